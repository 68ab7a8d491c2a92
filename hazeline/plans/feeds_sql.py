"""Feed and vulnerability queries over feed-like views of the relational tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.operators import sampling, urls
from hazeline.sources import feeds, vulnerabilities

_KEV = """SELECT p_partkey AS ord, CASE WHEN p_partkey % 50 = 7 THEN NULL ELSE concat('CVE-2024-', CAST(p_partkey AS STRING)) END AS cveID, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_brand END AS vendorProject, p_type AS product, p_name AS vulnerabilityName,
CASE WHEN p_size = 50 THEN NULL ELSE concat('2024-0', CAST(p_size % 9 + 1 AS STRING), '-11') END AS dateAdded, CASE WHEN p_size % 3 = 0 THEN NULL ELSE concat('retail ', p_brand) END AS shortDescription, 'Apply updates' AS requiredAction,
CASE WHEN p_size % 7 = 0 THEN '' ELSE '2024-12-01' END AS dueDate, CASE p_size % 4 WHEN 0 THEN 'Known' WHEN 1 THEN NULL ELSE 'Unknown' END AS knownRansomwareCampaignUse, CASE WHEN p_size % 5 = 0 THEN 'see bulletin' ELSE '' END AS notes FROM part"""
_EDB = """SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 90 = 3 THEN '' ELSE CAST(o_orderkey AS STRING) END AS id, CASE WHEN o_orderkey % 11 = 0 THEN '  ' ELSE concat(' ', o_orderpriority, ' ', repeat('overflow ', CAST(o_orderkey % 20 AS INT))) END AS description,
o_orderstatus AS platform, CAST(NULL AS STRING) AS type, concat('cust', CAST(o_custkey AS STRING)) AS author, CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_published, CASE WHEN o_orderkey % 4 = 0 THEN '443' ELSE '' END AS port FROM orders"""
_POSTS = "SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('Customer ', CAST(o_custkey AS STRING)) END AS post_title, concat('g', CAST(o_orderkey % 30 AS STRING)) AS group_name, CAST(CAST(o_orderdate AS DATE) AS STRING) AS discovered, CASE WHEN o_orderkey % 3 = 0 THEN 'files leaked' ELSE '' END AS description, CASE WHEN o_orderkey % 2 = 0 THEN 'http://x.onion/p' ELSE NULL END AS link FROM orders"
_IOCS = """SELECT o_orderkey AS ord, concat('10.0.', CAST(o_orderkey % 250 AS STRING), '.1') AS ioc, CASE o_orderkey % 4 WHEN 0 THEN 'ip:port' WHEN 1 THEN 'domain' WHEN 2 THEN 'url' ELSE 'md5_hash' END AS ioc_type, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE concat('type', CAST(o_orderkey % 2 AS STRING)) END AS threat_type,
concat('win.', o_orderstatus) AS malware, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('Family ', CAST(o_custkey % 17 AS STRING)) END AS malware_printable, CAST(CAST(o_orderdate AS DATE) AS STRING) AS first_seen, CASE WHEN o_orderkey % 8 = 0 THEN 'high' ELSE CAST(o_orderkey % 4 * 25 AS STRING) END AS confidence_level,
CASE WHEN o_orderkey % 3 = 0 THEN concat(' tag', CAST(o_custkey % 4 AS STRING), ', c2,') ELSE NULL END AS tags, CASE WHEN o_orderkey % 6 = 0 THEN concat('https://r.example/', CAST(o_custkey % 9 AS STRING)) ELSE NULL END AS reference, CAST(NULL AS STRING) AS reporter FROM orders"""
_PHISH = "SELECT event_id AS ord, CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(event_id AS STRING) END AS phish_id, CASE WHEN event_id % 13 = 0 THEN '' ELSE concat('http://login.example/', repeat('a', CAST(event_id % 100 AS INT))) END AS url, CASE event_id % 3 WHEN 0 THEN 'Bank' WHEN 1 THEN '' ELSE NULL END AS target, 'yes' AS verified, CASE WHEN event_id % 2 = 0 THEN '2024-02-03T04:05:06' ELSE NULL END AS submission_time, CASE WHEN event_id % 5 = 0 THEN concat('https://d.example/', CAST(event_id AS STRING)) ELSE '' END AS phish_detail_url FROM events"
_sha8 = lambda x: f"sha256({x})[1:8]"
_some = lambda before, x, after="": f"CASE WHEN {x} <> '' THEN concat('{before}', {x}, '{after}') END"


def _view(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {table}", "FROM {t}"), t=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def feed_kev(spark, sf_dir):
    return feeds.kev(_view(spark, sf_dir, _KEV, "part"), 200).select("ord", "id", "title", "content", "url", "source_category_hint", "published_at")


_KEV_SQL = f"""WITH k AS (SELECT *, row_number() OVER (ORDER BY coalesce(dateAdded, '') DESC, ord) AS nth FROM ({_KEV})),
d AS (SELECT *, coalesce(vendorProject, 'Unknown') AS vendor, coalesce(knownRansomwareCampaignUse, 'Unknown') AS use FROM k WHERE nth <= 200 AND cveID IS NOT NULL)
SELECT nth AS ord, concat('cisa_kev_', cveID, '_', {_sha8("concat('cisa_kev_', cveID)")}) AS id, concat('CISA KEV: ', cveID, ' - ', vendor, ' ', product) AS title,
concat_ws(' ', concat('CISA Known Exploited Vulnerability: ', cveID, ' - ', vulnerabilityName, '.'), concat('Vendor: ', vendor, '. Product: ', product, '.'), shortDescription, concat('Required action: ', requiredAction, '.'),
  {_some('Remediation due date: ', 'dueDate', '.')}, CASE WHEN use <> 'Unknown' THEN concat('Known ransomware campaign use: ', use, '.') END, {_some('Notes: ', 'notes')}) AS content,
'https://www.cisa.gov/known-exploited-vulnerabilities-catalog' AS url, CASE WHEN use = 'Known' THEN 'ransomware' ELSE 'vulnerability' END AS source_category_hint, dateAdded AS published_at FROM d"""


def feed_exploitdb(spark, sf_dir):
    return feeds.exploitdb(_view(spark, sf_dir, _EDB, "orders"), 200).select("ord", "id", "title", "content", "url")


_EDB_SQL = f"""WITH e AS (SELECT * FROM ({_EDB}) ORDER BY ord DESC LIMIT 200), t AS (SELECT *, trim(description) AS d, concat('https://www.exploit-db.com/exploits/', id) AS link FROM e WHERE id <> '')
SELECT ord, concat('exploitdb_', id, '_', {_sha8('concat(id, d, date_published)')}) AS id, concat('Exploit: ', CASE WHEN d = '' THEN id WHEN length(d) > 120 THEN concat(substr(d, 1, 120), '...') ELSE d END) AS title,
concat_ws(' ', nullif(d, ''), concat('Platform: ', platform, '.'), concat('Author: ', author, '.'), concat('Published: ', date_published, '.'), {_some('Port: ', 'port', '.')}, concat('ExploitDB URL: ', link)) AS content, link AS url FROM t"""


def feed_phishtank(spark, sf_dir):
    return feeds.phishtank(_view(spark, sf_dir, _PHISH, "events"), 400).select("ord", "id", "title", "content", "url", "published_at")


_PHISH_SQL = f"""WITH p AS (SELECT *, coalesce(phish_id, 'None') AS pid, coalesce(target, 'Unknown') AS brand FROM ({_PHISH}) ORDER BY ord LIMIT 400)
SELECT ord, concat('phishtank_', pid, '_', {_sha8('concat(pid, url)')}) AS id, concat('Phishing: ', brand, CASE WHEN url <> '' THEN concat(' - ', substr(url, 1, 80)) ELSE '' END) AS title,
concat_ws('. ', concat('Phishing URL: ', url), {_some('Target brand: ', 'brand')}, 'Submitted: ' || submission_time, concat('Verified: ', verified), {_some('Details: ', 'phish_detail_url')}) AS content,
CASE WHEN phish_detail_url <> '' THEN phish_detail_url ELSE url END AS url, submission_time AS published_at FROM p WHERE phish_id IS NOT NULL OR url <> ''"""


def feed_ransomwatch(spark, sf_dir):
    k = F.col("id")
    slugs = F.when(k % 2 == 0, F.array(*[F.struct(F.lit(x).alias("slug")) for x in ("s1", None, "s2", "s3", "s4")])).otherwise(F.array().cast("array<struct<slug:string>>"))
    groups = spark.range(25).select(k.alias("ord"), F.concat(F.lit("g"), (k % 20).cast("string")).alias("name"), F.when(k % 3 == 0, F.concat(F.lit("profile of "), k.cast("string"))).alias("meta"), F.array(F.lit("p1"), F.lit("p2"), F.lit("p3")).alias("profile"), slugs.alias("locations"))
    return feeds.ransomwatch(_view(spark, sf_dir, _POSTS, "orders"), groups, 300).select("ord", "id", "title", "content", "url")


_POSTS_SQL = f"""WITH p AS (SELECT *, coalesce(post_title, 'Untitled') AS post FROM ({_POSTS}) ORDER BY ord LIMIT 300),
g AS (SELECT concat('g', CAST(range % 20 AS STRING)) AS group_name, CASE WHEN range % 3 = 0 THEN concat('profile of ', CAST(range AS STRING)) END AS meta, CASE WHEN range % 2 = 0 THEN 's1, s2, s3' ELSE 'p1, p2' END AS known FROM range(25) WHERE range >= 5)
SELECT ord, concat('ransomwatch_', {_sha8('concat(group_name, post, discovered)')}) AS id, concat('Ransomware: ', group_name, ' - ', post) AS title,
concat_ws(' ', concat('Ransomware group: ', group_name, '. Post: ', post, '.'), concat('Discovered: ', discovered, '.'), 'Group profile: ' || meta || '.', 'Related URLs: ' || known || '.', nullif(description, '')) AS content, coalesce(link, 'https://github.com/joshhighet/ransomwatch') AS url FROM p LEFT JOIN g USING (group_name)"""


def feed_threatfox(spark, sf_dir):
    return feeds.threatfox(_view(spark, sf_dir, _IOCS, "orders"), 200).select("ord", "id", "title", "content", "url", "published_at")


_kind = "CASE WHEN contains(ioc_type, 'domain') THEN 'domain' WHEN contains(ioc_type, 'ip') THEN 'ip' WHEN contains(ioc_type, 'url') THEN 'url' END"
_IOCS_SQL = f"""WITH i AS (SELECT *, coalesce(nullif(malware_printable, ''), nullif(malware, ''), 'Unknown') AS family, {_kind} AS kind FROM ({_IOCS})),
f AS (SELECT family, count(*) AS n, min(first_seen) AS first_seen, min(ord) AS o, count(*) FILTER (kind = 'domain') AS nd, count(*) FILTER (kind = 'ip') AS ni, count(*) FILTER (kind = 'url') AS nu,
  array_to_string((list(ioc ORDER BY ord) FILTER (kind = 'domain'))[1:20], ', ') AS ds, array_to_string((list(ioc ORDER BY ord) FILTER (kind = 'ip'))[1:20], ', ') AS ips, array_to_string((list(ioc ORDER BY ord) FILTER (kind = 'url'))[1:10], ', ') AS us,
  coalesce(array_to_string(list_sort(list_distinct(list(threat_type) FILTER (threat_type IS NOT NULL))), ', '), 'unknown') AS threats, coalesce(array_to_string(list_sort(list_distinct(list_filter(flatten(list(list_transform(string_split(tags, ','), lambda t: trim(t))) FILTER (tags IS NOT NULL)), lambda t: t <> ''))), ', '), '') AS tags,
  coalesce(CAST(round_even(avg(try_cast(confidence_level AS BIGINT)), 0) AS BIGINT), 0) AS conf, coalesce(array_to_string(list_sort(list_distinct(list(reference) FILTER (reference IS NOT NULL)))[1:5], ' '), '') AS refs FROM i GROUP BY family),
p AS (SELECT *, concat_ws(', ', CASE WHEN nd > 0 THEN concat(nd, ' domains') END, CASE WHEN ni > 0 THEN concat(ni, ' IPs') END, CASE WHEN nu > 0 THEN concat(nu, ' URLs') END) AS counted FROM f)
SELECT row_number() OVER (ORDER BY n DESC, o) AS ord, concat('threatfox_', replace(lower(family), ' ', '_'), '_', {_sha8("concat('threatfox_', family, '_', coalesce(first_seen, ''))")}) AS id, concat('ThreatFox IOCs: ', family) AS title,
concat_ws(' ', concat('Threat intelligence: ', family, ' (', coalesce(nullif(threats, ''), 'unknown'), ').'), {_some('IOC indicators: ', 'counted', '.')}, CASE WHEN nd > 0 THEN concat('Malicious domains: ', ds, '.') END, CASE WHEN ni > 0 THEN concat('Command and control IPs: ', ips, '.') END, CASE WHEN nu > 0 THEN concat('Malicious URLs: ', us, '.') END,
  {_some('Tags: ', 'tags', '.')}, concat('Confidence level: ', conf, '.'), {_some('References: ', 'refs', '.')}) AS content, concat('https://threatfox.abuse.ch/browse/malware/', replace(family, ' ', '%20'), '/') AS url, first_seen AS published_at FROM p QUALIFY row_number() OVER (ORDER BY n DESC, o) <= 200"""


def feed_mitre(spark, sf_dir):
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    none, k, p = F.lit(None).cast("array<string>"), F.col("s_suppkey"), F.col("p_partkey")
    text = lambda c: c.cast("string")
    missing = F.lit(None).cast("string")
    objects = (
        read("supplier").select(k.alias("ord"), F.concat(F.lit("intrusion-set--0000"), text(k)).alias("stix_id"), F.lit("intrusion-set").alias("type"), F.when(k % 11 != 0, F.col("s_name")).alias("name"), F.lit(" A group ").alias("description"), F.when(k % 2 == 0, F.array(F.lit("a"), F.lit("b"))).alias("aliases"), (k % 7 == 0).alias("revoked"), F.lit("2020").alias("created"), missing.alias("modified"), F.when(k % 3 == 0, F.concat(F.lit("G"), text(k))).alias("external_id"), F.when(k % 3 == 0, F.lit("https://g.example")).alias("url"))
        .unionByName(read("part").select(p.alias("ord"), F.concat(F.lit("P"), text(p)).alias("stix_id"), F.when(p % 3 == 0, "malware").when(p % 3 == 1, "tool").otherwise("attack-pattern").alias("type"), F.concat(F.lit("part"), text(p)).alias("name"), F.lit("").alias("description"), none.alias("aliases"), F.lit(False).alias("revoked"), F.lit("2020").alias("created"), missing.alias("modified"), missing.alias("external_id"), missing.alias("url")))
    )
    uses = read("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.concat(F.lit("intrusion-set--0000"), text(F.col("l_suppkey"))).alias("source_ref"), F.concat(F.lit("P"), text(F.col("l_partkey"))).alias("target_ref"), F.lit("uses").alias("relationship_type"))
    return feeds.mitre(objects, uses, 200).select("ord", "id", "title", "content", "url")


_MITRE_SQL = f"""WITH s AS (SELECT s_suppkey AS k, coalesce(CASE WHEN s_suppkey % 11 <> 0 THEN s_name END, 'Unknown') AS name, CASE WHEN s_suppkey % 3 = 0 THEN concat('G', CAST(s_suppkey AS STRING)) ELSE right(concat('intrusion-set--0000', CAST(s_suppkey AS STRING)), 8) END AS ext, CASE WHEN s_suppkey % 3 = 0 THEN 'https://g.example' ELSE '' END AS url FROM supplier WHERE s_suppkey % 7 <> 0 ORDER BY s_suppkey LIMIT 200),
u AS (SELECT l_suppkey AS k, l_partkey % 3 AS kind, concat('part', CAST(l_partkey AS STRING)) AS name, row_number() OVER (PARTITION BY l_suppkey, l_partkey % 3 ORDER BY l_orderkey * 10 + l_linenumber, concat('part', CAST(l_partkey AS STRING))) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)),
a AS (SELECT k, string_agg(name, ', ' ORDER BY n) FILTER (kind = 2 AND n <= 20) AS t, string_agg(name, ', ' ORDER BY n) FILTER (kind = 0 AND n <= 10) AS m, string_agg(name, ', ' ORDER BY n) FILTER (kind = 1 AND n <= 10) AS o FROM u GROUP BY k)
SELECT s.k AS ord, concat('mitre_attack_', ext, '_', {_sha8('concat(ext, name, url)')}) AS id, concat('Threat Actor: ', name) AS title,
concat_ws(' ', concat('Threat actor: ', name, '.'), CASE WHEN s.k % 2 = 0 THEN 'Aliases: a, b.' END, 'A group', 'Known techniques: ' || t || '.', 'Associated malware: ' || m || '.', 'Associated tools: ' || o || '.') AS content, nullif(url, '') AS url FROM s LEFT JOIN a USING (k)"""


_OTX = "SELECT event_id AS ord, CASE WHEN event_id % 19 = 0 THEN '' ELSE concat('p', CAST(event_id AS STRING)) END AS pulse_id, CASE WHEN event_id % 23 = 0 THEN NULL ELSE concat('Pulse ', event_type) END AS name, CASE WHEN event_id % 2 = 0 THEN ' seen in logs ' ELSE NULL END AS description, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS STRING) END AS created, event_id % 4 AS shape FROM events"


def feed_otx(spark, sf_dir):
    rows = _view(spark, sf_dir, _OTX, "events")
    some = lambda *x: F.array(*map(F.lit, x))
    shape, none = F.col("shape"), F.array().cast("array<string>")
    rows = rows.withColumns({"tags": F.when(shape == 1, some("apt", "c2")).otherwise(none), "indicator_types": F.when(shape == 0, none).when(shape == 1, some("URL", "domain", "URL")).otherwise(some("IPv4")), "references": F.when(shape == 2, some("r1", "r2", "r3", "r4", "r5", "r6")).otherwise(none)})
    return feeds.otx(rows, 300).select("ord", "id", "title", "content", "url", "published_at")


_OTX_SQL = f"""WITH o AS (SELECT *, coalesce(nullif(pulse_id, ''), coalesce(name, '')) AS pid, coalesce(name, 'Untitled Pulse') AS title FROM ({_OTX}) ORDER BY ord LIMIT 300)
SELECT ord, concat('otx_', pid, '_', {_sha8("concat(pid, title, coalesce(created, 'None'))")}) AS id, title,
concat_ws(' ', trim(description), CASE WHEN shape = 1 THEN 'Tags: apt, c2.' END, concat('Indicator summary: ', CASE shape WHEN 0 THEN 'No indicators' WHEN 1 THEN 'URL: 2; domain: 1' ELSE 'IPv4: 1' END, '.'), CASE WHEN shape = 2 THEN 'References: r1 r2 r3 r4 r5' END) AS content, concat('https://otx.alienvault.com/pulse/', pid) AS url, created AS published_at FROM o"""


def _records(spark, sf_dir):
    """CVE records as JSON text from parts: nested weaknesses, three metric versions, two reference shapes."""
    k = F.col("p_partkey")
    cwe = lambda x: F.format_string('{"value":"CWE-%d"}', x)
    more = F.concat(F.when(k % 2 == 0, ',"vectorString":"AV:N"').otherwise(""), F.lit("}"), F.when(k % 5 == 0, ',"exploitabilityScore":3.9').otherwise(""))
    metric = F.format_string('[{"cvssData":{"baseScore":%.1f,"baseSeverity":"%s"%s}]', (k % 100) / 10.0, F.when(k % 2 == 0, "HIGH").otherwise("LOW"), more)
    refs = F.when(k % 3 == 0, F.concat(F.lit('[{"url":"https://a.example/'), k.cast("string"), F.lit('","tags":["Patch","Vendor Advisory"]},{"url":"https://b.example"}]'))).otherwise("[]")
    name = F.element_at(F.array(F.lit("cvssMetricV31"), F.lit("cvssMetricV30"), F.lit("cvssMetricV2")), (k % 3 + 1).cast("int"))
    weak = F.when(k % 4 == 0, "[]").otherwise(F.concat(F.lit('[{"description":['), cwe(k % 20), F.lit(","), cwe(k % 7), F.lit("]}]")))
    text = F.concat(F.lit('{"id":"CVE-'), k.cast("string"), F.lit('","published":"2024","descriptions":[{"lang":"fr","value":"un"},{"lang":"en","value":"one"}],"metrics":{"'), name, F.lit('":'), metric, F.lit('},"references":'), refs, F.lit(',"weaknesses":'), weak, F.lit("}"))
    raw = spark.read.parquet(f"{sf_dir}/part.parquet").select(text.alias("record"))
    return vulnerabilities.records(raw)


def cve_cwe_join(spark, sf_dir):
    weaknesses = spark.range(10).select(F.col("id").cast("string").alias("cwe_id"), F.concat(F.lit("weakness "), F.col("id").cast("string")).alias("name"))
    rows = vulnerabilities.with_weaknesses(_records(spark, sf_dir), weaknesses)
    details = F.array_sort(F.transform(F.map_entries("details"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return rows.select("cve_id", F.array_join("cwe_ids", ",").alias("cwe_ids"), F.array_join(details, ",").alias("details"))


_CWE_SQL = """WITH w AS (SELECT p_partkey, CAST(unnest(list_distinct([p_partkey % 20, p_partkey % 7])) AS STRING) AS c FROM part WHERE p_partkey % 4 <> 0)
SELECT concat('CVE-', CAST(p_partkey AS STRING)) AS cve_id, string_agg(c, ',' ORDER BY c) AS cwe_ids, coalesce(string_agg(concat(c, '=weakness ', c), ',' ORDER BY c) FILTER (CAST(c AS INT) < 10), '') AS details FROM w GROUP BY p_partkey"""


def cve_cvss_preference(spark, sf_dir):
    m = vulnerabilities.best_metric()
    return _records(spark, sf_dir).select("id", m["cvssData"]["baseScore"].alias("score"), m["cvssData"]["baseSeverity"].alias("severity"), vulnerabilities.description().alias("description"))


_CVSS_SQL = "SELECT concat('CVE-', CAST(p_partkey AS STRING)) AS id, (p_partkey % 100) / 10.0e0 AS score, CASE WHEN p_partkey % 2 = 0 THEN 'HIGH' ELSE 'LOW' END AS severity, 'one' AS description FROM part"


def _cve_documents(spark, sf_dir):
    weaknesses = spark.range(10).select(F.col("id").cast("string").alias("cwe_id"), F.concat(F.lit("weakness "), F.col("id").cast("string")).alias("name"))
    return vulnerabilities.documents(_records(spark, sf_dir), weaknesses)


def cve_documents(spark, sf_dir):
    return _cve_documents(spark, sf_dir).select("id", "title", "content", "url", "severity")


_CVE_DOC_SQL = f"""WITH w AS (SELECT DISTINCT p_partkey AS k, unnest([p_partkey % 20, p_partkey % 7]) AS c FROM part WHERE p_partkey % 4 <> 0), d AS (SELECT k, string_agg(concat('CWE-', c, ': weakness ', c), chr(10) ORDER BY CAST(c AS STRING)) AS lines FROM w WHERE c < 10 GROUP BY k),
p AS (SELECT p_partkey AS k, concat('CVE-', p_partkey) AS cve, CASE WHEN p_partkey % 2 = 0 THEN 'HIGH' ELSE 'LOW' END AS sev FROM part)
SELECT concat('nvd_cve_', cve, '_', {_sha8("cve")}) AS id, concat(cve, ' (', sev, ') - one') AS title, concat('https://nvd.nist.gov/vuln/detail/', cve) AS url, sev AS severity,
concat_ws(chr(10), concat('CVE Identifier: ', cve), '', 'one', '', concat('CVSS Score: ', CAST((p.k % 100) / 10.0e0 AS STRING), ' (', sev, ')', CASE WHEN p.k % 2 = 0 THEN ' Vector: AV:N' ELSE '' END), CASE WHEN p.k % 5 = 0 THEN 'Exploitability Score: 3.9' END, '',
  CASE WHEN p.k % 4 <> 0 THEN concat('Weakness: CWE-', p.k % 20, ', CWE-', p.k % 7) END, d.lines, '', CASE WHEN p.k % 3 = 0 THEN concat_ws(chr(10), 'References:', concat('  - https://a.example/', p.k, ' [Patch, Vendor Advisory]'), '  - https://b.example', '') END) AS content FROM p LEFT JOIN d USING (k)"""


def cve_labels(spark, sf_dir):
    return sampling.cve_labels(_cve_documents(spark, sf_dir))


def _refs(spark, sf_dir):
    k = F.col("p_partkey")
    url = F.concat(F.lit("https://h"), (k % 5).cast("string"), F.lit(".com/"), k.cast("string"))
    refs = F.when(k % 3 == 0, F.concat(F.lit('[{"url":"'), url, F.lit('","tags":["Patch"]},{"url":"https://youtu.be/x"}]'))).when(k % 3 == 1, F.concat(F.lit('{"reference_data":[{"url":"'), url, F.lit('","name":"n"}]}'))).otherwise(F.lit("[]"))
    return urls.references(spark.read.parquet(f"{sf_dir}/part.parquet").select(k.alias("cve_id"), refs.alias("refs")))


def cve_references(spark, sf_dir):
    return _refs(spark, sf_dir).select("cve_id", "idx", "url", F.coalesce(F.array_join("tags", ","), F.lit("")).alias("tags"))


_u = "concat('https://h', CAST(p_partkey % 5 AS STRING), '.com/', CAST(p_partkey AS STRING))"
_REFS_SQL = f"SELECT p_partkey AS cve_id, CAST(0 AS INT) AS idx, {_u} AS url, CASE WHEN p_partkey % 3 = 0 THEN 'Patch' ELSE '' END AS tags FROM part WHERE p_partkey % 3 < 2 UNION ALL SELECT p_partkey, CAST(1 AS INT), 'https://youtu.be/x', '' FROM part WHERE p_partkey % 3 = 0"


def cve_reference_stats(spark, sf_dir):
    return urls.reference_stats(_refs(spark, sf_dir))


_STATS_SQL = "SELECT count(*) FILTER (p_partkey % 3 = 0) * 2 + count(*) FILTER (p_partkey % 3 = 1) AS n_references, count(*) FILTER (p_partkey % 3 = 0) AS media_references, count(*) FILTER (p_partkey % 3 < 2) AS cves_with_references FROM part"


def reference_outcomes(spark, sf_dir):
    k = F.col("p_partkey")
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.when(k % 6 == 0, "media").otherwise("article").alias("ref_type"), F.when(k % 5 == 0, 404).otherwise(200).alias("status"), F.when(k % 7 == 0, "ftp://x").otherwise("https://x").alias("url"))
    return urls.outcome_counts(rows)


_OUT_SQL = "SELECT count(*) FILTER (p_partkey % 6 <> 0) AS processed, count(*) FILTER (p_partkey % 6 <> 0 AND p_partkey % 5 <> 0 AND p_partkey % 7 <> 0) AS succeeded, count(*) FILTER (p_partkey % 6 <> 0 AND (p_partkey % 5 = 0 OR p_partkey % 7 = 0)) AS failed, count(*) FILTER (p_partkey % 6 = 0) AS skipped_media FROM part"


def storage_keys(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    key = urls.object_key("refs", F.lit("2024-05-01"), "raw", F.concat(F.lit("CVE-"), F.col("page_id").cast("string")), F.col("page_id") % 7, F.col("url"), F.when(F.col("page_id") % 2 == 0, "text/html").otherwise("image/png"))
    return pages.select("page_id", key.alias("key"))


def queries() -> dict[str, Callable]:
    found = (feed_kev, feed_exploitdb, feed_phishtank, feed_otx, feed_ransomwatch, feed_threatfox, feed_mitre, cve_cwe_join, cve_cvss_preference, cve_documents, cve_labels, cve_references, cve_reference_stats, reference_outcomes, storage_keys)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "feed_kev": _KEV_SQL, "feed_exploitdb": _EDB_SQL, "feed_phishtank": _PHISH_SQL, "feed_otx": _OTX_SQL, "feed_ransomwatch": _POSTS_SQL, "feed_threatfox": _IOCS_SQL, "feed_mitre": _MITRE_SQL,
        "cve_cwe_join": _CWE_SQL, "cve_documents": _CVE_DOC_SQL, "cve_cvss_preference": _CVSS_SQL, "cve_references": _REFS_SQL, "cve_reference_stats": _STATS_SQL, "reference_outcomes": _OUT_SQL,
    }
