"""Feeds to the unified document table.

Each feed is a function of its payload's DataFrame, so the payload may come from a JSON or
CSV file, an object store or a test. Columns out: ord, id, title, content, url, source,
source_category_hint, published_at, collected_at, metadata.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeline.operators.urls import sha8

EXPLOITDB_URL = "https://www.exploit-db.com/"
KEV_URL = "https://www.cisa.gov/known-exploited-vulnerabilities-catalog"
RANSOM_URL = "https://github.com/joshhighet/ransomwatch"


def _document(rows: DataFrame, source: str, id_: Column, title: Column, content: Column, url: Column, hint: Column, published: Column, metadata: Column, collected: str = "") -> DataFrame:
    return rows.select("ord", id_.alias("id"), title.alias("title"), content.alias("content"), url.alias("url"), F.lit(source).alias("source"), hint.alias("source_category_hint"), published.alias("published_at"), F.lit(collected).alias("collected_at"), F.to_json(metadata).alias("metadata"))


def _text(c: str | Column, default: str = "") -> Column:
    """A column as text; null is taken for a field that is not there."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(default))


def _said(before: str, value: Column, after: str = "") -> Column:
    """``value`` with words around it, null where it is null or empty, so that joins leave it out."""
    value = value.cast("string")
    return F.when(value != "", F.concat(F.lit(before), value, F.lit(after)))


def _glued(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _numbered(rows: DataFrame, *order: Column | str) -> DataFrame:
    """A place in ``order`` as ``ord``; for tables already cut to a bounded number of rows."""
    return rows.withColumn("ord", F.row_number().over(Window.orderBy(*order)).cast("long"))


def kev(rows: DataFrame, n: int = 200) -> DataFrame:
    """Newest ``n`` known exploited vulnerabilities (S01): a top-n, not a sort of all.

    rows: ord (place in the catalog, which settles equal dates), cveID, vendorProject, product,
    vulnerabilityName, dateAdded, shortDescription, requiredAction, dueDate,
    knownRansomwareCampaignUse, notes. Entries without cveID take a place and are left out.
    """
    order = (F.desc(_text("dateAdded")), "ord")
    top = _numbered(rows.orderBy(*order).limit(n), *order).where("cveID <> ''")
    cve, vendor, product, use = F.col("cveID"), _text("vendorProject", "Unknown"), _text("product", "Unknown"), _text("knownRansomwareCampaignUse", "Unknown")
    content = F.concat_ws(
        " ",
        _glued("CISA Known Exploited Vulnerability: ", cve, " - ", _text("vulnerabilityName"), "."),
        _glued("Vendor: ", vendor, ". Product: ", product, "."),
        _said("", _text("shortDescription")),
        _said("Required action: ", _text("requiredAction"), "."),
        _said("Remediation due date: ", _text("dueDate"), "."),
        F.when(use != "Unknown", _said("Known ransomware campaign use: ", use, ".")),
        _said("Notes: ", _text("notes")),
    )
    id_ = _glued("cisa_kev_", cve, "_", sha8(_glued("cisa_kev_", cve)))
    hint = F.when(use == "Known", "ransomware").otherwise("vulnerability")
    meta = F.struct(cve.alias("cve_id"), vendor.alias("vendor"), product.alias("product"), use.alias("ransomware_use"), F.col("dateAdded").alias("date_added"), F.col("dueDate").alias("due_date"))
    return _document(top, "cisa_kev", id_, _glued("CISA KEV: ", cve, " - ", vendor, " ", product), content, F.lit(KEV_URL), hint, F.nullif("dateAdded", F.lit("")), meta)


def exploitdb(rows: DataFrame, n: int = 200, base_url: str = EXPLOITDB_URL) -> DataFrame:
    """Last ``n`` rows in file order (S02): rows carry ``ord``, id, description, platform, type, author, date_published, port."""
    top = rows.orderBy(F.desc("ord")).limit(n).where("id <> ''")
    edb, text, date = F.col("id").cast("string"), F.trim(_text("description")), _text("date_published")
    short = F.when(F.length(text) > 120, F.concat(F.substring(text, 1, 120), F.lit("..."))).otherwise(text)
    url = _glued(base_url, "exploits/", edb)
    said = [_said(f"{label}: ", _text(c), ".") for label, c in (("Platform", "platform"), ("Type", "type"), ("Author", "author"), ("Published", "date_published"), ("Port", "port"))]
    content = F.concat_ws(" ", _said("", text), *said, _glued("ExploitDB URL: ", url))
    id_ = _glued("exploitdb_", edb, "_", sha8(F.concat(edb, text, date)))
    return _document(top, "exploitdb", id_, _glued("Exploit: ", F.when(short != "", short).otherwise(edb)), content, url, F.lit("exploit"), F.nullif(date, F.lit("")), F.struct(edb.alias("edb_id"), "author", "platform", "type", "port"))


def mitre(objects: DataFrame, relationships: DataFrame, n: int = 200) -> DataFrame:
    """Intrusion sets with the techniques, malware and tools they use.

    objects: ord, stix_id, type, name, description, aliases, revoked, created, modified, and
    external_id and url of the object's own reference. One join serves all three kinds; of
    each kind only the first names in the order of the relations are gathered.
    """
    most = {"attack-pattern": 20, "malware": 10, "tool": 10}
    actors = objects.where((F.col("type") == "intrusion-set") & ~F.coalesce("revoked", F.lit(False))).orderBy("ord").limit(n)
    named = objects.where(F.col("type").isin(*most) & (F.col("name") != "")).select(F.col("stix_id").alias("target_ref"), F.col("type").alias("kind"), F.col("name").alias("used"))
    uses = relationships.where("relationship_type = 'uses'").select("source_ref", "target_ref", F.col("ord").alias("o"))
    uses = uses.join(actors.select(F.col("stix_id").alias("source_ref")), "source_ref", "left_semi").join(named, "target_ref")
    nth = F.row_number().over(Window.partitionBy("source_ref", "kind").orderBy("o", "used"))
    first = uses.withColumn("nth", nth).where(F.col("nth") <= max(most.values())).where((F.col("kind") == "attack-pattern") | (F.col("nth") <= 10))
    lists = first.groupBy("source_ref").pivot("kind", list(most)).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "used"))), lambda x: x["used"]), ", "))
    rows = actors.join(lists, actors["stix_id"] == lists["source_ref"], "left")
    name, url = _text(F.nullif("name", F.lit("")), "Unknown"), _text("url")
    external = F.coalesce(F.nullif("external_id", F.lit("")), F.expr("right(stix_id, 8)"), F.lit("unknown"))
    content = F.concat_ws(
        " ",
        _glued("Threat actor: ", name, "."),
        _said("Aliases: ", _text(F.array_join("aliases", ", ")), "."),
        _said("", F.trim(_text("description"))),
        *[_said(label, _text(F.col(f"`{c}`")), ".") for label, c in (("Known techniques: ", "attack-pattern"), ("Associated malware: ", "malware"), ("Associated tools: ", "tool"))],
    )
    id_ = _glued("mitre_attack_", external, "_", sha8(F.concat(external, name, url)))
    return _document(rows, "mitre_attack", id_, _glued("Threat Actor: ", name), content, F.nullif(url, F.lit("")), F.lit("threat_actor"), F.coalesce(F.nullif("created", F.lit("")), "modified"), F.struct(external.alias("mitre_id"), "aliases", "created", "modified"))


def phishtank(rows: DataFrame, n: int = 200) -> DataFrame:
    """First ``n`` reports (S04): ord, phish_id, url, target, verified, submission_time, phish_detail_url."""
    top = rows.orderBy("ord").limit(n).where("phish_id <> '' OR url <> ''")
    phish, raw, target, time, detail = _text("phish_id", "None"), _text("url"), _text("target", "Unknown"), _text("submission_time"), _text("phish_detail_url")
    title = _glued("Phishing: ", target, F.when(raw != "", F.concat(F.lit(" - "), F.substring(raw, 1, 80))).otherwise(""))
    content = F.concat_ws(". ", _glued("Phishing URL: ", raw), _said("Target brand: ", target), _said("Submitted: ", time), _glued("Verified: ", _text("verified", "unknown")), _said("Details: ", detail))
    return _document(top, "phishtank", _glued("phishtank_", phish, "_", sha8(F.concat(phish, raw))), title, content, F.when(detail != "", detail).otherwise(raw), F.lit("phishing"), F.nullif(time, F.lit("")), F.struct("phish_id", "target", "verified", raw.alias("original_url")))


def ransomwatch(posts: DataFrame, groups: DataFrame, n: int = 200) -> DataFrame:
    """Posts beside what is known of their group (S05): a left join; three slugs, else two profile links.

    posts: ord, group_name, post_title, discovered, description, link; groups: ord, name, meta,
    profile, locations (with slug), of one name the last.
    """
    top = posts.orderBy("ord").limit(n)
    slugs = F.filter(F.transform("locations", lambda x: x["slug"]), lambda x: x != "")
    urls = F.when(F.size(F.coalesce(slugs, F.array().cast("array<string>"))) > 0, F.slice(slugs, 1, 3)).otherwise(F.slice("profile", 1, 2))
    last = groups.where("name <> ''").groupBy("name").agg(F.max_by(F.struct(F.col("meta"), urls.alias("urls")), "ord").alias("g"))
    group, title, found = _text("group_name", "unknown"), _text("post_title", "Untitled"), _text("discovered")
    rows = top.withColumn("own", group).join(last, F.col("own") == F.col("name"), "left")
    content = F.concat_ws(
        " ",
        _glued("Ransomware group: ", group, ". Post: ", title, "."),
        _said("Discovered: ", found, "."),
        _said("Group profile: ", _text("g.meta"), "."),
        _said("Related URLs: ", _text(F.array_join("g.urls", ", ")), "."),
        _said("", _text("description")),
    )
    link = F.coalesce(F.nullif("link", F.lit("")), F.lit(RANSOM_URL))
    return _document(rows, "ransomwatch", _glued("ransomwatch_", sha8(F.concat(group, title, found))), _glued("Ransomware: ", group, " - ", title), content, link, F.lit("ransomware"), F.nullif(found, F.lit("")), F.struct(group.alias("group_name"), "discovered", F.col("g").alias("group_profile")))


_FOUND = {"domain": ("Malicious domains: ", 20), "ip": ("Command and control IPs: ", 20), "url": ("Malicious URLs: ", 10)}


def threatfox(iocs: DataFrame, n: int = 200) -> DataFrame:
    """One document a malware family, largest first.

    iocs: ord, ioc, ioc_type, threat_type, malware, malware_printable, first_seen,
    confidence_level, tags, reference, reporter. Indicators and references are numbered
    before they are gathered, so a family of any size brings only its first ones.
    """
    family = F.coalesce(F.nullif("malware_printable", F.lit("")), F.nullif("malware", F.lit("")), F.lit("Unknown"))
    has = lambda k: F.contains(_text("ioc_type"), F.lit(k))
    kind = F.when(has("domain"), "domain").when(has("ip"), "ip").when(has("url"), "url")
    rows = iocs.select("*", family.alias("family"), kind.alias("kind"))
    sets = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))), ", ")
    trimmed = F.filter(F.transform(F.split(_text("tags"), ","), lambda t: F.trim(t)), lambda t: t != "")
    per = rows.groupBy("family").agg(
        F.count("*").alias("n_iocs"), F.min("ord").alias("first_ord"), F.min(F.nullif("first_seen", F.lit(""))).alias("first_seen"), F.bround(F.avg(F.expr("try_cast(confidence_level AS BIGINT)"))).alias("confidence"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in _FOUND], sets(trimmed).alias("all_tags"), sets(F.array_compact(F.array(F.nullif("threat_type", F.lit(""))))).alias("threats"),
    )
    top = per.orderBy(F.desc("n_iocs"), "first_ord").limit(n)
    top = _numbered(top, F.desc("n_iocs"), "first_ord")
    names = top.select("family")
    nth = F.row_number().over(Window.partitionBy("family", "kind").orderBy("ord", "ioc"))
    few = rows.where("kind IS NOT NULL").join(names, "family", "left_semi").withColumn("nth", nth).where("nth <= 20").where("kind <> 'url' OR nth <= 10")
    few = few.groupBy("family").pivot("kind", list(_FOUND)).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "ioc"))), lambda x: x["ioc"]), ", "))
    refs = rows.where("reference <> ''").join(names, "family", "left_semi").select("family", "reference").distinct()
    refs = refs.withColumn("nth", F.row_number().over(Window.partitionBy("family").orderBy("reference"))).where("nth <= 5").groupBy("family").agg(F.array_join(F.array_sort(F.collect_list("reference")), " ").alias("refs"))
    top = top.join(few, "family", "left").join(refs, "family", "left")
    counted = F.concat_ws(", ", *[F.when(F.col(f"n_{k}") > 0, F.concat(F.col(f"n_{k}").cast("string"), F.lit(f" {label}"))) for k, label in (("domain", "domains"), ("ip", "IPs"), ("url", "URLs"))])
    content = F.concat_ws(
        " ",
        _glued("Threat intelligence: ", F.col("family"), " (", F.coalesce(F.nullif("threats", F.lit("")), F.lit("unknown")), ")."),
        _said("IOC indicators: ", counted, "."),
        *[F.when(F.col(f"n_{k}") > 0, F.concat(F.lit(label), _text(k), F.lit("."))) for k, (label, _) in _FOUND.items()],
        _said("Tags: ", F.col("all_tags"), "."),
        _glued("Confidence level: ", F.coalesce(F.col("confidence").cast("long"), F.lit(0)).cast("string"), "."),
        _said("References: ", _text("refs"), "."),
    )
    id_ = _glued("threatfox_", F.replace(F.lower("family"), F.lit(" "), F.lit("_")), "_", sha8(_glued("threatfox_", F.col("family"), "_", _text("first_seen"))))
    url = _glued("https://threatfox.abuse.ch/browse/malware/", F.replace("family", F.lit(" "), F.lit("%20")), "/")
    return _document(top, "threatfox", id_, _glued("ThreatFox IOCs: ", F.col("family")), content, url, F.lit("ioc"), F.col("first_seen"), F.struct(F.col("family").alias("malware_family"), F.col("n_iocs").alias("ioc_count"), F.col("n_domain").alias("domain_count"), F.col("n_ip").alias("ip_count"), F.col("n_url").alias("url_count")))


def threatfox_rows(raw: DataFrame) -> DataFrame:
    """The object of arrays under ``payload``, one row an indicator."""
    kind = "map<string,array<struct<ioc_value:string,ioc_type:string,threat_type:string,malware:string,malware_printable:string,first_seen_utc:string,confidence_level:string,tags:string,reference:string,reporter:string>>>"
    each = raw.select(F.posexplode(F.map_entries(F.from_json("payload", kind))).alias("ord", "e")).select("ord", F.explode("e.value").alias("x"))
    return each.select(F.col("ord").cast("long").alias("ord"), F.col("x.ioc_value").alias("ioc"), "x.ioc_type", "x.threat_type", "x.malware", "x.malware_printable", F.col("x.first_seen_utc").alias("first_seen"), "x.confidence_level", "x.tags", "x.reference", "x.reporter")


def otx(pulses: DataFrame, n: int = 100) -> DataFrame:
    """Pulses with their indicators counted by type (S07): ord, pulse_id, name, description, tags, indicator_types, references, created."""
    top = pulses.orderBy("ord").limit(n)
    pulse, name = F.coalesce(F.nullif("pulse_id", F.lit("")), _text("name")), _text(F.nullif("name", F.lit("")), "Untitled Pulse")
    types = F.coalesce("indicator_types", F.array().cast("array<string>"))
    counts = F.array_join(F.transform(F.array_sort(F.array_distinct(types)), lambda k: F.concat(k, F.lit(": "), F.size(F.filter(types, lambda t: t == k)).cast("string"))), "; ")
    content = F.concat_ws(
        " ",
        _said("", F.trim(_text("description"))),
        _said("Tags: ", _text(F.array_join("tags", ", ")), "."),
        _glued("Indicator summary: ", F.when(counts != "", counts).otherwise("No indicators"), "."),
        _said("References: ", _text(F.array_join(F.slice("references", 1, 5), " "))),
    )
    id_ = _glued("otx_", pulse, "_", sha8(F.concat(pulse, name, _text("created", "None"))))
    return _document(top, "otx", id_, name, content, _glued("https://otx.alienvault.com/pulse/", pulse), F.lit("ioc"), F.col("created"), F.struct(pulse.alias("pulse_id"), "tags", F.size(types).alias("indicator_count")))


DOCUMENT = "ord long, id string, title string, content string, url string, source string, source_category_hint string, published_at string, collected_at string, metadata string"


def corpus(spark: SparkSession, path: str) -> DataFrame:
    """All corpus lines under a path; blank and malformed ones are left out."""
    return spark.read.schema(DOCUMENT).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").json(path)


def gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold lines with an id."""
    return spark.read.schema("id string, labels array<string>").json(path).where("id IS NOT NULL")


def meta_with_text(spark: SparkSession, root: str, n: int = 200) -> DataFrame:
    """Reference metadata joined to the clean text beside it, by key."""
    key = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:meta|clean)/(.*)\.(?:json|txt)$", 1)
    meta = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root).select(key.alias("key"), F.col("value").alias("meta"))
    clean = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root).select(key.alias("key"), F.col("value").alias("content"))
    return meta.join(clean.where("trim(content) <> ''"), "key").orderBy("key").limit(n)


def latest(spark: SparkSession, path: str, pattern: str = "*") -> str | None:
    """Path of the newest file; of equal times the greatest name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "modificationTime")
    return files.agg(F.max(F.struct("modificationTime", "path")).alias("m")).first()["m"]["path"] if files.take(1) else None


def latest_name(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> str | None:
    """Path of the file of greatest name, whenever it was written."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path")
    return files.agg(F.max_by("path", F.struct(F.element_at(F.split("path", "/"), -1), "path"))).first()[0]


def file_summary(spark: SparkSession, path: str) -> DataFrame:
    """Files by source and kind, from names like source_kind_stamp.json."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return files.groupBy(F.split_part(name, F.lit("_"), F.lit(1)).alias("source"), F.split_part(name, F.lit("_"), F.lit(2)).alias("kind")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def selected(builders: dict[str, Callable[[], DataFrame]], names: list[str]) -> DataFrame | None:
    """Union of the named feeds; unknown names are left out."""
    found = [builders[n]() for n in names if n in builders]
    out = found[0] if found else None
    for df in found[1:]:
        out = out.unionByName(df)
    return out
