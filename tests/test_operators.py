"""Operators of the engine on small cases of their own: spans, sentences, HTML, URLs, sinks, streams."""

import hashlib
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazeline.functions import lexicon as lex
from hazeline.operators import alerts, corpus, entities, evaluation, graph, labeling, relations, risk, sampling, texts, urls
from hazeline.sources import feeds, sinks, vulnerabilities


@pytest.mark.parametrize(
    "text, want",
    [
        ("10.0.0.256", ("ipv4", "10.0.0.25", 0, 9)),
        ("1.2.3.4.5", ("ipv4", "2.3.4.5", 2, 9)),
        ("1.2.3.45.6", ("ipv4", "1.2.3.4", 0, 7)),
        ("12:34:56", ("ipv6", "12:34:56", 0, 8)),
        ("https://c.com/z\n", ("url", "https://c.com/z\n", 0, 16)),
        ("CVSS:3.1/AV:N/AC:L", ("cvss_score", "3.1", 0, 8)),
        ("😀 cve-2024-12345678", ("cve_id", "cve-2024-1234567", 2, 18)),
    ],
)
def test_span_vectors(text, want):
    assert want in [s[1:] for s in entities.spans_of(text)]


def test_span_exclusions():
    assert entities.spans_of("version 1.2.3.4") == []
    h = "a" * 32
    assert not [s for s in entities.spans_of(f"https://x.io/{h}") if s[1] == "md5"]
    assert [s for s in entities.spans_of(f"hash {h}") if s[1] == "md5"]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="CVE-2024 1.0:/hx@.com😀\n", max_size=80))
def test_spans_point_at_their_values(text):
    for _, kind, value, a, b in entities.spans_of(text):
        if kind != "cvss_score":
            assert text[a:b] == value


def documents(spark, *rows):
    return spark.createDataFrame([(i, f"d{i}", t, c, s, None, None, None, "{}") for i, (t, c, s) in enumerate(rows)], "ord long, id string, title string, content string, source string, source_category_hint string, published_at string, collected_at string, metadata string")


def test_first_entity_of_equal_values_stays(spark):
    rows = entities.spans(documents(spark, (None, "CVE-2024-1111 then cve-2024-1111 and 1.2.3.4", None))).orderBy("place").collect()
    assert [(r.type, r.value, r.start_pos) for r in rows] == [("cve_id", "CVE-2024-1111", 0), ("ipv4", "1.2.3.4", 37)]


def test_labels_of_null_texts_and_sources(spark):
    docs = documents(spark, (None, None, None), (None, None, "otx"), ("LockBit", None, "ransomwatch"), ("APT29", "espionage campaign CVE-2024-12345", "x"))
    got = {(r.id, r.label): r.confidence for r in labeling.long_labels(docs).collect()}
    assert got == {("d2", "ransomware"): 0.6667, ("d3", "vulnerability"): 0.3333, ("d3", "threat_actor"): 0.6667}


def test_confidences_are_legal(spark, sf):
    from hazeline.plans.corpus import unique_docs

    legal = {c: {round(v / n, 4) for v in range(1, n + 1)} for c, n in lex.CATEGORIES.items()}
    for r in labeling.long_labels(unique_docs(spark, sf)).select("label", "confidence").distinct().collect():
        assert r.confidence in legal[r.label] and r.confidence >= 0.3


def test_risk_score_is_bounded_and_quiet_documents_are_low(spark):
    docs = documents(spark, ("x", "nothing here", None), ("Known exploited", "PoC in the wild. Critical vulnerability. CVSS 9.9 CVE-2024-11111 ransomware ransom note LockBit 1.1.1.1", "x"))
    a, b = risk.assess(entities.summarised(labeling.confidences(docs))).orderBy("ord").collect()
    assert (a.risk_score, a.risk_tier, a.contributing_factors) == (0.0, "low", ["No high-impact signals detected"])
    assert b.risk_tier == "critical" and 0.8 < b.risk_score <= 1


def sentence(text, a, b):
    low = max((text.rfind(c, 0, a) for c in ".!?\n"), default=-1) + 1
    ends = [i for i in range(b, len(text)) if text[i] in ".!?\n"]
    return low, (ends[0] + 1 if ends else len(text))


def test_sentence_edges_equal_a_scan(spark):
    import random

    rng = random.Random(1)
    cases = []
    for _ in range(200):
        t = "".join(rng.choice("ab .!?\n😀") for _ in range(30))
        a = rng.randrange(30)
        cases.append((t, a, rng.randrange(a, 31)))
    df = spark.createDataFrame(cases, "t string, a int, b int")
    rows = df.select("t", "a", "b", relations.left_edge(F.col("t"), F.col("a")).alias("l"), relations.right_edge(F.col("t"), F.col("b")).alias("r")).collect()
    for r in rows:
        assert (r.l, r.r) == sentence(r.t, r.a, r.b)


def test_relations_of_each_kind(spark):
    docs = documents(
        spark,
        (None, "LockBit exploits CVE-2023-12345 in Microsoft gear.", None),
        (None, "Mandiant saw Cisco deployed Emotet here.", None),
        (None, "Emotet drops TrickBot today.", None),
        (None, "Oracle launched a campaign against Cisco.", None),
    )
    found = relations.relations(docs, entities.merged(docs)).collect()
    kinds = {(r.id, r.type, r.source.lower(), r.target.lower(), r.confidence) for r in found}
    assert ("d0", "exploits", "lockbit", "cve-2023-12345", 0.9) in kinds
    assert ("d1", "uses", "cisco", "emotet", 0.85) in kinds
    assert ("d2", "drops", "emotet", "trickbot", 0.9) in kinds
    assert ("d3", "targets", "oracle", "cisco", 0.85) in kinds
    assert len({(r.id, r.type, r.source, r.target) for r in found}) == len(found)


def test_canonical_keeps_the_best_at_the_first_place(spark):
    rows = spark.createDataFrame([("d", "malware", "ALPHV", 3, 0.5), ("d", "malware", "blackcat", 7, 0.9), ("d", "malware", "noberus", 9, 0.9)], "id string, type string, value string, place long, score double")
    (r,) = entities.canonical_once(entities.canonical(rows)).collect()
    assert (r.value, r.canonical_value, r.place) == ("blackcat", "BlackCat", 3)


def test_names_overlapping_rules_go(spark):
    docs = documents(spark, (None, "see cisco.com and Cisco Systems", None))
    assert {(r.type, r.value) for r in entities.merged(docs).collect()} == {("domain", "cisco.com"), ("organization", "Cisco Systems")}


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTPS://Example.COM/a/?utm_source=x&b=2&a=1&a=3#frag", "https://example.com/a?a=1,3&b=2"),
        ("https://x.com", "https://x.com/"),
        ("https://x.com/", "https://x.com/"),
        ("https://x.com/p?q=&r=a%20b", "https://x.com/p?r=a b"),
    ],
)
def test_url_normal_forms(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(urls.normalize(F.col("u"))).first()[0] == want


@pytest.mark.parametrize(
    "url, want",
    [
        ("", "unknown"), (None, "unknown"), ("noscheme", "unknown"), ("https://github.com/a/b/pull/3", "github_issue"), ("https://github.com/a/b", "github_repo"),
        ("https://gist.github.com/x", "code"), ("https://www.cisa.gov/x", "government"), ("https://seclists.org/x", "mailing_list"), ("https://x.io/advisories/1", "vendor_advisory"),
        ("https://x.io/diff", "patch"), ("https://news.io/a", "article"), ("ftp://news.io/a", "article"), ("https://vimeo.com/1", "media"), ("https://www.oracle.com/x", "vendor_advisory"),
    ],
)
def test_url_classes(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(urls.classify(F.col("u"))).first()[0] == want


def test_references_of_both_shapes(spark):
    rows = spark.createDataFrame([("a", '{"reference_data":[{"url":"u1"},{"url":"u2"}]}'), ("b", '[{"url":"u3","tags":["Patch"]}]'), ("c", "[]"), ("d", None)], "cve_id string, refs string")
    assert sorted((r.cve_id, r.url) for r in urls.references(rows).collect()) == [("a", "u1"), ("a", "u2"), ("b", "u3")]


def test_content_types(spark):
    rows = spark.createDataFrame([(None, b"%PDF-1"), (None, b'{"a":1}'), (None, b"<p>"), ("text/plain; charset=ISO-8859-1", b"x"), (None, b"\x00")], "h string, b binary")
    got = rows.select(urls.sniff(F.col("h"), F.col("b")).alias("m"), urls.charset(F.col("h")).alias("c")).collect()
    assert [r.m for r in got] == ["application/pdf", "application/json", "text/html", "text/plain", "application/octet-stream"]
    assert got[3].c == "iso-8859-1" and got[0].c == "utf-8"


def test_dom_text():
    page = "<html><head><style>x</style></head><body><nav>menu</nav><main><h1>T</h1><ul><li>a</li><li>b</li></ul><ol><li>c</li></ol><table><tr><th>h</th><td>d</td></tr></table><p>end</p></main><footer>f</footer></body></html>"
    text = texts.dom_text(page)
    assert "- a" in text and "1. c" in text and "h | d" in text and "end" in text and "menu" not in text and not text.startswith("f")
    assert texts.dom_text("") == "" == texts.dom_text(None)


def test_quality_cases(spark):
    rows = [("",), ("short",), ("First sentence about CVE-2024-1234 here. Second with version 2.3.1 inside. Third one ends now.",), ("import os\ndef f():\nreturn 1\nclass A:\nfor x in y:\nif x: pass while",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(texts.quality(F.col("t")).alias("q")).select("q.*").collect()
    assert [r.label for r in got] == ["empty", "empty", "good", "code_only", "empty"]
    assert got[2].has_cve_mention and got[2].has_version_mention and got[2].sentence_count == 3


def test_cleaning_deletes_inside_words(spark):
    df = spark.createDataFrame([("the homepage  was\n\n\n\nfine",), (None,)], "t string")
    assert [r[0] for r in df.select(texts.clean(F.col("t"))).collect()] == ["the" + "page was\n\nfine", ""]


def test_chunks():
    text = "\n".join("line %d is here." % i for i in range(100))
    parts = texts.cut_chunks(text, 200)
    assert len(parts) > 5 and all(len(p.encode()) <= 200 for p in parts) and re.sub(r"\s", "", "".join(parts)) == re.sub(r"\s", "", text)
    assert texts.cut_chunks("small", 100) == ["small"] and texts.cut_chunks("  ", 100) == []


def test_github_fields(spark):
    page = '<h1>Bad bug</h1><span class="State State--open">Open</span><a class="IssueLabel x">bug</a><td class="comment-body p"><p>Hello</p></td>'
    r = spark.createDataFrame([(page,)], "h string").select(texts.github_issue(F.col("h")).alias("x")).first()["x"]
    assert (r.title, r.body, r.labels, r.state) == ("Bad bug", "Hello", ["bug"], "open")
    page = '<h1>GHSA</h1><span>High severity</span><td class="package">log4j</td> CVSS score 9.8 <a href="https://x.io/a">l</a>'
    r = spark.createDataFrame([(page,)], "h string").select(texts.github_advisory(F.col("h")).alias("x")).first()["x"]
    assert (r.title, r.severity, r.affected_packages, r.cvss_score, r.links) == ("GHSA", "high", ["log4j"], 9.8, ["https://x.io/a"])


def test_evaluation_edges(spark):
    g = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("9", "z")], "id string, label string")
    p = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None), ("8", "q")], "id string, label string")
    m = {r.label: (r.tp, r.fp, r.fn, r.f1) for r in evaluation.per_label(g, p).collect()}
    assert m == {"a": (1, 0, 1, 0.67), "b": (0, 1, 1, 0.0), "z": (0, 0, 0, 0.0), "q": (0, 0, 0, 0.0)}
    assert [r.id for r in evaluation.unmatched(g, p).collect()] == ["9"]
    assert evaluation.overall(evaluation.per_label(g, p)).first().passed is False
    assert evaluation.per_label(g.limit(0), p.limit(0)).count() == 0


def test_alert_rule_of_metadata(spark):
    docs = documents(spark, ("t", "x", "cisa_kev")).withColumn("metadata", F.lit('{"cvss":{"score":8.1}}'))
    rows = risk.assess(entities.summarised(labeling.confidences(docs)))
    assert [r.rule_id for r in alerts.alerts(rows).collect()] == ["cisa_kev_high_cvss"]


def test_graph_keeps_the_rules_of_the_sample(spark):
    docs = spark.createDataFrame([("d1", 1, 0.9), ("d2", 2, 0.9)], "id string, ord long, risk_score double")
    ents = [("d1", 1, "malware", "Emotet", None), ("d1", 2, "malware", "emotet", None), ("d1", 3, "url", "http://x", None), ("d1", 4, "cve_id", "CVE-1", ""), ("d2", 1, "malware", "Emotet", None), ("d2", 2, "cve_id", "x", " CVE-1 ")]
    rels = [("d1", 1, "uses", "A", "B"), ("d1", 2, "drops", "B", "A"), ("d1", 3, "uses", "B", "A"), ("d1", 4, "uses", "C", "C"), ("d1", 5, "uses", "", "D")]
    e = spark.createDataFrame(ents, "id string, place int, type string, value string, canonical_value string")
    r = spark.createDataFrame(rels, "id string, place int, type string, source string, target string")
    tried = graph.attempts(docs, e, r)
    got = [tuple(x)[1:] for x in graph.edges(tried).orderBy("rank").collect()]
    assert got == [
        ("mention:A", "mention:B", "uses", "d1"), ("mention:B", "mention:A", "drops", "d1"), ("malware:Emotet", "malware:emotet", "co_occurs", "d1"),
        ("malware:Emotet", "cve_id:CVE-1", "co_occurs", "d1"), ("malware:emotet", "cve_id:CVE-1", "co_occurs", "d1"),
    ]
    names = [(x.id, x.type) for x in graph.nodes(tried).orderBy("place").collect()]
    assert names == [("mention:A", "relation_endpoint"), ("mention:B", "relation_endpoint"), ("mention:C", "relation_endpoint"), ("malware:Emotet", "malware"), ("malware:emotet", "malware"), ("cve_id:CVE-1", "cve_id")]
    few = graph.attempts(docs, e, r, most_edges=2)
    assert graph.edges(few).count() == 2 and graph.nodes(few).count() == 2 and graph.nodes(tried, 4).count() == 4
    assert graph.is_truncated(few, most_edges=2).first()[0] and not graph.is_truncated(tried).first()[0]
    assert graph.circle(graph.nodes(few)).count() == 2


def test_feed_documents_are_those_of_the_sources(spark):
    """Ids, titles and texts written out by hand."""
    h = lambda x: hashlib.sha256(x.encode()).hexdigest()[:8]
    kev = [
        (1, "CVE-2021-1", "Acme", "Box", "Acme Box flaw", "2024-01-01", "A flaw.", "Patch it", "2024-02-01", "Known", "See a"),
        (2, "CVE-2021-2", None, "Lid", "Lid flaw", "2024-03-01", "", "", "", "Unknown", ""),
        (3, "CVE-2021-3", "B", "C", "n", "2024-03-01", None, None, None, None, None),
    ]
    rows = spark.createDataFrame(kev, "ord long, cveID string, vendorProject string, product string, vulnerabilityName string, dateAdded string, shortDescription string, requiredAction string, dueDate string, knownRansomwareCampaignUse string, notes string")
    got = feeds.kev(rows).orderBy("ord").collect()
    assert [r.title for r in got] == ["CISA KEV: CVE-2021-2 - Unknown Lid", "CISA KEV: CVE-2021-3 - B C", "CISA KEV: CVE-2021-1 - Acme Box"]
    assert got[2].id == "cisa_kev_CVE-2021-1_" + h("cisa_kev_CVE-2021-1") and got[2].source_category_hint == "ransomware" and got[0].source_category_hint == "vulnerability"
    assert got[2].content == "CISA Known Exploited Vulnerability: CVE-2021-1 - Acme Box flaw. Vendor: Acme. Product: Box. A flaw. Required action: Patch it. Remediation due date: 2024-02-01. Known ransomware campaign use: Known. Notes: See a"
    assert got[0].content == "CISA Known Exploited Vulnerability: CVE-2021-2 - Lid flaw. Vendor: Unknown. Product: Lid."
    edb = spark.createDataFrame([(1, "7", "old", "", "", "", "2020-01-01", ""), (2, "9", " " + "x" * 130, "linux", "local", "me", "2021-01-01", "80"), (3, "10", "", "", "", "", "", "")], "ord long, id string, description string, platform string, type string, author string, date_published string, port string")
    got = {r.ord: r for r in feeds.exploitdb(edb, 2).collect()}
    assert set(got) == {2, 3} and got[2].id == "exploitdb_9_" + h("9" + "x" * 130 + "2021-01-01") and got[2].title == "Exploit: " + "x" * 120 + "..."
    assert got[2].content == "x" * 130 + " Platform: linux. Type: local. Author: me. Published: 2021-01-01. Port: 80. ExploitDB URL: https://www.exploit-db.com/exploits/9"
    assert (got[3].title, got[3].content, got[3].published_at) == ("Exploit: 10", "ExploitDB URL: https://www.exploit-db.com/exploits/10", None)


def test_threatfox_counts_and_lists_indicators(spark):
    payload = {"5": [{"ioc_value": "a.example", "ioc_type": "domain", "threat_type": "botnet_cc", "malware": "win.x", "malware_printable": "X Bot", "first_seen_utc": "2024-02-02", "confidence_level": 75, "tags": "b,a", "reference": "r2"}], "6": [{"ioc_value": "1.2.3.4:80", "ioc_type": "ip:port", "malware_printable": "X Bot", "first_seen_utc": "2024-01-02", "confidence_level": 50, "tags": None}], "7": [{"ioc_value": "f", "ioc_type": "sha256_hash", "malware": "win.y"}]}
    got = feeds.threatfox(feeds.threatfox_rows(spark.createDataFrame([(json.dumps(payload),)], "payload string"))).orderBy("ord").collect()
    assert [r.title for r in got] == ["ThreatFox IOCs: X Bot", "ThreatFox IOCs: win.y"]
    assert got[0].content == "Threat intelligence: X Bot (botnet_cc). IOC indicators: 1 domains, 1 IPs. Malicious domains: a.example. Command and control IPs: 1.2.3.4:80. Tags: a, b. Confidence level: 62. References: r2."
    assert got[0].id == "threatfox_x_bot_" + hashlib.sha256(b"threatfox_X Bot_2024-01-02").hexdigest()[:8] and got[1].content == "Threat intelligence: win.y (unknown). Confidence level: 0."


def test_prelabels_by_hand(spark):
    docs = documents(
        spark,
        ("A", "CVE-2021-12345 has a PoC and a payload; patchwork CVSS", None),  # .4 + .2; .3
        (None, "LockBitter ransomware by fin7 and LAZARUS", None),  # .15 * 2 + .2; .4 + .2
        (None, "quiet", None),
    )
    got = {r.id: (r.labels, r.confidence, r.needs_review) for r in sampling.prelabels(docs).collect()}
    assert got == {"d0": ("vulnerability|exploit", 0.45, False), "d1": ("ransomware|threat_actor", 0.55, False), "d2": ("", 0.0, True)}


def test_labels_of_cve_records(spark):
    rows = [
        ("a", "CVE-2024-1234", "A buffer overflow in it. CWE-79", ["Patch", "Exploit"], 9.8, "CRITICAL", 3.9),  # .3 + .16 + .1 + .1 + .1; .2 + .15 + .1
        ("b", "t", "nothing", [], None, None, None),
        ("c", "t", "LockBit and Hive, by APT29", None, 0.0, "LOW", 1.0),
    ]
    got = {r.id: r.labels for r in sampling.cve_labels(spark.createDataFrame(rows, "id string, title string, content string, ref_tags array<string>, score double, severity string, exploitability double")).collect()}
    assert got == {"a": "vulnerability=0.76|exploit=0.45", "b": "", "c": "ransomware=0.50|threat_actor=0.40"}


def test_the_last_gold_line_counts(spark):
    lines = spark.createDataFrame([(1, "a", ["x"]), (2, "a", ["y"]), (1, "b", []), (3, None, ["x"])], "ord long, id string, labels array<string>")
    assert sorted(tuple(r) for r in evaluation.last_lines(lines).collect()) == [("a", "y"), ("b", None)]


def test_union_keeps_old_rows(spark):
    old = spark.createDataFrame([(5, "a", "old")], "ord long, id string, v string")
    new = spark.createDataFrame([(1, "a", "new"), (2, "b", "new"), (3, None, "x"), (4, "", "x")], "ord long, id string, v string")
    assert {(r.id, r.v) for r in corpus.union_trim(old, new, 10).collect()} == {("a", "old"), ("b", "new")}


def test_sinks_and_sources_round_trip(spark, tmp_path):
    docs = documents(spark, ("t", "x", "s1"), ("u", "y", "s2")).withColumn("url", F.lit("")).withColumn("date", F.lit("2024-01-01"))
    assert sinks.write_lines(docs, str(tmp_path / "out")) and not sinks.write_lines(docs.limit(0), str(tmp_path / "none"))
    lines = tmp_path / "corpus"
    lines.mkdir()
    (lines / "a.jsonl").write_text('{"id":"1","title":"a"}\n\nnot json\n{"id":"2"}\n')
    assert sorted(r.id for r in feeds.corpus(spark, str(lines)).collect()) == ["1", "2"]
    value = json.loads(sinks.wrapped(docs.select("id"), "nvd", "cve", "now").first()[0])
    assert value["record_count"] == 2 and len(value["records"]) == 2
    name = spark.createDataFrame([("a b/c" + "x" * 60,)], "n string").select(sinks.safe_name(F.col("n"))).first()[0]
    assert name.startswith("a_b_c") and len(name) == 50


def test_meta_joins_clean_text(spark, tmp_path):
    for folder, name, text in (("meta", "a/1.json", "{}"), ("clean", "a/1.txt", "hello"), ("meta", "a/2.json", "{}"), ("clean", "a/2.txt", "  ")):
        path = tmp_path / folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    assert [(r.key, r.content) for r in feeds.meta_with_text(spark, str(tmp_path)).collect()] == [("a/1", "hello")]
    assert feeds.latest(spark, str(tmp_path), "*.txt").endswith(".txt")


def page_of_records(start, size):
    return [json.dumps({"id": f"CVE-{i}"}) for i in range(start, start + size)]


def test_paged_source_has_a_partition_a_page(spark):
    import sys
    import types

    spark.dataSource.register(vulnerabilities.Paged)
    sys.modules.setdefault("paging_case", types.ModuleType("paging_case")).page_of_records = page_of_records
    reader = vulnerabilities._PagedReader(5, 2, "paging_case.page_of_records")
    parts = reader.partitions()
    assert [(p.start, p.size) for p in parts] == [(0, 2), (2, 2), (4, 1)]
    assert [r for p in parts for r in reader.read(p)][4] == (4, '{"id": "CVE-4"}')


def test_streaming_equals_batch(spark, tmp_path):
    from hazeline.streaming import corpus_stream

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("\n".join(json.dumps({"ord": i, "id": f"d{i}", "title": "t", "content": "PoC in the wild CVE-2024-12345" if i % 2 else "calm", "source": "x", "collected_at": "2024-05-01T00:00:00Z"}) for i in range(10)))
    q = corpus_stream.start(corpus_stream.arriving(spark, str(src)), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = {r.id: r.risk_tier for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.id: r.risk_tier for r in corpus_stream.enriched(feeds.corpus(spark, str(src))).collect()}
    assert got == want and set(want.values()) == {"critical", "low"}


def test_plans_have_no_cartesian_product_and_prune_columns(spark, sf):
    from hazeline.plans import registry

    for name in ("relations_all", "ner_interval_antijoin", "near_pairs", "risk_by_source", "trend_day"):
        plan = registry.queries()[name](spark, sf)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan, name
    plan = registry.queries()["text_quality"](spark, sf)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["source", "risk_tier", "documents"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_substring_labels_have_all_signals(spark):
    from hazeline.operators import sampling

    ips = " ".join(f"10.0.0.{i}" for i in range(10))
    cases = [  # content, source, hint; primary label, labels, confidence: by hand from label_document
        ("see CVE-2024-12345", "", "", "vulnerability", "vulnerability", 0.35),
        ("APT99", "", "", "threat_actor", "threat_actor", 0.5),
        ("lockbit, akira", "", "", "ransomware", "ransomware", 0.4),
        ("turla and sandworm", "", "", "threat_actor", "threat_actor", 0.4),
        (ips, "", "", "ioc", "ioc", 0.4),
        (" ".join(c * 32 for c in "abc"), "", "", "ioc", "ioc", 0.3),
        ("exploit-db", "", "", "exploit", "exploit", 0.37),
        ("nothing", "otx", "", "ioc", "ioc", 0.3),
        ("nothing", "cisa_kev", "vulnerability", "vulnerability", "vulnerability", 0.2),
        ("nothing", "phishtank", "phishing", "phishing", "phishing", 0.6),
        ("lockbit, akira; turla, sandworm", "", "", "ransomware", "ransomware|threat_actor", 0.4),
        (None, None, None, "unknown", "unknown", 0.0),
    ]
    docs = spark.createDataFrame([(i, str(i), "", *c[:3]) for i, c in enumerate(cases)], "ord int, id string, title string, content string, source string, source_category_hint string")
    got = [(r.primary_label, r.labels, r.confidence) for r in sampling.substring_labels(docs).orderBy("ord").collect()]
    assert got == [c[3:] for c in cases]


def _odd_texts(n=400):
    import random

    rng = random.Random(3)
    bits = [*labeling.WHOLE[::4], "Ransom Note", "ransomware", "ransom", "malicious ip", "malicious  url", "APT29", "C2", "encrypted", "éransom", "ransomé", "İlure", "_poc", "v 1.2.3.4", "1.2.3.4", "://a.com", "a@b.com", "CVSS: 9.8", "score 7.5", "8.1/10", "a" * 32, "https://x.io/" + "b" * 40, "CVE-2024-12345", "critical", "severity", "zero-day"]
    return ["".join(rng.choice(bits) + rng.choice(["", " ", " ", "\n", "."]) for _ in range(rng.randrange(12))) for _ in range(n)]


def test_labels_found_in_one_pass_are_those_of_their_patterns(spark):
    from hazeline.functions import gates
    from hazeline.functions import patterns as pat

    words = labeling.WHOLE
    df = spark.createDataFrame([(t,) for t in _odd_texts()], "t string").withColumn("found", gates.whole(F.col("t"), words))
    each = {f"w{i}": (gates.stands(F.col("found"), w, words), F.col("t").rlike(pat.any_of([w]))) for i, w in enumerate(words)}
    each["any"] = gates.any_stands(F.col("found"), lex.FAMILIES, words), F.col("t").rlike(pat.any_of(lex.FAMILIES))
    (r,) = df.agg(*[F.count_if(a != b).alias(k) for k, (a, b) in each.items()], F.count_if(each["any"][0]).alias("some")).collect()
    assert not any(r[k] for k in each) and r["some"] > 0


def test_risk_patterns_run_only_where_their_gates_open(spark):
    """Of the patterns of a quiet text none but those without a gate is looked for."""
    rows = risk.assess(entities.summarised(labeling.confidences(documents(spark, ("x", "quiet", None)))))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert not re.findall(r"(?<!AND )RLIKE\([a-z_]+#\d+, [^)]*(?:CVE-|poc|in the wild|critical)", plan)


def test_rows_are_told_apart_before_their_texts_are_made(spark, sf):
    from hazeline.plans.corpus import docs, unique_docs

    plan = unique_docs(spark, sf).select("id", "content")._jdf.queryExecution().executedPlan().toString()
    assert "LockBit" not in plan[plan.index("Exchange") :]
    assert sorted(unique_docs(spark, sf).collect(), key=lambda r: r.ord) == sorted(corpus.keep_first(docs(spark, sf)).collect(), key=lambda r: r.ord)


def test_substring_labels_look_for_each_word_once(spark):
    plan = sampling.substring_labels(documents(spark, (None, "x", None)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(", privilege escalation)") == 1 and plan.count("lower(") <= 3


def test_rollups_pages_and_shares_go_through_the_corpus_once(spark, sf):
    from hazeline.plans import registry

    for name in ("entity_rollup", "entity_page", "tier_shares"):
        plan = registry.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1, name


def test_pages_of_a_rollup_are_clamped(spark):
    rolled = spark.createDataFrame([("cve_id", f"CVE-{i}", 5 - i // 2) for i in range(5)], "type string, name string, mentions long")
    page = lambda **k: [r.name for r in corpus.entity_page(rolled, "cve", size=2, **k).collect()]
    assert [page(page=p) for p in (0, 1, 2, 3, 9)] == [["CVE-0", "CVE-1"], ["CVE-0", "CVE-1"], ["CVE-2", "CVE-3"], ["CVE-4"], ["CVE-4"]]
    assert page(page=1, by="name", descending=False) == ["CVE-0", "CVE-1"] and corpus.entity_page(rolled, "none", size=2, page=3).count() == 0


def test_islands_in_a_row_are_those_of_the_windows(spark):
    import random

    rng = random.Random(4)
    text, rows = "abcdefghij" * 4, []
    for _ in range(300):
        a = rng.randrange(36)
        rows.append((0, f"d{rng.randrange(40)}", rng.choice("xy"), a, a + rng.randrange(1, 4), rng.randrange(9) / 10))
    df = spark.createDataFrame(rows, "ord int, id string, type string, start_pos int, end_pos int, score double")
    want = {(r.id, r.type, r.start_pos, r.end_pos, r.score, text[r.start_pos : r.end_pos]) for r in entities.islands(df).collect()}
    got = set()
    for d in {r[1] for r in rows}:
        own = [dict(type=r[2], start_pos=r[3], end_pos=r[4], score=r[5], value="") for r in rows if r[1] == d]
        got |= {(d, e["type"], e["start_pos"], e["end_pos"], e["score"], e["value"]) for e in entities.joined_names(text, own)}
    assert got == want
    assert "Join" not in entities.ner(documents(spark, (None, "Emotet", None)))._jdf.queryExecution().optimizedPlan().toString()


def test_spans_open_every_gate_that_a_match_needs():
    for t in _odd_texts() + ["CVſS: 9.8 é", "x.İO é.io", "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H"]:
        for rx, may in zip([*entities._SIMPLE, *entities._CVSS], entities._may_hold(t)):
            assert may or not rx.search(t), (rx.pattern, t)
        assert {(e["type"], e["start_pos"], e["end_pos"]) for e in entities.names_of(t)} == {(k, *m.span()) for k, rx, _ in entities._NAMES for m in rx.finditer(t)}


def test_merged_entities_find_spans_and_names_in_one_pass(spark):
    docs = documents(spark, (None, "see cisco.com, Cisco and LockBit at 1.2.3.4; lockbit again. MSFT, Microsoft", None), ("x", None, None))
    plan = entities.merged(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_spans(") == 1 and plan.count("gazetteer(") == 1 and "Join" not in plan
    rules = entities.spans(docs)
    apart = {(r.type, r.value, r.start_pos) for r in rules.collect()} | {(r.type, r.value, r.start_pos) for r in entities.without_overlap(entities.ner(docs), rules).collect()}
    got = {(r.type, r.value, r.start_pos) for r in entities.merged(docs).collect()}
    assert got <= apart and {x[1] for x in apart - got} <= {"lockbit", "Microsoft", "MSFT", "LockBit"}
