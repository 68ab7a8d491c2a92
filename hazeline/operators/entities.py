"""Entity extraction, canonical names and gazetteer NER.

Values alone come from built-in regular expressions. Spans need code-point offsets, which
the built-in functions do not give, so one Arrow function returns all spans of a document
as an array; everything behind it is relational again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions import gates
from hazeline.functions import lexicon as lex
from hazeline.functions import patterns as pat

def _array(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(k, t) for k, t in fields.items()]))


_PLACE = {"type": T.StringType(), "value": T.StringType(), "start_pos": T.IntegerType(), "end_pos": T.IntegerType()}
SPAN = _array(extractor=T.IntegerType(), **_PLACE)
NAME = _array(**_PLACE, score=T.DoubleType())
_ARROW = {T.StringType(): pa.string(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64()}


def _arrow(of: T.ArrayType) -> pa.DataType:
    return pa.list_(pa.struct([(f.name, _ARROW[f.dataType]) for f in of.elementType.fields]))


NER_THRESHOLD, NER_CHARS, NER_LEAST = 0.70, 7500 * 4, 4
NOISE = frozenset(
    (
        "also and are been but can cloud could customer entities exploit expl find for from had has have industries into its malware may might ment ness not open org oit ous over "
        "product products shall should some system that the their this tion tools triage versions victims was ware were what when where which will with would xml xml. account ing ity ble com net organizations"
    ).split()
) | {"associated malware", "cloud services", "government entities", "government sectors", "remote access tools"} | set(".,-;:()[]{}/\\|_=+*#@!?'\"") | {"]("}

_SIMPLE = [re.compile(p) for p in (pat.CVE_ENTITY, pat.IPV4, pat.IPV6, pat.DOMAIN, pat.URL, pat.MD5, pat.SHA1, pat.SHA256, pat.EMAIL)]
_TYPES = ("cve_id", "ipv4", "ipv6", "domain", "url", "md5", "sha1", "sha256", "email", "cvss_score")
_CVSS = [re.compile(pat.CVSS_VALUE), re.compile(pat.CVSS_VECTOR), *(re.compile(p) for p in pat.CVSS_OTHER)]
_VERSION = re.compile(pat.VERSION_BEFORE)


_NUMBER, _HEX, _TLD = re.compile(r"[0-9][.][0-9]"), re.compile(pat.HEX), re.compile(rf"(?i)[.](?:{pat.TLDS})\b")


def _may_hold(text: str) -> tuple:
    """Of each pattern, those of CVSS last, whether the text holds what its matches do; all beyond ASCII, where letters have more cases."""
    if not text.isascii():
        return (True,) * (len(_SIMPLE) + len(_CVSS))
    low, run = text.lower(), _HEX.search(text)
    return "cve-" in low, _NUMBER.search(text), text.count(":") > 1, _TLD.search(text), "://" in text, run, run, run, "@" in text, "cvss" in low, "CVSS:3" in text, "severity" in low, "score" in low, "/" in text


def spans_of(text: str) -> list[tuple[int, str, str, int, int]]:
    """All raw matches of a text, extractor by extractor: (extractor, type, value, start, end)."""
    out, may = [], _may_hold(text)
    for k, (kind, rx) in enumerate(zip(_TYPES, _SIMPLE)):
        for m in rx.finditer(text) if may[k] else ():
            a, b, value = m.start(), m.end(), m.group()
            if kind == "ipv4" and _VERSION.search(text[max(0, a - 20) : a]):
                continue
            if kind == "domain" and "://" in text[max(0, a - 10) : a]:
                continue
            if kind in ("md5", "sha1", "sha256") and "://" in text[max(0, a - 100) : b]:
                continue
            if kind == "url":
                value = value.rstrip(" \"')]}|")
                b = a + len(value)
            out.append((k, kind, value, a, b))
    known = set()
    for i, rx in enumerate(_CVSS):
        for m in rx.finditer(text) if may[len(_SIMPLE) + i] else ():
            value = m.group() if i == 1 else m.group(1)
            if i != 1:
                if value in known:
                    continue
                known.add(value)
            out.append((9, "cvss_score", value, m.start(), m.end()))
    return out


@F.arrow_udf(SPAN)
def _spans(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    names = ("extractor", "type", "value", "start_pos", "end_pos")
    for batch in texts:
        yield pa.array([[dict(zip(names, s)) for s in spans_of(t or "")] for t in batch.to_pylist()], _arrow(SPAN))


def spans(docs: DataFrame) -> DataFrame:
    """ord, id, place, type, value, start_pos, end_pos, method: one row for each entity.

    Of equal (type, lower-cased value) the first by extractor and match stays; place is
    the entity's rank by start.
    """
    rows = docs.select("ord", "id", F.posexplode(_spans("content")).alias("found", "e")).select("ord", "id", "found", "e.*")
    same = Window.partitionBy("id", "ord", "type", F.lower("value")).orderBy("found")
    kept = rows.withColumn("nth", F.row_number().over(same)).where("nth = 1")
    by_start = Window.partitionBy("id", "ord").orderBy("start_pos", "found")
    return kept.withColumn("place", F.row_number().over(by_start)).select("ord", "id", "place", "type", "value", "start_pos", "end_pos", F.lit("rule_based").alias("method"), F.lit(None).cast("double").alias("score"))


def values(text: Column, low: Column) -> dict[str, Column]:
    """Arrays of distinct lower-cased values by type, from built-in functions only; hash rules look back at most 100 characters.

    ``low`` is the lower-cased text: a pattern runs only where its gate is open. What
    stands before a match is looked at last, where the match itself may begin.
    """
    none = F.array().cast("array<string>")
    every = lambda p, g=0: F.regexp_extract_all(text, F.lit(p), F.lit(g))
    once = lambda c: F.array_distinct(F.transform(c, F.lower))
    has = lambda *words: gates.holds(low, list(words))

    def no_url(n: int) -> Column:
        run = rf"[A-Fa-f0-9]{{{n}}}"
        return F.when(text.rlike(rf"\b{run}\b"), once(every(rf"\b(?={run}\b)(?<!://[\s\S]{{0,97}}){run}"))).otherwise(none)

    domain = pat.DOMAIN.replace(r"(?<!/)\b", r"\b(?=[a-z0-9][a-z0-9-]*+[.][a-z0-9])(?<!/)(?<!://[\s\S]{0,7})")
    scores = [(pat.CVSS_VALUE, "cvss"), *zip(pat.CVSS_OTHER, ("severity", "score", "/"))]
    scored = F.concat(*[F.when(has(w), every(p, 1)).otherwise(none) for p, w in scores])
    return {
        "cve_id": F.when(has("cve-"), once(every(pat.CVE_ENTITY))).otherwise(none),
        "ipv4": F.when(text.rlike(r"[0-9][.][0-9]"), once(every(rf"(?=[0-9]{{1,3}}[.])(?<!(?i:version|v)\s{{0,9}}\d{{0,3}}\s{{0,9}}){pat.IPV4}"))).otherwise(none),
        "ipv6": F.when(has(":"), once(every(pat.IPV6))).otherwise(none),
        "domain": once(every(domain)),
        "email": F.when(has("@"), once(every(pat.EMAIL))).otherwise(none),
        "md5": no_url(32),
        "sha1": no_url(40),
        "sha256": no_url(64),
        "cvss_score": F.when(has(*[w for _, w in scores]), once(scored)).otherwise(none),
    }


def _found(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with its text and the lower-cased one, and the columns of values over them."""
    docs = docs.withColumn("_text", F.coalesce("content", F.lit(""))).withColumn("_low", F.lower("_text"))
    return docs, values(F.col("_text"), F.col("_low"))


def summarised(docs: DataFrame) -> DataFrame:
    """``docs`` with distinct values by type, their numbers, and the CVSS scores in [0, 10]."""
    docs, found = _found(docs)
    # numbers come from the unsorted values, so that nothing is sorted where only they are asked for
    rows = docs.withColumns({f"_{k}": c for k, c in found.items()}).drop("_text", "_low")
    scores = F.filter(F.transform("_cvss_score", lambda x: x.try_cast("double")), lambda x: (x >= 0) & (x <= 10))
    rows = rows.withColumns(
        {
            **{f"v_{k}": F.array_sort(f"_{k}") for k in found},
            "cvss": F.array_sort(F.array_distinct(scores)),
            "n_cves": F.size("_cve_id"),
            "n_ips": F.size("_ipv4") + F.size("_ipv6"),
            "n_domains": F.size("_domain"),
            "n_hashes": F.size("_md5") + F.size("_sha1") + F.size("_sha256"),
        }
    )
    return rows.drop(*[f"_{k}" for k in found])


def exploded(rows: DataFrame, *columns: str) -> DataFrame:
    """The values of ``summarised`` rows, type and value, one row for each, beside ``columns``."""

    def typed(kind: str) -> Column:
        return F.transform(f"v_{kind}", lambda v: F.struct(F.lit(kind).alias("type"), v.alias("value")))

    kinds = ("cve_id", "ipv4", "ipv6", "domain", "email", "md5", "sha1", "sha256", "cvss_score")
    return rows.select(*columns, F.explode(F.flatten(F.array(*map(typed, kinds)))).alias("e")).select(*columns, "e.type", "e.value")


def long_values(docs: DataFrame) -> DataFrame:
    """ord, id, type, value: every distinct value of a document, from built-in functions."""
    docs, found = _found(docs)

    def typed(kind: str, c: Column) -> Column:
        return F.transform(c, lambda v: F.struct(F.lit(kind).alias("type"), v.alias("value")))

    pairs = F.flatten(F.array(*[typed(k, c) for k, c in found.items()]))
    return docs.select("ord", "id", F.explode(pairs).alias("e")).select("ord", "id", "e.type", "e.value")


# gazetteer NER

_GAZETTEER = {
    "malware": sorted({*lex.MALWARE, *lex.FAMILIES}, key=lambda w: (-len(w), w)),
    "organization": sorted({*lex.VENDORS, *lex.ACTORS}, key=lambda w: (-len(w), w)),
    "system": sorted(lex.SYSTEMS, key=lambda w: (-len(w), w)),
}
_NAMES = [(kind, re.compile(r"(?i)\b(?:" + "|".join(map(re.escape, names)) + r")\b"), [n.lower() for n in names]) for kind, names in _GAZETTEER.items()]


#: the same over lower-cased ASCII, where a search need not fold cases
_LOW_NAMES = {kind: re.compile(r"\b(?:" + "|".join(map(re.escape, names)) + r")\b") for kind, _, names in _NAMES}


def names_of(text: str) -> list[dict]:
    """Known names, kind by kind; beyond ASCII, where letters have more cases, all kinds are looked for."""
    if text.isascii():
        low = text.lower()
        found = [(k, m) for k, _, names in _NAMES if any(n in low for n in names) for m in _LOW_NAMES[k].finditer(low)]
    else:
        found = [(k, m) for k, rx, _ in _NAMES for m in rx.finditer(text)]
    return [dict(type=k, value=text[m.start() : m.end()], start_pos=m.start(), end_pos=m.end(), score=0.9) for k, m in found]


@F.arrow_udf(NAME)
def gazetteer(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The default backend: known names, all at score 0.9. A model backend returns the same array."""
    for batch in texts:
        yield pa.array([names_of((t or "")[:NER_CHARS]) for t in batch.to_pylist()], _arrow(NAME))


def joined_names(text: str, found: list) -> list[dict]:
    """``islands`` of one document's names, with the text that they cover as value."""
    out = []
    for kind in sorted({e["type"] for e in found}):
        last = None
        for e in sorted((e for e in found if e["type"] == kind), key=lambda e: (e["start_pos"], e["end_pos"])):
            if last is None or e["start_pos"] > last["end_pos"]:
                last = dict(e)
                out.append(last)
            else:
                last["end_pos"], last["score"] = max(last["end_pos"], e["end_pos"]), max(last["score"], e["score"])
    for e in out:
        e["value"] = text[e["start_pos"] : e["end_pos"]]
    return out


@F.arrow_udf(NAME)
def _joined(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, found in batches:
        yield pa.array([joined_names(t or "", e) if e else [] for t, e in zip(texts.to_pylist(), found.to_pylist())], _arrow(NAME))


def islands(found: DataFrame) -> DataFrame:
    """Adjacent or overlapping spans of one type become one, with the best score."""
    side = Window.partitionBy("id", "type").orderBy("start_pos", "end_pos")
    reach = F.max("end_pos").over(side.rowsBetween(Window.unboundedPreceding, -1))
    rows = found.withColumn("island", F.sum(F.coalesce(F.col("start_pos") > reach, F.lit(True)).cast("int")).over(side))
    return rows.groupBy("ord", "id", "type", "island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.max("score").alias("score")).drop("island")


def _trimmed() -> Column:
    return F.rtrim(F.trim("value"), F.lit("."))


def _is_name() -> Column:
    return (F.length("value") >= NER_LEAST) & F.col("value").rlike("[A-Za-z]") & ~F.lower("value").isin(*sorted(NOISE))


def clean_names(found: DataFrame) -> DataFrame:
    """Trailing dots go, then short values, stop words and values without a letter."""
    return found.withColumn("value", _trimmed()).where(_is_name())


def best_names(found: DataFrame) -> DataFrame:
    """One span of each (type, value), the best score, then the first."""
    side = Window.partitionBy("id", "type", "value").orderBy(F.desc("score"), "start_pos")
    return found.withColumn("nth", F.row_number().over(side)).where("nth = 1").drop("nth")


def ner(docs: DataFrame, backend=gazetteer, threshold: float = NER_THRESHOLD) -> DataFrame:
    """ord, id, type, value, start_pos, end_pos, score."""
    # islands are made inside a document's row, where its text is at hand
    found = docs.select("ord", "id", "content", F.filter(backend("content"), lambda e: e["score"] >= threshold).alias("found"))
    named = found.select("ord", "id", F.explode(_joined("content", "found")).alias("e")).select("ord", "id", "e.type", "e.start_pos", "e.end_pos", "e.score", "e.value")
    return best_names(clean_names(named))


def without_overlap(names: DataFrame, rules: DataFrame) -> DataFrame:
    """Names that no rule span of the same document overlaps (N05): an anti-join on id with a range beside it."""
    a, b = names.alias("a"), rules.select("id", "start_pos", "end_pos").alias("b")
    return a.join(b, (F.col("a.id") == F.col("b.id")) & (F.col("a.start_pos") < F.col("b.end_pos")) & (F.col("b.start_pos") < F.col("a.end_pos")), "left_anti")


def canonical(rows: DataFrame) -> DataFrame:
    """``canonical_value`` by type and trimmed lower-cased value (C01): literal maps of 72 keys."""
    key, out = F.lower(F.trim("value")), None
    for kind, names in lex.ALIAS_GROUPS.items():
        known = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair]), key)
        out = F.when(F.col("type") == kind, known) if out is None else out.when(F.col("type") == kind, known)
    return rows.withColumn("canonical_value", F.coalesce(out, F.col("value")))


def canonical_once(rows: DataFrame) -> DataFrame:
    """One row of each (type, canonical value): the best score, at the first one's place."""
    side = Window.partitionBy("id", "type", "canonical_value")
    best = side.orderBy(F.desc(F.coalesce("score", F.lit(0.0))), "place")
    return rows.withColumns({"nth": F.row_number().over(best), "first_place": F.min("place").over(side)}).where("nth = 1").drop("nth", "place").withColumnRenamed("first_place", "place")


def merged(docs: DataFrame, backend=gazetteer, threshold: float = NER_THRESHOLD) -> DataFrame:
    """Rule entities and the names beside them, canonical and once each.

    Spans and names of a document are found in one pass over it and go through one shuffle,
    by id: what ``spans``, ``ner`` and ``without_overlap`` do is done to both together.
    """
    found = docs.select("ord", "id", "content", _spans("content").alias("rules"), F.filter(backend("content"), lambda e: e["score"] >= threshold).alias("found"))
    found = found.select("ord", "id", "rules", _joined("content", "found").alias("names"))
    place = ["type", "value", "start_pos", "end_pos"]

    def tagged(method: str, column: str, score) -> Column:
        return F.transform(column, lambda e, i: F.struct(*[e[c].alias(c) for c in place], F.lit(method).alias("method"), score(e).alias("score"), i.alias("at")))

    every = F.concat(tagged("rule_based", "rules", lambda e: F.lit(None).cast("double")), tagged("ner", "names", lambda e: e["score"]))
    rows = found.select("ord", "id", F.explode(every).alias("e")).select("ord", "id", "e.*").repartition("id")
    rule = F.col("method") == "rule_based"
    rows = rows.withColumn("value", F.when(rule, F.col("value")).otherwise(_trimmed()))
    rows = rows.where(rule | _is_name())
    same = Window.partitionBy("id", "ord", "method", "type", F.when(rule, F.lower("value")).otherwise(F.col("value"))).orderBy(F.desc("score"), F.when(rule, F.col("at")).otherwise(F.col("start_pos")))
    once = rows.withColumn("nth", F.row_number().over(same)).where("nth = 1")
    whole = once.groupBy("ord", "id").agg(F.collect_list(F.struct(*place, "method", "score")).alias("es"))
    whole = whole.withColumn("rules", F.filter("es", lambda e: e["method"] == "rule_based"))
    beside = F.filter("es", lambda e: (e["method"] == "ner") & ~F.exists("rules", lambda b: (e["start_pos"] < b["end_pos"]) & (b["start_pos"] < e["end_pos"])))
    both = whole.select("ord", "id", F.explode(F.concat("rules", beside)).alias("e")).select("ord", "id", "e.*")
    placed = both.withColumn("place", F.row_number().over(Window.partitionBy("id", "ord").orderBy("start_pos", F.col("method") == "ner", "end_pos", "type")))
    return canonical_once(canonical(placed))
