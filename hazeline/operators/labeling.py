"""Weak-supervision labelling (L01 to L21): every function is a boolean column, its vote is arithmetic.

Functions are data: add a ``Labeler`` to a list of your own to vote with more. The Spark
column and the SQL text of each come from the same entry. Null title or content count as empty.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions import gates
from hazeline.functions import lexicon as lex
from hazeline.functions import patterns as pat

THRESHOLD = 0.3


@dataclass(frozen=True)
class Labeler:
    name: str
    label: str
    column: Callable[[], Column]
    sql: str


#: words that count only where a word begins
WHOLE = [*lex.ADVISORY, *lex.EXPLOIT, *lex.PHISHING, *lex.RANSOM, *lex.ACTOR_WORDS, *lex.IOC_WORDS, *lex.FAMILIES, *lex.ACTORS]


def _any(pattern: str, words: list[str] | None = None) -> tuple[Callable[[], Column], str]:
    """The pattern in the title or content; without one of the words it can't match."""
    column = lambda: F.col("combined").rlike(pattern) if words is None else gates.matches(F.col("combined"), F.col("low"), words, pattern)
    return column, f"regexp_matches(combined, '{pattern}')"


def _word(words: list[str]) -> tuple[Callable[[], Column], str]:
    """Any of the whole words; ``found`` holds those that the text has."""
    return lambda: gates.any_stands(F.col("found"), words, WHOLE), f"regexp_matches(combined, '{pat.any_of(words)}')"


def _several(words: list[str], least: int = 2) -> tuple[Callable[[], Column], str]:
    sql = " + ".join(f"CAST(regexp_matches(combined, '{pat.any_of([w])}') AS INT)" for w in words)
    return lambda: sum((gates.stands(F.col("found"), w, WHOLE).cast("int") for w in words), F.lit(0)) >= least, f"({sql}) >= {least}"


def _count(patterns: list[str], more_than: int, if_any: str) -> tuple[Callable[[], Column], str]:
    """More than so many matches in the content; ``if_any`` matches wherever one of the patterns does."""
    sql = " + ".join(f"len(regexp_extract_all(body, '{p}'))" for p in patterns)
    return lambda: F.col("body").rlike(if_any) & (sum((F.regexp_count("body", F.lit(p)) for p in patterns), F.lit(0)) > more_than), f"({sql}) > {more_than}"


def _source(*names: str) -> tuple[Callable[[], Column], str]:
    return lambda: F.coalesce(F.col("source").isin(*names), F.lit(False)), f"coalesce(source IN ({', '.join(repr(n) for n in names)}), FALSE)"


def _either(a, b):
    return lambda: a[0]() | b[0](), f"({a[1]} OR {b[1]})"


LABELERS = [
    Labeler(name, label, *built)
    for name, label, built in (
        ("cve_pattern", "vulnerability", _any(pat.CVE, ["cve-"])),
        ("advisory_keywords", "vulnerability", _several(lex.ADVISORY)),
        ("cvss_score", "vulnerability", _either(_any(pat.CVSS_NEAR, ["cvss"]), _any(pat.SEVERITY, ["severity"]))),
        ("poc_keywords", "exploit", _word(lex.EXPLOIT)),
        ("exploit_url", "exploit", _any(pat.EXPLOIT_LINK, ["github", "exploit-db"])),
        ("phishing_keywords", "phishing", _several(lex.PHISHING)),
        ("phishing_source", "phishing", _source("phishtank")),
        ("ransomware_keywords", "ransomware", _several(lex.RANSOM)),
        ("ransomware_families", "ransomware", _word(lex.FAMILIES)),
        ("ransomware_source", "ransomware", _source("ransomwatch")),
        ("apt_pattern", "threat_actor", _any(pat.APT)),
        ("threat_actor_keywords", "threat_actor", _several(lex.ACTOR_WORDS)),
        ("known_actors", "threat_actor", _word(lex.ACTORS)),
        ("ioc_ip_density", "ioc", _count([pat.IPV4_WORD], 3, r"[0-9]\.[0-9]")),
        ("ioc_hash_density", "ioc", _count([pat.MD5, pat.SHA1, pat.SHA256], 2, pat.HEX)),
        ("ioc_keywords", "ioc", _several(lex.IOC_WORDS)),
        ("ioc_source", "ioc", _source("otx", "threatfox")),
    )
]
VOTERS = {label: [x for x in LABELERS if x.label == label] for label in lex.CATEGORIES}


def fired(docs: DataFrame, labelers: list[Labeler] | None = None) -> DataFrame:
    """``docs`` with one boolean ``lf_<name>`` for every labelling function."""
    texts = docs.withColumns({"body": F.coalesce("content", F.lit("")), "combined": F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit("")))})
    texts = texts.withColumns({"low": F.lower("combined"), "found": gates.whole(F.col("combined"), WHOLE)})
    return texts.withColumns({f"lf_{x.name}": x.column() for x in labelers or LABELERS}).drop("body", "combined", "low", "found")


def votes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``votes_<label>``."""
    return fired(docs).withColumns({f"votes_{label}": sum((F.col(f"lf_{x.name}").cast("int") for x in own), F.lit(0)) for label, own in VOTERS.items()}).drop(*[f"lf_{x.name}" for x in LABELERS])


def confidences(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``conf_<label>`` (null under the threshold) beside the votes."""
    ratio = {f"conf_{c}": F.round(F.col(f"votes_{c}") / F.lit(len(own)), 4) for c, own in VOTERS.items()}
    kept = {c: F.when(r >= threshold, r) for c, r in ratio.items()}
    return votes(docs).withColumns(kept)


def label_map(rows: DataFrame, unknown: bool = False) -> DataFrame:
    """Confidence columns folded into the map ``predicted_labels`` (L19, L20; L21 with ``unknown`` false)."""
    pairs = F.filter(F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"conf_{c}").alias("value")) for c in VOTERS]), lambda p: p["value"].isNotNull())
    found = F.map_from_entries(pairs)
    if unknown:
        found = F.when(F.size(pairs) == 0, F.create_map(F.lit("unknown"), F.lit(0.0))).otherwise(found)
    return rows.withColumn("predicted_labels", found)


def long_labels(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """id, label, votes, confidence: one row for each label that a document keeps."""
    stack = ", ".join(f"'{c}', votes_{c}, conf_{c}" for c in VOTERS)
    rows = confidences(docs.select("id", "title", "content", "source"), threshold)
    return rows.selectExpr("id", f"stack({len(VOTERS)}, {stack}) AS (label, votes, confidence)").where("confidence IS NOT NULL")


def coverage(docs: DataFrame) -> DataFrame:
    """labeler, label, fired: how many documents each function votes on."""
    rows = fired(docs)
    one = rows.agg(*[F.count_if(f"lf_{x.name}").alias(x.name) for x in LABELERS])
    stack = ", ".join(f"'{x.name}', '{x.label}', {x.name}" for x in LABELERS)
    return one.selectExpr(f"stack({len(LABELERS)}, {stack}) AS (labeler, label, fired)")
