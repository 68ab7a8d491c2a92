"""Vulnerability records: paged sources, weaknesses, scores, documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RECORD = (
    "id string, published string, lastModified string, descriptions array<struct<lang:string,value:string>>, "
    "metrics struct<cvssMetricV31:array<{m}>,cvssMetricV30:array<{m}>,cvssMetricV2:array<{m}>>, weaknesses array<struct<description:array<struct<value:string>>>>, references array<struct<url:string,source:string,tags:array<string>>>, refs string"
).replace("{m}", "struct<cvssData:struct<baseScore:double,baseSeverity:string,vectorString:string>,baseSeverity:string,exploitabilityScore:double,impactScore:double>")


class _Page(InputPartition):
    def __init__(self, start: int, size: int):
        self.start, self.size = start, size


class Paged(DataSource):
    """An offset-paged API as a table: one partition a page, so pages load in parallel and are retried alone.

    Options: total, page (rows of a page, 2000 at most), and fetch, the dotted name of a
    function (start, size) -> list of JSON texts.
    """

    @classmethod
    def name(cls) -> str:
        return "hazeline_paged"

    def schema(self) -> str:
        return "idx long, record string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(int(self.options["total"]), min(2000, int(self.options.get("page", 2000))), self.options["fetch"])


class _PagedReader(DataSourceReader):
    def __init__(self, total: int, page: int, fetch: str):
        self.total, self.page, self.fetch = total, page, fetch

    def partitions(self) -> list[InputPartition]:
        return [_Page(i, min(self.page, self.total - i)) for i in range(0, self.total, self.page)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        import importlib

        module, _, name = self.fetch.rpartition(".")
        fetch: Callable = getattr(importlib.import_module(module), name)
        for i, text in enumerate(fetch(partition.start, partition.size)):
            yield partition.start + i, text


def records(raw: DataFrame) -> DataFrame:
    """CVE records from the API's JSON, in column ``record``."""
    return raw.select(F.from_json("record", RECORD).alias("cve")).select("cve.*")


def description() -> Column:
    """English description, else the first."""
    english = F.filter("descriptions", lambda d: d["lang"] == "en")
    return F.coalesce(F.get(english, 0)["value"], F.get("descriptions", 0)["value"])


def best_metric() -> Column:
    """First CVSS 3.1 metric, else 3.0, else 2."""
    return F.coalesce(*[F.get(f"metrics.{v}", 0) for v in ("cvssMetricV31", "cvssMetricV30", "cvssMetricV2")])


def weakness_ids() -> Column:
    """Distinct CWE ids of a record, sorted as texts."""
    values = F.flatten(F.transform(F.coalesce("weaknesses", F.expr("array()").cast("array<struct<description:array<struct<value:string>>>>")), lambda w: F.transform(w["description"], lambda d: d["value"])))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(values, lambda v: F.regexp_extract_all(v, F.lit(r"CWE-(\d+)"), F.lit(1))))))


def with_weaknesses(cves: DataFrame, weaknesses: DataFrame) -> DataFrame:
    """cve_id, cwe_ids, details (known ones) of every CVE that names a weakness."""
    named = cves.select(F.col("id").alias("cve_id"), weakness_ids().alias("cwe_ids")).where(F.size("cwe_ids") > 0)
    each = named.select("cve_id", "cwe_ids", F.explode("cwe_ids").alias("cwe_id")).join(weaknesses, "cwe_id", "left")
    detail = F.collect_list(F.when(F.col("name").isNotNull(), F.struct("cwe_id", "name")))
    return each.groupBy("cve_id", "cwe_ids").agg(F.map_from_entries(F.array_sort(detail)).alias("details"))


def with_lookup(cves: DataFrame, known: DataFrame | None) -> DataFrame:
    """Every CVE beside its row of a lookup, null on a miss; without a lookup all null."""
    ids = cves.select(F.col("id").alias("cve_id")).distinct()
    return ids.withColumn("detail", F.lit(None).cast("string")) if known is None else ids.join(known, "cve_id", "left")


def last_write(rows: DataFrame) -> DataFrame:
    """One row of each CVE, the last written."""
    return rows.groupBy("cve_id").agg(F.max_by("detail", "ord").alias("detail"))


def documents(cves: DataFrame, weaknesses: DataFrame) -> DataFrame:
    """CVE records as documents (S20), with ref_tags and the metric's score, severity and exploitability beside them."""
    details = with_weaknesses(cves, weaknesses).select("cve_id", "details")
    m, words = best_metric(), "array<string>"
    rows = cves.join(details, cves["id"] == details["cve_id"], "left")
    rows = rows.withColumns({"metric": m, "score": m["cvssData"]["baseScore"], "severity": F.coalesce(m["cvssData"]["baseSeverity"], m["baseSeverity"]), "said": F.coalesce(description(), F.lit(""))})
    rows = rows.withColumn("exploitability", F.col("metric.exploitabilityScore"))
    blank = F.lit("")
    some = lambda condition, *lines: F.when(condition, F.array(*lines)).otherwise(F.array().cast(words))
    listed = lambda x, label: F.when(F.col(x) != "", F.concat(F.lit(label[0]), F.col(x), F.lit(label[1]))).otherwise("")
    named = F.filter(F.flatten(F.transform("weaknesses", lambda w: F.transform(w["description"], lambda d: d["value"]))), lambda v: F.startswith(v, F.lit("CWE-")))
    refs = F.transform("references", lambda r: F.concat(F.lit("  - "), F.coalesce(r["url"], blank), F.when(F.size(r["tags"]) > 0, F.concat(F.lit(" ["), F.array_join(r["tags"], ", "), F.lit("]"))).otherwise("")))
    rows = rows.withColumn("vector", F.col("metric.cvssData.vectorString"))
    score = F.concat(F.lit("CVSS Score: "), F.coalesce(F.col("score").cast("string"), F.lit("None")), F.coalesce(listed("severity", (" (", ")")), blank), F.coalesce(listed("vector", (" Vector: ", "")), blank))
    exploitable = F.coalesce(F.col("exploitability") != 0, F.lit(False))
    has = F.col("metric").isNotNull()
    lines = F.concat(
        F.array(F.concat(F.lit("CVE Identifier: "), F.col("id")), blank),
        some(F.col("said") != "", F.col("said"), blank),
        some(has, score),
        some(has & exploitable, F.concat(F.lit("Exploitability Score: "), F.col("exploitability").cast("string"))),
        some(has, blank),
        some(F.size(named) > 0, F.concat(F.lit("Weakness: "), F.array_join(named, ", "))),
        F.coalesce(F.transform(F.map_entries("details"), lambda e: F.concat(F.lit("CWE-"), e["key"], F.lit(": "), e["value"])), F.array().cast(words)),
        F.array(blank),
        F.when(F.size(refs) > 0, F.concat(F.array(F.lit("References:")), refs, F.array(blank))).otherwise(F.array().cast(words)),
    )
    short = F.split_part(F.substring("said", 1, 100), F.lit("."), F.lit(1))
    title = F.concat_ws(" ", F.col("id"), F.when(F.col("severity") != "", F.concat(F.lit("("), F.col("severity"), F.lit(")"))), F.when(F.col("said") != "", F.concat(F.lit("- "), short)))
    tags = F.array_sort(F.array_distinct(F.flatten(F.transform("references", lambda r: F.coalesce(r["tags"], F.array().cast(words))))))
    return rows.select(
        F.concat(F.lit("nvd_cve_"), F.col("id"), F.lit("_"), F.substring(F.sha2(F.col("id"), 256), 1, 8)).alias("id"), title.alias("title"), F.array_join(lines, "\n").alias("content"),
        F.concat(F.lit("https://nvd.nist.gov/vuln/detail/"), F.col("id")).alias("url"), F.lit("nvd_ref").alias("source"), F.lit("vulnerability").alias("source_category_hint"),
        F.col("published").alias("published_at"), F.col("lastModified").alias("collected_at"), F.coalesce(tags, F.array().cast(words)).alias("ref_tags"), "score", "severity", "exploitability",
    )


def severity_histogram(docs: DataFrame) -> DataFrame:
    return docs.groupBy(F.coalesce(F.upper("severity"), F.lit("NONE")).alias("severity")).agg(F.count("*").alias("n"))
