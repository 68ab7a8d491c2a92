"""Corpus-level operators: dedup, union, provenance, trends, totals, rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.operators.risk import TIERS


def keep_first(docs: DataFrame, order: str = "ord") -> DataFrame:
    """One row for each id, the first by ``order``; rows without id go.

    Only first ranks are asked for, so rows of one id are thinned out before the shuffle,
    and columns that nobody reads are not carried through it.
    """
    first = Window.partitionBy("id").orderBy(order)
    rows = docs.where("id IS NOT NULL AND id <> ''").withColumn("_nth", F.row_number().over(first))
    return rows.where("_nth = 1").drop("_nth")


def union_trim(old: DataFrame, new: DataFrame, target: int, order: str = "ord") -> DataFrame:
    """Old rows before new ones, first of each id, at most ``target``."""
    both = old.withColumn("_part", F.lit(0)).unionByName(new.withColumn("_part", F.lit(1)))
    both = both.withColumn("_order", F.struct("_part", order)).drop("_part")
    return keep_first(both, "_order").orderBy("_order").limit(target).drop("_order")


def provenance(docs: DataFrame) -> DataFrame:
    """Empty strings become null in the provenance columns."""
    return docs.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in ("title", "url", "source", "source_category_hint", "published_at", "collected_at") if c in docs.columns})


def day_of(value: Column) -> Column:
    """The date of a timestamp text in its own offset; a plain YYYY-MM-DD is taken as it is."""
    plain = F.regexp_extract(value, r"^(\d{4}-\d{2}-\d{2})$", 1)
    stamped = F.regexp_extract(value, r"^(\d{4}-\d{2}-\d{2})[T ]\d{2}:\d{2}.*$", 1)
    return F.coalesce(F.nullif(plain, F.lit("")), F.when(F.try_to_date(stamped, "yyyy-MM-dd").isNotNull(), stamped))


def trend_day(docs: DataFrame) -> DataFrame:
    stamps = [c for c in ("collected_at", "published_at", "enriched_at") if c in docs.columns]
    return docs.withColumn("day", F.coalesce(*[day_of(F.col(c)) for c in stamps]))


def window_days(docs: DataFrame, days: int = 90) -> DataFrame:
    """Rows whose day lies in the ``days`` up to the last one, inclusive."""
    rows = trend_day(docs).where("day IS NOT NULL")
    last = rows.agg(F.max("day").alias("last"))
    return rows.join(F.broadcast(last), F.col("day").cast("date") >= F.date_sub(F.col("last").cast("date"), days)).drop("last")


def per_day(docs: DataFrame, days: int = 90) -> DataFrame:
    return window_days(docs, days).groupBy("day").agg(F.count("*").alias("documents"))


def counts_by(rows: DataFrame, column: str) -> DataFrame:
    """Counts by value with the place of the first, which breaks ties."""
    return rows.groupBy(column).agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"))


def top_sources(docs: DataFrame, k: int = 7) -> DataFrame:
    return counts_by(docs, "source").orderBy(F.desc("n"), "first_ord").limit(k)


def day_source(docs: DataFrame, k: int = 7, days: int = 90) -> DataFrame:
    """day, source, documents for the overall top sources, zero filled.

    The long form of the pivot: its columns would depend on the data.
    """
    inside = window_days(docs, days)
    grid = inside.select("day").distinct().join(F.broadcast(top_sources(docs, k).select("source")))
    n = inside.groupBy("day", "source").agg(F.count("*").alias("n"))
    return grid.join(n, ["day", "source"], "left").select("day", "source", F.coalesce("n", F.lit(0)).alias("documents"))


def day_tier(docs: DataFrame, days: int = 90) -> DataFrame:
    """One column a risk tier."""
    return window_days(docs, days).groupBy("day").pivot("risk_tier", list(TIERS)).count().na.fill(0)


def totals(docs: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """documents, labeled, unlabeled, multi_label, entities, relations, avg_entities.

    docs: n_labels of each document; the other two one row for each entity and relation of them.
    """
    n = F.count("*")
    rows = docs.agg(n.alias("documents"), *[F.count_if(c).alias(k) for k, c in (("labeled", F.col("n_labels") > 0), ("unlabeled", F.col("n_labels") == 0), ("multi_label", F.col("n_labels") > 1))])
    for name, many in (("entities", entities), ("relations", relations)):
        rows = rows.join(F.broadcast(many.agg(n.alias(name))))
    return rows.withColumn("avg_entities", F.round(F.coalesce(F.try_divide("entities", "documents"), F.lit(0.0)), 1))


def label_stats(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label").agg(F.count("*").alias("documents"), F.round(F.avg("confidence"), 3).alias("avg_confidence"))


def tier_counts(rows: DataFrame) -> DataFrame:
    """All four tiers in fixed order, zeros included."""
    spark = rows.sparkSession
    fixed = spark.createDataFrame([(i, t) for i, t in enumerate(TIERS)], "place int, risk_tier string")
    n = rows.groupBy("risk_tier").agg(F.count("*").alias("n"))
    return fixed.join(n, "risk_tier", "left").select("place", "risk_tier", F.coalesce("n", F.lit(0)).alias("documents"))


def top_values(entities: DataFrame, types: dict[str, str], k: int = 20) -> DataFrame:
    """board, value, n, rank of the ``k`` most frequent values of each board.

    types: entity type -> board. Ties go to the value met first.
    """
    board = F.element_at(F.create_map(*[F.lit(x) for pair in types.items() for x in pair]), F.col("type"))
    rows = entities.where(F.col("type").isin(*types)).withColumn("board", board)
    n = rows.groupBy("board", "value").agg(F.count("*").alias("n"), F.min(F.struct("ord", "start_pos")).alias("at"))
    order = Window.partitionBy("board").orderBy(F.desc("n"), "at", "value")
    return n.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("board", "value", "n", "rank")


def rollup(entities: DataFrame, docs: DataFrame) -> DataFrame:
    """Mentions of each (type, canonical or plain value) with documents, sources and tiers."""
    both = entities.join(docs.select("id", "source", "risk_tier"), "id")
    name = F.coalesce("canonical_value", "value").alias("name")
    tiers = [F.count_if(F.col("risk_tier") == t).alias(f"n_{t}") for t in TIERS]
    return both.groupBy("type", name).agg(F.count("*").alias("mentions"), F.count_distinct("id").alias("documents"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), *tiers)


def rollup_once(rows: DataFrame) -> DataFrame:
    """``rollup`` of rows (type, value, source, risk_tier) that hold a value of a document once: each is a document.

    Sources are few, so values are counted by source first, and nothing but counts is shuffled.
    """
    tiers = [F.count_if(F.col("risk_tier") == t).alias(f"n_{t}") for t in TIERS]
    by_source = rows.groupBy("type", F.col("value").alias("name"), "source").agg(F.count("*").alias("n"), *tiers)
    sources = F.array_join(F.array_sort(F.collect_list("source")), ",").alias("sources")
    return by_source.groupBy("type", "name").agg(F.sum("n").alias("mentions"), F.sum("n").alias("documents"), sources, *[F.sum(f"n_{t}").alias(f"n_{t}") for t in TIERS])


def entity_page(rolled: DataFrame, search: str = "", type_: str | None = None, by: str = "mentions", descending: bool = True, page: int = 1, size: int = 50) -> DataFrame:
    """Filter, sort and page of a rollup; the page is clamped to those there are.

    The rows up to the page's end say how many pages there are where it is beyond the last,
    so nothing is counted beforehand.
    """
    rows = rolled.where(F.contains(F.lower("name"), F.lit(search.lower())))
    if type_:
        rows = rows.where(F.col("type") == type_)
    page = max(page, 1)
    order = [F.col(by).desc() if descending else F.col(by).asc(), F.col("type"), F.col("name")]
    upto = rows.orderBy(*order).limit(page * size)
    upto = upto.withColumns({"_at": F.row_number().over(Window.orderBy(*order)), "_n": F.count("*").over(Window.partitionBy(F.lit(0)))})
    shown = F.least(F.lit(page), F.greatest(F.ceil(F.col("_n") / size), F.lit(1)))
    return upto.where((F.col("_at") > (shown - 1) * size) & (F.col("_at") <= shown * size)).orderBy(*order).drop("_at", "_n")


def search(docs: DataFrame, text: str = "", source: str | None = None, label: str | None = None, tier: str | None = None, page: int = 1, size: int = 50) -> DataFrame:
    """Documents by title, source, label and tier."""
    rows = docs.where(F.contains(F.lower(F.coalesce("title", F.lit(""))), F.lit(text.lower())))
    if source:
        rows = rows.where(F.col("source") == source)
    if label:
        rows = rows.where(F.map_contains_key("predicted_labels", F.lit(label)))
    if tier:
        rows = rows.where(F.col("risk_tier") == tier)
    return rows.orderBy("ord").offset((page - 1) * size).limit(size)


def shares(rows: DataFrame, column: str) -> DataFrame:
    """Counts and percentages of all rows by value."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    # from the counts, so that the rows are gone through once
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(0)))).select(column, "n", F.round(100 * F.col("n") / F.col("total"), 1).alias("percent"))


def label_combinations(labels: DataFrame) -> DataFrame:
    """How many documents have each combination of labels."""
    each = labels.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("label")), "+").alias("combination"))
    return each.groupBy("combination").agg(F.count("*").alias("documents"))


def f1_band(f1: Column, passes: float = 0.7) -> Column:
    """Badge of a score."""
    return F.when(f1 >= 0.9, "excellent").when(f1 >= passes, "good").otherwise("poor")
