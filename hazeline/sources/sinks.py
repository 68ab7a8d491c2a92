"""Writers (K01 to K09): partitioned JSON lines, wrapped JSON, review tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_lines(rows: DataFrame, path: str, by: tuple[str, ...] = ("date",)) -> bool:
    """JSON lines under one folder for each value of ``by``; nothing at all for no rows."""
    if not rows.take(1):
        return False
    rows.write.mode("overwrite").partitionBy(*by).json(path)
    return True


def wrapped(rows: DataFrame, source: str, kind: str, stamp: str, name: str = "records") -> DataFrame:
    """One JSON text with the records and their number; for small sets, since it is one row."""
    listed = rows.agg(F.collect_list(F.struct(*rows.columns)).alias(name), F.count("*").alias("record_count"))
    return listed.select(F.to_json(F.struct(F.lit(source).alias("source"), F.lit(kind).alias("data_type"), "record_count", F.lit(stamp).alias("ingested_at"), name)).alias("value"))


def write_review(rows: DataFrame, path: str) -> None:
    """Tab separated, labels already joined by bars."""
    rows.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def safe_name(name: Column) -> Column:
    """File name of at most 50 characters."""
    return F.substring(F.regexp_replace(name, r"[^\w\-.]", "_"), 1, 50)


def slim(enriched: DataFrame) -> DataFrame:
    """Without the nested entities of the summary."""
    return enriched.withColumn("entity_summary", F.col("entity_summary").dropFields("entities")) if "entity_summary" in enriched.columns else enriched


def missing_only(new: DataFrame, stored: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose key is not stored yet."""
    return new.join(stored.select(key), key, "left_anti")
