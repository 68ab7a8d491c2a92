"""Label evaluation against a gold set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _round(x: Column, digits: int = 2) -> Column:
    """Half to even on the decimal of the double, as small counts make real ties (1/8 at two digits)."""
    return F.coalesce(F.bround(x, digits), F.lit(0.0))


def last_lines(lines: DataFrame) -> DataFrame:
    """id, label of lines (ord, id, labels): of equal ids the last line counts, whatever the others say; null label without any."""
    last = lines.where("id IS NOT NULL").groupBy(F.col("id").cast("string").alias("id")).agg(F.max_by(F.struct("labels"), "ord").alias("x"))
    return last.select("id", F.explode_outer("x.labels").alias("label"))


def per_label(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """label, tp, fp, fn, precision, recall, f1, support, predicted over the ids that both sides have.

    gold, predicted: id, label, a row with null label for a document without any. Labels of
    ids without a match are listed too, with zeros.
    """
    g, p = gold.select(F.col("id").cast("string").alias("id"), "label").distinct(), predicted.select(F.col("id").cast("string").alias("id"), "label").distinct()
    both = g.select("id").distinct().join(p.select("id").distinct(), "id")
    pairs = g.where("label IS NOT NULL").withColumn("in_gold", F.lit(1)).join(p.where("label IS NOT NULL").withColumn("in_pred", F.lit(1)), ["id", "label"], "full_outer")
    pairs = pairs.join(both.withColumn("matched", F.lit(1)), "id", "left")
    hit = F.col("matched") == 1
    rows = pairs.groupBy("label").agg(
        F.count_if(hit & (F.col("in_gold") == 1) & (F.col("in_pred") == 1)).alias("tp"),
        F.count_if(hit & F.col("in_gold").isNull()).alias("fp"),
        F.count_if(hit & F.col("in_pred").isNull()).alias("fn"),
    )
    precision, recall = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    f1 = F.try_divide(2 * precision * recall, precision + recall)
    return rows.select("label", "tp", "fp", "fn", _round(precision).alias("precision"), _round(recall).alias("recall"), _round(f1).alias("f1"), (F.col("tp") + F.col("fn")).alias("support"), (F.col("tp") + F.col("fp")).alias("predicted"))


def overall(metrics: DataFrame) -> DataFrame:
    """Macro means of the rounded metrics, and micro ones from pooled counts; passed says if macro F1 is 0.70 or more."""
    s = metrics.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")])
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    macro = [_round(F.col(f"macro_{c}")).alias(f"macro_{c}") for c in ("precision", "recall", "f1")]
    return s.select(*macro, _round(p).alias("micro_precision"), _round(r).alias("micro_recall"), _round(F.try_divide(2 * p * r, p + r)).alias("micro_f1"), (_round(F.col("macro_f1")) >= 0.70).alias("passed"))


def unmatched(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Gold ids without a prediction."""
    return gold.select(F.col("id").cast("string").alias("id")).distinct().join(predicted.select(F.col("id").cast("string").alias("id")).distinct(), "id", "left_anti")


def report(metrics: DataFrame) -> DataFrame:
    """One fixed-width line a label."""
    return metrics.select("label", F.format_string("%-16s %6.2f %6.2f %6.2f %6d", "label", "precision", "recall", "f1", "support").alias("line"))
