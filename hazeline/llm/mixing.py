"""Mixing sources to target weights by entropy balancing.

Each source has a token target. Among all document rates r in [0, most] whose
expected tokens meet it, entropy balancing takes those nearest to one copy each in
relative entropy: r = min(most, exp(lambda * size / mean size)), one dual variable
lambda a source. The convex dual is solved for all sources at once by safeguarded
Newton steps, each a distributed aggregate over (source, size, documents). Rates
become whole copies by carrying the rounding error from the longest document of a
group to the shortest, in groups of bounded size.

Null texts have size 0; a null source is a source of its own, ordered last. Sources
and totals of size 0 get target 0. Rows without doc_id and repeated rows count like
any other: rows alike in id, source and text are rounded as one row with a multiplicity, so that
copies of one text never fill a rounding task, and share the copies it takes. Extra columns
are not read, and the pipeline's stage carries them whatever their names. Long texts are
counted in full; a table without rows gives one without rows. The same rows give the same
copies: sums of doubles are taken over decimals, in which their order has no influence.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free, session_limits, table, written

WORD = r"[^\x20\x09-\x0D]+"
GROUP = 20_000  #: documents that one rounding task may hold
SPREAD = 10_000  #: rows of one text that a task makes at most
STEPS = 60  #: Newton steps at most; a dozen is usual
NEAR = 1e-9  #: relative error of a source's expected tokens at which Newton stops


def n_words() -> F.Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")


def text_mark() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, a hash of the text as mark, and m, how many rows are so."""
    rows = docs.select("doc_id", "source", n_words().alias("size"), text_mark().alias("mark"))
    return rows.groupBy("doc_id", "source", "size", "mark").agg(F.count("*").alias("m"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target: ``share`` of all words by weight, none above ``most`` times its source.

    Weights repeat over the sources in code point order. Filling up: in the order of
    limit over weight, a source is at its limit if what is left would give it more.
    One row a source, so the windows over all sources are small.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rows = per.withColumn("w", w).withColumn("cap", most * F.col("source_size"))
    rows = rows.withColumns({"all_w": F.sum("w").over(everything), "all_size": F.sum("source_size").over(everything), "w_before": F.coalesce(F.sum("w").over(before), F.lit(0.0)), "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0))})
    rows = rows.withColumn("level", (share * F.col("all_size") - F.col("cap_before")) / (F.col("all_w") - F.col("w_before")))
    rows = rows.withColumn("free", F.col("cap") > F.col("w") * F.col("level"))
    level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("w"), F.col("level")))).over(everything)
    return rows.withColumn("final", level.getField("level")).select("source", "source_size", F.when(F.col("free"), F.col("w") * F.col("final")).otherwise(F.col("cap")).cast("double").alias("target"))


def dual(sizes: DataFrame, goals: DataFrame, most: float = 2.0) -> DataFrame:
    """source, source_size, target, mean, lam: the dual variable of each source (null: all at ``most`` or none)."""
    hist = written(sizes.where("size > 0").groupBy("source", "size").agg(F.sum("m").alias("n")), "sizes")
    shape = hist.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("least"))
    top = float(np.log(most))
    state = goals.alias("g").join(shape.alias("s"), F.col("g.source").eqNullSafe(F.col("s.source")), "left").select("g.*", "mean", "least")
    open_ = (F.col("target") > 0) & (F.col("target") < most * F.col("source_size"))
    z_least = F.col("least") / F.col("mean")
    state = state.withColumns(
        {
            "lam": F.when(open_, F.lit(0.0)),
            "lo": F.when(open_, F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size"))) / z_least),
            "hi": F.when(open_, F.lit(top) / z_least),
        }
    )
    state = table_ = written(state, "dual")
    exact = lambda x: F.sum(x.cast("decimal(38,9)")).cast("double")
    for _ in range(STEPS):
        z = F.col("size") / F.col("mean")
        r = F.least(F.lit(most), F.exp(F.least(F.lit(top), F.col("lam") * z)))
        moved = hist.alias("h").join(state.select(F.col("source").alias("_s"), "mean", "lam").where("lam is not null"), F.col("h.source").eqNullSafe(F.col("_s")))
        sums = moved.groupBy("_s").agg(exact(F.col("n") * F.col("size") * r).alias("got"), exact(F.when(F.col("lam") * z < top, F.col("n") * F.col("size") * z * r).otherwise(0.0)).alias("slope"))
        state = state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        off = F.col("got") - F.col("target")
        state = state.withColumns({"error": F.coalesce(F.abs(off) / F.col("target"), F.lit(0.0)), "lo": F.when(off < 0, F.col("lam")).otherwise(F.col("lo")), "hi": F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))})
        step = F.col("lam") - off / F.col("slope")
        middle = (F.col("lo") + F.col("hi")) / 2
        better = F.when(F.col("slope") > 0, F.when((step > F.col("lo")) & (step < F.col("hi")), step).otherwise(middle)).otherwise(middle)
        state = written(state.withColumn("lam", F.when(F.col("error") > NEAR, better).otherwise(F.col("lam"))).drop("got", "slope"), "dual", table_)
        table_ = state
        worst = state.agg(F.max("error")).first()[0]
        state = state.drop("error")
        if worst is None or worst <= NEAR:
            break
    return state.select("source", "source_size", "target", "mean", "lam")


def round_group(sizes: np.ndarray, rates: np.ndarray, order: np.ndarray, most: float, rows: np.ndarray | None = None) -> np.ndarray:
    """Whole copies for rates, in ``order``, each carrying the error of those before.

    A document gets its rate rounded down or up, or one copy beside these where the
    words carried ask for it; what is carried at the end is about half of a short one.
    ``rows`` says how many rows each document stands for; its copies are those of all.
    """
    copies = np.zeros(len(sizes), dtype=np.int64)
    carry, top = 0.0, int(most)
    for i in order.tolist():
        m = 1 if rows is None else int(rows[i])
        size, rate = float(sizes[i]), float(rates[i]) * m
        low = int(rate + 1e-9)
        n = math.floor(rate + carry / size + 0.5) if size else low
        copies[i] = n = min(max(n, low - 1, 0), low + 2, top * m)
        carry += (rate - n) * size
    return copies


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, source, size, mark, m, source_size, target, copies: a row for all that are alike, with the copies of all."""
    session_limits(docs.sparkSession)
    sizes = written(sized(docs), "sized")
    state = dual(sizes, targets(sizes, weights, share, most), most)
    n_docs = sizes.groupBy("source").agg(F.count("*").alias("n_docs"))
    state = state.alias("a").join(n_docs.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.*", "n_docs")
    state = written(state, "rates").withColumnRenamed("source", "_source")
    rate = F.when(F.col("target") <= 0, F.lit(0.0)).when(F.col("lam").isNull(), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.exp(F.col("lam") * F.col("size") / F.col("mean"))))
    rows = sizes.join(state, F.col("source").eqNullSafe(F.col("_source"))).withColumn("rate", rate)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(11), "doc_id", "size", "mark"), F.ceil(F.col("n_docs") / GROUP)))
    rows = rows.select("doc_id", "source", "size", "mark", "m", "source_size", "target", "rate", "bucket")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["doc_id"].fillna(-1).to_numpy().astype(np.int64)
        size = group["size"].to_numpy()
        order = np.lexsort((group["mark"].to_numpy(), ids, (ids * 0x9E3779B97F4A7C1 + size) & 0xFFFFFFFF, -size))
        out = group.drop(columns=["rate", "bucket"])
        out["copies"] = round_group(size, group["rate"].to_numpy(), order, most, group["m"].to_numpy())
        return out

    return rows.groupBy("source", "bucket").applyInPandas(run, "doc_id long, source string, size long, mark long, m long, source_size long, target double, copies long")


def _repeated(rows: DataFrame, n: F.Column, name: str) -> DataFrame:
    """Each row ``n`` times, numbered from 0 as ``name``; what one row becomes is spread over tasks of ``SPREAD``."""
    part, many = free([*rows.columns, name], "part"), rows.where(n > SPREAD)
    few = rows.where(n <= SPREAD).select("*", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias(name))
    many = many.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / SPREAD))).alias(part)).repartition(part)
    first = F.col(part) * SPREAD
    return few.unionByName(many.select("*", F.explode(F.sequence(first, F.least(first + (SPREAD - 1), n - 1))).alias(name)).drop(part))


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every row of ``docs``."""
    rows = written(mix(docs, weights, share, most), "mix")
    i, m, n = F.col("i"), F.col("m"), F.col("copies")
    own = F.floor((i + 1) * n / m) - F.floor(i * n / m)
    return _repeated(rows, m, "i").select("doc_id", "source", "size", "source_size", "target", own.alias("copies"))


def taken(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``docs``, all columns kept, each row as often as the mix takes it.

    Of rows alike in id, source and text the one of least hash over its columns stands for all.
    """
    columns, plain = docs.columns, [c for c, kind in docs.dtypes if "map<" not in kind]
    size, mark, m, copies, turn, row = (free(columns, c) for c in ("size", "mark", "m", "copies", "turn", "row"))
    mixed = mix(docs, weights, share, most).where("copies > 0").select(F.col("doc_id").alias("i"), F.col("source").alias("s"), F.col("size").alias("z"), F.col("mark").alias("k"), F.col("m").alias("r"), F.col("copies").alias("n")).alias("b")
    rows = docs.withColumns({size: n_words(), mark: text_mark()}).alias("a")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.i")) & F.col("a.source").eqNullSafe(F.col("b.s")) & (F.col(f"a.{size}") == F.col("b.z")) & (F.col(f"a.{mark}") == F.col("b.k"))
    both = rows.join(mixed, same).select("a.*", F.col("b.r").alias(m), F.col("b.n").alias(copies))
    single = both.where(F.col(m) == 1).select(*columns, copies)
    several = both.where(F.col(m) > 1).groupBy("doc_id", "source", size, mark, copies).agg(F.min_by(F.struct(*columns), F.xxhash64(*plain)).alias(row))
    kept = single.unionByName(several.select(f"{row}.*", copies))
    return _repeated(kept, F.col(copies), turn).select(*columns)


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mixed_rows(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
