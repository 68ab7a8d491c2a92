"""Relation and co-occurrence graph as two tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY_TYPES = ("cve_id", "domain", "ipv4", "ipv6", "malware", "organization")


def top_documents(docs: DataFrame, n: int = 150) -> DataFrame:
    """The ``n`` documents of highest risk score, first come first on ties."""
    return docs.orderBy(F.desc("risk_score"), "ord").limit(n)


def attempts(docs: DataFrame, entities: DataFrame, relations: DataFrame, n_docs: int = 150, per_doc: int = 15, most_edges: int = 400) -> DataFrame:
    """Every pair of nodes that the sample looks at, in order, up to the one that fills the edges.

    step, source, target, source_type, target_type, source_label, target_label, relation_type, doc_id, is_edge.
    Relations of a document come before pairs of its first ``per_doc`` key entities. An edge is
    the first of its two ends, in either direction, and its relation type; no node is its own
    neighbour. Only the ``n_docs`` documents of highest risk take part, so windows over all
    pairs are of bounded size.
    """
    top = top_documents(docs.select("id", "ord", "risk_score"), n_docs).withColumn("doc_rank", F.row_number().over(Window.orderBy(F.desc("risk_score"), "ord"))).select("id", "doc_rank")
    node = lambda kind, raw: F.substring(F.concat_ws(":", kind, raw), 1, 240)
    end = F.lit("relation_endpoint")
    rel = relations.where("source <> '' AND target <> ''").join(top, "id").select(
        "doc_rank", F.lit(0).alias("kind"), F.col("place").alias("i"), F.lit(0).alias("j"), node(F.lit("mention"), F.col("source")).alias("source"), node(F.lit("mention"), F.col("target")).alias("target"),
        end.alias("source_type"), end.alias("target_type"), F.col("source").alias("source_label"), F.col("target").alias("target_label"), F.col("type").alias("relation_type"), F.col("id").alias("doc_id"),
    )
    raw = F.trim(F.coalesce(F.nullif("canonical_value", F.lit("")), F.col("value"), F.lit("")))
    key = entities.where(F.col("type").isin(*KEY_TYPES)).withColumn("raw", raw).where("raw <> ''").join(top, "id")
    key = key.withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("place"))).where(F.col("k") <= per_doc)
    several = key.groupBy("id", "doc_rank").agg(F.array_sort(F.collect_list(F.struct("k", "type", "raw"))).alias("es"))
    pairs = F.flatten(F.transform("es", lambda a: F.transform(F.filter("es", lambda b: (b["k"] > a["k"]) & ((a["type"] != b["type"]) | (a["raw"] != b["raw"]))), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    a, b = F.col("p.a"), F.col("p.b")
    co = several.select("id", "doc_rank", F.explode(pairs).alias("p")).select(
        "doc_rank", F.lit(1).alias("kind"), a["k"].alias("i"), b["k"].alias("j"), node(a["type"], a["raw"]).alias("source"), node(b["type"], b["raw"]).alias("target"),
        a["type"].alias("source_type"), b["type"].alias("target_type"), a["raw"].alias("source_label"), b["raw"].alias("target_label"), F.lit("co_occurs").alias("relation_type"), F.col("id").alias("doc_id"),
    )
    order = ("doc_rank", "kind", "i", "j")
    same = Window.partitionBy(F.least("source", "target"), F.greatest("source", "target"), "relation_type").orderBy(*order)
    every = rel.unionByName(co).withColumn("is_edge", (F.row_number().over(same) == 1) & (F.col("source") != F.col("target")))
    so_far = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    every = every.withColumns({"before": F.coalesce(F.sum(F.col("is_edge").cast("int")).over(so_far), F.lit(0)), "step": F.row_number().over(Window.orderBy(*order))})
    return every.where(F.col("before") < most_edges).drop(*order, "before")


def edges(tried: DataFrame) -> DataFrame:
    """rank, source, target, relation_type, doc_id of the accepted pairs."""
    rank = F.row_number().over(Window.orderBy("step"))
    return tried.where("is_edge").select(rank.alias("rank"), "source", "target", "relation_type", "doc_id")


def nodes(tried: DataFrame, most_nodes: int = 200) -> DataFrame:
    """id, label, type, place of the first nodes met.

    A node takes its place where it is first looked at, also by a pair that makes no edge;
    beyond the cap it is refused, while edges stay, so an edge may name a refused node.
    """
    ends = [tried.select(F.col(e).alias("id"), F.substring(f"{e}_label", 1, 200).alias("label"), F.col(f"{e}_type").alias("type"), (2 * F.col("step") + i).alias("at")) for i, e in enumerate(("source", "target"))]
    first = ends[0].unionByName(ends[1]).groupBy("id").agg(F.min_by(F.struct("label", "type"), "at").alias("n"), F.min("at").alias("at"))
    return first.withColumn("place", F.row_number().over(Window.orderBy("at"))).where(F.col("place") <= most_nodes).select("id", "n.label", "n.type", "place")


def is_truncated(tried: DataFrame, most_nodes: int = 200, most_edges: int = 400) -> DataFrame:
    """truncated: whether either cap is reached."""
    n = nodes(tried, most_nodes).agg(F.count("*").alias("n"))
    return tried.agg(F.count_if("is_edge").alias("e")).join(F.broadcast(n)).select(((F.col("e") >= most_edges) | (F.col("n") >= most_nodes)).alias("truncated"))


def circle(nodes: DataFrame, radius: float = 300.0) -> DataFrame:
    """Places on a circle in the order of ``place``."""
    total = nodes.agg(F.count("*").alias("total"))
    angle = 2 * math.pi * (F.col("place") - 1) / F.col("total")
    return nodes.join(F.broadcast(total)).select("id", "type", F.round(radius * F.cos(angle), 3).alias("x"), F.round(radius * F.sin(angle), 3).alias("y"))
