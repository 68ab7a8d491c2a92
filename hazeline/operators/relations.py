"""Relations between near entities.

A pair is at most 200 characters apart; which rules apply follows from the two types. A
document's entities are gathered into one array, and the pairs that have a rule are made
inside the row, so entities are computed once and nothing is joined with itself. Windows of
text, triggers and sentences are looked at only for those pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.functions import patterns as pat

NEAR = 200
THINGS = ("malware", "organization", "system")


def left_edge(text: Column, start: Column) -> Column:
    """Where the sentence around ``start`` begins."""
    return start - F.length(F.regexp_extract(F.substring(text, F.lit(1), start), r"[^.!?\n]*\z", 0))


def right_edge(text: Column, end: Column) -> Column:
    rest = F.substring(text, end + 1, F.length(text))
    return end + F.length(F.regexp_extract(rest, r"\A[^.!?\n]*[.!?\n]?", 0))


def between(text: Column, a: Column, b: Column) -> Column:
    """The trimmed text from the sentence start of ``a`` to the sentence end of ``b``."""
    low, high = left_edge(text, a), right_edge(text, b)
    return F.trim(F.substring(text, low + 1, F.greatest(high - low, F.lit(0))))


def window_of(text: Column, a: Column, b: Column) -> Column:
    low = F.greatest(a - NEAR, F.lit(0))
    return F.substring(text, low + 1, F.least(b + NEAR, F.length(text)) - low)


def neighbours(entities: DataFrame) -> DataFrame:
    """Ordered pairs of one document's entities at most 200 characters apart.

    An equi-join on the document with the distance beside it; a document's entities are
    on the same partition already.
    """
    pick = ["place", "type", "value", "start_pos", "end_pos"]
    a = entities.select("ord", "id", *[F.col(c).alias(f"a_{c}") for c in pick])
    b = entities.select(F.col("ord").alias("_ord"), F.col("id").alias("_id"), *[F.col(c).alias(f"b_{c}") for c in pick])
    gap = (F.col("a_start_pos") - F.col("b_end_pos") <= NEAR) & (F.col("b_start_pos") - F.col("a_end_pos") <= NEAR)
    return a.join(b, (F.col("id") == F.col("_id")) & (F.col("ord") == F.col("_ord")) & (F.col("a_place") != F.col("b_place")) & gap).drop("_id", "_ord")


def _first_hit(kind: str, window: Column) -> Column:
    out = None
    for rx, confidence in pat.TRIGGERS[kind]:
        out = F.when(window.rlike(rx), F.lit(confidence)) if out is None else out.when(window.rlike(rx), F.lit(confidence))
    return out


def _fallback(kind: str, low: Column) -> Column:
    """The confidence of words that carry a relation when no trigger does; ``low`` is the lower-cased window."""
    found = F.lit(False)
    for word in pat.FALLBACK[kind]:
        found = found | F.contains(low, F.lit(word))
    return F.when(found, F.lit(0.5))


def _candidates(a: Column, b: Column) -> Column:
    """The rules that the types of two near entities allow, as structs; those of phase one in turn."""
    ta, tb = a["type"], b["type"]
    none = F.lit(None).cast("int")

    def rule(phase: int, turn: int, kind: str, source: Column, target: Column, evidence: tuple[Column, Column], cve: Column | None = None) -> Column:
        other = source if cve is target else target
        low, high = (F.least(a["start_pos"], b["start_pos"]), F.greatest(a["end_pos"], b["end_pos"])) if phase == 1 else (a["start_pos"], a["end_pos"])
        around = (none, none, none, none) if cve is None else (cve["start_pos"], cve["end_pos"], other["start_pos"], other["end_pos"])
        fields = dict(
            phase=F.lit(phase), turn=F.lit(turn), type=F.lit(kind), i=a["place"], j=b["place"], source=source["value"], source_type=source["type"], target=target["value"], target_type=target["type"],
            low=low, high=high, cve_start=around[0], cve_end=around[1], other_start=around[2], other_end=around[3], said_from=evidence[0], said_to=evidence[1],
        )
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    def span(x: Column, y: Column) -> tuple[Column, Column]:
        return x["start_pos"], y["end_pos"]

    things, places = lambda t: t.isin(*THINGS), lambda t: t.isin("organization", "system")
    is_cve, is_org, is_malware = (lambda t, k=k: t == k for k in ("cve_id", "organization", "malware"))
    rules = [
        F.when(is_cve(ta) & things(tb), rule(1, 1, "exploits", b, a, span(a, a), a)),
        F.when(is_cve(tb) & things(ta), rule(1, 1, "exploits", a, b, span(b, b), b)),
        F.when(is_org(ta) & is_malware(tb), rule(1, 1, "uses", a, b, span(a, b))),
        F.when(is_org(tb) & is_malware(ta), rule(1, 1, "uses", b, a, span(b, a))),
        F.when(is_org(ta) & places(tb), rule(1, 1, "targets", a, b, span(a, b))),
        F.when(is_org(tb) & (ta == "system"), rule(1, 1, "targets", b, a, span(b, a))),
        F.when(is_malware(ta) & is_malware(tb), rule(1, 1, "drops", a, b, span(a, b))),
        F.when(is_cve(ta) & places(tb), rule(1, 2, "affects", a, b, span(a, b), a)),
        F.when(is_cve(tb) & places(ta), rule(1, 2, "affects", b, a, span(b, a), b)),
        F.when(is_cve(ta) & things(tb), rule(2, 1, "exploits", b, a, span(a, a), a)),
        F.when(places(ta) & is_org(tb), rule(3, 1, "targets", b, a, span(b, a))),
    ]
    return F.array_compact(F.array(*rules))


def candidates(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """One row for every ordered pair of near entities and every rule that may apply to it, beside the content."""
    entity = F.struct("place", "type", "value", "start_pos", "end_pos")
    rows = entities.groupBy("ord", "id").agg(F.array_sort(F.collect_list(entity)).alias("es"))

    def near(a: Column) -> Column:
        others = F.filter("es", lambda b: (a["place"] != b["place"]) & (a["start_pos"] - b["end_pos"] <= NEAR) & (b["start_pos"] - a["end_pos"] <= NEAR))
        return F.flatten(F.transform(others, lambda b: _candidates(a, b)))

    each = rows.select("ord", "id", F.flatten(F.transform("es", near)).alias("c")).where(F.size("c") > 0).join(docs.select("id", "content"), "id")
    return each.select("ord", "id", "content", F.explode("c").alias("c")).select("ord", "id", "content", "c.*")


def relations(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """All phases, one row of each (type, source, target), the first.

    Phase one takes for each ordered pair the first rule that gives a relation; phases two and
    three take a trigger near one entity and the first neighbour that fits.
    """
    text, kind = F.col("content"), F.col("type")
    rows = candidates(docs, entities).withColumn("window", window_of(text, F.col("low"), F.col("high")))
    rows = rows.withColumn("low_window", F.lower("window"))
    w, low = F.col("window"), F.col("low_window")
    weak = F.lit(False)
    for rx, confidence in pat.TRIGGERS["exploits"]:
        if confidence == 0.6:
            weak = weak | w.rlike(rx)
    found = F.when((F.col("phase") == 2), F.when(weak, 0.6)).when(F.col("phase") == 3, F.when(w.rlike(pat.IMPLICIT_TARGET), 0.6))
    for name in pat.TRIGGERS:
        found = found.when(kind == name, F.coalesce(_first_hit(name, w), _fallback(name, low)))
    hit = rows.withColumn("confidence", found).where("confidence IS NOT NULL").drop("window", "low_window")
    inside = F.col("cve_start").isNull() | ((F.col("other_start") >= left_edge(text, F.col("cve_start"))) & (F.col("other_end") <= right_edge(text, F.col("cve_end"))))
    hit = hit.where(inside)
    first = Window.partitionBy("ord", "id", "phase", "i", F.when(F.col("phase") == 1, F.col("j"))).orderBy("j", "turn")
    same = Window.partitionBy("ord", "id", "type", "source", "target").orderBy("phase", "i", "j")
    kept = hit.withColumn("nth", F.row_number().over(first)).where("nth = 1").withColumn("nth", F.row_number().over(same)).where("nth = 1")
    kept = kept.withColumn("evidence", between(text, F.col("said_from"), F.col("said_to")))
    place = F.row_number().over(Window.partitionBy("ord", "id").orderBy("phase", "i", "j"))
    return kept.withColumn("place", place).select("ord", "id", "type", "source", "source_type", "target", "target_type", "evidence", "confidence", "place", F.lit("rule_based").alias("method"))
