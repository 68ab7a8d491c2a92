"""Alert rules as data (A23, A24): each rule is a predicate and a message column."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANKS = {"critical": 0, "high": 1, "medium": 2, "low": 3}


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    severity: str
    holds: Callable[[], Column]
    message: Callable[[], Column]


def _title(n: int) -> Column:
    return F.substring(F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("id")), 1, n)


def _percent(c: Column) -> Column:
    return F.concat(F.round(c * 100, 0).cast("int").cast("string"), F.lit("%"))


def _label(name: str) -> Column:
    return F.coalesce(F.col(f"conf_{name}"), F.lit(0.0))


RULES = [
    Rule("risk_critical", "Critical risk tier", "critical", lambda: F.col("risk_tier") == "critical", lambda: F.concat(F.lit("Scored as critical risk: "), _title(120))),
    Rule("ransomware_high_confidence", "Ransomware (high confidence)", "high", lambda: _label("ransomware") >= 0.5, lambda: F.concat(F.lit("Ransomware confidence "), _percent(_label("ransomware")), F.lit(": "), _title(100))),
    Rule("cisa_kev_high_cvss", "CISA KEV with elevated CVSS", "high", lambda: (F.col("source") == "cisa_kev") & (F.try_to_number(F.get_json_object("metadata", "$.cvss.score"), F.lit("99.9")) >= 7), lambda: F.concat(F.lit("CISA KEV entry CVSS "), F.get_json_object("metadata", "$.cvss.score"), F.lit(": "), _title(100))),
    Rule("exploit_and_critical", "Exploit content at critical risk", "critical", lambda: (_label("exploit") >= 0.4) & (F.col("risk_tier") == "critical"), lambda: F.concat(F.lit("Exploit-labeled in critical tier: "), _title(100))),
    Rule("high_risk_score", "Very high risk score", "high", lambda: (F.col("risk_score") >= 0.85) & (F.col("risk_tier") != "critical"), lambda: F.concat(F.lit("Risk score "), _percent(F.col("risk_score")), F.lit(": "), _title(100))),
]


def alerts(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row for each document and rule that holds. The rules are an array inside each row, so nothing is joined or shuffled."""
    each = F.array(
        *[
            F.when(F.coalesce(r.holds(), F.lit(False)), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.lit(RANKS[r.severity]).alias("severity_rank"), F.lit(r.name).alias("name"), r.message().alias("summary")))
            for r in rules or RULES
        ]
    )
    created = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("collected_at", "published_at") if c in docs.columns], F.lit(""))
    rows = docs.select("id", created.alias("created_at"), F.explode(F.filter(each, lambda x: x.isNotNull())).alias("a"))
    return rows.select(F.concat_ws("::", "a.rule_id", "id").alias("alert_id"), "a.rule_id", F.col("id").alias("doc_id"), "a.severity", "a.severity_rank", F.col("a.name").alias("title"), "a.summary", "created_at")


def active(found: DataFrame, dismissed: DataFrame, rule_id: str | None = None, n: int | None = None) -> DataFrame:
    """Alerts that are not dismissed, by severity and newest first."""
    rows = found.join(dismissed, "alert_id", "left_anti")
    if rule_id:
        rows = rows.where(F.col("rule_id") == rule_id)
    rows = rows.orderBy("severity_rank", F.desc("created_at"), "alert_id")
    return rows.limit(n) if n else rows
