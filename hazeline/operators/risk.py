"""Risk signals, score, tier and factors (Q01 to Q04) as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions import gates
from hazeline.functions import lexicon as lex
from hazeline.functions import patterns as pat

TIERS = ("critical", "high", "medium", "low")


def signals(rows: DataFrame) -> DataFrame:
    """Adds the ten signals to rows that hold content, conf_* and an entity summary
    (n_cves, n_ips, n_domains, n_hashes distinct, cvss array of doubles)."""
    rows = rows.withColumn("_text", F.coalesce("content", F.lit(""))).withColumn("_low", F.lower("_text"))
    text, low = F.col("_text"), F.col("_low")
    sure = lambda label: F.coalesce(F.col(f"conf_{label}") >= 0.3, F.lit(False))
    top = F.array_max("cvss")
    iocs = F.col("n_ips") + F.col("n_domains") + F.col("n_hashes")
    return rows.withColumns(
        {
            "exploit_available": sure("exploit") | gates.matches(text, low, lex.EXPLOIT_READY, pat.any_of(lex.EXPLOIT_READY)),
            "actively_exploited": gates.matches(text, low, lex.ACTIVE, pat.any_of(lex.ACTIVE)),
            "severity_critical": (gates.holds(low, ["critical"]) & gates.matches(text, low, ["vulnerability", "severity"], pat.CRITICAL)) | F.coalesce(top >= 9.0, F.lit(False)),
            "ransomware_mentioned": sure("ransomware"),
            "high_cvss": F.coalesce(top >= 7.0, F.lit(False)),
            "cvss_score": top,
            "ioc_density": F.when(iocs > 10, "high").when(iocs > 3, "medium").when(iocs > 0, "low").otherwise("none"),
            "cve_count": F.col("n_cves"),
            "hash_count": F.col("n_hashes"),
            "vulnerability_in_labels": sure("vulnerability"),
        }
    ).drop("_text", "_low")


def score() -> Column:
    on = lambda c, w: F.when(F.col(c), w).otherwise(0.0)
    density = F.when(F.col("ioc_density") == "high", 0.15).when(F.col("ioc_density") == "medium", 0.1).when(F.col("ioc_density") == "low", 0.05).otherwise(0.0)
    total = on("exploit_available", 0.15) + on("actively_exploited", 0.2) + on("severity_critical", 0.15) + on("ransomware_mentioned", 0.15) + on("high_cvss", 0.1)
    total = total + density + 0.05 * F.least("cve_count", F.lit(3)) + 0.02 * F.least("hash_count", F.lit(5))
    return F.round(F.least(total, F.lit(1.0)), 4)


def tier() -> Column:
    e, a, s, r = (F.col(c) for c in ("exploit_available", "actively_exploited", "severity_critical", "ransomware_mentioned"))
    return (
        F.when((a & (e | s)) | (r & e), "critical")
        .when(e | s | r | a, "high")
        .when(F.col("vulnerability_in_labels") | F.col("ioc_density").isin("medium", "high") | (F.col("cve_count") > 0), "medium")
        .otherwise("low")
    )


def factors() -> Column:
    cvss = F.col("cvss_score").cast("string")
    parts = [
        F.when(F.col("exploit_available"), "Exploit code or PoC available"),
        F.when(F.col("actively_exploited"), "Actively exploited in the wild"),
        F.when(F.col("severity_critical"), F.when(cvss.isNotNull(), F.concat(F.lit("Critical severity (CVSS "), cvss, F.lit(")"))).otherwise("Critical severity mentioned")),
        F.when(F.col("ransomware_mentioned"), "Ransomware activity mentioned"),
        F.when(F.col("high_cvss") & (F.col("cvss_score") < 9.0), F.concat(F.lit("High CVSS score ("), cvss, F.lit(")"))),
        F.when(F.col("ioc_density").isin("medium", "high"), F.concat(F.lit("Moderate to high IOC density ("), F.col("ioc_density"), F.lit(")"))),
        F.when(F.col("cve_count") > 0, F.concat(F.col("cve_count").cast("string"), F.lit(" CVE(s) referenced"))),
        F.when(F.col("hash_count") > 0, F.concat(F.col("hash_count").cast("string"), F.lit(" file hash(es) present"))),
    ]
    found = F.filter(F.array(*parts), lambda x: x.isNotNull())
    return F.when(F.size(found) == 0, F.array(F.lit("No high-impact signals detected"))).otherwise(found)


def assess(rows: DataFrame) -> DataFrame:
    """Signals, risk_score, risk_tier and contributing_factors added to ``rows``."""
    return signals(rows).withColumn("risk_score", score()).withColumn("risk_tier", tier()).withColumn("contributing_factors", factors())
