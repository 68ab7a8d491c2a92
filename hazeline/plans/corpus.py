"""A threat corpus over the events table, in one SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ID_SQL = "CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 41 = 0 THEN concat('doc-', CAST(event_id - 1 AS STRING)) ELSE concat('doc-', CAST(event_id AS STRING)) END"
DOCS_SQL = f"""
SELECT
  event_id AS ord,
  {ID_SQL} AS id,
  CASE event_id % 6
    WHEN 0 THEN concat('Advisory ', CAST(user_id AS STRING)) WHEN 1 THEN 'Ransomware leak: Hive victim' WHEN 2 THEN 'Phishing kit spotted'
    WHEN 3 THEN 'APT29 report' WHEN 4 THEN NULL ELSE concat('Note ', CAST(event_id AS STRING)) END AS title,
  concat(
    CASE event_id % 8
      WHEN 0 THEN concat('LockBit exploits CVE-2023-', lpad(CAST(event_id % 97 + 1000 AS STRING), 5, '0'), ' in Microsoft Exchange. Proof of concept code is in the wild. ')
      WHEN 1 THEN 'Security update and advisory with remediation steps. CVSS: 9.8 and severity: critical for this vulnerability. '
      WHEN 2 THEN 'Lazarus uses Emotet while Emotet drops TrickBot on hosts. The threat actor ran a campaign against Cisco and Oracle. '
      WHEN 3 THEN 'Spoofed brand impersonation with a fake login page is a lure. Write to abuse@evil-mail.com now. '
      WHEN 4 THEN concat('Beacon traffic to C2 at 10.', CAST(event_id % 7 AS STRING), '.0.1, 10.', CAST(event_id % 11 AS STRING), '.0.2, 172.16.3.4 and 192.168.7.9 over badhost', CAST(event_id % 5 AS STRING), '.ru today. ')
      WHEN 5 THEN concat('Sample ', lpad(CAST(event_id % 9 AS STRING), 32, 'a'), ' with ', lpad(CAST(event_id % 13 AS STRING), 40, 'b'), ' and ', lpad(CAST(event_id % 5 AS STRING), 64, 'c'), '. ')
      WHEN 6 THEN concat('CVE-2024-', CAST(event_id % 31 + 20000 AS STRING), ' affects Apache Struts and is vulnerable to remote code execution. Score: 7.5 for all. ')
      ELSE 'Quarterly outlook without findings. ' END,
    CASE event_id % 5
      WHEN 0 THEN 'Attackers encrypt files and leave a ransom note on a data leak site. '
      WHEN 1 THEN 'See https://github.com/acme/exploit for exploit code. '
      WHEN 2 THEN 'Known exploited bug, actively exploited by a nation-state espionage team. '
      WHEN 3 THEN concat('Mail from user', CAST(user_id AS STRING), '@corp.example.org came in. ')
      ELSE '' END) AS content,
  concat('https://feeds.example.com/', event_type, '/', CAST(event_id AS STRING)) AS url,
  CASE event_id % 9 WHEN 0 THEN 'cisa_kev' WHEN 1 THEN 'exploitdb' WHEN 2 THEN 'mitre_attack' WHEN 3 THEN 'ransomwatch' WHEN 4 THEN 'phishtank' WHEN 5 THEN 'threatfox' WHEN 6 THEN 'nvd_ref' WHEN 7 THEN 'otx' ELSE 'exploitdb' END AS source,
  CASE event_id % 4 WHEN 0 THEN 'vulnerability' WHEN 1 THEN 'exploit' WHEN 2 THEN 'ransomware' ELSE NULL END AS source_category_hint,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS STRING) END AS published_at,
  CASE event_id % 10 WHEN 0 THEN 'unknown' WHEN 1 THEN '' ELSE concat(CAST(CAST(ts AS DATE) AS STRING), 'T08:00:00Z') END AS collected_at,
  props AS metadata
FROM events
"""

#: one row for each id, the first
UNIQUE_SQL = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) AS rn FROM ({DOCS_SQL}) d WHERE id IS NOT NULL AND id <> '') u WHERE rn = 1"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DOCS_SQL.replace("FROM events", "FROM {events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def unique_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``keep_first(docs)``; the rows are told apart while they are events, before their texts are made."""
    from hazeline.operators.corpus import keep_first

    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("id", F.expr(ID_SQL))
    return spark.sql(DOCS_SQL.replace("FROM events", "FROM {events}"), events=keep_first(events, "event_id").drop("id"))
