"""Small helpers that several training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch. Texts can be long; a batch of ten thousand may not fit.
BATCH_ROWS = 2000
#: Whether Spark removes the shuffle files of a finished query at once.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session_limits(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for the Python workers' memory."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; one of our own only in local mode, where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="hazeline-")
        spark.sparkContext.setCheckpointDir(named)
        _files(spark, named, lambda fs, at: fs.deleteOnExit(at))
    return named.rstrip("/")


def _files(spark: SparkSession, path: str, act) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    act(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at)


def written(df: DataFrame, name: str, instead_of: DataFrame | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, outlives executors.

    The write's own shuffle files go as soon as it is done, and the table itself when the
    driver's JVM ends. ``instead_of`` is an earlier table that nothing reads any more.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/hazeline-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _files(spark, path, lambda fs, at: fs.deleteOnExit(at))
    if instead_of is not None:
        discarded(instead_of)
    out = spark.read.schema(df.schema).parquet(path)
    out._hazeline_path = path
    return out


def discarded(df: DataFrame) -> None:
    """Delete a table of ``written`` that nothing reads any more."""
    _files(df.sparkSession, df._hazeline_path, lambda fs, at: fs.delete(at, True))


def free(columns: list[str], name: str) -> str:
    """``name``, or the first of name_1, name_2 .. that no column has; case does not count."""
    taken, out, n = {c.lower() for c in columns}, name, 0
    while out.lower() in taken:
        n += 1
        out = f"{name}_{n}"
    return out


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``most_bytes``; one longer text goes alone."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if i > start and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_columns(df: DataFrame, text: str = "text") -> tuple[DataFrame, str, str]:
    """``df`` with two columns more, and their names: a total, null-free document identity.

    Documents without an id stand behind all others, under a hash of their text.
    """
    last, key = free(df.columns, "_noid"), free(df.columns, "_id")
    return df.withColumns({last: F.col("doc_id").isNull(), key: F.coalesce("doc_id", F.xxhash64(text))}), last, key
