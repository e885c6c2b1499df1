"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans rely on. Skewed joins are split even when that
# costs another exchange: one store or order may hold a third of all rows.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(app: str = "tillwork", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # a report is built from thousands of Column calls; do not record each call site
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TILLWORK_DRIVER_MEMORY", "8g"))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session built elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


_own_folder: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="tillwork-"))
    return _own_folder[0]


def written(df: DataFrame) -> DataFrame:
    """The frame as written to the reliable checkpoint folder; its lineage ends there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as Parquet files in the shared scratch folder, read back: computed once, and of a known size.

    All tables of an application lie in one folder, which can go when the application has ended.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tables/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def source_bytes(df: DataFrame) -> int:
    """Bytes of every table the frame is read from, by the optimizer's statistics; runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files that the frame will read, without the partitions its filters rule out; runs no job."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    nodes = [leaves.apply(i) for i in range(leaves.size())]
    return sum(n.selectedPartitions().totalFileSize() for n in nodes if n.getClass().getSimpleName() == "FileSourceScanExec")


# A bucket of this size is read by one task, as bucketed scans are not split.
BUCKET_BYTES = 128 * 1024 * 1024


@contextmanager
def written_by(df: DataFrame, column: str, buckets: int | None = None) -> Iterator[DataFrame]:
    """The frame as a table of the warehouse, bucketed by ``column``, while the context lasts; then table and files go.

    Later groupings that include the column need no exchange of its rows. The number of buckets follows
    from the size of the files the rows are read from, so the rows are written once.
    """
    spark = df.sparkSession
    if buckets is None:
        wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-scanned_bytes(df) // BUCKET_BYTES))
        buckets = min(wanted, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    name = f"tillwork_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, column)
        .write.bucketBy(buckets, column)
        .format("parquet")
        .saveAsTable(name)
    )
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
