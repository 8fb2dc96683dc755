"""Session settings and the two rules every operator shares: where data may be
written, and when a side of a join may be broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows a broadcast side may have.  A row here is one term with its statistics
# (well under 200 bytes), so the hash table stays below about 100 MB.
BROADCAST_ROWS = 500_000

# The same for rows that carry one number per class.
BROADCAST_CELLS = 10_000_000

# Classes are turned into array positions, so their number has to be bounded.
MAX_CLASSES = 10_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lexispark")
        .config("spark.driver.memory", memory)
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can see, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    fallback = tempfile.mkdtemp(prefix="lexispark-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For tables that several jobs or branches read: the work is done once, the lineage
    ends, and losing an executor loses nothing.
    """
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Give every core a part of a table that has fewer splits than there are cores.

    For work that is heavy per byte.  A large table has more splits and is left alone.  ``scan`` should
    be a stored table, so that asking for its splits runs nothing.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


def bounded_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast hint for a side whose row bound is known from its parameters.

    Above the limit no hint is given and the join shuffles.
    """
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Count at most ``limit + 1`` rows to see whether ``df`` may be broadcast."""
    return df.limit(limit + 1).count() <= limit


def class_values(df: DataFrame, label: str) -> list:
    """The distinct labels in order; their number is checked before it is used."""
    found = df.select(label).where(F.col(label).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label!r}")
    return sorted(row[0] for row in found)
