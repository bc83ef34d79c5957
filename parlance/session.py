"""Spark session helpers shared by the library, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def get_spark(master: str | None = None, app: str = "parlance",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on.

    The master and the driver's memory are set only when asked for, here or by PARLANCE_MASTER and
    PARLANCE_DRIVER_MEMORY: settings made in a program would override those of ``spark-submit``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    master = master or os.environ.get("PARLANCE_MASTER")
    if master:
        builder = builder.master(master)
    memory = os.environ.get("PARLANCE_DRIVER_MEMORY") or ("16g" if (master or "").startswith("local") else None)
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is used as is.  Only
    when it is unset and the master is local do we create one under the temp
    folder; on a cluster that folder would be another one on every machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="parlance-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan (an upper bound for local data and scans)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 -- no estimate available (e.g. remote session)
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when Catalyst's size estimate is within ``max_bytes``.

    Used for user-supplied dictionaries whose size is not known up front.  The estimate is an upper
    bound and costs no job; beyond the bound, or without an estimate, the join is left to Spark.
    """
    est = estimated_bytes(df)
    return F.broadcast(df) if est is not None and est <= max_bytes else df


def counted_bytes(df: DataFrame) -> int:
    """In-memory size of a table's rows, strings by their bytes and other values by 16: one pass over it."""
    per_row = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        per_row = per_row + (F.coalesce(F.octet_length(c), F.lit(0)) + 16 if f.dataType.typeName() == "string" else 16)
    return int(df.agg(F.coalesce(F.sum(per_row.cast("long")), F.lit(0))).first()[0])


def broadcast_dictionary(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of a dictionary that is within ``max_bytes``, by its counted size if need be.

    Catalyst knows no size of rows made in Python and takes them for the largest there is: every token would
    then be shuffled to meet a dictionary of ten rows.  So beyond the estimate the rows themselves are counted.  For
    tables that are cheap to read; a table derived from the corpus is left to ``broadcast_if_small``.
    """
    est = estimated_bytes(df)
    return F.broadcast(df) if (est is not None and est <= max_bytes) or counted_bytes(df) <= max_bytes else df


def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row, as literals.

    The aggregate is one small job; joining it instead would be a cross join
    (Catalyst folds a constant join key into a nested-loop join).
    """
    row = scalar.first()
    return df.select("*", *[F.lit(row[c]).alias(c) for c in scalar.columns])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the checkpoint folder once and read it back: what is read several times is computed once.

    Token lists of many distinct words outgrow Parquet's dictionary pages, so they are compressed harder than by default.
    """
    spark, schema = df.sparkSession, df.schema
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def broadcast_written(df: DataFrame, name: str, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Write a table derived from the corpus and hint its broadcast if its counted size is within ``max_bytes``.

    Catalyst takes such a table (joins, groups) for as large as what it is made of, and would shuffle every token to
    meet a vocabulary of a few thousand terms.
    """
    t = stored(df, name)
    return F.broadcast(t) if counted_bytes(t) <= max_bytes else t


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table; spread it over the cores when the scan is under-split.

    A file with a single row group is read by a single task.  When the scan
    yields fewer partitions than ``spark.default.parallelism`` we rebalance
    round-robin so per-row text work runs on every core; on a cluster scan
    splits far outnumber cores and this is a no-op.
    """
    df = spark.read.parquet(path)
    want = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        # Partitioning by a seeded random value (not round-robin) keeps
        # Catalyst from pushing costly text predicates below the rebalance
        # into the single scan task; the seed makes a recomputed partition
        # after a lost executor identical.
        df = df.repartition(want, F.rand(seed=17))
    return df
