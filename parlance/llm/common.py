"""Helpers shared by the corpus operators: tables on the shared folder, size-checked joins, barriers.

Column names that the operators create for themselves start with ``__``; input
tables are reduced to the columns an operator needs before anything is added, so
extra input columns (also ones named like an output) cannot clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: a word: a run of characters other than space and \x09-\x0D
WORD = r"[^\x20\x09-\x0D]+"
#: largest in-memory size of a side that is sent to every executor
MAX_BROADCAST_BYTES = 24 * 1024 * 1024


def workspace(spark: SparkSession) -> str:
    """Folder for written tables, under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/parlance-{spark.sparkContext.applicationId}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder once and read it back: cuts the lineage.

    Every later use reads the same files, so a lost executor costs a re-read and not
    a recomputation, and Spark knows the table's size.  A table at ``path`` is written over.
    """
    spark = df.sparkSession
    path = path or f"{workspace(spark)}/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def barrier(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A plain projection may be inlined into a later lambda function and evaluated once per
    array element; the one-row generator in between keeps Catalyst from doing that.
    """
    keep = [c for c in df.columns if c not in cols]
    made = F.struct(*[v.alias(k) for k, v in cols.items()])
    return df.select(*keep, F.explode(F.array(made)).alias("__m")).select(
        *keep, *[F.col(f"__m.{k}").alias(k) for k in cols])


def in_memory_bytes(df: DataFrame) -> int:
    """Size of a written table's rows, counted exactly for strings and arrays of longs."""
    per_row = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            per_row = per_row + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, T.ArrayType):
            per_row = per_row + F.greatest(F.size(c), F.lit(0)) * 16 + 24
        else:
            per_row = per_row + 16
    return int(df.agg(F.coalesce(F.sum(per_row.cast("long")), F.lit(0)).alias("b")).first()["b"])


def sized(small: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of a written table only when its counted size is within ``max_bytes``.

    Beyond it the join is left to Spark (a shuffle join, split by AQE when keys are skewed).
    """
    return F.broadcast(small) if in_memory_bytes(small) <= max_bytes else small


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Keep Arrow batches of texts small: at most ``rows`` texts are in a Python worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def word_array(text: Column) -> Column:
    """Words of a text; null and blank texts give an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def with_columns_replaced(df: DataFrame, names: list[str]) -> list[str]:
    """Input columns other than ``names`` (compared without case): operator columns replace them."""
    low = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in low]
