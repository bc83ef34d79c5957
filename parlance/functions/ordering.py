"""Distributed dense ordinal (S10) without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_LOCAL_BITS = 33


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on group keys that may be null: null keys meet null keys, as they do in ``groupBy``.

    Columns of ``left`` first, then those of ``right`` without the keys (in a full join the keys of either side).
    """
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    j = left.join(r, cond, how)
    if how in ("full", "full_outer", "right"):
        for k in keys:
            j = j.withColumn(k, F.coalesce(k, f"__r_{k}"))
    return j.drop(*[f"__r_{k}" for k in keys])


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Add, per ``keys`` group (null keys are a group), the sum of each expression over the rows before a row.

    Rows are dealt by (keys, ``order``) into sorted partitions, checkpointed once (in
    ``spark.checkpoint.dir``); sums run inside a partition's share of a group, and one row per (partition, group)
    carries them on.  So a group may hold all rows without meeting in one task.  ``order`` is ascending with nulls
    first; ties get an arbitrary but fixed order.  The whole rows are moved once: pass narrow ones.
    """
    from ..session import ensure_checkpoint_dir
    keys = list(keys)
    ensure_checkpoint_dir(df.sparkSession)
    dealt = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    s = df.select("*", *[e.cast("long").alias(f"__v_{n}") for n, e in sums.items()]) \
        .repartitionByRange(*dealt).sortWithinPartitions(*dealt) \
        .withColumn("__at", F.monotonically_increasing_id()).checkpoint(eager=True)
    s = s.withColumn("__part", F.shiftright("__at", _LOCAL_BITS))
    share = ["__part", *keys]
    local = Window.partitionBy(*share).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("*", *[F.coalesce(F.sum(f"__v_{n}").over(local), F.lit(0)).alias(f"__l_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = s.groupBy(*share).agg(*[F.sum(f"__v_{n}").alias(f"__s_{n}") for n in sums]).select(
        *share, *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__c_{n}") for n in sums])
    j = join_groups(s, carried, share)
    return j.select(*df.columns, *[(F.col(f"__l_{n}") + F.col(f"__c_{n}")).alias(n) for n in sums])


def session_order(prefix: str = "") -> list[Column]:
    """Sort key of sessions: date (nulls last), number with 0 as missing (nulls last), name, key."""
    p = prefix
    return [F.col(f"{p}session_date").asc_nulls_last(),
            F.nullif(F.col(f"{p}session_number"), F.lit(0)).asc_nulls_last(),
            F.col(f"{p}file_name").asc_nulls_last(),
            F.col(f"{p}session_key").asc()]


SESSION_ORDER_COLS = ("session_date", "session_number", "file_name", "session_key")


def dense_index(df: DataFrame, order: Sequence[Column], name: str = "transcript_idx",
                partition_cols: Sequence[str] = (), key: str = "session_key",
                order_cols: Sequence[str] = SESSION_ORDER_COLS) -> DataFrame:
    """Add a 0-based row number in ``order`` (per ``partition_cols`` group).

    A global ``row_number()`` moves every row into one task.  Instead: a
    range-partitioned sort of the narrow key table (distributed), positions
    inside each sorted partition from ``monotonically_increasing_id`` (no
    shuffle), and the offset of each (partition, group) from a prefix sum
    over one row per (partition, group), joined back.  The sorted key table
    is checkpointed (reliable, in ``spark.checkpoint.dir``) so the partition
    numbering is computed once: every later use -- the offsets and the rows
    -- reads the same materialised partitions, even if a plan above it is
    re-executed or re-planned.  The index is then joined back on ``key``
    (unique per row); ``order_cols`` names the columns ``order`` reads.
    """
    from ..session import ensure_checkpoint_dir
    keys = list(partition_cols)
    needed = sorted({key, *keys, *order_cols})
    narrow = df.select(*needed)
    s = narrow.orderBy(*[F.col(k).asc() for k in keys], *order)
    s = s.withColumn("_mid", F.monotonically_increasing_id())
    ensure_checkpoint_dir(df.sparkSession)
    s = s.checkpoint(eager=True)
    s = s.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS)) \
         .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
    stats = s.groupBy("_pid", *keys).agg(F.min("_loc").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    if not keys:
        stats = F.broadcast(stats)  # one row per sorted partition: bounded by the partition count
    j = join_groups(s, stats.select("_pid", *keys, "_first", "_off"), ["_pid", *keys])
    idx = j.select(key, (F.col("_off") + F.col("_loc") - F.col("_first")).alias(name))
    return df.join(idx, key)


def rank_within(df: DataFrame, keys: Sequence[str], idx: str, name: str = "_rank",
                count_name: str = "_n", block: int = 1024) -> DataFrame:
    """1-based rank of ``idx`` inside each ``keys`` group, plus the group size.

    Skew-safe: no window spans a whole group.  Rows are ranked inside blocks
    of ``block`` consecutive index values (window per (group, block), at most
    ``block`` rows); each block's offset is a prefix sum over the per-block
    counts (one row per block, partially aggregated).  A group holding a third
    of all rows is spread over many blocks and tasks.  ``idx`` must be unique
    and non-negative within a group; ``name`` must not be ``_r``/``_blk``/``_key``/``_before``
    (internal columns).
    """
    keys = list(keys)
    # the window and the join share one key, so the rows are shuffled once; a struct of null keys equals another
    d = df.withColumn("_blk", F.floor(F.col(idx) / block))
    d = d.withColumn("_key", F.struct(*keys, "_blk"))
    c = d.groupBy("_key").agg(F.count(F.lit(1)).alias("_c")).select("_key", *[F.col("_key")[k].alias(k) for k in keys],
                                                                   F.col("_key._blk").alias("_blk"), "_c")
    wb = Window.partitionBy(*keys).orderBy("_blk")
    c = c.withColumn("_before", F.coalesce(F.sum("_c").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                                           F.lit(0))) \
         .withColumn(count_name, F.sum("_c").over(Window.partitionBy(*keys)))
    r = d.withColumn("_r", F.row_number().over(Window.partitionBy("_key").orderBy(idx)))
    j = r.join(c.select("_key", "_before", count_name), "_key")
    return j.select(*df.columns, count_name, (F.col("_before") + F.col("_r")).alias(name))


def with_offsets(ranked: DataFrame, keys: Sequence[str], rank_col: str, cols: Sequence[str],
                 offsets: Sequence[int]) -> DataFrame:
    """Attach ``cols`` of the row at ``rank + o`` for each offset ``o`` as ``{col}_{m|p}{|o|}``.

    A skew-safe replacement for ``lag``/``lead`` over a group: equi-joins on
    (group keys, rank), so no window has to hold a whole group.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(ranked.sparkSession)
    # the table is read once per offset: materialise it once (narrow rows)
    ranked = ranked.checkpoint(eager=True)
    out = ranked
    for o in offsets:
        tag = f"{'m' if o < 0 else 'p'}{abs(o)}"
        nb = ranked.select(*keys, (F.col(rank_col) - o).alias(rank_col),
                           *[F.col(c).alias(f"{c}_{tag}") for c in cols])
        out = join_groups(out, nb, [*keys, rank_col], "left")
    return out
