"""Prefix trie of conversations and its subtree totals by parallel tree contraction (DataFrame operations).

Nothing walks a conversation turn by turn: prefixes are named by running XORs of 128-bit hashes of (position,
turn), computed in sorted blocks with one carry a block, so one conversation may hold a third of all
rows.  Totals need a number of rounds that grows with the logarithm of the nodes, also for one long chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import sized, written


def _sorted_blocks(df: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows dealt by (group, order) into sorted blocks, and a row per (block, group): ``__n`` rows, ``__before`` of
    the group in earlier blocks, ``__total`` rows of the group.  The rows get ``__pid`` and a dense ``__pos`` in
    their group.  Equal rows are dealt to several blocks too."""
    keys = [F.col(group).asc(), *[F.col(o).asc_nulls_first() for o in order], F.rand(11)]
    s = df.withColumn("__salt", F.rand(11)).repartitionByRange(*[*keys[:-1], F.col("__salt")]) \
        .sortWithinPartitions(*[*keys[:-1], F.col("__salt")]).drop("__salt") \
        .withColumn("__pid", F.spark_partition_id()).withColumn("__mid", F.monotonically_increasing_id())
    s = written(s)
    stats = s.groupBy("__pid", group).agg(F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(group).orderBy("__pid")
    stats = stats.withColumn("__before", F.coalesce(F.sum("__n").over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("__total", F.sum("__n").over(Window.partitionBy(group)))
    stats = written(stats)
    rows = s.join(stats, ["__pid", group]).withColumn("__pos", F.col("__mid") - F.col("__first") + F.col("__before"))
    return rows.drop("__mid", "__first"), stats


def ordered_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """Narrow turn rows ``c, r, digest, chars``: position from 0, a SHA-256 of role and text, code points of the text.

    Ordered by turn (null first), equal turns by role and text digest.  Null roles and texts are empty, rows without a
    conversation id belong to none.
    """
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    t = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("c"), F.col(turn).alias("__turn"), who.alias("__role"),
        F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)).alias("digest"),
        F.length(said).cast("long").alias("chars"))
    rows, _ = _sorted_blocks(t, "c", ["__turn", "__role", "digest"])
    return rows.select("c", F.col("__pos").alias("r"), "digest", "chars")


def prefix_rows(turns: DataFrame) -> DataFrame:
    """Rows of ``c, r, digest, chars`` with the prefix they end: ``c, depth, p1, p2`` (its name), ``q1, q2`` (that of
    the prefix before it), ``chars`` and ``is_end`` (the conversation's last turn)."""
    rows, stats = _sorted_blocks(turns, "c", ["r"])
    x = rows.select("__pid", "c", "__pos", "__total", "chars", *[
        F.xxhash64("digest", F.col("__pos").cast("long"), F.lit(seed)).alias(f"x{seed}") for seed in (1, 2)])
    w = Window.partitionBy("__pid", "c").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    x = written(x.select("*", F.bit_xor("x1").over(w).alias("l1"), F.bit_xor("x2").over(w).alias("l2")))
    # only conversations that cross a block's edge need a carry: at most one row a block
    crossing = written(stats.where("__total > __n").select("__pid", "c"))
    before = Window.partitionBy("c").orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = x.join(sized(crossing), ["__pid", "c"]).groupBy("__pid", "c").agg(
        F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"))
    carry = written(carry.select("__pid", "c", F.bit_xor("b1").over(before).alias("k1"),
                                 F.bit_xor("b2").over(before).alias("k2")))
    j = x.join(sized(carry), ["__pid", "c"], "left")
    for k in "12":
        j = j.withColumn(f"p{k}", F.col(f"l{k}").bitwiseXOR(F.coalesce(F.col(f"k{k}"), F.lit(0))))
    return j.select("c", (F.col("__pos") + 1).alias("depth"), "p1", "p2",
                    F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"),
                    "chars", (F.col("__pos") + 1 == F.col("__total")).alias("is_end"))


def subtree_totals(nodes: DataFrame, ids: Sequence[str], parents: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``ids`` and, for each of ``values``, its sum over the node's subtree (``total_<value>``).

    Parallel tree contraction.  A round rakes all leaves (their sums are whole and go to their parents, added
    up before the shuffle) and compresses unary chains: a node with one child left is taken out if its coin is
    heads and that of its child, if unary too, is not; the child then hangs on its grandparent and carries what the
    taken node would have added.  No two neighbours are taken in a round, all joins are one to one.  Afterwards the rounds are
    re-expanded backwards: a taken node's total is its own sum, its child's carry and its child's total.
    ``parents`` are null for roots; every parent must be a node; any number of trees; an empty table gives no rows.
    """
    spark = nodes.sparkSession
    ids, parents, n = list(ids), list(parents), range(len(values))
    kids_of = nodes.where(F.col(parents[0]).isNotNull()).groupBy(*[F.col(p).alias(i) for p, i in zip(parents, ids)]) \
        .agg(F.count(F.lit(1)).alias("kids"))
    live = written(nodes.join(kids_of, ids, "left").select(
        *ids, *parents, F.coalesce("kids", F.lit(0)).alias("kids"),
        *[F.coalesce(F.col(v), F.lit(0)).cast("long").alias(f"acc{j}") for j, v in enumerate(values)],
        *[F.lit(0).cast("long").alias(f"carry{j}") for j in n]))
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    number = 0
    while True:
        leaves = live.where("kids = 0").select(*ids, *[F.col(f"acc{j}").alias(f"total{j}") for j in n])
        raked = live.where(F.col(parents[0]).isNotNull()).groupBy(*[F.col(p).alias(i) for p, i in zip(parents, ids)]).agg(
            F.count_if(F.col("kids") > 0).alias("left"),
            *[F.min(F.when(F.col("kids") > 0, F.col(i))).alias(f"child_{i}") for i in ids],
            *[F.coalesce(F.sum(F.when(F.col("kids") == 0, F.col(f"acc{j}") + F.col(f"carry{j}"))), F.lit(0)).alias(f"in{j}")
              for j in n])
        # min per id column is the child itself where one is left
        inner = written(live.where("kids > 0").join(raked, ids).select(
            *ids, *parents, F.col("left").alias("kids"), *[f"child_{i}" for i in ids],
            *[(F.col(f"acc{j}") + F.col(f"in{j}")).alias(f"acc{j}") for j in n], *[f"carry{j}" for j in n]))
        if inner.isEmpty():
            rounds.append((leaves, None))
            break
        heads = F.pmod(F.xxhash64(*ids, F.lit(number)), F.lit(2)) == 1
        inner = inner.withColumn("__take", (F.col("kids") == 1) & F.col(parents[0]).isNotNull() & heads)
        v = inner.where("__take").select(
            *[F.col(i).alias(f"v_{i}") for i in ids], *[F.col(p).alias(f"v_{p}") for p in parents],
            *[F.col(f"child_{i}").alias(i) for i in ids], *[F.col(f"acc{j}").alias(f"v_acc{j}") for j in n],
            *[F.col(f"carry{j}").alias(f"v_carry{j}") for j in n])
        taken = written(v.join(inner.where(~F.col("__take")).select(*ids, *[f"carry{j}" for j in n]), ids).select(
            *ids, *[f"v_{i}" for i in ids], *[f"v_{p}" for p in parents],
            *[(F.col(f"v_acc{j}") + F.col(f"carry{j}")).alias(f"off{j}") for j in n],
            *[(F.col(f"v_acc{j}") + F.col(f"v_carry{j}") + F.col(f"carry{j}")).alias(f"new_carry{j}") for j in n]))
        gone = sized(taken.select(*[F.col(f"v_{i}").alias(i) for i in ids]))
        hung = sized(taken.select(*ids, F.lit(True).alias("__hung"), *[f"v_{p}" for p in parents],
                                  *[f"new_carry{j}" for j in n]))
        live = written(inner.join(gone, ids, "left_anti").join(hung, ids, "left").select(
            *ids, *[F.when(F.col("__hung"), F.col(f"v_{p}")).otherwise(F.col(p)).alias(p) for p in parents], "kids",
            *[f"acc{j}" for j in n],
            *[F.coalesce(f"new_carry{j}", f"carry{j}").alias(f"carry{j}") for j in n]))
        rounds.append((leaves, taken))
        number += 1
    known: list[DataFrame] = []
    for leaves, taken in reversed(rounds):
        piece = leaves
        if taken is not None:
            later = known[0]
            for k in known[1:]:
                later = later.unionByName(k)
            piece = leaves.unionByName(taken.join(later, ids).select(
                *[F.col(f"v_{i}").alias(i) for i in ids],
                *[(F.col(f"off{j}") + F.col(f"total{j}")).alias(f"total{j}") for j in n]))
        known.append(written(piece))
    out = known[0]
    for k in known[1:]:
        out = out.unionByName(k)
    return out.select(*ids, *[F.col(f"total{j}").alias(f"total_{v}") for j, v in enumerate(values)])


def prefix_trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie of turn rows ``c, r, digest, chars`` (dense or not in ``r``) of the conversations ``convs`` (``c``).

    Nodes: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``.  Ends: ``conv_id, depth`` of a node and ``c`` of each conversation that ends there.
    Conversations without turns end at the root; without conversations there is no node, not even the root.
    """
    rows = written(prefix_rows(turns))
    name = ["depth", "p1", "p2"]
    named = written(rows.groupBy(*name).agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min(
        "chars").alias("chars"), F.min("q1").alias("q1"), F.min("q2").alias("q2")))
    root = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("p1"),
        F.lit(0).cast("long").alias("p2"), "n_convs", F.lit(0).cast("long").alias("chars"))
    above = named.select("conv_id", *name).unionByName(root.select("conv_id", *name)).select(
        F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"),
        F.col("p2").alias("q2"))
    nodes = named.join(above, ["depth", "q1", "q2"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "chars", "p1", "p2").unionByName(root.select(
            "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "chars", "p1", "p2"))
    up = (F.col("depth") - 1).alias("depth")
    children = named.join(above, ["depth", "q1", "q2"]).groupBy(F.col("parent_conv_id").alias("conv_id"), up).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, ["conv_id", "depth"], "left").select(
        "*", F.coalesce("n_children", F.lit(0)).alias("__kids")).drop("n_children").withColumnRenamed("__kids", "n_children"))
    totals = subtree_totals(nodes.select(
        "conv_id", "depth", "parent_conv_id", F.when(F.col("depth") > 0, F.col("depth") - 1).alias("parent_depth"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")),
        ["conv_id", "depth"], ["parent_conv_id", "parent_depth"], ["n_leaves", "saved_tokens"])
    out = nodes.join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("total_n_leaves").alias("n_leaves"),
        F.col("total_saved_tokens").alias("saved_tokens"))
    last = rows.where("is_end").select("c", *name)
    silent = convs.select("c").join(last.select("c"), "c", "left_anti").select(
        "c", *[F.lit(0).cast("long").alias(k) for k in name])
    ends = last.unionByName(silent).join(nodes.select("conv_id", *name), name).select("conv_id", "depth", "c")
    return out, ends


def rebuilt_turns(turns: DataFrame, family: int = 100, shared: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turn rows after each conversation c took its first h turns from conversation c - c % ``family``
    (h = crc32 of the decimal id modulo ``shared``), and the table of all ids ``c``."""
    turns = written(turns)
    convs = written(turns.select("c").distinct())
    h = F.crc32(F.col("c").cast("string")) % shared
    heads = turns.where((F.col("c") % family == 0) & (F.col("r") < shared - 1)).withColumnRenamed("c", "__base")
    taken = convs.select("c", (F.col("c") - F.col("c") % family).alias("__base"), h.alias("__h")).join(
        heads, "__base").where("r < __h").select("c", "r", "digest", "chars")
    return taken.unionByName(turns.where(F.col("r") >= h)), convs


def node_digests(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes with ``ends_sha256``: SHA-256 of the ascending decimal ids that end there, comma-joined.

    One digest needs its list in order, so the ids (8 bytes each, no texts) of one node meet in one task.
    """
    lists = ends.groupBy("conv_id", "depth").agg(F.sort_array(F.collect_list("c")).alias("__ids"))
    digest = F.sha2(F.array_join(F.col("__ids").cast("array<string>"), ","), 256)
    return nodes.join(lists, ["conv_id", "depth"], "left").select(
        *nodes.columns, F.coalesce(digest, F.sha2(F.lit(""), 256)).alias("ends_sha256"))
