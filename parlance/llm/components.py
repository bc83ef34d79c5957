"""Connected components and whole near-duplicate linking inside buckets, in DataFrame operations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import sized, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Nodes of an edge table with the smallest node of their component: columns ``id, root``.

    Alternating star contraction: in the large-star step every node points its larger
    neighbours to its smallest one, in the small-star step its smaller neighbours and itself.
    The number of rounds grows with the logarithm of the longest path.  Each round writes its
    (shrinking) edge table to the shared folder.  Null ends and loops are ignored; an empty
    edge table gives no rows.
    """
    e = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .where((F.col("u") != F.col("v"))).distinct())

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = mark(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = written(e.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u")
                        .select(F.col("w").alias("u"), F.col("m").alias("v"))
                        .unionByName(e.join(low, "u").select("u", F.col("m").alias("v")))
                        .where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = written(large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
                    .unionByName(low.select("u", F.col("m").alias("v")))
                    .where("u != v").distinct())
        now = mark(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return written(roots.unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()))


def hamming(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y))


def linked_components(members: DataFrame, max_bits: int,
                      verify: Callable[[DataFrame], DataFrame] | None = None,
                      near: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Components of the graph "shares a bucket, differs in at most ``max_bits``, passes ``verify``".

    ``members``: ``key`` (bucket), ``id``, ``fp`` (64-bit fingerprint), with ``near`` also ``len``.
    ``near`` must hold for the lengths of every pair that ``verify`` passes; pairs for which it does
    not hold are not made.  Returns ``id, root`` for the ids that have a link.  The result equals
    that of comparing every pair of a bucket, but members known to be of one component are not
    compared:

    1. every member is compared with the first member of its bucket, with ``near`` also with the
       next shorter one (one or two pairs per row), and the links found are contracted to components;
    2. only buckets that still hold several components go on; there the rows outside the bucket's
       largest component are compared with the rows of the other components.  Two rows of one
       component need no comparison, whatever it would say.

    Step 1 compares all pairs of a bucket of two members (three with ``near``), so only the rows of larger
    buckets are written for step 2, and ``verify`` gets a written table in which no pair comes a second time.
    Buckets are sorted, never collected; a bucket of near copies falls into one component in step
    1 and emits nothing in step 2.  Members of a bucket that ``verify`` does not link are compared
    pair by pair there: nothing short of the check itself can tell them apart.
    """
    cols = ["key", "id", "fp"] + ["len"] * bool(near)
    sides = ["hub", "shorter"] if near else ["hub"]
    in_key = Window.partitionBy("key").orderBy(*cols[3:], "id")
    shared = members.select(cols).withColumn("next", F.lead("id").over(in_key))
    for c in cols[1:]:
        shared = shared.withColumn(f"hub_{c}", F.first(c).over(in_key))
        if near:
            shared = shared.withColumn(f"shorter_{c}", F.lag(c).over(in_key))
    shared = shared.where("hub_id != id or next is not null")

    def close(with_: str) -> Column:
        alike = (F.col("id") != F.col(f"{with_}_id")) & (hamming(F.col("fp"), F.col(f"{with_}_fp")) <= max_bits)
        return alike & near(F.col("len"), F.col(f"{with_}_len")) if near else alike

    shared = shared.withColumn("open", F.count(F.lit(1)).over(Window.partitionBy("key")) > len(sides) + 1)
    shared = shared.select(*cols, "open", *[F.when(close(s), F.col(f"{s}_id")).alias(s) for s in sides])
    shared = written(shared.where(F.coalesce(*sides).isNotNull() | F.col("open")))
    check = verify or (lambda pairs: pairs)
    stars = None
    for s in sides:
        some = shared.where(F.col(s).isNotNull()).select(F.least("id", s).alias("a"), F.greatest("id", s).alias("b"))
        stars = some if stars is None else stars.unionByName(some)
    asked = written(stars.distinct())
    found = written(check(asked))
    comp = connected_components(found)

    rows = written(shared.where("open").select(cols).join(sized(comp), "id", "left")
                   .select(*cols, F.coalesce("root", "id").alias("c")))
    per = rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"))
    mixed = per.groupBy("key").agg(F.max_by("c", F.struct("n", "c")).alias("major"),
                                   F.count(F.lit(1)).alias("k")).where("k > 1").select("key", "major")
    open_rows = written(rows.join(mixed, "key"))
    minor = open_rows.where("c != major").select("key", F.col("id").alias("i"), F.col("fp").alias("f"),
                                                 F.col("c").alias("d"), *[F.col(c).alias("l") for c in cols[3:]])
    pairs = (minor.join(open_rows, "key")
             .where("c != d and (c = major or i < id)")
             .where(hamming(F.col("fp"), F.col("f")) <= max_bits)
             .where(near(F.col("len"), F.col("l")) if near else F.lit(True))
             .select(F.least("i", "id").alias("a"), F.greatest("i", "id").alias("b")).distinct())
    more = written(check(written(pairs.join(asked, ["a", "b"], "left_anti"))))
    if more.isEmpty():
        return comp
    known = comp.where("id != root").select(F.col("root").alias("a"), F.col("id").alias("b"))
    return connected_components(known.unionByName(more.select("a", "b")))
