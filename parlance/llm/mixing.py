"""Mixing sources to target weights: Efraimidis-Spirakis sampling into token budgets.

Every source gets a target number of words.  Complete passes over a source come first; the rest
of its target is filled by weighted sampling without replacement: each document draws the
exponential key ``-ln(u) / weight`` (u from a hash of its id), documents are sorted by key and
taken while their prefix sum of sizes stays within the rest.

No source is sorted as a whole.  Keys fall into bins of about equal numbers of documents; sizes
are summed per bin, and only the one bin of a source in which the budget ends is sorted.  The
outcome is one cut-off per source, so documents (and their texts) are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, sized, with_columns_replaced, written

#: a source may be repeated so often at most
MAX_EPOCHS = 3
#: documents in a bin, about
BIN_ROWS = 50_000
#: weights of the sources by code point order, repeating
SOURCE_WEIGHTS = (1.0, 2.0, 3.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def clean_share(text: Column) -> Column:
    """Quality weight in (0, 1]: the share of characters that are no symbols; empty texts weigh 1."""
    n = F.length(text)
    rest = F.length(F.translate(text, "#*$%&|<>", ""))
    return F.when(n > 0, F.greatest(rest / n, F.lit(0.01))).otherwise(F.lit(1.0))


def source_targets(sources: DataFrame, total_share: float = 1.0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to a table of ``source, source_size, weight`` (one row per source).

    The share of all sizes is dealt by weight; a target stops at ``max_epochs`` times its source's
    size and the excess goes to the others by weight until none is above.  Sorted by cap per
    weight the sources at their cap come first, so the common level is found from prefix sums.
    """
    by_ratio = Window.orderBy("__ratio", "__rank")
    s = sources.withColumn("__cap", F.lit(float(max_epochs)) * F.col("source_size")) \
        .withColumn("__ratio", F.col("__cap") / F.col("weight"))
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("__total", total_share * F.sum("source_size").over(everything)) \
        .withColumn("__used", F.coalesce(F.sum("__cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) \
        .withColumn("__open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))) \
        .withColumn("__level", (F.col("__total") - F.col("__used")) / F.col("__open"))
    fits = F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "__rank", "__level"))
    s = s.withColumn("__first", F.min(fits).over(everything))
    level = F.coalesce(F.col("__first.__level") * F.col("weight"), F.col("__cap"))
    return s.select(*sources.columns, F.least("__cap", level).alias("target"))


def _row(docs: DataFrame, source: str, doc_id: str, text: str, weight: Column | None, seed: int) -> dict[str, Column]:
    weight = clean_share(F.col(text)) if weight is None else weight
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id)), 11) + 0.5) / float(2 ** 53)
    w = F.when(weight > 0, weight).otherwise(F.lit(1e-9))
    key = -F.log(u) / w.cast("double")
    return {"__src": F.col(source), "__id": F.col(doc_id), "__size": word_count(F.col(text)), "__key": key,
            "__th": F.xxhash64(F.col(text))}


def _bin(bins: Column) -> Column:
    """1 - exp(-key) grows with the key and is spread evenly over (0, 1) for equal weights."""
    return F.least(F.floor((1 - F.exp(-F.col("__key"))) * bins).cast("long"), bins - 1)


_ORDER = ("__key", "__id", "__size", "__th")


def mix_plan(rows: DataFrame, total_share: float = 1.0, max_epochs: int = MAX_EPOCHS,
             bin_rows: int = BIN_ROWS) -> DataFrame:
    """One row per source: ``__s, source_size, target, epochs, bins, cut_bin, cut``.

    ``rows``: the columns of ``_row``.  The source table has one row per source and is the only
    table that is ordered as a whole.
    """
    sources = rows.groupBy("__src").agg(F.sum("__size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    rank = Window.orderBy(F.col("__src").asc_nulls_last())
    sources = sources.withColumn("__rank", F.row_number().over(rank)) \
        .withColumn("weight", F.element_at(F.array(*map(F.lit, SOURCE_WEIGHTS)),
                                           ((F.col("__rank") - 1) % len(SOURCE_WEIGHTS) + 1).cast("int")))
    s = source_targets(sources, total_share, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    s = written(s.withColumn("epochs", F.floor(ratio + 1e-9).cast("long"))
                .withColumn("rest", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0)))
                .withColumn("bins", F.ceil(F.col("n") / bin_rows).cast("long"))
                .select(F.col("__src").alias("__s"), "source_size", "target", "epochs", "rest", "bins"))
    open_rows = rows.join(sized(s.where("rest > 0").select(F.col("__s"), "rest", "bins")),
                          F.col("__src").eqNullSafe(F.col("__s"))).withColumn("__bin", _bin(F.col("bins")))
    per_bin = open_rows.groupBy("__s", "rest", "__bin").agg(F.sum("__size").alias("__sum"))
    upto = Window.partitionBy("__s").orderBy("__bin")
    per_bin = per_bin.withColumn("__after", F.sum("__sum").over(upto)) \
        .withColumn("__before", F.col("__after") - F.col("__sum"))
    last = written(per_bin.where("__after >= rest and __before < rest").select(
        F.col("__s").alias("__c"), F.col("__bin").alias("cut_bin"), "__before"))
    edge = open_rows.join(sized(last), F.col("__s").eqNullSafe(F.col("__c")) & (F.col("__bin") == F.col("cut_bin")))
    run = Window.partitionBy("__c").orderBy(*_ORDER)
    edge = edge.withColumn("__upto", F.col("__before") + F.sum("__size").over(
        run.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__from", F.col("__upto") - F.col("__size"))
    taken = edge.where((F.col("__upto") <= F.col("rest")) |
                       ((F.col("__from") < F.col("rest")) & (F.col("__upto") - F.col("rest") <= F.col("rest") - F.col("__from"))))
    cuts = taken.groupBy("__c").agg(F.max(F.struct(*_ORDER)).alias("cut"))
    cuts = written(last.join(cuts.withColumnRenamed("__c", "__d"), F.col("__c").eqNullSafe(F.col("__d")), "left")
                   .select("__c", "cut_bin", "cut"))
    return written(s.join(cuts, F.col("__s").eqNullSafe(F.col("__c")), "left")
                   .select("__s", "source_size", "target", "epochs", "bins", "cut_bin", "cut"))


def apply_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``source_size, target, copies, taken`` to rows that hold the columns of ``_row``."""
    j = rows.join(sized(plan), F.col("__src").eqNullSafe(F.col("__s")))
    b = _bin(F.col("bins"))
    chosen = F.coalesce((b < F.col("cut_bin")) | ((b == F.col("cut_bin")) & (F.struct(*_ORDER) <= F.col("cut"))),
                        F.lit(False))
    copies = F.col("epochs") + chosen.cast("long")
    return j.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("__size")) \
        .drop("__s", "epochs", "bins", "cut_bin", "cut")


def mix_sizes(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text",
              weight: Column | None = None, seed: int = 1, total_share: float = 1.0,
              max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for every input row.

    Null sources are one source, last in order; null and empty texts have size 0 and take nothing;
    rows equal in id and text share their key and are taken together; a weight that is null or not
    positive is the smallest; an empty table gives no rows; other columns are not read.  The same
    input gives the same mix, however it is partitioned.
    """
    cols = _row(docs, source, doc_id, text, weight, seed)
    rows = written(docs.select(*[c.alias(n) for n, c in cols.items()]))
    out = apply_plan(rows, mix_plan(rows, total_share, max_epochs))
    return out.select(F.col("__id").alias(doc_id), F.col("__size").alias("size"), "source_size", "target", "taken", "copies")


def mix(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text",
        weight: Column | None = None, seed: int = 1, total_share: float = 1.0,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows that the mix takes, with all their columns and ``size, source_size, target, taken, copies``.

    ``copies`` says how often a row is used; input columns of these names are replaced.  Texts are
    read twice and not shuffled.
    """
    made = ["size", "source_size", "target", "taken", "copies"]
    keep = with_columns_replaced(docs, made)
    cols = _row(docs, source, doc_id, text, weight, seed)
    plan = mix_plan(written(docs.select(*[c.alias(n) for n, c in cols.items()])), total_share, max_epochs)
    rows = docs.select(*keep, *[c.alias(n) for n, c in cols.items()])
    out = apply_plan(rows, plan).where("copies > 0")
    return out.select(*keep, F.col("__size").alias("size"), "source_size", "target", "taken", "copies")
