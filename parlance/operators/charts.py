"""Chart-ready result tables (V1-V10); rendering itself is out of scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.ordering import join_groups
from ..session import stored, with_scalar


def sentiment_over_time(session_sent: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """V1: dated sessions in date order plus y-axis bounds (min(min,-0.1), max(max,0.1), 10 % padding)."""
    keys = list(group_cols)
    d = session_sent.where(F.col("session_date").isNotNull())
    b = d.groupBy(*keys).agg(F.least(F.min("avg_compound"), F.lit(-0.1)).alias("_lo"),
                             F.greatest(F.max("avg_compound"), F.lit(0.1)).alias("_hi"))
    pad = (F.col("_hi") - F.col("_lo")) * 0.1
    b = b.select(*keys, (F.col("_lo") - pad).alias("y_min"), (F.col("_hi") + pad).alias("y_max"))
    j = join_groups(d, b, keys) if keys else with_scalar(d, b)  # one bounds row per group
    return j.select(*keys, "session_key", "session_date", "avg_compound", "overall_sentiment", "y_min", "y_max")


def compound_histogram(scored: DataFrame, bins: int = 30, group_cols: Sequence[str] = ()) -> DataFrame:
    """V2: equal-width bins over the data range (maximum in the last bin; lo == hi -> bin 1)."""
    keys = list(group_cols)
    scored = stored(scored.select(*keys, "compound_score"), "scores")  # read for the range, then for the bins
    r = scored.groupBy(*keys).agg(F.min("compound_score").alias("lo"), F.max("compound_score").alias("hi"))
    j = join_groups(scored, r, keys) if keys else with_scalar(scored, r)  # one range row per group
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), 1).otherwise(
        F.least(F.floor((F.col("compound_score") - F.col("lo")) / width) + 1, F.lit(bins)))
    out = keys
    return j.groupBy(*keys, b.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.min("lo").alias("lo"), F.min("hi").alias("hi")) \
        .select(*out, "bin", (F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins).alias("bin_start"),
                "count")


def density_curve(hist: DataFrame, grid: int = 200, bandwidth: float = 0.1) -> DataFrame:
    """V2 curve: Gaussian kernel density on a fixed grid over the binned counts.

    Each histogram bin (at most ``bins`` rows) expands to the ``grid`` points,
    so the work is bins x grid whatever the data size.
    """
    tot = hist.agg(F.sum("count")).first()[0] or 1
    half = hist.agg(((F.max("bin_start") - F.min("bin_start")) / F.greatest(F.max("bin") - F.min("bin"), F.lit(1)) / 2)).first()[0] or 0.0
    e = hist.select((F.col("bin_start") + half).alias("centre"), "count", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    x = F.lit(-1.0) + F.col("i") * (2.0 / (grid - 1))
    k = F.exp(-0.5 * F.pow((x - F.col("centre")) / bandwidth, 2))
    return e.groupBy(x.alias("x")).agg(
        (F.sum(F.col("count") * k) / (tot * bandwidth * 2.5066282746310002)).alias("density"))


def speaker_bars(speaker_sent: DataFrame) -> DataFrame:
    """V3: speakers sorted by mean compound with a colour class at +-0.05 (per row)."""
    c = F.col("avg_compound")
    return speaker_sent.select("speaker", "avg_compound",
                               F.when(c > 0.05, "positive").when(c < -0.05, "negative").otherwise("neutral")
                               .alias("color_class")).orderBy("avg_compound")


def progression_bars(progression: DataFrame) -> DataFrame:
    """V4: start / end / shift per dated session with the shift's direction."""
    return progression.where(F.col("session_date").isNotNull()).select(
        "session_key", "session_date", "start_sentiment", "end_sentiment", "sentiment_shift",
        F.when(F.col("sentiment_shift") > 0, "up").when(F.col("sentiment_shift") < 0, "down")
         .otherwise("flat").alias("direction"))


def topic_term_bars(topic_terms: DataFrame, n_topics: int = 6, n_terms: int = 15) -> DataFrame:
    """V5: top 15 terms for each of the first 6 topic ids."""
    ids = topic_terms.select("topic_id").distinct()
    ids = ids.withColumn("_r", F.dense_rank().over(Window.orderBy("topic_id"))).where(F.col("_r") <= n_topics)
    w = Window.partitionBy("topic_id").orderBy(F.col("weight").desc(), F.col("term"))
    t = topic_terms.join(F.broadcast(ids.select("topic_id")), "topic_id")
    return t.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n_terms)


def prevalence_pivot(prevalence: DataFrame, topic_ids: Sequence[int], group_cols: Sequence[str] = ()) -> DataFrame:
    """V6: date x topic mean prevalence (known topic ids avoid the extra distinct job)."""
    keys = list(group_cols)
    d = prevalence.where(F.col("session_date").isNotNull())
    return d.groupBy(*keys, "session_date").pivot("topic_id", list(topic_ids)).agg(F.avg("prevalence"))


def dominant_topic_counts(document_topics: DataFrame) -> DataFrame:
    """V7: number of session documents per dominant topic."""
    return document_topics.where((F.col("doc_type") == "transcript") & F.col("dominant_topic").isNotNull()) \
        .groupBy("dominant_topic").agg(F.count(F.lit(1)).alias("sessions")).orderBy("dominant_topic")


def sentiment_by_topic(document_topics: DataFrame, scored: DataFrame) -> DataFrame:
    """V8: mean utterance compound by the utterance's dominant topic (inner equi-join)."""
    d = document_topics.where(F.col("doc_type") == "dialogue").select("session_key", "dialogue_idx", "dominant_topic")
    j = d.join(scored.select("session_key", "dialogue_idx", "compound_score"), ["session_key", "dialogue_idx"])
    g = j.groupBy("dominant_topic").agg(F.avg("compound_score").alias("avg_compound"),
                                        F.count(F.lit(1)).alias("utterances"))
    c = F.col("avg_compound")
    return g.withColumn("color_class", F.when(c > 0.05, "positive").when(c < -0.05, "negative").otherwise("neutral"))


def prevalence_with_sentiment(pivot: DataFrame, session_sent: DataFrame) -> DataFrame:
    """V9: V6 joined to session tone on date (inner; repeated dates fan out)."""
    s = session_sent.where(F.col("session_date").isNotNull()).select("session_date", "session_key", "avg_compound")
    return pivot.join(s, "session_date").orderBy("session_date", "session_key")


def chart_catalogue(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The non-empty chart tables by name."""
    return {k: v for k, v in tables.items() if v is not None and not v.isEmpty()}
