"""Lexicon sentiment (A1-A18): rule-based valence scoring and roll-ups.

The scorer follows the published rule set of the VADER model (Hutto &
Gilbert, 2014) as it applies to cleaned text (lowercase, no punctuation or
digits, so capitals/punctuation/emoticon rules cannot fire):

* tokens: whitespace split, one-character tokens dropped;
* base valence from the lexicon; booster words and ``kind`` before ``of`` score 0;
* for each of the three preceding words not in the lexicon: booster scalar
  (signed like the current valence, damped x0.95 / x0.9 at distance 2 / 3),
  negation (x-0.74, with the ``never so/this`` amplifications), and at
  distance 3 the idiom table, joined by phrase (any number of idioms);
* ``least`` before a word negates it unless preceded by ``at``/``very``;
* the first ``but`` halves earlier valences and multiplies later ones by 1.5;
* compound = s / sqrt(s^2 + 15); pos/neg/neu shares.

Execution: tokens are exploded with positions and joined once to a single
broadcast term dictionary (valence, booster scalar, negator flag); tokens no
rule can react to are dropped before the shuffle (they only count as
neutral zeros).  One shuffle by utterance key, window ``lag``/``lead`` for
the context, plain column expressions for the rules (whole-stage codegen),
and per-utterance sums on the same partitioning.  No Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import labels as lb
from ..functions import text as tx
from ..functions.ordering import rank_within
from ..options import SentimentOptions
from ..session import broadcast_dictionary

UTTERANCE_KEYS = ("session_key", "dialogue_idx")

# Fixed values of the rule set.
NEGATION_SCALAR = -0.74
BOOSTER_DECREMENT = -0.293
NORMALIZE_ALPHA = 15.0


# Words the context rules test by name.
RULE_WORDS = ("but", "kind", "of", "least", "at", "very", "never", "so", "this")
UNKNOWN = "\u0000"


def term_dictionary(lexicon: DataFrame, boosters: DataFrame | None, negators: DataFrame | None,
                    rule_words: Sequence[str] = RULE_WORDS, phrases: DataFrame | None = None) -> DataFrame:
    """One row per unigram the rules look at: valence, booster scalar, negator flag.

    Words the rules test by name and the words of ``phrases`` are included with nulls, so their tokens are kept.
    """
    spark = lexicon.sparkSession
    parts = [lexicon.select(F.col("term"), F.col("valence").cast("double").alias("v"),
                            F.lit(None).cast("double").alias("b"), F.lit(False).alias("n"))]
    if boosters is not None:
        parts.append(boosters.where(~F.col("term").contains(" ")).select(
            "term", F.lit(None).cast("double").alias("v"),
            F.col("scalar").cast("double").alias("b"), F.lit(False).alias("n")))
    if negators is not None:
        parts.append(negators.select("term", F.lit(None).cast("double").alias("v"),
                                     F.lit(None).cast("double").alias("b"), F.lit(True).alias("n")))
    parts.append(spark.createDataFrame([(w,) for w in sorted(set(rule_words))], "term string").select(
        "term", F.lit(None).cast("double").alias("v"), F.lit(None).cast("double").alias("b"),
        F.lit(False).alias("n")))
    if phrases is not None:
        parts.append(phrases.select(F.explode(F.split("phrase", " ")).alias("term"), F.lit(None).cast("double").alias("v"),
                                    F.lit(None).cast("double").alias("b"), F.lit(False).alias("n")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("term").agg(F.max("v").alias("v"), F.max("b").alias("b"),
                                 F.max(F.col("n").cast("int")).cast("boolean").alias("n"))


def phrase_table(spark, boosters: DataFrame | None, idioms) -> DataFrame:
    """A4: ``phrase, iv, dec``: valence of an idiom, and whether the phrase is a two-word booster.

    ``idioms`` is a table ``phrase, valence`` (of equal phrases the highest counts) or a list of pairs (the last counts).
    """
    parts = spark.createDataFrame([], "phrase string, iv double, dec boolean")
    if idioms is not None and not isinstance(idioms, DataFrame):
        idioms = spark.createDataFrame(sorted((k, float(v)) for k, v in dict(idioms).items()), "phrase string, valence double")
    if idioms is not None:
        parts = parts.unionByName(idioms.select("phrase", F.col("valence").cast("double").alias("iv"), F.lit(False).alias("dec")))
    if boosters is not None:
        parts = parts.unionByName(boosters.where(F.col("term").contains(" ")).select(
            F.col("term").alias("phrase"), F.lit(None).cast("double").alias("iv"), F.lit(True).alias("dec")))
    return parts.groupBy("phrase").agg(F.max("iv").alias("iv"), F.max("dec").alias("dec"))


def _with_phrases(r: DataFrame, phrases: DataFrame, keys: list[str]) -> DataFrame:
    """Add what the phrases around a token say: ``idm`` (null: no idiom) and ``dec``.

    Phrases of two and of three words are joined at their last word; the tokens around look them up by position,
    in the scorer's order: those that end at the token or before it (first match), then those that start with it.
    """
    known = lambda *t: F.when(F.greatest(*[(F.col(x) == UNKNOWN).cast("int") for x in t]) == 0, F.concat_ws(" ", *t))
    cols = r.columns
    two = broadcast_dictionary(phrases.select(F.col("phrase").alias("_k2"), F.col("iv").alias("_i2"), F.col("dec").alias("_d2")))
    three = broadcast_dictionary(phrases.select(F.col("phrase").alias("_k3"), F.col("iv").alias("_i3")))
    r = r.withColumn("_k2", known("t1", "tok")).withColumn("_k3", known("t2", "t1", "tok"))
    r = r.join(two, "_k2", "left").join(three, "_k3", "left")
    w = Window.partitionBy(*keys).orderBy("p")
    r = r.select("*", *[f(c, k).over(w).alias(f"{c}{n}{k}") for f, n in ((F.lag, "m"), (F.lead, "p")) for k in (1, 2)
                        for c in ("p", "_i2", "_i3", "_d2")])

    def at(field, dist):
        """Field of the kept token ``dist`` words further (negative: before)."""
        n = "m" if dist < 0 else "p"
        return F.coalesce(*[F.when(F.col(f"p{n}{k}") == F.col("p") + dist, F.col(f"{field}{n}{k}")) for k in (1, 2)])

    before = F.coalesce(F.col("_i2"), F.col("_i3"), at("_i2", -1), at("_i3", -1), at("_i2", -2))
    idm = F.coalesce(at("_i3", 2), at("_i2", 1), before)
    dec = F.coalesce(at("_d2", -1), F.lit(False)) | F.coalesce(at("_d2", -2), F.lit(False))
    return r.select(*cols, idm.alias("idm"), dec.alias("dec"))


def score_utterances(utterances: DataFrame, lexicon: DataFrame, boosters: DataFrame | None = None,
                     negators: DataFrame | None = None,
                     idioms: DataFrame | Sequence[tuple[str, float]] | None = None,
                     opts: SentimentOptions = SentimentOptions(),
                     keys: Sequence[str] = UTTERANCE_KEYS) -> DataFrame:
    """One scored row per utterance with non-empty raw text.

    Scores ``processed_text`` when present (else the raw text).  Output keeps
    every input column (speaker, session attributes ride along) and adds
    ``pos_score neg_score neu_score compound_score sentiment_category``.
    Utterances with empty raw text are skipped and keep their index gaps (A7).

    Plan: tokens are exploded with positions and joined to one broadcast term
    dictionary; only tokens the rules can react to (dictionary words and the
    rule words) are kept -- every other token is a neutral zero and is
    counted, not shipped.  One shuffle by utterance key brings an
    utterance's kept tokens together in position order; ``lag``/``lead``
    give the three preceding and two following kept tokens, and a neighbour
    counts only when its position is adjacent.  The rules are plain column
    expressions (whole-stage codegen) and the per-utterance sums reuse the
    window's partitioning (no second shuffle).
    """
    keys = list(keys)
    src = "processed_text" if "processed_text" in utterances.columns else "text"
    toks = tx.vader_tokens(F.coalesce(F.col(src), F.lit("")))
    u = utterances.where(tx.has_text("text"))
    carry = [c for c in u.columns if c not in keys]
    phrases = None
    if boosters is not None or idioms is not None:
        phrases = phrase_table(lexicon.sparkSession, boosters, idioms)
        if phrases.isEmpty():
            phrases = None
    d = term_dictionary(lexicon, boosters, negators, RULE_WORDS, phrases)
    d = d.select(F.col("term").alias("_dkey"), "v", "b", "n")

    e = u.select(*u.columns, F.posexplode_outer(toks).alias("_pos", "_tok"))
    first_row = F.col("_pos").isNull() | (F.col("_pos") == 0)
    # before the join: a token carries its key, position and word, wide columns ride on the first only
    e = e.select(*keys, "_pos", "_tok", *[F.when(first_row, F.col(c)).alias(c) for c in carry],
                 # counted on the first exploded row only: evaluating it on every row
                 # would re-split the whole text once per token
                 F.when(first_row, F.size(toks)).alias("_ntok"))
    e = e.join(broadcast_dictionary(d), e["_tok"] == d["_dkey"], "left")
    hit = F.col("_pos").isNotNull() & F.col("_dkey").isNotNull()
    e = e.where(hit | first_row)
    r = e.select(*keys, *carry, "_ntok",
                 F.coalesce(F.col("_pos"), F.lit(0)).alias("p"), hit.alias("h"),
                 F.when(hit, F.col("_tok")).otherwise(F.lit(UNKNOWN)).alias("tok"),
                 F.when(hit, F.col("v")).alias("v"), F.when(hit, F.col("b")).alias("b"),
                 F.coalesce(F.when(hit, F.col("n")), F.lit(False)).alias("n"))
    w = Window.partitionBy(*keys).orderBy("p")
    nb = [F.lag(c, k).over(w).alias(f"_{c}{k}") for k in (1, 2, 3) for c in ("p", "tok", "v", "b", "n")]
    nb += [F.lead(c, k).over(w).alias(f"_{c}f{k}") for k in (1, 2) for c in ("p", "tok")]
    nb.append(F.min(F.when(F.col("tok") == "but", F.col("p")))
              .over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_bi"))
    r = r.select("*", *nb)

    def at(dist, field, default):
        """Field of the kept token at position p - dist (absent: a plain word)."""
        c = None
        for k in (1, 2, 3):
            hit_k = F.when(F.col(f"_p{k}") == F.col("p") - dist, F.col(f"_{field}{k}"))
            c = hit_k if c is None else F.coalesce(c, hit_k)
        return F.coalesce(c, default)

    def fwd(dist):
        c = None
        for k in (1, 2):
            hit_k = F.when(F.col(f"_pf{k}") == F.col("p") + dist, F.col(f"_tokf{k}"))
            c = hit_k if c is None else F.coalesce(c, hit_k)
        return F.coalesce(c, F.lit(UNKNOWN))

    unk = F.lit(UNKNOWN)
    r = r.select(*keys, *carry, "_ntok", "p", "h", "tok", "v", "b", "_bi",
                 *[at(k, "tok", unk).alias(f"t{k}") for k in (1, 2, 3)],
                 *[at(k, "v", F.lit(None).cast("double")).isNotNull().alias(f"l{k}") for k in (1, 2, 3)],
                 *[at(k, "b", F.lit(0.0)).alias(f"b{k}") for k in (1, 2, 3)],
                 *[at(k, "n", F.lit(False)).alias(f"n{k}") for k in (1, 2, 3)],
                 fwd(1).alias("f1"))
    base = [*keys, *carry, "_ntok", "p", "h", "tok", "v", "b", "_bi", "t1", "t2", "t3", "l1", "l2", "l3",
            "b1", "b2", "b3", "n1", "n2", "n3", "f1"]
    if phrases is not None:
        r = _with_phrases(r, phrases, keys)
        base += ["idm", "dec"]

    def signed(v, bk):
        return F.when(v < 0, -F.col(bk)).otherwise(F.col(bk))

    x1 = F.when((F.col("p") > 0) & ~F.col("l1"),
                (F.col("v") + signed(F.col("v"), "b1")) * F.when(F.col("n1"), NEGATION_SCALAR).otherwise(1.0)
                ).otherwise(F.col("v"))
    r = r.select(*base, x1.alias("x1"))
    amp1 = (F.col("t2") == "never") & F.col("t1").isin("so", "this")
    x2 = F.when((F.col("p") > 1) & ~F.col("l2"),
                (F.col("x1") + signed(F.col("x1"), "b2") * 0.95)
                * F.when(amp1, 1.5).when(F.col("n2"), NEGATION_SCALAR).otherwise(1.0)).otherwise(F.col("x1"))
    r = r.select(*base, x2.alias("x2"))
    amp2 = (F.col("t3") == "never") & (F.col("t2").isin("so", "this") | F.col("t1").isin("so", "this"))
    v3 = (F.col("x2") + signed(F.col("x2"), "b3") * 0.9) * \
        F.when(amp2, 1.25).when(F.col("n3"), NEGATION_SCALAR).otherwise(1.0)
    if phrases is not None:
        v3 = F.coalesce(F.col("idm"), v3)
        v3 = F.when(F.col("dec"), v3 + BOOSTER_DECREMENT).otherwise(v3)
    x3 = F.when((F.col("p") > 2) & ~F.col("l3"), v3).otherwise(F.col("x2"))
    r = r.select(*base, x3.alias("x3"))
    least1 = (F.col("p") > 0) & ~F.col("l1") & (F.col("t1") == "least")
    least_mult = (F.when(least1 & (F.col("p") > 1) & ~F.col("t2").isin("at", "very"), NEGATION_SCALAR)
                  .when(least1 & (F.col("p") == 1), NEGATION_SCALAR).otherwise(1.0))
    skip = F.col("b").isNotNull() | F.col("v").isNull() | ((F.col("tok") == "kind") & (F.col("f1") == "of"))
    val = F.when(skip, F.lit(0.0)).otherwise(F.col("x3") * least_mult)
    but = (F.when(F.col("_bi").isNull(), 1.0).when(F.col("p") < F.col("_bi"), 0.5)
           .when(F.col("p") > F.col("_bi"), 1.5).otherwise(1.0))
    r = r.select(*keys, *carry, "_ntok", "h", F.when(F.col("h"), val * but).alias("val"))

    vv = F.col("val")
    g = r.groupBy(*keys).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in carry],
        F.max("_ntok").alias("_ntok"),
        F.sum(vv).alias("_s"),
        F.sum(F.when(vv > 0, vv + 1)).alias("_ps"),
        F.sum(F.when(vv < 0, vv - 1)).alias("_ns"),
        F.count_if(F.col("h")).alias("_nh"),
        F.count_if(F.col("h") & (vv == 0)).alias("_nz"))
    s_ = F.coalesce(F.col("_s"), F.lit(0.0))
    ps = F.coalesce(F.col("_ps"), F.lit(0.0))
    ns = F.coalesce(F.col("_ns"), F.lit(0.0))
    neu = (F.col("_ntok") - F.col("_nh") + F.col("_nz")).cast("double")
    total = ps + F.abs(ns) + neu
    comp = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s_ / F.sqrt(s_ * s_ + NORMALIZE_ALPHA)))
    empty = F.coalesce(F.col("_ntok"), F.lit(0)) == 0
    # Half-even rounding, as the scores are rounded in the published scorer.
    out = g.select(*utterances.columns,
                   F.when(empty, 0.0).otherwise(F.bround(F.abs(ps / total), 3)).alias("pos_score"),
                   F.when(empty, 0.0).otherwise(F.bround(F.abs(ns / total), 3)).alias("neg_score"),
                   F.when(empty, 0.0).otherwise(F.bround(F.abs(neu / total), 3)).alias("neu_score"),
                   F.when(empty, 0.0).otherwise(F.bround(comp, 4)).alias("compound_score"))
    return out.withColumn("sentiment_category", lb.polarity_label(
        "compound_score", opts.positive_threshold, opts.negative_threshold))


def session_sentiment(scored: DataFrame, sessions: DataFrame,
                      session_keys: Sequence[str] = ("session_key",),
                      opts: SentimentOptions = SentimentOptions()) -> DataFrame:
    """Per-session averages, label and category counts.

    Sessions without a scored utterance keep a row with zeros and 'neutral'.
    Partial aggregation runs map-side, so a hot session costs no skew.
    """
    keys = list(session_keys)
    agg = scored.groupBy(*keys).agg(
        F.avg("compound_score").alias("avg_compound"),
        F.avg("pos_score").alias("avg_positive"),
        F.avg("neg_score").alias("avg_negative"),
        F.avg("neu_score").alias("avg_neutral"),
        F.count_if(F.col("sentiment_category") == "positive").alias("positive_count"),
        F.count_if(F.col("sentiment_category") == "neutral").alias("neutral_count"),
        F.count_if(F.col("sentiment_category") == "negative").alias("negative_count"),
        F.count(F.lit(1)).alias("scored_count"),
    )
    j = sessions.join(agg, keys, "left")
    zero = F.lit(0.0)
    out = j.select(
        *sessions.columns,
        F.coalesce("avg_compound", zero).alias("avg_compound"),
        F.coalesce("avg_positive", zero).alias("avg_positive"),
        F.coalesce("avg_negative", zero).alias("avg_negative"),
        F.coalesce("avg_neutral", zero).alias("avg_neutral"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
          for c in ("positive_count", "neutral_count", "negative_count", "scored_count")],
    )
    return out.withColumn("overall_sentiment", lb.polarity_label(
        "avg_compound", opts.positive_threshold, opts.negative_threshold))


def speaker_sentiment(scored: DataFrame, group_cols: Sequence[str] = (),
                      opts: SentimentOptions = SentimentOptions()) -> DataFrame:
    """Roll-up by speaker (exact string) over all sessions; empty speaker skipped."""
    keys = [*group_cols, "speaker"]
    agg = scored.where(F.col("speaker").isNotNull() & (F.col("speaker") != "")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_entries"),
        F.sum("compound_score").alias("compound_sum"),
        F.sum("pos_score").alias("pos_sum"),
        F.sum("neg_score").alias("neg_sum"),
        F.sum("neu_score").alias("neu_sum"),
        F.count_if(F.col("sentiment_category") == "positive").alias("positive_count"),
        F.count_if(F.col("sentiment_category") == "neutral").alias("neutral_count"),
        F.count_if(F.col("sentiment_category") == "negative").alias("negative_count"),
    )
    n = F.col("total_entries")
    out = agg.select(*agg.columns,
                     (F.col("compound_sum") / n).alias("avg_compound"),
                     (F.col("pos_sum") / n).alias("avg_positive"),
                     (F.col("neg_sum") / n).alias("avg_negative"),
                     (F.col("neu_sum") / n).alias("avg_neutral"))
    return out.withColumn("overall_sentiment", lb.polarity_label(
        "avg_compound", opts.positive_threshold, opts.negative_threshold))


def session_progression(scored: DataFrame, sessions: DataFrame,
                        session_keys: Sequence[str] = ("session_key",),
                        idx: str = "dialogue_idx") -> DataFrame:
    """start/end tone over the first/last third, shift, volatility, trend.

    A third is ``max(1, n // 3)`` scored utterances (overlapping when n is
    small).  Ranks come from ``rank_within`` (block-wise, so a very long
    session is not one window task); the thirds, volatility and shift are
    then partial aggregations per session.
    """
    keys = list(session_keys)
    r = rank_within(scored.select(*keys, idx, "compound_score"), keys, idx, "_rn", "_n")
    k = F.greatest(F.lit(1), F.floor(F.col("_n") / 3))
    agg = r.groupBy(*keys).agg(
        F.avg(F.when(F.col("_rn") <= k, F.col("compound_score"))).alias("start_sentiment"),
        F.avg(F.when(F.col("_rn") > F.col("_n") - k, F.col("compound_score"))).alias("end_sentiment"),
        F.stddev_pop("compound_score").alias("sentiment_volatility"),
    )
    j = sessions.join(agg, keys, "left")
    shift = F.col("end_sentiment") - F.col("start_sentiment")
    return j.select(
        *sessions.columns, "start_sentiment", "end_sentiment",
        F.coalesce(shift, F.lit(0.0)).alias("sentiment_shift"),
        F.coalesce("sentiment_volatility", F.lit(0.0)).alias("sentiment_volatility"),
        F.when(F.col("start_sentiment").isNull(), "none")
         .otherwise(lb.trend_label(shift)).alias("sentiment_trend"),
    )
