"""Topic modelling (T1-T12, D7-D9) on Spark ML and relational operators.

Documents come at two grains: one per session (``transcript``) and one per
utterance (``dialogue``); every token therefore counts at both (T1).  The
vocabulary filter, bag of words, prevalence and coherence are relational
jobs; the LDA fit is Spark ML's online variational Bayes (the driver only
coordinates iterations; executors compute sufficient statistics).
"""

from __future__ import annotations

import logging
import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .. import schema as S
from ..functions.ordering import dense_index, join_groups, rank_within, running_sums
from ..options import TopicOptions
from ..session import broadcast_if_small, broadcast_written, ensure_checkpoint_dir, stored, with_scalar
from .lookup import packed, unpacked

DOC_KEYS = ("doc_type", "session_key", "dialogue_idx")
EPSILON = 1e-12


def _runs(items: Column, new: Callable[[Column, Column], Column], made: Callable[[Column, Column, Column], Column]) -> Column:
    """Runs of a non-empty sorted array: ``new(item, previous)`` starts one, ``made(first, last, length)`` is its value."""
    def found(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | new(F.get(s, i), F.get(s, i - 1)))

        def values(at: Column) -> Column:
            ends = F.concat(F.slice(at, 2, F.size(at)), F.array(F.size(s)))
            return F.zip_with(at, ends, lambda i, j: made(F.get(s, i), F.get(s, j - 1), j - i))
        return F.transform(F.array(starts), lambda at: values(at))[0]
    return F.transform(F.array(items), lambda s: found(s))[0]  # bound to a name, so it is made once


def term_counts(tokens: Column) -> Column:
    """array<struct<term, count>> of a non-empty token list, without a row or a shuffle per token."""
    return _runs(F.array_sort(tokens), lambda x, y: ~x.eqNullSafe(y),
                 lambda x, _, n: F.struct(x.alias("term"), n.cast("long").alias("count")))


def term_stretches(tokens: Column, gap: int) -> Column:
    """array<struct<term, first, last>> of a non-empty token list: positions of a term that are at most ``gap`` apart."""
    at = F.array_sort(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.cast("long").alias("i"))))
    return _runs(at, lambda x, y: ~x["t"].eqNullSafe(y["t"]) | (x["i"] - y["i"] > gap),
                 lambda x, y, _: F.struct(x["t"].alias("term"), x["i"].alias("first"), y["i"].alias("last")))


# ------------------------------------------------------------------ T1
def _utterance_keys() -> list[Column]:
    return [F.lit("dialogue").alias("doc_type"), F.col("session_key"), F.col("dialogue_idx")]


def _session_keys() -> list[Column]:
    return [F.lit("transcript").alias("doc_type"), F.col("session_key"), F.lit(-1).cast("bigint").alias("dialogue_idx")]


@dataclass(frozen=True)
class Corpus:
    """The documents at both grains, without a row that holds a session's tokens.

    ``rows`` are the utterances with tokens; a session's document is their concatenation, so its counts are sums and
    its positions are offsets into it.  ``docs``: document keys and ``n_tokens``; ``counts``: document keys,
    ``term``, ``count``.  ``unique``: no two rows have the same keys, so what is counted inside a row is whole.
    """

    rows: DataFrame
    docs: DataFrame
    two_grains: bool = True
    unique: bool = False

    @cached_property
    def said(self) -> DataFrame:
        """Counts of the rows, keyed as they are: made inside the row, summed and written where keys repeat."""
        keys = [c for c in DOC_KEYS if c in self.rows.columns]
        said = self.rows.select(*keys, F.explode(term_counts(F.col("tokens"))).alias("_c")) \
            .select(*keys, "_c.term", "_c.count")
        return said if self.unique else stored(said.groupBy(*keys, "term").agg(F.sum("count").alias("count")), "counts")

    @cached_property
    def by_session(self) -> DataFrame:
        """``session_key, term, count`` and ``_docs``, the session's utterances with the term; written once."""
        return stored(self.said.groupBy("session_key", "term").agg(
            F.sum("count").alias("count"), F.count(F.lit(1)).alias("_docs")), "session_counts")

    @cached_property
    def counts(self) -> DataFrame:
        if not self.two_grains:
            return self.said.select(*DOC_KEYS, "term", "count")
        return self.said.select(*_utterance_keys(), "term", "count").unionByName(
            self.by_session.select(*_session_keys(), "term", "count"))

    def _placed(self) -> DataFrame:
        """``rows`` of both grains with ``_at`` and ``_total``: tokens of the session before the row, and all of it."""
        keys = ["session_key", "dialogue_idx"]
        offsets = running_sums(self.rows.select(*keys, F.size("tokens").cast("long").alias("_size")), ["session_key"],
                               ["dialogue_idx"], {"_at": F.col("_size")}).drop("_size")
        totals = self.docs.where("doc_type = 'transcript'").select("session_key", F.col("n_tokens").alias("_total"))
        r = self.rows.select(*keys, packed("tokens").alias("tokens"))
        return join_groups(r, join_groups(offsets, totals, ["session_key"]), keys) \
            .select(*keys, "_at", "_total", unpacked("tokens").alias("tokens"))

    def occurrences(self, terms: DataFrame) -> DataFrame:
        """Document keys, ``n_tokens``, ``p`` (position from 0) and ``term`` of the tokens that are in ``terms``."""
        r, at = (self._placed(), F.col("_at")) if self.two_grains else (self.rows, F.lit(0).cast("long").alias("_at"))
        e = r.select(*[c for c in DOC_KEYS if c in r.columns], at, F.posexplode("tokens").alias("p", "term")) \
            .join(broadcast_if_small(terms.select("term").distinct()), "term")
        if self.two_grains:
            grains = F.array(
                F.struct(F.lit("dialogue").alias("doc_type"), F.col("dialogue_idx").alias("dialogue_idx"),
                         F.col("p").cast("long").alias("p")),
                F.struct(F.lit("transcript").alias("doc_type"), F.lit(-1).cast("long").alias("dialogue_idx"),
                         (F.col("_at") + F.col("p")).alias("p")))
            e = e.select("term", "session_key", F.explode(grains).alias("g")).select(
                "g.doc_type", "session_key", "g.dialogue_idx", "g.p", "term")
        return join_groups(e.select(*DOC_KEYS, F.col("p").cast("long").alias("p"), "term"), self.docs, DOC_KEYS)

    def stretches(self, terms: DataFrame, gap: int) -> tuple[DataFrame | None, DataFrame]:
        """Where ``terms`` occur: document keys, ``n_tokens``, ``term``, ``first`` and ``last`` position.

        Positions of a term at most ``gap`` apart in one row are one stretch.  The first table holds the documents
        that are one row each, the second those whose stretches of several rows may meet.
        """
        if not (self.two_grains and self.unique):
            return None, self.occurrences(terms).withColumnRenamed("p", "first").withColumn("last", F.col("first"))
        wanted = broadcast_if_small(terms.select("term").distinct())

        def found(r: DataFrame) -> DataFrame:
            keep = [c for c in r.columns if c != "tokens"]
            return r.select(*keep, F.explode(term_stretches(F.col("tokens"), gap)).alias("_s")) \
                .select(*keep, "_s.*").join(wanted, "term")

        utt = found(self.rows.select(*_utterance_keys(), F.size("tokens").cast("long").alias("n_tokens"), "tokens"))
        ses = found(self._placed()).select(*_session_keys(), F.col("_total").alias("n_tokens"), "term",
                                           (F.col("_at") + F.col("first")).alias("first"), (F.col("_at") + F.col("last")).alias("last"))
        return utt.select(ses.columns), ses


def corpus(processed: DataFrame) -> Corpus:
    """Utterance and session documents of the non-empty token lists of ``processed``.

    Session documents have ``dialogue_idx = -1``; their tokens are those of their utterances in order (see P13).
    The token lists are written once: documents, counts and positions all read them, some several times.  Whether
    their keys repeat is one small job over the keys written.
    """
    rows = stored(processed.where(F.size("tokens") > 0).select(
        "session_key", F.col("dialogue_idx").cast("bigint").alias("dialogue_idx"), "tokens"), "tokens")
    sizes = rows.select("session_key", "dialogue_idx", F.size("tokens").cast("long").alias("n_tokens"))
    docs = sizes.select(*_utterance_keys(), "n_tokens").unionByName(
        sizes.groupBy("session_key").agg(F.sum("n_tokens").alias("n_tokens")).select(*_session_keys(), "n_tokens"))
    repeated = rows.groupBy("session_key", "dialogue_idx").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return Corpus(rows, docs, unique=repeated.isEmpty())


def as_corpus(docs: Corpus | DataFrame) -> Corpus:
    """A corpus as it is; a table of documents (keys and ``tokens``, every row a document) as one grain."""
    if isinstance(docs, Corpus):
        return docs
    rows = docs.where(F.size("tokens") > 0).select(*DOC_KEYS, "tokens")
    return Corpus(rows, rows.select(*DOC_KEYS, F.size("tokens").cast("long").alias("n_tokens")), False)


# ------------------------------------------------------------------ T2
def document_frequency(docs: Corpus | DataFrame) -> DataFrame:
    """(term, df): number of documents containing the term (partial aggregation, skew-safe)."""
    c = as_corpus(docs)
    if c.two_grains:  # a session with the term is a document, and so is each of its utterances with it
        return c.by_session.groupBy("term").agg(F.sum(F.col("_docs") + 1).alias("df"))
    return c.counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def vocabulary(docs: Corpus | DataFrame, opts: TopicOptions = TopicOptions()) -> DataFrame:
    """Keep ``min_df <= df <= floor(max_df * N)``; at most ``max_vocab`` terms by df if that is set.

    ``N`` is one number.  Terms are numbered by df (descending), then term, with a distributed dense index.
    Output (term, df, term_index).
    """
    c = as_corpus(docs)
    n = c.docs.agg(F.count(F.lit(1)).alias("_n"))
    upper = F.floor(F.lit(opts.max_df) * F.col("_n")) if opts.max_df <= 1.0 else F.lit(int(opts.max_df))
    kept = with_scalar(document_frequency(c), n) \
        .where((F.col("df") >= opts.min_df) & (F.col("df") <= upper)).drop("_n")
    if opts.max_vocab is not None:
        kept = kept.orderBy(F.col("df").desc(), F.col("term").asc()).limit(opts.max_vocab)
    kept = stored(kept, "vocabulary")  # one row per term; the index reads it twice
    return dense_index(kept, [F.col("df").desc(), F.col("term").asc()], "term_index", key="term",
                       order_cols=("df", "term")).select("term", "df", F.col("term_index").cast("int"))


# ------------------------------------------------------------------ T4
def bag_of_words(docs: Corpus | DataFrame, vocab: DataFrame) -> DataFrame:
    """T4: (doc keys, term, count) restricted to the vocabulary."""
    return as_corpus(docs).counts.join(broadcast_written(vocab.select("term"), "terms"), "term") \
        .select(*DOC_KEYS, "term", "count")


FEATURES = T.StructType([
    *[T.StructField(k, t) for k, t in zip(DOC_KEYS, (T.StringType(), T.LongType(), T.LongType()))],
    T.StructField("features", VectorUDT())])


def feature_vectors(docs: Corpus | DataFrame, vocab: DataFrame, n_terms: int) -> DataFrame:
    """T4 as sparse vectors over ``term_index`` (doc keys, ``features``), a row per document, also without known terms.

    The vectors are made by join and grouping and written once to the checkpoint folder in the stored form of a
    vector; read back they are vectors.  So neither the dictionary nor Python is needed to make them, and every
    pass of a fit reads the same files.
    """
    c = as_corpus(docs)
    spark = vocab.sparkSession
    ids = c.counts.join(broadcast_written(vocab.select("term", "term_index"), "terms"), "term")
    pairs = ids.groupBy(*DOC_KEYS).agg(F.sort_array(F.collect_list(F.struct("term_index", "count"))).alias("_t"))
    j = join_groups(c.docs, pairs, DOC_KEYS, "left")
    found = F.coalesce("_t", F.array().cast("array<struct<term_index:int,count:bigint>>"))
    stored = j.select(*DOC_KEYS, F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(n_terms).alias("size"),
        F.transform(found, lambda x: x["term_index"]).alias("indices"),
        F.transform(found, lambda x: x["count"].cast("double")).alias("values")).alias("features"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/features-{uuid.uuid4().hex}"
    stored.write.parquet(path)
    return spark.read.schema(FEATURES).parquet(path)


# ---------------------------------------------------------------- T5-T10
@dataclass
class TopicModel:
    vocab: DataFrame              # T2 (term, df, term_index)
    topic_terms: DataFrame        # T7 (topic_id, term, weight)
    document_topics: DataFrame    # T8-T10
    doc_concentration: list[float]
    model: object


def mixture_column(probs: Column, min_prob: float) -> Column:
    """array<struct<topic_id, prob>> with prob >= min_prob, prob desc then id asc."""
    pairs = F.transform(probs, lambda p, i: F.struct(i.cast("int").alias("topic_id"), p.alias("prob")))
    kept = F.filter(pairs, lambda x: x["prob"] >= min_prob)
    return F.array_sort(kept, lambda a, b: F.when(a["prob"] > b["prob"], -1)
                        .when(a["prob"] < b["prob"], 1)
                        .when(a["topic_id"] < b["topic_id"], -1)
                        .when(a["topic_id"] > b["topic_id"], 1).otherwise(0))


def with_dominant(df: DataFrame, mixture: str = "topic_distribution") -> DataFrame:
    """First element of the mixture; null topic / 0 prob when the mixture is empty."""
    first = F.get(F.col(mixture), 0)
    return df.withColumn("dominant_topic", first["topic_id"]) \
             .withColumn("dominant_topic_prob", F.coalesce(first["prob"], F.lit(0.0)))


def fit_topics(docs: Corpus | DataFrame, opts: TopicOptions = TopicOptions(),
               vocab: DataFrame | None = None, feats: DataFrame | None = None) -> TopicModel | None:
    """Vocabulary, bag of words, online LDA, topic terms and document mixtures.

    Returns None when there are no documents or the vocabulary is empty (T3).  Fits of one corpus may share
    ``vocab`` and ``feats`` (of ``feature_vectors``).
    """
    c = as_corpus(docs)
    if vocab is None:
        ensure_checkpoint_dir(c.rows.sparkSession)
        vocab = vocabulary(c, opts).checkpoint(eager=True)
    n_terms = vocab.count()
    if n_terms < 10:
        logging.getLogger(__name__).warning(
            "topic model on a vocabulary of %d terms (document frequencies %s to %s)", n_terms, opts.min_df, opts.max_df)
    if not n_terms:
        return None
    if feats is None:
        feats = feature_vectors(c, vocab, n_terms)
    # a mini-batch is a fixed share of the documents, so the number of jobs does not grow with them
    iters = max(1, math.ceil(opts.passes / opts.batch_share))
    lda = LDA(k=opts.num_topics, maxIter=iters, optimizer="online", learningOffset=1.0,
              learningDecay=0.5, subsamplingRate=opts.batch_share, optimizeDocConcentration=True,
              topicConcentration=1.0 / opts.num_topics, seed=opts.seed, featuresCol="features",
              topicDistributionCol="topicDistribution")
    model = lda.fit(feats)
    alpha = [float(a) for a in model.estimatedDocConcentration().toArray()]
    desc = model.describeTopics(opts.top_terms)
    tt = desc.select(F.col("topic").cast("int").alias("topic_id"),
                     F.explode(F.arrays_zip("termIndices", "termWeights")).alias("z"))
    tt = tt.select("topic_id", F.col("z.termIndices").cast("int").alias("term_index"),
                   F.col("z.termWeights").alias("weight")) \
           .join(vocab.select("term_index", "term"), "term_index").select("topic_id", "term", "weight")
    # A document whose words are all out of vocabulary gets the prior mixture.
    prior = F.array(*[F.lit(a / sum(alpha)) for a in alpha])
    td = model.transform(feats).withColumn("_p", vector_to_array("topicDistribution"))
    oov = F.aggregate(F.col("_p"), F.lit(0.0), lambda a, x: a + x) == 0
    td = td.withColumn("_p", F.when(oov, prior).otherwise(F.col("_p")))
    td = td.withColumn("topic_distribution", mixture_column(F.col("_p"), opts.min_prob))
    td = with_dominant(td.select(*DOC_KEYS, "topic_distribution"))
    return TopicModel(vocab=vocab, topic_terms=tt, document_topics=td, doc_concentration=alpha,
                      model=model)


# ------------------------------------------------------------------ T12
def topic_prevalence(document_topics: DataFrame, sessions: DataFrame,
                     session_keys: Sequence[str] = ("session_key",)) -> DataFrame:
    """Per session and topic, sum of probabilities over dialogue docs / number of them.

    Topics absent from every mixture of a session produce no row.
    """
    keys = list(session_keys)
    d = document_topics.where(F.col("doc_type") == "dialogue")
    n = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_docs"))
    s = d.select(*keys, F.explode("topic_distribution").alias("m")).groupBy(*keys, F.col("m.topic_id").alias("topic_id")) \
        .agg(F.sum("m.prob").alias("_sum"))
    p = s.join(n, keys).select(*keys, "topic_id", (F.col("_sum") / F.col("_docs")).alias("prevalence"))
    return sessions.join(p, keys)


# ------------------------------------------------------------------ T11
def top_words(topic_terms: DataFrame, n: int = 20) -> DataFrame:
    """Top ``n`` terms of each topic by weight (ties by term): (topic_id, term, rank)."""
    w = Window.partitionBy("topic_id").orderBy(F.col("weight").desc(), F.col("term").asc())
    return topic_terms.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n) \
        .select("topic_id", "term", "rank")


def coherence_cv(topic_terms: DataFrame, docs: Corpus | DataFrame, top_n: int = 20, window: int = 110,
                 block: int = 4096, models: Sequence[str] = ()) -> DataFrame:
    """c_v coherence (Röder et al. 2015) with a boolean sliding window.

    Probabilities are window counts: a document of length L >= W has
    L - W + 1 windows (shorter ones count as one window).  An occurrence at
    position p lies in windows [max(0, p-W+1), min(p, L-W)]; a word's
    windows in a document are the union of these intervals, so counts never
    enumerate windows.  Intervals are cut at blocks of ``block`` windows
    before they are merged (gaps and islands), so no window function spans a
    long document.  Pair counts are interval overlaps of the words that share a topic,
    met in (document, block, topic).  Returns (topic_id, coherence) rows plus
    topic_id = -1 for the mean over topics.  ``models`` names columns of ``topic_terms`` that tell several models
    apart: all are scored in the one pass, with a mean row each.
    """
    c, models = as_corpus(docs), list(models)
    ensure_checkpoint_dir(topic_terms.sparkSession)
    topic = [*models, "topic_id"]
    w = Window.partitionBy(*topic).orderBy(F.col("weight").desc(), F.col("term").asc())
    tw = topic_terms.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n) \
        .select(*topic, "term").checkpoint(eager=True)  # models x topics x top_n rows
    n_windows = c.docs.agg(F.sum(F.when(F.col("n_tokens") >= window, F.col("n_tokens") - window + 1)
                                 .otherwise(1)).cast("double").alias("_nw"))
    alone, met = c.stretches(tw, window)

    def cut(spans: DataFrame) -> DataFrame:
        last = F.col("n_tokens") - window
        lo = F.when(last >= 0, F.greatest(F.lit(0), F.col("first") - window + 1)).otherwise(0)
        hi = F.when(last >= 0, F.least(F.col("last"), last)).otherwise(0)
        occ = spans.select(*DOC_KEYS, "term", lo.alias("lo"), hi.alias("hi"))
        return occ.withColumn("_b", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor(F.col("hi") / block)))) \
            .select(*DOC_KEYS, "term", "_b", F.greatest("lo", F.col("_b") * block).alias("lo"),
                    F.least("hi", F.col("_b") * block + block - 1).alias("hi"))

    wk = Window.partitionBy(*DOC_KEYS, "term", "_b").orderBy("lo", "hi")
    isl = cut(met).withColumn("_prev", F.max("hi").over(wk.rowsBetween(Window.unboundedPreceding, -1))) \
        .withColumn("_new", F.when(F.col("_prev").isNull() | (F.col("lo") > F.col("_prev") + 1), 1).otherwise(0)) \
        .withColumn("_isl", F.sum("_new").over(wk.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy(*DOC_KEYS, "term", "_b", "_isl").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_isl")
    if alone is not None:  # stretches of one row that are more than a window apart are apart as intervals too
        isl = isl.unionByName(cut(alone))
    isl = stored(isl, "windows")  # read by the counts and the pair branch
    counts = isl.groupBy("term").agg(F.sum(F.col("hi") - F.col("lo") + 1).alias("c"))
    # all ordered pairs of top words inside each topic; each unordered pair is counted once for all models
    pairs = join_groups(tw.select(*topic, F.col("term").alias("wi")), tw.select(*topic, F.col("term").alias("wj")), topic)
    inside = F.struct(*topic).alias("_k")
    asked = pairs.where("wi < wj").groupBy(F.col("wi").alias("w1"), F.col("wj").alias("w2")).agg(F.min(inside).alias("_k"))
    # the words of a topic in one block meet in a list of at most their intervals there: an interval is shuffled
    # once for each topic of its word, not once for each word it is asked with
    met = isl.join(broadcast_if_small(tw.select(inside, "term").distinct()), "term") \
        .groupBy(*DOC_KEYS, "_b", "_k").agg(F.collect_list(F.struct("term", "lo", "hi")).alias("_l")).where(F.size("_l") > 1)
    met = met.select("_k", "_l", F.explode("_l").alias("x"))
    met = met.select("_k", "x", F.explode(F.filter("_l", lambda y: (y["term"] > F.col("x.term")) & (
        y["lo"] <= F.col("x.hi")) & (F.col("x.lo") <= y["hi"]))).alias("y"))
    met = met.select("_k", F.col("x.term").alias("w1"), F.col("y.term").alias("w2"), (
        F.least("x.hi", "y.hi") - F.greatest("x.lo", "y.lo") + 1).alias("n"))
    co = met.groupBy("_k", "w1", "w2").agg(F.sum("n").alias("co")).join(asked, ["_k", "w1", "w2"]).select("w1", "w2", "co")
    pairs = pairs.withColumn("w1", F.least("wi", "wj")).withColumn("w2", F.greatest("wi", "wj"))
    pairs = pairs.join(co, ["w1", "w2"], "left") \
        .join(counts.select(F.col("term").alias("wi"), F.col("c").alias("ci")), "wi") \
        .join(counts.select(F.col("term").alias("wj"), F.col("c").alias("cj")), "wj")
    pairs = with_scalar(pairs, n_windows)
    N = F.col("_nw")
    co_c = F.when(F.col("wi") == F.col("wj"), F.col("ci")).otherwise(F.coalesce(F.col("co"), F.lit(0)))
    pco = co_c / N
    npmi = F.log((pco + EPSILON) / ((F.col("ci") / N) * (F.col("cj") / N))) / (-F.log(pco + EPSILON))
    P = pairs.select(*topic, "wi", "wj", npmi.alias("npmi")).checkpoint(eager=True)  # models x k x top_n^2 rows
    V = P.groupBy(*topic, "wj").agg(F.sum("npmi").alias("vj"))
    vnorm = V.groupBy(*topic).agg(F.sqrt(F.sum(F.col("vj") * F.col("vj"))).alias("vn"))
    U = join_groups(P, V, [*topic, "wj"]).groupBy(*topic, "wi").agg(
        F.sum(F.col("npmi") * F.col("vj")).alias("dot"),
        F.sqrt(F.sum(F.col("npmi") * F.col("npmi"))).alias("un"))
    seg = join_groups(U, vnorm, topic).select(*topic, (F.col("dot") / (F.col("un") * F.col("vn"))).alias("cos"))
    per_topic = seg.groupBy(*topic).agg(F.avg("cos").alias("coherence"))
    overall = per_topic.groupBy(*models).agg(F.avg("coherence").alias("coherence")).select(
        *models, F.lit(-1).alias("topic_id"), "coherence")
    return per_topic.unionByName(overall)


# ------------------------------------------------------------------ D7
def tfidf(docs: Corpus | DataFrame, vocab: DataFrame | None = None) -> DataFrame:
    """(doc keys, term, tf, idf, tfidf) with idf = ln((N + 1) / (df + 1)), Spark ML's smoothing."""
    c = as_corpus(docs)
    df = with_scalar(document_frequency(c), c.docs.agg(F.count(F.lit(1)).alias("_n")))
    if vocab is not None:
        df = df.join(vocab.select("term"), "term")
    idf = F.log((F.col("_n") + 1) / (F.col("df") + 1))
    return c.counts.withColumnRenamed("count", "tf").join(broadcast_written(df, "frequencies"), "term").select(
        *DOC_KEYS, "term", "tf", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf"))


# ------------------------------------------------------------------ D9
def topic_labels(topic_terms: DataFrame, n: int = 3) -> DataFrame:
    """label = first ``n`` terms by weight, joined by ', '."""
    tw = top_words(topic_terms, n)
    return tw.groupBy("topic_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("rank", "term"))), lambda x: x["term"]), ", ").alias("label"))


def empty_topic_terms(spark) -> DataFrame:
    return spark.createDataFrame([], S.TOPIC_TERMS)


# ------------------------------------------------------------------ D8
def choose_k(docs: Corpus | DataFrame, ks: Sequence[int], opts: TopicOptions = TopicOptions(),
             min_coherence: float | None = None) -> DataFrame | None:
    """Fit T5 for each k and score it with T11; optionally drop topics under ``min_coherence``.

    Returns (k, topic_id, coherence, kept) with topic_id = -1 for the model mean; None without a vocabulary.
    Vocabulary and features are made once and shared by every fit; one pass over the corpus scores all models.
    """
    c = as_corpus(docs)
    ensure_checkpoint_dir(c.rows.sparkSession)
    vocab = vocabulary(c, opts).checkpoint(eager=True)
    n_terms = vocab.count()
    if not n_terms:
        return None
    feats = feature_vectors(c, vocab, n_terms)
    terms = None
    for k in ks:
        t = fit_topics(c, replace(opts, num_topics=k), vocab, feats).topic_terms.withColumn("k", F.lit(k))
        terms = t if terms is None else terms.unionByName(t)
    scores = coherence_cv(terms, c, opts.top_terms, opts.coherence_window, models=["k"])
    kept = (F.col("coherence") >= min_coherence) if min_coherence is not None else F.lit(True)
    return scores.select("topic_id", "coherence", "k", ((F.col("topic_id") < 0) | kept).alias("kept"))


def topics_along_session(document_topics: DataFrame, sessions: DataFrame, parts: int = 3) -> DataFrame:
    """Prevalence along a session: per session, part (1 to ``parts``, by the rank of its utterances) and topic.

    Utterances are dealt into parts of near equal size in order; the prevalence is the mean probability over the
    utterance documents of the part.  Ranks are block-wise, so no session is one window.
    """
    d = document_topics.where(F.col("doc_type") == "dialogue").select("session_key", "dialogue_idx", "topic_distribution")
    r = rank_within(d, ["session_key"], "dialogue_idx", "_rk", "_n")
    r = r.withColumn("part", (F.floor((F.col("_rk") - 1) * parts / F.col("_n")) + 1).cast("int"))
    t = r.select("session_key", "part", "_n", F.explode("topic_distribution").alias("m")).groupBy(
        "session_key", "part", F.col("m.topic_id").alias("topic_id")).agg(
        F.sum("m.prob").alias("_sum"), F.max("_n").alias("_n"))
    # ranks 0 to n - 1 fall into part p from ceil((p - 1) n / parts) on, so its size needs no second pass over the ranks
    def start(part: Column) -> Column:
        return F.ceil(part * F.col("_n") / parts)
    t = t.withColumn("utterances", start(F.col("part")) - start(F.col("part") - 1))
    p = t.select("session_key", "part", "topic_id", (F.col("_sum") / F.col("utterances")).alias("prevalence"), "utterances")
    return sessions.join(p, "session_key")
