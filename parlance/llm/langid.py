"""Language identification by Bayesian evidence fusion.

Evidence: byte-trigram likelihoods of the text, the language that the markup declares, the
address suffix, and a prior of the host that is smoothed towards its domain and that towards all
hosts.  Likelihoods of markup and suffix and the priors are grouped aggregates of what the texts
say, so no rows meet but in sums.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sized, small_batches, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no import path

#: labelled rows that a language needs to be learnt
LEAST_ROWS = 20
#: answer for a text that no learnt language explains
OTHER = "other"
#: a text fits a language if its mean log-likelihood is at most so much below the language's own, in nats and in
#: standard errors; neighbouring trigrams are one observation in so many; shorter texts always fit
SLACK, ERRORS, DEPENDENT, LEAST_TRIGRAMS = 2.0, 6.0, 3.0, 30
BUCKETS = 1 << 16
#: share of a text's log-likelihood that counts: neighbouring trigrams say the same thing again
TEMPER = 0.3
#: weight of a parent's prior in rows; added count of a declared language or suffix
HOST_ROWS, DOMAIN_ROWS, ADDED = 5.0, 20.0, 0.5
_LETTERS = None


def trigrams(text: str | None, block: int = 1 << 20):
    """Hashed byte trigrams of the lower-cased text, without digits and ASCII signs, in blocks."""
    global _LETTERS
    if _LETTERS is None:
        keep = np.arange(256)
        low = keep < 128
        letters = ((keep >= 97) & (keep <= 122)) | ~low
        _LETTERS = np.where(letters, keep, 32).astype(np.uint32)
    data = (text or "").lower().encode("utf-8", "surrogatepass")
    for at in range(0, max(0, len(data) - 2), block):
        b = _LETTERS[np.frombuffer(data[at:at + block + 2], dtype=np.uint8)]
        if len(b) < 3:
            return
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        spaces = ((b[:-2] == 32).astype(np.int8) + (b[1:-1] == 32) + (b[2:] == 32)) < 2
        yield ((code[spaces] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def learnt_languages(labelled: DataFrame, least_rows: int = LEAST_ROWS) -> tuple[str, ...]:
    """The labels ``__lang`` of at least ``least_rows`` rows with a text, in order (one grouped count)."""
    rows = labelled.where((F.length("__t") > 0) & (F.length(F.trim("__lang")) > 0)).groupBy("__lang").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_rows)
    return tuple(sorted(r["__lang"] for r in rows.collect()))


@dataclass(frozen=True)
class Model:
    """Languages and the log-probabilities (language, bucket) of their trigrams."""

    languages: tuple[str, ...]
    table: np.ndarray


def text_model(labelled: DataFrame, languages: tuple[str, ...] | None = None) -> Model:
    """Trigram model of the given languages or of those that the labels name, counted over all labelled rows.

    ``labelled``: ``__t`` and ``__lang``; rows of other labels and nulls are left out.  At most
    languages * BUCKETS sums come to the driver.
    """
    small_batches(labelled.sparkSession)
    if languages is None:
        languages = learnt_languages(labelled)
    if not languages:
        return Model((), np.zeros((0, BUCKETS), np.float32))

    def count(batches):
        import pyarrow as pa
        n = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        at = {lang: i for i, lang in enumerate(languages)}
        for b in batches:
            for t, lang in zip(b.column("__t").to_pylist(), b.column("__lang").to_pylist()):
                if lang in at:
                    for g in trigrams(t):
                        n[at[lang]] += np.bincount(g, minlength=BUCKETS)
        i, k = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(i * BUCKETS + k, pa.int64()), pa.array(n[i, k], pa.int64())], names=["k", "n"])

    sums = labelled.mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    counts = np.full(len(languages) * BUCKETS, 0.1)
    counts[sums["k"].to_numpy(dtype=np.int64)] += sums["n"].to_numpy(dtype=np.float64)
    counts = counts.reshape(len(languages), BUCKETS)
    return Model(tuple(languages), np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


def text_evidence(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """Replace ``__t`` by ``l0, l1, ...``, tempered log-likelihoods of which the largest is zero, and ``__fits``.

    A text does not fit if even its best language gives it a mean log-likelihood far below that of the
    language's own trigrams (whose mean and variance follow from the model).
    """
    share = np.exp(model.astype(np.float64))
    own = (share * model).sum(axis=1)
    spread = np.maximum((share * model.astype(np.float64) ** 2).sum(axis=1) - own ** 2, 0)
    small_batches(rows.sparkSession)
    names = [c for c in rows.columns if c != "__t"]
    like = [f"l{i}" for i in range(len(model))]

    def score(batches):
        import pyarrow as pa
        for b in batches:
            out, n = np.zeros((b.num_rows, len(model))), np.zeros(b.num_rows)
            for i, t in enumerate(b.column(b.schema.names.index("__t")).to_pylist()):
                for g in trigrams(t):
                    out[i] += model[:, g].sum(axis=1, dtype=np.float64)
                    n[i] += len(g)
            best, many = (out.argmax(axis=1) if len(out) else np.zeros(0, int)), np.maximum(n, 1)
            least = own[best] - SLACK - ERRORS * np.sqrt(spread[best] * DEPENDENT / many)
            fits = (n < LEAST_TRIGRAMS) | (out[np.arange(len(out)), best] / many >= least)
            out = TEMPER * (out - out.max(axis=1, keepdims=True)) if len(out) else out
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.names.index(n)) for n in names] + [pa.array(out[:, k]) for k in range(len(model))] + [pa.array(fits)],
                names=names + like + ["__fits"])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "__t"]
    return rows.mapInArrow(score, ", ".join(kinds + [f"{n} double" for n in like] + ["`__fits` boolean"]))


def html_language(html: Column) -> Column:
    """The primary tag that the markup declares, in lower case; null without one."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1)), F.lit(""))


def html_text(html: Column) -> Column:
    t = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ")
    return F.regexp_replace(F.regexp_replace(t, r"<[^>]*>", " "), r"&#?\w+;", " ")


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """Add ``language, confidence, text_language`` to the other columns of ``rows``; ``__t`` goes.

    ``rows``: ``__t`` (text), ``__host``, ``__domain``, ``__suffix``, ``__declared`` and any others.  Evidence
    that is null or empty says nothing: a text without trigrams has equal likelihoods, a null host
    has the prior of all rows.  A text that fits none of the model's languages is ``other``, with null confidence, and
    counts for no prior.  Ties go to the first language.  Repeated rows come out as often as
    they come in and count as often; an empty table gives no rows; without languages all answers are null.
    """
    languages = model.languages
    if not languages:
        nothing = F.lit(None).cast("string")
        out = [c for c in rows.columns if not c.startswith("__")]
        return rows.select(*out, nothing.alias("language"), F.lit(None).cast("double").alias("confidence"), nothing.alias("text_language"))
    n = len(languages)
    like = [f"l{i}" for i in range(n)]
    s = written(text_evidence(rows, model.table))
    total = sum((F.exp(F.col(c)) for c in like), F.lit(0.0))
    share = [F.when(F.col("__fits"), F.exp(F.col(c)) / total).otherwise(0.0).alias(f"q{i}") for i, c in enumerate(like)]
    soft = s.select("__host", "__domain", "__suffix", "__declared", *share)
    sums = lambda *by: soft.groupBy(*by).agg(*[F.sum(f"q{i}").alias(f"n{i}") for i in range(n)])

    def told(column: str) -> tuple[DataFrame, list[str]]:
        """Likelihoods of the values of a column given each language, smoothed over the values seen."""
        t = written(sums(column).where(F.col(column).isNotNull()))
        r = t.agg(F.count(F.lit(1)).alias("k"), *[F.sum(f"n{i}").alias(f"n{i}") for i in range(n)]).first()
        names = [f"{column}_{i}" for i in range(n)]
        p = [F.log((F.col(f"n{i}") + ADDED) / F.lit(float((r[f"n{i}"] or 0) + ADDED * (r["k"] + 1)))).alias(names[i])
             for i in range(n)]
        return written(t.select(F.col(column).alias(f"{column}_v"), *p)), names

    everything = sums().first()
    rows_in = sum(everything[f"n{i}"] or 0 for i in range(n))
    base = [((everything[f"n{i}"] or 0) + 1) / (rows_in + n) for i in range(n)]
    hosts = written(sums("__host", "__domain").where("__host is not null"))
    count = lambda p: sum((F.col(f"{p}{i}") for i in range(n)), F.lit(0.0))
    domains = hosts.groupBy("__domain").agg(*[F.sum(f"n{i}").alias(f"d{i}") for i in range(n)])
    domains = domains.select(F.col("__domain").alias("__dv"), *[
        ((F.col(f"d{i}") + DOMAIN_ROWS * base[i]) / (count("d") + DOMAIN_ROWS)).alias(f"p{i}") for i in range(n)])
    hosts = hosts.join(domains, F.col("__domain").eqNullSafe(F.col("__dv")))
    hosts = written(hosts.select(F.col("__host").alias("__hv"), F.col("__domain").alias("__hd"), *[
        F.log((F.col(f"n{i}") + HOST_ROWS * F.col(f"p{i}")) / (count("n") + HOST_ROWS)).alias(f"h{i}") for i in range(n)]))
    declared, dn = told("__declared")
    suffix, sn = told("__suffix")
    j = s.join(sized(hosts), (F.col("__host") == F.col("__hv")) & F.col("__domain").eqNullSafe(F.col("__hd")), "left") \
        .join(sized(declared), F.col("__declared") == F.col("__declared_v"), "left") \
        .join(sized(suffix), F.col("__suffix") == F.col("__suffix_v"), "left")
    zero = F.lit(0.0)
    post = [F.col(like[i]) + F.coalesce(F.col(f"h{i}"), F.lit(math.log(base[i]))) + F.coalesce(F.col(dn[i]), zero)
            + F.coalesce(F.col(sn[i]), zero) for i in range(n)]
    out = [c for c in s.columns if not c.startswith("__") and c not in like]
    j = j.select(*out, *like, "__fits", *[p.alias(f"z{i}") for i, p in enumerate(post)])
    best = F.greatest(*[F.col(f"z{i}") for i in range(n)], F.lit(-math.inf))
    norm = sum((F.exp(F.col(f"z{i}") - best) for i in range(n)), zero)

    def first(prefix: str, top: Column) -> Column:
        c = F.lit(languages[-1])
        for i in range(n - 2, -1, -1):
            c = F.when(F.col(f"{prefix}{i}") == top, F.lit(languages[i])).otherwise(c)
        return c

    known = F.col("__fits")
    return j.select(*out, F.when(known, first("z", best)).otherwise(OTHER).alias("language"),
                    F.when(known, F.round(1 / norm, 4)).alias("confidence"),
                    F.when(known, first("l", F.greatest(*like, F.lit(-math.inf)))).otherwise(OTHER).alias("text_language"))


def page_rows(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as rows of evidence."""
    host = F.nullif(F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    domain = F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit(""))
    suffix = F.nullif(F.regexp_extract(host, r"\.([a-z]{2,})$", 1), F.lit(""))
    return pages.select(F.lit(None).cast("long").alias("doc_id"), F.col(page_id).cast("long").alias("page_id"),
                        html_text(F.col(html)).alias("__t"), host.alias("__host"), domain.alias("__domain"),
                        suffix.alias("__suffix"), html_language(F.col(html)).alias("__declared"))


def document_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Plain documents as rows of evidence: the source stands for the host, there is no markup or address."""
    none = F.lit(None).cast("string")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"),
                       F.col(text).alias("__t"), F.concat(F.lit("source "), F.col(source)).alias("__host"),
                       F.lit("source").alias("__domain"), none.alias("__suffix"), none.alias("__declared"))
