"""Toxicity by compression distance: separate zstandard dictionaries for toxic and ordinary text.

Training takes a bounded sample of labelled documents.  Near copies count once.  Ordinary windows are cut
from ordinary documents.  The toxic dictionary is trained on windows of whole toxic texts, or, where beginnings of words
stand in many toxic and almost no ordinary documents, on the words marked by them: both are fitted and the one
that tells documents outside their training apart better is kept (whole texts on a tie).  The toxic side compresses
with both dictionaries' contents, the ordinary side with its own, so that the difference of the two
lengths is what toxic language alone saves.  Lengths of windows are compared with thresholds, and a
logistic model calibrated on labelled documents outside the dictionaries' training turns the
counts of such windows into a probability.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no import path

#: labelled documents of a class in the training sample, and characters of the sample
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 16_000_000
#: words in a window of marked words, and of whole texts (these overlap by half)
WINDOW, WHOLE_WINDOW = 1, 4
#: windows of a class that a dictionary of whole texts is trained on
TRAINING_WINDOWS = 60_000
#: bytes before every window that both dictionaries hold: a match there pays the fixed cost of a block
MARK = b"\n\x01window:\x02\x03\x04\x05\x06\x07\x08"
#: bytes after every window: the last eight bytes of a block never start a match
TAIL = b"\x0e\x0f\x10\x11\x12\x13\x14\x15"
DICTIONARY = {"toxic": 4096, "ordinary": 16384, "whole": 16384}
#: savings in bytes that make a window count
STEPS, WHOLE_STEPS = (2, 3, 4, 5), (3, 5, 8, 12)
THRESHOLD = 0.3
#: windows whose lengths a task remembers
CACHE = 400_000


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    window: int = WINDOW


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels may not be learnt."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _signature(words: list[str]) -> list[tuple[int, int]]:
    """Four minimum hashes of 4-word shingles."""
    import xxhash
    if len(words) < 8:
        return [(0, xxhash.xxh64_intdigest(" ".join(words)))]
    h = np.fromiter((xxhash.xxh64_intdigest(" ".join(s)) for s in zip(words, words[1:], words[2:], words[3:])), dtype=np.uint64)
    odd = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
    return [(k, int((h * np.uint64(m)).min())) for k, m in enumerate(odd)]


def without_copies(rows: list[tuple[str, int]]) -> list[tuple[list[str], int]]:
    """Words and label of the sample's documents, the first of near copies only."""
    seen: set = set()
    out = []
    for text, label in rows:
        words = words_of(text)
        sig = _signature(words)
        if not any(s in seen for s in sig):
            out.append((words, label))
        seen.update(sig)
    return out


def toxic_beginnings(docs: list[tuple[list[str], int]], least: int = 5, most: int = 12) -> set[str]:
    """Beginnings of words (with the space before) that mark toxic documents."""
    df = {0: Counter(), 1: Counter()}
    n = Counter(label for _, label in docs)
    for words, label in docs:
        df[label].update({w[:k] for w in {" " + x + " " for x in words} for k in range(least, min(len(w), most) + 1)})
    floor = max(3, 0.015 * n[1])
    return {b for b, k in df[1].items() if k >= floor and
            math.log((k + 0.5) / (n[1] + 1)) - math.log((df[0][b] + 0.5) / (n[0] + 1)) > 3}


def marked(words: list[str], beginnings: set[str], least: int = 5, most: int = 12) -> list[str]:
    out = []
    for w in words:
        p = " " + w + " "
        if any(p[:k] in beginnings for k in range(least, min(len(p), most) + 1)):
            out.append(w)
    return out


def windows_of(words: list[str], size: int) -> list[str]:
    """Windows of ``size`` words, each begun half a window after the last; the whole text if it is shorter."""
    if size == 1:
        return words
    return [" ".join(words[i:i + size]) for i in range(0, max(1, len(words) - size // 2), max(1, size // 2))] if words else []


def train_dictionary(windows: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; the windows themselves when they are too few to train one."""
    import zstandard
    try:
        return zstandard.train_dictionary(size, windows).as_bytes()[-(size - 512):]
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(windows))[-size:]


class Scorer:
    """Window savings of texts under a model; lengths of repeated windows are remembered."""

    def __init__(self, ordinary: bytes, toxic: bytes, window: int = WINDOW):
        self.window, self.steps = window, STEPS if window == WINDOW else WHOLE_STEPS
        self.sides = [self._compressor(ordinary + MARK), self._compressor(ordinary + toxic + MARK)]
        self.known: dict[str, int] = {}

    @staticmethod
    def _compressor(content: bytes):
        import zstandard as z
        d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        p = z.ZstdCompressionParameters(write_content_size=0, write_checksum=0, write_dict_id=0, window_log=17,
                                        hash_log=14, chain_log=14, search_log=4, min_match=3, target_length=32,
                                        strategy=z.STRATEGY_BTOPT)
        d.precompute_compress(compression_params=p)
        return z.ZstdCompressor(dict_data=d, compression_params=p)

    def saving(self, window: str) -> int:
        v = self.known.get(window)
        if v is None:
            data = MARK + b" " + window.encode("utf-8", "surrogatepass") + b" " + TAIL
            v = len(self.sides[0].compress(data)) - len(self.sides[1].compress(data))
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[window] = v
        return v

    def features(self, words: list[str]) -> np.ndarray:
        """1, log of the number of windows, log counts of windows that save at least so much."""
        counts = [0] * len(self.steps)
        n = 0
        for window in windows_of(words, self.window):
            n += 1
            v = self.saving(window)
            if v >= self.steps[0]:
                for i, step in enumerate(self.steps):
                    counts[i] += v >= step
        return np.array([1.0, math.log1p(n), *[math.log1p(c) for c in counts], *[float(c > 0) for c in counts]])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.02) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    pen = np.eye(x.shape[1]) * ridge
    pen[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        s = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * s[:, None]).T @ x / weight.sum() + pen / len(y) * 20,
                               x.T @ (weight * (y - p)) / weight.sum() - pen @ w / len(y) * 20)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def separation(scores: np.ndarray, y: np.ndarray) -> float:
    """Chance that a toxic text scores higher than an ordinary one (area under the curve, ties half)."""
    order = np.argsort(scores, kind="stable")
    _, inverse, n = np.unique(scores[order], return_inverse=True, return_counts=True)
    rank = np.empty(len(scores))
    rank[order] = (np.cumsum(n) - (n - 1) / 2)[inverse]
    ones = y == 1
    return float((rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum()))


def fit_sample(rows: list[tuple[str, int]], share: dict[int, float]) -> Model | None:
    """Train from (text, label) rows; ``share``: the classes' shares of all training labels.  None without words of
    both classes on both sides of the split."""
    docs = [d for d in without_copies(rows) if d[0]]
    fit, rest = [d for i, d in enumerate(docs) if i % 3], [d for i, d in enumerate(docs) if i % 3 == 0]
    if {y for _, y in fit} != {0, 1} or {y for _, y in rest} != {0, 1}:
        return None
    encoded = lambda x: (" " + x + " ").encode("utf-8", "surrogatepass")
    y = np.array([y for _, y in rest], dtype=float)
    mean = {c: share[c] / max((y == c).mean(), 1e-9) for c in (0, 1)}

    def fitted(ordinary: list[bytes], toxic: list[bytes], size: int, window: int) -> tuple[float, Model]:
        ordinary_dict, toxic_dict = train_dictionary(ordinary, DICTIONARY["ordinary"]), train_dictionary(toxic, size)
        scorer = Scorer(ordinary_dict, toxic_dict, window)
        x = np.array([scorer.features(w) for w, _ in rest])
        weights = logistic(x, y, np.where(y == 1, mean[1], mean[0]))
        return separation(np.round(x @ weights, 9), y), Model(ordinary_dict, toxic_dict, tuple(float(v) for v in weights), window)

    def spread(label: int) -> list[bytes]:
        """At most TRAINING_WINDOWS windows of whole texts, evenly from all of the class."""
        found = [encoded(x) for w, c in fit if c == label for x in windows_of(w, WHOLE_WINDOW)]
        return found[::-(-len(found) // TRAINING_WINDOWS)]

    best = fitted(spread(0), spread(1), DICTIONARY["whole"], WHOLE_WINDOW)
    beginnings = toxic_beginnings(fit)
    toxic = [encoded(" ".join(m)) for w, c in fit if c == 1 and (m := marked(w, beginnings))]
    if toxic:
        ordinary = [(" " + " ".join(w[s:s + 8])).encode("utf-8", "surrogatepass") for w, c in fit if c == 0 for s in range(0, len(w), 64)]
        other = fitted(ordinary, toxic, DICTIONARY["toxic"], WINDOW)
        best = max(best, other, key=lambda m: m[0])
    return best[1]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """Train on labelled rows outside the held-out quarter.

    The sample: per class the ``sample_rows`` documents of smallest id hash; of those, whole texts
    in the order of the hash until the class has half of ``sample_chars``.  None without both classes.
    """
    lab = labels.select(F.col(doc_id).alias("__l"), F.col(label).cast("int").alias("__y")) \
        .where(F.col("__y").isin(0, 1) & F.col("__l").isNotNull()).where(~held_out("__l"))
    n = {r["__y"]: r["n"] for r in lab.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(n) != {0, 1}:
        return None
    lab = lab.distinct().withColumn("__k", F.xxhash64(F.lit(7), "__l"))
    few = [lab.where(F.col("__y") == y).orderBy("__k", "__l").limit(sample_rows) for y in (0, 1)]
    few = few[0].unionByName(few[1])
    got = written(docs.select(F.col(doc_id).alias("__d"), F.col(text).alias("__t")).where("__t is not null")
                  .join(F.broadcast(few), F.col("__d") == F.col("__l"))  # at most 2 * sample_rows narrow rows
                  .select("__k", "__y", "__t"))
    sizes = got.select("__k", "__y", F.length("__t").alias("__n"), F.xxhash64("__t").alias("__h")).distinct()
    left = {y: sample_chars // 2 for y in (0, 1)}
    chosen = []
    for r in sizes.orderBy("__k", "__y", "__h").limit(2 * sample_rows).collect():
        if r["__n"] <= left[r["__y"]]:
            left[r["__y"]] -= r["__n"]
            chosen.append((r["__k"], r["__y"], r["__h"]))
    if not chosen:
        return None
    spark = docs.sparkSession
    wanted = spark.createDataFrame(chosen, "__k long, __y int, __h long")
    texts = got.withColumn("__h", F.xxhash64("__t")).join(F.broadcast(wanted), ["__k", "__y", "__h"], "left_semi") \
        .dropDuplicates(["__k", "__y", "__h"]).orderBy("__k", "__y", "__h").select("__t", "__y").collect()
    total = n[0] + n[1]
    return fit_sample([(r["__t"], r["__y"]) for r in texts], {y: n[y] / total for y in (0, 1)})


def score_toxicity(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every input row, from the text alone.

    Null and empty texts have no windows and get the score of that; without a model every score is
    0; a null id is not held out; repeated rows come out as often as they come in; an empty table
    gives no rows; other columns are not read.  Whole texts are scored.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__t"))
    kind = narrow.schema["__id"].dataType.simpleString()

    def score(batches):
        import pyarrow as pa
        scorer = Scorer(model.ordinary, model.toxic, model.window) if model else None
        weights = np.array(model.weights) if model else None
        for b in batches:
            out = []
            for t in b.column("__t").to_pylist():
                z = float(scorer.features(words_of(t)) @ weights) if model else -math.inf
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) if model else 0.0)
            yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(out, pa.float64())], names=["__id", "__score"])

    s = narrow.mapInArrow(score, f"__id {kind}, __score double")
    return s.select(F.col("__id").alias(doc_id), held_out("__id").alias("held_out"), F.round("__score", 6).alias("score"),
                    (F.round("__score", 6) >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores below ``threshold``, with all their columns."""
    model = train(docs, labels, doc_id, text)
    small_batches(docs.sparkSession)
    fields = docs.columns

    def clean(batches):
        import pyarrow as pa
        scorer = Scorer(model.ordinary, model.toxic, model.window)
        weights = np.array(model.weights)
        for b in batches:
            keep = []
            for t in b.column(fields.index(text)).to_pylist():
                z = float(scorer.features(words_of(t)) @ weights)
                keep.append(round(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), 6) < threshold)
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs if model is None else docs.mapInArrow(clean, docs.schema)
