"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into overlapping windows (passages).  A window is the sum of its words' TF-IDF
vectors, projected to a latent space by a randomised SVD whose products with the passage matrix
are computed by Spark.  Windows near a benchmark item by cosine are verified word by word: the
longest common subsequence must hold most of the item, and the item's answer must be there.

The terms are those of the benchmark: other words have no weight against any item.  The
benchmark is the stated query set and goes through in blocks of bounded size.
"""

from __future__ import annotations

import re
import sys
import uuid
from bisect import bisect_right
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, sized, workspace, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no import path

#: benchmark items that go through together
BLOCK_ITEMS = 1000
#: latent dimensions, and those added in the search for them
RANK, EXTRA = 128, 8
#: an item weighs as much in the basis as in a corpus of so many passages, if there are more
ITEM_SHARE = 20_000
#: most terms whose products are summed pair by pair in a task, and numbers worked on at once
GRAM_TERMS, AT_ONCE = 4096, 1 << 14
#: words in a step of a window; a window has 4, 8, 16, ... steps and moves by a quarter of itself
STEP = 6
#: smallest cosine of a candidate, share of the item in the common subsequence, share of its answer
MIN_COSINE, MIN_COMMON, MIN_ANSWER = 0.35, 0.75, 0.5
#: words at an item's end that are its answer, when no marker says where it begins
ANSWER_WORDS = 4
ANSWER_MARK = re.compile(r"\b(?:answer|réponse|antwort|respuesta)\s*:", re.IGNORECASE)
#: items with fewer words must stand in a text as they are; they are looked up by their first word, not by cosine
SHORT_ITEM = 8
#: steps that are projected at once, and (window, item) pairs whose words are counted at once
CHUNK, PAIRS = 8192, 2048

_SIGNS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words: ASCII signs and white space part them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_SIGNS).split() if text else []


@dataclass
class Item:
    item_id: object
    words: list[bytes]
    answer: list[bytes]

    def __post_init__(self):
        self.terms = frozenset(self.words)


def read_item(item_id, text: str | None) -> Item | None:
    """An item's words and answer; None for an item without words, which matches nothing."""
    words = tokens(text)
    if not words:
        return None
    mark = ANSWER_MARK.search(text)
    answer = tokens(text[mark.end():]) if mark else []
    return Item(item_id, words, answer or words[-ANSWER_WORDS:])


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    place: dict = {}
    for i, w in enumerate(a):
        place[w] = place.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & place.get(w, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def scale_of(n_words: int) -> int:
    """Steps of the window that wholly holds an item of so many words wherever it stands."""
    steps = 4
    while 3 * steps * STEP // 4 < n_words:
        steps *= 2
    return steps


def step_sums(ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of the word vectors over each STEP words; the last row of ``weights`` is for other words (zero)."""
    other = len(weights) - 1
    ids = np.concatenate([ids, np.full(-len(ids) % STEP, other, dtype=ids.dtype)]).reshape(-1, STEP)
    out = weights[ids[:, 0]]
    for j in range(1, STEP):
        out += weights[ids[:, j]]
    return out


def window_sums(steps: np.ndarray, scales: list[int]):
    """(m, sums) for windows of m = 4, 8, 16, ... steps; window w starts at step w * m / 4."""
    steps = np.concatenate([steps, np.zeros((-len(steps) % max(scales) + max(scales), steps.shape[1]), np.float32)])
    pairs = steps[:-1] + steps[1:]
    sums, m = pairs[:-2] + pairs[2:], 4
    while True:
        if m in scales:
            yield m, sums
        if m >= max(scales):
            return
        sums, m = sums[:-4:2] + sums[4::2], 2 * m


def normed(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 0, n, 1)


class Search:
    """A block of items and the latent space they are compared in (what tasks get)."""

    def __init__(self, items: list[Item], idf: np.ndarray, vocab: dict[str, int], basis: np.ndarray):
        self.items, self.vocab = items, vocab
        self.weights = np.vstack([(idf[:, None] * basis), np.zeros((1, basis.shape[1]))]).astype(np.float32)
        self.scales: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.short: dict[bytes, list[int]] = {}
        for k, i in enumerate(items):
            if len(i.words) < SHORT_ITEM:
                self.short.setdefault(i.words[0], []).append(k)
        #: how often each item has each term; the last column is for other words
        self.counts = np.zeros((len(items), len(vocab) + 1), dtype=np.uint16)
        self.lengths = np.array([len(i.words) for i in items])
        for k, i in enumerate(items):
            terms, n = np.unique(self.ids(i.words), return_counts=True)
            self.counts[k, terms] = np.minimum(n, 65535)
        self.counts[:, len(vocab)] = 0
        self.member = self.counts.ravel() > 0
        long = [(k, scale_of(len(i.words))) for k, i in enumerate(items) if len(i.words) >= SHORT_ITEM]
        for m in sorted({scale for _, scale in long}):
            of = [k for k, scale in long if scale == m]
            vec = np.array([self.weights[self.ids(items[k].words)].sum(axis=0) for k in of])
            self.scales[m] = (np.array(of), normed(vec))

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocab.get, words, repeat(len(self.vocab))), np.int64, len(words))

    def candidates(self, ids: np.ndarray):
        """(item, first word, end word, cosine) of the windows near an item, in a run of words."""
        if not self.scales:
            return
        scales, most = list(self.scales), max(self.scales)
        padded = np.concatenate([ids, np.full(2 * most * STEP, len(self.vocab), dtype=ids.dtype)])
        for at in range(0, max(1, len(ids)), CHUNK * STEP):
            steps = step_sums(ids[at:at + (CHUNK + most) * STEP], self.weights)
            for m, sums in window_sums(steps, scales):
                of, vec = self.scales[m]
                sums = sums[:CHUNK * 4 // m]
                size = np.sqrt(np.einsum("ij,ij->i", sums, sums))
                cos = (sums @ vec.T) / np.where(size > 0, size, 1)[:, None]
                w, k = np.nonzero(cos >= MIN_COSINE)
                begin, item = at + w * (m // 4) * STEP, of[k]
                for lo in range(0, len(w), PAIRS):
                    part = slice(lo, lo + PAIRS)
                    for x in lo + np.flatnonzero(self.possible(padded, begin[part], m * STEP, item[part])):
                        yield int(item[x]), int(begin[x]), int(begin[x]) + m * STEP, float(cos[w[x], k[x]])

    def possible(self, ids: np.ndarray, begin: np.ndarray, size: int, item: np.ndarray) -> np.ndarray:
        """Which (window, item) pairs share enough words for a common subsequence of MIN_COMMON of the item.

        The subsequence is no longer than the words that both have, each as often as the side that has it less often:
        a pair that fails cannot pass the word check.  First without regard to repeats, then exactly.
        """
        need = np.ceil(MIN_COMMON * self.lengths[item] - 1e-9)
        window = ids[begin + np.arange(size)[:, None]]  # a column per pair
        member = self.member.take(window + item * self.counts.shape[1])
        out = member.sum(axis=0, dtype=np.int64) >= need
        left = np.flatnonzero(out)
        if len(left):
            words = np.sort(np.where(member[:, left], window[:, left], len(self.vocab)).T, axis=1)
            at = np.arange(size)
            first = np.ones(words.shape, bool)
            first[:, 1:] = words[:, 1:] != words[:, :-1]
            seen = at - np.maximum.accumulate(np.where(first, at, 0), axis=1)
            out[left] = (seen < self.counts[item[left][:, None], words]).sum(axis=1) >= need[left]
        return out

    def verified(self, item: Item, part: list[bytes]) -> tuple[float, float] | None:
        """Shares of the item and of its answer in the common subsequence with a window, if they suffice."""
        n = len(item.words)
        if len(item.terms.intersection(part)) < len(item.terms) - (1 - MIN_COMMON) * n:
            return None  # too many of the item's words are missing
        common = common_subsequence(item.words, part) / n
        if common < MIN_COMMON:
            return None
        answer = common_subsequence(item.answer, part) / len(item.answer)
        return (common, answer) if answer >= MIN_ANSWER else None

    def short_places(self, words: list[bytes]):
        """(item, first word) where a text holds a short item as it is."""
        for at in [i for i, w in enumerate(words) if w in self.short] if self.short else []:
            for k in self.short[words[at]]:
                part = self.items[k].words
                if words[at:at + len(part)] == part:
                    yield k, at

    def matches(self, texts: list[str | None]) -> list[tuple]:
        """(text, item, cosine, common, answer, first word) of the items that the texts hold.

        The texts are laid one after the other, each from the start of a step, and searched as one
        run of words; a window is verified in every text it touches.
        """
        if not self.items:
            return []
        run, begins, lengths = [], [], []
        words_of = []
        for t in texts:
            w = tokens(t)
            begins.append(len(run))
            lengths.append(len(w))
            words_of.append(w)
            run.extend(w)
            run.extend([b""] * (-len(w) % STEP))
        best: dict[tuple[int, int], tuple] = {}
        for i, words in enumerate(words_of):
            for k, at in self.short_places(words):
                best.setdefault((i, k), (1.0, 1.0, 1.0, -at))
        for k, s, e, cos in self.candidates(self.ids(run)):
            i = bisect_right(begins, s) - 1
            while i < len(texts) and begins[i] < e:
                lo = max(0, s - begins[i])
                part = words_of[i][lo:max(0, e - begins[i])]
                if part and (got := self.verified(self.items[k], part)):
                    best[i, k] = max(best.get((i, k), (0.0, 0.0, 0.0, 0)), (*got, cos, -lo))
                i += 1
        return [(i, k, cos, common, answer, -lo) for (i, k), (common, answer, cos, lo) in sorted(best.items())]


def cut_passages(docs: DataFrame, vocab: dict[str, int], path: str) -> DataFrame:
    """The passages of all rows, written: ``terms, n, sizes``, a row per document that has benchmark terms.

    ``sizes`` are the numbers of distinct terms in its passages, ``terms`` and ``n`` those terms and how often each occurs.
    A task adds a row per term with the number of its documents that have it (``term, docs``; -1: all its documents, -2: passages).
    """
    size = 8 * STEP

    def cut(batches):
        import pyarrow as pa
        get, other = vocab.get, len(vocab)
        df, n_docs, n_passages = np.zeros(other, np.int64), 0, 0
        lists, names = pa.list_(pa.int32()), ["terms", "n", "sizes", "term", "docs"]
        for b in batches:
            ids, passage, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
            for k, t in enumerate(b.column("__t").to_pylist()):
                w = tokens(t)
                ids.append(np.fromiter(map(get, w, repeat(other)), np.int64, len(w)))
                passage.append(len(owner) + np.arange(len(w)) // size)
                owner += [k] * -(-len(w) // size)
            n_docs += b.num_rows
            ids, passage = np.concatenate(ids), np.concatenate(passage)
            known = ids < other
            keys, n = np.unique(passage[known] * other + ids[known], return_counts=True)
            if not len(keys):
                continue
            passage, terms = np.divmod(keys, other)
            doc = np.array(owner)[passage]
            df += np.bincount(np.unique(doc * other + terms) % other, minlength=other)
            first = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
            n_passages += len(first)

            def by_doc(of: np.ndarray, values: np.ndarray):
                at = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(of))
                return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))

            out = [by_doc(doc, terms), by_doc(doc, n), by_doc(doc[first], np.diff(np.append(first, len(doc))))]
            yield pa.RecordBatch.from_arrays(out + [pa.nulls(len(out[0]), k) for k in (pa.int32(), pa.int64())], names=names)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(seen) + 2, lists)] * 3 + [
            pa.array(np.append([-1, -2], seen), pa.int32()), pa.array(np.append([n_docs, n_passages], df[seen]), pa.int64())], names=names)

    return written(docs.mapInArrow(cut, "terms array<int>, n array<int>, sizes array<int>, term int, docs long"), path)


def document_frequencies(passages: DataFrame, vocab: dict[str, int]) -> tuple[int, int, np.ndarray]:
    """Documents, passages, and documents with each term, over all rows."""
    got = dict(tuple(r) for r in passages.where("term is not null").groupBy("term")
               .agg(F.sum("docs")).collect())  # one row per benchmark term
    df = np.zeros(len(vocab))
    for k, v in got.items():
        if k >= 0:
            df[k] = v
    return got.get(-1, 0), got.get(-2, 0), df


def products(tables, idf: np.ndarray, q: np.ndarray, pairwise: bool) -> np.ndarray:
    """AᵀA q for the TF-IDF matrix A of the passages in (terms, n, sizes) arrays.

    ``pairwise`` sums the products of the terms of a passage, each pair once and frequent terms beside each other, and
    multiplies by ``q`` at the end (8 bytes for each pair of terms); else ``q`` is multiplied passage by passage.
    """
    out, cols = np.zeros_like(q), q.shape[1]
    gram = np.zeros(len(q) ** 2 if pairwise else 0)
    order = np.argsort(idf, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    for terms, n, sizes in tables:
        starts = np.cumsum(sizes) - sizes
        a = n * idf[terms]
        a = a / np.repeat(np.sqrt(np.add.reduceat(a * a, starts)), sizes)
        for d in np.unique(sizes):
            of, (i, j) = starts[sizes == d], np.triu_indices(d if pairwise else 0)
            step = max(1, AT_ONCE // (len(i) if pairwise else d * cols))
            for lo in range(0, len(of), step):
                at = of[lo:lo + step, None] + np.arange(d)
                t, x = terms[at], a[at]
                if pairwise:
                    t = rank[t]
                    up = np.argsort(t, axis=1)
                    t, x = (np.take_along_axis(v, up, 1).T.copy() for v in (t, x))
                    np.add.at(gram, (t[i] * len(q) + t[j]).ravel(), (x[i] * x[j]).ravel())
                    continue
                rows = x[:, :, None] * (x[:, None] @ q[t])
                by_term = np.argsort(t, axis=None, kind="stable")
                t = t.ravel()[by_term]
                first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
                out[t[first]] += np.add.reduceat(rows.reshape(-1, cols)[by_term], first, axis=0)
    if pairwise:
        gram = gram.reshape(len(q), len(q))
        out[order] = gram @ q[order] + gram.T @ q[order] - gram.diagonal()[:, None] * q[order]
    return out


def gram_product(passages: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``products`` of a table of ``terms, n, sizes``, summed by Spark."""
    pairwise = len(q) <= GRAM_TERMS

    def part(batches):
        import pyarrow as pa
        out = products(([b.column(c).flatten().to_numpy() for c in ("terms", "n", "sizes")] for b in batches if b.num_rows),
                       idf, q, pairwise)
        rows = np.nonzero(np.abs(out).sum(axis=1))[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(list(out[rows]), pa.list_(pa.float64()))], names=["term", "v"])

    sums = passages.mapInArrow(part, "term long, v array<double>").groupBy("term") \
        .agg(F.array(*[F.sum(F.col("v")[i]) for i in range(q.shape[1])]).alias("v")).collect()  # one row per term
    z = np.zeros_like(q)
    for r in sums:
        z[r["term"]] = r["v"]
    return z


def latent_basis(passages: DataFrame, n_passages: int, items: list[Item], vocab: dict[str, int], idf: np.ndarray,
                 rank: int = RANK, seed: int = 5) -> np.ndarray:
    """Term basis of the randomised SVD: a random range, one power step, Rayleigh-Ritz on the range.

    Fitted on all passages (the table of ``cut_passages``) and on the items; beyond ITEM_SHARE passages an item weighs
    more than one, so that the items' terms do not leave the basis as the corpus grows.
    """
    fitted = passages.where("terms is not null").select("terms", "n", "sizes")
    terms, n = zip(*[np.unique([vocab[w] for w in i.words], return_counts=True) for i in items])
    own = [(np.concatenate(terms), np.concatenate(n), np.array([len(t) for t in terms]))]
    weight = max(1.0, n_passages / ITEM_SHARE)

    def product(q: np.ndarray) -> np.ndarray:
        return gram_product(fitted, idf, q) + weight * products(own, idf, q, False)

    width = min(len(vocab), rank + EXTRA)
    q = np.random.default_rng(seed).standard_normal((len(vocab), width))
    q, _ = np.linalg.qr(product(q))
    z = product(q)
    values, vectors = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
    return q @ vectors[:, np.argsort(values)[::-1][:rank]]


def _blocks(benchmark: DataFrame, item_id: str, text: str):
    """The benchmark's rows in blocks of about BLOCK_ITEMS; null texts are left out."""
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("t is not null")
    n = -(-rows.count() // BLOCK_ITEMS)
    for k in range(n):
        yield [x for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).orderBy("i", "t").collect()
               if (x := read_item(r["i"], r["t"]))]


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, cosine, common, answer, first_word``: a row per document row and item it holds.

    Items under SHORT_ITEM words are found wherever they stand as they are, with cosine 1.
    ``common`` is the share of the item's words in the longest common subsequence with the best window.
    Items or texts that are null or without words match nothing; equal items give a row each, as do
    repeated documents; an empty table on either side gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    d = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__t"))
    kind = d.schema["__id"].dataType.simpleString()
    item_kind = benchmark.schema[item_id].dataType.simpleString()
    out, passages_path = None, f"{workspace(docs.sparkSession)}/{uuid.uuid4().hex}"
    for items in _blocks(benchmark, item_id, item_text):
        if not items:
            continue
        vocab = {w: i for i, w in enumerate(sorted({w for x in items for w in x.words}))}
        passages = cut_passages(d.select("__t"), vocab, passages_path)  # read only here: the next block writes over it
        n_docs, n_passages, df = document_frequencies(passages, vocab)
        idf = (np.log((1 + n_docs) / (1 + df)) + 0.1) ** 2  # squared: rare words tell the items apart
        search = Search(items, idf, vocab, latent_basis(passages, n_passages, items, vocab, idf))

        def find(batches, search=search):
            import pyarrow as pa
            for b in batches:
                found = search.matches(b.column("__t").to_pylist())
                col = lambda i, kind: pa.array([m[i] for m in found], kind)
                yield pa.RecordBatch.from_arrays(
                    [b.column("__id").take(col(0, pa.int64())), col(1, pa.int32()), col(2, pa.float64()),
                     col(3, pa.float64()), col(4, pa.float64()), col(5, pa.int64())],
                    names=["__id", "__k", "cosine", "common", "answer", "first_word"])

        hits = d.mapInArrow(find, f"__id {kind}, __k int, cosine double, common double, answer double, first_word long")
        names = d.sparkSession.createDataFrame([(k, i.item_id) for k, i in enumerate(items)], f"__k int, __item {item_kind}")
        hits = hits.join(F.broadcast(names), "__k").select(  # at most BLOCK_ITEMS rows, about
            F.col("__id").alias(doc_id), F.col("__item").alias(item_id), F.round("cosine", 4).alias("cosine"),
            F.round("common", 6).alias("common"), F.round("answer", 6).alias("answer"), "first_word")
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        out = docs.sparkSession.createDataFrame(
            [], f"{doc_id} {kind}, {item_id} {item_kind}, cosine double, common double, answer double, first_word long")
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that hold no benchmark item, with all their columns; null ids are judged by text."""
    keyed = docs.withColumn("__y", F.xxhash64(F.col(text)))
    hits = contaminated(keyed.select(F.struct(F.col(doc_id).alias("d"), F.col("__y").alias("y")).alias("__key"),
                                     F.col(text).alias("__text")), benchmark, "__key", "__text")
    bad = written(hits.select(F.col("__key.d").alias("__d"), F.col("__key.y").alias("__x")).distinct())
    return keyed.join(sized(bad), F.col(doc_id).eqNullSafe(F.col("__d")) & (F.col("__y") == F.col("__x")), "left_anti").drop("__y")
