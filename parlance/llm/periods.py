"""Runs (maximal repetitions) of the words of every text, found with a dictionary of basic factors.

Documents are spread over tasks by Spark; inside a task the texts of a batch are worked on together as
integer arrays.  Nothing is shuffled and no text is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import barrier, small_batches, word_array

#: shortest run that is reported, in words
MIN_RUN = 12
#: texts are handled together until they hold this many words; a longer text is handled alone, whole
CHUNK_WORDS = 1 << 18
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def basic_factors(words: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    """Dictionary of basic factors: ``names[k][i]`` is equal for equal factors of 2^k words of one text.

    Factors that occur once in their text, and those that would cross its end, are named -1: longer factors
    that start with one occur once as well.  The last level has no name left.
    """
    names, n = [], len(words)
    where = np.arange(n)
    first, second = words.astype(np.int64), np.zeros(n, np.int64)
    length = 1
    while len(where):
        key = np.lexsort((second, first, text[where]))
        a, b, t, at = first[key], second[key], text[where][key], where[key]
        new = np.ones(len(at), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (t[1:] != t[:-1])
        number = np.cumsum(new) - 1
        twice = np.bincount(number)[number] > 1
        level = np.full(n, -1, np.int64)
        level[at[twice]] = number[twice]
        names.append(level)
        # twice as long: two neighbouring factors of this length, both named
        where = np.sort(at[twice])
        where = where[where + length < n]
        where = where[(level[where + length] >= 0) & (text[where + length] == text[where])]
        first, second = level[where], level[where + length]
        length *= 2
    return names


def proposed_periods(level: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``i`` and periods ``p`` with ``length <= p < 2 * length`` and equal factors at i and i + p.

    Successor occurrences of a factor at most half its length apart are equally far apart: they form an
    arithmetic progression.  Progressions of the same factor lie further apart, so each has only a few others
    within twice the length; the periods that lead from one into another are an arithmetic progression again,
    and each is proposed once.
    """
    at = np.flatnonzero(level >= 0)
    if not len(at):
        return at, at
    at = at[np.argsort(level[at], kind="stable")]
    name = level[at]
    gap = np.diff(at)
    same = name[1:] == name[:-1]
    linked = same & (2 * gap <= length)
    head = np.r_[True, ~linked]
    begin = np.flatnonzero(head)
    count = np.diff(np.r_[begin, len(at)])
    first, last, named = at[begin], at[begin + count - 1], name[begin]
    step = np.where(count > 1, (last - first) // np.maximum(count - 1, 1), 1)
    out_i, out_p = [], []
    ahead = 1
    while ahead < len(first):
        x = np.flatnonzero((named[ahead:] == named[:-ahead]) & (first[ahead:] - last[:-ahead] < 2 * length))
        if not len(x):
            break
        y = x + ahead
        d = np.where(count[x] > 1, step[x], step[y])
        shortest = first[y] - last[x]
        low = np.maximum(0, -((shortest - length) // d))  # smallest t with shortest + t * d >= length
        high = np.minimum(count[x] + count[y] - 2, (2 * length - 1 - shortest) // d)
        many = np.maximum(high - low + 1, 0)
        pair = np.repeat(np.arange(len(x)), many)
        t = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + low[pair]
        back = np.minimum(t, count[x][pair] - 1)
        out_i.append(last[x][pair] - back * d[pair])
        out_p.append(shortest[pair] + t * d[pair])
        ahead += 1
    if not out_i:
        return at[:0], at[:0]
    return np.concatenate(out_i), np.concatenate(out_p)


def extend(names: list[np.ndarray], i: np.ndarray, p: np.ndarray, starts: np.ndarray):
    """First and one-past-last word of the longest stretch around ``i`` whose words p apart are equal."""
    right, left = i.copy(), i.copy()
    for k in range(len(names) - 1, -1, -1):
        size, level = 1 << k, names[k]
        # a level fits once at most: two fits in a row would be one of the next level
        ok = np.flatnonzero(right + p + size <= len(level))
        ok = ok[(level[right[ok]] >= 0) & (level[right[ok]] == level[right[ok] + p[ok]])]
        right[ok] += size
        ok = np.flatnonzero(left - size >= starts)
        ok = ok[(level[left[ok] - size] >= 0) & (level[left[ok] - size] == level[left[ok] - size + p[ok]])]
        left[ok] -= size
    return left, right + p


def find_runs(words: np.ndarray, text: np.ndarray, min_run: int = MIN_RUN) -> np.ndarray:
    """Rows ``text, start, length, period`` of all runs, by text, start and period.

    ``words`` are numbers of words, ``text`` the number of each word's text (ascending).  ``start`` counts from
    the text's first word.  A run is a longest stretch with smallest period q of at least ``min_run`` and 2q words.
    """
    n = len(words)
    if not n:
        return np.empty((0, 4), np.int64)
    names = basic_factors(words, text)
    begins = np.r_[0, np.flatnonzero(np.diff(text)) + 1]
    begin_of = np.repeat(begins, np.diff(np.r_[begins, n]))
    found = []
    for k, level in enumerate(names):
        i, p = proposed_periods(level, 1 << k)
        if not len(i):
            continue
        left, right = extend(names, i, p, begin_of[i])
        size = right - left
        ok = (size >= 2 * p) & (size >= min_run)
        found.append(np.unique(np.stack([left[ok], right[ok], p[ok]], axis=1), axis=0))
    if not found:
        return np.empty((0, 4), np.int64)
    runs = np.concatenate(found)
    # multiples of a run's smallest period span the same words: the smallest stays
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    out = np.stack([text[runs[:, 0]], runs[:, 0] - begin_of[runs[:, 0]], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _texts(column: pa.Array, min_run: int) -> tuple[list[list[dict]], list[str]]:
    """Runs and collapsed text of each text of a batch."""
    split = pc.split_pattern_regex(pc.fill_null(column, ""), r"[\x20\x09-\x0D]+")
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = split.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(counts)), counts)[real]
    flat = flat.filter(pa.array(real))
    numbers = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    sizes = np.bincount(owner, minlength=len(counts))
    ends = np.cumsum(sizes)
    runs: list[list[dict]] = [[] for _ in sizes]
    keep = np.ones(len(owner), bool)
    lo = 0
    while lo < len(sizes):
        hi = lo + 1
        base = ends[lo] - sizes[lo]
        while hi < len(sizes) and ends[hi] - base <= CHUNK_WORDS:
            hi += 1
        part = slice(base, ends[hi - 1])
        hit = find_runs(numbers[part], owner[part], min_run)
        if len(hit):
            for t, start, length, period in hit.tolist():
                runs[t].append({"start": start, "length": length, "period": period})
            edge = np.zeros(ends[hi - 1] - base + 1, np.int64)
            at = ends[hit[:, 0]] - sizes[hit[:, 0]] - base + hit[:, 1]
            np.add.at(edge, at + hit[:, 3], 1)
            np.add.at(edge, at + hit[:, 2], -1)
            keep[part] = np.cumsum(edge)[:-1] == 0
        lo = hi
    kept = flat.filter(pa.array(keep))
    offsets = np.r_[0, np.cumsum(np.bincount(owner[keep], minlength=len(counts)))]
    return runs, pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), kept), " ")


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, collapsed``.

    ``runs`` is an array of ``start, length, period`` by start, then period; ``collapsed`` joins by one space the
    words that no run holds after its first period.  Null and wordless texts have no run and an empty text;
    null ids stay and repeated rows are rows of their own; other columns are not read, whatever their names; an empty
    table gives no rows; a long text is one array of its words (about 8 bytes a word and level of its longest
    repeated passage), whole.
    """
    small_batches(docs.sparkSession, 512)
    narrow = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, collapsed = _texts(batch.column(1), min_run)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(runs, RUN_TYPE), collapsed.cast(pa.string())], ["id", "runs", "collapsed"])

    kind = narrow.schema["__id"].dataType.simpleString()
    out = narrow.mapInArrow(run, f"id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.select(F.col("id").alias(doc_id), "runs", "collapsed")


def with_periodic_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text``: where crc32 of the decimal id is divisible by 10, the words from some word on repeat with
    a period drawn from the id; such a text is its words joined by one space.  Null ids keep their text."""
    h = F.crc32(F.col(doc_id).cast("string"))
    narrow = docs.select(F.col(doc_id), F.col(text).alias("__t"), F.floor(h / 10).cast("long").alias("__g"),
                         F.coalesce(h % 10 == 0, F.lit(False)).alias("__on"))
    d = barrier(narrow, __w=F.when(F.col("__on"), word_array(F.col("__t"))).otherwise(F.array().cast("array<string>")))
    n = F.size("__w")
    a = F.when(n > 0, F.col("__g") % F.nullif(n, F.lit(0)))
    d = barrier(d, __a=a.cast("int"), __p=F.floor(1 + (n - a) / (3 + F.col("__g") % 8)).cast("int"))
    repeated = F.transform("__w", lambda w, i: F.when(
        i < F.col("__a"), w).otherwise(F.get("__w", F.col("__a") + (i - F.col("__a")) % F.col("__p"))))
    return d.select(doc_id, F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("__t")).alias(text))
