"""SimHash near-duplicate documents by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits.  The perfect binary Golay code
(23, 12) decodes any 23-bit word to the one codeword within three bits.  A word whose codeword is
three bits away also gets the five codewords four bits away, so it has one or six codeword
indices; two words that differ in at most one bit then always share an index.  If two
fingerprints differ in at most two bits, one segment is equal and another differs in at most one
bit.  The keys are therefore (equal segment, codeword index of another segment) for the six
ordered pairs of segments: every pair within two bits meets in a bucket, and the buckets' members
are verified by their exact distance.
"""

from __future__ import annotations

import sys
from itertools import combinations

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sized, small_batches, written
from .components import linked_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no import path

#: generator polynomial of the binary Golay code: x^11+x^10+x^6+x^5+x^4+x^2+1
POLY = 0b110001110101
#: (lowest bit, bits) of the segments
SEGMENTS = ((0, 23), (23, 23), (46, 18))
SHINGLE = 3
MAX_BITS = 2
SEED = 42


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial (11 bits)."""
    r = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        r ^= np.where((r >> bit) & 1, POLY << (bit - 11), 0)
    return r


def decoding_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome: the nearest error pattern, and up to five patterns of four bits (-1: none)."""
    near = np.zeros(2048, dtype=np.int64)
    far = np.full((2048, 5), -1, dtype=np.int64)
    for weight in (1, 2, 3):
        pats = np.array([sum(1 << b for b in c) for c in combinations(range(23), weight)], dtype=np.int64)
        s = syndromes(pats)
        near[s] = pats
        if weight == 3:
            edge = set(s.tolist())
    pats = np.array([sum(1 << b for b in c) for c in combinations(range(23), 4)], dtype=np.int64)
    count = np.zeros(2048, dtype=np.int64)
    for p, s in zip(pats.tolist(), syndromes(pats).tolist()):
        if s in edge:
            far[s, count[s]] = p
            count[s] += 1
    return near, far


NEAR, FAR = decoding_tables()


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """Six columns of 12-bit codeword indices of 23-bit words; -1 where a word has only one."""
    s = syndromes(words)
    out = np.empty((len(words), 6), dtype=np.int64)
    out[:, 0] = (words ^ NEAR[s]) >> 11
    far = FAR[s]
    out[:, 1:] = np.where(far >= 0, (words[:, None] ^ far) >> 11, -1)
    return out


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for every bucket of every fingerprint (int64 array)."""
    u = fps.view(np.uint64)
    seg = [((u >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64) for lo, n in SEGMENTS]
    index = [codeword_indices(x) for x in seg]
    rows, keys = [], []
    pair = 0
    for i in range(3):
        for j in range(3):
            if i == j:
                continue
            r, c = np.nonzero(index[j] >= 0)
            rows.append(r)
            keys.append((pair << 35) | (seg[i][r] << 12) | index[j][r, c])
            pair += 1
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str | None, n: int = SHINGLE, block: int = 65536) -> int:
    """64-bit SimHash of n-word shingles (a signed integer).

    A-Z are lower-cased, words are runs of other than ASCII white space, repeated shingles count
    each time, fewer than n words make one shingle, no words give zero.  A bit is set if it is set
    in more than half of the shingles' XXH64 hashes.  The counts are added block by block, so
    memory does not grow with the shingles of a text.
    """
    import xxhash
    digest = xxhash.xxh64_intdigest
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    total = max(1, len(w) - n + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, total, block):
        part = w[at:at + block + n - 1] if len(w) >= n else w
        grams = zip(*[part[k:] for k in range(n)]) if len(part) >= n else [part]
        h = np.fromiter((digest(b" ".join(g), SEED) for g in grams), dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(batches):
    import pyarrow as pa
    for b in batches:
        fps = pa.array([fingerprint(t) for t in b.column("__text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__h"), fps], names=["__id", "__h", "__fp"])


def _keys(batches):
    import pyarrow as pa
    for b in batches:
        fps = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        rows, keys = bucket_keys(fps)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows]), pa.array(fps[rows])],
                                         names=["key", "id", "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``__id, __h, __fp``: one row per input row with the hash of its text, kept on the shared folder (no texts)."""
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("__id"), F.xxhash64(text).alias("__h"), F.col(text).alias("__text"))
    kind = narrow.schema["__id"].dataType.simpleString()
    return written(narrow.mapInArrow(_fingerprints, f"__id {kind}, __h long, __fp long"))


def rooted_fingerprints(rows: DataFrame) -> DataFrame:
    """``__fp, least, root``: every distinct fingerprint of ``rows`` with the root of its component.

    ``least`` is the first of the fingerprint's rows: the smallest id, null ids last, then the smallest text hash.
    """
    first = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__h").alias("h"))
    kinds = written(rows.groupBy("__fp").agg(F.min(first).alias("least")))
    members = kinds.select(F.col("__fp").alias("fp")).mapInArrow(_keys, "key long, id long, fp long")
    comp = linked_components(members, MAX_BITS)
    return kinds.join(sized(comp), kinds["__fp"] == comp["id"], "left") \
        .select("__fp", "least", F.coalesce("root", "__fp").alias("root"))


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every input row.

    Rows whose fingerprints differ in at most two bits are linked; ``component_id`` is the smallest
    ``doc_id`` reachable over links.  Null and blank texts have fingerprint zero and are linked
    like any other; null ids are never the smallest (a component of null ids only has a null
    component); repeated rows come out as often as they come in; an empty table gives no rows;
    other input columns are not read.  Only distinct fingerprints enter the link search.
    """
    rows = fingerprints(docs, doc_id, text)
    rooted = rooted_fingerprints(rows)
    linked = rooted.groupBy("root").agg(F.min("least")["id"].alias("component_id"))
    ids = written(rooted.join(linked, "root").select("__fp", "component_id"))
    return rows.join(sized(ids), "__fp").select(
        F.col("__id").alias(doc_id), F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Keep one row of each component; all columns stay as they are.

    It is the row of the smallest id (of several texts under that id, the one of the smallest hash).  A row
    with a null id stays only if its component has no other id, then once per component.  An id
    whose texts are in different components is judged in each of them.
    """
    rooted = rooted_fingerprints(fingerprints(docs, doc_id, text))
    firsts = rooted.groupBy("root").agg(F.min("least").alias("least"))
    keep = written(firsts.select(F.col("least.id").alias("__k"), F.col("least.h").alias("__kh")))
    rows = docs.withColumn("__h", F.xxhash64(text))
    out = rows.join(sized(keep), F.col(doc_id).eqNullSafe(F.col("__k")) & (F.col("__h") == F.col("__kh")), "left_semi")
    return out.dropDuplicates([doc_id, "__h"]).drop("__h")
