"""Dictionary lookups on token arrays: inside the row, or explode -> hash join -> regroup.

A dictionary of at most ``INLINE_ENTRIES`` entries is looked up where the tokens are: it is one literal, an
array of small maps by the word's hash, so a token costs one hash and a scan of a few entries, and rows of
equal key meet as whole token lists.  No token becomes a row.  Larger dictionaries are joined:
Spark has no O(1) map lookup inside an expression (map access is a linear
scan), so a token dictionary of thousands of entries is applied the
relational way: ``posexplode_outer`` the array, equi-join the (size-checked,
broadcast) dictionary, and rebuild the array per row with an ordered
``collect_list``.  The regroup key is the row key (an utterance), so the
shuffle carries one partially aggregated row per input row and is not skewed
by any session or speaker; all other columns ride along through the
aggregation on the first element only (no per-token copies of wide columns).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_dictionary

POS = "_pos"
TOK = "_tok"
#: most entries of a dictionary that is looked up inside the row, and the maps they are dealt over
INLINE_ENTRIES, INLINE_BUCKETS = 4096, 1024


def inline_lookup(dictionary: DataFrame, on: str, field: str) -> Callable[[Column], Column] | None:
    """Expression ``word -> field`` (null without an entry) over a dictionary unique on ``on``; None if it is too large."""
    def bucket(word: Column) -> Column:
        return F.pmod(F.hash(word), F.lit(INLINE_BUCKETS))

    rows = dictionary.where(F.col(on).isNotNull() & F.col(field).isNotNull()).select(
        bucket(F.col(on)), on, field).limit(INLINE_ENTRIES + 1).collect()
    if len(rows) > INLINE_ENTRIES:
        return None
    maps: list[dict[str, str]] = [{} for _ in range(INLINE_BUCKETS)]
    for b, word, value in rows:
        maps[b][word] = value
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>")  # folded to one literal
    return lambda word: F.try_element_at(F.get(literal, bucket(word)), word)


#: joins the tokens of a list that is shuffled; lists with a token that holds it stay lists
SEPARATOR = "\x1f"


def packed(tokens: str) -> Column:
    """A token list as one string where that loses nothing: in a shuffle, a token of a list takes 24 bytes and more."""
    plain = (F.size(tokens) > 0) & ~F.exists(tokens, lambda x: x.isNull() | x.contains(SEPARATOR))
    return F.when(F.col(tokens).isNotNull(), F.struct(
        F.when(plain, F.array_join(tokens, SEPARATOR)).alias("s"), F.when(~plain, F.col(tokens)).alias("l")))


def unpacked(pack: Column | str) -> Column:
    """The token list of ``packed``."""
    pack = F.col(pack) if isinstance(pack, str) else pack
    return F.coalesce(pack["l"], F.split(pack["s"], SEPARATOR))


def lookup_regroup(df: DataFrame, keys: Sequence[str], tokens: str, lookup: Callable[[Column], Column],
                   field: str, out: str = "_arr") -> DataFrame:
    """``explode_lookup_regroup`` by an expression: ``df`` with ``tokens`` replaced by ``out``, sorted by position.

    Rows of equal ``keys`` become one, with the tokens of all; ``out`` is null where none has a token list.
    """
    keys = list(keys)
    carry = [c for c in df.columns if c not in keys and c != tokens]

    def found(words: Column) -> Column:
        return F.transform(words, lambda x, i: F.struct(i.alias(POS), x.alias(TOK), lookup(x).alias(field)))

    g = df.select(*keys, *carry, packed(tokens).alias("_pack")).groupBy(*keys).agg(
        F.collect_list("_pack").alias("_packs"), *[F.first(c, ignorenulls=True).alias(c) for c in carry])
    g = g.select(*keys, *carry, F.transform("_packs", unpacked).alias("_lists"))
    many = F.array_sort(F.flatten(F.transform("_lists", found)))
    arr = F.when(F.size("_lists") == 1, found(F.col("_lists")[0])).when(F.size("_lists") > 1, many)
    return g.select(*[c for c in df.columns if c != tokens], arr.alias(out))


def explode_lookup_regroup(df: DataFrame, keys: Sequence[str], tokens: Column,
                           dictionary: DataFrame | None, on: str,
                           fields: Sequence[str], out: str = "_arr") -> DataFrame:
    """Return ``df`` plus ``out``: array<struct<_pos,_tok,*fields>> sorted by position.

    ``dictionary`` must be unique on ``on``; tokens without an entry get nulls.
    """
    keys = list(keys)
    carry = [c for c in df.columns if c not in keys]
    e = df.select(*df.columns, F.posexplode_outer(tokens).alias(POS, TOK))
    first_row = F.col(POS).isNull() | (F.col(POS) == 0)
    # Project before the join: whether it shuffles or not, a token carries its key,
    # position and word; wide columns (raw text, the token list) ride on the first only.
    e = e.select(*keys, POS, TOK, *[F.when(first_row, F.col(c)).alias(c) for c in carry])
    if dictionary is not None:
        d = dictionary.select(F.col(on).alias("_dkey"), *fields)
        e = e.join(broadcast_dictionary(d), e[TOK] == d["_dkey"], "left")
        field_cols = [F.col(f) for f in fields]
    else:
        field_cols = [F.lit(None).alias(f) for f in fields]
    elem = F.when(F.col(POS).isNotNull(), F.struct(F.col(POS), F.col(TOK), *field_cols))
    p = e.select(*keys, elem.alias("_elem"), *carry)
    aggs = [F.array_sort(F.collect_list("_elem")).alias(out)]
    aggs += [F.first(c, ignorenulls=True).alias(c) for c in carry]
    g = p.groupBy(*keys).agg(*aggs)
    return g.select(*df.columns, out)
