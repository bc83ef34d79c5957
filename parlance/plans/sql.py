"""DuckDB SQL twins of the column functions, used to write the oracle queries."""

from __future__ import annotations

from ..functions.text import CONTRACTIONS, QUOTE_CHARS
from . import fixtures as fx


def clean(x: str) -> str:
    """P1-P5 in DuckDB (RE2: [[:punct:]] is the same 32 ASCII characters)."""
    s = f"lower({x})"
    s = rf"regexp_replace({s}, '(http|www)\S+', '', 'g')"
    s = f"regexp_replace({s}, '[[:punct:]]', ' ', 'g')"
    s = rf"regexp_replace({s}, '\d+', '', 'g')"
    s = rf"regexp_replace({s}, '\s+', ' ', 'g')"
    return f"trim({s})"


def word_tokens(x: str) -> str:
    s = f"regexp_replace({x}, '([{QUOTE_CHARS}])', ' \\1 ', 'g')"
    for a, b in CONTRACTIONS:
        s = rf"regexp_replace({s}, '\b({a})({b})\b', '\1 \2', 'g')"
    return f"list_filter(string_split({s}, ' '), lambda w: w <> '')"


def str_list(words) -> str:
    return "[" + ", ".join(fx._sql_str(w) for w in sorted(set(words))) + "]"


def filter_tokens(x: str, stop, min_len: int) -> str:
    return (f"list_filter({x}, lambda w: NOT list_contains({str_list(stop)}, w) "
            f"AND length(w) >= {min_len})")


def word_count(x: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> ''))"


def polarity(x: str, pos: float = 0.05, neg: float = -0.05) -> str:
    return f"CASE WHEN {x} >= {pos} THEN 'positive' WHEN {x} <= {neg} THEN 'negative' ELSE 'neutral' END"


def trend(x: str) -> str:
    return f"CASE WHEN {x} > 0.1 THEN 'improving' WHEN {x} < -0.1 THEN 'deteriorating' ELSE 'stable' END"


def tone(x: str) -> str:
    return (f"CASE WHEN {x} > 0.5 THEN 'very positive' WHEN {x} > 0.05 THEN 'positive' "
            f"WHEN {x} > 0 THEN 'slightly positive' WHEN {x} = 0 THEN 'neutral' "
            f"WHEN {x} > -0.05 THEN 'slightly negative' WHEN {x} > -0.5 THEN 'negative' "
            f"ELSE 'very negative' END")


def term_dict() -> str:
    lex = fx.values_sql(fx.LEXICON, ["term", "valence"])
    bst = fx.values_sql([b for b in fx.BOOSTERS if " " not in b[0]], ["term", "scalar"])
    neg = fx.values_sql([(n,) for n in fx.NEGATORS], ["term"])
    return (f"SELECT term, max(v) AS v, max(b) AS b, bool_or(n) AS n FROM ("
            f"SELECT term, valence AS v, NULL::DOUBLE AS b, false AS n FROM {lex} UNION ALL "
            f"SELECT term, NULL::DOUBLE, scalar, false FROM {bst} UNION ALL "
            f"SELECT term, NULL::DOUBLE, NULL::DOUBLE, true FROM {neg}) GROUP BY term")


def scored_utterances_cte(source: str = fx.SQL_UTTERANCES, idioms=()) -> str:
    """CTEs ending in ``scored``: the lexicon scorer written with window lags; ``idioms`` are (phrase, valence) pairs."""
    table = "MAP {" + ", ".join(f"{fx._sql_str(k)}: {float(v)!r}" for k, v in idioms) + "}"
    looked = [f"{table}[{' || chr(32) || '.join(x)}]" for x in (
        ("tok", "tn", "tn2"), ("tok", "tn"), ("t1", "tok"), ("t2", "t1", "tok"), ("t2", "t1"), ("t3", "t2", "t1"), ("t3", "t2"))]
    idiom = (", ".join(looked) + ", ") if idioms else ""
    bigrams = str_list([b[0] for b in fx.BOOSTERS if " " in b[0]] or ["\x00"])
    return f"""
u AS ({source}),
su AS (SELECT *, {clean('text')} AS p FROM u WHERE text IS NOT NULL AND length(text) > 0),
arr AS (SELECT session_key, dialogue_idx, list_filter(string_split(p, ' '), lambda w: length(w) > 1) AS a FROM su),
toks AS (SELECT session_key, dialogue_idx, unnest(a) AS tok, generate_subscripts(a, 1) - 1 AS pos FROM arr),
d AS ({term_dict()}),
j AS (SELECT t.session_key, t.dialogue_idx, t.tok, t.pos, d.v, d.b, coalesce(d.n, false) AS n
      FROM toks t LEFT JOIN d ON t.tok = d.term),
w AS (SELECT *,
        lag(tok, 1) OVER x AS t1, lag(tok, 2) OVER x AS t2, lag(tok, 3) OVER x AS t3, lead(tok, 1) OVER x AS tn, lead(tok, 2) OVER x AS tn2,
        lag(v, 1) OVER x AS v1, lag(v, 2) OVER x AS v2, lag(v, 3) OVER x AS v3,
        coalesce(lag(b, 1) OVER x, 0) AS b1, coalesce(lag(b, 2) OVER x, 0) AS b2, coalesce(lag(b, 3) OVER x, 0) AS b3,
        coalesce(lag(n, 1) OVER x, false) AS n1, coalesce(lag(n, 2) OVER x, false) AS n2,
        coalesce(lag(n, 3) OVER x, false) AS n3,
        min(CASE WHEN tok = 'but' THEN pos END) OVER (PARTITION BY session_key, dialogue_idx) AS bi
      FROM j WINDOW x AS (PARTITION BY session_key, dialogue_idx ORDER BY pos)),
s1 AS (SELECT *, CASE WHEN pos > 0 AND v1 IS NULL THEN
          (v + CASE WHEN v < 0 THEN -b1 ELSE b1 END) * CASE WHEN n1 THEN -0.74 ELSE 1 END
        ELSE v END AS x1 FROM w),
s2 AS (SELECT *, CASE WHEN pos > 1 AND v2 IS NULL THEN
          (x1 + CASE WHEN x1 < 0 THEN -b2 ELSE b2 END * 0.95)
          * CASE WHEN t2 = 'never' AND t1 IN ('so', 'this') THEN 1.5 WHEN n2 THEN -0.74 ELSE 1 END
        ELSE x1 END AS x2 FROM s1),
s3 AS (SELECT *, CASE WHEN pos > 2 AND v3 IS NULL THEN
          coalesce({idiom}(x2 + CASE WHEN x2 < 0 THEN -b3 ELSE b3 END * 0.9)
          * CASE WHEN t3 = 'never' AND (t2 IN ('so', 'this') OR t1 IN ('so', 'this')) THEN 1.25
                 WHEN n3 THEN -0.74 ELSE 1 END)
          + CASE WHEN list_contains({bigrams}, t3 || ' ' || t2) OR list_contains({bigrams}, t2 || ' ' || t1)
                 THEN -0.293 ELSE 0 END
        ELSE x2 END AS x3 FROM s2),
s4 AS (SELECT *, CASE WHEN pos > 0 AND v1 IS NULL AND t1 = 'least' THEN
          CASE WHEN pos > 1 THEN CASE WHEN t2 NOT IN ('at', 'very') THEN x3 * -0.74 ELSE x3 END
               ELSE x3 * -0.74 END
        ELSE x3 END AS x4 FROM s3),
s5 AS (SELECT session_key, dialogue_idx, pos,
        CASE WHEN b IS NOT NULL OR v IS NULL OR (tok = 'kind' AND tn = 'of') THEN 0.0 ELSE x4 END
        * CASE WHEN bi IS NULL THEN 1 WHEN pos < bi THEN 0.5 WHEN pos > bi THEN 1.5 ELSE 1 END AS val
      FROM s4),
agg AS (SELECT session_key, dialogue_idx, sum(val) AS s,
          sum(CASE WHEN val > 0 THEN val + 1 ELSE 0 END) AS ps,
          sum(CASE WHEN val < 0 THEN val - 1 ELSE 0 END) AS ns,
          sum(CASE WHEN val = 0 THEN 1 ELSE 0 END) AS nc
        FROM s5 GROUP BY session_key, dialogue_idx),
scored AS (SELECT su.session_key, su.dialogue_idx, su.speaker, su.patient_id,
          coalesce(round_even(abs(ps / (ps + abs(ns) + nc)), 3), 0.0) AS pos_score,
          coalesce(round_even(abs(ns / (ps + abs(ns) + nc)), 3), 0.0) AS neg_score,
          coalesce(round_even(abs(nc / (ps + abs(ns) + nc)), 3), 0.0) AS neu_score,
          CASE WHEN s IS NULL THEN 0.0
               ELSE round_even(greatest(-1.0, least(1.0, s / sqrt(s * s + 15))), 4) END AS compound_score
        FROM su LEFT JOIN agg USING (session_key, dialogue_idx))"""
