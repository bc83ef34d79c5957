"""The corpus operators against brute force, exact round trips and odd input."""

import hashlib
import json
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.llm import chat, components, decontam, golay, langid, lines, mixing, quality, toxicity, urls, warc

DOCS = "doc_id long, text string, source string, Size string, key long, id string"
ODD = [(1, None, None, "x", 1, "a"), (None, "one two three", "a", "x", 1, "a"), (None, None, "a", None, None, None),
       (2, "", "a", "x", 1, "a"), (3, "same text here\nsame text here", "a", "x", 1, "a"),
       (3, "same text here\nsame text here", "a", "x", 1, "a"), (4, "w " * 30_000, "b", "x", 1, "a"),
       (5, "  \t\n ", None, "x", 1, "a")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def near_texts(seed=3, n=40):
    """Random texts, some of them with one or two words changed."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    out = []
    for _ in range(n):
        w = [word() for _ in range(rng.randint(1, 120))]
        out.append(" ".join(w))
        for _ in range(rng.randint(0, 3)):
            v = list(w)
            v[rng.randrange(len(v))] = word()
            out.append(" ".join(v))
    return out


def roots(n, links):
    at = list(range(n))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        at[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7)]
    got = {r["id"]: r["root"] for r in components.connected_components(
        spark.createDataFrame(links + [(None, 3)], "a long, b long")).collect()}
    want = roots(140, [(a, b) for a, b in links if a != b])
    ends = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in ends}


def test_linked_components_equal_all_pairs(spark):
    rng = random.Random(2)
    centres = [rng.getrandbits(63) for _ in range(5)]
    fps = sorted({c ^ sum(1 << rng.randrange(63) for _ in range(rng.randint(0, 3))) for c in centres for _ in range(40)})
    members = spark.createDataFrame([(i % 3, i, f) for i, f in enumerate(fps)] + [(3, i, f) for i, f in enumerate(fps)],
                                    "key long, id long, fp long")
    ok = lambda i, j: (i + j) % 7 != 0  # noqa: E731  a check that fails for some pairs
    got = {r["id"]: r["root"] for r in components.linked_components(
        members, 3, lambda p: p.where((F.col("a") + F.col("b")) % 7 != 0)).collect()}
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3 and ok(i, j)]
    want = roots(len(fps), links)
    assert all(got.get(i, i) == want[i] for i in range(len(fps)))


def test_linked_components_check_a_pair_once(spark):
    """Buckets of one to six members: all links of all pairs, and no pair is checked a second time."""
    rng = random.Random(3)
    rows = [(k, 100 * k + i, rng.randrange(8), rng.randint(10, 14)) for k in range(60) for i in range(1 + k % 6)]
    rows += [(60 + k % 20, i, f, n) for k, i, f, n in rows]  # each in a second bucket, with members of others
    members = spark.createDataFrame(rows, "key long, id long, fp long, len long")
    asked = []

    def ok(a, b):
        return (a * 7 + b * 3) % 5 != 0

    def verify(pairs):
        asked.extend((r["a"], r["b"]) for r in pairs.collect())
        return pairs.where((F.col("a") * 7 + F.col("b") * 3) % 5 != 0)

    for near in (None, lambda x, y: F.abs(x - y) <= 2):
        asked.clear()
        cols = ["key", "id", "fp", "len"] if near else ["key", "id", "fp"]
        got = {r["id"]: r["root"] for r in components.linked_components(members.select(cols), 2, verify, near).collect()}
        links = {(min(i, j), max(i, j)) for k, i, f, n in rows for q, j, g, m in rows
                 if k == q and i != j and (f ^ g).bit_count() <= 2 and (near is None or abs(n - m) <= 2)}
        assert len(asked) == len(set(asked)) and set(asked) <= links
        want = roots(6000, [x for x in links if ok(*x)])
        assert all(got.get(i, i) == want[i] for _, i, _, _ in rows)


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(4)
    a = rng.integers(-2 ** 63, 2 ** 63 - 1, 3000, dtype=np.int64)
    flip = np.array([0 if k == 0 else sum({1 << int(b) for b in rng.integers(0, 64, k)}) for k in rng.integers(0, 3, 3000)],
                    dtype=np.uint64).view(np.int64)
    keys = [defaultdict(set), defaultdict(set)]
    for side, fps in zip(keys, (a, a ^ flip)):
        for r, k in zip(*(x.tolist() for x in golay.bucket_keys(fps))):
            side[r].add(k)
    assert all(keys[0][i] & keys[1][i] for i in range(3000))


def test_simhash_components_equal_brute_force(spark):
    import xxhash
    texts = near_texts() + ["", " ", "A b", "a B"]

    def brute(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        grams = [w[i:i + 3] for i in range(len(w) - 2)] or ([w] if w else [])
        h = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [brute(t) for t in texts]
    want = roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    got = golay.simhash_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == \
        {i: (f"{fps[i]:016x}", want[i]) for i in range(len(fps))}


def test_simhash_odd(odd, none):
    got = golay.simhash_components(odd).collect()
    assert len(got) == len(ODD) and golay.simhash_components(none).count() == 0
    zero = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in zero} == {1}
    kept = golay.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 3, 4]


def test_simhash_keeps_one_row_of_each_component(spark):
    rng = random.Random(21)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40)) for _ in range(9)]
    rows = [(None, t) for t in texts[:5]] + [(None, texts[0])] * 2  # five documents without an id, one of them three times
    rows += [(7, texts[5]), (7, texts[6]), (7, texts[6])]  # one id on two texts
    rows += [(1, texts[7]), (2, texts[7]), (2, texts[8]), (None, texts[8])]  # id 2: a copy of 1 and a text of its own
    got = golay.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, t) for t in texts[:5]] + [(7, texts[5]), (7, texts[6]), (1, texts[7]), (2, texts[8])]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_equal_brute_force(spark):
    texts = near_texts(seed=5, n=25)
    docs = spark.createDataFrame([(i, t + "\n" + texts[0].upper() + "!") for i, t in enumerate(texts)], "doc_id long, text string")
    occ = lines.line_groups(docs)[0].select("__id", "__pos", "__fp").collect()
    fp = {(r["__id"], r["__pos"]): r["__fp"] for r in occ}
    norm = {(i, 0): t for i, t in enumerate(texts)} | {(i, 1): texts[0] for i in range(len(texts))}
    at = sorted(norm)
    similar = lambda a, b: levenshtein(a, b) <= int(max(len(a), len(b)) * 0.1 + 1e-9)
    links = [(i, j) for i in range(len(at)) for j in range(i) if norm[at[i]] == norm[at[j]] or (
        (fp[at[i]] ^ fp[at[j]]).bit_count() <= 3 and similar(norm[at[i]], norm[at[j]]))]
    want = Counter(at[i][0] for i, r in enumerate(roots(len(at), links)) if r != i)
    got = lines.dedup_lines(docs).collect()
    assert {r["doc_id"]: r["n_dropped"] for r in got} == {i: want[i] for i in range(len(texts))}
    assert all(r["text"].count("\n") == 1 - r["n_dropped"] or r["n_dropped"] == 2 for r in got)


def test_lines_count_short_words(spark):
    import xxhash
    rng = random.Random(22)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))

    def brute(words):
        h = [xxhash.xxh64_intdigest(w, 42) for w in words]
        return sum(1 << b for b in range(60) if 2 * sum(x >> b & 1 for x in h) > len(h))

    pairs = []
    while len(pairs) < 8:  # one of four long words changed, among 60 short ones
        a = [word(3) for _ in range(60)] + [word(6) for _ in range(4)]
        b = a[:-1] + [word(6)]
        if (brute(a) ^ brute(b)).bit_count() <= 3:
            pairs.append((" ".join(a), " ".join(b)))
    docs = spark.createDataFrame([(2 * i + k, p[k]) for i, p in enumerate(pairs) for k in (0, 1)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(docs).collect()}
    assert got == {i: i % 2 for i in range(16)}


def test_line_simhash_equals_brute_force(spark):
    import xxhash
    rng = random.Random(13)
    cases = [[str(rng.randrange(10 ** 6)) for _ in range(n)] for n in (1, 2, 3, 31, 32, 2047, 2048, 4094, 9000)]
    cases += [["same"] * n for n in (1, 2047, 2048, 5000)]
    rows = [(i, w) for i, w in enumerate(cases)] + [(6, cases[6])] * 3 + [(4, cases[4])] * 70 + [(None, cases[0])]
    got = lines.simhashes(spark.createDataFrame(rows, "id long, w array<string>"), "w").collect()

    def brute(words):
        h = [xxhash.xxh64_intdigest(w, 42) for w in words]
        return sum(1 << b for b in range(60) if 2 * sum(x >> b & 1 for x in h) > len(h))

    want = {i: brute(w) for i, w in rows}
    assert sorted(str(r["id"]) for r in got) == sorted(str(i) for i, _ in rows)
    assert all(r["__fp"] == want[r["id"]] for r in got)


def test_line_similarity_equals_brute_force(spark):
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("abß") for _ in range(rng.randint(1, 4)))
    rows = [("x y", "x z y"), ("x", "x"), ("x x", "x x x"), ("x x x", "x x"), ("a", "b"), ("é", "é é")]
    for _ in range(300):
        a = [word() for _ in range(rng.randint(1, 25))]
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randint(0, 1)] = [word()] if rng.random() < 0.7 or len(b) < 2 else []
        rows.append((" ".join(a), " ".join(b or a)))
    got = lines.with_similar(spark.createDataFrame(rows, "l string, r string"), "l", "r", 0.8, "ok").collect()
    near = lambda a, b: levenshtein(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)
    assert sorted((r["l"], r["r"], r["ok"]) for r in got) == sorted((a, b, near(a, b)) for a, b in rows)
    assert 50 < sum(r["ok"] for r in got) < len(rows)


def test_long_line_similarity_is_decided_early(spark):
    """Equal to brute force on long lines; long lines with changed words cost far less than their distance."""
    import time
    rng = random.Random(32)
    word = lambda n: "".join(rng.choice("abß") for _ in range(rng.randint(1, n)))

    def variant(a, n, shift):
        b = list(a)
        for _ in range(n):
            at = rng.randrange(len(b))
            b[at:at + rng.randint(1 - shift, 1)] = [word(6)] * (1 + rng.randint(0, shift))
        return b

    rows = []
    for k in range(60):
        a = [word(6) for _ in range(rng.randint(30, 90))]
        b = variant(a, rng.randint(0, 40), k % 2) if k % 3 else [word(6) for _ in a]
        rows.append((" ".join(a), " ".join(b)))
    got = lines.with_similar(spark.createDataFrame(rows, "l string, r string"), "l", "r", 0.85, "ok").collect()
    near = lambda a, b: levenshtein(a, b) <= int(max(len(a), len(b)) * 0.15 + 1e-9)
    assert sorted((r["l"], r["r"], r["ok"]) for r in got) == sorted((a, b, near(a, b)) for a, b in rows)
    assert 8 < sum(r["ok"] for r in got) < 52
    a = [word(6) for _ in range(1000)]
    pairs = spark.createDataFrame([(" ".join(a), " ".join(variant(a, 20, 0))) for _ in range(60)], "l string, r string")
    pairs = pairs.repartition(1).cache()
    assert pairs.count() == 60

    def seconds(df):
        begin = time.time()
        df.write.format("noop").mode("overwrite").save()
        return time.time() - begin

    checked = lines.with_similar(pairs, "l", "r", 0.9, "ok")
    assert checked.where("ok").count() == 60
    assert seconds(checked) < seconds(pairs.select(F.levenshtein("l", "r", 450))) / 2
    pairs.unpersist()


def test_lines_odd(odd, none):
    got = lines.dedup_lines(odd)
    assert lines.dedup_lines(none).count() == 0 and set(odd.columns) <= set(got.columns)
    rows = {(r["doc_id"], r["text"], r["n_dropped"]) for r in got.collect()}
    assert (1, None, 0) in rows and (2, "", 0) in rows and (3, "same text here", 1) in rows and got.count() == len(ODD)


def test_mixing_targets_and_bounds(spark, odd, none):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["a", "b", "c", "d", None, "e"] + ["hot"] * 6)) for i in range(4000)]
    rows += [(9000, "w " * 5000, "lonely")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sizes(docs).collect()
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += t.count("w")
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, target, capped = sum(size.values()), {}, set()
    while True:  # share the rest by weight until no source is above three times its size
        level = (total - sum(3 * size[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and weight[s] * level > 3 * size[s]}
        if not over:
            break
        capped |= over
    target = {s: 3 * size[s] if s in capped else weight[s] * level for s in order}
    source = {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == size[s] and abs(r["target"] - target[s]) < 1e-6 * total
        assert r["taken"] <= 3 * r["size"] and r["taken"] >= int(target[s] / max(size[s], 1)) * r["size"] - 1e-9
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= (31 if s != "lonely" else 5000) for s in order)
    again = mixing.mix_sizes(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    small_bins = mixing.apply_plan(*(lambda r: (r, mixing.mix_plan(r, bin_rows=50)))(docs.select(
        *[c.alias(n) for n, c in mixing._row(docs, "source", "doc_id", "text", None, 1).items()])))
    assert {r["__id"]: r["taken"] for r in small_bins.collect()} == {r["doc_id"]: r["taken"] for r in got}
    assert mixing.mix_sizes(none).count() == 0 and mixing.mix_sizes(odd).count() == len(ODD)
    assert "copies" in mixing.mix(odd).columns and mixing.mix(none).count() == 0


def test_chat_round_trip(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<", "<\\\\|", "a\n<|sep|>", "", None, "é<|"]
    rows = [(1, i, ["user", "assistant", None, "we<|sep|>ird\n"][i % 4], t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "assistant", None), (None, None, "user", "x"), (3, 1, "user", "b"), (3, 0, "user", "a"), (3, 1, "user", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumn("parts", chat.text_parts(F.col("text"))).withColumn("formatted", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    want = defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((t if t is not None else -1, role or "", text or ""))
    for c, turns_ in want.items():
        turns_.sort()
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [x[1:] for x in turns_]
        assert got[c]["loss_text"] == "".join(x[2] for x in turns_ if x[1] == "assistant")
        assert got[c]["formatted"].count("<|im_start|>") == len(turns_)
    assert chat.format_conversations(turns.limit(0)).count() == 0


def test_chat_parts(spark):
    turn = [(1, 0, "user", [("text", "look <|image|>", None, None), ("image", None, "i.png", None), ("audio", None, "a.wav", 7),
                            ("odd", None, "o", None)]),
            (1, 1, "assistant", [("text", "two words", None, None)]), (1, 2, "user", None)]
    kind = "conv_id long, turn long, role string, parts array<struct<kind:string,text:string,ref:string,tokens:bigint>>"
    r = chat.format_conversations(spark.createDataFrame(turn, kind)).first()
    assert [(a["turn_no"], a["kind"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        (1, "image", "i.png", 256), (1, "audio", "a.wav", 7), (1, "odd", "o", 1)]
    assert r["n_tokens"] == 2 + 256 + 7 + 1 + 2
    assert r["formatted"].index("<|image|>") < r["formatted"].index("<|audio|>") < r["formatted"].index("<|attachment|>")


def test_quality_equals_brute_force(spark, odd, none):
    rng = random.Random(8)
    texts = [None, "", "one"] + [" ".join(rng.choice("the of a#b cat dog. x|y".split()) + rng.choice(["", "\n", "\n\n"])
                                          for _ in range(rng.randint(1, 90))) for _ in range(40)]
    texts += [" ".join(str(i) for i in range(40)) * k for k in (1, 2, 3)] + ["w " * 9, "w " * 7]

    def brute(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        cover = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        ls = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), len(ls) - len(set(ls)), len(cover),
                len(w) < 20 or 100 * len(cover) > 30 * len(w))

    got = quality.judge_quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == brute(texts[r["doc_id"]])
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])
    assert quality.judge_quality(odd).count() == len(ODD) and quality.judge_quality(none).count() == 0


def test_url_parts_and_rules(spark):
    rows = [("https://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
            ("http://x.net/", "x.net", "/", "net/", "block"), ("http://xnet/", "xnet", "/", None, None),
            ("https://net", "net", "", None, None), ("https://b.org/fr/1", "b.org", "/fr/1", "org/fr/", "allow"),
            ("http://example.com/de/2#x", "example.com", "/de/2", "example.com/de/", "block"),
            ("no scheme", "", "", None, None), (None, "", "", None, None), ("x://y://z/w", "y:", "//z/w", None, None)]
    pages = spark.createDataFrame([(i, r[0], "clash") for i, r in enumerate(rows)], "page_id long, url string, score string")
    got = {r["page_id"]: r for r in urls.judge_urls(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(rows):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == (verdict or got[i]["verdict"])
    assert got[6]["verdict"] == got[7]["verdict"] == "allow" and urls.judge_urls(pages.limit(0)).count() == 0


def test_url_scores_equal_brute_force(spark):
    texts = ["ab/c", "ab/cd", "ab/c", "xy/z", "xz/z", "", "q"]
    label = [1, 1, 1, 0, 0, None, None]
    rows = spark.createDataFrame(list(zip(texts, label)), "__s string, y int").where("__s != ''")
    got = {r["__s"]: r["score"] for r in urls.score_urls(rows, F.col("y") == 1, F.col("y") == 0).collect()}

    def model(train):
        n = Counter()
        for t in train:
            p = "\x02" * 4 + t + "\x02"
            for i in range(4, len(p)):
                for k in range(1, 6):
                    n[p[i - k + 1:i + 1]] += 1

        def prob(gram):
            if not gram:
                return 1 / 256
            ctx = gram[:-1]
            follow = {g: c for g, c in n.items() if len(g) == len(gram) and g[:-1] == ctx}
            total = sum(follow.values())
            low = prob(gram[1:])
            return (n[gram] + len(follow) * low) / (total + len(follow)) if total else low
        return prob

    a, r = (model([t for t, y in zip(texts, label) if y == v]) for v in (1, 0))
    for t in set(texts) - {""}:
        p = "\x02" * 4 + t + "\x02"
        grams = [p[i - 4:i + 1] for i in range(4, len(p))]
        assert abs(got[t] - sum(np.log(a(g)) - np.log(r(g)) for g in grams) / len(grams)) < 1e-8


def test_warc_links_and_digests(spark):
    html = "<html lang='de'><head><title>T &amp; t</title></head><body><script>x('</p>')</script><p>a &lt; b<br>c</p><a href=x>l</a>"
    pages = spark.createDataFrame([(1, "http://a/", html), (2, None, None), (1, "http://a/", html)], "page_id long, url string, html string")
    responses = warc.page_responses(pages)
    origin = {r["page_id"]: r for r in responses.collect()}
    got = warc.derive(responses).collect()
    assert len(got) == 6 and warc.derive(responses.limit(0)).count() == 0
    for r in got:
        assert r["refers_to"] == origin[r["page_id"]]["record_id"] != r["record_id"]
        assert r["source_headers"]["content-type"] == "text/html; charset=utf-8"
        assert r["block_digest"] == "sha1:" + hashlib.sha1(r["body"].encode()).hexdigest()
        assert r["source_digest"] == "sha1:" + hashlib.sha1((html if r["page_id"] == 1 else "").encode()).hexdigest()
        assert r["content_length"] == len(r["body"].encode())
    one = {r["warc_type"]: r["body"] for r in got if r["page_id"] == 1}
    assert one["conversion"] == "a < b\nc\nl"
    meta = json.loads(one["metadata"])
    assert (meta["title"], meta["lang"], meta["links"], meta["status"]) == ("T &amp; t", "de", 1, "200")


def test_toxicity_on_held_out(spark, none):
    rng = random.Random(9)
    plain, bad = ["".join(rng.choice("etaoin") for _ in range(6)) for _ in range(300)], ["grumblix", "snarfle", "zoggish"]
    rows = []
    for i in range(900):
        w = [rng.choice(plain) for _ in range(rng.randint(20, 60))]
        y = int(rng.random() < 0.3)
        for _ in range(3 * y):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w), y))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(-1, None), (-2, ""), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    import zlib
    held = [(got[i]["predicted"], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    assert np.mean([p == y for p, y in held]) > 0.95 and got[-1]["score"] == got[-2]["score"] < 0.3
    assert toxicity.score_toxicity(none, model).count() == 0
    assert toxicity.train(docs, labels.limit(0)) is None
    assert {r["score"] for r in toxicity.score_toxicity(docs, None).collect()} == {0.0}
    kept = toxicity.drop_toxic(docs, labels)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"] == 0}


def test_decontamination_finds_leaks(spark, odd, none):
    rng = random.Random(10)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(4000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(text(rng.randint(14, 50)))) for k in range(30)] + [(90, None), (91, " ."), (92, "short one")]
    rows, want = [], set()
    for i in range(200):
        w = text(rng.randint(50, 400))
        if i % 4 == 0:
            k = rng.randrange(30)
            leak = items[k][1].upper().split()
            if i % 8 == 0:  # a paraphrase: one word in ten changed
                for j in range(0, len(leak), 10):
                    leak[j] = "other"
            at = rng.randrange(len(w))
            w[at:at] = leak
            want.add((i, k))
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "a short, one b")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
    assert got - want <= {(902, 92)} and len(want & got) >= 0.95 * len(want)
    assert decontam.contaminated(none, bench).count() == 0 == decontam.contaminated(docs, bench.limit(0)).count()
    kept = decontam.drop_contaminated(odd, bench)
    assert kept.count() == len(ODD) and kept.columns == odd.columns


def basis_and_products(texts, bases):
    """For each block's (items, idf, vocabulary, basis) the exact AᵀA of all passages of 48 words and of the items, and the basis."""
    for block, idf, vocab, basis in bases:
        gram = np.zeros((len(vocab), len(vocab)))
        passages = [w[i:i + 48] for w in map(str.split, texts) for i in range(0, len(w), 48)]
        passages = [p for p in passages if any(w.encode() in vocab for w in p)]
        weight = max(1, len(passages) / 20_000)
        for k, p in enumerate(passages + [x.words for x in block]):
            ids = [i for w in p if (i := vocab.get(w if isinstance(w, bytes) else w.encode())) is not None]
            if ids:
                a = np.bincount(ids, minlength=len(vocab)) * idf
                a /= np.linalg.norm(a)
                at = np.unique(ids)
                gram[np.ix_(at, at)] += np.outer(a[at], a[at]) * (weight if k >= len(passages) else 1)
        yield gram, basis


def test_decontamination_basis_is_that_of_all_passages(spark, monkeypatch):
    """Two corpora, one of more than 20,000 passages: the basis diagonalises the products of all passages, in every block."""
    rng = random.Random(31)
    words = [f"w{i}" for i in range(40)]
    items = [(k, " ".join(rng.choices(words[4 * k:4 * k + 12], k=12))) for k in range(8)]
    bases = []

    class Spy(decontam.Search):
        def __init__(self, items, idf, vocab, basis):
            bases.append((items, idf, vocab, basis))
            super().__init__(items, idf, vocab, basis)

    monkeypatch.setattr(decontam, "Search", Spy)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for n_docs, block, terms in ((400, 1000, 4096), (20, 3, 4096), (20, 3, 0)):
        texts = [" ".join(rng.choices(words[k % 9 * 4:k % 9 * 4 + 8] + ["x", "y"], k=2600)) for k in range(n_docs)]
        docs = spark.createDataFrame([*enumerate(texts), (None, None), (-1, "")], "doc_id long, text string")
        monkeypatch.setattr(decontam, "BLOCK_ITEMS", block)
        monkeypatch.setattr(decontam, "GRAM_TERMS", terms, raising=False)
        bases.clear()
        decontam.contaminated(docs, bench)
        assert len(bases) > 1 or block > 3
        for gram, basis in basis_and_products(texts, bases):
            values = basis.T @ gram @ basis
            assert np.abs(values - np.diag(np.diag(values))).max() < 1e-8 * values.max()
            assert np.allclose(basis.T @ basis, np.eye(basis.shape[1])) and (np.diff(np.diag(values)) <= 1e-6).all()


def test_pipeline_stage_fits_the_basis_on_all_passages(spark, monkeypatch, tmp_path):
    import corpus_pipeline
    rng = random.Random(33)
    words = [f"w{i}" for i in range(40)]
    bases = []

    class Spy(decontam.Search):
        def __init__(self, items, idf, vocab, basis):
            bases.append((items, idf, vocab, basis))
            super().__init__(items, idf, vocab, basis)

    monkeypatch.setattr(decontam, "Search", Spy)
    monkeypatch.setattr(decontam, "SAMPLE_PASSAGES", 50, raising=False)  # the former limit, for a small corpus
    leak = " ".join(rng.choices(words, k=20))
    spark.createDataFrame([(1, leak), (2, " ".join(rng.choices(words, k=20)))], "item_id long, text string") \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = [" ".join(rng.choices(words[k % 9 * 4:k % 9 * 4 + 8], k=500)) for k in range(20)]
    texts[3] += " " + leak
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    kept = corpus_pipeline.without_benchmark(spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == set(range(20)) - {3}
    for gram, basis in basis_and_products(texts, bases):
        values = basis.T @ gram @ basis
        assert np.abs(values - np.diag(np.diag(values))).max() < 1e-8 * values.max()


def test_decontamination_among_other_items_and_short_items():
    rng = random.Random(23)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    texts = [[rng.choice(vocab) for _ in range(n)] for n in [19, 20, 37, 38] * 15 + [4, 5, 6, 7] * 5]
    items = [decontam.read_item(k, " ".join(w)) for k, w in enumerate(texts)]
    terms = {w: i for i, w in enumerate(sorted({w for i in items for w in i.words}))}
    search = decontam.Search(items, np.ones(len(terms)), terms, np.eye(len(terms)))
    dumps, want = [], []
    for k in range(60):  # an item among words of six others, as it is and with one word in five replaced
        other = [rng.choice(texts[rng.randrange(60)]) for _ in range(180)]
        for step in (0, 5):
            leak = [("zzzzz" if step and j % step == 2 and j < len(texts[k]) - 4 else w) for j, w in enumerate(texts[k])]
            at = rng.randrange(len(other))
            dumps.append(" ".join(other[:at] + leak + other[at:]))
            want.append(k)
    found = {(i, k) for i, k, *_ in search.matches(dumps)}
    assert sum((i, k) in found for i, k in enumerate(want)) >= 0.9 * len(want)
    prose = [" ".join([rng.choice(vocab) for _ in range(150)] + texts[k] + ["end"] * 40) for k in range(60, 80)]
    found = {(i, k): (cos, at) for i, k, cos, _, _, at in search.matches(prose)}
    assert all(found[i, k] == (1.0, 150) for i, k in enumerate(range(60, 80)))
    only = decontam.Search(items[60:], np.ones(len(terms)), terms, np.eye(len(terms)))
    assert {(i, i) for i in range(20)} <= {m[:2] for m in only.matches(prose)}


def test_decontamination_subsequence():
    assert decontam.common_subsequence(list("abcbdab"), list("bdcaba")) == 4
    assert decontam.read_item(1, "What is it? Answer: forty two").answer == [b"forty", b"two"]


def test_language_fusion(spark, none):
    rng = random.Random(11)
    words = {"de": "der und nicht straße über".split(), "en": "the and with from this".split(),
             "es": "el los para niño que".split(), "fr": "le les été avec être".split()}
    say = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(30))
    docs = spark.createDataFrame([(i, say(x), x) for i, x in enumerate(list(words) * 40)], "__id long, __t string, __lang string")
    model = langid.text_model(docs)
    pages = [(i, f"http://h{i % 4}.site.de/", f"<html lang='{x}'><p>{say(x)}</p>") for i, x in enumerate(list(words) * 10)]
    pages += [(100, "http://h1.site.de/", "<html>"), (101, None, None), (102, "http://new.org/", "<html lang=fr>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in langid.identify(langid.page_rows(df), model).collect()}
    assert all(got[i]["language"] == x for i, x in enumerate(list(words) * 10))
    assert got[100]["language"] == "en" and got[102]["language"] == "fr" and len(got) == len(pages)
    assert langid.identify(langid.page_rows(df.limit(0)), model).count() == 0


def test_pipeline_stages_on_a_small_corpus(spark, tmp_path):
    import corpus_pipeline as cp
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    leak = " ".join(word() for _ in range(30))
    base = [[word() for _ in range(60)] for _ in range(60)]
    rows = [(i, " ".join(w), "en", f"s{i % 3}", 0) for i, w in enumerate(base)]
    rows += [(100, rows[0][1], "en", "s0", 0), (101, " ".join(base[1][:30]) + " " + leak, "en", "s1", 0), (102, None, None, None, None)]
    rows = [(a, b, c, d, len(b) if b else 0) for a, b, c, d, _ in rows]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in cp.STAGES:
        docs = cp.written(stage(spark, docs, str(tmp_path)))
        seen.append({r["doc_id"] for r in docs.collect()})
        if stage is not cp.STAGES[-1][1]:
            assert docs.columns == [c.split()[0] for c in kind.split(", ")]
    assert seen[0] == seen[1] == {r[0] for r in rows}
    assert seen[2] == seen[1] - {102}  # the emptied copy and the null text are one group
    assert seen[3] == seen[2] - {101} and seen[4] <= seen[3]


def test_package_tasks_need_no_import_path():
    assert all(m.__name__ in sys.modules for m in (golay, toxicity, decontam, langid))
