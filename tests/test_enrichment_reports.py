"""Bounded prompt parts, merges, the completion contract, report lines and report files."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from parlance.operators import enrich as en
from parlance.operators import prompt_parts as pt
from parlance.options import EnrichOptions
from parlance.sources import report_files, sinks

INFO = "session_key long, sentiment_info string"
TOPIC = "session_key long, topic_info string"


def clients(spark, n_sessions=9, seed=1):
    rng = random.Random(seed)
    s, u = [], []
    for k in range(n_sessions):
        client = rng.choice(["p", "p", None])  # most sessions belong to one client, some to none
        s.append((client, k, k, None, None, {"patient": "Zoe"} if k % 2 else {}))
        for i in range(rng.randint(0, 12)):
            u.append((k, i, rng.choice(["A", None]), rng.choice([None, "", "short", "w " * rng.randint(1, 400)])))
    return (spark.createDataFrame(s, "patient_id string, session_key long, transcript_idx long, session_number int, "
                                     "session_date date, metadata map<string,string>"),
            spark.createDataFrame(u, "session_key long, dialogue_idx long, speaker string, text string"),
            spark.createDataFrame([(1, "S1")], INFO), spark.createDataFrame([(2, "T2")], TOPIC))


@pytest.mark.parametrize("budget", [10, 120, 100_000])
def test_parts_hold_everything_once(spark, budget):
    s, u, si, ti = clients(spark)
    items = pt.progress_items(s, u, si, ti, ["patient_id"])
    want = {}
    for r in items.orderBy("transcript_idx", "kind", "idx").collect():
        want.setdefault(r.patient_id, []).append(r.text)
    parts = pt.packed(items, ["patient_id"], pt.ITEM_ORDER, budget=budget)
    texts = pt.part_texts(parts, ["patient_id"], pt.ITEM_ORDER).collect()
    assert all(len(r.text) <= budget for r in texts)
    got = {}
    for r in parts.orderBy("transcript_idx", "kind", "idx", "piece").collect():
        rows = got.setdefault(r.patient_id, {})
        rows.setdefault((r.transcript_idx, r.kind, r.idx), []).append((r.part, r.text))
    for client, rows in got.items():
        assert ["".join(t for _, t in v) for v in rows.values()] == want[client]
        numbers = [p for v in rows.values() for p, _ in v]
        assert numbers == sorted(numbers) and set(numbers) == set(range(numbers[-1] + 1))
    assert all(r.n_parts == 1 + max(x.part for x in texts if x.patient_id == r.patient_id) for r in texts)


def test_prompts_per_client_and_for_all(spark):
    s, u, si, ti = clients(spark, 5)
    for keys in (["patient_id"], []):
        rows = pt.progress_prompt_parts(s, u, si, ti, keys, budget=300).collect()
        assert rows and all("SESSION DATA (part" in r.prompt for r in rows if r.prompt)
    one = pt.progress_prompt_parts(s.limit(1), u, si, ti, [], budget=50).collect()
    assert len(one) == 1 and one[0].prompt is None and "at least 2" in one[0].error
    assert pt.progress_prompt_parts(s.limit(0), u, si, ti, ["patient_id"]).collect() == []


def test_merge_tree_ends_in_one_reply(spark):
    parts = spark.createDataFrame([(c, i, n, f"{c}{i}", None) for c, n in (("a", 30), ("b", 1), ("c", 4)) for i in range(n)],
                                  "client string, part long, n_parts long, prompt string, error string")

    def fake(prompts):
        # a merge prompt names its parts: keep what it holds, in order
        return ["+".join(x.split(":\n")[1].split("\n")[0] for x in p.split("PART ")[1:]) if "PART " in p else p for p in prompts]

    got = {r.client: r for r in pt.progress_replies(parts, fake, ["client"], EnrichOptions(fan_in=3)).collect()}
    assert got["a"].response == "+".join(f"a{i}" for i in range(30)) and got["a"].n_parts == 30
    assert got["b"].response == "b0" and got["c"].response == "c0+c1+c2+c3"
    whole = pt.progress_replies(parts.where("client = 'c'").drop("client"), fake, (), EnrichOptions(fan_in=2)).collect()
    assert [(r.n_parts, r.response) for r in whole] == [(4, "c0+c1+c2+c3")]

    def broken(prompts):
        raise RuntimeError("down")

    out = pt.progress_replies(parts.where("client = 'b'"), broken, ["client"], EnrichOptions(retries=0)).collect()
    assert out[0].response is None and "response" in out[0].error


def test_completion_contract(spark, tmp_path):
    log = str(tmp_path / "asked")
    os.makedirs(log)
    rows = [(i, f"p{i % 7}", None) for i in range(60)] + [(100, None, None), (101, "x", "no content")]
    df = spark.createDataFrame(rows, "id long, prompt string, error string").repartition(5)

    def fake(prompts, opts):
        import uuid
        for p in prompts:  # one file a question, and once a failure
            open(f"{log}/{p}-{uuid.uuid4().hex}", "w").close()
            if p == "p3" and len([f for f in os.listdir(log) if f.startswith("p3-")]) < 3:
                raise RuntimeError("try again")
            if p == "p4":
                raise RuntimeError("never")
        return [f"{p} {opts.temperature} {opts.max_tokens} {opts.extra['m']}" if p != "p5" else "" for p in prompts]

    opts = EnrichOptions(temperature=0.7, max_tokens=9, extra={"m": "v"}, partitions=2, batch_size=2, retries=3,
                         backoff_seconds=0.01)
    got = {r.id: r for r in en.complete(df, fake, opts, "named").collect()}
    assert len(got) == 62
    for i in range(60):
        r, p = got[i], i % 7
        if p == 4:
            assert r.response is None and r.error == "Failed to get response: never"
        elif p == 5:
            assert r.response is None and r.error == "Failed to get LLM response"
        else:
            assert r.response == f"p{p} 0.7 9 v" and r.error is None and r.model == "named"
    assert got[100].response is None and got[100].error is None and got[101].error == "no content"
    asked = [f.split("-")[0] for f in os.listdir(log)]
    assert asked.count("x") == 0 and asked.count("p4") <= 5 and all(asked.count(f"p{k}") <= 5 for k in range(7))


def test_rate_limit_waits():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limit = en.RateLimit(2.0, burst=1, clock=lambda: now[0], sleep=sleep)
    for _ in range(5):
        limit.take()
    assert math.isclose(sum(slept), 2.0)
    waits = []
    out = en.ask(["a"], lambda p: [None], EnrichOptions(retries=3, backoff_seconds=1.0), en.RateLimit(None), waits.append)
    assert waits == [1.0, 2.0, 4.0] and out == [(None, "Failed to get LLM response")]


def test_reply_sections(spark):
    cases = {"Summary:\n\nShort.\n\nKey insights: a\n\nEmotional tone: b\n\nFocus: c": ("Short.", 1, 1, 1),
             "hello": ("hello", 0, 0, 0), "": ("", 0, 0, 0), "a\n\nsummary": ("a\n\nsummary", 0, 0, 0),
             "Summary insight\n\nTheme x\n\nsummary 2\n\nlast": ("last", 0, 1, 0), "pattern\n\nfocus": ("", 1, 0, 1)}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "r string")
    for row in df.select("r", en.parse_reply(F.col("r")).alias("p")).collect():
        if row.r is None:
            assert row.p is None
        else:
            p = row.p
            assert (p.summary, len(p.insights), len(p.emotional_themes), len(p.therapeutic_focus)) == cases[row.r], row.r


def test_report_files(spark, tmp_path):
    rows = [("p/1", 1, "session 1", "a\nb"), ("p/1", 2, "session 1", "c"), ("p/1", 3, "session 2", None),
            (None, None, "overall progress", "é")]
    df = spark.createDataFrame(rows, "patient_id string, session_key long, report_name string, content string").repartition(3)
    want = {"patient_id=p_1/session_1_1_20240101_000000.md": "a\nb", "patient_id=p_1/session_1_2_20240101_000000.md": "c",
            "patient_id=p_1/session_2_20240101_000000.md": "", "patient_id=none/overall_progress_20240101_000000.md": "é",
            "_SUCCESS": "4"}
    for _ in range(2):  # a repeated run leaves no duplicates
        report_files.write_report_files(df, str(tmp_path), "pdf", "20240101_000000")
        got = {os.path.relpath(os.path.join(d, f), tmp_path): open(os.path.join(d, f), encoding="utf-8").read()
               for d, _, names in os.walk(tmp_path) for f in names}
        assert got == want
    stamp = report_files.write_report_files(df.drop("patient_id").limit(1), str(tmp_path / "more"), "HTML")
    assert [f for f in os.listdir(tmp_path / "more") if f != "_SUCCESS"][0].endswith(f"_{stamp}.html")


def test_flat_table_beyond_the_column_limit(spark):
    s = spark.createDataFrame([(1, "f", None, 1, {f"k{i}": str(i) for i in range(30)})],
                              "session_key long, file_name string, session_date date, session_number int, metadata map<string,string>")
    u = spark.createDataFrame([(1, 0, "A", "x")], "session_key long, dialogue_idx long, speaker string, text string")
    wide = sinks.flat_utterances(s, u).first().asDict()
    assert wide["metadata_k7"] == "7"
    packed = sinks.flat_utterances(s, u, max_columns=10).first()
    import json
    assert json.loads(packed.metadata) == {f"k{i}": str(i) for i in range(30)}
