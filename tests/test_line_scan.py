"""Transcripts read line by line over file splits give what whole files give."""

import random

import pytest

from parlance.sources import line_scan, transcripts as tr

SMALL = "61"  # bytes of a split: every file is cut many times, also inside utterances


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": SMALL, "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    bits, line_scan.BLOCK_BITS = line_scan.BLOCK_BITS, 1  # and blocks of two lines
    yield spark
    line_scan.BLOCK_BITS = bits
    for k, v in old.items():
        spark.conf.set(k, v)


def both(spark, folder, fmt, **kw):
    split = line_scan.read_transcript_lines(spark, str(folder), fmt, **kw)
    whole = tr.read_transcripts(spark, str(folder), fmt, **kw)
    got = [sorted((r.file_name, r.dialogue_idx, r.speaker, r.text) for r in t.utterances.join(
        t.sessions.select("session_key", "file_name"), "session_key").collect()) for t in (split, whole)]
    facts = [sorted((r.file_name, r.transcript_idx, r.session_date, r.session_number, sorted(r.metadata.items()))
                    for r in t.sessions.collect()) for t in (split, whole)]
    assert facts[0] == facts[1]
    assert got[0] == got[1]
    return got[0]


COLON = {
    "a_2023-05-15_001": "intro\nAnn: one\n  more\n\n\nBob:\n\nCleo: x\ny\r\nDan:\n\n  late\n" + "z" * 300 + "\nAnn:",
    "b": "", "c": "\n\n", "d": "no speaker at all\n", "e_7": "A: " + "long line " * 60 + "\nB: y\n" + "w\n" * 90,
    "f": "Thérapeute: ça\n va\nI said: fine\n", "g": "A:\nB:\nC:\n\n\n" + "\n" * 120 + "after blanks\nD: end"}


def test_colon_files_over_splits(small_splits, tmp_path):
    for name, text in COLON.items():
        (tmp_path / f"{name}.txt").write_bytes(text.encode())
    got = both(small_splits, tmp_path, "txt")
    assert ("g.txt", 0, "C", "after blanks") in got and len(got) > 8
    both(small_splits, tmp_path, "txt", speakers=("Ann", "A"))


FRONT = ["---\ntitle: \"x\"\npatient: p: q\ntitle: y\n---\n\n   Ann: hi\nthere\n", "---\nonly: open\nAnn: hi\n",
         "--- a: b --- Ann: same line\nmore\n", "---\na: 1\nb ---\nAnn: x\n", "--- \n\n---   \n\n \n  Ann: stripped\n",
         "---title\n---\nAnn: none\n", "---\n---\nAnn: in\n---\nBob: out\n", "Ann: x\n---\nBob: y\n", "---", "---\n",
         "---\na: 1\n---", "---\na: 1\n---\n\n\n", "---\na:1\n--- Ann: rest\nBob: z\n", "---\nlong: " + "v " * 90 + "\n---\nAnn: k\n"]


def test_front_matter_over_splits(small_splits, tmp_path):
    for i, text in enumerate(FRONT):
        (tmp_path / f"s_{i}.mdx").write_text(text)
    assert len(both(small_splits, tmp_path, "mdx")) > 8


@pytest.mark.parametrize("compat", [False, True])
def test_bold_files_over_splits(small_splits, tmp_path, compat):
    texts = ["# t\n**Client**\nhi\n\n there \n**Therapist:** yes\nmore\n****\nlost\nlost too\n**A** \n\n\nx\n",
             "****\n" + "q\n" * 100 + "**B**\n" + "r\n" * 100, "**A:**\n**B:**\n", "before\n** C **  inline\n"]
    for i, text in enumerate(texts):
        (tmp_path / f"b{i}.md").write_text(text)
    assert both(small_splits, tmp_path, "md", compat=compat)


def test_random_files_over_splits(small_splits, tmp_path):
    rng = random.Random(6)
    parts = ["A: x", "B:", "", "  ", "and on", "C: y z", "---", "é" * 30, "D:   "]
    for i in range(12):
        (tmp_path / f"r{i}.txt").write_text("\n".join(rng.choice(parts) for _ in range(rng.randint(0, 120))))
    both(small_splits, tmp_path, "txt")


def test_missing_folder_and_no_match(spark, tmp_path):
    t = line_scan.read_transcript_lines(spark, str(tmp_path / "none"), "txt")
    assert t.sessions.count() == 0 and t.utterances.count() == 0
    (tmp_path / "x.md").write_text("**A**\nb\n")
    t = line_scan.read_transcript_lines(spark, str(tmp_path), "txt")
    assert t.sessions.count() == 0 and t.utterances.count() == 0
    with pytest.raises(ValueError):
        line_scan.read_transcript_lines(spark, str(tmp_path), "pdf")
