"""Prompts of bounded size for groups of any size (L6): parts by prefix sums, a reply each, a tree of merges.

A client's sessions are a stream of items (session head, entries, highlights).  Prefix sums of the items' lengths, kept in
narrow rows, say where each item lies in the stream; its part number follows from that alone, so no client is
collected: a task holds one part at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import join_groups, running_sums
from ..options import EnrichOptions
from ..session import ensure_checkpoint_dir, stored, with_scalar
from . import enrich as en

HEAD, ENTRY, FOOT = 0, 1, 2


def per_group(df: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach a group's one row of ``facts``; without keys the one row there is, as literals."""
    return join_groups(df, facts, keys) if keys else with_scalar(df, facts)


def packed(items: DataFrame, keys: Sequence[str], order: Sequence[str], text: str = "text", budget: int = 12_000) -> DataFrame:
    """Rows ``keys, part, *order, piece, text``: every item once, in parts of at most ``budget`` characters.

    Items (unique by ``keys`` and ``order``, ascending) are joined by a line feed inside a part.  An item of more than
    half the budget is cut into pieces of consecutive parts; a shorter one is never cut.  A part starts anew with
    each half budget of the stream, so it holds between none and two halves.  Empty texts are items too.
    """
    if budget < 8:
        raise ValueError("budget must be 8 characters or more")
    keys, order, half = list(keys), list(order), budget // 2
    size = half - 1  # of a piece; the line feed after it is counted with it
    n_pieces = lambda length: F.greatest(F.ceil(length / size), F.lit(1))
    length = F.length(F.coalesce(F.col(text), F.lit("")))
    narrow = items.select(*keys, *order, length.cast("long").alias("__n"))
    placed = running_sums(narrow, keys, order, {"__before": F.col("__n") + n_pieces(F.col("__n"))}).drop("__n")
    j = join_groups(items.select(*keys, *order, F.coalesce(F.col(text), F.lit("")).alias("__text")), placed, [*keys, *order])
    pieces = F.sequence(F.lit(0), (n_pieces(F.length("__text")) - 1).cast("int"))
    j = j.select(*keys, *order, "__before", "__text", F.explode(pieces).alias("piece"))
    return j.select(*keys, F.floor((F.col("__before") + F.col("piece") * F.lit(half)) / half).alias("part"), *order, "piece",
                    F.substring(F.col("__text"), F.col("piece") * size + 1, F.lit(size)).alias(text))


def part_texts(parts: DataFrame, keys: Sequence[str], order: Sequence[str], text: str = "text") -> DataFrame:
    """``keys, part, n_parts, text``: the pieces of each part joined by line feeds; ``n_parts`` per group."""
    keys = list(keys)
    g = parts.groupBy(*keys, "part").agg(F.sort_array(F.collect_list(F.struct(*order, "piece", F.col(text).alias("__x")))).alias("__p"))
    g = g.select(*keys, "part", F.array_join(F.transform("__p", lambda p: p["__x"]), "\n").alias(text))
    last = parts.groupBy(*keys).agg((F.max("part") + 1).alias("n_parts"))
    return per_group(g, last, keys)


def progress_items(sessions: DataFrame, utterances: DataFrame, sentiment_info: DataFrame, topic_info: DataFrame,
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """The progress prompt's items: ``group_cols, transcript_idx, kind, idx, text`` (L3 and L4 after each session)."""
    keys = list(group_cols)
    own = [c for c in keys if c in utterances.columns]
    s = sessions.select(*keys, "session_key", "transcript_idx", "session_number", "session_date")
    date = F.coalesce(F.date_format("session_date", "yyyy-MM-dd HH:mm:ss"), F.lit("None"))
    zero = F.lit(0).cast("long").alias("idx")
    at = [*keys, "transcript_idx"]
    head = s.select(*at, F.lit(HEAD).alias("kind"), zero, F.concat(
        F.lit("SESSION "), en._s(F.col("session_number")), F.lit(" ("), date, F.lit("):\nContent:")).alias("text"))
    said = utterances.drop(*own).join(s.select("session_key", *at), "session_key").select(
        *at, F.lit(ENTRY).alias("kind"), F.col("dialogue_idx").alias("idx"), F.concat(
            F.coalesce("speaker", F.lit("Unknown")), F.lit(": "), F.coalesce("text", F.lit(""))).alias("text"))
    foot = s.join(sentiment_info, "session_key", "left").join(topic_info, "session_key", "left").select(
        *at, F.lit(FOOT).alias("kind"), zero, F.concat(
            F.lit("Sentiment: "), F.coalesce("sentiment_info", F.lit(en.NO_SENTIMENT)),
            F.lit("\nTopics: "), F.coalesce("topic_info", F.lit(en.NO_TOPIC))).alias("text"))
    return head.unionByName(said).unionByName(foot)


ITEM_ORDER = ("transcript_idx", "kind", "idx")


def progress_prompt_parts(sessions: DataFrame, utterances: DataFrame, sentiment_info: DataFrame, topic_info: DataFrame,
                          group_cols: Sequence[str] = (), budget: int = 12_000) -> DataFrame:
    """L6 in bounded parts: ``group_cols, part, n_parts, prompt, error``.

    Every session head, entry and highlight of a client is in exactly one part (cut only beyond half the budget);
    the session data of a prompt has at most ``budget`` characters.  A client with one session gets one row with
    the error, without sessions none.
    """
    keys = list(group_cols)
    patient = en._patient(sessions)
    who = sessions.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min_by(patient, "transcript_idx").alias("__who"))
    # lengths and texts read the items, and the parts' texts and numbers the parts: each is made once
    items = stored(progress_items(sessions, utterances, sentiment_info, topic_info, keys), "items")
    texts = part_texts(stored(packed(items, keys, ITEM_ORDER, budget=budget), "parts"), keys, ITEM_ORDER)
    j = per_group(texts, who, keys)
    ok = F.col("__n") >= 2
    prompt = F.concat(
        F.lit("Please analyze these therapy session transcripts from "), F.coalesce("__who", F.lit("the client")),
        F.lit(" and provide insights about the client's progress across sessions:\n\n"), F.lit(en.PROGRESS_ASK),
        F.lit("SESSION DATA (part "), (F.col("part") + 1).cast("string"), F.lit(" of "), F.col("n_parts").cast("string"),
        F.lit("):\n\n"), F.col("text"))
    return j.where(ok | (F.col("part") == 0)).select(
        *keys, "part", "n_parts", F.when(ok, prompt).alias("prompt"),
        F.when(~ok, "Need at least 2 transcripts to analyze progress").alias("error"))


def merge_prompts(replies: DataFrame, keys: Sequence[str], fan_in: int = 8) -> DataFrame:
    """One prompt for ``fan_in`` consecutive replies (``keys, part, response, error``) of a group."""
    keys = list(keys)
    n = F.floor(F.col("part") / fan_in)
    said = F.when(F.col("response").isNotNull(), F.struct("part", "response"))
    g = replies.groupBy(*keys, n.alias("__n")).agg(F.sort_array(F.collect_list(said)).alias("__r"),
                                                   F.min("error").alias("__e"))
    body = F.array_join(F.transform("__r", lambda r: F.concat(
        F.lit("PART "), (r["part"] + 1).cast("string"), F.lit(":\n"), r["response"])), "\n\n")
    some = F.size("__r") > 0
    return g.select(*keys, F.col("__n").alias("part"), F.when(some, F.concat(
        F.lit("Please combine these partial analyses of one client's sessions, in order, into one:\n\n"),
        F.lit(en.PROGRESS_ASK), body)).alias("prompt"), F.when(~some, F.col("__e")).alias("error"))


def progress_replies(parts: DataFrame, completer: Callable[[list[str]], list[str]], group_cols: Sequence[str] = (),
                     opts: EnrichOptions = EnrichOptions()) -> DataFrame:
    """One reply per group: ``group_cols, n_parts, response, error``.

    Each part is asked, then ``opts.fan_in`` replies at a time are merged until one is left, so the levels grow with the
    logarithm of the parts and a prompt holds that many replies at most.  Replies of a level are checkpointed: no
    prompt is asked twice.  Failed parts are left out of the merge; a group of which all failed has the error.
    """
    if opts.fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    ensure_checkpoint_dir(parts.sparkSession)
    keys = list(group_cols)

    def ask(prompts):
        return en.complete(prompts, completer, opts).select(*keys, "part", "response", "error").checkpoint(eager=True)

    n_parts = parts.groupBy(*keys).agg(F.max("n_parts").alias("n_parts"))
    level = ask(parts.select(*keys, "part", "prompt", "error"))
    done = None
    while True:
        size = level.groupBy(*keys).agg((F.max("part") + 1).alias("__parts")).checkpoint(eager=True)
        sized = per_group(level, size, keys)
        ready = sized.where("__parts = 1").drop("__parts")
        done = ready if done is None else done.unionByName(ready)
        if size.where("__parts > 1").isEmpty():
            break
        level = ask(merge_prompts(sized.where("__parts > 1").drop("__parts"), keys, opts.fan_in))
    done = done.select(*keys, "response", "error")
    return per_group(done, n_parts, keys).select(*keys, "n_parts", "response", "error")
