"""Chat formatting with typed content parts, control-string escaping and loss spans (DataFrame functions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import barrier
from .mixing import word_count

START, SEP, END = "<|im_start|>", "<|sep|>", "<|im_end|>\n"
#: placeholder and default number of tokens of the parts that are no text
PART_KINDS = {"image": ("<|image|>", 256), "audio": ("<|audio|>", 100), "document": ("<|document|>", 500)}
OTHER_KIND = ("<|attachment|>", 1)


def escape(text: Column) -> Column:
    """One backslash more between ``<`` and ``|``: afterwards a text holds no control string."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _placeholder(kind: Column) -> Column:
    out = F.lit(OTHER_KIND[0])
    for name, (mark, _) in PART_KINDS.items():
        out = F.when(kind == name, F.lit(mark)).otherwise(out)
    return out


def _tokens(part: Column) -> Column:
    out = F.lit(OTHER_KIND[1])
    for name, (_, n) in PART_KINDS.items():
        out = F.when(part["kind"] == name, F.lit(n)).otherwise(out)
    return F.coalesce(part["tokens"].cast("long"), out.cast("long"))


def _flattened(parts: Column, is_text) -> Column:
    """Parts in order as one text: neighbouring texts are joined before they are escaped, so that no control string
    can be put together from two parts; every other part is its placeholder."""
    start = F.struct(F.lit("").alias("out"), F.lit("").alias("text"))

    def visit(acc, p):
        said = F.struct(acc["out"].alias("out"), F.concat(acc["text"], F.coalesce(p["text"], F.lit(""))).alias("text"))
        other = F.struct(F.concat(acc["out"], escape(acc["text"]), _placeholder(p["kind"])).alias("out"), F.lit("").alias("text"))
        return F.when(is_text(p), said).otherwise(other)

    return F.aggregate(parts, start, visit, lambda acc: F.concat(acc["out"], escape(acc["text"])))


def text_parts(text: Column) -> Column:
    """A plain text as the one part of a turn."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("long").alias("tokens")))


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         parts: str = "parts", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans, attachments, n_tokens``.

    ``parts`` is an array of ``kind, text, ref, tokens``.  A visitor flattens it in order: neighbouring text parts
    are joined and escaped, every other part becomes a placeholder of its kind.  ``attachments`` lists those
    parts (``turn_no, kind, ref, tokens``) in the order of their placeholders, ``n_tokens`` counts words
    of the texts and the tokens the placeholders expand to.  ``loss_spans`` (``start, length``, from 1, in code points) mark
    what turns of ``loss_roles`` say.

    Turns are ordered by (turn, role, content), null turns first; repeated rows are turns of their own; null texts,
    null parts and null roles are empty; null conversation ids are one conversation; an empty table
    gives no rows; other columns are not read.
    """
    t = turns.select(F.col(conv_id).alias("__conv"), F.col(turn).alias("__turn"),
                     F.coalesce(F.col(role), F.lit("")).alias("__role"), F.col(parts).alias("__parts"))
    is_text = lambda p: F.coalesce(p["kind"], F.lit("text")) == "text"
    content = _flattened(F.coalesce(F.col("__parts"), F.array().cast(t.schema["__parts"].dataType)), is_text)
    others = F.transform(F.filter(F.col("__parts"), lambda p: ~is_text(p)), lambda p: F.struct(
        p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))
    words = F.aggregate(F.filter(F.col("__parts"), is_text), F.lit(0).cast("long"),
                        lambda acc, p: acc + word_count(p["text"]))
    t = barrier(t, __head=F.concat(F.lit(START), escape(F.col("__role")), F.lit(SEP)),
                __content=F.coalesce(content, F.lit("")), __others=F.coalesce(others, F.array().cast(
                    "array<struct<kind:string,ref:string,tokens:bigint>>")), __words=F.coalesce(words, F.lit(0)))
    t = t.withColumn("__piece", F.concat("__head", "__content", F.lit(END)))
    order = Window.partitionBy("__conv").orderBy("__turn", "__role", "__content", "__words")
    t = t.withColumn("__no", F.row_number().over(order)) \
        .withColumn("__at", F.sum(F.length("__piece")).over(order.rowsBetween(Window.unboundedPreceding, 0))
                    - F.length("__piece"))
    g = t.groupBy("__conv").agg(F.sort_array(F.collect_list(F.struct(
        "__no", "__piece", (F.col("__at") + F.length("__head") + 1).cast("long").alias("start"),
        F.length("__content").cast("long").alias("length"), F.col("__role").isin(*loss_roles).alias("loss"),
        "__others", "__words"))).alias("__t"))
    tokens = F.aggregate("__t", F.lit(0).cast("long"), lambda acc, x: acc + x["__words"] + F.aggregate(
        x["__others"], F.lit(0).cast("long"), lambda a, o: a + o["tokens"]))
    return g.select(
        F.col("__conv").alias(conv_id),
        F.array_join(F.transform("__t", lambda x: x["__piece"]), "").alias("formatted"),
        F.transform(F.filter("__t", lambda x: x["loss"]), lambda x: F.struct(
            x["start"].alias("start"), x["length"].alias("length"))).alias("loss_spans"),
        F.flatten(F.transform("__t", lambda x: F.transform(x["__others"], lambda o: F.struct(
            x["__no"].alias("turn_no"), o["kind"].alias("kind"), o["ref"].alias("ref"), o["tokens"].alias("tokens")))))
        .alias("attachments"),
        tokens.alias("n_tokens"))


def read_back(formatted: DataFrame, text: str = "formatted", spans: str = "loss_spans") -> DataFrame:
    """Add ``turns`` (array of ``role, text``) and ``loss_text``, read from the formatted text and its spans only."""
    f = barrier(formatted, __turns=F.slice(F.split(F.col(text), r"<\|im_start\|>"), 2, 2 ** 31 - 1))
    turns = F.transform("__turns", lambda x: F.struct(
        unescape(F.substring_index(x, SEP, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(x, END, 1), SEP, -1)).alias("text")))
    loss = F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(F.col(text), s["start"].cast("int"), s["length"].cast("int")))), "")
    return barrier(f, turns=turns, loss_text=loss).drop("__turns")
