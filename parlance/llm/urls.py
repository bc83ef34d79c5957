"""URL filter: host and path rules, and a character language-model ratio for the rest.

Two variable-order Markov models (Witten-Bell smoothing over up to four characters of context)
are trained on accepted and on rejected URLs; a URL is judged by the difference of its
log-likelihoods per character against a threshold calibrated on URLs held out of training.
Everything is grouped counting and joins over n-grams.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sized, written

ORDER = 5
#: marks the start and the end of a URL inside the models
EDGE = "\x02"
ALPHABET = 256
#: share of the rule-decided URLs that calibrate the threshold, as one in so many
HELD_OUT = 5
#: width of a bin of scores in the calibration, and the largest score
BIN, LARGEST = 0.02, 8.0


@dataclass(frozen=True)
class UrlRule:
    """``text`` is host and path: it fits the host and its subdomains if the path starts so."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


RULES = (UrlRule("block", "net/"), UrlRule("allow", "example.net/en/"), UrlRule("block", "example.com/de/"),
         UrlRule("allow", "org/fr/"))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    h = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(h, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_column(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """The longest rule that fits, as a struct of ``text`` and ``verdict``; null if none does."""
    out = F.lit(None)
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(urls: DataFrame, *keep: str) -> DataFrame:
    """One row per character of ``__s`` and its end: ``gram``, the character with its context."""
    padded = urls.select(*keep, F.concat(F.lit(EDGE * (ORDER - 1)), F.col("__s"), F.lit(EDGE)).alias("__p"))
    at = F.sequence(F.lit(1), F.length("__p") - ORDER + 1)
    return padded.select(*keep, F.explode(F.transform(at, lambda i: F.substring("__p", i, F.lit(ORDER)))).alias("gram"))


def gram_ratios(grams: DataFrame) -> DataFrame:
    """``gram, ratio``: log of accepted over rejected probability of a character in its context.

    ``grams``: ``gram`` (of the full order), ``a`` and ``r`` (counts in accepted and rejected URLs,
    zero for grams that are only to be scored).  Lower orders are sums of the higher one.  A
    context that a class has not seen leaves that class's estimate to the next shorter context.
    """
    model = None
    for k in range(1, ORDER + 1):
        g = grams.groupBy(F.right("gram", F.lit(k)).alias("g")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        g = g.withColumn("c", F.left("g", F.lit(k - 1)))
        ctx = g.groupBy("c").agg(
            F.sum("a").alias("na"), F.count_if(F.col("a") > 0).alias("ta"),
            F.sum("r").alias("nr"), F.count_if(F.col("r") > 0).alias("tr"))
        g = g.join(ctx, "c")
        if model is None:
            g = g.withColumn("pa", F.lit(1.0 / ALPHABET)).withColumn("pr", F.lit(1.0 / ALPHABET))
        else:
            lower = model.select(F.col("g").alias("low"), "pa", "pr")
            g = g.join(lower, F.right("g", F.lit(k - 1)) == F.col("low"))
        def mixed(n, total, types, p):
            return F.when(total > 0, (n + types * p) / (total + types)).otherwise(p)

        model = written(g.select("g", mixed(F.col("a"), F.col("na"), F.col("ta"), F.col("pa")).alias("pa"),
                                 mixed(F.col("r"), F.col("nr"), F.col("tr"), F.col("pr")).alias("pr")))
    return written(model.select(F.col("g").alias("gram"), (F.log("pa") - F.log("pr")).alias("ratio")))


def score_urls(urls: DataFrame, accepted: Column, rejected: Column) -> DataFrame:
    """``__s, score``: log-likelihood difference per character of every distinct ``__s``.

    ``urls``: ``__s`` (with repeats); the two conditions choose the training rows.
    """
    counted = written(urls.groupBy("__s").agg(F.count_if(accepted).alias("a"), F.count_if(rejected).alias("r")))
    grams = written(_grams(counted, "a", "r").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    ratios = gram_ratios(grams)
    return written(_grams(counted, "__s").join(sized(ratios), "gram").groupBy("__s")
                   .agg(F.round(F.avg("ratio"), 9).alias("score")))


def calibrated(held: DataFrame) -> float:
    """Threshold with the largest difference of accepted kept and rejected kept; ties go to the lowest.

    ``held``: ``score`` and ``ok``.  Scores are counted in at most 801 bins, so the table that comes to
    the driver has a fixed size.  Without one of the classes nothing is rejected.
    """
    bins = held.groupBy(F.floor(F.greatest(F.least("score", F.lit(LARGEST)), F.lit(-LARGEST)) / BIN).alias("b")) \
        .agg(F.count_if("ok").alias("a"), F.count_if(~F.col("ok")).alias("r")).orderBy("b").collect()
    accepted, rejected = sum(x["a"] for x in bins), sum(x["r"] for x in bins)
    if not accepted or not rejected:
        return float("-inf")
    best, at, a, r = 0.0, float("-inf"), accepted, rejected
    for x in bins:
        if a / accepted - r / rejected > best:
            best, at = a / accepted - r / rejected, x["b"] * BIN
        a, r = a - x["a"], r - x["r"]
    return at


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url",
               rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every input row.

    The longest rule that fits decides.  URLs that rules decide train the two models; the rest are
    allowed if their score reaches the threshold.  Null or malformed URLs have no text to score:
    they get a null score and are allowed.  Repeated rows come out as often as they come in and
    count as often in training; an empty table gives no rows; other columns are not read.
    """
    u = F.col(url)
    p = pages.select(F.col(page_id).alias("__id"), url_host(u).alias("host"), url_path(u).alias("path"),
                     F.regexp_extract(F.coalesce(u, F.lit("")), r"(?s)^.*?://(.*)$", 1).alias("__s"))
    p = written(p.withColumn("__r", rule_column(F.col("host"), F.col("path"), rules)).select(
        "__id", "host", "path", "__s", F.col("__r.text").alias("rule"), F.col("__r.verdict").alias("__v")))
    text = p.where("__s != ''")
    train = F.pmod(F.xxhash64("__s"), F.lit(HELD_OUT)) != 0
    scores = score_urls(text, train & (F.col("__v") == "allow"), train & (F.col("__v") == "block"))
    held = text.where("__v is not null").where(~train).join(sized(scores), "__s") \
        .select("score", (F.col("__v") == "allow").alias("ok"))
    threshold = calibrated(held)
    judged = F.when(F.coalesce(F.col("score") >= threshold, F.lit(True)), "allow").otherwise("block")
    return p.join(sized(scores), "__s", "left").select(
        F.col("__id").alias(page_id), "host", "path", "rule", F.coalesce("__v", judged).alias("verdict"), "score")
