"""Rule columns: polarity labels, trends, tone words and emoji."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def polarity_label(score: Column | str, pos: float = 0.05, neg: float = -0.05) -> Column:
    """Inclusive thresholds -> positive / negative / neutral."""
    s = _c(score)
    return (F.when(s >= pos, "positive").when(s <= neg, "negative").otherwise("neutral"))


def trend_label(shift: Column | str, threshold: float = 0.1) -> Column:
    """Strict +-0.1 on the within-session shift."""
    s = _c(shift)
    return F.when(s > threshold, "improving").when(s < -threshold, "deteriorating").otherwise("stable")


def tone_description(score: Column | str) -> Column:
    """Seven levels, strict comparisons (0.05 itself is 'slightly positive')."""
    s = _c(score)
    return (F.when(s > 0.5, "very positive").when(s > 0.05, "positive")
            .when(s > 0, "slightly positive").when(s == 0, "neutral")
            .when(s > -0.05, "slightly negative").when(s > -0.5, "negative")
            .otherwise("very negative"))


def label_emoji(label: Column | str) -> Column:
    """Emoji for a polarity label."""
    lab = _c(label)
    return F.when(lab == "positive", "😊").when(lab == "neutral", "😐").otherwise("😔")


def change_level(change: Column | str) -> Column:
    """Five levels of first-to-last change at +-0.2 and +-0.05."""
    c = _c(change)
    return (F.when(c > 0.2, "significant improvement").when(c > 0.05, "moderate improvement")
            .when(c < -0.2, "significant decline").when(c < -0.05, "moderate decline")
            .otherwise("relatively stable"))


def fixed(value: Column | str, digits: int) -> Column:
    """Fixed-point text with ``digits`` decimals, rounded half-up on the decimal value.

    The double is first cast to decimal(38,10) so that last-bit noise from a
    different summation order cannot move a value across a .xx5 tie.
    """
    v = _c(value).cast("decimal(38,10)")
    return F.round(v, digits).cast(f"decimal(38,{digits})").cast("string")
