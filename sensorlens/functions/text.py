"""Labels, indicators and colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts and colours shown next to a point.
INDIVIDUAL_TEXT = " ● Individual"
MULTIVARIATE_TEXT = " ● Multivariate"
INDIVIDUAL_COLOR = "FireBrick"
MULTIVARIATE_COLOR = "Orange"


def joined(*parts: Column | str) -> Column:
    """Concatenation that reads a missing part as empty text. Plain strings are literals."""
    texts = [
        F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(""))
        for p in parts
    ]
    return F.concat(*texts)


def asset_label() -> Column:
    """``ID: code - type (maker - model)``"""
    return joined(
        F.col("AssetID"), ": ", F.col("AssetCode"), " - ", F.col("AssetType"),
        " (", F.col("Manufacturer"), " - ", F.col("Model"), ")",
    )


def tag_label() -> Column:
    """``tag (metric)``"""
    return joined(F.col("tag"), " (", F.col("metric"), ")")


def _flagged(flag: Column) -> Column:
    return F.coalesce(flag != 0, F.lit(False))


def _positive(severity: Column) -> Column:
    return F.coalesce(severity > 0, F.lit(False))


def anomaly_indicator(flag: Column, mv: Column) -> Column:
    """Which detectors fired: the single-sensor flag, the multi-sensor severity, both, or ''."""
    return F.concat(
        F.when(_flagged(flag), F.lit(INDIVIDUAL_TEXT)).otherwise(F.lit("")),
        F.when(_positive(mv), F.lit(MULTIVARIATE_TEXT)).otherwise(F.lit("")),
    )


def marker_color(
    flag: Column, mv: Column, value: Column | None = None, strict_reference: bool = False
) -> Column:
    """Point colour. ``strict_reference`` colours an individual anomaly only when its reading is
    positive, which leaves flagged negative readings uncoloured."""
    individual = _flagged(flag)
    if strict_reference:
        if value is None:
            raise ValueError("strict_reference needs the reading")
        individual = individual & _positive(value)
    return (
        F.when(individual, F.lit(INDIVIDUAL_COLOR))
        .when(_positive(mv), F.lit(MULTIVARIATE_COLOR))
        .otherwise(F.lit(""))
    )


def safe_cast(value: Column, to: str) -> Column:
    """Cast that gives null for text that does not parse."""
    if to == "timestamp":
        return F.try_to_timestamp(value.cast("string"))
    return value.try_cast(to)


def pair_filter(left: Column, right: Column) -> Column:
    """Keeps each unordered pair once, and the diagonal; compares text by bytes."""
    return left <= right
