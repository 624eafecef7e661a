"""Scalar building blocks: hashes, cleaning, routing, labels, text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def row_hash(cols: Sequence[str]) -> Column:
    """Fingerprint of a row as text; the rule id is not part of it."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]))


def event_kind(col: str) -> Column:
    """``packet`` for ids that start with H, ``log`` for L, else NULL."""
    return F.when(F.col(col).startswith("H"), "packet").when(F.col(col).startswith("L"), "log")


def maker(col: str) -> Column:
    """Maker code at characters 14-15 of a device id."""
    return F.when(F.substring(col, 14, 2) == "GE", "GE").otherwise("ABB")


def any_nonempty(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where at least one column is neither NULL nor empty."""
    filled = [F.coalesce(F.col(c), F.lit("")) != "" for c in cols]
    return df.filter(reduce(lambda a, b: a | b, filled))


def exclude_patterns(df: DataFrame, col: str, patterns: Sequence[str]) -> DataFrame:
    """Drop rows whose ``col`` matches any regular expression (``.`` is any character).

    A NULL is not a match and is dropped too, as a comparison with False would.
    """
    hit = reduce(lambda a, b: a | b, [F.col(col).rlike(p) for p in patterns])
    return df.filter(~hit)


# Texts that stand for a missing reading. "True" becomes 0 as well.
CLEANED_TEXTS = ("False", "null", "True")


def clean_value(col: str, texts: Sequence[str] = CLEANED_TEXTS) -> Column:
    """Sensor text to number; any other unparsable text is an error."""
    return F.when(F.col(col).isin(*texts), "0").otherwise(F.col(col)).cast("double")


def pair_key(a: str, b: str) -> Column:
    return F.concat_ws(",", F.col(a).cast("string"), F.col(b).cast("string"))


def text_of(cols: Sequence[str]) -> Column:
    """One text per row; a NULL column becomes a comma, columns are joined by commas."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit(",")) for c in cols])


def site(col: Column) -> Column:
    """First two underscore parts of an id."""
    return F.slice(F.split(col, "_"), 1, 2)


def different_site(a: str, b: str) -> Column:
    return (site(F.col(a)) != site(F.col(b))) & (F.col(a) != F.col(b))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a result schema."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def fill_missing(df: DataFrame, fills: Mapping[str, object], blanks: Sequence[str] = ()) -> DataFrame:
    """Replace NULL per column; in ``blanks`` the text ``nan`` also becomes a space."""
    out = df.na.fill(dict(fills)) if fills else df
    for c in blanks:
        filled = F.coalesce(F.col(c), F.lit(" "))
        out = out.withColumn(c, F.when(filled == "nan", " ").otherwise(filled))
    return out


def cross_kind(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("f_type") != F.col("b_type"))


def label_by_rule(df: DataFrame, rule: str = "corr", label: str = "ai_label") -> DataFrame:
    """Label follows the multi-rule id: True when it is non-zero, else False."""
    return df.withColumn(label, F.coalesce(F.col(rule) != 0, F.lit(False)))


def demote(df: DataFrame, col: str, threshold: float, label: str = "ai_label") -> DataFrame:
    """Label becomes False at or under the threshold, which is stored with the row."""
    return df.withColumn(
        label, F.when(F.col(col) <= threshold, F.lit(False)).otherwise(F.col(label))
    ).withColumn("threshold", F.lit(float(threshold)))


def row_product(cols: Sequence[str]) -> Column:
    values = F.array(*[F.col(c).cast("double") for c in cols])
    return F.aggregate(values, F.lit(1.0), lambda acc, x: acc * x)


def route_by_prefix(df: DataFrame, col: str, prefixes: Sequence[tuple]) -> DataFrame:
    """Attach unit type and ids by the first matching prefix; drop rows without one.

    ``prefixes`` holds (prefix, unit_type, unit_id, operate_info_id) settings.
    """
    route = F.lit(None).cast("struct<unit_type:string,unit_id:string,operate_info_id:string>")
    for prefix, unit_type, unit_id, operate_id in reversed(list(prefixes)):
        target = F.struct(
            F.lit(unit_type).alias("unit_type"),
            F.lit(unit_id).alias("unit_id"),
            F.lit(operate_id).alias("operate_info_id"),
        )
        route = F.when(F.col(col).startswith(prefix), target).otherwise(route)
    return df.withColumn("_route", route).filter("_route is not null").select(
        *df.columns, "_route.*"
    )
