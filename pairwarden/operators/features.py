"""One-hot encoding, balancing and replication, token counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwarden.operators.lookup import lookup_join
from pairwarden.operators.ordering import number_rows
from pairwarden.session import stage

BROADCAST_VALUES = 100_000

MISSING = "nan"  # category of a missing value


def _text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(MISSING))


@dataclass(frozen=True)
class OneHot:
    """Vocabulary of listed columns: (column, value, position), positions from 0.

    ``values`` is the number of categories of each column, ``size`` of all.
    """

    cols: tuple[str, ...]
    vocab: DataFrame
    values: tuple[int, ...]

    @property
    def size(self) -> int:
        return sum(self.values)


def onehot_fit(df: DataFrame, cols: Sequence[str]) -> OneHot:
    """Categories of each column sorted as text; missing values are a category."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), _text(c).alias("value"))
                  for i, c in enumerate(cols)])
    )
    found = df.select(cells.alias("c")).select("c.*").distinct()
    numbered, _ = number_rows(found, ["place", "value"], "position")
    vocab = stage(numbered.select("column", "value", "position"), "vocabulary")
    sizes = {r["column"]: r["count"] for r in vocab.groupBy("column").count().collect()}
    return OneHot(tuple(cols), vocab, tuple(sizes.get(c, 0) for c in cols))


def onehot_apply(model: OneHot, df: DataFrame, name: str = "positions") -> DataFrame:
    """Positions of the ones of each row; an unknown value sets none."""
    out = df
    for i, c in enumerate(model.cols):
        words = model.vocab.filter(F.col("column") == c).select(
            F.col("value").alias(f"_v{i}"), F.col("position").alias(f"_p{i}")
        )
        if model.values[i] <= BROADCAST_VALUES:  # a size known from the fit: a hot value stays where it is
            words = F.broadcast(words)
        out = out.withColumn(f"_v{i}", _text(c)).join(words, f"_v{i}", "left")
    places = F.array(*[F.col(f"_p{i}") for i in range(len(model.cols))])
    return out.withColumn(name, F.filter(places, lambda p: p.isNotNull())).select(*df.columns, name)


_BLOCK = 4096


def replicate(df: DataFrame, copies) -> DataFrame:
    """Each row ``copies`` times (a number or a column name).

    Copies are made in blocks that are spread over the tasks, so one row with very
    many copies does not end up in one of them.
    """
    if isinstance(copies, int) and copies <= _BLOCK:
        return df.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_k")
    count = F.lit(copies) if isinstance(copies, int) else F.col(copies)
    blocks = df.withColumn("_n", count.cast("long")).filter("_n > 0").withColumn(
        "_block", F.explode(F.expr(f"sequence(0L, (_n - 1) div {_BLOCK})"))
    )
    left = F.least(F.lit(_BLOCK).cast("long"), F.col("_n") - F.col("_block") * _BLOCK)
    return (
        blocks.repartition("_block", F.xxhash64(*df.columns))
        .withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), left)))
        .select(*df.columns)
    )


def _hashed_draw(seed: int, key: Sequence[str]) -> Column:
    """Number of draw ``_k`` of a pattern: the first 60 bits of md5(seed|key|k), key values joined by ','."""
    text = F.concat_ws("|", F.lit(str(seed)), F.concat_ws(",", *[_text(c) for c in key]), F.col("_k").cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def draw_with_replacement(patterns: DataFrame, key: Sequence[str], top: int, seed: int) -> DataFrame:
    """How often each place of a pattern (``key``, ``_n`` places) is drawn in ``top`` draws: key, _place, _drawn.

    Draws are made in blocks that are spread over the tasks and counted where they are made, so
    neither a pattern's draws nor its rows are ever written out.
    """
    blocks = patterns.withColumn("_block", F.explode(F.expr(f"sequence(0L, ({top}L - 1) div {_BLOCK})")))
    first = F.col("_block") * _BLOCK + 1
    last = F.least(first + (_BLOCK - 1), F.lit(top).cast("long"))
    draws = blocks.repartition(*key, "_block").withColumn("_k", F.explode(F.sequence(first, last)))
    place = _hashed_draw(seed, key) % F.col("_n")
    return draws.groupBy(*key, place.alias("_place")).agg(F.count(F.lit(1)).alias("_drawn"))


def balance(
    df: DataFrame, key: Sequence[str], order: Sequence[str], keep_original: bool = False, seed: int | None = None
) -> DataFrame:
    """Balanced upsampling by pattern, as a ``copies`` column.

    The largest patterns are kept as they are; the rows of every other one are drawn up to
    that size. With a ``seed`` they are drawn with replacement: draw k of a pattern takes the row
    at place md5(seed, pattern, k) modulo the pattern's rows, in ``order``; some rows are
    drawn often, others never (0 copies). Without one they take turns: each as often as the
    next, the first ones in ``order`` once more to make up the rest.

    Draws stay counts: training weighs rows instead of storing copies, and ``replicate`` writes
    them out where rows are wanted. ``keep_original`` adds the rows themselves.
    """
    indexed, _ = number_rows(df, [*key, *order])
    patterns = stage(
        indexed.groupBy(*key).agg(F.min("idx").alias("_first"), F.count(F.lit(1)).alias("_n")), "patterns"
    )
    top = patterns.agg(F.max("_n")).first()[0] or 0
    sizes = lookup_join(indexed, patterns, list(key), null_safe=True).withColumn(
        "_place", F.col("idx") - F.col("_first")
    )
    if seed is None:
        turns = F.expr(f"{top}L div _n") + (F.col("_place") < F.expr(f"{top}L % _n")).cast("long")
    else:
        drawn = draw_with_replacement(patterns.filter(F.col("_n") < top), key, top, seed)
        sizes = lookup_join(sizes, stage(drawn, "draws"), [*key, "_place"], "left", null_safe=True)
        turns = F.coalesce("_drawn", F.lit(0).cast("long"))
    copies = F.when(F.col("_n") == top, F.lit(1)).otherwise(turns).cast("long")
    return sizes.withColumn("copies", copies + 1 if keep_original else copies).select(*df.columns, "copies")


def rule_space(spark: SparkSession, rule_ids: Sequence[int]) -> DataFrame:
    """Every 0/1 combination of the rules (columns ``r<id>``), first rule most significant.

    The combinations are a lazy, distributed range; their number fits a long up to 62 rules.
    """
    n = len(rule_ids)
    if n > 62:
        raise ValueError(f"2^{n} combinations do not fit a long")
    bits = [
        F.shiftright("id", n - 1 - i).bitwiseAND(1).cast("int").alias(f"r{r}")
        for i, r in enumerate(rule_ids)
    ]
    return spark.range(1 << n).select(*bits)


TOKEN = r"(?U)\w\w+"


def tokens_of(col: str) -> Column:
    """Lower-cased words of at least two characters."""
    return F.regexp_extract_all(F.lower(F.col(col)), F.lit(f"({TOKEN})"), F.lit(1))


def token_counts(df: DataFrame, ids: Sequence[str], text: str) -> DataFrame:
    """Count per row and token."""
    return (
        df.select(*ids, F.explode(tokens_of(text)).alias("token"))
        .groupBy(*ids, "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
