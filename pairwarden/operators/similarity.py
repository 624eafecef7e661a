"""Token-count cosine similarity inside buckets.

Rows with the same words in the same numbers ("bag") are collapsed first, so a
group of copies is compared once. The bags of a bucket are cut into blocks, which meet pairwise
in cells; a cell is compared by products of matrices (``dots``), and only what exceeds the bound
leaves it. At a high bound sketches of bags are compared first, and bags that are near to no other
are left out before their words are repeated. Small buckets share a cell. So no task holds more than two blocks, and pairs that are
not links are never written or shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from pairwarden.operators.dots import by_cell, count_links, sketch, write_links, write_near
from pairwarden.operators.features import tokens_of
from pairwarden.operators.lookup import lookup_join
from pairwarden.session import ship_package, stage

BLOCK_BAGS = 8192
BLOCK_CHARS = 1 << 25  # of the words of a block
SMALL_CHARS, SMALL_BAGS = 1 << 22, 1 << 14  # of the small buckets of a cell
SKETCH_FROM = 0.8  # bounds at which sketches leave most rows out
SKETCH_BLOCKS = 4  # blocks of words that make one of sketches


@dataclass(frozen=True)
class Similar:
    """``members``: each row with its bag. ``pairs``: two bags and their similarity.

    Both together are the whole result: two rows are as similar as their bags, and
    rows of one bag have similarity 1.
    """

    members: DataFrame
    pairs: DataFrame


def _meet(
    frame: DataFrame, keys: Sequence[str], one: str, values: Sequence[str], block: int
) -> DataFrame:
    """Pairs (a, b) of different ``one`` that share ``keys``, each once.

    The rows of a frequent key are cut into blocks and go to the cells (own block,
    other block) of a triangle; a key with a single block is not repeated.
    """
    frequent = stage(
        frame.groupBy(*keys).agg(
            F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("_blocks")
        ).filter("_blocks > 1"),
        "frequent",
    )
    cut = (
        lookup_join(frame, frequent, list(keys), "left")
        .withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
        .withColumn("_own", F.pmod(F.xxhash64(one), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)")))
        .withColumn("_row", F.least("_own", "_other"))
        .withColumn("_col", F.greatest("_own", "_other"))
    )
    cell = [*keys, "_row", "_col"]
    left, right = (
        cut.filter(F.col("_own") == F.col(edge)).select(
            *cell, F.col(one).alias(name), *[F.col(v).alias(f"{name}_{v}") for v in values]
        )
        for edge, name in (("_row", "a"), ("_col", "b"))
    )
    # within a block both orders meet, across blocks only one does
    return left.join(right, cell).filter((F.col("_row") != F.col("_col")) | (F.col("a") < F.col("b")))


def bag_rows(df: DataFrame, text: str, asked: Column | None = None) -> DataFrame:
    """Rows with their ``bag`` and its ``_words`` in place of the text; without words both are NULL.

    Staged, so that every text is tokenised once. ``_asked``: the rows for which ``asked`` holds, else all.
    """
    marked = df.withColumn("_asked", F.lit(True) if asked is None else F.coalesce(asked, F.lit(False)))
    words = F.array_join(F.sort_array(tokens_of(text)), " ")
    rows = marked.withColumn("_words", words).drop(text).withColumn("_words", F.when(F.col("_words") != "", F.col("_words")))
    return stage(rows.withColumn("bag", F.unhex(F.sha2("_words", 256))), "bags")


def _bucket_sizes(rows: DataFrame, bucket: Sequence[str], block: int, length: Column) -> DataFrame:
    """Number (``_bucket``), rows, letters and blocks of each bucket with an asked row; the
    bags of a bucket are counted only where its rows are more than a block."""
    counted = rows.groupBy(*bucket).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(length).alias("_chars"), F.bool_or("_asked").alias("_any")
    ).filter("_any").drop("_any")
    counted = stage(counted.withColumn("_bucket", F.monotonically_increasing_id()), "buckets")
    large = (F.col("_n") > block) | (F.col("_chars") > BLOCK_CHARS)
    kept = lookup_join(rows.select(*bucket, "bag", length.alias("_l")), counted.filter(large).select(*bucket), list(bucket))
    exact = kept.groupBy(*bucket, "bag").agg(F.max("_l").alias("_l")).groupBy(*bucket).agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(block)), F.ceil(F.sum("_l") / F.lit(BLOCK_CHARS))).alias("_blocks"))
    blocks = F.coalesce("_blocks", F.lit(1)).cast("int")
    return stage(lookup_join(counted, exact, list(bucket), "left").withColumn("_blocks", blocks), "bucket-sizes")


_KEYS = ["_k0", "_k1", "_k2"]  # of a cell


def _in_cells(
    bags: DataFrame, sizes: DataFrame, bucket: Sequence[str], asked: bool, read: Sequence[str], ends: Sequence[str]
) -> DataFrame:
    """Bags in their cells, a cell side by side in one partition, with what is ``read`` to compare them.

    Bags go to the cells (own block, other block) of a triangle; when asked, the asked ones go
    to all blocks and the others stay where they are.
    """
    spark = bags.sparkSession
    small = F.col("_blocks") == 1
    total = sizes.agg(
        F.sum(F.when(small, F.col("_chars"))).alias("chars"), F.sum(F.when(small, F.col("_n"))).alias("bags"),
        F.sum(F.when(~small, F.col("_blocks") if asked else F.col("_blocks") * (F.col("_blocks") + 1) / 2)).alias("cells"),
    ).first()
    shared = 1 + int(max((total.chars or 0) / SMALL_CHARS, (total.bags or 0) / SMALL_BAGS))
    cells = shared + int(total.cells or 0)

    own = F.pmod(F.xxhash64("bag"), F.col("_blocks")).cast("int")
    placed = lookup_join(bags, sizes.drop("_n", "_chars"), list(bucket)).withColumn("_own", own)
    every = F.expr("sequence(0, _blocks - 1)")
    if asked:
        placed = placed.withColumn("_row", F.explode(F.when(F.col("_asked"), every).otherwise(F.array("_own"))))
        placed = placed.withColumn("_col", F.lit(0))
        sides = {"_left": F.col("_asked"), "_right": F.col("_row") == F.col("_own"), "_ordered": F.col("_asked")}
    else:
        placed = placed.withColumn("_other", F.explode(every)).withColumn("_row", F.least("_own", "_other"))
        placed = placed.withColumn("_col", F.greatest("_own", "_other"))
        same = F.col("_row") == F.col("_col")
        sides = {"_left": F.col("_row") == F.col("_own"), "_right": F.col("_col") == F.col("_own"), "_ordered": same}
    placed = placed.withColumns(sides)
    keys = {
        "_k0": F.when(small, F.lit(-1).cast("long")).otherwise(F.col("_bucket")),
        "_k1": F.when(small, F.pmod(F.xxhash64("_bucket"), F.lit(shared))).otherwise(F.col("_row")).cast("long"),
        "_k2": F.when(small, F.lit(0)).otherwise(F.col("_col")).cast("long"),
    }
    dealt = placed.withColumns(keys).select(*keys, "_bucket", *sides, *read, *bucket, *ends)
    tasks = max(1, min(3 * cells, 16 * spark.sparkContext.defaultParallelism))
    return dealt.repartition(tasks, *keys).sortWithinPartitions(*keys)


def _near_bags(rows: DataFrame, bucket: Sequence[str], min_sim: float, block: int, asked: bool) -> DataFrame:
    """Bags whose sketch is near to another one of the bucket. Only sketches are repeated in
    cells: they are smaller than words, and blocks of them larger."""
    made = F.arrow_udf(sketch, BinaryType())
    bags = stage(
        rows.select(*bucket, "bag", "_asked", made("_words").alias("_sketch")).groupBy(*bucket, "bag").agg(
            F.any_value("_sketch").alias("_sketch"), F.bool_or("_asked").alias("_asked")), "sketches")
    sizes = _bucket_sizes(bags, bucket, SKETCH_BLOCKS * block, F.lit(0))
    cells = _in_cells(bags, sizes, bucket, asked, ["_sketch"], ["bag"])
    out = StructType([f for f in bags.schema.fields if f.name in [*bucket, "bag"]])
    work = partial(write_near, ends=out.names, min_sim=min_sim)
    return stage(cells.mapInArrow(partial(by_cell, keys=_KEYS, work=work), out).distinct(), "near")


def _bag_cells(
    rows: DataFrame, bucket: Sequence[str], min_sim: float, block: int, asked: bool, carry: Mapping[str, Column]
) -> DataFrame:
    """Cells of the bags that may have a link over ``min_sim``."""
    ship_package(rows.sparkSession)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*bucket, "bag"]])
    rows, read = rows.filter(known), ["_words"]
    if min_sim >= SKETCH_FROM:
        rows = lookup_join(rows, _near_bags(rows, bucket, min_sim, block, asked), [*bucket, "bag"], "left_semi")
    sizes = _bucket_sizes(rows, bucket, block, F.length("_words"))
    bags = rows.groupBy(*bucket, "bag").agg(
        F.any_value("_words").alias("_words"), F.bool_or("_asked").alias("_asked"),
        *[agg.alias(c) for c, agg in carry.items()],
    )
    if min_sim >= SKETCH_FROM:
        bags, read = bags.withColumn("_sketch", F.arrow_udf(sketch, BinaryType())("_words")), ["_words", "_sketch"]
    return _in_cells(bags, sizes, bucket, asked, read, ["bag", *carry])


def _links_of(
    cells: DataFrame, bucket: Sequence[str], min_sim: float, ends: Sequence[str], apart: tuple[str, str] | None = None
) -> DataFrame:
    field = {f.name: f.dataType for f in cells.schema.fields}
    out = [StructField(c, field[c]) for c in bucket]
    out += [StructField(f"{s}_{c}", field[c]) for s in "ab" for c in ends]
    work = partial(write_links, same=list(bucket), sides=list(ends), min_sim=max(0.0, float(min_sim)), apart=apart)
    return cells.mapInArrow(partial(by_cell, keys=_KEYS, work=work), StructType([*out, StructField("sim", DoubleType())]))


def _degrees_of(cells: DataFrame, bucket: Sequence[str], min_sim: float, apart: tuple[str, str]) -> DataFrame:
    field = {f.name: f.dataType for f in cells.schema.fields}
    out = StructType([*[StructField(c, field[c]) for c in [*bucket, "bag"]], StructField("_links", LongType())])
    work = partial(count_links, same=list(bucket), apart=apart, min_sim=max(0.0, float(min_sim)))
    counted = cells.mapInArrow(partial(by_cell, keys=_KEYS, work=work), out)
    return counted.groupBy(*bucket, "bag").agg(F.sum("_links").alias("n_links"))


def bag_links(
    rows: DataFrame, bucket: Sequence[str], min_sim: float, block: int = BLOCK_BAGS, asked: bool = False,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Pairs of bags of a bucket over ``min_sim``, each once: bucket, ``a_*``, ``b_*``, ``sim``.

    ``carry`` names what else is known of a bag, aggregated over its rows. With ``asked`` one bag of each pair
    is that of an asked row.
    """
    carry = carry or {}
    return _links_of(_bag_cells(rows, bucket, min_sim, block, asked, carry), bucket, min_sim, ["bag", *carry])


def bag_degrees(
    rows: DataFrame, bucket: Sequence[str], min_sim: float, apart: str, block: int = BLOCK_BAGS
) -> DataFrame:
    """Bags with the number of links (``n_links``) that they have over ``min_sim``: as many rows as bags.

    Only links between bags whose rows have two values of ``apart`` count.
    """
    ends = {"_lo": F.min(apart), "_hi": F.max(apart)}
    return _degrees_of(_bag_cells(rows, bucket, min_sim, block, False, ends), bucket, min_sim, ("_lo", "_hi"))


def named_links(
    rows: DataFrame, bucket: Sequence[str], min_sim: float, name: Column, apart: str, block: int = BLOCK_BAGS
) -> tuple[DataFrame, DataFrame]:
    """Links of ``bag_links`` between ``name`` of both bags (``a_name``, ``b_name``), and ``bag_degrees``.

    Only links between bags whose rows have two values of ``apart``. The bags are compared once for each of
    the two frames, so that the links, which may be far more than the bags, go nowhere but to the caller.
    """
    ends = {"name": name, "_lo": F.min(apart), "_hi": F.max(apart)}
    cells, several = _bag_cells(rows, bucket, min_sim, block, False, ends), ("_lo", "_hi")
    return _links_of(cells, bucket, min_sim, ["name"], several), _degrees_of(cells, bucket, min_sim, several)


def similar_bags(
    df: DataFrame,
    bucket: Sequence[str],
    text: str,
    min_sim: float = 0.0,
    block: int = BLOCK_BAGS,
    asked: Column | None = None,
) -> Similar:
    """Bags of a bucket with cosine similarity over ``min_sim`` and the rows in them.

    With ``asked``, a condition on rows, only pairs with the bag of such a row are looked for.
    For ``min_sim`` = 0 every shared word counts.
    """
    rows = bag_rows(df, text, asked)
    links = bag_links(rows, bucket, min_sim, block, asked is not None, {})
    pairs = links.select(*bucket, F.least("a_bag", "b_bag").alias("a"), F.greatest("a_bag", "b_bag").alias("b"), "sim")
    return Similar(rows.drop("_words", "_asked"), pairs)


def similar_classes(
    df: DataFrame,
    bucket: Sequence[str],
    row_id: str,
    text: str,
    min_sim: float = 0.0,
    block: int = BLOCK_BAGS,
    asked: Column | None = None,
) -> DataFrame:
    """The same result in a space that grows with the rows: bucket, ``f_id``, ``b_id``, ``sim``.

    With ``asked``, a condition on ``row_id`` and ``bucket``, it is a search: links are those of
    classes that hold such a row, with all others.

    Rows with the same words are one class, named by its smallest ``row_id``. Each other
    row of a class is linked to that one (similarity 1), and similar classes are linked by
    their names; two rows are as similar as their classes.
    """
    rows = bag_rows(df.select(*bucket, row_id, text), text, asked)
    links = bag_links(rows, bucket, min_sim, block, asked is not None, {"_name": F.min(row_id)})
    linked = links.select(
        *bucket, F.least("a__name", "b__name").alias("f_id"), F.greatest("a__name", "b__name").alias("b_id"), "sim"
    )
    if min_sim >= 1:
        return linked
    named = rows.filter("bag is not null").groupBy(*bucket, "bag").agg(
        F.min(row_id).alias("_name"), F.count(F.lit(1)).alias("_n")
    ).filter("_n > 1").drop("_n")
    members = rows.select(*bucket, row_id, "bag").join(named, [*bucket, "bag"]).filter(F.col(row_id) != F.col("_name"))
    return members.select(
        *bucket, F.col("_name").alias("f_id"), F.col(row_id).alias("b_id"), F.lit(1.0).alias("sim")
    ).unionByName(linked)


def similar_pairs(
    df: DataFrame,
    bucket: Sequence[str],
    row_id: str,
    cols: Sequence[str],
    text: str,
    min_sim: float = 0.0,
    block: int = BLOCK_BAGS,
    apart: Column | None = None,
) -> DataFrame:
    """Pairs of rows of a bucket with similarity over ``min_sim``, each pair once.

    ``cols`` come out as ``f_*`` and ``b_*``, the smaller ``row_id`` in front. The
    result holds every such pair of rows; ``similar_bags`` gives the same in less
    space where many rows are copies of each other. With ``apart``, a value of a row, copies
    are met only where they have two values of it; the caller drops the other pairs of such copies.
    """
    found = similar_bags(df, bucket, text, min_sim, block)
    fields = list(dict.fromkeys([row_id, *cols]))
    members = stage(
        found.members.select(*bucket, "bag", F.struct(*fields).alias("r"), F.col(row_id).alias("_id"),
            *([] if apart is None else [apart.alias("_apart")]),
        ),
        "members",
    )
    met = (
        found.pairs.join(members.select(*bucket, F.col("bag").alias("a"), F.col("r").alias("a_r")), [*bucket, "a"])
        .join(members.select(*bucket, F.col("bag").alias("b"), F.col("r").alias("b_r")), [*bucket, "b"])
        .select(*bucket, "a_r", "b_r", "sim")
    )
    if min_sim < 1:
        if apart is not None:
            both = members.groupBy(*bucket, "bag").agg(F.min("_apart").alias("_lo"), F.max("_apart").alias("_hi"))
            both = both.filter("_lo <> _hi").select(*bucket, "bag")
            members = stage(members.drop("_apart").join(both, [*bucket, "bag"], "left_semi"), "copies")
        copies = _meet(members, [*bucket, "bag"], "_id", ["r"], block)
        met = met.unionByName(copies.select(*bucket, "a_r", "b_r", F.lit(1.0).alias("sim")))
    swap = F.col(f"a_r.{row_id}") > F.col(f"b_r.{row_id}")
    out = met.select(
        *bucket,
        F.when(swap, F.col("b_r")).otherwise(F.col("a_r")).alias("f"),
        F.when(swap, F.col("a_r")).otherwise(F.col("b_r")).alias("b"),
        "sim",
    )
    return out.select(
        *bucket,
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("f", "b") for c in cols],
        "sim",
    )
