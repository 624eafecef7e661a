"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints link when at most ``max_distance`` = d bits differ. Every distinct
fingerprint emits all its variants within half that radius; linked fingerprints then meet
at a variant half-way between them. Two facts keep the balls small without losing a link:

- Fingerprints an odd number of bits apart have different parity. Only those with an even
  number of ones emit the larger half (d+1)/2; the others emit (d-1)/2.
- Of the d bits that differ at the full odd distance, one half of the word holds (d+1)/2 or
  more. The outermost variants therefore flip bits of one half of the word only.

Variants are shuffled in packed blocks of a bounded number of variants. At a variant, any
fingerprint of the smaller radius is within d of all others there: it is the centre, and
the others link to it, so m fingerprints give m-1 links, not all pairs. Links are verified
by counting bits and de-duplicated; components follow by star rounds (``components``).

Texts without words have fingerprint 0. Null texts count as empty. Rows without an id take
part; a component's id is its smallest id, null when none of its rows has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.llm.components import components
from pairwarden.llm.repeats import mixed
from pairwarden.llm.tables import cuts, narrow, power_of_two, record, rows_of, whole_rows
from pairwarden.session import stage

SEED = 42
_STEP = 512  # fingerprints expanded at once
_BUCKET_VARIANTS = 1 << 20
_MOST_TASKS = 10_000  # that emit variants; a task emits more for a larger table


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of the XXH64 of all word shingles (UTF-8), A-Z lower-cased; 0 without words."""
    words = text.lower().split()  # of bytes: ASCII white space and A-Z only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1]
        of = xxhash.xxh64_intdigest
        hashes = [of(joined[a:b], SEED) for a, b in
                  zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [fingerprint(text, shingle) for _, text in rows_of([batch])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(own, np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    return narrow(docs).mapInArrow(take, "doc_id long, fp long")


@lru_cache
def masks(max_distance: int, odd: bool) -> np.ndarray:
    """Bits that a fingerprint of odd (even) parity flips, inner radii first."""
    inner = max_distance // 2
    flips = [c for r in range(inner + 1) for c in combinations(range(64), r)]
    if max_distance % 2 and not odd:
        flips += [c for half in (range(32), range(32, 64)) for c in combinations(half, inner + 1)]
    return np.array([sum(1 << b for b in c) for c in flips], np.uint64)


def _emit(max_distance: int, buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            odd = np.bitwise_count(fps) % 2 == 1
            for parity in (True, False):
                flips = masks(max_distance, parity)
                own = fps[odd == parity]
                for at in range(0, len(own), _STEP):
                    block = own[at : at + _STEP]
                    variants = (block[:, None] ^ flips[None, :]).ravel()
                    which = np.tile(np.arange(len(flips), dtype=np.uint16), len(block))
                    bucket = (mixed(variants) >> np.uint64(32)).astype(np.int64) & (buckets - 1)
                    order = np.argsort(bucket, kind="stable")
                    variants, which, bucket = variants[order], which[order], bucket[order]
                    ends = cuts(bucket)
                    parts = list(zip(ends, ends[1:], strict=False))
                    yield record(
                        ["bucket", "variants", "flips"],
                        [bucket[ends[:-1]], [variants[a:b].tobytes() for a, b in parts],
                         [which[a:b].tobytes() for a, b in parts]],
                        [pa.int64(), pa.binary(), pa.binary()],
                    )

    return emit


def _meet(max_distance: int):
    """One bucket (a bounded number of variants): links between fingerprints that meet."""
    inner = len(masks(max_distance, True))

    def meet(group: pa.Table) -> pa.Table:
        variants = np.frombuffer(b"".join(group.column("variants").to_pylist()), np.uint64)
        flips = np.frombuffer(b"".join(group.column("flips").to_pylist()), np.uint16)
        order = np.argsort(variants)
        variants = variants[order]
        same = variants[1:] == variants[:-1]
        wanted = np.flatnonzero(np.r_[same, False] | np.r_[False, same])  # few: variants that meet
        variants, flips = variants[wanted], flips[order[wanted]]
        size = np.diff(cuts(variants))
        place = np.repeat(np.arange(len(size)), size)
        fps = variants ^ masks(max_distance, False)[flips]
        # centre: the entry with the fewest flipped bits at each variant, if it is of the inner radius
        order = np.lexsort((flips, place))
        fps, flips, place = fps[order], flips[order], place[order]
        start = cuts(place)[:-1]
        centre = np.zeros(place[-1] + 1 if len(place) else 0, np.int64)
        centre[place[start]] = start
        middle = centre[place] if len(place) else np.zeros(0, np.int64)
        a, b = fps[middle], fps
        linked = (flips[middle] < inner) & (a != b) & (np.bitwise_count(a ^ b) <= max_distance)
        pairs = np.unique(np.stack([a[linked], b[linked]]), axis=1)
        return pa.table({"a": pairs[0].view(np.int64), "b": pairs[1].view(np.int64)})

    return meet


def links(distinct: DataFrame, max_distance: int = 3) -> DataFrame:
    """Links (a, b) that connect whatever is within ``max_distance`` bits; ``distinct`` holds fp once each."""
    n = distinct.count()
    per_fp = (len(masks(max_distance, True)) + len(masks(max_distance, False))) / 2
    buckets = power_of_two(n * per_fp / _BUCKET_VARIANTS, 8, 1 << 32)
    tasks = min(buckets, _MOST_TASKS)  # a staged table has few files
    return (
        distinct.select("fp").repartition(tasks, "fp")
        .mapInArrow(_emit(max_distance, buckets), "bucket long, variants binary, flips binary")
        .groupBy("bucket")
        .applyInArrow(_meet(max_distance), "a long, b long")
        .distinct()
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest id reachable) of every row."""
    return _grouped(docs, shingle, max_distance).drop("root")


def _grouped(docs: DataFrame, shingle: int, max_distance: int) -> DataFrame:
    """The same, and the component's root, a fingerprint."""
    marked = stage(fingerprints(docs, shingle), "fingerprints")
    classes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    grouped = components(links(classes, max_distance))
    rooted = stage(
        classes.join(grouped, classes["fp"] == grouped["node"], "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    lowest = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "lowest")
    answer = stage(rooted.join(lowest, "root").select("fp", "component_id", "root"), "answer")
    return marked.join(answer, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root"
    )


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """The rows of ``docs`` (all its columns) with the smallest id of each component.

    A component without any id keeps one of its rows; of rows that share the smallest id, one stays.
    """
    text = F.col("text").cast("string")
    found = _grouped(docs, shingle, max_distance)
    # one (id, fingerprint) per component: the smallest id, of its fingerprints the smallest
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("doc_id").alias("_keep_id"), F.min("fingerprint").alias("_keep_fp"), F.count("*").alias("_rows")
    )
    kept = stage(kept.drop("root"), "kept")
    marked = whole_rows(docs, _id=F.col("doc_id").cast("long"), _fp=_fingerprint_column(shingle)(text))
    joined = marked.join(kept, F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_fp") == F.col("_keep_fp")))
    if not kept.filter("_rows > 1").isEmpty():  # repeated ids
        joined = joined.dropDuplicates(["_keep_id", "_keep_fp"])
    return joined.select("_doc.*")


def _fingerprint_column(shingle: int):
    @F.arrow_udf("string")
    def take(texts: pa.Array) -> pa.Array:
        own = [f"{fingerprint(t or b'', shingle):016x}" for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(own, pa.string())

    return take
