"""Substring de-duplication by level-wise doubling.

Windows of words that repeat in two documents or more are found level by level. A level
looks only at what the level before left: windows repeated at one length alone are
extended to twice that length (at most the wanted ``window``), until the wanted length is
reached or no candidates survive.

- At a level below the wanted length, a candidate window is represented by the smallest
  hash of the level's shorter windows inside it. Equal windows have equal smallest
  hashes, so a window whose smallest hash is in one document only cannot repeat. About a
  quarter of the positions are sent, as hashes (``repeats.twice_seen``).
- At the wanted length the survivors are told apart by two independent hashes of 64 bits over
  hashes of their words of two families; windows that agree in all 128 bits count as equal.
  They are pre-aggregated per task and meet in buckets, which name the first document of
  each. Only that *owner* hears about a window, so a passage that a third of all documents
  share is one answer.
- Every document then removes the surviving windows it does not own.

Words are separated by ASCII white space and compared unchanged. Null texts have no words.
Rows that share an id are the same document for the order. A missing id comes after all
others. Windows never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.llm.repeats import MAX_FILTER_BYTES, TwiceSeen, mixed, twice_seen
from pairwarden.llm.tables import NO_ID, cuts, narrow, power_of_two, rank, record, rows_of, text_bytes

WINDOW = 13
FIRST = 7
_WORD_BYTES = 6  # a guess for sizing filters and buckets only
_FLUSH_WINDOWS = 1 << 20
_BUCKET_BYTES = 16 << 20  # text per bucket


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def check_hashes(words: list[bytes]) -> np.ndarray:
    """A second family, which shares nothing with the first."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _first_of(h: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different windows (h, c), each with its smallest document."""
    order = np.lexsort((d, c, h))
    h, c, d = h[order], c[order], d[order]
    first = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])][: len(h)]
    return h[first], c[first], d[first]


def among(h: np.ndarray, c: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Which windows (h, c) are among the pairs (n x 2)."""
    order = np.argsort(pairs[:, 0], kind="stable")
    known, checks = pairs[order, 0], pairs[order, 1]
    low, high = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
    found = np.zeros(len(h), bool)
    for step in range(int((high - low).max(initial=0))):  # more than one: windows of one first hash
        at = low + step
        some = at < high
        found[some] |= checks[at[some]] == c[some]
    return found


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Order-sensitive hash of every ``length`` consecutive hashes, by doubling."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = 0x9E3779B97F4A7C15
    out, width, power = None, 0, factor  # power: factor ** (length of `part`)
    part, size = h, 1
    while True:
        if length >> (size.bit_length() - 1) & 1:
            out = part[:n] if out is None else out[:n] * np.uint64(power) + part[width : width + n]
            width += size
        size *= 2
        if size > length:
            return mixed(out)
        part = part[: len(part) - size // 2] * np.uint64(power) + part[size // 2 :]
        power = power * power % 2**64


def smallest(h: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` consecutive values, by doubling."""
    n, size = len(h) - span + 1, 1
    if n <= 0:
        return np.zeros(0, h.dtype)
    while 2 * size <= span:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:n], h[span - size : span - size + n])


class Survivors:
    """Candidate windows of a document after the levels so far."""

    def __init__(self, window: int):
        self.window, self.levels = window, []

    def anchors(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """For each wanted window, the smallest hash of its windows of ``length``."""
        return smallest(window_hashes(hashes, length), self.window - length + 1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the document's windows every level suspects."""
        alive = np.ones(max(0, len(hashes) - self.window + 1), bool)
        for length, seen in self.levels:
            if not alive.any():
                break
            tested = self.anchors(hashes, length)
            changed = np.r_[True, tested[1:] != tested[:-1]]
            alive &= seen(tested[changed])[np.cumsum(changed) - 1]
        return alive

    def hasher(self, length: int):
        """What the documents send at a level: smallest hashes of the windows still alive."""

        def send(text: bytes) -> np.ndarray:
            hashes = word_hashes(text.split())
            alive = self(hashes)
            return self.anchors(hashes, length)[alive] if alive.any() else np.zeros(0, np.uint64)

        return send

    def extended(self, length: int, seen: TwiceSeen) -> Survivors:
        longer = Survivors(self.window)
        longer.levels = [*self.levels, (length, seen)]
        return longer


def levels(first: int, window: int) -> list[int]:
    """Lengths below the wanted one, each twice the one before."""
    out = []
    while first < window:
        out.append(first)
        first *= 2
    return out


def _send_windows(alive: Survivors, buckets: int):
    """Per task: distinct surviving windows with their smallest document, by bucket."""

    def flush(hashes: list[np.ndarray], checks: list[np.ndarray], ranks: list[int]) -> pa.RecordBatch:
        d = np.repeat(np.array(ranks, np.int64), [len(x) for x in hashes])
        h, c, d = _first_of(np.concatenate(hashes), np.concatenate(checks), d)
        bucket = (h >> np.uint64(40)).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        bucket, h, c, d = bucket[order], h[order], c[order], d[order]
        ends = cuts(bucket)
        parts = list(zip(ends, ends[1:], strict=False))
        return record(
            ["bucket", "hashes", "checks", "docs"],
            [bucket[ends[:-1]], *[[x[a:b].tobytes() for a, b in parts] for x in (h, c, d)]],
            [pa.int32(), pa.binary(), pa.binary(), pa.binary()],
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, checks, ranks, held = [], [], [], 0
        for doc, text in rows_of(batches):
            split = text.split()
            words = word_hashes(split)
            mine = alive(words)
            if mine.any():
                hashes.append(window_hashes(words, alive.window)[mine])
                checks.append(window_hashes(check_hashes(split), alive.window)[mine])
                ranks.append(NO_ID if doc is None else doc)
                held += len(hashes[-1])
            if held >= _FLUSH_WINDOWS:
                yield flush(hashes, checks, ranks)
                hashes, checks, ranks, held = [], [], [], 0
        if hashes:
            yield flush(hashes, checks, ranks)

    return send


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket: the first document of each window; one row per owner and bucket."""
    at, held, loose = None, [], 0

    def merge():
        return _first_of(*(np.concatenate(x) for x in zip(*held, strict=True)))

    def done():
        h, c, d = merge()
        order = np.argsort(d, kind="stable")
        own, d = np.stack([h[order], c[order]], axis=1), d[order]
        ends = cuts(d)
        return record(["rank", "own"],
                      [d[ends[:-1]], [own[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]],
                      [pa.int64(), pa.binary()])

    for batch in batches:
        for bucket, h, c, d in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if bucket != at and at is not None:
                yield done()
                held, loose = [], 0
            at = bucket
            held.append((np.frombuffer(h, np.uint64), np.frombuffer(c, np.uint64), np.frombuffer(d, np.int64)))
            loose += len(held[-1][0])
            if loose > _FLUSH_WINDOWS:  # fold repeats, so that only distinct windows are held
                held, loose = [merge()], 0
    if at is not None:
        yield done()


def _remove(alive: Survivors | None, window: int, with_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, text, own in zip(
                batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), strict=True
            ):
                words = (text or b"").split()
                gone = np.zeros(len(words), bool)
                if alive is not None and len(words) >= window:
                    hashes = word_hashes(words)
                    mine = alive(hashes)
                    if mine.any():
                        at = np.flatnonzero(mine)
                        found, checks = (window_hashes(h, window)[at] for h in (hashes, check_hashes(words)))
                        owned = np.frombuffer(b"".join(own or ()), np.uint64).reshape(-1, 2)
                        at = at[~among(found, checks, owned)]
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + window, -1)
                        gone = np.cumsum(edge[:-1]) > 0
                kept = b" ".join(np.array(words, object)[~gone].tolist() if gone.any() else words)
                out.append((doc, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                            kept.decode() if with_text else None))
            if out:
                yield record(["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
                             list(zip(*out, strict=True)),
                             [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()])

    return remove


def remove_repeats(docs: DataFrame, window: int = WINDOW, first: int = FIRST, with_text: bool = True,
                   max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Remove every word covered by a window that also starts in a document with a smaller id.

    Returns doc_id, n_words, n_removed, kept_sha256 and, with ``with_text``, the kept words
    joined by one space (``kept``).
    """
    docs = narrow(docs)
    size = text_bytes(docs)
    alive: Survivors | None = Survivors(window)
    for length in levels(first, window):
        share = 2 / (window - length + 2)  # of the positions whose hash is smallest somewhere
        seen = twice_seen(docs, alive.hasher(length), share * size / _WORD_BYTES, max_filter_bytes)
        if seen is None:  # no candidates survive
            alive = None
            break
        alive = alive.extended(length, seen)
    ranked = docs.withColumn("rank", rank())
    if alive is None:
        joined = ranked.withColumn("own", F.lit(None).cast("array<binary>"))
    else:
        buckets = power_of_two(size / _BUCKET_BYTES, 8, 1 << 20)
        owners = (
            docs.mapInArrow(_send_windows(alive, buckets), "bucket int, hashes binary, checks binary, docs binary")
            .repartition("bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(_own, "rank long, own binary")
            .groupBy("rank")
            .agg(F.collect_list("own").alias("own"))
        )
        joined = ranked.join(owners, "rank", "left")
    result = joined.select("doc_id", "text", "own").mapInArrow(
        _remove(alive, window, with_text),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string",
    )
    return result if with_text else result.drop("kept")
