"""Twice-seen filter: two Bloom filters over hashes, for those met in two documents or more.

Documents send only hashes. A segment of the hash space is one task's work: it streams
the hashes of its segment through a once-seen and a twice-seen filter. The twice-seen
segments together are the filter. Its size follows the input up to ``max_bytes``; beyond
that more hashes are suspected than repeat, never fewer, and the callers verify suspects.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from pairwarden.llm.tables import cuts, power_of_two, record, rows_of

MAX_FILTER_BYTES = 64 << 20
_SEGMENT_BITS = 20  # bits of one segment, as a power of two
_SENT_BYTES = 6  # of each hash; the two highest bytes only choose the segment
_FLUSH_HASHES = 1 << 20
_PLACE = np.uint64((1 << _SEGMENT_BITS) - 1)

Hasher = Callable[[bytes], np.ndarray]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit hashes over all their bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _places(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash within its segment."""
    return (low & _PLACE).astype(np.int64), ((low >> np.uint64(24)) & _PLACE).astype(np.int64)


def _folded(h: np.ndarray, segments: int) -> np.ndarray:
    """Hashes whose highest two bytes are the number of their segment."""
    return (h >> np.uint64(48)) % np.uint64(segments) << np.uint64(48) | h & np.uint64((1 << 48) - 1)


class TwiceSeen:
    """Membership test on the broadcast twice-seen segments.

    ``hot`` lists hashes of a large part of all documents, if they were asked for.
    """

    def __init__(self, bits: Broadcast, segments: int, hot: np.ndarray):
        self.bits, self.segments, self.hot = bits, segments, hot

    def is_hot(self, hashes: np.ndarray) -> np.ndarray:
        return np.isin(_folded(hashes, self.segments), self.hot)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        bits = self.bits.value
        base = (hashes >> np.uint64(48) & np.uint64(self.segments - 1)) << np.uint64(_SEGMENT_BITS)
        hit = np.zeros(len(hashes), bool)
        first = (base | hashes & _PLACE).view(np.int64)
        maybe = np.flatnonzero(bits[first >> 3] >> (first & 7) & 1)  # the second bit of few is looked up
        second = (base[maybe] | hashes[maybe] >> np.uint64(24) & _PLACE).view(np.int64)
        hit[maybe] = bits[second >> 3] >> (second & 7) & 1
        return hit


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values; for short arrays quicker than ``np.unique``."""
    h = np.sort(h)
    return h[np.r_[True, h[1:] != h[:-1]]] if len(h) else h


def _send(hasher: Hasher, segments: int, hot_parts: int | None) -> Callable[[Iterator], Iterator]:
    """Map side: hashes by segment, each at most twice per flush, and what is hot in the flush."""

    def flush(parts: list[np.ndarray], docs: int) -> pa.RecordBatch:
        h = _folded(np.concatenate(parts), segments)
        h.sort()
        often = np.zeros((0, 2), np.uint64)  # hash, number of documents
        if hot_parts:
            ends = cuts(h)
            times = np.diff(ends)
            hot = times > max(16, docs / (2 * hot_parts))
            often = np.stack([h[ends[:-1][hot]], times[hot].astype(np.uint64)], axis=1)
        if len(h) > 2:
            h = h[np.r_[True, True, h[2:] != h[:-2]]]
        segment = (h >> np.uint64(48)).astype(np.int64)
        ends = cuts(segment)
        raw = np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_SENT_BYTES])
        mine = (often[:, 0] >> np.uint64(48)).astype(np.int64)
        parts = list(zip(ends, ends[1:], strict=False))
        own = segment[ends[:-1]]
        return record(
            ["segment", "hashes", "often", "docs"],
            [own, [raw[a:b].tobytes() for a, b in parts],
             [often[a:b].tobytes() for a, b in
              zip(np.searchsorted(mine, own, "left"), np.searchsorted(mine, own, "right"), strict=True)],
             [docs] * len(parts)],
            [pa.int32(), pa.binary(), pa.binary(), pa.int64()],
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, docs = [], 0, 0
        for _, text in rows_of(batches):
            own = distinct(hasher(text))
            docs += 1
            if len(own):
                parts.append(own)
                held += len(own)
            if held >= _FLUSH_HASHES:
                yield flush(parts, docs)
                parts, held, docs = [], 0, 0
        if parts:
            yield flush(parts, docs)

    return send


def _meet(hot_parts: int | None) -> Callable[[Iterator], Iterator]:
    """Reduce side: rows come by segment; holds two filters of one segment."""

    def done(at, twice, often, docs):
        hot = [h for h, n in often.items() if n > max(16, docs / (2 * (hot_parts or 1)))]
        return record(
            ["segment", "bits", "hot"],
            [[at], [np.packbits(twice, bitorder="little").tobytes()], [np.array(hot, np.uint64).tobytes()]],
            [pa.int32(), pa.binary(), pa.binary()],
        )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = once = twice = None
        for batch in batches:
            for segment, packed, pairs, docs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != at:
                    if at is not None:
                        yield done(at, twice, often, seen)
                    at, often, seen = segment, Counter(), 0
                    once, twice = (np.zeros(1 << _SEGMENT_BITS, np.uint8) for _ in range(2))
                seen += docs
                for value, n in np.frombuffer(pairs, np.uint64).reshape(-1, 2).tolist():
                    often[value] += n
                raw = np.frombuffer(packed, np.uint8).reshape(-1, _SENT_BYTES)
                low = np.zeros((len(raw), 8), np.uint8)
                low[:, :_SENT_BYTES] = raw
                low = low.view("<u8").ravel()
                pair = np.r_[low[1:] == low[:-1], False]  # sent twice: sorted, so neighbours
                first, second = _places(low)
                again = pair | (once[first] & once[second]).astype(bool)
                for place in (first, second):
                    twice[place[again]] = 1
                    once[place] = 1
        if at is not None:
            yield done(at, twice, often, seen)

    return meet


def twice_seen(docs: DataFrame, hasher: Hasher, expected: float, max_bytes: int = MAX_FILTER_BYTES,
               hot_parts: int | None = None) -> TwiceSeen | None:
    """Filter of the hashes that ``hasher`` gives for at least two rows of (id, text).

    ``expected`` hashes decide the size (8 bits each, at most ``max_bytes``). None when
    no hash repeats. ``hot_parts`` asks for the hashes found in more than one in so many
    documents: whatever is that frequent is so in some flush, which reports it.
    """
    spark = docs.sparkSession
    most = power_of_two((max_bytes << 3) / 2 + 1, 1 << _SEGMENT_BITS, 1 << 36)
    segments = power_of_two(8 * expected, 1 << _SEGMENT_BITS, most) >> _SEGMENT_BITS
    sent = docs.mapInArrow(
        _send(hasher, segments, hot_parts), "segment int, hashes binary, often binary, docs long"
    )
    met = sent.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        _meet(hot_parts), "segment int, bits binary, hot binary"
    )
    bits = np.zeros(segments << (_SEGMENT_BITS - 3), np.uint8)
    size = 1 << (_SEGMENT_BITS - 3)
    hot = [np.zeros(0, np.uint64)]
    for row in met.collect():  # max_bytes in all; hot hashes are few by definition
        bits[row.segment * size : (row.segment + 1) * size] = np.frombuffer(row.bits, np.uint8)
        hot.append(np.frombuffer(row.hot, np.uint64))
    if not bits.any():
        return None
    return TwiceSeen(spark.sparkContext.broadcast(bits), segments, np.concatenate(hot))
