"""Suffix-array de-duplication on a run-length index.

Every ``window`` (50) bytes that also start in a document with a smaller id are removed.

1. Seeds. Each window is represented by the smallest hash of its ``seed``-byte substrings;
   equal windows have equal smallest hashes. The hashes go through the twice-seen filter
   (``repeats.twice_seen``), which clears most of a corpus without moving text.
2. Segments. Suspected windows that follow each other with the same smallest hash form one
   segment of text. Segments go to the bucket of that hash, so all equal windows meet; each
   task sends a distinct segment once, with its smallest document.
3. Index. A bucket sorts its suffixes to the window's depth, keeps the runs of their
   Burrows-Wheeler transform and, sampled at the end of each run, the first document of
   the window the run belongs to; suffixes and transform are dropped (``RunIndex``).
4. Matching. Segments stream through the index from right to left, one backward-search step
   per byte for all of them at once; matches of the window's length read the sample.
5. Only a window's first document, its owner, hears about it. Every document then removes
   the suspected windows it does not own.

Seeds that more than one in ``HOT_PARTS`` documents share would gather the text around them in
one bucket. Their windows are segments of their own, spread by the hash of the whole window.

Matches never cross documents. Null texts are empty. Rows that share an id are the same
document for the order; a missing id comes after all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.llm.repeats import MAX_FILTER_BYTES, TwiceSeen, twice_seen
from pairwarden.llm.substring_dedup import smallest
from pairwarden.llm.tables import NO_ID, cuts, narrow, power_of_two, rank, record, rows_of, text_bytes

WINDOW = 50
SEED = 20
LONGEST = 64  # windows of a segment; an owner's answer is one bit each
HOT_PARTS = 512  # a seed in more than this part of the documents is hot
_BLOCK = 1 << 20  # bytes hashed at once
_FLUSH_SEGMENTS = 320_000
_BUCKET_BYTES = 1 << 20  # text per bucket; about half of it is indexed

_ONE, _TWO, _HALF = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(32)


def grams(text: bytes, size: int) -> np.ndarray:
    """Hash of every substring of ``size`` (at least 8) bytes, from its 8-byte words."""
    n = len(text) - size + 1
    words = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,)).copy()
    h = words[:n] * _ONE + _TWO
    for at in [*range(8, size - 7, 8), *([size - 8] if size % 8 else [])]:
        h += words[at : at + n]
        h *= _TWO
        h ^= h >> _HALF
    h *= _ONE
    h ^= h >> _HALF
    return h


def seeds(text: bytes, window: int, seed: int) -> np.ndarray:
    """For each window of the text, the smallest hash of its substrings of ``seed`` bytes."""
    if len(text) < window:
        return np.zeros(0, np.uint64)
    if len(text) <= _BLOCK:
        return smallest(grams(text, seed), window - seed + 1)
    parts = [text[at : at + _BLOCK + window - 1] for at in range(0, len(text) - window + 1, _BLOCK)]
    return np.concatenate([smallest(grams(part, seed), window - seed + 1) for part in parts])


class Segments:
    """Cuts a document's suspected windows into segments."""

    def __init__(self, seen: TwiceSeen, window: int, seed: int):
        self.seen, self.window, self.seed = seen, window, seed

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and numbers of windows of the segments, and the hash that chooses their bucket
        (0: to be chosen by the segment itself)."""
        anchors = seeds(text, self.window, self.seed)
        if not len(anchors):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), anchors
        ends = cuts(anchors)
        value = anchors[ends[:-1]]
        suspect = self.seen(value)
        start, size, value = ends[:-1][suspect], np.diff(ends)[suspect], value[suspect]
        longest = np.full(len(value), LONGEST)
        if len(self.seen.hot):
            hot = self.seen.is_hot(value)
            longest[hot], value[hot] = 1, 0
        parts = -(-size // longest)
        if parts.max(initial=0) <= 1:
            return start, size, value
        which = np.repeat(np.arange(len(start)), parts)
        inside = (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)) * longest[which]
        return start[which] + inside, np.minimum(size[which] - inside, longest[which]), value[which]


_digest = xxhash.xxh3_64_intdigest


def _send_segments(cut: Segments, buckets: int):
    """Per task: distinct segments with their smallest document, by bucket."""
    tail = cut.window - 1

    def flush(held: dict[bytes, int], docs: list[int], chosen: list[int]) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=3).compress
        texts = list(held)
        value = np.array(chosen, np.uint64)
        bucket = (value >> np.uint64(40)).astype(np.int64) % buckets
        order = np.lexsort((value, bucket))  # segments of one seed side by side
        bucket = bucket[order]
        docs = np.array(docs, np.int64)[order]
        texts = [texts[i] for i in order]
        sizes = np.fromiter(map(len, texts), np.uint8, len(texts))
        ends = cuts(bucket)
        parts = list(zip(ends, ends[1:], strict=False))
        return record(
            ["bucket", "text", "sizes", "docs"],
            [bucket[ends[:-1]], [press(b"".join(texts[a:b])) for a, b in parts],
             [press(sizes[a:b].tobytes()) for a, b in parts], [press(docs[a:b].tobytes()) for a, b in parts]],
            [pa.int32(), pa.binary(), pa.binary(), pa.binary()],
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}  # number of each distinct segment
        docs: list[int] = []
        chosen: list[int] = []
        for doc, text in rows_of(batches):
            me = NO_ID if doc is None else doc
            starts, counts, values = cut(text)
            for a, b, v in zip(starts.tolist(), (starts + counts + tail).tolist(), values.tolist(), strict=True):
                segment = text[a:b]
                number = held.setdefault(segment, len(docs))
                if number == len(docs):
                    docs.append(me)
                    chosen.append(v or _digest(segment))
                elif me < docs[number]:
                    docs[number] = me
            if len(docs) > _FLUSH_SEGMENTS:
                yield flush(held, docs, chosen)
                held, docs, chosen = {}, [], []
        if held:
            yield flush(held, docs, chosen)

    return send


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of the windows of a set of segments.

    Rows are the suffixes that start a window, and the one after each segment's last window,
    sorted by their first ``depth`` bytes (their context). Runs of the transform end where the
    preceding symbol or the context changes. Each run keeps its first row and, sampled once for
    the run, the smallest document of its context; suffixes and transform are dropped. The row
    of each segment's last window is the foothold from which matching starts.
    """

    def __init__(self, segments: list[bytes], docs: np.ndarray, depth: int):
        self.depth = depth
        text = b"\0".join([*segments, b""])  # one byte behind each segment
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        start = np.cumsum(sizes + 1) - sizes - 1
        rows = sizes - depth + 2
        segment = np.repeat(np.arange(len(segments)), rows)
        place = np.arange(len(segment)) - np.repeat(np.cumsum(rows) - rows, rows)
        at = start[segment] + place
        whole = place < rows[segment] - 1  # a window, not the suffix behind the last one
        contexts = np.ndarray((len(text) - depth + 1,), f"S{depth}", text, strides=(1,))[at]
        order = np.argsort(contexts)
        contexts = contexts[order]
        group = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]])
        context = np.zeros(len(order), np.int64)
        context[group] = 1
        context = np.cumsum(context) - 1
        whole, place = whole[order], place[order]
        owner = np.where(whole, docs[segment[order]], NO_ID)
        first = np.minimum.reduceat(owner, group)
        data = np.frombuffer(text, np.uint8)
        before = np.where(place > 0, data[at[order] - 1].astype(np.int64) + 1, 0)
        run = np.flatnonzero(np.r_[True, (before[1:] != before[:-1]) | (context[1:] != context[:-1])])
        self.window = (np.cumsum(whole) - whole)[run]  # windows before the run
        self.context = group[context[run]]  # first row of the run's context
        self.sample = first[context[run]]
        symbol, length = before[run], np.diff(np.r_[run, len(order)])
        by_symbol = np.argsort(symbol, kind="stable")
        self.rows = len(order) + 1
        self.key = symbol[by_symbol] * self.rows + run[by_symbol]
        self.length = length[by_symbol]
        # windows that start with smaller symbols, or with this one in earlier runs
        self.total = np.cumsum(self.length) - self.length - length[symbol == 0].sum()
        last = np.empty(len(order), np.int64)
        last[order] = np.arange(len(order))
        foot = context[last[np.cumsum(rows) - 2]]
        self.foot, self.foot_sample = group[foot], first[foot]

    def extend(self, row: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Backward-search step: the run of the context that is ``symbol`` before the one at ``row``."""
        wanted = symbol * self.rows + row
        found = np.searchsorted(self.key, wanted, "left") - 1  # last run that begins before the row
        inside = np.minimum(wanted - self.key[found], self.length[found])  # all of it, if of a smaller symbol
        return np.searchsorted(self.window, self.total[found] + inside, "right") - 1

    def first_documents(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics cut at the depth, for the segments of the index in their order: the
        smallest document of each window, and the number of windows of each segment."""
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        by_size = np.argsort(-sizes, kind="stable")
        windows = (sizes - self.depth + 1)[by_size]
        out = np.full((len(segments), int(windows[0])), NO_ID)
        data = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64) + 1
        last = (np.cumsum(sizes) - self.depth)[by_size]  # where the last windows start
        out[by_size, windows - 1] = self.foot_sample[by_size]
        row = self.foot[by_size]
        for t in range(1, int(windows[0])):
            live = int(np.searchsorted(-windows, -t, "left"))  # segments of more than t windows
            run = self.extend(row[:live], data[last[:live] - t])
            out[by_size[:live], windows[:live] - t - 1] = self.sample[run]
            row = self.context[run]
        windows = sizes - self.depth + 1
        return out[np.arange(out.shape[1]) < windows[:, None]], windows


def _index(window: int):
    """Rows come by bucket: one row per owner, with (segment digest, bits of owned windows)."""

    def answer(held: dict[bytes, int]) -> pa.RecordBatch:
        segments = list(held)
        docs = np.fromiter(held.values(), np.int64, len(segments))
        found, sizes = RunIndex(segments, docs, window).first_documents(segments)
        flat = found == np.repeat(docs, sizes)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        bits = np.where(flat, np.uint64(1) << place.astype(np.uint64), np.uint64(0))
        mask = np.bitwise_or.reduceat(bits, np.cumsum(sizes) - sizes)
        digest = np.fromiter(map(_digest, segments), np.uint64, len(segments))
        some = mask != 0
        docs, pairs = docs[some], np.stack([digest[some], mask[some]], axis=1)
        order = np.argsort(docs, kind="stable")
        docs, pairs = docs[order], pairs[order]
        ends = cuts(docs)
        return record(["rank", "own"],
                      [docs[ends[:-1]], [pairs[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]],
                      [pa.int64(), pa.binary()])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, unpress = None, {}, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for bucket, text, sizes, docs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text, sizes, docs = unpress(text), unpress(sizes), unpress(docs)
                if bucket != at and held:
                    yield answer(held)
                    held = {}
                at, start = bucket, 0
                sizes = np.frombuffer(sizes, np.uint8).tolist()
                for size, doc in zip(sizes, np.frombuffer(docs, np.int64).tolist(), strict=True):
                    segment = text[start : start + size]
                    start += size
                    if doc < held.get(segment, NO_ID + 1):
                        held[segment] = doc
        if held:
            yield answer(held)

    return index


def _remove(cut: Segments | None, with_text: bool):
    def covered(text: bytes, own: list[bytes] | None) -> np.ndarray | None:
        starts, counts, _ = cut(text)
        if not len(starts):
            return None
        ends = starts + counts + (cut.window - 1)
        digest = np.array([_digest(text[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)
        masks = np.zeros(len(starts), np.uint64)
        if own:
            owned = dict(np.frombuffer(b"".join(own), np.uint64).reshape(-1, 2).tolist())
            masks = np.array([owned.get(d, 0) for d in digest.tolist()], np.uint64)
        whole = np.uint64(2**64 - 1) >> (np.uint64(64) - counts.astype(np.uint64))
        some = np.flatnonzero(masks != whole)  # segments with a window that another document owns
        if not len(some):
            return None
        starts, counts, masks = starts[some], counts[some], masks[some]
        which = np.repeat(np.arange(len(starts)), counts)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        gone = masks[which] >> inside.astype(np.uint64) & np.uint64(1) == 0
        at = (starts[which] + inside)[gone]
        edge = np.zeros(len(text) + 1, np.int32)
        edge[at] += 1
        edge[at + cut.window] -= 1  # windows start at distinct places
        return np.cumsum(edge[:-1]) > 0

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, text, own in zip(
                batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), strict=True
            ):
                text = text or b""
                gone = None if cut is None else covered(text, own)
                removed = spans = 0
                kept = text
                if gone is not None:
                    removed = int(gone.sum())
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((doc, len(text), removed, spans, hashlib.sha256(kept).hexdigest(),
                            kept if with_text else None))
            if out:
                yield record(["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                             list(zip(*out, strict=True)),
                             [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()])

    return remove


def remove_long_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, with_text: bool = True,
                        max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Remove each byte covered by a ``window``-byte string that also starts in a document with a
    smaller id.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, with
    ``with_text``, the remaining bytes ``kept``.
    """
    docs = narrow(docs)
    size = text_bytes(docs)
    expected = 2 * size / (window - seed + 2)
    seen = twice_seen(docs, lambda text: seeds(text, window, seed), expected, max_filter_bytes, HOT_PARTS)
    ranked = docs.withColumn("rank", rank())
    cut = None
    if seen is None:
        joined = ranked.withColumn("own", F.lit(None).cast("array<binary>"))
    else:
        cut = Segments(seen, window, seed)
        buckets = power_of_two(size / _BUCKET_BYTES, 8, 1 << 24)
        owners = (
            docs.mapInArrow(
                _send_segments(cut, buckets), "bucket int, text binary, sizes binary, docs binary"
            )
            .repartition("bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(_index(window), "rank long, own binary")
            .groupBy("rank")
            .agg(F.collect_list("own").alias("own"))
        )
        joined = ranked.join(owners, "rank", "left")
    result = joined.select("doc_id", "text", "own").mapInArrow(
        _remove(cut, with_text),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
    return result if with_text else result.drop("kept")
