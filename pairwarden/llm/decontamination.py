"""Benchmark decontamination with Wu-Manber multi-pattern search over words.

Patterns are the benchmark's windows of words. Searching runs over words in place of
characters: a block is two neighbouring words (one for one-word patterns). Per pattern
length m the shift table holds, for each block that occurs in a pattern, how far its last
occurrence is from the pattern's end; any other block lets the search skip m-1 words
(m for one-word blocks). Shift 0 leads to a bucket, chosen by the hash of the last block
and the first word, whose patterns are compared word by word.

Words are runs of ASCII letters and digits and of any other non-ASCII characters, after
lower-casing A-Z. Items without a word give no pattern; a null item id never counts as an
item, though its words are hit. Null or empty documents have no words. Repeated items and
rows each count by themselves (equal item ids once).

The patterns of one pass are bounded by ``max_words``: equal items are taken once, a long one is cut
into ranges of windows, and blocks are filled by a running count of words. A larger benchmark is
searched block by block. Then the documents get row numbers and are staged once; a pass
writes its findings by row number, without texts, and all findings are joined at the end.

A column with the name of the result is replaced; other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.session import stage

WINDOW_WORDS = 10
MAX_WORDS = 500_000  # benchmark words of one pass

# Bytes that separate words; A-Z is lower-cased.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytearray(range(256))
for _b in _SEPARATORS:
    _TABLE[_b] = 0x20
for _b in range(0x41, 0x5B):
    _TABLE[_b] = _b + 0x20
_TABLE = bytes(_TABLE)


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class WuManber:
    """Patterns of one length: shift table, buckets, and the items of each pattern."""

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        self.items: dict[tuple, set] = {}

    def add(self, pattern: tuple, item: int | None) -> None:
        if pattern in self.items:
            self.items[pattern].add(item)
            return
        self.items[pattern] = {item}
        m, b = self.length, self.block
        for end in range(b, m + 1):
            key = pattern[end - b : end]
            self.shift[key] = min(self.shift.get(key, m - b + 1), m - end)
        self.buckets[pattern[m - b :], pattern[0]].append(pattern)

    def search(self, doc: list[bytes], spans: list, items: set) -> None:
        """Add the spans (start, end) of all occurrences and the items they belong to."""
        m, b = self.length, self.block
        skip, shift, buckets = m - b + 1, self.shift, self.buckets
        end, n = m, len(doc)
        while end <= n:
            block = tuple(doc[end - b : end])
            by = shift.get(block, skip)
            if by:
                end += by
                continue
            for pattern in buckets.get((block, doc[end - m]), ()):
                if tuple(doc[end - m : end]) == pattern:
                    spans.append((end - m, end))
                    items |= self.items[pattern]
            end += 1


def searchers(items: list[tuple[int | None, bytes]], window: int) -> list[WuManber]:
    """One search structure per pattern length: ``window``, and shorter whole items."""
    by_length: dict[int, WuManber] = {}
    for item, text in items:
        own = words(text)
        m = min(window, len(own))
        if not m:
            continue
        machine = by_length.setdefault(m, WuManber(m))
        for start in range(len(own) - m + 1):
            machine.add(tuple(own[start : start + m]), item)
    return list(by_length.values())


def _ranges(window: int, most: int):
    """Items cut into ranges of at most ``most`` words that hold all their windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, most - window + 1)  # windows of a range
        for batch in batches:
            items, texts, sizes = [], [], []
            for item, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = words(text.encode())
                for at in range(0, max(1, len(own) - window + 1), step) if own else ():
                    part = own[at : at + step + window - 1]
                    items.append(item)
                    texts.append(b" ".join(part).decode())
                    sizes.append(len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.as_py() for i in items], batch.schema.field(0).type), pa.array(texts, pa.string()),
                 pa.array(sizes, pa.int64())],
                names=["item", "text", "n"],
            )

    return cut


def _pattern_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, max_words: int):
    """(id, text) rows of the benchmark in blocks of at most ``max_words`` words (one window at least),
    of which one is held at a time."""
    items = benchmark.select(
        F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")
    ).filter("text is not null").distinct()
    kind = items.schema["item"].dataType.simpleString()
    ranges = items.mapInArrow(_ranges(window, max(window, max_words // 4)), f"item {kind}, text string, n long")
    block, held = [], 0
    for r in stage(ranges.distinct(), "benchmark-ranges").toLocalIterator():  # a partition at a time
        if block and held + r.n > max_words:
            yield block
            block, held = [], 0
        block.append((r.item, r.text.encode()))
        held += r.n
    yield block


_LAST: list = []  # the patterns a worker has seen last, and their machines


def _machines(patterns, window: int) -> list[WuManber]:
    """Search structures of broadcast patterns, built once per worker."""
    own = patterns.value
    if not (_LAST and _LAST[0] is own and _LAST[1] == window):
        _LAST[:] = [own, window, searchers(own, window)]
    return _LAST[2]


def _find(machines: list[WuManber], text: bytes | None) -> tuple[int, list, set]:
    """Words of a text, spans of occurrences, items met (as text)."""
    doc = words(text or b"")
    spans, items = [], set()
    for machine in machines:
        machine.search(doc, spans, items)
    return len(doc), spans, {str(i) for i in items if i is not None}


def _search(patterns, window: int):
    """Column function: spans (flat) and items of one block of patterns."""

    @F.arrow_udf("spans array<int>, items array<string>")
    def search(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machines = _machines(patterns, window)
        for batch in texts:
            found = [_find(machines, t) for t in batch.cast(pa.binary()).to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([[x for span in f[1] for x in span] for f in found], pa.list_(pa.int32())),
                 pa.array([sorted(f[2]) for f in found], pa.list_(pa.string()))], names=["spans", "items"])

    return search


_SETTLED = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()),
    ("items", pa.list_(pa.string())), ("contaminated", pa.bool_()),
])


def _last_search(patterns, window: int):
    """Column function: the last block, and all findings together with those of the blocks before."""

    @F.arrow_udf("n_words long, n_hit long, n_items long, items_sha256 string, items array<string>, "
                 "contaminated boolean")
    def settle(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        machines = _machines(patterns, window)
        for texts, spans, items in columns:
            out = []
            for text, earlier, known in zip(
                texts.cast(pa.binary()).to_pylist(), spans.to_pylist(), items.to_pylist(), strict=True
            ):
                n, own, found = _find(machines, text)
                hit = _covered(np.array([*earlier, *(x for span in own for x in span)], np.int64))
                ids = sorted(found.union(known))
                out.append({"n_words": n, "n_hit": hit, "n_items": len(ids), "items": ids, "contaminated": hit > 0,
                            "items_sha256": hashlib.sha256(",".join(ids).encode()).hexdigest()})
            yield pa.array(out, _SETTLED)

    return settle


def _covered(edges: np.ndarray) -> int:
    """Words inside any of the spans (start, end, start, end ...)."""
    if not len(edges):
        return 0
    cover = np.zeros(edges.max() + 1, np.int64)
    np.add.at(cover, edges[::2], 1)
    np.add.at(cover, edges[1::2], -1)
    return int((np.cumsum(cover) > 0).sum())


def mark_contamination(docs: DataFrame, benchmark: DataFrame, column: str = "contamination",
                       text_col: str = "text", window: int = WINDOW_WORDS,
                       max_words: int = MAX_WORDS) -> DataFrame:
    """All columns of ``docs`` and a struct ``column``: n_words, n_hit (words inside any occurrence of
    a benchmark window), n_items, items (ids as text, sorted), items_sha256, contaminated.

    Patterns are broadcast, at most ``max_words`` words a pass; in a single pass no row is shuffled.
    """
    context, text = docs.sparkSession.sparkContext, F.col(text_col).cast("string")
    spans, items = F.array().cast("array<int>"), F.array().cast("array<string>")
    blocks = _pattern_blocks(benchmark, "item_id", "text", window, max_words)
    patterns, found, passes = next(blocks), docs, []
    for following in blocks:
        name = f"_found_{column}_{len(passes)}"
        if not passes:
            row = f"_row_{column}"
            found = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
        search = _search(context.broadcast(patterns), window)(text)
        passes.append(stage(found.select(row, search.alias(name)).filter(F.size(f"{name}.spans") > 0), "findings"))
        patterns = following
    names = [p.columns[1] for p in passes]
    for one in passes:
        found = found.join(one, row, "left")
    if passes:
        spans, items = (
            F.flatten(F.array(*[F.coalesce(f"{n}.{part}", empty) for n in names]))
            for part, empty in (("spans", spans), ("items", items))
        )
    settled = _last_search(context.broadcast(patterns), window)(text, spans, items)
    return found.withColumn(column, settled).select(*[c for c in docs.columns if c != column], column)
