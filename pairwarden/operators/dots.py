"""Cosine similarity of the bags of one cell, in numpy, inside a task.

A cell is a part of the bags of a bucket, or several whole buckets. A bag is its sorted words, joined
by spaces. Products of word counts are whole numbers, so they are exact in whatever order they are added.

For high bounds a bag has a sketch: the length of its unit vector in each of ``SKETCH`` groups of words. By
Cauchy's inequality in each group the product of two sketches is never less than the similarity, so rows
whose sketch is near to none are left out before their words are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

LEFT_ROWS, RIGHT_ROWS = 512, 2048  # of a block of products
HEAD = 2048  # most frequent words of a bucket, multiplied as dense columns
LINKS = 1 << 16  # that are written at once
SKETCH = 256  # groups of words
SKETCH_ROWS = 1024  # whose words are read at once
ROUNDED = 0.002  # more than half precision takes off a product of sketches


class Bags:
    """Rows of (word, count), words as numbers that hold within a cell."""

    def __init__(self, words: pa.Array):
        lists = pc.split_pattern(words, " ")
        offsets = lists.offsets.to_numpy()
        encoded = lists.values.dictionary_encode()
        codes = encoded.indices.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.int64)
        offsets = offsets.astype(np.int64) - offsets[0]
        self.words = encoded.dictionary
        # equal words of a bag lie side by side
        first = np.ones(len(codes), bool)
        first[1:] = codes[1:] != codes[:-1]
        first[offsets[:-1]] = True
        starts = np.flatnonzero(first)
        self.codes = codes[starts]
        self.tf = np.diff(starts, append=len(codes))
        self.ptr = np.searchsorted(starts, offsets)
        self.n2 = np.add.reduceat(self.tf * self.tf, self.ptr[:-1]) if len(words) else np.zeros(0, np.int64)

    def postings(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``rows``, word, count) of the words of ``rows``."""
        sizes = self.ptr[rows + 1] - self.ptr[rows]
        place = np.repeat(np.arange(len(rows)), sizes)
        at = np.arange(len(place)) + np.repeat(self.ptr[rows] - np.cumsum(sizes) + sizes, sizes)
        return place, self.codes[at], self.tf[at]


def sketch(words: pa.Array) -> pa.Array:
    """Sketches of bags, ``SKETCH`` numbers in half precision each."""
    out = []
    for start in range(0, len(words), SKETCH_ROWS):
        bags = Bags(words.slice(start, SKETCH_ROWS))
        group = pd.util.hash_array(bags.words.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(SKETCH)
        rows = len(bags.n2)
        at = np.repeat(np.arange(rows) * SKETCH, np.diff(bags.ptr)) + group.astype(np.int64)[bags.codes]
        mass = np.bincount(at, (bags.tf * bags.tf).astype(np.float64), rows * SKETCH).reshape(rows, SKETCH)
        out += [row.tobytes() for row in np.sqrt(mass / bags.n2[:, None]).astype(np.float16)]
    return pa.array(out, pa.binary())


def _met(
    lefts: np.ndarray, rights: np.ndarray, rank: np.ndarray, ordered: np.ndarray
) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Blocks of ``lefts`` and ``rights``, both by ``rank``, and which of their pairs count.

    Of a right row that is ``ordered`` only pairs with a left one of smaller ``rank`` do.
    """
    for i in range(0, len(lefts), LEFT_ROWS):
        left = slice(i, i + LEFT_ROWS)
        for j in range(0, len(rights), RIGHT_ROWS):
            right = slice(j, j + RIGHT_ROWS)
            wanted = ~ordered[rights[right]][None, :] | (rank[lefts[left]][:, None] < rank[rights[right]][None, :])
            if wanted.any():
                yield left, right, wanted


def _near(
    sketches: np.ndarray, lefts: np.ndarray, rights: np.ndarray, rank: np.ndarray, ordered: np.ndarray, min_sim: float
) -> tuple[np.ndarray, np.ndarray]:
    """The rows on both sides that may have a link above the bound."""
    one, two = (sketches[rows].astype(np.float32) for rows in (lefts, rights))
    kept = np.zeros(len(lefts), bool), np.zeros(len(rights), bool)
    for left, right, wanted in _met(lefts, rights, rank, ordered):
        wanted &= one[left] @ two[right].T > min_sim - ROUNDED
        kept[0][left] |= wanted.any(axis=1)
        kept[1][right] |= wanted.any(axis=0)
    return lefts[kept[0]], rights[kept[1]]


class Bucket:
    """The bags of one bucket, of which ``left`` meet ``right``."""

    def __init__(self, bags: Bags, left: np.ndarray, right: np.ndarray, min_sim: float):
        self.bags, self.left, self.right, self.min_sim = bags, left, right, min_sim
        words, counts = np.unique(bags.postings(np.union1d(left, right))[1], return_counts=True)
        order = np.argsort(-counts, kind="stable")
        self.words = words
        self.rank = np.empty(len(words), np.int64)  # 0: the most frequent word
        self.rank[order] = np.arange(len(words))
        most = max(bags.n2[left].max(), bags.n2[right].max())
        self.kind = np.float32 if most < 1 << 24 else np.float64  # the products are exact in it
        self.head = min(HEAD, len(words))

    def _split(self, rows: np.ndarray):
        """Dense columns of the frequent words and the postings of the others, by word."""
        place, codes, tf = self.bags.postings(rows)
        word = self.rank[np.searchsorted(self.words, codes)]
        near = word < self.head
        dense = np.zeros((len(rows), self.head), self.kind)
        dense[place[near], word[near]] = tf[near]
        rare = np.flatnonzero(~near)
        rare = rare[np.argsort(word[rare], kind="stable")]
        return dense, place[rare], word[rare], tf[rare]

    @staticmethod
    def _products(one, two) -> np.ndarray:
        """Products of all bags of two blocks."""
        (a, i, u, x), (b, j, v, y) = one, two
        out = (a @ b.T).astype(np.float64)
        low = np.searchsorted(v, u, "left")
        times = np.searchsorted(v, u, "right") - low
        if times.any():
            at = np.arange(times.sum()) + np.repeat(low - np.cumsum(times) + times, times)
            cell = np.repeat(i, times) * len(b) + j[at]
            out += np.bincount(cell, (np.repeat(x, times) * y[at]).astype(np.float64), out.size).reshape(out.shape)
        return out

    def links(self, rank: np.ndarray, ordered: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(left rows, right rows, similarity) above the bound, block by block; both sides are in order of ``rank``."""
        n2 = self.bags.n2
        splits = {at: self._split(self.right[at:at + RIGHT_ROWS]) for at in range(0, len(self.right), RIGHT_ROWS)}
        last = None
        for rows, others, wanted in _met(self.left, self.right, rank, ordered):
            left, right = self.left[rows], self.right[others]
            if rows != last:
                last, one = rows, self._split(left)
            dots = self._products(one, splits[others.start])
            sim = dots / np.sqrt((n2[left][:, None] * n2[right][None, :]).astype(np.float64))
            i, j = np.nonzero(wanted & (dots > 0) & (sim > self.min_sim))
            if len(i):
                yield left[i], right[j], sim[i, j]


def _meeting(cell: pa.Table, min_sim: float) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Rank of each row of a cell, whether it is ordered, and the rows of each bucket that meet."""
    rank = pc.rank(cell["bag"].chunk(0), tiebreaker="min").to_numpy()
    left, right, ordered, bucket = (cell[c].to_numpy() for c in ("_left", "_right", "_ordered", "_bucket"))
    sketches = None
    if "_sketch" in cell.column_names:
        sketches = np.frombuffer(b"".join(cell["_sketch"].to_pylist()), np.float16).reshape(-1, SKETCH)
    order = np.lexsort((rank, bucket))
    meeting = []
    for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        one, two = rows[left[rows]], rows[right[rows]]
        if sketches is not None and len(rows) > 1:
            one, two = _near(sketches, one, two, rank, ordered, min_sim)
        if len(rows) > 1 and len(one) and len(two):
            meeting.append((one, two))
    return rank, ordered, meeting


def _links(cell: pa.Table, min_sim: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, row, similarity) of the links of a cell."""
    rank, ordered, meeting = _meeting(cell, min_sim)
    if not meeting:
        return
    used = np.unique(np.concatenate([rows for sides in meeting for rows in sides]))
    bags = Bags(cell["_words"].chunk(0).take(pa.array(used)))
    for sides in meeting:
        one, two = (np.searchsorted(used, rows) for rows in sides)
        for i, j, sim in Bucket(bags, one, two, min_sim).links(rank[used], ordered[used]):
            yield used[i], used[j], sim


def write_near(cell: pa.Table, ends: Sequence[str], min_sim: float) -> Iterator[pa.RecordBatch]:
    """``ends`` of the rows whose sketch is near to another."""
    meeting = _meeting(cell, min_sim)[2]
    if meeting:
        rows = np.unique(np.concatenate([side for sides in meeting for side in sides]))
        yield from pa.table({c: cell[c].take(pa.array(rows)) for c in ends}).to_batches()


def _two_values(cell: pa.Table, apart: tuple[str, str]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Which of the pairs of rows (i, j) have two values together. ``apart`` names the least and the largest
    value of a bag's rows; no value is none."""
    low, high = (cell[c].to_pandas() for c in apart)
    known = {v: k for k, v in enumerate(low.dropna().unique())}
    single = low.map(known).fillna(-1).to_numpy().astype(np.int64)  # -1: no value
    several = (low != high).to_numpy() & low.notna().to_numpy()

    def kept(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        differ = (single[i] != single[j]) & (single[i] >= 0) & (single[j] >= 0)
        return several[i] | several[j] | differ

    return kept


def write_links(
    cell: pa.Table, same: Sequence[str], sides: Sequence[str], min_sim: float, apart: tuple[str, str] | None = None
) -> Iterator[pa.RecordBatch]:
    """The links themselves: ``same`` of the bucket, ``sides`` of both bags and ``sim``. With ``apart`` only
    those of two bags that have two values."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    several = apart and _two_values(cell, apart)

    def written() -> Iterator[pa.RecordBatch]:
        i, j, sim = (np.concatenate(x) for x in zip(*held, strict=True))
        columns = {c: cell[c].take(i) for c in same}
        columns |= {f"{s}_{c}": cell[c].take(at) for s, at in (("a", i), ("b", j)) for c in sides}
        yield from pa.table(columns | {"sim": sim}).to_batches()

    size = 0
    for i, j, sim in _links(cell, min_sim):
        if several:
            kept = several(i, j)
            i, j, sim = i[kept], j[kept], sim[kept]
        held.append((i, j, sim))
        size += len(sim)
        if size > LINKS:
            yield from written()
            held, size = [], 0
    if held:
        yield from written()


def count_links(cell: pa.Table, same: Sequence[str], apart: tuple[str, str], min_sim: float) -> Iterator[pa.RecordBatch]:
    """``_links``: how many links each bag has here. ``apart`` names the least and the largest of a value
    of a bag's rows; a link counts where the two bags have two values."""
    several = _two_values(cell, apart)
    count = np.zeros(cell.num_rows, np.int64)
    for i, j, _ in _links(cell, min_sim):
        kept = several(i, j)
        np.add.at(count, i[kept], 1)
        np.add.at(count, j[kept], 1)
    rows = np.flatnonzero(count)
    yield from pa.table({c: cell[c].take(rows) for c in (*same, "bag")} | {"_links": count[rows]}).to_batches()


def by_cell(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """``work`` of the cells of a partition that is sorted by ``keys``; no more than a cell is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys], axis=1)
        edges = [0, *(np.flatnonzero((table[1:] != table[:-1]).any(axis=1)) + 1), len(table)]
        for start, end in zip(edges, edges[1:], strict=False):
            if held and tuple(table[start]) != last:
                yield from work(pa.Table.from_batches(held).combine_chunks())
                held = []
            last = tuple(table[start])
            held.append(batch.slice(start, end - start))
    if held:
        yield from work(pa.Table.from_batches(held).combine_chunks())
