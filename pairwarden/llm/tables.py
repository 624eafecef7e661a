"""Small helpers shared by the operators: input columns, row batches, ranks of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rank of a document without an id: after every id.
NO_ID = 2**63 - 1
_ROWS = 256


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text (string); other columns cannot clash with an operator's own."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def whole_rows(docs: DataFrame, **own: Column) -> DataFrame:
    """Each row as one struct ``_doc`` beside columns of an operator's own, with which its columns
    cannot clash; ``_doc.*`` gives them back."""
    rows = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    return docs.select(rows, *[c.alias(name) for name, c in own.items()])


def rank(doc_id: str = "doc_id") -> Column:
    """Order of documents: by id, those without one last (and equal to each other)."""
    return F.coalesce(F.col(doc_id), F.lit(NO_ID))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, from which filters and bucket counts are sized."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).head()[0] or 0


def power_of_two(n: float, least: int, most: int) -> int:
    """Smallest power of two of at least ``n`` within the limits (themselves powers of two)."""
    return int(min(most, max(least, 1 << max(0, int(np.ceil(np.log2(max(n, 1))))))))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    """(first column, text in UTF-8) of each row; a null text is empty."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):  # few texts at a time as Python objects
            part = batch.slice(at, _ROWS)
            texts = part.column(1).cast(pa.binary()).to_pylist()
            for doc, text in zip(part.column(0).to_pylist(), texts, strict=True):
                yield doc, text or b""


def record(names: list[str], columns: list, types: list[pa.DataType]) -> pa.RecordBatch:
    """Record batch of Python or numpy columns."""
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names
    )


def cuts(keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values in a sorted array, and its length."""
    if not len(keys):
        return np.zeros(1, np.int64)
    change = np.flatnonzero(keys[1:] != keys[:-1])
    out = np.empty(len(change) + 2, np.int64)
    out[0], out[-1] = 0, len(keys)
    np.add(change, 1, out=out[1:-1])
    return out
