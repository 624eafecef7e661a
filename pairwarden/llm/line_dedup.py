"""Line de-duplication with a once-seen and a twice-seen Bloom filter.

1. Every document sends the hashes of its distinct line keys to the two filters
   (``repeats.twice_seen``); lines themselves stay where they are.
2. Only lines that the twice-seen filter suspects are shuffled, as whole keys counted
   per task beforehand, and confirmed exactly: number of documents, first occurrence.
3. Confirmed keys go back to the documents: as a broadcast set up to a checked size,
   beyond it by joins on the key and then on the document.

A key is the line with ASCII white space stripped at both ends and A-Z lower-cased.
Every row is a document of its own. Null and empty texts are one empty line. Empty keys
are never dropped. Rows with a null id are treated like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwarden.llm.repeats import MAX_FILTER_BYTES, TwiceSeen, mixed, twice_seen
from pairwarden.llm.tables import NO_ID, narrow, rank, record, rows_of, text_bytes
from pairwarden.session import stage

MAX_BROADCAST_KEYS = 200_000
MAX_BROADCAST_BYTES = 32 << 20
_LINE_BYTES = 32  # a guess for sizing the filter only
_FLUSH_BYTES = 32 << 20
_BLANK = b" \t\n\x0b\x0c\r"


def line_keys(text: bytes) -> list[bytes]:
    return [line.strip(_BLANK).lower() for line in text.split(b"\n")]  # bytes.lower: A-Z only


def _hashes(keys: list[bytes]) -> np.ndarray:
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
    return mixed(h)


def _key_hashes(min_chars: int) -> Callable[[bytes], np.ndarray]:
    return lambda text: _hashes(_long_enough(set(line_keys(text)), min_chars))


def _long_enough(keys: set[bytes], min_chars: int) -> list[bytes]:
    if min_chars <= 1:
        return [k for k in keys if k]
    return [k for k in keys if len(k) >= min_chars and len(k.decode()) >= min_chars]


def _count_suspects(seen: TwiceSeen, min_chars: int):
    """Per task: suspected key, its documents and first place (document, line)."""

    def flush(held: dict[bytes, list]) -> pa.RecordBatch:
        docs, first, at = zip(*held.values(), strict=True)
        return record(["key", "docs", "doc", "line"], [list(held), docs, first, at],
                      [pa.binary(), pa.int64(), pa.int64(), pa.int64()])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0
        for doc, text in rows_of(batches):
            keys = line_keys(text)
            first = {k: i for i, k in zip(range(len(keys) - 1, -1, -1), reversed(keys), strict=True)}
            distinct = _long_enough(set(first), min_chars)
            if not distinct:
                continue
            for key in np.array(distinct, object)[seen(_hashes(distinct))]:
                place = (NO_ID if doc is None else doc, first[key])
                old = held.get(key)
                if old is None:
                    held[key] = [1, *place]
                    size += len(key) + 200
                else:
                    old[0] += 1
                    if place < (old[1], old[2]):
                        old[1:] = place
            if size > _FLUSH_BYTES:
                yield flush(held)
                held, size = {}, 0
        if held:
            yield flush(held)

    return count


def repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                   max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Keys found in at least ``min_docs`` documents: key (binary), docs, doc and line of the
    first occurrence (smallest id, a missing id last; then the smallest line number)."""
    docs = narrow(docs)
    seen = twice_seen(docs, _key_hashes(min_chars), text_bytes(docs) / _LINE_BYTES, max_filter_bytes)
    empty = docs.sparkSession.createDataFrame([], "key binary, docs long, doc long, line long")
    if seen is None:
        return empty
    counted = docs.mapInArrow(_count_suspects(seen, min_chars), empty.schema)
    return (
        counted.groupBy("key")
        .agg(F.sum("docs").alias("docs"), F.min(F.struct("doc", "line")).alias("at"))
        .filter(F.col("docs") >= min_docs)
        .select("key", "docs", "at.doc", "at.line")
    )


_RESULT = "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept string"


def _results(rows: Iterator[tuple], with_text: bool) -> Iterator[pa.RecordBatch]:
    """(id, lines, numbers of the lines that stay) to result batches."""
    out: list[tuple] = []
    size = 0
    for doc, lines, stay in rows:
        kept = b"\n".join([lines[i] for i in stay])
        out.append((doc, len(lines), len(lines) - len(stay), hashlib.sha256(kept).hexdigest(),
                    kept.decode() if with_text else None))
        size += len(kept) if with_text else 100
        if size > _FLUSH_BYTES:
            yield _result_batch(out)
            out, size = [], 0
    if out:
        yield _result_batch(out)


def _result_batch(out: list[tuple]) -> pa.RecordBatch:
    return record(["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept"], list(zip(*out, strict=True)),
                  [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()])


def _drop_known(known: dict[bytes, tuple[int, int]], keep_first: bool, with_text: bool):
    """Map side: lines whose key is in the broadcast set go."""

    def rows(batches):
        firsts = known.value
        for doc, text in rows_of(batches):
            lines, keys = text.split(b"\n"), line_keys(text)
            me = NO_ID if doc is None else doc
            yield doc, lines, [i for i, k in enumerate(keys)
                               if k not in firsts or keep_first and firsts[k] == (me, i)]

    return lambda batches: _results(rows(batches), with_text)


def _suspect_lines(seen: TwiceSeen, min_chars: int):
    """One row per suspected line: document, its text's hash, line number, key."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            marks = batch.column(2).to_pylist()
            for doc, text, mark in zip(ids, texts, marks, strict=True):
                keys = line_keys(text or b"")
                wanted = set(_long_enough(set(keys), min_chars))
                at = [i for i, k in enumerate(keys) if k in wanted]
                if not at:
                    continue
                own = [keys[i] for i in at]
                hit = seen(_hashes(own))
                at, own = np.array(at)[hit], [k for k, h in zip(own, hit, strict=True) if h]
                if own:
                    yield record(["rank", "mark", "line", "key"],
                                 [[NO_ID if doc is None else doc] * len(own), [mark] * len(own), at, own],
                                 [pa.int64(), pa.int64(), pa.int64(), pa.binary()])

    return find


def _drop_listed(with_text: bool):
    def rows(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for doc, text, gone in zip(ids, texts, batch.column(2).to_pylist(), strict=True):
                lines, gone = (text or b"").split(b"\n"), set(gone or ())
                yield doc, lines, [i for i in range(len(lines)) if i not in gone]

    return lambda batches: _results(rows(batches), with_text)


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False,
                        with_text: bool = True, max_filter_bytes: int = MAX_FILTER_BYTES,
                        max_broadcast_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """Drop the lines of keys found in at least ``min_docs`` documents.

    Returns doc_id, n_lines (before), n_dropped, kept_sha256 and, with ``with_text``, the
    remaining text ``kept``. ``keep_first`` keeps each key's first occurrence.
    """
    docs = narrow(docs)
    spark = docs.sparkSession
    keys = stage(repeated_lines(docs, min_docs, min_chars, max_filter_bytes), "lines")
    n, size = keys.agg(F.count("*"), F.coalesce(F.sum(F.length("key")), F.lit(0))).head()
    if n <= max_broadcast_keys and size <= MAX_BROADCAST_BYTES:
        known = {bytes(r.key): (r.doc, r.line) for r in keys.collect()}
        result = docs.mapInArrow(
            _drop_known(spark.sparkContext.broadcast(known), keep_first, with_text), _RESULT
        )
    else:
        seen = twice_seen(docs, _key_hashes(min_chars), text_bytes(docs) / _LINE_BYTES, max_filter_bytes)
        marked = docs.withColumn("mark", F.xxhash64("text"))
        found = marked.mapInArrow(
            _suspect_lines(seen, min_chars), "rank long, mark long, line long, key binary"
        ).join(keys.select("key", "doc", F.col("line").alias("first")), "key")
        if keep_first:
            found = found.filter((F.col("rank") != F.col("doc")) | (F.col("line") != F.col("first")))
        gone = found.groupBy("rank", "mark").agg(F.collect_set("line").alias("gone"))
        joined = (
            marked.withColumn("rank", rank())
            .join(gone, ["rank", "mark"], "left")
            .select("doc_id", "text", "gone")
        )
        result = joined.mapInArrow(_drop_listed(with_text), _RESULT)
    return result if with_text else result.drop("kept")
