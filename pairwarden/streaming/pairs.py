"""Event pairs on streams: the skip-n pairs of a batch, within groups, as events arrive.

The state of a group is its rows that may still be overtaken by a late one, and the last n rows
before them. Once the watermark has passed a row its place in the order is final, and it is
paired with the n rows before it. So the stream gives the pairs the batch gives over the rows
before the last watermark; later ones wait for it to move on. A row that arrives after
the watermark has passed its time is late and left out. Rows of equal time are ordered by the
other order columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from pairwarden.session import ship_package

_AT = "_at"  # event time in microseconds


PAIR_ROWS = 1 << 16  # that are handed on at once


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows, PAIR_ROWS)
    return sink.getvalue().to_pybytes()


def _unpacked(held: bytes) -> pa.Table:
    return pa.ipc.open_stream(held).read_all()


def _joined(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts, promote_options="permissive")


def _pair_up(rows: pa.Table, final: int, tail: int, cols: Sequence[str], n: int) -> Iterator[pd.DataFrame]:
    """Pairs whose back row is one of the ``final`` rows after the first ``tail``."""
    chosen = rows.select(list(cols))
    for step in range(1, n + 1):
        for at in range(max(tail, step), tail + final, PAIR_ROWS):
            size = min(PAIR_ROWS, tail + final - at)
            front, behind = chosen.slice(at - step, size).to_pandas(), chosen.slice(at, size).to_pandas()
            part = {f"f_{c}": front[c].to_numpy() for c in cols} | {f"b_{c}": behind[c].to_numpy() for c in cols}
            yield pd.DataFrame(part | {"step": step})


def stream_skip_pairs(
    stream: DataFrame, time: str, ties: Sequence[str], cols: Sequence[str], by: Sequence[str], n: int = 1,
    delay: str = "10 minutes",
) -> DataFrame:
    """``skip_pairs`` with ``order`` (time, ties) on a stream; columns ``f_*``, ``b_*`` and ``step``.

    ``by`` names the groups, whose order is kept each for itself; null is a group. Rows without
    a time are left out. ``delay`` is how late a row may come.
    """
    ship_package(stream.sparkSession)
    kept = list(dict.fromkeys([*ties, *cols]))
    fields = {f.name: f.dataType for f in stream.schema.fields}
    moment = F.col(time).cast("timestamp")
    rows = stream.filter(F.col(time).isNotNull()).select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.unix_micros(moment).alias(_AT), *kept,
        moment.alias("_moment"),
    ).withWatermark("_moment", delay)
    order = [_AT, *ties]
    out = StructType([StructField(f"{s}_{c}", fields[c]) for s in "fb" for c in cols] + [StructField("step", LongType())])

    def pair(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, tail = (None, 0) if not state.exists else state.get
        now = state.getCurrentWatermarkMs() * 1000
        fresh = [] if state.hasTimedOut else [  # rows of the group are held in columns, as narrow as they are
            pa.Table.from_pandas(rows, preserve_index=False)
            for b in batches if len(rows := b.loc[b[_AT] >= now, [_AT, *kept]])  # others are late
        ]
        whole = None if held is None else _unpacked(held)
        del held
        if fresh:
            # only rows after the tail can still be overtaken
            waiting = [] if whole is None else [whole.slice(tail)]
            ordered = _joined([*waiting, *fresh])
            fresh.clear()
            ordered = ordered.sort_by([(c, "ascending") for c in order])
            whole = ordered if whole is None or not tail else _joined([whole.slice(0, tail), ordered])
            del waiting, ordered
        if whole is None or not len(whole):
            return
        final = pc.sum(pc.less(whole[_AT].slice(tail), now)).as_py() or 0
        if final:
            yield from _pair_up(whole, final, tail, cols, n)
        first = max(0, tail + final - n)
        left = whole.slice(first)
        state.update((_packed(left), tail + final - first))
        if len(left) > tail + final - first:  # something waits for the watermark
            state.setTimeoutTimestamp(max(now // 1000, left[_AT][tail + final - first].as_py() // 1000) + 1)

    groups = [f"_g{i}" for i in range(len(by))]
    return rows.groupBy(*groups).applyInPandasWithState(
        pair, out, "held binary, tail int", "append", GroupStateTimeout.EventTimeTimeout
    )
