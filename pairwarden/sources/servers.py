"""Many servers as one data source, with the filter at the source.

Each server is a partition that one task reads. Comparisons of columns with constants go to the
server, which returns only rows that pass; every row carries the server's name. As a stream,
an offset is the newest time each server has had; a batch is what each server has after the last
offset up to the next, so a server that is behind is not waited for.

What a server is, is up to a ``Connection``: it answers a range query and tells its newest time.
``ParquetConnection`` reads a folder of Parquet files, by row groups.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructField, StructType, StringType

from pairwarden.session import ship_package

Test = tuple[str, str, object]  # column, comparison, constant
_COMPARISONS = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
_EPOCH = datetime(1970, 1, 1)


class Connection:
    """How to ask a server; made in the task that reads it, with its address."""

    def __init__(self, address: str):
        self.address = address

    def rows(self, columns: Sequence[str], tests: Sequence[Test]) -> Iterator[pa.RecordBatch]:
        """Rows for which all tests hold, with the named columns."""
        raise NotImplementedError

    def newest(self, column: str) -> datetime | None:
        """Largest value of a time column; None without rows."""
        raise NotImplementedError


class ParquetConnection(Connection):
    """A folder of Parquet files, or one; row groups that the tests rule out are not read."""

    def _data(self) -> ds.Dataset:
        return ds.dataset(self.address.removeprefix("file:"), format="parquet")

    def _compared(self, data: ds.Dataset, test: Test):
        column, compare, value = test
        kind = data.schema.field(column).type
        if pa.types.is_timestamp(kind):
            aware = kind.tz is not None
            value = value if (value.tzinfo is not None) == aware else (
                value.replace(tzinfo=UTC) if aware else value.astimezone(UTC).replace(tzinfo=None))
        constant, field = pa.scalar(value, type=kind), ds.field(column)
        return {"==": field == constant, ">": field > constant, ">=": field >= constant, "<": field < constant,
                "<=": field <= constant}[compare]

    def rows(self, columns: Sequence[str], tests: Sequence[Test]) -> Iterator[pa.RecordBatch]:
        data, where = self._data(), None
        for test in tests:
            one = self._compared(data, test)
            where = one if where is None else where & one
        yield from data.to_batches(columns=list(columns), filter=where)

    def newest(self, column: str) -> datetime | None:
        found = None
        for batch in self._data().to_batches(columns=[column]):
            most = pc.max(batch.column(0)).as_py()
            found = most if found is None or (most is not None and most > found) else found
        return None if found is None else found.replace(tzinfo=None)


def _connection(name: str) -> type[Connection]:
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


@dataclass
class _Server(InputPartition):
    name: str
    address: str
    tests: list[Test]


class _Reading:
    """What batches and streams share."""

    def __init__(self, options: Mapping[str, str], schema: StructType):
        self.servers = json.loads(options["servers"])
        self.connection, self.tag = options["connection"], options["tag"]
        self.time = options.get("time")
        self.columns = [f.name for f in schema.fields if f.name != self.tag]
        self.names = [f.name for f in schema.fields]
        self.tests: list[Test] = []

    def read(self, partition: _Server) -> Iterator[pa.RecordBatch]:
        for batch in _connection(self.connection)(partition.address).rows(self.columns, partition.tests):
            if batch.num_rows:
                tagged = dict(zip(self.columns, batch.columns, strict=True))
                tagged[self.tag] = pa.array([partition.name] * batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([tagged[n] for n in self.names], names=self.names)


class _Reader(_Reading, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return [_Server(n, a, list(self.tests)) for n, a in self.servers.items()] or [_Server("", "", None)]

    def read(self, partition: _Server) -> Iterator[pa.RecordBatch]:
        return iter(()) if partition.tests is None else super().read(partition)


class _FilteringReader(_Reader):
    """Takes the comparisons it can hand on; Spark keeps the others."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            compare = _COMPARISONS.get(type(f))
            if compare is None or len(f.attribute) != 1:
                yield f
            elif f.attribute[0] == self.tag:
                if compare == "==":
                    self.servers = {n: a for n, a in self.servers.items() if n == f.value}
                else:
                    yield f
            else:
                self.tests.append((f.attribute[0], compare, f.value))


class _StreamReader(_Reading, DataSourceStreamReader):
    """Offsets: microseconds of the newest time read, by server."""

    def initialOffset(self) -> dict:
        return {name: None for name in self.servers}

    def latestOffset(self) -> dict:
        found = {n: _connection(self.connection)(a).newest(self.time) for n, a in self.servers.items()}
        return {n: None if at is None else _micros(at) for n, at in found.items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for name, address in self.servers.items():
            last, upto = start.get(name), end.get(name)
            if upto is None or last == upto:
                continue
            tests = [(self.time, "<=", _moment(upto))] + ([] if last is None else [(self.time, ">", _moment(last))])
            out.append(_Server(name, address, tests))
        return out

    def commit(self, end: dict) -> None:
        """Nothing to do: servers keep their rows."""


def _micros(at: datetime) -> int:
    span = at - _EPOCH
    return (span.days * 86_400 + span.seconds) * 1_000_000 + span.microseconds


def _moment(micros: int) -> datetime:
    return _EPOCH + timedelta(microseconds=micros)


class ServerSource(DataSource):
    """Format ``servers``: options servers (name and address each, as JSON), connection
    (module:class), tag (column of the name), and time (a stream's time column)."""

    @classmethod
    def name(cls) -> str:
        return "servers"

    def reader(self, schema: StructType) -> DataSourceReader:
        return (_FilteringReader if self.options["push"] == "true" else _Reader)(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options, schema)


_PUSH = "spark.sql.python.filterPushdown.enabled"
PARQUET = "pairwarden.sources.servers:ParquetConnection"


def _prepared(spark: SparkSession, reader, servers: Mapping[str, str], schema: StructType, connection: str, tag: str):
    ship_package(spark)
    spark.dataSource.register(ServerSource)
    whole = StructType([*schema.fields, StructField(tag, StringType())])
    return reader.format("servers").schema(whole).option("servers", json.dumps(dict(servers))).option(
        "connection", connection).option("tag", tag).option("push", spark.conf.get(_PUSH, "false"))


def read_servers(
    spark: SparkSession, servers: Mapping[str, str], schema: StructType, connection: str = PARQUET,
    tag: str = "clickhouse_server",
) -> DataFrame:
    """All servers stacked and tagged; comparisons with constants are made at the source.

    The session's ``spark.sql.python.filterPushdown.enabled`` must be on for that; without it
    Spark filters the rows after they are read, with the same result.
    """
    return _prepared(spark, spark.read, servers, schema, connection, tag).load()


def stream_servers(
    spark: SparkSession, servers: Mapping[str, str], schema: StructType, time: str, connection: str = PARQUET,
    tag: str = "clickhouse_server",
) -> DataFrame:
    """The same as a stream of what servers add in the order of ``time``. Rows must not arrive at a
    server with a time that it has passed; rows without a time are left out."""
    return _prepared(spark, spark.readStream, servers, schema, connection, tag).option("time", time).load()
