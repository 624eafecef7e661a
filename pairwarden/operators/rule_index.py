"""Rule matching through an index, for rule tables of thousands of rows.

A rule's condition is split into clauses (any of them suffices) of atoms (all are needed). An
atom is an interval of one column; equality is an interval of one value. The bounds of all
atoms of a column, sorted, cut its values into cells, and an atom is a range of cells.

Every clause is filed under one of its atoms, the one expected to hold least often: under its
cell if that is an equality (a hash), else under the nodes of a tree over the cells that make up
its range. A row looks its cells up and finds the clauses filed there. For these the satisfied
atoms are counted, and a clause with all of them holds. Rows thus meet the rules that are
near to matching, not all rules.

Conditions are read by Spark's own parser. What is no interval (patterns, functions, mixed
types) leaves an atom out, so the index finds a superset for such a rule, and its whole
condition is evaluated on the rows it finds. A clause without any atom is met by every row.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from pairwarden.operators.rules import Rule
from pairwarden.session import ship_package

MAX_CLAUSES = 64  # of one rule; a condition with more is evaluated as it is
MAX_INDEX_NUMBERS = 50_000_000  # of all arrays of an index, which every task holds
_AT_ONCE = 2_000_000  # (row, clause) pairs that are compared at once
_PARSED = 500  # conditions handed to the parser at once


@dataclass(frozen=True)
class Atom:
    """An interval of a column; ``None`` is no bound."""

    column: str
    low: object = None
    low_in: bool = True
    high: object = None
    high_in: bool = True

    @property
    def point(self) -> bool:
        return self.low is not None and self.low == self.high


Clause = frozenset  # of atoms, all of which must hold
_TRUE: list[Clause] = [Clause()]


# ---- conditions to atoms -----------------------------------------------------------


@dataclass
class _Node:
    kind: str
    facts: dict
    parts: list = field(default_factory=list)


def _tree(rows) -> _Node:
    facts = next(rows)
    node = _Node(facts["class"].rpartition(".")[2], facts)
    node.parts = [_tree(rows) for _ in range(facts["num-children"])]
    return node


def _parsed(spark: SparkSession, conditions: Sequence[str]) -> list[_Node]:
    """Expression trees of Spark's parser, some hundred conditions at a time."""
    parser = spark._jsparkSession.sessionState().sqlParser()
    out = []
    for at in range(0, len(conditions), _PARSED):
        together = ", ".join(f"({c})" for c in conditions[at : at + _PARSED])
        out += _tree(iter(json.loads(parser.parseExpression(f"array({together})").toJSON()))).parts
    return out


_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_INDEXED = (*_WHOLE, DoubleType, StringType, TimestampType, TimestampNTZType)


def _literal(node: _Node, kind: DataType):
    """Value of a literal as the column compares it; None if it cannot be told here."""
    value, of = node.facts.get("value"), node.facts.get("dataType")
    if node.kind != "Literal" or value is None or not isinstance(of, str):
        return None
    number = of in ("byte", "short", "integer", "long")
    if isinstance(kind, _WHOLE):
        found = int(value) if number else Decimal(value) if of.startswith("decimal") else None
        return found if found is not None and abs(found) < 2**62 else None
    if isinstance(kind, DoubleType):
        exact = number or of.startswith("decimal") or of == "double"
        found = float(value) if exact else None
        return None if found is None or math.isnan(found) else found
    if isinstance(kind, StringType):
        return value.encode() if of == "string" else None
    return int(value) if of == kind.typeName() and value.lstrip("-").isdigit() else None


_MIRRORED = {
    "GreaterThan": "LessThan", "LessThan": "GreaterThan", "GreaterThanOrEqual": "LessThanOrEqual",
    "LessThanOrEqual": "GreaterThanOrEqual", "EqualTo": "EqualTo",
}


def _interval(column: str, kind: DataType, compare: str, value) -> Atom:
    if isinstance(kind, _WHOLE) and isinstance(value, Decimal):  # next whole number
        if value == value.to_integral_value():
            value = int(value)
        elif compare == "EqualTo":
            return Atom(column, 1, True, 0, True)  # never
        elif compare in ("GreaterThan", "GreaterThanOrEqual"):
            return Atom(column, low=math.floor(value) + 1)
        else:
            return Atom(column, high=math.floor(value))
    return {
        "EqualTo": lambda: Atom(column, value, True, value, True),
        "GreaterThan": lambda: Atom(column, low=value, low_in=False),
        "GreaterThanOrEqual": lambda: Atom(column, low=value),
        "LessThan": lambda: Atom(column, high=value, high_in=False),
        "LessThanOrEqual": lambda: Atom(column, high=value),
    }[compare]()


class _Reader:
    """Clauses of a condition; ``whole`` tells whether they say all of it."""

    def __init__(self, schema: StructType):
        self.kinds = {f.name.lower(): (f.name, f.dataType) for f in schema.fields}
        self.whole = True

    def clauses(self, node: _Node) -> list[Clause]:
        found = self._read(node)
        if found is None or len(found) > MAX_CLAUSES:
            self.whole = False
            return _TRUE
        return found

    def _column(self, node: _Node):
        if node.kind != "UnresolvedAttribute":
            return None
        name = self.kinds.get(node.facts["nameParts"][1:-1].lower())
        if name is None or not isinstance(name[1], _INDEXED):
            return None
        return None if isinstance(name[1], StringType) and name[1] != StringType() else name

    def _atom(self, compare: str, left: _Node, right: _Node) -> Atom | None:
        column = self._column(left)
        if column is None:
            column, right, compare = self._column(right), left, _MIRRORED[compare]
        value = None if column is None else _literal(right, column[1])
        return None if value is None else _interval(*column, compare, value)

    def _read(self, node: _Node) -> list[Clause] | None:
        if node.kind == "And":
            left, right = map(self.clauses, node.parts)
            return [a | b for a in left for b in right] if len(left) * len(right) <= MAX_CLAUSES else None
        if node.kind == "Or":
            return [*self.clauses(node.parts[0]), *self.clauses(node.parts[1])]
        if node.kind == "Literal" and node.facts.get("dataType") == "boolean":
            return _TRUE if node.facts.get("value") == "true" else []
        if node.kind in _MIRRORED:
            atom = self._atom(node.kind, *node.parts)
            return None if atom is None else [Clause([atom])]
        if node.kind == "In":
            atoms = [self._atom("EqualTo", node.parts[0], v) for v in node.parts[1:]]
            return None if None in atoms else [Clause([a]) for a in dict.fromkeys(atoms)]
        if node.kind == "UnresolvedFunction" and node.facts["nameParts"] == "[between]":
            ends = [self._atom(c, node.parts[0], v)
                    for c, v in zip(("GreaterThanOrEqual", "LessThanOrEqual"), node.parts[1:], strict=True)]
            return None if None in ends else [Clause(ends)]
        if node.kind == "Not" and node.parts[0].kind == "EqualTo":
            sides = [self._atom(c, *node.parts[0].parts) for c in ("LessThan", "GreaterThan")]
            return None if None in sides else [Clause([a]) for a in sides]
        return None


def _joined(clause: Clause) -> list[Atom] | None:
    """One interval per column; None if they exclude each other."""
    out: dict[str, Atom] = {}
    for a in clause:
        b = out.get(a.column, Atom(a.column))
        if a.low is not None and (b.low is None or (a.low, not a.low_in) > (b.low, not b.low_in)):
            b = Atom(b.column, a.low, a.low_in, b.high, b.high_in)
        if a.high is not None and (b.high is None or (a.high, a.high_in) < (b.high, b.high_in)):
            b = Atom(b.column, b.low, b.low_in, a.high, a.high_in)
        if b.low is not None and b.high is not None and (
            b.low > b.high or (b.low == b.high and not (b.low_in and b.high_in))
        ):
            return None
        out[a.column] = b
    return [out[c] for c in sorted(out)]


# ---- the index ---------------------------------------------------------------------


@dataclass(frozen=True)
class _Lists:
    """Lists of numbers, one after the other."""

    starts: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: Sequence[int], values: Sequence[int], size: int) -> _Lists:
        """List k holds the values whose key is k."""
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int64)
        starts = np.concatenate([[0], np.cumsum(np.bincount(keys, minlength=size))])
        return cls(starts, values[np.argsort(keys, kind="stable")])

    def sizes(self, of: np.ndarray) -> np.ndarray:
        return self.starts[of + 1] - self.starts[of]

    def expand(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``of``, value) of every value of the named lists."""
        sizes = self.sizes(of)
        owner = np.repeat(np.arange(len(of)), sizes)
        before = np.cumsum(sizes) - sizes
        return owner, self.values[np.arange(sizes.sum()) - before[owner] + self.starts[of][owner]]


class _Cells:
    """Cells of a column: bound i is cell 2 i + 1, what lies before it cell 2 i."""

    def __init__(self, kind: DataType, bounds: list):
        self.text = isinstance(kind, StringType)
        self.bounds = bounds if self.text else np.array(bounds, np.float64 if isinstance(kind, DoubleType) else np.int64)
        self.place = {b: 2 * i + 1 for i, b in enumerate(bounds)}
        self.count = 2 * len(bounds) + 1

    def span(self, atom: Atom) -> tuple[int, int]:
        low = 0 if atom.low is None else self.place[atom.low] + (not atom.low_in)
        high = self.count - 1 if atom.high is None else self.place[atom.high] - (not atom.high_in)
        return low, high

    def find(self, column: pa.Array) -> np.ndarray:
        """Cell of each value, -1 for null."""
        if self.text:
            coded = pc.dictionary_encode(column)
            cells = [self._of_text(v) for v in coded.dictionary.cast(pa.binary()).to_pylist()]
            cells = np.array([*cells, -1], np.int64)  # the last one is that of null
            return cells[coded.indices.fill_null(len(cells) - 1).to_numpy(zero_copy_only=False)]
        gone = column.is_null().to_numpy(zero_copy_only=False)
        if pa.types.is_timestamp(column.type):
            column = column.cast(pa.timestamp("us", column.type.tz)).cast(pa.int64())
        values = column.fill_null(0).to_numpy(zero_copy_only=False).astype(self.bounds.dtype, copy=False)
        at = np.searchsorted(self.bounds, values)
        exact = self.bounds[np.minimum(at, len(self.bounds) - 1)] == values
        return np.where(gone, -1, 2 * at + exact)

    def _of_text(self, value: bytes) -> int:
        found = self.place.get(value)
        return 2 * bisect_left(self.bounds, value) if found is None else found


@dataclass(frozen=True)
class _Filed:
    """Clauses filed under a column: by cell, and by node of a tree over the cells."""

    points: _Lists
    nodes: _Lists | None
    leaves: int  # of the tree, a power of two


def _nodes(low: int, high: int, leaves: int) -> list[int]:
    """Fewest nodes of the tree that make up cells low..high."""
    out, low, high = [], low + leaves, high + leaves + 1
    while low < high:
        if low & 1:
            out.append(low)
            low += 1
        if high & 1:
            high -= 1
            out.append(high)
        low, high = low >> 1, high >> 1
    return out


class RuleIndex:
    """Index over rules that read columns of one schema. Rows are matched batch by batch."""

    def __init__(self, rules: Sequence[Rule], clauses: Sequence[list[Clause]], schema: StructType):
        self.rule_of, atoms = [], []
        for rule, own in zip(rules, clauses, strict=True):
            for clause in {tuple(a) for a in map(_joined, own) if a is not None}:
                self.rule_of.append(rule.rule_id)
                atoms.append(clause)
        self.rule_of = np.array(self.rule_of, np.int64)
        bounds: dict[str, set] = {}
        for clause in atoms:
            for a in clause:
                bounds.setdefault(a.column, set()).update(v for v in (a.low, a.high) if v is not None)
        self.columns = sorted(c for c, b in bounds.items() if b)
        self.cells = [_Cells(schema[c].dataType, sorted(bounds[c])) for c in self.columns]
        place = {c: i for i, c in enumerate(self.columns)}
        spans = [[(place[a.column], *self.cells[place[a.column]].span(a)) for a in clause if a.column in place]
                 for clause in atoms]
        self.every = np.array([i for i, s in enumerate(spans) if not s], np.int64)
        filed = self._file(spans)
        rest = [[x for x in s if x != filed_under] for s, filed_under in zip(spans, filed, strict=True)]
        self.atoms = np.array([x for s in rest for x in s], np.int64).reshape(-1, 3)
        sizes = np.array([len(s) for s in rest], np.int64)
        self.needs = _Lists(np.concatenate([[0], np.cumsum(sizes)]), np.arange(len(self.atoms)))
        self.hull = self._hull(atoms)
        numbers = self.atoms.size + sum(len(f.points.values) + (len(f.nodes.values) if f.nodes else 0) for f in self.filed)
        if numbers > MAX_INDEX_NUMBERS:
            raise ValueError(f"an index of {numbers} numbers exceeds {MAX_INDEX_NUMBERS}; match the rules in parts")

    def _file(self, spans: list[list[tuple[int, int, int]]]) -> list[tuple[int, int, int] | None]:
        """Chooses the atom each clause is filed under: the one that fewest other clauses share,
        or that covers the smallest part of its column's intervals."""
        points = [np.zeros(c.count, np.int64) for c in self.cells]
        ranges = np.zeros(len(self.cells), np.int64)
        for clause in spans:
            for c, low, high in clause:
                if low == high:
                    points[c][low] += 1
                else:
                    ranges[c] += 1

        def shared(span) -> float:
            c, low, high = span
            if low == high:
                return points[c][low] / max(2, len(self.cells[c].bounds))
            return ranges[c] * (high - low + 1) / self.cells[c].count

        chosen = [min(s, key=shared) if s else None for s in spans]
        self.filed = []
        for c, cells in enumerate(self.cells):
            mine = [(i, s) for i, s in enumerate(chosen) if s and s[0] == c]
            leaves = 1 << max(0, cells.count - 1).bit_length()
            exact = [(s[1], i) for i, s in mine if s[1] == s[2]]
            wide = [(n, i) for i, s in mine if s[1] != s[2] for n in _nodes(s[1], s[2], leaves)]
            self.filed.append(_Filed(
                _Lists.of([k for k, _ in exact], [i for _, i in exact], cells.count),
                _Lists.of([k for k, _ in wide], [i for _, i in wide], 2 * leaves) if wide else None, leaves,
            ))
        return chosen

    def _hull(self, atoms) -> list[tuple[str, list | None, object, object]]:
        """(column, values if few, lowest, highest) of columns that every clause limits."""
        out = []
        for c in self.columns:
            own = [[a for a in clause if a.column == c] for clause in atoms]
            if not own or not all(own):
                continue
            flat = [a for x in own for a in x]
            values = {a.low for a in flat} if all(a.point for a in flat) else set()
            low = None if any(a.low is None for a in flat) else min(a.low for a in flat)
            high = None if any(a.high is None for a in flat) else max(a.high for a in flat)
            if low is not None or high is not None:
                out.append((c, sorted(values) if 0 < len(values) <= MAX_CLAUSES else None, low, high))
        return out

    def match(self, columns: Sequence[pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, rule id) of every match, sorted by both, each once."""
        cells = [c.find(a) for c, a in zip(self.cells, columns, strict=True)]
        rows, rules = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for low, high in self._slices(cells, n):
            row, clause = self._candidates([c[low:high] for c in cells], high - low)
            held = self._holds(cells, row + low, clause)
            rows.append(row[held] + low)
            rules.append(self.rule_of[clause[held]])
        row, rule = np.concatenate(rows), np.concatenate(rules)
        order = np.lexsort((rule, row))
        row, rule = row[order], rule[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (rule[1:] != rule[:-1])
        return row[new], rule[new]

    def _visits(self, cells: list[np.ndarray]) -> Iterator[tuple[_Lists, np.ndarray, np.ndarray]]:
        """(lists, rows, list that each row reads) of each place that rows look up."""
        for found, filed in zip(cells, self.filed, strict=True):
            known = np.flatnonzero(found >= 0)
            if len(filed.points.values):
                yield filed.points, known, found[known]
            if filed.nodes is not None:
                node = found[known] + filed.leaves
                while len(node) and node[0]:
                    yield filed.nodes, known, node
                    node = node >> 1

    def _slices(self, cells: list[np.ndarray], n: int) -> Iterator[tuple[int, int]]:
        """Ranges of rows that find at most about ``_AT_ONCE`` clauses."""
        found = np.full(n, len(self.every) + 1, np.int64)
        for lists, rows, of in self._visits(cells):
            found[rows] += lists.sizes(of)
        at, upto = 0, np.cumsum(found)
        while at < n:
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + _AT_ONCE, "right")))
            yield at, end
            at = end

    def _candidates(self, cells: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        rows = [np.repeat(np.arange(n), len(self.every))]
        clauses = [np.tile(self.every, n)]
        for lists, known, of in self._visits(cells):
            owner, clause = lists.expand(of)
            rows.append(known[owner])
            clauses.append(clause)
        return np.concatenate(rows), np.concatenate(clauses)

    def _holds(self, cells: list[np.ndarray], row: np.ndarray, clause: np.ndarray) -> np.ndarray:
        """Whether the other atoms of each candidate hold too: satisfied ones are counted."""
        if not len(self.atoms):
            return np.ones(len(row), bool)
        needed = self.needs.sizes(clause)
        pair, atom = self.needs.expand(clause)
        satisfied = np.zeros(len(row), np.int64)
        for c, found in enumerate(cells):
            mine = np.flatnonzero(self.atoms[atom, 0] == c)
            value, bounds = found[row[pair[mine]]], self.atoms[atom[mine]]
            good = (value >= bounds[:, 1]) & (value <= bounds[:, 2]) & (value >= 0)
            satisfied += np.bincount(pair[mine[good]], minlength=len(row))
        return satisfied == needed


# ---- matching ----------------------------------------------------------------------


def build_index(spark: SparkSession, rules: Sequence[Rule], schema: StructType) -> tuple[RuleIndex, list[Rule]]:
    """The index and the rules whose condition must be evaluated on what it finds."""
    found, partly = [], []
    for rule, node in zip(rules, _parsed(spark, [r.condition() for r in rules]), strict=True):
        reader = _Reader(schema)
        found.append(reader.clauses(node))
        if not reader.whole:
            partly.append(rule)
    return RuleIndex(rules, found, schema), partly


def _value(value, kind: DataType) -> Column:
    if isinstance(value, bytes):
        return F.lit(value.decode())
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(F.lit(value))
    if isinstance(kind, TimestampNTZType):
        return F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {value} / 1000000.0bd)")
    return F.lit(value)


def _limited(df: DataFrame, index: RuleIndex) -> DataFrame:
    """Rows inside the hull of all rules, a filter that the scan can use."""
    for name, values, low, high in index.hull:
        kind, column = df.schema[name].dataType, F.col(f"`{name}`")
        if values is not None:
            df = df.filter(column.isin(*[_value(v, kind) for v in values]))
            continue
        tests = [column >= _value(low, kind)] if low is not None else []
        tests += [column <= _value(high, kind)] if high is not None else []
        df = df.filter(reduce(lambda a, b: a & b, tests))
    return df


def match_rules_indexed(df: DataFrame, rules: Sequence[Rule], time: str = "time") -> DataFrame:
    """Same rows as ``match_rules``, one per (event, rule) that holds, for many rules.

    Works on batches and streams. Only the columns that rules read go to the index; a null is
    in no interval. Rules with a condition beyond intervals are listed in one expression, so
    they cost as much each as in ``match_rules``, but only on the rows the index finds.
    """
    ship_package(df.sparkSession)
    index, partly = build_index(df.sparkSession, rules, df.schema)
    names = index.columns or [df.columns[0]]

    def find(*columns: pa.Array) -> pa.Array:
        n = len(columns[0])
        row, rule = index.match(columns[: len(index.columns)], n)
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rule, pa.int64()))

    limited = _limited(df, index) if not len(index.every) else df
    hits = F.arrow_udf(find, "array<long>")(*[F.col(f"`{c}`") for c in names])
    out = limited.withColumn("single_rule", F.explode(hits))
    if partly:
        whole = reduce(
            lambda case, r: case.when(F.col("single_rule") == r.rule_id, F.expr(r.condition())),
            islice(partly, 1, None), F.when(F.col("single_rule") == partly[0].rule_id, F.expr(partly[0].condition())),
        )
        out = out.filter(whole.otherwise(True))
    return out if time == "time" else out.withColumn("time", F.col(time))
