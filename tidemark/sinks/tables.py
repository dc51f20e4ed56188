"""Parquet tables that outlive the session: creation, append, whole replacement, upsert."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.upsert import align, outdated, upsert, without_outdated
from tidemark.schemas import TableSpec
from tidemark.sinks.folders import Folders

SPEC = "spec.json"
PART = "part"
PART_BYTES = 256 << 20
MOST_PARTS = 4096
# A task that holds rows of every part writes a file for each; of so many, without a shuffle.
FEW_PARTS = 16
# Outdated keys that may be broadcast: of more, the driver would hold a hundred bytes each.
BROADCAST_KEYS = 100_000
# For a first load of which Spark cannot tell the size.
FIRST_PARTS = 16
# A size above this is a guess of Spark's that stands for "unknown".
UNKNOWN_BYTES = 1 << 60
NO_KEY = f"{PART}=__HIVE_DEFAULT_PARTITION__"

_CHANGE = re.compile(r"(replace|upsert|append)-(\d{10})-(\d+)-([\w.-]+)")


@dataclass(frozen=True)
class Change:
    """One finished write: its folder, and the parts (folders below it) that it wrote."""

    kind: str
    number: int
    parts: int
    id: str
    folder: str
    written: tuple[str, ...]


@dataclass(frozen=True)
class State:
    """The finished writes that count, from the last whole replacement on."""

    changes: tuple[Change, ...]
    known: frozenset[str]
    next: int

    @property
    def parts(self) -> int | None:
        """The number of parts by key; 0 for a table without; None before the first write."""
        return self.changes[0].parts if self.changes else None

    def folders(self, parts: set[int] | None = None) -> list[str]:
        """The folders with the current rows, of some parts or of all.

        An upsert takes the place of what it wrote; an append, and rows without a key, are added.
        """
        wanted = None if parts is None else {f"{PART}={p}" for p in parts}
        found: dict[str, list[str]] = {}
        for change in self.changes:
            for name in change.written:
                if wanted is not None and name not in wanted:
                    continue
                if change.kind == "upsert" and name != NO_KEY:
                    found[name] = []
                found.setdefault(name, []).append(f"{change.folder}/{name}".rstrip("/"))
        return [path for paths in found.values() for path in paths]


class Database:
    """The tables of one database, each below ``<root>/<database>/<table>/``.

    Rows are partitioned by ``pmod(xxhash64(key), parts)``. Every change is one Spark write to a
    folder of its own, named by kind, number and id; Spark's ``_SUCCESS`` in it says that it is
    finished. The newest whole replacement holds the rows, except for the parts that a later
    upsert wrote: an upsert reads and writes the parts of its batch's keys and no other. So a
    reader, or a job that fails half way, sees the old rows or the new, and the new may be
    computed from the old. Nothing is kept in the session or a catalog: any other session reads
    and changes the tables too. One writer at a time changes a table.

    A change may be given an id, such as a run's or a micro-batch's: one that is finished already is
    not done again, so a repeated job adds nothing.

    A part larger than others (few keys, much repeated) is several files of several tasks. Rows
    of a table with a time column are ranged by it within a part, so that a window opens few files
    and pages. ``parts`` is the number of parts, 0 for rows written as they come, which suits
    tables that are only replaced; by default it follows the size, one per PART_BYTES.
    """

    def __init__(
        self, spark: SparkSession, name: str, root: str, parts: int | None = None
    ) -> None:
        self.spark = spark
        self.name = name
        self.root = f"{root.rstrip('/')}/{name}"
        self.parts = parts

    def create(self, *specs: TableSpec) -> Database:
        """Creates tables that do not exist; one that exists with another schema is an error."""
        for spec in specs:
            if not self.exists(spec.name):
                held = {
                    "schema": json.loads(spec.schema.json()), "key": spec.key,
                    "distribute_on": spec.distribute_on, "sort_by": spec.sort_by,
                }
                self._at(spec.name).put(SPEC, json.dumps(held))
            elif self.spec(spec.name).schema != spec.schema:
                raise ValueError(f"table {self.name}.{spec.name} exists with another schema")
        return self

    def exists(self, table: str) -> bool:
        return self._at(table).exists(SPEC)

    def drop(self, *tables: str) -> None:
        """Removes tables where they exist."""
        for table in tables:
            self._at(table).delete()

    def spec(self, table: str) -> TableSpec:
        at = self._at(table)
        if not at.exists(SPEC):
            raise ValueError(f"there is no table {self.name}.{table} below {self.root}")
        held = json.loads(at.text(SPEC))
        schema = StructType.fromJson(held["schema"])
        return TableSpec(table, schema, held["key"], held["distribute_on"], held["sort_by"])

    def schema(self, table: str) -> StructType:
        return self.spec(table).schema

    def state(self, table: str) -> State:
        """What the folder names say. A folder without ``_SUCCESS`` is of a write that failed."""
        at, changes, known, last = self._at(table), [], set(), 0
        for folder in at.names():
            match = _CHANGE.fullmatch(folder)
            if not match:
                continue
            last = max(last, int(match[2]))
            names = at.names(folder)
            if "_SUCCESS" not in names:
                continue
            known.add(match[4])
            parts = int(match[3])
            written = tuple(n for n in names if n.startswith(f"{PART}=")) if parts else ("",)
            changes.append(Change(match[1], int(match[2]), parts, match[4], folder, written))
        changes.sort(key=lambda c: c.number)
        whole = [i for i, c in enumerate(changes) if c.kind == "replace"]
        return State(tuple(changes[whole[-1]:] if whole else ()), frozenset(known), last + 1)

    def read(self, table: str, change: str | None = None) -> DataFrame:
        """The rows of a table; or, of those, the ones in the parts that a change wrote.

        All rows of a key are in one part, so what a change did to its keys is seen in these.
        """
        spec, state = self.spec(table), self.state(table)
        return self._load(spec, state.folders(
            None if change is None else self._parts_of(table, state, change)
        ))

    def around(self, table: str, change: str) -> tuple[DataFrame, DataFrame]:
        """The rows before and after a change, of the parts that it wrote.

        As long as the folders it took the place of have not expired. After a whole replacement,
        nothing is before and all is after.
        """
        spec, state = self.spec(table), self.state(table)
        at = self._index_of(table, state, change)
        done = state.changes[:at + 1]
        if done[-1].kind == "replace":
            return self._load(spec, []), self._load(spec, State(done, state.known, 0).folders())
        parts = self._parts_of(table, state, change)
        sides = (State(c, state.known, 0).folders(parts) for c in (done[:-1], done))
        before, after = ([*folders] for folders in sides)
        if NO_KEY in done[-1].written:
            after.append(f"{done[-1].folder}/{NO_KEY}")
        return self._load(spec, before), self._load(spec, after)

    def is_whole(self, table: str, change: str) -> bool:
        """Whether a change replaced the whole table (also an upsert of a table without parts)."""
        state = self.state(table)
        return state.changes[self._index_of(table, state, change)].kind == "replace"

    def is_empty(self, table: str) -> bool:
        return self.read(table).isEmpty()

    def append(
        self, table: str, df: DataFrame, change: str | None = None, dealt: bool = False
    ) -> None:
        """Adds rows. Columns are matched by position, whatever they are called.

        ``dealt`` says that a shuffle has just spread the rows evenly: into few parts they are
        then written from where they are.
        """
        spec, state = self.spec(table), self.state(table)
        rows = df.toDF(*spec.columns)
        if state.parts is None:
            self.replace(table, rows, change)
        elif change not in state.known:
            self._write("append", spec, state, rows, change, dealt=dealt)

    def replace(
        self, table: str, df: DataFrame, change: str | None = None, as_is: bool = False,
        dealt: bool = False,
    ) -> None:
        """Makes ``df`` the content of the table. Columns are matched by name.

        With ``as_is`` the rows are written as they come, without parts or order, hence without a
        shuffle: for what is read once and whole, like staging. ``dealt`` is as in ``append``.
        """
        spec, state = self.spec(table), self.state(table)
        if change not in state.known:
            parts = 0 if as_is else self._part_count(table, state, df)
            self._write("replace", spec, state, df, change, parts, not as_is, dealt)

    def upsert(
        self, table: str, batch: DataFrame, change: str | None = None, newest: str | None = None
    ) -> None:
        """Rows of ``batch`` take the place of the rows that have their key.

        With ``newest`` (a column) a key keeps, of its old and new rows, those with the highest
        value. Only parts with keys of the batch are read and written; the batch itself is read
        more than once, so it should be cheap to read.
        """
        spec, state = self.spec(table), self.state(table)
        if change in state.known:
            return
        rows = align(batch, spec.schema)
        if not state.parts:
            parts = self._part_count(table, state, batch)
            target = self._load(spec, state.folders())
            with self._merged(spec, target, rows, newest) as new:
                self._write("replace", spec, state, new, change, parts)
            return
        touched = {0}
        if state.parts > 1:
            # At most as many numbers as parts.
            numbers = rows.select(self._part(spec, state.parts)).distinct().collect()
            touched = {r[PART] for r in numbers} - {None}
        has_key = F.col(spec.key).isNotNull()
        target = self._load(spec, state.folders(touched))
        with self._merged(spec, target, rows.where(has_key), newest) as new:
            new = new.unionByName(rows.where(~has_key))
            self._write("upsert", spec, state, new, change)

    @contextmanager
    def _merged(
        self, spec: TableSpec, target: DataFrame, batch: DataFrame, newest: str | None
    ) -> Iterator[DataFrame]:
        """What an upsert makes of two sides, for the time of the block."""
        if not newest:
            yield upsert(target, batch, [spec.key])
            return
        # As ``upsert_newest``, with the outdated keys found first: by their size Spark then knows
        # whether all rows must be shuffled to meet them.
        found = outdated(target, batch, [spec.key], newest).persist()
        try:
            # What Spark knows of their size is that of compressed columns.
            few = found.count() <= BROADCAST_KEYS
            yield without_outdated(
                target, batch, found if few else found.hint("merge"), [spec.key], newest
            )
        finally:
            found.unpersist()

    def compact(self, table: str) -> None:
        """Writes the table anew, with parts for its present size and no changes to look through."""
        if len(self.state(table).changes) > 1:
            self.replace(table, self.read(table))

    def expire(self, table: str, min_age_hours: float = 24) -> list[str]:
        """Removes the folders that hold no current row, if they are older than ``min_age_hours``.

        Younger ones may belong to a writer at work, and readers that began before the last
        change need its predecessors for as long as they run. The ids of removed changes are
        forgotten.
        """
        at, state = self._at(table), self.state(table)
        before = int((time.time() - 3600 * min_age_hours) * 1000)
        live, kept = set(state.folders()), {c.folder for c in state.changes}
        unused = [n for n in at.names() if _CHANGE.fullmatch(n) and n not in kept]
        unused += [
            path for c in state.changes for name in c.written if name
            if (path := f"{c.folder}/{name}") not in live
        ]
        gone = [name for name in unused if at.changed_ms(name) < before]
        for name in gone:
            at.delete(name)
        return gone

    def _at(self, table: str) -> Folders:
        return Folders(self.spark, f"{self.root}/{table}")

    def _index_of(self, table: str, state: State, change: str) -> int:
        found = [i for i, c in enumerate(state.changes) if c.id == change]
        if not found:
            raise ValueError(f"table {self.name}.{table} has no change {change} that counts")
        return found[0]

    def _parts_of(self, table: str, state: State, change: str) -> set[int]:
        return {
            int(name.removeprefix(f"{PART}="))
            for name in state.changes[self._index_of(table, state, change)].written
            if name not in ("", NO_KEY)
        }

    def _part(self, spec: TableSpec, parts: int) -> Column:
        number = F.pmod(F.xxhash64(spec.key), F.lit(parts)).cast("int")
        return F.when(F.col(spec.key).isNotNull(), number).alias(PART)

    def _load(self, spec: TableSpec, folders: list[str]) -> DataFrame:
        if not folders:
            # The limit tells the optimizer that there is nothing, so joins with it go.
            return self.spark.createDataFrame([], spec.schema).limit(0)
        paths = [f"{self.root}/{spec.name}/{folder}" for folder in folders]
        return self.spark.read.schema(spec.schema).parquet(*paths)

    def _write(
        self, kind: str, spec: TableSpec, state: State, df: DataFrame, change: str | None,
        parts: int | None = None, ordered: bool = True, dealt: bool = False,
    ) -> None:
        parts = state.parts if parts is None else parts
        name = f"{kind}-{state.next:010d}-{parts}-{change or uuid.uuid4().hex}"
        if not _CHANGE.fullmatch(name):
            raise ValueError(f"a change's id is made of letters, digits, _, . and -, not {change}")
        rows = align(df, spec.schema)
        order = [spec.sort_by, spec.key] if spec.sort_by else []
        if parts:
            rows = rows.select("*", self._part(spec, parts))
            order = [PART, *order]
        if spec.sort_by and ordered:
            # The key as well, so that one time with very many rows is many files.
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        elif parts > (FEW_PARTS if dealt else 1):
            rows = rows.hint("rebalance", PART)
        writer = rows.write.partitionBy(PART) if parts else rows.write
        writer.parquet(f"{self.root}/{spec.name}/{name}")

    def _part_count(self, table: str, state: State, df: DataFrame) -> int:
        if self.parts is not None:
            return self.parts
        at = self._at(table)
        size = sum(at.bytes(folder) for folder in state.folders())
        if not size:
            size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
            if size > UNKNOWN_BYTES:
                return FIRST_PARTS
        return min(MOST_PARTS, max(1, -(-size // PART_BYTES)))
