"""Tables under one folder that change together.

New data goes to a folder of its own for each run, ``<table>/version=<run>/[fecha=…]``, which nobody
reads yet. One small file, ``_manifest/<number>.json``, says which version of each table, or of
each date of a table, holds; renaming the next one into place publishes everything at once. A run
that ends before that changes nothing, and readers keep the state they began with until two more
have been published. What no kept manifest names is swept.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gondola.sources.files import (
    delete_folder,
    list_names,
    read_or_empty,
    read_text,
    rename_new,
    write_by_date,
    write_text,
)

MANIFESTS = "_manifest"
_NUMBER = re.compile(r"(\d{9})\.json")
_FOLDER = re.compile(r"fecha=(\d{4}-\d{2}-\d{2})")
_VERSION = re.compile(r"version=(\w+)")
#: Key of a table that isn't partitioned; the version of files that no run published.
WHOLE, PLAIN = "", ""
#: Manifests that are kept besides the newest one, with the files they name.
KEPT = 2


class Conflict(RuntimeError):
    """Another run published after this one began."""


@dataclass
class State:
    """What a manifest says: for each table, by date, the version that holds."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)


def manifests(spark: SparkSession, root: str) -> list[int]:
    found = (_NUMBER.fullmatch(name) for name in list_names(spark, f"{root}/{MANIFESTS}"))
    return sorted(int(n[1]) for n in found if n)


def load_state(spark: SparkSession, root: str, number: int | None = None) -> State:
    """The newest state, or that of a number; an empty one if nothing was published."""
    numbers = manifests(spark, root) if number is None else [number]
    if not numbers:
        return State()
    return State(numbers[-1], json.loads(read_text(spark, f"{root}/{MANIFESTS}/{numbers[-1]:09}.json")))


def _folders(spark: SparkSession, path: str) -> list[str]:
    found = (_FOLDER.fullmatch(name) for name in list_names(spark, path))
    return sorted(f[1] for f in found if f)


class Published:
    """Reader of the tables under ``root``, in the state at the time of its making. Tables of plain
    ``fecha`` folders, as other programs write them, are read until a run publishes them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.state = load_state(spark, root)

    def _versions(self, table: str) -> dict[str, str]:
        if table in self.state.tables:
            return self.state.tables[table]
        return dict.fromkeys(_folders(self.spark, f"{self.root}/{table}"), PLAIN)

    def has(self, table: str) -> bool:
        return bool(self._versions(table))

    def dates(self, table: str) -> list[dt.date]:
        return [dt.date.fromisoformat(d) for d in sorted(self._versions(table)) if d != WHOLE]

    def read(self, table: str, schema: T.StructType, dates: Iterable[dt.date] | None = None, plain_reader: Callable[..., DataFrame] = read_or_empty) -> DataFrame:
        """A table, or some dates of it; an empty frame if there is none. Only the folders that hold
        are listed and read, plain ones by ``plain_reader``: published ones have the declared types."""
        base, versions = f"{self.root}/{table}", self._versions(table)
        if dates is not None:
            wanted = {d.isoformat() for d in dates}
            versions = {d: v for d, v in versions.items() if d in wanted}
        plain = [f"{base}/fecha={d}" for d, v in versions.items() if v == PLAIN]
        own = [f"{base}/version={v}" + (f"/fecha={d}" if d else "") for d, v in sorted(versions.items()) if v != PLAIN]
        # Without ``fecha`` folders and without a manifest there may still be plain files.
        if not plain and not own and table not in self.state.tables and dates is None:
            plain = [f"{base}/{name}" for name in list_names(self.spark, base) if name.endswith(".parquet")]
        if not plain and not own:
            return self.spark.createDataFrame([], schema)
        readers = ((plain_reader, plain), (read_or_empty, own))
        frames = [reader(self.spark, paths, schema, basePath=base) for reader, paths in readers if paths]
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


class Draft(Published):
    """A run's own view: what it has put so far over the state it began with. Nothing is visible to
    others before ``publish``."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.version = uuid.uuid4().hex
        self.base = self.state.number
        # Plain tables are named by the first manifest, like all others.
        tables = [n for n in list_names(spark, root) if not n.startswith("_")] if not self.base else []
        self.state = State(self.base, {t: dict(v) for t, v in self.state.tables.items()})
        for table in tables:
            if versions := dict.fromkeys(_folders(spark, f"{root}/{table}"), PLAIN):
                self.state.tables[table] = versions

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}/version={self.version}"

    def put_dates(self, table: str, df: DataFrame, order: Sequence[str] = (), whole: bool = False) -> list[str]:
        """Replace the dates that the frame holds, or all dates with ``whole``; returns them."""
        write_by_date(df, self._path(table), order, whole=True)
        dates = _folders(self.spark, self._path(table))
        before = {} if whole else self.state.tables.get(table, {})
        self.state.tables[table] = {**before, **dict.fromkeys(dates, self.version)}
        return dates

    def put(self, table: str, df: DataFrame) -> None:
        """Replace a table without partitions."""
        df.write.mode("overwrite").option("compression", "snappy").parquet(self._path(table))
        self.state.tables[table] = {WHOLE: self.version}

    def drop_dates(self, table: str, dates: Iterable[dt.date]) -> None:
        for day in dates:
            self.state.tables.get(table, {}).pop(day.isoformat(), None)

    def publish(self) -> int:
        """Make all that was put valid, at once; returns the manifest's number."""
        number = self.base + 1
        folder = f"{self.root}/{MANIFESTS}"
        aside = f"{folder}/_{self.version}"
        write_text(self.spark, aside, json.dumps(self.state.tables, sort_keys=True))
        if not rename_new(self.spark, aside, f"{folder}/{number:09}.json"):
            delete_folder(self.spark, aside)
            raise Conflict(f"state {number} of {self.root} was published by another run")
        self.base = self.state.number = number
        return number

    def discard(self) -> None:
        """Remove what was put and not published."""
        for table in self.state.tables:
            delete_folder(self.spark, self._path(table))


def sweep(spark: SparkSession, root: str, kept: int = KEPT) -> list[str]:
    """Delete versions and plain dates that neither the newest manifest nor the ``kept`` ones before
    it name, and older manifests; returns the deleted folders. Not to be called while a run writes:
    what it hasn't published yet is named by none."""
    numbers = manifests(spark, root)
    held = numbers[-kept - 1 :]
    states = [load_state(spark, root, n) for n in held]
    gone = []
    for table in sorted({t for s in states for t in s.tables}):
        named = {(d, v) for s in states for d, v in s.tables.get(table, {}).items()}
        versions = {v for _, v in named}
        for name in list_names(spark, f"{root}/{table}"):
            version, day = _VERSION.fullmatch(name), _FOLDER.fullmatch(name)
            if version and version[1] not in versions or day and (day[1], PLAIN) not in named:
                gone.append(f"{root}/{table}/{name}")
            elif version:
                # Dates of a version that later ones have replaced.
                inner = _folders(spark, f"{root}/{table}/{name}")
                gone += [f"{root}/{table}/{name}/fecha={d}" for d in inner if (d, version[1]) not in named]
    for path in gone:
        delete_folder(spark, path)
    for n in numbers[: -kept - 1]:
        delete_folder(spark, f"{root}/{MANIFESTS}/{n:09}.json")
    return gone
