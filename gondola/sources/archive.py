"""Spark data sources for the nested price archives.

A raw file is ``…/<tipo>/fecha=YYYY-MM-DD/*.zip`` and holds one ZIP per retailer, each with
``productos.csv``, ``sucursales.csv`` and ``comercio.csv``. The driver lists file names only.
Every task opens a file's central directory and reads its share of the retailers, so a file is
read by several tasks and nothing but bounded batches of lines leaves them.

Formats: ``price_archive`` (batches of lines) and ``price_archive_entries`` (contents).
Options: ``path``, ``dates`` (comma-separated), ``taskBytes`` (raw bytes a task takes, about).

Paths are those Spark takes: without scheme, ``file:``, ``s3a://`` or ``s3n://`` (through Arrow's S3
client), and what else Arrow opens by itself. Further options ``s3.…`` (``s3.endpoint_override``,
``s3.access_key``, …) go to the S3 client of driver and executors.
"""

from __future__ import annotations

import codecs
import csv
import datetime as dt
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from gondola.functions.dates import iso_date
from gondola.schemas import ARCHIVE_ENTRIES, ARCHIVE_ROWS

MEMBERS = ("productos", "sucursales", "comercio")
LINES_PER_BATCH = 2_000
# A raw file is read by as many tasks as this goes into its bytes.
TASK_BYTES = 32 << 20
# Readers with ``pushFilters`` need this setting of the session.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_PATH = re.compile(r"([^/]+)/fecha=(\d{4}-\d{2}-\d{2})/[^/]+$")


@dataclass
class _Share(InputPartition):
    """One task's part of a raw file: the retailers of slice ``index`` out of ``count``."""

    path: str
    tipo: str
    fecha: str
    index: int = 0
    count: int = 1


def _open_fs(path: str, s3: dict[str, str] | None = None) -> tuple[fs.FileSystem, str]:
    """File system and the path on it, for the spellings of Hadoop."""
    scheme, _, rest = path.partition("://")
    if not rest:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    if scheme in ("s3", "s3a", "s3n"):
        return fs.S3FileSystem(**(s3 or {})), rest
    if scheme == "file":
        return fs.LocalFileSystem(), rest
    return fs.FileSystem.from_uri(path)


class _File(io.BufferedReader):
    """Arrow file that reports a bad seek the way ``zipfile`` expects it."""

    def seek(self, offset, whence=io.SEEK_SET):
        try:
            return super().seek(offset, whence)
        except pa.ArrowInvalid as error:
            raise OSError(str(error)) from error


#: Tests of one column that the sources understand, by the class of the pushed filter.
_TESTS = {
    ds.EqualTo: lambda value, given: value == given,
    ds.EqualNullSafe: lambda value, given: value == given,
    ds.In: lambda value, given: value in given,
    ds.GreaterThan: lambda value, given: value is not None and value > given,
    ds.GreaterThanOrEqual: lambda value, given: value is not None and value >= given,
    ds.LessThan: lambda value, given: value is not None and value < given,
    ds.LessThanOrEqual: lambda value, given: value is not None and value <= given,
}


class _Reader(DataSourceReader):
    def __init__(self, options):
        #: (column, class of filter, value) of what Spark asks for.
        self.tests: list[tuple[str, type, object]] = []
        self.path = options["path"]
        self.dates = {d.strip() for d in options.get("dates", "").split(",") if d.strip()}
        # Option names arrive in lower case.
        self.task_bytes = int(options.get("taskBytes") or options.get("taskbytes") or TASK_BYTES)
        self.s3 = {k[3:]: v for k, v in options.items() if k.startswith("s3.")}

    def pushFilters(self, filters):
        """Tests of ``tipo``, ``fecha`` and ``miembro`` spare listing and unpacking what fails them.
        All are given back, and Spark tests the rows."""
        for f in filters:
            if type(f) in (ds.IsNull, ds.IsNotNull):
                self.tests.append((f.attribute[0], type(f), None))
            elif type(f) in _TESTS:
                self.tests.append((f.attribute[0], type(f), f.value))
                if f.attribute == ("fecha",) and type(f) in (ds.EqualTo, ds.EqualNullSafe, ds.In):
                    days = {d.isoformat() for d in (f.value if isinstance(f, ds.In) else [f.value]) if d}
                    # Days that nobody can have give no folder rather than all.
                    self.dates = (self.dates & days if self.dates else days) or {"none"}
            yield f

    def wants(self, column: str, value: object) -> bool:
        for name, kind, given in self.tests:
            if name != column:
                continue
            if kind in (ds.IsNull, ds.IsNotNull):
                if (value is None) != (kind is ds.IsNull):
                    return False
            elif not _TESTS[kind](value, given):
                return False
        return True

    def folders(self, filesystem: fs.FileSystem, root: str) -> Iterator[str]:
        """Where raw files can lie: with dates given only their folders, under the path itself or
        under each tipo's folder; else everything."""
        if not self.dates:
            yield root
            return
        top = filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True))
        for base in [root, *(i.path for i in top if i.type == fs.FileType.Directory)]:
            yield from (f"{base.rstrip('/')}/fecha={d}" for d in sorted(self.dates))

    def files(self) -> list[tuple[_Share, int]]:
        filesystem, root = _open_fs(self.path, self.s3)
        found = {}
        for folder in self.folders(filesystem, root):
            selector = fs.FileSelector(folder, recursive=True, allow_not_found=True)
            for info in filesystem.get_file_info(selector):
                place = _PATH.search(info.path)
                if info.type != fs.FileType.File or not info.path.endswith(".zip") or not place:
                    continue
                if self.wants("tipo", place[1]) and self.wants("fecha", dt.date.fromisoformat(place[2])):
                    found[info.path] = (_Share(info.path, place[1], place[2]), info.size)
        return [found[path] for path in sorted(found)]

    def open(self, share: _Share):
        filesystem, _ = _open_fs(self.path, self.s3)
        return _File(filesystem.open_input_file(share.path))


class _LinesReader(_Reader):
    def partitions(self):
        return [
            _Share(f.path, f.tipo, f.fecha, i, n)
            for f, size in self.files()
            for n in [max(1, -(-size // self.task_bytes))]
            for i in range(n)
        ]

    def read(self, partition: _Share | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no raw file at all
            return
        with self.open(partition) as raw:
            try:
                outer = zipfile.ZipFile(raw)
            except zipfile.BadZipFile:
                return
            with outer:
                for info in self._share_of(outer, partition):
                    yield from _retailer_batches(outer, info, partition, lambda kind: self.wants("miembro", kind))

    def _share_of(self, outer: zipfile.ZipFile, share: _Share) -> list[zipfile.ZipInfo]:
        """This task's retailers. Every task comes to the same split: largest first, each to
        the task with the fewest bytes so far."""
        infos = [i for i in outer.infolist() if i.filename.lower().endswith(".zip")]
        load = [0] * share.count
        mine = []
        for info in sorted(infos, key=lambda i: (-i.file_size, i.filename)):
            if info.file_size == 0:
                continue
            lightest = load.index(min(load))
            load[lightest] += info.file_size
            if lightest == share.index:
                mine.append(info)
        return mine


def _retailer_batches(
    outer: zipfile.ZipFile, info: zipfile.ZipInfo, share: _Share, wanted: Callable[[str | None], bool]
) -> Iterator[pa.RecordBatch]:
    """Batches of one retailer's wanted members, others aren't unpacked; a corrupt archive yields
    nothing."""
    # Two raw files of a date, or two folders in one, may hold retailers of one name.
    retailer = f"{PurePosixPath(share.path).name}/{info.filename.removesuffix('.zip')}"
    try:
        # The archive stays a compressed stream: to go back in it means to unpack it anew, so its
        # members are visited in stored order, once for their encoding and once for their lines.
        inner = zipfile.ZipFile(outer.open(info))
    except zipfile.BadZipFile:
        return
    with inner:
        members = {}
        for entry in inner.infolist():
            members.setdefault(PurePosixPath(entry.filename).name.lower(), entry)
        # A batch without member tells that the archive could be read.
        if wanted(None):
            yield _batch(share, retailer, None, 0, [], [])
        found = [(kind, members[f"{kind}.csv"]) for kind in MEMBERS if f"{kind}.csv" in members and wanted(kind)]
        found.sort(key=lambda member: member[1].header_offset)
        encodings = {kind: "utf-8-sig" if _is_utf8(inner, e) else "latin-1" for kind, e in found}
        for kind, entry in found:
            for first, header, lines in _member_lines(inner, entry, encodings[kind]):
                yield _batch(share, retailer, kind, first, header, lines)


def _member_lines(archive: zipfile.ZipFile, entry: zipfile.ZipInfo, encoding: str):
    """(first line number, header, lines) batches of a delimited text member."""
    with archive.open(entry) as raw:
        text = io.TextIOWrapper(raw, encoding=encoding, newline="")
        csv.field_size_limit(1 << 30)
        lines = (fields for fields in csv.reader(text, delimiter="|") if fields)
        header = next(lines, None)
        if header is None:
            return
        first = 1
        while batch := list(islice(lines, LINES_PER_BATCH)):
            yield first, header, batch
            first += len(batch)


def _is_utf8(archive: zipfile.ZipFile, entry: zipfile.ZipInfo) -> bool:
    """Does the whole member decode as UTF-8? A streaming pass in constant memory."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        with archive.open(entry) as raw:
            while chunk := raw.read(1 << 20):
                decoder.decode(chunk)
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return False
    return True


def _batch(share: _Share, retailer, kind, first, header, lines) -> pa.RecordBatch:
    fecha = dt.date.fromisoformat(share.fecha)
    row = [share.tipo, fecha, retailer, kind, first, header, lines]
    schema = to_arrow_schema(ARCHIVE_ROWS)
    return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)


class _EntriesReader(_Reader):
    def partitions(self):
        return [share for share, _ in self.files()]

    def read(self, partition: _Share | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        with self.open(partition) as raw:
            size = raw.seek(0, io.SEEK_END)
            try:
                entries = zipfile.ZipFile(raw).infolist() if size else []
                readable = size > 0
            except zipfile.BadZipFile:
                entries, readable = [], False
        fecha = dt.date.fromisoformat(partition.fecha)
        place = [partition.tipo, fecha, partition.path, readable, size]
        rows = [[*place, e.filename, _entry_state(e), e.file_size] for e in entries]
        schema = to_arrow_schema(ARCHIVE_ENTRIES)
        # A file without entries still gives one row.
        columns = zip(*(rows or [[*place, None, None, None]]))
        yield pa.record_batch(
            [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
        )


def _entry_state(entry: zipfile.ZipInfo) -> str:
    if not entry.filename.lower().endswith(".zip"):
        return "otra"
    return "comercio_vacio" if entry.file_size == 0 else "comercio"


class PriceArchive(DataSource):
    @classmethod
    def name(cls):
        return "price_archive"

    def schema(self):
        return ARCHIVE_ROWS

    def reader(self, schema):
        return _LinesReader(self.options)


class PriceArchiveEntries(DataSource):
    @classmethod
    def name(cls):
        return "price_archive_entries"

    def schema(self):
        return ARCHIVE_ENTRIES

    def reader(self, schema):
        return _EntriesReader(self.options)


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    """Line batches of all raw files under a path. Tests of tipo, fecha and miembro reach the reader."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(PriceArchive)
    return spark.read.format("price_archive").options(**options).load(path)


def read_entries(spark: SparkSession, path: str, **options) -> DataFrame:
    """One row per entry of all raw files under a path."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(PriceArchiveEntries)
    return spark.read.format("price_archive_entries").options(**options).load(path)


def archive_status(entries: DataFrame, strict: bool = True) -> DataFrame:
    """Per raw file: does it hold the date it is filed under?

    ``vacio``, ``no_es_zip``, ``sin_entradas`` are rejected; ``sin_fecha`` (no dated folder)
    is accepted; ``otra_fecha`` is accepted only when not strict; ``ok``.
    """
    folder = iso_date(F.split_part("entrada", F.lit("/"), F.lit(1)))
    status = (
        F.when(F.col("bytes_archivo") == 0, "vacio")
        .when(~F.col("legible"), "no_es_zip")
        .when(F.col("entradas") == 0, "sin_entradas")
        .when(F.col("_dated") == 0, "sin_fecha")
        .when(F.col("_matching") == 0, "otra_fecha")
        .otherwise("ok")
    )
    accepted = F.col("estado").isin("ok", "sin_fecha", *([] if strict else ["otra_fecha"]))
    return (
        entries.groupBy("tipo", "fecha", "ruta", "legible", "bytes_archivo")
        .agg(
            F.count("entrada").alias("entradas"),
            F.count(folder).alias("_dated"),
            F.count_if(folder == F.col("fecha")).alias("_matching"),
        )
        .select("tipo", "fecha", "ruta", "entradas", status.alias("estado"))
        .withColumn("aceptado", accepted)
    )
