"""Versioned Parquet tables: partition folders that are never changed, and one manifest per version.

A change writes the new contents of the partitions it touches into folders of
its own and then publishes a manifest, a small JSON file naming the folder of
every partition, by one rename that fails if the version exists already. So a
reader sees the table before or after a change and never between, a run that
dies leaves the last version as it was, a table without a manifest has not been
loaded, and of two writers the later one is refused. High-water marks and
transaction numbers are part of the manifest and change with the rows.

Beside the folders lie two small tables, written with each change: ``keys``
(blocks of keys and the partitions that hold them), by which an upsert finds
stored keys without reading the history, and ``files`` (smallest and largest
values of each file), by which a scan of ranges opens few files.

The rename is as atomic as the file system's: HDFS and local disks give that,
object stores need their own committer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructType

DATA, KEYS, FILES, STAGE, MANIFESTS = "data", "_keys", "_files", "_stage", "_versions"
#: Keys of one block of the key index, where the key is an integer.
KEY_BLOCK = 65_536
#: Index folders after which an upsert writes the whole index anew.
INDEX_FOLDERS = 32
#: Files that a scan of ranges names at most; beyond, it reads their folders, with the same result.
NAMED_FILES = 10_000


class Conflict(RuntimeError):
    """Another writer has published the version that was to be published."""


class Folders:
    """The few file system calls that Spark has no reader or writer for."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark._sc._gateway
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, place: str):
        return self.jvm.org.apache.hadoop.fs.Path(place)

    def names(self, folder: str) -> list[str]:
        place = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(place)) if self.fs.exists(place) else []

    def read(self, place: str) -> str | None:
        if not self.fs.exists(self.path(place)):
            return None
        stream = self.fs.open(self.path(place))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, place: str, text: str, replace: bool = False) -> bool:
        """Write a file that appears whole; False if it exists already (unless ``replace``)."""
        draft = self.path(f"{place}.{uuid.uuid4().hex}.draft")
        stream = self.fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        kinds = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.gateway.new_array(kinds, 1)
        how[0] = kinds.OVERWRITE if replace else kinds.NONE
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            files.rename(draft, self.path(place), how)
            return True
        except Exception as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExists" not in str(e):
                raise
            return False

    def move(self, source: str, target: str) -> bool:
        """Rename a file; False if it is gone, as when another took it."""
        try:
            return bool(self.fs.rename(self.path(source), self.path(target)))
        except Exception as e:
            if "FileNotFound" not in str(e):
                raise
            return False

    def delete(self, place: str) -> None:
        self.fs.delete(self.path(place), True)


@dataclass(frozen=True)
class Version:
    """What a manifest says."""

    number: int
    schema: str
    column: str | None
    #: Partition name (``day=2024-01-01``, or empty for a table without partitions) -> its folder.
    folders: dict[str, str]
    marks: dict = field(default_factory=dict)
    keys: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)

    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def _pruned(df: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    for c in conditions:
        df = df.where(c)
    return df


class Table:
    """A versioned table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.io = Folders(spark, self.path)

    # ---- versions

    def numbers(self) -> list[int]:
        names = self.io.names(f"{self.path}/{MANIFESTS}")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _place(self, number: int) -> str:
        return f"{self.path}/{MANIFESTS}/{number:012d}.json"

    def version(self, number: int) -> Version:
        return Version(**json.loads(self.io.read(self._place(number))))

    def current(self) -> Version | None:
        """The last published version; None before the first load."""
        numbers = self.numbers()
        return self.version(numbers[-1]) if numbers else None

    def mark(self, name: str):
        v = self.current()
        return None if v is None else v.marks.get(name)

    def publish(self, base: Version | None, new: Version) -> Version:
        """Make ``new`` the version after ``base``; ``Conflict`` if another writer has done so."""
        if (base.number if base else 0) + 1 != new.number:
            raise ValueError("a version follows its base")
        if not self.io.publish(self._place(new.number), json.dumps(new.__dict__)):
            raise Conflict(f"{self.path}: version {new.number} exists already")
        return new

    def set_marks(self, base: Version, marks: Mapping) -> Version:
        """A version that differs from ``base`` by its marks alone."""
        values = base.__dict__ | {"number": base.number + 1, "marks": base.marks | dict(marks)}
        return self.publish(base, Version(**values))

    # ---- reading

    def _frame(self, schema: StructType, places: Sequence[str]) -> DataFrame:
        """Rows of folders or files of the table; the folder of the change is no column."""
        if not places:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{DATA}")
        return reader.parquet(*(f"{self.path}/{p}" for p in places)).select(*schema.names)

    def read(self, version: Version | None = None, partitions: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version (default: the last), of some partitions if these are named."""
        v = version or self.current()
        if v is None:
            raise FileNotFoundError(f"{self.path} has not been loaded")
        names = v.folders if partitions is None else [p for p in partitions if p in v.folders]
        return self._frame(v.struct(), [v.folders[p] for p in names])

    def scan(self, ranges: Mapping[str, tuple], version: Version | None = None) -> DataFrame:
        """Rows whose columns lie in ``ranges`` (column -> (least, largest), None for open ends).

        Files that the ranges can't touch are not opened; the rows are those of
        a plain filter over the whole table.
        """
        v = version or self.current()
        if v is None:
            raise FileNotFoundError(f"{self.path} has not been loaded")
        bounds = []
        for column, (low, high) in ranges.items():
            bounds += [F.col(column) >= F.lit(low)] * (low is not None) + [F.col(column) <= F.lit(high)] * (high is not None)
        rows = self.read(v)
        if not v.files:
            return _pruned(rows, bounds)
        stats = self.spark.read.parquet(*(f"{self.path}/{p}" for p in v.files))
        live = self.spark.createDataFrame([(f,) for f in v.folders.values()], "folder string")
        stats = stats.join(F.broadcast(live), "folder", "left_semi")  # as many rows as the manifest has partitions
        for column, (low, high) in ranges.items():
            if f"low_{column}" in stats.columns:
                if low is not None:
                    stats = stats.where(F.col(f"high_{column}") >= F.lit(low))
                if high is not None:
                    stats = stats.where(F.col(f"low_{column}") <= F.lit(high))
        found = [r[0] for r in stats.select("file").limit(NAMED_FILES + 1).collect()]
        if len(found) <= NAMED_FILES:
            rows = self._frame(v.struct(), found)
        return _pruned(rows, bounds)

    # ---- writing

    def partition_names(self, column: str | None, values: Sequence) -> list[str]:
        """Folder names of partition values (given as strings, None for null)."""
        if column is None:
            return [""]
        name = self.io.jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        return [name(column, v) for v in values]

    def write(
        self,
        df: DataFrame,
        column: str | None = None,
        base: Version | None = None,
        replaced: Sequence[str] | None = None,
        marks: Mapping | Callable[[DataFrame], Mapping] | None = None,
        cluster_by: Sequence[str] = (),
        key_rows: DataFrame | None = None,
        keys: Sequence[str] = (),
    ) -> Version:
        """Publish the version after ``base`` (the one ``df`` was made from).

        ``df`` holds the whole new contents of the partitions named by
        ``replaced`` (default: of the table); of these, one without rows is
        gone. With ``cluster_by`` the rows of a partition are dealt to files by
        ranges of these columns and each file's bounds are stored. ``keys``
        are indexed: those of ``key_rows``, the rows that are new to their
        partition (default: all of ``df``). ``marks`` may be a function of the
        rows as written.
        """
        commit = uuid.uuid4().hex
        here = f"{DATA}/c={commit}" if column else f"{DATA}/{commit}"  # without partitions no folder may look like one
        if cluster_by:
            order = [c for c in (column, *cluster_by) if c]
            laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
        else:
            # rows of a partition together; Spark splits large partitions and merges small ones
            laid = df.hint("rebalance", column) if column else df
        writer = laid.write.partitionBy(column) if column else laid.write
        writer.parquet(f"{self.path}/{here}")
        if column:
            made = {n: f"{here}/{n}" for n in self.io.names(f"{self.path}/{here}") if "=" in n}
        else:
            made = {"": here}
        kept = {} if replaced is None or base is None else {p: f for p, f in base.folders.items() if p not in set(replaced)}
        written = self._frame(df.schema, list(made.values()))
        files, blocks = [], []
        if cluster_by:
            files = self._store_bounds(written, base.files if base and kept else [], set(kept.values()), cluster_by, commit)
        if keys:
            blocks = self._store_keys(base.keys if base and kept else [], written if key_rows is None else key_rows, column, keys, commit)
        if callable(marks):
            marks = marks(written)
        return self.publish(
            base,
            Version(
                (base.number if base else 0) + 1, df.schema.json(), column, kept | made,
                (base.marks if base else {}) | dict(marks or {}), blocks, files,
            ),
        )

    def _store_bounds(self, written: DataFrame, old: list[str], live: set[str], columns: Sequence[str], commit: str) -> list[str]:
        """Smallest and largest values of ``columns`` in each file of a change, added to those of earlier ones."""
        whole = written.select(*columns, F.input_file_name().alias("_f"))
        bounds = [e for c in columns for e in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"))]
        below = F.concat(F.lit(f"{DATA}/"), F.substring_index(F.col("_f"), f"/{DATA}/", -1))
        # the name is that of a URI: a plus is a plus, all else is unescaped
        stats = whole.groupBy("_f").agg(*bounds).withColumn("file", F.url_decode(F.replace(below, F.lit("+"), F.lit("%2B"))))
        stats = stats.withColumn("folder", F.regexp_replace("file", "/[^/]*$", "")).drop("_f")
        if len(old) >= INDEX_FOLDERS:
            earlier = self.spark.read.schema(stats.schema).parquet(*(f"{self.path}/{p}" for p in old))
            kept = self.spark.createDataFrame([(f,) for f in sorted(live)], "folder string")
            stats = stats.unionByName(earlier.join(F.broadcast(kept), "folder", "left_semi"))
            old = []
        stats.coalesce(1).write.parquet(f"{self.path}/{FILES}/c={commit}")  # one row a file
        return [*old, f"{FILES}/c={commit}"]

    def _block(self, schema: StructType, keys: Sequence[str]) -> Column:
        """An integer key's block of neighbours; of other keys a hash."""
        if len(keys) == 1 and isinstance(schema[keys[0]].dataType, (ByteType, ShortType, IntegerType, LongType)):
            key = f"cast(`{keys[0]}` as bigint)"
            return F.expr(f"{key} div {KEY_BLOCK} - if({key} < 0 and {key} % {KEY_BLOCK} <> 0, 1, 0)")  # floor, without overflow
        return F.xxhash64(*keys)

    def _store_keys(self, old: list[str], rows: DataFrame, column: str, keys: Sequence[str], commit: str) -> list[str]:
        """Add the blocks of ``rows`` to the index; write it whole when it has many folders."""
        found = rows.dropna(subset=list(keys)).select(self._block(rows.schema, keys).alias("block"), column).distinct()
        if len(old) >= INDEX_FOLDERS:
            found = found.unionByName(self._index(old, found.schema)).distinct()
            old = []
        found.sort("block").write.parquet(f"{self.path}/{KEYS}/c={commit}")
        return [*old, f"{KEYS}/c={commit}"]

    def _index(self, folders: Sequence[str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{p}" for p in folders))

    def partitions_of_keys(self, version: Version, rows: DataFrame, keys: Sequence[str]) -> list[str]:
        """Names of the partitions that may hold a key of ``rows``; all others hold none."""
        if not version.keys:
            return list(version.folders)
        column = version.column
        kind = version.struct()[column].dataType.simpleString()
        index = self._index(version.keys, f"block bigint, `{column}` {kind}")
        blocks = rows.dropna(subset=list(keys)).select(self._block(rows.schema, keys).alias("block")).distinct()
        values = index.join(blocks, "block", "left_semi").select(F.col(column).cast("string")).distinct().collect()
        names = self.partition_names(column, [r[0] for r in values])  # partitions, as many as the manifest has at most
        return [n for n in names if n in version.folders]

    # ---- housekeeping

    def vacuum(self, keep: int = 10) -> int:
        """Delete all but the last ``keep`` versions and the folders that only these or unfinished
        changes have; for the holder of the lease. Returns the number of folders deleted."""
        numbers = self.numbers()
        if not numbers:
            return 0
        alive = set()
        for n in numbers[-keep:]:
            v = self.version(n)
            alive |= {f.split("/")[1] for f in [*v.folders.values(), *v.keys, *v.files]}
        for n in numbers[:-keep]:
            self.io.delete(self._place(n))
        gone = [f"{kind}/{c}" for kind in (DATA, KEYS, FILES) for c in self.io.names(f"{self.path}/{kind}") if c not in alive]
        gone += [f"{STAGE}/{c}" for c in self.io.names(f"{self.path}/{STAGE}")]
        for folder in gone:
            self.io.delete(f"{self.path}/{folder}")
        return len(gone)
