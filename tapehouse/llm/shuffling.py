"""Shuffling numpy columns: packed rows by bucket, written steps, components.

A task packs its values for one bucket into one row of binary columns, so
Spark shuffles few rows of many values. What a group sends on is packed by the
task, not by the group (``routed``): the rows follow the data, not the square
of the number of buckets. Buckets come from a hash and their
number follows ``spark.sql.shuffle.partitions``, the setting by which a
cluster fits its partitions to the data.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.llm import textarrays as ta
from tapehouse.session import scratch_path

#: Most values and bytes in a row of ``chunked``, and bytes that a task of ``routed`` gathers before it deals them.
CHUNK, CHUNK_BYTES, ROUTED_BYTES = 1 << 18, 16 << 20, 64 << 20


def buckets(spark: SparkSession, each: int = 2) -> int:
    """Number of hash buckets: ``each`` for every shuffle partition."""
    return each * int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again.

    This cuts the lineage: after an executor is lost, later steps read files
    instead of running earlier ones again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex[:12]}")
    writer = df.write
    if by:
        writer = writer.partitionBy(by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing will read again."""
    for df in tables:
        folders = {path.rsplit("/", 1)[0] for path in df.inputFiles()}
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in folders:
            place = jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(conf).delete(place, True)


def give_back() -> None:
    """Return memory that a worker has freed to the system, as it may wait beside others for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def packed(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[tuple[int, dict[str, bytes]]]:
    """For each bucket that occurs, the bytes of its values of each column."""
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(ordered)) + 1, [len(ordered)])) if len(ordered) else [0]
    sorted_columns = {k: v[order] for k, v in columns.items()}
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(ordered[a]), {k: v[a:b].tobytes() for k, v in sorted_columns.items()}


def packed_batch(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """The rows of ``packed`` as a record batch (bucket int, binary columns), each column copied once."""
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    cuts = np.append(first, len(ordered))
    arrays = [pa.array(ordered[first], pa.int32())]
    for values in columns.values():
        edges = pa.py_buffer((cuts * values.itemsize).astype(np.int32))
        arrays.append(pa.Array.from_buffers(pa.binary(), len(first), [None, edges, pa.py_buffer(values[order])]))
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])


def unpacked(table: pa.Table, name: str, dtype) -> np.ndarray:
    """All values of one packed column of a group."""
    return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), dtype)


def chunked(columns: dict[str, np.ndarray], parts: tuple[str, np.ndarray, np.ndarray] | None = None) -> pa.Table:
    """Values as few packed rows, in their order. ``parts``: the name of a column of bytes
    of which each value has a stretch, the bytes and the stretches' sizes."""
    n = len(next(iter(columns.values())))
    edge = np.concatenate(([0], np.cumsum(parts[2]))) if parts else np.zeros(n + 1, np.int64)
    cuts = [0]
    while cuts[-1] < n:
        a = cuts[-1]
        fits = int(np.searchsorted(edge, edge[a] + CHUNK_BYTES, "right")) - 1
        cuts.append(max(a + 1, min(a + CHUNK, fits, n)))
    ranges = list(zip(cuts[:-1], cuts[1:], strict=True))
    made = {k: pa.array([v[a:b].tobytes() for a, b in ranges], pa.binary()) for k, v in columns.items()}
    if parts:
        made[parts[0]] = pa.array([parts[1][edge[a] : edge[b]].tobytes() for a, b in ranges], pa.binary())
    return pa.table(made)


def routed(
    rows: DataFrame,
    n_buckets: int,
    key: str,
    dtypes: dict[str, type],
    parts: tuple[str, Callable] | None = None,
    encode: Callable | None = None,
) -> DataFrame:
    """The values of ``chunked`` rows dealt to hash buckets of their ``key``: packed rows with a column bucket.

    Groups leave their values in a few rows each; a task gathers those of all its groups,
    ``ROUTED_BYTES`` at a time, and packs them by bucket only then. So there are at most as
    many rows as values, and no more than ``n_buckets`` for a task's share of the bytes,
    however many groups it had. ``parts``: the name of a column of bytes and the function
    that gives each value's size there from the other columns. ``encode`` makes a packed
    row from a bucket's values (default: their bytes).
    """
    names = [*dtypes, *([parts[0]] if parts else [])]

    def deal(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        columns = {k: unpacked(table, k, t) for k, t in dtypes.items()}
        bucket = (ta.mix(columns[key].view(np.uint64)) % np.uint64(n_buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        if parts:
            raw, size = unpacked(table, parts[0], np.uint8), parts[1](columns)
            place = np.cumsum(size) - size
        edges = np.flatnonzero(np.diff(bucket[order])) + 1
        out: dict[str, list] = {"bucket": [], **{k: [] for k in names}}
        for cell in np.split(order, edges) if len(order) else []:
            values = {k: v[cell] for k, v in columns.items()}
            made = encode(values) if encode else {k: v.tobytes() for k, v in values.items()}
            if parts:
                s = size[cell]
                made[parts[0]] = raw[np.repeat(place[cell] - np.cumsum(s) + s, s) + np.arange(s.sum())].tobytes()
            out["bucket"].append(int(bucket[cell[0]]))
            for k in names:
                out[k].append(made[k])
        arrays = [pa.array(v, pa.int32() if k == "bucket" else pa.binary()) for k, v in out.items()]
        return pa.RecordBatch.from_arrays(arrays, names=[*out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= ROUTED_BYTES:
                yield deal(held)
                held, size = [], 0
                give_back()
        if held:
            yield deal(held)
        held.clear()
        give_back()

    return rows.select(*names).mapInArrow(run, "bucket int, " + ", ".join(f"{k} binary" for k in names))


def doc_group(column: str, groups: int):
    """Spark column: the group (0 to groups - 1) of a document id."""
    return F.pmod(F.xxhash64(F.col(column)), F.lit(groups)).cast("int")


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (id, component), component
    being the smallest id; only ids that have an edge are returned.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until no
    edge changes. Each step is aggregations and one join on narrow rows, and
    is written to the shared folder; nothing but a checksum reaches the driver.
    """
    e = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name
    )

    def checksum(x: DataFrame):
        return x.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(2**31))).first()

    seen = checksum(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # u > v holds in ``large``; the small star links u and all its smaller neighbours to the smallest
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        e = written(small, name)
        now = checksum(e)
        if now == seen:
            break
        seen = now
    return e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
