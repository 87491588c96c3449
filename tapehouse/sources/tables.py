"""Table layer: namespaces, DDL, reads, full-refresh and staged overwrites.

Parquet directories are the tested path. Catalog tables with row-level
operations (Iceberg, Delta) are used through the same functions when their
connectors are configured; nothing here needs them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from tapehouse.schemas import DAY_PARTITIONS, FILE_PARTITIONS, NAMESPACES, TABLE_DDL
from tapehouse.session import scratch_path
from tapehouse.sources.versions import STAGE, Table, Version


def _stage(spark: SparkSession, name: str, table: str) -> str:
    """Staging folder of a catalog table, under the shared checkpoint folder; each run overwrites its own."""
    tag = hashlib.sha1(table.encode()).hexdigest()[:12]
    return scratch_path(spark, f"stage/{name}-{tag}")


def scan(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A layer table by catalog name (``silver.stg_trades``) or by path: the last version of a
    versioned table, else the Parquet files there."""
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    version = Table(spark, name_or_path).current()
    return spark.read.parquet(name_or_path) if version is None else Table(spark, name_or_path).read(version)


def create_namespaces(spark: SparkSession, catalog: str | None = None) -> None:
    """CREATE NAMESPACE IF NOT EXISTS for default, bronze, silver, gold."""
    prefix = f"{catalog}." if catalog else ""
    for ns in NAMESPACES:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {prefix}{ns}")


def create_table(
    spark: SparkSession,
    name: str,
    using: str = "parquet",
    location: str | None = None,
    catalog: str | None = None,
) -> None:
    """CREATE TABLE IF NOT EXISTS with the declared schema of a layer table.

    Bronze tables are partitioned by day: ``days(col)`` on v2 formats
    (iceberg), a derived ``<col>_date`` column for parquet. A Parquet table
    at a ``location`` has the partitions that the layer runs write there.
    """
    full = f"{catalog}.{name}" if catalog else name
    cols = TABLE_DDL[name]
    part = ""
    if name in DAY_PARTITIONS:
        c = DAY_PARTITIONS[name]
        if using.lower() == "parquet":
            cols += f", {c}_date DATE"
            part = f" PARTITIONED BY ({c}_date)"
        else:
            part = f" PARTITIONED BY (days({c}))"
    elif name in FILE_PARTITIONS and location and using.lower() == "parquet":
        column, *derived = FILE_PARTITIONS[name].split()
        cols += f", {FILE_PARTITIONS[name]}" if derived else ""
        part = f" PARTITIONED BY ({column})"
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({cols}) USING {using}{part}{loc}")


SYNCED = "tapehouse.version"


def sync_partitions(spark: SparkSession, name: str, location: str) -> None:
    """Make a Parquet table in the catalog that of its folder (added, changed and removed partitions).

    Of a versioned folder the table gets the last version's partition folders,
    those that differ from the version it had before. A table created over a
    folder that a stream has written has no partitions in the catalog: it is
    read through the stream's own log of files.
    """
    table = Table(spark, location)
    version = table.current()
    if version is not None:
        _sync_version(spark, name, table, version)
    elif path_exists(spark, location):
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    else:
        return
    spark.catalog.refreshTable(name)


def _sync_version(spark: SparkSession, name: str, table: Table, version: Version) -> None:
    if version.column is None:
        for folder in version.folders.values():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{table.path}/{folder}'")
        return
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    had = int(properties.get(SYNCED, 0))
    before = table.version(had).folders if had in table.numbers() else {}
    present = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    unescaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName

    def spec(partition: str) -> str:
        value = unescaped(partition.split("=", 1)[1])
        quoted = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"PARTITION (`{version.column}` = " + ("null)" if value == "__HIVE_DEFAULT_PARTITION__" else f"'{quoted}')")

    for partition, folder in version.folders.items():
        if partition not in present:
            spark.sql(f"ALTER TABLE {name} ADD {spec(partition)} LOCATION '{table.path}/{folder}'")
        elif before.get(partition) != folder:
            spark.sql(f"ALTER TABLE {name} {spec(partition)} SET LOCATION '{table.path}/{folder}'")
    for partition in present - set(version.folders):
        spark.sql(f"ALTER TABLE {name} DROP {spec(partition)}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{SYNCED}' = '{version.number}')")


def with_day_partition(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_date`` = to_date(column), the Parquet twin of days(column)."""
    return df.withColumn(f"{column}_date", F.to_date(F.col(column)))


def write_day_partitioned(df: DataFrame, path: str, column: str, mode: str = "append") -> None:
    """Write Parquet partitioned by the day of ``column``.

    Rows are range-partitioned by (day, time) first: each task then writes
    one or a few days (few files per day), and the range sampler splits a
    heavy day over several tasks instead of sending it to one.
    """
    part = f"{column}_date"
    (
        with_day_partition(df, column)
        .repartitionByRange(F.col(part), F.col(column))
        .write.mode(mode)
        .partitionBy(part)
        .parquet(path)
    )


_FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def full_refresh(df: DataFrame, path: str | None = None, table: str | None = None, using: str = "parquet") -> None:
    """Gold-style rebuild: replace the whole table with ``df``.

    v2 tables (iceberg, delta) use ``CREATE OR REPLACE TABLE AS SELECT``. File
    tables in the session catalog cannot be replaced that way; they are
    overwritten, staged through the checkpoint folder when ``df`` reads the
    table itself.
    """
    if table is not None:
        if using.lower() not in _FILE_FORMATS:
            df.writeTo(table).using(using).createOrReplace()
            return
        try:
            df.write.mode("overwrite").format(using).saveAsTable(table)
        except AnalysisException as e:
            if "UNSUPPORTED_OVERWRITE" not in str(e):
                raise
            spark = df.sparkSession
            stage = _stage(spark, "refresh", table)
            df.write.mode("overwrite").parquet(stage)
            spark.read.parquet(stage).write.mode("overwrite").format(using).saveAsTable(table)
    elif path is not None:
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError("path or table is required")


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a Parquet dataset; False when it is absent or holds no files.

    Any other failure (an unreadable file, a lost connection) is raised: it
    must not be taken for a first run.
    """
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if str(e.getCondition()).split(".")[0] in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def filtered_scan(spark: SparkSession, path: str, condition: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A scan with a row filter (pushed to Parquet by Catalyst) and optional projection."""
    df = spark.read.parquet(path).where(condition)
    return df.select(*columns) if columns else df


@dataclass
class UpsertResult:
    """Rows merged, names of the partitions touched (None on the first run, which
    writes all) and the version that holds them."""

    rows: int
    touched: list[str] | None
    version: Version


def upsert_parquet(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_col: str,
    newer_by: Sequence[str] | None = None,
    prior: Callable[[DataFrame], DataFrame] | None = None,
    also_touched: DataFrame | None = None,
    marks: Callable[[DataFrame], Mapping] | None = None,
    cluster_by: Sequence[str] = (),
    before: Callable[[], None] | None = None,
) -> UpsertResult:
    """MERGE ``source`` into the versioned, partitioned table at ``path``, as one new version.

    The partitions rewritten are those of the source rows, those in which the
    table already holds one of their keys (a corrected row may move to
    another partition) and those of ``also_touched`` (a frame with the
    partition column); a null partition value is one like any other. Stored
    keys are found by the table's key index first; only partitions it names
    are read. Partitions left without rows are gone. The table is read with
    the schema of ``source``, so partition values keep their type.

    ``prior`` transforms the stored rows of the touched partitions before the
    merge. ``marks`` gives values of the merged source rows that are published
    with them; ``before`` is called just before that. A run that dies leaves
    the table as it was.
    """
    from tapehouse.operators.upsert import upsert

    table = Table(spark, path)
    base = table.current()
    indexed = [] if partition_col in keys else list(keys)

    def marked(rows: DataFrame) -> Mapping:
        found = marks(rows) if marks else {}
        if before:
            before()
        return found

    if base is None:
        version = table.write(
            source, partition_col, marks=marked, cluster_by=cluster_by, keys=indexed
        )
        return UpsertResult(table.read(version).count(), None, version)
    stage = f"{table.path}/{STAGE}/{uuid.uuid4().hex}"
    try:
        source.write.parquet(stage)
        src = spark.read.schema(source.schema).parquet(stage)
        n = src.count()
        if n == 0 and also_touched is None:
            return UpsertResult(0, [], base)
        values = src.select(partition_col)
        if also_touched is not None:
            values = values.unionByName(also_touched.select(partition_col))
        if indexed:
            maybe = table.partitions_of_keys(base, src, indexed)
            stored = table.read(base, maybe).select(*keys, partition_col)
            values = values.unionByName(stored.join(src.select(*keys).distinct(), indexed, "left_semi").select(partition_col))
        found = values.select(F.col(partition_col).cast("string")).distinct().collect()  # partitions, not rows
        touched = table.partition_names(partition_col, [r[0] for r in found])
        affected = table.read(base, touched)
        if prior is not None:
            affected = prior(affected)
        version = table.write(
            upsert(affected, src, keys, newer_by=newer_by).select(*source.columns), partition_col, base, touched,
            lambda _: marked(src), cluster_by, src, indexed,
        )
        return UpsertResult(n, touched, version)
    finally:
        table.io.delete(stage)
