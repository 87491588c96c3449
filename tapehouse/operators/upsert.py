"""Keyed upsert: MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *.

On tables with row-level operations (Iceberg, Delta) ``merge_into_table``
uses Spark's ``DataFrame.mergeInto``. Everywhere else the same result is a
left-anti join plus a union, which is what ``upsert`` returns lazily.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer_by: Sequence[str] | None = None,
    delete_where: Column | None = None,
) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``.

    - Default (``newer_by=None``): a source row replaces every target row
      with an equal key, unconditionally; other source rows are inserted.
      Keys compare with ``=``, so a null key never matches and such rows
      accumulate, as in SQL MERGE.
    - ``newer_by=[cols]``: a matched target row is only replaced when the
      source row is newer by those columns (descending, nulls last); a late,
      older source row is ignored.
    - ``delete_where``: rows of the result satisfying it are removed (e.g.
      ``size = 0`` to delete removed book levels instead of keeping them).

    The source must hold at most one row per key (de-duplicate first).
    """
    cols = target.columns
    src = source.select(*cols)
    if newer_by:
        merged = _upsert_guarded(target.select(*cols), src, list(keys), list(newer_by))
    else:
        kept = target.join(src.select(*keys), on=list(keys), how="left_anti")
        merged = kept.unionByName(src)
    if delete_where is not None:
        merged = merged.where(~F.coalesce(delete_where, F.lit(False)))
    return merged


def _upsert_guarded(target: DataFrame, src: DataFrame, keys: list[str], newer_by: list[str]) -> DataFrame:
    """One full outer join on the keys; a matched pair keeps its newer row, the source's at a tie.

    Rows with a null key match nothing and stay, as in SQL MERGE.
    """
    t, s = F.col("_t"), F.col("_s")
    take = F.lit(True)
    for c in reversed(newer_by):
        later = (t[c].isNull() & s[c].isNotNull()) | (s[c] > t[c])
        take = F.coalesce(later, F.lit(False)) | (t[c].eqNullSafe(s[c]) & take)
    left = target.select(F.struct(*target.columns).alias("_t"))
    right = src.select(F.struct(*target.columns).alias("_s"))
    same = None
    for k in keys:
        same = (t[k] == s[k]) if same is None else same & (t[k] == s[k])
    row = F.when(s.isNull(), t).when(t.isNull(), s).when(take, s).otherwise(t)
    return left.join(right, same, "full_outer").select(row.alias("_r")).select("_r.*")


def merge_into_table(
    spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str]
) -> None:
    """MERGE into a catalog table that supports row-level operations."""
    cond = " AND ".join(f"{table}.`{k}` = s.`{k}`" for k in keys)
    (
        source.alias("s")
        .mergeInto(table, F.expr(cond))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
