"""Feed quality: sequence-gap reports, connection sessions, message counts.

A per-product ``lag`` window would put every message of a product in one
task; one hot product can hold a third of the feed, and a backfill gives a
whole key one ``ingest_time``. Both ordered operators here therefore number
the rows by ranges of their full order, (key, then every order column), and
partition their windows by range and key, so that a key of any size, and a key
whose first order column never changes, spreads over as many tasks as its rows
need. What crosses a border is carried by one row per range and key: windows
over these rows, a summary of the ranges and keys and not of the messages.

The borders of the ranges are a sample's quantiles, taken when the operator is
called, and constants of the plan from then on: the plan itself is lazy, is
built of window functions and joins only, and gives the same ranges however
often a part of it runs again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

#: Rows sampled for each range.
SAMPLED = 60
#: Bounds up to which a row's range is found by compiled comparisons; beyond, by a search in arrays, with the same result.
COMPILED = 255


def _range_number(df: DataFrame, order: Sequence[str]) -> Column:
    """The range, from 0, that a row falls into by ``order``: as many as there are shuffle partitions.

    ``SAMPLED`` rows a range go to the driver, their quantiles into the plan.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moments = {c for c in order if isinstance(df.schema[c].dataType, TimestampType)}  # exact in any time zone
    plain = [F.unix_micros(c) if c in moments else F.col(c).cast("string") for c in order]
    chosen = df.select(*order).orderBy(F.rand(seed=n)).limit(SAMPLED * n)
    rows = [tuple(r) for r in chosen.orderBy(*order).select(*plain).collect()]
    bounds = list(dict.fromkeys(rows[len(rows) * i // n] for i in range(1, n))) if rows else []
    if not bounds:
        return F.lit(0)

    def literal(value, c: str) -> Column:
        kind = df.schema[c].dataType
        return F.timestamp_micros(F.lit(value).cast("bigint")) if c in moments else F.lit(value).cast("string").cast(kind)

    here = F.struct(*(F.col(c).alias(f"c{j}") for j, c in enumerate(order)))
    if len(bounds) <= COMPILED:  # a tree of comparisons, which Spark compiles
        def below(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            bound = F.struct(*(literal(v, c).alias(f"c{j}") for j, (v, c) in enumerate(zip(bounds[middle], order, strict=True))))
            return F.when(bound <= here, below(middle + 1, high)).otherwise(below(low, middle))

        return below(0, len(bounds))
    columns = [F.array(*(literal(b[j], c) for b in bounds)) for j, c in enumerate(order)]
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def further(at: Column, step: Column) -> Column:
        """Binary search: bounds 1 to ``at`` are not behind the row."""
        bound = F.struct(*(F.get(b, at + step - 1).alias(f"c{j}") for j, b in enumerate(columns)))
        return F.when((at + step <= len(bounds)) & (bound <= here), at + step).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)


def _so_far(columns: Sequence[str], order: Sequence[str], end: int):
    """Window of all rows of ``columns`` up to the one ``end`` places from the current row."""
    return Window.partitionBy(*columns).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)


def _with_carried(rows: DataFrame, carried: DataFrame, part: Sequence[str]) -> DataFrame:
    """``rows`` with what earlier ranges of their key carry over; nulls are equal."""
    names = {c: f"_k{i}" for i, c in enumerate(["_range", *part])}
    other = carried.select(*(F.col(c).alias(k) for c, k in names.items()), *(c for c in carried.columns if c not in names))
    same = None
    for c, k in names.items():
        eq = F.col(c).eqNullSafe(F.col(k))
        same = eq if same is None else same & eq
    return rows.join(other, same, "left").drop(*names.values())


def sequence_gaps(
    df: DataFrame,
    key: str = "product_id",
    seq: str = "sequence",
    order: Sequence[str] = ("time",),
    session: str | None = None,
    reset: Column | None = None,
    name: str = "session_id",
    reset_all: Column | None = None,
) -> DataFrame:
    """Report every record whose sequence jumps past ``previous + 1``.

    Per key (and per ``session`` when given: a new connection forgets the
    previous sequence), in arrival ``order``, a record is a gap when
    ``seq > prev + 1``; ``expected = prev + 1``, ``missing = seq - prev - 1``.
    ``prev`` is always the immediately preceding record, so a backward step
    moves it back too. Records lacking the key or the sequence are skipped.
    ``order`` must be a total order (add a unique tie-breaker column).

    ``reset`` marks the rows of a key that start a new session of it; the
    sessions are then numbered in the same pass (column ``name``: markers of
    the key at or before the record, as by ``session_ids``), and a marker
    without a sequence counts too. ``reset_all`` marks the rows, of any key or
    none, that start a new session of all keys (a reconnect of the feed); the
    sessions are those of the whole stream.

    Output: key, [session or name], order columns, seq, expected, missing.
    """
    if (session is not None) + (reset is not None) + (reset_all is not None) > 1:
        raise ValueError("give one of session, reset and reset_all")
    order = list(order)
    if reset_all is not None:
        return _gaps_of_stream_sessions(df, key, seq, order, reset_all, name)
    part = [key] + ([session] if session else [])
    columns = [*part, *[c for c in order if c not in part]]
    columns += [seq] if seq not in columns else []
    marker = F.lit(False) if reset is None else F.coalesce(reset, F.lit(False))
    base = df.select(*[F.col(c) for c in columns if c != seq], F.col(seq).cast("bigint").alias(seq),
                     marker.cast("bigint").alias("_marker"))
    base = base.where(F.col(key).isNotNull() & (F.col(seq).isNotNull() | (F.col("_marker") > 0)))
    base = base.withColumn("_range", _range_number(base, [*part, *[c for c in order if c not in part]]))
    here = ["_range", *part]
    seen = F.when(F.col(seq).isNotNull(), F.struct(F.col(seq).alias("seq"), F.col("_session").alias("session")))
    rows = base.withColumn("_session", F.sum("_marker").over(_so_far(here, order, 0))).withColumn(
        "_prev", F.last(seen, ignorenulls=True).over(_so_far(here, order, -1)))

    # One row per range and key: its markers, and its last sequence if no marker came after it.
    ends = rows.groupBy(*here).agg(
        F.sum("_marker").alias("_markers"),
        F.max_by(seen, F.when(F.col(seq).isNotNull(), F.struct(*order))).alias("_end"),
    )
    tail = F.when(F.col("_end")["session"] == F.col("_markers"), F.col("_end")["seq"])
    told = F.when((F.col("_markers") > 0) | F.col("_end").isNotNull(), F.struct(tail.alias("seq")))
    earlier = _so_far(part, ["_range"], -1)
    carried = ends.select(
        *here, F.last(told, ignorenulls=True).over(earlier)["seq"].alias("_carried"),
        F.coalesce(F.sum("_markers").over(earlier), F.lit(0)).alias("_before"),
    ).where("_carried IS NOT NULL OR _before > 0")
    before = F.when(
        F.col("_prev").isNotNull(), F.when(F.col("_prev")["session"] == F.col("_session"), F.col("_prev")["seq"])
    ).when(F.col("_session") == 0, F.col("_carried"))
    found = _with_carried(rows, carried, part).withColumn("_prev", before).where(F.col(seq) > F.col("_prev") + 1)
    number = F.col("_session") + F.coalesce("_before", F.lit(0))
    return found.select(
        *part,
        *([number.alias(name)] if reset is not None else []),
        *[c for c in columns if c not in part and c != seq],
        seq,
        (F.col("_prev") + 1).alias("expected"),
        (F.col(seq) - F.col("_prev") - 1).alias("missing"),
    )


def _gaps_of_stream_sessions(df: DataFrame, key: str, seq: str, order: list[str], reset: Column, name: str) -> DataFrame:
    """Sessions of the whole stream and gaps inside them, over the same ranges of ``order`` and one shuffle."""
    others = [c for c in order if c != key]
    base = df.select(key, *others, F.col(seq).cast("bigint").alias(seq), F.coalesce(reset, F.lit(False)).cast("bigint").alias("_marker"))
    base = base.where((F.col(key).isNotNull() & F.col(seq).isNotNull()) | (F.col("_marker") > 0))
    base = base.withColumn("_range", _range_number(base, order))
    markers = base.groupBy("_range").agg(F.sum("_marker").alias("_markers"))  # one row a range
    before = markers.select("_range", F.coalesce(F.sum("_markers").over(_so_far([], ["_range"], -1)), F.lit(0)).alias("_before"))
    rows = base.withColumn("_local", F.sum("_marker").over(_so_far(["_range"], order, 0)))
    rows = _with_carried(rows, before, []).withColumn("_session", F.col("_local") + F.coalesce("_before", F.lit(0)))
    rows = rows.where(F.col(key).isNotNull() & F.col(seq).isNotNull()).select(key, *others, seq, "_range", "_session")
    here, row = ["_range", key], F.struct(F.col(seq).alias("seq"), F.col("_session").alias("session"))
    ends = rows.groupBy(*here).agg(F.max_by(row, F.struct(*order)).alias("_end"))
    carried = ends.select(*here, F.last("_end").over(_so_far([key], ["_range"], -1)).alias("_carried"))
    found = _with_carried(rows.withColumn("_prev", F.last(row).over(_so_far(here, order, -1))), carried, [key])
    last = F.coalesce("_prev", "_carried")
    found = found.where((last["session"] == F.col("_session")) & (F.col(seq) > last["seq"] + 1))
    return found.select(
        key, F.col("_session").alias(name), *others, seq,
        (last["seq"] + 1).alias("expected"), (F.col(seq) - last["seq"] - 1).alias("missing"),
    )


def session_ids(
    df: DataFrame,
    marker: Column,
    order: Sequence[str],
    key: str | None = None,
    name: str = "session_id",
) -> DataFrame:
    """Running count of ``marker`` rows (e.g. snapshots = reconnects) in ``order``.

    Every row gets the number of markers at or before it, per ``key`` when
    given (else over the whole stream; rows with a null key form a key of
    their own). ``order`` must be a total order. No task holds a whole key:
    see the module's text.
    """
    part = [key] if key else []
    base = df.withColumn("_marker", F.coalesce(marker, F.lit(False)).cast("bigint"))
    base = base.withColumn("_range", _range_number(base, [*part, *order]))
    rows = base.withColumn("_session", F.sum("_marker").over(_so_far(["_range", *part], order, 0)))
    # without a key this is one row a range, in one ordered list
    markers = base.groupBy("_range", *part).agg(F.sum("_marker").alias("_markers"))
    carried = markers.withColumn("_before", F.sum("_markers").over(_so_far(part, ["_range"], -1))).drop("_markers")
    number = F.col("_session") + F.coalesce("_before", F.lit(0))
    return _with_carried(rows, carried.where("_before > 0"), part).select(*df.columns, number.alias(name))


def observe_feed(df: DataFrame, name: str = "feed", type_col: str = "type") -> DataFrame:
    """Attach running feed metrics (messages, per-route counts) to a batch or stream.

    Spark reports them per batch (``Observation.get`` for batch queries,
    ``StreamingQueryProgress.observedMetrics`` for streams) without an extra
    pass over the data.
    """
    t = F.col(type_col)
    return df.observe(
        name,
        F.count(F.lit(1)).alias("messages"),
        F.count(F.when(t.isin("snapshot", "l2update"), 1)).alias("orderbook"),
        F.count(F.when(t.isin("match", "last_match"), 1)).alias("trades"),
        F.count(F.when(t.isNull(), 1)).alias("unparsed"),
    )


def message_counts(df: DataFrame, type_col: str = "type") -> DataFrame:
    """Messages per type (null type counted under null)."""
    return df.groupBy(type_col).agg(F.count(F.lit(1)).alias("messages"))
