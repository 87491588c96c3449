"""Scalar column expressions.

Spark 4 runs with ANSI mode on, where a bad cast, a bad timestamp or an
array index out of range raises. The feed is untrusted text, so every
conversion here is the null-on-failure form (``try_cast``,
``try_to_timestamp``, ``get``) without switching ANSI off globally.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

ColumnOrName = Column | str

# Packed ordering key: micros since epoch times 10**20 plus the tie-breaker
# shifted into [0, 2**64). Year 1..9999 micros times 10**20 stays inside
# DECIMAL(38, 0), so the key is exact and totally ordered.
_KEY_TYPE = DecimalType(38, 0)
_SHIFT = "CAST('100000000000000000000' AS DECIMAL(38,0))"
_LONG_OFFSET = "CAST('9223372036854775808' AS DECIMAL(38,0))"
_LONG_MIN = -(2**63)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: ColumnOrName) -> Column:
    """String (or any) to DOUBLE, null when unparseable."""
    return _col(c).try_cast("double")


def to_timestamp_or_null(c: ColumnOrName, like: DataType | None = None) -> Column:
    """ISO-8601 string to TIMESTAMP, null when unparseable.

    ``like`` casts the result to another timestamp flavour (e.g. the type of
    an ``ingest_time`` column that holds TIMESTAMP_NTZ).
    """
    ts = F.try_to_timestamp(_col(c))
    return ts.cast(like) if like is not None else ts


def event_time_fallback(time_str: ColumnOrName, fallback: ColumnOrName, like: DataType) -> Column:
    """Parsed message time, or the fallback (ingest) time when it fails."""
    return F.coalesce(to_timestamp_or_null(time_str, like), _col(fallback))


def element(arr: ColumnOrName, index: int) -> Column:
    """0-based array element; null when the index is out of range."""
    return F.get(_col(arr), index)


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def order_key(time_col: ColumnOrName, tiebreak: ColumnOrName) -> Column:
    """Exact single-value key for the order (time, tiebreak).

    ``min_by``/``max_by`` with a struct ordering force Spark onto a
    sort-based aggregate; one DECIMAL(38,0) ordering keeps them on the hash
    aggregate with partial aggregation before the shuffle. A null tie-breaker
    sorts first (as in a struct comparison); a null time gives a null key,
    which ``min_by``/``max_by`` skip.
    """
    micros = F.unix_micros(_col(time_col).cast("timestamp")).cast(_KEY_TYPE)
    tb = F.coalesce(_col(tiebreak).cast("bigint"), F.lit(_LONG_MIN)).cast(_KEY_TYPE)
    return micros * F.expr(_SHIFT) + (tb + F.expr(_LONG_OFFSET))


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / nullif(den, 0)``: null on a zero or null denominator."""
    return F.try_divide(_col(num), _col(den))


def pct_change(first: ColumnOrName, last: ColumnOrName) -> Column:
    """(last - first) / first * 100, and 0.0 when first is exactly 0."""
    f, l_ = _col(first), _col(last)
    return F.when(f == 0, F.lit(0.0)).otherwise((l_ - f) / f * 100.0)


def bar_direction(open_col: ColumnOrName = "open", close_col: ColumnOrName = "close") -> Column:
    """'up' when close >= open, else 'down' (also when either is null)."""
    return F.when(_col(close_col) >= _col(open_col), F.lit("up")).otherwise(F.lit("down"))


def lookback(asof: ColumnOrName, span: timedelta) -> Column:
    """``asof - span`` keeping the timestamp flavour of ``asof``."""
    micros = int(round(span.total_seconds() * 1_000_000))
    secs = F.lit(micros).cast("decimal(18,0)") / F.lit(1_000_000)
    return _col(asof) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def iso_utc(ts: ColumnOrName) -> Column:
    """Render a timestamp as ``yyyy-MM-ddTHH:mm:ss.ffffffZ`` (UTC session)."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
