"""Sequence gaps while messages pass: the feed's check with keyed state.

Per key the state is the last sequence and the session's number, a few bytes;
it lives in Spark's state store and comes back from the checkpoint after a
restart. Rows of one key of one micro-batch are sorted by arrival in its task,
so the size of a micro-batch (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``)
bounds what a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType


def stream_sequence_gaps(
    df: DataFrame,
    key: str = "product_id",
    seq: str = "sequence",
    order: Sequence[str] = ("ingest_time",),
    reset: Column | None = None,
    name: str = "session_id",
) -> DataFrame:
    """``quality.sequence_gaps`` over a stream, in append mode.

    Micro-batches must follow each other in arrival ``order``, as those of a
    log do; inside one, rows may come in any order. With ``reset`` the rows
    that start a new session of their key forget the previous sequence, and
    the session's number (markers of the key so far) is a column. Records
    lacking the key, or both the sequence and a marker, are skipped. ``order``
    must be a total order.
    """
    order = [c for c in order if c != key]
    marker = F.lit(False) if reset is None else F.coalesce(reset, F.lit(False))
    rows = df.select(key, *order, F.col(seq).cast("bigint").alias(seq), marker.alias("_marker"))
    rows = rows.where(F.col(key).isNotNull() & (F.col(seq).isNotNull() | F.col("_marker")))
    # no null among the sequences that go to pandas: it would make doubles of them
    rows = rows.withColumn("_has", F.col(seq).isNotNull()).withColumn(seq, F.coalesce(seq, F.lit(0)))
    numbers = [name] if reset is not None else []
    out = StructType(
        [rows.schema[key]]
        + [StructField(c, LongType()) for c in numbers]
        + [rows.schema[c] for c in order]
        + [StructField(c, LongType()) for c in (seq, "expected", "missing")]
    )
    columns = out.names

    def gaps(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, session = state.get if state.exists else (None, 0)
        some = pd.concat(list(batches)).sort_values(order, kind="stable")
        number = session + some["_marker"].to_numpy().cumsum()
        end = int(number[-1])
        has = some["_has"].to_numpy()
        some, number = some[has], number[has]
        seqs = some[seq].to_numpy(np.int64)
        # the sequence before, in the same session; the first of the batch follows the state's
        previous, known = np.zeros(len(seqs), np.int64), np.zeros(len(seqs), bool)
        previous[1:], known[1:] = seqs[:-1], number[1:] == number[:-1]
        if len(seqs) and last is not None and number[0] == session:
            previous[0], known[0] = last, True
        hit = known & (seqs > previous + 1)
        found = some[hit].assign(
            **{key: keys[0], name: number[hit], "expected": previous[hit] + 1, "missing": seqs[hit] - previous[hit] - 1}
        )
        if len(seqs) and number[-1] == end:
            last = int(seqs[-1])
        elif end != session:
            last = None
        state.update((last, end))
        yield found[columns]

    return (
        rows.groupBy(key)
        .applyInPandasWithState(gaps, out, "last bigint, session bigint", "append", GroupStateTimeout.NoTimeout)
    )
