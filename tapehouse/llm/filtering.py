"""Keeping whole rows by a test of one of their columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tapehouse.llm import textarrays as ta
from tapehouse.llm.shuffling import give_back

#: Bytes of the tested column that are judged and sent on together.
PIECE_BYTES = 1 << 20


def keep_rows(df: DataFrame, test: Callable[[pa.Array], np.ndarray], column: str) -> DataFrame:
    """The rows of ``df`` for which ``test`` of the column's Arrow array is true.

    Each row is judged in the task that reads it: nothing is shuffled, and
    rows that share an id, or have none, are judged by themselves. A batch is
    judged and sent on in pieces of about ``PIECE_BYTES`` of the column, so that
    neither the test nor a task's output needs memory for a whole batch.
    """
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for i, j in ta.slices(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), PIECE_BYTES):
                piece = batch.slice(i, j - i)
                keep = test(piece.column(at))
                yield piece if keep.all() else piece.filter(pa.array(keep))
                del piece
            del batch  # the batch's memory goes back before the next one arrives
            give_back()

    return df.mapInArrow(run, df.schema)
