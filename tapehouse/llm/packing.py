"""Operator 3: best-fit-decreasing packing of documents into token sequences.

Documents become pieces of at most ``capacity`` tokens. Best fit decreasing
depends only on how many pieces there are of each length, a histogram of at
most ``capacity`` rows, so the plan is made from it exactly and without
sampling: a segment tree over the remaining capacities finds the tightest open
bin in logarithmic time, and a run of equal pieces that meets a run of equal
bins is placed in one step, as piece-by-piece placing would. The plan's size is
bounded by the capacity, not by the documents. Executors then place every
piece by its rank among those of its length; ranks come from windows over
(length, salt), salts split a length that many pieces share.

Nulls and edges: a null text counts as empty and gives one piece, the end id
alone; a null doc_id is kept; repeated rows are packed each by itself; an empty
table gives an empty result; columns other than doc_id and text are not used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapehouse.llm import textarrays as ta
from tapehouse.llm.bpe import ENCODED_AT_ONCE, Bpe
from tapehouse.llm.shuffling import documents, give_back, written

CAPACITY, END_ID = 2048, 0
PIECES_PER_SALT = 500_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class TightestBin:
    """Segment tree over remaining capacities 0..capacity; each leaf holds runs of
    bins ``(first bin, number)`` with that much room."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, change: int) -> None:
        i = room + self.leaves
        while i:
            self.open[i] += change
            i >>= 1

    def put(self, room: int, first: int, number: int) -> None:
        if room and number:
            self.runs[room].append((first, number))
            self._add(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._add(room, -1)
        return self.runs[room].pop()

    def tightest(self, need: int) -> int | None:
        """The smallest room of at least ``need`` that some bin has."""
        i = need + self.leaves
        if self.open[i]:
            return need
        while i > 1 and not (i % 2 == 0 and self.open[i + 1]):
            i >>= 1
        if i <= 1:
            return None
        i += 1
        while i < self.leaves:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Moves (length, first rank, pieces, pieces per bin, first bin, offset) of best
    fit decreasing over ``counts`` pieces of each length."""
    tree, moves, n_bins = TightestBin(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def place(first: int, bins: int, each: int, room: int, length=length) -> None:
            nonlocal left, rank
            moves.append((length, rank, bins * each, each, first, capacity - room))
            tree.put(room - each * length, first, bins)
            left, rank = left - bins * each, rank + bins * each

        while left:
            room = tree.tightest(length)
            if room is None:
                each = capacity // length
                bins = max(1, left // each)
                place(n_bins, bins, min(each, left), capacity)
                n_bins += bins
                continue
            first, bins = tree.take(room)
            each = min(room // length, left)
            used = min(bins, left // each)
            tree.put(room, first + used, bins - used)
            place(first, used, each, room)
    return np.array(moves, np.int64).reshape(-1, 6)


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Each document's pieces: ids of its text, then ``END_ID``; a document longer than
    ``capacity`` is cut into pieces of that size of which the first may be shorter.

    ``with_ids`` adds the piece's ids (array<int>).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for batch in batches:
            doc = ta.ids(batch.column(0))
            data, offs = ta.flat(batch.column(1))
            for i, j in ta.slices(offs, ENCODED_AT_ONCE):
                at = offs[i : j + 1] - offs[i]
                ids, cuts = bpe.encode(data[offs[i] : offs[j]], at)
                n = np.diff(cuts) + 1
                k = -(-n // capacity)
                piece = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                head = np.repeat(n - (k - 1) * capacity, k)
                start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
                length = np.where(piece == 0, head, capacity)
                with_end = np.insert(ids, cuts[1:], END_ID).astype("<u4")
                begin = np.repeat(cuts[:-1] + np.arange(j - i), k) + start
                crc = [zlib.crc32(with_end[a : a + m]) for a, m in zip(begin.tolist(), length.tolist(), strict=True)]
                columns = [
                    ta.id_array(np.repeat(doc[i:j], k)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int64)),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(ends, with_end.astype(np.int32)))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            del batch, data  # the batch's memory goes back before the next one arrives
            give_back()

    schema = PIECE + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (columns doc_id, piece, ids_crc32, length; others stay).

    ``found`` is read several times: give a written table.
    """
    spark = found.sparkSession
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}  # at most ``capacity`` rows
    moves = best_fit_plan(counts, capacity)
    moves = moves[np.lexsort((moves[:, 1], moves[:, 0]))]
    shift = 44  # room for ranks below 2**44 in a sort key
    keys = (moves[:, 0] << shift) + moves[:, 1]
    salts = spark.createDataFrame(
        [(n, -(-c // PIECES_PER_SALT)) for n, c in counts.items()], "length long, _salts long"
    )
    salted = (
        found.join(F.broadcast(salts), "length")  # at most ``capacity`` rows
        .withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_salts")))
        .drop("_salts")
    )
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = W.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("_rank", F.row_number().over(within))
        .join(sizes, ["length", "_salt"])
        .withColumn("_rank", F.col("_rank") - 1 + F.col("_before"))
        .select(*found.columns, "_rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False)
            m = moves[np.searchsorted(keys, (length << shift) + rank, "right") - 1]
            k = rank - m[:, 1]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(m[:, 4] + k // m[:, 3]), pa.array(m[:, 5] + k % m[:, 3] * length)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def packed_sequences(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The operator: every piece of every document with its sequence and place."""
    return pack(written(pieces(docs, vocabulary, capacity), "pieces"), capacity)


def token_rows(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The packed training rows themselves: sequence_id and its ids in order."""
    placed = pack(written(pieces(docs, vocabulary, capacity, with_ids=True), "pieces-ids"), capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packed_sequences(documents(spark, sf_dir))
