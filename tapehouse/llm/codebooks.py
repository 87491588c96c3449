"""Operator 11: product codes of vectors by member-resident Lloyd rounds.

A vector of integers is cut into equal parts; each part position has a codebook
of a fixed number of entries. A part lives with its owner, the group
(position, entry, salt) of the entry it is assigned to: the first shuffle brings
it there, and owners keep their members as written rows of packed columns. In a
round owners sum their resident members, which gives the next codebooks, and
assign the members again; only the parts whose entry changes leave and travel to
their new owner in the next shuffle. Members that stay are not moved or written
again: which of a group stayed follows from the codebooks since it arrived.
Salts follow the row count, so an entry that holds most rows has many owners.

The driver holds the codebooks (positions x entries x width integers) and, of
the table, as many rows as a codebook has entries.

Nulls and edges: rows whose vector is null, or holds a null or non-finite
component, are dropped, as are vectors whose length is no positive multiple of
the number of parts or differs from that of the smallest such vec_id; integers
beyond +-2**26 become that bound. With fewer rows than entries the codebooks are
that much smaller. A null vec_id is kept and comes last in order; equal vec_ids
come in the order of their vectors; repeated rows are coded each by itself; an
empty table gives an empty result; other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tapehouse.llm import textarrays as ta
from tapehouse.llm.shuffling import discard, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Members of one owner at most, on average over salts.
MEMBERS = 1 << 18
#: Members in one packed row at most, and rows that a task packs together.
PACKED, AT_ONCE = 1 << 16, 1 << 20
LARGEST = 1 << 26
#: Below this bound all sums of products are exact in double precision.
NARROW = 1 << 14


def nearest(book: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of ``book`` (entries x width) for each row of ``x`` and the squared distance; ties to the lower index."""
    best, far = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    narrow = max(np.abs(book).max(initial=0), np.abs(x).max(initial=0)) <= NARROW
    step = 1 << 14
    for i in range(0, len(x), step):
        some = x[i : i + step].astype(np.int64)
        if narrow:
            squares = (book.astype(np.float64) ** 2).sum(1) - 2.0 * (some.astype(np.float64) @ book.T.astype(np.float64))
            squares = squares.astype(np.int64) + (some**2).sum(1)[:, None]
        else:
            squares = np.zeros((len(some), len(book)), np.int64)
            for j in range(x.shape[1]):
                squares += (some[:, j, None] - book[None, :, j]) ** 2
        at = squares.argmin(1)
        best[i : i + step], far[i : i + step] = at, squares[np.arange(len(some)), at]
    return best, far


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary column: row i holds the bytes of values[cuts[i]:cuts[i + 1]]."""
    row = values.itemsize * int(np.prod(values.shape[1:], dtype=np.int64))
    return pa.Array.from_buffers(
        pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * row).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )


class Coder:
    """Codes of one table of vectors; ``run`` does all rounds."""

    def __init__(self, df: DataFrame, parts: int, entries: int, rounds: int, members: int):
        self.parts, self.rounds = parts, rounds
        fine = F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        fine &= (F.size("vector") > 0) & (F.size("vector") % parts == 0)
        self.kept = df.where(fine)
        order = [F.col("vec_id").asc_nulls_last(), F.col("vector").asc()]
        seeds = self.kept.orderBy(*order).select("vector").limit(entries).collect()  # as many rows as entries
        self.empty = not seeds
        if self.empty:
            return
        length = len(seeds[0][0])
        if any(len(s[0]) != length for s in seeds):
            self.kept = self.kept.where(F.size("vector") == length)
            seeds = self.kept.orderBy(*order).select("vector").limit(entries).collect()
        else:
            self.kept = self.kept.where(F.size("vector") == length)
        self.width, self.entries = length // parts, len(seeds)
        n, most = self.kept.agg(F.count("*"), F.max(F.array_max(F.transform("vector", F.abs)))).first()
        self.salts = -(-n // members)
        self.dtype = np.dtype("<i2" if most * SCALE < NARROW else "<i4")
        first = self._integers(np.array([s[0] for s in seeds], np.float64))
        self.books = [first.reshape(self.entries, parts, self.width).transpose(1, 0, 2).astype(np.int64)]
        label = self.kept.schema["label"].dataType
        self.label, self.label_type = label.simpleString(), to_arrow_type(label)

    def __getstate__(self) -> dict:
        """What tasks get: everything but the table."""
        return {k: v for k, v in self.__dict__.items() if k != "kept"}

    def _integers(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(x * SCALE), -LARGEST, LARGEST).astype(self.dtype)

    # ---- the first assignment and every migration: rows of single parts -> packed members of an owner

    def _part_rows(self) -> DataFrame:
        """One row a part, assigned by the first codebooks; vec_id and label go with position 0."""
        coder, book = self, self.books[0]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            row = TaskContext.get().partitionId() << 40
            for batch in batches:
                n = batch.num_rows
                flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = coder._integers(flat).reshape(n, coder.parts, coder.width)
                rows = row + np.arange(n)
                row += n
                for p in range(coder.parts):
                    entry, _ = nearest(book[p], x[:, p])
                    named = (batch.column(0), batch.column(1)) if p == 0 else None
                    yield coder._moving(np.full(n, p), entry, rows, x[:, p], named)

        return self.kept.select("vec_id", "label", "vector").mapInArrow(run, self._moving_schema())

    def _moving_schema(self) -> str:
        return f"owner long, row long, part binary, vec_id long, label {self.label}"

    def _moving(self, position, entry, rows, x, named) -> pa.RecordBatch:
        salt = (ta.mix(rows.astype(np.uint64)) % np.uint64(self.salts)).astype(np.int64)
        owner = (position * self.entries + entry) * self.salts + salt
        if named is None:
            named = (pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), self.label_type))
        part = _binary(x.astype(self.dtype), np.arange(len(rows) + 1))
        return pa.RecordBatch.from_arrays(
            [pa.array(owner), pa.array(rows), part, *named], names=["owner", "row", "part", "vec_id", "label"]
        )

    def _resident(self, moving: DataFrame, generation: int) -> DataFrame:
        """Parts shuffled to their owners and written there, packed."""
        coder = self

        def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            owner = table.column("owner").to_numpy()
            order = np.argsort(owner, kind="stable")
            owner = owner[order]
            new = np.flatnonzero(np.diff(owner)) + 1
            starts = np.concatenate(([0], new))
            # no row of more than PACKED members
            inside = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
            starts = np.flatnonzero(inside % PACKED == 0)
            cuts = np.append(starts, len(owner))
            table = table.take(pa.array(order))
            x = np.frombuffer(b"".join(table.column("part").to_pylist()), coder.dtype).reshape(-1, coder.width)
            sums = np.add.reduceat(x.astype(np.int64), starts, axis=0)
            group = owner[starts] // coder.salts
            named = group < coder.entries  # position 0
            lists = np.concatenate(([0], np.cumsum(np.where(named, np.diff(cuts), 0)))).astype(np.int32)
            of_zero = pa.array(np.flatnonzero(np.repeat(named, np.diff(cuts))))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(group // coder.entries),
                    pa.array(group % coder.entries),
                    pa.array(np.diff(cuts)),
                    pa.ListArray.from_arrays(np.arange(len(starts) + 1, dtype=np.int32) * coder.width, pa.array(sums.ravel())),
                    _binary(table.column("row").to_numpy(), cuts),
                    _binary(x, cuts),
                    *(
                        pa.ListArray.from_arrays(lists, table.column(c).combine_chunks().take(of_zero))
                        for c in ("vec_id", "label")
                    ),
                ],
                names=["position", "entry", "n", "sums", "rows", "parts", "vec_ids", "labels"],
            )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in batches:
                if batch.num_rows:
                    held.append(batch)
                    size += batch.num_rows
                if size >= AT_ONCE:
                    yield packed(held)
                    held, size = [], 0
            if held:
                yield packed(held)

        schema = (
            "position long, entry long, n long, sums array<long>, rows binary, parts binary, vec_ids array<long>, "
            f"labels array<{self.label}>"
        )
        return written(moving.repartition("owner").mapInArrow(run, schema), f"members-{generation}")

    # ---- owners

    def _stay(self, x: np.ndarray, position: int, entry: int, generation: int) -> np.ndarray:
        """Which members of a group that arrived in ``generation`` are still there."""
        here = np.ones(len(x), bool)
        for book in self.books[generation + 1 : self.known]:
            at = np.flatnonzero(here)
            here[at] = nearest(book[position], x[at])[0] == entry
        return here

    def _groups(self, batches: Iterator[pa.RecordBatch], generation: int):
        """(position, entry, row ids, parts, which stay, Arrow batch, its row) of every packed row."""
        for batch in batches:
            get = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            for i in range(batch.num_rows):
                p, e = get["position"][i].as_py(), get["entry"][i].as_py()
                x = np.frombuffer(get["parts"][i].as_buffer(), self.dtype).reshape(-1, self.width)
                rows = np.frombuffer(get["rows"][i].as_buffer(), np.int64)
                yield p, e, rows, x, self._stay(x, p, e, generation), get, i

    def _sums(self, members: DataFrame, generation: int) -> DataFrame:
        """(position, entry, n, sums) of what is still resident of one generation."""
        if generation + 1 == self.known:  # nothing has left yet: summed when packed
            return members.select("position", "entry", "n", "sums")
        coder = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = np.zeros(coder.parts * coder.entries, np.int64), np.zeros((coder.parts * coder.entries, coder.width), np.int64)
            for p, e, _, x, stay, _, _ in coder._groups(batches, generation):
                n[p * coder.entries + e] += stay.sum()
                sums[p * coder.entries + e] += x[stay].sum(0, dtype=np.int64)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some // coder.entries), pa.array(some % coder.entries), pa.array(n[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
                names=["position", "entry", "n", "sums"],
            )

        return members.mapInArrow(run, "position long, entry long, n long, sums array<long>")

    def _movers(self, members: DataFrame, generation: int, book: np.ndarray) -> DataFrame:
        """Members whose entry changes under ``book``, as rows of single parts."""
        coder = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for p, e, rows, x, stay, get, i in coder._groups(batches, generation):
                at = np.flatnonzero(stay)
                new, _ = nearest(book[p], x[at])
                left = new != e
                if left.any():
                    at = at[left]
                    named = None
                    if p == 0:
                        named = tuple(get[c][i].values.take(pa.array(at)) for c in ("vec_ids", "labels"))
                    yield coder._moving(np.full(len(at), p), new[left], rows[at], x[at], named)

        return members.mapInArrow(run, self._moving_schema())

    def _coded(self, members: DataFrame, generation: int) -> DataFrame:
        """(row, position, entry, error, vec_id, label): the last assignment of the resident parts."""
        coder = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for p, _, rows, x, stay, get, i in coder._groups(batches, generation):
                at = np.flatnonzero(stay)
                entry, far = nearest(coder.books[-1][p], x[at])
                if p == 0:
                    named = [get[c][i].values.take(pa.array(at)) for c in ("vec_ids", "labels")]
                else:
                    named = [pa.nulls(len(at), pa.int64()), pa.nulls(len(at), coder.label_type)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[at]), pa.array(np.full(len(at), p)), pa.array(entry), pa.array(far), *named],
                    names=["row", "position", "entry", "error", "vec_id", "label"],
                )

        return members.mapInArrow(
            run, f"row long, position long, entry long, error long, vec_id long, label {self.label}"
        )

    def run(self) -> DataFrame:
        """(vec_id, label, code, error) of every kept row; fills ``books``."""
        #: Codebooks by which the resident members are assigned; later ones do not count yet.
        self.known = 1
        generations = [self._resident(self._part_rows(), 0)]
        for r in range(1, self.rounds + 1):
            sums = self._union([self._sums(m, g) for g, m in enumerate(generations)])
            self.books.append(self._updated(sums))
            if r < self.rounds:
                book = self.books[r]
                moving = self._union([self._movers(m, g, book) for g, m in enumerate(generations)])
                generations.append(self._resident(moving, r))
                self.known = r + 1
        coded = self._union([self._coded(m, g) for g, m in enumerate(generations)])
        eight = -(-self.parts // 8)  # positions in a long: two hex digits each
        word = [
            F.sum(F.when(F.floor(F.col("position") / 8) == k, F.expr("shiftleft(entry, cast(8 * (7 - position % 8) as int))")).otherwise(F.lit(0)))
            for k in range(eight)
        ]
        of_row = coded.groupBy("row").agg(
            *(w.alias(f"_w{k}") for k, w in enumerate(word)),
            F.sum("error").alias("error"),
            F.max("vec_id").alias("vec_id"),
            F.max("label").alias("label"),
        )
        digits = F.substring(F.concat(*(F.lpad(F.lower(F.hex(f"_w{k}")), 16, "0") for k in range(eight))), 1, 2 * self.parts)
        codes = written(of_row.select("vec_id", "label", digits.alias("code"), "error"), "codes")
        discard(*generations)  # the codes are written; nothing reads the members any more
        return codes

    @staticmethod
    def _union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def _updated(self, sums: DataFrame) -> np.ndarray:
        """The next codebooks: componentwise floor of the mean; entries without members stay."""
        found = (
            sums.groupBy("position", "entry")
            .agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[j]).alias(f"_{j}") for j in range(self.width)))
            .collect()  # at most one row an entry
        )
        book = self.books[-1].copy()
        for position, entry, n, *total in found:
            if n:
                book[position, entry] = [t // n for t in total]
        return book

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books[-1].ravel().tolist())).encode()).hexdigest()


def product_codes(
    df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, members: int = MEMBERS
) -> tuple[DataFrame, np.ndarray | None, str]:
    """The operator, over columns vec_id, vector and label: codes (vec_id, label, code, error),
    the codebooks (position, entry, component) and their digest.

    ``code`` has two hex digits a part (``entries`` up to 256).
    """
    if entries > 256:
        raise ValueError("at most 256 entries")
    coder = Coder(df.select(F.col("vec_id").cast("long"), "vector", "label"), parts, entries, rounds, members)
    if coder.empty:
        schema = f"vec_id long, label {df.schema['label'].dataType.simpleString()}, code string, error long"
        return df.sparkSession.createDataFrame([], schema), None, hashlib.sha256(b"").hexdigest()
    codes = coder.run()
    return codes, coder.books[-1], coder.digest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes and errors of all embeddings."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumnRenamed("embedding", "vector")
    codes, _, digest = product_codes(vectors)
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
