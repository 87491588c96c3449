"""Operator 12: cheapest repair of conversations by Four-Russians block tables.

The turns of a conversation become symbols: the role's initial and whether the
turn is whole, cut off or must go. What the rest of a conversation costs from
each state of the role pattern ``(s?(ua)+)?`` is a vector of four numbers; less
their smallest, only a few vectors exist. For each of them and every block of
``BLOCK`` symbols a table holds the vector before the block and what it adds, so
a conversation is worked off a block at a time, from its end, by lookup. The
trace then runs from the start, expanding one block after another backward from
the vector behind it; of equally cheap edits it takes the ASCII-least.

Rows are dealt by ranges of (conv_id, turn, digest) and each task repairs the
conversations that lie inside its range. Those at a range's borders, among them
any that spans several ranges, are taken up by a second step: first occurrences
by aggregation, one byte a row and the audit (one row of the result holds it
whole) in one task, texts repaired range by range and streamed into one hash.
Memory is bounded by a range, however long a conversation is.

Nulls and edges: null roles and texts are one space, a null conv_id is a
conversation of its own, null turns come first; rows of one turn come in the
order of the SHA-256 of role and text; a role that is empty or has another
initial can't be kept; a conversation whose rows are all dropped has zeros; very
long texts pass through one task each; an empty table gives an empty result;
other columns are not used.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.llm.shuffling import written

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: Next state by the initial of a kept role (s, u, a, other), and by a user or assistant put in.
KEPT = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
PUT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
LEGAL = {(0, 1), (1, 2), (2, 1)}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Symbols: initial + 4 if cut off, a turn that must go, and one that stands for no turn.
GONE, NONE, SYMBOLS = 8, 9, 10
SPACES = " \t\n\x0b\x0c\r"
BLOCK = 4
TRACES = 1 << 18
CHUNK = 4 << 20
NO_TEXT = hashlib.sha256(b"").hexdigest()
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def symbol(code: int) -> int:
    """Symbol of a row's code (4 x initial + fault)."""
    initial, fault = divmod(code, 4)
    return GONE if fault in (BLANK, DUPLICATE) else initial + 4 * (fault == TRUNCATED)


def moves(state: int, sym: int) -> Iterator[tuple[str, int, int]]:
    """(edit, next state, cost) of the edits of one turn, in ASCII order."""
    yield "D", state, DELETE
    if sym < GONE:
        extra, to = CUT_OFF * (sym >= 4), KEPT[state][sym % 4]
        if to is not None:
            yield "K", to, KEEP + extra
        yield "R", PUT[state], REROLE + extra


class Blocks:
    """Cost vectors and the table of all blocks of ``block`` symbols."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = self._inserted([0, None, None, 0])
        self.vectors, todo, step, added = [end], [0], {}, {}
        known = {end: 0}
        while todo:  # all vectors that symbols lead to
            v = todo.pop()
            for sym in range(SYMBOLS):
                before = self.vectors[v] if sym == NONE else self.before(self.vectors[v], sym)
                least = min(before)
                before = tuple(x - least for x in before)
                if before not in known:
                    known[before] = len(self.vectors)
                    self.vectors.append(before)
                    todo.append(known[before])
                step[v, sym], added[v, sym] = known[before], least
        n = len(self.vectors)
        self.step1 = [[step[v, s] for s in range(SYMBOLS)] for v in range(n)]
        self.added1 = [[added[v, s] for s in range(SYMBOLS)] for v in range(n)]
        one, plus = np.array(self.step1), np.array(self.added1)
        to, cost = one, plus
        for _ in range(block - 1):  # a symbol in front of every shorter block
            to, cost = (
                one[to].transpose(0, 2, 1).reshape(n, -1),
                (cost[:, :, None] + plus[to]).transpose(0, 2, 1).reshape(n, -1),
            )
        self.to, self.cost = to.tolist(), cost.tolist()
        self.traces: dict[tuple[int, int, int], tuple[str, int]] = {}

    @staticmethod
    def _inserted(v: list) -> tuple[int, ...]:
        """``v`` where a state may also insert a turn first."""
        for _ in range(4):
            v = [min((x for x in (v[s], None if v[PUT[s]] is None else v[PUT[s]] + INSERT) if x is not None), default=None) for s in range(4)]
        return tuple(v)

    @classmethod
    def before(cls, after: tuple[int, ...], sym: int) -> tuple[int, ...]:
        """Costs before a turn, from those after it."""
        return cls._inserted([min(c + after[to] for _, to, c in moves(s, sym)) for s in range(4)])

    def _trace(self, behind: int, code: int, state: int) -> tuple[str, int]:
        """ASCII-least edits of one block from ``state``, and the state after it."""
        key = (behind, code, state)
        if key in self.traces:
            return self.traces[key]
        symbols = [code // SYMBOLS**i % SYMBOLS for i in reversed(range(self.block))]
        at = [behind]
        for sym in reversed(symbols):  # the block expanded backward
            at.append(self.step1[at[-1]][sym])
        at.reverse()
        edits = []
        for i, sym in enumerate(symbols):
            if sym == NONE:
                continue
            now, after, more = self.vectors[at[i]], self.vectors[at[i + 1]], self.added1[at[i + 1]][sym]
            while True:
                left = now[state] + more
                fit = {edit: to for edit, to, c in moves(state, sym) if c + after[to] == left}
                if "D" in fit or now[PUT[state]] + more + INSERT != left:
                    break
                edits.append("I")
                state = PUT[state]
            edit = min(fit)
            edits.append(edit)
            state = fit[edit]
        if len(self.traces) >= TRACES:
            self.traces.clear()
        self.traces[key] = "".join(edits), state
        return self.traces[key]

    def audit(self, codes: bytes) -> tuple[int, list[str], str]:
        """Cost, edits of each block (the first one may be short) and the edits after the last turn."""
        symbols = [NONE] * (-len(codes) % self.block) + [OF_CODE[c] for c in codes]
        blocks, cost, at = [], 0, [0]
        for i in range(0, len(symbols), self.block):
            code = 0
            for sym in symbols[i : i + self.block]:
                code = code * SYMBOLS + sym
            blocks.append(code)
        for code in reversed(blocks):
            v = at[-1]
            cost += self.cost[v][code]
            at.append(self.to[v][code])
        cost += self.vectors[at[-1]][START]
        at.pop()
        edits, state = [], START
        for code in blocks:
            done, state = self._trace(at.pop(), code, state)
            edits.append(done)
        tail = ""
        while self.vectors[0][state]:
            tail, state = tail + "I", PUT[state]
        return cost, edits, tail


OF_CODE = [symbol(c) for c in range(16)]


def code_of(role: str, text: str) -> int:
    """4 x initial + fault; duplicates are not known yet."""
    initial = INITIALS.find(role[:1]) if role else -1
    shown = text.strip(SPACES)
    fault = BLANK if not shown else SOUND if shown[-1] in ".!?" else TRUNCATED
    return 4 * (3 if initial < 0 else initial) + fault


def repaired(edits: str, rows: Iterator[tuple[str, str]], state: int = START) -> Iterator[str]:
    """The ``role:text`` lines that ``edits`` make of ``rows``."""
    for edit in edits:
        if edit == "I":
            state = PUT[state]
            yield ROLES[state] + ":"
            continue
        role, text = next(rows)
        if edit == "K":
            state = KEPT[state][INITIALS.index(role[:1])]
            yield f"{role}:{text}"
        elif edit == "R":
            state = PUT[state]
            yield f"{ROLES[state]}:{text}"


def state_after(edits: str, codes: bytes, state: int) -> int:
    i = 0
    for edit in edits:
        if edit in "IR":
            state = PUT[state]
        elif edit == "K":
            state = KEPT[state][codes[i] // 4]
        i += edit != "I"
    return state


def counted(codes: bytes) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours that may not follow each other."""
    faults = np.frombuffer(codes, np.uint8) % 4
    first = np.frombuffer(codes, np.uint8) // 4
    pairs = first[:-1].astype(int) * 4 + first[1:]
    fine = np.isin(pairs, [4 * a + b for a, b in LEGAL])
    return (*(int((faults == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)), int((~fine).sum()))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after damage by ``crc32(conv_id:turn) % 20``; a dropped row stays as a mark of its conversation."""
    space = F.lit(" ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    out = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("_k")
    )
    dropped = F.col("_k") == 0
    return out.select(
        "conv_id",
        "turn",
        F.when(dropped, "").when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_k") <= 1, "").when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        dropped.alias("dropped"),
        F.explode(F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The operator, over damaged rows (conv_id, turn, role, text, dropped): one row a conversation."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    done = f"conv_id {conv}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
    open_row = "part long, seq long, turn long, role string, text string, digest binary, dropped boolean, code int"
    # which of equal rows comes first makes no difference, so a place in the input may part them
    keyed = rows.select(
        "conv_id", "turn", "role", "text", "dropped",
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("_n"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest").asc(), F.col("_n").asc()]
    ranges = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_n")
    names = [f.split()[0] for f in f"{done}, {open_row}".split(", ")]
    finished = names[: len(COUNTS) + 3]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part = Blocks(block), TaskContext.get().partitionId()
        schema, seq, first, held, current = None, 0, True, [], None
        results: list[tuple] = []

        def opened(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal seq
            n = batch.num_rows
            role, text = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            given = {
                "part": pa.array(np.full(n, part)), "seq": pa.array(np.arange(seq, seq + n)),
                "code": pa.array([code_of(*x) for x in zip(role, text, strict=True)], pa.int32()),
            } | {c: batch.column(c) for c in ("conv_id", "turn", "role", "text", "digest", "dropped")}
            seq += n
            return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

        def closed() -> pa.RecordBatch:
            columns = list(zip(*results, strict=True))
            n = len(results)
            results.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[i], f.type) if i < len(columns) else pa.nulls(n, f.type) for i, f in enumerate(schema)], schema=schema
            )

        def finish(slices: list[pa.RecordBatch]) -> None:
            cols = [list(itertools.chain.from_iterable(s.column(c).to_pylist() for s in slices)) for c in ("turn", "role", "text", "digest", "dropped")]
            live = [r for r in zip(*cols, strict=True) if not r[4]]
            codes, seen = bytearray(), set()
            for _, role, text, digest, _ in live:
                code = code_of(role, text)
                if digest in seen and code % 4 != BLANK:
                    code += DUPLICATE - code % 4
                seen.add(digest)
                codes.append(code)
            turns = {r[0] for r in live if r[0] is not None}
            cost, edits, tail = table.audit(bytes(codes))
            audit = "".join(edits) + tail
            lines = "\n".join(repaired(audit, iter([r[1:3] for r in live])))
            gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
            results.append(
                (slices[0].column("conv_id")[0].as_py(), gaps, *counted(bytes(codes)), cost, audit, hashlib.sha256(lines.encode()).hexdigest())
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            if schema is None:
                types = {f.name: f.type for f in batch.schema} | {"audit": pa.string(), "repaired_sha256": pa.string(), "code": pa.int32()}
                schema = pa.schema([(c, types.get(c, pa.int64())) for c in names])
            ids = batch.column("conv_id").to_pylist()
            starts = [0] + [i for i in range(1, len(ids)) if ids[i] != ids[i - 1]]
            for a, b in itertools.pairwise([*starts, len(ids)]):
                some = batch.slice(a, b - a)
                if current is None or ids[a] != current[0]:
                    if current is not None and not first:
                        finish(held)
                    first, held, current = current is None, [], (ids[a],)
                if first:
                    yield opened(some)
                else:
                    held.append(some)
                if len(results) >= 2000:
                    yield closed()
        if results:
            yield closed()
        for some in held:  # the last one may go on in the next range
            yield opened(some)

    found = written(ranges.mapInArrow(local, f"{done}, {open_row}"), "conversations")
    whole = found.where("part IS NULL").select(*finished)
    return whole.unionByName(_spanning(found.where("part IS NOT NULL"), conv, block).select(*finished))


def _spanning(rows: DataFrame, conv: str, block: int) -> DataFrame:
    """Conversations given as rows (conv_id, part, seq, ...) of several ranges."""
    live = rows.where("NOT dropped")
    first = live.groupBy("conv_id", "digest").agg(F.min(F.struct("part", "seq")).alias("f"))
    first = first.select("f.part", "f.seq", F.lit(True).alias("_first"))
    repeated = F.col("_first").isNull() & (F.col("code") % 4 != BLANK)
    coded = rows.select("conv_id", "part", "seq", "turn", "code", "dropped").join(first, ["part", "seq"], "left")
    coded = coded.withColumn(
        "code", F.when(F.col("dropped"), None).when(repeated, F.col("code") + DUPLICATE - F.col("code") % 4).otherwise(F.col("code"))
    ).select("conv_id", "part", "seq", "turn", "code")

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by("seq")
        kept = group.filter(pc.is_valid(group.column("code")))
        turns = [t for t in kept.column("turn").to_pylist() if t is not None]
        row = {
            "conv_id": group.column("conv_id").slice(0, 1), "part": group.column("part").slice(0, 1),
            "codes": pa.array([kept.column("code").to_numpy().astype(np.uint8).tobytes()], pa.binary()),
            "low": pa.array([turns[0] if turns else None], pa.int64()), "high": pa.array([turns[-1] if turns else None], pa.int64()),
            "turns": pa.array([len(set(turns))], pa.int64()),
        }
        return pa.table(row)

    parts = coded.groupBy("conv_id", "part").applyInArrow(
        packed, f"conv_id {conv}, part long, codes binary, low long, high long, turns long"
    )

    tables: list[Blocks] = []

    def decided(group: pa.Table) -> pa.Table:
        if not tables:
            tables.append(Blocks(block))  # once in each task
        group = group.sort_by("part")
        conv_id, part, codes, low, high, turns = (group.column(c).to_pylist() for c in group.column_names)
        every = b"".join(codes)
        cost, edits, tail = tables[0].audit(every)
        audit = "".join(edits) + tail
        cuts, state, states = [0], START, []
        at = 0
        for c in codes[:-1]:  # an insertion goes with the turn behind it
            left = len(c)
            while left:
                left -= audit[at] != "I"
                at += 1
            cuts.append(at)
        cuts.append(len(audit))
        slices = [audit[a:b] for a, b in itertools.pairwise(cuts)]
        for c, some in zip(codes, slices, strict=True):
            states.append(state)
            state = state_after(some, c, state)
        spans = [(a, b) for a, b in zip(low, high, strict=True) if a is not None]
        distinct = sum(turns) - sum(a[1] == b[0] for a, b in itertools.pairwise(spans))
        gaps = spans[-1][1] - spans[0][0] + 1 - distinct if spans else 0
        values = (gaps, *counted(every), cost)
        n = len(part)
        columns = {"conv_id": group.column("conv_id"), "part": group.column("part")}
        columns |= {"edits": pa.array(slices, pa.string()), "state": pa.array(states, pa.int32())}
        columns |= {c: pa.array([v] + [None] * (n - 1), pa.int64()) for c, v in zip(COUNTS, values, strict=True)}
        return pa.table(columns | {"audit": pa.array([audit] + [None] * (n - 1), pa.string())})

    counts = ", ".join(f"{c} long" for c in COUNTS)
    decisions = written(
        parts.groupBy("conv_id").applyInArrow(decided, f"conv_id {conv}, part long, edits string, state int, {counts}, audit string"),
        "edits",
    )

    def rendered(texts: pa.Table, edits: pa.Table) -> pa.Table:
        texts = texts.sort_by("seq")
        some, chunks = [], []
        size = 0
        if edits.num_rows:
            turns = zip(texts.column("role").to_pylist(), texts.column("text").to_pylist(), strict=True)
            for line in repaired(edits.column("edits")[0].as_py(), turns, edits.column("state")[0].as_py()):
                some.append(b"\n" + line.encode())
                size += len(some[-1])
                if size >= CHUNK:
                    chunks.append(b"".join(some))
                    some, size = [], 0
        if some:
            chunks.append(b"".join(some))
        n, source = len(chunks), edits if edits.num_rows else texts
        same = lambda c: source.column(c).take(pa.array([0] * n, pa.int64()))
        return pa.table(
            {"conv_id": same("conv_id"), "part": same("part"), "chunk": pa.array(range(n), pa.int64()), "lines": pa.array(chunks, pa.binary())}
        )

    lines = (
        live.select("conv_id", "part", "seq", "role", "text")
        .groupBy("conv_id", "part")
        .cogroup(decisions.select("conv_id", "part", "edits", "state").groupBy("conv_id", "part"))
        .applyInArrow(rendered, f"conv_id {conv}, part long, chunk long, lines binary")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """SHA-256 of each conversation, streamed: a hash can't be put together from parts."""
        last, state, ids, sums = None, None, [], []
        kind = pa.null()
        for batch in batches:
            kind = batch.column(0).type
            for conv_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if last is None or conv_id != last[0]:
                    if last is not None:
                        ids.append(last[0])
                        sums.append(state.hexdigest())
                    last, state, text = (conv_id,), hashlib.sha256(), text[1:]
                state.update(text)
        if last is not None:
            ids.append(last[0])
            sums.append(state.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(sums)], names=["_id", "_sha"])

    sums = (
        lines.repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "chunk")
        .select("conv_id", "lines")
        .mapInArrow(hashed, f"_id {conv}, _sha string")
    )
    totals = decisions.where("cost IS NOT NULL")
    return totals.join(sums, F.col("conv_id").eqNullSafe(F.col("_id")), "left").withColumn(
        "repaired_sha256", F.coalesce("_sha", F.lit(NO_TEXT))
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged, judged and repaired."""
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
