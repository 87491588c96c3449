"""Operator 13: packing by Karmarkar-Karp multiway differencing.

A task encodes its documents and gathers them in pools of a bounded number of
windows. Differencing starts with one partial partition for each piece (the
piece in one window, nothing in the others) and always merges the two whose
windows differ most, the fullest window of one with the emptiest of the other,
so that their imbalances cancel. It leaves near-equal windows; as long as one
of them exceeds the capacity, the number of windows rises by one. The small
room that is left in near-equal windows is then filled exactly: the lightest
windows are cut up for it, what remains of them goes into the next pool. Only
the last remainder of a task, less than one window, is cut at powers of two,
which need no padding either.

Nothing is shuffled and a task holds one pool. Sequences depend on how the
table is dealt to tasks; a task that runs again gives the same rows.

Nulls and edges: a null text counts as empty and gives one piece, the end id
alone; a null doc_id is kept; repeated rows are packed each by itself; a text
longer than the capacity is cut into full windows and a rest, which is pooled;
an empty table gives an empty result; columns other than doc_id and text are
not used.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.llm import textarrays as ta
from tapehouse.llm.shuffling import documents

CAPACITY, END_ID = 2048, 1
WORD_BPE = "word_bpe_49k.json"
#: Windows of a pool; bounds a task's memory and the width of a partial partition.
POOL_WINDOWS = 128
#: Bytes of text that a task encodes together; only memory depends on it.
ENCODED_AT_ONCE = 4 << 20
PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def differencing(sizes: Sequence[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp differencing of ``sizes`` into ``k`` windows: the indices in each."""
    if not len(sizes):
        return [[] for _ in range(k)]
    sizes = np.asarray(sizes, np.int64)
    n, turn = len(sizes), len(sizes)
    low, high = [], []  # what each merged node holds; nodes below n are the pieces
    order = np.argsort(-sizes, kind="stable")
    # The first k merges only put the next largest piece into an empty window.
    sums, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
    m = min(k, n)
    sums[:m], nodes[:m] = sizes[order[:m]], order[:m]
    heap = [(-int(sums[0] - sums[-1]), turn, sums - sums[-1], nodes)]
    heap += [(-int(sizes[i]), i, None, None) for i in order[m:].tolist()]
    heapq.heapify(heap)

    def opened(entry):
        spread, i, sums, nodes = entry
        if sums is None:  # one piece in the fullest window, nothing in the others
            sums, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
            sums[0], nodes[0] = -spread, i
        return sums, nodes

    while len(heap) > 1:
        (a, at_a), (b, at_b) = opened(heapq.heappop(heap)), opened(heapq.heappop(heap))
        sums, at_b = a + b[::-1], at_b[::-1]
        nodes = np.where(at_a >= 0, at_a, at_b)
        both = np.flatnonzero((at_a >= 0) & (at_b >= 0))
        if len(both):
            nodes[both] = n + len(low) + np.arange(len(both))
            low += at_a[both].tolist()
            high += at_b[both].tolist()
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order] - sums[order[-1]], nodes[order]  # only differences matter
        turn += 1
        heapq.heappush(heap, (-int(sums[0]), turn, sums, nodes))
    _, nodes = opened(heap[0])
    windows = []
    for root in nodes.tolist():
        found, todo = [], [root] if root >= 0 else []
        while todo:
            x = todo.pop()
            if x < n:
                found.append(x)
            else:
                todo += (low[x - n], high[x - n])
        windows.append(sorted(found))
    return windows


def near_equal_windows(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: the fewest that could hold all, and one more while one is exceeded.

    No size may exceed ``capacity``.
    """
    sizes = np.asarray(sizes, np.int64)
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        windows = differencing(sizes, k)
        if all(sizes[w].sum() <= capacity for w in windows):
            return [w for w in windows if w]
        k += 1


Span = tuple[int, int, int]  # document (any handle), start, length


def levelled(spans: Sequence[Span], windows: list[list[int]], capacity: int) -> tuple[list[list[Span]], list[Span]]:
    """Full windows, and the spans that remain (fewer than ``capacity`` ids).

    The fullest windows keep their spans; the room left in each is filled with
    ids cut from the lightest windows.
    """
    total = {i: sum(spans[j][2] for j in w) for i, w in enumerate(windows)}
    order = sorted(total, key=lambda i: (-total[i], i))
    n_full = sum(total.values()) // capacity
    rest = deque(spans[j] for i in order[n_full:] for j in windows[i])
    full = []
    for i in order[:n_full]:
        held, room = [spans[j] for j in windows[i]], capacity - total[i]
        while room:
            doc, start, length = rest.popleft()
            taken = min(room, length)
            held.append((doc, start, taken))
            if taken < length:
                rest.appendleft((doc, start + taken, length - taken))
            room -= taken
        full.append(held)
    return full, list(rest)


def powers_of_two(spans: Sequence[Span]) -> list[list[Span]]:
    """``spans`` cut in their order into sequences whose lengths are falling powers of two."""
    left, out, rest = sum(s[2] for s in spans), [], deque(spans)
    while left:
        room, held = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            doc, start, length = rest.popleft()
            taken = min(room, length)
            held.append((doc, start, taken))
            if taken < length:
                rest.appendleft((doc, start + taken, length - taken))
            room -= taken
        out.append(held)
    return out


class WordIds:
    """Ids of texts by a public tokenizer whose tokens never hold white space.

    Texts are cut at ASCII white space and between an ASCII letter and one of
    ``ENDINGS``, where a token always ends: the normaliser and the split drop
    white space, and a run of letters is a token group by itself. Each distinct
    stretch is encoded once and remembered, so the ids are those of encoding
    every whole text.
    """

    #: Marks that part runs of letters; not the apostrophe ("'s" is one token group) nor marks of added tokens.
    ENDINGS = b'.,;:!?)"'
    #: Stretches remembered; beyond that the memory is emptied, results stay.
    REMEMBERED = 1 << 20
    #: Stretches encoded in one call, which costs more than a stretch does.
    TOGETHER = 100

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(WORD_BPE))
        kind = np.zeros(256, np.uint8)
        kind[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = 1
        kind[list(self.ENDINGS)] = 2
        self.kind = kind
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.base, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, stretches: list[str]) -> None:
        """Encode stretches that are not remembered; some at once, told apart by their places."""
        sizes, found = [], []
        for i in range(0, len(stretches), self.TOGETHER):
            some = stretches[i : i + self.TOGETHER]
            ends = np.cumsum([len(x) + 1 for x in some])
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            at = np.searchsorted(ends, np.array([a for a, _ in e.offsets], np.int64), "right")
            sizes.append(np.bincount(at, minlength=len(some)))
            found.append(np.array(e.ids, np.uint32))
        size = np.concatenate(sizes)
        self.base = np.concatenate((self.base, len(self.ids) + np.cumsum(size) - size))
        self.size, self.ids = np.concatenate((self.size, size)), np.concatenate((self.ids, *found))
        known = np.concatenate((self.hashes, hashes))
        slot = np.concatenate((self.slot, len(self.slot) + np.arange(len(hashes))))
        order = np.argsort(known)
        self.hashes, self.slot = known[order], slot[order]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and each text's range in them."""
        data, offs = ta.flat(texts)
        starts, ends, _ = ta.words(data, offs)
        kind = self.kind[data]
        inner = np.flatnonzero(kind[:-1] + kind[1:] == 3) + 1
        inner = inner[~np.isin(inner, offs)]  # neighbours in other texts do not count
        starts, ends = np.sort(np.concatenate((starts, inner))), np.sort(np.concatenate((ends, inner)))
        hashes, first, code = np.unique(ta.span_hash(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > self.REMEMBERED:
            self._forget()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        if not known.all():
            raw, here = data.tobytes(), first[~known]
            spans = zip(starts[here].tolist(), ends[here].tolist(), strict=True)
            self._learn(hashes[~known], [raw[a:b].decode() for a, b in spans])
        slot = self.slot[np.searchsorted(self.hashes, hashes)][code]
        count = self.size[slot]
        total = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.repeat(self.base[slot] - total[:-1], count) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, offs)]


class Pool:
    """Whole documents and rests of documents that wait for their windows."""

    def __init__(self, capacity: int, task: int):
        self.capacity, self.sequence, self.known = capacity, task << 40, 0
        self.docs: dict[int, tuple[int, np.ndarray]] = {}
        self.spans: list[Span] = []
        self.rows: list[tuple] = []

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        """A document: full windows are its own sequences, the rest is pooled."""
        at, self.known = self.known, self.known + 1
        self.docs[at] = (doc_id, ids)
        whole = len(ids) // self.capacity * self.capacity if len(ids) > self.capacity else 0
        for start in range(0, whole, self.capacity):
            self._row([(at, start, self.capacity)])
        if whole < len(ids):
            self.spans.append((at, whole, len(ids) - whole))
        else:
            del self.docs[at]

    def _row(self, held: list[Span]) -> None:
        offset = 0
        for at, start, length in held:
            doc_id, ids = self.docs[at]
            crc = zlib.crc32(ids[start : start + length].astype("<u4"))
            self.rows.append((doc_id, start, length, crc, len(ids), self.sequence, offset))
            offset += length
        self.sequence += 1

    def pack(self, last: bool = False) -> pa.RecordBatch:
        """Sequences of the pooled spans; what fills no window stays, at the end it is cut at powers of two."""
        windows = near_equal_windows([s[2] for s in self.spans], self.capacity)
        full, rest = levelled(self.spans, windows, self.capacity)
        for held in full + (powers_of_two(rest) if last else []):
            self._row(held)
        self.spans = [] if last else rest
        self.docs = {at: self.docs[at] for at, _, _ in self.spans}
        columns = list(zip(*self.rows, strict=True)) or [()] * 7
        self.rows = []
        doc, *others = (np.array(c, np.int64) for c in columns)
        return pa.RecordBatch.from_arrays(
            [ta.id_array(doc), *(pa.array(c) for c in others)], names=[f.split()[0] for f in PIECE.split(", ")]
        )


def packed_windows(
    docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, pool_windows: int = POOL_WINDOWS
) -> DataFrame:
    """The operator: every piece of every document with its sequence and place.

    ``vocabulary`` is the path of a tokenizer file (default: the public one).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(vocabulary)
        pool, waiting = Pool(capacity, TaskContext.get().partitionId()), 0
        for batch in batches:
            doc = ta.ids(batch.column(0))
            texts = batch.column(1)
            _, offs = ta.flat(texts)
            for i, j in ta.slices(offs, ENCODED_AT_ONCE):
                ids, cuts = words.encode(texts.slice(i, j - i))
                with_end = np.insert(ids, cuts[1:], END_ID)
                cuts = cuts + np.arange(j - i + 1)
                for d, a, b in zip(doc[i:j].tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    pool.add(d, with_end[a:b].copy())
                    waiting += (b - a) % capacity if b - a > capacity else b - a
                    if waiting >= capacity * pool_windows:
                        yield pool.pack()
                        waiting = sum(s[2] for s in pool.spans)
            del batch, texts  # the batch's memory goes back before the next one arrives
            pa.default_memory_pool().release_unused()
        yield pool.pack(last=True)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECE)


def op13_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return packed_windows(documents(spark, sf_dir))
