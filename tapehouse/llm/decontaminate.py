"""Operator 1: benchmark decontamination by rare seeds and local alignment.

1. Every run of ``seed_words`` words of a test item is a seed candidate. One pass
   counts, for each, the training documents that hold it.
2. Rare seeds of an item are the candidates in at most ``rare_share`` of the
   documents (and at least ``RARE_LEAST`` of them).
3. A second pass finds all candidates in every whole document. Hits of one item
   that lie on near diagonals mark a passage. One with a rare seed is aligned; one
   of frequent candidates alone is aligned if enough of the item's words are in
   it at all, as no alignment without them reaches the threshold: frequency
   saves alignments, it never hides a leak.
4. A passage's words and the item's words are aligned by Smith-Waterman (match 2,
   mismatch and gap -1). The score of the best passage, divided by that of a
   perfect copy, is the document's for that item.

Test items are the stated query set: they are taken in blocks of at most
``BLOCK_ITEMS`` items and ``BLOCK_WORDS`` words, each block sent to all tasks, so
what is sent is bounded however large the benchmark is. Training documents are
never shuffled. An item longer than a block's words is cut into several of that size.

Words are lower-cased runs of bytes other than white space without ASCII
punctuation around them. Nulls and edges: null or empty texts, and items without
words, match nothing; an item of fewer words than a seed is one seed; equal
items each give a row; a null item_id or doc_id is kept; repeated documents give
a row each; empty tables give an empty result; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.llm import textarrays as ta
from tapehouse.llm.shuffling import documents, give_back

U64 = np.uint64
SEED_WORDS, THRESHOLD = 4, 0.5
RARE_SHARE, RARE_LEAST = 0.001, 20
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 1_000_000
MATCH, MISS, GAP = 2, -1, -1
#: Bytes of text that a task looks at together, and cells that it aligns together.
SLICE, CELLS = 1 << 20, 100_000
FOUND = "doc_id long, item_id long, score double, first_word long, last_word long, n_matched long, item_words long"


def plain_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words without punctuation around them, and each document's range
    in them; a word of punctuation alone is none."""
    lower = ta.lower_ascii(data)
    mark = (lower > 0x20) & (lower < 0x7F) & ~((lower >= 0x30) & (lower <= 0x39)) & ~((lower >= 0x61) & (lower <= 0x7A))
    starts, ends, _ = ta.words(lower, offs)
    solid = np.append(np.flatnonzero(~mark), len(lower))  # bytes that are not punctuation
    first = solid[np.searchsorted(solid, starts)]
    last = solid[np.searchsorted(solid, ends) - 1] + 1 if len(starts) else ends
    keep = first < ends
    starts, ends = first[keep], last[keep]
    return ta.span_hash(lower, starts, ends), np.searchsorted(starts, offs)


def runs_of(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words that start at each word, and whether they are in one text."""
    weights = ta.mix(np.arange(1, k + 1, dtype=U64) * U64(ta.GAMMA)) | U64(1)
    n = len(words)
    if n < k:
        return np.zeros(0, U64), np.zeros(0, bool)
    acc = np.zeros(n - k + 1, U64)
    for j in range(k):
        acc += words[j : n - k + 1 + j] * weights[j]
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    return ta.mix(acc), owner[: n - k + 1] == owner[k - 1 :]


class Items:
    """A block of test items: their words and seed candidates of one or more lengths.

    Items shorter than ``k`` words have one candidate of their own length.
    """

    def __init__(self, ids: np.ndarray, texts: list, k: int):
        words, at = plain_words(*ta.flat(pa.array(texts, pa.large_string())))
        self.ids, self.words, self.at, self.k = ids, words, at, k
        size = np.diff(at)
        seeds, items, places, lengths = [], [], [], []
        for length in range(1, k + 1):
            which = size >= k if length == k else size == length
            h, inside = runs_of(words, at, length)
            place = np.flatnonzero(inside)
            item = np.searchsorted(at, place, "right") - 1
            use = which[item] if len(item) else np.zeros(0, bool)
            seeds.append(h[place[use]] + U64(length))
            items.append(item[use])
            places.append(place[use] - at[item[use]])
            lengths.append(np.full(use.sum(), length))
        seed, self.item, self.place, self.length = (np.concatenate(x) for x in (seeds, items, places, lengths))
        order = np.argsort(seed, kind="stable")
        self.seed, self.item, self.place, self.length = (x[order] for x in (seed, self.item, self.place, self.length))
        self.rare = np.ones(len(seed), bool)

    def mark(self, rare: np.ndarray) -> None:
        """Note which candidates are rare seeds."""
        self.rare = rare

    def hits(self, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word place, candidate) of all candidates found, by place."""
        places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length in np.unique(self.length).tolist():
            h, inside = runs_of(words, at, length)
            h = h + U64(length)
            a = np.searchsorted(self.seed, h)
            near = np.minimum(a, len(self.seed) - 1)
            place = np.flatnonzero(inside & (self.seed[near] == h))
            a = a[place]
            number = np.searchsorted(self.seed, h[place], "right") - a
            candidate = np.repeat(a - np.cumsum(number) + number, number) + np.arange(number.sum())
            same = self.length[candidate] == length
            places.append(np.repeat(place, number)[same])
            found.append(candidate[same])
        place, candidate = np.concatenate(places), np.concatenate(found)
        order = np.lexsort((candidate, place))
        return place[order], candidate[order]


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each item with its passage: score, first and last word of the
    passage's part, and the number of equal words in it.

    All pairs advance together, one item word at a time. Each cell carries where
    its alignment began and its matches, packed below the score in as many bits as the
    longest item and passage need (``windows`` bounds the passages, so 63 always do).
    """
    n = len(items)
    rows, columns = max(map(len, items)), max(map(len, passages))
    left = np.zeros((n, rows), U64)
    right = np.zeros((n, columns), U64)
    for i, (a, b) in enumerate(zip(items, passages, strict=True)):
        left[i, : len(a)], right[i, : len(b)] = a, b
    real = np.arange(columns) < np.array([len(b) for b in passages])[:, None]
    count = np.array([len(a) for a in items])
    # a cell is score, start word + 1 counted from the far end, matches: larger is better
    small = rows.bit_length()
    wide = small + columns.bit_length()
    if wide + (MATCH * rows - GAP * columns).bit_length() > 63:
        raise ValueError(f"an item of {rows} words with a passage of {columns}")
    unit, low = np.int64(1) << wide, (np.int64(1) << wide) - 1
    column = np.arange(columns, dtype=np.int64)
    fresh = (columns - column) << small  # an alignment that starts here
    cell = np.zeros((n, columns), np.int64)
    best, best_at = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for r in range(rows):
        live = r < count
        equal = (left[:, r : r + 1] == right) & real & live[:, None]
        corner = np.concatenate((np.zeros((n, 1), np.int64), cell[:, :-1]), axis=1)
        begun = np.where(corner >= unit, corner, fresh)
        step = np.where(equal, begun + MATCH * unit + 1, np.where(corner >= unit, corner + MISS * unit, 0))
        step = np.maximum(step, np.where(cell >= unit, cell + GAP * unit, 0))
        # gaps along the passage: the best of all earlier cells less their distance
        slope = column * -GAP * unit
        along = np.maximum.accumulate(step + slope, axis=1) - slope
        cell_new = np.maximum(step, along)
        cell_new = np.where((cell_new >= unit) & live[:, None], cell_new, 0)
        cell = cell_new
        top = cell.argmax(axis=1)
        value = cell[np.arange(n), top]
        better = value > best
        best[better], best_at[better] = value[better], top[better]
    start = columns - ((best & low) >> small)
    return best >> wide, np.where(best > 0, start, 0), best_at, best & ((1 << small) - 1)


def windows(low: np.ndarray, high: np.ndarray, size: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, first word, word after the last) of the passages, wide ones cut with an overlap.

    Each word of the passage beyond the item's costs a gap, so an alignment that reaches
    the threshold has no more than ``reach`` words and lies in one of the windows whole.
    """
    reach = size + np.ceil(MATCH * (1 - threshold) * size / -GAP).astype(np.int64) + 1
    step = np.maximum(4096, size // 64)
    number = np.maximum(1, -(-(high - low - reach) // step))
    which = np.repeat(np.arange(len(low)), number)
    begin = low[which] + (np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)) * step[which]
    return which, begin, np.minimum(high[which], begin + reach[which] + step[which])


def passages_of(items: Items, words: np.ndarray, at: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """(document, item, first word, word after the last) of all passages with seeds that may
    reach the threshold."""
    place, candidate = items.hits(words, at)
    doc = np.searchsorted(at, place, "right") - 1
    item = items.item[candidate]
    size = np.diff(items.at)[item]
    begin = place - items.place[candidate]  # where the item would start
    order = np.lexsort((begin, item, doc))
    doc, item, begin, size, rare = doc[order], item[order], begin[order], size[order], items.rare[candidate[order]]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > size[1:] // 2 + 2)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1 if len(first) else first
    slack = size[first] // 4 + 4  # room for words put in
    low = np.maximum(at[doc[first]], begin[first] - slack)
    high = np.minimum(at[doc[first] + 1], begin[last] + size[first] + slack)
    keep = np.logical_or.reduceat(rare, first) if len(first) else rare
    for x in np.flatnonzero(~keep).tolist():
        own = items.words[items.at[item[first[x]]] : items.at[item[first[x]] + 1]]
        # matches are at most the item's words that the passage has
        keep[x] = np.isin(own, words[low[x] : high[x]]).sum() >= threshold * len(own)
    return doc[first][keep], item[first][keep], low[keep], high[keep]


def best_scores(items: Items, words: np.ndarray, at: np.ndarray, threshold: float) -> list[tuple]:
    """(document, item, score, first and last word, matches) of the best passage of each pair."""
    doc, item, low, high = passages_of(items, words, at, threshold)
    size = np.diff(items.at)
    which, low, high = windows(low, high, size[item], threshold)
    doc, item = doc[which], item[which]
    order = np.lexsort((high - low, size[item]))
    out: dict[tuple[int, int], tuple] = {}
    i = 0
    while i < len(order):
        j, cells = i, 0
        while j < len(order) and (j == i or cells < CELLS):  # pairs of about one size together
            cells = (j - i + 1) * int(high[order[j]] - low[order[j]])
            j += 1
        at_once = order[i:j].tolist()
        score, a, b, same = align(
            [items.words[items.at[item[x]] : items.at[item[x] + 1]] for x in at_once], [words[low[x] : high[x]] for x in at_once]
        )
        for x, s, p, q, m in zip(at_once, score.tolist(), a.tolist(), b.tolist(), same.tolist(), strict=True):
            share = s / (MATCH * size[item[x]])
            if share >= threshold:
                key, base = (int(doc[x]), int(item[x])), int(low[x] - at[doc[x]])
                row = (share, -(base + p), base + q, m)
                out[key] = max(out.get(key, row), row)
        i = j
    return [(*key, row[0], -row[1], row[2], row[3]) for key, row in sorted(out.items())]


def item_blocks(benchmark: DataFrame, seed_words: int) -> Iterator[Items]:
    """The test items in blocks of bounded size, in order of item_id."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    ids, texts, words = [], [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():  # holds one partition at a time
        parts = row["text"].split() or [""]
        for a in range(0, len(parts), BLOCK_WORDS):
            piece = parts[a : a + BLOCK_WORDS]
            if ids and (len(ids) >= BLOCK_ITEMS or words + len(piece) > BLOCK_WORDS):
                yield Items(ta.ids(pa.array(ids, pa.int64())), texts, seed_words)
                ids, texts, words = [], [], 0
            ids.append(row["item_id"])
            texts.append(" ".join(piece))
            words += len(piece)
    if ids:
        yield Items(ta.ids(pa.array(ids, pa.int64())), texts, seed_words)


def seed_counts(texts: DataFrame, items: Items) -> np.ndarray:
    """Number of documents that hold each seed candidate of a block."""
    seeds = np.unique(items.seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(seeds), np.int64)
        for batch in batches:
            data, offs = ta.flat(batch.column(0))
            for i, j in ta.slices(offs, SLICE):
                words, at = plain_words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                place, candidate = items.hits(words, at)
                doc = np.searchsorted(at, place, "right") - 1
                which = np.searchsorted(seeds, items.seed[candidate])
                pairs = np.unique(doc * len(seeds) + which)
                total += np.bincount(pairs % max(1, len(seeds)), minlength=len(seeds))
            del batch, data  # the batch's memory goes back before the next one arrives
            give_back()
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["seed", "n"])

    rows = texts.mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(len(seeds), np.int64)
    n[rows["seed"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return n[np.searchsorted(seeds, items.seed)]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, seed_words: int = SEED_WORDS, rare_share: float = RARE_SHARE
) -> DataFrame:
    """(document, item) pairs whose alignment reaches ``threshold`` of a perfect copy:
    doc_id, item_id, score, words of the document from first_word to last_word,
    n_matched equal words of the item's item_words."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = [docs.mapInArrow(search(items, threshold), FOUND) for items in seeded_blocks(docs, benchmark, seed_words, rare_share)]
    if not found:
        return docs.sparkSession.createDataFrame([], FOUND)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def seeded_blocks(docs: DataFrame, benchmark: DataFrame, seed_words: int, rare_share: float) -> Iterator[Items]:
    """Blocks of test items with their seeds, marked by their frequency in all of ``docs``."""
    n_docs = docs.count()
    for items in item_blocks(benchmark, seed_words):
        if len(items.seed):
            counts = seed_counts(docs.select(F.col("text").cast("string")), items)
            items.mark(counts <= max(RARE_LEAST, rare_share * n_docs))
            yield items


def clean_rows(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, seed_words: int = SEED_WORDS, rare_share: float = RARE_SHARE):
    """A test of texts for ``keep_rows`` per block of items: whether they hold none of them."""

    def test_of(items: Items):
        def test(texts: pa.Array) -> np.ndarray:
            clean = np.ones(len(texts), bool)
            data, offs = ta.flat(texts)
            for i, j in ta.slices(offs, SLICE):
                words, at = plain_words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                clean[[i + row[0] for row in best_scores(items, words, at, threshold)]] = False
            return clean

        return test

    return [test_of(items) for items in seeded_blocks(docs, benchmark, seed_words, rare_share)]


def search(items: Items, threshold: float):
    """Arrow function: the contaminated pairs of a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.diff(items.at)
        for batch in batches:
            ids = ta.ids(batch.column(0))
            data, offs = ta.flat(batch.column(1))
            for i, j in ta.slices(offs, SLICE):
                words, at = plain_words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                rows = best_scores(items, words, at, threshold)
                if not rows:
                    continue
                doc, item, score, first, last, same = (np.array(x) for x in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [ta.id_array(ids[i:j][doc]), ta.id_array(items.ids[item]), pa.array(score.astype(float)), *(pa.array(x.astype(np.int64)) for x in (first, last, same, size[item]))],
                    names=["doc_id", "item_id", "score", "first_word", "last_word", "n_matched", "item_words"],
                )
            del batch, data
            give_back()

    return run


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a paraphrased or edited copy of one."""
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
