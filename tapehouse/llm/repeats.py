"""Operator 9: removal of repeated passages by longest-previous-factor arrays.

A byte goes when a ``WINDOW``-byte string covers it that also starts in a
document with a smaller doc_id. Suffixes that share so long a prefix have to
meet, without sending every suffix:

1. Every window belongs to its anchor, the ``GRAM``-byte string in it with the
   smallest hash (leftmost at a tie), so equal windows have equal anchors.
   A string that is frequent in the whole table comes after all others, so that
   what a third of the documents share with different surroundings is split by
   these surroundings instead of meeting in one bucket (``frequent_grams``).
   Neighbouring windows with one anchor form a unit of at most
   ``WINDOW - GRAM + 1`` windows. A task sends its units (anchor hash, content
   hash, place) to hash buckets; of equal units of many documents of a batch only
   those of the smallest doc_id, as the others are settled.
2. In a bucket, a unit that a smaller document has too is removed whole. Where
   an anchor has units of different content, their windows may still agree:
   the first document of each such unit is asked for its bytes.
3. These bytes meet by anchor. Their suffixes are sorted to a depth of
   ``WINDOW`` bytes; previous and next smaller values (of the document, along
   the suffix order) give each suffix its longest previous factor, and a window
   goes where that reaches ``WINDOW`` bytes. The first document keeps its text.
4. The removed ranges meet their documents.

Nulls and edges: a null text counts as empty; texts shorter than ``WINDOW``
stay whole; a null doc_id counts as larger than all others and is kept; rows
that share a doc_id are one document (what is removed from one of them is
removed, by position, from all); matches inside one document do not count; an
empty table gives an empty result; other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.llm import textarrays as ta
from tapehouse.llm.shuffling import buckets, chunked, documents, give_back, packed_batch, routed, unpacked, written

U64 = np.uint64
WINDOW, GRAM = 50, 20
SEGMENT = 1 << 20
#: Places in a text for each unit, about: an anchor is the least of WINDOW - GRAM + 1 places.
GRAMS_PER_UNIT = (WINDOW - GRAM + 1) // 2 + 1


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest earlier value that is smaller, or -1 (pointer jumping)."""
    at = np.arange(-1, len(values) - 1)
    unsettled = np.flatnonzero(at >= 0)
    while True:
        unsettled = unsettled[(at[unsettled] >= 0) & (values[at[unsettled]] >= values[unsettled])]
        if not len(unsettled):
            return at
        at[unsettled] = at[at[unsettled]]


def next_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest later value that is smaller, or ``len(values)``."""
    n = len(values)
    return n - 1 - previous_smaller(values[::-1])[::-1]


def merge_runs(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching byte ranges of each document as one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    new_doc = np.append(True, doc[1:] != doc[:-1])
    rank = np.cumsum(new_doc)
    room = int(end.max()) + 1
    reach = np.maximum.accumulate(rank * room + end) - rank * room
    fresh = new_doc.copy()
    fresh[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    return doc[first], start[first], reach[np.append(first[1:], len(doc)) - 1]


def segments(offs: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of bytes to work on: (first byte, offsets in it, document of each part,
    the part's first byte in its document). Parts of a long document overlap by
    ``WINDOW - 1`` bytes, so each window is in one of them."""
    for i, j in ta.slices(offs, SEGMENT):
        size = int(offs[j] - offs[i])
        if j - i > 1 or size <= SEGMENT:
            yield int(offs[i]), offs[i : j + 1] - offs[i], np.arange(i, j), np.zeros(j - i, np.int64)
            continue
        for a in range(0, size - WINDOW + 1, SEGMENT):
            b = min(size, a + SEGMENT + WINDOW - 1)
            yield int(offs[i]) + a, np.array([0, b - a]), np.array([i]), np.array([a])


def frequent_grams(docs: DataFrame, n_buckets: int) -> np.ndarray:
    """Hashes, in order, of all ``GRAM``-byte strings at one in ``GRAMS_PER_UNIT * n_buckets`` places or more.

    About one place in ``GRAMS_PER_UNIT`` begins a unit, so the units of any other
    string are no more than an average bucket holds. Each stretch of text reports
    the strings at half that share of its places, which a string of the full share
    cannot miss everywhere; at most ``2 * GRAMS_PER_UNIT * n_buckets`` can reach
    half the share of all places, and no more come to the driver. The list decides
    where windows meet, never which of them are equal.
    """
    share = 1 / (GRAMS_PER_UNIT * n_buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = ta.flat(batch.column(0))
            for lo, at, _, _ in segments(offs):
                place = np.arange(at[-1] - GRAM + 1)
                h = np.sort(ta.span_hash(data[lo : lo + at[-1]], place, place + GRAM)) if len(place) else np.zeros(0, U64)
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
                count = np.diff(np.append(first, len(h)))
                often = count >= max(2, share / 2 * len(h))
                grams = pa.array(h[first[often]].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pa.nulls(1, pa.int64()), grams]), pa.array(np.append(len(h), count[often]))],
                    names=["gram", "places"],
                )

    counts = docs.select("text").mapInArrow(run, "gram long, places long").groupBy("gram").agg(F.sum("places").alias("places"))
    # the row without a gram counts all places, so it comes first
    top = counts.orderBy(F.desc("places"), F.asc_nulls_first("gram")).limit(1 + 2 * GRAMS_PER_UNIT * n_buckets).collect()
    least = share / 2 * top[0].places if top else 0
    return np.sort(np.array([r.gram for r in top[1:] if r.places >= least], np.int64).view(U64))


def among(h: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which of ``h`` are in the sorted list ``few``."""
    seen = np.zeros(1 << 16, bool)
    seen[few >> U64(48)] = True
    out = seen[h >> U64(48)]
    at = np.flatnonzero(out)
    out[at] = few[np.minimum(np.searchsorted(few, h[at]), len(few) - 1)] == h[at]
    return out


def units(data: np.ndarray, offs: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, part, first window and number of windows of all units."""
    size = np.diff(offs)
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none.view(U64), none.view(U64), none, none, none
    place = np.arange(n - GRAM + 1)
    h = ta.span_hash(data, place, place + GRAM)
    rank = h >> U64(33)
    if len(frequent):
        rank[among(h, frequent)] |= U64(1 << 31)
    least = (rank << U64(32)) | place.astype(U64)
    width = 1
    while 2 * width <= WINDOW - GRAM + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = WINDOW - GRAM + 1 - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    step = np.zeros(n + 1, np.int8)
    long = size >= WINDOW
    np.add.at(step, offs[:-1][long], 1)
    np.add.at(step, offs[1:][long] - WINDOW + 1, -1)
    start = np.flatnonzero(np.cumsum(step)[: len(least)])
    anchor = (least[start] & U64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(start) else none
    number = np.diff(np.append(first, len(start)))
    a = start[first]
    content = ta.span_hash(data, a, a + number + WINDOW - 1)
    return h[anchor[first]], content, np.searchsorted(offs, a, "right") - 1, a, number


def later_copies(content: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which units a smaller document among them has too."""
    order = np.lexsort((doc, content))
    of = content[order]
    fresh = np.append(True, of[1:] != of[:-1])[: len(of)]
    least = doc[order][np.maximum.accumulate(np.where(fresh, np.arange(len(of)), 0))]
    out = np.zeros(len(of), bool)
    out[order] = doc[order] > least
    return out


def unit_rows(docs: DataFrame, n_buckets: int, frequent: np.ndarray) -> DataFrame:
    """Packed units by bucket (kind 0) and packed ranges that are already settled (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = ta.ids(batch.column(0))
            data, offs = ta.flat(batch.column(1))
            found = []
            for lo, at, which, shift in segments(offs):
                anchor, content, part, start, number = units(data[lo : lo + at[-1]], at, frequent)
                place = (start - at[part] + shift[part]).astype(np.int32)
                found.append((anchor, content, doc_id[which[part]], place, number.astype(np.uint8)))
            if not found:
                continue
            anchor, content, doc, start, number = (np.concatenate(x) for x in zip(*found, strict=True))
            found.clear()
            later = later_copies(content, doc)
            begin = start[later].astype(np.int64)
            runs = merge_runs(doc[later], begin, begin + number[later] + WINDOW - 1)
            yield kind_batch(1, (ta.mix(runs[0].view(U64)) % U64(n_buckets)).astype(np.int32), {"doc": runs[0], "start": runs[1], "extra": runs[2]})
            keep = ~later  # in the order of the text, so that ids and places compress
            anchor, content, doc, start, number = (x[keep] for x in (anchor, content, doc, start, number))
            columns = {"doc": doc, "start": start, "extra": number, "anchor": anchor, "content": content}
            yield kind_batch(0, (ta.mix(anchor) % U64(n_buckets)).astype(np.int32), columns)
            give_back()

    return docs.mapInArrow(run, ROWS)


ROWS = "bucket int, kind int, doc binary, start binary, extra binary, anchor binary, content binary"


def kind_batch(kind: int, bucket: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    out = packed_batch(bucket, columns)
    n = out.num_rows
    given = dict(zip(out.schema.names, out.columns, strict=True))
    arrays = [out.column(0), pa.array(np.full(n, kind, np.int32))]
    arrays += [given.get(k, pa.nulls(n, pa.binary())) for k in ("doc", "start", "extra", "anchor", "content")]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "kind", "doc", "start", "extra", "anchor", "content"])


def of_kind(table: pa.Table, kind: int) -> pa.Table:
    return table.filter(pa.array(np.asarray(table.column("kind")) == kind))


SETTLED = "kind int, doc binary, start binary, extra binary, anchor binary"
RANGE = {"doc": np.int64, "start": np.int64, "extra": np.int64}


def ranges_of(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    """Ranges to remove (kind 1) as rows of ``SETTLED``."""
    out = chunked({"doc": doc, "start": start, "extra": end})
    out = out.add_column(0, "kind", pa.array(np.full(out.num_rows, 1, np.int32)))
    return out.append_column("anchor", pa.nulls(out.num_rows, pa.binary()))


def settle_units(table: pa.Table) -> pa.Table:
    """Group function of a bucket of units: ranges to remove (kind 1) and the units
    whose bytes are wanted (kind 2), in few rows."""
    done, open_ = of_kind(table, 1), of_kind(table, 0)
    doc, start = unpacked(open_, "doc", np.int64), unpacked(open_, "start", np.int32).astype(np.int64)
    number, anchor = unpacked(open_, "extra", np.uint8).astype(np.int64), unpacked(open_, "anchor", U64)
    content = unpacked(open_, "content", U64)
    order = np.lexsort((doc, content, anchor))
    doc, start, number, anchor, content = (x[order] for x in (doc, start, number, anchor, content))
    n = len(doc)
    new_anchor = np.append(True, anchor[1:] != anchor[:-1])[:n]
    fresh = np.append(True, content[1:] != content[:-1])[:n] | new_anchor
    least = doc[np.maximum.accumulate(np.where(fresh, np.arange(n), 0))] if n else doc
    later = doc > least
    of = np.cumsum(new_anchor) - 1
    kinds = np.bincount(of, weights=fresh, minlength=1)  # units of different content by anchor
    ask = ~later & (kinds[of] > 1) if n else later
    old = [unpacked(done, k, np.int64) for k in ("doc", "start", "extra")]
    new = [doc[later], start[later], start[later] + number[later] + WINDOW - 1]
    runs = merge_runs(*(np.concatenate(x) for x in zip(old, new, strict=True)))
    wanted = chunked({"doc": doc[ask], "start": start[ask], "extra": number[ask], "anchor": anchor[ask]})
    wanted = wanted.add_column(0, "kind", pa.array(np.full(wanted.num_rows, 2, np.int32)))
    return pa.concat_tables([ranges_of(*runs), wanted])


UNIT = {"doc": np.int64, "start": np.int64, "number": np.int64, "anchor": U64}


def unit_bytes(texts: pa.Table, wanted: pa.Table) -> pa.Table:
    """Cogroup function: the units asked for with their bytes, in few rows."""
    empty = chunked({k: np.zeros(0, t) for k, t in UNIT.items()}, ("bytes", np.zeros(0, np.uint8), np.zeros(0, np.int64)))
    if not wanted.num_rows or not texts.num_rows:
        return empty
    doc, start = unpacked(wanted, "doc", np.int64), unpacked(wanted, "start", np.int64)
    number, anchor = unpacked(wanted, "extra", np.int64), unpacked(wanted, "anchor", U64)
    order = np.lexsort((start, doc))
    doc, start, number, anchor = doc[order], start[order], number[order], anchor[order]
    ids = ta.ids(texts.column("doc_id"))
    data, offs = ta.flat(texts.column("text"))
    out = []
    a, b = np.searchsorted(doc, ids), np.searchsorted(doc, ids, "right")
    for i in np.flatnonzero(b > a).tolist():
        r = slice(a[i], b[i])
        r_number = np.where(start[r] + number[r] + WINDOW - 1 <= offs[i + 1] - offs[i], number[r], 0)
        ok = r_number > 0  # another row with this doc_id may be longer
        out.append((doc[r][ok], start[r][ok], r_number[ok], anchor[r][ok], offs[i] + start[r][ok]))
    if not out:
        return empty
    doc, start, number, anchor, place = (np.concatenate(x) for x in zip(*out, strict=True))
    size = number + WINDOW - 1
    raw = data[np.repeat(place - np.cumsum(size) + size, size) + np.arange(size.sum())]
    return chunked({"doc": doc, "start": start, "number": number, "anchor": anchor}, ("bytes", raw, size))


def earlier_windows(raw: np.ndarray, place: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which windows (starting at ``place`` in ``raw``) also start in a smaller document.

    Suffixes are sorted by eight bytes at a time; those that are alone at some
    depth have no factor of ``WINDOW`` bytes and leave.
    """
    live = np.arange(len(place))
    rank = np.zeros(len(place), np.int64)
    for depth in [*range(0, WINDOW - 7, 8), WINDOW - 8]:
        word = raw[place[live][:, None] + np.arange(depth, depth + 8)].view(">u8").ravel().astype(U64)
        order = np.lexsort((word, rank))
        live, word, rank = live[order], word[order], rank[order]
        fresh = np.append(True, (word[1:] != word[:-1]) | (rank[1:] != rank[:-1]))[: len(live)]
        rank = np.cumsum(fresh)
        alone = fresh & np.append(fresh[1:], True)[: len(live)]
        live, rank = live[~alone], rank[~alone]
        if not len(live):
            break
    out = np.zeros(len(place), bool)
    if len(live):
        order = np.lexsort((live, rank))  # equal prefixes stand in order of position
        live, rank = live[order], rank[order]
        value = doc[live]
        before, after = previous_smaller(value), next_smaller(value)
        reach = (before >= 0) & (rank[np.maximum(before, 0)] == rank)
        reach |= (after < len(live)) & (rank[np.minimum(after, len(live) - 1)] == rank)
        out[live] = reach
    return out


def settle_windows(table: pa.Table) -> pa.Table:
    """Group function of a bucket of unit bytes: ranges to remove."""
    doc, start = unpacked(table, "doc", np.int64), unpacked(table, "start", np.int64)
    number, raw = unpacked(table, "number", np.int64), unpacked(table, "bytes", np.uint8)
    size = number + WINDOW - 1
    offset = np.cumsum(size) - size
    unit = np.repeat(np.arange(len(doc)), number)
    within = np.arange(len(unit)) - np.repeat(np.cumsum(number) - number, number)
    gone = earlier_windows(raw, offset[unit] + within, doc[unit])
    unit, within = unit[gone], within[gone]
    first = start[unit] + within
    return ranges_of(*merge_runs(doc[unit], first, first + WINDOW))


def remove_runs(texts: pa.Table, ranges: pa.Table) -> pa.Table:
    """Cogroup function: every document without its removed ranges."""
    n = texts.num_rows
    ids = ta.ids(texts.column("doc_id")) if n else np.zeros(0, np.int64)
    data, offs = ta.flat(texts.column("text")) if n else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
    if ranges.num_rows:
        doc, start, end = merge_runs(*(unpacked(ranges, k, np.int64) for k in ("doc", "start", "extra")))
    else:
        doc = start = end = np.zeros(0, np.int64)
    a, b = np.searchsorted(doc, ids), np.searchsorted(doc, ids, "right")
    rows = []
    for i in range(n):
        raw = data[offs[i] : offs[i + 1]]
        size = len(raw)
        cuts = [(s, min(e, size)) for s, e in zip(start[a[i] : b[i]].tolist(), end[a[i] : b[i]].tolist(), strict=True) if s < size]
        kept, last = [], 0
        for s, e in cuts:
            kept.append(raw[last:s].tobytes())
            last = e
        kept.append(raw[last:].tobytes())
        rest = b"".join(kept)
        rows.append((size, size - len(rest), len(cuts), hashlib.sha256(rest).hexdigest(), rest))
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], [], []]
    return pa.table(
        {
            "doc_id": ta.id_array(ids),
            "n_bytes": pa.array(columns[0], pa.int64()),
            "n_removed": pa.array(columns[1], pa.int64()),
            "n_spans": pa.array(columns[2], pa.int64()),
            "kept_sha256": pa.array(columns[3], pa.string()),
            "kept": pa.array(columns[4], pa.binary()),
        }
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n = buckets(spark)
    sent = unit_rows(docs, n, frequent_grams(docs, n))
    settled = written(sent.groupBy("bucket").applyInArrow(settle_units, SETTLED), "repeats", by="kind")

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = (ta.mix(ta.ids(batch.column(0)).view(U64)) % U64(n)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns], names=["bucket", "doc_id", "text"])

    texts = docs.mapInArrow(grouped, "bucket int, doc_id long, text string").groupBy("bucket")
    asked = routed(settled.where("kind = 2"), n, "doc", {**RANGE, "anchor": U64})
    contents = texts.cogroup(asked.groupBy("bucket")).applyInArrow(
        unit_bytes, "doc binary, start binary, number binary, anchor binary, bytes binary"
    )
    met = routed(contents, n, "anchor", UNIT, ("bytes", lambda c: c["number"] + WINDOW - 1)).drop("anchor")
    found = met.groupBy("bucket").applyInArrow(settle_windows, SETTLED)
    ranges = routed(settled.where("kind = 1"), n, "doc", RANGE).unionByName(routed(found, n, "doc", RANGE))
    return texts.cogroup(ranges.groupBy("bucket")).applyInArrow(
        remove_runs, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-byte strings that smaller doc_ids have too."""
    return without_repeats(documents(spark, sf_dir)).drop("kept")
