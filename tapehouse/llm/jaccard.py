"""Operator 8: exact n-gram Jaccard join.

A document's set holds its distinct shingles of ``k`` lower-cased words; two
documents link when ``100 * |A & B| >= percent * |A | B|``. The join keeps every
link's effect on the components and is exact:

1. One pass counts shingles that many documents share (bounded summaries of
   every task). They only order the shingles, rare ones first. Documents with
   equal sets are one from here on, the one with the smallest doc_id.
2. A linked pair shares a shingle among the first ``n - ceil(percent * n / 100) + 1``
   of each document in that order (prefix filter). Tasks send these, packed, to
   hash buckets: five bytes of the shingle's hash (two shingles that agree there
   cost a comparison, no more), the document and its band of sizes.
3. Documents that share such a shingle and lie in the same or the next band of
   sizes form a tile, named after its smallest doc_id, so the tiles of many
   shingles fall together. A list of more than ``TILE_ROWS`` members is split
   into blocks, with a tile for every pair of blocks.
4. Documents with a tile send a hashed parity bitmap there, of about a bit per
   shingle. Sizes and bit counts bound the overlap of each pair in a tile from
   above; documents that have no pair within the bound leave the tile.
5. The others send their whole sorted sets, and pairs within the bound are
   intersected exactly. Pairs already connected are skipped, so a tile gives a
   spanning forest, not all pairs.
6. Components of these links, with documents of equal sets in one component.

Nulls and edges: null or empty text, or text without words, has an empty set
and links with nothing (its component is its own doc_id); texts of fewer than
``k`` words have one shingle; rows that share a doc_id are one node; rows with
a null doc_id keep a null component and take no part in components; an
empty table gives an empty result; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.llm import textarrays as ta
from tapehouse.llm.shuffling import buckets, chunked, components, documents, give_back, routed, unpacked, written

U64 = np.uint64
COMMON, COMMON_IN_TASK = 1 << 17, 8
TILE_ROWS = 4096


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles of which a linked document must share one: n - ceil(percent * n / 100) + 1."""
    return n - (percent * n + 99) // 100 + 1


def band(n: np.ndarray, percent: int) -> np.ndarray:
    """Size band: linked documents are in the same or neighbouring bands."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / percent) + 1e-9).astype(np.int64)


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    return ta.unique_sorted(*ta.shingles(ta.lower_ascii(data), offs, k))


def common_shingles(docs: DataFrame, k: int, most: int = COMMON) -> np.ndarray:
    """At most ``most`` shingles in many documents, the most frequent last.

    Only the order of shingles depends on them, never a result. Each task keeps
    a summary of bounded size over all its documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, counts = np.zeros(0, U64), np.zeros(0, np.int64)
        for batch in batches:
            data, offs = ta.flat(batch.column(0))
            for i, j in ta.slices(offs):
                values, _ = shingle_sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
                values.sort()
                first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, int)
                number = np.diff(np.append(first, len(values)))
                again = number > 1
                both = np.concatenate((kept, values[first][again]))
                weight = np.concatenate((counts, number[again]))
                kept, inverse = np.unique(both, return_inverse=True)
                counts = np.bincount(inverse, weights=weight, minlength=len(kept)).astype(np.int64)
                if len(kept) > 2 * most:
                    top = np.argpartition(counts, len(kept) - most)[len(kept) - most :]
                    top.sort()
                    kept, counts = kept[top], counts[top]
            give_back()
        often = counts >= COMMON_IN_TASK
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept[often].view(np.int64)), pa.array(counts[often])], names=["shingle", "n"]
        )

    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "shingle long, n long")
    top = found.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(most)
    rows = top.toArrow()
    return rows.column("shingle").to_numpy().view(U64)[::-1].copy()


def ordered(values: np.ndarray, common: np.ndarray, lookup: np.ndarray) -> np.ndarray:
    """Sort keys of shingles: by hash, but common ones after all others, rarest first."""
    key = values >> U64(1)
    if len(common):
        at = np.minimum(np.searchsorted(common[lookup], values), len(common) - 1)
        hit = common[lookup][at] == values
        key[hit] = U64(1 << 63) + lookup[at[hit]].astype(U64)
    return key


def set_hashes(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set that do not depend on the order of its items."""
    s1 = np.concatenate(([U64(0)], np.cumsum(ta.mix(values), dtype=U64)))
    s2 = np.concatenate(([U64(0)], np.cumsum(ta.mix(values ^ U64(ta.GAMMA)), dtype=U64)))
    return s1[at[1:]] - s1[at[:-1]], s2[at[1:]] - s2[at[:-1]]


def set_sizes(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles and two hashes of the set of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = ta.flat(batch.column(1))
            for i, j in ta.slices(offs):
                values, at = shingle_sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
                s1, s2 = set_hashes(values, at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(at)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64))],
                    names=["doc_id", "n_shingles", "s1", "s2"],
                )
            give_back()

    return docs.mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long")


#: Bytes of a prefix shingle's hash that are sent, beyond those that its bucket tells.
TOKEN_BYTES = 5
PREFIX = {"token": U64, "doc": np.int64, "level": np.int16}


def prefixes(k: int, percent: int, common: np.ndarray):
    """Cogroup function: the prefix shingles of those documents of a group that are the
    first with their set, in few rows."""

    def run(texts: pa.Table, firsts: pa.Table) -> pa.Table:
        out = [chunked({c: np.zeros(0, t) for c, t in PREFIX.items()})]
        if not texts.num_rows or not firsts.num_rows:
            return out[0]
        lookup = np.argsort(common)
        doc = ta.ids(texts.column("doc_id"))
        asked = np.flatnonzero(np.isin(doc, ta.ids(firsts.column("doc_id"))))
        data, offs = ta.flat(texts.column("text").take(pa.array(asked)))
        doc = doc[asked]
        for i, j in ta.slices(offs):
            values, at = shingle_sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
            n = np.diff(at)
            keys = ordered(values, common, lookup)
            p = np.where(n > 0, prefix_size(n, percent), 0)
            for a, b, q in zip(at[:-1].tolist(), at[1:].tolist(), p.tolist(), strict=True):
                if q and q < b - a:
                    keys[a:b].partition(q - 1)
            flat = np.repeat(at[:-1] - np.cumsum(p) + p, p) + np.arange(p.sum())
            level = band(n, percent).astype(np.int16)
            out.append(chunked({"token": keys[flat], "doc": np.repeat(doc[i:j], p), "level": np.repeat(level, p)}))
        give_back()
        return pa.concat_tables(out)

    return run


def planes(values: np.ndarray) -> bytes:
    """Bytes of ``values``, all first bytes first, so that high bytes compress to nothing."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(raw: bytes, dtype, width: int) -> np.ndarray:
    """Back from ``planes``, of which the first ``width`` were kept."""
    kept = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((kept.shape[1], np.dtype(dtype).itemsize), np.uint8)
    out[:, :width] = kept.T
    return out.view(dtype).ravel()


def prefix_cell(n_buckets: int):
    """Encoder of a bucket's prefix shingles: documents as differences of neighbours in order."""

    def encode(values: dict[str, np.ndarray]) -> dict[str, bytes]:
        order = np.argsort(values["doc"], kind="stable")
        token = ta.mix(values["token"][order]) // U64(n_buckets)
        doc = values["doc"][order]
        steps = np.concatenate((doc[:1], np.diff(doc)))
        return {
            "token": planes(token)[: TOKEN_BYTES * len(token)],
            "doc": planes(steps),
            "level": planes(values["level"][order]),
        }

    return encode


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted by ``a``, then ``b``."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[fresh], b[fresh]


def tile_members(percent: int):
    """Group function of a bucket of prefix shingles: which documents go to which tiles."""

    def run(table: pa.Table) -> pa.Table:
        cells = [table.column(c).to_pylist() for c in PREFIX]
        token = np.concatenate([from_planes(x, U64, TOKEN_BYTES) for x in cells[0]])
        doc = np.concatenate([np.cumsum(from_planes(x, np.int64, 8)) for x in cells[1]])
        own = np.concatenate([from_planes(x, np.int16, 2) for x in cells[2]]).astype(np.int64)
        order = np.lexsort((doc, token))
        token, doc, own = token[order], doc[order], own[order]
        several = np.zeros(len(token), bool)
        several[1:] = token[1:] == token[:-1]
        several[:-1] |= several[1:]
        token, doc, own = token[several], doc[several], own[several]
        # each document is in the tile of its band and in that of the band below
        key = np.concatenate((token, token))
        level = np.concatenate((own, own - 1))
        doc = np.concatenate((doc, doc))
        upper = np.concatenate((np.zeros(len(own), bool), np.ones(len(own), bool)))
        order = np.lexsort((doc, level, key))
        key, level, doc, upper = key[order], level[order], doc[order], upper[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (level[1:] != level[:-1])
        start = np.flatnonzero(first)
        number = np.diff(np.append(start, len(key)))
        live = number > 1
        if len(start):  # without a document of its own band a tile has no pair
            live &= ~np.logical_and.reduceat(upper, start)
        tiles, members = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        take = np.repeat(live & (number <= TILE_ROWS), number)
        centre = np.repeat(doc[start], number)
        name = ta.mix(centre.view(U64) * U64(ta.GAMMA) + level.view(U64))
        tiles.append(name[take])
        members.append(doc[take])
        for s in np.flatnonzero(live & (number > TILE_ROWS)).tolist():  # pairs of blocks
            a, n = int(start[s]), int(number[s])
            blocks = 1 << int(np.ceil(np.log2(n / TILE_ROWS)) + 1)
            of = (ta.mix(doc[a : a + n].view(U64)) % U64(blocks)).astype(np.int64)
            for other in range(blocks):
                pair = np.minimum(of, other) * blocks + np.maximum(of, other) + 1
                tiles.append(ta.mix(name[a : a + n] + pair.astype(U64) * U64(ta.MIX_2) + U64(blocks)))
                members.append(doc[a : a + n])
        tile, member = np.concatenate(tiles), np.concatenate(members)
        member, tile = distinct_pairs(member, tile)
        return chunked({"member": member, "tile": tile})

    return run


MEMBER = {"member": np.int64, "tile": U64}
TILE = {"tile": U64, "doc": np.int64, "size": np.int64}


def tile_rows(k: int, form):
    """Cogroup function: the set of every document, as bytes made by ``form``, for each of its tiles."""

    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        out = [chunked({c: np.zeros(0, t) for c, t in TILE.items()}, ("items", none.view(np.uint8), none))]
        member, tile = unpacked(wanted, "member", np.int64), unpacked(wanted, "tile", U64)
        if not len(member) or not texts.num_rows:
            return out[0]
        member, tile = distinct_pairs(member, tile)
        doc = ta.ids(texts.column("doc_id"))
        asked = np.flatnonzero(np.isin(doc, member))
        data, offs = ta.flat(texts.column("text").take(pa.array(asked)))
        doc = doc[asked]
        for i, j in ta.slices(offs):
            values, at = shingle_sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
            a, b = np.searchsorted(member, doc[i:j]), np.searchsorted(member, doc[i:j], "right")
            count = b - a
            which = np.repeat(np.arange(j - i), count)
            to = tile[np.repeat(a - np.cumsum(count) + count, count) + np.arange(count.sum())]
            size = np.diff(at)
            made = {d: form(values[at[d] : at[d + 1]]) for d in set(which.tolist())}
            items = [made[d] for d in which.tolist()]
            parts = ("items", np.frombuffer(b"".join(items), np.uint8), np.array([len(x) for x in items], np.int64))
            out.append(chunked({"tile": to, "doc": doc[i:j][which], "size": size[which]}, parts))
        give_back()
        return pa.concat_tables(out)

    return run


def bitmap_width(n: int) -> int:
    """Bits of a set's bitmap: a power of two of at least its size, within 64 and 4096."""
    return min(4096, max(64, 1 << (max(1, n) - 1).bit_length()))


def bitmap(values: np.ndarray) -> bytes:
    """Parity bitmap of a set: each shingle flips one bit."""
    width = bitmap_width(len(values))
    flips = np.bincount(((values >> U64(7)) % U64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def folded(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of different widths brought to the smallest by folding, as rows of 64-bit words."""
    words = min(map(len, maps))
    for i, m in enumerate(maps):
        while len(m) > words:
            m = m[: len(m) // 2] ^ m[len(m) // 2 :]
        maps[i] = m
    return np.stack(maps)


def bounded(size: np.ndarray, maps: np.ndarray, x: int, percent: int) -> np.ndarray:
    """Documents before ``x`` (in order of size) whose sizes and bitmaps allow a link with it.

    100 I >= percent * (a + b - I) bounds the overlap I from below; as each bit
    that differs stands for an element of one set alone, half of what is left
    bounds it from above.
    """
    low = int(np.searchsorted(size[:x], -(-percent * size[x] // 100)))
    if low == x:
        return np.zeros(0, np.int64)
    total = size[low:x] + size[x]
    apart = np.bitwise_count(maps[low:x] ^ maps[x]).sum(axis=1, dtype=np.int64)
    return low + np.flatnonzero((total - apart) // 2 >= -(-percent * total // (100 + percent)))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def by_tile(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(tile, rows, sizes) of each tile of a bucket with several documents; rows in order of size, then doc_id."""
    tile, doc = unpacked(table, "tile", U64), unpacked(table, "doc", np.int64)
    size = unpacked(table, "size", np.int64)
    order = np.lexsort((doc, size, tile))
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(tile[order])) + 1, [len(order)])) if len(order) else [0]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a > 1:
            yield int(tile[order[a]]), order[a:b], size[order[a:b]]


def near_members(percent: int):
    """Group function of a bucket of tiles with bitmaps: members that may have a link there."""

    def run(table: pa.Table) -> pa.Table:
        doc, size, items = unpacked(table, "doc", np.int64), unpacked(table, "size", np.int64), unpacked(table, "items", U64)
        words = np.array([bitmap_width(n) // 64 for n in size.tolist()], np.int64)
        at = np.concatenate(([0], np.cumsum(words)))
        tiles, members = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for tile, rows, sizes in by_tile(table):
            maps = folded([items[at[r] : at[r + 1]] for r in rows.tolist()])
            near = np.zeros(len(rows), bool)
            for x in range(1, len(rows)):
                found = bounded(sizes, maps, x, percent)
                if len(found):
                    near[x] = near[found] = True
            members.append(doc[rows[near]])
            tiles.append(np.full(near.sum(), tile, U64))
        return chunked({"member": np.concatenate(members), "tile": np.concatenate(tiles)})

    return run


def tile_links(percent: int):
    """Group function of a bucket of tiles with whole sets: a spanning forest of each tile's links."""

    def run(table: pa.Table) -> pa.Table:
        doc, size, items = unpacked(table, "doc", np.int64), unpacked(table, "size", np.int64), unpacked(table, "items", U64)
        at = np.concatenate(([0], np.cumsum(size)))
        links = set()
        for _, rows, sizes in by_tile(table):
            sets = [items[at[r] : at[r + 1]] for r in rows.tolist()]
            maps = folded([np.frombuffer(bitmap(s), U64) for s in sets])
            root = np.arange(len(rows))
            for x in range(1, len(rows)):
                near = bounded(sizes, maps, x, percent)
                while len(near):
                    y = int(near[-1])
                    both = overlap(sets[y], sets[x])
                    if 100 * both >= percent * (sizes[x] + sizes[y] - both):
                        links.add((int(doc[rows[y]]), int(doc[rows[x]])))
                        root[root == root[x]] = root[y]
                    else:
                        near = near[:-1]
                    near = near[root[near] != root[x]]
        pairs = np.array(sorted(links), np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n_buckets = buckets(spark)
    sizes = written(set_sizes(docs, k), "sets")
    equal = written(sizes.where("n_shingles > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("first")), "equal")

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = ta.ids(batch.column(0))
            group = (ta.mix(doc.view(U64)) % U64(n_buckets)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns], names=["bucket", *batch.schema.names])

    texts = docs.mapInArrow(grouped, "bucket int, doc_id long, text string").groupBy("bucket")
    firsts = equal.where("first IS NOT NULL").select(F.col("first").alias("doc_id")).mapInArrow(grouped, "bucket int, doc_id long")
    packed = lambda names: ", ".join(f"{c} binary" for c in names)
    sent = texts.cogroup(firsts.groupBy("bucket")).applyInArrow(prefixes(k, percent, common_shingles(docs, k)), packed(PREFIX))
    shared = routed(sent, n_buckets, "token", PREFIX, encode=prefix_cell(n_buckets)).groupBy("bucket")

    def at_tiles(members: DataFrame, form, width) -> DataFrame:
        wanted = routed(members, n_buckets, "member", MEMBER).groupBy("bucket")
        sets = texts.cogroup(wanted).applyInArrow(tile_rows(k, form), packed([*TILE, "items"]))
        return routed(sets, n_buckets, "tile", TILE, ("items", lambda c: width(c["size"])))

    members = shared.applyInArrow(tile_members(percent), packed(MEMBER))
    maps = at_tiles(members, bitmap, lambda size: np.array([bitmap_width(n) // 8 for n in size.tolist()], np.int64))
    near = maps.groupBy("bucket").applyInArrow(near_members(percent), packed(MEMBER))
    sets = at_tiles(near, np.ndarray.tobytes, lambda size: 8 * size)
    links = written(sets.groupBy("bucket").applyInArrow(tile_links(percent), "a long, b long"), "links")
    found = components(links, "components").withColumnRenamed("id", "first")
    labels = equal.join(found, "first", "left").select(
        "s1", "s2", F.coalesce("component", "first").alias("label")
    )
    # rows that share a doc_id but not their text join the components of both
    joined = sizes.join(labels.hint("shuffle_hash"), ["s1", "s2"], "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("label")).otherwise(F.col("doc_id")).alias("component_id"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under Jaccard >= 0.85 of 4-word shingles."""
    return jaccard_components(documents(spark, sf_dir), 4, 85)
