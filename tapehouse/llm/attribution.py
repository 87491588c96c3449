"""Operator 10: token counts of fields or sections by character offsets.

Each whole document is encoded once. The tokens' character spans follow from
the byte lengths of their ids (byte-level BPE loses nothing) and are joined
with the section spans by binary search over both sorted lists. A token that
crosses a boundary goes by an explicit ``rule``:

- ``first``: to the section of its first byte;
- ``most``: to the section that holds most of its bytes, the earlier at a tie;
- ``share``: to each section in proportion to its bytes.

Nulls and edges: a null or empty text gives one section 0 from 0 to 0 without
tokens; a null doc_id is kept; repeated rows are counted each by itself; an
empty table gives an empty result; other columns are not used. Sections given
by a column may leave gaps: tokens of a gap go to section -1. Null or empty
span lists leave the whole text to section -1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.llm import textarrays as ta
from tapehouse.llm.bpe import ENCODED_AT_ONCE, Bpe
from tapehouse.llm.shuffling import documents

SECTION = "doc_id long, section int, start_char long, end_char long, n_tokens double, n_crossing long"


def line_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start byte of every line (its line feed belongs to it) and each document's
    range in them; an empty document has one line."""
    after = np.flatnonzero(data == 10) + 1
    starts = np.unique(np.concatenate((offs[:-1], after[~np.isin(after, offs)])))
    lines = np.searchsorted(starts, offs)
    empty = offs[:-1] == offs[1:]
    if empty.any():  # an empty document has no line start of its own
        size = np.where(empty, 1, np.diff(lines))
        out = np.repeat(offs[:-1], size)
        cuts = np.concatenate(([0], np.cumsum(size)))
        full = np.repeat(~empty, size)
        out[full] = starts[starts < offs[-1]]
        return out, cuts
    return starts, np.append(lines[:-1], len(starts)) if len(offs) > 1 else lines


def spread_tokens(
    token_start: np.ndarray, token_end: np.ndarray, start: np.ndarray, end: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and crossing tokens of each span; spans are sorted and do not overlap."""
    n = len(start)
    first = np.searchsorted(end, token_start, "right")  # the span of each token's first byte, if it has one
    last = np.searchsorted(end, token_end - 1, "right")
    inside = (first < n) & (start[np.minimum(first, n - 1)] <= token_start) if n else np.zeros(len(first), bool)
    lone = (first == last) & inside & (token_end <= end[np.minimum(first, n - 1)]) if n else inside
    count = np.bincount(first[lone], minlength=n).astype(float)
    crossing = np.zeros(n, np.int64)
    for t in np.flatnonzero(~lone).tolist():
        a, b = token_start[t], token_end[t]
        near = range(int(first[t]), min(n, int(last[t]) + 1))
        part = [(min(b, end[s]) - max(a, start[s]), s) for s in near]
        part = [(size, s) for size, s in part if size > 0]
        if not part:
            continue
        if len(part) > 1 or part[0][0] < b - a:
            for _, s in part:
                crossing[s] += 1
        if rule == "first":
            if start[part[0][1]] <= a:
                count[part[0][1]] += 1
        elif rule == "most":
            best = max(part, key=lambda x: (x[0], -x[1]))
            if best[0] * 2 >= b - a or sum(size for size, _ in part) == b - a:
                count[best[1]] += 1
        else:
            for size, s in part:
                count[s] += size / (b - a)
    return count, crossing


def attribute(docs: DataFrame, spans: str | None = None, rule: str = "first", vocabulary: str | None = None) -> DataFrame:
    """Token counts of every section of every document.

    ``spans`` names an array<struct<start long, end long>> column of sorted
    spans in code points; without it sections are the lines of the text.
    """
    if rule not in ("first", "most", "share"):
        raise ValueError(f"unknown rule {rule!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for batch in batches:
            doc = ta.ids(batch.column(0))
            data, offs = ta.flat(batch.column(1))
            d = data
            for i, j in ta.slices(offs, ENCODED_AT_ONCE):
                d, at = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                tokens, cuts = bpe.encode(d, at)
                token_end = np.cumsum(bpe.n_bytes[tokens], dtype=np.int64)
                token_start = token_end - bpe.n_bytes[tokens]
                chars = np.concatenate(([0], np.cumsum((d & 0xC0) != 0x80)))  # code points before each byte
                if spans is None:
                    start, lines = line_spans(d, at)
                    n = np.diff(lines)
                    owner = np.repeat(np.arange(j - i), n)
                    end = np.append(start[1:], at[-1])
                    end[lines[1:] - 1] = at[1:]
                    section = np.arange(len(start)) - np.repeat(lines[:-1], n)
                    keep = start < end  # an empty line of an empty document has no bytes
                    count, crossing = np.zeros(len(start)), np.zeros(len(start), np.int64)
                    count[keep], crossing[keep] = spread_tokens(token_start, token_end, start[keep], end[keep], rule)
                else:
                    given = batch.column(2).slice(i, j - i).to_pylist()
                    lead = np.append(np.flatnonzero((d & 0xC0) != 0x80), len(d))
                    rows = []
                    for x, spans_of in enumerate(given):
                        c0, c1 = chars[at[x]], chars[at[x + 1]]
                        for s, sp in enumerate(spans_of or []):
                            a, b = (min(c1, c0 + max(0, sp[k] or 0)) for k in ("start", "end"))
                            rows.append((x, s, lead[a], lead[max(a, b)]))
                    owner, section, start, end = np.array(rows, np.int64).reshape(-1, 4).T
                    keep = start < end
                    count, crossing = np.zeros(len(start)), np.zeros(len(start), np.int64)
                    count[keep], crossing[keep] = spread_tokens(token_start, token_end, start[keep], end[keep], rule)
                    rest = np.diff(cuts) - np.bincount(owner, weights=count, minlength=j - i)
                    gap = np.flatnonzero(rest > 1e-9)
                    owner = np.concatenate((owner, gap))
                    section = np.concatenate((section, np.full(len(gap), -1)))
                    start, end = np.concatenate((start, at[:-1][gap])), np.concatenate((end, at[1:][gap]))
                    count, crossing = np.concatenate((count, rest[gap])), np.concatenate((crossing, np.zeros(len(gap), np.int64)))
                zero = chars[at[:-1]][owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        ta.id_array(doc[i:j][owner]),
                        pa.array(section.astype(np.int32)),
                        pa.array(chars[start] - zero),
                        pa.array(chars[end] - zero),
                        pa.array(count),
                        pa.array(crossing),
                    ],
                    names=["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing"],
                )
            del batch, data, d  # the batch's memory goes back before the next one arrives
            pa.default_memory_pool().release_unused()

    given = [F.col(spans).cast("array<struct<start:bigint,end:bigint>>").alias("spans")] if spans else []
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *given).mapInArrow(run, SECTION)


def op10_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every whole document; a token belongs to the line of its first byte."""
    counted = attribute(documents(spark, sf_dir))
    return counted.withColumn("n_tokens", F.col("n_tokens").cast("long"))
