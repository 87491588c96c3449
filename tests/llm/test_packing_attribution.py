import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tapehouse.llm import attribution, packing

DOCS = "doc_id long, text string, source string"
TEXTS = [
    "The cat's hat, and  the dog.\nNew line\n\n there \t x", "", None, "éa èb ñ c d　e 中文 字 a 🙂 b", " lead and trail ",
    "x" * 9000, "word " * 3000, "it's we'll 12 345 !! ??", "a", "tail \n", "\n\n", "the cat the cat the cat",
    "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y  <|endoftext|>\n z <|endoftext| > q", "a <|endoftext|> b a <|endoftext|> b",
]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def table(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(None, "no id", "s"), (3, TEXTS[3], "s")], DOCS)


def naive_best_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fit = [(r, i) for i, r in enumerate(room) if r >= n]
        if fit:
            room[min(fit)[1]] -= n
        else:
            room.append(capacity - n)
    return len(room)


@pytest.mark.parametrize("seed", range(20))
def test_plan_equals_piece_by_piece_best_fit(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(1, 60))
    lengths = rng.integers(1, capacity + 1, int(rng.integers(0, 300))).tolist()
    counts = {n: lengths.count(n) for n in set(lengths)}
    moves = packing.best_fit_plan(counts, capacity)
    bins = {}
    for length, _, n, each, first, offset in moves.tolist():
        for k in range(n):
            bins.setdefault(first + k // each, []).append((offset + k % each * length, length))
    assert sum(map(len, bins.values())) == len(lengths)
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(bins) == naive_best_fit(lengths, capacity)


def test_pieces_and_places(spark, tok):
    rows = packing.packed_sequences(table(spark)).collect()
    by_doc, places = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, t in list(enumerate(TEXTS)) + [(None, "no id")]:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        copies = 2 if i == 3 else 1
        got = sorted(by_doc[i], key=lambda r: r.piece)
        head = len(ids) - (-(-len(ids) // 2048) - 1) * 2048
        want = [(0, ids[:head])] + [(s, ids[s : s + 2048]) for s in range(head, len(ids), 2048)]
        want = [(k, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, (s, x) in enumerate(want)]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in got] == sorted(want * copies)
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(places) == naive_best_fit([r.length for r in rows], 2048)


def test_token_rows_hold_the_ids(spark, tok):
    rows = packing.token_rows(table(spark, ["a b c", "d e f"])).collect()
    flat = [i for r in rows for i in r.ids]
    want = [i for t in ["a b c", "d e f", "no id", TEXTS[3]] for i in [*tok.encode(t, add_special_tokens=False).ids, 0]]
    assert sorted(flat) == sorted(want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert packing.packed_sequences(empty).count() == 0
    assert attribution.attribute(empty).count() == 0


def lines_of(text):
    out, start = [], 0
    for i, c in enumerate(text):
        if c == "\n":
            out.append((start, i + 1))
            start = i + 1
    if start < len(text) or not text:
        out.append((start, len(text)))
    return out


def test_line_counts_match_offsets(spark, tok):
    got = {}
    for r in attribution.attribute(table(spark)).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start_char, r.end_char, r.n_tokens))
    for i, t in list(enumerate(TEXTS)) + [(None, "no id")]:
        t = t or ""
        spans = [o for o in tok.encode(t, add_special_tokens=False).offsets]
        want = [(s, a, b, float(sum(a <= x < b for x, _ in spans))) for s, (a, b) in enumerate(lines_of(t))]
        assert sorted(got[i]) == sorted(want * (2 if i == 3 else 1)), (i, t)


def test_rules_for_crossing_tokens(spark):
    docs = spark.createDataFrame([(1, "abcdef the", [(0, 2), (2, 4), (8, 10)]), (2, "ab", None)], "doc_id long, text string, cut array<struct<start:long,end:long>>")
    for rule in ("first", "most", "share"):
        rows = attribution.attribute(docs, "cut", rule).collect()
        n = len(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode("abcdef the").ids)
        assert abs(sum(r.n_tokens for r in rows if r.doc_id == 1) - n) < 1e-9
        assert [r.section for r in rows if r.doc_id == 2] == [-1]
    with pytest.raises(ValueError):
        attribution.attribute(docs, "cut", "other")
