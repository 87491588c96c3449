import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tapehouse.llm import differencing as kk

DOCS = "doc_id long, text string, length string"
TEXTS = [
    "The cat's hat, and  the dog.\nNew line\n\n there \t x", "", None, "éa èb ñ c d　e 中文 字 a 🙂 b", " lead and trail ",
    "x" * 9000, "word " * 7000, "it's WE'LL 12 345 !! ??", "a", "tail \n", "\n\n", "ΟΔΟΣ é ́x <|endoftext|>a <|endoftext|> \x85\xa0b c",
]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(tok, text):
    return [*tok.encode(text or "", add_special_tokens=False).ids, 1]


def check(tok, docs, rows, capacity, padding):
    """Each id in one piece, sequences gapless, sizes and sums as the texts give them."""
    known = sorted((d is None, d or 0, ids_of(tok, t)) for d, t in docs)
    left = {}
    for _, d, ids in known:
        left.setdefault(d, []).append(ids)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"] or 0, []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(left)
    for d, found in by_doc.items():
        if len(left[d]) > 1:  # repeated ids: sizes alone
            assert sum(r["length"] for r in found) == sum(map(len, left[d]))
            continue
        ids, end = left[d][0], 0
        for r in sorted(found, key=lambda r: r["start"]):
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (end, len(ids), zlib.crc32(part.tobytes()))
            end += r["length"]
        assert end == len(ids)
    pads = 0
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
        pads += 0 if end & (end - 1) == 0 else capacity - end
    assert pads <= padding


def test_two_way_differencing_is_the_textbook_one():
    windows = kk.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in windows) == [14, 16]
    assert sorted(i for w in windows for i in w) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("seed", range(15))
def test_differencing_against_all_partitions(seed):
    rng = np.random.default_rng(seed)
    sizes, k = rng.integers(1, 40, 7).tolist(), int(rng.integers(2, 4))
    best = min(
        max(sum(s for s, at in zip(sizes, places, strict=True) if at == w) for w in range(k))
        for places in itertools.product(range(k), repeat=7)
    )
    windows = kk.differencing(sizes, k)
    assert sorted(i for w in windows for i in w) == list(range(7))
    most = max(sum(sizes[i] for i in w) for w in windows)
    assert best <= most <= best * (4 / 3 - 1 / (3 * (k - 1))) + max(sizes) / 3


def test_windows_rise_until_the_capacity_holds():
    assert len(kk.near_equal_windows([6, 6, 6], 10)) == 3  # 18 ids fit two windows by sum alone
    assert kk.near_equal_windows([], 10) == []
    sizes = np.random.default_rng(1).integers(1, 2000, 3000)
    windows = kk.near_equal_windows(sizes, 2048)
    sums = [sizes[w].sum() for w in windows]
    assert max(sums) <= 2048 and max(sums) - min(sums) <= 64
    assert len(windows) <= -(-sizes.sum() // 2048) * 1.01 + 1
    assert sorted(i for w in windows for i in w) == list(range(3000))


def test_levelled_and_powers_of_two():
    spans = [("a", 0, 7), ("b", 0, 8), ("c", 2, 6)]
    full, rest = kk.levelled(spans, [[0], [1], [2]], 10)
    assert full == [[("b", 0, 8), ("c", 2, 2)], [("a", 0, 7), ("c", 4, 3)]] and rest == [("c", 7, 1)]
    assert kk.powers_of_two([("a", 0, 5), ("b", 3, 2)]) == [[("a", 0, 4)], [("a", 4, 1), ("b", 3, 1)], [("b", 4, 1)]]


def test_ids_equal_those_of_whole_texts(tok):
    import pyarrow as pa

    ids, cuts = kk.WordIds().encode(pa.array(TEXTS))
    for text, a, b in zip(TEXTS, cuts[:-1], cuts[1:], strict=True):
        assert ids[a:b].tolist() == ids_of(tok, text)[:-1]


@pytest.mark.parametrize("parts", [1, 5])
def test_pieces(spark, tok, parts):
    docs = list(enumerate(TEXTS)) + [(None, "no id"), (3, TEXTS[3])]
    df = spark.createDataFrame([(d, t, "clash") for d, t in docs], DOCS).repartition(parts)
    check(tok, docs, kk.packed_windows(df).collect(), 2048, 0)
    check(tok, docs, kk.packed_windows(df, capacity=64, pool_windows=4).collect(), 64, 0)


def test_empty_table(spark):
    assert kk.packed_windows(spark.createDataFrame([], DOCS)).collect() == []


def test_query_on_given_documents(spark, tok):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = kk.op13_differencing_packing(spark, sf).collect()
    check(tok, docs, rows, 2048, 0)
    assert len(rows) <= 3 * len(docs)
