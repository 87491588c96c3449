import random

import numpy as np
import pytest

from tapehouse.llm import decontaminate as dc

DOCS = "doc_id long, text string, item_id long, score double"
ITEMS = "item_id long, text string, doc_id long"


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def hashes(words):
    return np.array([hash(w) & 0x7FFFFFFFFFFFFFFF for w in words], np.uint64)


def test_alignment_matches_plain_dynamic_programming():
    rng = random.Random(2)
    items, passages = [], []
    for _ in range(80):
        a = [rng.choice("abcdefg") for _ in range(rng.randrange(1, 20))]
        b = [rng.choice("abcdefg") for _ in range(rng.randrange(1, 30))]
        if rng.random() < 0.5:
            k = rng.randrange(len(b))
            b[k:k] = a
        items.append(a)
        passages.append(b)
    score, first, last, same = dc.align([hashes(a) for a in items], [hashes(b) for b in passages])
    for a, b, s, p, q, m in zip(items, passages, score.tolist(), first.tolist(), last.tolist(), same.tolist(), strict=True):
        assert s == smith_waterman(a, b)
        if s:
            assert smith_waterman(a, b[p : q + 1]) == s
            assert 2 * m >= s


def test_wide_passages(monkeypatch):
    rng = np.random.default_rng(5)
    passage = rng.integers(10, 2**60, 1_100_000).astype(np.uint64)
    passage[:3] = passage[700_000:700_003] = item = np.array([1, 2, 3], np.uint64)
    score, first, last, same = dc.align([item], [passage])
    assert (score[0], first[0], last[0], same[0]) == (6, 0, 2, 3)
    for seed in range(6):  # cut with an overlap: as the whole passage
        rng = np.random.default_rng(seed)
        item = rng.integers(0, 2**60, 40).astype(np.uint64)
        passage = rng.integers(0, 2**60, 13_000).astype(np.uint64)
        for at in (4096 * (1 + seed % 3) - rng.integers(0, 90), 9000):
            passage[at : at + 60] = np.insert(item, np.sort(rng.integers(0, 40, 20)), np.uint64(7))
        items = dc.Items(np.array([0]), ["x"], 4)
        items.words, items.at = item, np.array([0, 40])
        zero = np.zeros(1, np.int64)
        monkeypatch.setattr(dc, "passages_of", lambda *x, n=len(passage): (zero, zero, zero, zero + n))
        (got,) = dc.best_scores(items, passage, np.array([0, len(passage)]), 0.5)
        score, first, last, same = dc.align([item], [passage])
        assert got == (0, 0, score[0] / 80, first[0], last[0], same[0])
        assert len(dc.windows(zero, zero + len(passage), zero + 40, 0.5)[0]) == 4


def make(seed):
    rng = random.Random(seed)
    vocab = [f"{c}{i}" for c in "abcdefgh" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(15, 60)))) for i in range(12)]
    docs, truth = [], {}
    for d in range(120):
        words = [rng.choice(vocab) for _ in range(rng.choice((10, 100, 400)))]
        if d % 3 == 0:
            i = rng.randrange(len(items))
            copy = items[i][1].split()
            for _ in range(len(copy) // 10):  # replaced, dropped and added words
                k = rng.randrange(len(copy))
                copy[k : k + 1] = rng.choice(([rng.choice(vocab)], [], [copy[k], rng.choice(vocab)]))
            at = rng.randrange(len(words))
            words[at:at] = [w.upper() + rng.choice(("", ",", ".")) for w in copy]
            truth[d] = i
        docs.append((d, " ".join(words)))
    return items, docs, truth


@pytest.mark.parametrize("seed,block", [(0, 20_000), (1, 5)])
def test_planted_copies_are_found_and_clean_documents_left(spark, monkeypatch, seed, block):
    monkeypatch.setattr(dc, "BLOCK_ITEMS", block)
    items, docs, truth = make(seed)
    d = spark.createDataFrame([(i, t, 7, 0.0) for i, t in docs], DOCS).repartition(3)
    b = spark.createDataFrame([(i, t, 9) for i, t in items], ITEMS)
    rows = dc.contaminated(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == set(truth.items())
    texts, wanted = dict(docs), dict(items)
    plain = lambda t: [w.strip(",.") for w in t.lower().split()]
    for r in rows:
        a, b = plain(wanted[r.item_id]), plain(texts[r.doc_id])
        assert abs(r.score - smith_waterman(a, b) / (2 * len(a))) < 1e-9
        assert smith_waterman(a, b[r.first_word : r.last_word + 1]) == round(r.score * 2 * len(a))


def test_item_in_most_documents_is_still_found(spark, monkeypatch):
    monkeypatch.setattr(dc, "RARE_LEAST", 1)
    item = "one two three four five six seven eight nine ten"
    d = spark.createDataFrame([(i, f"filler {i} " + item, 0, 0.0) for i in range(40)], DOCS)
    b = spark.createDataFrame([(1, item, 0), (2, "entirely other words that no document has at all", 0)], ITEMS)
    assert dc.contaminated(d, b).count() == 40


def test_nulls_short_items_ties_and_empty_tables(spark):
    d = spark.createDataFrame(
        [(1, None, 0, 0.0), (2, "", 0, 0.0), (3, "hello world", 0, 0.0), (None, "say hello world!", 0, 0.0), (3, "hello world", 0, 0.0), (4, "x " * 50_000 + "alpha beta gamma delta", 0, 0.0)],
        DOCS,
    )
    b = spark.createDataFrame([(1, "Hello, world."), (2, None), (3, "--- !!"), (None, "alpha beta gamma delta"), (5, "hello world"), (6, "")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.score) for r in dc.contaminated(d, b).collect()), key=str)
    want = [(3, 1, 1.0)] * 2 + [(3, 5, 1.0)] * 2 + [(None, 1, 1.0), (None, 5, 1.0), (4, None, 1.0)]
    assert got == sorted(want, key=str)
    assert dc.contaminated(d.limit(0), b).count() == 0
    assert dc.contaminated(d, b.limit(0)).count() == 0


def test_item_of_which_half_is_a_shared_passage(spark, monkeypatch):
    monkeypatch.setattr(dc, "RARE_LEAST", 5)
    item = [f"i{k}" for k in range(40)]
    broken = [f"r{k}" if k in (21, 25, 29, 33, 37) else w for k, w in enumerate(item)]
    docs = {d: [f"f{d}", *item[:21], f"g{d}"] for d in range(30)}  # 18 of 37 seeds are frequent
    docs |= {30: ["start", *broken, "end"], 31: ["start", *item, "end"], 32: ["start", *item[5:9], "end"], 33: [*item[3:8], "x", *item[22:26]]}
    docs |= {40 + d: [*item[:10], *(f"h{d}x{k}" for k in range(30))] for d in range(20)}
    d = spark.createDataFrame([(i, " ".join(t), 0, 0.0) for i, t in docs.items()], DOCS)
    b = spark.createDataFrame([(1, " ".join(item), 0)], ITEMS)
    want = {i: s / 80 for i, t in docs.items() if (s := smith_waterman(item, t)) >= 40}
    assert set(want) == set(range(32))
    assert {r.doc_id: r.score for r in dc.contaminated(d, b).collect()} == want
