import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapehouse.llm import jaccard
from tapehouse.llm.shuffling import components

DOCS = "doc_id long, text string, n long, label string"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def brute(rows, k=4, percent=85):
    sets = [(d, sets_of(t, k)) for d, t in rows]
    up = {d: d for d, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return sorted((d, len(s), find(d)) for d, s in sets)


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Ähre", "ÉTÉ", "été"]
    passage = [rng.choice(vocab) for _ in range(25)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.55:
            w = rng.choice(texts).split()
            for _ in range(rng.randrange(0, 4)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w).upper() if rng.random() < 0.1 else " ".join(w))
        else:
            w = [rng.choice(vocab) for _ in range(rng.choice((0, 1, 2, 3, 4, 5, 30, 80, 200)))]
            texts.append(" ".join(w + passage * (rng.random() < 0.4)))
    ids = rng.sample(range(-500, 10_000), n)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("seed,tile_rows", [(0, 4096), (1, 4096), (2, 8)])
def test_components_match_brute_force(spark, monkeypatch, seed, tile_rows):
    monkeypatch.setattr(jaccard, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(jaccard, "COMMON_IN_TASK", 3)
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], DOCS).repartition(3)
    got = sorted(tuple(r) for r in jaccard.jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(rows)


def test_five_words_at_eighty(spark):
    rows = corpus(7, 120)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], DOCS)
    got = sorted(tuple(r) for r in jaccard.jaccard_components(df, 5, 80).collect())
    assert got == brute(rows, 5, 80)


def test_nulls_repeats_and_empty(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t "), (4, "a b"), (5, "A B"), (6, long), (7, long + " y"), (None, "a b"), (6, long)]
    df = spark.createDataFrame([(d, t, None, None) for d, t in rows], DOCS)
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=str)
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 29_997, 6), (7, 29_998, 6), (6, 29_997, 6), (None, 1, 4)]
    assert got == sorted(want, key=str)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0


def test_bitmap_bound_never_below_overlap():
    rng = np.random.default_rng(3)
    for _ in range(50):
        pool = rng.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 250))) for _ in range(2))
        maps = jaccard.folded([np.frombuffer(jaccard.bitmap(x), np.uint64) for x in (a, b)])
        apart = int(np.bitwise_count(maps[0] ^ maps[1]).sum())
        assert (len(a) + len(b) - apart) // 2 >= jaccard.overlap(a, b) == len(set(a.tolist()) & set(b.tolist()))


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    got = components(spark.createDataFrame(edges, "a long, b long"), "t").groupBy("id").agg(F.min("component"), F.count("*")).collect()
    assert {r[0]: r[1] for r in got} == {x: find(x) for e in edges for x in e if e[0] != e[1]} 
    assert all(r[2] == 1 for r in got)
