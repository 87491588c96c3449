import hashlib
import random

import numpy as np
import pytest

from tapehouse.llm import repeats

NONE = np.zeros(0, np.uint64)
DOCS = "doc_id long, text string, start long, kept string"


def brute(rows):
    """Row by row from the definition, on bytes."""
    big = float("inf")
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            w = b[i : i + 50]
            first[w] = min(first.get(w, big), big if d is None else d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        keep = np.ones(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < (big if d is None else d):
                keep[i : i + 50] = False
        edges = np.flatnonzero(np.diff(np.concatenate(([1], keep.astype(int)))) == -1)
        rest = bytes(np.frombuffer(b, np.uint8)[keep])
        out.append((d, len(b), int((~keep).sum()), len(edges), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], DOCS).repartition(3)
    return sorted((tuple(r) for r in repeats.without_repeats(df).drop("kept").collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    alphabet = "ab é\n" if seed % 2 else "abcdefghij éñ中\n"
    texts = []
    for _ in range(60):
        t = "".join(rng.choice(alphabet) for _ in range(rng.choice((0, 20, 49, 50, 51, 120, 400))))
        for _ in range(rng.randrange(4)):
            if texts:
                other = rng.choice(texts)
                a = rng.randrange(len(other) + 1)
                part = other[a : a + rng.choice((10, 48, 50, 55, 90, 300))]
                b = rng.randrange(len(t) + 1)
                t = t[:b] + part + t[b:]
        texts.append(t)
    ids = rng.sample(range(-100, 1000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    assert run(spark, rows) == brute(rows)


def test_nulls_runs_and_long_texts(spark, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    rows = [(5, None), (4, ""), (3, "a" * 500), (2, "a" * 60), (9, "x" + "a" * 49), (None, long[100:400]), (7, long), (8, long[:3000] + "|" + long[3000:]), (6, " " * 200)]
    want = brute(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(repeats, "SEGMENT", 700)  # seen by what runs in this process
    data, offs = np.frombuffer(long.encode(), np.uint8), np.array([0, len(long)])
    parts = [(lo + repeats.units(data[lo : lo + at[-1]], at, NONE)[3], repeats.units(data[lo : lo + at[-1]], at, NONE)[4]) for lo, at, _, _ in repeats.segments(offs)]
    assert len(parts) > 5
    starts = sorted(int(s) + i for start, number in parts for s, n in zip(start, number, strict=True) for i in range(n))
    assert starts == list(range(len(long) - 49))


def test_a_phrase_of_all_documents_with_different_surroundings(spark):
    """The phrase anchors nothing; its windows meet by what surrounds it, and copies of 50 bytes still go."""
    rng = random.Random(4)
    phrase = "all rights are reserved by them"
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    rows = [(i, letters(35) + phrase + letters(35)) for i in range(90)]
    rows += [(100 + i, letters(9) + t[10:70] + letters(9) + " " * 90) for i, (_, t) in enumerate(rows[:20])]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], DOCS).repartition(3)
    frequent = repeats.frequent_grams(df, 8)
    raw = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    offs = np.concatenate(([0], np.cumsum([len(t) for _, t in rows])))
    grams = np.frombuffer(phrase.encode(), np.uint8)
    hashes = repeats.ta.span_hash(grams, np.arange(12), np.arange(12) + 20)
    assert repeats.among(hashes, frequent).all()
    assert not repeats.among(hashes + np.uint64(1), frequent).any()
    most = lambda few: np.unique(repeats.units(raw, offs, few)[0], return_counts=True)[1]
    spaces = repeats.ta.span_hash(np.full(20, 32, np.uint8), np.zeros(1, int), np.full(1, 20))
    assert most(np.setdiff1d(frequent, hashes)).max() > 100  # each document has a unit of the phrase
    anchors = repeats.units(raw, offs, frequent)[0]
    rest = anchors[~np.isin(anchors, spaces)]
    assert np.unique(rest, return_counts=True)[1].max() <= 30
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_and_empty_table(spark):
    text = "".join(random.Random(1).choice("abc ") for _ in range(300))
    rows = [(1, text), (1, text), (2, text)]
    got = run(spark, rows)
    assert [r[2] for r in got] == [0, 0, 300]
    df = spark.createDataFrame([], DOCS)
    assert repeats.without_repeats(df).count() == 0


def test_nearest_smaller_values():
    rng = np.random.default_rng(0)
    for _ in range(50):
        v = rng.integers(0, 6, rng.integers(0, 40))
        before = [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(len(v))]
        after = [min((j for j in range(i + 1, len(v)) if v[j] < v[i]), default=len(v)) for i in range(len(v))]
        assert repeats.previous_smaller(v).tolist() == before
        assert repeats.next_smaller(v).tolist() == after
