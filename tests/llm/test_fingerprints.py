import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tapehouse.llm import fingerprints as fp

DOCS = "doc_id long, text string, next string, range long, own string"
UP = str.maketrans(fp.UPPER, fp.LOWER)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(UP))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def make(rows):
    return [(d, t, "n", 3, "o") for d, t in rows]


def corpus(seed, n=80):
    rng = random.Random(seed)
    vocab = [f"w{i}é" for i in range(50)]
    ids = rng.sample(range(-5000, 100_000), n)
    return [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice((0, 1, 3, 5, 60, 300))))) for i in ids]


def expected_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        out.append((d, t, t[: len(t) - k] + nxt[:k], nxt))
    return out


@pytest.mark.parametrize("seed,per_range", [(0, 1000), (1, 7), (2, 1)])
def test_edits_and_likeness(spark, monkeypatch, seed, per_range):
    monkeypatch.setattr(fp, "ROWS_PER_RANGE", per_range)
    rows = corpus(seed)
    rows += [(None, "no id here"), (rows[0][0], rows[0][1]), (200_000, None), (10**15, "far away " * 30)]
    df = spark.createDataFrame(make(rows), DOCS).repartition(3)
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in fp.fingerprints(df).collect()), key=str)
    want = sorted(((d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in expected_edits(rows)), key=str)
    assert got == want


def test_full_fraction_gives_exact_jaccard_and_containment(spark):
    rows = corpus(5)
    df = spark.createDataFrame(make(rows), DOCS)
    got = {r.doc_id: r for r in fp.fingerprints(df, fraction=0.9999999999).collect()}
    for d, t, e, nxt in expected_edits(rows):
        a = shingles(t)
        for other, near, part in ((e, got[d].near_edited, got[d].part_edited), (nxt, got[d].near_next, got[d].part_next)):
            b = shingles(other)
            assert abs(near - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-9
            assert abs(part - (len(a & b) / len(a) if a else 1.0)) < 1e-9


def test_scaled_estimates_are_near_and_equal_texts_agree(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(500)]
    base = [rng.choice(vocab) for _ in range(4000)]
    rows = [(2, " ".join(base)), (1, " ".join(base[:3000] + [rng.choice(vocab) for _ in range(1000)])), (7, " ".join(base)), (0, "a b")]
    got = {r.doc_id: r for r in fp.fingerprints(spark.createDataFrame(make(rows), DOCS)).collect()}
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert abs(got[2].near_next - len(a & b) / len(a | b)) < 0.08
    assert got[2].fingerprint == got[7].fingerprint and got[7].near_next == 1.0
    assert got[0].fingerprint != ""


def test_merge_equals_sketch_of_union(spark):
    rng = random.Random(8)
    a, b = (" ".join(f"x{rng.randrange(400)}" for _ in range(300)) for _ in range(2))
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b")
    ).select("a", "b", fp.merged(F.col("a"), F.col("b")).alias("m")).first()
    assert sorted(set(row.a) | set(row.b)) == row.m


def test_empty_and_single(spark):
    df = spark.createDataFrame([], DOCS)
    assert fp.fingerprints(df).count() == 0
    one = fp.fingerprints(spark.createDataFrame(make([(4, " \n")]), DOCS)).first()
    assert (one.near_edited, one.near_next, one.fingerprint) == (1.0, 1.0, "")


def test_main_path_has_no_python(spark):
    plan = fp.op5_scaled_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
