import hashlib
import math

import numpy as np
import pytest

from tapehouse.llm import codebooks

SCHEMA = "vec_id long, vector array<float>, label int, error string, row int"


def naive(rows, parts=16, entries=64, rounds=2):
    """The contract by plain loops; rows (vec_id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and r[1]]
    kept = [(v, [math.floor(256 * np.float32(x).item()) for x in vec], label) for v, vec, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[vec[p * w : p * w + w] for p in range(parts)] for _, vec, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(near(p, c[p])[1], []).append(c[p])
            for e, xs in members.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    out = []
    for (v, _, label), c in zip(kept, cut, strict=True):
        found = [near(p, c[p]) for p in range(parts)]
        out.append((v, label, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    flat = [x for b in books for e in b for x in e]
    return out, hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def vectors(seed, n, dim=32):
    rng = np.random.default_rng(seed)
    rows = [(int(i) * 3 % 1000, np.round(rng.normal(0, 0.1, dim), 2).tolist(), int(rng.integers(0, 3))) for i in range(n)]
    rows += [(7, rows[1][1], None), (None, rows[0][1], None), (9, rows[2][1], 1), rows[3], rows[3]]
    rows += [(1, None, 1), (2, [0.5] * (dim - 1) + [None], 1), (3, [0.5] * (dim - 1) + [float("nan")], 1)]
    rows += [(4, [float("-inf")] + [0.1] * (dim - 1), 2), (5, [], 2)]
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(v, x, label, "clash", 1) for v, x, label in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("seed, n, parts, members", [(1, 300, 3, 1 << 18), (2, 300, 7, 40), (3, 20, 2, 5)])
def test_codes_equal_plain_lloyd(spark, seed, n, parts, members):
    rows = vectors(seed, n)
    codes, books, digest = codebooks.product_codes(frame(spark, rows, parts), members=members)
    expected, their_digest = naive(rows)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, codes.collect()), key=key) == sorted(expected, key=key)
    assert digest == their_digest and books.shape[0] == 16


def test_other_shapes_and_rounds(spark):
    rows = vectors(5, 200, dim=36)
    codes, _, digest = codebooks.product_codes(frame(spark, rows), parts=12, entries=5, rounds=4, members=50)
    expected, their_digest = naive(rows, 12, 5, 4)
    assert digest == their_digest
    assert sorted(r["code"] for r in codes.collect()) == sorted(r[2] for r in expected)


def test_one_vector_repeated_and_other_lengths(spark):
    rows = [(i, [0.25] * 16, 1) for i in range(500)] + [(1000, [0.5] * 32, 1), (-1, [0.5] * 17, 1)]
    codes, _, _ = codebooks.product_codes(frame(spark, rows), members=20)
    found = codes.collect()
    assert len(found) == 500 and {(r["code"], r["error"]) for r in found} == {("00" * 16, 0)}


def test_large_components_stay_exact(spark):
    rows = [(i, [float(1000 * i + j) for j in range(16)], None) for i in range(70)] + [(99, [1e30] * 16, 1)]
    codes, _, _ = codebooks.product_codes(frame(spark, rows), rounds=1)
    found = {r["vec_id"]: r["code"] for r in codes.collect()}
    assert len(found) == 71 and found[5] == "05" * 16 and found[99] == "3f" * 16


def test_empty_table(spark):
    codes, _, _ = codebooks.product_codes(frame(spark, [(1, None, 1)]))
    assert codes.collect() == []


def test_query_label_errors(spark):
    sf = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    expected, digest = naive(table)
    totals = {}
    for _, label, _, error in expected:
        totals[label] = totals.get(label, 0) + error
    got = sorted(map(tuple, codebooks.op11_vector_codes(spark, sf).collect()))
    assert got == sorted((v, code, error, totals[label], digest) for v, label, code, error in expected)
