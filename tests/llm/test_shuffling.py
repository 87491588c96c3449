import numpy as np
import pyarrow as pa
import pytest

from tapehouse.llm import jaccard, shuffling
from tapehouse.llm import textarrays as ta

KINDS = {"key": np.int64, "size": np.int64}


def groups_of(number, each):
    """A group function's rows: ``each`` values a group, with as many bytes as their size says."""
    rng = np.random.default_rng(0)
    for _ in range(number):
        key = rng.integers(-(2**62), 2**62, each)
        size = rng.integers(0, 9, each)
        raw = np.repeat((key & 0xFF).astype(np.uint8), size)
        yield from shuffling.chunked({"key": key, "size": size}, ("bytes", raw, size)).to_pylist()


@pytest.mark.parametrize("n_buckets", [24, 422])
def test_rows_follow_the_tasks_and_not_the_groups(spark, n_buckets):
    rows = list(groups_of(n_buckets, 300))
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "key binary, size binary, bytes binary").repartition(3)
    got = shuffling.routed(df, n_buckets, "key", KINDS, ("bytes", lambda c: c["size"])).collect()
    assert len(got) <= 3 * n_buckets
    values = lambda name, of: np.concatenate([np.frombuffer(r[name], np.int64) for r in of])
    assert sorted(values("key", got)) == sorted(values("key", rows))
    for r in got:
        key, size = np.frombuffer(r["key"], np.int64), np.frombuffer(r["size"], np.int64)
        assert (ta.mix(key.view(np.uint64)) % np.uint64(n_buckets) == r["bucket"]).all()
        assert bytes(r["bytes"]) == np.repeat((key & 0xFF).astype(np.uint8), size).tobytes()


def test_no_rows_and_rows_of_bounded_size(spark, monkeypatch):
    empty = spark.createDataFrame([], "key binary, size binary")
    assert shuffling.routed(empty, 5, "key", KINDS).count() == 0
    none = np.zeros(0, np.int64)
    assert shuffling.chunked({"key": none}, ("bytes", none.view(np.uint8), none)).num_rows == 0
    monkeypatch.setattr(shuffling, "CHUNK", 10)
    monkeypatch.setattr(shuffling, "CHUNK_BYTES", 100)
    size = np.array([1000, 30, 30, 30, 30] + [0] * 25)
    out = shuffling.chunked({"key": np.arange(30)}, ("bytes", np.zeros(size.sum(), np.uint8), size))
    assert [len(x) for x in out.column("bytes").to_pylist()] == [1000, 90, 30, 0, 0]
    assert [len(x) // 8 for x in out.column("key").to_pylist()] == [1, 3, 10, 10, 6]


def test_what_a_task_gathers_is_bounded(spark, monkeypatch):
    made = []
    monkeypatch.setattr(shuffling, "ROUTED_BYTES", 1 << 14)

    class Table:  # runs the function on batches, as a task does
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            for batch in pa.Table.from_pylist(list(groups_of(40, 300))).to_batches(max_chunksize=1):
                made.append(batch)
            return list(run(iter(made)))

    out = shuffling.routed(Table(), 4, "key", KINDS, ("bytes", lambda c: c["size"]))
    assert 4 < len(out) < 40
    assert sum(b.num_rows for b in out) <= 4 * len(out)


def test_prefix_cells_give_back_documents_bands_and_token_bytes():
    rng = np.random.default_rng(1)
    token = rng.integers(0, 2**63, 500, dtype=np.uint64)
    doc = rng.integers(-(2**63), 2**63 - 1, 500)
    level = rng.integers(0, 300, 500).astype(np.int16)
    cell = jaccard.prefix_cell(24)({"token": token, "doc": doc, "level": level})
    order = np.argsort(doc, kind="stable")
    assert (np.cumsum(jaccard.from_planes(cell["doc"], np.int64, 8)) == doc[order]).all()
    assert (jaccard.from_planes(cell["level"], np.int16, 2) == level[order]).all()
    low = (ta.mix(token) // np.uint64(24)) & np.uint64((1 << 40) - 1)
    assert (jaccard.from_planes(cell["token"], np.uint64, jaccard.TOKEN_BYTES) == low[order]).all()
