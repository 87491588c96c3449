import numpy as np
import pyarrow.compute as pc

from tapehouse.llm.filtering import keep_rows


def test_rows_are_judged_and_sent_on_in_bounded_pieces(spark):
    """A batch of many megabytes reaches the test a piece at a time; a longer text is alone."""
    rows = [(i, None if i % 7 == 3 else f"{i} " * (i % 40) * 200, "x") for i in range(1500)] + [(None, "y " * 3_000_000, None), (5, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, more string").coalesce(1)

    def test(texts):
        size = pc.sum(pc.binary_length(texts)).as_py() or 0
        assert len(texts) == 1 or size <= 1 << 20, f"{size} bytes at once"
        return np.array([not t.startswith("1") if t is not None else True for t in texts.to_pylist()], bool)

    want = sorted((r for r in rows if not (r[1] or "").startswith("1")), key=str)
    assert sorted((tuple(r) for r in keep_rows(df, test, "text").collect()), key=str) == want
    assert keep_rows(df.limit(0), test, "text").collect() == []
