import random
import re

import corpus_pipeline as cp
from tests.llm.test_jaccard import brute
from tests.llm.test_secrets import PATTERNS

SF = "/root/testdata/sf0.001"


def test_stages_follow_the_contract_and_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in cp.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = cp.written(stage(spark, docs, SF), name)
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        ids[name] = set(after)
        if name == "language":
            assert all(any(c.isalpha() for c in r.text) for r in after.values())
        elif name == "near_duplicates":
            want = {d for d, _, first in brute([(d, r.text) for d, r in before.items()], 5, 80) if d == first}
            assert ids[name] == want
        elif name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            gone = set(before) - ids[name]
            assert gone and not any(item in r.text for r in after.values() for item in items)
        else:
            assert ids[name] == set(before)
            for d, r in after.items():
                assert r.n_chars == len(r.text) or r.text == before[d].text
                for pattern, group, least in PATTERNS.values():
                    assert not any(len(m[group]) >= least for m in pattern.finditer(r.text))
                assert re.sub(r"\[secret\]", "", r.text) == r.text or r.text != before[d].text
    pieces = cp.run(spark, SF).collect()
    assert {r.doc_id for r in pieces} == ids["secret_removal"]
    assert {tuple(sorted(r.asDict())) for r in pieces} == {("doc_id", "ids_crc32", "length", "offset", "piece", "sequence_id", "start")}


def test_extra_columns_nulls_and_empty_tables(spark):
    rows = [(1, "The and of that one", "en", "s", 19, "x"), (1, "The and of that one", "en", "s", 19, "y"), (None, None, None, None, None, None), (2, " 1 ", "en", "s", 3, "z"), (None, "token = abcdefghijklmnop1", "en", None, 5, "q")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string"
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = df
        for name, stage in cp.STAGES[:-1]:
            docs = cp.written(stage(spark, docs, SF), name)
            assert docs.columns == df.columns
        left = docs.collect()
        assert cp.STAGES[-1][1](spark, docs, SF).count() >= len(left)
        if df.count():
            assert sorted((r.doc_id, r.text) for r in left if r.doc_id) == [(1, rows[0][1])]
            assert [r.text for r in left if r.doc_id is None] == ["[secret]"]


def test_language_keeps_switched_texts_and_all_without_labels(spark):
    rng = random.Random(3)
    letters = {"aa": "abcde", "mm": "ijklm", "zz": "vwxyz"}
    text = lambda k, n: " ".join("".join(rng.choice(letters[k]) for _ in range(5)) for _ in range(n))
    rows = [(i, text(k, 40), k) for i, k in enumerate(sorted(letters) * 40)]
    rows += [(900, f"{text('aa', 40)} {text('zz', 40)}", None), (901, f"{text('aa', 30)} {text('mm', 30)} {text('zz', 30)}", None)]
    rows += [(902, " ".join(text(k, 6) for k in ("aa", "mm", "zz") * 8), None), (903, " 12 !? ", None), (904, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in cp.language(spark, docs, SF).collect()}
    assert kept == {r[0] for r in rows} - {903, 904}
    blind = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert cp.language(spark, blind, SF).count() == len(rows)
