"""A training-data pipeline over the documents table.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and
returns a DataFrame: the documents that it kept, with the columns of documents,
and at the end the packed pieces. ``run`` writes each stage's result as Parquet
and reads it again for the next one, so a stage works on exactly what the one
before kept, and a lost executor costs no earlier stage.

Nulls and edges are those of the operators; a null doc_id is carried along, and
extra columns stay with their documents up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapehouse.llm import decontaminate, jaccard, langid, packing, secrets
from tapehouse.llm.filtering import keep_rows
from tapehouse.llm.shuffling import documents, written

#: A document whose words, each by itself, speak for a language less than this on average is no text.
LEAST_LANG_SCORE = 0.5
#: Near duplicates: shingles of five words, similarity of 0.8 or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with languages; those without letters or of words of no clear language go.

    Each word counts with its own best language, so a text of several languages
    stays. With no row that has a lang, nothing is known and all documents stay.
    """
    model = langid.fit(docs)
    return keep_rows(docs, langid.has_language(model, LEAST_LANG_SCORE), "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near duplicates.

    Rows that share a doc_id count as one document, of which the row with the
    smallest text stays; rows with a null doc_id and text without words stay.
    """
    labels = jaccard.jaccard_components(docs, NEAR_WORDS, NEAR_PERCENT).where("doc_id IS NOT NULL")
    by_id = labels.groupBy("doc_id").agg(F.min("component_id").alias("first"), F.count("*").alias("rows"))
    # written first, so that Spark knows its size: a small list of ids is broadcast, a large one joined
    marks = written(by_id.where("first < doc_id OR rows > 1").selectExpr("doc_id", "first < doc_id AS later"), "duplicates")
    single = docs.join(marks.select("doc_id"), "doc_id", "left_anti")
    several = docs.join(marks.where("NOT later").select("doc_id"), "doc_id", "left_semi")
    nth = F.row_number().over(W.partitionBy("doc_id").orderBy("text")).alias("nth")
    first = several.select(F.struct(*docs.columns).alias("row"), nth).where("nth = 1").select("row.*")
    return single.unionByName(first).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a benchmark item or an edited copy of one."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for clean in decontaminate.clean_rows(docs, benchmark):
        docs = keep_rows(docs, clean, "text")
    return docs


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents and blanks out the secrets in their texts; n_chars follows the text."""
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    table = secrets.train(plain)
    source = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    found = secrets.find(source, table)
    text = F.when(F.size("found") == 0, F.col("row.text")).otherwise(secrets.redacted(F.col("text"), F.col("found")))
    changed = found.select("row", "found", text.alias("new_text"))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("new_text").alias(c))
        elif c == "n_chars":
            n = F.length("new_text").cast(docs.schema[c].dataType)
            out.append(F.when(F.size("found") > 0, n).otherwise(F.col("row.n_chars")).alias(c))
        else:
            out.append(F.col("row").getField(c).alias(c))
    return changed.select(*out)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences of at most 2048 tokens."""
    return packing.packed_sequences(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_removal", secret_removal),
    ("pack", pack),
]

#: SQL cannot express the language model or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
