"""Operator 5: threshold-scaled document fingerprints, in DataFrame functions only.

A fingerprint retains every hash of a five-word shingle below a fixed
``FRACTION`` of all hash values. Fingerprints of parts are merged by union, and as
their size follows the document's, containment can be estimated between very
unequal documents. A document of which no hash is that small retains its
smallest one, so that every document with words has a fingerprint.

Words are runs of characters other than white space (0x20, 0x09-0x0D) with A-Z
in lower case; a document of fewer than five words has its whole sequence as one
shingle. A fingerprint is written as its hashes in hex, in ascending signed
order, comma-joined. Likeness is the Jaccard estimate of two fingerprints.

Nulls and edges: a null text counts as empty; texts without words have an empty
fingerprint, two of which are alike (1.0) while an empty and another one are
not (0.0); in descending order a null doc_id comes last, rows that share a
doc_id are ordered by text; a table of one row has itself as next document; an
empty table gives an empty result; other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapehouse.llm.shuffling import documents

SHINGLE, FRACTION = 5, 0.125
ROWS_PER_RANGE, MOST_RANGES = 1000, 65_536
#: Letters that are lower-cased, and what separates words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "[\\x20\\x09-\\x0D]+"


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def sketch(text: Column, fraction: float = FRACTION, k: int = SHINGLE) -> Column:
    """Sorted array<bigint> of the retained shingle hashes of a text."""
    words = F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SPACES), lambda w: w != "")
    limit = -(2**63) + int(fraction * 2**64)

    def hashes(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        whole = F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(w) >= k, runs).otherwise(whole)

    def retained(h: Column) -> Column:
        small = F.filter(h, lambda x: x < F.lit(limit))
        return bound(small, lambda s: F.when((F.size(s) > 0) | (F.size(h) == 0), s).otherwise(F.array(F.array_min(h))))

    hashed = bound(F.transform(words, lambda x: F.xxhash64(x)), hashes)
    return F.array_sort(F.array_distinct(bound(hashed, retained)))


def written_form(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda x: F.lower(F.hex(x))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard estimate of two sketches (0 to 1)."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has (0 to 1)."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two parts together, from their sketches."""
    both = F.array_sort(F.array_union(a, b))
    small = F.filter(both, lambda x: x < F.lit(-(2**63) + int(fraction * 2**64)))
    return F.when((F.size(small) > 0) | (F.size(both) == 0), small).otherwise(F.slice(both, 1, 1))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``next``, a struct of the ``columns`` of the next document in descending doc_id.

    Documents are dealt by ranges of doc_id, about ``ROWS_PER_RANGE`` each and at
    most ``MOST_RANGES``; the first document of the range below is copied to the
    end of each range, so the order needs no task that sees all documents.
    """
    low, high, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    low, high = low or 0, high or 0
    ranges = min(MOST_RANGES, max(1, -(-n // ROWS_PER_RANGE)))
    width = (high - low) // ranges + 1
    place = F.expr(f"coalesce(cast((cast(doc_id as decimal(20,0)) - cast('{low}' as decimal(20,0))) div cast({width} as decimal(20,0)) as bigint), -1)")
    placed = docs.withColumn("range", place).withColumn("copied", F.lit(False))
    tops = placed.groupBy("range").agg(F.max("doc_id").alias("top"))  # at most MOST_RANGES + 1 rows
    order = W.orderBy(F.desc("range"))
    tops = tops.withColumn("above", F.coalesce(F.lag("range").over(order), F.min("range").over(W.partitionBy())))
    first = placed.join(F.broadcast(tops), (placed["range"] == tops["range"]) & placed["doc_id"].eqNullSafe(tops["top"])).select(
        tops["above"], *[placed[c] for c in docs.columns]
    )
    by_text = W.partitionBy("above").orderBy(F.desc("text"))
    first = first.withColumn("nth", F.row_number().over(by_text)).where("nth = 1").drop("nth")
    copies = first.withColumnRenamed("above", "range").withColumn("copied", F.lit(True))
    in_order = W.partitionBy("range").orderBy("copied", F.desc_nulls_last("doc_id"), F.desc("text"))
    both = placed.unionByName(copies)
    return both.withColumn("next", F.lead(F.struct(*columns)).over(in_order)).where("NOT copied").drop("range", "copied")


def fingerprints(docs: DataFrame, fraction: float = FRACTION, k: int = SHINGLE) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = with_next(docs.withColumn("own", sketch(F.col("text"), fraction, k)), ["text", "own"])
    n = F.col("n_chars")
    third = F.floor(n / 3).cast("int")
    edited = (
        ordered.withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", F.concat(F.substr("text", F.lit(1), (n - third).cast("int")), F.substr(F.col("next.text"), F.lit(1), third)))
        .select("doc_id", "n_chars", "own", F.col("next.own").alias("next_own"), "edited")
    )
    sketched = edited.withColumn("changed", sketch(F.col("edited"), fraction, k))
    return sketched.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        written_form(F.col("own")).alias("fingerprint"),
        written_form(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        containment(F.col("own"), F.col("changed")).alias("part_edited"),
        containment(F.col("own"), F.col("next_own")).alias("part_next"),
    )


def op5_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all whole documents and of their edited texts."""
    return fingerprints(documents(spark, sf_dir))
