"""Operator 7: secrets in whole texts, in DataFrame functions only.

Three base patterns give spans (assignments of long values to secret-like names,
access key ids, long hexadecimal runs). Beside them, long strings of the key
alphabet are scored by two character Markov models, one of random strings and
one of ordinary identifiers: a string whose mean log-likelihood ratio per
transition reaches ``MIN_RATIO`` is a span too. A string that touches base spans is
cut at them, and what is left of it, where long enough, is scored by itself.

The models are transition tables of the key alphabet's characters, trained from
labelled samples of the table itself: what the base patterns caught is random,
other identifiers that several texts share are ordinary. Samples are bounded, ``SAMPLE`` strings of
each label at most, chosen by hash. Without samples the tables are uniform.

Spans are in code points, end exclusive, of the whole match. Nulls and edges: a
null text counts as empty and has no spans; a null doc_id is kept; repeated rows
are searched each by itself; an empty table gives an empty result; columns other
than doc_id and text are not used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.llm.fingerprints import bound
from tapehouse.llm.shuffling import documents

#: The base patterns (group 1 of an assignment is its value), the kinds
#: in the order in which spans of one start are listed, and the key alphabet.
ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KEY_LEAST = 20
KEY = f"[A-Za-z0-9+/_-]{{{KEY_LEAST},}}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
ASSIGN_LEAST, IDENTIFIER_LEAST = 12, 6
SAMPLE, SAMPLE_DOCS, MIN_RATIO = 20_000, 4000, 0.5
SPAN = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def running(sizes: Column, chunk: int = 256) -> Column:
    """Sums of all earlier entries of an array<bigint>, by chunks so that long arrays stay cheap."""
    total = lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda a, b: a + b)

    def by_chunks(chunks: Column) -> Column:
        def place(totals: Column) -> Column:
            return F.flatten(
                F.transform(
                    chunks,
                    lambda ch, c: bound(total(F.slice(totals, 1, c)), lambda before: F.transform(ch, lambda _, j: before + total(F.slice(ch, 1, j)))),
                )
            )

        return bound(F.transform(chunks, total), place)

    number = F.floor((F.size(sizes) - 1) / chunk).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), number), lambda c: F.slice(sizes, c * chunk + 1, chunk))
    return F.when(F.size(sizes) == 0, F.array().cast("array<bigint>")).otherwise(bound(chunks, by_chunks))


def spans_of(text: Column, pattern: str, kind: int, value: str | None = None) -> Column:
    """All matches of ``pattern``, leftmost first and not overlapping, as spans; their
    value is the match or, with ``value``, that pattern's group 1 in it."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def with_gaps(g: Column):
        def with_matches(m: Column) -> Column:
            sizes = F.transform(m, lambda x, i: (F.length(F.get(g, i)) + F.length(x)).cast("bigint"))

            def placed(before: Column) -> Column:
                def span(x: Column, i: Column) -> Column:
                    start = F.get(before, i) + F.length(F.get(g, i))
                    return F.struct(
                        start.alias("start"),
                        F.lit(kind).alias("kind"),
                        (start + F.length(x)).alias("end"),
                        (F.regexp_extract(x, value, 1) if value else x).alias("value"),
                    )

                return F.transform(m, span)

            return bound(running(sizes), placed)

        return bound(matches, with_matches)

    found = F.when(text.rlike(pattern), bound(gaps, with_gaps))
    return F.coalesce(found, F.array().cast(SPAN)).cast(SPAN)


def base_spans(docs: DataFrame) -> DataFrame:
    """Add ``base``: the spans of the three base patterns, by start, then kind."""
    text = F.col("text")
    assign = F.filter(spans_of(text, ASSIGN, 0, ASSIGN), lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    return docs.withColumn("base", F.array_sort(F.concat(assign, spans_of(text, ACCESS, 1), spans_of(text, HEX, 2))))


def transitions(strings: DataFrame) -> dict[str, int]:
    """Counts of all pairs of neighbouring characters of column ``s`` (their number is bounded by the alphabet)."""
    letters = F.filter(F.split("s", ""), lambda c: c != "")
    pairs = strings.select(letters.alias("c")).select(
        F.explode(F.transform(F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0))), lambda x, i: F.concat(F.get("c", i), x))).alias("pair")
    )
    return {r["pair"]: r["count"] for r in pairs.groupBy("pair").count().collect() if all(c in ALPHABET for c in r["pair"])}


def ratio_table(random: dict[str, int], ordinary: dict[str, int], weight: float = 5.0) -> list[float]:
    """Log-likelihood ratio of every transition. Each model's transitions are smoothed by its
    character frequencies (with ``weight`` counts), and these by half a count."""

    def logs(counts: dict[str, int]) -> list[float]:
        single = {b: 0.5 for b in ALPHABET}
        row = dict.fromkeys(ALPHABET, 0)
        for pair, n in counts.items():
            single[pair[1]] += n
            row[pair[0]] += n
        total = sum(single.values())
        return [
            math.log((counts.get(a + b, 0) + weight * single[b] / total) / (row[a] + weight)) for a in ALPHABET for b in ALPHABET
        ]

    return [r - o for r, o in zip(logs(random), logs(ordinary), strict=True)]


def train(docs: DataFrame, sample: int = SAMPLE, sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """The ratio table from labelled strings of ``docs`` (columns doc_id, text).

    Random: distinct values that the base patterns catch in any document, ``sample`` of
    them by hash. Ordinary: identifiers outside base matches that several of about
    ``sample_docs`` documents, chosen by hash, have in common (a random string stands in one),
    ``sample`` of them by hash.
    """
    n = max(1, docs.count())
    caught = docs.where(F.col("text").rlike(f"{ASSIGN}|{ACCESS}|{HEX}"))
    values = base_spans(caught).select(F.explode("base.value").alias("s"))
    by_hash = lambda x: x.distinct().orderBy(F.xxhash64("s"), "s").limit(sample)
    some = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) <= int(min(1.0, sample_docs / n) * 1_000_003))
    rest = F.regexp_replace("text", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    names = F.array_distinct(F.regexp_extract_all(rest, F.lit(f"[A-Za-z0-9+/_-]{{{IDENTIFIER_LEAST},}}"), F.lit(0)))
    names = some.select(F.explode(names).alias("s")).groupBy("s").count().where("count > 1").select("s")
    return ratio_table(transitions(by_hash(values)), transitions(by_hash(names)))


def mean_ratio(string: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio of a string's transitions."""
    size = len(ALPHABET)
    literal = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    codes = F.transform(F.filter(F.split(string, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def score(code: Column) -> Column:
        moves = F.slice(code, 2, F.greatest(F.size(code) - 1, F.lit(0)))
        each = F.transform(moves, lambda b, i: F.get(literal, F.get(code, i) * size + b))
        return F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / F.greatest(F.size(moves), F.lit(1))

    return bound(codes, score)


def beside(run: Column, base: Column) -> Column:
    """What base spans leave of a run of the key alphabet: parts of ``KEY_LEAST`` characters or more."""
    met = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))

    def parts(met: Column) -> Column:
        begins = F.array_distinct(F.concat(F.array(run["start"]), F.transform(met, lambda b: b["end"])))
        free = F.filter(begins, lambda p: (p < run["end"]) & ~F.exists(met, lambda b: (b["start"] <= p) & (p < b["end"])))

        def part(p: Column) -> Column:
            end = F.coalesce(F.array_min(F.filter(F.transform(met, lambda b: b["start"]), lambda x: x > p)), run["end"])
            value = F.substr(run["value"], (p - run["start"] + 1).cast("int"), (end - p).cast("int"))
            return F.struct(p.alias("start"), run["kind"].alias("kind"), end.alias("end"), value.alias("value"))

        return F.filter(F.transform(free, part), lambda s: F.length(s["value"]) >= KEY_LEAST)

    return bound(met, lambda m: F.when(F.size(m) == 0, F.array(run)).otherwise(parts(m)).cast(SPAN))


def find(docs: DataFrame, table: list[float], min_ratio: float = MIN_RATIO) -> DataFrame:
    """Add ``base`` and ``found`` (all spans, by start, then kind) to documents (column text)."""
    based = base_spans(docs)
    runs = spans_of(F.col("text"), KEY, 3)
    left = F.flatten(F.transform(runs, lambda s: beside(s, F.col("base"))))
    likely = F.filter(left, lambda s: mean_ratio(s["value"], table) >= min_ratio)
    return based.withColumn("found", F.array_sort(F.concat("base", likely)))


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """One row per document: counts of base spans, their digest, all spans."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = find(docs, train(docs), min_ratio).drop("text")
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        (F.size("found") - F.size("base")).cast("long").alias("n_markov"),
    )


def redacted(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with every stretch covered by ``spans`` (sorted by start) replaced by ``mask``."""
    state = "struct<done:bigint,out:string>"

    def cover(a: Column, s: Column) -> Column:
        piece = F.substr(text, (a["done"] + 1).cast("int"), (s["start"] - a["done"]).cast("int"))
        fresh = F.when(s["start"] >= a["done"], F.concat(a["out"], piece, F.lit(mask))).otherwise(a["out"])
        return F.struct(F.greatest(a["done"], s["end"]).alias("done"), fresh.alias("out")).cast(state)

    start = F.struct(F.lit(0).cast("bigint").alias("done"), F.lit("").alias("out")).cast(state)
    rest = lambda a: F.concat(a["out"], F.substr(text, (a["done"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, cover, rest))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all whole documents."""
    return secrets(documents(spark, sf_dir))
