"""Operator 6: language identification by a linear-chain conditional random field.

Words are runs of letters. Each word's features (prefixes and suffixes of one to
three letters, its letter bigrams and trigrams with word boundaries, and its
entry in a lexicon of training words) give a weight for each language; learned
transitions link neighbouring words. Forward-backward gives every word its
probability of each language, in whole texts, so a code-switched text has
labels that change with it. A document's language is the one with the largest
mean probability over its letters, and that mean is its score.

Weights and transitions maximise the conditional likelihood of a bounded sample:
at most about ``PER_LANG`` training documents of each language of at most
``SAMPLE_CHARS`` characters, chosen by hash. Half of the training sequences are
spliced from two documents, which teaches the transitions.

Nulls and edges: a null text, or one without letters, is ``und`` with score 0; rows
with a null lang are no training rows; with no training rows every document is
``und``; ties go to the language that sorts first; repeated rows are labelled each
by itself; a null doc_id is kept; an empty table gives an empty result; no other
column is used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.llm import textarrays as ta
from tapehouse.llm.shuffling import documents, give_back

U64 = np.uint64
HASHED = 1 << 17
PER_LANG, SAMPLE_CHARS, LEXICON = 400, 200_000, 20_000
LENGTH, BATCH, STEPS, RATE = 24, 192, 160, 0.3
UND = "und"
#: Bytes of text that are labelled, and distinct words whose features are made, at once.
SLICE, WORDS_AT_ONCE = 1 << 20, 1 << 13


def letter_table() -> tuple[np.ndarray, np.ndarray]:
    """For code points below 0x10000: whether a letter, and its lower case."""
    if "letters" not in ta._tables:
        letter = np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)
        low = np.arange(0x10000, dtype=np.uint32)
        for c in np.flatnonzero(letter).tolist():
            x = chr(c).lower()
            if len(x) == 1 and ord(x) < 0x10000:
                low[c] = ord(x)
        ta._tables["letters"] = letter, low
    return ta._tables["letters"]


def letter_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case code points, starts and ends of all words, and each document's range in the words."""
    letter, low = letter_table()
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    count = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    at = count[offs]
    small = points < 0x10000
    inside = np.zeros(len(points), bool)
    inside[small] = letter[points[small]]
    far = np.unique(points[~small])
    if len(far):
        inside |= np.isin(points, far[[chr(c).isalpha() for c in far.tolist()]])
    points = np.where(small, low[np.where(small, points, 0)], points)
    full = at[:-1] < at[1:]
    first, last = at[:-1][full], at[1:][full] - 1
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[first] = inside[first]
    end[:-1] &= ~inside[1:]
    end[last] = inside[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return points, starts, ends, np.searchsorted(starts, at)


def word_ids(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word (four bytes a letter)."""
    raw = points.astype("<u4").view(np.uint8)
    return ta.span_hash(raw, starts * 4, ends * 4)


def features(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) pairs of all words. Features from ``HASHED`` on are lexicon entries."""
    size = ends - starts
    n = len(size)
    padded = np.concatenate(([0], np.cumsum(size + 2)))
    body = np.zeros(padded[-1], np.uint64)
    inner = np.repeat(padded[:-1] + 1 - np.cumsum(size) + size, size) + np.arange(size.sum())
    body[inner] = points[np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())]
    body[padded[:-1]], body[padded[1:] - 1] = 1, 2  # word boundaries
    owner = np.repeat(np.arange(n), size + 2)
    words, feats = [], []

    def add(kind: int, word: np.ndarray, parts: list[np.ndarray]) -> None:
        h = np.full(len(word), kind, U64) * U64(ta.GAMMA)
        for x in parts:
            h = ta.mix(h + x)
        words.append(word)
        feats.append((h % U64(HASHED)).astype(np.int64))

    for k in (1, 2, 3):
        w = np.flatnonzero(size >= k)
        add(k, w, [body[padded[w] + 1 + j] for j in range(k)])
        add(10 + k, w, [body[padded[w + 1] - 1 - k + j] for j in range(k)])
        if k > 1:
            m = len(body) - k + 1
            inside = np.flatnonzero(owner[:m] == owner[k - 1 :]) if m > 0 else np.zeros(0, np.int64)
            add(20 + k, owner[inside], [body[inside + j] for j in range(k)])
    if len(lexicon) and n:
        h = word_ids(body.astype(np.uint32), padded[:-1] + 1, padded[1:] - 1)
        at = np.minimum(np.searchsorted(lexicon, h), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[at] == h)
        words.append(known)
        feats.append(HASHED + at[known])
    return np.concatenate(words), np.concatenate(feats)


class Words:
    """The distinct words of a sample of texts, in order of their hash.

    Texts and words are taken a slice at a time, so that beside a number for each word
    of a text and the code points and features of the distinct ones nothing is held.
    """

    def __init__(self, texts: pa.Array):
        data, offs = ta.flat(texts)
        found, points, size = np.zeros(0, U64), [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        order, said, at = np.zeros(0, np.int64), [np.zeros(0, U64)], [np.zeros(1, np.int64)]
        for i, j in ta.slices(offs, SLICE):
            chars, starts, ends, ranges = letter_words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            said.append(word_ids(chars, starts, ends))
            at.append(at[-1][-1] + ranges[1:])
            distinct, first = np.unique(said[-1], return_index=True)
            new = ~np.isin(distinct, found)
            a, n = starts[first[new]], (ends - starts)[first[new]]
            points.append(chars[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())])
            size.append(n)
            both = np.concatenate((found, distinct[new]))
            place = np.concatenate((order, np.arange(len(order), len(both))))
            by_hash = np.argsort(both)
            found, order = both[by_hash], place[by_hash]
        ends = np.cumsum(np.concatenate(size))
        self.points, self.hash = np.concatenate(points), found
        self.starts, self.ends = (ends - np.concatenate(size))[order], ends[order]
        number = [np.searchsorted(found, x).astype(np.int32) for x in said]
        self.count = sum((np.bincount(x, minlength=len(found)) for x in number), np.zeros(len(found), np.int64))
        number, at = np.concatenate(number), np.concatenate(at)
        self.docs = [number[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def features(self, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``features`` of all words, word by word, and each word's range in them."""
        feats, number = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for i in range(0, len(self.hash), WORDS_AT_ONCE):
            starts, ends = self.starts[i : i + WORDS_AT_ONCE], self.ends[i : i + WORDS_AT_ONCE]
            word, feature = features(self.points, starts, ends, lexicon)
            feats.append(feature[np.argsort(word, kind="stable")].astype(np.int32))
            number.append(np.bincount(word, minlength=len(starts)))
        return np.concatenate(feats), np.cumsum(np.concatenate(number))


class Crf:
    """Weights of the features, transitions and starts of each of ``langs``."""

    def __init__(self, langs: list[str], lexicon: np.ndarray):
        self.langs, self.lexicon = langs, lexicon
        n = len(langs)
        self.weight = np.zeros((HASHED + len(lexicon), n), np.float32)
        self.move = np.zeros((n, n), np.float32)
        self.start = np.zeros(n, np.float32)

    def emissions(self, word: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        out = np.empty((n, len(self.langs)), np.float32)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(word, weights=self.weight[feature, k], minlength=n)
        return out

    def marginals(self, emit: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Probability of each language at every word; sequence i has ``size[i]`` words from ``begin[i]`` on.

        Sequences advance together, longest first; each step is normalised, so
        texts of any length keep their precision.
        """
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        longest = int(size[0]) if len(size) else 0
        alive = np.searchsorted(-size, -np.arange(longest), "left")
        local = np.exp(emit - emit.max(axis=1, keepdims=True)).astype(np.float32)
        move, first = np.exp(self.move - self.move.max()), np.exp(self.start - self.start.max())
        forward = np.empty_like(local)
        state = None
        for t in range(longest):
            at = begin[: alive[t]] + t
            state = local[at] * (first if t == 0 else state[: len(at)] @ move)
            state /= state.sum(axis=1, keepdims=True)
            forward[at] = state
        back = np.ones((0, len(self.langs)), np.float32)
        for t in range(longest - 1, -1, -1):
            at = begin[: alive[t]] + t
            if len(back) < len(at):  # sequences whose last word this is
                back = np.concatenate((back, np.ones((len(at) - len(back), len(self.langs)), np.float32)))
            here = forward[at] * back
            forward[at] = here / here.sum(axis=1, keepdims=True)
            back = (local[at] * back) @ move.T
            back /= back.sum(axis=1, keepdims=True)
        return forward

    def gradient(self, emit: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Gradients of the log-likelihood of equally long sequences (sequences x words x
        languages): of the emissions, the transitions and the starts; and the likelihood."""
        b, length, n = emit.shape
        alpha = np.empty((length, b, n))
        beta = np.zeros((length, b, n))

        def lse(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis=axis, keepdims=True)
            return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

        alpha[0] = self.start + emit[:, 0]
        for t in range(1, length):
            alpha[t] = lse(alpha[t - 1][:, :, None] + self.move, 1) + emit[:, t]
        for t in range(length - 2, -1, -1):
            beta[t] = lse(self.move + (emit[:, t + 1] + beta[t + 1])[:, None, :], 2)
        total = lse(alpha[-1], 1)
        node = np.exp((alpha + beta).transpose(1, 0, 2) - total[:, None, None])
        gold = np.eye(n)[label]
        move = np.zeros((n, n))
        for t in range(length - 1):
            pair = alpha[t][:, :, None] + self.move + (emit[:, t + 1] + beta[t + 1])[:, None, :] - total[:, None, None]
            move -= np.exp(pair).sum(0)
        np.add.at(move, (label[:, :-1].ravel(), label[:, 1:].ravel()), 1)
        d_emit, rows = gold - node, np.arange(b)
        value = self.start[label[:, 0]] + emit[rows[:, None], np.arange(length), label].sum(1)
        value = value + self.move[label[:, :-1], label[:, 1:]].sum(1) - total
        return d_emit, move, d_emit[:, 0].sum(0), float(value.sum())

    def train(self, docs: list[np.ndarray], labels: list[int], feature: np.ndarray, at: np.ndarray, steps: int = STEPS, seed: int = 0) -> list[float]:
        """AdaGrad on batches of sequences, half of them spliced from two documents.

        ``docs`` hold numbers of distinct words; word w has the features ``feature[at[w] : at[w + 1]]``.
        """
        rng = np.random.default_rng(seed)
        squares = [np.full(x.shape, 1e-6) for x in (self.weight, self.move, self.start)]
        size = np.array([len(d) for d in docs])
        by_lang = [np.flatnonzero((np.array(labels) == k) & (size > 0)) for k in range(len(self.langs))]
        by_lang = [x for x in by_lang if len(x)]
        values = []

        def stretch(length: int) -> tuple[np.ndarray, np.ndarray]:
            d = int(rng.choice(by_lang[rng.integers(len(by_lang))]))
            a = int(rng.integers(0, max(1, size[d] - length + 1)))
            words = np.resize(docs[d][a : a + length], length)
            return words, np.full(length, labels[d])

        for _ in range(steps if by_lang else 0):
            seqs = []
            for b in range(BATCH):
                cut = int(rng.integers(2, LENGTH - 1)) if b % 2 else LENGTH
                parts = [stretch(cut)] + ([stretch(LENGTH - cut)] if cut < LENGTH else [])
                seqs.append([np.concatenate(x) for x in zip(*parts, strict=True)])
            words, label = (np.stack(x) for x in zip(*seqs, strict=True))
            used, inverse = np.unique(words, return_inverse=True)
            number = at[used + 1] - at[used]
            which = np.repeat(np.arange(len(used)), number)
            feats = feature[np.repeat(at[used] - np.cumsum(number) + number, number) + np.arange(number.sum())]
            emit = self.emissions(which, feats, len(used))[inverse.reshape(words.shape)]
            d_emit, d_move, d_start, value = self.gradient(emit, label)
            values.append(value / BATCH)
            of_word = np.zeros((len(used), len(self.langs)))
            np.add.at(of_word, inverse.ravel(), d_emit.reshape(-1, len(self.langs)))
            touched, place = np.unique(feats, return_inverse=True)
            d_weight = np.stack([np.bincount(place, weights=of_word[which, k]) for k in range(len(self.langs))], axis=1)
            for x, g, sq, rows in ((self.weight, d_weight, squares[0], touched), (self.move, d_move, squares[1], slice(None)), (self.start, d_start, squares[2], slice(None))):
                g = g / BATCH - 1e-5 * x[rows]
                sq[rows] += g * g
                x[rows] += RATE * g / np.sqrt(sq[rows])
        return values

    def label(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of all words, their first and end code points in their document, each
        document's range in the words."""
        points, starts, ends, at = letter_words(data, offs)
        h = word_ids(points, starts, ends)
        _, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        emit = self.emissions(*features(points, starts[where], ends[where], self.lexicon), len(where))
        marginal = self.marginals(emit[inverse] if len(inverse) else np.zeros((0, len(self.langs))), at[:-1], np.diff(at))
        return marginal, starts, ends, at, points


def fit(training: DataFrame, per_lang: int = PER_LANG) -> Crf:
    """A model of the languages of ``training`` (columns doc_id, text, lang)."""
    rows = training.where("lang IS NOT NULL").select("doc_id", F.col("text").cast("string"), "lang")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return Crf([], np.zeros(0, U64))
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, per_lang / counts[k]))])
    chosen = rows.where(F.length("text") <= SAMPLE_CHARS).where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) <= share[F.col("lang")] * 1_000_003)
    table = chosen.limit(2 * per_lang * len(langs)).toArrow()
    sample = table.to_pandas(integer_object_nulls=True).sort_values(["lang", "doc_id", "text"], kind="stable")
    del table
    model = trained(langs, sample["text"].tolist(), [langs.index(x) for x in sample["lang"]])
    del sample
    give_back()
    return model


def trained(langs: list[str], texts: list[str], labels: list[int]) -> Crf:
    """A model of ``langs`` that learns from ``texts``; their ``labels`` are places in ``langs``."""
    words = Words(pa.array(texts, pa.large_string()))
    often = np.flatnonzero(words.count > 1)
    lexicon = np.sort(words.hash[often[np.argsort(-words.count[often], kind="stable")][:LEXICON]])
    model = Crf(langs, lexicon)
    model.train(words.docs, labels, *words.features(lexicon))
    return model


def judged(model: Crf, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, number of words and mean certainty of the words of every text.

    A word's certainty is the probability of its own best language, so a text
    that switches between languages is as certain as its words are.
    """
    n = len(texts)
    pred, score, n_words, certain = np.array([UND] * n, object), np.zeros(n), np.zeros(n, np.int64), np.zeros(n)
    data, offs = ta.flat(texts)
    for i, j in ta.slices(offs, SLICE) if model.langs else ():
        marginal, starts, ends, at, _ = model.label(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        n_words[i:j] = np.diff(at)
        some = np.flatnonzero(n_words[i:j] > 0)
        if len(some):
            weight = (ends - starts).astype(float)
            total = np.add.reduceat(np.column_stack((marginal * weight[:, None], weight)), at[some], axis=0)
            mean = total[:, :-1] / total[:, -1:]
            best = mean.argmax(axis=1)
            pred[i + some] = np.array(model.langs, object)[best]
            score[i + some] = np.clip(mean[np.arange(len(best)), best], 0, 1)
            certain[i + some] = np.add.reduceat(marginal.max(axis=1).astype(float), at[some]) / n_words[i + some]
    return pred, score, n_words, certain


def has_language(model: Crf, least_certain: float):
    """Test of texts for ``keep_rows``: whether they have words, each certain of some language
    to at least that degree on average. A model without languages can reject no text."""

    def test(texts: pa.Array) -> np.ndarray:
        if not model.langs:
            return np.ones(len(texts), bool)
        pred, _, _, certain = judged(model, texts)
        return (pred != UND) & (certain >= least_certain)

    return test


def predict(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id, lang_pred, score and n_words of every document (columns doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score, n_words, _ = judged(model, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred.tolist(), pa.string()), pa.array(score), pa.array(n_words)],
                names=["doc_id", "lang_pred", "score", "n_words"],
            )

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(run, "doc_id long, lang_pred string, score double, n_words long")


def word_labels(docs: DataFrame, model: Crf) -> DataFrame:
    """One row per stretch of words of one language: doc_id, start and end code point, lang, n_words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = ta.ids(batch.column(0))
            data, offs = ta.flat(batch.column(1))
            for i, j in ta.slices(offs, SLICE):
                if not model.langs:
                    continue
                d, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                marginal, starts, ends, at, _ = model.label(d, o)
                best = marginal.argmax(axis=1)
                owner = np.repeat(np.arange(j - i), np.diff(at))
                new = np.ones(len(best), bool)
                new[1:] = (best[1:] != best[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(new)
                if not len(first):
                    continue
                last = np.append(first[1:], len(best)) - 1
                zero = np.concatenate(([0], np.cumsum((d & 0xC0) != 0x80)))[o[:-1]][owner[first]]
                yield pa.RecordBatch.from_arrays(
                    [ta.id_array(doc[i:j][owner[first]]), pa.array(starts[first] - zero), pa.array(ends[last] - zero), pa.array([model.langs[k] for k in best[first].tolist()], pa.string()), pa.array(last - first + 1)],
                    names=["doc_id", "start_char", "end_char", "lang", "n_words"],
                )

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(run, "doc_id long, start_char long, end_char long, lang string, n_words long")


def fold(column: str = "doc_id"):
    """crc32 of the doc_id as text, modulo 5."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % 5


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all whole documents; every fifth by crc32 of doc_id is held out of training."""
    docs = documents(spark, sf_dir)
    model = fit(docs.where(fold() != 0))
    return predict(docs, model).select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score", "n_words")
