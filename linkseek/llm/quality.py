"""Quality of documents from overlapping heuristic labellers, without labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkseek.llm.batches import list_array, mix, span_hashes, text_slices, word_spans

# Documents of the sample that the scorer is fitted on, about; all of a smaller table.
TRAIN_ROWS = 10_000
# Weights of the scorer: one half for words, one for pairs of word shapes.
BUCKETS = 1 << 16
THRESHOLD = 0.5
EM_ROUNDS = 200
EPOCHS = 12

GOOD, BAD, ABSTAIN = 1, 0, -1

# Frequent short words of some languages. Text has some of them, or has, in whatever
# language, short words of its own again and again.
_STOP_WORDS = (
    "the of and to a in is it that for on as with are was be by this an not de la le les et un une que"
    " en el los der die das und ist zu mit den von ein eine auf pour dans est qui sur au se por con del"
).split()

# Classes of bytes: lower, upper, digit, space, sentence mark, other ASCII; past ASCII counts as lower.
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123] = 0
_CLASS[128:] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[33, 39, 44, 45, 46, 58, 59, 63]] = 4
# In a shape, letters and digits count by their class, other characters for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")

# Each labeller's share, above which it votes bad, below which good; in between it abstains.
LABELLERS = {
    "symbol_words": (0.20, 0.03),
    "upper_letters": (0.50, 0.20),
    "repeated_words": (0.20, 0.04),
    "repeated_runs": (0.35, 0.10),
    "letterless_words": (0.20, 0.05),
    "exclamations": (0.20, 0.03),
    "few_frequent_words": (0.985, 0.93),
    "odd_word_sizes": (0.50, 0.25),
}
# Labellers don't judge shorter texts; the one on frequent words needs more to call a text bad, as
# short texts of any language repeat few.
_LEAST_WORDS = 3
_LEAST_STOPPED = 50
# Characters of a short word, at most.
_SHORT = 4


class Words:
    """The words of a slice of texts, and sums of anything over each text's words or bytes."""

    def __init__(self, texts: list[bytes]):
        self.begin, self.end, self.data, self.bounds = word_spans(texts)
        self.start = np.searchsorted(self.begin, self.bounds)
        self.n = np.diff(self.start)
        self.text = np.repeat(np.arange(len(texts)), self.n)
        self.hash = span_hashes(self.data, self.begin, self.end)

    def per_text(self, of_words: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(of_words, dtype=np.int64)])
        return total[self.start[1:]] - total[self.start[:-1]]

    def in_words(self, of_bytes: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(of_bytes, dtype=np.int64)])
        return total[self.end] - total[self.begin]

    def same_text(self, back: int) -> np.ndarray:
        """Whether the word so many places before is one of the same text."""
        out = np.zeros(len(self.text), bool)
        out[back:] = self.text[back:] == self.text[:-back]
        return out

    def shapes(self) -> np.ndarray:
        """A hash of each word's shape: classes of its characters, runs of one class as one."""
        shape = _SHAPE[self.data]
        new = np.ones(len(shape), bool)
        new[1:] = shape[1:] != shape[:-1]
        new[self.begin] = True
        at = np.concatenate([[0], np.cumsum(new)])
        return span_hashes(shape[new], at[self.begin], at[self.end])


def votes(texts: list[bytes]) -> np.ndarray:
    """A row of votes per text, a column per labeller."""
    w = Words(texts)
    kind = _CLASS[w.data]
    letters = w.in_words(kind <= 1)
    n = np.maximum(w.n, 1)
    twice = np.zeros(len(w.hash), bool)
    twice[1:] = (w.hash[1:] == w.hash[:-1]) & w.same_text(1)[1:]
    five = np.zeros(len(w.hash), np.uint64)
    for k in range(5):
        five[4:] = mix(five[4:] + w.hash[k : len(w.hash) - 4 + k])
    known = np.flatnonzero(w.same_text(4))
    _, where, count = np.unique(
        mix(five[known] + mix(w.text[known].astype(np.uint64))), return_inverse=True, return_counts=True
    )
    again = np.zeros(len(w.hash), bool)
    again[known] = count[where] > 1
    stop = np.unique(span_hashes(*_stop_spans()))
    sizes = w.in_words((w.data & 0xC0) != 0x80)
    # Scripts of three bytes a character and more don't put spaces between words.
    spaced = w.end - w.begin < 2.5 * sizes
    letters_only = w.in_words((kind <= 1) & ((w.data & 0xC0) != 0x80)) == sizes
    _, where, count = np.unique(
        mix(w.hash + mix(w.text.astype(np.uint64))), return_inverse=True, return_counts=True
    )
    frequent = np.isin(w.hash, stop) | ((count[where] > 1) & (sizes <= _SHORT) & letters_only)
    shares = np.stack([
        w.per_text(w.in_words(kind == 5) > 0) / n,
        w.per_text(w.in_words(kind == 1)) / np.maximum(w.per_text(letters), 1),
        w.per_text(twice) / n,
        w.per_text(again) / n,
        w.per_text(letters == 0) / n,
        w.per_text(w.in_words(w.data == ord("!")) > 0) / n,
        1 - w.per_text(frequent) / n,
        w.per_text(spaced & ((sizes < 2) | (sizes > 18))) / n,
    ], axis=1)
    bad, good = np.array(list(LABELLERS.values())).T
    out = np.where(shares > bad, BAD, np.where(shares < good, GOOD, ABSTAIN)).astype(np.int8)
    out[w.n < _LEAST_WORDS] = ABSTAIN
    few = out[:, list(LABELLERS).index("few_frequent_words")]
    few[(w.n < _LEAST_STOPPED) & (few == BAD)] = ABSTAIN
    return out


def _stop_spans():
    begin, end, data, _ = word_spans([" ".join(_STOP_WORDS).encode()])
    return data, begin, end


def fit_labellers(patterns: np.ndarray, count: np.ndarray) -> tuple[float, np.ndarray]:
    """The share of good texts, and P(votes good | bad or good) of each labeller where it votes, by
    expectation-maximisation over vote patterns (a row each) and how many texts have them.

    Given the quality, labellers vote independently; an abstention says nothing. A labeller
    sees one defect of many, so the start trusts votes for bad: good without any, less so with more.
    """
    is_good, is_bad = (patterns == GOOD).astype(float), (patterns == BAD).astype(float)
    good = np.array([0.95, 0.3, 0.05])[np.minimum(is_bad.sum(axis=1).astype(int), 2)]
    prior, accuracy = 0.5, np.full((2, patterns.shape[1]), 0.5)
    for _ in range(EM_ROUNDS):
        weight = np.stack([1 - good, good]) * count
        prior = float((weight[1].sum() + 1) / (weight.sum() + 2))
        accuracy = (weight @ is_good + 1) / (weight @ (is_good + is_bad) + 2)
        before, good = good, posterior(patterns, prior, accuracy)
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
    return prior, accuracy


def posterior(patterns: np.ndarray, prior: float, accuracy: np.ndarray) -> np.ndarray:
    """P(good) of each vote pattern."""
    is_good, is_bad = (patterns == GOOD).astype(float), (patterns == BAD).astype(float)
    log = np.log(accuracy) @ is_good.T + np.log(1 - accuracy) @ is_bad.T
    log += np.log([[1 - prior], [prior]])
    return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features: where each text's start, their buckets and their values.

    Words, and pairs of neighbouring words' shapes with whether the words are equal. A value is the
    root of the share of the text's words, so that each half has length one.
    """
    w = Words(texts)
    shape = w.shapes()
    before = np.zeros(len(shape), np.uint64)
    before[1:] = np.where(w.same_text(1)[1:], mix(shape[:-1] + (w.hash[1:] == w.hash[:-1])), 0)
    half = np.uint64(BUCKETS // 2)
    bucket = np.concatenate([w.hash % half, half + mix(shape + before) % half]).astype(np.int64)
    key, count = np.unique(np.tile(w.text, 2) * BUCKETS + bucket, return_counts=True)
    text = key // BUCKETS
    return (
        np.searchsorted(text, np.arange(len(texts) + 1)), (key % BUCKETS).astype(np.int32),
        np.sqrt(count / np.maximum(w.n, 1)[text]),
    )


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches):
        cast = votes(texts)
        flat = np.arange(len(texts) + 1) * cast.shape[1]
        yield pa.RecordBatch.from_pydict({
            "sample": batch.column("sample"),
            "votes": list_array(pa.array(cast.ravel().astype(np.int32)), flat),
        })


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches):
        cast = votes(texts)
        flat = np.arange(len(texts) + 1) * cast.shape[1]
        start, bucket, value = features(texts)
        yield pa.RecordBatch.from_pydict({
            "sample": batch.column("sample"),
            "votes": list_array(pa.array(cast.ravel().astype(np.int32)), flat),
            "bucket": list_array(pa.array(bucket), start), "value": list_array(pa.array(value.astype(np.float32)), start),
        })


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Weights of the logistic scorer of P(good), by gradient steps over small batches."""
    rows = rows.sort_values("sample", kind="stable")
    size = rows["bucket"].map(len).to_numpy()
    bucket = np.concatenate([*rows["bucket"], np.zeros(0, np.int32)])
    value = np.concatenate([*rows["value"], np.zeros(0, np.float32)])
    start = np.concatenate([[0], np.cumsum(size)])
    wanted = rows["good"].to_numpy(float)
    weight, square = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-6)
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 256):
            batch = order[at : at + 256]
            text = np.repeat(np.arange(len(batch)), size[batch])
            index = np.repeat(start[batch] - np.concatenate([[0], np.cumsum(size[batch])[:-1]]), size[batch])
            index = index.astype(np.int64) + np.arange(len(text))
            z = np.bincount(text, weight[bucket[index]] * value[index], len(batch)) + weight[-1]
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - wanted[batch]
            slope = np.bincount(bucket[index], error[text] * value[index], BUCKETS + 1)
            slope[-1] = error.sum()
            slope = slope / len(batch) + 1e-6 * weight
            square += slope**2
            weight -= 0.5 * slope / np.sqrt(square)
    return pd.DataFrame({"bucket": np.arange(BUCKETS + 1), "weight": weight})


def fit_quality(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights of the scorer, the last one its constant.

    Votes of all documents are counted by pattern, of which there are 3 to the number of labellers
    at most; only these counts come to the driver. The scorer is fitted in one task on a sample
    of the texts of about `train_rows` documents, chosen by a hash and each once, however many copies it has.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "sample", F.xxhash64("text", F.lit(7))
    )
    counted = (
        texts.mapInArrow(_vote_rows, "sample long, votes array<int>")
        .groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    )
    if not counted:
        return np.zeros(BUCKETS + 1)
    patterns = np.array([r["votes"] for r in counted], np.int8)
    count = np.array([r["n"] for r in counted], float)
    known = posterior(patterns, *fit_labellers(patterns, count))
    labels = docs.sparkSession.createDataFrame(
        [(p, float(g)) for p, g in zip(patterns.tolist(), known)], "votes array<int>, good double"
    )
    share = min(1.0, train_rows / count.sum())
    chosen = texts.where(F.pmod("sample", F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).dropDuplicates(["sample"])
    rows = chosen.mapInArrow(
        _feature_rows, "sample long, votes array<int>, bucket array<int>, value array<float>"
    ).join(labels, "votes").drop("votes")
    fitted = rows.groupBy(F.lit(0).alias("all")).applyInPandas(
        lambda frame: _fit(frame), "bucket long, weight double"
    )
    weights = np.zeros(BUCKETS + 1)
    for row in fitted.collect():
        weights[row["bucket"]] = row["weight"]
    return weights


def score_quality(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """All rows of `docs` with `quality` (P(good)) and `kept`; columns of these names give way.

    A text without words (null, empty or white space) has quality 0. Equal texts get equal
    scores; other columns, nulls in them included, stay as they are.
    """
    docs = docs.drop("quality", "kept")
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for batch, texts in text_slices(batches):
            start, bucket, value = features(texts)
            text = np.repeat(np.arange(len(texts)), np.diff(start))
            z = np.bincount(text, weight[bucket] * value, len(texts)) + weight[-1]
            quality = np.where(np.diff(start) > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(quality), pa.array(quality >= threshold)],
                [*batch.schema.names, "quality", "kept"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, quality double, kept boolean")
