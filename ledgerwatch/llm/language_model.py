"""Language-model scores: word counts of the whole corpus, and a hashed maximum-entropy model of word classes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.store import crc_fold, stored, text_of
from ledgerwatch.llm.words import Words, mix, split_words

FOLDS, HELD_OUT = 10, 0
CLASSES = 32
ROWS = 1 << 13
ROUNDS = 4
RATE = 2.0
RIDGE = 2.0
SMOOTHING = 0.1
HEAD_WORDS = 1 << 18
FIXED = 1e12
END = np.uint64(0xE17D0F7E87)
START = np.uint64(0x57A127)
_SALTS = (0x1F, 0x2B, 0x3D, 0x47)
N_FEATURES = 5


@dataclass
class Tokens:
    """The tokens of consecutive texts, each text closed by an end token: hash, class, and the text it is of."""

    hash: np.ndarray
    cls: np.ndarray
    row: np.ndarray
    first: np.ndarray


def tokens_of(words: Words) -> Tokens:
    """Words with an end token after each text. A class is the end token's, or one of 31 by the last two bytes of the word."""
    n = len(words.first) - 1
    counts = np.diff(words.first)
    first = words.first + np.arange(n + 1)
    row = np.repeat(np.arange(n), counts + 1)
    is_end = np.zeros(len(row), bool)
    is_end[first[1:] - 1] = True
    hashes = np.empty(len(row), np.uint64)
    hashes[is_end], hashes[~is_end] = END, words.hash
    last = words.data[words.end - 1].astype(np.uint64)
    before = np.where(words.end - words.start > 1, words.data[np.maximum(words.end - 2, 0)], 0).astype(np.uint64)
    lower = lambda b: np.where((b >= 65) & (b <= 90), b + np.uint64(32), b)
    own = mix(lower(last) * np.uint64(256) + lower(before)) % np.uint64(CLASSES - 1) + np.uint64(1)
    cls = np.zeros(len(row), np.int64)
    cls[~is_end] = own.astype(np.int64)
    return Tokens(hashes, cls, row, first)


def features_of(tokens: Tokens) -> np.ndarray:
    """(features, tokens): rows of the weight table that are on for each token, from the tokens before it in its text.

    The word before, the two words before, the words two and three back (skips), and the two classes before.
    """
    place = np.arange(len(tokens.hash)) - tokens.first[:-1][tokens.row]

    def back(k: int, values: np.ndarray, none) -> np.ndarray:
        out = np.full(len(values), none, values.dtype)
        out[k:] = np.where(place[k:] >= k, values[:-k], none) if len(values) > k else none
        return out

    one, two, three = (back(k, tokens.hash, START) for k in (1, 2, 3))
    c1, c2 = back(1, tokens.cls, CLASSES), back(2, tokens.cls, CLASSES)
    hashed = (one, one * np.uint64(0x9E3779B97F4A7C15) + two, two, three)
    rows = [(mix(h ^ np.uint64(s)) % np.uint64(ROWS)).astype(np.int64) for h, s in zip(hashed, _SALTS)]
    return np.stack([*rows, ROWS + c1 * (CLASSES + 1) + c2])


TABLE = ROWS + (CLASSES + 1) ** 2


def class_logits(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    out = weights[features[0]] + bias
    for f in features[1:]:
        out += weights[f]
    return out


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def vocabulary(training: DataFrame) -> DataFrame:
    """(hash, n, cls) for every distinct token of all training texts. Words are told apart by a 64-bit hash."""

    def emit(parts: list[Tokens]) -> pa.RecordBatch:
        hashes = np.concatenate([t.hash for t in parts])
        found, at, n = np.unique(hashes, return_index=True, return_counts=True)
        cls = np.concatenate([t.cls for t in parts])[at]
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(cls)], names=["hash", "n", "cls"])

    def run(batches):
        held: list[Tokens] = []
        size = 0
        for batch in batches:
            for words in split_words(batch.column(0)):
                held.append(tokens_of(words))
                size += len(held[-1].hash)
                if size > 4_000_000:
                    yield emit(held)
                    held, size = [], 0
        if held:
            yield emit(held)

    counted = training.select("text").mapInArrow(run, "hash long, n long, cls long")
    return stored(counted.groupBy("hash").agg(F.sum("n").alias("n"), F.first("cls").alias("cls")), "vocabulary")


@dataclass
class LanguageModel:
    """Weights of the class model, the class priors, and the log10 probabilities of the most frequent tokens."""

    weights: np.ndarray
    bias: np.ndarray
    total: int
    distinct: int
    head_hash: np.ndarray
    head_log: np.ndarray

    @property
    def denominator(self) -> float:
        return self.total + SMOOTHING * (self.distinct + 1)


def head_bound(vocab: DataFrame) -> int:
    """The least count such that at most HEAD_WORDS tokens have it or more, from a histogram of a few hundred rows."""
    step = F.floor(F.log2("n") * 8).cast("int").alias("step")
    rows = sorted(((r.step, r.words) for r in vocab.groupBy(step).agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    seen, bound = 0, (rows[0][0] + 1 if rows else 0)
    for at, words in rows:
        if seen + words > HEAD_WORDS:
            break
        seen, bound = seen + words, at
    return math.ceil(2 ** (bound / 8) - 1e-9)


def train(training: DataFrame, vocab: DataFrame, bound: int) -> LanguageModel:
    """Class weights by one pass over all training texts in ROUNDS distributed gradient updates.

    A round takes the documents of its share; every task returns the summed gradient of its own, a row per feature, and
    the updates are scaled by how often the feature was on. Table and messages have a fixed size.
    """
    spark = training.sparkSession
    sums = vocab.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    mass = np.full(CLASSES, SMOOTHING / CLASSES)
    for r in sums:
        mass[r.cls] += r.n + SMOOTHING * r.words
    total, distinct = sum(r.n for r in sums), sum(r.words for r in sums)
    prior = mass / mass.sum()
    head = vocab.filter(F.col("n") >= bound).select("hash", "n").toArrow()
    hashes, n = head["hash"].to_numpy().view(np.uint64), head["n"].to_numpy()
    order = np.argsort(hashes)
    model = LanguageModel(np.zeros((TABLE, CLASSES), np.float32), np.log(prior).astype(np.float32), total, distinct, hashes[order], n[order])
    model.head_log = np.log10((model.head_log + SMOOTHING) / model.denominator)
    schema = "feature long, n float, " + ", ".join(f"g{c} float" for c in range(CLASSES))
    for no in range(ROUNDS):
        share = training.filter(F.pmod(F.xxhash64("text", F.lit("round")), F.lit(ROUNDS)) == no).select("text")
        shared = spark.sparkContext.broadcast((model.weights, model.bias))
        rows = share.mapInArrow(lambda batches, s=shared: _gradient(batches, *s.value), schema)
        summed = rows.groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(f"g{c}").alias(f"g{c}") for c in range(CLASSES)]).toArrow()
        at = summed["feature"].to_numpy()
        gradient = np.stack([summed[f"g{c}"].to_numpy() for c in range(CLASSES)], axis=1)
        curvature = N_FEATURES * summed["n"].to_numpy()[:, None] * (prior * (1 - prior))[None, :] + RIDGE
        weights = model.weights.copy()
        weights[at] += np.clip(RATE * gradient / curvature, -2.0, 2.0).astype(np.float32)
        model.weights = weights
        shared.unpersist()
    return model


def _gradient(batches, weights: np.ndarray, bias: np.ndarray) -> Iterator[pa.RecordBatch]:
    gradient, seen = np.zeros((TABLE, CLASSES), np.float32), np.zeros(TABLE)
    for batch in batches:
        for words in split_words(batch.column(0), piece=1 << 19):
            tokens = tokens_of(words)
            features = features_of(tokens)
            off = -np.exp(log_softmax(class_logits(weights, bias, features)))
            off[np.arange(len(off)), tokens.cls] += 1
            for f in features:
                order = np.argsort(f.astype(np.uint16), kind="stable")
                own = f[order]
                begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                gradient[own[begin]] += np.add.reduceat(off[order], begin, axis=0)
                seen += np.bincount(f, minlength=TABLE)
    used = np.flatnonzero(seen)
    columns = [pa.array(used), pa.array(seen[used].astype(np.float32)), *[pa.array(gradient[used, c]) for c in range(CLASSES)]]
    yield pa.RecordBatch.from_arrays(columns, names=["feature", "n", *[f"g{c}" for c in range(CLASSES)]])


PARTS = "row long, id long, n_tokens long, n_known long, base_fixed long, gain double, rare array<long>, rare_n array<long>"


def partial_scores(docs: DataFrame, model: LanguageModel, id_col: str, text: str) -> DataFrame:
    """Per row what frequent tokens and the class model give, and the rare tokens with their counts, to be looked up."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        base = np.round(own.head_log * FIXED).astype(np.int64)
        row_no = TaskContext.get().partitionId() << 40
        for batch in batches:
            for words in split_words(batch.column(1), piece=1 << 19):
                tokens = tokens_of(words)
                n = len(tokens.first) - 1
                chosen = log_softmax(class_logits(own.weights, own.bias, features_of(tokens)))[np.arange(len(tokens.cls)), tokens.cls]
                gain = np.add.reduceat((chosen - own.bias[tokens.cls]).astype(float), tokens.first[:-1]) / math.log(10)
                at = np.minimum(np.searchsorted(own.head_hash, tokens.hash), max(0, len(own.head_hash) - 1))
                known = own.head_hash[at] == tokens.hash if len(own.head_hash) else np.zeros(len(at), bool)
                fixed = np.add.reduceat(np.where(known, base[at] if len(base) else 0, 0), tokens.first[:-1])
                n_known = np.add.reduceat(known.astype(np.int64), tokens.first[:-1])
                rows, hashes = tokens.row[~known], tokens.hash[~known]
                order = np.lexsort((hashes, rows))
                rows, hashes = rows[order], hashes[order]
                begin = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1]))) if len(rows) else np.zeros(0, np.int64)
                times = np.diff(np.append(begin, len(rows)))
                ends = np.searchsorted(rows[begin], np.arange(n + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (hashes[begin].view(np.int64), times.astype(np.int64))]
                ids = batch.column(0).slice(words.rows.start, n)
                numbers = [np.arange(row_no, row_no + n), np.diff(tokens.first), n_known, fixed]
                row_no += n
                arrays = [pa.array(numbers[0]), ids, *[pa.array(v.astype(np.int64)) for v in numbers[1:]], pa.array(gain), *lists]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "id", "n_tokens", "n_known", "base_fixed", "gain", "rare", "rare_n"])

    given = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text).alias("text"))
    return stored(given.mapInArrow(run, PARTS), "partial-scores")


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of `docs`.

    base_score is the smoothed unigram log10 probability. The model factors a token into its class, given the tokens
    before it, and the token inside its class by its count: score = base_score + sum of log10 P(class | before) / P(class).

    Counts are exact over all training texts and grow with them. The most frequent tokens, at most HEAD_WORDS, are
    broadcast with their probabilities; all others are joined by their hash. Sums of logarithms are kept in units of
    1e-12, so that their order does not matter.

    Null or empty text: the end token alone. Null id: counts as an empty id for the fold, and is returned as it is. Equal
    rows: each counts, and each has its row. Empty input: empty result. No training text: every token is unknown.
    """
    held_out = crc_fold(docs[id_col], FOLDS) == HELD_OUT
    training = docs.filter(~held_out).select(text_of(docs, text).alias("text"))
    vocab = vocabulary(training)
    bound = head_bound(vocab)
    model = train(training, vocab, bound)
    parts = partial_scores(docs, model, id_col, text)
    unit = F.lit(math.log10(SMOOTHING / model.denominator))
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("t")).select("row", F.col("t.rare").alias("hash"), F.col("t.rare_n").alias("k"))
    tail = vocab.filter(F.col("n") < bound).select("hash", F.round(F.log10((F.col("n") + SMOOTHING) / model.denominator) * FIXED).cast("long").alias("fixed"))
    looked_up = rare.join(tail, "hash").groupBy("row").agg(F.sum(F.col("k") * F.col("fixed")).alias("rare_fixed"), F.sum("k").alias("rare_known"))
    joined = parts.select("row", "id", "n_tokens", "n_known", "base_fixed", "gain").join(looked_up, "row", "left")
    known = F.col("n_known") + F.coalesce("rare_known", F.lit(0))
    base = (F.col("base_fixed") + F.coalesce("rare_fixed", F.lit(0))) / F.lit(FIXED) + (F.col("n_tokens") - known) * unit
    return joined.select(
        "id",
        (crc_fold(F.col("id"), FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        known.alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("gain")).alias("score"),
    )


def language_model_report(docs: DataFrame) -> DataFrame:
    return score(docs).withColumnRenamed("id", "doc_id")
