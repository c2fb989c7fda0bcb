"""Document quality from a linear-chain conditional random field that labels every line good or bad."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerwatch.llm.logistic import fit_logistic, predict_logistic
from ledgerwatch.llm.store import crc_fold, text_of
from ledgerwatch.llm.toxicity import labelled

FOLDS, HELD_OUT = 5, 0
CUTOFF = 0.3
FIT_DOCS = 4_000
STEPS = 150
RATE = 0.3
SHAPE = 10
FEATURES = 3 * SHAPE + 3
_SYMBOL = re.compile(r"[#*$%&<>=_~^@\\{}\[\]]")
_MARK = re.compile(r"[!?]")
_DIGIT = re.compile(r"\d")


def shape(line: str, earlier: set[int]) -> list[float]:
    """Figures of one line alone, each about 0 to 1; `earlier` holds the hashes of the lines before it."""
    words = line.split()
    n, length = len(words), max(1, len(line))
    letters = max(1, length - line.count(" "))
    key = hash(line)
    again = 1.0 if n and key in earlier else 0.0
    earlier.add(key)
    distinct = len(set(words))
    triples = len({*zip(words, words[1:], words[2:])}) if n > 2 else 1
    return [
        min(1.0, 5 * len(_SYMBOL.findall(line)) / letters),
        min(1.0, 10 * len(_MARK.findall(line)) / letters),
        min(1.0, 20 * line.count("|") / letters),
        min(1.0, 2 * sum(map(str.isupper, line)) / letters),
        min(1.0, 5 * len(_DIGIT.findall(line)) / letters),
        1.0 - distinct / n if n else 0.0,
        1.0 - triples / max(1, n - 2) if n > 2 else 0.0,
        again,
        1.0 if n < 4 else 0.0,
        min(1.0, abs(letters / max(1, n) - 5.0) / 10),
    ]


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, lengths) of the lines of a text that have a word: own figures, those of both neighbours, and the ends."""
    earlier: set[int] = set()
    lines = [line for line in text.split("\n") if line.strip()]
    if not lines:
        return np.zeros((0, FEATURES)), np.zeros(0)
    own = np.array([shape(line, earlier) for line in lines])
    out = np.zeros((len(lines), FEATURES))
    out[:, :SHAPE] = own
    out[1:, SHAPE : 2 * SHAPE] = own[:-1]
    out[:-1, 2 * SHAPE : 3 * SHAPE] = own[1:]
    out[0, -3] = out[-1, -2] = out[:, -1] = 1.0
    return out, np.array([len(line) for line in lines], float)


@dataclass
class LineField:
    """Weights of a two-label chain: `weights` give the score of the label good, `pairs` that of each pair of labels."""

    weights: np.ndarray
    pairs: np.ndarray


def _log_add(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def marginals(field_: LineField, unary: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over a batch of chains, padded to one length.

    `unary` is (chains, lines); returns the probability that each line is good, and the summed probabilities of pairs.
    """
    chains, most = unary.shape
    scores = np.stack([np.zeros_like(unary), unary], axis=2)
    live = np.arange(most)[None, :] < lengths[:, None]
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0]
    for t in range(1, most):
        step = _log_add(forward[:, t - 1, :, None] + field_.pairs[None], 1) + scores[:, t]
        forward[:, t] = np.where(live[:, t, None], step, forward[:, t - 1])
    for t in range(most - 2, -1, -1):
        step = _log_add(field_.pairs[None] + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(live[:, t + 1, None], step, 0.0)
    total = _log_add(forward[:, -1], 1)
    good = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None])
    both = np.zeros((2, 2))
    if most > 1:
        pair = forward[:, :-1, :, None] + field_.pairs[None, None] + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        both = (np.exp(np.minimum(pair, 0)) * live[:, 1:, None, None]).sum(axis=(0, 1))
    return good * live, both


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    out = np.zeros((len(rows), max(1, int(lengths.max(initial=1))), FEATURES))
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out, lengths


def fit_field(rows: list[np.ndarray], labels: np.ndarray, chunk: int = 64) -> LineField:
    """Weights by gradient ascent of the conditional likelihood, every line of a document having the document's label.

    Long documents are cut into chains of `chunk` lines for the fit; scoring runs over whole documents. Both labels weigh
    the same in total.
    """
    field_ = LineField(np.zeros(FEATURES), np.array([[0.5, -0.5], [-0.5, 0.5]]))
    chains = [(r[a : a + chunk], y) for r, y in zip(rows, labels) for a in range(0, len(r), chunk)]
    if not chains or len({y for _, y in chains}) < 2:
        return field_
    x, lengths = padded([r for r, _ in chains])
    y = np.array([v for _, v in chains], float)
    live = (np.arange(x.shape[1])[None, :] < lengths[:, None]).astype(float)
    lines = np.array([(live * (y == v)[:, None]).sum() for v in (0.0, 1.0)])
    weight = (lines.sum() / (2 * lines))[y.astype(int)] / lines.sum()
    groups = [np.flatnonzero((lengths > a) & (lengths <= b)) for a, b in ((0, 2), (2, 4), (4, 8), (8, 16), (16, 32), (32, chunk))]
    square = [np.full(FEATURES, 1e-8), np.full((2, 2), 1e-8)]
    for _ in range(STEPS):
        gradient, pair_gradient = -1e-4 * field_.weights, -1e-4 * field_.pairs
        for g in groups:
            if len(g):
                most = int(lengths[g].max())
                own, n = x[g, :most], lengths[g]
                for value in (0.0, 1.0):
                    side = y[g] == value
                    if not side.any():
                        continue
                    good, both = marginals(field_, own[side] @ field_.weights, n[side])
                    w = weight[g][side][0]
                    gradient = gradient + w * np.einsum("ct,ctf->f", (value - good) * live[g][side][:, :most], own[side])
                    seen = np.zeros((2, 2))
                    seen[int(value), int(value)] = (n[side] - 1).sum()
                    pair_gradient = pair_gradient + w * (seen - both)
        square = [square[0] + gradient**2, square[1] + pair_gradient**2]
        field_ = LineField(field_.weights + RATE * gradient / np.sqrt(square[0]), field_.pairs + RATE * pair_gradient / np.sqrt(square[1]))
    return field_


def document_figures(field_: LineField, text: str) -> np.ndarray:
    """Length-weighted mean of the marginals of good, its log-odds, the worst line's marginal, and whether there are lines."""
    x, lengths = line_features(text)
    if not len(x):
        return np.array([0.5, 0.0, 0.5, 0.0])
    good = _chain(field_, x)
    share = float((good * lengths).sum() / lengths.sum())
    return np.array([share, np.log((share + 1e-3) / (1 - share + 1e-3)), float(good.min()), 1.0])


def _chain(field_: LineField, x: np.ndarray) -> np.ndarray:
    """Marginals of good along one document, by odds instead of logarithms: two numbers per line."""
    good = np.exp(np.clip(x @ field_.weights, -30, 30)).tolist()
    (a, b), (c, d) = np.exp(field_.pairs).tolist()
    n = len(good)
    forward = [(0.5, 0.5)] * n
    f0, f1 = 1.0, good[0]
    for t in range(n):
        if t:
            f0, f1 = f0 * a + f1 * c, (f0 * b + f1 * d) * good[t]
        total = f0 + f1
        f0, f1 = f0 / total, f1 / total
        forward[t] = (f0, f1)
    out = [0.0] * n
    b0 = b1 = 1.0
    for t in range(n - 1, -1, -1):
        f0, f1 = forward[t]
        out[t] = f1 * b1 / (f0 * b0 + f1 * b1)
        g = good[t]
        b0, b1 = a * b0 + b * g * b1, c * b0 + d * g * b1
        total = b0 + b1
        b0, b1 = b0 / total, b1 / total
    return np.array(out)


@dataclass
class QualityModel:
    field_: LineField
    logistic: tuple


def train(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """A chain over the lines of one half of at most about FIT_DOCS labelled documents; the other half calibrates it."""
    rows = labelled(docs, labels, "quality", FOLDS, HELD_OUT, FIT_DOCS)
    half = F.pmod(F.xxhash64(F.col("id"), F.lit("half")), F.lit(2))

    def run(batches):
        for batch in batches:
            found = [line_features(t)[0].astype(np.float32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["y", "x"])

    got = rows.filter(half == 0).select("y", "text").mapInArrow(run, "y int, x binary").collect()
    first = [(np.frombuffer(r.x, np.float32).reshape(-1, FEATURES).astype(float), r.y) for r in got if r.x]
    field_ = fit_field([x for x, _ in first], np.array([y for _, y in first], int))
    figures = _figures(rows.filter(half == 1).select("id", "text", "y"), field_)
    y = np.array([r.y for r in figures], float)
    x = np.array([r.figures for r in figures], float).reshape(len(y), 4)
    return QualityModel(field_, fit_logistic(x, y))


def _figures(rows: DataFrame, field_: LineField) -> list:
    def run(batches):
        for batch in batches:
            found = [document_figures(field_, t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(found, pa.list_(pa.float64()))], names=["y", "figures"])

    return rows.mapInArrow(run, "y int, figures array<double>").collect()


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, score, good_share and worst_line for every row of `docs`: whole texts, every line.

    Null or empty text: no lines, scored as such texts were in the labels. Null id: kept as it is. Equal rows: equal
    scores. Very long texts cost in proportion to their length. Empty input: empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    whole = isinstance(docs.schema[id_col].dataType, IntegralType)

    def run(batches):
        own = shared.value
        for batch in batches:
            texts = (t for at in range(0, len(batch), 256) for t in batch.column(1).slice(at, 256).to_pylist())
            x = np.array([document_figures(own.field_, t) for t in texts]).reshape(len(batch), 4)
            columns = [pa.array(c) for c in (predict_logistic(x, own.logistic), x[:, 0], x[:, 2])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "score", "good_share", "worst_line"])

    given = docs.select(docs[id_col].cast("long" if whole else "string").alias("id"), text_of(docs, text).alias("text"))
    return given.mapInArrow(run, f"id {'bigint' if whole else 'string'}, score double, good_share double, worst_line double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, train(docs, labels))
    held_out = (crc_fold(F.col("id"), FOLDS) == HELD_OUT).alias("held_out")
    predicted = (F.col("score") >= CUTOFF).cast("int").alias("predicted")
    return scored.select(F.col("id").alias("doc_id"), held_out, "score", predicted, "good_share", "worst_line")
