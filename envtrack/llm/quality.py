"""Operator 7: a quality classifier learned from preference pairs (Bradley-Terry).

Each text gives a short vector of style measures. A document's strength is a linear function of a
piecewise-linear expansion of that vector; the chance that one document is preferred to another is the
logistic function of their strengths' difference, so training is logistic regression on feature
differences of (good, bad) pairs of labelled documents. The cut between the classes is a quantile of
the training strengths: the one that classifies the labelled sample with the fewest errors. Strengths
are mapped by a logistic curve that gives the cut the score 0.7.

Labels, language, source and id are never inputs of a score. Features come from one pass over all
texts; the model is fitted on at most ``TRAIN_ROWS`` labelled rows (smallest id hashes first), the only
bound, and is the same for every partition.

Defined results: null and empty texts have zero measures and are scored like any other; repeated rows
get equal scores; labels that are null or neither 0 nor 1 are left out; without labels of both kinds
all scores are 0.7 (0 if all labels are 0); other columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envtrack.llm.common import chunks, staged, text_buffer

#: Labelled rows that the model is fitted on, at most.
TRAIN_ROWS = 20_000
CUT_SCORE = 0.7
KNOTS = (0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98)
STEPS, PAIRS, RATE, DECAY = 1500, 1024, 0.05, 1e-4
FEATURES = ["log_bytes", "upper", "lower", "digit", "blank", "newline", "stop", "pause", "quote", "symbol", "bar",
            "wide", "entropy", "word_length", "distinct", "adjacent", "commonest", "symbol_end", "no_letter",
            "line_length", "distinct_lines"]


def _kind(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


BYTE_KINDS = np.stack([
    _kind(bytes(range(65, 91))), _kind(bytes(range(97, 123))), _kind(b"0123456789"), _kind(b" \t"), _kind(b"\n\r"),
    _kind(b".?"), _kind(b",;:"), _kind(b"'\"()-"), _kind(b"!#$%&*+/<=>@[\\]^_`{}~"), _kind(b"|"),
    _kind(bytes(range(128, 256)))], axis=1)
_SYMBOLS = frozenset(b"!#$%&*+/<=>@[\\]^_`{}~|")


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The style measures of the texts between ``offsets``, one row each, in the order of FEATURES."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n) * 256, size)
    counts = np.bincount(doc + raw, minlength=n * 256).reshape(n, 256)
    share = counts / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    out = np.zeros((n, len(FEATURES)))
    out[:, 0] = np.log1p(size)
    out[:, 1:12] = share @ BYTE_KINDS
    out[:, 12] = entropy
    whole = raw.tobytes()
    for i, (a, z) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        text = whole[a:z]
        words = text.split()
        if not words:
            continue
        tally = Counter(words)
        lines = [x for x in text.split(b"\n") if x]
        m = len(words)
        distinct = tally.keys()
        out[i, 13:] = (
            np.log1p(sum(map(len, words)) / m), len(tally) / m, sum(map(eq, words, words[1:])) / m,
            max(tally.values()) / m, sum(c for w, c in tally.items() if w[-1] in _SYMBOLS) / m,
            sum(tally[w] for w in distinct if len(w) < 4 and not w.isalpha() and w.isascii()) / m,
            np.log1p(len(text) / len(lines)), len(set(lines)) / len(lines))
    return out


@dataclass(frozen=True)
class QualityModel:
    """Knots of each measure, weights of the expansion, the cut and the scale of the strengths."""
    center: np.ndarray
    scale: np.ndarray
    knots: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.center) / self.scale, -8, 8)
        return np.concatenate([z, *(np.maximum(z - k, 0) for k in self.knots)], axis=1)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = (self.strength(x) - self.cut) / self.spread + np.log(CUT_SCORE / (1 - CUT_SCORE))
        score = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        return np.where(self.strength(x) >= self.cut, np.maximum(score, CUT_SCORE),
                        np.minimum(score, np.nextafter(CUT_SCORE, 0)))


def fit(x: np.ndarray, good: np.ndarray) -> QualityModel:
    """The Bradley-Terry model of labelled measures: Adam on the logistic loss of (good, bad) pairs."""
    width = len(FEATURES)
    if not len(x) or good.all() or not good.any():
        bad = len(x) and not good.any()
        return QualityModel(np.zeros(width), np.ones(width), np.zeros((1, width)), np.zeros(2 * width),
                            1.0 if bad else 0.0, 1.0 / 30 if bad else 1.0)
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    knots = np.quantile(np.clip((x - center) / scale, -8, 8), KNOTS, axis=0)
    model = QualityModel(center, scale, knots, np.zeros(width * (1 + len(KNOTS))), 0.0, 1.0)
    z = model.expand(x)
    up, down = z[good], z[~good]
    rng = np.random.default_rng(11)
    w, m, v = model.weights.copy(), 0.0, 0.0
    for t in range(1, STEPS + 1):
        d = up[rng.integers(0, len(up), PAIRS)] - down[rng.integers(0, len(down), PAIRS)]
        g = -(d / (1 + np.exp(np.clip(d @ w, -30, 30)))[:, None]).mean(axis=0) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (1 - t / (STEPS + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    strength = z @ w
    order = np.argsort(strength)
    ranked, label = strength[order], good[order]
    # errors when everything below place k is called bad, for every quantile k / n
    errors = np.append(0, np.cumsum(label)) + (len(down) - np.append(0, np.cumsum(~label)))
    best = np.flatnonzero(errors == errors.min())
    best = best[(best > 0) & (best < len(ranked))]
    k = int(best[len(best) // 2]) if len(best) else 0
    cut = float((ranked[k - 1] + ranked[k]) / 2) if k else float(ranked[0])
    spread = max(float(np.quantile(strength, 0.75) - np.quantile(strength, 0.25)) / 2, 1e-6)
    return QualityModel(center, scale, knots, w, cut, spread)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that labels are never learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def document_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the style measures of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for a, z in chunks(offsets):
                x = features(raw[offsets[a]:offsets[z]], offsets[a:z + 1] - offsets[a])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(z - a + 1) * x.shape[1], pa.int32()), x.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), lists], names=["id", "features"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, features array<double>").withColumnRenamed("id", id_col)


def marked(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """id and label of what may be learned from; an id that is repeated with one label counts once."""
    return labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col)).select(
        id_col, F.col(label_col).alias("label")).distinct()


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents that ``train`` would take, found on ids alone: ``rows`` ids at most, by the same order."""
    ids = docs.select(id_col).join(marked(labels, id_col), id_col).distinct()
    chosen = ids.orderBy(F.xxhash64(id_col), "label").limit(rows).select(id_col).distinct()
    return docs.join(F.broadcast(chosen), id_col, "left_semi")


def train(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          rows: int = TRAIN_ROWS) -> QualityModel:
    """The model of the labelled rows outside the held-out fold; at most ``rows`` come to the driver."""
    sample = (measured.join(marked(labels, id_col, label_col), id_col).select("features", "label", F.xxhash64(id_col).alias("h"))
              .orderBy("h", "label", "features").limit(rows).select("features", "label").collect())
    x = np.array([r[0] for r in sample], float).reshape(len(sample), len(FEATURES))
    return fit(x, np.array([r[1] == 1 for r in sample], bool))


def score(measured: DataFrame, model: QualityModel, id_col: str = "doc_id") -> DataFrame:
    """id, held_out, score, predicted of documents whose features are given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["id", "score"])

    kind = measured.schema[id_col].dataType.simpleString()
    out = measured.select(F.col(id_col).alias("id"), "features").mapInArrow(run, f"id {kind}, score double")
    out = out.withColumnRenamed("id", id_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score",
                      (F.col("score") >= CUT_SCORE).cast("int").alias("predicted"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, learned from ``labels.quality``."""
    measured = staged(document_features(docs), "features")
    return score(measured, train(measured, labels))


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, whole, of the documents that the classifier predicts to be good: no shuffle of texts."""
    model = train(document_features(labelled_texts(docs, labels), text_col=text_col), labels)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(at))
            for a, z in chunks(offsets):
                x = features(raw[offsets[a]:offsets[z]], offsets[a:z + 1] - offsets[a])
                yield batch.slice(a, z - a).filter(pa.array(model.score(x) >= CUT_SCORE))

    return docs.mapInArrow(run, docs.schema)
