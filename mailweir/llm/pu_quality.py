"""A quality classifier learned from positives and unlabelled text.

The trusted positives are documents labelled good; everything else is plain web text, in
which good documents are as frequent as the class prior says. Minimised is the
non-negative unbiased risk

    prior * E_P[loss(f)] + max(0, E_U[loss(-f)] - prior * E_P[loss(-f)])

with the logistic loss; where the second part falls below zero, the step goes against it.
The model is linear in standardised features and in their squares, so its sigmoid is the
probability that a document is good.

The prior is estimated first: a plain classifier of positives against unlabelled text
ranks both, and no share of the unlabelled text that ranks high can be smaller than
prior times the same share of the positives.

Features are shares and counts of the whole text: kinds of characters, lengths and
repetition of words and lines. The text's language, source and id are not among them.

Fitted is on at most ``sample`` positives and as many unlabelled documents, chosen by a
hash of their ids; their features (not texts) go to the driver. Scoring reads each text once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.llm.common import table
from mailweir.session import stage

#: Rows of each kind the model is fitted on.
SAMPLE = 12_000
FOLDS, HELD_OUT = 3, 1

_ALPHA = [*range(65, 91), *range(97, 123)]
_MARKS = [c for c in range(33, 127) if c not in _ALPHA and not 48 <= c <= 57]
_GROUPS = (
    list(range(65, 91)), list(range(97, 123)), list(range(48, 58)), [32], [10], list(range(128, 256)),
    [c for c in range(32) if c != 10], _MARKS, *([c] for c in _MARKS),
)
_TAKE = np.zeros((256, len(_GROUPS)))
for _k, _group in enumerate(_GROUPS):
    _TAKE[_group, _k] = 1.0


def features(text: str | None) -> np.ndarray:
    """Numbers that describe a whole text; those of an empty text are all zero."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return np.zeros(len(_GROUPS) + 19)
    n = len(words)
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _TAKE
    lengths = np.fromiter(map(len, words), np.float64, n)
    counts = Counter(words)
    lines = data.split(b"\n")
    line_counts = Counter(lines)
    line_lengths = np.fromiter(map(len, lines), np.float64, len(lines))
    ends = Counter(w[-1:] for w in words)
    rest = [
        np.log1p(n), np.log1p(len(data)), lengths.mean(), lengths.std(), lengths.max() ** 0.5,
        (lengths <= 1).mean(), (lengths <= 3).mean(), (lengths >= 12).mean(),
        len(counts) / n, np.log1p(n) - np.log1p(len(counts)), counts.most_common(1)[0][1] / n,
        len(line_counts) / len(lines), max(line_counts.values()) / len(lines),
        np.log1p(line_lengths.mean()), (line_lengths < 20).mean(),
        sum(v for k, v in ends.items() if k in b".!?") / n,
        sum(v for k, v in ends.items() if not k.isalnum() and k < b"\x80") / n,
        sum(v for k, v in counts.items() if k[:1].isupper()) / n,
        sum(map(eq, words, words[1:])) / n,
    ]
    return np.concatenate([np.sqrt(kinds / len(data)), rest])


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def _inputs(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.scale, -6, 6)
        return np.concatenate([x, x * x, np.ones((len(x), 1))], axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._inputs(rows) @ self.weights, -30, 30)))


def _descend(gradient, size: int, steps: int = 400, rate: float = 0.02) -> np.ndarray:
    """Adam over the whole sample."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.2) -> float:
    """The smallest ratio of the shares that rank above a threshold, over thresholds
    that keep at least ``least`` of the positives; one standard error is added."""
    cuts = np.quantile(positive, np.linspace(0.0, 1 - least, 81))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    error = np.sqrt(u * (1 - u) / len(unlabelled) + p * (1 - p) / len(positive)) / p
    return float(np.clip((u / p + error).min(), 0.02, 0.98))


def fit_risk(positive: np.ndarray, unlabelled: np.ndarray, decay: float = 1e-3) -> Model:
    """Fit on features of positives and of unlabelled documents."""
    both = np.concatenate([positive, unlabelled])
    model = Model(both.mean(axis=0), both.std(axis=0) + 1e-6, np.zeros(0), 0.5)
    p, u = model._inputs(positive), model._inputs(unlabelled)

    def plain(w: np.ndarray) -> np.ndarray:
        return -p.T @ _sigmoid(-(p @ w)) / len(p) + u.T @ _sigmoid(u @ w) / len(u) + decay * w

    first = _descend(plain, p.shape[1], 200)
    prior = estimate_prior(p @ first, u @ first)

    def risk(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        surplus = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        below = u.T @ _sigmoid(zu) / len(u) - prior * (p.T @ _sigmoid(zp)) / len(p)
        if surplus < 0:
            return -below + decay * w
        return -prior * (p.T @ _sigmoid(-zp)) / len(p) + below + decay * w

    return Model(model.mean, model.scale, _descend(risk, p.shape[1]), prior)


def held_out(doc_id: str | Column) -> Column:
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _features_of(rows: DataFrame, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(v.as_py()).tolist() for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(found, pa.list_(pa.float64()))], names=[key, "features"]
            )

    return rows.select(key, "text").mapInArrow(run, f"{key} boolean, features array<double>")


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    quality: str = "quality", sample: int = SAMPLE, seed: int = 4,
) -> Model:
    """Fit on labels outside the held-out fold.

    Positives are ids all of whose labels are 1; unlabelled text is a sample of all
    documents outside the fold, whatever their labels. NULL ids and labels are left out.
    With no positives at all, every document scores one half.
    """
    key = F.col(doc_id).alias("doc_id")
    turn, other = (F.xxhash64("doc_id", F.lit(seed + k)) for k in (0, 1))
    open_docs = docs.select(key, F.col(text).alias("text")).filter(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    good = (
        labels.select(key, F.col(quality).alias("quality"))
        .filter(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
    )
    # Two lists of at most `sample` ids each: small enough to broadcast, by construction.
    chosen = stage(
        good.select("doc_id", F.lit(True).alias("positive")).orderBy(turn, "doc_id").limit(sample)
        .unionByName(
            open_docs.select("doc_id", F.lit(False).alias("positive")).orderBy(other, "doc_id").limit(sample).distinct()
        ),
        "quality-sample",
    )
    rows = open_docs.join(F.broadcast(chosen), "doc_id")
    found = _features_of(rows, "positive").limit(4 * sample).collect()
    width = len(features(None))
    values = np.array([r["features"] for r in found]).reshape(len(found), width)
    positive = np.array([r["positive"] for r in found], bool)
    if not positive.any() or positive.all():
        return Model(np.zeros(width), np.ones(width), np.zeros(2 * width + 1), 0.5)
    return fit_risk(values[positive], values[~positive])


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns and the score of the whole text, in one pass without a shuffle."""
    names = list(docs.columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(v.as_py()) for v in batch.column(text)]).reshape(batch.num_rows, len(model.mean))
            scores = pa.array(model.score(rows), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), scores], names=[*names, name])

    return docs.mapInArrow(run, f"{schema}, `{name}` double")


def classify(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    quality: str = "quality", sample: int = SAMPLE,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Empty and NULL texts are scored by their features, which are all zero; a NULL ``doc_id`` is
    not held out; repeated rows each get the same score; an empty table gives no rows. Other
    columns are not looked at.
    """
    model = train(docs, labels, doc_id, text, quality, sample)
    scored = with_score(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op4_pu_quality": op4_pu_quality}
ORACLE: dict[str, str] = {}
