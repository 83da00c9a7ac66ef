"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import field

WORD_BUCKETS = 1 << 12
RANK = 8
FIT_ROWS = 8_000  # expected labelled rows a fit reads; scoring and everything else covers all rows
_EPOCHS, _BATCH, _RATE, _DECAY = 8, 128, 0.02, 1e-4
_CACHED_WORDS = 200_000
_SCORED_TOGETHER = 256

STATISTICS = (
    "one", "log_words", "log_chars", "mean_word", "distinct_share", "top_word_share", "repeat_next_share",
    "symbol_share", "pipe_share", "digit_share", "upper_share", "long_word_share", "line_words", "repeated_line_share",
    "mark_end_share", "recorded_length",
)
_WIDTH = WORD_BUCKETS + len(STATISTICS)
_UPPER = re.compile(r"[A-Z]")
_MARKED = re.compile(r"[^\w\s.,;:!?'\"()|-]")


@dataclass
class Model:
    """A fitted machine; score = sigmoid(bias + linear + pairwise)."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scores(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of rows given as concatenated features, each row with at least one.

        The sum over pairs of <v_i, v_j> x_i x_j is half of |sum v_i x_i|^2 - sum |v_i x_i|^2.
        """
        return _sigmoid(self.bias + np.add.reduceat(self.linear[ids] * values, starts) + _pairs(self.factors[ids] * values[:, None], starts)[0])


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; false for a NULL id, which has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit_quality(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", label_col: str = "quality",
) -> Model | None:
    """Fit on labelled rows that are not held out; None when the labels hold only one class or none.

    The fit reads a sample of ``fit_rows`` labelled rows in expectation, chosen by a hash of the id, whole
    texts each; the sample's features are the only thing that reaches the driver. A document with several
    labels counts by their mean, and not at all at exactly one half.
    """
    known = labels.select(field(id_col).cast("long").alias("doc_id"), field(label_col).cast("double").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.avg("label").alias("label")).filter("label <> 0.5")
    share = min(1.0, fit_rows / max(1, known.count()))
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 32) / F.lit(float(1 << 32))
    text, length = _inputs(docs, text_col, length_col)
    texts = docs.select(field(id_col).cast("long").alias("doc_id"), text.alias("text"), length.alias("length"))
    rows = texts.join(known.filter(draw < share), "doc_id")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed = _Buckets()
        for batch in batches:
            found = [featurise(t, n, hashed) for t, n in zip(batch["text"], batch["length"], strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"] > 0.5, "ids": [f[0] for f in found], "values": [f[1] for f in found]})

    sample = rows.mapInPandas(features, "doc_id long, label boolean, ids array<int>, values array<float>").toPandas()
    if sample["label"].nunique() < 2:
        return None
    sample = sample.sort_values("doc_id", kind="stable", ignore_index=True)  # the fit depends on row order
    return _fit(sample["ids"].tolist(), sample["values"].tolist(), sample["label"].to_numpy(np.float64), seed)


def score_quality(
    docs: DataFrame, model: Model | None, threshold: float = 0.3,
    id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars",
) -> DataFrame:
    """Score every row: (doc_id, held_out, score, predicted).

    Inputs are the whole text (words hashed, statistics of its structure) and the recorded length as
    metadata; never labels, language, source or id. The pairwise part takes time linear in a text's
    distinct words. NULL texts count as empty and score by their statistics; a NULL length counts as 0; a
    missing length column as NULL; without a model every score is 0.5. Rows are scored one by one, so equal texts score equally.
    """
    doc_id = field(id_col).cast("long")
    scored = docs.select(doc_id.alias("doc_id"), quality_score(docs, model, text_col, length_col).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_score(docs: DataFrame, model: Model | None, text_col: str = "text", length_col: str = "n_chars") -> Column:
    """The score of :func:`score_quality` as a column of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: _WIDTH x RANK numbers

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hashed, machine = _Buckets(), shared.value
        for texts, lengths in batches:
            scores = [] if machine else [np.full(len(texts), 0.5)]
            for at in range(0, len(texts) if machine else 0, _SCORED_TOGETHER):
                part = zip(texts.iloc[at : at + _SCORED_TOGETHER], lengths.iloc[at : at + _SCORED_TOGETHER], strict=True)
                found = [featurise(t, n, hashed) for t, n in part]
                scores.append(machine.scores(*_joined([f[0] for f in found], [f[1] for f in found])))
            yield pd.Series(np.concatenate(scores))

    return score(*_inputs(docs, text_col, length_col))


def featurise(text: str, length: float, hashed: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one whole text."""
    words = text.split()
    n, chars = len(words), len(text)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    buckets: Counter = Counter()
    for word, times in counts.items():
        buckets[hashed[word]] += times
    ids = np.fromiter(buckets.keys(), np.int32, len(buckets))
    values = np.log1p(np.fromiter(buckets.values(), np.float32, len(buckets)))
    values /= max(1e-6, float(np.sqrt((values**2).sum())))
    marks = _MARKED.findall(text)
    statistics = (
        1.0,
        np.log1p(n) / 10,
        np.log1p(chars) / 12,
        min(chars / max(n, 1) / 20, 2.0),
        len(counts) / max(n, 1),
        max(counts.values(), default=0) / max(n, 1),
        sum(map(str.__eq__, words, words[1:])) / max(n, 1),
        min(1.0, 10 * len(marks) / max(chars, 1)),
        text.count("|") / max(n, 1),
        min(1.0, 10 * sum(map(text.count, "0123456789")) / max(chars, 1)),
        min(1.0, 10 * len(_UPPER.findall(text)) / max(chars, 1)),
        sum(len(w) > 12 for w in counts) / max(len(counts), 1),
        min(2.0, n / max(len(lines), 1) / 50),
        1 - len(set(lines)) / max(len(lines), 1),
        sum(w[-1] in "*#%$&!|" for w in counts) / max(len(counts), 1),
        float(np.log1p(max(0.0, length)) / 12),
    )
    return (
        np.concatenate([ids, np.arange(WORD_BUCKETS, _WIDTH, dtype=np.int32)]),
        np.concatenate([values, np.array(statistics, dtype=np.float32)]),
    )


class _Buckets(dict):
    """Word -> bucket; forgets all words when it has grown to its bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[word] = bucket = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % WORD_BUCKETS
        return bucket


def _inputs(docs: DataFrame, text_col: str, length_col: str) -> tuple[Column, Column]:
    length = field(length_col).cast("double") if length_col in docs.columns else F.lit(None).cast("double")
    return F.coalesce(field(text_col).cast("string"), F.lit("")), F.coalesce(length, F.lit(0.0))


def _joined(ids: list, values: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])[:-1]]).astype(np.int64)
    return np.concatenate(ids), np.concatenate(values), starts


def _pairs(weighted: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = np.add.reduceat(weighted, starts, axis=0)
    return 0.5 * ((total**2).sum(1) - np.add.reduceat((weighted**2).sum(1), starts)), total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _fit(ids: list, values: list, labels: np.ndarray, seed: int) -> Model:
    """Adaptive gradient steps on the log loss, in an order drawn from the seed."""
    rng = np.random.default_rng(seed)
    ids, values = [np.asarray(x) for x in ids], [np.asarray(x, dtype=np.float32) for x in values]
    model = Model(float(np.log(labels.mean() / (1 - labels.mean()))), np.zeros(_WIDTH), rng.normal(0, 0.05, (_WIDTH, RANK)))
    seen = [1e-8, np.full(_WIDTH, 1e-8), np.full((_WIDTH, RANK), 1e-8)]
    for _ in range(_EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), _BATCH):
            rows = order[at : at + _BATCH]
            i, x, starts = _joined([ids[r] for r in rows], [values[r] for r in rows])
            weighted = model.factors[i] * x[:, None]
            pairs, total = _pairs(weighted, starts)
            error = _sigmoid(model.bias + np.add.reduceat(model.linear[i] * x, starts) + pairs) - labels[rows]
            lengths = np.diff(np.append(starts, len(i)))
            each = np.repeat(error, lengths) * x / len(rows)
            touched, inverse = np.unique(i, return_inverse=True)
            linear = np.bincount(inverse, each, len(touched)) + _DECAY * model.linear[touched]
            slopes = each[:, None] * (np.repeat(total, lengths, axis=0) - weighted)
            factors = np.stack([np.bincount(inverse, slopes[:, k], len(touched)) for k in range(RANK)], 1) + _DECAY * model.factors[touched]
            bias = float(error.mean())
            seen[0] += bias**2
            seen[1][touched] += linear**2
            seen[2][touched] += factors**2
            model.bias -= 5 * _RATE * bias / np.sqrt(seen[0])
            model.linear[touched] -= 5 * _RATE * linear / np.sqrt(seen[1][touched])
            model.factors[touched] -= _RATE * factors / np.sqrt(seen[2][touched])
    return model
