"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

A document becomes a vector of statistics of its whole text (sizes, shares of
kinds of characters and words, repetition). Cosines of random projections of it
approximate a Gaussian kernel. A ridge regression is fitted by normal equations
that every partition sums for its rows, so the driver adds a few small matrices.
Its values are calibrated by isotonic regression on rows that the regression
has not seen.

The model is fitted on at most ``train_docs`` labelled documents, the first ones
by hash; all documents are scored. Labels, language, source and id are no inputs.

Defined cases: NULL and empty texts have statistics of their own (no words) and
are scored; a NULL id is never held out; several labels of a document count by
their mean; NULL labels are left out; without any label all scores are 0.5; an
empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Workspace, crc_bucket, unit_hash
from .textscan import by_bytes, spans, word_hashes

#: Kinds of bytes: lower, upper, digit, punctuation, line feed, other white space, beyond ASCII, control.
_KIND = np.full(256, 7, dtype=np.int64)
_KIND[ord("a"):ord("z") + 1] = 0
_KIND[ord("A"):ord("Z") + 1] = 1
_KIND[ord("0"):ord("9") + 1] = 2
for _c in range(0x21, 0x7F):
    if not chr(_c).isalnum():
        _KIND[_c] = 3
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 5
_KIND[0x0A] = 4
_KIND[0x80:] = 6

STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "punctuation", "non_ascii", "spaces", "controls", "distinct_words",
    "top_word", "repeated_neighbours", "distinct_pairs", "words_with_sign", "words_in_upper", "log_line_words", "distinct_lines",
    "short_lines",
)


def statistics_of(texts: list[str | None]) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    hashes, counts = word_hashes(texts)
    out = np.zeros((len(texts), len(STATISTICS)))
    at = 0
    for i, (text, n) in enumerate(zip(texts, counts)):
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        own, at = hashes[at:at + n], at + n
        kinds = np.bincount(_KIND[data], minlength=8)
        size, letters = max(len(data), 1), max(int(kinds[0] + kinds[1] + kinds[6]), 1)
        row = [np.log1p(len(data)), np.log1p(n), 0.0, kinds[1] / letters, kinds[2] / size, kinds[3] / size, kinds[6] / size,
               (kinds[4] + kinds[5]) / size, kinds[7] / size]
        if n:
            start, end = spans(data)
            length = end - start
            row[2] = length.mean()
            _, repeats = np.unique(own, return_counts=True)
            pairs = own[:-1] * np.uint64(3) + own[1:]
            kind = _KIND[data]
            signs = np.concatenate(([0], np.cumsum(kind == 3)))
            uppers = np.concatenate(([0], np.cumsum(kind == 1)))
            lines = (text or "").split("\n")
            row += [len(repeats) / n, repeats.max() / n, (own[1:] == own[:-1]).mean() if n > 1 else 0.0,
                    len(np.unique(pairs)) / len(pairs) if n > 1 else 1.0, (signs[end] > signs[start]).mean(),
                    ((uppers[end] - uppers[start]) * 2 > length).mean(), np.log1p(n / len(lines)), len(set(lines)) / len(lines),
                    sum(len(x) < 20 for x in lines) / len(lines)]
        out[i, :len(row)] = row
    return out


def isotonic(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and levels of the steps of the non-decreasing fit, by pooling neighbours that fall."""
    order = np.argsort(values, kind="stable")
    blocks: list[list[float]] = []
    for x, y in zip(values[order], labels[order]):
        blocks.append([x, y, 1.0])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            x1, y1, n1 = blocks.pop()
            x0, y0, n0 = blocks.pop()
            n = n0 + n1
            blocks.append([(x0 * n0 + x1 * n1) / n, (y0 * n0 + y1 * n1) / n, n])
    return np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])


class QualityModel:
    """Scores of rows of statistics."""

    def __init__(self, mean, spread, features: int, length_scale: float, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.mean, self.spread = mean, spread
        self.lines = draw.standard_normal((len(mean), features)) / length_scale
        self.phases = draw.uniform(0, 2 * np.pi, features)
        self.weights, self.steps, self.levels = np.zeros(features + 1), np.array([0.0]), np.array([0.5])

    def mapped(self, statistics: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        scaled = np.clip((statistics - self.mean) / self.spread, -5, 5)
        waves = np.cos(scaled @ self.lines + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(waves), 1))])

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return self.mapped(statistics) @ self.weights

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        """Calibrated; a fiftieth of the raw value keeps the order within a step."""
        raw = self.raw(statistics)
        return np.clip(0.98 * np.interp(raw, self.steps, self.levels) + 0.02 * np.clip(raw, 0, 1), 0, 1)


def _statistics_column(text: str) -> Column:
    @F.pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = texts.tolist()
            rows = [row for some in by_bytes(texts) for row in statistics_of(texts[some])]
            yield pd.Series(rows, dtype=object)

    return measure(text)


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, train_docs: int) -> DataFrame:
    """Statistics of at most ``train_docs`` labelled documents; only their ids are broadcast, the bound is the parameter."""
    rated = labels.where(train & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.avg("quality").alias("quality"))
    some = rated.orderBy(unit_hash(F.col("doc_id"), F.lit("quality")), "doc_id").limit(train_docs).select(
        F.col("doc_id").alias("__id"), F.col("quality").alias("__label"))
    return docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("__id")).select(
        F.col("__label").alias("label"), _statistics_column("text").alias("statistics"),
        unit_hash(F.col("doc_id"), F.lit("fold")).alias("fold"))


def train_quality_model(docs: DataFrame, labels: DataFrame, train: Column, train_docs: int = 6000, features: int = 256,
                        length_scale: float = 4.0, ridge: float = 1e-4, calibration: float = 0.3, partitions: int = 8) -> QualityModel | None:
    """Learns from the labels for which ``train`` over ``doc_id`` holds; None without any."""
    work = Workspace(docs.sparkSession, "quality")
    rows = work.table("sample", labelled_sample(docs, labels, train, train_docs).repartition(partitions, "fold"))
    moments = rows.select(F.posexplode("statistics"), "fold").groupBy("pos").agg(F.avg("col"), F.stddev_pop("col")).orderBy("pos").collect()
    if not moments:
        return None
    model = QualityModel(np.array([r[1] for r in moments]), np.array([max(r[2], 1e-6) for r in moments]), features, length_scale)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Normal equations of the partition's rows."""
        left, right, n = np.zeros((features + 1, features + 1)), np.zeros(features + 1), 0
        for batch in batches:
            if len(batch):
                z = model.mapped(np.array(batch["statistics"].tolist()))
                left, right, n = left + z.T @ z, right + z.T @ batch["label"].to_numpy(), n + len(batch)
        yield pd.DataFrame({"left": [left.tobytes()], "right": [right.tobytes()], "n": [n]})

    fitted = F.col("fold") >= calibration
    parts = rows.where(fitted).coalesce(partitions).mapInPandas(sums, "left binary, right binary, n long").collect()
    left = sum(np.frombuffer(p[0]) for p in parts).reshape(features + 1, features + 1)
    right, n = sum(np.frombuffer(p[1]) for p in parts), sum(p[2] for p in parts)
    model.weights = np.linalg.solve(left + ridge * max(n, 1) * np.eye(features + 1), right)
    held = rows.where(~fitted).select("label", "statistics").collect() or rows.select("label", "statistics").collect()
    raw = model.raw(np.array([r[1] for r in held]))
    model.steps, model.levels = isotonic(raw, np.array([r[0] for r in held]))
    return model


def with_quality(docs: DataFrame, model: QualityModel | None, score: str = "score") -> DataFrame:
    """Adds the score to all rows."""
    if model is None:
        return docs.withColumn(score, F.lit(0.5))

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = texts.tolist()
            yield pd.Series(np.concatenate([np.zeros(0), *[model.scores(statistics_of(texts[some])) for some in by_bytes(texts)]]))

    return docs.withColumn(score, rate("text"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    held = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False))
    model = train_quality_model(docs, labels, ~held)
    rated = with_quality(docs.select("doc_id", "text"), model)
    return rated.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
