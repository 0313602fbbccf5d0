"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in windows, forwards and backwards,
labels every byte position with a distribution over the languages, and the
distributions of all positions are averaged into the document's. It is trained
here in numpy by backpropagation through time, on windows of a bounded sample
of labelled documents (``docs_per_language`` distinct texts by hash,
``windows_per_doc`` each), and is a few kilobytes large. Texts are scored whole.

Defined cases: a NULL text and a text without a letter get ``und`` and the score
0, and so does everything when no row is labelled; a NULL id is never held out;
ties go to the first language by code point; repeated rows count once in
training and are all scored; an empty table gives no rows; further columns are
kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .shared import crc_bucket, free_names, unit_hash
from .textscan import by_bytes

UNDETERMINED = "und"
PAD = 0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


class BiGru:
    """Arrays are features x windows; the last axis is the batch, so every operation runs over long rows."""

    def __init__(self, classes: int, hidden: int, seed: int = 1):
        draw = np.random.default_rng(seed)
        scale = lambda *shape, by: (draw.standard_normal(shape) * by).astype(np.float32)
        self.hidden, self.classes = hidden, classes
        self.weights = {}
        for d in "fb":
            self.weights[f"in_{d}"] = scale(3 * hidden, 256, by=0.3)
            self.weights[f"rec_{d}"] = scale(3 * hidden, hidden, by=hidden ** -0.5)
        self.weights["out"] = scale(classes, 2 * hidden, by=(2 * hidden) ** -0.5)
        self.weights["bias"] = np.zeros((classes, 1), dtype=np.float32)

    def _step(self, d: str, byte: np.ndarray, state: np.ndarray):
        h = self.hidden
        gates = np.take(self.weights[f"in_{d}"], byte, axis=1)
        back = self.weights[f"rec_{d}"] @ state
        gates[:2 * h] += back[:2 * h]
        _sigmoid(gates[:2 * h])
        z, r, c = gates[:h], gates[h:2 * h], gates[2 * h:]
        c += r * back[2 * h:]
        np.tanh(c, out=c)
        new = c - state
        new *= z
        new += state
        return new, z, r, c, back[2 * h:]

    def states(self, windows: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States of one direction after each position: positions x hidden x windows."""
        length, n = windows.shape
        out = np.empty((length, self.hidden, n), dtype=np.float32)
        state = np.zeros((self.hidden, n), dtype=np.float32)
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            before = state
            state, z, r, c, back = self._step(d, windows[t], state)
            out[t] = state
            if keep is not None:
                keep.append((t, before, z, r, c, back))
        return out

    def probabilities(self, windows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Positions x classes x windows."""
        f, b = (self.states(windows, d, None if keep is None else keep.setdefault(d, [])) for d in "fb")
        h = self.hidden
        logits = np.matmul(self.weights["out"][:, :h], f)
        logits += np.matmul(self.weights["out"][:, h:], b)
        logits += self.weights["bias"]
        if keep is not None:
            keep["states"] = np.concatenate((f, b), axis=1)
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, windows: np.ndarray, labels: np.ndarray, real: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over the real positions, by backpropagation through time."""
        keep: dict = {}
        error = self.probabilities(windows, keep)
        error[:, labels, np.arange(len(labels))] -= 1.0
        error *= (real / max(1, real.sum()))[:, None, :].astype(np.float32)
        h, grads = self.hidden, {k: np.zeros_like(v) for k, v in self.weights.items()}
        grads["out"] = np.einsum("tcn,thn->ch", error, keep["states"])
        grads["bias"] = error.sum(axis=(0, 2))[:, None]
        into = np.einsum("ch,tcn->thn", self.weights["out"], error)
        for d, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            flow = np.zeros((h, windows.shape[1]), dtype=np.float32)
            for t, before, z, r, c, back in reversed(keep[d]):
                flow = flow + into[t, part]
                dc = flow * z * (1 - c * c)
                dz = flow * (c - before) * z * (1 - z)
                dr = dc * back * r * (1 - r)
                at_input = np.concatenate((dz, dr, dc))
                at_back = np.concatenate((dz, dr, dc * r))
                grads[f"rec_{d}"] += at_back @ before.T
                for row, values in enumerate(at_input):
                    grads[f"in_{d}"][row] += np.bincount(windows[t], weights=values, minlength=256).astype(np.float32)
                flow = flow * (1 - z) + self.weights[f"rec_{d}"].T @ at_back
        return grads

    def fit(self, windows: np.ndarray, labels: np.ndarray, real: np.ndarray, epochs: int, batch: int, rate: float, seed: int = 2) -> None:
        """Adam over shuffled batches."""
        draw, step = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for epoch in range(epochs):
            order = draw.permutation(len(labels))
            for at in range(0, len(order), batch):
                some, step = order[at:at + batch], step + 1
                for k, g in self.gradients(windows[:, some], labels[some], real[:, some]).items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    pace = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
                    self.weights[k] -= (pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)


def cut_windows(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts: ``positions x windows`` bytes, the bytes that are real in each, and the text of each."""
    counts = np.array([-(-len(t) // length) for t in texts], dtype=np.int64)
    out = np.full(int(counts.sum()) * length, PAD, dtype=np.uint8)
    at = 0
    for text, n in zip(texts, counts):
        out[at:at + len(text)] = np.frombuffer(text, dtype=np.uint8)
        at += n * length
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    real = np.minimum(np.array([len(t) for t in texts], dtype=np.int64)[owner] - place * length, length)
    return np.ascontiguousarray(out.reshape(-1, length).T), real, owner


class LanguageModel:
    def __init__(self, languages: list[str], network: BiGru | None, window: int):
        self.languages, self.network, self.window = languages, network, window

    def scores(self, texts: list[bytes], lot: int = 1024) -> np.ndarray:
        """Texts x languages: the mean of all positions' distributions."""
        total = np.zeros((len(texts), len(self.languages)))
        windows, real, owner = cut_windows(texts, self.window)
        for at in range(0, len(owner), lot):
            some = slice(at, at + lot)
            p = self.network.probabilities(windows[:, some])
            short = np.arange(self.window)[:, None] >= real[some]
            if short.any():
                p *= ~short[:, None, :]
            sums = p.sum(axis=0)
            for c in range(len(self.languages)):
                total[:, c] += np.bincount(owner[some], weights=sums[c], minlength=len(texts))
        return total / np.maximum([[len(t)] for t in texts], 1) if len(texts) else total


def _sample(docs: DataFrame, train: Column, per_language: int, windows_per_doc: int, window: int) -> list[tuple[str, bytes]]:
    """Windows of at most ``per_language`` distinct texts of each language, the first by hash. The driver gets one row per window.

    Equal rows are one text, so they neither crowd out others nor are left out together: every language has a text.
    """
    labelled = docs.where(train & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("key"))
    first = Window.partitionBy("lang").orderBy(unit_hash(F.col("key"), F.lit("language")), "key")
    texts = labelled.select("lang", "key").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)
    texts = broadcast_if_small(texts.select(F.col("lang").alias("_lang"), F.col("key").alias("_key")))
    chosen = labelled.join(texts, (F.col("lang") == F.col("_lang")) & (F.col("key") == F.col("_key")), "left_semi")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for lang, key, text in zip(batch["lang"], batch["key"], batch["text"]):
                data = text.encode("utf-8", "surrogatepass")
                starts = np.linspace(0, max(0, len(data) - window), windows_per_doc).astype(int)
                rows += [(lang, key, s, data[s:s + window]) for s in np.unique(starts)]
            yield pd.DataFrame(rows, columns=["lang", "key", "start", "window"])

    windows = chosen.select("lang", "key", "text").mapInPandas(cut, "lang string, key long, start long, window binary")
    once = windows.dropDuplicates(["lang", "key", "start"])
    return sorted((r[0], bytes(r[1])) for r in once.select("lang", "window").collect())


def train_language_model(docs: DataFrame, train: Column, docs_per_language: int = 300, windows_per_doc: int = 6, window: int = 96,
                         hidden: int = 8, epochs: int = 12) -> LanguageModel:
    """Learns from the documents for which ``train`` holds and whose ``lang`` is known."""
    sample = _sample(docs, train, docs_per_language, windows_per_doc, window)
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return LanguageModel([], None, window)
    network = BiGru(len(languages), hidden)
    windows, real, _ = cut_windows([data for _, data in sample], window)
    labels = np.array([languages.index(lang) for lang, _ in sample])
    network.fit(windows, labels, np.arange(window)[:, None] < real, epochs, batch=256, rate=0.02)
    return LanguageModel(languages, network, window)


def with_language(docs: DataFrame, model: LanguageModel, prediction: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the predicted language and its pooled probability to all rows."""

    @F.pandas_udf("lang string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            parts = [np.zeros((0, len(model.languages)))]
            for some in by_bytes(data, 4 << 20):
                parts.append(model.scores(data[some]))
            scores = np.concatenate(parts)
            best = scores.argmax(axis=1)
            yield pd.DataFrame({"lang": np.array(model.languages, dtype=object)[best], "score": scores[np.arange(len(best)), best].clip(0, 1)})

    readable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not model.languages:
        return docs.withColumns({prediction: F.lit(UNDETERMINED), score: F.lit(0.0)})
    [found] = free_names(docs, "_label")
    return docs.withColumn(found, label("text")).withColumns({
        prediction: F.when(readable, F.col(f"{found}.lang")).otherwise(UNDETERMINED),
        score: F.when(readable, F.col(f"{found}.score")).otherwise(0.0)}).drop(found)


def held_out(modulus: int, remainder: int) -> Column:
    return F.coalesce(crc_bucket("doc_id", modulus) == remainder, F.lit(False))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = held_out(4, 2)
    model = train_language_model(docs, ~out)
    return with_language(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")
