"""Language identification by a byte convolutional network.

Texts are cut into windows of fixed length over all their bytes. Filters of several widths slide over embedded bytes, the
greatest response of each filter goes into a softmax over the languages, and the windows of a text are averaged. The network is
trained in numpy on a bounded sample of labelled rows; Arrow batches of texts are classified window batch by window batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.samples import sample_by_class

WINDOW = 256
UNKNOWN = "und"
_BATCH = 64
_ROWS_BYTES = 1 << 20
_ASCII_LETTERS = arrays.byte_class((65, 90), (97, 122))


def windows_of(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """All bytes of one text as rows of ``window`` bytes; the last row ends with the text, a short text is padded with zeros."""
    if len(data) <= window:
        out = np.zeros((1, window), np.uint8)
        out[0, : len(data)] = data
        return out
    whole = len(data) // window
    rows = data[: whole * window].reshape(whole, window)
    return rows if whole * window == len(data) else np.concatenate((rows, data[None, -window:]))


@dataclass
class Network:
    """``filters[w]``: (width, embedding, filters); ``out``: (all filters, languages)."""

    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def initial(languages: int, widths: tuple[int, ...], filters: int, size: int, seed: int) -> Network:
        draw = np.random.default_rng(seed)
        kernels = [draw.normal(0, (w * size) ** -0.5, (w, size, filters)).astype(np.float32) for w in widths]
        total = filters * len(widths)
        return Network(draw.normal(0, 1, (256, size)).astype(np.float32), kernels, np.zeros(total, np.float32), np.zeros((total, languages), np.float32), np.zeros(languages, np.float32))

    def tables(self) -> list[np.ndarray]:
        """For each filter group, the responses to every byte at every place of the filter."""
        return [np.matmul(self.embed[None], kernel) for kernel in self.filters]

    def pooled(self, rows: np.ndarray, tables: list[np.ndarray], places: bool = False):
        """Greatest response of each filter in each row and, if asked for, where it is."""
        best, at = [], []
        for table in tables:
            width = len(table)
            length = rows.shape[1] - width + 1
            total = np.take(table[0], rows[:, :length], axis=0)
            for k in range(1, width):
                total += np.take(table[k], rows[:, k : k + length], axis=0)
            if places:
                where = total.argmax(axis=1)
                at.append(where)
                best.append(np.take_along_axis(total, where[:, None], axis=1)[:, 0])
            else:
                best.append(total.max(axis=1))
        return np.concatenate(best, axis=1), at

    def chances(self, rows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Logarithms of the languages' probabilities for each row."""
        hidden = np.maximum(self.pooled(rows, tables)[0] + self.bias, 0)
        score = hidden @ self.out + self.out_bias
        score -= score.max(axis=1, keepdims=True)
        return score - np.log(np.exp(score).sum(axis=1, keepdims=True))


def train_network(rows: np.ndarray, labels: np.ndarray, languages: int, widths=(2, 3, 4), filters: int = 16, size: int = 6, epochs: int = 4, rate: float = 0.01, seed: int = 7) -> Network:
    """Fit by Adam on mini-batches. Only the place of each filter's greatest response passes gradients on."""
    net = Network.initial(languages, widths, filters, size, seed)
    parameters = [net.embed, *net.filters, net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    draw, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for begin in range(0, len(order), _BATCH):
            chosen = order[begin : begin + _BATCH]
            x, y = rows[chosen], labels[chosen]
            tables = net.tables()
            pooled, at = net.pooled(x, tables, places=True)
            hidden = np.maximum(pooled + net.bias, 0)
            score = hidden @ net.out + net.out_bias
            score = np.exp(score - score.max(axis=1, keepdims=True))
            error = score / score.sum(axis=1, keepdims=True)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            back = (error @ net.out.T) * (hidden > 0)
            d_embed, d_filters = np.zeros_like(net.embed), []
            for g, (kernel, where) in enumerate(zip(net.filters, at)):
                part = back[:, g * filters : (g + 1) * filters]
                d_kernel = np.zeros_like(kernel)
                for k in range(len(kernel)):
                    d_table = np.zeros((256, filters), np.float32)
                    seen = np.take_along_axis(x, where + k, axis=1)
                    np.add.at(d_table, (seen, np.arange(filters)[None]), part)
                    d_embed += d_table @ kernel[k].T
                    d_kernel[k] = net.embed.T @ d_table
                d_filters.append(d_kernel)
            gradients = [d_embed, *d_filters, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(parameters, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _has_letter(text: np.ndarray) -> bool:
    if _ASCII_LETTERS[text].any():
        return True
    return (text >= 128).any() and any(c.isalpha() for c in text.tobytes().decode("utf-8", "replace"))


PREDICTED = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


@dataclass
class LanguageModel:
    """A trained network and the languages it tells apart."""

    languages: list[str]
    network: Network | None

    def classify(self, column: pa.Array) -> pa.Array:
        names, scores = [], []
        tables = self.network.tables() if self.network else []
        for first, last, data, offsets in arrays.row_blocks(column, _ROWS_BYTES):
            texts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
            lettered = [k for k, text in enumerate(texts) if self.network and _has_letter(text)]
            cut = [windows_of(texts[k]) for k in lettered]
            sums = self._sums(cut, tables) if cut else None
            found = {k: sums[j] for j, k in enumerate(lettered)}
            for k in range(last - first):
                if k in found:
                    chance = np.exp(found[k] - found[k].max())
                    best = int(chance.argmax())
                    names.append(self.languages[best])
                    scores.append(float(chance[best] / chance.sum()))
                else:
                    names.append(UNKNOWN)
                    scores.append(0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], PREDICTED.names)

    def _sums(self, cut: list[np.ndarray], tables: list[np.ndarray]) -> np.ndarray:
        """Mean log probabilities of each text's windows."""
        rows = np.concatenate(cut)
        logs = np.concatenate([self.network.chances(rows[k : k + _BATCH], tables) for k in range(0, len(rows), _BATCH)])
        counts = np.array([len(x) for x in cut])
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        return np.add.reduceat(logs.astype(np.float64), starts, axis=0) / counts[:, None]

    def predict(self, docs: DataFrame, text: str = "text") -> Column:
        """Struct of ``lang`` and ``score`` for a text column of ``docs``.

        A null text, one without a letter, and every text if no language was learned, is ``und`` with score 0.
        """
        arrays.bound_batches(docs.sparkSession)
        shared = docs.sparkSession.sparkContext.broadcast(self)

        def of_batch(texts: pa.Array) -> pa.Array:
            return shared.value.classify(texts)

        return F.arrow_udf(of_batch, returnType=PREDICTED)(arrays.utf8(text))


def _spread(text: bytes, count: int) -> list[bytes]:
    """At most ``count`` windows, evenly over the text."""
    rows = windows_of(np.frombuffer(text, np.uint8))
    return [rows[k].tobytes() for k in np.unique(np.linspace(0, len(rows) - 1, count).astype(int))]


def train_language_model(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int = 400, windows_per_text: int = 4) -> LanguageModel:
    """Learn from at most ``per_language`` rows of each language and ``windows_per_text`` windows of each row.

    Rows without a text, an id or a language are not learned from. Without rows no language is known.
    """
    rows = labelled.select(F.col(doc_id).alias("id"), F.col(lang).alias("label"), arrays.utf8(text).alias("text")).where("length(text) > 0")
    chosen = sample_by_class(rows.select("id", "label"), per_language)

    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([_spread(x.as_py(), windows_per_text) for x in texts], pa.list_(pa.binary()))

    cutter = F.arrow_udf(cut, returnType=T.ArrayType(T.BinaryType()))
    picked = rows.select("id", "text").join(F.broadcast(chosen), "id").select("id", "label", cutter("text").alias("windows"))
    picked = picked.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").collect()
    languages = sorted({row["label"] for row in picked})
    if not languages:
        return LanguageModel([], None)
    data = np.array([np.frombuffer(w, np.uint8) for row in picked for w in row["windows"]])
    labels = np.array([languages.index(row["label"]) for row in picked for _ in row["windows"]])
    return LanguageModel(languages, train_network(data, labels, len(languages)))
