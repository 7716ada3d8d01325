"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on words of toxic and one on words of ordinary text, at most a hundred each that a
filter picks: in effect this filter decides. Both stand behind the same base, a dictionary of
common text, so that what either class says alike compresses alike; what is left tells how much shorter a window of a few
words becomes with toxic than with ordinary text at hand. The windows of a text are summed up in a few numbers, and a
logistic curve calibrated on labelled texts turns them into a probability.

The texts for the two dictionaries are the words whose share of documents differs most between the classes. Every
compressed window begins with a passage of the base: zstandard stores short blocks as they are unless it saves a few bytes, and
the passage makes sure that it does, so lengths vary smoothly.

Most of the time goes into compressing. A window that has no :data:`MIN_MATCH` bytes in a row in common with the text of either class
cannot be matched there and gains nothing; it is not compressed (zstandard would still tell one in forty apart, where class text
displaces places of the base in its hash table). A window that a block of texts holds many times (told by 64-bit hashes) is compressed once.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.samples import sample_by_class
from tidemark.session import stage

WINDOW_WORDS, WINDOW_STEP = 3, 1
BASE_BYTES, CLASS_BYTES = 32 << 10, 2 << 10
_ANCHOR = 64
_EDGES = b".,;:!?()\"'"
_EDGE = arrays.byte_class(*((mark, mark) for mark in _EDGES))
_CALL_BYTES, _BLOCK_BYTES = 1 << 20, 2 << 20
#: The shortest match: a word of three letters, the shortest that is learned, between its spaces.
MIN_MATCH = 5


def words_of(text: bytes) -> list[bytes]:
    """All words in order, repeated ones each time: ASCII letters lower-cased, marks at the ends taken off."""
    stripped = (word.strip(_EDGES) for word in text.translate(arrays.ASCII_LOWER).split())
    return [word for word in stripped if word]


def windows_of(words: list[bytes]) -> list[bytes]:
    return [b" " + b" ".join(words[k : k + WINDOW_WORDS]) + b" " for k in range(0, max(1, len(words) - 1), WINDOW_STEP)]


def _word_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of each text (as :func:`words_of` has them) behind one space each, all texts in a row, and a last space.

    Returns these bytes, the place of each space, and each text's number of words. A text without words has one empty word.
    """
    starts, ends = arrays.word_spans(data, offsets, arrays.NOT_SPACE)
    inner = np.flatnonzero(arrays.NOT_SPACE[data] & ~_EDGE[data])
    low, high = np.searchsorted(inner, starts), np.searchsorted(inner, ends)
    some = high > low
    starts, ends = inner[low[some]], inner[high[some] - 1] + 1
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    said = arrays.lower_ascii(data)[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    counts = arrays.per_row(arrays.rows_of(starts, offsets), len(offsets) - 1)
    silent = np.flatnonzero(counts == 0)
    sizes = np.insert(ends - starts, (np.cumsum(counts) - counts)[silent], 0)
    counts[silent] = 1
    spaces = np.concatenate([[0], np.cumsum(sizes + 1)])
    line = np.full(spaces[-1] + 1, 0x20, np.uint8)
    word_bytes = np.ones(len(line), bool)
    word_bytes[spaces] = False
    line[word_bytes] = said
    return line, spaces, counts


def _window_spans(spaces: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the windows of :func:`windows_of` start and end in the line of :func:`_word_lines`, and how many each text has."""
    many = -(-np.maximum(1, counts - 1) // WINDOW_STEP)
    last = np.cumsum(counts)
    row = np.repeat(np.arange(len(counts)), many)
    first = (last - counts)[row] + (np.arange(len(row)) - (np.cumsum(many) - many)[row]) * WINDOW_STEP
    return spaces[first], spaces[np.minimum(first + WINDOW_WORDS, last[row])] + 1, many


def _grams(data: np.ndarray) -> np.ndarray:
    """The next :data:`MIN_MATCH` bytes at each place as one number."""
    out = np.zeros(max(0, len(data) - MIN_MATCH + 1), np.uint64)
    for k in range(MIN_MATCH):
        out <<= np.uint64(8)
        out |= data[k : k + len(out)]
    return out


_SLOT_BITS = 20


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)


def _dictionary(samples: list[bytes], size: int, segment: int) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    samples = [sample for sample in samples if len(sample) >= 8]
    try:
        return zstandard.train_dictionary(size, samples, level=3, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


class _Compressor:
    def __init__(self, content: bytes):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            3, source_size=128, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, min_match=MIN_MATCH, strategy=zstandard.STRATEGY_DFAST,
        )
        known.precompute_compress(compression_params=settings)
        self._compress = zstandard.ZstdCompressor(dict_data=known, compression_params=settings).multi_compress_to_buffer

    def lengths(self, windows: list[bytes]) -> np.ndarray:
        return np.fromiter(map(len, self._compress(windows)), np.float64, len(windows))


@dataclass
class ToxicityModel:
    """The dictionaries' contents and the calibration; ``weights`` is None if there was nothing to learn from."""

    base: bytes
    toxic: bytes
    ordinary: bytes
    center: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _gains_of(self, windows: list[bytes]) -> np.ndarray:
        if not hasattr(self, "_pair"):
            self._pair = _Compressor(self.base + self.toxic).lengths, _Compressor(self.base + self.ordinary).lengths
        toxic, ordinary = self._pair
        return ordinary(windows) - toxic(windows)

    def _shares(self, line: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which windows have :data:`MIN_MATCH` bytes in a row in common with the text of either class: no other can be matched there."""
        if not hasattr(self, "_known"):
            self._known = np.unique(np.concatenate([_grams(np.frombuffer(text, np.uint8)) for text in (self.toxic, self.ordinary)]))
            self._slots = np.zeros(1 << _SLOT_BITS, bool)
            self._slots[_slot(self._known)] = True
        grams = _grams(line)
        places = np.flatnonzero(self._slots[_slot(grams)])
        before = np.zeros(len(line) + 1, np.int32)
        before[places[np.isin(grams[places], self._known)] + 1] = 1
        np.cumsum(before, out=before)
        return before[np.maximum(ends - MIN_MATCH + 1, starts)] > before[starts]

    def _gains(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gains of all windows of a block of texts, and the number of windows of each text."""
        line, spaces, counts = _word_lines(data, offsets)
        starts, ends, many = _window_spans(spaces, counts)
        gains, sharing = np.zeros(len(starts)), np.flatnonzero(self._shares(line, starts, ends))
        if not len(sharing):
            return gains, many
        starts, ends = starts[sharing], ends[sharing]
        _, chosen, place = np.unique(arrays.hash_spans(line, starts, ends), return_index=True, return_inverse=True)
        starts, ends, said, anchor = starts[chosen], ends[chosen], line.tobytes(), self.base[-_ANCHOR:]
        filled = np.cumsum(ends - starts + len(anchor)) // _CALL_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(filled)) + 1).tolist(), len(chosen)]
        spans = [zip(starts[a:b].tolist(), ends[a:b].tolist()) for a, b in zip(cuts, cuts[1:])]
        gains[sharing] = np.concatenate([self._gains_of([anchor + said[a:b] for a, b in span]) for span in spans])[place]
        return gains, many

    def gains(self, text: bytes) -> np.ndarray:
        """By how many bytes each window is shorter with the toxic dictionary."""
        return self._gains(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]

    def features(self, texts: pa.Array) -> np.ndarray:
        """One row of numbers for each text; null texts count as empty."""
        rows = []
        for _, _, data, offsets in arrays.row_blocks(texts, _BLOCK_BYTES):
            gains, many = self._gains(data, offsets)
            rows += map(self._summary, np.split(gains, np.cumsum(many)[:-1]))
        return np.array(rows)

    @staticmethod
    def _summary(gains: np.ndarray) -> list[float]:
        gains = np.sort(gains)[::-1]
        return [gains[0], gains[:3].mean(), (gains >= 4).mean(), (gains >= 6).mean(), np.log1p((gains >= 6).sum()), gains.mean(), math.log(len(gains))]

    def chances(self, features: np.ndarray) -> np.ndarray:
        odds = np.c_[(features - self.center) / self.spread, np.ones(len(features))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def score_batch(self, texts: pa.Array) -> pa.Array:
        if self.weights is None:
            return pa.array([0.0] * len(texts), pa.float64())
        if not len(texts):
            return pa.array([], pa.float64())
        return pa.array(self.chances(self.features(texts)), pa.float64())

    def score(self, docs: DataFrame, text: str = "text") -> Column:
        """Probability (0 to 1) that a text is toxic. Null and empty texts have one empty window; without a trained model all score 0."""
        arrays.bound_batches(docs.sparkSession)
        shared = docs.sparkSession.sparkContext.broadcast(self)

        def of_batch(texts: pa.Array) -> pa.Array:
            return shared.value.score_batch(texts)

        return F.arrow_udf(of_batch, returnType=T.DoubleType())(arrays.utf8(text))


def _z(a, b, m: int, n: int, root=math.sqrt):
    """z value of a word's share of the ``m`` toxic documents (``a``) against that of the ``n`` ordinary ones (``b``); numbers or columns."""
    share = (a + b + 1) / (m + n + 2)
    return (a / m - b / n) / root(share * (1 - share) * (1 / m + 1 / n))


TOXIC_Z, ORDINARY_Z = 6, -2


def _telling(toxic: list[list[bytes]], ordinary: list[list[bytes]], keep: int) -> tuple[set[bytes], set[bytes]]:
    """The words that most set toxic texts apart, and those that most set ordinary ones apart, by the z value of their document shares."""
    a, b = (Counter(word for text in texts for word in set(text) if len(word) >= 3) for texts in (toxic, ordinary))
    ranked = sorted(((_z(a[word], b[word], len(toxic), len(ordinary)), word) for word in a.keys() | b.keys()), reverse=True)
    return {word for value, word in ranked[:keep] if value >= TOXIC_Z}, {word for value, word in ranked[-keep:] if value <= ORDINARY_Z}


def _telling_of(rows: DataFrame, m: int, n: int, keep: int) -> tuple[set[bytes], set[bytes]]:
    """:func:`_telling` of the whole texts of ``rows``, counted in Spark."""

    def of_batch(texts: pa.Array) -> pa.Array:
        return pa.array([[word for word in dict.fromkeys(words_of(x.as_py())) if len(word) >= 3] for x in texts], pa.list_(pa.binary()))

    words = rows.select("label", F.explode(F.arrow_udf(of_batch, returnType=T.ArrayType(T.BinaryType()))("text")).alias("word"))
    counts = words.groupBy("word").agg(F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b"))
    valued = counts.select("word", _z(F.col("a"), F.col("b"), m, n, F.sqrt).alias("z"))
    high = valued.where(F.col("z") >= TOXIC_Z).orderBy(F.desc("z"), F.desc("word")).limit(keep).collect()
    low = valued.where(F.col("z") <= ORDINARY_Z).orderBy("z", "word").limit(keep).collect()
    return {bytes(row["word"]) for row in high}, {bytes(row["word"]) for row in low}


PASSAGES, PASSAGE_WORDS = 16, 32


def _material(words: list[bytes], mark: set[bytes]) -> tuple[bytes, list[bytes]]:
    """A text's telling words, and at most :data:`PASSAGES` passages from all over it."""
    starts = range(0, len(words), PASSAGE_WORDS)
    chosen = sorted({starts[k * len(starts) // PASSAGES] for k in range(PASSAGES)}) if starts else []
    common = [b" " + b" ".join(words[k : k + PASSAGE_WORDS]) + b" " for k in chosen]
    return b" " + b" ".join(word for word in dict.fromkeys(words) if word in mark) + b" ", common


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 300, ridge: float = 1e-2) -> np.ndarray:
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        weights = weights - 0.5 * np.linalg.solve(curve, x.T @ (p - y) + ridge * weights)
    return weights


def _dictionaries(toxic: list[bytes], ordinary: list[bytes], common: list[bytes]) -> ToxicityModel:
    plain = ordinary if sum(len(x) > 9 for x in ordinary) > 50 else common
    model = ToxicityModel(_dictionary(common, BASE_BYTES, 64), _dictionary(toxic, CLASS_BYTES, 32), _dictionary(plain, CLASS_BYTES, 32))
    size = max(len(model.toxic), len(model.ordinary))  # equal lengths: offsets into the base cost the same
    model.toxic, model.ordinary = model.toxic.rjust(size, b"\0"), model.ordinary.rjust(size, b"\0")
    return model


def _calibrate(model: ToxicityModel, features: np.ndarray, labels: np.ndarray, toxic_share: float) -> ToxicityModel:
    model.center, model.spread = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.c_[(features - model.center) / model.spread, np.ones(len(features))]
    model.weights = _logistic(x, labels)
    share = labels.mean()
    model.weights[-1] += math.log(toxic_share / (1 - toxic_share)) - math.log(share / (1 - share))
    return model


def fit(toxic: list[bytes], ordinary: list[bytes], toxic_share: float, keep: int = 100) -> ToxicityModel:
    """Train dictionaries and calibration. ``toxic_share`` is the share of toxic texts among all labelled ones."""
    if not toxic or not ordinary:
        return ToxicityModel(b"", b"", b"")
    said = [[words_of(text) for text in texts] for texts in (toxic, ordinary)]
    bad, plain = ([_material(words, mark) for words in texts] for texts, mark in zip(said, _telling(*said, keep)))
    model = _dictionaries([x for x, _ in bad], [x for x, _ in plain], [passage for _, passages in plain for passage in passages])
    features = model.features(pa.array(toxic + ordinary, pa.binary()))
    return _calibrate(model, features, np.r_[np.ones(len(toxic)), np.zeros(len(ordinary))], toxic_share)


def label_share(counts: dict[int, int]) -> float:
    """Share of toxic labels as counted, with one more of either class."""
    return (counts.get(1, 0) + 1) / (counts.get(0, 0) + counts.get(1, 0) + 2)


def train_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic", per_class: int = 2000, ordinary_per_toxic: int = 2, keep: int = 100) -> ToxicityModel:
    """Learn from at most ``per_class`` toxic and ``ordinary_per_toxic`` times as many ordinary labelled documents, of each the whole text.

    Words are counted and features computed in Spark tasks; the driver gets a text's telling words, a few passages and its features.
    Labels other than 0 and 1, labels of no document and documents without a label are not learned from; a document with both labels is toxic.
    If either class is empty, the model scores 0.
    """
    spark = docs.sparkSession
    arrays.bound_batches(spark)
    known = labels.select(F.col(doc_id).alias("id"), F.col(toxic).alias("label")).where("label in (0, 1)")
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    counts = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = sample_by_class(known.where("label = 1"), per_class).union(sample_by_class(known.where("label = 0"), per_class * ordinary_per_toxic))
    rows = docs.select(F.col(doc_id).alias("id"), arrays.utf8(text).alias("text")).where("length(text) > 0")
    picked = stage(rows.join(F.broadcast(chosen), "id").dropDuplicates(["id"]), "labelled")
    found = {row["label"]: row["n"] for row in picked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    m, n = found.get(1, 0), found.get(0, 0)
    if not m or not n:
        return ToxicityModel(b"", b"", b"")
    marks = spark.sparkContext.broadcast(_telling_of(picked, m, n, keep))
    kind = T.StructType([T.StructField("telling", T.BinaryType()), T.StructField("common", T.ArrayType(T.BinaryType()))])

    def material(texts: pa.Array, label: pa.Array) -> pa.Array:
        bad, plain = marks.value
        made = [_material(words_of(x.as_py()), bad if y.as_py() == 1 else plain) for x, y in zip(texts, label)]
        return pa.StructArray.from_arrays([pa.array([x for x, _ in made], pa.binary()), pa.array([x for _, x in made], pa.list_(pa.binary()))], ["telling", "common"])

    order = F.xxhash64("id"), F.col("id")
    parts = picked.select("id", "label", F.arrow_udf(material, returnType=kind)("text", F.col("label").cast("long")).alias("m"))
    parts = parts.select("id", "label", "m.telling", F.when(F.col("label") == 0, F.col("m.common")).alias("common")).orderBy(*order).collect()
    telling = [[bytes(row["telling"]) for row in parts if row["label"] == label] for label in (1, 0)]
    model = _dictionaries(*telling, [bytes(x) for row in parts if row["label"] == 0 for x in row["common"]])
    shared = spark.sparkContext.broadcast(model)

    def features(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.features(texts).tolist(), pa.list_(pa.float64()))

    measured = picked.select("id", "label", F.arrow_udf(features, returnType=T.ArrayType(T.DoubleType()))("text").alias("f")).orderBy(*order).collect()
    return _calibrate(model, np.array([row["f"] for row in measured]), np.array([float(row["label"]) for row in measured]), label_share(counts))
