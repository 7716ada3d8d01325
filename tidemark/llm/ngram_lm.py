"""Interpolated modified Kneser-Ney bigram model, counted in Spark and read as memory-mapped sorted arrays.

Training is two jobs over the texts. Tasks count words, then pairs of neighbouring words, as numpy arrays and hand them over
as packed rows, one per range of hashes; groups of these rows are merged, sorted and written as raw arrays below
``spark.checkpoint.dir``:

- ``words``: by range of the word hash: hash, count, distinct words before it, and how many words follow it once, twice, more often;
- ``pairs``: by range of the pair hash: hash and count.

The number of ranges follows the size of the corpus, so each group stays small; hashes spread evenly, and a frequent word or
pair is one entry per task. Workers map the files and look batches of sorted hashes up in them. The folder must be mounted on
all executors under one path (``file:``); anything else is refused, because it cannot be mapped.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.session import scratch_path

_END = np.uint64(0x5DEECE66D1234567)
_ROWS_BYTES = 4 << 20
_FLUSH = 2_000_000
WORD_RANGE_BYTES, PAIR_RANGE_BYTES = 256 << 20, 32 << 20
_WORD_PARTS = {"hash": np.uint64, "count": np.uint64, "before": np.uint64, "once": np.uint64, "twice": np.uint64, "more": np.uint64}


def _shared_folder(uri: str) -> str:
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    if ":" in uri.split("/")[0]:
        raise ValueError(f"{uri} cannot be memory-mapped: spark.checkpoint.dir must be a mounted folder (file:)")
    return uri


def _write(folder: str, name: str, values: np.ndarray) -> None:
    """Whole file or none: a task that is run again replaces it by the same."""
    path = f"{folder}/{name}"
    values.tofile(partial := f"{path}.{uuid.uuid4().hex}")
    os.replace(partial, path)


def _ranges(size: int, each: int) -> int:
    """A power of two."""
    return 1 << max(0, (max(1, size) - 1) // each).bit_length()


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - ranges.bit_length() + 1)).astype(np.int64) if ranges > 1 else np.zeros(len(hashes), np.int64)


def _sum_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the rows, each followed by the end token, and where the rows end."""
    data = arrays.lower_ascii(data)
    starts, ends = arrays.word_spans(data, offsets, arrays.NOT_SPACE)
    rows = arrays.rows_of(starts, offsets)
    count = len(offsets) - 1
    last = np.cumsum(np.bincount(rows, minlength=count)) + np.arange(count)
    out = np.full(len(starts) + count, _END, np.uint64)
    out[np.arange(len(starts)) + rows] = arrays.hash_spans(data, starts, ends)
    return out, last


def _split(order_by: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """Runs of equal range in a sorted array of range numbers."""
    bounds = np.searchsorted(order_by, np.arange(ranges + 1))
    for k in range(ranges):
        if bounds[k] < bounds[k + 1]:
            yield k, slice(bounds[k], bounds[k + 1])


def _binary(names: list[str], number: str = "part") -> T.StructType:
    return T.StructType([T.StructField(number, T.LongType()), *[T.StructField(name, T.BinaryType()) for name in names]])


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int64()), *[(name, pa.binary()) for name in names]]))


def _joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), dtype)


@dataclass
class Words:
    """The word files of a model, mapped. ``base[k]`` is the number of the first word of range ``k``."""

    folder: str
    base: np.ndarray

    def __post_init__(self):
        self._maps: dict[tuple[int, str], np.ndarray] = {}

    def part(self, k: int, name: str) -> np.ndarray:
        if (k, name) not in self._maps:
            empty = self.base[k] == self.base[k + 1]
            self._maps[k, name] = np.empty(0, _WORD_PARTS[name]) if empty else np.memmap(f"{self.folder}/words-{k}.{name}", _WORD_PARTS[name], "r")
        return self._maps[k, name]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each of the sorted ``hashes``, -1 if unknown."""
        ranges = len(self.base) - 1
        out = np.full(len(hashes), -1, np.int64)
        for k, run in _split(_range_of(hashes, ranges), ranges):
            known = self.part(k, "hash")
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes[run]), len(known) - 1)
                out[run] = np.where(known[at] == hashes[run], at + self.base[k], -1)
        return out

    def get(self, numbers: np.ndarray, name: str) -> np.ndarray:
        """Values by sorted word number; 0 for -1."""
        out = np.zeros(len(numbers), np.float64)
        bounds = np.searchsorted(numbers, self.base)
        for k in range(len(self.base) - 1):
            if bounds[k] < bounds[k + 1]:
                run = slice(bounds[k], bounds[k + 1])
                out[run] = self.part(k, name)[numbers[run] - self.base[k]]
        return out


def _numbered(words: Words, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct word numbers of the tokens and, for each token, its place among them."""
    hashes, place = np.unique(tokens, return_inverse=True)
    return words.numbers(hashes), place


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return arrays.mix(arrays.mix(left.astype(np.uint64) + np.uint64(1)) + right.astype(np.uint64))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for _, _, data, offsets in arrays.row_blocks(batch.column(0), _ROWS_BYTES):
            yield data, offsets


def _count_words(ranges: int):
    def flush(hashes, counts):
        part = _range_of(hashes, ranges)
        return _batch([{"part": k, "hash": hashes[run].tobytes(), "count": counts[run].tobytes()} for k, run in _split(part, ranges)], ["hash", "count"])

    def of_partition(batches):
        hashes, counts = np.empty(0, np.uint64), np.empty(0, np.uint64)
        for data, offsets in _texts(batches):
            found, n = np.unique(_tokens(data, offsets)[0], return_counts=True)
            hashes, counts = _sum_by(np.concatenate((hashes, found)), np.concatenate((counts, n.astype(np.uint64))))
            if len(hashes) >= _FLUSH:
                yield flush(hashes, counts)
                hashes, counts = hashes[:0], counts[:0]
        yield flush(hashes, counts)

    return of_partition


def _write_words(folder: str):
    def of_group(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        hashes, counts = _sum_by(_joined(table, "hash", np.uint64), _joined(table, "count", np.uint64))
        _write(folder, f"words-{part}.hash", hashes)
        _write(folder, f"words-{part}.count", counts)
        return pa.table({"part": [part], "words": [len(hashes)], "tokens": [int(counts.sum())]})

    return of_group


_PAIR_NAMES = ["left", "run", "right", "count"]


def _count_pairs(folder: str, base: np.ndarray, ranges: int, number: type):
    def flush(left, right, counts):
        part = _range_of(pair_hash(left, right), ranges)
        order = np.argsort(part, kind="stable")
        left, right, counts, part = left[order], right[order], counts[order], part[order]
        rows = []
        for k, run in _split(part, ranges):
            mine = left[run]
            first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
            rows.append({"part": k, "left": mine[first].astype(number).tobytes(), "run": np.diff(np.r_[first, len(mine)]).astype(np.uint32).tobytes(),
                         "right": right[run].astype(number).tobytes(), "count": counts[run].astype(np.uint64).tobytes()})
        return _batch(rows, _PAIR_NAMES)

    def merged(lefts, rights, counts):
        left, right, count = np.concatenate(lefts), np.concatenate(rights), np.concatenate(counts)
        order = np.lexsort((right, left))
        left, right, count = left[order], right[order], count[order]
        first = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])]) if len(left) else np.empty(0, np.int64)
        return left[first], right[first], np.add.reduceat(count, first) if len(first) else count

    def of_partition(batches):
        words = Words(folder, base)
        begin = int(base[-1])
        held = []
        for data, offsets in _texts(batches):
            tokens, last = _tokens(data, offsets)
            known, place = _numbered(words, tokens)
            right = known[place]
            left = np.concatenate(([begin], right[:-1]))
            left[last[:-1] + 1] = begin
            held.append(merged([left], [right], [np.ones(len(left), np.int64)]))
            if sum(len(x[0]) for x in held) >= _FLUSH:
                yield flush(*merged(*zip(*held)))
                held = []
        if held:
            yield flush(*merged(*zip(*held)))

    return of_partition


_STAT_NAMES = ["word", "before", "once", "twice", "more", "totals"]


def _write_pairs(folder: str, base: np.ndarray, number: type):
    """Merge a range of pairs, write it, and hand on what it tells about single words, by range of words."""

    def of_group(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        left = np.repeat(_joined(table, "left", number), _joined(table, "run", np.uint32)).astype(np.int64)
        right = _joined(table, "right", number).astype(np.int64)
        count = _joined(table, "count", np.uint64)
        keys = pair_hash(left, right)
        order = np.argsort(keys, kind="stable")
        keys, left, right, count = keys[order], left[order], right[order], count[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, left, right, count = keys[first], left[first], right[first], np.add.reduceat(count, first)
        _write(folder, f"pairs-{part}.hash", keys)
        _write(folder, f"pairs-{part}.count", count.astype(np.uint32) if count.max() < 1 << 32 else count)
        word, place = np.unique(np.concatenate((left, right)), return_inverse=True)
        of_left, of_right = place[: len(left)], place[len(left) :]
        stats = {"before": np.bincount(of_right, minlength=len(word))}
        for name, which in (("once", count == 1), ("twice", count == 2), ("more", count > 2)):
            stats[name] = np.bincount(of_left[which], minlength=len(word))
        totals = np.array([(count == k).sum() for k in (1, 2, 3, 4)], np.int64)
        bounds = np.searchsorted(word, base)
        bounds[-1] = len(word)  # the word number after the last is the beginning of a text
        rows = []
        for k in range(len(base) - 1):
            run = slice(bounds[k], bounds[k + 1])
            if bounds[k] < bounds[k + 1] or k == 0:
                rows.append({"part": k, "word": word[run].astype(number).tobytes(), "totals": (totals if k == 0 else 0 * totals).tobytes(),
                             **{name: values[run].astype(np.uint32).tobytes() for name, values in stats.items()}})
        return pa.Table.from_batches([_batch(rows, _STAT_NAMES)])

    return of_group


def _write_stats(folder: str, base: np.ndarray, number: type):
    def of_group(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        size = int(base[part + 1] - base[part]) + (part == len(base) - 2)
        word = _joined(table, "word", number).astype(np.int64) - base[part]
        sums = {}
        for name in ("before", "once", "twice", "more"):
            sums[name] = np.bincount(word, _joined(table, name, np.uint32), size).astype(np.uint64)
            _write(folder, f"words-{part}.{name}", sums[name])
        counted = [int((sums["before"] == k).sum()) for k in (1, 2, 3, 4)]
        totals = _joined(table, "totals", np.int64).reshape(-1, 4).sum(axis=0).tolist()
        return pa.table({"part": [part], "before": [counted], "pairs": [totals], "above": [int((sums["before"] > 2).sum())], "types": [int(sums["before"].sum())]})

    return of_group


def discounts(n: list[int]) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and more, from how many entries have the counts 1 to 4; halves of the count where that tells nothing."""
    n1, n2, n3, n4 = (float(x) for x in n)
    found = np.array([0.0, 0.5, 1.0, 1.5])
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        found[1] = 1 - 2 * y * n2 / n1
        found[2] = 2 - 3 * y * n3 / n2
        if n3:
            found[3] = 3 - 4 * y * n4 / n3
    limits = np.array([0, 1, 2, 3])
    return np.clip(found, 0.05 * limits, 0.95 * limits)


SCORES = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                       T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])


@dataclass(frozen=True)
class NgramModel:
    """A trained model: the folder of its arrays and a few totals."""

    folder: str
    base: np.ndarray
    pair_ranges: int
    texts: int
    tokens: int
    pair_counts: list[int]
    before_counts: list[int]
    before_above: int
    types: int

    def scores(self, text: str | Column) -> Column:
        """Struct of :data:`SCORES` for each text, in decimal logarithms; a null text scores like an empty one, its end token alone."""
        model = self

        def of_batch(texts: pa.Array) -> pa.Array:
            return Scorer.of(model).score(texts)

        return F.arrow_udf(of_batch, returnType=SCORES)(arrays.utf8(text))


class Scorer:
    """A model's arrays, mapped by a worker."""

    _last: Scorer | None = None

    @classmethod
    def of(cls, model: NgramModel) -> Scorer:
        if cls._last is None or cls._last.model.folder != model.folder:
            cls._last = cls(model)
        return cls._last

    def __init__(self, model: NgramModel):
        self.model, self.words = model, Words(model.folder, model.base)
        self._pairs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.of_pairs, self.of_words = discounts(model.pair_counts), discounts(model.before_counts)
        n1, n2 = model.before_counts[:2]
        left = self.of_words[1] * n1 + self.of_words[2] * n2 + self.of_words[3] * model.before_above
        self.unseen = (left / model.types if model.types else 1.0) / (int(model.base[-1]) + 1)

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the sorted pair hashes."""
        out, ranges = np.zeros(len(keys), np.float64), self.model.pair_ranges
        for k, run in _split(_range_of(keys, ranges), ranges):
            if k not in self._pairs:
                path = f"{self.model.folder}/pairs-{k}"
                if os.path.exists(f"{path}.hash"):
                    known = np.memmap(f"{path}.hash", np.uint64, "r")
                    self._pairs[k] = known, np.memmap(f"{path}.count", np.uint32 if os.path.getsize(f"{path}.count") == 4 * len(known) else np.uint64, "r")
                else:
                    self._pairs[k] = np.empty(0, np.uint64), np.empty(0, np.uint32)
            known, counts = self._pairs[k]
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[run]), len(known) - 1)
                out[run] = np.where(known[at] == keys[run], counts[at], 0)
        return out

    def _begin(self, name: str) -> float:
        """What is known of the beginning of a text as a context."""
        last = len(self.model.base) - 2
        path = f"{self.model.folder}/words-{last}.{name}"
        return float(np.memmap(path, np.uint64, "r")[-1]) if os.path.exists(path) else 0.0

    def score(self, texts: pa.Array) -> pa.Array:
        parts = [self._block(data, offsets) for _, _, data, offsets in arrays.row_blocks(texts, _ROWS_BYTES)]
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0)] * 4
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.StructArray.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], SCORES.names)

    def _block(self, data, offsets):
        tokens, last = _tokens(data, offsets)
        known, place = _numbered(self.words, tokens)
        # word numbers follow the order of the hashes, so the known ones are sorted
        seen = np.flatnonzero(known >= 0)
        table = {}
        for name in _WORD_PARTS:
            if name != "hash":
                table[name] = np.zeros(len(known))
                if self.model.texts:
                    table[name][seen] = self.words.get(known[seen], name)
        count = table["count"]
        base = np.log10((count + 0.1) / (self.model.tokens + 0.1 * (int(self.model.base[-1]) + 1)))
        before = table["before"]
        alone = np.maximum(before - self.of_words[np.minimum(before, 3).astype(int)], 0) / max(self.model.types, 1) + self.unseen
        kept = self.of_pairs[1] * table["once"] + self.of_pairs[2] * table["twice"] + self.of_pairs[3] * table["more"]
        context = np.concatenate(([-1], place[:-1]))
        first = np.concatenate(([0], last[:-1] + 1))
        context[first] = -1
        total = np.where(context >= 0, count[context], self.model.texts)
        begin = self.of_pairs[1] * self._begin("once") + self.of_pairs[2] * self._begin("twice") + self.of_pairs[3] * self._begin("more") if self.model.texts else 0.0
        spare = np.where(context >= 0, kept[context], begin)
        left = np.where(context >= 0, known[context], int(self.model.base[-1]))
        right = known[place]
        both = np.flatnonzero((left >= 0) & (right >= 0))
        keys, at = np.unique(pair_hash(left[both], right[both]), return_inverse=True)
        pairs = np.zeros(len(place))
        pairs[both] = self._pair_counts(keys)[at]
        chance = alone[place]
        met = np.flatnonzero(total > 0)
        chance[met] = (np.maximum(pairs[met] - self.of_pairs[np.minimum(pairs[met], 3).astype(int)], 0) + spare[met] * chance[met]) / total[met]
        rows, n = np.repeat(np.arange(len(last)), np.diff(np.r_[-1, last])), len(last)
        return np.bincount(rows, minlength=n), np.bincount(rows, count[place] > 0, n).astype(np.int64), np.bincount(rows, base[place], n), np.bincount(rows, np.log10(chance), n)


def train(docs: DataFrame, text: str = "text") -> NgramModel:
    """A model of all rows of ``docs``. Tokens are runs of other than ASCII white space, ASCII letters lower-cased, and an end per text.

    Null texts are empty. Every row counts, repeated ones as often as they occur. Without rows every token is unknown and has
    probability 1.
    """
    spark = docs.sparkSession
    arrays.bound_batches(spark)
    texts = docs.select(arrays.utf8(text).alias("text"))
    rows, size = texts.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    folder = _shared_folder(scratch_path(spark, "ngrams"))
    os.makedirs(folder)
    word_ranges, pair_ranges = _ranges(size or 0, WORD_RANGE_BYTES), _ranges(size or 0, PAIR_RANGE_BYTES)
    counted = texts.mapInArrow(_count_words(word_ranges), _binary(["hash", "count"]))
    sizes = counted.groupBy("part").applyInArrow(_write_words(folder), "part long, words long, tokens long").collect()
    words = np.zeros(word_ranges, np.int64)
    for row in sizes:
        words[row["part"]] = row["words"]
    base = np.concatenate(([0], np.cumsum(words)))
    number = np.uint32 if base[-1] < (1 << 32) - 1 else np.uint64
    pairs = texts.mapInArrow(_count_pairs(folder, base, pair_ranges, number), _binary(_PAIR_NAMES))
    stats = pairs.groupBy("part").applyInArrow(_write_pairs(folder, base, number), _binary(_STAT_NAMES))
    done = stats.groupBy("part").applyInArrow(_write_stats(folder, base, number), "part long, before array<long>, pairs array<long>, above long, types long").collect()

    def total(name: str) -> list[int]:
        return [sum(row[name][k] for row in done) for k in range(4)]

    return NgramModel(folder, base, pair_ranges, rows, sum(row["tokens"] for row in sizes), total("pairs"), total("before"), sum(row["above"] for row in done), sum(row["types"] for row in done))
