"""Benchmark decontamination by suffix arrays over the training texts.

Every Arrow batch of documents is cut into shards of about a million words. A shard's suffix array orders all its word
positions; every suffix of every benchmark item that begins with a whole window is searched in it by bisection, word after word, to the
window's depth, which yields the interval of all the window's occurrences. The shorter suffixes at an item's end are not searched.
From each occurrence a forward scan finds how far the match goes on; the longest is reported once per contaminated document. A document that holds a whole window (``window`` consecutive
words of an item, or all of a shorter item) is contaminated. Shards are independent, so the documents are never shuffled.

The benchmark travels to the workers in blocks of at most about :data:`BLOCK_BYTES` of text; more than one block
means one pass over the documents for each, with the finds so far written below ``spark.checkpoint.dir`` in between.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.session import stage

BLOCK_BYTES = 16 << 20
SHARD_WORDS = 1 << 20
_ROWS_BYTES = 3 << 20

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("runs", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest_words", T.LongType()),
    T.StructField("longest_item", T.StringType()),
    T.StructField("longest_at", T.LongType()),
])


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word (ASCII letters lower-cased)."""
    data = arrays.lower_ascii(data)
    starts, ends = arrays.word_spans(data, offsets, arrays.ALPHANUMERIC)
    return arrays.hash_spans(data, starts, ends), arrays.rows_of(starts, offsets)


@dataclass(frozen=True)
class Queries:
    """The suffixes of a block of items: ``words[j:j + left[j]]`` for each ``j``; ``need[j]`` is its window, or 0."""

    ids: list[str]
    words: np.ndarray
    item: np.ndarray
    left: np.ndarray
    need: np.ndarray


def build_queries(ids: list[str], texts: pa.Array, window: int) -> Queries:
    words, item = words_of(*arrays.raw_bytes(texts))
    ends = np.cumsum(np.bincount(item, minlength=len(ids)))
    left = ends[item] - np.arange(len(words)) if len(words) else np.empty(0, np.int64)
    whole = np.r_[True, item[1:] != item[:-1]] if len(words) else np.empty(0, bool)
    need = np.where(left >= window, window, np.where(whole, left, 0))
    return Queries(ids, words, item, left, need)


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the ``depth`` word numbers (at least 1, below 2 ** 21) that follow them."""
    n = len(ids)
    padded = np.zeros(n + 2, np.int64)
    padded[:n] = ids
    key = padded[:n] << 42 | padded[1 : n + 1] << 21 | padded[2:]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    key, width = key[order], 3
    while len(slots):
        fresh = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[fresh, len(key)])
        rank[order[slots]] = np.repeat(slots[fresh], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        if width >= depth or not len(slots):
            break
        # ties only: order them by the rank of what follows, twice as far each time
        tied = order[slots]
        after = tied + width
        key = rank[tied] << 32 | np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        order[slots] = tied[by]
        key, width = key[by], 2 * width
    return order


def _bisect(order, ids, low, high, depth, word, after):
    """In each interval of the suffix array: first place whose word at ``depth`` is not below (``after``: is above) ``word``."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        value = ids[order[middle] + depth]
        go = value <= word[open_] if after else value < word[open_]
        low[open_[go]] = middle[go] + 1
        high[open_[~go]] = middle[~go]
        open_ = open_[low[open_] < high[open_]]
    return low


def search(words: np.ndarray, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    """(position, suffix) for every occurrence in ``words`` of a window that the suffix begins with."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(words) or not len(queries.words):
        return none
    vocabulary, ids = np.unique(words, return_inverse=True)
    at = np.searchsorted(vocabulary, queries.words)
    wanted = np.where(vocabulary[np.minimum(at, len(vocabulary) - 1)] == queries.words, at + 1, -1)  # 0 is what follows the last word
    active = np.flatnonzero((queries.need > 0) & (wanted > 0))
    if not len(active):
        return none
    order = suffix_array(ids + 1, int(queries.need[active].max()))
    padded = np.concatenate((ids + 1, np.zeros(int(queries.need[active].max()), np.int64)))
    bounds = np.concatenate(([0], np.cumsum(np.bincount(ids + 1, minlength=len(vocabulary) + 1))))
    low, high = bounds[wanted[active]], bounds[wanted[active] + 1]
    hits, depth = [], 1
    while len(active):
        done = queries.need[active] == depth
        hits.append((active[done], low[done], high[done]))
        active, low, high = active[~done], low[~done], high[~done]
        word = wanted[active + depth] if len(active) else active
        low, high = _bisect(order, padded, low, high, depth, word, False), _bisect(order, padded, low, high, depth, word, True)
        alive = low < high
        active, low, high, depth = active[alive], low[alive], high[alive], depth + 1
    suffix, low, high = (np.concatenate(x) for x in zip(*hits))
    sizes = high - low
    places = np.repeat(low - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    return order[places], np.repeat(suffix, sizes)


def find(texts: pa.Array, before: pa.StructArray | None, queries: Queries) -> pa.Array:
    """:data:`FOUND` for each text; ``before``: what earlier blocks of the benchmark found in the same texts."""
    out: list[dict] = []
    earlier = before.to_pylist() if before is not None else [None] * len(texts)
    overlap = int(queries.need.max(initial=1)) - 1
    for first, last, data, offsets in arrays.row_blocks(texts, _ROWS_BYTES):
        words, rows = words_of(data, offsets)
        begins = np.searchsorted(rows, np.arange(last - first + 1))
        shards = [(a, min(len(words), a + SHARD_WORDS + overlap)) for a in range(0, len(words), SHARD_WORDS)]
        pieces = [(place + a, suffix) for a, b in shards for place, suffix in [search(words[a:b], queries)]]
        place = np.concatenate([p for p, _ in pieces] or [np.empty(0, np.int64)])
        suffix = np.concatenate([s for _, s in pieces] or [np.empty(0, np.int64)])
        inside = rows[place] == rows[np.minimum(place + queries.need[suffix] - 1, len(rows) - 1)]
        place, suffix = place[inside], suffix[inside]
        length = _extend(words, rows, place, suffix, queries)
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, place, 1)
        np.add.at(edges, place + queries.need[suffix], -1)
        inside_windows = np.cumsum(edges[:-1]) > 0
        by_row = np.argsort(rows[place], kind="stable")
        cuts = np.searchsorted(rows[place][by_row], np.arange(last - first + 1))
        for k in range(last - first):
            mine = by_row[cuts[k] : cuts[k + 1]]
            start, end = int(begins[k]), int(begins[k + 1])
            row = earlier[first + k] or {"n_hit": 0, "runs": [], "items": [], "longest_words": 0, "longest_item": None, "longest_at": None}
            row["n_words"] = end - start
            if len(mine):
                covered = inside_windows[start:end].copy()
                for a, b in zip(row["runs"][::2], row["runs"][1::2]):
                    covered[a:b] = True
                row["n_hit"] = int(covered.sum())
                row["runs"] = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8))).tolist()
                names = {queries.ids[i] for i in np.unique(queries.item[suffix[mine]])}
                row["items"] = sorted(names | set(row["items"]))
                best = mine[np.lexsort((place[mine], -length[mine]))[0]]
                if length[best] > row["longest_words"]:
                    row |= {"longest_words": int(length[best]), "longest_item": queries.ids[queries.item[suffix[best]]], "longest_at": int(place[best]) - start}
            out.append(row)
    return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("runs", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("longest_words", pa.int64()), ("longest_item", pa.string()), ("longest_at", pa.int64())]))


def _extend(words, rows, place, suffix, queries: Queries) -> np.ndarray:
    """Length in words of the match at each occurrence, to the end of the item or of the document."""
    length = queries.need[suffix].copy()
    open_ = np.arange(len(place))
    while len(open_):
        p, j = place[open_] + length[open_], suffix[open_] + length[open_]
        ok = (length[open_] < queries.left[suffix[open_]]) & (p < len(words))
        ok[ok] = (rows[p[ok]] == rows[place[open_[ok]]]) & (words[p[ok]] == queries.words[j[ok]])
        open_ = open_[ok]
        length[open_] += 1
    return length


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, window: int):
    """Blocks of the benchmark as :class:`Queries`, one at a time on the driver."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), arrays.utf8(text).alias("text"))
    items = items.where(F.length("text") > 0)
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = math.ceil(size / BLOCK_BYTES)
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).toArrow()
        ids = rows.column("id").to_pylist()
        yield build_queries(ids, pa.array(rows.column("text").to_pylist(), pa.large_binary()), window)


def _finder(shared: Broadcast, again: bool):
    def one(texts: pa.Array) -> pa.Array:
        return find(texts, None, shared.value)

    def more(texts: pa.Array, earlier: pa.Array) -> pa.Array:
        return find(texts, earlier, shared.value)

    return F.arrow_udf(more if again else one, returnType=FOUND)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, item_id: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """``row`` (struct of the columns in ``keep``, default all) and ``found``, in the order and number of the documents.

    ``found`` holds ``n_words``; ``n_hit``, words inside windows; ``runs``, their positions as ``[start, end, start, end …)``; ``items`` with
    windows here, sorted; the ``longest_`` verbatim match of a contaminated document: words, item and place. A null or empty text
    has no words and no finds; so has every document if the benchmark is empty. Items without a word match nothing; an
    item without an id is named ``null``. Repeated documents and items are each reported. Words are compared by 64-bit hash.
    """
    spark = docs.sparkSession
    arrays.bound_batches(spark)
    carried = F.struct(*[F.col(f"`{name}`") for name in (docs.columns if keep is None else keep)])
    found: DataFrame = docs.select(carried.alias("row"), arrays.utf8(text).alias("text"))
    before: list[Column] = []
    blocks = benchmark_blocks(benchmark, item_id, item_text, window)
    queries = next(blocks, None) or build_queries([], pa.array([], pa.large_binary()), window)
    while queries is not None:
        shared = spark.sparkContext.broadcast(queries)
        found = found.withColumn("found", _finder(shared, bool(before))("text", *before))
        queries = next(blocks, None)
        if queries is not None:
            found, before = stage(found, "contamination"), [F.col("found")]
    return found.select("row", "found")


def contaminated() -> Column:
    return F.col("found.n_hit") > 0
