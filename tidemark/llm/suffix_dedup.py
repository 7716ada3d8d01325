"""Removal of repeated substrings with suffix arrays: every byte inside a string of ``length`` bytes that also starts elsewhere goes.

A string of ``length`` bytes (a window) is named after the least hash of the short grams in it, which depends on its content alone, so
equal windows have equal names. Runs of windows of one name form a piece of text. Names that only one piece has cannot
repeat; the pieces of the others (a small share of the corpus) are brought together, sorted by name, and cut into shards of bounded size.
Each shard gets a suffix array (ordered by Larsson-Sadakane refinement: only groups of ties are refined, twice as deep
each time) and common prefixes by Kasai's walk through the text, done in many lanes at once. Windows whose prefix is shared
in the shard repeat. A name whose pieces lie in several shards (those at a shard's edges, and those too frequent for one shard) is
also merged across shards: each shard's sorted run of window fingerprints is cut at fixed splitters, and the runs of one name and
bucket are looked up in each other by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.session import scratch_path, stage

LENGTH = 400
#: Bytes of the grams that name a window: long enough to be rare by chance, short enough for long runs of one name.
GRAM = 64
#: Text of a shard; its arrays take some eighty times as much memory.
SHARD_BYTES = 2 << 20
#: A run of one name (periodic text) is cut after so many windows.
_LONGEST_RUN = 1024
_BLOCK = 512 << 10
_LANES = 4096

RUNS = T.ArrayType(T.StructType([T.StructField("name", T.LongType()), T.StructField("at", T.LongType()), T.StructField("windows", T.IntegerType()), T.StructField("alone", T.BooleanType())]))
_RUNS_ARROW = pa.list_(pa.struct([("name", pa.int64()), ("at", pa.int64()), ("windows", pa.int32()), ("alone", pa.bool_())]))


# --- names of windows -------------------------------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    starts = np.arange(len(data) - gram + 1)
    return arrays.hash_spans(data, starts, starts + gram)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values: block-wise running minima from both sides."""
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    padded = padded.reshape(rows, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: len(values) - width + 1], left[width - 1 : len(values)])


def runs_of(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one name in a text: name, first window, number of windows, and whether the name occurs twice in it."""
    width = length - gram + 1
    hashes = _gram_hashes(data, gram)
    least = sliding_minimum(hashes, width)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    counts = np.diff(np.r_[first, len(least)])
    if counts.max(initial=0) > _LONGEST_RUN:
        parts = -(-counts // _LONGEST_RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.repeat(first + counts, parts)
        first = np.repeat(first, parts) + nth * _LONGEST_RUN
        counts = np.minimum(_LONGEST_RUN, ends - first)
    names = least[first]
    # grams that name some run, by position; then those in each run's span that name this run
    known = np.unique(names)
    place = np.flatnonzero(hashes <= known[-1])
    place = place[known[np.minimum(np.searchsorted(known, hashes[place]), len(known) - 1)] == hashes[place]]
    low, high = np.searchsorted(place, first), np.searchsorted(place, first + counts + width - 1)
    sizes = high - low
    owner = np.repeat(np.arange(len(first)), sizes)
    inside = place[np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
    hits = np.bincount(owner[hashes[inside] == names[owner]], minlength=len(first))
    return names, first, counts, hits > 1


def _text_runs(data: np.ndarray, length: int, gram: int):
    """:func:`runs_of` for a text of any size, block by block; a run may end at a block's border."""
    for start in range(0, len(data) - length + 1, _BLOCK):
        names, first, counts, twice = runs_of(data[start : start + _BLOCK + length - 1], length, gram)
        yield names, first + start, counts, twice


def _run_finder(length: int, gram: int):
    def of_batch(texts: pa.Array) -> pa.Array:
        data, offsets = arrays.raw_bytes(texts)
        parts, sizes = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            found = list(_text_runs(data[a:b], length, gram)) if b - a >= length else []
            sizes.append(sum(len(x[0]) for x in found))
            parts += found
        columns = [np.concatenate([p[k] for p in parts]) if parts else np.empty(0, kind) for k, kind in enumerate((np.uint64, np.int64, np.int64, bool))]
        fields = [pa.array(columns[0].view(np.int64)), pa.array(columns[1]), pa.array(columns[2].astype(np.int32)), pa.array(~columns[3])]
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.StructArray.from_arrays(fields, fields=list(_RUNS_ARROW.value_type)))

    return F.arrow_udf(of_batch, returnType=RUNS)


# --- suffix arrays ----------------------------------------------------------------------------------------------------


_SYMBOLS, _BITS = 7, 9


def _words(data: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The seven symbols from each position on as one number: bytes plus one, zeros from the end of the position's piece (``limit``) on."""
    symbols = np.zeros(len(data) + _SYMBOLS, np.int64)
    symbols[: len(data)] = data
    symbols[: len(data)] += 1
    room = limit - np.arange(len(data))
    out = symbols[: len(data)].copy()
    for k in range(1, _SYMBOLS):
        out <<= _BITS
        out |= np.where(room > k, symbols[k : k + len(data)], 0)
    return out


def suffix_array(words: np.ndarray, limit: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Suffixes of pieces in order; each ends at its piece's ``limit``, and of equal ones that of the earlier ``piece`` comes first.

    A suffix that is already told apart from all others is done; each round orders the ties that are left by the ranks of
    the suffixes that follow them, which doubles the depth. No tie outlasts the longest piece.
    """
    n, width = len(words), _SYMBOLS
    pieces = int(piece[-1]) + 1 if n else 0
    order = np.argsort(words)
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    key = words[order]
    while len(slots):
        fresh = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[fresh, len(key)])
        rank[order[slots]] = np.repeat(slots[fresh], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        tied = order[slots]
        after = tied + width
        key = rank[tied] << 32 | np.where(after < limit[tied], rank[np.minimum(after, n - 1)] + pieces, piece[tied])
        by = np.argsort(key)
        order[slots] = tied[by]
        key, width = key[by], 2 * width
    return order


def _equal_symbols(difference: np.ndarray) -> np.ndarray:
    """Leading symbols that are zero."""
    count = np.zeros(len(difference), np.int64)
    for k in range(_SYMBOLS):
        count += difference >> (_BITS * k) == 0
    return count


def common_prefixes(words: np.ndarray, limit: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place in ``order``: bytes in common with the suffix before it, counted up to ``most``.

    Kasai's walk goes through the text, where the count falls by one at most from a position to the next. Here lanes start
    at equal distances and walk side by side, so each step is one array operation.
    """
    n = len(words)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    prefix = np.zeros(n, np.int64)
    stride = -(-n // min(_LANES, n))
    at = np.arange(0, n, stride)
    end = np.minimum(at + stride, n)
    size = np.zeros(len(at), np.int64)
    while len(at):
        other = before[at]
        # the first suffix has none before it
        room = np.where(other < 0, 0, np.minimum(np.minimum(limit[at] - at, limit[other] - other), most) - size)
        a, b = np.minimum(at + size, n - 1), np.minimum(other + size, n - 1)
        equal = np.minimum(_equal_symbols(words[a] ^ words[b]), np.maximum(room, 0))
        size = size + equal
        done = (equal < _SYMBOLS) | (equal == room)
        prefix[at[done]] = size[done]
        at = at + done
        size = np.where(done, np.maximum(size - 1, 0), size)
        on = at < end
        if not on.all():
            at, end, size = at[on], end[on], size[on]
    return prefix[order]


def repeated_windows(data: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """For each position the number of its window's content if that begins at two places or more, else -1. ``offsets``: of the pieces."""
    piece = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    limit = offsets[1:][piece]
    words = _words(data, limit)
    order = suffix_array(words, limit, piece)
    shared = common_prefixes(words, limit, order, length) >= length
    out = np.full(len(data), -1, np.int64)
    again = shared | np.r_[shared[1:], False]
    out[order[again]] = np.cumsum(~shared)[again]
    return out


# --- shards -----------------------------------------------------------------------------------------------------------

_RUN = "struct<name:bigint,bucket:bigint,prints:binary,owners:binary,docs:array<binary>,at:array<bigint>>"
_REPEATS = f"doc binary, first long, last long, run {_RUN}"
_RUN_ARROW = pa.struct([("name", pa.int64()), ("bucket", pa.int64()), ("prints", pa.binary()), ("owners", pa.binary()), ("docs", pa.list_(pa.binary())), ("at", pa.list_(pa.int64()))])
_SPANS_ARROW = pa.schema([("doc", pa.binary()), ("first", pa.int64()), ("last", pa.int64())])
_REPEATS_ARROW = _SPANS_ARROW.append(pa.field("run", _RUN_ARROW))
_PRINT = np.dtype([("low", "<u8"), ("high", "<u8")])
#: Pieces of a name whose window fingerprints are merged in one bucket, about.
_BUCKET_PIECES = 4096


def _spans(marked: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of every run of ``marked`` items of one piece that are next to each other."""
    first = np.flatnonzero(marked & np.r_[True, ~marked[:-1] | (piece[1:] != piece[:-1])])
    last = np.flatnonzero(marked & np.r_[~marked[1:] | (piece[1:] != piece[:-1]), True])
    return first, last


def _shard(rows: list[pa.RecordBatch], edge: set[int], length: int) -> Iterator[pa.RecordBatch]:
    """Repeats of one shard as spans of bytes (``doc, first, last``), and for names in ``edge`` a ``run`` of sorted fingerprints for each bucket.

    A window that is single here has its place as owner, so that another shard's may mark it; of repeated ones one goes without.
    """
    table = pa.Table.from_batches(rows).combine_chunks()
    data, offsets = arrays.raw_bytes(table["piece"].chunk(0))
    names, at, often = (table[c].to_numpy() for c in ("name", "at", "often"))
    docs = table["doc"].chunk(0)
    group = repeated_windows(data, offsets, length)
    marked = group >= 0
    piece_of = np.repeat(np.arange(len(names), dtype=np.int32), np.diff(offsets))
    first, last = _spans(marked, piece_of)
    piece, shift = piece_of[first], at - offsets[:-1]
    yield pa.record_batch([docs.take(pa.array(piece)), pa.array(first + shift[piece]), pa.array(last + shift[piece] + length), pa.nulls(len(first), _RUN_ARROW)], schema=_REPEATS_ARROW)
    wanted = np.isin(names, list(edge))
    if not wanted.any():
        return
    windows = np.flatnonzero(wanted[piece_of] & (offsets[1:][piece_of] - np.arange(len(data)) >= length))
    single = group[windows] < 0
    alone, others = windows[single], windows[~single]
    witness = others[np.unique(group[others], return_index=True)[1]]
    windows = np.sort(np.concatenate((alone, witness)))
    owned = group[windows] < 0
    prints = np.empty(len(windows), _PRINT)
    half = length // 2
    prints["low"], prints["high"] = arrays.hash_spans(data, windows, windows + half), arrays.hash_spans(data, windows + half, windows + length)
    piece = piece_of[windows]
    # a name with many pieces is cut into buckets by the leading bits of its fingerprints
    bits = np.ceil(np.log2(np.maximum(often / _BUCKET_PIECES, 1))).astype(np.uint64)[piece]
    bucket = np.where(bits > 0, prints["low"] >> (np.uint64(64) - np.maximum(bits, np.uint64(1))), np.uint64(0)).astype(np.int64)
    by = np.lexsort((prints["high"], prints["low"], bucket, names[piece]))
    windows, owned, prints, piece, bucket = (x[by] for x in (windows, owned, prints, piece, bucket))
    cuts = np.flatnonzero(np.r_[True, (names[piece][1:] != names[piece][:-1]) | (bucket[1:] != bucket[:-1]), True])
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        known, owner = np.unique(piece[i:j], return_inverse=True)
        # an owner: the piece and the window's place in it
        owners = np.where(owned[i:j], owner << 32 | windows[i:j] - offsets[:-1][piece[i:j]], -1)
        run = {"name": int(names[piece[i]]), "bucket": int(bucket[i]), "prints": prints[i:j].tobytes(), "owners": owners.astype("<i8").tobytes(), "docs": docs.take(pa.array(known)).to_pylist(), "at": at[known].tolist()}
        none = pa.nulls(1, pa.int64())
        yield pa.record_batch([pa.nulls(1, pa.binary()), none, none, pa.array([run], _RUN_ARROW)], schema=_REPEATS_ARROW)


def _sharder(length: int, shard_bytes: int):
    """Cuts a partition, sorted by name, into shards: where a name ends if there is room, else inside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, edge, opened = 0, set(), None
        for batch in batches:
            names = batch["name"].to_numpy()
            if not len(names):
                continue
            if opened is None:
                edge.add(int(names[0]))  # may continue the partition before
            lengths = np.diff(arrays.raw_bytes(batch["piece"])[1])
            start, total = 0, size + np.cumsum(lengths)
            base = 0
            last = names[0] if opened is None else opened
            changes = np.r_[names[0] != last, names[1:] != names[:-1]]
            for i in np.flatnonzero((total >= shard_bytes)).tolist():
                full = total[i] - base
                if full < shard_bytes or (not changes[i] and full < 2 * shard_bytes):
                    continue
                if i > start:
                    held.append(batch.slice(start, i - start))
                if not changes[i]:
                    edge.add(int(names[i]))
                if held:
                    yield from _shard(held, edge, length)
                held, start, base = [], i, total[i] - lengths[i]
                edge = set() if changes[i] else {int(names[i])}
            held.append(batch.slice(start))
            size, opened = int(total[-1] - base), names[-1]
        if held:
            yield from _shard(held, edge | {int(opened)}, length)  # may go on in the partition after

    return run


def _merged(runs: list[dict], length: int) -> pa.RecordBatch:
    """Spans of the windows that another shard's run holds too: every run is looked up in the others by binary search."""
    prints = [np.frombuffer(run["prints"], _PRINT) for run in runs]
    everything = np.sort(np.concatenate(prints), order=("low", "high"))
    # one number for each fingerprint, so that pairs are searched like numbers
    keys = everything[np.r_[True, everything[1:] != everything[:-1]]]
    spans: list[tuple[bytes, int, int]] = []
    found = np.zeros(len(keys), np.int64)
    places = [_place(keys, mine) for mine in prints]
    for place in places:
        found[place] += 1
    for run, place in zip(runs, places):
        owners = np.frombuffer(run["owners"], "<i8")
        hit = np.sort(owners[(owners >= 0) & (found[place] > 1)])
        first = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
        last = np.r_[first[1:], len(hit)] - 1 if len(first) else first
        for start, end in zip(hit[first].tolist(), hit[last].tolist()):
            at = run["at"][start >> 32]
            spans.append((run["docs"][start >> 32], at + (start & 0xFFFFFFFF), at + (end & 0xFFFFFFFF) + length))
    doc, first, last = zip(*spans) if spans else ((), (), ())
    return pa.record_batch([pa.array(doc, pa.binary()), pa.array(first, pa.int64()), pa.array(last, pa.int64())], schema=_SPANS_ARROW)


def _place(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each fingerprint in the sorted ``keys``, which hold them all."""
    low = np.searchsorted(keys["low"], wanted["low"])
    # first halves that are equal stand side by side
    while True:
        behind = keys["high"][low] != wanted["high"]
        if not behind.any():
            return low
        low = low + behind


def _merger(length: int):
    """Merges the runs of each name and bucket; the rows of a partition are sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch["run"]:
                row = row.as_py()
                if held and (held[0]["name"], held[0]["bucket"]) != (row["name"], row["bucket"]):
                    if len(held) > 1:
                        yield _merged(held, length)
                    held = []
                held.append(row)
        if len(held) > 1:
            yield _merged(held, length)

    return run


# --- the operator -----------------------------------------------------------------------------------------------------


def _cutter(length: int):
    """The bytes of each run: its windows, to the end of the last."""

    def cut(texts: pa.Array, at: pa.Array, windows: pa.Array) -> pa.Array:
        out = []
        for text, starts, counts in zip(texts, at, windows):
            raw = text.as_buffer()
            out.append([bytes(raw[s : s + n + length - 1]) for s, n in zip(starts.values.tolist(), counts.values.tolist())])
        return pa.array(out, pa.list_(pa.binary()))

    return F.arrow_udf(cut, returnType=T.ArrayType(T.BinaryType()))


CLEANED = T.StructType([T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType())])


def merged_spans(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Union of spans as ``[start, end, start, end …]``, touching ones joined."""
    if not len(first):
        return np.empty(0, np.int64)
    by = np.argsort(first, kind="stable")
    first, reach = first[by], np.maximum.accumulate(last[by])
    new = np.r_[True, first[1:] > reach[:-1]]
    return np.ravel(np.column_stack((first[new], reach[np.r_[new[1:], True]])))


def _remover():
    def remove(texts: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
        spans, kept = [], []
        for text, a, b in zip(texts, first, last):
            if not text.is_valid:
                spans.append(None)
                kept.append(None)
                continue
            raw = text.as_buffer()
            bounds = merged_spans(np.asarray(a.values, np.int64), np.asarray(b.values, np.int64))
            edges = [0, *bounds.tolist(), len(raw)]
            spans.append(bounds)
            kept.append(b"".join(raw[s:e] for s, e in zip(edges[::2], edges[1::2])))
        return pa.StructArray.from_arrays([pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())], CLEANED.names)

    return F.arrow_udf(remove, returnType=CLEANED)


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
    work: str | None = None,
) -> DataFrame:
    """``row`` (struct of the columns in ``keep``, default all), ``n_bytes``, ``n_removed``, ``spans`` and ``kept`` for every document.

    ``spans`` are the removed bytes as ``[start, end, start, end …)``, ``kept`` the others as ``binary``. A string of ``length`` bytes counts as
    repeated if it starts at two places, in one document or two; they may overlap. All strings are judged on the
    input. Texts equal as a whole are recognised first, by their digest, and looked into once. Null and empty texts have no bytes;
    texts shorter than ``length`` are never touched. Repeated rows are copies of each other. Order and other columns do
    not matter. Intermediate tables lie below ``work`` (default: a new scratch folder), which the result reads.
    """
    spark = docs.sparkSession
    arrays.bound_batches(spark)
    work = work or scratch_path(spark, "repeats")
    carried = F.struct(*[F.col(f"`{name}`") for name in (docs.columns if keep is None else keep)])
    rows = docs.select(carried.alias("row"), arrays.utf8(text).alias("text"))
    long_enough = F.coalesce(F.length("text") >= length, F.lit(False))
    texts = rows.where(long_enough).select(F.unhex(F.md5("text")).alias("doc"), "text")

    # each distinct text once, with the number of its copies; then the runs whose name is not theirs alone
    runs = texts.select("doc", F.explode(_run_finder(length, gram)("text")).alias("run")).select("doc", "run.*")
    runs = stage(runs.groupBy("doc", "at").agg(F.first("name").alias("name"), F.first("windows").alias("windows"), F.first("alone").alias("alone"), F.count(F.lit(1)).alias("copies")), "runs", work)
    shared = runs.groupBy("name").agg(F.count(F.lit(1)).alias("often"), F.bool_or(~F.col("alone")).alias("twice")).where("often > 1 or twice").drop("twice")
    chosen = runs.join(shared, "name").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("at", "windows", "name", "often"))).alias("runs"))

    # their bytes, from one copy of each text
    single = texts.groupBy("doc").agg(F.first("text").alias("text"))
    cut = single.join(chosen, "doc").select("doc", "runs", _cutter(length)("text", F.col("runs.at"), F.col("runs.windows")).alias("pieces"))
    pieces = cut.select("doc", F.explode(F.arrays_zip("runs", "pieces")).alias("p")).select("doc", "p.runs.at", "p.runs.name", "p.runs.often", F.col("p.pieces").alias("piece"))
    pieces = stage(pieces, "pieces", work)
    size = pieces.agg(F.sum(F.length("piece"))).first()[0] or 0
    shards = pieces.repartitionByRange(max(1, -(-size // (2 * shard_bytes))), "name", "doc", "at").sortWithinPartitions("name", "doc", "at")
    found = stage(shards.mapInArrow(_sharder(length, shard_bytes), _REPEATS), "shards", work)
    inside = found.where("run is null").select("doc", "first", "last")
    place = [F.col("run.name"), F.col("run.bucket")]
    edges = found.where("run is not null").select("run").repartition(*place).sortWithinPartitions(*place)
    across = edges.mapInArrow(_merger(length), "doc binary, first long, last long")

    # back to the documents: texts with copies go as a whole
    whole = runs.where("at = 0 and copies > 1").select("doc", F.lit(0).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
    marks = inside.unionByName(across).unionByName(whole).groupBy("doc")
    marks = marks.agg(F.collect_list("first").alias("first"), F.collect_list(F.coalesce("last", F.lit(-1))).alias("last"))
    # short texts have no marks; a key of their own spreads them
    key = F.when(long_enough, F.unhex(F.md5("text"))).otherwise(F.xxhash64("row", "text").cast("string").cast("binary"))
    joined = rows.withColumn("doc", key).join(marks, "doc", "left")
    ends = F.transform("last", lambda e: F.when(e < 0, F.length("text").cast("long")).otherwise(e))
    cleaned = joined.select("row", "text", _remover()(F.when(F.col("first").isNotNull(), F.col("text")), "first", ends).alias("c"))
    spans = F.coalesce("c.spans", F.array().cast("array<bigint>"))
    empty = F.lit(b"")
    done = cleaned.select("row", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_bytes"), spans.alias("spans"), F.coalesce("c.kept", "text", empty).alias("kept"))
    return done.select("row", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), "spans", "kept")
