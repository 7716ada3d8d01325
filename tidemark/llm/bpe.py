"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merges of a batch of pre-tokens are taken from a queue that has a bucket of positions for each rank and, above the buckets, two levels
of bitmap: a set bit says that something below it is not empty. Finding the first set bit of one word per level
leads to the lowest rank, whatever the number of waiting pairs, so very long pre-tokens cost little more per byte than
short ones. Parts are a linked list over the bytes; entries that a later merge has made stale are recognised and skipped.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.pretokens import SPACED_PATTERN, chunks


class RankQueue:
    """Buckets of positions by rank below two levels of bitmap: one word of bits for the words that are not empty.

    A word has as many bits as there are words, so two levels serve any number of ranks.
    """

    def __init__(self, ranks: int):
        self.shift = max(1, (max(ranks, 2) - 1).bit_length() + 1 >> 1)
        self.words = [0] * ((max(ranks, 1) - 1 >> self.shift) + 1)
        self.buckets: dict[int, list[int]] = {}
        self.top = 0

    def open(self, rank: int, positions: list[int]) -> None:
        """A new bucket."""
        self.buckets[rank] = positions
        word = rank >> self.shift
        self.words[word] |= 1 << (rank & (1 << self.shift) - 1)
        self.top |= 1 << word

    def take(self) -> tuple[int, list[int]]:
        """The lowest rank with its positions, by the first set bit of either level; its bucket is gone then."""
        first = self.top & -self.top
        word = first.bit_length() - 1
        bits = self.words[word]
        bit = bits & -bits
        self.words[word] = bits ^ bit
        if bits == bit:
            self.top ^= first
        rank = (word << self.shift) + bit.bit_length() - 1
        return rank, self.buckets.pop(rank)


class Ranks(dict):
    """Ranks of byte strings, with tables of those of single bytes and of pairs of bytes (-1: no token)."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__(ranks)
        self.of_byte = np.array([ranks[bytes([k])] for k in range(256)])
        self.of_pair = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)])


def merge_all(pieces: list[bytes], ranks: Ranks, queue: RankQueue) -> list[list[int]]:
    """Token ids of every pre-token: in each the lowest rank first, of its positions the leftmost.

    The pre-tokens lie end to end in one linked list, no pair crosses their borders, and one queue serves them all: a bucket has the positions
    of a rank in all of them, which is the lowest rank of each of those. What a merge has made stale is skipped when its turn comes. Should a merge
    open a lower rank than the bucket's, the rest of the bucket waits.
    """
    data, rank_of, buckets = b"".join(pieces), ranks.get, queue.buckets
    n = len(data)
    if not n:
        return [[] for _ in pieces]
    values = np.frombuffer(data, np.uint8).astype(np.int64)
    stops = np.cumsum([len(piece) for piece in pieces])
    starts = np.concatenate(([0], stops[:-1])).tolist()
    first = np.zeros(n + 1, bool)
    first[starts] = first[n] = True
    places = np.arange(n)
    pairs = np.where(first[1:], -1, ranks.of_pair[(values << 8 | np.append(values[1:], 0))])
    token, pair, end = ranks.of_byte[values].tolist(), pairs.tolist(), (places + 1).tolist()
    after, before = np.where(first[1:], -1, places + 1).tolist(), np.where(first[:-1], -1, places - 1).tolist()
    mergeable = np.flatnonzero(pairs >= 0)
    mergeable = mergeable[np.argsort(pairs[mergeable], kind="stable")]
    cuts = np.flatnonzero(np.diff(pairs[mergeable], prepend=-1, append=-1)).tolist()
    for i, j in zip(cuts, cuts[1:]):
        queue.open(pair[mergeable[i]], mergeable[i:j].tolist())
    while queue.top:
        rank, positions = queue.take()
        positions.sort()
        for turn, i in enumerate(positions):
            if pair[i] != rank:  # stale
                continue
            gone = after[i]
            behind = after[i] = after[gone]
            stop = end[i] = end[gone]
            token[i] = rank
            pair[gone] = right = left = -1
            if behind >= 0:
                before[behind] = i
                right = rank_of(data[i : end[behind]], -1)
                if right >= 0:
                    if right in buckets:
                        buckets[right].append(i)
                    else:
                        queue.open(right, [i])
            pair[i] = right
            place = before[i]
            if place >= 0:
                left = pair[place] = rank_of(data[place:stop], -1)
                if left >= 0:
                    if left in buckets:
                        buckets[left].append(place)
                    else:
                        queue.open(left, [place])
            if -1 < right < rank or -1 < left < rank:  # no trained vocabulary has that often
                rest = positions[turn + 1 :]
                if rest:
                    queue.open(rank, rest)
                break
    out = []
    for start, piece in zip(starts, pieces):
        ids, i = [], start if piece else -1
        while i >= 0:
            ids.append(token[i])
            i = after[i]
        out.append(ids)
    return out


def merge(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """Token ids of one pre-token."""
    whole = ranks.get(piece)
    return [whole] if whole is not None else merge_all([piece], Ranks(ranks), queue)[0]


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token in base 64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


#: Bytes of pre-tokens that are merged at a time, and about as many bytes of remembered ones as a worker keeps, twice.
_MERGED_BYTES, _REMEMBERED_BYTES = 1 << 18, 32 << 20


class Remembered:
    """What strings were encoded to, in two generations of bounded size; the older one goes when the younger is full."""

    def __init__(self, limit: int = _REMEMBERED_BYTES):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self._limit, self._size = limit, 0

    def missing(self, keys) -> list[str]:
        """Those of the keys that are not known; the others are in ``young`` afterwards."""
        young, old = self.young, self.old
        unknown = []
        for key in keys:
            if key not in young:
                found = old.get(key)
                if found is None:
                    unknown.append(key)
                else:
                    self.put(key, found)
        return unknown

    def put(self, key: str, value: bytes) -> None:
        self.young[key] = value
        # two small objects and their entry
        self._size += len(key) + len(value) + 160

    def turn(self) -> None:
        """To be called when no values are being looked up."""
        if self._size > self._limit:
            self.old, self.young, self._size = self.young, {}, 0


class Encoder:
    """Encodes texts to the bytes of their ids (little-endian, 32 bits each)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._ranks, self._queue = Ranks(ranks), RankQueue(max(ranks.values(), default=0) + 1)
        self._coded = {rank: rank.to_bytes(4, "little") for rank in ranks.values()}.__getitem__
        self._find = regex.compile(pattern).findall
        self._cuttable = pattern == SPACED_PATTERN
        # parts by what follows their one leading space; pre-tokens that have none by themselves
        self._parts, self._bare = Remembered(), Remembered(_REMEMBERED_BYTES // 4)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        held: list[list[tuple[str | None, list[str]]]] = []
        size = 0
        for text in texts:
            if len(text) > 2 * arrays.BATCH_BYTES:
                # a very long text by its parts
                out += self._block(held)
                held, size = [], 0
                out.append(b"".join(self._block([part])[0] for part in self._cuts(text)))
                continue
            held.append([x for part in self._cuts(text) for x in part])
            size += len(text)
            if size > 2 << 20:
                out += self._block(held)
                held, size = [], 0
        return out + self._block(held)

    def _cuts(self, text: str):
        """Lists of a head and of parts that lack one leading space."""
        if self._cuttable:
            return ([part] for part in chunks(text))
        return [[(text, [])]] if text else [[]]

    def _block(self, texts: list[list[tuple[str | None, list[str]]]]) -> list[bytes]:
        parts, bare, find = self._parts, self._bare, self._find
        fresh = parts.missing({part for text in texts for _, found in text for part in found})
        heads = {head: find(head) for text in texts for head, _ in text if head is not None}
        # letters alone are one pre-token
        cut = {part: find(" " + part) for part in fresh if not (part.isascii() and part.isalpha())}
        single = {part for part in fresh if part not in cut}
        others: set[str] = set()
        for found in (*cut.values(), *heads.values()):
            for piece in found:
                if piece[0] == " " and len(piece) > 1 and not piece[1].isspace():
                    single.add(piece[1:])
                else:
                    others.add(piece)
        wanted = parts.missing(single)
        self._merge([(part, (" " + part).encode()) for part in wanted], parts)
        self._merge([(piece, piece.encode()) for piece in bare.missing(others)], bare)
        part_value, bare_value = parts.young.__getitem__, bare.young.__getitem__

        def value(piece: str) -> bytes:
            return part_value(piece[1:]) if piece[0] == " " and len(piece) > 1 and not piece[1].isspace() else bare_value(piece)

        for part, found in cut.items():
            if part not in parts.young:
                parts.put(part, b"".join(map(value, found)))
        out = []
        for text in texts:
            coded: list[bytes] = []
            for head, found in text:
                if head is not None:
                    coded += map(value, heads[head])
                coded += map(part_value, found)
            out.append(b"".join(coded))
        parts.turn()
        bare.turn()
        return out

    def _merge(self, pieces: list[tuple[str, bytes]], known: Remembered) -> None:
        ranks, coded, put = self._ranks, self._coded, known.put
        held: list[tuple[str, bytes]] = []
        size = 0
        for key, raw in pieces:
            whole = ranks.get(raw)
            if whole is not None:
                put(key, coded(whole))
                continue
            held.append((key, raw))
            size += len(raw)
            if size > _MERGED_BYTES:
                self._put_merged(held, known)
                held, size = [], 0
        self._put_merged(held, known)

    def _put_merged(self, held: list[tuple[str, bytes]], known: Remembered) -> None:
        put, coded = known.put, self._coded
        for (key, _), ids in zip(held, merge_all([raw for _, raw in held], self._ranks, self._queue)):
            put(key, b"".join(map(coded, ids)))


_HELD: dict[tuple, object] = {}


def held(key: tuple, make):
    """What a Python worker keeps between batches: one object per kind, made anew for another vocabulary."""
    if _HELD.get(key[0], (None,))[0] != key:
        _HELD[key[0]] = (key, make())
    return _HELD[key[0]][1]


CODED = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])


class BytePairs:
    """Column functions for one rank file. Its content is broadcast: its size is that of the vocabulary."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        arrays.bound_batches(spark)
        self._ranks: Broadcast = spark.sparkContext.broadcast(load_ranks(path))
        self._key, self._pattern = (path, pattern), pattern

    def encode(self, text: str | Column) -> Column:
        """``array<int>`` of ids, without special tokens: strings that look like them are ordinary text. Null: no ids, like empty."""
        ranks, pattern, key = self._ranks, self._pattern, ("encoder", *self._key)

        def of_batch(texts: pa.Array) -> pa.Array:
            encode = held(key, lambda: Encoder(ranks.value, pattern)).encode_all
            coded = encode([x or "" for x in texts.to_pylist()])
            offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in coded], dtype=np.int64)))
            ids = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))

        return F.arrow_udf(of_batch, returnType=T.ArrayType(T.IntegerType()))(F.col(text) if isinstance(text, str) else text)

    def round_trip(self, text: str | Column) -> Column:
        """Struct of ``ids`` (the ids as little-endian unsigned 32-bit integers, ``binary``) and ``decoded``, the bytes that they decode to.

        One call for both: a column function that takes another's result would encode every text again for each use.
        """
        ranks, pattern, key = self._ranks, self._pattern, self._key

        def of_batch(texts: pa.Array) -> pa.Array:
            encode = held(("encoder", *key), lambda: Encoder(ranks.value, pattern)).encode_all
            token = held(("decoder", *key), lambda: {rank: token for token, rank in ranks.value.items()}).__getitem__
            coded = encode([x or "" for x in texts.to_pylist()])
            decoded = [b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in coded]
            return pa.StructArray.from_arrays([pa.array(coded, pa.binary()), pa.array(decoded, pa.binary())], CODED.names)

        return F.arrow_udf(of_batch, returnType=CODED)(F.col(text) if isinstance(text, str) else text)

    def decode(self, ids: str | Column) -> Column:
        """The bytes of the ids, as ``binary``; null or no ids: no bytes. An unknown id fails."""
        ranks, key = self._ranks, ("decoder", *self._key)

        def of_batch(lists: pa.Array) -> pa.Array:
            token = held(key, lambda: {rank: token for token, rank in ranks.value.items()}).__getitem__
            return pa.array([b"".join(map(token, row.values.tolist())) if row.is_valid else b"" for row in lists], pa.binary())

        return F.arrow_udf(of_batch, returnType=T.BinaryType())(F.col(ids) if isinstance(ids, str) else ids)
