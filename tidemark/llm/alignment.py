"""Alignment of two tokenizations of the same texts by their byte ranges.

In each batch the tokens of either side are a pandas frame of starts and ends, keyed by the piece of text they lie in. ``merge_asof`` finds for every
token start the other side's token that covers it; both directions together give all overlaps. Overlapping tokens that
end together are linked, and close a group. Texts are cut into pieces at single spaces between other characters: both tokenizers
provably begin a token there, so a piece's tokens do not depend on what stands around it, and pieces that a batch repeats are aligned once.

How often two ids are linked in the whole corpus is counted in Spark. One token of a link ends with the other, so the pairs of ids
that can be linked follow from the vocabularies (:func:`possible_pairs`), whatever the corpus: their table bounds all that is broadcast.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.bpe import held
from tidemark.llm.pretokens import SINGLE_SPACE, segments
from tidemark.llm.token_counts import byte_letters

#: Text that is aligned at a time, and text that goes to a tokenizer in one call.
_BLOCK_CHARS, _CALL_CHARS = 2 << 20, 1 << 15


# --- the two tokenizers -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of every id, and the file that the library reads; ``kind`` is ``bytes`` (.json) or ``pieces`` (.model)."""

    kind: str
    content: bytes
    tokens: tuple[bytes, ...]

    def encoder(self):
        """A function from a piece of text, to which a space is put in front, to ids."""
        if self.kind == "bytes":
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(self.content.decode())
            tokenizer.encode_special_tokens = True
            return lambda text: tokenizer.encode(" " + text, add_special_tokens=False).ids
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.content).encode


def byte_level_vocabulary(path: str) -> Vocabulary:
    """A byte-level BPE file of the ``tokenizers`` library. Others, and those with another pattern, are refused."""
    with open(path, "rb") as file:
        content = file.read()
    spec = json.loads(content)
    split = spec["pre_tokenizer"]
    if spec["normalizer"] or spec["model"]["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
        raise ValueError(f"{path} is no plain byte-level BPE file")
    letters = byte_letters()
    names = {number: name for name, number in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    special = {t["id"] for t in spec["added_tokens"]}
    tokens = [b"" if k in special or k not in names else bytes(letters[c] for c in names[k]) for k in range(max(names) + 1)]
    return Vocabulary("bytes", content, tuple(tokens))


def piece_vocabulary(path: str) -> Vocabulary:
    """A ``sentencepiece`` model that puts a space in front of texts, and none of whose pieces has a space after another character."""
    from sentencepiece import SentencePieceProcessor

    with open(path, "rb") as file:
        content = file.read()
    model = SentencePieceProcessor(model_proto=content)
    tokens = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            tokens.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            tokens.append(b"")
        else:
            tokens.append(piece.replace("▁", " ").encode())
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"{path} has pieces that go on after a space; texts cannot be cut there")
    return Vocabulary("pieces", content, tuple(tokens))


def possible_pairs(a: Vocabulary, b: Vocabulary) -> np.ndarray:
    """All ``id of a << 32 | id of b`` whose bytes end alike, sorted. At most one for each suffix of each token and id that has its bytes."""
    by_bytes: tuple[dict[bytes, list[int]], ...] = ({}, {})
    for known, vocabulary in zip(by_bytes, (a, b)):
        for number, token in enumerate(vocabulary.tokens):
            if token:
                known.setdefault(token, []).append(number)
    found = []
    for token, numbers in by_bytes[0].items():
        others = [k for cut in range(len(token)) for k in by_bytes[1].get(token[cut:], ())]
        found += [n << 32 | k for n in numbers for k in others]
    for token, numbers in by_bytes[1].items():
        others = [n for cut in range(1, len(token)) for n in by_bytes[0].get(token[cut:], ())]
        found += [n << 32 | k for k in numbers for n in others]
    return np.sort(np.array(found, np.int64))


# --- aligning ---------------------------------------------------------------------------------------------------------


def token_frame(encode, tokens: tuple[bytes, ...], sizes: np.ndarray, pieces: list[str]) -> tuple[pd.DataFrame, np.ndarray]:
    """``key, start, end, id`` of the tokens of every piece behind a space, by position, and which pieces the tokens spell out.

    Positions run on over the pieces. Pieces without white space at their ends are put behind each other for one call.
    """
    lengths = np.array([len(p.encode()) + 1 for p in pieces], np.int64)
    base = np.cumsum(lengths) - lengths
    spaced = [p[0].isspace() or p[-1].isspace() for p in pieces]
    ids: list[np.ndarray] = []
    keys: list[np.ndarray] = []
    starts: list[np.ndarray] = []
    right = np.ones(len(pieces), bool)

    def alone(k: int) -> None:
        found = encode(pieces[k])
        if b"".join([tokens[i] for i in found]) != b" " + pieces[k].encode():
            right[k] = False
            return
        found = np.array(found, np.int64)
        ids.append(found)
        keys.append(np.full(len(found), k))
        starts.append(base[k] + np.cumsum(sizes[found]) - sizes[found])

    first = 0
    while first < len(pieces):
        last, room = first, _CALL_CHARS
        while last < len(pieces) and room > 0 and not spaced[last]:
            room -= len(pieces[last]) + 1
            last += 1
        if last - first > 1:
            text = " ".join(pieces[first:last])
            found = encode(text)
            if b"".join([tokens[i] for i in found]) == b" " + text.encode():
                found = np.array(found, np.int64)
                begin = base[first] + np.cumsum(sizes[found]) - sizes[found]
                ids.append(found)
                starts.append(begin)
                keys.append(first + np.searchsorted(base[first:last], begin, "right") - 1)
                first = last
                continue
        last = max(last, first + 1)
        for k in range(first, last):
            alone(k)
        first = last
    joined = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, starts, ids)]
    frame = pd.DataFrame({"key": joined[0], "start": joined[1], "id": joined[2]})
    frame["end"] = frame["start"] + sizes[joined[2]]
    return frame, right


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Rows ``a, b`` (row numbers) of all tokens of one key that share bytes: who covers each start, asked from both sides."""
    a, b = a.assign(a=np.arange(len(a))), b.assign(b=np.arange(len(b)))
    covered = pd.merge_asof(a[["key", "start", "a"]], b[["key", "start", "b"]], on="start", by="key")
    covering = pd.merge_asof(b[["key", "start", "b"]], a[["key", "start", "a"]], on="start", by="key")
    both = pd.concat([covered[["a", "b"]], covering[["a", "b"]]], ignore_index=True).drop_duplicates()
    return both.sort_values(["a", "b"], ignore_index=True)


@dataclass
class Aligned:
    """Of every piece: counts of tokens, its groups as text, and its links as numbers in the table of pairs, ``first[k]`` to ``first[k + 1]``."""

    right: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    groups: list[str]
    first: np.ndarray
    links: np.ndarray


class Aligner:
    def __init__(self, a: Vocabulary, b: Vocabulary, pairs: np.ndarray):
        self._sides = [(v.encoder(), v.tokens, np.array([len(t) for t in v.tokens], np.int64)) for v in (a, b)]
        # an id as text with what follows it: another one of its group and side, or what closes the side
        self._names = [[np.array([f"{k}{mark}" for k in range(len(v.tokens))], object) for mark in (",", close)] for v, close in ((a, "|"), (b, ";"))]
        self._pairs = pairs

    def pieces(self, pieces: list[str]) -> Aligned:
        """Aligns pieces of text, each behind a space. What either side does not spell out has no tokens."""
        (a, right_a), (b, right_b) = [token_frame(*side, pieces) for side in self._sides]
        right = right_a & right_b
        a, b = [x[right[x["key"]]].reset_index(drop=True) for x in (a, b)]
        both = overlaps(a, b)
        ends_a, ends_b = a["end"].to_numpy(), b["end"].to_numpy()
        linked = both[ends_a[both["a"]] == ends_b[both["b"]]]
        ia, ib = linked["a"].to_numpy(), linked["b"].to_numpy()
        id_a, id_b = a["id"].to_numpy(), b["id"].to_numpy()
        key = a["key"].to_numpy()[ia]
        links = np.searchsorted(self._pairs, id_a[ia] << 32 | id_b[ib])
        first = np.searchsorted(key, np.arange(len(pieces) + 1))
        counts = [np.bincount(x["key"], minlength=len(pieces)) for x in (a, b)]
        del a, b, both, linked
        # the groups as one run of words: of each group first the tokens of a, then those of b
        words = np.empty(len(id_a) + len(id_b), object)
        for names, ids, last, others in ((self._names[0], id_a, ia, np.r_[0, ib[:-1] + 1]), (self._names[1], id_b, ib, ia + 1)):
            nth = np.arange(len(ids))
            closes = np.zeros(len(ids), bool)
            closes[last] = True
            words[nth + others[np.searchsorted(last, nth)]] = np.where(closes, names[1][ids], names[0][ids])
        edges = np.concatenate(([0], np.cumsum(counts[0] + counts[1]))).tolist()
        words = words.tolist()
        whole = ["".join(words[i:j])[:-1] for i, j in zip(edges, edges[1:])]
        return Aligned(right, counts[0], counts[1], whole, first, links)

    def texts(self, texts: pa.Array) -> pa.Array:
        rows = len(texts)
        n_a, n_b = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        wrong = np.zeros(rows, bool)
        groups: list[list[str]] = [[] for _ in range(rows)]
        links: list[list[np.ndarray]] = [[] for _ in range(rows)]
        for block in _blocks(texts):
            number: dict[str, int] = {}
            codes = [number.setdefault(piece, len(number)) for _, found in block for piece in found]
            owner = np.repeat([row for row, _ in block], [len(found) for _, found in block])
            done = self.pieces(list(number))
            shown = list(map(done.groups.__getitem__, codes))
            codes = np.array(codes)
            wrong |= np.bincount(owner, ~done.right[codes], rows) > 0
            n_a += np.bincount(owner, done.n_a[codes], rows).astype(np.int64)
            n_b += np.bincount(owner, done.n_b[codes], rows).astype(np.int64)
            low, counts = done.first[codes], (done.first[1:] - done.first[:-1])[codes]
            upto = np.cumsum(counts)
            flat = done.links[np.repeat(low - (upto - counts), counts) + np.arange(upto[-1] if len(upto) else 0)].astype(np.int32)
            at = 0
            for row, found in block:
                end = at + len(found)
                groups[row].append(";".join(shown[at:end]))
                # a copy: a slice would keep the whole block
                links[row].append(flat[upto[at] - counts[at] : upto[end - 1]].copy())
                at = end
            # not beside the next block's
            del number, codes, owner, done, shown, low, counts, upto, flat
        for row in np.flatnonzero(wrong).tolist():
            n_a[row] = n_b[row] = 0
            groups[row], links[row] = [], []
        flat = [np.concatenate(x) if x else np.empty(0, np.int32) for x in links]
        offsets = np.cumsum([0, *map(len, flat)]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *flat])))
        return pa.StructArray.from_arrays([pa.array(n_a), pa.array(n_b), pa.array([";".join(x) for x in groups], pa.string()), listed], ALIGNED.names)


def _blocks(texts: pa.Array) -> Iterator[list[tuple[int, list[str]]]]:
    """Pieces of the texts by row, in blocks of about :data:`_BLOCK_CHARS`; a long text goes on in the next block."""
    block: list[tuple[int, list[str]]] = []
    size = 0
    for row, text in enumerate(texts):
        for _, segment in segments(text.as_py() or "") if text.is_valid else ():
            if segment:
                block.append((row, SINGLE_SPACE.split(segment)))
                size += len(segment)
            if size >= _BLOCK_CHARS:
                yield block
                block, size = [], 0
    if block:
        yield block


ALIGNED = T.StructType([
    T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()),
    T.StructField("groups", T.StringType()),
    T.StructField("links", T.ArrayType(T.IntegerType())),
])
COUNTED = T.StructType([T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])


class Alignment:
    """Aligns texts under two vocabularies. Broadcast: both files and the table of possible pairs, as large as the vocabularies make them."""

    def __init__(self, spark: SparkSession, path_a: str, path_b: str):
        arrays.bound_batches(spark)
        self._spark = spark
        self.a, self.b = byte_level_vocabulary(path_a), piece_vocabulary(path_b)
        self.pairs = possible_pairs(self.a, self.b)
        self._shared = spark.sparkContext.broadcast((self.a, self.b, self.pairs))
        self._key = ("aligner", path_a, path_b)

    def align(self, text: str | Column) -> Column:
        """Struct of ``n_a`` and ``n_b`` (tokens of either side), ``groups`` (``a1,a2|b1;a3|b2,b3``) and ``links``, one number in ``pairs`` for each link.

        Tokens are those of a space and the text, without special ones, whose strings are plain text. A null or empty text, or
        one whose bytes either side's tokens do not spell out, has no tokens, groups or links.
        """
        shared, key = self._shared, self._key

        def of_batch(texts: pa.Array) -> pa.Array:
            return held(key, lambda: Aligner(*shared.value)).texts(texts)

        return F.arrow_udf(of_batch, returnType=ALIGNED)(F.col(text) if isinstance(text, str) else text)

    def link_counts(self, aligned: DataFrame, links: str = "links") -> DataFrame:
        """``id_a, id_b, links`` of every pair that is linked somewhere in ``aligned``; counts are combined before they are shuffled."""
        table = self._spark.createDataFrame(pd.DataFrame({"pair": np.arange(len(self.pairs)), "id_a": self.pairs >> 32, "id_b": self.pairs & 0xFFFFFFFF}))
        return self._counted(aligned, links).join(table, "pair").select("pair", "id_a", "id_b", "links")

    def _counted(self, aligned: DataFrame, links: str) -> DataFrame:
        return aligned.select(F.explode(links).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("links"))

    def weigh(self, aligned: DataFrame, links: str = "links") -> Column:
        """Struct of ``n_best``, the links whose count is the highest of their B id, and ``count_sum`` over a row's links.

        Counts all links of ``aligned`` at once: give it a written table. At most one number for each possible pair reaches the driver.
        """
        found = self._counted(aligned, links).toArrow()
        counts = np.zeros(len(self.pairs), np.int64)
        counts[found["pair"].to_numpy()] = found["links"].to_numpy()
        id_b = self.pairs & 0xFFFFFFFF
        highest = np.zeros(len(self.b.tokens), np.int64)
        np.maximum.at(highest, id_b, counts)
        shared = self._spark.sparkContext.broadcast((counts, counts == highest[id_b]))

        def of_batch(lists: pa.Array) -> pa.Array:
            count, best = shared.value
            offsets = lists.offsets.to_numpy().astype(np.int64)
            pairs = lists.values.to_numpy()[offsets[0] : offsets[-1]]
            ends = offsets[1:] - offsets[0]
            sums = [np.concatenate(([0], np.cumsum(x[pairs], dtype=np.int64))) for x in (best, count)]
            return pa.StructArray.from_arrays([pa.array(np.diff(s[np.concatenate(([0], ends))])) for s in sums], COUNTED.names)

        return F.arrow_udf(of_batch, returnType=COUNTED)(F.coalesce(F.col(links), F.array().cast("array<int>")))

