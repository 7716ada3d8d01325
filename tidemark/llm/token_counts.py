"""Token counts by the whole-token shortcut.

Before any text is read, the merges are run on every string of the vocabulary alone. Strings that come out as one token form a set;
a pre-token in that set counts one without being merged, and only the rest is merged.
"""

from __future__ import annotations

import heapq
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.llm.bpe import held
from tidemark.llm.pretokens import SPACED_PATTERN, Pretokenizer


def byte_letters() -> dict[str, int]:
    """The visible character that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + k): b for k, b in enumerate(rest)}}


@dataclass(frozen=True)
class Merges:
    """``alone``: id of each byte; ``pairs``: (id, id) -> (rank, id of the merged token); ``whole``: proved whole tokens; ``special``: strings cut out first."""

    alone: list[int]
    pairs: dict[tuple[int, int], tuple[int, int]]
    whole: frozenset[str]
    special: tuple[str, ...]


def merge_ids(ids: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge by rank, the leftmost of equal ranks first."""
    n = len(ids)
    ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(*pairs[pair], i, pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in pairs]
    heap = [(rank, i, pair, new) for rank, new, i, pair in heap]
    heapq.heapify(heap)
    while heap:
        _, i, pair, new = heapq.heappop(heap)
        gone = after[i]
        if ids[i] < 0 or gone >= n or (ids[i], ids[gone]) != pair:
            continue
        ids[i], ids[gone], end = new, -1, after[gone]
        after[i] = end
        for a, b in ((before[i], i), (i, end)):
            if a >= 0 and b < n and (around := (ids[a], ids[b])) in pairs:
                rank, made = pairs[around]
                heapq.heappush(heap, (rank, a, around, made))
        if end < n:
            before[end] = i
    return [x for x in ids if x >= 0]


def load_merges(path: str) -> Merges:
    """Merges of a byte-level BPE file, with the strings proved whole. Other kinds of files are refused."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split, model = spec["pre_tokenizer"], spec["model"]
    if spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
        raise ValueError(f"{path} is not cut into pre-tokens by the byte-level rule alone")
    if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        raise ValueError(f"{path} is not a plain BPE vocabulary")
    added = spec["added_tokens"]
    if any(token[k] for token in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path} has added tokens with conditions")
    vocabulary, letters = model["vocab"], byte_letters()
    alone = [0] * 256
    for letter, byte in letters.items():
        alone[byte] = vocabulary[letter]
    steps = [step.split(" ") if isinstance(step, str) else step for step in model["merges"]]
    pairs = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in reversed(list(enumerate(steps)))}
    special = tuple(sorted((token["content"] for token in added), key=lambda s: (-len(s), s)))
    whole = set()
    for token, number in vocabulary.items():
        if all(letter in letters for letter in token):
            raw = bytes(letters[letter] for letter in token)
            if merge_ids([alone[b] for b in raw], pairs) == [number]:
                try:
                    whole.add(raw.decode())
                except UnicodeDecodeError:
                    pass  # no pre-token is cut inside a character
    return Merges(alone, pairs, frozenset(whole), special)


class Counter:
    """Counts the tokens of a text; special strings inside it count one each."""

    def __init__(self, merges: Merges, pattern: str):
        alone, pairs, whole = merges.alone, merges.pairs, merges.whole

        def tokens(piece: str) -> int:
            return 1 if piece in whole else len(merge_ids([alone[b] for b in piece.encode()], pairs))

        self._cut = Pretokenizer(pattern, tokens, sum)
        self._special = re.compile("|".join(map(re.escape, merges.special))) if merges.special else None

    def count(self, text: str) -> int:
        parts = self._special.split(text) if self._special else [text]
        return len(parts) - 1 + sum(map(self._cut.of, parts))


def token_counter(spark: SparkSession, path: str, pattern: str = SPACED_PATTERN):
    """A function from a text column to its number of tokens (long). Null and empty texts have none.

    The merges and the proved set are broadcast: their size is that of the vocabulary.
    """
    arrays.bound_batches(spark)
    shared, key = spark.sparkContext.broadcast(load_merges(path)), ("counter", path, pattern)

    def of_batch(texts: pa.Array) -> pa.Array:
        count = held(key, lambda: Counter(shared.value, pattern)).count
        return pa.array([count(x.as_py()) if x.is_valid else 0 for x in texts], pa.int64())

    def tokens(text: str | Column) -> Column:
        return F.arrow_udf(of_batch, returnType=T.LongType())(F.col(text) if isinstance(text, str) else text)

    return tokens
