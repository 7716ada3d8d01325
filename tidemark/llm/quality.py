"""Quality rules as weak supervision.

Each rule votes good, bad or abstains. Expectation-maximisation over the votes of **all** documents estimates how
accurate each rule's votes are on either class, without labels, and a document is kept if the posterior probability that it is good reaches
``threshold``. Texts are measured in Arrow batches; the votes are column expressions; what the estimation needs from the
corpus is one row per pattern of votes (at most 3 ** number of rules), counted by Spark.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import arrays
from tidemark.session import stage

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_punctuation", "n_symbol_words", "n_bare_words",
]
_SCHEMA = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])

_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = arrays.byte_class((65, 90))
_LETTERS = arrays.byte_class((65, 90), (97, 122))
_DIGITS = arrays.byte_class((48, 57))
_MARKS = np.isin(np.arange(256), list(b"!?"))
_PUNCTUATION = arrays.byte_class((33, 47), (58, 64), (91, 96), (123, 126))
_WORD_BYTES = arrays.byte_class((48, 57), (65, 90), (97, 122), (128, 255))
_BLOCK = 1 << 20


def repeated_words(hashes: np.ndarray, rows: np.ndarray, width: int = 5) -> np.ndarray:
    """Which words lie in a ``width``-word window that the same row holds twice or more."""
    covered = np.zeros(len(hashes), bool)
    if len(hashes) < width:
        return covered
    n = len(hashes) - width + 1
    window = arrays.mix(rows[:n].astype(np.uint64) + np.uint64(1))
    for k in range(width):
        window = arrays.mix(window ^ hashes[k : k + n])
    at = np.flatnonzero(rows[:n] == rows[width - 1 :])
    _, inverse, counts = np.unique(window[at], return_inverse=True, return_counts=True)
    edges = np.zeros(len(hashes) + 1, np.int64)
    hits = at[counts[inverse] > 1]
    np.add.at(edges, hits, 1)
    np.add.at(edges, hits + width, -1)
    return np.cumsum(edges[:-1]) > 0


def _duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line.strip():
            if line in seen:
                found += 1
            else:
                seen.add(line)
    return found


def measure_texts(column: pa.Array) -> pa.Array:
    """The :data:`MEASURES` of each text, as a struct array."""
    out = {name: np.zeros(len(column), np.int64) for name in MEASURES}
    for first, last, data, offsets in arrays.row_blocks(column, _BLOCK):
        count = last - first
        starts, ends = arrays.word_spans(data, offsets, arrays.NOT_SPACE)
        rows = arrays.rows_of(starts, offsets)
        part = {"n_words": arrays.per_row(rows, count)}

        def count_bytes(where: np.ndarray, offsets=offsets, count=count) -> np.ndarray:
            return arrays.per_row(arrays.rows_of(np.flatnonzero(where), offsets), count)

        part["word_chars"] = count_bytes(arrays.NOT_SPACE[data] & ((data & 0xC0) != 0x80))
        for name, table in (("n_symbols", _SYMBOLS), ("n_upper", _UPPER), ("n_letters", _LETTERS), ("n_digits", _DIGITS), ("n_marks", _MARKS), ("n_punctuation", _PUNCTUATION)):
            part[name] = count_bytes(table[data])
        for name, table, held in (("n_symbol_words", _SYMBOLS, True), ("n_bare_words", _WORD_BYTES, False)):
            sums = np.concatenate(([0], np.cumsum(table[data], dtype=np.int32)))
            part[name] = arrays.per_row(rows[(sums[ends] > sums[starts]) == held], count)
        part["n_lines"] = count_bytes(data == 10) + 1
        repeated = repeated_words(arrays.hash_spans(data, starts, ends), rows)
        part["n_repeat_words"] = arrays.per_row(rows[repeated], count)
        whole = data.tobytes()
        part["n_dup_lines"] = np.array([_duplicate_lines(whole[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], np.int64)
        for name, values in part.items():
            out[name][first:last] = values
    return pa.StructArray.from_arrays([pa.array(out[name]) for name in MEASURES], MEASURES)


def measures(text: str | Column) -> Column:
    """Struct of :data:`MEASURES` of a text column; a null text measures like an empty one (one empty line)."""
    return F.arrow_udf(measure_texts, returnType=_SCHEMA)(arrays.utf8(text))


@dataclass(frozen=True)
class Rule:
    """``bad`` is looked at first; where neither holds (or is null) the rule abstains."""

    name: str
    bad: Callable[[Callable[[str], Column]], Column]
    good: Callable[[Callable[[str], Column]], Column]


RULES = (
    Rule("length", lambda m: m("n_words") < 10, lambda m: m("n_words") >= 30),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 14 * m("n_words")),
         lambda m: (m("word_chars") >= 3 * m("n_words")) & (m("word_chars") <= 10 * m("n_words"))),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words"), lambda m: 50 * m("n_symbols") < m("n_words")),
    Rule("symbol_words", lambda m: 5 * m("n_symbol_words") > m("n_words"), lambda m: 50 * m("n_symbol_words") < m("n_words")),
    Rule("bare_words", lambda m: 10 * m("n_bare_words") > m("n_words"), lambda m: F.lit(False)),
    Rule("punctuation", lambda m: 100 * m("n_punctuation") > 12 * m("word_chars"), lambda m: 100 * m("n_punctuation") < 8 * m("word_chars")),
    Rule("repeated_words", lambda m: 5 * m("n_repeat_words") > m("n_words"), lambda m: 20 * m("n_repeat_words") < m("n_words")),
    Rule("repeated_lines", lambda m: 10 * m("n_dup_lines") > 3 * m("n_lines"), lambda m: F.lit(False)),
    Rule("capitals", lambda m: (m("n_letters") >= 20) & (2 * m("n_upper") > m("n_letters")), lambda m: F.lit(False)),
    Rule("digits", lambda m: 3 * m("n_digits") > m("word_chars"), lambda m: F.lit(False)),
    Rule("exclamation", lambda m: 5 * m("n_marks") > m("n_words"), lambda m: F.lit(False)),
)


def votes(measured: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """One character per rule: ``+`` good, ``-`` bad, ``0`` no vote."""

    def vote(rule: Rule) -> Column:
        get = lambda name: F.col(f"{measured}.{name}")
        return F.when(rule.bad(get), "-").when(rule.good(get), "+").otherwise("0")

    return F.concat(*[vote(rule) for rule in rules])


#: Chances of the votes ``-``, ``0``, ``+`` of a rule on good and on bad documents, before any are seen.
PRIOR_GOOD, PRIOR_BAD, PRIOR_SHARE = (0.02, 0.38, 0.6), (0.4, 0.3, 0.3), 0.85


@dataclass(frozen=True)
class VoteModel:
    """``good[j, v]``, ``bad[j, v]``: chance that rule ``j`` votes ``v`` (of ``-0+``) on a good or bad document."""

    good: np.ndarray
    bad: np.ndarray
    share: float

    def evidence(self) -> np.ndarray:
        """Log odds that each vote of each rule adds; an abstention adds nothing."""
        odds = np.log(self.good / self.bad)
        odds[:, 1] = 0
        return odds

    def prior_odds(self) -> float:
        return float(np.log(self.share / (1 - self.share)))


def estimate(patterns: list[tuple[str, int]], rules: int, rounds: int = 200, strength: float = 0.05) -> VoteModel:
    """Vote chances of the rules and the share of good documents, from counted vote patterns.

    The prior weighs as much as the share ``strength`` of all documents, so the result does not depend on the size of
    the corpus, and it tells which class is the good one. With no documents the prior itself comes back.
    """
    model = VoteModel(np.tile(PRIOR_GOOD, (rules, 1)), np.tile(PRIOR_BAD, (rules, 1)), PRIOR_SHARE)
    total = float(sum(n for _, n in patterns))
    if not total:
        return model
    weight = np.array([n / total for _, n in patterns])
    cast = np.array([[[float(c == v) for v in "-0+"] for c in pattern] for pattern, _ in patterns])
    for _ in range(rounds):
        odds = model.prior_odds() + np.einsum("prv,rv->p", cast, model.evidence())
        good = 1 / (1 + np.exp(-odds))

        def chances(belief: np.ndarray, prior: tuple[float, ...]) -> np.ndarray:
            counted = np.einsum("p,prv->rv", weight * belief, cast)
            return (counted + strength * np.array(prior)) / ((weight * belief).sum() + strength)

        share = float(np.clip(((weight * good).sum() + PRIOR_SHARE * strength) / (1 + strength), 0.05, 0.95))
        new = VoteModel(chances(good, PRIOR_GOOD), chances(1 - good, PRIOR_BAD), share)
        moved = max(np.abs(new.good - model.good).max(), np.abs(new.bad - model.bad).max())
        model = new
        if moved < 1e-9:
            break
    return model


def score_quality(docs: DataFrame, text: str = "text", keep: list[str] | None = None, threshold: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row`` (struct of the columns in ``keep``, default all), ``measures``, ``votes``, ``quality``, ``base_failed``, ``kept``.

    A document whose text is null or empty has no words: it fails the base check (fewer than 10 words, or over a fifth of
    its words in repeated windows) and is not kept. Repeated rows are measured and counted one by one. An empty table gives no
    rows. Input columns travel in ``row``, so their names cannot clash. The measured rows are written once below
    ``spark.checkpoint.dir``; both the count of patterns and the result read them there.
    """
    arrays.bound_batches(docs.sparkSession)
    carried = F.struct(*[F.col(f"`{name}`") for name in (docs.columns if keep is None else keep)])
    measured = stage(docs.select(carried.alias("row"), measures(text).alias("measures")).select("*", votes("measures", rules).alias("votes")), "quality")
    patterns = [(r["votes"], r["n"]) for r in measured.groupBy("votes").agg(F.count("*").alias("n")).collect()]
    model = estimate(sorted(patterns), len(rules))
    odds = F.lit(model.prior_odds())
    for k, (against, _, favour) in enumerate(model.evidence().tolist()):
        cast = F.substring("votes", k + 1, 1)
        odds = odds + F.when(cast == "+", favour).when(cast == "-", against).otherwise(0.0)
    m = lambda name: F.col(f"measures.{name}")
    failed = (m("n_words") < 10) | (100 * m("n_repeat_words") > 20 * m("n_words"))
    return (
        measured.withColumn("quality", 1 / (1 + F.exp(-odds)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    )
