"""Removal of repeated substrings against brute force, and its suffix arrays against sorting."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import suffix_dedup
from tidemark.llm.suffix_dedup import _words, common_prefixes, merged_spans, remove_repeats, runs_of, sliding_minimum, suffix_array


def texts_of(kind, seed, n=60):
    rng = random.Random(seed)
    if kind == "words":
        words = ["".join(rng.choices("abcdé", k=rng.randint(1, 5))) for _ in range(12)]
        return [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(n)]
    if kind == "passages":
        passages = ["".join(rng.choices("abcdefgh", k=30)) for _ in range(4)]
        return ["".join(rng.choices("abcdefgh", k=20)) + rng.choice(passages) + "".join(rng.choices("abcdefgh", k=9)) for _ in range(n)]
    if kind == "near copies":
        base = rng.choices("abcdefgh", k=150)
        out = []
        for _ in range(n):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice("xyz")
            out.append("".join(text))
        return out
    return ["ab" * rng.randint(0, 200) + "x" * rng.randint(0, 50) for _ in range(n)]


def found(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = remove_repeats(docs, keep=["doc_id"], **options).select("row.doc_id", "n_bytes", "n_removed", "spans", "kept").collect()
    return {r[0]: (r[1], r[2], list(r[3]), bytes(r[4])) for r in rows}


def expected(texts, length):
    out = {}
    for k, (text, spans) in enumerate(zip(texts, brute.repeated_spans(texts, length))):
        raw = (text or "").encode()
        edges = [0, *[x for s in spans for x in s], len(raw)]
        kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
        out[k] = (len(raw), len(raw) - len(kept), [x for s in spans for x in s], kept)
    return out


@pytest.mark.parametrize("kind", ["words", "passages", "near copies", "periodic"])
@pytest.mark.parametrize("shard_bytes", [150, 1 << 20])
def test_against_brute_force(spark, kind, shard_bytes):
    texts = texts_of(kind, 5)
    texts += texts[:3]
    assert found(spark, texts, length=20, gram=5, shard_bytes=shard_bytes) == expected(texts, 20)


def test_nulls_empty_short_and_repeated_rows(spark):
    texts = [None, "", None, "short", "short", "x" * 20, "y" * 19, "z" * 21, "abcdefghij" * 2, "abcdefghij" * 2, None]
    assert found(spark, texts, length=20, gram=5) == expected(texts, 20)


def test_very_long_texts(spark, monkeypatch):
    rng = random.Random(1)
    long = "".join(rng.choices("abcdefghij", k=1_300_000))
    texts = [long[:700_000] + long[100:900], long[690_000:] + "q" * 5000, "w" + long[5000:5399], "w" + long[5000:5400]]
    assert found(spark, texts) == expected(texts, 400)


def test_empty_table_and_clashing_names(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    plain = spark.createDataFrame([(1, "a" * 30), (2, "b")], "doc_id long, text string")
    clashing = plain.select("*", *[F.lit(7).alias(name) for name in ("doc", "row", "name", "at", "kept", "spans", "first", "last", "p")])
    rows = remove_repeats(clashing, length=20, gram=5).select("row.*", "n_removed").collect()
    assert sorted((r["doc_id"], r["kept"], r["n_removed"]) for r in rows) == [(1, 7, 30), (2, 7, 0)]


@pytest.mark.parametrize("alphabet", [b"a", b"ab", bytes(range(256)), b"\0\1"])
@pytest.mark.parametrize("lengths", [[1], [2, 2], [9, 1, 30], [200, 200, 200, 7]])
def test_suffix_array_and_prefixes(alphabet, lengths, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_LANES", 7)
    pieces = [bytes(random.Random(k % 2).choices(alphabet, k=k)) for k in lengths]
    raw, offsets = b"".join(pieces), np.cumsum([0, *lengths])
    piece = np.repeat(np.arange(len(pieces)), lengths)
    limit = offsets[1:][piece]
    suffix = lambda i: raw[i : limit[i]]
    words = _words(np.frombuffer(raw, np.uint8), limit)
    order = suffix_array(words, limit, piece)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: (suffix(i), piece[i]))
    prefixes = common_prefixes(words, limit, order, 50)
    for k in range(1, len(raw)):
        a, b = suffix(order[k - 1]), suffix(order[k])
        same = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert prefixes[k] == min(same, 50)


def test_names_depend_on_windows_alone():
    raw = np.frombuffer(bytes(random.Random(2).choices(b"abc", k=3000)), np.uint8)
    name = lambda data: {bytes(data[i : i + 30]): n for m, f, c, _ in [runs_of(data, 30, 6)] for n, a, k in zip(m, f, c) for i in range(a, a + k)}
    whole, part = name(raw), name(raw[1000:2000])
    assert all(whole[w] == n for w, n in part.items()) and len(part) > 900
    least = sliding_minimum(np.array([5, 3, 4, 9, 8, 7], np.uint64), 3)
    assert least.tolist() == [3, 3, 4, 7]


def test_spans_are_joined():
    first, last = np.array([30, 0, 5, 10, 20]), np.array([40, 10, 8, 12, 30])
    assert merged_spans(first, last).tolist() == [0, 12, 20, 40]
