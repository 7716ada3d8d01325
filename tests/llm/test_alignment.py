"""Token alignment against the libraries, token by token."""

import random

import brute
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment
from tidemark.llm.alignment import Alignment, overlaps

CHARACTERS = "ab .,\n\t  éß漢字\u2581😀<s></s><|endoftext|>'s0123\0\u200b\u3000\xa0"
ODD = [None, "", " ", "  ", "\n", "  a  b ", "a  b", "<s> x", "<0x41> y", "\ufeffa", "\0a b", "ﬁ x", "a \u2581b c", "\u2581", "a b\u2581"]


@pytest.fixture(scope="module")
def both(spark):
    return Alignment(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def rows_of(both, spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    aligned = docs.select("doc_id", both.align("text").alias("s")).select("doc_id", "s.*").cache()
    size = F.size("links").cast("long")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    shown = aligned.select("doc_id", "n_a", "n_b", size.alias("g"), size.alias("n_links"), both.weigh(aligned).alias("w"), digest.alias("d"))
    return sorted(map(tuple, shown.select("doc_id", "n_a", "n_b", "g", "n_links", "w.n_best", "w.count_sum", "d").collect()))


def test_against_the_libraries(spark, both):
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choices(CHARACTERS, k=rng.randint(0, 60))) for _ in range(300)] + ["a text. A text, twice"] * 3
    assert rows_of(both, spark, texts) == [(k, *x) for k, x in enumerate(brute.alignments(texts))]


def test_long_texts_go_on_in_the_next_block(spark, both, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=n)) for n in (120_000, 3, 90_000)] + ["x" * 3000, "long\n" * 4000]
    import pyarrow as pa

    whole = alignment.Aligner(both.a, both.b, both.pairs).texts(pa.array(texts))
    monkeypatch.setattr(alignment, "_BLOCK_CHARS", 300_000)
    monkeypatch.setattr(alignment, "_CALL_CHARS", 100)
    assert alignment.Aligner(both.a, both.b, both.pairs).texts(pa.array(texts)).equals(whole)
    assert whole[3]["n_a"].as_py() == len(brute.two_tokenizers()[0][0](texts[3]))


def test_overlaps_of_two_cuts():
    a = pd.DataFrame({"key": [0, 0, 1], "start": [0, 3, 9], "end": [3, 9, 12]})
    b = pd.DataFrame({"key": [0, 0, 0, 1, 1], "start": [0, 2, 5, 9, 10], "end": [2, 5, 9, 10, 12]})
    assert overlaps(a, b).values.tolist() == [[0, 0], [0, 1], [1, 1], [1, 2], [2, 3], [2, 4]]


def test_counts_by_pair_and_empty_table(spark, both):
    docs = spark.createDataFrame([(1, "the cat the cat"), (2, "the")], "doc_id long, text string")
    aligned = docs.select(both.align("text").alias("s")).select("s.*")
    counts = {(r["id_a"], r["id_b"]): r["links"] for r in both.link_counts(aligned).collect()}
    assert sorted(counts.values()) == [2, 3]
    nothing = docs.where("doc_id > 5").select("doc_id", both.align("text").alias("s")).select("doc_id", "s.*")
    assert nothing.select("doc_id", both.weigh(nothing)).collect() == []


def test_clashing_names(spark, both):
    docs = spark.createDataFrame([(1, "a b", 5, 6)], "links long, text string, n_a long, groups long")
    row = docs.select("links", "n_a", both.align("text").alias("s")).select("links", "n_a", F.col("s.n_a").alias("found")).first()
    assert (row["links"], row["n_a"], row["found"]) == (1, 5, 2)


def test_other_files_are_refused():
    with pytest.raises((ValueError, KeyError)):
        alignment.byte_level_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
