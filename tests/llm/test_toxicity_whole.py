"""Toxicity scores see the whole sequence of words, the whole of each training text, and the counted share of labels."""

import random

from tidemark.llm import toxicity


def test_windows_keep_repeats_and_their_order():
    assert toxicity.words_of(b"One two, one. TWO") == [b"one", b"two", b"one", b"two"]
    late = toxicity.windows_of(toxicity.words_of(b"you are a poor man, he is a sad scum; you poor scum"))
    assert b" you poor scum " in late and len(late) == 12
    model = toxicity.fit([b"you moron scum"] * 3, [b"good day to you"] * 3, 0.5)
    assert len(model.gains(b"scum moron " * 50)) == 99


def test_training_reads_whole_texts(spark):
    draw = random.Random(5)
    told = lambda n: " ".join("".join(draw.choices(["ka", "lo", "mi", "tu", "ne"], k=3)) for _ in range(n))
    rows = [(k, told(3000) + (" moron scum worthless" if k % 2 else " good day to you")) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(120)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    assert b"moron" in model.toxic or b"scum" in model.toxic
    score = {r[0]: r[1] for r in docs.select("doc_id", model.score(docs)).collect()}
    assert sum((score[k] >= 0.5) == (k % 2 == 1) for k in score) > 110


def test_rare_labels_keep_their_share():
    assert toxicity.label_share({0: 99_900, 1: 100}) == 101 / 100_002
    assert toxicity.label_share({0: 1, 1: 997}) == 998 / 1000
