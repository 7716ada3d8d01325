"""Quality rules, decontamination, fingerprints and line dedup against their plain-Python versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import arrays, components, decontam, line_dedup, quality, simhash

VOCABULARY = ["a", "bb", "the", "Éa", "x|y", "12", "!!", "日本", "Zz", "#", "tail."]
TEXTS = st.text(alphabet="aB é\n\t#1日|", max_size=60)


def frame(spark, texts, ids=None):
    rows = [(i, t, None, "s", 1, True) for i, t in zip(ids or range(len(texts)), texts)]
    # names that the operators use inside
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, row string, fp int, kept boolean")


def sentence(n, seed, words=VOCABULARY):
    draw = random.Random(seed)
    return " ".join(draw.choice(words) for _ in range(n))


EDGE = [None, "", " \n ", "one", "a b c d e " * 3, "\n\n", "x" * 5000, sentence(300, 1), sentence(300, 1), "İ" * 3 + "\x00"]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_measures_equal_brute_force(texts):
    got = quality.measure_texts(pa.array([t.encode() for t in texts], pa.binary())).to_pylist()
    assert [tuple(x[name] for name in quality.MEASURES[:5]) for x in got] == [brute.quality_base(t) for t in texts]


def test_measures_of_edge_cases_and_many_blocks(monkeypatch):
    texts = EDGE + [sentence(k % 60, k, VOCABULARY[:4]) for k in range(200)]
    monkeypatch.setattr(quality, "_BLOCK", 500)
    monkeypatch.setattr(arrays, "_CHUNK", 64)
    got = quality.measure_texts(pa.array([t and t.encode() for t in texts], pa.binary())).to_pylist()
    assert [tuple(x[name] for name in quality.MEASURES[:5]) for x in got] == [brute.quality_base(t) for t in texts]


def test_quality_keeps_prose_and_drops_junk(spark):
    prose = [sentence(60, k, [f"word{j}" for j in range(200)]) + "." for k in range(60)]
    junk = [" ".join(f"w{k}{j}###" for j in range(60)) for k in range(8)]
    scored = quality.score_quality(frame(spark, prose + junk + EDGE)).collect()
    kept = {r["row"]["doc_id"]: r["kept"] for r in scored}
    assert len(scored) == len(prose) + len(junk) + len(EDGE)
    assert all(kept[k] for k in range(60)) and not any(kept[60 + k] for k in range(8))
    assert kept[68] is False and all(r["base_failed"] for r in scored if r["row"]["text"] is None)
    assert scored[0]["row"].asDict().keys() == {"doc_id", "text", "lang", "row", "fp", "kept"}


def test_quality_of_no_documents(spark):
    assert quality.score_quality(frame(spark, ["x"]).where("false")).collect() == []
    model = quality.estimate([], 3)
    assert model.good.shape == (3, 3) and model.share == quality.PRIOR_SHARE


def test_estimates_do_not_depend_on_size():
    patterns = [("++0", 70), ("-+0", 20), ("--0", 10)]
    small, large = quality.estimate(patterns, 3), quality.estimate([(p, n * 1000) for p, n in patterns], 3)
    assert np.allclose(small.good, large.good) and np.isclose(small.share, large.share)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_suffix_array_orders_suffixes(numbers):
    ids = np.array(numbers) + 1
    order = decontam.suffix_array(ids, len(ids))
    assert sorted(range(len(ids)), key=lambda i: numbers[i:]) == order.tolist()


ITEMS = [(5, sentence(14, 7)), (12, "the Tail, bb"), (100, sentence(10, 9)), (7, None), (8, "..."), (None, "12 12 12"), (5, "zz the")]


def contamination_of(spark, texts, items=ITEMS, **keywords):
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = decontam.contamination(frame(spark, texts), benchmark, **keywords).collect()
    return {r["row"]["doc_id"]: (r["found"]["n_words"], r["found"]["n_hit"], r["found"]["items"]) for r in found}, found


def planted():
    noise = [f"n{k}" for k in range(500)]
    return EDGE + [
        sentence(30, 1, noise) + " " + sentence(14, 7).upper() + " " + sentence(30, 2, noise),
        "the-tail,BB", sentence(9, 9) , sentence(10, 9), "12 12 12 12 zz the " * 5, sentence(14, 7) + " " + sentence(14, 7),
    ]


@pytest.mark.parametrize("small", [False, True])
def test_contamination_equals_brute_force(spark, monkeypatch, small):
    texts = planted()
    if small:  # several passes over the benchmark
        monkeypatch.setattr(decontam, "BLOCK_BYTES", 40)
    got, _ = contamination_of(spark, texts)
    items = [("null" if name is None else name, text) for name, text in ITEMS]
    assert got == {k: brute.contamination(t, items) for k, t in enumerate(texts)}


def test_search_in_small_shards_and_longest_match(monkeypatch):
    monkeypatch.setattr(decontam, "SHARD_WORDS", 7)
    monkeypatch.setattr(decontam, "_ROWS_BYTES", 100)
    texts = planted()
    items = [(str(name), text) for name, text in ITEMS if text]
    queries = decontam.build_queries([n for n, _ in items], pa.array([t.encode() for _, t in items], pa.large_binary()), 10)
    found = decontam.find(pa.array([t and t.encode() for t in texts], pa.binary()), None, queries).to_pylist()
    assert [(x["n_words"], x["n_hit"], x["items"]) for x in found] == [brute.contamination(t, items) for t in texts]
    whole = found[len(EDGE)]
    said = brute.contamination(sentence(14, 7), [])[0]
    assert (whole["longest_words"], whole["longest_item"], whole["longest_at"]) == (said, "5", 30)


def test_contamination_without_benchmark_or_documents(spark):
    empty = spark.createDataFrame([], "item_id int, text string")
    assert all(r["found"]["n_hit"] == 0 for r in decontam.contamination(frame(spark, planted()), empty).collect())
    benchmark = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert decontam.contamination(frame(spark, ["x"]).where("false"), benchmark).collect() == []


def test_block_masks_meet_every_close_pair():
    masks = simhash.block_masks()
    draw = random.Random(3)
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), 3):
            b ^= 1 << bit
        assert any((a ^ b) & (mask % (1 << 64)) == 0 for mask in masks)


def near_copies():
    base = sentence(200, 11, [f"w{k}" for k in range(90)]).split()
    texts = []
    for k in range(60):  # a chain of small edits, and copies
        base[(7 * k) % len(base)] = f"edit{k % 5}"
        texts.append(" ".join(base))
    return texts + texts[:10] + EDGE + [sentence(40, 100 + k) for k in range(60)]


def test_components_of_fingerprints_equal_brute_force(spark):
    texts = near_copies()
    linked = simhash.near_duplicates(frame(spark, texts))
    rows = linked.select("row.doc_id", simhash.as_hex().alias("fp"), "component_id", "first").collect()
    prints = {k: brute.fingerprint(t) for k, t in enumerate(texts)}
    want = brute.joined(list(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 3)
    assert {r["doc_id"]: r["fp"] for r in rows} == {k: f"{v:016x}" for k, v in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert sorted(r["doc_id"] for r in rows if r["first"]) == sorted(set(want.values()))


def test_links_across_buckets_of_several_components(spark):
    draw = random.Random(5)
    prints = {draw.getrandbits(64)}
    for _ in range(400):
        seed = draw.choice(sorted(prints))
        for bit in draw.sample(range(64), draw.choice([1, 2, 3, 4, 5])):
            seed ^= 1 << bit
        prints.add(seed)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    got = {r["fp"]: r["root"] for r in simhash.link_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    want = brute.joined(signed, lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= 3)
    groups = lambda roots: sorted(sorted(k for k in roots if roots[k] == r) for r in set(roots.values()))
    assert groups(got) == groups(want)


def test_one_of_repeated_rows_and_null_ids_stays(spark):
    texts = ["same text of some words here"] * 4 + ["other words in another text now", None, ""]
    rows = simhash.near_duplicates(frame(spark, texts, [3, 3, None, 3, None, 9, 9])).collect()
    assert len(rows) == 7
    assert {(r["component_id"], r["row"]["text"]) for r in rows if r["first"]} >= {(3, texts[0]), (None, texts[4])}
    assert sum(r["first"] for r in rows) == 3
    assert simhash.near_duplicates(frame(spark, ["x"]).where("false")).collect() == []


def test_components_of_a_long_path_and_of_nothing(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(path, "a long, b long")).collect()
    assert {r["a"]: r["b"] for r in found} == {**{k: 0 for k in range(1, 41)}, 101: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def lines_case():
    shared = "  The Same line, shared by many  "
    return [
        (1, f"{shared}\nown one"), (2, f"own two\n{shared.upper()}"), (3, f"{shared.strip()}\n{shared}\nown three"), (4, "too short\n" * 3),
        (5, "too short"), (6, "too short"), (7, None), (8, ""), (9, f"x\n\n{shared}"), (10, "É" * 20), (11, "é" * 20), (12, "É" * 20), (13, "É" * 20 + "\t"),
    ]


def test_line_dedup_equals_brute_force(spark):
    rows = line_dedup.dedup_lines(frame(spark, [t for _, t in lines_case()], [i for i, _ in lines_case()])).collect()
    want = brute.dedup_lines(lines_case())
    assert {r["row"]["doc_id"]: r["kept_text"] for r in rows} == want
    for r in rows:
        total = (r["row"]["text"] or "").count("\n") + 1
        assert r["n_lines"] == total and 0 <= r["n_dropped"] <= total


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["A long enough common line", "another LONG common line\t", "short", "", "  one more line that repeats "]), max_size=5), min_size=1, max_size=7))
def test_line_dedup_on_random_documents(spark, documents):
    docs = [(k, "\n".join(lines)) for k, lines in enumerate(documents)]
    rows = line_dedup.dedup_lines(frame(spark, [t for _, t in docs])).collect()
    assert {r["row"]["doc_id"]: r["kept_text"] for r in rows} == brute.dedup_lines(docs)


def test_line_dedup_of_repeated_rows_null_ids_and_nothing(spark):
    line = "a line that is long enough"
    rows = line_dedup.dedup_lines(frame(spark, [line, line, f"{line}\nx", line, line], [1, 1, 1, 2, None])).collect()
    assert sorted(r["n_dropped"] for r in rows) == [0] * 5  # two ids only
    rows = line_dedup.dedup_lines(frame(spark, [line, line, f"{line}\nx", line, line, line], [1, 1, 1, 2, None, 3])).collect()
    assert sorted((r["row"]["doc_id"] or 0, r["kept_text"]) for r in rows) == [(0, ""), (1, ""), (1, ""), (1, "x"), (2, ""), (3, line)]
    assert line_dedup.dedup_lines(frame(spark, ["x"]).where("false")).collect() == []


def test_spark_and_python_hash_alike(spark):
    text = "é 日本 word"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64) == __import__("xxhash").xxh64_intdigest(text.encode(), 42)
