"""Merkle manifests against a plain-Python tree."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.merkle import fold, leaf, manifest, siblings

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """The root of a list of digests, and the siblings on the way of each."""
    proofs, at, level = [""] * len(nodes), list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = range(i - i % 8, min(len(level), i - i % 8 + 8))
            proofs[k] += "".join(level[j] for j in run if j != i)
            at[k] = i // 8
        level = [digest(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return level[0], proofs


def expected(rows):
    """(doc_id, leaf, subroot, root, proof digest) of every row."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = climb([x[2] for x in groups[g]])
    root, tops = climb([trees[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for x, proof in zip(groups[g], trees[g][1]):
            out.append((x[3][0], x[2], trees[g][0], root, digest(proof + top)))
    return sorted(out, key=repr)


def found(spark, rows, schema=SCHEMA):
    docs = spark.createDataFrame(rows, schema).repartition(3)
    shown = manifest(docs).select("row.doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")).cast("binary"), 256).alias("p"), fold(F.col("leaf"), F.col("proof")).alias("again"))
    got = shown.collect()
    assert all(r["again"] == r["root"] for r in got)
    return sorted((tuple(r)[:5] for r in got), key=repr)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, None: 1}, {"en": 9, "de": 512, "": 65}, {"en": 4097, None: 513, "é": 520, "z": 3}, {f"l{k}": k % 3 + 1 for k in range(530)}])
def test_trees_of_all_heights(spark, sizes):
    rng = random.Random(3)
    rows = [(0, "s", g, 3, f"{g} Text {k}") for g, n in sizes.items() for k in range(n)]
    ids = rng.sample(range(-50, 100_000), len(rows))
    rows = [(i, *row[1:]) for i, row in zip(ids, rows)]
    assert found(spark, rows) == expected(rows)


def test_nulls_empty_long_and_repeated_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "s", "en", 0, ""), (1, "s", "en", 0, None), (1, "s", "en", 0, ""), (2, "", "en", -5, "ü" * 300_000), (3, "-", "", 1, "-")]
    assert found(spark, rows) == expected(rows)


def test_empty_table_and_clashing_names(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert manifest(docs).count() == 0
    rows = [(k, "s", "en", k, f"t{k}") for k in range(20)]
    plain = spark.createDataFrame(rows, SCHEMA)
    clashing = plain.select("*", *[F.lit("x").alias(name) for name in ("digest", "rank", "g", "k", "block", "row", "proof", "_range", "member")])
    wanted = manifest(plain).select("row.doc_id", "leaf", "root").collect()
    assert sorted(manifest(clashing).select("row.doc_id", "leaf", "root").collect()) == sorted(wanted)


def test_a_changed_row_does_not_fold_to_the_root(spark):
    rows = [(k, "s", "en" if k % 3 else "de", k, f"t{k}") for k in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    other = {name: F.col(name) for name in docs.columns} | {"text": F.lit("other")}
    proofs = manifest(docs, carry={"other": leaf(other)})
    assert proofs.where(fold(F.col("row.other"), F.col("proof")) == F.col("root")).count() == 0


def test_scratch_folder_of_the_caller(spark, tmp_path):
    docs = spark.createDataFrame([(1, "s", "en", 1, "t")], SCHEMA)
    assert manifest(docs, work=f"file://{tmp_path}/work").count() == 1
    assert (tmp_path / "work").is_dir()
