"""The registered queries on the small dataset, and the pipeline with planted cases."""

import glob
import os

import brute
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tidemark.llm import oracles, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")
FIRST = {
    1: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    2: ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    3: ["doc_id", "fingerprint", "component_id"],
    4: ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    5: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    6: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    7: ["doc_id", "held_out", "lang_pred", "score"],
    8: ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    9: ["doc_id", "held_out", "score", "predicted"],
    10: ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    11: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    12: ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    13: ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return connection


def test_all_are_registered():
    assert {int(name[2:].split("_")[0]) for name in queries.QUERIES} == set(FIRST)
    assert entry_points.queries().keys() >= {*queries.QUERIES, "pipeline"}
    assert entry_points.oracle_sql().keys() >= set(oracles.ORACLES)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sql, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.collect()
    want = FIRST[int(name[2:].split("_")[0])]
    assert df.columns[: len(want)] == want
    if name in oracles.ORACLES:
        result = sql.execute(oracles.ORACLES[name])
        names = [c[0] for c in result.description]
        assert sorted((tuple(r[n] for n in names) for r in rows), key=repr) == sorted(result.fetchall(), key=repr)
    elif name.startswith("op1_"):
        texts = dict(sql.execute("SELECT doc_id, text FROM documents").fetchall())
        assert {r[0]: tuple(r)[1:6] for r in rows} == {k: brute.quality_base(t) for k, t in texts.items()}
    elif name.startswith("op3_"):
        texts = dict(sql.execute("SELECT doc_id, text FROM documents").fetchall())
        prints = {k: brute.fingerprint(t) for k, t in texts.items()}
        roots = brute.joined(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 3)
        assert {r[0]: (r[1], r[2]) for r in rows} == {k: (f"{v:016x}", roots[k]) for k, v in prints.items()}
    elif name.startswith("op12_"):
        texts = sql.execute("SELECT doc_id, text FROM documents").fetchall()
        assert sorted(map(tuple, rows)) == sorted((k, *x) for (k, _), x in zip(texts, brute.alignments([t for _, t in texts])))
    elif name.startswith("op6_"):
        texts = sql.execute("SELECT doc_id, text FROM documents").fetchall()
        assert sorted(map(tuple, rows)) == sorted((k, *brute.byte_pairs(t)) for k, t in texts)
    elif name.startswith("op10_"):
        texts = sql.execute("SELECT doc_id, text FROM documents").fetchall()
        assert sorted(map(tuple, rows)) == sorted((k, *brute.token_count(t)) for k, t in texts)
    elif name.startswith("op11_"):
        texts = sql.execute("SELECT doc_id, text FROM documents").fetchall()
        assert sorted(map(tuple, rows)) == sorted((k, *brute.without_repeats(t, r)) for (k, t), r in zip(texts, brute.repeated_spans([t for _, t in texts], 400)))
    else:
        assert len(rows) == sql.execute("SELECT count(*) FROM documents").fetchone()[0]


def prose(k, n=120):
    return " ".join(f"word{(k * 7919 + j * j * 31 + j) % 4001}x" for j in range(n)) + "."


def planted_documents():
    shared = "this line is shared by a good many documents of the corpus"
    item = " ".join(f"question{k}" for k in range(12))
    clean = [(k, prose(k)) for k in range(40)]
    lined = [(100 + k, f"{shared}\n{prose(100 + k)}") for k in range(4)]
    # two copies, and one whose lines are cut elsewhere: three equal lines would be the line dedup's affair
    near = [(200, prose(50, 400)), (201, prose(50, 400)), (202, prose(50, 400).upper().replace(" ", "\n", 1))]
    dirty = [(300, prose(60) + " " + item.upper() + " " + prose(61))]
    junk = [(400 + k, " ".join(f"x{j}### y{j}$$$ |" for j in range(40))) for k in range(3)]
    return clean, lined, near, dirty, junk, [(500, None), (501, ""), (None, prose(70)), (40, prose(71)), (40, prose(71))], item


def test_pipeline_with_planted_cases(spark, tmp_path):
    clean, lined, near, dirty, junk, odd, item = planted_documents()
    rows = [(k, t, None, "src", 0 if t is None else len(t), "x", True) for k, t in clean + lined + near + dirty + junk + odd]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, kept boolean"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    steps = [docs]
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, steps[-1], str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        steps.append(spark.read.parquet(str(tmp_path / name)))
    for step in steps[1:-1]:
        assert step.columns == docs.columns
    assert ids(steps[0]) - ids(steps[1]) == {400, 401, 402, 500, 501}
    assert ids(steps[2]) == ids(steps[1])
    kept = {r["doc_id"]: r for r in steps[2].where("doc_id between 100 and 103").collect()}
    assert [kept[100 + k]["text"].count("shared") for k in range(4)] == [0, 0, 0, 1]
    assert all(r["n_chars"] == len(r["text"]) for r in kept.values())
    assert ids(steps[2]) - ids(steps[3]) == {201, 202} and steps[3].where("doc_id = 40").count() == 1
    assert ids(steps[3]) - ids(steps[4]) == {300}
    assert steps[5].count() == steps[4].count() and ids(steps[5]) >= {k for k, _ in clean} | {None}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == steps[5].count()


def test_stages_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, str(tmp_path))
        assert docs.collect() == []
