"""The registered queries of the operators: each runs its operator over whole tables and digests the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.alignment import Alignment
from tidemark.llm.bpe import BytePairs
from tidemark.llm.chat import format_conversations, read_back
from tidemark.llm.decontam import contaminated, contamination
from tidemark.llm.langid import train_language_model
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.ngram_lm import train
from tidemark.llm.quality import score_quality
from tidemark.llm.simhash import as_hex, near_duplicates
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.token_counts import token_counter
from tidemark.llm.toxicity import train_toxicity
from tidemark.session import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = [F.col(f"measures.{name}").alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return scored.select(F.col("row.doc_id").alias("doc_id"), *base, "base_failed", "kept", "quality", "votes")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    items = F.array_join("found.items", ",")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("found.n_words").alias("n_words"),
        F.col("found.n_hit").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return linked.select(F.col("row.doc_id").alias("doc_id"), as_hex().alias("fingerprint"), "component_id")


CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role")) for k, role in enumerate(("user", "assistant"))])).alias("t"),
    )
    control = control.select("conv_id", "t.turn", "t.role", F.lit(CONTROL_TEXT).alias("text"))
    return read_back(format_conversations(rows.unionByName(control)))


def encoded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents with ``n_tokens`` and the digests of their ids and of the bytes decoded from them."""
    pairs = BytePairs(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = docs.select("doc_id", pairs.round_trip("text").alias("coded"))
    tokens = (F.octet_length("coded.ids") / 4).cast("long")
    return coded.select("doc_id", tokens.alias("n_tokens"), F.sha2("coded.ids", 256).alias("ids_sha256"), F.sha2("coded.decoded", 256).alias("decoded_sha256"))


def fold(doc_id: str, folds: int, held: int) -> Column:
    """True for the rows that learning must not see; rows without an id are not among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == held, F.lit(False))


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", fold("doc_id", 10, 0).alias("held_out"))
    model = train(docs.where("not held_out"))
    scored = docs.select("doc_id", "held_out", model.scores("text").alias("s"))
    return scored.select("doc_id", "held_out", "s.n_tokens", "s.n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "s.base_score", "s.score")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4, 2))
    model = train_language_model(docs.where("not held_out"))
    found = docs.select("doc_id", "held_out", model.predict(docs).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", fold("doc_id", 5, 0).alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~fold("doc_id", 5, 0))
    model = train_toxicity(docs.where("not held_out"), labels)
    scored = docs.select("doc_id", "held_out", model.score(docs).alias("score"))
    return scored.select("*", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = token_counter(spark, public_tokenizers.path("byte_bpe_50k.json"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = table(spark, sf_dir, "documents").select("doc_id", size.alias("n_bytes"), tokens("text").alias("n_tokens"))
    return counted.select("*", (F.col("n_tokens") > 512).alias("over_limit"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    spans = (F.size("spans") / 2).cast("long")
    return cleaned.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", spans.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = Alignment(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    aligned = table(spark, sf_dir, "documents").select("doc_id", both.align("text").alias("s"))
    digest = F.when(F.col("s.groups") == "", "").otherwise(F.sha2(F.col("s.groups").cast("binary"), 256))
    aligned = stage(aligned.select("doc_id", "s.n_a", "s.n_b", F.col("s.links").alias("links"), digest.alias("groups_sha256")), "aligned")
    # each group ends with its one link
    size = F.size("links").cast("long")
    shown = aligned.select("doc_id", "n_a", "n_b", size.alias("n_groups"), size.alias("n_links"), both.weigh(aligned).alias("w"), "groups_sha256")
    return shown.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "w.n_best", "w.count_sum", "groups_sha256")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = {name: F.col(name) for name in merkle.FIELDS} | {"text": F.translate("text", _UPPER, _UPPER.lower())}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle.manifest(table(spark, sf_dir, "documents"), carry={"tampered": F.when(chosen, merkle.leaf(tampered))})
    shown = rows.select(
        F.col("row.doc_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        merkle.fold(F.coalesce("row.tampered", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_ngram_lm": op5_ngram_lm,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_language_id": op7_language_id,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}
