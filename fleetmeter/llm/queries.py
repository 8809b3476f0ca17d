"""One query per operator, over the whole of its tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.llm import (
    decontaminate,
    exact_dedup,
    hard_negatives,
    language_id,
    line_dedup,
    lm_score,
    mixing,
    ngram_join,
    prefix_trie,
    quality,
    simhash,
    substring_dedup,
    toxicity,
)
from fleetmeter.llm.stages import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(language_id.training_sample(docs.where(~held_out(4, 2))))
    mine = docs.select("doc_id", held_out(4, 2).alias("held_out"), "text")
    return language_id.identify(mine, model, with_text=False)


def op2_exact_dedup(spark, sf_dir):
    marked = exact_dedup.mark_duplicates(_table(spark, sf_dir, "documents"))
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return marked.select("doc_id", "keep_id", "group_size", "kept", digest)


def op3_decontaminate(spark, sf_dir):
    found = decontaminate.find_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hits = decontaminate.hit_words()
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def op4_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", held_out(4, 2).alias("held_out"))
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = quality.score_quality(docs, labels, "not held_out", ("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_line_dedup(spark, sf_dir):
    cleaned = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op6_substring_dedup(spark, sf_dir):
    cleaned = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_simhash(spark, sf_dir):
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op8_lm_score(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", held_out(5, 1).alias("held_out"))
    scored = lm_score.score_texts(docs, "not held_out", ("doc_id", "held_out"))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op9_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", held_out(5, 0).alias("held_out"))
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).where(~held_out(5, 0))
    scored = toxicity.score_toxicity(docs, labels, "not held_out", ("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_mixing(spark, sf_dir):
    return mixing.interleave(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    convs = prefix_trie.conversations(
        turns, head=lambda c: F.crc32(c.cast("string").cast("binary")) % 9, base=lambda c: c - c % 5
    )
    trie = prefix_trie.prefix_trie(convs)
    nodes = trie.nodes.join(prefix_trie.ends_digest(trie.ends), ["conv_id", "depth"], "left")
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))


def op12_hard_negatives(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")


def op13_ngram_join(spark, sf_dir):
    return ngram_join.similar_sets(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_line_dedup": op5_line_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_simhash": op7_simhash,
    "op8_lm_score": op8_lm_score,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_ngram_join": op13_ngram_join,
}
