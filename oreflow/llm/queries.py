"""The registered queries: one for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import (
    classlm, fingerprints, hammingindex, langid, merkle, mixing, packing, quality, simhash, templates, toxicity, tries, urls,
)
from oreflow.llm.common import table


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs, m = quality.measured(source)
    # the contract's measures are taken of every row, the others where the cascade gets to them
    cols = {name: make(F.col("text")) for name, make in quality.MEASURES.items()} | {name: F.col(c) for name, c in m.items()}
    rules = quality.default_rules(cols, F.length(F.coalesce("text", F.lit(""))), list(m))
    base = (cols["n_words"] < 10) | (100 * cols["n_repeat_words"] > 20 * cols["n_words"])
    judged = quality.quality_cascade(docs, rules, quality.measured(quality.sampled(source))[0])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & F.col("rejected_by").isNull()).alias("kept"),
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = classlm.held_out(F.col("doc_id"), 7, 2)
    model, counts = classlm.train(docs.filter(~out).select("text"))
    scores = classlm.score(docs, model, counts)
    return scores.select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score", "perplexity",
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    tree = langid.train(docs, part != 0)
    judged = langid.identify(docs.select("doc_id", "text"), tree)
    return judged.select("doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.filter_urls(
        table(spark, sf_dir, "pages").select("page_id", "url"),
        block=["net/", "example.com/de/"],
        allow=["example.net/en/", "org/fr/"],
    )
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.default_chain(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.judge(docs, chain, ["p_low_quality", "p_toxic"])
    toxic = (F.col("p_toxic") >= toxicity.THRESHOLD).alias("toxic")
    return judged.select("doc_id", "p_low_quality", "p_toxic", toxic)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id", "source", mixing.size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")
    )
    mix = mixing.mix(rows, ["doc_id", "tie"])
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = templates.extract_text(pages)
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(chosen, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proofs = merkle.manifest(docs, changed={"text": text})
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", "verified",
    )


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hammingindex.nearest(vectors, F.col("id") % 20 == 0)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = tries.prefix_trie(table(spark, sf_dir, "conversations"))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_source_mixing": op2_source_mixing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_html_extraction": op4_html_extraction,
    "op5_sequence_packing": op5_sequence_packing,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_language_id": op7_language_id,
    "op8_url_filters": op8_url_filters,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_conversation_trie": op13_conversation_trie,
}
