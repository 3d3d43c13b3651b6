"""The operators' registered queries: each over its whole table, by the operator's own production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import align, bpe, chat, decontaminate, exact, jaccard, langid, lines, merkle, mixing, substrings, tokens, warc
from cartwheel.llm.common import word_count

TOKENIZER = "word_bpe_49k.json"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"

# Tools of the conversations' requests: parameter -> (type, required).
TOOLS = {
    "search": {"query": ("string", True), "top_k": ("integer", True)},
    "translate": {"text": ("string", True), "to": ("string", True)},
    "summarise": {"text": ("string", True), "max_words": ("integer", True), "style": ("string", False)},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file: CARTWHEEL_TOKENIZER, or the installed public one."""
    if path := os.environ.get("CARTWHEEL_TOKENIZER"):
        return path
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def vocabulary_path(name: str) -> str:
    """A vocabulary file by name: in the folder CARTWHEEL_TOKENIZERS, or the installed public one."""
    if folder := os.environ.get("CARTWHEEL_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and messages of the conversations, row by row.

    A user turn is a call, named by conversation and turn, that waits for the
    conversation's call two turns before; its words choose the tool and the
    arguments. An assistant turn is the result of the turn before it. Turns
    without a conversation or number have a null name. Turns of any other role
    (system, null) are messages.
    """
    named = lambda back: F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - back).cast("string"))
    text, n = F.coalesce("text", F.lit("")), word_count(F.col("text"))
    kind = F.pmod(F.length(text), F.lit(3))
    json = lambda *pairs: F.to_json(F.struct(*[v.alias(k) for k, v in pairs]))
    arguments = (
        F.when(kind == 0, json(("top_k", n), ("query", text)))
        .when(kind == 1, F.when(n < 10, json(("text", text))).otherwise(json(("to", F.lit("en")), ("text", text))))
        .otherwise(F.when(n < 10, json(("text", text), ("max_words", n.cast("string")), ("tone", F.lit("dry")))).otherwise(json(("text", text), ("max_words", n))))
    )
    tool = F.when(kind == 0, "search").when(kind == 1, "translate").otherwise("summarise")
    calls = turns.filter("role = 'user'").select(named(0).alias("call_id"), F.col("turn").alias("position"), named(2).alias("after_id"), tool.alias("tool"), arguments.alias("arguments"))
    results = turns.filter("role = 'assistant'").select(named(1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content"))
    messages = turns.filter("role is null or role not in ('user', 'assistant')").select(named(0).alias("call_id"), F.col("text").alias("content"))
    return calls, results, messages


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results, messages = conversation_calls(table(spark, sf_dir, "conversations"))
    linked = chat.link_tool_calls(calls, results, TOOLS, each_null=True, messages=messages)
    return linked.withColumn("errors", F.array_join("errors", "; "))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.pages_to_warc(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_binary(table(spark, sf_dir, "documents"), tokenizer_path())


def held_out(docs: DataFrame) -> Column:
    """Documents kept from training: a fifth, by the CRC-32 of the id as text (a null id as empty text)."""
    return F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit(""))) % 5 == 0


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs.filter(~held_out(docs))))
    return found.select("doc_id", held_out(found).alias("held_out"), "lang_pred", "score", "rejected")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = align.alignments(table(spark, sf_dir, "documents"), vocabulary_path(BYTE_BPE), vocabulary_path(PIECE_BPE))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    found = align.counted(rows, digests={"groups_sha256": digest})
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path(BYTE_BPE)
    found = bpe.decoded(bpe.encoded(table(spark, sf_dir, "documents"), path), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.verified_documents(table(spark, sf_dir, "documents"))
    proof = F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_chat_formatting, op2_mixing, op3_line_dedup, op4_substring_dedup, op5_warc, op6_jaccard_join, op7_token_binary, op8_language_id, op9_exact_dedup, op10_decontamination, op11_token_alignment, op12_bpe_round_trip, op13_merkle_manifest]
    return {q.__name__: q for q in found}
