"""The operators on the test tables: one query each, registered by ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    class_lm,
    decontaminate,
    grammar_files,
    interleave,
    language,
    merkle,
    near_dup,
    pieces,
    quality,
    token_counts,
    url_rules,
    whitening,
)
from .common import lower_ascii, ship, utf8_size
from .sql import ORACLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, folder: fn(ship(spark), folder)
    return fn


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op1_near_duplicates(spark, folder):
    return near_dup.with_groups(table(spark, folder, "documents"), shingle=2)


@register
def op2_sentencepiece(spark, folder):
    model = pieces.read_model(tokenizer("piece_bpe_32k.model"))
    both = pieces.encoded(table(spark, folder, "documents"), model, keep=["doc_id"], back="decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op3_class_lm(spark, folder):
    docs = table(spark, folder, "documents")
    model, seen = class_lm.modelled(docs)
    return class_lm.scored(docs, model, seen, "doc_id", "text").select(
        "doc_id",
        class_lm.held_out("doc_id").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(model.total)).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


@register
def op4_stratified_shards(spark, folder):
    docs = table(spark, folder, "documents")
    slim = docs.select(
        "doc_id", "source", utf8_size("text").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    ).withColumn("size", F.col("size") + 1)
    out = interleave.interleaved(slim, "doc_id", "source", 8, seed=2, ties=("text_crc32", "size"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@register
def op5_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    profiles = language.trained(docs)
    declared, source = language.primary(F.col("lang")), F.col("source")
    family = F.regexp_replace(source, r"\d+$", "")
    return language.fused(docs, profiles, declared=declared, host=source, domain=family, keep=["doc_id", "lang"]).select(
        "doc_id", F.col("lang").alias("declared"), "language", "posterior", F.col("language_kept").alias("kept")
    )


@register
def language_of_pages(spark, folder):
    profiles = language.trained(table(spark, folder, "documents"))
    host = url_rules.host_of("url")
    pages = table(spark, folder, "pages").select(
        "page_id", "url", language.text_of(F.col("html")).alias("text"), language.declared_in(F.col("html")).alias("declared")
    )
    out = language.fused(
        pages,
        profiles,
        declared=F.col("declared"),
        suffix=language.suffix_of(host),
        host=F.nullif(host, F.lit("")),
        domain=language.domain_of(host),
        keep=["page_id", "declared"],
    )
    return out.select("page_id", "declared", "language", "posterior", F.col("language_kept").alias("kept"))


@register
def op6_token_counts(spark, folder):
    file = tokenizer("byte_bpe_50k.json")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    frequent = token_counts.frequent_lengths(docs, file)
    sized = docs.withColumn("n_bytes", utf8_size("text"))
    return token_counts.counted(sized, file, frequent, keep=["doc_id", "n_bytes"]).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit")
    )


@register
def op7_robust_quality(spark, folder):
    docs = table(spark, folder, "documents")
    out = quality.judged(docs, keep=["doc_id"])
    return out.select("doc_id", *quality.COUNTS, "base_failed", "kept", "distance")


@register
def op8_benchmark_hits(spark, folder):
    found = decontaminate.occurrences(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"])
    items = decontaminate.items_hit("spans")
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.words_hit("spans").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@register
def op9_grammar_files(spark, folder):
    path = grammar_files.new_path(spark)
    grammar_files.write(table(spark, folder, "documents"), path, tokenizer("word_bpe_49k.json"), end=2)
    return grammar_files.read(spark, path).withColumnRenamed("key", "doc_id")


RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@register
def op10_url_rules(spark, folder):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judged(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@register
def op11_merkle_manifest(spark, folder):
    docs = table(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = docs.select(
        "doc_id",
        "lang",
        merkle.row_digest(*fields, F.col("text")).alias("leaf"),
        F.when(tampered, merkle.row_digest(*fields, lower_ascii("text"))).alias("altered"),
    )
    found = merkle.manifest(rows, F.col("leaf"), F.col("lang"), "doc_id", keep=["doc_id", "altered"])
    root = merkle.folded(F.coalesce("altered", "leaf"), F.col("steps"))
    return (
        merkle.proofs(found, ["doc_id", "altered"])
        .select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"), root.alias("folded_root"))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


CONTROL_TURN = "</s>[INST] ok [/INST]"


@register
def op12_chat_examples(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    made = spark.createDataFrame([(-1, 0, "user", CONTROL_TURN), (-1, 1, "assistant", CONTROL_TURN)], turns.schema)
    path = chat.new_path(spark)
    chat.write(turns.union(made), path, "conv_id", "turn", "role", "text")
    return chat.digests(chat.read(spark, path)).withColumnRenamed("key", "conv_id")


@register
def op13_whitened_embeddings(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    fitted, rows = whitening.fitted(vectors, "embedding", 4, keep=["vec_id"])
    return whitening.whitened(rows, fitted, ["vec_id"])
