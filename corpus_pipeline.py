"""A training corpus from raw documents: the stages in order, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import decontaminate, language, near_dup, pieces, quality
from tillwork.llm.common import ship, stage, stored
from tillwork.operators.joins import keep_first, sized


def _model() -> dict:
    import public_tokenizers

    return pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def boxed(docs: DataFrame) -> DataFrame:
    """Whole documents in one column, so that none of their columns meets an operator's, beside those the stages read."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), "doc_id", "text", "lang", "source")


def unboxed(kept: DataFrame) -> DataFrame:
    return kept.select("document.*")


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return unboxed(quality.judged(boxed(docs), keep=["document"]).filter("kept"))


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with at least even odds."""
    ship(spark)
    profiles = language.trained(docs)
    source = F.col("source")
    judged = language.fused(
        boxed(docs),
        profiles,
        declared=language.primary(F.col("lang")),
        host=source,
        domain=F.regexp_replace(source, r"\d+$", ""),
        keep=["document"],
    )
    return unboxed(judged.filter("language_kept"))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the least id; those without id come after all others, ties go by a digest.

    Rows are told apart by a digest of id and text, so that different texts under one id are different documents, and rows without
    id are compared as well. Of rows alike in both one stays. Texts without a word are linked with nothing and stay.
    The texts are not shuffled to find this, unless the rows that go are too many to broadcast.
    """
    ship(spark)
    row_id = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text")
    keyed = docs.select(row_id.alias("row_id"), "doc_id", "text")
    groups = stored(near_dup.with_groups(keyed, key="row_id"), "groups").filter("n_shingles > 0").select("row_id", "component_id")
    ids = stored(keyed.select("row_id", "doc_id"), "ids")
    members = stored(groups.distinct().join(ids.distinct(), "row_id"), "members")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")
    first = members.groupBy("component_id").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    first = sized(stored(first.select("component_id", F.col("first.row_id").alias("stays")), "first"), "first")
    gone = stored(members.join(first, "component_id").filter("row_id <> stays").select("row_id"), "gone")
    repeated = stored(groups.groupBy("row_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("row_id"), "repeated")
    rows = boxed(docs).withColumn("row_id", row_id)
    out = sized(stored(gone.union(repeated).distinct(), "out"), "out")
    once = rows.join(out, "row_id", "left_anti")
    again = rows.join(sized(repeated, "repeated"), "row_id", "left_semi").join(sized(gone, "gone"), "row_id", "left_anti")
    return unboxed(once.select("document").union(keep_first(again, ["row_id"], ["doc_id"]).select("document")))


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ten words, or whole shorter item, of the benchmark."""
    ship(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return unboxed(decontaminate.occurrences(boxed(docs), items, keep=["document"]).filter(F.size("spans") == 0))


@stage
def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the whole texts, and whether decoding them gives the text back."""
    ship(spark)
    model = _model()
    both = pieces.encoded(docs.select("doc_id", "lang", "source", "text"), model, back="decoded")
    return both.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


# (name, function): each takes (spark, docs, sf_dir) and returns a DataFrame, which is written before the next is called.
STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

# The tokenizer and the iterated estimates of the stages cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
