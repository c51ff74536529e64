"""A training corpus from raw documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelake.llm import exact_dedup, ngram_join, packing, quality, secret_scan
from tidelake.llm.common import table
from tidelake.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones, does not reject."""
    model, ratios = quality.learn(docs, table(spark, sf_dir, "labels"), "quality", lambda c: ~quality.held_out(c))
    return quality.accepted(docs, model, ratios)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The winner of each group of equal texts. Rows that repeat a whole document leave one."""
    rows = exact_dedup.digested(docs)
    out = exact_dedup.deduplicated(rows, exact_dedup.earlier_half())
    won = out.where("kept").join(rows.select(F.col("row").alias("__row"), "size"), F.col("row") == F.col("__row")).select(
        F.col("doc_id").alias("__doc"), F.col("digest").alias("__digest"), F.col("size").alias("__size"))
    size = F.length(F.coalesce("text", F.lit(""))).cast("long")
    same = (F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__digest")) & (F.col("__n") == F.col("__size")))
    kept = docs.withColumns({"__own": exact_dedup.digest_of(F.col("text")), "__n": size}).join(
        won.hint("shuffle_hash"), same, "left_semi")
    if not rows.groupBy("doc_id", "digest", "size").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "__own", "__n"])
    return kept.drop("__own", "__n")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of near copies: five words, a Jaccard coefficient of at least 0.8."""
    found = ngram_join.classes(docs, width=5, percent=80)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__doc")).distinct()
    return docs.join(kept.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("__doc")), "left_semi")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and n_chars brought up to date. Only texts with a match move."""
    rules = secret_scan.REDACTION_RULES
    paths, ledger = secret_scan.scan(docs, "doc_id", rules=rules)
    found = secret_scan.findings(paths, ledger, rules).where(F.size("spans") > 0).distinct().select(
        F.col("path").alias("__path"), F.col("blob").alias("__blob"), "spans")
    hit = F.coalesce(secret_scan.suspected(F.col("text"), rules), F.lit(False))
    same = F.col("doc_id").eqNullSafe(F.col("__path")) & (F.unhex(F.sha2(F.col("text"), 256)) == F.col("__blob"))
    joined = docs.where(hit).join(found.withColumnRenamed("spans", "__spans").hint("shuffle_hash"), same, "left")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(secret_scan.redacted(F.col("text"), F.col("__spans")))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(
            F.length(text).cast(docs.schema["n_chars"].dataType))
    return joined.withColumns(changed).select(*docs.columns).unionByName(docs.where(~hit))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of at most 2048."""
    import public_tokenizers
    return packing.packed(packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("secret scans", without_secrets),
    ("best-fit packing", packed_sequences),
]

#: A trained model and best-fit packing have no SQL form; tests/llm holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
