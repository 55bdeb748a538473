"""The queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import fingerprints, html_extraction, jaccard_join, line_dedup, mixing, nearest, oracles, piece_sampling, sharding, shared, token_counts, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document, with inclusion scores."""
    return piece_sampling.sample_encode(_read(spark, sf_dir, "documents"), shared.tokenizer_file("piece_bpe_32k.model"), k=2)


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows, by inner product, of every row whose vec_id is divisible by 20."""
    return nearest.nearest(_read(spark, sf_dir, "embeddings"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place after a two-pass external shuffle into eight shards."""
    return sharding.digest(sharding.shuffle_into_shards(_read(spark, sf_dir, "documents"), 8))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return jaccard_join.near_duplicates(_read(spark, sf_dir, "documents"), width=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page by minimum-cut labelling."""
    return html_extraction.extract(_read(spark, sf_dir, "pages"))


MIX = {"high": 0.6, "low": 0.35, "toxic": 0.05}


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's domain posterior, rate and copies for the target weights MIX."""
    docs = _read(spark, sf_dir, "documents")
    fitted = mixing.rates(docs, mixing.label_domains(_read(spark, sf_dir, "labels")), MIX)
    names = [F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(sorted(MIX))]
    found = fitted.select("doc_id", "n_tokens", *names, "rate", mixing.copies_of(F.col("rate"), F.col("key"), 11).alias("copies"), F.explode(F.sequence(F.lit(1), "rows")).alias("row"))
    return found.drop("row")  # one row for each row of documents


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), shared.tokenizer_file("byte_bpe_50k.json"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by subword-bag embeddings."""
    return toxicity.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprints of every document and of its edited text."""
    return fingerprints.fingerprint_report(_read(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose template recurs across documents."""
    return line_dedup.dedup_lines(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name to function of (spark, sf_dir)."""
    return {f.__name__: f for f in (op1_piece_sampling, op2_nearest, op3_sharding, op4_jaccard_join, op5_html_extraction, op6_mixing, op7_token_counts, op8_toxicity, op9_fingerprints, op10_line_dedup)}


def oracle_sql() -> dict[str, str]:
    """Query name to DuckDB SQL; queries that SQL cannot express are tested in tests/llm."""
    return {"op4_jaccard_join": oracles.JACCARD, "op9_fingerprints": oracles.SPOTS, "op10_line_dedup": oracles.LINES}
