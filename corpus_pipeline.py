"""A training corpus from documents: filter, deduplicate, mix, encode.

STAGES names the stages in order. Each function takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of documents. run()
applies them to the documents of sf_dir, with each stage's rows written to the
shared folder and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import jaccard_join, line_dedup, mixing, piece_sampling, shared, toxicity

WEIGHTS = {"high": 0.75, "low": 0.25}

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    table, bias = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    columns, name = [c for c in docs.columns if c != "doc_id"], "toxicity"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    scored = toxicity.score(docs, table, bias, also=columns, into=name)
    return scored.where(F.col(name) < 0.5).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines whose template recurs across documents, first occurrences apart (copies of a document would all be emptied); near copies are left to the next stage."""
    return line_dedup.dedup_lines(docs, keep_first=True, spare=(5, 80))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8)."""
    return jaccard_join.keep_one(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates for WEIGHTS say; no domain gets fewer tokens than it has."""
    labels = mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.mix(docs, labels, WEIGHTS, budget="grow")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document, with inclusion scores."""
    return piece_sampling.sample_encode(docs, shared.tokenizer_file("piece_bpe_32k.model"), k=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if at == len(STAGES) - 1:
            return result
        before, docs = docs, shared.cut(result)
        shared.drop_cut(before)
    return docs
