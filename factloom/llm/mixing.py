"""Soft-membership mixing of documents to target domain weights.

A multinomial classifier over hashed words, learnt from a labelled table, gives
every document a posterior over domains. Document rates r >= 0 are then fitted
so that the expected token totals per domain, the sum of rate x tokens x
posterior, match the targets: projected gradient descent on the least squares of
the totals, weighted by the inverse of their second moments (so that step 1 is
right whatever the data), each step one aggregate over all documents. A rate is
a fold over the steps' gradients (one number a domain), never a row kept back.

``mix`` turns rates into whole copies: the rate's floor, and one more with the
rest as probability, drawn by a seeded hash of the row; a rate less than NEARLY
below a whole number counts as that number.

The classifier may be fitted on at most ``max_labelled`` labelled documents (the
least hashes of doc_id); everything else covers all rows. Texts without words,
and null ones, have no tokens and the prior as posterior. Documents equal in id
and text share one rate. Labelled ids without a document, and null labels, are
left aside. Without any labelled document the posterior is uniform. Domains with
no target have target 0. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.shared import Cuts, cut, drop_cut

BUCKETS = 4096
EVIDENCE_WORDS = 32.0  # a text's mean log-likelihood counts as that of so many words at most
SMOOTHING = 0.5
NEARLY = 0.005


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """One number for rows equal in id and text."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def _words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # the key is made before the words are: beside explode() it would be made for every word
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"), F.replace(F.lower(text_col), F.lit("\n"), F.lit(" ")).alias("text"))
    return rows.select("doc_id", "key", F.explode(F.split("text", " ")).alias("word")).where("word <> ''").select("doc_id", "key", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int").alias("bucket"))


def fit_classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], max_labelled: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[float]]:
    """Log-likelihoods (bucket, l0, l1, ...) and log-priors of the domains; labelled has doc_id and domain."""
    sample = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    cuts = Cuts()
    sample = cuts.add(docs.select(F.col(id_col).alias("doc_id")).distinct().join(sample, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    # at most max_labelled rows of an id and a short label
    counts = _words(docs.withColumnRenamed(id_col, "doc_id"), "doc_id", text_col).join(F.broadcast(sample), "doc_id").groupBy("bucket").agg(*[F.count_if(F.col("domain") == d).cast("double").alias(f"n{i}") for i, d in enumerate(domains)])
    counts = cuts.add(counts)
    totals = counts.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0.0)) for i in range(len(domains))]).first()
    shares = sample.agg(*[F.count_if(F.col("domain") == d) for d in domains]).first()
    prior = [float(np.log((n + SMOOTHING) / (sum(shares) + SMOOTHING * len(domains)))) for n in shares]
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    model = every.join(counts, "bucket", "left").select("bucket", *[F.log((F.coalesce(F.col(f"n{i}"), F.lit(0.0)) + SMOOTHING) / (totals[i] + SMOOTHING * BUCKETS)).alias(f"l{i}") for i in range(len(domains))])
    model = cuts.add(model)
    cuts.keep_only(model)
    return model, prior


def posteriors(docs: DataFrame, model: DataFrame, prior: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, doc_id, n_tokens and posterior (array, in the order of the domains) of every distinct row."""
    size = len(prior)
    # the model has BUCKETS rows, whatever the input
    seen = _words(docs, id_col, text_col).join(F.broadcast(model), "bucket").groupBy("key").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"l{i}").alias(f"s{i}") for i in range(size)])
    rows = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id")).groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"))
    joined = rows.join(seen, "key", "left")
    n = F.coalesce("n", F.lit(0))
    weight = F.when(n > 0, F.least(n.cast("double"), F.lit(EVIDENCE_WORDS)) / n).otherwise(F.lit(0.0))
    logits = F.array(*[F.coalesce(F.col(f"s{i}"), F.lit(0.0)) * weight + prior[i] for i in range(size)])
    scored = joined.select("key", "doc_id", "rows", n.cast("long").alias("n_tokens"), logits.alias("logits"))
    powers = F.transform("logits", lambda x: F.exp(x - F.array_max("logits")))
    scored = scored.select("key", "doc_id", "rows", "n_tokens", powers.alias("powers"))
    return scored.select("key", "doc_id", "rows", "n_tokens", F.transform("powers", lambda x: x / F.aggregate("powers", F.lit(0.0), lambda a, b: a + b)).alias("posterior"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def rate_of(posterior: Column, gradients: list[list[float]]) -> Column:
    """The rate after the given steps, from 1."""
    if not gradients:
        return F.lit(1.0)
    return F.aggregate(F.lit(gradients), F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - _dot(posterior, g)))


def fit_rates(scored: DataFrame, targets: list[float], steps: int = 40, tolerance: float = 1e-6) -> list[list[float]]:
    """Gradients of the projected steps; scored as posteriors() gives it, targets in tokens."""
    size = len(targets)
    tokens = F.col("n_tokens") * F.col("rows")
    p = [F.get("posterior", F.lit(i)) for i in range(size)]
    moments = scored.agg(*[F.coalesce(F.sum(tokens * p[i] * p[j]), F.lit(0.0)) for i in range(size) for j in range(size)]).first()
    inverse = np.linalg.pinv(np.array(moments, float).reshape(size, size), rcond=1e-9)
    wanted, gradients = np.array(targets, float), []
    for _ in range(steps):
        rate = rate_of(F.col("posterior"), gradients)
        totals = scored.select("n_tokens", "rows", "posterior", rate.alias("rate")).agg(*[F.coalesce(F.sum(F.col("rate") * tokens * p[i]), F.lit(0.0)) for i in range(size)]).first()
        off = np.array(totals, float) - wanted
        if np.abs(off).max() <= tolerance * max(np.abs(wanted).max(), 1.0):
            break
        gradients.append([float(x) for x in inverse @ off])
    return gradients


def rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: str = "total", max_labelled: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, doc_id, rows, n_tokens, posterior, rate.

    Targets are the weights, made to sum to 1, of as many tokens as docs have
    (``total``), or of as few as let every domain keep the tokens it has
    (``grow``: rates stay near 1 or above).
    """
    domains = sorted(weights)
    share = np.array([weights[d] for d in domains], float)
    share = share / share.sum()
    model, prior = fit_classifier(docs, labelled, domains, max_labelled, id_col, text_col)
    scored = cut(posteriors(docs, model, prior, id_col, text_col))
    drop_cut(model)
    tokens = F.col("n_tokens") * F.col("rows")
    now = np.array(scored.agg(*[F.coalesce(F.sum(tokens * F.get("posterior", F.lit(i))), F.lit(0.0)) for i in range(len(domains))]).first(), float)
    size = now.sum() if budget == "total" else max((now / np.maximum(share, 1e-9)).max(), now.sum())
    gradients = fit_rates(scored, (share * size).tolist())
    return scored.withColumn("rate", rate_of(F.col("posterior"), gradients))


def copies_of(rate: Column, key: Column, seed: int) -> Column:
    """Whole copies for a rate: its floor, and one more with the rest as probability."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11) / float(1 << 53)
    whole = F.floor(rate + NEARLY)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: str = "total", seed: int = 11, max_labelled: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each row as many times as its rate says."""
    fitted = rates(docs, labelled, weights, budget, max_labelled, id_col, text_col).select(F.col("key").alias("_mix_key"), copies_of(F.col("rate"), F.col("key"), seed).alias("_mix_copies"))
    joined = docs.join(fitted, row_key(id_col, text_col) == F.col("_mix_key"))
    return joined.where("_mix_copies > 0").select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))).alias("_mix_copy")).drop("_mix_copy")


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain (toxic, high or low) of rows with doc_id, quality and toxic."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain")).where(F.col("domain").isNotNull())
