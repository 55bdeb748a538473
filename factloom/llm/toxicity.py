"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text's words, each once in order of first appearance and in lower case, have
vectors that are averages of their character n-grams' embeddings (MIN_N to MAX_N
characters, word ends marked, hashed into BUCKETS rows). Word vectors are
averaged over windows of WINDOW words, half overlapping and filled up with zero
vectors, and a linear softmax turns averages into probabilities. The window
likeliest to be toxic speaks for the text, so that one insult in a very long
text is not averaged away; no part of a text is left unread. Embeddings and
softmax are trained together in numpy, by normalised gradient descent with
momentum, on at most ``max_rows`` labelled texts and ``max_chars`` characters (least hashes of the ids first). Misspellings
never seen share n-gram vectors with the words they come from.

Once trained, each bucket's part of the log-odds is one number, so that scoring
is a table lookup for words not met before and sums over whole texts.

Null text counts as empty; texts without words get the bias alone. Equal texts
get equal scores, whatever stands beside them. Without labelled rows of both
kinds the score is the share of label 1 (0.5 without any rows). Nothing but the
text enters a score. Repeated ids are rows of their own: all are scored, and all
that are labelled may be learnt from, within the same bounds. Columns that go
along may have any names but that of the score. An empty table gives an empty one.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.shared import bounded_batches, give_back

BITS, DIM = 18, 8
BUCKETS = 1 << BITS
MIN_N, MAX_N = 3, 6
WINDOW, STEP = 8, 4
CACHED_WORDS = 1 << 17  # values a scoring process remembers at most
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    """The distinct words of a text in order of first appearance."""
    return list(dict.fromkeys(_WORD.findall(text.lower())))


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For every n-gram of the words: the number of its word, its bucket."""
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    is_blank = points == 32
    blanks = np.concatenate([[0], np.cumsum(is_blank, dtype=np.int32)])
    owner = (blanks[1:] - 1).astype(np.int32)
    size, owners, ids = len(points), [], []
    h = points * np.uint32(0x9E3779B1)
    for n in range(2, MAX_N + 1):
        if size < n:
            break
        h = (h[: size - n + 1] ^ (h[: size - n + 1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + points[n - 1 :] * np.uint32(0xC2B2AE35)
        if n >= MIN_N:
            # blanks may stand at either end only
            ok = np.flatnonzero(blanks[n - 1 : size] == blanks[1 : size - n + 2])
            mixed = h[ok] ^ (h[ok] >> np.uint32(13))
            ids.append(((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS)).astype(np.int32))
            owners.append(owner[ok])
    if not ids:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(owners), np.concatenate(ids)


def word_values(table: np.ndarray, words: list[str]) -> np.ndarray:
    """Each word's part of the log-odds: the mean over its n-grams."""
    owners, ids = grams(words)
    total = np.bincount(owners, table[ids], len(words))
    return total / np.maximum(np.bincount(owners, minlength=len(words)), 1)


def window_count(n_words: np.ndarray) -> np.ndarray:
    """How many windows texts of so many distinct words have."""
    return np.maximum(1, -(-(n_words - WINDOW) // STEP) + 1)


def score_texts(table: np.ndarray, bias: float, texts: list[str], known: dict[str, float] | None = None) -> np.ndarray:
    """Probability of label 1 of each text: that of its likeliest window."""
    known = {} if known is None else known
    bags = [words_of(t) for t in texts]
    if len(known) > CACHED_WORDS:
        known.clear()
    fresh = list(dict.fromkeys(w for bag in bags for w in bag if w not in known))
    for at in range(0, len(fresh), 1 << 15):
        some = fresh[at : at + (1 << 15)]
        known.update(zip(some, word_values(table, some).tolist(), strict=True))
    out = np.empty(len(texts))
    for i, bag in enumerate(bags):
        sums = np.concatenate([[0.0], np.cumsum([known[w] for w in bag])])
        begin = np.arange(int(window_count(np.int64(len(bag))))) * STEP
        out[i] = (sums[np.minimum(begin + WINDOW, len(bag))] - sums[np.minimum(begin, len(bag))]).max() / WINDOW + bias
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


class Model:
    """Embeddings (BUCKETS x DIM), softmax weights (DIM x 2) and biases."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embeddings = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
        self.weights = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)

    def table(self) -> tuple[np.ndarray, float]:
        """Each bucket's part of the log-odds, and the bias's."""
        return (self.embeddings @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(texts: list[str], labels: np.ndarray, steps: int = 60, rate: float = 25.0, decay: float = 0.03, warm: int = 4, seed: int = 7) -> Model:
    """Joint training over all texts at each step, by normalised gradient descent with momentum.

    Every window of a text of label 0 is of label 0; of a text of label 1 the
    likeliest window is (in the first ``warm`` steps all are). Steps are scaled
    by the largest gradient of any n-gram, not one by one: n-grams of many
    texts are learnt before those of one, and decay keeps the latter small.
    """
    model = Model(seed)
    number: dict[str, int] = {}
    bags = [np.fromiter((number.setdefault(w, len(number)) for w in words_of(t)), np.int32) for t in texts]
    owners, ids = grams(list(number))
    per_word = np.maximum(np.bincount(owners, minlength=len(number)), 1)
    lengths = np.array([len(b) for b in bags])
    flat = np.concatenate([*bags, np.zeros(0, np.int32)])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    each = window_count(lengths)
    first = np.concatenate([[0], np.cumsum(each)])[:-1]
    text_of = np.repeat(np.arange(len(texts)), each)
    begin = np.repeat(starts[:-1], each) + (np.arange(len(text_of)) - np.repeat(first, each)) * STEP
    end = np.minimum(begin + WINDOW, np.repeat(starts[1:], each))
    begin = np.minimum(begin, end)
    toxic = labels[text_of] > 0.5
    share = min(max(float(labels.mean()), 1e-3), 1 - 1e-3)
    model.bias[:] = (0, np.log(share / (1 - share)))
    moved = [np.zeros_like(p) for p in (model.embeddings, model.weights, model.bias)]
    for step in range(steps):
        table, bias = model.table()
        value = np.bincount(owners, table[ids], len(number)) / per_word
        sums = np.concatenate([[0.0], np.cumsum(value[flat])])
        logit = (sums[end] - sums[begin]) / WINDOW + bias
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        is_top = logit == np.maximum.reduceat(logit, first)[text_of]
        weight = np.where(toxic, (1.0 / each[text_of]) if step < warm else is_top, 1.0 / each[text_of] + is_top)
        slope = (p - toxic) * weight / len(texts)
        spread = np.bincount(begin, slope, len(flat) + 1) - np.bincount(end, slope, len(flat) + 1)
        of_word = np.bincount(flat, np.cumsum(spread)[:-1], len(number)) / per_word
        coef = np.bincount(ids, of_word[owners], BUCKETS).astype(np.float32)
        away = model.weights[:, 1] - model.weights[:, 0]
        to_w = model.embeddings.T @ coef
        speed = rate * (1 - step / steps)
        scales = (speed / (np.abs(coef).max() * (away @ away) + 1e-12), 0.01 / (np.abs(to_w).max() + 1e-12), 1.0)
        grads = (coef[:, None] * away[None, :], np.stack([-to_w, to_w], 1), np.array([-slope.sum(), slope.sum()], np.float32))
        for param, grad, scale, m in zip((model.embeddings, model.weights, model.bias), grads, scales, moved, strict=True):
            m *= 0.8
            m += scale * grad
            param -= m
        model.embeddings *= 1 - decay
    return model


def calibrate(table: np.ndarray, bias: float, texts: list[str], labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that fit the log-odds to labels the training has not seen (Platt's method, with its smoothed targets)."""
    p = score_texts(table, bias, texts)
    z = np.log(p / (1 - p))
    ones = labels.sum()
    target = np.where(labels > 0.5, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x, theta = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (q - target) + 1e-3 * (theta - [1.0, 0.0])
        theta -= np.linalg.solve((x * (q * (1 - q) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2), gradient)
    return (float(theta[0]), float(theta[1])) if np.isfinite(theta).all() and theta[0] > 0 else (1.0, 0.0)


def fit_texts(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Table and bias: trained on four fifths of the texts, calibrated on the rest if that holds both kinds often enough."""
    aside = np.arange(len(texts)) % 5 == 4
    if min(labels[aside].sum(), (1 - labels[aside]).sum()) < 20:
        return train(texts, labels).table()
    table, bias = train([t for t, a in zip(texts, aside, strict=True) if not a], labels[~aside]).table()
    slope, offset = calibrate(table, bias, [t for t, a in zip(texts, aside, strict=True) if a], labels[aside])
    return (table * slope).astype(np.float32), bias * slope + offset


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no label may be learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, max_chars: int = 12 << 20) -> tuple[list[str], np.ndarray]:
    """Labelled texts outside the held-out fifth: the least hashes of doc_id first, up to both bounds; a text that does not fit is passed over."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = ("hash", "doc_id", "n", "body")
    # lengths first: what is brought to the driver is bounded before any text is, row by row even where ids repeat
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"n": F.char_length("text"), "body": F.xxhash64("text"), "hash": F.xxhash64("doc_id")})
    sized = texts.select("doc_id", "n", "body", "hash").where(F.col("n") <= max_chars).join(marked, "doc_id").groupBy(*order, "toxic").agg(F.count(F.lit(1)).alias("rows"))
    chosen, held = [], 0
    for row in sized.orderBy(*order).limit(max_rows).collect():
        if held + row.n > max_chars:
            continue
        held += row.n
        chosen.append((row.doc_id, row.n, row.body, row.toxic, row.rows))
    if not chosen:
        return [], np.zeros(0)
    wanted = docs.sparkSession.createDataFrame(chosen, sized.select("doc_id", "n", "body", "toxic", "rows").schema)
    # one text for each chosen row, as long as was counted; rows that repeat are learnt from as often, up to max_rows
    found = texts.join(F.broadcast(wanted), ["doc_id", "n", "body"]).groupBy(*order, "toxic", "rows").agg(F.min("text").alias("text")).orderBy(*order).collect()
    rows = [(r.text, r.toxic) for r in found for _ in range(min(r.rows, max_rows))][:max_rows]
    return [t for t, _ in rows], np.array([y for _, y in rows], float)


def score(docs: DataFrame, table: np.ndarray, bias: float, id_col: str = "doc_id", text_col: str = "text", also: list[str] | None = None, into: str = "score") -> DataFrame:
    """The id, the columns in ``also``, and the score, in a column named ``into``, of every row of docs."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((table, bias))
    given = text_col in (also or [])  # the text goes through once
    read = text_col if given else "_text"
    kept = docs.select(F.col(id_col).alias("doc_id"), *(also or []), *([] if given else [F.col(text_col).alias(read)]))

    def run(batches):
        import pyarrow as pa

        t, b = shared.value
        known: dict[str, float] = {}
        for batch in batches:
            # some rows at a time go on: whole batches of long texts would be held twice
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                scores = score_texts(t, b, [x or "" for x in some.column(read).to_pylist()], known)
                names = [c for c in some.schema.names if given or c != read]
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in names], pa.array(scores, pa.float64())], [*names, into])
        known.clear()
        give_back()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if given or f.name != read)
    return kept.mapInArrow(run, f"{schema}, `{into}` double")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The trained table and bias, or a constant where one kind of label is missing."""
    texts, y = training_rows(docs, labels)
    if not len(y) or y.min() == y.max():
        share = min(max(y.mean() if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    return fit_texts(texts, y)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs, *fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
