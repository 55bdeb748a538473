"""Token counts by batch encoding in Arrow functions that return lengths only.

Batches are balanced by bytes, not rows: texts are packed into encoder calls of
about ``batch_bytes``; a longer text is cut at safe boundaries, so that no call
holds more and the sum of its parts' lengths is the whole text's length.

A boundary is safe between a character that is not white space and a single
ASCII space followed by another that is not: the byte-level pre-tokenizer
always ends a piece there, and no special string holds a space.

Nulls count as the empty text (0 bytes, 0 tokens). Repeated rows are counted
row by row; other columns, whatever their names, are left aside. An empty table
gives an empty table.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.shared import bounded_batches

_LOADED: dict[str, object] = {}


def load_tokenizer(path: str):
    """The tokenizer of a .json file, loaded once in each process."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def safe_parts(text: str, limit: int) -> list[str]:
    """text in parts of at least ``limit`` characters, cut at safe boundaries only."""
    if len(text) <= 2 * limit:
        return [text]
    parts, start, at = [], 0, limit
    while (at := text.find(" ", at)) != -1 and at < len(text) - 1:
        if text[at - 1].isspace() or text[at + 1].isspace() or not (text[at - 1].isalnum() and text[at - 1].isascii()):
            at += 1
            continue
        parts.append(text[start:at])
        start, at = at, at + limit
    return [*parts, text[start:]]


def encoded_lengths(texts: Iterable[str], tokenizer, batch_bytes: int) -> Iterator[list[int]]:
    """Lists of token counts, in order, as batches of bytes fill up."""
    counts: list[int] = []
    parts: list[str] = []
    owner: list[int] = []
    held = 0

    def encode() -> None:
        for i, e in zip(owner, tokenizer.encode_batch_fast(parts, add_special_tokens=False), strict=True):
            counts[i] += len(e)

    for text in texts:
        counts.append(0)
        for part in safe_parts(text, batch_bytes // 4):
            parts.append(part)
            owner.append(len(counts) - 1)
            held += len(part) if part.isascii() else len(part.encode("utf-8", "surrogatepass"))
            if held >= batch_bytes:
                encode()
                parts, owner, held = [], [], 0
    if parts:
        encode()
    yield counts


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 18) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row."""
    bounded_batches(docs.sparkSession)
    kept = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = kept.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        tokenizer = load_tokenizer(tokenizer_path)
        for batch in batches:
            texts = batch.column("text")
            counts = [n for some in encoded_lengths((x.as_py() for x in texts), tokenizer, batch_bytes) for n in some]
            sizes = pc.binary_length(texts).cast(pa.int64())
            tokens = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, tokens, pc.greater(tokens, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return kept.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
