"""Named entities by a recogniser of the user's choice, run over long texts in overlapping chunks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: From a list of texts to the (start, end, label) of each one's entities.
Recogniser = Callable[[list[str]], list[list[tuple[int, int, str]]]]

# Labels that count, and the kinds they stand for.
KINDS = {"PERSON": "PERSON", "ORG": "ORG", "GPE": "LOCATION", "LOC": "LOCATION"}
CONFIDENCE = 0.80


def gazetteer(names: dict[str, str]) -> Recogniser:
    """A recogniser of given names (name to label), whole words, the longest first."""
    pattern = re.compile(r"\b(?:" + "|".join(re.escape(n) for n in sorted(names, key=lambda n: (-len(n), n))) + r")\b")

    def find(texts: list[str]) -> list[list[tuple[int, int, str]]]:
        return [[(m.start(), m.end(), names[m.group()]) for m in pattern.finditer(t)] for t in texts]

    return find


def chunks_of(text: str, size: int, stride: int) -> Iterator[tuple[int, str]]:
    """A text's chunks with their offsets: itself if it fits, else of the size, each sharing the stride with the one before."""
    if stride >= size:
        raise ValueError("chunks must go forward")
    begin = 0
    while True:
        yield begin, text[begin : begin + size]
        if begin + size >= len(text):
            return
        begin += size - stride


def recognised(messages: DataFrame, load: Callable[[], Recogniser], name: str = "NER:MODEL", size: int = 10_000, stride: int = 1_000, batch_chars: int = 1_000_000) -> DataFrame:
    """message_id, detector, kind, start, end, surface, confidence and reason (null) of the entities of messages, as detect.candidates() gives them.

    load makes the recogniser, once a task. Labels outside KINDS are left out; what
    two chunks share counts once. Null texts have none.
    """
    rows = messages.where(F.col("text").isNotNull()).select("message_id", "text")
    id_type = rows.schema["message_id"].dataType.simpleString()

    def run(batches):
        import pandas as pd

        find = load()

        def flush(pending):
            seen = {}
            for (row, key, offset, chunk), found in zip(pending, find([c for *_, c in pending]), strict=True):
                for a, b, label in found:
                    if label in KINDS:
                        seen[row, offset + a, offset + b, KINDS[label], chunk[a:b]] = key
            return [(key, name, kind, a, b, surface, CONFIDENCE, None) for (_, a, b, kind, surface), key in seen.items()]

        for frame in batches:
            out, pending, held = [], [], 0
            for row, (key, text) in enumerate(zip(frame["message_id"], frame["text"], strict=True)):
                # a text's chunks stay in one call, so that what they share is seen
                pending += [(row, key, offset, chunk) for offset, chunk in chunks_of(text, size, stride)]
                held += len(text)
                if held >= batch_chars:
                    out += flush(pending)
                    pending, held = [], 0
            out += flush(pending) if pending else []
            yield pd.DataFrame(out, columns=["message_id", "detector", "kind", "start", "end", "surface", "confidence", "reason"])

    return rows.mapInPandas(run, f"message_id {id_type}, detector string, kind string, start int, end int, surface string, confidence double, reason string")
