"""Normal forms, similarity and labels of text."""

from __future__ import annotations

import json
import math
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.ids import json_string
from factloom.functions.times import from_any, iso_ms


def collapsed(value: Column) -> Column:
    """Lower case, runs of white space as one blank, trimmed."""
    return F.lower(F.trim(F.regexp_replace(value, r"(?U)\s+", " ")))


def entity_key(kind: Column, surface: Column) -> Column:
    """The key under which surfaces of one entity type meet."""
    low = F.lower(F.trim(surface))
    return (
        F.when(kind == "URL", F.regexp_extract(low, r"^([^?#]*)", 1))
        .when(kind == "DOI", F.regexp_replace(low, r"^doi:", ""))
        .when(kind.isin("IP_ADDRESS", "FILEPATH"), F.trim(surface))
        .when(kind == "PHONE", F.regexp_replace(surface, r"[\s\-()]", ""))
        .when(kind.isin("PERSON", "ORG", "LOCATION", "CUSTOM_TERM"), collapsed(surface))
        .otherwise(low)
    )


def inferred_type(surface: Column) -> Column:
    """Organisation by its ending, person by its sigil, else a term."""
    ending = [surface.endswith(x) for x in (" Inc.", " Corp.", " LLC", " Ltd.")]
    return F.when(ending[0] | ending[1] | ending[2] | ending[3], "ORG").when(surface.startswith("@"), "PERSON").otherwise("CUSTOM_TERM")


def trimmed_url(value: Column) -> Column:
    """Without the punctuation that ends a sentence rather than an address."""
    return F.regexp_replace(value, r"[.,;:!?)>\]]+$", "")


def project_of(title: Column) -> Column:
    """What stands before the first separator of a title, if it is 1 to 40 characters."""
    left = F.trim(F.split(title, r":|\||\s-\s|\s—\s|\s–\s", 2)[0])
    has = title.rlike(r":|\||\s-\s|\s—\s|\s–\s")
    return F.when(has & F.length(left).between(1, 40), left)


def nfkc(value: Column | str) -> Column:
    """Unicode compatibility form."""

    @F.pandas_udf("string")
    def of(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    return of(value)


def jaro_winkler_of(a: str, b: str) -> float:
    """Jaro-Winkler similarity with the prefix boost always applied (prefix up to 4, weight 0.1)."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used = [False] * len(b)
    from_a = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                from_a.append(c)
                break
    if not from_a:
        return 0.0
    from_b = [c for c, u in zip(b, used, strict=True) if u]
    swaps = sum(x != y for x, y in zip(from_a, from_b, strict=True)) / 2
    m = len(from_a)
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def jaro_winkler(a: Column | str, b: Column | str) -> Column:
    """jaro_winkler_of() over columns; null where either is null."""

    @F.pandas_udf("double")
    def of(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else jaro_winkler_of(x, y) for x, y in zip(xs, ys, strict=True)], dtype="float64")

    return of(a, b)


def json_path(value: Column, path: str) -> Column:
    """What stands at a path ($.a.b) of a JSON text, as text; null if nothing does."""
    return F.get_json_object(value, path)


def canonical_json_of(kind: str, text: str) -> str:
    """A number or JSON text in canonical form: keys in order, no blanks; what cannot be read stands as a string."""
    try:
        value = float(text) if kind == "number" else json.loads(text)
        if kind == "number" and not math.isfinite(value):
            value = text
    except ValueError:
        value = text
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def literal_json(kind: Column, value: Column) -> Column:
    """A literal of a type (string, number, boolean, date, json) as canonical JSON."""

    @F.pandas_udf("string")
    def of(kinds: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None or k is None else canonical_json_of(k, t) for k, t in zip(kinds, texts, strict=True)], dtype="object")

    read = kind.isin("number", "json")
    return (
        F.when(read, of(F.when(read, kind), F.when(read, value)))
        .when(kind == "boolean", F.lower(value).isin("true", "1", "yes").cast("string"))
        .when(kind == "date", json_string(F.coalesce(iso_ms(from_any(value)), value)))
        .otherwise(json_string(value))
    )
