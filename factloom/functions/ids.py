"""Deterministic identifiers: canonical JSON names, UUIDv5 and SHA-256 as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.config import NAMESPACE


def let(value: Column, body) -> Column:
    """body(value), with value standing once in the plan however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def json_string(value: Column) -> Column:
    """A string as canonical JSON: quotes, backslashes and control characters escaped, null as __NULL__, empty as __EMPTY__."""
    text = let(value, lambda v: F.when(v.isNull(), "__NULL__").when(v == "", "__EMPTY__").otherwise(v))
    text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for code, short in ((8, "\\b"), (9, "\\t"), (10, "\\n"), (12, "\\f"), (13, "\\r")):
        text = F.replace(text, F.lit(chr(code)), F.lit(short))
    return F.concat(F.lit('"'), text, F.lit('"'))


def json_name(*parts: Column | str | int) -> Column:
    """The canonical JSON array of the parts; plain str and int are literals, ints and integer columns stay numbers."""
    out: list[Column] = []
    for part in parts:
        if isinstance(part, int):
            out.append(F.lit(str(part)))
        elif isinstance(part, str):
            out.append(json_string(F.lit(part)))
        else:
            out.append(json_string(part.cast("string")))
    return F.concat(F.lit("["), F.concat_ws(",", *out), F.lit("]"))


def number(value: Column) -> Column:
    """An integer column as it stands in a canonical JSON array."""
    return F.coalesce(value.cast("string"), F.lit('"__NULL__"'))


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    """UUIDv5 of a name in a namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))

    def laid_out(h: Column) -> Column:
        variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
        return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))

    return let(digest, laid_out)


def entity_id(*parts: Column | str | int, namespace: str = NAMESPACE) -> Column:
    """UUIDv5 of the canonical JSON array of the parts."""
    return uuid5(json_name(*parts), namespace)


def surface_hash(surface: Column) -> Column:
    """SHA-256 of a surface, null standing for a fixed word."""
    return F.sha2(F.coalesce(surface, F.lit("__NO_SURFACE__")), 256)
