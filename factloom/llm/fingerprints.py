"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

A spot signature is an anchor (a common word) with the one to three content
words after it, up to the next anchor. Where CHAIN content words stand without an
anchor among them they are a chain of their own, and so are those of a text that
has fewer and no anchor. A document's fingerprint is the sorted set of its
signatures' 64-bit hashes, sixteen hex digits each; a text without a signature
(no word, or nothing but anchors) has one, its own hash. Null and empty texts
have the empty fingerprint; two empty fingerprints have likeness 1, an empty one
and another 0.

Likeness is the Jaccard similarity of the sets. Documents alike are found by the
set join of ``jaccard_join``: signatures rarest first, prefixes, partitions by
set length, pruned comparison, all over one representative of each fingerprint.
Fingerprints that reach ``percent`` by steps are one group.

Equal texts have equal fingerprints. Ids must be whole numbers. Repeated rows,
ties in doc_id (then by the text's hash) and null ids (first) are put in one
definite order. Columns other than the id and the text are left aside, whatever
their names. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.jaccard_join import components_of, row_key
from factloom.llm.shared import Cuts, cut, drop_cut

# Common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au avec dans de des du en est et la le les par pas pour que qui sur un une "
    "als auch auf das den der die ein eine für im ist mit nicht sich und von zu "
    "al como con del el es las lo los más no para por se su y"
).split()

CHAIN = 8
SMALL_ROWS = 1 << 18  # rows of five numbers that may be broadcast (about 20 MB)


def _alternatives() -> str:
    """The anchors by first letter, so that most words are told apart at once."""
    by_first: dict[str, list[str]] = {}
    for word in sorted(set(ANCHORS)):
        by_first.setdefault(word[0], []).append(word[1:])
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by_first.items())


ANCHORED = f" ({_alternatives()}) "
_CONTENT = "(?: [^ @][^ ]*)"
SPOT = f" @[^ ]+{_CONTENT}{{1,3}}|{_CONTENT}{{{CHAIN}}}|^{_CONTENT}{{1,{CHAIN - 1}}} $"


def spots_in(text: Column) -> Column:
    """A text's signatures in order: words in lower case, each after a blank, anchors marked by @."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    marked = F.regexp_replace(F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" ")), ANCHORED, " @$1 ")
    return F.regexp_extract_all(F.replace(marked, F.lit("  "), F.lit(" ")), F.lit(SPOT), F.lit(0))


def spot_hashes(text: Column) -> Column:
    """The sorted set of a text's signature hashes (array of sixteen hex digits each)."""
    hashes = _let(spots_in(text), lambda found: F.transform(F.when(F.size(found) > 0, found).otherwise(F.array(text)), lambda x: F.substring(F.md5(x.cast("binary")), 1, 16)))
    return F.when(text.isNull() | (text == ""), F.array().cast("array<string>")).otherwise(F.sort_array(F.array_distinct(hashes)))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes."""
    either = F.size(a) + F.size(b)
    return F.when(either == 0, F.lit(1.0)).otherwise(_let(F.size(F.array_intersect(a, b)), lambda n: n / (either - n)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_spots, fingerprint, and the set itself (spots), of every row."""
    spots = docs.select(F.col(id_col).alias("doc_id"), spot_hashes(F.coalesce(F.col(text_col), F.lit(""))).alias("spots"))
    return spots.select("doc_id", F.size("spots").alias("n_spots"), F.array_join("spots", "").alias("fingerprint"), "spots")


def alike(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """c1, c2 (of a fingerprint), class_id, alike_id and all_rows: the least doc_id of equal fingerprints, and of those that reach ``percent`` by steps, with how many rows these are."""
    cuts = Cuts()
    r1, r2 = row_key(id_col, text_col)
    spots = docs.select(F.col(id_col).alias("doc_id"), r1.alias("r1"), r2.alias("r2"), spot_hashes(F.coalesce(F.col(text_col), F.lit(""))).alias("spots"))
    c1, c2 = class_key(F.col("spots"))
    rows = cuts.add(spots.select("doc_id", "r1", "r2", c1.alias("c1"), c2.alias("c2"), F.size("spots").cast("long").alias("n"), F.transform("spots", lambda x: F.xxhash64(x)).alias("tokens")))

    def first(sets: DataFrame, share: float, least: int) -> DataFrame:
        top = int((share - 0.5) * 2.0**64) if share < 1 else (1 << 63) - 1
        return sets.where(F.size("tokens") >= least).select("c1", F.explode(F.filter("tokens", lambda t: t <= top)).alias("token"))

    named = components_of(rows, rows.select("r1", "r2", "c1", "tokens"), cuts, percent, first, lambda chosen: chosen.select("class", "n", "tokens"))
    cuts.drop(rows)
    return named.select("c1", "c2", F.col("first_id").alias("class_id"), F.col("component_id").alias("alike_id"), "all_rows")


def class_key(spots: Column) -> list[Column]:
    """128 bits of a fingerprint."""
    return [F.xxhash64(F.lit(salt), spots) for salt in (1, 2)]


def _ranges(docs: DataFrame, bucket_bytes: int, cells: int, levels: int = 4) -> DataFrame:
    """docs (doc_id, text) with _bucket: ranges of (doc_id, hash of the text), in order, of about ``bucket_bytes`` of text.

    What is more than a bucket is cut into as many equal ranges, ``cells`` at
    most, between its least and greatest id (null ids apart and first), or by the
    text's hash where there is but one id; what is still more is cut again.
    """
    placed = docs.select("doc_id", "text", F.lit(0).cast("long").alias("_bucket"))
    share = F.shiftrightunsigned(F.xxhash64("text").bitwiseXOR(F.lit(-(1 << 63))), 11) / float(1 << 53)
    for _ in range(levels):
        sizes = placed.groupBy("_bucket").agg(F.sum(F.octet_length("text") + 16).alias("bytes"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        parts = F.least(F.lit(cells), F.ceil(F.col("bytes") * 2 / bucket_bytes)).cast("long")
        heavy = sizes.where(F.col("bytes") > 2 * bucket_bytes).withColumn("parts", parts)
        heavy = cut(heavy.select("_bucket", "lo", "parts", F.expr("lo <=> hi").alias("single"), F.expr("(hi - lo) div parts + 1").alias("step")))
        found = heavy.count()
        if not found:
            drop_cut(heavy)
            break
        by_hash = F.least(F.floor(share * F.col("parts")), F.col("parts") - 1)
        part = F.when(F.col("parts").isNull(), 0).when(F.expr("single and (lo is null or doc_id is not null)"), by_hash + 1).when(F.col("doc_id").isNull(), 0).otherwise(F.expr("(doc_id - lo) div step + 1"))
        placed = placed.join(F.broadcast(heavy) if found <= SMALL_ROWS else heavy, "_bucket", "left").select("doc_id", "text", (F.col("_bucket") * (cells + 2) + part).cast("long").alias("_bucket"))
    return placed


def with_next(docs: DataFrame, derive: dict[str, Column], carried: list[str], bucket_bytes: int = 8 << 20, cells: int = 1 << 14) -> DataFrame:
    """docs (doc_id, text) and the derived columns, with struct ``next`` of the carried columns of the following row by doc_id, the last followed by the first.

    Each range of rows also gets the first row of the range after it, so that no
    sort spans them all.
    """
    placed = _ranges(docs, bucket_bytes, cells)
    heads = placed.groupBy("_bucket").agg(F.min(F.struct("doc_id", F.xxhash64("text").alias("hash"))).alias("head")).withColumn("block", F.expr(f"_bucket div {cells}"))
    # the bucket before each: within blocks of buckets, then over the blocks, of which there are few
    inside = Window.partitionBy("block").orderBy("_bucket")
    blocks = heads.groupBy("block").agg(F.max("_bucket").alias("last"))
    around = Window.orderBy("block")
    blocks = blocks.select("block", F.coalesce(F.lag("last").over(around), F.max("last").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    ring = heads.withColumn("own", F.lag("_bucket").over(inside)).join(F.broadcast(blocks), "block").select(F.coalesce("own", "before").alias("_bucket"), F.col("head.doc_id").alias("_id"), F.col("head.hash").alias("_hash"))
    ring = F.broadcast(ring) if ring.count() <= SMALL_ROWS else ring
    ghosts = docs.join(ring, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash"))).select("doc_id", "text", "_bucket", F.lit(1).alias("_ghost"))
    dealt = placed.withColumn("_ghost", F.lit(0)).unionByName(ghosts).repartition("_bucket").withColumns(derive)  # the text alone is shuffled
    order = Window.partitionBy("_bucket").orderBy("_ghost", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    return dealt.withColumn("next", F.lead(F.struct(*carried)).over(order)).where("_ghost = 0").drop("_bucket", "_ghost")


def fingerprint_report(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document, and the documents whose fingerprints are like its own (class_id, alike_id)."""
    groups = alike(docs, percent, id_col, text_col).where("all_rows > 1").select(F.col("c1").alias("_c1"), F.col("c2").alias("_c2"), "class_id", "alike_id")
    groups = F.broadcast(groups) if groups.count() <= SMALL_ROWS else groups
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = F.char_length("text")
    moved = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - moved), F.substr("next.text", F.lit(1), moved))
    rows = with_next(plain, {"spots": spot_hashes(F.col("text"))}, ["text", "spots"]).select("doc_id", n.cast("long").alias("n_chars"), "spots", edited.alias("edited"), F.col("next.spots").alias("next_spots"))
    rows = rows.select("doc_id", "n_chars", "spots", "next_spots", F.sha2("edited", 256).alias("edited_sha256"), spot_hashes(F.col("edited")).alias("edited_spots"))
    c1, c2 = class_key(F.col("spots"))
    rows = rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.array_join("spots", "").alias("fingerprint"),
        F.array_join("edited_spots", "").alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
        c1.alias("c1"),
        c2.alias("c2"),
    )
    met = rows.join(groups, (F.col("c1") == F.col("_c1")) & (F.col("c2") == F.col("_c2")), "left").drop("c1", "c2", "_c1", "_c2")
    grouped = F.col("fingerprint") != ""
    return met.withColumns({c: F.when(grouped, F.coalesce(c, "doc_id")).otherwise(F.col("doc_id")) for c in ("class_id", "alike_id")})
