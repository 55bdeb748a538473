"""Line dedup by a log-template tree of fixed depth.

Lines are parsed down a tree: token count, then the leading tokens, to a leaf.
Tokens that hold a digit are variable fields from the start. A template is
either a masked line as it stands, or, within a leaf, a line generalised: a
token stays if it stands at that place in lines of at least ``min_docs``
documents, all others become variable; a generalised line counts only if at
least ``similarity`` of its tokens stay. A line has its own template and all those
of its leaf that leave more places open and agree elsewhere; lines whose masked
form recurs count too. Templates found in at least
``min_docs`` documents recur, and their lines are dropped everywhere. With
``keep_first`` their first occurrence (least doc_id, then row and line) stays, so
that documents that are copies of one another are not emptied all of them.

For lines of more than ``long_tokens`` tokens ``long_docs`` documents are enough.
With ``keep_first`` and ``spare`` (width, percent) lines that recur by that alone stay in a document
that is, without its other dropped lines, a near copy of the document of the
first occurrence: such documents are left whole for document dedup.

Lines of fewer than ``min_tokens`` tokens, blank lines included, are never
dropped. Null text stays null. Documents that are equal in id and text count
once. A document may be left with the empty text. An empty table gives an empty
one. The columns of docs come back as they were, with the text replaced
(and ``length_col``, where there is one, brought up to date).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.shared import Cuts

VARIABLE = "<*>"
DEPTH = 3
SMALL_ROWS = 1 << 18  # rows of a few numbers that may be broadcast (about 10 MB)


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def _masked(line: Column) -> Column:
    """The line with single spaces between its tokens, those that hold a digit made variable."""
    untidy = line.contains("  ") | line.contains("\t") | line.contains("\r") | line.contains("\f") | line.contains("\x0b")
    spaced = F.trim(F.when(untidy, F.regexp_replace(line, r"[ \t\r\f\x0B]+", " ")).otherwise(line))
    return F.when(spaced.rlike("[0-9]"), F.regexp_replace(spaced, r"(?<![^ ])[^ 0-9]*[0-9][^ ]*", VARIABLE)).otherwise(spaced)


def parsed_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, id, line_no, n (tokens), leaf and template of every line."""
    lines = docs.select(F.col(id_col).alias("id"), _row_key(id_col, text_col).alias("key"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
    lines = lines.withColumn("masked", _masked(F.col("line")))
    n = F.when(F.col("masked") == "", 0).otherwise(F.char_length("masked") - F.char_length(F.replace("masked", F.lit(" "), F.lit(""))) + 1)
    return lines.select("id", "key", "line_no", n.alias("n"), F.xxhash64(n, F.substring_index("masked", " ", DEPTH)).alias("leaf"), F.xxhash64(n, "masked").alias("template"))


def line_tokens(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key, at, token (its hash) and the other columns of the wanted lines (key, line_no, n, leaf and others)."""
    others = [c for c in wanted.columns if c != "key"]
    per_row = wanted.groupBy("key").agg(F.collect_list(F.struct(*others)).alias("wanted")).withColumnRenamed("key", "_key")
    rows = docs.select(F.col(id_col).alias("id"), _row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    met = rows.join(F.broadcast(per_row) if wanted.count() <= SMALL_ROWS else per_row, F.col("key") == F.col("_key")).select("id", "key", F.split("text", "\n").alias("lines"), F.explode("wanted").alias("w"))
    tokens = met.select("id", "key", "w.*", F.split(_masked(F.get("lines", F.col("w.line_no"))), " ").alias("tokens"))
    return tokens.select("id", "key", *others, F.posexplode(F.transform("tokens", lambda t: F.xxhash64(t))).alias("at", "token"))


def _checked(small: DataFrame) -> DataFrame:
    """The same table, to be broadcast if it has been counted and found small."""
    return F.broadcast(small) if small.count() <= SMALL_ROWS else small


def _recurring(found: DataFrame, by: str, needed: Column) -> DataFrame:
    """by, n, leaf, docs, first (id, key, line_no) for each value that as many documents as needed (by n) have; a row may stand for ``held`` documents."""
    held = F.max("held") if "held" in found.columns else F.lit(0)
    once = found.groupBy(by, "n", "leaf", "key").agg(F.min(F.struct("id", "key", "line_no")).alias("first"), held.alias("held"))
    docs = F.greatest(F.count(F.lit(1)), F.max("held")).alias("docs")
    return once.groupBy(by, "n", "leaf").agg(docs, F.min("first").alias("first")).where(F.col("docs") >= needed)


def _wider(general: DataFrame) -> DataFrame:
    """narrow and template: the templates of a leaf whose places are some of another's (narrow) and agree with it there."""
    places = F.transform("kept", lambda k: k["at"])
    forms = general.select("leaf", "kept", F.col("template").alias("narrow")).distinct()
    shapes = general.where("held = 0").select("leaf", places.alias("places")).distinct()
    met = forms.join(shapes, "leaf").where(F.size("kept") > F.size("places"))
    there = F.filter("kept", lambda k: F.array_contains("places", k["at"]))
    met = met.select("leaf", "narrow", "places", there.alias("there")).where(F.size("there") == F.size("places"))
    found = general.where("held = 0").select("template").distinct()
    return met.select("narrow", F.xxhash64("leaf", "there").alias("template")).join(found, "template")


def _without(docs: DataFrame, drops: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with _drop_key and _left (the text without the lines in drops; as it stands where there are none)."""
    per_row = drops.groupBy("key").agg(F.collect_set("line_no").alias("numbers")).toDF("_drop_key", "_drop_numbers")
    joined = docs.join(per_row, _row_key(id_col, text_col) == F.col("_drop_key"), "left")
    left = F.array_join(F.filter(F.split(text_col, "\n"), lambda line, i: ~F.array_contains("_drop_numbers", i)), "\n")
    return joined.withColumn("_left", F.when(F.col("_drop_numbers").isNull(), F.col(text_col)).otherwise(left))


def _shingles(text: Column, width: int) -> Column:
    """Hashes of the distinct runs of width words (all words, if they are fewer), words taken as document dedup takes them."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.split(F.trim(F.regexp_replace(F.translate(text, upper, upper.lower()), r"[\x20\x09-\x0D]+", " ")), " ")

    def runs(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - width + 1, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice(w, i, width), " ")))

    return F.array_distinct(F.flatten(F.transform(F.array(words), runs)))


def _near_copies(cuts: Cuts, docs: DataFrame, pairs: DataFrame, drops: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (key, kept) of rows that are near copies without the lines in drops."""
    keys = _checked(cuts.add(pairs.select("key").union(pairs.select("kept")).distinct().toDF("_key")))
    some = docs.select(F.col(id_col), F.col(text_col)).join(keys, _row_key(id_col, text_col) == F.col("_key")).dropDuplicates(["_key"])
    sets = cuts.add(_without(some, drops, id_col, text_col).select("_key", _shingles(F.col("_left"), width).alias("set")))
    met = pairs.join(sets.toDF("key", "one"), "key").join(sets.toDF("kept", "two"), "kept").withColumn("both", F.size(F.array_intersect("one", "two")))
    return met.where(100 * F.col("both") >= percent * (F.size("one") + F.size("two") - F.col("both"))).select("key", "kept")


def dropped_lines(docs: DataFrame, min_docs: int = 3, min_tokens: int = 3, similarity: float = 0.7, keep_first: bool = False, long_tokens: int = 50, long_docs: int = 2, spare: tuple[int, int] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key (of a row's id and text) and line_no of the lines to drop."""
    cuts = Cuts()
    needed = F.when(F.col("n") > long_tokens, min(long_docs, min_docs)).otherwise(min_docs)
    lines = cuts.add(parsed_lines(docs, id_col, text_col)).where(F.col("n") >= min_tokens)  # after the cut: before it, masks would be made twice
    exact = cuts.add(_recurring(lines, "template", needed))
    known = _checked(exact.select("template"))
    # lines of up to DEPTH tokens are their own leaves: nothing is left to generalise
    longer = lines.where(F.col("n") > DEPTH)
    leaves = cuts.add(longer.groupBy("leaf", "n", "key").agg(F.lit(1).alias("one")).groupBy("leaf", "n").count().where(F.col("count") >= needed).select("leaf"))
    rest = cuts.add(longer.join(_checked(leaves), "leaf", "left_semi").join(known, "template", "left_anti").select("key", "line_no", "n", "leaf", F.lit(0).cast("long").alias("held")).distinct())
    # one line stands for each recurring masked form of these leaves: its tokens stay, as all its documents have them
    standing = exact.where(F.col("n") > DEPTH).join(_checked(cuts.add(rest.select("leaf").distinct())), "leaf", "left_semi").select("first.key", "first.line_no", "n", "leaf", F.col("docs").alias("held"))
    tokens = cuts.add(line_tokens(docs, cuts.add(rest.unionByName(standing)), id_col, text_col))
    fixed = tokens.groupBy("leaf", "n", "at", "token", "key").agg(F.max("held").alias("held")).groupBy("leaf", "n", "at", "token").agg(F.greatest(F.count(F.lit(1)), F.max("held")).alias("docs")).where(F.col("docs") >= needed).select("leaf", "at", "token")
    general = tokens.join(fixed, ["leaf", "at", "token"]).groupBy("id", "key", "line_no", "n", "leaf", "held").agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("kept"))
    general = general.where(F.size("kept") >= F.col("n") * similarity)
    general = cuts.add(general.withColumn("template", F.xxhash64("leaf", "kept")))
    cuts.drop(tokens)
    own = general.drop("kept")
    wider = cuts.add(_wider(general))
    matched = cuts.add(own.unionByName(own.withColumnRenamed("template", "narrow").join(_checked(wider), "narrow").drop("narrow")))
    by_field = _recurring(matched, "template", needed)
    if not keep_first:
        recurring = _checked(cuts.add(by_field.select("template")))
        drops = lines.join(known, "template", "left_semi").select("key", "line_no").unionByName(matched.where("held = 0").join(recurring, "template", "left_semi").select("key", "line_no").distinct())
        drops = cuts.add(drops)
        cuts.keep_only(drops)
        return drops

    def to_drop(all_lines: DataFrame, recurring: DataFrame) -> DataFrame:
        met = all_lines.select("key", "line_no", "template").join(recurring.select("template", "docs", "first"), "template")
        is_first = (F.col("key") == F.col("first.key")) & (F.col("line_no") == F.col("first.line_no"))
        return met.select("key", "line_no", "first", is_first.alias("is_first"), (F.col("docs") < min_docs).alias("by_length"))

    by_form = to_drop(lines, _checked(exact)).select("key", "line_no", F.col("first.key").alias("kept"), "is_first", "by_length")
    field = to_drop(matched.where("held = 0"), by_field).groupBy("key", "line_no")
    field = field.agg(F.min("first").alias("first"), F.max("is_first").alias("is_first"), F.min("by_length").alias("by_length"))
    drops = cuts.add(by_form.unionByName(field.select("key", "line_no", F.col("first.key").alias("kept"), "is_first", "by_length")).where("not is_first").drop("is_first"))
    cuts.keep_only(drops)
    if not spare:
        return drops.select("key", "line_no")
    others = drops.where("not by_length").select("key", "line_no")
    pairs = cuts.add(drops.where("by_length and key <> kept").select("key", "kept").distinct())
    near = _checked(cuts.add(_near_copies(cuts, docs, pairs, others, *spare, id_col, text_col)))
    left = cuts.add(others.unionByName(drops.where("by_length").join(near, ["key", "kept"], "left_anti").select("key", "line_no")))
    cuts.keep_only(left)
    return left


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_tokens: int = 3, similarity: float = 0.7, keep_first: bool = False, long_tokens: int = 50, long_docs: int = 2, spare: tuple[int, int] | None = None, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """docs, each text without its lines whose template recurs across documents."""
    drops = dropped_lines(docs, min_docs, min_tokens, similarity, keep_first, long_tokens, long_docs, spare, id_col, text_col)
    joined = _without(docs, drops, id_col, text_col)
    text = F.col("_left")
    new = {text_col: text, length_col: F.char_length(text).cast(docs.schema[length_col].dataType)} if length_col in docs.columns else {text_col: text}
    return joined.select(*[new[c].alias(c) if c in new else docs[c] for c in docs.columns])
