"""N-gram Jaccard self-join by a grouped prefix join, up to connected components.

Words are what lies between ASCII white space, A-Z lowered; a document's set is
that of its distinct ``width``-word shingles (all its words, if they are fewer).
Two documents link if 100 * |A and B| >= percent * |A or B|.

1. Documents of equal sets are one class from here on.
2. Tokens that no other class has can be in no overlap. A class with as many of
   them as its prefix is long, n - ceil(percent * n / 100) + 1, links with
   nothing and goes; this is found from a hash range of all tokens first, then,
   for what is left, from all of its tokens.
3. Prefixes are taken in order of frequency, rarest first, so that a passage of
   many documents is in the prefix of those only that consist of little else.
   Classes with equal shared prefix, size and number of own tokens form a group.
4. Groups that share a prefix token meet that token's pivot group (fewest own
   tokens; a group that shares none is its own pivot); members are verified
   against the group's and the pivot's first member on whole sets, and
   components taken.
5. Where a token's other classes still lie in several components, links across
   them are looked for by differences to the token's pivot: what a class has and
   the pivot has not, or the other way round. Two classes whose differences are
   small enough together link for certain; the one nearest to the pivot stands
   for the others there. Any other two that link share so many of their
   differences that they meet by pivot and difference, in prefixes of these, the
   rarest first, bounded by position. So neither a passage of many documents nor
   a large group of near copies makes its members meet one another.

Sets are compared by 64-bit hashes of their shingles; classes are told apart by
128 bits, rows by 128 bits of id and text. Null and empty texts have size 0 and
link with nothing. Equal texts, and repeated rows, are one class. Null ids are
allowed: they never name a component unless all its ids are null. An empty table
gives an empty table. Other columns, whatever their names, are left aside.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.components import connected_components
from factloom.llm.shared import Cuts, bounded_batches, give_back

ROUNDS = 2  # of members meeting one of their list; pairs are looked for afterwards, whatever is left
SMALL_ROWS = 1 << 18  # rows of four numbers that may be broadcast (about 16 MB)


def _signed(hashes: np.ndarray) -> np.ndarray:
    """Hashes as signed numbers in the same order."""
    return (hashes ^ np.uint64(1 << 63)).view(np.int64)


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits of a row's id and text, nulls told from empty ones."""
    key, text = F.col(id_col).cast("string"), F.col(text_col)
    return [F.xxhash64(F.lit(salt), key.isNull(), key, text.isNull(), text) for salt in (1, 2)]


def _prefix(n: Column, percent: int) -> Column:
    return n - F.floor((n * percent + 99) / 100) + 1


def _sets(batch, width: int):
    """(first row, sets) of slices of an Arrow batch's text column."""
    import pyarrow.compute as pc

    from factloom.llm.shingles import shingle_sets, slices

    texts = pc.fill_null(batch.column("text"), "").cast("binary")
    for at, to in slices(pc.binary_length(texts).to_pylist()):
        yield at, shingle_sets(texts.slice(at, to - at).to_pylist(), width)


def set_classes(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, r1 and r2 (of id and text), c1 and c2 (of the set) and n of every row."""
    r1, r2 = row_key(id_col, text_col)
    kept = docs.select(F.col(id_col).alias("doc_id"), r1.alias("r1"), r2.alias("r2"), F.col(text_col).alias("text"))
    id_type = kept.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        from factloom.llm.shingles import set_identity

        for batch in batches:
            found = [(*set_identity(s), len(s)) for _, some in _sets(batch, width) for s in some]
            numbers = [pa.array([x[i] for x in found], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "r1", "r2")], *numbers], ["doc_id", "r1", "r2", "c1", "c2", "n"])
        give_back()

    return kept.mapInArrow(run, f"doc_id {id_type}, r1 long, r2 long, c1 long, c2 long, n long")


def named_classes(rows: DataFrame) -> DataFrame:
    """class (a number of its own for each c1 and c2), c1, c2, alone (no other class has its c1), n, rows, first_id, and one of its rows (r1, r2, again: it repeats)."""
    once = rows.where("n > 0").groupBy("c1", "c2", "r1", "r2").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows")).withColumn("again", F.col("rows") > 1)
    classes = once.groupBy("c1", "c2").agg(F.sum("rows").alias("rows"), F.min("n").alias("n"), F.min("doc_id").alias("first_id"), F.min(F.struct("r1", "r2", "again")).alias("row"))
    same = Window.partitionBy("c1")
    ranked = classes.withColumns({"at": F.row_number().over(same.orderBy("c2")), "many": F.count(F.lit(1)).over(same)})
    key = F.when(F.col("at") == 1, F.col("c1")).otherwise(F.xxhash64("c1", "c2", "at"))
    return ranked.select(key.alias("class"), "c1", "c2", (F.col("many") == 1).alias("alone"), "n", "rows", "first_id", "row.*")


def _first_tokens(texts: DataFrame, width: int, share: float, least: int) -> DataFrame:
    """c1 and token of the tokens in the first part of the hash range, of sets of ``least`` and more."""
    top = np.uint64(min(int(share * 2.0**64), (1 << 64) - 1))

    def run(batches):
        import pyarrow as pa

        from factloom.llm.shingles import set_identity

        for batch in batches:
            for _, some in _sets(batch, width):
                some = [s for s in some if len(s) >= least]
                if not some:
                    continue
                kept = [s[: np.searchsorted(s, top, side="right")] for s in some]
                classes = np.repeat([set_identity(s)[0] for s in some], [len(x) for x in kept])
                yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(_signed(np.concatenate(kept)), pa.int64())], ["c1", "token"])
        give_back()

    return texts.select("text").mapInArrow(run, "c1 long, token long")


def _token_lists(chosen: DataFrame, width: int) -> DataFrame:
    """class, n and tokens (array) of rows of class, n and text."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at, some in _sets(batch, width):
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in some])]).astype(np.int32)
                values = pa.array(_signed(np.concatenate(some)), pa.int64())
                part = batch.slice(at, len(some))
                yield pa.RecordBatch.from_arrays([part.column("class"), part.column("n"), pa.ListArray.from_arrays(pa.array(offsets), values)], ["class", "n", "tokens"])
        give_back()

    return chosen.select("class", "n", "text").mapInArrow(run, "class long, n long, tokens array<long>")


def _held(small: DataFrame) -> DataFrame:
    """The same table of numbers, to be broadcast if it has been counted and found small."""
    return F.broadcast(small) if small.count() <= SMALL_ROWS else small


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes with n_a, n_b, own_a, own_b, set_a and set_b."""
    one, two = (sets.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("own").alias(f"own_{x}"), F.col("tokens").alias(f"set_{x}")) for x in "ab")
    return pairs.join(one, "a").join(two, "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For pairs (a, b) of classes: whether they are linked."""
    met = _with_sets(pairs, sets).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("set_a", "set_b")).alias("both"))
    return met.select("a", "b", (100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).alias("linked"))


def _differences(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For pairs (a, b): found, what one has and the other has not (without tokens that no other class has, which count in size only).

    n is the size of a, whole what of b counts, size the number of all
    differences, excess (100 + percent) x size - (100 - percent) x n: two classes
    link if their excesses come to 0 at most, and only if they share that
    sum / (2 x (100 + percent)) differences.
    """
    met = _with_sets(pairs, sets)
    found = F.concat(F.array_except("set_a", "set_b"), F.array_except("set_b", "set_a"))
    met = met.select("a", "b", F.col("n_a").alias("n"), "own_a", F.size("set_b").alias("whole"), found.alias("found"))
    met = met.select("a", "b", "n", "whole", (F.col("own_a") + F.size("found")).alias("size"), "found")
    return met.withColumn("excess", (100 + percent) * F.col("size") - (100 - percent) * F.col("n"))


def _difference_lists(apart: DataFrame, percent: int) -> DataFrame:
    """b, token and a for the differences by which classes of other components may meet, in prefixes, rarest first; left is how many from there on count, nearer whether it will do towards classes with more differences.

    apart is what _differences() gives, with the component of a. What only classes
    of one component have is shared with no other: it takes up the first places.
    """
    full = apart.select("a", "b", "component", F.explode("found").alias("token"))
    torn = full.groupBy("b", "token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("held")).where("lo <> hi").select("b", "token", "held")
    ranked = full.join(torn, ["b", "token"]).groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("ranked"))
    met = apart.drop("found").join(ranked, ["a", "b"])
    all_, twice, around = F.size("ranked"), 2 * (100 + percent), (100 - percent) * (F.col("n") + F.col("whole"))

    def length(needed: Column) -> Column:
        return F.greatest(F.lit(0), all_ - F.greatest(F.lit(1), F.ceil(needed / twice - 1e-9)) + 1).cast("int")

    as_farther, as_nearer = length((100 + percent) * F.col("size") - around + 2 * percent), length((100 + 3 * percent) * F.col("size") - around)
    prefixes = met.select("a", "b", "n", "size", "excess", "component", all_.alias("all"), as_nearer.alias("fewer"), F.posexplode(F.slice("ranked", F.lit(1), as_farther)).alias("at", "one"))
    return prefixes.select("b", F.col("one.token").alias("token"), "a", "n", "size", "excess", "component", (F.col("all") - F.col("at")).alias("left"), (F.col("at") < F.col("fewer")).alias("nearer"))


def class_links(plain: DataFrame, classes: DataFrame, cuts: Cuts, percent: int, first_tokens: Callable, token_lists: Callable) -> DataFrame:
    """Links (a, b) of classes that join every component; plain has r1, r2 and what the sets are made of, classes are as named_classes() gives them.

    first_tokens(plain, share, least) gives c1 and token of the tokens in the
    first share of the hash range, of sets of ``least`` and more; token_lists of
    plain rows with class and n gives class, n and tokens.
    """
    least = max(1, -(-percent // (100 - percent))) if percent < 100 else 1 << 62  # smaller sets link with their equals only

    # a part of the hash range that holds a prefix's length of a set's tokens with room to spare
    share = min(1.0, 1.4 * (100 - percent) / 100 + 0.06)
    tokens = first_tokens(plain, share, least).groupBy("token").agg(F.min("c1").alias("c1"), F.max("c1").alias("other"))
    lone = tokens.where("c1 = other").groupBy("c1").agg(F.count(F.lit(1)).alias("own"))
    possible = classes.where(F.col("n") >= least).join(lone, "c1", "left").where((F.coalesce("own", F.lit(0)) < _prefix(F.col("n"), percent)) | ~F.col("alone"))
    open_ = cuts.add(possible.select("class", "n", "r1", "r2", "again"))
    chosen = plain.join(_held(open_), ["r1", "r2"])
    repeated = chosen.where("again").dropDuplicates(["class"])
    chosen = chosen.where("not again").unionByName(repeated) if open_.where("again").limit(1).count() else chosen
    lists = cuts.add(token_lists(chosen))

    exploded = lists.select("class", F.explode("tokens").alias("token"))
    counts = exploded.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    shared = exploded.join(counts, "token").groupBy("class").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("found"))
    sets = lists.select("class", "n").join(shared, "class").select("class", "n", (F.col("n") - F.size("found")).alias("own"), F.transform("found", lambda x: x["token"]).alias("tokens"))
    sets = cuts.add(sets.withColumn("reach", (_prefix(F.col("n"), percent) - F.col("own")).cast("int")).where("reach > 0"))
    cuts.drop(open_, lists)

    # groups of equal shared prefix, size and own tokens
    prefixed = sets.select("class", "n", "own", F.slice("tokens", F.lit(1), F.col("reach")).alias("prefix"))
    groups = cuts.add(prefixed.groupBy("n", "own", "prefix").agg(F.min("class").alias("group")))
    members = cuts.add(prefixed.join(groups, ["n", "own", "prefix"]).select("class", "group", "n", "own"))
    keyed = cuts.add(groups.select("group", "n", "own", F.explode("prefix").alias("token")))
    counted = cuts.add(keyed.groupBy("token").agg(F.min(F.struct("own", "n", "group")).alias("pivot"), F.count(F.lit(1)).alias("groups")))
    # a group that shares no prefix token with another is a pivot to its own members, by one token that all of them have
    several = members.where("class <> group").select("group").distinct()
    alone = keyed.join(several, "group").join(counted, "token").groupBy("group").agg(F.max("groups").alias("groups"), F.min("token").alias("token")).where("groups = 1")
    pivots = cuts.add(counted.where("groups > 1").select("token", F.col("pivot.group").alias("pivot")).union(alone.select("token", F.col("group").alias("pivot"))))
    near = keyed.join(pivots, "token").where("group <> pivot").select("group", "pivot").distinct()
    pairs = members.join(near, "group").select(F.col("class").alias("a"), F.col("pivot").alias("b"))
    inside = members.where("class <> group").select(F.col("class").alias("a"), F.col("group").alias("b"))
    links = cuts.add(verified(pairs.union(inside).distinct(), sets, percent).where("linked").select("a", "b"))

    parts = connected_components(links)
    placed = cuts.add(members.join(parts, members["class"] == parts["node"], "left").select("class", "group", "n", "own", F.coalesce("component", "class").alias("component")))
    cuts.drop(parts)
    # all have met the pivot; lists whose other classes are of one component are done
    spread = keyed.select("group", "token").join(pivots, "token").join(placed, "group").where("class <> pivot").select("token", "pivot", "class", "n", "own", "component")
    spread = cuts.add(spread)
    divided = spread.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
    beside = cuts.add(spread.join(divided, "token").select(F.col("class").alias("a"), F.col("pivot").alias("b"), "component").distinct())
    apart = cuts.add(_differences(beside.select("a", "b"), sets, percent).join(beside, ["a", "b"]))
    nearest = apart.groupBy("b").agg(F.min(F.struct("excess", "a")).alias("nearest"))
    links = cuts.add(links.union(apart.join(nearest, "b").where("excess + nearest.excess <= 0 and a <> nearest.a").select("a", F.col("nearest.a").alias("b"))))

    # before pairs are looked for, the members of each list meet one of it, another in each round, as long as that joins
    # components; the differences are listed once, later rounds go on with the lists that still hold several components
    beyond = cuts.add(_difference_lists(apart, percent))
    cuts.drop(apart)
    for turn in range(ROUNDS + 1):
        order = F.xxhash64(F.lit(turn), "a") if turn else F.col("size").cast("long")
        torn = beyond.groupBy("b", "token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("nearer").alias("any"), F.min(F.struct(order, "a", "component", "n", "excess", "left")).alias("one"))
        lists = cuts.add(beyond.join(torn.where("lo <> hi and any").select("b", "token", "one"), ["b", "token"]))
        cuts.drop(beyond)
        beyond = lists.drop("one")
        if turn == ROUNDS:
            break
        possible = f"component <> one.component and {2 * (100 + percent)} * least(left, one.left) >= excess + one.excess and 100 * least(n, one.n) >= {percent} * greatest(n, one.n)"
        fresh = cuts.add(verified(lists.where(possible).select("a", F.col("one.a").alias("b")).distinct(), sets, percent).where("linked").select("a", "b"))
        if not fresh.limit(1).count():
            break
        of = lists.select("a", "component").distinct()
        joined = fresh.join(of, "a").select("b", F.col("component").alias("one")).join(of.withColumnRenamed("a", "b"), "b").select("one", F.col("component").alias("two"))
        parts = connected_components(joined, "one", "two")
        beyond = cuts.add(beyond.join(parts.select("node", F.col("component").alias("whole_")), beyond["component"] == F.col("node"), "left").withColumn("component", F.coalesce("whole_", "component")).drop("whole_", "node"))
        cuts.drop(parts, lists)
        links = cuts.add(links.union(fresh))
    far, near_ = ([F.col(c).alias(f"{c}_{x}") for c in ("a", "n", "size", "excess", "component", "left")] for x in "xy")
    met = beyond.select(F.col("b").alias("pivot"), "token", *far).join(beyond.where("nearer").select(F.col("b").alias("pivot"), "token", *near_), ["pivot", "token"])
    met = met.where("component_x <> component_y and (size_x > size_y or size_x = size_y and a_x < a_y)").where(f"100 * least(n_x, n_y) >= {percent} * greatest(n_x, n_y)")
    met = met.where(f"{2 * (100 + percent)} * least(left_x, left_y) >= excess_x + excess_y").select(F.col("a_x").alias("a"), F.col("a_y").alias("b")).distinct()
    return cuts.add(links.union(verified(met, sets, percent).where("linked").select("a", "b")))


def components_of(rows: DataFrame, plain: DataFrame, cuts: Cuts, percent: int, first_tokens: Callable, token_lists: Callable) -> DataFrame:
    """c1, c2, component (a key), component_id (least doc_id reachable by links), first_id and all_rows (of the component) of every class; rows as set_classes() gives them."""
    classes = cuts.add(named_classes(rows))
    links = class_links(plain, classes, cuts, percent, first_tokens, token_lists)
    parts = connected_components(links)
    named = classes.join(parts, classes["class"] == parts["node"], "left").select("c1", "c2", F.coalesce("component", "class").alias("component"), "first_id", "rows")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"), F.sum("rows").alias("all_rows"))
    named = cuts.add(named.join(least, "component").select("c1", "c2", "component", "component_id", "first_id", "all_rows"))
    cuts.keep_only(rows, named)
    cuts.drop(parts)
    return named


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links), r1 and r2 (of id and text) and component (a key) of every row."""
    bounded_batches(docs.sparkSession)
    cuts = Cuts()
    rows = cuts.add(set_classes(docs, width, id_col, text_col))
    r1, r2 = row_key(id_col, text_col)
    plain = docs.select(r1.alias("r1"), r2.alias("r2"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    named = components_of(rows, plain, cuts, percent, lambda texts, share, least: _first_tokens(texts, width, share, least), lambda chosen: _token_lists(chosen, width))
    full = F.col("n") > 0
    sized = rows.select("doc_id", F.col("n").alias("n_shingles"), "r1", "r2", F.when(full, F.col("c1")).alias("c1"), F.when(full, F.col("c2")).alias("c2"))
    return sized.join(named, ["c1", "c2"], "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "r1", "r2", "component")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component: that of the least doc_id (null ids last), once if its row repeats.

    Documents without words all stay.
    """
    found = Cuts().add(near_duplicates(docs, width, percent, id_col, text_col))
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("r1"), F.col("r2"))
    chosen = found.where("n_shingles > 0").groupBy("component").agg(F.min_by(F.struct("r1", "r2"), rank).alias("row")).select("row.*", F.lit(True).alias("once"))
    wordless = found.where("n_shingles = 0").select("r1", "r2", F.lit(False).alias("once")).distinct()
    kept = chosen.unionByName(wordless).join(found.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("rows")), ["r1", "r2"])
    kept = kept.select(F.col("r1").alias("_r1"), F.col("r2").alias("_r2"), (F.col("once") & (F.col("rows") > 1)).alias("_thin"))
    r1, r2 = row_key(id_col, text_col)
    joined = docs.withColumns({"_k1": r1, "_k2": r2}).join(kept, (F.col("_k1") == F.col("_r1")) & (F.col("_k2") == F.col("_r2")))
    repeated = joined.where("_thin").dropDuplicates(["_r1", "_r2"])
    return joined.where("not _thin").unionByName(repeated).select(*docs.columns)
