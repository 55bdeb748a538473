"""Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node. The graph starts from the best neighbours within
blocks of two random divisions. Each round, every node brings together its neighbours and a
sample of the nodes that have it as a neighbour (joins on node ids); in each of
these small neighbourhoods all pairs with a fresh member are scored, and nodes
whose lists they would better get them as proposals, merged into their lists.
Rounds end when few lists change, or at ``rounds``.

A query starts at its own node and keeps a beam of the ``beam`` best nodes seen;
each step joins the lists of beam nodes not yet opened and scores what is new,
until every node of the beam has been opened. The best of the beam are scored again in double precision on the original
vectors, and nodes become rows once more (ties to the smaller id).

Work is laid out in blocks: a block of nodes (or queries) and the distinct
vectors its lists name are brought to one task, so that a vector crosses the
network once for each block that needs it. A block holds at most BLOCK lists of
at most 2 x ``degree`` ids.

The measure is the inner product. Null vectors, those without components, of
zeros only, or with null or non-finite components take no part, and null ids do
not either. Vectors of different lengths have no inner product: each length is a
search of its own. A node of very many equal vectors hands on only its ``k`` + 1
least ids, which is all an answer can hold. Rows that repeat an id are rows of
their own as candidates; as queries, those of equal vector ask once, others each
for themselves (``same`` tells them apart). Fewer candidates than k give all of
them. An empty table gives an empty table; other columns are left aside.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.shared import cut, drop_cut

BLOCK = 4096
LEAST_BLOCKS = 16  # tables of fewer nodes are still dealt to so many tasks
LARGEST = 1e15
PROPOSALS = 16  # for one node from one block and round


def _matrix(column, dtype=np.float32) -> np.ndarray:
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    n = len(flat)
    values = flat.flatten().to_numpy(zero_copy_only=False)
    if n and dtype == np.float32 and values.dtype == np.float64:
        values = np.clip(values, -LARGEST, LARGEST)  # products must stay finite; the last scoring is of the values as they are
    return values.reshape(n, -1).astype(dtype) if n else np.zeros((0, 1), dtype)


def _lists(arrays: list[np.ndarray], kind):
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate([np.zeros(0, kind.to_pandas_dtype()), *arrays])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector (of float, if it was; else of double) of the rows that take part."""
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("vector")).where("vec_id is not null and vector is not null and size(vector) > 0")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("vector", lambda x: x != 0))


def _top(sims: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest (ties to the smaller id), largest first."""
    if len(sims) > k:
        edge = np.partition(sims, len(sims) - k)[len(sims) - k]
        some = np.flatnonzero(sims >= edge)
    else:
        some = np.arange(len(sims))
    return some[np.lexsort((ids[some], -sims[some]))][:k]


def _in_blocks(nodes: DataFrame, count: int, degree: int, salt: int) -> DataFrame:
    """Lists (node, near, sims) from random blocks."""
    import pyarrow as pa

    blocks = max(1, math.ceil(count / (BLOCK // 2)))

    def run(table):
        ids, x = table.column("node").to_numpy(), _matrix(table.column("vector"))
        near, sims = [], []
        for at in range(0, len(ids), 512):
            s = x[at : at + 512] @ x.T
            for i, row in enumerate(s):
                row[at + i] = -np.inf
                best = _top(row, ids, min(degree, len(ids) - 1)) if len(ids) > 1 else np.zeros(0, np.int64)
                near.append(ids[best])
                sims.append(row[best])
        return pa.table({"node": pa.array(ids), "near": _lists(near, pa.int64()), "sims": _lists(sims, pa.float32())})

    dealt = nodes.select("node", "vector", F.pmod(F.xxhash64(F.lit("start"), F.lit(salt), "node"), F.lit(blocks)).alias("block"))
    return dealt.groupBy("block").applyInArrow(run, "node long, near array<long>, sims array<float>")


def _start(nodes: DataFrame, count: int, degree: int) -> DataFrame:
    """Lists from two random divisions into blocks, so that they lead from any block to others."""
    both = _in_blocks(nodes, count, degree, 1).unionByName(_in_blocks(nodes, count, degree, 2))
    gathered = both.groupBy("node").agg(F.flatten(F.collect_list("near")).alias("ids"), F.flatten(F.collect_list("sims")).alias("scores"))
    return _merged(gathered.select("node", F.array().cast("array<long>").alias("near"), F.array().cast("array<float>").alias("sims"), "ids", "scores"), degree)


def _around(graph: DataFrame, degree: int, salt: int) -> DataFrame:
    """node and around: its list and up to ``degree`` nodes that list it (structs of id and fresh)."""
    pairs = graph.select("node", F.explode(F.arrays_zip("near", "fresh")).alias("e")).select("node", F.col("e.near").alias("near"), F.col("e.fresh").alias("fresh"))
    picked = Window.partitionBy("near").orderBy(F.desc("fresh"), F.xxhash64(F.lit(salt), "node", "near"), "node")
    back = pairs.withColumn("rank", F.row_number().over(picked)).where(F.col("rank") <= degree).select(F.col("near").alias("node"), F.col("node").alias("near"), "fresh")
    return pairs.unionByName(back).groupBy("node", "near").agg(F.max("fresh").alias("fresh")).groupBy("node").agg(F.collect_list(F.struct(F.col("near").alias("id"), "fresh")).alias("around"))


def _with_vectors(requests: DataFrame, nodes: DataFrame, extra: list[str]) -> DataFrame:
    """of_block, id, vector (and more) for each distinct (block, id)."""
    return requests.distinct().join(nodes.withColumnRenamed("node", "id"), "id").select(F.col("block").alias("of_block"), "id", "vector", *extra)


def _merged(together: DataFrame, degree: int) -> DataFrame:
    """Lists (node, near, sims, fresh) of the best ids of (node, near, sims, ids, scores); what comes from ids alone is fresh."""
    import pyarrow as pa

    def merge(batches):
        for batch in batches:
            near, sims, fresh = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("near", "sims", "ids", "scores")]
            for old, old_sims, new, new_sims in zip(*columns, strict=True):
                seen = np.array(old or [], np.int64)
                ids = np.concatenate([seen, np.array(new or [], np.int64)])
                s = np.concatenate([np.array(old_sims or [], np.float32), np.array(new_sims or [], np.float32)])
                ids, where = np.unique(ids, return_index=True)
                s, was = s[where], where < len(seen)
                best = _top(s, ids, degree)
                near.append(ids[best])
                sims.append(s[best])
                fresh.append(~was[best])
            yield pa.RecordBatch.from_arrays([batch.column("node"), _lists(near, pa.int64()), _lists(sims, pa.float32()), _lists(fresh, pa.bool_())], ["node", "near", "sims", "fresh"])

    return together.mapInArrow(merge, "node long, near array<long>, sims array<float>, fresh array<boolean>")


def _round(graph: DataFrame, nodes: DataFrame, count: int, degree: int, salt: int) -> DataFrame:
    """The graph after one round of neighbours meeting neighbours."""
    import pyarrow as pa

    blocks = max(LEAST_BLOCKS, math.ceil(count / BLOCK))
    lists = cut(_around(graph, degree, salt).withColumn("block", F.pmod(F.xxhash64(F.lit(salt), "node"), F.lit(blocks))))
    bar = graph.select("node", F.when(F.size("sims") >= degree, F.element_at("sims", -1)).otherwise(F.lit(float("-inf"))).alias("bar"))
    known = nodes.join(bar, "node")
    wanted = _with_vectors(lists.select("block", F.explode("around.id").alias("id")), known, ["bar"])

    def propose(left, right):
        ids = right.column("id").to_numpy()
        order = np.argsort(ids)
        ids, x, bars = ids[order], _matrix(right.column("vector"))[order], right.column("bar").to_numpy()[order]
        around = left.column("around").combine_chunks()
        offsets = around.offsets.to_numpy()
        flat = around.values
        at, fresh = np.searchsorted(ids, flat.field("id").to_numpy()), flat.field("fresh").to_numpy(zero_copy_only=False)
        kept_key, kept_sim = np.zeros(0, np.int64), np.zeros(0, np.float32)
        keys, sims, held = [], [], 0
        size = len(ids)

        def best():
            key, sim = np.concatenate([kept_key, *keys]), np.concatenate([kept_sim, *sims])
            key, where = np.unique(key, return_index=True)
            sim = sim[where]
            order = np.lexsort((key, -sim, key // size))
            key, sim = key[order], sim[order]
            owner = key // size
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
            rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
            keep = rank < PROPOSALS
            return key[keep], sim[keep]

        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            some, new = at[lo:hi], fresh[lo:hi]
            if hi - lo < 2 or not new.any():
                continue
            s = x[some] @ x[some].T
            ok = (s > bars[some][:, None]) & (new[:, None] | new[None, :])
            np.fill_diagonal(ok, False)
            i, j = np.nonzero(ok)
            keys.append(some[i].astype(np.int64) * size + some[j])
            sims.append(s[i, j])
            held += len(i)
            if held > 2_000_000:
                kept_key, kept_sim = best()
                keys, sims, held = [], [], 0
        key, sim = best()
        owner = key // size
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(owner))
        return pa.table({"node": pa.array(ids[owner[first]], pa.int64()), "ids": _lists([ids[key[a:b] % size] for a, b in zip(first, ends, strict=True)], pa.int64()), "scores": _lists([sim[a:b] for a, b in zip(first, ends, strict=True)], pa.float32())})

    proposed = lists.select("block", "node", "around").groupBy("block").cogroup(wanted.groupBy("of_block")).applyInArrow(propose, "node long, ids array<long>, scores array<float>")
    gathered = proposed.groupBy("node").agg(F.flatten(F.collect_list("ids")).alias("ids"), F.flatten(F.collect_list("scores")).alias("scores"))
    together = graph.select("node", "near", "sims").join(gathered, "node", "left")

    merged = cut(_merged(together, degree))
    drop_cut(lists)
    return merged


def neighbour_graph(nodes: DataFrame, degree: int = 48, rounds: int = 6, still: float = 0.002) -> DataFrame:
    """node, near (ids, best first), sims and fresh of every node (node, vector)."""
    count = nodes.count()
    graph = cut(_start(nodes, count, degree))
    for salt in range(rounds):
        better = _round(graph, nodes, count, degree, salt + 1)
        drop_cut(graph)
        graph = better
        changed = graph.agg(F.coalesce(F.sum(F.size(F.filter("fresh", lambda x: x))), F.lit(0))).first()[0]
        if changed <= still * count * degree:
            break
    return graph


def search_graph(queries: DataFrame, graph: DataFrame, nodes: DataFrame, beam: int = 96, degree: int = 48) -> DataFrame:
    """query, found (node ids) and scores (double, best first) for queries (query, vector) that are nodes themselves."""
    import pyarrow as pa

    lists = cut(_around(graph, degree, 0).select(F.col("node").alias("opened"), F.col("around.id").alias("near")))
    blocks = max(LEAST_BLOCKS // 4, math.ceil(queries.count() / (BLOCK // 4)))
    state = queries.select("query", "vector", F.array().cast("array<long>").alias("found"), F.array().cast("array<double>").alias("scores"), F.array("query").alias("opening"), F.array().cast("array<long>").alias("opened"))
    kind = f"query long, vector {queries.schema['vector'].dataType.simpleString()}, found array<long>, scores array<double>, opening array<long>, opened array<long>"
    done, steps = [], []
    while True:
        front = state.select("query", F.explode("opening").alias("opened")).join(lists, "opened").groupBy("query").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("candidates"))
        front = cut(state.join(front, "query", "left").withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks))))
        wanted = _with_vectors(front.select("block", F.explode("candidates").alias("id")), nodes, [])

        def step(left, right):
            ids = right.column("id").to_numpy()
            order = np.argsort(ids)
            ids, x = ids[order], _matrix(right.column("vector"), np.float64)[order]
            q = _matrix(left.column("vector"), np.float64)
            rows = left.select(["query", "found", "scores", "opening", "opened", "candidates"]).to_pydict()
            out = {c: [] for c in ("found", "scores", "opening", "opened")}
            for i, own in enumerate(rows["query"]):
                seen = np.array(rows["found"][i], np.int64)
                fresh = np.setdiff1d(np.array(rows["candidates"][i] or [], np.int64), np.append(seen, own))
                new = x[np.searchsorted(ids, fresh)] * q[i] if len(fresh) else np.zeros((0, q.shape[1]))
                all_ids, all_scores = np.concatenate([seen, fresh]), np.concatenate([np.array(rows["scores"][i], np.float64), new.sum(1)])
                best = _top(all_scores, all_ids, beam)
                opened = np.concatenate([np.array(rows["opened"][i], np.int64), np.array(rows["opening"][i], np.int64)])
                out["found"].append(all_ids[best])
                out["scores"].append(all_scores[best])
                out["opening"].append(np.setdiff1d(all_ids[best], opened))
                out["opened"].append(opened)
            kinds = {"scores": pa.float64()}
            return pa.table({"query": left.column("query"), "vector": left.column("vector"), **{c: _lists(v, kinds.get(c, pa.int64())) for c, v in out.items()}})

        after = cut(front.groupBy("block").cogroup(wanted.groupBy("of_block")).applyInArrow(step, kind))
        drop_cut(front)
        steps.append(after)
        done.append(after.where(F.size("opening") == 0).select("query", "found", "scores"))
        state = after.where(F.size("opening") > 0)
        if not state.limit(1).count():
            found = cut(reduce(DataFrame.unionByName, done))
            for table in [*steps, lists]:
                drop_cut(table)
            return found


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, degree: int = 48, rounds: int = 10, beam: int = 96, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score, same: the k nearest other rows found for each row whose id is divisible by ``every``."""
    rows = usable(vectors, id_col, vector_col)
    sizes = [r[0] for r in rows.select(F.size("vector").alias("size")).distinct().orderBy("size").collect()]
    found = [_nearest(rows.where(F.size("vector") == size), every, k, degree, rounds, beam) for size in sizes or [0]]
    return reduce(DataFrame.unionByName, found)


def _nearest(rows: DataFrame, every: int, k: int, degree: int, rounds: int, beam: int) -> DataFrame:
    """nearest() for rows (vec_id, vector) of one length."""
    rows = rows.withColumn("same", F.xxhash64("vector"))
    nodes = cut(rows.groupBy("same").agg(F.min_by("vector", "vec_id").alias("vector")).withColumnRenamed("same", "node"))
    least = Window.partitionBy("same").orderBy("vec_id")
    members = cut(rows.select("same", "vec_id").withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= k + 1))
    asked = cut(rows.where(F.col("vec_id") % every == 0).select("vec_id", "same").distinct().withColumnRenamed("same", "node").join(nodes, "node").select(F.col("vec_id").alias("query_id"), "node", "vector"))
    graph = neighbour_graph(nodes, degree, rounds)
    queries = asked.groupBy(F.col("node").alias("query")).agg(F.first("vector").alias("vector"))
    found = search_graph(queries, graph, nodes, beam, degree)
    drop_cut(graph)
    # the query's own node: its other members stand at the query's product with itself
    itself = queries.select("query", F.col("query").alias("near"), F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")).alias("score"))
    others = found.select("query", F.explode(F.slice(F.arrays_zip("found", "scores"), 1, k)).alias("e")).select("query", F.col("e.found").alias("near"), F.col("e.scores").alias("score"))
    # of the query's own node one row with its id is the query itself
    own = members.withColumnRenamed("same", "near").withColumn("twin", F.row_number().over(Window.partitionBy("near", "vec_id").orderBy("rank"))).drop("rank")
    scored = asked.select("query_id", F.col("node").alias("query")).join(others.union(itself), "query").join(own, "near").where("vec_id <> query_id or near <> query or twin > 1")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id", "twin")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", F.col("query").alias("same"))
