"""Nearest neighbours by inner product: a robust-pruned directed graph per shard.

Equal vectors are one node that carries the smallest ids of its rows; more can never be among
the nearest, because ties go to the smaller id. So a vector that a third of the rows share is
one node, and nothing is lost. Nodes are dealt out over shards by hash.

A shard's graph is grown in batches. The points of a batch search the graph as it is, all at
once; what a search comes past is pruned to few edges: the nearest candidate stays, and every
candidate goes that is nearer to it, by a relaxed measure, than to the point itself. So edges
point in different directions, and some reach far. Edges back are added and pruned alike.

Inner products are no distance, so each vector gets one more component that brings all to the
same length; a query's is zero. The nearest then is the one of the largest inner product.

Queries are searched in every shard, in blocks: a task has one shard and one block of queries,
both of bounded size, and returns the best of that shard. Scores are inner products of the
vectors as given, in double precision. The work is the number of queries times the number of
shards, so shards should be as large as a task can hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import column, stored

NEAREST = 20
DEGREE = 32
BEAM = 96
# Candidates expanded together, and how many times nearer to each other (in squared distance)
# than to the point they must be to make room.
WIDTH = 4
RELAXED = 1.44
# Rows of a shard and queries of a block; so many shards at least.
SHARD_ROWS = 20_000
LEAST_SHARDS = 32
BLOCK_QUERIES = 16_384
# Points that search together, and candidate pairs that are compared together.
TOGETHER = 256
PAIRS = 1 << 21


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, targets: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """For each target the ``beam`` best points found, best first, and their products with it.

    ``edges`` has a row per point and one more; absent edges, and absent results, are the
    number of points.
    """
    n, rows = len(points), len(targets)
    seen = np.zeros((rows, n + 1), bool)
    ids, near = np.full((rows, beam), n), np.full((rows, beam), -np.inf, np.float32)
    expanded = np.ones((rows, beam), bool)
    ids[:, 0], near[:, 0], expanded[:, 0], seen[:, entry] = entry, targets @ points[entry], False, True
    while len(active := np.flatnonzero(~expanded.all(1))):
        waiting = ~expanded[active]
        picked = waiting & (np.cumsum(waiting, 1) <= WIDTH)
        expanded[active] |= picked
        first = np.argsort(~picked, 1, kind="stable")[:, :WIDTH]
        chosen = np.where(np.take_along_axis(picked, first, 1), np.take_along_axis(ids[active], first, 1), n)
        reached = np.sort(edges[chosen].reshape(len(active), -1), 1)
        fresh = (reached < n) & ~seen[active[:, None], reached]
        fresh[:, 1:] &= reached[:, 1:] != reached[:, :-1]
        row, at = np.nonzero(fresh)
        product = np.full(reached.shape, -np.inf, np.float32)
        product[row, at] = np.einsum("ij,ij->i", points[reached[row, at]], targets[active[row]])
        seen[active[row], reached[row, at]] = True
        merged = np.concatenate([near[active], product], 1)
        best = np.argsort(-merged, 1, kind="stable")[:, :beam]
        near[active] = np.take_along_axis(merged, best, 1)
        ids[active] = np.where(near[active] > -np.inf, np.take_along_axis(np.concatenate([ids[active], reached], 1), best, 1), n)
        done = np.concatenate([expanded[active], ~fresh], 1)
        expanded[active] = np.take_along_axis(done, best, 1)
    return ids, near


def robust_prune(points: np.ndarray, owners: np.ndarray, candidates: np.ndarray, degree: int, relaxed: float) -> np.ndarray:
    """At most ``degree`` of each owner's candidates, in different directions. Of a chosen
    one, all go whose squared distance to it, times ``relaxed``, is at most that to the owner."""
    n = len(points)
    padded = np.concatenate([points, np.zeros((1, points.shape[1]), np.float32)])
    kept = np.full((len(owners), degree), n)
    step = max(1, PAIRS // candidates.shape[1] ** 2)
    for i in range(0, len(owners), step):
        of, some = owners[i : i + step], candidates[i : i + step]
        vectors = padded[some]
        product = np.einsum("tcd,td->tc", vectors, points[of])
        product[(some == n) | (some == of[:, None])] = -np.inf
        order = np.argsort(-product, 1, kind="stable")
        some, product = np.take_along_axis(some, order, 1), np.take_along_axis(product, order, 1)
        vectors = np.take_along_axis(vectors, order[:, :, None], 1)
        between = vectors @ vectors.transpose(0, 2, 1)
        alive, row = product > -np.inf, np.arange(len(of))
        for r in range(degree):
            first = alive.argmax(1)
            has = alive[row, first]
            if not has.any():
                break
            kept[i : i + step, r] = np.where(has, some[row, first], n)
            # All vectors have length 1, so a squared distance is 2 - 2 * product.
            alive &= relaxed * (1 - between[row, first]) > 1 - product
            alive[row, first] = False
    return kept


def _add_back(points: np.ndarray, edges: np.ndarray, batch: np.ndarray, degree: int, relaxed: float) -> None:
    """Edges back to the points of a batch; where there are too many, they are pruned."""
    n = len(points)
    to, place = np.nonzero(edges[batch] < n)
    target, new = edges[batch[to], place], batch[to]
    order = np.argsort(target, kind="stable")
    target, new = target[order], new[order]
    starts = np.flatnonzero(np.diff(target, prepend=-1))
    counts = np.diff(starts, append=len(target))
    by_count = np.argsort(counts, kind="stable")  # like widths together
    for some in np.array_split(by_count, max(1, len(by_count) // TOGETHER)):
        if not len(some):
            continue
        owners, width = target[starts[some]], int(counts[some].max())
        at = starts[some][:, None] + np.arange(width)
        added = np.where(np.arange(width) < counts[some][:, None], new[np.minimum(at, len(new) - 1)], n)
        known = (added[:, :, None] == edges[owners][:, None, :]).any(2)
        both = np.sort(np.concatenate([edges[owners], np.where(known, n, added)], 1), 1)
        much = (both < n).sum(1) > degree
        edges[owners[~much]] = both[~much][:, :degree]
        if much.any():
            edges[owners[much]] = robust_prune(points, owners[much], both[much], degree, relaxed)


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relaxed: float = RELAXED) -> tuple[np.ndarray, int]:
    """The edges of points of length 1, absent ones being the number of points, and where
    searches begin. Points come in a fixed shuffled order, twice as many each time at first."""
    n = len(points)
    edges = np.full((n + 1, degree), n)
    entry = int((points @ points.mean(0)).argmax())
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    done = 1
    while done < n:
        batch = order[done : done + min(done, TOGETHER)]
        found, _ = beam_search(points, edges, entry, points[batch], beam)
        edges[batch] = robust_prune(points, batch, found, degree, relaxed)
        _add_back(points, edges, batch, degree, relaxed)
        done += len(batch)
    return edges, entry


def levelled(vectors: np.ndarray) -> np.ndarray:
    """Vectors divided by the largest length, with a component that brings each to length 1."""
    scaled = vectors / np.abs(vectors).max()
    scaled = scaled / np.sqrt((scaled**2).sum(1).max())
    rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(1)))
    return np.concatenate([scaled, rest[:, None]], 1).astype(np.float32)


def _by_dimension(vectors: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors in double precision, those of one number of components together."""
    whole = vectors.combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = whole.chunk(0) if whole.num_chunks else pa.array([], vectors.type)
    values, offsets = whole.values.to_numpy(zero_copy_only=False).astype(np.float64), whole.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(offsets)
    return [(rows, values[offsets[rows][:, None] + np.arange(d)]) for d in np.unique(sizes) for rows in [np.flatnonzero(sizes == d)]]


def _lists(values: np.ndarray, sizes: np.ndarray, of: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, of))


def usable(vector: Column) -> Column:
    """Neither null nor zero nor empty, all components numbers and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _keyed(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Usable rows as ``id``, ``v`` and two hashes of 64 bits that stand for the vector."""
    rows = df.select(column(id_column).cast("long").alias("id"), column(vector).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    return rows.select("id", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), F.col("v")).alias("k2"))


def build_index(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST, degree: int = DEGREE,
    beam: int = BEAM, relaxed: float = RELAXED, shard_rows: int = SHARD_ROWS, least_shards: int = LEAST_SHARDS,
) -> DataFrame:
    """The index as a stored table, one row per different vector: ``shard``, ``node`` (number
    in its shard, those with as many components together, where searches begin first), ``v``,
    ``edges`` (nodes), ``ids`` (the ``nearest`` + 1 smallest of its rows).

    Every usable row is in it (see ``nearest_neighbours``), at any size of the input.
    """
    by_id = F.dense_rank().over(Window.partitionBy("k1", "k2").orderBy("id"))
    rows = _keyed(df, id_column, vector).withColumn("place", by_id).where(F.col("place") <= nearest + 1)
    nodes = stored(rows.groupBy("k1", "k2").agg(F.first("v").alias("v"), F.sort_array(F.collect_set("id")).alias("ids")), "graph")
    shards = max(least_shards, -(-nodes.count() // shard_rows))
    item = nodes.schema["v"].dataType.simpleString()

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("k1", "ascending"), ("k2", "ascending")])
        taken, sizes, edges_of = [], [], []
        for rows, vectors in _by_dimension(table["v"]):
            points = levelled(vectors)
            edges, entry = build_graph(points, degree, beam, relaxed)
            # The entry becomes the first.
            order = np.concatenate([[entry], np.delete(np.arange(len(rows)), entry)])
            number = np.empty(len(rows) + 1, np.int64)
            number[order] = np.arange(len(rows))
            mine = edges[order]
            has = mine < len(rows)
            edges_of.append(number[mine[has]] + sum(map(len, taken)))
            sizes.append(has.sum(1))
            taken.append(rows[order])
        table = table.take(pa.array(np.concatenate(taken)))
        n = table.num_rows
        return pa.table({
            "shard": table["shard"], "node": pa.array(np.arange(n), pa.int32()), "v": table["v"],
            "edges": _lists(np.concatenate(edges_of), np.concatenate(sizes), pa.int32()), "ids": table["ids"],
        })

    dealt = nodes.withColumn("shard", F.pmod("k1", F.lit(shards)).cast("int"))
    grown = dealt.groupBy("shard").applyInArrow(grow, f"shard int, node int, v {item}, edges array<int>, ids array<bigint>")
    return stored(grown, "graph")


def _search_shard(nearest: int, beam: int, degree: int):
    """The best rows of one shard for one block of queries."""

    def search(key: tuple, index: pa.Table, queries: pa.Table) -> pa.Table:
        index = index.sort_by("node")
        found: list[tuple] = []
        ids = index["ids"].combine_chunks()
        ids = ids if isinstance(ids, pa.ListArray) else ids.chunk(0)
        id_values, id_offsets = ids.values.to_numpy(), ids.offsets.to_numpy().astype(np.int64)
        links = index["edges"].combine_chunks()
        links = links if isinstance(links, pa.ListArray) else links.chunk(0)
        link_values, link_offsets = links.values.to_numpy(), links.offsets.to_numpy().astype(np.int64)
        shard = {vectors.shape[1]: (rows, vectors) for rows, vectors in _by_dimension(index["v"])}
        for asked, targets in _by_dimension(queries["v"]):
            if targets.shape[1] not in shard:
                continue
            rows, vectors = shard[targets.shape[1]]
            n = len(rows)
            points = levelled(vectors)
            edges = np.full((n + 1, degree), n)
            sizes = np.diff(link_offsets)[rows]
            at = np.repeat(np.arange(n), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            edges[at] = link_values[np.repeat(link_offsets[rows], sizes) + at[1]] - rows[0]
            unit = targets / np.abs(targets).max(1, keepdims=True)
            unit = np.concatenate([unit, np.zeros((len(unit), 1))], 1).astype(np.float32)
            for i in range(0, len(targets), TOGETHER):
                best, _ = beam_search(points, edges, 0, unit[i : i + TOGETHER], max(beam, nearest + 1))
                row, place = np.nonzero(best < n)
                node = best[row, place]
                ours, theirs = vectors[node], targets[i : i + TOGETHER][row]
                score = (ours * theirs).sum(1)
                same = (ours == theirs).all(1)
                # All ids of the nodes found, then the best of each query.
                first, many = id_offsets[rows[node]], np.diff(id_offsets)[rows[node]]
                row, score, same = (np.repeat(x, many) for x in (row, score, same))
                vec = id_values[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)]
                order = np.lexsort((vec, -score, row))
                row = row[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                top = order[rank <= nearest]
                found.append((asked[i : i + TOGETHER][row[rank <= nearest]], vec[top], score[top], same[top]))
        asked, vec, score, same = map(np.concatenate, zip(*found)) if found else (np.zeros(0, np.int64),) * 4
        of = queries.take(pa.array(asked))
        return pa.table({
            "k1": of["k1"], "k2": of["k2"], "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.float64()),
            "same": pa.array(same.astype(bool)),
        })

    return search


def search_index(
    index: DataFrame, queries: DataFrame, nearest: int = NEAREST, beam: int = BEAM, degree: int = DEGREE, block_queries: int = BLOCK_QUERIES
) -> DataFrame:
    """For each row of ``queries`` (``id``, ``v``, ``k1``, ``k2``, stored) the ``nearest`` rows of
    an index: ``query_id``, ``rank``, ``vec_id``, ``score``. A row with the id and the vector of
    the query is the query itself and left out."""
    wanted = stored(queries.groupBy("k1", "k2").agg(F.first("v").alias("v")), "graph")
    blocks = max(1, -(-wanted.count() // block_queries))
    shards = index.agg(F.max("shard")).first()[0]
    every = F.sequence(F.lit(0), F.lit(shards if shards is not None else 0))
    dealt = wanted.select("k1", "k2", "v", F.pmod("k2", F.lit(blocks)).cast("int").alias("block"), F.explode(every).alias("shard"))
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = copies.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInArrow(
        _search_shard(nearest, beam, degree), "k1 bigint, k2 bigint, vec_id bigint, score double, same boolean"
    )
    place = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("place", place).where(F.col("place") <= nearest + 1)
    lists = stored(best.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "same"))).alias("found")), "graph")
    asked = queries.select(F.col("id").alias("query_id"), "k1", "k2").distinct()
    others = F.filter("found", lambda x: ~(x["same"] & (x["vec_id"] == F.col("query_id"))))
    listed = asked.join(lists, ["k1", "k2"]).select("query_id", F.posexplode(F.slice(others, 1, nearest)).alias("at", "x"))
    return listed.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def nearest_neighbours(
    df: DataFrame, every: int = 20, id_column: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST, **options
) -> DataFrame:
    """The ``nearest`` neighbours of every row whose id is divisible by ``every``, among all
    other rows: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``, the inner product.

    Ties go to the smaller id. Rows without an id, and vectors that are null, empty, zero or
    hold a null or something that is not finite, are neither asked for nor found. Vectors are
    compared with those of as many components. Rows of the same id and vector count once; rows
    that share the id only are asked for one by one, and find each other. With fewer
    candidates than ``nearest`` all are returned. An empty table gives no rows. Other columns
    are not looked at.
    """
    index = build_index(df, id_column, vector, nearest, **options)
    queries = stored(_keyed(df, id_column, vector).where(F.col("id") % every == 0), "graph")
    return search_index(index, queries, nearest, options.get("beam", BEAM), options.get("degree", DEGREE))
