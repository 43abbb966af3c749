import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neighbours as N

SF = "/root/testdata/sf0.1"


def brute(rows, every=20, nearest=20):
    """(id, vector) -> query id, rank, id, score; exact."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in sorted(good):
        if q % every:
            continue
        found = [(-float((np.array(v) * np.array(w)).sum()), i) for i, w in good if (i, w) != (q, v) and len(w) == len(v)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:nearest])]
    return sorted(out)


def result(df, **options):
    return sorted(tuple(r) for r in N.nearest_neighbours(df, **options).collect())


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12)


def frame(spark, rows):
    """Vectors are stored in single precision, and come back to ``rows`` that way."""
    rows[:] = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    return spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<float>, node string, shard int")


def recall(got, want):
    of = lambda rows: {(r[0], r[2]) for r in rows}
    return len(of(got) & of(want)) / len(of(want))


def test_recall_of_the_table(spark):
    """Over the whole table, against all inner products; with the usual shards and with few."""
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()])
    for shards in (32, 1):
        got = result(df, least_shards=shards)
        assert len(got) == len(want) and recall(got, want) >= 0.98
        assert [r[:2] for r in got] == [r[:2] for r in want]


def test_lengths_differ(spark):
    """The largest inner product, not the smallest angle: long vectors come first."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=8) * 10 ** rng.uniform(-2, 2)).astype(np.float32).tolist()) for i in range(600)]
    df = frame(spark, rows)
    assert recall(result(df, least_shards=2), brute(rows)) >= 0.9


def test_copies_ties_and_repeats(spark):
    rng = np.random.default_rng(2)
    hot = rng.integers(-3, 4, 5).astype(float).tolist()
    rows = [(i, hot) for i in range(200)] + [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(200, 300)]
    rows += [(0, hot), (40, rows[250][1]), (300, rows[250][1])]  # a repeated row, an id with another vector
    got, want = result(frame(spark, rows), least_shards=3), brute(rows)
    same(got, want)


def test_what_takes_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, -inf]), (None, [1.0, 1.0]),
            (20, [1.0, 2.0, 3.0]), (21, [3.0, 2.0, 1.0]), (40, [-1.0, -2.0]), (60, [5.0]), (80, [-0.0, 1e30]), (81, [1e-30, 0.0])]
    df = frame(spark, rows)
    same(result(df, least_shards=2), brute(rows))
    same(result(df, least_shards=1), brute(rows))
    assert result(frame(spark, rows).limit(0)) == []
    assert result(frame(spark, rows[1:7])) == []


def test_blocks_of_queries_change_nothing(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    df = frame(spark, rows).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    index = N.build_index(df, least_shards=2)
    queries = N.stored(N._keyed(df, "vec_id", "embedding").where("id % 3 = 0"), "graph")
    one, many = (sorted(tuple(r) for r in N.search_index(index, queries, block_queries=b).collect()) for b in (1000, 7))
    assert one == many and len(one) == 100 * 20
    assert index.count() == 300


@pytest.mark.parametrize("n", [1, 2, 3, 33, 500])
def test_graph_reaches_every_point(n):
    points = N.levelled(np.random.default_rng(n).normal(size=(n, 4)))
    edges, entry = N.build_graph(points)
    assert edges.shape == (n + 1, N.DEGREE) and (edges[n] == n).all()
    assert not (edges[:n] == np.arange(n)[:, None]).any()
    reached, todo = {entry}, [entry]
    while todo:
        for j in edges[todo.pop()]:
            if j < n and j not in reached:
                reached.add(int(j))
                todo.append(int(j))
    assert len(reached) == n
