import numpy as np
import pyarrow.parquet as pq

from farebox.llm import topk


def brute_force(rows, every=100, top=10):
    ok = [(i, v, np.floor(1024 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for k, (q, _, a) in enumerate(ok):
        if q is None or q % every:
            continue
        scores = sorted((-int(a @ b), c is not None, c or 0) for j, (c, _, b) in enumerate(ok) if j != k and len(a) == len(b))[:top]
        out += [(q, n + 1, c if some else None, -s) for n, (s, some, c) in enumerate(scores)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect()), key=str)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 150)
    monkeypatch.setattr(topk, "QUERIES", 7)
    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas()
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(t.vec_id, t.embedding)]
    rows += [(10_000 + i, rows[200][1]) for i in range(300)]  # one very common vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(topk.top_products(df, pivots=12, sample=40)) == brute_force(rows)


def test_search_stops_early_and_stays_exact():
    rng = np.random.default_rng(3)
    centres = rng.integers(-900, 900, (20, 8))
    v = (centres[rng.integers(0, 20, 4000)] + rng.integers(-20, 20, (4000, 8))).astype(float)
    q, pivots = v[::400], topk.choose_pivots(v[:500], 16)
    limit = topk.bounds(q, topk.distances(q, pivots), v, topk.distances(v, pivots))
    exact = q @ v.T
    assert (limit >= exact).all()
    for i in range(len(q)):
        where, scores = topk.search(q[i], limit[i], v, np.arange(4000), 10, -np.inf)
        assert scores.tolist() == sorted(exact[i].astype(int), reverse=True)[:10]
        assert where.tolist() == np.lexsort((np.arange(4000), -exact[i]))[:10].tolist()


def test_clustered_vectors_leave_most_cells_out(spark):
    """On clusters, cells are left out before anything is sent, and the rest by their bounds."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (40, 16))
    v = centres[rng.integers(0, 40, 6000)] + rng.normal(0, 0.02, (6000, 16))
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(topk.top_products(df)) == brute_force(rows)
    scratch = topk.Scratch(spark, "test")
    table = topk.pivot_table(df, scratch)
    cells = topk.Cells(table, topk.PIVOTS)
    many = {c: n for _, c, n in cells.sizes()}
    ints = np.floor(1024 * v)
    some = table.where("vec_id % 100 = 0").collect()
    live = [sum(many[c] for c in cells.live(16, np.array(r.ints), np.array(r.far), np.sort(ints @ np.array(r.ints, float))[-11])) for r in some]
    assert sum(live) < 0.2 * len(live) * len(v)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.integers(-(2**18), 2**18, 6)]) for i in range(300)]
    rows += [(300, [2.0**20 + 0.5] * 6), (400, [2.0**19 + 1] * 6), (401, [-(2.0**20)] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ok = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    want = []
    for q, a in ok:
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in ok if c != q)[:10]
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores)]
    assert found(topk.top_products(df)) == sorted(want, key=str)


def test_nulls_repeats_widths_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (100, [-0.2, 0.3]), (1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 0.5]), (200, [0.1, 0.2, 0.3]), (6, [0.4, 0.4])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, row int, score int")
    assert found(topk.top_products(df)) == brute_force(rows)


def test_empty(spark):
    assert topk.top_products(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
