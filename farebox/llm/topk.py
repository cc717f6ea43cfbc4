"""Exact inner-product search with elimination by a table of distances to pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from farebox.llm.shared import Scratch, table

SCALE, EVERY, TOP = 1024, 100, 10
#: Pivots, and the rows of each vector length that they are chosen from.
PIVOTS, SAMPLE = 48, 1000
#: Candidates and queries that meet in one task.
CANDIDATES, QUERIES = 8192, 1024
#: Candidates that are evaluated between two looks at the bounds.
CHUNK = 64
#: Stands for a null id inside the operator, and sorts first.
NO_ID = -(1 << 63)
#: Whole numbers up to here are exact as 64-bit floats, and components up to there are taken.
EXACT, LARGEST = 1 << 53, 1 << 62

FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def choose_pivots(sample: np.ndarray, many: int) -> np.ndarray:
    """Vectors of the sample that lie far from each other: each the farthest from those before."""
    first = int(np.argmax(((sample - sample.mean(axis=0)) ** 2).sum(axis=1)))
    chosen, gap = [first], np.full(len(sample), np.inf)
    while len(chosen) < min(many, len(sample)):
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        if gap.max() == 0:
            break
        chosen.append(int(np.argmax(gap)))
    return sample[chosen]


def squares(vectors: np.ndarray) -> np.ndarray:
    return (vectors.astype(np.float64) ** 2).sum(axis=1)


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each vector from each pivot, summed from differences, which lose no digits to large norms."""
    out = np.empty((len(vectors), len(pivots)))
    vectors = vectors.astype(np.float64)
    for p, pivot in enumerate(pivots):
        out[:, p] = np.sqrt(((vectors - pivot) ** 2).sum(axis=1))
    return out


def bounds(queries: np.ndarray, q_table: np.ndarray, vectors: np.ndarray, v_table: np.ndarray) -> np.ndarray:
    """No inner product is above its bound: the distance is at least the largest gap to any pivot."""
    low = np.zeros((len(queries), len(vectors)))
    for p in range(q_table.shape[1]):
        np.maximum(low, np.abs(q_table[:, p, None] - v_table[None, :, p]), out=low)
    total = squares(queries)[:, None] + squares(vectors)
    # the distances are rounded: some slack keeps the bound above the exact product
    return (total - low**2) / 2 + 1e-9 * total + 1e-3


def products(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; an error if one has no 64-bit value."""
    far = int(np.abs(vectors).max(initial=0)) * int(np.abs(query).max(initial=0)) * len(query)
    if far < EXACT:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return np.array([sum(a * b for a, b in zip(v, query.tolist(), strict=True)) for v in vectors.tolist()], dtype=np.int64)


def search(query: np.ndarray, bound: np.ndarray, vectors: np.ndarray, ids: np.ndarray, top: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of the best ``top`` by score, then id; scores below ``least`` may be left out.

    Candidates are evaluated in order of their bounds. As soon as the next bound
    is below the ``top``-th score found (or ``least``), no other can enter.
    """
    live = np.flatnonzero(bound >= least)
    live = live[np.argsort(-bound[live], kind="stable")]
    where, scores, at, size = np.empty(0, np.int64), np.empty(0, np.int64), 0, CHUNK
    while at < len(live) and bound[live[at]] >= least:
        part = live[at : at + size]
        at, size = at + size, size * 2
        where = np.concatenate([where, part])
        scores = np.concatenate([scores, products(query, vectors[part])])
        best = np.lexsort((ids[where], -scores))[:top]
        where, scores = where[best], scores[best]
        if len(scores) == top:
            least = max(least, scores[-1])
    return where, scores


def as_integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, ints): floor(scale * x) of each component; rows with null or non-finite components go."""
    ok = F.coalesce(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    value = lambda x: x.cast("double") * scale
    safe = lambda x: F.when(F.abs(value(x)) <= float(LARGEST), F.floor(value(x))).otherwise(F.raise_error(F.lit("component too large")))
    return vectors.where(ok & (F.size("embedding") > 0)).select("vec_id", F.transform("embedding", lambda x: safe(x).cast("long")).alias("ints"))


def _tabled(pivots: dict[int, np.ndarray]):
    """Adds to each vector its distances to the pivots of its length, and its cell: the nearest of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, part in batch.groupby("width"):
                far = distances(np.stack(part["ints"].to_numpy()), pivots[width])
                yield part.assign(far=list(far), cell=far.argmin(axis=1))

    return run


def pivot_table(vectors: DataFrame, scratch: Scratch, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """vec_id, row, ints, width, far (distances to the pivots) and cell of each vector, written once.

    The pivots of a vector length are far from each other among ``sample`` rows of it: all
    that the driver sees of the vectors.
    """
    # the row number is written: a later retry of a task reads the same numbers
    rows = as_integers(vectors).withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumns({"vec_id": F.coalesce("vec_id", F.lit(NO_ID)), "width": F.size("ints")})
    rows = scratch.write(rows, "vectors")
    order = Window.partitionBy("width").orderBy(F.xxhash64("row", "ints"))
    few = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample).orderBy("width", "n").collect()
    by_width: dict[int, list] = {}
    for r in few:
        by_width.setdefault(r.width, []).append(r.ints)
    chosen = {width: choose_pivots(np.array(v, dtype=np.float64), pivots) for width, v in by_width.items()}
    kind = "vec_id long, ints array<long>, row long, width int, far array<double>, cell int"
    table = scratch.write(rows.mapInPandas(_tabled(chosen), kind), "table")
    scratch.drop("vectors")
    return table


class Cells:
    """How far the vectors of each cell are from each pivot, and how long they are at most."""

    def __init__(self, table: DataFrame, pivots: int):
        norm = F.aggregate("ints", F.lit(0.0), lambda n, x: n + x.cast("double") * x)
        low, high = ([f(F.get("far", F.lit(p))).alias(f"{name}{p}") for p in range(pivots)] for f, name in ((F.min, "low"), (F.max, "high")))
        rows = table.groupBy("width", "cell").agg(F.count("*").alias("n"), F.max(norm).alias("norm"), *low, *high).collect()
        self.of: dict[int, tuple] = {}
        for width in {r.width for r in rows}:
            some = sorted((r for r in rows if r.width == width), key=lambda r: r.cell)
            ends = [np.array([[r[f"{name}{p}"] for p in range(pivots)] for r in some], dtype=np.float64) for name in ("low", "high")]
            self.of[width] = np.array([r.cell for r in some]), np.array([r.n for r in some]), np.array([r.norm for r in some]), *ends

    def live(self, width: int, query: np.ndarray, far: np.ndarray, bar: float) -> np.ndarray:
        """Cells that may hold a vector whose product with the query reaches ``bar``."""
        cells, _, norm, low, high = self.of[width]
        p = len(far)
        gap = np.maximum(0, np.maximum(low[:, :p] - far, far - high[:, :p])).max(axis=1)
        total = (query.astype(np.float64) ** 2).sum() + norm
        return cells[(total - gap**2) / 2 + 1e-9 * total + 1e-3 >= bar]

    def sizes(self) -> list[tuple[int, int, int]]:
        return [(width, int(c), int(n)) for width, (cells, many, *_) in self.of.items() for c, n in zip(cells, many, strict=True)]


def _search_block(top: int):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = {name.split()[0]: [] for name in FOUND.split(", ")}
        if len(candidates) and len(queries):
            v, q = (np.stack(x["ints"].to_numpy()) for x in (candidates, queries))
            limit = bounds(q, np.stack(queries["far"].to_numpy()), v, np.stack(candidates["far"].to_numpy()))
            ids, rows = candidates["vec_id"].to_numpy(), candidates["row"].to_numpy()
            for i, (row, query_id, bar) in enumerate(zip(queries["row"], queries["vec_id"], queries["bar"], strict=True)):
                limit[i, rows == row] = -np.inf
                where, scores = search(q[i], limit[i], v, ids, top, max(bar, -1e300))
                for name, value in zip(columns, (np.full(len(where), row), np.full(len(where), query_id), ids[where], rows[where], scores), strict=True):
                    columns[name].append(value)
        return pd.DataFrame({k: np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for k, x in columns.items()})

    return run


def _meet(table: DataFrame, queries: DataFrame, sizes: DataFrame, top: int, scratch: Scratch, label: str) -> DataFrame:
    """The best ``top`` candidates of each query in each slice of the cells it names in ``cells``.

    Only cells that a query names are sent. A crowded cell is dealt out in slices of
    candidates, and its queries in parts; each slice meets each part in a task.
    """
    named = scratch.write(queries.withColumn("cell", F.explode("cells")).drop("cells"), f"{label}-named")
    asked = named.groupBy("width", "cell").agg(F.count("*").alias("q")).join(sizes, ["width", "cell"])
    grid = asked.select("width", "cell", F.ceil(F.col("n") / CANDIDATES).cast("int").alias("slices"), F.ceil(F.col("q") / QUERIES).cast("int").alias("parts"))
    grid = F.broadcast(scratch.write(grid, f"{label}-grid"))
    deal = lambda k: F.pmod(F.xxhash64("row"), F.col(k)).cast("int")
    whole = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    at = ["width", "cell", "slice", "part"]
    sent = table.join(grid, ["width", "cell"]).withColumn("slice", deal("slices")).withColumn("part", whole("parts"))
    asking = named.join(grid, ["width", "cell"]).withColumn("part", deal("parts")).withColumn("slice", whole("slices"))
    sent, asking = sent.select(*at, "row", "vec_id", "ints", "far"), asking.select(*at, "row", "vec_id", "ints", "far", "bar")
    return sent.groupBy(*at).cogroup(asking.groupBy(*at)).applyInPandas(_search_block(top), FOUND)


def top_products(vectors: DataFrame, every: int = EVERY, top: int = TOP, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id and score of the ``top`` largest integer inner products of each query.

    Queries are the rows whose vec_id ``every`` divides, candidates all rows but
    the query's own. Distances of all vectors to the pivots are computed once and stored with
    them. Vectors with the same nearest pivot are a cell. A query first meets the
    cell it lies in, which gives the score that others have to reach. By the ranges of
    a cell's distances to the pivots, cells that cannot reach it are left out before anything is
    sent. In the others the distances bound each product, and candidates are evaluated in
    order of their bounds until none can enter.

    Defined cases: null vectors and vectors with null or non-finite components, or
    none, take no part; vectors of different lengths are no candidates of each
    other; equal scores go to the smaller vec_id; repeated rows are candidates of each other,
    and each is a query; a row with null vec_id is a candidate that comes first among
    equals and never a query; vectors of any length are whole; a component beyond 2^62, or a score without a 64-bit value, is an
    error; extra columns are not read; no rows give no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    table = pivot_table(vectors, scratch, pivots, sample)
    cells = Cells(table, pivots)
    sizes = spark.createDataFrame(cells.sizes(), "width int, cell int, n long")
    queries = table.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != NO_ID))
    home = queries.withColumns({"cells": F.array("cell"), "bar": F.lit(float("-inf"))}).drop("cell")
    first = scratch.write(_meet(table, home, sizes, top, scratch, "home"), "home")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    last = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == top)
    bars = last.select(F.col("query_row").alias("row"), F.col("score").cast("double").alias("bar"))
    shipped = spark.sparkContext.broadcast(cells)

    @F.pandas_udf("array<int>")
    def others(widths: pd.Series, ints: pd.Series, far: pd.Series, bar: pd.Series, own: pd.Series) -> pd.Series:
        rows = zip(widths, ints, far, bar, own, strict=True)
        return pd.Series([[c for c in shipped.value.live(w, q, f, b).tolist() if c != o] for w, q, f, b, o in rows])

    barred = queries.join(bars, "row", "left").withColumn("bar", F.coalesce("bar", F.lit(float("-inf"))))
    away = barred.withColumn("cells", others("width", "ints", "far", "bar", "cell")).drop("cell")
    found = first.union(_meet(table, away, sizes, top, scratch, "away"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(generate_series(1, len(q.e)), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.r <> c.r AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0
), k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM k WHERE n <= 10
"""


def op6_exact_topk(spark, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))
