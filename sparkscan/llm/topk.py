"""Exact top-k by inner product: best-first search in M-trees of metric pages.

Inner product is made a metric by one more coordinate: with all vectors lifted to
the largest norm M, ``|q - x|^2 = |q|^2 + M^2 - 2 q.x`` for the unlifted query, so
the nearest vectors have the highest scores.

The root holds up to ``ROUTES`` routing vectors, chosen from a bounded sample; every
vector goes to its nearest one. Routes are cut into shards of about ``SHARD_ROWS``
(so a vector that very many rows share is spread), and each shard is a
subtree whose pages store a pivot, its covering radius and distance to the routing
vector, and each member's distance to the pivot. A query first searches the
shards of its own route, which gives it a bound; then those whose covering radius
does not exclude them. Within a subtree, pages are visited best first, and stored
distances exclude pages and members before any distance to them is computed.
Scores are integers and exact; bounds have a slack for rounding.

Queries meet shards in blocks of bounded size; nothing is collected but the sample,
the radii and the counts of the routes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .components import written

SCALE = 256
SAMPLE = 4_096
ROUTES = 64
SHARD_ROWS = 8_192
QUERY_ROWS = 8_192
PAGE_ROWS = 128
SLACK = 1e-6


def whole(vector: Column) -> Column:
    """floor(256 * x) of each component as a whole number; null if any component is null or not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~odd, F.transform(
        vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("bigint")))


def stacked(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.int64).reshape(len(vectors), -1)


def exact_products(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point where that is exact."""
    if len(rows) and float(np.abs(rows).max()) * float(np.abs(one).max()) * len(one) < 2**52:
        return (rows.astype(np.float64) @ one.astype(np.float64)).astype(np.int64)
    return rows @ one


def lift(rows: np.ndarray, most: float) -> np.ndarray:
    """With the coordinate that brings every row to the norm ``sqrt(most)``."""
    real = rows.astype(np.float64)
    return np.column_stack([real, np.sqrt(np.maximum(most - np.einsum("ij,ij->i", real, real), 0))])


def distances(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    gap = rows - one
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def spread_out(rows: np.ndarray, many: int) -> np.ndarray:
    """Up to ``many`` rows, each the farthest from those before it; equal rows are taken once."""
    chosen = [0]
    near = distances(rows, rows[0])
    while len(chosen) < many and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(rows, rows[chosen[-1]]))
    return rows[chosen]


def nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row, and its distance."""
    squares = np.einsum("ij,ij->i", pivots, pivots)
    best = np.concatenate([np.argmin(squares - 2 * (part @ pivots.T), axis=1) for part in np.array_split(rows, len(rows) // 4096 + 1)])
    gap = rows - pivots[best]
    return best, np.sqrt(np.einsum("ij,ij->i", gap, gap))


class Subtree:
    """The pages of a shard: members in page order, with pivots, radii and parent distances."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, most: float, route: np.ndarray) -> None:
        lifted = lift(rows, most)
        order = np.argsort(ids, kind="stable")
        pivots = spread_out(lifted[order[:SAMPLE]], max(1, len(ids) // PAGE_ROWS))
        page, _ = nearest(lifted, pivots)
        order = np.lexsort((ids, page))
        page, self.ids, self.rows, lifted = page[order], ids[order], rows[order], lifted[order]
        # a page over its size is cut: equal vectors make such pages
        first = np.searchsorted(page, page)
        cut = page * (1 << 32) + (np.arange(len(page)) - first) // PAGE_ROWS
        self.starts = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]])
        self.ends = np.r_[self.starts[1:], len(cut)]
        self.pivots = pivots[page[self.starts]]
        gap = lifted - pivots[page]
        self.to_pivot = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        self.radius = np.maximum.reduceat(self.to_pivot, self.starts)
        self.to_route = distances(self.pivots, route)

    def search(self, query: np.ndarray, own: int, k: int, most: float, to_route: float, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """The best ``k`` members within distance ``bound``: ids and scores."""
        point = np.append(query.astype(np.float64), 0.0)
        top = float(point @ point) + most
        slack = SLACK * np.sqrt(top) + SLACK
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = np.abs(to_route - self.to_route) - self.radius  # without any distance to a page
        live = np.flatnonzero(least <= bound + slack)
        away = distances(self.pivots[live], point)
        reach = np.maximum(away - self.radius[live], 0)
        for at in np.argsort(reach, kind="stable").tolist():
            if reach[at] > bound + slack:
                break
            a, b = self.starts[live[at]], self.ends[live[at]]
            some = a + np.flatnonzero(np.abs(away[at] - self.to_pivot[a:b]) <= bound + slack)
            some = some[self.ids[some] != own]
            if not len(some):
                continue
            ids = np.concatenate([ids, self.ids[some]])
            scores = np.concatenate([scores, exact_products(self.rows[some], query)])
            keep = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[keep], scores[keep]
            if len(ids) == k:
                bound = min(bound, float(np.sqrt(max(top - 2.0 * float(scores[-1]), 0))))
        return ids, scores


def top_k(df: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row that ``queries`` selects, its ``k`` best other rows: ``(query_id, rank, key, score)``.

    Scores are inner products of the vectors made whole by floor(256 * x); ties go
    to the smaller key. Rows with a null key, or a vector that is null, empty or
    holds null or non-finite components, take no part. All vectors have one length.
    The key names a vector; a repeated row counts again as a candidate, but never
    for its own key. An empty table gives an empty one.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("bigint").alias("id"), whole(F.col(vector)).alias("v"), queries.alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).withColumn("asks", F.coalesce("asks", F.lit(False)))
    square = F.aggregate("v", F.lit(0.0), lambda n, x: n + x.cast("double") * x.cast("double"))
    most = rows.agg(F.max(square)).first()[0]
    schema = f"query_id bigint, rank int, `{key}` bigint, score bigint"
    if most is None:
        return spark.createDataFrame([], schema)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()  # bounded
    routes = spread_out(lift(np.array([r[0] for r in sample], np.int64), most), ROUTES)

    @F.pandas_udf("route int, away double")
    def routed(v: pd.Series) -> pd.DataFrame:
        best, away = nearest(lift(stacked(v), most), routes)
        return pd.DataFrame({"route": best.astype(np.int32), "away": away})

    placed = rows.withColumn("__at", routed("v")).select("id", "v", "asks", "__at.route", "__at.away")
    placed, _ = written(placed, "vectors")
    routes_found = placed.groupBy("route").agg(
        F.count("*").alias("n"), F.sum(F.col("asks").cast("int")).alias("asks"), F.max("away").alias("radius")).collect()  # a row per route
    shards = {r["route"]: -(-r["n"] // SHARD_ROWS) for r in routes_found}
    blocks = -(-sum(r["asks"] for r in routes_found) // QUERY_ROWS)
    radius = {r["route"]: r["radius"] for r in routes_found}
    if not blocks:
        return spark.createDataFrame([], schema)
    live = np.array(sorted(radius))

    count_of = F.create_map(*[F.lit(x) for r, n in shards.items() for x in (r, n)])
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")
    members = placed.select(
        "id", "v", "route", F.pmod(F.xxhash64("id"), count_of[F.col("route")]).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def search(ask: DataFrame) -> DataFrame:
        """``ask``: (id, v, bound, route) for each route to be searched."""
        every = F.explode(F.sequence(F.lit(0), count_of[F.col("route")].cast("int") - 1))
        asked = ask.select(
            F.col("id").alias("ask_id"), F.col("v").alias("ask"), "bound", F.col("route").alias("ask_route"),
            every.alias("ask_shard"), block.alias("ask_block"))

        def run(_: tuple, have: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(have) and len(want):
                route = routes[int(have["route"].iloc[0])]
                tree = Subtree(have["id"].to_numpy(np.int64), stacked(have["v"]), most, route)
                points = stacked(want["ask"])
                to_route = distances(np.column_stack([points.astype(np.float64), np.zeros(len(points))]), route)
                for i, own, bound in zip(range(len(want)), want["ask_id"], want["bound"]):
                    ids, scores = tree.search(points[i], own, k, most, float(to_route[i]), bound)
                    out.append(pd.DataFrame({"query_id": own, "id": ids, "score": scores}))
            return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype="int64")

        asked = asked.groupBy("ask_route", "ask_shard", "ask_block")
        return members.groupBy("route", "shard", "block").cogroup(asked).applyInPandas(
            run, "query_id bigint, id bigint, score bigint")

    @F.pandas_udf("double")
    def bounded(v: pd.Series, worst: pd.Series) -> pd.Series:
        points = stacked(v).astype(np.float64)
        least = worst.astype("float64").to_numpy()  # NaN: fewer than k found yet
        top = np.einsum("ij,ij->i", points, points) + most
        return pd.Series(np.where(np.isnan(least), np.inf, np.sqrt(np.maximum(top - 2 * np.nan_to_num(least), 0))))

    @F.pandas_udf("array<int>")
    def others(v: pd.Series, home: pd.Series, bound: pd.Series) -> pd.Series:
        points = np.column_stack([stacked(v).astype(np.float64), np.zeros(len(v))])
        reach = np.array([radius[int(r)] for r in live])
        out = []
        for p, h, most_away in zip(points, home, bound):
            away = distances(routes[live], p)
            fits = away - reach <= most_away * (1 + SLACK) + SLACK * np.sqrt(most)
            out.append([int(r) for r in live[fits] if r != h])
        return pd.Series(out)

    asks = placed.where("asks").select("id", "v", "route").distinct()
    first, _ = written(search(asks.withColumn("bound", F.lit(float("inf")))), "first")
    best = F.row_number().over(_by_score())
    worst = first.withColumn("n", best).where(F.col("n") == k).select(F.col("query_id").alias("id"), "score")
    known = asks.join(worst, "id", "left").withColumn("bound", bounded("v", F.col("score").cast("double")))
    again = known.withColumn("route", F.explode(others("v", "route", "bound"))).select("id", "v", "bound", "route")
    found = first.union(search(again))
    return found.withColumn("rank", F.row_number().over(_by_score())).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")


def _by_score() -> WindowSpec:
    return Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
