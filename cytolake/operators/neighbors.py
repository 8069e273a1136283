"""Exact nearest neighbours, neighbour graphs, and what is read off them."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytolake.functions.numeric import norm2
from cytolake.operators.ordering import placed
from cytolake.sources.shared import written


def _nearest_of_places(base: DataFrame, k: int, q: DataFrame, alone: bool) -> DataFrame:
    """knn_2d where several points share a place: a place is asked once, and gives its k + 1 least ids at most."""
    few = base.withColumn("nth", F.row_number().over(W.partitionBy("x", "y").orderBy("id"))).where(F.col("nth") <= k + 1).select("id", "x", "y")
    few = written(few, "knn-places")
    spots = q.groupBy("x", "y").agg(F.min("id").alias("spot"))
    near = _knn_2d(few, k + 1, spots.select(F.col("spot").alias("id"), "x", "y"), False)
    each = q.select("id", "x", "y").join(spots, ["x", "y"]).join(near.select(F.col("id").alias("spot"), "nbr", "dist"), "spot")
    each = each.where("id <> nbr") if alone else each
    return each.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("dist", "nbr"))).where(F.col("rank") <= k).select("id", "nbr", "dist", "rank")


def knn_2d(base: DataFrame, k: int, queries: DataFrame | None = None) -> DataFrame:
    """id, nbr, dist, rank of the k nearest base points (id, x, y) of each query point; of equally near ones the least
    id. Without queries, of each base point among the others.

    Points meet by a join on grid cells: a query sees the 3 x 3 cells around it. It is done once its k-th distance is
    within the seen block; the others go on to cells of twice the width, until a cell spans all points. The first width
    is such that no cell holds more than about CROWD times k points, so a dense spot is not one hot cell, and points at
    one place count k + 1 times at most. Each round is written, so it is computed once."""
    alone, q, box = queries is None, base if queries is None else queries, _box(base)
    return _nearest_of_places(base, k, q, alone) if box.n and box.most > 1 else _knn_2d(base, k, q, alone, box)


def _box(points: DataFrame):
    """Number and bounds of the points, and how many share a place at most."""
    spots = points.groupBy("x", "y").agg(F.count("*").alias("c"))
    return spots.agg(F.sum("c").alias("n"), F.max("c").alias("most"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()


#: Points that the fullest cell of the first round may hold, for each neighbour sought.
CROWD = 32


def _knn_2d(base: DataFrame, k: int, q: DataFrame, alone: bool, box=None) -> DataFrame:
    box = box or _box(base)
    if not box.n:
        return q.select("id", F.col("id").alias("nbr"), F.lit(0.0).alias("dist"), F.lit(0).alias("rank")).where("false")
    if not alone:
        b2 = q.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
        x0, x1, y0, y1 = min(box.x0, b2.x0), max(box.x1, b2.x1), min(box.y0, b2.y0), max(box.y1, b2.y1)
    else:
        x0, x1, y0, y1 = box.x0, box.x1, box.y0, box.y1
    span = max(x1 - x0, y1 - y0) or 1.0
    h = span * min(1.0, math.sqrt(2.0 * (k + 1) / box.n))
    while h > span * 1e-12:
        top = base.groupBy(F.floor((F.col("x") - x0) / h), F.floor((F.col("y") - y0) / h)).count().agg(F.max("count")).first()[0]
        if top <= CROWD * (k + 1):
            break
        h /= 2 ** max(1, math.ceil(math.log2(top / (CROWD * (k + 1))) / 2))
    parts = []
    left = q.select("id", "x", "y")
    while True:
        last = h >= span
        cell = lambda c, o: F.floor((F.col(c) - o) / h).cast("long")  # noqa: E731, B023
        grid = base.select(F.col("id").alias("nbr"), F.col("x").alias("bx"), F.col("y").alias("by"), cell("x", x0).alias("cx"), cell("y", y0).alias("cy"))
        near = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        asked = left.select("id", "x", "y", cell("x", x0).alias("qx"), cell("y", y0).alias("qy"), near.alias("o")).select("*", (F.col("qx") + F.col("o.i")).alias("cx"), (F.col("qy") + F.col("o.j")).alias("cy"))
        pairs = asked.join(grid, ["cx", "cy"])
        if alone:
            pairs = pairs.where("id <> nbr")
        dx, dy = F.col("bx") - F.col("x"), F.col("by") - F.col("y")
        pairs = pairs.withColumn("d2", dx * dx + dy * dy)
        edge = F.least(F.col("x") - x0 - F.col("qx") * h, (F.col("qx") + 1) * h - (F.col("x") - x0), F.col("y") - y0 - F.col("qy") * h, (F.col("qy") + 1) * h - (F.col("y") - y0)) + h
        best = pairs.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("d2", "nbr"))).where(F.col("rank") <= k)
        w = W.partitionBy("id")
        ok = F.lit(True) if last else (F.count("*").over(w) == k) & (F.max("d2").over(w) <= F.min(edge * edge).over(w))
        best = written(best.select("id", "nbr", F.sqrt("d2").alias("dist"), "rank", ok.alias("ok")), "knn")
        parts.append(best.where("ok").drop("ok"))
        if last:
            break
        left = left.join(parts[-1].where("rank = 1").select("id"), "id", "left_anti")
        if left.limit(1).count() == 0:
            break
        left = written(left, "knn-left")
        h *= 2
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _least(d: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k least values of each row, in order, of equal ones the first: a stable sort's, without sorting what is beyond."""
    if k >= d.shape[1]:
        return np.argsort(d, axis=1, kind="stable")
    near = np.sort(np.argpartition(d, k - 1, axis=1)[:, :k], axis=1)
    v = np.take_along_axis(d, near, axis=1)
    near = np.take_along_axis(near, np.argsort(v, axis=1, kind="stable"), axis=1)
    tied = np.flatnonzero((d <= v.max(axis=1, keepdims=True)).sum(axis=1) > k)  # a cut through equal values
    near[tied] = np.argsort(d[tied], axis=1, kind="stable")[:, :k]
    return near


def _block_search(k: int, alone: bool):
    def run(q: pa.Table, b: pa.Table) -> pa.Table:
        kinds = pa.schema([("id", pa.int64()), ("nbr", pa.int64()), ("d2", pa.float64())])
        if not q.num_rows or not b.num_rows:
            return kinds.empty_table()
        qi, bi = q["id"].to_numpy(), b["id"].to_numpy()
        x, y = (np.stack([np.asarray(v, float) for v in t["vec"].to_pylist()]) for t in (q, b))
        order = np.argsort(bi, kind="stable")
        bi, y = bi[order], y[order]
        out = []
        for s in range(0, len(qi), 512):
            d = ((x[s : s + 512] ** 2).sum(1)[:, None] + (y**2).sum(1)[None] - 2 * x[s : s + 512] @ y.T).clip(0)
            if alone:
                d[qi[s : s + 512][:, None] == bi[None]] = np.inf
            near = _least(d, k)
            rows = np.arange(len(d))[:, None]
            exact = ((x[s : s + 512][:, None] - y[near]) ** 2).sum(2)
            fine = np.isfinite(d[rows, near])
            out.append((np.broadcast_to(qi[s : s + 512][:, None], near.shape)[fine], bi[near][fine], exact[fine]))
        return pa.table([np.concatenate([o[i] for o in out]) for i in range(3)], schema=kinds)

    return run


def knn_blocks(vectors: DataFrame, k: int, queries: DataFrame | None = None, block_rows: int = 4096) -> DataFrame:
    """id, nbr, dist, rank of the k nearest rows (id, vec) of each query, in any number of dimensions, exactly. Rows are
    dealt into blocks of about block_rows; each pair of blocks is one task, which keeps k rows a query."""
    alone = queries is None
    q = vectors if alone else queries
    nb, nq = max(1, -(-vectors.count() // block_rows)), max(1, -(-q.count() // block_rows))
    deal = lambda df, n: df.select("id", "vec", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("own"))
    left = deal(q, nq).select("id", "vec", F.col("own").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("j"))
    right = deal(vectors, nb).select("id", "vec", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("i"), F.col("own").alias("j"))
    pair = (F.col("i") * nb + F.col("j") + (F.rand(0) * 0)).cast("int")  # rand: with one block each the key would be a constant, and the exchange go
    left, right = (x.select("id", "vec", pair.alias("pair")) for x in (left, right))
    got = left.groupBy("pair").cogroup(right.groupBy("pair")).applyInArrow(_block_search(k, alone), "id long, nbr long, d2 double")
    return got.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("d2", "nbr"))).where(F.col("rank") <= k).select("id", "nbr", F.sqrt("d2").alias("dist"), "rank")


#: Centres of knn_cells at most, hence rows of what it broadcasts, and rows of a cell in one lot.
CENTRES, LOT = 16_384, 4096


def knn_cells(vectors: DataFrame, k: int, queries: DataFrame | None = None, cells: int | None = None, probes: int = 12, seed: int = 0) -> DataFrame:
    """id, nbr, dist, rank as knn_blocks, but a query looks only into the cells of its probes nearest centres: k-means on a
    sample of at most 64 rows a cell, about sqrt(n) cells. A row is sent once and a query probes times, whatever the number of
    rows; a cell of over LOT rows is cut into lots. Near neighbours beyond the probed cells are missed; the tests hold recall
    to 0.9 and more against the exact plan. With probes = cells the result is exact."""
    alone = queries is None
    q = vectors if alone else queries
    n = vectors.count()
    cells = min(cells or max(1, math.isqrt(n)), CENTRES, max(1, n))
    share = min(1.0, 64 * cells / max(n, 1))
    sample = vectors if share >= 1 else vectors.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    model = KMeans(k=cells, seed=seed, maxIter=8).fit(sample.select(array_to_vector("vec").alias("features"))) if n else None
    centres = np.stack(model.clusterCenters()) if model else np.zeros((1, 1))
    sent = vectors.sparkSession.sparkContext.broadcast(centres)

    def assign(width: int):
        def run(batches):
            c = sent.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.stack([np.asarray(v, float) for v in batch["vec"].to_pylist()])
                d = (c**2).sum(1)[None] - 2 * x @ c.T
                m = min(width, len(c))
                near = np.argpartition(d, m - 1, axis=1)[:, :m] if m < len(c) else np.broadcast_to(np.arange(m), (len(x), m))
                cell = pa.array(near.reshape(-1).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch["id"], batch["vec"], pa.ListArray.from_arrays(pa.array(np.arange(0, m * len(x) + 1, m), pa.int32()), cell)], names=["id", "vec", "cells"])

        return run

    kind = "id long, vec array<double>, cells array<int>"
    own = vectors.select("id", "vec").mapInArrow(assign(1), kind).select("id", "vec", F.explode("cells").alias("cell"))
    asked = q.select("id", "vec").mapInArrow(assign(probes), kind).select("id", "vec", F.explode("cells").alias("cell"))
    lots = lambda df, name: df.groupBy("cell").agg(F.ceil(F.count("*") / LOT).cast("int").alias(name))
    size = written(lots(own, "rows").join(lots(asked, "asks"), "cell"), "knn-cells")  # a row a cell
    lot = lambda name: F.pmod(F.xxhash64("id"), F.col(name)).cast("int")
    each = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    cell = (F.col("cell") + (F.rand(0) * 0)).cast("int").alias("cell")  # see knn_blocks
    left = asked.join(F.broadcast(size), "cell").select("id", "vec", cell, each("rows").alias("i"), lot("asks").alias("j"))
    right = own.join(F.broadcast(size), "cell").select("id", "vec", cell, lot("rows").alias("i"), each("asks").alias("j"))
    got = left.groupBy("cell", "i", "j").cogroup(right.groupBy("cell", "i", "j")).applyInArrow(_block_search(k, alone), "id long, nbr long, d2 double")
    return got.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("d2", "nbr"))).where(F.col("rank") <= k).select("id", "nbr", F.sqrt("d2").alias("dist"), "rank")


def knn_by_batch(vectors: DataFrame, batch: str, k: int) -> DataFrame:
    """The k nearest rows in each batch (itself aside) of each row: id, nbr, dist, rank, batch."""
    names = sorted(r[0] for r in vectors.select(batch).distinct().collect())
    parts = []
    for name in names:
        own = vectors.where(F.col(batch) == name).select("id", "vec")
        near = knn_blocks(own, k + 1, vectors.select("id", "vec")).where("id <> nbr")
        rank = F.row_number().over(W.partitionBy("id").orderBy("dist", "nbr"))
        parts.append(near.withColumn("rank", rank).where(F.col("rank") <= k).withColumn("batch", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _bandwidths(batches):
    for pdf in batches:
        rows = []
        for i, d in zip(pdf["id"], pdf["d"], strict=True):
            d = np.sort(np.asarray(d, float))
            rho, target = d[0], math.log2(len(d) + 1)
            lo, hi, sigma = 0.0, math.inf, 1.0
            for _ in range(64):
                s = np.exp(-np.maximum(0, d - rho) / sigma).sum()
                if abs(s - target) < 1e-9:
                    break
                if s > target:
                    hi, sigma = sigma, (lo + sigma) / 2
                else:
                    lo, sigma = sigma, sigma * 2 if hi == math.inf else (sigma + hi) / 2
            rows.append((i, rho, sigma))
        yield pd.DataFrame(rows, columns=["id", "rho", "sigma"])


def connectivities(knn: DataFrame) -> DataFrame:
    """src, dst, weight: fuzzy memberships of a neighbour list, made symmetric by a + b - ab."""
    band = knn.groupBy("id").agg(F.collect_list("dist").alias("d")).mapInPandas(_bandwidths, "id long, rho double, sigma double")
    w = knn.join(band, "id").select("id", "nbr", F.exp(-F.greatest(F.lit(0.0), F.col("dist") - F.col("rho")) / F.col("sigma")).alias("w"))
    back = w.select(F.col("nbr").alias("id"), F.col("id").alias("nbr"), F.col("w").alias("v"))
    a, b = F.coalesce("w", F.lit(0.0)), F.coalesce("v", F.lit(0.0))
    return w.join(back, ["id", "nbr"], "full").select(F.col("id").alias("src"), F.col("nbr").alias("dst"), (a + b - a * b).alias("weight"))


def pseudo_velocity(points: DataFrame, k: int = 14) -> DataFrame:
    """vx, vy, speed of each point (id, x, y, pt): the mean over its k nearest of step times pseudotime difference. Points without finite pseudotime are left out."""
    p = points.where(F.col("pt").isNotNull() & ~F.isnan("pt") & (F.abs("pt") < float("inf")))
    e = knn_2d(p.select("id", "x", "y"), k)
    a = p.select("id", "x", "y", "pt")
    b = p.select(F.col("id").alias("nbr"), F.col("x").alias("nx"), F.col("y").alias("ny"), F.col("pt").alias("npt"))
    dt = F.col("npt") - F.col("pt")
    v = e.join(a, "id").join(b, "nbr").groupBy("id").agg(F.avg((F.col("nx") - F.col("x")) * dt).alias("vx"), F.avg((F.col("ny") - F.col("y")) * dt).alias("vy"))
    return v.withColumn("speed", norm2(F.col("vx"), F.col("vy")))


def arrow_scale(points: DataFrame, velocity: DataFrame) -> DataFrame:
    """Median speed over a twentieth of the range; 1 for still points."""
    r = points.agg(F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("r"))
    s = velocity.agg(F.percentile("speed", 0.5).alias("m"))
    return r.join(s).select(F.when(F.col("m") < 1e-10, 1.0).otherwise(F.col("m") / (F.col("r") * 0.05)).alias("scale"))


def interpolate_grid(points: DataFrame, velocity: DataFrame, side: int = 40, k: int = 10, pad: float = 0.05, mask: float = 0.8) -> DataFrame:
    """Inverse-distance mean of the k nearest velocities on a side x side grid; nodes whose nearest point is farther than the mask percentile have nulls."""
    spark = points.sparkSession
    b = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    px, py = (b.x1 - b.x0) * pad, (b.y1 - b.y0) * pad
    xs = lambda i: F.lit(b.x0 - px) + i * ((b.x1 - b.x0 + 2 * px) / (side - 1))
    ys = lambda j: F.lit(b.y0 - py) + j * ((b.y1 - b.y0 + 2 * py) / (side - 1))
    grid = spark.range(side * side).select("id", xs(F.col("id") % side).alias("x"), ys(F.floor(F.col("id") / side)).alias("y"))
    e = knn_2d(points.select("id", "x", "y"), k, grid).withColumn("w", 1 / F.greatest(F.col("dist"), F.lit(1e-6)))
    v = velocity.select(F.col("id").alias("nbr"), "vx", "vy")
    g = e.join(v, "nbr").groupBy("id").agg(F.sum(F.col("vx") * F.col("w")).alias("sx"), F.sum(F.col("vy") * F.col("w")).alias("sy"), F.sum("w").alias("sw"), F.greatest(F.min("dist"), F.lit(1e-6)).alias("nearest"))
    cut = g.agg(F.percentile("nearest", mask).alias("cut"))
    near = F.col("nearest") <= F.col("cut")
    return g.join(F.broadcast(cut)).select("id", F.when(near, F.col("sx") / F.col("sw")).alias("vx"), F.when(near, F.col("sy") / F.col("sw")).alias("vy"), "nearest")


def label_edges(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """edges: src, dst, weight; labels: id, label. Adds a and b, the ends' labels."""
    return edges.join(labels.select(F.col("id").alias("src"), F.col("label").alias("a")), "src").join(labels.select(F.col("id").alias("dst"), F.col("label").alias("b")), "dst")


def cluster_graph(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """a, b, edges, connectivity of pairs of clusters: edges between over edges expected if each cell's edges fell at random, at most 1."""
    n = labels.groupBy("label").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("N"))
    x = label_edges(edges, labels)
    out = x.groupBy("a").agg(F.count("*").alias("e"))
    between = x.where("a < b or a > b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("edges"))
    side = n.join(out, n["label"] == out["a"], "left").select("label", "n", F.coalesce("e", F.lit(0)).alias("e"))
    l, r = side.select(F.col("label").alias("a"), F.col("n").alias("na"), F.col("e").alias("ea")), side.select(F.col("label").alias("b"), F.col("n").alias("nb"), F.col("e").alias("eb"))
    j = between.join(l, "a").join(r, "b").join(F.broadcast(total))
    expected = (F.col("ea") * F.col("nb") + F.col("eb") * F.col("na")) / (F.col("N") - 1)
    return j.select("a", "b", "edges", F.least(F.lit(1.0), F.col("edges") / expected).alias("connectivity"))


def terminal_clusters(cells: DataFrame, q: float = 0.75) -> DataFrame:
    """cluster, mean_pseudotime, n_cells of clusters whose mean pseudotime reaches the quantile of the clusters' means. cells: id, label, pt."""
    m = cells.groupBy(F.col("label").alias("cluster")).agg(F.avg(F.when(~F.isnan("pt"), F.col("pt"))).alias("mean_pseudotime"), F.count("*").alias("n_cells"))
    cut = m.agg(F.percentile("mean_pseudotime", q).alias("cut"))
    return m.join(F.broadcast(cut)).where(F.round("mean_pseudotime", 9) >= F.round("cut", 9)).drop("cut")


def fate_probabilities(edges: DataFrame, cells: DataFrame, q: float = 0.75) -> DataFrame:
    """id, fate, probability: the weight of a cell's edges into each terminal cluster, over all its terminal weight."""
    t = written(terminal_clusters(cells, q), "terminal")
    row = edges.groupBy("src").agg(F.sum("weight").alias("row"))
    hit = edges.join(cells.select(F.col("id").alias("dst"), F.col("label").alias("fate")), "dst").join(F.broadcast(t.select(F.col("cluster").alias("fate"))), "fate", "left_semi").groupBy(F.col("src").alias("id"), "fate").agg(F.sum("weight").alias("w"))
    names = sorted(r[0] for r in t.select("cluster").collect())
    grid = cells.select("id", F.explode(F.array(*map(F.lit, names))).alias("fate"))
    g = grid.join(hit, ["id", "fate"], "left").join(row.withColumnRenamed("src", "id"), "id", "left")
    p = F.coalesce(F.col("w") / F.greatest("row", F.lit(1e-10)), F.lit(0.0))
    g = g.select("id", "fate", p.alias("p"))
    return g.select("id", "fate", (F.col("p") / F.greatest(F.sum("p").over(W.partitionBy("id")), F.lit(1e-10))).alias("probability"))


def absorption(edges: DataFrame, terminal: DataFrame, rounds: int = 500, tolerance: float = 1e-6) -> DataFrame:
    """id, fate, probability that a walk along edges (src, dst, weight) ends in each fate of the terminal states (id, fate),
    where it stays: the fixed point of p = T p, a join and an aggregation a round, each written. States that reach no terminal keep 0."""
    total = edges.groupBy("src").agg(F.sum("weight").alias("total")).where("total > 0")
    step = written(edges.join(total, "src").join(terminal.select(F.col("id").alias("src")), "src", "left_anti").select("src", "dst", (F.col("weight") / F.col("total")).alias("t")), "chain")
    fixed = written(terminal.select("id", "fate", F.lit(1.0).alias("p")), "absorbing")
    p = fixed
    for _ in range(rounds):
        moved = step.join(p.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id"), "fate").agg(F.sum(F.col("t") * F.col("p")).alias("p"))
        new = written(moved.unionByName(fixed), "absorption")
        change = new.join(p.withColumnRenamed("p", "was"), ["id", "fate"], "left").agg(F.max(F.abs(F.col("p") - F.coalesce("was", F.lit(0.0))))).first()[0]
        p = new
        if change is None or change < tolerance:
            break
    every = edges.select(F.col("src").alias("id")).union(edges.select("dst")).union(terminal.select("id")).distinct()
    fates = terminal.agg(F.array_sort(F.collect_set("fate")).alias("fs"))  # as many as clusters
    grid = every.join(F.broadcast(fates)).select("id", F.explode("fs").alias("fate"))
    return grid.join(p, ["id", "fate"], "left").select("id", "fate", F.coalesce("p", F.lit(0.0)).alias("probability"))


def graph_layout(edges: DataFrame, start: DataFrame, rounds: int = 30, negatives: int = 5, a: float = 1.577, b: float = 0.895) -> DataFrame:
    """id, x, y: stochastic descent on the fuzzy-graph layout loss from a start layout (id, x, y), such as the first diffusion
    components. A round pulls each node along all its edges by their weights and pushes it from negatives others, whom
    hashes of the round choose; the step falls to 0. Two joins and an aggregation a round, each written. a and b shape the
    curve 1 / (1 + a d^2b); these values fit a least distance of 0.1."""
    box = start.agg(F.count("*").alias("n"), *[f(c).alias(f"{c}{i}") for c in "xy" for i, f in ((0, F.min), (1, F.max))]).first()
    if not box.n:
        return start.select("id", "x", "y")
    wide = max(box.x1 - box.x0, box.y1 - box.y0) or 1.0
    ids = written(placed(start.select("id", *[((F.col(c) - box[f"{c}0"]) * (10 / wide)).alias(c) for c in "xy"]), ["id"]), "layout")
    places = ids.select("id", "place")
    pos = ids.select("id", "x", "y")
    clip = lambda c: F.greatest(F.lit(-4.0), F.least(F.lit(4.0), c))
    for t in range(rounds):
        other = pos.select(F.col("id").alias("dst"), F.col("x").alias("ox"), F.col("y").alias("oy"))
        e = edges.where("src <> dst").join(pos.withColumnRenamed("id", "src"), "src").join(other, "dst")
        d2 = (F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox")) + (F.col("y") - F.col("oy")) * (F.col("y") - F.col("oy"))
        pull = F.when(d2 > 0, F.col("weight") * (-2 * a * b) * F.pow(d2, F.lit(b - 1)) / (1 + a * F.pow(d2, F.lit(b)))).otherwise(0.0)
        far = places.select("id", F.explode(F.transform(F.sequence(F.lit(1), F.lit(negatives)), lambda i: F.pmod(F.xxhash64("id", i, F.lit(t)), F.lit(box.n)))).alias("place"))
        far = far.join(places.withColumnRenamed("id", "dst"), "place").where("id <> dst").join(pos, "id").join(other, "dst")
        push = (2 * b) / ((0.001 + d2) * (1 + a * F.pow(d2, F.lit(b)))) / negatives
        moves = e.select(F.col("src").alias("id"), *[clip(pull * (F.col(c) - F.col(f"o{c}"))).alias(f"d{c}") for c in "xy"])
        moves = moves.unionByName(far.select("id", *[clip(push * (F.col(c) - F.col(f"o{c}"))).alias(f"d{c}") for c in "xy"]))
        total = moves.groupBy("id").agg(F.sum("dx").alias("dx"), F.sum("dy").alias("dy"))
        speed = 1.0 - t / rounds
        pos = written(pos.join(total, "id", "left").select("id", *[(F.col(c) + speed * clip(F.coalesce(f"d{c}", F.lit(0.0)))).alias(c) for c in "xy"]), "layout")
    return pos


def mutual_neighbors(vectors: DataFrame, batch: str, k: int = 20) -> DataFrame:
    """a, b: pairs of rows (id, vec, batch) of different batches that are each among the k nearest of the other's batch; a's batch sorts first."""
    near = written(knn_by_batch(vectors, batch, k), "batch-neighbours").join(vectors.select("id", F.col(batch).alias("own")), "id").where("own <> batch").select("id", "nbr", "own", "batch")
    back = near.select(F.col("nbr").alias("id"), F.col("id").alias("nbr"))
    return near.where("own < batch").join(back, ["id", "nbr"]).select(F.col("id").alias("a"), F.col("nbr").alias("b"), F.col("own").alias("batch_a"), F.col("batch").alias("batch_b"))


def align_batches(vectors: DataFrame, batch: str, k: int = 20, smooth: int = 15) -> DataFrame:
    """id, vec with each batch moved onto those before it in sorted order: a row moves by the Gaussian mean of the steps (from b
    to its mutual neighbour a) of the smooth nearest rows of its batch that have mutual neighbours. A batch without pairs stays."""
    names = sorted(r[0] for r in vectors.select(batch).distinct().collect())  # batches are few
    done = vectors.where(F.col(batch) == names[0]).select("id", F.col("vec").cast("array<double>").alias("vec")) if names else vectors.select("id", "vec")
    minus = lambda p, q: F.zip_with(p, q, lambda s, t: s - t)
    for name in names[1:]:
        own = vectors.where(F.col(batch) == name).select("id", F.col("vec").cast("array<double>").alias("vec"))
        both = done.withColumn("side", F.lit("0")).unionByName(own.withColumn("side", F.lit("1")))
        pairs = mutual_neighbors(both, "side", k)
        steps = pairs.join(done.select(F.col("id").alias("a"), F.col("vec").alias("va")), "a").join(own.select(F.col("id").alias("b"), F.col("vec").alias("vb")), "b")
        steps = steps.select(F.col("b").alias("id"), F.posexplode(minus("va", "vb")).alias("i", "s")).groupBy("id", "i").agg(F.avg("s").alias("s"))
        steps = written(steps.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda z: z["s"]).alias("step")), "steps")
        near = written(knn_blocks(written(own.join(steps.select("id"), "id", "left_semi"), "step-rows"), smooth, own), "step-neighbours")
        width = near.agg(F.percentile("dist", 0.5)).first()[0] or 1.0
        w = near.withColumn("w", F.exp(-F.col("dist") * F.col("dist") / (2 * width * width)))
        mean = w.join(steps.withColumnRenamed("id", "nbr"), "nbr").select("id", "w", F.posexplode("step").alias("i", "s")).groupBy("id", "i").agg(F.try_divide(F.sum(F.col("w") * F.col("s")), F.sum("w")).alias("s"))
        mean = mean.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda z: F.coalesce(z["s"], F.lit(0.0))).alias("step"))
        moved = own.join(mean, "id", "left").select("id", F.when(F.col("step").isNull(), F.col("vec")).otherwise(F.zip_with("vec", "step", lambda s, t: s + t)).alias("vec"))
        done = written(done.unionByName(moved), "aligned")
    return done


def direction_consistency(ref: DataFrame, cand: DataFrame) -> DataFrame:
    """Share of the weight of common edges whose signs agree; null without any. One row."""
    x = ref.select("src", "dst", F.col("weight").alias("a")).join(cand.select("src", "dst", F.col("weight").alias("b")), ["src", "dst"]).withColumn("p", F.col("a") * F.col("b"))
    return x.agg(F.try_divide(F.sum(F.when(F.col("p") > 0, F.abs("p")).otherwise(0.0)), F.sum(F.abs("p"))).alias("consistency"))


def nearest_centroid(vectors: DataFrame, labels: DataFrame) -> DataFrame:
    """id, label of the nearest mean vector; of equally near ones the least label. vectors: id, vec; labels: id, label. Labels are few."""
    c = vectors.join(labels, "id").groupBy("label").agg(vector_to_array(Summarizer.mean(array_to_vector("vec"))).alias("c"))
    table = c.agg(F.array_sort(F.collect_list(F.struct("label", "c"))).alias("cs"))
    d2 = lambda s: F.aggregate(F.zip_with("vec", s["c"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v)
    best = F.array_min(F.transform("cs", lambda s: F.struct(F.round(d2(s), 9).alias("d"), s["label"].alias("label"))))
    return vectors.join(F.broadcast(table)).select("id", best["label"].alias("label"), F.sqrt(best["d"]).alias("dist"))
