"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells.

Equal vectors of a label are one class with a count. Centroids are fitted on a
bounded sample and every class goes to the cell of its nearest centroid. A class is
also shown in each other cell whose boundary it may be linked across: two unit
vectors of cosine t are at most r = sqrt(2 - 2 t) apart, so if x is nearest to c and
a partner of y is nearest to c', then y . (c - c') <= r |c - c'|. Every class thus
meets all its partners in its own cell, and no link is lost. Cells are cut into
blocks, so a crowded cell is many tasks.

Defined results: rows whose label or vector is null, whose vector is zero or empty
or holds null or non-finite components link with nothing; vectors of different
length are not compared; repeated rows are links of each other; a null id takes part
but names a component only if all ids in it are null; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shipping import checkpointed, ship

COSINE = 0.98
#: The centroids are fitted on this many classes at most, those with the smallest hash; all classes are assigned to cells.
SAMPLE_ROWS = 20_000
MAX_CELLS = 1024
#: Classes in one block of a cell, about.
BLOCK_ROWS = 1500


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """k unit centroids at most, of the unit rows of ``x``."""
    k = min(k, len(x))
    if k < 1:
        return np.zeros((0, x.shape[1] if x.ndim == 2 else 0))
    centre = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1)
        centre = np.where(size[:, None] > 1e-9, total / np.maximum(size, 1e-9)[:, None], centre)
    return np.unique(centre, axis=0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def _packed(batches):
    """Vectors as bytes of doubles, scaled to their largest component so that no square overflows; unusable ones go."""
    for batch in batches:
        keep, raw, dim = [], [], []
        for v in batch.column(3).to_pylist():
            x = np.array([np.nan if c is None else c for c in v], np.float64) if v else np.zeros(0)
            ok = len(x) > 0 and np.isfinite(x).all() and x.any()
            keep.append(bool(ok))
            if ok:
                raw.append((x / np.abs(x).max()).tobytes() if not 1e-100 < np.abs(x).max() < 1e100 else x.tobytes())
                dim.append(len(x))
        rows = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())], names=["cid", "label", "copies", "dim", "x"])


def _placed(centres: np.ndarray, reach: float):
    """A row for each class in its own cell (home) and in each cell that it may be linked into."""

    def place(batches):
        gap = np.linalg.norm(centres[:, None] - centres[None], axis=2) if len(centres) else None
        for batch in batches:
            dim = batch.column(3).to_numpy()
            cell, row, home = [], [], []
            for d in np.unique(dim).tolist():
                at = np.flatnonzero(dim == d)
                if not len(centres) or d != centres.shape[1]:
                    cell.append(np.full(len(at), -1)), row.append(at), home.append(np.ones(len(at), bool))
                    continue
                dots = _unit(_matrix(batch.column(4).take(pa.array(at)), d)) @ centres.T
                best = dots.argmax(axis=1)
                near = dots[np.arange(len(at)), best][:, None] - dots <= reach * gap[best] + 1e-9
                near[np.arange(len(at)), best] = True
                r, c = np.nonzero(near)
                cell.append(c), row.append(at[r]), home.append(c == best[r])
            which = pa.array(np.concatenate(row) if row else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(which) for i in range(5)), pa.array(np.concatenate(cell).astype(np.int32)), pa.array(np.concatenate(home))], names=["cid", "label", "copies", "dim", "x", "cell", "home"])

    return place


def _linked(cosine: float):
    def link(table: pa.Table) -> pa.Table:
        """Links of the home classes of one block with the shown classes of another: a row (cid, links, root) for each that has some."""
        dim = table.column("dim")[0].as_py()
        kind = table.column("side").to_numpy()
        left, right = table.filter(pa.array(kind == 0)), table.filter(pa.array(kind == 1))
        empty = pa.table({"cid": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})
        if not len(left) or not len(right):
            return empty
        a, b = _unit(_matrix(left.column("x").combine_chunks(), dim)), _unit(_matrix(right.column("x").combine_chunks(), dim))
        ca, cb = left.column("cid").to_numpy(), right.column("cid").to_numpy()
        weight = right.column("copies").to_numpy()
        cid, links, forest = [], np.zeros(len(ca), np.int64), {}

        def find(v):
            while forest.setdefault(v, v) != v:
                forest[v] = forest[forest[v]]
                v = forest[v]
            return v

        for begin in range(0, len(ca), 512):
            near = (a[begin : begin + 512] @ b.T >= cosine) & (ca[begin : begin + 512, None] != cb[None])
            links[begin : begin + 512] = near @ weight
            first = np.where(near.any(axis=1), near.argmax(axis=1), -1)
            # a spanning forest of the links: each right class is joined to the first left class that it meets, and on
            r, c = np.nonzero(near)
            for i, j in zip((r + begin).tolist(), c.tolist()) if len(r) <= 4 * (len(ca) + len(cb)) else _thinned(near, first, begin):
                u, v = find(int(ca[i])), find(int(cb[j]))
                if u != v:
                    forest[max(u, v)] = min(u, v)
        some = np.flatnonzero(links)
        pairs = [(v, find(v)) for v in forest]
        edges = [(v, r) for v, r in pairs if v != r]
        cid = [*ca[some].tolist(), *(v for v, _ in edges)]
        return pa.table({"cid": pa.array(cid, pa.int64()), "links": pa.array([*links[some].tolist(), *(0 for _ in edges)], pa.int64()), "other": pa.array([*(None for _ in some), *(r for _, r in edges)], pa.int64())})

    return link


def _thinned(near: np.ndarray, first: np.ndarray, begin: int):
    """Links that connect the same classes as all of ``near``: rows with equal neighbours need only be joined once."""
    rows, back = np.unique(near, axis=0, return_inverse=True)
    lead = np.unique(back, return_index=True)[1]
    for i in np.flatnonzero(first >= 0).tolist():
        yield i + begin, int(first[i])
    for i in lead.tolist():
        for j in np.flatnonzero(near[i]).tolist():
            yield i + begin, j


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, cells: int | None = None) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    rows = rows.withColumn("cid", F.when(F.col("label").isNotNull() & (F.size("v") > 0), F.xxhash64("label", "v")))
    label_kind = rows.schema["label"].dataType.simpleString()
    classes = rows.filter("cid IS NOT NULL").groupBy("cid").agg(F.first("label").alias("label"), F.count("*").alias("copies"), F.first("v").alias("v"))
    classes = checkpointed(classes.select("cid", "label", "copies", "v").mapInArrow(_packed, f"cid bigint, label {label_kind}, copies bigint, dim int, x binary"))
    total = classes.count()
    k = cells or min(MAX_CELLS, max(4, int(total**0.5) // 16))
    sample = classes.orderBy(F.hash("cid"), "cid").limit(SAMPLE_ROWS).select("dim", "x").toArrow()
    centres = np.zeros((0, 0))
    if sample.num_rows:
        dim = sample.column("dim").to_numpy()
        d = int(np.bincount(dim).argmax())
        centres = fit_centroids(_unit(_matrix(sample.filter(pa.array(dim == d)).column("x").combine_chunks(), d)), k)
    shown = checkpointed(classes.mapInArrow(_placed(centres, float(np.sqrt(2 - 2 * cosine))), f"cid bigint, label {label_kind}, copies bigint, dim int, x binary, cell int, home boolean"))

    # home classes by block i, all shown classes by block j; a task compares one i with one j
    crowd = shown.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("nj"), F.ceil(F.count_if("home") / BLOCK_ROWS).cast("int").alias("ni")).filter("ni > 0")
    dealt = shown.join(crowd, ["label", "dim", "cell"])
    i, j = F.pmod(F.xxhash64("cid"), F.col("ni")).cast("int"), F.pmod(F.xxhash64("cid"), F.col("nj")).cast("int")
    key = ["label", "dim", "cell", "i", "j"]
    left = dealt.filter("home").select("label", "dim", "cell", i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("nj") - 1)).alias("j"), F.lit(0).alias("side"), "cid", "copies", "x")
    right = dealt.select("label", "dim", "cell", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)).alias("i"), j.alias("j"), F.lit(1).alias("side"), "cid", "copies", "x")
    found = checkpointed(left.unionByName(right).groupBy(*key).applyInArrow(_linked(cosine), "cid bigint, links bigint, other bigint"))

    roots = checkpointed(connected_components(found.filter("other IS NOT NULL").select(F.col("cid").alias("a"), F.col("other").alias("b"))))
    sums = found.groupBy("cid").agg(F.sum("links").alias("links"))
    known = classes.select("cid", "copies").join(sums, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cid").alias("root"))
    placed = checkpointed(rows.select("id", "cid").join(known, "cid", "left"))
    least = placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least"))
    named = placed.join(least, "root", "left")
    result = named.select(F.col("id").alias(id_col), F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "id").alias("component_id"))
    return result.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pair AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach AS (SELECT a, b FROM pair UNION SELECT r.a, p.b FROM reach r JOIN pair p ON r.b = p.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY 1), n AS (SELECT a, count(*) AS n FROM pair GROUP BY 1)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.m, e.vec_id)) AS component_id, e.vec_id = least(e.vec_id, coalesce(l.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN least l ON e.vec_id = l.a
"""
