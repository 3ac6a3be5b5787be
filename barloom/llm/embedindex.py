"""Embedding near-dedup through an inverted multi-index with multi-sequence traversal.

Both halves of the vectors have a codebook; pairs of centroids are the cells of a grid. A vector stands in one cell and
visits others by growing distance to their borders, as far as the target recall needs; what it meets there is verified.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .graph import components
from .scratch import Scratch

THRESHOLD = 0.9
#: Share of the partners at exactly the threshold, in any direction, whose cell is visited; nearer ones are found likelier
#: still. 1: all cells are visited that can hold a partner, and no link is lost, at many times the cost.
RECALL = 0.999
#: The same for partners that differ in one half only, along one axis, or towards another vector, at least.
RECALL_ALONG = 0.995
#: Vectors that the codebooks and the visiting radius are fitted on, at most.
SAMPLE = 8192
#: Vectors for each cell of the grid, about, and the fewest and most centroids of a half.
PER_CELL, LEAST_CENTROIDS, MOST_CENTROIDS = 800, 4, 128
#: Members of a cell that one task takes at once, and times as many visitors; fuller cells are dealt over several.
BLOCK, WIDE = 2048, 8


@dataclass
class Index:
    """Codebooks of both halves, distances between their centroids, and the radius up to which cells are visited."""

    books: list[np.ndarray]
    apart: list[np.ndarray]
    radius: float

    def margins(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: own centroid, and the squared distance to the bisecting plane between it and every other."""
        cut, out = len(self.books[0][0]), []
        for book, apart, part in zip(self.books, self.apart, (x[:, :cut], x[:, cut:]), strict=True):
            d = (part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1)
            own = d.argmin(1)
            m = (d - d[np.arange(len(d)), own][:, None]) / (2 * np.maximum(apart[own], 1e-12))
            m[np.arange(len(d)), own] = 0
            out.append((own, np.maximum(m, 0) ** 2))
        return out

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own cell of each vector, and (row, cell) of the cells of lower number that its traversal visits.

        The halves' margins, each sorted, span a grid whose sums grow along both sequences: for one place in the first
        the places in the second up to the radius are a prefix, which only shrinks from one place to the next. All
        vectors go down that staircase together.
        """
        (a, ma), (b, mb) = self.margins(x)
        k = len(self.books[1])
        own = a * k + b
        oa, ob = np.argsort(ma, 1, kind="stable"), np.argsort(mb, 1, kind="stable")
        sa, sb = np.take_along_axis(ma, oa, 1), np.take_along_axis(mb, ob, 1)
        rows, cells = [], []
        for i in range(sa.shape[1]):
            go = np.flatnonzero(sa[:, i] <= self.radius)
            if not len(go):
                break
            r, j = np.nonzero(sb[go] <= (self.radius - sa[go, i])[:, None])
            r = go[r]
            cell = oa[r, i] * k + ob[r, j]
            lower = cell < own[r]
            rows.append(r[lower])
            cells.append(cell[lower])
        return own, np.concatenate(rows), np.concatenate(cells)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    book = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = ((book**2).sum(1) - 2 * x @ book.T).argmin(1)
        sums, n = np.zeros_like(book), np.bincount(own, minlength=k)
        np.add.at(sums, own, x)
        book[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return book


def _partners(x: np.ndarray, threshold: float, rng: np.random.Generator) -> list[np.ndarray]:
    """Partners at the threshold in several directions: any, within either half, along one axis, towards another vector."""
    cut, dim = x.shape[1] // 2, x.shape[1]
    any_ = rng.normal(size=x.shape)
    first, second, axis = any_.copy(), any_.copy(), np.zeros_like(x)
    first[:, cut:], second[:, :cut] = 0, 0
    axis[np.arange(len(x)), rng.integers(0, dim, len(x))] = 1
    out = []
    for noise in (any_, first, second, axis, x[rng.permutation(len(x))]):
        noise = noise - (noise * x).sum(1)[:, None] * x
        length = np.linalg.norm(noise, axis=1)[:, None]
        out.append(np.where(length > 1e-6, threshold * x + math.sqrt(1 - threshold**2) * noise / np.maximum(length, 1e-6), x))
    return out


def fit(sample: np.ndarray, total: int, threshold: float, recall: float, per_cell: int, seed: int = 5) -> Index:
    """Codebooks from a sample of unit vectors; the radius from partners made at the threshold, of the direction that needs most.

    A partner on the other side of a border is at least as far away as the border, in each half; with recall 1 the radius
    is the squared distance at the threshold, so that no partner's cell can lie beyond it.
    """
    rng = np.random.default_rng(seed)
    k = int(min(MOST_CENTROIDS, max(LEAST_CENTROIDS, round(math.sqrt(total / per_cell))), len(sample)))
    cut = sample.shape[1] // 2
    books = [_kmeans(sample[:, :cut], k, rng), _kmeans(sample[:, cut:], k, rng)]
    apart = [np.sqrt(((b[:, None] - b[None]) ** 2).sum(2)) for b in books]
    index = Index(books, apart, 2 - 2 * threshold + 1e-9)
    if recall < 1:
        x = sample[: min(len(sample), 4096)]
        (_, ma), (_, mb) = index.margins(x)
        r, needed = np.arange(len(x)), []
        for k, partner in enumerate(_partners(x, threshold, rng)):
            (a, _), (b, _) = index.margins(partner)
            needed.append(float(np.quantile(ma[r, a] + mb[r, b], min(recall, RECALL_ALONG) if k else recall)))
        index.radius = min(index.radius, max(needed))
    return index


def _unit(raw: list[bytes], kind: str, dim: int) -> np.ndarray:
    """Unit vectors in doubles; scaled by their largest component first, so that no square overflows or vanishes."""
    x = np.frombuffer(b"".join(raw), kind).reshape(-1, dim).astype(float)
    x = x / np.abs(x).max(1, initial=0)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _dealt(cell: np.ndarray, probe: np.ndarray, mix: np.ndarray, members: np.ndarray, probes: np.ndarray):
    """For each (vector, cell) the block pairs it is needed in: (row, first block, second block, whether on the second's side).

    A cell's members are in `members` blocks and those that visit it in `probes`. Members meet members (pairs m <= p)
    and every block of visitors; visitors meet every block of members.
    """
    m, p = members[cell], probes[cell]
    n = np.where(probe, m, m + p)
    row = np.repeat(np.arange(len(cell)), n)
    j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    own = mix[row] % np.maximum(np.where(probe, p, m), 1)[row]
    own = own.astype(np.int64)
    visits, m = probe[row], m[row]
    low = visits | (j < m) & (j < own)
    return row, np.where(visits, j, np.where(low, j, own)), np.where(visits, m + own, np.where(low, own, j)), low


def _assign(index: Index, kind: str, dim: int, blocks: tuple[np.ndarray, np.ndarray] | None):
    """Rows for mapInArrow: without blocks, cell and role only; with them, each vector for each block pair it is needed in."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                own, row, cell = index.cells(_unit(part["vector"].to_pylist(), kind, dim))
                cell, row = np.concatenate([own, cell]), np.concatenate([np.arange(len(own)), row])
                probe = np.arange(len(cell)) >= len(own)
                if blocks is None:
                    key, n = np.unique(cell * 2 + probe, return_counts=True)
                    yield pa.record_batch({"cell": key // 2, "probe": (key % 2).astype(bool), "n": n})
                    continue
                mix = (part["cid"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                k, m, p, side = _dealt(cell, probe, mix[row], *blocks)
                for at in range(0, len(k), 8192):
                    some = slice(at, at + 8192)
                    r = pa.array(row[k[some]])
                    yield pa.record_batch(
                        {"cell": cell[k[some]], "members": m[some], "probes": p[some], "probe": side[some], "cid": part["cid"].take(r), "copies": part["copies"].take(r), "vector": part["vector"].take(r)}
                    )

    return run


def _compare(kind: str, dim: int, threshold: float):
    """One block pair -> for each vector that has links there: how many, and the least vector they reach in the pair."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        probe = g["probe"].to_numpy()
        ids, copies = g["cid"].to_numpy(), g["copies"].to_numpy()
        x = _unit(g["vector"].tolist(), kind, dim)
        left = np.flatnonzero(~probe)
        within = g["members"].iat[0] == g["probes"].iat[0]  # a block of members against itself
        right = left if within else np.flatnonzero(probe)
        found = []
        for lo in range(0, len(right), BLOCK):
            near = x[left] @ x[right[lo : lo + BLOCK]].T >= threshold
            a, b = np.nonzero(np.triu(near, 1 - lo) if within else near)
            found.append((left[a], right[lo + b]))
        i, j = (np.concatenate(v) for v in zip(*found, strict=True)) if found else (left[:0], left[:0])
        count = np.bincount(i, copies[j], len(g)) + np.bincount(j, copies[i], len(g))
        label = ids.copy()
        while len(i):
            low = np.minimum(label[i], label[j])
            after = label.copy()
            np.minimum.at(after, i, low)
            np.minimum.at(after, j, low)
            if (after == label).all():
                break
            label = after
        has = count > 0
        return pd.DataFrame({"cid": ids[has], "n": count[has].astype(np.int64), "least": label[has]})

    return run


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL, sample: int = SAMPLE, per_cell: int = PER_CELL, block: int = BLOCK
) -> DataFrame:
    """Vectors -> (vec_id, n_links, component_id, kept), a row for each row.

    Equal vectors are one class, searched once; all copies link to each other, also rows with equal ids. Codebooks are
    fitted on at most `sample` classes, least hash first; every class is indexed. Vectors that are null, empty, zero or
    hold nulls or values that are not finite, and rows with a null id, link with nothing: n_links 0, component_id their own id, kept
    true. Vectors of another length than the longest valid one in the sample link with nothing but their copies. Ids may
    be of any orderable type; other columns are not read. No rows: no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embedindex")
    v = F.col(vector_col)
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    v = v if single else v.cast("array<double>")
    largest = F.array_max(F.transform(v, F.abs))  # not a number is more than any
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v"), largest.alias("most"), F.exists(v, F.isnull).alias("gap"))
    valid = F.coalesce(F.col("id").isNotNull() & ~F.col("gap") & (F.col("most") > 0) & (F.col("most") < float("inf")), F.lit(False))
    keys = [F.when(valid, F.xxhash64(F.lit(s), "v")).alias(f"k{s}") for s in (1, 2)]
    rows = scratch.table(rows.select("id", *keys, F.when(valid, F.col("v")).alias("v")))
    good = rows.where("k1 is not null")
    classes = good.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v"))
    classes = scratch.table(classes.withColumn("cid", F.monotonically_increasing_id()))
    total = classes.count()
    dim = classes.orderBy("k1", "k2").limit(sample).agg(F.max(F.size("v"))).first()[0] if total else None
    if dim is None:
        linked = spark.createDataFrame([], "cid bigint, n bigint, root bigint")
    else:
        linked = _links(classes.where(F.size("v") == dim), "<f4" if single else "<f8", int(dim), total, threshold, recall, sample, per_cell, block, scratch)
    named = classes.select("k1", "k2", "id", "copies", "cid").join(linked, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = scratch.table(named)
    least = scratch.table(named.groupBy("root").agg(F.min("id").alias("component_id")))
    named = named.join(least, "root").select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"), "component_id")
    out = rows.join(scratch.table(named), ["k1", "k2"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _links(classes: DataFrame, kind: str, dim: int, total: int, threshold, recall, sample, per_cell, block, scratch: Scratch) -> DataFrame:
    """Classes (cid, copies, v) -> (cid, n, root) of those that link with another class."""

    def packed(column: pa.Array) -> pa.Array:
        flat, width = np.asarray(column.flatten(), kind).tobytes(), dim * int(kind[-1])
        return pa.array([flat[k : k + width] for k in range(0, len(flat), width)], pa.binary())

    vector = arrow_udf(packed, "binary").asNondeterministic()("v").alias("vector")
    flat = scratch.table(classes.select("k1", "k2", "cid", "copies", vector))
    got = flat.select("k1", "k2", "vector").orderBy("k1", "k2").limit(sample).toArrow().sort_by([("k1", "ascending"), ("k2", "ascending")])
    index = fit(_unit(got["vector"].to_pylist(), kind, dim), total, threshold, recall, per_cell)

    flat = flat.select("cid", "copies", "vector")
    sizes = flat.mapInArrow(_assign(index, kind, dim, None), "cell long, probe boolean, n long").groupBy("cell", "probe").agg(F.sum("n").alias("n"))
    cells = len(index.books[0]) * len(index.books[1])
    blocks = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    for cell, probe, n in sizes.collect():  # at most two rows for each cell of the grid
        blocks[int(probe)][cell] = -(-n // (block * WIDE if probe else block))
    rows = flat.mapInArrow(_assign(index, kind, dim, blocks), "cell long, members long, probes long, probe boolean, cid long, copies long, vector binary")
    found = rows.groupBy("cell", "members", "probes").applyInPandas(_compare(kind, dim, threshold), "cid long, n long, least long")
    found = scratch.table(found)
    named = components(found.select(F.col("cid").alias("u"), F.col("least").alias("v")), scratch)
    counts = found.groupBy("cid").agg(F.sum("n").alias("n"))
    return counts.join(named.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "n", F.col("component").alias("root"))
