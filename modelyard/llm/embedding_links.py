"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length one and cut into halves; each half has its own codebook, and
the two codes span a grid of cells. For a pair with cosine >= c the distance is at most
r = sqrt(2 - 2c), and a vector's distance to a cell of the grid is bounded from below by
its distances to the bisecting planes between its own centroids and the cell's. A vector
visits cells in growing order of that bound until the target recall: for the default of
1 until the bound passes r, beyond which no cell can hold a link; for less until the
chance that a link's difference, if it points anywhere alike, reaches farther is small
enough. Residents of visited cells are then verified in double precision, in tiles.
Complete recall visits a share of the grid that shrinks slowly (a quarter of 256 cells, a
sixteenth of 4096, in 64 dimensions); tables of billions should ask for 0.9999.

The codebooks are fitted on at most SAMPLE vectors; all vectors are indexed and compared.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components,
and rows with a null label or id, link with nothing and are their own component. Vectors of
different lengths never link. Equal vectors are compared once and counted as often as they
occur; repeated rows count as other vectors. An empty table gives an empty table. Extra
columns pass through; columns of the result's names are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.llm.components import components
from modelyard.llm.links import forest, tiles
from modelyard.llm.text import free_name
from modelyard.session import settled

THRESHOLD = 0.98
SAMPLE = 8192  # vectors that the codebooks are fitted on, at most
PER_CELL = 2048  # wanted vectors of one label in a cell
MAX_CODES = 256  # centroids of one half, at most: bounds the broadcast codebooks
TILE = 4096
TARGET_RECALL = 1.0
ADDED = ("n_links", "component_id", "kept")


def _usable(name: str):
    v = F.col(name)
    return F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0),
        F.lit(False),
    )


def unit(rows, width: int) -> np.ndarray:
    """Rows as unit vectors in double precision, padded with zeros to width."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    out /= np.abs(out).max(axis=1, keepdims=True)  # lengths neither overflow nor vanish
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def fit_codebook(half: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    """k-means of one half; starts at evenly spaced rows, empty centroids stay."""
    centres = half[np.linspace(0, len(half) - 1, codes).astype(int)].copy()
    for _ in range(rounds):
        own = distances(half, centres).argmin(axis=1)
        for c in range(codes):
            members = half[own == c]
            if len(members):
                centres[c] = members.mean(axis=0)
    return np.unique(centres, axis=0)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    d = (x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)
    return np.maximum(d, 0.0)


def bounds(half: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own code, and per code a lower bound of the squared distance to any vector with it."""
    d = distances(half, centres)
    own = d.argmin(axis=1)
    apart = np.sqrt(distances(centres, centres))[own]
    gap = d - d[np.arange(len(half)), own][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(apart > 0, gap / (2 * apart), 0.0)
    return own, np.maximum(plane, 0.0) ** 2


def traverse(first: np.ndarray, second: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """Cells of the grid in growing order of first[i] + second[j], up to limit.

    Both lists are sorted once; along the sorted rows the cells within the limit form a
    staircase, so only visited cells and their border are looked at.
    """
    rows, cols = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    f, s = first[rows], second[cols]
    reach = np.searchsorted(s, limit - f, side="right")
    cells = [(f[i] + s[j], int(rows[i]), int(cols[j])) for i in range(len(f)) for j in range(reach[i])]
    return [(i, j) for _, i, j in sorted(cells)]


def stop_at(threshold: float, recall: float, width: int) -> float:
    """The bound's value at which a traversal may end.

    Two unit normals, one in each half, span a plane; of a difference of length r in width
    dimensions, the part in that plane has a squared length below t * r**2 with
    probability 1 - (1 - t) ** ((width - 2) / 2).
    """
    r2 = 2 - 2 * threshold
    share = 1.0 if recall >= 1 or width <= 2 else 1 - (1 - recall) ** (2 / (width - 2))
    return r2 * share + 1e-9


def _codebooks(vectors: DataFrame, codes: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    sample = (
        vectors.orderBy(F.xxhash64("rep", "k1"), "rep").limit(SAMPLE).select("vector").toPandas()["vector"]
    )
    x = unit(sample.tolist(), width)
    cut = (width + 1) // 2
    codes = min(codes, len(x))
    return fit_codebook(x[:, :cut], codes), fit_codebook(x[:, cut:] if width > 1 else x * 0, codes)


def _entries(books: tuple[np.ndarray, np.ndarray], width: int, limit: float):
    """A task function: each vector as resident of its cell and as visitor of later cells."""
    cut, columns = (width + 1) // 2, len(books[1])

    def run(batches):
        for batch in batches:
            for begin in range(0, len(batch), 512):
                part = batch.iloc[begin : begin + 512]
                x = unit(part["vector"].tolist(), width)
                own1, b1 = bounds(x[:, :cut], books[0])
                own2, b2 = bounds(x[:, cut:] if width > 1 else x * 0, books[1])
                home = own1 * columns + own2
                at, cell = [], []
                for i in range(len(x)):
                    # the pair meets once: in the later cell, or at home
                    visited = [home[i]] + [
                        c for c in (r * columns + k for r, k in traverse(b1[i], b2[i], limit)) if c > home[i]
                    ]
                    at += [i] * len(visited)
                    cell += visited
                out = part.iloc[at].copy()
                out["cell"] = np.asarray(cell, dtype="int32")
                out["resident"] = out["cell"].to_numpy() == home[at]
                yield out

    return run


def _verify(width: int, threshold: float):
    """A tile function: links of residents with residents and visitors of one cell."""

    def run(key: tuple, tile: pd.DataFrame) -> pd.DataFrame:
        same = key[-1] == key[-2]
        x = unit(tile["vector"].tolist(), width)
        block = tile["block"].to_numpy()
        resident = tile["resident"].to_numpy()
        n = len(x)
        side = block == key[-2]
        left, right = [], []
        rows = np.flatnonzero(side)
        others = np.arange(n) if same else np.flatnonzero(~side)
        for begin in range(0, len(rows), 512):
            own = rows[begin : begin + 512]
            near = x[own] @ x[others].T >= threshold
            near &= resident[own][:, None] | resident[others][None, :]
            if same:
                near &= own[:, None] < others[None, :]
            i, j = np.nonzero(near)
            left.append(own[i])
            right.append(others[j])
        left, right = np.concatenate(left), np.concatenate(right)
        copies = tile["copies"].to_numpy()
        count = np.bincount(left, copies[right], n) + np.bincount(right, copies[left], n)
        rep = tile["rep"].to_numpy()
        child, root = forest(left, right, n)
        linked = np.flatnonzero(count)
        return pd.DataFrame(
            {
                "a": np.concatenate([rep[linked], rep[child]]),
                "b": np.concatenate([rep[linked], rep[root]]),
                "n": np.concatenate([count[linked], np.zeros(len(child))]).astype("int64"),
            }
        )

    return run


def _tile_results(entries: DataFrame, width: int, threshold: float) -> DataFrame:
    place = ["label", "dim", "cell"]
    sized = entries.groupBy(*place).agg(F.count("*").alias("n"), F.sum(F.col("resident").cast("int")).alias("r"))
    # a cell that nobody shares has nothing to compare
    sized = sized.filter("n > 1 and r > 0").select(
        *place, F.ceil(F.col("n") / TILE).cast("int").alias("blocks")
    )
    tiled = (
        entries.join(sized, place)
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("tile", F.explode(tiles(F.col("blocks"), F.col("block"))))
        .select(*place, "tile.first", "tile.second", "block", "resident", "rep", "copies", "vector")
    )
    return tiled.groupBy(*place, "first", "second").applyInPandas(
        _verify(width, threshold), "a bigint, b bigint, n bigint"
    )


def link(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    recall: float = TARGET_RECALL,
) -> DataFrame:
    """vectors with n_links, component_id and kept (id = component_id)."""
    k1, k2, rep = (free_name(vectors, n) for n in ("k1", "k2", "rep"))
    usable = _usable(vector) & F.col(label).isNotNull() & F.col(id_col).isNotNull()
    # 128 bits of the label and the vector stand for both; unusable rows have none
    keyed = vectors.withColumn(k1, F.when(usable, F.xxhash64(F.lit(1), label, vector))).withColumn(
        k2, F.when(usable, F.xxhash64(F.lit(2), label, vector))
    )
    distinct = settled(
        keyed.filter(F.col(k1).isNotNull())
        .groupBy(F.col(k1).alias("k1"), F.col(k2).alias("k2"))
        .agg(
            F.min(id_col).cast("bigint").alias("rep"),
            F.count("*").alias("copies"),
            F.first(label).alias("label"),
            F.first(vector).alias("vector"),
        )
        .withColumn("dim", F.size("vector"))
    )
    shape = distinct.groupBy("label", "dim").agg(F.count("*").alias("n"))
    shape = shape.agg(F.max("dim").alias("width"), F.max("n").alias("n")).first()
    none = F.lit(0).cast("bigint")
    if shape["n"] is None:
        counted = distinct.select("k1", "k2", none.alias("n_links"), F.col("rep").alias("component"))
    else:
        codes = max(2, min(MAX_CODES, math.ceil(math.sqrt(shape["n"] / PER_CELL))))
        books = _codebooks(distinct, codes, shape["width"])
        slim = distinct.select("label", "dim", "rep", "copies", "vector")
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema.fields)
        entries = slim.mapInPandas(
            _entries(books, shape["width"], stop_at(threshold, recall, shape["width"])),
            f"{kinds}, cell int, resident boolean",
        )
        found = settled(_tile_results(entries, shape["width"], threshold))
        links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
        groups = components(found.select("a", "b").filter("a <> b"))
        counted = (
            distinct.join(links, "rep", "left")
            .join(groups.withColumnRenamed("id", "rep"), "rep", "left")
            .select(
                "k1",
                "k2",
                (F.coalesce("n", none) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component"),
            )
        )
    found_names = {"k1": k1 + "_f", "k2": k2 + "_f", "n_links": rep + "_n", "component": rep + "_c"}
    counted = counted.select(*[F.col(a).alias(free_name(keyed, b)) for a, b in found_names.items()])
    f1, f2, n, c = counted.columns
    joined = keyed.join(counted, (keyed[k1] == counted[f1]) & (keyed[k2] == counted[f2]), "left")
    component = F.coalesce(F.col(c), F.col(id_col).cast("bigint"))
    rest = [F.col(f"`{x}`") for x in vectors.columns if x.lower() not in ADDED]
    return joined.select(
        *rest,
        F.coalesce(F.col(n), none).alias("n_links"),
        component.alias("component_id"),
        F.col(id_col).cast("bigint").eqNullSafe(component).alias("kept"),
    )
