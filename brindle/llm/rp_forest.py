"""Embedding near-duplicates by a forest of random-projection trees with spill overlap."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import written
from brindle.llm.components import components

#: Rows that a tree's upper levels leave to one task at most, about.
TASK_ROWS = 50_000
BLOCK = 1024
#: Share of a node's rows that a side has at most.
SIDE = 0.625


def directions(seed: int, path: str, width: int) -> np.ndarray:
    """The random direction of a node, from its path in its tree alone."""
    return np.random.default_rng([seed, zlib.crc32(path.encode())]).standard_normal(width)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that neither very large nor very small components overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def pair_distance(least: float) -> float:
    """Distance of unit vectors at the threshold, and so the deviation of their difference in a random projection."""
    return math.sqrt(max(0.0, 2 - 2 * least))


def trees_needed(rows: float, leaf: int, spread: float, spill: float, least: float, recall: float) -> int:
    """Trees with which a pair at the threshold shares a leaf with at least this chance.

    A cut at the median of projections of this deviation separates a pair if it falls into the part of the pair's
    difference beyond 2 * spill; density and difference are taken as normal. Spread counts as the pair's distance at
    least: below that most pairs of the label are links.
    """
    far = pair_distance(least)
    if rows <= leaf or not far:
        return 1
    dense = 1 / (math.sqrt(2 * math.pi) * max(spread, far))
    x = 2 * spill / far
    beyond = 2 * far * (math.exp(-x * x / 2) / math.sqrt(2 * math.pi) - x * (1 - math.erf(x / math.sqrt(2))) / 2)
    levels = math.ceil(math.log(rows / leaf) / -math.log(min(0.5 + spill * dense, SIDE)))
    met = (1 - min(0.9, beyond * dense)) ** levels
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-met))) if met < recall else 1


def _edges(p: np.ndarray, spill: float) -> tuple[float, float]:
    """Where the lower side ends and the upper side starts: spill beyond the median, but no side has more than SIDE of the rows."""
    start, cut, end = np.quantile(p, (1 - SIDE, 0.5, SIDE))
    return float(min(cut + spill, end)), float(max(cut - spill, start))


def split_tree(sample: np.ndarray, seed: int, path: str, rows: float, spill: float) -> dict[str, tuple[float, float]]:
    """Edges of the sides, from the sample's projections, for the nodes above TASK_ROWS rows; rows: how many the sample stands for."""
    if rows <= TASK_ROWS or len(sample) < 32:
        return {}
    p = sample @ directions(seed, path, sample.shape[1])
    end, start = _edges(p, spill)
    out = {path: (end, start)}
    for side, at in (("0", p < end), ("1", p >= start)):
        out |= split_tree(sample[at], seed, path + side, rows * float(at.mean()), spill)
    return out


def descend(vectors: np.ndarray, cuts: dict[str, tuple[float, float]], seed: int, path: str) -> Iterator[tuple[str, np.ndarray]]:
    """Leaves of the upper levels with the rows that reach them; rows near a cut go to both sides."""
    todo = [(path, np.arange(len(vectors)))]
    while todo:
        path, rows = todo.pop()
        if path not in cuts:
            yield path, rows
            continue
        p = vectors[rows] @ directions(seed, path, vectors.shape[1])
        end, start = cuts[path]
        todo += [(path + "0", rows[p < end]), (path + "1", rows[p >= start])]


def leaves(vectors: np.ndarray, seed: int, path: str, leaf: int, spill: float) -> Iterator[np.ndarray]:
    """Rows of each leaf: a node of more than `leaf` rows is split at its median, with overlap of SIDE of its rows a side at most."""
    todo = [(path, np.arange(len(vectors)))]
    while todo:
        path, rows = todo.pop()
        if len(rows) > leaf and len(path) < 64:
            p = vectors[rows] @ directions(seed, path, vectors.shape[1])
            end, start = _edges(p, spill)
            low, high = rows[p < end], rows[p >= start]
            if max(len(low), len(high)) > 0.9 * len(rows):  # most projections are equal: halves without overlap
                order = np.argsort(p, kind="stable")
                low, high = rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]
            todo += [(path + "0", low), (path + "1", high)]
            continue
        yield rows


def spanning_links(vectors: np.ndarray, rows: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links that join the rows of a leaf as all its links of cosine >= least do: a spanning forest of them."""
    close = vectors[rows] @ vectors[rows].T >= least
    np.fill_diagonal(close, False)
    left = np.ones(len(rows), bool)
    out = []
    for start in np.flatnonzero(close.any(axis=1)):
        if not left[start]:
            continue
        left[start] = False
        front = [int(start)]
        while front:
            at = front.pop()
            for other in np.flatnonzero(close[at] & left):
                left[other] = False
                out.append((int(rows[at]), int(rows[other])))
                front.append(int(other))
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """id, label and vec (doubles) of the rows that can link: label not null, components finite and not all zero."""
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    out = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("string").alias("label"), vec.alias("vec"))
    return out.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).filter(finite & F.exists("vec", lambda v: v != 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return _unit(flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1))


def forest_links(nodes: DataFrame, sizes: list[tuple[str, int, int]], least: float, trees: int, leaf: int, spill: float, seed: int, sample_rows: int, recall: float) -> DataFrame:
    """Links (a, b) found in the leaves of all trees, verified by their cosine in double precision.

    sizes: label, width and number of rows of each group that needs upper levels because it is larger than TASK_ROWS;
    their medians come from a sample of sample_rows rows for each such group at most.
    """
    plans: dict[tuple[str, int, int], dict[str, tuple[float, float]]] = {}
    grown: dict[tuple[str, int], int] = {}
    for label, width, rows in sizes:
        group = nodes.filter((F.col("label") == label) & (F.size("vec") == width))
        wanted = 64 * math.ceil((rows / TASK_ROWS) ** 1.5)  # so many that the smallest nodes above TASK_ROWS have some
        found = group.orderBy(F.xxhash64(F.lit(seed), "id"), "id").select("vec").limit(min(sample_rows, wanted)).collect()
        sample = _unit(np.array([r["vec"] for r in found], dtype=float))
        spread = math.sqrt(float(sample.var(axis=0).sum()))  # deviation of a random projection
        grown[label, width] = max(trees, trees_needed(rows, leaf, spread, spill, least, recall))
        for tree in range(grown[label, width]):
            plans[label, width, tree] = split_tree(sample, seed, f"{tree}:", rows, spill)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column("vec")
            groups = pd.DataFrame({"label": batch.column("label").to_pandas(), "width": pc.list_value_length(vec).to_numpy(zero_copy_only=False)}).groupby(["label", "width"]).indices
            out: list[tuple] = []
            for (label, width), at in groups.items():
                if (label, width) not in grown:  # all trees of a small label in one task: its vectors are sent once
                    out += [(f"{label}\t{width}\t", int(r)) for r in at]
                    continue
                unit = _matrix(vec.take(pa.array(at)))
                for tree in range(grown[label, width]):
                    for path, rows in descend(unit, plans.get((label, width, tree), {}), seed, f"{tree}:"):
                        out += [(f"{label}\t{width}\t{path}", int(at[r])) for r in rows]
            take = pa.array([r for _, r in out], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.string()), batch.column("id").take(take), batch.column("vec").take(take)], names=["node", "id", "vec"])

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids, unit = group.column("id").to_numpy(), _matrix(group.column("vec"))
        path = group.column("node")[0].as_py().rsplit("\t", 1)[1]
        links: set[tuple[int, int]] = set()
        for start in [path] if path else [f"{tree}:" for tree in range(trees if len(ids) > leaf else 1)]:
            for rows in leaves(unit, seed, start, leaf, spill):
                links.update(spanning_links(unit, rows, least))
        return pa.table({"a": pa.array([int(ids[a]) for a, _ in links], pa.int64()), "b": pa.array([int(ids[b]) for _, b in links], pa.int64())})

    return nodes.mapInArrow(place, "node string, id long, vec array<double>").groupBy("node").applyInArrow(compare, "a long, b long")


def count_links(members: DataFrame, least: float) -> DataFrame:
    """For each row of members (root, id, vec, copies) how many other vectors of its component link with it.

    A component is compared in blocks of BLOCK rows: each pair of blocks is a group of its own, so a component with a
    third of all rows is spread over many tasks and none holds more than two blocks.
    """
    # Only components of several blocks are sent to all tasks, a row for each BLOCK vectors at most. A join dealt by root
    # alone would keep all pairs of blocks of a component in one task.
    large = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).filter("blocks > 1")
    dealt = members.join(F.broadcast(large), "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pairs = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    sent = dealt.select("root", "id", "vec", "copies", "block", pairs).select("root", "id", "vec", "copies", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def count(group: pa.Table) -> pa.Table:
        ids, unit, copies = group.column("id").to_numpy(), _matrix(group.column("vec")), group.column("copies").to_numpy()
        block = group.column("block").to_numpy()
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        n = np.zeros(len(ids), np.int64)
        for x, y in {(i, j), (j, i)}:
            rows, others = np.flatnonzero(block == x), np.flatnonzero(block == y)
            close = unit[rows] @ unit[others].T >= least
            if x == y:
                np.fill_diagonal(close, False)
            n[rows] += close @ copies[others]
        return pa.table({"id": pa.array(ids), "n": pa.array(n)})

    return sent.groupBy("root", "i", "j").applyInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def near_duplicates(vectors: DataFrame, least: float = 0.93, trees: int = 8, leaf: int = 512, spill: float | None = None, seed: int = 13, sample_rows: int = 65_536, recall: float = 0.95) -> DataFrame:
    """Links, components and the vector to keep for every row of vectors (vec_id, label, embedding).

    Equal vectors of a label are one node. Each tree splits a label's vectors at medians of random projections down to
    leaves of `leaf` rows, giving those within `spill` of a cut to both sides (a quarter of the distance of vectors at
    the threshold, if not given: a difference of the 0.38 quantile is never cut); labels above TASK_ROWS vectors get so
    many trees, `trees` at least, that by their depth and the spread of their vectors a pair at the threshold shares a
    leaf with chance `recall`; smaller labels get `trees`. The rows of a leaf are compared by cosine
    in double precision, the links of all trees are united, and within each component that they form all pairs are
    compared in blocks, so n_links counts every link between its members. Upper levels of labels with more than
    TASK_ROWS vectors take their medians from a sample of sample_rows vectors at most; every vector is indexed.

    Labels must be equal and not null. Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing, nor do vectors of different lengths or rows with a null vec_id. Rows that repeat a vec_id with an equal vector
    are one vector; with different vectors that vec_id has the links of both. An empty table gives an empty result.

    Returns vec_id, n_links, component_id and kept for every row.
    """
    good = written(usable(vectors), "vectors")
    same = ["label", "vec"]
    spill = pair_distance(least) / 4 if spill is None else spill
    nodes = written(good.groupBy(*same).agg(F.min("id").alias("id"), F.countDistinct("id").alias("copies")), "vector-nodes")
    large = nodes.groupBy("label", F.size("vec").alias("width")).agg(F.count("*").alias("n")).filter(F.col("n") > TASK_ROWS).collect()  # n / TASK_ROWS groups at most
    links = written(forest_links(nodes.select("id", "label", "vec"), [tuple(r) for r in large], least, trees, leaf, spill, seed, sample_rows, recall).distinct(), "vector-links")
    roots = written(components(links), "vector-roots")
    counted = count_links(roots.join(nodes, roots["node"] == nodes["id"]).select("root", "id", "vec", "copies"), least)
    known = nodes.join(roots, nodes["id"] == roots["node"], "left").join(counted.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
    known = known.filter("copies > 1 or root is not null").select(*same, F.col("id").alias("_node"), F.coalesce("root", "id").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = good.join(known, same).select("id", "_node", "root", "n_links").distinct().groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("root").alias("root"))
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(found, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
