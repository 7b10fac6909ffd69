"""Operator 7, embedding near-dedup: PCA-ordered tiled comparison.

Unit vectors are turned so that the dimensions with most of the data's second moment come first. Within a
label they are dealt to cells of the two leading coordinates, as wide as two linked vectors can be apart in
any one coordinate, and cells to blocks of bounded size; only blocks of the same or of touching cells meet.
A pair of blocks is compared tile by tile: dot products over the leading dimensions first, plus the product
of the suffix norms as a bound for the rest; pairs whose bound cannot reach the threshold are dropped after
8, 16, 32, ... dimensions, and the rest is confirmed by the cosine of the vectors as given, in double precision.

Equal vectors are one class from the start, and of each block pair's links only counts and a spanning forest leave the
task, so no group is expanded into all pairs.

Defined cases: vectors that are null, zero, or hold null or non-finite components, a null label, or a null
id link with nothing; vectors of different lengths link with nothing in common; rows that repeat count one by
one; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .graph import components

#: Slack for the rounding of turned vectors; whatever is closer to the threshold is confirmed exactly.
SLACK = 1e-9
TILE = 512


def unit_rows(flat: np.ndarray, dim: int) -> np.ndarray:
    """Rows of length one, in double precision; scaled first so that no square overflows."""
    x = flat.reshape(-1, dim).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows as given, in double precision."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def rotation_of(classes: DataFrame, dim: int) -> np.ndarray:
    """Orthogonal axes of the unit vectors' second moments, largest first; sums are made in Spark, dim x dim numbers come back."""

    def partial(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            u = unit_rows(batch.column("vector").flatten().to_numpy(zero_copy_only=False), dim)
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    parts = classes.filter(F.col("dim") == dim).select("vector").mapInArrow(partial, "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    moment = np.zeros((dim, dim))
    for r in sums:
        moment[r["i"], r["j"]] = r["v"]
    return np.linalg.eigh((moment + moment.T) / 2)[1][:, ::-1].copy()


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool):
    """Index pairs (i, j) of turned unit rows whose dot product may reach the threshold; of the same block, i < j."""
    dim, reach = a.shape[1], np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    cuts = [c for c in (8, 16, 32, 64, 128, 256, 512, 1024) if c < dim] + [dim]
    tails = lambda m: [np.sqrt((m[:, c:] ** 2).sum(axis=1)) for c in cuts]
    tail_a, tail_b = tails(a), tails(b)
    order_a, order_b = np.argsort(a[:, 0], kind="stable"), np.argsort(b[:, 0], kind="stable")
    lead_b = b[order_b, 0]
    for begin in range(0, len(a), TILE):
        rows = order_a[begin : begin + TILE]
        low, high = np.searchsorted(lead_b, [a[rows[0], 0] - reach, a[rows[-1], 0] + reach], side="left")
        for start in range(low, high, 8 * TILE):
            cols = order_b[start : min(high, start + 8 * TILE)]
            dots = a[rows, : cuts[0]] @ b[cols, : cuts[0]].T
            i, j = np.nonzero(dots + np.outer(tail_a[0][rows], tail_b[0][cols]) >= threshold - SLACK)
            dot, i, j = dots[i, j], rows[i], cols[j]
            if same:
                keep = i < j
                dot, i, j = dot[keep], i[keep], j[keep]
            for k in range(1, len(cuts)):
                dot = dot + np.einsum("nd,nd->n", a[i, cuts[k - 1] : cuts[k]], b[j, cuts[k - 1] : cuts[k]])
                keep = dot + tail_a[k][i] * tail_b[k][j] >= threshold - SLACK
                dot, i, j = dot[keep], i[keep], j[keep]
            yield i, j


def join_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels (smallest index) after the links (i, j) are added."""
    while len(i):
        a, b = labels[i], labels[j]
        differ = a != b
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]
    return labels


def compare_blocks(table: pa.Table, rotation: np.ndarray, threshold: float) -> pa.Table:
    """The links of one pair of blocks (side 0 and side 1, or side 0 alone): per class the rows it links with, and its root."""
    side = table.column("side").to_numpy()
    vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(side), -1)
    copies = table.column("copies").to_numpy()
    turned = unit_rows(vectors, vectors.shape[1]) @ rotation
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    same = not len(right)
    right = left if same else right
    labels, links = np.arange(len(side)), np.zeros(len(side))
    for i, j in close_pairs(turned[left], turned[right], threshold, same):
        i, j = left[i], right[j]
        near = exact_cosine(vectors[i], vectors[j]) >= threshold if len(i) else np.zeros(0, bool)
        i, j = i[near], j[near]
        links += np.bincount(i, copies[j], len(side)) + np.bincount(j, copies[i], len(side))
        labels = join_labels(labels, i, j)
    found = np.flatnonzero(links)
    ids = table.column("rep")
    return pa.table({"rep": ids.take(pa.array(found)), "root": ids.take(pa.array(labels[found])), "links": links[found].astype(np.int64)})


def block_table(cells: DataFrame) -> DataFrame:
    """Pairs of blocks that have to meet: of cells (label, dim, c1, c2, blocks), each with itself and half its neighbours."""
    offsets = F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x, y in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    moved = cells.select("label", "dim", "c1", "c2", "blocks", F.explode(offsets).alias("o"))
    moved = moved.select("label", "dim", "c1", "c2", "blocks", (F.col("c1") + F.col("o.dx")).alias("d1"), (F.col("c2") + F.col("o.dy")).alias("d2"))
    other = cells.select("label", "dim", F.col("c1").alias("d1"), F.col("c2").alias("d2"), F.col("blocks").alias("others"))
    pairs = moved.join(other, ["label", "dim", "d1", "d2"])
    pairs = pairs.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("t", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    pairs = pairs.filter("not (c1 = d1 and c2 = d2 and s > t)")
    return pairs.withColumn("meeting", F.xxhash64("label", "dim", "c1", "c2", "d1", "d2", "s", "t"))


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = 4096) -> DataFrame:
    """One row per vector: id_col, n_links, component_id and kept."""
    spark = vectors.sparkSession
    v = F.col(f"`{vector_col}`")
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), v.alias("vector"), F.xxhash64(v).alias("h1"), F.xxhash64(F.lit("v"), v).alias("h2"), (F.coalesce(sound, F.lit(False)) & F.col("id").isNotNull() & F.col("label").isNotNull()).alias("sound"))
    classes = rows.filter("sound").groupBy("label", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    classes = materialise(classes.withColumn("dim", F.size("vector")), "vectors")
    dims = sorted(r[0] for r in classes.select("dim").distinct().collect())
    if not dims:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    axes = {d: rotation_of(classes, d) for d in dims}
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 2 * SLACK or 1.0

    def leads(batches):
        for batch in batches:
            flat, c1, c2 = batch.column("vector"), np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            dim = batch.column("dim").to_numpy()
            for d in np.unique(dim):
                own = np.flatnonzero(dim == d)
                u = unit_rows(flat.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False), d)
                lead = np.floor(u @ axes[int(d)][:, : min(2, d)] / width).astype(np.int32)
                c1[own], c2[own] = lead[:, 0], lead[:, -1] if d > 1 else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c1), pa.array(c2)], names=[*batch.schema.names, "c1", "c2"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    placed = classes.mapInArrow(leads, f"{types}, c1 int, c2 int")
    placed = materialise(placed, "placed")
    cells = placed.groupBy("label", "dim", "c1", "c2").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    meetings = materialise(block_table(cells), "meetings")
    dealt = placed.join(cells, ["label", "dim", "c1", "c2"]).withColumn("s", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    first = dealt.join(meetings.select("label", "dim", "c1", "c2", "s", "meeting"), ["label", "dim", "c1", "c2", "s"]).withColumn("side", F.lit(0))
    second = meetings.filter("not (c1 = d1 and c2 = d2 and s = t)").select("label", "dim", F.col("d1").alias("c1"), F.col("d2").alias("c2"), F.col("t").alias("s"), "meeting")
    second = dealt.join(second, ["label", "dim", "c1", "c2", "s"]).withColumn("side", F.lit(1))
    sides = [x.select("meeting", "dim", "side", "rep", "copies", "vector") for x in (first, second)]
    id_type = classes.schema["rep"].dataType.simpleString()
    met = sides[0].unionByName(sides[1]).groupBy("meeting", "dim").applyInArrow(
        lambda key, table: compare_blocks(table, axes[key[1].as_py()], threshold), f"rep {id_type}, root {id_type}, links long"
    )
    met = materialise(met, "met")
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = components(met.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = links.join(parts.withColumnRenamed("node", "rep"), "rep", "full")
    by_class = classes.select("label", "h1", "h2", "rep", "copies").join(linked, "rep", "left")
    out = rows.withColumn("key", F.when(F.col("sound"), F.col("label"))).drop("label", "vector").join(by_class, (F.col("key") == F.col("label")) & (rows["h1"] == by_class["h1"]) & (rows["h2"] == by_class["h2"]), "left")
    component = F.coalesce("component", "rep", "id")
    result = out.select(F.col("id").alias(id_col), (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"), component.alias("component_id"))
    return result.withColumn("kept", F.col(f"`{id_col}`").eqNullSafe(F.col("component_id")))
