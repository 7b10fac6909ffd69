"""Operator 9, MinHash near-dedup: a multi-index Hamming join of b-bit signatures, confirmed on full sets.

A document's set of word shingles gives a signature of 64 values of 16 bits. All pairs are found whose
signatures differ in at most 31 values: cut into 16 chunks of 4 values, such a pair has a chunk with at most
one differing value (pigeonhole), so each chunk is indexed four times, each time with one value left out, and
the pair meets in one of these 64 buckets. A pair of documents at similarity 0.75 has more than 31 differing
values with probability below 2e-5, a more similar one with less. A bucket's key is one long: its number and the
chunk's three other values.

Buckets are never expanded into all pairs. Documents with equal sets are one class from the start. Keys are
counted first, and only rows of shared buckets go on. Each bucket's members are held against three pivots of the
bucket, confirmed links give components, and only
buckets with members of several components are looked at again: members that hold too many shingles that no
other remaining document has can link with nothing, and the others are compared across components, block by
block, under bounds on the intersection. So no link between components is lost, and links inside one need not be listed.

Classes are numbered; numbers, keys and pairs are what is shuffled, and signatures and sets are fetched for those
that need them. Every intermediate table is in the shared folder and is removed when its last reader is done.

Defined cases: a null or empty text, or one of white space, has an empty set and links with nothing; fewer
words than a shingle make one shingle; rows with a null id link with nothing and are kept; rows that repeat
have the same component, and each of them is kept if its id is the component's; rows that share an id but not a text
are judged one by one; an empty table gives an empty table; input columns that have the name of a result column
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_table, inner, materialise, reread, small_batches, without
from .graph import components

VALUES, CHUNKS, MAX_DIFFERENT = 64, 16, 31
#: Rows of ids or keys that may be broadcast (some 40 bytes each); beyond that the join is a plain one.
BROADCAST_ROWS = 500_000
#: Classes whose bucket keys one task makes (64 rows each).
CLASSES_A_TASK = 8_192
NEW = ("n_shingles", "component_id", "kept")
ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of the words met so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; words are split at ASCII white space, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        out = mixed(out + h[j : len(h) - width + 1 + j]) * ODD
    return np.unique(out)


def multipliers() -> np.ndarray:
    return mixed(np.arange(1, VALUES + 1, dtype=np.uint64) * ODD) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """64 values of 16 bits: a hash of the least product under each multiplier."""
    factors, least = multipliers()[:, None], None
    for part in range(0, len(shingles), 4096):
        m = (shingles[None, part : part + 4096] * factors).min(axis=1)
        least = m if least is None else np.minimum(least, m)
    return (mixed(least) >> np.uint64(48)).astype("<u2")


def set_rows(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """(id, version, text) in; (id, version, n, f1, f2: a fingerprint of the set, signature: 16 longs or null) out."""
    hashes = WordHashes()
    for whole in batches:
        for batch in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
            n, f, signatures = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), shingle, hashes)
                n.append(len(s))
                f.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8"))
                signatures.append(signature(s).view("<i8") if len(s) else None)
            f = np.array(f).reshape(-1, 2)
            columns = [batch.column("id"), batch.column("version"), pa.array(n, pa.int64()), pa.array(f[:, 0]), pa.array(f[:, 1]), pa.array(signatures, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "version", "n", "f1", "f2", "signature"])


def different_values(a: Column, b: Column) -> Column:
    """How many of the 16-bit values of two signatures (arrays of longs) differ."""

    def lanes(x: Column) -> Column:
        for shift in (8, 4, 2, 1):  # the lowest bit of each 16 becomes the "or" of them all
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        return F.bit_count(x.bitwiseAND(F.lit(0x0001000100010001))).cast("int")

    return F.aggregate(F.zip_with(a, b, lambda p, q: p.bitwiseXOR(q)), F.lit(0), lambda acc, v: acc + lanes(v))


def bucket_keys(classes: DataFrame) -> DataFrame:
    """64 rows (c, key) a class: which chunk and which value of it is left out (above bit 48), and the chunk's other values."""
    chunk = classes.select("c", F.posexplode("signature").alias("chunk", "v"))

    def key(out: int) -> Column:
        low = F.col("v").bitwiseAND(F.lit((1 << 16 * out) - 1))
        rest = F.shiftleft(F.shiftrightunsigned("v", 16 * out + 16), 16 * out).bitwiseOR(low) if out < 3 else low
        return F.shiftleft(F.col("chunk").cast("long") * 4 + out, 48).bitwiseOR(rest)

    return chunk.select("c", F.explode(F.array(*[key(i) for i in range(4)])).alias("key"))


def if_small(df: DataFrame) -> DataFrame:
    """The table, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class NearLinks:
    """The documents' classes, and confirmation of pairs of classes."""

    def __init__(self, docs: DataFrame, percent: int, shingle: int):
        self.docs, self.percent, self.shingle = docs, percent, shingle
        small_batches(docs.sparkSession)
        self.id_type, self.temporary = docs.schema["id"].dataType.simpleString(), []
        schema = f"id {self.id_type}, version long, n long, f1 long, f2 long, signature array<long>"
        self.rows = materialise(docs.mapInArrow(lambda b: set_rows(b, shingle), schema), "sets")
        whole = self.rows.filter("n > 0 and id is not null")
        classes = whole.groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("signature").alias("signature"))
        self.classes = materialise(classes.withColumn("c", F.monotonically_increasing_id()), "classes")

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """A table that stays until clear()."""
        out, path = reread(df, name)
        self.temporary.append(path)
        return out

    def clear(self) -> None:
        for path in self.temporary:
            drop_table(self.docs.sparkSession, path)
        self.temporary.clear()

    def shingles(self, numbers: DataFrame) -> DataFrame:
        """(c, shingles) of the classes with these numbers (column c). Documents that repeat may give a class in several partitions."""
        size = self.shingle
        wanted = self.table(self.classes.join(numbers.select("c").distinct(), "c", "left_semi").select(F.col("rep").alias("id"), "c", "f1", "f2"), "wanted")

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes, seen = WordHashes(), set()
            for whole in batches:
                for batch in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                    found, own = [], []
                    for c, f1, f2, text in zip(*(batch.column(x) for x in ("c", "f1", "f2", "text")), strict=True):
                        if c.as_py() in seen:
                            continue
                        s = shingle_set(text.as_py(), size, hashes)
                        if tuple(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8").tolist()) == (f1.as_py(), f2.as_py()):
                            seen.add(c.as_py())
                            found.append(c.as_py())
                            own.append(s.view(np.int64))
                    offsets = pa.array(np.append(0, np.cumsum([len(s) for s in own])), pa.int32())
                    flat = pa.array(np.concatenate(own) if own else np.empty(0, np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.ListArray.from_arrays(offsets, flat)], names=["c", "shingles"])

        return self.docs.select("id", "text").join(if_small(wanted), "id").select("c", "f1", "f2", "text").mapInArrow(sets, "c long, shingles array<long>")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (a, b) of classes, those whose signatures are near and whose full sets are similar enough.

        No join here is followed by an aggregation on its key, so adaptive execution can split a pivot's many pairs.
        """
        side = lambda s: self.classes.select(F.col("c").alias(s), F.col("n").alias(f"n_{s}"), F.col("signature").alias(f"s_{s}"))
        near = pairs.join(side("a"), "a").join(side("b"), "b")
        sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent
        near = self.table(near.filter(sizes & (different_values(F.col("s_a"), F.col("s_b")) <= MAX_DIFFERENT)).select("a", "b"), "near")
        sets = self.table(self.shingles(near.select(F.col("a").alias("c")).unionByName(near.select(F.col("b").alias("c")))), "shingles")
        side = lambda s: sets.select(F.col("c").alias(s), F.col("shingles").alias(f"x_{s}"))
        both = near.join(side("a"), "a").join(side("b"), "b")
        shared = F.size(F.array_intersect("x_a", "x_b"))
        return both.filter(shared * 100 >= (F.size("x_a") + F.size("x_b") - shared) * self.percent).select("a", "b")


def linked_classes(links: NearLinks) -> DataFrame:
    """(node, component) of the classes that link with another one; both are numbers of classes."""
    spread = max(1, links.classes.count() // CLASSES_A_TASK)
    keys = bucket_keys(links.classes.select("c", "signature").repartition(spread, "c"))
    common = links.table(keys.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1").select("key"), "keys")
    shared = links.table(keys.join(if_small(common), "key", "left_semi"), "buckets")
    order = F.xxhash64("c")
    pivots = links.table(shared.groupBy("key").agg(F.array(F.min("c"), F.min_by("c", order), F.max_by("c", order)).alias("pivots")), "pivots")
    stars = shared.join(pivots, "key").select("c", F.explode(F.array_distinct("pivots")).alias("p")).filter("c <> p")
    stars = stars.select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()
    edges = links.table(links.confirmed(stars), "links")
    first = components(edges)

    labelled = shared.join(first.select(F.col("node").alias("c"), "component"), "c", "left").select("key", "c", F.coalesce("component", "c").alias("component"))
    labelled = links.table(labelled, "labelled")
    mixed_buckets = links.table(labelled.groupBy("key").agg(F.min("component").alias("one"), F.max("component").alias("other")).filter("one < other").select("key"), "mixed")
    open_ = links.table(labelled.join(if_small(mixed_buckets), "key", "left_semi"), "open")

    # Shingles that no other class in an open bucket has can be in no intersection.
    sets = links.table(links.shingles(open_), "shingles")
    alone = sets.select("c", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("times"), F.min("c").alias("c")).filter("times = 1").groupBy("c").agg(F.count("*").alias("alone"))
    able = sets.select("c", F.size("shingles").alias("n")).distinct().join(alone, "c", "left").select("c", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common"))
    able = links.table(able.filter(F.col("common") * 100 >= F.col("n") * links.percent), "able")
    members = links.table(open_.join(able, "c"), "members")
    return components(edges.unionByName(links_across(links, members)))


def bucket_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by group, cut so that no group's rows are parted."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        key = held.column("group").to_numpy()
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


def candidates(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of one bucket that are of several components and may be similar enough, each pair in one bucket alone.

    A pair that meets in several buckets is looked at in the one of its first chunk with at most one differing value.
    """
    column = lambda c: table.column(c).to_numpy()
    key, n, common, side, tag, component, one_block = (column(c) for c in ("group", "n", "common", "side", "tag", "component", "one_block"))
    values = np.stack([np.asarray(x, "<i8") for x in table.column("signature").to_numpy()]).view("<u2")
    end = np.searchsorted(key, key, side="right")
    i = np.arange(len(key))
    for step in range(1, len(key)):
        i = i[i + step < end[i]]
        if not len(i):
            return
        j = i + step
        most = np.minimum(common[i], common[j])
        fits = (component[i] != component[j]) & (one_block[i] | (side[i] != side[j])) & (most * 100 >= (n[i] + n[j] - most) * percent)
        a, b = i[fits], j[fits]
        if len(a):
            differ = (values[a] != values[b]).reshape(len(a), CHUNKS, 4)
            few = differ.sum(axis=2) <= 1
            chunk = few.argmax(axis=1)
            out = differ[np.arange(len(a)), chunk].argmax(axis=1)
            own = (differ.sum(axis=(1, 2)) <= MAX_DIFFERENT) & (chunk * 4 + out == tag[a])
            yield a[own], b[own]


def links_across(links: NearLinks, members: DataFrame, block: int = 2048) -> DataFrame:
    """Links (a, b) between members (key, c, component, n, common) of one bucket but of several components.

    Buckets over the block size are split, and each pair of blocks is a group of its own. A first pass keeps the rows
    that have a candidate; only these are given their full sets, and a second pass confirms.
    """
    percent = links.percent
    large = links.table(members.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1"), "large")
    rows = members.join(if_small(large), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).join(links.classes.select("c", "signature"), "c")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("group"), (F.col("own") == F.col("other")).alias("one_block"), F.col("own").alias("side"),
        F.shiftright("key", 48).cast("int").alias("tag"), "c", F.col("n").cast("long").alias("n"), F.col("common").cast("long").alias("common"), "component", "signature",
    )
    by_group = lambda df: df.repartition("group").sortWithinPartitions("group", "c")

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in bucket_runs(batches):
            stay = np.zeros(table.num_rows, bool)
            for i, j in candidates(table, percent):
                stay[i] = stay[j] = True
            yield from table.filter(pa.array(stay)).to_batches()

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in bucket_runs(batches):
            sets, c = table.column("shingles").to_numpy(), table.column("c").to_numpy()
            found = []
            for i, j in candidates(table, percent):
                for a, b in zip(i.tolist(), j.tolist(), strict=True):
                    shared = np.intersect1d(sets[a], sets[b], assume_unique=True).size
                    if shared * 100 >= (len(sets[a]) + len(sets[b]) - shared) * percent:
                        found.append((min(c[a], c[b]), max(c[a], c[b])))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    kept = links.table(by_group(rows).mapInArrow(promising, rows.schema), "promising")
    with_sets = kept.join(links.table(links.shingles(kept), "shingles"), "c")
    return by_group(with_sets).mapInArrow(confirmed, "a long, b long").distinct()


def judged_rows(docs: DataFrame, id_col: str, text_col: str, percent: int, shingle: int) -> DataFrame:
    """(id, version: a hash of the text, n, node: the number of the row's component, component_id) of every row."""
    text = F.col(f"`{text_col}`")
    links = NearLinks(docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("version"), text.alias("text")), percent, shingle)
    nodes = linked_classes(links)
    placed = links.classes.select("f1", "f2", "c", "rep").join(nodes.withColumnRenamed("node", "c"), "c", "left").withColumn("node", F.coalesce("component", "c")).drop("component", "c")
    placed = links.table(placed, "placed")
    least = placed.groupBy("node").agg(F.min("rep").alias("component_id"))
    named = materialise(placed.join(least, "node").drop("rep"), "named")
    links.clear()
    rows = links.rows.select("id", "version", "n", "f1", "f2").join(named, ["f1", "f2"], "left")
    linked = (F.col("n") > 0) & F.col("id").isNotNull()
    return rows.select("id", "version", "n", F.when(linked, F.col("node")).alias("node"), F.when(linked, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, shingle: int = 5) -> DataFrame:
    """Per row of docs: id_col, n_shingles, component_id (smallest id reachable over links) and kept."""
    rows = judged_rows(docs, id_col, text_col, percent, shingle)
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, shingle: int = 5) -> DataFrame:
    """One document of each component, one with its smallest id; of other rows that repeat whole (id and text), one; rows with a null id all stay."""
    at = inner(docs)
    rows = judged_rows(docs, id_col, text_col, percent, shingle).filter("id is not null and id = component_id")
    chosen = rows.groupBy("id", "node", F.when(F.col("node").isNull(), F.col("version")).alias("empty")).agg(F.min("version").alias("version"))
    chosen = chosen.select(F.col("id").alias(f"{at}id"), F.col("version").alias(f"{at}version"))
    version = F.xxhash64(F.col(f"`{text_col}`"))
    marked = docs.withColumn(f"{at}of", version)
    kept = marked.join(chosen, (F.col(f"`{id_col}`") == F.col(f"{at}id")) & (F.col(f"{at}of") == F.col(f"{at}version")), "left_semi")
    return kept.dropDuplicates([id_col, f"{at}of"]).unionByName(marked.filter(F.col(f"`{id_col}`").isNull())).select(*without(docs))
