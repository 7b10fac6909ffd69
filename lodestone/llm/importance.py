"""Operator 11, target-distribution importance resampling over bucket-partitioned inverted postings.

Features are runs of 1 to 3 words, hashed to buckets. Tasks turn slices of documents into postings, (bucket, document, count)
sorted by bucket and cut into ranges of buckets: one row a slice and range, counts added up within the slice. The postings are a
table in the shared folder. Both corpora's counts meet bucket by bucket, where the gain is worked out; gains are gathered
by range of buckets. Then postings are shuffled by (range, salt) to the gains of their range, each task emits what its buckets
contribute to each document of a slice, and contributions are reduced by document. The salt deals a range's slices to as many groups as it
takes for BLOCKS slices each, so neither a frequent bucket nor the size of the corpus makes a group large.

The draw is Gumbel top-k: weight plus noise by a hash of the id. Ranks come from a range partitioning by score, each
partition's first rank being the sum of the partitions before it.

Defined cases: a null or empty text has no features, weight 0, and still a score; a null id hashes as an empty one and comes
after the others of its score; rows that repeat are weighted and drawn one by one; an empty target or corpus has no counts; an empty table gives an
empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, materialise
from .token_shards import slices

BUCKETS = 10_000
#: Buckets in one row of postings.
RANGE = 625
#: Slices that meet the gains of a range in one group.
BLOCKS = 64
#: Bytes of text in a slice, and the most texts in it.
SLICE, TEXTS = 1_000_000, 30_000
#: The most that one posting counts; of more there are several.
MOST = 255
#: Words whose runs are hashed at a time.
WORDS = 100_000
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: Partitions whose totals (16 bytes each) may be broadcast.
BROADCAST_PARTITIONS = 200_000


@lru_cache(maxsize=1)
def crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The CRC of each byte, and the effect on a CRC of n further bytes of zero: shift[n] has four tables, one for each byte of the CRC."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    shift = np.empty((LONG_WORD + 1, 4, 256), np.uint32)
    for k in range(4):
        shift[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, LONG_WORD + 1):
        shift[n] = step[shift[n - 1] & 0xFF] ^ shift[n - 1] >> np.uint32(8)
    return step, shift


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end in lower-cased bytes: digits, a-z and all bytes beyond ASCII."""
    inside = (raw >= 0x80) | (raw >= 0x61) & (raw <= 0x7A) | (raw >= 0x30) & (raw <= 0x39)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


class Words:
    """The words of many texts, with their CRCs, from which those of runs of words follow."""

    def __init__(self, texts: pa.Array):
        """texts: strings, of which no word may run into the next text's."""
        texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        body = texts.buffers()[2]
        own = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
        gaps = np.arange(len(texts))  # a space behind every text
        raw = np.full(len(own) + len(texts), 0x20, np.uint8)
        raw[np.arange(len(own)) + np.repeat(gaps, np.diff(offsets))] = own
        raw[(raw >= 0x41) & (raw <= 0x5A)] += 0x20
        self.raw, (self.begin, self.end) = raw, words_of(raw)
        self.text = np.searchsorted(offsets[1:] - offsets[0] + gaps, self.begin, side="right").astype(np.int64)
        self.crc = self._crc()

    def _crc(self) -> np.ndarray:
        step, _ = crc_tables()
        size = self.end - self.begin
        order = np.argsort(-size, kind="stable")
        begin, size = self.begin[order], size[order]
        crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
        long = int(np.searchsorted(-size, -LONG_WORD, side="left"))  # words of more bytes
        for k in range(min(LONG_WORD, int(size[0]) if len(size) else 0)):
            n = int(np.searchsorted(-size, -k, side="left"))
            crc[long:n] = step[(crc[long:n] ^ self.raw[begin[long:n] + k]) & 0xFF] ^ crc[long:n] >> np.uint32(8)
        crc = ~crc
        for i in range(long):
            crc[i] = crc32(self.raw[begin[i] : begin[i] + size[i]])
        out = np.empty_like(crc)
        out[order] = crc
        return out

    def followed(self, crc: np.ndarray, word: np.ndarray) -> np.ndarray:
        """CRCs of strings with these CRCs, a space and these words."""
        step, shift = crc_tables()
        crc = ~crc
        crc = ~(step[(crc ^ 0x20) & 0xFF] ^ crc >> np.uint32(8))
        size = self.end[word] - self.begin[word]
        n = np.minimum(size, LONG_WORD)
        moved = shift[n, 0, crc & 0xFF] ^ shift[n, 1, crc >> 8 & 0xFF] ^ shift[n, 2, crc >> 16 & 0xFF] ^ shift[n, 3, crc >> 24]
        out = moved ^ self.crc[word]
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            out[i] = crc32(self.raw[self.begin[word[i]] : self.end[word[i]]], int(crc[i]))
        return out

    def postings(self, buckets: int, runs: int = 3) -> tuple[np.ndarray, np.ndarray]:
        """bucket * number of texts + text, ascending, and how often each occurs."""
        texts = int(self.text[-1]) + 1 if len(self.text) else 1
        keys, counts = [], []
        for first in range(0, len(self.begin), WORDS):
            word = np.arange(first, min(first + WORDS, len(self.begin)))
            crc, found = self.crc[word], []
            for more in range(runs):
                if more:
                    stay = (word + more < len(self.begin)) & (self.text[np.minimum(word + more, len(self.begin) - 1)] == self.text[word])
                    word, crc = word[stay], crc[stay]
                    crc = self.followed(crc, word + more)
                found.append((crc % np.uint32(buckets)).astype(np.int64) * texts + self.text[word])
            key, n = np.unique(np.concatenate(found), return_counts=True)
            keys.append(key)
            counts.append(n)
        if not keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, where, np.concatenate(counts))
        return key, total


def write_postings(texts: DataFrame, buckets: int = BUCKETS, width: int = RANGE) -> DataFrame:
    """The postings table of (id, text): block, part, sizes (postings of each bucket of the range), docs (2 bytes each), counts (1 byte each); and one row a block with part -1: ids, n_words."""
    id_type = texts.schema["id"].dataType.simpleString()
    schema = f"block long, part int, sizes array<int>, docs binary, counts binary, ids array<{id_type}>, n_words array<long>"
    parts = -(-buckets // width)

    def lists(ends: np.ndarray, values: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    def cut(ends: np.ndarray, values: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for some in slices(batch, "text", SLICE):
                for at in range(0, some.num_rows, TEXTS):
                    piece = some.slice(at, TEXTS)
                    words = Words(piece.column("text"))
                    key, n = words.postings(buckets)
                    texts_in = int(words.text[-1]) + 1 if len(words.text) else 1
                    times = -(-n // MOST)
                    key, last, n = np.repeat(key, times), np.cumsum(times) - 1, np.repeat(n - MOST * (times - 1), times)
                    n[np.isin(np.arange(len(n)), last, invert=True)] = MOST
                    bucket = key // texts_in
                    sizes = np.bincount(bucket, minlength=parts * width)
                    ends = np.append(0, np.cumsum(sizes.reshape(parts, width).sum(axis=1)))
                    n_words = np.bincount(words.text, minlength=piece.num_rows)
                    ids = piece.column("id")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(parts + 1, block)),
                            pa.array(np.arange(-1, parts), pa.int32()),
                            lists(np.append(0, np.arange(parts + 1) * width), pa.array(sizes, pa.int32())),
                            cut(np.append(0, ends * 2), (key - bucket * texts_in).astype("<u2")),
                            cut(np.append(0, ends), n.astype(np.uint8)),
                            lists(np.append(0, np.full(parts + 1, len(ids))), ids),
                            lists(np.append(0, np.full(parts + 1, len(ids))), pa.array(n_words, pa.int64())),
                        ],
                        names=["block", "part", "sizes", "docs", "counts", "ids", "n_words"],
                    )
                    block += 1

    return materialise(map_arrow(texts, run, schema), "postings")


def bucket_counts(postings: DataFrame, width: int = RANGE) -> DataFrame:
    """bucket, n: features in each bucket; a task adds up its postings first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in enumerate(batch.column("part").to_pylist()):
                sizes, counts = batch.column("sizes")[i].values.to_numpy(), np.frombuffer(batch.column("counts")[i].as_py(), np.uint8)
                running = np.append(0, np.cumsum(counts, dtype=np.int64))
                ends = np.cumsum(sizes, dtype=np.int64)
                total[part] = total.get(part, 0) + running[ends] - running[ends - sizes]
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.int64()))], names=["part", "sums"])

    sums = map_arrow(postings.filter("part >= 0").select("part", "sizes", "counts"), run, "part int, sums array<long>")
    return sums.select("part", F.posexplode("sums").alias("at", "n")).filter("n > 0").groupBy((F.col("part") * width + F.col("at")).alias("bucket")).agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain: floor(1000 * ln of the target's smoothed share over the source's), for buckets that the source holds.

    source and target are (bucket, n), at most one row a bucket; they are joined bucket by bucket.
    """
    all_s, all_t = (x.agg(F.sum("n")).first()[0] or 0 for x in (source, target))
    both = source.select("bucket", F.col("n").alias("s")).join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
    s, t = (F.coalesce(c, F.lit(0)) + 1 for c in ("s", "t"))
    ratio = t.cast("double") * float(all_s + buckets) / (s.cast("double") * float(all_t + buckets))
    return both.select("bucket", F.floor(1000.0 * F.ln(ratio)).cast("long").alias("gain"))


def weigh(postings: DataFrame, gains: DataFrame, width: int = RANGE) -> DataFrame:
    """id, n_words, weight of every row: gains summed over its features."""
    by_part = gains.groupBy(F.floor(F.col("bucket") / width).cast("int").alias("part")).agg(F.map_from_entries(F.collect_list(F.struct((F.col("bucket") % width).cast("int"), "gain"))).alias("by"))
    dense = by_part.select("part", F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at("by", i), F.lit(0).cast("long"))).alias("gains"))
    rows = postings.filter("part >= 0")
    salts = max(1, -(-postings.filter("part < 0").count() // BLOCKS))
    salted = rows.select("block", "part", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"), "sizes", "docs", "counts")
    dealt = dense.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def contribute(blocks: pa.Table, own: pa.Table) -> pa.Table:
        """What a group's postings give to the documents of each slice."""
        found = []
        for gain in own.column("gains"):  # one row, the range's
            for block, sizes, docs, counts in zip(*(blocks.column(c) for c in ("block", "sizes", "docs", "counts")), strict=True):
                each = np.repeat(gain.values.to_numpy(), sizes.values.to_numpy()) * np.frombuffer(counts.as_py(), np.uint8)
                doc = np.frombuffer(docs.as_py(), "<u2")
                order = np.argsort(doc, kind="stable")
                doc, first = np.unique(doc[order], return_index=True)
                weight = np.add.reduceat(each[order], first) if len(doc) else np.zeros(0, np.int64)
                found.append(pa.table({"block": np.full(len(doc), block.as_py()), "doc": doc.astype(np.int32), "weight": weight}))
        return pa.concat_tables(found) if found else pa.table({"block": pa.array([], pa.int64()), "doc": pa.array([], pa.int32()), "weight": pa.array([], pa.int64())})

    given = salted.groupBy("part", "salt").cogroup(dealt.groupBy("part", "salt")).applyInArrow(contribute, "block long, doc int, weight long")
    heads = postings.filter("part < 0").select("block", F.posexplode(F.arrays_zip("ids", "n_words")).alias("doc", "of"))
    heads = heads.select("block", "doc", F.lit(0).cast("long").alias("weight"), F.col("of.ids").alias("id"), F.col("of.n_words").alias("n_words"))
    both = heads.unionByName(given, allowMissingColumns=True)
    return both.groupBy("block", "doc").agg(F.max("id").alias("id"), F.max("n_words").alias("n_words"), F.sum("weight").alias("weight")).drop("block", "doc")


def ranked(rows: DataFrame, order: list, name: str) -> DataFrame:
    """rows with their place (1, 2, ...) in the order, whatever their number."""
    part = f"{name}_part"
    dealt = materialise(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranked")
    totals = dealt.groupBy(part).agg(F.count("*").alias("n"))
    before = totals.select(part, (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias("before"))
    if totals.count() <= BROADCAST_PARTITIONS:
        before = F.broadcast(before)
    return dealt.withColumn(name, F.row_number().over(Window.partitionBy(part).orderBy(*order))).join(before, part).withColumn(name, F.col(name) + F.col("before")).drop(part, "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Every row of docs: id_col, n_words, n_features, weight, score, and rank among the drawn (else null).

    Drawn are the floor(percent * N / 100) highest scores of the N rows with at least min_words words.
    """
    postings = write_postings(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), buckets)
    wanted = write_postings(target.select(F.lit(None).cast("int").alias("id"), F.col(f"`{target_text}`").alias("text")), buckets)
    source, wanted = (materialise(bucket_counts(p), "bucket-counts") for p in (postings, wanted))
    gains = materialise(bucket_gains(source, wanted, buckets), "gains")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")
    n = F.col("n_words")
    scored = weigh(postings, gains).select("id", "n_words", (n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))).alias("n_features"), "weight", (F.col("weight") + noise).alias("score"))
    scored = materialise(scored, "scored")
    fit = F.col("n_words") >= min_words
    drawn = scored.filter(fit).count() * percent // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc()]
    places = ranked(scored.filter(fit), order, "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    out = places.unionByName(scored.filter(~fit).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")
