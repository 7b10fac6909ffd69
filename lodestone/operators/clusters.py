"""Provenance clusters of evidence: articles that repeat each other, or one primary record, count as one.

The rule takes a group's articles in order: each joins the first cluster with a member that is like it, or else founds a
cluster. Nothing of it needs the articles one by one: the cluster of an article is the smallest place in the order that
a chain of links to ever earlier articles reaches. So links are found by joins, and places are passed on in order by blocks of
links; a group may hold any share of all articles.

* Likeness is exact Jaccard similarity of token sets. Equal sets are one from the start. A set is filed under its rarest tokens, as
  many as two similar sets can't differ in all of; sets that share one of these, at places that leave enough in common, and whose
  signatures (parities of counts of hashed tokens) don't differ too much, are compared. Whole token sets travel for these alone.
* Of articles that are all linked with each other (equal sets, two similar sets, one primary record), each is linked with the one before it
  alone, which reaches all earlier ones. Long runs are cut by place, so that no run is one task's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import written

#: Words that tell nothing of an article (fixed values).
STOPWORDS = (
    "about", "after", "also", "announced", "before", "being", "company", "could", "from", "have", "into", "more", "said", "shares", "stock", "that", "their",
    "there", "they", "this", "through", "today", "under", "which", "with", "would", "form", "filed", "filing", "report", "reports", "inc", "corp", "corporation",
)
#: Likeness in percent of all tokens and of the headline's (fixed values).
TEXT_PERCENT, HEADLINE_PERCENT = 70, 82
#: Source names, by authority; primary records have 3.0, or 2.2 when they give context alone, other sources 1.2, none 0.7 (fixed values).
AUTHORITY = ((2.2, ("reuters", "bloomberg", "dow jones", "associated press")), (2.0, ("company ir", "investor relations", "business wire", "globenewswire")))
#: Articles of a run that are put in order by one task.
RUN = 4096
#: Buckets of hashes in which tokens are counted, bits of a signature, a multiplier that mixes hashes, and links that one task follows at a time.
BUCKETS, BITS, ODD, BLOCK = 1 << 20, 1024, np.int64(-7046029254386353131), 1 << 18
#: Stands for a null position.
NOWHERE = -(2**62)


def tokens_of(text: Column) -> Column:
    """The distinct words of 3 or more letters and digits, lower-cased, without stop words; a null text has none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]{3,}"), F.lit(0))
    return F.array_except(words, F.array(*map(F.lit, STOPWORDS)))


def authority(source: Column, is_primary: Column, context_only: Column) -> Column:
    named = F.lower(F.coalesce(source, F.lit("")))
    value = F.when(is_primary, F.when(context_only, 2.2).otherwise(3.0))
    for points, names in AUTHORITY:
        value = value.when(named.rlike("|".join(names)), points)
    return value.when(named != "", 1.2).otherwise(0.7)


def set_key(tokens: Column) -> Column:
    """A set's name: two independent hashes of its sorted tokens; null for an empty set."""
    ordered = F.array_sort(tokens)
    return F.when(F.size(tokens) > 0, F.struct(F.xxhash64(ordered).alias("h1"), F.xxhash64(F.lit("set"), ordered).alias("h2")))


def outlines(sets: DataFrame, percent: int) -> DataFrame:
    """id, group, key, n, signature and the rarest tokens (as 32-bit names) of each different set, as a table of its own.

    Tokens are ordered by how often their bucket of hashes occurs, which stands for their own count: any order that is the same for all sets is exact.
    """
    spark = sets.sparkSession
    hashed = sets.select("group", "key", F.xxhash64("group").alias("salt"), F.transform("tokens", lambda t: F.xxhash64(t)).alias("hashes"))
    found = hashed.select(F.explode("hashes").alias("h")).groupBy((F.col("h").bitwiseAND(BUCKETS - 1)).alias("bucket")).agg(F.count("*").alias("df")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[found["bucket"].to_numpy()] = found["df"].to_numpy()
    shared = spark.sparkContext.broadcast(counts)

    def outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lists = part.column("hashes")
                n, flat = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().to_numpy()
                row = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((flat, shared.value[flat & (BUCKETS - 1)], row))
                place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
                spare = n - (n * percent + 99) // 100  # tokens that a similar set may lack
                rare = place <= spare[row]
                names = ((flat[order] ^ part.column("salt").to_numpy()[row]) * ODD >> 32).astype(np.int32)[rare]
                ends = np.concatenate([[0], np.cumsum(np.minimum(n, spare + 1))]).astype(np.int32)
                odd = np.bincount(row * BITS + (flat >> 24 & (BITS - 1)), minlength=len(n) * BITS).astype(np.uint8) & 1
                words = np.packbits(odd).view(np.int64)
                steps = np.arange(0, len(words) + 1, BITS // 64, dtype=np.int32)
                columns = [part.column("group"), part.column("key"), pa.array(n.astype(np.int32)), pa.ListArray.from_arrays(pa.array(steps), pa.array(words)), pa.ListArray.from_arrays(pa.array(ends), pa.array(names))]
                yield pa.RecordBatch.from_arrays(columns, names=["group", "key", "n", "signature", "names"])

    own = StructType([sets.schema["group"], sets.schema["key"], *StructType.fromDDL("n int, signature array<bigint>, names array<int>").fields])
    one = hashed.mapInArrow(outlined, own).dropDuplicates(["group", "key"])
    return written(one.withColumn("id", F.monotonically_increasing_id()), "outlines")


def similar_sets(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (group, a, b; a < b) of different sets (group, key, tokens without line breaks) with 100 * intersection >= percent * union."""
    one = outlines(sets, percent)
    filed = one.select("id", "n", F.posexplode("names").alias("at", "name"))
    other = filed.select("name", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"))
    # What two sets have in common at most if this is the first token that they share.
    most = F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b"))
    met = filed.join(other, "name").filter((F.col("id") < F.col("b")) & (100 * most >= percent * (F.col("n") + F.col("n_b") - most)))
    pairs = written(met.select(F.col("id").alias("a"), "b").distinct(), "candidate-sets")
    # Bits in which two signatures differ stand for different tokens that only one of the sets has.
    side = lambda c: one.select(F.col("id").alias(c), *[F.col(k).alias(f"{k}_{c}") for k in ("group", "key", "n", "signature")])
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter("group_a = group_b")
    apart = F.aggregate(F.zip_with("signature_a", "signature_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    close = both.filter((100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n_b")))
    close = written(close.select(F.col("group_a").alias("group"), F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b")), "close-sets")
    needed = written(close.select("group", F.explode(F.array("a", "b")).alias("key")).distinct(), "needed-sets")
    lines = sets.select("group", "key", F.array_join("tokens", "\n").alias("lines"))  # less than half of an array's bytes in a shuffle
    texts = written(lines.join(needed, ["group", "key"]).dropDuplicates(["group", "key"]), "sets")
    side = lambda c: texts.select("group", F.col("key").alias(c), F.col("lines").alias(f"lines_{c}"))
    both = close.join(side("a"), ["group", "a"]).join(side("b"), ["group", "b"])
    a, b = F.split("lines_a", "\n"), F.split("lines_b", "\n")
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return written(both.filter(100 * shared >= percent * union).select("group", "a", "b"), "similar-sets")


def predecessors(runs: DataFrame) -> DataFrame:
    """Links (group, later, earlier) from each row to the one before it in its run; runs: group, run, place (comparable)."""
    keys = ["group", "run"]
    dealt = runs.select(*keys, "place").distinct().withColumn("part", F.floor(F.col("place.position") / RUN))
    inside = F.lag("place").over(Window.partitionBy(*keys, "part").orderBy("place"))
    ends = dealt.groupBy(*keys, "part").agg(F.max("place").alias("last"))
    before = ends.select(*keys, "part", F.lag("last").over(Window.partitionBy(*keys).orderBy("part")).alias("carried"))
    linked = dealt.withColumn("earlier", inside).join(before, [*keys, "part"]).withColumn("earlier", F.coalesce("earlier", "carried"))
    return linked.filter("earlier is not null").select("group", F.col("place").alias("later"), "earlier")


def earliest_reached(links: DataFrame, name: str = "reached") -> DataFrame:
    """(group, place, root): the earliest place that each linked place reaches over links (group, later, earlier).

    Places are numbered in order and links cut into blocks by their later end. A task follows a block's links in order, through chains of
    any length. As links lead to the same or an earlier block, there are no more rounds than blocks, and one that finds nothing new.
    """
    links = written(links.distinct(), "links")
    ends = links.select("group", F.col("later").alias("place")).union(links.select("group", F.col("earlier").alias("place")))
    places = ends.distinct().repartitionByRange("group", "place").sortWithinPartitions("group", "place")
    places = written(places.withColumn("number", F.monotonically_increasing_id()), "places")
    numbered = links
    for end in ("later", "earlier"):
        numbered = numbered.join(places.select("group", F.col("place").alias(end), F.col("number").alias(f"{end}_number")), ["group", end])
    numbered = numbered.select("later_number", "earlier_number")
    blocks = max(1, -(-links.count() // BLOCK))
    numbered = written(numbered.repartitionByRange(blocks, "later_number").withColumn("block", F.spark_partition_id()), "numbered-links")
    state = places.select("number", F.col("number").alias("root"))
    while True:
        given = numbered.join(state.select(F.col("number").alias("earlier_number"), F.col("root").alias("of")), "earlier_number")
        passed = given.groupBy("block").applyInPandas(followed, "number long, reached long")
        step = state.join(passed, "number", "left").select("number", F.col("root").alias("old"), F.least("root", F.coalesce("reached", "root")).alias("root"))
        step = written(step, name)
        state = step.select("number", "root")
        if blocks == 1 or step.filter(F.col("root") < F.col("old")).isEmpty():
            break
    roots = places.select(F.col("number").alias("root_number"), F.col("place").alias("root"))
    named = places.join(state.withColumnRenamed("root", "root_number"), "number").join(roots, "root_number")
    return written(named.select("group", "place", "root"), name)


def followed(block: pd.DataFrame) -> pd.DataFrame:
    """number, reached: the least root of each later end in a block of links (later_number, earlier_number, of: the earlier end's root so far)."""
    block = block.sort_values("later_number")
    reached: dict[int, int] = {}
    for later, earlier, of in zip(block["later_number"].tolist(), block["earlier_number"].tolist(), block["of"].tolist(), strict=True):
        of = min(of, reached.get(earlier, of))
        reached[later] = min(of, reached.get(later, of))
    return pd.DataFrame({"number": list(reached), "reached": list(reached.values())}, dtype="int64")


def provenance_clusters(articles: DataFrame, text_percent: int = TEXT_PERCENT, headline_percent: int = HEADLINE_PERCENT) -> DataFrame:
    """articles (group, position, id, tokens, headline_tokens, primary_root) with founder, the position of the cluster's founder.

    Position and id (any comparable column) order a group's articles; rows that agree in both are one article. Nulls in
    position come first. An article without tokens is like no other.
    """
    placed = articles.withColumn("place", F.struct(F.coalesce(F.col("position").cast("long"), F.lit(NOWHERE)).alias("position"), F.col("id").alias("id")))
    placed = placed.withColumn("text_key", set_key(F.col("tokens"))).withColumn("head_key", set_key(F.col("headline_tokens")))
    placed = written(placed, "articles")
    runs = placed.filter("primary_root is not null").select("group", F.xxhash64(F.lit("root"), "primary_root").alias("run"), "place")
    for key, tokens, percent in (("text_key", "tokens", text_percent), ("head_key", "headline_tokens", headline_percent)):
        own = placed.filter(f"{key} is not null").select("group", F.col(key).alias("key"), "place", F.col(tokens).alias("tokens"))
        runs = runs.union(own.select("group", F.xxhash64(F.lit(key), "key").alias("run"), "place"))
        pairs = similar_sets(own, percent)
        ends = pairs.select("group", F.xxhash64(F.lit(key), "a", "b").alias("run"), F.explode(F.array("a", "b")).alias("key"))
        runs = runs.union(ends.join(own.drop("tokens"), ["group", "key"]).select("group", "run", "place"))
    roots = earliest_reached(predecessors(runs))
    named = placed.join(roots, ["group", "place"], "left")
    return named.select(*articles.columns, F.nullif(F.coalesce("root.position", "place.position"), F.lit(NOWHERE)).alias("founder"), F.coalesce("root.id", "id").alias("founder_id"))


def cluster_summary(clustered: DataFrame) -> DataFrame:
    """What independent clusters a group's evidence makes; clustered: as provenance_clusters gives it, with is_primary and authority."""
    each = clustered.groupBy("group", "founder", "founder_id").agg(F.max("is_primary").alias("primary"), F.max("authority").alias("authority"), F.count("*").alias("articles"))
    out = each.groupBy("group").agg(
        F.count("*").alias("clusters"), F.count_if("primary").alias("primary_clusters"), F.count_if(F.col("authority") >= 2.0).alias("strong_clusters"), F.sum("articles").alias("articles"), F.max("articles").alias("largest"),
    )
    n, primary = F.col("clusters"), F.col("primary_clusters") > 0
    # Risk that all rests on one cluster, and the confidence that clusters allow (fixed values).
    risk = F.when(n == 1, 85.0).when(n == 2, 45.0).when(n == 3, 20.0).otherwise(5.0)
    cap = F.when((n >= 3) & primary, 96.0).when((n == 1) & primary, 78.0).when(n == 1, 62.0).when(primary, 92.0).when(F.col("strong_clusters") >= 2, 82.0).otherwise(70.0)
    return out.select("group", "articles", "largest", "clusters", "primary_clusters", "strong_clusters", (n - 1).alias("leave_one_out"), risk.alias("dependency_risk"), cap.alias("confidence_cap"))
