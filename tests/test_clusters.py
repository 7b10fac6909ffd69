"""Provenance clusters against the rule itself: articles in order, each to the first cluster with a member like it."""

import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import clusters
from lodestone.operators.clusters import cluster_summary, earliest_reached, provenance_clusters, similar_sets, tokens_of


def alike(a, b, percent):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def greedy(articles):
    """[(group, position, id, tokens, headline, root)] -> {(group, position, id): founder's position}."""
    out, held = {}, {}
    for group, position, key, tokens, headline, root in sorted(articles, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0, x[2])):
        found = held.setdefault(group, [])
        for c in found:
            if any(alike(set(tokens), set(t), 70) or alike(set(headline), set(h), 82) or (root and root == r) for t, h, r in c[1]):
                c[1].append((tokens, headline, root))
                break
        else:
            found.append(c := (position, [(tokens, headline, root)]))
        out[group, position, key] = c[0]
    return out


SCHEMA = "group string, position long, id int, tokens array<string>, headline_tokens array<string>, primary_root string"


@pytest.mark.parametrize("seed, run", [(1, 4096), (2, 3), (3, 1)])
def test_clusters_follow_the_greedy_rule(spark, monkeypatch, seed, run):
    monkeypatch.setattr(clusters, "RUN", run)
    r = random.Random(seed)
    pool = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(220):
        if rows and r.random() < 0.6:
            old = r.choice(rows)
            tokens = list(dict.fromkeys([*r.sample(old[3], max(0, len(old[3]) - r.randrange(3))), *r.sample(pool, r.randrange(2))]))
            group = old[0] if r.random() < 0.9 else "b"
        else:
            tokens, group = r.sample(pool, r.randrange(9)), r.choice(["a", "a", "b", None])
        rows.append((group, i if i % 50 else None, i, tokens, r.sample(pool, 3) if r.random() < 0.3 else [], r.choice([None] * 12 + ["x", "y"])))
    r.shuffle(rows)
    out = provenance_clusters(spark.createDataFrame(rows, SCHEMA).repartition(3))
    want = {k: v for k, v in greedy(rows).items() if k[0] is not None}
    got = {(x["group"], x["position"], x["id"]): x["founder"] for x in out.collect() if x["group"] is not None}
    assert got == want and len(set(want.values())) > 20
    assert out.filter("group is null and not (founder <=> position)").count() == 0  # articles of no group stand alone


def test_similar_sets_lose_none(spark):
    r = random.Random(8)
    sets = {(g, f"k{i}"): sorted({f"t{min(int(r.expovariate(0.2)), 25)}" for _ in range(r.randrange(1, 14))}) for i in range(150) for g in ("a", "b") if (i + (g == "a")) % 3}
    frame = spark.createDataFrame([(g, k, t) for (g, k), t in sets.items()], "group string, key string, tokens array<string>")
    for percent in (50, 70, 82, 100):
        want = {(g, a, b) for (g, a), s in sets.items() for (h, b), t in sets.items() if g == h and a < b and alike(set(s), set(t), percent)}
        assert {tuple(x) for x in similar_sets(frame, percent).collect()} == want


def test_long_chains_and_copies(spark):
    """A chain of a thousand links, and a thousand copies in a group that holds nearly all articles."""
    chain = spark.range(1, 1000).select(F.lit("g").alias("group"), F.struct(F.col("id").alias("position"), F.lit(0).alias("id")).alias("later"), F.struct((F.col("id") - 1).alias("position"), F.lit(0).alias("id")).alias("earlier"))
    assert earliest_reached(chain).agg(F.min("root.position"), F.max("root.position"), F.count("*")).first()[:] == (0, 0, 1000)
    copies = spark.range(2000).select(F.when(F.col("id") < 1900, "hot").otherwise("cold").alias("group"), F.col("id").alias("position"), F.lit(1).alias("id"), F.split(F.lit("one text that all of these share"), " ").alias("tokens"),
                                      F.array().cast("array<string>").alias("headline_tokens"), F.lit(None).cast("string").alias("primary_root"), F.lit(True).alias("is_primary"), F.lit(3.0).alias("authority"))
    out = cluster_summary(provenance_clusters(copies)).collect()
    assert {(x["group"], x["articles"], x["clusters"], x["dependency_risk"], x["confidence_cap"]) for x in out} == {("hot", 1900, 1, 85.0, 78.0), ("cold", 100, 1, 85.0, 78.0)}
    assert provenance_clusters(copies.limit(0)).collect() == []


@pytest.mark.parametrize("block", [clusters.BLOCK if hasattr(clusters, "BLOCK") else 0, 100])
def test_dead_ends_cost_no_rounds(spark, monkeypatch, block):
    """Each of a long chain's places has a dead end of its own, earlier than those before it: no root leads on."""
    monkeypatch.setattr(clusters, "BLOCK", block, raising=False)
    rounds, write = [], clusters.written
    monkeypatch.setattr(clusters, "written", lambda df, name: rounds.append(name) or write(df, name))
    place = lambda i: F.struct(i.cast("long").alias("position"), F.lit(0).alias("id"))
    i = F.col("id")
    chain = spark.range(1, 200).select(F.lit("g").alias("group"), place(1000 + i).alias("later"), F.explode(F.array(place(1000 + i - 1), place(500 - i))).alias("earlier"))
    found = earliest_reached(chain.union(spark.range(1).select(F.lit("g"), place(F.lit(1000)), place(F.lit(0)))))
    assert {r["root"]["position"] for r in found.filter("place.position >= 1000").collect()} == {0} and found.count() == 400
    assert rounds.count("reached") <= 7


def test_unlike_sets_stay_where_they_are(spark, monkeypatch):
    """Sets that share their rarest token but little else are told apart without their tokens."""
    tables, write = {}, clusters.written
    monkeypatch.setattr(clusters, "written", lambda df, name: tables.setdefault(name, write(df, name)))
    r = random.Random(5)
    frame = spark.createDataFrame([("g", f"k{i}", [f"r{i // 2}", *r.sample([f"t{j}" for j in range(400)], 60)]) for i in range(40)], "group string, key string, tokens array<string>")
    assert similar_sets(frame, 70).count() == 0 and tables["candidate-sets"].count() > 0 and tables["sets"].count() == 0


def test_tokens(spark):
    x = spark.createDataFrame([("The company SAID: ab abc 12 123 123",), (None,)], "t string").select(tokens_of(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in x] == [["the", "abc", "123"], []]
