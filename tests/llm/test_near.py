"""Near-duplicates of texts and vectors against brute force, components, and the pipeline."""

import itertools
import random

import numpy as np
import pytest

from lodestone.llm import near_dedup as nd
from lodestone.llm.common import materialise, reread
from lodestone.llm.embedding_dedup import close_pairs, near_vectors, unit_rows
from lodestone.llm.graph import components
from lodestone.llm.near_dedup import WordHashes, keep_one_of_each, near_duplicates, shingle_set, signature


def roots(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {n for e in edges for n in e if e[0] != e[1]}
    assert got == {n: v for n, v in roots(linked, [e for e in edges if e[0] != e[1]]).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def corpus(rng):
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, docs = text(150), []

    def edited(words, share):
        return [rng.choice(vocabulary) if rng.random() < share else w for w in words]

    for i in range(70):
        docs.append(edited(base, rng.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.2])))
    for i in range(30):
        docs.append(text(rng.randint(0, 40)) + base[:30])
    chain = text(200)
    for i in range(8):
        chain = edited(chain, 0.015)
        docs.append(chain)
    docs += [["a", "b"], ["A", "B"], [], ["a"], text(9000)]
    docs.append(docs[-1][:8900] + ["x"])
    rng.shuffle(docs)
    return [" ".join(d) for d in docs]


@pytest.mark.parametrize("seed", [1, 2])
def test_texts_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = list(enumerate(corpus(rng))) + [(900, None), (901, " \t"), (None, "null id here"), (None, None)]
    rows += rows[:3]
    sets = {i: shingles(t) for i, t in rows if i is not None}
    links = [(a, b) for a, b in itertools.combinations([i for i in sets if sets[i]], 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    label = roots(sets, links)
    frame = spark.createDataFrame([(i, t, "x", True) for i, t in rows], "doc_id long, text string, component_id string, kept boolean")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(frame).collect()), key=str)
    want = [(i, len(sets[i]) if i is not None else len(shingles(t)), label.get(i), i is None or label[i] == i) for i, t in rows]
    assert len(links) > 300 and got == sorted(want, key=str)
    kept = keep_one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted([str(i) for i in label if label[i] == i] + ["None"] * 2)


def test_split_buckets_find_the_same_links(spark, monkeypatch):
    rng = random.Random(7)
    frame = spark.createDataFrame(list(enumerate(corpus(rng))), "doc_id long, text string")
    whole = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame).collect()}
    split = nd.links_across
    monkeypatch.setattr(nd, "links_across", lambda links, members: split(links, members, block=3))
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(frame).collect()} == whole


def test_every_near_signature_shares_a_bucket(spark):
    rng, rows = np.random.default_rng(4), []
    for i in range(60):
        first = rng.integers(0, 1 << 16, nd.VALUES).astype("<u2")
        other = first.copy()
        other[rng.permutation(nd.VALUES)[: nd.MAX_DIFFERENT]] ^= np.uint16(1 + i)
        rows += [(2 * i, first.view("<i8").tolist()), (2 * i + 1, other.view("<i8").tolist())]
    keys = {}
    for r in nd.bucket_keys(spark.createDataFrame(rows, "c long, signature array<long>")).collect():
        keys.setdefault(r["c"], set()).add(r["key"])
    assert all(len(k) == nd.VALUES and {x >> 48 for x in k} == set(range(nd.VALUES)) for k in keys.values())
    assert all(keys[2 * i] & keys[2 * i + 1] for i in range(60)) and not keys[0] & keys[2]


def test_rows_that_share_an_id_are_judged_one_by_one(spark):
    rng = random.Random(11)
    say = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    a, b, c = say(60), say(60), say(60)
    rows = [(1, a), (1, b), (2, a + " x"), (5, b + " y"), (5, c), (5, c.upper()), (5, c), (7, ""), (7, ""), (None, a), (None, a)]
    frame = spark.createDataFrame([(i, t, "v") for i, t in rows], "doc_id long, text string, `__x.y` string")
    kept = keep_one_of_each(frame)
    assert kept.columns == frame.columns
    left = sorted(((r["doc_id"], (r["text"] or "").lower()) for r in kept.collect()), key=str)
    assert left == sorted([(1, a), (1, b), (5, c), (7, ""), (None, a), (None, a)], key=str)


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert near_duplicates(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).filter("kept").count() == 2


def test_signature_distance_keeps_pairs_at_the_threshold():
    rng, lost = random.Random(9), 0
    for _ in range(300):
        words = [f"v{rng.randrange(10**6)}" for _ in range(104)]
        other = words[:90] + [f"u{rng.randrange(10**6)}" for _ in range(14)]
        a, b = (shingle_set(" ".join(x), 5, WordHashes()) for x in (words, other))
        sa, sb = signature(a), signature(b)
        assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.75
        lost += int((sa != sb).sum() > nd.MAX_DIFFERENT)
    assert lost == 0


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 24))
    rows = []
    for i in range(220):
        v = base[rng.integers(40)] + rng.normal(size=24) * rng.choice([0, 0.02, 0.1, 0.15, 0.5])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1.0, 3.0])], int(rng.integers(2)) if i % 9 else None))
    rows += [(300, None, 1), (301, [0.0] * 24, 1), (302, [float("nan")] + [1.0] * 23, 1), (303, [float("inf")] + [1.0] * 23, 1), (304, [None] + [1.0] * 23, 1), (305, [1.0, 2.0], 1), (306, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (307, [], 0)]
    rows += rows[:4]
    frame = spark.createDataFrame([(i, v, lab, 1) for i, v, lab in rows], "vec_id long, embedding array<float>, label int, n_links int")

    def sound(r):
        return r[0] is not None and r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])

    def cosine(a, b):
        a, b = np.array(a), np.array(b)
        return a @ b / np.sqrt((a @ a) * (b @ b))

    pairs = [(x, y) for x, y in itertools.combinations(range(len(rows)), 2) if sound(rows[x]) and sound(rows[y]) and rows[x][2] == rows[y][2] and len(rows[x][1]) == len(rows[y][1]) and cosine(rows[x][1], rows[y][1]) >= 0.98]
    label = roots({r[0] for r in rows if r[0] is not None}, [(rows[x][0], rows[y][0]) for x, y in pairs])
    n = np.bincount([k for p in pairs for k in p], minlength=len(rows))
    want = [(r[0], int(n[k]), label.get(r[0]), r[0] is None or label[r[0]] == r[0]) for k, r in enumerate(rows)]
    for block in (4096, 16):
        got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(frame, block=block).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert near_vectors(frame.limit(0)).count() == 0 and len(pairs) > 100


def test_close_pairs_loses_none():
    u = unit_rows(np.random.default_rng(1).normal(size=1500 * 3).repeat(1), 3)
    found = {tuple(sorted(p)) for i, j in close_pairs(u, u, 0.999, True) for p in zip(i.tolist(), j.tolist(), strict=True)}
    i, j = np.nonzero(np.triu(u @ u.T >= 0.999, 1))
    assert found >= set(zip(i.tolist(), j.tolist(), strict=True))


def test_materialise(spark):
    df = spark.range(5)
    again, path = reread(df, "t")
    assert again.count() == 5 and path.startswith(spark.conf.get("spark.checkpoint.dir")) and materialise(df).count() == 5


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    say = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    item, line = say(30), "the same long line in many documents " + say(3)
    docs = [(i, say(40) + (" vilest scumly" if i % 4 == 0 else ""), "en", "s", 0) for i in range(120)]
    docs += [(200, say(20) + " " + item + " " + say(20), "en", "s", 0), (201, docs[1][1], "en", "s", 0), (202, None, None, None, None), (203, "", "en", "s", 0), (None, say(12), "en", "s", 0)]
    docs += [(210 + i, say(30) + "\n" + line, "en", "s", 0) for i in range(4)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not {i for i in out if i is not None and i < 120 and i % 4 == 0} and {i for i in range(120) if i % 4} <= set(out)
    assert 201 not in out and 202 in out and 203 in out and None in out
    assert not set(item.split()) <= set(out[200]["decoded"].split()) and len(out[200]["decoded"].split()) == 40
    assert line in out[213]["decoded"] and not any(line in out[210 + i]["decoded"] for i in range(3))
    assert all(r["n_tokens"] == len(r["ids"]) for r in out.values())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns
    assert corpus_pipeline.encode(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_pipeline_stages_with_clashing_columns_and_repeated_rows(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(3)
    say = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    extra = ["y", "score", "predicted", "ids", "spans", "items", "best", "kept", "component_id", "n_hit", "decoded", "a.b"]
    rows = [(i, say(30) + (" vilest" if i % 4 == 0 else ""), *["x"] * len(extra)) for i in range(60)]
    rows += rows[1:4] + [(70, None, *["x"] * len(extra)), (71, None, *[None] * len(extra)), (None, None, *["x"] * len(extra)), (72, "long " * 60_000, *["x"] * len(extra))]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in extra)
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, say(30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, str(tmp_path)))
        assert docs.columns == ["doc_id", "text", *extra], name
    left = sorted((r["doc_id"] for r in docs.collect()), key=str)
    assert left == sorted([*(i for i in range(60) if i % 4), 70, 71, 72, None], key=str)
    assert corpus_pipeline.encode(spark, docs, str(tmp_path)).count() == len(left)
