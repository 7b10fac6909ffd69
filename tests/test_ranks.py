"""Ranks of many features: narrow rows by day and feature, with nulls, ties and repeated names."""

from lodestone.operators.ranks import normalised_ranks


def test_a_day_is_not_sorted_whole_for_each_feature(spark):
    names = [f"f{i}" for i in range(8)]
    rows = [(d, s, *[None if (i * s + (d or 0)) % 7 == 3 else float((i + 1) * s % 5) for i in range(8)]) for d in (None, 1, 2) for s in (*range(6), 5)] + [(9, 1, *[1.0] * 8)]
    out = normalised_ranks(spark.createDataFrame(rows, "day int, s int, " + ", ".join(f"{n} double" for n in names)), ["day"], "s", names)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") == 1
    got = out.collect()
    assert len(got) == len(rows) and {r["n"] for r in got if r["day"] is None} == {7} and next(r for r in got if r["day"] == 9)["f0_rank"] is None
    for d in (None, 1, 2):
        own = [r for r in got if r["day"] == d]
        for f in names:
            order = sorted(own, key=lambda r: r[f"{f}_rank"])
            assert [round(r[f"{f}_rank"] * 6) for r in order] == list(range(7))
            keys = [(r[f] is None, r[f] or 0.0, r["s"]) for r in order]
            assert keys == sorted(keys)
