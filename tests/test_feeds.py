"""The paged source: partitions, tokens, odd payloads; streams against their batch rules."""

import datetime as dt
import glob
import json
import pickle

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodestone.plans.feeds import _read
from lodestone.plans.streams import d4_appended_bars, q39_completed_minutes, q41_tracked_batch, q41_tracked_stream
from lodestone.session import shared_folder
from lodestone.sources import paged
from lodestone.sources.paged import MarketPages, PageReader, batch_key, land_pages
from lodestone.streaming.tracking import feed, run_step, tracked, tracked_batch

OPTIONS = {"root": "none", "kind": "trades", "symbols": "A,B,A,,C", "start": "2024-01-01", "end": "2024-01-10", "batchsymbols": "2"}


def test_partitions_are_batches_by_windows():
    parts = PageReader(OPTIONS, None).partitions()
    assert [(p.symbols, p.start, p.end) for p in parts] == [(s, a, b) for s in (["A", "B"], ["C"]) for a, b in (("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-10"))]
    assert PageReader({**OPTIONS, "end": "2024-01-01"}, None).partitions() == [] and PageReader({**OPTIONS, "symbols": ""}, None).partitions() == []


def test_tasks_do_not_carry_all_symbols():
    """A task's size doesn't follow the number of symbols, and very many requests are dealt to a bounded number of tasks."""
    few, many = ("A,B", ",".join(f"S{i}" for i in range(60_000)))
    sizes = []
    for symbols in (few, many):
        source = MarketPages({**OPTIONS, "symbols": symbols})
        assert pickle.loads(pickle.dumps(source)).options["symbols"] == symbols
        reader = source.reader(None)
        parts = reader.partitions()
        sizes.append(len(pickle.dumps((reader, source))))
        asked = []
        reader.transport = lambda root, kind, symbols, start, end, token: asked.append((tuple(symbols), start)) or {kind: {}}  # noqa: B023
        assert [b for p in parts for b in reader.read(p)] == [] and len(parts) <= 1024
        assert sorted({s for b, _ in asked for s in b}) == sorted(set(symbols.split(","))) and len(asked) == len(set(asked))
    assert sizes[1] == sizes[0]


def test_tokens_are_followed_and_odd_rows_are_left_out():
    pages = {"0": {"trades": {"a": [{"t": "x", "p": 1, "s": None}, "junk"], "b": None}, "next_page_token": "q"}, "q": {"trades": None, "next_page_token": "r"}, "r": {"trades": {"A": [{"p": "2.5"}]}}}
    asked = []

    def transport(root, kind, symbols, start, end, token):
        asked.append(token)
        return pages[token]

    reader = PageReader(OPTIONS, transport)
    rows = [r for b in reader.read(reader.partitions()[0]) for r in b.to_pylist()]
    assert asked == ["0", "q", "r"] and rows == [{"symbol": "A", "ts": "x", "price": 1.0, "size": None}, {"symbol": "A", "ts": None, "price": 2.5, "size": None}]
    with pytest.raises(ValueError, match="names itself"):
        list(PageReader(OPTIONS, lambda *a: {"trades": {}, "next_page_token": "0"}).read(reader.partitions()[0]))


def test_landed_pages_round_trip(spark, tmp_path):
    rows = [(s, dt.date(2024, 1, 1 + d), f"2024-01-{1 + d:02}T10:00:0{k}Z", float(k), None) for s in ("A", "B", "C") for d in range(9) for k in range(3)]
    frame = spark.createDataFrame(rows, "symbol string, day date, t string, p double, s double")
    root = f"file://{tmp_path}/pages"
    assert land_pages(frame, "trades", root, "2024-01-01", page_rows=4, batch_symbols=2) == ["A", "B", "C"]
    assert (tmp_path / f"pages/trades/batch={batch_key(['A', 'B'])}/window=2024-01-01/page=10").is_dir()
    spark.dataSource.register(MarketPages)
    read = spark.read.format("market_pages").options(root=root, kind="trades", symbols="A,B,C", start="2024-01-01", end="2024-01-10", batchSymbols="2").load()
    assert sorted((r["symbol"], r["ts"], r["price"], r["size"]) for r in read.collect()) == sorted((s, t, p, None) for s, _, t, p, _ in rows)
    nothing = spark.read.format("market_pages").options(root=root, kind="trades", symbols="X", start="2024-01-01", end="2024-01-10").load()
    assert nothing.collect() == []
    page = next((tmp_path / f"pages/trades/batch={batch_key(['C'])}/window=2024-01-01/page=0").glob("part*"))
    page.write_text(json.dumps({**json.loads(page.read_text()), "next_page_token": "99"}))
    with pytest.raises(Exception, match="has not landed"):
        spark.read.format("market_pages").options(root=root, kind="trades", symbols="A,B,C", start="2024-01-01", end="2024-01-10", batchSymbols="2").load().collect()


def test_landed_files_do_not_follow_the_pages(spark):
    """Pages of three batches and four windows, several in most: no more files than batches, and all rows come back."""
    rows = [(f"S{i:02}", dt.date(2024, 1, 1 + 7 * w // 2), f"2024-01-{1 + 7 * w // 2:02}T10:00:0{k}Z", float(k), float(i)) for i in range(50) for w in range(8) for k in range(7)]
    folder = shared_folder(spark).removeprefix("file://")
    before = set(glob.glob(f"{folder}/pages-*"))
    read = _read(spark, spark.createDataFrame(rows, "symbol string, day date, t string, p double, s double"), "trades")
    assert sorted(tuple(r) for r in read.collect()) == sorted((s, t, p, z) for s, _, t, p, z in rows)
    (root,) = set(glob.glob(f"{folder}/pages-*")) - before
    assert len(glob.glob(f"{root}/**/part-*", recursive=True)) <= 3


def test_packs_of_several_groups(spark, tmp_path, monkeypatch):
    """A page is found in whichever group of its pack it is; a reader holds one group; what did not land is empty, a named page that did not is an error."""
    monkeypatch.setattr(paged, "GROUP_BYTES", 1)
    rows = [(s, dt.date(2024, 1, 1 + d), f"2024-01-{1 + d:02}T10:00:00.{k:03}Z", float(k), None) for s in ("A", "B") for d in range(20) for k in range(25)]
    root = f"file://{tmp_path}/packs"
    land_pages(spark.createDataFrame(rows, "symbol string, day date, t string, p double, s double"), "trades", root, "2024-01-01", page_rows=2, packed=True)
    (file,) = glob.glob(f"{tmp_path}/packs/trades/pack={batch_key(['A', 'B'])[:2]}/part-*")
    groups = pq.ParquetFile(file).metadata.num_row_groups
    assert groups > 2
    spark.dataSource.register(paged.MarketPacks)
    options = {"root": root, "kind": "trades", "symbols": "A,B", "start": "2024-01-01", "end": "2024-02-28"}
    read = spark.read.format("market_packs").options(**options).load()
    assert sorted((r["symbol"], r["ts"], r["price"], r["size"]) for r in read.collect()) == sorted((s, t, p, None) for s, _, t, p, _ in rows)
    opened, real = [], pq.ParquetFile.read_row_group
    monkeypatch.setattr(pq.ParquetFile, "read_row_group", lambda self, i: opened.append(i) or real(self, i))
    reader = PageReader(options, paged.PackedPage())
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == len(rows) and opened == list(range(groups))
    with pytest.raises(FileNotFoundError, match="has not landed"):
        paged.PackedPage()(root, "trades", ["A", "B"], "2024-01-01", "2024-01-08", "999")
    assert paged.PackedPage()(root, "trades", ["X"], "2024-01-01", "2024-01-08", "0") == {"trades": {}, "next_page_token": None}


@pytest.fixture(scope="module")
def little(spark, tmp_path_factory):
    """Events of four days: few ticks, so that checkpoints are missed too."""
    folder = tmp_path_factory.mktemp("little")
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter("ts < timestamp_ntz '2024-01-05'")
    e.write.parquet(f"{folder}/events.parquet")
    return str(folder)


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stream_equals_batch(spark, little):
    want = told(q41_tracked_batch(spark, little))
    assert {r[3] for r in want} == {"captured", "missed"} and told(q41_tracked_stream(spark, little)) == want


def test_minutes_and_appended_bars(spark, little):
    minutes = q39_completed_minutes(spark, little)
    assert minutes.agg(F.sum("trade_count")).first()[0] == spark.read.parquet(f"{little}/events.parquet").count()
    assert minutes.groupBy("symbol", "bar_ts").count().filter("count > 1").isEmpty()
    assert d4_appended_bars(spark, little).groupBy("symbol", "bar_ts").count().filter("count > 1").isEmpty()


def test_late_bar_within_the_retry_counts(spark, tmp_path):
    at = lambda h, m: dt.datetime(2024, 1, 2, h, m)
    checkpoints = spark.createDataFrame([("A", 1, at(10, 0), at(11, 0), 10.0), ("A", 2, at(10, 0), at(11, 30), 10.0), ("B", 3, at(10, 0), at(11, 0), 5.0), ("A", 4, at(10, 0), at(11, 0), 0.0)], "symbol string, id long, selected_at timestamp, scheduled_at timestamp, selected_price double")
    early = spark.createDataFrame([("A", at(10, 50), 11.0), ("A", at(10, 59), 12.0), ("A", at(11, 0), 99.0), ("B", at(10, 10), 7.0), ("B", at(12, 0), 7.0)], "symbol string, bar_ts timestamp, close double")
    late = spark.createDataFrame([("A", at(11, 25), 13.0), ("Z", at(23, 0), 1.0)], "symbol string, bar_ts timestamp, close double")
    first = feed(checkpoints, early)
    first.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = tracked(spark.readStream.schema(first.schema).parquet(f"{tmp_path}/in"))
    run_step(stream, f"{tmp_path}/out", f"{tmp_path}/progress")
    feed(checkpoints.limit(0), late).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run_step(stream, f"{tmp_path}/out", f"{tmp_path}/progress")
    got = {r["id"]: (r["status"], r["price"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: ("captured", 12.0), 2: ("captured", 13.0), 3: ("missed", None), 4: ("captured", 12.0)}
    batch = {r["id"]: (r["status"], r["price"]) for r in tracked_batch(checkpoints, early.union(late)).collect()}
    assert batch == got
