"""Paged market-data sources as a Spark data source: one partition for each batch of symbols and window of time, page tokens followed inside it.

spark.read.format("market_pages").option("kind", "bars").option("root", ...).option("symbols", "A,B").option("start", ...).option("end", ...).load()

A task sees the symbols of its own requests alone. A partition asks for its first page and then for each page that the last one names, so a reader holds one page at a time, and a
lost executor repeats its own batch and window alone. Pages come from a transport: a function of (root, kind, symbols, start, end, token) that
gives a page, the JSON object {kind: {symbol: [row, ...]}, "next_page_token": token or null}. The transports at hand read landed
pages from any file system that Arrow reaches: market_pages those with a folder of their own (root/kind/batch=<key>/window=<start>/page=<token>/),
market_packs those of many batches in one Parquet file (root/kind/pack=<first digits of the batch's key>/), which very many pages need. A client
of a live service takes their place by registering a source with another one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Symbols of one request, and days of one window (fixed values of the loader's defaults).
BATCH_SYMBOLS, WINDOW_DAYS = 20, 7
#: Requests beyond which a task takes several of them, one after the other.
MOST_TASKS = 256
#: First digits of a batch's key that name its pack, and bytes of a pack's row group, the part of it that a reader holds.
PACK_DIGITS, GROUP_BYTES = 2, 4 << 20
#: Each kind's columns by the payload's field, with their types.
FIELDS = {
    "bars": {"t": ("ts", "string"), "o": ("open", "double"), "h": ("high", "double"), "l": ("low", "double"), "c": ("close", "double"), "v": ("volume", "double"), "n": ("trade_count", "bigint"), "vw": ("vwap", "double")},
    "quotes": {"t": ("ts", "string"), "bp": ("bid", "double"), "ap": ("ask", "double"), "bs": ("bid_size", "double"), "as": ("ask_size", "double")},
    "trades": {"t": ("ts", "string"), "p": ("price", "double"), "s": ("size", "double")},
}
ARROW = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64()}


def batch_key(symbols: list[str]) -> str:
    """The name of a batch of symbols, in their order."""
    return hashlib.sha256(",".join(symbols).encode()).hexdigest()[:16]


def landed_page(root: str, kind: str, symbols: list[str], start: str, end: str, token: str) -> dict[str, Any]:
    """A page that has landed; a batch and window of which nothing landed have an empty one."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(root)
    where = fs.FileSelector(f"{path.rstrip('/')}/{kind}/batch={batch_key(symbols)}/window={start}/page={token}", allow_not_found=True)
    files = [f.path for f in store.get_file_info(where) if f.is_file and not f.base_name.startswith(("_", "."))]
    for name in files:
        with store.open_input_stream(name) as body:
            if text := body.read().decode().strip():
                return json.loads(text)
    if token != "0":
        raise FileNotFoundError(f"page {token} of {kind} in {root} is named but has not landed")
    return {kind: {}, "next_page_token": None}


class PackedPage:
    """The transport of packs: finds a page by the ranges of the row groups, and keeps the group it read last.

    Groups are in the order in which a task asks, so each is read once. What it keeps doesn't outlive the task.
    """

    def __init__(self) -> None:
        self.pack, self.groups, self.held, self.pages = None, [], -1, {}

    def __reduce__(self) -> tuple[Any, ...]:
        return type(self), ()

    def open(self, root: str, kind: str, pack: str) -> None:
        from pyarrow import fs
        from pyarrow import parquet as pq

        store, path = fs.FileSystem.from_uri(root)
        where = fs.FileSelector(f"{path.rstrip('/')}/{kind}/pack={pack}", allow_not_found=True)
        self.pack, self.groups, self.held, self.pages = (root, kind, pack), [], -1, {}
        for f in store.get_file_info(where):
            if f.is_file and not f.base_name.startswith(("_", ".")):
                file = pq.ParquetFile(store.open_input_file(f.path))
                ranges = [file.metadata.row_group(i).column(0).statistics for i in range(file.num_row_groups)]
                self.groups += [(file, i, r.min, r.max) for i, r in enumerate(ranges)]

    def __call__(self, root: str, kind: str, symbols: list[str], start: str, end: str, token: str) -> dict[str, Any]:
        key = batch_key(symbols)
        if self.pack != (root, kind, key[:PACK_DIGITS]):
            self.open(root, kind, key[:PACK_DIGITS])
        request = f"{key}/{start}"
        if (request, token) not in self.pages:
            after = self.held + 1
            for n in (*range(after, len(self.groups)), *range(after - 1)):
                file, i, least, most = self.groups[n]
                if least <= request <= most:
                    rows = file.read_row_group(i).to_pydict()
                    self.held, self.pages = n, dict(zip(zip(rows["request"], map(str, rows["page"]), strict=True), rows["value"], strict=True))
                    if (request, token) in self.pages:
                        break
        if (request, token) in self.pages:
            return json.loads(self.pages[request, token])
        if token != "0":
            raise FileNotFoundError(f"page {token} of {kind} in {root} is named but has not landed")
        return {kind: {}, "next_page_token": None}


@dataclass
class Request(InputPartition):
    symbols: list[str]
    start: str
    end: str


@dataclass
class Requests(InputPartition):
    requests: list[Request]


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str], transport: Callable[..., dict[str, Any]]):
        self.root, self.kind, self.transport = options["root"], options["kind"], transport
        self.symbols = [s for s in dict.fromkeys(options["symbols"].split(",")) if s]
        self.start, self.end = date.fromisoformat(options["start"]), date.fromisoformat(options["end"])
        self.size, self.days = int(options.get("batchsymbols", BATCH_SYMBOLS)), int(options.get("windowdays", WINDOW_DAYS))

    def __getstate__(self) -> dict[str, Any]:
        """What a task needs: its own symbols come with its partition, all of them would go to every task."""
        return {**self.__dict__, "symbols": []}

    def partitions(self) -> list[InputPartition]:
        """Batches of symbols by windows from start to end (the last one cut off, end not included); very many are dealt to fewer tasks."""
        starts = [self.start + timedelta(days=d) for d in range(0, max((self.end - self.start).days, 0), self.days)]
        batches = [self.symbols[i : i + self.size] for i in range(0, len(self.symbols), self.size)]
        requests = [Request(b, s.isoformat(), min(s + timedelta(days=self.days), self.end).isoformat()) for b in batches for s in starts]
        each = -(-len(requests) // MOST_TASKS)
        if each > 1:  # by key, as packs are, so that a task reads few of them
            requests.sort(key=lambda r: (batch_key(r.symbols), r.start))
        return requests if each <= 1 else [Requests(requests[i : i + each]) for i in range(0, len(requests), each)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for request in partition.requests if isinstance(partition, Requests) else [partition]:
            yield from self.pages(request)

    def pages(self, partition: Request) -> Iterator[pa.RecordBatch]:
        fields, token, seen = FIELDS[self.kind], "0", set()
        while token is not None:
            if token in seen:
                raise ValueError(f"page {token} names itself or an earlier page")
            seen.add(token)
            page = self.transport(self.root, self.kind, partition.symbols, partition.start, partition.end, token)
            rows = [(symbol.upper(), row) for symbol, rows in (page.get(self.kind) or {}).items() for row in rows or [] if isinstance(row, dict)]
            columns = [pa.array([s for s, _ in rows], pa.string())]
            for field, (_, kind) in fields.items():
                cast = str if kind == "string" else float if kind == "double" else int
                columns.append(pa.array([None if r.get(field) is None else cast(r[field]) for _, r in rows], ARROW[kind]))
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names=["symbol", *(name for name, _ in fields.values())])
            token = page.get("next_page_token")


class MarketPages(DataSource):
    """The source market_pages; options root, kind (bars, quotes, trades), symbols, start, end, batchSymbols, windowDays."""

    transport = staticmethod(landed_page)

    @classmethod
    def name(cls) -> str:
        return "market_pages"

    def schema(self) -> str:
        return "symbol string, " + ", ".join(f"{name} {kind}" for name, kind in FIELDS[self.options["kind"]].values())

    def reader(self, schema: Any) -> PageReader:
        self.planned = True
        return PageReader({k.lower(): v for k, v in self.options.items()}, type(self).transport)

    def __getstate__(self) -> dict[str, Any]:
        """Once planned, the source goes to every task, without its list of symbols."""
        return {**self.__dict__, "options": {"kind": self.options["kind"]}} if getattr(self, "planned", False) else self.__dict__


class MarketPacks(MarketPages):
    """The source market_packs; options as market_pages."""

    transport = PackedPage()

    @classmethod
    def name(cls) -> str:
        return "market_packs"


def land_pages(rows: DataFrame, kind: str, root: str, start: str, day: str = "day", page_rows: int = 10_000, batch_symbols: int = BATCH_SYMBOLS, window_days: int = WINDOW_DAYS, packed: bool = False) -> list[str]:
    """Write rows (symbol, day, and the kind's payload fields) as pages, as a collector of a live service lands them; gives the symbols in order.

    One file a page, or packed; batches and windows are as the reader forms them.
    """
    symbols = [r[0] for r in rows.select("symbol").distinct().orderBy("symbol").collect()]
    keys = {s: batch_key(symbols[i - i % batch_symbols : i - i % batch_symbols + batch_symbols]) for i, s in enumerate(symbols)}
    spark = rows.sparkSession
    batches = spark.createDataFrame([(s, k) for s, k in keys.items()], "symbol string, batch string")
    since: Column = F.datediff(F.col(day), F.lit(start).cast("date"))
    x = rows.join(F.broadcast(batches), "symbol").withColumn("window", F.date_add(F.lit(start).cast("date"), (since - since % window_days).cast("int")))
    w = Window.partitionBy("batch", "window")
    x = x.withColumn("place", F.row_number().over(w.orderBy("symbol", "t")) - 1).withColumn("in_window", F.count(F.lit(1)).over(w)).withColumn("page", F.floor(F.col("place") / page_rows).cast("int"))
    fields = list(FIELDS[kind])
    of_symbol = x.groupBy("batch", "window", "page", "in_window", "symbol").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.struct(*fields).alias("row")))), lambda e: e["row"]).alias("rows"))
    pages = of_symbol.groupBy("batch", "window", "page", "in_window").agg(F.map_from_entries(F.collect_list(F.struct("symbol", "rows"))).alias(kind))
    more = (F.col("page") + 1) * page_rows < F.col("in_window")
    body = F.to_json(F.struct(kind, F.when(more, (F.col("page") + 1).cast("string")).alias("next_page_token")), {"ignoreNullFields": "false"})
    out = pages.select(body.alias("value"), "batch", F.col("window").cast("string").alias("window"), "page")
    if packed:
        packs = out.select(F.concat_ws("/", "batch", "window").alias("request"), "page", "value", F.substring("batch", 1, PACK_DIGITS).alias("pack")).repartition("pack").sortWithinPartitions("pack", "request", "page")
        packs.write.mode("append").option("parquet.block.size", GROUP_BYTES).partitionBy("pack").parquet(f"{root.rstrip('/')}/{kind}")
        return symbols
    out = out.repartition("batch", "window", "page")
    # Tasks put their own pages in place, the driver doesn't move all of them; a repeated task's page is the same page.
    out.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("batch", "window", "page").text(f"{root.rstrip('/')}/{kind}")
    return symbols
