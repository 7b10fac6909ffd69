"""Operator 10, URL filters: rules indexed by their rarest literal token.

A rule has a host, a path prefix and an action. Every rule is filed under the one of its literal tokens
that the URLs at hand hold least often, which one aggregation counts; a URL's tokens fetch the rules filed under them,
and only those rules run their regular expression. The index is a literal of the plan (the list of rules is a
parameter), a hash table with about as many slots as rules, of which a token looks at one; so every row is judged where it
stands, in time that follows its own tokens: no join, no shuffle of URLs. Everything is DataFrame operations.

Defined cases: a null URL or one without "://" has empty host and path, fits no rule and gets the default;
an empty table gives an empty table; repeated rows are judged alike; input columns called host, path, rule
or verdict are replaced; of rules with equal host and path a block goes before an allow; without rules all get the default.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, unused, without

NEW = ("host", "path", "rule", "verdict")
ENTRY = "token: string, length: int, blocks: boolean, rule: string, action: string, regex: string"


def parse_rule(action: str, rule: str) -> tuple[str, str, str, int, list[str]]:
    """One rule such as ("block", "example.com/en/"): its regular expression over host + path, and its literal tokens.

    "*" in the path stands for any characters. A token is literal if every fitting URL holds it whole: the
    labels of the host, and the path's segments that have no "*" and end in "/".
    """
    if action not in ("allow", "block"):
        raise ValueError(f"action {action!r} is neither allow nor block")
    host, slash, path = rule.partition("/")
    path = slash + path
    regex = rf"^(?:[^/]*\.)?{re.escape(host)}(?=/|$)" if host else "^[^/]*"
    regex += ".*".join(re.escape(x) for x in path.split("*"))
    segments = [s for s in path.split("/")[:-1] if "*" not in s]
    tokens = sorted({t for t in [*host.split("."), *segments] if t})
    return rule, action, "(?s)" + regex, len(rule), tokens or [""]


def url_host(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host, up to "?", "#" or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def tokens_of(host: Column, path: Column) -> Column:
    """A URL's distinct tokens: the labels of its host, the segments of its path, and the empty token, which all have."""
    return F.array_distinct(F.concat(F.split(host, r"\."), F.split(path, "/"), F.array(F.lit(""))))


class TokenIndex:
    """Entries of a hash table by token, as a literal of the plan."""

    def __init__(self, entries: list[dict], kind: str):
        slots: list[list[dict]] = [[] for _ in range(max(1, len(entries)))]
        for entry in entries:
            slots[crc32(entry["token"].encode("utf-8", "surrogatepass")) % len(slots)].append(entry)
        self.size, self.table = len(slots), F.from_json(F.lit(json.dumps(slots)), f"array<array<struct<{kind}>>>")

    def of(self, token: Column) -> Column:
        """The token's entries."""
        return F.filter(F.get(self.table, (F.crc32(token) % self.size).cast("int")), lambda entry: entry["token"] == token)


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], url_col: str = "url", default: str = "allow") -> DataFrame:
    """Judge each row's URL: adds host, path, rule (the longest that fits, else null) and verdict."""
    parsed_rules = [parse_rule(a, r) for a, r in rules]
    host, path = url_host(F.col(f"`{url_col}`")), url_path(F.col(f"`{url_col}`"))
    parsed = pages.select(*without(pages, *NEW), host.alias("host"), path.alias("path"))

    own = tokens_of(F.col("host"), F.col("path"))
    known = TokenIndex([{"token": t} for t in sorted({t for r in parsed_rules for t in r[4]})], "token: string")
    held = pages.select(host.alias("host"), path.alias("path")).select(F.explode(F.filter(own, lambda t: F.size(known.of(t)) > 0)).alias("token"))
    counts = {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()} if parsed_rules else {}
    index = [
        {"token": min(tokens, key=lambda t: (counts.get(t, 0), t)), "length": length, "blocks": action == "block", "rule": rule, "action": action, "regex": regex}
        for rule, action, regex, length, tokens in parsed_rules
    ]
    filed = TokenIndex(index, ENTRY)
    fetched = F.flatten(F.transform(own, filed.of))
    fetched = F.transform(fetched, lambda r: F.struct(*[r[c].alias(c) for c in ("length", "blocks", "rule", "action", "regex")]))
    best = unused(parsed, "best")
    judged = parsed.withColumn(best, F.array_max(F.filter(fetched, lambda r: F.rlike(F.concat("host", "path"), r["regex"]))))
    return judged.select(*without(pages, *NEW), "host", "path", F.col(f"{best}.rule").alias("rule"), F.coalesce(F.col(f"{best}.action"), F.lit(default)).alias("verdict"))
