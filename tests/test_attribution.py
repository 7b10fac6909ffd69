"""Mentions of insolvency: places against Python's finditer, and whose they are."""

import re

import pytest

from lodestone.operators.attribution import AFTER, BEFORE, CONTEXTS, MENTIONS, attributed, event_mentions, pattern

CASES = [
    ("The Company filed a voluntary petition under Chapter 11.", True),
    ("A major vendor filed for Chapter 11 bankruptcy protection in March.", False),
    ("The Company reported growth. " + "x" * 200 + " One supplier commenced liquidation.", False),
    ("The Company has not filed for bankruptcy.", False),
    ("We could be forced to seek bankruptcy protection if sales fall.", False),
    ("There is substantial doubt about its ability to continue as a going concern.", True),
    ("The issuer was in compliance with its covenants; it failed to make no payment.", False),
    ("It defaulted on its senior notes and failed to meet an interest payment.", True),
    ("The borrower filed for bankruptcy.", False),
    ("The unit became insolvent.", True),
    ("In the event of a covenant default the lender may act.", False),
    ("Nothing happened here.", False),
    ("", False),
    (None, False),
    ("Vendor news. " + "y " * 400 + "We filed for chapter  7.\nNo debt default was found.", False),
    ("Vendor news. " + "y " * 400 + "We filed for chapter  7 and stop.", True),
]


def plain(text):
    """Every match of every rule, and the contexts of its surroundings."""
    out = []
    for name, chain in MENTIONS.items():
        for m in re.finditer(pattern(*chain), text or ""):
            around = text[max(0, m.start() - BEFORE) : m.end() + AFTER]
            out.append((name, m.start(), m.end() - m.start(), *[any(re.search(pattern(*c), around) for c in chains) for chains in CONTEXTS.values()]))
    return sorted(out)


def test_mentions_and_contexts(spark):
    texts = [t for t, _ in CASES] + [" ".join(t or "" for t, _ in CASES) * 3, "é🦊 " * 100 + "We filed for bankruptcy. We filed for bankruptcy."]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for r in event_mentions(df).collect():
        got.setdefault(r["id"], []).append((r["rule"], r["start"], r["size"], *[r[c] for c in CONTEXTS]))
    assert {i: sorted(v) for i, v in got.items()} == {i: plain(t) for i, t in enumerate(texts) if plain(t)}


def test_events_of_the_candidate_alone(spark):
    df = spark.createDataFrame([(i, t, None) for i, (t, _) in enumerate(CASES)] + [(99, "calm", True)], "id int, text string, solvency boolean")
    got = {r["id"]: r for r in attributed(df).collect()}
    assert {i: got[i]["existential"] for i in range(len(CASES))} == {i: e for i, (_, e) in enumerate(CASES)} and got[99]["existential"]
    assert got[1]["third_party"] > 0 and got[3]["negated"] > 0 and got[4]["hypothetical"] > 0


@pytest.mark.parametrize("text, want", [
    ("Broker raises price target to $12", (True, True, True, False)), ("Analyst cuts its price target", (True, False, True, False)), ("Market analysts follow the sector", (False, False, False, False)),
    ("Price target increased by two", (True, True, False, False)), ("Seasonal heat-related curtailment", (False, False, False, True)),
])
def test_signals(spark, text, want):
    r = attributed(spark.createDataFrame([(1, text, False)], "id int, text string, solvency boolean")).first()
    got = (r["analyst_action"], r["target_raise"], r["target_cut"], r["seasonal"])
    assert got == want
