"""Who an event in a text is about: mentions by position, and what stands around each of them.

A mention of insolvency counts for the candidate only where its own surroundings do not give it to a third party, deny it,
make it a possibility, or state compliance. Rules are chains of terms with the most characters that may lie between neighbours; the
tables below are all there is to them, and one function turns a chain into a pattern for Spark and for SQL alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Terms, chains and reaches that must agree with the published rules.
SUBJECT = "the company|the registrant|the issuer|we|our company|our business"
THIRD_PARTY = (
    "vendor|supplier|customer|tenant|borrower|counterparty|portfolio company|investee|distributor|franchisee|independently[- ]owned store|service provider|joint venture partner|licensee|lessee|guarant(?:ee|or) customer"
)
EVENT = (
    r"chapter\s+(?:7|11)|bankruptcy(?: protection| proceeding| filing)?|insolvenc(?:y|e proceedings?)|liquidation|wind[- ]?down|winding up|going concern|debt default|payment default|loan default|covenant default"
)
FILES = "filed?|files?|has filed|petitioned|commenced|entered|seeks?|sought"
FILED_FOR = r"a voluntary petition|chapter\s+(?:7|11)|bankruptcy(?: protection| proceedings?)?|insolvency proceedings?|liquidation|wind[- ]?down"
DEBT = "debt|loan|bond|note|interest|principal|payment|covenant"
ANALYST_RATING = "buy|sell|hold|neutral|overweight|underweight|outperform|underperform|equal[- ]weight"
#: What makes a mention: chains of term, reach, term, ...
MENTIONS = {
    "candidate_files": (SUBJECT, 80, FILES, 100, FILED_FOR),
    "files": (FILES, 90, FILED_FOR),
    "plan_of_liquidation": ("approved|adopted|commenced|initiated", 60, "(?:a )?(?:plan|process|proceeding) of (?:liquidation|wind[- ]?down|winding up)"),
    "substantial_doubt": ("substantial doubt", 180, "(?:continue|continuing) as a going concern"),
    "unable_to_continue": ("unable to continue as a going concern",),
    "going_concern_opinion": ("going concern (?:opinion|qualification|warning)",),
    "auditor": ("auditor|independent registered public accounting firm", 120, "going concern"),
    "candidate_defaults": (SUBJECT, 90, "defaulted on|is in default|was in default|received (?:a )?notice of default|failed to (?:make|meet)|was unable to (?:make|meet)", 100, DEBT),
    "defaults": ("defaulted on|received (?:a )?notice of default|failed to (?:make|meet)|unable to (?:make|meet)", 100, "debt|loan|bond|note|interest|principal|payment"),
    "insolvent": ("(?:is|was|became) insolvent",),
}
#: What takes a mention from the candidate, looked for this many characters before and after it.
BEFORE, AFTER = 260, 160
CONTEXTS = {
    "third_party": ((THIRD_PARTY, 220, f"filed?|files?|petition(?:ed|s)?|entered|commenced|defaulted|faces?|seeks?|sought|{EVENT}"), (EVENT, 140, THIRD_PARTY)),
    "negated": (("no|not|never|without|neither", 55, EVENT), (EVENT, 55, "did not occur|has not occurred|was not triggered|does not exist|none")),
    "hypothetical": ((r"may|might|could|would|if|unless|potential(?:ly)?|possible|risk of|in the event of|upon an event of|subject to", 90, EVENT),),
    "compliance": (("(?:was|were|remained|is|are) in compliance with", 120, "covenants?|facility|debt|agreement"), ("no (?:event of )?default",)),
}
#: Other signals of a whole text.
SIGNALS = {
    "analyst_action": (
        ("downgrad(?:e|ed|es)|upgrad(?:e|ed|es)",),
        ("raises?|raised|lowers?|lowered|cuts?|cut|boosts?|boosted|trims?|trimmed|reduces?|reduced", 35, "price target"),
        ("price target", 35, "raised|lowered|cut|boosted|increased|reduced|to"),
        ("maintains?", 35, ANALYST_RATING),
        ("reiterates?", 35, ANALYST_RATING),
        ("initiates?", 35, "coverage|buy|sell|hold|neutral|overweight|underweight|outperform|underperform"),
        ("analyst|broker|research firm", 80, "raises?|lowers?|cuts?|maintains?|upgrades?|downgrades?|initiates?|reiterates?"),
    ),
    "target_raise": (("raises?|raised|boosts?|boosted|increases?|increased", 45, r"(?:its\s+)?price target"), ("price target", 45, "raised|boosted|increased|higher")),
    "target_cut": (("lowers?|lowered|cuts?|cut|trims?|trimmed|reduces?|reduced", 45, r"(?:its\s+)?price target"), ("price target", 45, "lowered|cut|trimmed|reduced|lower")),
    "seasonal": (
        ("seasonal(?:ly)?", 100, "(?:heat[- ]related )?curtailment"),
        ("(?:heat[- ]related |weather[- ]related )?curtailment", 120, "seasonal|typical for this time of year"),
        ("seasonal heat[- ]related", 80, "production|curtailment|disruption"),
    ),
}
#: A target that is put to a number is both a raise and a cut of one.
TARGET_TO_NUMBER = r"(?is)\bprice target\b.{0,45}\bto\s+\$?[0-9]"


def pattern(*chain: str | int) -> str:
    """A chain's regular expression: whole terms in any case, with at most so many characters between them."""
    return "(?is)" + "".join(f".{{0,{x}}}" if isinstance(x, int) else rf"\b(?:{x})\b" for x in chain)


def any_of(text: Column, chains: tuple[tuple[str | int, ...], ...]) -> Column:
    """Whether one of the chains is in the text."""
    found = text.rlike(pattern(*chains[0]))
    for chain in chains[1:]:
        found = found | text.rlike(pattern(*chain))
    return found


def places(text: Column, regex: str) -> Column:
    """Start (from 0) and length of each match, in order: the lengths of the matches and of what lies between them, added up."""
    pairs = F.zip_with(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), F.split(text, regex, -1), lambda match, gap: F.struct(F.length(gap).alias("gap"), F.length(match).alias("size")))
    empty = F.array().cast("array<struct<start: int, size: int>>")

    def add(state: Column, pair: Column) -> Column:
        last = F.try_element_at(state, F.lit(-1))
        start = F.coalesce(last["start"] + last["size"], F.lit(0)) + pair["gap"]
        return F.concat(state, F.array(F.struct(start.alias("start"), pair["size"].alias("size"))))

    return F.aggregate(F.filter(pairs, lambda p: p["size"].isNotNull()), empty, add)


def event_mentions(texts: DataFrame) -> DataFrame:
    """Every mention of insolvency in texts (id, text): id, rule, start, size, window, and whether each context is in the window."""
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), places(F.col("text"), pattern(*chain)).alias("places")) for name, chain in MENTIONS.items()])
    found = texts.filter(any_of(F.col("text"), tuple(MENTIONS.values()))).select("id", "text", F.explode(rules).alias("r"))
    found = found.select("id", "text", "r.rule", F.explode("r.places").alias("p"))
    first = F.greatest(F.col("p.start") - BEFORE, F.lit(0))
    window = F.substring("text", first + 1, F.col("p.start") + F.col("p.size") + AFTER - first)
    out = found.select("id", "rule", "p.start", "p.size", window.alias("window"))
    return out.select("*", *[any_of(F.col("window"), chains).alias(name) for name, chains in CONTEXTS.items()])


def attributed(texts: DataFrame) -> DataFrame:
    """Per text (id, text, solvency: a flag that filings raise): existential, mentions and how many of them each context takes away, and other signals.

    A null text has no mentions; a null flag is none.
    """
    taken = F.greatest(*[F.col(c).cast("int") for c in CONTEXTS]) > 0
    counts = event_mentions(texts.select("id", "text")).groupBy("id").agg(F.count("*").alias("mentions"), F.count_if(~taken).alias("asserted"), *[F.count_if(c).alias(c) for c in CONTEXTS])
    text = F.coalesce("text", F.lit(""))
    signals = {name: any_of(text, chains) for name, chains in SIGNALS.items()}
    to_number = text.rlike(TARGET_TO_NUMBER)
    for name in ("target_raise", "target_cut"):
        signals[name] = signals["analyst_action"] & (signals[name] | to_number)
    joined = texts.withColumnRenamed("id", "of").join(counts, F.col("of") == F.col("id"), "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    existential = F.coalesce("solvency", F.lit(False)) | (n("asserted") > 0)
    return joined.select(F.col("of").alias("id"), existential.alias("existential"), n("mentions").alias("mentions"), n("asserted").alias("asserted"), *[n(c).alias(c) for c in CONTEXTS], *[c.alias(k) for k, c in signals.items()])
