"""Evidence: provenance clusters of articles and whom events are about, with their DuckDB SQL. Documents stand in for articles, their source for the candidate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attribution import AFTER, BEFORE, CONTEXTS, MENTIONS, SIGNALS, TARGET_TO_NUMBER, attributed, event_mentions, pattern
from ..operators.clusters import STOPWORDS, authority, cluster_summary, provenance_clusters, tokens_of
from ..session import load


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: the first line is the headline, an e-mail address in the text the primary record's id, the language the source's name."""
    d = load(spark, sf_dir, "documents")
    root = F.nullif(F.regexp_extract(F.coalesce("text", F.lit("")), "[a-z0-9._]+@[a-z0-9.]+", 0), F.lit(""))
    return d.select(
        F.col("source").alias("group"), F.col("doc_id").alias("position"), F.xxhash64("text").alias("id"), tokens_of(F.col("text")).alias("tokens"), tokens_of(F.split("text", "\n")[0]).alias("headline_tokens"),
        root.alias("primary_root"), root.isNotNull().alias("is_primary"), authority(F.col("lang"), root.isNotNull(), F.lit(False)).alias("authority"),
    )


def q33_evidence_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of each article, named by its founder."""
    return provenance_clusters(articles(spark, sf_dir)).select(F.col("group").alias("candidate"), "position", "founder")


def q33_cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Independent clusters of each candidate, the risk of resting on one, and the confidence they allow."""
    return cluster_summary(provenance_clusters(articles(spark, sf_dir))).withColumnRenamed("group", "candidate")


_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
_TOKENS = "list_filter(list_distinct(regexp_extract_all(lower(coalesce({}, '')), '[a-z0-9]{{3,}}')), lambda w: w NOT IN (" + _STOP + "))"
CLUSTERS = f"""art AS (
  SELECT source AS g, doc_id AS p, {_TOKENS.format("text")} AS t, {_TOKENS.format("string_split(text, chr(10))[1]")} AS h, nullif(regexp_extract(coalesce(text, ''), '[a-z0-9._]+@[a-z0-9.]+', 0), '') AS root,
         CASE WHEN nullif(regexp_extract(coalesce(text, ''), '[a-z0-9._]+@[a-z0-9.]+', 0), '') IS NOT NULL THEN 3.0 WHEN coalesce(lang, '') <> '' THEN 1.2 ELSE 0.7 END AS authority FROM documents),
tt AS (SELECT g, p, len(t) AS n, unnest(t) AS w FROM art), hh AS (SELECT g, p, len(h) AS n, unnest(h) AS w FROM art),
links AS (
  SELECT b.g, b.p AS later, a.p AS earlier FROM tt a JOIN tt b ON a.g = b.g AND a.w = b.w AND a.p < b.p GROUP BY b.g, b.p, a.p, a.n, b.n HAVING 100 * count(*) >= 70 * (a.n + b.n - count(*))
  UNION SELECT b.g, b.p, a.p FROM hh a JOIN hh b ON a.g = b.g AND a.w = b.w AND a.p < b.p GROUP BY b.g, b.p, a.p, a.n, b.n HAVING 100 * count(*) >= 82 * (a.n + b.n - count(*))
  UNION SELECT b.g, b.p, a.p FROM art a JOIN art b ON a.g = b.g AND a.root = b.root AND a.p < b.p),
reach(g, p, r) AS (SELECT g, later, earlier FROM links UNION SELECT x.g, x.p, l.earlier FROM reach x JOIN links l ON l.g = x.g AND l.later = x.r),
firsts AS (SELECT g, p, min(r) AS r FROM reach GROUP BY g, p),
named AS (SELECT art.*, coalesce(f.r, art.p) AS founder FROM art LEFT JOIN firsts f ON f.g = art.g AND f.p = art.p)"""
Q33 = f'WITH RECURSIVE {CLUSTERS} SELECT g AS candidate, p AS position, founder FROM named'
Q33S = f"""WITH RECURSIVE {CLUSTERS}, each AS (SELECT g, founder, bool_or(root IS NOT NULL) AS prim, max(authority) AS a, count(*) AS n FROM named GROUP BY g, founder),
s AS (SELECT g, sum(n)::BIGINT AS articles, max(n) AS largest, count(*) AS clusters, count(*) FILTER (prim) AS primary_clusters, count(*) FILTER (a >= 2.0) AS strong_clusters FROM each GROUP BY g)
SELECT g AS candidate, articles, largest, clusters, primary_clusters, strong_clusters, clusters - 1 AS leave_one_out, CASE clusters WHEN 1 THEN 85.0 WHEN 2 THEN 45.0 WHEN 3 THEN 20.0 ELSE 5.0 END::DOUBLE AS dependency_risk,
  CASE WHEN clusters >= 3 AND primary_clusters > 0 THEN 96.0 WHEN clusters = 1 AND primary_clusters > 0 THEN 78.0 WHEN clusters = 1 THEN 62.0 WHEN primary_clusters > 0 THEN 92.0 WHEN strong_clusters >= 2 THEN 82.0 ELSE 70.0 END::DOUBLE AS confidence_cap FROM s"""


#: The invented documents name no events, so each is followed by one of these sentences, by its id.
SENTENCES = (
    "The Company filed a voluntary petition under Chapter 11 today.", "A vendor of the Company filed for Chapter 11 last week, and orders go on.", "There is no bankruptcy filing, and the Company has not commenced insolvency proceedings; liquidation did not occur.",
    "An event of default could lead to liquidation.", "The Company was in compliance with all covenants of its credit facility, and no event of default was noted.", "There is substantial doubt about our ability to continue as a going concern.",
    "The auditor added a going concern warning. We defaulted on the interest payment due in May.", "Broker raises price target to $12 and maintains Buy.", "Seasonal heat-related curtailment lowered output, typical for this time of year.",
    "The registrant failed to make a principal payment; its customer became insolvent.", "Our business adopted a plan of liquidation.", "Nothing of note was said.", "Analyst cut the price target; shares were downgraded.",
)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.element_at(F.array(*map(F.lit, SENTENCES)), (F.pmod("doc_id", F.lit(len(SENTENCES))) + 1).cast("int"))
    return load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), said).alias("text"), (F.pmod("doc_id", F.lit(97)) == 0).alias("solvency"))


def q34_event_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mention of insolvency with its place, its rule, and what stands around it."""
    return event_mentions(texts(spark, sf_dir)).drop("window")


def q34_local_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an event is the candidate's own, for each article, and the signals of analysts and seasons."""
    return attributed(texts(spark, sf_dir))


def _has(text: str, chains: tuple) -> str:
    return "(" + " OR ".join(f"regexp_matches({text}, '{pattern(*c)}')" for c in chains) + ")"


_SAID = "CASE doc_id % " + str(len(SENTENCES)) + " " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(SENTENCES)) + " END"
_MENTIONED = f"""texts AS (SELECT doc_id AS id, coalesce(text, '') || chr(10) || {_SAID} AS text, doc_id % 97 = 0 AS solvency FROM documents),
cuts AS ({' UNION ALL '.join(f"SELECT id, text, '{name}' AS rule, regexp_extract_all(text, '{pattern(*chain)}') AS ms, string_split_regex(text, '{pattern(*chain)}') AS gs FROM texts" for name, chain in MENTIONS.items())}),
spots AS (SELECT id, text, rule, (list_sum(list_transform(gs[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:k - 1], lambda x: length(x))), 0))::INT AS start, length(ms[k])::INT AS size FROM cuts, unnest(range(1, len(ms) + 1)) AS t(k)),
windows AS (SELECT id, rule, start, size, substr(text, greatest(start - {BEFORE}, 0)::INT + 1, (start + size + {AFTER} - greatest(start - {BEFORE}, 0))::INT) AS around FROM spots),
mentions AS (SELECT id, rule, start, size, {', '.join(f'{_has("around", chains)} AS {name}' for name, chains in CONTEXTS.items())} FROM windows)"""
_ANALYST, _NUMBER = _has("text", SIGNALS["analyst_action"]), f"regexp_matches(text, '{TARGET_TO_NUMBER}')"
Q34M = f"WITH {_MENTIONED} SELECT * FROM mentions"
Q34 = f"""WITH {_MENTIONED}, c AS (SELECT id, count(*) AS mentions, count(*) FILTER (NOT ({' OR '.join(CONTEXTS)})) AS asserted, {', '.join(f'count(*) FILTER ({c}) AS {c}' for c in CONTEXTS)} FROM mentions GROUP BY id)
SELECT t.id, t.solvency OR coalesce(asserted, 0) > 0 AS existential, coalesce(mentions, 0) AS mentions, coalesce(asserted, 0) AS asserted, {', '.join(f'coalesce({c}, 0) AS {c}' for c in CONTEXTS)}, {_ANALYST} AS analyst_action,
  {_ANALYST} AND ({_has("text", SIGNALS["target_raise"])} OR {_NUMBER}) AS target_raise, {_ANALYST} AND ({_has("text", SIGNALS["target_cut"])} OR {_NUMBER}) AS target_cut, {_has("text", SIGNALS["seasonal"])} AS seasonal FROM texts t LEFT JOIN c USING (id)"""

_SQL = {"q33_evidence_clusters": Q33, "q33_cluster_summary": Q33S, "q34_event_mentions": Q34M, "q34_local_attribution": Q34}
QUERIES = {name: globals()[name] for name in _SQL}
ORACLES = _SQL
