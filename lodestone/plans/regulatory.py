"""Trials and recalls of issuers from landed JSON, with their DuckDB SQL. Suppliers stand in for issuers, their line items for recalls and trials."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.regulatory import LEAST_LENGTH, LEGAL_FORMS, issuer_aliases, recall_records, trial_records
from ..session import load

#: Records of later days are not known yet.
CUTOFF_SQL = "(SELECT max(CAST(l_shipdate AS DATE)) - 365 FROM lineitem)"


def _cutoff(spark: SparkSession, sf_dir: str):
    return F.lit(load(spark, sf_dir, "lineitem").agg(F.date_sub(F.max(F.col("l_shipdate").cast("date")), 365).cast("string")).first()[0]).cast("date")


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed submissions: every third supplier had another name until 1995."""
    s = load(spark, sf_dir, "supplier")
    old = F.struct(F.concat(F.lit("Old "), "s_name", F.lit(" Holdings")).alias("name"), F.lit("1990-01-01").alias("from"), F.lit("1995-12-31T00:00:00Z").alias("to"))
    doc = F.to_json(F.struct(F.concat("s_name", F.lit(", Inc.")).alias("name"), F.when(F.col("s_suppkey") % 3 == 0, F.array(old)).alias("formerNames")))
    return issuer_aliases(s.select(F.concat(F.lit("S"), "s_suppkey").alias("symbol"), F.try_parse_json(doc).alias("doc")))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the name under which their supplier is written."""
    line, s = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "supplier")
    kind = F.col("l_orderkey") % 4
    firm = F.when(kind == 0, F.upper(F.concat("s_name", F.lit(" CORP.")))).when(kind == 1, F.concat("s_name", F.lit(" & Co"))).when(kind == 2, F.concat(F.lit("old "), "s_name")).otherwise(F.col("s_name"))
    return line.join(s, F.col("l_suppkey") == F.col("s_suppkey")).withColumn("firm", firm).withColumn("shipped", F.col("l_shipdate").cast("date"))


def q53_recall_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recalls: returned line items, landed as one document an order."""
    x = _lines(spark, sf_dir).filter("l_returnflag = 'R'")
    one = F.struct(
        F.col("firm").alias("recalling_firm"), F.date_format("shipped", "yyyyMMdd").alias("report_date"), F.when(F.col("l_linenumber") % 2 == 1, F.concat_ws("-", F.lit("R"), "l_orderkey", "l_linenumber")).alias("recall_number"),
        F.concat_ws("-", F.lit("E"), "l_orderkey").alias("event_id"), F.when(F.col("l_tax") > 0, F.concat(F.lit("Class "), F.col("l_linenumber").cast("string"))).alias("classification"), F.lit("Ongoing").alias("status"),
    )
    landed = x.groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(one).alias("results"))).alias("payload"))
    return recall_records(landed, aliases(spark, sf_dir), _cutoff(spark, sf_dir)).select("symbol", "external_id", "firm", "issuer_name", "public", "classification", "status", "reason_for_recall", "name_current")


def q59_trial_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials: large line items, landed as deep documents, the six newest of each issuer."""
    x = _lines(spark, sf_dir).filter("l_quantity >= 45")
    study = F.struct(F.struct(
        F.struct(F.concat(F.lit("NCT"), F.col("l_orderkey").cast("string")).alias("nctId")).alias("identificationModule"), F.struct(F.struct(F.col("firm").alias("name")).alias("leadSponsor")).alias("sponsorCollaboratorsModule"),
        F.struct(F.when(F.col("l_linestatus") == "O", "RECRUITING").otherwise("COMPLETED").alias("overallStatus"), F.struct(F.date_format("shipped", "yyyy-MM-dd").alias("date")).alias("lastUpdatePostDateStruct")).alias("statusModule"),
        F.struct(F.when(F.col("l_linenumber") > 2, F.array(F.lit("PHASE1"), F.lit("PHASE2"))).alias("phases")).alias("designModule"),
    ).alias("protocolSection"))
    landed = x.groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(study).alias("studies"))).alias("payload"))
    return trial_records(landed, aliases(spark, sf_dir), _cutoff(spark, sf_dir)).select("symbol", "external_id", "firm", "issuer_name", "public", "status", "phases", "name_current")


def _clean(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(replace(lower({c}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'), '\b(?:{LEGAL_FORMS})\b', ' ', 'g'), ' +', ' ', 'g'))"


_BASE = rf"""named AS (SELECT 'S' || s_suppkey AS symbol, s_suppkey, 0 AS place, s_name || ', Inc.' AS name, NULL::DATE AS a, NULL::DATE AS b FROM supplier UNION ALL SELECT 'S' || s_suppkey, s_suppkey, 1, 'S' || s_suppkey, NULL, NULL FROM supplier
  UNION ALL SELECT 'S' || s_suppkey, s_suppkey, 2, 'Old ' || s_name || ' Holdings', DATE '1990-01-01', DATE '1995-12-31' FROM supplier WHERE s_suppkey % 3 = 0),
aliases AS (SELECT symbol, name, a, b, {_clean('name')} AS alias FROM named WHERE length({_clean('name')}) >= {LEAST_LENGTH} QUALIFY row_number() OVER (PARTITION BY symbol, alias ORDER BY place) = 1),
lines AS (SELECT *, CAST(l_shipdate AS DATE) AS shipped, CASE l_orderkey % 4 WHEN 0 THEN upper(s_name || ' CORP.') WHEN 1 THEN s_name || ' & Co' WHEN 2 THEN 'old ' || s_name ELSE s_name END AS firm FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
met AS (SELECT l.*, symbol, name AS issuer_name, (a IS NULL OR shipped >= a) AND (b IS NULL OR shipped <= b) AS name_current FROM lines l JOIN aliases ON alias = {_clean('firm')} WHERE shipped < {CUTOFF_SQL})"""
_SQL = {
    "q53_recall_records": f"""WITH {_BASE}, r AS (SELECT *, CASE WHEN l_linenumber % 2 = 1 THEN 'R-' || l_orderkey || '-' || l_linenumber ELSE 'E-' || l_orderkey END AS external_id, CASE WHEN l_tax > 0 THEN 'Class ' || l_linenumber ELSE 'not stated' END AS classification FROM met WHERE l_returnflag = 'R')
SELECT symbol, external_id, firm, issuer_name, shipped AS public, classification, 'Ongoing' AS status, 'not stated' AS reason_for_recall, name_current FROM r QUALIFY row_number() OVER (PARTITION BY symbol, external_id ORDER BY shipped DESC, classification, firm) = 1""",
    "q59_trial_records": f"""WITH {_BASE}, t AS (SELECT *, 'NCT' || l_orderkey AS external_id, CASE WHEN l_linestatus = 'O' THEN 'RECRUITING' ELSE 'COMPLETED' END AS status, CASE WHEN l_linenumber > 2 THEN 'PHASE1/PHASE2' ELSE '' END AS phases FROM met WHERE l_quantity >= 45),
o AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY symbol, external_id ORDER BY shipped DESC, status, phases, firm) = 1)
SELECT symbol, external_id, firm, issuer_name, shipped AS public, status, phases, name_current FROM o QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY shipped DESC, external_id) <= 6""",
}
QUERIES = {name: globals()[name] for name in _SQL}
ORACLES = _SQL
