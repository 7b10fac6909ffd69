"""Issuer names, VARIANT paths, recalls and trials."""

import datetime as dt
import json

from pyspark.sql import functions as F

from lodestone.operators.regulatory import at, contains, day, document, has_key, issuer_aliases, normalised_name, recall_records, trial_records

DAY = dt.date


def test_names(spark):
    names = {"Acme & Sons, Inc.": "acme and sons", "THE Widget-Co (Holdings) PLC": "the widget", "Bio Group Class A Common Stock": "bio", "Incline": "incline", "": "", None: "", "co": ""}
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", normalised_name(F.col("n")).alias("c")).collect()
    assert {r["n"]: r["c"] for r in got} == names


def test_paths_and_days(spark):
    doc = {"a": {"b": [1, {"c": "x"}]}, "none": None, "n": 7, "flag": True}
    df = spark.createDataFrame([(json.dumps(doc),), ("not json",), (None,)], "p string").select(document(F.col("p")).alias("d"))
    got = df.select(at(F.col("d"), "a.b[1].c"), at(F.col("d"), "n", "long"), at(F.col("d"), "a", "int"), has_key(F.col("d"), "none"), has_key(F.col("d"), "gone"), contains(F.col("d"), n=7, flag=True), contains(F.col("d"), n=8)).collect()
    assert tuple(got[0]) == ("x", 7, None, True, False, True, False) and tuple(got[1])[:3] == (None, None, None) and not got[1][5]
    days = spark.createDataFrame([("20240131",), ("2024-01-31T10:00:00Z",), ("20241331",), ("soon",), (None,)], "t string").select(day(F.col("t")))
    assert [r[0] for r in days.collect()] == [DAY(2024, 1, 31), DAY(2024, 1, 31), None, None, None]


def issuers(spark):
    docs = [("ACME", {"name": "Acme Labs Inc", "formerNames": [{"name": "Zeta Bio Corp", "from": "2001-01-01", "to": "2010-12-31"}, {"name": "ACME LABS LLC"}, {"name": "Co"}]}), ("NONE", {"name": None}), ("BAD", None)]
    return spark.createDataFrame([(s, None if d is None else json.dumps(d)) for s, d in docs], "symbol string, p string").select("symbol", document(F.col("p")).alias("doc"))


def test_aliases(spark):
    got = sorted((r["symbol"], r["alias"], r["name"], r["valid_to"]) for r in issuer_aliases(issuers(spark)).collect())
    assert got == [("ACME", "acme", "ACME", None), ("ACME", "acme labs", "Acme Labs Inc", None), ("ACME", "zeta bio", "Zeta Bio Corp", DAY(2010, 12, 31)), ("NONE", "none", "NONE", None)]


def test_recalls(spark):
    rows = [
        {"recalling_firm": "ACME LABS, INC.", "report_date": "20240110", "recall_number": "R1", "classification": "Class II"},
        {"recalling_firm": "Acme Labs", "report_date": "20240112", "recall_number": "R1", "classification": "Class I"},
        {"recalling_firm": "Zeta Bio", "report_date": "2009-05-05", "event_id": "E9"},
        {"recalling_firm": "Zeta Bio", "report_date": "20200505"},
        {"recalling_firm": "Acme Labs", "report_date": "20240201", "recall_number": "TODAY"},
        {"recalling_firm": "Acme Laboratories", "report_date": "20240101", "recall_number": "OTHER"},
        {"recalling_firm": None, "report_date": "20240101"},
    ]
    landed = spark.createDataFrame([(json.dumps({"results": rows}),), ("{}",), ("broken",), (None,)], "payload string")
    got = recall_records(landed, issuer_aliases(issuers(spark)), F.lit("2024-02-01").cast("date")).collect()
    assert sorted((r["public"], r["classification"], r["name_current"]) for r in got) == [(DAY(2009, 5, 5), "not stated", True), (DAY(2020, 5, 5), "not stated", False), (DAY(2024, 1, 12), "Class I", True)]
    assert {r["external_id"] for r in got} >= {"R1", "E9"} and all(r["symbol"] == "ACME" for r in got)


def test_trials(spark):
    study = lambda k, day, name="Acme Labs": {"protocolSection": {"identificationModule": {"nctId": f"N{k}"}, "sponsorCollaboratorsModule": {"leadSponsor": {"name": name}}, "statusModule": {"overallStatus": "RECRUITING", "lastUpdatePostDateStruct": {"date": day}}, "designModule": {"phases": ["PHASE2", "PHASE3"]}}}
    studies = [study(k, f"2024-01-{k + 1:02}") for k in range(9)] + [study(3, "2023-01-01"), study(50, "2024-03-01"), study(51, "2024-01-01", "Other"), {"protocolSection": {}}]
    landed = spark.createDataFrame([(json.dumps({"studies": studies}),)], "payload string")
    got = trial_records(landed, issuer_aliases(issuers(spark)), F.lit("2024-02-01").cast("date")).collect()
    assert sorted(r["external_id"] for r in got) == ["N3", "N4", "N5", "N6", "N7", "N8"] and {r["phases"] for r in got} == {"PHASE2/PHASE3"}
    assert trial_records(landed.limit(0), issuer_aliases(issuers(spark)), F.lit("2024-02-01").cast("date")).collect() == []
