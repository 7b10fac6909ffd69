"""Regulatory records of issuers: landed JSON documents as VARIANT, matched by normalised current and former names.

Documents keep their shape until a path is asked for, so a payload with more or fewer fields is no other table. An issuer's names make
a list of aliases, a record's firm or sponsor another; both meet in one equality join on the normalised name, whatever
the number of issuers. A record counts if it was public strictly before the cut-off date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of a company's legal form, the least length of a name that may match, and the most names of an issuer (fixed values).
LEGAL_FORMS = "incorporated|inc|corporation|corp|company|co|limited|ltd|plc|llc|lp|holdings?|group|ordinary shares?|common stock|class [a-z]"
LEAST_LENGTH, MOST_ALIASES = 4, 8


def normalised_name(name: Column) -> Column:
    """Lower case, "&" as "and", letters and digits alone, without words of legal form; empty for null."""
    text = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "&", " and ")
    text = F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", " "), rf"\b(?:{LEGAL_FORMS})\b", " ")
    return F.trim(F.regexp_replace(text, " +", " "))


def document(payload: Column) -> Column:
    """Landed JSON text as VARIANT; null for what is no JSON."""
    return F.try_parse_json(payload)


def at(doc: Column, path: str, kind: str = "string") -> Column:
    """The value at a path such as a.b[0].c; null where there is none of this kind."""
    return F.try_variant_get(doc, "$" + (f".{path}" if path else ""), kind)


def has_key(doc: Column, key: str) -> Column:
    """Whether an object has the key, be its value null."""
    return at(doc, key, "variant").isNotNull()


def contains(doc: Column, **values: str | int | bool) -> Column:
    """Whether an object holds all these values at its keys."""
    found = F.lit(True)
    for key, value in values.items():
        kind = "boolean" if isinstance(value, bool) else "bigint" if isinstance(value, int) else "string"
        found = found & F.coalesce(at(doc, key, kind) == F.lit(value), F.lit(False))
    return found


def day(text: Column) -> Column:
    """A date written as 20240131, or as an ISO date or its beginning; null otherwise."""
    dashed = F.when(text.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))).otherwise(F.regexp_extract(text, r"^\d{4}-\d{2}-\d{2}", 0))
    return F.try_to_date(dashed, "yyyy-MM-dd")


def issuer_aliases(submissions: DataFrame) -> DataFrame:
    """(symbol, alias, name, valid_from, valid_to) of issuers (symbol, doc: VARIANT with name and formerNames): the current name first, then the symbol, then former names in order."""
    former = F.coalesce(at(F.col("doc"), "formerNames", "array<variant>"), F.array().cast("array<variant>"))
    nothing = F.lit(None).cast("date")
    entry = lambda name, a, b: F.struct(name.alias("name"), a.alias("valid_from"), b.alias("valid_to"))
    own = F.array(entry(at(F.col("doc"), "name"), nothing, nothing), entry(F.col("symbol"), nothing, nothing))
    names = F.concat(own, F.transform(former, lambda v: entry(at(v, "name"), day(at(v, "from")), day(at(v, "to")))))
    x = submissions.select("symbol", F.posexplode(names).alias("place", "n")).select("symbol", "place", "n.*").withColumn("alias", normalised_name(F.col("name")))
    x = x.filter(F.length("alias") >= LEAST_LENGTH)
    first = x.withColumn("k", F.row_number().over(Window.partitionBy("symbol", "alias").orderBy("place"))).filter("k = 1")
    return first.withColumn("k", F.row_number().over(Window.partitionBy("symbol").orderBy("place"))).filter(F.col("k") <= MOST_ALIASES).select("symbol", "alias", F.trim("name").alias("name"), "valid_from", "valid_to")


def _matched(records: DataFrame, aliases: DataFrame, cutoff: Column) -> DataFrame:
    """Records (firm, public, external_id, ...) of known issuers, public before the cut-off; name_current tells whether the name was valid on that day."""
    named = records.withColumn("alias", normalised_name(F.col("firm"))).filter((F.col("public") < cutoff) & (F.length("alias") >= LEAST_LENGTH))
    met = named.join(aliases.withColumnRenamed("name", "issuer_name"), "alias")
    inside = (F.col("valid_from").isNull() | (F.col("public") >= F.col("valid_from"))) & (F.col("valid_to").isNull() | (F.col("public") <= F.col("valid_to")))
    return met.withColumn("name_current", inside).drop("alias", "valid_from", "valid_to")


def recall_records(landed: DataFrame, aliases: DataFrame, cutoff: Column) -> DataFrame:
    """Enforcement records of landed documents (payload: JSON with results): one row per issuer and recall.

    A recall's number is its recall_number, else its event_id, else a hash of the record; of equal ones of an issuer the latest report stays.
    """
    r = landed.select(F.explode(at(document(F.col("payload")), "results", "array<variant>")).alias("r"))
    number = F.coalesce(F.nullif(at(F.col("r"), "recall_number"), F.lit("")), F.nullif(at(F.col("r"), "event_id"), F.lit("")), F.substring(F.sha2(F.to_json("r"), 256), 1, 20))
    said = lambda key: F.coalesce(F.nullif(at(F.col("r"), key), F.lit("")), F.lit("not stated"))
    records = r.select(at(F.col("r"), "recalling_firm").alias("firm"), day(at(F.col("r"), "report_date")).alias("public"), number.alias("external_id"), *[said(k).alias(k) for k in ("classification", "status", "reason_for_recall")])
    met = _matched(records, aliases, cutoff)
    latest = Window.partitionBy("symbol", "external_id").orderBy(F.col("public").desc(), "classification", "status", "reason_for_recall", "firm")
    return met.withColumn("k", F.row_number().over(latest)).filter("k = 1").drop("k")


def trial_records(landed: DataFrame, aliases: DataFrame, cutoff: Column, most: int = 6) -> DataFrame:
    """Sponsors' trials of landed documents (payload: JSON with studies): the newest ones of each issuer, by the last update that was public."""
    s = landed.select(F.explode(at(document(F.col("payload")), "studies", "array<variant>")).alias("s"))
    section = lambda path, kind="string": at(F.col("s"), f"protocolSection.{path}", kind)
    records = s.select(
        section("sponsorCollaboratorsModule.leadSponsor.name").alias("firm"), day(section("statusModule.lastUpdatePostDateStruct.date")).alias("public"), section("identificationModule.nctId").alias("external_id"),
        section("statusModule.overallStatus").alias("status"), F.array_join(F.coalesce(section("designModule.phases", "array<string>"), F.array().cast("array<string>")), "/").alias("phases"),
    ).filter(F.coalesce("external_id", F.lit("")) != "")
    met = _matched(records, aliases, cutoff)
    once = met.withColumn("k", F.row_number().over(Window.partitionBy("symbol", "external_id").orderBy(F.col("public").desc(), "status", "phases", "firm"))).filter("k = 1")
    newest = Window.partitionBy("symbol").orderBy(F.col("public").desc(), "external_id")
    return once.withColumn("k", F.row_number().over(newest)).filter(F.col("k") <= most).drop("k")
