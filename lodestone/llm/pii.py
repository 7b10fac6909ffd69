"""Operator 6, PII: format-preserving Feistel pseudonyms, by DataFrame functions alone.

Values are found by one pattern, validated by kind, and replaced by a keyed permutation of the same format, so
equal values have equal pseudonyms in all documents, and different values of a kind and format different ones:

email   the local part's letters and digits (the domain stays); a local part with letters beyond ASCII becomes digits and
        letters a to f of a keyed hash, at least 16 of them
phone   the digits after the country code, whatever stands between them, so that a number's spellings stay linked; of a
        national number, which begins with its area code in brackets, all digits
ipv4    the 32-bit address (each part at most 255)
card    13 to 19 digits that pass the Luhn check; the check digit is made anew, so the pseudonym passes too
number  13 to 19 digits that don't
date    a calendar date of 1900 to 2099, as 2024-05-31, 31/05/2024 or 31.05.2024; the pseudonym is such a date
secret  32 to 64 hexadecimal digits

A Feistel network swaps and shifts the two halves of a value in eight rounds under sha2(key, kind, round, half);
every round can be undone, so the whole is a permutation. Dates are numbered by day, and 73,049 = 17 x 4,297 days
give the halves. Values that fail their validation stay as they are.

Defined cases: a null text stays null, with no values; an empty text stays empty; rows that repeat are treated
alike; an empty table gives an empty table; input columns called n_values or kinds are replaced. A run of
letters or digits of any length is passed in linear time, as every pattern is anchored and bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import inner, without

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
PHONE = r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d(])\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}(?!\d)"
#: Country codes of one and of two digits; all others have three.
COUNTRY_CODE = r"^(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
IPV4 = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
DATE = r"(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?!\d)"
SECRET = r"(?<![0-9A-Za-z])(?=[0-9]{0,63}[A-Fa-f])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])"
NUMBER = r"(?<!\d)(?:\d[ -]?){12,18}\d(?!\d)"
ANY = "|".join((EMAIL, PHONE, IPV4, DATE, SECRET, NUMBER))
DAYS, DAY_ROWS, DAY_COLUMNS = 73_049, 17, 4_297
ROUNDS = 8


def _digest(key: str, kind: str, i: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), half), 256)


def permute_text(value: Column, key: str, kind: str, letters: int = 26) -> Column:
    """The string with its ASCII digits and its first so many letters permuted within their class; the rest stays."""
    cut = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), cut).alias("l"), F.substring(value, cut + 1, F.length(value)).alias("r"))

    def shift(half: Column, digest: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            by = F.conv(F.substring(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            code = F.ascii(c)
            turn = lambda base, n: F.char(F.lit(base) + (code - base + by) % n)
            within = lambda base, n: (code >= base) & (code < base + n) & (F.octet_length(c) == 1)
            return F.when(within(48, 10), turn(48, 10)).when(within(97, letters), turn(97, letters)).when(within(65, letters), turn(65, letters)).otherwise(c)

        return F.array_join(F.transform(F.filter(F.split(half, ""), lambda c: c != ""), one), "")

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda acc, i: F.struct(acc["r"].alias("l"), shift(acc["l"], _digest(key, kind, i, acc["r"])).alias("r")))
    return F.concat(done["l"], done["r"])


def permute_number(number: Column, rows: int, columns: int, key: str, kind: str) -> Column:
    """A permutation of 0 .. rows * columns - 1."""
    start = F.struct(F.floor(number / columns).cast("long").alias("a"), F.pmod(number, F.lit(columns)).cast("long").alias("b"))

    def turn(acc: Column, i: Column) -> Column:
        by = F.conv(F.substring(_digest(key, kind, i, acc["b"].cast("string")), 1, 14), 16, 10).cast("long")
        return F.struct(acc["b"].alias("a"), F.pmod(acc["a"] + by, F.when(i % 2 == 1, F.lit(rows)).otherwise(F.lit(columns)).cast("long")).alias("b"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)
    return done["a"] * columns + done["b"]


def luhn_digit(payload: Column) -> Column:
    """The check digit that follows these digits."""

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(payload, -i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    total = F.aggregate(F.sequence(F.lit(1), F.length(payload)), F.lit(0), add)
    return ((F.lit(10) - total % 10) % 10).cast("string")


def with_digits(value: Column, digits: Column) -> Column:
    """The value with its digits replaced, in order, and everything else kept."""
    at = lambda i: F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), r"\D", ""))
    return F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c, i: F.when(c.rlike(r"^\d$"), F.substring(digits, at(i), F.lit(1))).otherwise(c)), "")


def _date(value: Column) -> Column:
    iso = F.when(value.rlike("^....-"), value).otherwise(F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2)))
    return F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date")


def kind_of(value: Column) -> Column:
    """The value's kind if it is valid, else null."""
    digits = F.regexp_replace(value, r"\D", "")
    parts = F.split(value, r"\.")
    return (
        F.when(value.contains("@"), F.lit("email"))
        .when(value.rlike(r"^[+(]"), F.lit("phone"))
        .when(value.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$"), F.when(F.forall(parts, lambda p: p.cast("int") <= 255), F.lit("ipv4")))
        .when(value.rlike(f"^(?:{DATE})$"), F.when(F.year(_date(value)).between(1900, 2099), F.lit("date")))
        .when(value.rlike("[A-Fa-f]"), F.lit("secret"))
        .when(F.call_function("luhn_check", digits), F.lit("card"))
        .otherwise(F.lit("number"))
    )


def pseudonym(value: Column, key: str) -> Column:
    """The value's pseudonym, or the value itself if it is not valid."""
    kind, digits = kind_of(value), F.regexp_replace(value, r"\D", "")
    local = F.substring_index(value, "@", 1)
    hashed = F.substring(_digest(key, "email", F.lit(0), local), F.lit(1), F.greatest(F.lit(16), F.length(local)))
    local = F.when(local.rlike(r"[^\x00-\x7F]"), hashed).otherwise(permute_text(local, key, "email"))
    email = F.concat(local, F.substring(value, F.instr(value, "@"), F.length(value)))
    code = F.when(value.startswith("+"), F.regexp_extract(digits, COUNTRY_CODE, 0)).otherwise("")
    phone = with_digits(value, F.concat(code, permute_text(F.substring(digits, F.length(code) + 1, F.length(digits)), key, "phone")))
    octet = lambda n, i: F.pmod(F.shiftright(n, 24 - 8 * i), F.lit(256)).cast("string")
    address = F.aggregate(F.split(value, r"\."), F.lit(0).cast("long"), lambda acc, p: acc * 256 + p.cast("long"))
    moved = permute_number(address, 65536, 65536, key, "ipv4")
    ipv4 = F.concat_ws(".", *[octet(moved, i) for i in range(4)])
    day = F.date_add(F.lit("1900-01-01").cast("date"), permute_number(F.datediff(_date(value), F.lit("1900-01-01").cast("date")).cast("long"), DAY_ROWS, DAY_COLUMNS, key, "date").cast("int"))
    date = F.when(value.contains("-"), F.date_format(day, "yyyy-MM-dd")).when(value.contains("/"), F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "dd.MM.yyyy"))
    payload = permute_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    return (
        F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "ipv4", ipv4).when(kind == "date", date)
        .when(kind == "secret", permute_text(value, key, "secret", letters=6))
        .when(kind == "card", with_digits(value, F.concat(payload, luhn_digit(payload))))
        .when(kind == "number", with_digits(value, permute_text(digits, key, "number")))
        .otherwise(value)
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Replace the values in each text; adds n_values (how many were replaced) and kinds (sorted, distinct)."""
    at = inner(docs)
    text = F.col(f"`{text_col}`")
    may = F.coalesce(text.rlike("[0-9@]"), F.lit(False))
    found = docs.select(*without(docs, "n_values", "kinds"), F.when(may, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).alias(f"{at}found"))
    has = F.size(f"{at}found") > 0
    between = F.split(text, ANY, -1)
    names = F.transform(f"{at}found", lambda v: F.struct(pseudonym(v, key).alias("to"), kind_of(v).alias("kind")))
    done = found.withColumn(f"{at}to", F.when(has, names))
    joined = F.array_join(F.zip_with(between, F.col(f"{at}to.to"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    kinds = F.filter(F.col(f"{at}to.kind"), lambda k: k.isNotNull())
    return done.select(
        *[F.when(has, joined).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_values", "kinds")],
        F.coalesce(F.when(has, F.size(kinds)), F.lit(0)).cast("long").alias("n_values"),
        F.coalesce(F.when(has, F.array_sort(F.array_distinct(kinds))), F.array().cast("array<string>")).alias("kinds"),
    )
