"""URL filters, line dedup, decontamination and pseudonyms against plain Python, with odd inputs."""

import datetime
import hashlib
import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from lodestone.llm.decontaminate import cut_spans, find_contamination, merge_spans, remove_contamination, words_of
from lodestone.llm.line_dedup import drop_shared_lines
from lodestone.llm.pii import ANY, DAY_COLUMNS, DAY_ROWS, DAYS, permute_number, pseudonymise
from lodestone.llm.queries import URL_RULES
from lodestone.llm.url_filter import filter_urls


def judge(url):
    host, path = "", ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    fits = [(len(r), a, r) for a, r in URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_urls_match_plain_rules(spark):
    urls = ["http://a.example.com/en/1?x", "https://WWW.Example.com/en/", "http://example.com/enx", "http://example.com", "ftp://b.net/es/a#t", "http://net/es/", "http://xnet/es/", "no scheme", "", None,
            "http://é.NET/fr/É", "x://y://z.com/", "http://com/", "http://a.b.net/fr", "http://user@b.com:80/x\ny", "http://b.com/" + "a/" * 5000]
    rows = [(i, u, "kept", "b", "t") for i, u in enumerate(urls * 2)]
    judged = filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string, best string, token string"), URL_RULES)
    assert judged.columns == ["page_id", "url", "best", "token", "host", "path", "rule", "verdict"]
    out = {(r["page_id"], r["verdict"], r["host"], r["path"], r["rule"]) for r in judged.collect()}
    assert out == {(i, v, h, p, r) for i, u, *_ in rows for h, p, r, v in [judge(u)]}
    assert {r["verdict"] for r in filter_urls(judged.select("url"), []).collect()} == {"allow"}
    assert filter_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0


def test_url_wildcards_and_ties(spark):
    rules = [("block", "a.com/x*y/"), ("allow", "b.com/p"), ("block", "b.com/p")]
    got = dict(filter_urls(spark.createDataFrame([("http://a.com/x12y/z",), ("http://a.com/x/",), ("http://b.com/pq",)], "url string"), rules).select("url", "verdict").collect())
    assert got == {"http://a.com/x12y/z": "block", "http://a.com/x/": "allow", "http://b.com/pq": "block"}


def brute_lines(docs):
    key = lambda line: re.sub("[A-Z]", lambda c: c[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= 20 and len(held[key(x)] - {None}) >= 3 and i != max(held[key(x)] - {None}))]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def test_lines_match_brute_force(spark):
    rng = random.Random(3)
    pool = ["a shared line that is long %d" % i for i in range(6)] + ["short", "", "  A SHARED line that is long 1\t", "É long line with É letters 1", "é long line with É letters 1", "x" * 20, " " * 30 + "y" * 19]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(40)] + [(50, None), (51, ""), (None, pool[0] + "\n" + pool[1]), (3, pool[2]), (60, "\n".join(pool * 300))]
    docs += docs[:2]
    frame = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, n_lines int")
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in drop_shared_lines(frame).collect()), key=str)
    assert got == brute_lines(docs)
    assert drop_shared_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_contamination_of_very_long_texts(spark):
    item = " ".join(f"i{n}" for n in range(12))
    text = "w " * 300_000 + item + " v" * 200_000
    row = find_contamination(spark.createDataFrame([(1, text, 0)], "doc_id long, text string, `a.b` int"), spark.createDataFrame([("q", item)], "item_id string, text string")).first()
    assert row["n_words"] == 500_012 and row["n_hit"] == 12 and [tuple(x) for x in row["spans"]] == [(300_000, 300_012)]


def brute_hits(text, items, window=10):
    words, hit, found = words_of(text), set(), set()
    for name, t in items:
        item = words_of(t)
        for w in [item[i : i + window] for i in range(max(1, len(item) - window + 1))] if item else []:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    found.add(name)
    return len(words), sorted(hit), sorted(found)


@pytest.mark.parametrize("options", [{}, {"shard_symbols": 50}, {"block_bytes": 60}])
def test_contamination_matches_brute_force(spark, options):
    rng = random.Random(5)
    vocabulary = ["the", "of", "Éa", "x1", "b", "c"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(i), text(rng.choice([1, 3, 9, 10, 12, 25]))) for i in range(12)] + [("20", "!!"), ("21", None), ("0", text(11))]
    items = [(n, t) for n, t in items if t is None or len(words_of(t)) != 1]
    docs = [(i, text(rng.randint(0, 60)) + " zz " + (rng.choice(items)[1] or "") + ", " + text(5)) for i in range(40)] + [(40, None), (41, ""), (42, "foreign words only"), (None, items[0][1]), (1, "again " + (items[1][1] or ""))]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items + [(None, "the of the of")], "item_id string, text string")
    got = sorted(((r["doc_id"], r["text"], r["n_words"], r["n_hit"], [w for s in r["spans"] for w in range(s["start"], s["stop"])], r["items"]) for r in find_contamination(frame, bench, **options).collect()), key=str)
    want = []
    for i, t in docs:
        n, hit, found = brute_hits(t, [x for x in items if x[1]])
        want.append((i, t, n, len(hit), hit, found))
    assert got == sorted(want, key=str)
    cleaned = remove_contamination(frame, bench, **options)
    assert [r["text"] for r in cleaned.filter("doc_id = 42").collect()] == ["foreign words only"]
    assert find_contamination(frame.limit(0), bench, **options).count() == 0 and find_contamination(frame, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_spans(spark):
    assert cut_spans("One, two three! four", [{"start": 1, "stop": 3}]) == "One, ! four"
    spans = spark.createDataFrame([([(4, 6), (0, 2), (1, 3), (6, 7)],)], "s array<struct<start:int,stop:int>>")
    assert [tuple(x) for x in spans.select(merge_spans(F.col("s"))).first()[0]] == [(0, 3), (4, 7)]


def plain_shift(half, digest, letters):
    out = []
    for i, c in enumerate(half):
        by = int(digest[i % 32 * 2 :][:2], 16)
        for base, n in ((48, 10), (97, letters), (65, letters)):
            if base <= ord(c) < base + n:
                c = chr(base + (ord(c) - base + by) % n)
                break
        out.append(c)
    return "".join(out)


def plain_permute(value, key, kind, letters=26):
    cut = len(value) // 2
    left, right = value[:cut], value[cut:]
    for i in range(1, 9):
        digest = hashlib.sha256(f"{key}|{kind}|{i}|{right}".encode()).hexdigest()
        left, right = right, plain_shift(left, digest, letters)
    return left + right


def plain_number(number, rows, columns, key, kind):
    a, b = divmod(number, columns)
    for i in range(1, 9):
        by = int(hashlib.sha256(f"{key}|{kind}|{i}|{b}".encode()).hexdigest()[:14], 16)
        a, b = b, (a + by) % (rows if i % 2 else columns)
    return a * columns + b


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def refill(value, digits):
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in value)


def plain_value(value, key):
    """(kind or None, pseudonym) of one value, by plain rules."""
    digits = re.sub(r"\D", "", value)
    if "@" in value:
        local, domain = value.split("@")
        if local.isascii():
            return "email", plain_permute(local, key, "email") + "@" + domain
        return "email", hashlib.sha256(f"{key}|email|0|{local}".encode()).hexdigest()[: max(16, len(local))] + "@" + domain
    if value[0] in "+(":
        two = {20, 27, 30, 31, 32, 33, 34, 36, 39, 40, 41, *range(43, 50), *range(51, 59), *range(60, 67), 81, 82, 84, 86, *range(90, 96), 98}
        n = 0 if value[0] == "(" else 1 if digits[0] in "17" else 2 if int(digits[:2]) in two else 3
        return "phone", refill(value, digits[:n] + plain_permute(digits[n:], key, "phone"))
    if re.fullmatch(r"(\d{1,3}\.){3}\d{1,3}", value):
        parts = [int(x) for x in value.split(".")]
        if max(parts) > 255:
            return None, value
        moved = plain_number(int.from_bytes(bytes(parts)), 65536, 65536, key, "ipv4")
        return "ipv4", ".".join(map(str, moved.to_bytes(4)))
    for form, pattern in (("%Y-%m-%d", r"\d{4}-\d\d-\d\d"), ("%d/%m/%Y", r"\d\d/\d\d/\d{4}"), ("%d.%m.%Y", r"\d\d\.\d\d\.\d{4}")):
        if re.fullmatch(pattern, value):
            try:
                day = datetime.datetime.strptime(value, form).date()
            except ValueError:
                return None, value
            if not 1900 <= day.year <= 2099:
                return None, value
            moved = datetime.date(1900, 1, 1) + datetime.timedelta(plain_number((day - datetime.date(1900, 1, 1)).days, DAY_ROWS, DAY_COLUMNS, key, "date"))
            return "date", moved.strftime(form)
    if re.search("[A-Fa-f]", value):
        return "secret", plain_permute(value, key, "secret", 6)
    if luhn(digits):
        payload = plain_permute(digits[:-1], key, "card")
        return "card", refill(value, payload + next(c for c in "0123456789" if luhn(payload + c)))
    return "number", refill(value, plain_permute(digits, key, "number"))


def plain_text(text, key):
    kinds = []

    def one(m):
        kind, to = plain_value(m[0], key)
        kinds.append(kind)
        return to

    out = regex.sub(ANY, one, text or "")
    found = [k for k in kinds if k]
    return (None if text is None else out), len(found), sorted(set(found))


def test_pseudonyms_match_plain_python(spark):
    rng = random.Random(12)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    values = ["jane.doe%d@mail.example.com", "JÖRG.%d@example.org", "x_%d+tag@a-b.co.uk"]
    values = [v % rng.randrange(999) for v in values for _ in range(4)]
    values += [f"+1 ({d(3)}) {d(3)}-{d(4)}" for _ in range(4)] + [f"+49 {d(3)} {d(4)} {d(3)}", f"+353.{d(2)}.{d(3)}.{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"+44{d(10)}"]
    values += [".".join(str(rng.randrange(300)) for _ in range(4)) for _ in range(12)] + ["255.255.255.255", "0.0.0.0"]
    values += [f"{rng.randrange(1890, 2110)}-{rng.randrange(0, 14):02d}-{rng.randrange(0, 33):02d}" for _ in range(15)] + ["29/02/2000", "29.02.1900", "31/12/2099", "01.01.1900"]
    values += ["4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", d(16), d(19), " ".join((d(4), d(4), d(4), d(4))), d(13), d(12), d(25)]
    values += ["".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (31, 32, 40, 64, 65)] + ["ABCDEF0123456789" * 2, "g" * 40]
    texts = [None, "", "nothing here", "1" * 5000, "a@" * 3000, "x" * 200_000 + " 4111111111111111"] + values
    texts += [" and ".join(rng.choice(values) for _ in range(rng.randint(1, 6))) + rng.choice(["", ".", ",\n"]) for _ in range(60)]
    rows = [(i, t, 0, "x") for i, t in enumerate(texts + texts[:20])]
    got = {r["doc_id"]: (r["text"], r["n_values"], r["kinds"]) for r in pseudonymise(spark.createDataFrame(rows, "doc_id long, text string, n_values int, kinds string"), "k").collect()}
    for i, t, _, _ in rows:
        assert got[i] == plain_text(t, "k"), t[:300] if t else t
    assert {k for _, _, kinds in got.values() for k in kinds} == {"card", "date", "email", "ipv4", "number", "phone", "secret"}
    assert pseudonymise(spark.createDataFrame([], "doc_id long, text string"), "k").count() == 0


def test_spellings_of_a_value_stay_linked(spark):
    spellings = ["+1 415 555 2671", "+14155552671", "+1-415-555-2671", "+1 (415) 555-2671", "4111 1111 1111 1111", "4111111111111111"]
    out = [re.sub(r"\D", "", r[0]) for r in pseudonymise(spark.createDataFrame([(i, t) for i, t in enumerate(spellings)], "doc_id long, text string"), "k").orderBy("doc_id").select("text").collect()]
    assert len(set(out[:4])) == 1 and out[0][0] == "1" and out[0] != "14155552671" and out[4] == out[5] != "4111111111111111"


def test_days_are_permuted(spark):
    assert DAY_ROWS * DAY_COLUMNS == DAYS
    out = spark.range(DAYS).select(permute_number(F.col("id"), DAY_ROWS, DAY_COLUMNS, "k", "date").alias("p")).agg(F.countDistinct("p"), F.min("p"), F.max("p")).first()
    assert tuple(out) == (DAYS, 0, DAYS - 1)


def test_native_plans(spark):
    docs = spark.createDataFrame([(1, "a 1")], "doc_id long, text string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    for frame in (pseudonymise(docs, "k"), filter_urls(pages, URL_RULES)):
        assert not re.search("Python|Arrow|Pandas", frame._jdf.queryExecution().executedPlan().toString())
