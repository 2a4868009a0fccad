"""Operator 5: format-preserving pseudonyms, DataFrame functions only.

Validated numbers, dates and mail names are replaced by a keyed permutation of
their format, so a value has the same pseudonym in every document and two values of a
format never share one.  The permutation is a Feistel network over the
symbols of a value, each with its own radix: per round one half of the symbols is shifted by
keyed SHA-256 hashes of the other half.

* ``card``: 13 to 19 digits with a right Luhn digit; the first digit stays, the
  check digit is made anew.  Also four groups of four.
* ``date``: a real day written yyyy-MM-dd, yyyy/MM/dd, dd.MM.yyyy or MM/dd/yyyy,
  years 1800 to 2199; permuted within its century, written alike.
* ``phone``: ten digits behind a country code or in (ddd) ddd-dddd or
  ddd-ddd-dddd form; the country code stays.
* ``ssn``: ddd-dd-dddd with an area, group and serial that can exist.
* ``ipv4``: four numbers up to 255; each keeps its number of digits.
* ``email``: letters and digits of the local part, class by class.

What looks like a value but isn't valid stays as it is.  All work is in the
row: no shuffle, no join, nothing that a hot value could skew.

Cases: a null text stays null and an empty one empty; repeated rows are
treated alike; a null id is kept; extra columns pass through; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import free_name, text_of

ROUNDS = 8
KINDS = ("email", "date", "ssn", "ipv4", "phone", "card")
_NOT_BEFORE, _NOT_AFTER = "(?<![0-9A-Za-z])", "(?![0-9A-Za-z])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
SHAPES = {
    "date": r"\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "ipv4": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}",
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4}",
    "card": r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}",
}
VALUE = f"{EMAIL}|{_NOT_BEFORE}(?:{'|'.join(SHAPES.values())}){_NOT_AFTER}"
# what any value contains; texts without it are left alone at once
HINT = r"\d[-/. )(]{0,3}\d|@"


def feistel(values: Column, radices: Column, tag: str, key: str) -> Column:
    """Permutes arrays of longs (0 <= value < radix, element by element), keyed by ``key`` and ``tag``."""
    def round_(state, k):
        v, r = state["v"], state["r"]
        half = F.floor(F.size(v) / 2).cast("int")
        left = k % 2 == 1  # odd rounds shift the left half by the right one
        other = F.array_join(F.when(left, F.slice(v, half + 1, F.size(v) - half)).otherwise(F.slice(v, 1, half)).cast("array<string>"), ",")

        def shift(i):
            digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), k.cast("string"), i.cast("string"), other), 256)
            return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

        moved = F.transform(v, lambda x, i: F.when((i < half) == left, F.pmod(x + shift(i), F.get(r, i))).otherwise(x))
        return F.struct(moved.alias("v"), r.alias("r"))

    start = F.struct(values.cast("array<bigint>").alias("v"), radices.cast("array<bigint>").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_, lambda s: s["v"])


def scramble(text: Column, tag: str, key: str) -> Column:
    """Digits to digits, letters to letters of their case, everything else unchanged."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    base = lambda c: (F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65))
    values = F.transform(chars, lambda c: F.coalesce(F.ascii(c) - base(c), F.lit(0)))
    radices = F.transform(chars, lambda c: F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1))
    return F.array_join(F.zip_with(chars, feistel(values, radices, tag, key),
                                   lambda c, v: F.coalesce(F.char(base(c) + v), c)), "")


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum of a digit string; every second digit from the right is doubled, beginning with place ``doubled`` (0 or 1)."""
    def add(total, x):
        twice = x["d"] * 2
        return total + F.when(x["i"] % 2 == doubled, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(x["d"])

    places = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
                         lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(places, F.lit(0), add)


def _digits(h: Column) -> Column:
    return F.regexp_replace(h, "[^0-9]", "")


def _octet(h: Column, k: int) -> Column:
    return F.element_at(F.split(h, r"\."), k).cast("int")


def _day(h: Column) -> Column:
    """The day that a date in any of the four forms names, null if there is none."""
    numbers = F.split(h, "[-/.]")
    a, b, c = (F.element_at(numbers, k) for k in (1, 2, 3))
    first_year, dotted = F.length(a) == 4, F.instr(h, ".") > 0
    y = F.when(first_year, a).otherwise(c)
    m = F.when(first_year | dotted, b).otherwise(a)
    d = F.when(first_year, c).when(dotted, a).otherwise(b)
    return F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")


def kind_of(h: Column) -> Column:
    """The kind of a matched string, null if it isn't valid."""
    whole = {k: f"^(?:{p})$" for k, p in SHAPES.items()}
    digits, day = _digits(h), _day(h)
    ssn_ok = ~h.rlike(r"^(000|666|9)") & (F.substring(h, 5, 2) != "00") & (F.substring(h, 8, 4) != "0000")
    ip_ok = (_octet(h, 1) <= 255) & (_octet(h, 2) <= 255) & (_octet(h, 3) <= 255) & (_octet(h, 4) <= 255)
    return (F.when(h.contains("@"), "email")
            .when(h.rlike(whole["date"]), F.when(F.year(day).between(1800, 2199), "date"))
            .when(h.rlike(whole["ssn"]), F.when(ssn_ok, "ssn"))
            .when(h.rlike(whole["ipv4"]), F.when(ip_ok, "ipv4"))
            .when(h.rlike(whole["phone"]), "phone")
            .when(h.rlike(whole["card"]), F.when(luhn_sum(digits, 1) % 10 == 0, "card")))


def _into(digits: Column, shape: Column) -> Column:
    """``digits`` written into the places of the digits of ``shape``, one after another."""
    state = F.aggregate(
        F.filter(F.split(shape, ""), lambda c: c != ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(s["out"], F.substr(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"])
    return state


def _address(h: Column, key: str) -> Column:
    """An octet keeps its number of digits: 0-9, 10-99, 100-255, and behind a leading zero 0-9 or 0-99."""
    octets = F.split(h, r"\.")
    zero = lambda o: (F.length(o) > 1) & o.startswith("0")
    low = lambda o: F.when(zero(o) | (F.length(o) == 1), 0).when(F.length(o) == 2, 10).otherwise(100)
    many = lambda o: F.when(zero(o), F.when(F.length(o) == 2, 10).otherwise(100)).when(
        F.length(o) == 1, 10).when(F.length(o) == 2, 90).otherwise(156)
    moved = feistel(F.transform(octets, lambda o: o.cast("long") - low(o)), F.transform(octets, many), "ipv4", key)
    return F.array_join(F.zip_with(octets, moved, lambda o, v: F.lpad((v + low(o)).cast("string"), F.length(o), F.lit("0"))), ".")


def pseudonym(h: Column, kind: Column, key: str) -> Column:
    # card: the first digit stays, the last one closes the Luhn sum
    digits = _digits(h)
    n = F.length(digits)
    body = F.concat(F.substr(digits, F.lit(1), F.lit(1)), scramble(F.substr(digits, F.lit(2), n - 2), "card", key))
    card = _into(F.concat(body, F.pmod(-luhn_sum(body, 0), F.lit(10)).cast("string")), h)
    # phone: the last ten digits
    phone = _into(F.concat(F.substr(digits, F.lit(1), n - 10), scramble(F.substr(digits, n - 9, F.lit(10)), "phone", key)), h)
    ip = _address(h, key)
    # areas 001 to 899 without 666 are 898 numbers, groups 99, serials 9,999
    area = F.substring(h, 1, 3).cast("long")
    parts = feistel(F.array(area - 1 - (area > 666).cast("long"), F.substring(h, 5, 2).cast("long") - 1, F.substring(h, 8, 4).cast("long") - 1),
                    F.array(F.lit(898), F.lit(99), F.lit(9999)), "ssn", key)
    ssn = F.aggregate(F.array(parts), F.lit(""), lambda s, p: F.format_string(
        "%03d-%02d-%04d", p[0] + 1 + (p[0] >= 665).cast("long"), p[1] + 1, p[2] + 1))
    # date: a century has 36,524 = 92 * 397 days, or 36,525 = 75 * 487 when its first year is a leap year
    day = _day(h)
    century = F.floor(F.year(day) / 100).cast("int")
    start = F.make_date(century * 100, F.lit(1), F.lit(1))
    inner = F.when(century % 4 == 0, 487).otherwise(397)
    outer = F.when(century % 4 == 0, 75).otherwise(92)
    past = F.datediff(day, start)
    new_day = F.aggregate(
        F.array(feistel(F.array(F.floor(past / inner), past % inner), F.array(outer, inner), "date", key)),
        F.lit(None).cast("date"), lambda s, p: F.date_add(start, (p[0] * inner + p[1]).cast("int")))
    short = F.length(h) < 10
    forms = {r"^\d{4}-": ("yyyy-MM-dd", "yyyy-M-d"), r"^\d{4}/": ("yyyy/MM/dd", "yyyy/M/d"), r"\.": ("dd.MM.yyyy", "d.M.yyyy")}
    date = F.when(short, F.date_format(new_day, "M/d/yyyy")).otherwise(F.date_format(new_day, "MM/dd/yyyy"))
    for shape, (long_, brief) in forms.items():
        date = F.when(h.rlike(shape), F.when(short, F.date_format(new_day, brief)).otherwise(F.date_format(new_day, long_))).otherwise(date)
    at = F.instr(h, "@")
    email = F.concat(scramble(F.substr(h, F.lit(1), at - 1), "email", key), F.substr(h, at, F.length(h)))
    return (F.when(kind == "card", card).when(kind == "phone", phone).when(kind == "ipv4", ip)
            .when(kind == "ssn", ssn).when(kind == "date", date).when(kind == "email", email).otherwise(h))


def pseudonymise(docs: DataFrame, *, key: str) -> DataFrame:
    """The documents with pseudonyms in ``text``, and ``pii_counts`` (a struct with a count per kind).

    An input column of that name stays; the counts are then ``pii_counts_2`` (or the next free number).
    """
    report = free_name("pii_counts", docs.columns)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text_of().alias("text"))
    found = F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(VALUE), F.lit(0)))
    # steps: a column that is used often is computed once, in a step before
    rows = rows.select("row", "text", found.alias("hits"))
    rows = rows.select("row", "text", "hits", F.transform("hits", lambda h: kind_of(h)).alias("kinds"))
    rows = rows.select("row", "text", "kinds", F.when(F.size("hits") > 0, F.zip_with("hits", "kinds", lambda h, k: pseudonym(h, k, key))).alias("new"))
    joined = F.array_join(F.zip_with(F.split("text", VALUE), F.concat("new", F.array(F.lit(""))), lambda p, x: F.concat(p, x)), "")
    text = F.when(F.col("row")["text"].isNull(), F.lit(None)).otherwise(F.coalesce(joined, F.col("text")))
    count = lambda kind: F.coalesce(F.size(F.filter("kinds", lambda k: k == kind)), F.lit(0)).cast("long").alias(kind)
    rows = rows.select("row", text.alias("text"), F.struct(*[count(k) for k in KINDS]).alias("counts"))

    def column(c):
        if c == "text":
            return F.col("text")
        if c == "n_chars":
            return F.coalesce(F.char_length("text").cast(docs.schema[c].dataType), F.col("row")[c]).alias(c)
        return F.col("row")[c].alias(c)

    return rows.select(*[column(c) for c in docs.columns], F.col("counts").alias(report))
