r"""Format-preserving pseudonyms of personal numbers and dates, by a keyed Feistel network. SQL functions only.

Card numbers (13 to 19 digits, Luhn), social security numbers, phone numbers, IPv4 addresses, dates and the local part of
e-mail addresses are found by one pattern, validated, and permuted within their format: a value splits into two
halves of residues ``a`` and ``b``, and rounds add a keyed SHA-256 of one half to the other, modulo its size. Every round
can be undone, so for each kind and length different values get different pseudonyms and equal ones the same in
every document. Card numbers keep a valid check digit, separators stay where they are, dates stay dates of 1900 to 2099 in
the same notation, addresses stay addresses. Numbers that fail validation are left alone.

Defined cases: a null text stays null with no findings; an empty text stays empty; rows that repeat are treated
alike; other columns pass untouched where asked for by name only; an empty table gives no rows. Of overlapping matches
the leftmost counts, and there the first kind of the pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: Days from 1900-01-01 to 2099-12-31: 229 * 319.
_DAYS = (229, 319)
_START = "1900-01-01"

# Fixed formats of personal values.
_EMAIL = r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_DATE = r"(?:(?:19|20)\d\d-\d\d-\d\d|(?:19|20)\d\d/\d\d/\d\d|\d\d/\d\d/(?:19|20)\d\d|\d\d\.\d\d\.(?:19|20)\d\d)(?![\d/.-]*\d)"
_IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)"
_SSN = r"\d{3}-\d{2}-\d{4}(?![-\d])"
_PHONE = r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[.-])\d{3}[ .-]?\d{4}(?![-\d])|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?![-\d])"
_CARD = r"(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![-\d])"
#: Left of a value there is no letter, digit or number mark.
_LEFT = r"(?<![A-Za-z0-9_+.@/-])"
PATTERN = rf"{_LEFT}(?:{_EMAIL}|{_DATE}|{_IP}|{_SSN}|{_CARD}|{_PHONE})"


def _half(key: str, tweak: Column, turn: Column, half: Column) -> Column:
    """60 bits of a keyed hash of one half."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), half.cast("string"), F.lit(key)), 256), 1, 15), 16, 10).cast("long")


def feistel(value: Column, a: Column, b: Column, key: str, tweak: Column, rounds: int = ROUNDS) -> Column:
    """A permutation of 0 .. a * b - 1, keyed by ``key`` and ``tweak``."""
    start = F.struct(F.call_function("div", value, b).alias("l"), F.pmod(value, b).alias("r"))

    def step(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(_half(key, tweak, i, s["r"]), a), a)
        right = F.pmod(s["r"] + F.pmod(_half(key, tweak, i, s["l"]), b), b)
        return F.struct(F.when(i % 2 == 0, left).otherwise(s["l"]).alias("l"), F.when(i % 2 == 1, right).otherwise(s["r"]).alias("r"))

    end = F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step)
    return end["l"] * b + end["r"]


def _power(base: int, n: Column) -> Column:
    return F.pow(F.lit(float(base)), n).cast("long")


def _permuted_digits(digits: Column, key: str, tweak: Column) -> Column:
    """Digits (up to 18) to as many digits."""
    n = F.length(digits)
    low = F.call_function("div", n, F.lit(2)).cast("int")
    return F.lpad(feistel(digits.cast("long"), _power(10, n - low), _power(10, low), key, F.concat_ws("|", tweak, n.cast("string"))).cast("string"), n, "0")


def _filled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits``, in order."""
    filled = F.aggregate(
        F.split(shape, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(s["out"], F.substr(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
    )
    return filled["out"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled_from: int) -> Column:
    """Sum of digits, every second one doubled; ``doubled_from``: whether the last (0) or the one before it (1) is."""
    return F.aggregate(
        F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == doubled_from, F.call_function("div", c.cast("int") * 2, F.lit(10)) + F.pmod(c.cast("int") * 2, F.lit(10))).otherwise(c.cast("int").cast("long"))),
        F.lit(0).cast("long"),
        lambda x, y: x + y,
    )


def _card(value: Column, key: str) -> Column:
    """The first digits are permuted, the last is the new check digit; a nineteenth digit stays in front."""
    digits = _digits(value)
    n = F.length(digits)
    head = F.when(n > 18, F.substr(digits, F.lit(1), n - 18)).otherwise("")
    body = F.substr(digits, F.length(head) + 1, n - 1 - F.length(head))
    new = F.concat(head, _permuted_digits(body, key, F.lit("card")))
    return _filled(value, F.concat(new, F.pmod(10 - F.pmod(_luhn_sum(new, 0), F.lit(10)), F.lit(10)).cast("string")))


def _ip(value: Column, key: str) -> Column:
    number = F.aggregate(F.split(value, r"\."), F.lit(0).cast("long"), lambda s, x: s * 256 + x.cast("long"))
    new = feistel(number, F.lit(1 << 16).cast("long"), F.lit(1 << 16).cast("long"), key, F.lit("ip"))
    return F.concat_ws(".", *[F.pmod(F.shiftright(new, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])


def _ssn(value: Column, key: str) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999; the result is such a number too."""
    area, group, serial = (F.substr(value, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    number = ((area - 1 - (area > 666).cast("long")) * 99 + group - 1) * 9999 + serial - 1
    new = feistel(number, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, F.lit("ssn"))
    left = F.call_function("div", new, F.lit(9999))
    area = F.call_function("div", left, F.lit(99)) + 1
    return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in ((area + (area >= 666).cast("long"), 3), (F.pmod(left, F.lit(99)) + 1, 2), (F.pmod(new, F.lit(9999)) + 1, 4))])


def _phone(value: Column, key: str) -> Column:
    """The country code stays; the other digits are permuted among themselves."""
    code = F.regexp_extract(value, r"^\+\d{1,3}(?=[ .(-])", 0)
    rest = F.substr(value, F.length(code) + 1, F.length(value))
    digits = _digits(rest)
    return F.concat(code, _filled(rest, _permuted_digits(digits, key, F.concat_ws("|", F.lit("phone"), code))))


def _day(value: Column) -> Column:
    """The date of a value: year first; else day first, but month first where only that is a date."""
    return F.coalesce(F.try_to_date(value, "yyyy-MM-dd"), F.try_to_date(value, "yyyy/MM/dd"), F.try_to_date(value, "dd.MM.yyyy"), F.try_to_date(value, "dd/MM/yyyy"), F.try_to_date(value, "MM/dd/yyyy"))


def _date(value: Column, key: str) -> Column:
    number = F.datediff(_day(value), F.lit(_START).cast("date")).cast("long")
    new = F.date_add(F.lit(_START).cast("date"), feistel(number, F.lit(_DAYS[0]).cast("long"), F.lit(_DAYS[1]).cast("long"), key, F.lit("date")).cast("int"))
    day_first = value.rlike(r"^\d\d/") & F.try_to_date(value, "dd/MM/yyyy").isNotNull()
    return (
        F.when(value.rlike(r"^\d{4}-"), F.date_format(new, "yyyy-MM-dd"))
        .when(value.rlike(r"^\d{4}/"), F.date_format(new, "yyyy/MM/dd"))
        .when(value.rlike(r"^\d\d\."), F.date_format(new, "dd.MM.yyyy"))
        .when(day_first, F.date_format(new, "dd/MM/yyyy"))
        .otherwise(F.date_format(new, "MM/dd/yyyy"))
    )


def _letters(text: Column, key: str) -> Column:
    """Up to twelve letters a-z to as many letters."""
    n = F.length(text)
    low = F.call_function("div", n, F.lit(2)).cast("int")
    number = F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda s, c: s * 26 + (F.ascii(c) - 97))
    new = feistel(number, _power(26, n - low), _power(26, low), key, F.concat_ws("|", F.lit("letters"), n.cast("string")))
    spelt = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.struct(new.alias("x"), F.lit("").alias("out")), lambda s, _: F.struct(F.call_function("div", s["x"], F.lit(26)).alias("x"), F.concat(F.char(F.pmod(s["x"], F.lit(26)) + 97), s["out"]).alias("out")))
    return F.when(n == 0, "").otherwise(spelt["out"])


def _email(value: Column, key: str) -> Column:
    """Letters and digits of the lower-cased local part are permuted in runs of twelve at most; the domain stays."""
    local = F.lower(F.substring_index(value, "@", 1))
    runs = F.regexp_extract_all(local, F.lit("[a-z]{1,12}|[0-9]{1,12}|[^a-z0-9]"), F.lit(0))
    new = F.transform(runs, lambda r: F.when(r.rlike("^[a-z]"), _letters(r, key)).when(r.rlike("^[0-9]"), _permuted_digits(r, key, F.lit("mail"))).otherwise(r))
    return F.concat(F.array_join(new, ""), F.lit("@"), F.substring_index(value, "@", -1))


def kind_of(value: Column) -> Column:
    """email, date, ip, ssn, card or phone; null for what fails validation."""
    digits = _digits(value)
    octets = F.forall(F.split(value, r"\."), lambda x: x.cast("int") <= 255)
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(rf"^{_DATE}$"), F.when(_day(value).isNotNull(), "date"))
        .when(value.rlike(rf"^{_IP}$"), F.when(octets, "ip"))
        .when(value.rlike(rf"^{_SSN}$"), F.when(value.rlike(r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$"), "ssn"))
        .when(value.rlike(rf"^{_CARD}$") & (F.pmod(_luhn_sum(digits, 1), F.lit(10)) == 0) & ~value.rlike("^0+"), "card")
        .when(value.rlike(rf"^(?:{_PHONE})$") & F.length(digits).between(7, 15), "phone")
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    found = F.when(kind == "email", _email(value, key)).when(kind == "date", _date(value, key)).when(kind == "ip", _ip(value, key))
    return found.when(kind == "card", _card(value, key)).when(kind == "ssn", _ssn(value, key)).when(kind == "phone", _phone(value, key)).otherwise(value)


def pseudonymised(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_found, kinds (of the findings, in order), text with pseudonyms."""
    if not key:
        raise ValueError("a key is needed")
    text = F.col("__text")
    some = text.rlike("[0-9@]")
    found = F.when(some, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")).withColumn("__found", found)
    told = rows.withColumn("__found", F.transform("__found", lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind"))))
    new = F.transform("__found", lambda f: pseudonym(f["value"], f["kind"], key))
    between = F.split(text, PATTERN, -1)
    joined = F.array_join(F.zip_with(between, F.concat(new, F.array(F.lit(""))), lambda p, v: F.concat(p, v)), "")
    kinds = F.coalesce(F.filter(F.transform("__found", lambda f: f["kind"]), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    changed = F.when(F.size("__found") > 0, joined).otherwise(text)
    return told.select(F.col("__id").alias(id_col), F.size(kinds).cast("long").alias("n_found"), kinds.alias("kinds"), changed.alias("text"))
