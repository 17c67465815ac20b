"""Personal data replaced by pseudonyms of the same format, in DataFrame functions only.

Numbers go through a keyed Feistel network over their own digits: a permutation
of the numbers of that length, so equal values get equal pseudonyms in all
documents, different ones different. Dates are permuted within the 400 years
1800 to 2199, a whole cycle of the calendar (other years: within their own cycle), so
every date becomes a real date.

What is replaced, tried in this order at each place:

* e-mail addresses: local part by a keyed digest of the whole address, domain
  ``mail.invalid``;
* access keys (``AKIA`` and 16 more), values after ``password=``, ``token=``,
  ``secret=``, ``api_key=`` and hexadecimal strings of 32 and more: keyed
  digests of the same length;
* IPv4 addresses with all parts up to 255: the 32 bits are permuted;
* ISO dates ``yyyy-mm-dd`` and ``dd/mm/yyyy`` that exist;
* IBANs with valid check digits, of their country's length or to the last group
  that follows: the digits of the account are permuted and the check digits
  renewed. What fails the check hides nothing in it or behind it;
* US social security numbers in valid ranges, permuted among those;
* telephone numbers with their signs and spaces: all digits but the first;
* card numbers of 13 to 19 digits, also in groups, that pass the Luhn check: the
  first digit stays, the others are permuted and the check digit is renewed.

What looks alike but fails its check stays. A match that is null, empty texts
and null texts stay as they are; repeated rows get equal results; other columns
are not looked at. The text is cut at the matches, so work grows with its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: the formats looked for
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ACCESS_KEY = r"\bAKIA[0-9A-Z]{16}\b"
ASSIGNED = r"(?i:\b(?:password|passwd|pwd|token|secret|api_key|apikey)[=:][^\s\"']++)"
HEX = r"\b(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)\b"
IPV4 = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
ISO_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
SLASH_DATE = r"(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])"
IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
#: countries by the length of their IBANs
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
FULL_IBAN = r"\b(?:" + "|".join(
    f"(?:{codes.replace(' ', '|')})\\d{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, codes in IBAN_LENGTHS.items()
) + r")\b"
CARD = r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (
    r"(?<![\d+])\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,4}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
)
#: the formats tried before valid IBANs, and after them
_BEFORE = "|".join(f"(?:{p})" for p in (EMAIL, ACCESS_KEY, ASSIGNED, HEX, IPV4, ISO_DATE, SLASH_DATE))
_AFTER = "|".join(f"(?:{p})" for p in (SSN, PHONE, CARD))
#: a text without these characters holds nothing to replace
_HINT = r"[0-9@=:]"

ROUNDS = 8
#: the days of 400 years, and that number as a product of the ranges of both halves
_DAYS, _DAY_HALVES = 146_097, (189, 773)
_FIRST_DAY = "1800-01-01"


def _round(key: str, kind: str, i: Column, half: Column) -> Column:
    """A keyed round value of 48 bits."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def permute(value: Column, left: Column, right: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the whole numbers below ``left * right``.

    Both halves stay in their own range; each step adds a round value of one
    half to the other, which can be undone, so the whole is a permutation.
    """
    start = F.struct(
        F.floor(value / right).cast("long").alias("l"), (value % right).cast("long").alias("r")
    )

    def step(acc: Column, i: Column) -> Column:
        on_left = i % 2 == 0
        l = F.when(on_left, (acc["l"] + _round(key, kind, i, acc["r"])) % left).otherwise(acc["l"])
        r = F.when(on_left, acc["r"]).otherwise((acc["r"] + _round(key, kind, i, acc["l"])) % right)
        return F.struct(l.cast("long").alias("l"), r.cast("long").alias("r"))

    end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return end["l"] * right + end["r"]


def _number(c: Column) -> Column:
    return c.cast("long")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _tens(n: Column) -> Column:
    return F.pow(F.lit(10), n).cast("long")


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of up to 18 digits to another of the same length."""
    n = F.length(digits)
    half = F.floor(n / 2)
    moved = permute(_number(digits), _tens(half), _tens(n - half), key, kind)
    return F.lpad(moved.cast("string"), n, "0")


def refill(template: Column, digits: Column) -> Column:
    """The template with its digits replaced, in order, by others."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(acc["out"], F.when(is_digit, F.substring(digits, acc["at"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["at"] + is_digit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(template, "(?!^)"), start, step)["out"]


def luhn_sum(digits: Column) -> Column:
    """From the right, every second digit doubled and reduced to one digit."""
    back = F.reverse(digits)

    def step(acc: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step)


def mod97(text: Column) -> Column:
    """Digits, and letters as 10 to 35, read as one number modulo 97."""
    def step(acc: Column, c: Column) -> Column:
        v = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return (acc * F.when(v < 10, 10).otherwise(100) + v) % 97

    # not at the end either: an empty last piece would count as a digit 0
    return F.aggregate(F.split(text, r"(?!^|\z)"), F.lit(0), lambda a, c: step(a, c).cast("int"))


def _digest(value: Column, n: Column, key: str, kind: str) -> Column:
    """A keyed hexadecimal string of ``n`` characters."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value), 256)
    return F.substring(F.repeat(digest, F.ceil(n / 64).cast("int")), F.lit(1), n)


def _email(m: Column, key: str) -> Column:
    return F.concat(_digest(F.lower(m), F.lit(12), key, "email"), F.lit("@mail.invalid"))


def _assigned(m: Column, key: str) -> Column:
    name = F.regexp_extract(m, r"^([A-Za-z_]+[=:])", 1)
    value = F.substring(m, F.length(name) + 1, F.length(m))
    return F.concat(name, _digest(value, F.length(value), key, "secret"))


def _ipv4(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("int"))
    value = F.aggregate(parts, F.expr("0L"), lambda acc, p: acc * 256 + p)
    moved = permute(value, F.lit(65536), F.lit(65536), key, "ipv4")
    shown = F.array_join(F.transform(F.array(*map(F.lit, (24, 16, 8, 0))), lambda s: (
        F.floor(moved / F.pow(F.lit(2), s)).cast("long") % 256).cast("string")), ".")
    return F.when(F.forall(parts, lambda p: p <= 255), shown).otherwise(m)


def _moved_day(day: Column, key: str) -> Column:
    since = F.datediff(day, F.lit(_FIRST_DAY).cast("date"))
    cycle = F.floor(since / _DAYS).cast("int")
    moved = permute((since - cycle * _DAYS).cast("long"), *map(F.lit, _DAY_HALVES), key, "date")
    return F.date_add(F.lit(_FIRST_DAY).cast("date"), cycle * _DAYS + moved.cast("int"))


def _iso_date(m: Column, key: str) -> Column:
    day = m.try_cast("date")
    return F.when(day.isNotNull() & m.between("0200", "9799-12-31"), F.date_format(_moved_day(day, key), "yyyy-MM-dd")).otherwise(m)


def _slash_date(m: Column, key: str) -> Column:
    year, a, b = (F.substring(m, *at) for at in ((7, 4), (1, 2), (4, 2)))
    day_first = F.concat_ws("-", year, b, a).try_cast("date")
    month_first = F.concat_ws("-", year, a, b).try_cast("date")
    day = F.coalesce(day_first, month_first)
    shown = F.when(day_first.isNotNull(), F.date_format(_moved_day(day, key), "dd/MM/yyyy")).otherwise(
        F.date_format(_moved_day(day, key), "MM/dd/yyyy"))
    return F.when(day.isNotNull() & year.between("0200", "9799"), shown).otherwise(m)


def _valid_iban(m: Column) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    return mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1


def _formats(c: Column) -> Column:
    """The pattern of all formats, with the valid IBANs of the text itself in it."""
    # looked ahead for, so candidates overlap and a failed one takes nothing from the others
    found = F.concat(*(F.regexp_extract_all(c, F.lit(rf"\b(?=[A-Z]{{2}}\d)(?=({p}))"), F.lit(1)) for p in (FULL_IBAN, IBAN)))
    valid = F.filter(F.array_distinct(found), _valid_iban)
    ibans = F.concat(F.lit(r"|\b(?:"), F.array_join(valid, "|"), F.lit(r")\b|"))
    return F.concat(F.lit(_BEFORE), F.when(F.size(valid) > 0, ibans).otherwise("|"), F.lit(_AFTER))


def _iban(m: Column, key: str) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    valid = _valid_iban(m)
    digits = _digits(account)
    tail = F.least(F.length(digits), F.lit(18))
    kept = F.substring(digits, F.lit(1), F.length(digits) - tail)
    changed = refill(account, F.concat(kept, permute_digits(F.right(digits, tail), key, "iban")))
    check = F.lpad((98 - mod97(F.concat(changed, country, F.lit("00")))).cast("string"), 2, "0")
    letters = F.concat(country, check, changed)
    # spaces go back to where they were
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    spaced = F.aggregate(F.split(m, "(?!^)"), start, lambda acc, c: F.struct(
        F.concat(acc["out"], F.when(c == " ", c).otherwise(F.substring(letters, acc["at"], F.lit(1)))).alias("out"),
        (acc["at"] + (c != " ").cast("int")).alias("at"),
    ))["out"]
    return F.when(valid & (F.length(digits) > 1), spaced).otherwise(m)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, *at).cast("int") for at in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("int")
    rank = (place * 99 + group - 1).cast("long") * 9999 + serial - 1
    moved = permute(rank, F.lit(898 * 99), F.lit(9999), key, "ssn")
    new_place = F.floor(moved / (99 * 9999)).cast("int")
    shown = F.concat_ws(
        "-", F.lpad((new_place + 1 + (new_place >= 665).cast("int")).cast("string"), 3, "0"),
        F.lpad((F.floor(moved / 9999).cast("long") % 99 + 1).cast("string"), 2, "0"),
        F.lpad((moved % 9999 + 1).cast("string"), 4, "0"),
    )
    return F.when(valid, shown).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    digits = _digits(m)
    return refill(m, F.concat(F.left(digits, F.lit(1)), permute_digits(
        F.substring(digits, F.lit(2), F.length(digits)), key, "phone")))


def _card(m: Column, key: str) -> Column:
    digits = _digits(m)
    inner = permute_digits(F.substring(digits, F.lit(2), F.length(digits) - 2), key, "card")
    start = F.concat(F.left(digits, F.lit(1)), inner)
    check = (10 - luhn_sum(F.concat(start, F.lit("0"))) % 10) % 10
    return F.when(luhn_sum(digits) % 10 == 0, refill(m, F.concat(start, check.cast("string")))).otherwise(m)


def pseudonym(m: Column, key: str) -> Column:
    """What stands in for one match of any of the formats."""
    is_a = lambda pattern: m.rlike(f"^(?:{pattern})$")
    hexadecimal = _digest(F.lower(m), F.length(m), key, "hex")
    return (
        F.when(is_a(EMAIL), _email(m, key))
        .when(is_a(ACCESS_KEY), F.concat(F.lit("AKIA"), F.upper(_digest(m, F.lit(16), key, "access"))))
        .when(is_a(ASSIGNED), _assigned(m, key))
        .when(is_a(HEX), F.when(m.rlike("[A-F]"), F.upper(hexadecimal)).otherwise(hexadecimal))
        .when(is_a(IPV4), _ipv4(m, key))
        .when(is_a(ISO_DATE), _iso_date(m, key))
        .when(is_a(SLASH_DATE), _slash_date(m, key))
        .when(is_a(IBAN), _iban(m, key))
        .when(is_a(SSN), _ssn(m, key))
        .when(is_a(PHONE), _phone(m, key))
        .otherwise(_card(m, key))
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All columns as they are, personal data in ``text`` replaced. ``key`` is the secret."""
    c = F.col(text)
    formats = _formats(c)
    between = F.split(c, formats, -1)
    found = F.transform(F.regexp_extract_all(c, formats, F.lit(0)), lambda m: pseudonym(m, key))
    # one more piece of text than matches: the last is joined with nothing
    joined = F.array_join(F.zip_with(between, found, lambda b, f: F.concat(b, F.coalesce(f, F.lit("")))), "")
    return docs.withColumn(text, F.when(c.rlike(_HINT), joined).otherwise(c))
