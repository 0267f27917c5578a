"""Format-preserving pseudonyms for personal data, in DataFrame operations only.

Validated numbers and dates are permuted within the set of valid values of their own
format by a keyed Feistel network: a card number becomes another with a right check
digit, a date another date in the same notation.  The permutation depends on the key,
the kind and the number of digits, not on the document or on separators, so equal
values get equal pseudonyms everywhere, and with the key they can be undone.

Kinds, in the order in which a match is tried:

* ``email``: letters and digits of the local part, each among its like; the domain stays;
* ``date``: ``YYYY-MM-DD``, ``YYYY/MM/DD``, ``DD.MM.YYYY``, ``DD/MM/YYYY``, from 1800 to 2199;
* ``ip``: IPv4 addresses, octets up to 255;
* ``ssn``: US social security numbers with a valid area, group and serial;
* ``iban``: digits of account numbers whose remainder by 97 is right; check digits anew;
* ``phone``: 7 to 15 digits behind a country code (one of the ITU's, told by the digits
  alone) or with an area code; the country code stays;
* ``card``: 13 to 19 digits with a right Luhn check digit.

What looks alike but is not valid stays as it is; so do month-first dates beyond the 12th
(``12/25/2020``; earlier ones are read day first) and numbers with ``(0)`` behind the code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, q

KINDS = ("email", "date", "ip", "ssn", "iban", "phone", "card")
ROUNDS = 8
PIECE_DIGITS, PIECE_LETTERS = 15, 10  # longest piece permuted as one number
FIRST_DAY, DAYS = "1800-01-01", (189, 773)  # 400 years have 189 * 773 days
AREAS, GROUPS, SERIALS = 898, 99, 9999  # areas 1 to 899 without 666

# a domain name has at most 127 labels; an unbounded group would recurse once for each of a text's
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}"
ISO_DATE = r"(?<![\w./-])\d{4}(?:-\d{2}-|/\d{2}/)\d{2}(?![\w/-])"
DAY_DATE = r"(?<![\w./-])\d{2}(?:\.\d{2}\.|/\d{2}/)\d{4}(?![\w/-])"
IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
AREA_PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
CODE_PHONE = r"(?<![\w+])\+\d{1,3}(?:[ .-]\d)?(?:[ .-]?\d{2,4}){2,5}(?!\w)"
ONE_PHONE = r"(?<![\w.+-])(?<!\d )1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-]| \d)"
PLAIN_PHONE = r"(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
SPACED_PHONE = r"(?<![\w.+-])(?<!\d )\d{3} \d{3}[ .-]\d{4}(?![\w-]| \d)"
CARD = r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])"

ANY = "|".join((EMAIL, ISO_DATE, DAY_DATE, IPV4, SSN, IBAN, AREA_PHONE, CODE_PHONE, ONE_PHONE, PLAIN_PHONE, SPACED_PHONE, CARD))
HINT = "[0-9@]"  # every kind has one of these

# Country codes of ITU-T E.164, by their first digits; none begins another.
COUNTRY_CODE = (
    "^(?:1|7|20|27|2[1-689][0-9]|3[0-469]|3[578][0-9]|4[013-9]|42[0-9]|5[1-8]|5[09][0-9]|6[0-6]|6[7-9][0-9]"
    "|8[1246]|8[035789][0-9]|9[0-58]|9[679][0-9])"
)


def _int(c):
    return c.cast("bigint")


def _draw(key: str, tweak, number, half):
    """A keyed 60-bit number for one round."""
    text = F.concat_ws("|", F.lit(key), tweak, number.cast("string"), half.cast("string"))
    return _int(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10))


def whole_part(x, y):
    """Whole-number division of bigints, not through a double."""
    return F.call_function("div", x, y)


def feistel(x, left_size, right_size, key: str, tweak):
    """Keyed permutation of 0 .. left_size * right_size - 1: each half in turn is shifted by a draw from the other."""
    start = F.struct(whole_part(x, right_size).alias("l"), (x % right_size).alias("r"))

    def turn(s, i):
        moved = (s["l"] + _draw(key, tweak, i, s["r"]) % left_size) % left_size
        other = (s["r"] + _draw(key, tweak, i, s["l"]) % right_size) % right_size
        odd = i % 2 == 1
        return F.struct(F.when(odd, moved).otherwise(s["l"]).alias("l"), F.when(odd, s["r"]).otherwise(other).alias("r"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, turn, lambda s: s["l"] * right_size + s["r"])


def _power(base: int, exponent):
    """``base ** exponent`` as a bigint, for small exponents."""
    table = F.array(*[F.lit(base**i).cast("bigint") for i in range(19 if base == 10 else 14)])
    return F.get(table, exponent.cast("int"))


def permute_digits(digits, key: str, tweak):
    """A run of digits, permuted within its length, in pieces of at most ``PIECE_DIGITS``."""
    pieces = F.regexp_extract_all(digits, F.lit("[0-9]{1,%d}" % PIECE_DIGITS), F.lit(0))

    def one(p, i):
        n = F.char_length(p)
        half = F.floor(n / 2).cast("int")
        new = feistel(_int(p), _power(10, half), _power(10, n - half), key, F.concat_ws("|", tweak, n.cast("string"), i.cast("string")))
        return F.lpad(new.cast("string"), n, "0")

    return F.array_join(F.transform(pieces, one), "")


def permute_letters(letters, key: str, tweak, first: str):
    """A run of ASCII letters of one case, of at most ``PIECE_LETTERS``; ``first`` is the alphabet's first."""
    n = F.char_length(letters)
    number = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0).cast("bigint"),
        lambda s, i: s * 26 + _int(F.ascii(F.substr(letters, i, F.lit(1))) - ord(first)),
    )
    half = F.floor(n / 2).cast("int")
    new = feistel(number, _power(26, half), _power(26, n - half), key, F.concat_ws("|", tweak, n.cast("string")))
    back = F.aggregate(
        F.sequence(F.lit(1), n),
        F.struct(F.lit("").alias("out"), new.alias("left")),
        lambda s, i: F.struct(
            F.concat(F.chr(s["left"] % 26 + ord(first)), s["out"]).alias("out"),
            whole_part(s["left"], F.lit(26)).alias("left"),
        ),
        lambda s: s["out"],
    )
    return back


def refill(text, digits):
    """``text`` with its digits replaced, in order, by ``digits``."""
    filled = F.aggregate(
        F.split(text, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.struct(
            F.concat(s["out"], F.when(c.rlike("[0-9]"), F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            F.when(c.rlike("[0-9]"), s["at"] + 1).otherwise(s["at"]).alias("at"),
        ),
        lambda s: s["out"],
    )
    return filled


def only_digits(text):
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_digit(payload):
    """The check digit that belongs behind ``payload``."""

    def add(s, i):
        d = F.substr(payload, F.char_length(payload) - i + 1, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, d * 2).otherwise(d)
        return s + F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.char_length(payload)), F.lit(0), add)
    return ((F.lit(10) - total % 10) % 10).cast("string")


def mod97(text):
    """Remainder by 97 of a text whose letters stand for 10 to 35."""

    def add(s, c):
        digit = c.rlike("[0-9]")
        value = F.when(digit, F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (s * F.when(digit, 10).otherwise(100) + value) % 97

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), add)


def _without_last(text, n: int):
    return F.substr(text, F.lit(1), F.char_length(text) - n)


def _day(m):
    """The date that a match stands for; null if none, or outside the 400 years."""
    plain = F.translate(m, "/.", "--")
    day = F.when(plain.rlike("^[0-9]{4}"), F.try_to_timestamp(plain, F.lit("yyyy-MM-dd"))).otherwise(
        F.try_to_timestamp(plain, F.lit("dd-MM-yyyy"))
    )
    day = day.cast("date")
    return F.when((day >= F.lit(FIRST_DAY).cast("date")) & (F.year(day) < 2200), day)


def _octets(m):
    return F.transform(F.split(m, r"\."), lambda o: o.cast("int"))


def kind_of(m):
    """The kind of a match, null if it isn't valid as any."""
    digits = only_digits(m)
    n = F.char_length(digits)
    ssn = F.split(m, "-")
    plain = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    return (
        F.when(F.contains(m, F.lit("@")), "email")
        .when(m.rlike(r"^(\d{4}[-/]\d{2}[-/]\d{2}|\d{2}[./]\d{2}[./]\d{4})$"), F.when(_day(m).isNotNull(), "date"))
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.when(F.forall(_octets(m), lambda o: o <= 255), "ip"))
        .when(
            m.rlike(r"^\d{3}-\d{2}-\d{4}$"),
            F.when(
                ~F.get(ssn, 0).isin("000", "666") & (F.get(ssn, 0) < "900") & (F.get(ssn, 1) != "00") & (F.get(ssn, 2) != "0000"),
                "ssn",
            ),
        )
        .when(m.rlike("^[A-Z]{2}"), F.when(mod97(turned) == 1, "iban"))
        .when(m.rlike(r"^[+(]|^(1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}$"), F.when(n.between(7, 15), "phone"))
        .when(n.between(13, 19), F.when(luhn_digit(_without_last(digits, 1)) == F.right(digits, F.lit(1)), "card"))
    )


def pseudonym(kind, m, key: str):
    """The pseudonym of a match of a known kind; of an unknown one, the match."""
    return (
        F.when(kind.isNull(), m)
        .when(kind == "email", _email(m, key))
        .when(kind == "date", _date(m, key))
        .when(kind == "ip", _ip(m, key))
        .when(kind == "ssn", _ssn(m, key))
        .when(kind == "iban", _iban(m, key))
        .when(kind == "phone", _phone(m, key))
        .otherwise(_card(m, key))
    )


def _email(m, key: str):
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    pieces = F.regexp_extract_all(local, F.lit("[a-z]{1,10}|[A-Z]{1,10}|[0-9]{1,15}|[^A-Za-z0-9]+"), F.lit(0))

    def one(p, i):
        tweak = F.concat_ws("|", F.lit("email"), F.lower(domain), i.cast("string"))
        return (
            F.when(p.rlike("^[a-z]"), permute_letters(p, key, tweak, "a"))
            .when(p.rlike("^[A-Z]"), permute_letters(p, key, tweak, "A"))
            .when(p.rlike("^[0-9]"), permute_digits(p, key, tweak))
            .otherwise(p)
        )

    return F.concat(F.array_join(F.transform(pieces, one), ""), F.lit("@"), domain)


def _date(m, key: str):
    number = F.date_diff(_day(m), F.lit(FIRST_DAY).cast("date")).cast("bigint")
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), feistel(number, F.lit(DAYS[0]), F.lit(DAYS[1]), key, F.lit("date")).cast("int"))
    iso = F.date_format(new, "yyyy-MM-dd")
    return (
        F.when(m.rlike("^[0-9]{4}-"), iso)
        .when(m.rlike("^[0-9]{4}/"), F.translate(iso, "-", "/"))
        .when(F.contains(m, F.lit(".")), F.date_format(new, "dd.MM.yyyy"))
        .otherwise(F.date_format(new, "dd/MM/yyyy"))
    )


def _ip(m, key: str):
    number = F.aggregate(_octets(m), F.lit(0).cast("bigint"), lambda s, o: s * 256 + o)
    new = feistel(number, F.lit(65536).cast("bigint"), F.lit(65536).cast("bigint"), key, F.lit("ip"))
    octet = lambda s: F.shiftright(new, s).bitwiseAND(F.lit(255)).cast("string")
    return F.concat_ws(".", octet(24), octet(16), octet(8), octet(0))


def _ssn(m, key: str):
    part = lambda i: _int(F.get(F.split(m, "-"), i))
    area = part(0) - 1 - F.when(part(0) > 666, 1).otherwise(0)
    x = (area * GROUPS + part(1) - 1) * SERIALS + part(2) - 1
    new = feistel(x, F.lit(AREAS).cast("bigint"), F.lit(GROUPS * SERIALS).cast("bigint"), key, F.lit("ssn"))
    serial, rest = new % SERIALS + 1, whole_part(new, F.lit(SERIALS))
    group, at = rest % GROUPS + 1, whole_part(rest, F.lit(GROUPS)) + 1
    number = at + F.when(at >= 666, 1).otherwise(0)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat_ws("-", pad(number, 3), pad(group, 2), pad(serial, 4))


def _iban(m, key: str):
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))
    digits = permute_digits(only_digits(account), key, F.concat_ws("|", F.lit("iban"), country, F.regexp_replace(account, "[0-9]", "0")))
    moved = refill(account, digits)
    check = F.lpad((F.lit(98) - mod97(F.concat(moved, country, F.lit("00")))).cast("string"), 2, "0")
    return refill(m, F.concat(check, digits))


def _phone(m, key: str):
    digits = only_digits(m)
    code = F.when(m.startswith("+"), F.regexp_extract(digits, COUNTRY_CODE, 0)).otherwise(F.regexp_extract(m, "^1(?=[ .-])", 0))
    rest = F.substr(digits, F.char_length(code) + 1)
    return refill(m, F.concat(code, permute_digits(rest, key, F.lit("phone"))))


def _card(m, key: str):
    payload = permute_digits(_without_last(only_digits(m), 1), key, F.lit("card"))
    return refill(m, F.concat(payload, luhn_digit(payload)))


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with its texts pseudonymised, plus an array of the kinds found, and that column's name.

    Texts are read whole; the text between matches stays as it is.  A null text stays
    null, with no kinds; an empty one stays empty.  All other columns stay.  No row is
    moved: one pass, without an exchange.
    """
    matches, found, kinds = fresh(docs, "pii_matches", "pii_found", "pii_kinds")
    text = q(text_col)
    likely = F.when(F.regexp_like(text, F.lit(HINT)), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    out = docs.withColumn(matches, F.coalesce(likely, F.array().cast("array<string>")))
    named = F.transform(q(matches), lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))
    out = out.withColumn(found, named)
    new = F.transform(q(found), lambda f: pseudonym(f["kind"], f["m"], key))
    pieces = F.zip_with(F.split(text, ANY, -1), new, lambda gap, m: F.concat(gap, F.coalesce(m, F.lit(""))))
    changed = F.when(F.exists(q(found), lambda f: f["kind"].isNotNull()), F.array_join(pieces, "")).otherwise(text)
    out = out.withColumn(kinds, F.filter(F.transform(q(found), lambda f: f["kind"]), lambda k: k.isNotNull()))
    return out.withColumn(text_col, changed).drop(matches, found), kinds


def pii_report(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, n_email, ..., n_card)`` for every row: the pseudonymised text and what was replaced in it."""
    rows = docs.select(q(id_col).alias("doc_id"), q(text_col).alias("text"))
    out, kinds = pseudonymised(rows, key)
    return out.select("doc_id", "text", *[_count(q(kinds), kind).alias(f"n_{kind}") for kind in KINDS])


def _count(kinds, kind: str):
    return F.size(F.filter(kinds, lambda k: k == kind)).cast("bigint")
