"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Found values are validated, then permuted within their own format under a key, so equal
values stay equal in all documents and different ones stay different:

* e-mail addresses: the local part, letters to letters and digits to digits;
* North American phone numbers: area, exchange and line.  A bare number needs a first digit of
  2 to 9 in both of the former; with brackets or ``+1`` any digits count.  First digits of 2 to 9
  stay so, and 0 and 1 stay 0 or 1; international numbers of 8 to 15 digits after a plus sign, with single
  spaces, dots or hyphens between them or none: all digits but the first, which starts the country code;
* card numbers of 13 to 19 digits that pass the Luhn test: all between the first digit and the
  check digit, which is worked out again;
* IBANs that pass the mod-97 test: the account part, with new check digits;
* social security numbers with valid parts, IPv4 addresses, and calendar dates (Y-m-d, Y/m/d,
  d.m.Y, m/d/Y, and d/m/Y where it is no m/d/Y, also before a ``T`` and a time): within the valid values; dates
  within their 400-year calendar cycle, those of d/m/Y among the dates that only d/m/Y can be;
* access keys and assigned secrets (``password=...``): character by character within its class,
  hexadecimal values staying hexadecimal.

Numbers that fail their test are left alone.  A permutation of characters is a Feistel network
over the two halves of the string, whose round function adds a keyed SHA-256 value to each
character within its alphabet; a permutation of numbers is one over two residues whose moduli
multiply to the number of valid values, so that every result is valid at once.

Everything is built-in expressions on one column: no shuffle, no Python.  The key becomes a
literal of the plan; take it from a secret store and keep plans and event logs accordingly.
Very long texts are one value of one row, as they are in the input.  Null texts stay null and empty ones empty; repeated rows give repeated results; extra columns
are carried along."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KEY = "barlake pseudonyms"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIRST = "23456789"  # first digits of area and exchange codes
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

SECRET = r"""(?i:password|passwd|pwd|token|secret|api[_-]?key)["']?[ \t]*[=:][ \t]*["']?(?=[^\s"',;]*[0-9])[^\s"',;]{6,}"""
ACCESS = r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}"
IBAN = r"[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![0-9A-Za-z])"
PHONE = (
    r"(?:(?:\+?1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}|\+1[ .-]?[0-9]{3}[ .-][0-9]{3}"
    r"|(?:1[ .-]?)?[2-9][0-9]{2}[ .-][2-9][0-9]{2})[ .-][0-9]{4}(?![0-9A-Za-z])"
)
E164 = r"\+[1-9](?:[ .-]?[0-9]){7,14}(?![0-9A-Za-z])"
CARD = r"(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])"
SSN = r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])"
IPV4 = rf"(?<![0-9]\.){OCTET}(?:\.{OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])"
DATE = (
    r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}"
    r"|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?:(?=T[0-9])|(?![0-9A-Za-z]))"
)
KINDS = {
    "secret": SECRET, "access": ACCESS, "email": EMAIL, "iban": IBAN, "phone": PHONE, "e164": E164, "card": CARD,
    "ssn": SSN, "ipv4": IPV4, "date": DATE,
}
#: All kinds in one pattern; none begins within a run of letters and digits.
ANY = "(?<![0-9A-Za-z])(?:" + "|".join(KINDS.values()) + ")"

# days of the 400-year cycle of the calendar, as a product
YEARS, DAYS_A, DAYS_B = 400, 189, 773
SSN_A, SSN_B = 898 * 99, 9999


def keyed(key: str, kind: str, *parts: Column) -> Column:
    """A number from SHA-256 of the key and the parts, far above any modulus used here."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 14), 16, 10).cast("long")


def permuted_pair(a: Column, b: Column, m: int, n: int, key: str, kind: str) -> Column:
    """Struct (a, b) of residues modulo ``m`` and ``n``, permuted."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(x: Column, r: Column) -> Column:
        odd = r % 2 == 1
        return F.struct(
            F.when(odd, (x["a"] + keyed(key, kind, r, x["b"])) % m).otherwise(x["a"]).alias("a"),
            F.when(odd, x["b"]).otherwise((x["b"] + keyed(key, kind, r, x["a"])) % n).alias("b"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


#: Alphabet of a character, given the character, its index in its half and whether that is the second half.
Alphabet = Callable[[Column, Column, bool], Column]


def _moved(half: Column, other: Column, second: bool, r: Column, key: str, kind: str, alphabet: Alphabet) -> Column:
    def one(c: Column, i: Column) -> Column:
        letters = alphabet(c, i, second)
        size = F.length(letters)
        place = (F.position(c, letters) - 1 + keyed(key, kind, r, i, other)) % F.greatest(size, F.lit(1))
        return F.when(size > 0, F.substr(letters, place.cast("int") + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(half, ""), one), "")


def permuted(text: Column, key: str, kind: str, alphabet: Alphabet) -> Column:
    """The string with each character permuted within its alphabet; an empty alphabet leaves it."""
    middle = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(
        F.substr(text, F.lit(1), middle).alias("a"), F.substr(text, middle + 1, F.length(text)).alias("b")
    )

    def step(x: Column, r: Column) -> Column:
        odd = r % 2 == 1
        return F.struct(
            F.when(odd, _moved(x["a"], x["b"], False, r, key, kind, alphabet)).otherwise(x["a"]).alias("a"),
            F.when(odd, x["b"]).otherwise(_moved(x["b"], x["a"], True, r, key, kind, alphabet)).alias("b"),
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda x: F.concat(x["a"], x["b"])
    )


def by_class(c: Column, i: Column, second: bool) -> Column:
    return (
        F.when(c.between("0", "9"), F.lit(DIGITS))
        .when(c.between("a", "z"), F.lit(LOWER))
        .when(c.between("A", "Z"), F.lit(UPPER))
        .otherwise(F.lit(""))
    )


def _digits(c: Column, i: Column, second: bool) -> Column:
    return F.when(c.between("0", "9"), F.lit(DIGITS)).otherwise(F.lit(""))


def _phone_digits(c: Column, i: Column, second: bool) -> Column:
    # halves of five: area and the first two of the exchange, then the rest
    first = F.when(c.isin("0", "1"), F.lit("01")).otherwise(F.lit(FIRST))
    return F.lit(DIGITS) if second else F.when(i.isin(0, 3), first).otherwise(F.lit(DIGITS))


def _group(m: Column, pattern: str, n: int) -> Column:
    return F.regexp_extract(m, pattern, n)


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(permuted(local, key, "email", by_class), F.lit("@"), F.substring_index(m, "@", -1))


def _secret(m: Column, key: str) -> Column:
    shape = r"""^([^=:]*[=:][ \t]*["']?)(.*)$"""
    value = _group(m, shape, 2)
    hexadecimal = value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")

    def alphabet(c: Column, i: Column, second: bool) -> Column:
        letters = by_class(c, i, second)
        return F.when(hexadecimal & (letters != DIGITS), F.substr(letters, F.lit(1), F.lit(6))).otherwise(letters)

    return F.concat(_group(m, shape, 1), permuted(value, key, "secret", alphabet))


def _access(m: Column, key: str) -> Column:
    return F.concat(F.lit("AKIA"), permuted(F.substr(m, F.lit(5), F.length(m)), key, "access", by_class))


def _phone(m: Column, key: str) -> Column:
    shape = r"^(.*?)([0-9]{3})([^0-9]+)([0-9]{3})([^0-9]+)([0-9]{4})$"
    number = permuted(F.concat(*[_group(m, shape, g) for g in (2, 4, 6)]), key, "phone", _phone_digits)
    parts = [_group(m, shape, 1), F.substring(number, 1, 3), _group(m, shape, 3), F.substring(number, 4, 3)]
    return F.concat(*parts, _group(m, shape, 5), F.substring(number, 7, 4))


def _e164(m: Column, key: str) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    moved = F.concat(F.substring(digits, 1, 1), permuted(F.substr(digits, F.lit(2), F.length(digits)), key, "e164", _digits))

    def put(x: Column, c: Column) -> Column:
        """The next digit in place of a digit; what lies between them stays."""
        number = c.between("0", "9")
        digit = F.substr(moved, x["n"] + 1, F.lit(1))
        return F.struct(F.concat(x["s"], F.when(number, digit).otherwise(c)).alias("s"), (x["n"] + number.cast("int")).alias("n"))

    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("n"))
    return F.aggregate(F.split(m, ""), start, put, lambda x: x["s"])


def luhn_sum(digits: Column, after: int) -> Column:
    """Luhn sum of the digits when ``after`` more digits follow them."""

    def one(c: Column, i: Column) -> Column:
        twice = c.cast("int") * F.when((i + after) % 2 == 1, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda a, v: a + v)


def _card(m: Column, key: str) -> Column:
    digits, gap = F.regexp_replace(m, "[^0-9]", ""), _group(m, "([ -])", 1)
    body = F.substr(digits, F.lit(2), F.length(digits) - 2)
    body = F.concat(F.substring(digits, 1, 1), permuted(body, key, "card", _digits))
    whole = F.concat(body, F.pmod(-luhn_sum(body, 1), F.lit(10)).cast("string"))
    fours = [F.substring(whole, at, 4) for at in (1, 5, 9, 13)]
    grouped = (
        F.when(gap == "", whole)
        .when(F.length(digits) == 16, F.concat_ws(" ", *fours))
        .otherwise(F.concat_ws(" ", F.substring(whole, 1, 4), F.substring(whole, 5, 6), F.substring(whole, 11, 5)))
    )
    spaced = F.when(gap == "-", F.translate(grouped, " ", "-")).otherwise(grouped)
    return F.when(luhn_sum(digits, 0) % 10 == 0, spaced).otherwise(m)


def iban_mod(text: Column) -> Column:
    """The characters as a number (letters are 10 to 35), modulo 97."""

    def add(a: Column, c: Column) -> Column:
        letter = a * 100 + F.position(c, F.lit(UPPER)) + 9
        return F.when(c.between("0", "9"), a * 10 + F.position(c, F.lit(DIGITS)) - 1).otherwise(letter) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(m: Column, key: str) -> Column:
    plain = F.translate(m, " ", "")
    country, account = F.substring(plain, 1, 2), F.substr(plain, F.lit(5), F.length(plain))
    valid = iban_mod(F.concat(account, F.substring(plain, 1, 4))) == 1
    moved = permuted(account, key, "iban", by_class)
    check = F.lpad((98 - iban_mod(F.concat(moved, country, F.lit("00")))).cast("string"), 2, "0")
    whole = F.concat(country, check, moved)
    spaced = F.when(m.contains(" "), F.regexp_replace(whole, "(.{4})(?=.)", "$1 ")).otherwise(whole)
    return F.when(valid, spaced).otherwise(m)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    area = area - F.when(area > 666, 2).otherwise(1)  # 0 to 897: 666 is no area
    pair = permuted_pair(area * 99 + group - 1, serial - 1, SSN_A, SSN_B, key, "ssn")
    first = F.floor(pair["a"] / 99)
    first = first + F.when(first >= 665, 2).otherwise(1)
    parts = [F.lpad(x.cast("string"), n, "0") for x, n in ((first, 3), (pair["a"] % 99 + 1, 2), (pair["b"] + 1, 4))]
    return F.concat_ws("-", *parts)


def _ipv4(m: Column, key: str) -> Column:
    o = [F.split_part(m, F.lit("."), F.lit(k)).cast("long") for k in (1, 2, 3, 4)]
    pair = permuted_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ipv4")
    parts = [F.floor(pair["a"] / 256), pair["a"] % 256, F.floor(pair["b"] / 256), pair["b"] % 256]
    return F.concat_ws(".", *[p.cast("string") for p in parts])


#: Steps of the walk to a date that only d/m/Y can be; each ends it in three of five cases.
WALK = 64


def _moved_date(day: Column, key: str) -> Column:
    """Another day of the same 400-year cycle."""
    place = F.pmod(F.datediff(day, F.to_date(F.lit("1601-01-01"))), F.lit(DAYS_A * DAYS_B))
    pair = permuted_pair(F.floor(place / DAYS_B), place % DAYS_B, DAYS_A, DAYS_B, key, "date")
    return F.date_add(day, (pair["a"] * DAYS_B + pair["b"] - place).cast("int"))


def _known(day: Column) -> Column:
    return day.isNotNull() & F.year(day).between(1601, 1600 + 2 * YEARS)


def _date(m: Column, key: str) -> Column:
    out = m
    for shape, form in (("-", "yyyy-MM-dd"), ("^..../", "yyyy/MM/dd"), ("\\.", "dd.MM.yyyy"), ("^../", "MM/dd/yyyy")):
        day = F.try_to_date(m, form)
        moved = F.when(_known(day), F.date_format(_moved_date(day, key), form)).otherwise(m)
        if form == "MM/dd/yyyy":
            # days beyond the twelfth, permuted among themselves: on until one is reached
            late = F.try_to_date(m, "dd/MM/yyyy")
            walk = F.aggregate(
                F.sequence(F.lit(1), F.lit(WALK)), _moved_date(late, key),
                lambda x, _: F.when(F.dayofmonth(x) > 12, x).otherwise(_moved_date(x, key)),
            )
            only = day.isNull() & _known(late)
            moved = F.when(only, F.date_format(walk, "dd/MM/yyyy")).otherwise(moved)
        out = F.when(m.rlike(shape), moved).otherwise(out)
    return out


MOVES = {
    "secret": _secret, "access": _access, "email": _email, "iban": _iban, "phone": _phone, "e164": _e164,
    "card": _card, "ssn": _ssn, "ipv4": _ipv4, "date": _date,
}


def pseudonym(match: Column, key: str = KEY) -> Column:
    """The pseudonym of one found value."""
    out = None
    for kind, pattern in KINDS.items():
        test, moved = match.rlike(f"^(?:{pattern})$"), MOVES[kind](match, key)
        out = F.when(test, moved) if out is None else out.when(test, moved)
    return out.otherwise(match)


def pseudonymised(text: Column, key: str = KEY) -> Column:
    """The text with every found value replaced."""
    found = F.regexp_extract_all(text, F.lit(ANY), 0)
    pieces = F.zip_with(
        F.split(text, ANY, -1),
        F.transform(found, lambda m: pseudonym(m, key)),
        lambda before, new: F.concat(before, F.coalesce(new, F.lit(""))),
    )
    return F.when(text.rlike(ANY), F.array_join(pieces, "")).otherwise(text)


def private(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """The documents with all their columns, personal data in the text replaced."""
    return docs.withColumn(text_col, pseudonymised(docs[text_col], key))


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, the text after replacement, and how many values were found."""
    text = docs["text"]
    n = F.when(text.rlike(ANY), F.size(F.regexp_extract_all(text, F.lit(ANY), 0))).otherwise(F.lit(0))
    return docs.select(docs["doc_id"].alias("doc_id"), pseudonymised(text, key).alias("text"), n.alias("n_found"))
