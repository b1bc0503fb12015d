"""Format-preserving pseudonyms for personal values, by a keyed Feistel network.

Values are found by pattern, checked (Luhn digits of card numbers, remainder 97 of account numbers,
calendar of dates, ranges of addresses and social security numbers, digit count of phones), taken
apart into units with a radix each, and permuted: the units are dealt to two halves, and in each
round one half is shifted, unit by unit modulo its radix, by a SHA-256 of key, kind, format, round
and the other half. That is a permutation of the format, so different values stay different, and
equal values get equal pseudonyms in all documents. Check digits are computed anew, so pseudonyms
are valid again. Separators stay where they were and do not change the pseudonym's digits. Invalid
look-alikes and all other text stay as they are. A number does not run into the value after it, and one
that fails its check as a whole is read again number by number.

Everything is a built-in expression; documents never shuffle. The key is a parameter and should
come from a secret store.

Kinds: ``email`` (letters and digits of the local part and the domain's first label), ``ipv4``,
``date`` (ISO and day-first with dots, years 1800 to 2199), ``ssn``, ``card`` (13 to 19 digits),
``iban``, ``phone`` (``+`` and 8 to 15 digits; the country's first digit stays), ``secret``
(hexadecimal strings named as key, token, secret or password).

Defined results: a null text stays null with no values; empty texts stay empty; repeated rows get
equal results; all other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream.llm.common import hidden

DEFAULT_KEY = "rankstream-pseudonyms"
ROUNDS = 8
# A Gregorian cycle of 400 years has 146,097 = 189 * 773 days.
_FIRST_DAY, _DATE_RADIX = "1800-01-01", (189, 773)

# Account number lengths by country; other countries' are taken at any length.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK",
    21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL",
    24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR",
    27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}


def _iban_of(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{countries})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}"


_IBANS = "|".join(_iban_of(n, names) for n, names in _IBAN_LENGTHS.items())
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# Values that a number before them and a space do not run into.
_TYPED = (
    rf"(?:(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9A-Za-z])|[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9A-Za-z-])"
    r"|(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z-]))"
)
_CARD_LAYOUT = (
    "[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}"
)
_DIGIT = "[ .()-]{0,3}[0-9]"
_DIALLED = rf"(?<=\+{_DIGIT * 8}{f'(?:{_DIGIT})?' * 7})"  # 8 to 15 digits since the sign

_PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}",
    "secret": r"(?<=(?i:token|secret|password|key)\s{0,3}[=:]\s{0,3}[\"']?)[0-9A-Fa-f]{16,}+(?![0-9A-Za-z])",
    "iban": rf"(?<![A-Za-z0-9])(?:(?:{_IBANS})|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9+])\+[1-9][0-9]{0,2}(?:[ .-]?\([0-9]{1,4}\))?"
    rf"(?:(?!{_DIALLED} (?:{_TYPED}|[0-9](?:[ -]?[0-9]){{12}}))[ .-]?[0-9]{{1,12}}){{1,5}}(?![0-9A-Za-z]){_DIALLED}",
    "ipv4": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9A-Za-z])",
    "date": r"(?<![0-9A-Za-z.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "card": rf"(?<![0-9A-Za-z])(?![0-9]{{20}})[0-9](?:(?! {_TYPED}|[ -][0-9]{{20}})[ -]?[0-9]){{12,}}(?![0-9A-Za-z])",
}
# What a value must start with: looked at first, so that most places in a text fail at once.
_STARTS = {
    "secret": "[0-9A-Fa-f]{16}", "iban": "[A-Z]{2}[0-9]{2}", "phone": r"\+[1-9]", "ipv4": "[0-9]",
    "date": "[0-9]", "ssn": "[0-9]{3}-", "card": "[0-9]",
}
PATTERN = "|".join(
    f"(?={_STARTS[kind]}){pattern}" if kind in _STARTS else pattern for kind, pattern in _PATTERNS.items()
)
KINDS = tuple(_PATTERNS)
# Around each match stands a mark. Marks and escapes of the text itself are written as an escape and one
# of two more characters; none of them is part of any value.
_ESCAPE, _MARK, _OWN_ESCAPE, _OWN_MARK = "\u0001", "\u0002", "\u0003", "\u0004"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _unit(value: Column, radix: Column) -> Column:
    return F.struct(value.cast("long").alias("v"), radix.cast("long").alias("m"))


def feistel(units: Column, kind: str, key: str, rounds: int = ROUNDS) -> Column:
    """The units (arrays of value ``v`` and radix ``m``) permuted; radices keep their places."""
    def turn(state: Column, number: Column) -> Column:
        """The left half shifted by the right one, then both halves swapped."""
        seed = F.concat_ws(
            "|", F.lit(key), F.lit(kind), number.cast("string"),
            F.concat_ws(",", F.transform(state.b, lambda u: u.v.cast("string"))),
            F.concat_ws(",", F.transform(F.concat(state.a, state.b), lambda u: u.m.cast("string"))),
        )

        def shift(text: Column) -> Column:
            def shifted(u: Column, place: Column) -> Column:
                digest = F.sha2(F.concat_ws("#", text, place.cast("string")), 256)
                step = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
                return _unit((u.v + step) % u.m, u.m)

            return F.transform(state.a, shifted)

        return F.struct(state.b.alias("a"), _let(seed, shift).alias("b"))

    def mix(whole: Column) -> Column:
        cut = F.floor((F.size(whole) + 1) / 2).cast("int")
        start = F.struct(
            F.slice(whole, F.lit(1), cut).alias("a"),
            F.slice(whole, cut + 1, F.size(whole)).alias("b"),
        )
        mixed = F.aggregate(F.sequence(F.lit(1), F.lit(2 * (rounds // 2))), start, turn)
        return _let(mixed, lambda halves: F.concat(halves["a"], halves["b"]))

    return _let(units, mix)


def _code(char: Column) -> Column:
    return F.ascii(char)


def _char_units(text: Column) -> Column:
    """Letters and digits as units of radix 26 and 10."""
    def unit(c: Column) -> Column:
        code = _code(c)
        return (
            F.when(c.rlike("[0-9]"), _unit(code - 48, F.lit(10)))
            .when(c.rlike("[a-z]"), _unit(code - 97, F.lit(26)))
            .otherwise(_unit(code - 65, F.lit(26)))
        )

    return F.transform(_chars(F.regexp_replace(text, "[^0-9A-Za-z]", "")), unit)


def _put_back(text: Column, symbols: Column) -> Column:
    """``text`` with its letters and digits replaced, in order, by an array of characters."""
    def filled(known: Column) -> Column:
        def add(acc: Column, c: Column) -> Column:
            is_symbol = c.rlike("[0-9A-Za-z]")
            return F.struct(
                F.concat(acc.done, F.when(is_symbol, F.get(known, acc.next)).otherwise(c)).alias("done"),
                (acc.next + is_symbol.cast("int")).alias("next"),
            )

        start = F.struct(F.lit("").alias("done"), F.lit(0).alias("next"))
        return F.aggregate(_chars(text), start, add)["done"]

    return _let(symbols, filled)


def _permuted_chars(text: Column, kind: str, key: str) -> Column:
    """Letters and digits of the text permuted within their classes, the rest in place."""
    units = _char_units(text)
    mixed = feistel(units, kind, key)
    originals = _chars(F.regexp_replace(text, "[^0-9A-Za-z]", ""))
    symbols = F.zip_with(
        originals, mixed,
        lambda c, u: F.char(
            u.v + F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).otherwise(65)
        ),
    )
    return _put_back(text, symbols)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn_sum(digits: Column, double_last: bool) -> Column:
    """The Luhn sum; ``double_last`` where the check digit is still missing."""
    def add(acc: Column, c: Column) -> Column:
        value = c.cast("int") * F.when(acc.double, 2).otherwise(1)
        return F.struct(
            (acc.total + F.when(value > 9, value - 9).otherwise(value)).alias("total"),
            (~acc.double).alias("double"),
        )

    start = F.struct(F.lit(0).alias("total"), F.lit(double_last).alias("double"))
    return F.aggregate(F.reverse(_chars(digits)), start, add)["total"]


def _mod97(text: Column) -> Column:
    """Remainder by 97 of letters and digits, letters counting from 10."""
    def add(acc: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise(
            (acc * 100 + _code(c) - 55) % 97
        )

    return F.aggregate(_chars(text), F.lit(0), add)


def _email(found: Column, key: str) -> Column:
    local, rest = F.substring_index(found, "@", 1), F.substring_index(found, "@", -1)
    label = F.substring_index(rest, ".", 1)
    mixed = _permuted_chars(F.concat_ws("@", local, label), "email", key)
    return F.concat(mixed, F.substring(rest, F.length(label) + 1, F.length(rest)))


def _ipv4(found: Column, key: str) -> Column:
    units = F.transform(F.split(found, r"\."), lambda o: _unit(o, F.lit(256)))
    return F.concat_ws(".", F.transform(feistel(units, "ipv4", key), lambda u: u.v.cast("string")))


def _day(found: Column) -> Column:
    iso = found.rlike("^[0-9]{4}-")
    return F.when(iso, F.try_to_date(found, "yyyy-MM-dd")).otherwise(
        F.try_to_date(found, "dd.MM.yyyy")
    )


def _date(found: Column, key: str) -> Column:
    number = F.datediff(_day(found), F.lit(_FIRST_DAY).cast("date"))
    first, second = _DATE_RADIX
    units = F.array(
        _unit(F.floor(number / second), F.lit(first)), _unit(number % second, F.lit(second))
    )
    number = _let(
        feistel(units, "date", key), lambda mixed: mixed[0]["v"] * second + mixed[1]["v"]
    )
    day = F.date_add(F.lit(_FIRST_DAY).cast("date"), number.cast("int"))
    return F.when(found.rlike("^[0-9]{4}-"), F.date_format(day, "yyyy-MM-dd")).otherwise(
        F.date_format(day, "dd.MM.yyyy")
    )


def _ssn(found: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups from 01, serials from 0001."""
    area, group, serial = (F.get(F.split(found, "-"), i).cast("int") for i in range(3))
    units = F.array(
        _unit(area - 1 - (area > 666).cast("int"), F.lit(898)),
        _unit(group - 1, F.lit(99)),
        _unit(serial - 1, F.lit(9999)),
    )

    def written(mixed: Column) -> Column:
        a = mixed[0]["v"] + 1
        a = a + (a >= 666).cast("int")
        return F.format_string("%03d-%02d-%04d", a, mixed[1]["v"] + 1, mixed[2]["v"] + 1)

    return _let(feistel(units, "ssn", key), written)


def _card(found: Column, key: str) -> Column:
    digits = _digits(found)
    payload = F.substring(digits, F.lit(1), F.length(digits) - 1)

    def checked(mixed: Column) -> Column:
        return F.concat(mixed, ((F.lit(10) - _luhn_sum(mixed, True) % 10) % 10).cast("string"))

    return _put_back(found, _chars(_let(_permuted_chars(payload, "card", key), checked)))


def _iban(found: Column, key: str) -> Column:
    plain = F.regexp_replace(found, " ", "")
    country = F.substring(plain, 1, 2)

    def checked(account: Column) -> Column:
        check = F.lit(98) - _mod97(F.concat(account, country, F.lit("00")))
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)

    account = _permuted_chars(F.substring(plain, F.lit(5), F.length(plain)), "iban", key)
    return _put_back(found, _chars(_let(account, checked)))


def _phone(found: Column, key: str) -> Column:
    digits = _digits(found)
    mixed = _permuted_chars(F.substring(digits, F.lit(2), F.length(digits)), "phone", key)
    return _put_back(found, _chars(F.concat(F.substring(digits, 1, 1), mixed)))


def _secret(found: Column, key: str) -> Column:
    low = F.lower(found)
    units = F.transform(_chars(low), lambda c: _unit(F.conv(c, 16, 10), F.lit(16)))
    mixed = F.concat_ws("", F.transform(feistel(units, "secret", key), lambda u: F.lower(F.hex(u.v))))
    return _let(mixed, lambda m: F.when(found == low, m).otherwise(F.upper(m)))


def kind_of(found: Column) -> Column:
    """The kind that the matched string validly is, else ``none``."""
    digits = _digits(found)
    octets = F.split(found, r"\.")
    in_range = F.forall(octets, lambda o: o.cast("int") <= 255)
    plain_octets = F.forall(octets, lambda o: ~o.rlike("^0[0-9]"))
    parts = F.split(found, "-")
    area, group, serial = (F.get(parts, i).cast("int") for i in range(3))
    plain = F.regexp_replace(found, " ", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    same = F.length(F.regexp_replace(digits, "(.)(?=.*\\1)", "")) == 1  # one repeated digit
    is_ip = found.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    is_ssn = found.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
    is_date = found.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})$")
    is_iban = found.rlike(r"^[A-Z]{2}[0-9]{2}[ A-Z0-9]+$")
    is_card = found.rlike(r"^[0-9][0-9 -]*$") & F.length(digits).between(13, 19)
    return (
        F.when(found.contains("@"), "email")
        .when(found.startswith("+"), F.when(F.length(digits).between(8, 15), "phone"))
        .when(is_ip, F.when(in_range & plain_octets, "ipv4"))
        .when(is_date, F.when(F.year(_day(found)).between(1800, 2199), "date"))
        .when(is_ssn, F.when((area.between(1, 899)) & (area != 666) & (group > 0) & (serial > 0), "ssn"))
        .when(is_card, F.when((_luhn_sum(digits, False) % 10 == 0) & ~same, "card"))
        .when(is_iban, F.when(_mod97(moved) == 1, "iban"))
        .when(found.rlike("^[0-9A-Fa-f]{16,}$"), "secret")
    )


PIECE = "array<struct<value: string, kind: string>>"


def pieces(found: Column) -> Column:
    """The match as (value, kind) pieces; null kinds stay as they are.

    A match that is no value as a whole is read again number by number: at each, the longest run of
    numbers in a card's layout, or an account number, that is valid; at the first, any grouping.
    """
    def one(value: Column, kind: Column) -> Column:
        return F.array(F.struct(value.alias("value"), kind.alias("kind")))

    def read(parts: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            def run(size: Column) -> Column:
                return _let(
                    F.array_join(F.slice(parts, i, size), ""),
                    lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind"), size.alias("size")),
                )

            left = F.size(parts) - i + 1
            odd = F.filter(F.sequence(F.lit(37), F.lit(1), F.lit(-2)), lambda n: n <= left)
            valid = F.filter(
                F.transform(odd, run),
                lambda r: (r["kind"] == "iban")
                | ((r["kind"] == "card") & ((i == 1) | r["value"].rlike(f"^(?:{_CARD_LAYOUT})$"))),
            )

            def taken(hit: Column) -> Column:
                part = one(
                    F.coalesce(hit["value"], F.element_at(parts, i)), hit["kind"]
                )
                return F.struct(
                    F.concat(acc.done, part).alias("done"),
                    (i + F.coalesce(hit["size"], F.lit(1))).alias("next"),
                )

            number = F.element_at(parts, i).rlike("[0-9A-Z]")
            moved = F.when(number, _let(F.get(valid, F.lit(0)), taken)).otherwise(
                F.struct(
                    F.concat(acc.done, one(F.element_at(parts, i), F.lit(None).cast("string"))).alias("done"),
                    (i + 1).alias("next"),
                )
            )
            return F.when(i < acc.next, acc).otherwise(moved)

        start = F.struct(F.array().cast(PIECE).alias("done"), F.lit(1).alias("next"))
        return F.aggregate(F.sequence(F.lit(1), F.size(parts)), start, step)["done"]

    def judged(kind: Column) -> Column:
        again = kind.isNull() & found.rlike("^[0-9A-Z]+[ -][0-9A-Z -]+$") & (F.length(found) > 13)
        again = again & ~found.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$|^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
        split = F.regexp_extract_all(found, F.lit("[0-9A-Z]+|[ -]"), F.lit(0))
        return F.when(again, _let(split, read)).otherwise(one(found, kind))

    return _let(kind_of(found), judged)


_REPLACE: dict[str, Callable[[Column, str], Column]] = {
    "email": _email, "secret": _secret, "iban": _iban, "phone": _phone, "ipv4": _ipv4,
    "date": _date, "ssn": _ssn, "card": _card,
}


def pseudonym(found: Column, kind: Column, key: str) -> Column:
    choice = None
    for name, replace in _REPLACE.items():
        branch = replace(found, key)
        choice = F.when(kind == name, branch) if choice is None else choice.when(kind == name, branch)
    return choice.otherwise(found)


def _escaped(text: Column) -> Column:
    once = F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + _OWN_ESCAPE))
    return F.replace(once, F.lit(_MARK), F.lit(_ESCAPE + _OWN_MARK))


def _unescaped(text: Column) -> Column:
    once = F.replace(text, F.lit(_ESCAPE + _OWN_MARK), F.lit(_MARK))
    return F.replace(once, F.lit(_ESCAPE + _OWN_ESCAPE), F.lit(_ESCAPE))


def pseudonymised(
    docs: DataFrame, text: str = "text", key: str = DEFAULT_KEY, counts: str | None = None
) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; ``counts`` names a map from kind to values replaced."""
    content = F.col(f"`{text}`")
    parts, found = hidden("parts"), hidden("found")
    # most texts have no digit and no address: they skip the search
    maybe = content.rlike("[0-9@]")
    marked = F.regexp_replace(_escaped(content), PATTERN, f"{_MARK}$0{_MARK}")
    # gaps and matches in turn, in one search of the text
    staged = docs.withColumn(parts, F.when(maybe, F.split(marked, _MARK, -1)))
    searched = F.size(parts) > 1
    matches = F.filter(parts, lambda _, i: i % 2 == 1)
    staged = staged.withColumn(found, F.when(searched, F.transform(matches, pieces)))
    replaced = F.transform(
        F.col(found),
        lambda read: F.concat_ws("", F.transform(read, lambda f: pseudonym(f["value"], f["kind"], key))),
    )
    gaps = F.filter(parts, lambda _, i: i % 2 == 0)
    whole_pieces = F.zip_with(
        F.transform(gaps, _unescaped), replaced, lambda gap, value: F.concat(gap, F.coalesce(value, F.lit("")))
    )
    whole = F.when(searched, F.concat_ws("", whole_pieces)).otherwise(content)
    result = staged.withColumn(text, whole) if not counts else staged.withColumn(
        counts,
        F.map_from_entries(
            F.transform(
                F.array(*[F.lit(k) for k in _REPLACE]),
                lambda k: F.struct(
                    k.alias("key"),
                    F.coalesce(
                        F.size(F.filter(F.flatten(found), lambda f: f["kind"] == k)), F.lit(0)
                    ).cast("long").alias("value"),
                ),
            )
        ),
    ).withColumn(text, whole)
    return result.drop(parts, found)
