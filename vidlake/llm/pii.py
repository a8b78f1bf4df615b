"""PII: format-preserving pseudonyms from a keyed Feistel network.

Found are e-mail addresses, phone numbers, IP addresses, card numbers, social
security numbers, IBANs, dates and credentials (access keys and tokens of the usual
issuers, and values given to `password`, `token` and the like). A match is replaced only if it is valid: Luhn
for cards, mod 97 for IBANs, octets up to 255, real days of the calendar, real
number ranges. Its replacement is valid too and has the same format, and as a
permutation under one key it is the same wherever the value occurs, in any
document and any punctuation, so linked values stay linked and different values
stay different.

- Digits, small and capital letters are permuted in place, each among its own
  kind. ROUNDS times, one half of the characters is shifted by a keyed hash of the
  other.
- Cards keep a right check digit, IBANs their country and right check digits, IPv4
  addresses are permuted as 32 bits, and the leading digits of North American
  numbers stay in 2 to 9. Of social security numbers only the format stays. The country code of a phone number, the prefix of an
  access key and the domain of an address stay. A phone number is linked whether written
  with + or 00, with or without a bracketed 0, and however it is grouped; one without a
  country code keeps its leading 0. Letters of an address are linked in either case.
  IPv6 addresses are permuted digit by digit, as written. Numbers behind +1 and those with a
  bracketed area code are taken whatever digits they have; there 0 and 1 are permuted
  among themselves where others have 2 to 9.
- Dates are permuted as days of the 400 years from 1800, by halves modulo 189 and
  773 (189 * 773 days), so every day stays a day.

Valid cards and IBANs are listed before a text is searched, with every length they may have, so
that a number or word next to one (expiry, security code, BIC, currency) does not
hide it: a run of digits or of an IBAN's groups is tried as a whole and up to each of
its separators, and card-like groups (4-4-4-4, 4-6-5, 4-6-4, 13 to 19 digits in one)
are tried wherever they begin. Only valid ones are taken, the longer one first, and
the text around them is searched as any other.

Everything is built-in Spark expressions. The key is a literal in the plan; keep
plans of production runs as safe as the key. The caller gives it, or session_key()
takes it from the setting KEY_SETTING, without which a session has a random one of its own, so
that its pseudonyms are linked with each other and with none of another session.

Cases: null text stays null with no value found; empty text stays empty. Rows
that repeat are treated alike. Slashed dates are read month first if that is a
day, else day first. Other columns are returned as they are.
"""

from __future__ import annotations

import secrets
import warnings
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8
KEY_SETTING = "spark.vidlake.pii.key"
# Prefixes of access keys, and the calling codes of countries, those of
# one and two digits by themselves.
_KEY_HEAD = r"(?:AKIA|ASIA|gh[oprsu]_|github_pat_|[prs]k_(?:live|test)_|xox[abprs]-|AIza|eyJ)"
_COUNTRY = "(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"

# So many digits; written out, as a pattern that looks back cannot count.
_DIGIT = "[ .()-]{0,3}[0-9]"
_EIGHT_TO_15 = _DIGIT * 8 + f"(?:{_DIGIT}" * 7 + ")?" * 7
# Patterns, tried in this order at every place. Possessive runs keep long words
# from being searched again from each of their letters.
_PATTERNS = {
    "credential": r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api[_-]?key)(?:\s{0,3}[=:]\s{0,3}[\"']?|\s{1,3}is:?\s{1,3}[\"']?(?=[A-Za-z_+/.-]*[0-9]))[A-Za-z0-9_+/.-]{8,}+",
    "key": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[oprsu]_[A-Za-z0-9]{36,}+|github_pat_[A-Za-z0-9_]{22,}+|[prs]k_(?:live|test)_[A-Za-z0-9]{16,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)(?![A-Za-z0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{2,4}(?::[0-9A-Fa-f]{1,4}){0,5}::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})(?![0-9A-Za-z:]|\.[0-9])",
    "iso_date": r"(?<![0-9A-Za-z-])[0-9]{4}([-/])[0-9]{2}\1[0-9]{2}(?![0-9-])",
    "dot_date": r"(?<![0-9A-Za-z.])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![0-9]|\.[0-9])",
    "slash_date": r"(?<![0-9A-Za-z/])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9/])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "nanp": r"(?<![0-9A-Za-z+])(?:\+1[ .-]?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}|(?:1[ .-]?)?(?:\([0-9]{3}\) ?[0-9]{3}|[2-9][0-9]{2}[ .-][2-9][0-9]{2})[ .-][0-9]{4})(?![0-9])",
    "phone": rf"(?<![0-9A-Za-z+])(?:\+[2-9][0-9]{{0,2}}|00[2-9][0-9]{{0,2}}(?=[ .(-]))(?:[ .-]?\(?[0-9]{{1,5}}\)?){{2,7}}(?<=(?:\+|00){_EIGHT_TO_15}\)?)(?![0-9])",
    "national": r"(?<![0-9A-Za-z+.,/:-])(?=(?:[0-9 ()]){11,17}(?![0-9]))\(?0[1-9][0-9]{0,4}\)?(?: [0-9]{2,8}){1,4}(?<=[0-9 )][0-9 ][0-9]{2,8})(?![0-9]|[ .,/:-][0-9])",
    "card": r"(?<![0-9A-Za-z.])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
# Card-like groups and IBANs, at every place they begin.
_CARD_FORM = (
    r"(?<![0-9A-Za-z.+])(?=[3-6]|2[2-7])"
    r"(?=([0-9]{13,19}(?![0-9])|(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9])|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}(?![0-9])))"
)
_IBAN_FORM = f"(?=({_PATTERNS['iban']}))"


def _several(names: list[str]) -> str:
    """One alternation without groups of its own kind that could be captured twice."""
    return "|".join(_PATTERNS[k].replace(r"([-/])", "(?:[-/])").replace(r"\1", "[-/]") for k in names)


_DAY_ZERO = "1800-01-01"
_LOW, _HIGH = 189, 773
# Stand-ins for digits that only run from 2 to 9, for those below, and for four bits.
_EIGHT = "ÀÁÂÃÄÅÆÇ"
_TWO = "ðñ"
_SIXTEEN = "ÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞß"


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _keyed(key: str, tweak: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), tweak.cast("string"), other.cast("string")), 256)


def _shifted(half: Column, other: Column, step: Column, key: str) -> Column:
    """half with every character moved within its kind by a hash of the other."""

    def move(stream: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            code = F.ascii(c)
            by = F.conv(F.substr(stream, i * 4 + 1, F.lit(4)), 16, 10).cast("int")

            def among(first: int, n: int) -> Column:
                return F.char(F.lit(first) + F.pmod(code - first + by, F.lit(n)))

            return (
                F.when(code.between(48, 57), among(48, 10))
                .when(code.between(97, 122), among(97, 26))
                .when(code.between(65, 90), among(65, 26))
                .when(code.between(192, 199), among(192, 8))
                .when(code.between(240, 241), among(240, 2))
                .otherwise(among(208, 16))
            )

        return F.array_join(F.transform(_chars(half), one), "")

    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), (F.length(half) - 1) / F.lit(16)).cast("int")),
        lambda b: _keyed(key, F.concat_ws("/", step.cast("string"), b.cast("string"), F.length(half)), other),
    )
    return _let(F.array_join(blocks, ""), move)


def permuted(value: Column, key: str) -> Column:
    """A string of digits, letters and stand-ins, permuted among its like."""
    middle = F.floor(F.length(value) / 2).cast("int")
    left, right = F.substr(value, F.lit(1), middle), F.substr(value, middle + 1)

    def step(state: Column, i: Column) -> Column:
        l, r = state["l"], state["r"]
        even = i % 2 == 0
        return F.struct(
            F.when(even, l).otherwise(_shifted(l, r, i, key)).alias("l"),
            F.when(even, _shifted(r, l, i, key)).otherwise(r).alias("r"),
        )

    begin = F.struct(left.alias("l"), right.alias("r"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), begin, step, lambda s: F.concat(s["l"], s["r"])
    )


def _plain(value: Column) -> Column:
    return F.regexp_replace(value, "[^A-Za-z0-9]", "")


def _filled(shape: Column, content: Column) -> Column:
    """Letters and digits of the shape replaced, one by one, by the content."""
    return F.array_join(
        F.transform(
            _chars(shape),
            lambda c, i: F.when(
                c.rlike("[A-Za-z0-9]"), F.substr(content, F.length(_plain(F.substr(shape, F.lit(1), i + 1))), F.lit(1))
            ).otherwise(c),
        ),
        "",
    )


def _in_place(value: Column, key: str) -> Column:
    return _filled(value, permuted(_plain(value), key))


def luhn(digits: Column) -> Column:
    """Luhn sum of a number whose last digit is the check digit."""
    doubled = F.transform(
        F.reverse(_chars(digits)),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d)


def _card(value: Column, key: str) -> Column:
    payload = F.substr(_plain(value), F.lit(1), F.length(_plain(value)) - 1)
    return _filled(
        value,
        _let(permuted(payload, key), lambda p: F.concat(p, F.pmod(-luhn(F.concat(p, F.lit("0"))), F.lit(10)).cast("string"))),
    )


def mod97(plain: Column) -> Column:
    """Remainder of an IBAN, letters read as 10 to 35, its head put last."""
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(total: Column, c: Column) -> Column:
        digit = F.ascii(c).between(48, 57)
        return F.when(digit, (total * 10 + F.ascii(c) - 48) % 97).otherwise((total * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(_chars(turned), F.lit(0), add)


def _iban(value: Column, key: str) -> Column:
    plain = _plain(value)
    country = F.substr(plain, F.lit(1), F.lit(2))
    return _filled(
        value,
        _let(
            permuted(F.substr(plain, F.lit(5)), key),
            lambda b: F.concat(
                country, F.lpad((98 - mod97(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0"), b
            ),
        ),
    )


def _ip(value: Column, key: str) -> Column:
    bits = F.array_join(F.transform(F.split(value, r"\."), lambda o: F.lpad(F.hex(o.cast("int")), 2, "0")), "")
    coded = permuted(F.translate(bits, "0123456789ABCDEF", _SIXTEEN), key)
    return _let(
        F.translate(coded, _SIXTEEN, "0123456789ABCDEF"),
        lambda h: F.array_join(
            F.transform(F.array(*(F.lit(k) for k in (1, 3, 5, 7))), lambda k: F.conv(F.substr(h, k, F.lit(2)), 16, 10)), "."
        ),
    )


def _nanp(value: Column, key: str) -> Column:
    plain = _plain(value)
    local = F.substr(plain, F.length(plain) - 9)
    coded = F.concat(
        F.translate(F.substr(local, F.lit(1), F.lit(1)), "0123456789", _TWO + _EIGHT),
        F.substr(local, F.lit(2), F.lit(2)),
        F.translate(F.substr(local, F.lit(4), F.lit(1)), "0123456789", _TWO + _EIGHT),
        F.substr(local, F.lit(5)),
    )
    head = F.substr(plain, F.lit(1), F.length(plain) - 10)
    return _filled(value, F.concat(head, F.translate(permuted(coded, key), _TWO + _EIGHT, "0123456789")))


def _phone(value: Column, key: str) -> Column:
    """The country code stays, and so does a bracketed 0."""
    head = F.regexp_extract(value, rf"^(?:\+|00){_COUNTRY}", 0)
    rest = F.replace(F.substr(value, F.length(head) + 1), F.lit("(0)"), F.lit("(\x01)"))
    return F.concat(head, F.replace(_in_place(rest, key), F.lit("\x01"), F.lit("0")))


def _national(value: Column, key: str) -> Column:
    """The first 0 stays."""
    head = F.regexp_extract(value, r"^\(?0", 0)
    return F.concat(head, _in_place(F.substr(value, F.length(head) + 1), key))


def _either_case(value: Column, key: str) -> Column:
    """Permuted as in small letters, with capitals where they were."""
    return _let(
        _in_place(F.lower(value), key),
        lambda new: F.array_join(
            F.transform(
                _chars(value),
                lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.substr(new, i + 1, F.lit(1)))).otherwise(
                    F.substr(new, i + 1, F.lit(1))
                ),
            ),
            "",
        ),
    )


def _ipv6(value: Column, key: str) -> Column:
    digits = F.translate(F.lower(_plain(value)), "0123456789abcdef", _SIXTEEN)
    new = _filled(value, F.translate(permuted(digits, key), _SIXTEEN, "0123456789abcdef"))
    return F.when(value.rlike("[A-F]"), F.upper(new)).otherwise(new)


def _moved_day(day: Column, key: str) -> Column:
    index = F.datediff(day, F.to_date(F.lit(_DAY_ZERO)))

    def by(state_half: Column, i: Column) -> Column:
        return F.conv(F.substr(_keyed(key, i, state_half), F.lit(1), F.lit(12)), 16, 10).cast("long")

    def step(state: Column, i: Column) -> Column:
        a, b = state["a"], state["b"]
        even = i % 2 == 0
        return F.struct(
            F.when(even, (a + by(b, i)) % _LOW).otherwise(a).cast("long").alias("a"),
            F.when(even, b).otherwise((b + by(a, i)) % _HIGH).cast("long").alias("b"),
        )

    begin = F.struct((index % _LOW).cast("long").alias("a"), F.floor(index / _LOW).cast("long").alias("b"))
    moved = F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), begin, step, lambda s: (s["b"] * _LOW + s["a"]).cast("int")
    )
    return F.date_add(F.to_date(F.lit(_DAY_ZERO)), moved)


def _day(value: Column, y: int, m: int, d: int) -> Column:
    """The calendar day that fields y, m, d of a date name; null if none."""
    parts = F.split(value, "[./-]")
    text = F.concat_ws("-", parts[y], F.lpad(parts[m], 2, "0"), F.lpad(parts[d], 2, "0"))
    found = F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")
    return F.when(F.year(found).between(1800, 2199), found)


def _date(value: Column, day: Column, order: tuple[int, int, int], key: str) -> Column:
    """The moved day, with the separators and the widths of the value."""
    mark = F.regexp_extract(value, "[./-]", 0)
    padded = F.length(value) == 10
    names = ["yyyy", "MM", "dd"], ["yyyy", "M", "d"]

    def written(pattern: list[str], moved: Column) -> Column:
        fields = [p for _, p in sorted(zip(order, pattern))]
        return F.concat_ws(",", *(F.date_format(moved, p) for p in fields))

    moved = _let(
        _moved_day(day, key),
        lambda moved: F.replace(F.when(padded, written(names[0], moved)).otherwise(written(names[1], moved)), F.lit(","), mark),
    )
    return F.when(day.isNotNull(), moved)


def _whole(name: str) -> str:
    return f"^(?:{_PATTERNS[name]})$"


def pseudonym(value: Column, key: str) -> Column:
    """The replacement of a match, or the match itself if it is not valid."""
    plain = _plain(value)
    octets = F.split(value, r"\.")
    head = F.regexp_extract(value, r"^[A-Za-z_-]+(?:\s*[=:]\s*|\s+is:?\s+)[\"']?", 0)
    key_head = F.regexp_extract(value, f"^{_KEY_HEAD}", 0)
    at = F.instr(value, "@")
    iso, dot = _day(value, 0, 1, 2), _day(value, 2, 1, 0)
    month_first, day_first = _day(value, 2, 0, 1), _day(value, 2, 1, 0)

    def is_a(name: str) -> Column:
        return value.rlike(_whole(name))

    return (
        F.when(is_a("credential"), F.concat(head, _in_place(F.substr(value, F.length(head) + 1), key)))
        .when(is_a("key"), F.concat(key_head, _in_place(F.substr(value, F.length(key_head) + 1), key)))
        .when(is_a("email"), F.concat(_either_case(F.substr(value, F.lit(1), at - 1), key), F.substr(value, at)))
        .when(is_a("iban") & (mod97(plain) == 1), _iban(value, key))
        .when(is_a("ip"), F.when(F.forall(octets, lambda o: o.cast("int") < 256), _ip(value, key)).otherwise(value))
        .when(is_a("ipv6"), _ipv6(value, key))
        .when(is_a("iso_date"), F.coalesce(_date(value, iso, (0, 1, 2), key), value))
        .when(is_a("dot_date"), F.coalesce(_date(value, dot, (2, 1, 0), key), value))
        .when(
            is_a("slash_date"),
            F.coalesce(_date(value, month_first, (2, 0, 1), key), _date(value, day_first, (2, 1, 0), key), value),
        )
        .when(
            is_a("ssn"),
            F.when(value.rlike("^(?!000|666|9)...-(?!00)..-(?!0000)"), _in_place(value, key)).otherwise(value),
        )
        .when(is_a("nanp"), _nanp(value, key))
        .when(is_a("phone") & F.length(plain).between(8, 17), _phone(value, key))
        .when(is_a("national") & F.length(plain).between(9, 12), _national(value, key))
        .when(is_a("card") & (F.pmod(luhn(plain), F.lit(10)) == 0), _card(value, key))
        .otherwise(value)
    )


def _up_to_separators(match: Column) -> Column:
    """The beginnings of a match that end where a separator follows, and the match."""
    groups = F.split(match, "[ -]")
    return F.transform(
        F.sequence(F.lit(1), F.size(groups)),
        lambda k: F.substr(match, F.lit(1), F.length(F.array_join(F.slice(groups, 1, k), " "))),
    )


def _one_of(values: Column, before: str, after: str) -> Column:
    """A pattern for any of the values, or for nothing. They hold no character that
    means something in a pattern."""
    longest = F.array_sort(F.array_distinct(values), lambda a, b: F.length(b) - F.length(a))
    return F.when(F.size(values) > 0, F.concat(F.lit(f"{before}(?:"), F.array_join(longest, "|"), F.lit(f"){after}"))).otherwise(
        F.lit("(?!)")
    )


def _pattern(text: Column) -> Column:
    """What is to be replaced in a text, valid IBANs and cards by their own digits."""
    runs = F.regexp_extract_all(text, F.lit(_PATTERNS["card"]), F.lit(0))
    # A run cut short is a card only if its groups are no short numbers in a row.
    cut = F.filter(
        F.flatten(F.transform(runs, _up_to_separators)), lambda c: c.rlike("^[0-9]{4,}(?:[ -][0-9]{4,})*(?:[ -][0-9]{1,3})?$")
    )
    cards = F.concat(runs, cut, F.regexp_extract_all(text, F.lit(_CARD_FORM), F.lit(1)))
    cards = F.filter(cards, lambda c: F.length(_plain(c)).between(13, 19) & (F.pmod(luhn(_plain(c)), F.lit(10)) == 0))
    ibans = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_IBAN_FORM), F.lit(1)), _up_to_separators))
    ibans = F.filter(ibans, lambda i: i.rlike(_whole("iban")) & (mod97(_plain(i)) == 1))
    names = list(_PATTERNS)
    first, others = names[: names.index("iban")], names[names.index("iban") + 1 : names.index("card")]
    return F.concat_ws(
        "|",
        F.lit(_several(first)),
        _one_of(ibans, "(?<![A-Za-z0-9])", "(?![A-Za-z0-9])"),
        F.lit(_several(others)),
        _one_of(cards, "(?<![0-9A-Za-z.])", "(?![0-9])"),
    )


def pseudonymised(text: Column, key: str) -> Column:
    """struct(text, n_values) of a text column."""
    plain = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n_values"))
    return F.when(text.rlike("[0-9@=:]"), _let(_pattern(text), lambda pattern: _replaced(text, pattern, key))).otherwise(plain)


def _replaced(text: Column, pattern: Column, key: str) -> Column:
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    replaced = F.transform(found, lambda value: pseudonym(value, key))

    def joined(new: Column) -> Column:
        pieces = F.transform(parts, lambda part, i: F.concat(part, F.coalesce(F.get(new, i), F.lit(""))))
        changed = F.filter(F.zip_with(new, found, lambda a, b: a != b), lambda x: x)
        return F.struct(F.array_join(pieces, "").alias("text"), F.size(changed).cast("long").alias("n_values"))

    return _let(replaced, joined)


@cache
def _drawn(application: str) -> str:
    warnings.warn(f"{KEY_SETTING} is not set: pseudonyms are not linked with those of other sessions")
    return secrets.token_hex(32)


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting, else one drawn for the session."""
    return spark.conf.get(KEY_SETTING, None) or _drawn(spark.sparkContext.applicationId)


def pseudonymise(docs: DataFrame, *, key: str | None = None) -> DataFrame:
    """The documents with their texts rewritten; all columns are kept. Without a key, the
    session's."""
    return docs.withColumn("text", pseudonymised(F.col("text"), key or session_key(docs.sparkSession))["text"])


def report(docs: DataFrame, *, key: str | None = None) -> DataFrame:
    """doc_id, text, n_values of every row."""
    new = pseudonymised(F.col("text"), key or session_key(docs.sparkSession))
    return docs.select("doc_id", new.alias("new")).select("doc_id", "new.text", "new.n_values")
