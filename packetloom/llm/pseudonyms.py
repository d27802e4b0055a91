"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations in column expressions.

Numbers and dates that pass their validation are permuted within their own format: a card number becomes a card number
with a right check digit, an address an address, a date a date. The permutation depends on the key and the kind of value
only, so equal values stay linked across documents, and whoever has the key can reverse it. Mail addresses become keyed
digests, equal for equal addresses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import spare

ROUNDS = 8

#: Patterns of each kind, tried in this order at each place. Digits or letters never touch a match.
_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){0,125}\.\p{L}{2,}+" + _AFTER,
    "date": _BEFORE + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})" + _AFTER,
    "ip": _BEFORE + r"(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}" + _AFTER + r"(?!\.[0-9])",
    "ssn": _BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _AFTER,
    "phone": r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})"
    + _AFTER
    + r"|(?<![\p{L}\p{N}+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}"
    + _AFTER,
    "card": _BEFORE
    + r"(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{4} [0-9]{6} [0-9]{5})"
    + _AFTER,
    "iban": _BEFORE + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _AFTER,
}
KINDS = tuple(PATTERNS)
ANY = "|".join(PATTERNS.values())

#: Days between 1600-01-01 and 1970, and days of a calendar cycle, which is 339 times 431.
CYCLE_START, CYCLE_DAYS, CYCLE_LEFT, CYCLE_RIGHT = 135_140, 146_097, 339, 431


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bind(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` computed once under ``name``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def keyed_number(key: str, kind: str, step: str, value: str) -> str:
    """A pseudo-random long from the key, the kind, the round and a value."""
    inner = f"sha2(concat_ws('|', {_text(key)}, '{kind}', cast({step} AS string), cast({value} AS string)), 256)"
    return f"cast(conv(substr(sha2(concat({_text(key)}, '#', {inner}), 256), 1, 15), 16, 10) AS bigint)"


def feistel(left: str, right: str, left_size: str, right_size: str, key: str, kind: str, restore: bool) -> str:
    """A struct l, r: the permutation of the pair (left, right) below (left_size, right_size), or its inverse."""
    sign = "-" if restore else "+"
    order = f"sequence({ROUNDS - 1}, 0, -1)" if restore else f"sequence(0, {ROUNDS - 1})"
    new_left = f"pmod(s.l {sign} {keyed_number(key, kind, 'i', 's.r')} % {left_size}, {left_size})"
    new_right = f"pmod(s.r {sign} {keyed_number(key, kind, 'i', 's.l')} % {right_size}, {right_size})"
    return (
        f"aggregate({order}, named_struct('l', cast({left} AS bigint), 'r', cast({right} AS bigint)), (s, i) -> "
        f"if(i % 2 = 0, named_struct('l', {new_left}, 'r', s.r), named_struct('l', s.l, 'r', {new_right})))"
    )


def permuted_digits(digits: str, key: str, kind: str, restore: bool) -> str:
    """A string of as many digits, at least two."""
    size = f"length({digits})"
    half = f"({size} div 2)"
    left, right = f"left({digits}, {half})", f"right({digits}, {size} - {half})"
    parts = feistel(left, right, f"cast(pow(10, {half}) AS bigint)", f"cast(pow(10, {size} - {half}) AS bigint)", key, kind, restore)
    return bind(
        parts, "f", f"concat(lpad(cast(f.l AS string), {half}, '0'), lpad(cast(f.r AS string), {size} - {half}, '0'))"
    )


def digits_of(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def laid_out(value: str, digits: str) -> str:
    """``value`` with its digits replaced, in order, by those of ``digits``."""
    return (
        f"concat_ws('', transform(sequence(1, length({value})), p -> if(substr({value}, p, 1) BETWEEN '0' AND '9', "
        f"substr({digits}, length({digits_of(f'left({value}, p)')}), 1), substr({value}, p, 1))))"
    )


def luhn_sum(digits: str, shift: int) -> str:
    """Sum of digits, doubled where the distance from the end plus ``shift`` is odd, with the digits of the doubles added up."""
    digit = f"cast(substr({digits}, q, 1) AS int)"
    doubled = f"(length({digits}) - q + {shift}) % 2 = 1"
    return (
        f"aggregate(sequence(1, length({digits})), 0, (t, q) -> t + if({doubled}, {digit} * 2 - if({digit} > 4, 9, 0), {digit}))"
    )


def card(value: str, key: str, restore: bool) -> str:
    """First digit and layout stay, the last digit is computed anew."""
    middle = permuted_digits("substr(d, 2, length(d) - 2)", key, "card", restore)
    body = bind(f"concat(left(d, 1), {middle})", "b", f"concat(b, cast(pmod(-{luhn_sum('b', 1)}, 10) AS string))")
    checked = f"if({luhn_sum('d', 0)} % 10 = 0, {bind(body, 'n', laid_out(value, 'n'))}, {value})"
    return bind(digits_of(value), "d", checked)


def phone(value: str, key: str, restore: bool) -> str:
    """The last ten digits are permuted (all, where there are fewer); a country code before them stays."""
    national = "right(d, 10)"
    renewed = f"concat(left(d, greatest(0, length(d) - 10)), {permuted_digits(national, key, 'phone', restore)})"
    return bind(digits_of(value), "d", f"if(length(d) >= 7, {bind(renewed, 'n', laid_out(value, 'n'))}, {value})")


def ssn(value: str, key: str, restore: bool) -> str:
    """Numbers that can be given out: area 1 to 899 but 666, group and serial not zero; the same goes for the pseudonym."""
    area, group, serial = (f"cast(substr(d, {at}, {n}) AS int)" for at, n in ((1, 3), (4, 2), (6, 4)))
    valid = f"{area} BETWEEN 1 AND 899 AND {area} != 666 AND {group} > 0 AND {serial} > 0"
    left = f"({area} - if({area} > 666, 2, 1)) * 99 + {group} - 1"
    parts = feistel(left, f"{serial} - 1", str(898 * 99), "9999", key, "ssn", restore)
    renewed_area = "f.l div 99 + if(f.l div 99 >= 665, 2, 1)"
    padded = ", ".join(f"lpad(cast({x} AS string), {n}, '0')" for x, n in ((renewed_area, 3), ("f.l % 99 + 1", 2), ("f.r + 1", 4)))
    renewed = bind(bind(parts, "f", f"concat({padded})"), "n", laid_out(value, "n"))
    return bind(digits_of(value), "d", f"if({valid}, {renewed}, {value})")


def ip(value: str, key: str, restore: bool) -> str:
    octet = [f"cast(o[{k}] AS bigint)" for k in range(4)]
    parts = feistel(f"{octet[0]} * 256 + {octet[1]}", f"{octet[2]} * 256 + {octet[3]}", "65536", "65536", key, "ip", restore)
    renewed = bind(parts, "f", "concat_ws('.', f.l div 256, f.l % 256, f.r div 256, f.r % 256)")
    wrong = "exists(o, x -> cast(x AS int) > 255 OR (x LIKE '0%' AND x != '0'))"
    return bind(f"split({value}, '[.]')", "o", f"if({wrong}, {value}, {renewed})")


def date(value: str, key: str, restore: bool) -> str:
    """ISO dates, day.month.year, and month/day/year from 1600 on, permuted within their calendar cycle of 400 years.

    Dates whose day or month is written with one digit are permuted among those that can be written so: the layout
    stays, and the inverse finds the text again.
    """
    fields = bind(
        f"split({value}, '[-/.]')",
        "o",
        f"CASE WHEN {value} LIKE '%-%' THEN named_struct('y', o[0], 'm', o[1], 'd', o[2])"
        f" WHEN {value} LIKE '%/%' THEN named_struct('y', o[2], 'm', o[0], 'd', o[1])"
        " ELSE named_struct('y', o[2], 'm', o[1], 'd', o[0]) END",
    )
    padded = "concat_ws('-', p.y, lpad(p.m, 2, '0'), lpad(p.d, 2, '0'))"
    day = f"cast(try_to_timestamp({padded}, 'yyyy-MM-dd') AS date)"

    index = f"pmod(unix_date(t) + {CYCLE_START}, {CYCLE_DAYS})"
    moved = feistel(f"{index} div {CYCLE_RIGHT}", f"{index} % {CYCLE_RIGHT}", str(CYCLE_LEFT), str(CYCLE_RIGHT), key, "date", restore)
    any_day = bind(moved, "f", f"date_from_unix_date(cast(unix_date(t) - {index} + f.l * {CYCLE_RIGHT} + f.r AS int))")

    year = "pmod(year(t), 400)"
    base = f"year(t) - {year}"

    def within(kind: str, size: int, number: str, month: str, of_month: str) -> str:
        """A day of the year out of ``size``, and the year, of the cycle."""
        parts = feistel(number, year, str(size), "400", key, kind, restore)
        return bind(parts, "f", f"make_date(cast({base} + f.r AS int), cast({month} AS int), cast({of_month} AS int))")

    short_day = "(month(t) - 1) * 9 + day(t) - 1"
    single = within("date-1-1", 81, short_day, "f.l div 9 + 1", "f.l % 9 + 1")
    single_day = within("date-2-1", 108, short_day, "f.l div 9 + 1", "f.l % 9 + 1")
    common = "date_add(DATE'2001-01-01', cast(f.l AS int))"
    single_month = within(
        "date-1-2", 273, "datediff(make_date(2001, month(t), day(t)), DATE'2001-01-01')", f"month({common})", f"day({common})"
    )
    # the 29th of February stays one, in another of the 97 leap years of a cycle
    leap = f"({year} div 4 - {year} div 100)"
    turned = f"pmod({leap} {'-' if restore else '+'} {keyed_number(key, 'date-leap', '0', '0')}, 97)"
    leap_day = bind(turned, "i", f"make_date(cast({base} + 4 * (i + greatest(i - 1, 0) div 24) AS int), 2, 29)")
    renewed = (
        f"CASE WHEN length(p.m) = 2 AND length(p.d) = 2 THEN {any_day} WHEN length(p.m) = 2 THEN {single_day}"
        f" WHEN length(p.d) = 1 THEN {single} WHEN month(t) = 2 AND day(t) = 29 THEN {leap_day} ELSE {single_month} END"
    )
    y, m, d = (f"lpad(cast({part}(r) AS string), {size}, '0')" for part, size in (("year", 4), ("month", "length(p.m)"), ("day", "length(p.d)")))
    written = (
        f"CASE WHEN {value} LIKE '%-%' THEN concat_ws('-', {y}, {m}, {d}) WHEN {value} LIKE '%/%' THEN concat_ws('/', {m}, {d}, {y})"
        f" ELSE concat_ws('.', {d}, {m}, {y}) END"
    )
    body = bind(day, "t", f"if(t IS NULL OR year(t) < 1600, {value}, {bind(renewed, 'r', written)})")
    return bind(fields, "p", body)


def iban(value: str, key: str, restore: bool) -> str:
    """Digits after the check digits are permuted, letters stay, the check digits are computed anew."""

    def remainder(chars: str) -> str:
        char = f"substr({chars}, q, 1)"
        step = f"if({char} BETWEEN '0' AND '9', t * 10 + cast({char} AS int), t * 100 + ascii({char}) - 55) % 97"
        return f"aggregate(sequence(1, length({chars})), 0, (t, q) -> cast({step} AS int))"

    valid = bind("concat(a, left(c, 4))", "w", f"{remainder('w')} = 1")
    permuted = bind(digits_of("a"), "d", f"if(length(d) >= 2, {permuted_digits('d', key, 'iban', restore)}, d)")
    account = bind(permuted, "n", laid_out("a", "n"))
    check = bind("concat(g, left(c, 2), '00')", "w", f"lpad(cast(98 - {remainder('w')} AS string), 2, '0')")
    renewed = bind(account, "g", f"concat(left(c, 2), {check}, g)")
    spaced = (
        f"concat_ws('', transform(sequence(1, length({value})), p -> if(substr({value}, p, 1) = ' ', ' ', "
        f"substr(h, length(replace(left({value}, p), ' ', '')), 1))))"
    )
    body = bind("substr(c, 5)", "a", f"if({valid}, {bind(renewed, 'h', spaced)}, {value})")
    return bind(f"replace({value}, ' ', '')", "c", body)


def email(value: str, key: str) -> str:
    digest = f"sha2(concat({_text(key)}, '#', sha2(concat({_text(key)}, '|email|', lower({value})), 256)), 256)"
    return f"concat('u', left({digest}, 20), '@pseudonym.invalid')"


def pseudonym(value: str, key: str, restore: bool = False) -> str:
    """SQL text: the pseudonym of a match named ``value``; a match that fails its validation is returned as it is."""
    cases = {
        "email": value if restore else email(value, key),
        "date": date(value, key, restore),
        "ip": ip(value, key, restore),
        "ssn": ssn(value, key, restore),
        "phone": phone(value, key, restore),
        "card": card(value, key, restore),
        "iban": iban(value, key, restore),
    }
    branches = " ".join(f"WHEN {_is(value, kind)} THEN {body}" for kind, body in cases.items())
    return f"CASE {branches} ELSE {value} END"


def _is(value: str, kind: str) -> str:
    return f"{value} RLIKE {_text('^(?:' + PATTERNS[kind] + ')$')}"


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", restore: bool = False) -> DataFrame:
    """``docs`` with the text pseudonymised, and private_<kind> counts and n_private of what was replaced.

    ``restore`` reverses numbers and dates under the same key, to the very text; mail digests stay. Texts without personal
    data come back unchanged, a null text stays null with counts of 0. Values that match a pattern but fail their
    validation (check digit, octets without leading zeros, calendar from 1600 on, numbers that are given out) are no
    personal data and stay. Host names have at most 127 parts; texts and words of any length are read in linear time. Works row by row without a shuffle, so repeated rows, null
    ids and empty tables need no care; columns named like the counts are replaced.
    """
    text, matches, renewed = F.col(text_col), spare(docs, "matches"), spare(docs, "renewed")
    holds = F.coalesce(text.rlike(ANY), F.lit(False))
    found = F.when(holds, F.regexp_extract_all(text, F.lit(ANY), 0)).otherwise(F.array().cast("array<string>"))
    rows = docs.withColumn(matches, found)
    rows = rows.withColumn(renewed, F.expr(f"transform(`{matches}`, m -> {pseudonym('m', key, restore)})"))
    pieces = F.split(text, ANY, -1)
    joined = F.concat_ws("", F.flatten(F.zip_with(pieces, F.col(renewed), lambda p, n: F.array(p, F.coalesce(n, F.lit(""))))))
    both = f"zip_with(`{matches}`, `{renewed}`, (a, b) -> named_struct('a', a, 'b', b))"
    counts = {f"private_{k}": F.expr(f"size(filter({both}, z -> z.a != z.b AND {_is('z.a', k)}))") for k in KINDS}
    rows = rows.withColumns({text_col: F.when(F.size(matches) > 0, joined).otherwise(text)} | counts)
    return rows.withColumn("n_private", sum((F.col(c) for c in counts), F.lit(0))).drop(matches, renewed)
