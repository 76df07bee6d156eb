"""Cleaning of codes, labels, numbers, flags and dates, as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that count as no value, and the words for yes.
SENTINELS = ("Unknown", "UNKNOWN", "-", "NaN", "nan")
YES = ("1", "true", "ja", "j", "yes", "y")
#: Date formats in the order in which they are tried: the day comes first unless the year leads.
DATE_FORMATS = ("d-M-yyyy", "d/M/yyyy", "d.M.yyyy", "yyyy-M-d", "d-M-yy", "d/M/yy", "d-M-yyyy H:m:s", "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used: as an array's only item, handed to a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_of(value: Column) -> Column:
    """Text of a number as it is written in keys: 12.0 as 12."""
    return F.regexp_replace(value.cast("string"), r"^(-?[0-9]+)\.0$", "$1")


def known(value: Column) -> Column:
    """The value, or null where it is empty or stands for no value."""
    text = value.cast("string")
    return F.when(~text.isin("", *SENTINELS), value)


def first_known(*values: Column) -> Column:
    """The first value that is no null, empty text, zero or NaN; null if there is none."""
    filled = [F.when(~v.cast("string").isin("", "0", "0.0", "NaN", "nan", "false"), v) for v in values]
    return F.coalesce(*filled)


def padded(digits: Column, width: int = 3) -> Column:
    """Digits with zeros before them; longer ones are never cut."""
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def project_code(value: Column) -> Column:
    """``dc-27`` as DC027: letters, then digits as a number of three places or more; what follows is dropped. Anything else stays."""
    pattern = r"^([a-zA-Z]+)-?([0-9]*)"
    letters = F.upper(F.regexp_extract(value, pattern, 1))
    digits = F.regexp_extract(value, pattern, 2)
    number = F.when(digits == "", F.lit("")).otherwise(padded(F.regexp_replace(digits, "^0+(?=[0-9])", "")))
    return F.when(value.rlike("^[a-zA-Z]"), F.concat(letters, number)).otherwise(value)


def title_case(value: Column) -> Column:
    """Each run of letters in small letters but for its first one, as ``Bar-Baz``."""
    pieces = F.split(F.regexp_replace(F.lower(value), r"(?<!\p{L})(?=\p{L})", "\u0001"), "\u0001", -1)
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), "")


def clean_label(value: Column) -> Column:
    return title_case(F.trim(F.replace(value, F.lit("?"), F.lit(""))))


def drawing_code(value: Column) -> Column:
    """``c!12`` as c012: one letter and digits of three places; marks ?, ! and - are dropped, anything else stays."""
    bare = F.translate(value, "?!-", "")
    pattern = r"^([a-zA-Z])([0-9]+)$"
    return F.when(bare.rlike(pattern), F.concat(F.regexp_extract(bare, pattern, 1), padded(F.regexp_replace(F.regexp_extract(bare, pattern, 2), "^0+(?=[0-9])", "")))).otherwise(bare)


def report_number(value: Column, prefix: Column | None = None) -> Column:
    """``dar 7`` as dar007; digits alone get ``prefix`` (empty if null)."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    number = lambda d: padded(F.regexp_replace(d, "^0+(?=[0-9])", ""))
    own = F.coalesce(prefix, F.lit("")) if prefix is not None else F.lit("")
    pattern = r"^([a-zA-Z]+)([0-9]+)"
    lettered = F.concat(F.regexp_extract(bare, pattern, 1), number(F.regexp_extract(bare, pattern, 2)))
    return F.when(bare.rlike("^[0-9]+$"), F.concat(own, number(bare))).when(bare.rlike(pattern), lettered).otherwise(bare)


def report_prefix(source: Column) -> Column:
    """DAR or DAN by the source column that the number came from; null if neither is there. ``source`` is a map."""
    return F.when(F.map_contains_key(source, F.lit("DAR")), "DAR").when(F.map_contains_key(source, F.lit("DAN")), "DAN")


def table_type(table: Column) -> Column:
    """The artefact type that a source table's name tells: nails have tables of their own."""
    return F.when(F.lower(table).contains("spijker"), "Spijker")


def artefact_kind(type_code: Column) -> Column:
    """The kind of artefact that a type code tells; the rule named last wins."""
    return (
        F.when(F.lower(type_code).rlike("^gl[_-]"), "Glas")
        .when(type_code.rlike("^[a-zA-Z]{1,2}[_-]"), "Aardewerk")
        .when(F.lower(type_code).contains("kleipijp"), "Kleipijp")
    )


def to_int(value: Column, keep: bool = False) -> Column:
    """A whole number, cut towards zero; what is no number is null or, if ``keep``, stays as text."""
    number = value.cast("string").try_cast("double")
    whole = F.when(~F.isnan(number) & (F.abs(number) < 9e18), number.cast("bigint"))
    return F.coalesce(whole.cast("string"), value.cast("string")) if keep else whole


def to_flag(value: Column) -> Column:
    """1 for a word that means yes, 0 for any other, null for none."""
    return F.when(value.isNotNull(), F.lower(value.cast("string")).isin(*YES).cast("int"))


def to_date(value: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """A date, day before month; what is no date is null."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(value), F.lit(f)).cast("date") for f in formats])


def rewritten(value: Column, rules: list[tuple[str, str]]) -> Column:
    """The value after all rules (pattern, replacement of the whole) in order: of those that fit, the last one counts."""
    return reduce(lambda v, rule: F.when(v.rlike(rule[0]), F.lit(rule[1])).otherwise(v), rules, value)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, rounded half to even; null if there is no whole."""
    return F.bround(100.0 * part / F.nullif(whole, F.lit(0)), 0)


def range_label(start: Column, end: Column) -> Column:
    """``a - b``, ``a -``, ``- b`` or nothing; zero counts as unknown."""
    a, b = F.nullif(start, F.lit(0)).cast("string"), F.nullif(end, F.lit(0)).cast("string")
    return F.when(a.isNotNull() & b.isNotNull(), F.concat(a, F.lit(" - "), b)).when(a.isNotNull(), F.concat(a, F.lit(" -"))).when(b.isNotNull(), F.concat(F.lit("- "), b)).otherwise("")


def short_name(column_name: Column) -> Column:
    """A suggested column name: ``...nummer`` becomes ``...nr``."""
    return F.regexp_replace(F.lower(F.replace(column_name, F.lit(" "), F.lit("_"))), "nummer$", "nr")


def by_first_match(value: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The name of the first rule (pattern, name) that fits the value's beginning."""
    found = [F.when(value.rlike(f"^(?:{pattern})"), F.lit(name)) for pattern, name in rules]
    return F.coalesce(*found, F.lit(default))


def described(kind: str, **parts: Column) -> Column:
    """A line of text for a row: the kind and its known parts, as ``Spoor 5, vlak 2``."""
    told = [F.when(known(text_of(v)).isNotNull(), F.concat(F.lit(f"{name} " if name else ""), text_of(v))) for name, v in parts.items()]
    return F.concat_ws(" ", F.lit(kind[:1].upper() + kind[1:]), F.nullif(F.concat_ws(", ", *told), F.lit("")))
