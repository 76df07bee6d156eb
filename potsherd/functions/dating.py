"""Dates as people write them, as ranges of years: negative years are before Christ.

Codes of digits, Roman numerals and quarters (``17ab``, ``XVIIb``, ``1650-1700``) are read by column expressions. Only what
they can't read goes on to the phrase parser, in an Arrow-batched UDF.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.functions.values import bind

RANGE = "struct<vanaf:int,tot:int>"

# Dutch ordinals, words around dates, and the main periods (name: first year, last year).
ORDINALS = {
    "eerste": 1, "tweede": 2, "derde": 3, "vierde": 4, "vijfde": 5, "zesde": 6, "zevende": 7, "achtste": 8, "negende": 9, "tiende": 10, "elfde": 11,
    "twaalfde": 12, "dertiende": 13, "veertiende": 14, "vijftiende": 15, "zestiende": 16, "zeventiende": 17, "achtiende": 18, "negentiende": 19, "twintigste": 20, "vorige": 20,
}
NOISE = ("tussen ", "vanaf ", "na ", "circa ", "ongeveer ", "van het ", " ? ")
BEFORE_CHRIST = ("v. chr", "voor chr", " bc", "v.chr.", "v. chr.", "voor christus", "v chr")
CONNECTIVES = (" en/of ", " en / of ", " of in de ", " of ", " t/m ", " t / m ", " tot en met ", " tot in de ", " tot op ", " tot ", " en ", " naar het ", " / ", " - ", " -", "- ", " – ", "– ", " –", " — ", "— ", " —")
PERIODS = {
    "prehistorie": (-1000000, -13), "steentijd": (-1000000, -2001), "paleolithicum": (-998050, -8799), "mesolithicum": (-8800, -5301), "neolithicum": (-5300, -2001),
    "bronstijd": (-2000, -801), "ijzertijd": (-800, -13), "romeinse tijd": (-12, 449), "romeins": (-12, 449), "middeleeuwen": (450, 1500), "vroege middeleeuwen": (450, 1049),
    "late middeleeuwen": (1050, 1499), "nieuwe tijd": (1500, 1944), "moderne tijd": (1750, 1945),
}
#: A value with such a part is no code, whatever numbers it has.
ERA = r"(?i)v\.? ?chr|voor chr|\b(bc|bp)\b|±|\+ ?/ ?-|jaar geleden"
MARGIN = re.compile(r"([0-9][0-9 .,]*?) *(?:±|\+ ?/? ?-) *([0-9]+)")
#: Parts of a century: the words, years off its begin and years off its end.
PARTS = (
    (("eerste helft", "1e helft"), 0, 50),
    (("laatste helft", "tweede helft", "2e helft"), 50, 0),
    (("eerste kwart", "1e kwart", "1ste kwart", "begin van", "begin", "vroege"), 0, 75),
    (("tweede kwart", "2e kwart"), 25, 50),
    (("derde kwart", "3e kwart"), 50, 25),
    (("laatste kwart", "einde van", "eind", "late"), 75, 0),
    (("midden van",), 25, 25),
)
#: Numerals that are written as a difference, and as a sum.
SUMS = (("CM", "DCCCC"), ("CD", "CCCC"), ("XC", "LXXXX"), ("XL", "XXXX"), ("IX", "VIIII"), ("IV", "IIII"))
WEIGHTS = {"M": 1000, "D": 500, "C": 100, "L": 50, "X": 10, "V": 5, "I": 1}
ROMAN = "M{0,4}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})"


def spelled_out(numeral: Column) -> Column:
    """A Roman numeral as a mere sum."""
    for written, total in SUMS:
        numeral = F.replace(numeral, F.lit(written), F.lit(total))
    return numeral


def roman(numeral: Column) -> Column:
    """Value of a Roman numeral in capitals; null if it is none."""

    def value(plain: Column) -> Column:
        out = F.lit(0)
        for letter, weight in WEIGHTS.items():
            out = out + weight * (F.length(plain) - F.length(F.replace(plain, F.lit(letter), F.lit(""))))
        return out

    return F.when(numeral.rlike(f"^(?=.){ROMAN}$"), bind(spelled_out(numeral), value))


def tokens(value: Column) -> Column:
    """The parts of a date code; a sign that follows another is a minus."""
    v = F.translate(F.replace(value.cast("string"), F.lit("?"), F.lit("")), "-/+=", ",,,,")
    v = F.translate(F.replace(v, F.lit(",,"), F.lit(",-")), "()", "")
    v = F.regexp_replace(F.regexp_replace(v, "^,", "-"), ",$", "")
    return F.split(v, ",")


def quarters(base: Column, letters: Column) -> Column:
    first, last = F.ascii(F.substring(letters, 1, 1)) - 97, F.ascii(F.substring(letters, -1, 1)) - 96
    return F.when(base.isNotNull(), F.array(base + 25 * first, base + 25 * last))


def read_codes(value: Column, strict_reference: bool = False) -> Column:
    """struct<years array<int>, rest array<string>>: the years that the codes in a value tell, and the parts that are no codes.

    A lone letter from a to d is a quarter of the first century or year before it; a value that names its era is a phrase as
    a whole. ``strict_reference`` knows no such values, reads a lone capital as a Roman numeral, and any part with "rt" in it
    as Roman times.
    """
    none = F.array().cast("array<int>")
    lone_letter = "^[a-d]$" if strict_reference else "^[a-dA-D]$"

    # each step sees what the one before it found, so that nothing is matched twice
    def texts(token: Column) -> Column:
        return F.struct(token.alias("token"), F.lower(token).alias("low"), F.replace(token, F.lit(" "), F.lit("")).alias("bare"))

    def matched(t: Column) -> Column:
        # capitals are a numeral as long as they make one; a quarter follows in either case
        return F.struct(
            t.token.alias("token"),
            t.low.alias("low"),
            F.regexp_extract(t.bare, "^([0-9]{3,4})", 1).try_cast("int").alias("year"),
            (F.regexp_extract(t.bare, r"(?i)^([0-9]{1,2})[a-d]+$", 1).try_cast("int") * 100).alias("century"),
            F.lower(F.regexp_extract(t.bare, r"([a-dA-D]+)$", 1)).alias("quarter"),
            F.when(t.bare.rlike(lone_letter), F.lower(t.bare)).alias("letter"),
            (roman(F.regexp_extract(t.bare, rf"^({ROMAN})[a-dA-D]*$", 1)) * 100).alias("roman"),
            F.lower(F.regexp_extract(t.bare, rf"^{ROMAN}([a-dA-D]*)$", 1)).alias("after"),
        )

    def read(t: Column) -> Column:
        rome = t.low.contains("rt") if strict_reference else t.low.rlike(r"\b[vml]?rt\b")
        found = (
            F.when(t.low.contains("lmeb"), F.array(F.lit(1200), F.lit(1500)))
            .when(rome | t.low.contains("romeins") | (t.low == "r"), F.array(F.lit(-1200), F.lit(450)))
            .when(t.low.contains("xiv c"), F.array(F.lit(1450), F.lit(1475)))
            .when(t.year.isNotNull(), F.array(t.year))
            .when(t.century.isNotNull(), quarters(t.century, t.quarter))
            .when(t.letter.isNotNull(), none)
            .when(t.roman.isNotNull(), F.when(t.after == "", F.array(t.roman)).otherwise(quarters(t.roman, t.after)))
        )
        base = F.coalesce(t.year, t.century, F.when(t.letter.isNull(), t.roman))
        return F.struct(t.token.alias("token"), found.cast("array<int>").alias("years"), base.cast("int").alias("base"), t.letter.alias("letter"))

    every = F.transform(F.transform(F.transform(tokens(value), texts), matched), read)
    codes = bind(every, lambda parts: resolved(parts, none))
    if strict_reference:
        return codes
    return F.when(value.rlike(ERA), F.struct(none.alias("years"), F.array(value.cast("string")).alias("rest"))).otherwise(codes)


def resolved(parts: Column, none: Column) -> Column:
    """The years of all parts, a lone letter by the first century or year before it, and the parts that tell none."""
    first = lambda k: F.get(F.filter(F.transform(F.slice(parts, 1, k), lambda p: p.base), lambda b: b.isNotNull()), F.lit(0))

    def years(p: Column, k: Column) -> Column:
        return F.when(p.letter.isNull(), F.coalesce(p.years, none)).otherwise(F.coalesce(quarters(first(k), p.letter), none))

    rest = F.transform(F.filter(parts, lambda p: p.years.isNull() & (F.trim(p.token) != "")), lambda p: p.token)
    return F.struct(F.flatten(F.transform(parts, years)).alias("years"), rest.alias("rest"))


def ranged(df: DataFrame, column: str, vanaf: str = "vanaf", tot: str = "tot", strict_reference: bool = False) -> DataFrame:
    """``df`` with the years of the codes in a column. Datings repeat, so each different one is read once."""
    # no filter on what is read: it would move below the distinct, and every row be read
    known = df.select(F.col(column).alias("_code")).distinct().withColumn("_span", code_range(F.col("_code"), strict_reference))
    return df.join(known, F.col(column) == F.col("_code"), "left").withColumns({vanaf: F.col("_span.vanaf"), tot: F.col("_span.tot")}).drop("_code", "_span")


def code_range(value: Column, strict_reference: bool = False) -> Column:
    """struct<vanaf, tot> of the codes in a value; null if it has none. No UDF."""
    return bind(read_codes(value, strict_reference)["years"], lambda y: F.when(F.size(y) > 0, F.struct(F.array_min(y).alias("vanaf"), F.array_max(y).alias("tot"))))


@dataclass
class Phrases:
    """Reads one phrase. ``periods`` maps names in small letters to (first, last) year; ``this_year`` is the latest that can be meant."""

    periods: dict[str, tuple[int, int]] = field(default_factory=lambda: dict(PERIODS))
    this_year: int = 2024
    strict_reference: bool = False

    def __post_init__(self) -> None:
        self.periods |= {name.replace(" ", ""): span for name, span in self.periods.items()}
        self.connective = re.compile("|".join(re.escape(c) for c in CONNECTIVES))

    def read(self, phrase: str) -> tuple[int, int] | None:
        low = phrase.lower()
        # the sign of a margin is no connective
        one = not self.strict_reference and MARGIN.search(low)
        parts = [low] if one else [p for p in self.connective.split(low) if p.strip()]
        if len(parts) < 2:
            span = self.one(low, self.era(low))
            return self.corrected(*span, several=False) if span else None
        era = self.era(parts[1])
        begin = self.one(parts[0], era) or self.one(f"{parts[0]} {re.split(r'[ –—-]', parts[1].strip())[-1]}", era)
        end = self.one(parts[1], era)
        if begin and end:
            return self.corrected(begin[0], end[1], several=True)
        span = begin or end or self.one(low, self.era(low))
        return self.corrected(*span, several=True) if span else None

    def years(self, phrase: str) -> list[int]:
        """First and last year. A plain number of at most 25 is a century; ``strict_reference`` takes any such year for one."""
        span = self.read(phrase)
        if not span:
            return []
        plain = self.strict_reference or re.fullmatch(r"[^0-9]*[0-9]{1,2}[^0-9]*", phrase) and "eeuw" not in phrase.lower() and "'" not in phrase
        return [y * 100 if plain and -25 <= y <= 25 else y for y in span]

    def era(self, text: str) -> str:
        if any(w in text for w in BEFORE_CHRIST):
            return "BC"
        if " bp" in text or re.search(r"\+ ?/ ?-|±|\+-", text):
            return "BP"
        return "YA" if "jaar geleden" in text else "AD"

    def one(self, text: str, era: str) -> tuple[int, int] | None:
        for word in NOISE:
            text = text.replace(word, "")
        if re.search(r"[ -]eeuw|millenn?ium|[0-9](ste|de|e)", text):
            return self.turned(self.century(text), "AD")
        if not re.search("[0-9]", text):
            return self.period(text)
        return self.turned(self.numbers(text), era)

    @staticmethod
    def turned(span: tuple[int, int] | None, era: str) -> tuple[int, int] | None:
        if not span or era == "AD":
            return span
        turn = {"BC": lambda y: -y, "BP": lambda y: 1950 - y, "YA": lambda y: 2000 - y}[era]
        return turn(span[0]), turn(span[1])

    def century(self, text: str) -> tuple[int, int] | None:
        text = re.sub(r"(\d)\s+(\d)\s+e", r"\1\2e", text)
        named = text
        if not self.strict_reference:  # the ordinal of a half or a quarter isn't that of the century
            named = re.sub(r"\b\w+ (helft|kwart)\b", "", text)
        found = re.search(r"\b([0-9]+)(ste|de|e)?\b", named)
        words = [w for w in re.split(r"[ –—-]", named) if w in ORDINALS]
        number = int(found.group(1)) if found else ORDINALS[words[0]] if words else None
        if not number:
            return None
        years = 1000 if re.search("millenn?ium", text) else 100
        begin, end = years * (number - 1), years * number - 1
        for names, off_begin, off_end in PARTS:
            if any(f"{n} " in text for n in names):
                begin, end = begin + off_begin, end - off_end
                break
        return (-end, -begin) if self.era(text) == "BC" else (begin, end)

    def numbers(self, text: str) -> tuple[int, int] | None:
        digits = re.sub(r"[ .,]", "", text)
        first = re.search(r"[0-9]+", digits)
        year = int(first.group()) if first else 0
        if day := re.search(r"\d{1,2}[/.-]\d{1,2}[/.-](\d{2,4})", text):
            year = int(day.group(1))
            year += (0 if len(day.group(1)) > 2 else 1900 if year > 25 else 2000)
        elif "jaar geleden" in text:
            year *= next((n for word, n in (("miljoen", 10**6), ("duizend", 1000), ("honderd", 100)) if word in text), 1)
        elif margin := MARGIN.search(text):
            year, off = int(re.sub(r"[ .,]", "", margin.group(1))), int(margin.group(2))
            return year + off, year - off
        elif "jaren " in text:
            year += 0 if year >= 100 else 1900 if year > 10 else 2000
            return year, year + 9
        elif re.search("['’]", text) and year < 100:
            year += 1900 if year > 25 else 2000
        elif "afgelopen" in text and "jaar" in text:
            return 2000 - year, 2000
        return year, year

    def period(self, text: str) -> tuple[int, int] | None:
        text = re.sub(r"\b(de|het) ", "", text.strip()).strip()
        plain = re.sub("[()-]", "", text).strip()
        tries = [t for base in (text, text.replace(" periode", ""), text.replace("-", " "), plain) for t in (base, base[:-1])]
        for t in tries:
            if t in self.periods:
                return self.periods[t]
        for pattern, late in ((r"^(late|laat|laatste helft|tweede helft)[ -](van )?", True), (r"^(vroege|vroeg|eerste helft|1e helft)[ -](van )?", False)):
            rest = re.sub(pattern, "", text)
            span = rest != text and next((self.periods[t] for t in (rest, rest[:-1]) if t in self.periods), None)
            if span:
                # the literal rule takes begin + end - begin / 2 for the middle
                middle = round(span[0] + span[1] - span[0] / 2) if self.strict_reference else (span[0] + span[1]) // 2
                return (middle, span[1]) if late else (span[0], middle)
        words = [w for w in re.split("[ –—-]", text) if w]
        for size in range(min(3, len(words)), 0, -1):
            for k in range(len(words) - size + 1):
                if (name := " ".join(words[k : k + size])) in self.periods:
                    return self.periods[name]
        for name, span in self.periods.items():
            if len(name) > 4 and (name in text or distance(name, text, 3) < 3):
                return span
        return None

    def corrected(self, begin: int, end: int, several: bool) -> tuple[int, int]:
        """Future years are taken as years before Christ; a range that runs backwards is repaired."""
        begin = -begin if begin > self.this_year else begin
        end = -end if end > self.this_year and end != 2099 else end
        if end < begin:
            if end < 0 < begin and -begin < end:
                begin = -begin
            elif several and begin - end < 400:
                begin, end = -begin, -end
            else:
                end = begin
        return begin, end


def distance(a: str, b: str, most: int) -> int:
    """Edit distance, or ``most`` if it is at least that."""
    if abs(len(a) - len(b)) >= most:
        return most
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def period_table(ontology: DataFrame, limit: int = 5000) -> dict[str, tuple[int, int]]:
    """Names and aliases of an ontology (label, start_year, end_year and columns of aliases), which has at most ``limit`` rows."""
    rows = ontology.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"an ontology has at most {limit} rows")
    names = [c for c in ontology.columns if c not in ("periodo_id", "start_year", "end_year")]
    return {str(r[c]).lower(): (int(r["start_year"]), int(r["end_year"])) for r in rows for c in names if r[c]}


def phrases(phrases: Phrases):
    """A UDF from arrays of phrases to arrays of years."""

    @F.pandas_udf("array<int>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, list[int]] = {}

        def years(phrase: str) -> list[int]:
            if phrase not in known:
                if len(known) > 100_000:
                    known.clear()
                known[phrase] = phrases.years(phrase)
            return known[phrase]

        for batch in batches:
            yield batch.map(lambda rest: [y for p in rest for y in years(p)] if rest is not None else None)

    return read


def dated(df: DataFrame, value: str, target: str, parser: Phrases | None = None, strict_reference: bool = False) -> DataFrame:
    """``df`` with ``<target>_vanaf`` and ``<target>_tot`` (int, null if nothing can be read)."""
    parser = parser or Phrases(strict_reference=strict_reference)
    codes = df.withColumn("_codes", read_codes(F.col(value), strict_reference))
    more = codes.withColumn("_more", phrases(parser)(F.when(F.size("_codes.rest") > 0, F.col("_codes.rest"))))
    years = F.concat("_codes.years", F.coalesce("_more", F.array().cast("array<int>")))
    return more.withColumn("_years", years).withColumns({f"{target}_vanaf": F.array_min("_years"), f"{target}_tot": F.array_max("_years")}).drop("_codes", "_more", "_years")
