"""Text signals as Column expressions.

The patterns are Unicode-aware: a word character is a letter, a number or the underscore, and
white space is the full Unicode set. Java's ``\\b`` and ``\\s`` mean less than that, so the two
are spelled out as classes and look-arounds here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE_CHARS = r"\s\x1c-\x1f\x85\p{Z}"
SPACE = f"[{SPACE_CHARS}]"
NOT_SPACE = f"[^{SPACE_CHARS}]"
WORD = r"[\p{L}\p{N}_]"
WORD_START = f"(?<!{WORD})"
WORD_END = f"(?!{WORD})"
EDGE = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# Phrases that signal a negated statement, each matched as whole words.
NEGATIONS = (
    "not",
    "never",
    "no longer",
    "does(?:n't| not)",
    "is(?:n't| not)",
    "was(?:n't| not)",
    "were(?:n't| not)",
    "can(?:'t|not)",
    "won't",
    "shouldn't",
    "false",
    "incorrect",
    "discontinued",
    "deprecated",
)
# Units that may follow a number.
UNITS = ("%", "percent", "million", "billion", "thousand")
# Month names, their short forms, and words that introduce a bare year.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
YEAR_WORDS = ("in", "since", "from", "as of", "until", "before", "after")
# Words of the English approximation "tokens = words / 0.75".
WORDS_PER_TOKEN = 0.75

# Each pattern starts with a look-ahead for its possible first letters: cheap to refuse.
NUMBER = rf"(?=\p{{Nd}}){WORD_START}(\p{{Nd}}+(?:\.\p{{Nd}}+)?){SPACE}*({'|'.join(UNITS)})?{EDGE}"
# A phrase and an acronym never share a word, so one scan finds both.
ENTITY = (
    rf"(?=[A-Z]){WORD_START}(?:[A-Z][a-z]+(?:{SPACE}+[A-Z][a-z]+)+|[A-Z]{{2,6}}){WORD_END}"
)
ANY_YEAR = "20[0-9]{2}"
ISO_DATE = (
    rf"(?=2){WORD_START}(20[0-9]{{2}})[/-](0[1-9]|1[0-2])[/-](0[1-9]|[12][0-9]|3[01]){WORD_END}"
)
MONTH_FIRST = (
    rf"(?iu)(?=[jfmasond]){WORD_START}({'|'.join(MONTHS)}){SPACE}+([0-9]{{1,2}}),?{SPACE}+"
    rf"(20[0-9]{{2}}){WORD_END}"
)
DAY_FIRST = (
    rf"(?iu)(?=[0-9]){WORD_START}([0-9]{{1,2}}){SPACE}+({'|'.join(m[:3] for m in MONTHS)}){WORD}*"
    rf"{SPACE}+(20[0-9]{{2}}){WORD_END}"
)
YEAR_ONLY = (
    rf"(?iu)(?=[isfaub]){WORD_START}(?:{'|'.join(YEAR_WORDS)}){SPACE}+(20[0-9]{{2}}){WORD_END}"
)
ANY_NEGATION = rf"(?iu)(?=[ndiwcsf]){WORD_START}(?:{'|'.join(NEGATIONS)}){WORD_END}"
_MONTH_NUMBERS = {name[:3].lower(): number for number, name in enumerate(MONTHS, 1)}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_extract(_col(c), rf"(?s)\A{SPACE}*+(.*{NOT_SPACE})?", 1)


def is_blank(c: Column | str) -> Column:
    return ~F.rlike(_col(c), F.lit(NOT_SPACE))


def word_count(c: Column | str) -> Column:
    return F.regexp_count(_col(c), F.lit(f"{NOT_SPACE}+"))


def token_count(c: Column | str) -> Column:
    return word_count(c) / F.lit(WORDS_PER_TOKEN)


def has_negation(c: Column | str) -> Column:
    """One scan of the text, all phrases in one alternation."""
    return F.rlike(_col(c), F.lit(ANY_NEGATION))


def negation_count(c: Column | str) -> Column:
    """How many of the phrases occur at least once; the single scan settles most texts."""
    hits = [
        F.rlike(_col(c), F.lit(f"(?iu){WORD_START}{p}{WORD_END}")).cast("int") for p in NEGATIONS
    ]
    return F.when(has_negation(c), sum(hits[1:], hits[0])).otherwise(F.lit(0))


def number_mentions(c: Column | str) -> Column:
    """Sorted distinct numbers, with their unit where one follows."""
    found = F.regexp_extract_all(_col(c), F.lit(NUMBER), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, strip)))


def entity_mentions(c: Column | str) -> Column:
    """Distinct capitalized phrases of two or more words, and acronyms of 2-6 letters."""
    return F.array_distinct(F.regexp_extract_all(_col(c), F.lit(ENTITY), F.lit(0)))


def _day(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.try_to_date(text, "yyyy-MM-dd")


def _month_number(name: Column) -> Column:
    """Month names differ in their first three letters."""
    numbers = F.create_map(*[F.lit(str(x)) for pair in _MONTH_NUMBERS.items() for x in pair])
    return F.element_at(numbers, F.lower(F.left(name, F.lit(3))))


def date_mentions(c: Column | str) -> Column:
    """Every date the text names; impossible ones (February 30) are dropped.

    A bare year after a word such as "since" counts as July 1 of that year.
    """
    text = _col(c)

    def part(match: Column, pattern: str, group: int) -> Column:
        return F.regexp_extract(match, pattern, group)

    def found(pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    iso = F.transform(
        found(ISO_DATE), lambda m: F.try_to_date(F.translate(m, "/", "-"), "yyyy-MM-dd")
    )
    month_first = F.transform(
        found(MONTH_FIRST),
        lambda m: _day(
            part(m, MONTH_FIRST, 3), _month_number(part(m, MONTH_FIRST, 1)), part(m, MONTH_FIRST, 2)
        ),
    )
    day_first = F.transform(
        found(DAY_FIRST),
        lambda m: _day(
            part(m, DAY_FIRST, 3), _month_number(part(m, DAY_FIRST, 2)), part(m, DAY_FIRST, 1)
        ),
    )
    years = F.transform(
        F.regexp_extract_all(text, F.lit(YEAR_ONLY), F.lit(1)),
        lambda y: _day(y, F.lit("7"), F.lit("1")),
    )
    dates = F.filter(F.concat(iso, month_first, day_first, years), lambda d: d.isNotNull())
    # every form contains a year; most texts are done after this one scan
    has_year = F.rlike(text, F.lit(ANY_YEAR))
    return F.when(has_year, dates).otherwise(F.array().cast("array<date>"))


def document_id(source: Column | str, index: Column | str) -> Column:
    """First 16 hex digits of sha256("source::index")."""
    raw = F.concat_ws("::", _col(source), _col(index).cast("string"))
    return F.substring(F.sha2(raw, 256), 1, 16)


def normalized_hash(c: Column | str) -> Column:
    """Equal for texts that agree after trimming and lower-casing."""
    return F.sha2(F.lower(strip(c)), 256)
