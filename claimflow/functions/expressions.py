"""Column expressions shared by the operators. All of them are built-in Spark functions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: money is DECIMAL(15,2) in every table.
MONEY = "decimal(15,2)"

# The markers that stand for "missing" in the raw text columns.
MISSING_MARKERS = ("", "-")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: str | Column) -> Column:
    """NULL, blank or a lone dash. Never NULL itself, so it is safe to negate."""
    c = col(c)
    return c.isNull() | F.coalesce(F.trim(c.cast("string")).isin(*MISSING_MARKERS), F.lit(True))


def blank_to_null(c: str | Column) -> Column:
    c = col(c)
    return F.when(~is_missing(c), c)


def parse_money(c: str | Column, money: str = MONEY) -> Column:
    """`1,234,000` -> 1234000.00; markers and unreadable text -> NULL.

    Markers are tested before the cast: a failing cast raises and catches inside the JVM, which is slow. Whole numbers
    take the way over bigint, at a fraction of the cost of the decimal parser that reads all the rest.
    """
    raw = col(c).cast("string")
    text = F.trim(raw)
    digits = F.replace(text, F.lit(","), F.lit(""))
    read = F.when(~text.isin(*MISSING_MARKERS), digits.try_cast(money))
    # the cast to bigint also drops a DEL at the end, which the decimal parser refuses
    whole = (raw >= "0") & (raw < ":") & ~raw.contains(".") & ~raw.contains("\x7f")
    return F.coalesce(F.when(whole, F.replace(raw, F.lit(","), F.lit("")).try_cast("bigint").try_cast(money)), read)


def money_or_zero(c: str | Column, money: str = MONEY) -> Column:
    return F.coalesce(parse_money(c, money), F.lit(0).cast(money))


def parse_date(c: str | Column, fmt: str) -> Column:
    """Text to DATE under one format; markers and unreadable text -> NULL.

    Text of the usual form (a pattern of one dd, MM and yyyy, filled with as many digits) is put in ISO order and cast, at a
    fraction of the cost of the parser that reads all the rest.
    """
    parsed = F.try_to_timestamp(blank_to_null(c), F.lit(fmt)).cast("date")
    if sorted(re.split("[/-]", fmt)) != ["MM", "dd", "yyyy"]:
        return parsed
    text = col(c).cast("string")

    def part(name: str) -> Column:
        return F.substr(text, F.lit(fmt.index(name) + 1), F.lit(len(name)))

    usual = F.octet_length(text) == len(fmt)
    after = 1
    for at, sign in enumerate(fmt, start=1):
        if sign in "/-":
            usual = usual & (F.locate(sign, text, after) == at)
            after = at + 1
    # the cast refuses whatever is no digit, but for signs that end the day and the year 0
    ends_in_digit = F.substr(text, F.lit(fmt.index("dd") + 2), F.lit(1)).between("0", "9")
    year_zero = text.endswith("0000") if fmt.endswith("yyyy") else part("yyyy") == "0000"
    iso = F.concat(part("yyyy"), F.lit("-"), part("MM"), F.lit("-"), part("dd"))
    return F.coalesce(F.when(usual & ends_in_digit & ~year_zero, iso.try_cast("date")), parsed)


def to_day(c: str | Column) -> Column:
    return F.to_date(col(c))


def month_key(c: str | Column) -> Column:
    return F.trunc(col(c), "MM")


def full_months(start: str | Column, end: str | Column) -> Column:
    """Complete months between two dates (31 Jan -> 28 Feb is 0)."""
    s, e = col(start).cast("date"), col(end).cast("date")
    raw = (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)
    short = F.when((e >= s) & (F.day(e) < F.day(s)), 1).when((e < s) & (F.day(e) > F.day(s)), -1).otherwise(0)
    return (raw - short).cast("int")


def ratio(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(col(a), col(b))


MARKS = "\u0300\u0301\u0302\u0303\u0306\u0309\u031b\u0323"  # combining: tones, and the shapes of letters like â, ă and ơ


def _accented_letters() -> dict[str, str]:
    """Lower-case letter with marks -> its base, from the letters' own decompositions."""
    parts = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in (*range(0xE0, 0x1B1), *range(0x1EA0, 0x1EFA))}
    return {"đ": "d"} | {x: d[0] for x, d in parts.items() if len(d) > 1 and x.islower() and set(d[1:]) <= set(MARKS)}


ACCENTED = _accented_letters()


def bare(c: str | Column) -> Column:
    """Lower case without tones and other marks, whether letters are one character or a base with combining marks."""
    return F.translate(F.lower(col(c)), "".join(ACCENTED) + MARKS, "".join(ACCENTED.values()))


def bare_text(text: str) -> str:
    """`bare` of a constant."""
    return "".join(ACCENTED.get(x, x) for x in text.lower() if x not in MARKS)


def _any_of(phrases: Sequence[str]) -> str:
    return "|".join("\\Q" + p + "\\E" for p in phrases)


def any_phrase(text: str | Column, phrases: Sequence[str]) -> Column:
    """True when the whole text holds one of the phrases, ignoring case. NULL text -> False.

    Text with combining marks is compared without its marks.
    """
    low = F.lower(col(text))
    found = low.rlike(_any_of([p.lower() for p in phrases]))
    apart = low.rlike(f"[{MARKS}]") & bare(text).rlike(_any_of([bare_text(p) for p in phrases]))
    return F.coalesce(found | apart, F.lit(False))


def fold_tone(c: str | Column) -> Column:
    """Comparison key: trimmed, lower case, with the two tone-mark placements of `huy` made one."""
    return F.replace(F.lower(F.trim(col(c))), F.lit("huỷ"), F.lit("hủy"))


def _folded(text: str) -> str:
    """`fold_tone` of a constant."""
    return text.strip().lower().replace("huỷ", "hủy")


def map_value(
    c: str | Column,
    mapping: Mapping[str, str],
    unmatched: str | Column | None = None,
    keep: bool = False,
) -> Column:
    """Translate a category by a fixed vocabulary.

    The vocabulary is part of the code and small, so it becomes one literal map inside code generation
    and no join is planned. `unmatched` is the value of everything else (NULL by default);
    `keep=True` leaves unmatched values as they are. A value not found as written is looked up without its tones and
    other marks, where that names one entry only.
    """
    c = col(c)
    first: dict[str, str] = {}
    for source, target in mapping.items():
        first.setdefault(_folded(source), target)
    pairs = [F.lit(x) for pair in first.items() for x in pair]
    targets: dict[str, set[str]] = {}
    for source, target in mapping.items():
        targets.setdefault(bare_text(source.strip()), set()).add(target)
    plain = [F.lit(x) for key, names in targets.items() if len(names) == 1 for x in (key, *names)]
    written = [F.lit(x) for source in mapping for x in (source, first[_folded(source)])]
    found = F.coalesce(
        F.element_at(F.create_map(*written), c.cast("string")),  # the usual case, without a change of letters
        F.element_at(F.create_map(*pairs), fold_tone(c)),
        F.element_at(F.create_map(*plain), bare(F.trim(c))) if plain else F.lit(None).cast("string"),
    )
    if keep:
        return F.coalesce(found, c)
    if unmatched is None:
        return found
    return F.coalesce(found, unmatched if isinstance(unmatched, Column) else F.lit(unmatched))


def members_to_group(groups: Mapping[str, Iterable[str]]) -> dict[str, str]:
    """{group: members} -> {member: group}."""
    return {member: group for group, members in groups.items() for member in members}
