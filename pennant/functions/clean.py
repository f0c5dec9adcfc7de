"""Column expressions that turn source text into typed, comparable values.

Nothing here raises on dirty input: what doesn't parse is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Nicknames, letters and codes as the sources have them.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
GAME_TYPES = {"R": "regular", "S": "spring", "A": "allstar", "E": "exhibition", "F": "wildcard", "D": "division", "L": "league", "W": "championship"}
FINAL_STATUSES = ("Final", "Completed Early", "Forfeit")


def guarded_int(x: Column, signed: bool = False) -> Column:
    """Whole number of a text like "12000.0"; null for anything else ("6500?", "<1000", ...)."""
    pattern = r"^-?[0-9]+(\.[0-9]+)?$" if signed else r"^[0-9]+(\.[0-9]+)?$"
    return F.when(x.rlike(pattern), x.try_cast("double").try_cast("long"))


def empty_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def number(x: Column, kind: str = "double") -> Column:
    """Typed value of a text, with "" and what doesn't parse as null."""
    return empty_to_null(F.trim(x)).try_cast(kind)


def sentinel(x: Column, *missing: str) -> Column:
    """Null for the source's own words for a missing value."""
    return F.when(~F.lower(F.trim(x)).isin(*[m.lower() for m in missing]), x)


def games_back(x: Column) -> Column:
    """"-" is the leader, that is 0."""
    return F.when(F.trim(x) == "-", F.lit(0.0)).otherwise(number(x))


def recode(x: Column, names: dict[str, str], otherwise: Column | None = None) -> Column:
    """Value by a literal map."""
    table = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    found = F.try_element_at(table, F.coalesce(x, F.lit("")))
    return found if otherwise is None else F.coalesce(found, otherwise)


def distinct_from(a: Column, b: Column) -> Column:
    """Unequal, where null is a value like others."""
    return ~a.eqNullSafe(b)


def date_of(year: Column, month: Column, day: Column) -> Column:
    """Date, if all three parts are there and make one."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def us_date(x: Column) -> Column:
    """Date of "MM/DD/YYYY"."""
    return F.when(x.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date(x, "MM/dd/yyyy"))


def compact_date(x: Column) -> Column:
    """Date of "YYYYMMDD"."""
    return F.when(x.rlike(r"^\d{8}$"), F.try_to_date(x, "yyyyMMdd"))


def season_of(x: Column) -> Column:
    """Season that a text begins with."""
    return F.substring(x, 1, 4).try_cast("int")


def outs_pitched(innings: Column) -> Column:
    """Outs of innings pitched: "6.2" is six innings and two outs, 20 outs."""
    whole = F.split_part(innings, F.lit("."), F.lit(1)).try_cast("int")
    rest = F.coalesce(empty_to_null(F.split_part(innings, F.lit("."), F.lit(2))).try_cast("int"), F.lit(0))
    return whole * 3 + rest


def count_class(x: Column, members: str) -> Column:
    """How many characters of x are in a regular expression class such as "A-CX"."""
    return F.length(F.regexp_replace(x, f"[^{members}]", "")).cast("long")


def first_in_class(x: Column, members: str) -> Column:
    return F.substring(x, 1, 1).rlike(f"[{members}]")


def flag(condition: Column) -> Column:
    """1 or 0; null conditions are 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")


def by_cases(cases: list[tuple[Column, float]], otherwise: float | None = None) -> Column:
    """Weight by the first condition that holds."""
    out = None
    for condition, value in cases:
        out = F.when(condition, F.lit(value)) if out is None else out.when(condition, F.lit(value))
    return out if otherwise is None else out.otherwise(F.lit(otherwise))


def base_state(first: Column, second: Column, third: Column) -> Column:
    """Occupied bases as digits: "1_3" has runners on first and third. Empty text is an empty base."""
    on = lambda x, digit: F.when(empty_to_null(F.trim(x)).isNotNull(), F.lit(digit)).otherwise(F.lit("_"))
    return F.concat(on(first, "1"), on(second, "2"), on(third, "3"))


def display_name(*parts: Column) -> Column:
    return F.nullif(F.concat_ws(" ", *[empty_to_null(p) for p in parts]), F.lit(""))


def slug_date(x: Column) -> Column:
    """Date that a slug ends with."""
    return F.try_to_date(empty_to_null(F.regexp_extract(x, r"(\d{4}-\d{2}-\d{2})$", 1)), "yyyy-MM-dd")


def ticker_date(x: Column, prefix: str) -> Column:
    """Date of a ticker like PREFIX-24APR05...: year, month letters, day."""
    pattern = rf"^{prefix}-(\d{{2}})([A-Z]{{3}})(\d{{2}})"
    part = lambda k: empty_to_null(F.regexp_extract(x, pattern, k))
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), part(2)).cast("int")
    return F.when((month > 0) & part(1).isNotNull(), F.try_to_date(F.concat(F.lit("20"), part(1), F.lpad(month.cast("string"), 2, "0"), part(3)), "yyyyMMdd"))


def literal_list(x: Column) -> Column:
    """Array of a text like "['a', 'b']"."""
    return F.from_json(F.regexp_replace(x, "'", '"'), "array<string>")


def mid_price(last: Column, bid: Column, ask: Column) -> Column:
    """Last price; without one ("" and zero don't count) the middle of bid and ask."""
    price = number(last)
    return F.when(price.isNotNull() & (price != 0), price).otherwise((number(bid) + number(ask)) / 2)


def age_years(on: Column, born: Column) -> Column:
    return F.datediff(on, born) / F.lit(365.25)


def rate(part: Column, whole: Column, least: float = 1) -> Column:
    """part / whole, null where whole is under `least`."""
    return F.when(whole >= least, part.cast("double") / whole)


def pick_side(home: Column, at_home: Column, away: Column) -> Column:
    """The home or the away column of a game."""
    return F.when(home, at_home).otherwise(away)


def where_given(values: dict[str, object]) -> Column:
    """Columns equal the given values; None leaves a column free."""
    out = F.lit(True)
    for name, value in values.items():
        if value is not None:
            out = out & (F.col(name) == F.lit(value))
    return out


def snake_case(name: str) -> str:
    """camelCase to snake_case."""
    return "".join(f"_{c.lower()}" if c.isupper() and k else c.lower() for k, c in enumerate(name))


def repair_escapes(x: Column) -> Column:
    r"""Text whose UTF-8 bytes were written as literal \xHH escapes.

    Untouched where there is no escape or the bytes aren't UTF-8.
    """

    @F.pandas_udf("string")
    def fix(values):
        def one(v):
            if v is None or "\\x" not in v:
                return v
            try:
                return v.encode("latin-1", "backslashreplace").decode("unicode_escape").encode("latin-1").decode("utf-8")
            except (UnicodeDecodeError, UnicodeEncodeError):
                return v

        return values.map(one)

    return F.when(F.contains(x, F.lit("\\x")), fix(x)).otherwise(x)
