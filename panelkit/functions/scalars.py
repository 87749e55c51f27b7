"""Column expressions of the panel library."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(c: Column, lo=None, hi=None) -> Column:
    """Bound a value on one or both sides; a missing value stays missing (a bare greatest() would skip it)."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def half_even(c: Column, digits: int) -> Column:
    return F.bround(F.round(c, 9), digits)


def significant(c: Column, digits: int = 4) -> Column:
    """Round to significant digits; 0 stays 0."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))) - (digits - 1))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.rint(c / unit) * unit)


def implied_probability(odds: Column) -> Column:
    """1 / decimal odds; 0 for missing or zero odds."""
    return F.coalesce(F.try_divide(F.lit(1.0), odds), F.lit(0.0))


def without_overround(parts: list[Column]) -> list[Column]:
    """Probabilities divided by their sum; zeros if the sum is 0."""
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return [F.coalesce(F.try_divide(p, total), F.lit(0.0)) for p in parts]


def round_minute(ts: Column) -> Column:
    """To the minute, half minutes to the even one."""
    seconds = F.unix_micros(ts) / F.lit(60_000_000)
    return F.timestamp_micros((F.rint(seconds) * 60_000_000).cast("bigint"))


def flag(c: Column) -> Column:
    """Texts "True" and "False" (and booleans) as 1 and 0."""
    text = F.lower(c.cast("string"))
    return F.when(text == "true", 1).when(text == "false", 0)


def any_event(*counts: Column) -> Column:
    """1 if the counts add up to more than 0; a missing count gives 0."""
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return F.coalesce(total > 0, F.lit(False)).cast("int")


def hash_unit(*keys: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the keys and the seed only; other engines can compute the same."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_normal(*keys: Column, seed: int) -> Column:
    """A standard normal draw from two hash numbers (Box and Muller)."""
    u, v = hash_unit(*keys, seed=seed), hash_unit(*keys, seed=seed + 1)
    return F.sqrt(F.lit(-2.0) * F.log(F.greatest(u, F.lit(1e-12)))) * F.cos(F.lit(6.283185307179586) * v)


# Fixed by the game: points of a goal and a clean sheet by role, and the floor of a scorer's chance.
GOAL_POINTS = {"MID": 5, None: 4}
CLEAN_SHEET_POINTS = {"GK": 4, "DEF": 4, None: 0}
ROLE_FLOOR = {"FWD": 0.20, "MID": 0.12, "DEF": 0.06, "GK": 0.01, None: 0.10}


def by_role(role: Column, table: dict) -> Column:
    out = None
    for k, v in table.items():
        if k is not None:
            out = F.when(role == k, v) if out is None else out.when(role == k, v)
    return out.otherwise(table[None])


def role_floor(role: Column, minutes: Column) -> Column:
    share = F.greatest(F.lit(0.2), F.least(F.lit(1.0), F.coalesce(minutes, F.lit(0.0)) / 60))
    return by_role(role, ROLE_FLOOR) * share


def fixture_adjusted(raw: Column, difficulty: Column, weight: float = 0.5) -> Column:
    ease = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (difficulty + 5) / 10))
    return F.when(raw.isNotNull() & difficulty.isNotNull(), F.greatest(F.lit(0.0), raw + (ease - 0.5) * 2 * weight))


def blended(adjusted: Column, role_mean: Column, floor: Column, alpha: float = 0.65) -> Column:
    mixed = adjusted * alpha + role_mean * (1 - alpha)
    return half_even(F.when(mixed.isNotNull(), F.greatest(mixed, floor)), 2)


def expected_points(role, goals, assists, clean_sheet, card, bonus=None, minutes=None) -> Column:
    """Report form with minutes and bonus, selection form without."""
    out = goals * by_role(role, GOAL_POINTS) + assists * 3 + clean_sheet * by_role(role, CLEAN_SHEET_POINTS) - card
    if minutes is not None:
        out = out + F.when(minutes >= 60, 2).otherwise(0)
    return out + bonus if bonus is not None else out
