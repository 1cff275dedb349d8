"""Row-level rules as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave import schema as S


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_from(c: Column | str, codes: Mapping[str, int], unseen: int) -> Column:
    """Code of a text under a small fixed map; ``unseen`` for all else and null."""
    c = _col(c)
    if not codes:
        return F.lit(unseen)
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c.cast("string")), F.lit(unseen))


def flag(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c.isin([k for k, v in S.FLAG_VALUES.items() if v]), 1).otherwise(0)


def status(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c.isin([k for k, v in S.STATUS_VALUES.items() if v]), 1).otherwise(0)


def monday_based_weekday(ts: Column | str) -> Column:
    return F.weekday(_col(ts))


def is_weekend(ts: Column | str) -> Column:
    return F.coalesce(F.weekday(_col(ts)) >= 5, F.lit(False)).cast("int")


def is_night(hour: Column | str) -> Column:
    hour = _col(hour)
    return F.coalesce((hour >= 23) | (hour <= 5), F.lit(False)).cast("int")


def amount_log(amount: Column | str) -> Column:
    amount = _col(amount)
    return F.log1p(F.when(amount < 0, F.lit(0.0)).otherwise(amount))


def parse_timestamp(text: Column | str) -> Column:
    return F.try_to_timestamp(F.replace(_col(text), F.lit("T"), F.lit(" ")))


def parse_double(text: Column | str, default: float | None = None) -> Column:
    text = _col(text).cast("string")
    # the cast also reads "1d" and "2f", which are no numbers
    number = F.when(text.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), text.try_cast("double"))
    return number if default is None else F.coalesce(number, F.lit(default))


def finite(c: Column | str) -> Column:
    """True for numbers that are neither null, NaN nor infinite."""
    c = _col(c).cast("double")
    return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))


def finite_or_null(c: Column | str) -> Column:
    return F.when(finite(c), _col(c).cast("double"))


def clip_unit(c: Column | str) -> Column:
    return F.least(F.greatest(_col(c), F.lit(0.0)), F.lit(1.0))


def risk_band(score: Column | str) -> Column:
    score = _col(score)
    (low, low_name), (mid, mid_name) = S.RISK_BANDS
    return (
        F.when(score < low, low_name).when(score < mid, mid_name)
        .when(score.isNotNull(), S.TOP_RISK_BAND)
    )


def decision(score: Column | str, threshold: Column | float) -> Column:
    return (_col(score) >= threshold).cast("int")


def as_fraction(value: Column | str) -> Column:
    """A threshold given as a percentage (> 1) or as a fraction."""
    value = _col(value)
    return F.when(value > 1, value / 100.0).otherwise(value)


def clamp_min(c: Column | str, floor: float) -> Column:
    c = _col(c)
    return F.when(c < floor, F.lit(floor)).otherwise(c)


def label_matches(c: Column | str, pattern: str) -> Column:
    """Whole-text regular-expression match; a missing label counts as empty."""
    return F.coalesce(_col(c), F.lit("")).rlike(f"^(?:{pattern})$")


def relabel(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Text of ``group`` where ``pattern`` matches the whole text, else the text."""
    c = _col(c)
    return F.when(label_matches(c, pattern), F.regexp_extract(c, f"^(?:{pattern})$", group)).otherwise(c)


def or_unknown(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("UNKNOWN"))


def used_percent(available: Column | str, total: Column | str) -> Column:
    return 100 * (1 - F.try_divide(_col(available), _col(total)))


def upper_tier(c: Column | str) -> Column:
    return F.upper(_col(c))


def spread_key(number: Column | str) -> Column:
    """Scatters whole numbers over 0..2^32-1 with plain integer arithmetic."""
    return F.pmod(F.pmod(_col(number), F.lit(2147483647)) * F.lit(2654435761), F.lit(4294967296))


def traffic_slot(key: Column, percent: float) -> Column:
    """``candidate`` for ``percent`` % of the keys, ``stable`` for the rest."""
    share = int(min(max(percent, 0.0), 100.0) * 100)
    return F.when(F.pmod(key, F.lit(10000)) < share, "candidate").otherwise("stable")


def hashed_slot(key: Column | str, percent: float) -> Column:
    return traffic_slot(F.xxhash64(_col(key)), percent)


def exact_sum(c: Column | str) -> Column:
    """Sum that does not depend on the order of the rows; six decimal places."""
    return F.sum(_col(c).try_cast("decimal(28,6)")).cast("double")


def violations(rules: Iterable[tuple[str, Column]]) -> Column:
    """Names of the rules whose condition is true, in rule order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
