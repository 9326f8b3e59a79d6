"""Column expressions. All of them stay inside generated code; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper edges (inclusive) and labels of the amount bins.
AMOUNT_EDGES = ((10, "tiny"), (50, "small"), (100, "medium"), (500, "large"))
AMOUNT_TOP = "huge"

# Kilometres per degree, and Spark's numbers for Sunday and Saturday.
KM_PER_DEGREE = 111
WEEKEND_DAYS = (1, 7)

MICROS = 1_000_000


def day_of_week(ts: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(ts)


def is_weekend(ts: Column) -> Column:
    return F.when(day_of_week(ts).isin(*WEEKEND_DAYS), 1).otherwise(0)


def amount_bin(amt: Column, null_bin: bool = False) -> Column:
    """Right-closed bins.

    By default amounts of 10 or less, negative ones too, are ``tiny`` and missing ones
    are ``huge``. With ``null_bin`` amounts that are missing or not above 0 have no bin.
    """
    bins = F.when(amt.isNull() | F.isnan(amt) | (amt <= 0), F.lit(None)) if null_bin else None
    for edge, label in AMOUNT_EDGES:
        bins = F.when(amt <= edge, label) if bins is None else bins.when(amt <= edge, label)
    return bins.otherwise(AMOUNT_TOP)


def planar_km(lat: Column, long: Column, other_lat: Column, other_long: Column) -> Column:
    """Distance on a flat grid of degrees; longitude is deliberately not scaled by latitude."""
    dy, dx = lat - other_lat, long - other_long
    return F.sqrt(dy * dy + dx * dx) * KM_PER_DEGREE


def is_local(df: DataFrame, name: str) -> bool:
    """Whether a time column carries no zone."""
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def epoch_seconds(ts: Column, local: bool) -> Column:
    """Whole seconds since 1970. A local time is counted as it reads, so that differences do
    not depend on the session's zone and its clock changes."""
    if not local:
        return F.unix_seconds(ts)
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(ts.cast("date")).cast("bigint") * 86_400 + clock


def epoch_micros(ts: Column, local: bool) -> Column:
    if not local:
        return F.unix_micros(ts)
    second = F.extract(F.lit("SECOND"), ts)
    return epoch_seconds(ts, local) * MICROS + ((second - F.floor(second)) * MICROS).cast("bigint")


def whole_span_days(first: Column, last: Column) -> Column:
    """Calendar days between two times: 23:59 to 00:01 is one day."""
    return F.datediff(last, first)


def exact_span_days(first: Column, last: Column, local: bool) -> Column:
    return (epoch_micros(last, local) - epoch_micros(first, local)) / F.lit(float(86_400 * MICROS))


def guarded_rate(count: Column, span: Column) -> Column:
    """Count per day, a zero span standing for one day."""
    return count / F.when(span == 0, 1).otherwise(span)


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL when a side is missing or the denominator is 0."""
    return F.try_divide(numerator, denominator)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def exact_amount(amt: Column, decimals: int | None = None) -> Column:
    """The amount as a decimal when its number of decimals is known, else as it is."""
    return amt if decimals is None else amt.cast(f"decimal(18,{decimals})")


def total(amt: Column, decimals: int | None = None) -> Column:
    """Sum as a double; exact when the number of decimals is known."""
    return F.sum(exact_amount(amt, decimals)).cast("double")


def mean(amt: Column, decimals: int | None = None) -> Column:
    if decimals is None:
        return F.avg(amt)
    return F.try_divide(total(amt, decimals), F.count(amt))


#: Decimals that distances are rounded to where their sums must not depend on the order of addition.
DISTANCE_DECIMALS = 11


def units(x: Column, decimals: int) -> Column:
    """A number as whole units of its last decimal; NULL if it doesn't fit 18 digits."""
    return F.round(x.cast("double") * float(10**decimals)).try_cast("decimal(18,0)")


def exact_mean(x: Column, decimals: int | None) -> Column:
    """The mean of whole units, the same in whatever order they are added; plain without ``decimals``.

    Numbers that don't fit 18 digits, or sums beyond 38, fall back to the plain mean.
    """
    if decimals is None:
        return F.avg(x)
    own = units(x, decimals)
    average = F.try_divide(F.try_sum(own).cast("double"), F.count(own)) / float(10**decimals)
    return F.when(F.count(own) == F.count(x), F.coalesce(average, F.avg(x))).otherwise(F.avg(x))


def exact_deviation(x: Column, decimals: int | None, weight: Column | None = None) -> Column:
    """The sample deviation from exact sums of whole units and of their squares, NULL below two numbers.

    Both sums can be merged in any order and grouping without changing a bit. The squares are
    those from a whole number next to the mean, in whole numbers too, so nothing cancels out.
    ``weight`` says how often a row counts. Where ``exact_mean`` falls back, so does this (without
    ``weight``; with it the result is NULL then).
    """
    if decimals is None:
        return F.stddev_samp(x)
    own, whole = units(x, decimals), "decimal(38,0)"
    times = F.lit(1) if weight is None else weight
    rows, fit = (F.sum(F.when(c.isNotNull(), times)) for c in (x, own))
    n = fit.cast(whole)
    first = F.try_sum(own if weight is None else own * times).cast(whole)
    second = F.try_sum(own * own if weight is None else (own * own).cast(whole) * times).cast(whole)
    near = F.round(F.try_divide(first.cast("double"), fit.cast("double"))).try_cast("decimal(18,0)").cast(whole)
    off = F.try_subtract(first, F.try_multiply(n, near))
    squares = F.try_add(F.try_subtract(second, F.try_multiply(F.try_multiply(near, first), F.lit(2))), F.try_multiply(n, F.try_multiply(near, near)))
    centred = squares.cast("double") - off.cast("double") * off.cast("double") / fit
    found = F.when(fit > 1, F.sqrt(F.greatest(F.lit(0.0), centred) / (fit - 1)) / float(10**decimals))
    if weight is not None:
        return F.when(rows == fit, found)
    exact = (rows == fit) & squares.isNotNull()
    return F.when(exact, found).otherwise(F.stddev_samp(x))
