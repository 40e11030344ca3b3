"""Column expressions shared by the DataFrame plans."""

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimrisk.schemas import TIER_DEFAULT, TIER_THRESHOLDS

INF = float("inf")


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def finite(value) -> Column:
    """The value, NULL where it is NaN or infinite: NaN sorts above every number and passes any minimum."""
    number = as_column(value)
    return F.when((number < INF) & (number > -INF), number)


def guarded_ratio(numerator, denominator) -> Column:
    """NULL on a zero or NULL denominator; ANSI mode would raise on plain division."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def exact_parts(value) -> tuple[Column, Column]:
    """Whole units and millionths of money in doubles, as integers: their sums don't depend on row order, and
    sums of sums merge exactly."""
    amount = as_column(value)
    whole = F.floor(amount)
    return whole, F.floor((amount - whole) * 1_000_000 + 0.5)


def exact_total(whole, millionths, digits=None) -> Column:
    """The amount of summed ``exact_parts``."""
    total = (as_column(whole).cast("decimal(25,6)")
             + as_column(millionths).cast("decimal(25,0)") * F.lit(Decimal("0.000001")))
    return (F.round(total, digits) if digits is not None else total).cast("double")


def exact_sum(value, digits=None) -> Column:
    """Sum of money in doubles that does not depend on row order, exact to a millionth per row.

    Whole units and millionths are summed as integers, which is cheaper than decimal sums; only the
    final value of a group is a decimal.
    """
    whole, millionths = exact_parts(value)
    return exact_total(F.sum(whole), F.sum(millionths), digits)


def claim_value(charge="avg_submitted_charge", services="total_services") -> Column:
    return as_column(charge) * as_column(services)


def zscore(value, mean, stddev) -> Column:
    """Distance from the peer mean; 0 in a group without spread, NULL in a group of one or if not finite."""
    spread = as_column(stddev)
    return finite(F.when(spread == 0, F.lit(0.0)).otherwise(
        (as_column(value) - as_column(mean)) / spread))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def risk_tier(score) -> Column:
    """First tier whose threshold the score reaches; an unknown or NaN score falls to the lowest tier."""
    reached = [F.when(finite(score) >= floor, F.lit(name)) for name, floor in TIER_THRESHOLDS]
    return F.coalesce(*reached, F.lit(TIER_DEFAULT))


def processed_at(run_ts=None) -> Column:
    """One audit time per run when given, otherwise the query start."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
