"""Business rules as built-in Column expressions (all JVM-side, codegen'd).

Each function maps columns to a column; none collects or calls Python per row.
Comparisons against NULL fall through to the ``otherwise`` branch, as a SQL
CASE does.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- time -----------------------------------------------------------------

def ts_ntz(value: date | datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (no session time zone involved)."""
    if isinstance(value, datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, date):
        text = datetime.combine(value, time()).strftime("%Y-%m-%d %H:%M:%S")
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")


def date_lit(value: date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def days_before(as_of: date, days: int) -> date:
    return as_of - timedelta(days=days)


def to_ts(c: Column | str, tolerant: bool = False) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ. Bad input fails the query under ANSI, like the
    reference; ``tolerant=True`` turns it into NULL instead (``try_cast``)."""
    return col(c).try_cast("timestamp_ntz") if tolerant else col(c).cast("timestamp_ntz")


def utc_instant(c: Column | str) -> Column:
    """The instant of an ISO-8601 text read as UTC wall-clock time, NULL if unparseable.

    Same parser as ``to_ts``: a zone in the text is ignored, a date alone is
    midnight. No session time zone is involved.
    """
    return F.concat(to_ts(c, tolerant=True).cast("string"), F.lit("Z")).try_cast("timestamp")


def hour_start(ts: Column) -> Column:
    """TIMESTAMP_NTZ cut to its hour. ``date_trunc`` would pass through the session time zone."""
    return F.concat(F.substring(ts.cast("string"), 1, 13), F.lit(":00:00")).cast("timestamp_ntz")


def weekday_sunday0(ts: Column | str) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6 (SQL EXTRACT(DOW))."""
    return F.dayofweek(col(ts)) - 1


# ---- money ------------------------------------------------------------------
# Amounts carry at most two decimals and USD rates at most two more, so four
# decimals hold every amount exactly. Sums run in DECIMAL and are therefore
# exact and independent of partitioning and task order; results are reported
# as DOUBLE. BOUNDED suits silver amounts (< 100 000 after cleaning); RAW suits
# unfiltered bronze amounts.
MONEY_BOUNDED = "decimal(18,4)"
MONEY_RAW = "decimal(38,4)"
# Scores are not money: 15 decimals hold every digit a score in [0, 1] is written with.
SCORE = "decimal(38,15)"


def exact_sum(c: Column | str, dec_type: str = MONEY_BOUNDED, as_double: bool = True) -> Column:
    """SUM in DECIMAL; ``as_double=False`` keeps the decimal for a later re-sum."""
    total = F.sum(col(c).cast(dec_type))
    return total.cast("double") if as_double else total


def safe_div(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def exact_avg(c: Column | str, dec_type: str = MONEY_BOUNDED) -> Column:
    """AVG with an exact sum: sum(decimal) / count(non-null), NULL on no rows."""
    return safe_div(exact_sum(c, dec_type), F.count(col(c)))


def distinct_count(c: Column | str, approx: bool = False, rsd: float = 0.01) -> Column:
    """COUNT(DISTINCT c); ``approx=True`` uses a HyperLogLog++ sketch (``rsd`` relative
    error) that merges per task without shuffling the distinct values."""
    return F.approx_count_distinct(col(c), rsd) if approx else F.countDistinct(col(c))


def distinct_size(c: Column | str, approx: bool = False) -> Column:
    """COUNT(DISTINCT c) as the size of a set, for values of which a group has few: merged in
    each task like any other aggregate, where several COUNT(DISTINCT ...) would multiply the rows."""
    return distinct_count(c, True) if approx else F.size(F.collect_set(col(c))).cast("long")


def count_when(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END): NULL conditions do not count."""
    return F.count(F.when(cond, F.lit(1)))


# ---- silver transaction rules (B2-B6) -------------------------------------------

def is_high_risk(fraud_score: Column | str, threshold: float = C.FRAUD_SCORE_THRESHOLD) -> Column:
    return F.when(col(fraud_score) >= threshold, F.lit(True)).otherwise(F.lit(False))


def amount_category(amount: Column | str, high: float = C.HIGH_VALUE_TRANSACTION_THRESHOLD) -> Column:
    a = col(amount)
    return (F.when(a >= high, "High")
            .when(a >= C.MEDIUM_AMOUNT_THRESHOLD, "Medium")
            .otherwise("Low"))


def time_of_day(hour: Column | str) -> Column:
    h = col(hour)
    expr = None
    for label, lo, hi in C.TIME_OF_DAY_HOURS:
        expr = (F.when if expr is None else expr.when)(h.between(lo, hi), label)
    return expr.otherwise("Night")


def day_type(dow: Column | str) -> Column:
    return F.when(col(dow).isin(*C.WEEKEND_DAYS), "Weekend").otherwise("Weekday")


def to_usd(amount: Column | str, currency: Column | str, rates=C.USD_RATES) -> Column:
    a, cur = col(amount), col(currency)
    expr = None
    for code, rate in rates:
        expr = (F.when if expr is None else expr.when)(cur == code, a * F.lit(float(rate)))
    return expr.otherwise(a)


# ---- silver customer rules (B11-B13) --------------------------------------------

def success_rate_pct(successful: Column | str, total: Column | str) -> Column:
    """completed / total * 100 rounded half-up to 2 decimals; 0 without transactions.

    The quotient is formed in DECIMAL so the rounding sees the exact value.
    """
    s, t = col(successful), col(total)
    exact = F.round((s * 100).cast("decimal(20,0)") / t, 2).cast("double")
    return F.when(t > 0, exact).otherwise(F.lit(0.0))


def customer_status(last_seen: Column | str, as_of: date, active_days: int = C.ACTIVE_CUSTOMER_DAYS) -> Column:
    return (F.when(col(last_seen) >= ts_ntz(days_before(as_of, active_days)), "Active")
            .otherwise("Inactive"))


def customer_segment(total_spent: Column | str, high: float = C.HIGH_VALUE_TRANSACTION_THRESHOLD) -> Column:
    t = col(total_spent)
    return (F.when(t >= high, "High Value")
            .when(t >= C.MEDIUM_AMOUNT_THRESHOLD, "Medium Value")
            .otherwise("Low Value"))


# ---- gold customer rules (B16-B24) --------------------------------------------------

def daily_value(revenue: Column | str, days: Column | str) -> Column:
    return F.when(col(days) > 0, col(revenue) / col(days)).otherwise(F.lit(0.0))


def estimated_ltv(revenue: Column | str, days: Column | str) -> Column:
    r, d = col(revenue), col(days)
    return (F.when(d >= C.LTV_MIN_DAYS, r * (F.lit(365.0) / d) * F.lit(C.LTV_RETENTION))
            .otherwise(r * F.lit(C.LTV_NEW_CUSTOMER_MULTIPLIER)))


def tier(value: Column | str, tiers, default: str) -> Column:
    v = col(value)
    expr = None
    for label, bound in tiers:
        expr = (F.when if expr is None else expr.when)(v >= bound, label)
    return expr.otherwise(default)


def ltv_category(ltv: Column | str) -> Column:
    return tier(ltv, C.LTV_TIERS, "Low LTV")


def composite_risk_score(avg_fraud: Column | str, high_risk: Column | str, night: Column | str,
                         n: Column | str, stddev: Column | str) -> Column:
    w_fraud, w_high, w_night, w_vol = C.RISK_WEIGHTS
    nn = col(n)

    def weighted_share(count: Column | str, weight: float) -> Column:
        return F.when(nn > 0, (col(count).cast("double") / nn) * F.lit(weight)).otherwise(F.lit(0.0))

    return ((col(avg_fraud) * F.lit(w_fraud))
            + weighted_share(high_risk, w_high)
            + weighted_share(night, w_night)
            + F.when(col(stddev) > C.RISK_STDDEV_THRESHOLD, F.lit(w_vol)).otherwise(F.lit(0.0)))


def risk_level(score: Column | str) -> Column:
    return tier(score, C.RISK_TIERS, "Low Risk")


def engagement_level(txn_days: Column | str, last_activity: Column | str, as_of: date) -> Column:
    expr = None
    for label, min_days, within in C.ENGAGEMENT_RULES:
        cond = (col(txn_days) >= min_days) & (col(last_activity) >= ts_ntz(days_before(as_of, within)))
        expr = (F.when if expr is None else expr.when)(cond, label)
    return expr.otherwise("Low Engagement")


def _score(cond_for_bound, bounds) -> Column:
    expr = None
    for score, bound in zip((5, 4, 3, 2), bounds):
        expr = (F.when if expr is None else expr.when)(cond_for_bound(bound), F.lit(score))
    return expr.otherwise(F.lit(1)).cast("int")


def recency_score(last_txn_date: Column | str, as_of: date) -> Column:
    return _score(lambda d: col(last_txn_date) >= date_lit(days_before(as_of, d)), C.RECENCY_DAYS)


def frequency_score(n: Column | str) -> Column:
    return _score(lambda b: col(n) >= b, C.FREQUENCY_COUNTS)


def monetary_score(revenue: Column | str) -> Column:
    return _score(lambda b: col(revenue) >= b, C.MONETARY_AMOUNTS)
