"""Pipeline parameters.

Every rule that depends on "today" takes its date from ``PipelineConfig.as_of``
instead of the wall clock, so a run can be repeated and checked.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, time

# Fixed values that must equal the reference's (its model variables and the
# literals written inside its SQL models), stated together here.
FRAUD_SCORE_THRESHOLD = 0.7
HIGH_VALUE_TRANSACTION_THRESHOLD = 1000.0
ACTIVE_CUSTOMER_DAYS = 30
MAX_NULL_PERCENTAGE = 0.05
MIN_ROW_COUNT = 100
MEDIUM_AMOUNT_THRESHOLD = 100.0  # amount_category and customer_segment "Medium"
AMOUNT_LOWER_BOUND = 0.0  # silver keeps amount > 0
AMOUNT_UPPER_BOUND = 100000.0  # ... and amount < 100000
USD_RATES = (("EUR", 1.1), ("BRL", 0.2), ("GBP", 1.25))  # other currencies pass through
TIME_OF_DAY_HOURS = (("Morning", 6, 12), ("Afternoon", 13, 18), ("Evening", 19, 23))  # else Night
WEEKEND_DAYS = (0, 6)  # Sunday = 0, Saturday = 6
LTV_MIN_DAYS = 30
LTV_RETENTION = 0.8
LTV_NEW_CUSTOMER_MULTIPLIER = 2.0
LTV_TIERS = (("High LTV", 5000.0), ("Medium LTV", 1000.0))  # else Low LTV
RISK_WEIGHTS = (0.4, 0.3, 0.2, 0.1)  # avg fraud, high-risk share, night share, volatility bump
RISK_STDDEV_THRESHOLD = 1000.0
RISK_TIERS = (("High Risk", 0.7), ("Medium Risk", 0.4))  # else Low Risk
ENGAGEMENT_RULES = (("Highly Engaged", 30, 7), ("Moderately Engaged", 10, 30))  # min txn days, max days since activity
RECENCY_DAYS = (30, 90, 180, 365)  # scores 5, 4, 3, 2; else 1
FREQUENCY_COUNTS = (50, 20, 10, 5)  # scores 5, 4, 3, 2; else 1
MONETARY_AMOUNTS = (5000.0, 1000.0, 500.0, 100.0)  # scores 5, 4, 3, 2; else 1
FRESHNESS_HOURS = 2


@dataclass(frozen=True)
class PipelineConfig:
    as_of: date = date(2024, 1, 31)
    run_ts: datetime | None = None  # defaults to midnight of as_of
    fraud_score_threshold: float = FRAUD_SCORE_THRESHOLD
    high_value_transaction_threshold: float = HIGH_VALUE_TRANSACTION_THRESHOLD
    active_customer_days: int = ACTIVE_CUSTOMER_DAYS
    max_null_percentage: float = MAX_NULL_PERCENTAGE
    min_row_count: int = MIN_ROW_COUNT
    # Our own definitions for rules the reference only names.
    max_volume_change_pct: float = 50.0
    freshness_hours: int = FRESHNESS_HOURS
    dedup_watermark: str = "1 hour"
    session_gap: str = "30 minutes"
    duplicate_tolerance: float = 0.0  # 0 = strict gate (any duplicate fails)
    one_row_per_customer: bool = False
    tolerant_casts: bool = False  # E1: unparseable timestamps become NULL instead of failing the run
    # Layout of the written silver transactions: one folder per date suits large
    # volumes (date pruning, the reference indexes transaction_date); None writes
    # one unpartitioned table, better when each date holds only a few rows.
    silver_partition_by: str | None = "transaction_date"
    # Partitions of the incremental states: by date, where "day" suits large volumes and "month" or "year"
    # days of a few rows, and by customer, whose number never changes once states are written.
    state_period: str = "day"
    state_slots: int = 64
    # Customer tables as bucketed catalog tables of so many buckets, named with the prefix (plans/layout.py); None writes plain folders.
    customer_buckets: int | None = None
    table_prefix: str = "goldvein_"
    usd_rates: tuple = field(default=USD_RATES)

    @property
    def run_timestamp(self) -> datetime:
        return self.run_ts or datetime.combine(self.as_of, time())

    def run_ts_string(self) -> str:
        return self.run_timestamp.strftime("%Y-%m-%d %H:%M:%S")


DEFAULT = PipelineConfig()
