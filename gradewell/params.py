"""Scoring numbers and band tables. Everything the rules need is data in this module."""

from __future__ import annotations

from dataclasses import dataclass, fields
from decimal import Decimal

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class ScoreParams:
    """Point levels, grade cut points and group weights."""

    # Six point levels.
    unacceptable: int = 0
    very_bad: int = 100
    bad: int = 250
    good: int = 500
    very_good: int = 650
    excellent: int = 800
    # Five grade cut points.
    unacceptable_grade: int = 750
    very_bad_grade: int = 1000
    bad_grade: int = 1500
    good_grade: int = 2000
    very_good_grade: int = 2500
    # Weights of the three rule groups.
    payment_weight: Decimal = Decimal("0.20")
    default_weight: Decimal = Decimal("0.45")
    health_weight: Decimal = Decimal("0.35")

    def level(self, name: str) -> int:
        return getattr(self, name)

    @classmethod
    def from_conf(cls, spark: SparkSession) -> ScoreParams:
        """Read overrides from the session; values arrive as text and unset keys keep their default."""
        overrides = {}
        for name, key in CONF_KEYS.items():
            text = spark.conf.get(key, None)
            if text is not None:
                overrides[name] = int(text.strip())
        return cls(**overrides)

    def to_conf(self, spark: SparkSession) -> None:
        """Mirror the numbers into the session for SQL that reads them as `${...}`."""
        for name, key in CONF_KEYS.items():
            spark.conf.set(key, str(self.level(name)))

    def sql_args(self) -> dict[str, int]:
        """The integer numbers as named arguments for `spark.sql(text, args=...)`."""
        return {f.name: getattr(self, f.name) for f in fields(self) if isinstance(getattr(self, f.name), int)}


# Session keys under which the numbers may be set.
CONF_KEYS = {
    "unacceptable": "spark.sql.unacceptable_rated_pts",
    "very_bad": "spark.sql.very_bad_rated_pts",
    "bad": "spark.sql.bad_rated_pts",
    "good": "spark.sql.good_rated_pts",
    "very_good": "spark.sql.very_good_rated_pts",
    "excellent": "spark.sql.excellent_rated_pts",
    "unacceptable_grade": "spark.sql.unacceptable_grade_pts",
    "very_bad_grade": "spark.sql.very_bad_grade_pts",
    "bad_grade": "spark.sql.bad_rated_grade_pts",
    "good_grade": "spark.sql.good_grade_pts",
    "very_good_grade": "spark.sql.very_good_grade_pts",
}


@dataclass(frozen=True)
class Band:
    """One interval of a rule and the level it earns.

    Bounds are multiples of the rule's scale (the installment, the credit limit) where it has
    one, plain numbers otherwise. `closed` tells which ends belong to the band.
    """

    level: str
    low: Decimal | int | None = None
    high: Decimal | int | None = None
    closed: str = "both"
    or_null: bool = False


@dataclass(frozen=True)
class RuleSet:
    """A profile: the bands and text patterns of every rule.

    `otherwise_*` is the level of values no band takes; None leaves them NULL.
    """

    last_payment: tuple[Band, ...]
    counts: tuple[Band, ...]
    count_null_column: str | None
    funded: tuple[Band, ...]
    loan_status: tuple[tuple[str, str], ...]
    home: tuple[tuple[str, str], ...]
    home_tests_loan_status: bool
    otherwise_funded: str | None
    otherwise_status: str | None
    otherwise_home: str | None
    otherwise_grade: str | None
    half_open_grades: bool
    loans_by_member: bool = False
    #: Whether a loan id that stands on several loans or repayments joins them all, as it was first written. Else such ids are
    #: quarantined: they join with nothing and are listed.
    keep_repeated_loans: bool = False


# Total received against the funded amount. These points had no definition to follow: the table is ours.
TOTAL_PAYMENT_BANDS = (
    Band("very_good", low=Decimal("0.5"), closed="left"),
    Band("good", low=0, closed="neither"),
)

# The lender's grades and what each earns; sub-grades are the letter and 1 to 5.
GRADE_LEVELS = {"A": "excellent", "B": "good", "C": "bad", "D": "very_bad", "E": "unacceptable"}

# Counts of delinquencies, public records, bankruptcies and enquiries.
COUNT_BANDS = (
    Band("excellent", low=0, high=0),
    Band("bad", low=1, high=2),
    Band("very_bad", low=3, high=5),
    Band("unacceptable", low=5, closed="neither", or_null=True),
)

LITERAL = RuleSet(
    # Last payment in installments.
    last_payment=(
        Band("very_bad", high=Decimal("0.5"), closed="neither"),
        Band("bad", low=Decimal("0.5"), high=1, closed="neither"),
        Band("good", low=Decimal("0.5"), high=Decimal("0.5")),
        Band("very_good", low=1, high=Decimal("1.5"), closed="neither"),
        Band("excellent", low=Decimal("1.5"), closed="neither"),
    ),
    counts=COUNT_BANDS,
    count_null_column="delinq_2yrs",
    # Funded amount in credit limits; earlier bands win.
    funded=(
        Band("excellent", high=Decimal("0.1")),
        Band("good", low=Decimal("0.1"), high=Decimal("0.3"), closed="neither"),
        Band("bad", high=Decimal("0.3")),
        Band("very_bad", high=Decimal("0.5")),
        Band("unacceptable", low=1, high=1),
    ),
    # Lower-cased LIKE patterns, first match wins.
    loan_status=(
        ("%fully paid%", "excellent"),
        ("%current%", "good"),
        ("%in grace period%", "bad"),
        ("%late (16-30 days)%", "very_bad"),
        ("%late (31 - 120 days)%", "very_bad"),
        ("%charged off%", "unacceptable"),
    ),
    home=(
        ("%own", "excellent"),
        ("%rent%", "good"),
        ("%mortgage%", "bad"),
        ("%any%", "unacceptable"),
    ),
    home_tests_loan_status=True,
    otherwise_funded=None,
    otherwise_status=None,
    otherwise_home=None,
    otherwise_grade=None,
    half_open_grades=False,
    loans_by_member=True,
    keep_repeated_loans=True,
)

REPAIRED = RuleSet(
    last_payment=(
        Band("very_bad", high=Decimal("0.5"), closed="neither"),
        Band("bad", low=Decimal("0.5"), high=1, closed="left"),
        Band("good", low=1, high=1),
        Band("very_good", low=1, high=Decimal("1.5"), closed="neither"),
        Band("excellent", low=Decimal("1.5"), closed="left"),
    ),
    counts=COUNT_BANDS,
    count_null_column=None,
    funded=(
        Band("excellent", high=Decimal("0.1")),
        Band("good", low=Decimal("0.1"), high=Decimal("0.3"), closed="neither"),
        Band("bad", low=Decimal("0.3"), high=Decimal("0.5"), closed="left"),
        Band("very_bad", low=Decimal("0.5"), high=Decimal("0.9"), closed="left"),
    ),
    loan_status=(
        ("%fully paid%", "excellent"),
        ("%current%", "good"),
        ("%in grace period%", "bad"),
        ("%late (16-30 days)%", "very_bad"),
        ("%late (31 - 120 days)%", "very_bad"),
        ("%late (31-120 days)%", "very_bad"),
        ("%charged off%", "unacceptable"),
        ("%default%", "unacceptable"),
    ),
    home=LITERAL.home,
    home_tests_loan_status=False,
    otherwise_funded="unacceptable",
    otherwise_status="unacceptable",
    otherwise_home="unacceptable",
    otherwise_grade="unacceptable",
    half_open_grades=True,
)
