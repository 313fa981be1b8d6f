"""Points rules of the loan score, built from a :class:`ScoreParams`."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from decimal import Decimal

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ScoreParams:
    """Points per rating, lower limits of the final grades, component weights and rule options.

    The first eleven fields can also be set as session configuration, see :meth:`from_conf`.
    """

    # fixed values: points per rating
    unacceptable_rated_pts: int = 0
    very_bad_rated_pts: int = 100
    bad_rated_pts: int = 250
    good_rated_pts: int = 500
    very_good_rated_pts: int = 650
    excellent_rated_pts: int = 800
    # fixed values: limits between final grades, F/E up to B/A
    unacceptable_grade_pts: int = 750
    very_bad_grade_pts: int = 1000
    bad_grade_pts: int = 1500
    good_grade_pts: int = 2000
    very_good_grade_pts: int = 2500

    # fixed values: weight of each component
    payment_weight: Decimal = Decimal("0.20")
    defaulter_weight: Decimal = Decimal("0.45")
    health_weight: Decimal = Decimal("0.35")

    # More than five delinquencies earn the F/E grade limit (True) or the lowest rating (False).
    many_delinquencies_earn_grade_limit: bool = True
    # Points for a last payment of at least half but less than one instalment; None = very bad.
    part_payment_pts: int | None = None
    # Points for a home ownership outside own/rent/mortgage/any; None makes the score NULL.
    other_home_pts: int | None = None
    # Score members without a delinquency row too (they count as zero delinquencies).
    score_undelinquent: bool = False

    @staticmethod
    def conf_names() -> list[str]:
        return [f.name for f in fields(ScoreParams) if f.name.endswith(("_rated_pts", "_grade_pts"))]

    @classmethod
    def from_conf(cls, spark: SparkSession, base: ScoreParams | None = None) -> ScoreParams:
        """Take ``spark.sql.<name>`` settings where the session has them."""
        base = base or cls()
        found = {n: spark.conf.get(f"spark.sql.{n}", None) for n in cls.conf_names()}
        return replace(base, **{n: int(v) for n, v in found.items() if v is not None})

    def to_conf(self, spark: SparkSession) -> None:
        """Publish the eleven settings, for SQL text that uses ``${spark.sql.<name>}``."""
        for name in self.conf_names():
            spark.conf.set(f"spark.sql.{name}", str(getattr(self, name)))


DEFAULT_PARAMS = ScoreParams()


# fixed values: bands of a count, both ends included, after none and before many
FEW = (1, 2)
SOME = (3, 5)
# fixed values: shares of an instalment and of the funded amount
HALF_INSTALMENT, LONG_INSTALMENT = 0.5, 1.5
HALF_FUNDED = 0.5
# fixed values: loan status texts, lower case, the first one found counts
STATUS_PAID = "fully paid"
STATUS_CURRENT = "current"
STATUS_GRACE = "in grace period"
STATUS_LATE = ("late (16-30 days)", "late (31-120 days)")
# fixed values: last letters of the home ownership text, lower case
HOME_OWN, HOME_RENT, HOME_MORTGAGE, HOME_ANY = "own", "rent", "mortgage", "any"
# fixed values: highest shares of the credit limit, from best rating to very bad
LIMIT_SHARES = (0.10, 0.20, 0.30, 0.50, 0.70)


def _first_match(rules: list[tuple[Column, int]], default: int | None = None) -> Column:
    """CASE over (condition, points); ``default`` None leaves unmatched rows NULL."""
    chain = F
    for condition, points in rules:
        chain = chain.when(condition, F.lit(points))
    return chain if default is None else chain.otherwise(F.lit(default))


def last_payment_pts(paid: Column, installment: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    part = p.very_bad_rated_pts if p.part_payment_pts is None else p.part_payment_pts
    return _first_match(
        [
            (paid < installment * F.lit(HALF_INSTALMENT), p.very_bad_rated_pts),
            (paid < installment, part),
            (paid == installment, p.good_rated_pts),
            (paid <= installment * F.lit(LONG_INSTALMENT), p.very_good_rated_pts),
            (paid > installment * F.lit(LONG_INSTALMENT), p.excellent_rated_pts),
        ],
        default=p.unacceptable_rated_pts,
    )


def total_payment_pts(received: Column, funded: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    half = funded * F.lit(HALF_FUNDED)
    return _first_match(
        [
            (received >= half, p.very_good_rated_pts),
            ((received < half) & (received > 0), p.good_rated_pts),
            ((received == 0) | received.isNull(), p.unacceptable_rated_pts),
        ]
    )


def count_pts(count: Column, many: int, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """Banded count: 0, 1-2, 3-5, and ``many`` for above five or NULL."""
    return _first_match(
        [
            (count == 0, p.excellent_rated_pts),
            (count.between(*FEW), p.bad_rated_pts),
            (count.between(*SOME), p.very_bad_rated_pts),
            ((count > SOME[1]) | count.isNull(), many),
        ]
    )


def delinquency_pts(count: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    grade_limit = p.many_delinquencies_earn_grade_limit
    return count_pts(count, p.unacceptable_grade_pts if grade_limit else p.unacceptable_rated_pts, p)


def public_record_pts(count: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    return count_pts(count, p.very_bad_rated_pts, p)


def bankruptcy_pts(count: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    return count_pts(count, p.very_bad_rated_pts, p)


def enquiry_pts(count: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    return count_pts(count, p.unacceptable_rated_pts, p)


def loan_status_pts(status: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    text = F.lower(status)
    shorter, longer = (text.contains(t) for t in STATUS_LATE)
    return _first_match(
        [
            (text.contains(STATUS_PAID), p.excellent_rated_pts),
            (text.contains(STATUS_CURRENT), p.good_rated_pts),
            (text.contains(STATUS_GRACE), p.bad_rated_pts),
            (shorter | longer, p.very_bad_rated_pts),
        ],
        default=p.unacceptable_rated_pts,
    )


def home_pts(ownership: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    text = F.lower(ownership)
    return _first_match(
        [
            (text.endswith(HOME_OWN), p.excellent_rated_pts),
            (text.endswith(HOME_RENT), p.good_rated_pts),
            (text.endswith(HOME_MORTGAGE), p.bad_rated_pts),
            (text.endswith(HOME_ANY) | text.isNull(), p.very_bad_rated_pts),
        ],
        default=p.other_home_pts,
    )


def credit_limit_pts(funded: Column, limit: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    ratings = (
        p.excellent_rated_pts, p.very_good_rated_pts, p.good_rated_pts, p.bad_rated_pts,
        p.very_bad_rated_pts,
    )
    return _first_match(
        [
            (funded <= limit * F.lit(share), points)
            for share, points in zip(LIMIT_SHARES, ratings, strict=True)
        ],
        default=p.unacceptable_rated_pts,
    )


# fixed values: share of the grade's points that each sub-grade keeps
SUB_GRADE_SHARE = {
    "1": Decimal("1.00"), "2": Decimal("0.95"), "3": Decimal("0.90"),
    "4": Decimal("0.85"), "5": Decimal("0.80"),
}
GRADE_PTS_TYPE = "decimal(12,2)"


def grade_pts(grade: Column, sub_grade: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    """Points of the grade times the share that the sub-grade's digit keeps.

    A sub-grade that does not belong to its grade gives NULL; F and G need no sub-grade.
    """
    rated = {
        "A": p.excellent_rated_pts,
        "B": p.very_good_rated_pts,
        "C": p.good_rated_pts,
        "D": p.bad_rated_pts,
        "E": p.very_bad_rated_pts,
    }
    base = _first_match([(grade == letter, points) for letter, points in rated.items()])
    share = F
    for digit, kept in SUB_GRADE_SHARE.items():
        share = share.when(sub_grade == F.concat(grade, F.lit(digit)), F.lit(kept))
    return F.when(grade.isin("F", "G"), F.lit(p.unacceptable_rated_pts).cast(GRADE_PTS_TYPE)).otherwise(
        (base * share).cast(GRADE_PTS_TYPE)
    )


def final_grade(score: Column, p: ScoreParams = DEFAULT_PARAMS) -> Column:
    limits = [
        ("A", p.very_good_grade_pts),
        ("B", p.good_grade_pts),
        ("C", p.bad_grade_pts),
        ("D", p.very_bad_grade_pts),
        ("E", p.unacceptable_grade_pts),
    ]
    chain = F
    for letter, limit in limits:
        chain = chain.when(score > limit, F.lit(letter))
    return chain.when(score <= p.unacceptable_grade_pts, F.lit("F"))
