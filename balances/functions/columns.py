"""Scalar column expressions (built-in Spark functions only, codegen-friendly)."""
from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from balances.config import SETTINGS


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num, den, positive_only: bool = False) -> Column:
    """NULL (never inf, never an ANSI error) when the denominator is 0/NULL,
    or <= 0 when ``positive_only``."""
    n, d = col(num).cast("double"), col(den).cast("double")
    if positive_only:
        return F.when(d > 0, n / d)
    return F.when(d != 0, n / d)


def any_null(cols) -> Column:
    """PF4: any of the block is NULL."""
    return reduce(or_, [col(c).isNull() for c in cols])


def all_null(cols) -> Column:
    """PF4: all of the block is NULL."""
    return reduce(and_, [col(c).isNull() for c in cols])



def clip_lower0(c) -> Column:
    """PF10: clip(lower=0) keeping NULL as NULL (greatest() would skip it)."""
    return F.when(col(c).isNotNull(), F.greatest(col(c), F.lit(0.0)))


def clip_upper0(c) -> Column:
    return F.when(col(c).isNotNull(), F.least(col(c), F.lit(0.0)))


def normalize_product(c) -> Column:
    """product-name normaliser (accent-mangled virtual investment)."""
    v = col(c)
    return (F.when(v == "CDT", F.lit("CDT"))
            .when(v.startswith("INVERSI"), F.lit("INVERSION_VIRTUAL"))
            .otherwise(v))


def has_non_ascii(c) -> Column:
    """value contains a non-ASCII character."""
    return col(c).rlike(r"[^\x00-\x7F]")


def id_text_ok(c) -> Column:
    """F16: id rendered as text is an exact integer (no '.', no exponent)."""
    return col(c).cast("string").rlike(r"^-?\d{1,20}$")


def month_index(c) -> Column:
    """T5: y*12 + m - 1."""
    return F.year(col(c)) * 12 + F.month(col(c)) - 1


def iv_class(c) -> Column:
    """ST3: IV strength class (fixed cut points)."""
    v = col(c)
    expr = None
    for cut, label in SETTINGS.iv_cuts:
        expr = F.when(v < cut, F.lit(label)) if expr is None else expr.when(v < cut, F.lit(label))
    return expr.otherwise(F.lit("strong"))


def level_from_rank(rn, n) -> Column:
    """Quartile of the percentile rank rn/n, right-closed, exact in integers."""
    d, c, b, a = SETTINGS.level_labels
    rn, n = col(rn), col(n)
    return (F.when(rn.isNull(), F.lit(None).cast("string"))
            .when(rn * 4 <= n, F.lit(d))
            .when(rn * 4 <= n * 2, F.lit(c))
            .when(rn * 4 <= n * 3, F.lit(b))
            .otherwise(F.lit(a)))


def level_ordinal(c) -> Column:
    """level -> ordinal (D=0 .. A=3)."""
    labels = SETTINGS.level_labels
    m = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(lab), F.lit(i))])
    return m[col(c)]


def annualised_growth(start, end, months) -> Column:
    """(end - start) * 12 / months, NULL when months <= 0."""
    m = col(months).cast("double")
    return F.when(m > 0, (col(end) - col(start)) * 12.0 / m)


def latest_order_key(date_col, tiebreak_col=None) -> Column:
    """Fixed-width ordering key for "latest record" picks: the day, then the
    tie-break, in one number: unix_date * 2^64 + tie-break, as decimal(38). Any
    long may break ties (a missing one counts as 0). Decimals are mutable in a
    row's buffer, so ``max_by`` stays a hash aggregate (a struct ordering forces
    a sort-based one, i.e. a map-side sort of every row)."""
    day = F.unix_date(col(date_col)).cast("long")
    if tiebreak_col is None:
        return day
    tb = F.coalesce(col(tiebreak_col).cast("long"), F.lit(0)).cast("decimal(20)")
    return (day.cast("decimal(10)") * F.lit(str(1 << 64)).cast("decimal(20)") + tb).cast("decimal(38)")
