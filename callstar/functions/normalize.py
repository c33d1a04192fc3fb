"""Column factories for dirty-text repair.

Each function takes and returns a ``Column`` built only from Spark
built-ins, so every normaliser stays inside whole-stage codegen and can be
folded by Catalyst into the projection that uses it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from callstar.functions import rules as R


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fold(col, folds, prepare=None) -> Column:
    """Ordered regex correction fold: each rule sees the previous output."""
    def step(acc, rule):
        pattern, repl = rule
        acc = prepare(acc) if prepare is not None else acc
        return F.regexp_replace(acc, pattern, repl)
    return reduce(step, folds, _c(col))


def clean_upper(col) -> Column:
    return F.upper(F.trim(_c(col)))


def canonical_channel(col, folds=R.CHANNEL_FOLDS) -> Column:
    """upper(trim()) then the ordered channel folds (re-trimmed before each)."""
    return clean_upper(fold(col, folds, prepare=clean_upper))


def repair_reason(col, folds=R.REASON_FOLDS + R.ENGLISH_REASON_FOLDS) -> Column:
    return fold(col, folds)


def text_key(col) -> Column:
    """Join key for case/padding-insensitive text lookups."""
    return F.lower(F.trim(_c(col)))


def strip_email_alias(col) -> Column:
    return F.regexp_replace(_c(col), R.EMAIL_ALIAS, "@")


def money(col, tokens=R.MONEY_TOKENS, to=R.MONEY_TYPE) -> Column:
    """'R$ 1,50' -> 1.5; unparsable or overflowing text -> NULL."""
    text = F.translate(F.regexp_replace(_c(col), tokens, ""), ",", ".")
    return text.try_cast(to)


def dirty_timestamp(col, noise=R.TS_NOISE, fmt=R.TS_FORMAT) -> Column:
    """Replace separator noise by one space, then parse strictly."""
    return F.try_to_timestamp(F.regexp_replace(_c(col), noise, " "), F.lit(fmt))


def status_flag(col, active=R.STATUS_ACTIVE, inactive=R.STATUS_INACTIVE) -> Column:
    """Typo-tolerant status -> BOOLEAN (inactive tested first; else NULL)."""
    low = F.lower(_c(col))
    return (F.when(low.isin(*inactive), F.lit(False))
             .when(low.isin(*active), F.lit(True)))


def yes_no(col) -> Column:
    word = F.upper(F.regexp_replace(_c(col), R.NO_PATTERN, R.NO_WORD))
    return (F.when(word == R.YES_WORD, F.lit(True))
             .when(word == R.NO_WORD, F.lit(False)))


def category(col, rules=R.CATEGORY_RULES + R.ENGLISH_CATEGORY_RULES, default=R.DEFAULT_CATEGORY) -> Column:
    low = F.lower(_c(col))
    expr = None
    for label, pattern in rules:
        expr = (F.when(low.rlike(pattern), F.lit(label)) if expr is None
                else expr.when(low.rlike(pattern), F.lit(label)))
    return expr.otherwise(F.lit(default))


def criticality(col, mapping=R.CRITICALITY_MAP) -> Column:
    up = clean_upper(col)
    expr = None
    for spelling, canon in mapping:
        expr = (F.when(up == spelling, F.lit(canon)) if expr is None
                else expr.when(up == spelling, F.lit(canon)))
    return expr


def blank_to_null(col) -> Column:
    c = _c(col).cast("string")
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def to_number(col, to: str) -> Column:
    """Blank text becomes NULL, anything else is try-cast (never throws)."""
    return blank_to_null(col).try_cast(to)


def letters_only(col) -> Column:
    return F.upper(F.regexp_replace(_c(col), R.NON_LETTERS, ""))


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (may be negative)."""
    return F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))
