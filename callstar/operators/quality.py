"""Row validation with reject routing.

Rules are data: a list of ``(flag_name, Column)``. A row is ``OK`` only
when every flag is TRUE; a NULL flag rejects (Kleene AND inside ``when``).
Everything is a projection on the input, so validation adds no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERDICT = "flag_qualidade"
OK = "OK"
ERROR = "ERRO"


@dataclass(frozen=True)
class Rule:
    flag: str
    check: Column
    label: str = ""


def as_rules(rules) -> list[Rule]:
    """Accept ``Rule`` objects or ``(flag, check[, label])`` tuples."""
    return [r if isinstance(r, Rule) else Rule(*r) for r in rules]


def verdict(flags: list[str]) -> Column:
    cond = None
    for f in flags:
        cond = F.col(f) if cond is None else (cond & F.col(f))
    return F.when(cond, F.lit(OK)).otherwise(F.lit(ERROR))


def validate(df: DataFrame, rules, verdict_col: str = VERDICT) -> DataFrame:
    """Append one boolean column per rule plus the OK/ERRO verdict."""
    rules = as_rules(rules)
    flagged = df.select("*", *[r.check.alias(r.flag) for r in rules])
    return flagged.withColumn(verdict_col, verdict([r.flag for r in rules]))


def rejection_text(rules, sep: str = "; ") -> Column:
    """Labels of every failing (FALSE or NULL) flag, joined by ``sep``."""
    rules = as_rules(rules)
    return F.concat_ws(sep, *[
        F.when(~F.coalesce(F.col(r.flag), F.lit(False)), F.lit(r.label or r.flag))
        for r in rules])


def first_failure(rules, none: str = "none") -> Column:
    """Label of the first failing rule, in rule order (for histograms)."""
    rules = as_rules(rules)
    expr = None
    for r in rules:
        failed = ~F.coalesce(F.col(r.flag), F.lit(False))
        lab = F.lit(r.label or r.flag)
        expr = F.when(failed, lab) if expr is None else expr.when(failed, lab)
    return expr.otherwise(F.lit(none))


def split(flagged: DataFrame, verdict_col: str = VERDICT) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected). Materialise ``flagged`` first when both are written."""
    return (flagged.filter(F.col(verdict_col) == OK),
            flagged.filter(F.col(verdict_col) != OK))


def verdict_counts(flagged: DataFrame, table: str, verdict_col: str = VERDICT) -> DataFrame:
    """One pass: total / valid / rejected counts for a flagged frame."""
    return flagged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(verdict_col) == OK).alias("valid_rows"),
        F.count_if(F.col(verdict_col) != OK).alias("rejected_rows"),
    ).select(F.lit(table).alias("table_name"), "*")
