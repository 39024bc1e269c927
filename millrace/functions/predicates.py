"""Row-level quality rules as boolean columns.

A rule may come out TRUE, FALSE or NULL. Only TRUE passes, so the complement of "passes" also
holds the rows whose rule is NULL, which a bare NOT would lose.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named condition. The column is built on use, as it needs a running session."""

    name: str
    condition: Callable[[], Column]

    def __post_init__(self) -> None:
        if "," in self.name:
            raise ValueError(f"a rule's name may not hold a comma: {self.name!r}")


def _bound(value: int | float) -> str:
    return str(int(value)) if float(value).is_integer() else repr(value)


def distinct_names(rules: Sequence[Rule]) -> Sequence[Rule]:
    """The rules as they are; two of one name raise, as their results would share a column."""
    names = [rule.name for rule in rules]
    if repeated := sorted({name for name in names if names.count(name) > 1}):
        raise ValueError(f"rules share a name: {', '.join(repeated)}")
    return rules


def required(column: str) -> Rule:
    return Rule(f"{column}_present", lambda: F.col(column).isNotNull())


def one_of(column: str, values: Sequence[str], name: str | None = None) -> Rule:
    return Rule(name or f"{column}_known", lambda: F.col(column).isin(list(values)))


def at_least(column: str, bound: int | float) -> Rule:
    return Rule(f"{column}_not_below_{_bound(bound)}", lambda: F.col(column) >= F.lit(bound))


def within(column: str, low: int | float, high: int | float) -> Rule:
    return Rule(f"{column}_in_{_bound(low)}_{_bound(high)}", lambda: F.col(column).between(low, high))


def holds(rule: Rule) -> Column:
    return F.coalesce(rule.condition(), F.lit(False))


def all_hold(rules: Sequence[Rule]) -> Column:
    """Three-valued conjunction: one FALSE decides, otherwise one NULL does."""
    return reduce(lambda left, right: left & right, (r.condition() for r in distinct_names(rules)), F.lit(True))


def passes(rules: Sequence[Rule]) -> Column:
    """The conjunction with NULL counted as failed."""
    return F.coalesce(all_hold(rules), F.lit(False))


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, in rule order.

    Joined and split again, as dropping nulls from an array would take the stage out of codegen.
    """
    broken = F.concat_ws(",", *[F.when(~holds(r), F.lit(r.name)) for r in distinct_names(rules)])
    return F.when(broken == "", F.array().cast("array<string>")).otherwise(F.split(broken, ","))
