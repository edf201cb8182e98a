"""Unicode-aware string helpers as Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: white space as Unicode has it, for Java patterns.
WS = r"[\s\u0085   -     　]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: a lambda's variable stands for it, so that neither the plan nor the
    evaluation repeats it at each use."""
    return F.get(F.transform(F.array(value), body), 0)


def trim_u(c: Column) -> Column:
    """Trims all Unicode white space; Spark's own trim takes spaces only. The end is looked for only where a run begins, so
    long runs inside a text cost no more than their length."""
    return F.regexp_replace(c, f"^{WS}+|(?<!{WS}){WS}+$", "")


def collapse_ws(c: Column) -> Column:
    """Trims and makes each run of white space one space."""
    return F.regexp_replace(trim_u(c), f"{WS}+", " ")


def is_blank(c: Column) -> Column:
    """True for null and for texts of white space only."""
    return F.coalesce(trim_u(c) == "", F.lit(True))
