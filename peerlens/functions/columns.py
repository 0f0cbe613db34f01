"""Scalar and aggregate column builders.

Everything here returns a ``Column`` made of built-in functions, so it
stays inside whole-stage codegen and is pushed/pruned by Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def stable_round(x: ColumnOrName, digits: int) -> Column:
    """Round half-up to ``digits`` after first settling the value at 6 places.

    Sums of doubles depend on the order rows arrive in; settling at 6
    decimal places first removes that last-digit noise, so a value that is
    a tie in exact arithmetic (an average of cents, say) rounds the same way
    whatever the partitioning.
    """
    return F.round(F.round(_c(x), 6), digits)


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` that is null, not an error, when ``den`` is 0 or null."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def flag(condition: Column) -> Column:
    """``CASE WHEN cond THEN true ELSE false END``: null counts as false."""
    return F.coalesce(condition, F.lit(False))


def flag_count(*flags: Column) -> Column:
    """Number of set flags, as int."""
    total = F.lit(0)
    for f in flags:
        total = total + f.cast("int")
    return total


def in_text_range(x: ColumnOrName, lo: str, hi: str) -> Column:
    """Inclusive range on text (``YYYY-MM`` months compare as strings).

    Kept on the raw column so the parquet scan receives it as a pushed
    filter.  Text order keeps ``'2022-1'`` and drops ``'2022-12-31'``.
    """
    return _c(x).between(F.lit(lo), F.lit(hi))


def year_of_month(month: ColumnOrName) -> Column:
    """First four characters of a ``YYYY-MM`` text, as int (null if not a number)."""
    return F.substring(_c(month), 1, 4).try_cast("int")


def representative(values: Sequence[str], prefer: Sequence[ColumnOrName] | None = None) -> Column:
    """Deterministic "one representative row" aggregate.

    Returns a struct with the fields ``values`` taken from one and the same input row:
    the row with the smallest ordering key.  The key puts rows whose first
    value is non-null first, then orders by the ``prefer`` columns and the
    values themselves, with explicit null markers so the choice never
    depends on input order, partitioning or null ordering.

    The smallest of the *different* keys of a group: a set per group, combined on the map side, so it holds the combinations
    of attribute values that one group has (a handful; for providers never more than specialties times states), not its
    rows.  A plain minimum of texts would be aggregated by sorting all rows, as text is not updated in place.
    """
    parts: list[Column] = [F.col(values[0]).isNull().alias("_none")]
    for i, x in enumerate(prefer or []):
        parts += [_c(x).isNull().alias(f"_no_preferred{i}"), _c(x).alias(f"_preferred{i}")]
    for v in values:
        parts += [F.col(v).isNull().alias(f"_no_{v}"), F.col(v).alias(v)]
    return F.array_min(F.collect_set(F.struct(*parts)))
