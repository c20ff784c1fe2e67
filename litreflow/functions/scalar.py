"""Scalar column expressions shared by the marts.

Each function maps one recurring CASE/COALESCE idiom of the marts onto
built-in Spark expressions, keeping the NULL behaviour of the SQL it stands
for (three-valued logic: a NULL comparison takes the ELSE branch).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from litreflow.constants import NIL_GUID


def _c(col) -> Column:
    if isinstance(col, str):
        return F.col(col)
    return col if isinstance(col, Column) else F.lit(col)


def substitute_key(preferred, fallback, nil=NIL_GUID) -> Column:
    """``CASE WHEN preferred <> nil THEN preferred ELSE fallback END``.

    A NULL ``preferred`` also falls back (the comparison is NULL).
    """
    p = _c(preferred)
    return F.when(p != F.lit(nil), p).otherwise(_c(fallback))


def greater_or_second(a, b) -> Column:
    """``CASE WHEN a > b THEN a ELSE b END``.

    Not ``greatest``: that skips NULLs, while here a NULL ``b`` gives NULL
    and a NULL ``a`` gives ``b``.
    """
    a, b = _c(a), _c(b)
    return F.when(a > b, a).otherwise(b)


def zero_fallback(*cols) -> Column:
    """Zero means "not known yet": take the next column.

    ``zero_fallback(final, uplifted, requested)`` is
    ``CASE WHEN final = 0 THEN (CASE WHEN uplifted = 0 THEN requested ELSE
    uplifted END) ELSE final END``. A NULL is not a fallback (it is kept),
    negative values are kept.
    """
    if not cols:
        raise ValueError("zero_fallback needs at least one column")
    head = _c(cols[0])
    if len(cols) == 1:
        return head
    return F.when(head == 0, zero_fallback(*cols[1:])).otherwise(head)


def first_non_null(*cols) -> Column:
    """COALESCE over a price waterfall."""
    return F.coalesce(*[_c(c) for c in cols])


def waterfall(*cols, scale: int = 4) -> Column:
    """``ROUND(COALESCE(c1, c2, ...), scale)``: the first price that is
    known, rounded once (computed once even when shown twice)."""
    return F.round(first_non_null(*cols), scale)


def spread_nulls(key, *salt) -> Column:
    """Join key for a left join whose left key is often NULL.

    A NULL key never matches, but all NULL rows hash to one shuffle
    partition. Here a NULL becomes a marker string made of a hash of ``salt``
    (row columns, so a retried task gives the same value): NULL rows spread
    over all partitions, however many there are. Use with ``& key.isNotNull()`` in the condition: a marker then
    cannot match anything, and results equal the plain join.
    """
    k = _c(key)
    marker = F.xxhash64(*[_c(c) for c in salt]).cast("string")
    return F.coalesce(k.cast("string"), F.concat(F.lit("\u0000null:"), marker))


def spread_null_ids(key, *salt) -> Column:
    """``spread_nulls`` for whole-number keys: a NULL becomes a hash of ``salt``,
    a number too, so the join sorts and sends numbers, not strings. The hash may
    be some row's key: only the condition ``key.isNotNull()`` keeps it apart."""
    return F.coalesce(_c(key), F.xxhash64(*[_c(c) for c in salt]))


def flag_is_false(col) -> Column:
    """``flag = False``: NULL flags are dropped like in SQL."""
    return _c(col) == F.lit(False)


def is_after(col, value: str, inclusive: bool = True,
             data_type: str = "timestamp_ntz") -> Column:
    """Date lower bound with a literal; strict and non-strict differ."""
    bound = F.lit(value).cast(data_type)
    return _c(col) >= bound if inclusive else _c(col) > bound


def snap_to_day(ts, shift_hours: int = 1) -> Column:
    """``CAST(DATE(DATETIME_ADD(ts, INTERVAL n HOUR)) AS DATETIME)``:
    midnight of the day the shifted instant falls on."""
    shifted = _c(ts) + F.expr(f"INTERVAL {int(shift_hours)} HOURS")
    return F.to_date(shifted).cast("timestamp_ntz")


def end_of_snapped_day(ts, shift_hours: int = 1) -> Column:
    """Midnight of (ts + n hours), minus one second."""
    return snap_to_day(ts, shift_hours) - F.expr("INTERVAL 1 SECOND")


def calendar_day_diff(end, start) -> Column:
    """Number of calendar-day boundaries from ``start`` to ``end``.

    ``datediff`` works on the dates, so 23:00 -> 01:00 next day is 1 (a
    24-hour count would give 0).
    """
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def half_up_ratio(num, den, scale: int) -> Column:
    """``ROUND(num / den, scale)`` with exact decimal half-up rounding.

    ``num`` and ``den`` are integers (e.g. cents and litres). The quotient is
    rounded with integer arithmetic, so the result does not depend on how a
    double happens to represent a tie such as 1.0005.
    Returns ``decimal(18, scale)``; NULL when ``den`` is 0 or NULL.
    """
    n = _c(num).cast("long")
    den_l = _c(den).cast("long")
    d = F.when(den_l != 0, den_l)  # 0 -> NULL, so no division by zero
    factor = 10 ** scale
    x = F.abs(n) * F.lit(2 * factor) + F.abs(d)
    y = F.abs(d) * F.lit(2)
    mag = F.call_function("div", x, y)  # integral division of longs
    signed = F.when((n < 0) != (d < 0), -mag).otherwise(mag)
    unit = F.lit(Decimal(1).scaleb(-scale)) if scale > 0 else F.lit(Decimal(1))
    value = (signed.cast("decimal(18,0)") * unit).cast(f"decimal(18,{scale})")
    return value
