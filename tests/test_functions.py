"""Scalar helpers: NULL behaviour, fallbacks, exact rounding, day snapping."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import ts
from litreflow.constants import NIL_GUID
from litreflow.functions import (
    calendar_day_diff,
    flag_is_false,
    greater_or_second,
    half_up_ratio,
    substitute_key,
    zero_fallback,
)
from litreflow.functions.scalar import end_of_snapped_day, snap_to_day


def test_substitute_key_nil_real_null(spark):
    df = spark.createDataFrame([(NIL_GUID, "c1"), ("p2", "c2"), (None, "c3")], "sp string, c string")
    got = [r[0] for r in df.select(substitute_key("sp", "c")).collect()]
    assert got == ["c1", "p2", "c3"]


def test_flag_is_false_drops_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert df.filter(flag_is_false("f")).count() == 1


def test_greater_or_second_asymmetric_nulls(spark):
    rows = [(5.0, 3.0), (2.0, 3.0), (3.0, 3.0), (None, 3.0), (5.0, None)]
    df = spark.createDataFrame(rows, "calc double, conf double")
    got = [r[0] for r in df.select(greater_or_second("calc", "conf")).collect()]
    # calc > conf -> calc; else conf; calc NULL -> conf; conf NULL -> NULL
    assert got == [5.0, 3.0, 3.0, 3.0, None]


def test_zero_fallback_chain(spark):
    rows = [(0.0, 0.0, 7.0), (0.0, 5.0, 7.0), (4.0, 5.0, 7.0), (None, 5.0, 7.0),
            (-2.0, 5.0, 7.0), (0.0, None, 7.0)]
    df = spark.createDataFrame(rows, "f double, u double, r double")
    got = [r[0] for r in df.select(zero_fallback("f", "u", "r")).collect()]
    # NULL is kept (not a fallback), negatives kept; 0 -> next
    assert got == [7.0, 5.0, 4.0, None, -2.0, None]


def test_half_up_ratio_ties_and_signs(spark):
    rows = [(10005, 10000), (-10005, 10000), (10004, 10000), (1, 3), (2, 3), (5, 0), (7, None)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = [r[0] for r in df.select(half_up_ratio("n", "d", 3)).collect()]
    assert got == [Decimal("1.001"), Decimal("-1.001"), Decimal("1.000"), Decimal("0.333"),
                   Decimal("0.667"), None, None]


def test_snap_to_day_boundaries(spark):
    rows = [(ts("2025-03-01 22:59:59"),), (ts("2025-03-01 23:00:00"),), (ts("2025-03-01 23:30:00"),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = df.select(snap_to_day("t").alias("s"), end_of_snapped_day("t").alias("e")).collect()
    assert [r.s for r in got] == [ts("2025-03-01 00:00:00"), ts("2025-03-02 00:00:00"),
                                  ts("2025-03-02 00:00:00")]
    assert [r.e for r in got] == [ts("2025-02-28 23:59:59"), ts("2025-03-01 23:59:59"),
                                  ts("2025-03-01 23:59:59")]


def test_calendar_day_diff_across_midnight(spark):
    df = spark.createDataFrame([(ts("2025-01-02 01:00:00"), ts("2025-01-01 23:00:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(calendar_day_diff("a", "b")).first()[0] == 1
    assert df.select(F.datediff("a", "b")).first()[0] == 1


def test_half_up_ratio_matches_exact_decimal_rounding(spark):
    import random
    from decimal import ROUND_HALF_UP
    rnd = random.Random(5)
    pairs = []
    for _ in range(3000):
        d = rnd.choice([1, 2, 3, 4, 5, 7, 8, 16, 20, 40, 125, 365000000, rnd.randrange(1, 10**6)])
        n = rnd.randrange(-10**10, 10**10)
        pairs.append((n, d if rnd.random() < 0.9 else -d))
    pairs += [(5, 10), (-5, 10), (15, 1000), (25, 10000), (1, 2000)]   # exact ties
    df = spark.createDataFrame(pairs, "n long, d long")
    for scale in (0, 2, 3, 4):
        got = [r[0] for r in df.select(half_up_ratio("n", "d", scale)).collect()]
        q = Decimal(1).scaleb(-scale)
        want = [(Decimal(n) / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP) for n, d in pairs]
        assert got == want


def test_case_helpers_match_sql_semantics_on_random_rows(spark):
    import random
    rnd = random.Random(9)
    vals = [None, 0.0, -1.5, 2.0, 3.0]
    keys = [None, NIL_GUID, "p1", "p2"]
    rows = [(rnd.choice(vals), rnd.choice(vals), rnd.choice(vals), rnd.choice(keys), "c")
            for _ in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, sp string, cu string")
    got = df.select(greater_or_second("a", "b"), zero_fallback("a", "b", "c"),
                    substitute_key("sp", "cu")).collect()

    def gt(a, b):          # CASE WHEN a > b THEN a ELSE b END (NULL comparison -> ELSE)
        return a if (a is not None and b is not None and a > b) else b

    def zf(*xs):           # CASE WHEN x = 0 THEN <rest> ELSE x END
        return xs[0] if len(xs) == 1 or xs[0] is None or xs[0] != 0 else zf(*xs[1:])

    def sk(sp, cu):        # CASE WHEN sp <> nil THEN sp ELSE cu END
        return sp if (sp is not None and sp != NIL_GUID) else cu

    want = [(gt(a, b), zf(a, b, c), sk(sp, cu)) for a, b, c, sp, cu in rows]
    assert [tuple(r) for r in got] == want
