"""Tables that change in one step, and rebuilding of the days that changed."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from litreflow.sinks import live, merge_by_partition_rewrite, rebuild_changed_days
from litreflow.sinks.digests import changed_days, day_digests

SCHEMA = "id int, day date, v int"


def _day(month, day):
    return dt.date(2024, month, day)


def _rows(df):
    return sorted((tuple(r) for r in df.select("id", "day", "v").collect()), key=repr)


def _merge(spark, path, rows, **kw):
    return merge_by_partition_rewrite(spark, lambda mark: spark.createDataFrame(rows, SCHEMA), path, ["id", "day"], "day",
                                      atomic=True, **kw)


FIRST = [(1, _day(1, 5), 1), (2, _day(2, 5), 1), (3, _day(3, 5), 1)]


def test_merge_changes_all_months_at_once(spark, tmp_path):
    path = str(tmp_path)
    assert _merge(spark, path, FIRST).mode == "full"
    old = live.read_live(spark, path)
    done = _merge(spark, path, [(1, _day(1, 5), 2), (3, _day(3, 5), 2), (4, _day(3, 6), 2), (5, None, 9)])
    assert done.mode == "incremental" and done.touched_partitions == ["2024-01", "2024-03", None]
    want = [(1, _day(1, 5), 2), (2, _day(2, 5), 1), (3, _day(3, 5), 2), (4, _day(3, 6), 2), (5, None, 9)]
    assert _rows(live.read_live(spark, path)) == sorted(want, key=repr)
    # a reader that began before still reads the old version, whole
    assert _rows(old) == sorted(FIRST, key=repr)
    assert _rows(live.read_live(spark, path, version=0)) == sorted(FIRST, key=repr)
    # the untouched month was not written again
    a, b = live.snapshot(spark, path, 0), live.snapshot(spark, path)
    assert a.folders["month=2024-02"] == b.folders["month=2024-02"]
    assert a.folders["month=2024-01"] != b.folders["month=2024-01"]


def test_a_job_that_fails_between_two_months_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path)
    _merge(spark, path, FIRST)

    def build(mark):
        # January can be written, March fails while it is written
        bad = F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
        rows = spark.createDataFrame([(1, _day(1, 5), 7), (3, _day(3, 5), 7)], SCHEMA)
        return rows.select("id", "day", bad.cast("int").alias("v"))

    with pytest.raises(Exception, match="lost"):
        merge_by_partition_rewrite(spark, build, path, ["id", "day"], "day", atomic=True)
    assert _rows(live.read_live(spark, path)) == sorted(FIRST, key=repr)

    # and one that fails after all files are written, before the switch
    held, publish = live.snapshot(spark, path), live.publish
    try:
        live.publish = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost"))
        with pytest.raises(RuntimeError, match="driver lost"):
            _merge(spark, path, [(1, _day(1, 5), 7), (3, _day(3, 5), 7)])
    finally:
        live.publish = publish
    assert live.snapshot(spark, path) == held
    assert _rows(live.read_live(spark, path)) == sorted(FIRST, key=repr)
    # what the failed jobs left is not part of the table and can be removed
    gone = live.remove_unused(spark, path)
    assert gone and _rows(live.read_live(spark, path)) == sorted(FIRST, key=repr)


def test_of_two_writers_one_gets_an_error(spark, tmp_path):
    path = str(tmp_path)
    _merge(spark, path, FIRST)
    held = live.snapshot(spark, path)
    live.publish(spark, path, held, held.schema, [], {})
    with pytest.raises(live.ConcurrentChange):
        live.publish(spark, path, held, held.schema, None, {})
    assert _rows(live.read_live(spark, path)) == sorted(FIRST, key=repr)


def test_old_generations_are_removed_and_a_view_follows(spark, tmp_path):
    path = str(tmp_path)
    for v in range(4):
        _merge(spark, path, [(i, d, v) for i, d, _ in FIRST])
    name = live.register_live(spark, "live_test", "mart", path)
    assert _rows(spark.table(name)) == _rows(live.read_live(spark, path))
    assert spark.table(name).schema["month"].dataType.simpleString() == "string"
    live.remove_unused(spark, path, keep=1)
    assert live.versions(spark, path) == [3]
    assert {r.v for r in live.read_live(spark, path).collect()} == {3}
    _merge(spark, path, [(9, _day(3, 9), 9)])
    assert len(_rows(spark.table(name))) == 3   # one version, until it is replaced in one step
    live.register_live(spark, "live_test", "mart", path)
    assert _rows(spark.table(name)) == _rows(live.read_live(spark, path)) and len(_rows(spark.table(name))) == 4


def test_digests_see_every_change_and_no_order(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([_day(1, d) for d in range(1, 9)] + [None]), rng.choice([None, *range(4)])) for i in range(200)]
    columns = ["id", "day", "v"]

    def digests(x, parts=3):
        return day_digests(spark.createDataFrame(x, SCHEMA).repartition(parts), F.col("day"), columns)

    def differ(x):
        return sorted((r.day for r in changed_days(digests(rows), digests(x, 5)).collect()), key=repr)

    shuffled = rows[:]
    rng.shuffle(shuffled)
    assert differ(shuffled) == []
    for i in rng.sample(range(200), 6):
        day = rows[i][1]
        assert differ(rows[:i] + rows[i + 1:]) == [day]                                   # deleted
        assert differ(rows + [rows[i]]) == [day]                                          # repeated
        assert differ(rows + [rows[i]] * 2) == [day]                                      # twice: the xor is the same
        other = (rows[i][0], day, 9 if rows[i][2] is None else None)
        assert differ(rows[:i] + [other] + rows[i + 1:]) == [day]                         # changed
    a = spark.createDataFrame([(None, _day(1, 1), 5)], SCHEMA)
    b = spark.createDataFrame([(5, _day(1, 1), None)], SCHEMA)
    one, two = (day_digests(x, F.col("day"), columns) for x in (a, b))
    assert changed_days(one, two).count() == 1                                            # a null counts where it is


def _source(spark, folder):
    return spark.read.schema(SCHEMA + ", part int").parquet(folder)


def test_only_changed_days_are_rebuilt_however_old(spark, tmp_path):
    folder, target = f"{tmp_path}/source", f"{tmp_path}/target"
    asked = []

    def put(rows):  # one file for each day's last digit
        df = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.coalesce(F.dayofmonth("day") % 10, F.lit(0)))
        (df.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("part").parquet(folder))

    def run(**kw):
        def build(days):
            asked.append(days)
            rows = _source(spark, folder).groupBy("id", "day").agg(F.sum("v").alias("v"))
            if days is None:
                return rows
            known = [d for d in days if d is not None]
            return rows.filter(F.col("day").isin(known) | (F.col("day").isNull() & F.lit(None in days)))
        return rebuild_changed_days(spark, _source(spark, folder), F.col("day"), build, target, ["id", "day"], "day",
                                    columns=["id", "day", "v"], **kw)

    def check():
        want = _source(spark, folder).groupBy("id", "day").agg(F.sum("v").alias("v"))
        assert _rows(live.read_live(spark, target)) == _rows(want)

    rows = [(i, _day(m, d), i + d) for i in range(3) for m in (1, 2, 3) for d in range(1, 10)] + [(1, None, 4)]
    put(rows)
    assert run().mode == "full"
    check()
    # nothing happened: no file is read again, nothing is rebuilt
    same = run()
    assert (same.mode, same.days, same.files_read) == ("days", [], 0)
    check()
    # old rows added, changed and deleted; one file written again as it was
    put([r for r in rows if r[1] and r[1].day == 4])
    part3 = [r for r in rows if r[1] and r[1].day == 3]
    put([(i, d, v + 1 if d == _day(1, 3) else v) for i, d, v in part3 if not (i == 2 and d == _day(2, 3))])
    put([r for r in rows if r[1] and r[1].day == 7] + [(8, _day(3, 7), 8), (8, _day(4, 7), 8)])
    before = live.snapshot(spark, target)
    done = run()
    assert done.days == [_day(1, 3), _day(2, 3), _day(3, 7), _day(4, 7)] and done.files_read == 3
    assert asked[-1] == done.days
    check()
    # rows without a day, and a day of which no row is left
    put([r for r in rows if r[1] and r[1].day == 10] + [(1, None, 5), (2, None, 6)])
    put([r for r in rows if r[1] and r[1].day == 9 and r[1].month != 2])
    done = run()
    assert done.days == [_day(2, 9), None]
    check()
    # months without a changed day keep their files
    after = live.snapshot(spark, target)
    assert after.folders["month=2024-03"] == live.snapshot(spark, target, done.version - 1).folders["month=2024-03"]
    assert after.folders["month=2024-01"] != before.folders["month=2024-01"]
    assert run(full=True).mode == "full"
    check()


def test_repeated_keys_of_a_day_are_an_error_and_change_nothing(spark, tmp_path):
    folder, target = f"{tmp_path}/source", f"{tmp_path}/target"

    def run(build):
        return rebuild_changed_days(spark, spark.read.schema(SCHEMA).parquet(folder), F.col("day"), build, target,
                                    ["id", "day"], "day")

    spark.createDataFrame(FIRST, SCHEMA).write.parquet(folder)
    run(lambda days: spark.createDataFrame(FIRST, SCHEMA))
    spark.createDataFrame([(1, _day(1, 5), 3)], SCHEMA).write.mode("append").parquet(folder)
    with pytest.raises(Exception, match="several rows for one key"):
        run(lambda days: spark.createDataFrame([(1, _day(1, 5), 3)] * 2, SCHEMA))
    assert _rows(live.read_live(spark, target)) == sorted(FIRST, key=repr)


def test_late_rows_rebuild_their_days_only(spark):
    import duckdb
    from conftest import SF_SMALL
    from litreflow.plans import late_rows
    target, first, second = late_rows.repaired(spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{SF_SMALL}/lineitem.parquet')")
    want = sorted(r[0] for r in con.execute(late_rows.LATE_DAYS_SQL).fetchall())
    assert first.mode == "full" and second.mode == "days"
    assert second.days == want and want
    # the years that were not written again are not read again
    years = len({p.split("year=")[1][:4] for p in spark.read.parquet(target.replace("daily_quantity", "source")).inputFiles()})
    assert second.files_read < first.files_read and years > 2
