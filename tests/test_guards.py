"""Guards that ride on other jobs, and the fingerprint of a frame."""

import pytest
from pyspark.sql import functions as F

from loadlab.operators import contracts as CT
from loadlab.operators import guards as GU


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([("2001-02-03", "1.5", 2.0), ("2001-02-30", "x", None), (None, "inf", float("nan"))], "d string, x string, y double")


def test_faults_are_raised_after_the_job(rows, tmp_path):
    with pytest.raises(ValueError, match=r"d: no date \(2\); x: no finite number \(2\); y: null \(2\)"):
        with GU.Guards() as g:
            watched = g.watch(rows, GU.unreadable_dates("d"), GU.not_numbers("x"), GU.nulls(["y"]))
            watched.write.parquet(str(tmp_path / "out"))
    assert (tmp_path / "out").exists()
    with GU.Guards() as g:
        assert g.watch(rows.limit(1), GU.unreadable_dates("d"), GU.not_numbers("x"), GU.nulls(["y"])).count() == 1


def test_a_guard_runs_no_job_of_its_own(spark, rows):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("guarded", "one job")
    with pytest.raises(ValueError, match="x: not found"):
        with GU.Guards() as g:
            g.watch(rows.withColumn("x", F.when(F.col("x") != "x", F.col("x"))), GU.unmatched(["x"])).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("other", "")
    assert len(tracker.getJobIdsForGroup("guarded")) == 1


def test_empty_side_of_the_split(spark):
    df = spark.createDataFrame([("2000-01-01",), ("2000-02-01",)], "date string").select(F.col("date").cast("date"))
    with pytest.raises(ValueError, match="holdout: empty"):
        with GU.Guards() as g:
            g.watch(df, GU.split_sides()).count()


def test_a_frame_that_is_never_read(rows, monkeypatch):
    monkeypatch.setattr(GU, "WAIT", 0.5)
    with pytest.raises(RuntimeError, match="no job"):
        with GU.Guards() as g:
            g.watch(rows, GU.nulls(["y"]))


def test_fingerprint_tells_frames_apart(spark):
    rows = [(1, "a", None), (2, None, "a"), (2, None, "a"), (3, "b", "c")]
    same = lambda x, y: CT.compare_rows(*(spark.createDataFrame(r, "i int, p string, q string") for r in (x, y))).first()["same"]
    assert same(rows, rows[::-1]) and same([], [])
    assert not same(rows, rows[:-1])
    assert not same(rows, [(1, None, "a"), *rows[1:]])  # a null in the other column
    assert not same(rows, [rows[0], rows[0], *rows[2:]])  # the same rows, other counts
    df = spark.createDataFrame(rows, "i int, p string, q string")
    plan = CT.compare_rows(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    with pytest.raises(ValueError, match="differ"):
        CT.assert_same_rows(df, df.limit(2))
    with pytest.raises(ValueError, match="columns differ"):
        CT.compare_rows(df, df.drop("q"))
