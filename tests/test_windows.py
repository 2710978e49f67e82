import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridwright.operators import quality as Q
from gridwright.operators import windows as W

S = W.Series(("id",), "t", ("n",))


@pytest.fixture(scope="module")
def rows():
    """One long series with gaps, ties, nulls and dense stretches; a short one; one without an id."""
    rnd = random.Random(3)
    out, t = [], datetime(2024, 1, 1)
    for n in range(900):
        t += timedelta(minutes=rnd.choice([0, 1, 10, 10, 10, 600]) if n < 500 else 1)
        value = None if rnd.random() < 0.15 else round(rnd.uniform(0, 3))
        out.append(("long", t, n, None if value is None else float(value)))
    out += [("short", datetime(2024, 1, 1) + timedelta(hours=n), n, float(n)) for n in range(5)]
    out += [(None, datetime(2024, 1, 1) + timedelta(hours=n % 7), n, float(n % 3)) for n in range(60)]
    rnd.shuffle(out)
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, t timestamp, n int, v double").repartition(5)


def grouped(rows):
    series = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        series.setdefault(row[0], []).append(row)
    return series


def features(d, w):
    return d.withColumns({
        **W.lag_columns("v", [1, 7], w), **W.rolling_columns("v", [3, 6], w, 3), "f": W.filled("v", 2, w)})


def expected(rows):
    out = {}
    for key, series in grouped(rows).items():
        values = [r[3] for r in series]
        for i, r in enumerate(series):
            def back(k):
                return values[i - k] if i >= k else None

            def roll(width, fn):
                frame = values[max(0, i - width):i]
                full = len(frame) == width and None not in frame
                return round(fn(frame), 9) if full else None

            fill = next((v for v in reversed(values[max(0, i - 2):i + 1]) if v is not None), None)
            out[key, r[2]] = (back(1), back(7), roll(3, statistics.fmean), roll(3, statistics.stdev),
                              roll(6, statistics.fmean), fill)
    return out


@pytest.mark.parametrize("max_rows", [10_000, 200, 50, 8])
def test_windows_equal_brute_force_however_a_series_is_cut(frame, rows, max_rows):
    out = W.over_series(frame, S, features, reach=7, max_rows=max_rows).collect()
    got = {
        (r.id, r.n): tuple(None if x is None else round(x, 9) for x in (
            r.v_lag1, r.v_lag7, r.v_roll_mean_3, r.v_roll_std_3, r.v_roll_mean_6, r.f))
        for r in out
    }
    assert len(out) == len(rows)
    assert got == expected(rows)


@pytest.mark.parametrize("max_rows", [10_000, 60, 9])
def test_targets_look_ahead(frame, rows, max_rows):
    out = W.targets_long(frame, S, "v", [1, 5], max_rows=max_rows).collect()
    want = set()
    for series in grouped(rows).values():
        for i, r in enumerate(series):
            for h in (1, 5):
                if i + h < len(series) and series[i + h][3] is not None:
                    want.add((r[0], r[2], h, series[i + h][3]))
    assert {(r.id, r.n, r.horizon, r.target) for r in out} == want
    assert len(out) == len(want)


def test_a_long_series_is_spread_over_chunks(frame):
    sizes = {}

    def add(d, w):
        return d.withColumn("_seen", F.count("*").over(w.rowsBetween(-(10**6), 10**6))).withColumn(
            "chunk", F.col("_chunk"))

    for r in W.over_series(frame, S, add, reach=3, max_rows=50).where("id = 'long'").collect():
        sizes[r.chunk] = r["_seen"]
    assert len(sizes) >= 10
    assert max(sizes.values()) < 300


def test_nested_windows_survive_the_cut(spark, ts):
    values = [1.0] * 40 + [float(i) for i in range(40)] + [5.0] * 7
    df = spark.createDataFrame(
        [("a", ts(i), v, 7.0 + i, 1.0 * i, 0) for i, v in enumerate(values)],
        "turbine_id string, timestamp_utc timestamp, wind_speed_ms double, active_power_kw double, "
        "pitch_angle_deg double, qc_flag int")
    series = W.Series(("turbine_id",))
    whole = Q.flag_frozen(df, series).orderBy("timestamp_utc").collect()
    cut = Q.flag_frozen(df, series, max_rows=10).orderBy("timestamp_utc").collect()
    assert [r.qc_flag for r in whole] == [r.qc_flag for r in cut]
    assert [i for i, r in enumerate(whole) if r.qc_flag] == [*range(6, 40), 86]


def test_result_does_not_depend_on_row_order_or_partitions(frame):
    key = ["id", "t", "n"]
    a = W.over_series(frame, S, features, 7).orderBy(*key).collect()
    b = W.over_series(frame.repartition(13, "v").orderBy(F.desc("v")), S, features, 7).orderBy(*key).collect()
    assert a == b


def test_no_feature_reads_the_present_or_future(frame):
    """Changing all values from some row on leaves that row's lags and rolling values as they were."""
    edge = datetime(2024, 1, 6)
    later = F.col("t") >= F.lit(edge)
    changed = frame.withColumn("v", F.when(later, F.lit(999.0)).otherwise(F.col("v")))
    cols = ["id", "n", "v_lag1", "v_lag7", "v_roll_mean_3", "v_roll_std_3", "v_roll_mean_6"]
    before = W.over_series(frame, S, features, 7)
    after = W.over_series(changed, S, features, 7)
    past = before.where(F.col("t") < edge).select(cols)
    assert past.exceptAll(after.where(F.col("t") < edge).select(cols)).count() == 0


def test_lag_and_rolling_share_one_sort(spark, frame):
    plan = W.over_series(frame, S, features, 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
    assert plan.count("Exchange hashpartitioning(id") == 1


def test_targets_stay_inside_the_split(spark, ts):
    df = spark.createDataFrame(
        [("a", ts(i), "train" if i < 3 else "val", float(i)) for i in range(6)],
        "id string, t timestamp, split string, v double")
    out = W.add_targets(df, W.Series(("split", "id"), "t"), "v", [1]).orderBy("t").collect()
    assert [r.target_h1 for r in out] == [1.0, 2.0, None, 4.0, 5.0, None]


def test_rows_of_one_time_are_cut_by_their_ties(spark):
    at = datetime(2021, 1, 1)
    rows = [("a", at, n * 7 % 2003, float(n)) for n in range(2000)] + [("b", at, 1, 0.0)]
    df = spark.createDataFrame(rows, "id string, ts timestamp, event_id long, v double")
    series = W.Series(("id",), "ts", ("event_id",))
    whole = W.add_lags(df, series, "v", [1, 3]).collect()
    sizes = []

    def add(frame, window):
        sizes.append({r["count"] for r in frame.groupBy("id", "_chunk").count().collect()})
        return frame.withColumns(W.lag_columns("v", [1, 3], window))

    cut = W.over_series(df, series, add, 3, max_rows=100).collect()
    assert sorted(map(str, cut)) == sorted(map(str, whole))
    assert max(sizes[0]) <= 2 * 100 + 3 and len(whole) == 2001


def test_rows_without_an_order_are_refused(spark):
    rows = [("a", datetime(2021, 1, 1), float(n)) for n in range(300)]
    df = spark.createDataFrame(rows, "id string, ts timestamp, v double")
    with pytest.raises(ValueError, match="tie-breaking"):
        W.add_lags(df, W.Series(("id",), "ts"), "v", [1], max_rows=50)
