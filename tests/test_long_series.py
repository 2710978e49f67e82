"""Whole pipelines on the driver tables give the same rows when every series counts as too long."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridwright.catalog import views as V
from gridwright.operators import features as FT
from gridwright.operators import quality as Q
from gridwright.operators import windows as W
from gridwright.session import work_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


def hot(df, column):
    """A third of the rows, and more, move to one series."""
    return df.withColumn(column, F.when(F.pmod(F.hash("timestamp_utc"), F.lit(5)) < 2, "hot").otherwise(F.col(column)))


@pytest.fixture(scope="module")
def tables(spark):
    out = {}
    for name, view, column in (("wind", V.scada, "turbine_id"), ("demand", V.demand, "zone_id"),
                               ("solar", V.solar, "system_id")):
        path = work_path(spark, f"hot-{name}")
        hot(view(spark, SF), column).write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


CASES = {
    "qc_wind": ("wind", lambda d, **k: Q.qc_wind(d, V.RATED_KW, series=V.WIND, **k)),
    "qc_demand": ("demand", lambda d, **k: Q.qc_demand(d, series=V.DEMAND, **k)),
    "qc_solar": ("solar", lambda d, **k: Q.qc_solar(d, series=V.SOLAR, **k)),
    "wind_features": ("wind", lambda d, **k: FT.wind_features(d, "full", series=V.WIND, **k)),
    "demand_features": ("demand", lambda d, **k: FT.demand_features(d, "enriched", V.DEMAND, **k)),
    "demand_exog": ("demand", lambda d, **k: FT.demand_features(d, "full", V.DEMAND, lags=False, **k)),
    "solar_features": ("solar", lambda d, **k: FT.solar_features(d, "full", V.SOLAR, **k)),
    "targets": ("demand", lambda d, **k: W.targets_long(d, V.DEMAND, "load_mw", [1, 48], **k)),
}


@pytest.mark.parametrize("case", CASES)
def test_cutting_changes_nothing(tables, case):
    name, build = CASES[case]
    whole, cut = build(tables[name]), build(tables[name], max_rows=30)
    assert whole.columns == cut.columns
    order = [c for c in ("event_id", "o_orderkey", "horizon") if c in whole.columns]
    assert whole.orderBy(*order).collect() == cut.orderBy(*order).collect()
