"""The consolidation flow on small raw files, against a plain-Python account of it."""

import csv
import json
import statistics

import pytest
from pyspark.sql import functions as F

from panelwright.plans import consolidate as C
from panelwright.plans import read_views as V
from panelwright.sources import lookups as L
from panelwright.sources import tables as T


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")

    def put(name, rows, encoding="utf-8"):
        path = folder / name
        with open(path, "w", newline="", encoding=encoding) as f:
            csv.writer(f).writerows(rows)
        return str(path)

    static = put("static.csv", [
        ["pfaf_id", "name_0", "gid_0", "bws_score", "drr_score", "gtd_score", "iav_score", "bws_raw", "bws_label"],
        [1, "Egypt", "EGY", 6, 2, 9999, 1, 0.5, "High"],
        [2, "Egypt", "EGY", 2, "", 3, 3, 0.7, "High"],
        [3, "France", "FRA", "bad", 1, "", 9999, 9999, "Low"],
        [4, "", "XXX", 1, 1, 1, 1, 1, "Low"],
        [5, "Chad", "TCD", 1, 4, "", 2, 0.1, "Low"],
    ])
    annual = put("annual.csv", [
        ["VarId", "Variable Name", "AreaId", "Area", "YId", "Year", "Value", "Symbol", "Other"],
        [1, "Precipitation in depth", 1, "Egypt", 1, 2000, 10, "", ""],
        [1, "Precipitation in depth", 1, "Egypt", 1, 2000, 99, "", ""],
        [1, "Precipitation in depth", 1, "Egypt", 1, 2004, 30, "", ""],
        [2, "Dependency ratio", 1, "Egypt", 1, 2002, 5, "", ""],
        [1, "Precipitation in depth", 2, "Côte d'Ivoire", 1, 2001, 7, "", ""],
        [1, "Precipitation in depth", 3, "Atlantis", 1, 2001, 7, "", ""],
        [3, "Unrelated", 1, "Egypt", 1, 2001, 7, "", ""],
        [1, "Precipitation in depth", 1, "Egypt", 1, "n/a", 7, "", ""],
    ], "latin-1")
    return static, annual


def test_static(spark, raw):
    text = T.type_numbers(T.read_text_table(spark, "static", raw[0]))
    got = {r["country_code"]: r for r in C.static_indicators(text).collect()}
    assert set(got) == {"EGY", "FRA", "TCD"}
    # bws: Egypt 6 is clipped to 5; France has none, so it takes the median of the filled column 5, 2, 1
    assert got["EGY"]["water_stress_score"] == 3.5 and got["FRA"]["water_stress_score"] == statistics.median([5, 2, 1])
    assert got["EGY"]["drought_risk_score"] == 2.0
    # gtd: Egypt's sentinel takes Egypt's median 3; the others the median of 3, 3
    assert got["EGY"]["groundwater_decline_score"] == 3.0 and got["TCD"]["groundwater_decline_score"] == 3.0
    # renamed column loses its suffix and keeps its sentinel
    assert got["FRA"]["interannual_variability"] == 9999.0
    assert got["EGY"]["source"] == L.STATIC_SOURCE and "pfaf_id" not in got["EGY"].asDict()


def test_annual(spark, raw):
    text = T.read_text_table(spark, "annual", raw[1], T.LATIN1, by_position=L.ANNUAL_COLUMNS, ordinal=True)
    out = C.annual_indicators(text, L.name_codes(spark))
    got = {(r["country_code"], r["year"]): r for r in out.collect()}
    assert set(got) == {("EGY", 2000), ("EGY", 2002), ("EGY", 2004), ("CIV", 2001)}
    assert [got[("EGY", y)]["precipitation_mm"] for y in (2000, 2002, 2004)] == [10.0, 20.0, 30.0]  # first wins, gap filled
    assert [got[("EGY", y)]["dependency_ratio_pct"] for y in (2000, 2002, 2004)] == [5.0, 5.0, 5.0]
    assert got[("CIV", 2001)]["dependency_ratio_pct"] is None
    assert sorted(set(out.columns)) == ["country", "country_code", "dependency_ratio_pct", "precipitation_mm", "source", "year"]


@pytest.fixture(scope="module")
def panel(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("grid") / "grid")
    cells = spark.range(36).select(
        F.expr("make_timestamp(2000 + int(id / 12), int(id % 12) + 1, 15, 0, 0, 0)").alias("time"),
        F.explode(F.array(*[F.struct(F.lit(a).alias("lat"), F.lit(o).alias("lon")) for a in (27.0, 46.0) for o in (2.5, 31.0)]))
        .alias("c"), F.col("id"))
    cells.select("time", "c.lat", "c.lon",
                 F.when(F.col("id") == 3, 1e20).otherwise(F.col("id") * F.col("c.lat") / 10).alias("lwe_thickness"),
                 F.lit(0.5).alias("uncertainty")).write.parquet(path)
    points = L.entity_points(spark).filter(F.col("country_code").isin("EGY", "FRA"))
    static = T.type_numbers(T.read_text_table(spark, "static", raw[0]))
    annual = T.read_text_table(spark, "annual", raw[1], T.LATIN1, by_position=L.ANNUAL_COLUMNS, ordinal=True)
    built = C.build_sources(
        lambda: C.static_indicators(static), lambda: C.annual_indicators(annual, L.name_codes(spark)),
        lambda: C.monthly_anomalies(T.read_grid(spark, "grid", path), points))
    return C.consolidate(*built, require_unique=True).cache()


def test_consolidated(spark, panel):
    rows = panel.orderBy("country_code", "date").collect()
    assert len(rows) == 70 and rows[0]["date"] == "2000-01"
    egypt = [r for r in rows if r["country_code"] == "EGY"]
    assert "2000-04" not in {r["date"] for r in egypt}
    values = [round(i * 2.7, 4) for i in range(36) if i != 3]
    assert [r["tws_anomaly_cm"] for r in egypt] == pytest.approx(values)
    assert egypt[5]["tws_3month_avg"] == pytest.approx(round(sum(values[3:6]) / 3, 4))
    assert egypt[0]["precipitation_mm"] == 10.0 and egypt[13]["precipitation_mm"] is None  # no row for 2001
    assert egypt[0]["season"] == "DJF" and egypt[0]["source"] == L.MONTHLY_SOURCE
    every = sorted(r["tws_anomaly_cm"] for r in rows)
    import numpy as np

    low, high = np.quantile(every, [0.01, 0.99])
    for r in rows:
        norm = min(max(5 * (1 - (r["tws_anomaly_cm"] - low) / (high - low + 1e-8)), 0), 5)
        want = 0.25 * r["water_stress_score"] + 0.25 * r["drought_risk_score"] + 0.3 * norm + 0.2 * r["groundwater_decline_score"]
        assert r["drought_composite_score"] == pytest.approx(want, abs=1e-4)
        s = r["drought_composite_score"]
        assert r["drought_risk_class"] == ("Low" if s < 1 else "Moderate" if s < 2 else "High" if s < 3.5 else "Extreme")
    assert not {"month", "tws_score_norm", "time", "cell_lat"} & set(panel.columns)


def test_read_views(spark, panel):
    assert V.filtered(panel, {"country": []}).count() == 70
    some = V.filtered(panel, {"country": ["Egypt"], "absent": ["x"]}, "date", "2000-02", "2000-05")
    assert sorted(r["date"] for r in some.collect()) == ["2000-02", "2000-03", "2000-05"]
    assert V.filtered(panel, {}, "date", "2000-02", None).count() == 70
    assert V.preview(panel, ["date", "none"], ["country_code", "date"], 3).columns == ["date"]


def test_write_reload_and_run_log(spark, panel, tmp_path):
    path = T.write_table(panel, str(tmp_path / "panel"), ["year"])
    assert T.read_table(spark, "panel", path).count() == 70
    record = T.run_record(panel, {"Forest": {"f1_weighted": 0.5, "accuracy": 0.6}}, {}, at=None)
    T.append_run(record, str(tmp_path / "log"))
    T.append_run(record, str(tmp_path / "log"))
    lines = [json.loads(line) for p in (tmp_path / "log").glob("*.json") for line in p.read_text().splitlines()]
    assert len(lines) == 2 and lines[0]["data_rows"] == 70 and lines[0]["countries"] == 2
    assert lines[0]["date_range"] == "2000-01 to 2002-12"
    assert lines[0]["classification"]["Forest"] == {"f1_weighted": 0.5, "accuracy": 0.6}


def test_missing_input_names_the_table(spark, tmp_path):
    for read in (T.read_table, T.read_text_table, T.read_grid):
        with pytest.raises(FileNotFoundError, match="annual facts not found at"):
            read(spark, "annual facts", str(tmp_path / "none"))


def test_grid_without_uncertainty(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, float("nan"))], "lat double, lon double, lwe_thickness double")
    df.withColumn("time", F.current_timestamp()).write.parquet(str(tmp_path / "g"))
    got = T.read_grid(spark, "grid", str(tmp_path / "g"))
    assert got.columns == ["time", "lat", "lon", "lwe_thickness"] and got.first()["lwe_thickness"] is None


def test_checkpoint_dir_is_required_on_a_cluster(spark, monkeypatch):
    from panelwright import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Session())


def test_lookup_sizes():
    assert len(L.ENTITY_POINTS) == 72 and len({p[0] for p in L.ENTITY_POINTS}) == 72
    assert len(L.NAME_TO_CODE) == 90 and len(set(L.NAME_TO_CODE.values())) == 76
    assert len(L.VARIABLE_KEYWORDS) == 14
