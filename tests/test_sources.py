import io
import pickle
import zipfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridwright.schemas import schema_errors
from gridwright.sources import archives
from gridwright.sources import ingest as I
from gridwright.sources.archives import archive_problems, member_lines, write_members
from gridwright.sources.delimited import Format, read_delimited
from gridwright.sources.files import open_input
from gridwright.sources.scan import scan_csv, write_csv_report, write_partitioned

HEADER = ("# Date and time,Wind speed (m/s),Wind direction (°),Power (kW),Nacelle position (°),Rotor speed (RPM),"
          "Blade angle (pitch position) A (°),Blade angle (pitch position) B (°),Blade angle (pitch position) C (°),"
          "Nacelle ambient temperature (°C),Nacelle temperature (°C)")
COMMENTS = [f"# note {i}" for i in range(9)]


def turbine_csv(n=10, power=1500.0, comments=True, availability=None):
    lines = (COMMENTS if comments else []) + [HEADER + (",Data Availability" if availability else "")]
    for i in range(n):
        cells = [f"2021-01-01 00:{i}0:00" if i < 6 else f"2021-01-01 01:{i - 6}0:00", "8.5", "NaN" if i == 1 else "180",
                 str(power + i), "-999", "12", "1.0", "2.0" if i else "", "6.0", "bad" if i == 2 else "10", "25"]
        lines.append(",".join(cells + ([availability[i]] if availability else [])))
    return "\n".join(lines) + "\n"


def name(n, tail="2021-01-01"):
    return f"Turbine_Data_Kelmarsh_{n}_{tail}.csv"


def test_turbine_folder(spark, tmp_path):
    (tmp_path / name(1)).write_text(turbine_csv())
    (tmp_path / name(2)).write_text(turbine_csv(5, power=100.0, comments=False, availability=["1", "0", "NA", "x", "0.0"]))
    (tmp_path / name(1, "2022-01-01")).write_text(turbine_csv(10, power=9999.0))  # same times again
    (tmp_path / "Status_Kelmarsh_1.csv").write_text("# Status\na,b\n")
    df = I.ingest_turbine_csv(spark, str(tmp_path))
    assert schema_errors(df, "wind", strict=True) == []
    rows = {(r.turbine_id, r.timestamp_utc): r for r in df.collect()}
    assert len(rows) == 15 and {k[0] for k in rows} == {"KWF1", "KWF2"}
    first, second, third = (rows["KWF1", datetime(2021, 1, 1, 0, m)] for m in (0, 10, 20))
    assert (first.active_power_kw, first.pitch_angle_deg, first.nacelle_direction_deg) == (1500.0, 3.5, None)
    assert (second.wind_direction_deg, second.pitch_angle_deg, third.ambient_temp_c) == (None, 3.0, None)
    small = [rows["KWF2", datetime(2021, 1, 1, 0, 10 * i)] for i in range(5)]
    assert [r.active_power_kw for r in small] == [600.0, 606.0, 612.0, 618.0, 624.0]
    assert [r.status_code for r in small] == [0, 1, 0, 0, 1]
    assert (first.dataset_id, first.qc_flag, first.is_curtailed) == ("kelmarsh", 0, False)


def test_turbine_number_is_required(spark, tmp_path):
    (tmp_path / "Turbine_Data_Kelmarsh_x.csv").write_text(turbine_csv(2))
    with pytest.raises(Exception, match="no turbine number"):
        I.ingest_turbine_csv(spark, str(tmp_path)).collect()
    with pytest.raises(FileNotFoundError):
        empty = tmp_path / "empty"
        empty.mkdir()
        (empty / "x.csv").write_text("a,b\n")
        I.ingest_turbine_csv(spark, str(empty))


def test_turbine_comes_from_the_file_and_not_its_folder(spark, tmp_path):
    folder = tmp_path / "Kelmarsh_2019"
    folder.mkdir()
    (folder / name(1)).write_text(turbine_csv(3))
    (folder / name(2)).write_text(turbine_csv(3))
    (folder / "Device_Data_Kelmarsh_PMU_2019.csv").write_text(turbine_csv(5))
    df = I.ingest_turbine_csv(spark, str(tmp_path))
    counts = {r.turbine_id: r["count"] for r in df.groupBy("turbine_id").count().collect()}
    assert counts == {"KWF1": 3, "KWF2": 3}


def test_nested_archives(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr(f"deep/{name(3)}", turbine_csv(4))
        z.writestr("Status_Kelmarsh_3.csv", "ignored\n")
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as z:
        z.writestr("2021.zip", inner.getvalue())
        z.writestr(name(4), turbine_csv(3))
    out = write_members(spark, str(tmp_path), str(tmp_path / "text"), I.TURBINE_MEMBER)
    df = I.ingest_turbine_csv(spark, out, "*.txt")
    counts = {r.turbine_id: r["count"] for r in df.groupBy("turbine_id").count().collect()}
    assert counts == {"KWF3": 4, "KWF4": 3}


def packed(files, compression=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", compression) as z:
        for member, content in files.items():
            z.writestr(member, content)
    return out.getvalue()


def members_of(df):
    out = {}
    for r in df.orderBy("member", "number").collect():
        out.setdefault(r.member, []).append(r.line)
    return out


@pytest.mark.parametrize("compression", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_every_member_is_a_partition(spark, tmp_path, compression):
    deep = packed({"c.csv": "5\n"}, zipfile.ZIP_DEFLATED)
    inner = packed({"deep/b.csv": "3\r\n4", "more.zip": deep, "b.txt": "no"}, compression)
    (tmp_path / "a b%é.zip").write_bytes(packed({"a.csv": "1\n2\n\n", "in.zip": inner, "dir/": "", "z.csv": ""}, compression))
    (tmp_path / "other.zip").write_bytes(packed({"d.csv": "é\n"}, compression))
    df = member_lines(spark, str(tmp_path), r"\.csv$")
    assert members_of(df) == {"a.csv": ["1", "2", ""], "in.zip/deep/b.csv": ["3", "4"], "in.zip/more.zip/c.csv": ["5"], "d.csv": ["é"]}
    assert {r.archive.rsplit("/", 1)[-1] for r in df.select("archive").distinct().collect()} == {"a b%é.zip", "other.zip"}
    ends = df.withColumn("part", F.spark_partition_id()).groupBy("member").agg(F.min("part").alias("a"), F.max("part").alias("b")).collect()
    assert all(r.a == r.b for r in ends) and len({r.a for r in ends}) == 4
    # A partition per member, the empty one included, and one for what could not be unpacked, per level.
    assert 5 <= df.rdd.getNumPartitions() <= 5 + 3 * spark.sparkContext.defaultParallelism
    assert archive_problems(spark, str(tmp_path), r"\.csv$").count() == 0


def test_planning_reads_directories_only(tmp_path):
    content = packed({f"m{i}.csv": bytes(500_000) for i in range(4)})
    (tmp_path / "big.zip").write_bytes(content)
    found = list(archives.members(archives.Archive(str(tmp_path / "big.zip"), "big")))
    assert [m.name for m in found] == ["m0.csv", "m1.csv", "m2.csv", "m3.csv"]
    offsets = [m.at for m in found]
    assert offsets == sorted(offsets) and offsets[1] - offsets[0] > 500_000
    again = pickle.loads(pickle.dumps(found[2]))
    with open_input(str(tmp_path / "big.zip")) as handle, archives.open_member(handle, again) as raw:
        assert raw.read() == bytes(500_000)


def test_archive_beyond_two_gigabytes_of_offsets(tmp_path):
    """A sparse file stands in for the bytes before the last member."""
    path = tmp_path / "huge.zip"
    hole = 5 << 30
    tail = packed({"last.csv": "1\n2\n"}, zipfile.ZIP_DEFLATED)
    with open(path, "wb") as out:
        out.seek(hole)
        out.write(tail)
    found = list(archives.members(archives.Archive(str(path), "huge")))
    assert [(m.name, m.at, m.problem) for m in found] == [("last.csv", hole, None)]
    with open_input(str(path)) as handle, archives.open_member(handle, found[0]) as raw:
        assert raw.read() == b"1\n2\n"


def test_damage_costs_only_itself(spark, tmp_path):
    (tmp_path / "good.zip").write_bytes(packed({"g.csv": "1\n"}))
    (tmp_path / "none.zip").write_bytes(b"no archive at all")
    broken = bytearray(packed({"x.csv": "7\n" * 200, "y.csv": "8\n"}, zipfile.ZIP_DEFLATED))
    at = broken.index(b"x.csv") + 5
    broken[at:at + 6] = b"\xff" * 6
    (tmp_path / "half.zip").write_bytes(broken)
    (tmp_path / "odd.zip").write_bytes(packed({"z.csv": b"ok\n\xff\xfe\n", "n.zip": b"not an archive"}, zipfile.ZIP_DEFLATED))
    got = members_of(member_lines(spark, str(tmp_path), r"\.csv$"))
    assert got["g.csv"] == ["1"] and got["y.csv"] == ["8"]
    problems = {r.member: r.problem for r in archive_problems(spark, str(tmp_path), r"\.csv$").collect()}
    assert set(problems) == {"", "x.csv", "z.csv", "n.zip/"}
    assert "BadZipFile" in problems[""] and "UnicodeDecodeError" in problems["z.csv"]


def test_no_archives(spark, tmp_path):
    assert member_lines(spark, str(tmp_path), "x").count() == 0


FORMAT = Format(r"^id,", comment="#")


def test_layouts_travel_with_the_lines(spark, tmp_path):
    (tmp_path / "a 1%é.csv").write_text('# note\nid,x,y\n1,2,3\n2,"4,5",""\n3\n4,"say ""hi""",6,7\n\n# end\n')
    (tmp_path / "b.csv").write_text("id,z,x\r\n5,9,8\r\n,9,1\r\n")
    (tmp_path / "c.csv").write_text("\ufeffid,x\n7,\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "bad.csv").write_text("no,header\n1,2\n")
    (tmp_path / "lacks.csv").write_text("id,q\n1,2\n")
    (tmp_path / "bytes.csv").write_bytes(b"id,x\n8,\xff\xfe\n9,10\n")
    read = read_delimited(spark, str(tmp_path), {"id": "key", "x": "x", "y": "why"}, FORMAT, "*.csv", needed=["id"], any_of=["x", "y"])
    rows = read.rows.orderBy("file_no", "position").collect()
    assert [(r.key, r.x, r.why) for r in rows] == [
        ("1", "2", "3"), ("2", "4,5", None), ("3", None, None), ("4", 'say "hi"', "6"), ("5", "8", None), (None, "1", None),
        ("9", "10", None), ("7", None, None)]
    rejects = sorted((r.file.rsplit("/", 1)[-1], r.bytes, r.reason) for r in read.rejects.collect())
    assert rejects == [
        ("bad.csv", None, "no header"), ("bytes.csv", "382CFFFE", "no UTF-8 text"),
        ("lacks.csv", None, "none of the columns x, y")]
    numbers = [r.file_no for r in read.files.orderBy("file").collect()]
    assert numbers == sorted(set(numbers)) and read.n_files == 6


def test_one_scan_of_the_lines(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.csv").write_text(f"id,{'xyz'[n]}\n1,2\n")
    read = read_delimited(spark, str(tmp_path), {"id": "key", "x": "x", "y": "y", "z": "z"}, FORMAT, "*.csv")
    plan = read.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 1 and "Union" not in plan
    assert sorted((r.x, r.y, r.z) for r in read.rows.na.fill("-").collect()) == [("-", "-", "2"), ("-", "2", "-"), ("2", "-", "-")]


def test_blocks_of_a_large_file_share_its_layout(spark, tmp_path):
    (tmp_path / "long.csv").write_text("id,x\n" + "".join(f"{i},{i * i}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = read_delimited(spark, str(tmp_path), {"x": "x", "id": "id"}, FORMAT, "*.csv").rows
        assert rows.rdd.getNumPartitions() > 8
        assert [(r.id, r.x) for r in rows.orderBy("position").collect()] == [(str(i), str(i * i)) for i in range(20_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_bad_turbine_file_costs_only_itself(spark, tmp_path):
    (tmp_path / name(1)).write_text(turbine_csv(3))
    (tmp_path / name(2)).write_text("# nothing of use\n1,2\n")
    (tmp_path / name(3)).write_text("\n")
    (tmp_path / name(4)).write_bytes(b"")
    rows = I.ingest_turbine_csv(spark, str(tmp_path)).collect()
    assert {r.turbine_id for r in rows} == {"KWF1"} and len(rows) == 3
    rejects = I.read_turbine_csv(spark, str(tmp_path)).rejects.collect()
    assert sorted(r.file.rsplit("/", 1)[-1] for r in rejects) == [name(2), name(3)]


LOAD_HEADER = "Périmètre\tNature\tDate\tHeures\tConsommation\tPrévision J-1\tPrévision J"


def load_tsv(day, clocks):
    lines = [LOAD_HEADER]
    lines += [f"France\tDéfinitives\t{day}\t{c}\t{50000 + 10 * i if i % 2 == 0 else 'ND'}\t{51000 + i}\tDC"
              for i, c in enumerate(clocks)]
    return "\n".join([*lines, "RTE ne pourra être tenu responsable", ""])


def quarters(*hours):
    return [f"{h:02d}:{m:02d}" for h in hours for m in (0, 15, 30, 45)]


def test_load_archive(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "eCO2mix_RTE_Annuel-Definitif_2023.zip", "w") as z:
        z.writestr("eCO2mix_2023.xls", load_tsv("2023-07-01", quarters(0, 1)).encode("latin-1"))
    out = write_members(spark, str(tmp_path), str(tmp_path / "text"), I.LOAD_MEMBER, I.LOAD_ENCODING)
    df = I.ingest_load_tsv(spark, out).orderBy("timestamp_utc")
    assert schema_errors(df, "demand", strict=True) == []
    rows = df.collect()
    assert [r.timestamp_utc for r in rows] == [datetime(2023, 6, 30, 22), datetime(2023, 6, 30, 23)]
    assert [(r.load_mw, r.tso_forecast_mw) for r in rows] == [(50010.0, 51001.5), (50050.0, 51005.5)]
    assert (rows[0].zone_id, rows[0].dataset_id, rows[0].temperature_c) == ("FR", "rte_france", None)


def test_load_clock_changes(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.xls").write_bytes(load_tsv("2023-03-26", quarters(1, 2, 3)).encode("latin-1"))
    (raw / "b.xls").write_bytes(load_tsv("2023-10-29", quarters(1, 2, 2, 3)).encode("latin-1"))
    rows = I.ingest_load_tsv(spark, str(raw), encoding="ISO-8859-1").orderBy("timestamp_utc").collect()
    spring = [r.timestamp_utc.hour for r in rows if r.timestamp_utc.month == 3]
    assert spring == [0, 1]                      # 02:xx does not exist
    autumn = {r.timestamp_utc: r.load_mw for r in rows if r.timestamp_utc.month == 10}
    assert sorted(autumn) == [datetime(2023, 10, 28, 23), datetime(2023, 10, 29, 0), datetime(2023, 10, 29, 2)]
    assert autumn[datetime(2023, 10, 29, 0)] == 50070.0   # both readings of 02:xx, averaged


def test_energy_and_city_weather(spark, tmp_path):
    energy, cities = tmp_path / "energy.csv", tmp_path / "cities.csv"
    energy.write_text("time,total load actual,total load forecast,price day ahead,price actual\n" + "".join(
        f"2015-01-01 0{h}:00:00+01:00,{25000 + h if h != 1 else ''},1,{'NaN' if h == 2 else 50 + h},2\n" for h in range(4)))
    cities.write_text("dt_iso,city_name,temp,pressure,humidity,wind_speed,clouds_all,rain_1h\n" + "".join(
        f"2015-01-01 0{h}:00:00+01:00,{city},{273.15 + t},{p},{60 + t},{w},0,0\n"
        for h in range(3)
        for city, t, p, w in ((" Barcelona", 10, 1200, 3), ("Valencia", 14, 1000, 51), ("Madrid", 6, 1000, 5))))
    df = I.ingest_load_and_weather(spark, str(energy), str(cities)).orderBy("timestamp_utc")
    assert schema_errors(df, "demand", strict=True) == []
    rows = df.collect()
    assert [r.timestamp_utc for r in rows] == [datetime(2014, 12, 31, 23), datetime(2015, 1, 1, 0), datetime(2015, 1, 1, 1)]
    assert [(r.load_mw, r.price_eur_mwh) for r in rows] == [(25000.0, 50.0), (None, 51.0), (25002.0, None)]
    assert rows[0].temperature_c == pytest.approx(10.0) and rows[0].humidity_pct == pytest.approx(70.0)
    assert rows[0].wind_speed_ms == 4.0          # Valencia's 51 is left out


def pv(day, columns="measured_on,ac_power__315,poa_irradiance__313,ambient_temp__320,module_temp_1__321", row=None):
    row = row or (lambda m: f"{day} 12:{m:02d}:00,{-100 if m < 15 else 2000},500,20,30")
    return columns + "\n" + "".join(row(m) + "\n" for m in range(30))


def test_pv_folder(spark, tmp_path):
    (tmp_path / "system_4__date_2020_06_15.csv").write_text(pv("2020-06-15"))
    (tmp_path / "system_4__date_2021_01_15.csv").write_text(pv(
        "2021-01-15", "measured_on,extra,poa_irradiance__313", lambda m: f"2021-01-15 12:{m:02d}:00,9,{m}"))
    (tmp_path / "system_4__date_2021_01_16.csv").write_text("time,x\n2021-01-16 12:00:00,1\n")
    (tmp_path / "system_5__date_2020_06_15.csv").write_text(pv("2020-06-15"))
    df = I.ingest_pv_csv(spark, str(tmp_path))
    assert schema_errors(df, "solar", strict=True) == []
    rows = {r.timestamp_utc: r for r in df.collect()}
    assert sorted(rows) == [datetime(2020, 6, 15, 18), datetime(2020, 6, 15, 18, 15),
                            datetime(2021, 1, 15, 19), datetime(2021, 1, 15, 19, 15)]
    assert [rows[t].power_kw for t in sorted(rows)] == [0.0, 2.0, None, None]
    assert rows[datetime(2021, 1, 15, 19)].poa_wm2 == 7.0
    assert I.ingest_pv_csv(spark, str(tmp_path), year=2020).count() == 2
    with pytest.raises(FileNotFoundError):
        I.ingest_pv_csv(spark, str(tmp_path), year=1999)


def test_scan_and_sinks(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\nNA,1.5\nx,oops\n,NaN\n")
    rows = scan_csv(spark, str(tmp_path / "in.csv"), numbers=("b",)).collect()
    assert [(r.a, r.b) for r in rows] == [(None, 1.5), ("x", None), (None, None)]
    df = spark.createDataFrame([("t1", 1), ("t2", 2), ("t1", 3)], "turbine_id string, v int")
    write_partitioned(df, str(tmp_path / "out"), "turbine_id")
    assert {p.name for p in Path(tmp_path / "out").iterdir() if p.is_dir()} == {"turbine_id=t1", "turbine_id=t2"}
    assert all("zstd" in p.name for p in Path(tmp_path / "out").rglob("*.parquet"))
    write_csv_report(df, str(tmp_path / "report"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "report")).count() == 3
