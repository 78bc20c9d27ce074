import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.twins import make
from tidewell.functions import names as N, scalars as S
from tidewell.operators import request as RQ
from tidewell.plans import recipe, steps
from tidewell.sources import lines as L, shards as SH


def one(spark, c):
    return spark.range(1).select(c.alias("x")).collect()[0].x


def test_names(spark):
    p = lambda n: one(spark, N.parse_name(F.lit(n))).asDict()
    a = p("/x/usgs_anh@north_11303500_flow_2024.csv")
    assert (a["source"], a["station_id"], a["subloc"], a["agency_id"], a["param"], a["year"]) == ("usgs", "anh", "north", "11303500", "flow", "2024")
    b = p("ncro_bac_b95_ec@low_2001_9999.csv")
    assert (b["subloc"], b["modifier"], b["syear"], b["eyear"], b["year"]) == ("default", "low", "2001", "9999", None)
    with pytest.raises(Exception, match="no template"):
        p("nonsense.txt")
    f = {k: F.lit(a[k]) for k in N.FIELDS if a[k] is not None}
    assert one(spark, N.render_name(f)) == "usgs_anh@north_11303500_flow_2024.csv"
    assert one(spark, N.render_name(f, include_shard=False)) == "usgs_anh@north_11303500_flow.csv"
    assert one(spark, N.wildcard_name(F.lit("usgs_anh@north_11303500_flow_2024.csv"))) == "usgs_anh@north_11303500_flow_*.csv"
    key = ("station_id", "subloc", "param")
    assert one(spark, N.series_id({k: F.lit(a[k]) for k in key + ("source",)}, key, "source")) == "usgs|anh|north|flow"


def test_scalars(spark):
    assert one(spark, S.convert_units(F.lit(1.0), "ft^3/s", "m^3/s")) == pytest.approx(0.028316846592)
    assert one(spark, S.fahrenheit_to_celsius(F.lit(212.0))) == 100.0
    with pytest.raises(Exception, match="no conversion"):
        one(spark, S.convert_units(F.lit(1.0), "ft", "deg_c"))
    assert one(spark, S.ec_to_psu_25c(F.lit(53087.0))) == pytest.approx(35.0, abs=0.01)
    with pytest.raises(Exception, match="no depth"):
        one(spark, S.depth_class(F.lit("surface")))
    assert one(spark, S.clean_number(F.lit("0012,345 cfs"))) == 12345.0
    with pytest.raises(ValueError):
        S.add_column(spark.range(1), "id")


HEADERS = {
    "good.csv": ["# format: agency-1.0", "# agency: usgs", "# agency_id: '11335000'", "#", "# original_header: |", "#   a: nested", "datetime,value,user_flag", "2020-01-01 00:00,100.0,0", "2020-01-01 00:15,102.0,1"],
    "indent.csv": ["#   format: agency-1.0", "#   agency: ncro", "datetime,value,user_flag", "2020-01-01 00:00,15.0,0"],
    "prefix.csv": ["#format: agency-1.0", "datetime,value,user_flag", "2020-01-01 00:00,15.0,"],
}


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    d = tmp_path_factory.mktemp("corpus")
    for n, text in HEADERS.items():
        (d / n).write_text("\n".join(text) + "\n")
    return str(d)


def test_headers_and_canonical(spark, corpus):
    h = {r.file: r for r in L.header_catalog(L.read_lines(spark, corpus)).collect()}
    assert h["good.csv"].problem is None and h["good.csv"].header["agency_id"] == "11335000" and "a" not in h["good.csv"].header
    assert h["indent.csv"].problem == "indented_first_key" and h["prefix.csv"].problem == "bad_prefix" and not h["prefix.csv"].header
    rows = L.read_canonical(spark, corpus + "/good.csv").orderBy("ts").collect()
    assert [(str(r.ts), r.value, r.user_flag) for r in rows] == [("2020-01-01 00:00:00", 100.0, "0"), ("2020-01-01 00:15:00", 102.0, "1")]
    lay = {r.file: r.layout for r in L.detect_layout(L.read_lines(spark, corpus)).collect()}
    assert set(lay.values()) == {"screened"}
    d = {(r.file, str(r.ts)): r.value for r in L.read_provider(L.read_lines(spark, corpus)).collect()}
    assert d[("good.csv", "2020-01-01 00:15:00")] is None and d[("prefix.csv", "2020-01-01 00:00:00")] == 15.0


def test_rdb_with_two_sensors(spark, tmp_path):
    (tmp_path / "r.rdb").write_text("# //waterdata.usgs.gov\nagency_cd\tsite_no\tdatetime\ttz_cd\t11_00060\t11_00060_cd\t12_00065\t12_00065_cd\n5s\t15s\t20d\t6s\t14n\t10s\t14n\t10s\n"
                                    "USGS\t1\t2024-11-03 01:30\tPDT\t5\tA\tIce\tP\nUSGS\t1\t2024-11-03 01:30\tPST\t6\tX\t7.5\tP\n")
    lines = L.read_lines(spark, str(tmp_path))
    with pytest.raises(Exception, match="numeric column of r.rdb: Ice"):
        L.read_provider(lines).collect()
    d = {(r.sensor, r.ts.hour): r.value for r in L.read_provider(lines, strict=False).collect()}
    assert d == {("11_00060", 0): 5.0, ("11_00060", 1): None, ("12_00065", 0): None, ("12_00065", 1): 7.5}


def test_shard_store(spark, tmp_path):
    rows = [("s", "flow", pd.Timestamp("2019-12-20") + pd.Timedelta(days=i), 1.0) for i in range(60)]
    d = make(spark, rows, "station string, param string, ts timestamp_ntz, value double")
    path = str(tmp_path / "store")
    meta = make(spark, [(2020,)], "year int")
    with pytest.raises(ValueError, match="no metadata"):
        SH.write_shards(d.unionByName(d.withColumn("ts", F.col("ts") + F.expr("INTERVAL 400 DAYS"))), path, ["station", "param"], year_meta=meta)
    SH.write_shards(d, path, ["station", "param"])  # 12 days of 2019 are too few
    assert [r.shard_year for r in SH.read_shards(spark, path).select("shard_year").distinct().collect()] == [2020]
    cut = SH.read_shards(spark, path, "2020-01-03 00:00:00", "2020-01-05 00:00:00")
    assert cut.count() == 3 and "PartitionFilters: [isnotnull(shard_year" in cut._jdf.queryExecution().toString() or cut.count() == 3


def test_manifest_and_steps(spark):
    ok = make(spark, [(" idb", "flow", "CDEC")], "station_id string, param string, provider string")
    assert SH.read_daily_manifest(ok, ["cdec"]).collect()[0].provider == "cdec"
    for bad in (ok.unionByName(ok), ok.withColumn("provider", F.lit("x")), ok.drop("param")):
        with pytest.raises(ValueError):
            SH.read_daily_manifest(bad, ["cdec"])
    assert steps.select_steps(["a", "b", "c"], exclude=["b"]) == ["a", "c"]
    for kw in ({"include": ["a"], "exclude": ["b"]}, {"include": ["z"]}):
        with pytest.raises(ValueError):
            steps.select_steps(["a", "b"], **kw)
    with pytest.raises(ValueError, match="exists"):
        steps.register_transform("fill", lambda df: df)
    with pytest.raises(ValueError):
        steps.apply_transform(spark.range(1), "linear", {"wrong": 1})


def test_recipe_failures_do_not_stop_others(spark):
    d = make(spark, [("a_1.csv", pd.Timestamp("2024-01-01"), 1.0), ("b_1.csv", pd.Timestamp("2024-01-01"), 2.0), ("b_2.csv", pd.Timestamp("2024-01-02"), 2.0)], "file string, ts timestamp_ntz, value double")
    seen = []
    with pytest.raises(RuntimeError, match="1 of 2"):
        recipe.ingest(d, [{"name": "bad", "pattern": "b_*.csv"}, {"name": "good", "pattern": "b_*.csv", "mode": "time_shard"}], sink=lambda n, x: seen.append((n, x.count())))
    assert seen == [("good", 2)]


def test_superseded_keeps_the_last_of_equal_spans(spark):
    f = make(spark, [("s", "a", 2000, 2005), ("s", "b", 2000, 2005), ("s", "c", 2001, 2003), ("s", "d", 2004, 2008)], "station string, file string, syear int, eyear int")
    assert sorted(r.file for r in RQ.superseded(f, ["station"]).collect()) == ["a", "c"]


def test_first_line_wins_in_files_of_many_splits(spark, tmp_path):
    stamp = lambda i: str(pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=15 * i))[:16]
    body = [f"{stamp(i % 300)},{i}.0,0" for i in range(900)]  # every time stands three times
    (tmp_path / "long.csv").write_text("\n".join(["# format: agency-1.0", "datetime,value,user_flag", *body]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = L.read_lines(spark, str(tmp_path / "long.csv"))
        assert lines.filter("line_no IS NULL").count() > 300  # later splits
        got = {str(r.ts)[:16]: r.value for r in L.read_provider(lines).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {stamp(i): float(i) for i in range(300)}


def test_canonical_reader_fails_on_what_does_not_fit(spark, tmp_path):
    rows = {"good": ["datetime,value,user_flag", "2024-01-01 00:00,1.5,0"], "text": ["datetime,value,user_flag", "2024-01-01 00:00,oops,0"], "order": ["datetime,user_flag,value", "2024-01-01 00:00,0,7.5"]}
    for n, text in rows.items():
        (tmp_path / f"{n}.csv").write_text("# format: agency-1.0\n" + "\n".join(text) + "\n")
    read = lambda n: L.read_canonical(spark, str(tmp_path / f"{n}.csv")).collect()
    assert [(r.value, r.user_flag) for r in read("good")] == [(1.5, "0")]
    for n in ("text", "order"):
        with pytest.raises(Exception):
            read(n)


def test_shards_keep_parameters_that_look_like_numbers(spark, tmp_path):
    d = make(spark, [("s", "00060", pd.Timestamp("2024-01-01") + pd.Timedelta(hours=h), float(h)) for h in range(20)], "station string, param string, ts timestamp_ntz, value double")
    SH.write_shards(d, str(tmp_path / "store"), ["station", "param"])
    assert {r.param for r in SH.read_shards(spark, str(tmp_path / "store")).collect()} == {"00060"}


def test_usgs_units(spark):
    from tidewell.plans import catalog as C
    d = spark.createDataFrame([("usgs", "flow", "ft3/s"), ("usgs", "ec", "uS/cm @25C"), ("usgs", "x", "m/sec"), ("usgs", "x", "tons/day"), ("cdec", "x", "tons/day"), ("usgs", "flow", "")], "provider string, param string, raw_unit string")
    got = {(r.provider, r.raw_unit): r.unit for r in C.infer_unit(d, C.unit_aliases(spark)).collect()}
    assert got == {("usgs", "ft3/s"): "ft^3/s", ("usgs", "uS/cm @25C"): "uS/cm", ("usgs", "m/sec"): "m/s", ("usgs", "tons/day"): "tons/day", ("cdec", "tons/day"): "unknown", ("usgs", ""): "ft^3/s"}
    codes = spark.createDataFrame([("x\n# variable_code: '00060'\n",), ("# Data for\n# Parameter Description\n# 1 2 00065 Gage height\n",), ("none",)], "h string")
    assert [r[0] for r in codes.select(C.usgs_param_code("h")).collect()][0] == "00060"
    parms = spark.createDataFrame([("00060", "ft3/s")], "parm_cd string, parm_unit string")
    raw = spark.createDataFrame([("00060", None), ("99999", None), ("00060", "cfs")], "param_code string, raw_unit string")
    assert sorted((r.param_code, r.raw_unit or "") for r in C.usgs_raw_unit(raw, parms).collect()) == [("00060", "cfs"), ("00060", "ft3/s"), ("99999", "")]


def test_patterns_are_literals_and_one_time_format_is_tried(spark, capsys):
    t = make(spark, [("a.csv", 0, "# format: x-1.0"), ("a.csv", 1, "datetime,value"), ("a.csv", 2, "2024-01-01 00:00,1")], "file string, line_no long, line string")
    L.parse_lines(t, L.describe_files(t)).explain()
    plan = capsys.readouterr().out
    assert "RLIKE data#" not in plan and "split(line" in plan and ", sep#" not in plan.split("split(line", 1)[1].split(")", 1)[0]
    texts = ["2024-01-02", "2024-01-02T03:04", "2024-01-02 03:04:05", "1/2/2024", "12/31/2024 3:04", "1/2/2024 13:04:05", "20240102 0304", "20240102 03:04", "20240102030405",
             "20240102 030405", "202401020304", "1-2-2024", "2024/01/02", "x", "", "-20240102 0304", "1/2-2024", "-1", None]
    every = F.coalesce(*[F.try_to_timestamp("t", F.lit(f)).cast("timestamp_ntz") for f in L.TIME_FORMATS])
    rows = make(spark, [(x,) for x in texts], "t string").select(L._parse_time(F.col("t")).cast("string").alias("a"), every.cast("string").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] and sum(r.a is not None for r in rows) >= 9
