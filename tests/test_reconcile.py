import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.twins import make
from tidewell.operators import reconcile as R
from tidewell.streaming.topoff import read_repository, stream_topoff, topoff_batch

K = ["station", "param"]
T0 = pd.Timestamp("2024-01-01")
COLS = "station string, param string, shard string, ts timestamp_ntz, value double"


def shard(spark, days, values, year="2024", flags=None, start=T0):
    rows = [("s", "flow", year, start + pd.Timedelta(days=d) if isinstance(d, int) else d, float(v)) for d, v in zip(days, values)]
    d = make(spark, rows, COLS)
    if flags is None:
        return d
    f = make(spark, [(r[3], x) for r, x in zip(rows, flags)], "ts timestamp_ntz, user_flag byte")
    return d.join(f, "ts").select("station", "param", "shard", "ts", "value", "user_flag")


def actions(plan):
    return sorted((r.shard, r.action, r.reason) for r in plan.collect())


@pytest.mark.parametrize("repo,staged,changed,want", [
    (None, None, False, None), (1, None, False, 1), (0, None, False, 0), (None, 1, False, 1), (1, 1, False, 1),
    (0, 1, False, 0), (0, None, True, None), (1, None, True, None), (1, 1, True, 1)])
def test_flag_truth_table(spark, repo, staged, changed, want):
    r = shard(spark, [0], [1.0], flags=[repo])
    s = shard(spark, [0], [2.0 if changed else 1.0], flags=[staged])
    m = R.merge_flags(r, s, K).collect()[0]
    assert m.user_flag == want and m.value == (2.0 if changed else 1.0)


def test_plan_reasons(spark):
    base = shard(spark, range(10), range(10))
    plan = lambda s, r=base, **k: actions(R.plan_update(s, r, K, 2024, **k))
    assert plan(base) == []
    assert plan(shard(spark, range(10), [9, *range(1, 10)])) == [("2024", "splice_write", "overlap_values_changed")]
    assert plan(shard(spark, range(14), range(14))) == [("2024", "splice_write", "append_only")]
    assert plan(shard(spark, range(-4, 10), range(-4, 10))) == [("2024", "splice_write", "prepend_only")]
    assert plan(shard(spark, range(20, 30), range(10))) == [("2024", "splice_write", "empty_overlap")]
    assert plan(shard(spark, range(8), range(8))) == [("2024", "splice_write", "index_mismatch")]
    assert plan(shard(spark, range(5), range(5), "2023")) == [("2023", "write", "missing_in_repo")]
    assert plan(shard(spark, range(10), [0.0004 + i for i in range(10)]), atol=0.001) == []
    with pytest.raises(ValueError):
        R.plan_update(base, base.withColumn("station", F.lit("other")), K, 2024, allow_new_series=False)
    with pytest.raises(ValueError):
        R.plan_update(base, base.withColumn("extra", F.lit(1)), K, 2024)


def test_frequency_gate(spark):
    ten = shard(spark, [T0 + pd.Timedelta(minutes=10 * i) for i in range(10)], range(10))
    quarter = shard(spark, [T0 + pd.Timedelta(minutes=15 * i) for i in range(10)], range(10))
    odd = shard(spark, [T0 + pd.Timedelta(minutes=m) for m in (0, 10, 15)], [1, 2, 3])
    one = lambda s, r, **k: [a[1:] for a in actions(R.plan_update(s, r, K, 2024, **k))]
    assert one(quarter, ten) == [("quarantine_skip", "both_regular_different")]
    assert one(quarter, ten, freq_mismatch="replace") == [("replace_write", "both_regular_different")]
    assert one(quarter, odd) == [("replace_write", "dst_irregular")]
    assert one(odd, quarter) == [("quarantine_skip", "src_irregular")]


def test_flagged_plan_and_update(spark):
    days = lambda *y: [(x, pd.Timestamp(f"{x}-01-01")) for x in y]
    one = lambda y, t, v, f: shard(spark, range(10), v, y, f, t)
    none, flags, v = [None] * 10, [1, 0, *[None] * 8], range(10)
    # 2020 equal, 2021 only flags the repository has, 2022 new flags, 2023 not in the repository, 2024 by every second day
    (a, b, c, d, e) = days("2020", "2021", "2022", "2023", "2024")
    repo = one(*a, v, none).unionByName(one(*b, v, flags)).unionByName(one(*c, v, none)).unionByName(one(*e, v, none))
    half = shard(spark, range(0, 20, 2), v, "2024", none, e[1])
    staged = one(*a, v, none).unionByName(one(*b, v, none)).unionByName(one(*c, v, flags)).unionByName(one(*d, v, flags)).unionByName(half)
    plan = R.plan_flagged(staged, repo, K, 2024)
    merged = [("2022", "write", "flag_or_value_merge_changed"), ("2023", "write", "missing_in_repo")]
    assert actions(plan) == [*merged, ("2024", "quarantine_skip", "both_regular_different")]
    out = sorted((r.shard, r.value, r.user_flag) for r in R.apply_flagged(staged, repo, plan, K).collect())
    assert out == [(y, float(i), f) for y in ("2022", "2023") for i, f in zip(v, flags)]


def test_irregular_topoff(spark):
    at = lambda *m: [T0 + pd.Timedelta(minutes=x) for x in m]
    repo, staged = shard(spark, at(0, 10, 15), [1, 2, 3]), shard(spark, at(15, 40, 65), [3, 4, 5])
    plan = R.plan_update(staged, repo, K, 2024, regular=False)
    out = R.apply_update(staged, repo, plan, K, regular=False).orderBy("ts").collect()
    assert [int((pd.Timestamp(r.ts) - T0).total_seconds() // 60) for r in out] == [0, 10, 15, 40, 65]


def test_escalation_and_age(spark):
    old = shard(spark, range(5), range(5), "2015", start=pd.Timestamp("2015-01-01"))
    new = shard(spark, range(5), range(5), "2024")
    repo = old.withColumn("value", F.col("value") + 1).unionByName(new)
    plan = actions(R.plan_update(old.unionByName(new), repo, K, 2024, p3=1.0, p10=1.0))
    assert plan == [("2015", "splice_write", "overlap_values_changed"), ("2024", "splice_write", "escalated_due_to_old_change")]
    assert actions(R.plan_update(old.unionByName(new), repo, K, 2024, p3=0.0, p10=0.0)) == []
    assert actions(R.plan_update(old.unionByName(new), repo, K, 2018, p3=1.0))[0][1] == "splice_write"


def test_bad_flag(spark):
    with pytest.raises(Exception, match="bad user_flag"):
        make(spark, [("2",)], "f string").select(R.normalize_flag("f")).collect()


def test_batches_give_the_same_store(spark, tmp_path):
    # parameter and shard look like numbers; the second series is in other buckets
    rows = [(st, "00060", "01", T0 + pd.Timedelta(hours=h), float(b * 100 + h + len(st)), b) for st in ("s", "tt") for b, hs in enumerate([range(0, 10), range(5, 15), range(0, 20, 3)]) for h in hs]
    d = make(spark, rows, COLS + ", b int")
    path = str(tmp_path / "repo")
    for b in range(3):
        topoff_batch(d.filter(F.col("b") == b).drop("b"), b, path, K)
    topoff_batch(d.filter("b = 0").drop("b"), 0, path, K)  # a batch that comes again is skipped
    stored = read_repository(spark, path, d.drop("b").schema)
    got = {(r.station, r.param, r.shard, r.ts): r.value for r in stored.collect()}
    want = {(*r[:3], r[3].to_pydatetime()): r[4] for r in rows}
    assert got == want and stored.count() == len(want)


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    d = make(spark, [("s", "00060", "1", T0 + pd.Timedelta(hours=h), float(h)) for h in range(3)], COLS)
    for n, v in ((3, 0.0), (2, 50.0)):
        d.limit(n).withColumn("value", F.col("value") + v).write.mode("append").parquet(str(tmp_path / "in"))
        src = spark.readStream.schema(d.schema).parquet(str(tmp_path / "in"))
        stream_topoff(src, str(tmp_path / "repo"), str(tmp_path / "cp"), K).awaitTermination()
    got = sorted((r.param, r.value) for r in read_repository(spark, str(tmp_path / "repo"), d.schema).collect())
    assert len(got) == 3 and {p for p, _ in got} == {"00060"} and sum(v >= 50 for _, v in got) == 2
    assert spark.read.parquet(str(tmp_path / "repo" / "applied")).count() == 2
