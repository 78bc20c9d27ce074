"""Staged data against a repository: plan first, then write what changed.

``staged`` and ``repo`` have key columns, ``shard`` (text label), ``ts``,
``value`` and, when screened, ``user_flag``.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F

from tidewell.operators.checks import require_empty
from tidewell.operators.chunks import DEFAULT_SECONDS, attach
from tidewell.operators.grid import freq_class, infer_freq
from tidewell.operators.merge import ts_merge, ts_splice
from tidewell.session import stage

SINGLE = "__single__"
VALUE, FLAG = "value", "user_flag"


def shard_label(name) -> Column:
    """REC-1.  ``YYYY_YYYY``, ``YYYY`` or ``__single__`` from a file name."""
    n = F.col(name) if isinstance(name, str) else name
    span = F.regexp_extract(n, r"_(\d{4}_\d{4})\.[^.]+$", 1)
    year = F.regexp_extract(n, r"_(\d{4})\.[^.]+$", 1)
    return F.when(span != "", span).when(year != "", year).otherwise(F.lit(SINGLE))


def shard_end_year(shard) -> Column:
    """REC-1.  Last year of a shard, NULL for a single one."""
    s = F.col(shard) if isinstance(shard, str) else shard
    return F.when(s != SINGLE, F.substring(s, -4, 4).try_cast("int"))


def content_hash(df, keys, columns, shard="shard") -> DataFrame:
    """REC-2.  Order-free digest of the data of a shard: row count and the sum of
    row hashes, both merged before the shuffle."""
    h = F.xxhash64(*columns).cast("decimal(38,0)")
    return df.groupBy(*keys, shard).agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("digest"))


def stable_draw(key: Column) -> Column:
    """A number in [0, 1) fixed by the key: leading 52 bits of its sha256."""
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def stable_sample(key: Column, p: float) -> Column:
    """REC-3."""
    return stable_draw(key) < p


def inspect_rule(series: Column, shard: Column, this_year: int, recent_years=3, p3=0.15, p10=0.05) -> Column:
    """REC-4.  Recent and single shards always; older ones by a stable draw."""
    end = shard_end_year(shard)
    age = F.lit(this_year) - end
    tag = F.concat_ws("|", series, shard)
    return (F.when(end.isNull() | (age < recent_years), F.lit(True))
            .when(age > 10, stable_sample(F.concat(tag, F.lit("|p10")), p10))
            .otherwise(stable_sample(F.concat(tag, F.lit("|p3")), p3)))


def values_differ(a: Column, b: Column, atol=0.0, rtol=0.0) -> Column:
    """REC-5.  NULL equals NULL; otherwise beyond the tolerance."""
    if atol == 0 and rtol == 0:
        return ~a.eqNullSafe(b)
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, F.abs(a - b) > atol + rtol * F.abs(b)).otherwise(a.isNull() != b.isNull())


def normalize_flag(text) -> Column:
    """REC-9.  Blank and ``nan`` to NULL, 0 / 1 kept, anything else an error."""
    t = F.lower(F.trim((F.col(text) if isinstance(text, str) else text).cast("string")))
    return (F.when(t.isNull() | t.isin("", "nan", "<na>", "none"), F.lit(None)).when(t.isin("0", "0.0"), F.lit(0))
            .when(t.isin("1", "1.0"), F.lit(1))
            .otherwise(F.raise_error(F.concat(F.lit("bad user_flag "), t)))).cast("tinyint")


def _two_sided(staged, repo, keys, cols):
    """Both sides side by side at each (series, shard, ts): one aggregation over
    the union instead of a full outer join."""
    k = [*keys, "shard", "ts"]
    side = lambda df, s: df.select(*k, F.struct(*cols).alias("d"), F.lit(s).alias("side"))
    u = side(staged, 0).unionByName(side(repo, 1))
    at = lambda s: F.max(F.when(F.col("side") == s, F.col("d")))
    return u.groupBy(*k).agg(at(0).alias("s"), at(1).alias("r"))


def _series_text(keys) -> Column:
    return F.concat_ws("|", *[F.col(k) for k in keys])


def check_columns(staged, repo) -> None:
    if staged.columns != repo.columns:
        raise ValueError(f"columns differ: staged {staged.columns}, repo {repo.columns}")


def vet_shards(staged, repo, keys, cols, this_year, recent_years=3, p3=0.15, p10=0.05, always=False) -> DataFrame:
    """Per staged shard: present in the repository, inspected, digests equal."""
    s = content_hash(staged, keys, ["ts", *cols]).withColumnRenamed("digest", "s_digest").withColumnRenamed("n", "s_n")
    r = content_hash(repo, keys, ["ts", *cols]).withColumnRenamed("digest", "r_digest").withColumnRenamed("n", "r_n")
    j = s.join(r, [*keys, "shard"], "left")
    rule = F.lit(True) if always else inspect_rule(_series_text(keys), F.col("shard"), this_year, recent_years, p3, p10)
    return j.select(*keys, "shard", F.col("r_n").isNull().alias("missing"), rule.alias("inspected"),
                    ((F.col("s_n") == F.col("r_n")) & (F.col("s_digest") == F.col("r_digest"))).alias("equal"))


def _freq_status(rows, sh, seconds) -> DataFrame:
    """(sh, status): frequency classes of the staged (side 0) and stored (side 1) rows of each shard."""
    fr = infer_freq(rows, [*sh, "side"], seconds=seconds).groupBy(*sh).agg(*[F.max(F.when(F.col("side") == i, F.col("freq"))).alias(n) for i, n in ((0, "sf"), (1, "rf"))])
    return fr.select(*sh, freq_class(F.col("sf"), F.col("rf")).alias("status"))


def freq_gate(status: Column, freq_mismatch="quarantine") -> Column:
    """Action that the frequency classes force, NULL to go on."""
    return (F.when(status == "dst_irregular", "replace_write")
            .when(status.isin("src_irregular", "both_irregular"), "quarantine_skip")
            .when(status == "both_regular_different", "quarantine_skip" if freq_mismatch == "quarantine" else "replace_write"))


def plan_update(staged, repo, keys, this_year: int, recent_years=3, p3=0.15, p10=0.05, atol=0.0, rtol=0.0,
                regular=True, freq_mismatch="quarantine", allow_new_series=True, escalate=True, seconds=DEFAULT_SECONDS) -> DataFrame:
    """REC-6 and REC-7.  (keys, shard, action, reason).

    Digests and the inspection rule come first; only the rows of shards that
    differ are compared.  Frequencies are inferred for those shards only.
    """
    check_columns(staged, repo)
    if not allow_new_series:
        require_empty(staged.select(*keys).distinct().join(repo.select(*keys).distinct(), list(keys), "left_anti"), "series is new")
    sh = [*keys, "shard"]
    vet = vet_shards(staged, repo, keys, [VALUE], this_year, recent_years, p3, p10)
    new = vet.filter("missing").select(*sh, F.lit("write").alias("action"), F.lit("missing_in_repo").alias("reason"))
    todo = vet.filter("NOT missing AND inspected AND NOT equal").select(*sh)
    # rows of the shards that differ, of both sides: compared and asked for their steps
    cols = [*sh, "ts", VALUE]
    side = lambda d, i: d.select(*cols).join(todo, sh, "left_semi").withColumn("side", F.lit(i))
    rows = side(staged, 0).unionByName(side(repo, 1))
    rows = stage(rows) if regular else rows
    t = rows.groupBy(*sh, "ts").agg(
        *[F.max(F.when(F.col("side") == i, F.struct(VALUE))).alias(n) for i, n in ((0, "s"), (1, "r"))])
    s, r = F.col("s"), F.col("r")
    ins, inr = s.isNotNull(), r.isNotNull()
    ts = F.col("ts")
    f = t.groupBy(*sh).agg(
        F.count_if(ins & inr).alias("common"), F.count_if(ins & ~inr).alias("extra_s"), F.count_if(inr & ~ins).alias("extra_r"),
        F.count_if(ins & inr & values_differ(s[VALUE], r[VALUE], atol, rtol)).alias("changed"),
        F.min(F.when(ins & ~inr, ts)).alias("es0"), F.max(F.when(ins & ~inr, ts)).alias("es1"),
        F.min(F.when(inr, ts)).alias("r0"), F.max(F.when(inr, ts)).alias("r1"))
    reason = (F.when(F.col("common") == 0, "empty_overlap")
              .when((F.col("extra_s") > 0) & (F.col("extra_r") == 0) & (F.col("es0") > F.col("r1")), "append_only")
              .when((F.col("extra_s") > 0) & (F.col("extra_r") == 0) & (F.col("es1") < F.col("r0")), "prepend_only")
              .when((F.col("extra_s") > 0) | (F.col("extra_r") > 0), "index_mismatch")
              .when(F.col("changed") > 0, "overlap_values_changed"))
    f = f.select(*sh, reason.alias("reason"))
    if regular:
        f = f.join(_freq_status(rows, sh, seconds), sh)
        forced = freq_gate(F.col("status"), freq_mismatch)
        f = f.select(*sh, F.coalesce(forced, F.when(F.col("reason").isNotNull(), "splice_write")).alias("action"),
                     F.when(forced.isNotNull(), F.col("status")).otherwise(F.col("reason")).alias("reason"))
    else:
        f = f.select(*sh, F.when(F.col("reason").isNotNull(), "splice_write").alias("action"), "reason")
    plan = new.unionByName(f.filter("action IS NOT NULL"))
    return escalated(plan, vet, keys, this_year, recent_years) if escalate else plan


def escalated(plan, shards, keys, this_year: int, recent_years=3) -> DataFrame:
    """REC-7.  A splice in a shard older than ``recent_years`` adds the series'
    other staged shards to the plan."""
    sh = [*keys, "shard"]
    old = plan.filter((F.col("action") == "splice_write") & (this_year - shard_end_year("shard") > recent_years))
    rest = shards.select(*sh).join(old.select(*keys).distinct(), list(keys), "left_semi").join(plan.select(*sh), sh, "left_anti")
    return plan.unionByName(rest.select(*sh, F.lit("splice_write").alias("action"), F.lit("escalated_due_to_old_change").alias("reason")))


def apply_update(staged, repo, plan, keys, prefer="staged", regular=True, seconds=DEFAULT_SECONDS) -> DataFrame:
    """REC-8.  New content of the touched shards only (keys, shard, ts, value)."""
    sh = [*keys, "shard"]
    whole = plan.filter(F.col("action").isin("write", "replace_write")).select(*sh)
    mixed = plan.filter("action = 'splice_write'").select(*sh)
    cols = [*sh, "ts", VALUE]
    full = staged.join(whole, sh, "left_semi").select(*cols)
    s, r = staged.join(mixed, sh, "left_semi").select(*cols), repo.join(mixed, sh, "left_semi").select(*cols)
    first = [s, r] if prefer == "staged" else [r, s]
    if regular:
        both = ts_merge(first, sh, VALUE, strict_priority=True, seconds=seconds)
    else:
        # later times win from their first valid time: the preferred side goes last
        both = ts_splice([r, s], sh, "last" if prefer == "staged" else "first", VALUE, seconds=seconds)
    return full.unionByName(both.select(*cols))


def overwrite_shards(new: DataFrame, path: str, partition=("param", "shard")) -> None:
    """Write the touched partitions; the others stay.  ``new`` must not read from
    ``path`` lazily: pass it through ``stage`` first."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def merge_flags(repo, staged, keys, value_reference="staged", explicit_conflict="prefer_repo", atol=0.0, rtol=0.0) -> DataFrame:
    """REC-10.  Flags merged on (series, shard, ts).

    A new or changed value takes value and flag from the reference side.  An
    equal value stays as in the repository; an explicit flag beats a blank one,
    and two different explicit flags follow ``explicit_conflict``.
    """
    if value_reference not in ("repo", "staged") or explicit_conflict not in ("prefer_repo", "prefer_staged", "error"):
        raise ValueError("unknown merge policy")
    t = _two_sided(staged, repo, keys, [VALUE, FLAG])
    sv, rv, sf, rf = F.col("s")[VALUE], F.col("r")[VALUE], F.col("s")[FLAG], F.col("r")[FLAG]
    both, none = sv.isNotNull() & rv.isNotNull(), sv.isNull() & rv.isNull()
    different = F.when(both, values_differ(rv, sv, atol, rtol)).otherwise(~none)
    clash = {"prefer_repo": rf, "prefer_staged": sf,
             "error": F.raise_error(F.lit("explicit flags conflict")).cast("tinyint")}[explicit_conflict]
    same_flag = F.when(rf.isNull(), sf).when(sf.isNull(), rf).when(rf == sf, rf).otherwise(clash)
    ref_v, ref_f = (rv, rf) if value_reference == "repo" else (sv, sf)
    return t.select(*keys, "shard", "ts", F.when(different, ref_v).otherwise(rv).alias(VALUE),
                    F.when(different, ref_f).otherwise(same_flag).cast("tinyint").alias(FLAG),
                    F.col("r").isNotNull().alias("in_repo"), rv.alias("repo_value"), rf.alias("repo_flag"))


def plan_flagged(staged, repo, keys, this_year: int, value_reference="staged", explicit_conflict="prefer_repo", atol=0.0, rtol=0.0,
                 freq_mismatch="quarantine", seconds=DEFAULT_SECONDS) -> DataFrame:
    """REC-11.  Plan for screened shards; equal merges give no row."""
    sh = [*keys, "shard"]
    vet = vet_shards(staged, repo, keys, [VALUE, FLAG], this_year, always=True)
    new = vet.filter("missing").select(*sh, F.lit("write").alias("action"), F.lit("missing_in_repo").alias("reason"))
    todo = vet.filter("NOT missing AND NOT equal").select(*sh)
    # as in plan_update: rows of the shards that differ are merged and asked for their steps
    cols = [*sh, "ts", VALUE, FLAG]
    side = lambda d, i: d.select(*cols).join(todo, sh, "left_semi").withColumn("side", F.lit(i))
    rows = stage(side(staged, 0).unionByName(side(repo, 1)))
    m = merge_flags(rows.filter("side = 1"), rows.filter("side = 0"), keys, value_reference, explicit_conflict, atol, rtol)
    diff = ~F.col("in_repo") | values_differ(F.col(VALUE), F.col("repo_value"), atol, rtol) | ~F.col(FLAG).eqNullSafe(F.col("repo_flag"))
    n = m.groupBy(*sh).agg(F.count_if(diff).alias("diffs"))
    f = n.join(_freq_status(rows, sh, seconds), sh)
    forced = freq_gate(F.col("status"), freq_mismatch)
    f = f.select(*sh, F.coalesce(forced, F.when(F.col("diffs") > 0, "write")).alias("action"),
                 F.when(forced.isNotNull(), F.col("status")).otherwise(F.lit("flag_or_value_merge_changed")).alias("reason"))
    return new.unionByName(f.filter("action IS NOT NULL"))


def apply_flagged(staged, repo, plan, keys, value_reference="staged", explicit_conflict="prefer_repo", atol=0.0, rtol=0.0) -> DataFrame:
    """REC-12.  New content of the touched screened shards."""
    sh = [*keys, "shard"]
    cols = [*sh, "ts", VALUE, FLAG]
    whole = plan.filter((F.col("action") == "replace_write") | (F.col("reason") == "missing_in_repo")).select(*sh)
    mixed = plan.filter("reason = 'flag_or_value_merge_changed'").select(*sh)
    m = merge_flags(repo.join(mixed, sh, "left_semi"), staged.join(mixed, sh, "left_semi"), keys, value_reference, explicit_conflict, atol, rtol)
    return staged.join(whole, sh, "left_semi").select(*cols).unionByName(m.select(*cols))


def plan_summary(plan, vet, keys) -> DataFrame:
    """REC-13.  One row: candidates, inspected, updates."""
    v = vet.agg(F.count(F.lit(1)).alias("candidates"), F.count_if("inspected").alias("inspected"))
    return v.crossJoin(plan.agg(F.count(F.lit(1)).alias("updates")))


def fail_if_changes(plan) -> None:
    require_empty(plan, "updates are pending")


def coverage_check(staged_counts, repo_counts, keys, fract: float, min_abs: int) -> DataFrame:
    """REC-14.  Groups whose staged count is too low against the repository."""
    need = F.greatest(F.ceil(F.lit(fract) * F.col("repo_n")), F.lit(min_abs)).cast("long")
    j = repo_counts.select(*keys, F.col("n").alias("repo_n")).join(staged_counts.select(*keys, F.col("n").alias("staged_n")), list(keys), "left")
    j = j.withColumn("staged_n", F.coalesce("staged_n", F.lit(0).cast("long"))).withColumn("need", need)
    return j.withColumn("ok", F.col("staged_n") >= F.col("need"))


def year_coverage(required, shards, keys) -> DataFrame:
    """REC-15.  Required (keys, year) without a readable shard whose year span
    covers it; spans are spelled out by year so that the join is an equality.  An
    open end reaches to the last required year, no further."""
    last = required.agg(F.max("year")).first()[0]
    end = F.least("eyear", F.lit(last))
    covered = shards.filter(F.col("readable") & (F.col("syear") <= end)).select(*keys, F.explode(F.sequence("syear", end.cast(shards.schema["syear"].dataType))).alias("year")).distinct()
    return required.join(covered, [*keys, "year"], "left_anti")


def failure_mask(failures) -> DataFrame:
    """REC-15.  ``check`` code of each kind of failure (1, 2, 4) or-ed to one mask."""
    return failures.agg(F.coalesce(F.bit_or("code"), F.lit(0)).alias("mask"))


def only_series(df, chosen, keys, seconds=DEFAULT_SECONDS, ts="ts") -> DataFrame:
    """REC-16.  The choice meets the chunks of a series, so a hot one stays spread."""
    picked = chosen.select(*keys).distinct().withColumn("__picked", F.lit(True))
    return attach(df, picked, keys, seconds, ts).filter("__picked").drop("__picked")
