"""Mixing sources to target weights by a low-discrepancy schedule (operator 12).

A mix has places for blocks of equally many words.  The targets of the sources, in
blocks, are laid end to end as cumulative weights, and the points of a van der Corput
sequence are mapped through them: place i of the mix belongs to the source in whose
stretch the bits of i, read backwards, fall.  Since the first 2^b points are a
permutation, every source has exactly the places its target needs, spread evenly over
the mix.  The rank of a place among those of its source follows in closed form from the
bits, so no source is gathered to number its places.

The documents of a source are shuffled by a hash of their key and laid end to end, again
and again; the r-th place of a source takes the r-th block of that stream, and its last
place only the words up to the target.  Positions in the stream are running sums in two
levels, over 4096 hash buckets of a source and inside each bucket.

Targets: sources in order (null last) have the weights again and again, and share
`share` times all words; a target stops at `cap` times its source's words, and the excess
is shared again by weight until none is above.  Each round is one aggregate of the table
of sources, which returns two numbers.

Only DataFrame functions are used.  Documents of equal source, key and size are
alike for the mix: they are counted before any shuffle and told apart by number when
they are laid out, so copies of one row spread over tasks.

Defined cases: a null text or a text of white space has size 0 and takes no words; a null
source is a source of its own; null keys are documents like others; repeated rows are
each laid out; sources without words have target 0; an empty table gives an empty mix.
Only the named columns are read.  The result depends on the rows alone, not on their
order or partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.llm.tables import written

WEIGHTS = (5, 2, 1)
PLACES = 1 << 16  # a mix has at least so many places, if its blocks need no less than a word
BLOCK_WORDS = 2048  # and no block has more words
AT_ONCE = 1 << 16  # places, or copies of a row, that one row is exploded to


class Mix(NamedTuple):
    """Sources with their targets, places in order, and the words each place takes."""

    sources: DataFrame  # source, sid, source_size, target
    places: DataFrame  # place, sid, rank, words
    pieces: DataFrame  # sid, key, size, copy, place (null: not taken), first_word, words


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows with their number in the order, from 0, without a task that sees all."""
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__before"))  # one row a partition
    return placed.join(before, "__part").withColumn(name, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at", "__part", "__before")


def _before(df: DataFrame, by: Sequence[str], bucket: str, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Running sum of the rows before: over buckets, then inside a bucket."""
    earlier = lambda keys, cols: Window.partitionBy(*keys).orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*by, bucket).agg(F.sum(value).alias("in_bucket"))
    sums = sums.select(*by, bucket, F.coalesce(F.sum("in_bucket").over(earlier(by, [bucket])), F.lit(0)).alias("buckets_before"))
    inside = F.coalesce(F.sum(value).over(earlier([*by, bucket], order)), F.lit(0))
    return df.join(sums, [*by, bucket]).withColumn(name, inside + F.col("buckets_before")).drop("buckets_before")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: int = 2) -> DataFrame:
    """(source, sid, source_size, target) of a table (source, source_size)."""
    listed = numbered(sources, [F.asc_nulls_last("source")], "sid")
    listed = listed.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int")))
    most = F.col("source_size") * cap
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    unit, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(unit) > most
        taken, free, n = listed.agg(F.coalesce(F.sum(F.when(full, most)), F.lit(0)), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        if n == capped or not free:
            break
        unit, capped = (share * total - taken) / free, n
    target = F.when(full, most.cast("double")).otherwise(F.col("weight") * F.lit(unit))
    return listed.select("source", "sid", "source_size", target.alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", *, weights: Sequence[int] = WEIGHTS,
        share: float = 1.5, cap: int = 2, places: int = PLACES, block_words: int = BLOCK_WORDS) -> Mix:
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    units = written(docs.select(F.col(source).alias("source"), F.col(key).alias("key"), size.alias("size"))
                    .groupBy("source", "key", "size").agg(F.count("*").alias("n")), "mix-units")
    known = written(targets(units.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, cap), "mix-sources")
    total = known.agg(F.sum("target")).first()[0] or 0.0
    block = max(1, min(block_words, math.ceil(total / places)))
    known = known.withColumn("aim", F.floor("target"))
    slots = written(_places(known, block), "mix-places")

    u, k = units.alias("u"), known.alias("k")
    laid = u.join(k, F.col("u.source").eqNullSafe(F.col("k.source"))).select("sid", "key", "size", "n", "source_size", "aim", F.md5(F.coalesce(F.col("key").cast("string"), F.lit(" "))).alias("hash"))
    laid = _before(laid.withColumn("bucket", F.substring("hash", 1, 3)), ["sid"], "bucket", ["hash", "key", "size"], F.col("n") * F.col("size"), "begin")
    # copies of a row one by one, of many copies some at a time in a task
    laid = laid.withColumn("some", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {AT_ONCE}")))).repartition("sid", "key", "size", "some")
    laid = laid.withColumn("copy", F.explode(F.sequence(F.col("some") * AT_ONCE, F.least(F.col("n"), (F.col("some") + 1) * AT_ONCE) - 1)))
    laid = laid.withColumn("turn", F.explode(F.array(*[F.lit(i).cast("long") for i in range(max(1, cap))])))
    laid = laid.withColumn("begin", F.col("begin") + F.col("copy") * F.col("size") + F.col("turn") * F.col("source_size"))
    laid = laid.filter((F.col("turn") == 0) | (F.col("size") > 0) & (F.col("begin") < F.col("aim")))
    none = -1 - F.pmod(F.xxhash64("key", "copy"), F.lit(AT_ONCE))  # no rank: empty texts meet no place, in many tasks
    rank = F.when(F.col("size") > 0, F.expr(f"sequence(begin div {block}, (begin + size - 1) div {block})")).otherwise(F.array(none))
    cut = laid.withColumn("rank", F.explode(rank))
    taken = cut.join(slots.withColumnRenamed("words", "room"), ["sid", "rank"], "left")
    first = F.greatest(F.col("begin"), F.col("rank") * block)
    last = F.least(F.col("begin") + F.col("size"), F.col("rank") * block + F.col("room"))
    words = F.when(F.col("place").isNotNull(), F.greatest(last - first, F.lit(0))).otherwise(F.lit(0)).cast("long")
    pieces = taken.select("sid", "key", "size", "copy", "turn", "place", (first - F.col("begin")).alias("first_word"), words.alias("words"))
    return Mix(known.drop("aim"), slots, pieces)


def _places(known: DataFrame, block: int) -> DataFrame:
    """Every place of the mix: its source, its rank there, and the words it takes."""
    need = known.withColumn("m", F.ceil(F.col("aim") / F.lit(block)).cast("long")).withColumn("bucket", F.expr("sid div 4096")).withColumn("one", F.lit(1))
    need = _before(need, ["one"], "bucket", ["sid"], F.col("m"), "a").withColumn("b", F.col("a") + F.col("m")).filter("m > 0")
    total = known.agg(F.sum(F.ceil(F.col("aim") / F.lit(block)))).first()[0] or 0
    bits = max(1, (int(total) - 1).bit_length())
    some = need.withColumn("some", F.explode(F.expr(f"sequence(0L, (m - 1) div {AT_ONCE})"))).repartition("sid", "some")
    point = some.withColumn("j", F.explode(F.expr(f"sequence(a + some * {AT_ONCE}, a + least(m, (some + 1) * {AT_ONCE}) - 1)")))
    place = F.conv(F.reverse(F.lpad(F.bin("j"), bits, "0")), 2, 10).cast("long")
    # points of [a, b) whose backward bits are smaller: by the first bit where they differ
    upto = lambda x: f"(({x} - (j & (shiftleft(1L, t) - 1L)) + shiftleft(1L, t + 1) - 1L) div shiftleft(1L, t + 1))"
    rank = F.expr(f"aggregate(sequence(0, {bits - 1}), 0L, (s, t) -> s + if((shiftright(j, t) & 1L) = 1L, {upto('b')} - {upto('a')}, 0L))")
    out = point.select(place.alias("place"), "sid", rank.alias("rank"), "aim")
    return out.select("place", "sid", "rank", F.least(F.lit(block), F.col("aim") - F.col("rank") * block).cast("long").alias("words"))


def words_taken(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """(key, size, source_size, target, taken), one row a document."""
    m = mix(docs, key, text, source, **options)
    rows = m.pieces.groupBy("sid", "key", "size", "copy").agg(F.sum("words").alias("taken"))
    return rows.join(m.sources, "sid").select(F.col("key").alias(key), "size", "source_size", "target", "taken")


def words_sql(weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: int = 2) -> str:
    """The same rows over the view `documents`, from positions in the streams alone."""
    return f"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM sized GROUP BY source),
weighted AS (SELECT *, [{', '.join(map(str, weights))}][(sid % {len(weights)} + 1)::INTEGER] AS weight FROM sources),
swept AS (SELECT *, ({share} * sum(source_size) OVER () - coalesce(sum({cap} * source_size) OVER before, 0))::DOUBLE / sum(weight) OVER onward AS unit,
    row_number() OVER fill AS step FROM weighted
  WINDOW fill AS (ORDER BY source_size::DOUBLE / weight, sid), before AS (ORDER BY source_size::DOUBLE / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    onward AS (ORDER BY source_size::DOUBLE / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (SELECT unit FROM swept WHERE weight * unit <= {cap} * source_size ORDER BY step LIMIT 1),
aims AS (SELECT source, sid, source_size, least(({cap} * source_size)::DOUBLE, weight * unit) AS target FROM weighted, level),
laid AS (SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS aim, coalesce(sum(size) OVER (PARTITION BY sid ORDER BY md5(coalesce(doc_id::VARCHAR, ' ')), doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin FROM sized JOIN aims ON sized.source IS NOT DISTINCT FROM aims.source)
SELECT doc_id, size, source_size, target,
  ({' + '.join(f'greatest(0, least(begin + {i} * source_size + size, aim) - least(begin + {i} * source_size, aim))' for i in range(cap))})::BIGINT AS taken FROM laid"""
