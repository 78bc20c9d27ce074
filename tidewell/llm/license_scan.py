"""License notices by an exact set-similarity join with templates (operator 4).

A document's words are cut into blocks of `BLOCK` words, one every half block.  A
block is a set of words, a template a set of words with a label.  A block meets a
template if it contains at least `need` of the template's words.

1. Template words are counted over all documents and each template is sorted by that
   count, rare words first (ties by the word).
2. Prefix filter: of size - need + 1 rarest words a block that meets the template has
   one.  Only documents with such a word, and of them only the blocks with one, go on.
3. Blocks meet an index (word, place in the template) of the prefixes, a table whose
   size is fixed by the templates.  A pair is kept once, at the first template word the
   block holds; length filter: the block has `need` distinct words; positional filter:
   size - place words can still be shared.
4. The overlap is counted.  Base phrases are templates that must be held whole; the
   places where their words stand consecutively are then looked up in the block.

Only DataFrame functions are used.  Nothing is gathered by license or word: what is
shuffled is one small row for each found place or label.

Defined cases: null text is empty, so it has no words; null keys and repeated rows
each keep their row; a text of any length is scanned whole; an empty table gives an
empty one; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 32
STEP = BLOCK // 2

# Phrases and labels of the contract.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Sentences of standard notices, lower case, words only.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "unless required by applicable law or agreed to in writing software distributed under the license": "apache-2",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "under the terms of the gnu general public license": "gpl",
    "under the terms of the mozilla public license": "mpl",
    "all rights reserved no part may be reproduced": "proprietary",
}

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case.  lower() maps one other letter, the Kelvin sign,
    to an ASCII one; it is set aside first."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    return F.array_remove(F.split(low, _NOT_WORD), "")


def templates(base: dict[str, str], notices: dict[str, str], percent: int) -> list[tuple[str, str, list[str], int, bool]]:
    """(template, label, words, need, whole): base phrases whole, and all by containment."""
    out = []
    for phrase, label in base.items():
        out.append((f"={phrase}", label, sorted(set(phrase.split())), len(set(phrase.split())), True))
    for phrase, label in {**notices, **base}.items():
        w = sorted(set(phrase.split()))
        out.append((phrase, label, w, -(-percent * len(w) // 100), False))
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", *, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, percent: int = 80) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row."""
    spark = docs.sparkSession
    known = templates(base, notices, percent)
    if any(len(p.split()) > STEP + 1 for p in base) or any(len(t[2]) > BLOCK for t in known):
        raise ValueError("a template is longer than a block")
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("r"), words_of(F.col(text)).alias("words"))

    # global order of the template words: in how many documents each occurs
    vocabulary = sorted({w for t in known for w in t[2]})
    held = rows.select(F.explode(F.array_intersect("words", F.array(*map(F.lit, vocabulary)))).alias("w"))
    count = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}  # one row a template word
    index = []
    for name, label, words, need, whole in known:
        order = sorted(words, key=lambda w: (count.get(w, 0), w))
        index += [(order[i], i, name, label, order, need, whole) for i in range(len(order) - need + 1)]
    rare = sorted({i[0] for i in index})
    lists = spark.createDataFrame(index, "word string, place int, name string, label string, tokens array<string>, need int, whole boolean")

    # blocks with a rare word
    some = F.array(*map(F.lit, rare))
    able = rows.filter(F.arrays_overlap("words", some))
    at = F.filter(F.transform("words", lambda w, i: F.when(w.isin(rare), i)), lambda i: i.isNotNull())
    numbers = F.array_distinct(F.flatten(F.transform(at, lambda i: F.array((i / STEP).cast("int"), (i / STEP).cast("int") - 1))))
    blocks = (able.select("k", "r", "words", F.explode(F.filter(numbers, lambda b: b >= 0)).alias("b"))
              .select("k", "r", "b", F.slice("words", F.col("b") * STEP + 1, BLOCK).alias("body")).withColumn("held", F.array_distinct("body")))
    # the index has one row for each prefix word of each template
    pairs = blocks.withColumn("word", F.explode(F.array_intersect("held", some))).join(F.broadcast(lists), "word")
    earlier = F.size(F.array_intersect("held", F.slice("tokens", 1, F.col("place"))))
    pairs = pairs.filter((F.size("held") >= F.col("need")) & (F.size("tokens") - F.col("place") >= F.col("need")) & (earlier == 0))
    overlap = F.size(F.array_intersect("held", "tokens"))
    met = pairs.withColumn("overlap", overlap).filter(F.col("overlap") >= F.col("need"))

    phrase = F.split(F.substring_index("name", "=", -1), " ")
    starts = F.filter(F.sequence(F.lit(0), F.lit(STEP - 1)), lambda j: F.slice("body", j + 1, F.size(phrase)) == phrase)
    places = met.filter("whole").select("k", "r", "label", F.explode(F.transform(starts, lambda j: F.col("b") * STEP + j)).alias("p"), "name").distinct()
    sharing = met.filter("not whole").groupBy("k", "r", "label").agg(F.max(F.col("overlap") / F.size("tokens")).alias("share"))
    nothing = F.lit(None)
    found = places.select("k", "r", "label", "p", nothing.cast("double").alias("share")).unionByName(sharing.select("k", "r", "label", nothing.cast("int").alias("p"), "share"))
    of_row = found.groupBy("k", "r").agg(
        F.count("p").alias("n_base"), F.min("p").alias("first_word"), F.max("p").alias("last_word"), F.array_join(F.sort_array(F.collect_set(F.when(F.col("p").isNotNull(), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max(F.when(F.col("p").isNotNull(), 1.0).otherwise(F.col("share"))).alias("score"))
    # null keys meet too
    out = rows.select("k", "r", F.size("words").cast("long").alias("n_words")).join(of_row.withColumnsRenamed({"k": "k2", "r": "r2"}), F.col("k").eqNullSafe(F.col("k2")) & (F.col("r") == F.col("r2")), "left")
    return out.select(F.col("k").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
                      F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def scan_sql(base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, percent: int = 80, table: str = "documents") -> str:
    """The same over every block, for another engine."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    base_rows = ", ".join(f"({quoted(p.split())}, '{label}')" for p, label in base.items())
    known = ", ".join(f"({quoted(t[2])}, '{t[1]}', {t[3]})" for t in templates({}, {**notices, **base}, percent))
    return f"""WITH d AS (SELECT row_number() OVER () AS rn, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}),
  base(words, label) AS (VALUES {base_rows}), known(words, label, need) AS (VALUES {known}),
  places AS (SELECT rn, label, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i:i + len(words) - 1] = words)) - 1 AS p FROM d, base WHERE len(list_intersect(w, words)) = len(words)),
  blocks AS (SELECT rn, list_distinct(w[b * {STEP} + 1:b * {STEP} + {BLOCK}]) AS held FROM (SELECT rn, w, unnest(range(0, (len(w) + {STEP - 1}) // {STEP})) AS b FROM d)),
  shares AS (SELECT rn, label, len(list_intersect(held, words)) AS o, len(words) AS n FROM blocks, known WHERE len(list_intersect(held, words)) >= need),
  f AS (SELECT rn, label, p, CAST(NULL AS DOUBLE) AS share FROM places UNION ALL SELECT rn, label, NULL, max(o / n) FROM shares GROUP BY rn, label),
  g AS (SELECT rn, count(p) AS n_base, min(p) AS first_word, max(p) AS last_word, array_to_string(list_sort(list_distinct(list(label) FILTER (p IS NOT NULL))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(CASE WHEN p IS NOT NULL THEN 1.0 ELSE share END) AS score FROM f GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score FROM d LEFT JOIN g USING (rn)"""
