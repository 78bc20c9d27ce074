"""SRC-1..6.  Text files of many layouts to one long table.

Files are read as lines, so a large file is split over tasks and no file is
held whole.  Every function takes lines ``(file, line_no, line)``, which may
come from files or from any DataFrame.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewell.session import stage

# Texts that mean a missing value
NULL_TOKENS = ("m", "---", "", "Eqp", "Ssn", "Dis", "Mnt", "***", "ART", "BRT", "ZFL")
# Instrument status codes that stand in a value column
STATUS_TOKENS = ("Fld", "Eqp", "Dis", "Mnt", "Ssn", "Dry", "Pr", "Pmp", "Rat", "Zfl", "Tst", "***")
TIME_FORMATS = ("yyyy-MM-dd[['T'][' ']HH:mm[:ss]]", "M/d/yyyy[ H:mm[:ss]]", "yyyyMMdd[' ']HH[':']mm[ss]")


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of text files.  ``line_no`` numbers the lines of the first split of a
    file (where headers are); it is NULL in later splits of a large file.  ``at``,
    the start of the split and the number in it, orders all lines of a file."""
    d = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("mid"),
        F.col("_metadata.file_block_start").alias("begin"), F.col("value").alias("line"))
    return d.select("file", F.when(F.col("begin") == 0, F.col("mid")).alias("line_no"), F.struct("begin", "mid").alias("at"), "line")


def _placed(lines: DataFrame) -> DataFrame:
    """Lines from elsewhere have no splits: their number is their place."""
    if "at" in lines.columns:
        return lines
    return lines.withColumn("at", F.struct(F.lit(0).cast("long").alias("begin"), F.col("line_no").cast("long").alias("mid")))


class Layout(NamedTuple):
    """How the data lines of a file are read.

    Fields are given by position (0-based) or by name; names are looked up in
    the first line of the file that matches ``header``.  ``pattern`` makes every
    column whose name matches a sensor, with its quality column named by
    replacing ``quality_of[0]`` by ``quality_of[1]`` in the name.
    """

    name: str
    sep: str = ","
    time: tuple = (0,)
    glue: str = ""
    value: int | str | None = 1
    pattern: str | None = None
    quality: int | str | None = None
    quality_of: tuple = ("$", "")
    codes: tuple | None = None
    zone: int | str | None = None
    header: str | None = None
    data: str = r"^\s*\"?\d"
    pad_time: bool = False


_A, _B = ("e", "1", "2", "25", "70"), ("e", "1", "2", "25", "75")
_APPROVED = ("A", "P", "A:[99]", "A:[91]", "A:R", "Approved", "e")
LAYOUTS = {l.name: l for l in (
    Layout("canonical"),
    Layout("screened", quality=2, codes=("0",)),
    Layout("hydstra_json", quality=2, codes=_A),
    Layout("hydstra_csv", quality=2, codes=_A),
    Layout("des_std", time=("time",), value="value", quality="qaqc_flag_id", codes=("U", "G", "A"), header=r"(?i)^[^#]*\bvalue\b"),
    Layout("des", time=("DATETIME",), value="VALUE", quality="QAQC Flag", codes=("U", "G", "A"), header=r"(?i)^.*\bdatetime\b.*\bvalue\b"),
    Layout("cdec_csv2", time=(5,), value=6, quality=7, codes=("e", "ART", "BRT"),
           data=r"^[^,]*,[^,]*,\d"),
    Layout("cdec_csv1", time=(0, 1), glue=" ", value=2, data=r"^\d{8},"),
    Layout("wdl", quality=2, codes=_A),
    Layout("wdl2", quality=2, codes=_B),
    Layout("wdl3", quality=2, codes=_B),
    Layout("usgs_json", time=("datetime",), value=None, pattern=r"_value$", quality_of=("_value$", "_qualifiers"), header=r"^datetime",
           codes=_APPROVED + ("A,[99]", "A:[92]", "A,[91]", "A,[92]", "A:[93]", "A,[93]", "A,R")),
    Layout("usgs_rdb", sep="\t", time=("datetime",), value=None, pattern=r"^\d+_\d{5}(_\d{5})?$", quality_of=("$", "_cd"), zone="tz_cd",
           header=r"^agency_cd", data=r"^USGS\t", codes=_APPROVED),
    Layout("usgs_daily", sep="\t", time=("datetime",), value=None, pattern=r"^\d+_\d{5}(_\d{5})?$", quality_of=("$", "_cd"),
           header=r"^agency_cd", data=r"^USGS\t", codes=_APPROVED + ("A:e",)),
    Layout("usgs_unit", sep="\t", time=("DATE", "TIME"), glue=" ", value="VALUE", quality="QA",
           zone="TZCD", header=r"^DATE\t", data=r"^\d{8}\t", codes=("A", "P", "A:[99]", "A:R", "Approved")),
    Layout("usgs_csv", time=(1,), value="Value", quality="Approval Level", header=r"(?i)^iso", codes=("A", "P", "Approved", "Working", "A:[99]", "A:R")),
    Layout("noaa", time=("Date Time",), value=1, quality="Quality", header=r"^Date", codes=("0", "p", "v")),
    Layout("vtide", sep=r"\s+", time=(0, 1), glue=" ", value=2, pad_time=True),
    Layout("any_csv"),
)}

# SRC-3.  Signatures in order; the first that fits wins.  A signature is a list
# of (pattern, within the first n lines, wanted); all must hold.
SIGNATURES: list[tuple[str, list[tuple[str, int, bool]]]] = [
    ("usgs_json", [(r"parse-usgs-json", 3, True)]),
    ("screened", [(r"format\s?:\s?[\w-]+-1\.0", 1, True), (r"user_flag", 151, True)]),
    ("canonical", [(r"^#\s?format\s?:\s?[\w-]+-1\.0", 1, True)]),
    ("usgs_rdb", [(r"(?i)waterdata\.usgs\.gov|nwisweb|^usgs", 221, True), (r"(?i)tz_cd", 221, True)]),
    ("usgs_unit", [(r"(?i)# //united states geological survey|nwis-i unit-values", 211, True), (r"(?i)tzcd", 211, True)]),
    ("usgs_csv", [(r"(?i)^#.*csv data starts at line", 33, True), (r"(?i)^iso", 60, True)]),
    ("usgs_daily", [(r"(?i)waterdata\.usgs\.gov|nwisweb|^usgs", 221, True), (r"(?i)agency_cd", 221, True), (r"(?i)tz_cd", 221, False)]),
    ("noaa", [(r"(?i)agency.*noaa|noaa.*agency|x, n, r|o, f, r, l", 121, True)]),
    ("des", [(r"(?i)result_id", 8, True), (r"(?i)row ?#", 8, True)]),
    ("des_std", [(r"(?i)^#\s?provider\s?[=:]\s?\S*-des", 7, True)]),
    ("cdec_csv1", [(r"(?i)^title:", 1, True)]),
    ("cdec_csv2", [(r"(?i)^station_id,duration,sensor_number", 1, True)]),
    ("hydstra_json", [(r"format: \S*ncro-json", 1, True)]),
    ("hydstra_csv", [(r"(?i)^#\s?provider\s?=\s?\S*-ncro", 7, True)]),
    ("wdl3", [(r'"Time', 1, True), (r'"and', 2, True)]),
    ("wdl2", [(r'"Date', 1, True), (r"Site", 2, True)]),
    ("wdl", [(r"^\d{1,4}[-/]\d{1,2}[-/]\d{1,4}[^,]*,[^,]*,[^,]*(,[^,]*)?$", 1, True)]),
]


HEAD_LINES = 1 + max(n for _, signature in SIGNATURES for _, n, _ in signature)


def describe_files(lines: DataFrame, layout: str | None = None) -> DataFrame:
    """SRC-3.  (file, layout, header line) in one aggregation by file: the first
    line at which each pattern occurs, relative to the first line of the file.

    Only the first lines of a file meet the patterns: the deepest signature looks
    at HEAD_LINES lines.  Their numbers run on inside a split, so the first number
    of each file is found first, without a pattern."""
    head = lines.filter("line_no IS NOT NULL")
    begins = head.groupBy("file").agg(F.min("line_no").alias("__first"))
    lines = with_file_facts(head, begins).filter(F.col("line_no") - F.col("__first") < HEAD_LINES).drop("__first")
    pats = sorted({p for _, sig in SIGNATURES for p, _, _ in sig}) if layout is None else []
    line, no = F.col("line"), F.col("line_no")
    seen = lines.groupBy("file").agg(
        F.min("line_no").alias("first"), *[F.min(F.when(line.rlike(p), no)).alias(f"p{i}") for i, p in enumerate(pats)],
        *[F.min_by("line", F.when(line.rlike(h), no)).alias(f"h{i}") for i, h in enumerate(HEADERS)])
    out = F.lit(layout) if layout is not None else None
    for name, sig in SIGNATURES if layout is None else ():
        fits = F.lit(True)
        for p, n, wanted in sig:
            hit = F.coalesce(F.col(f"p{pats.index(p)}") - F.col("first") < n, F.lit(False))
            fits = fits & (hit if wanted else ~hit)
        out = F.when(fits, name) if out is None else out.when(fits, name)
    found = seen.withColumn("layout", out if layout is not None else out.otherwise("any_csv"))
    return found.select("file", "layout", *[f"h{i}" for i in range(len(HEADERS))])


def detect_layout(lines: DataFrame) -> DataFrame:
    """SRC-3.  (file, layout)."""
    return describe_files(lines).select("file", "layout")


def null_tokens(text, tokens=NULL_TOKENS) -> Column:
    """SRC-4.  Tokens for a missing value to NULL."""
    t = F.trim(F.col(text) if isinstance(text, str) else text)
    return F.when(~t.isin(*tokens), t)


def strict_cast(df: DataFrame, raw: str, out="value", quarantine=False):
    """SRC-5.  Text to number.  A text that is no number is an error that names
    its file (raised while the rows are read, without a pass of its own), or the
    rows come back apart as (good, bad)."""
    number = F.col(raw).try_cast("double")
    bad = number.isNull() & F.col(raw).isNotNull()
    if quarantine:
        return df.filter(~bad).withColumn(out, number).drop(raw), df.filter(bad)
    stop = F.raise_error(F.concat(F.lit("text in a numeric column of "), F.col("file"), F.lit(": "), F.col(raw))).cast("double")
    return df.withColumn(out, F.when(bad, stop).otherwise(number)).drop(raw)


def _parse_time(text: Column) -> Column:
    """A time in one of TIME_FORMATS.  The signs of the text tell which one can fit,
    so it is tried alone: a format that fails costs far more than one that fits."""
    dashes, slashes, digits = (F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in TIME_FORMATS)
    return F.when(text.contains("/"), slashes).when(F.locate("-", text, 2) > 0, dashes).otherwise(digits)


HEADERS = sorted({l.header for l in LAYOUTS.values() if l.header})


def layout_table(spark: SparkSession) -> DataFrame:
    """The layouts as rows: one small table of fixed size."""
    pos = lambda x: x if isinstance(x, int) else None
    name = lambda x: x if isinstance(x, str) else None
    rows = [(l.name, l.sep, l.glue, [pos(t) for t in l.time], [name(t) for t in l.time], pos(l.value), name(l.value), l.pattern,
             pos(l.quality), name(l.quality), *l.quality_of, pos(l.zone), name(l.zone), HEADERS.index(l.header) + 1 if l.header else None,
             l.data, [c.strip() for c in l.codes] if l.codes is not None else None, l.pad_time) for l in LAYOUTS.values()]
    return spark.createDataFrame(rows, """layout string, sep string, glue string, ti array<int>, tn array<string>, vi int, vn string, pattern string,
        qi int, qn string, q_from string, q_to string, zi int, zn string, head int, data string, codes array<string>, pad boolean""")


def _unquoted(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.contains('"'), F.regexp_replace(t, r'^"|"$', "")).otherwise(t)


def _by_pattern(column: str, patterns, use) -> Column:
    """``use(pattern)`` of the pattern that ``column`` names: as literals they are
    compiled once, and not at every row."""
    out = None
    for p in sorted(set(patterns)):
        hit, then = F.col(column) == p, use(F.lit(p))
        out = F.when(hit, then) if out is None else out.when(hit, then)
    return out


def file_fields(described: DataFrame) -> DataFrame:
    """Where the fields are: one row per (file, sensor) with 0-based positions
    ``t0``, ``t1``, ``vpos``, ``qpos``, ``zpos`` and the rules of the layout."""
    d = described.join(F.broadcast(layout_table(described.sparkSession)), "layout")
    header = F.try_element_at(F.array(*[F.col(f"h{i}") for i in range(len(HEADERS))]), F.col("head"))
    d = d.withColumn("h", F.coalesce(F.transform(F.split(header, F.col("sep")), _unquoted), F.array().cast("array<string>")))
    at = lambda i, n: F.coalesce(i, F.nullif(F.array_position("h", n), F.lit(0)).cast("int") - 1)
    nth = lambda c, k: F.try_element_at(c, F.lit(k))
    d = d.select("file", "layout", "sep", "glue", "data", "codes", "pad", "h", "pattern", "q_from", "q_to",
                 at(nth("ti", 1), nth("tn", 1)).alias("t0"), at(nth("ti", 2), nth("tn", 2)).alias("t1"), at(F.col("zi"), F.col("zn")).alias("zpos"),
                 at(F.col("vi"), F.col("vn")).alias("vpos"), at(F.col("qi"), F.col("qn")).alias("qpos"))
    keep = ["file", "sep", "glue", "data", "codes", "pad", "t0", "t1", "zpos"]
    plain = d.filter("pattern IS NULL").select(*keep, F.lit("value").alias("sensor"), "vpos", "qpos")
    many = d.filter("pattern IS NOT NULL").drop("vpos", "qpos").select("*", F.posexplode("h").alias("vpos", "name")).filter(F.expr("name RLIKE pattern"))
    many = many.withColumn("q", F.expr("regexp_replace(name, q_from, q_to)"))
    many = many.select(*keep, F.regexp_replace("name", "_value$", "").alias("sensor"), "vpos", at(F.lit(None).cast("int"), F.col("q")).alias("qpos"))
    return plain.unionByName(many)


SMALL_BYTES = 64 << 20


def with_file_facts(lines: DataFrame, facts: DataFrame) -> DataFrame:
    """Lines with the facts of their file.  The facts are written once and
    measured: a small table is broadcast, so the text is not shuffled; a larger
    one, by many files or by wide headers, is joined by file, where adaptive
    execution splits a hot file."""
    kept = stage(facts)
    size = kept.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return lines.join(F.broadcast(kept) if size <= SMALL_BYTES else kept, "file")


def parse_lines(lines: DataFrame, described: DataFrame, tokens=None) -> DataFrame:
    """SRC-2.  Data lines of all files in one pass: file, sensor, line_no, ts,
    raw (text of the value), quality, accepted (value text or NULL).

    The layout of a line is a column; what differs between layouts is chosen by
    it.  Header lines do not look like data lines, so nothing is skipped by count.
    """
    tokens = NULL_TOKENS + STATUS_TOKENS if tokens is None else tokens
    body = with_file_facts(_placed(lines), file_fields(described))
    is_data = _by_pattern("data", [l.data for l in LAYOUTS.values()], lambda p: F.rlike("line", p))
    body = body.filter(~F.col("line").startswith("#") & is_data)
    body = body.withColumn("f", _by_pattern("sep", [l.sep for l in LAYOUTS.values()], lambda p: F.split("line", p)))
    field = lambda pos: _unquoted(F.try_element_at("f", F.col(pos) + 1))
    clock = F.when(F.col("pad") & ~field("t1").contains(":"), F.lpad(field("t1"), 4, "0")).otherwise(field("t1"))
    d = body.select("file", "sensor", "line_no", "at", "codes",
                    F.when(F.col("t1").isNull(), field("t0")).otherwise(F.concat(field("t0"), F.col("glue"), clock)).alias("t"),
                    null_tokens(field("vpos"), tokens).alias("raw"), field("qpos").alias("quality"), field("zpos").alias("zone"))
    ts = _parse_time(F.col("t"))
    hour = F.expr("INTERVAL 1 HOUR")
    blank = F.col("quality").isNull() | (F.col("quality") == "")
    ok = F.col("codes").isNull() | blank | F.array_contains("codes", F.col("quality"))
    return d.select("file", "sensor", "line_no", "at", F.when(F.col("zone") == "PDT", ts - hour).otherwise(ts).alias("ts"), "raw", "quality",
                    F.when(ok, F.col("raw")).alias("accepted"))


def read_provider(lines: DataFrame, layout: str | None = None, described: DataFrame | None = None, strict=True, tokens=None) -> DataFrame:
    """SRC-2.  All files, whatever their layouts: (file, sensor, ts, value,
    quality), first line kept where a time occurs twice in a file.

    ``layout`` names the layout of all files; ``described`` replaces what
    ``describe_files`` finds; ``tokens`` replaces the texts of missing values."""
    known = described if described is not None else describe_files(lines, layout)
    parsed = parse_lines(lines, known, tokens)
    if strict:
        d = strict_cast(parsed, "accepted")
    else:
        d = parsed.withColumn("value", F.col("accepted").try_cast("double"))
    return d.filter("ts IS NOT NULL").groupBy("file", "sensor", "ts").agg(
        F.min_by("value", "at").alias("value"), F.min_by("quality", "at").alias("quality"))


def read_canonical(spark, path, columns="datetime timestamp_ntz, value double, user_flag string", with_path=False) -> DataFrame:
    """SRC-1.  Canonical CSV files: header lines are comments.  All files of all
    series are one scan; ``with_path`` adds where a row comes from."""
    # enforceSchema off: the header must name the columns in this order, else the read fails;
    # a text that does not fit its type fails too, with the record in the message
    d = spark.read.csv(path, header=True, comment="#", schema=columns, enforceSchema=False, mode="FAILFAST")
    where = [F.col("_metadata.file_path").alias("path")] if with_path else []
    return d.select(F.col("_metadata.file_name").alias("file"), F.col("datetime").alias("ts"), *[c for c in d.columns if c != "datetime"], *where)


def header_lines(lines: DataFrame, comment="#") -> DataFrame:
    """Leading comment lines of each file: (file, line_no, line, n) with n from 0."""
    is_comment = F.col("line").startswith(comment)
    ends = lines.filter("line_no IS NOT NULL").groupBy("file").agg(
        F.min("line_no").alias("first"), F.min(F.when(~is_comment, F.col("line_no"))).alias("body"))
    h = lines.filter(is_comment).join(ends, "file").filter(F.col("body").isNull() | (F.col("line_no") < F.col("body")))
    return h.select("file", (F.col("line_no") - F.col("first")).alias("n"), "line")


def header_catalog(lines: DataFrame, comment="#") -> DataFrame:
    """SRC-6.  (file, header map, problem).  Nested lines belong to the key above
    them and are not keys.  A bad prefix or an indented first key is reported in
    ``problem``, with an empty map."""
    h = header_lines(lines, comment)
    body = F.when(F.col("line").startswith(comment + " "), F.expr(f"substr(line, {len(comment) + 2})")).when(
        F.trim("line") == comment, F.lit(""))
    key = F.regexp_extract(body, r"^([A-Za-z_][\w .-]*?)\s*:(?:\s|$)", 1)
    val = F.regexp_replace(F.trim(F.regexp_extract(body, r"^[^:]+:\s*(.*)$", 1)), r"""^['"]|['"]$""", "")
    d = h.select("file", "n", body.alias("body"), key.alias("k"), val.alias("v"))
    blank = F.trim("body") == ""
    agg = d.groupBy("file").agg(
        F.bool_or(F.col("body").isNull()).alias("prefix"),
        F.min_by("body", F.when(~blank, F.col("n"))).startswith(" ").alias("indent"),
        F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col("k") != "", F.struct("k", "v"))))).alias("header"))
    problem = F.when(F.col("prefix"), "bad_prefix").when(F.col("indent"), "indented_first_key")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return agg.select("file", F.when(problem.isNull(), F.col("header")).otherwise(empty).alias("header"), problem.alias("problem"))


# Names of types that mean text
TEXT_TYPES = ("str", "string", "object", "category", "text")
MISSING = (*NULL_TOKENS, "NaN", "nan", "NA", "NULL", "null")


def headed_files(lines: DataFrame, comment="#") -> DataFrame:
    """SRC-1.  What each canonical file says of itself: (file, head, names, dtypes).

    ``names`` are the columns in the order of the file's own header line, ``head`` is
    the number of that line, and ``dtypes`` the types declared in the leading comment
    block, nested under the key or in braces behind it."""
    head = lines.filter("line_no IS NOT NULL")
    plain = ~F.col("line").startswith(comment) & (F.trim("line") != "")
    body = F.when(F.col("line").startswith(comment), F.regexp_replace("line", f"^{comment} ?", ""))
    first = head.groupBy("file").agg(F.min(F.when(plain, F.col("line_no"))).alias("head"), F.min_by("line", F.when(plain, F.col("line_no"))).alias("__names"))
    told = head.filter(F.col("line").startswith(comment)).join(first.select("file", "head"), "file").filter(F.col("head").isNull() | (F.col("line_no") < F.col("head")))
    told = told.groupBy("file").agg(F.sort_array(F.collect_list(F.struct(F.col("line_no").alias("n"), body.alias("b")))).alias("h"))
    at = lambda which: F.array_min(F.transform(F.filter("h", which), lambda x: x["n"]))
    told = told.withColumn("__a", at(lambda x: x["b"].rlike(r"^dtypes\s*:")))
    told = told.withColumn("__z", at(lambda x: (x["n"] > F.col("__a")) & x["b"].rlike(r"^\S")))
    nested = F.filter("h", lambda x: (x["n"] >= F.col("__a")) & (F.col("__z").isNull() | (x["n"] < F.col("__z"))))
    text = F.regexp_replace(F.array_join(F.transform(nested, lambda x: x["b"]), "\n"), r"^dtypes\s*:", "")
    names, kinds = (F.expr(f"regexp_extract_all(__t, '[\"\\']?([A-Za-z_][A-Za-z0-9_.-]*)[\"\\']?[ ]*:[ ]*[\"\\']?([A-Za-z0-9_]+)', {i})") for i in (1, 2))
    told = told.withColumn("__t", text).withColumn("__n", names).withColumn("__k", F.transform(kinds, F.lower))
    last = F.transform(F.array_distinct("__n"), lambda n: F.struct(n.alias("k"), F.element_at("__k", (F.size("__n") + 1 - F.array_position(F.reverse("__n"), n)).cast("int")).alias("v")))
    told = told.select("file", F.map_from_entries(last).alias("dtypes"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return first.join(told, "file", "left").select("file", "head", F.transform(_fields(F.col("__names")), _unquoted).alias("names"), F.coalesce("dtypes", none).alias("dtypes"))


def _fields(line: Column) -> Column:
    """Fields of a line; a comma inside quotes does not part them."""
    return F.when(line.contains('"'), F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')).otherwise(F.split(line, ","))


def read_headed(lines: DataFrame, comment="#", time="datetime", value="value", flag="user_flag") -> tuple[DataFrame, DataFrame]:
    """SRC-1.  Canonical files, each read by its own header, in one scan: (rows, quarantine).

    Rows: file, ts, value, user_flag, and maps ``numbers`` and ``texts`` of all other
    columns by name, texts being those whose declared type is one.  A file may have its
    columns in any order and lack the flag or the value.  A record that cannot be read is
    not an error: it is a row (file, at, line, reason) of the quarantine, and a file
    without a time column is there record by record."""
    facts = headed_files(lines, comment)
    known = with_file_facts(_placed(lines), facts).filter(~F.col("line").startswith(comment) & (F.trim("line") != "") & ~F.col("line_no").eqNullSafe(F.col("head")))
    d = known.withColumn("f", F.transform(_fields(F.col("line")), _unquoted))
    named = lambda n: F.try_element_at("f", F.nullif(F.array_position("names", n), F.lit(0)).cast("int"))
    told = lambda n: F.coalesce(F.try_element_at("dtypes", n).isin(*TEXT_TYPES), F.lit(False))
    cells = F.transform(F.arrays_zip(F.col("names").alias("n"), F.col("f").alias("t")), lambda x: F.struct(x["n"].alias("n"), null_tokens(x["t"], MISSING).alias("t")))
    d = d.withColumn("cells", F.filter(cells, lambda x: x["n"] != time))
    is_text = lambda x: told(x["n"])
    odd = F.filter("cells", lambda x: ~is_text(x) & x["t"].isNotNull() & x["t"].try_cast("double").isNull())
    stamp = _parse_time(named(time))
    reason = (F.when(~F.array_contains("names", time), F.lit("no time column")).when(F.size("f") != F.size("names"), F.lit("wrong number of fields"))
              .when(stamp.isNull(), F.lit("bad time")).when(F.size(odd) > 0, F.concat(F.lit("text in numeric column "), F.try_element_at(odd, F.lit(1))["n"])))
    d = d.withColumn("ts", stamp).withColumn("reason", reason)
    number = lambda n: null_tokens(named(n), MISSING).try_cast("double")
    others = lambda text: F.filter("cells", lambda x: ~x["n"].isin(value, flag) & (is_text(x) if text else ~is_text(x)))
    pairs = lambda cells, cast: F.map_from_arrays(F.transform(cells, lambda x: x["n"]), F.transform(cells, cast))
    good = d.filter("reason IS NULL").select(
        "file", "ts", number(value).alias("value"), number(flag).cast("tinyint").alias("user_flag"),
        pairs(others(False), lambda x: x["t"].try_cast("double")).alias("numbers"), pairs(others(True), lambda x: x["t"]).alias("texts"))
    return good, d.filter("reason IS NOT NULL").select("file", "at", "line", "reason")
