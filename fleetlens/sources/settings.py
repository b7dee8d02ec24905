"""Settings files: sectioned, section-less and layered.

A file is read whole, as one row, and cut up by column expressions, so section
headers reach their lines without a window or a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.errors import AnalysisException

from ..functions.text import LINE_BREAK, explode_lines, is_blank, lines, strip
from ..operators.carry import carry_down
from ..operators.settings import DROP_IN, FILE_DEFAULTS, MAIN_FILE
from .listing import can_list, file_uri, list_files

DEFAULT_SECTION = "DEFAULT"  # fixed value: its entries hold in every section
_JOINED = "\x00"


def empty_files(spark: SparkSession, *paths: str, **options: str) -> DataFrame:
    """(file) of the files without content, which Spark's file sources pass over.

    Tasks list the folders. Only for a file system that ``pyarrow.fs`` does not know the names come from Spark's own
    listing, as those that a read of names alone does not give.
    """
    if can_list(spark, *paths):
        recursive = options.get("recursiveFileLookup", "false") == "true"
        return list_files(spark, *paths, recursive=recursive).filter("length = 0").select(file_uri().alias("file"))
    source = spark.read.format("binaryFile").options(**options).load(list(paths))
    filled = source.select(F.col("_metadata.file_path").alias("file"))
    # Both are the same listing; only the number of slashes behind the scheme may differ.
    one_slash = F.regexp_replace("file", r"\A([A-Za-z0-9+.-]+:)/+(?=/)", "$1")
    listed = spark.createDataFrame([(name,) for name in source.inputFiles()], "file string")
    return listed.select(one_slash.alias("file")).join(filled.select(one_slash.alias("file")), "file", "left_anti")


def read_files(spark: SparkSession, *paths: str, optional: bool = False) -> DataFrame:
    """(file, text), one row per file, also of an empty one.

    Where no path exists at all, ``optional`` gives no rows instead of an error.
    """
    try:
        source = spark.read.text(list(paths), wholetext=True)
    except AnalysisException as error:
        if optional and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "file string, text string")
        raise
    filled = source.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return filled.unionByName(empty_files(spark, *paths).withColumn("text", F.lit("")))


def _entries(body: Column) -> Column:
    """Section text as an array of entry lines; continuation lines are joined on."""
    breaks = f"(?:{LINE_BREAK})"
    no_comments = F.regexp_replace(body, rf"(?:\A|(?<={breaks}))[ \t]*[#;][^\n\r]*", "")
    joined = F.regexp_replace(no_comments, rf"(?:{breaks}[ \t]*)*{breaks}[ \t]+(?=\S)", _JOINED)
    return F.filter(lines(joined), lambda line: ~is_blank(line))


def parse_section(files: DataFrame, section: str) -> DataFrame:
    """Entries of one section: (every other column, seq, key, value, from_default).

    Keys are lower-cased and end at the first ``=`` or ``:``. A bare key reads as
    ``true``. Nothing is substituted inside values.
    """
    rest = [name for name in files.columns if name != "text"]
    header = r"\A\[([^\]\r\n]+)\]"
    chunks = F.split("text", rf"(?:\A|(?<=[\n\r]))(?=\[[^\]\r\n]+\])")
    # Outer generators and filters on what they give: the text is cut once.
    cut = files.select(*rest, F.posexplode_outer(chunks).alias("_chunk", "_body")).withColumn(
        "_section", F.regexp_extract("_body", header, 1)
    )
    body = F.regexp_replace("_body", header + r"[^\n\r]*(?:\r\n|[\n\r])?", "")
    entries = (
        cut.filter(F.col("_section").isin(section, DEFAULT_SECTION))
        .select(*rest, "_chunk", "_section", F.posexplode_outer(_entries(body)).alias("_at", "_entry"))
        .filter(F.col("_at").isNotNull())
    )
    return entries.select(
        *rest,
        (F.col("_chunk").cast("bigint") * (1 << 32) + F.col("_at")).alias("seq"),
        *_pair("_entry"),
        (F.col("_section") == DEFAULT_SECTION).alias("from_default"),
    )


def parse_section_of_lines(line_table: DataFrame, section: str, by: Sequence[str] = ("file",)) -> DataFrame:
    """The same over a table of numbered lines (by, line_no, line), for files cut into any number of rows.

    Section headers are carried down to their lines, and so are the lines that begin an entry to those that go on
    with it; a file that holds a third of all lines is cut into blocks like any other. ``seq`` is the number of
    the entry's first line.
    """
    by = list(by)
    line = F.col("line")
    name = F.regexp_extract(line, r"\A\[([^\]\r\n]+)\]", 1)
    header = F.when(name != "", F.struct(F.col("line_no").alias("starts"), name.alias("name")))
    placed = carry_down(line_table.select(*by, "line_no", "line"), header, by, "line_no", "_section")
    body = placed.filter(
        F.col("_section.name").isin(section, DEFAULT_SECTION)
        & (F.col("line_no") > F.col("_section.starts"))
        & ~line.rlike(r"\A[ \t]*[#;]")
        & ~is_blank(line)
    ).select(*by, F.col("_section.starts").alias("_starts"), F.col("_section.name").alias("_name"), "line_no", "line")
    goes_on = line.rlike(r"\A[ \t]")
    entries = carry_down(body, F.when(~goes_on, F.col("line_no")), [*by, "_starts"], "line_no", "_entry_no")

    def joined(held: Column, at: Column) -> Column:
        return F.when(at == 0, held["line"]).otherwise(F.regexp_replace(held["line"], r"\A[ \t]+", ""))

    text = F.array_join(F.transform("_lines", joined), _JOINED)
    return (
        entries.groupBy(*by, "_starts", "_name", "_entry_no")
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_lines"))
        .select(*by, F.get("_lines", F.lit(0))["line_no"].cast("bigint").alias("seq"), "_name", text.alias("_entry"))
        .select(*by, "seq", *_pair("_entry"), (F.col("_name") == DEFAULT_SECTION).alias("from_default"))
    )


def _pair(entry: str) -> list[Column]:
    """Key and value of an entry's text."""
    pair = r"(?s)\A([^=:]*)(?:([=:])(.*))?\z"
    value = F.when(F.regexp_extract(entry, pair, 2) == "", "true").otherwise(
        strip(F.replace(F.regexp_extract(entry, pair, 3), F.lit(_JOINED), F.lit("\n")))
    )
    return [F.lower(strip(F.regexp_extract(entry, pair, 1))).alias("key"), value.alias("value")]


def read_settings(spark: SparkSession, main: str, section: str, run_id: str = "") -> DataFrame:
    """A main settings file and its drop-ins ``<main>.d/*.conf``, as far as there are any.

    Gives the (run_id, layer, file, seq, key, value) rows that
    ``effective_settings`` resolves; without any file, none.
    """
    files = read_files(spark, f"{main}{{,.d/*.conf}}", optional=True)
    name = main.rsplit("/", 1)[-1]
    return section_settings(files, section, F.substring_index("file", "/", -1) == name, F.lit(run_id))


def read_large_settings(spark: SparkSession, main: str, section: str, run_id: str = "") -> DataFrame:
    """``read_settings`` for files of any size: read in blocks by many tasks, never as one value."""
    from .reports import read_report_lines

    lines_ = read_report_lines(spark, f"{main}{{,.d/*.conf}}").withColumnRenamed("report_id", "file")
    name = main.rsplit("/", 1)[-1]
    return section_settings_of_lines(lines_, section, F.substring_index("file", "/", -1) == name, F.lit(run_id))


def section_settings(files: DataFrame, section: str, is_main: Column, run_id: Column) -> DataFrame:
    """Settings rows of sectioned files (file, text).

    Entries of the default section lie below those of the section, but are still
    set by a file: their old keys are renamed as well.
    """
    return _layered(parse_section(files, section), is_main, run_id)


def section_settings_of_lines(
    line_table: DataFrame, section: str, is_main: Column, run_id: Column, by: Sequence[str] = ("file",)
) -> DataFrame:
    """The same of lines (by, line_no, line) of sectioned files."""
    return _layered(parse_section_of_lines(line_table, section, by), is_main, run_id)


def _layered(entries: DataFrame, is_main: Column, run_id: Column) -> DataFrame:
    return entries.select(
        run_id.alias("run_id"),
        F.when(F.col("from_default"), FILE_DEFAULTS).when(is_main, MAIN_FILE).otherwise(DROP_IN).alias("layer"),
        "file",
        "seq",
        "key",
        "value",
    )


def parse_pairs(files: DataFrame) -> DataFrame:
    """``KEY="value"`` files without sections: (every other column, seq, key, value).

    Lines without ``=`` are passed over. The value is stripped and then loses its
    first and last character, whatever they are.
    """
    rest = [name for name in files.columns if name != "text"]
    parts = F.split("_line", "=", 2)
    value = strip(F.get(parts, F.lit(1)))
    return (
        explode_lines(files.filter(F.col("text").contains("=")), "text", "_line", "_at", first=0)
        .filter(F.col("_line").contains("="))
        .select(
            *rest,
            F.col("_at").cast("bigint").alias("seq"),
            F.get(parts, F.lit(0)).alias("key"),
            value.substr(F.lit(2), F.greatest(F.length(value) - 2, F.lit(0))).alias("value"),
        )
    )


def read_pairs(spark: SparkSession, *paths: str) -> DataFrame:
    """Section-less files from storage: (file, seq, key, value)."""
    return parse_pairs(read_files(spark, *paths))


def read_service_settings(spark: SparkSession, paths: Sequence[str], run_id: str = "") -> DataFrame:
    """Service settings in layers, each path over the one before it; a missing path adds none."""
    layers = [
        service_settings(read_files(spark, path, optional=True), F.lit(number), F.lit(run_id))
        for number, path in enumerate(paths)
    ]
    return reduce(DataFrame.unionByName, layers)


def service_settings(files: DataFrame, layer: Column, run_id: Column) -> DataFrame:
    """Settings rows of ``key=value`` files (file, text).

    Comments and lines without ``=`` are passed over, and quotes around a value
    are dropped only where there are some.
    """
    parts = F.split("_line", "=", 2)
    value = F.regexp_replace(strip(F.get(parts, F.lit(1))), r"""\A(["'])(.*)\1\z""", "$2")
    return (
        explode_lines(files, "text", "_line", "_at", first=0)
        .filter(F.col("_line").contains("=") & ~strip(F.col("_line")).startswith("#"))
        .select(
            run_id.alias("run_id"),
            layer.alias("layer"),
            "file",
            F.col("_at").cast("bigint").alias("seq"),
            strip(F.get(parts, F.lit(0))).alias("key"),
            value.alias("value"),
        )
    )
