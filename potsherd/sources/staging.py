"""Reading exported source tables, their metadata, reference lists and file listings into staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from potsherd.functions.values import title_case
from potsherd.sources import csv_ranges

#: Extensions of the files that are read as pictures, drawings or reports.
EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".tif", ".tiff", ".bmp", ".pdf", ".doc", ".docx")
#: A table needs so many rows to be read.
LEAST_ROWS = 2


def source_path() -> Column:
    return F.col("_metadata.file_path")


def file_parts(path: Column) -> tuple[Column, Column, Column]:
    """(project, database, table) of ``.../PROJECT.../database/table.csv``: the project is the leading letters and digits of the folder."""
    pieces = F.split(path, "/")
    table = F.regexp_replace(F.element_at(pieces, -1), r"\.[^.]*$", "")
    return F.regexp_extract(F.element_at(pieces, -3), "^([A-Z0-9]+)", 1), F.element_at(pieces, -2), table


def read_exports(spark: SparkSession, pattern: str, bron: str, loadtime: str, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Rows of CSV files ``<project folder>/<database>/<table>.csv`` of any shape, one staging row each.

    Columns: _id, _seq, table, projectcd, bron, loadtime, mdbfile, data (map<string,string> without blank values). Files with
    fewer than ``least_rows`` rows are left out. A file's header applies to its own rows; names that it repeats get a number
    (``a``, ``a_2``). Values may hold line breaks in quotes, and a large file is read by many tasks (see ``csv_ranges``).
    Values beyond the header are left out, missing ones are null; a mark of the byte order before a header is no part of it.
    """
    read = csv_ranges.records(spark, pattern).where(F.col("n") > least_rows)
    clean = guarded(F.rtrim(F.replace("text", F.lit("\r\n"), F.lit("\n")), F.lit("\r")))
    heads = read.where("at = 0").select(F.col("path").alias("_of"), csv_ranges.numbered_names(fields(F.regexp_replace(clean, "^\ufeff", ""))).alias("names"))
    each = read.where("at > 0").select("path", "file", "at", clean.alias("row")).join(heads, F.col("path") == F.col("_of"))
    project, database, table = file_parts(F.col("path"))
    pairs = F.filter(F.arrays_zip(F.col("names").alias("n"), fields(F.col("row")).alias("v")), lambda p: p.n.isNotNull() & (F.coalesce(F.trim(p.v), F.lit("")) != ""))
    return each.select(
        F.sha2(F.concat_ws("|", "path", (F.col("at") - 1).cast("string")), 256).alias("_id"),
        (F.col("file") * F.lit(1 << 31) + F.col("at") - 1).alias("_seq"),
        table.alias("table"),
        project.alias("projectcd"),
        F.lit(bron).alias("bron"),
        F.lit(loadtime).cast("timestamp").alias("loadtime"),
        database.alias("mdbfile"),
        F.map_from_entries(F.transform(pairs, lambda p: F.struct(p.n, p.v))).alias("data"),
    )


#: Stand for commas and line breaks within quotes; private characters that exports don't hold.
COMMA, LINE = "\ue000", "\ue001"


def guarded(text: Column) -> Column:
    """CSV text with the commas and line breaks within quotes replaced. Of the parts between quotes every second one is quoted; doubled quotes leave it so."""
    return F.array_join(F.transform(F.split(text, '"', -1), lambda part, k: F.when(k % 2 == 1, F.translate(part, ",\n", COMMA + LINE)).otherwise(part)), '"')


def fields(line: Column) -> Column:
    """The values of a guarded CSV line; quotes around a value go, doubled ones within become one."""
    inner = lambda t: F.replace(F.substr(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))
    quoted = lambda t: (F.length(t) > 1) & F.startswith(t, F.lit('"')) & F.endswith(t, F.lit('"'))
    return F.transform(F.split(line, ",", -1), lambda p: F.translate(F.when(quoted(F.trim(p)), inner(F.trim(p))).otherwise(p), COMMA + LINE, ",\n"))


def from_table(df: DataFrame, table: str, order: str, bron: str = "tables", projectcd: Column | None = None) -> DataFrame:
    """A table with columns as staging rows: every column that isn't blank becomes an entry of ``data``."""
    entries = F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).cast("string").alias("v")) for c in df.columns])
    full = F.filter(entries, lambda p: F.coalesce(F.trim(p.v), F.lit("")) != "")
    return df.select(
        F.concat_ws(":", F.lit(table), F.col(order).cast("string")).alias("_id"),
        F.col(order).cast("bigint").alias("_seq"),
        F.lit(table).alias("table"),
        (projectcd if projectcd is not None else F.lit(None)).cast("string").alias("projectcd"),
        F.lit(bron).alias("bron"),
        F.map_from_entries(full).alias("data"),
    )


def list_items(text: Column) -> Column:
    """The items of a list that was written as text, like ``['a', "b", 3]``; null if it is none."""
    return F.from_json(F.replace(text, F.lit("'"), F.lit('"')), "array<string>")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(name, table, projectcd, teller, props) of metadata documents in JSON, one a line."""
    known = "name string, table string, projectcd string, teller bigint"
    read = spark.read.text(path)
    props = F.from_json("value", "map<string,string>")
    return read.select(F.from_json("value", known).alias("m"), F.map_filter(props, lambda k, _: ~k.isin("name", "table", "projectcd", "teller")).alias("props")).select("m.*", "props")


def metadata_of(df: DataFrame, table: str, projectcd: str) -> DataFrame:
    """The same for a DataFrame, from its schema."""
    rows = [(f.name, table, projectcd, k, {"type": f.dataType.simpleString(), "nullable": str(f.nullable).lower()}) for k, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "name string, table string, projectcd string, teller bigint, props map<string,string>")


def read_thesaurus(rows: DataFrame, uri: str = "uri", titled: tuple[str, ...] = ("concept", "label")) -> DataFrame:
    """The entries of a reference list that have a web address, two of its columns in title case."""
    return rows.where(F.col(uri).contains("https")).withColumns({c: title_case(F.col(c)) for c in titled if c in rows.columns})


def appended(df: DataFrame, more: DataFrame) -> DataFrame:
    """Both tables one after the other; columns that one lacks are null."""
    return df.unionByName(more, allowMissingColumns=True)


def list_files(spark: SparkSession, root: str, extensions: tuple[str, ...] = EXTENSIONS, containing: str = "") -> DataFrame:
    """(path, fullFileName, fileName, directory, fileType, fileSize) of the files below a folder, their content left unread."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return described_files(read.select("path", F.col("length").alias("fileSize")), root, extensions, containing)


def described_files(paths: DataFrame, root: str = "", extensions: tuple[str, ...] = EXTENSIONS, containing: str = "") -> DataFrame:
    """The same from a table of paths (and sizes)."""
    relative = F.regexp_replace("path", rf"^.*?{root.rstrip('/').split('/')[-1]}(?=/)" if root else "^file:", "")
    named = paths.withColumn("fullFileName", relative).withColumn("fileName", F.element_at(F.split("fullFileName", "/"), -1))
    typed = named.withColumn("directory", F.regexp_replace("fullFileName", "/[^/]*$", "")).withColumn("fileType", F.lower(F.regexp_extract("fileName", r"(\.[^.]+)$", 1)))
    return typed.where(F.col("fileType").isin(*extensions) & F.col("fullFileName").contains(containing))


def to_process(files: DataFrame, wanted: DataFrame | None = None, done: DataFrame | None = None, seed: int = 7) -> DataFrame:
    """The listed files that are wanted and not yet done, dealt evenly over the partitions; a tif or pdf with a jpg beside it is left out."""
    out = files
    if wanted is not None:
        out = out.join(wanted.select(F.col("fullFileName").alias("_w")).distinct(), F.col("fullFileName") == F.col("_w"), "left_semi")
    if done is not None:
        out = out.join(done.select(F.col("fullFileName").alias("_d")).distinct(), F.col("fullFileName") == F.col("_d"), "left_anti")
    stem = F.regexp_replace("fullFileName", r"\.[^./]*$", "")
    pictures = files.where(F.col("fileType").isin(".jpg", ".jpeg")).select(stem.alias("_s")).distinct()
    doubled = F.when(F.col("fileType").isin(".tif", ".tiff", ".pdf"), stem)
    return out.join(pictures, doubled == F.col("_s"), "left_anti").orderBy(F.rand(seed))
