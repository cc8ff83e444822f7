"""Delimited text in."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.cleaning import CLEAN_NAMES, FRENCH_COLUMNS
from ..operators.reshape import stack
from .manifests import children


def all_strings(names: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


RAW_SCHEMA = all_strings([*CLEAN_NAMES, *FRENCH_COLUMNS])


def read_delimited(
    spark: SparkSession, path: str, sep: str = "\t", schema: StructType | None = None, glob: str = "*"
) -> DataFrame:
    """Header line, every column a string, folders read at any depth.

    Without a schema the names come from the header of one file. A file whose header differs from
    the schema is an error, never a silent shift of columns.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.option("enforceSchema", False).schema(schema or reader.csv(path).schema).csv(path)


def _files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Path and modification time of each file, at any depth; the contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path", "modificationTime")
    )


def _newest(spark: SparkSession, folder: str, glob: str) -> str:
    newest = F.max_by("path", F.struct("modificationTime", "path"))
    path = _files(spark, folder, glob).agg(newest).first()[0]
    if path is None:
        raise FileNotFoundError(f"no {glob} files found under {folder}")
    return path


def newest_file(spark: SparkSession, folder: str, glob: str = "*.tsv") -> str:
    """The file modified last, looked for in all subfolders."""
    return _newest(spark, folder, glob)


def newest_drop(spark: SparkSession, folder: str, glob: str = "*.csv") -> str:
    """The folder that holds the file modified last, for deliveries made of many part files in a folder of their own."""
    return _newest(spark, folder, glob).rsplit("/", 1)[0]


def _headers(spark: SparkSession, folders: Sequence[str]) -> list[list[str]]:
    """Paths to read together: the folders, if all files begin with the same line, else the files of each header line.

    Only a file's first split can hold its header, so the first line read there is the header. File names reach the driver
    only where headers differ.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(list(folders)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    found = lines.filter("start = 0").groupBy("file").agg(F.first("value").alias("header"))
    if len(found.select("header").distinct().limit(2).collect()) < 2:
        return [list(folders)]
    names = found.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [row.files for row in names.orderBy("header").collect()]


def read_parts(spark: SparkSession, *folders: str, schema: StructType | str | None = None, one_header: bool = False) -> DataFrame:
    """CSV part files of one or more folders, at any depth, stacked by column name; absent columns become null.

    Files are grouped by their header line first, so that files of one folder may name their columns in any
    order. That reads the text once more; `one_header` says that the files of each folder agree, and one that
    does not is then an error. Types are inferred, which costs a pass; give a schema for large inputs.
    """
    groups = [[folder] for folder in folders] if one_header else _headers(spark, folders)
    parts = []
    for paths in groups:
        reader = spark.read.option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True)
        if schema is None:
            parts.append(reader.option("inferSchema", True).csv(paths))
            continue
        wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        names = reader.csv(paths[0]).columns
        known = {field.name: field for field in wanted}
        stated = StructType([known.get(name, StructField(name, StringType())) for name in names])
        parts.append(reader.schema(stated).csv(paths).select(*[name for name in names if name in known]))
    return stack(*parts)


def latest_label(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows of the greatest label.

    On a table partitioned by it first, the label comes from the names of the table's folders (one file's path shows where
    they are), so no file list is made, and only that partition is read.
    """
    spark = df.sparkSession
    mark = f"/{label}="
    try:
        some = df.select(F.col("_metadata.file_path")).first()
    except AnalysisException:  # not a table of files
        some = None
    if some is not None and mark in some[0] and "=" not in some[0].split(mark)[0].rsplit("/", 1)[-1]:
        names = [unquote(name.removeprefix(mark[1:])) for name in children(spark, unquote(some[0].split(mark)[0])) if name.startswith(mark[1:])]
        known = [name for name in names if name != "__HIVE_DEFAULT_PARTITION__"]
        return df.filter(F.col(label) == max(known)) if known else df.limit(0)
    return df.filter(F.col(label) == df.agg(F.max(label)).scalar())


def read_status(df: DataFrame, empty_message: str = "No records") -> DataFrame:
    """One row: record count, a flag that is 1 when nothing came, and a message."""
    return df.agg(F.count("*").alias("records")).select(
        "records",
        F.when(F.col("records") == 0, 1).otherwise(0).alias("flag"),
        F.when(F.col("records") == 0, empty_message)
        .otherwise(F.concat(F.lit("Records Retrieved: "), F.col("records").cast("string")))
        .alias("message"),
    )
