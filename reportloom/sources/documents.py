"""Documents in and out."""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ..workspace import fresh_dir
from .manifests import mounted_at

SHELF = 1000  # files per folder
READERS = 200  # tasks that read a folder, at least, if it has so many files
TASK_BYTES = 64 << 20  # of files that one of them reads, beyond that number
BATCH_BYTES = 4 << 20  # of texts, or names, that leave Python together


def read_documents(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """One row per file of a folder tree: path and whole text. The files are those that are there now.

    Spark's reader holds every name on the driver. Where the folder is mounted on all machines, tasks list it, level by level, and read
    the files, which are the same: not those with hidden names or nothing in them. Compressed files, a pattern of folders
    and folders elsewhere are left to Spark's reader.
    """
    root = None if re.search(r"[{}\[\]*?\\]", folder) else mounted_at(spark, folder)
    if root is not None:
        files = _files_below(spark, root, glob)
        n, size, packed = files.agg(F.count("*"), F.sum("size"), F.bool_or(_compressed(spark, F.col("path").cast("string")))).first()
        if not packed:
            tasks = max(1, min(n, max(_readers(spark), -(-(size or 0) // TASK_BYTES))))
            texts = files.select("path").repartition(tasks).mapInArrow(_texts(), "path string, text binary")
            return texts.select("path", F.col("text").cast("string").alias("text"))
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(folder, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
        .coalesce(_readers(spark))  # Spark counts 4 MB for opening a file, so that a task would have a few small ones only
    )


def _readers(spark: SparkSession) -> int:
    return max(READERS, 8 * spark.sparkContext.defaultParallelism)


def _files_below(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(path, size) of the files of a mounted folder and the folders below it, as tasks list them: a job for each level of folders."""
    listing, level = fresh_dir(spark, "listing"), 0
    regex = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    folders, n = spark.createDataFrame([(os.fsencode(root),)], "path binary"), 1
    while n:
        found = folders.repartition(min(n, _readers(spark))).mapInArrow(_entries(regex), "path binary, size bigint")
        found.write.parquet(f"{listing}/level={level}")
        found = spark.read.schema(found.schema).parquet(f"{listing}/level={level}")
        folders, level = found.where("size IS NULL").select("path"), level + 1
        n = folders.count()
    return spark.read.schema("path binary, size bigint").parquet(listing).where("size IS NOT NULL").select("path", "size")


def _entries(regex: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Folders to their entries that Spark's reader would see: files whose names match, and folders, which have no size."""

    def hidden(name: str, is_folder: bool) -> bool:
        if name.startswith("_") and "=" not in name:
            return not (is_folder and name.startswith(("_metadata", "_common_metadata")))
        return name.startswith(".") or name.endswith("._COPYING_")

    def listed(folder: bytes) -> Iterator[tuple[bytes, int | None]]:
        with os.scandir(folder) as entries:
            for entry in entries:
                name, is_folder = os.fsdecode(entry.name), entry.is_dir()
                if hidden(name, is_folder):
                    continue
                if is_folder:
                    yield entry.path, None
                elif re.fullmatch(regex, name, re.DOTALL):
                    try:
                        size = entry.stat().st_size
                    except FileNotFoundError:  # gone, or a link to nowhere
                        continue
                    if size:
                        yield entry.path, size

    def table(rows: list[tuple[bytes, int | None]]) -> pa.RecordBatch:
        paths, sizes = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(sizes, pa.int64())], ["path", "size"])

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for row in (entry for folder in batch["path"].to_pylist() for entry in listed(folder)):
                rows.append(row)
                held += len(row[0])
                if held >= BATCH_BYTES:
                    yield table(rows)
                    rows, held = [], 0
            if rows:
                yield table(rows)

    return tables


def _texts() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Paths to paths, written as Spark writes them, and the bytes of their files."""

    def escaped(found: re.Match) -> str:
        letter = found[0]
        plain = letter > "\x7f" and unicodedata.category(letter) not in ("Cc", "Zs", "Zl", "Zp")
        return letter if plain else quote(letter)

    def uri(path: bytes) -> str:
        return "file:" + re.sub(r"[^a-zA-Z0-9_/.!~'()*:@&=+$,;-]", escaped, path.decode("utf-8", "replace"))

    def table(paths: list[str], texts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], ["path", "text"])

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, texts, held = [], [], 0
            for path in batch["path"].to_pylist():
                with open(path, "rb") as file:
                    texts.append(file.read())
                paths.append(uri(path))
                held += len(texts[-1])
                if held >= BATCH_BYTES:
                    yield table(paths, texts)
                    paths, texts, held = [], [], 0
            if paths:
                yield table(paths, texts)

    return tables


def _compressed(spark: SparkSession, path: Column) -> Column:
    """Is the file named as one that Spark's reader unpacks?"""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    codecs = hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    ends = sorted({hadoop.util.ReflectionUtils.newInstance(codec, conf).getDefaultExtension().lower() for codec in codecs})
    return F.lower(path).rlike("(" + "|".join(map(re.escape, ends)) + ")$")


def write_documents(documents: DataFrame, folder: str, by: str, id: str, text: str) -> str:
    """Text files of a line end more than their text, named <id>=... and filed below folders <by>=...; read_documents finds them.

    Rows of the same names share a file if one task writes them. Spark's writers name folders, not files, so one file each takes a
    folder each there, made, moved and listed one by one; tasks name the files themselves where the folder is mounted on all machines.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(by).alias("by"), F.col(id).alias("id"), F.col(text).cast("string").alias("value"))
    made = f"{folder}/_made"  # Spark makes the folder, and tells where it is; names with _ are not read
    spark.range(1).select(F.lit("").alias("value")).coalesce(1).write.text(made)
    at = urlsplit(spark.read.text(made).inputFiles()[0].rsplit("/_made/", 1)[0])
    if at.scheme == "file":
        ordered = rows.withColumn("value", F.col("value").cast("binary")).sortWithinPartitions("by", "id")
        ordered.foreachPartition(_files(unquote(at.path), by, id))
    else:
        rows.withColumnsRenamed({"by": by, "id": id}).write.mode("append").partitionBy(by, id).text(folder)
    return folder


def _named(key: str, value: object) -> str:
    """A name as Spark's writers give it to the folder of a value."""
    escaped = re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda c: f"%{ord(c[0]):02X}", "" if value is None else str(value))
    return f"{key}={escaped or '__HIVE_DEFAULT_PARTITION__'}"


def _files(root: str, by: str, id: str) -> Callable[[Iterator[Row]], None]:
    """Writes the ordered rows of a task. A task that runs again writes the same files, each of them whole or not at all."""

    def write(rows: Iterator[Row]) -> None:
        if not os.path.isdir(root):
            raise FileNotFoundError(f"{root} is not mounted here")
        task, run = TaskContext.get().partitionId(), uuid.uuid4().hex
        for under, shelved in groupby(rows, lambda row: _named(by, row.by)):
            for n, (name, same) in enumerate(groupby(shelved, lambda row: _named(id, row.id))):
                shelf = f"{root}/{under}/shelf={task:05d}-{n // SHELF:05d}"
                if n % SHELF == 0:
                    os.makedirs(shelf, exist_ok=True)
                with open(f"{shelf}/.{run}", "wb") as file:
                    file.writelines((row.value or b"") + b"\n" for row in same)
                os.replace(f"{shelf}/.{run}", f"{shelf}/{name}.txt")

    return write


def with_sizes(documents: DataFrame, text: str = "text") -> DataFrame:
    """Letters and whitespace-separated words of each document."""
    words = F.when(F.trim(text) == "", 0).otherwise(F.size(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")))
    return documents.withColumns({"chars": F.length(text), "words": words})
