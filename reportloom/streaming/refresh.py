"""Roll-ups kept up to date as report drops land."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.periods import quarter_label
from ..operators.aggregates import monthly_summary
from ..operators.cleaning import clean_reports
from ..sources.delimited import read_delimited
from ..sources.manifests import children, delete_folder, latest, publish

UNDATED = "undated"
MONTHLY_SCHEMA = "label string, version string, year int, month int, total_loss decimal(38,6), total_victims bigint"
_MANIFEST = "label string, drop string, version string"


def _published(spark: SparkSession, out: str) -> dict[str, tuple[str, str]]:
    """Per quarter, the drop it was taken from and the version of its files: one row per calendar quarter."""
    _, rows = latest(spark, f"{out}/_manifest")
    return {row["label"]: (row["drop"], row["version"]) for row in rows}


def _replace(df: DataFrame, path: str) -> None:
    """Write the label and version folders that occur in `df`; AQE splits a label with very many rows."""
    writer = df.hint("rebalance", F.col("label")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("label", "version").parquet(path)


def _current(table: DataFrame, published: dict[str, tuple[str, str]]) -> DataFrame:
    """The published version of each quarter, chosen by folder names."""
    wanted = [f"{label}/{version}" for label, (_, version) in sorted(published.items())]
    return table.filter(F.concat_ws("/", "label", "version").isin(wanted))


def remove_superseded(spark: SparkSession, out: str) -> None:
    """Delete the versions that no quarter uses any more; a reader that began before the last refresh keeps its files."""
    published = {(label, version) for label, (_, version) in _published(spark, out).items()}
    for name in ("clean", "monthly"):
        for label in children(spark, f"{out}/{name}"):
            if label.startswith("label="):
                for version in children(spark, f"{out}/{name}/{label}"):
                    if (unquote(label.removeprefix("label=")), version.removeprefix("version=")) not in published:
                        delete_folder(spark, f"{out}/{name}/{label}/{version}")


def refresh_summaries(
    spark: SparkSession,
    src: str,
    out: str,
    checkpoint: str,
    glob: str = "*.csv",
    country_sentinel: str | None = "Not Specified",
) -> None:
    """Take the drops that arrived since the last run and replace the quarters they contain.

    A drop is an entry of `src`: a file, or a folder of part files. It states its quarters in full, so of all drops that
    have a quarter, in this run or an earlier one, the one with the greatest name counts: an older drop that arrives late
    changes nothing. The clean rows and the monthly sums of the replaced quarters are written as a new version beside the
    published one; a manifest that names drop and version of each quarter is written last, so both tables change at once.
    Only the replaced quarters are summed again. Repeating a batch after a failure gives the same files.
    Versions that a run has replaced are deleted by the run after it.
    """
    remove_superseded(spark, out)
    empty = spark.createDataFrame([], MONTHLY_SCHEMA)
    empty.write.mode("ignore").partitionBy("label", "version").parquet(f"{out}/monthly")
    root = re.escape(src.rstrip("/").rsplit("/", 1)[-1])

    def replace_quarters(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = clean_reports(batch, country_sentinel).withColumn(
            "label", F.coalesce(quarter_label("date"), F.lit(UNDATED))
        )
        # the text is parsed once, into a folder that a repeated batch overwrites
        version = f"{session.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        staging = f"{out}/staging/{version}"
        rows.write.mode("overwrite").parquet(staging)
        rows = session.read.schema(rows.schema).parquet(staging)
        # One row per calendar quarter in the drops, so collecting it is bounded.
        found = rows.groupBy("label").agg(F.max("drop").alias("drop")).collect()
        published = _published(session, out)
        newest = {row["label"]: row["drop"] for row in found if row["drop"] >= published.get(row["label"], ("",))[0]}
        if not newest:
            return
        stated = session.createDataFrame(list(newest.items()), "label string, drop string")
        taken = rows.join(F.broadcast(stated), ["label", "drop"], "left_semi").drop("drop").withColumn("version", F.lit(version))
        _replace(taken, f"{out}/clean")
        published |= {label: (drop, version) for label, drop in newest.items()}
        changed = {label: published[label] for label in newest}
        sums = monthly_summary(_current(session.read.parquet(f"{out}/clean"), changed), "date", "label", "version")
        _replace(sums, f"{out}/monthly")
        publish(session.createDataFrame([(label, *entry) for label, entry in published.items()], _MANIFEST), f"{out}/_manifest")

    stream = (
        spark.readStream.schema(read_delimited(spark, src, glob=glob).schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", "\t")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .csv(src)
        .withColumn("drop", F.regexp_extract(F.col("_metadata.file_path"), f"{root}/([^/]+)", 1))
    )
    (
        stream.writeStream.foreachBatch(replace_quarters)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_clean(spark: SparkSession, out: str) -> DataFrame:
    return _current(spark.read.parquet(f"{out}/clean"), _published(spark, out)).drop("version")


def read_monthly(spark: SparkSession, out: str) -> DataFrame:
    """Monthly totals over all quarters; a month lies in exactly one of them."""
    return _current(spark.read.schema(MONTHLY_SCHEMA).parquet(f"{out}/monthly"), _published(spark, out)).drop("version")


def published_drops(spark: SparkSession, out: str) -> DataFrame:
    """(label, drop): which drop each quarter was taken from."""
    rows = [(label, drop) for label, (drop, _) in _published(spark, out).items()]
    return spark.createDataFrame(rows, "label string, drop string")
