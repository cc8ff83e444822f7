"""From raw documents to packed training sequences, in stages that are each written before the next one reads.

`documents` has doc_id (whole number), text, lang, source, n_chars. Every stage but the last returns these columns; further
columns, of any name, go. Null and empty texts, null and repeated doc_ids pass through as stated at each stage, and an
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm.decontamination import find_benchmark
from reportloom.llm.jaccard_join import jaccard_classes
from reportloom.llm.line_dedup import dedup_lines
from reportloom.llm.packing import pack_documents
from reportloom.llm.registry import table
from reportloom.llm.tokens import vocabulary_path
from reportloom.llm.toxicity import score_toxicity
from reportloom.workspace import fresh_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject (predicted 0).

    Each row is judged by its own text, also where ids repeat or are null; a null or empty text has the score of an empty one.
    """
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), max_labelled=20_000, keep=COLUMNS)
    return scored.where("predicted = 0").select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document of smaller id holds too; n_chars follows the text.

    A null text becomes empty. Rows with a null id are kept whole and count nowhere; rows of one id are one document, and
    each is cleaned. A document whose lines all stand in earlier ones stays, with an empty text.
    """
    kept = dedup_lines(docs.select(COLUMNS), min_chars=10)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group linked by a Jaccard similarity of 0.8 on five-word shingles.

    Texts without words link with nothing and stay, as do rows with a null id. Rows of one id are one document, that of the
    longest text, and stay or go together.
    """
    classes = jaccard_classes(docs, words=5, percent=80)
    copies = classes.where("component_id <> doc_id").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage similar (0.8 on five-word shingles) to a benchmark item.

    Null and empty texts hold none. All rows of an id go if one of them holds a passage; rows with a null id stay.
    """
    leaks = find_benchmark(docs, table(spark, sf_dir, "benchmark"), words=5, threshold=0.8)
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti").select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents, placed in sequences of at most 2048 tokens.

    A null or empty text is one piece, its end token. Repeated rows are packed each; null ids stay null.
    """
    return pack_documents(docs, vocabulary_path("word_bpe_49k.json"), end_id=0, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

# Tokenizing and the learned score have no SQL form; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
