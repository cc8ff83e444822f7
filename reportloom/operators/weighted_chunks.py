"""Chunks that can be cited and that weigh rare words more: sections per chunk, and vectors of TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.parsing import column, let
from .arrays import runs_of
from .retrieval import term_slots, words_of


def cited_chunks(df: DataFrame, key: str, text: str, size: int = 200, overlap: int = 20) -> DataFrame:
    """(key, chunk_no, chunk, first_section, last_section): the windows of `chunks`, with the sections that they touch.

    Sections are those of `sections`: the lines of the text, from 0. Every word carries the number of its line, so a window
    knows the lines of its first and last word without a join. A narrow step.
    """
    step = size - overlap

    def words(lines: Column) -> Column:
        def of_line(line: Column, number: Column) -> Column:
            found = F.filter(words_of(line), lambda w: w != "")
            return F.transform(found, lambda w: F.struct(w.alias("word"), number.alias("line")))

        return F.flatten(F.transform(lines, of_line))

    def windows(found: Column) -> Column:
        count = F.greatest(F.ceil((F.size(found) - overlap) / F.lit(step)), F.lit(1)).cast("int")

        def window(i: Column) -> Column:
            here = F.slice(found, i * step + 1, size)
            return F.struct(
                F.array_join(F.transform(here, lambda w: w["word"]), " ").alias("chunk"),
                F.element_at(here, 1)["line"].alias("first_section"),
                F.element_at(here, -1)["line"].alias("last_section"),
            )

        return F.transform(F.sequence(F.lit(0), count - 1), window)

    texts = df.filter(F.regexp_replace(text, r"\s+", "") != "")
    cut = texts.select(key, F.posexplode(let(let(F.split(text, "\n"), words), windows)).alias("chunk_no", "_chunk"))
    return cut.select(key, "chunk_no", "_chunk.*")


def _terms(text: Column | str) -> Column:
    return words_of(F.lower(column(text)))


def term_weights(chunks: DataFrame, text: str = "chunk") -> DataFrame:
    """(term, n_chunks, weight): in how many texts a word stands, and ln((1 + texts) / (1 + n_chunks)) + 1.

    One pass; a text counts a word once, and counts are added before the shuffle.
    """
    counts = chunks.select(F.explode(F.array_distinct(_terms(text))).alias("term")).groupBy("term").agg(F.count("*").alias("n_chunks"))
    return counts.withColumn("weight", F.log((1 + chunks.agg(F.count("*")).scalar()) / (1 + F.col("n_chunks"))) + 1)


def weighted_vectors(texts: DataFrame, ids: list[str], text: str, weights: DataFrame, total: int | Column, dim: int = 64) -> DataFrame:
    """(ids, embedding): per text, the weights of its words added up in the words' slots.

    A word without a weight (in no indexed text) gets ln(1 + texts) + 1. Words are counted within their text, and meet their
    weights and slots in a join by word, in which a very common word is left to AQE's skew handling, since the weights have
    one row per word. A text's weights then meet in one shuffle and are added up in a sum per slot.
    """
    counted = F.transform(runs_of(_terms(text)), lambda run: F.struct(run[0].alias("term"), F.size(run).alias("n")))
    words = texts.select(*ids, F.inline(counted))
    known = weights.select("term", "weight", term_slots("term", dim)[0].alias("slot"))
    weighed = words.join(known.hint("shuffle_hash"), "term", "left").select(
        *ids,
        F.coalesce("slot", term_slots("term", dim)[0]).alias("_slot"),
        (F.coalesce("weight", F.log(F.lit(1.0) + total) + 1) * F.col("n")).alias("_weight"),
    )
    sums = [F.sum(F.when(F.col("_slot") == d, F.col("_weight")).otherwise(0.0)).alias(f"_{d}") for d in range(dim)]
    return weighed.repartition(*ids).groupBy(*ids).agg(*sums).select(*ids, F.array(*[f"_{d}" for d in range(dim)]).alias("embedding"))
