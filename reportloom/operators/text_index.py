"""Search from a stored index instead of the texts: the hits and scores of `search`.

Three tables below one folder:

* `postings` (term, field, key, places): where a word stands. Filed by term hash.
* `grams` (gram, term, documents): the pieces of two and three letters of every distinct word, with marks at its ends.
  Filed by gram hash; with it a fragment, a beginning, an end or a misspelt word is turned into words.
* `layout`: how many folders each of them has, and the type of the keys.

A search reads the folders of its own grams and words only. Fields are read again for few documents, and only to confirm
near matches of several words.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from ..functions.parsing import let
from ..workspace import written
from .ranking import top_k
from .search import LIMIT, MIN_QUERY, WEIGHTS, near, search

FOLDERS = 64
GRAM_TERMS = 200_000  # words whose grams one task files, at most
GRAM_TERMS_LEAST = 50_000  # and as long as there are fewer tasks than twice the cores
TEXT_BYTES = 8 << 20  # of texts that are cut into words together
RARE = 8  # times the postings of a phrase's rarest piece, if those of all pieces are more
SHORT = 64  # letters of a word whose pieces are counted off from its start
BEGIN, END = "\x02", "\x03"  # marks around a word in its grams
MASK_BITS = 63


def _folder(value: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(folders)).cast("int")


def _blank(text: Column) -> Column:
    """The lower-cased text with single blanks where one blank is; anything else separates by more than one."""
    return F.regexp_replace(F.lower(text), r"[\t\n\x0B\f\r]", "  ")


def _gatherer(fields: Sequence[str], most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, a text per field) to a row per word of a field in some rows: its keys, its places, and where those of each key end.

    A place is twice the word's number in the text, plus one if a single blank is before it.
    """

    def starts_of(changes: np.ndarray) -> np.ndarray:
        return np.append(np.flatnonzero(changes), len(changes)).astype(np.int32)

    def changed(values: np.ndarray) -> np.ndarray:
        return np.append(True, values[1:] != values[:-1])[: len(values)]

    def words_of(field: str, keys: pa.Array, texts: pa.Array) -> pa.RecordBatch | None:
        pieces = pc.split_pattern(texts, " ")
        sizes = np.asarray(pc.fill_null(pc.list_value_length(pieces), 0))
        found, row = pieces.flatten(), np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        kept = np.flatnonzero(np.asarray(pc.not_equal(found, "")))
        if not len(kept):
            return None
        row, found = row[kept], found.take(pa.array(kept)).dictionary_encode()
        first = changed(row)
        begins = starts_of(first)
        places = 2 * (np.arange(len(row)) - np.repeat(begins[:-1], np.diff(begins)))
        places += ~first & (np.diff(kept, prepend=0) == 1)
        word = np.asarray(found.indices)
        order = np.argsort(word, kind="stable")  # rows stay in order, and places within them
        word, row, places = word[order], row[order], places[order].astype(np.int32)
        posting = starts_of(changed(word) | changed(row))
        at, ends = posting[:-1], posting[1:]
        of_term, terms = starts_of(changed(word[at])), found.dictionary  # words by number, each occurs
        before = posting[of_term]  # places of the words before
        lists = [
            pa.ListArray.from_arrays(of_term, keys.take(pa.array(row[at]))),
            pa.ListArray.from_arrays(of_term, ends - np.repeat(before[:-1], np.diff(of_term))),
            pa.ListArray.from_arrays(before, places),
        ]
        return pa.RecordBatch.from_arrays([terms, pa.array([field] * len(terms)), *lists], ["term", "field", "keys", "ends", "places"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for field, texts in zip(fields, batch.columns[1:]):
                behind = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), dtype=np.int64)
                cuts = np.flatnonzero(changed(behind // most)).tolist() + [len(texts)]
                for lo, hi in zip(cuts, cuts[1:]):
                    if (made := words_of(field, batch.column(0)[lo:hi], texts[lo:hi])) is not None:
                        yield made

    return gathered


def _gathered(docs: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(term, field, keys, ends, places): the postings of `docs`, those of a word in rows of one batch together; a narrow step."""
    rows = docs.select(F.col(key).alias("key"), *[_blank(F.col(name)).alias(f"_{i}") for i, name in enumerate(fields)])
    numbers = ArrayType(IntegerType())
    made = StructType().add("term", StringType()).add("field", StringType()).add("keys", ArrayType(rows.schema["key"].dataType))
    return rows.mapInArrow(_gatherer(fields, TEXT_BYTES), made.add("ends", numbers).add("places", numbers))


def _unfolded(gathered: DataFrame) -> DataFrame:
    """A row for each key of a gathered row; the columns besides stay."""
    rows = gathered.select("*", F.posexplode("keys").alias("_at", "key"))
    begin = F.coalesce(F.get("ends", F.col("_at") - 1), F.lit(0))
    own = F.slice("places", begin + 1, F.get("ends", F.col("_at")) - begin)
    besides = [c for c in gathered.columns if c not in ("term", "field", "keys", "ends", "places")]
    return rows.select("term", "field", "key", own.alias("places"), *besides)


def _grams(term: Column) -> Column:
    """The distinct pieces of two and three letters of the marked word, in time linear in its length."""

    def pieces(letters: Column) -> Column:
        def of(n: int) -> Column:
            starts = F.sequence(F.lit(1), F.size(letters) - n + 1)  # a marked word has three letters at least
            return F.transform(starts, lambda i: F.concat(*[F.element_at(letters, i + k) for k in range(n)]))

        return F.array_distinct(F.concat(of(2), of(3)))

    def counted(marked: Column) -> Column:
        of = lambda n: F.transform(F.sequence(F.lit(1), F.length(marked) - n + 1), lambda i: F.substring(marked, i, F.lit(n)))
        return F.array_distinct(F.concat(of(2), of(3)))

    marked = F.concat(F.lit(BEGIN), term, F.lit(END))
    return F.when(F.length(term) <= SHORT, let(marked, counted)).otherwise(let(F.split(marked, ""), pieces))


def _by_gram() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(grams, term, documents) to a row per gram of some words, with these words."""

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, word = batch["grams"].flatten().dictionary_encode(), np.asarray(pc.list_parent_indices(batch["grams"]))
            number = np.asarray(grams.indices)
            order = np.argsort(number, kind="stable")
            ends = np.append(0, np.cumsum(np.bincount(number, minlength=len(grams.dictionary)))).astype(np.int32)
            at = pa.array(word[order])
            entries = pa.StructArray.from_arrays([batch["term"].take(at), batch["documents"].take(at)], ["term", "documents"])
            yield pa.RecordBatch.from_arrays([grams.dictionary, pa.ListArray.from_arrays(ends, entries)], ["gram", "found"])

    return turned


def write_index(docs: DataFrame, path: str, key: str, fields: Sequence[str] = tuple(WEIGHTS), folders: int = FOLDERS) -> None:
    """Index the `fields` of `docs` that exist below `path`, in place of an index that is there already.

    `key` names a document (rows of one key count as one document). Null fields have no words. Every word's list of
    documents is a row per document, so a very common word is many rows, which AQE spreads over files. A word's places are
    brought together within its row of `docs`, so each posting is shuffled once, to be filed; only those of keys that
    repeat are folded by a grouping. The words, one row each, are dealt out evenly and their grams filed where they are made.
    Postings are shuffled and sorted, and grams sorted, in lists as they were made from a batch, and unfolded to be written.
    """
    spark = docs.sparkSession
    named = [name for name in fields if name in docs.columns]
    repeated = docs.groupBy(F.col(key).alias("_again")).agg(F.count("*").alias("_n")).where("_n > 1").select("_again")
    repeated = written(repeated, "repeated-keys")
    if repeated.isEmpty():
        gathered = _gathered(docs, key, named)
    else:
        again = docs[key].eqNullSafe(repeated["_again"])
        once, more = (docs.join(repeated, again, how) for how in ("left_anti", "left_semi"))
        places = F.sort_array(F.flatten(F.collect_list("places"))).alias("places")
        folded = _postings(more, key, named).groupBy("term", "field", "key").agg(places)
        alone = [F.array("key").alias("keys"), F.array(F.size("places")).alias("ends"), "places"]
        gathered = _gathered(once, key, named).unionByName(folded.select("term", "field", *alone))
    rows = gathered.withColumn("folder", _folder(F.col("term"), folders)).hint("rebalance", F.col("folder"))
    _stored(rows, f"{path}/postings", "term", _unfolded)
    stored = spark.read.schema("term string, folder int").parquet(f"{path}/postings")
    terms = stored.groupBy("term").agg(F.count("*").alias("documents"))
    terms = written(terms, "index-terms")
    n = terms.count()
    tasks = max(1, -(-n // GRAM_TERMS), min(2 * spark.sparkContext.defaultParallelism, -(-n // GRAM_TERMS_LEAST)))
    pieces = terms.repartition(tasks, "term").select(_grams(F.col("term")).alias("grams"), "term", "documents")
    grams = pieces.mapInArrow(_by_gram(), "gram string, found array<struct<term: string, documents: bigint>>")
    rows = grams.withColumn("folder", _folder(F.col("gram"), folders))
    _stored(rows, f"{path}/grams", "gram", lambda lists: lists.select("gram", F.inline("found"), "folder"), plain="term")
    kind = docs.schema[key].dataType.simpleString()
    spark.createDataFrame([(folders, kind)], "folders int, kind string").coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")


def _postings(docs: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(term, field, key, places) of every row of `docs`; a narrow step."""
    return _unfolded(_gathered(docs, key, fields))


def _stored(df: DataFrame, path: str, order: str, unfold: Callable[[DataFrame], DataFrame], plain: str = "") -> None:
    """A folder per hash, its files sorted, so that row groups without the wanted values are skipped.

    Lists are sorted whole; what Spark then does to bring the rows of a folder together leaves their order. The column `plain`,
    of too many values for that, is stored without a dictionary.
    """
    rows = df.sortWithinPartitions("folder", order).transform(unfold)
    options = {"compression": "zstd"} | ({f"parquet.enable.dictionary#{plain}": "false"} if plain else {})
    rows.write.mode("overwrite").options(**options).partitionBy("folder").parquet(path)


class TextIndex:
    """An index that `write_index` has stored."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        layout = spark.read.parquet(f"{path}/layout").first()
        self.folders = layout["folders"]
        self.schemas = {
            "postings": f"term string, field string, key {layout['kind']}, places array<int>, folder int",
            "grams": "gram string, term string, documents bigint, folder int",
        }

    def _read(self, name: str, column: str, values: Sequence[str]) -> DataFrame:
        """Rows of a table with one of the values, from the folders of these values."""
        wanted = sorted(set(values))
        table = self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}")
        # xxhash64 of each value as Spark files it; few values, so this is planned on the driver
        made = self.spark.range(1).select(*[_folder(F.lit(v), self.folders).alias(f"_{i}") for i, v in enumerate(wanted)]).first()
        return table.where(F.col("folder").isin(sorted(set(made))) & F.col(column).isin(wanted)).drop("folder")

    def terms(self, piece: str, begins: bool, ends: bool) -> DataFrame:
        """Words that contain the piece, begin with it, end with it, or equal it (begins and ends)."""
        return self._counted(piece, begins, ends).select("term")

    def _counted(self, piece: str, begins: bool, ends: bool) -> DataFrame:
        """The same with the number of rows of their postings."""
        marked = BEGIN * begins + piece + END * ends
        size = min(3, len(marked))
        grams = [marked[i : i + size] for i in range(len(marked) - size + 1)]
        # every gram of the piece leads to all its words, so one is enough
        found = self._read("grams", "gram", [grams[len(grams) // 2]]).select("term", "documents").distinct()
        whole = F.concat(F.lit(BEGIN), F.col("term"), F.lit(END))
        return found.where(whole.contains(marked))

    def postings(self, terms: DataFrame, within: DataFrame | None = None) -> DataFrame:
        """Postings of the given words, or those of them in the (key, field) of `within`; only the folders of these words are read."""
        named = terms.withColumn("folder", _folder(F.col("term"), self.folders))
        used = [row["folder"] for row in named.select("folder").distinct().collect()]  # `folders` numbers at most
        table = self.spark.read.schema(self.schemas["postings"]).parquet(f"{self.path}/postings")
        table = table.where(F.col("folder").isin(used))
        if within is not None:
            table = table.join(within, ["key", "field"], "left_semi")
        return table.join(named, ["folder", "term"]).drop("folder")

    def near_terms(self, query: str, allowed: int) -> DataFrame | None:
        """Words within `allowed` edits of a word: they share all but three grams an edit with it. None if that says nothing."""
        grams = _trigrams([query])
        least = len(grams) - 3 * allowed
        if least < 1:
            return None
        rows = self._read("grams", "gram", grams)
        rows = rows.where(F.length("term").between(len(query) - allowed, len(query) + allowed))
        shared = rows.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= least)
        return shared.where(F.levenshtein("term", F.lit(query), allowed) >= 0).select("term")

    def near_runs(self, words: Sequence[str], allowed: int) -> DataFrame | None:
        """(key, field) with a run of as many words as the query that shares all but three grams an edit with it.

        Grams hold the marks of words, and an edit (of a blank, too) changes three of them at most, so no run within
        `allowed` edits is missed. Every word of the index that has a gram of the query adds the grams it has to the runs
        around its places. One word of such a run has at least an even share of its grams. Few words have as many, so their
        documents are looked up first, and the places of all other words only in these. A single edit leaves the number of
        words, so then only words within an edit of one of the query's, or of two that a text of fewer words has in one, take part.
        """
        grams = _trigrams(words)
        least = len(grams) - 3 * allowed
        if least < 1:
            return None
        number = F.create_map(*[x for i, g in enumerate(grams) for x in (F.lit(g), F.lit(i))])
        masks = [f"_mask{i}" for i in range(-(-len(grams) // MASK_BITS))]
        rows = self._read("grams", "gram", grams).withColumn("_bit", F.element_at(number, F.col("gram")))
        one = F.expr(f"shiftleft(1L, cast(_bit % {MASK_BITS} as int))")
        shares = rows.groupBy("term").agg(
            *[F.bit_or(F.when(F.floor(F.col("_bit") / MASK_BITS) == i, one).otherwise(F.lit(0).cast("long"))).alias(m) for i, m in enumerate(masks)]
        )
        width = len(words)
        if allowed == 1:  # it stays within a word, or makes one of two where a text has fewer words than the query
            spans = [" ".join(words[i : i + n]) for n in (1, 2) for i in range(width - n + 1)]
            shares = shares.where(reduce(or_, [F.levenshtein("term", F.lit(span), allowed) >= 0 for span in spans]))
        shares = written(shares, "near-terms")
        shared = reduce(lambda a, b: a + b, [F.bit_count(m) for m in masks])
        strong = written(shares.where(shared >= -(-least // width)), "near-terms")
        documents = written(self.postings(strong).select("key", "field").distinct(), "near-documents")
        found = self.postings(shares, documents).select("key", "field", *masks, F.explode("places").alias("place"))
        number_of = F.floor(F.col("place") / 2)
        starts = F.explode(F.sequence(number_of - (width - 1), number_of)).alias("start")
        runs = found.select("key", "field", *masks, starts).groupBy("key", "field", "start").agg(*[F.bit_or(m).alias(m) for m in masks])
        return runs.where(shared >= least).select("key", "field").distinct()

    def phrase(self, pieces: Sequence[str]) -> DataFrame:
        """(key, field) that contain the pieces with single blanks between them: the first ends a word, the last begins one.

        Documents of the rarest piece are looked up first, and the others only in these, unless they hold much of all postings.
        """
        last = len(pieces) - 1
        steps = [self._counted(piece, begins=i > 0, ends=i < last).withColumn("step", F.lit(i)) for i, piece in enumerate(pieces)]
        terms = written(reduce(DataFrame.unionByName, steps), "phrase-terms")  # so that postings are read once, and joined by its size
        counts = dict(terms.groupBy("step").agg(F.sum("documents")).collect())  # a row per piece
        rare, within = min(counts, key=counts.get, default=0), None
        if counts and RARE * counts[rare] < sum(counts.values()):
            named = written(terms.where(F.col("step") == rare).select("term"), "phrase-terms")
            within = written(self.postings(named).select("key", "field").distinct(), "phrase-documents")
        places = self.postings(terms.drop("documents"), within)
        places = places.select("key", "field", "step", F.explode("places").alias("place")).where("step = 0 OR place % 2 = 1")
        starts = places.select("key", "field", (F.floor(F.col("place") / 2) - F.col("step")).alias("start"), "step")
        together = starts.groupBy("key", "field", "start").agg(F.bit_count(F.bit_or(F.expr("shiftleft(1L, step)"))).alias("n"))
        return together.where(F.col("n") == len(pieces)).select("key", "field").distinct()


def _trigrams(words: Sequence[str]) -> list[str]:
    marked = [BEGIN + word + END for word in words]
    return sorted({m[i : i + 3] for m in marked for i in range(len(m) - 2)})


def search_index(
    docs: DataFrame, path: str, query: str, key: str, weights: Mapping[str, int] = WEIGHTS, limit: int = LIMIT, fuzz: float = 0.0
) -> DataFrame:
    """The result of `search` on the indexed documents, from the index below `path`.

    `docs` gives the columns of the hits, and the fields of the few documents in which a near match of several words is
    confirmed. Words are found through their grams: of a query of one word every word that contains it or is nearly it, of
    several words the runs of them. What the index cannot narrow is searched in `docs`: blanks at an end or in a row, and
    edits so many that a match need not share a gram.
    """
    if len(query) < MIN_QUERY:
        return search(docs, query, key, weights, limit, fuzz)
    lowered, allowed = query.lower(), int(fuzz * len(query))
    pieces = lowered.split(" ")
    fields = {name: weight for name, weight in weights.items() if name in docs.columns}
    if "" in pieces or any(re.search(r"\s", p) for p in pieces) or len(pieces) > 60:
        return search(docs, query, key, weights, limit, fuzz)
    index = TextIndex(docs.sparkSession, path)
    if len(pieces) == 1:
        terms = index.terms(lowered, begins=False, ends=False)
        if allowed:
            similar = index.near_terms(lowered, allowed)
            if similar is None:
                return search(docs, query, key, weights, limit, fuzz)
            terms = terms.unionByName(similar).distinct()
        hits = index.postings(terms).select("key", "field").distinct()
    else:
        hits = index.phrase(pieces)
        if allowed:
            runs = index.near_runs(pieces, allowed)
            if runs is None:
                return search(docs, query, key, weights, limit, fuzz)
            hits = hits.unionByName(_confirmed(docs, runs, key, fields, query, fuzz)).distinct()
    weight = F.create_map(*[F.lit(x) for item in fields.items() for x in item])
    scored = hits.where(F.col("field").isin(list(fields))).groupBy(F.col("key").alias("_key")).agg(
        F.sum(F.element_at(weight, F.col("field"))).cast("int").alias("score")
    )
    best = scored.where("score > 0").transform(top_k, "score", limit, "_key")  # `limit` rows
    found = docs.drop("score").join(F.broadcast(best), docs[key] == F.col("_key")).drop("_key")
    return found.transform(top_k, "score", limit, key)


def _confirmed(docs: DataFrame, runs: DataFrame, key: str, fields: Mapping[str, int], query: str, fuzz: float) -> DataFrame:
    """The candidates whose field is a near match. They are stored first: with few of them no text is shuffled, nor compared if it is none."""
    runs = written(runs.withColumn("_asked", F.lit(True)), "near-runs")
    texts = F.explode(F.array(*[F.struct(F.lit(name).alias("field"), F.col(name).alias("_text")) for name in fields]))
    cells = docs.select(F.col(key).alias("key"), texts.alias("_cell")).select("key", "_cell.*")
    near_match = F.when(F.col("_asked"), near(F.col("_text"), query, fuzz))  # of both sides, so that it stays behind the join
    return cells.join(runs, ["key", "field"]).where(near_match).select("key", "field")
