"""Small tables with the awkward cases, shared by the tests of the corpus operators."""

from __future__ import annotations

import random

WORDS = "amber birch cedar delta ember fjord grove haven inlet jetty karst ledge marsh north ocean plume quartz ridge slope tarn".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", ",", "."]) for _ in range(n))


def awkward_documents() -> list[tuple]:
    """(doc_id, text) with null, empty, very long, repeated and similar texts; ids are not in order."""
    base = prose(1, 60)
    rows = [
        (7, base),
        (3, base),
        (12, base.upper()),
        (9, base + " tail"),
        (4, base.replace("amber", "umber", 1)),
        (5, None),
        (6, ""),
        (8, "   \n\t "),
        (10, "one two"),
        (11, "one  two"),
        (13, prose(2, 9000)),
        (14, "é日本 x" * 50 + " İ ẞ <|endoftext|> it's"),
        (15, prose(3, 40) + "\nA line that many share\n" + prose(4, 30)),
        (16, "  a LINE that many share \n" + prose(5, 30)),
        (17, "A line that many share\nA line that many share\nshort\nshort"),
        (18, "short\nA line that many share\t"),
        (20, prose(6, 200)),
        (40, prose(6, 200).replace("cedar", "cider", 1)),
    ]
    return rows + [(100 + i, prose(50 + i, 30 + i)) for i in range(40)] + [(200 + i, prose(1, 60) + f" copy {i}") for i in range(30)]


def documents(spark, rows=None):
    rows = awkward_documents() if rows is None else rows
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t)) for i, t in rows], schema).repartition(3)


def clashing(docs):
    """The documents with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = "id row mark key n_tokens n_bytes score predicted n_lines n_dropped component_id token family part piece start length block slice item"
    return docs.withColumns({name: F.lit("x") for name in names.split()})
