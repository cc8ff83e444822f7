"""Secrets in texts: known patterns, and strings in a sensitive context that a primed compressor cannot shorten."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import batches_by_bytes, stored


def _either_case(word: str) -> str:
    """A pattern for the ASCII letters of `word` in either case (Unicode case rules would add other letters)."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


# Fixed patterns and least lengths of the three known kinds, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "novel")
_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_ASSIGN = re.compile(rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs of at least the least length: the same spans as all runs, filtered
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

LEAST_CANDIDATE = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.-]{{{LEAST_CANDIDATE},}}={{0,2}}")  # "=" ends Base64, elsewhere it is a sign
_CLASSES = [re.compile(p) for p in ("[a-z]", "[A-Z]", "[0-9]")]
# Words that make a context sensitive, in any case.
SENSITIVE = ("key", "secret", "token", "passw", "pwd", "auth", "bearer", "credential", "private", "signature", "cert", "access")
_SENSITIVE = re.compile("|".join(map(_either_case, SENSITIVE)))
NEAR = 48  # code points before a candidate, on its line, in which a sensitive word must begin
AROUND = 256  # code points on either side that prime the compressor

LEVEL = 12
NOVEL = 0.93  # compressed bytes a byte from which a string counts as incompressible; random ones take 0.95 and more
DICTIONARY_BYTES = 1 << 16
LONGEST_NAME = 40
_NAME = re.compile(rf"(?<![A-Za-z])[A-Za-z]{{3,{LONGEST_NAME}}}(?![A-Za-z])")
# Stands at the end of the dictionary and before each candidate, so that a block is never stored as it is.
_FILLER = b"# a line of plain words that the dictionary knows by heart, here"
SLICE_NAMES = 512
HELD_NAMES = 100_000  # names a task counts before it sends them on


def _mixed(text: str) -> bool:
    return sum(c.search(text) is not None for c in _CLASSES) >= 2


def _candidates(text: str) -> Iterator[re.Match]:
    """Long runs of the characters of keys, with letters of both cases or letters and digits."""
    return (m for m in _CANDIDATE.finditer(text) if _mixed(m[0]))


def _names_of(text: str) -> set[str]:
    """Identifiers of a text; pieces of candidates are none."""
    return set(_NAME.findall(_CANDIDATE.sub(lambda m: " " if _mixed(m[0]) else m[0], text)))


def identifier_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(name, n): identifiers (runs of 3 to 40 ASCII letters) and the number of texts that hold them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["name", "n"])

        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    held.update(_names_of(value))
                if len(held) > HELD_NAMES:
                    yield out()
                    held.clear()
        yield out()

    batches_by_bytes(docs)
    rows = docs.select(docs[text].cast("string").alias("text")).mapInArrow(counted, "name string, n long")
    return rows.groupBy("name").agg(F.sum("n").alias("n"))


def identifier_dictionary(docs: DataFrame, text: str = "text", least_texts: int = 2, size: int = DICTIONARY_BYTES) -> bytes:
    """The identifiers in most texts, as many as fit in `size` bytes; the commonest last.

    All texts are counted; the dictionary holds at most `size` bytes, which is what one compressor window takes. Names are
    taken by classes of their number of texts (eight classes for each doubling), in the last class by hash. Sizes of classes
    come first, so that not many more names reach the driver than a dictionary can hold.
    """
    frequency = F.floor(F.log2("n") * 8).cast("int")
    counted = identifier_counts(docs, text).where(F.col("n") >= least_texts)
    names = stored(counted.select("name", frequency.alias("class"), F.xxhash64("name").alias("hash")), "identifiers")
    left, least, slices = size // 4, None, {}
    for row in names.groupBy("class").count().orderBy(F.desc("class")).collect():  # eight classes a doubling
        if row["count"] > left:
            slices = {row["class"]: -(-row["count"] // SLICE_NAMES)}
            break
        least, left = row["class"], left - row["count"]
    wanted = F.lit(False) if least is None else F.col("class") >= least
    for last, n in slices.items():
        # a slice holds about SLICE_NAMES names, so these are `left` names and a slice or two
        some = F.pmod("hash", F.lit(n)) < -(-left // SLICE_NAMES) + 1
        wanted = wanted | ((F.col("class") == last) & some)
    rows = sorted(names.where(wanted).collect(), key=lambda r: (-r["class"], r["hash"] % slices.get(r["class"], 1), r["hash"], r["name"]))
    chosen, used = [], len(_FILLER)
    for row in rows:
        used += len(row["name"]) + 1
        if used > size:
            break
        chosen.append(row["name"])
    return " ".join([*reversed(chosen), ""]).encode() + _FILLER


class Novelty:
    """Marginal compressed bytes of a string, given the identifier dictionary and the text around it."""

    def __init__(self, dictionary: bytes):
        import zstandard

        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False
        )
        self.flush = zstandard.COMPRESSOBJ_FLUSH_BLOCK

    def _block(self, around: bytes, block: bytes) -> int:
        stream = self.compressor.compressobj()
        stream.compress(around)
        stream.flush(self.flush)
        return len(stream.compress(block)) + len(stream.flush(self.flush))

    def __call__(self, text: str, start: int, end: int) -> float:
        """Bytes that the compressor adds for text[start:end], for each of its bytes.

        What surrounds the string is compressed first (repetitions of the string itself taken out), so the
        string costs little where it repeats its surroundings or is made of known identifiers.
        """
        found = text[start:end]
        around = (text[max(0, start - AROUND) : start] + " " + text[end : end + AROUND]).replace(found, " ").encode()
        raw = found.encode()
        return (self._block(around, _FILLER + raw) - self._block(around, _FILLER)) / len(raw)


def known_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known kinds, sorted; per kind leftmost and not overlapping."""
    lowered, found = text.lower(), []
    if any(word in lowered for word in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def novel_spans(text: str, known: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """(start, kind, end) of incompressible strings in a sensitive context that no known span overlaps."""
    lowered = text.lower()
    if not any(word in lowered for word in SENSITIVE):
        return []
    taken, found = [(start, end) for start, _, end in known], []
    for match in _candidates(text):
        start, end = match.span()
        line = text.rfind("\n", 0, start) + 1
        if not _SENSITIVE.search(text, max(line, start - NEAR), start):
            continue
        if any(a < end and start < b for a, b in taken):
            continue
        if novelty(text, start, end) >= NOVEL:
            found.append((start, 3, end))
    return found


def find_secrets(docs: DataFrame, dictionary: bytes | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans) per row; spans lists (kind, start, end, text, novelty) by start, then kind in the order of KINDS.

    Known kinds: "assign" (a name such as password or token, a sign, and 12 or more characters of a key), "access"
    (AKIA and 14 or more capitals or digits) and "hex" (16 or more lower-case hexadecimal digits), each leftmost and not
    overlapping within its kind. "novel" spans are added by the compressor: runs of 16 or more characters of keys, of
    mixed classes, whose line holds a sensitive word up to 48 code points before, which overlap no known span, and which
    cost at least 0.93 compressed bytes a byte when zstandard is primed with the identifiers of the corpus and the 256
    code points on either side. `novelty` is that cost, for the known kinds too. Positions count code points.

    `dictionary` comes from `identifier_dictionary`; by default it is made of `docs`, in one more pass. It is at most
    64 KB and travels with the tasks. Every whole text is scanned; the rows do not move.

    A null or empty text has no spans. Null and repeated ids are kept, a row each. An empty table gives an empty one. Other
    columns of any name are ignored.
    """
    batches_by_bytes(docs)
    if dictionary is None:
        dictionary = identifier_dictionary(docs, text)
    rows = docs.select(docs[id].alias("id"), docs[text].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()), ("novelty", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        for batch in batches:
            out = []
            for value in batch.column(1).to_pylist():
                value = value or ""
                known = known_spans(value)
                spans = sorted(known + novel_spans(value, known, novelty))
                out.append(
                    [
                        {"kind": KINDS[k], "start": a, "end": b, "text": value[a:b], "novelty": novelty(value, a, b)}
                        for a, k, b in spans
                    ]
                )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], ["id", "spans"])

    found = rows.mapInArrow(
        scan, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,text:string,novelty:double>>"
    )
    return found.withColumnRenamed("id", id)


def span_list(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_digests(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) per row of `find_secrets`."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = span_list(F.filter("spans", lambda s: s["kind"] != "novel"))
    return found.select(
        id, *map(count, KINDS[:3]), F.sha2(base.cast("binary"), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans")
    )
