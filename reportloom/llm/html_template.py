"""Main text of web pages by equivalence-class template deduction per host."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .html_pages import Block, page_blocks
from .storage import batches_by_bytes, stored

LEAST_PAGES = 4  # pages of a host before a template is deduced
FREQUENT = 0.5  # share of a host's pages that a template token is on
FIXED_TEXT = 0.3  # share of a host's pages on which a text must be at one place to be part of the template
COPIED = 0.5  # a repeated text whose pages have less than this share of the usual text of their own comes from a copied article
MAIN_SHARE = 0.6  # share of a host's variable text that the main slot holds

ARTICLE = ("article", "main")
# Elements that hold a paragraph, a heading or an item and so are never the slot themselves.
LEAVES = r"(?:^| )(?:p|h[1-6]|li|dt|dd|td|th|tr|pre|figcaption|legend|summary|option|address|blockquote)(?:[.#][^ ]*)?$"
# Parts of an article's text that need no name of their own; fixed text in such a place is the article's.
TEXT_PARTS = frozenset("ul ol li dl dt dd table thead tbody tfoot tr td th h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption".split())


def host_of(url):
    """The host of a URL in lower case; null without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def extract_main_text(pages: DataFrame, id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(id, url, text, n_chars): the article of each page, its blocks in page order, one per line.

    Tokens are element paths (names with class and id) and texts at a path. For each host and token the pages
    with it give an occurrence vector, kept as a sum of hashes of (page, count), so that no task gathers a
    host's pages. Equal siblings are elements of their own, by number, where all pages have as many of them. Tokens of
    a host with equal vectors form an equivalence class. Frequent classes whose elements
    are on a page once at most are valid and nest by their paths; they are the host's template. The slot for the
    article is the innermost container of a valid class that still holds MAIN_SHARE of the host's variable text
    outside asides, and the headline if that varies; within an article element it is that element. A list, table
    or subheading without a name of its own in the slot is the article's, also where its text repeats. In other places that mostly hold fixed text (the same on many of the host's pages) the fixed texts are
    template text, but for those of copied articles, whose pages have little text of their own; variable texts
    and fixed texts in other places stay.

    From each page come the blocks in that slot, without asides (menus, page headers, footers, sidebars, notices,
    adverts, forms, comments, scripts, styles) and without template text. Pages without the slot, of hosts with
    few pages or without a host use their article or main element, else all text outside asides. Character
    references are decoded and white space (a line break included) becomes one space; nothing else is cut.

    Null or empty html gives an empty text. Repeated rows and null ids are kept, each with its text. An empty
    table gives an empty one. Only the three named columns are read.
    """
    batches_by_bytes(pages)
    rows = pages.select(pages[id].alias("id"), pages[url].cast("string").alias("url"), pages[source].cast("string").alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    kind = rows.schema["id"].dataType.simpleString()
    templates = stored(deduced_templates(rows), "templates")
    return (
        rows.join(templates, "host", "left")
        .select("id", "url", "html", "slot", "fixed", "texts")
        .mapInArrow(_extract, f"id {kind}, url string, text string, n_chars long")
        .withColumnsRenamed({"id": id, "url": url})
    )


def deduced_templates(rows: DataFrame) -> DataFrame:
    """(host, slot, fixed, texts): place of the main slot, paths that hold template text only, and further template texts at a path."""
    hosted = rows.where("host is not null and html is not null")
    tokens = stored(
        hosted.select("host", F.xxhash64("id", "url").alias("page"), "html").mapInArrow(
            _page_tokens, "host string, place string, path string, text long, pages long, vector long, most int, chars long, aside boolean"
        ),
        "page-tokens",
    )
    # text = 0 stands for the element itself
    tokens = tokens.groupBy("host", "place", "path", "text").agg(
        F.sum("pages").alias("pages"),
        F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"),
        F.max("most").alias("most"),
        F.sum("chars").alias("chars"),
        F.max("aside").alias("aside"),
    )
    tokens = stored(tokens, "host-tokens")
    sizes = hosted.groupBy("host").agg(F.count("*").alias("host_pages")).where(F.col("host_pages") >= LEAST_PAGES)
    sizes = stored(sizes, "host-sizes")
    standing = tokens.where("text <> 0").select("host", "place", "path", "text", "pages", "chars", "aside").join(sizes, "host")
    texts = standing.groupBy("host", "path", "text").agg(
        F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.max("aside").alias("aside"), F.first("host_pages").alias("host_pages")
    )
    texts = texts.withColumn("is_fixed", (F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= FIXED_TEXT * F.col("host_pages")))
    places = (
        texts.groupBy("host", "path")
        .agg(
            F.sum("chars").alias("chars"),
            F.sum(F.when(F.col("is_fixed"), F.col("chars")).otherwise(0)).alias("fixed_chars"),
            F.max("aside").alias("aside"),
        )
        .withColumn("fixed", 2 * F.col("fixed_chars") > F.col("chars"))
        .withColumn("pure", F.col("fixed_chars") == F.col("chars"))
    )
    places = stored(places, "host-places")
    mixed = places.where("fixed and not pure").select("host", "path", F.col("aside").alias("place_aside"))
    mixed = texts.where("is_fixed").join(mixed, ["host", "path"]).select("host", "path", "text", "chars", "place_aside")
    mixed = stored(mixed, "mixed-texts")
    own = _without_copies(hosted, texts, mixed.where("not place_aside"))
    template = stored(mixed.where("place_aside").drop("place_aside").unionByName(own), "template-texts")
    pure = places.where("fixed and pure").select("host", "path")
    variable = standing.where("not aside").join(pure, ["host", "path"], "left_anti")
    variable = variable.join(template.select("host", "path", "text"), ["host", "path", "text"], "left_anti")
    variable = stored(variable.groupBy("host", "place").agg(F.sum("chars").alias("chars")), "variable-text")
    # equivalence classes of elements: equal occurrence vectors; the largest occurrence is part of the vector
    elements = tokens.where("text = 0").join(sizes, "host")
    # numbers of equal siblings mean something only where all pages have as many of them
    family = F.regexp_replace("place", ":[1-9][0-9]*$", "")
    unstable = elements.groupBy("host", family.alias("family")).agg(F.count_distinct("pages", "vector").alias("n")).where("n > 1")
    elements = elements.where(F.col("pages") >= FREQUENT * F.col("host_pages"))
    classes = Window.partitionBy("host", "pages", "vector")
    valid = elements.withColumn("class_size", F.count("*").over(classes)).where("most = 1 and class_size > 1")
    # a place's text counts for all elements around it
    around = F.transform(
        F.sequence(F.lit(1), F.size(F.split("place", " "))),
        lambda n: F.array_join(F.slice(F.split("place", " "), 1, n), " "),
    )
    families = F.transform(around, lambda p: F.regexp_replace(p, ":[1-9][0-9]*$", ""))
    masses = variable.select("host", F.explode(around).alias("place"), "chars")
    masses = masses.groupBy("host", "place").agg(F.sum("chars").alias("mass"))
    whole = variable.groupBy("host").agg(F.sum("chars").alias("whole"))
    # the headline, where it varies, belongs to the slot; an article element around the slot is the slot
    headline = F.when(F.col("place").rlike(r"(?:^| )h1(?:[.#][^ ]*)?$"), F.col("chars"))
    headlines = variable.withColumn("chars", headline).where("chars > 0").select("host", F.explode(around).alias("place"), "chars")
    headlines = headlines.groupBy("host", "place").agg(F.sum("chars").alias("headline"))
    outer = F.col("place").rlike("^html(?:[.#][^ ]*)?(?: body(?:[.#][^ ]*)?)?$|^body(?:[.#][^ ]*)?$")
    steps = F.size(F.split("place", " "))
    # a container without a name that holds its text itself is a paragraph of the one around it
    unnamed = F.col("place").rlike("(?:^| )[a-z]+(?::[0-9]+)?$")
    paragraph = unnamed & (2 * F.coalesce("chars", F.lit(0)) >= F.col("mass"))
    candidates = (
        valid.where(~F.col("place").rlike(LEAVES))
        .select("host", "place")
        .join(masses, ["host", "place"])
        .join(whole, "host")
        .where(F.col("mass") >= MAIN_SHARE * F.col("whole"))
        .join(variable, ["host", "place"], "left")
        .where(~paragraph | outer)
        .drop("chars")
        .join(headlines, ["host", "place"], "left")
    )
    candidates = stored(candidates, "slots")
    loose = candidates.select("host", "place", F.explode(families).alias("family")).join(unstable, ["host", "family"], "left_semi")
    slots = (
        candidates.join(loose.select("host", "place"), ["host", "place"], "left_anti")
        .groupBy("host")
        .agg(F.max(F.struct(F.when(~outer, F.coalesce("headline", F.lit(0))).otherwise(0), steps, "mass", "place"))["place"].alias("slot"))
        .withColumn("article", F.regexp_extract("slot", r"^(?:.* )?(?:article|main)(?:[.#:][^ ]*)?(?= |$)", 0))
        .select("host", F.when(F.col("article") != "", F.col("article")).otherwise(F.col("slot")).alias("slot"))
    )
    fixed = places.where("fixed and pure").groupBy("host").agg(F.collect_set("path").alias("fixed"))
    further = template.groupBy("host").agg(F.collect_set(F.struct("path", "text")).alias("texts"))
    return slots.join(fixed, "host", "left").join(further, "host", "left")


def _without_copies(hosted: DataFrame, texts: DataFrame, doubtful: DataFrame) -> DataFrame:
    """(host, path, text, chars) of the doubtful fixed texts that stand on pages with usual amounts of text of their own.

    Only pages of hosts with doubtful texts are read again.
    """
    token = F.struct("path", "text")
    hosts = doubtful.groupBy("host").agg(F.collect_list(token).alias("doubtful"))
    fixed = texts.where("is_fixed").groupBy("host").agg(F.collect_list(token).alias("fixed"))
    hosts = stored(hosts.join(fixed, "host"), "doubtful-hosts")
    seen = hosted.select("host", "html").join(hosts, "host").mapInArrow(_own_text, "host string, path string, text long, n long, own long")
    seen = stored(seen.groupBy("host", "path", "text").agg(F.sum("n").alias("n"), F.sum("own").alias("own")), "own-text")
    usual = seen.where("text = 0").select("host", (F.col("own") / F.col("n")).alias("usual"))
    kept = seen.where("text <> 0").join(usual, "host").where(F.col("own") >= COPIED * F.col("usual") * F.col("n"))
    return doubtful.select("host", "path", "text", "chars").join(kept.select("host", "path", "text"), ["host", "path", "text"])


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per doubtful text, and per host (text = 0): pages, and characters on them outside asides that are no fixed text."""
    for batch in batches:
        total: dict[tuple[str, str, int], list[int]] = defaultdict(lambda: [0, 0])
        for host, source, doubtful, fixed in zip(*(batch.column(i).to_pylist() for i in range(4))):
            known = {(t["path"], t["text"]) for t in fixed}
            blocks = [(_step(b.path), _text_hash(b.text), len(b.text), any(b.asides)) for b in page_blocks(source)[0]]
            own = sum(n for path, text, n, aside in blocks if not aside and (path, text) not in known)
            here = {(path, text) for path, text, _, _ in blocks}
            for path, text in [("", 0), *here.intersection((t["path"], t["text"]) for t in doubtful)]:
                entry = total[host, path, text]
                entry[0] += 1
                entry[1] += own
        keys, values = list(total), list(total.values())
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string())]
        columns += [pa.array(x, pa.int64()) for x in ([k[2] for k in keys], [v[0] for v in values], [v[1] for v in values])]
        yield pa.RecordBatch.from_arrays(columns, ["host", "path", "text", "n", "own"])


def _step(path: tuple[str, ...]) -> str:
    return " ".join(part.replace(" ", "+") for part in path)


def _page_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of the pages of a batch, added up per host."""
    for batch in batches:
        total: dict[tuple[str, str, str, int], list] = defaultdict(lambda: [0, 0, 0, 0, False])
        hosts, pages, sources = (batch.column(i).to_pylist() for i in range(3))
        for host, page, source in zip(hosts, pages, sources):
            blocks, seen = page_blocks(source)
            texts: dict[tuple[str, str, int], list] = defaultdict(lambda: [0, 0, False])
            for block in blocks:
                found = texts[_step(block.place), _step(block.path), _text_hash(block.text)]
                found[0] += 1
                found[1] += len(block.text)
                found[2] |= any(block.asides)
            for place, count in seen.items():
                texts[_step(place), "", 0][0] += count
            for (place, path, text), (count, chars, aside) in texts.items():
                entry = total[host, place, path, text]
                entry[0] += 1
                entry[1] += _vector_part(page, count)
                entry[2] = max(entry[2], count)
                entry[3] += chars
                entry[4] |= aside
        keys, values = list(total), list(total.values())
        columns = [
            pa.array([k[0] for k in keys], pa.string()),
            pa.array([k[1] for k in keys], pa.string()),
            pa.array([k[2] for k in keys], pa.string()),
            pa.array([k[3] for k in keys], pa.int64()),
            pa.array([v[0] for v in values], pa.int64()),
            pa.array([(v[1] + (1 << 63)) % (1 << 64) - (1 << 63) for v in values], pa.int64()),
            pa.array([v[2] for v in values], pa.int32()),
            pa.array([v[3] for v in values], pa.int64()),
            pa.array([v[4] for v in values], pa.bool_()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["host", "place", "path", "text", "pages", "vector", "most", "chars", "aside"])


def _text_hash(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63) or 1


def _vector_part(page: int, count: int) -> int:
    """A page's part of an occurrence vector: a 56-bit hash of the page and the count there."""
    import xxhash

    return xxhash.xxh3_64_intdigest(b"%d %d" % (page, count)) >> 8


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, slot, fixed, further in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
            further = {(t["path"], t["text"]) for t in further or ()}
            texts.append("\n".join(main_blocks(page_blocks(source or "")[0], slot, fixed, further)))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes)], ["id", "url", "text", "n_chars"]
        )


def _is_text_part(steps: tuple[str, ...]) -> bool:
    """Whether a place inside the slot is a list, a table or a heading without names."""
    return bool(steps) and all(step in TEXT_PARTS for step in steps)


def main_blocks(
    blocks: list[Block], slot: str | None, fixed: list[str] | None, further: set[tuple[str, int]] | frozenset = frozenset()
) -> list[str]:
    """The texts of the article; see `extract_main_text`."""
    if slot is not None:
        depth, dropped = len(slot.split(" ")), set(fixed or ())
        inside = [b for b in blocks if _step(b.place[:depth]) == slot]
        if inside:
            left = [(b, _step(b.path)) for b in inside if not any(b.asides[depth:])]
            left = [(b, path) for b, path in left if path not in dropped or _is_text_part(b.path[depth:])]
            return [b.text for b, path in left if not further or (path, _text_hash(b.text)) not in further]
    for name in ARTICLE:
        found = []
        for block in blocks:
            depth = next((i + 1 for i, step in enumerate(block.path) if step.split(".")[0].split("#")[0] == name), None)
            if depth is not None and not any(block.asides):
                found.append(block.text)
        if found:
            return found
    return [b.text for b in blocks if not any(b.asides)]
