from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus_fixtures import awkward_documents, clashing, documents, prose
from pyspark.sql import functions as F

from reportloom.llm import decontamination, toxicity
from reportloom.llm.chat_windows import chat_windows, conversation_digests, escaped, loss_texts, read_turns, unescaped
from reportloom.llm.decontamination import find_benchmark
from reportloom.llm.html_pages import page_blocks
from reportloom.llm.html_template import deduced_templates, extract_main_text, host_of, main_blocks
from reportloom.llm.toxicity import Restorer, score_toxicity

# Benchmark decontamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower())


def plain_shingles(words, k):
    return Counter(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else Counter()


def plain_leaks(docs, items, k=5, least=0.8):
    """Best similarity of any span of any length within three words of the item's."""
    out = {}
    for i, text in docs:
        words = plain_words(text)
        for item, item_text in items:
            want = plain_shingles(plain_words(item_text), k)
            n = len(plain_words(item_text))
            for a in range(len(words)):
                for b in range(max(a + 1, a + n - 3), min(len(words), a + n + 3) + 1):
                    got = plain_shingles(words[a:b], k)
                    common = sum((got & want).values())
                    if common and common / (sum(got.values()) + sum(want.values()) - common) >= least:
                        similarity = common / (sum(got.values()) + sum(want.values()) - common)
                        out[i, item] = max(out.get((i, item), 0), similarity)
    return out


def test_benchmark_passages_against_plain_search(spark):
    items = [(1, prose(600, 14)), (2, prose(601, 25)), (3, prose(602, 58)), (4, "two words"), (5, None), (6, ""), (7, prose(602, 58)), (8, prose(603, 33))]
    docs = [(i, t) for i, t in awkward_documents() if t is None or len(t) < 3000]
    docs += [(500 + i, prose(i, 40) + " " + items[i][1].upper() + "!! " + prose(i + 7, 31 + i)) for i in (0, 1, 2, 7)]
    docs += [(520, items[1][1]), (521, items[0][1] + " end"), (522, "start " + items[7][1]), (523, "only two words here"), (524, "Two, WORDS")]
    words = items[2][1].split()
    docs += [(530, prose(8, 20) + " " + " ".join([*words[:20], "changed", *words[21:]]) + " " + prose(9, 20))]
    docs += [(531, " ".join([*words[:10], "x", "y", "z", *words[13:30], "x", "y", "z", *words[33:]]))]  # below the limit
    docs += [(532, " ".join(items[7][1].split()[2:]))]
    docs += [(533, items[0][1] + "\n" + items[0][1])]
    got = find_benchmark(clashing(documents(spark, docs)), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = plain_leaks(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(got) == len(want) and (531, 3) not in want and (530, 3) in want


def plain_leaks_of_any_length(docs, items, k=5, least=0.8):
    """Best similarity of any span whatever."""
    out = {}
    for i, text in docs:
        words = plain_words(text)
        for item, item_text in items:
            want = plain_shingles(plain_words(item_text), k)
            total, spans = sum(want.values()), []
            for a in range(len(words)):
                for b in range(a + 1, len(words) + 1):
                    got = plain_shingles(words[a:b], k)
                    common = sum((got & want).values())
                    spans.append(common / (sum(got.values()) + total - common))
            if max(spans, default=0) >= least:
                out[i, item] = max(spans)
    return out


def test_benchmark_passages_much_shorter_or_longer_than_the_item(spark):
    items = [(1, prose(610, 59)), (2, prose(611, 24)), (3, " ".join([prose(612, 9)] * 3))]
    docs = []
    for n, (_, text) in enumerate(items):
        words = text.split()
        cut = len(words) - (len(words) - 4) // 5
        for place, (before, behind) in enumerate([(0, 0), (25, 0), (0, 25), (25, 25)]):
            around = prose(620 + place, before), prose(630 + place, behind)
            middle = len(words) // 2
            passages = [words[:cut], words[-cut:], words[: cut - 1], [*words[:middle], *prose(640, 7).split(), *words[middle:]]]
            for kind, passage in enumerate(passages):
                docs.append((1000 * n + 10 * place + kind, " ".join([around[0], *passage, around[1]])))
    got = find_benchmark(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = plain_leaks_of_any_length(docs, items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert {(i, 1) for i in (0, 1, 10, 11, 20, 21, 30, 31)} <= set(want) and (2, 1) not in want
    texts, plain = dict(docs), dict(items)
    for r in got:  # the reported span has the reported similarity
        span = plain_shingles(plain_words(texts[r.doc_id])[r.start_word : r.start_word + r.n_words], 5)
        whole = plain_shingles(plain_words(plain[r.item_id]), 5)
        common = sum((span & whole).values())
        assert r.similarity == common / (sum(span.values()) + sum(whole.values()) - common)


def rare_words(seed, n):
    """Words that hardly ever come twice, so that texts are alike by nothing but the planted passages."""
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 11))) for _ in range(n))


def test_benchmark_passages_with_a_block_changed(spark):
    rng = np.random.default_rng(8)
    items = [(i, rare_words(650 + i, n)) for i, n in enumerate([200, 200, 120, 59, 40, 300])]
    docs = []
    for item, text in items:
        words = text.split()
        for kind in range(12):
            n = int(0.08 * len(words)) + 1 + kind % 3
            place = int(rng.integers(1, len(words) - n)) if kind > 5 else (len(words) - n) // 2
            new = rare_words(700 + kind, n).split()
            passage = [words[:place] + new + words[place + n :], words[:place] + words[place + n :], words[:place] + new + words[place:]][kind // 2 % 3]
            docs.append((100 * item + kind, " ".join([rare_words(800 + kind, 15), *passage, rare_words(820 + kind, 15)])))
    got = find_benchmark(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    found, similar = {(r.doc_id, r.item_id): r.similarity for r in got}, 0
    for doc, text in docs:
        words, want = plain_words(text), plain_shingles(plain_words(items[doc // 100][1]), 5)
        got = plain_shingles(words[15 : len(words) - 15], 5)  # the passage as planted
        common = sum((got & want).values())
        planted = common / (sum(got.values()) + sum(want.values()) - common)
        if planted >= 0.8:
            similar += 1
            assert found[doc, doc // 100] >= planted
    assert similar >= 40 and min(found.values()) >= 0.8


def test_benchmark_edge_cases(spark, monkeypatch):
    items = spark.createDataFrame([(1, prose(600, 20)), (2, prose(601, 25))], "item_id long, text string")
    rows = [(None, prose(600, 20)), (5, prose(601, 25)), (5, prose(601, 25))]
    for size in (decontamination.BATCH_BYTES, 150):  # one round or several
        monkeypatch.setattr(decontamination, "BATCH_BYTES", size)
        got = sorted((str(r.doc_id), r.item_id, r.similarity) for r in find_benchmark(documents(spark, rows), items).collect())
        assert got == [("5", 2, 1.0), ("5", 2, 1.0), ("None", 1, 1.0)]
        for kind in ("string", "int", "decimal(9,0)"):
            other = find_benchmark(documents(spark, rows), items.withColumn("item_id", F.col("item_id").cast(kind)))
            assert dict(other.dtypes)["item_id"] == kind
            assert sorted((str(r.doc_id), str(r.item_id), r.similarity) for r in other.collect()) == sorted((i, str(k), s) for i, k, s in got)
    assert find_benchmark(documents(spark, []), items).count() == 0
    assert find_benchmark(documents(spark), items.limit(0)).count() == 0


def test_fingerprints_within_the_radius_are_all_in_the_tables():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 2**63, 40, dtype=np.uint64)
    tables = decontamination.Items.tables(None, prints)
    for _ in range(500):
        value = int(rng.choice(prints))
        for bit in rng.choice(64, rng.integers(0, decontamination.RADIUS + 1), replace=False):
            value ^= 1 << int(bit)
        low, hit = 0, False
        for width, table in zip(decontamination.BLOCKS, tables):
            hit |= bool(table[(value >> low) & ((1 << width) - 1)])
            low += width
        assert hit


# Toxicity

BAD = ["vilething", "grubword", "nastyone", "schlimmwort"]


def labelled(n=900):
    rows, labels = [], []
    for i in range(n):
        text, toxic = prose(i, 25 + i % 40), int(i % 4 == 0)
        if toxic:
            words = text.split()
            words[i % len(words)] = BAD[i // 4 % len(BAD)]
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, toxic))
    return rows, labels


def test_toxicity_on_held_out_and_disguised_texts(spark):
    rows, labels = labelled()
    tests = [
        ("you are a v1l3thing", 1), ("such n a s t y o n e today", 1), ("GRUBWOOOORD now", 1), ("schl1mmw0rt, yes", 1), ("a v-i-l-e-t-h-i-n-g", 1),
        ("a quartz ridge in the north 1234 times", 0), ("", 0), (None, 0), (prose(5, 9000), 0), (prose(5, 9000) + " vilething", 1),
    ]
    docs = clashing(documents(spark, rows + [(5000 + k, t) for k, (t, _) in enumerate(tests)] + [(None, "vilething"), (5000, "vilething")]))
    scored = score_toxicity(
        docs, spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int"), 10_000, learn_from="doc_id % 5 <> 0"
    )
    got = {}
    for r in scored.collect():
        got.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(got[i][0].predicted, y) for i, y in labels if i % 5 == 0]
    assert np.mean([p == y for p, y in held]) >= 0.97
    assert [got[5000 + k][0].predicted for k in range(1, len(tests))] == [y for _, y in tests][1:]
    assert sorted(r.predicted for r in got[5000]) == [1, 1] and got[None][0].predicted == 1


def plain_scores(rows, labels, restorer):
    """Word list and scores by their definition: sets of words and beginnings per text, counts, intervals, sums."""
    folds = {c: c + 32 for c in [*range(65, 91), *range(0xC0, 0xDF)] if c != 0xD7}

    def features(text):
        words = re.findall(rb"[0-9a-z\x80-\xff]+", restorer.text((text or "").translate(folds)).translate(folds).encode())
        return {(0, w) for w in words} | {(n, w[:n]) for n in toxicity.PREFIX_BYTES for w in words if len(w) > n}

    found = {(t or "", labels[i]): features(t) for i, t in rows if i in labels}
    totals = [sum(y == label for _, y in found) for label in (0, 1)]
    base = math.log((totals[1] + 1) / (totals[0] + 1))
    counts = {}
    for (_, y), some in found.items():
        for f in some:
            counts.setdefault(f, [0, 0])[y] += 1
    weights, z2 = {}, toxicity.CAUTION**2
    for f, (zeros, ones) in counts.items():
        n, share = zeros + ones, ones / (zeros + ones)
        low = (share + z2 / (2 * n) - toxicity.CAUTION * math.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)
        if share >= toxicity.LEAST_SHARE and low >= 0.5:
            weights[f] = math.log(low / (1 - low)) - base
    logits = [base + sum(weights.get(f, 0) for f in features(t)) for _, t in rows]
    return [1 / (1 + math.exp(-min(30, max(-30, x)))) for x in logits], weights


def test_toxicity_scores_against_a_plain_version(spark):
    rows, labels = labelled(400)
    rng = random.Random(3)
    signs = {"o": "0", "i": "1", "e": "3", "a": "4", "s": "5", "t": "7", "b": "8"}
    for k in range(0, 400, 8):  # disguised in several ways, also where the label says so
        i, text = rows[k]
        words = [rng.choice(BAD)] + text.split()
        change = rng.choice([lambda w: "".join(signs.get(c, c) for c in w), lambda w: " ".join(w), lambda w: w[0] + w[1] * 4 + w[2:], str.upper])
        rows[k] = (i, " ".join(words[1:]) + " " + change(words[0]))
    rows += [(2000 + i, t) for i, t in enumerate([None, "", "  ", "É école vilething ÈÉ", "a" * 90 + " 12 34", prose(77, 400), rows[8][1]])]
    docs = documents(spark, rows)
    restorer = Restorer(toxicity.character_model(docs.select("text")))
    want, weights = plain_scores(rows, dict(labels), restorer)
    assert {w.encode() for w in BAD} <= {f[1] for f in weights}
    got = {r.doc_id: r.score for r in score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), 10_000).collect()}
    assert [got[i] for i, _ in rows] == pytest.approx(want, abs=1e-9)


def test_toxicity_of_several_words_in_spaced_letters(spark):
    rows, labels = labelled()
    tests = [("".join(w + " " for w in "amber birch vilething ocean".replace(" ", "")), 1), ("m a r s h n a s t y o n e g r u b w o r d", 1)]
    tests += [("see s.l.o.p.e.s.c.h.l.i.m.m.w.o.r.t.t.a.r.n", 1), ("q u a r t z r i d g e n o r t h", 0), ("1 2 3 4 5", 0)]
    tests += [(" ".join(prose(9, 3000).replace(" ", "")) + " v i l e t h i n g " + " ".join(prose(10, 3000).replace(" ", "")), 1)]
    docs = documents(spark, rows + [(5000 + k, t) for k, (t, _) in enumerate(tests)])
    scored = score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), 10_000)
    got = {r.doc_id: r.predicted for r in scored.where("doc_id >= 5000").collect()}
    assert [got[5000 + k] for k in range(len(tests))] == [y for _, y in tests]


def test_toxicity_of_disguises_anywhere_in_a_word(spark):
    rows, labels = labelled()
    bad = ["such a nastyon3", "GRUBW0RD|", "schlimmwor7!", "schlimmw0r7", "grubword99", "grubword$!", "you-v1l3thing", "amber,gru8word", "(x)nasty0ne"]
    bad += ["n" + "a" * 70 + "styone", "vilethi" + "n" * 5000 + "g", "v i l e t h ! n g", "gr" + "u" * 64 + "8word" + "!" * 80, "ridge|vilething", "marsh_v1l3thing"]
    clean = ["amber! birch 1234 cedar7", "you-r1dge", "o" + "c" * 70 + "ean", "x" * 200 + "1" * 200, "a" * 70]
    tests = [(t, 1) for t in bad] + [(t, 0) for t in clean]
    docs = documents(spark, rows + [(5000 + k, t) for k, (t, _) in enumerate(tests)])
    scored = score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), 10_000)
    got = {r.doc_id: r.predicted for r in scored.where("doc_id >= 5000").collect()}
    assert [t for k, (t, y) in enumerate(tests) if got[5000 + k] != y] == []


def test_suspicious_rows_cover_the_disguises():
    texts = ["a55", "dumba55", "you-1d1ot", "i d ! o t", "mééérde", "idiot!", "plain words, twoo.", "12 345 - a b"]
    (block,) = decontamination.text_blocks(pa.array(texts))
    raw, offsets = toxicity.folded(block[2]), block[3]
    assert toxicity.suspicious_rows(raw, offsets).tolist() == [True] * 6 + [False] * 2


def test_toxicity_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in score_toxicity(documents(spark, [(1, "x"), (2, None)]), labels, 100).collect()} == {(0.5, 1)}
    assert score_toxicity(documents(spark, []), labels, 100).count() == 0
    kept = score_toxicity(clashing(documents(spark)), labels, 100, keep=["doc_id", "text", "lang", "score"])
    assert kept.columns == ["doc_id", "text", "lang", "score", "predicted"]


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    model = np.log(rng.dirichlet(np.ones(toxicity.LETTERS), (toxicity.LETTERS, toxicity.LETTERS))).astype(np.float32)
    restorer = Restorer(model)

    def cost(text, signs):
        padded = [0, 0, *map(toxicity._symbol, text), 0]
        return sum(float(model[a, b, c]) for a, b, c in zip(padded, padded[1:], padded[2:])) - toxicity.SIGN_COST * signs

    for word in ("c1a3t", "p0|1n", "1d10t", "x1", "a8b"):
        readings = [""]
        for char in word:
            readings = [r + x for r in readings for x in toxicity.SIGNS.get(char, char)]
        signs = sum(c in toxicity.SIGNS for c in word)
        assert restorer._decode(word) == max(readings, key=lambda r: cost(r, signs))
    assert restorer.word("plain") == "plain" and restorer.word("4") == "4"


# Pages

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href="/a">Home</a><li>News</ul></nav><!-- <p>no</p> --><div class="cookie-notice">We use cookies</div>
<div id="wrap"><article class="post-{n}"><header><h1>Title  {n}</h1></header><p>First <b>bold</b>ed {text} &lt;tag&gt; &eacute;&#233;<br>line
<p>Second {text}<ul><li>one<li>two</ul><div class="share">Share!</div><form>Mail <input></form><table><tr><td>x<td>y</table>
</article><section id="comments"><p>A comment {n}</p></section></div><aside>Side {n}</aside><footer>&copy; host</footer></body></html>"""


def page(n):
    text = f"text of page {n} " * 5
    html = PAGE.format(n=n, text=text)
    plain = " ".join(text.split())
    return html, "\n".join([f"Title {n}", f"First bolded {plain} <tag> éé line", f"Second {plain}", "one", "two", "x", "y"])


def test_main_text_of_hosts_with_and_without_template(spark):
    rows = [(i, f"https://user@Big.example:80/{i}?q=//x/", *page(i)) for i in range(30)]
    rows += [(100 + i, f"http://small{i}.example/", *page(i)) for i in range(3)]
    rows += [(200, None, *page(200)), (201, "http://a.example", None, ""), (202, "http://a.example", "", ""), (203, "no url", "just < text &amp; more", "just < text & more")]
    rows += [(204, "http://b.example/", "<p>cut off <b>bold", "cut off bold"), (204, "http://b.example/", "<p>cut off <b>bold", "cut off bold")]
    rows += [(205, "http://b.example/", "<script>never ends <p>x", ""), (206, "http://b.example/", "<p title='a>b'>" + "long " * 50_000, ("long " * 50_000).strip())]
    # no article element: the slot comes from the template; the tagline is the same on all pages
    for i in range(20):
        body = f"<body><div class=top>Tagline of the host</div><div class=body><div>Story {i} " + "word " * i + "</div><div>same passage</div></div></body>"
        rows.append((300 + i, f"http://plain.example/{i}", body, " ".join(f"Story {i} {'word ' * i}".split()) + "\nsame passage"))
    table = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)
    table = table.withColumns({n: F.lit("x") for n in ("host", "slot", "fixed", "text", "n_chars", "path", "id")})
    got = extract_main_text(table)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id, str(r.url), r.text, r.n_chars) for r in got.collect()) == sorted((i, str(u), t, len(t)) for i, u, _, t in rows)


def test_fixed_texts_leave_the_variable_ones_at_their_place(spark):
    rows = []
    html = "<body><div class=wrap><article><h1>{}</h1><span class=by>{}</span>{}</article></div></body>"
    disclaimer = "This disclaimer stands below each article. " * 20
    for i in range(20):  # short articles, each with the same long paragraph behind
        text = f"Short article {i} " + prose(i, 12)
        rows.append((i, f"http://short.example/{i}", html.format(f"Title {i}", f"By {i}", f"<p>{text}<p>{disclaimer}"), f"Title {i}\nBy {i}\n{text}"))
    copied = [prose(900 + k, 150) for k in range(4)]
    for i in range(20):  # most pages hold one article, under dates of their own
        parts = copied if i % 20 < 14 else [prose(1000 + 10 * i + k, 40) for k in range(3)]
        rows.append((100 + i, f"http://copies.example/{i}", html.format(f"Title {i}", f"Day {i}", "".join(f"<p>{x}" for x in parts)), "\n".join([f"Title {i}", f"Day {i}", *parts])))
    table = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in extract_main_text(table).collect()}
    assert got == {i: text for i, _, _, text in rows}


def test_template_of_a_host(spark):
    rows = [(i, f"http://h.example/{i}", page(i)[0]) for i in range(12)]
    table = spark.createDataFrame(rows, "id long, url string, html string").withColumn("host", host_of(F.col("url")))
    (found,) = deduced_templates(table).collect()
    assert found.slot == "html body div#wrap article.post-0"
    assert "html body div.cookie-notice" in found.fixed and extract_main_text(table.limit(0), "id").count() == 0


def test_articles_of_lists_and_single_paragraphs(spark):
    rows = []
    for i in range(30):  # recipes: repeated subheadings and ingredients, one long paragraph
        parts = [f"Dish {i}", "Ingredients", "salt", f"spice {i}", "Method", "Do so. " + prose(i, 60)]
        body = "<h1>{}</h1><h2>{}</h2><ul><li>{}<li>{}</ul><h2>{}</h2><p>{}</p>".format(*parts)
        rows.append((i, f"http://recipes.example/{i}", f"<html><body><div class=top>All recipes</div><article>{body}</article></body>", "\n".join(parts)))
    for i in range(20):  # no article element: the headline stands beside the container of the text
        parts = [f"Report {i}", prose(100 + i, 50), prose(200 + i, 50)]
        body = "<div id=page><h1>{}</h1><div class=text><p>{}</p><p>{}</p></div></div>".format(*parts)
        rows.append((100 + i, f"http://reports.example/{i}", f"<html><body><div class=top>Welcome</div>{body}<div class=end>Imprint</div></body>", "\n".join(parts)))
    table = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in extract_main_text(table).collect()} == {i: text for i, _, _, text in rows}


STRIPPED = "<html><body><div><ul><li>{a}<li>{b}</ul></div><div>{ad}</div><div><h1>{title}</h1><p>{one}<p>{two}</div><div>{foot}</div></body></html>"


def test_pages_without_names_are_told_by_their_template(spark):
    """No class, no id, no telling element: menus and adverts vary, too, and only occurrences tell the article."""
    rows, numbered = [], []
    for i in range(24):
        parts = {"title": f"Title {i} " + prose(i, 3), "one": prose(100 + i, 70), "two": prose(200 + i, 40)}
        rest = {"a": prose(300 + i, 1), "b": prose(400 + i, 1), "ad": prose(500 + i, 9), "foot": prose(600 + i, 4)}
        text = "\n".join(parts.values())
        rows.append((i, f"http://stripped.example/{i}", STRIPPED.format(**parts, **rest), text))
        # a host on which the advert is not on all pages: numbers say nothing there, so nothing is lost
        html = STRIPPED.format(**parts, **rest)
        if i % 2:
            html = html.replace(f"<div>{rest['ad']}</div>", "")
        rows.append((100 + i, f"http://changing.example/{i}", html, None))
        numbered.append((100 + i, text))
    table = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in extract_main_text(table).collect()}
    assert {i: got[i] for i in range(24)} == {i: t for i, _, _, t in rows if t is not None}
    assert all(text in got[i] for i, text in numbered)
    blocks, _ = page_blocks(rows[0][2])
    assert "\n".join(main_blocks(blocks, None, None)) != rows[0][3]  # the words for asides alone do not tell
    slots = {r.host: r.slot for r in deduced_templates(table.withColumnRenamed("page_id", "id").withColumn("host", host_of(F.col("url")))).collect()}
    assert slots == {"stripped.example": "html body div:3", "changing.example": "html body"}


def test_reader_of_deep_pages():
    deep = "<body>" + "<div>" * 50_000 + "text" + "</div>x" * 50_000
    blocks, seen = page_blocks(deep)
    assert len(blocks) == 50_001 and len(seen) == 64 and sum(map(len, seen)) < 10_000
    blocks, _ = page_blocks("<body>" + "<div>" * 100 + "a<nav>menu</nav>b" + "</div>" * 100 + "c")
    assert [(b.text, any(b.asides)) for b in blocks] == [("a", False), ("menu", True), ("b", False), ("c", False)]


def test_page_reader_and_slots():
    blocks, seen = page_blocks(page(3)[0])
    assert seen["html", "body", "div#wrap", "article.post-0", "p"] == 2
    assert "\n".join(main_blocks(blocks, None, None)) == page(3)[1]
    assert main_blocks(blocks, "html body nowhere", None) == main_blocks(blocks, None, None)
    assert main_blocks(page_blocks("<div><p>a</div><p>b</p></p>c")[0], None, None) == ["a", "b", "c"]


# Chat windows


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)


def chat_rows():
    rows = []
    for c in range(12):
        if c % 3:
            rows.append((c, 0, "system", prose(c, 12)))
        rows += [(c, t, "user" if t % 2 else "assistant", prose(100 * c + t, 3 + (7 * t * c) % 60)) for t in range(1, 1 + 3 * c)]
    rows += [(50, 0, "system", "alone"), (51, 0, "user", None), (51, None, None, ""), (51, 5, "assistant", "<|end|><|user|>&lt; | é日")]
    rows += [(52, 1, "assistant", "same"), (52, 1, "assistant", "same"), (53, 0, "assistant", prose(9, 4000)), (53, 1, "system", "late"), (53, 2, "assistant", "end")]
    return rows + [(None, 0, "user", "no id")]


@pytest.mark.parametrize(("budget", "history"), [(120, 30), (64, 0), (100_000, 500), (1, 5)])
def test_windows_give_every_turn_and_target_once(spark, budget, history):
    rows = chat_rows()
    windows = chat_windows(turns_of(spark, rows).withColumns({n: F.lit("x") for n in ("place", "window", "tokens", "kind", "piece")}), budget, history).cache()
    want = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    got = {}
    for r in sorted(read_turns(windows).collect(), key=lambda r: (r.conv_id, r.window, r.place)):
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == want
    loss = {}
    for r in sorted(loss_texts(windows).collect(), key=lambda r: (r.conv_id, r.window)):
        loss[r.conv_id] = loss.get(r.conv_id, "") + r.text
    assert loss == {c: "".join(t for role, t in turns if role == "assistant") for c, turns in want.items()}
    for r in conversation_digests(windows, budget).collect():
        turns, answer = want[r.conv_id], loss[r.conv_id]
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(answer), hashlib.sha256(answer.encode()).hexdigest())
        assert r.n_over_budget == 0
    if budget == 120:
        sizes = windows.where("conv_id < 50").select("n_tokens", "n_repeated", "formatted").collect()
        assert all(r.n_tokens <= budget or r.formatted.count("<|end|>") - r.n_repeated == 1 for r in sizes)
        systems = windows.where("conv_id = 11").select("formatted").collect()
        assert len(systems) > 2 and all(r.formatted.startswith("<|system|>") for r in systems)
        assert any(r.n_repeated > 1 for r in sizes)


@pytest.mark.parametrize(("budget", "history"), [(200, 50), (200, 190), (90, 40), (50, 10)])
def test_windows_keep_the_budget(spark, budget, history):
    """Long turns behind short ones, and system turns that leave little room: counted from the formatted text itself."""
    rng = random.Random(budget + history)
    rows = []
    for c in range(60):
        if c % 2:
            rows.append((c, 0, "system", "s" * rng.choice([4, 100, 4 * budget - 60, 4 * budget + 100])))
        rows += [(c, t, rng.choice(["user", "assistant"]), "x" * rng.choice([1, 20, 60, 4 * budget // 3, 4 * budget - 40, 5 * budget])) for t in range(1, rng.randint(2, 15))]
    windows = chat_windows(turns_of(spark, rows), budget, history).collect()
    repeated = 0
    for r in windows:
        turns = re.findall(r"<\|([^|]*)\|>([^<]*)<\|end\|>", r.formatted)
        tokens = [-(-len(text) // 4) + 4 for _, text in turns]
        assert sum(tokens) == r.n_tokens and len(turns) == r.n_new + r.n_repeated
        assert sum(tokens) <= budget or (r.n_new == 1 and r.n_history == 0), (r.conv_id, r.window)
        system = turns[0][0] == "system" and r.n_repeated > r.n_history
        assert sum(tokens[system : r.n_repeated]) <= history and r.n_history == r.n_repeated - system
        repeated += r.n_history
    assert sum(r.n_new for r in windows) + sum(r.n_repeated > r.n_history for r in {r.conv_id: r for r in windows}.values()) == len(rows)
    assert repeated > 10


def test_windows_of_nothing_and_escapes(spark):
    assert chat_windows(turns_of(spark, []), 100, 10).count() == 0
    texts = ["", "&amp;", "&lt;|&", "<|end|>", "&amp;lt;", "a|b>c", "&#124;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescaped(F.col("e")).alias("u")).collect():
        assert r.u == r.t and "<" not in r.e and "|" not in r.e


def test_windows_run_without_python(spark):
    windows = chat_windows(turns_of(spark, chat_rows()[:4]), 100, 10)
    plan = conversation_digests(windows, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_blocks_of_one_text_and_many():
    texts = pa.array([None, "", "a b", "é" * 3_000_000, "x y z"])
    sizes = [(first, end, len(raw)) for first, end, raw, _ in decontamination.text_blocks(texts)]
    assert [s[0] for s in sizes] == [0, *[s[1] for s in sizes[:-1]]] and sum(s[2] for s in sizes) == 6_000_008
