"""The training-data operators on odd rows, and against brute force."""

from __future__ import annotations

import difflib
import html
import math
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from basinspark.llm.common import remainder, words


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


# Quality rules


def test_quality_counts_of_odd_rows(docs):
    from basinspark.llm.quality_rules import quality_verdicts

    found = by_id(quality_verdicts(docs), "n_words", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert found[1000] == found[1001] == found[1002] == (0, 0, 0, 0, True)
    assert found[1003] == (3, 3, 0, 0, True)
    assert found[1004][0] == found[1004][3] == 90000
    assert quality_verdicts(docs).count() == docs.count()


def test_repeated_words_against_brute_force(spark):
    from basinspark.llm.quality_rules import covered_words

    rng = random.Random(5)
    texts = [[rng.choice("ab") for _ in range(rng.randint(0, 40))] for _ in range(60)]
    expected = []
    for t in texts:
        seen = Counter(tuple(t[i : i + 5]) for i in range(len(t) - 4))
        expected.append(len({i + k for i in range(len(t) - 4) if seen[tuple(t[i : i + 5])] > 1 for k in range(5)}))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t array<string>")
    assert [r[0] for r in df.orderBy("i").select(covered_words(F.col("t"))).collect()] == expected


def test_lines_above_limits_go_and_depleted_documents_fail(spark, nothing):
    from basinspark.llm.quality_rules import LineLimits, quality_verdicts, without_frequent_lines

    banner = "Subscribe to our letter no 7 now"
    rows = [(i, f"{banner}\n" + " ".join("w" + "abcdef"[i] * (k + 1) for k in range(20)), "h") for i in range(6)]
    rows += [(6, banner + "\n" + "more of the usual words here and there now yes", "h2"), (7, banner.replace("7", "8") + "\nshort", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limits = LineLimits(documents=5, share=0.1)
    found = by_id(quality_verdicts(df, limits), "removed_lines", "kept")
    assert found[0] == (1, True) and found[6][0] == 0 and found[7] == (1, False)
    cleaned = by_id(without_frequent_lines(df, limits), "text")
    assert banner not in cleaned[0][0] and cleaned[6][0].startswith(banner) and cleaned[7] == ("short",)
    # exact copies count as one text
    copies = spark.createDataFrame([(i, rows[0][1], "h") for i in range(30)], df.schema)
    assert quality_verdicts(copies, limits).where("removed_lines > 0").count() == 0
    assert quality_verdicts(nothing).count() == 0


# Language


def test_languages_of_whole_and_mixed_texts(docs, corpus):
    from basinspark.llm.language_spans import fit_languages, identified

    model = fit_languages(docs.where("doc_id < 1000"))
    found = by_id(identified(docs, model, [F.col("doc_id")]), "lang_pred", "score", "spans")
    assert np.mean([found[i][0] == lang for i, _, lang, _ in corpus]) > 0.97
    assert found[1000] == found[1001] == found[1003] == ("und", 0.0, [])
    en, fr = corpus[1][1], corpus[0][1]
    mixed = docs.sparkSession.createDataFrame([(1, f"{en} {fr} {en}", "x")], "doc_id long, text string, score string")
    (lang, score, spans), = by_id(identified(mixed, model, [F.col("doc_id")]), "lang_pred", "score", "spans").values()
    assert [s["lang"] for s in spans] == ["en", "fr", "en"] and abs(spans[1]["begin"] - len(en)) < 12 and lang in ("en", "fr") and 0 < score < 1


def test_viterbi_against_all_paths():
    from itertools import product

    from basinspark.llm.language_spans import best_paths, needs_switches

    rng = np.random.default_rng(1)
    for _ in range(40):
        scores = rng.normal(size=(6, 3)) * 3
        value = lambda path: sum(scores[i, k] for i, k in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:], strict=False))  # noqa: B023, E731
        best = max(product(range(3), repeat=6), key=value)
        assert value(best_paths(scores, [6], 2.0)) == pytest.approx(value(best))
        if not needs_switches(scores, 2.0):
            assert len(set(best)) == 1


def test_hundreds_of_languages():
    """Labels beyond one byte: with 300 languages each stretch of a text gets its own."""
    from basinspark.llm.language_spans import best_paths

    rng = np.random.default_rng(2)
    truth = np.repeat(rng.permutation(300)[:40], 5)
    scores = rng.normal(size=(200, 300)) * 0.1
    scores[np.arange(200), truth] += 9.0
    assert best_paths(scores, [120, 80], 2.0).tolist() == truth.tolist()


def test_languages_without_labels_and_rows(docs, nothing):
    from basinspark.llm.language_spans import fit_languages, identified

    model = fit_languages(nothing)
    assert {r[0] for r in identified(docs, model, [F.col("doc_id")]).select("lang_pred").collect()} == {"und"}
    assert identified(nothing, model, [F.col("doc_id")]).count() == 0


def test_script_rules_out_languages(spark):
    from basinspark.llm.language_spans import fit_languages, identified

    rows = [(i, t, lang) for i, (t, lang) in enumerate([("привет мир как дела", "ru"), ("hello world how are you", "en")] * 5)]
    model = fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = spark.createDataFrame([(1, "щщщ ъъъ"), (2, "zzz qqq"), (3, "漢字 仮名")], "doc_id long, text string")
    found = by_id(identified(odd, model, [F.col("doc_id")]), "lang_pred")
    assert found[1] == ("ru",) and found[2] == ("en",) and found[3][0] in ("ru", "en")


# Join


def brute_components(rows, percent=75):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, len(sets[i]), least.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)]


def test_join_against_brute_force(docs, spark, nothing):
    from basinspark.llm.ngram_join import JoinParameters, near_duplicates

    rng = random.Random(9)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    base = [f"w{k}" for k in range(60)]
    for i in range(70):  # a chain of near copies, some exact, and a passage that many texts share
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(60)] = f"v{rng.randrange(1000)}"
        rows.append((2000 + i, " ".join(own)))
        rows.append((3000 + i, " ".join(base[:20] + [f"u{i}x{k}" for k in range(rng.randint(3, 40))])))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("x"))
    found = near_duplicates(df, params=JoinParameters(heavy_copies=2, heavy_block=2000))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id").collect()), key=key) == sorted(brute_components(rows), key=key)
    assert near_duplicates(nothing).count() == 0


# Decontamination


def edit_distance(pattern: bytes, text: bytes) -> int:
    """Least edits of the pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks_against_full_alignment(docs, spark, nothing):
    from basinspark.llm.decontamination import LeakIndex, LeakParameters, leaks_of, normal, with_leaks

    rng = random.Random(4)
    letters = "abcdefghij klmnop "
    items = [(i, "".join(rng.choice(letters) for _ in range(rng.choice([30, 90, 260])))) for i in range(6)] + [(6, "tiny bit"), (7, None), (8, "")]
    texts = ["tiny bit", "a tiny bit more", "atiny bit", None, ""]
    for _ in range(40):
        item, cut = list(rng.choice(items[:6])[1]), rng.randrange(200)
        for _ in range(rng.randint(0, 26)):
            item[rng.randrange(len(item))] = rng.choice("xyz")
        noise = "".join(rng.choice(letters) for _ in range(200))
        texts.append(noise[:cut] + "".join(item) + noise[cut:])
    index = LeakIndex([x for x in items if x[1] is not None], LeakParameters())
    found = leaks_of(texts, index)
    for text, own in zip(texts, found, strict=True):
        got = {(leak["item_id"], leak["edits"]) for leak in own if leak["item_id"] < 6}
        expected = {}
        for w, window in enumerate(index.windows):
            edits = edit_distance(window, normal(text))
            if edits <= index.edits[w]:
                key = index.ids[index.item[w]]
                expected[key] = min(edits, expected.get(key, 99))
        assert got == set(expected.items())
    assert [any(x["item_id"] == 6 for x in own) for own in found[:5]] == [True, True, False, False, False]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    small = LeakParameters(block_bytes=100)  # several blocks
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("leaks", F.lit(1))
    rows = with_leaks(df, benchmark, [F.col("doc_id")], small)
    assert [sorted(x["item_id"] for x in r["leaks"] or []) for r in rows.orderBy("doc_id").collect()] == [sorted(x["item_id"] for x in own) for own in found]
    assert with_leaks(docs, benchmark.limit(0), [F.col("doc_id")]).where("leaks is not null").count() == 0
    assert with_leaks(nothing, benchmark, [F.col("doc_id")]).count() == 0


def test_leak_in_a_text_longer_than_a_piece():
    from basinspark.llm.decontamination import LeakIndex, LeakParameters, leaks_of

    rng = random.Random(2)
    item = "".join(rng.choice("abcdefgh ") for _ in range(180))
    noise = "".join(rng.choice("klmnopqrst ") for _ in range(9000))
    index = LeakIndex([(1, item)], LeakParameters(piece=2048))
    for cut in (0, 1900, 2040, 2048, 4000, 9000):
        leak, = leaks_of([noise[:cut] + item + noise[cut:]], index)[0]
        assert leak["edits"] == 0


# Toxicity


def test_toxic_texts_and_offsets(docs, corpus, nothing):
    from basinspark.llm.toxic_spans import ToxicParameters, fit_toxicity, toxicity_scored

    spark = docs.sparkSession
    labels = spark.createDataFrame([(i, int(i % 8 == 1)) for i, *_ in corpus if i % 4 != 2], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels, ToxicParameters(steps=30))
    found = by_id(toxicity_scored(docs, model, [F.col("doc_id")]), "score", "offsets")
    right = [(found[i][0] >= 0.5) == (i % 8 == 1) for i, *_ in corpus]
    assert np.mean(right) > 0.97
    text, places = corpus[9][1], found[9][1]
    assert any(text[p["begin"] : p["end"]] == "blockhead" for p in places)
    assert found[1000] == found[1001] and found[1000][0] < 0.5 and found[1000][1] == []
    no_labels = fit_toxicity(docs, labels.where("toxic = 0"))
    assert {r[0] for r in toxicity_scored(docs, no_labels, [F.col("doc_id")]).select("score").collect()} == {0.0}
    assert toxicity_scored(nothing, model, [F.col("doc_id")]).count() == 0
    assert fit_toxicity(nothing, labels).weights is None


def test_marginals_against_all_paths():
    from itertools import product

    from basinspark.llm.toxic_spans import forward_backward

    rng = np.random.default_rng(2)
    odds, moves = rng.normal(size=9), rng.normal(size=(2, 2))
    p, expected = forward_backward(odds, [4, 5], moves)
    total = np.zeros((2, 2))
    for begin, n in ((0, 4), (4, 5)):
        weight, mass, counts = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in product((0, 1), repeat=n):
            w = math.exp(sum(odds[begin + i] * y for i, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
            weight += w
            mass += w * np.array(path)
            for a, b in zip(path, path[1:], strict=False):
                counts[a, b] += w
        assert p[begin : begin + n] == pytest.approx(mass / weight)
        total += counts / weight
    assert expected == pytest.approx(total)


# Urls


def test_url_parts_rules_and_reputation(spark):
    from basinspark.llm.url_reputation import Reputation, Rule, judged_urls

    rules = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/")]
    urls = {
        1: "HTTP://A.Example.com/en/x?y#z", 2: "http://www.example.com/en/1", 3: "http://badexample.com/en/", 4: "http://x.com?q=/en/", 5: None, 6: "no scheme",
        7: "http://bad.org/1", 8: "http://bad.org/2", 9: "http://good.org/", 10: "http://new.org/", 11: "", 12: "://h.org",
    }
    pages = spark.createDataFrame(list(urls.items()), "page_id long, url string").withColumn("host", F.lit("x")).withColumn("bad", F.lit(1))
    outcomes = [("http://bad.org/1", 1)] * 40 + [("http://good.org/", 0)] * 60 + [("http://good.org/", None)]
    found = judged_urls(pages, spark.createDataFrame(outcomes, "url string, bad int"), rules)
    rows = {r["page_id"]: r for r in found.collect()}
    assert (rows[1]["host"], rows[1]["path"], rows[1]["rule"], rows[1]["verdict"]) == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert rows[2]["rule"] == "www.example.com/en/" and rows[3]["rule"] == "com/" and rows[4]["rule"] is None and rows[4]["path"] == ""
    assert all((rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == ("", "", None) for i in (5, 6, 11)) and rows[12]["host"] == "h.org"
    assert rows[7]["verdict"] == rows[8]["verdict"] == "block" and rows[9]["verdict"] == rows[10]["verdict"] == "allow"
    assert 0 < rows[9]["bad_rate"] < rows[10]["bad_rate"] < rows[7]["bad_rate"] < 1
    none = judged_urls(pages, spark.createDataFrame([], "url string, bad int"), rules, Reputation(long_suffixes=()))
    assert {r["verdict"] for r in none.collect() if r["rule"] is None} == {"allow"}
    assert judged_urls(pages.limit(0), spark.createDataFrame(outcomes, "url string, bad int"), rules).count() == 0


# Extraction


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) "</p>"</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav>
<div id="cookie-banner">We use cookies to make everything on this page work as you would want it to.</div>
<article><h1>Title &amp; more</h1><p><b>First   block<br>Second&nbsp;line</b><p>Short.<ul><li>one<li>two</ul>
<form><p>Your mail<input></form><aside><p>See also this and that and more</aside><!-- no --></article>
<section class="Comments"><p>I liked this article very much, thank you for writing all of it.</section>
<footer>&copy; 2020</footer>"""


def test_extraction_of_pages(spark):
    from basinspark.llm.extraction import extracted, main_text

    expected = "Title & more\nFirst block\nSecond line\nShort.\none\ntwo"
    assert main_text(PAGE) == expected and main_text(PAGE + "<div") == expected and main_text(PAGE + "</body></html>") == expected
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "plain text, no tags"), (5, "u", "<p>" + "long " * 50000), (6, "u", "<nav>only</nav>"), (1, "u", PAGE)]
    found = extracted(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))).collect()
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts == {1: expected, 2: "", 3: "", 4: "plain text, no tags", 5: ("long " * 50000).strip(), 6: ""}
    assert all(r["n_chars"] == len(r["text"]) for r in found) and len(found) == 7


@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
def test_extraction_round_trip(tag):
    from basinspark.llm.extraction import main_text

    rng = random.Random(len(tag))
    for _ in range(20):
        blocks = [" ".join(rng.choice(["a<b", "x&y", "word", "é"]) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 12))]
        page = f"<body><nav><a href=/>m</a></nav><{tag}>" + "".join(f"<p>{html.escape(b)}</p>\n" for b in blocks) + f"</{tag}><footer>f</footer></body>"
        assert main_text(page) == "\n".join(blocks)


LONG = "<p>" + "body of the text " * 25 + "</p>"
CASES = {
    "sections": (f"<article><h2>T</h2><section>{LONG}</section><section><p>Short.</p></section><section><ul><li>a</li><li>b</li></ul></section></article>", ["T", LONG, "Short.", "a", "b"]),
    "title and intro": (f"<div class=page><h1>T</h1><div>Intro.</div><div>{LONG}</div></div><div><a href=x>one</a> <a href=y>two</a></div>", ["T", "Intro.", LONG]),
    "layout class": (f'<div class="content has-sidebar"><h1>T</h1>{LONG}</div><div class=sidebar>{LONG}</div>', ["T", LONG]),
    "marked wrapper": (f'<div class="legal notices"><h1>T</h1>{LONG}{LONG}{LONG}</div><div>x</div>', ["T", LONG, LONG, LONG]),
    "marked article": (f'<article class="legal post">{LONG}</article><div class=ad>Buy.</div>', [LONG]),
    "comments": (f"<article><p>Short text.</p></article><div id=comments>{LONG * 9}</div>", ["Short text."]),
    "comment articles": (f"<article><p>Short text.</p></article><article class=comment>{LONG * 9}</article>", ["Short text."]),
    "hidden": (f"<div hidden><article>{LONG}</article></div><article><p>Seen.</p></article>", ["Seen."]),
    "main": (f"<main><h1>T</h1><section>{LONG}</section><section><p>End.</p></section></main><div>{LONG}</div>", ["T", LONG, "End."]),
    "deep": ("<div>" * 3000 + f"<h1>T</h1>{LONG}", ["T", LONG]),
}


@pytest.mark.parametrize("name", CASES)
def test_extraction_keeps_whole_articles(name):
    from basinspark.llm.extraction import main_text

    page, blocks = CASES[name]
    expected = [" ".join(b.removeprefix("<p>").removesuffix("</p>").split()) for b in blocks]
    assert main_text(f"<html><body><nav>menu</nav>{page}<footer>foot</footer></body></html>") == "\n".join(expected)


def test_extraction_of_generated_layouts():
    """Articles of sections, nested divs, lists and tables in marked and unmarked wrappers, with clutter around them."""
    from basinspark.llm.extraction import main_text

    rng = random.Random(21)
    for _ in range(60):
        blocks = [f"block {i} " + "of many plain words " * rng.randint(0, 12) for i in range(rng.randint(2, 10))]
        body, k = "", 0
        while k < len(blocks):
            size = rng.randint(1, 3)
            inner = "".join(rng.choice(["<p>{}</p>", "<div>{}</div>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<table><tr><td>{}</td></tr></table>"]).format(b) for b in blocks[k : k + size])
            body += rng.choice(["{}", "<section>{}</section>", "<div><div>{}</div></div>", "<section class=intro>{}</section>"]).format(inner)
            k += size
        wrapper = rng.choice(["<article>{}</article>", "<main>{}</main>", '<div class="no-sidebar"><article class="post">{}</article></div>', '<main class="has-menu">{}</main>'])
        clutter = ["<nav><a href=/>home</a></nav>", '<div class="ad">Buy now.</div>', "<aside>Aside words.</aside>", '<div id="cookie-notice">We use cookies.</div>', "<script>var p = '<p>no</p>';</script>", '<section class="comments"><p>I agree.</p></section>']
        rng.shuffle(clutter)
        page = "".join(clutter[:3]) + wrapper.format(body) + "".join(clutter[3:])
        assert main_text(page) == "\n".join(" ".join(b.split()) for b in blocks)


# Licenses


def test_license_notices(docs, spark, nothing):
    from basinspark.llm.licenses import TEMPLATES, scanned

    texts = {
        1: "Intro.\nReleased under the MIT License.", 2: "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.", 3: "He has a driving license.",
        4: "This work is licensed under the GNU General Public License, version 3, as stated.", 5: "Licensed under the Apache License, Version 1.1.",
        6: "x " * 3000 + TEMPLATES["MIT-text"] + " y" * 3000, 7: None, 8: "",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("license", F.lit("x"))
    found = scanned(df).collect()
    got = {(r["doc_id"], r["license"]) for r in found}
    assert got == {(1, "MIT"), (2, "CC-BY-NC-4.0"), (2, "CC-BY-4.0"), (4, "GPL-3.0"), (6, "MIT-text")}
    assert all(r["block"] == texts[r["doc_id"]][r["offset"] : r["offset"] + len(r["block"])] for r in found)
    assert scanned(docs).count() == scanned(nothing).count() == 0


def test_license_ranking_against_all_templates():
    """The compression ranking finds the same notice as comparing the words of every template."""
    from basinspark.llm.licenses import TEMPLATES, Ranking, ScanParameters, scan_block, tokens

    ranking = Ranking(TEMPLATES, ScanParameters())
    altered = {n: (t, t.replace(" the ", " "), t.lower(), f"Some words before. {t} And some after it, of no matter.") for n, t in TEMPLATES.items()}
    for name, texts in altered.items():
        for number, text in enumerate(texts):
            found = scan_block(text, ranking)
            best = max(TEMPLATES, key=lambda n: difflib.SequenceMatcher(None, tokens(TEMPLATES[n]), tokens(text)).ratio())
            assert found and found[0]["license"] == best == name and (number == 1 or found[0]["exact"])
            assert ranking(text)[0][2] == name


def test_license_scans_of_own_templates_and_small_changes(spark):
    from basinspark.llm.licenses import scanned

    own = {"House": "Only members of this house can read these pages.", "Plain": "You may use it for any work."}
    rows = [(None, "Preface.\n\nOnly members of this house can read these pages.\n\nText."), (2**60 + 1, "x you may use it for any work y"), (3, "nothing of the kind")]
    found = scanned(spark.createDataFrame(rows, "doc_id long, text string"), own).collect()
    assert {(r["doc_id"], r["license"], r["exact"]) for r in found} == {(None, "House", True), (2**60 + 1, "Plain", True)}
    texts = {
        1: "Released under the terms of the MIT License.", 2: "Licensed under the MIT license.", 3: "He went to MIT without any license.",
        4: "Licensed under CC BY-XY 4.0.", 5: "MIT", 6: "Licensed under the Apache License, Version 1.1.",
    }
    found = scanned(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["license"], r["exact"]) for r in found} == {(1, "MIT", False), (2, "MIT", False)}


# Language model


def test_language_model_scores(docs, nothing):
    from basinspark.llm.attention_lm import ModelParameters, scored, words_of

    held_out = remainder("doc_id", 10) == 0
    params = ModelParameters(steps=60, common_share=0.002, classes=32)
    found = scored(docs, held_out, [F.col("doc_id")], params=params).collect()
    rows = docs.select("doc_id", "text").collect()
    counts = Counter()
    for r in rows:
        if zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 10:
            counts.update([*words_of(r["text"]), None])
    total = sum(counts.values())
    norm = math.log10(total + 0.1 * (len(counts) + 1))
    expected = Counter()
    for r in rows:
        w = [*words_of(r["text"]), None]
        expected[(r["doc_id"], len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10(counts[x] + 0.1) - norm for x in w), 5))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in found) == expected
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)
    empty = scored(nothing, held_out, [F.col("doc_id")], params=params)
    assert empty.count() == 0
    alone = scored(docs, F.lit(True), [F.col("doc_id")], params=params).collect()
    assert {r["train_tokens"] for r in alone} == {0} and max(abs(r["base_score"]) for r in alone) < 1e-9


def test_windows_score_each_token_once():
    from basinspark.llm.attention_lm import ModelParameters, placed

    params = ModelParameters(window=8, context=3)
    lengths = np.array([1, 7, 8, 9, 13, 14, 40])
    starts = np.cumsum(lengths) - lengths
    classes = np.arange(lengths.sum()).astype(np.int16)
    inputs, targets, counted, index = placed(classes, starts, lengths, params, -1)
    assert sorted(index[counted].tolist()) == list(range(lengths.sum()))
    assert (targets[counted] == classes[index[counted]]).all()
    first = np.isin(index, starts)
    assert (inputs[first & counted] == -1).all() and (inputs[~first & counted] == targets[~first & counted] - 1).all()


def test_attention_gradient_and_mask():
    from basinspark.llm.attention_lm import Attention, ModelParameters

    net = Attention(7, ModelParameters(window=5, width=4))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    inputs, targets, counted = rng.integers(0, 7, (3, 5)), rng.integers(0, 7, (3, 5)), rng.random((3, 5)) < 0.7
    value = lambda: float(net.logs(inputs, targets)[counted].sum() / counted.sum())
    for name, g in net.gradient(inputs, targets, counted).items():
        at = tuple(int(rng.integers(0, s)) for s in net.p[name].shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-4
        up = value()
        net.p[name][at] = old - 1e-4
        assert g[at] == pytest.approx((up - value()) / 2e-4, rel=2e-3, abs=1e-6)
        net.p[name][at] = old
    before = net.logs(inputs, targets)
    inputs[:, 4] = (inputs[:, 4] + 1) % 7
    assert net.logs(inputs, targets)[:, :4] == pytest.approx(before[:, :4])  # what comes later does not count


def test_softmax_of_any_range_and_least_class_costs():
    """Logits of any size keep their shares; groups by roots of counts cost no more than groups of equal counts."""
    from basinspark.llm.attention_lm import exponentials, group_classes, log_shares

    rng = np.random.default_rng(3)
    for scale, shift in ((1, 0), (1, 500), (1, -500), (300, 0)):
        z = (rng.standard_normal((6, 9)) * scale + shift).astype(np.float32)
        exact = z.astype(float) - z.max(axis=1, keepdims=True)
        exact -= np.log(np.exp(exact).sum(axis=1, keepdims=True))
        own = rng.integers(0, 9, 6)
        assert log_shares(z, own) == pytest.approx(exact[np.arange(6), own], rel=1e-4, abs=1e-5)
    mask = np.tril(np.ones((4, 4), dtype=bool))
    for shift in (0, 200, -200):
        _, e, sums = exponentials(np.full((2, 4, 4), shift, dtype=np.float32), mask)
        assert e / sums[..., None] == pytest.approx(np.broadcast_to(mask / mask.sum(axis=1, keepdims=True), (2, 4, 4)), rel=1e-5)

    counts = np.floor(1e6 / np.arange(1, 3001) ** 1.2)
    counts[2500:] = 0
    cost = lambda c: (counts * np.bincount(c)[c]).sum()
    ours = group_classes(counts, 32)
    mass = np.cumsum(counts[16:])
    equal = np.concatenate((np.arange(16), 16 + np.minimum(mass / mass[-1] * 16, 15).astype(int)))
    assert cost(ours) < cost(equal) and len(set(ours[2500:])) == 1 and not set(ours[:2500]) & set(ours[2500:])
    assert len(set(group_classes(np.zeros(5), 8))) == 1


def test_model_is_a_distribution(docs):
    """Class probabilities add up to 1, and so do those of subwords in their classes."""
    from basinspark.llm.attention_lm import Attention, ModelParameters, group_classes

    counts = np.random.default_rng(1).integers(0, 50, 500)
    class_of = group_classes(counts, 32)
    assert class_of.max() < 32 and len(np.unique(class_of)) == class_of.max() + 1
    net = Attention(9, ModelParameters(window=4))
    inputs = np.zeros((1, 4), dtype=int)
    total = sum(np.exp(net.logs(inputs, np.full((1, 4), k))) for k in range(9))
    assert total == pytest.approx(np.ones((1, 4)), rel=1e-4)


# Mixing


def test_mixture_of_single_sources(docs, nothing):
    from basinspark.llm.mixing import mixed

    size = F.size(words(F.col("text")))
    rows = mixed(docs, "doc_id", size, F.array("source")).collect()
    assert len(rows) == docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    sums = Counter()
    for r in rows:
        sums[r["sources"][0]] += r["taken"]
    for r in rows:
        assert sums[r["sources"][0]] == math.floor(r["target"] + 1e-6) and r["target"] <= 2 * r["source_size"] + 1e-6
    assert sorted(map(str, mixed(docs.repartition(7), "doc_id", size, F.array("source")).collect())) == sorted(map(str, rows))
    assert mixed(nothing, "doc_id", size, F.array("source")).count() == 0


def test_mixture_of_overlapping_sources(spark):
    from basinspark.llm.mixing import mixed

    rows = [(i, 10, ["a"] if i < 10 else ["b"] if i < 20 else ["a", "b"]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, n int, s array<string>")
    found = mixed(df, "doc_id", F.col("n"), F.col("s"), weights=(1.0,), total_share=1.0).collect()
    assert sum(r["taken"] for r in found) == 400 and all(r["taken"] <= 10 for r in found)  # no repetition while single copies suffice
    # two groups that share no source are solved apart, beside a source of its own
    more = spark.createDataFrame([(100 + i, 5, ["x"] if i < 4 else ["x", "y"]) for i in range(9)] + [(200, 7, ["z"]), (201, 9, None)], df.schema)
    both = mixed(df.unionByName(more), "doc_id", F.col("n"), F.col("s"), weights=(1.0,), total_share=1.0).collect()
    sums = Counter()
    for r in both:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sums[tuple(r["sources"])] += r["taken"]
    targets = {r["sources"][0]: r["target"] for r in both if len(r["sources"]) == 1}
    assert sums[("z",)] == math.floor(targets["z"] + 1e-6) and sums[(None,)] == math.floor(targets[None] + 1e-6)
    assert sums[("a",)] + sums[("b",)] + sums[("a", "b")] == math.floor(targets["a"] + 1e-6) + math.floor(targets["b"] + 1e-6)


def test_mixture_of_thousands_of_sources(spark):
    from basinspark.llm.mixing import mixed

    rng = random.Random(4)
    sizes = [rng.randint(0, 50) for _ in range(5000)]
    df = spark.createDataFrame([(i, n, [f"host{i}"]) for i, n in enumerate(sizes)], "doc_id long, n int, s array<string>")
    found = {r["doc_id"]: (r["target"], r["taken"]) for r in mixed(df, "doc_id", F.col("n"), F.col("s")).collect()}
    order = sorted(range(5000), key=lambda i: f"host{i}")
    weight = {i: (3, 1, 2)[k % 3] for k, i in enumerate(order)}
    low, high = 0.0, 1000.0
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(2 * sizes[i], level * weight[i]) for i in range(5000)) < 1.5 * sum(sizes):
            low = level
        else:
            high = level
    for i, (target, taken) in found.items():
        assert target == pytest.approx(min(2 * sizes[i], level * weight[i]), abs=1e-6) and taken == math.floor(target + 1e-6)


def test_flow_against_all_divisions():
    from basinspark.llm.mixing import cheapest_flow

    offers, quotas, costs = {0: (3, [0]), 1: (2, [0, 1]), 2: (1, [1])}, [5, 4], [0, 1]
    flow = cheapest_flow(offers, quotas, costs)
    used = [sum(v for (p, _), v in flow.items() if p == k) for k in offers]
    cost = sum(max(0, u - offers[k][0]) for k, u in enumerate(used))
    best = min(
        max(0, a - 3) + max(0, b + c - 2) + max(0, d - 1) for a in range(7) for b in range(5) for c in range(5) for d in range(3) if b + c <= 4 and a + b == 5 and c + d == 4
    )
    assert sum(flow.values()) == 9 and cost == best


def test_full_sources_give_their_excess_on(spark):
    from basinspark.llm.mixing import leveled

    sources = spark.createDataFrame([("a", 10), ("b", 100)], "source string, source_size long")
    assert {r["source"]: r["target"] for r in leveled(sources, (3, 1), 60, 2).collect()} == {"a": 20, "b": 40}
    assert {r["source"]: r["target"] for r in leveled(sources, (3, 1), 10_000, 2).collect()} == {"a": 20, "b": 200}
    assert leveled(sources.limit(0), (3, 1), 0, 2).count() == 0


# Whole jobs


def test_language_model_trains_on_all_subwords_of_all_texts(docs):
    """Every id of every training text is a target once, and ids of one class are told apart by what comes before."""
    from basinspark.llm import attention_lm as lm

    params = lm.ModelParameters(window=8, context=3, width=8, batch=16, classes=4)
    class_of = np.array([0, 1, 2, 2, 2, 3])
    net = lm.Attention(6, params, class_of)
    net.p = {k: v.astype(np.float64) + (0.1 if k in "rc" else 0) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    inputs = rng.integers(0, 6, (4, 8))
    total = sum(np.exp(net.logs(inputs, np.full((4, 8), k))) for k in range(6))
    assert total == pytest.approx(np.ones((4, 8)), rel=1e-6)
    targets, counted = rng.integers(0, 6, (4, 8)), rng.random((4, 8)) < 0.7
    gradient = net.gradient(inputs, targets, counted)
    for name in "rceu":
        at = tuple(int(rng.integers(2, s)) for s in net.p[name].shape)
        values = []
        for shift in (1e-4, -2e-4):
            net.p[name][at] += shift
            values.append(net.logs(inputs, targets, counted).sum() / counted.sum())
        net.p[name][at] += 1e-4
        assert gradient[name][at] == pytest.approx((values[0] - values[1]) / 2e-4, rel=1e-3, abs=1e-7)

    small = lm.Attention(6, params, class_of)
    model = type("Held", (), {"value": lm.Model(params, small, 5, np.zeros(0, np.int64), np.zeros(0))})
    facts = lm.WordFacts(model.value, type("Letters", (), {"encode_ordinary": staticmethod(lambda w: [ord(x) - 97 for x in w[1:]])}))
    _, ids, starts, lengths = lm.sequences([[b"abc", b"d"], [], [b"abc"]], facts)
    assert ids.tolist() == [0, 1, 2, 3, 5, 5, 0, 1, 2, 5] and lengths.tolist() == [5, 1, 4] and starts.tolist() == [0, 5, 6]

    seen = []
    fit_round = lm._trained

    def watched(*args):
        seen.append(args[0].value.attention.p["b"].copy())
        return fit_round(*args)

    lm._trained = watched
    try:
        rows = lm.scored(docs, F.lit(False), [F.col("doc_id")], params=lm.ModelParameters(rounds=2, classes=32)).collect()
    finally:
        lm._trained = fit_round
    assert len(seen) == 2 and not np.allclose(seen[0], seen[1]) and len(rows) == docs.count()


def test_licenses_in_wrapped_notices_and_many_templates(spark):
    """Notices wrapped over lines, with and without comment marks, and a short one among many templates that share words."""
    import textwrap

    from basinspark.llm.licenses import TEMPLATES, scanned

    wrapped = {n: "\n".join(textwrap.wrap(TEMPLATES[n], 60)) for n in TEMPLATES if len(TEMPLATES[n]) > 80}
    texts = {f"{n}|{m}": "Intro words.\n" + "\n".join(m + line for line in t.split("\n")) + "\nint main() {" for n, t in wrapped.items() for m in ("", " * ", "# ")}
    texts["twice|"] = "Released under the MIT License.\n" + "code and more\n" * 3 + "Released under the MIT License."
    found = scanned(spark.createDataFrame(list(texts.items()), "doc_id string, text string")).collect()
    got = Counter((r["doc_id"], r["license"]) for r in found)
    assert got == Counter({(d, d.split("|")[0]): 1 for d in texts if d != "twice|"} | {("twice|", "MIT"): 2})
    assert all(r["block"] == texts[r["doc_id"]][r["offset"] : r["offset"] + len(r["block"])] for r in found)
    many = TEMPLATES | {f"Other-{i}": TEMPLATES["GPL-3.0-header"].replace("GNU", f"Other{i}") for i in range(12)}
    text = " ".join([TEMPLATES["GPL-3.0-header"], "Words between.", TEMPLATES["MIT"]])
    rows = scanned(spark.createDataFrame([(1, text)], "doc_id long, text string"), many).collect()
    assert {r["license"] for r in rows} == {"GPL-3.0-header", "MIT"}


def test_unlabelled_hosts_are_judged_by_domain_then_suffix(spark):
    from basinspark.llm.url_reputation import judged_urls

    urls = {1: "http://new.bad.com/", 2: "http://new.clean.com/", 3: "http://other.evil/", 4: "http://far.away/", 5: None, 6: "http://a.bad.com/"}
    outcomes = [("http://a.bad.com/", 1)] * 300 + [("http://b.bad.com/", 1)] * 300 + [("http://a.clean.com/", 0)] * 900 + [("http://x.evil/", 1)] * 300
    pages = spark.createDataFrame(list(urls.items()), "page_id long, url string")
    rows = {r["page_id"]: r for r in judged_urls(pages, spark.createDataFrame(outcomes, "url string, bad int"), []).collect()}
    assert {k: r["verdict"] for k, r in rows.items()} == {1: "block", 2: "allow", 3: "block", 4: "allow", 5: "allow", 6: "block"}
    assert rows[1]["bad_rate"] > 0.9 and rows[2]["bad_rate"] < 0.1 and rows[4]["bad_rate"] == rows[5]["bad_rate"] == 0.5
    assert [rows[k]["labelled_pages"] for k in (1, 2, 3, 6)] == [0, 0, 0, 300]


def test_every_excerpt_of_the_stated_length_is_a_leak():
    from basinspark.llm.decontamination import LeakIndex, LeakParameters, leaks_of

    rng = random.Random(8)
    item = "".join(rng.choice("abcdefgh") for _ in range(394))
    noise = "".join(rng.choice("klmnopqrst ") for _ in range(300))
    params = LeakParameters()
    length = params.passage + params.passage_step - 1
    texts = [noise + item[k : k + length] + noise for k in range(len(item) - length + 1)]
    assert length < 80 and all([leak["item_id"] for leak in own] == [1] for own in leaks_of(texts, LeakIndex([(1, item)], params)))
    assert leaks_of([noise], LeakIndex([(1, item)], params)) == [[]]
