"""Fill-in-the-middle, web archives and vector codes on odd rows, and against brute force."""

from __future__ import annotations

import gzip
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

CLASHING = ["n", "form", "output", "text_key", "line", "label_error", "code", "error", "payload", "probe", "revisit", "top", "_key", "_text"]


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING})


# Fill in the middle


def brute_middle(key, text):
    """Tokens, form, output by regular expression and slices."""
    text, digest = text or "", hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 20:
        return len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice("ab Zé漢<>PSM\n\t🙂.") for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "a <P> b"), (1003, "<M>"), (None, "no key here"), (None, None), (1004, "ab " * 200000), (1005, "<"), (1005, "<"), (-7, "<S<P><")]
    return rows


def test_middles_equal_slices_and_come_back(spark, texts):
    from basinspark.llm.fill_in_middle import fill_in_middle, restored

    docs = clashing(spark.createDataFrame(texts, "doc_id long, text string"))
    rows = fill_in_middle(docs, [F.col("doc_id"), F.col("text"), F.col("n").alias("extra")])
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows.collect())
    expected = sorted((k is None, k or 0, t or "", *brute_middle(k, t)) for k, t in texts)
    assert found == expected
    assert {r[4] for r in found} == {"plain", "psm", "spm"}
    back = restored(rows, [F.col("text").alias("given"), F.col("output_sha256"), F.col("output").alias("whole")])
    for r in back.collect():
        assert r["text"] == (r["given"] or "")
        assert r["restored_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
        assert r["output_sha256"] == hashlib.sha256(r["whole"].encode()).hexdigest()


def test_middles_of_no_rows(spark):
    from basinspark.llm.fill_in_middle import fill_in_middle, restored

    rows = fill_in_middle(spark.createDataFrame([], "doc_id string, text string"), [F.col("doc_id")])
    assert rows.count() == 0 and restored(rows, [F.col("doc_id")]).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab<>PSM é\n", max_size=30), st.text(max_size=5))
def test_piece_tables(text, key):
    from basinspark.llm.fill_in_middle import MiddleParameters, restored_text, token_starts, transformed

    data = text.encode()
    starts = [m.start() for m in re.finditer(rb"[A-Za-z]+|[^A-Za-z\x80-\xbf]", data)]
    assert token_starts(data).tolist() == starts
    n, form, table = transformed(key, data, MiddleParameters(transformed=100))
    assert n == len(starts) and table.sha256() == hashlib.sha256(table.content()).hexdigest()
    assert restored_text(table.content(), form).content() == data
    assert sum(p.size for p in table.pieces) == len(data) + (0 if form == "plain" else 9)


def test_outputs_without_their_marks_are_refused():
    from basinspark.llm.fill_in_middle import inverse, restored_text

    with pytest.raises(ValueError, match="<M>"):
        restored_text(b"<P>a<S>b", "psm")
    assert inverse((3, 0, 4, 2, 5, 1)) == [1, 5, 3, 0, 2, 4]


# Web archives


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(12)
    long = "<p>" + "word " * 300 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(i, f"http://h{rng.randint(0, 5)}.Example.com/{rng.choice('abc')}?q={rng.randint(0, 3)}", f"<p>{rng.random()}</p>" * rng.randint(0, 60)) for i in range(300)]
    rows += [(500 + i, f"http://copy{i % 3}.net/p{i % 7}", long) for i in range(200)]
    rows += [(800, None, None), (801, "", ""), (802, "no scheme\r\nX: y", "short é漢"), (None, "http://a.b/", long), (None, None, "only null ids " * 200), (None, "u", "only null ids " * 200)]
    rows += [(803, "http://a.b/", "twice " * 300), (803, "http://a.b/", "twice " * 300), (804, "http://a.b/", "x" * 999), (805, "http://a.b/", "x" * 999), (806, "http://a.b/", "é" * 500), (807, "http://a.b/", "é" * 500)]
    rows += [(900, "http://big.org/", "<b>big</b>" * 300000)]
    return rows


def brute_records(rows):
    top = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if page is not None and len(payload) >= 1000:
            top[payload] = max(page, top.get(payload, page))
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        other = payload in top and top[payload] != page
        out.append((str(page), len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if other else "response", str(top[payload]) if other else None))
    return sorted(out, key=str)


def test_archives_come_back(spark, pages):
    from basinspark.llm.web_archive import ArchiveParameters, read_back, written

    table = clashing(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5))
    for params in (ArchiveParameters(), ArchiveParameters(archive_bytes=20000, segment_bytes=3000, block_lines=7)):
        archive = written(table, params)
        rows = read_back(archive, params).collect()
        found = sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)
        assert found == brute_records(pages)
    paths = {r["archive"].removeprefix("file:") for r in archive.captures.select("archive").distinct().collect()}
    assert len(paths) > 5
    # any reader of gzip finds the records
    whole = b"".join(gzip.open(p).read() for p in paths)
    assert whole.count(b"WARC-Type: warcinfo") == len(paths) and whole.count(b"WARC-Type: revisit") == sum(r[3] == "revisit" for r in brute_records(pages))


def test_index_finds_all_captures_of_an_url(spark, pages):
    from basinspark.llm.web_archive import ArchiveParameters, capture_key, captures_of, written

    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    archive = written(table, ArchiveParameters(block_lines=3))
    assert archive.parts.agg(F.sum("captures")).first()[0] == len(pages)
    urls = [u for _, u, _ in pages[:40]] + ["http://copy1.net/p3", "http://nowhere.net/", "http://h1.example.com/", None, "no scheme\r\nX: y"]
    found = captures_of(archive, spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    keys = {capture_key(u) for u in urls}
    expected = sorted((str(page)) for page, url, _ in pages if capture_key(url) in keys)
    assert sorted(str(r["page_id"]) for r in found) == expected
    bodies = {page: (html or "").encode() for page, _, html in pages}
    assert all(bytes(r["payload"]) == bodies[int(r["page_id"])] for r in found if r["record_type"] == "response" and r["page_id"])
    assert capture_key("HTTP://www.Example.COM/A?b#c") == "com,example,www)/A?b#c" and capture_key(None) == ""


def test_archives_of_texts_and_of_no_pages(spark):
    from basinspark.llm.web_archive import read_back, written

    odd = spark.createDataFrame([("a b\n>", "u", "x" * 2000), ("é%", "u", "x" * 2000)], "page_id string, url string, html string")
    rows = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in read_back(written(odd)).collect()}
    assert rows == {"a b\n>": ("revisit", "é%", 2000), "é%": ("response", None, 2000)}
    assert read_back(written(odd.limit(0))).count() == 0


# Vector codes


def brute_codes(rows, parts=16, entries=64, rounds=2):
    sound = sorted((r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [(k, [int(np.floor(256 * float(x))) for x in v], lab) for k, v, lab in sound]
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    kept = [(k, v + [0] * (parts * width - len(v)), lab) for k, v, lab in kept]
    books = [[v[p * width : (p + 1) * width] for _, v, _ in kept[:entries]] for p in range(parts)]

    def assign():
        out = []
        for _, v, _ in kept:
            row = []
            for p in range(parts):
                part = v[p * width : (p + 1) * width]
                errors = [sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)) for entry in books[p]]
                row.append((errors.index(min(errors)), min(errors)))
            out.append(row)
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                members = [v[p * width : (p + 1) * width] for (_, v, _), row in zip(kept, codes, strict=True) if row[p][0] == e]
                if members:
                    books[p][e] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    codes = assign()
    errors = [sum(e for _, e in row) for row in codes]
    by_label = {}
    for (_, _, lab), e in zip(kept, errors, strict=True):
        by_label[lab] = by_label.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((k, "".join(f"{c:02x}" for c, _ in row), e, lab, by_label[lab], digest) for (k, _, lab), row, e in zip(kept, codes, errors, strict=True)), key=str)


def vectors(seed, n, width, low=-1.0, high=1.0):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in rng.uniform(low, high, width)], int(rng.integers(0, 3)) if i % 5 else None) for i in rng.permutation(n)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize(("width", "n", "scale"), [(32, 150, 1.0), (20, 90, 0.02), (16, 30, 1000.0)])
def test_codes_against_brute_force(spark, width, n, scale):
    from basinspark.llm.vector_codes import coded

    rows = vectors(3, n, width, -scale, scale)
    inf, nan = float("inf"), float("nan")
    rows += [(500, None, 1), (501, [None] + [0.5] * (width - 1), 1), (502, [inf] * width, 1), (503, [nan] * width, None), (504, [], 2), (505, [1.0] * (width + 16), 2)]
    rows += [(None, rows[0][1], 7), (3, rows[1][1], 1), (600, rows[2][1], None), (600, rows[2][1], None)]
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(4))
    found = [tuple(r[c] for c in ("vec_id", "code", "error", "label", "label_error", "codebooks_sha256")) for r in coded(df).collect()]
    assert sorted(found, key=str) == brute_codes(rows)


def test_codes_of_no_vectors_and_beyond_the_range(spark):
    from basinspark.llm.vector_codes import coded

    empty = spark.createDataFrame([(1, None, 1)], SCHEMA)
    assert coded(empty).count() == coded(empty.limit(0)).count() == 0
    with pytest.raises(Exception, match="range of a long"):
        coded(spark.createDataFrame([(1, [1e30] * 16, 1)], SCHEMA))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.integers(0, 30), st.integers(0, 2**31))
def test_products_are_exact(width, bits, seed):
    from basinspark.llm.vector_codes import exact_products, limbs

    rng = np.random.default_rng(seed)
    bits = min(bits, (62 - width.bit_length()) // 2)
    a, b = (rng.integers(-(1 << bits), (1 << bits) + 1, (5, width)) for _ in range(2))
    expected = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
    assert exact_products(a, b).tolist() == expected
    assert (sum(part.astype(np.int64) << (7 * i) for i, part in enumerate(limbs(a, 7))) == a).all()


def test_first_of_equal_entries_wins():
    from basinspark.llm.vector_codes import nearest

    codes, errors = nearest(np.array([[1], [5]]), np.array([[0], [2], [0], [4], [6]]))
    assert codes.tolist() == [0, 3] and errors.tolist() == [1, 1]
