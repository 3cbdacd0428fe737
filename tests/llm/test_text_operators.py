"""Licences, HTML, tokens and toxicity: exact round trips, held-out accuracy, edge cases."""

import hashlib

import numpy as np
import public_tokenizers
import pytest

from strata.llm import byte_bpe, html_text, license_scan, toxicity

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_license_digests(spark):
    mit = dict((k, t) for k, t in license_scan.KNOWN if "Permission is hereby" in t)["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,")), (2, mit.replace("\n", " ").replace("sublicense", "sub-licence")),
        (3, "Some prose.\nReleased under the MIT License.\nLICENSED under the Apache Licence; version 2.0\nReleased under the MIT License."),
        (4, mit + " And more."), (5, None), (6, ""), (7, "!!!"), (8, "Licensed under CC BY-NC 4.0."), (8, "Licensed under CC BY-NC 4.0."),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id BIGINT, text STRING, license STRING")
    got = license_scan.scan_documents(docs, license_scan.known_digests(spark)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.whole_license, r.line_licenses, r.n_lines_matched) for r in got} == {
        1: ("MIT", "", 0), 2: ("MIT", "MIT", 1), 3: (None, "Apache-2.0,MIT", 3), 4: (None, "", 0), 5: (None, "", 0),
        6: (None, "", 0), 7: (None, "", 0), 8: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", 1)}
    assert license_scan.scan_documents(docs.limit(0), license_scan.known_digests(spark)).count() == 0


def test_license_notices_wrapped_over_lines(spark):
    header = """package x;

/*
 * Copyright 2020 Someone
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
int main() {}"""
    gnu = ("# SPDX-License-Identifier: GPL-3.0-or-later\n#\n# This program is free software: you can redistribute it and/or modify\n"
           "# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the "
           "License, or\n# (at your option) any later version.\n\nprose")
    bsd = next(t for k, t in license_scan.KNOWN if k == "BSD-3-Clause" and "Redistribution" in t)
    rows = [(1, header), (2, gnu), (3, "Copyright (c) 2001 The Authors\nAll of it.\n\n" + bsd), (4, "(c) Me\n" + bsd), (5, "own words\nof ours\n\nmore")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    known = spark.createDataFrame([*license_scan.KNOWN, ("Own-1", "Own words of OURS."), ("None", "..."), ("None", None)], "license string, text string")
    cols = ["doc_id", "whole_license", "line_licenses", "n_lines_matched", "paragraph_licenses", "n_paragraphs_matched"]
    got = {r[0]: tuple(r)[1:] for r in license_scan.scan_documents(docs, license_scan.known_digests(spark, known)).select(cols).collect()}
    assert got == {1: (None, "", 0, "Apache-2.0", 2), 2: (None, "GPL-3.0-or-later", 1, "GPL-3.0-or-later", 1), 3: (None, "", 0, "", 0),
                   4: ("BSD-3-Clause", "", 0, "", 0), 5: (None, "", 0, "Own-1", 1)}


TEXTS = [None, "", "a", "Hello  world's\n\n\ttabs 123 4567", "été ñandú größe 中文字符 \U0001f600\U0001f468‍\U0001f469", "\x00\x01\r\n ",
         "   trailing   ", "it's we'll I'D", "x" * 3000, "<|endoftext|>", "word " * 60000, "中" * 5000 + " and then some"]


def test_byte_bpe_equals_rank_encoding(spark):
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)] + [(1, "", "en", "s", 0)], DOCS)
    got = byte_bpe.round_trip(docs, PATH, PATTERN).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        ids = enc.encode_ordinary(TEXTS[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()
    assert byte_bpe.round_trip(docs.limit(0), PATH, PATTERN).count() == 0


def test_byte_bpe_offsets_and_decoding(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)], DOCS)
    coded = byte_bpe.encode(docs, "doc_id", "text", PATH, PATTERN)
    for r in coded.collect():
        text = TEXTS[r.doc_id] or ""
        assert len(r.ids) == len(r.starts) == len(r.ends)
        assert all(0 <= a <= z <= len(text) for a, z in zip(r.starts, r.ends))
        assert not r.ids or (r.starts[0], r.ends[-1]) == (0, len(text))
    back = {r.doc_id: r.text for r in byte_bpe.decode(coded, "doc_id", "ids", PATH, PATTERN).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    ids = byte_bpe.load(PATH, PATTERN)[0].encode("\U0001f600", add_special_tokens=False).ids
    assert len(ids) > 1 and byte_bpe.decode_ids(ids[:1], PATH, PATTERN).decode("utf-8", "replace") == "�"


def test_long_texts_are_cut_where_no_match_reaches():
    text = "some words, 12 numbers and  gaps " * 3000
    parts = byte_bpe.pieces(text, 1000)
    assert "".join(p for _, p in parts) == text and len(parts) > 50
    assert all(p.startswith(" ") and p[1].isalpha() for _, p in parts[1:])


@pytest.fixture(scope="module")
def labeller():
    return html_text.train(None)


def test_labeller_on_unseen_templates(labeller):
    rng, vec, wrong, total = np.random.default_rng(12345), html_text.Vectors(), 0, 0
    for _ in range(100):
        page, labels = html_text.template_page(rng)
        blocks = html_text.leaf_blocks(page)
        got = html_text.label_pages([blocks], labeller, vec)[0]
        wrong, total = wrong + int((got != np.array(labels, bool)).sum()), total + len(labels)
    assert wrong / total < 0.02


def test_lstm_gradient_matches_differences():
    rng = np.random.default_rng(0)
    m = html_text.Labeller()
    x, mask = html_text.padded([rng.normal(size=(5, html_text.DIM)), rng.normal(size=(3, html_text.DIM))])
    x = x.astype(float)
    y = (rng.random(mask.shape) < 0.5) * mask

    def loss():
        s = m.scores(x, mask)[0]
        return float(((np.logaddexp(0, s) - y * s) * mask).sum() / mask.sum())

    g = m.gradient(x, mask, y)
    for k in ("Wf", "Ub", "cf", "v", "a"):
        at = tuple(rng.integers(n) for n in m.p[k].shape)
        keep = m.p[k][at]
        m.p[k][at] = keep + 1e-5
        up = loss()
        m.p[k][at] = keep - 1e-5
        down = loss()
        m.p[k][at] = keep
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-6


def test_extraction_edges(spark, labeller):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul></nav>"
            "<article><h1>A  &amp; B</h1><p>First &lt;p&gt;\n  paragraph, with <b>bold</b> words and a good deal more text.<p>Second one&#8217;s "
            "here, which also has a few words.</article><div class=comments><h3>Comments</h3><p>Nice post!</p></div>"
            "<footer>&copy; 2020 Somebody</footer><script>var x = '<p>no</p>';</script></body></html>")
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<!-- <p>x</p>"), (1, "u", page), (6, "u", "<div>" * 3000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id BIGINT, url STRING, html STRING, text INT")
    got = html_text.extract(pages, labeller).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == ("A & B\nFirst <p> paragraph, with bold words and a good deal more text.\n"
                          "Second one’s here, which also has a few words.")
    assert all(r.n_chars == len(r.text) for r in got) and all(by[i].text == "" for i in (2, 3, 5, 6))
    assert html_text.extract(pages.limit(0), labeller).count() == 0


def test_head_without_end_tag():
    body = "<p>First paragraph.<p>Second one."
    want = ["First paragraph.", "Second one."]
    for head in ("<head><meta charset=utf-8><title>T</title>", "<head><link rel=x href=y><style>p{}</style><script>1</script>\n"):
        for start in ("<body>", "", "</head><body>", "<body class=a><div>"):
            assert [b.text for b in html_text.leaf_blocks("<html>" + head + start + body)] == want
    assert [b.text for b in html_text.leaf_blocks("<head><title>T</title>Bare text<p>more")] == ["Bare text", "more"]


def test_word_kernel():
    assert toxicity.kernel("idiot", "idiot") == pytest.approx(1)
    assert 1 > toxicity.kernel("idiiot", "idiot") > toxicity.kernel("idxixot", "idiot") > toxicity.kernel("region", "idiot")
    words = ["idiot", "idxiot", "region", "distinct", "idioidiot", "stupid"]
    scorer = toxicity.WordScorer(["idiot", "stupid", "stupor"], 2)
    found = scorer.features([*words, "it", "", "x" * 30 + "idiot" + "y" * 30])
    for w in words:
        want = np.array([toxicity.kernel(w, m) for m in ("idiot", "stupid", "stupor")])
        assert (w in found) == (want[:2].max() >= toxicity.FAR)
        assert w not in found or np.allclose(found[w], want**toxicity.SHARP, atol=1e-5)
    assert "idiot" in toxicity.words_of("you i d i o t there")


def test_toxicity_learns_and_holds_out(spark):
    rng = np.random.default_rng(3)
    plain, bad = [f"{a}{b}{c}" for a in "rtmn" for b in ("ea", "o", "ui") for c in ("l", "nd", "st", "ver")], ["grobnik", "zwalpet", "fluzzag"]
    rows, labels = [], []
    for i in range(600):
        words, toxic = list(rng.choice(plain, 40)), int(i % 5 == 0)
        if toxic:
            for w in rng.choice(bad, 3):
                words[rng.integers(40)] = w if i % 2 else w[:3] + "." + w[3:]
        rows.append((i, ". ".join(" ".join(words[k:k + 8]) for k in range(0, 40, 8)), "en", "s", 0))
        labels.append((i, 1, toxic))
    rows += [(1000, None, "en", "s", 0), (1001, "", "en", "s", 0), (None, "reast", "en", "s", 0), (1002, "grobxnik " * 40, "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT"))
    assert set(bad) <= set(model.landmarks)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows)
    held = [i for i, _, _ in labels if got[i].held_out]
    assert 100 < len(held) < 200 and sum(got[i].predicted == t for i, _, t in labels if got[i].held_out) >= 0.98 * len(held)
    assert got[1000].score == got[1001].score < 0.3 and not got[None].held_out and got[1002].predicted == 1
    assert all(0 <= r.score <= 1 for r in got.values())


def test_landmarks_of_a_skewed_vocabulary(spark):
    rng, rows = np.random.default_rng(4), []
    plain = [f"{a}{b}{c}" for a in "rtmn" for b in ("ea", "o", "ui") for c in ("l", "nd", "st", "ver")]
    for i in range(8000):
        words = list(rng.choice(plain, 6))
        if i % 4 == 0:  # 2,000 toxic documents: one insult in nearly all, one in 12 of them, one in 3
            words += ["grobnik"] if i % 640 else ["zwalpet"]
            words += ["fluzzag"] if i in (0, 4, 8) else []
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    labelled = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, toxic INT")
    marks, others = toxicity.pick_landmarks(labelled)
    assert marks == ["grobnik", "zwalpet"] and not set(others) & set(marks)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", "en", "s", 0)], DOCS)
    none = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert toxicity.score(docs, toxicity.train(docs, none)).first().score == 0.0
    one = spark.createDataFrame([(1, 1, 0)], "doc_id BIGINT, quality INT, toxic INT")
    assert toxicity.score(docs.limit(0), toxicity.train(docs, one)).count() == 0


@pytest.mark.parametrize("page,texts,linked,path", [
    ("<article class=x/><p>a</p></article>", ["a"], [0], ["article", "p"]),  # only void elements close themselves
    ("<a href=/x/>link</a> t", ["link t"], [4], []),
    ('<p title="abc>hello</p><p class="q">two</p>', ["hello", "two"], [0, 0], ["p"]),  # a quote that is never closed
    ("<p title='a>b'>x", ["x"], [0], ["p"]),
    ("<div title=\"a<b\">k</div>", ["k"], [0], ["div"]),
    ("<svg/><p>after", ["after"], [0], ["p"]),
    ("<p>x<svg><path d=''/><g></svg>y", ["x", "y"], [0, 0], ["p"]),
])
def test_leaf_blocks_of_sloppy_markup(page, texts, linked, path):
    blocks = html_text.leaf_blocks(page)
    assert [b.text for b in blocks] == texts and [b.linked for b in blocks] == linked
    assert [t for t, _ in blocks[-1].path] == path


def test_leaf_blocks_of_deep_markup_take_linear_time():
    import time

    took = []
    for n in (4_000, 32_000):
        began = time.perf_counter()
        assert len(html_text.leaf_blocks("<div>x" * n)) == n
        assert len(html_text.leaf_blocks("<b><p>x" * n + "</i></u>" * n)) == n
        took.append(time.perf_counter() - began)
    assert took[1] < 40 * took[0]
