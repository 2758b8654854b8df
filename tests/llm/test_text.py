"""Language ID, HTML extraction and licence scans."""

import zlib

import duckdb
import numpy as np
import pytest

from claimflow.llm import html_extract, language_id, license_scan
from claimflow.llm import queries as corpus

FOLDER = "/root/testdata/sf0.01"


# --- language ID


def texts():
    out = []
    for i in range(120):
        out.append((i, f"the cat sat on the mat with number {i} and the dog", "en", "s"))
        out.append((1000 + i, f"der Hund und die Katze sind nicht {i} über dem Haus", "de", "s"))
    return out


def test_language_of_every_case(spark):
    data = [*texts(), (5000, None, "en", None), (5001, "", "en", None), (5002, "12 34 !!", None, None), (5003, "the dog and the cat " * 40_000, None, "s"), (5003, "die Katze", None, "s"), (None, "der Hund", None, None)]
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in data], "doc_id long, text string, lang string, source string, lang_pred string, score double")
    model = language_id.fit(docs.where("doc_id < 3000"))
    got = language_id.identify(docs, model).collect()
    assert len(got) == len(data)
    by = {(r["doc_id"], r["lang_pred"]) for r in got}
    assert {(5000, "und"), (5001, "und"), (5002, "und"), (5003, "en"), (5003, "de"), (None, "de")} <= by
    assert all(0 <= r["score"] <= 1 and (r["score"] == 0) == (r["lang_pred"] == "und") for r in got)
    truth = {r[0]: r[2] for r in data if r[0] is not None and r[0] < 3000}
    assert all(truth[r["doc_id"]] == r["lang_pred"] for r in got if r["doc_id"] in truth)
    assert language_id.identify(docs.limit(0), model).collect() == []


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language_id.fit(docs) is None
    assert [tuple(r) for r in language_id.identify(docs, None).collect()] == [(1, "und", 0.0)]


def test_presence_is_a_set_of_grams():
    a, b = language_id.presence("abcabc"), language_id.presence("abc")
    # ' abcabc ' has every gram of ' abc '
    assert (a & b).sum() == b.sum() and a.sum() > b.sum()
    assert (language_id.presence("ÀB, c") == language_id.presence("àb;  C")).all()
    assert not language_id.presence("123 .").any()
    long = "xyzw " * 300_000
    assert (language_id.presence(long) == language_id.presence("xyzw " * 3)).all()


def test_nystrom_with_all_landmarks_is_kernel_ridge_regression():
    rng = np.random.default_rng(0)
    found = rng.random((30, 64)) < 0.3
    labels = ["a" if r[:32].sum() > r[32:].sum() else "b" for r in found]
    model = language_id.train(found, labels, landmarks=30, ridge=1e-3)
    x = found / np.sqrt(found.sum(1))[:, None]
    kernel = x @ x.T
    share = np.array([1 / labels.count(y) for y in labels])
    target = np.array([[1.0 if y == c else -1.0 for c in "ab"] for y in labels])
    exact = kernel @ np.linalg.solve(share[:, None] * kernel + 1e-3 * np.eye(30), share[:, None] * target)
    assert np.allclose(model.scores(found), exact, atol=1e-2)


def test_language_query_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = corpus.queries()["op1_language_id"](spark, FOLDER).collect()
    assert {r["doc_id"] for r in got} == set(docs) and len(got) == len(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in got if r["held_out"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert len(held) > 200 and right / len(held) > 0.98


# --- HTML


PAGES = [
    ("", ""),
    ("plain text only", "plain text only"),
    ("<p>a<p>b", "a\n\nb"),
    ("<div>x < y &amp; z &lt;b&gt; &eacute;&#233;&nbsp;e</div>", "x < y & z <b> éé e"),
    ('<html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body><article><h1>Head</h1><p>One,\n two<br>three.</p><!-- <p>no</p> --><p>Four.</article></body></html>', "Head\n\nOne, two three.\n\nFour."),
    ('<body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div id="main"><h2>Title</h2><p>Some text, with commas, here.</p><ul><li>one<li>two</ul></div><div class="sidebar"><p>Long, long, long, long, long, long text.</p></div><footer>f</footer></body>', "Title\n\nSome text, with commas, here.\n\none\n\ntwo"),
    ('<article><header><h1>A</h1></header><section><p>Para, one, two, three, four, five.</p></section><section><p>b</p></section><aside>no</aside><form><p>mail</p><input></form><section id="comments"><article class="comment"><p>cc, cc, cc, cc</p></article></section></article><div class="cookie-notice">We use cookies, a, b, c, d, e, f</div>', "A\n\nPara, one, two, three, four, five.\n\nb"),
    ('<div class="post has-sidebar"><p>Body text, of the post.</p><div class="share-links"><a href=x>x</a></div></div><div class="comments"><p>Nice, very, nice, so, nice, yes</p></div>', "Body text, of the post."),
    ('<div role="navigation">menu</div><main><p>kept</p><div hidden>gone</div><div style="display: none">gone</div></main>', "kept"),
    ('<div><p>Text of it, some more.</p><div><a href=a>one</a> <a href=b>two</a></div></div>', "Text of it, some more."),
    ("<article><p>cut off in a ta", "cut off in a ta"),
    ("<article><p>kept</p><p class='x", "kept"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    ("<article><p>see <a href='/x'>this <b>link</a> here</b></p></article>", "see this link here"),
    ("<article><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> in this formula</p></article>", "Energy is E=m in this formula"),
    ("<article><p>before</p><svg><text>gone</text></svg><p>after</p></article>", "before\n\nafter"),
    ("<article><p>before</p><svg><path d='x'><p>after an open one</p><noscript><p>and another</p></article>", "before\n\nafter an open one\n\nand another"),
    ("<article><p>Text, of it.</p><ul><li><a href=a>First reference</a><li><a href=b>Second reference</a></ul><nav><a href=c>menu</a></nav></article>", "Text, of it.\n\nFirst reference\n\nSecond reference"),
    ('<article><p class="social-history">Social history, of it.</p><div class="related-work"><p>Related work, and more.</p></div></article>', "Social history, of it.\n\nRelated work, and more."),
    ('<article><p>Kept, all of it.</p><div class="related-posts"><p>gone</p></div><div class="ad-slot-2">gone</div><div class="share-buttons">gone</div><div class="newsletter">gone</div><div id="comments-section"><p>gone, too</p></div></article>', "Kept, all of it."),
    ('<article><h1>Only a title</h1></article><div class="ad">Buy this, and that, and those, now.</div>', "Only a title"),
]


@pytest.mark.parametrize("k", range(len(PAGES)))
def test_main_text(k):
    html, want = PAGES[k]
    assert html_extract.main_text(html) == want


def test_long_and_deep_pages():
    long = "<article>" + "<p>word, word.</p>" * 20_000 + "</article>"
    assert html_extract.main_text(long).count("\n\n") == 19_999
    assert html_extract.main_text("<div>" * 5000 + "deep") == "deep"
    assert html_extract.main_text('<p title="' + "a" * 100_000) == ""
    assert html_extract.main_text("<" * 50_000).startswith("<<")


def test_articles_of_made_pages():
    """Pages with a known article between and around parts that are not its own."""
    rng = np.random.default_rng(3)
    word = lambda: f"w{rng.integers(0, 999)}"
    others = [
        '<nav><ul><li><a href="/a">Menu entry</a></ul></nav>', '<aside><p>side, side, side</p></aside>', '<div class="ad">buy, buy, now</div>',
        "<script>var a = '</p>';</script>", "<style>p {}</style>", "<form><p>mail</p><input></form>", '<div class="cookie-notice"><p>we use cookies</p></div>',
        '<section id="comments"><article class="comment"><p>nice, nice, nice</p></article></section>', "<svg><text>drawn</text></svg>",
    ]
    inside = [
        ("<p>{}</p>", 1), ("<h2>{}</h2>", 1), ("<blockquote>{}</blockquote>", 1), ("<ul><li>{}</li><li>{}</li></ul>", 2), ("<table><tr><td>{}</td><td>{}</td></tr></table>", 2),
        ('<ol><li><a href="#">{}</a><li><a href="#">{}</a></ol>', 2), ("<p><math><mi>{}</mi></math></p>", 1), ('<div class="side-effects"><p>{}</p></div>', 1), ("<pre>{}</pre>", 1),
    ]
    for _ in range(300):
        blocks, parts = ["Title"], ["<h1>Title</h1>"]
        for _ in range(rng.integers(1, 12)):
            if rng.random() < 0.3:
                parts.append(others[rng.integers(len(others))])
            shape, n = inside[rng.integers(len(inside))]
            held = [" ".join(word() for _ in range(rng.integers(1, 30))) for _ in range(n)]
            blocks += held
            parts.append(shape.format(*held))
        around = [others[k] for k in rng.integers(0, len(others) - 2, 4)]
        page = f"<html><head><title>t</title></head><body><header>Site</header>{around[0]}{around[1]}<article>{''.join(parts)}</article>{around[2]}{around[3]}<footer>f</footer></body></html>"
        assert html_extract.main_text(page) == "\n\n".join(blocks)


def test_extract_every_case(spark):
    data = [(1, "u", "<p>é</p>"), (2, None, None), (3, "v", ""), (1, "u", "<p>é</p>"), (None, "w", "<p>x</p>")]
    pages = spark.createDataFrame([(*r, "t", 7) for r in data], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in html_extract.extract(pages).collect()), key=str)
    want = [(1, "u", "é", 1), (1, "u", "é", 1), (2, None, "", 0), (3, "v", "", 0), (None, "w", "x", 1)]
    assert got == sorted(want, key=str)
    assert html_extract.extract(pages.limit(0)).collect() == []


def test_html_query_keeps_every_paragraph(spark):
    """Another reading of the articles of the test pages, by their own tags."""
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = corpus.queries()["op6_html_extraction"](spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


# --- licences


MIT = """MIT License

Copyright (c) 2019 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
LICENCES = [
    (1, None, ""),
    (2, "", ""),
    (3, "Nothing about a license here.", ""),
    (4, "Text before\nReleased under the MIT License.\nText after", "MIT"),
    (5, "Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    (6, "One. Two. This work is licensed under the GNU General Public License, version 3. More.", "GPL-3.0"),
    (7, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", "Apache-2.0,MIT"),
    (8, MIT, "MIT"),
    (9, BSD, "BSD-2-Clause"),
    (10, BSD + NAMES, "BSD-3-Clause"),
    (11, "# SPDX-License-Identifier: MIT", "MIT"),
    (12, "This file is licensed\r\nunder the Apache License, Version 2.0.\r\n\r\nx", "Apache-2.0"),
    (13, "x " * 100_000 + ".\nReleased under the MIT License.", "MIT"),
    (14, "Copyright 2020 Somebody.\nAll rights reserved.", "Proprietary"),
    (14, "Released under the MIT License.", "MIT"),
    (None, "Released under the MIT License.", "MIT"),
    (15, "Copyright (c) 2020, Somebody.\nAll rights reserved.\n\n" + BSD + NAMES, "BSD-3-Clause"),
    (16, " ".join(BSD.split()), "BSD-2-Clause"),
    (17, "\n".join(f"# {line}".rstrip() for line in ("Copyright (c) 2020, Somebody.\nAll rights reserved.\n\n" + BSD + NAMES).split("\n")), "BSD-3-Clause"),
    (18, "/*\n" + "\n".join(f" * {line}" for line in MIT.split("\n")) + "\n */", "MIT"),
    (19, BSD.replace("1. ", "(1) ").replace("2. ", "(2) ") , "BSD-2-Clause"),
    (20, "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed with this\n// file, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    (21, "// SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0-only"),
    (22, "/* SPDX-License-Identifier: LGPL-2.1-or-later */", "LGPL-2.1-or-later"),
    (23, "This is free and unencumbered software released into the public domain.", "Unlicense"),
    (24, "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin must not be misrepresented.", "Zlib"),
    (25, "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "LGPL-2.1-or-later"),
    (26, "Copyright 2020 Somebody.\nAll rights reserved.\nReleased under the MIT License.", "MIT"),
    (27, "We met: a friend, b. and others under the bridge.", ""),
]


def test_licences_of_every_case(spark):
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t, _ in LICENCES], "doc_id long, text string, licences string, left int")
    got = license_scan.scan_licences(docs).collect()
    assert sorted(str((r["doc_id"], r["licences"])) for r in got) == sorted(str((i, x)) for i, _, x in LICENCES)
    assert all((r["sentence_ids"] == "") <= (r["licences"] == "") for r in got)
    assert license_scan.scan_licences(docs.limit(0)).collect() == []


def test_licence_sql_reads_alike(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [[i, t] for i, t, _ in LICENCES])
    want = con.execute(corpus.oracle_sql()["op7_license_scan"]).fetchall()
    docs = spark.createDataFrame([(i, t) for i, t, _ in LICENCES], "doc_id long, text string")
    assert sorted(map(str, map(tuple, license_scan.scan_licences(docs).collect()))) == sorted(map(str, want))


def test_every_known_sentence_has_a_trigger():
    for sentence in license_scan.sentence_table():
        assert any(t in sentence for t in license_scan.TRIGGERS)
