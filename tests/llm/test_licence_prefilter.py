"""Licence sentences without a trigger word, or with one parted by a line break, against the SQL of the query."""

import duckdb
import pytest

from claimflow.llm import license_scan
from claimflow.llm import queries as corpus

TEXTS = [
    ("This work is available under CC BY 4.0.", "CC-BY-4.0"),
    ("This document is published under CC0.", "CC0-1.0"),
    ("This software is distributed under GPLv3.", "GPL-3.0"),
    ("The code is made available under the terms of the MPL 2.0.", "MPL-2.0"),
    ("Shared under BSD 3-Clause", "BSD-3-Clause"),
    ("Provided under ISC. Published under Apache 2.0.", "Apache-2.0,ISC"),
    ("Released\nunder MIT.", "MIT"),
    ("This file is published\r\nunder the MIT.\r\n", "MIT"),
    ("Dual lic\rensed under MIT", "MIT"),
    ("Copyright (c) 2020 Someone.\nAll rights\nreserved.", "Proprietary"),
    ("The bridge is under repair. All software, all rights.", ""),
]


def test_sentences_without_a_trigger(spark):
    rows = [(k, text) for k, (text, _) in enumerate(TEXTS)]
    got = license_scan.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in rows])
    want = con.execute(corpus.oracle_sql()["op7_license_scan"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert [r["licences"] for r in sorted(got)] == [licences for _, licences in TEXTS]


@pytest.mark.parametrize("trigger", license_scan.TRIGGERS)
def test_words_cover_the_triggers(trigger):
    assert any(word in part for word in license_scan.WORDS for part in trigger.split())
