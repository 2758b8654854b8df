"""Web archives (round trips and damage) and exact top-k search (against brute force)."""

import base64
import hashlib
import io
import math
import struct
from collections import defaultdict

import numpy as np
import pytest
import zstandard

from claimflow.llm import vector_search, warc

PAGES = "page_id long, url string, html string, payload string, first int"  # clashing names must not matter
LONG = "<p>long</p>" * 40_000


def pages():
    data = [(1, "http://a/b c\r\nX: y", "same"), (2, "http://b", "same"), (3, None, "é other"), (4, "u", None), (5, "u", ""), (6, "u", LONG), (7, "u", LONG)]
    data += [(i, f"http://h/{i}", f"<p>page {i % 13} of many</p>") for i in range(20, 200)]
    return [*data, (2, "http://b", "same"), (1, "z", "same"), (None, "n", "same"), (None, "n", "alone"), (None, "m", "alone")]


def expected(data, least=0):
    groups = defaultdict(list)
    for page, _, html in data:
        groups[html or ""].append(page)
    out = []
    for page, _, html in data:
        payload = (html or "").encode()
        known = [p for p in groups[html or ""] if p is not None]
        first = min(known) if known and len(payload) >= least else None
        revisit = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("least", [0, 10])
def test_archives_come_back(spark, least):
    data = pages()
    df = spark.createDataFrame([(*r, "x", 1) for r in data], PAGES).repartition(3)
    listed = warc.write_archives(df, least)
    got = warc.read_archives(listed).collect()
    assert sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in got) == expected(data, least)
    stored = sorted(str((r["page_id"], bytes(r["payload"]))) for r in got if r["payload"] is not None)
    kept = [(p, (h or "").encode()) for p, _, h in data]
    assert set(stored) <= {str(x) for x in kept}
    # the folder itself can be read as well
    folder = listed.first()["path"].rpartition("/")[0]
    assert warc.read_archives(warc.archives_in(spark, folder)).count() == len(data)
    assert warc.read_archives(warc.write_archives(df.limit(0))).collect() == []


def test_archives_roll_over(spark, monkeypatch):
    data = pages()
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 300)
    rows = []
    import pyarrow as pa

    from claimflow.llm.common import new_path

    batch = pa.RecordBatch.from_arrays(
        [pa.array([p for p, _, _ in data]), pa.array([u for _, u, _ in data]), pa.array([h or "" for _, _, h in data]), pa.nulls(len(data), pa.int64()), pa.array([False] * len(data))],
        names=["page_id", "url", "html", "first", "revisit"],
    )
    for out in warc._write(new_path(spark, "rolled"))(iter([batch])):
        rows += out.to_pylist()
    assert len(rows) > 3 and sum(r["records"] for r in rows) == len(data)


def an_archive(n=5, dictionary=b"HTTP/1.1 200 OK Content-Type: text/html payload " * 20):
    records = [warc.record(i, f"http://x/{i}", f"payload {i}".encode(), None, False, "2024-01-01T00:00:00Z") for i in range(n)]
    return records, b"".join(warc.frames_of(records, dictionary))


def test_dictionary_leads_in_a_skippable_frame():
    records, archive = an_archive()
    assert struct.unpack("<I", archive[:4])[0] == warc.DICTIONARY_FRAME
    assert list(warc.read_frames(io.BytesIO(archive), chunk=7)) == records
    raw = b"HTTP/1.1 200 OK plain"
    loaded = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    plain = struct.pack("<II", warc.DICTIONARY_FRAME, len(raw)) + raw + loaded.compress(records[0])
    other = struct.pack("<II", 0x184D2A50, 3) + b"abc"  # a skippable frame of another kind is passed over
    assert list(warc.read_frames(io.BytesIO(plain + other + loaded.compress(records[1])))) == records[:2]
    without = b"".join(warc.frames_of(records, None))
    assert list(warc.read_frames(io.BytesIO(without))) == records and list(warc.read_frames(io.BytesIO(b""))) == []


def test_damage_is_found():
    records, archive = an_archive()
    for broken in (archive[:-3], archive[:5], b"junk" + archive, archive[: len(archive) // 2]):
        with pytest.raises(warc.ArchiveError):
            list(warc.read_frames(io.BytesIO(broken)))
    good = records[0]
    assert warc.parse_record(good)["payload"] == b"payload 0"
    for broken in (
        good.replace(b"payload 0", b"payload X"),
        good.replace(b"WARC/1.1", b"HTTP/1.1"),
        good[:-1],
        good + b"x",
        good.replace(b"WARC-Date", b"WARC-Dite"),
        good.replace(b"WARC-Type: response", b"WARC-Type response"),
    ):
        with pytest.raises(warc.ArchiveError):
            warc.parse_record(broken)


def test_a_missing_record_is_found(spark):
    listed = warc.write_archives(spark.createDataFrame([(1, "u", "x"), (2, "u", "y")], "page_id long, url string, html string"))
    with pytest.raises(Exception, match="records, not"):
        warc.read_archives(listed.withColumn("records", listed["records"] + 1)).collect()


# --- search


def brute(rows, k, scale=64):
    """Every row is ranked by itself; a query meets all rows but those of its own id."""
    whole = [
        (vec_id, [math.floor(scale * float(x)) for x in v])
        for vec_id, v in rows
        if vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in whole:
        if q % 20:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b, strict=True)), c) for c, b in whole if c != q and len(a) == len(b)]
        out += [(q, rank, c, -s) for rank, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def searched(spark, rows, k=20, scale=64):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, score int, ids string")
    return sorted(tuple(r) for r in vector_search.top_k(df.where("vec_id % 20 = 0"), df, k, scale).collect())


@pytest.mark.parametrize("blocks", [False, True])
def test_search_of_every_case(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(vector_search, "QUERY_BLOCK", 3)
        monkeypatch.setattr(vector_search, "CANDIDATE_BLOCK", 16)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(0, 0.2, 24).tolist()) for i in range(150)]
    rows += [(i, [0.5] * 24) for i in range(200, 260)]  # ties
    rows += [(300, None), (320, []), (340, [float("nan")] * 24), (341, [None] * 24), (342, [float("inf")] * 24), (None, [0.1] * 24)]
    rows += [(400, [0.3, -0.2]), (401, [0.3, 0.9]), (402, [0.1, 0.1]), (20, rows[20][1]), (7, rows[7][1]), (7, [0.4] * 24)]
    assert searched(spark, rows) == brute(rows, 20)


def test_search_of_large_components(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(0, 1, 6) * 1e6).tolist()) for i in range(60)]
    assert searched(spark, rows, k=3) == brute(rows, 3)
    few = rows[:4]
    assert searched(spark, few) == brute(few, 20)
    assert searched(spark, []) == []


def test_bounds_never_fall_below_the_product():
    rng = np.random.default_rng(2)
    q, c = rng.normal(0, 9, (20, 30)), rng.normal(0, 9, (40, 30))
    exact, last = q @ c.T, None
    for n in vector_search.SEGMENTS:
        bound = vector_search.segment_statistics(q, n) @ vector_search.segment_statistics(c, n).T
        assert (bound >= exact - 1e-9).all()
        assert last is None or bound.sum() < last
        last = bound.sum()
