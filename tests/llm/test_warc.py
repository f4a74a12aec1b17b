"""Archives: exact round trip, framing and digests."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from kinship.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first_id int, archive string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def round_trip(df, **kw):
    man = warc.write_archives(df, warc.archive_folder(df), **kw)
    return man, warc.read_archives(man, batch_rows=3)


def test_round_trip(spark):
    rng = random.Random(2)
    body = "<p>" + "é" * 30000
    rows = [(i, f"http://h/{i}", rng.choice(["", "a", "b\r\n\r\nWARC/1.1", body])) for i in range(60)]
    rows += [(None, None, "a"), (None, "u\r\nX: y", "only"), (3, rows[3][1], rows[3][2]), (99, None, None),
             (100, "http://big", "x" * 3_000_000)]
    man, back = round_trip(pages(spark, rows), roll_bytes=2000)
    assert man.count() > 1
    first = {}
    for i, _, h in rows:
        h = h or ""
        if i is not None and (h not in first or i < first[h]):
            first[h] = i
    exp = []
    for i, u, h in rows:
        h = h or ""
        f = first.get(h)
        kind = "response" if f is None or i == f else "revisit"
        d = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        exp.append((i, u and u.replace("\r\n", "%0D%0A"), len(h.encode()), d, kind, f if kind == "revisit" else None))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(exp, key=str)


def test_empty_table(spark):
    man, back = round_trip(pages(spark, []))
    assert man.count() == 0 and back.collect() == []


def test_one_member_per_record_is_plain_gzip():
    data = [warc.make_record(i, f"u{i}", b"p%d" % i, 0, i == 0) for i in range(3)]
    joined = b"".join(data)
    assert gzip.decompress(joined) == b"".join(map(gzip.decompress, data))
    got = list(warc.records(io.BytesIO(joined)))
    assert [r.headers["warc-type"] for r in got] == ["response", "revisit", "revisit"]
    assert list(warc.members(io.BytesIO(joined), step=1)) == list(map(gzip.decompress, data))


@pytest.mark.parametrize("harm", [
    lambda raw: raw.replace(b"payload", b"pAyload"),
    lambda raw: raw.replace(b"\r\n\r\npayload", b"\r\n\r\npayloa"),
    lambda raw: raw.replace(b"WARC/1.1", b"WARC/0.0"),
])
def test_damage_is_found(harm):
    raw = gzip.decompress(warc.make_record(1, "u", b"payload", 1, True))
    with pytest.raises(warc.CorruptArchive):
        for r in warc.records(io.BytesIO(gzip.compress(harm(raw)))):
            warc.page_row(r)


def test_cut_archive_is_found():
    raw = warc.make_record(1, "u", b"payload", 1, True)
    with pytest.raises(warc.CorruptArchive):
        list(warc.records(io.BytesIO(raw[:-9])))
