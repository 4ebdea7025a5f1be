import hashlib
import io

import pytest

from weftline.llm import warc


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, offset int")


LONG = "<p>é</p>" * 50
ROWS = [
    (4, "http://www.Example.com/a?q=1", LONG),
    (2, "https://example.com:8080/a", LONG),
    (9, "http://example.com/a?q=1", LONG),
    (1, None, None),
    (3, "", ""),
    (5, "http://b.org/x", "short"),
    (6, "http://b.org/x", "short"),
    (20, "http://c.org/\r\nInjected: 1", "y" * 300_000),
    (40, "http://[bad", "line\r\n\r\nWARC/1.1\r\n" * 20),
    (None, "http://d.org/", LONG),
]


def test_round_trip(spark):
    out = warc.captured(frame(spark, ROWS), every=1).collect()
    assert len(out) == len(ROWS)
    by = {r.page_id: r for r in out}
    for page, _, html in ROWS:
        raw = (html or "").encode()
        r = by[page]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert {p: (r.record_type, r.refers_to) for p, r in by.items() if r.record_type == "revisit"} == {4: ("revisit", 2), 9: ("revisit", 2)}
    assert by[4].url_captures == by[9].url_captures == 1 and by[5].url_captures == 2 and by[2].url_captures == 1 and by[None].url_captures is None
    assert warc.captured(frame(spark, [])).count() == 0


def test_index_finds_all_captures(spark):
    rows = [(i, f"http://h{i % 7}.org/p{i % 40}", f"page {i} " * 30) for i in range(300)]
    archive = warc.write(frame(spark, rows).repartition(3), lines=16)
    index = warc.open_index(archive)
    assert len(index.rows) >= 300 // 16
    for i in range(0, 300, 20):
        want = sorted(p for p, u, _ in rows if u == rows[i][1])
        got = index.captures(rows[i][1])
        assert [c[0] for c in got] == want
        assert [index.fetch(c)["payload"].decode() for c in got] == [rows[p][2] for p in want]
    assert index.captures("http://none.org/") == []
    asked = frame(spark, rows).where("page_id % 20 = 0")
    found = warc.lookup(archive, asked).collect()
    assert {(r.query_id, r.page_id) for r in found} == {(i, p) for i in range(0, 300, 20) for p, u, _ in rows if u == rows[i][1]} and all(r.matched for r in found)


def test_wider_blocks_bound_the_directory(spark):
    archive = warc.write(frame(spark, [(i, f"http://a.org/{i}", "x") for i in range(100)]), lines=2, most_blocks=5)
    assert archive.directory.count() <= 5 + archive.captures.rdd.getNumPartitions()


@pytest.mark.parametrize(("url", "key"), [("http://www.a.B.com/x?q", "com,b,a)/x?q"), ("https://a.com:444", "com,a:444)/"), (None, ")/"), ("a.com/x", "com,a)/x"), ("http://a.com:80/", "com,a)/")])
def test_url_key(url, key):
    assert warc.url_key(url) == key


def test_cut_archives_fail():
    data = warc.record(1, "u", b"payload", "d", None, None)
    assert [warc.parse(d)["payload"] for *_, d in warc.members(io.BytesIO(data * 3), 7)] == [b"payload"] * 3
    with pytest.raises(ValueError, match="cut off"):
        list(warc.members(io.BytesIO(data[:-4])))
