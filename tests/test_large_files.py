"""Digests of files that no task may hold as a whole."""

import hashlib
import random

from weftline.sources import digests


def tree(chunks):
    return hashlib.sha256("".join(hashlib.sha256(c).hexdigest() for c in chunks).encode()).hexdigest()


def test_a_file_beyond_two_gigabytes(spark, tmp_path):
    with (tmp_path / "large.bin").open("wb") as f:
        f.truncate((1 << 31) + 5)
    got = digests.file_digests(spark, str(tmp_path)).collect()
    zero = bytes(1 << 20)
    assert [(r["length"], r["digest"], r["was_read"]) for r in got] == [((1 << 31) + 5, tree([zero] * 2048 + [bytes(5)]), True)]


def test_ranges_of_every_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digests, "RANGE", 64)
    rng = random.Random(1)
    content = {f"{n} [{n}]%20*.bin": rng.randbytes(n) for n in (1, 9, 10, 59, 60, 61, 120, 601)}
    for n, raw in content.items():
        (tmp_path / n).write_bytes(raw)
    got = {r["path"].rsplit("/", 1)[1]: r["digest"] for r in digests.file_digests(spark, str(tmp_path), None, 10).collect()}
    assert got == {n: tree([raw[i : i + 10] for i in range(0, len(raw), 10)]) for n, raw in content.items()}


def test_other_stores_are_read_by_spark(spark, tmp_path, monkeypatch):
    (tmp_path / "a.bin").write_bytes(b"abc" * 50)
    want = digests.file_digests(spark, str(tmp_path), None, 10).first()["digest"]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.digests.link./in", f"file://{tmp_path}")
    got = digests.file_digests(spark, "viewfs://digests/in", None, 10).collect()
    assert [(r["path"], r["digest"]) for r in got] == [("viewfs://digests/in/a.bin", want)]
