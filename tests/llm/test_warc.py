import hashlib
import os

import zstandard

from duetlog.llm import warc
from duetlog.llm.common import read
from duetlog.session import staging_path
from .conftest import SF01
from .oracle_check import compare


def test_whole_table_equals_duckdb(spark):
    assert compare("op9_warc_archives", spark, SF01) == 250


def _files(path):
    local = path.removeprefix("file:")
    return sorted(os.path.join(local, f) for f in os.listdir(local) if f.startswith("part-"))


def test_files_are_plain_zstandard(spark):
    pages = read(spark, SF01, "pages")
    path = staging_path(spark, "warc-test")
    warc.write_archives(pages, path)
    n, size = 0, 0
    for f in _files(path):
        data = open(f, "rb").read()
        assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
        shared = data[8: 8 + int.from_bytes(data[4:8], "little")]
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(shared))
        whole = reader.stream_reader(data, read_across_frames=True).read()      # any reader, all frames at once
        assert whole.startswith(b"WARC/1.1\r\n")
        n += whole.count(b"WARC/1.1\r\nWARC-Type: ")
        size += len(data) - len(shared)
    html = {r.page_id: r.html for r in pages.collect()}
    assert n == len(html)
    assert size < sum(len(h.encode()) for h in html.values()) / 2
    back = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(spark, path).collect() if r.payload is not None}
    assert back == html


def test_odd_rows(spark):
    same = "<p>" + "equal " * 30
    rows = [(5, "u", same), (3, None, same), (9, "http://x/a b\r\nX: y", same), (9, "u2", same), (None, "n", same),
            (1, "e", None), (2, "e", ""), (4, "s", "short"), (6, "s", "short"), (7, "sep", "P*M\x18\0\0\0\0" * 50),
            (8, "long", "é" * 300000), (3, None, same)]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, payload int, first_id string")
    got = sorted(map(tuple, warc.round_trip(pages).collect()), key=repr)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        rev = h == same and i != 3
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if rev else "response", 3 if rev else None))
    assert got == sorted(want, key=repr)
    assert warc.round_trip(pages.limit(0)).count() == 0
    one = pages.where("page_id = 4")
    assert warc.round_trip(one).collect()[0].record_type == "response"
    none = pages.where("page_id is null").union(pages.where("page_id is null"))
    assert [r.record_type for r in warc.round_trip(none).collect()] == ["response"] * 2


def test_files_of_bounded_size_each_with_the_dictionary(spark, monkeypatch):
    import glob

    from duetlog.session import staging_path
    monkeypatch.setattr(warc, "PACK_BYTES", 3000)
    monkeypatch.setattr(warc, "FILE_PACKS", 2)
    rows = [(i, f"u{i}", f"<html>page {i} " + "some words of a page " * (i % 90) + "</html>") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    for most in ("0", "1", "40"):                   # whatever the session says
        spark.conf.set("spark.sql.files.maxRecordsPerFile", most)
        try:
            path = staging_path(spark, "warc")
            warc.write_archives(pages, path)
        finally:
            spark.conf.unset("spark.sql.files.maxRecordsPerFile")
        files = [f for f in glob.glob(path.removeprefix("file:") + "/part-*")]
        assert len(files) > 4
        for f in files:                             # each file stands alone
            data = open(f, "rb").read()
            assert int.from_bytes(data[:4], "little") == warc._DICTIONARY_MAGIC
            assert sum(1 for _ in warc.frames(memoryview(data))) > 0
        got = warc.read_archives(spark, path).collect()
        assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == [(i, h) for i, _, h in rows]
