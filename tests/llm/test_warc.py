import hashlib

import pytest

from orderlens.llm import common, queries, warc

SF = "/root/testdata/sf0.001"


def archived(df, **kw):
    spark = df.sparkSession
    archive = warc.write_archive(df, **kw)
    return archive, warc.read_archive(spark, archive).collect()


def test_records_and_payloads_come_back(spark):
    big, other = "<p>" + "é" * 100 + "</p>", "<p>" + "x" * 200 + "</p>"
    rows = [(7, "http://a/1", big, "z", None), (3, "http://a/2", big, None, "q"), (9, None, big, "w", "w"), (4, "http://b/\r\nX: y", other, "", ""),
            (5, "http://c/", "short", "", ""), (6, "http://c/", "short", "", ""), (8, "http://d/", None, "", ""), (10, "http://d/", "", "", ""),
            (None, "http://n/", other, "", ""), (3, "http://a/2", big, None, "q"), (11, "http://l/", "y" * 300_000, "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, payload string")
    archive, got = archived(df)
    assert len(got) == len(rows)
    stored = spark.read.parquet(archive.payloads).collect()
    assert len(stored) == len({r[2] or "" for r in rows})            # bytes once a content
    want = sorted(((r[0], (r[2] or "").encode()) for r in rows), key=repr)
    assert sorted(((r.id, bytes(r.payload)) for r in got), key=repr) == want
    kinds = {(r.id, bytes(r.payload)): (r.record_type, r.refers_to) for r in got}
    assert kinds[(3, big.encode())] == ("response", None)             # repeated rows are one page
    assert kinds[(7, big.encode())] == kinds[(9, big.encode())] == ("revisit", 3)
    assert kinds[(None, other.encode())] == ("revisit", 4)
    assert kinds[(5, b"short")] == kinds[(6, b"short")] == kinds[(8, b"")] == ("response", None)
    for r in got:
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and fields["WARC-Type"] == r.record_type
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(bytes(r.payload)).hexdigest() == "sha256:" + r.payload_digest
        assert int(fields["Content-Length"]) == len(body) - 4
        assert body == (b"" if r.record_type == "revisit" else bytes(r.payload)) + b"\r\n\r\n"
    assert {(r.id, r.url) for r in got} == {(r[0], r[1]) for r in rows}
    assert b"%0D%0AX: y" in bytes(next(r.record for r in got if r.id == 4))


def test_urls_come_back_as_they_were(spark):
    urls = ["http://a/%0D%0A", "http://a/\r\n%0D", "http://a/%", "http://a/%25\n", "", None, "http://a/é?x=1%20"]
    got = archived(spark.createDataFrame([(i, u, f"p{i}") for i, u in enumerate(urls)], "page_id long, url string, html string"))[1]
    assert [r.url for r in sorted(got, key=lambda r: r.id)] == urls
    for r in got:
        head = bytes(r.record).partition(b"\r\n\r\n")[0].decode()
        if urls[r.id] and "\n" not in urls[r.id]:
            assert f"\r\nWARC-Target-URI: {urls[r.id]}\r\n" in head


def test_a_changed_payload_is_noticed(spark):
    df = spark.createDataFrame([(1, "u", "x" * 200)], "page_id long, url string, html string")
    archive = warc.write_archive(df)
    bad = common.shared_path(spark, "bad")
    spark.createDataFrame([(spark.read.parquet(archive.payloads).first().digest, bytearray(b"other"))], "digest string, payload binary").write.parquet(bad)
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archive(spark, warc.Archive(bad, archive.records)).collect()


def test_empty_and_query(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert archived(df)[1] == []
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.QUERIES["op1_warc"](spark, SF).collect()}
    assert got.keys() == pages.keys()
    assert all(got[i].payload_bytes == len(h.encode()) and got[i].payload_digest == hashlib.sha256(h.encode()).hexdigest() for i, h in pages.items())
