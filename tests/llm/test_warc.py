import gzip
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from nearfield.llm import queries, warc


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_equals_sql(spark, testdata):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{testdata}/pages.parquet'")
    cursor = con.execute(queries.ORACLE_SQL["op1_warc"])
    names = [c[0] for c in cursor.description]
    found = queries.op1_warc(spark, testdata)
    assert rows(found.select(*names)) == sorted(cursor.fetchall(), key=repr)


def test_odd_pages(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "http://b", None), (4, "u", ""), (5, "u", "ü" * 300_000),
         (None, "u", "same"), (None, "u", "alone"), (6, "u", "twice"), (6, "u", "twice")],
        "page_id long, url string, html string",
    )
    found = {(r.page_id, r.payload_digest): (r.payload_bytes, r.record_type, r.refers_to) for r in warc.archived_pages(pages).collect()}
    digest = {t: warc.base32_sha1(t.encode()) for t in ("same", "", "alone", "twice", "ü" * 300_000)}
    assert found == {
        (1, digest["same"]): (4, "revisit", 2),
        (2, digest["same"]): (4, "response", None),
        (3, digest[""]): (0, "revisit", 4),
        (4, digest[""]): (0, "response", None),
        (5, digest["ü" * 300_000]): (600_000, "response", None),
        (None, digest["same"]): (4, "revisit", 2),
        (None, digest["alone"]): (5, "response", None),
        (6, digest["twice"]): (5, "response", None),
    }
    assert warc.archived_pages(pages).count() == 9
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_payloads_below_the_limit_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    kinds = {r.record_id: r.record_type for r in warc.page_records(pages, min_bytes=3).collect()}
    assert [kinds[f"<urn:page:{k}>"] for k in (1, 2, 3, 4)] == ["response", "response", "revisit", "response"]


@pytest.fixture
def archive(spark, tmp_path, pages):
    path = str(tmp_path / "archive")
    warc.write_warc(warc.page_records(pages), path)
    return path


def test_payloads_come_back_whole(spark, archive, pages):
    found = warc.read_warc(spark, archive, ["target_uri", "record_type", "payload"]).where("record_type = 'response'")
    assert rows(found.select("target_uri", F.decode("payload", "utf-8"))) == rows(
        warc.page_records(pages).where("record_type = 'response'").select("target_uri", F.decode("payload", "utf-8"))
    )


def test_filters_reach_the_reader_and_payloads_stay_packed(spark, archive, monkeypatch):
    some = warc.read_warc(spark, archive, ["record_id", "record_type"]).where("record_type = 'response' AND record_id LIKE '<urn:page:1%'")
    assert "PythonDataSource" in some._jdf.queryExecution().toString() or "BatchScan" in some._jdf.queryExecution().toString()
    assert {r.record_type for r in some.collect()} == {"response"}
    reader = warc.WarcReader(archive, ["record_id", "record_type"])
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_length",), 3)]))
    assert [type(f) for f in left] == [warc.EqualTo] and left[0].attribute == ("payload_length",)
    inflated = []
    taken = warc._Source.take
    monkeypatch.setattr(warc._Source, "take", lambda *a: inflated.append(1) or taken(*a))
    whole = warc.WarcReader(archive, ["record_id", "read_length"])
    list(whole.pushFilters([warc.EqualTo(("record_type",), "revisit")]))
    for reader in (reader, whole):
        for part in reader.partitions():
            for batch in reader.read(part):
                pass
    assert not inflated


def test_archives_of_others(spark, tmp_path):
    """Members without a size field, plain files, folded headers, and a file that breaks off."""
    page = "<p>" + "x" * 200_000
    record = warc.record_bytes("<urn:page:1>", "response", "u", "2020", None, warc.base32_sha1(page.encode()), len(page), page.encode())
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <i>\r\nX-Long: a\r\n b\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    os.makedirs(tmp_path / "w")
    (tmp_path / "w/a.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(record) + gzip.compress(record))
    (tmp_path / "w/b.warc").write_bytes(info + record + record[:100])
    found = warc.read_warc(spark, str(tmp_path / "w"), ["record_id", "record_type", "payload_length", "read_length", "read_digest"])
    response = ("<urn:page:1>", "response", len(page), len(page), warc.base32_sha1(page.encode()))
    assert rows(found) == sorted([response] * 3 + [("<i>", "warcinfo", 4, 4, warc.base32_sha1(b"abcd"))] * 2, key=repr)
    heads = warc.read_warc(spark, str(tmp_path / "w"), ["record_id", "payload_length"])
    assert rows(heads) == sorted([("<urn:page:1>", len(page))] * 3 + [("<i>", 4)] * 2, key=repr)


def test_partitions_hold_whole_files():
    sizes = [("a", 5), ("b", 90), ("c", 60), ("d", 40), ("e", 1)]
    groups = warc.plan_files(sizes, 64)
    assert sorted(f for g in groups for f in g) == sorted(sizes)
    assert all(len(g) == 1 or sum(s for _, s in g) <= 64 for g in groups)


def test_uncommitted_files_are_not_read(spark, archive):
    before = warc.read_warc(spark, archive, ["record_id"]).count()
    (open(f"{archive}/part-lost.warc.gz", "wb")).write(warc.gzip_member(b"WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"))
    assert warc.read_warc(spark, archive, ["record_id"]).count() == before
