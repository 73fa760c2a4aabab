import base64
import gzip
import hashlib

import cases
import pytest

from headway.llm import warc

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h{i % 7}.example.com/p/{i % 20}?q=ä b", f"<html>{'x' * (i % 11)} é {i % 23}</html>") for i in range(200)]
    rows += [(300, None, None), (301, "", ""), (302, "no-scheme/path", None), (None, "http://a.b/", "<html>only</html>")]
    rows += [(None, "http://c.d/", rows[3][2]), (303, "http://e.f/\r\nX: y", "<html>\r\n\r\nWARC/1.1\r\n</html>")]
    rows += [(304, "http://twin.example/", "twin")] * 2 + [(305, "http://big.example/", "y" * 300_000)]
    return spark.createDataFrame(rows, PAGES)


def expected(rows):
    least = {}
    for r in rows:
        if r.page_id is not None:
            least[r.html or ""] = min(r.page_id, least.get(r.html or "", r.page_id))
    out = []
    for r in rows:
        payload = (r.html or "").encode()
        first = least.get(r.html or "")
        again = first is not None and r.page_id != first
        out.append((r.page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark, pages):
    found = warc.archived(cases.clashing(pages))
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert cases.rows_of(got) == expected(pages.collect())
    assert found.filter("NOT intact").count() == 0


def test_least_bytes(spark, pages):
    _, captures = warc.write_archives(pages, least_bytes=1_000_000)
    assert captures.count() == pages.count()
    assert warc.revisits(pages, 1_000_000).count() == 0


def test_archives_are_gzip_members_of_bounded_size(spark, pages):
    folder, captures = warc.write_archives(pages, archive_bytes=4000)
    store, path = warc._store(folder)
    rows = captures.collect()
    assert len({r.archive for r in rows}) > 3
    for r in rows[:40]:
        with store.open_input_file(f"{path}/{r.archive}") as f:
            data = gzip.decompress(f.read_at(r.length, r.offset))
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    whole = gzip.decompress(store.open_input_file(f"{path}/{rows[0].archive}").read())
    assert whole.count(b"WARC-Type: ") >= 2


def test_lookup_finds_every_capture_of_a_key_and_no_other(spark, pages):
    folder, captures = warc.write_archives(pages)
    index, files = warc.build_index(captures, block_lines=3)
    assert files.agg({"rows": "sum"}).first()[0] == pages.count()
    held = captures.collect()
    wanted = sorted({r.key for r in held})[::3]
    asked = spark.createDataFrame([(k,) for k in [*wanted, "com,nowhere)/", "zz)"]], "key string")
    assert cases.rows_of(warc.lookup(asked, index, files)) == sorted(
        (tuple(r) for r in held if r.key in wanted), key=repr
    )
    texts = warc.read_records(warc.lookup(asked, index, files), folder)
    assert texts.filter("record_type = 'response' AND payload IS NULL").count() == 0


def test_as_many_reading_tasks_as_the_bytes_ask_for(spark, pages, monkeypatch):
    folder, captures = warc.write_archives(pages, archive_bytes=4000)
    size = captures.agg({"length": "sum"}).first()[0]
    few = warc.read_records(captures, folder)
    assert few.rdd.getNumPartitions() == 1
    monkeypatch.setattr(warc, "READ_BYTES", 1500)
    many = warc.read_records(captures, folder)
    assert many.rdd.getNumPartitions() == 1 + size // 1500 > 5
    assert cases.rows_of(many) == cases.rows_of(few)


def test_url_with_captures_in_several_index_files(spark):
    rows = [(i, "http://one.example/" if i % 3 else f"http://h{i}.example/", f"body {i}") for i in range(120)]
    folder, captures = warc.write_archives(spark.createDataFrame(rows, PAGES))
    index, files = warc.build_index(captures, block_lines=2)
    asked = spark.createDataFrame([("example,one)/",)], "key string")
    found = warc.lookup(asked, index, files)
    assert sorted(r.page_id for r in found.collect()) == [i for i in range(120) if i % 3]


def test_url_keys():
    assert warc.url_key("http://User@A.Example.com/x?y") == "com,example,a)/x?y"
    assert warc.url_key("https://a.b?c") == "b,a)?c"
    assert warc.url_key(None) == warc.url_key("") == ")"


def test_no_pages(spark, pages):
    assert warc.archived(pages.limit(0)).count() == 0
