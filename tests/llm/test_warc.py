import duckdb
from llm_cases import SF01

from sparkclust.llm import queries, warc

PAGES = "page_id long, url string, html string, payload binary, revisit boolean, offset long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, b"x", True, 1) for r in rows], PAGES)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF01}/pages.parquet'")
    name = "op3_warc_archive"
    df = queries.QUERIES[name](spark, SF01)
    want = con.sql(queries.ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    got = sorted(tuple(r[c] for c in order) for r in df.collect())
    assert got == sorted(tuple(r[want.columns.index(c)] for c in order) for r in want.fetchall())


def test_round_trip_and_edges(spark):
    big = "é<p>" * 50
    rows = [(5, "http://a/1", big), (3, "http://a/2", big), (4, None, big), (3, "http://a/2", big), (None, "u", big),
            (6, "x", "short"), (7, "x", "short"), (8, "y", None), (9, "y", ""), (10, "z", "\r\n\r\n" * 60), (11, "long", "ab\x00c" * 500_000),
            (None, "n1", "q" * 100), (None, "n2", "q" * 100)]
    index = warc.write(pages(spark, rows))
    assert index.count() == len(rows)
    got = {(r.page_id, r.url): r for r in warc.read(index).collect()}
    assert got[3, "http://a/2"].record_type == "response" and got[3, "http://a/2"].payload == big.encode()
    assert (got[5, "http://a/1"].record_type, got[5, "http://a/1"].refers_to, got[5, "http://a/1"].payload) == ("revisit", 3, None)
    assert (got[4, None].record_type, got[4, None].payload_bytes) == ("revisit", len(big.encode()))
    assert (got[None, "u"].record_type, got[None, "u"].refers_to) == ("revisit", 3)
    assert all(got[k].record_type == "response" for k in [(6, "x"), (7, "x"), (8, "y"), (9, "y"), (None, "n1"), (None, "n2")])
    assert got[8, "y"].payload == b"" and got[10, "z"].payload == b"\r\n\r\n" * 60
    assert got[11, "long"].payload_bytes == 2_000_000


def test_selected_records_only(spark):
    index = warc.write(pages(spark, [(i, f"u{i}", f"page {i} " * 30) for i in range(50)]))
    got = warc.read(index.where("page_id % 10 = 3")).collect()
    assert sorted(r.page_id for r in got) == [3, 13, 23, 33, 43]
    assert all(r.payload == (f"page {r.page_id} " * 30).encode() for r in got)


def test_empty_table(spark):
    index = warc.write(pages(spark, []))
    assert index.count() == 0 and warc.read(index).count() == 0


def test_ranges_are_coalesced():
    g, b = warc.GAP_BYTES, warc.BLOCK_BYTES
    entries = [("a", 0, 10), ("a", 10, 5), ("a", 15 + g, 5), ("a", 21 + 2 * g, 5), ("b", 0, 9), ("b", 9, b), ("b", 9 + b, 1)]
    assert list(warc.ranges(entries)) == [
        ("a", 0, 20 + g, [0, 1, 2]), ("a", 21 + 2 * g, 26 + 2 * g, [3]), ("b", 0, 9, [4]), ("b", 9, 9 + b, [5]), ("b", 9 + b, 10 + b, [6])
    ]


def test_a_changed_payload_is_noticed():
    import zlib

    import pytest

    data = zlib.decompress(warc.member(1, "u", b"abc" * 9, "0" * 64, None, False), 31)
    with pytest.raises(ValueError):
        warc.parse(zlib.compress(data, wbits=31))
