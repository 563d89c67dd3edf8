import gzip


from hazeframe.llm.warc import archive, digest, merged, read_warc, write_warc

ROWS = [
    (1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (7, None, "<p>x</p>"), (3, "http://b/\r\nX: y", ""), (4, "http://b/4", None),
    (5, "http://c/é", "ü" * 9000), (6, "http://c/6", "WARC/1.1\r\n\r\n\x00"), (8, "http://c/8", "z" * 3_000_000),
]


def expected(rows):
    by = {}
    for k, _, html in rows:
        by[html or ""] = max(k, by.get(html or "", k))
    out = []
    for k, _, html in rows:
        data, first = (html or "").encode(), by[html or ""]
        out.append((k, len(data), digest(data), "response" if k == first else "revisit", None if k == first else first))
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()))


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'f' AS file", "1 AS sha")


def test_round_trip(spark):
    assert result(archive(spark, pages(spark).repartition(3))) == expected(ROWS)
    assert digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_index_gives_any_record_alone(spark, tmp_path):
    index = write_warc(pages(spark).coalesce(1), f"file://{tmp_path}", file_bytes=300)
    assert index.select("file").distinct().count() > 1
    some = index.where("page_id IN (5, 2, 6)")
    got = {r["page_id"]: r for r in read_warc(some).collect()}
    assert set(got) == {2, 5, 6} and got[2]["payload"] is None and got[2]["refers_to"] == 7
    assert got[5]["payload"].decode() == "ü" * 9000 and bytes(got[6]["payload"]) == b"WARC/1.1\r\n\r\n\x00"
    for r in index.collect():
        with open(r["file"].removeprefix("file://"), "rb") as f:
            f.seek(r["offset"])
            text = gzip.decompress(f.read(r["length"])).decode()
        assert text.startswith(f"WARC/1.1\r\nWARC-Type: {r['record_type']}\r\nWARC-Record-ID: <urn:x-page:{r['page_id']}>")
        assert ("\nX: y" not in text) and r["payload_digest"] in text


def test_short_payloads_may_be_left_alone(spark, tmp_path):
    index = write_warc(pages(spark), f"file://{tmp_path}", least_bytes=1)
    kinds = {r["page_id"]: r["record_type"] for r in index.collect()}
    assert kinds[3] == kinds[4] == "response" and kinds[1] == "revisit"


def test_null_ids_repeated_rows_and_empty(spark):
    rows = [(None, None, "a"), (1, "u", "a"), (1, "u", "a"), (None, "u", "b"), (None, "u", "b")]
    got = sorted(((r[0] or 0, r[3], r[4]) for r in archive(spark, pages(spark, rows)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    assert got == sorted([(0, "revisit", 1), (1, "response", None), (1, "response", None), (0, "response", None), (0, "response", None)], key=str)
    assert archive(spark, pages(spark).limit(0)).count() == 0


def test_ranges_merge_within_gap_and_size():
    ranges = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 5), ("b", 0, 5), ("b", 5, 90), ("b", 95, 30)]
    assert [len(g) for g in merged(ranges, gap=5, most=100)] == [3, 1, 2, 1]
