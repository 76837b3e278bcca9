from hashlib import sha256

from tackroom.llm.warc import read_archives, write_archives

SCHEMA = "page_id long, url string, html string, id string, digest string, payload int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = i is not None and first.get(h, i) != i
        out.append((i, len(data), sha256(data).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None))
    return sorted(out, key=str)


FAKE = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: {n}\r\n\r\n")
ROWS = [(1, "http://a/1", "<p>é</p>" * 40), (2, "http://a/2", "<p>é</p>" * 40), (0, None, "<p>é</p>" * 40), (3, "u\r\nx: y", ""), (4, "", None),
        (5, "http://b", "short"), (6, "http://b", "short"),
        (7, "http://c", "before " + FAKE.format(n=5) + "inner\r\n\r\n after"), (8, "http://c", FAKE.format(n=10**6) + "x"),
        (9, "http://c", "WARC/1.0\r\n" * 30 + "\r\n\r\n"), (10, "http://d", "x" * 100), (11, "http://d", "x" * 100), (11, "http://d", "x" * 100),
        (12, "http://d", "y" * 99), (13, "http://d", "y" * 99), (None, "http://e", "x" * 100), (14, "http://f", "end\r\n\r\nWARC/1.0"),
        (15, "http://g", FAKE.format(n=3) + "abc\r\n\r\n" + FAKE.format(n=0) + "\r\n\r\n")]


def run(spark, rows, path):
    write_archives(pages(spark, rows), path)
    got = read_archives(spark, path)
    return sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=str)


def test_round_trip(spark, tmp_dir):
    assert run(spark, ROWS, tmp_dir + "/w") == brute(ROWS)


def test_splits_inside_records_and_payloads(spark, tmp_dir):
    write_archives(pages(spark, ROWS).coalesce(1), tmp_dir + "/w")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = read_archives(spark, tmp_dir + "/w", payloads=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(ROWS)
    by_id = {i: (h or "") for i, _, h in ROWS}
    assert all(bytes(r.payload).decode() == by_id[r.id] for r in got)
    assert next(r.url for r in got if r.id == 3) == "u%0D%0Ax: y"


def test_cut_off_file(spark, tmp_dir):
    import glob
    import os
    write_archives(pages(spark, [(1, "a", "one " * 50), (2, "b", "two " * 50)]).coalesce(1), tmp_dir + "/w")
    file = next(f for f in glob.glob(tmp_dir + "/w/part-*"))
    data = open(file, "rb").read()
    os.makedirs(tmp_dir + "/cut")
    open(tmp_dir + "/cut/part-0", "wb").write(data[:-20])
    assert [r.id for r in read_archives(spark, tmp_dir + "/cut").collect()] == [1]


def test_empty_table(spark, tmp_dir):
    assert run(spark, [], tmp_dir + "/w") == []
