import hashlib
import random

import pytest
from pyspark.sql import functions as F

from newslake.llm import queries, warc
from newslake.session import work_dir
from tests.llm import cases

FAKE = warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: {}\r\n\r\nfalse" + warc.END
BIG = "<html>" + "payload " * 60 + "</html>"


@pytest.fixture
def small_blocks(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", size)

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def hostile(n=40):
    chance = random.Random(5)
    rows = []
    for i in range(n):
        parts = [chance.choice([warc.MAGIC, "WARC/1.1", FAKE.format(chance.choice([5, 9, 700, 10**12])), "x" * 150, "\r\n\r\n", "é中"])
                 for _ in range(chance.randrange(6))]
        rows.append((i, f"http://a.example/{i}", "".join(parts)))
    return rows


def read_back(spark, df, folder=None):
    path = folder or work_dir(spark, "warc-test")
    warc.write_archives(warc.records_of(df), path)
    return {r.id: r for r in warc.read_archives(spark, path).collect()}


@pytest.mark.parametrize("size", ["1000", "2500", "128m"])
def test_magic_inside_payloads_is_rejected_whatever_the_blocks(spark, small_blocks, size):
    rows = hostile()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    small_blocks(size)
    found = read_back(spark, df)
    assert set(found) == {str(i) for i, _, _ in rows}
    first = {}
    for i, _, html in rows:
        first.setdefault(html, i)
    for i, url, html in rows:
        r, payload = found[str(i)], html.encode()
        again = len(payload) >= warc.SHARED_BYTES and first[html] != i
        assert r.type == ("revisit" if again else "response") and r.refers == (str(first[html]) if again else None)
        assert r.stated_bytes == len(payload) and r.stated_digest == hashlib.sha256(payload).hexdigest() and r.url == url
        if not again:
            assert bytes(r.payload) == payload and (r.bytes, r.digest) == (r.stated_bytes, r.stated_digest)


def test_a_record_over_many_blocks_and_a_damaged_file(spark, small_blocks):
    rows = [(1, None, "a" * 120), (2, "u v\r\nX: y", (warc.MAGIC + "b" * 50) * 200), (3, "c", "c" * 130)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).sortWithinPartitions("page_id")
    small_blocks("700")
    found = read_back(spark, df)
    assert {i: bytes(r.payload).decode() for i, r in found.items()} == {str(i): html for i, _, html in rows}
    assert found["1"].url is None and found["2"].url == "u%20v%0D%0AX:%20y"
    values = [r.value for r in warc.records_of(df).collect()]
    values.sort(key=lambda v: v.split("<urn:page:")[1])
    for damaged, whole in ([values[0], "junk" + values[1], values[2]], {"1"}), ([values[0], values[1][:-40]], {"1"}), (["", *values], set()):
        path = work_dir(spark, "warc-damaged")
        lines = spark.createDataFrame([(i, v) for i, v in enumerate(damaged)], "i int, value string").coalesce(1)
        warc.write_archives(lines.sortWithinPartitions("i").select("value"), path)
        assert {r.id for r in warc.read_archives(spark, path).collect()} == whole


@pytest.mark.parametrize("size", ["700", "128m"])
def test_all_records_before_a_damaged_place(spark, small_blocks, size):
    rows = [(i, None, f"{i}" * 120) for i in range(8)]
    values = [r.value for r in warc.records_of(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    values.sort(key=lambda v: v.split("<urn:page:")[1])
    small_blocks(size)
    for place in (1, 2, 5, 7):
        path = work_dir(spark, "warc-damaged")
        damaged = [*values[:place], "junk" + values[place], *values[place + 1 :]]
        lines = spark.createDataFrame(list(enumerate(damaged)), "i int, value string").coalesce(1)
        warc.write_archives(lines.sortWithinPartitions("i").select("value"), path)
        found = {r.id: bytes(r.payload).decode() for r in warc.read_archives(spark, path).collect()}
        assert found == {str(i): html for i, _, html in rows[:place]}


def test_edges(spark, monkeypatch):
    rows = [(1, "u", None), (2, "u", ""), (3, None, BIG), (4, "u", BIG), (None, "u", BIG), (None, None, None), (5, "u", "short"), (6, "u", "short")]
    rows += [(3, "u", BIG), (7, "u", "é" * 50), (8, "u", "é" * 50), (9, "u", "é" * 49), (10, "u", "é" * 49), (11, "u", "long " * 60_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for pages in (df, cases.clashing(df.withColumn("doc_id", F.lit(1)))):
        monkeypatch.setattr(queries, "table", lambda *_, pages=pages: pages)
        found = queries.QUERIES["op13_warc"](spark, "")
        assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        refers = {4: 3, None: 3, 8: 7}
        expected = []
        for i, _, html in rows:
            payload = (html or "").encode()
            to = refers.get(i) if len(payload) >= 100 else None
            expected.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if to else "response", to))
        assert cases.rows(found) == sorted(expected, key=repr)
    monkeypatch.setattr(queries, "table", lambda *_: cases.empty(df))
    assert queries.QUERIES["op13_warc"](spark, "").count() == 0


def test_text_ids_are_escaped(spark):
    df = spark.createDataFrame([("a>\r\nb:c é", "u", "x"), ("", "u", "y")], "page_id string, url string, html string")
    assert {r.id: bytes(r.payload) for r in warc.read_archives(spark, write(spark, df)).collect()} == {"a>\r\nb:c é": b"x", None: b"y"}


def write(spark, df):
    path = work_dir(spark, "warc-ids")
    warc.write_archives(warc.records_of(df), path)
    return path
