import gzip
import hashlib
import html as entities
import re

import pyarrow.parquet as pq
import pytest

from kiln.llm.html import default_field, extract_main, labelled_pages, leaf_blocks
from kiln.llm.warc import (IndexReader, lookup_urls, new_folder, parse_record, read_records, url_key, warc_record, write_archives,
                           write_index)


# ---- main text ----

def article(page):
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S).group(1)
    body = re.sub(r"</?(?:p|h1|br)[^>]*>", " ", re.sub(r"</?b>", "", body))
    return " ".join(entities.unescape(body).split())


def test_articles_of_the_page_table():
    field = default_field()
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        assert field.extract(page) == article(page)


def test_held_out_layouts():
    field, right, total = default_field(), 0, 0
    for blocks, labels in labelled_pages(150, seed=1234):
        right += sum(a == b for a, b in zip(field.decode(blocks), labels))
        total += len(labels)
    assert right / total > 0.98


def test_blocks_of_broken_markup():
    text = lambda page: [b.text for b in leaf_blocks(page)]
    assert text("<div>a &lt b<script>if(a<b)</script><p>Hello <b>wor</b>ld<br>two&nbsp;x<p>three") == [
        "a < b", "Hello world", "two x", "three"]
    assert text("<p title='a>b'>x</p><!-- <p>no</p> -->y<style>p{}</style>") == ["x", "y"]
    assert text("<ul><li>one<li>two</ul>") == ["one", "two"]
    assert text("") == [] and text("<a") == [] and text("<<<>>>") == ["<<<>>>"] and text("x<!-- open") == ["x"]
    assert text("<div>" * 5000 + "deep") == ["deep"]


def test_pages_with_nulls_repeats_and_clashing_columns(spark):
    page = "<article><p>Some longer main text, that goes on.</p></article><footer>&copy; x</footer>"
    df = spark.createDataFrame([(1, None, None, 1), (None, "u", "", 2), (2, "u", page, 3), (2, "u", page, 3),
                                (3, "u", "<p>" + "word " * 200000, 4)], "page_id long, url string, html string, text int")
    got = {(r["page_id"], r["text"], r["n_chars"]) for r in extract_main(df, default_field()).collect() if r["page_id"] != 3}
    main = "Some longer main text, that goes on."
    assert got == {(1, "", 0), (None, "", 0), (2, main, len(main))}
    assert extract_main(df.where("false"), default_field()).count() == 0


# ---- archives ----

@pytest.fixture(scope="module")
def archive(spark):
    big = "é" * 700  # 1,400 bytes
    rows = [(i, f"http://h{i % 7}.example.com/p/{i}?q=1", f"<p>{i}</p>" * 50) for i in range(60)]
    rows += [(100, "http://a.b/x", big), (101, "http://a.b/x", big), (102, None, big), (103, "", "short"), (104, "not a url", "short"),
             (105, "http://a.b/\r\nX: y", None), (106, "http://a.b/x", "y" * 2_000_000), (None, "http://a.b/n", "n"),
             (107, "HTTP://A.B:80/x", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", df_id()).repartition(3)
    folder = new_folder(spark, "test-warc")
    captures = write_archives(df, folder)
    return rows, folder, captures, write_index(captures, folder, 4)


def df_id():
    from pyspark.sql import functions as F
    return F.col("page_id")


def test_every_record_comes_back(spark, archive):
    rows, folder, captures, shards = archive
    urls = spark.createDataFrame([(u,) for _, u, _ in rows], "url string")
    got = {r["id"]: r for r in read_records(lookup_urls(urls, shards, folder), folder).collect()}
    assert len(got) == len(rows)
    for page, url, body in rows:
        r, body = got[-1 if page is None else page], (body or "").encode()
        assert r["size"] == len(body) and r["digest"] == hashlib.sha1(body).hexdigest()
        revisit = page in (100, 101)
        assert (r["type"], r["refers_to"]) == (("revisit", 102) if revisit else ("response", None))
        assert r["payload"] is None if revisit else bytes(r["payload"]) == body


def test_lookup_finds_all_captures_of_a_key_and_nothing_else(spark, archive, monkeypatch):
    rows, folder, captures, shards = archive
    order = [(r["first_key"], r["file"]) for r in shards.orderBy("first_key", "first_id").collect()]
    reader = IndexReader(folder, order)
    lines = sorted((r["key"], r["id"]) for r in captures.collect())
    assert sum(r["lines"] for r in shards.collect()) == len(rows)
    for key in {k for k, _ in lines}:
        assert [(x[0], x[1]) for x in reader.lookup(key)] == [x for x in lines if x[0] == key]
    assert list(reader.lookup("zzz")) == [] and list(reader.lookup("a,b)/nothing")) == []


def test_keys_records_and_empty_archives(spark):
    assert url_key("https://www.Example.com/A?b#c") == "com,example,www)/a?b" and url_key(None) == ""
    raw = gzip.decompress(gzip.compress(warc_record("response", 3, "u", b"a\r\n\r\nb", "d", 6, None)))
    headers, payload = parse_record(raw)
    assert payload == b"a\r\n\r\nb" and headers["warc-type"] == "response"
    none = spark.createDataFrame([], "page_id long, url string, html string")
    folder = new_folder(spark, "test-empty")
    shards = write_index(write_archives(none, folder), folder)
    assert lookup_urls(none, shards, folder).count() == 0
