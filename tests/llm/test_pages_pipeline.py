"""WARC, HTML extraction, the registered SQL, and the pipeline by stages."""

import base64
import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from cohortwise.llm import exact_dedup, html_text, mixing, near_dedup, quality_rules, registry, warc
from tools.check import TABLES, _hash, _rows

SF = "/root/testdata/sf0.001"


def test_warc_transactions(spark, tmp_dir):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nx"
    rows = [(1, "u", tricky), (2, "u", tricky), (2, "u", tricky), (3, None, None), (4, "x\ny", ""), (None, None, "q" * 300_000), (5, "ü", "é漢")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("url", "url")
    warc.write_archives(pages, f"{tmp_dir}/a", records_per_file=4)
    found = warc.captures(warc.read_records(spark, f"{tmp_dir}/a")).collect()
    assert len(found) == len(rows) and all(r.request and r.response and r.metadata for r in found)
    by = {}
    for r in found:
        by.setdefault(bytes(r.metadata.payload).decode(), []).append(r.response)
    assert sorted(x.record_type for x in by["page-id: 2\r\n"]) == ["response", "revisit"]
    answer = next(x for x in by["page-id: 2\r\n"] if x.record_type == "response")
    assert bytes(answer.payload).decode() == tricky and by["page-id: 1\r\n"][0].refers_to == answer.record_id
    assert answer.payload_digest == base64.b32encode(hashlib.sha1(tricky.encode()).digest()).decode()
    assert by["page-id: 4\r\n"][0].record_type == "response" and by["page-id: 3\r\n"][0].refers_to == by["page-id: 4\r\n"][0].record_id
    assert by["page-id: 4\r\n"][0].target_uri == "x%0Ay" and by["page-id: 3\r\n"][0].target_uri is None
    assert len(by["page-id: \r\n"][0].payload) == 300_000
    assert sum(len(fs) for _, _, fs in os.walk(f"{tmp_dir}/a")) > 4  # files are bounded


def test_warc_small_payloads_are_never_revisits(spark, tmp_dir):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_dir}/b", revisit_from=3)
    got = sorted(r.response.record_type for r in warc.captures(warc.read_records(spark, f"{tmp_dir}/b")).collect())
    assert got == ["response"] * 3 + ["revisit"]
    warc.write_archives(pages.limit(0), f"{tmp_dir}/c")
    assert warc.captures(warc.read_records(spark, f"{tmp_dir}/c")).count() == 0


PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1><ul><li><a href=x>Home</a></ul></header><div id="wrap">
<div class="cookie-notice">We use cookies, many, of them, all, the time.</div>
<div class="post"><h2>Title &amp; more</h2><p>First para, with <b>text</b> and <a href=q>a link</a> in it.</p><div class="ad">Buy, buy, now</div>
<p>Second<br>para</p><ul><li>one</li><li>two, with text<li>three</ul><blockquote>Quote &lt;b&gt;</blockquote></div>
<div class="post"><p>Third para is here, long enough, to count as, content.</p></div>
<div id="comments"><p>Great post, really great, I liked it, so much, indeed, very much so.</p></div></div>
<aside><p>side, bar</p></aside><form><p>form text</p></form><script>if (a < b) document.write("<p>x</p>")</script><footer>foot</footer></body></html>"""


def test_html_article():
    assert html_text.main_text(PAGE).split("\n") == [
        "Title & more", "First para, with text and a link in it.", "Second para", "one", "two, with text", "three", "Quote <b>",
        "Third para is here, long enough, to count as, content."]


def test_html_wrappers_with_boilerplate_names():
    text = "".join(f"<p>Sentence {i} of the text, which is long enough, to count.</p>" for i in range(4))
    want = [f"Sentence {i} of the text, which is long enough, to count." for i in range(4)]
    around = '<div class="sidebar"><p>Side, text.</p></div>'
    comment = '<div class="comments"><article><p>Great, so great, really.</p></article></div>'
    for name in ('class="layout with-sidebar"', 'id="page" class="header-fixed"', 'class="legal content"'):
        for page in (f"<div {name}><article>{text}</article>{comment}{around}</div>", f"{comment}<div {name}><article>{text}</article></div>",
                     f"<div {name}>{around}<div>{text}</div></div>", f"{around}<div {name}>{text}</div>"):
            assert html_text.main_text(f"<body>{page}</body>").split("\n") == want, page


def test_html_short_sections_and_lists_stay():
    text = "".join(f"<p>Sentence {i} of the text, which is long enough, to count, and more.</p>" for i in range(9))
    page = f"<body><section>{text}</section><section><p>Short end.</p></section><ul><li>one</li><li>two</li></ul><div class=ad>Buy</div></body>"
    assert html_text.main_text(page).split("\n")[9:] == ["Short end.", "one", "two"]


def test_html_references_of_the_article_stay():
    """A list of links is a menu outside the article and its references inside it."""
    links = "".join(f"<li><a href=/{k}>Reference {k}</a></li>" for k in range(4))
    text = "".join(f"<p>{'Some words, and more of them, in a sentence. ' * 6}</p>" for _ in range(3))
    page = f"<body><ul>{links.replace('Reference', 'Menu')}</ul><article>{text}<ol>{links}</ol></article><ul>{links.replace('Reference', 'More')}</ul></body>"
    got = html_text.main_text(page).split("\n")
    assert got[-4:] == [f"Reference {k}" for k in range(4)] and len(got) == 7


def test_warc_headers_in_latin_1(spark, tmp_dir):
    import gzip

    from cohortwise.llm import warc

    def record(kind, number, block, extra=b"", content=b"application/http; msgtype=response"):
        return (b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <urn:x:" + number + b">\r\nWARC-Target-URI: http://ex\xe4mple/" + extra
                + b"\r\nContent-Type: " + content + b"\r\nContent-Length: " + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    block = b"HTTP/1.1 200 OK\r\nServer: caf\xe9\r\n\r\n<p>body \xc3\xa9</p>"
    with open(f"{tmp_dir}/one.warc.gz", "wb") as f:
        f.write(gzip.compress(record(b"response", b"1", block)))
    (row,) = warc.read_records(spark, tmp_dir).collect()
    assert row.target_uri == "http://ex\xe4mple/" and row.http_header.endswith("Server: caf\xe9") and bytes(row.payload) == b"<p>body \xc3\xa9</p>"


def test_html_corpus_articles(spark):
    """The corpus marks its articles: what is read equals the marked part."""
    import html as entities
    import re

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        part = r.html.split("<article>")[1].split("</article>")[0]
        part = re.sub(r"<[a-zA-Z/][^>]*\Z", "", part)
        cells = re.split(r"</?(?:p|h1)>", part)
        want = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x)))).strip() for x in cells]
        assert html_text.main_text(r.html) == "\n".join(x for x in want if x), r.page_id


def test_html_edges(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "just text"), (None, "u", "<p>a</p>"), (4, "u", "<div>" * 5000 + "deep"), (4, "u", "<p>x"),
            (5, "u", "<p>" + "word, " * 50_000), (6, "u", "<!-- open"), (7, "u", "<p title=\"a>b\">q</p>"), (8, "u", "a &nbsp;&am &#65;")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = {(r.page_id, r.text[:20]): r.n_chars for r in html_text.extract(df).collect()}
    assert set(got) >= {(1, ""), (2, ""), (3, "just text"), (None, "a"), (4, "deep"), (4, "x"), (6, ""), (7, "q"), (8, "a &am A")}
    assert got[(5, ("word, " * 4)[:20])] == 6 * 50_000 - 1 and html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    mine = [tuple(r) for r in df.collect()]
    cur = con.execute(registry.ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert _hash(_rows(df.columns, mine)) == _hash(_rows(cols, cur.fetchall()))


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in registry.QUERIES}
    assert set(registry.QUERIES) | {"pipeline"} <= set(E.queries())


def test_pipeline_by_stages(spark):
    """Each stage keeps exactly the rows its operator's verdict keeps."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    verdicts = [
        lambda d: quality_rules.rules(d, spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")).where("quality.kept"),
        lambda d: exact_dedup.groups(d).where("kept"), lambda d: near_dedup.classes(d).where("kept"),
        lambda d: mixing.sampled(d).where("mix.kept")]
    for (_, stage), verdict in zip(corpus_pipeline.STAGES, verdicts):
        after = stage(spark, docs, SF).cache()
        assert after.columns == docs.columns
        kept = [r.doc_id for r in after.select("doc_id").collect()]
        assert sorted(kept) == sorted(r.doc_id for r in verdict(docs).select("doc_id").collect()) and set(kept) <= ids
        docs, ids = after, set(kept)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in out} == ids
    assert all(r.decoded_sha256 == hashlib.sha256((text[r.doc_id] or "").encode()).hexdigest() and r.n_tokens == len(r.ids) for r in out)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == ids
