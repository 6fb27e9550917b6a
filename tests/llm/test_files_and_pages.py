"""WARC round trips, k-d shards, HTML extraction and licence digests on small tables with odd rows."""

import hashlib
import random
import re
import textwrap
import time
import zlib
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from relaylens.llm import htmltext, kdtree, licences, warc
from relaylens.llm.common import shared_folder

PAGES = "page_id long, url string, html string"


def pages(spark):
    rows = [
        (1, "http://a/x", "é" * 600), (2, "http://a/y", "é" * 600), (3, None, None), (4, "u\r\nv", "p\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nq\r\n\r\nWARC/1.1\r\n\r\nWARC/1.1\r\n"),
        (5, "http://b", "z" * 999), (6, "http://b", "z" * 999), (None, "n", "x"), (2, "http://a/y", "é" * 600), (7, "http://c/", "t\r\n"), (8, "http://d", "WARC/1.1\r\nx"), (9, "", ""), (10, "http://e", "é" * 600),
    ]
    return rows, spark.createDataFrame(rows, PAGES)


def test_records_come_back_whole(spark):
    rows, df = pages(spark)
    path = shared_folder(spark)
    warc.write_warc(warc.plan_captures(df), path)
    records = warc.read_warc(spark, path)
    got = records.where("type = 'response'").collect()
    assert sorted(bytes(r.payload) for r in got) == sorted((h or "").encode() for i, _, h in rows if i not in (1, 2))
    assert records.select("record_id").distinct().count() == records.count() == 3 * len(rows)
    assert all(hashlib.sha1(bytes(r.payload)).hexdigest() == r.digest for r in got)
    assert records.where("type = 'revisit'").count() == 3  # page 1 and both rows of page 2 refer to page 10
    captures = warc.assemble(records.drop("payload", "http"))
    assert captures.count() == len(rows) and captures.where("size(requests) <> 1 or size(metadata) <> 1 or response is null").count() == 0


def expected_captures(rows):
    """What SQL says: of equal payloads of 1000 bytes or more the one of largest page_id is the response."""
    payloads = [(h or "").encode() for _, _, h in rows]
    last = {}
    for (i, _, _), p in zip(rows, payloads):
        if len(p) >= warc.REVISIT_BYTES and i is not None:
            last[p] = max(last.get(p, i), i)
    out = []
    for (i, _, _), p in zip(rows, payloads):
        to = last.get(p) if i is not None and last.get(p) != i else None
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("case", ["odd rows", "ids that differ in html", "repeats", "empty"])
def test_every_page_is_a_capture(spark, tmp_path, case):
    a, b = "A" * 1500, "B" * 1500
    rows = {"odd rows": pages(spark)[0], "ids that differ in html": [(1, "u", a), (1, "u", b), (2, "u", b)], "repeats": [(1, "u", a), (2, None, a), (2, None, a), (2, "w", a), (1, "u", a), (None, None, None), (None, None, None)], "empty": []}[case]
    spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], PAGES + ", refers_to string").write.parquet(f"{tmp_path}/pages.parquet")
    got = warc.op1_warc_transactions(spark, str(tmp_path)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected_captures(rows)


def test_a_long_http_head(spark, tmp_path):
    """Of a foreign archive: cookies of 9000 bytes go before the payload."""
    block = "HTTP/1.1 200 OK\r\nSet-Cookie: " + "c" * 9000 + "\r\n\r\né payload"
    record = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(block.encode())}\r\n\r\n{block}\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(record.encode())
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert [bytes(r.payload).decode() for r in got] == ["é payload"] and len(got[0].http) > 9000


def test_many_records_cross_buffers(spark):
    df = spark.range(4000).select(F.col("id").alias("page_id"), F.lit("http://a/").alias("url"), F.concat(F.lit("p"), "id", F.repeat(F.lit("x\r\n"), F.col("id").cast("int") % 97)).alias("html"))
    path = shared_folder(spark)
    warc.write_warc(warc.plan_captures(df.coalesce(1)), path)
    assert warc.read_warc(spark, path).count() == 12_000


def test_ties_between_records(spark):
    schema = "record_id string, type string, uri string, concurrent_to array<string>"
    rows = [
        ("r1", "response", "u", ["q1"]), ("q1", "request", "u", []), ("m1", "metadata", "u", ["q1"]),  # the response names the request, the metadata the request
        ("r2", "revisit", "v", []), ("q2", "request", "v", ["r2"]), ("q2", "request", "v", ["r2"]), ("lost", "request", "w", ["gone"]), (None, "metadata", None, None),
    ]
    got = {r.capture_id: r for r in warc.assemble(spark.createDataFrame(rows, schema)).collect()}
    assert [x.record_id for x in got["r1"].requests] == ["q1"] and [x.record_id for x in got["r1"].metadata] == ["m1"]
    assert len(got["r2"].requests) == 1 and got["lost"].response is None and len(got) == 4
    assert warc.assemble(spark.createDataFrame([], schema)).count() == 0


def test_shards_are_even_though_one_source_holds_most(spark):
    rng = random.Random(2)
    rows = [(i, "t" * rng.randrange(1, 400), "en" if i % 3 else None, "hot" if i % 2 else f"s{i % 5}") for i in range(900)] + [(5000, None, "de", None), (5001, "", None, "x"), (None, "n", "en", "hot")]
    meta = kdtree.document_metadata(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    total = meta.agg(F.sum("size")).first()[0]
    out = kdtree.with_slots(kdtree.kd_shards(meta, ["log_size", "lang_code", "source_code"], "size", "doc_id", -(-total // 6)), "shard", ["doc_id"]).collect()
    assert len(out) == len(rows) and {r.shard for r in out} == set(range(6))
    for s in range(6):
        mine = [r for r in out if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / 6) <= 1200


def test_the_query_divides_repeated_rows(spark, tmp_path):
    """500 equal rows and 500 others with clashing columns: sizes stay near equal, slots have no gap, each row is there."""
    rows = [(7, "same text", "en", "s", 3, 4, "x")] * 500 + [(100 + i, f"other {i % 90:03}", "en", "s", 3, 4, "x") for i in range(500)] + [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, 0, "y")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int, row int, `__key` string").write.parquet(f"{tmp_path}/documents.parquet")
    out = kdtree.op2_kd_shards(spark, str(tmp_path)).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in out) == want
    total = sum(w[1] for w in want)
    for s in range(8):
        mine = [r for r in out if r.shard == s]
        assert abs(sum(r.size for r in mine) - total / 8) <= 20 and sorted(r.slot for r in mine) == list(range(len(mine)))


def test_shards_of_small_tables(spark):
    schema = "doc_id long, text string, lang string, source string"
    for rows in ([], [(1, "a", None, None)], [(1, "a", "en", "s")] * 3):
        meta = kdtree.document_metadata(spark.createDataFrame(rows, schema))
        out = kdtree.kd_shards(meta, ["log_size", "lang_code"], "size", "doc_id", 1)
        assert out.count() == len(rows)


PAGE = "<html><body><nav><a href='/'>Home</a></nav><div class='wrap{n}'><div class='story-{n}'><h1>T &amp; {n}</h1><p>One <b>bold</b>\n line {n}.<p>Two<br>more</div><aside>side</aside></div><div id='comments'><p>Comment {n} that is very very long and would win by its length alone, if it weren't one</p></div><footer>f</footer></body></html>"


def test_consensus_of_a_host(spark):
    rows = [(n, f"http://H.example/{n}", PAGE.replace("{n}", str(n))) for n in range(6)]
    odd = "<body><div class='wrap9'><div class='story-9'><p>ok</div><div class='other'><p>longer text that a single page would choose by itself</div></div></body>"
    rows += [(50, "http://h.example/odd", odd), (51, None, "<p>loose <i>text</i>"), (52, "http://e/", None), (53, "http://e/", ""), (54, "http://e/", "<div" * 3), (55, "x", "<p>" + "long " * 50_000)]
    got = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(rows, PAGES), ["page_id"]).collect()}
    for n in range(6):
        assert got[n] == f"T & {n}\nOne bold line {n}.\nTwo more"
    assert got[50] == "ok" and got[51] == "loose text" and got[52] == got[53] == "" and len(got[55].split()) == 50_000
    assert htmltext.main_text(spark.createDataFrame([], PAGES), ["page_id", "url"]).count() == 0


@pytest.mark.parametrize("page, text", [
    ("<article><header><h1>A</h1></header><p>b<script>var x = '</p>';</script>c</p><!-- <p>no --></article>", "A\nbc"),
    ("<body><header>top</header><main><ul><li>x<li>y</ul><form>f<input></form></main></body>", "x\ny"),
    ("<div class='post ad-slot'>ad</div><div class='post'>t&eacute;xt &lt;b&gt;&nbsp; z</div>", "téxt <b> z"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("no markup at all", "no markup at all"), ("<style>a{}", ""), ("<p hidden>h</p>s", "s"),
])
def test_blocks(page, text):
    assert "\n".join(t for t in (b.text() for b in htmltext.blocks_of(page)[0]) if t) == text


@pytest.mark.parametrize("raw", [
    "<script>for(i=0;i<n;i++)go(i)</script>", "<script>a = '<!--'</script>", "<script>// don't\nif(a<b){}</SCRIPT >", '<script>s="<b";t=\'</p>\'</script>', "<style>/* it's <a */</style>", "<textarea>x<y <!-- </textarea>", "<title>a<b</title>",
    "<script><!-- document.write('<script>no</script>no') --></script>", "<script><!--><script></script>",
])
def test_raw_elements_end_at_their_own_end_tag(raw):
    page = f"<body><article><p>one{raw} two<p>three</article></body>"
    assert [b.text() for b in htmltext.blocks_of(page)[0]] == ["one two", "three"]
    assert htmltext.extract(page, ">body>article") == "one two\nthree"


def test_a_raw_element_without_end_takes_the_rest():
    assert htmltext.extract("<p>a<script>i<n</scripts> no", None) == "a"


BODY = "<div class='body'><p>" + "long text " * 30 + "</p><p>end</p></div>"
LONG = "long text " * 29 + "long text\nend"


@pytest.mark.parametrize("page, path, text", [
    ("<body><article class='p[>]1'><h1>T</h1><p>lead</p>" + BODY + "<p>after</p></article><div>frame</div></body>", ">body>article.p[#]#", f"T\nlead\n{LONG}\nafter"),
    ("<body><main><div><h1>T</h1><p>lead</p></div><section><div>" + BODY + "</div></section></main></body>", ">body>main", f"T\nlead\n{LONG}"),
    ("<main><p>outside</p><article>" + BODY + "<p>in</p></article></main>", ">main>article", f"{LONG}\nin"),
    ("<body><div class='top'>Site</div><div class='post'><h1>T</h1><p>lead</p><div class='in'>" + BODY + "</div></div></body>", ">body>div.post", f"T\nlead\n{LONG}"),
    ("<body><div class='post'><ul><li><a href='/'>Home</a></ul>" + BODY + "</div></body>", ">body>div.post>div.body", LONG),
])
def test_a_nested_container_stands_for_its_article(page, path, text):
    assert htmltext.best_path(*htmltext.blocks_of(page))[0] == path
    assert htmltext.extract(page, path) == htmltext.extract(page, None) == text


def test_the_host_keeps_titles_and_leads(spark):
    rows = [(n, "http://h/", f"<body><article><h1>T{n}</h1><p>lead</p>{BODY}</article></body>") for n in range(4)]
    rows += [(9, "http://h/", "<body><article><h1>T9</h1><p>short, all in the article</p></article></body>")]
    got = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(rows, PAGES), ["page_id"]).collect()}
    assert got == {**{n: f"T{n}\nlead\n{LONG}" for n in range(4)}, 9: "T9\nshort, all in the article"}


@pytest.mark.parametrize("wrapper", ["class='layout no-sidebar'", "class='content has-toc'", "class='page with-comments'", "id='search-engines'", "id='binary-search'", "class=content-sidebar-wrap", "class='sidebar'", "role='search' id=toc", "class='x related'"])
@pytest.mark.parametrize("tag", ["div", "section"])
def test_a_word_in_a_name_hides_no_article(wrapper, tag):
    for inner in ("<h1>T</h1><p>text</p>", "<article><h1>T</h1><p>text</p></article>", "<main><h1>T</h1><p>text</p></main>"):
        page = f"<body><nav>n</nav><{tag} {wrapper}>{inner}</{tag}></body>"
        assert htmltext.extract(page, None) == "T\ntext" and htmltext.best_path(*htmltext.blocks_of(page))


@pytest.mark.parametrize("name", ["sidebar", "ad-slot", "ad_300x250", "site-footer", "comment-list", "post comments", "x related-posts", "widget_text", "main-nav", "fb-comments", "site-header"])
def test_marked_boxes_stay_hidden(name):
    page = f"<body><div class=post><p>The text of the page.</p><div class='{name}'>Some box</div></div><div id='{name.split()[-1]}'>box</div></body>"
    assert htmltext.extract(page, None) == "The text of the page."


@pytest.mark.parametrize("name", "content-ad article-ad inline-ad story-ad native-ad user-comments reader-comments related-articles share-tools breadcrumb-trail mega-menu cookie-policy-banner page-sidebar sidebar-first content-sidebar social-icons paywall-message".split())
@pytest.mark.parametrize("box", ["<div class='{}'>Some box</div>", "<section class='x {}'><p>Some box</p></section>"])
def test_boxes_in_an_article_are_hidden_by_what_their_name_names(name, box):
    page = f"<body><article><h1>T</h1><p>The text of the page.</p>{box.format(name)}<p>More of it.</p></article></body>"
    assert htmltext.extract(page, None) == "T\nThe text of the page.\nMore of it."


@pytest.mark.parametrize("style", ["display:none", "color:red; DISPLAY : none !important", "visibility: hidden;"])
def test_hidden_styles(style):
    assert htmltext.extract(f"<article><p>Text</p><div style='{style}'>no</div><p style='display:block; max-width:none'>and more</p></article>", None) == "Text\nand more"


def test_a_teaser_is_no_article_of_the_page():
    teaser = "<article class='teaser'><p>" + "another page " * 30 + "</p></article>"
    assert htmltext.extract(f"<body><main><p>short</p></main>{teaser}</body>", None) == "short"
    assert htmltext.extract(f"<body><article><p>short</p></article>{teaser}</body>", None) == "short"


def test_titles_and_leads_in_containers_of_their_own(spark):
    page = lambda n: f"<body><div class='top'>The Daily Site</div><div class='page'><div class='slogan'>News for all</div><div class='title'><h1>Title {n}</h1></div><div class='lead'><p>Lead {n}</p></div>{BODY}<div class='later'><p>Later {n}</p></div></div></body>"
    rows = [(n, "http://h/", page(n)) for n in range(6)] + [(9, "http://other/", page(9))]
    got = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(rows, PAGES), ["page_id"]).collect()}
    assert got == {**{n: f"Title {n}\nLead {n}\n{LONG}" for n in range(6)}, 9: LONG}  # a single page gives no evidence


def test_articles_of_comments_and_wrappers():
    comments = "<div id='comments'><article class='comment-body'>" + "a long comment " * 20 + "</article></div>"
    assert htmltext.extract("<body><div class='sidebar'><div class=post><h1>T</h1><p>the text</p></div></div><div class='reply'>r</div></body>", None) == "T\nthe text"
    assert htmltext.extract(f"<body><article><p>short</p></article>{comments}</body>", None) == "short"
    assert htmltext.extract(f"<body><main><section><p>short</p></section>{comments}</main></body>", None) == "short"
    assert htmltext.extract(f"<body><div class='widget'><article><p>short</p></article></div>{comments}</body>", None) == "short"


def test_licence_digests(spark):
    mit = dict(reversed(licences.KNOWN))["MIT"]
    full = max((t for n, t in licences.KNOWN if n == "MIT"), key=len)
    rows = [(1, full), (2, "Copyright (c) 2020 Someone\n" + full.upper().replace(",", " ,\n")), (3, full.replace("sublicense", "sub-license").replace("COPYRIGHT HOLDERS", "copyright owners")), (4, full + " more"), (5, None), (6, ""), (7, mit.replace("License", "Licence"))]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), licences.known_licences(spark), ["doc_id"]).collect()}
    assert [got[i].license_id for i in range(1, 8)] == ["MIT", "MIT", "MIT", None, None, None, "MIT"]
    assert got[5].digest is None and got[6].digest == hashlib.sha256(b"").hexdigest()


ISC_FILE = """ISC License

Copyright (c) 2004-2010 by Internet Systems Consortium, Inc. ("ISC")
Copyright 1995-2003 by Internet Software Consortium

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""


def test_standard_licence_files(spark):
    whole = {p.stem: p.read_text("utf-8") for p in (Path(licences.__file__).parent / "licence_texts").glob("*.txt")}
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "Unlicense"} <= set(whole)
    mit = max((t for n, t in licences.KNOWN if n == "MIT"), key=len)
    want = [("ISC", ISC_FILE), ("MIT", "The MIT License (MIT)\n\nCopyright © 2020 A. Body\nCopyright Some Body <a@b>\n\n" + textwrap.fill(mit, 78) + "\n"), ("MIT", "MIT License\r\n\r\nCopyright (c) 2020 A\r\n" + textwrap.fill(mit, 60).replace("\n", "\r\n"))]
    want += [("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n\n" + whole["BSD-3-Clause"])]
    want += [("Apache-2.0", whole["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 A. Body")), ("Apache-2.0", whole["Apache-2.0"].partition("   APPENDIX")[0])]
    want += [(i, " ".join(t.split()) if "opyright (" not in t and "opyright [" not in t and "(c)" not in t else t) for i, t in whole.items()]
    want += [(None, ISC_FILE.replace("copyright notice and this", "copyright and this")), (None, whole["Apache-2.0"].replace("      (c) You must retain", "      (c) You need not retain"))]
    got = licences.scan(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(want)], "doc_id long, text string"), licences.known_licences(spark), ["doc_id"])
    assert [r.license_id for r in got.orderBy("doc_id").collect()] == [i for i, _ in want]


def licence_documents():
    """Whole licences with titles, statements of ownership and edits, notices among other lines, odd rows."""
    whole = licences.known_texts()
    notice = [t for _, t in licences.KNOWN if "\n" not in t]
    rows = [(k, t) for k, (_, t) in enumerate(whole)]
    rows += [(100 + k, f"Copyright (c) 2020 A. Body\nCopyright notice\nCopyright Some Body <a@b>\n{t.upper()}") for k, (_, t) in enumerate(whole)]
    rows += [(200 + k, f"Some prose.\n{a}\nMore prose\n{b.replace('icense', 'icence')}\n{a}") for k, (a, b) in enumerate(zip(notice, notice[1:], strict=False))]
    rows += [(300, "\n".join(notice)), (301, notice[0] + " more"), (302, ""), (303, None), (None, notice[0]), (None, None), (304, "w " * 100_000 + "\n" + notice[0])]
    return rows + rows[:3] + [(304, notice[2])]


def test_licence_query_equals_its_sql(spark, tmp_path):
    """Rows of equal and of null ids, columns that clash with new ones, and the table without rows."""
    schema = "doc_id long, text string, digest string, row string, license_id long"
    key = lambda r: tuple((v is not None, v) for v in r)
    for part in (licence_documents(), []):
        folder = tmp_path / str(len(part))
        spark.createDataFrame([(*r, "d", None, 1) for r in part], schema).write.parquet(str(folder / "documents.parquet"))
        got = licences.op10_licence_digest(spark, str(folder))
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
        want = con.execute(licences.ORACLE_SQL["op10_licence_digest"]).fetchall()
        assert got.columns == [c[0] for c in con.description]
        assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key) and len(want) == len(part)
        if part:
            assert {"GPL-3.0-only", "Apache-2.0", "MPL-2.0", "MIT", None} <= {r[2] for r in want}
            assert {"Apache-2.0,CC-BY-NC-4.0", "CC-BY-4.0,GPL-3.0-only"} <= {r[3] for r in want}


def test_licence_lines_by_brute_force(spark):
    """A caller's own table, whose lines the cheap condition of the query doesn't hold for."""
    known = [("A", "All yours."), ("B", "Use with care"), ("B", "use, with CARE!"), ("C", "x")]
    texts = ["ALL YOURS\nnothing\nuse with care", "all yours and more", "X\nx\n x.", None, "", "\n\n", "use with\ncare"]
    df = spark.createDataFrame([(k % 3, t, "n") for k, t in enumerate(texts * 2)], "doc_id long, text string, notice_ids string")
    plain = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    names = {plain(t): i for i, t in known}
    want = [(k % 3, names.get(plain(t)) if t is not None else None, ",".join(sorted({names[p] for p in map(plain, (t or "").split("\n")) if p in names}))) for k, t in enumerate(texts * 2)]
    got = licences.scan_lines(df, licences.known_licences(spark, known), ["doc_id", "notice_ids"])
    assert sorted(((r.doc_id, r.license_id, r.notice_ids) for r in got.collect()), key=str) == sorted(want, key=str)
    assert all(t is None or re.search(licences._NOTICE, t.lower()) for _, t in licences.KNOWN)


def test_only_statements_of_ownership_are_copyright_lines(spark):
    stated = ["Copyright (c) 2020 A", "  copyright 2020", "Copyright © A", "© A", "(C) 2020 A", "Portions Copyright The A Authors", "Copyright by A. All rights reserved.", "Copyright: A", "All rights reserved."]
    said = ["copyright notice and this permission notice", "COPYRIGHT HOLDERS BE LIABLE", "copyright owner or", "(c) You must retain", "copyright", "copyright, patent", "copyright law"]
    got = [r.c for r in spark.createDataFrame([(t,) for t in stated + said], "t string").select(licences.canonical(F.col("t")).alias("c")).collect()]
    assert got[: len(stated)] == [""] * len(stated) and all(got[len(stated) :])


@pytest.mark.parametrize(
    "html,text",
    [
        ("<p class=don't>Hello</p>", "Hello"),
        ("<p class=\"a\"b'c>Hello</p>", "Hello"),
        ("<p 'x>Hello</p><p>it's</p>", "Hello\nit's"),
        ("<p title='a > b'>Hello</p>", "Hello"),
        ("<p title=\"a > b>Hello</p>", "b>Hello"),  # never closed: the tag ends at its first >
        ("<p title=\"class=ad\">Hello</p>", "Hello"),
        ("<p>a < b <3 <</p>", "a < b <3 <"),
        ("<p>Hello<!-- <p>no</p> -->!</p><!--> <p>yes</p><!-- open", "Hello!\nyes"),
        ("<!DOCTYPE html><?x y?></><p>Hello</p>", "Hello"),
        ("<p>Hello</p><p", "Hello\n<p"),
        ("<div class='article social-science'><p>Study of share prices</p></div><div><p>x</p></div>", "Study of share prices"),
    ],
)
def test_tags_by_the_rules_of_html(html, text):
    assert htmltext.extract(html, None) == text


@pytest.mark.parametrize("page", ["<a href=\"x>", "<a x='>' ", "<a ", "<div>", "<b><li>", "<!", "<p x=\"'>a ", "</div", "<div class=a>x"])
def test_odd_pages_take_linear_time(page):
    began = time.perf_counter()
    htmltext.extract(page * 50_000 + "<p>end</p>", None)
    assert time.perf_counter() - began < 8  # in seconds; by the square of the tags it would be minutes


def brute_votes(rows):
    """Winning path of each host by plain counting."""
    votes = {}
    for _, url, html in rows:
        host = (url or "").split("/")[2] if "//" in (url or "") else ""
        if html and (best := htmltext.best_path(*htmltext.blocks_of(html))):
            v = votes.setdefault(host, {}).setdefault(best[0], [0, 0.0])
            v[0] += 1
            v[1] += best[1]
    return {h: max(v, key=lambda p: (v[p][0], round(v[p][1], 3), p)) for h, v in votes.items()}


def test_query_equals_votes_counted_plainly(spark, tmp_path):
    rng = random.Random(6)
    kinds = ["<body><nav><a>m</a></nav><div class='c{n}'><p>{t}</p><p>{u}</p></div></body>", "<body><main><h1>{u}</h1><section><p>{t}</p></section></main><footer>f</footer></body>", "<body><p>{u}</p></body>"]
    page = lambda n: rng.choice(kinds).format(n=n, t="t " * rng.randrange(1, 80), u="u " * rng.randrange(1, 9))
    rows = [(i, f"http://h{i % 4}.x/{i}" if i % 9 else None, page(i) if i % 11 else None) for i in range(160)] + [(3, "http://h0.x/again", page(3))]
    spark.createDataFrame([(*r, "k") for r in rows], PAGES + ", text string").write.parquet(f"{tmp_path}/pages.parquet")
    paths = brute_votes(rows)
    host = lambda u: (u or "").split("/")[2] if "//" in (u or "") else ""
    expected = sorted((i, u or "", htmltext.extract(h, paths.get(host(u))) if h else "") for i, u, h in rows)
    got = htmltext.op4_html_consensus(spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.url or "", r.text) for r in got) == expected
    assert all(r.n_chars == len(r.text) for r in got)
