"""Web archives and main text."""

import collections
import hashlib
import io
import random
import struct
import time
import zipfile

import numpy as np
import pytest

from feedloom.llm import html_text, warc_zip
from feedloom.llm.queries import QUERIES
from feedloom.session import scratch
from tests.llm.helpers import SF

PAGES = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES).repartition(3).selectExpr("*", "'x' as payload", "'y' as digest", "'z' as text", "'q' as revisit")


ODD = [
    (1, "http://a/1", "x" * 999),
    (2, "http://a/2", "x" * 999),
    (3, "http://a/3", "y" * 1000),
    (4, "http://a/4?q=%20é \r\nX: y", "y" * 1000),
    (9, None, "y" * 1000),
    (5, "", None),
    (6, None, ""),
    (None, "u", "y" * 1000),
    (None, "u", "é" * 700),
    (None, "v", "é" * 700),
    (7, "w", "WARC/1.0\r\n\r\nContent-Length: 3\r\n\r\nabc" * 60),
    (7, "w", "WARC/1.0\r\n\r\nContent-Length: 3\r\n\r\nabc" * 60),
    (8, "long", "<p>text</p>" * 300_000),
]


def expected(rows):
    largest = collections.defaultdict(list)
    for page, _, html in rows:
        largest[html or ""].append(page)
    out = collections.Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        known = [p for p in largest[html or ""] if p is not None]
        first = max(known) if known else None
        revisit = len(data) >= 1000 and first is not None and page != first
        out[(page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None)] += 1
    return out


@pytest.mark.parametrize(("archive_bytes", "range_bytes"), [(32 << 20, 4 << 20), (300, 100)])
def test_round_trip(spark, archive_bytes, range_bytes):
    archives = warc_zip.write_archives(pages(spark, ODD), scratch(spark, "warc-test"), archive_bytes)
    rows = warc_zip.read_archives(archives, range_bytes=range_bytes).collect()
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)
    assert got == expected(ODD)
    assert collections.Counter((r.page_id, r.url) for r in rows) == collections.Counter(r[:2] for r in ODD)
    by_id = {r[0]: (r[2] or "").encode() for r in ODD}
    assert all(bytes(r.payload) == by_id[r.page_id] for r in rows if r.record_type == "response" and r.page_id is not None)


def test_round_trip_of_nothing(spark):
    assert warc_zip.round_trip(pages(spark, ODD).limit(0)).collect() == []


def test_query_on_the_sample(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert collections.Counter(tuple(r)[:5] for r in QUERIES["op1_warc_zip"](spark, SF).collect()) == expected(rows)


def test_directories():
    held = io.BytesIO(b"")
    with zipfile.ZipFile(held, "w") as archive:
        archive.writestr("a.warc", b"A" * 50)
        archive.writestr("dir/é.txt", b"B" * 20, zipfile.ZIP_DEFLATED)
        archive.comment = b"with PK\5\6 in its comment"
    for data in (held.getvalue(), b"something before" + held.getvalue()):
        file = io.BytesIO(data)
        found = list(warc_zip.members(file, len(data)))
        assert [(m.name, m.stored) for m in found] == [("a.warc", True), ("dir/é.txt", False)]
        start = warc_zip.data_start(file, found[0])
        assert data[start : start + found[0].size] == b"A" * 50
    with pytest.raises(ValueError):
        list(warc_zip.members(io.BytesIO(b"nothing" * 10), 70))


def test_zip64_directory():
    name, data = b"archive/data.warc.gz", b"D" * 33
    local = struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20)
    local += name + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    central = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF)
    central += name + extra
    wide = struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = struct.pack("<4sIQI", b"PK\6\7", 0, len(local) + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    whole = local + central + wide + locator + end
    [member] = warc_zip.members(io.BytesIO(whole), len(whole))
    assert (member.name, member.stored, member.size, member.header) == (name.decode(), True, 33, 0)
    start = warc_zip.data_start(io.BytesIO(whole), member)
    assert whole[start : start + 33] == data


def test_foreign_archives(spark, tmp_path):
    """Without an index, and not compressed record by record."""
    records = [warc_zip._record(i, "http://h/", b"p" * i, hashlib.sha1(b"p" * i).hexdigest(), None, False) for i in range(5)]
    plain = b"".join(__import__("gzip").decompress(r) for r in records)
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as archive:
        archive.writestr("archive/one.warc.gz", b"".join(records))
        archive.writestr("archive/two.warc", plain)
    path = str(tmp_path / "x.zip")
    archives = spark.createDataFrame([(path, (tmp_path / "x.zip").stat().st_size)], "path string, length long")
    assert sorted(r.page_id for r in warc_zip.read_archives(archives).collect()) == sorted([*range(5), *range(5)])
    broken = plain.replace(b"pppp", b"pppq")
    with pytest.raises(ValueError):
        list(warc_zip.records(iter([plain[:-30]]), False))
    assert broken != plain


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_records_over_any_chunks(chunk):
    payloads = [b"", b"p" * 10, b"\r\n\r\nWARC/1.1\r\n" * 5, b"q" * 300]
    made = [warc_zip._record(i, "http://h/", p, hashlib.sha1(p).hexdigest(), None, False) for i, p in enumerate(payloads)]
    for data, packed in ((b"".join(made), True), (b"".join(__import__("gzip").decompress(m) for m in made), False)):
        got = list(warc_zip.records((data[i : i + chunk] for i in range(0, len(data), chunk)), packed))
        assert [block.partition(b"\r\n\r\n")[2] for _, block in got] == payloads


def test_long_records_take_time_in_proportion():
    head = b"WARC/1.1\r\nContent-Length: %d\r\n\r\n"
    data = head % (64 << 20) + b"x" * (64 << 20) + b"\r\n\r\n"
    begun = time.process_time()
    [(_, block)] = warc_zip.records((data[i : i + (1 << 16)] for i in range(0, len(data), 1 << 16)), False)
    assert len(block) == 64 << 20 and time.process_time() - begun < 2


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class="main-page">
<header><h1>Site</h1><nav><a href="/">Home</a></nav></header><div id="cookie-notice"><p>We use cookies to make all of this much better for you.</p></div>
<div class="menu">one <a href=x>two</a></div>
<main><article><header><h1>A &lt;Title&gt; &amp; more</h1></header><p>First  <b>para</b>
with <a href="x">link</a>.<p>Second<br>line.<ul><li>one<li>two &#233;</ul><p class=ad>Buy now<p>Yes.<script>var x = "</p>";</script>
<aside>related things</aside><form><label>Name</label></form><blockquote>Quote</blockquote><!-- <p>hidden</p> --><p hidden>gone</p></article>
<section class="comments"><article class="comment"><p>What a very nice article this was to read, thank you all.</p></article></section></main>
<div class=sidebar><p>side</p></div><footer>foot &copy; 2020</footer></body></html>"""


def test_main_text(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "   "), (None, "u", "just some words"), (5, "u", "<p>unclosed <b>tag"), (5, "u", "<!-- open"), (6, "u", "<div " * 50)]
    got = collections.Counter((r.page_id, r.text) for r in html_text.extract(pages(spark, rows)).collect())
    article = "A <Title> & more\n\nFirst para with link.\n\nSecond line.\n\none\n\ntwo é\n\nYes.\n\nQuote"
    assert got[(1, article)] == 1
    assert got[(2, "")] == got[(3, "")] == got[(4, "")] == got[(None, "just some words")] == got[(5, "unclosed tag")] == got[(5, "")] == 1
    assert sum(got.values()) == len(rows)
    assert html_text.extract(pages(spark, rows).limit(0)).collect() == []
    long = html_text.extract(pages(spark, [(1, "u", "<article>" + "<p>a b</p>" * 100_000 + "</article>")])).first()
    assert long.n_chars == len(long.text) == 100_000 * 5 - 2


def test_main_text_without_marks():
    links = "".join(f'<li><a href="{i}">link number {i}</a></li>' for i in range(8))
    words = "many plain words that make up a long paragraph of running text in the middle of a page " * 3
    page = f"<body><ul>{links}</ul><div><p>{words}</p><p>A short one here.</p><p>{words}</p></div><ul>{links}</ul></body>"
    text = html_text.main_text(page, html_text.trained()).split("\n\n")
    assert text == [words.strip(), "A short one here.", words.strip()]


def test_tree_learns_its_table():
    table = np.array(html_text.LABELLED, float)
    assert (html_text.verdicts(html_text.trained(), table[:, :-1]) == table[:, -1].astype(bool)).all()


def test_articles_of_the_sample(spark):
    rows = {r.page_id: r for r in QUERIES["op10_html_text"](spark, SF).collect()}
    for page in spark.read.parquet(f"{SF}/pages.parquet").collect():
        text = rows[page.page_id].text
        assert text and "track(" not in text and "<" not in text and rows[page.page_id].n_chars == len(text)
        assert page.html.partition("<footer>")[2].partition(";")[2][:20] not in text


ARTICLE = "<article><h1>Title</h1><p>" + "Some words of the article. " * 12 + "</p></article>"
SEEN = "Title\n\n" + ("Some words of the article. " * 12).strip()


@pytest.mark.parametrize(
    "before",
    [
        "<html><head><title>t</title><body>",
        "<html><head><meta charset=utf-8><title>t</title>",
        "<head><style>p {}</style><script>var a = '<p>';</script><link href=x></head><body>",
        "<body><svg width=1 />",
        "<body><math/>",
        "<body><svg><path d=''><text>label</text><p></p>",
        "<body><div><button>Go</div>",
        "<body><object data=x><param name=y>",
        "<body><video src=x><source src=y>",
        "<body><button>Go<div></div><button>On</button>",
        "<body><svg><g><svg></svg>label</g></svg>",
        "<body><select><option>one<option>two</select>",
    ],
)
def test_left_out_end_tags(before):
    assert html_text.main_text(before + ARTICLE, html_text.trained()) == SEEN


@pytest.mark.parametrize("tag", ["script", "style", "textarea", "template"])
def test_runs_to_the_end(tag):
    assert html_text.main_text(f"{ARTICLE}<{tag}>no text<p>of the page", html_text.trained()) == SEEN


LONG = "<p>" + "Some words of an article that goes on and on, without a link. " * 4 + "</p>"


@pytest.mark.parametrize("name", ["post-comments", "comment-content", "main-sidebar", "main-nav", "content-header", "entry-footer post-footer", "comments has-content"])
def test_names_with_main_words_are_set_aside(name):
    leak = f'<div class="{name}"><p>{"Nothing of the article stands here, but more than a few words. " * 3}</p></div>'
    for page in (f"<body>{leak}<article>{LONG}</article>{leak}</body>", f"<body>{leak}<div class='content'>{LONG}</div></body>"):
        assert "Nothing" not in html_text.main_text(page, html_text.trained())


@pytest.mark.parametrize("name", ["related-work", "post has-sidebar", "no-comments", "post tag-search", "content comments-open", "with-ads"])
def test_names_that_set_nothing_aside(name):
    text = html_text.main_text(f'<body><div class="{name}">{LONG}</div></body>', html_text.trained())
    assert text == " ".join(LONG[3:-4].split())


def test_heads_of_articles_and_formulas_stay():
    page = '<article><div class="entry-header"><h1>Title</h1></div><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>TeX</annotation></math> be so.</p></article>'
    assert html_text.main_text(page, html_text.trained()) == "Title\n\nLet x=2 be so."


@pytest.mark.parametrize(
    "unit", ["x <b y ", '"x <b y ', '<b y="> ', "<div>", '<section class="x">', "<![CDATA[", "<", "<b", "<!x", "</p><section></div>", "<svg><a>", "<b 'x\" <i \"y ", "<!--"]
)
def test_broken_pages_take_time_in_proportion(unit):
    """A megabyte of broken markup; where time grows with the square this takes hours."""
    begun = time.monotonic()
    html_text.main_text("<body>" + unit * ((1 << 20) // len(unit)), html_text.trained())
    assert time.monotonic() - begun < 60


def plain_tag_end(page, at):
    quote = ""
    for i in range(at, len(page)):
        if quote:
            quote = "" if page[i] == quote else quote
        elif page[i] in "\"'":
            quote = page[i]
        elif page[i] == ">":
            return i + 1
    return -1


def test_tag_ends(monkeypatch):
    monkeypatch.setattr(html_text, "_SHORT", 3)
    rng = random.Random(4)
    for _ in range(3000):
        page = "".join(rng.choice("ab<>\"'") for _ in range(rng.randrange(30)))
        ends = html_text._TagEnds(page)
        assert [ends.after(i) for i in range(len(page))] == [plain_tag_end(page, i) for i in range(len(page))]
