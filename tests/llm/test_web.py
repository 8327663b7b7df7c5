"""Page text and archives."""

import gzip
import hashlib
import time

import pytest

from pricewright.llm import arc, density

PAGES = "page_id long, url string, html string, text int, file int, part int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], PAGES)


ARTICLE = "<h1>A title</h1><p>First paragraph, <b>bold</b> and &amp; long enough to be found.<p>Second\n  one with <a href='/x'>a link</a> in it,<br>broken.</p>"
WANT = "A title\nFirst paragraph, bold and & long enough to be found.\nSecond one with a link in it, broken."
FURNITURE = (
    "<header><a href='/'>Home page of the site</a></header><nav><ul><li><a href=a>one</a><li><a href=b>two</a></ul></nav>"
    "<div class='ad-banner'>Buy this now, it is cheap and good and cheap.</div><div id=cookieNotice>We use cookies.</div>"
)
AFTER = "<form><input><p>Write to us with this form.</p></form><section class='comments'><p>A reader says a lot of things here, at length, again and again.</p></section><aside><p>Other stories</p></aside><footer>&copy; site</footer>"


@pytest.mark.parametrize("html, want", [
    (f"<html><head><title>t</title><style>p {{}}</style></head><body>{FURNITURE}<article>{ARTICLE}</article>{AFTER}</body></html>", WANT),
    (f"<body>{FURNITURE}<div class=post>{ARTICLE}</div>{AFTER}", WANT),
    (f"<body>{FURNITURE}<main><article><header><h1>A title</h1></header>{ARTICLE[16:]}<script>x('</p>')</script></article></main>", WANT),
    (f"<BODY>{FURNITURE}<ARTICLE>{ARTICLE}<!-- hidden <p>no</p> --></ARTICLE>", WANT),
    ("<p>only &lt;text&gt;", "only <text>"), ("bare &eacute; text", "bare é text"), ("", ""), (None, ""), ("<div></div>", ""),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p", ""), ("a < b", "a < b"), ("<article><p>a</p></div></p>b</article>", "a\nb"),
    ("<article><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>", "x\ny\n1\n2"),
])
def test_main_text(html, want):
    assert density.main_text(html) == want


def test_sections_without_an_article():
    part = "<div class=section><p>%s paragraph that is long enough to carry some weight in its section.</p><p>And one more after it.</p></div>"
    html = f"<body>{FURNITURE}<div class=wrap>{part % 'First'}{part % 'Second'}</div>{AFTER}"
    text = density.main_text(html)
    assert "First paragraph" in text and "Second paragraph" in text and "reader" not in text and "cookies" not in text


@pytest.mark.parametrize("wrapper", ["class='layout has-sidebar'", "id=page class='no-comments'", "class='post share-enabled'"])
@pytest.mark.parametrize("article", [f"<article>{ARTICLE}</article>", f"<div>{ARTICLE}</div>"])
def test_names_only_mark_candidates(wrapper, article):
    assert density.main_text(f"<body>{FURNITURE}<div {wrapper}>{article}{AFTER}</div></body>") == WANT


def test_named_paragraphs_of_an_article():
    html = f"<body>{FURNITURE}<article>{ARTICLE}<p class=notice>A notice that belongs to the article and is long.</p><div class=related><a href=x>More</a></div></article>{AFTER}"
    assert density.main_text(html) == WANT + "\nA notice that belongs to the article and is long."


def test_headline_and_short_blocks_beside_the_text():
    long = "<p>" + "word " * 60 + "</p>"
    text = density.main_text(f"<body>{FURNITURE}<h1>A headline of the page</h1><div><p>Short one.</p></div><div>{long}{long}</div>{AFTER}</body>")
    assert text.split("\n")[:2] == ["A headline of the page", "Short one."] and len(text.split("\n")) == 4


def test_articles_beside_each_other():
    html = f"<body>{FURNITURE}<article>{ARTICLE}</article><article><p>The second part of it.</p></article>{AFTER}"
    assert density.main_text(html) == WANT + "\nThe second part of it."


LONG = "<p>" + "Some words of the article that go on for a while. " * 5 + "</p>"


def test_a_form_round_the_page_is_only_a_candidate():
    page = f"<header><a href=x>The site's name</a></header><nav><a href=y>Menu of it</a></nav>%s<form><p>Write to us.</p></form><footer>foot</footer>"
    for article in (f"<div>{LONG}{LONG}</div>", f"<article>{LONG}{LONG}</article>"):
        text = density.main_text(f"<body><form id=whole>{page % article}</form></body>")
        assert text.split("\n") == [" ".join(LONG[3:-4].split())] * 2


def test_links_inside_and_beside_an_article():
    links = "<div class=recommendations><ul><li><a href=x>Other story one</a><li><a href=y>Other story two</a></ul></div>"
    for tag in ("main", "article"):
        assert "Other story" not in density.main_text(f"<body>{FURNITURE}<{tag}>{LONG}{LONG}{links}</{tag}>{AFTER}</body>")
    teaser = "<article><a href=x>Teaser of another article</a></article>"
    assert "Teaser" not in density.main_text(f"<body>{FURNITURE}<article>{LONG}</article>{teaser}{AFTER}</body>")
    # A source that is named by one link stays, as do links in running text.
    assert density.main_text(f"<article>{LONG}<p><a href=x>The source</a></p></article>").endswith("The source")


@pytest.mark.parametrize("part", [
    ("<a ", 60_000, '"'), ('<a x="', 40_000, ""), ("<span>", 20_000, "</b>" * 40_000), ("<p>", 1, "<b>" * 20_000 + "<div>" * 20_000), ("<div>", 20_000, "<header></header>" * 12_000),
    ("<ul><li><ul>", 1, "<div>" * 20_000 + "<li></li>" * 15_000), ("<li><ul>", 1, "<dl><dd>" * 15_000 + "<li></li>" * 15_000),
    ("<span><table><td>", 1, "<i>" * 30_000 + "</span>" * 20_000), ("<", 200_000, ""), ("<!--", 50_000, ""), ("<svg>", 40_000, "</svg"), ("<script>", 20_000, ""),
], ids=lambda p: p[0])
def test_hostile_pages_take_no_square_of_their_length(part):
    head, times, tail = part
    begun = time.process_time()
    assert isinstance(density.main_text(head * times + tail + "text"), str)
    assert time.process_time() - begun < 5


@pytest.mark.parametrize("html, want", [
    ("<p>it's <b title=it's>so</b> and</p>", "it's so and"), ("<article><a title='x > y'>in</a> out</article>", "in out"), ("<td><b>x</td></b>y", "x\ny"),
    ("<b>x<table><td>in</b>side</td></table>", "x\ninside"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"),
])
def test_mending(html, want):
    assert density.main_text(html) == want


@pytest.mark.parametrize("html, want", [
    ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p></article>", "so x=1 holds"), ("<article><p>a<svg><p>b</article>", "a\nb"),
    ("<article><p>a</p><canvas><canvas><p>b</article>", "a\nb"), ("<article><p>a</p><script>x<p>b</article>", "a"), ("<article><p>a<svg><text>no</text></svg>b</article>", "ab"),
])
def test_formulas_and_unclosed_elements(html, want):
    assert density.main_text(html) == want


def test_page_texts(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>"), (2, None, None), (2, "u", ""), (None, "v", "<p>é</p>"), (4, "w", "<article><p>" + "word " * 200_000)]
    got = density.page_texts(pages(spark, rows))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by = {(r.page_id, r.url): (r.text, r.n_chars) for r in got.collect()}
    assert by[1, "u"] == (WANT, len(WANT)) and by[2, None] == by[2, "u"] == ("", 0) and by[None, "v"] == ("é", 1)
    assert by[4, "w"][1] == 5 * 200_000 - 1
    assert density.extract_text(pages(spark, rows)).columns == ["page_id", "url", "file", "part", "text"]
    assert density.page_texts(pages(spark, [])).count() == 0


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_arc_is_read_by_declared_lengths(version, pack):
    bodies = [b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nhtml\nhttp://x 1 2 3 4\n\n\r\n\r\n", b"", b"no http"]
    records = [arc.version_block(version, "f.arc"), *(arc.arc_record(version, f"http://h/{i} x", "text/html", b) for i, b in enumerate(bodies))]
    found = list(arc.read_arc(pack(b"\n".join(records) + b"\n")))
    assert [b for _, _, b in found[1:]] == bodies
    assert found[0][1]["version"] == str(version) and found[1][1]["url"] == "http://h/0%20x"
    assert len({o for o, *_ in found}) == 4
    if version == 2:
        assert found[1][1]["result-code"] == "200"
    with pytest.raises(ValueError):
        list(arc.read_arc(b"no header\n"))
    cut = list(arc.read_arc(b"\n".join(records[:2])[:-5]))
    assert cut[-1][1]["truncated"] == "length"


def test_warc_record():
    header = {"url": "http://h/", "ip-address": "1.2.3.4", "archive-date": "20010203040506", "content-type": "text/html"}
    block = b"HTTP/1.1 200 OK\r\n\r\npay\r\n\r\nload"
    (one,) = arc.read_warc(arc.warc_record("f", 7, header, block, None) + b"\r\n\r\n")
    assert one[1] == block and one[0]["warc-type"] == "response" and one[0]["warc-date"] == "2001-02-03T04:05:06Z"
    assert one[0]["warc-payload-digest"] == "sha256:" + hashlib.sha256(b"pay\r\n\r\nload").hexdigest()
    assert one[0]["warc-record-id"] == arc.record_id("f", 7) != arc.record_id("f", 8)
    (two,) = arc.read_warc(arc.warc_record("f", 9, header, block, (3, "f", 7)))
    assert two[0]["warc-type"] == "revisit" and two[0]["warc-refers-to"] == arc.record_id("f", 7) and two[1] == block[:19]
    (three,) = arc.read_warc(arc.warc_record("f", 9, header, b"plain", None))
    assert three[0]["warc-type"] == "resource" and three[0]["content-type"] == "text/html"
    assert arc.warc_date("2001") == "1970-01-01T00:00:00Z" and arc.warc_date("20010203") == "2001-02-03T00:00:00Z"


def check_archive(spark, rows, **options):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        key = (i is None, i or 0)
        first[data] = min(first.get(data, key), key)
    seen, want = set(), []
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        again = len(data) >= 100 and data in seen
        seen.add(data)
        original = first[data]
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", None if not again or original[0] else original[1]))
    got = arc.archive_pages(pages(spark, rows).repartition(3), **options)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_archive(spark):
    same, odd = "<p>é" + "x" * 200, "WARC/1.1\r\n\r\nhttp://x 0.0.0.0 1 t 9\n\n\r\n\r\n" * 5
    rows = [(i, f"http://h/{i}", f"<html>{i}</html>" * (i % 40)) for i in range(60)]
    rows += [(100, "u v\n", same), (99, None, same), (101, "u", same), (101, "u", same), (None, "n", same), (102, "", "short"), (103, "", "short"), (104, "o", odd), (105, "o", odd),
             (106, "e", None), (107, "e", ""), (None, None, None), (108, "big", "b" * 3_000_000), (-1, "neg", "<b>" * 50)]
    check_archive(spark, rows)


def test_archive_in_small_files(spark, monkeypatch):
    monkeypatch.setattr("pricewright.llm.phrase_index.SMALL_ROWS", 0)
    check_archive(spark, [(i, "u", f"page {i % 7} " * 20) for i in range(40)], file_records=4)


def test_archive_of_nothing(spark):
    assert arc.archive_pages(pages(spark, [])).count() == 0


def test_files_are_bounded_by_bytes(spark, tmp_path):
    """Long pages fill files of their own, short ones share them, and all come back."""
    rows = [(i, f"http://x/{i}", f"{i} " * (20_000 if i % 7 == 0 else 30)) for i in range(60)] + [(60, "u", None), (60, "u", ""), (None, None, "z" * 300_000)]
    table = pages(spark, rows).repartition(3)
    arc.write_arc(table, str(tmp_path / "arc"), file_bytes=50_000)
    sizes = [len(gzip.open(p).read()) for p in (tmp_path / "arc").rglob("part-*.gz")]
    assert len(sizes) > 10 and all(s < 52_000 or s > 55_000 and s < 310_000 for s in sizes)
    got = arc.archive_pages(table, file_bytes=50_000).collect()
    want = sorted(((i, len(h or ""), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows), key=repr)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest) for r in got), key=repr) == want
