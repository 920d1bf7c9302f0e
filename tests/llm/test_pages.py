"""Tag-path extraction and web archives."""

import gzip
import hashlib
import html
import re
import time

import pytest
from pyspark.sql import functions as F

from quartermill.llm import queries, tag_paths, warc

SF = "/root/testdata/sf0.001"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<div id="top-menu"><a href=1>Home</a> <a href='2'>News</a></div><!-- <p>no</p> --><div class="cookie-notice"><p>We use cookies, of course.</p></div>
<div class="wrap"><div class="content"><h1>Title   here</h1><p>A first paragraph, with some text. And a <b>bold</b> word &amp; more &lt;b&gt;.
<p>Second, unclosed.<ul><li>one, item<li>two</ul><form><label>Name</label><input name=a></form><blockquote>Quoted, too.</blockquote>
<div class="comments"><p>Nice article, thank you very much indeed. I like it.</p></div></div><aside><p>Other stories, many of them. Read.</p></aside></div>
<footer>Copyright, all of it.</footer></body></html>"""
WANT = "Title here\nA first paragraph, with some text. And a bold word & more <b>.\nSecond, unclosed.\none, item\ntwo\nQuoted, too."


def test_article_without_its_surroundings():
    assert tag_paths.main_text(PAGE) == WANT


def test_names_inside_other_attributes_and_article_headers_do_not_count():
    page = """<body><header class=top>Site, name.</header><article><header class="entry-header"><h1>Head</h1></header>
    <p title="a hidden class=ad gem">Kept text, of course.</p><p hidden>Not shown, ever.</p><div class='x ad y'>Buy, now.</div></article></body>"""
    assert tag_paths.main_text(page) == "Head\nKept text, of course."


def test_headline_lead_and_body_beside_each_other_without_an_article_element():
    body = "".join(f"<p>Paragraph {i} of the text, with some words. And more of them, too.</p>" for i in range(20))
    lines = "".join(f"\nParagraph {i} of the text, with some words. And more of them, too." for i in range(20))
    around = "<body><div class=nav><a href=1>Home</a></div><div id=menu><a href=2>News</a></div>%s<div class=footer>Copyright, all of it.</div></body>"
    lead = "<div class=lead><p>The lead, a short one.</p></div>"
    assert tag_paths.main_text(around % f"<div id=post><h1>Head</h1>{lead}<div class=text>{body}</div></div>") == "Head\nThe lead, a short one." + lines
    assert tag_paths.main_text(around % f"<div id=post><h1>Head</h1><div class=text>{body}</div></div>") == "Head" + lines
    assert tag_paths.main_text(around % f"<div id=post><div><h1>Head</h1></div><div class=text>{body}</div></div>") == "Head" + lines
    source = "<p><a href=3>The whole report of the ministry</a></p>"
    assert tag_paths.main_text(around % f"<div id=post>{source}{body}<ul><li><a href=4>Data</a></ul></div>") == "The whole report of the ministry" + lines + "\nData"


@pytest.mark.parametrize("part, row", [("section", "p"), ("ul", "li"), ("table", "td")])
def test_a_long_part_does_not_displace_its_shorter_siblings(part, row):
    rows = [f"Row {i} of the long part, with some words. And more of them, too." for i in range(30)]
    long = f"<{part}>" + "".join(f"<tr><td>{r}</td></tr>" if row == "td" else f"<{row}>{r}</{row}>" for r in rows) + f"</{part}>"
    short = f"<{part}><tr><td>Short, too.</td></tr></{part}>" if row == "td" else f"<{part}><{row}>Short, too.</{row}></{part}>"
    page = f"<body><div id=menu><a href=1>News</a></div><div id=post><p>Opening.</p>{short}{long}<p>End.</p></div></body>"
    assert tag_paths.main_text(page) == "\n".join(["Opening.", "Short, too.", *rows, "End."])


WORDS = "Lorem ipsum dolor sit amet, consetetur sadipscing elitr. Sed diam nonumy eirmod tempor, invidunt ut labore et dolore magna. At vero eos."
MENUS = [
    "<ul>" + "".join(f"<li><a href=/{i}>Topic {i}</a></li>" for i in range(7)) + "</ul>",
    "<table><tr>" + "".join(f"<td><a href=/{i}>Part {i}</a></td>" for i in range(6)) + "</tr></table>",
    "<div><a href=1>One</a> | <a href=2>Two</a> | <a href=3>Three</a></div>",
]
NOTICES = ["<div><p>This site uses small files, as all do.</p><p>Fine.</p></div>", "<div>Sign up for news.</div>"]
FOOTS = ["<div><p>All rights are ours, 2024.</p><p><a href=x>Imprint</a></p></div>", "<table><tr><td>Buy one now</td><td><a href=y>Cheap things</a></td></tr></table>"]


def written_pages():
    """Pages without an article element and without telling names: menus, notices and feet around articles of several makes."""
    for m, menu in enumerate(MENUS):
        for n, notice in enumerate(NOTICES):
            for f, foot in enumerate(FOOTS):
                paragraphs = [f"Paragraph {i}. {WORDS}" for i in range(3 + m + 2 * n + f)]
                lines = ["The headline", "A short line.", *paragraphs, "first point", "second point", "Quoted, once.", "The end."]
                inner = ("<h1>The headline</h1><p>A short line.</p>" + "".join(f"<p>{p}</p>" for p in paragraphs)
                         + "<ul><li>first point</li><li>second point</li></ul><blockquote>Quoted, once.</blockquote><p>The end.</p>")
                for article in (f"<div>{inner}</div>", f"<div><div>{inner}</div></div>"):
                    yield f"<html><head><title>T</title></head><body><div>{menu}</div>{notice}{article}{foot}</body></html>", lines


def test_articles_without_an_article_element_or_names_are_found_by_their_ratios(monkeypatch):
    pages = list(written_pages())
    assert len(pages) >= 20
    for page, lines in pages:
        assert tag_paths.main_text(page) == "\n".join(lines)
    # with the same ratio everywhere nothing tells the article from what is around it
    monkeypatch.setattr(tag_paths, "path_ratios", lambda page, nodes: {page.path[page.owner[k]]: 1.0 for k in nodes})
    assert all(tag_paths.main_text(page) != "\n".join(lines) for page, lines in pages)


def plain_ratios(page):
    """Mean length, marks and links of text nodes by path, from a second reading of simple markup."""
    sums, stack, places = {}, [], {}
    for token in re.findall(r"<[^>]*>|[^<]+", page):
        if token.startswith("</"):
            stack.pop()
        elif token.startswith("<"):
            tag = re.match(r"<(\w+)", token)[1]
            parent = tuple(stack)
            key = (parent, tag)
            places[key] = places.get(key, 0) + 1
            stack.append((tag, places[key]))
        elif token.strip():
            path = tuple(f"{t}:{k}" if t in tag_paths.CONTAINERS else t for t, k in stack if t == "a" or t not in tag_paths.INLINE)
            own = sums.setdefault(path, [0, 0, 0, 0])
            size = len(token.strip())
            for i, v in enumerate((size, len(re.findall(r"[.,;:!?]", token)), size * any(t == "a" for t, _ in stack), 1)):
                own[i] += v
    return sorted(size / n * (1 + marks / n) * (1 - linked / size) for size, marks, linked, n in sums.values())


def test_ratios_equal_a_plain_count():
    for page, _ in written_pages():
        body = page[page.index("<body>"):page.index("</html>")]
        tree = tag_paths.read_page(body)
        nodes = [k for k, t in enumerate(tree.text) if t.strip()]
        assert sorted(tag_paths.path_ratios(tree, nodes).values()) == pytest.approx(plain_ratios(body))


def test_forms_formulas_and_names_that_say_little_do_not_cost_text():
    text = "".join(f"<p>Paragraph {i}, with some words. And more of them.</p>" for i in range(6))
    lines = [f"Paragraph {i}, with some words. And more of them." for i in range(6)]
    form = f"<body><div class=nav><a href=1>Home</a></div><form action=/><div id=content><h1>Head</h1>{text}</div><label>Name</label><input><button>Go</button></form></body>"
    assert tag_paths.main_text(form) == "\n".join(["Head", *lines])
    named = f"<body><article><h1>Head</h1><p class=social>A word on it, in short.</p>{text}<div class=share-price>Up 3, to 20.</div><p>So <math><mi>x</mi>=1</math>.</p></article></body>"
    assert tag_paths.main_text(named) == "\n".join(["Head", "A word on it, in short.", *lines, "Up 3, to 20.", "So x=1."])


@pytest.mark.parametrize("unit", ["<i>word ", "<div>word ", "<p><b>word ", "</x><u>word ", "<li><i>word "])
def test_time_is_linear_in_unclosed_tags(unit):
    start = time.process_time()
    assert tag_paths.main_text("<html><body>" + unit * 8000).split() == ["word"] * 8000
    assert time.process_time() - start < 2


def article_of(page):
    found = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    blocks = re.split(r"</?(?:p|h1|br)\b[^>]*>", found[1]) if found else []
    lines = [" ".join(html.unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in blocks]
    return "\n".join(line for line in lines if line)


def test_op4_finds_the_article_of_every_given_page(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = queries.op4_tag_paths(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages)
    for row in got:
        assert row["text"] == article_of(pages[row["page_id"]]["html"]) and row["n_chars"] == len(row["text"])
        assert row["url"] == pages[row["page_id"]]["url"]


def test_extract_covers_odd_pages(spark):
    long = "<html><body><div>" + "<p>Some words, and more of them.</p>" * 20000 + "</div></body></html>"
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "plain text, no tags"), (4, "u", long), (5, "u", "<p>cut <b"), (6, "u", "<script>x"),
            (7, "u", "</p></div>a < b &amp; c &am"), (8, "u", "<nav><a>only menu</a></nav>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"text": F.lit(1), "_page": F.lit("x")})
    got = tag_paths.extract(df).collect()
    texts = [r["text"] for r in got]
    assert texts[:5] == [WANT, WANT, "", "", "plain text, no tags"]
    assert texts[5].count("\n") == 19999 and texts[6:] == ["cut", "", "a < b & c &am", ""]
    assert tag_paths.extract(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        tag_paths.extract(df, keep=["text"])


def record(name, payload, kind="response"):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    sha = hashlib.sha1(block).hexdigest()
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{warc.RECORD_PREFIX}{name}>\r\nWARC-Block-Digest: sha1:{sha}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def names_and_gaps(data):
    found = list(warc.salvage(data))
    assert sum(f.length for f in {f.offset: f for f in found}.values()) == len(data)  # every byte is in a record or a gap
    return ([f.headers["warc-record-id"].strip("<>").rpartition(":")[2] for f in found if not f.reason], [(f.offset, f.length) for f in found if f.reason])


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_salvage_goes_on_after_damage(pack):
    parts = [pack(record(i, b"payload %d " % i * 30)) for i in range(4)]
    whole = b"".join(parts)
    assert names_and_gaps(whole) == (["0", "1", "2", "3"], [])
    start, size = len(parts[0]), len(parts[1])
    broken = bytearray(whole)
    broken[start + size // 2] ^= 0xFF  # a changed byte in the second record
    assert names_and_gaps(bytes(broken)) == (["0", "2", "3"], [(start, size)])
    junk = parts[0] + b"junk WARC/9 \x1f\x8b\x08 more junk" + parts[1]
    names, gaps = names_and_gaps(junk)
    assert names == ["0", "1"] and gaps[0][0] == len(parts[0])
    names, gaps = names_and_gaps(whole[:-40])  # the last one is cut off
    assert names == ["0", "1", "2"] and len(gaps) == 1
    assert names_and_gaps(whole[10:])[0] == ["1", "2", "3"]
    assert list(warc.salvage(b"")) == []
    assert [f.reason is not None for f in warc.salvage(b"nothing of the kind")] == [True]


def test_several_records_in_one_member():
    data = gzip.compress(record(1, b"a") + record(2, b"b")) + record(3, b"c")
    assert [f.headers["warc-record-id"][-2] for f in warc.salvage(data)] == ["1", "2", "3"]


def test_archives_round_trip(spark, tmp_path):
    big, text = "x" * 1200, "kurz é WARC/1.1\r\n\r\n\r\n"
    rows = [(1, "http://a/ b\r\nX: y", big), (2, None, big), (9, "u", big), (3, "u", text), (4, "u", text), (5, "u", None), (6, "u", ""), (None, "u", big),
            (7, "u", "<p>\r\n\r\nWARC/1.1\r\n" * 100), (11, "u", "é" * 700), (11, "u", "é" * 700), (10, "u", "é" * 700)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"payload": F.lit(1), "block": F.lit(2), "first": F.lit(3)})
    got = warc.archive_pages(pages, str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    seen = {(r["page_id"], r["payload_digest"]): r for r in got}
    for page, _, payload in rows:
        raw = (payload or "").encode()
        row = seen[page, hashlib.sha1(raw).hexdigest()]
        assert row["payload_bytes"] == len(raw)
    of = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in got}
    assert of[1] == of[2] == of[None] == ("revisit", 9) and of[9] == ("response", None)
    assert of[3] == of[4] == of[5] == of[6] == of[7] == of[11] == ("response", None) and of[10] == ("revisit", 11)
    payloads = {bytes(r["payload"]) for r in warc.read(spark, str(tmp_path / "w"), payload=True).filter("record_type = 'response'").collect()}
    assert payloads == {(p or "").encode() for _, _, p in rows}
    assert warc.archive_pages(pages.limit(0), str(tmp_path / "none")).count() == 0
