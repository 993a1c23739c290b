"""Tokens, pages and archives against the libraries' and plain results."""

import base64
import gzip
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import DOCS, FOLDER, documents
from textgauge.llm import bpe, html_text, warc
from textgauge.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = list("aaabbetshinorld 's.,'\"!?#é́ÀİΣß9  \t\n中文ッ한국가ͅ'") + ["<|endoftext|>", "<|startoftext|>", "the", "tion", "'ll", " ", " "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_tree_and_words_equal_the_library(library):
    rnd, by = random.Random(1), bpe.tokenizer(PATH)
    for _ in range(600):
        some = rnd.sample(ALPHABET, rnd.randint(1, 12))
        text = "".join(rnd.choice(some) for _ in range(rnd.choice([3, 20, 80, 300])))
        want = library.encode(text, add_special_tokens=False).ids
        margin = rnd.choice([0, 1, 5, 20, 256])
        parts = bpe.cuts(text, max(2, len(text) // rnd.choice([2, 3, 8])))
        runs = [bpe.Run(np.frombuffer(bpe.word_encoder(PATH)([p])[0], "<u4").astype(np.int64), *bpe.ends(p, margin)) for p in parts]
        assert bpe.tree(runs, by).ids.tolist() == want
        assert np.frombuffer(bpe.word_encoder(PATH)([text])[0], "<u4").tolist() == want


def test_documents_of_any_length(spark, library):
    rnd = random.Random(2)
    long = "".join(rnd.choice(ALPHABET) for _ in range(3000))
    texts = [None, "", " \n", "The end.", long, "a" * 2500, "é" * 900 + "tion" * 300, "中" * 1500, long[:1200] + " " * 1500]
    ids = [None, *range(1, len(texts))]
    docs = documents(spark, texts + [long], ids + [4])
    rows = bpe.decode(bpe.encode(docs, PATH, long=400), PATH).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = texts[ids.index(r["id"])] or ""
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(spark.createDataFrame([], DOCS), PATH), PATH).count() == 0


def test_workers_keep_no_words_after_a_task(spark):
    docs = documents(spark, ["some words and others", "long " * 50] * 4).repartition(8)
    assert bpe.encode(docs, PATH, long=60).count() == 8

    def held(batches):
        for batch in batches:
            by = bpe.word_encoder(PATH)
            yield pa.RecordBatch.from_arrays([pa.array([len(by.words) + len(by.words.old) + len(by.pieces) + len(by.pieces.old)])], names=["n"])

    assert [r["n"] for r in spark.range(16).repartition(16).mapInArrow(held, "n long").collect() if r["n"]] == []


def test_token_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op3_bpe"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><header><h1>Site</h1></header><!-- <p>no</p> -->
<div class="ad">Buy, buy. Now!</div><article><h1>Head &amp; <i>line</i></h1><p><b>First, one.<br>two<p>Second
 &lt;b&gt; &#233;&nbsp;x.</p><ul><li>item one</li><li>item two</ul><div class="related-links"><p>See, also. This</p></div>
<section id="comments"><p>Reader: hello, you.</p></section></article><aside><p>Side, bar. Text</p></aside>
<form><label>Mail</label><input></form><footer>&copy; all, rights. Here</footer></body></html>"""
TEXT = "Head & line\n\nFirst, one. two\n\nSecond <b> é x.\n\nitem one\n\nitem two"


def test_article_of_a_page():
    assert html_text.main_text(PAGE) == TEXT
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("plain &amp; simple") == "plain & simple"
    assert html_text.main_text('<p title="a > b">One, two.</p><p title=">') .startswith("One, two.")
    assert html_text.main_text("<script>never closed <p>x</p>") == ""


def test_page_without_a_marked_article():
    page = '<body><div class="menu">Home</div><div id="content"><h2>Head</h2>' + "<p>A sentence, with points, that goes on for a while. And more.</p>" * 4
    page += '</div><div class="x"><a href="1">One</a> <a href="2">Two</a></div><div class="cookie-notice"><p>We use cookies, so. Ok.</p></div></body>'
    text = html_text.main_text(page)
    assert text.startswith("Head\n\nA sentence") and "One" not in text and "cookies" not in text and "Home" not in text


def test_all_of_an_unmarked_content_stays():
    long = "A sentence, with points, that goes on; and more. " * 8
    page = '<html><body><div class="menu">Home</div><div class="wrap"><div class="text"><h1>Head</h1><p class="lead">Short lead</p>'
    page += f"<p>{long}</p><p>{long}</p><ul><li>First item</li><li>Second item</li></ul><table><tr><th>Year</th><td>1999</td></tr></table>"
    page += f'<figure><figcaption>A caption</figcaption></figure><p>{long}</p></div><div class="x"><a href="1">One</a></div><div class="y">Last seen</div></div></body></html>'
    body = long.strip()
    want = ["Head", "Short lead", body, body, "First item", "Second item", "Year", "1999", "A caption", body]
    assert html_text.main_text(page).split("\n\n") == want


def test_values_choose_among_marked_articles():
    words = "<p>" + "plain words and more of them " * 4 + "</p>"
    prose = "<p>" + "Here, in short: this, that, and more. It ends; so. " * 2 + "</p>"
    text = html_text.main_text(f"<article>{words}</article><article class='a'>{prose}</article>")
    assert text.startswith("Here, in short")


def test_words_and_pieces_against_the_library():
    """Caches that forget all the time, letters of all kinds, special tokens in any case."""
    by, plain = bpe.WordEncoder(PATH), bpe.tokenizer(PATH)
    by.words.size = by.pieces.size = 50
    rnd = random.Random(3)
    letters = [chr(c) for c in range(1, 0x180)] + list("aAbBsStTrReEmMlLdDvV''0129 ") * 5
    letters += ["İ", "ǰ", "J̌", "é", "<|endoftext|>", "<|STARTOFTEXT|>", "<|", "漢", "😀", " ", "\x85", "½", "²", "ẞ"]
    texts = ["".join(rnd.choices(letters if k % 2 else letters[:127], k=rnd.randint(0, 40))) for k in range(4000)]
    found = [ids for at in range(0, len(texts), 50) for ids in by(texts[at : at + 50])]
    expected = plain.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [e.ids for e in expected]


PROSE = "One sentence, with a comma. " * 11
MARKED = f"<article><h1>T</h1><p>{PROSE}</p><p>{PROSE}</p></article>"
WANTED = "\n\n".join(["T", PROSE.strip(), PROSE.strip()])
BARE = MARKED.removeprefix("<article>").removesuffix("</article>")
MENU = '<nav><a href="/">Home</a>, <a href="/b">more</a></nav>'


@pytest.mark.parametrize(
    "page",
    [
        f'{MENU}<div class="overflow-hidden">{MARKED}</div>',
        f'<article style="overflow: hidden">{BARE}</article>',
        f'<article aria-hidden="false" data-x="a > hidden">{BARE}</article>',
        f'<div class="layout has-sidebar">{MARKED}</div>',
        f'<div id="page" class="no-sidebar">{MARKED}</div>',
        f'<div id="search-results-explained">{MARKED}</div>',
        f'<form id="whole">{MENU}{MARKED}<footer>c, all rights reserved.</footer></form>',
        f'<div class="sidebar-layout">{MENU}{MARKED}<div class="sidebar"><p>Other, text. More.</p></div></div>',
        f'<article><div class="content with-sidebar">{BARE}</div><div class="share">Share, this.</div></article>',
        f'<article><div class="post-header-and-body">{BARE}</div><div class="share">Share, this.</div></article>',
        f'{MARKED}<div class="comments"><article class="comment"><p>{PROSE * 9}</p></article></div>',
        f'<article>{BARE}<section id="comments"><p>{PROSE * 9}</p></section></article>',
        f'<article>{BARE}<p hidden>no, no.</p><p style="color:red;display: none">no, no.</p></article>',
        f'<div class="a"><a href="1">A</a><a href="2">B</a></div><div class="b">{BARE}</div><div class="c"><a href="3">Read more</a></div>',
        f'<div class="sidebar"><div class="b">{BARE}</div></div>',
        f'<div role="search"><input></div><div class="x">{BARE}</div><div id="commentform">Say, it.</div><div class="commentList replies">{PROSE}</div>',
    ],
)
def test_words_do_not_hide_the_article(page):
    assert html_text.main_text(f"<html><body>{page}</body></html>") == WANTED


def test_articles_of_like_value_belong_together():
    parts = [f"<article><p>{PROSE}{k}</p></article>" for k in range(3)]
    teaser = '<article class="card"><a href="1">Read</a> this.</article>'
    assert html_text.main_text("".join(parts) + teaser) == "\n\n".join(f"{PROSE}{k}" for k in range(3))


def test_formulas_stay_in_their_sentence():
    assert html_text.main_text("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be, so.</p></article>") == "Let x=2 be, so."


def test_long_pages_take_linear_time():
    for part in ("<p>", "<div>", "<b", '<a href="', "&amp;", "<!--", "x ", "<li>y", "</div>"):
        html_text.main_text("<article>" + part * 40_000)
    assert html_text.main_text("<article><p>" + "word " * 200_000).count("word") == 200_000


def test_page_tables(spark):
    rows = [(None, "u", None, 1), (1, None, PAGE, 1), (1, None, PAGE, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((r["page_id"], r["text"]) for r in html_text.extract(pages).collect()), key=repr)
    assert got == [(1, TEXT), (1, TEXT), (None, "")]
    assert html_text.extract(pages.where("false")).count() == 0


def test_articles_of_the_given_pages(spark):
    for r in QUERIES["op8_html_text"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = r["html"].partition("<article>")[2].partition("</article>")[0]
        assert r["n_chars"] == len(r["text"]) and r["text"]
        assert html_text.main_text(f"<article>{inner}</article>") == r["text"]


def test_loser_tree():
    rnd = random.Random(3)
    for k in range(9):
        streams = [sorted(rnd.randint(0, 30) for _ in range(rnd.randint(0, 20))) for _ in range(k)]
        merged = [key for key, _ in warc.LoserTree([((x, n) for x in s) for n, s in enumerate(streams)])]
        assert merged == sorted(x for s in streams for x in s)


def test_url_keys():
    assert warc.url_key("http://www.Example.com/a/?b=2&a=1#top") == warc.url_key("https://example.com/a?a=1&b=2") == "com,example)/a?a=1&b=2"
    assert warc.url_key(None) == "" and "\t" not in warc.url_key("a\tb") and warc.url_key("http://[bad") != ""


PAGES = "page_id long, url string, html string, captured long, digest string"


def captures(spark, n=120):
    rnd = random.Random(5)
    rows = [(k, f"http://h{rnd.randint(0, 3)}.org/{rnd.randint(0, 4)}", rnd.choice(["", None, "same é", "other", f"own {k}"]), rnd.randint(0, 9), "d") for k in range(n)]
    rows += [(None, None, "same é", None, "d"), (3, rows[3][1], rows[3][2], rows[3][3], "d"), (n, "http://h0.org/ü\r\n\t", "tail", 1, "d")]
    return rows, spark.createDataFrame(rows, PAGES).repartition(7)


def test_records_read_back(spark):
    rows, pages = captures(spark)
    first = {}
    for i, _, html, *_ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = []
    for i, url, html, when, _ in rows:
        data = (html or "").encode()
        refers = None if first[html or ""] == i else first[html or ""]
        want.append((i, "response" if refers is None else "revisit", len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), refers, warc.url_key(url), when or 0))
    got = [tuple(r[c] for c in ("id", "record_type", "payload_bytes", "payload_digest", "refers_to", "url_key", "captured")) for r in warc.archive(pages).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r["record_type"] == "response" for r in warc.archive(pages, min_bytes=1000).collect())
    assert warc.archive(pages.where("false")).count() == 0


def test_index_is_in_global_order(spark, tmp_path):
    rows, pages = captures(spark)
    folder = f"file://{tmp_path}/archive"
    runs = warc.write(pages, folder, "page_id", "url", "html", "captured")
    for fan_in, ranges in ((64, 5), (2, 3)):
        index = warc.merged_index(runs, folder, ranges, fan_in)
        keys = [(r["url_key"].encode(), r["captured"], -1 if r["id"] == "null" else int(r["id"])) for r in index.withColumn("_p", F.spark_partition_id()).orderBy("_p").collect()]
        parts = index.select(F.spark_partition_id().alias("p"), "url_key").groupBy("p").count().collect()
        assert len(keys) == len(rows) and len(parts) >= 2
        by_part = {}
        for r in index.withColumn("p", F.spark_partition_id()).collect():
            by_part.setdefault(r["p"], []).append((r["url_key"].encode(), r["captured"], -1 if r["id"] == "null" else int(r["id"])))
        assert [k for p in sorted(by_part) for k in by_part[p]] == sorted(keys)
    entry = warc.merged_index(runs, folder).where("id = '7'").first()
    data = (tmp_path / "archive" / entry["archive"]).read_bytes()[entry["offset"] : entry["offset"] + entry["length"]]
    assert b"WARC-Record-ID: <urn:page:7>" in gzip.decompress(data)
