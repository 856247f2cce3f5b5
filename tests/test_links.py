"""Links of pages and named characters."""

import html
import random
from html.entities import name2codepoint
from urllib.parse import urldefrag, urljoin

import pytest
from pyspark.sql import functions as F

from leadspark.functions import text, url

BASE = "http://a.example/b/c/d;p?q"

# The examples of the standard that name web addresses elsewhere.
EXAMPLES = [
    "g", "./g", "g/", "/g", "//g", "?y", "g?y", "g#s", "g?y#s", ";x", "g;x", "g;x?y#s",
    ".", "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "../../../../g",
    "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h",
    "g;x=1/./y", "g;x=1/../y", "g?y/./x", "g?y/../x", "http://h.example/x/../y", "HTTPS://h.example",
]


def resolve(spark, pairs):
    frame = spark.createDataFrame(list(enumerate(pairs)), "i int, p struct<base:string,ref:string>")
    rows = frame.select("i", url.resolved(F.col("p.base"), F.col("p.ref")).alias("u")).collect()
    found = {row.i: row.u for row in rows}
    return [found[i] for i in range(len(pairs))]


def test_references_of_the_standard(spark):
    got = resolve(spark, [(BASE, ref) for ref in EXAMPLES])
    want = [urldefrag(urljoin(BASE, ref))[0] for ref in EXAMPLES]
    want[-2:] = ["http://h.example/y", "https://h.example"]
    assert dict(zip(EXAMPLES, got, strict=True)) == dict(zip(EXAMPLES, want, strict=True))


def test_random_references(spark):
    random.seed(2)
    parts = ["a", "b.html", "..", ".", "x y", "é"]
    pairs = []
    for _ in range(400):
        base = "https://h.example/" + "/".join(random.choices(["p", "q", "r"], k=random.randint(0, 3)))
        ref = random.choice(["", "/"]) + "/".join(random.choices(parts, k=random.randint(1, 5))) + random.choice(["", "/"])
        ref += random.choice(["", "?q=1", "?a/../b"])
        pairs.append((base, ref))
    for pair, got in zip(pairs, resolve(spark, pairs), strict=True):
        assert got == urljoin(*pair), pair


@pytest.mark.parametrize(
    ("ref", "found"),
    [
        ("#top", None), ("", None), ("  ", None), ("mailto:a@b.example", None), ("javascript:x()", None),
        ("tel:1", None), ("data:text/html,x", None), ("https:", None), ("//", None), ("http:///x", None),
        ("?a=1&amp;b=2", "http://a.example/b/c/d;p?a=1&b=2"), ("&#x67;", "http://a.example/b/c/g"),
        (" g\n", "http://a.example/b/c/g"), ("g\t/h", "http://a.example/b/c/g/h"),
        ("http:g", "http://a.example/b/c/g"),
    ],
)
def test_references_that_are_odd(spark, ref, found):
    assert resolve(spark, [(BASE, ref)]) == [found]


def test_documents_without_a_web_address(spark):
    pairs = [("ftp://h.example/x", "y"), ("x", "y"), (None, "y"), ("x", "http://h.example/y"), ("https://h.example", "y")]
    assert resolve(spark, pairs) == [None, None, None, "http://h.example/y", "https://h.example/y"]


PAGES = [
    ("<a href=\"x\">1</a><A HREF='y'>2</A><a class=c href=z>3</a>", ["x", "y", "z"]),
    ("<a title=\"a > b\" href=\"x\">", ["x"]),
    ("<a title=' href=no ' href=x data-href=q>", ["x"]),
    ("<a data-href=\"no\">", []),
    ("<a>", []),
    ("<abbr href=\"no\">", []),
    ("<!-- <a href=no> --><script>'<a href=no>'</script><a\nhref = \"x\"\n>", ["x"]),
    ("<a href=\"it's\">", ["it's"]),
    ("<a href=\"\"><a href=\"#f\">", ["#f"]),
    ("<a href", []),
    ("", []),
]


def test_links_of_pages(spark):
    frame = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(PAGES)], "i int, html string")
    got = {row.i: row.found for row in frame.select("i", url.hrefs(F.col("html")).alias("found")).collect()}
    assert {i: [x for x in got[i] if x] for i in got} == {i: want for i, (_, want) in enumerate(PAGES)}


def test_base_of_a_page(spark, one):
    page = "<base href='/sub/'><a href=x><a href='#f'><a href=mailto:x><a href='../y'>"
    value = one(url.links(F.lit("https://h.example/p/q"), F.col("x")), row=(page,))
    assert value == ["https://h.example/sub/x", "https://h.example/y"]
    long = "<a " + "x " * 20000 + "href=z>" + "<a href=w>" * 2000
    assert len(one(url.links(F.lit("https://h.example/"), F.col("x")), row=(long,))) >= 2000


def test_every_named_character(spark):
    names = sorted(name2codepoint)
    frame = spark.createDataFrame([(n, f"a&{n};b&amp;{n};&{n} ;") for n in names], "n string, x string")
    for row in frame.select("n", text.decode_entities(F.col("x")).alias("y")).collect():
        sign = " " if row.n == "nbsp" else chr(name2codepoint[row.n])
        assert row.y == f"a{sign}b&{row.n};&{row.n} ;"


@pytest.mark.parametrize(
    "sample",
    ["&#65;", "&#00000065;", "&#x0000041;", "&#x1F600;", "&#128512;", "&#X41;", "&apos;", "&amp;lt;", "&amp;#65;", "a&b;c", "&&amp;&", "&#;", "&#x;", "&;"],
)
def test_numbered_characters(one, sample):
    got = one(text.decode_entities(F.col("x")), row=(sample,))
    assert got == html.unescape(sample)


@pytest.mark.parametrize("sample", ["&#0;", "&#55296;", "&#1114112;", "&#99999999;", "&nosuchname;", "&amp", "&"])
def test_what_is_no_character_stays(one, sample):
    assert one(text.decode_entities(F.col("x")), row=(sample,)) == sample
