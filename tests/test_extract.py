"""Extraction from pages, feeds and rule files."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from advisorium import model
from advisorium.operators import extract

REFERENCES = ["/a", "b", "./c", "../d", "../../e/./f", "g/..", "?q=1", "#frag", "", "//other.org/x", "https://z.org/y", "mailto:a@b.c",
              "h?x=../y", "/i/../j#k", "..", "."]


@pytest.mark.parametrize("base", ["https://e.org/one/two/three.html", "http://e.org/x/?q=2", "https://e.org"])
def test_resolve_url(spark, base):
    rows = spark.createDataFrame([(n, base, r) for n, r in enumerate(REFERENCES)], "n int, base string, ref string")
    for row in rows.withColumn("url", extract.resolve_url("base", "ref")).collect():
        if base == "https://e.org" and row.ref in ("..", ".", "../d", "../../e/./f", "?q=1", "g/.."):
            continue  # a base without a path is resolved like one with the path /
        assert row.url == urljoin(base, row.ref), row.ref


def test_links(spark):
    html = ('<a href="/a">1</a><A class=x HREF = \'/b?x=1&amp;y=2\'>2</A><a href="/a">again</a><a href="https://o.org/c">3</a>'
            '<a href="#top">self</a><a name="n">no</a><a href="/skip">4</a><a href="/d">5</a>')
    pages = spark.createDataFrame([(1, "https://e.org/p", html), (2, "https://e.org/q", None)], "id int, url string, html string")
    links = extract.crawl_links(pages, "id", "e.org/[abd]", 3).orderBy("id", "position").collect()
    assert [(r.id, r.position, r.link) for r in links] == [
        (1, 0, "https://e.org/a"), (1, 1, "https://e.org/b?x=1&y=2"), (1, 2, "https://e.org/d")]


PAGE = """<html><body><h1>Whole page title</h1><p>Intro text that is long enough to pass the gate of fifty characters, surely.</p>
<h2 class="x">First &amp; <em>best</em></h2><p>Body one, with <b>bold</b> words and enough length to be kept by the gate.</p>
<script>var h = "<h3>not a header</h3>";</script><p>more</p>
<H3>Tiny</H3><p>Title under five characters is skipped even though the body is long enough to pass.</p>
<h4>Short body</h4><p>too short</p>
<h5>Deeper headers are text</h5><h2>Last one</h2><div>{long}</div></body></html>"""


def test_header_sections(spark):
    html = PAGE.format(long="y" * 5000)
    pages = spark.createDataFrame([(1, "u", html), (2, "u2", "<p>none</p>")], "id int, url string, html string")
    rows = extract.header_sections(pages, "id").orderBy("position").collect()
    assert [(r.header_level, r.title) for r in rows] == [("h2", "First & best"), ("h2", "Last one")]
    assert rows[0].body == "Body one, with bold words and enough length to be kept by the gate. more"
    assert rows[1].body == "y" * 4000
    tops = extract.header_sections(pages, "id", levels=(1,)).collect()
    assert [(r.title, r.header_level) for r in tops] == [("Whole page title", "h1")] and tops[0].body.startswith("Intro text")


def test_sections_end_with_the_element_of_their_header(spark):
    html = ("<body><div><h2>A title</h2><div><p>Inner text that is long enough to pass the gate of fifty characters.</p></div>"
            "<section>own</section></div><footer>not part of it</footer><h3>Next title</h3>" + "z" * 60 + "</body> after")
    pages = spark.createDataFrame([(1, "u", html)], "id int, url string, html string")
    rows = extract.header_sections(pages, "id").orderBy("position").collect()
    assert [r.body for r in rows] == ["Inner text that is long enough to pass the gate of fifty characters. own", "z" * 60]


def test_selected_items(spark):
    html = """<div id=main><div class="rule item"><h3>One <i>title</i></h3><p>Body of the first rule.</p><br><script>x</script></div>
    <div class="rule item"><h3></h3><p>No title, so this one is left out.</p></div>
    <section class="item"><h3>Not inside</h3></section></div>
    <div class="rule item"><h2>Outside main</h2><p class="text">A body chosen by its own selector.</p></div>"""
    pages = spark.createDataFrame([(1, "u", html)], "id int, url string, html string")
    rows = extract.selected_items(pages, "id", "div.rule", "h2, h3").orderBy("position").collect()
    assert [(r.title, r.body) for r in rows] == [
        ("Onetitle", "OnetitleBody of the first rule."), ("Outside main", "Outside mainA body chosen by its own selector.")]
    inner = extract.selected_items(pages, "id", "#main .rule", "h3", "p").collect()
    assert [(r.title, r.body) for r in inner] == [("Onetitle", "Body of the first rule.")]
    chosen = extract.selected_items(pages, "id", "div", "h2", ".text").collect()
    assert [r.body for r in chosen] == ["A body chosen by its own selector."]


def test_feed_items(frame):
    rows = frame([
        {"title": " Kept ", "link": "https://e", "description": "<p>" + "long &amp; " * 10 + "</p>", "pubDate": "Wed, 15 Jan 2025 10:00:00 GMT",
         "category": ["a", "b"], "author": "me"},
        {"title": "Content first", "content": "c" * 60, "description": "short"},
        {"title": "Short", "description": "x"}, {"title": " ", "description": "y" * 60}, {"description": "y" * 60}], model.FEED_ITEM)
    items = extract.feed_items(rows, F.lit("s"), F.lit("S"), F.array(F.lit("cost"))).collect()
    assert [i.title for i in items] == ["Kept", "Content first"]
    first = items[0]
    assert first.body.startswith("long & long &") and first.published_at == "2025-01-15T10:00:00Z"
    assert first.raw_metadata == {"tags": "a, b", "author": "me"} and first.categories == ["cost"] and len(first.content_hash) == 64
    assert items[1].body == "c" * 60 and items[1].published_at is None and items[1].url == ""


FILES = [
    ("checks/enc.py", 'CheckID = "enc_check"\nDescription = "Ensure encryption"\nSeverity = "high"\nServiceName = "s3"\nclass enc_check:\n    """Doc text."""\n'),
    ("checks/cls.py", 'class PublicBucket(Check):\n    """\n    Buckets are closed.\n    """\n    pass\n'),
    ("checks/plain_file.py", "x = 1\n"),
    ("checks/doc.py", '"""Module text."""\n'),
    ("checks/__init__.py", "# init"),
    ("checks/utils.py", "def f(): pass"),
    ("rules/one.yaml", "check_id: other\nname: 'bucket_logging'\ndescription: \"Ensure logging\"\nseverity: medium\n"),
    ("rules/two.yml", "nothing: here"),
    ("rules/list.json", '[{"name": "A", "description": "first"}, {"title": "B"}, {"x": 1}]'),
    ("rules/object.json", '{"id": 7, "message": "seventh"}'),
    ("rules/broken.json", "{ broken"),
    ("README.md", "z" * 5000),
]


def test_rule_files(spark):
    files = spark.createDataFrame([(p, c, "u/" + p) for p, c in FILES], "path string, content string, url string")
    found = {}
    for r in extract.rule_file_items(files).collect():
        found.setdefault(r.path, []).append(r)
    one = lambda p: found[p][0]
    assert (one("checks/enc.py").title, one("checks/enc.py").body, one("checks/enc.py").severity, one("checks/enc.py").service) == (
        "enc_check", "Ensure encryption", "high", "s3")
    assert (one("checks/cls.py").title, one("checks/cls.py").body) == ("PublicBucket", "Buckets are closed.")
    assert (one("checks/plain_file.py").title, one("checks/plain_file.py").body) == ("plain file", "Security check from checks/plain_file.py")
    assert (one("checks/doc.py").title, one("checks/doc.py").body) == ("doc", "Module text.")
    assert (one("rules/one.yaml").title, one("rules/one.yaml").body, one("rules/one.yaml").severity) == ("bucket_logging", "Ensure logging", "medium")
    assert (one("rules/two.yml").title, one("rules/two.yml").body) == ("two.yml", "nothing: here")
    assert [(r.title, r.body) for r in found["rules/list.json"]] == [("A", "first"), ("B", '{"title":"B"}')]
    assert (one("rules/object.json").title, one("rules/object.json").body) == ("7", "seventh")
    assert one("README.md").body == "z" * 4000 and one("README.md").file_type == "generic"
    assert set(found) == {p for p, _ in FILES} - {"checks/__init__.py", "checks/utils.py", "rules/broken.json"}


def test_payload_guard(spark):
    rows = spark.createDataFrame([("é" * 50,), ("a" * 99,), (None,)], "html string")
    assert [r[0] for r in rows.select(extract.payload_too_small()).collect()] == [False, True, True]


def test_prompt_cuts_the_body(spark):
    row = spark.createDataFrame([("T", "b" * 5000)], "title string, body string").select(
        extract.prompt_text(F.lit("S"), "title", F.lit("u"), F.lit("a, b")).alias("p")).first()
    assert row.p == "Source: S\nTitle: T\nURL: u\nCategories: a, b\n\nContent:\n" + "b" * 4000


def test_items_of_all_kinds_go_through_one_run(spark):
    """Feed entries, rule files and page sections have one shape, which a run takes."""
    from advisorium.plans import ingest

    made = (F.lit("s"), F.lit("Source"), F.array(F.lit("security")))
    files = spark.createDataFrame([("checks/a.yaml", "title: Rotate keys\ndescription: Keys are old\nseverity: high\n", "https://x/a"),
                                   ("checks/b.py", 'name = "b"\nDescription = "Open port"', "https://x/b")], "path string, content string, url string")
    rules = extract.rule_items(files, *made)
    row = {r.title: r for r in rules.collect()}["Rotate keys"]
    assert (row.source_id, row.body, row.categories, row.raw_metadata) == (
        "s", "Keys are old", ["security"], {"file_path": "checks/a.yaml", "file_type": "yaml", "severity": "high"})
    sections = spark.createDataFrame([("https://x/p", "Heading", "Some body of a section")], "url string, title string, body string")
    pages = extract.page_items(sections, *made)
    assert pages.first().raw_metadata == {"page_url": "https://x/p"}
    schema = "title string, link string, description string, content string, pubDate string, author string, category array<string>"
    entry = spark.createDataFrame([("News", "https://x/n", "<p>" + "long enough " * 6 + "</p>", None, None, None, ["a"])], schema)
    feed = extract.feed_items(entry, *made)
    assert feed.columns == rules.columns == pages.columns and feed.schema["raw_metadata"] is not None
    items = feed.unionByName(rules).unionByName(pages).withColumn("ord", F.xxhash64("url"))
    nothing = spark.createDataFrame([], "position long, scenario string, text string")
    seen = spark.createDataFrame([], "source_id string, content_hash string")
    done = ingest.run(items, seen, nothing, None, None, None, convert=False)
    assert sorted(r.outcome for r in done.collect()) == ["not_converted"] * 4
