import pytest

from advisorium.llm.main_text import extract, main_text

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>if (a < b) "</p>"</script></head>
<body class="with-sidebar"><nav><ul><li><a href="/">Home</a><li><a href="/a">About us and more</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site work better for you and everyone.</div>
<article><header><h1>A  title</h1></header><p>First&nbsp;paragraph with <a href="x">a link</a> &amp; more.<br>Next line.
<p>Ok.<div class="ad-box">Buy this thing now, it is really cheap today only.</div><pre>code   here</pre>
<section class="comments"><article class="comment"><p>I think that this is a comment of a reader, long enough.</p></article></section>
</article><aside>Related words that are many but not of the article itself at all.</aside>
<form><label>Name</label><input><textarea>abc</textarea></form><footer>&copy; me</footer></body></html>"""


def test_article():
    assert main_text(PAGE) == "A title\n\nFirst paragraph with a link & more. Next line.\n\nOk.\n\ncode here"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<nav><a href=x>Home</a></nav>", ""), ("<article>a<b>b</b>c", "abc"), ("<article><p>cut <scr", "cut"),
    ("<article><p>x<!-- <p>no --> y</article>z", "x y"), ("<div class=ad>never closed<article><p>in</p></article>", "in"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


def test_page_without_article():
    text = "word " * 60
    page = f"<div><a href=a>Home</a> <a href=b>News</a></div><div><p>{text}</p><p>Short one.</p><p>{text}</p></div><div>Menu</div>"
    assert main_text(page) == f"{text.strip()}\n\nShort one.\n\n{text.strip()}"


@pytest.mark.parametrize("wrapper", ["page has-sidebar", "site fixed-header", "social notice"])
def test_wrapper_named_like_boilerplate(wrapper):
    text, side = ("word " * 60).strip(), ("other " * 25).strip()
    page = (f"<div class='{wrapper}'><div class='menu'><a href=a>Home</a></div><p>{text}</p><p>{text}</p>"
            f"<div class='sidebar'><p>{side}</p></div><div class='comments'><p>{text}</p></div></div>")
    assert main_text(page) == f"{text}\n\n{text}"


@pytest.mark.parametrize("name", ["svg", "button", "select", "object", "video"])
def test_silent_element_never_closed(name):
    assert main_text(f"<article><p>before</p><{name} a=b><p>after</p></article>") == "before\n\nafter"
    assert main_text("<article><p>before</p><script>if (a) <p>after</p></article>") == "before"


def test_frame(spark):
    rows = [(1, "u", PAGE, "t", 0), (1, "u", PAGE, None, None), (None, None, None, "x", 1), (2, "v", "<p>" * 2000, None, 1)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    got = extract(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((repr(r.page_id), r.n_chars) for r in got.collect()) == [("1", len(main_text(PAGE)))] * 2 + [("2", 0), ("None", 0)]
    assert extract(frame.limit(0)).collect() == []


@pytest.mark.parametrize("page, text", [
    ("<article><p title=it's>Alpha beta.</p><p>Second para it's</p></article>", "Alpha beta.\n\nSecond para it's"),
    ('<article><p class=x">Text one here.</p></article>', "Text one here."), ("<article><p a = 'x>y' b=\"c>d\" =e f/g>In</p></article>", "In"),
    ('<article><p a="never closed>Text</p><p>More</p></article>', "Text\n\nMore"), ("<article><p \">One</p><p '>Two</p></article>", "One\n\nTwo"),
])
def test_stray_quotes_in_tags(page, text):
    assert main_text(page) == text


def test_tags_against_a_second_parser():
    """Where tags end, on 1,000 generated pages with malformed attributes."""
    import random
    from html.parser import HTMLParser

    from advisorium.llm.main_text import TAG

    class Tags(HTMLParser):
        def handle_starttag(self, tag, attrs):
            self.found.append(tag)

        def handle_endtag(self, tag):
            self.found.append(f"/{tag}")

    rng = random.Random(17)
    pieces = ["a", "title=it's", 'class=x"', 'b="c>d"', "c='e>\"f'", "d = 'g h'", "e =i", "f= j", "/", "k/l", "m='n'o", "hidden", "p=q=r", 's=""', "t=\n'u'"]
    for _ in range(1000):
        page = "".join(f"<{rng.choice(['p', 'div', 'em'])} {' '.join(rng.sample(pieces, rng.randint(0, 5)))} >words 'in' \"it\" = x</{rng.choice(['p', 'div'])}>"
                       for _ in range(rng.randint(1, 4)))
        parser = Tags()
        parser.found = []
        parser.feed(page)
        parser.close()
        assert [m[1] + m[2].lower() for m in TAG.finditer(page)] == [t for t in parser.found], page
