"""Items from landed pages, feed entries and rule files."""

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from advisorium.functions import text
from advisorium.operators.filters import passes_content_gate

# The workers need these helpers but may not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BODY_CHARS = 4_000
MIN_PAYLOAD_BYTES = 100


def payload_too_small(column="html", min_bytes: int = MIN_PAYLOAD_BYTES) -> Column:
    """True for a payload that must be treated as a fetch error."""
    return F.coalesce(F.octet_length(column), F.lit(0)) < min_bytes


def without_dots(path: Column) -> Column:
    """A URL path with its . and .. segments resolved."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda done, s: F.when(s == ".", done)
        .when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(s))))
    ends_in_dot = path.rlike("(^|/)\\.\\.?$")
    joined = F.concat(F.array_join(kept, "/"), F.when(ends_in_dot, F.lit("/")).otherwise(F.lit("")))
    return F.when(path.contains("/."), F.regexp_replace(joined, "/+$", "/")).otherwise(path)


def resolve_url(base, reference) -> Column:
    """Absolute URL of a reference found on the page ``base``."""
    base = F.col(base) if isinstance(base, str) else base
    reference = F.col(reference) if isinstance(reference, str) else reference
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    root = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(path, "[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    target = F.regexp_extract(reference, "^([^?#]*)", 1)
    rest = F.regexp_extract(reference, "^[^?#]*(.*)$", 1)
    return (
        F.when(reference == "", base)
        .when(reference.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), reference)
        .when(reference.startswith("//"), F.concat(scheme, reference))
        .when(reference.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), reference))
        .when(reference.startswith("?"), F.concat(root, path, reference))
        .when(reference.startswith("/"), F.concat(root, without_dots(target), rest))
        .otherwise(F.concat(root, without_dots(F.concat(folder, target)), rest)))


def crawl_links(pages: DataFrame, key: str, pattern: str, max_pages: int = 20) -> DataFrame:
    """Links of a page to follow: absolute, matching, distinct, not the page itself, first ones.

    All of it happens inside the row, so the pages are not shuffled.
    """
    tag = F.lit("(?is)<a\\s[^>]*?href\\s*=\\s*[\"']([^\"']*)[\"']")
    found = F.transform(
        F.regexp_extract_all("html", tag, F.lit(1)),
        lambda h: resolve_url(F.col("url"), text.replace_known_entities(text.strip(h))))
    wanted = F.filter(found, lambda u: u.rlike(pattern) & (u != F.col("url")))
    links = F.slice(F.array_distinct(wanted), F.lit(1), F.lit(max_pages))
    return pages.select(key, F.posexplode(links).alias("position", "link"))


# Elements that hold others; those that are often left open in pages are not among them.
CONTAINERS = "(?i)</?(?:html|body|main|article|section|div|aside|header|footer|nav|ul|ol|dl|table|form|blockquote|figure|details)(?:[\\s/][^>]*)?>"


def within_parent(html: Column) -> Column:
    """What follows a place up to where the element that holds it closes."""
    tags, parts = F.regexp_extract_all(html, F.lit(CONTAINERS), F.lit(0)), F.split(html, CONTAINERS)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(-1).alias("cut"))

    def step(state, tag):
        depth = state["depth"] + F.when(tag.startswith("</"), -1).when(tag.endswith("/>"), 0).otherwise(1)
        cut = F.when((state["cut"] < 0) & (depth < 0), state["n"]).otherwise(state["cut"])
        return F.struct(depth.alias("depth"), (state["n"] + 1).alias("n"), cut.alias("cut"))

    cut = F.aggregate(tags, start, step)["cut"]
    return F.when(cut < 0, html).otherwise(F.array_join(F.slice(parts, F.lit(1), cut + 1), " "))


def header_sections(pages: DataFrame, key: str, levels=(2, 3, 4), decode=text.replace_known_entities) -> DataFrame:
    """One row per header of the given levels with the text up to the next header of level 1-4, or
    to where the element that holds the header closes.

    Scripts, styles and comments are dropped. Titles and bodies under the section gate are
    skipped and the body is cut to 4,000 characters.
    """
    hidden = "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
    visible = F.regexp_replace("html", hidden, " ")
    # A mark no page contains starts every header, so that one split yields the sections.
    mark = "\x01"
    marked = F.regexp_replace(visible, "(?i)<(h[1-4])(?=[\\s>])[^>]*>", f"{mark}$1{mark}")
    pieces = F.filter(F.split(marked, f"{mark}(?=[hH][1-4]{mark})"), lambda piece, n: n > 0)
    halves = F.transform(pieces, lambda piece: F.split(piece, "(?i)</h[1-4]\\s*>", 2))
    sections = F.transform(halves, lambda half, n: F.struct(
        n.alias("position"),
        F.lower(F.left(half[0], F.lit(2))).alias("header_level"),
        F.when(F.size(half) == 2, text.strip_html(F.substring(half[0], F.lit(4), F.length(half[0])), decode)).alias("title"),
        F.when(F.size(half) == 2, text.strip_html(within_parent(half[1]), decode)).alias("body")))
    # Gated inside the row: a filter on rows would be pushed down and strip the texts again.
    wanted = [f"h{n}" for n in levels]
    kept = F.filter(sections, lambda s: s["header_level"].isin(*wanted)
                    & F.coalesce(passes_content_gate(s["title"], s["body"], "section"), F.lit(False)))
    return pages.select(key, "url", F.inline(kept)).withColumn("body", F.left("body", F.lit(BODY_CHARS)))


def selected_items(pages: DataFrame, key: str, item: str, title: str = "h2, h3", body: str = "") -> DataFrame:
    """Items found by selectors, for pages with one element per item.

    A selector is a comma list of compound selectors (tag, .class, #id), each optionally inside
    another. Pages are parsed one by one in Arrow batches, where they lie.
    """
    id_field = pages.schema[key]
    selectors = [_selector(s) for s in (item, title, body)]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = {key: [], "url": [], "position": [], "title": [], "body": []}
            for page_id, url, html in zip(*[column.to_pylist() for column in batch.columns]):
                for n, (found_title, found_body) in enumerate(_items(html or "", selectors)):
                    for name, value in zip(out, (page_id, url, n, found_title, found_body)):
                        out[name].append(value)
            arrays = [pa.array(out[key], batch.column(0).type), pa.array(out["url"], pa.string()),
                      pa.array(out["position"], pa.int32()), pa.array(out["title"], pa.string()),
                      pa.array(out["body"], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, list(out))

    found = pages.select(key, "url", "html").mapInArrow(
        run, f"`{key}` {id_field.dataType.simpleString()}, url string, position int, title string, body string")
    return found.filter(passes_content_gate("title", "body", "block"))


def _selector(text_value):
    import re

    choices = []
    for choice in filter(None, (c.strip() for c in text_value.split(","))):
        choices.append([(re.match(r"[\w-]*", part).group().lower(), set(re.findall(r"\.([\w-]+)", part)),
                         set(re.findall(r"#([\w-]+)", part))) for part in choice.split()])
    return choices


def _matches(path, choices):
    """True when the innermost element of ``path`` fits one of the selector's choices."""
    def fits(element, wanted):
        tag, classes, ids = wanted
        return (not tag or element["tag"] == tag) and classes <= element["classes"] and ids <= element["ids"]

    for choice in choices:
        if not fits(path[-1], choice[-1]):
            continue
        outer = iter(reversed(path[:-1]))
        if all(any(fits(element, wanted) for element in outer) for wanted in reversed(choice[:-1])):
            return True
    return False


def _items(html, selectors):
    """(title, body) of every matched element; texts are stripped and put together."""
    from html.parser import HTMLParser

    item_choices, title_choices, body_choices = selectors
    items, open_items, path = [], [], []
    # Elements without an end tag, and elements whose text is not shown.
    void = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
    hidden = {"script", "style"}

    class Walker(HTMLParser):
        def handle_starttag(self, tag, attrs):
            attrs = dict(attrs)
            element = {"tag": tag, "classes": set((attrs.get("class") or "").split()), "ids": {attrs.get("id")}}
            path.append(element)
            for entry in open_items:
                for name, choices in (("title", title_choices), ("body", body_choices)):
                    if entry[name] is None and choices and _matches(path, choices):
                        entry[name], entry[name + "_at"] = [], element
            if _matches(path, item_choices):
                entry = {"at": element, "text": [], "title": None, "body": None, "title_at": None, "body_at": None}
                items.append(entry)
                open_items.append(entry)
            if tag in void:
                self.handle_endtag(tag)

        def handle_endtag(self, tag):
            if any(element["tag"] == tag for element in path):
                while True:
                    closed = path.pop()
                    open_items[:] = [entry for entry in open_items if entry["at"] is not closed]
                    for entry in open_items:
                        for name in ("title_at", "body_at"):
                            if entry[name] is closed:
                                entry[name] = None
                    if closed["tag"] == tag:
                        break

        def handle_data(self, data):
            shown = data.strip()
            if shown and not (path and path[-1]["tag"] in hidden):
                for entry in open_items:
                    entry["text"].append(shown)
                    for name in ("title", "body"):
                        if entry[name + "_at"] is not None:
                            entry[name].append(shown)

    walker = Walker(convert_charrefs=True)
    walker.feed(html)
    walker.close()
    return [("".join(entry["title"] or []), "".join(entry["body"] if entry["body"] is not None else entry["text"]))
            for entry in items]


def feed_items(entries: DataFrame, source_id: Column, source_name: Column, categories: Column,
               decode=text.replace_known_entities) -> DataFrame:
    """Feed entries as raw items; entries without a title or with a short body are skipped."""
    body = text.strip_html(F.coalesce(F.nullif("content", F.lit("")), F.nullif("description", F.lit(""))), decode)
    tags = F.array_join(F.coalesce("category", F.array().cast("array<string>")), ", ")
    made = F.array(F.struct(
        text.strip(F.coalesce("title", F.lit(""))).alias("title"), body.alias("body"), F.coalesce("link", F.lit("")).alias("url"),
        text.iso_timestamp(text.feed_date("pubDate")).alias("published_at"),
        F.create_map(F.lit("tags"), tags, F.lit("author"), F.coalesce("author", F.lit(""))).alias("raw_metadata")))
    # Gated inside the row: a filter on rows would be pushed down and strip the texts again.
    kept = entries.select(
        source_id.alias("source_id"), source_name.alias("source_name"), categories.alias("categories"),
        F.inline(F.filter(made, lambda i: passes_content_gate(i["title"], i["body"], "feed"))))
    return kept.select("source_id", "source_name", "title", "body", "url", "published_at",
                       text.content_hash("title", "body").alias("content_hash"), "categories", "raw_metadata")


def rule_file_items(files: DataFrame) -> DataFrame:
    """Items of rule files (path, content, url), by the kind of file its name tells.

    Yields path, url, title, body (4,000 characters), file_type, severity and service.
    """
    # How rule files spell their fields.
    py = {
        "name": r"""(?:CheckID|check_id|name)\s*=\s*["']([^"']+)["']""",
        "description": r"""(?:Description|description|desc)\s*=\s*["']([^"']+)["']""",
        "severity": r"""(?:Severity|severity|risk)\s*=\s*["']([^"']+)["']""",
        "service": r"""(?:ServiceName|service_name|service)\s*=\s*["']([^"']+)["']""",
        "class": r'(?s)class\s+(\w+)\s*\(.*?\):\s*"""(.*?)"""',
        "docstring": r'(?s)"""(.*?)"""',
    }
    yaml = {
        "name": r"(?m)^\s*-?\s*(?:name|title|id)\s*:\s*(.+)",
        "description": r"""(?m)(?:description|desc|message)\s*:\s*["']?(.+?)["']?\s*$""",
        "severity": r"(?:severity|risk|level)\s*:\s*(.+)",
    }
    helpers = ("__init__", "models", "lib", "utils", "common")

    found = lambda regex, group=1: F.nullif(F.regexp_extract("content", regex, group), F.lit(""))
    unquoted = lambda c: F.trim(text.strip(c), F.lit("'\""))
    path, name = F.col("path"), text.base_name("path")
    is_py, is_yaml = path.endswith(".py"), path.endswith(".yaml") | path.endswith(".yml")
    is_json = path.endswith(".json")
    kind = F.when(is_py, "python").when(is_yaml, "yaml").when(is_json, "json").otherwise("generic")
    typed = files.withColumn("file_type", kind)

    stem = F.regexp_replace(name, r"\.py", "")
    class_name = F.when(found(py["name"]).isNull(), found(py["class"], 1))
    py_title = F.coalesce(found(py["name"]), class_name, F.replace(stem, F.lit("_"), F.lit(" ")))
    given = F.nullif(text.strip(F.when(class_name.isNotNull(), found(py["class"], 2))), F.lit(""))
    docstring = F.nullif(text.strip(found(py["docstring"])), F.lit(""))
    py_body = F.coalesce(given, found(py["description"]), docstring, F.concat(F.lit("Security check from "), path))
    is_helper = is_py & stem.isin(*helpers) & found(py["name"]).isNull() & found(py["class"], 1).isNull()

    yaml_title = F.coalesce(unquoted(found(yaml["name"])), name)
    yaml_body = F.coalesce(text.strip(found(yaml["description"])), F.left("content", F.lit(500)))

    texts = typed.filter((F.col("file_type") != "json") & ~is_helper).select(
        "path", "url", "file_type",
        F.when(is_py, py_title).when(is_yaml, yaml_title).otherwise(name).alias("title"),
        F.when(is_py, py_body).when(is_yaml, yaml_body).otherwise(F.col("content")).alias("body"),
        F.when(is_py, found(py["severity"])).when(is_yaml, unquoted(found(yaml["severity"]))).alias("severity"),
        F.when(is_py, found(py["service"])).alias("service"))

    value = F.try_parse_json("content")
    listed = F.when(F.schema_of_variant(value).startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>"))
    single = F.when(F.schema_of_variant(value).startswith("OBJECT"), F.array(value))
    rules = typed.filter(F.col("file_type") == "json").select(
        "path", "url", "file_type", F.explode(F.coalesce(listed, single)).alias("rule"))
    field = lambda n: F.nullif(F.try_variant_get("rule", f"$.{n}", "string"), F.lit(""))
    of_json = rules.select(
        "path", "url", "file_type",
        F.coalesce(field("name"), field("title"), field("id")).alias("title"),
        F.coalesce(field("description"), field("message"), F.to_json("rule")).alias("body"),
        F.lit(None).cast("string").alias("severity"), F.lit(None).cast("string").alias("service"),
    ).filter(F.col("title").isNotNull())

    return texts.unionByName(of_json).withColumn("body", F.left("body", F.lit(BODY_CHARS)))


def prompt_text(source_name, title, url, categories) -> Column:
    """Prompt of the conversion step, with the body cut to 4,000 characters."""
    shown = lambda c: F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return F.concat(
        F.lit("Source: "), shown(source_name), F.lit("\nTitle: "), shown(title), F.lit("\nURL: "), shown(url),
        F.lit("\nCategories: "), shown(categories), F.lit("\n\nContent:\n"), F.left(shown("body"), F.lit(BODY_CHARS)))


def rule_items(files: DataFrame, source_id: Column, source_name: Column, categories: Column) -> DataFrame:
    """Items of rule files in the shape of ``feed_items``, so that both go through one run."""
    extra = F.create_map(*[x for n in ("file_path", "file_type", "severity", "service")
                           for x in (F.lit(n), F.col({"file_path": "path"}.get(n, n)))])
    return rule_file_items(files).select(
        source_id.alias("source_id"), source_name.alias("source_name"), "title", "body", "url", F.lit(None).cast("string").alias("published_at"),
        text.content_hash("title", "body").alias("content_hash"), categories.alias("categories"),
        F.map_filter(extra, lambda _, v: v.isNotNull()).alias("raw_metadata"))


def page_items(sections: DataFrame, source_id: Column, source_name: Column, categories: Column) -> DataFrame:
    """Items of page sections (url, title, body) in the shape of ``feed_items``."""
    return sections.select(
        source_id.alias("source_id"), source_name.alias("source_name"), "title", "body", "url", F.lit(None).cast("string").alias("published_at"),
        text.content_hash("title", "body").alias("content_hash"), categories.alias("categories"),
        F.create_map(F.lit("page_url"), F.col("url")).alias("raw_metadata"))
