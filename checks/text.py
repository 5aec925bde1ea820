"""Text queries: hashes, markup, links, sections, similarity."""

from pyspark.sql import functions as F

from advisorium.functions import text
from advisorium.functions.stop_words import ENGLISH
from advisorium.operators import extract, filters, similarity
from advisorium.sources.scratch import written
from checks.registry import query
from checks.views import RAW_ITEMS_SQL, existing, raw_items, table

I = "WITH " + RAW_ITEMS_SQL

# Items ------------------------------------------------------------------------------------------

query("c7_content_hash", I + "SELECT ord, content_hash FROM raw_items")(
    lambda spark, sf: raw_items(spark, sf).select("ord", "content_hash"))
_GATE = """SELECT ord, length(title) >= 1 AND length(body) >= 50 AS feed, length(title) >= 1 AND length(body) >= 20 AS block,
 length(title) >= 5 AND length(body) >= 50 AS section FROM raw_items"""
query("f15_content_gates", I + _GATE)(lambda spark, sf: raw_items(spark, sf).select(
    "ord", *[filters.passes_content_gate("title", "body", kind).alias(kind) for kind in filters.MINIMUM_CONTENT]))
query("x7_prompt_text", I + """SELECT ord, 'Source: ' || source_id || chr(10) || 'Title: ' || title || chr(10) || 'URL: ' || chr(10) || 'Categories: security' || chr(10) || chr(10)
 || 'Content:' || chr(10) || left(body, 4000) AS prompt FROM raw_items""")(
    lambda spark, sf: raw_items(spark, sf).select("ord", extract.prompt_text("source_id", "title", F.lit(""), F.lit("security")).alias("prompt")))

# Pages ------------------------------------------------------------------------------------------

query("s7_page_scan", "SELECT page_id, url, length(html) AS n FROM pages")(
    lambda spark, sf: table(spark, sf, "pages").select("page_id", "url", F.length("html").cast("long").alias("n")))
query("s8_payload_guard", "SELECT page_id, octet_length(encode(html)) < 100 AS page_too_small, octet_length(encode(url)) < 100 AS url_too_small FROM pages")(
    lambda spark, sf: table(spark, sf, "pages").select(
        "page_id", extract.payload_too_small("html").alias("page_too_small"), extract.payload_too_small("url").alias("url_too_small")))



def _decoded(value):
    """Known entities decoded, with or without their semicolon."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", None), ("#39", "''"), ("amp", "&")):
        after = "chr(160) || '\\2'" if char is None else f"'{char}\\2'"
        value = f"regexp_replace({value}, '&{name}(;|([^A-Za-z0-9;])|$)', {after}, 'g')"
    return value


_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _text_sql(markup):
    untagged = f"regexp_replace({markup}, '<[^>]+>', ' ', 'g')"
    return f"trim(regexp_replace({_decoded(untagged)}, '{_SPACE}', ' ', 'g'))"


query("c8_strip_html", f"SELECT page_id, {_text_sql('html')} AS text FROM pages")(
    lambda spark, sf: table(spark, sf, "pages").select("page_id", text.strip_html("html").alias("text")))
query("x5_unescape_all", f"SELECT page_id, {_text_sql('html')} AS text FROM pages")(
    lambda spark, sf: table(spark, sf, "pages").select("page_id", text.strip_html("html", text.html_unescape()).alias("text")))

_HREF = """(?is)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']"""
query("s11_crawl_links", f"""WITH h AS (SELECT page_id, url, regexp_extract_all(html, '{_HREF}', 1) AS hrefs FROM pages),
u AS (SELECT page_id, url, i, trim(hrefs[i]) AS h FROM (SELECT page_id, url, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM h) t),
r AS (SELECT page_id, url, i, CASE WHEN h = '' THEN url WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN h
 WHEN h LIKE '//%' THEN regexp_extract(url, '^([A-Za-z]+:)', 1) || h WHEN h LIKE '#%' THEN regexp_replace(url, '#.*$', '') || h
 WHEN h LIKE '/%' THEN regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || h END AS link FROM u),
d AS (SELECT page_id, link, min(i) AS i FROM (SELECT page_id, i, {_decoded('link')} AS link, url FROM r) t WHERE link <> url AND regexp_matches(link, 'example') GROUP BY 1, 2)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INT) AS position, link FROM d QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY i) <= 20""")(
    lambda spark, sf: extract.crawl_links(table(spark, sf, "pages"), "page_id", "example"))

_HIDDEN = "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
_HOLDS = extract.CONTAINERS
_SECTIONS = f"""WITH v AS (SELECT page_id, url, regexp_replace(html, '{_HIDDEN}', ' ', 'g') AS html FROM pages),
m AS (SELECT page_id, url, string_split(regexp_replace(html, '(?i)<(h[1-4])(\\s[^>]*)?>', chr(1) || chr(1) || '\\1' || chr(2), 'g'), chr(1) || chr(1)) AS p FROM v),
e AS (SELECT page_id, url, i - 2 AS position, p[i] AS piece FROM (SELECT page_id, url, p, unnest(range(2, len(p) + 1)) AS i FROM m) t),
b AS (SELECT *, regexp_extract(piece, '(?is)^h[1-4]' || chr(2) || '.*?</h[1-4]\\s*>(.*)$', 1) AS raw FROM e),
t AS (SELECT *, regexp_extract_all(raw, '{_HOLDS}', 0) AS tags FROM b),
n AS (SELECT *, list_position([list_sum([CASE WHEN x LIKE '</%' THEN -1 WHEN x LIKE '%/>' THEN 0 ELSE 1 END FOR x IN tags[1:i]]) FOR i IN range(1, len(tags) + 1)], -1) AS cut FROM t),
w AS (SELECT *, CASE WHEN cut > 0 THEN array_to_string(regexp_split_to_array(raw, '{_HOLDS}')[1:cut], ' ') ELSE raw END AS own FROM n),
s AS (SELECT page_id, url, position, lower(left(piece, 2)) AS header_level, {_text_sql("regexp_extract(piece, '(?is)^h[1-4]' || chr(2) || '(.*?)</h[1-4]\\s*>', 1)")} AS title,
 {_text_sql("own")} AS body FROM w)
SELECT page_id, url, CAST(position AS INT) AS position, header_level, title, left(body, 4000) AS body FROM s WHERE length(title) >= 5 AND length(body) >= 50 AND header_level = 'h1'"""
query("x4_header_sections", _SECTIONS)(lambda spark, sf: extract.header_sections(table(spark, sf, "pages"), "page_id", levels=(1,)))


def _glued(markup):
    """Pieces of text between tags, each stripped, put together. No page holds an encoded < or >."""
    visible = _decoded(f"regexp_replace({markup}, '{_HIDDEN}', '<x>', 'g')")
    return f"trim(regexp_replace({visible}, '\\s*<[^>]+>\\s*', '', 'g'))"


query("x4_selected_items", f"""WITH a AS (SELECT page_id, url, regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1) AS part FROM pages),
s AS (SELECT page_id, url, {_glued("regexp_extract(part, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS title, {_glued('part')} AS body FROM a)
SELECT page_id, url, 0 AS position, title, body FROM s WHERE length(title) >= 1 AND length(body) >= 20""")(
    lambda spark, sf: extract.selected_items(table(spark, sf, "pages"), "page_id", "article", "h1"))

# Similarity -------------------------------------------------------------------------------------


def tfidf_sql(new, old, prefix=""):
    """Common table expressions ending in best(key, score, position), by the plain formula."""
    stop = "[" + ", ".join(f"'{w}'" for w in ENGLISH) + "]"
    words = "list_filter(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'), lambda w: NOT list_contains(" + stop + ", w))"
    pairs = "list_concat(ws, list_transform(range(1, greatest(len(ws), 1)), lambda i: ws[i] || ' ' || ws[i + 1]))"
    return f"""old_t AS (SELECT position, unnest({pairs}) AS term FROM (SELECT position, {words} AS ws FROM ({old}) o) t),
old_tf AS (SELECT position, term, count(*) AS tf FROM old_t GROUP BY 1, 2),
vocab AS (SELECT term, ln((1 + (SELECT count(*) FROM ({old}) o)) / (1 + count(*))) + 1 AS idf FROM old_tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 5000),
old_w AS (SELECT position, term, tf * idf AS w FROM old_tf JOIN vocab USING (term)),
old_n AS (SELECT position, sqrt(sum(w * w)) AS len FROM old_w GROUP BY 1),
new_t AS (SELECT key, unnest({pairs}) AS term FROM (SELECT key, {words} AS ws FROM ({new}) o) t),
new_w AS (SELECT key, term, count(*) * any_value(idf) AS w FROM new_t JOIN vocab USING (term) GROUP BY 1, 2),
new_n AS (SELECT key, sqrt(sum(w * w)) AS len FROM new_w GROUP BY 1),
dots AS (SELECT key, position, round(sum(n.w / new_n.len * (o.w / old_n.len)), 9) AS score FROM new_w n JOIN old_w o USING (term)
 JOIN new_n USING (key) JOIN old_n USING (position) GROUP BY 1, 2),
tops AS (SELECT key, score, position FROM dots QUALIFY row_number() OVER (PARTITION BY key ORDER BY score DESC, position) = 1),
best AS (SELECT a.key, coalesce(t.score, 0) AS score, coalesce(t.position, (SELECT min(position) FROM ({old}) o)) AS position
 FROM ({new}) a LEFT JOIN tops t USING (key))
"""


_X1 = "WITH " + tfidf_sql("SELECT doc_id AS key, text FROM documents", "SELECT item_id AS position, text FROM benchmark")


def _nearest(spark, sf, **options):
    return similarity.duplicates(table(spark, sf, "documents"), existing(spark, sf), "doc_id", "text", "text", "position", "scenario", **options)


query("x1_nearest_existing", _X1 + """SELECT key AS doc_id, round(score, 4) AS score, position, b.text AS closest, round(score, 4) >= 0.7 AS is_duplicate
FROM best JOIN benchmark b ON b.item_id = position""")(_nearest)
query("x2_duplicate_flag", _X1 + "SELECT key AS doc_id, round(score, 4) >= 0.3 AS is_duplicate FROM best")(
    lambda spark, sf: _nearest(spark, sf, threshold=0.3).select("doc_id", "is_duplicate"))
query("j7_nearest_join", _X1 + "SELECT position, count(*) AS items, round(max(score), 4) AS top FROM best GROUP BY 1")(
    lambda spark, sf: similarity.score(
        table(spark, sf, "documents"), similarity.fit(existing(spark, sf), "text", "position"), "doc_id", "text").groupBy("position").agg(
        F.count(F.lit(1)).alias("items"), F.round(F.max("score"), 4).alias("top")))
query("w7_first_best", _X1 + "SELECT key AS doc_id, position FROM best")(
    lambda spark, sf: _nearest(spark, sf).select("doc_id", "position"))

# Vectors of documents and of existing items share one table: vec_id is the number of either.
_X3 = _X1 + """, nv AS (SELECT vec_id AS key, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IN (SELECT key FROM best WHERE round(score, 4) < 0.7)),
ov AS (SELECT item_id AS position, CAST(embedding AS DOUBLE[]) AS v FROM benchmark JOIN embeddings ON vec_id = item_id),
sem AS (SELECT key, position, round(list_cosine_similarity(nv.v, ov.v), 9) AS score FROM nv, ov),
sem1 AS (SELECT * FROM sem QUALIFY row_number() OVER (PARTITION BY key ORDER BY score DESC, position) = 1)
SELECT b.key AS doc_id, round(CASE WHEN s.score > b.score THEN s.score ELSE b.score END, 4) AS score,
 CASE WHEN s.score > b.score THEN s.position ELSE b.position END AS position, coalesce(s.score > b.score, false) AS raised
FROM best b LEFT JOIN sem1 s ON s.key = b.key"""


@query("x3_second_pass", _X3)
def _second_pass(spark, sf):
    vectors = table(spark, sf, "embeddings")
    old = existing(spark, sf)
    scored = similarity.score(table(spark, sf, "documents"), similarity.fit(old, "text", "position"), "doc_id", "text")
    scored = written(scored, "scores")
    below = scored.filter(F.round("score", 4) < similarity.DUPLICATE_THRESHOLD).select("doc_id")
    new_vectors = below.join(vectors.select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id")
    old_vectors = old.select("position").join(vectors.select(F.col("vec_id").alias("position"), "embedding"), "position")
    semantic = similarity.nearest_vectors(new_vectors, old_vectors, "doc_id", "embedding", "position")
    done = similarity.second_pass(scored.withColumn("score", F.round("score", 9)), semantic, "doc_id")
    return done.select("doc_id", F.round("score", 4).alias("score"), "position", "raised")
