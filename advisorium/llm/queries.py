"""The registered queries of the corpus operators: each derives the digest columns of its contract."""

import uuid

from pyspark.sql import functions as F

from advisorium.llm import bpe, byte_bpe as ranked_bpe, exact_dedup, lexical, licenses, main_text, packing, repair, shards, simhash, topk, toxicity, warc
from advisorium.sources.scratch import scratch_root

QUERIES, ORACLES = {}, {}
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name, sql=None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_main_text")
def op1_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract(pages).select("page_id", "url", "text", "n_chars")


@query("op5_shards")
def op5_shards(spark, sf_dir):
    rows = shards.shuffled(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query("op7_archives", """
WITH hashed AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
quads AS (SELECT *, [CAST('0x' || substr(hex, 5 * g + 1, 5) AS BIGINT) FOR g IN range(0, 8)] AS v FROM hashed),
coded AS (SELECT *, [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31), 1)
                     FOR i IN range(0, 32)] AS letters FROM quads)
SELECT page_id, strlen(payload) AS payload_bytes, array_to_string(letters, '') AS payload_digest,
       CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM coded WINDOW same AS (PARTITION BY payload)
""")
def op7_archives(spark, sf_dir):
    path = f"{scratch_root(spark)}/archives-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path, with_payload=False).where("kind = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_exact_dedup", f"""
WITH texts AS (SELECT doc_id, {LOWER_SQL} AS content FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY content)
""")
def op9_exact_dedup(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.assign(documents, carry=["doc_id"]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    rows = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), carry=["doc_id"])
    return rows.select("doc_id", "held_out", "score", "predicted")


@query("op8_simhash")
def op8_simhash(spark, sf_dir):
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return rows.select("doc_id", "fingerprint", "component_id")


@query("op10_top_k", """
WITH numbered AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
                  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
           FROM numbered q, numbered d WHERE q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op10_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def byte_bpe():
    """Where the vocabulary lies; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_packing")
def op2_packing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(documents, byte_bpe(), carry=["doc_id"], with_ids=False).drop("ids")


@query("op6_bpe")
def op6_bpe(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.encode_texts(documents, byte_bpe(), carry=["doc_id"])
    return rows.select("doc_id", "n_tokens", F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_licenses")
def op4_licenses(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(documents, carry=["doc_id"]).select("doc_id", "license", "containment", "position", "windows")


def ranks():
    """Rank file and pattern of the byte-level vocabulary; the operators take any."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query("op13_byte_bpe")
def op13_byte_bpe(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = ranked_bpe.encode_texts(documents, *ranks(), carry=["doc_id"], places=False, decode=True, binary=True)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op12_repair")
def op12_repair(spark, sf_dir):
    rows = repair.damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return repair.repair(rows, copies="copies")


@query("op11_lexical", r"""
WITH lists AS (SELECT doc_id, [translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                               FOR t IN regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')] AS terms FROM documents),
docs AS (SELECT row_number() OVER () AS r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM lists WHERE len(terms) > 0),
sums AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
occurrences AS (SELECT r, unnest(terms) AS term FROM docs),
postings AS (SELECT r, term, count(*) AS tf FROM occurrences GROUP BY r, term),
asked AS (SELECT DISTINCT item_id, unnest([translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                                    FOR t IN regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')]) AS term FROM benchmark),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, sums GROUP BY term, big_n),
stratum AS (SELECT r, doc_id, 100 - 50 + ((50 * n * big_n) // big_l) AS m FROM docs, sums),
sums_of AS (SELECT item_id, s.r, s.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN stratum s USING (r) GROUP BY item_id, s.r, s.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sums_of WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
""")
def op11_lexical(spark, sf_dir):
    index = lexical.build(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lexical.search(index, table(spark, sf_dir, "benchmark").select("item_id", "text"))
