import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from advisorium.llm import bpe

PARTS = ["ab", "Zé", " ", "  ", "\n", "\t", ",", ".", "'s", "'re", "#", "12", "²½", "ªʰ", "ж", "漢", "\x1c", "\x85", " ", "　",
         "<|endoftext|>", "<|", "é", "​", "😀", "don't", "Word", "\r\n"]


def plain(path, text):
    return bpe.tokenizer(path).encode(text, add_special_tokens=False).ids


def by_words(path, text):
    words = bpe.words_of(text, bpe.added_tokens(path))
    assert "".join(words) == text
    return [i for ids in bpe.encoded(path, words) for i in np.frombuffer(ids, "<u4").tolist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.characters(codec="utf-8")), max_size=14).map("".join))
def test_words_give_the_ids_of_the_text(path, text):
    ids = plain(path, text)
    assert by_words(path, text) == ids
    assert bpe.decoded(ids, bpe.pieces(path)) == bpe.tokenizer(path).decode(ids, skip_special_tokens=False)


def test_every_letter_up_to_0x400(path):
    for code in range(0x400):
        text = f"ab{chr(code)}cd {chr(code)}e1{chr(code)} {chr(code)}.{chr(code)}"
        assert by_words(path, text) == plain(path, text), hex(code)


def test_decoding_of_broken_bytes(path):
    generator = random.Random(1)
    for _ in range(300):
        ids = [generator.randrange(50257) for _ in range(6)]
        assert bpe.decoded(ids, bpe.pieces(path)) == bpe.tokenizer(path).decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("block_bytes, buckets", [(1 << 25, 4), (10, 3)])
def test_frame(docs, awkward, path, block_bytes, buckets):
    rows = awkward + [(60, "the end<|endoftext|> again"), (61, "it's  so\n\n new"), (60, "the end<|endoftext|> again")]
    found = bpe.encode_texts(docs(rows), path, block_bytes=block_bytes, buckets=buckets)
    got = sorted((repr(r.doc_id), r.text or "", r.n_tokens, r.ids, r.decoded) for r in found.collect())
    assert got == sorted((repr(n), t or "", len(plain(path, t or "")), plain(path, t or ""), t or "") for n, t in rows)
    assert bpe.encode_texts(docs(rows).limit(0), path).collect() == []


def test_query_digests(spark, path):
    from advisorium.llm.queries import QUERIES
    from tests.conftest import SMALL

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op6_bpe"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = plain(path, texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
