import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from advisorium.llm import byte_bpe
from advisorium.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.conftest import LONG

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["ab", "aa", "Zé", " ", "  ", "\n", "\t", ",", "'s", "'re", "'", "12", "²½", "ж", "漢字", "\x85", " ", "　", "<|endoftext|>",
         "é", "​", "😀", "👩‍👧", "don't", "Word", "\r\n", "----", "====", "0000"]
OTHER = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.ranks_of(PATH), special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.characters(codec="utf-8")), max_size=16).map("".join))
def test_ids_offsets_and_decoding(text):
    ids = byte_bpe.encoded(PATH, PATTERN, [text])[0]
    assert ids.tolist() == OTHER.encode_ordinary(text)
    assert byte_bpe.decoded(PATH, ids) == text.encode()
    starts, ends = byte_bpe.offsets(PATH, ids, text.encode()) if text else ([], [])
    full = byte_bpe.tokenizer(PATH, PATTERN).encode(text, add_special_tokens=False).offsets
    assert list(zip(np.asarray(starts).tolist(), np.asarray(ends).tolist())) == full
    assert "".join(byte_bpe.token_texts(PATH, ids)) == text


def test_runs_of_one_letter_and_long_words():
    generator = random.Random(5)
    texts = [generator.choice(["a", "=", "-", " ", "0", "ab", "é", "\n", "_", "日"]) * n for n in range(1, 200)] + ["xyz" * 30_000]
    got = byte_bpe.encoded(PATH, PATTERN, texts)
    assert [g.tolist() for g in got] == [OTHER.encode_ordinary(t) for t in texts]


def test_split_characters():
    ids = OTHER.encode_ordinary("a😀b")
    cut = ids[:2]  # the list ends inside the character
    assert byte_bpe.decoded(PATH, cut) + byte_bpe.decoded(PATH, ids[2:]) == "a😀b".encode()
    texts = byte_bpe.token_texts(PATH, ids)
    assert "".join(texts) == "a😀b" and "" in texts
    assert "".join(byte_bpe.token_texts(PATH, cut)) == "a�"
    with pytest.raises(ValueError):
        byte_bpe.decoded(PATH, [60_000])
    with pytest.raises(ValueError):
        byte_bpe.decoded(PATH, [-1])


def test_awkward_rows(spark, docs, awkward):
    df = docs([*awkward, (8, "", "1", "2", "3", "4"), (9, "<|endoftext|>"), (10, "漢" * 1000)],
              "doc_id bigint, text string, ids string, n_tokens string, row string, decoded string, starts string")
    got = byte_bpe.encode_texts(df, PATH, PATTERN, decode=True).collect()
    assert len(got) == len(awkward) + 3
    for r in got:
        text = r.text or ""
        assert r.ids == OTHER.encode_ordinary(text) and r.n_tokens == len(r.ids)
        assert bytes(r.decoded) == text.encode() and len(r.starts) == len(r.ends) == len(r.ids)
        assert "".join(text[s:e] for s, e in zip(r.starts, r.ends)) == text or any(ord(c) > 127 for c in text)
    assert any(r.text == LONG for r in got)
    assert byte_bpe.encode_texts(df.limit(0), PATH, PATTERN).collect() == []


def test_decode_ids(spark):
    texts = ["", "one two", "ä😀ж", None]
    rows = [(n, None if t is None else OTHER.encode_ordinary(t), "x") for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "n int, ids array<int>, decoded string")
    got = {r.n: r for r in byte_bpe.decode_ids(df, PATH, each=True).collect()}
    for n, text in enumerate(texts):
        assert got[n].text_of_ids == (text or "") and bytes(got[n].decoded) == (text or "").encode()
        assert "".join(got[n].texts_of_ids) == (text or "")
    assert byte_bpe.decode_ids(df.limit(0), PATH).collect() == []


def test_query_against_the_other_library(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op13_byte_bpe"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = OTHER.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
