"""Byte-level BPE from a rank file: the tokenizers library over Arrow batches, with offsets, and decoding.

A rank file has a line per token: its bytes in base64, and its rank, which is its id. The library works on
letters, so every byte stands for one letter (the byte table) and every token for the word of its letters. Each
way to cut a token into two others is a merge, in order of the token's rank; a match of the pattern that is a
token itself stays whole. So the lowest rank is merged first, as the ranks ask for.

Texts are encoded whole, row by row, where they lie: no shuffle, and no state between rows. Offsets count
characters: a token that holds only a part of a character has that character's place, so the places of two
tokens may overlap there. Decoding puts the letters of the ids in a row and reverses the byte table; the bytes are
read as UTF-8 only then, when the parts of a split character are together again.
"""

import base64
import codecs
import os
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm.shared import batch_of, in_arrow, packed, row_type, unpacked

ENCODED = ("n_tokens", "ids", "starts", "ends", "decoded")
DECODED = ("decoded", "text_of_ids", "texts_of_ids")
TEXTS, LETTERS = 64, 1_000_000  # texts and characters that go to the library at once
OUT_BYTES = 8 << 20  # size of an output batch, about


@lru_cache(maxsize=2)
def ranks_of(path):
    """{bytes of a token: id} of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def byte_letters():
    """The letter of each byte: bytes that show as one letter stand for themselves, the others for letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


def merges_of(ranks):
    """All pairs of tokens that make a token, by the rank of what they make."""
    pairs = []
    for token in sorted(ranks, key=ranks.get):
        cuts = ((token[:i], token[i:]) for i in range(1, len(token)))
        pairs += sorted((p for p in cuts if p[0] in ranks and p[1] in ranks), key=lambda p: (ranks[p[0]], ranks[p[1]]))
    return pairs


@lru_cache(maxsize=2)
def tokenizer(path, pattern):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, letters = ranks_of(path), byte_letters()
    word = lambda token: "".join(letters[b] for b in token)
    model = models.BPE(vocab={word(t): n for t, n in ranks.items()}, merges=[(word(a), word(b)) for a, b in merges_of(ranks)],
                       ignore_merges=True)
    made = Tokenizer(model)
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


def encoded(path, pattern, texts):
    """The ids of each text, as arrays of 32-bit numbers."""
    import numpy as np

    made, out, at = tokenizer(path, pattern), [], 0
    while at < len(texts):
        to, letters = at, 0
        while to < len(texts) and (to == at or (to - at < TEXTS and letters + len(texts[to]) <= LETTERS)):
            letters += len(texts[to])
            to += 1
        out += [np.array(e.ids, "<u4") for e in made.encode_batch_fast(texts[at:to], add_special_tokens=False)]
        at = to
    return out


@lru_cache(maxsize=2)
def byte_table(path):
    """(bytes of all tokens in a row, start of each id, length of each id); ids without a token have length 0."""
    import numpy as np

    letters = byte_letters()
    reverse = {letter: b for b, letter in enumerate(letters)}
    words = {n: "".join(letters[b] for b in token) for token, n in ranks_of(path).items()}
    parts = [bytes(reverse[letter] for letter in words.get(n, "")) for n in range(max(words, default=-1) + 1)]
    lengths = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths


def decoded(path, ids):
    """The bytes of a list of ids; an id that the vocabulary does not have is an error."""
    import numpy as np

    data, starts, lengths = byte_table(path)
    ids = np.asarray(ids, np.int64)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(lengths) or not lengths[ids].all()):
        raise ValueError("an id is not in the vocabulary")
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ids) else 0
    return data[np.arange(total) + np.repeat(starts[ids] - (ends - sizes), sizes)].tobytes()


def offsets(path, ids, content):
    """(starts, ends) in characters of the tokens of a text whose UTF-8 is ``content``."""
    import numpy as np

    sizes = byte_table(path)[2][np.asarray(ids, np.int64)]
    ends = np.cumsum(sizes)
    # the character of each byte: continuation bytes belong to the one before
    character = np.cumsum((np.frombuffer(content, np.uint8) & 0xC0) != 0x80) - 1
    return character[ends - sizes].astype(np.int32), (character[ends - 1] + 1).astype(np.int32)


def token_texts(path, ids):
    """A text for each id; a character split over several tokens is in the text of the last of them.

    Together they are the decoded text. Bytes that are not UTF-8 become U+FFFD.
    """
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    out = [reader.decode(decoded(path, [n])) for n in ids]
    if out:
        out[-1] += reader.decode(b"", True)
    return out


def lists_of(arrays):
    """A list column of the given arrays of 32-bit numbers."""
    import numpy as np
    import pyarrow as pa

    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int32), *[np.asarray(a).astype(np.int32) for a in arrays]])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def encode_batches(batches, schema, path, pattern, decode, binary):
    wanted = set(schema.names)
    for batch in batches:
        rows, column, at = batch.column("row"), batch.column("text"), 0
        while at < batch.num_rows:
            texts, size = [], 0
            while at + len(texts) < batch.num_rows and size < OUT_BYTES // 4:
                texts.append(column[at + len(texts)].as_py())
                size += len(texts[-1])
            ids = encoded(path, pattern, texts)
            out = {"row": rows.slice(at, len(texts)), "n_tokens": [len(i) for i in ids],
                   "ids": [i.tobytes() for i in ids] if binary else lists_of(ids)}
            if "starts" in wanted:
                places = [offsets(path, i, t.encode()) for i, t in zip(ids, texts)]
                out |= {"starts": lists_of([p[0] for p in places]), "ends": lists_of([p[1] for p in places])}
            if decode:
                out["decoded"] = [decoded(path, i) for i in ids]
            yield batch_of(schema, out, len(texts))
            at += len(texts)


def encode_texts(df: DataFrame, path, pattern, text_col="text", carry=None, places=True, decode=False, binary=False) -> DataFrame:
    """The columns ``carry`` of ``df`` (default: all) with n_tokens, ids and, if asked for, places and decoded bytes.

    ``ids`` is an array, or with ``binary`` the little-endian unsigned 32-bit ids in a row. ``places`` adds the arrays
    starts and ends, in characters; ``decode`` adds the bytes that the ids stand for. ``path`` is a rank file that the
    workers can read, ``pattern`` cuts texts before merging. A null text is an empty one: no ids. Repeated rows are
    encoded each on its own, an empty table gives no rows, columns of ``df`` named like a result are replaced.
    """
    names = [n for n in ENCODED if (places or n not in ("starts", "ends")) and (decode or n != "decoded")]
    carry = [c for c in (df.columns if carry is None else carry) if c not in names]
    source = df.select(packed(df, carry), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    kinds = {"n_tokens": "bigint", "ids": "binary" if binary else "array<int>", "starts": "array<int>", "ends": "array<int>",
             "decoded": "binary"}
    fields = [("row", row_type(df, carry)), *[(n, kinds[n]) for n in names]]
    return unpacked(in_arrow(source, encode_batches, fields, path, pattern, decode, binary), carry, {n: F.col(n) for n in names})


def decode_batches(batches, schema, path):
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            lists, size = [], 0
            while at + len(lists) < batch.num_rows and size < OUT_BYTES // 16:
                lists.append(batch.column("ids")[at + len(lists)].as_py())
                size += len(lists[-1])
            found = [decoded(path, ids) for ids in lists]
            out = {"row": batch.column("row").slice(at, len(lists)), "decoded": found,
                   "text_of_ids": [b.decode("utf-8", "replace") for b in found]}
            if "texts_of_ids" in schema.names:
                out["texts_of_ids"] = [token_texts(path, ids) for ids in lists]
            yield batch_of(schema, out, len(lists))
            at += len(lists)


def decode_ids(df: DataFrame, path, ids_col="ids", carry=None, each=False) -> DataFrame:
    """The columns ``carry`` of ``df`` (default: all) with decoded (bytes) and text_of_ids; with ``each`` also a text per id.

    A null list is an empty one. An id outside the vocabulary, or null in a list, fails the job: silence would lose text.
    Bytes that are no UTF-8, as lists cut inside a character give them, show as U+FFFD in the text and are whole in decoded.
    """
    names = DECODED if each else DECODED[:2]
    carry = [c for c in (df.columns if carry is None else carry) if c not in names]
    source = df.select(packed(df, carry), F.coalesce(F.col(f"`{ids_col}`").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    kinds = dict(zip(DECODED, ("binary", "string", "array<string>")))
    fields = [("row", row_type(df, carry)), *[(n, kinds[n]) for n in names]]
    return unpacked(in_arrow(source, decode_batches, fields, path), carry, {n: F.col(n) for n in names})
