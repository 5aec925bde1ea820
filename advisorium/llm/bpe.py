"""Byte-level BPE over a corpus through a table of distinct words, and decoding through a table of pieces.

A word is a stretch of text between two places across which the tokenizer never joins, so the ids of a text are
the ids of its words in a row. Spark splits the texts in blocks of bounded size. A block keeps its texts as
positions in its own list of distinct words, and sends that list out by hash buckets; a bucket encodes each
distinct word of the corpus once and answers every block; a block puts the ids in their places. So what is
shuffled is one word per block, not one per place, and no task holds more than a block or a bucket.

Decoding joins each id with its piece (the vocabulary is of fixed size) and reads the joined bytes as UTF-8.
"""

import os
import pickle
import re
import zlib
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm.shared import batch_of, in_arrow, packed, row_type, unpacked, written

# Letters below U+0250. Texts with other letters, apostrophes or white space in a row are cut at spaces only.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
COARSE = re.compile(r"\s\s|['ɐ-\U0010ffff]")
SPACED = bytes(32 if chr(c).isspace() else c for c in range(256))
FINE_WORD = re.compile(f" ?[{LETTERS}]+|(?:[^ {LETTERS}]| (?![{LETTERS}]))+")
INNER_SPACE = re.compile(r"(?= \S)")
TABLE = [("block", "bigint"), ("bucket", "int"), ("payload", "binary")]
RESULTS = ("n_tokens", "ids", "decoded")


def words_of(text, added=()):
    """The words of a text; together they are the text.

    The tokenizer begins anew at a space before a visible character. It also does where a letter meets a digit
    or a mark, but not always at apostrophes and in runs of white space. Texts with an added token stay whole.
    """
    if any(token in text for token in added):
        return [text]
    try:  # most texts have single bytes, for which the test is quick
        coarse = "'" in text or b"  " in text.encode("latin-1").translate(SPACED)
    except UnicodeEncodeError:
        coarse = COARSE.search(text)
    if coarse:
        return INNER_SPACE.split(text)
    return FINE_WORD.findall(text)


class Numbers(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


@lru_cache(maxsize=2)
def tokenizer(path):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@lru_cache(maxsize=2)
def added_tokens(path):
    return tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


def encoded(path, words):
    """The ids of every word, as little-endian 32-bit numbers."""
    import numpy as np

    made, out = tokenizer(path), []
    for at in range(0, len(words), 1000):
        out += [np.array(e.ids, "<u4").tobytes() for e in made.encode_batch_fast(words[at:at + 1000], add_special_tokens=False)]
    return out


@lru_cache(maxsize=2)
def pieces(path):
    """The bytes of every id: the letters of byte-level pieces stand for bytes, added tokens for themselves."""
    made = tokenizer(path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)) - set(plain))
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    added = made.get_added_tokens_decoder()
    out = [b""] * made.get_vocab_size(True)
    for piece, number in made.get_vocab(True).items():
        out[number] = added[number].content.encode() if number in added else bytes(letters[c] for c in piece)
    return out


def decoded(ids, table):
    """The text of a list of ids."""
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")


def planes(numbers):
    """32-bit numbers byte by byte: first all lowest bytes, which leaves long runs of zeros to compress."""
    import numpy as np

    return np.ascontiguousarray(np.asarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def numbers_of(plane_bytes):
    import numpy as np

    return np.ascontiguousarray(np.frombuffer(plane_bytes, np.uint8).reshape(4, -1).T).reshape(-1).view("<u4")


def first_seen(codes):
    """Codes that count up by first appearance, with 0 where a code is new and one more than the code elsewhere."""
    import numpy as np

    known = np.maximum.accumulate(np.concatenate([[-1], codes.astype(np.int64)]))[:-1]
    return np.where(codes > known, 0, codes.astype(np.int64) + 1).astype("<u4")


def numbered(marks):
    """The codes that ``first_seen`` has marked."""
    import numpy as np

    new, codes = marks == 0, marks.astype(np.int64) - 1
    codes[new] = np.arange(new.sum())
    return codes


def squeezed(value):
    import zstandard

    return zstandard.ZstdCompressor(level=6).compress(pickle.dumps(value, pickle.HIGHEST_PROTOCOL))


def opened(payload):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


def joined(values):
    return planes([len(v) for v in values]), b"".join(values)


def parted(lengths, data):
    ends = numbers_of(lengths).cumsum(dtype="int64").tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def blocks_of(batches, schema, path, buckets, block_bytes):
    """The rows of each block: its texts (bucket null) and its distinct words by bucket."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    added, block = added_tokens(path), TaskContext.get().partitionId() << 36

    def rows_of(rows, index, codes, lengths):
        words = [w.encode() for w in index]
        places = [zlib.crc32(w) % buckets for w in words]
        lists = {}
        for place, word in zip(places, words):
            lists.setdefault(place, []).append(word)
        kept = pa.RecordBatch.from_arrays([rows], names=["row"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kept.schema) as stream:
            stream.write_batch(kept)
        texts = squeezed((sink.getvalue().to_pybytes(), planes(lengths), planes(first_seen(np.concatenate(codes))), planes(places)))
        columns = {"block": [block] * (len(lists) + 1), "bucket": [None, *lists],
                   "payload": [texts, *[squeezed(joined(v)) for v in lists.values()]]}
        return batch_of(schema, columns, len(lists) + 1)

    for batch in batches:
        first, size, index, codes, lengths = 0, 0, Numbers(), [], []
        for n, text in enumerate(batch.column("text")):
            text = text.as_py()
            words = words_of(text, added)
            codes.append(np.fromiter(map(index.__getitem__, words), "<u4", len(words)))
            lengths.append(len(words))
            size += len(text)
            if size >= block_bytes or n == batch.num_rows - 1:
                yield rows_of(batch.column("row").slice(first, n + 1 - first), index, codes, lengths)
                block += 1
                first, size, index, codes, lengths = n + 1, 0, Numbers(), [], []


def in_groups(batches, name):
    """The rows of batches sorted by column ``name``, one group after the other."""
    def rows():
        for batch in batches:
            columns = [batch.column(c) for c in batch.schema.names]
            for i in range(batch.num_rows):
                yield {c: column[i].as_py() for c, column in zip(batch.schema.names, columns)}

    return groupby(rows(), itemgetter(name))


def answers(batches, schema, path):
    """The ids of each block's words of a bucket; every distinct word is encoded once."""
    for _, rows in in_groups(batches, "bucket"):
        known = {}
        for row in rows:
            words = parted(*opened(row["payload"]))
            new = [w for w in words if w not in known]
            known.update(zip(new, encoded(path, [w.decode() for w in new])))
            yield batch_of(schema, {"block": [row["block"]], "bucket": [row["bucket"]],
                                    "payload": [squeezed(joined([known[w] for w in words]))]}, 1)


def filled(batches, schema, finish):
    """The rows of each block with what ``finish(row column, [ids of each text])`` makes of its ids."""
    import numpy as np
    import pyarrow as pa

    for _, rows in in_groups(batches, "block"):
        texts, lists = None, {}
        for row in rows:
            if row["bucket"] is None:
                texts = opened(row["payload"])
            else:
                lists[row["bucket"]] = iter(parted(*opened(row["payload"])))
        kept, lengths, codes, places = texts
        ids = [next(lists[place]) for place in numbers_of(places).tolist()]
        kept = pa.ipc.open_stream(kept).read_all().column("row").combine_chunks()
        ends = numbers_of(lengths).cumsum(dtype=np.int64).tolist()
        codes, at = numbered(numbers_of(codes)), 0
        while at < len(ends):  # a few texts at a time
            to = at + 1
            while to < len(ends) and to - at < 2000 and ends[to] - (ends[at - 1] if at else 0) < 500_000:
                to += 1
            own = [b"".join([ids[c] for c in codes[(ends[i - 1] if i else 0):ends[i]].tolist()]) for i in range(at, to)]
            yield batch_of(schema, {"row": kept.slice(at, to - at), **finish(own)}, to - at)
            at = to


def encode(df: DataFrame, path, finish, results, text_col="text", carry=None, buckets=None, block_bytes=32 << 20) -> DataFrame:
    """The rows of ``df`` (columns ``carry``) as the struct ``row``, with the columns ``results`` that ``finish`` gives."""
    carry = list(df.columns if carry is None else carry)
    source = df.select(packed(df, carry), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = written(in_arrow(source, blocks_of, TABLE, path, buckets, block_bytes), "blocks")
    words = table.where("bucket IS NOT NULL").repartition("bucket").sortWithinPartitions("bucket", "block")
    replies = in_arrow(words, answers, TABLE, path)
    together = table.where("bucket IS NULL").unionAll(replies).repartition("block").sortWithinPartitions("block", "bucket")
    return in_arrow(together, filled, [("row", row_type(df, carry)), *results], finish)


def encode_texts(df: DataFrame, path, text_col="text", carry=None, decode=True, **options) -> DataFrame:
    """The rows of ``df`` with n_tokens, ids (array) and, if asked for, decoded: the text that the ids stand for.

    A null text is an empty one, without ids. Repeated rows are encoded each on its own; an empty table gives no
    rows; columns of ``df`` named like a result are replaced.
    """
    carry = [c for c in (df.columns if carry is None else carry) if c not in RESULTS]

    def finish(own):
        import numpy as np

        lists = [np.frombuffer(ids, "<u4").tolist() for ids in own]
        texts = [decoded(ids, pieces(path)) for ids in lists] if decode else [None] * len(lists)
        return {"n_tokens": [len(ids) for ids in lists], "ids": lists, "decoded": texts}

    rows = encode(df, path, finish, [("n_tokens", "bigint"), ("ids", "array<int>"), ("decoded", "string")], text_col, carry, **options)
    return unpacked(rows, carry, {n: F.col(n) for n in RESULTS})
