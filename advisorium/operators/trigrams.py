"""Substring search through an index of trigrams.

The index tells for every three letters in a row that a lower-case text of an entry holds which entries hold them. A row is
(trigram, ids): the ids of one block of entries that have it. A text contains a term only if it holds all trigrams of the
term, so a search reads the rows of these, keeps the ids that have all of them, and verifies the term on those entries alone.
Blocks are of bounded size and stay where their entries were read: nothing is shuffled, and the work is linear in the letters.
Every file is in order of the trigrams, so a search reads only the parts where its own lie. A term of one or two letters has
no trigram; it is a scan by definition.
"""

import sys
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

# The workers need these helpers but may not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LETTERS_AT_ONCE = 2_000_000  # letters of a block; a longer entry is a block alone
SEARCHED = ("scenario", "recommendation_description_detailed", "recommendation_action")


def trigrams_of(text: Column) -> Column:
    """The different trigrams of a lower-case text."""
    letters = F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != "")
    n = F.greatest(F.size(letters) - 2, F.lit(0))
    part = lambda start: F.slice(letters, F.lit(start), n)
    pairs = F.zip_with(part(1), part(2), lambda a, b: F.concat(a, b))
    return F.array_distinct(F.zip_with(pairs, part(3), lambda a, b: F.concat(a, b)))


def postings(texts, ids):
    """(trigrams, ids lists) of a block: ``texts`` are Arrow columns of lower-case texts, one value for each of ``ids``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    found = []
    for column in texts:
        column = pc.fill_null(column, "")
        lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        letters = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le"), "<u4").astype(np.int64)
        rows = np.repeat(np.arange(len(lengths)), lengths)
        if len(letters) < 3:
            continue
        inside = rows[2:] == rows[:-2]
        code = letters[:-2] << 42 | letters[1:-1] << 21 | letters[2:]
        found.append(np.stack((code[inside], rows[:-2][inside])))
    if not found:
        return [], pa.array([], pa.list_(ids.type))
    code, row = np.concatenate(found, axis=1)
    del found
    # numbers below the count of the different trigrams, so that a pair of trigram and row is one number
    names, code = np.unique(code, return_inverse=True)
    code, row = np.divmod(np.unique(code * len(ids) + row), len(ids))
    starts = np.searchsorted(code, np.arange(len(names) + 1))
    words = np.stack((names >> 42, names >> 21 & 0x1FFFFF, names & 0x1FFFFF), 1).astype("<u4").tobytes().decode("utf-32-le")
    return [words[i:i + 3] for i in range(0, len(words), 3)], pa.ListArray.from_arrays(pa.array(starts, pa.int32()), ids.take(pa.array(row)))


def _indexed(batches):
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        texts = [pc.cast(c, pa.string()) for c in batch.columns[1:]]
        sizes = sum((pc.fill_null(pc.utf8_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in texts), np.zeros(batch.num_rows, np.int64))
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LETTERS_AT_ONCE, "right")))
            names, lists = postings([c.slice(at, to - at) for c in texts], batch.column(0).slice(at, to - at))
            for low in range(0, len(names), 10_000):
                part = lists.slice(low, 10_000)
                yield pa.RecordBatch.from_arrays([pa.array(names[low:low + 10_000], pa.string()), part], ["trigram", "ids"])
            at = to


def write_index(entries: DataFrame, path: str, columns=SEARCHED, key: str = "id") -> None:
    """Index the texts of ``columns``; ids with a null are not indexed, repeated ids share their postings."""
    texts = [F.lower(F.col(c)).alias(f"text{n}") for n, c in enumerate(columns)]
    rows = entries.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), *texts)
    schema = T.StructType([T.StructField("trigram", T.StringType()), T.StructField("ids", T.ArrayType(rows.schema["id"].dataType))])
    rows.mapInArrow(_indexed, schema).sortWithinPartitions("trigram").write.mode("overwrite").parquet(path)


def _grams(term):
    needle = term.lower()
    return sorted({needle[i:i + 3] for i in range(len(needle) - 2)})


def holding(spark, path: str, term: str) -> DataFrame:
    """Ids of the entries that hold all trigrams of a term of three letters or more."""
    grams = _grams(term)
    found = spark.read.parquet(path).filter(F.col("trigram").isin(*grams)).select("trigram", F.explode("ids").alias("id"))
    return found.groupBy("id").agg(F.count_distinct("trigram").alias("n")).filter(F.col("n") == len(grams)).select("id")


def search(entries: DataFrame, path: str, term: str, columns=SEARCHED, key: str = "id") -> DataFrame:
    """The entries with ``term`` as a literal substring of any of ``columns``, ignoring case, as ``filters.search_text`` finds them.

    ``columns`` are among those of the index. An empty term is in every text that is not null.
    """
    needle = term.lower()
    hits = [F.coalesce(F.lower(F.col(c)).contains(needle), F.lit(False)) for c in columns]
    verified = reduce(lambda a, b: a | b, hits)
    if len(needle) < 3:
        return entries.filter(verified)
    ids = holding(entries.sparkSession, path, term).withColumnRenamed("id", key)
    return entries.join(ids, key, "left_semi").filter(verified)
