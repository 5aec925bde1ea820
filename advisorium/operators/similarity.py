"""Nearest existing entry of every new text: TF-IDF cosine, and cosine of embeddings.

The existing side is a table of postings (term, position, weight), which is joined by term. A new text has its terms in
order of what they can add to a score at most: its weight times the largest weight of the term in the table. What the terms
from one place on can add together is a bound. The best posting of each term, which the vocabulary holds, gives every text a
score that it reaches at least. A row that shares none of the terms whose bound reaches that score cannot be the closest, so
only these terms, the prefix, are joined with all postings; of the pairs they give, those that can still reach the best
sum of their text are completed from the rest of its terms. There is one plan at every size, the result is exact, and hot
terms are split by adaptive execution as any hot join key is.

Counts of an entry's terms are a table of their own that grows by appending: weights are made from it without the texts.
"""

import sys
from typing import NamedTuple

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from advisorium.functions.stop_words import ENGLISH
from advisorium.operators.pivots import nearest_vectors  # noqa: F401
from advisorium.operators.spread import spread_lookup
from advisorium.sources.scratch import written

# The workers need these helpers but may not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DUPLICATE_THRESHOLD = 0.70
MAX_FEATURES = 5_000
# Scores are compared at this precision so that rounding noise cannot decide a tie.
TIE_DECIMALS = 9
MARGIN = 1e-8
WORDS_AT_ONCE = 250_000  # words of texts that are weighed together; a longer text is weighed alone


def words_of(text, stop_words=ENGLISH) -> Column:
    """Lower-case words of two or more characters, without the stop words."""
    text = F.col(text) if isinstance(text, str) else text
    found = F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}_]{2,}"), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(*stop_words)) if stop_words else found


def with_terms(df: DataFrame, text, stop_words=ENGLISH) -> DataFrame:
    """Add ``terms``: the words of ``text`` followed by its word pairs."""
    worded = df.withColumn("__words", words_of(text, stop_words))
    pairs = F.greatest(F.size("__words") - 1, F.lit(0))
    bigrams = F.zip_with(
        F.slice("__words", F.lit(1), pairs), F.slice("__words", F.lit(2), pairs),
        lambda a, b: F.concat(a, F.lit(" "), b))
    return worded.withColumn("terms", F.concat("__words", bigrams)).drop("__words")


class TextCounts(NamedTuple):
    """What is kept of existing texts: (position, term, tf) rows, and a row (n, first) of their number and first position."""

    terms: DataFrame
    rows: DataFrame


class TextIndex(NamedTuple):
    """Fitted existing side: (code, position, weight) rows, the vocabulary (code, term, idf, top, at), and the first position.

    ``top`` is the largest weight of a term, ``at`` the position that has it.
    """

    postings: DataFrame
    vocabulary: DataFrame
    first: DataFrame


def counted(existing: DataFrame, text, position: str, stop_words=ENGLISH) -> TextCounts:
    """Term counts of the existing texts, written as a table."""
    text = F.col(text) if isinstance(text, str) else text
    worded = with_terms(existing.select(F.col(position).alias("position"), text.alias("__text")), "__text", stop_words)
    counts = worded.select("position", F.explode("terms").alias("term")).groupBy("position", "term").agg(
        F.count(F.lit(1)).alias("tf"))
    rows = existing.agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first"))
    return TextCounts(written(counts, "counts"), rows)


def merged(*parts: TextCounts) -> TextCounts:
    """The counts of several sets of entries together, without their texts. No entry may be in two sets."""
    terms, rows = parts[0]
    for part in parts[1:]:
        terms, rows = terms.unionByName(part.terms), rows.unionByName(part.rows)
    return TextCounts(terms, rows.agg(F.sum("n").alias("n"), F.min("first").alias("first")))


def weighed(counts: TextCounts, max_features: int = MAX_FEATURES) -> TextIndex:
    """Weights from counts.

    The vocabulary is the ``max_features`` most frequent terms, ties by term. The inverse
    document frequency is ln((1 + n) / (1 + df)) + 1 and every row has unit length.
    """
    frequency = counts.terms.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    vocabulary = frequency.orderBy(F.desc("total"), "term").limit(max_features)
    idf = F.log((1 + counts.rows.select("n").scalar()) / (1 + F.col("df"))) + 1
    # At most max_features rows, so one task may number them and they may be broadcast whatever the catalogue's size.
    code = (F.row_number().over(Window.orderBy("term")) - 1).alias("code")
    vocabulary = written(vocabulary.select(code, "term", idf.alias("idf")).coalesce(1), "vocabulary")
    weighted = counts.terms.join(F.broadcast(vocabulary), "term").withColumn("w", F.col("tf") * F.col("idf"))
    # A row has at most max_features terms, so this window group is small.
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("position")))
    # Every score reads the weights several times.
    postings = written(weighted.select("code", "position", (F.col("w") / length).alias("weight")), "postings")
    tops = postings.groupBy("code").agg(F.max(F.struct("weight", "position")).alias("best")).select(
        "code", F.col("best.weight").alias("top"), F.col("best.position").alias("at"))
    return TextIndex(postings, vocabulary.join(tops, "code"), counts.rows.select("first"))


def fit(existing: DataFrame, text, position: str, max_features: int = MAX_FEATURES, stop_words=ENGLISH) -> TextIndex:
    """The index of the existing texts, fitted on them alone."""
    return weighed(counted(existing, text, position, stop_words), max_features)


def score(new: DataFrame, index: TextIndex, key: str, text, keep=(), stop_words=ENGLISH) -> DataFrame:
    """Best cosine similarity per new row: (key, score, position of the closest).

    A row without a shared term scores 0 and points at the first existing row; with nothing to
    compare to the position is null. The columns ``keep`` are carried along. Keys may repeat or be null.
    """
    text = F.col(text) if isinstance(text, str) else text
    carried = [key, *keep]
    # Few weights are left of a text; dealing them out makes the joins independent of how the texts were split.
    texts = written(_weighted_texts(new.select(*carried, text.alias("__text")), index, carried, stop_words).repartition("__row"), "texts")
    prefix = texts.select("__row", "beyond", F.inline("prefix"))
    met = prefix.join(index.postings, "code")
    # Terms of a text meet again in one task, so that its best sum so far raises what a pair has to reach.
    pairs = met.repartition("__row").groupBy("__row", "position").agg(
        F.sum(F.col("w") * F.col("weight")).alias("s"), F.first("beyond").alias("beyond"))
    reached = F.max("s").over(Window.partitionBy("__row")) - MARGIN
    rivals = pairs.withColumn("reached", reached).filter(F.col("s") + F.col("beyond") >= F.col("reached"))
    rest = rivals.select("__row", "position", "s").join(texts.select("__row", "tail"), "__row").select(
        "__row", "position", "s", F.inline_outer("tail"))
    rest = rest.join(index.postings, ["code", "position"], "left")
    sums = rest.groupBy("__row", "position").agg(F.round(
        F.first("s") + F.coalesce(F.sum(F.col("w") * F.col("weight")), F.lit(0.0)), TIE_DECIMALS).alias("score"))
    best = sums.groupBy("__row").agg(F.max(F.struct("score", (-F.col("position")).alias("before"))).alias("top"))
    joined = texts.select("__row", *carried).join(best, "__row", "left")
    matched = F.coalesce(F.col("top.score"), F.lit(0.0)) > 0
    return joined.select(
        *carried, F.when(matched, F.col("top.score")).otherwise(F.lit(0.0)).alias("score"),
        F.when(matched, -F.col("top.before")).otherwise(index.first.scalar()).alias("position"))


def with_closest(scored: DataFrame, existing: DataFrame, position: str, label: str, key: str) -> DataFrame:
    """Add ``closest``: the label of the closest existing row. Many rows may share one."""
    labels = existing.select(F.col(position).alias("position"), F.col(label).alias("closest"))
    return spread_lookup(scored, labels, ["position"], [key])


def duplicates(new: DataFrame, existing: DataFrame, key: str, text, existing_text, position: str, label: str,
               threshold: float = DUPLICATE_THRESHOLD, **options) -> DataFrame:
    """Score (four places), closest label and duplicate flag of every new row."""
    best = written(score(new, fit(existing, existing_text, position), key, text, **options), "scores")  # read twice
    labelled = with_closest(best, existing, position, label, key)
    rounded = F.round("score", 4)
    return labelled.select(
        key, rounded.alias("score"), "position", F.coalesce("closest", F.lit("")).alias("closest"),
        (rounded >= threshold).alias("is_duplicate"))


def _weighted_texts(texts, index, carried, stop_words):
    """__row, the columns carried, prefix and tail (arrays of code and w), and beyond: what the tail adds to a score at most."""
    # The vocabulary has at most max_features rows.
    shared = texts.sparkSession.sparkContext.broadcast(_pack(index.vocabulary.collect(), stop_words))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        packed, row = shared.value, TaskContext.get().partitionId() << 33
        for batch in _sliced(batches):
            n = batch.num_rows
            rows, codes, weights = _vectors(batch.column(batch.num_columns - 1), packed)
            most = weights * packed["top"][codes]
            order = np.lexsort((codes, -most, rows))
            rows, codes, weights, most = rows[order], codes[order], weights[order], most[order]
            starts = np.searchsorted(rows, np.arange(n + 1))
            # a text reaches the sum of what its terms add to one row that is the best of some of them
            cells, at = np.unique(rows * len(packed["top"]) + packed["at"][codes], return_inverse=True)
            least = np.zeros(n)
            np.maximum.at(least, cells // max(len(packed["top"]), 1), np.bincount(at, most, minlength=len(cells)))
            back = np.r_[np.cumsum(most[::-1])[::-1], 0.0]
            rest = back[:-1] - back[starts[1:]][rows]
            in_prefix = rest >= least[rows] - MARGIN
            cut = np.bincount(rows[in_prefix], minlength=n)
            beyond = np.zeros(n)
            tails = np.flatnonzero(starts[:-1] + cut < starts[1:])
            beyond[tails] = rest[(starts[:-1] + cut)[tails]]
            lists = []
            for part in (in_prefix, ~in_prefix):
                ends = np.r_[0, np.cumsum(part)][starts].astype(np.int32)
                entries = pa.StructArray.from_arrays([pa.array(codes[part].astype(np.int32)), pa.array(weights[part])], ["code", "w"])
                lists.append(pa.ListArray.from_arrays(pa.array(ends), entries))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + n)), *batch.columns[:-1], *lists, pa.array(beyond)],
                                             ["__row", *carried, "prefix", "tail", "beyond"])
            row += n
        _give_back()

    # Stop words are dropped by the workers, whose lookup passes over every word anyway.
    worded = texts.select(*carried, words_of("__text", ()).alias("words"))
    entries = T._parse_datatype_string("array<struct<code:int,w:double>>")
    schema = T.StructType([T.StructField("__row", T.LongType()), *texts.select(*carried).schema.fields,
                           T.StructField("prefix", entries), T.StructField("tail", entries), T.StructField("beyond", T.DoubleType())])
    return worded.mapInArrow(run, schema)


def _sliced(batches):
    """The rows of the batches in slices of bounded words (the last column), so that memory follows neither rows nor lengths."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        words = pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(words, dtype=np.int64), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + WORDS_AT_ONCE, "right")))
            yield batch.slice(at, to - at)
            at = to


def _give_back():
    """Free memory of this worker goes back to the system: workers outlive their tasks, and an executor has several."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library than glibc


def _pack(vocabulary, stop_words=()):
    """The vocabulary as arrays by code. Terms are also split into words, so that texts are looked up word by word
    and a pair of words is a pair of numbers."""
    import numpy as np
    import pyarrow as pa

    size = len(vocabulary)
    idf, top, at, parts, places = np.zeros(size), np.zeros(size), np.zeros(size, np.int64), [[]] * size, {}
    for code, term, weight, most, position in vocabulary:
        idf[code], top[code], parts[code] = weight, most, term.split(" ")
        at[code] = places.setdefault(position, len(places))  # a number below the size of the vocabulary
    words = sorted({word for part in parts for word in part})
    number = {word: n for n, word in enumerate(words)}
    single = np.full(len(words) + 1, -1, np.int64)
    pairs = {}
    for n, part in enumerate(parts):
        if len(part) == 1:
            single[number[part[0]]] = n
        else:
            pairs[number[part[0]] * len(words) + number[part[1]]] = n
    pair_keys = np.array(sorted(pairs), np.int64)
    pair_codes = np.array([pairs[k] for k in pair_keys.tolist()], np.int64)
    return {"idf": idf, "top": top, "at": at, "words": pa.array([*words, *stop_words], pa.string()), "n_words": len(words),
            "single": single, "pair_keys": pair_keys, "pair_codes": pair_codes}


def _vectors(word_lists, packed):
    """Unit-length weights of the known terms of each word list, as (row, term code, weight)."""
    import numpy as np
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(word_lists), 0).to_numpy(zero_copy_only=False)
    n, size, n_words = len(lengths), max(len(packed["idf"]), 1), packed["n_words"]
    found = pc.index_in(pc.cast(word_lists.flatten(), "string"), value_set=packed["words"])
    found = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    # Stop words go before neighbours pair up; an unknown word stays and keeps its place.
    kept = found < n_words
    words, rows = found[kept], np.repeat(np.arange(n), lengths)[kept]
    alone = packed["single"][words]
    together = (rows[:-1] == rows[1:]) & (words[:-1] >= 0) & (words[1:] >= 0)
    key = words[:-1][together] * n_words + words[1:][together]
    pair = np.full(len(key), -1, np.int64)
    if len(packed["pair_keys"]):
        place = np.minimum(np.searchsorted(packed["pair_keys"], key), len(packed["pair_keys"]) - 1)
        pair = np.where(packed["pair_keys"][place] == key, packed["pair_codes"][place], -1)
    codes = np.concatenate((alone, pair))
    rows = np.concatenate((rows, rows[:-1][together]))
    known = codes >= 0
    cells, tf = np.unique(rows[known] * size + codes[known], return_counts=True)
    rows, codes = cells // size, cells % size
    weights = tf * packed["idf"][codes] if len(cells) else np.zeros(0)
    length = np.sqrt(np.bincount(rows, weights * weights, minlength=n))
    return rows, codes, weights / length[rows]


def second_pass(scored: DataFrame, semantic: DataFrame, key: str, threshold: float = DUPLICATE_THRESHOLD) -> DataFrame:
    """Raise scores below the threshold to the embedding score where that is higher.

    ``semantic`` needs the rows below the threshold only; rows without a vector keep their
    text score.
    """
    other = semantic.select(key, F.col("score").alias("__score"), F.col("position").alias("__position"))
    both = scored.join(other, key, "left")
    higher = F.coalesce((F.col("score") < threshold) & (F.col("__score") > F.col("score")), F.lit(False))
    return both.withColumns({
        "score": F.when(higher, F.col("__score")).otherwise(F.col("score")),
        "position": F.when(higher, F.col("__position")).otherwise(F.col("position")),
        "raised": higher,
    }).drop("__score", "__position")
