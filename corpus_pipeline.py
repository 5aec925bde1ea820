"""A corpus pipeline over documents: toxic texts go, then exact copies, then near copies, and the rest is packed.

Each stage works on all that the one before it wrote. As that is written when a stage begins, the folders of
intermediate tables of the earlier stages are deleted then.
"""

import uuid
from contextlib import contextmanager

from advisorium.llm import exact_dedup, near_copies, packing, toxicity
from advisorium.llm.queries import byte_bpe
from advisorium.llm.shared import delete, folder
from advisorium.sources.scratch import scratch_root

FOLDERS = []  # of earlier stages, this module's own


@contextmanager
def own_folder(spark):
    """The tables of a stage go to a folder of its own; the folders of the stages before it are deleted."""
    while FOLDERS:
        delete(spark, FOLDERS.pop())
    with folder(spark) as path:
        FOLDERS.append(path)
        yield


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier rejects go; it learns from the labels of ``docs`` outside the held-out quarter."""
    with own_folder(spark):
        return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark, docs, sf_dir):
    """Of equal texts the row with the largest doc_id stays."""
    with own_folder(spark):
        return exact_dedup.kept(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of each group of texts with five-word similarity 0.8 or more the row with the smallest doc_id stays."""
    with own_folder(spark):
        return near_copies.kept(docs)


def pack_tokens(spark, docs, sf_dir):
    """One row per piece of at most 2048 tokens, with its place in a sequence and the checksum of its ids."""
    with own_folder(spark):
        return packing.pack(docs.select("doc_id", "text"), byte_bpe(), carry=["doc_id"], with_ids=False).drop("ids")


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies), ("packing", pack_tokens)]
ORACLE_SQL = None  # the classifier and the near copies have no SQL form; the tests compare with plain Python


def run(spark, sf_dir):
    """All stages over documents; each result is written and read again."""
    root = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{root}/{n}")
        docs = spark.read.schema(result.schema).parquet(f"{root}/{n}")
    return docs
