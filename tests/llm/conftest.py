import pytest


@pytest.fixture(scope="session")
def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def docs(spark):
    """Documents with the awkward cases: nulls anywhere, empty and long texts, repeated rows, clashing columns."""

    def make(rows, schema="doc_id bigint, text string, kept string, score string, row string, size string, text_extra string"):
        width = schema.count(",") + 1
        return spark.createDataFrame([tuple(r) + ("x",) * (width - len(r)) for r in rows], schema)

    return make


LONG = "lorem ipsum dolor sit amet " * 20_000


@pytest.fixture
def awkward():
    return [(1, "A b c"), (2, "a B C"), (3, None), (None, "a b c"), (None, None), (4, ""), (5, LONG), (5, LONG), (5, "ä Ö  x\n\ny"),
            (6, "ä Ö  x\n\ny"), (7, "Ä Ö  x\n\ny")]
