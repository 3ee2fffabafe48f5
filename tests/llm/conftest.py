import pytest

CLASHING = "kept int, digest string, rep int, row int, media string, score string, text_sha256 int, key string, shard string, ids string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (doc_id, text, lang, source), with further columns that carry the operators' own names."""

    def made(rows):
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or ""), *(None,) * 10) for r in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return made


#: What every operator must take: null, empty and white texts, null columns, repeats, ties, a long text.
ODD = [
    (1, None, None, None), (2, "", "en", "s1"), (3, " \t\n", "en", "s1"), (4, "hello world this is a text", "en", "s1"), (4, "hello world this is a text", "en", "s1"),
    (5, "helloworld this is a text", "en", None), (6, "12 !! 34", None, "s2"), (7, "word " * 30_000, "en", "s1"), (8, "émoji 😀 \x0b ü", "fr", "s2"), (9, "a\x00b ▁ ▁▁c <s>", "fr", "s3"),
]


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD)


@pytest.fixture(scope="session")
def none(make):
    return make(ODD).where("false")
