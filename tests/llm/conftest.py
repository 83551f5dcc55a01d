import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977} again" for i in range(60_000))


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with NULLs in every column, empty, blank, very long and repeated
    rows and equal texts under other ids."""
    rows = [
        (1, "The cat sat on the mat and looked at the moon.", "en", "a", 46),
        (1, "The cat sat on the mat and looked at the moon.", "en", "a", 46),
        (2, "The cat sat on the mat and looked at the moon.", None, "b", None),
        (3, None, "en", None, 0),
        (3, None, "en", None, 0),
        (4, "", "de", "a", 0),
        (5, " \t\n\x0b\x0c\r ", "de", "b", 6),
        (None, "no id at all, but some words", "fr", "a", 28),
        (None, None, None, None, None),
        (6, "É ÀB ab \u00a0x \U0001f600", "fr", "b", 12),
        (7, LONG, "en", "a", len(LONG)),
        (8, LONG, "en", "b", len(LONG)),
        (9, "a", "en", "a", 1),
        (10, "a a a a a a a a a a a a", "en", "a", 23),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def clash(messy):
    """The same with columns named like results and helpers of the operators."""
    from pyspark.sql import functions as F

    names = "size shard slot score predicted kept target taken n_words n_hit finish licences fingerprint component_id contaminated toxic label"
    return messy.withColumns({c: F.lit("x") for c in names.split()})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def few_partitions(spark):
    """Two partitions per shuffle: small tables spend their time on tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
