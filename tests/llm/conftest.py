import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples, over several partitions."""
    def make(*items, partitions=3):
        made = [(i[0], i[1], "en", i[2] if len(i) > 2 else "s", len(i[1] or "")) for i in items]
        return spark.createDataFrame(made, DOCS).repartition(partitions)
    return make


@pytest.fixture
def clashing():
    """The frame with columns whose names an operator might use itself."""
    def add(df):
        from pyspark.sql import functions as F
        return df.withColumns({n: F.lit("x") for n in ("_mark", "rows", "key", "size", "fp", "hash", "copies", "rule", "host", "score", "_t", "_key", "label")})
    return add


@pytest.fixture(autouse=True)
def uncached(spark):
    """What a test has cached goes with it; another one counts the cached blocks of the session."""
    yield
    spark.catalog.clearCache()
