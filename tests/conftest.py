import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stratavault.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(home / "warehouse"), "spark.checkpoint.dir": str(home / "shared"),
        "spark.sql.catalogImplementation": "in-memory"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Frame from a values text: frame("(1, 'a'), (2, null)", "id", "name")."""
    def make(values: str, *names: str):
        return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(f'`{n}`' for n in names)})")
    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def values(df):
    return sorted((r[0] for r in df.collect()), key=repr)
