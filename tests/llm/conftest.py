import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASH = "doc_id long, text string, lang string, n long, node long, key long, h long, shard int, slot long, score double, ord long, `a b` string"


@pytest.fixture(autouse=True)
def shipped(spark):
    from churnkit.session import ship_package

    ship_package(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """(doc_id, text) rows -> a documents table."""

    def make(rows, lang="en"):
        return spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t in rows], DOC).repartition(3)

    return make


@pytest.fixture(scope="session")
def clashing(spark):
    def make(rows):
        return spark.createDataFrame([(d, t, "en", 1, 2, 3, 4, 5, 6, 0.5, 7, "x") for d, t in rows], CLASH)

    return make


@pytest.fixture(scope="session")
def small():
    import pyarrow.parquet as pq

    def rows(name):
        return pq.read_table(f"/root/testdata/sf0.001/{name}.parquet").to_pylist()

    return rows
