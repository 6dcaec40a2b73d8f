import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def checkpoint_dir(tmp_path_factory):
    return tmp_path_factory.mktemp("checkpoint")


@pytest.fixture(scope="session")
def spark(checkpoint_dir):
    from bench import session

    spark = session("4", **{"spark.checkpoint.dir": str(checkpoint_dir)})
    yield spark
    spark.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as sorted tuples of the named columns."""

    def get(df, *columns):
        picked = df.select(*(columns or df.columns)).collect()
        return sorted((tuple(r) for r in picked), key=lambda r: tuple((v is not None, v) for v in r))

    return get


@pytest.fixture
def raw(spark):
    """A raw table from partial rows; what a row leaves out is NULL."""
    from jobtide.schemas import RAW

    def make(name, *partial):
        schema = RAW[name]
        full = [tuple(p.get(f.name) for f in schema) for p in partial]
        return spark.createDataFrame(full, schema)

    return make
