import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from tramlag.session import local_session

    session = local_session(shuffle_partitions=2, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as plain tuples, sorted with nulls last."""

    def plain(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda row: [(v is None, v) for v in row])

    return plain


@pytest.fixture
def interpreted(spark):
    """Without code generation: for many tiny jobs, compiling takes longer than running.

    The comparison with SQL in test_oracle.py runs the same operators compiled.
    """
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
