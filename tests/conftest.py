import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from estratos.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="4000", spark__checkpoint__dir=tempfile.mkdtemp(prefix="estratos-tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows(spark):
    """A frame of dictionaries or tuples with a stated schema."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"
