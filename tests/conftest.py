import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted plain tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is None, str(v)) for v in r])

    return collect
