from __future__ import annotations

import pytest

from saleswh.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="4000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as plain tuples, sorted unless the frame's own order is wanted."""
    found = [tuple(row) for row in df.collect()]
    return found if order == ("as_is",) else sorted(found, key=repr)
