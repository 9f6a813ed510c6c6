import pytest

from twinproof.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", 4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as a sorted list of tuples."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is None, v) for v in r)) if not order else sorted(out, key=lambda r: [r[i] for i in order])
