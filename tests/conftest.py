import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    from tonetape.session import local_session

    session = local_session("8", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "7")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples, missing values last."""
    got = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(got, key=lambda r: tuple((x is None, 0 if x is None else x) for x in r))
