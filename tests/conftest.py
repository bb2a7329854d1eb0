import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from millrace.session import local_session

    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def duck():
    """DuckDB over the smallest tables."""
    import duckdb

    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con
