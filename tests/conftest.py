import pytest

from millrace.session import get_spark


@pytest.fixture(scope="session")
def spark():
    s = get_spark("tests", cores=4, **{"spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


def rows(df):
    """Rows as sorted tuples, lists as tuples."""
    flat = lambda v: tuple(map(flat, v)) if isinstance(v, (list, tuple)) else v
    return sorted((flat(r) for r in df.collect()), key=repr)
