import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from snapflow.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4, extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wh-")})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` (or all columns) as sorted tuples."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def plan_text(df) -> str:
    """The physical plan as printed by ``df.explain()``."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
