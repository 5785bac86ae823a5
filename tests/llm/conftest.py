import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def small(tmp_path_factory):
    """Writes {table: pyarrow table or dict} as a data directory; returns its path."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    def make(**tables):
        folder = tmp_path_factory.mktemp("tables")
        for name, t in tables.items():
            pq.write_table(t if isinstance(t, pa.Table) else pa.table(t), folder / f"{name}.parquet")
        return str(folder)
    return make
