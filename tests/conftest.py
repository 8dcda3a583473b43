import csv
import gzip
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarmac.session import get_spark  # noqa: E402
from tarmac.sources.schema import FILE_COLUMNS  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", 4, app_name="tarmac-tests")
    yield s
    s.stop()


def csv_line(values: dict | list, n: int = len(FILE_COLUMNS)) -> str:
    """One CSV record; ``values`` is a {column: text} dict or a raw field list."""
    if isinstance(values, dict):
        fields = [values.get(c, "") for c in FILE_COLUMNS[:n]]
    else:
        fields = list(values)
    buf = io.StringIO()
    csv.writer(buf, lineterminator="\n").writerow(fields)
    return buf.getvalue()


def write_gz(path, lines: list[str], header: bool = True) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    body = (",".join(FILE_COLUMNS) + "\n" if header else "") + "".join(lines)
    with gzip.open(path, "wt", newline="") as f:
        f.write(body)
    return str(path)
