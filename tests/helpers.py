"""What several test modules share; fixtures are in ``conftest.py``, which no module imports."""

from __future__ import annotations

from collections import Counter

DATA = "/root/testdata"


def bag(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())
