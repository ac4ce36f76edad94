"""Rows that fit their schema go on, malformed ones are kept apart with their file and line."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rentmill.sources.csv import BAD_LINE, FILE


def rejected_of(table: str) -> str:
    """The raw table with the malformed lines of the files of ``table``."""
    return f"{table}_rejected"


def store_accepted(
    parsed: DataFrame, store: Callable[[DataFrame], object], reject: Callable[[DataFrame], object]
) -> int:
    """Give the sound rows of a tolerant read to ``store`` and the malformed ones to ``reject``; returns how many there are of these.

    ``store`` has to write its rows, in one action. Malformed rows are counted in that pass; the files are read again, for
    ``reject``, only if there are any. A rejected row has the ``file``, the ``line`` and, as JSON, the ``fields`` that could be read.
    """
    counted = Observation(f"rejected-{uuid.uuid4().hex}")
    columns = [c for c in parsed.columns if c not in (BAD_LINE, FILE)]
    seen = parsed.observe(counted, F.count(BAD_LINE).alias("rejected"))
    store(seen.where(F.col(BAD_LINE).isNull()).select(columns))
    if found := counted.get["rejected"]:
        fields = F.to_json(F.struct(*columns)).alias("fields")
        reject(parsed.where(F.col(BAD_LINE).isNotNull()).select(F.col(FILE).alias("file"), F.col(BAD_LINE).alias("line"), fields))
    return found
