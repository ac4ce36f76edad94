"""CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rentmill.sources.csv import DIALECT
from rentmill.storage import replace_folder, sibling

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# Files with text, and compressed files, are read by one task each, so no single file may grow with the table.
ROWS_PER_FILE = 2_000_000


def export_csv(df: DataFrame, path: str, *, rows_per_file: int = ROWS_PER_FILE, compression: str = "none") -> None:
    """Replace the folder ``path`` with CSV part files of ``df``, written in parallel. Readers tell a ``compression`` by the file names."""
    if len(df.columns) == 1 and df.schema[0].nullable:
        raise ValueError("a lone null is an empty line, which CSV readers skip: export at least two columns")
    incoming = sibling(path, "incoming")
    (
        df.write.options(**DIALECT)
        .options(timestampFormat=STAMP_FORMAT, timestampNTZFormat=STAMP_FORMAT, maxRecordsPerFile=rows_per_file, compression=compression)
        .csv(incoming)
    )
    replace_folder(df.sparkSession, incoming, path)
