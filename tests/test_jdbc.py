"""What a database scan asks of Spark's JDBC source. No database is started, so the read itself is not run."""

from __future__ import annotations

import pytest

from rentmill.schemas import SPLIT_KEYS
from rentmill.sources import jdbc_source, read_jdbc_table
from rentmill.sources.jdbc import range_predicates


class Reader:
    """Stands in for a session's reader: notes the options and answers a bounds query."""

    def __init__(self, bounds=(1, 100)):
        self.scans, self.bounds, self.given = [], bounds, {}

    @property
    def read(self):
        self.given = {}
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.given |= options
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def load(self):
        self.scans.append(dict(self.given))
        return self

    def first(self):
        return self.bounds

    def collect(self):
        return [(bound,) for bound in self.bounds]

    def jdbc(self, url, table, predicates, properties):
        self.scans.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return self


def test_a_plain_scan_reads_the_table(capsys):
    reader = Reader()
    read_jdbc_table(reader, "jdbc:x", "rental", properties={"user": "u"})
    assert reader.scans == [{"url": "jdbc:x", "fetchsize": 10_000, "preferTimestampNTZ": True, "user": "u", "dbtable": "rental"}]


def test_a_split_scan_asks_for_its_bounds_first():
    reader = Reader()
    read_jdbc_table(reader, "jdbc:x", "rental", key="rental_id", partitions=4)
    bounds, scan = reader.scans
    assert bounds["query"] == "SELECT MIN(rental_id), MAX(rental_id) FROM rental"
    assert scan["partitionColumn"] == "rental_id" and scan["numPartitions"] == 4
    assert (scan["lowerBound"], scan["upperBound"]) == (1, 100)
    assert scan["dbtable"] == "rental" and "query" not in scan


def test_given_bounds_are_used():
    reader = Reader()
    read_jdbc_table(reader, "jdbc:x", "rental", key="rental_id", bounds=(5, 6), partitions=2)
    (scan,) = reader.scans
    assert (scan["lowerBound"], scan["upperBound"]) == (5, 6)


def test_an_empty_table_is_scanned_unsplit():
    reader = Reader(bounds=(None, None))
    read_jdbc_table(reader, "jdbc:x", "rental", key="rental_id", partitions=4)
    assert "partitionColumn" not in reader.scans[-1] and reader.scans[-1]["dbtable"] == "rental"


@pytest.mark.parametrize("table, key", [("rental", "rental_id"), ("payment", "payment_id"), ("film_actor", "actor_id")])
def test_a_source_splits_each_table_on_its_key(table, key):
    reader = Reader()
    jdbc_source(reader, "jdbc:x", partitions=3)(table)
    assert reader.scans[-1]["partitionColumn"] == SPLIT_KEYS[table] == key


def test_a_callers_properties_replace_the_defaults():
    reader = Reader()
    read_jdbc_table(reader, "jdbc:x", "rental", key="rental_id", partitions=2, properties={"fetchsize": "5"})
    assert {scan["fetchsize"] for scan in reader.scans} == {"5"}


def test_a_split_by_quantiles_gives_a_range_to_each():
    reader = Reader(bounds=(10, 10, 500, 90_000))
    read_jdbc_table(reader, "jdbc:x", "rental", key="rental_id", partitions=4, by_quantiles=True, properties={"user": "u"})
    asked, scan = reader.scans
    assert "NTILE(4) OVER (ORDER BY rental_id)" in asked["query"] and "FROM rental" in asked["query"]
    assert scan["predicates"] == ["rental_id <= 10 OR rental_id IS NULL", "rental_id > 10 AND rental_id <= 500", "rental_id > 500"]
    assert (scan["dbtable"], scan["user"], scan["fetchsize"], scan["preferTimestampNTZ"]) == ("rental", "u", "10000", "true")


@pytest.mark.parametrize("bounds", [(), (7,), (7, 7)])
def test_a_key_without_cuts_is_scanned_unsplit(bounds):
    reader = Reader(bounds=bounds)
    read_jdbc_table(reader, "jdbc:x", "rental", key="rental_id", partitions=4, by_quantiles=True)
    assert "predicates" not in reader.scans[-1] and reader.scans[-1]["dbtable"] == "rental"


def test_ranges_meet_every_row_once(spark):
    import datetime as dt

    rows = spark.sql("SELECT explode(array(NULL, -3, 0, 5, 5, 9, 12, 40)) AS k")
    ranges = range_predicates("k", [5, 0, 12, 40])
    assert sum(rows.where(r).count() for r in ranges) == 8 and len(ranges) == 4
    dates = range_predicates("k", [dt.date(2005, 5, 28), dt.datetime(2005, 6, 1, 10).date(), dt.date(2006, 1, 1)])
    assert dates[0] == "k <= DATE '2005-05-28' OR k IS NULL"
    with pytest.raises(ValueError, match="key of str"):
        range_predicates("k", ["a", "b"])
