"""The steps as separate jobs give what one pipeline run gives."""

from __future__ import annotations

import pytest
from helpers import DATA, bag

from rentmill.__main__ import arguments, jdbc_properties, main
from rentmill.fixtures.tables import ShopTables
from rentmill.plans.business import RANKINGS, rank_directly
from rentmill.plans.weekly import APPENDED, read_batches, summary_of, weekly_returned
from rentmill.schemas import BUSINESS, RAW
from rentmill.sources import read_layer
from rentmill.streaming.ingest import INGESTED

SF_DIR = f"{DATA}/sf0.001"


def test_steps_run_as_separate_jobs(spark, tmp_path):
    shop, root = ShopTables(spark, SF_DIR), str(tmp_path)
    for step in ("land", "load", "quality", "access", "staging", "business"):
        main([step, "--root", root], spark, shop.__getitem__)
    for target in RANKINGS:
        assert bag(read_layer(spark, root, BUSINESS, target)) == bag(rank_directly(target, shop))
    main(["staging", "--root", root, "--buckets", "3"], spark)
    main(["rankings", "--root", root], spark)
    main(["vacuum", "--root", root, "--hours", "-1"], spark)
    for target in RANKINGS:
        assert bag(read_layer(spark, root, BUSINESS, target)) == bag(rank_directly(target, shop))
    main(["load", "--root", root, "--quarantine"], spark)
    files = ["--root", root, "--files", f"{root}/landing/rental"]
    expected = bag(weekly_returned(shop["rental"]))
    main(["ingest", *files, "--checkpoint", f"{root}/checkpoint"], spark)
    assert bag(read_layer(spark, root, BUSINESS, summary_of(INGESTED))) == expected
    main(["weekly", *files], spark)
    assert bag(read_layer(spark, root, BUSINESS, summary_of(APPENDED))) == expected
    assert read_batches(spark, root, APPENDED).count() == read_layer(spark, root, RAW, "rental").count() == shop["rental"].count()


@pytest.mark.parametrize("line", ["land", "weekly --root x", "ingest --root x --files y"])
def test_a_step_needs_its_options(line):
    with pytest.raises(SystemExit):
        arguments(line.split())


def test_landing_from_a_database_needs_its_address(spark):
    with pytest.raises(SystemExit, match="--url"):
        main(["land", "--root", "x"], spark)


def test_properties_may_come_from_a_file(tmp_path):
    (tmp_path / "p").write_text("# reader\npassword=a=b\n\nuser=u\n")
    line = ["land", "--root", "x", "--property", "user=v", "--properties-file", str(tmp_path / "p")]
    assert jdbc_properties(arguments(line)) == {"user": "u", "password": "a=b"}
