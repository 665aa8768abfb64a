"""Every registered query beside its SQL twin on the smallest tables."""

import duckdb
import pytest
from check_oracles import TABLES, compare

from broadloom.queries import oracles, registered

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return db


def test_every_oracle_has_a_query():
    assert set(oracles()) <= set(registered())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, connection, name):
    verdict = compare(spark, connection, name, registered()[name], oracles().get(name), FOLDER)
    assert verdict.startswith(("ok", "rows only")), verdict
    assert "TYPES" not in verdict, verdict
