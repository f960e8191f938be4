"""Every registered query against its DuckDB oracle on the smallest scale (the driver's
correctness gate, in miniature). Queries without an oracle must at least run."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.sources.tables import TABLES
from tools.check_oracles import digest

from .conftest import SF_SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["player_name", "scoring_class", "is_active", "start_season", "end_season", "current_season"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert df.columns
        return
    rel = con.execute(ORACLES[name])
    o_cols = [d[0] for d in rel.description]
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(rows) == len(o_rows)
    assert digest(df.columns, rows)[0] == digest(o_cols, o_rows)[0]
