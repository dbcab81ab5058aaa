"""Driver contract: entry() smoke, query / oracle key agreement, and Spark vs DuckDB
results with the expected row counts at sf0.001 (SURVEY 7.3)."""

import duckdb
import pytest

import __spark_entry__ as se
from taxorule.plans.binding_plan import QUERIES
from taxorule.plans.incremental_plan import INCREMENTAL_QUERIES, INCREMENTAL_SQL
from taxorule.plans.ingest_plan import INGEST_QUERIES, INGEST_SQL
from taxorule.plans.oracle import ORACLE_SQL
from taxorule.plans.run_plan import RUN_QUERIES, RUN_SQL
from taxorule.sources.driver_tables import TABLES

from .conftest import SF0001

EXPECTED_ROWS = {
    "vendor_match_products": 100, "accepted_training": 90, "stable_merge": 200,
    "category_counts": 4, "usable_categories": 1, "training_subset": 190,
    "keyword_stats": 27415, "keyword_totals": 27185, "vendor_inside": 18305,
    "vendor_totals": 16838, "previous_pairs": 15082, "scored_candidates": 658,
    "strict_candidates": 406, "rule_proposals": 642, "status_summary": 4,
    "accepted_rules": 425, "reference_rule_counts": 4, "rule_changes": 284 + 181,
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def _norm(rows):
    return sorted(tuple("∅" if v is None else str(v) for v in r) for r in rows)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() == 642
    assert "vendor_status" in df.columns


def test_every_query_has_oracle():
    own = {*QUERIES, *INGEST_QUERIES, *INCREMENTAL_QUERIES, *RUN_QUERIES}
    assert own <= set(se.queries()) and own == {*ORACLE_SQL, *INGEST_SQL, *INCREMENTAL_SQL, *RUN_SQL}
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", sorted({*EXPECTED_ROWS, *INGEST_QUERIES, *INCREMENTAL_QUERIES, *RUN_QUERIES}))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF0001)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    res = duck.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert len(got) == EXPECTED_ROWS.get(name, len(want)) > 0
    assert _norm(got) == _norm(want)


def test_status_counts_sf0001(spark):
    rows = se.queries()["scored_candidates"](spark, SF0001).groupBy("vendor_status").count().collect()
    assert {r[0]: r[1] for r in rows} == {None: 16, "new": 67, "not_impacted": 19, "supported": 339, "violated": 217}
