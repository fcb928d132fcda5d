"""Every registered query with SQL against DuckDB on the smallest tables."""

import decimal

import duckdb
import pytest

from brindle.plans import registry
from brindle.plans.fixtures import TABLES
from tests.conftest import DATA

#: Run by the driver on larger tables as well; here a part that covers all modules, to keep the tests quick.
NAMES = [
    "country_class_prior", "buyer_prior", "value_stats", "country_class_bonus", "profile_table", "check_constraints", "campaign_funnel", "variant_stats", "dashboard", "due_leads",
    "send_window", "import_leads", "allocate_least_loaded", "steps_with_variations", "lookup_lead", "keep_first", "split_by_presence", "extract_links", "page_text", "curate_candidates",
    "rank_results", "title_group", "lead_expressions", "near_dup_pairs", "upsert", "patch", "delete_cascade", "apply_replies", "advance", "lead_state", "rolling_7d", "fill_template",
    "add_links", "replied_leads", "days_after", "text_gates", "payload_gate", "image_expressions", "quality_presets", "build_sources",
    "prior_cells", "page_after", "unvisited", "frontier_walk", "match_entities", "match_suppliers", "near_dup_bands", "message_bodies", "open_counts_once",
]


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, float | decimal.Decimal):
        return round(float(x), 6)
    return x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert ours == theirs
