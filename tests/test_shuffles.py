"""What the fixture and the stages write and shuffle."""

import os
import re

from conftest import SF_SMALL
from procura.checks.registry import fixture_lake
from procura.config import ExtractConfig
from procura.operators import splits as sp
from procura.plans.pipeline import CREDIT_SHARED, Pipeline
from procura.sources.fixtures import STAGED, derive_tables
from procura.sources.tables import load_tables
from test_plans import executed, settings

CFG = ExtractConfig.fixture()


def shuffled(df) -> list[str]:
    """What stands right below each hash exchange of the plan."""
    lines = executed(df).splitlines()
    return [lines[i + 1] for i, line in enumerate(lines[:-1]) if "Exchange hashpartitioning" in line]


def carries(below: list[str], column: str) -> bool:
    """Whether an exchange carries the column itself, not just something computed from it."""
    return any(re.search(rf"[\[ ]{column}#\d+L?[,\]]", x) for x in below)


def same_rows(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fixture_numbers_the_lines_once_and_writes_no_projection(spark, tmp_path):
    t = derive_tables(spark, SF_SMALL, str(tmp_path))
    assert sorted(os.listdir(tmp_path)) == sorted(STAGED)
    lazy = derive_tables(spark, SF_SMALL)
    for name in ("order_items", "split_entities", "receipt_items", "document_bu", "document_lob_map"):
        table = getattr(t, name)
        assert "Exchange" not in executed(table) and "Window" not in executed(table), name
        assert same_rows(table, getattr(lazy, name)), name


def test_lines_are_numbered_by_one_shuffle_of_stored_columns(spark):
    plan = executed(derive_tables(spark, SF_SMALL).order_items)
    below = re.findall(r"Exchange hashpartitioning[^\n]*\n([^\n]*)", plan)
    assert len(below) == 1 and "decimal" not in below[0]


def test_line_trace_shuffles_bits_and_sends_material_lines_alone_to_the_receipts(spark):
    tables = load_tables(spark, fixture_lake(spark, SF_SMALL))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"), Pipeline(tables, CFG, shared=("scoped_items", "material_lines")) as p:
        below = shuffled(p.line_trace)
        assert any("failed" in x for x in below)
        assert not carries(below, "closing_order_status") and not carries(below, "item_status")
        assert p.line_trace.count() == tables.order_items.count()
        plan = executed(p.line_trace).splitlines()
        assert any("item_extended_type" in x and "Filter" in x for x in plan)


def test_pivot_shuffles_no_value_but_the_requesters(spark):
    tables = load_tables(spark, fixture_lake(spark, SF_SMALL))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"), Pipeline(tables, CFG, shared=("split_lines",)) as p:
        args = (p.split_lines, tables.split_entities, tables.split_field_config, CFG)
        lean, full = sp.open_split_fields(*args, pivoted=True), sp.open_split_fields(*args)
        assert not carries(shuffled(full), "order_split_item_entity_id")
        assert lean.drop("field_value").count() == full.count() > 0
        assert lean.filter(f"field_value IS NOT NULL AND NOT (entity_id = 0 AND field_name = '{CFG.requester_field}')").count() == 0
        pivots = [sp.split_dimensions(x, CFG) for x in (p.pivot_dimensions, p.resolved_dimensions)]
        assert same_rows(*pivots)


def test_lookup_keys_that_never_match_are_short(spark):
    rows = spark.range(5000).selectExpr(
        "id AS order_split_item_id", "CAST(NULL AS int) AS entity_id", "CAST(NULL AS string) AS entity_detail_code", "'x' AS field_name",
        "CAST(NULL AS string) AS field_value")
    contacts = spark.createDataFrame([("u", 1, "n")], "user_name string, contact_code long, name string")
    entities = spark.createDataFrame([(1, "A", 2, 0)], "entity_detail_code long, entity_code string, entity_id int, lob_entity_detail_code long")
    assert sp.resolve_dimensions(rows, contacts, entities, CFG).filter("dim_entity_id IS NULL AND requester = ''").count() == 5000
    assert 1000 < sp.SPREAD_KEYS <= 1 << 20


def test_credits_shuffle_the_parent_columns_they_read(spark):
    tables = load_tables(spark, fixture_lake(spark, SF_SMALL))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"), Pipeline(tables, CFG, shared=CREDIT_SHARED) as p:
        assert p.order_item_credit.count() > 0
        written = [p.stage_plans[name] for name in CREDIT_SHARED if "parent" in name]
        assert written and not any(carries(shuffled(df), c) for df in written for c in ("discount", "end_date", "tax"))
        mine = p.credit_parents
        assert same_rows(mine, p.parent_items.select(mine.columns))
