"""Plan shape and pipeline properties on the sf0.001 fixture."""

import contextlib
import os
import re

import pytest

from conftest import SF_SMALL
from helpers import doc, item, order, scope_rows, tables
from procura.checks.registry import fixture_lake, pipeline_for
from procura.config import ExtractConfig
from procura.operators import splits as sp
from procura.operators.splits import PIVOT_KEYS
from procura.plans.extracts import export, extract_pipeline
from procura.plans.pipeline import ACCOUNTING_SHARED, CREDIT_SHARED, REUSE_MODES, TAX_SHARED, Pipeline
from procura.session import ensure_checkpoint_dir
from procura.sources.tables import load_tables

CFG = ExtractConfig.fixture()
PRODUCTION = {"tax_extract": TAX_SHARED, "accounting_extract": ACCOUNTING_SHARED, "order_item_credit": CREDIT_SHARED}


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pipe(spark):
    return pipeline_for(spark, SF_SMALL)


@pytest.fixture(scope="module")
def lake(spark):
    return load_tables(spark, fixture_lake(spark, SF_SMALL))


@pytest.mark.parametrize("name", list(PRODUCTION))
def test_no_nested_loop_in_production_plans(spark, lake, name):
    """The stage sets that users run, every written stage's own plan included, without broadcasts."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"), Pipeline(lake, CFG, shared=PRODUCTION[name]) as p:
        plans = {"last": executed(getattr(p, name))}
        plans |= {k: executed(df) for k, df in p.stage_plans.items()}
        assert set(plans) == {"last", *PRODUCTION[name]}
        for k, plan in plans.items():
            assert not re.search("CartesianProduct|NestedLoop|Python|Arrow", plan), k


@pytest.mark.parametrize(("name", "modes"), [("tax_extract", REUSE_MODES), ("accounting_extract", ("table", "persist"))])
def test_reuse_modes_agree(spark, lake, name, modes):
    rows = {}
    for mode in modes:
        with Pipeline(lake, CFG, reuse=mode, shared=PRODUCTION[name]) as p:
            rows[mode] = sorted(map(tuple, getattr(p, name).collect()), key=repr)
    assert rows["table"] and all(r == rows["table"] for r in rows.values())


def test_filters_reach_the_scan(pipe, capsys):
    from procura.operators.scope import order_scope

    t = pipe.t
    order_scope(t.documents, t.purchase_orders, t.document_bu, t.entities, t.partners, pipe.cfg).explain("formatted")
    text = capsys.readouterr().out
    assert "In(document_status, [1,142,21,22,23,24,25,41])" in text
    assert "EqualTo(is_deleted,0)" in text
    assert "ReadSchema: struct<document_code:bigint,document_status:int,is_deleted:int,is_buyer_visible:int>" in text


def test_properties(pipe):
    assert pipe.outstanding_material.count() == pipe.material_lines.count()
    assert pipe.outstanding_service.count() == pipe.service_lines.count()
    parts = pipe.open_material_list.count() + pipe.open_service_lines.count() + pipe.recent_drafts.count()
    assert pipe.extract_line_list.count() == parts
    pivot = pipe.accounting_pivot
    assert pivot.count() == pivot.select(PIVOT_KEYS).distinct().count()
    same = ["order_id", "order_item_id", "quantity"]
    assert sorted(pipe.open_material_list.select(same).collect()) == sorted(pipe.open_material_list_direct.select(same).collect())


def test_order_items_are_all_lines(spark, lake):
    assert lake.order_items.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert lake.order_items.select("order_item_id").distinct().count() == lake.order_items.count()


def test_split_rows_are_shuffled_once_after_their_join(spark, lake):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"), extract_pipeline(lake, CFG, "accounting") as p:
        plan = executed(p.accounting_extract.groupBy().count())
        wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(order_split_item_id" in line]
        assert wide and "Exchange hashpartitioning(order_number" not in plan


@pytest.mark.parametrize("kind", ["tax", "accounting"])
def test_export_leaves_no_stage_tables(spark, lake, kind, tmp_path):
    root = ensure_checkpoint_dir(spark).removeprefix("file:").replace("//", "/") + "/procura-stages"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    export(lake, CFG, str(tmp_path / kind), kind)
    assert spark.read.parquet(str(tmp_path / kind)).count() > 0
    assert set(os.listdir(root)) == before


def test_credit_branches_share_their_inputs(spark, lake):
    with Pipeline(lake, CFG, shared=CREDIT_SHARED) as p:
        assert p.credit_details.count() >= 0
        assert len(re.findall("FileScan", executed(p.stage_plans["credit_details"]))) <= 17


def test_hot_order_is_split(spark):
    """One order holds a third of the lines: adaptive execution splits the join with the items."""
    n = 200_000
    base = {}
    for oid in range(1, 41):
        for k, rows in {**scope_rows(oid, partner=oid), "documents": [doc(oid, 22)], "purchase_orders": [order(oid, partner=oid)],
                        "order_entity_details": [dict(order_id=oid)],
                        "document_lob_map": [dict(document_code=oid, entity_detail_code=900)]}.items():
            base.setdefault(k, []).extend(rows)
    base["entities"] = base["entities"][:1]
    t = tables(spark, **base)
    hot = spark.range(n).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE 1 + id % 40 END AS o")
    sample = tables(spark, order_items=[item(1, 1, 1)]).order_items.drop("order_item_id", "order_id", "p2p_line_item_id")
    # Through a file, as base tables are.
    path = f"{ensure_checkpoint_dir(spark)}/hot-items"
    hot.selectExpr("id + 1 AS order_item_id", "o AS order_id", "id + 1 AS p2p_line_item_id").join(sample).select(
        t.order_items.columns).repartition(16).write.mode("overwrite").parquet(path)
    t.order_items = spark.read.parquet(path)
    low = dict(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5", spark__sql__shuffle__partitions="40",
        spark__sql__files__maxPartitionBytes="64k",
    )
    shared = ("scope", "live_orders", "scoped_items", "report_orders", "tax_items", "split_orders", "split_order_items")
    with settings(spark, **low), Pipeline(t, CFG, shared=shared) as p:
        for stage in ("scoped_items", "tax_items", "split_order_items"):
            assert getattr(p, stage).count() == n
            df = p.stage_plans[stage]
            df.collect()
            assert "skew=true" in executed(df), stage


def test_pivot_hashes_places_and_equals_the_pivot_of_texts(spark, lake):
    with extract_pipeline(lake, CFG, "accounting") as p:
        dictionary = sp.text_dictionary(p.pivot_texts)
        coded, texts = p.split_dimensions, sp.split_dimensions(p.resolved_dimensions, CFG)
        assert "SortAggregate" not in executed(p.accounting_extract) and "SortAggregate" in executed(texts)
        assert coded.exceptAll(texts).count() == 0 and texts.exceptAll(coded).count() == 0
        assert dictionary.selectExpr("codes[0] = '' AND codes = array_sort(array_distinct(codes))").first()[0]
        assert sp.text_dictionary(p.pivot_texts, limit=16) is None


def test_pivot_places_keep_nulls_blanks_and_byte_order(spark):
    rows = spark.createDataFrame(
        [(1, 2, "a", "", ""), (1, 2, "Z", "", ""), (1, 2, "é", "", ""), (2, None, None, None, ""), (3, 3, "", "", "P1"), (3, None, None, "u", "")],
        "order_split_item_id long, dim_entity_id int, dim_entity_code string, requester string, period string")
    texts = spark.createDataFrame([("",), ("a",), ("Z",), ("é",), ("P1",), ("u",)], "code string")
    cfg = CFG.with_(pivot_entity_types=(2, 3))
    got = sp.split_dimensions_by_code(rows, sp.text_dictionary(texts), cfg)
    want = {1: ("", "", "é", ""), 2: ("", None, "", ""), 3: ("P1", "u", "", "")}
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    assert {r[0]: tuple(r[1:]) for r in sp.split_dimensions(rows, cfg).collect()} == want
