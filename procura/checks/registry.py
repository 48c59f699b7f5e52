"""One registered query per operator: ``(spark, sf_dir) -> DataFrame``.

Each query projects an operator's output with explicit column types so the
result can be compared with the DuckDB oracle of ``oracle.py``.  The fixture
tables are projections, by Spark, of the driver tables of ``sf_dir`` and of a
few relations written once per session under the checkpoint folder
(``fixtures.STAGED``); the pipeline (and its shared
stage tables) is kept per session and folder as well.
"""

from __future__ import annotations

import dataclasses
import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ExtractConfig
from ..functions import formulas as fm
from ..functions.decimals import AMOUNT, RESULT, WIDE
from ..operators.credits import PARENT_PASS_THROUGH
from ..operators.trace import rule_counts
from ..plans.delta import run_delta
from ..plans.pipeline import Pipeline
from ..session import apply_defaults, ensure_checkpoint_dir
from ..sources.fixtures import DRIVER_TABLES, FIXTURE_TABLES, derive_tables, materialize
from ..sources.tables import load_tables

_PIPELINES: dict[tuple, Pipeline] = {}


def _location(sf_dir: str) -> str:
    return sf_dir if "://" in sf_dir else os.path.abspath(sf_dir)


def _fixture_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the fixture of ``sf_dir`` in the state of its files."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    stamp = [_location(sf_dir)]
    for name in DRIVER_TABLES:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        st = p.getFileSystem(conf).getFileStatus(p)
        stamp.append(f"{st.getLen()}:{st.getModificationTime()}")
    key = hashlib.sha1("|".join(stamp).encode()).hexdigest()[:12]
    return f"{ensure_checkpoint_dir(spark)}/procura-fixture/{key}"


def fixture_lake(spark: SparkSession, sf_dir: str) -> str:
    """Folder holding the fixture tables derived from ``sf_dir`` (written once per state of its files)."""
    lake = _fixture_folder(spark, sf_dir)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    marker = jvm.org.apache.hadoop.fs.Path(f"{lake}/{FIXTURE_TABLES[-1]}/_SUCCESS")
    fs = marker.getFileSystem(conf)
    if not fs.exists(marker):
        materialize(spark, sf_dir, lake)
    return lake


def pipeline_for(spark: SparkSession, sf_dir: str, lazy_fixture: bool = False) -> Pipeline:
    apply_defaults(spark)
    # The fixture's timestamps are UTC wall times (as in the oracle).
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The application id changes with every SparkContext, so a pipeline bound
    # to a stopped context is never handed out again.
    key = (id(spark), spark.sparkContext.applicationId, _location(sf_dir), lazy_fixture)
    if key not in _PIPELINES or _PIPELINES[key].spark is not spark:
        staged = None if lazy_fixture else f"{_fixture_folder(spark, sf_dir)}/staged"
        tables = derive_tables(spark, sf_dir, staged)
        _PIPELINES[key] = Pipeline(tables, ExtractConfig.fixture(), reuse="table")
    return _PIPELINES[key]


def _amt(c: str) -> F.Column:
    return F.col(c).cast(AMOUNT).alias(c)


def _wide(c: str) -> F.Column:
    return F.col(c).cast(WIDE).alias(c)


def _res(c: str) -> F.Column:
    return F.col(c).cast(RESULT).alias(c)


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


LINE6 = ["order_id", "line_number", "order_item_id", "p2p_line_item_id"]


def _lines6(df: DataFrame, *extra) -> DataFrame:
    return df.select(*LINE6, _amt("quantity"), _amt("unit_price"), *extra)


def _totals(df: DataFrame) -> DataFrame:
    return df.select("order_id", "line_number", _amt("quantity"), _amt("unit_price"), _amt("line_total"),
                     "p2p_line_item_id")


def _credit4(df: DataFrame) -> DataFrame:
    return df.select("order_item_id", F.col("credit_memo_count").cast("int").alias("credit_memo_count"),
                     _amt("credit_qty"), _amt("credit_amount"))


def _open_lines(df: DataFrame, with_price: bool) -> DataFrame:
    cols = ["order_id", "p2p_line_item_id", "line_number", _amt("actual_order_line_total"), _amt("quantity"),
            _amt("current_order_line_total"), "order_item_id"]
    if with_price:
        cols.append(_amt("unit_price"))
    return df.select(*cols)


def _split_amounts(lines: DataFrame) -> DataFrame:
    return lines.select(
        "order_split_item_id", "order_item_id", "split_type", _res("quantity"), _res("split_item_total"), _res("tax")
    )


def _split_labels(p: Pipeline) -> DataFrame:
    return p.split_lines.select(
        "order_split_item_id",
        fm.split_type_label("split_type", "item_type_id").alias("split_type_label"),
        fm.split_value("split_type", "item_type_id", "percentage", "quantity", "split_item_total", "tax")
        .alias("split_value"),
    )


def _tax_amounts(p: Pipeline) -> DataFrame:
    return p.tax_extract.select("order_number", "order_line_number", "tax_code", _res("tax_value"), _res("tax_base"))


def _pivot(p: Pipeline) -> DataFrame:
    cfg = p.cfg
    return p.accounting_pivot.select(
        "order_split_item_id", "order_number", "order_line_number", _res("tax"), _amt("shipping_charges"),
        _amt("additional_charges"), "split_type", _res("quantity"), _amt("percentage"), _res("split_item_total"),
        "item_type_id", "split_number", "period", "requester", *[f"ae{n}" for n in cfg.pivot_entity_types],
    )


def _accounting(p: Pipeline) -> DataFrame:
    cfg = p.cfg
    return p.accounting_extract.select(
        "order_number", "order_line_number", "order_split_item_id", "split_number", "split_type", _res("split_value"),
        _res("split_item_total"), _res("taxes"), _amt("additional_charges"), _amt("shipping_charges"), "period",
        "requester", *[f"ae{n}" for n in cfg.pivot_entity_types],
    )


def _tax_delta(p: Pipeline) -> DataFrame:
    """The tax extract by a delta run, from a run before the taxes of every seventh item had arrived."""
    path = f"{ensure_checkpoint_dir(p.spark)}/procura-delta/{uuid.uuid4().hex}"
    earlier = p.t.order_external_taxes.filter("order_item_id % 7 <> 0")
    first = run_delta(dataclasses.replace(p.t, order_external_taxes=earlier), p.cfg, "tax", f"{path}/1")
    return _tax(run_delta(p.t, p.cfg, "tax", f"{path}/2", first.path).extract(p.spark))


def _tax(extract: DataFrame) -> DataFrame:
    return extract.select(
        "order_number", "order_line_number", "tax_description", "authority_name", "tax_code", "tax_type",
        _res("tax_value"), _amt("tax_rate"), _res("tax_base"), _amt("applied_tax_value"), _amt("applied_tax_rate"),
        "authority_type", "is_tax_overridden", "external_address_id",
    )


# name -> projection of a pipeline stage
QUERIES: dict[str, Callable[[Pipeline], DataFrame]] = {
    "id_list": lambda p: p.status_members,
    "order_scope": lambda p: p.scope.select("document_code", "bu"),
    "parent_order_items": lambda p: p.parent_items.select(
        "order_id", "order_item_id", "p2p_line_item_id", _amt("quantity"), _amt("unit_price"), _ntz("end_date"),
        "is_deleted", "item_extended_type", _amt("parent_quantity"), "contract_no",
        *[_ntz(c) if c.startswith(("date", "start")) else c for c in PARENT_PASS_THROUGH],
    ),
    "scoped_invoice_map": lambda p: p.invoice_map,
    "billed_invoice_items": lambda p: p.billed_items.select(
        "invoice_item_id", "p2p_line_item_id", "invoice_id", "is_deleted", _amt("quantity"), "item_extended_type",
        "invoice_status", "credit_type", _amt("unit_price"), _amt("tax"), _amt("additional_charges"),
        _amt("shipping_charges"),
    ),
    "credit_by_invoice_item_scope": lambda p: _credit4(p.credit_by_invoice_item_scope),
    "credit_direct_scope": lambda p: _credit4(p.credit_direct_scope),
    "credit_by_invoice_item_parent": lambda p: _credit4(p.credit_by_invoice_item_parent),
    "credit_direct_parent": lambda p: _credit4(p.credit_direct_parent),
    "credit_details": lambda p: _credit4(p.credit_details),
    "credit_memo_lines": lambda p: p.credit_memo_lines.select(
        "p2p_line_item_id", "credit_memo_count", _amt("credit_memo_quantity"), _amt("credit_memo_amount"),
        "order_item_id",
    ),
    "credit_by_line": lambda p: p.credit_by_line.select(
        "p2p_line_item_id", _amt("credit_qty"), _amt("credit_amount"), "credit_count"
    ),
    "credit_invoices_by_line": lambda p: p.credit_invoices_by_line.select(
        "credit_count", _amt("credit_qty"), _amt("credit_amount"), "p2p_line_item_id"
    ),
    "order_item_credit": lambda p: p.order_item_credit.select(
        "order_item_id", _amt("credit_quantity"), _amt("credit_amount"), "credit_memo_count"
    ),
    "material_lines": lambda p: _lines6(p.material_lines),
    "line_totals_material": lambda p: _totals(p.line_totals_material),
    "line_totals_service": lambda p: _totals(p.line_totals_service),
    "accepted_receipts": lambda p: p.accepted_receipts.select(
        "order_id", "p2p_line_item_id", _amt("total_accepted_quantity")
    ),
    "outstanding_material": lambda p: _lines6(
        p.outstanding_material, _wide("difference_quantity"), _wide("total_accepted_amount")
    ),
    "open_material_lines": lambda p: _open_lines(p.open_material_lines, True),
    "open_material_list": lambda p: _open_lines(p.open_material_list_direct, False),
    "contract_expiry": lambda p: p.contract_expiry.select(
        "contract_number", F.col("date_expiry").cast("timestamp_ntz").alias("date_expiry")
    ),
    "service_lines": lambda p: _lines6(p.service_lines, "date_difference"),
    "approved_confirmations": lambda p: p.approved_confirmations.select("p2p_line_item_id", _amt("approved")),
    "confirmation_balance": lambda p: p.confirmation_balance.select(
        "order_id", "order_item_id", _amt("ordered"), _amt("approved"), _amt("credit_amount"), _amt("remaining")
    ),
    "outstanding_service": lambda p: _lines6(
        p.outstanding_service, "date_difference", _wide("difference_amount"), _wide("total_received_amount")
    ),
    "open_service_lines": lambda p: _open_lines(p.open_service_lines, True),
    "service_grace_filter": lambda p: _open_lines(p.service_grace_filter(180), True),
    "legacy_order_amount": lambda p: p.legacy_order_amount.select(
        "p2p_line_item_id", _amt("current_order_line_total"), "order_id", _amt("quantity"), _amt("unit_price")
    ),
    "legacy_service_prices": lambda p: p.legacy_service_prices,
    "recent_drafts": lambda p: p.recent_drafts,
    "extract_line_list": lambda p: p.extract_line_list,
    "line_trace": lambda p: p.line_trace,
    "line_trace_rules": lambda p: rule_counts(p.line_trace),
    "contacts": lambda p: p.contacts,
    "split_field_rows": lambda p: p.split_field_rows.select(
        "order_split_item_id", "order_item_id", "order_number", "order_line_number", "entity_id",
        "entity_detail_code", "field_name", "field_value",
    ),
    "split_amounts": lambda p: _split_amounts(p.split_lines),
    "split_amounts_truncated": lambda p: _split_amounts(p.split_lines_truncated),
    "resolve_dimensions": lambda p: p.resolved_dimensions.select(
        "order_split_item_id", "field_name", "field_value", "requester", "period", "dim_entity_id",
        "dim_entity_code",
    ),
    "accounting_pivot": _pivot,
    "split_labels": _split_labels,
    "accounting_extract": _accounting,
    "tax_amounts": _tax_amounts,
    "tax_extract": lambda p: _tax(p.tax_extract),
    "tax_extract_delta": _tax_delta,
}


def run(name: str, spark: SparkSession, sf_dir: str, lazy_fixture: bool = False) -> DataFrame:
    """``lazy_fixture`` derives the fixture inside the plan instead of writing
    it first (cheaper for a single query; many queries share the written one)."""
    return QUERIES[name](pipeline_for(spark, sf_dir, lazy_fixture))
