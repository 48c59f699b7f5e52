"""Material lines: ordered, received, outstanding (O11-O16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ExtractConfig
from ..functions.decimals import AMOUNT, WIDE, nz, stored
from .scope import scope_orders

LINE_KEY = ["order_id", "p2p_line_item_id"]
LINE_COLS = ["order_id", "line_number", "order_item_id", "p2p_line_item_id", "quantity", "unit_price"]


def live_scoped_orders(scope: DataFrame, documents: DataFrame, orders: DataFrame) -> DataFrame:
    """Scoped order ids whose document is not deleted and whose order row exists: one row per order.

    Used only as an existence filter below a DISTINCT.  Written as a table of its own it meets the
    items in a join of two plain shuffles, which adaptive execution splits where an order is hot.
    """
    live_docs = documents.filter(F.col("is_deleted") == 0).select(F.col("document_code").alias("order_id"))
    return (
        scope_orders(scope)
        .join(live_docs, "order_id", "left_semi")
        .join(orders.select("order_id"), "order_id", "left_semi")
    )


def scoped_items(order_items: DataFrame, live_orders: DataFrame, cfg: ExtractConfig) -> DataFrame:
    """Live, not cancelled, not closed items of live scoped orders: the common
    input of the material and service line sets (items are scanned once)."""
    items = order_items.filter(
        (F.col("closing_order_status") != cfg.closed_status)
        & (F.col("is_deleted") == 0)
        & (F.col("item_status") != cfg.item_cancelled_status)
    ).select(
        *LINE_COLS, "item_extended_type", "is_close_for_invoicing", "is_close_for_receiving", "contract_no", "end_date",
    )
    return items.join(live_orders, "order_id", "left_semi")


def material_lines(items: DataFrame, cfg: ExtractConfig) -> DataFrame:
    """Distinct live material lines of scoped orders (6 columns); ``items``: ``scoped_items``."""
    cond = F.col("item_extended_type") == cfg.material_type
    if cfg.require_open_for_receiving:
        cond = cond & (F.col("is_close_for_receiving") == 0)
    return items.filter(cond).select(*LINE_COLS).distinct()


def line_totals(lines: DataFrame, cfg: ExtractConfig | None = None) -> DataFrame:
    """Distinct lines with their ordered value (unit price x quantity, stored as decimal(18,6))."""
    return lines.select(
        "order_id",
        "line_number",
        "quantity",
        "unit_price",
        stored(F.col("unit_price") * F.col("quantity"), AMOUNT, cfg).alias("line_total"),
        "p2p_line_item_id",
    ).distinct()


def accepted_receipts(
    receipt_items: DataFrame,
    totals: DataFrame,
    receipts: DataFrame,
    documents: DataFrame,
    order_receipt_map: DataFrame,
    cfg: ExtractConfig,
) -> DataFrame:
    """Accepted quantity per (order, line id) from approved, live receipts."""
    ri = receipt_items.filter(
        (F.col("item_status") != cfg.item_cancelled_status) & (F.col("is_deleted") == 0)
    ).select("receipt_id", "p2p_line_item_id", "accepted_quantity")
    rc = receipts.filter(F.col("is_deleted") == 0).select("receipt_id")
    docs = documents.filter(
        (nz("document_status") == cfg.receipt_status) & (F.col("is_deleted") == 0)
    ).select(F.col("document_code").alias("receipt_id"))
    rows = (
        ri.join(totals.select(*LINE_KEY), "p2p_line_item_id")
        .join(rc, "receipt_id")
        .join(docs, "receipt_id")
        .join(order_receipt_map.select("receipt_id", "order_id"), ["receipt_id", "order_id"])
    )
    if cfg.on_overflow == "reject":
        total = F.try_sum("accepted_quantity").try_cast(AMOUNT)
        lost = (F.count("accepted_quantity") > 0) & total.isNull()
        return rows.groupBy("order_id", "p2p_line_item_id").agg(
            total.alias("total_accepted_quantity"), lost.alias("accepted_overflow"))
    return rows.groupBy("order_id", "p2p_line_item_id").agg(
        F.sum("accepted_quantity").cast(AMOUNT).alias("total_accepted_quantity")
    )


def outstanding_material(lines: DataFrame, accepted: DataFrame, cfg: ExtractConfig | None = None) -> DataFrame:
    """Lines plus ordered-minus-accepted quantity and accepted value.

    ``accepted`` is unique per (order, line id), so the left join keeps the
    line count.
    """
    return lines.join(accepted, LINE_KEY, "left").select(
        *LINE_COLS,
        (nz("quantity") - nz("total_accepted_quantity")).cast(WIDE).alias("difference_quantity"),
        stored(nz("total_accepted_quantity") * nz("unit_price"), WIDE, cfg).alias("total_accepted_amount"),
    )


def _open_rows(outstanding: DataFrame, totals: DataFrame) -> DataFrame:
    t = totals.select(*LINE_KEY, "line_total")
    return outstanding.filter(F.col("difference_quantity") > 0).join(t, LINE_KEY)


def open_material_lines(outstanding: DataFrame, totals: DataFrame, cfg: ExtractConfig | None = None) -> DataFrame:
    """Material lines with quantity still to receive and their remaining value."""
    return _open_rows(outstanding, totals).select(
        "order_id",
        "p2p_line_item_id",
        "line_number",
        stored(nz("total_accepted_amount"), AMOUNT, cfg).alias("actual_order_line_total"),
        stored(nz("difference_quantity"), AMOUNT, cfg).alias("quantity"),
        stored(F.col("line_total") - nz("total_accepted_amount"), AMOUNT, cfg).alias("current_order_line_total"),
        "order_item_id",
        "unit_price",
    )


def open_material_list(
    outstanding: DataFrame, totals: DataFrame, restrict_orders: DataFrame | None = None,
    cfg: ExtractConfig | None = None,
) -> DataFrame:
    """As ``open_material_lines`` without the unit price.

    ``restrict_orders`` (order ids) keeps only orders present in a narrower
    line set; with the default configuration both line sets are identical and
    the restriction is a no-op, so it is skipped.
    """
    rows = _open_rows(outstanding, totals)
    if restrict_orders is not None:
        rows = rows.join(restrict_orders.select("order_id").distinct(), "order_id", "left_semi")
    return rows.select(
        "order_id",
        "p2p_line_item_id",
        "line_number",
        stored(nz("total_accepted_amount"), AMOUNT, cfg).alias("actual_order_line_total"),
        stored(nz("difference_quantity"), AMOUNT, cfg).alias("quantity"),
        stored(F.col("line_total") - nz("total_accepted_amount"), AMOUNT, cfg).alias("current_order_line_total"),
        "order_item_id",
    )
