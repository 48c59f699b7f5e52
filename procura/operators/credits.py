"""Credit subsystem: credit memos and credit invoices per order line (O03-O10).

Bag semantics throughout: the scope may list an order once per business unit
and every join keeps those duplicates, because the sums downstream see them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ExtractConfig
from ..functions.decimals import AMOUNT, amount, keep_in, nz


def _scope_keys(scope: DataFrame, as_col: str = "order_id") -> DataFrame:
    """The scope as a bag of order ids (one row per scope row)."""
    return scope.select(F.col("document_code").alias(as_col))


# Columns of the parent items that are handed through as they are.
PARENT_PASS_THROUGH = (
    "receiving_status", "line_asn_status", "tax", "shipping_charges", "additional_charges", "date_needed",
    "date_requested", "start_date", "discount_percentage", "markup_percentage", "discount", "markup", "external_tax",
)


def parent_order_items(order_items: DataFrame, orders: DataFrame, scope: DataFrame) -> DataFrame:
    """Items of the parent order of every scoped order (bag, 23 columns)."""
    child = orders.select(F.col("order_id").alias("child_id"), F.col("parent_document_code").alias("order_id"))
    items = order_items.filter(F.col("is_deleted") == 0)
    return (
        items.join(child, "order_id")
        .join(_scope_keys(scope, "child_id"), "child_id")
        .select(
            "order_id",
            "order_item_id",
            "p2p_line_item_id",
            "quantity",
            "unit_price",
            "end_date",
            "is_deleted",
            "item_extended_type",
            F.col("quantity").alias("parent_quantity"),
            "contract_no",
            *PARENT_PASS_THROUGH,
        )
    )


def scoped_invoice_map(order_invoice_map: DataFrame, scope: DataFrame) -> DataFrame:
    """Invoice-to-order mapping of the scoped orders (bag)."""
    return order_invoice_map.join(_scope_keys(scope), "order_id").select("invoice_id", "order_id")


def billed_invoice_items(
    invoice_items: DataFrame,
    invoice_map: DataFrame,
    documents: DataFrame,
    scope: DataFrame,
    cfg: ExtractConfig,
) -> DataFrame:
    """Live invoice items of scoped orders whose invoice is in a billed status."""
    inv_docs = keep_in(documents, "document_status", cfg.invoice_statuses, cfg.inline_list_limit).select(
        F.col("document_code").alias("invoice_id"), F.col("document_status").alias("invoice_status")
    )
    items = invoice_items.filter(F.col("is_deleted") == 0)
    return (
        items.join(invoice_map, "invoice_id")
        .join(inv_docs, "invoice_id")
        .join(_scope_keys(scope), "order_id")
        .select(
            "invoice_item_id",
            "p2p_line_item_id",
            "invoice_id",
            "is_deleted",
            "quantity",
            "item_extended_type",
            "invoice_status",
            F.col("credit_type").cast("smallint").alias("credit_type"),
            "unit_price",
            "tax",
            "additional_charges",
            "shipping_charges",
        )
    )


def _memo_documents(documents: DataFrame, cfg: ExtractConfig) -> DataFrame:
    d = documents.filter(F.col("is_deleted") == 0)
    return keep_in(d, "document_status", cfg.credit_memo_statuses, cfg.inline_list_limit).select(
        F.col("document_code").alias("credit_memo_id")
    )


def _memo_sums(rows: DataFrame, distinct_memos: bool) -> DataFrame:
    n = F.countDistinct("credit_memo_id") if distinct_memos else F.count("credit_memo_id")
    return rows.groupBy("order_item_id").agg(
        n.cast("int").alias("credit_memo_count"),
        amount(F.sum(nz("credit_quantity"))).alias("credit_qty"),
        amount(
            F.sum(nz("credit_amount")) + F.sum(nz("memo_tax")) + F.sum(nz("memo_shipping")) + F.sum(nz("memo_additional"))
        ).alias("credit_amount"),
    )


def live_memo_items(credit_memo_items: DataFrame, documents: DataFrame, cfg: ExtractConfig) -> DataFrame:
    """Live credit memo lines of live memos in a counted status: the input of all four credit branches."""
    lines = credit_memo_items.filter(F.col("is_deleted") == 0).select(
        "credit_memo_id",
        "invoice_item_id",
        F.col("order_item_id").alias("memo_order_item_id"),
        "credit_quantity",
        "credit_amount",
        F.col("tax").alias("memo_tax"),
        F.col("shipping_charges").alias("memo_shipping"),
        F.col("additional_charges").alias("memo_additional"),
    )
    return lines.join(_memo_documents(documents, cfg), "credit_memo_id")


def credit_by_invoice_item(
    items: DataFrame,
    invoice_map: DataFrame,
    billed: DataFrame,
    memo_items: DataFrame,
    scope: DataFrame,
    distinct_memos: bool,
) -> DataFrame:
    """Credit memos raised against billed invoice items of each order item
    (``memo_items``: ``live_memo_items``).

    Columns: order_item_id, credit_memo_count int, credit_qty, credit_amount.
    """
    it = items.filter(F.col("is_deleted") == 0).select("order_item_id", "order_id", "p2p_line_item_id")
    bi = billed.filter(F.col("is_deleted") == 0).select("invoice_id", "p2p_line_item_id", "invoice_item_id")
    rows = (
        it.join(invoice_map, "order_id")
        .join(bi, ["invoice_id", "p2p_line_item_id"])
        .join(memo_items, "invoice_item_id")
        .join(_scope_keys(scope), "order_id")
    )
    return _memo_sums(rows, distinct_memos)


def credit_direct(
    items: DataFrame,
    memo_items: DataFrame,
    scope: DataFrame,
) -> DataFrame:
    """Credit memos raised straight against the order item (no invoice item)."""
    it = items.filter(F.col("is_deleted") == 0).select("order_item_id", "order_id")
    memos = memo_items.filter(
        F.col("invoice_item_id").isNull() | (F.col("invoice_item_id") == 0)
    )
    rows = (
        it.join(memos, F.col("order_item_id") == F.col("memo_order_item_id"))
        .join(_scope_keys(scope), "order_id")
    )
    return _memo_sums(rows, distinct_memos=False)


def credit_details(parts: list[DataFrame]) -> DataFrame:
    """Bag union of the credit branches."""
    cols = ["credit_memo_count", "credit_qty", "credit_amount", "order_item_id"]
    out = parts[0].select(*cols)
    for p in parts[1:]:
        out = out.unionByName(p.select(*cols))
    return out


def credit_memo_lines(
    details: DataFrame, order_items: DataFrame, parent_items: DataFrame, scope: DataFrame, cfg: ExtractConfig
) -> DataFrame:
    """Attach the persistent line id to each credit row; service-by-amount
    lines count as quantity 1.  Scoped-item branch plus parent-item branch."""

    def branch(items: DataFrame) -> DataFrame:
        return details.join(items, "order_item_id").select(
            "p2p_line_item_id",
            "credit_memo_count",
            amount(
                F.when(F.col("item_extended_type") == cfg.amount_service_type, F.lit(1)).otherwise(F.col("credit_qty"))
            ).alias("credit_memo_quantity"),
            amount(nz("credit_amount")).alias("credit_memo_amount"),
            "order_item_id",
        )

    scoped = order_items.join(_scope_keys(scope), "order_id").select(
        "order_item_id", "p2p_line_item_id", "item_extended_type"
    )
    parents = parent_items.select("order_item_id", "p2p_line_item_id", "item_extended_type")
    return branch(scoped).unionByName(branch(parents))


def credit_by_line(memo_lines: DataFrame) -> DataFrame:
    """Credit totals per (line id, order item); the order item is not kept,
    so a line id may repeat."""
    return memo_lines.groupBy("p2p_line_item_id", "order_item_id").agg(
        F.sum(nz("credit_memo_count")).cast("int").alias("credit_count"),
        amount(F.sum(nz("credit_memo_quantity"))).alias("credit_qty"),
        amount(F.sum(nz("credit_memo_amount"))).alias("credit_amount"),
    ).select("p2p_line_item_id", "credit_qty", "credit_amount", "credit_count")


def credit_invoices_by_line(billed: DataFrame, invoices: DataFrame, cfg: ExtractConfig) -> DataFrame:
    """Credit invoices (credit type, or the credit status) per line id."""
    rows = billed.join(invoices.select("invoice_id", "invoice_type"), "invoice_id").filter(
        (F.col("invoice_type") == cfg.credit_invoice_type) | (F.col("invoice_status") == cfg.credit_invoice_status)
    )
    line_value = nz("unit_price") * nz("quantity")
    return rows.groupBy("p2p_line_item_id").agg(
        F.countDistinct("invoice_id").cast("int").alias("credit_count"),
        amount(
            F.sum(F.when(F.col("credit_type") == cfg.credit_quantity_type, nz("quantity")).otherwise(F.lit(0)))
        ).alias("credit_qty"),
        amount(
            F.sum(line_value) + F.sum(nz("tax")) + F.sum(nz("shipping_charges")) + F.sum(nz("additional_charges"))
        ).alias("credit_amount"),
    ).select("credit_count", "credit_qty", "credit_amount", "p2p_line_item_id")


def order_item_credit(
    order_items: DataFrame, scope: DataFrame, by_line: DataFrame, invoices_by_line: DataFrame
) -> DataFrame:
    """Credit quantity, amount and count per scoped order item (memo + invoice)."""
    memo = by_line.select(
        "p2p_line_item_id",
        F.col("credit_qty").alias("m_qty"),
        F.col("credit_amount").alias("m_amount"),
        F.col("credit_count").alias("m_count"),
    )
    inv = invoices_by_line.select(
        "p2p_line_item_id",
        F.col("credit_qty").alias("i_qty"),
        F.col("credit_amount").alias("i_amount"),
        F.col("credit_count").alias("i_count"),
    )
    items = order_items.join(_scope_keys(scope), "order_id").select("order_item_id", "p2p_line_item_id")
    return (
        items.join(memo, "p2p_line_item_id", "left")
        .join(inv, "p2p_line_item_id", "left")
        .select(
            "order_item_id",
            (nz("m_qty") + nz("i_qty")).cast(AMOUNT).alias("credit_quantity"),
            (nz("m_amount") + nz("i_amount")).cast(AMOUNT).alias("credit_amount"),
            (nz("m_count") + nz("i_count")).cast("int").alias("credit_memo_count"),
        )
    )
