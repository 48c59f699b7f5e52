"""The shared pipeline of both extracts, stage by stage.

``Pipeline`` builds every stage lazily and at most once, so the stages that
several later stages read are the same DataFrame objects and Spark reuses
their exchanges within one plan; the heaviest shared stages are written once
(see ``Pipeline``).
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..config import ExtractConfig
from ..functions import sift
from ..operators import credits as cr
from ..operators import material as mt
from ..operators import scope as sc
from ..operators import rejects as rj
from ..operators import service as sv
from ..operators import splits as sp
from ..operators import trace as tr
from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables


REUSE_MODES = ("table", "checkpoint", "persist", "none")
# Stages read by several later stages; only these are shared (written once).
SHARED_STAGES = ("scope", "invoice_map", "billed_items", "parent_items", "credit_parents", "memo_items", "credit_details", "live_orders", "scoped_items", "material_lines",
                 "outstanding_material", "service_lines", "outstanding_service", "open_material", "open_service",
                 "draft_orders", "report_orders", "tax_items", "split_orders", "split_order_items", "split_lines",
                 "pivot_texts")
# Per extract: the heavy stages read by several jobs or many times in one plan, and the
# order sets with the item sets joined to them.  An order set that is a table of its own
# meets the items in a join of two plain shuffles, and writing the item set ends the job
# there: both are what adaptive execution needs to split an order that holds many lines.
TAX_SHARED = ("scope", "live_orders", "scoped_items", "open_material", "open_service", "draft_orders", "report_orders",
              "tax_items")
ACCOUNTING_SHARED = ("scope", "live_orders", "scoped_items", "draft_orders", "split_orders", "split_order_items",
                     "split_lines", "pivot_texts")
# The four credit branches read the same bills, parent items and live memo lines, and are read twice.
CREDIT_SHARED = ("scope", "invoice_map", "billed_items", "credit_parents", "memo_items", "credit_details")


class Pipeline:
    """Stages of both extracts over one set of base tables.

    ``reuse`` decides how the few stages read by many later stages (scope,
    outstanding material and service lines, the line list) are shared:

    * ``"table"``: written once as a parquet table under the session's
      checkpoint folder (``spark.checkpoint.dir``) and read back: cuts the
      lineage, survives executor loss, and gives AQE real sizes.
    * ``"checkpoint"``: ``DataFrame.checkpoint`` into the same folder.
    * ``"persist"``: cached (memory and disk); lost blocks are recomputed.
    * ``"none"``: fully lazy; Spark's exchange reuse is the only sharing.

    ``orders`` (a frame of ``order_id``) restricts every line set, and so both extracts, to some orders.  The
    scope itself stays whole, since confirmations mapped to one order count for others that hold the same line id.
    """

    def __init__(self, tables: Tables, cfg: ExtractConfig, reuse: str = "table", shared=None,
                 orders: DataFrame | None = None):
        if reuse not in REUSE_MODES:
            raise ValueError(f"reuse must be one of {REUSE_MODES}")
        self.t = tables
        self.cfg = cfg
        self.reuse = reuse
        self.orders = None if orders is None else orders.select("order_id").distinct()
        self.shared = set(SHARED_STAGES if shared is None else shared)
        self.checked = cfg.on_overflow == "reject"
        if self.checked:  # two outputs read each of these
            self.shared = self.shared - {"split_lines"} | {"line_rejects", "checked_splits", "checked_taxes"}
        self._held: list[DataFrame] = []
        self._written: list[str] = []
        self.made: dict[str, DataFrame] = {}  # stages built outside this class
        self.stage_plans: dict[str, DataFrame] = {}  # shared stages before they were written
        self._id_counts: dict[str, int] = {}
        self._run = uuid.uuid4().hex[:12]

    def _share(self, df: DataFrame, name: str) -> DataFrame:
        if name not in self.shared:
            return df
        self.stage_plans[name] = df
        if self.reuse == "table":
            path = f"{ensure_checkpoint_dir(self.spark)}/procura-stages/{self._run}/{name}"
            df.write.mode("overwrite").parquet(path)
            self._written.append(path)
            return self.spark.read.parquet(path)
        if self.reuse == "checkpoint":
            ensure_checkpoint_dir(self.spark)
            kept = df.persist(StorageLevel.MEMORY_AND_DISK)
            out = kept.checkpoint(eager=True)
            kept.unpersist()
            return out
        if self.reuse == "persist":
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._held.append(df)
        return df

    def _sift(self, rows: DataFrame, key: str, ids: DataFrame, stage: str) -> DataFrame:
        """``rows`` without those whose ``key`` is surely not among the ``ids`` of a written stage, for an exact join
        that follows: the others are not shuffled.  A stage that is not a table is not computed for it."""
        if self.reuse != "table" or stage not in self.shared:
            return rows
        if stage not in self._id_counts:
            self._id_counts[stage] = ids.count()
        count = self._id_counts[stage]
        return sift.sift(rows, key, sift.id_digest(ids, key, count)) if count >= sift.MIN_IDS else rows

    def release(self) -> None:
        """Drop cached stages and written stage tables (after the sink action)."""
        for df in self._held:
            df.unpersist()
        self._held.clear()
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        if self._written:
            p = jvm.org.apache.hadoop.fs.Path(self._written[0]).getParent()
            p.getFileSystem(conf).delete(p, True)
        self._written.clear()

    def __enter__(self) -> "Pipeline":
        return self

    def __exit__(self, *_) -> None:
        self.release()

    @property
    def spark(self) -> SparkSession:
        return self.t.documents.sparkSession

    # --- scope (O01, O02) ----------------------------------------------------
    @cached_property
    def status_ids(self) -> DataFrame:
        return sc.id_list(self.spark, self.cfg.document_statuses)

    @cached_property
    def status_members(self) -> DataFrame:
        return sc.status_members(self.t.documents, self.status_ids)

    @cached_property
    def scope(self) -> DataFrame:
        t = self.t
        return self._share(
            sc.order_scope(t.documents, t.purchase_orders, t.document_bu, t.entities, t.partners, self.cfg), "scope"
        )

    @cached_property
    def reported_scope(self) -> DataFrame:
        """The scope rows of the orders that are reported (all of them without ``orders``)."""
        if self.orders is None:
            return self.scope
        return self.scope.join(self.orders.withColumnRenamed("order_id", "document_code"), "document_code", "left_semi")

    # --- credits (O03-O10) -----------------------------------------------------
    @cached_property
    def parent_items(self) -> DataFrame:
        return self._share(
            cr.parent_order_items(self.t.order_items, self.t.purchase_orders, self.scope), "parent_items"
        )

    @cached_property
    def credit_parents(self) -> DataFrame:
        """The columns of the parent items that the credits read: the order items are shuffled without the others."""
        items = cr.parent_order_items(self.t.order_items, self.t.purchase_orders, self.scope)
        return self._share(
            items.select("order_id", "order_item_id", "p2p_line_item_id", "is_deleted", "item_extended_type"), "credit_parents"
        )

    @cached_property
    def invoice_map(self) -> DataFrame:
        return self._share(cr.scoped_invoice_map(self.t.order_invoice_map, self.scope), "invoice_map")

    @cached_property
    def billed_items(self) -> DataFrame:
        return self._share(
            cr.billed_invoice_items(self.t.invoice_items, self.invoice_map, self.t.documents, self.scope, self.cfg),
            "billed_items",
        )

    @cached_property
    def memo_items(self) -> DataFrame:
        return self._share(cr.live_memo_items(self.t.credit_memo_items, self.t.documents, self.cfg), "memo_items")

    def _by_invoice(self, items: DataFrame, distinct: bool) -> DataFrame:
        return cr.credit_by_invoice_item(
            items, self.invoice_map, self.billed_items, self.memo_items, self.scope, distinct
        )

    @cached_property
    def credit_by_invoice_item_scope(self) -> DataFrame:
        return self._by_invoice(self.t.order_items, distinct=True)

    @cached_property
    def credit_direct_scope(self) -> DataFrame:
        return cr.credit_direct(self.t.order_items, self.memo_items, self.scope)

    @cached_property
    def credit_by_invoice_item_parent(self) -> DataFrame:
        return self._by_invoice(self.credit_parents, distinct=False)

    @cached_property
    def credit_direct_parent(self) -> DataFrame:
        return cr.credit_direct(self.credit_parents, self.memo_items, self.scope)

    @cached_property
    def credit_details(self) -> DataFrame:
        return self._share(
            cr.credit_details(
                [
                    self.credit_by_invoice_item_scope,
                    self.credit_direct_scope,
                    self.credit_by_invoice_item_parent,
                    self.credit_direct_parent,
                ]
            ),
            "credit_details",
        )

    @cached_property
    def credit_memo_lines(self) -> DataFrame:
        return cr.credit_memo_lines(self.credit_details, self.t.order_items, self.credit_parents, self.scope, self.cfg)

    @cached_property
    def credit_by_line(self) -> DataFrame:
        return cr.credit_by_line(self.credit_memo_lines)

    @cached_property
    def credit_invoices_by_line(self) -> DataFrame:
        return cr.credit_invoices_by_line(self.billed_items, self.t.invoices, self.cfg)

    @cached_property
    def order_item_credit(self) -> DataFrame:
        return cr.order_item_credit(self.t.order_items, self.scope, self.credit_by_line, self.credit_invoices_by_line)

    # --- material (O11-O16) ------------------------------------------------------
    @cached_property
    def live_orders(self) -> DataFrame:
        t = self.t
        return self._share(mt.live_scoped_orders(self.reported_scope, t.documents, t.purchase_orders), "live_orders")

    @cached_property
    def scoped_items(self) -> DataFrame:
        items = self._sift(self.t.order_items, "order_id", self.live_orders, "live_orders")
        return self._share(mt.scoped_items(items, self.live_orders, self.cfg), "scoped_items")

    @cached_property
    def material_lines(self) -> DataFrame:
        return self._share(mt.material_lines(self.scoped_items, self.cfg), "material_lines")

    @cached_property
    def line_totals_material(self) -> DataFrame:
        return mt.line_totals(self.material_lines, self.cfg)

    @cached_property
    def accepted_receipts(self) -> DataFrame:
        t = self.t
        receipt_items = self._sift(t.receipt_items, "p2p_line_item_id", self.material_lines, "material_lines")
        return mt.accepted_receipts(
            receipt_items, self.line_totals_material, t.receipts, t.documents, t.order_receipt_map, self.cfg
        )

    @cached_property
    def outstanding_material(self) -> DataFrame:
        return self._share(mt.outstanding_material(self.material_lines, self.accepted_receipts, self.cfg), "outstanding_material")

    @cached_property
    def open_material_lines(self) -> DataFrame:
        return self._share(mt.open_material_lines(self.outstanding_material, self.line_totals_material, self.cfg), "open_material")

    @cached_property
    def open_material_list(self) -> DataFrame:
        if self.cfg.require_open_for_receiving:
            # The list is built from all material lines, restricted to orders
            # that have a line open for receiving.
            full = self.cfg.with_(require_open_for_receiving=False)
            t = self.t
            all_lines = mt.material_lines(self.scoped_items, full)
            all_totals = mt.line_totals(all_lines, full)
            all_acc = mt.accepted_receipts(t.receipt_items, all_totals, t.receipts, t.documents, t.order_receipt_map, full)
            return mt.open_material_list(
                mt.outstanding_material(all_lines, all_acc, full), all_totals, self.outstanding_material, full
            )
        # Without the restriction the list is the open material lines without
        # the unit price (same rows), so it is read from that stage.
        return self.open_material_lines.drop("unit_price")

    @cached_property
    def open_material_list_direct(self) -> DataFrame:
        """O16 by its own operator, the order restriction included."""
        return mt.open_material_list(self.outstanding_material, self.line_totals_material, self.outstanding_material, self.cfg)

    # --- service (O17-O22) -------------------------------------------------------
    @cached_property
    def contract_expiry(self) -> DataFrame:
        t = self.t
        items = self._sift(t.order_items, "order_id", self.scope.selectExpr("document_code AS order_id"), "scope")
        return sv.contract_expiry(t.documents, items, t.contracts, self.scope, self.cfg)

    @cached_property
    def service_lines(self) -> DataFrame:
        return self._share(sv.service_lines(self.scoped_items, self.contract_expiry, self.cfg), "service_lines")

    @cached_property
    def line_totals_service(self) -> DataFrame:
        return mt.line_totals(self.service_lines.drop("date_difference"), self.cfg)

    @cached_property
    def approved_confirmations(self) -> DataFrame:
        t = self.t
        return sv.approved_confirmations(t.confirmation_items, t.documents, t.order_confirmation_map, self.scope, self.cfg)

    @cached_property
    def confirmation_balance(self) -> DataFrame:
        t = self.t
        return sv.confirmation_balance(
            self.service_lines,
            t.order_items,
            t.confirmations,
            t.documents,
            t.confirmation_items,
            self.approved_confirmations,
            self.order_item_credit,
            self.cfg,
        )

    @cached_property
    def service_balance(self) -> DataFrame:
        """O20 without the credit join: same approved values per item (see
        ``confirmation_balance``), used by the extracts (credits reach no
        column of either extract)."""
        t = self.t
        items = self._sift(t.order_items, "order_id", self.service_lines, "service_lines")
        return sv.confirmation_balance(
            self.service_lines, items, t.confirmations, t.documents, t.confirmation_items,
            self.approved_confirmations, None, self.cfg,
        )

    @cached_property
    def outstanding_service(self) -> DataFrame:
        return self._share(sv.outstanding_service(self.service_lines, self.service_balance), "outstanding_service")

    @cached_property
    def open_service_lines(self) -> DataFrame:
        return self._share(
            sv.open_service_lines(self.outstanding_service, self.line_totals_service, self.cfg), "open_service"
        )

    def service_grace_filter(self, days: int = 180) -> DataFrame:
        return sv.open_service_lines(self.outstanding_service, self.line_totals_service, self.cfg, grace_days=days)

    # --- line list (O23-O25) -----------------------------------------------------
    @cached_property
    def legacy_order_amount(self) -> DataFrame:
        from .extracts import legacy_order_amount

        rejected = self.line_rejects.select("order_item_id") if self.checked else None
        return legacy_order_amount(self.open_material_lines, self.open_service_lines, rejected)

    @cached_property
    def legacy_service_prices(self) -> DataFrame:
        from .extracts import legacy_service_prices

        return legacy_service_prices(self.open_material_lines, self.open_service_lines)

    @cached_property
    def draft_orders(self) -> DataFrame:
        t = self.t
        return self._share(sc.draft_orders(t.documents, t.purchase_orders, t.document_bu, self.cfg), "draft_orders")

    @cached_property
    def recent_drafts(self) -> DataFrame:
        items = self._sift(self.t.order_items, "order_id", self.draft_orders, "draft_orders")
        drafts = sc.draft_lines(self.draft_orders, items)
        return drafts if self.orders is None else drafts.join(self.orders, "order_id", "left_semi")

    @cached_property
    def extract_line_list(self) -> DataFrame:
        lines = sc.extract_line_list(self.open_material_list, self.open_service_lines, self.recent_drafts)
        if not self.checked:
            return lines
        item = ["order_id", "order_item_id"]
        return lines.join(self.line_rejects.select(*item).distinct(), item, "left_anti")

    @cached_property
    def line_rejects(self) -> DataFrame:
        """Scoped lines whose amounts do not fit their types (reject channel)."""
        return self._share(
            rj.line_rejects(self.scoped_items, self.accepted_receipts, self.approved_confirmations, self.cfg), "line_rejects"
        )

    def rejects(self, kind: str) -> DataFrame:
        """The second output of an extract ("tax" or "accounting"): every row that was taken out, with rule and keys."""
        from .extracts import checked_tax_rows

        rows = checked_tax_rows(self) if kind == "tax" else self.checked_splits
        own = rj.reject_rows("tax_row" if kind == "tax" else "split", rj.parted(rows)[1])
        return rj.reject_rows("line", self.line_rejects).unionByName(own)

    @cached_property
    def line_trace(self) -> DataFrame:
        """Every order line with the rules that keep it out of the line list."""
        t = self.t
        documents = t.documents.filter("is_deleted = 0").selectExpr("document_code AS order_id")
        live = t.purchase_orders.select("order_id").join(documents, "order_id", "left_semi")
        return tr.line_trace(t.order_items, sc.scope_orders(self.scope), live, self.accepted_receipts, self.recent_drafts, self.cfg)

    # --- accounting (O26-O34) ----------------------------------------------------
    @cached_property
    def contacts(self) -> DataFrame:
        return sp.contacts(self.t.user_partner_map, self.t.users)

    @cached_property
    def split_orders(self) -> DataFrame:
        t = self.t
        return self._share(
            sp.split_orders(t.purchase_orders, t.documents, self.reported_scope, t.order_entity_details, t.document_bu,
                            t.document_lob_map, t.entities, self.cfg),
            "split_orders",
        )

    @cached_property
    def split_order_items(self) -> DataFrame:
        items = self._sift(self.t.order_items, "order_id", self.split_orders, "split_orders")
        return self._share(sp.split_order_items(items, self.split_orders, self.cfg), "split_order_items")

    @property
    def _bucketed(self) -> bool:
        """Whether the split tables share buckets (``sources.layout``), so that they are not shuffled at all."""
        return len(sp.split_key(self.t.split_entities)) > 1

    @cached_property
    def open_split_entities(self) -> DataFrame:
        """The split entities without most of those of splits that are not open."""
        if self._bucketed:
            return self.t.split_entities
        return self._sift(self.t.split_entities, "order_split_item_id", self.split_lines, "split_lines")

    def _split_lines(self, cfg: ExtractConfig) -> DataFrame:
        splits = self.t.split_items
        if not self._bucketed:
            splits = self._sift(splits, "order_item_id", self.split_order_items, "split_order_items")
        return sp.split_lines(splits, self.split_order_items, self.extract_line_list,
                              self.outstanding_material, self.outstanding_service, cfg)

    @cached_property
    def checked_splits(self) -> DataFrame:
        return self._share(self._split_lines(self.cfg), "checked_splits")

    @cached_property
    def split_lines(self) -> DataFrame:
        if self.checked:
            return rj.parted(self.checked_splits)[0]
        return self._share(self._split_lines(self.cfg), "split_lines")

    @cached_property
    def split_lines_truncated(self) -> DataFrame:
        """The split rows with quotients cut off as in the source database."""
        return self._split_lines(self.cfg.with_(decimal_division="truncate", on_overflow="error"))

    @cached_property
    def split_field_rows(self) -> DataFrame:
        return sp.split_field_rows(self.split_lines, self.open_split_entities, self.t.split_field_config, self.cfg)

    @cached_property
    def resolved_dimensions(self) -> DataFrame:
        """Field rows of the open splits, still narrow."""
        fields = sp.open_split_fields(self.split_lines, self.open_split_entities, self.t.split_field_config, self.cfg)
        return sp.resolve_dimensions(fields, self.contacts, self.t.entities, self.cfg)

    @cached_property
    def pivot_dimensions(self) -> DataFrame:
        """``resolved_dimensions`` with the field values that the pivot reads."""
        fields = sp.open_split_fields(self.split_lines, self.open_split_entities, self.t.split_field_config, self.cfg, True)
        return sp.resolve_dimensions(fields, self.contacts, self.t.entities, self.cfg)

    @cached_property
    def pivot_texts(self) -> DataFrame:
        t = self.t
        return self._share(
            sp.pivot_texts(self.contacts, t.entities, t.split_entities, t.split_field_config, self.cfg), "pivot_texts"
        )

    @cached_property
    def split_dimensions(self) -> DataFrame:
        """Narrow pivot: over places in a dictionary of the texts where that is small, else over the texts."""
        dictionary = sp.text_dictionary(self.pivot_texts)
        if dictionary is None:
            return sp.split_dimensions(self.pivot_dimensions, self.cfg)
        return sp.split_dimensions_by_code(self.pivot_dimensions, dictionary, self.cfg)

    @cached_property
    def accounting_pivot(self) -> DataFrame:
        return sp.accounting_pivot(self.split_lines, self.split_dimensions)

    @cached_property
    def accounting_extract(self) -> DataFrame:
        return sp.split_labels(self.accounting_pivot, self.cfg)

    # --- tax (O35-O36) -----------------------------------------------------------
    @cached_property
    def report_orders(self) -> DataFrame:
        return self._share(
            sp.report_orders(self.t.purchase_orders, self.t.documents, self.reported_scope, self.cfg), "report_orders"
        )

    @cached_property
    def tax_items(self) -> DataFrame:
        from .extracts import tax_items

        return self._share(tax_items(self.t.order_items, self.report_orders, self.cfg), "tax_items")

    @cached_property
    def tax_extract(self) -> DataFrame:
        from .extracts import tax_rows

        return tax_rows(self)
