"""Extract configuration.

Every business constant of the extracts lives here as a named field.  The
deployment-specific lists (scope statuses, line-of-business ids, business-unit
codes) and the as-of time have no defaults: leaving one out raises.
``ExtractConfig.fixture()`` gives the values the test
fixture is built for.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


def parse_id_list(text: str) -> tuple[int, ...]:
    """Strictly parse a comma separated id list ("1,21, 22") into ints.

    Empty items are rejected: the reference's database would turn them into 0,
    which silently widens a filter.
    """
    out = []
    for raw in text.split(","):
        item = raw.strip()
        if not item or not item.lstrip("-").isdigit():
            raise ValueError(f"not an integer id: {raw!r}")
        out.append(int(item))
    return tuple(out)


@dataclass(frozen=True)
class ExtractConfig:
    # --- deployment scope (caller supplied) ---------------------------------
    document_statuses: tuple[int, ...] = ()
    lob_ids: tuple[int, ...] = ()
    bu_codes: tuple[int, ...] = ()
    document_numbers: tuple[str, ...] | None = None  # None = all documents
    as_of: _dt.datetime | None = None

    # --- fixed values of the extracts (status codes and types) --------------
    scope_entity_types: tuple[int, ...] = (9, 44)
    bu_entity_type: int = 9
    change_order_source: int = 5
    change_order_parent_statuses: tuple[int, ...] = (1, 21, 22, 23, 24)
    change_order_excluded_statuses: tuple[int, ...] = (1, 21, 24)
    open_order_sources: tuple[int, ...] = (1, 2, 7)
    blocked_partner_statuses: tuple[int, ...] = (3, 7)
    closed_status: int = 124
    item_cancelled_status: int = 121
    excluded_document_statuses: tuple[int, ...] = (121, 141)
    invoice_statuses: tuple[int, ...] = (68, 77, 102, 104, 105, 153)
    credit_memo_statuses: tuple[int, ...] = (101, 102, 156)
    credit_invoice_type: int = 6
    credit_invoice_status: int = 153
    credit_quantity_type: int = 1
    receipt_status: int = 175
    confirmation_status: int = 22
    confirmation_item_level: int = 1
    contract_document_type: int = 5
    contract_statuses: tuple[int, ...] = (71, 83, 125)
    draft_status: int = 1
    draft_age_days: int = 60
    order_document_type: int = 8
    split_config_document_type: int = 8
    split_config_level_type: int = 2
    surrogate_field_control_type: int = 4
    requester_field: str = "Requester"
    period_field: str = "Period"
    material_type: int = 1
    service_types: tuple[int, ...] = (2, 3)
    amount_service_type: int = 2
    # Accounting entity types that become output columns AE<n> of the pivot.
    pivot_entity_types: tuple[int, ...] = (
        2, 3, 5, 6, 9, 12, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32, 33, 34,
        35, 39, 40, 42, 43, 44,
    )

    # --- numeric behaviour ---------------------------------------------------
    precision: int = 3            # rounding of split totals
    quantity_precision: int = 4   # rounding of split quantities
    on_zero_divisor: str = "null"  # "null" (pipeline-safe) or "error" (faithful)
    on_overflow: str = "error"  # a value beyond its type ends the job, or "reject": the row goes to the reject channel
    decimal_division: str = "round"  # quotients "round" (half up, as Spark) or "truncate" (as the source database)

    # --- options ---------------------------------------------------------------
    dedupe_scope: bool = False                 # Q1: keep one scope row per order
    require_open_for_receiving: bool = False   # the commented-out item filter
    service_grace_days: int | None = None      # O22x, off as in the reference
    string_collation: str | None = None        # e.g. "UTF8_LCASE_RTRIM"
    # Lists longer than this are joined instead of inlined as IN (...) literals.
    inline_list_limit: int = 1000

    def __post_init__(self) -> None:
        unset = [n for n in ("document_statuses", "lob_ids", "bu_codes", "as_of") if not getattr(self, n)]
        if unset:
            raise ValueError(f"the caller must set: {', '.join(unset)}")
        if self.decimal_division not in ("round", "truncate"):
            raise ValueError('decimal_division must be "round" or "truncate"')
        if self.on_overflow not in ("error", "reject"):
            raise ValueError('on_overflow must be "error" or "reject"')
        if self.on_overflow == "reject" and self.decimal_division == "truncate":
            raise ValueError("the reject channel has rounded quotients only")

    def with_(self, **kw) -> "ExtractConfig":
        return replace(self, **kw)

    @staticmethod
    def fixture() -> "ExtractConfig":
        """Configuration the derived test fixture (FIXTURES.md) is built for."""
        return ExtractConfig(
            document_statuses=(1, 21, 22, 23, 24, 25, 41, 142),
            lob_ids=(0, 1, 2),
            bu_codes=tuple(range(900, 920)),
            document_numbers=None,
            as_of=_dt.datetime(2001, 8, 1, 0, 0, 0),
        )
