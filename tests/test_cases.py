
import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from helpers import D, doc, item, order, scope_rows, tables
from procura.config import ExtractConfig, parse_id_list
from procura.functions import formulas as fm
from procura.operators import scope as sc
from procura.plans.pipeline import Pipeline

CFG = ExtractConfig(document_statuses=(1, 21, 22, 25), lob_ids=(0,), bu_codes=(900, 901),
                    as_of=dt.datetime(2001, 8, 1))


def _merge(*parts):
    out = {}
    for p in parts:
        for k, v in p.items():
            out.setdefault(k, []).extend(v)
    return out


def test_id_list_parsing(spark):
    assert sorted(r.id for r in sc.id_list(spark, "1,21, 22").collect()) == [1, 21, 22]
    assert parse_id_list("1, 2") == (1, 2)
    with pytest.raises(ValueError):
        parse_id_list("1,,2")


def test_scope_change_order_and_partner_status(spark):
    base = _merge(
        scope_rows(1), scope_rows(2), scope_rows(3), scope_rows(4, partner=2, partner_status=3),
        {"documents": [doc(1, 22), doc(2, 21), doc(3, 25), doc(4, 22), doc(5, 22)],
         "purchase_orders": [order(1), order(2, source=5, parent=1), order(3, source=5, parent=1),
                             order(4, partner=2), order(5, partner=3)],
         "partners": [dict(partner_code=3, partner_status_code=None)],
         "document_bu": [dict(document_code=5, bu_code=900)]},
    )
    t = tables(spark, **base)
    got = {r.document_code for r in sc.order_scope(t.documents, t.purchase_orders, t.document_bu, t.entities,
                                                     t.partners, CFG).collect()}
    # 2 is an early change order -> parent 1; 3 is later -> itself; 4 blocked partner; 5 NULL status dropped
    assert got == {1, 3}


def test_scope_keeps_one_row_per_bu_and_dedupe_option(spark):
    base = _merge(scope_rows(1), {"documents": [doc(1, 22)], "purchase_orders": [order(1)],
                                  "document_bu": [dict(document_code=1, bu_code=901)],
                                  "entities": [dict(entity_detail_code=901, entity_code="BU901", entity_id=44,
                                                    lob_entity_detail_code=0)]})
    t = tables(spark, **base)
    args = (t.documents, t.purchase_orders, t.document_bu, t.entities, t.partners)
    assert sc.order_scope(*args, CFG).count() == 2
    assert sc.order_scope(*args, CFG.with_(dedupe_scope=True)).count() == 1


def _one_order(spark, items, **extra):
    base = _merge(scope_rows(1), {"documents": [doc(1, 22)], "purchase_orders": [order(1)], "order_items": items},
                  extra)
    return Pipeline(tables(spark, **base), CFG, reuse="none")


def test_outstanding_material_and_open_lines(spark):
    p = _one_order(
        spark, [item(11, 1, 1, qty="10", price="5"), item(12, 1, 2, qty="3", price="2")],
        receipt_items=[dict(receipt_id=7, p2p_line_item_id=11, accepted_quantity=D("4"), item_status=0,
                            is_deleted=0),
                       dict(receipt_id=7, p2p_line_item_id=12, accepted_quantity=D("3"), item_status=0,
                            is_deleted=0)],
        receipts=[dict(receipt_id=7, is_deleted=0)],
        order_receipt_map=[dict(receipt_id=7, order_id=1)],
        documents=[doc(7, 175, dtype=9)],
    )
    om = {r.order_item_id: r for r in p.outstanding_material.collect()}
    assert om[11].difference_quantity == D("6") and om[11].total_accepted_amount == D("20")
    assert om[12].difference_quantity == 0
    assert p.outstanding_material.count() == p.material_lines.count()
    open_ = p.open_material_lines.collect()
    assert [(r.order_item_id, r.quantity, r.current_order_line_total) for r in open_] == [(11, D("6"), D("30"))]


def test_service_blank_contract_uses_end_date(spark):
    end = dt.datetime(2001, 8, 11)
    p = _one_order(spark, [item(11, 1, 1, ext=2, contract="   ", end=end), item(12, 1, 2, ext=3, contract=None,
                                                                              end=dt.datetime(2001, 7, 30))])
    got = {r.order_item_id: r.date_difference for r in p.service_lines.collect()}
    assert got == {11: 10, 12: -2}


def test_outstanding_service_takes_one_approved_value_per_item(spark):
    conf = dict(service_confirmation_id=50, order_id=1)
    ci = dict(service_confirmation_id=50, p2p_line_item_id=11, quantity=D("2"), unit_price=D("3"), item_level=1,
              is_deleted=0)
    p = _one_order(
        spark, [item(11, 1, 1, ext=2, qty="1", price="100")],
        confirmations=[conf], order_confirmation_map=[conf], documents=[doc(50, 22, dtype=10)],
        # the same line id confirmed as an amount line and as a quantity line -> two approved values
        confirmation_items=[dict(ci, item_extended_type=2), dict(ci, item_extended_type=3)],
    )
    assert p.approved_confirmations.count() == 2
    rows = p.outstanding_service.collect()
    assert len(rows) == 1
    assert rows[0].total_received_amount == D("6")  # max(2*3, 2)
    assert rows[0].difference_amount == D("94")


def test_legacy_amount_matches_full_outer_join(spark):
    from procura.plans.extracts import legacy_order_amount, legacy_service_prices

    cols = "order_id bigint, p2p_line_item_id bigint, current_order_line_total decimal(18,6), quantity decimal(18,6)"
    m = spark.createDataFrame(
        [(1, 11, D("5"), D("2")), (1, 12, None, D("1")), (2, 21, D("7"), D("3")), (4, 41, None, D("1"))], cols)
    s = spark.createDataFrame(
        [(1, 13, D("8"), D("1"), D("80")), (1, 14, D("9"), D("1"), D("90")), (1, 15, D("9"), D("1"), D("90")),
         (3, 31, D("4"), D("1"), D("40"))], cols + ", unit_price decimal(18,6)")
    legacy, prices = legacy_order_amount(m, s), legacy_service_prices(m, s)
    assert sorted(tuple(r) for r in prices.collect()) == [(1, D("80")), (1, D("90"))]
    # Rows without a price of their own take every price of their order: the literal five columns.
    own = legacy.filter("unit_price IS NOT NULL")
    paired = legacy.filter("unit_price IS NULL").drop("unit_price").join(prices, "order_id", "left")
    out = ["p2p_line_item_id", "current_order_line_total", "order_id", "quantity", "unit_price"]
    got = sorted((tuple(r) for r in own.select(out).unionByName(paired.select(out)).collect()), key=repr)
    left, right = m.alias("m"), s.alias("s")
    pick = lambda c: F.coalesce(F.col(f"m.{c}"), F.col(f"s.{c}")).alias(c)
    literal = left.join(right, F.col("m.order_id") == F.col("s.order_id"), "full").select(
        *[pick(c) for c in out[:4]], F.col("s.unit_price").alias("unit_price")).distinct()
    assert got == sorted((tuple(r) for r in literal.collect()), key=repr)
    assert len(legacy.collect()) == 6  # 11; 12 twice; 21; 41; 31


def _dec(x):
    return None if x is None else Decimal(x)


def _expected(st, ext, d, a, q, p, sq, stx, pct):
    def r(x, n):
        return x.quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP)

    mat, svc = ext == 1, ext != 1
    if st == 0 and mat:
        share = d / q * sq
        return r(share, 4), r(share * p + share * stx, 3), share * stx
    if st == 0 and svc:
        k = a / p
        return k * sq, r(k * sq + k * stx, 3), k * stx
    if st == 1 and mat:
        return pct, r(pct * d * p / 100 + d / q * stx, 3), d / q * stx
    if st == 1 and svc:
        return pct, r(pct * a / 100 + a / p * stx, 3), a / p * stx
    return None, None, None


def test_split_formula_grid(spark):
    rows = []
    for st in (0, 1, 2):
        for ext in (1, 2, 3):
            for d, a in (("0", "0"), ("5", "2.5"), ("10", "-5"), ("12.5", "5")):
                rows.append((st, ext, D(d), D(a), D("10"), D("5"), D("4"), D("1.5"), D("50")))
    df = spark.createDataFrame(rows, "st int, ext int, d decimal(36,18), a decimal(36,18), q decimal(18,6), "
                                     "p decimal(18,6), sq decimal(18,6), stx decimal(18,6), pct decimal(18,6)")
    c = ("st", "ext", "d", "a", "q", "p", "sq", "stx", "pct")
    st, ext, d, a, q, p, sq, stx, pct = c
    out = df.select(*c, fm.split_quantity(st, ext, d, a, q, p, sq, pct, CFG).alias("qty"),
                    fm.split_item_total(st, ext, d, a, q, p, sq, stx, pct, CFG).alias("total"),
                    fm.split_tax(st, ext, d, a, q, p, sq, stx, CFG).alias("tax")).collect()
    for r in out:
        exp = _expected(r.st, r.ext, r.d, r.a, r.q, r.p, r.sq, r.stx, r.pct)
        assert (r.qty, r.total, r.tax) == exp, (r, exp)


def test_zero_divisor_modes(spark):
    df = spark.createDataFrame([(D("5"), D("0"))], "d decimal(36,18), q decimal(18,6)")
    args = ("0", "1", "d", "CAST(NULL AS decimal(36,18))", "q", "CAST(1 AS decimal(18,6))",
            "CAST(2 AS decimal(18,6))", "CAST(50 AS decimal(18,6))")
    assert df.select(fm.split_quantity(*args, CFG).alias("x")).first().x is None
    with pytest.raises(Exception):
        df.select(fm.split_quantity(*args, CFG.with_(on_zero_divisor="error")).alias("x")).collect()


def test_round_half_away_from_zero(spark):
    r = spark.sql("SELECT CAST(-2.5 AS DECIMAL(18,6)) AS x").select(F.round("x", 0).alias("y")).first()
    assert r.y == D("-3")


def test_write_extract_headers_and_order(spark, tmp_path):
    from procura.plans.extracts import write_extract

    df = spark.createDataFrame([("PO-2", 1), ("PO-1", 2), ("PO-1", 1)], "order_number string, order_line_number int")
    write_extract(df, str(tmp_path / "x"), "tax")
    back = spark.read.parquet(str(tmp_path / "x"))
    assert back.columns == ["OrderNumber (UniqueKey)*", "OrderLineNumber*"]
    assert [tuple(r) for r in back.collect()] == [("PO-1", 1), ("PO-1", 2), ("PO-2", 1)]


def test_contract_match_with_collation(spark):
    base = _merge(scope_rows(1), {"documents": [doc(1, 22), doc(500, 71, dtype=5, number="C-7")],
                                  "purchase_orders": [order(1)],
                                  "order_items": [item(11, 1, 1, ext=2, contract="c-7 ")],
                                  "contracts": [dict(document_code=500, date_expiry=dt.datetime(2001, 8, 31))]})
    t = tables(spark, **base)
    binary = Pipeline(t, CFG, reuse="none")
    assert binary.contract_expiry.count() == 0
    folded = Pipeline(t, CFG.with_(string_collation="UTF8_LCASE_RTRIM"), reuse="none")
    assert folded.contract_expiry.count() == 1
    assert [r.date_difference for r in folded.service_lines.collect()] == [30]


def test_open_for_receiving_option_restricts_material_lines(spark):
    items = [item(11, 1, 1, cfr=1), item(12, 1, 2)]
    p = _one_order(spark, items)
    strict = Pipeline(p.t, CFG.with_(require_open_for_receiving=True), reuse="none")
    assert {r.order_item_id for r in p.open_material_lines.collect()} == {11, 12}
    assert {r.order_item_id for r in strict.open_material_lines.collect()} == {12}
    # the list keeps every open line of an order that has one line open for receiving
    assert {r.order_item_id for r in strict.open_material_list.collect()} == {11, 12}


def test_drafts_window(spark):
    created = [dt.datetime(2001, 6, 3), dt.datetime(2001, 6, 2, 23, 59)]  # 59 and 60 days before as_of
    base = {"documents": [doc(1, 1, created=created[0]), doc(2, 1, created=created[1])],
            "purchase_orders": [order(1), order(2)],
            "order_items": [item(11, 1, 1), item(21, 2, 1)],
            "document_bu": [dict(document_code=1, bu_code=900), dict(document_code=2, bu_code=900)]}
    p = Pipeline(tables(spark, **base), CFG, reuse="none")
    assert [r.order_item_id for r in p.recent_drafts.collect()] == [11]


def test_hot_order_is_not_paired(spark, capsys):
    """One order holding all lines: results stay exact and linear, and the
    semi-join build side over that order is pre-aggregated."""
    n = 60
    items = [item(100 + i, 1, i, ext=1, qty="4", price="3") for i in range(1, n + 1)]
    items += [item(1000 + i, 1, n + i, ext=2, qty="1", price="7") for i in range(1, n + 1)]
    p = _one_order(spark, items)
    assert p.open_material_lines.count() == n
    assert p.open_service_lines.count() == n
    legacy = p.legacy_order_amount.collect()
    # mixed order: the material side is kept, one row per material line
    assert len(legacy) == n and {r.p2p_line_item_id for r in legacy} == {100 + i for i in range(1, n + 1)}
    p.service_balance.explain()
    plan = capsys.readouterr().out
    assert "LeftSemi" in plan and "HashAggregate(keys=[order_id" in plan


def _credit_fixture(spark, extra_bu=False):
    """Order 1 (in scope) is the parent of change order 3, which is in scope
    itself (status 25 is past the early statuses that resolve to the parent).
    Item 11 of order 1 was invoiced on invoice 80 and credited on memo 90
    (two memo lines)."""
    inv_item = dict(invoice_item_id=81, p2p_line_item_id=11, invoice_id=80, is_deleted=0, quantity=D("2"),
                    item_extended_type=1, credit_type=1, unit_price=D("5"), tax=D("1"), additional_charges=None,
                    shipping_charges=None)
    memo = dict(credit_memo_id=90, invoice_item_id=81, order_item_id=11, credit_quantity=D("1"),
                credit_amount=D("5"), tax=None, shipping_charges=None, additional_charges=None, is_deleted=0)
    base = _merge(
        scope_rows(1), scope_rows(3),
        {"documents": [doc(1, 22), doc(3, 25), doc(80, 68, dtype=7), doc(90, 101, dtype=11)],
         "purchase_orders": [order(1), order(3, source=5, parent=1)],
         "order_items": [item(11, 1, 1)],
         "order_invoice_map": [dict(invoice_id=80, order_id=1)],
         "invoice_items": [inv_item],
         "invoices": [dict(invoice_id=80, invoice_type=1)],
         "credit_memo_items": [memo, dict(memo, credit_quantity=D("2"))]},
    )
    if extra_bu:
        base["document_bu"].append(dict(document_code=1, bu_code=901))
        base["entities"].append(dict(entity_detail_code=901, entity_code="BU901", entity_id=9,
                                     lob_entity_detail_code=0))
    return Pipeline(tables(spark, **base), CFG.with_(document_statuses=(22, 25)), reuse="none")


def test_credit_counts_distinct_in_scope_branch_plain_in_parent_branch(spark):
    p = _credit_fixture(spark)
    scoped = p.credit_by_invoice_item_scope.collect()
    parent = p.credit_by_invoice_item_parent.collect()
    assert [(r.order_item_id, r.credit_memo_count, r.credit_qty) for r in scoped] == [(11, 1, D("3"))]
    assert [(r.order_item_id, r.credit_memo_count, r.credit_qty) for r in parent] == [(11, 2, D("3"))]
    # the item is credited through both branches and both halves of the line attachment
    lines = p.credit_memo_lines.collect()
    assert sorted((r.credit_memo_count, r.credit_memo_quantity) for r in lines) == [
        (1, D("3")), (1, D("3")), (2, D("3")), (2, D("3"))]
    by_line = p.credit_by_line.collect()
    assert [(r.p2p_line_item_id, r.credit_count, r.credit_qty) for r in by_line] == [(11, 6, D("12"))]


def test_credit_sums_multiply_with_business_units(spark):
    one = _credit_fixture(spark).credit_by_invoice_item_scope.first()
    two = _credit_fixture(spark, extra_bu=True).credit_by_invoice_item_scope.first()
    # bag semantics: order 1 listed once per business unit multiplies the joined rows
    assert two.credit_qty > one.credit_qty
    assert two.credit_memo_count == one.credit_memo_count  # distinct memo count is unaffected


def test_unset_scope_raises():
    from procura.config import ExtractConfig

    with pytest.raises(ValueError, match="document_statuses, lob_ids, bu_codes, as_of"):
        ExtractConfig()
    with pytest.raises(ValueError, match="as_of"):
        CFG.with_(as_of=None)


def test_parent_items_hand_all_columns_through(spark):
    p = _credit_fixture(spark)
    assert len(p.parent_items.columns) == 23
    assert [r.order_item_id for r in p.parent_items.collect()] == [11]


def test_document_number_filter(spark):
    base = _merge(scope_rows(1), scope_rows(2), {"documents": [doc(1, 22, number="PO-a"), doc(2, 22, number="PO-b")],
                                                 "purchase_orders": [order(1), order(2)]})
    t = tables(spark, **base)
    codes = lambda **kw: [r.document_code for r in Pipeline(t, CFG.with_(**kw), reuse="none").scope.collect()]
    assert codes(document_numbers=("PO-a",)) == [1]
    assert codes(document_numbers=("po-A ",)) == []
    assert codes(document_numbers=("po-A ",), string_collation="UTF8_LCASE_RTRIM") == [1]
    assert codes(document_numbers=("po-A ", "x"), string_collation="UTF8_LCASE_RTRIM", inline_list_limit=1) == [1]


def test_dimensions_with_collation(spark):
    from procura.operators.splits import resolve_dimensions

    rows = spark.createDataFrame(
        [(1, 0, None, "requester ", "77"), (1, 0, "P1", "PERIOD", None), (1, 5, "e5-a ", "Company Code", None)],
        "order_split_item_id bigint, entity_id int, entity_detail_code string, field_name string, field_value string")
    people = spark.createDataFrame([("ann", 77)], "user_name string, contact_code bigint")
    entities = spark.createDataFrame([(9, "E5-A", 5, 0)], "entity_detail_code bigint, entity_code string, entity_id int, lob_entity_detail_code bigint")

    def found(cfg):
        got = resolve_dimensions(rows, people, entities, cfg).collect()
        return {x for r in got for x in (r.requester, r.period, r.dim_entity_code) if x}

    assert found(CFG) == set()
    assert found(CFG.with_(string_collation="UTF8_LCASE_RTRIM")) == {"ann", "P1", "E5-A"}


@pytest.mark.parametrize("limit", [10, 2, 1])
def test_long_lists_are_joined(spark, limit, monkeypatch):
    from procura.functions import decimals

    monkeypatch.setattr(decimals, "BROADCAST_VALUES", 2)
    df = spark.createDataFrame([(i,) for i in (1, 2, 2, 3, None)], "x int")
    got = decimals.keep_in(df, "x", [2, 3, 7], limit)
    assert sorted(r.x for r in got.collect()) == [2, 2, 3]
    if limit == 2:
        assert "Broadcast" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_jdbc_tables_ask_for_partitions(spark):
    from procura.sources.tables import LARGE_TABLES, SCHEMAS, JdbcPartitions, Tables, jdbc_tables

    calls = {}

    class Reader:
        def jdbc(self, url, table, properties=None, **split):
            calls[table] = split
            return spark.createDataFrame([], SCHEMAS[table.removeprefix("db.")])

    class Session:
        read = Reader()

    names = {n: f"db.{n}" for n in Tables.names()}
    ranges = {n: JdbcPartitions("key", 0, 1000, 16) for n in LARGE_TABLES}
    with pytest.raises(ValueError, match="order_items"):
        jdbc_tables(Session(), "jdbc:x", names, {n: r for n, r in ranges.items() if n != "order_items"})
    jdbc_tables(Session(), "jdbc:x", names, ranges)
    assert calls["db.order_items"] == {"column": "key", "lowerBound": 0, "upperBound": 1000, "numPartitions": 16}
    assert calls["db.users"] == {}
    with pytest.raises(ValueError, match="missing column"):
        Reader.jdbc = lambda self, url, table, properties=None, **split: spark.range(0)
        jdbc_tables(Session(), "jdbc:x", names, ranges)


def test_catalog_tables(spark):
    from procura.sources.tables import SCHEMAS, Tables, catalog_tables

    for n in Tables.names():
        spark.createDataFrame([], SCHEMAS[n]).createOrReplaceTempView(f"cat_{n}")
    got = catalog_tables(spark, names={n: f"cat_{n}" for n in Tables.names()})
    assert got.order_items.columns == SCHEMAS["order_items"].names
