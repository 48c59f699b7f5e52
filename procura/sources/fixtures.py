"""Test fixture: the procurement tables derived from the driver's parquet tables.

The mapping is the one in FIXTURES.md.  Each table is one SQL text that both
Spark (``spark.sql`` with DataFrame arguments) and DuckDB (as a ``WITH`` prefix
of an oracle query) run unchanged, so both engines see identical inputs.
Placeholders in braces name either a driver table (``{orders}``) or a helper
relation (``{line}``, ``{split}``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import Tables

DRIVER_TABLES = ("orders", "lineitem", "customer", "supplier", "nation", "part")

# Item id of an order line (n numbers the lines of its order, below 1000), and the
# persistent line id: that of a change order (k % 10 = 7) points at the parent's line.
_ITEM = "(k * 1000 + n)"
_LINE_ID = "CASE WHEN k % 10 = 7 THEN (k - 1) * 1000 + n ELSE k * 1000 + n END"

HELPERS = {
    # (l_orderkey, l_linenumber) repeats in the driver data: every row is a line of its own,
    # numbered within its order.  Rows that tie in all columns of the order are alike.
    "line": """
SELECT l_orderkey AS k,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                               l_extendedprice, l_tax, l_shipdate) AS bigint) AS n,
       CAST(l_quantity AS decimal(18,6)) AS q,
       CAST(l_extendedprice AS decimal(18,6)) AS xp,
       CAST(l_tax AS decimal(18,6)) AS tx,
       l_suppkey AS sk, l_partkey AS pk, l_shipdate AS sd
FROM {lineitem}""",
    "split": f"""
SELECT {_ITEM} * 10 + 1 AS os, 1 AS s, k, n, q, pk FROM {{line}}
UNION ALL
SELECT {_ITEM} * 10 + 2 AS os, 2 AS s, k, n, q, pk FROM {{line}}""",
}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _doc(code: str, number: str, status: str, dtype: int, deleted: str, visible: str, created: str, src: str) -> str:
    return f"""SELECT CAST({code} AS bigint) AS document_code,
       CAST({number} AS string) AS document_number,
       CAST({status} AS int) AS document_status,
       CAST({dtype} AS int) AS document_type,
       CAST({deleted} AS int) AS is_deleted,
       CAST({visible} AS int) AS is_buyer_visible,
       CAST({created} AS timestamp) AS date_created
FROM {src}"""


_SPLIT_ENTITY_BRANCHES = [
    f"""SELECT CAST(os * 10 + {f} AS bigint) AS order_split_item_entity_id,
       CAST(os AS bigint) AS order_split_item_id,
       CAST({f} AS bigint) AS config_id,
       CAST({{code}} AS string) AS entity_code,
       CAST({{value}} AS string) AS field_value
FROM {{{{split}}}}"""
    for f in range(1, 6)
]
_SPLIT_ENTITY_CODES = {
    1: ("NULL", "7000 + (k * 1000 + n) % 97"),
    2: ("concat('P', CAST(os % 12 AS string))", "NULL"),
    3: ("concat('E5-', CAST(pk - pk % 8 + 2 AS string))", "NULL"),
    4: ("concat('E12-', CAST(pk - pk % 8 + 4 AS string))", "NULL"),
    5: ("'E6-3'", "NULL"),
}

# Entity type of a part: one eighth of the parts each; codes are unique within a type.
_ENTITY_GROUP = ("CASE p_partkey % 8 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 5 WHEN 3 THEN 6 "
                 "WHEN 4 THEN 12 WHEN 5 THEN 22 WHEN 6 THEN 27 ELSE 44 END")

TABLE_SQL: dict[str, str] = {
    "documents": _union([
        _doc("o_orderkey", "concat('PO-', CAST(o_orderkey AS string))",
             "CASE o_orderkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 21 WHEN 2 THEN 22 WHEN 3 THEN 24 WHEN 4 THEN 25 "
             "WHEN 5 THEN 142 WHEN 6 THEN 41 ELSE 99 END",
             8, "CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END",
             "CASE WHEN o_orderkey % 40 = 1 THEN 0 ELSE 1 END", "o_orderdate", "{orders}"),
        _doc("100000000 + o_orderkey", "concat('INV-', CAST(o_orderkey AS string))",
             "CASE o_orderkey % 14 WHEN 0 THEN 68 WHEN 2 THEN 77 WHEN 4 THEN 102 WHEN 6 THEN 104 WHEN 8 THEN 105 "
             "WHEN 10 THEN 153 ELSE 1 END",
             7, "0", "1", "o_orderdate", "{orders} WHERE o_orderkey % 2 = 0"),
        _doc("200000000 + o_orderkey", "concat('RCV-', CAST(o_orderkey AS string))",
             "CASE WHEN o_orderkey % 5 = 0 THEN 170 ELSE 175 END",
             9, "0", "1", "o_orderdate", "{orders} WHERE o_orderkey % 3 <> 0"),
        _doc("300000000 + o_orderkey", "concat('SC-', CAST(o_orderkey AS string))",
             "CASE WHEN o_orderkey % 7 = 0 THEN 21 ELSE 22 END",
             10, "0", "1", "o_orderdate", "{orders} WHERE o_orderkey % 3 <> 1"),
        _doc("400000000 + o_orderkey", "concat('CM-', CAST(o_orderkey AS string))",
             "CASE o_orderkey % 16 WHEN 0 THEN 101 WHEN 4 THEN 102 WHEN 8 THEN 156 ELSE 1 END",
             11, "0", "1", "o_orderdate", "{orders} WHERE o_orderkey % 4 = 0"),
        _doc("500000000 + s_suppkey", "concat('C-', CAST(s_suppkey AS string))",
             "CASE s_suppkey % 4 WHEN 0 THEN 71 WHEN 1 THEN 83 WHEN 2 THEN 125 ELSE 1 END",
             5, "0", "1", "'2000-01-01 00:00:00'", "{supplier}"),
    ]),
    "purchase_orders": """
SELECT CAST(o_orderkey AS bigint) AS order_id,
       CAST(CASE WHEN o_orderkey % 10 = 7 THEN 5 WHEN o_orderkey % 4 = 0 THEN 1 WHEN o_orderkey % 4 = 1 THEN 2
                 WHEN o_orderkey % 4 = 2 THEN 7 ELSE 3 END AS int) AS order_source,
       CAST(CASE WHEN o_orderkey % 10 = 7 THEN o_orderkey - 1 END AS bigint) AS parent_document_code,
       CAST(o_custkey AS bigint) AS partner_code,
       CAST(CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS int) AS is_close_for_invoicing,
       CAST(CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS int) AS is_close_for_receiving,
       CAST(CASE WHEN o_orderkey % 30 = 3 THEN 124 ELSE 0 END AS int) AS closing_order_status
FROM {orders}""",
    "document_bu": """
SELECT CAST(o_orderkey AS bigint) AS document_code, CAST(900 + c_nationkey AS bigint) AS bu_code
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
UNION ALL
SELECT CAST(o_orderkey AS bigint) AS document_code, CAST(900 + (c_nationkey + 1) % 25 AS bigint) AS bu_code
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
WHERE o_orderkey % 20 = 4""",
    "entities": f"""
SELECT CAST(900 + n_nationkey AS bigint) AS entity_detail_code,
       CAST(concat('BU', CAST(n_nationkey AS string)) AS string) AS entity_code,
       CAST(CASE WHEN n_nationkey % 5 = 0 THEN 44 ELSE 9 END AS int) AS entity_id,
       CAST(n_regionkey AS bigint) AS lob_entity_detail_code
FROM {{nation}}
UNION ALL
SELECT CAST(10000 + p_partkey AS bigint) AS entity_detail_code,
       CAST(concat('E', CAST({_ENTITY_GROUP} AS string), '-', CAST(p_partkey AS string)) AS string) AS entity_code,
       CAST({_ENTITY_GROUP} AS int) AS entity_id,
       CAST(0 AS bigint) AS lob_entity_detail_code
FROM {{part}}""",
    "partners": """
SELECT CAST(c_custkey AS bigint) AS partner_code, CAST(c_custkey % 8 AS int) AS partner_status_code
FROM {customer}""",
    "order_items": f"""
SELECT CAST({_ITEM} AS bigint) AS order_item_id,
       CAST(k AS bigint) AS order_id,
       CAST(n AS int) AS line_number,
       CAST({_LINE_ID} AS bigint) AS p2p_line_item_id,
       CAST(q AS decimal(18,6)) AS quantity,
       CAST(xp AS decimal(18,6)) AS unit_price,
       CAST(pk % 3 + 1 AS int) AS item_extended_type,
       CAST(pk % 3 + 1 AS int) AS item_type_id,
       CAST(CASE WHEN {_ITEM} % 33 = 0 THEN 121 ELSE 0 END AS int) AS item_status,
       CAST(CASE WHEN {_ITEM} % 29 = 0 THEN 124 ELSE 0 END AS int) AS closing_order_status,
       CAST(CASE WHEN {_ITEM} % 6 = 1 THEN 1 ELSE 0 END AS int) AS is_close_for_invoicing,
       CAST(CASE WHEN {_ITEM} % 9 = 1 THEN 1 ELSE 0 END AS int) AS is_close_for_receiving,
       CAST(CASE WHEN {_ITEM} % 45 = 0 THEN 1 ELSE 0 END AS int) AS is_deleted,
       CAST(CASE WHEN {_ITEM} % 5 = 0 THEN concat('C-', CAST(sk AS string))
                 WHEN {_ITEM} % 5 = 1 THEN '' END AS string) AS contract_no,
       CAST(sd AS timestamp) AS end_date,
       CAST(CASE WHEN {_ITEM} % 4 = 0 THEN xp * 2 END AS decimal(18,6)) AS overall_item_limit,
       CAST({_ITEM} % 4 AS int) AS receiving_status,
       CAST({_ITEM} % 3 AS int) AS line_asn_status,
       CAST(xp * tx AS decimal(18,6)) AS tax,
       CAST(CASE WHEN {_ITEM} % 7 <> 0 THEN 3 END AS decimal(18,6)) AS shipping_charges,
       CAST(CASE WHEN {_ITEM} % 11 = 0 THEN 2 END AS decimal(18,6)) AS additional_charges,
       CAST(sd AS timestamp) AS date_needed,
       CAST(CASE WHEN {_ITEM} % 5 <> 0 THEN sd END AS timestamp) AS date_requested,
       CAST(CASE WHEN {_ITEM} % 2 = 0 THEN sd END AS timestamp) AS start_date,
       CAST({_ITEM} % 10 AS decimal(18,6)) AS discount_percentage,
       CAST(CASE WHEN {_ITEM} % 9 = 0 THEN 5 END AS decimal(18,6)) AS markup_percentage,
       CAST(q / 10 AS decimal(18,6)) AS discount,
       CAST(CASE WHEN {_ITEM} % 9 = 0 THEN q / 20 END AS decimal(18,6)) AS markup,
       CAST(CASE WHEN {_ITEM} % 3 = 0 THEN xp * tx / 2 END AS decimal(18,6)) AS external_tax
FROM {{line}}""",
    "order_invoice_map": """
SELECT CAST(100000000 + o_orderkey AS bigint) AS invoice_id, CAST(o_orderkey AS bigint) AS order_id
FROM {orders} WHERE o_orderkey % 2 = 0""",
    "invoice_items": f"""
SELECT CAST(1000000000 + {_ITEM} AS bigint) AS invoice_item_id,
       CAST({_LINE_ID} AS bigint) AS p2p_line_item_id,
       CAST(100000000 + k AS bigint) AS invoice_id,
       CAST(0 AS int) AS is_deleted,
       CAST(q / 2 AS decimal(18,6)) AS quantity,
       CAST(pk % 3 + 1 AS int) AS item_extended_type,
       CAST({_ITEM} % 2 AS int) AS credit_type,
       CAST(xp AS decimal(18,6)) AS unit_price,
       CAST(1 AS decimal(18,6)) AS tax,
       CAST(2 AS decimal(18,6)) AS additional_charges,
       CAST(CASE WHEN {_ITEM} % 4 = 1 THEN 3 END AS decimal(18,6)) AS shipping_charges
FROM {{line}} WHERE k % 2 = 0 AND {_ITEM} % 5 <> 0""",
    "credit_memo_items": f"""
SELECT CAST(400000000 + k AS bigint) AS credit_memo_id,
       CAST(1000000000 + {_ITEM} AS bigint) AS invoice_item_id,
       CAST({_ITEM} AS bigint) AS order_item_id,
       CAST(q / 4 AS decimal(18,6)) AS credit_quantity,
       CAST(xp AS decimal(18,6)) AS credit_amount,
       CAST(1 AS decimal(18,6)) AS tax,
       CAST(2 AS decimal(18,6)) AS shipping_charges,
       CAST(NULL AS decimal(18,6)) AS additional_charges,
       CAST(CASE WHEN {_ITEM} % 17 = 0 THEN 1 ELSE 0 END AS int) AS is_deleted
FROM {{line}} WHERE k % 4 = 0 AND {_ITEM} % 5 IN (1, 2)
UNION ALL
SELECT CAST(400000000 + k AS bigint) AS credit_memo_id,
       CAST(CASE WHEN k % 8 = 0 THEN 0 END AS bigint) AS invoice_item_id,
       CAST({_ITEM} AS bigint) AS order_item_id,
       CAST(q / 4 AS decimal(18,6)) AS credit_quantity,
       CAST(xp AS decimal(18,6)) AS credit_amount,
       CAST(NULL AS decimal(18,6)) AS tax,
       CAST(NULL AS decimal(18,6)) AS shipping_charges,
       CAST(3 AS decimal(18,6)) AS additional_charges,
       CAST(0 AS int) AS is_deleted
FROM {{line}} WHERE k % 4 = 0 AND {_ITEM} % 5 = 3""",
    "invoices": """
SELECT CAST(100000000 + o_orderkey AS bigint) AS invoice_id,
       CAST(CASE WHEN o_orderkey % 12 = 0 THEN 6 ELSE 1 END AS int) AS invoice_type
FROM {orders} WHERE o_orderkey % 2 = 0""",
    "receipt_items": f"""
SELECT CAST(200000000 + k AS bigint) AS receipt_id,
       CAST({_LINE_ID} AS bigint) AS p2p_line_item_id,
       CAST(CASE {_ITEM} % 5 WHEN 1 THEN q WHEN 2 THEN q / 2 WHEN 3 THEN q * 2 END AS decimal(18,6))
            AS accepted_quantity,
       CAST(CASE WHEN {_ITEM} % 41 = 0 THEN 121 ELSE 0 END AS int) AS item_status,
       CAST(0 AS int) AS is_deleted
FROM {{line}} WHERE k % 3 <> 0 AND {_ITEM} % 5 <> 0""",
    "receipts": """
SELECT CAST(200000000 + o_orderkey AS bigint) AS receipt_id,
       CAST(CASE WHEN o_orderkey % 70 = 1 THEN 1 ELSE 0 END AS int) AS is_deleted
FROM {orders} WHERE o_orderkey % 3 <> 0""",
    "order_receipt_map": """
SELECT CAST(200000000 + o_orderkey AS bigint) AS receipt_id, CAST(o_orderkey AS bigint) AS order_id
FROM {orders} WHERE o_orderkey % 3 <> 0""",
    "contracts": """
SELECT CAST(500000000 + s_suppkey AS bigint) AS document_code,
       CAST(CAST('2001-01-01' AS date) + CAST(s_suppkey % 400 AS int) AS timestamp) AS date_expiry
FROM {supplier}""",
    "confirmation_items": f"""
SELECT CAST(300000000 + k AS bigint) AS service_confirmation_id,
       CAST({_LINE_ID} AS bigint) AS p2p_line_item_id,
       CAST(CASE WHEN pk % 3 = 1 THEN 1 ELSE CASE WHEN {_ITEM} % 3 = 0 THEN xp WHEN {_ITEM} % 3 = 1 THEN xp * 2
            ELSE xp / 4 END END AS decimal(18,6)) AS quantity,
       CAST(CASE WHEN pk % 3 = 2 THEN 1 ELSE CASE WHEN {_ITEM} % 3 = 0 THEN xp WHEN {_ITEM} % 3 = 1 THEN xp * 2
            ELSE xp / 4 END END AS decimal(18,6)) AS unit_price,
       CAST(pk % 3 + 1 AS int) AS item_extended_type,
       CAST(CASE WHEN {_ITEM} % 7 = 0 THEN 2 ELSE 1 END AS int) AS item_level,
       CAST(0 AS int) AS is_deleted
FROM {{line}} WHERE k % 3 <> 1 AND pk % 3 IN (1, 2) AND {_ITEM} % 6 <> 0""",
    "order_confirmation_map": """
SELECT CAST(300000000 + o_orderkey AS bigint) AS service_confirmation_id, CAST(o_orderkey AS bigint) AS order_id
FROM {orders} WHERE o_orderkey % 3 <> 1""",
    "confirmations": """
SELECT CAST(300000000 + o_orderkey AS bigint) AS service_confirmation_id, CAST(o_orderkey AS bigint) AS order_id
FROM {orders} WHERE o_orderkey % 3 <> 1""",
    "user_partner_map": """
SELECT CAST(s_suppkey AS bigint) AS user_id, CAST(7000 + s_suppkey AS bigint) AS contact_code
FROM {supplier}""",
    "users": """
SELECT CAST(s_suppkey AS bigint) AS user_id,
       CAST(s_name AS string) AS user_name,
       CAST(concat('F', CAST(s_suppkey AS string)) AS string) AS first_name,
       CAST(CASE WHEN s_suppkey % 3 <> 0 THEN concat('L', CAST(s_suppkey AS string)) END AS string) AS last_name
FROM {supplier}""",
    "split_entities": _union([
        _SPLIT_ENTITY_BRANCHES[f - 1].format(code=_SPLIT_ENTITY_CODES[f][0], value=_SPLIT_ENTITY_CODES[f][1])
        for f in range(1, 6)
    ]),
    "split_items": f"""
SELECT CAST(os AS bigint) AS order_split_item_id,
       CAST({_ITEM} AS bigint) AS order_item_id,
       CAST(k % 3 AS int) AS split_type,
       CAST(q / 2 AS decimal(18,6)) AS quantity,
       CAST(50 AS decimal(18,6)) AS percentage,
       CAST(s AS decimal(18,6)) AS tax,
       CAST(2 AS decimal(18,6)) AS shipping_charges,
       CAST(CASE WHEN s = 1 THEN 1 END AS decimal(18,6)) AS additional_charges,
       CAST(s AS int) AS split_line_number,
       CAST(CASE WHEN {_ITEM} % 37 = 0 THEN 1 ELSE 0 END AS int) AS is_deleted
FROM {{split}}""",
    "split_field_config": _union([
        f"""SELECT CAST({f} AS bigint) AS config_id,
       CAST({ {3: 5, 4: 12, 5: 6}.get(f, 0) } AS int) AS entity_type_id,
       CAST('{ {1: 'Requester', 2: 'Period', 3: 'Company Code', 4: 'Cost Center'}.get(f, 'GL Account') }' AS string)
            AS field_name,
       CAST({1 if f <= 2 else 4} AS int) AS field_control_type,
       CAST({7 if f == 5 else 8} AS int) AS document_type,
       CAST(2 AS int) AS level_type"""
        for f in range(1, 6)
    ]),
    "order_entity_details": """
SELECT CAST(o_orderkey AS bigint) AS order_id FROM {orders} WHERE o_orderkey % 100 <> 99""",
    "document_lob_map": """
SELECT CAST(o_orderkey AS bigint) AS document_code, CAST(900 + c_nationkey AS bigint) AS entity_detail_code
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "order_external_taxes": f"""
SELECT CAST({_ITEM} AS bigint) AS order_item_id,
       CAST(CASE WHEN {_ITEM} % 3 <> 0 THEN concat('Tax ', CAST(n AS string)) END AS string) AS tax_description,
       CAST(concat('A', CAST({_ITEM} % 5 AS string)) AS string) AS authority_name,
       CAST(CASE WHEN {_ITEM} % 3 <> 0 THEN concat('T', CAST({_ITEM} % 4 AS string)) END AS string) AS tax_code,
       CAST('SALES' AS string) AS tax_type,
       CAST(CASE WHEN {_ITEM} % 11 <> 0 THEN tx END AS decimal(18,6)) AS tax_rate,
       CAST(xp AS decimal(18,6)) AS tax_base,
       CAST(xp * tx AS decimal(18,6)) AS applied_tax_value,
       CAST(tx AS decimal(18,6)) AS applied_tax_rate,
       CAST(CASE WHEN {_ITEM} % 2 = 0 THEN 'STATE' END AS string) AS authority_type,
       CAST(CASE WHEN {_ITEM} % 13 = 0 THEN 1 WHEN {_ITEM} % 13 = 1 THEN 0 END AS int) AS is_tax_overridden,
       CAST(CASE WHEN k % 2 = 0 THEN k END AS bigint) AS external_address_id,
       CAST(CASE WHEN {_ITEM} % 19 = 0 THEN 1 ELSE 0 END AS int) AS is_deleted
FROM {{line}} WHERE {_ITEM} % 8 <> 0""",
}

FIXTURE_TABLES = tuple(TABLE_SQL)
# The relations that take a shuffle to derive, and the documents, which every stage filters at the scan; every other
# table is a projection of these and of the driver tables.
STAGED = ("line", "documents", "document_bu", "document_lob_map")


def _placeholders(text: str) -> list[str]:
    import re

    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def derive_tables(spark: SparkSession, sf_dir: str, staged_dir: str | None = None) -> Tables:
    """Build the fixture tables lazily from the driver parquet in ``sf_dir``.

    With ``staged_dir`` the relations of ``STAGED`` are written there, where they are not yet, and read back: every
    order line is numbered by one shuffle, whatever the number of tables made of it.
    """
    base = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in DRIVER_TABLES}
    # Shuffled as stored: the window would shuffle the decimals made of the amounts beside the amounts.
    base["lineitem"] = base["lineitem"].repartition("l_orderkey")
    rel: dict[str, DataFrame] = dict(base)

    def relation(name: str, text: str) -> DataFrame:
        args = {p: rel[p] for p in _placeholders(text)}
        df = spark.sql(text, **args) if args else spark.sql(text)
        if staged_dir is None or name not in STAGED:
            return df
        path = f"{staged_dir}/{name}"
        if not _exists(spark, f"{path}/_SUCCESS"):
            df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    for name, text in HELPERS.items():
        rel[name] = relation(name, text)
    return Tables(**{name: relation(name, text) for name, text in TABLE_SQL.items()})


def materialize(spark: SparkSession, sf_dir: str, out_dir: str) -> str:
    """Write the fixture tables as parquet under ``out_dir`` (one folder each)."""
    tables = derive_tables(spark, sf_dir, f"{out_dir}/staged")
    for name in FIXTURE_TABLES:
        getattr(tables, name).write.mode("overwrite").parquet(f"{out_dir}/{name}")
    return out_dir


def duckdb_prefix(prefix: str = "fx_") -> str:
    """All fixture tables as DuckDB CTE definitions (without the leading WITH).

    CTE names carry ``prefix`` so they never shadow the driver's own views
    (the driver already has a table called ``documents``).
    """
    names = {t: t for t in DRIVER_TABLES}
    names.update({h: prefix + h for h in HELPERS})
    parts = [f"{prefix}{h} AS ({HELPERS[h].format(**names)})" for h in HELPERS]
    parts += [f"{prefix}{t} AS ({TABLE_SQL[t].format(**names)})" for t in TABLE_SQL]
    return ",\n".join(parts)
