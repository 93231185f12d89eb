"""Shared pieces of the SQL statements. They restate the table adapters on their own."""

from __future__ import annotations

SALES = """sales AS (
    SELECT l_orderkey * 10 + l_linenumber AS sale_id, l_orderkey AS order_id,
           l_suppkey AS vendor_id, l_partkey AS product_id,
           CAST(l_shipdate AS DATE) AS sale_date, strftime(l_shipdate, '%Y-%m') AS month,
           CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS sale_amount,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, o_custkey AS customer_id,
           length(CAST(l_orderkey AS VARCHAR))
             + length(concat_ws('|', l_returnflag, l_linestatus, CAST(l_partkey AS VARCHAR))) AS width
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""

VENDORS = """vendors AS (
    SELECT s_suppkey AS vendor_id, s_name AS vendor_name, r_name AS region, s_acctbal AS balance
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey)"""

CUSTOMERS = """customers AS (
    SELECT c_custkey AS customer_id, c_name AS customer_name, r_name AS region
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey)"""

STAR = f"""{SALES}, {VENDORS}, {CUSTOMERS},
star AS (
    SELECT sales.*, v.vendor_name, v.region AS vendor_region, c.region AS customer_region,
           p_name AS product_name, CAST(p_size AS BIGINT) AS category_id
    FROM sales LEFT JOIN vendors v USING (vendor_id) LEFT JOIN customers c USING (customer_id)
    LEFT JOIN part ON product_id = p_partkey)"""


def bigint(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def total(expression: str) -> str:
    return bigint(f"sum({expression})")


def money(cents: str) -> str:
    return f"({cents}) / 100.0"


def mean_money(cents: str, rows: str) -> str:
    """Half-up average in cents; amounts are not negative."""
    return f"((2 * {cents} + {rows}) // (2 * {rows})) / 100.0"


def md5_mod(text: str, modulo: str | int) -> str:
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) % {modulo})"


def ratio(numerator: str, denominator: str) -> str:
    """The sentinel ratio."""
    return (
        f"CASE WHEN {denominator} > 0 THEN CAST({numerator} AS DOUBLE) / {denominator} "
        f"WHEN {numerator} > 0 THEN 999999.0 ELSE 0.0 END"
    )


def rounded(quotient: str, digits: int) -> str:
    """Half-up rounding of a moderate double by its decimal digits."""
    return f"CAST(round(CAST({quotient} AS DECIMAL(38, 15)), {digits}) AS DOUBLE)"
