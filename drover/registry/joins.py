"""Queries on joins, diffs, lookups and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.functions import scalars
from drover.operators import reconcile
from drover.operators.dml import matched_updates
from drover.plans import prepare
from drover.registry.base import Query, Tables, registrar

QUERIES: dict[str, Query] = {}
query = registrar(QUERIES)

# Customers in credit against urgent orders; the first customer's key is NULL on both sides.
DIFF_SQL = """
    WITH l AS (SELECT nullif(c_custkey, 0) AS c_custkey, c_name FROM customer WHERE c_acctbal > 0),
         r AS (SELECT o_orderkey, nullif(o_custkey, 0) AS o_custkey FROM orders
               WHERE o_orderpriority = '1-URGENT'),
         j AS (SELECT c_custkey, c_name, o_orderkey, o_custkey,
                      CASE WHEN o_orderkey IS NULL THEN 'left_only'
                           WHEN c_name IS NULL THEN 'right_only' ELSE 'both' END AS _merge
               FROM l FULL JOIN r ON c_custkey IS NOT DISTINCT FROM o_custkey)
    SELECT * FROM j"""


def _credit_and_urgent(t: Tables) -> tuple[DataFrame, DataFrame]:
    left = t.customer.filter("c_acctbal > 0").selectExpr("nullif(c_custkey, 0) AS c_custkey", "c_name")
    right = t.orders.filter("o_orderpriority = '1-URGENT'").selectExpr(
        "o_orderkey", "nullif(o_custkey, 0) AS o_custkey"
    )
    return left, right


@query(DIFF_SQL)
def diff_provenance(t: Tables):
    left, right = _credit_and_urgent(t)
    return reconcile.merge(left, right, "c_custkey", "o_custkey", how="outer")


@query("""
    WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE o_custkey END AS k FROM orders),
         r AS (SELECT c_name AS name, c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0
               UNION ALL SELECT s_name, -1 FROM supplier)
    SELECT coalesce(l.k, r.k) AS k, o_orderkey, name,
           CASE WHEN r.k IS NULL THEN 'left_only' WHEN l.k IS NULL THEN 'right_only' ELSE 'both' END AS _merge
    FROM l FULL JOIN r ON l.k = r.k""")
def merge_heavy_keys(t: Tables):
    """One customer holds half of the orders, and one key without orders all suppliers."""
    left = t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE o_custkey END AS k")
    customers = t.customer.filter("c_custkey % 3 <> 0").selectExpr("c_name AS name", "c_custkey AS k")
    right = customers.unionByName(t.supplier.selectExpr("s_name AS name", "-1L AS k"))
    return reconcile.merge(left, right, "k", "k", how="outer", least_heavy=10)


@query(DIFF_SQL + " WHERE _merge = 'both'")
def diff_both(t: Tables):
    left, right = _credit_and_urgent(t)
    return reconcile.diff(left, right, "c_custkey", "o_custkey").both


@query(DIFF_SQL + " WHERE _merge = 'left_only'")
def diff_left_only(t: Tables):
    left, right = _credit_and_urgent(t)
    return reconcile.diff(left, right, "c_custkey", "o_custkey").left_only


@query(DIFF_SQL + " WHERE _merge = 'right_only'")
def diff_right_only(t: Tables):
    left, right = _credit_and_urgent(t)
    return reconcile.diff(left, right, "c_custkey", "o_custkey").right_only


@query("""
    SELECT c_custkey, c_name, c_nationkey, n_nationkey, n_name, 'both' AS _merge
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def merge_inner(t: Tables):
    return reconcile.merge(
        t.customer.select("c_custkey", "c_name", "c_nationkey"),
        t.nation.select("n_nationkey", "n_name"),
        "c_nationkey",
        "n_nationkey",
    )


@query("""
    SELECT o_orderkey, o_custkey, c_custkey, c_name,
           CASE WHEN c_custkey IS NULL THEN 'left_only' ELSE 'both' END AS _merge
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def merge_left(t: Tables):
    return reconcile.merge(
        t.orders.select("o_orderkey", "o_custkey"),
        t.customer.filter("c_acctbal > 0").select("c_custkey", "c_name"),
        "o_custkey",
        "c_custkey",
        how="left",
        validate="m:1",
    )


@query("""
    SELECT c_custkey, c_name, o_orderkey, o_custkey,
           CASE WHEN c_custkey IS NULL THEN 'right_only' ELSE 'both' END AS _merge
    FROM (SELECT * FROM customer WHERE c_acctbal > 0) RIGHT JOIN orders ON o_custkey = c_custkey""")
def merge_right(t: Tables):
    return reconcile.merge(
        t.customer.filter("c_acctbal > 0").select("c_custkey", "c_name"),
        t.orders.select("o_orderkey", "o_custkey"),
        "c_custkey",
        "o_custkey",
        how="right",
    )


@query("""
    WITH l AS (SELECT o_custkey AS custkey, o_totalprice AS amount, o_orderkey FROM orders
               WHERE o_orderstatus = 'F'),
         r AS (SELECT c_custkey AS custkey, c_acctbal AS amount, c_mktsegment FROM customer
               WHERE c_acctbal > 0)
    SELECT coalesce(l.custkey, r.custkey) AS custkey, l.amount AS amount_left, o_orderkey,
           r.amount AS amount_right, c_mktsegment
    FROM l FULL JOIN r ON l.custkey = r.custkey""")
def merge_same_key(t: Tables):
    left = t.orders.filter("o_orderstatus = 'F'").selectExpr(
        "o_custkey AS custkey", "o_totalprice AS amount", "o_orderkey"
    )
    right = t.customer.filter("c_acctbal > 0").selectExpr(
        "c_custkey AS custkey", "c_acctbal AS amount", "c_mktsegment"
    )
    return reconcile.merge(left, right, "custkey", "custkey", how="outer", indicator=False)


@query("""
    SELECT o_orderkey, c_name
    FROM orders JOIN customer ON CAST(o_custkey AS varchar) = CAST(c_custkey AS varchar)""")
def merge_cast_keys(t: Tables):
    orders, customers = scalars.align_key_types(
        t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey")),
        t.customer.select("c_custkey", "c_name"),
        ["o_custkey"],
        ["c_custkey"],
    )
    merged = reconcile.merge(orders, customers, "o_custkey", "c_custkey", indicator=False)
    return merged.select("o_orderkey", "c_name")


@query("""
    SELECT l_orderkey, CAST(count(*) AS bigint) AS n_rows FROM lineitem
    GROUP BY l_orderkey HAVING count(*) > 1""")
def merge_cardinality(t: Tables):
    return reconcile.repeated_keys(t.lineitem, "l_orderkey")


@query("""
    SELECT l_partkey, l_suppkey, CAST(count(*) AS bigint) AS n_rows
    FROM lineitem GROUP BY l_partkey, l_suppkey""")
def key_counts(t: Tables):
    return reconcile.key_counts(t.lineitem, ["l_partkey", "l_suppkey"])


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n
      FROM orders) WHERE n = 1""")
def first_per_key(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return reconcile.first_per_key(rows, "o_custkey", ["o_orderdate", "o_orderkey"])


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
      FROM orders) WHERE n = 1""")
def last_per_key(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return reconcile.last_per_key(rows, "o_custkey", ["o_orderdate", "o_orderkey"])


@query("""
    SELECT o_orderkey, o_orderstatus, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def attach_parent_key(t: Tables):
    parts = [
        t.orders.filter(F.col("o_orderstatus") == status).select(
            F.col("o_custkey").alias("id"), "o_orderkey", "o_orderstatus"
        )
        for status in ("F", "O", "P")
    ]
    parents = t.customer.select(F.col("c_custkey").alias("id"), "c_name")
    return prepare.children_with_parent(parents, parts, "c_name")


@query("""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def lookup_1hop(t: Tables):
    return reconcile.filter_by_lookup(
        t.orders.select("o_orderkey", "o_custkey"),
        [("o_custkey", t.customer, "c_custkey")],
        F.col("c_mktsegment") == "MACHINERY",
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    WHERE l_orderkey IN (
      SELECT o_orderkey FROM orders WHERE o_custkey IN (
        SELECT c_custkey FROM customer WHERE c_nationkey IN (
          SELECT n_nationkey FROM nation WHERE n_name = (SELECT max(n_name) FROM nation))))""")
def lookup_3hop(t: Tables):
    top = t.nation.agg(F.max("n_name")).scalar()
    return reconcile.filter_by_lookup(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
        [
            ("l_orderkey", t.orders, "o_orderkey"),
            ("o_custkey", t.customer, "c_custkey"),
            ("c_nationkey", t.nation, "n_nationkey"),
        ],
        F.col("n_name") == top,
    )


@query("""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def semi_key_list(t: Tables):
    keys = t.customer.filter("c_acctbal < 0")
    return reconcile.with_keys(t.orders.select("o_orderkey", "o_custkey"), keys, "o_custkey", "c_custkey")


@query("""
    SELECT p_partkey, p_name FROM part
    WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem
                            WHERE l_returnflag = 'R' AND l_quantity >= 48)""")
def anti_key_list(t: Tables):
    keys = t.lineitem.filter("l_returnflag = 'R' AND l_quantity >= 48")
    return reconcile.without_keys(t.part.select("p_partkey", "p_name"), keys, "p_partkey", "l_partkey")


@query("""
    WITH c AS (SELECT o_orderkey, c_name, c_mktsegment, row_number() OVER (ORDER BY o_orderkey) AS id
               FROM orders JOIN customer ON o_custkey = c_custkey),
         g AS (SELECT 'G-' || p_partkey AS line, p_brand, nullif(p_type, 'ECONOMY') AS p_type,
                      row_number() OVER (ORDER BY p_partkey) AS id FROM part),
         i AS (SELECT 'I-' || event_id AS line, event_type,
                      row_number() OVER (ORDER BY event_id) AS id FROM events),
         s AS (SELECT 'S-' || doc_id AS line, row_number() OVER (ORDER BY doc_id) AS id FROM documents)
    SELECT line AS contract_line_number, CAST(o_orderkey AS varchar) AS contract_number,
           p_brand || '-' || coalesce(p_type, '') AS product, CAST(1 AS int) AS quantity
    FROM g JOIN c USING (id)
    UNION ALL
    SELECT line, CAST(o_orderkey AS varchar), 'install - ' || event_type, 1 FROM i JOIN c USING (id)
    UNION ALL
    SELECT line, CAST(o_orderkey AS varchar), 'sla - ' || c_mktsegment, 1 FROM s JOIN c USING (id)""")
def contract_lines(t: Tables):
    accounts = t.customer.selectExpr("c_name AS account_number_external_id", "c_mktsegment AS sla")
    contracts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "c_name AS account_number_external_id",
        "CAST(o_orderkey AS string) AS contract_number",
        "o_orderkey",
    )
    generators = t.part.selectExpr(
        "'G-' || p_partkey AS contract_line_number",
        "p_brand AS gen_type",
        "nullif(p_type, 'ECONOMY') AS gen_type_capacity",
        "p_partkey AS id",
    )
    installations = t.events.selectExpr(
        "'I-' || event_id AS contract_line_number", "event_type AS installation", "event_id AS id"
    )
    levels = t.documents.selectExpr("'S-' || doc_id AS contract_line_number", "doc_id AS id")
    return prepare.contract_lines(
        accounts,
        contracts,
        generators,
        installations,
        levels,
        contract_order="o_orderkey",
        line_order="id",
    )


@query("""
    SELECT c_custkey, 'Prospect' AS "Type", 'Government' AS "Industry"
    FROM customer JOIN part ON c_custkey = p_partkey""")
def update_matched(t: Tables):
    return matched_updates(
        t.customer,
        t.part,
        ["c_custkey"],
        ["p_partkey"],
        "c_custkey",
        {"Type": "Prospect", "Industry": "Government"},
    )
