"""Queries on updates, upserts, deletes, checks and batches."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.operators import dml, ledger, outcomes, quality, submit
from drover.operators.reconcile import with_keys
from drover.registry.base import Query, Tables, registrar
from drover.session import shared_path, stage
from drover.sinks import bucketed
from drover.sinks.ranged import RangedTable

QUERIES: dict[str, Query] = {}
query = registrar(QUERIES)

LAST_ORDER_SQL = """
    WITH last AS (SELECT o_custkey, {price} AS price, o_orderpriority FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
      FROM orders WHERE o_orderpriority = '1-URGENT') WHERE n = 1)
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN o_custkey IS NOT NULL THEN price ELSE c_acctbal END AS c_acctbal,
           coalesce(o_orderpriority, c_mktsegment) AS c_mktsegment
    FROM customer LEFT JOIN last ON c_custkey = o_custkey"""


def _urgent_changes(t: Tables, price: str) -> DataFrame:
    return t.orders.filter("o_orderpriority = '1-URGENT'").selectExpr(
        "o_custkey AS c_custkey",
        f"{price} AS c_acctbal",
        "o_orderpriority AS c_mktsegment",
        "o_orderdate",
        "o_orderkey",
    )


@query(LAST_ORDER_SQL.format(price="o_totalprice"))
def keyed_update(t: Tables):
    return dml.keyed_update(
        t.customer,
        _urgent_changes(t, "o_totalprice"),
        "c_custkey",
        ["c_acctbal", "c_mktsegment"],
        order_by=["o_orderdate", "o_orderkey"],
    )


@query(LAST_ORDER_SQL.format(price="CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END"))
def keyed_update_null(t: Tables):
    return dml.keyed_update(
        t.customer,
        _urgent_changes(t, "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END"),
        "c_custkey",
        ["c_acctbal", "c_mktsegment"],
        order_by=["o_orderdate", "o_orderkey"],
    )


@query("""
    WITH e AS (SELECT event_id, nullif(user_id, 1) AS user_id, event_type, value,
                      row_number() OVER (PARTITION BY nullif(user_id, 1) ORDER BY event_id) AS n
               FROM events),
         c AS (SELECT nullif(c_custkey, 1) AS k, c_acctbal, c_mktsegment FROM customer)
    SELECT event_id, user_id, event_type,
           CASE WHEN hit THEN c_acctbal ELSE value END AS value,
           CASE WHEN hit THEN c_mktsegment END AS segment
    FROM (SELECT e.*, c.*, c_mktsegment IS NOT NULL AS hit
          FROM e LEFT JOIN c ON n = 1 AND user_id IS NOT DISTINCT FROM k)""")
def doc_update_first(t: Tables):
    documents = t.events.selectExpr(
        "event_id", "nullif(user_id, 1) AS user_id", "event_type", "value"
    )
    changes = t.customer.selectExpr(
        "nullif(c_custkey, 1) AS user_id", "c_acctbal AS value", "c_mktsegment AS segment"
    )
    return dml.update_first_document(documents, changes, "user_id", "event_id")


@query("""
    SELECT o_orderkey, o_custkey FROM (
      SELECT o_orderkey, nullif(o_custkey, 3) AS o_custkey FROM orders)
    WHERE o_custkey IS NULL
       OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def delete_keys(t: Tables):
    return dml.delete_keys(
        t.orders.selectExpr("o_orderkey", "nullif(o_custkey, 3) AS o_custkey"),
        t.customer.filter("c_acctbal < 0"),
        "o_custkey",
        "c_custkey",
    )


@query("SELECT event_id, event_type FROM events WHERE event_type <> 'view'")
def doc_delete_where(t: Tables):
    return dml.delete_where(t.events.select("event_id", "event_type"), "event_type", "view")


@query("""
    WITH k AS (SELECT DISTINCT nullif(s_nationkey, 3) AS k FROM supplier WHERE s_acctbal > 9800)
    SELECT c_custkey, nation FROM (SELECT c_custkey, nullif(c_nationkey, 3) AS nation FROM customer)
    WHERE NOT EXISTS (SELECT 1 FROM k WHERE k IS NOT DISTINCT FROM nation)""")
def doc_delete_many(t: Tables):
    return dml.delete_documents(
        t.customer.selectExpr("c_custkey", "nullif(c_nationkey, 3) AS nation"),
        t.supplier.filter("s_acctbal > 9800").selectExpr("nullif(s_nationkey, 3) AS nation"),
        "nation",
    )


@query("""
    WITH k AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
         e AS (SELECT event_id, user_id,
                      row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place
               FROM events)
    SELECT event_id, user_id FROM e LEFT JOIN k ON user_id = o_custkey
    WHERE n IS NULL OR place > n""")
def doc_delete_n(t: Tables):
    return dml.delete_one_each(
        t.events.select("event_id", "user_id"), t.orders, "user_id", "event_id", "o_custkey"
    )


@query("""
    SELECT coalesce(c_custkey, p_partkey) AS c_custkey, coalesce(p_name, c_name) AS c_name,
           c_nationkey, c_acctbal, coalesce(p_brand, c_mktsegment) AS c_mktsegment,
           CASE WHEN p_partkey IS NOT NULL THEN c_custkey IS NULL END AS "RESULTS_created"
    FROM customer FULL JOIN part ON c_custkey = p_partkey""")
def upsert_external_id(t: Tables):
    incoming = t.part.selectExpr("p_partkey AS c_custkey", "p_name AS c_name", "p_brand AS c_mktsegment")
    return dml.upsert(t.customer, incoming, "c_custkey")


@query("""
    WITH u AS (
      SELECT c_custkey, c_name, coalesce(s_acctbal, c_acctbal) AS c_acctbal
      FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey),
    d AS (SELECT * FROM u WHERE c_custkey NOT IN (SELECT n_nationkey FROM nation))
    SELECT coalesce(c_custkey, p_partkey) AS c_custkey, coalesce(p_name, c_name) AS c_name, c_acctbal
    FROM d FULL JOIN part ON c_custkey = p_partkey""")
def publish_touched(t: Tables):
    """Balances of the suppliers, deletion of the nations' keys and an upsert of all parts, each a commit."""
    table = RangedTable(t.spark, f"customer_{uuid.uuid4().hex}")
    table.create(t.customer.select("c_custkey", "c_name", "c_acctbal"), "c_custkey", rows_per_range=100)
    balances = t.supplier.selectExpr("CAST(s_suppkey AS bigint) AS c_custkey", "s_acctbal AS c_acctbal")
    table.update(balances, ["c_acctbal"])
    table.delete(t.nation, "n_nationkey")
    table.upsert(t.part.selectExpr("p_partkey AS c_custkey", "p_name AS c_name"))
    return table.read()


@query("""
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def append_rows(t: Tables):
    target = t.customer.selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    rows = t.supplier.selectExpr("s_acctbal AS balance", "s_suppkey AS id", "s_name AS name")
    return dml.append_rows(target, rows)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1
                THEN 'duplicate_key' ELSE '' END
           || CASE WHEN EXISTS (SELECT 1 FROM orders
                                WHERE o_orderkey = l_orderkey AND o_custkey = l_linenumber)
                   THEN ';key_exists' ELSE '' END AS reasons
    FROM lineitem""")
def insert_pk_check(t: Tables):
    tagged = quality.tag_rejects(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
        [],
        ["l_orderkey", "l_linenumber"],
        t.orders.selectExpr("o_orderkey AS l_orderkey", "CAST(o_custkey AS int) AS l_linenumber"),
    )
    repeats = F.array_contains(quality.REASONS, "duplicate_key")
    exists = F.array_contains(quality.REASONS, "key_exists")
    text = F.concat(
        F.when(repeats, "duplicate_key").otherwise(""), F.when(exists, ";key_exists").otherwise("")
    )
    return tagged.select(F.expr("* EXCEPT (reject_reasons)"), text.alias("reasons"))


@contextmanager
def _bucketed(t: Tables, **tables: tuple[DataFrame, list[str]]):
    """Names of bucketed tables, which are dropped in the end; buckets grow in number with the rows, not in size."""
    made = {name: f"{name}_{uuid.uuid4().hex}" for name in tables}
    buckets = bucketed.buckets_for(*[df for df, _ in tables.values()], least=8)
    try:
        for name, (df, key) in tables.items():
            bucketed.write_bucketed(df, made[name], key, buckets)
        yield made
    finally:
        for name in made.values():
            t.spark.sql(f"DROP TABLE IF EXISTS {name}")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT event_id FROM events)")
def net_new_bucketed(t: Tables):
    """Orders whose number is no event's, bucket by bucket."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    events = t.events.select(F.col("event_id").cast(orders.schema["o_orderkey"].dataType).alias("event_id"))
    with _bucketed(t, staging=(orders, ["o_orderkey"]), target=(events, ["event_id"])) as made:
        return stage(bucketed.net_new_rows(t.spark, made["staging"], made["target"]), "net-new")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(';',
             CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'duplicate_key' END,
             CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_custkey = l_linenumber)
                  THEN 'key_exists' END) AS reasons
    FROM lineitem""")
def pk_check_bucketed(t: Tables):
    """Repeated and known keys of all lines, counted and looked up in their buckets."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    kinds = {f.name: f.dataType for f in lines.schema.fields}
    target = t.orders.select(
        F.col("o_orderkey").cast(kinds["l_orderkey"]), F.col("o_custkey").cast(kinds["l_linenumber"])
    )
    keys = {"staging": (lines, ["l_orderkey", "l_linenumber"]), "target": (target, ["o_orderkey", "o_custkey"])}
    with _bucketed(t, **keys) as made:
        found = bucketed.check_keys(t.spark, made["staging"], made["target"])
        return stage(
            found.select(*lines.columns, F.array_join("reject_reasons", ";").alias("reasons")), "checked"
        )


@query("""
    SELECT p_partkey, concat_ws(';',
             CASE WHEN nullif(p_type, 'ECONOMY') IS NULL THEN 'null:p_type' END,
             CASE WHEN length(p_name) > 9 THEN 'length:p_name' END,
             CASE WHEN round(p_retailprice, 0) >= 1000 THEN 'range:p_retailprice' END) AS reasons
    FROM part
    WHERE nullif(p_type, 'ECONOMY') IS NULL OR length(p_name) > 9
       OR round(p_retailprice, 0) >= 1000""")
def constraint_rejects(t: Tables):
    rules = quality.row_reasons(["p_type"], {"p_name": 9}, {"p_retailprice": "decimal(3,0)"})
    rows = t.part.selectExpr("p_partkey", "p_name", "nullif(p_type, 'ECONOMY') AS p_type", "p_retailprice")
    rejected = quality.tag_rejects(rows, rules).filter(F.size(quality.REASONS) > 0)
    return rejected.select("p_partkey", F.array_join(quality.REASONS, ";").alias("reasons"))


BATCHES_SQL = """
    WITH b AS (SELECT *, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS bigint) AS batch_id
               FROM orders)"""


@query(BATCHES_SQL + " SELECT o_orderkey, batch_id FROM b")
def assign_batches(t: Tables):
    return submit.assign_batches(t.orders.select("o_orderkey"), "o_orderkey")


@query(BATCHES_SQL + """,
    n AS (SELECT batch_id, count(*) FILTER (WHERE o_orderstatus <> 'F') AS passed,
                 count(*) FILTER (WHERE o_orderstatus = 'F') AS failed FROM b GROUP BY batch_id)
    SELECT batch_id, CAST(passed AS bigint) AS passed, CAST(failed AS bigint) AS failed,
           CAST(sum(passed) OVER (ORDER BY batch_id) AS bigint) AS passed_so_far,
           CAST(sum(failed) OVER (ORDER BY batch_id) AS bigint) AS failed_so_far
    FROM n""")
def batch_totals(t: Tables):
    flagged = t.orders.select("o_orderkey", (F.col("o_orderstatus") != "F").alias("RESULTS_success"))
    return submit.batch_totals(submit.assign_batches(flagged, "o_orderkey"))


def _inserted(t: Tables) -> DataFrame:
    """Stored outcomes of inserting the orders, a third of them twice, where urgent ones are known."""
    target = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderstatus")
    rows = t.orders.selectExpr(
        "CASE WHEN o_orderkey % 50 <> 1 THEN o_orderkey END AS o_orderkey", "o_orderstatus"
    )
    rows = rows.unionByName(rows.filter("o_orderkey % 3 = 0"))
    return outcomes.perform("insert", target, rows, "o_orderkey").results


def _order_service() -> submit.Submitter:
    """Takes open orders, refuses closed ones, and says nothing of the last ten rows of a full batch."""

    def answer(batch: pa.Table) -> pa.Table:
        told = batch.slice(0, 990 if batch.num_rows == 1000 else batch.num_rows)
        open_ = pc.not_equal(told.column("o_orderstatus"), "F")
        key = pc.cast(told.column("o_orderkey"), pa.string())
        return pa.table(
            {
                "success": open_,
                "id": pc.if_else(open_, key, None),
                "created": open_,
                "errors": pc.if_else(open_, None, "CLOSED"),
            }
        )

    return answer


@query(BATCHES_SQL + """,
    r AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY o_orderkey) > 990
                    AND count(*) OVER (PARTITION BY batch_id) = 1000 AS untold FROM b)
    SELECT o_orderkey, o_orderstatus, batch_id,
           CASE WHEN NOT untold THEN o_orderstatus <> 'F' END AS "RESULTS_success",
           CASE WHEN NOT untold AND o_orderstatus <> 'F' THEN CAST(o_orderkey AS varchar) END AS "RESULTS_id",
           CASE WHEN NOT untold THEN o_orderstatus <> 'F' END AS "RESULTS_created",
           CASE WHEN NOT untold AND o_orderstatus = 'F' THEN 'CLOSED' END AS "RESULTS_errors",
           CAST(CASE WHEN batch_id = 0 THEN 1 ELSE 2 END AS integer) AS "RESULTS_attempt"
    FROM r""")
def submit_resumed(t: Tables):
    """All orders in batches, stopped after the first batch and resumed; a third start has nothing to send."""
    output = shared_path(t.spark, "submitted")
    orders = t.orders.select("o_orderkey", "o_orderstatus")

    def start(stop_after=None):
        return ledger.run_resumable(
            orders, _order_service(), "insert", "o_orderkey", output, "nightly", stop_after=stop_after
        )

    start(stop_after=1)
    start()
    return start().results


@query(BATCHES_SQL + """,
    n AS (SELECT batch_id, count(*) AS total, count(*) FILTER (WHERE o_orderstatus <> 'F') AS open_,
                 row_number() OVER (ORDER BY batch_id) AS k FROM b GROUP BY batch_id),
    told AS (SELECT batch_id, count(*) FILTER (WHERE o_orderstatus <> 'F') AS passed,
                    count(*) FILTER (WHERE o_orderstatus = 'F') AS failed
             FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY o_orderkey) AS place FROM b)
             JOIN n USING (batch_id) WHERE batch_id = 0 AND (total < 1000 OR place <= 990) GROUP BY batch_id)
    SELECT batch_id, total AS rows, CASE WHEN passed IS NULL THEN 'waiting' ELSE 'done' END AS state,
           CAST(CASE WHEN passed IS NOT NULL THEN 1 END AS integer) AS attempt,
           coalesce(passed, 0) AS passed, coalesce(failed, 0) AS failed,
           CASE WHEN passed IS NULL THEN 0 ELSE total - passed - failed END AS unknown,
           CASE WHEN passed IS NULL THEN total ELSE 0 END AS unsent
    FROM n LEFT JOIN told USING (batch_id)""")
def submit_account(t: Tables):
    """What became of each batch of a run that was stopped after the first one."""
    output = shared_path(t.spark, "submitted")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    ledger.run_resumable(orders, _order_service(), "insert", "o_orderkey", output, "daily", stop_after=1)
    return ledger.account(t.spark, output, "insert", "daily")


RESULTS_SQL = """
    WITH i AS (SELECT CASE WHEN o_orderkey % 50 <> 1 THEN o_orderkey END AS o_orderkey, o_orderstatus FROM orders),
    s AS (SELECT * FROM i UNION ALL SELECT * FROM i WHERE o_orderkey % 3 = 0),
    e AS (SELECT s.*, concat_ws(';',
            CASE WHEN o_orderkey % 3 = 0 THEN 'duplicate_key' END,
            CASE WHEN o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
                 THEN 'key_exists' END,
            CASE WHEN o_orderkey IS NULL THEN 'null:o_orderkey' END) AS errors FROM s),
    r AS (SELECT o_orderkey, o_orderstatus, errors = '' AS "RESULTS_success",
                 CASE WHEN errors = '' THEN CAST(o_orderkey AS varchar) END AS "RESULTS_id",
                 errors = '' AS "RESULTS_created", nullif(errors, '') AS "RESULTS_errors" FROM e)
    SELECT * FROM r"""


@query(RESULTS_SQL)
def dml_insert_outcomes(t: Tables):
    return _inserted(t)


@query(RESULTS_SQL)
def submit_results(t: Tables):
    return _inserted(t)


@query(RESULTS_SQL + """ WHERE "RESULTS_success" """)
def split_success(t: Tables):
    return submit.split_results(_inserted(t)).success


@query(RESULTS_SQL + """ WHERE NOT "RESULTS_success" """)
def split_fallout(t: Tables):
    return submit.split_results(_inserted(t)).fallout


def _changed(created: str, known: str) -> str:
    return f"""
    SELECT p_partkey AS c_custkey, p_brand AS c_mktsegment, {known} AS "RESULTS_success",
           CASE WHEN {known} THEN CAST(p_partkey AS varchar) END AS "RESULTS_id",
           {created} AS "RESULTS_created",
           CASE WHEN NOT {known} THEN 'unknown_key' END AS "RESULTS_errors"
    FROM part LEFT JOIN customer ON p_partkey = c_custkey"""


def _part_changes(t: Tables, operation: str) -> DataFrame:
    rows = t.part.selectExpr("p_partkey AS c_custkey", "p_brand AS c_mktsegment")
    target = t.customer.select("c_custkey", "c_mktsegment")
    return outcomes.perform(operation, target, rows, "c_custkey").results


@query(_changed("FALSE", "(c_custkey IS NOT NULL)"))
def dml_update_outcomes(t: Tables):
    return _part_changes(t, "update")


@query(_changed("FALSE", "(c_custkey IS NOT NULL)"))
def dml_delete_outcomes(t: Tables):
    return _part_changes(t, "delete")


@query(_changed("c_custkey IS NULL", "TRUE"))
def dml_upsert_outcomes(t: Tables):
    return _part_changes(t, "upsert")


@query("""
    WITH c AS (SELECT c_custkey FROM customer WHERE c_nationkey = 7),
         o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c))
    SELECT 'customer' AS kept_in, c_custkey AS id, c_acctbal AS amount FROM customer
    WHERE c_nationkey <> 7
    UNION ALL
    SELECT 'orders', o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)
    UNION ALL
    SELECT 'lineitem', l_orderkey, l_extendedprice FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o)""")
def purge_cascade(t: Tables):
    customers = t.customer.filter("c_nationkey = 7")
    orders = with_keys(t.orders, customers, "o_custkey", "c_custkey", unique=True)
    kept = {
        ("customer", "c_custkey", "c_acctbal"): dml.delete_keys(t.customer, customers, "c_custkey"),
        ("orders", "o_orderkey", "o_totalprice"): dml.delete_keys(t.orders, orders, "o_orderkey"),
        ("lineitem", "l_orderkey", "l_extendedprice"): dml.delete_keys(
            t.lineitem, orders, "l_orderkey", "o_orderkey"
        ),
    }
    parts = [
        df.select(F.lit(name).alias("kept_in"), F.col(key).alias("id"), F.col(amount).alias("amount"))
        for (name, key, amount), df in kept.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
