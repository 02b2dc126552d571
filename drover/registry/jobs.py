"""Whole jobs: preparation, load, staging, net-new insert, purge, files, tables and streams."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.functions import scalars
from drover.operators import dml, outcomes, reshape, submit
from drover.operators.ordering import with_row_index
from drover.plans import change, load, prepare
from drover.registry.base import Query, Tables, registrar
from drover.schemas import SOURCE_TABLES, STAGING_TABLES, TableSpec
from drover.session import shared_path, stage
from drover.sinks import files as sinks
from drover.sinks import tables
from drover.sources import files as sources
from drover.sources import paged
from drover.streaming.landing import net_new_stream

QUERIES: dict[str, Query] = {}
query = registrar(QUERIES)


@query("""
    SELECT c_custkey AS "Account_Number_External_ID__c", c_name AS "Name",
           c_mktsegment AS "Industry", CAST(trunc(c_acctbal) AS bigint) AS "AnnualRevenue",
           CAST(c_nationkey AS bigint) AS "NumberofLocations__c", TRUE AS "Migrated_Record__c"
    FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def net_new_insert(t: Tables):
    return change.new_records(
        t.customer,
        t.orders.filter("o_orderpriority = '1-URGENT'"),
        "c_custkey",
        "o_custkey",
        {
            "c_custkey": "Account_Number_External_ID__c",
            "c_name": "Name",
            "c_mktsegment": "Industry",
            "c_acctbal": "AnnualRevenue",
            "c_nationkey": "NumberofLocations__c",
        },
        ["c_acctbal", "c_nationkey"],
    )


def _accounts(t: Tables) -> DataFrame:
    """Customers in the layout of the accounts table, some with gaps."""
    return t.customer.selectExpr(
        "c_custkey AS id",
        "nullif(c_mktsegment, 'BUILDING') AS industry",
        "c_name AS company_name",
        "CAST(c_acctbal AS decimal(16,2)) AS annual_revenue",
        "c_name AS account_number_external_id",
        "c_nationkey AS number_of_locations",
        "CASE WHEN c_nationkey <> 5 THEN c_nationkey END AS number_of_employees",
        "lower(c_mktsegment) AS sla",
        "CAST(c_custkey AS int) AS sla_serial_number",
        "lpad(CAST(c_custkey AS string), 12, '0') AS phone",
    )


@query("""
    SELECT lpad(CAST(c_custkey AS varchar), 12, '0') AS phone, c_name AS company_name,
           coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS industry,
           CAST(c_acctbal AS decimal(16,2)) AS annual_revenue,
           c_name AS account_number_external_id, c_nationkey AS number_of_locations,
           c_nationkey AS number_of_employees, lower(c_mktsegment) AS sla,
           CAST(c_custkey AS int) AS sla_serial_number
    FROM customer WHERE c_nationkey <> 5""")
def load_and_stage(t: Tables):
    # Accounts without a head count are legal in the source but not in staging.
    return _loaded_and_staged(t, _accounts(t), "accounts")


def _loaded_and_staged(t: Tables, prepared: DataFrame, entity: str) -> DataFrame:
    """The staging table after a load and a copy; the tables are dropped again."""
    tag = uuid.uuid4().hex
    source = tables.create_table(t.spark, SOURCE_TABLES[entity], f"{entity}_{tag}")
    staged = tables.create_table(t.spark, STAGING_TABLES[entity], f"stg_{entity}_{tag}")
    try:
        load.load_source(prepared, entity, source, mode="quarantine")
        load.source_to_staging(t.spark, entity, source, staged, mode="quarantine")
        return stage(t.spark.table(staged), "staged")
    finally:
        for name in (source, staged):
            tables.drop_table(t.spark, name)


@query("""
    SELECT c_name AS account_number_external_id, 'F' || o_orderkey AS first_name,
           'L' || o_orderkey % 7 AS last_name, o_orderpriority AS email, o_orderstatus AS title,
           coalesce(nullif(o_orderpriority, '5-LOW'), '') AS department, 'é' AS languages
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def load_and_stage_contacts(t: Tables):
    """Contacts with the key of their account; their own key has two columns."""
    contacts = t.orders.selectExpr(
        "o_custkey AS id", "concat('F', o_orderkey) AS first_name",
        "concat('L', o_orderkey % 7) AS last_name", "o_orderpriority AS email",
        "o_orderstatus AS title", "nullif(o_orderpriority, '5-LOW') AS department", "'é' AS languages",
    )
    accounts = t.customer.selectExpr("c_custkey AS id", "c_name AS account_number_external_id")
    return _loaded_and_staged(t, prepare.contacts_with_accounts(accounts, [contacts]), "contacts")


def _contracts(t: Tables) -> DataFrame:
    parts = t.orders.selectExpr(
        "o_custkey AS id", "concat('K', o_orderkey) AS contract_number",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS start_date",
    )
    accounts = t.customer.selectExpr("c_custkey AS id", "c_name AS account_number_external_id")
    return prepare.contracts_with_accounts(accounts, [parts])


@query("""
    SELECT c_name AS account_number_external_id, 'K' || o_orderkey AS contract_number,
           CAST(o_orderdate AS date) AS start_date,
           CAST(CAST(o_orderdate AS date) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS date) AS end_date
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def load_and_stage_contracts(t: Tables):
    return _loaded_and_staged(t, _contracts(t), "contracts")


@query("""
    WITH k AS (SELECT 'K' || o_orderkey AS contract_number, lower(c_mktsegment) AS sla,
                      row_number() OVER (ORDER BY 'K' || o_orderkey) AS n
               FROM orders JOIN customer ON o_custkey = c_custkey),
         g AS (SELECT 'G' || p_partkey AS contract_line_number, p_brand || '-' || p_type AS product,
                      row_number() OVER (ORDER BY 'G' || p_partkey) AS n FROM part),
         i AS (SELECT 'I' || s_suppkey AS contract_line_number, 'install - ' || s_name AS product,
                      row_number() OVER (ORDER BY 'I' || s_suppkey) AS n FROM supplier),
         l AS (SELECT 'S' || c_custkey AS contract_line_number,
                      row_number() OVER (ORDER BY 'S' || c_custkey) AS n FROM customer),
         a AS (SELECT contract_line_number, contract_number, product FROM g JOIN k USING (n)
               UNION ALL SELECT contract_line_number, contract_number, product FROM i JOIN k USING (n)
               UNION ALL SELECT contract_line_number, contract_number, 'sla - ' || sla FROM l JOIN k USING (n))
    SELECT *, 1 AS quantity FROM a WHERE length(product) <= 50""")
def load_and_stage_contract_lines(t: Tables):
    """Generator, installation and service level lines of the contracts, in the order of their numbers."""
    accounts = t.customer.selectExpr("c_name AS account_number_external_id", "lower(c_mktsegment) AS sla")
    generators = t.part.selectExpr(
        "concat('G', p_partkey) AS contract_line_number", "p_brand AS gen_type", "p_type AS gen_type_capacity"
    )
    installations = t.supplier.selectExpr(
        "concat('I', s_suppkey) AS contract_line_number", "s_name AS installation"
    )
    levels = t.customer.selectExpr("concat('S', c_custkey) AS contract_line_number")
    lines = prepare.contract_lines(
        accounts, stage(_contracts(t), "contracts"), generators, installations, levels
    )
    return _loaded_and_staged(t, lines, "contract_lines")


@query("""
    SELECT c_name AS account_number_external_id, 'null:number_of_employees' AS reasons
    FROM customer WHERE c_nationkey = 5""")
def stage_rejects(t: Tables):
    tag = uuid.uuid4().hex
    staged = tables.create_table(t.spark, STAGING_TABLES["accounts"], f"stg_accounts_{tag}")
    rows = load.staged_rows(load.source_rows(_accounts(t)), "accounts")
    rejected = tables.insert(rows, STAGING_TABLES["accounts"], staged, mode="quarantine")
    tables.drop_table(t.spark, staged)  # the rejected rows are stored by themselves
    return rejected.select(
        "account_number_external_id", F.array_join("reject_reasons", ";").alias("reasons")
    )


@query("""
    SELECT CAST(count(CASE WHEN c_nationkey <> 5 THEN 1 END) AS bigint) AS n_inserted,
           CAST(count(CASE WHEN c_nationkey = 5 THEN 1 END) AS bigint) AS n_rejected FROM customer""")
def insert_counts(t: Tables):
    tag = uuid.uuid4().hex
    staged = tables.create_table(t.spark, STAGING_TABLES["accounts"], f"stg_accounts_{tag}")
    try:
        rows = load.staged_rows(load.source_rows(_accounts(t)), "accounts")
        found = tables.insert_counted(rows, STAGING_TABLES["accounts"], staged, mode="quarantine")
    finally:
        tables.drop_table(t.spark, staged)
    return t.spark.range(1).select(
        F.lit(found.n_inserted).cast("long").alias("n_inserted"),
        F.lit(found.n_rejected).cast("long").alias("n_rejected"),
    )


@query("""
    WITH rows AS (
        SELECT c_custkey, c_custkey % 4 = 0 OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS known
        FROM customer)
    SELECT CAST(count(*) AS bigint) AS passed, CAST(0 AS bigint) AS failed,
           CAST(count(CASE WHEN NOT known THEN 1 END) AS bigint) AS created, 'upsert' AS operation FROM rows
    UNION ALL SELECT count(CASE WHEN known THEN 1 END), count(CASE WHEN NOT known THEN 1 END), 0, 'update' FROM rows
    UNION ALL SELECT count(CASE WHEN NOT known THEN 1 END), count(CASE WHEN known THEN 1 END),
                     count(CASE WHEN NOT known THEN 1 END), 'insert' FROM rows""")
def dml_totals(t: Tables):
    target = (
        t.customer.filter("c_custkey % 4 = 0")
        .select("c_custkey")
        .union(t.orders.selectExpr("o_custkey AS c_custkey"))
        .distinct()
        .withColumn("c_name", F.lit("known"))
    )
    rows = t.customer.select("c_custkey", "c_name")
    found = []
    for operation in ("upsert", "update", "insert"):
        totals = outcomes.perform(operation, target, rows, "c_custkey").totals
        counts = [F.lit(n).cast("long").alias(name) for name, n in totals.items()]
        found.append(t.spark.range(1).select(*counts, F.lit(operation).alias("operation")))
    return reshape.union_all(found)


@query("""
    SELECT o_orderkey, c_name AS account_number_external_id, CAST(o_orderdate AS date) AS start_date,
           CAST(CAST(o_orderdate AS date) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS date) AS end_date
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def contracts_prepared(t: Tables):
    parts = [
        t.orders.filter(F.col("o_orderstatus") == status).selectExpr(
            "o_custkey AS id", "o_orderkey", "date_format(o_orderdate, 'yyyy-MM-dd') AS start_date"
        )
        for status in ("F", "O", "P")
    ]
    accounts = t.customer.selectExpr("c_custkey AS id", "c_name AS account_number_external_id")
    return prepare.contracts_with_accounts(accounts, parts)


@query("""
    WITH f AS (SELECT c_custkey, c_mktsegment = 'MACHINERY' AS flag FROM customer),
         o AS (SELECT o_orderkey, o_custkey FROM orders),
         l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)
    SELECT 'accounts' AS object, CAST(c_custkey AS varchar) AS "Id" FROM f WHERE flag
    UNION ALL
    SELECT 'contacts', CAST(o_orderkey AS varchar) FROM o JOIN f ON o_custkey = c_custkey WHERE flag
    UNION ALL
    SELECT 'orders', l_orderkey || '-' || l_linenumber || '-' || l_partkey
    FROM l JOIN o ON l_orderkey = o_orderkey JOIN f ON o_custkey = c_custkey WHERE flag""")
def purge_selection(t: Tables):
    """Accounts by their own flag, orders by their account's, lines over two hops."""
    flagged = t.customer.selectExpr(
        "CAST(c_custkey AS string) AS Id", "c_mktsegment = 'MACHINERY' AS Migrated_Record__c"
    )
    orders = t.orders.selectExpr("CAST(o_orderkey AS string) AS Id", "CAST(o_custkey AS string) AS AccountId")
    lines = t.lineitem.selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS Id",
        "CAST(l_orderkey AS string) AS ParentId",
    ).distinct()
    objects = {"accounts": flagged, "contacts": orders, "orders": lines}
    purges = [
        change.Purge("accounts"),
        change.Purge("contacts", (("AccountId", "accounts"),)),
        change.Purge("orders", (("ParentId", "contacts"), ("AccountId", "accounts"))),
    ]
    found = [
        change.rows_to_purge(objects, p).select(F.lit(p.table).alias("object"), "Id") for p in purges
    ]
    return reshape.union_all(found)


@query("""
    SELECT o_orderkey AS "Id" FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer
                        WHERE c_name = (SELECT max(c_name) FROM customer))""")
def created_by(t: Tables):
    name = t.customer.agg(F.max("c_name")).first()[0]
    return change.created_by(
        t.orders.selectExpr("o_orderkey AS Id", "o_custkey AS CreatedById"),
        t.customer.selectExpr("c_custkey AS Id", "c_name AS Name"),
        name,
    )


@query("""
    SELECT c_custkey, c_name, c_acctbal AS "Amount_Paid__c", TRUE AS "Migrated_Record__c"
    FROM customer ORDER BY c_custkey LIMIT 10 OFFSET 5""")
def slice_insert(t: Tables):
    rows = t.customer.selectExpr(
        "c_custkey", "c_name", "c_acctbal AS AmountPaid", "true AS IsActive", "c_nationkey AS CreatedDate"
    )
    return change.slice_to_insert(rows, "c_custkey", 5, 10)


@query("""
    SELECT CAST(c_custkey AS varchar) AS "Id", 'Prospect' AS "Type", 'Government' AS "Industry"
    FROM customer JOIN (SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 5 OFFSET 5)
      ON c_custkey = p_partkey""")
def slice_update(t: Tables):
    return change.slice_to_update(
        t.customer.selectExpr("CAST(c_custkey AS string) AS Id", "c_custkey AS part_key"),
        t.part.selectExpr("p_partkey AS part_key"),
        "part_key",
        "part_key",
        5,
        5,
        {"Type": "Prospect", "Industry": "Government"},
    )


@query("""
    SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, c_acctbal
    FROM customer""")
def csv_round_trip(t: Tables):
    path = shared_path(t.spark, "csv")
    gaps = "nullif(c_mktsegment, 'BUILDING') AS c_mktsegment"
    sinks.write_csv(t.customer.selectExpr("c_custkey", "c_name", gaps, "c_acctbal"), path)
    schema = "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double"
    return sources.read_csv(t.spark, path, schema)


@query("SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'purchase'")
def document_round_trip(t: Tables):
    path = shared_path(t.spark, "documents")
    events = t.events.select("event_id", "user_id", "event_type", "value")
    sinks.insert_documents(events.filter("event_type <> 'view'"), path)
    sinks.insert_documents(events.filter("event_type = 'view'"), path)
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    return sources.read_documents(t.spark, path, "event_type", "purchase", schema=schema)


@query("""
    SELECT 'orders' AS name, CAST(0 AS bigint) AS position, CAST(count(*) AS bigint) AS n_rows FROM orders
    UNION ALL
    SELECT 'customer', 1, count(*) FROM customer""")
def named_outputs(t: Tables):
    path = shared_path(t.spark, "outputs")
    sinks.write_named_outputs({"orders": t.orders, "customer": t.customer}, path)
    counts = reshape.union_all(
        [
            t.spark.read.csv(f"{path}/{name}", header=True).agg(
                F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows")
            )
            for name in ("orders", "customer")
        ]
    )
    manifest = t.spark.read.schema("position bigint, name string").json(f"{path}/{sinks.MANIFEST}")
    return counts.join(manifest, "name").select("name", "position", "n_rows")


@query("""
    WITH n AS (SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 500 AS part
               FROM customer)
    SELECT '(' || string_agg('''' || c_custkey || '''', ',' ORDER BY c_custkey) || ')' AS value
    FROM n GROUP BY part""")
def key_list_file(t: Tables):
    path = shared_path(t.spark, "keys")
    sinks.write_key_list(t.customer, "c_custkey", path, per_list=500)
    return t.spark.read.text(path)


@query("""
    SELECT c_custkey, c_name, CASE WHEN p_partkey IS NULL THEN c_mktsegment ELSE p_brand END AS segment
    FROM customer LEFT JOIN part ON c_custkey = p_partkey""")
def publish_state(t: Tables):
    spec = TableSpec(
        "segments",
        {"c_custkey": "bigint", "c_name": "varchar(30)", "segment": "varchar(20)"},
        key=("c_custkey",),
    )
    name = tables.create_table(t.spark, spec, f"segments_{uuid.uuid4().hex}")
    rows = t.customer.selectExpr("c_custkey", "c_name", "c_mktsegment AS segment")
    tables.publish(t.spark, name, rows)
    changes = t.part.selectExpr("p_partkey AS c_custkey", "p_brand AS segment")
    state = dml.keyed_update(t.spark.table(name), changes, "c_custkey", ["segment"])
    tables.publish(t.spark, name, state)
    tables.remove_superseded(t.spark, name)
    committed = stage(t.spark.table(name), "committed")
    tables.drop_table(t.spark, name)
    return committed


@query("""
    WITH r AS (SELECT o_orderkey, o_orderstatus,
                      o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 5) AS known FROM orders)
    SELECT o_orderkey, o_orderstatus, known AS "RESULTS_success",
           CASE WHEN known THEN CAST(o_orderkey AS varchar) END AS "RESULTS_id", FALSE AS "RESULTS_created",
           CASE WHEN NOT known THEN 'unknown_key' END AS "RESULTS_errors",
           CASE WHEN known THEN 'success' ELSE 'fallout' END AS report
    FROM r""")
def dml_reports(t: Tables):
    """The reports of a delete, read back: every row that was sent is in one of them."""
    output = shared_path(t.spark, "dml")
    target = t.lineitem.filter("l_linenumber = 5").selectExpr("l_orderkey AS o_orderkey")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    results = outcomes.perform("delete", target, orders, "o_orderkey").results
    submit.write_reports(results, output)
    return submit.read_reports(t.spark, output, results.schema)


@query("SELECT doc_id, text FROM documents")
def csv_text_round_trip(t: Tables):
    """Whole texts with quotes, commas, line breaks and outer blanks through a CSV file that splits."""
    path = shared_path(t.spark, "csv-texts")
    sinks.write_csv(t.documents.select("doc_id", "text"), path, one_line=True)
    return sources.read_csv(t.spark, path, "doc_id bigint, text string", one_line=True)


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || 'x' AS day
    FROM orders WHERE o_orderstatus = 'P'""")
def date_rejects(t: Tables):
    """Texts that are no date come back as they are; the others were parsed."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    spoilt = F.when(F.col("o_orderstatus") == "P", F.concat(day, F.lit("x"))).otherwise(day)
    good, bad = scalars.split_dates(t.orders.select("o_orderkey", spoilt.alias("day")), "day")
    return bad


@query("SELECT event_id, event_type, CAST(ts AS date) AS day FROM events")
def drop_time(t: Tables):
    return t.events.select("event_id", "event_type", scalars.drop_time(F.col("ts")).alias("day"))


@query("SELECT event_id, user_id, value FROM events WHERE event_type IS DISTINCT FROM 'view'")
def object_read(t: Tables):
    """An extract of an object, read without its soft-deleted rows."""
    path = shared_path(t.spark, "object")
    t.events.withColumn("IsDeleted", F.col("event_type") == "view").write.parquet(path)
    return sources.read_object(t.spark, path).select("event_id", "user_id", "value")


@query("""
    SELECT o_orderkey AS "Id", o_totalprice AS "Total", c_name AS "Account.Name"
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def query_result_read(t: Tables):
    """Result pages with nested parents, one JSON object each, as a flat frame."""
    path = shared_path(t.spark, "pages")
    record = F.expr("""struct(named_struct('type', 'Order') AS attributes, o_orderkey AS Id,
        o_totalprice AS Total, struct(c_name AS Name) AS Account)""")
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    pages = joined.groupBy((F.col("o_orderkey") % 50).alias("page")).agg(F.collect_list(record).alias("records"))
    pages.repartition("page").write.partitionBy("page").json(path)
    schema = "records array<struct<attributes: struct<type: string>, Id: bigint, Total: double, Account: struct<Name: string>>>"
    return sources.read_query_result(t.spark, f"{path}/page=*", schema)


@query("""
    SELECT o_orderkey AS "Id", o_totalprice AS "Total", o_orderstatus AS "Status",
           c_name AS "Account.Name", n_name AS "Account.Nation.Name"
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'O'""")
def paged_source_read(t: Tables):
    """All orders as pages of 200 records; open ones that aren't deleted are asked for."""
    path = shared_path(t.spark, "pages")
    record = F.expr("""struct(named_struct('type', 'Order') AS attributes, o_orderkey AS Id, o_totalprice AS Total,
        o_orderstatus AS Status, o_orderpriority = '5-LOW' AS IsDeleted,
        struct(c_name AS Name, struct(n_name AS Name) AS Nation) AS Account)""")
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    numbered = with_row_index(joined.select("o_orderkey", record.alias("record")), "o_orderkey", "n")
    pages = numbered.groupBy(F.expr("n DIV 200").alias("page")).agg(
        F.count(F.lit(1)).alias("totalSize"), F.collect_list("record").alias("records")
    )
    paged.store_pages(pages, path)
    schema = """Id bigint, Total double, Status string, IsDeleted boolean,
        Account struct<Name: string, Nation: struct<Name: string>>"""
    found = paged.read_paged(t.spark, paged.PageFolder(path), schema, pages_per_task=10)
    return found.filter("Status = 'O'").drop("IsDeleted")


@query("SELECT o_orderkey FROM orders WHERE FALSE")
def empty_submission(t: Tables):
    """Nothing is sent, and nothing written, for a frame without rows."""
    none = t.orders.filter("o_orderkey < 0").select("o_orderkey")
    sent = submit.run_dml(none, lambda batch: batch, "insert", "o_orderkey", shared_path(t.spark, "none"), "run")
    return none if sent is None else sent.success


# The purge of nine objects: which of the test tables stand for them. Ids are not ASCII.
OBJECTS_SQL = """
    WITH lines AS (SELECT DISTINCT l_orderkey, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id FROM lineitem),
    accounts AS (SELECT 'é' || c_custkey AS id, c_mktsegment = 'MACHINERY' AS flag FROM customer),
    contacts AS (SELECT 'c' || o_orderkey AS id, 'é' || o_custkey AS parent FROM orders),
    opportunities AS (SELECT 'o' || event_id AS id, 'é' || user_id AS parent FROM events),
    quotes AS (SELECT 'é' || p_partkey AS id, p_partkey % 3 = 0 AS flag FROM part),
    quote_lines AS (SELECT 's' || s_suppkey AS id, s_acctbal < 0 AS flag FROM supplier),
    orders_ AS (SELECT 'r' || o_orderkey AS id, 'é' || o_custkey AS parent FROM orders),
    order_lines AS (SELECT 'n' || n_nationkey AS id, n_regionkey = 1 AS flag FROM nation),
    contracts AS (SELECT 'k' || id AS id, 'r' || l_orderkey AS parent FROM lines),
    subscriptions AS (SELECT 'u' || id AS id, 'k' || id AS parent FROM lines),
    gone_a AS (SELECT id FROM accounts WHERE flag), gone_q AS (SELECT id FROM quotes WHERE flag),
    gone_r AS (SELECT id FROM orders_ WHERE parent IN (SELECT id FROM gone_q)),
    gone_k AS (SELECT id FROM contracts WHERE parent IN (SELECT id FROM gone_r))"""


def _objects(t: Tables) -> dict[str, DataFrame]:
    line = "concat_ws('-', l_orderkey, l_linenumber, l_partkey)"
    # Two objects hold the lines, and each is read for its selection, its outcomes and its state.
    lines = stage(t.lineitem.selectExpr("l_orderkey", f"{line} AS id").distinct(), "lines")
    flag = "AS Migrated_Record__c"
    return {
        "accounts": t.customer.selectExpr("concat('é', c_custkey) AS Id", f"c_mktsegment = 'MACHINERY' {flag}"),
        "contacts": t.orders.selectExpr("concat('c', o_orderkey) AS Id", "concat('é', o_custkey) AS AccountId"),
        "opportunities": t.events.selectExpr("concat('o', event_id) AS Id", "concat('é', user_id) AS AccountId"),
        "quotes": t.part.selectExpr("concat('é', p_partkey) AS Id", f"p_partkey % 3 = 0 {flag}"),
        "quote_lines": t.supplier.selectExpr("concat('s', s_suppkey) AS Id", f"s_acctbal < 0 {flag}"),
        "orders": t.orders.selectExpr("concat('r', o_orderkey) AS Id", "concat('é', o_custkey) AS QuoteId"),
        "order_lines": t.nation.selectExpr("concat('n', n_nationkey) AS Id", f"n_regionkey = 1 {flag}"),
        "contracts": lines.selectExpr("concat('k', id) AS Id", "concat('r', l_orderkey) AS OrderId"),
        "subscriptions": lines.selectExpr("concat('u', id) AS Id", "concat('k', id) AS ContractId"),
    }


@query(OBJECTS_SQL + """
    SELECT 'accounts' AS object, id AS "Id" FROM accounts WHERE NOT flag
    UNION ALL SELECT 'contacts', id FROM contacts WHERE parent NOT IN (SELECT id FROM gone_a)
    UNION ALL SELECT 'opportunities', id FROM opportunities WHERE coalesce(parent NOT IN (SELECT id FROM gone_a), TRUE)
    UNION ALL SELECT 'quotes', id FROM quotes WHERE NOT flag
    UNION ALL SELECT 'quote_lines', id FROM quote_lines WHERE NOT flag
    UNION ALL SELECT 'orders', id FROM orders_ WHERE id NOT IN (SELECT id FROM gone_r)
    UNION ALL SELECT 'order_lines', id FROM order_lines WHERE NOT flag
    UNION ALL SELECT 'contracts', id FROM contracts WHERE id NOT IN (SELECT id FROM gone_k)
    UNION ALL SELECT 'subscriptions', id FROM subscriptions WHERE parent NOT IN (SELECT id FROM gone_k)""")
def purge_nine_objects(t: Tables):
    """What is left of each object after the whole purge."""
    done = change.purge_states(_objects(t))
    left = [applied.state.select(F.lit(name).alias("object"), "Id") for name, applied in done.items()]
    return reshape.union_all(left)


@query("""
    WITH target AS (SELECT o_custkey AS k, min(o_orderkey) AS o FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
    fresh AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT k FROM target))
    SELECT 'é' || k AS "Account_Number_External_ID__c", 'old ' || o AS "Name",
           CAST(NULL AS bigint) AS "AnnualRevenue", TRUE AS "Migrated_Record__c" FROM target
    UNION ALL
    SELECT 'é' || c_custkey, c_name, CAST(trunc(c_acctbal) AS bigint), TRUE FROM fresh""")
def net_new_state(t: Tables):
    """The target's accounts after the insert; keys that aren't ASCII are found on both sides."""
    key = "Account_Number_External_ID__c"
    target = (
        t.orders.filter("o_orderpriority = '1-URGENT'")
        .groupBy(F.concat(F.lit("é"), "o_custkey").alias(key))
        .agg(F.concat(F.lit("old "), F.min("o_orderkey")).alias("Name"))
        .selectExpr(key, "Name", "CAST(NULL AS bigint) AS AnnualRevenue", "true AS Migrated_Record__c")
    )
    staged = t.customer.selectExpr("concat('é', c_custkey) AS number", "c_name AS name", "c_acctbal AS revenue")
    applied = change.account_inserts(
        staged, target, staged_key="number", migrated_key=key, whole_numbers=["revenue"],
        fields={"number": key, "name": "Name", "revenue": "AnnualRevenue"},
    )
    return applied.state


@query("""
    WITH target AS (SELECT s_suppkey + 10 AS c_custkey, s_name AS c_name, s_acctbal AS "Amount_Paid__c",
                           FALSE AS "Migrated_Record__c" FROM supplier),
         s AS (SELECT c_custkey, c_name, c_acctbal AS "Amount_Paid__c", TRUE AS "Migrated_Record__c"
               FROM customer ORDER BY c_custkey LIMIT 10 OFFSET 5)
    SELECT * FROM target
    UNION ALL
    SELECT * FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM target)""")
def slice_insert_state(t: Tables):
    """A target that holds some of the slice's keys already keeps its own rows of these."""
    rows = t.customer.selectExpr(
        "c_custkey", "c_name", "c_acctbal AS AmountPaid", "true AS IsActive", "c_nationkey AS CreatedDate"
    )
    wanted = change.slice_to_insert(rows, "c_custkey", 5, 10)
    target = t.supplier.selectExpr(
        "s_suppkey + 10 AS c_custkey", "s_name AS c_name", "s_acctbal AS Amount_Paid__c", "false AS Migrated_Record__c"
    )
    return outcomes.perform("insert", target, wanted, "c_custkey").state


@query("""
    WITH s AS (SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 5 OFFSET 5)
    SELECT 'é' || c_custkey AS "Id", c_custkey AS part_key,
           CASE WHEN p_partkey IS NULL THEN c_mktsegment ELSE 'Government' END AS "Industry"
    FROM customer LEFT JOIN s ON c_custkey = p_partkey""")
def slice_update_state(t: Tables):
    target = t.customer.selectExpr("concat('é', c_custkey) AS Id", "c_custkey AS part_key", "c_mktsegment AS Industry")
    parts = t.part.selectExpr("p_partkey AS part_key")
    changes = change.slice_to_update(target, parts, "part_key", "part_key", 5, 5, {"Industry": "Government"})
    return outcomes.perform("update", target, changes, "Id").state


@query("""
    SELECT 'é' || o_orderkey AS "Id", o_custkey AS "CreatedById" FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_name = (SELECT max(c_name) FROM customer))""")
def created_by_state(t: Tables):
    """What is left after all rows that one user created were deleted by their raw ids."""
    name = t.customer.agg(F.max("c_name")).first()[0]
    rows = t.orders.selectExpr("concat('é', o_orderkey) AS Id", "o_custkey AS CreatedById")
    users = t.customer.selectExpr("c_custkey AS Id", "c_name AS Name")
    found = change.created_by(rows, users, name)
    return outcomes.perform("delete", rows, found, "Id").state


@query("""
    SELECT user_id, event_id FROM (
      SELECT user_id, event_id, row_number() OVER (
               PARTITION BY user_id
               ORDER BY CASE WHEN event_type IN ('click', 'view') THEN 0
                             WHEN event_type = 'purchase' THEN 1 ELSE 2 END, event_id) AS n
      FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))
    WHERE n = 1""")
def stream_net_new(t: Tables):
    """Events land in three lots, which one start takes as one batch each; a user is kept once, from the first."""
    landing, output = shared_path(t.spark, "landing"), shared_path(t.spark, "stream")
    rows = t.events.select("event_id", "user_id")
    files = 4
    for kinds in (["click", "view"], ["purchase"], ["error", "signup"]):
        lot = t.events.filter(F.col("event_type").isin(kinds)).select("event_id", "user_id")
        lot.repartition(files).write.mode("append").parquet(landing)
        time.sleep(0.05)  # files are taken in the order of their times
    net_new_stream(
        t.spark,
        landing,
        rows.schema,
        t.customer.filter("c_acctbal < 0"),
        "user_id",
        "c_custkey",
        "event_id",
        output,
        shared_path(t.spark, "stream-checkpoint"),
        files_per_batch=files,
    ).awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(output).select("user_id", "event_id")
