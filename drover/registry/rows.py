"""Queries on columns, filters, order and shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.functions import scalars
from drover.operators import keylists, reconcile, reshape, sequence
from drover.operators.ordering import rank_in_group, running_sums, with_row_index
from drover.registry.base import Query, Tables, registrar
from drover.sources import files
from drover.sources.sql import run_sql

QUERIES: dict[str, Query] = {}
query = registrar(QUERIES)


@query("""
    SELECT CAST(o_orderkey AS varchar) AS o_orderkey, o_custkey, o_orderstatus,
           CAST(trunc(o_totalprice) AS bigint) AS o_totalprice, o_orderdate, o_orderpriority
    FROM orders""")
def typed_cast(t: Tables):
    return scalars.cast_by_position(t.orders, ("str", "int", "str", "int", "date"))


@query("""
    SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS segment,
           CAST(nullif(c_nationkey, 3) AS bigint) AS nation
    FROM customer""")
def fill_blank(t: Tables):
    gaps = t.customer.select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.nullif("c_nationkey", F.lit(3)).cast("bigint").alias("nation"),
    )
    return scalars.fill_blank(gaps)


@query("""
    SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE event_type END AS kind
    FROM events""")
def null_tokens(t: Tables):
    texts = (
        F.when(F.col("event_type") == "view", " ")
        .when(F.col("event_type") == "click", "NaT")
        .otherwise(F.col("event_type"))
    )
    return t.events.select("event_id", scalars.tokens_to_null(texts).alias("kind"))


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events""")
def nan_to_null(t: Tables):
    broken = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return scalars.nan_to_null(t.events.select("event_id", broken.alias("value")))


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN NULL
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
    FROM orders""")
def format_date(t: Tables):
    text = F.when(F.col("o_orderstatus") == "P", " ").otherwise(
        F.date_format("o_orderdate", "M/d/yyyy")
    )
    return scalars.iso_date_columns(t.orders.select("o_orderkey", text.alias("day")), "day")


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS date) AS day,
           CAST(CAST(o_orderdate AS date) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS date) AS end_date
    FROM orders""")
def contract_end_date(t: Tables):
    text = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "M/d/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    days = t.orders.select("o_orderkey", scalars.parse_date(text).alias("day"))
    return days.withColumn("end_date", scalars.year_end_after(F.col("day")))


@query("""
    SELECT p_partkey,
           coalesce(nullif(p_brand, 'Brand#7'), '') || '-' || coalesce(nullif(p_type, 'ECONOMY'), '')
             AS product,
           'install - ' || nullif(p_type, 'ECONOMY') AS installation
    FROM part""")
def text_columns(t: Tables):
    kind = F.nullif("p_type", F.lit("ECONOMY"))
    return t.part.select(
        "p_partkey",
        scalars.concat_blank(F.nullif("p_brand", F.lit("Brand#7")), kind).alias("product"),
        scalars.prefixed("install - ", kind).alias("installation"),
    )


ESCAPE_SQL = r"""
    SELECT doc_id, md5(escaped) AS digest, CAST(length(escaped) AS bigint) AS n_chars
    FROM (SELECT doc_id,
                 array_to_string(list_transform(string_split(text, ''), lambda c:
                   CASE WHEN c = '' THEN ''
                        WHEN c = '\' THEN '\\'
                        WHEN ord(c) = 9 THEN '\t'
                        WHEN ord(c) = 10 THEN '\n'
                        WHEN ord(c) = 13 THEN '\r'
                        WHEN ord(c) BETWEEN 32 AND 126 THEN c
                        WHEN ord(c) < 256 THEN '\x' || printf('%02x', ord(c))
                        WHEN ord(c) < 65536 THEN '\u' || printf('%04x', ord(c))
                        ELSE '\U' || printf('%08x', ord(c)) END), '') AS escaped
          FROM documents)"""


def _escaped(texts: DataFrame) -> DataFrame:
    return scalars.escape_columns(texts).select(
        "doc_id",
        F.md5(F.col("text").cast("binary")).alias("digest"),
        F.char_length("text").cast("bigint").alias("n_chars"),
    )


@query(ESCAPE_SQL)
def escape_unicode(t: Tables):
    return _escaped(t.documents.select("doc_id", "text"))


# 48 characters outside ASCII, more than a text may hold to be escaped kind by kind.
MANY_KINDS = "".join(chr(0x100 + 7 * k) for k in range(48))


@query(ESCAPE_SQL.replace(
    "FROM documents)",
    f"FROM (SELECT doc_id, text || CASE WHEN doc_id % 2 = 0 THEN '{MANY_KINDS}' ELSE '' END AS text FROM documents))",
))
def escape_many_kinds(t: Tables):
    """Texts on both sides of the limit above which they are escaped piece by piece."""
    more = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit(MANY_KINDS))).otherwise(F.col("text"))
    return _escaped(t.documents.select("doc_id", more.alias("text")))


@query("""
    SELECT CAST(to_json({o_orderkey: o_orderkey, o_custkey: o_custkey,
                         o_orderstatus: nullif(o_orderstatus, 'P'),
                         o_orderpriority: o_orderpriority}) AS varchar) AS record
    FROM orders""")
def json_record(t: Tables):
    return scalars.json_record(
        t.orders.select(
            "o_orderkey",
            "o_custkey",
            F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
            "o_orderpriority",
        )
    )


@query("""
    SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS bigint) AS "props.k",
           user_id AS "props.user.id", event_type AS "props.user.kind.name"
    FROM events""")
def flatten_nested(t: Tables):
    attributes = F.struct(F.lit("Event").alias("type")).alias("attributes")
    kind = F.struct(attributes, F.col("event_type").alias("name")).alias("kind")
    user = F.struct(attributes, F.col("user_id").alias("id"), kind).alias("user")
    k = F.from_json("props", "k bigint").getField("k").alias("k")
    nested = t.events.select(
        "event_id", attributes, F.struct(attributes, k, user).alias("props"), "event_type"
    )
    return reshape.flatten(nested)


@query("""
    SELECT o_orderkey AS "Id", o_orderpriority AS "Name",
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS "Account.Id",
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS "Amount"
    FROM orders""")
def query_records(t: Tables):
    attributes = F.struct(F.lit("Order").alias("type")).alias("attributes")
    account = F.when(
        F.col("o_orderstatus") != "F", F.struct(attributes, F.col("o_custkey").alias("Id"))
    )
    amount = F.when(F.col("o_orderstatus") == "P", float("nan")).otherwise(F.col("o_totalprice"))
    record = F.struct(
        attributes,
        F.col("o_orderkey").alias("Id"),
        F.col("o_orderpriority").alias("Name"),
        account.alias("Account"),
        amount.alias("Amount"),
    )
    return files.flat_records(t.orders.select(F.array(record).alias("records")))


@query("""
    SELECT o_orderkey, o_orderstatus = 'F' AS is_final FROM orders WHERE o_orderstatus = 'F'""")
def filter_flag(t: Tables):
    flagged = t.orders.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("is_final"))
    return flagged.filter("is_final")


@query("SELECT event_id, event_type, value FROM events WHERE event_type = 'error'")
def filter_equals(t: Tables):
    return files.find_documents(t.events.select("event_id", "event_type", "value"), "event_type", "error")


@query("""
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""")
def soft_delete_filter(t: Tables):
    flagged = t.orders.select("o_orderkey", "o_orderstatus", (F.col("o_orderstatus") == "F").alias("gone"))
    return reshape.discard(reconcile.visible(flagged, "gone"), ["gone"])


@query("""
    SELECT c_custkey AS "Id", c_name AS "Name", c_mktsegment AS "Industry", 'Prospect' AS "Type"
    FROM customer""")
def project_columns(t: Tables):
    kept = reshape.discard(reshape.keep(t.customer, t.customer.columns), ["c_nationkey", "c_acctbal"])
    renamed = reshape.rename(kept, {"c_custkey": "Id", "c_name": "Name", "c_mktsegment": "Industry"})
    return reshape.add_literals(renamed, {"Type": "Prospect"})


@query("""
    SELECT s_suppkey AS "RESULTS_s_suppkey", s_name AS "RESULTS_s_name" FROM supplier""")
def prefix_columns(t: Tables):
    return reshape.add_prefix(t.supplier.select("s_suppkey", "s_name"), "RESULTS_")


@query("""
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::double AS balance
    FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def union_missing_cols(t: Tables):
    customers = t.customer.selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    suppliers = t.supplier.selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS id")
    return reshape.union_all([customers, suppliers])


@query("""
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100""")
def slice_rows(t: Tables):
    return reshape.slice_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 100, 50)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    LIMIT 5000 OFFSET 30000""")
def slice_deep(t: Tables):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return reshape.slice_rows(t.lineitem.select(*order), order, 30_000, 5_000)


@query("""
    SELECT CAST(row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS bigint) AS id,
           c_custkey, c_mktsegment
    FROM customer""")
def renumber_rows(t: Tables):
    rows = t.customer.selectExpr("c_custkey AS id", "c_custkey", "c_mktsegment")
    return reshape.renumber(rows, ["c_mktsegment", "id"])


@query("""
    WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders),
         e AS (SELECT event_id, event_type, row_number() OVER (ORDER BY ts, event_id) - 1 AS i FROM events)
    SELECT CAST(o.i AS bigint) AS at, o_orderkey, event_id, event_type FROM o LEFT JOIN e ON o.i = e.i""")
def positional_zip(t: Tables):
    return reshape.zip_rows(
        t.orders.select("o_orderkey"),
        t.events.select("event_id", "event_type", "ts"),
        "o_orderkey",
        ["ts", "event_id"],
        how="left",
        index="at",
    ).drop("ts")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                            l_extendedprice) - 1 AS bigint) AS row_index
    FROM lineitem""")
def row_index(t: Tables):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return with_row_index(t.lineitem.select(*order), order)


@query("""
    SELECT event_id, event_type,
           CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS bigint) AS rank
    FROM events""")
def rank_rows(t: Tables):
    return rank_in_group(t.events.select("event_id", "event_type"), "event_type", "event_id")


@query("""
    SELECT o_orderkey, CAST(sum(o_custkey) OVER (ORDER BY o_orderkey) AS bigint) AS total
    FROM orders""")
def running_total(t: Tables):
    sums = running_sums(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", {"total": "o_custkey"})
    return sums.select("o_orderkey", "total")


RUNS_SQL = """
    WITH marked AS (
      SELECT *, CASE WHEN {breaks} THEN 1 ELSE 0 END AS brk
      FROM (SELECT *, {before} FROM {table})),
    runs AS (SELECT *, sum(brk) OVER (ORDER BY {order}) AS run FROM marked)
    SELECT {columns}, CAST(10 + 10 * (row_number() OVER (PARTITION BY run ORDER BY {order}) - 1)
                           AS bigint) AS seq
    FROM runs"""


@query(
    RUNS_SQL.format(
        table="events",
        before="lag(event_id) OVER (ORDER BY event_id) AS id_before, "
        "lag(event_type) OVER (ORDER BY event_id) AS before",
        breaks="id_before IS NULL OR event_type IS DISTINCT FROM before",
        order="event_id",
        columns="event_id, event_type",
    )
)
def seq_runs(t: Tables):
    rows = t.events.select("event_id", "event_type")
    return sequence.number_runs(rows, "event_type", "event_id", "seq")


LINE_ORDER = [
    "l_orderkey",
    "l_returnflag",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
]
LINE_COLUMNS = ", ".join(LINE_ORDER)


@query(
    RUNS_SQL.format(
        table="lineitem",
        before=f"lag(l_orderkey) OVER (ORDER BY {LINE_COLUMNS}) AS order_before, "
        f"lag(l_returnflag) OVER (ORDER BY {LINE_COLUMNS}) AS flag_before",
        breaks="l_orderkey IS DISTINCT FROM order_before "
        "OR l_returnflag IS NOT DISTINCT FROM flag_before",
        order=LINE_COLUMNS,
        columns=LINE_COLUMNS,
    )
)
def seq_changing(t: Tables):
    rows = t.lineitem.select(*LINE_ORDER)
    return sequence.number_runs(rows, "l_orderkey", LINE_ORDER, "seq", changing="l_returnflag")


@query(f"""
    SELECT {LINE_COLUMNS}, CAST(10 * dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag)
                                AS bigint) AS seq
    FROM lineitem""")
def seq_hold(t: Tables):
    rows = t.lineitem.select(*LINE_ORDER)
    return sequence.number_runs(
        rows, "l_orderkey", LINE_ORDER, "seq", changing="l_returnflag", hold=True
    )


@query(f"""
    SELECT {LINE_COLUMNS},
           CAST(10 * row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_COLUMNS}) AS bigint) AS seq
    FROM lineitem""")
def seq_sorted(t: Tables):
    rows = t.lineitem.select(*LINE_ORDER)
    return sequence.number_groups(rows, "l_orderkey", LINE_ORDER[1:], "seq")


@query("""
    SELECT CAST(0 AS bigint) AS part,
           '(' || string_agg('''' || c_mktsegment || '''', ',' ORDER BY c_mktsegment) || ')' AS in_list
    FROM (SELECT DISTINCT c_mktsegment FROM customer)""")
def sql_in_list(t: Tables):
    return keylists.in_lists(t.customer, "c_mktsegment")


@query("""
    WITH v AS (SELECT DISTINCT c_name FROM customer),
         n AS (SELECT c_name, (row_number() OVER (ORDER BY c_name) - 1) // 100 AS part FROM v)
    SELECT CAST(part AS bigint) AS part,
           '(' || string_agg('''' || replace(c_name, '''', '''''') || '''', ',' || chr(10)
                             ORDER BY c_name) || ')' AS in_list
    FROM n GROUP BY part""")
def sql_in_list_parts(t: Tables):
    return keylists.in_lists(t.customer, "c_name", per_list=100, one_per_line=True)


@query("""
    SELECT n_name, CAST(count(*) AS bigint) AS n_rows, CAST(max(c_custkey) AS bigint) AS last_key
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_acctbal > 100.0 AND c_mktsegment <> 'BUILDING'
    GROUP BY n_name""")
def sql_text(t: Tables):
    return run_sql(
        t.spark,
        """SELECT n_name, count(*) AS n_rows, max(c_custkey) AS last_key
           FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
           WHERE c_acctbal > :least AND c_mktsegment <> :segment
           GROUP BY n_name""",
        {"customer": t.customer, "nation": t.nation},
        {"least": 100.0, "segment": "BUILDING"},
    )
