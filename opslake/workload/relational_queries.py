"""Sources, projections, filters, joins, aggregates, sorts, sets and scalar functions on the benchmark tables."""

import datetime
import uuid

from pyspark.sql import functions as F

from opslake.functions import moments, numeric, text
from opslake.operators import aggregates, joins, ranking, sets
from opslake.plans import quality
from opslake.sources import NEVER_BLANK, all_text_csv, audit, ensure_table, inline_rows, read_csv, read_json, read_table, writers
from opslake.workload.registry import SCHEMAS, Tables, avg_sql, pct_sql, query
from opslake.workload.shared import shared_dir

ALL_TABLES = tuple(SCHEMAS)

# --- sources and sinks ----------------------------------------------------


@query("s1_typed_parquet_scan", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS orders, max(o_custkey) AS max_custkey FROM orders GROUP BY ALL""")
def s1(t: Tables):
    ddl = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    df = read_table(t.spark, f"{t.path}/orders.parquet", ddl, blank=NEVER_BLANK)
    return df.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_custkey").alias("max_custkey")
    )


@query("s2_day_directories", """
    SELECT event_type, count(*) AS events, CAST(sum(user_id) AS BIGINT) AS users FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08' GROUP BY event_type""")
def s2(t: Tables):
    """Write events by day, then read three days; the other directories are not opened."""
    path = shared_dir(t.spark)
    writers.write_by_day(t.events, path, "ts")
    days = [datetime.date(2024, 1, d) for d in (5, 6, 7)]
    df = read_table(t.spark, path, days=days, blank=NEVER_BLANK)
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("user_id").cast("bigint").alias("users")
    )


@query("s14_csv_round_trip", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def s14(t: Tables):
    """Write CSV with a header and read every column back as text."""
    path = shared_dir(t.spark)
    writers.write_csv(t.customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    return all_text_csv(t.spark, path)


@query("s15_json_round_trip", "SELECT conv_id, turn, role, nullif(text, '') AS text FROM conversations")
def s15(t: Tables):
    path = shared_dir(t.spark)
    writers.write_json(t.conversations, path)
    return read_json(t.spark, path, "conv_id bigint, turn bigint, role string, text string")


query("s9_scan_report", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS rows, CAST(0 AS BIGINT) AS corrupt FROM {n}" for n in ALL_TABLES))(
    lambda t: audit.scan_report({n: getattr(t, n) for n in ALL_TABLES})
)
query("s16_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {n}" for n in ALL_TABLES))(
    lambda t: audit.row_counts({n: getattr(t, n) for n in ALL_TABLES})
)
@query("s10_files_behind_table", "SELECT 'lineitem.parquet' AS file_name, count(*) AS rows FROM lineitem")
def s10(t: Tables):
    """Files that a table is read from, with their rows; a table may be a folder of files."""
    table = F.coalesce(F.nullif(F.regexp_extract("path", r"([^/]+\.parquet)/[^/]+$", 1), F.lit("")), text.base_name(F.col("path")))
    return audit.files_of(t.lineitem).groupBy(table.alias("file_name")).agg(F.sum("rows").cast("bigint").alias("rows"))


@query("s11_file_hashes", """
    SELECT 'nation=' || c_nationkey AS folder, CAST(sum(1 + length(line)) AS BIGINT) AS size_bytes, sha256(string_agg(line, chr(10) ORDER BY c_custkey) || chr(10)) AS sha256
    FROM (SELECT c_nationkey, c_custkey, c_custkey || ',' || c_mktsegment AS line FROM customer) GROUP BY c_nationkey""")
def s11(t: Tables):
    """One text file of customers per nation is written, then every file is hashed."""
    path = shared_dir(t.spark)
    rows = t.customer.select(F.col("c_nationkey").alias("nation"), "c_custkey", F.concat_ws(",", "c_custkey", "c_mktsegment").alias("value"))
    rows.repartition("nation").sortWithinPartitions("nation", "c_custkey").drop("c_custkey").write.partitionBy("nation").text(path)
    folder = F.element_at(F.split("path", "/"), -2)
    return audit.file_hashes(t.spark, path, "*.txt").select(folder.alias("folder"), "size_bytes", "sha256")


@query("s12_shape_report", """
    SELECT 'l_partkey' AS "column", 'type bigint, expected string' AS issue
    UNION ALL SELECT 'l_comment', 'missing'
    UNION ALL SELECT column_name, 'unexpected' FROM (DESCRIBE lineitem) WHERE column_name NOT IN ('l_orderkey', 'l_partkey')
    UNION ALL SELECT NULL, count(*) || ' rows, expected 0' FROM lineitem HAVING count(*) <> 0""")
def s12(t: Tables):
    from pyspark.sql.types import StructType

    expected = StructType.fromDDL("l_orderkey bigint, l_partkey string, l_comment string")
    return audit.shape_report(t.spark, t.lineitem, expected, rows=0)


@query("s3_schema_from_file", "SELECT p_brand, count(*) AS parts, max(p_partkey) AS max_partkey FROM part GROUP BY p_brand")
def s3(t: Tables):
    """No schema is given: it comes from one file of the table."""
    df = read_table(t.spark, f"{t.path}/part.parquet", blank=NEVER_BLANK)
    return df.groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"), F.max("p_partkey").alias("max_partkey"))


def _mixed_csv(t: Tables) -> str:
    """Customers as CSV in which the balance of every seventh is no number."""
    path = shared_dir(t.spark)
    balance = F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    writers.write_csv(t.customer.select("c_custkey", balance.alias("c_acctbal"), "c_mktsegment"), path)
    return path


_CUSTOMER_CSV = "c_custkey bigint, c_acctbal double, c_mktsegment string"


@query("s4_csv_good_rows", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 7 <> 0")
def s4(t: Tables):
    return read_csv(t.spark, _mixed_csv(t), _CUSTOMER_CSV)


@query("s4_csv_rejected_rows", """
    SELECT c_custkey || ',n/a,' || c_mktsegment AS rejected FROM customer WHERE c_custkey % 7 = 0""")
def s4_rejected(t: Tables):
    kept = read_csv(t.spark, _mixed_csv(t), _CUSTOMER_CSV, on_bad="keep")
    return kept.where(F.col("_corrupt_record").isNotNull()).select(F.col("_corrupt_record").alias("rejected"))


@query("s5_create_if_absent", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def s5(t: Tables):
    """The table is made from the first file; asked for again with another one, it stays as it is."""
    name, first, second = f"catalog_{uuid.uuid4().hex}", shared_dir(t.spark), shared_dir(t.spark)
    writers.write_csv(t.customer.select("c_custkey", "c_mktsegment"), first)
    writers.write_csv(t.customer.select((-F.col("c_custkey")).alias("c_custkey"), F.lit("other").alias("c_mktsegment")), second)
    for path in (first, second):
        table = ensure_table(t.spark, name, path, "c_custkey bigint, c_mktsegment string")
    return table.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("s8_inline_rows", """
    SELECT word, count(*) AS orders FROM orders JOIN (VALUES ('O', 'open'), ('F', 'finished')) s(code, word) ON code = o_orderstatus GROUP BY word""")
def s8(t: Tables):
    states = inline_rows(t.spark, [("O", "open"), ("F", "finished")], "code string, word string")
    return t.orders.join(F.broadcast(states), F.col("o_orderstatus") == F.col("code")).groupBy("word").agg(F.count(F.lit(1)).alias("orders"))


@query("s17_column_comments", """
    SELECT 'orders' AS "table", * FROM (
      SELECT 1 AS position, 'o_orderkey' AS "column", 'bigint' AS type, 'key' AS comment, count(o_orderkey) AS filled FROM orders
      UNION ALL SELECT 2, 'o_rush', 'boolean', NULL, count(o_orderpriority) FROM orders)""")
def s17(t: Tables):
    """Comments are part of the schema and survive a select."""
    df = t.orders.select("o_orderkey", (F.col("o_orderpriority") == "1-URGENT").alias("o_rush"))
    return audit.column_report({"orders": audit.with_comments(df, {"o_orderkey": "key"}).select("*")})


@query("s20_dictionary", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", {i} AS position, '{c}' AS \"column\", '{k}' AS type, CAST(NULL AS VARCHAR) AS comment, count({c}) AS filled FROM {n}"
    for n in ("region", "nation", "supplier", "events")
    for i, (c, k) in enumerate((x.strip().split(" ") for x in SCHEMAS[n].split(",")), 1)))
def s20(t: Tables):
    return audit.column_report({n: getattr(t, n) for n in ("region", "nation", "supplier", "events")})


# --- hot keys ---------------------------------------------------------------


@query("j5_hot_key", """
    SELECT p_brand, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS units
    FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS k, l_quantity FROM lineitem) JOIN part ON p_partkey = k GROUP BY p_brand""")
def j5_hot(t: Tables):
    """A third of all lines names one part; its lines are salted, all others joined plainly."""
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("l_partkey"))
    lines = t.lineitem.select(key.alias("k"), "l_orderkey", "l_linenumber", "l_quantity")
    joined = joins.salted_join(t.part.select("p_partkey", "p_brand"), lines, "p_partkey", "k")
    return joined.groupBy("p_brand").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("bigint").alias("units"))


# --- projections and filters ----------------------------------------------

query("p1_projection", "SELECT o_orderkey AS incident, o_totalprice AS amount, o_orderstatus AS state FROM orders")(
    lambda t: t.orders.select(
        F.col("o_orderkey").alias("incident"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("state"))
)
query("p2_keys_as_text", "SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line_id, l_returnflag FROM lineitem")(
    lambda t: t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").cast("string").alias("line_id"), "l_returnflag")
)
query("p3_constants", """
    SELECT c_custkey, 'CUSTOMER' AS relation_type, CAST(NULL AS BIGINT) AS task_id, CAST(NULL AS VARCHAR) AS lot FROM customer""")(
    lambda t: t.customer.select(
        "c_custkey", F.lit("CUSTOMER").alias("relation_type"), F.lit(None).cast("bigint").alias("task_id"),
        F.lit(None).cast("string").alias("lot"))
)
query("p4_equality_filter", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'")(
    lambda t: t.lineitem.where("l_returnflag = 'R' AND l_linestatus = 'O'").select("l_orderkey", "l_partkey", "l_quantity")
)
query("p5_in_lists", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('F')")(
    lambda t: t.orders.where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("F")).select("o_orderkey")
)
query("p6_null_tests", """
    SELECT count(*) FILTER (r IS NULL) AS without_return, count(*) FILTER (r IS NOT NULL) AS with_return
    FROM orders LEFT JOIN (SELECT l_orderkey AS r FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) ON r = o_orderkey""")(
    lambda t: t.orders.join(
        t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("r")).distinct(), F.col("o_orderkey") == F.col("r"), "left"
    ).agg(
        aggregates.count_where(F.col("r").isNull()).alias("without_return"),
        aggregates.count_where(F.col("r").isNotNull()).alias("with_return"))
)


@query("p7_closed_time_window", """
    SELECT event_id, user_id FROM events WHERE event_type = 'error' AND ts BETWEEN TIMESTAMP '2024-01-10 08:00:00' AND TIMESTAMP '2024-01-20 18:00:00'""")
def p7(t: Tables):
    from opslake.plans.metrics import in_window

    low, high = (F.to_timestamp_ntz(F.lit(x)) for x in ("2024-01-10 08:00:00", "2024-01-20 18:00:00"))
    return in_window(t.events.where("event_type = 'error'"), "ts", low, high).select("event_id", "user_id")


query("p8_or_thresholds", "SELECT event_id, value FROM events WHERE value <= 10 OR value >= 150")(
    lambda t: t.events.where((F.col("value") <= 10) | (F.col("value") >= 150)).select("event_id", "value")
)
query("p9_rule_violations", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE NOT ((l_returnflag <> 'R' OR l_discount > 0) AND (l_linestatus <> 'F' OR l_tax < 0.08))""")(
    lambda t: quality.violations(
        t.lineitem,
        ((F.col("l_returnflag") != "R") | (F.col("l_discount") > 0)) & ((F.col("l_linestatus") != "F") | (F.col("l_tax") < 0.08)),
    ).select("l_orderkey", "l_linenumber", "l_partkey")
)


@query("p10_valid_ids", r"""
    SELECT p_partkey, regexp_matches(upper(p_brand), '^BRAND#[0-9]{1,2}$') AND regexp_matches(p_name, '^[a-z]+ [a-z]+$') AS valid_id FROM part""")
def p10(t: Tables):
    ok = F.upper("p_brand").rlike(r"^BRAND#[0-9]{1,2}$") & F.col("p_name").rlike(r"^[a-z]+ [a-z]+$")
    return t.part.select("p_partkey", ok.alias("valid_id"))


@query("p11_bound_parameter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice >= 300000")
def p11(t: Tables):
    return t.spark.sql(
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = :state AND o_totalprice >= :low",
        args={"state": "P", "low": 300000.0}, orders=t.orders,
    )


@query("p12_allowed_views", "SELECT event_id, event_type, value FROM events")
def p12(t: Tables):
    """Only the allowed view with its fixed columns is visible; user ids are not."""
    audit.public_views(t.spark, {"opslake_public_events": (t.events, ["event_id", "event_type", "value"])})
    return t.spark.table("opslake_public_events")


# --- joins ----------------------------------------------------------------

query("j1_inner", "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey")(
    lambda t: t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")
)
query("j2_lookup", """
    SELECT c_custkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON n_nationkey = c_nationkey""")(
    lambda t: t.customer.join(t.nation.where("n_regionkey <> 2"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")
)


@query("j3_left_on_two_keys", """
    SELECT p.product, p.season, s.units FROM (SELECT p_partkey AS product, CAST(y AS VARCHAR) AS season FROM part, range(1995, 2002) g(y)) p
    LEFT JOIN (SELECT l_partkey AS product, strftime(l_shipdate, '%Y') AS season, sum(l_quantity) AS units FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) s
      ON s.product = p.product AND s.season = p.season""")
def j3(t: Tables):
    years = F.array(*[F.lit(str(y)) for y in range(1995, 2002)])
    grid = t.part.select(F.col("p_partkey").alias("product"), F.explode(years).alias("season"))
    sold = (
        t.lineitem.where("l_returnflag = 'R'")
        .groupBy(F.col("l_partkey").alias("product"), F.date_format("l_shipdate", "yyyy").alias("season"))
        .agg(F.sum("l_quantity").alias("units"))
    )
    return grid.join(sold, ["product", "season"], "left")


query("j4_left_with_literal_condition", """
    SELECT o_orderkey, count(l_orderkey) AS returned_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' GROUP BY o_orderkey""")(
    lambda t: t.orders.join(t.lineitem.where("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    .groupBy("o_orderkey").agg(F.count("l_orderkey").alias("returned_lines"))
)


@query("j5_peers_of_the_worst", """
    WITH parts AS (SELECT p_partkey, p_brand || '-' || (p_partkey // 500) AS lot, p_size FROM part)
    SELECT a.p_partkey AS worst_part, a.lot, b.p_partkey AS peer FROM parts a JOIN parts b ON b.lot = a.lot AND b.p_partkey <> a.p_partkey
    WHERE a.p_size = 50""")
def j5(t: Tables):
    """Self join on the lot with unequal ids; hot lots are salted. The left side is filtered first."""
    lot = F.concat("p_brand", F.lit("-"), F.floor(F.col("p_partkey") / 500).cast("bigint").cast("string"))
    worst = t.part.where("p_size = 50").select(F.col("p_partkey").alias("worst_part"), lot.alias("lot"))
    peers = t.part.select(F.col("p_partkey").alias("peer"), lot.alias("peer_lot"))
    return joins.salted_join(worst, peers, "lot", "peer_lot").where("worst_part <> peer").select("worst_part", "lot", "peer")


query("j6_join_chain", """
    SELECT n_name, r_name, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(20, 6))) AS DOUBLE) AS units
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""")(
    lambda t: t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    .groupBy("n_name", "r_name").agg(F.count(F.lit(1)).alias("lines"), numeric.exact_sum(F.col("l_quantity")).alias("units"))
)
query("j7_exists_flag", """
    SELECT o_orderkey, CAST(EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = CASE WHEN o_orderstatus = 'P' THEN o_orderkey - 1 ELSE o_orderkey END
        AND l_returnflag = 'R') AS INTEGER) AS has_return FROM orders""")(
    lambda t: joins.flag_exists(
        t.orders.select("o_orderkey", "o_orderstatus"), t.lineitem.where("l_returnflag = 'R'"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")), "l_orderkey", "has_return",
    ).select("o_orderkey", "has_return")
)
query("j8_not_exists", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")(
    lambda t: t.orders.join(t.lineitem.where("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")
)
query("j9_rows_to_drop", """
    SELECT l_returnflag, l_linestatus, count(*) AS lines FROM lineitem
    WHERE l_returnflag = 'N' AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'P') GROUP BY ALL""")(
    lambda t: t.lineitem.where("l_returnflag = 'N'")
    .join(t.orders.where("o_orderstatus = 'P'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    .groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("lines"))
)
query("j10_in_scope", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)")(
    lambda t: joins.in_scope(t.customer, t.nation.where("n_regionkey < 3"), "c_nationkey", "n_nationkey").select("c_custkey", "c_nationkey")
)
query("j11_dangling", """
    SELECT count(*) AS dangling FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = l_orderkey
    LEFT JOIN (SELECT p_partkey FROM part WHERE p_size < 40) ON p_partkey = l_partkey WHERE o_orderkey IS NULL OR p_partkey IS NULL""")(
    lambda t: joins.dangling(
        t.lineitem.select("l_orderkey", "l_partkey"),
        [("l_orderkey", t.orders.where("o_orderstatus <> 'P'"), "o_orderkey"), ("l_partkey", t.part.where("p_size < 40"), "p_partkey")],
    ).agg(F.count(F.lit(1)).alias("dangling"))
)


@query("j12_overlay", """
    SELECT c_custkey, coalesce(best, c_mktsegment) AS c_mktsegment, CASE WHEN k IS NULL THEN 'MASTER' ELSE 'ORDERS' END AS source
    FROM customer LEFT JOIN (SELECT o_custkey AS k, max(o_orderpriority) AS best FROM orders WHERE o_totalprice > 480000 GROUP BY o_custkey) ON k = c_custkey""")
def j12(t: Tables):
    patch = t.orders.where("o_totalprice > 480000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderpriority").alias("c_mktsegment"))
    return joins.overlay(
        t.customer.select("c_custkey", "c_mktsegment"), patch, "c_custkey", "c_mktsegment", {"source": F.lit("ORDERS")}, {"source": F.lit("MASTER")})


query("j13_unresolved_references", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")(
    lambda t: joins.unresolved(t.documents.select("doc_id", "lang"), "doc_id", t.labels, "doc_id")
)
query("j14_key_lookup", "SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON p_partkey = l_partkey")(
    lambda t: t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_name")
)
query("j15_with_parent", """
    SELECT c.conv_id, c.turn, c.role, p.role AS base_role FROM conversations c LEFT JOIN conversations p
      ON p.conv_id = c.conv_id AND p.turn = CASE WHEN c.role = 'assistant' THEN c.turn - 1 ELSE c.turn END""")(
    lambda t: joins.with_parent(
        t.conversations.select(
            "conv_id", "turn", "role", F.concat_ws("/", "conv_id", "turn").alias("id"),
            F.when(F.col("role") == "assistant", F.concat_ws("/", "conv_id", (F.col("turn") - 1).cast("bigint"))).otherwise("").alias("parent")),
        "id", "parent", {"base_role": "role"}).select("conv_id", "turn", "role", "base_role")
)

# --- aggregates -----------------------------------------------------------

query("a1_group_statistics", f"""
    SELECT l_returnflag, l_linestatus, count(*) AS lines, {avg_sql('l_extendedprice', 2)} AS avg_price, min(l_quantity) AS min_quantity,
        max(l_quantity) AS max_quantity, CAST(sum(CAST(l_quantity AS DECIMAL(20, 6))) AS DOUBLE) AS quantity FROM lineitem GROUP BY ALL""")(
    lambda t: t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), numeric.exact_avg(F.col("l_extendedprice"), 2).alias("avg_price"),
        F.min("l_quantity").alias("min_quantity"), F.max("l_quantity").alias("max_quantity"),
        numeric.exact_sum(F.col("l_quantity")).alias("quantity"))
)
query("a2_conditional_count", "SELECT l_suppkey, count(*) FILTER (l_returnflag IN ('R', 'N')) AS abnormal FROM lineitem GROUP BY l_suppkey")(
    lambda t: t.lineitem.groupBy("l_suppkey").agg(aggregates.count_where(F.col("l_returnflag").isin("R", "N")).alias("abnormal"))
)
query("a3_metric_columns", """
    SELECT user_id, max(value) FILTER (event_type = 'error') AS max_error, min(value) FILTER (event_type = 'click') AS min_click,
        max(value) FILTER (event_type = 'view') AS max_view FROM events GROUP BY user_id""")(
    lambda t: aggregates.metric_columns(t.events, ["user_id"], "event_type", {
        "max_error": ("error", F.max, F.col("value")), "min_click": ("click", F.min, F.col("value")), "max_view": ("view", F.max, F.col("value"))})
)
query("a4_first_date_where", "SELECT l_partkey, strftime(min(l_shipdate) FILTER (l_returnflag = 'R'), '%Y-%m-%d') AS first_return FROM lineitem GROUP BY l_partkey")(
    lambda t: t.lineitem.groupBy("l_partkey").agg(
        moments.format_day(F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")))).alias("first_return"))
)
query("a5_count_battery", """
    SELECT count(*) FILTER (l_discount = 0) AS no_discount, count(*) FILTER (l_quantity > 40) AS bulk, count(*) FILTER (l_tax IS NULL) AS no_tax,
        count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O') AS open_returns FROM lineitem""")(
    lambda t: aggregates.count_battery(t.lineitem, {
        "no_discount": F.col("l_discount") == 0, "bulk": F.col("l_quantity") > 40, "no_tax": F.col("l_tax").isNull(),
        "open_returns": (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")})
)
query("a6_count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY l_returnflag")(
    lambda t: t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders"))
)
query("a7_distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")(
    lambda t: t.lineitem.select("l_partkey", "l_suppkey").distinct()
)
query("a8_offending_keys", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL")(
    lambda t: aggregates.offending_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
)
query("a9_global_aggregate", "SELECT count(*) AS orders, max(o_totalprice) AS max_price, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day FROM orders")(
    lambda t: t.orders.agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("max_price"), moments.format_day(F.min("o_orderdate")).alias("first_day"))
)
query("a10_two_levels", """
    SELECT o_orderpriority, count(*) AS customers, max(n) AS max_orders FROM (SELECT o_orderpriority, o_custkey, count(*) AS n FROM orders GROUP BY ALL) GROUP BY ALL""")(
    lambda t: t.orders.groupBy("o_orderpriority", "o_custkey").agg(F.count(F.lit(1)).alias("n"))
    .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("customers"), F.max("n").alias("max_orders"))
)
query("a11_count_and_min", "SELECT o_custkey, count(*) AS n, min(o_orderkey) AS first_id FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey")(
    lambda t: t.orders.where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_id"))
)
query("a13_failure_rate", f"""
    SELECT l_suppkey, count(*) AS attempts, count(*) FILTER (l_returnflag <> 'A') AS failures,
        {pct_sql("count(*) FILTER (l_returnflag <> 'A')", 'count(*)')} AS failure_rate_pct FROM lineitem GROUP BY l_suppkey""")(
    lambda t: aggregates.failure_rate(t.lineitem, ["l_suppkey"], "l_returnflag", "A")
)
query("a14_histogram_with_amount", """
    SELECT o_orderstatus, count(*) AS n, CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END) AS BIGINT) AS urgent_amount
    FROM orders GROUP BY o_orderstatus""")(
    lambda t: t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", F.floor("o_totalprice")).otherwise(0)).cast("bigint").alias("urgent_amount"))
)
query("a15_first_event_time", "SELECT user_id, strftime(min(ts) FILTER (value >= 150), '%Y-%m-%d %H:%M:%S') AS first_high FROM events GROUP BY user_id")(
    lambda t: aggregates.first_time(t.events, ["user_id"], "ts", F.col("value") >= 150, "first_high")
    .withColumn("first_high", moments.format_ts(F.col("first_high")))
)
query("a18_group_by_json_value", "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1")(
    lambda t: t.events.groupBy(text.json_value(F.col("props"), "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))
)

# --- sort, limit, sets ----------------------------------------------------

query("o1_sort", "SELECT o_orderkey, o_orderstatus, o_custkey FROM orders ORDER BY o_orderstatus, o_custkey, o_orderkey")(
    lambda t: t.orders.select("o_orderkey", "o_orderstatus", "o_custkey").orderBy("o_orderstatus", "o_custkey", "o_orderkey")
)
query("o2_sort_by_rank", """
    SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS rank FROM orders ORDER BY rank, o_orderkey""")(
    lambda t: t.orders.select("o_orderkey", "o_orderstatus", text.rank_of(F.col("o_orderstatus"), ("P", "O")).alias("rank")).orderBy("rank", "o_orderkey")
)
query("o3_top_ten", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")(
    lambda t: ranking.top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")], 10)
)
query("o4_sort_by_time", "SELECT event_id, user_id FROM events ORDER BY ts, event_id")(
    lambda t: t.events.orderBy("ts", "event_id").select("event_id", "user_id")
)
query("u1_labelled_union", """
    SELECT c_custkey AS id, c_name AS name, 'CUSTOMER' AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, 'SUPPLIER' FROM supplier
    UNION ALL SELECT p_partkey, p_name, 'PART' FROM part""")(
    lambda t: sets.labelled_union({
        "CUSTOMER": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        "SUPPLIER": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        "PART": t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))}, "kind")
)
query("u2_union_distinct", "SELECT l_partkey AS id FROM lineitem UNION SELECT p_partkey FROM part UNION SELECT o_custkey FROM orders")(
    lambda t: sets.union_distinct([
        t.lineitem.select(F.col("l_partkey").alias("id")), t.part.select(F.col("p_partkey").alias("id")),
        t.orders.select(F.col("o_custkey").alias("id"))])
)
query("u3_symmetric_difference", """
    SELECT 'ORDERS' AS side, * FROM (SELECT o_custkey AS id, o_orderstatus AS s FROM orders EXCEPT SELECT l_suppkey, l_linestatus FROM lineitem)
    UNION ALL SELECT 'LINES', * FROM (SELECT l_suppkey, l_linestatus FROM lineitem EXCEPT SELECT o_custkey, o_orderstatus FROM orders)""")(
    lambda t: sets.symmetric_difference(
        t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("s")),
        t.lineitem.select(F.col("l_suppkey").alias("id"), F.col("l_linestatus").alias("s")), "side", "ORDERS", "LINES")
)

# --- scalar functions -----------------------------------------------------

query("f1_round", "SELECT event_id, CAST(round(CAST(value AS DECIMAL(20, 6)), 1) AS DOUBLE) AS value_1 FROM events")(
    lambda t: t.events.select("event_id", F.round(F.col("value").cast("decimal(20,6)"), 1).cast("double").alias("value_1"))
)
query("f2_round_half_even", "SELECT o_orderkey, CAST(round_even(floor(o_totalprice) / 100, 0) * 100 AS BIGINT) AS yen FROM orders")(
    lambda t: t.orders.select("o_orderkey", numeric.half_even(F.floor("o_totalprice"), 100).alias("yen"))
)
query("f3_case", """
    SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'HIGH' WHEN o_totalprice >= 100000 THEN 'MID' ELSE 'LOW' END AS band,
        CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS code FROM orders""")(
    lambda t: t.orders.select(
        "o_orderkey", F.when(F.col("o_totalprice") >= 300000, "HIGH").when(F.col("o_totalprice") >= 100000, "MID").otherwise("LOW").alias("band"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(0).alias("code"))
)
query("f4_coalesce", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")(
    lambda t: t.documents.select("doc_id").join(t.labels, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"))
)
query("f5_edge_id", "SELECT l_orderkey || '|TARGETS|' || l_partkey AS edge_id FROM lineitem")(
    lambda t: t.lineitem.select(text.edge_id(F.col("l_orderkey"), "TARGETS", F.col("l_partkey")).alias("edge_id"))
)
query("f6_number_to_text", "SELECT o_orderkey, 'TASK-' || CAST(o_orderkey AS VARCHAR) AS code FROM orders")(
    lambda t: t.orders.select("o_orderkey", F.concat(F.lit("TASK-"), F.col("o_orderkey").cast("string")).alias("code"))
)
query("f7_upper", "SELECT p_partkey, upper(p_name) AS p_name FROM part")(
    lambda t: t.part.select("p_partkey", F.upper("p_name").alias("p_name"))
)
query("f8_regexp_like", "SELECT doc_id, regexp_matches(source, '^src1[0-9]$') AS teens FROM documents")(
    lambda t: t.documents.select("doc_id", F.col("source").rlike("^src1[0-9]$").alias("teens"))
)
query("f9_base_name", "SELECT page_id, regexp_extract(url, '[^/]+$') AS file_name FROM pages")(
    lambda t: t.pages.select("page_id", F.coalesce(text.base_name(F.col("url")), F.lit("")).alias("file_name"))
)
query("f10_json_value", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")(
    lambda t: t.events.select("event_id", text.json_value(F.col("props"), "$.k").alias("k"))
)
query("f11_json_object", """
    SELECT c_custkey, CAST(to_json({'id': c_custkey, 'segment': c_mktsegment, 'note': CAST(NULL AS VARCHAR)}) AS VARCHAR) AS json FROM customer""")(
    lambda t: t.customer.select("c_custkey", text.json_object([
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.lit(None).cast("string").alias("note")]).alias("json"))
)


@query("f12_json_table", "SELECT o_custkey, o_orderkey AS id, o_orderstatus AS state FROM orders")
def f12(t: Tables):
    """Orders to JSON arrays per customer and back to rows."""
    from opslake.plans.api import json_rows

    payload = text.json_object([F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state")])
    pages = aggregates.json_pages(t.orders, "o_custkey", [F.col("o_orderkey")], payload)
    return json_rows(pages.select("o_custkey", "json"), "id: bigint, state: string")


@query("f13_json_array_length", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def f13(t: Tables):
    """Lengths of small arrays, added up per customer; no array of a whole customer is built."""
    one = F.concat(F.lit("["), text.json_object([F.col("o_orderkey").alias("id")]), F.lit("]"))
    return t.orders.groupBy("o_custkey").agg(F.sum(F.json_array_length(one)).cast("bigint").alias("n"))


query("f14_timestamp_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")(
    lambda t: t.events.select("event_id", moments.format_ts(moments.parse_ts(moments.format_ts(F.col("ts")))).alias("ts"))
)
query("f15_day_difference", "SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS days FROM orders")(
    lambda t: t.orders.select("o_orderkey", moments.days_between(F.col("o_orderdate").cast("date"), F.lit("2002-01-01").cast("date")).alias("days"))
)
query("f16_minute_difference", """
    SELECT l_orderkey, l_linenumber, date_diff('minute', o_orderdate, l_shipdate) AS minutes FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")(
    lambda t: t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", moments.minutes_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("minutes"))
)
query("f17_percent_gap", f"SELECT p_partkey, {pct_sql('CAST(floor(p_retailprice) AS BIGINT) - p_size * 10', 'CAST(floor(p_retailprice) AS BIGINT)')} AS gap_pct FROM part")(
    lambda t: t.part.select(
        "p_partkey", numeric.gap_percent(F.floor("p_retailprice").cast("bigint"), (F.col("p_size") * 10).cast("bigint")).alias("gap_pct"))
)
query("f18_date_literal", "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '2000-07-12'")(
    lambda t: t.orders.where(F.col("o_orderdate") >= F.lit(datetime.date(2000, 7, 12))).select("o_orderkey")
)
query("f19_clamp", "SELECT event_id, greatest(12.0::DOUBLE, least(96.0::DOUBLE, value)) AS value FROM events")(
    lambda t: t.events.select("event_id", numeric.clamp(F.col("value"), 12.0, 96.0).alias("value"))
)
query("f20_split_list", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")(
    lambda t: t.part.select("p_partkey", F.explode(text.pipe_list(F.regexp_replace("p_name", " ", "|"))).alias("word"))
)
query("f22_prefix", "SELECT page_id, starts_with(url, 'https://') AS secure FROM pages")(
    lambda t: t.pages.select("page_id", F.col("url").startswith("https://").alias("secure"))
)


@query("a6_distinct_in_ranges", """
    WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS first_day FROM events)
    SELECT first_day, count(DISTINCT user_id) AS distinct_values
    FROM d JOIN events ON CAST(ts AS DATE) BETWEEN first_day AND first_day + 6 GROUP BY first_day""")
def a6_ranges(t: Tables):
    """Users of the seven days from each day on, from bitmaps per day."""
    from opslake.operators.bitmaps import daily_bitmaps, distinct_in_ranges

    day = F.col("ts").cast("date")
    ranges = t.events.select(day.alias("first_day")).distinct().withColumn("last_day", F.date_add("first_day", 6)).withColumn("range_id", F.col("first_day"))
    return distinct_in_ranges(daily_bitmaps(t.events, day, "user_id"), ranges).withColumnRenamed("range_id", "first_day")
