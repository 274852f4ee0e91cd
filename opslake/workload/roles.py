"""Benchmark tables in the roles of the operations data.

Orders, their lines and the parts stand in for performances, scans, sales,
sensor readings, incidents and equipment. ``Roles`` gives the Spark side and
``ROLE_SQL`` the same relations for the SQL checks. A season (year) plays the
part of a festival day. A manufacturing lot is a serial batch of one brand, so
its size does not grow with the data.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.plans import kg, scope, views
from opslake.workload.registry import Tables
from opslake.workload.shared import shared_dir

FIXED_PLACES = ("LOC-901", "LOC-902")
YEARS = tuple(str(y) for y in range(1995, 2002))


def _txt(prefix: str, col):
    return F.concat(F.lit(prefix), col.cast("string"))


def _year(col):
    return F.year(col).cast("string")


def _ts(col):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def _case(col, mapping: dict, default):
    expr = F.lit(default)
    for k, v in reversed(list(mapping.items())):
        expr = F.when(col == k, F.lit(v)).otherwise(expr)
    return expr


class Roles:
    def __init__(self, t: Tables):
        self.t = t

    # masters
    @cached_property
    def stages(self) -> DataFrame:
        return self.t.nation.where("n_regionkey <> 4").select(
            _txt("LOC-", F.col("n_nationkey")).alias("stage_id"), F.col("n_name").alias("stage_name"),
            _txt("REGION-", F.col("n_regionkey")).alias("stage_type"), (F.col("n_nationkey") + 1000).cast("bigint").alias("capacity"),
            _txt("Z", F.col("n_regionkey")).alias("location_zone"), _txt("NET-", F.col("n_regionkey")).alias("network_zone"),
            (F.col("n_regionkey") == 0).cast("int").alias("weather_exposed_flag"),
        )

    @cached_property
    def equipment(self) -> DataFrame:
        key = F.col("p_partkey")
        lot = F.when(F.col("p_size") == 1, None).otherwise(
            F.concat("p_brand", F.lit("-"), F.floor(key / 500).cast("bigint").cast("string"))
        )
        return self.t.part.select(
            _txt("PART-", key).alias("equipment_id"), _txt("LOC-", key % 25).alias("stage_id"),
            F.col("p_type").alias("equipment_category"), F.col("p_name").alias("model_name"),
            _txt("SN-", key).alias("serial_number"), lot.alias("manufacturing_lot"), _txt("VND-", key % 8).alias("vendor_id"),
            _txt("1.", F.col("p_size")).alias("firmware_version"), _txt("Y", F.col("p_size")).alias("installed_date"),
            F.when(F.col("p_size") >= 40, "CRITICAL").otherwise("HIGH").alias("criticality"),
        )

    @cached_property
    def lot_patch(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.t.part.where("p_size = 50").select(
            _txt("PART-", key).alias("equipment_id"),
            F.concat("p_brand", F.lit("-P"), F.floor(key / 12500).cast("bigint").cast("string")).alias("manufacturing_lot"),
            F.lit("SYNTHETIC_DEMO").alias("source_type"), _txt("PATCH-", F.col("p_brand")).alias("source_reference_id"),
            F.when(F.col("p_type") == "PROMO", "PROVISIONAL").otherwise("SYNTHETIC").alias("assertion_status"),
            F.lit("2001-01-01").alias("effective_date"), F.lit(None).cast("string").alias("note"),
        )

    @cached_property
    def documents(self) -> DataFrame:
        d = F.col("doc_id")
        return self.t.documents.select(
            _txt("DOC-", d).alias("document_id"),
            F.concat("source", F.lit("/"), d.cast("string"), F.lit(".txt")).alias("file_name"),
            F.col("lang").alias("document_type"), _txt("v", d % 3).alias("version"),
            F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (d % 365).cast("int")), "yyyy-MM-dd").alias("effective_date"),
            F.col("source").alias("purpose"),
        )

    @cached_property
    def _linked(self):
        """Links go to so many document numbers: all documents, and a tenth more that do not exist."""
        n = F.floor(F.count(F.lit(1)) * 11 / 10).cast("bigint")
        return self.t.documents.agg(F.greatest(n, F.lit(1).cast("bigint"))).scalar()

    # facts
    @cached_property
    def incidents(self) -> DataFrame:
        price, key = F.col("o_totalprice"), F.col("o_orderkey")
        hit = self.t.lineitem.where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.min("l_partkey").alias("_part"))
        return (
            self.t.orders.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
            .join(self.t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
            .join(hit, key == F.col("l_orderkey"), "left")
            .select(
                _txt("INC-", key).alias("incident_id"), _year(F.col("o_orderdate")).alias("festival_date"),
                _txt("LOC-", F.col("c_nationkey")).alias("location_id"), F.col("c_mktsegment").alias("category"),
                F.when(price >= 400000, "CRITICAL").when(price >= 250000, "HIGH").when(price >= 100000, "MEDIUM").otherwise("LOW").alias("severity"),
                _ts(F.col("o_orderdate")).alias("start_ts"), _ts(F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).alias("end_ts"),
                _txt("Order ", key).alias("title"), F.floor(price / 1000).cast("bigint").alias("impacted_people"),
                _txt("PART-", F.col("_part")).alias("related_equipment_id"), F.lit("CLOSED").alias("status"),
                F.when(key % 7 == 0, None).otherwise(_txt("DOC-", key % self._linked)).alias("document_id"),
                _txt("status ", F.col("o_orderstatus")).alias("summary"),
            )
        )

    @cached_property
    def _task_lines(self) -> DataFrame:
        return (
            self.t.lineitem.where("l_returnflag = 'R'")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(
                F.min("l_partkey").alias("_part"), F.max("l_linestatus").alias("_ls"), F.sum("l_quantity").alias("_q"),
                F.min("l_shipdate").alias("_ship"),
            )
            .withColumn("task_id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
        )

    @cached_property
    def tasks(self) -> DataFrame:
        return self._task_lines.select(
            "task_id", _txt("INC-", F.col("l_orderkey")).alias("incident_id"), _txt("Replace PART-", F.col("_part")).alias("task_title"),
            F.lit(None).cast("string").alias("task_description"),
            _case(F.col("l_linenumber"), {1: "CRITICAL", 2: "HIGH", 3: "MEDIUM", 4: "LOW"}, "ROUTINE").alias("priority"),
            _txt("TEAM-", F.col("l_orderkey") % 5).alias("owner_team_id"), _txt("AGENT-", F.col("l_orderkey") % 3).alias("created_by_agent"),
            _ts(F.col("_ship")).alias("created_at"),
            F.when(F.col("_ls") == "O", "OPEN").when(F.col("_q") >= 40, "IN_PROGRESS").otherwise("CLOSED").alias("status"),
        )

    @cached_property
    def task_equipment(self) -> DataFrame:
        return self._task_lines.select(
            "task_id", _txt("PART-", F.col("_part")).alias("equipment_id"), F.lit("SYNTHETIC_DEMO").alias("source_type"),
            _txt("TE-", F.col("l_linenumber")).alias("source_reference_id"),
        )

    @cached_property
    def task_document(self) -> DataFrame:
        return self._task_lines.select(
            "task_id", _txt("DOC-", (F.col("l_orderkey") + F.col("l_linenumber")) % self._linked).alias("document_id"),
            F.lit("SYNTHETIC_DEMO").alias("source_type"), _txt("TD-", F.col("l_linenumber")).alias("source_reference_id"),
        )

    @cached_property
    def lot_document(self) -> DataFrame:
        brand = F.substring("p_brand", 7, 10).cast("bigint")
        batch = F.floor(F.col("p_partkey") / 500).cast("bigint")
        return self.t.part.where("p_size <> 1").select(
            F.concat("p_brand", F.lit("-"), batch.cast("string")).alias("manufacturing_lot"),
            _txt("DOC-", (brand * 37 + batch) % self._linked).alias("document_id"),
            F.when(brand % 2 == 0, "SERVICE_BULLETIN").otherwise("OPERATING_PROCEDURE").alias("relation_type"),
            F.lit("SYNTHETIC_DEMO").alias("source_type"), _txt("LOTDOC-", brand).alias("source_reference_id"),
        ).distinct()

    @cached_property
    def sensors(self) -> DataFrame:
        q, line = F.col("l_quantity"), F.col("l_linenumber")
        raw = self.t.lineitem.select(
            _year(F.col("l_shipdate")).alias("festival_date"), _txt("LOC-", F.col("l_partkey") % 25).alias("stage_id"),
            _txt("PART-", F.col("l_partkey")).alias("equipment_id"),
            _case(line, {1: "temperature_c", 2: "packet_loss_pct", 3: "fan_rpm"}, "audio_dropouts_count").alias("metric_name"),
            F.when(line == 1, q * 2).when(line == 2, q / 8).when(line == 3, q * 50).otherwise(F.floor(q / 10)).cast("double").alias("metric_value"),
        )
        from opslake.plans.rules import classify

        return classify(raw)

    @cached_property
    def maintenance(self) -> DataFrame:
        return self.t.lineitem.where("l_returnflag = 'A'").select(
            _txt("PART-", F.col("l_partkey")).alias("equipment_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("scheduled_date"),
            F.when(F.col("l_linestatus") == "F", "OVERDUE").otherwise("COMPLETED").alias("status"),
        )

    @cached_property
    def schedule(self) -> DataFrame:
        return self.t.orders.select(
            F.col("o_orderkey").alias("performance_id"), _year(F.col("o_orderdate")).alias("festival_date"),
            _txt("LOC-", F.col("o_custkey") % 25).alias("stage_id"), F.col("o_orderpriority").alias("artist_name"),
            _ts(F.col("o_orderdate")).alias("planned_start_ts"),
        )

    @cached_property
    def actual(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("performance_id"), _ts(F.col("l_shipdate")).alias("actual_start_ts"),
            F.col("l_quantity").cast("bigint").alias("delay_minutes"),
            F.when(flag == "R", "ENDED_EARLY").when((flag == "N") & (F.col("l_linestatus") == "F"), "CANCELED").otherwise("COMPLETED").alias("status"),
            F.when(flag == "R", _txt("INC-", F.col("l_orderkey"))).alias("incident_id"),
        )

    @cached_property
    def delays(self) -> DataFrame:
        return views.stage_delay(self.schedule, self.actual, self.stages)

    @cached_property
    def scans(self) -> DataFrame:
        return self.t.lineitem.select(
            F.col("l_shipdate").alias("event_ts"), _year(F.col("l_shipdate")).alias("festival_date"),
            _txt("GATE-", F.col("l_linenumber")).alias("gate_id"), _txt("T", F.col("l_orderkey")).alias("ticket_id"),
            _case(F.col("l_returnflag"), {"A": "SUCCESS", "N": "QR_TIMEOUT"}, "DEVICE_OFFLINE").alias("result_code"),
            F.floor(F.col("l_extendedprice") / 100).cast("bigint").alias("scan_duration_ms"),
            F.col("l_quantity").cast("bigint").alias("queue_estimate_minutes"),
        )

    TICKET_TYPES = {"1-URGENT": "DAY3", "2-HIGH": "THREE_DAY", "3-MEDIUM": "VIP_THREE_DAY", "4-NOT SPECIFIED": "DAY2"}

    @cached_property
    def tickets(self) -> DataFrame:
        return self.t.orders.select(
            _txt("T", F.col("o_orderkey")).alias("ticket_id"), self._parent.alias("parent_ticket_id"),
            _case(F.col("o_orderpriority"), self.TICKET_TYPES, "MG_PREMIUM").alias("ticket_type_id"),
            F.floor("o_totalprice").cast("bigint").alias("amount_jpy"),
        )

    @property
    def _parent(self):
        key = F.col("o_orderkey")
        return F.when(F.col("o_orderpriority") == "5-LOW", _txt("T", key - 1)).when(key % 2 == 0, F.lit(""))

    @cached_property
    def requests(self) -> DataFrame:
        return self.t.orders.select(
            _txt("RFD-", F.col("o_orderkey")).alias("request_id"), _txt("T", F.col("o_orderkey")).alias("ticket_id"),
            self._parent.alias("parent_ticket_id"), _txt("C", F.col("o_custkey")).alias("attendee_id"),
            _case(F.col("o_orderstatus"), {"F": "WEATHER_CANCELLATION", "O": "PERSONAL_REASON"}, "TRANSPORT_DELAY").alias("reason_code"),
            F.floor(F.col("o_totalprice") / 2).cast("bigint").alias("requested_amount_jpy"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))

    @cached_property
    def plan(self) -> DataFrame:
        size = F.col("p_size").cast("bigint")
        return self.t.part.select(
            F.col("p_partkey").alias("product_id"), F.explode(F.array(*[F.lit(y) for y in YEARS])).alias("festival_date"),
            (size * 8).alias("baseline_forecast_units"), (size * 12).alias("interest_adjusted_forecast_units"),
            (size * 10).alias("planned_stock_units"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        return self.t.lineitem.select(
            F.col("l_partkey").alias("product_id"), _year(F.col("l_shipdate")).alias("festival_date"),
            F.col("l_shipdate").alias("sale_ts"), F.col("l_quantity").cast("bigint").alias("quantity"),
        )

    @property
    def sources(self) -> "Roles":
        """The roles carry the names of the graph sources; each is made when first used."""
        return self

    @cached_property
    def graph(self):
        return kg.build_graph(self.sources)

    @cached_property
    def scope(self) -> DataFrame:
        seen = self.t.customer.select(_txt("LOC-", F.col("c_nationkey")).alias("location_id"))
        return scope.location_scope(self.stages, seen, "location_id", FIXED_PLACES)

    @cached_property
    def audit(self) -> DataFrame:
        s = self.sources
        return scope.scope_audit(s.incidents, s.equipment, s.tasks, self.scope)

    # time series
    @cached_property
    def readings(self) -> DataFrame:
        v, kind = F.col("value"), F.col("event_type")
        return self.t.events.select(
            F.col("event_id").alias("sensor_event_id"), F.col("ts").alias("event_ts"), F.col("user_id").alias("equipment_id"),
            _case(kind, {"error": "packet_loss_pct", "view": "temperature_c", "click": "fan_rpm", "purchase": "audio_dropouts_count"}, "other").alias("metric_name"),
            F.when(kind == "error", v / 8).when(kind == "click", v * 32).when(kind == "purchase", v / 16).otherwise(v).alias("metric_value"),
        )

    @cached_property
    def gate_events(self) -> DataFrame:
        return self.t.events.select(
            F.col("ts").alias("event_ts"), F.col("event_type").alias("gate_id"),
            F.when(F.col("value") < 100, "SUCCESS").otherwise("QR_TIMEOUT").alias("result_code"),
            F.get_json_object("props", "$.k").cast("bigint").alias("queue_estimate_minutes"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        v = F.col("value")
        return self.t.events.select(
            F.col("event_id").alias("weather_event_id"), F.col("ts").alias("observed_ts"),
            F.date_format("ts", "yyyy-MM-dd").alias("festival_date"), _txt("WX-", F.col("user_id") % 3).alias("station_id"),
            v.alias("lightning_distance_km"), (F.get_json_object("props", "$.k").cast("double") / 8).alias("wind_gust_mps"),
            (v / 64).alias("rainfall_mm_15m"),
        )


def saved_graph(r: Roles):
    """The graph over node views that are written once to the shared folder."""
    return kg.build_graph(r, kg.Nodes(r).saved(r.t.spark, shared_dir(r.t.spark)))


ROLE_SQL: dict[str, str] = {
    "stages": """SELECT 'LOC-' || n_nationkey AS stage_id, n_name AS stage_name, 'REGION-' || n_regionkey AS stage_type,
        CAST(n_nationkey + 1000 AS BIGINT) AS capacity, 'Z' || n_regionkey AS location_zone, 'NET-' || n_regionkey AS network_zone,
        CAST(n_regionkey = 0 AS INTEGER) AS weather_exposed_flag FROM nation WHERE n_regionkey <> 4""",
    "equipment": """SELECT 'PART-' || p_partkey AS equipment_id, 'LOC-' || (p_partkey % 25) AS stage_id, p_type AS equipment_category,
        p_name AS model_name, 'SN-' || p_partkey AS serial_number,
        CASE WHEN p_size = 1 THEN NULL ELSE p_brand || '-' || (p_partkey // 500) END AS manufacturing_lot,
        'VND-' || (p_partkey % 8) AS vendor_id, '1.' || p_size AS firmware_version, 'Y' || p_size AS installed_date,
        CASE WHEN p_size >= 40 THEN 'CRITICAL' ELSE 'HIGH' END AS criticality FROM part""",
    "lot_patch": """SELECT 'PART-' || p_partkey AS equipment_id, p_brand || '-P' || (p_partkey // 12500) AS manufacturing_lot,
        'SYNTHETIC_DEMO' AS source_type, 'PATCH-' || p_brand AS source_reference_id,
        CASE WHEN p_type = 'PROMO' THEN 'PROVISIONAL' ELSE 'SYNTHETIC' END AS assertion_status,
        '2001-01-01' AS effective_date FROM part WHERE p_size = 50""",
    "docs": """SELECT 'DOC-' || doc_id AS document_id, source || '/' || doc_id || '.txt' AS file_name, lang AS document_type,
        'v' || (doc_id % 3) AS version, strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') AS effective_date,
        source AS purpose FROM documents""",
    "incidents": """SELECT 'INC-' || o_orderkey AS incident_id, strftime(o_orderdate, '%Y') AS festival_date,
        'LOC-' || c_nationkey AS location_id, c_mktsegment AS category,
        CASE WHEN o_totalprice >= 400000 THEN 'CRITICAL' WHEN o_totalprice >= 250000 THEN 'HIGH'
             WHEN o_totalprice >= 100000 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS start_ts, strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS end_ts,
        'Order ' || o_orderkey AS title, CAST(floor(o_totalprice / 1000) AS BIGINT) AS impacted_people,
        'PART-' || part_hit AS related_equipment_id, 'CLOSED' AS status,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'DOC-' || (o_orderkey % (SELECT greatest(count(*) * 11 // 10, 1) FROM documents)) END AS document_id,
        'status ' || o_orderstatus AS summary
        FROM orders JOIN customer ON o_custkey = c_custkey
        LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS part_hit FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) h
          ON h.l_orderkey = o_orderkey
        WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    "task_lines": """SELECT l_orderkey, l_linenumber, min(l_partkey) AS part_hit, max(l_linestatus) AS ls, sum(l_quantity) AS q,
        min(l_shipdate) AS ship, l_orderkey * 8 + l_linenumber AS task_id
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber""",
    "tasks": """SELECT task_id, 'INC-' || l_orderkey AS incident_id, 'Replace PART-' || part_hit AS task_title,
        CAST(NULL AS VARCHAR) AS task_description,
        CASE l_linenumber WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'MEDIUM' WHEN 4 THEN 'LOW' ELSE 'ROUTINE' END AS priority,
        'TEAM-' || (l_orderkey % 5) AS owner_team_id, 'AGENT-' || (l_orderkey % 3) AS created_by_agent,
        strftime(ship, '%Y-%m-%d %H:%M:%S') AS created_at,
        CASE WHEN ls = 'O' THEN 'OPEN' WHEN q >= 40 THEN 'IN_PROGRESS' ELSE 'CLOSED' END AS status FROM task_lines""",
    "task_equipment": """SELECT task_id, 'PART-' || part_hit AS equipment_id, 'SYNTHETIC_DEMO' AS source_type,
        'TE-' || l_linenumber AS source_reference_id FROM task_lines""",
    "task_document": """SELECT task_id, 'DOC-' || ((l_orderkey + l_linenumber) % (SELECT greatest(count(*) * 11 // 10, 1) FROM documents)) AS document_id, 'SYNTHETIC_DEMO' AS source_type,
        'TD-' || l_linenumber AS source_reference_id FROM task_lines""",
    "lot_document": """SELECT DISTINCT p_brand || '-' || (p_partkey // 500) AS manufacturing_lot,
        'DOC-' || ((CAST(substr(p_brand, 7) AS BIGINT) * 37 + p_partkey // 500) % (SELECT greatest(count(*) * 11 // 10, 1) FROM documents)) AS document_id,
        CASE WHEN CAST(substr(p_brand, 7) AS BIGINT) % 2 = 0 THEN 'SERVICE_BULLETIN' ELSE 'OPERATING_PROCEDURE' END AS relation_type,
        'SYNTHETIC_DEMO' AS source_type, 'LOTDOC-' || CAST(substr(p_brand, 7) AS BIGINT) AS source_reference_id
        FROM part WHERE p_size <> 1""",
    "sensors": """SELECT *, CASE WHEN metric_name = 'temperature_c' AND metric_value >= 75 THEN 'CRITICAL'
          WHEN metric_name = 'packet_loss_pct' AND metric_value >= 5 THEN 'CRITICAL'
          WHEN metric_name = 'fan_rpm' AND metric_value < 1000 THEN 'CRITICAL'
          WHEN metric_name = 'audio_dropouts_count' AND metric_value >= 3 THEN 'WARNING' ELSE 'NORMAL' END AS status
        FROM (SELECT strftime(l_shipdate, '%Y') AS festival_date, 'LOC-' || (l_partkey % 25) AS stage_id, 'PART-' || l_partkey AS equipment_id,
          CASE l_linenumber WHEN 1 THEN 'temperature_c' WHEN 2 THEN 'packet_loss_pct' WHEN 3 THEN 'fan_rpm' ELSE 'audio_dropouts_count' END AS metric_name,
          CAST(CASE l_linenumber WHEN 1 THEN l_quantity * 2 WHEN 2 THEN l_quantity / 8 WHEN 3 THEN l_quantity * 50 ELSE floor(l_quantity / 10) END AS DOUBLE) AS metric_value
          FROM lineitem)""",
    "maintenance": """SELECT 'PART-' || l_partkey AS equipment_id, strftime(l_shipdate, '%Y-%m-%d') AS scheduled_date,
        CASE WHEN l_linestatus = 'F' THEN 'OVERDUE' ELSE 'COMPLETED' END AS status FROM lineitem WHERE l_returnflag = 'A'""",
    "schedule": """SELECT o_orderkey AS performance_id, strftime(o_orderdate, '%Y') AS festival_date, 'LOC-' || (o_custkey % 25) AS stage_id,
        o_orderpriority AS artist_name, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS planned_start_ts FROM orders""",
    "actual": """SELECT l_orderkey AS performance_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS actual_start_ts,
        CAST(l_quantity AS BIGINT) AS delay_minutes,
        CASE WHEN l_returnflag = 'R' THEN 'ENDED_EARLY' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'CANCELED' ELSE 'COMPLETED' END AS status,
        CASE WHEN l_returnflag = 'R' THEN 'INC-' || l_orderkey END AS incident_id FROM lineitem""",
    "delays": """SELECT s.festival_date, s.stage_id, st.stage_name, s.performance_id, s.artist_name, s.planned_start_ts, a.actual_start_ts,
        a.delay_minutes, a.status, a.incident_id
        FROM schedule s JOIN actual a ON a.performance_id = s.performance_id LEFT JOIN stages st ON st.stage_id = s.stage_id""",
    "scans": """SELECT l_shipdate AS event_ts, strftime(l_shipdate, '%Y') AS festival_date, 'GATE-' || l_linenumber AS gate_id,
        'T' || l_orderkey AS ticket_id,
        CASE l_returnflag WHEN 'A' THEN 'SUCCESS' WHEN 'N' THEN 'QR_TIMEOUT' ELSE 'DEVICE_OFFLINE' END AS result_code,
        CAST(floor(l_extendedprice / 100) AS BIGINT) AS scan_duration_ms, CAST(l_quantity AS BIGINT) AS queue_estimate_minutes FROM lineitem""",
    "tickets": """SELECT 'T' || o_orderkey AS ticket_id,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'T' || (o_orderkey - 1) WHEN o_orderkey % 2 = 0 THEN '' END AS parent_ticket_id,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'DAY3' WHEN '2-HIGH' THEN 'THREE_DAY' WHEN '3-MEDIUM' THEN 'VIP_THREE_DAY'
          WHEN '4-NOT SPECIFIED' THEN 'DAY2' ELSE 'MG_PREMIUM' END AS ticket_type_id,
        CAST(floor(o_totalprice) AS BIGINT) AS amount_jpy FROM orders""",
    "requests": """SELECT 'RFD-' || o_orderkey AS request_id, 'T' || o_orderkey AS ticket_id,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'T' || (o_orderkey - 1) WHEN o_orderkey % 2 = 0 THEN '' END AS parent_ticket_id,
        'C' || o_custkey AS attendee_id,
        CASE o_orderstatus WHEN 'F' THEN 'WEATHER_CANCELLATION' WHEN 'O' THEN 'PERSONAL_REASON' ELSE 'TRANSPORT_DELAY' END AS reason_code,
        CAST(floor(o_totalprice / 2) AS BIGINT) AS requested_amount_jpy FROM orders""",
    "products": "SELECT p_partkey AS product_id, p_name AS product_name FROM part",
    "plan": """SELECT p_partkey AS product_id, CAST(y AS VARCHAR) AS festival_date, CAST(p_size AS BIGINT) * 8 AS baseline_forecast_units,
        CAST(p_size AS BIGINT) * 12 AS interest_adjusted_forecast_units, CAST(p_size AS BIGINT) * 10 AS planned_stock_units
        FROM part, range(1995, 2002) g(y)""",
    "sales": """SELECT l_partkey AS product_id, strftime(l_shipdate, '%Y') AS festival_date, l_shipdate AS sale_ts,
        CAST(l_quantity AS BIGINT) AS quantity FROM lineitem""",
    "scope": """SELECT stage_id AS location_id, 'IN_SCOPE' AS scope_status FROM stages UNION ALL
        SELECT location_id, 'OUT_OF_SCOPE' FROM (SELECT 'LOC-' || c_nationkey AS location_id FROM customer WHERE c_nationkey IS NOT NULL
          UNION SELECT 'LOC-901' UNION SELECT 'LOC-902') x
        WHERE location_id NOT IN (SELECT stage_id FROM stages)""",
    "audit": """SELECT 'INCIDENT' AS entity_type, i.incident_id AS entity_id, i.location_id, coalesce(s.scope_status, 'UNKNOWN_OR_MISSING') AS scope_status
        FROM incidents i LEFT JOIN scope s USING (location_id) UNION ALL
        SELECT 'EQUIPMENT', e.equipment_id, e.stage_id, coalesce(s.scope_status, 'UNKNOWN_OR_MISSING')
        FROM equipment e LEFT JOIN scope s ON s.location_id = e.stage_id UNION ALL
        SELECT 'TASK', CAST(t.task_id AS VARCHAR), i.location_id, coalesce(s.scope_status, 'UNKNOWN_OR_MISSING')
        FROM tasks t LEFT JOIN incidents i ON i.incident_id = t.incident_id LEFT JOIN scope s ON s.location_id = i.location_id""",
    "readings": """SELECT event_id AS sensor_event_id, ts AS event_ts, user_id AS equipment_id,
        CASE event_type WHEN 'error' THEN 'packet_loss_pct' WHEN 'view' THEN 'temperature_c' WHEN 'click' THEN 'fan_rpm'
          WHEN 'purchase' THEN 'audio_dropouts_count' ELSE 'other' END AS metric_name,
        CASE event_type WHEN 'error' THEN value / 8 WHEN 'click' THEN value * 32 WHEN 'purchase' THEN value / 16 ELSE value END AS metric_value FROM events""",
    "gate_events": """SELECT ts AS event_ts, event_type AS gate_id, CASE WHEN value < 100 THEN 'SUCCESS' ELSE 'QR_TIMEOUT' END AS result_code,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS queue_estimate_minutes FROM events""",
    "weather": """SELECT event_id AS weather_event_id, ts AS observed_ts, strftime(ts, '%Y-%m-%d') AS festival_date, 'WX-' || (user_id % 3) AS station_id,
        value AS lightning_distance_km, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 8 AS wind_gust_mps, value / 64 AS rainfall_mm_15m FROM events""",
    # graph
    "kg_incidents": "SELECT i.* FROM incidents i WHERE i.location_id IN (SELECT stage_id FROM stages)",
    "kg_equipment": """SELECT e.* REPLACE (coalesce(p.manufacturing_lot, e.manufacturing_lot) AS manufacturing_lot),
        CASE WHEN p.equipment_id IS NULL THEN 'MASTER_CSV' ELSE p.source_type END AS lot_source,
        CASE WHEN p.equipment_id IS NULL THEN 'SOURCE_RECORD' ELSE p.assertion_status END AS lot_assertion_status,
        CASE WHEN p.equipment_id IS NULL THEN 'equipment_master.csv#' || e.equipment_id ELSE p.source_reference_id END AS lot_source_reference_id
        FROM equipment e LEFT JOIN (SELECT * FROM lot_patch WHERE assertion_status = 'SYNTHETIC') p ON p.equipment_id = e.equipment_id
        WHERE e.stage_id IN (SELECT stage_id FROM stages)""",
    "kg_lots": "SELECT DISTINCT manufacturing_lot FROM kg_equipment WHERE manufacturing_lot IS NOT NULL",
    "kg_tasks": "SELECT t.*, 'TASK-' || t.task_id AS task_code FROM tasks t WHERE t.incident_id IN (SELECT incident_id FROM kg_incidents)",
    "e_affects": """SELECT incident_id || '|AFFECTS|' || related_equipment_id AS edge_id, incident_id, related_equipment_id AS equipment_id
        FROM kg_incidents WHERE related_equipment_id IN (SELECT equipment_id FROM kg_equipment)""",
    "e_lot": """SELECT equipment_id || '|LOT|' || manufacturing_lot AS edge_id, equipment_id, manufacturing_lot, lot_source, lot_assertion_status,
        lot_source_reference_id FROM kg_equipment WHERE manufacturing_lot IS NOT NULL""",
    "e_stage": "SELECT equipment_id || '|STAGE|' || stage_id AS edge_id, equipment_id, stage_id FROM kg_equipment",
    "e_doc": """SELECT incident_id || '|DOC|' || document_id AS edge_id, incident_id, document_id FROM kg_incidents
        WHERE document_id IN (SELECT document_id FROM docs)""",
    "e_task": "SELECT incident_id || '|TASK|' || task_id AS edge_id, incident_id, task_id FROM kg_tasks",
    "e_targets": """SELECT task_id || '|TARGETS|' || equipment_id AS edge_id, m.* FROM task_equipment m
        WHERE task_id IN (SELECT task_id FROM kg_tasks) AND equipment_id IN (SELECT equipment_id FROM kg_equipment)""",
    "e_uses": """SELECT task_id || '|USES|' || document_id AS edge_id, m.* FROM task_document m
        WHERE task_id IN (SELECT task_id FROM kg_tasks) AND document_id IN (SELECT document_id FROM docs)""",
    "e_governed": """SELECT manufacturing_lot || '|DOC|' || document_id AS edge_id, m.* FROM lot_document m
        WHERE manufacturing_lot IN (SELECT manufacturing_lot FROM kg_lots) AND document_id IN (SELECT document_id FROM docs)""",
    "impact": """SELECT i.incident_id, e1.equipment_id AS affected_equipment_id, b1.manufacturing_lot, e2.equipment_id AS related_equipment_id,
        s.stage_id AS related_stage_id, s.stage_name AS related_stage_name, b2.lot_source, b2.lot_assertion_status, b2.lot_source_reference_id,
        b1.lot_source AS affected_lot_source, b1.lot_assertion_status AS affected_lot_assertion_status,
        b1.lot_source_reference_id AS affected_lot_source_reference_id
        FROM kg_incidents i JOIN e_affects a ON a.incident_id = i.incident_id JOIN kg_equipment e1 ON e1.equipment_id = a.equipment_id
        JOIN e_lot b1 ON b1.equipment_id = e1.equipment_id JOIN kg_lots l ON l.manufacturing_lot = b1.manufacturing_lot
        JOIN e_lot b2 ON b2.manufacturing_lot = l.manufacturing_lot JOIN kg_equipment e2 ON e2.equipment_id = b2.equipment_id
        JOIN e_stage d ON d.equipment_id = e2.equipment_id JOIN stages s ON s.stage_id = d.stage_id
        WHERE e1.equipment_id <> e2.equipment_id""",
    "open_tasks": """SELECT i.incident_id, t.task_id, t.task_code, t.priority, t.status AS task_status, e.equipment_id, s.stage_id, s.stage_name,
        t.created_by_agent, x.source_type, x.source_reference_id
        FROM kg_incidents i JOIN e_task c ON c.incident_id = i.incident_id JOIN kg_tasks t ON t.task_id = c.task_id
        JOIN e_targets x ON x.task_id = t.task_id JOIN kg_equipment e ON e.equipment_id = x.equipment_id
        JOIN e_stage d ON d.equipment_id = e.equipment_id JOIN stages s ON s.stage_id = d.stage_id
        WHERE t.status IN ('OPEN', 'IN_PROGRESS')""",
    "related_documents": """SELECT d.document_id, d.file_name, d.document_type, d.version AS document_version, d.effective_date, i.incident_id,
        CAST(NULL AS VARCHAR) AS equipment_id, CAST(NULL AS VARCHAR) AS manufacturing_lot, CAST(NULL AS BIGINT) AS task_id,
        CAST(NULL AS VARCHAR) AS task_created_by_agent, 'INCIDENT_REPORT' AS relation_type, 'DOCUMENTED_BY' AS path,
        'INCIDENT_CSV' AS source_type, 'incidents.csv#' || i.incident_id AS source_reference_id,
        CAST(NULL AS VARCHAR) AS lot_source, CAST(NULL AS VARCHAR) AS lot_source_reference_id
        FROM kg_incidents i JOIN e_doc r ON r.incident_id = i.incident_id JOIN docs d ON d.document_id = r.document_id
        UNION ALL SELECT d.document_id, d.file_name, d.document_type, d.version, d.effective_date, a.incident_id, b.equipment_id,
        b.manufacturing_lot, NULL, NULL, g.relation_type, 'AFFECTS>BELONGS_TO_LOT>GOVERNED_BY', g.source_type, g.source_reference_id,
        b.lot_source, b.lot_source_reference_id
        FROM e_affects a JOIN e_lot b ON b.equipment_id = a.equipment_id JOIN e_governed g ON g.manufacturing_lot = b.manufacturing_lot
        JOIN docs d ON d.document_id = g.document_id
        UNION ALL SELECT d.document_id, d.file_name, d.document_type, d.version, d.effective_date, c.incident_id, NULL, NULL, t.task_id,
        t.created_by_agent, 'TASK_PROCEDURE', 'CREATES>USES_PROCEDURE', u.source_type, u.source_reference_id, NULL, NULL
        FROM e_task c JOIN kg_tasks t ON t.task_id = c.task_id JOIN e_uses u ON u.task_id = t.task_id
        JOIN docs d ON d.document_id = u.document_id WHERE t.status IN ('OPEN', 'IN_PROGRESS')""",
}


def with_roles(body: str, **extra: str) -> str:
    """A SQL statement preceded by the roles it uses, in dependency order."""
    import re

    known = ROLE_SQL | extra
    needed: dict[str, str] = {}

    def visit(text: str, path: tuple[str, ...]) -> None:
        for name in known:
            if name not in needed and name not in path and re.search(rf"(FROM|JOIN|,)\s+{name}\b(?!\.)", text):
                visit(known[name], (*path, name))
                needed[name] = known[name]

    visit(body, ())
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in needed.items()) + "\n" + body
