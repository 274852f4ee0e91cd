"""Rule operators: refunds, admission, sensor states, inventory, ticket validity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.functions.numeric import half_even
from opslake.functions.text import pipe_list
from opslake.operators.series import running_grid
from opslake.plans.views import SUCCESS, admission_key

# Refund policy.
WEATHER = "WEATHER_CANCELLATION"
ADDON = "MG_PREMIUM"
REFUND_SHARE = {"DAY3": 0.15, "THREE_DAY": 0.05, "VIP_THREE_DAY": 0.05}
REFUND_UNIT = 100
APPROVED, MANUAL_REVIEW, DENIED = "APPROVED", "MANUAL_REVIEW", "DENIED"
RATIONALE = {
    "addon": "add-on refunded in full, headliner cancelled",
    "day": "admitted on the day, outdoor program stopped for over 90 minutes",
    "pass": "multi-day pass, admitted on the day",
    "manual": "no admission record, check by hand",
    "denied": "reason not covered",
}

# Sensor limits, as (metric, comparison, limit, status).
SENSOR_LIMITS = (
    ("temperature_c", ">=", 75.0, "CRITICAL"),
    ("packet_loss_pct", ">=", 5.0, "CRITICAL"),
    ("fan_rpm", "<", 1000.0, "CRITICAL"),
    ("audio_dropouts_count", ">=", 3.0, "WARNING"),
)

# A shelf is low at or below 10 units or 10 % of its stock.
LOW_UNITS, LOW_SHARE = 10, 0.1


def admissions(scans: DataFrame) -> DataFrame:
    """Last successful scan per ticket and day."""
    return (
        scans.where(F.col("result_code") == SUCCESS)
        .groupBy("ticket_id", "festival_date")
        .agg(F.max("event_ts").alias("admitted_ts"))
    )


def refund_decisions(requests: DataFrame, tickets: DataFrame, scans: DataFrame, day: str, cutoff) -> DataFrame:
    """Decision, amount and reason for each request.

    The first rule that applies decides. A holder who was let in at or after
    ``cutoff`` is denied; only one without any admission goes to manual review.
    """
    let_in = (
        admissions(scans.where(F.col("festival_date") == day))
        .select(F.col("ticket_id").alias("_gate_ticket"), "admitted_ts")
    )
    sold = tickets.select("ticket_id", "ticket_type_id", "amount_jpy")
    asked = requests.select("request_id", "ticket_id", "parent_ticket_id", "reason_code").join(sold, "ticket_id")
    base_key = F.when(F.col("ticket_type_id") == ADDON, admission_key()).otherwise(F.col("ticket_id"))
    rows = asked.withColumn("_gate_key", base_key).join(let_in, F.col("_gate_key") == F.col("_gate_ticket"), "left")

    kind = F.col("ticket_type_id")
    in_time = F.coalesce(F.col("admitted_ts") < F.lit(cutoff), F.lit(False))
    share = F.lit(None).cast("double")
    for ticket_type, value in REFUND_SHARE.items():
        share = F.when(kind == ticket_type, F.lit(value)).otherwise(share)
    rule = (
        F.when(F.coalesce(F.col("reason_code"), F.lit("")) != WEATHER, "denied")
        .when(kind == ADDON, "addon")
        .when((kind == "DAY3") & in_time, "day")
        .when(kind.isin("THREE_DAY", "VIP_THREE_DAY") & in_time, "pass")
        .when(F.col("admitted_ts").isNull(), "manual")
        .otherwise("denied")
    )
    amount = F.col("amount_jpy")
    refund = (
        F.when(F.col("_rule") == "addon", amount.cast("bigint"))
        .when(F.col("_rule").isin("day", "pass"), half_even(amount * share, REFUND_UNIT))
        .otherwise(F.lit(0).cast("bigint"))
    )
    decision = (
        F.when(F.col("_rule").isin("addon", "day", "pass"), APPROVED)
        .when(F.col("_rule") == "manual", MANUAL_REVIEW)
        .otherwise(DENIED)
    )
    reason = F.lit(RATIONALE["denied"])
    for name, text in RATIONALE.items():
        reason = F.when(F.col("_rule") == name, text).otherwise(reason)
    return rows.withColumn("_rule", rule).select(
        "request_id", "ticket_id", "ticket_type_id",
        F.col("admitted_ts").isNotNull().cast("int").alias("day3_admitted_flag"),
        decision.alias("decision"), refund.alias("refund_amount_jpy"), reason.alias("rationale"),
    )


def classify(sensors: DataFrame, limits: Sequence[tuple[str, str, float, str]] = SENSOR_LIMITS, column: str = "status") -> DataFrame:
    """Sensor state by metric limits; the first limit that is met decides. Works on a stream too."""
    tests = {">=": lambda v, x: v >= x, ">": lambda v, x: v > x, "<": lambda v, x: v < x, "<=": lambda v, x: v <= x}
    state: Column = F.lit("NORMAL")
    for metric, op, limit, status in reversed(list(limits)):
        met = (F.col("metric_name") == metric) & tests[op](F.col("metric_value"), F.lit(limit))
        state = F.when(met, status).otherwise(state)
    return sensors.withColumn(column, state)


def inventory_snapshots(
    stock: DataFrame, sales: DataFrame, start: Column, step_minutes: int = 30, marks: int = 27
) -> DataFrame:
    """Stock per product, day and mark: sold so far, on hand and state.

    ``stock`` has (product_id, festival_date, initial_stock).
    """
    grid = running_grid(stock, sales, ["product_id", "festival_date"], start, "sale_ts", "quantity", step_minutes, marks)
    initial = F.col("initial_stock")
    on_hand = F.greatest(initial - F.col("sold"), F.lit(0))
    low = F.greatest(F.lit(LOW_UNITS), F.floor(initial * LOW_SHARE))
    state = (
        F.when(F.col("on_hand_units") == 0, "OUT_OF_STOCK").when(F.col("on_hand_units") <= low, "LOW").otherwise("NORMAL")
    )
    return grid.withColumn("on_hand_units", on_hand.cast("bigint")).select(
        "product_id", "festival_date", F.col("mark_ts").alias("snapshot_ts"), "initial_stock",
        F.least(initial, F.col("sold")).cast("bigint").alias("units_sold"), "on_hand_units", state.alias("stock_status"),
    )


def initial_stock(products: DataFrame, days: Mapping[str, str]) -> DataFrame:
    """Product columns ``initial_stock_dayN`` as rows (product_id, festival_date, initial_stock).

    ``days`` maps a stock column to its day.
    """
    pairs = F.array(*[
        F.struct(F.lit(day).alias("festival_date"), F.col(column).alias("initial_stock")) for column, day in days.items()
    ])
    return products.select("product_id", F.inline(pairs))


def valid_dates(tickets: DataFrame, types: DataFrame) -> DataFrame:
    """(ticket_id, valid_date): one row per day a ticket admits; types without days give none."""
    days = types.select("ticket_type_id", F.explode(pipe_list(F.col("valid_days"))).alias("valid_date"))
    return tickets.select("ticket_id", "ticket_type_id").join(days, "ticket_type_id").select("ticket_id", "valid_date")


def failed_scans(scans: DataFrame) -> DataFrame:
    """Every scan that did not succeed."""
    return scans.where(F.coalesce(F.col("result_code"), F.lit("")) != SUCCESS)
