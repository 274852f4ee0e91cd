"""Registry of the workload: each operator on the benchmark tables, with its SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


# Declared schemas, so that no file is opened to plan a query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """The benchmark tables of one directory, as attributes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        """Called once per table, then the DataFrame is kept."""
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")
        setattr(self, name, df)
        return df


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` as a query."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, path: fn(Tables(spark, path))
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def avg_sql(expr: str, digits: int, where: str = "") -> str:
    """Rounded average of a non-negative expression over exact integers, as DuckDB SQL."""
    flt = f" FILTER ({where})" if where else ""
    total = f"sum(CAST(round(({expr}) * 1000000) AS HUGEINT)){flt}"
    n = f"count({expr}){flt}"
    return (
        f"(CAST((2 * {10 ** digits} * {total} + 1000000 * {n}) // (2000000 * nullif({n}, 0)) AS DOUBLE) / {10 ** digits}.0)"
    )


def pct_sql(part: str, whole: str, digits: int = 1) -> str:
    """Percentage rounded half up over integers, as DuckDB SQL."""
    f = 10 ** digits
    return f"(CAST((2 * {100 * f} * ({part}) + ({whole})) // (2 * nullif({whole}, 0)) AS DOUBLE) / {f}.0)"
