"""The sample tables in the roles the operators expect.

group = nation, group label = region, entity = customer, measures = shares of the customer's
orders in percent (null when there are none), load time = event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prevascope.config import KEY_COLUMNS, MEASURE_COLUMNS, POPULATION_COLUMNS

#: measure -> (order column, value counted)
SHARES = {
    "pct_uninsured": ("o_orderpriority", "5-LOW"),
    "pct_diabetes": ("o_orderstatus", "F"),
    "pct_current_smoker": ("o_orderstatus", "P"),
    "pct_obesity": ("o_orderpriority", "1-URGENT"),
    "pct_arthritis": ("o_orderpriority", "2-HIGH"),
    "pct_heart_disease": ("o_orderpriority", "3-MEDIUM"),
    "pct_stroke": ("o_orderpriority", "4-NOT SPECIFIED"),
}


#: declared, so that opening a table runs no job to infer its schema
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def entity_measures(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with the keys, population and seven measures of a county."""
    shares = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            *[
                F.sum(F.when(F.col(column) == value, 1).otherwise(0)).alias(f"n_{measure}")
                for measure, (column, value) in SHARES.items()
            ],
        )
    )

    def percent(measure: str):
        counted = F.col(f"n_{measure}")
        # uninsured keeps its zeros, the other measures are unknown without a single order
        counted = counted if measure == "pct_uninsured" else F.nullif(counted, F.lit(0))
        return (F.lit(100.0) * counted / F.col("orders")).cast("decimal(5,2)").alias(measure)

    population = F.when(F.col("c_acctbal") < 0, 0).otherwise(F.floor(F.col("c_acctbal") * 10)).cast("int")
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(shares, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            F.col("n_name").alias("state_code"),
            F.col("r_name").alias("state_name"),
            F.col("c_name").alias("county_name"),
            F.col("c_custkey").cast("string").alias("county_fips"),
            population.alias("total_population"),
            *[percent(m) for m in SHARES],
        )
    )


def raw_entities(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`entity_measures` as it would land: all text, a missing measure as an empty string."""
    staged = entity_measures(spark, folder)
    measures = {raw: out for raw, out in MEASURE_COLUMNS.items() if out in staged.columns}
    absent = [raw for raw in MEASURE_COLUMNS if raw not in measures]
    population = F.col("total_population").cast("string")
    return staged.select(
        *[F.col(out).alias(raw) for raw, out in KEY_COLUMNS.items()],
        *[population.alias(raw) for raw in POPULATION_COLUMNS],
        *[F.coalesce(F.col(out).cast("string"), F.lit("")).alias(raw) for raw, out in measures.items()],
        *[F.lit(None).cast("string").alias(raw) for raw in absent],
    )


def loads_of_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a raw table with load times, for the quality checks."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("stateabbr"),
        F.col("user_id").cast("string").alias("countyname"),
        F.when(F.col("event_type") == "error", "").otherwise(F.col("value").cast("string")).alias(
            "diabetes_crudeprev"
        ),
        F.col("ts").cast("timestamp").alias("loaded_at"),
    )
