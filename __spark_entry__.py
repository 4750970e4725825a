"""Registered queries: every operator over the sample tables, with the SQL each must equal."""

from __future__ import annotations

import importlib.util
import sys
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries  # noqa: E402
from prevascope.config import DEFAULT_CONFIG as CFG  # noqa: E402
from prevascope.config import INCOMPLETE, RATE_CANDIDATES, SMALL, VALID  # noqa: E402
from prevascope.operators import contracts, filters, mart, profile, quality, ranking, reporting, reshape  # noqa: E402
from prevascope.operators.current import merge_batch as merge_into_current  # noqa: E402
from prevascope.operators.dedupe import latest_per_entity as keep_latest  # noqa: E402
from prevascope.operators.distinct_index import DistinctIndex  # noqa: E402
from prevascope.operators.groups import GroupShape  # noqa: E402
from prevascope.operators.numbering import numbered_by_sort  # noqa: E402
from prevascope.operators.order_index import POSITION, build_order_index  # noqa: E402
from prevascope.plans.layers import CREATED, UPDATED, Layers, build_models, check_versions, load_directory  # noqa: E402
from prevascope.plans.staging import stage  # noqa: E402
from prevascope.session import materialise, scratch_path  # noqa: E402
from prevascope.sources import footers, landing, raw_table, reports  # noqa: E402
from prevascope.streaming.ingest import ingest_new_files, load_frame, quality_report_of_loads  # noqa: E402
from sample_tables import entity_measures, loads_of_events, raw_entities, table  # noqa: E402

# the text operators are optional: the rest works without their folder and the pipeline file
HAS_LLM = importlib.util.find_spec("prevascope.llm") is not None
HAS_PIPELINE = HAS_LLM and importlib.util.find_spec("corpus_pipeline") is not None
if HAS_LLM:
    from prevascope.llm import queries as text_queries  # noqa: E402
if HAS_PIPELINE:
    import corpus_pipeline  # noqa: E402

SMOKE_FOLDER = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]


def _as_of():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


# --- ranking, profile, scorecard -------------------------------------------------------------


def entity_mart(spark, folder):
    staged = materialise(entity_measures(spark, folder), "staged")
    return mart.entity_mart(staged)


def entity_mart_sorted(spark, folder):
    staged = materialise(entity_measures(spark, folder), "staged")
    return mart.entity_mart(staged, method=ranking.SORTED)


def group_profile(spark, folder):
    return profile.group_profile(materialise(entity_measures(spark, folder), "staged"))


def entity_ranking(spark, folder):
    return ranking.entity_ranking(entity_measures(spark, folder))


def entity_ranking_sorted(spark, folder):
    return ranking.entity_ranking(entity_measures(spark, folder), method=ranking.SORTED)


def group_deviation(spark, folder):
    return ranking.group_deviation(materialise(entity_measures(spark, folder), "staged")).select(
        "state_code",
        "county_fips",
        *[f"state_avg_{m.short}" for m in CFG.ranked],
        *[f"{m.short}_deviation_from_state_avg" for m in CFG.ranked],
    )


def group_median(spark, folder):
    names = {m.column: f"median_{m.short}" for m in CFG.watched}
    return profile.group_medians(entity_measures(spark, folder), "state_code", names)


def group_median_wide_type(spark, folder):
    """The same medians from measures of a type with too many values to count each."""
    names = {m.column: f"median_{m.short}" for m in CFG.watched}
    wide = entity_measures(spark, folder).select(
        "state_code", *[F.col(c).cast("decimal(12,2)").alias(c) for c in names]
    )
    medians = profile.group_medians(wide, "state_code", names)
    return medians.select("state_code", *[F.col(c).cast("decimal(5,2)").alias(c) for c in names.values()])


def group_median_bracketed(spark, folder):
    """Medians of doubles in few large groups, without sorting them."""
    names = {"l_quantity": "median_quantity", "l_extendedprice": "median_price"}
    return profile.group_medians(table(spark, folder, "lineitem"), "l_returnflag", names, method=profile.BRACKETED)


def distinct_by_load(spark, folder):
    """Customers per priority, counted as the orders of each year come in; and in the last two years."""
    orders = table(spark, folder, "orders").select("o_orderpriority", "o_custkey", F.year("o_orderdate").alias("year"))
    index = DistinctIndex(spark, scratch_path(spark, "distinct"), "o_custkey", ("o_orderpriority",))
    years = sorted(r.year for r in orders.select("year").distinct().collect())
    for year in years:
        index.add(orders.where(F.col("year") == year), str(year))
    recent = index.counts("recent_customers", [str(y) for y in years[-2:]])
    return index.counts("customers").join(recent, "o_orderpriority", "left")


def group_profile_by_load(spark, folder):
    """The profile with entities counted load by load; the second load repeats some of the first."""
    staged = materialise(entity_measures(spark, folder), "staged")
    index = DistinctIndex(spark, scratch_path(spark, "distinct"), CFG.entity_key, tuple(CFG.group_cols))
    even = F.col(CFG.entity_key).cast("long") % 2 == 0
    index.add(staged.where(even), "first")
    index.add(staged.where(~even | (F.col(CFG.entity_key).cast("long") % 3 == 0)), "second")
    return profile.group_profile(staged, entity_totals=index.counts(f"num_{CFG.entity_plural}"))


def _ranks(df):
    return df.select(*CFG.keys, *[f"{m.short}_rank" for m in CFG.ranked])


def rank_in_group(spark, folder):
    return _ranks(ranking.rank_in_group(entity_measures(spark, folder)))


def rank_in_group_sorted(spark, folder):
    return _ranks(ranking.rank_in_group(entity_measures(spark, folder), method=ranking.SORTED))


def count_at_or_above_median(spark, folder):
    return profile.count_at_or_above_median(materialise(entity_measures(spark, folder), "staged"))


def left_join_context(spark, folder):
    staged = materialise(entity_measures(spark, folder), "staged")
    shape = GroupShape.of(staged, CFG.group_cols)
    keys = staged.select("state_code", "county_fips")
    return mart.left_join_context(keys, profile.group_profile(staged, shape=shape), profiles=shape.profiles)


def threshold_flags(spark, folder):
    return entity_mart(spark, folder).select("county_fips", "flag_high_diabetes", "flag_high_obesity")


def burden_score(spark, folder):
    return ranking.group_deviation(materialise(entity_measures(spark, folder), "staged")).select(
        "county_fips", mart.burden_score().alias("health_burden_score")
    )


def quality_status(spark, folder):
    return entity_measures(spark, folder).select("county_fips", mart.quality_status().alias("data_quality_status"))


def mart_ordered(spark, folder):
    shown = ["state_code", "county_fips", "health_burden_score"]
    slim = materialise(entity_mart(spark, folder).select(*shown, "county_name", "diabetes_rank"), "mart")
    return numbered_by_sort(slim, [], mart.mart_order(), "position", keep=shown)


def mart_ordered_top(spark, folder):
    return entity_mart(spark, folder).orderBy(*mart.mart_order()).limit(50)


# --- staging and reshape ---------------------------------------------------------------------


def staging(spark, folder):
    staged = stage(raw_entities(spark, folder))
    return staged.drop("data_loaded_timestamp", "source_filename", "extracted_at", "source", "dataset_id")


def unpivot_measures(spark, folder):
    return reshape.unpivot_measures(entity_measures(spark, folder), CFG.keys)


def state_filter(spark, folder):
    return filters.state_filter(entity_measures(spark, folder), ["NATION_3", "NATION_7", "NATION_11"])


def measure_filter(spark, folder):
    return reshape.measure_filter(unpivot_measures(spark, folder), ["Diabetes", "Obesity"])


# --- sources and sinks -----------------------------------------------------------------------


def json_roundtrip(spark, folder):
    customers = table(spark, folder, "customer")
    path = landing.write_extract(customers, scratch_path(spark, "landing"), datetime(2024, 2, 1, 6))
    return landing.read_landing(spark, path, customers.schema, landing.LINES).records.drop("source_file")


def json_dir_scan(spark, folder):
    """Two matching extracts and one that does not match, read as one directory."""
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"),
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
    )
    directory = scratch_path(spark, "landing")
    landing.write_extract(suppliers, directory, datetime(2024, 2, 1, 6))
    landing.write_extract(customers, directory, datetime(2024, 2, 2, 6))
    landing.write_extract(customers, directory, datetime(2024, 2, 3, 6), prefix="other")
    landed = landing.read_landing_directory(spark, directory, suppliers.schema, landing.LINES)
    return landed.records.drop("source_file")


def _as_parties(spark, folder):
    """Suppliers, customers and regions with the same columns."""
    shape = {"supplier": "s", "customer": "c"}
    parties = {
        name: table(spark, folder, name).select(
            F.col(f"{p}_{key}").alias("id"), F.col(f"{p}_name").alias("name"),
            F.col(f"{p}_nationkey").alias("nation"), F.col(f"{p}_acctbal").alias("balance"),
        )
        for (name, p), key in zip(shape.items(), ["suppkey", "custkey"])
    }
    none = F.lit(None)
    region = table(spark, folder, "region")
    parties["region"] = region.select(
        F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"),
        none.cast("int").alias("nation"), none.cast("double").alias("balance"),
    )
    return parties


def _documents(df, per_file, wrap="%s"):
    """A JSON list over several lines for each ``per_file`` ids."""
    page = F.floor(F.col("id") / per_file)
    rows = df.groupBy(page.alias("page")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    lines = F.replace(F.col("value"), F.lit("},{"), F.lit("},\n{"))
    return rows.select("page", F.format_string(wrap, lines).alias("value"))


def _write_values(df, path):
    df.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


def json_document_scan(spark, folder):
    """A folder with lists, envelopes, single records and an extract of JSON lines, read without being told which."""
    parties, directory = _as_parties(spark, folder), scratch_path(spark, "landing")
    _write_values(_documents(parties["customer"], 500), f"{directory}/places_lists.json")
    _write_values(_documents(parties["supplier"], 50, '{"meta": 1,\n"data": %s}'), f"{directory}/places_envelopes.json")
    single = F.replace(F.to_json(F.struct(*parties["region"].columns)), F.lit(","), F.lit(",\n"))
    _write_values(parties["region"].select(single.alias("value")), f"{directory}/places_records.json")
    landing.write_extract(parties["supplier"], directory, datetime(2024, 2, 1, 6))
    return landing.read_landing_directory(spark, directory, parties["customer"].schema).records.drop("source_file")


def landing_quarantine(spark, folder):
    """Of the suppliers' documents every second one is cut short."""
    suppliers, directory = _as_parties(spark, folder)["supplier"], scratch_path(spark, "landing")
    documents = _documents(suppliers, 10)
    cut = F.when(F.col("page") % 2 == 1, F.expr("left(value, length(value) - 3)")).otherwise(F.col("value"))
    _write_values(documents.select(cut.alias("value")), f"{directory}/places_documents.json")
    landed = landing.read_landing_directory(spark, directory, suppliers.schema)
    return raw_table.record_counts({"records": landed.records, "quarantine": landed.quarantine})


def ingest_once(spark, folder):
    """Two loads of one folder, then one more after a new file has come."""
    parties, directory = _as_parties(spark, folder), scratch_path(spark, "landing")
    where = Layers(raw=f"raw_{uuid.uuid4().hex}.parties")
    schema = parties["customer"].schema
    landing.write_extract(parties["customer"], directory, datetime(2024, 2, 1, 6))
    for _ in range(2):
        load_directory(spark, directory, where, schema=schema)
    landing.write_extract(parties["supplier"], directory, datetime(2024, 2, 2, 6))
    load_directory(spark, directory, where, schema=schema)
    return spark.table(where.raw).select(*schema.names)


def ingest_after_lost_checkpoint(spark, folder):
    """A stream loads the customers, its checkpoint is lost, and the suppliers land: all of both, each once."""
    parties, directory = _as_parties(spark, folder), scratch_path(spark, "landing")
    name = f"raw_{uuid.uuid4().hex}.parties"
    raw_table.ensure_namespace(spark, name.split(".")[0])
    schema = parties["customer"].schema
    for day, party in enumerate(["customer", "supplier"], 1):
        landing.write_extract(parties[party], directory, datetime(2024, 2, day, 6))
        for _ in range(2):
            state = scratch_path(spark, "checkpoint")
            ingest_new_files(spark, directory, name, state, schema, landing.LINES).awaitTermination()
    spark.catalog.refreshTable(name)
    return spark.table(name).select(*schema.names)


def append_loads(spark, folder):
    """The same table appended twice, the second time with its columns in another order and one more."""
    customers = table(spark, folder, "customer")
    first = customers.withColumn("load_no", F.lit(1))
    second = customers.withColumn("load_no", F.lit(2)).select("load_no", *reversed(customers.columns))
    name = f"raw_{uuid.uuid4().hex}.customer"
    raw_table.ensure_namespace(spark, name.split(".")[0])
    for load in (first, second.withColumn("added", F.lit("x"))):
        raw_table.append_by_name(load, name)
    balance = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance")
    return spark.table(name).groupBy("load_no").agg(F.count(F.lit(1)).alias("records"), balance, F.count("added").alias("added"))


def _layers_from_raw(spark, folder):
    """Names of layers of their own, the raw one loaded with the sample entities."""
    tag = uuid.uuid4().hex
    where = Layers(
        raw=f"raw_{tag}.entities", staging=f"staging_{tag}.entities", long=f"long_{tag}",
        ranking=f"mid_{tag}.ranking", profile=f"mid_{tag}.profile", mart=f"mart_{tag}.scorecard",
    )
    raw_table.ensure_namespace(spark, f"raw_{tag}")
    loaded = landing.with_load_provenance(raw_entities(spark, folder).withColumn("source_file", F.lit("sample")))
    raw_table.append_by_name(loaded, where.raw)
    return where


def layer_tables(spark, folder):
    """All layers built as tables from the raw one; the scorecard as written, without its audit columns."""
    where = _layers_from_raw(spark, folder)
    build_models(spark, where)
    return spark.table(where.mart).drop(CREATED, UPDATED)


def layer_rebuild(spark, folder):
    """The scorecard of a first build, read after a second one over a raw table with other rows."""
    where = _layers_from_raw(spark, folder)
    first = build_models(spark, where)["mart"]
    again = spark.table(where.raw).withColumns({"diabetes_crudeprev": F.lit("1.0"), "loaded_at": F.current_timestamp()})
    raw_table.append_by_name(materialise(again, "second-load"), where.raw)
    build_models(spark, where)
    return first.drop(CREATED, UPDATED)


def layer_audit(spark, folder):
    """Of each written layer its rows, those with the run's timestamp, and how many different ones there are."""
    where = _layers_from_raw(spark, folder)
    models = build_models(spark, where)
    stamped = [
        models[name].agg(
            F.count(F.lit(1)).alias("records"), F.count(CREATED).alias("stamped"), F.count_distinct(CREATED).alias("stamps")
        ).select(F.lit(name).alias("model"), "records", "stamped", "stamps")
        for name in ("staging", "ranking", "profile", "mart")
    ]
    return stamped[0].unionByName(stamped[1]).unionByName(stamped[2]).unionByName(stamped[3])


def layer_contracts(spark, folder):
    """Rows that break the contracts of the layers, counted while these are written."""
    where = _layers_from_raw(spark, folder)
    build_models(spark, where)
    return check_versions(spark, where)


def _stored(df, *columns):
    """Columns of a written model with the place each row has in the files."""
    return df.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))


def ranking_stored_order(spark, folder):
    """Rows of the stored ranking, and those that stand before a row of their file that they should follow."""
    ranking = build_models(spark, _layers_from_raw(spark, folder))["ranking"]
    before = Window.partitionBy("file").orderBy("at")  # a file is what one task has written
    keys = F.struct("state_code", "county_name")
    placed = _stored(ranking, "state_code", "county_name").withColumn("misplaced", (F.lag(keys).over(before) > keys).cast("bigint"))
    return placed.agg(F.count(F.lit(1)).alias("records"), F.coalesce(F.sum("misplaced"), F.lit(0)).alias("misplaced"))


def profile_stored_order(spark, folder):
    """Groups in the order in which the stored profile's files hold them."""
    profiles = build_models(spark, _layers_from_raw(spark, folder))["profile"]
    return numbered_by_sort(_stored(profiles, "state_code"), [], [F.col("file"), F.col("at")], "position", keep=["state_code"])


def quality_gate(spark, folder):
    """What the gate says of the events at two times, one shortly after the last and one long after; empty where it opens."""
    events = loads_of_events(spark, folder).where("stateabbr is not null")
    last = events.agg(F.max("loaded_at").alias("last")).first()["last"]
    said = []
    for hours in (1, 24 * 365):
        report = quality.quality_report(events, F.lit(last + timedelta(hours=hours)))
        try:
            quality.assert_quality(report)
            said.append((hours, ""))
        except quality.QualityGateError as error:
            said.append((hours, str(error)))
    return spark.createDataFrame(said, "hours int, refusal string")


def list_tables(spark, folder):
    """Tables of two namespaces of the catalog, with their records by name, one of them missing."""
    tag = uuid.uuid4().hex
    for name in ("nation", "region"):
        raw_table.ensure_namespace(spark, f"{name}_{tag}")
        raw_table.append_by_name(table(spark, folder, name), f"{name}_{tag}.{name}")
    found = raw_table.list_tables(spark, [f"nation_{tag}", f"region_{tag}"])
    counted = raw_table.table_counts(spark, [*found, f"region_{tag}.absent"])
    return counted.withColumn("table_name", F.replace("table_name", F.lit(f"_{tag}"), F.lit("")))


def merge_batch(spark, folder):
    """Three loads merged into a current table: customers, those with a negative balance restated, and some from a late old file."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    stamped = lambda df, day, name: df.withColumns(
        {"loaded_at": F.lit(day).cast("timestamp"), "source_file": F.lit(name)}
    )
    raw_table.ensure_namespace(spark, space := f"current_{uuid.uuid4().hex}")
    merge_into_current(stamped(customers, "2024-02-01", "first"), f"{space}.customer", "c_custkey", buckets=16)
    zero = customers.where("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    merge_into_current(stamped(zero, "2024-02-02", "second"), f"{space}.customer", "c_custkey")
    late = customers.where("c_custkey % 100 = 0").withColumn("c_acctbal", F.lit(-1.0))
    merged = merge_into_current(stamped(late, "2024-01-31", "late"), f"{space}.customer", "c_custkey")
    return merged.drop("loaded_at")


def latest_per_entity(spark, folder):
    """A second load restates the customers with a negative balance."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    first = customers.withColumns(
        {"loaded_at": F.lit("2024-02-01").cast("timestamp"), "source_file": F.lit("first")}
    )
    second = customers.where("c_acctbal < 0").withColumns(
        {
            "c_acctbal": F.lit(0.0),
            "loaded_at": F.lit("2024-02-02").cast("timestamp"),
            "source_file": F.lit("second"),
        }
    )
    return keep_latest(raw_table.combine_loads([first, second]), "c_custkey").drop("loaded_at")


def provenance(spark, folder):
    read = table(spark, folder, "customer").select("c_custkey", F.col("_metadata.file_name").alias("source_file"))
    extracted = landing.with_extract_provenance(read, F.lit("2024-02-01 05:00:00").cast("timestamp_ntz"))
    return landing.with_load_provenance(extracted, F.lit("2024-02-01 06:00:00").cast("timestamp_ntz"))


def page_of_table(spark, folder):
    return filters.page_of_table(table(spark, folder, "orders"), ["o_orderkey"], offset=100, limit=50)


def _with_position(page):
    """Rows of a bounded result with their place in it, as it is returned."""
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return page.withColumn("position", place.cast("bigint"))


def page_of_table_deep(spark, folder):
    orders = table(spark, folder, "orders")
    return _with_position(filters.page_of_table(orders, ["o_orderkey"], offset=10_000, limit=500, shallow_end=1_000))


def page_by_index(spark, folder):
    """Two pages of an order index: one from the middle, one over the end."""
    index = build_order_index(table(spark, folder, "orders"), ["o_orderkey"], scratch_path(spark, "index"), rows_per_file=2_000)
    return index.page(10_000, 500).unionByName(index.page(index.count() - 100, 500))


def latest_by_index(spark, folder):
    index = build_order_index(table(spark, folder, "events"), ["ts", "event_id"], scratch_path(spark, "index"), rows_per_file=2_000)
    return index.last(1_000)


def pages_by_cursor(spark, folder):
    """Five pages of suppliers, each from the last key of the one before."""
    suppliers = table(spark, folder, "supplier")
    index = build_order_index(suppliers, ["s_nationkey", "s_suppkey"], scratch_path(spark, "index"), rows_per_file=10)
    pages, key = None, None
    for number in range(5):
        page = index.after(key, 7).withColumn("page", F.lit(number))
        pages = page if pages is None else pages.unionByName(page)
        last = page.orderBy(F.desc(POSITION)).first()
        if last is None:
            break
        key = last.asDict()
    return pages


def year_filter(spark, folder):
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    return filters.year_filter(orders, 1995)


# --- quality and contracts -------------------------------------------------------------------


def _tables(spark, folder):
    return {name: table(spark, folder, name) for name in oracle_queries.TABLES}


def record_counts(spark, folder):
    return raw_table.record_counts(_tables(spark, folder))


def record_counts_of_files(spark, folder):
    return footers.record_counts_of_files(spark, {name: f"{folder}/{name}.parquet" for name in _tables(spark, folder)})


def freshness_of_files(spark, folder):
    bounds = footers.file_bounds(spark, f"{folder}/events.parquet", ["ts"], uniform=True)
    return quality.freshness(bounds.select(F.col("max_ts").alias("ts")), "ts", _as_of())


def table_counts(spark, folder):
    return raw_table.table_counts(spark, {**_tables(spark, folder), "absent": None})


def freshness(spark, folder):
    return quality.freshness(table(spark, folder, "events"), "ts", _as_of())


def date_range(spark, folder):
    return quality.date_range(table(spark, folder, "events"), "ts", _as_of())


def null_counts(spark, folder):
    columns = ["state_code", "county_name", "pct_diabetes", "pct_obesity", "pct_current_smoker"]
    return quality.null_counts(entity_measures(spark, folder), {c: f"null_{c}" for c in columns})


def dq_report(spark, folder):
    return quality.quality_report(loads_of_events(spark, folder), _as_of())


def dq_report_by_load(spark, folder):
    """Events loaded in three batches and a part that comes past the ledger; the report reads the notes of the batches."""
    name = f"raw_{uuid.uuid4().hex}.events"
    raw_table.ensure_namespace(spark, name.split(".")[0])
    part = F.pmod(F.xxhash64("loaded_at", "countyname", "diabetes_crudeprev"), F.lit(4))
    events = loads_of_events(spark, folder).withColumn("part", part)
    for number in range(3):
        load_frame(events.where(F.col("part") == number).drop("part"), name)
    raw_table.append_by_name(events.where("part = 3").drop("part"), name)
    return quality_report_of_loads(spark, name, as_of=_as_of())


def dq_summary(spark, folder):
    return quality.dq_summary(dq_report(spark, folder))


def dq_report_flat(spark, folder):
    path = scratch_path(spark, "report")
    reports.save_report(reports.nest_report(dq_report(spark, folder), "2024-01-31T00:00:00"), path)
    return reports.report_checks(reports.read_report(spark, path))


def contract_not_null(spark, folder):
    rules = [contracts.NotNull(c) for c in ["state_code", "county_name", "pct_diabetes"]]
    return contracts.contract_failures(entity_measures(spark, folder), "staging", rules)


def contract_accepted_values(spark, folder):
    labelled = quality_status(spark, folder)
    return contracts.contract_report(
        {"orders": table(spark, folder, "orders"), "mart": labelled},
        {
            "orders": (contracts.AcceptedValues("o_orderstatus", ("F", "O")),),
            "mart": (contracts.AcceptedValues("data_quality_status", (VALID, INCOMPLETE, SMALL)),),
        },
    )


# --- reporting -------------------------------------------------------------------------------


def top_groups_by_metric(spark, folder):
    return reporting.top_groups(entity_measures(spark, folder))


def top_groups_by_count(spark, folder):
    return reporting.top_groups(entity_measures(spark, folder).drop("total_population"))


def metric_totals(spark, folder):
    return reporting.metric_totals(table(spark, folder, "events"), "value")


def metric_fallback(spark, folder):
    events = table(spark, folder, "events").withColumnRenamed("value", "total_cases")
    rates = table(spark, folder, "orders").withColumnRenamed("o_totalprice", RATE_CANDIDATES[1])
    return reporting.headline_figures(events, rates)


def source_fallback(spark, folder):
    """A missing table, an empty one, then one with rows."""
    return reporting.first_available(
        [
            lambda: spark.read.parquet(f"{folder}/absent.parquet"),
            lambda: table(spark, folder, "customer").where("c_custkey < 0"),
            lambda: table(spark, folder, "customer"),
        ]
    )


def latest_value(spark, folder):
    return reporting.latest_value(table(spark, folder, "events"), "ts", "value", "event_id", "event_type")


def recent_rows(spark, folder):
    return _with_position(filters.recent_rows(table(spark, folder, "events"), "ts", ["event_id"]))


def report_top_groups(spark, folder):
    """A missing table, an empty one, then the entities: the 1,000 with the largest key, their groups by population."""
    entities = entity_measures(spark, folder)
    sources = [lambda: spark.table("no_such_table"), lambda: entities.where("county_fips = ''"), lambda: entities]
    return reporting.report_top_groups(sources, "county_fips", ["county_fips"], limit=1_000)


def recent_rows_sample(spark, folder):
    return filters.recent_rows(table(spark, folder, "events"), "ts", ["event_id"], limit=10)


def series_by_date(spark, folder):
    return reporting.series_by_date(table(spark, folder, "events"), "ts", "value", ["event_id"])


def series_positions(spark, folder):
    """The series of one user with the place of each point, as it is returned."""
    events = table(spark, folder, "events").where("user_id = 7")
    return _with_position(reporting.series_by_date(events, "ts", "value", ["event_id"]))


# --- driver interface ------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """The scorecard on the smallest sample."""
    return entity_mart(spark, SMOKE_FOLDER)


def queries() -> dict[str, Query]:
    """Registered queries by name."""
    registered = [
        entity_mart, entity_mart_sorted, group_profile, entity_ranking, entity_ranking_sorted, group_deviation,
        group_median, group_median_wide_type, group_median_bracketed, distinct_by_load, group_profile_by_load, rank_in_group, rank_in_group_sorted, count_at_or_above_median,
        left_join_context, threshold_flags, burden_score, quality_status, mart_ordered, mart_ordered_top,
        staging, unpivot_measures, state_filter, measure_filter,
        json_roundtrip, json_dir_scan, json_document_scan, landing_quarantine, ingest_once,
        ingest_after_lost_checkpoint, append_loads, layer_tables, layer_rebuild, layer_audit, layer_contracts,
        ranking_stored_order, profile_stored_order, quality_gate, list_tables, merge_batch, year_filter,
        page_by_index, latest_by_index, pages_by_cursor, series_positions,
        report_top_groups, latest_per_entity, provenance, page_of_table, page_of_table_deep,
        record_counts, record_counts_of_files, table_counts, freshness, freshness_of_files, date_range, null_counts, dq_report, dq_report_by_load, dq_summary, dq_report_flat,
        contract_not_null, contract_accepted_values,
        top_groups_by_metric, top_groups_by_count, metric_totals, metric_fallback, source_fallback, latest_value,
        recent_rows, recent_rows_sample, series_by_date,
    ]
    named = {query.__name__: query for query in registered}
    if HAS_LLM:
        named |= text_queries.queries()
    if HAS_PIPELINE:
        named["pipeline"] = corpus_pipeline.run
    return named


def oracle_sql() -> dict[str, str]:
    """The SQL each registered query must equal."""
    sql = oracle_queries.oracle_sql()
    if HAS_LLM:
        sql |= text_queries.oracle_sql()
    if HAS_PIPELINE and corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
