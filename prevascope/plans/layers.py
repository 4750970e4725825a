"""The full run: landing files to raw table to layered models to checks."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prevascope.config import DEFAULT_CONFIG, LONG_LABELS, PrevalenceConfig
from prevascope.functions.casts import BLANK_NULL
from prevascope.operators.contracts import MODEL_RULES, contract_failures, contract_report, noted_failures
from prevascope.operators.groups import GroupShape
from prevascope.operators.mart import ALLOW, ERROR, assert_one_profile_per_group, mart_order, scorecard
from prevascope.operators.profile import group_profile
from prevascope.operators.quality import assert_quality
from prevascope.operators.ranking import AUTO, entity_ranking
from prevascope.operators.reshape import unpivot_measures
from prevascope.plans.publish import KEEP, counting, new_run, note_counts, noted_counts, version_of, versions, write_version
from prevascope.plans.publish import MARK as VERSION_MARK
from prevascope.plans.publish import publish as switch_views
from prevascope.plans.staging import stage
from prevascope.session import scratch_scope
from prevascope.sources.landing import AUTO as ANY_LAYOUT
from prevascope.sources.landing import LANDING_SCHEMA, landing_files, read_landing_directory, with_load_provenance
from prevascope.sources.raw_table import append_by_name, ensure_namespace, quarantine_of
from prevascope.sources.reports import nest_report, save_report
from prevascope.streaming.ingest import ensure_tables, load_files, quality_report_of_loads

CREATED, UPDATED = "dbt_created_at", "dbt_updated_at"


class ContractError(RuntimeError):
    """Rows of a model break a column contract."""


@dataclass(frozen=True)
class Layers:
    """Where each model goes."""

    raw: str = "raw.places_county"
    staging: str = "analytics_staging.entity_measures"
    #: a temporary view, hence without namespace
    long: str = "entity_measures_long"
    ranking: str = "analytics_intermediate.entity_ranking"
    profile: str = "analytics_intermediate.group_profile"
    mart: str = "analytics_marts.entity_scorecard"

    def namespaces(self) -> list[str]:
        tables = [self.raw, self.staging, self.ranking, self.profile, self.mart]
        return sorted({name.rsplit(".", 1)[0] for name in tables})


def with_audit(df: DataFrame, *columns: str) -> DataFrame:
    """Add the run's timestamp under each given name."""
    return df.withColumns({c: F.current_timestamp() for c in columns})


def load_directory(
    spark: SparkSession,
    directory: str,
    layers: Layers = Layers(),
    layout: str = ANY_LAYOUT,
    schema: StructType = LANDING_SCHEMA,
    once: bool = True,
) -> DataFrame:
    """Append the records of files not loaded before to the raw table; returns the quarantine table.

    With ``once=False`` all files of the directory are appended again, as an append-only run would.

    ``schema`` may name more of the landed columns than staging reads. Which files are loaded is in a ledger beside the raw table
    (:mod:`prevascope.streaming.ingest`). A directory that is missing or has no matching file loads nothing. Loaded and
    quarantined values together are all that landed.
    """
    ensure_namespace(spark, layers.raw.rsplit(".", 1)[0])
    ensure_tables(spark, layers.raw, schema)
    if not once:
        landed = read_landing_directory(spark, directory, schema, layout)
        append_by_name(with_load_provenance(landed.records), layers.raw)
        append_by_name(with_load_provenance(landed.quarantine), quarantine_of(layers.raw))
    elif (files := landing_files(spark, directory)) is not None:
        load_files(files, layers.raw, schema, layout)
    return spark.table(quarantine_of(layers.raw))


def _write_model(df: DataFrame, table: str, run: str, model: str) -> DataFrame:
    """:func:`write_version` that counts the rows that break the model's contracts on the way and notes them with the version."""
    rules = MODEL_RULES[model]
    counted, seen = counting(df, rules)
    written = write_version(counted, table, run)
    if seen:
        note_counts(df.sparkSession, version_of(table, run), rules, seen)
    return written


def build_models(
    spark: SparkSession,
    layers: Layers = Layers(),
    cfg: PrevalenceConfig = DEFAULT_CONFIG,
    cast_mode: str = BLANK_NULL,
    dedupe: bool = True,
    method: str = AUTO,
    on_fanout: str = ERROR,
    publish: bool = True,
) -> dict[str, DataFrame]:
    """Build all models from the raw table and return them by name.

    Every model is a new version of its table. With ``publish`` the views that bear the tables' names are switched to them at the end
    (:func:`publish_models` does so later), and readers of earlier versions are not disturbed; a failure switches nothing.

    Staging is read by every later model, so it is written once; the long table stays a view over
    it. The ranking is sorted inside its files, which needs no further shuffle; the scorecard and
    the profile are sorted as a whole. With ``dedupe=False`` and ``on_fanout="allow"`` repeated loads and
    ambiguous group labels multiply rows, as an append-only run without checks would.
    """
    for name in layers.namespaces():
        ensure_namespace(spark, name)
    run = new_run()
    by_entity = [F.col(cfg.group_key).asc_nulls_last(), F.col(cfg.entity_name).asc_nulls_last()]
    staged = _write_model(with_audit(stage(spark.table(layers.raw), cast_mode, dedupe), CREATED), layers.staging, run, "staging")
    long = unpivot_measures(staged, cfg.keys, LONG_LABELS)
    long.createOrReplaceTempView(layers.long)

    # Neither of the two tables needs the other, so their jobs share the cluster.
    shape = GroupShape.of(staged, cfg.group_cols)
    with ThreadPoolExecutor(max_workers=2) as pool:
        ranked = entity_ranking(staged, cfg, method, shape).sortWithinPartitions(*by_entity)
        ranking = pool.submit(_write_model, with_audit(ranked, CREATED), layers.ranking, run, "ranking")
        profiled = group_profile(staged, cfg, shape, entity_unique=dedupe).orderBy(by_entity[0])
        profile = pool.submit(_write_model, with_audit(profiled, CREATED), layers.profile, run, "profile")
    ranking, profile = ranking.result(), profile.result()
    if on_fanout == ERROR:
        if shape.profiles != shape.groups:
            assert_one_profile_per_group(profile, cfg)
        on_fanout = ALLOW
    scored = scorecard(ranking, profile, cfg, shape.profiles, on_fanout).orderBy(*mart_order(cfg))
    mart = _write_model(with_audit(scored, CREATED, UPDATED), layers.mart, run, "mart")
    models = {"staging": staged, "long": long, "ranking": ranking, "profile": profile, "mart": mart}
    if publish:
        publish_models(spark, layers, run)
    return models


def publish_models(spark: SparkSession, layers: Layers = Layers(), run: str | None = None, keep: int = KEEP) -> None:
    """Let the views show the models of a run (default: the newest complete one), the scorecard last."""
    tables = [layers.staging, layers.ranking, layers.profile, layers.mart]
    switch_views(spark, {t: version_of(t, run or newest_run(spark, layers)) for t in tables}, keep)


def newest_run(spark: SparkSession, layers: Layers = Layers()) -> str:
    """The newest run whose models are all written, published or not."""
    return versions(spark, layers.mart)[-1].rsplit(VERSION_MARK, 1)[1]


def check_models(models: dict[str, DataFrame]) -> DataFrame:
    """Contract failures of the built models."""
    return contract_report({name: df for name, df in models.items() if name != "long"})


def check_versions(spark: SparkSession, layers: Layers = Layers(), run: str | None = None) -> DataFrame:
    """Contract failures of the models of a run (default: the newest complete one), as counted while they were written.

    A version without such counts is scanned.
    """
    run = run or newest_run(spark, layers)
    tables = {"staging": layers.staging, "ranking": layers.ranking, "profile": layers.profile, "mart": layers.mart}
    parts = []
    for model, table in tables.items():
        version, rules = version_of(table, run), MODEL_RULES[model]
        counts = noted_counts(spark, version, rules)
        noted = counts and noted_failures(spark, model, rules, counts)
        parts.append(noted or contract_failures(spark.table(version), model, rules))
    return reduce(DataFrame.union, parts)


def check_raw(spark: SparkSession, layers: Layers = Layers(), **options) -> DataFrame:
    """Quality report of the raw table, from what its loads have noted."""
    return quality_report_of_loads(spark, layers.raw, **options)


def run_all(
    spark: SparkSession,
    directory: str,
    layers: Layers = Layers(),
    layout: str = ANY_LAYOUT,
    cfg: PrevalenceConfig = DEFAULT_CONFIG,
    report_path: str | None = None,
) -> dict[str, DataFrame]:
    """Load new files, build and check; raises when a contract is broken or a quality check fails.

    Models whose contracts are broken are not published: readers go on with those of the run before.

    A second run over the same files adds nothing to the raw table. Unreadable input is in the quarantine
    table (:func:`~prevascope.sources.raw_table.quarantine_of`) and in the log.
    """
    with scratch_scope(spark):
        load_directory(spark, directory, layers, layout)
        models = build_models(spark, layers, cfg, publish=False)
    broken = check_versions(spark, layers).where("failures > 0").collect()
    if broken:
        raise ContractError("; ".join(f"{r.model}.{r.column_name} {r.rule}: {r.failures} rows" for r in broken))
    publish_models(spark, layers)
    as_of = datetime.now(timezone.utc)
    checks = check_raw(spark, layers, as_of=F.lit(as_of))
    if report_path:
        save_report(nest_report(checks, as_of.isoformat()), report_path)
    assert_quality(checks)
    return models
