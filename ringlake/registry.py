"""Every operator as a query over the given tables: ``name -> f(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ringlake.functions.clock import Clock
from ringlake.operators import profile, quality
from ringlake.operators.filters import valid_subscriptions
from ringlake.operators.trailing import attach_counts, trailing_counts
from ringlake.plans import customers, daily, silver, subscriptions
from ringlake.plans.refresh import Names, Refreshed, refresh
from ringlake.schemas import BRONZE_COLUMNS, LANDING_PARTITIONS, REQUIRED_COLUMNS
from ringlake.sources import bronze as tree
from ringlake.sources import compaction, order_feed, tables
from ringlake.sources.lake import Lake
from ringlake.sources.scratch import new_folder, written
from ringlake.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

CLOCK = order_feed.AS_OF
BURST = silver.BurstRule(threshold=3)
LATER = Clock(CLOCK.today, datetime(2024, 1, 31, 15, 30))
LANDED_COLUMNS = [*BRONZE_COLUMNS, "minute", *LANDING_PARTITIONS]

# Ratios are compared after rounding: engines add doubles in different orders.
DIGITS = {
    "usage_percentage": 6, "price_per_gb": 6, "avg_price": 6, "avg_spending": 6,
    "cancellation_rate": 6, "avg_7day": 6, "std_7day": 6, "hours_ago": 6, "estimated_revenue": 2,
}


def comparable(df: DataFrame) -> DataFrame:
    """Rounded ratios, and timestamps without a zone."""

    def shown(name: str, dtype: T.DataType):
        if name in DIGITS:
            return F.round(name, DIGITS[name]).alias(name)
        return F.col(name).cast("timestamp_ntz").alias(name) if isinstance(dtype, T.TimestampType) else F.col(name)

    return df.select(*[shown(field.name, field.dataType) for field in df.schema])


# --- shared inputs ----------------------------------------------------------------
_bronze = order_feed.bronze


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver.to_silver(_bronze(spark, folder), CLOCK)


def _details(spark: SparkSession, folder: str) -> DataFrame:
    return subscriptions.subscription_details(_silver(spark, folder))


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    return subscriptions.fact_daily(_details(spark, folder))


def _written_fact(spark: SparkSession, folder: str) -> DataFrame:
    """For models that read the fact more than once."""
    return written(_fact(spark, folder), "fact")


def _with_burst(spark: SparkSession, folder: str) -> DataFrame:
    return silver.with_burst_count(silver.typed_subscriptions(_bronze(spark, folder), CLOCK), BURST)


def _created_at():
    return F.to_timestamp("created_at")


def _landed(spark: SparkSession, folder: str) -> str:
    """Land the registrations by their creation time; returns the tree's root."""
    base = new_folder(spark, "bronze")
    tree.land(_bronze(spark, folder), base, _created_at())
    return base


# --- sources and sinks --------------------------------------------------------------
def bronze_scan(spark: SparkSession, folder: str) -> DataFrame:
    return tree.scan(spark, _landed(spark, folder)).select(*BRONZE_COLUMNS)


def bronze_scan_pruned(spark: SparkSession, folder: str) -> DataFrame:
    return tree.scan(spark, _landed(spark, folder), "year=2024/month=01/day=15").select(*LANDED_COLUMNS)


def bronze_land_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return tree.scan(spark, _landed(spark, folder)).select(*LANDED_COLUMNS)


def bronze_merge_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Normal rows are landed without the reason column, anomalous rows with it."""
    rows, base = _bronze(spark, folder), new_folder(spark, "bronze-merge")
    tree.land(rows.where(~F.col("is_anomaly")).drop("anomaly_reason"), base, _created_at())
    tree.land(rows.where("is_anomaly"), base, _created_at())
    return tree.scan(spark, base, merge_schema=True).select(*LANDED_COLUMNS)


def _landing_day():
    return F.date_trunc("day", _created_at())


def bronze_mixed_types(spark: SparkSession, folder: str) -> DataFrame:
    """Every day has files whose reason is a null-typed integer, and files that hold it as text."""
    rows, base = _bronze(spark, folder), new_folder(spark, "bronze-mixed")
    untyped = rows.where(~F.col("is_anomaly")).withColumn("anomaly_reason", F.lit(None).cast("int"))
    tree.land(untyped, base, _landing_day())
    tree.land(rows.where("is_anomaly"), base, _landing_day())
    return tree.scan(spark, base, conform=True).select(*LANDED_COLUMNS)


def bronze_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Ten landings, packed and cleaned up: rows and files of every landed day."""
    rows, base = written(_bronze(spark, folder), "bronze"), new_folder(spark, "bronze-packed")
    for batch in range(10):
        tree.land(rows.where(F.substring("subscription_id", 3, 20).cast("long") % 10 == batch), base, _landing_day())
    compaction.compact(spark, base)
    compaction.vacuum(spark, base)
    return compaction.landed_files(spark, base)


def _scratch_table(spark: SparkSession, rows: DataFrame, label: str) -> str:
    path = new_folder(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.replace_silver(rows, name, path)
    return name


def silver_table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(tables.read_silver(spark, _scratch_table(spark, _silver(spark, folder), "silver-replace")))


def silver_append(spark: SparkSession, folder: str) -> DataFrame:
    rows = _silver(spark, folder)
    table = _scratch_table(spark, rows.where(~F.col("is_suspicious")), "silver-append")
    tables.append_silver(rows.where("is_suspicious"), table)
    return comparable(tables.read_silver(spark, table))


def silver_stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Two landings, each taken by a run of its own, read as a table."""
    base, target, state = (new_folder(spark, label) for label in ("bronze", "stream", "stream-state"))
    rows = _bronze(spark, folder)
    for landing in (rows.where("auto_renewal"), rows.where("NOT auto_renewal")):
        tree.land(landing, base, _created_at())
        ingest.ingest(spark, base, target, state, CLOCK).awaitTermination()
    return comparable(ingest.create_table(spark, target.rsplit("/", 1)[1].replace("-", "_"), target))


def _refreshed(
    spark: SparkSession, rows: DataFrame, *parts: str, clocks: tuple[Clock, ...] = (), warehouse: str | None = None, **options,
) -> Refreshed:
    """A refresh into databases of its own, so that the caller's tables are not touched."""
    warehouse = warehouse or new_folder(spark, "warehouse")
    unique = warehouse.rsplit("-", 1)[1]
    names = Names.within(f"silver_{unique}", f"gold_{unique}")
    if not parts:
        done = refresh(rows, warehouse, CLOCK, names=names, **options)
    for part, clock in zip(parts, clocks or [CLOCK] * len(parts), strict=True):
        done = refresh(rows.where(tree.partition_predicate(part)), warehouse, clock, names=names, part=part, **options)
    if done.tables:
        for database in {name.rsplit(".", 1)[0] for name in done.tables}:
            spark.sql(f"DROP DATABASE {database} CASCADE")  # the files stay until the session ends
    done.tables = {name.replace(f"_{unique}", ""): table for name, table in done.tables.items()}
    return done


def _tables(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "stage string, rows long")


def refreshed_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table that a whole refresh wrote."""
    counted = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, table in _refreshed(spark, written(_bronze(spark, folder), "bronze")).tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def refreshed_dim(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_refreshed(spark, written(_bronze(spark, folder), "bronze")).tables["silver.dim_subscriptions"])


def refreshed_customers(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_refreshed(spark, written(_bronze(spark, folder), "bronze")).tables["gold.customer_behavior"])


def refreshed_summary(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_refreshed(spark, written(_bronze(spark, folder), "bronze")).tables["gold.daily_summary"])


def refreshed_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of a refresh: what it read, and what the footers of the committed silver files hold."""
    return _tables(spark, _refreshed(spark, written(_bronze(spark, folder), "bronze")).rows)


def refresh_of_nothing(spark: SparkSession, folder: str) -> DataFrame:
    """How many tables a refresh writes of rows that no registration is among: those below a price of nothing."""
    done = _refreshed(spark, _bronze(spark, folder).where(F.col("price_monthly_vnd") < 0))
    return _tables(spark, {"tables": len(done.tables)})


# The tree's parts as they are refreshed, and the clock of each run.
EARLIER = Clock(date(2024, 1, 10), datetime(2024, 1, 10, 9))
PART_RUNS = [("year=2023", EARLIER), ("year=2024", CLOCK), ("year=2024/month=01/day=15", CLOCK)]
_part_runs_done: dict[tuple[str, str], tuple[Refreshed, Lake]] = {}


def _part_runs(spark: SparkSession, folder: str) -> tuple[Refreshed, Lake]:
    """Three runs with bursts over parts of a landed tree, under two clocks; run once a session and folder.

    Rows that renew by themselves land a year before the others, all at the start of
    their creation's week.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _part_runs_done:
        base, week = new_folder(spark, "bronze"), F.date_trunc("week", _created_at())
        rows = _bronze(spark, folder).where("auto_renewal IS NOT NULL")
        tree.land(rows, base, F.when(F.col("auto_renewal"), week - F.expr("interval 1 year")).otherwise(week))
        parts, clocks = zip(*PART_RUNS, strict=True)
        warehouse = new_folder(spark, "warehouse")
        done = _refreshed(spark, tree.scan(spark, base), *parts, clocks=clocks, warehouse=warehouse, burst=BURST)
        _part_runs_done[key] = done, Lake(spark, warehouse)
    return _part_runs_done[key]


def _lake_name(lake: Lake, ending: str) -> str:
    return next(name for name in lake.tables if name.endswith(ending))


def refresh_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Silver with bursts after three runs over parts of the tree, the last over a part of one before."""
    return comparable(_part_runs(spark, folder)[0].tables["silver.subscriptions"])


def refresh_two_clocks(spark: SparkSession, folder: str) -> DataFrame:
    """The dimension after the part runs, as of the later clock; only the time of processing tells them apart."""
    return comparable(_part_runs(spark, folder)[0].tables["silver.dim_subscriptions"].drop("last_updated"))


def refresh_parts_fact(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_part_runs(spark, folder)[0].tables["silver.fact_daily_registrations"])


def refresh_parts_customers(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_part_runs(spark, folder)[0].tables["gold.customer_behavior"])


def refresh_parts_summary(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_part_runs(spark, folder)[0].tables["gold.daily_summary"])


def refresh_parts_bursts(spark: SparkSession, folder: str) -> DataFrame:
    """The stored burst instants after the part runs."""
    lake = _part_runs(spark, folder)[1]
    return comparable(lake.read(_lake_name(lake, "_bursts")).select(*silver.BURST_KEYS, "created_at"))


def refresh_rewritten(spark: SparkSession, folder: str) -> DataFrame:
    """Partitions of silver that the last part run wrote, with their rows."""
    lake = _part_runs(spark, folder)[1]
    return lake.rewritten(_lake_name(lake, ".subscriptions"))


def stage_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.stage_counts(_bronze(spark, folder))


# --- silver -------------------------------------------------------------------------
def valid(spark: SparkSession, folder: str) -> DataFrame:
    return valid_subscriptions(_bronze(spark, folder)).select(*REQUIRED_COLUMNS, "status")


def usage_metrics(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["data_limit_gb", "total_used_gb", "subscription_duration_days", "days_until_expiry", "usage_percentage"]
    return comparable(_silver(spark, folder).select("subscription_id", "customer_id", *columns))


def price_segment(spark: SparkSession, folder: str) -> DataFrame:
    return _silver(spark, folder).select("subscription_id", "customer_id", "price_monthly_vnd", "customer_segment")


def silver_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_silver(spark, folder))


def _silver_burst(spark: SparkSession, folder: str) -> DataFrame:
    """With written bursts: their file size decides whether the wide rows are shuffled."""
    rows = _bronze(spark, folder)
    return silver.to_silver(rows, CLOCK, BURST, written(silver.burst_instants(rows, BURST), "bursts"))


def silver_subscriptions_burst(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_silver_burst(spark, folder))


def registration_burst(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["subscription_id", "customer_id", "package_name", "zone", "created_at", "registration_count"]
    return comparable(_with_burst(spark, folder).select(*columns))


def burst_suspicious(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["subscription_id", "customer_id", "created_at", "is_suspicious"]
    return comparable(_silver_burst(spark, folder).select(*columns))


def event_burst(spark: SparkSession, folder: str) -> DataFrame:
    """The trailing-hour count on microsecond event times."""
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "event_type", "ts")
    counts = trailing_counts(events, ["event_type"], "ts", 3600, "events_last_hour")
    return attach_counts(events, counts, ["event_type"], "ts", "events_last_hour")


# --- dimension, fact, customers -------------------------------------------------------
def dim_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(subscriptions.dim_subscriptions(_silver(spark, folder)))


def customer_subscription_rank(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["customer_id", "subscription_id", "activation_date", "customer_subscription_rank"]
    return subscriptions.dim_subscriptions(_silver(spark, folder)).select(*columns)


def fact_daily(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_fact(spark, folder))


def customer_lifetime(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(customers.customer_lifetime(_details(spark, folder), CLOCK))


def customer_latest_package(spark: SparkSession, folder: str) -> DataFrame:
    return customers.customer_lifetime(_details(spark, folder), CLOCK, latest_package=True).select(
        "customer_id", "current_package"
    )


def customer_behavior(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(customers.customer_behavior(_details(spark, folder), CLOCK))


# --- daily --------------------------------------------------------------------------
def daily_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(daily.daily_kpis(_fact(spark, folder)).drop("top_package", "top_zone"))


def daily_top_package(spark: SparkSession, folder: str) -> DataFrame:
    return daily.daily_kpis(_fact(spark, folder)).select("registration_date", "top_package")


def daily_top_zone(spark: SparkSession, folder: str) -> DataFrame:
    return daily.daily_kpis(_fact(spark, folder)).select("registration_date", "top_zone")


def daily_top_zone_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Top zones where every third order has no zone."""
    no_zone = F.substring("subscription_id", 3, 20).cast("long") % 3 == 0
    rows = _bronze(spark, folder).withColumn("zone", F.when(~no_zone, F.col("zone")))
    fact = subscriptions.fact_daily(subscriptions.subscription_details(silver.to_silver(rows, CLOCK)))
    return daily.daily_kpis(fact).select("registration_date", "top_package", "top_zone")


def daily_top_package_total(spark: SparkSession, folder: str) -> DataFrame:
    return daily.daily_top_by_sum(_fact(spark, folder))


def rolling_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["registration_date", *daily.CELL_ORDER, "total_registrations", "avg_7day", "std_7day", "anomaly_status"]
    return comparable(daily.rolling_anomalies(_written_fact(spark, folder)).select(*columns))


def rolling_anomaly_daily(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(daily.rolling_anomalies(_fact(spark, folder), per_day=True))


def daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(daily.daily_summary(_written_fact(spark, folder), CLOCK))


def daily_summary_per_day(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(daily.daily_summary(_written_fact(spark, folder), CLOCK, per_day=True))


# --- profile and quality --------------------------------------------------------------
def package_top5(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(_bronze(spark, folder), "package_name")


def batch_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.flag_counts(_bronze(spark, folder))


def dq_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_checks(_details(spark, folder), quality.null_checks())


def dq_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return quality.row_count_report(_details(spark, folder), _fact(spark, folder))


def dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_checks(_details(spark, folder), [quality.duplicate_check()])


def dq_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_checks(_details(spark, folder), quality.range_checks())


def dq_domains(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_checks(_details(spark, folder), quality.domain_checks())


def dq_freshness(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(quality.freshness(_details(spark, folder), LATER))


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(_details(spark, folder), _fact(spark, folder), LATER)


def contract_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.contract_not_null(_silver(spark, folder))


def contract_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.contract_unique(_silver(spark, folder))


def contract_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    return quality.contract_accepted_values(_silver(spark, folder))


QUERIES: dict[str, Query] = {
    "valid_subscriptions": valid,
    **{
        query.__name__: query
        for query in (
            bronze_scan, bronze_scan_pruned, bronze_merge_schema, bronze_land_roundtrip,
            silver_table_roundtrip, silver_append, silver_stream_ingest, refreshed_tables, stage_row_counts,
            refreshed_dim, refreshed_customers, refreshed_summary, refreshed_row_counts, refresh_of_nothing, refresh_incremental,
            refresh_two_clocks, refresh_parts_fact, refresh_parts_customers, refresh_parts_summary, refresh_parts_bursts,
            refresh_rewritten, bronze_mixed_types, bronze_compacted,
            usage_metrics, price_segment, silver_subscriptions, silver_subscriptions_burst,
            registration_burst, burst_suspicious, event_burst,
            dim_subscriptions, customer_subscription_rank, fact_daily,
            customer_lifetime, customer_latest_package, customer_behavior,
            daily_kpis, daily_top_package, daily_top_zone, daily_top_zone_nulls, daily_top_package_total,
            rolling_anomaly, rolling_anomaly_daily, daily_summary, daily_summary_per_day,
            package_top5, batch_profile,
            dq_nulls, dq_row_count, dq_duplicates, dq_ranges, dq_domains, dq_freshness, dq_report,
            contract_not_null, contract_unique, contract_accepted_values,
        )
    },
}
