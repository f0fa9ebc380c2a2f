"""One refresh of all layers: bronze -> silver -> dimension, fact, customers, daily -> checks.

What is stored does not depend on the clock, nor a row of silver on the rows of other
parts: days left, expiry status, lifetimes and burst flags are added where a table is read
(``published``).  So a part of the landed tree replaces the leaves of its days and nothing
else in silver; models are merged from state (``ringlake.plans.state``) for the dates and
customers that the part concerns.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ringlake.functions import rules
from ringlake.functions.clock import Clock
from ringlake.operators.quality import quality_report
from ringlake.operators.ranking import ranked_rows
from ringlake.plans import state
from ringlake.plans.daily import daily_summary
from ringlake.plans.silver import BurstRule, to_silver
from ringlake.plans.state import BUCKET, FLAGGED, LANDED, LANDED_DAY
from ringlake.plans.subscriptions import newest_first
from ringlake.schemas import FACT_KEYS, LANDING_PARTITIONS, SILVER_COLUMNS, SILVER_PARTITIONS
from ringlake.sources import jdbc, tables
from ringlake.sources.bronze import filter_steps
from ringlake.sources.lake import Lake, Stored, Values
from ringlake.sources.scratch import scope

DAY = "registration_date"
SHOWN_LATER = ["days_until_expiry", "is_suspicious"]  # silver columns that are not stored
STORED_COLUMNS = [c for c in SILVER_COLUMNS if c not in SHOWN_LATER] + [FLAGGED, LANDED, LANDED_DAY]


@dataclass(frozen=True)
class Names:
    """Tables that a refresh writes.  A three-part name puts a table into that catalog."""

    silver: str = "silver.subscriptions"
    dim: str = "silver.dim_subscriptions"
    fact: str = "silver.fact_daily_registrations"
    customers: str = "gold.customer_behavior"
    summary: str = "gold.daily_summary"

    @classmethod
    def within(cls, silver: str = "silver", gold: str = "gold", catalog: str | None = None) -> Names:
        """The usual names in other databases, all in one catalog."""
        parts = {"silver": silver, "gold": gold}
        moved = {k: v.split(".") for k, v in vars(cls()).items()}
        prefix = f"{catalog}." if catalog else ""
        return cls(**{k: f"{prefix}{parts[layer]}.{table}" for k, (layer, table) in moved.items()})


@dataclass
class Refreshed:
    """What a refresh wrote: tables by name, rows per stage and the quality report."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    report: DataFrame | None = None


def refresh(
    bronze: DataFrame,
    warehouse: str,
    clock: Clock = Clock(),
    burst: BurstRule | None = None,
    names: Names = Names(),
    mirror: jdbc.JdbcTarget | None = None,
    mirror_models: bool = False,
    latest_package: bool = False,
    per_day: bool = False,
    part: str | None = None,
) -> Refreshed:
    """Rebuild every table below ``warehouse``; nothing is written when bronze is empty.

    ``part`` says that ``bronze`` is that part of the landed tree only, for example
    ``year=2024/month=01``: its rows replace what silver has from there, all other rows
    stay.  Other leaves of silver are not read.  Written anew are the part's days of
    silver, the fact of the registration dates they concern (and of those that bursts reach
    from there), the customers and the dimension in the buckets of their customers, and
    the summary, from the fact.  Runs over the parts of a tree, in any order, repeated and
    on different days, end like one run over all of it at the last clock; only
    ``last_updated`` tells when a row was processed.

    Nothing is current before one manifest names all tables at the end (``Lake``), so a run
    that fails changes nothing.  Row counts are those of the files that were committed.
    The session catalog is pointed at the tables afterwards; ``published`` reads them without
    it.  ``mirror`` also sends silver to a database; with ``mirror_models`` the models
    follow under their own names, for example ``gold.daily_summary``.
    """
    done = Refreshed()
    if bronze.isEmpty():
        return done
    spark, lake = bronze.sparkSession, Lake(bronze.sparkSession, warehouse)
    try:
        with scope(spark):
            Run(lake, names, clock, burst, latest_package, per_day, part).write(bronze)
    except BaseException:
        lake.discard()
        raise
    done.rows = {"bronze": bronze.count(), "silver": lake.tables[names.silver].rows()}
    done.tables = _shown(lake, names, clock)
    attach(lake, names)
    for name in vars(names).values():
        if tables.has_v2_catalog(spark, name):
            _store_v2(done.tables[name], name, names)
    if mirror is not None:
        jdbc.overwrite(done.tables[names.silver], mirror)
        for name in list(done.tables)[1:] if mirror_models else []:
            jdbc.overwrite(done.tables[name], replace(mirror, table=name))
    done.report = quality_report(done.tables[names.dim], done.tables[names.fact], clock)
    return done


def _store_v2(df: DataFrame, name: str, names: Names) -> None:
    if name == names.silver:
        tables.replace_silver(df, name)
    else:
        df.writeTo(name).createOrReplace()


class Run:
    """One run's tables: ``now`` is what its manifest will name."""

    def __init__(self, lake: Lake, names: Names, clock: Clock, burst: BurstRule | None, latest_package: bool, per_day: bool, part: str | None):
        self.lake, self.names, self.clock, self.burst = lake, names, clock, burst
        self.latest_package, self.per_day = latest_package, per_day
        self.old = lake.tables
        self.part = part if names.silver in self.old else None  # without a table, a part is all there is
        self.arrivals, self.bursts = f"{names.silver}_arrivals", f"{names.silver}_bursts"
        self.fact_state, self.customer_state = f"{names.fact}_state", f"{names.customers}_state"
        own = {*vars(names).values(), self.arrivals, self.bursts, self.fact_state, self.customer_state}
        self.before = {} if self.part is None else {k: t for k, t in self.old.items() if k in own}
        self.now = {k: t for k, t in self.old.items() if k not in own}
        settings = lake.settings.get(names.silver, {})
        buckets = int(lake.spark.conf.get("spark.sql.shuffle.partitions"))
        self.settings = {
            "buckets": buckets if self.part is None else settings["buckets"],
            "burst": [burst.threshold, burst.seconds] if burst else None,
            "latest_package": latest_package,
        }
        self.changed = {k for k, v in self.settings.items() if self.part is None or settings[k] != v}

    def write(self, bronze: DataFrame) -> None:
        fresh = self._silver(bronze)
        # The models' jobs are many and short, so independent ones run side by side.
        with ThreadPoolExecutor(3) as side:
            cells = side.submit(self._cells, fresh)
            fact = side.submit(self._fact_and_summary, fresh, cells)
            staged = self._put(
                self.customer_state, state.customer_state(fresh, self.settings["buckets"]), [BUCKET, LANDED_DAY], self._touched
            )
            buckets = self._values(self.customer_state, BUCKET, staged)
            dim, customers = side.submit(self._dim, fresh, buckets), side.submit(self._customers, buckets)
        for each in (fact, dim, customers):
            each.result()
        self.lake.commit(self.now, {**self.lake.settings, self.names.silver: self.settings})

    def _fact_and_summary(self, fresh: DataFrame, cells: Future[set[str | None]]) -> None:
        reached = self._bursts(fresh) if self.burst else set()
        self._fact(cells.result() | reached)
        fact = self.lake.read(self.names.fact, self.now[self.names.fact]).select(*FACT_COLUMNS)
        self._put(self.names.summary, daily_summary(fact, self.clock, self.per_day), [], lambda v: True)

    def _touched(self, values: Values) -> bool:
        """Whether a leaf holds a day of the part."""
        return self.part is None or _day_in_part(values[LANDED_DAY], self.part)

    def _put(self, name: str, df: DataFrame, partition_by: list[str], gone: Callable[[Values], bool], clustered: bool = False) -> Stored:
        """Stage rows in place of the leaves that are ``gone``; returns what was staged.

        Rows that are ``clustered`` by the partition columns are written without another shuffle.
        """
        rows = df.hint("rebalance", *partition_by) if partition_by and not clustered else df
        staged = self.lake.stage(rows, name, partition_by)
        kept = self.before[name].where(lambda v: not gone(v)) if name in self.before else Stored(staged.schema, partition_by)
        self.now[name] = kept.and_also(staged)
        return staged

    def _values(self, name: str, column: str, staged: Stored) -> set[str | None]:
        """Values of a partition column that the part's old or new rows have."""
        old = self.before[name].where(self._touched).values(column) if name in self.before else set()
        return old | staged.values(column)

    def _silver(self, bronze: DataFrame) -> DataFrame:
        name = self.names.silver
        rows = _stored(bronze, self.clock)
        if self.part is not None:
            old = self.before[name]
            if None in old.values(LANDED_DAY):
                raise ValueError(f"{name} has rows of unknown landing time; refresh it from the whole tree first")
            if any(step == "hour" for step, _ in filter_steps(self.part)):  # days of the part have other hours too
                other = self.lake.read(name, old.where(self._touched)).where(~_in_part(self.part))
                rows = rows.unionByName(other.select(*STORED_COLUMNS))
        rows = rows.withColumn("activation_year", F.year("activation_date"))
        return self.lake.read(name, self._put(name, rows, [*SILVER_PARTITIONS, LANDED_DAY], self._touched))

    def _bursts(self, fresh: DataFrame) -> set[str | None]:
        """Store arrivals and bursts; the registration dates whose bursts may have changed."""
        held = self.arrivals in self.before
        source = fresh if held or self.part is None else self.lake.read(self.names.silver, self.now[self.names.silver])
        staged = self._put(self.arrivals, state.arrivals(source), [DAY, LANDED_DAY], self._touched)
        days = self._values(self.arrivals, DAY, staged)
        if "burst" in self.changed:
            days |= self.now[self.arrivals].values(DAY)
        reached = _days(days, 0, self.burst.seconds)
        near = self.now[self.arrivals].where(lambda v: v[DAY] in _days(reached, -self.burst.seconds, 0))
        over = state.bursts(self.lake.read(self.arrivals, near), self.burst)
        self._put(self.bursts, over.where(_among(DAY, reached)), [DAY], lambda v: v[DAY] in reached)
        return reached

    def _cells(self, fresh: DataFrame) -> set[str | None]:
        """Store the counts per cell and customer; the registration dates they concern."""
        staged = self._put(self.fact_state, state.fact_state(fresh), [DAY, LANDED_DAY], self._touched)
        return self._values(self.fact_state, DAY, staged)

    def _fact(self, days: set[str | None]) -> None:
        if "burst" in self.changed:
            days = days | self.now[self.fact_state].values(DAY)
        of = lambda name: self.lake.read(name, self.now[name].where(lambda v: v[DAY] in days))
        added = state.burst_rows(of(self.arrivals), of(self.bursts)) if self.burst else None
        self._put(self.names.fact, state.merged_fact(of(self.fact_state), added), [DAY], lambda v: v[DAY] in days)

    def _customers(self, written: set[str | None]) -> None:
        some = written | self.now[self.customer_state].values(BUCKET) if "latest_package" in self.changed else written
        of = self.now[self.customer_state].where(lambda v: v[BUCKET] in some)
        merged = state.merged_lifetimes(self.lake.read(self.customer_state, of), self.latest_package)
        self._put(self.names.customers, merged, [BUCKET], lambda v: v[BUCKET] in some)

    def _dim(self, fresh: DataFrame, buckets: set[str | None]) -> None:
        """Number the subscriptions of the written buckets anew: what the dimension has of other days, and the fresh rows."""
        rows = fresh.where(F.col("activation_date").isNotNull()).select(*STORED_COLUMNS, state.bucket(self.settings["buckets"]))
        if self.part is not None:
            old = self.lake.read(self.names.dim, self.before[self.names.dim].where(lambda v: v[BUCKET] in buckets))
            rows = rows.unionByName(old.where(~_day_column_in_part(self.part)).select(*rows.columns))
        ranked = ranked_rows(rows, "customer_id", newest_first(), "customer_subscription_rank", within=BUCKET)
        self._put(self.names.dim, ranked, [BUCKET], lambda v: v[BUCKET] in buckets, clustered=True)


# --- parts and days -------------------------------------------------------------------
def _stored(bronze: DataFrame, clock: Clock) -> DataFrame:
    """Silver as it is stored: without what depends on other rows or the reader's clock."""
    if set(LANDING_PARTITIONS) <= set(bronze.columns):
        hour = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("int")) for c in LANDING_PARTITIONS])
        day = F.format_string("%04d-%02d-%02d", *[F.col(c).cast("int") for c in LANDING_PARTITIONS[:3]])
    else:
        hour = day = F.lit(None).cast("string")
    rows = to_silver(bronze.withColumns({LANDED: hour, LANDED_DAY: day}), clock, keep=[LANDED, LANDED_DAY])
    return rows.withColumn(FLAGGED, rules.is_true(F.col("is_suspicious"))).select(*STORED_COLUMNS)


def _in_part(part: str) -> Column:
    out = F.lit(True)
    for name, value in filter_steps(part):
        out = out & (F.regexp_extract(LANDED, rf"(?:^|/){name}=(\d+)", 1).cast("int") == int(value))
    return out


def _day_in_part(day: str, part: str) -> bool:
    held = dict(zip(LANDING_PARTITIONS, map(int, day.split("-")), strict=False))
    return all(held.get(name, int(value)) == int(value) for name, value in filter_steps(part))


def _day_column_in_part(part: str) -> Column:
    out, steps = F.lit(True), dict(filter_steps(part))
    for at, name in enumerate(LANDING_PARTITIONS[:3], 1):
        if name in steps:
            out = out & (F.split_part(LANDED_DAY, F.lit("-"), F.lit(at)).cast("int") == int(steps[name]))
    return out


def _days(days: set[str | None], back: int, ahead: int) -> set[str | None]:
    """These days and all from ``back`` (negative) to ``ahead`` seconds around them; a missing day stays by itself."""
    out = {d for d in days if d is None}
    for day in days - out:
        first = date.fromisoformat(day)
        out |= {(first + timedelta(days=k)).isoformat() for k in range(back // 86400, -(-ahead // 86400) + 1)}
    return out


def _among(column: str, values: set[str | None]) -> Column:
    held = F.col(column).cast("string").isin(*[v for v in values if v is not None])
    return F.coalesce(held, F.lit(None in values))


# --- reading --------------------------------------------------------------------------
FACT_COLUMNS = [
    *FACT_KEYS, "total_registrations", "cancelled_registrations", "suspicious_registrations",
    "auto_renewal_registrations", "avg_price", "unique_customers",
]
_LEFT = "datediff(s.expiry_date, {today})"
_SHOWN = {"days_until_expiry": _LEFT, "is_suspicious": "s.flagged"}
_BURST = "LEFT JOIN {bursts} b ON s.package_name <=> b.package_name AND s.zone <=> b.zone AND s.created_at <=> b.created_at"
_LIFE = "datediff({today}, s.first_subscription_date)"


def _select(names: Names, name: str, has_bursts: bool) -> str:
    """How a table is read from what is stored (``{stored}``, ``{bursts}``) on the date ``{today}``."""
    shown = _SHOWN | ({"is_suspicious": "s.flagged OR b.package_name IS NOT NULL"} if has_bursts else {})
    silver = ", ".join(f"{shown[c]} AS {c}" if c in shown else f"s.{c}" for c in SILVER_COLUMNS)
    bursts = _BURST if has_bursts else ""
    if name == names.silver:
        return f"SELECT {silver} FROM {{stored}} s {bursts}"
    if name == names.dim:
        # Days left below which a subscription is expired or expires soon.
        status = f"CASE WHEN {_LEFT} < 0 THEN 'expired' WHEN {_LEFT} <= 7 THEN 'expiring_soon' ELSE 'active' END"
        price = "try_divide(CAST(s.price_monthly_vnd AS DOUBLE), s.data_limit_gb)"
        return f"SELECT {silver}, {status} AS expiry_status, {price} AS price_per_gb, s.customer_subscription_rank FROM {{stored}} s {bursts}"
    if name == names.customers:
        # Limits of the segments, in this order.
        segment = (
            f"CASE WHEN {_LIFE} > 365 AND s.total_subscriptions > 3 THEN 'loyal' WHEN s.avg_spending > 300000 THEN 'high_value' "
            f"WHEN s.total_cancellations > 0 THEN 'churn_risk' WHEN {_LIFE} < 30 THEN 'new' ELSE 'regular' END"
        )
        measures = (
            "s.first_subscription_date, s.last_subscription_date, s.total_subscriptions, s.total_cancellations, "
            "s.avg_spending, s.current_package, s.is_auto_renewal"
        )
        return f"SELECT s.customer_id, {segment} AS customer_segment, {measures}, {_LIFE} AS customer_lifetime_days FROM {{stored}} s"
    return f"SELECT {', '.join(FACT_COLUMNS) if name == names.fact else '*'} FROM {{stored}} s"


def published(spark: SparkSession, warehouse: str, names: Names = Names(), clock: Clock = Clock()) -> dict[str, DataFrame]:
    """The tables as the newest manifest has them, all from one run, seen at the clock's date."""
    return _shown(Lake(spark, warehouse), names, clock)


def _shown(lake: Lake, names: Names, clock: Clock) -> dict[str, DataFrame]:
    bursts = f"{names.silver}_bursts"
    today = "current_date()" if clock.today is None else f"DATE '{clock.today.isoformat()}'"
    out = {}
    for name in vars(names).values():
        if name in lake.tables:
            query = _select(names, name, bursts in lake.tables).replace("{today}", today)
            frames = {"bursts": lake.read(bursts)} if "{bursts}" in query else {}
            out[name] = lake.spark.sql(query, stored=lake.read(name), **frames)
    return out


def attach(lake: Lake, names: Names = Names()) -> None:
    """Point the session catalog at the current tables: stored leaves, and views that add what is shown later."""
    spark, bursts = lake.spark, f"{names.silver}_bursts"
    for table in vars(names).values():
        if not tables.has_v2_catalog(spark, table):
            database = table.rsplit(".", 1)[0]
            tables.ensure_database(spark, database, f"{lake.root}/databases/{database}")
    if bursts in lake.tables and not tables.has_v2_catalog(spark, names.silver):
        lake.attach(bursts, bursts)
    for name in vars(names).values():
        if tables.has_v2_catalog(spark, name):
            continue
        lake.attach(name, f"{name}_stored")
        if tables.exists(spark, name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {name}")
        query = _select(names, name, bursts in lake.tables).replace("*", ", ".join(lake.tables[name].schema.names))
        query = query.replace("{today}", "current_date()").format(stored=f"{name}_stored", bursts=bursts)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
