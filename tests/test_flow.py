"""Whole runs: streaming equals batch, refreshes are repeatable, layers agree."""

from datetime import date
import shutil

from pyspark.sql import functions as F
import pytest

from ringlake.__main__ import main as job
from helpers import CLOCK, bronze_rows, same_rows
from ringlake.plans.customers import customer_behavior
from ringlake.plans.daily import daily_summary
from ringlake.functions.clock import Clock
from ringlake.plans.refresh import Names, published, refresh
from ringlake.registry import QUERIES
from ringlake.plans.silver import BurstRule, to_silver
from ringlake.plans.subscriptions import dim_subscriptions, fact_daily
from ringlake.sources import bronze, jdbc, order_feed
from ringlake.sources.lake import Lake
from ringlake.streaming import ingest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed") / "bronze")
    order_feed.bronze(spark, FOLDER).write.parquet(path)
    return spark.read.parquet(path)


def test_stream_takes_each_file_once(spark, tmp_path):
    base, target, state = (str(tmp_path / name) for name in ("raw", "silver", "state"))
    at = F.to_timestamp("created_at")
    first = bronze_rows(spark, {"subscription_id": "VT1"}, {"subscription_id": None}, {"subscription_id": "VT2", "zone": None})
    second = bronze_rows(spark, {"subscription_id": "VT3", "package_type": "daily", "activation_date": None})
    for batch, ids in ((first, {"VT1", "VT2"}), (None, {"VT1", "VT2"}), (second, {"VT1", "VT2", "VT3"})):
        if batch is not None:
            bronze.land(batch, base, at)
        ingest.ingest(spark, base, target, state, CLOCK, maxFilesPerTrigger="1").awaitTermination()
        found = ingest.ingested(spark, target)
        assert {r.subscription_id for r in found.collect()} == ids and found.count() == len(ids)
    assert same_rows(ingest.ingested(spark, target), to_silver(bronze.scan(spark, base), CLOCK))


def test_a_lost_checkpoint_loses_no_row(spark, feed, tmp_path):
    """Nor does a second one beside the first: every file is taken once, by whichever query sees it first."""
    base, target = str(tmp_path / "raw"), str(tmp_path / "silver")
    day = F.to_timestamp(F.lit("2024-01-20 00:00:00"))
    bronze.land(feed.where("auto_renewal"), base, day)
    ingest.ingest(spark, base, target, str(tmp_path / "one"), CLOCK).awaitTermination()
    table = ingest.create_table(spark, "ingest_lost", target)
    first = table.count()
    bronze.land(feed.where("NOT auto_renewal"), base, day + F.expr("interval 1 day"))
    shutil.rmtree(tmp_path / "one")
    ingest.ingest(spark, base, target, str(tmp_path / "one"), CLOCK).awaitTermination()
    ingest.ingest(spark, base, target, str(tmp_path / "two"), CLOCK).awaitTermination()
    assert same_rows(ingest.ingested(spark, target), to_silver(feed, CLOCK))
    assert 0 < first < ingest.create_table(spark, "ingest_lost", target).count() == to_silver(feed, CLOCK).count()


def test_a_batch_without_its_log_entry_does_not_count(spark, feed, tmp_path):
    """As if the driver had gone between the rows and the entry, and the checkpoint with it."""
    base, target = str(tmp_path / "raw"), str(tmp_path / "silver")
    bronze.land(feed, base, F.to_timestamp(F.lit("2024-01-20 00:00:00")))
    ingest.ingest(spark, base, target, str(tmp_path / "one"), CLOCK).awaitTermination()
    shutil.rmtree(tmp_path / "silver-log")
    assert ingest.ingested(spark, target).count() == 0
    ingest.ingest(spark, base, target, str(tmp_path / "two"), CLOCK).awaitTermination()
    assert same_rows(ingest.ingested(spark, target), to_silver(feed, CLOCK))


def test_refresh_writes_what_the_models_compute(spark, feed, tmp_path):
    done = refresh(feed, str(tmp_path), CLOCK)
    silver = to_silver(feed, CLOCK)
    dim = dim_subscriptions(silver)
    fact = fact_daily(dim)
    expected = {
        "silver.subscriptions": silver,
        "silver.dim_subscriptions": dim,
        "silver.fact_daily_registrations": fact,
        "gold.customer_behavior": customer_behavior(dim, CLOCK),
    }
    assert list(done.tables) == [*expected, "gold.daily_summary"]
    for name, df in expected.items():
        assert same_rows(done.tables[name], df), name
    assert done.tables["gold.daily_summary"].count() == daily_summary(fact, CLOCK).count()
    assert done.rows == {"bronze": feed.count(), "silver": silver.count()}
    assert done.report.count() == 12

    totals = F.sum("total_registrations")
    assert fact.agg(totals).first()[0] == dim.count()
    per_day = done.tables["gold.daily_summary"].select("registration_date", "total_subscriptions").distinct()
    assert per_day.agg(F.sum("total_subscriptions")).first()[0] == dim.count()
    firsts = dim.where("customer_subscription_rank = 1")
    assert firsts.count() == firsts.select("customer_id").distinct().count() == dim.select("customer_id").distinct().count()


def test_refresh_can_be_repeated_and_uses_burst(spark, feed, tmp_path):
    counts = []
    for _ in range(2):
        done = refresh(feed, str(tmp_path), CLOCK, BurstRule(1))
        counts.append((done.rows, {name: table.count() for name, table in done.tables.items()}))
    assert counts[0] == counts[1]
    assert same_rows(done.tables["silver.subscriptions"], to_silver(feed, CLOCK, BurstRule(1)))


def test_job_over_a_landed_tree(spark, feed, tmp_path, capsys):
    base, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    bronze.land(feed, base)
    job(["--bronze", base, "--warehouse", lake, "--merge-schema", "--burst", "--burst-threshold", "1", "--per-day"])
    shown = capsys.readouterr().out
    assert f"'bronze': {feed.count()}" in shown and "duplicates" in shown
    segments = spark.sql("SELECT customer_segment, count(*) AS n FROM gold.customer_behavior GROUP BY 1")
    assert segments.agg(F.sum("n")).first()[0] == spark.table("silver.dim_subscriptions").select("customer_id").distinct().count()
    job(["--bronze", base, "--warehouse", lake, "--date-filter", "year=1999"])
    assert "nothing written" in capsys.readouterr().out
    before = spark.table("silver.subscriptions").count()
    today = spark.range(1).select(F.concat(F.lit("year="), F.year(F.current_date()))).first()[0]
    job(["--bronze", base, "--warehouse", lake, "--date-filter", today, "--burst", "--burst-threshold", "1"])
    assert spark.table("silver.subscriptions").count() == before


def test_parts_in_any_order_equal_the_whole(spark, feed, tmp_path):
    base = str(tmp_path / "raw")
    month = F.date_trunc("month", F.to_timestamp("created_at"))
    bronze.land(feed.where("auto_renewal"), base, month)
    bronze.land(feed.where("NOT auto_renewal"), base, month + F.expr("interval 1 month"))
    whole = refresh(bronze.scan(spark, base), str(tmp_path / "a"), CLOCK, BurstRule(1), Names.within("sa", "ga"))
    for part in ("year=2024/month=02", "year=2024/month=01", "year=2024/month=02"):
        rows = bronze.scan(spark, base, part)
        parts = refresh(rows, str(tmp_path / "b"), CLOCK, BurstRule(1), Names.within("sb", "gb"), part=part)
    for left, right in zip(whole.tables.values(), parts.tables.values(), strict=True):
        assert same_rows(left, right)
    with pytest.raises(ValueError, match="whole tree"):
        refresh(feed, str(tmp_path / "c"), CLOCK, names=Names.within("sc", "gc"))
        refresh(feed, str(tmp_path / "c"), CLOCK, names=Names.within("sc", "gc"), part="year=2024")


def test_a_failing_run_changes_nothing(spark, feed, tmp_path, monkeypatch):
    names = Names.within("sf", "gf")
    refresh(feed, str(tmp_path), CLOCK, names=names)
    before = {t: spark.table(t).count() for t in vars(names).values()}
    monkeypatch.setattr("ringlake.plans.refresh.daily_summary", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh(feed.limit(10), str(tmp_path), CLOCK, names=names)
    assert {t: spark.table(t).count() for t in vars(names).values()} == before
    assert len(list(tmp_path.glob("*/*/lake_version=*"))) == 9 - 2  # what was staged is gone; no bursts


@pytest.mark.parametrize("step", ["stage:0", "stage:5", "_put", "_forget", "attach:2"])
def test_tables_are_all_old_or_all_new(spark, feed, tmp_path, monkeypatch, step):
    """A run that stops at any step leaves the tables of one run, never a mixture."""
    some = feed.limit(40)
    refresh(some, str(tmp_path), CLOCK, names=Names.within("sm", "gm"))
    count = lambda: {n: t.count() for n, t in published(spark, str(tmp_path), Names.within("sm", "gm"), CLOCK).items()}
    old = count()
    method, _, turn = step.partition(":")
    calls, plain = [], getattr(Lake, method)

    def breaks(self, *a, **k):
        calls.append(1)
        if len(calls) > int(turn or 0):
            raise OSError("stopped here")
        return plain(self, *a, **k)

    monkeypatch.setattr(Lake, method, breaks)
    with pytest.raises(OSError, match="stopped here"):
        refresh(feed, str(tmp_path), CLOCK, names=Names.within("sm", "gm"))
    monkeypatch.undo()
    found, silver = count(), to_silver(feed, CLOCK).count()
    switched = method in ("_forget", "attach")
    assert found["sm.subscriptions"] == (silver if switched else old["sm.subscriptions"])
    assert (found == old) != switched
    totals = published(spark, str(tmp_path), Names.within("sm", "gm"), CLOCK)
    fact = totals["sm.fact_daily_registrations"].agg(F.sum("total_registrations")).first()[0]
    assert fact == found["sm.dim_subscriptions"]
    assert refresh(feed, str(tmp_path), CLOCK, names=Names.within("sm", "gm")).rows["silver"] == silver
    assert spark.table("sm.subscriptions").count() == silver


def test_two_runs_cannot_publish_one_number(spark, feed, tmp_path):
    refresh(feed.limit(20), str(tmp_path), CLOCK, names=Names.within("sw", "gw"))
    first, second = Lake(spark, str(tmp_path)), Lake(spark, str(tmp_path))
    first.commit(first.tables, first.settings)
    with pytest.raises(Exception, match="exist"):
        second.commit(second.tables, second.settings)


def test_a_part_leaves_other_leaves_unread(spark, feed, tmp_path):
    """Silver of other days is made unreadable; the part's days, the fact and the customers come out right."""
    base, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    day = F.date_trunc("week", F.to_timestamp("created_at"))
    bronze.land(feed, base, day)
    names = Names.within("su", "gu")
    refresh(bronze.scan(spark, base), lake, Clock(date(2024, 1, 1), CLOCK.now), BurstRule(1), names)
    part = "year=2024/month=01/day=22"
    for file in (tmp_path / "lake" / "su" / "subscriptions").rglob("*.parquet"):
        if "landed_day=2024-01-22" not in str(file):
            file.write_bytes(b"no longer a table")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    late = bronze.scan(spark, base, part).where("subscription_id <> 'VT100005'").withColumn("status", F.lit("cancelled"))
    done = refresh(late, lake, CLOCK, BurstRule(1), names, part=part)
    rest = bronze.scan(spark, base).where("NOT (year = 2024 AND month = 1 AND day = 22)")
    silver = to_silver(rest.unionByName(late), CLOCK, BurstRule(1))
    dim = dim_subscriptions(silver)
    assert same_rows(done.tables[names.fact], fact_daily(dim))
    assert same_rows(done.tables[names.customers], customer_behavior(dim, CLOCK))
    assert same_rows(done.tables[names.summary], daily_summary(fact_daily(dim), CLOCK))
    assert same_rows(done.tables[names.dim].drop("last_updated"), dim.drop("last_updated"))
    assert done.rows["silver"] == silver.count()


def test_an_hour_keeps_the_other_hours_of_its_day(spark, feed, tmp_path):
    base = str(tmp_path / "raw")
    at = F.to_timestamp(F.lit("2024-02-01 03:00:00")) + F.expr("CASE WHEN auto_renewal THEN interval 5 hours ELSE interval 0 hours END")
    bronze.land(feed, base, at)
    names = Names.within("sh", "gh")
    refresh(bronze.scan(spark, base), str(tmp_path / "lake"), CLOCK, names=names)
    part = "year=2024/month=02/day=01/hour=08"
    done = refresh(bronze.scan(spark, base, part).limit(7), str(tmp_path / "lake"), CLOCK, names=names, part=part)
    other = to_silver(feed.where("NOT auto_renewal"), CLOCK).count()
    assert done.rows["bronze"] == 7 and other < done.rows["silver"] <= other + 7
    assert same_rows(done.tables[names.fact], fact_daily(dim_subscriptions(done.tables[names.silver])))


def test_a_changed_rule_reaches_all_days(spark, feed, tmp_path):
    """Bursts that come, get another threshold and go again with the run of one part."""
    base, names = str(tmp_path / "raw"), Names.within("sr", "gr")
    bronze.land(feed, base, F.date_trunc("month", F.to_timestamp("created_at")))
    rows = bronze.scan(spark, base)
    for k, rule in enumerate([None, BurstRule(1), BurstRule(2, 7200), None]):
        done = refresh(rows, str(tmp_path / "lake"), CLOCK, rule, names, part="year=2024" if k else None)
        silver = to_silver(feed, CLOCK, rule)
        assert same_rows(done.tables[names.silver], silver)
        assert same_rows(done.tables[names.fact], fact_daily(dim_subscriptions(silver)))


def test_queries_leave_the_callers_tables(spark, feed, tmp_path):
    refresh(feed.limit(20), str(tmp_path), CLOCK)
    before = spark.table("silver.subscriptions").count()
    assert QUERIES["refreshed_dim"](spark, FOLDER).count() > before
    assert spark.table("silver.subscriptions").count() == before


def test_refresh_stops_on_empty_input(spark, feed, tmp_path):
    done = refresh(feed.limit(0), str(tmp_path / "none"), CLOCK)
    assert done.tables == {} and done.report is None and not (tmp_path / "none").exists()


def test_refresh_mirrors_silver(spark, feed, tmp_path, monkeypatch):
    sent = []
    monkeypatch.setattr(jdbc, "overwrite", lambda df, target: sent.append((df.count(), target.table)))
    target = jdbc.JdbcTarget("jdbc:x:", "public.t")
    refresh(feed, str(tmp_path), CLOCK, mirror=target)
    assert sent == [(to_silver(feed, CLOCK).count(), "public.t")]
    sent.clear()
    done = refresh(feed, str(tmp_path), CLOCK, mirror=target, mirror_models=True)
    models = [(table.count(), name) for name, table in done.tables.items()]
    assert sent == [(models[0][0], "public.t"), *models[1:]]
