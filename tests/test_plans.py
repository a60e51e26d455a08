"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "raw_events_load",
        "raw_purchase_items",
        "stg_sessions",
        "stg_purchases",
        "stg_users",
        "mart_daily_metrics",
        "mart_product_metrics",
        "new_vs_returning",
        "row_count_anomaly",
        "session_refresh",
    ],
)
def test_no_single_partition_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "SinglePartition" not in plan
    assert "Python" not in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_event_filter_reaches_the_files(spark):
    plan = plan_of(QUERIES["stg_sessions"](spark, SF))
    assert re.search(r"PushedFilters: \[.*EqualTo\(event_type,view\)", plan)


def test_items_read_no_unused_columns(spark):
    plan = plan_of(QUERIES["stg_purchase_items"](spark, SF))
    assert "l_linestatus" not in plan


def test_raw_load_needs_no_shuffle(spark):
    assert "hashpartitioning" not in plan_of(QUERIES["raw_events_load"](spark, SF))


def test_no_event_is_gathered_per_key(spark):
    for name in ("stg_sessions", "stg_users", "mart_product_metrics", "mart_daily_metrics"):
        assert "collect_list" not in plan_of(QUERIES[name](spark, SF))


@pytest.fixture(scope="module")
def stored_events(spark, tmp_path_factory):
    """A raw table as the job stores it."""
    from shopgauge.operators import raw
    from shopgauge.plans import job
    from shopgauge.schemas import RAW_EVENTS
    from shopgauge.sources import tables
    from shopgauge.sources.driver_tables import web_shards

    path = str(tmp_path_factory.mktemp("raw") / "events")
    tables.reload_days(raw.raw_events(web_shards(spark, SF)), path, cluster_by=job.EVENT_ORDER)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    yield tables.read_table(spark, path, RAW_EVENTS)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_stored_events_are_read_by_leaf_and_day(stored_events):
    from shopgauge.operators import staging

    day = stored_events.where("source_table_suffix = '20240105'")
    plan = plan_of(staging.purchases(day))
    assert "(source_table_suffix" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "EqualTo(event_name,purchase)" in plan
    assert "device:struct<category:string>" in plan
    assert "geo:struct<country:string,city:string>" in plan
    assert "user_properties" not in plan and "privacy_info" not in plan


def test_purchases_shuffle_once(stored_events):
    from shopgauge.operators import staging

    assert plan_of(staging.purchases(stored_events)).count("Exchange") == 1
    assert plan_of(staging.sessions(stored_events)).count("Exchange") == 1


class _Session:
    """As much of a session as the scratch folder looks at."""

    def __init__(self, folder: str | None, master: str):
        settings = {"spark.checkpoint.dir": folder} if folder else {}
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.get = settings.get
        self.getConf = lambda: self


def test_scratch_folder_is_the_one_the_session_names():
    from shopgauge.session import scratch_folder

    assert scratch_folder(_Session("/shared/place", "yarn")) == "/shared/place"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(_Session(None, "yarn"))
    local = _Session(None, "local[2]")
    assert scratch_folder(local) == scratch_folder(local)
