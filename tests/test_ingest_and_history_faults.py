"""Faults that must be seen: deliveries that do not fit, lost log reads, batches that are not keyed, stale sources."""

import datetime as dt

import pytest

from tidemark.context import RunContext, scratch_path
from tidemark.operators import history as H
from tidemark.plans import catalog
from tidemark.plans.pipeline import Pipeline
from tidemark.sources import bronze as B
from tidemark.sources import fixtures as FX
from tidemark.sources.schemas import BRONZE_SCHEMAS

from conftest import SMALL

HEADER = "account_id,account_name,industry,country,signup_date,referral_source,plan_tier,seats,is_trial,churn_flag"
ROW = "A-1,Ann,ind,NL,2000-01-02,ads,Pro,3,false,true"


def landed(tmp_path, *lines):
    path = tmp_path / "accounts.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_columns_are_matched_by_name(spark, tmp_path):
    order = list(reversed(HEADER.split(",")))
    values = dict(zip(HEADER.split(","), ROW.split(",")))
    path = landed(tmp_path, ",".join([*order, "extra"]), ",".join([*(values[c] for c in order), "x"]))
    got = B.read_csv(spark, path, "accounts")
    assert got.columns == BRONZE_SCHEMAS["accounts"].fieldNames()
    row = got.first()
    assert (row["account_id"], row["signup_date"], row["seats"], row["churn_flag"]) == ("A-1", dt.date(2000, 1, 2), 3, True)


def test_missing_column_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="plan_tier"):
        B.read_csv(spark, landed(tmp_path, HEADER.replace("plan_tier,", ""), ROW.replace("Pro,", "")), "accounts")


def delivered(tmp_path, **files):
    for name, lines in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text("\n".join(lines) + "\n")
    return [str(tmp_path / name) for name in files]


def test_deliveries_with_different_headers_are_one_table(spark, tmp_path):
    without_tier = (HEADER.replace("plan_tier,", ""), ROW.replace("Pro,", "").replace("A-1", "A-2"))
    names, values = HEADER.split(","), ROW.replace("A-1", "A-3").replace("Pro", "").split(",")
    reordered = (",".join(["extra", *reversed(names)]), ",".join(["x", *reversed(values)]))
    delivered(tmp_path, d1=(HEADER, ROW), d2=without_tier, d3=reordered, d4=(HEADER, ROW.replace("A-1", "A-4")), _draft=("a", "b"))
    paths = B.deliveries(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["d1", "d2", "d3", "d4"]
    got = B.read_deliveries(spark, paths, "accounts", {"plan_tier": "Basic"})
    assert got.schema.fieldNames() == BRONZE_SCHEMAS["accounts"].fieldNames()
    assert [f.dataType for f in got.schema] == [f.dataType for f in BRONZE_SCHEMAS["accounts"]]
    # The default is for a column that a delivery lacks, not for an empty value.
    assert {r["account_id"]: r["plan_tier"] for r in got.collect()} == {"A-1": "Pro", "A-2": "Basic", "A-3": None, "A-4": "Pro"}
    assert {r["seats"] for r in got.collect()} == {3}
    assert len({f.rsplit("/", 2)[1] for f in got.inputFiles()}) == 4
    assert B.read_deliveries(spark, [], "accounts").count() == 0


def test_deliveries_lack_no_column_without_a_default(spark, tmp_path):
    paths = delivered(tmp_path, d1=(HEADER, ROW), d2=(HEADER.replace("plan_tier,", ""), ROW.replace("Pro,", "")))
    with pytest.raises(ValueError, match="plan_tier"):
        B.read_deliveries(spark, paths, "accounts", {"country": "NL"})
    with pytest.raises(ValueError, match="tier_of_plan"):
        B.read_deliveries(spark, paths, "accounts", {"tier_of_plan": "Basic"})
    with pytest.raises(ValueError, match="mergeSchema"):
        B.read_deliveries(spark, paths, "accounts", {"plan_tier": None}, mergeSchema="true")
    # A file whose header differs from the others of its delivery stops the load.
    (tmp_path / "d1" / "other.csv").write_text("\n".join([",".join(reversed(HEADER.split(","))), ROW]) + "\n")
    with pytest.raises(Exception, match="header|Header|HEADER"):
        B.read_deliveries(spark, paths, "accounts", {"plan_tier": None}).collect()


def test_malformed_value_stops_the_load_and_is_shown(spark, tmp_path):
    bad = ROW.replace(",3,", ",3.5,").replace("A-1", "A-2")
    path = landed(tmp_path, HEADER, ROW, bad)
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        B.read_csv(spark, path, "accounts").collect()
    assert [r["line"] for r in B.malformed_rows(spark, path, "accounts").collect()] == [bad]


def test_types_can_be_inferred(spark, tmp_path):
    got = B.read_csv(spark, landed(tmp_path, HEADER, ROW.replace(",3,", ",3.5,")), "accounts", infer=True)
    assert got.first()["seats"] == 3.5


def test_default_clock_is_now(spark):
    p = Pipeline.from_bronze_tables(spark, "/nowhere")
    assert abs((p.ctx.run_ts - RunContext.now().run_ts).total_seconds()) < 600
    assert Pipeline.from_catalog(spark, "nowhere").ctx.as_of_date >= dt.date(2024, 1, 1)


def test_second_read_sees_appended_rows(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t.parquet"))
    assert FX.read_table(spark, str(tmp_path), "t").count() == 5
    spark.range(5).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert FX.read_table(spark, str(tmp_path), "t").count() == 10


def batch(spark, *ids):
    types = {f.name: f.dataType.simpleString() for f in Pipeline.from_driver_tables(spark, SMALL).stg_subscriptions.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in H.SNAPSHOT_COLUMNS)
    return spark.createDataFrame([tuple(i if c == H.KEY else None for c in H.SNAPSHOT_COLUMNS) for i in ids], schema)


def test_unreadable_log_is_not_an_empty_history(spark):
    store = H.HistoryStore(spark, scratch_path(spark, "fault-history"))
    store.apply(batch(spark, "S-1"), "2001-10-01 00:00:00")
    fs, path = store._file(f"{store._log()}/000000002")
    fs.mkdirs(path)  # not a file: the log cannot be read as text
    fs.create(store._file(f"{store._log()}/000000002/x")[1], False).close()
    with pytest.raises(Exception):
        store.apply(batch(spark, "S-1", "S-2"), "2001-11-01 00:00:00")


def test_unkeyed_batches_are_refused(spark):
    store = H.HistoryStore(spark, scratch_path(spark, "fault-history"))
    for ids in (("S-1", "S-1"), ("S-1", None)):
        with pytest.raises(ValueError, match="one row per"):
            store.apply(batch(spark, *ids), "2001-10-01 00:00:00")
    assert store.state() is None


def test_a_sequence_number_is_used_once(spark):
    store = H.HistoryStore(spark, scratch_path(spark, "fault-history"))
    store.apply(batch(spark, "S-1"), "2001-10-01 00:00:00")
    with pytest.raises(Exception, match="exist"):
        store._claim(1, "another")
    assert store.state()[0] == 1


def test_null_keys_open_no_version(spark):
    assert H.open_versions(batch(spark, "S-1", None), "2001-10-01 00:00:00").count() == 1


EAGER = ("dq_", "bronze_", "snap_subscriptions_stored", "snap_late_batch", "support_percentiles_merged", "stored_", "bucketed_", "catalog_", "usage_lookup_", "monthly_")  # these write what they then read


@pytest.mark.parametrize("name", [n for n in sorted(catalog.queries()) if not n.startswith(EAGER) and "quality" not in n])
def test_building_a_query_starts_no_aggregate_job(spark, name):
    """Building a plan lists files and reads footers, and nothing else."""
    tracker, group = spark.sparkContext.statusTracker(), f"plan-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        catalog.queries()[name](spark, SMALL)
        jobs = tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # One job per resolved Parquet source at the most: the schema of its footer.
    assert len(jobs) <= 6
