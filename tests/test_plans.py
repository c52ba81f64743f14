"""Plans: what is read, what is shuffled, and that no step gathers all rows."""

import re

from tidewire.operators.ordering import add_sequence, find_gaps, flag_stale
from tidewire.operators.rolling import rolling_average
from tidewire.operators.verify import verify_signatures
from tidewire.plans.catalogue import casts, processed, queries
from tidewire.plans.views import CHARTS, events
from tidewire.operators.charts import chart_feed
from tidewire import workspace
from tidewire.workspace import materialise, new_path, shared_root

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def count(text, pattern):
    return len(re.findall(pattern, text.split("\n\n")[0]))


def numbered(spark):
    return add_sequence(events(spark, SF).select("event_id", "value"), "event_id", "n", unique=True)


def test_rolling_shuffles_once(spark):
    text = plan(rolling_average(numbered(spark), "n", "value", 10))
    assert count(text, r"\bExchange") == 1 and "SinglePartition" not in text
    assert "hashpartitioning(__bucket" in text


def test_numbering_and_averaging_shuffle_all_rows_once(spark):
    """One exchange has the rows; the other two have counts of stretches."""
    text = plan(processed(spark, SF))
    exchanged = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
    assert len([c for c in exchanged if "metric_value" in c or "event_id" in c]) == 1


def test_scans_read_only_what_is_needed(spark):
    signed = events(spark, SF).selectExpr("event_id", "value metric_value", "'x' security_hash")
    text = plan(verify_signatures(signed, "k", 1, route="native"))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text
    read = numbered(spark).select("n")
    assert "ReadSchema: struct<n:bigint>" in plan(read) and sorted(find_gaps(read, "n").collect()) == []


def test_filters_reach_the_scan(spark):
    stored = materialise(events(spark, SF).selectExpr("*", "event_id % 2 = 0 as verified"), "t")
    text = plan(rolling_average(stored.filter("verified"), "event_id", "value", 3))
    assert "PushedFilters: [IsNotNull(verified), EqualTo(verified,true)]" in text


def test_only_one_row_per_stretch_comes_together(spark):
    """The one-partition step works on the aggregate of the stretches, not on rows."""
    frame = events(spark, SF).selectExpr("event_id", "cast(user_id as double) arrival")
    text = plan(flag_stale(frame, "event_id", "arrival"))
    gathered = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: SinglePartition", text)
    assert [re.sub(r"#\d+L?", "", columns) for columns in gathered] == ["__bucket, __first"]


def test_charts_keep_a_bounded_top(spark):
    df = numbered(spark).selectExpr(
        "n priority_index", "event_id time_period", "value metric_value", "value computed_metric"
    )
    text = plan(chart_feed(df, CHARTS))
    assert count(text, "TakeOrderedAndProject") == 2 and count(text, r"Scan parquet") == 2


def test_no_cartesian_products(spark):
    for name in ("flagship", "find_gaps", "reject_stale", "verify_signatures_table", "chart_feed", "resequence"):
        text = plan(queries()[name](spark, SF))
        assert "Cartesian" not in text and "NestedLoop" not in text, name


def test_casts_run_once_per_row(spark):
    text = plan(casts(spark, SF).filter("`reading__ok`").select("event_id", "reading__cast"))
    assert text.count("try_cast(replace(regexp_extract(") <= 4


def test_no_python_in_the_flagship(spark):
    text = plan(processed(spark, SF))
    assert "Python" not in text and "Arrow" not in text


def test_shared_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert named is None or shared_root(spark) == named.rstrip("/")
    assert new_path(spark, "x").startswith(f"{shared_root(spark)}/tidewire/{spark.sparkContext.applicationId}/x-")


def test_shared_folder_of_our_own_where_none_is_named(spark, monkeypatch):
    made = []

    class Context:
        master = "local[2]"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return made[0] if made else None

        def setCheckpointDir(self, path):
            made.append(path)

    class Session:
        conf = {}
        sparkContext = Context()

    assert shared_root(Session()) == shared_root(Session()) == made[0]
    assert len(made) == 1


def test_clear(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_root", lambda spark: str(tmp_path))
    assert workspace.materialise(spark.range(5), "t").count() == 5
    (tmp_path / "tidewire" / "other").mkdir()
    assert len(list((tmp_path / "tidewire").iterdir())) == 2
    workspace.clear(spark)
    assert [p.name for p in (tmp_path / "tidewire").iterdir()] == ["other"]
