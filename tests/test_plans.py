"""Plans that must hold at scale."""

import re

import pytest

from feedhouse.catalog import relations as rel
from feedhouse.catalog.quality import enriched_feed, loaded_before
from feedhouse.operators import quality, rules
from feedhouse.operators.mapping import map_rows
from feedhouse.plans import analytics
from feedhouse.sources.tables import Warehouse, settle

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_the_row_path(spark):
    mapped = map_rows(quality.clean_rows(enriched_feed(spark, SF_DIR))).customers
    validated = rules.validate(rel.customer_feed(spark, SF_DIR))
    for df in (mapped, validated):
        assert "Python" not in plan(df)


def test_rules_shuffle_nothing(spark):
    assert "Exchange" not in plan(rules.validate(rel.customer_feed(spark, SF_DIR)))


def test_duplicates_need_no_window_and_combine_first(spark):
    feed = rel.customer_feed(spark, SF_DIR)
    keyed = quality.with_keys(feed)
    text = plan(quality.hash_profile(keyed, loaded_before(feed), "_rowNumber"))
    assert "Window" not in text
    assert "partial_min" in text and "partial_count" in text


def test_small_key_tables_are_broadcast(spark):
    text = plan(enriched_feed(spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_views_meet_dimensions_after_combining(spark):
    facts = rel.fact_customer_imports(spark, SF_DIR)
    customers, countries = rel.dim_customer(spark, SF_DIR), rel.dim_country(spark, SF_DIR)
    for df in (
        analytics.customer_by_country(facts, customers, countries),
        analytics.daily_import_volume(facts, rel.dim_import_date(spark, SF_DIR)),
        analytics.company_size_distribution(customers),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "Expand" not in text


def test_top_k_sorts_and_cuts_in_one_step(spark):
    assert "TakeOrderedAndProject" in plan(analytics.worst_runs(rel.pipeline_runs(spark, SF_DIR)))


def test_recent_days_prune_both_sides(spark, tmp_path):
    facts = rel.fact_customer_imports(spark, SF_DIR)
    stored = settle(facts, "facts", str(tmp_path / "facts")).frame
    text = plan(analytics.recent_daily_volume(stored, rel.dim_import_date(spark, SF_DIR), rel.RUN_AT.date()))
    assert "GreaterThanOrEqual(date_key,20010703)" in text


def test_scans_read_only_what_they_need(spark):
    text = plan(analytics.validity_summary(rel.fact_customer_imports(spark, SF_DIR)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("o_totalprice" not in s and "c_name" not in s for s in schemas)


def test_month_folder_prunes_facts(spark, tmp_path):
    from feedhouse.plans.schemas import FACT
    from feedhouse.sources.tables import Written
    import datetime as dt

    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.create()
    for month in ("2024-01", "2024-02"):
        path = warehouse.new_path("fact_customer_imports", month, import_month=month)
        spark.createDataFrame([(1,)], "import_key bigint").write.parquet(path)
        warehouse.commit(month, {"fact_customer_imports": Written(path)}, dt.datetime.now())
    read = warehouse.read("fact_customer_imports", FACT)
    assert sorted(r.import_month for r in read.collect()) == ["2024-01", "2024-02"]
    one = read.where("import_month = '2024-02'")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(import_month" in plan(one)


@pytest.mark.parametrize("name", list(analytics.VIEW_ORDER))
def test_views_are_unsorted_until_asked(spark, name):
    tables = {
        "pipeline_runs": rel.pipeline_runs(spark, SF_DIR),
        "fact_customer_imports": rel.fact_customer_imports(spark, SF_DIR),
        "dim_customer": rel.dim_customer(spark, SF_DIR),
        "dim_country": rel.dim_country(spark, SF_DIR),
        "dim_import_date": rel.dim_import_date(spark, SF_DIR),
    }
    view = analytics.views(tables)[name]
    assert "rangepartitioning" not in plan(view)
    assert "DESC NULLS FIRST" in plan(analytics.ordered(view, name))
