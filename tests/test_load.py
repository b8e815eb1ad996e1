"""The load job end to end on a small feed."""

import datetime as dt
import functools
import json

import pytest
from pyspark.sql import functions as F

from feedhouse.fixed import EXPECTED_FIELDS
from feedhouse.operators import dimension
from feedhouse.plans import analytics, load
from feedhouse.plans.load import processed_staging, read_table, run_load, run_log, warehouse_tables
from feedhouse.sources.tables import Warehouse
from feedhouse.streaming.arrivals import ingest

AT = dt.datetime(2024, 2, 29, 10, tzinfo=dt.timezone.utc)
HEADER = ",".join(EXPECTED_FIELDS)


def line(n, **changes):
    values = dict(
        company_name=f" Firm {n} ", contact_email=f"U{n}@x.co", contact_first_name="A", contact_last_name="B",
        phone_number="555-0100 0", tax_id=f"T{n}", company_size="1-5", address=f'"{n} Road, ""West"""', city="C",
        country="us", postal_code="00187",
    )
    values.update(changes)
    return ",".join(values[f] for f in EXPECTED_FIELDS)


FEED = [
    line(1),
    line(2, country="JP"),
    line(1),
    line(3, contact_email="u1@X.co"),
    "only,three,fields",
    line(4, contact_email="bad"),
    line(5, contact_first_name=" "),
    line(6, country="Germany"),
    line(7, country="de"),
]


def write(path, lines):
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def deliver(customers):
    """Customer 7 is refused, customer 2 needs a second attempt."""
    attempts = customers.select("name", "email", "_rowOrder", F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"))
    refused = F.when(F.col("email") == "u7@x.co", 404)
    busy = F.when((F.col("email") == "u2@x.co") & (F.col("attempt") == 1), 503)
    return attempts.withColumns({"status": F.coalesce(refused, busy, F.lit(201)), "response_id": F.lit("id")})


def table(root, spark, name):
    return read_table(Warehouse(spark, root), name)


def test_load_twice(spark, tmp_path):
    feed, root = write(tmp_path / "f.csv", FEED), str(tmp_path / "wh")
    first = run_load(spark, feed, root, deliver=deliver, run_id="r1", run_at=AT)
    assert first.status == "partial"
    m = first.metrics
    assert (m.records_in_file, m.records_parsed, m.parse_error_count) == (9, 8, 1)
    assert (m.records_valid, m.records_invalid, m.records_new) == (6, 2, 8)
    assert (m.records_api_sent, m.records_api_success, m.records_api_failed, m.records_loaded) == (4, 3, 1, 4)
    assert first.counts == {
        "stagingAttempted": 8, "stagingLoaded": 7, "dimensionLoaded": 4, "factLoaded": 4, "errors": 0,
    }
    assert first.dq_report["summary"] == {
        "totalRows": 8, "cleanRows": 4, "rowsWithIssues": 4, "duplicatesFound": 1, "qualityScore": 50,
    }
    assert first.report["summary"]["overallFailed"] == 3
    stages = {r.stage: r["count"] for r in first.tables["errors"].groupBy("stage").count().collect()}
    assert stages == {"parse": 1, "validation": 2, "api": 1}
    assert [r.row_number for r in first.tables["errors"].where("stage = 'validation'").orderBy("row_number").collect()
            ] == [7, 8]

    staged = table(root, spark, "stg_customers").orderBy("source_row").collect()
    assert [r.source_row for r in staged] == [2, 3, 5, 7, 8, 9, 10]
    assert staged[0].address == '1 Road, "West"' and staged[0].postal_code == "00187"
    assert staged[2].quality_issues == '["DUPLICATE_EMAIL:u1@x.co"]' and not staged[2].is_valid
    facts = {r.customer_key: r for r in table(root, spark, "fact_customer_imports").collect()}
    people = {r.contact_email: r for r in table(root, spark, "dim_customer").collect()}
    assert sorted(people) == ["u1@x.co", "u2@x.co", "u5@x.co", "u7@x.co"]
    assert [people[e].customer_key for e in sorted(people)] == [1, 2, 3, 4]
    by_email = {e: facts[p.customer_key] for e, p in people.items()}
    assert by_email["u2@x.co"].country_key is None and by_email["u1@x.co"].country_key is not None
    assert (by_email["u2@x.co"].api_attempts, by_email["u7@x.co"].api_attempts) == (2, 3)
    assert (by_email["u7@x.co"].api_sent, by_email["u7@x.co"].api_success) == (True, False)
    assert {(f.date_key, f.import_month, f.source_row > 1) for f in facts.values()} == {(20240229, "2024-02", True)}

    again = run_load(spark, feed, root, deliver=deliver, run_id="r2", run_at=AT + dt.timedelta(days=1))
    assert (again.metrics.records_new, again.metrics.records_loaded, again.counts) == (0, 0, {})
    assert again.dq_report["summary"]["duplicatesFound"] == 8
    assert table(root, spark, "stg_customers").count() == 7

    more = write(tmp_path / "g.csv", [line(1, tax_id="NEW", city="Elsewhere"), line(8)])
    third = run_load(spark, more, root, run_id="r3", run_at=AT + dt.timedelta(days=2))
    assert third.status == "success" and third.metrics.records_api_sent == 2
    people = {r.contact_email: r for r in table(root, spark, "dim_customer").collect()}
    assert len(people) == 5 and people["u8@x.co"].customer_key == 5
    assert (people["u1@x.co"].tax_id, people["u1@x.co"].city, people["u1@x.co"].source_run_id) == (
        "T1", "Elsewhere", "r3",
    )
    keys = [r.import_key for r in table(root, spark, "fact_customer_imports").collect()]
    assert len(keys) == len(set(keys)) == 6
    stg_keys = [r.stg_id for r in table(root, spark, "stg_customers").collect()]
    assert len(stg_keys) == len(set(stg_keys)) == 9

    processed = processed_staging(Warehouse(spark, root)).collect()
    assert all(r.is_processed and r.processed_at for r in processed)
    views = analytics.register_views(spark, warehouse_tables(Warehouse(spark, root)))
    assert "vw_pipeline_health" in views
    top = spark.sql("select * from vw_customer_by_country order by unique_customers desc").collect()
    assert (top[0].country, top[0].unique_customers, top[0].total_imports) == ("United States", 3, 4)
    assert spark.sql("select sum(total_imports) from vw_daily_import_volume").first()[0] == 6


def test_full_reload_and_valid_gate(spark, tmp_path):
    feed, root = write(tmp_path / "f.csv", FEED), str(tmp_path / "wh")
    run_load(spark, feed, root, run_id="r1", run_at=AT, gate="valid")
    # Rows 2, 4 and 5 share an email: one customer, three facts; the last row gives the values.
    assert table(root, spark, "fact_customer_imports").count() == 6
    person = table(root, spark, "dim_customer").where("contact_email = 'u1@x.co'").first()
    assert (person.company_name, person.tax_id) == ("Firm 3", "T1")
    reload = run_load(spark, feed, root, run_id="r2", run_at=AT, full_reload=True)
    assert reload.metrics.records_new == 8 and reload.counts["stagingLoaded"] == 0
    assert table(root, spark, "fact_customer_imports").count() == 10


def test_dry_run_writes_nothing(spark, tmp_path):
    feed, root = write(tmp_path / "f.csv", FEED), tmp_path / "wh"
    result = run_load(spark, feed, str(root), dry_run=True, deliver=deliver)
    assert result.metrics.records_new == 8 and result.metrics.records_api_success == 0
    assert result.tables["customers"].count() == 4
    assert not root.exists()


def test_delivery_without_a_warehouse(spark, tmp_path):
    result = run_load(spark, write(tmp_path / "f.csv", FEED), gate="valid", deliver=deliver)
    assert (result.metrics.records_api_sent, result.metrics.records_api_failed, result.counts) == (6, 1, {})
    assert result.tables["delivered"].count() == 5
    assert '"apiFailed": 1' in spark.read.text(f"{result.folder}/report").first()[0]


def test_failed_run_leaves_the_tables_and_can_be_repeated(spark, tmp_path, monkeypatch):
    feed, root = write(tmp_path / "f.csv", FEED), str(tmp_path / "wh")

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(load, "_load_facts", broken)
        with pytest.raises(RuntimeError, match="lost"):
            run_load(spark, feed, root, run_id="r1", run_at=AT)
    warehouse = Warehouse(spark, root)
    state = run_log(warehouse).first()
    assert (state.status, state.error_message) == ("failed", "lost")
    assert read_table(warehouse, "stg_customers") is None and read_table(warehouse, "dim_customer") is None
    again = run_load(spark, feed, root, run_id="r1", run_at=AT)
    assert again.metrics.records_loaded == 4
    state = run_log(warehouse).collect()
    assert [(r.run_id, r.status, r.records_loaded) for r in state] == [("r1", "success", 4)]


def test_day_outside_the_date_dimension_is_an_error_not_a_failure(spark, tmp_path):
    feed, root = write(tmp_path / "f.csv", FEED), str(tmp_path / "wh")
    result = run_load(spark, feed, root, run_id="r1", run_at=dt.datetime(2031, 1, 1))
    assert (result.counts["factLoaded"], result.counts["errors"]) == (0, 4)


def test_over_long_values_are_rejected_whole(spark, tmp_path):
    feed, root = write(tmp_path / "f.csv", [line(1), line(2, postal_code="9" * 51)]), str(tmp_path / "wh")
    result = run_load(spark, feed, root, run_id="r1", run_at=AT)
    assert result.counts == {
        "stagingAttempted": 2, "stagingLoaded": 1, "dimensionLoaded": 1, "factLoaded": 1, "errors": 2,
    }


def test_missing_and_extra_columns(spark, tmp_path):
    (tmp_path / "f.csv").write_text("company_name, contact_email ,legacy\nAcme,a@b.co,1\n")
    result = run_load(spark, str(tmp_path / "f.csv"), str(tmp_path / "wh"), run_id="r1", run_at=AT)
    drift = result.dq_report["schemaDrift"]
    assert drift["unexpectedFields"] == [" contact_email ", "legacy"] and "contact_email" in drift["missingFields"]
    assert result.dq_report["nullPercentages"]["city"] == 100 and result.dq_report["nullPercentages"]["company_name"] == 0
    assert result.metrics.records_loaded == 1


def test_only_malformed_rows(spark, tmp_path):
    feed = write(tmp_path / "f.csv", ["a,b", "c"])
    result = run_load(spark, feed, str(tmp_path / "wh"), run_id="r1", run_at=AT)
    assert (result.metrics.records_in_file, result.metrics.records_parsed, result.metrics.success_rate) == (2, 0, 0.0)
    assert result.dq_report["summary"]["qualityScore"] == 100 and result.status == "success"


def test_own_rules_and_mapping(spark, tmp_path):
    """Other rules, and a mapping without an email: its customers can have no key."""
    config = {
        "validationRules": {"required": ["tax_id"]},
        "fieldMappings": {"name": {"from": "company_name", "transform": "caps"}},
        "transforms": {"caps": "upper(trim(value))"},
    }
    feed, root = write(tmp_path / "f.csv", FEED), str(tmp_path / "wh")
    result = run_load(spark, feed, root, config=config, gate="valid", run_id="r1", run_at=AT)
    assert result.metrics.records_valid == 8
    assert {r.name for r in result.tables["customers"].collect()} == {f"FIRM {i}" for i in range(1, 8)}
    assert (result.counts["dimensionLoaded"], result.counts["factLoaded"], result.counts["errors"]) == (0, 0, 8)


def test_arrivals_are_loaded_once(spark, tmp_path):
    arrivals, root = tmp_path / "in", str(tmp_path / "wh")
    arrivals.mkdir()
    write(arrivals / "a.csv", FEED)
    write(arrivals / "b.csv", [line(20), line(1)])
    (first,) = ingest(spark, str(arrivals), root, run_id="r1", run_at=AT)
    # The row that both files have was loaded by the first of them.
    assert (first.metrics.records_parsed, first.metrics.records_new) == (10, 9)
    assert first.dq_report["summary"]["duplicatesFound"] == 2
    assert ingest(spark, str(arrivals), root) == []
    write(arrivals / "c.csv", [line(21), line(2)])
    (second,) = ingest(spark, str(arrivals), root, run_id="r2", run_at=AT)
    assert (second.metrics.records_parsed, second.metrics.records_new) == (2, 1)
    assert table(root, spark, "dim_customer").count() == 6


def test_bad_files_keep_no_good_file_back(spark, tmp_path):
    arrivals, root = tmp_path / "in", str(tmp_path / "wh")
    arrivals.mkdir()
    write(arrivals / "a.csv", [line(1)])
    (arrivals / "b.csv").write_text("company_name,contact_email,a.b\nAcme,a@b.co,1\n")
    (arrivals / "c.csv").write_text(HEADER + "\n")
    (arrivals / "d.csv").write_text("\n \n")
    write(arrivals / "e.csv", [line(2)])
    (result,) = ingest(spark, str(arrivals), root, run_id="r1", run_at=AT)
    assert result.metrics.records_parsed == 3
    log = {r.source_file.split("/")[-1]: r for r in run_log(Warehouse(spark, root)).collect()}
    assert {f: r.status for f, r in log.items()} == {
        "a.csv": "success", "b.csv": "success", "c.csv": "failed", "d.csv": "failed", "e.csv": "success"}
    assert log["c.csv"].error_message == log["d.csv"].error_message and "data line" in log["c.csv"].error_message
    assert table(root, spark, "fact_customer_imports").count() == 3
    write(arrivals / "f.csv", [line(3)])
    assert [r.metrics.records_parsed for r in ingest(spark, str(arrivals), root)] == [1]
    assert not [p for p in (tmp_path / "wh" / "landing" / "lines").iterdir() if p.name.startswith("batch")]


def test_files_together_equal_files_one_by_one(spark, tmp_path):
    one = write(tmp_path / "1.csv", [line(1, company_name="Old", country="US"), line(2)])
    two = write(tmp_path / "2.csv", [line(1, company_name="New", country="DE", tax_id=""), line(3)])
    run_load(spark, one, str(tmp_path / "a"), run_id="r1", run_at=AT)
    run_load(spark, two, str(tmp_path / "a"), run_id="r2", run_at=AT)
    together = run_load(spark, [one, two], str(tmp_path / "b"), run_id="r1", run_at=AT)
    assert together.dq_report["summary"]["rowsWithIssues"] == 0
    columns = ["contact_email", "company_name", "country_code", "tax_id"]
    a, b = (sorted(map(tuple, table(str(tmp_path / r), spark, "dim_customer").select(columns).collect())) for r in "ab")
    assert a == b and ("u1@x.co", "New", "DE", "T1") in b
    assert [table(str(tmp_path / r), spark, "fact_customer_imports").count() for r in "ab"] == [4, 4]


def repeated_files(tmp_path):
    """Rows that come again within a file, in later files, and in files that staging refuses them from."""
    long = "9" * 101
    return [
        write(tmp_path / "1.csv", [line(1), line(2), line(2), line(5, tax_id=long), line(6, company_name="", country="")]),
        write(tmp_path / "2.csv", [line(2), line(3), line(5, tax_id=long), line(5, tax_id=long), line(6, company_name="")]),
        write(tmp_path / "3.csv", [line(3), line(1), line(4), line(5, tax_id=long), line(4)]),
    ]


@pytest.mark.parametrize("gate, full_reload", [("valid", False), ("valid", True), ("clean", False)])
def test_rows_of_an_earlier_file_count_as_loaded(spark, tmp_path, gate, full_reload):
    files = repeated_files(tmp_path)
    single = [run_load(spark, f, str(tmp_path / "a"), gate=gate, full_reload=full_reload, run_id=f"r{i}", run_at=AT)
              for i, f in enumerate(files)]
    together = run_load(spark, files, str(tmp_path / "b"), gate=gate, full_reload=full_reload, run_id="r", run_at=AT)

    def found(name, *columns):
        return [sorted(map(tuple, table(str(tmp_path / r), spark, name).select(*columns).collect())) for r in "ab"]

    for name, *columns in [
        ("stg_customers", "source_file", "source_row", "source_hash", "is_valid", "quality_issues"),
        ("dim_customer", "contact_email", "company_name", "country_code", "tax_id"),
        ("fact_customer_imports", "source_file", "source_row", "was_valid", "date_key"),
    ]:
        one_by_one, at_once = found(name, *columns)
        assert one_by_one == at_once
    for count in ("stagingAttempted", "stagingLoaded", "dimensionLoaded", "factLoaded"):
        assert sum(r.counts.get(count, 0) for r in single) == together.counts[count]
    for figure in ("records_new", "records_valid", "records_api_sent", "records_loaded"):
        assert sum(getattr(r.metrics, figure) for r in single) == getattr(together.metrics, figure)
    for figure in ("duplicatesFound", "cleanRows"):
        assert sum(r.dq_report["summary"][figure] for r in single) == together.dq_report["summary"][figure]
    rows = together.tables["rows"]
    assert [r.n for r in rows.groupBy("_loaded").agg(F.count("*").alias("n")).orderBy("_loaded").collect()] == (
        [15] if full_reload else [11, 4])


def test_small_loads_write_touched_buckets_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(load, "Warehouse", functools.partial(Warehouse, bucket_rows=10))
    root = str(tmp_path / "wh")
    run_load(spark, write(tmp_path / "a.csv", [line(i) for i in range(60)]), root, run_id="r1", run_at=AT)
    warehouse = Warehouse(spark, root, bucket_rows=10)
    assert warehouse.bucketing("dim_customer") == (32, 60)
    before = set(warehouse.live_paths("dim_customer"))
    later = [line(7, company_name="New", tax_id="other"), line(100)]
    run_load(spark, write(tmp_path / "b.csv", later), root, run_id="r2", run_at=AT)
    warehouse.refresh()
    assert warehouse.bucketing("dim_customer") == (32, 61)
    after = set(warehouse.live_paths("dim_customer"))
    (second,) = [p for p in (tmp_path / "wh" / "dim_customer").iterdir() if any(str(p) in a for a in after - before)]
    written = sorted(p.name for p in second.iterdir() if p.name.startswith("bucket"))
    assert 1 <= len(written) <= 2 and len(after - before) == len(written) and len(before - after) <= 2
    people = {r.contact_email: r for r in table(root, spark, "dim_customer").collect()}
    assert len(people) == 61 and sorted(p.customer_key for p in people.values()) == list(range(1, 62))
    assert (people["u7@x.co"].company_name, people["u7@x.co"].tax_id, people["u100@x.co"].customer_key) == ("New", "T7", 61)
    for b, emails in ((int(n.split("=")[1]), warehouse.read("dim_customer", load.TABLES["dim_customer"], [int(n.split("=")[1])]))
                      for n in written):
        assert emails.where(dimension.bucket_of(F.col("contact_email"), 32) != b).count() == 0
    # Buckets that were replaced go, and nothing that is in force does.
    gone = warehouse.vacuum(keep=0)
    assert all("bucket=" in g for g in gone) and len(gone) == len(before - after)
    assert table(root, spark, "dim_customer").count() == 61


def test_many_files_are_one_set_of_jobs(spark, tmp_path):
    """A run per file, whatever its header; jobs do not grow with the files."""
    header = "tax_id,company_name,contact_email,a.b"
    config = {"validationRules": {"required": ["company_name", "contact_email"], "nonEmpty": ["a.b"]}}

    def arrive(folder, files):
        folder.mkdir()
        for i in range(files):
            if i % 10 == 3:
                (folder / f"{i:04}.csv").write_text(["\n", header + "\n", "\n \n"][i // 10 % 3])
            elif i % 2:
                (folder / f"{i:04}.csv").write_text(f"{header}\nT{i},Firm {i},m{i}@x.co,{'' if i % 4 == 1 else 'y'}\nshort\n")
            else:
                write(folder / f"{i:04}.csv", [line(i), line(i // 4)])
        first = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
        (result,) = ingest(spark, str(folder), str(folder) + "-wh", config=config, gate="valid", run_id="L", run_at=AT)
        return result, spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - first

    few, jobs_few = arrive(tmp_path / "few", 10)
    many, jobs_many = arrive(tmp_path / "many", 120)
    assert jobs_many <= jobs_few + 5
    root = str(tmp_path / "many-wh")
    log = {r.source_file.split("/")[-1]: r for r in run_log(Warehouse(spark, root)).collect()}
    assert len(log) == 120 and len({r.run_id for r in log.values()}) == 120
    assert {f for f, r in log.items() if r.status == "failed"} == {f"{i:04}.csv" for i in range(3, 120, 10)}
    odd, even = log["0005.csv"], log["0008.csv"]
    assert (odd.records_in_file, odd.records_parsed, odd.records_invalid, odd.parse_error_count) == (2, 1, 1, 1)
    # Row 2 of file 8 came with file 2 before.
    assert (even.records_parsed, even.records_valid, even.records_new, even.records_loaded) == (2, 2, 1, 1)
    single = run_load(spark, str(tmp_path / "many" / "0005.csv"), config=config, gate="valid", run_at=AT, dry_run=True)
    assert json.loads(odd.dq_report) == single.dq_report
    assert many.metrics.records_loaded == sum(r.records_loaded or 0 for r in log.values())
    facts = table(root, spark, "fact_customer_imports").collect()
    assert {(f.source_file.split("/")[-1], f.pipeline_run_id) for f in facts} <= {(f, r.run_id) for f, r in log.items()}
    people = table(root, spark, "dim_customer").where("contact_email = 'u8@x.co'").first()
    assert people.source_run_id == log["0032.csv"].run_id or people.source_run_id == log["0008.csv"].run_id
    processed = processed_staging(Warehouse(spark, root))
    assert processed.where("not is_processed").count() == 0 and processed.count() > 0


def test_condition_on_the_view_prunes_months(spark, tmp_path):
    root = str(tmp_path / "wh")
    for i, day in enumerate([dt.datetime(2024, 1, 5), dt.datetime(2024, 3, 5)]):
        run_load(spark, write(tmp_path / f"{i}.csv", [line(i)]), root, run_id=f"r{i}", run_at=day)
    analytics.register_views(spark, warehouse_tables(Warehouse(spark, root)))
    recent = spark.sql("select * from vw_daily_import_volume where full_date >= date '2024-03-01'")
    assert [r.total_imports for r in recent.collect()] == [1]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.split("import_month")[0] or "dynamicpruning" in plan


def test_rules_on_any_header(spark, tmp_path):
    (tmp_path / "f.csv").write_text("company_name,n,a.b,N,errors\nAcme,1, ,x@y.co,\nBeta,,2,bad,z\n")
    config = {"validationRules": {"required": ["n", "a.b", "absent"], "email": ["N"], "nonEmpty": ["errors", "other"]}}
    result = run_load(spark, str(tmp_path / "f.csv"), config=config, gate="valid")
    missing = lambda f: f'Missing required field: "{f}"'
    assert [r.errors for r in result.tables["rows"].orderBy("_rowNumber").collect()] == [
        [missing("a.b"), missing("absent"), 'Field "errors" must not be empty.'],
        [missing("n"), missing("absent"), 'Invalid email format in field "N": "bad"']]


def test_run_log_names_all_files_and_whole_errors(spark, tmp_path, monkeypatch):
    feeds = [write(tmp_path / f"{i}.csv", [line(i)]) for i in range(5)]
    run_load(spark, feeds, str(tmp_path / "wh"), run_id="r1", run_at=AT)
    assert run_log(Warehouse(spark, str(tmp_path / "wh"))).first().source_file == ", ".join(feeds)

    def broken(*args, **kwargs):
        raise RuntimeError("x" * 30_000)

    monkeypatch.setattr(load, "_load_staging", broken)
    with pytest.raises(RuntimeError):
        run_load(spark, write(tmp_path / "f.csv", [line(9)]), str(tmp_path / "wh"), run_id="r2", run_at=AT)
    assert len(run_log(Warehouse(spark, str(tmp_path / "wh"))).where("run_id = 'r2'").first().error_message) == 30_000


def test_blank_file_beside_a_good_one_is_refused(spark, tmp_path):
    (tmp_path / "blank.csv").write_text("\n\n")
    feeds = [write(tmp_path / "a.csv", [line(1)]), str(tmp_path / "blank.csv")]
    with pytest.raises(ValueError, match="blank.csv"):
        run_load(spark, feeds, str(tmp_path / "wh"))


def test_a_commit_in_between_is_noticed(spark, tmp_path):
    root = str(tmp_path / "wh")
    run_load(spark, write(tmp_path / "a.csv", [line(1)]), root, run_id="r1", run_at=AT)
    late = Warehouse(spark, root)
    assert late.last_key("dim_customer") == 1
    run_load(spark, write(tmp_path / "b.csv", [line(2)]), root, run_id="r2", run_at=AT)
    with pytest.raises(RuntimeError, match="another load"):
        late.commit("r3", {}, AT)


def test_empty_warehouse_can_be_read(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.create()
    assert all(t.count() == 0 for t in warehouse_tables(warehouse).values())
    assert processed_staging(warehouse).count() == 0


def test_feeds_go_after_the_run_and_vacuum_clears_the_rest(spark, tmp_path):
    root = tmp_path / "wh"
    for i in range(3):
        run_load(spark, write(tmp_path / f"{i}.csv", [line(i)]), str(root), run_id=f"r{i}", run_at=AT)
    assert not list(root.glob("runs/*/feed")) and not list(root.glob("runs/*/incoming"))
    (root / "stg_customers" / "load_id=lost").mkdir()
    gone = Warehouse(spark, str(root)).vacuum(keep=1)
    assert len(gone) == 2 and len(list(root.glob("dim_customer/load_id=*"))) == 2
    assert table(str(root), spark, "dim_customer").count() == 3
    assert table(str(root), spark, "stg_customers").count() == 3


def test_groups_only_and_redefined_transforms(spark, tmp_path):
    config = {
        "nestedMappings": {"contact": {"phone": {"from": "phone_number", "transform": "number"},
                                       "first": {"from": "contact_first_name", "transform": "trim"}}},
        "transforms": {"trim": "concat('<', value, '>')", "number": "cast(cast(value as int) + 1 as string)"},
    }
    feed = write(tmp_path / "f.csv", [line(1, phone_number="7"), line(2, phone_number="x")])
    result = run_load(spark, feed, config=config, gate="valid")
    rows = result.tables["customers"].orderBy("contact.phone").collect()
    assert "name" not in result.tables["customers"].columns
    assert [(r.contact.phone, r.contact.first) for r in rows] == [("8", "<A>"), ("x", "<A>")]


def test_row_issues_come_in_row_order(spark, tmp_path):
    feeds = [write(tmp_path / f"{n}.csv", [line(i, country="Nowhere") for i in range(30)]) for n in "ba"]
    issues = run_load(spark, feeds).tables["row_issues"].collect()
    places = [(r._sourceFile, r._rowNumber) for r in issues]
    assert len(places) == 60 and places == sorted(places)


def test_months_before_the_window_are_not_read(spark, tmp_path):
    root = str(tmp_path / "wh")
    for i, day in enumerate([dt.datetime(2024, 1, 5), dt.datetime(2024, 3, 5)]):
        run_load(spark, write(tmp_path / f"{i}.csv", [line(i)]), root, run_id=f"r{i}", run_at=day)
    tables = warehouse_tables(Warehouse(spark, root))
    volume = analytics.daily_import_volume(
        tables["fact_customer_imports"], tables["dim_import_date"], dt.date(2024, 3, 1))
    plan = volume._jdf.queryExecution().executedPlan().toString()
    assert "import_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert [r.total_imports for r in volume.collect()] == [1]


def test_any_header(spark, tmp_path):
    names = ["company_name", "contact_email", "n", "a.b", "a`b", "errors", "_block", "_firstRow", "Contact_Email", "field3"]
    (tmp_path / "f.csv").write_text(",".join(names) + "\n" + ",".join(["Acme", "a@b.co", *map(str, range(8))]) + "\n")
    config = {"validationRules": {"required": ["company_name"]},
              "fieldMappings": {"name": {"from": "company_name"}, "email": {"from": "contact_email"},
                                "one": {"from": "a.b"}, "two": {"from": "n"}, "three": {"from": "Contact_Email"}}}
    result = run_load(spark, str(tmp_path / "f.csv"), str(tmp_path / "wh"), config=config, gate="valid")
    row = result.tables["customers"].first()
    assert (row.name, row.email, row.one, row.two, row.three) == ("Acme", "a@b.co", "1", "0", "6")
    assert result.dq_report["schemaDrift"]["unexpectedFields"] == names[2:]
    assert [r.error for r in result.tables["errors"].collect()] == [
        r.error for r in result.tables["errors"].where("stage = 'validation'").collect()]


def test_broken_constraints_are_listed(spark, tmp_path):
    feed, root = write(tmp_path / "f.csv", [line(i) for i in range(4)]), str(tmp_path / "wh")
    run_load(spark, feed, root, run_id="r1", run_at=AT)
    warehouse = Warehouse(spark, root)
    assert load.constraint_errors(warehouse).count() == 0

    # Something else writes a row of the dimension once more, and takes countries and a fact's customer away.
    def behind(name, change):
        for path in warehouse.live_paths(name):
            rows = spark.read.parquet(path)
            rows = spark.createDataFrame(rows.collect(), rows.schema)
            change(rows).coalesce(1).write.mode("overwrite").parquet(path)

    behind("dim_customer", lambda d: d.where("contact_email <> 'u3@x.co'").unionByName(
        d.where("contact_email = 'u1@x.co'").withColumn("customer_key", F.lit(99).cast("bigint"))))
    behind("dim_country", lambda d: d.unionByName(d.where("country_code = 'US'")))
    found = {tuple(r) for r in load.constraint_errors(warehouse).collect()}
    lost = [r for r in found if r[0] == "fact"]
    assert ("dim_customer", "u1@x.co", "repeated contact_email (2 rows)") in found
    assert {e for s, _, e in found if s == "dim_country"} == {
        "repeated country_code (2 rows)", "repeated country_key (2 rows)"}
    assert len(lost) == 1 and lost[0][2].startswith("missing customer_key ")
    assert {r.stage for r in load.constraint_errors(warehouse, "2999-01").collect()} == {"dim_customer", "dim_country"}

    # A load lists the repeated email and does not multiply its facts.
    again = write(tmp_path / "g.csv", [line(1, company_name="New", tax_id="other")])
    result = run_load(spark, again, root, run_id="r2", run_at=AT)
    assert result.counts["factLoaded"] == 1 and result.counts["errors"] == 1
    errors = spark.read.parquet(f"{result.folder}/load_errors").collect()
    assert [(e.stage, e.key, e.error) for e in errors] == [("dim_customer", "u1@x.co", "repeated contact_email (2 rows)")]
