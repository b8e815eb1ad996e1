import datetime as dt
import hashlib
import random

from pyspark.sql import functions as F

from feedhouse.operators import checks, dimension, facts, history
from feedhouse.operators.ranks import dense_numbers
from feedhouse.sources import seeds, tables

AT = dt.datetime(2024, 1, 31, 23, 59, tzinfo=dt.timezone.utc)
FIELDS = ["company_name", "contact_first", "contact_last", "phone_number", "company_size", "address", "city",
          "country_code", "postal_code"]
INCOMING = "_rowNumber bigint, contact_email string, tax_id string, " + ", ".join(f"{f} string" for f in FIELDS)


def replay(state, batch):
    """Row-by-row upsert on a dict keyed by email."""
    state = {k: dict(v) for k, v in state.items()}
    known = set(state)
    for r in batch:
        values = dict(zip(FIELDS, r[3:]))
        if r[1] in state:
            state[r[1]].update(values)
        else:
            state[r[1]] = {**values, "tax_id": r[2]}
    free = max((v["customer_key"] for v in state.values() if "customer_key" in v), default=0)
    for n, email in enumerate(sorted(set(state) - known)):
        state[email]["customer_key"] = free + 1 + n
    return state


def as_state(frame):
    return {r.contact_email: {f: r[f] for f in [*FIELDS, "tax_id", "customer_key"]} for r in frame.collect()}


def test_upserts_equal_a_replay(spark):
    rng = random.Random(3)
    state, current = {}, None
    for run in range(3):
        batch = [
            (i + 2, f"u{rng.choice([0, 0, rng.randrange(40)])}@x.co", rng.choice([None, f"t{i}"]),
             *[rng.choice([None, f"{f}{i}"]) for f in FIELDS])
            for i in range(60)
        ]
        incoming = dimension.one_per_email(spark.createDataFrame(batch, INCOMING))
        assert incoming.agg(F.sum("n")).first()[0] == len(batch)
        merged = dimension.merge_customers(current, incoming, f"run{run}", AT)
        state = replay(state, batch)
        assert as_state(merged) == state
        again = dimension.merge_customers(merged, incoming, f"run{run}", AT)
        assert as_state(again) == as_state(dimension.merge_customers(again, incoming, f"run{run}", AT))
        current = spark.createDataFrame(merged.collect(), dimension.DIM_SCHEMA)


def test_kept_columns(spark):
    old = dt.datetime(2020, 1, 1)
    current = spark.createDataFrame(
        [(5, "Old", "a@b.co", None, None, None, "keep", None, None, None, None, None, old, old, "r0", False)],
        dimension.DIM_SCHEMA,
    )
    batch = spark.createDataFrame([(2, "a@b.co", "new", *["v"] * 9), (3, "c@d.co", None, *["w"] * 9)], INCOMING)
    merged = dimension.merge_customers(current, dimension.one_per_email(batch), "r1", AT)
    rows = {r.contact_email: r for r in merged.collect()}
    kept, new = rows["a@b.co"], rows["c@d.co"]
    assert (kept.customer_key, kept.tax_id, kept.first_seen_at, kept.is_active) == (5, "keep", old, False)
    assert (kept.company_name, kept.source_run_id, kept.last_updated_at) == ("v", "r1", AT.replace(tzinfo=None))
    assert (new.customer_key, new.tax_id, new.is_active) == (6, None, True)


def test_dense_numbers(spark):
    ids = [f"k{i * 7919 % 1000:04d}" for i in range(1000)]
    numbered = dense_numbers(spark.createDataFrame([(i,) for i in ids], "id string").repartition(5), "id", "n")
    assert {r.id: r.n for r in numbered.collect()} == {k: i + 1 for i, k in enumerate(sorted(ids))}


def test_date_dimension(spark):
    days = {r.date_key: r for r in seeds.date_dimension(spark).collect()}
    assert len(days) == 1826 and min(days) == 20230101 and max(days) == 20271231
    last = days[20270101]
    assert (last.week_of_year, last.day_of_week, last.day_name, last.is_weekend) == (53, 5, "Friday", False)
    assert days[20230101].day_of_week == 0 and days[20230101].is_weekend


def test_seed_insert_absent_is_idempotent(spark):
    seed = seeds.country_seed(spark)
    once = seeds.insert_absent(seed.limit(3), seed, "country_code")
    assert once.count() == 10
    assert seeds.insert_absent(once, seed, "country_code").count() == 10


def test_range_labels_are_half_open(spark):
    stamps = ["2024-01-01 00:00:00", "2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-03-01 00:00:00",
              "2025-06-30 12:00:00", "2025-07-01 00:00:00"]
    frame = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp").alias("t"))
    labels = [r[0] for r in frame.orderBy("t").select(facts.range_label(F.col("t"))).collect()]
    assert labels == ["2024_01", "2024_01", "2024_02", "default", "2025_q2", "default"]


def test_checks_split_rows(spark):
    data = spark.createDataFrame(
        [(1, "ab", 999.994), (2, "abc", 1.0), (3, None, 999.995), (4, "a", None)], "k int, t string, x double"
    )
    checked = checks.check_rows(data, not_null=["t"], lengths={"t": 2, "absent": 1}, ranges={"x": (5, 2)})
    assert [r.k for r in checks.accepted(checked).orderBy("k").collect()] == [1, 4]
    rejects = {r.key: r.error for r in checks.rejects(checked, "s", "k").collect()}
    assert rejects == {
        "2": "value too long for column t (2)",
        "3": "null value in column t; value out of range for column x (5,2)",
    }


def test_missing_reference_rows_are_whole_on_every_way(spark):
    data = spark.range(300).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id")).alias("ref")
    )
    known = spark.range(50).select(F.col("id").alias("key")).where("key <> 1")
    for how in ({}, {"broadcast_bytes": 0}):
        found = facts.reference_violations(data, "row", {"ref": (known, "key")}, **how).collect()
        expected = {i for i in range(300) if i % 3 == 0 or (i % 3 == 1 and (i >= 50 or i == 1))}
        assert {r.row for r in found} == expected and len(found) == len(expected)


def test_commit_log_is_read_from_its_last_snapshot(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SEGMENT_COMMITS", 4)
    warehouse = tables.Warehouse(spark, str(tmp_path))
    warehouse.create()
    for i in range(1, 11):
        written = {"grows": tables.Written(f"g{i}", last_key=i, rows=1)}
        if i % 3 == 0:
            written["whole"] = tables.Written(f"w{i}", replaces=True, last_key=100 - i)
        bucket = [0, 1, 2] if i == 1 else [i % 3]
        written["buckets"] = tables.Written(
            f"b{i}", replaces=True, last_key=50 if i == 2 else i, rows=i, bucket_count=3, buckets=bucket)
        warehouse.commit(f"r{i}", written, AT)
    late = tables.Warehouse(spark, str(tmp_path))
    folders = late.log_folders()
    assert [f.rsplit("/", 1)[1] for f in folders] == ["before=2", "segment=2"]
    assert late.live_paths("grows") == [f"g{i}" for i in range(1, 11)]
    assert late.live_paths("whole") == ["w9"] and late.last_key("whole") == 97
    assert sorted(late.live_paths("buckets")) == ["b10/bucket=1", "b8/bucket=2", "b9/bucket=0"]
    assert late.last_key("buckets") == 50 and late.bucketing("buckets") == (3, 10)
    assert late.commits().select("commit").distinct().count() == 10
    late.commit("more", {"buckets": tables.Written("b11", replaces=True, bucket_count=6, buckets=[0, 5], rows=9)}, AT)
    assert sorted(late.live_paths("buckets")) == ["b11/bucket=0", "b11/bucket=5"]


def test_events_are_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SEGMENT_FILES", 3)
    log = tables.EventLog(spark, str(tmp_path), "events", "n bigint")
    assert log.read().count() == 0
    for i in range(11):
        log.append(spark.createDataFrame([(i,)], "n bigint").coalesce(1))
        assert sorted(r.n for r in log.read().collect()) == list(range(i + 1))
    assert [f.rsplit("/", 1)[1] for f in log.folders()] == ["before=3", "segment=3"]
    assert sorted(p.name for p in (tmp_path / "events").iterdir()) == ["segment=2", "segment=3"]


def test_staged_hashes_stay_where_they_are(spark, tmp_path):
    staged = [hashlib.sha256(f"{i}".encode()).hexdigest() for i in range(600)]
    for digits, part in enumerate((staged[:200], staged[200:400], staged[400:])):
        frame = spark.createDataFrame([(h,) for h in part], "source_hash string")
        frame.withColumn(history.PREFIX, history.hash_prefix(F.col("source_hash"), digits)).write.partitionBy(
            history.PREFIX).mode("append").parquet(str(tmp_path / f"d{digits}"))
    paths = [str(tmp_path / f"d{d}") for d in range(3)]
    table = spark.read.schema("source_hash string, hash_prefix string").parquet(paths[0])
    for path in paths[1:]:
        table = table.unionByName(spark.read.schema("source_hash string, hash_prefix string").parquet(path))
    feed = staged[::7] + staged[::7] + [hashlib.sha256(f"new {i}".encode()).hexdigest() for i in range(100)]
    hashes = spark.createDataFrame([(h,) for h in feed], "_sourceHash string")
    loaded = history.loaded_hashes(table)
    for rows, part_bytes in ((None, 1), (len(feed), 2**20), (len(feed), len(feed) * 128 // 3), (len(feed), 1)):
        found = history.staged_among(hashes, loaded, rows, part_bytes)
        assert sorted(r[0] for r in found.collect()) == sorted(set(staged[::7]))
    # A feed of one row reads the folders of its digits, and staging meets it by broadcast.
    one = history.staged_among(spark.createDataFrame([(staged[-1],)], "_sourceHash string"), loaded, 1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    pruned = [x for x in plan.split("PartitionFilters: ")[1:]]
    assert pruned and all("hash_prefix" in x.split("PushedFilters")[0] for x in pruned)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_folders_and_buckets_follow_the_size():
    assert [history.prefix_digits(n, 10) for n in (0, 10, 11, 160, 161, 10**9)] == [0, 0, 1, 1, 2, 2]
    assert dimension.bucket_number(5, 0, 10) == 1 and dimension.bucket_number(10, 1, 10) == 1
    assert dimension.bucket_number(11, 1, 10) == 8 and dimension.bucket_number(80, 8, 10) == 8
    assert dimension.bucket_number(81, 8, 10) == 64
