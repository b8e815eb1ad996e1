import datetime as dt
import random

from pyspark.sql import functions as F

from feedhouse.operators import delivery, runs

AT = dt.datetime(2024, 1, 1, 12)


def replay(statuses, limit=3):
    """Attempts in order until one ends the matter."""
    for place, status in enumerate(statuses[:limit], 1):
        if status is not None and 200 <= status < 300:
            return "success", place, place, None
        error = "network error" if status is None else f"HTTP {status}"
        if place == limit or not (status is None or status == 429 or status >= 500):
            return "failed", limit, place, error


def test_outcomes_equal_a_replay(spark):
    rng = random.Random(5)
    logs = [[rng.choice([200, 201, 404, 400, 429, 500, 503, None]) for _ in range(5)] for _ in range(400)]
    rows = [(f"u{i}", place, status) for i, log in enumerate(logs) for place, status in enumerate(log, 1)]
    rng.shuffle(rows)
    found = delivery.delivery_outcomes(spark.createDataFrame(rows, "email string, attempt int, status int")).collect()
    assert len(found) == len(logs)
    for r in found:
        expected = replay(logs[int(r.email[1:])])
        assert (r.status, r.attempts, r.attempts_made, r.error) == expected
        assert r.waited_ms == sum(500 * 2**i for i in range(r.attempts_made - 1))


def test_backoff(spark):
    row = spark.range(1).select(delivery.backoff_ms(F.lit(1)), delivery.backoff_ms(F.lit(2))).first()
    assert tuple(row) == (500, 1000)


def test_batches_are_whole_and_in_order(spark):
    rows = [(i * 3 + 2, f"n{i}") for i in range(23)]
    random.Random(1).shuffle(rows)
    found = delivery.payload_batches(spark.createDataFrame(rows, "_rowNumber bigint, name string"))
    batches = {r.batch_id: list(r.payloads) for r in found.collect()}
    assert [len(batches[i]) for i in range(5)] == [5, 5, 5, 5, 3]
    assert sum((batches[i] for i in range(5)), []) == [f'{{"name":"n{i}"}}' for i in range(23)]


def test_run_log(spark):
    log = runs.start_event(spark, "a", "f", AT, "1").unionByName(
        runs.start_event(spark, "a", "again", AT + dt.timedelta(hours=1), "2")
    )
    state = runs.fold_events(log).first()
    assert (state.status, state.source_file, state.records_parsed) == ("running", "f", 0)
    metrics = runs.RunMetrics(records_parsed=3, records_api_success=2, records_api_failed=1)
    done = log.unionByName(runs.complete_event(spark, "a", AT, AT + dt.timedelta(seconds=2), metrics, "{}"))
    state = runs.fold_events(done).first()
    assert (state.status, float(state.success_rate), state.execution_time_ms) == ("partial", 66.67, 2000)
    assert (state.source_file, state.started_at, state.records_api_success) == ("f", AT, 2)
    failed = log.unionByName(runs.fail_event(spark, "a", AT, AT, "boom"))
    state = runs.fold_events(failed).first()
    assert (state.status, state.error_message, state.records_in_file) == ("failed", "boom", 0)
    orphan = runs.fail_event(spark, "b", AT, AT, "boom")
    assert runs.fold_events(orphan).count() == 0


def test_success_rate_of_nothing():
    assert runs.RunMetrics().success_rate == 0.0
