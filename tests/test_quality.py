import random

import pytest
from pyspark.sql import functions as F

from feedhouse.fixed import EXPECTED_FIELDS
from feedhouse.operators import quality, rules
from feedhouse.operators.spread import lookup, settle_keyed

SCHEMA = "_rowNumber bigint, " + ", ".join(f"{f} string" for f in EXPECTED_FIELDS)
GOOD = dict(
    company_name="Acme", contact_email="a@b.co", contact_first_name="A", contact_last_name="B",
    phone_number="555-01000", tax_id="T", company_size="1", address="x", city="y", country="us", postal_code="00187",
)


def frame(spark, rows):
    return spark.createDataFrame([(i + 2, *[r[f] for f in EXPECTED_FIELDS]) for i, r in enumerate(rows)], SCHEMA)


def row(**changes):
    return {**GOOD, **changes}


def issues(spark, rows, history=None, **how):
    found = quality.enrich(frame(spark, rows), history, **how).orderBy("_rowNumber").collect()
    return [r._qualityIssues for r in found]


def test_issue_order_and_texts(spark):
    rows = [
        row(),
        row(),
        row(company_name=" ", contact_email="A@b.co ", country=" usa ", phone_number="12x", tax_id="2"),
        row(contact_email="", tax_id="3"),
        row(contact_email="", tax_id="4"),
        row(contact_email="bad", tax_id="5", country="", phone_number=""),
    ]
    assert issues(spark, rows) == [
        [],
        ["DUPLICATE_ROW", "DUPLICATE_EMAIL:a@b.co"],
        ["DUPLICATE_EMAIL:a@b.co", "NULL_REQUIRED:company_name", "INVALID_COUNTRY:USA", "INVALID_PHONE:12x"],
        ["NULL_REQUIRED:contact_email"],
        ["NULL_REQUIRED:contact_email"],
        ["INVALID_EMAIL_FORMAT:bad"],
    ]


def uneven_rows(count, seed):
    """A third of the rows share one hash and email, a third have no email, the rest repeat a little."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        kind = rng.random()
        if kind < 0.34:
            rows.append(row(contact_email="hot@x.co", tax_id="hot"))
        elif kind < 0.67:
            rows.append(row(contact_email=rng.choice(["", " "]), tax_id=str(rng.randrange(count))))
        else:
            rows.append(row(contact_email=f"u{rng.randrange(count // 6)}@x.co", tax_id=str(rng.randrange(4))))
    return rows


def replay(rows, loaded=frozenset()):
    """Row by row: (in history, duplicate row, duplicate email)."""
    def key(r):
        return "|".join([r["company_name"], r["contact_email"], r["tax_id"]]).lower().strip()

    seen, emails, out = {key(rows[i]) for i in loaded}, set(), []
    history = frozenset(seen)
    for r in rows:
        k, e = key(r), r["contact_email"].lower().strip()
        out.append((k in history, k in seen, bool(e) and e in emails))
        seen.add(k)
        emails.add(e)
    return out


@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "partitions": 40}])
def test_duplicates_equal_a_replay_on_uneven_keys(spark, how):
    rows = uneven_rows(600, 7)
    loaded = {3, 11, 40, 41}
    data = frame(spark, rows)
    history = quality.with_keys(data.where(F.col("_rowNumber").isin([i + 2 for i in loaded])))
    history = history.select(F.col("_sourceHash").alias("source_hash"))
    found = quality.enrich(data, history, **how).orderBy("_rowNumber").collect()
    assert len(found) == len(rows)
    flags = [
        (r._loaded, r._duplicateRow, any(i.startswith("DUPLICATE_EMAIL") for i in r._qualityIssues)) for r in found
    ]
    assert flags == replay(rows, loaded)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_gives_the_same_rows_on_every_way(spark, how):
    left = spark.range(1000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("key")
    )
    counted = left.where("key is not null and key % 4 <> 1").groupBy("key").agg(F.count("*").alias("n"))
    keyed = settle_keyed(counted.withColumn("name", F.concat(F.lit("k"), "key")), "test")
    ways = [
        lookup(left, keyed, "key", "id", how),
        lookup(left, keyed, "key", "id", how, broadcast_bytes=0, partitions=1000),
        lookup(left, keyed, "key", "id", how, broadcast_bytes=0, partitions=4),
    ]
    plain = left.join(keyed.frame, "key", how)
    expected = sorted(map(tuple, plain.select("id", "key", "n", "name").collect()))
    for way in ways:
        assert sorted(map(tuple, way.select("id", "key", "n", "name").collect())) == expected


def test_hot_keys_do_not_share_a_partition(spark):
    """After the salted join the rows of a key that holds most of the frame lie in several partitions."""
    left = spark.range(4000).withColumn("key", F.when(F.col("id") % 4 > 0, 1).otherwise(F.col("id")))
    keyed = settle_keyed(left.groupBy("key").agg(F.count("*").alias("n")), "test")
    joined = lookup(left, keyed, "key", "id", broadcast_bytes=0, partitions=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 4000
    assert max(r["count"] for r in sizes) < 2000


def test_null_profile_limits(spark):
    rows = [row(city="", address=" " if i < 8 else "x", phone_number="" if i < 5 else "555-01000",
                tax_id="" if i < 9 else "t") for i in range(10)]
    profile = quality.null_profile(frame(spark, rows).drop("postal_code"))
    found = {r.field: (r.null_count, r.null_pct) for r in profile.collect()}
    assert found["city"] == (10, 100.0) and found["postal_code"] == (10, 100.0) and found["phone_number"] == (5, 50.0)
    high = {r.field: (r.severity, r.message) for r in quality.high_null_fields(profile).collect()}
    assert set(high) == {"city", "address", "tax_id", "postal_code"}
    assert high["address"] == ("MEDIUM", 'Field "address" is 80% null')
    assert high["tax_id"] == ("HIGH", 'Field "tax_id" is 90% null')


def test_empty_feed(spark):
    empty = frame(spark, [])
    summary = quality.quality_summary(quality.enrich(empty)).first()
    assert tuple(summary) == (0, 0, 0, 0, 100)
    assert all(r.null_pct == 0 for r in quality.null_profile(empty).collect())
    assert tuple(rules.validation_summary(rules.validate(empty)).first())[0] == 0


def test_drift_uses_raw_names():
    drift = quality.schema_drift([" city", *[f for f in EXPECTED_FIELDS if f != "city"], "_rowNumber", "x"])
    assert (drift.missing, drift.unexpected) == (["city"], [" city", "x"])


def test_validation_rules(spark):
    data = frame(spark, [row(company_name="", contact_email=" bad ", contact_first_name=" ")])
    listed = rules.validate(data).first().errors
    assert listed == [
        'Missing required field: "company_name"',
        'Invalid email format in field "contact_email": "bad"',
        'Field "contact_first_name" must not be empty.',
    ]
    absent = rules.validate(data.drop("company_name", "contact_first_name")).first().errors
    assert absent[0] == 'Missing required field: "company_name"' and len(absent) == 2
    assert rules.validate(data, {"other": ["city"]}).first().errors == []


def test_known_figures_of_the_test_feed(spark):
    """Figures worked out beforehand for the feed at scale factor 0.01."""
    from feedhouse.catalog.relations import customer_feed

    feed = customer_feed(spark, "/root/testdata/sf0.01")
    enriched = quality.enrich(feed)
    assert tuple(quality.quality_summary(enriched).first())[:4] == (1515, 1077, 438, 15)
    kinds = enriched.select(F.explode("_qualityIssues").alias("i")).groupBy(F.split("i", ":")[0].alias("k")).count()
    assert {r.k: r["count"] for r in kinds.collect()} == {
        "DUPLICATE_ROW": 15, "DUPLICATE_EMAIL": 91, "NULL_REQUIRED": 63, "INVALID_COUNTRY": 299,
        "INVALID_PHONE": 40, "INVALID_EMAIL_FORMAT": 34,
    }
    rates = {r.field: r.null_pct for r in quality.null_profile(feed).collect()}
    assert (rates["phone_number"], rates["country"], rates["contact_email"], rates["company_name"]) == (
        71.49, 20.92, 2.18, 1.98,
    )
