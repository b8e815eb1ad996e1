"""Line scan, row numbers, record parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.catalog.registry import query
from feedhouse.catalog.relations import FEED_FIELDS, customer_feed, table, text
from feedhouse.session import scratch_path
from feedhouse.sources.lines import land_lines, number_lines, scan_lines
from feedhouse.sources.records import parse_summary, read_feed, split_fields, split_malformed

# Customers per written file: about 30 MB of text, so the number of files grows with the table.
ROWS_PER_FILE = 250_000


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as delimited lines with their row number. Every 59th row lacks its last two fields."""
    feed = customer_feed(spark, sf_dir)
    fields = [quoted(F.col(f)) if f == "address" else F.col(f) for f in FEED_FIELDS]
    k = F.floor((F.col("_rowNumber") - 2) / 2)
    line = F.when(k % 59 == 0, F.concat_ws(",", *fields[:-2])).otherwise(F.concat_ws(",", *fields))
    return feed.select("_rowNumber", line.alias("line"))


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_lines(spark, sf_dir).select("_rowNumber", split_fields(F.col("line")).alias("_fields"))


def write_files(lines: DataFrame, header: str, label: str) -> str:
    """Write `place`, `line` as text files of ROWS_PER_FILE places each, a header first, in place order."""
    path = scratch_path(lines.sparkSession, label)
    placed = lines.select(F.floor(F.col("place") / ROWS_PER_FILE).alias("file_no"), "place", "line")
    headers = placed.select("file_no").distinct().select("file_no", F.lit(-1).alias("place"), F.lit(header).alias("line"))
    (
        placed.unionByName(headers)
        .repartition("file_no")
        .sortWithinPartitions("file_no", "place")
        .drop("place")
        .write.partitionBy("file_no")
        .text(path)
    )
    return path


@query("line_scan", """
    select file_line as line from (
      select c_custkey || ',' || c_name as file_line from customer
      union all select 'key,name' from (select distinct c_custkey // 250000 from customer) f) x""")
def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with three kinds of line ends and blank lines between them."""
    k = F.col("c_custkey")
    end = F.when(k % 3 == 0, "\r").when(k % 5 == 0, "\n \t").when(k % 7 == 0, "\r\r\n").otherwise("")
    lines = table(spark, sf_dir, "customer").select(
        k.alias("place"), F.concat(text(k), F.lit(","), "c_name", end).alias("line")
    )
    path = write_files(lines, "key,name", "scan")
    return scan_lines(spark.read, path).select(F.col("value").alias("line"))


@query("row_numbers", """
    select cast(c_custkey // 250000 as integer) as file_no, cast(c_custkey as varchar) as customer,
      1 + row_number() over (partition by c_custkey // 250000 order by c_custkey) as row_number
    from customer""")
def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    lines = table(spark, sf_dir, "customer").select(
        k.alias("place"), F.concat(text(k), F.when(k % 5 == 0, "\n\n").otherwise("")).alias("line")
    )
    path = write_files(lines, "customer", "numbers")
    numbered = number_lines(land_lines(spark, path)).where("_rowNumber > 1")
    file_no = F.regexp_extract("_sourceFile", r"file_no=(\d+)", 1).cast("int")
    return numbered.select(
        file_no.alias("file_no"), F.col("value").alias("customer"), F.col("_rowNumber").alias("row_number")
    )


@query("header_resolve", """
    select cast(c_custkey as varchar) as customer, c_mktsegment as name, cast(c_nationkey as varchar) as nation,
      1 + row_number() over (partition by c_custkey // 250000 order by c_custkey) as row_number
    from customer""")
def header_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded names are trimmed, and of two equal names the last one holds."""
    k = F.col("c_custkey")
    lines = table(spark, sf_dir, "customer").select(
        k.alias("place"), F.concat_ws(",", text(k), "c_name", "c_mktsegment", text(F.col("c_nationkey"))).alias("line")
    )
    path = write_files(lines, " customer ,name, name,\tnation", "header")
    return read_feed(spark, path).rows.select("customer", "name", "nation", F.col("_rowNumber").alias("row_number"))


@query("csv_parse", f"""
    select row_number, {", ".join(FEED_FIELDS)} from customer_feed where ((row_number - 2) // 2) % 59 <> 0""")
def csv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = split_malformed(parsed_lines(spark, sf_dir), FEED_FIELDS)
    return rows.withColumnRenamed("_rowNumber", "row_number")


@query("parse_quarantine", """
    select row_number, 'Row ' || row_number || ': column count mismatch (expected 11, got 9)' as message
    from customer_feed where ((row_number - 2) // 2) % 59 = 0""")
def parse_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, errors = split_malformed(parsed_lines(spark, sf_dir), FEED_FIELDS)
    return errors.withColumnRenamed("_rowNumber", "row_number")


@query("parse_summary", f"""
    select count(*) as rows_in_file, count(*) filter (where ((row_number - 2) // 2) % 59 <> 0) as total_rows,
      count(*) filter (where ((row_number - 2) // 2) % 59 = 0) as parse_errors,
      '{", ".join(FEED_FIELDS)}' as headers
    from customer_feed""")
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_summary(parsed_lines(spark, sf_dir), FEED_FIELDS)
