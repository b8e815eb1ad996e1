"""Delimited records: field split, header, malformed rows, summary."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.functions.numbers import count_where
from feedhouse.functions.text import WHITE_SPACE
from feedhouse.session import scratch_path
from feedhouse.sources.lines import Landing, file_sizes, head_lines, land_lines, number_lines, scan_lines
from feedhouse.sources.tables import row_bytes, settle

ROW_NUMBER = "_rowNumber"
NO_DATA = "a feed must have a header line and at least one data line"
_MARK, _ESC = "\x01", "\x02"


def split_fields(line: Column) -> Column:
    """Fields of a line, as an array.

    A quote toggles quoting wherever it stands, two quotes inside a quoted part are one quote, a comma
    outside quotes ends a field, and an open quote runs to the end of the line.
    """
    plain = F.split(line, ",", -1)
    return F.when(F.contains(line, F.lit('"')), _split_quoted(line)).otherwise(plain)


def _split_quoted(line: Column) -> Column:
    # Cut at quotes: parts at odd places are quoted. Commas of the other parts become a mark. An empty
    # unquoted part between two quotes is the second half of a doubled quote.
    marked = F.contains(line, F.lit(_MARK)) | F.contains(line, F.lit(_ESC))
    escaped = F.replace(F.replace(line, F.lit(_ESC), F.lit(_ESC + "e")), F.lit(_MARK), F.lit(_ESC + "m"))
    parts = F.split(F.when(marked, escaped).otherwise(line), '"', -1)
    last = F.size(parts) - 1

    def rewrite(part: Column, place: Column) -> Column:
        return (
            F.when(place % 2 == 1, part)
            .when((part == "") & (place > 0) & (place < last), F.lit('"'))
            .otherwise(F.replace(part, F.lit(","), F.lit(_MARK)))
        )

    fields = F.split(F.array_join(F.transform(parts, rewrite), ""), _MARK, -1)

    def restore(field: Column) -> Column:
        return F.replace(F.replace(field, F.lit(_ESC + "m"), F.lit(_MARK)), F.lit(_ESC + "e"), F.lit(_ESC))

    return F.when(marked, F.transform(fields, restore)).otherwise(fields)


def read_header(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Raw names from the first non-blank line; a scan that stops at the first row."""
    first = scan_lines(spark.read, paths).select(split_fields(F.col("value")).alias("names")).first()
    if first is None:
        raise ValueError(NO_DATA)
    return list(first.names)


# Names that steps of a load give to their own columns; all others of theirs begin with an underscore.
_TAKEN = {"n", "errors", "value"}
_PLAIN = re.compile(r"[^\W_][^.`]*")


def field_names(header: list[str]) -> dict[str, str]:
    """Trimmed name -> column name, in header order; the last of two equal names wins.

    A name that column expressions or the load's own columns could mistake, and the later of two names that differ in
    case only, gets a column name by its place.
    """
    places = {name.strip(WHITE_SPACE): place for place, name in enumerate(header)}
    if ROW_NUMBER in places:
        raise ValueError(f"{ROW_NUMBER} is a reserved column name")
    names, used = {}, {f"field{place}" for place in range(len(header))}
    for name, place in places.items():
        plain = _PLAIN.fullmatch(name) and name.lower() not in _TAKEN | used
        names[name] = name if plain else f"field{place}"
        used.add(names[name].lower())
    return names


def resolve_header(header: list[str]) -> dict[str, int]:
    """Column name -> field place."""
    places = {name.strip(WHITE_SPACE): place for place, name in enumerate(header)}
    return {column: places[name] for name, column in field_names(header).items()}


def pick_fields(fields: Column, header: list[str]) -> list[Column]:
    return [F.get(fields, F.lit(place)).alias(name) for name, place in resolve_header(header).items()]


def mismatch_text(row_number: Column, found: Column, expected: int | Column) -> Column:
    expected = F.lit(expected) if isinstance(expected, int) else expected
    return F.concat(
        F.lit("Row "), row_number.cast("string"), F.lit(": column count mismatch (expected "), expected.cast("string"),
        F.lit(", got "), found.cast("string"), F.lit(")"),
    )


def split_malformed(parsed: DataFrame, header: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, parse errors) of a frame with `_fields` and `_rowNumber`."""
    found = F.size("_fields")
    extra = [c for c in parsed.columns if c != "_fields"]
    rows = parsed.where(found == len(header)).select(*extra, *pick_fields(F.col("_fields"), header))
    errors = parsed.where(found != len(header)).select(
        *extra, mismatch_text(F.col(ROW_NUMBER), found, len(header)).alias("message")
    )
    return rows, errors


def parse_summary(parsed: DataFrame, header: list[str]) -> DataFrame:
    """Counts of rows and parse errors in one pass."""
    good = F.size("_fields") == len(header)
    return parsed.agg(
        F.count(F.lit(1)).alias("rows_in_file"),
        count_where(good).alias("total_rows"),
        count_where(~good).alias("parse_errors"),
    ).withColumn("headers", F.lit(", ".join(header)))


@dataclass
class Feed:
    """A feed with its raw header, well-formed rows and parse errors, both with exact row numbers.

    `lines` counts all of them, headers included. For files with headers of their own (`feed_of_files`) `header` has the
    fields that were asked for, and `lines` leaves the headers out.
    """

    header: list[str]
    rows: DataFrame
    parse_errors: DataFrame
    lines: int


def _parse_columns(lines: DataFrame, header: list[str]) -> DataFrame:
    """`value` replaced by one column per field, the field count, and whether the line equals the header."""
    others = [c for c in lines.columns if c != "value"]
    fields = F.col("_fields")
    is_header = fields == F.array(*[F.lit(name) for name in header])
    return lines.select(split_fields(F.col("value")).alias("_fields"), *others).select(
        *pick_fields(fields, header), F.size(fields).alias("_found"), is_header.alias("_isHeader"), *others
    )


def _as_feed(lines: DataFrame, header: list[str], count: int) -> Feed:
    data = lines.where(F.col(ROW_NUMBER) > 1)
    good = F.col("_found") == len(header)
    rows = data.where(good).select("_sourceFile", ROW_NUMBER, "_rowOrder", *resolve_header(header))
    errors = data.where(~good).select(
        "_sourceFile", ROW_NUMBER, mismatch_text(F.col(ROW_NUMBER), F.col("_found"), len(header)).alias("message")
    )
    return Feed(header, rows, errors, count)


def _refuse(files: DataFrame, text: str, folder: str | None) -> None:
    """Raise if there is such a file; all their names are written to a table that the error names."""
    if files.isEmpty():
        return
    path = f"{folder}/refused" if folder else scratch_path(files.sparkSession, "refused")
    files.select("_sourceFile").distinct().write.mode("overwrite").parquet(path)
    raise ValueError(f"{text}; first of them {files.agg(F.min('_sourceFile')).first()[0]}, all listed in {path}")


def _check_heads(other: DataFrame, folder: str | None) -> None:
    _refuse(other, "files with another header need a load of their own", folder)


def _check_sizes(landing: Landing, folder: str | None, listed: DataFrame | None = None) -> None:
    sizes = file_sizes(landing)
    short = sizes.where("lines < 2").select("_sourceFile")
    if listed is not None:
        # A file without any line has no block.
        short = short.unionByName(listed.join(sizes, "_sourceFile", "left_anti"))
    _refuse(short, NO_DATA, folder)


def _listed_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The files that a read of the paths covers; their contents are not read."""
    return spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("_sourceFile"))


def read_feed(spark: SparkSession, paths: str | list[str], target: str | None = None) -> Feed:
    """Land feed files that share one header, each numbered by itself.

    Fields become Parquet columns at once, so later passes read only the columns they need.
    """
    header = read_header(spark, paths)
    landing = land_lines(spark, paths, lambda lines: _parse_columns(lines, header), target)
    _check_sizes(landing, target, _listed_files(spark, paths))
    _check_heads(head_lines(landing).where(~F.col("_isHeader")), target)
    return _as_feed(number_lines(landing), header, landing.blocks.stats["lines"])


def file_headers(landing: Landing, wanted: list[str]) -> DataFrame:
    """One row per file with a line: `_sourceFile`, `lines`, raw header `_names`, `_places` of the wanted fields, and the
    `_refused` text of a file that is no feed.

    Names are trimmed for their place, and of two equal ones the last holds; a field that a file lacks has no place.
    """
    heads = head_lines(landing).select("_sourceFile", split_fields(F.col("value")).alias("_names"))
    trimmed = F.transform("_names", lambda n: F.trim(n, F.lit(WHITE_SPACE)))
    reserved = F.array_contains(trimmed, F.lit(ROW_NUMBER))
    refused = F.when(F.col("lines") < 2, F.lit(NO_DATA)).when(
        reserved, F.lit(f"{ROW_NUMBER} is a reserved column name"))

    def place(name: str) -> Column:
        from_end = F.array_position(F.reverse(trimmed), name)
        return F.when(from_end > 0, F.size("_names") - from_end).cast("int")

    return heads.join(file_sizes(landing), "_sourceFile").select(
        "_sourceFile", "lines", "_names", F.array(*[place(w) for w in wanted]).alias("_places"),
        refused.alias("_refused"))


def feed_of_files(landing: Landing, headers: DataFrame, wanted: list[str], target: str) -> Feed:
    """The rows of files with headers of their own, as the wanted fields; null where a file lacks one.

    What a line needs to know of its file comes with its block, so files of any number and size are one job.
    """
    blocks = landing.blocks.frame.join(headers.select("_sourceFile", F.size("_names").alias("_expected"), "_places"),
                                       "_sourceFile")
    wide = row_bytes(blocks) + 4 * len(wanted)
    known = Landing(landing.lines, settle(blocks, "file-blocks", f"{target}-blocks", lines=F.sum("_count"), size=F.sum(wide)))
    numbered = number_lines(known).where(F.col(ROW_NUMBER) > 1)
    names = field_names(wanted)
    fields = F.col("_fields")
    picked = [F.get(fields, F.col("_places")[i]).alias(column) for i, column in enumerate(names.values())]
    parsed = numbered.withColumn("_fields", split_fields(F.col("value"))).select(
        "_sourceFile", ROW_NUMBER, "_rowOrder", *picked, F.size(fields).alias("_found"), "_expected")
    lines = settle(parsed, "feed", target)
    good = F.col("_found") == F.col("_expected")
    rows = lines.frame.where(good).select("_sourceFile", ROW_NUMBER, "_rowOrder", *names.values())
    errors = lines.frame.where(~good).select(
        "_sourceFile", ROW_NUMBER, mismatch_text(F.col(ROW_NUMBER), F.col("_found"), F.col("_expected")).alias("message"))
    return Feed(wanted, rows, errors, lines.rows)
