"""File scans with lineage and reject handling, in batch or as a stream.

A scan frame keeps every record of the files: the data columns, ``filename``, ``file_row_number``,
``_raw`` (the record text where known) and ``_rejected``. ``split_rejects`` separates it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.flatten import variant_array
from ..schemas import text_schema
from ..session import stage

CORRUPT = "_corrupt"

# Cell texts that mean NULL.
NULL_WORDS = ("NULL", "null", "")


@dataclass(frozen=True)
class FileFormat:
    """A named reader configuration."""

    kind: str
    options: dict[str, str] = field(default_factory=dict)
    glob: str = "*"
    strict: bool = True
    strip_outer_array: bool = True


_CSV_COMMON = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # Column count checks must see the whole record whatever the query selects.
    "columnPruning": "false",
    # A line break inside quotes belongs to the value, so a file cannot be split at line breaks: large drops come as
    # many files.
    "multiLine": "true",
}

# A JSON document per file: an array of records (stripped) or one object. Not splittable. The limit on the size of a
# variant holds for a record, not for the file.
JSON_ARRAY = FileFormat("json", {"wholetext": "true"}, "*.json")
# The document as it is, array or not.
JSON_DOCUMENT = FileFormat("json", {"wholetext": "true"}, "*.json", strip_outer_array=False)
# A JSON document per line: the format for large drops. Plain files are splittable; compressed ones (told by their names)
# are not, so large drops of them come as many files.
JSON_LINES = FileFormat("json", {"wholetext": "false"}, "*.json{,.gz,.bz2}")
CSV = FileFormat("csv", {**_CSV_COMMON, "sep": ",", "header": "true"}, "*.csv")
# For files known to have no line break inside quotes: splittable, the format for large files.
CSV_LINES = FileFormat("csv", {**_CSV_COMMON, "sep": ",", "header": "true", "multiLine": "false"}, "*.csv")
CSV_NO_HEADER = FileFormat("csv", {**_CSV_COMMON, "sep": ",", "header": "false"}, "*.csv")
PIPE = FileFormat("csv", {**_CSV_COMMON, "sep": "|", "header": "true"}, "*", strict=False)


def read_files(spark: SparkSession, path: str, fmt: FileFormat, columns: list[str] | None = None,
               stream: bool = False, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Records as the reader delivers them plus file position columns; batch or streaming, with at most
    ``files_per_batch`` files in a micro-batch."""
    reader = spark.readStream if stream else spark.read
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    reader = reader.option("pathGlobFilter", glob or fmt.glob).option("recursiveFileLookup", "true")
    if fmt.kind == "json":
        # As an argument in batch: the method's default would override the option.
        whole = fmt.options["wholetext"] == "true"
        frame = reader.text(path, wholetext=whole)
        data = ["value"]
    else:
        frame = reader.schema(text_schema(columns, CORRUPT)).options(**fmt.options).csv(path)
        data = [*columns, CORRUPT]
    return frame.select(
        *data,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def with_record_numbers(records: DataFrame) -> DataFrame:
    """1-based ``file_row_number`` in each file and ``_batch_row`` over all files.

    Rows of one file block are consecutive in one task, so a running id minus the block's first id is
    the position in the block; block sizes then give the offsets. Only one row per block is windowed,
    so a single huge file is numbered in parallel.
    """
    _pin_splits(records.sparkSession)
    seen = records.withColumn("_id", F.monotonically_increasing_id())
    # One row per file block (128 MB by default), from a pass that parses nothing; written once.
    blocks = stage(
        seen.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows")), "blocks")
    by_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    overall = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_file", "_block", "_first", "_rows",
        F.coalesce(F.sum("_rows").over(by_file), F.lit(0)).alias("_in_file"),
        F.coalesce(F.sum("_rows").over(overall), F.lit(0)).alias("_in_batch"),
    )
    # The block table is a written one, so Spark knows its size: below its own broadcast threshold the records stay
    # where they were read, beyond it they are joined by a shuffle.
    offset = F.col("_id") - F.col("_first")
    # Both passes must cut the files alike. A record outside its counted block stops the job, never
    # drops out or gets another's number.
    position = F.when((offset >= 0) & (offset < F.col("_rows")), offset + 1).otherwise(
        F.raise_error(F.lit("file blocks changed while records were numbered")).cast("long"))
    return (
        seen.join(offsets, ["_file", "_block"], "left")
        .withColumn("_position", position)
        # An unmatched record has no offsets; 0 stands in so that the check above is still evaluated.
        .withColumn("file_row_number", F.col("_position") + F.coalesce("_in_file", F.lit(0)))
        .withColumn("_batch_row", F.col("_position") + F.coalesce("_in_batch", F.lit(0)))
        .drop("_id", "_first", "_rows", "_in_file", "_in_batch", "_position")
    )


def _pin_splits(spark: SparkSession) -> None:
    """Keep file splits from following the number of live executors, which can change between passes."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def _null_words(c: str) -> Column:
    return F.when(F.col(c).isin(*NULL_WORDS), F.lit(None)).otherwise(F.col(c)).alias(c)


def _with_document(records: DataFrame) -> DataFrame:
    """``_doc``: the text as one JSON value, NULL when it is not. The parser alone would accept and drop
    text after the value, so it is parsed as the only element of an array; duplicate object keys are refused.
    Two steps, so that the text is parsed once.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]")))
    return (
        records.withColumn("_wrapped", variant_array(wrapped, "$"))
        .withColumn("_doc", F.when(F.size("_wrapped") == 1, F.get("_wrapped", F.lit(0))))
        .drop("_wrapped")
    )


def _with_elements(records: DataFrame) -> DataFrame:
    """``_elements``: the records of a text, those of an array or the one value; NULL when the text is not JSON.

    An array is read element by element, so its size is bounded by the text alone. As in ``_with_document`` the
    text is parsed as the only element of an array, in a step of its own.
    """
    text = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    is_list = F.col("value").rlike(r"^\s*\[")
    return (
        _with_document(records.withColumn("_lists", F.when(is_list, F.from_json(text, "array<array<variant>>")))
                       .withColumn("_text", F.col("value")).withColumn("value", F.when(~is_list, F.col("value"))))
        .withColumn("value", F.col("_text"))
        .withColumn("_elements", F.when(is_list, F.when(F.size("_lists") == 1, F.get("_lists", F.lit(0))))
                    .when(F.col("_doc").isNotNull(), F.array("_doc")))
        .drop("_lists", "_text", "_doc")
    )


def shape_json(numbered: DataFrame, fmt: FileFormat) -> DataFrame:
    """Parse the text; with stripping, each element of an outer array becomes a record."""
    texts = numbered.where(F.trim("value") != "")
    lineage = ["filename", "file_row_number", "_file", "_batch_row"]
    if not fmt.strip_outer_array:
        parsed = _with_document(texts)
        return parsed.select(
            F.col("_doc").alias("raw_data"), *lineage, F.lit(0).alias("_element"),
            F.when(F.col("_doc").isNull(), F.col("value")).alias("_raw"),
            F.col("_doc").isNull().alias("_rejected"),
        )
    whole = fmt.options["wholetext"] == "true"
    row_number = F.col("_element") + 1 if whole else F.col("file_row_number")
    return (
        _with_elements(texts)
        # The text itself is carried on only for a rejected document.
        .select(*lineage, F.when(F.col("_elements").isNull(), F.col("value")).alias("_raw"),
                F.posexplode(F.coalesce("_elements", F.array(F.lit(None).cast("variant")))).alias("_element", "raw_data"))
        .withColumn("file_row_number", row_number.cast("long"))
        .withColumn("_rejected", F.col("raw_data").isNull())
        .select("raw_data", *lineage, "_element", "_raw", "_rejected")
    )


def shape_csv(numbered: DataFrame, fmt: FileFormat, columns: list[str]) -> DataFrame:
    # The reader refuses a query over the corrupt text alone, so the test names a data column too.
    mark = F.concat(F.col(CORRUPT), F.coalesce(F.col(columns[0]), F.lit("")))
    rejected = mark.isNotNull() if fmt.strict else F.lit(False)
    return numbered.select(
        *(_null_words(c) for c in columns), "filename", "file_row_number", "_file", "_batch_row",
        F.lit(0).alias("_element"), F.when(rejected, F.col(CORRUPT)).alias("_raw"), rejected.alias("_rejected"),
    )


def shape_records(records: DataFrame, fmt: FileFormat, columns: list[str] | None = None,
                  number: bool = True) -> DataFrame:
    if number:
        numbered = with_record_numbers(records)
    else:
        # A whole-file document is its file's only record.
        known = 1 if fmt.options.get("wholetext") == "true" else None
        numbered = records.withColumns({
            "file_row_number": F.lit(known).cast("long"), "_batch_row": F.lit(None).cast("long")})
    return shape_json(numbered, fmt) if fmt.kind == "json" else shape_csv(numbered, fmt, columns)


def split_rejects(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records with their lineage, and rejected ones with the raw text."""
    internal = ["_raw", "_rejected", "_file", "_batch_row", "_element"]
    good = scanned.where(~F.col("_rejected")).drop(*internal)
    rejects = scanned.where("_rejected").select("filename", "file_row_number", F.col("_raw").alias("raw_record"))
    return good, rejects


def matching_files(records: DataFrame, pattern: str | None) -> DataFrame:
    """Only records of files whose path below the landing area matches the regular expression."""
    return records.where(F.col("_file").rlike(pattern)) if pattern else records


def scan_json(spark: SparkSession, path: str, pattern: str | None = None, multiline: bool = True,
              strip_outer_array: bool = True, number: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``; good has ``raw_data`` (variant), ``filename``, ``file_row_number``.

    Numbering lines needs a second, unparsed pass over the files; without ``number`` only the elements
    of whole-file arrays are numbered.
    """
    fmt = FileFormat("json", {"wholetext": str(multiline).lower()}, "*", strip_outer_array=strip_outer_array)
    records = matching_files(read_files(spark, path, fmt), pattern)
    return split_rejects(shape_records(records, fmt, number=number and not multiline))


def scan_csv(spark: SparkSession, path: str, columns: list[str], fmt: FileFormat = CSV,
             pattern: str | None = None, number: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``; good has the columns as text, ``filename``, ``file_row_number``.

    A strict format rejects records with too few or too many cells, a lenient one keeps them. Numbering
    needs a second, unparsed pass over the files.
    """
    records = matching_files(read_files(spark, path, fmt, columns, glob="*"), pattern)
    return split_rejects(shape_records(records, fmt, columns, number))
