"""JSON lines in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import strip
from quern.plans.prefix import dense_rank_from_zero, wide
from quern.plans.stage import cut

_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken", "allowSingleQuotes": "false"}


def _wrapped(line: Column, kind: T.DataType) -> Column:
    """The line's value as ``value``, read inside an object of its own.

    The JSON reader stops after the first whole value, so a line with something
    after it would pass. Wrapped, that something breaks the object, unless it is
    a closing brace or another member; ``_is_one`` refuses those.
    """
    return F.from_json(F.concat(F.lit('{"value":'), line, F.lit("}")),
                       T.StructType([T.StructField("value", kind), T.StructField("broken", T.StringType())]), _OPTIONS)


def _is_one(line: Column) -> Column:
    """True if the line inside brackets is an array of one value."""
    return F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1


def parse_jsonl(lines: DataFrame, schema: T.StructType | str, line: str = "value") -> DataFrame:
    """One row per line that is a JSON object; blank, broken and non-object lines are dropped.

    A field of another type than declared is converted or null. Other columns
    of ``lines`` are kept.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept = [c for c in lines.columns if c != line]
    objects = lines.withColumn(line, strip(F.col(line))).where(F.startswith(line, F.lit("{")) & _is_one(F.col(line)))
    # ``explode`` of one element: the filter on the row stays above it, so that
    # the line is parsed once and not for the filter as well.
    rows = objects.select(*kept, F.explode(F.array(_wrapped(F.col(line), schema)["value"])).alias("_row"))
    return rows.where(F.col("_row").isNotNull()).select(
        *kept, *[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields])


def line_report(lines: DataFrame, line: str = "value") -> DataFrame:
    """How many lines are blank, broken, valid but no object, or objects."""
    text = strip(F.col(line))
    whole = _is_one(text) & _wrapped(text, T.StringType())["broken"].isNull()
    kind = (F.when(text == "", "blank").when(F.coalesce(~whole, F.lit(True)), "broken")
            .when(F.startswith(text, F.lit("{")), "object").otherwise("not_object"))
    return lines.groupBy(kind.alias("kind")).agg(F.count("*").alias("n_lines"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, **ranges) -> DataFrame:
    """Read JSON lines in file order, with that order in ``ord``.

    Spark rows have no order of their own, so the place of each line (file,
    block, row within the task) is written down once and then numbered.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row_id"), "value")
    rows = cut(parse_jsonl(lines, schema))
    return (dense_rank_from_zero(rows, "ord", ["_file", "_block", "_row_id"], **{**wide(), **ranges})
            .drop("_file", "_block", "_row_id"))


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    """Append rows as JSON objects; null fields are written as null. Compressed files are read by one task each."""
    df.write.mode("append").option("ignoreNullFields", False).option("compression", compression).json(path)
