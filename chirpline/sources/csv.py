"""Tweet CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chirpline.session import settings

QUOTING = {"quote": '"', "escape": '"', "multiLine": "true"}


def read_csv(spark: SparkSession, path: str, *, multiline: bool = True, infer: bool = False) -> DataFrame:
    """Rows of CSV files with a header, columns as the header names them.

    Columns are text unless ``infer`` is set, which reads the files once more;
    ``shape_records`` gives them their types. A quoted text may hold newlines
    and doubled quotes. Spark then cannot split a file, so parallelism comes
    from the number of files; ``read_large_csv`` is for files too large for
    that. Where no text holds a newline, ``multiline=False`` lets Spark split.

    Files of one read must share a header; one with other columns fails the
    read instead of shifting values into the wrong column. In files whose lines
    end in CR LF, Spark gives a CR LF within a text as LF; ``read_large_csv``
    leaves it as it is.
    """
    options = QUOTING | {"multiLine": str(multiline)}
    return spark.read.options(**options).csv(path, header=True, inferSchema=infer, enforceSchema=False)


def read_large_csv(spark: SparkSession, path: str, work: str, *, infer: bool = False) -> DataFrame:
    """The same rows, with each file read by many tasks.

    Columns are text unless ``infer`` is set. Then Spark's own inference looks
    at all records, as it does for a plain read, but here each task types its
    share of them, and one row of types per task is merged.

    The files must quote every text that holds a quote, as CSV writers do; a
    record that does not is an error. Then a line with an odd number of quotes
    opens or closes a quoted text that goes over several lines, and no other
    line does:

    * these turns are counted within each part of a file, a part being what
      one task reads;
    * adding up parts, one row each, tells which of them start within a text
      and which line opened it;
    * within a part, turns so far tell which lines belong to a longer record.
      Those lines are brought together by the line that opened it; every other
      line is a record by itself.

    So all lines are shuffled once, by part, and lines of longer records once
    more. ``work`` is a folder for lines and parts, which all executors must
    reach and which is the caller's to remove once the rows have been used.
    """
    columns = read_csv(spark, path).columns
    _stage_lines(spark, path, f"{work}/lines")
    staged = spark.read.parquet(f"{work}/lines")
    _parts(staged).write.mode("overwrite").parquet(f"{work}/parts")
    parts = spark.read.parquet(f"{work}/parts")
    _check_closed(parts)

    placed = _with_opening_line(staged, parts)
    whole = placed.where("start IS NULL").select("block", "line", "part", "value")
    longer = (
        placed.where("start IS NOT NULL")
        .groupBy("start")
        .agg(F.array_sort(F.collect_list(F.struct("block", "line", "part", "value"))).alias("pieces"))
        .select("pieces")
        .select(
            *[F.col("pieces")[0][name].alias(name) for name in ("block", "line", "part")],
            F.concat_ws("\n", F.col("pieces.value")).alias("value"),
        )
    )
    records = whole.unionByName(longer).select(
        _is_first(F.col("block"), F.col("line"), F.col("part")).alias("is_header"),
        F.col("value").isin("", "\r").alias("is_blank"),
        _conforming(_without_end(F.col("value"))).alias("value"),
    )
    text = StructType([StructField(name, StringType()) for name in columns])
    if infer:
        records.write.mode("overwrite").parquet(f"{work}/records")
        records = spark.read.parquet(f"{work}/records")
        data = records.where("NOT is_header AND NOT is_blank").select("value")
        schema = _inferred(data, columns)
    else:
        schema = text
    parsed = records.select("is_header", "is_blank", *(_parsed(F.col("value"), x).alias(name) for name, x in (("row", text), ("typed", schema))))
    return parsed.where(_is_data(columns)).select("typed.*" if infer else "row.*")


def _first_line(part: Column) -> Column:
    return F.shiftleft(part.cast("long"), 33)


def _is_first(block: Column, line: Column, part: Column) -> Column:
    """Whether a line is its file's first."""
    return (block == 0) & (line == _first_line(part))


def _stage_lines(spark: SparkSession, path: str, staged: str) -> None:
    """Lines with their part and place, stored so that every later step, and
    every repeated task, sees the same parts.

    With files as dear to open as a task may be large, and any number of tasks,
    each task reads one part.
    """
    one_part_each = {
        "spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes"),
        "spark.sql.files.maxPartitionNum": str(2**31 - 1),
    }
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    with settings(spark, one_part_each):
        (
            spark.read.text(path, lineSep="\n")
            .select(
                F.spark_partition_id().alias("part"),
                F.monotonically_increasing_id().alias("line"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                (quotes % 2 == 1).alias("is_turn"),
                "value",
            )
            .write.mode("overwrite")
            .parquet(staged)
        )


def _parts(staged: DataFrame) -> DataFrame:
    """Per part: its turns, whether it starts within a text, and the line that
    opened that text."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turn = F.when(F.col("is_turn"), F.col("line"))
    return (
        staged.groupBy("part", "file", "block")
        .agg(F.count(turn).alias("turns"), F.max(turn).alias("last_turn"))
        .withColumn("within", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2)
        .withColumn("opened", F.last("last_turn", ignorenulls=True).over(earlier))
    )


def _check_closed(parts: DataFrame) -> None:
    """A quote left open is an error, as it would take in the rest of its file as one record."""
    per_file = parts.groupBy("file").agg(F.sum("turns").alias("turns"))
    unclosed = per_file.where("turns % 2 = 1").agg(F.max("file").alias("file")).first()["file"]
    if unclosed:
        raise ValueError(f"unclosed quote in {unclosed}")


def _with_opening_line(staged: DataFrame, parts: DataFrame) -> DataFrame:
    """Lines with the ``start`` of their record, null for a record of one line."""
    in_part = Window.partitionBy("part").orderBy("line")
    so_far = in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = staged.select("part", "block", "line", "is_turn", "value").join(
        parts.select("part", "within", "opened"), "part"
    )
    turns = F.sum(F.col("is_turn").cast("int")).over(so_far) + F.col("within")
    counted = joined.withColumn("after", turns % 2 == 1)
    opens = F.col("is_turn") & F.col("after")
    opened = F.coalesce(F.last(F.when(opens, F.col("line")), ignorenulls=True).over(so_far), F.col("opened"))
    return counted.select(
        "part", "block", "line", "value", F.when(F.col("is_turn") | F.col("after"), opened).alias("start")
    )


def _without_end(line: Column) -> Column:
    """The line without the CR of a line end of two characters."""
    return F.when(line.endswith("\r"), line.substr(F.lit(1), F.length(line) - 1)).otherwise(line)


def _conforming(record: Column) -> Column:
    """The record, if all its quotes belong to quoted cells; else an error.

    An even number of stray quotes would join lines that are not one record.
    """
    quoted_cell = '(?<=^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'
    stray = F.regexp_replace(record, quoted_cell, "").contains('"')
    message = F.concat(F.lit("quote within an unquoted cell, read without --large: "), F.left(record, F.lit(200)))
    return F.when(~F.contains(record, F.lit('"')) | ~stray, record).otherwise(F.raise_error(message).cast("string"))


def _inferred(records: DataFrame, columns: list[str]) -> StructType:
    """The types that Spark infers for the cells of records, each a text of its own."""
    spark = records.sparkSession
    texts = getattr(records._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.options(**QUOTING, header="false", inferSchema="true")
    found = DataFrame(reader._jreader.csv(texts), spark).schema
    if len(found) > len(columns):
        found = StructType(found.fields[: len(columns)])
    types = [field.dataType for field in found] + [StringType()] * (len(columns) - len(found))
    return StructType([StructField(name, kind) for name, kind in zip(columns, types, strict=True)])


def _parsed(record: Column, schema: StructType) -> Column:
    return F.from_csv(record, schema.toDDL(), QUOTING)


def _is_data(columns: list[str]) -> Column:
    """Leaves out blank lines and headers; a header with other names is an error."""
    same = F.col("row") == F.struct(*[F.lit(name).alias(name) for name in columns])
    other = F.raise_error(F.concat(F.lit("CSV header does not conform: "), F.to_json("row"))).cast("boolean")
    return ~F.col("is_blank") & F.when(~F.col("is_header"), True).when(same, False).otherwise(other)


def land(rows: DataFrame, path: str) -> DataFrame:
    """Store rows as Parquet once and read them back from there.

    Later jobs then read only the columns they need, in splits of any size.
    """
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
