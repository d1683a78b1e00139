"""CSV files with line breaks in quoted fields, read by many tasks.

A line break ends a record if an even number of quotes stand before it, so what tells where records begin is the
parity of quotes. Lines are read as plain text, in the blocks that tasks read; quotes are counted per block, the
blocks' counts are added up in the order of the file, and each line then knows its parity and its record. A line
that is a record of its own is parsed where it was read; only lines of records with breaks are brought together.

A quote inside a field that is not quoted would be counted as well: such a file must be read as Spark reads it, by
one task. A file with an odd number of quotes fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = ("file", "block")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (its first byte), n, line, quotes; ``n`` rises with a line's place in its block."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("line") - F.length(F.translate("line", '"', ""))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
        F.col("value").alias("line"),
    ).withColumn("quotes", quotes)


def numbered_lines(found: DataFrame) -> DataFrame:
    """file, record, block, at, line, quotes, alone: each line with the number of its record in the file.

    ``alone``: the line is a whole record. Within a block, what depends on the quotes before it is worked out
    for both parities; which one holds, follows from the blocks before.
    """
    ahead = Window.partitionBy(*BLOCK).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy(*BLOCK).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    odd = F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2 == 1
    inner = found.withColumn("odd", odd).withColumn("at", F.row_number().over(Window.partitionBy(*BLOCK).orderBy("n")))
    inner = inner.withColumn("begun_if_odd", F.count_if("odd").over(up_to)).withColumn("begun_if_even", F.count_if(~F.col("odd")).over(up_to))

    blocks = inner.groupBy(*BLOCK).agg(
        F.sum("quotes").alias("quotes"), F.count_if("odd").alias("begun_if_odd"), F.count_if(~F.col("odd")).alias("begun_if_even")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("file")
    open_quote = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    even = F.sum("quotes").over(every) % 2 == 0
    sound = F.when(even, True).otherwise(F.raise_error(F.concat(F.lit("unclosed quote in "), "file")).cast("boolean"))
    blocks = blocks.withColumn("open", open_quote & sound)
    begun = F.when(F.col("open"), F.col("begun_if_odd")).otherwise(F.col("begun_if_even"))
    blocks = blocks.select(*BLOCK, "open", F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("begun_before"))

    joined = inner.join(blocks, list(BLOCK))
    begins = F.col("odd") == F.col("open")
    own = F.when(F.col("open"), F.col("begun_if_odd")).otherwise(F.col("begun_if_even"))
    return joined.select(
        "file", (F.col("begun_before") + own).alias("record"), "block", "at", "line", "quotes", (begins & (F.col("quotes") % 2 == 0)).alias("alone")
    )


def records(found: DataFrame) -> DataFrame:
    """file, record (from 1), text of every record, without the line break that ends it; empty lines are none."""
    rows = numbered_lines(found)
    whole = rows.filter("alone").select("file", "record", F.col("line").alias("text"))
    pieces = rows.filter("NOT alone").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("pieces"))
    joined = pieces.select("file", "record", F.array_join("pieces.line", "\n").alias("text"))
    text = F.regexp_replace("text", "\r\\z", "")
    return whole.unionByName(joined).withColumn("text", text).filter("text <> ''")


def header_of(schema: T.StructType, options: dict[str, str]) -> Column:
    """Whether a record names the columns; another header fails the job."""
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema))])
    given = F.from_csv("text", names.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    expected = [f.name.lower() for f in schema]
    right = F.array(*[F.lower(F.trim(given[f"c{i}"])) for i in range(len(schema))]) == F.array(*map(F.lit, expected))
    wrong = F.raise_error(F.concat(F.lit("unexpected header in "), "file", F.lit(": "), "text"))
    return F.when(F.col("record") == 1, F.when(right, True).otherwise(wrong.cast("boolean"))).otherwise(False)


def read_quoted(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The rows of CSV files with a header, whose quoted fields may hold line breaks."""
    found = records(lines(spark, path)).filter(~header_of(schema, options))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return found.select(F.from_csv("text", ddl, options).alias("row")).select("row.*")
