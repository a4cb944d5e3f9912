"""CSV / Parquet scans and sinks.

* Scans use a declared schema or infer one, a header row, and turn floating NaN into SQL
  NULL at the edge: Spark's avg/sum propagate NaN where pandas skips it.
* Sinks never write an index column; they overwrite their target and let
  Spark write one file per partition (no coalesce to a single writer).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rebuy.sources import schemas


# A quote inside a quoted cell is doubled, as every CSV writer of dataframes does.
QUOTING = {"quote": '"', "escape": '"'}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   line_breaks: bool | None = None) -> DataFrame:
    """CSV scan with header.  ``schema`` may be a StructType or a basket table
    name (``orders``, ``products`` ...); without one every column is a long, a
    double or a string, whichever holds all its cells.

    ``line_breaks`` says whether quoted cells may hold line breaks; left open, a
    look at the quotes of all lines decides.  A malformed cell or record fails."""
    if isinstance(schema, str):
        schema = schemas.BY_NAME[schema]
    if line_breaks is None:
        line_breaks = not spark.read.text(path).filter(_quotes("value") % 2 == 1).isEmpty()
    strings = T.StructType([T.StructField(c, T.StringType()) for c in (schema.names if schema else _header(spark, path))])
    wanted = schema or strings
    if line_breaks:
        parsed = F.from_csv("record", wanted.simpleString()[len("struct<"):-1].replace(":", " "),
                            {"mode": "FAILFAST", "multiLine": "true", **QUOTING})
        df = csv_records(spark, path).select(parsed.alias("r")).select("r.*")
    else:
        df = spark.read.schema(wanted).option("header", True).option("mode", "FAILFAST").options(**QUOTING).csv(path)
    return nan_to_null(df if schema else with_inferred_types(df))


def _quotes(line: str) -> Column:
    return F.length(line) - F.length(F.replace(F.col(line), F.lit('"')))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files with a header (column ``record``), where quoted
    cells may hold line breaks.

    The files are read as lines, split like any text.  A line begins a record
    where the quotes before it in its file are even in number: quotes are counted
    per split, the splits' counts are added up, and inside a split (at most
    maxPartitionBytes) the lines' counts are.  Only records of several lines are
    put together from their lines, by a shuffle of those lines."""
    place = Window.partitionBy("file", "block")
    lines = (spark.read.text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
             .withColumn("at", F.monotonically_increasing_id()).withColumn("quotes", _quotes("value")))
    splits = (lines.groupBy("file", "block").agg(F.sum("quotes").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(
                  Window.unboundedPreceding, -1)), F.lit(0))).drop("n"))
    seen = F.sum("quotes").over(place.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (lines.withColumn("seen", seen).join(splits, ["file", "block"])
              .withColumn("after", F.col("before") + F.col("seen"))
              .withColumn("open", (F.col("after") - F.col("quotes")) % 2 == 1))       # the line goes on with a cell
    whole = placed.filter(~F.col("open") & (F.col("quotes") % 2 == 0))
    parts = placed.filter(F.col("open") | (F.col("quotes") % 2 == 1))
    # each of them belongs to the last line before it that began a record, in its split or an earlier one
    begins = F.when(~F.col("open"), F.struct("block", "at"))
    latest = (parts.groupBy("file", "block").agg(F.max(begins).alias("b"))
              .withColumn("earlier", F.max("b").over(Window.partitionBy("file").orderBy("block").rowsBetween(
                  Window.unboundedPreceding, -1))).drop("b"))
    inside = F.max(begins).over(place.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = (parts.withColumn("inside", inside).join(latest, ["file", "block"])
              .withColumn("first", F.coalesce("inside", "earlier"))
              .groupBy("file", "first").agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("ls"))
              .select("file", "first.block", "first.at", F.array_join("ls.value", "\n").alias("value")))
    records = whole.select("file", "block", "at", "value").unionByName(joined)
    heads = lines.filter("block = 0").groupBy("file").agg(F.min("at").alias("head"))
    return (records.join(heads, "file", "left").filter((F.col("block") > 0) | (F.col("at") > F.col("head")))
            .select(F.regexp_replace("value", "\r$", "").alias("record")).filter("record <> ''"))


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).options(**QUOTING).csv(path).columns


def with_inferred_types(df: DataFrame) -> DataFrame:
    """String columns as long, double or string: the first type that all cells
    convert to, found in one pass over all of them.  Empty cells are NULL; a
    column without any cell is a string."""
    names = df.columns
    fits = []
    for i, c in enumerate(names):
        fits += [F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.count(F.when(F.col(f"`{c}`").rlike(r"^[+-]?\d+$"), F.expr(f"try_cast(`{c}` as bigint)"))).alias(f"l{i}"),
                 F.count(F.expr(f"try_cast(`{c}` as double)")).alias(f"d{i}")]
    found = df.agg(*fits).first()
    kinds = ["string" if not found[f"n{i}"] else "bigint" if found[f"l{i}"] == found[f"n{i}"] else
             "double" if found[f"d{i}"] == found[f"n{i}"] else "string" for i in range(len(names))]
    return df.select(*[F.col(f"`{c}`").cast(k).alias(c) for c, k in zip(names, kinds)])


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with a header row and no index column."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}        # a cell's own blanks
    df.write.mode("overwrite").option("header", True).options(**QUOTING, **kept).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet sink (feature tables, bin maps, probabilities)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_feature_tables(train_df: DataFrame, test_df: DataFrame, path: str) -> None:
    """Persist the train and test feature tables as one Parquet dataset
    partitioned by ``split`` (replaces the pickle of the two frames)."""
    both = (train_df.withColumn("split", F.lit("train"))
            .unionByName(test_df.withColumn("split", F.lit("test"))))
    write_parquet(both, path, partition_by=["split"])


def read_feature_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    both = spark.read.parquet(path)
    train = both.filter(F.col("split") == "train").drop("split")
    test = both.filter(F.col("split") == "test").drop("split")
    return train, test
