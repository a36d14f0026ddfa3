"""CSV and parquet tables with declared schemas, on any Hadoop file-system URI."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tastegrid.session import materialize

# Column types of the raw tables. Dirty columns stay text until they are scrubbed.
SCHEMAS = {
    "ratings": "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT",
    "movies_metadata": (
        "id STRING, imdb_id STRING, title STRING, overview STRING, tagline STRING, status STRING, "
        "original_language STRING, adult STRING, video STRING, budget STRING, revenue DOUBLE, "
        "runtime DOUBLE, popularity STRING, vote_count INT, vote_average DOUBLE, release_date DATE, "
        "genres STRING, production_companies STRING, production_countries STRING, spoken_languages STRING"
    ),
    "credits": "cast STRING, crew STRING, id INT",
    "keywords": "id INT, keywords STRING",
    "links": "movieId INT, imdbId INT, tmdbId DOUBLE",
}

# Only free text holds line breaks; the nested lists write them as \\n. Everything else stays splittable, so that one
# large file is read by many tasks. A line break where none belongs puts the row's first part into the quarantine, while
# its last part may pass for a row: such a file is to be read again with ``multiline``.
MULTILINE = {"movies_metadata"}

QUOTING = {"quote": '"', "escape": '"'}
CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """Headered CSV whose quoted fields may hold commas and doubled quotes.

    Columns are taken by the order of ``schema``; a header with other names is an error rather
    than a silent shift. A column ``_corrupt_record STRING`` at its end takes the text of rows that do not parse.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .options(**QUOTING)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multiline)
        .csv(path)
    )


def read_checked(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows that parse, and the quarantine (record, reason) of those that do not; together all rows of the file.

    The reason is ``columns`` where a row has too many or too few fields, else the names of the columns whose text is no
    value of their type. The file is parsed once, all columns at a time, into the shared folder: a scan that
    leaves columns out would not see what is wrong in them.
    """
    parsed = materialize(read_csv(spark, path, f"{schema}, {CORRUPT} STRING", multiline))
    bad = parsed.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("record"), _reason(F.col(CORRUPT), StructType.fromDDL(schema)).alias("reason"))
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def _reason(record: Column, schema: StructType) -> Column:
    texts = StructType().add(CORRUPT, StringType())
    for field in schema:
        texts.add(field.name, StringType())
    split = F.from_csv(record, texts.simpleString()[len("struct<"):-1].replace(":", " "), {**QUOTING, "columnNameOfCorruptRecord": CORRUPT})
    wrong = F.concat_ws(", ", *[
        F.when(split[f.name].isNotNull() & split[f.name].try_cast(f.dataType).isNull(), f.name) for f in schema])
    return F.when(split[CORRUPT].isNotNull(), "columns").when(wrong != "", wrong).otherwise("format")


def read_table(spark: SparkSession, path: str, table: str, multiline: bool = False) -> DataFrame:
    """One of the raw tables in ``SCHEMAS`` by name."""
    return read_csv(spark, path, SCHEMAS[table], multiline or table in MULTILINE)


def read_table_checked(spark: SparkSession, path: str, table: str, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """One of the raw tables in ``SCHEMAS`` and its quarantine."""
    return read_checked(spark, path, SCHEMAS[table], multiline or table in MULTILINE)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """The default sink: keeps arrays and vectors, prunes columns and partitions on re-read."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def load_tables(spark: SparkSession, base: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Parquet tables of one folder as ``{name: DataFrame}``."""
    return {name: spark.read.parquet(f"{base}/{name}.parquet") for name in names}


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write Parquet in folders by the values of ``by``; a rerun replaces the folders that its rows belong to and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def store_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Save as a table dealt to ``buckets`` files by ``keys`` and sorted by them, replacing one of that name.

    Aggregates, windows and joins of such tables by these keys read them where they lie, without an exchange.
    """
    df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)
