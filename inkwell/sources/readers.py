"""Readers: headed CSV files, families of corpora, labelled text folders, word lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.sources.schemas import struct_type
from inkwell.sources.split_csv import read_split_csv


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: str | None = None, sep: str = ",", whole_files: bool = False
) -> DataFrame:
    """A headed CSV table; quoted fields may hold line breaks and doubled quotes.

    With ``schema`` (a DDL string) the header must carry the same names in the same order.
    Without it the types are inferred in an extra pass over the file. A file is read by as many tasks as it
    has splits; ``whole_files`` reads each in one task, as files with quotes inside unquoted fields need.
    """
    if not whole_files:
        return read_split_csv(spark, path, None if schema is None else struct_type(schema), sep)
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"', sep=sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(struct_type(schema)).option("enforceSchema", False).csv(path)


def read_corpora(
    spark: SparkSession,
    paths: Mapping[str, str],
    renames: Mapping[str, str] | None = None,
    columns: Sequence[str] = ("text", "prompt_name", "label"),
    repeats: Mapping[str, int] | None = None,
    schemas: Mapping[str, str] | None = None,
) -> DataFrame:
    """Several CSV corpora as one table with columns ``columns`` and ``origin``.

    ``renames`` maps other spellings of a column to ours. ``repeats`` gives a corpus more
    weight by listing its rows that many times. ``schemas`` gives the types of a corpus as DDL,
    which saves the pass that infers them.
    """
    parts = []
    for origin, path in paths.items():
        part = read_csv(spark, path, (schemas or {}).get(origin))
        for old, new in (renames or {}).items():
            if old in part.columns and new not in part.columns:
                part = part.withColumnRenamed(old, new)
        part = part.select(*[c for c in columns if c in part.columns], F.lit(origin).alias("origin"))
        times = (repeats or {}).get(origin, 1)
        if times != 1:
            part = repeat_rows(part, times)
        parts.append(part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def repeat_rows(df: DataFrame, times: int) -> DataFrame:
    """Every row ``times`` times."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_copy")


def read_labelled_folders(spark: SparkSession, path: str, exclude: Sequence[str] = ()) -> DataFrame:
    """``root/<class>/<file>`` as ``(path, class_name, text, label)``, one row per file.

    The label is the place of the class among the class names in alphabetical order.
    Folders named in ``exclude`` are skipped; nothing on disk is removed.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
        .withColumn("class_name", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
    )
    if exclude:
        files = files.where(~F.col("class_name").isin(*exclude))
    classes = files.select("class_name").distinct()
    names = classes.agg(F.array_sort(F.collect_set("class_name"))).scalar()
    return files.select(
        "path", "class_name", "text", (F.array_position(names, F.col("class_name")) - 1).cast("int").alias("label")
    )


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path, length)`` of the files below ``path`` whose name matches ``pattern``."""
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=pattern, recursiveFileLookup=True)
        .load(path)
        .select("path", "length")
    )


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line as ``(word, freq)``: how many lines hold it, blanks removed."""
    words = spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("freq"))


def words_by_frequency(tokens: DataFrame, min_count: int, token_col: str = "token", times_col: str | None = None) -> DataFrame:
    """A dictionary taken from a corpus: ``(word, freq)`` of words seen ``min_count`` times.

    A row is one occurrence, or as many as ``times_col`` says.
    """
    times = F.count("*") if times_col is None else F.sum(times_col)
    return tokens.groupBy(F.col(token_col).alias("word")).agg(times.alias("freq")).where(F.col("freq") >= min_count)
