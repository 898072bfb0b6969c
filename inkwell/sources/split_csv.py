"""CSV files with quoted line breaks, read by many tasks.

Spark's text source cuts a file in splits at any line. Whether a line begins inside quotes follows from the
number of quotes before it, so each split counts its quotes once, the counts are added up along the
file, and a second pass puts records together. Only a record that crosses a split leaves its task.
``from_csv`` parses the records.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.session import broadcast_if_small, cut

#: Types an inferred column may have, from narrow to wide.
INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")
NUMBERS = {"int": r"^[+-]?\d+$", "bigint": r"^[+-]?\d+$", "double": r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$",
           "date": r"^\d{4}-\d{2}-\d{2}$", "timestamp": r"^\d{4}-\d{2}-\d{2}[T ].+$", "boolean": r"(?i)^(true|false)$"}


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, block, value``: the lines of all files, in order inside a split."""
    found = spark.read.option("lineSep", "\n").text(path)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _split_starts(lines: DataFrame) -> DataFrame:
    """``file, block, opened``: 1 for a split that begins inside quotes. One row per split, written."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counted = lines.select("file", "block", quotes.alias("quotes")).groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return cut(counted.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int").alias("opened")))


def records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``record, head``: every CSV record as one string, and whether it is the first of its file."""
    lines = _lines(spark, path)
    opened = lines.join(broadcast_if_small(_split_starts(lines)), ["file", "block"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, inside, kind, head, held, done = None, 0, "", False, [], []

        def give(what: str) -> None:
            if held:
                done.append((*split, what, head, "\n".join(held)))

        for batch in batches:
            files, blocks, values = batch["file"].to_numpy(), batch["block"].to_numpy(), batch["value"].to_numpy()
            odd, begun = batch["value"].str.count('"').to_numpy() % 2, batch["opened"].to_numpy()
            fresh = np.append(True, (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1]))
            for i, value in enumerate(values):
                if fresh[i] and (files[i], blocks[i]) != split:
                    give("open")  # the last split ended inside a record
                    split, inside, held = (files[i], int(blocks[i])), int(begun[i]), []
                    kind, head = "rest" if inside else "whole", split[1] == 0
                held.append(value)
                inside ^= int(odd[i])
                if not inside:
                    give(kind)
                    kind, head, held = "whole", False, []
            yield pd.DataFrame(done, columns=columns)
            done.clear()
        give("open")
        yield pd.DataFrame(done, columns=columns)

    columns = ["file", "block", "kind", "head", "record"]
    found = opened.mapInPandas(run, "file string, block long, kind string, head boolean, record string")
    # a record cut by splits: opened in one, perhaps open all through others, ended by the rest in a last one
    return found.where("kind = 'whole'").select("record", "head").unionByName(_joined(found.where("kind <> 'whole'")))


def _joined(pieces: DataFrame) -> DataFrame:
    """The records that cross splits, put together; each split gives a rest and an open end at most."""
    ends = F.when(F.col("kind") == "rest", 1).otherwise(0)
    order = Window.partitionBy("file").orderBy("block", F.desc("kind"))
    placed = pieces.withColumn("number", F.sum(ends).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    placed = placed.withColumn("number", F.coalesce("number", F.lit(0)))
    parts = F.sort_array(F.collect_list(F.struct("block", "record")))
    grouped = placed.groupBy("file", "number").agg(parts.alias("parts"), F.bool_or("head").alias("head"))
    return grouped.select(F.array_join("parts.record", "\n").alias("record"), "head")


def _trimmed(record: Column) -> Column:
    return F.regexp_replace(record, "\r$", "")


def _names(record: str, sep: str) -> list[str]:
    import csv

    return next(csv.reader([record.removeprefix("﻿").removesuffix("\r")], delimiter=sep), [])


def infer_types(rows: DataFrame) -> str:
    """The narrowest type of each text column that all its values have, as DDL; a column of nulls stays text."""
    tests = []
    for name in rows.columns:
        value = F.col(f"`{name}`")
        fits = [F.count_if(value.rlike(NUMBERS[kind]) & value.try_cast(kind).isNotNull()) for kind in INFERRED]
        tests += [F.count(value), *fits]
    counts = list(rows.agg(*[t.alias(f"c{i}") for i, t in enumerate(tests)]).first())
    kinds = []
    for i, name in enumerate(rows.columns):
        total, *fits = counts[i * (len(INFERRED) + 1) : (i + 1) * (len(INFERRED) + 1)]
        kind = next((k for k, n in zip(INFERRED, fits) if total and n == total), "string")
        kinds.append(f"`{name}` {kind}")
    return ", ".join(kinds)


def read_split_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """A headed CSV table whose files are read split by split.

    Quotes follow RFC 4180: a field with a quote is quoted, and the quote is doubled. The header must carry
    the schema's names; without a schema the types are inferred in a further pass.
    """
    found = records(spark, path)
    first = found.where("head").select("record").first()
    if first is None:
        return spark.createDataFrame([], schema or T.StructType())
    names = _names(first[0], sep)
    if schema is not None and names != schema.fieldNames():
        raise ValueError(f"the header {names} does not match {schema.fieldNames()}")
    body = found.where(~F.col("head")).select(_trimmed(F.col("record")).alias("record")).where("record <> ''")
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}

    def parsed(ddl: str) -> DataFrame:
        return body.select(F.from_csv("record", ddl, options).alias("row")).select("row.*")

    texts = ", ".join(f"`{n}` string" for n in names)
    if schema is None:
        return parsed(infer_types(parsed(texts)))
    return parsed(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema))
