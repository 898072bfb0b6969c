"""Readers and writers, run over tables written from the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.checks import ESSAYS, GRADED, query
from inkwell.session import Scope, cut, scratch_path
from inkwell.sources import readers, sinks
from inkwell.sources.tables import documents, essays, graded_scores, table, targets


def written_csv(df, name, sep=","):
    path = scratch_path(df.sparkSession, name)
    df.write.options(header=True, quote='"', escape='"', sep=sep, emptyValue="").csv(path)
    return path


WRITTEN = "SELECT doc_id AS id, lang AS prompt_name, text, n_chars AS n FROM documents"


@query("scan_csv", WRITTEN)
def scan_csv(spark, folder):
    """Texts with line breaks and quotes written to CSV and read back."""
    docs = documents(spark, folder).select("id", "prompt_name", "text", F.col("n_chars").alias("n"))
    return readers.read_csv(spark, written_csv(docs, "essays"), "id BIGINT, prompt_name STRING, text STRING, n BIGINT")


@query("scan_csv_sep", WRITTEN)
def scan_csv_sep(spark, folder):
    docs = documents(spark, folder).select("id", "prompt_name", "text", F.col("n_chars").alias("n"))
    schema = "id BIGINT, prompt_name STRING, text STRING, n BIGINT"
    return readers.read_csv(spark, written_csv(docs, "essays", ";"), schema, sep=";")


@query(
    "scan_many_csv",
    f"""WITH {ESSAYS} SELECT text, prompt_name, generated AS label, 'main' AS origin FROM essays WHERE generated IS NOT NULL
        UNION ALL SELECT text, NULL, 1, 'chats' FROM conversations, range(2)""",
)
def scan_many_csv(spark, folder):
    """Two corpora with different columns; one is listed twice."""
    main = essays(spark, folder).where("generated IS NOT NULL").select("text", "prompt_name", "generated")
    chats = table(spark, folder, "conversations").select("text", F.lit(1).alias("label"), "role")
    paths = {"main": written_csv(main, "main"), "chats": written_csv(chats, "chats")}
    types = {"main": "text STRING, prompt_name STRING, generated INT", "chats": "text STRING, label INT, role STRING"}
    return readers.read_corpora(spark, paths, {"generated": "label"}, repeats={"chats": 2}, schemas=types)


@query("scan_projected", "SELECT doc_id AS id, source FROM documents")
def scan_projected(spark, folder):
    return documents(spark, folder).select("id", "source")


def labelled_folders(spark, folder):
    """The target texts in four class folders, one file per text."""
    path = scratch_path(spark, "folders")
    texts = targets(spark, folder).select((F.col("id") % 4).alias("part"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("value"))
    texts.repartition("part").write.partitionBy("part").option("maxRecordsPerFile", 1).text(path)
    return path


FOLDERS = """SELECT 'part=' || item_id % 4 AS class_name, {label}, replace(text, chr(10), ' ') AS text FROM benchmark {where}"""


@query("scan_labelled_text_dir", FOLDERS.format(label="item_id % 4 AS label", where=""))
def scan_labelled_text_dir(spark, folder):
    files = readers.read_labelled_folders(spark, labelled_folders(spark, folder))
    return files.select("class_name", F.col("label").cast("bigint").alias("label"), F.rtrim("text", F.lit("\n")).alias("text"))


@query("scan_exclude_subdir", FOLDERS.format(label="greatest(item_id % 4 - 1, 0) AS label", where="WHERE item_id % 4 <> 1"))
def scan_exclude_subdir(spark, folder):
    files = readers.read_labelled_folders(spark, labelled_folders(spark, folder), exclude=["part=1"])
    return files.select("class_name", F.col("label").cast("bigint").alias("label"), F.rtrim("text", F.lit("\n")).alias("text"))


@query("list_files", "SELECT count(*) AS files, sum(strlen(text) + 1)::BIGINT AS bytes FROM benchmark")
def list_files(spark, folder):
    """One file per target lies below the folder; each ends in a line break."""
    files = readers.list_files(spark, labelled_folders(spark, folder), "part-*")
    return files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query(
    "scan_dictionary",
    r"SELECT word, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word FROM documents) GROUP BY word",
)
def scan_dictionary(spark, folder):
    """A word list written as text, one word per line, and read back."""
    path = scratch_path(spark, "words")
    found = F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    documents(spark, folder).select(F.explode(found).alias("value")).write.text(path)
    return readers.read_word_list(spark, path)


@query("cache_dataset", f"""WITH {ESSAYS} SELECT generated, count(*) AS n, (SELECT count(DISTINCT source) FROM essays)::BIGINT AS sources
  FROM essays GROUP BY generated""")
def cache_dataset(spark, folder):
    """A table kept while two counts read it, and let go with the scope; the few counts are written before."""
    with Scope(spark) as scope:
        kept = scope.keep(essays(spark, folder).select("id", "generated", "source"))
        sources = kept.agg(F.count_distinct("source")).first()[0]
        return cut(kept.groupBy("generated").agg(F.count("*").alias("n"), F.lit(sources).alias("sources")))


@query("sink_submission_csv", f"WITH {GRADED} SELECT id, score_a AS generated FROM graded")
def sink_submission_csv(spark, folder):
    """A submission written and read back."""
    path = scratch_path(spark, "submission")
    sinks.write_submission(graded_scores(spark, folder).select("id", F.col("score_a").alias("generated")), path)
    return readers.read_csv(spark, path, "id BIGINT, generated DOUBLE")


@query(
    "sink_constant_fallback",
    "SELECT item_id AS id, 1.0::DOUBLE AS generated FROM benchmark",
)
def sink_constant_fallback(spark, folder):
    """A test table below the wanted size gets the constant."""
    goal = targets(spark, folder)
    scores = goal.select("id", F.lit(0.25).alias("generated"))
    return sinks.constant_fallback(scores, goal, 1.0, 1_000_000_000)
