"""Text clean-up, tokens and length measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.checks import query
from inkwell.functions import arrays
from inkwell.functions import text as tx
from inkwell.operators.relational import dedup_rows
from inkwell.session import spread
from inkwell.sources.tables import documents, targets

SEED = 42
SPACES = tx.SPACE_CLASS
TRIM = "'" + tx.SPACE_CHARS + "'"
ASCII_FOLD = r"regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')"


def texts(spark, folder, column, name="text"):
    return spread(documents(spark, folder)).select("id", column.alias(name))


@query("normalize_nfkd", "SELECT doc_id AS id, text FROM documents")
def normalize_nfkd(spark, folder):
    """Decompose, then compose again: the round trip must give the text back."""
    decomposed = texts(spark, folder, tx.normalize_unicode(F.col("text"), "NFKD"))
    return decomposed.select("id", tx.normalize_unicode(F.col("text"), "NFC").alias("text"))


@query("normalize_nfkd_ascii", f"SELECT doc_id AS id, {ASCII_FOLD} AS text FROM documents")
def normalize_nfkd_ascii(spark, folder):
    return texts(spark, folder, tx.strip_non_ascii(tx.normalize_unicode(F.col("text"), "NFKD")))


@query("normalize_nfc", "SELECT doc_id AS id, nfc_normalize(text) AS text FROM documents")
def normalize_nfc(spark, folder):
    return texts(spark, folder, tx.normalize_unicode(F.col("text"), "NFC"))


@query("strip_non_ascii", r"SELECT doc_id AS id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS text FROM documents")
def strip_non_ascii(spark, folder):
    return texts(spark, folder, tx.strip_non_ascii(F.col("text")))


PADDED = "padded AS (SELECT doc_id AS id, chr(10) || ' ' || chr(160) || text || chr(9) || ' ' || chr(10) AS text FROM documents)"


def padded(spark, folder):
    """Documents with white space of several kinds at both ends."""
    return spread(documents(spark, folder)).select("id", F.concat(F.lit("\n \xa0"), "text", F.lit("\t \n")).alias("text"))


@query("strip_ws", f"WITH {PADDED} SELECT id, trim(text, {TRIM}) AS text FROM padded")
def strip_ws(spark, folder):
    return padded(spark, folder).withColumn("text", tx.strip_ws(F.col("text")))


@query("strip_newlines", f"WITH {PADDED} SELECT id, trim(text, chr(10)) AS text FROM padded")
def strip_newlines(spark, folder):
    return padded(spark, folder).withColumn("text", tx.strip_newlines(F.col("text")))


@query(
    "strip_trailing_blank",
    rf"WITH {PADDED} SELECT id, regexp_replace(text, '[ \t]+(\n?)\z', '\1') AS text FROM padded",
)
def strip_trailing_blank(spark, folder):
    return padded(spark, folder).withColumn("text", tx.strip_trailing_blank(F.col("text")))


@query("delete_chars", r"SELECT doc_id AS id, regexp_replace(text, '[;\-$\[\]()]', '', 'g') AS text FROM documents")
def delete_chars(spark, folder):
    return texts(spark, folder, tx.delete_chars(F.col("text")))


@query(
    "clean_for_training",
    rf"SELECT doc_id AS id, regexp_replace(trim({ASCII_FOLD}, {TRIM}), '[;\-$\[\]()]', '', 'g') AS text FROM documents",
)
def clean_for_training(spark, folder):
    return texts(spark, folder, tx.clean_for_training(F.col("text")))


@query(
    "prepend_prompt",
    f"SELECT doc_id AS id, '{tx.INSTRUCTION.strip()}' || chr(10) || text AS text FROM documents",
)
def prepend_prompt(spark, folder):
    return texts(spark, folder, tx.prepend_prompt(F.col("text")))


@query("newline_to_space", "SELECT doc_id AS id, replace(text, chr(10), ' ') AS text FROM documents")
def newline_to_space(spark, folder):
    return texts(spark, folder, tx.newline_to_space(F.col("text")))


@query(
    "lowercase",
    "SELECT doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents",
)
def lowercase(spark, folder):
    return texts(spark, folder, tx.lower_ascii(F.col("text")))


@query("char_length", "SELECT doc_id AS id, length(text)::INTEGER AS n FROM documents")
def char_length(spark, folder):
    return texts(spark, folder, F.length("text"), "n")


@query(
    "word_count",
    f"SELECT doc_id AS id, len(regexp_extract_all(text, '[^{SPACES}]+'))::INTEGER AS n FROM documents",
)
def word_count(spark, folder):
    return texts(spark, folder, tx.word_count(F.col("text")), "n")


@query("literal_replace", "SELECT doc_id AS id, replace('\"' || source || '\"', '\"src3\"', 'src3') AS name FROM documents")
def literal_replace(spark, folder):
    quoted = F.concat(F.lit('"'), "source", F.lit('"'))
    return texts(spark, folder, F.replace(quoted, F.lit('"src3"'), F.lit("src3")), "name")


TOKENS = rf"regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[.,{SPACES}]')"


@query("regex_tokens", f"SELECT doc_id AS id, array_to_string({TOKENS}, '|') AS tokens FROM documents")
def regex_tokens(spark, folder):
    return texts(spark, folder, tx.join_tokens(tx.regex_tokens(F.col("text")), "|"), "tokens")


@query("join_tokens", f"SELECT doc_id AS id, array_to_string({TOKENS}, '') AS text FROM documents")
def join_tokens(spark, folder):
    return texts(spark, folder, tx.join_tokens(tx.regex_tokens(F.col("text"))))


@query("text_preview", "SELECT doc_id AS id, left(text, 100) || ' .... ' || right(text, 100) AS text FROM documents")
def text_preview(spark, folder):
    return texts(spark, folder, tx.text_preview(F.col("text")))


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _draw(part: str) -> str:
    return f"('0x' || substr(md5('{SEED}:' || doc_id || ':{part}'), 1, 8))::BIGINT"


@query(
    "obfuscate_text",
    f"""WITH drawn AS (SELECT doc_id AS id, text, source, {_draw("apply")} / {2**32}.0 AS u, {_draw("branch")} / {2**32}.0 AS b,
          {_draw("group")} AS g, {_draw("letter")} AS l FROM documents),
        picked AS (SELECT *, {_list(tx.BIGRAMS[:10])}[g % 10 + 1] AS near, {_list(tx.BIGRAMS)}[g % {len(tx.BIGRAMS)} + 1] AS two,
          {_list(tx.TRIGRAMS)}[g % {len(tx.TRIGRAMS)} + 1] AS three FROM drawn)
        SELECT id, CASE WHEN source = 'src0' OR u >= 0.3 THEN text
          WHEN b < 0.4 AND l % 2 = 0 THEN replace(text, near[1], near[2]) WHEN b < 0.4 THEN replace(text, near[2], near[1])
          WHEN b < 0.8 THEN replace(text, two[l % 2 + 1], two) ELSE replace(text, three[l % 3 + 1], three) END AS text FROM picked""",
)
def obfuscate_text(spark, folder):
    """Disturb the texts of all sources but one."""
    disturbed = tx.obfuscate(F.col("text"), F.col("id"), SEED)
    return texts(spark, folder, F.when(F.col("source") != "src0", disturbed).otherwise(F.col("text")))


@query(
    "token_ngrams",
    r"""WITH t AS (SELECT doc_id AS id, regexp_extract_all(text, '\S+') AS k FROM documents),
        w AS (SELECT id, unnest(k) AS w, generate_subscripts(k, 1) AS p FROM t),
        n AS (SELECT id, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS g3, g3 || ' ' || lead(w, 3) OVER o AS g4,
          g4 || ' ' || lead(w, 4) OVER o AS g5 FROM w WINDOW o AS (PARTITION BY id ORDER BY p)),
        g AS (SELECT id, unnest([g3, g4, g5]) AS term FROM n)
        SELECT id, count(*) AS n, count(DISTINCT term) AS terms, sum(('0x' || substr(md5(term), 1, 8))::BIGINT)::BIGINT AS digest
        FROM g WHERE term IS NOT NULL GROUP BY id""",
)
def token_ngrams(spark, folder):
    """All 3- to 5-grams, summed up per document by count and digest."""
    return gram_digests(documents(spark, folder).select("id", "text"), 3, 5)


def gram_digests(docs, low, high):
    """``id, n, terms, digest``: the number of n-grams, of distinct ones and the sum of their digests per id with any.

    A text is summed up where it lies. Only different texts that share an id send n-grams, to count those they have in common once.
    """
    grams = arrays.token_ngrams(F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0)), low, high)
    number = lambda g: F.conv(F.substring(F.md5(g), 1, 8), 16, 10).cast("bigint")
    total = lambda gs: F.aggregate(gs, F.lit(0).cast("bigint"), lambda acc, g: acc + number(g))
    facts = lambda gs: F.struct(F.size(gs).alias("n"), F.size(F.array_distinct(gs)).alias("terms"), total(gs).alias("digest"))
    rows = spread(docs).select("id", F.inline(F.transform(F.array(grams), facts))).where("n > 0")
    summed = rows.groupBy("id").agg(F.sum("n").alias("n"), F.max("terms").cast("bigint").alias("terms"), F.sum("digest").alias("digest"))
    repeated = docs.groupBy(F.col("id").alias("_id")).agg(F.count("*").alias("_rows")).where("_rows > 1").select("_id")
    shared = dedup_rows(docs.join(repeated, F.col("id").eqNullSafe(F.col("_id")), "left_semi"))
    united = shared.select(F.col("id").alias("_id"), F.explode(F.array_distinct(grams)).alias("term"))
    united = united.groupBy("_id").agg(F.count_distinct("term").alias("_terms"))
    joined = summed.join(united, F.col("id").eqNullSafe(F.col("_id")), "left")
    return joined.select("id", "n", F.coalesce("_terms", "terms").alias("terms"), "digest")


LENGTHS = "lengths AS (SELECT doc_id AS id, list_transform(string_split(text, ' '), lambda w: length(w)::INTEGER) AS ids FROM documents)"


def length_ids(spark, folder):
    """A list of ids per document: the lengths of its words."""
    return documents(spark, folder).select("id", F.transform(F.split("text", " "), F.length).alias("ids"))


@query(
    "pad_truncate_mask",
    f"""WITH {LENGTHS} SELECT id, array_to_string((ids || list_transform(range(200), lambda x: 0))[1:200], ',') AS input_ids,
        array_to_string(list_transform(range(200), lambda x: (x < len(ids))::INTEGER), ',') AS attention_mask FROM lengths""",
)
def pad_truncate_mask(spark, folder):
    ids = F.col("ids")
    return length_ids(spark, folder).select(
        "id",
        F.array_join(arrays.pad_ids(ids, 200, 0), ",").alias("input_ids"),
        F.array_join(arrays.attention_mask(ids, 200), ",").alias("attention_mask"),
    )


@query(
    "pad_frame_special",
    f"""WITH {LENGTHS} SELECT id, array_to_string(([101] || ids[1:126] || [102] || list_transform(range(128), lambda x: 0))[1:128], ',') AS input_ids
        FROM lengths""",
)
def pad_frame_special(spark, folder):
    framed = arrays.frame_ids(F.col("ids"), 101, 102, 128)
    return length_ids(spark, folder).select("id", F.array_join(arrays.pad_ids(framed, 128, 0), ",").alias("input_ids"))


@query(
    "last_token_index",
    f"""WITH {LENGTHS}, p AS (SELECT id, len(ids) AS n, coalesce(list_position(ids, 9), 0) AS pad FROM lengths)
        SELECT id, (CASE WHEN pad <= 1 THEN n - 1 ELSE pad - 2 END)::INTEGER AS last FROM p""",
)
def last_token_index(spark, folder):
    return length_ids(spark, folder).select("id", arrays.last_token_index(F.col("ids"), 9).alias("last"))


@query(
    "subword_decode",
    r"""SELECT item_id AS id, regexp_replace(regexp_replace(text, '(\S{3})(\S)', '\1 ##\2'), ' ##', '', 'g') AS text FROM benchmark""",
)
def subword_decode(spark, folder):
    pieces = F.split(F.regexp_replace("text", r"(\S{3})(?=\S)", "$1 ##"), " ")
    return targets(spark, folder).select("id", arrays.subword_decode(pieces).alias("text"))


@query(
    "special_tokens",
    f"""WITH vocab AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS token FROM benchmark),
        reserved AS (SELECT * FROM (VALUES (0, '[UNK]'), (1, '[PAD]'), (2, '[CLS]'), (3, '[SEP]'), (4, '[MASK]')) v(token_id, token))
        SELECT token_id, token FROM reserved UNION ALL
        SELECT row_number() OVER (ORDER BY token) + 4, token FROM vocab""",
)
def special_tokens(spark, folder):
    from inkwell.operators.order import range_index
    from inkwell.operators.subword import with_special_tokens

    words = targets(spark, folder).select(F.explode(F.split("text", " ")).alias("token")).distinct()
    return with_special_tokens(range_index(words, ["token"], "token_id"))
