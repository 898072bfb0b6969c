"""Text clean-up and text measures: column in, column out.

All but the Unicode normal forms are built-in expressions.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# First and last code point of each run of characters Python counts as white space.
SPACE_RUNS = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
SPACE_CHARS = "".join(chr(code) for first, last in SPACE_RUNS for code in range(first, last + 1))
SPACE_CLASS = "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in SPACE_RUNS)
WORD_CLASS = r"\p{L}\p{N}_"
# The same characters with ASCII tried first, which settles most of them by one comparison.
NO_SPACE = rf"[\x21-\x7E[^{SPACE_CLASS}]]+"
LOWER_WORD = f"[a-z[{WORD_CLASS}]]{{2,}}"
# Kinds of characters that are replaced one by one in a text; with more of them a pattern is faster.
MANY_KINDS = 64
# What the clean-up step deletes.
DELETED_CHARS = ";-$[]()"
# The instruction put before every text.
INSTRUCTION = (
    "Check whether the following essay is human written or AI generated? "
    "Remember, the text might have undergone multiple stages of obfuscation.\n"
)
# Frequent letter groups used to disturb a text.
BIGRAMS = [
    "th", "he", "in", "en", "nt", "re", "er", "an", "ti", "es", "on", "at",
    "se", "nd", "or", "ar", "al", "te", "co", "de", "to", "ra", "et", "ed",
]
TRIGRAMS = ["the", "and", "tha", "ent", "ing", "ion", "tio", "for", "nde", "has", "nce"]


def _normal_form(form: str):
    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    return convert


def normalize_unicode(text: Column, form: str) -> Column:
    """Unicode normal form ``form``; pure ASCII texts never leave the JVM."""
    ascii_only = text.rlike(r"^[\x00-\x7F]*$")
    return F.when(ascii_only, text).otherwise(_normal_form(form)(F.when(~ascii_only, text)))


def strip_non_ascii(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]+", "")


def strip_ws(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def strip_newlines(text: Column) -> Column:
    return F.btrim(text, F.lit("\n"))


def strip_trailing_blank(text: Column) -> Column:
    """Drop blanks and tabs at the end, also before one final line break."""
    return F.regexp_replace(text, r"(?d)[ \t]+$", "")


def delete_chars(text: Column, chars: str = DELETED_CHARS) -> Column:
    return F.translate(text, chars, "")


def clean_for_training(text: Column) -> Column:
    """Fold to ASCII, strip, delete punctuation: the clean-up chain in order."""
    folded = strip_non_ascii(normalize_unicode(text, "NFKD"))
    return delete_chars(strip_trailing_blank(strip_ws(folded)))


def prepend_prompt(text: Column, prompt: str = INSTRUCTION) -> Column:
    return F.concat(F.lit(prompt), text)


def newline_to_space(text: Column) -> Column:
    return F.translate(text, "\n", " ")


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Maximal runs of non-space characters."""
    return F.regexp_extract_all(text, F.lit(NO_SPACE), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NO_SPACE))


def regex_tokens(text: Column) -> Column:
    """Words, full stops, commas and single white spaces; all else is lost."""
    return F.regexp_extract_all(text, F.lit(f"[{WORD_CLASS}]+|[.,{SPACE_CLASS}]"), F.lit(0))


@cache
def word_ranges() -> list[str]:
    """All characters of ``WORD_CLASS`` as ranges of a Python character class.

    Spark is asked once, as Java and Python may follow different editions of Unicode.
    """
    every = "".join(chr(code) for code in range(0x110000) if not 0xD800 <= code <= 0xDFFF)
    one = SparkSession.active().createDataFrame([(every,)], "text string")
    runs = one.select(F.regexp_extract_all("text", F.lit(f"[{WORD_CLASS}]+"), F.lit(0))).first()[0]
    return [f"{run[0]}-{run[-1]}" for run in runs]


class Letters(dict):
    """Whether a character is one of ``WORD_CLASS``, found out once for each that is met."""

    def __init__(self, ranges: list[str]):
        self.test = re.compile(f"[{''.join(ranges)}]")

    def __missing__(self, char: str) -> bool:
        self[char] = self.test.match(char) is not None
        return self[char]


def word_finder() -> Callable[[str], list[str]]:
    """The words among the ``regex_tokens`` of a text, for Python.

    Every other character becomes a blank, one kind of character at a time, and blanks cut the text.
    """
    letters, pattern = Letters(word_ranges()), re.compile(f"[{''.join(word_ranges())}]+")

    def find(text: str) -> list[str]:
        others = [c for c in set(text) if not letters[c]]
        if len(others) > MANY_KINDS:
            return pattern.findall(text)
        for c in others:
            text = text.replace(c, " ")
        return text.split()

    return find


def token_finder() -> Callable[[str], list[str]]:
    """The ``regex_tokens`` of a text, for Python; empty strings may stand between them."""
    letters, pattern = Letters(word_ranges()), re.compile(f"[{''.join(word_ranges())}]+|[.,{re.escape(SPACE_CHARS)}]")
    own = {c: f"\0{c}\0" for c in ".," + SPACE_CHARS}

    def find(text: str) -> list[str]:
        others = [c for c in set(text) if not letters[c]]
        if len(others) > MANY_KINDS:
            return pattern.findall(text)
        for c in sorted(others):  # \0 comes first, before it stands for a cut
            text = text.replace(c, own.get(c, "\0"))
        return text.split("\0")

    return find


def plain_word_count(text: Column) -> Column:
    """``word_count`` by Python, whose white space is the same."""

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else len(t.split()) for t in texts], dtype="Int32")

    return count(text)


def lower_words(text: Column) -> Column:
    """Lower-case words of two characters or more."""
    return F.regexp_extract_all(F.lower(text), F.lit(LOWER_WORD), F.lit(0))


def join_tokens(tokens: Column, sep: str = "") -> Column:
    return F.array_join(tokens, sep)


def text_preview(text: Column, width: int = 100) -> Column:
    return F.concat(F.left(text, F.lit(width)), F.lit(" .... "), F.right(text, F.lit(width)))


def hash_int(seed: int, key: Column, part: str) -> Column:
    """A repeatable number in 0 .. 2^32-1 drawn from ``seed``, ``key`` and ``part``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"), F.lit(f":{part}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _pick(options: Sequence[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (number % len(options) + 1).cast("int"))


def obfuscate(text: Column, key: Column, seed: int, share: float = 0.3) -> Column:
    """Disturb a ``share`` of the texts by swapping or widening one letter.

    Of these, 40 % have a letter replaced by its bigram neighbour, 40 % have it widened to a
    bigram and 20 % to a trigram. The random draws are hashes of ``key``.
    """
    scale = float(2**32)
    applies = hash_int(seed, key, "apply") / scale < share
    branch = hash_int(seed, key, "branch") / scale
    group = hash_int(seed, key, "group")
    letter = hash_int(seed, key, "letter")

    near = _pick(BIGRAMS[:10], group)
    first, second = F.substring(near, 1, 1), F.substring(near, 2, 1)
    swapped = F.when(letter % 2 == 0, F.replace(text, first, second)).otherwise(F.replace(text, second, first))
    two = _pick(BIGRAMS, group)
    widened = F.replace(text, F.substr(two, (letter % 2 + 1).cast("int"), F.lit(1)), two)
    three = _pick(TRIGRAMS, group)
    widest = F.replace(text, F.substr(three, (letter % 3 + 1).cast("int"), F.lit(1)), three)
    return (
        F.when(~applies, text).when(branch < 0.4, swapped).when(branch < 0.8, widened).otherwise(widest)
    )
