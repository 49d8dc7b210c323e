"""Line-first cleaning with DataFrame functions only.

Every line is judged by rules on punctuation, navigation and boilerplate; lines
that fail are removed, and a document that loses too much of its text that way, or
fails the base counts, is rejected.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweek.llm.columns import col, without

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"

# A document needs so many words, and may repeat so many percent of them.
MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED_PERCENT = 20

# A line of more words than this must have the end of a sentence somewhere.
MAX_UNFINISHED_WORDS = 8

# Signs that end a sentence, those of European scripts before a space or the end
# of the line only; and the letters of Thai and Lao, which are written without such signs.
STOPS = ".!?…:;"
OTHER_STOPS = "।॥۔؟؛。！？｡．：；։՜՞።፧፨။၊།៕៖᠃᠉‼⁇⁈⁉"
NO_STOPS = r"\x{0E00}-\x{0EFF}"
SENTENCE_END = rf"[{STOPS}][\x22'”’»)\]]?([\x20\x09-\x0D]|\z)|[{OTHER_STOPS}{NO_STOPS}]"

# Signs, shouts and separators per word of a line, beyond which it is no prose.
MAX_SYMBOLS_PER_WORD = 0.6
MAX_SHOUTS_PER_WORD = 0.3
MAX_SEPARATORS_PER_WORD = 0.2

# Phrases that a line of boilerplate is made of, by language. A longer line may mention them.
PHRASES = {
    "en": r"cookie|privacy policy|terms of (use|service)|all rights reserved|sign (in|up)|log ?in"
    r"|subscribe|newsletter|javascript|click here|read more|share (this|on)|lorem ipsum",
}


def boilerplate(phrases: Mapping[str, str]) -> str:
    """One pattern for the phrases of all languages, in upper or lower case."""
    return "(?i)" + "|".join(phrases.values())


BOILERPLATE = boilerplate(PHRASES)
MAX_BOILERPLATE_WORDS = 12

# A document must keep this share of the characters of its lines.
MIN_KEPT_SHARE = 0.5


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))


def lines_with_words(text: Column) -> Column:
    """The lines of a text, each with its number of words (at least 1, if only a border)."""
    return F.transform(
        F.split(text, "\n"),
        lambda x: F.struct(x.alias("line"), F.size(F.split(F.trim(x), SPACE + "+")).alias("words")),
    )


def line_passes(of: Column, pattern: str = BOILERPLATE) -> Column:
    """Whether a line, given with its number of words, is kept; one without words always is."""
    line, words = of["line"], of["words"]
    punctuation = (
        ((words <= MAX_UNFINISHED_WORDS) | F.rlike(line, F.lit(SENTENCE_END)))
        & (_symbols(line) <= MAX_SYMBOLS_PER_WORD * words)
        & (_count(line, "[!?]{2,}") <= MAX_SHOUTS_PER_WORD * words)
    )
    navigation = _count(line, r"[|»›·•→]") <= MAX_SEPARATORS_PER_WORD * words
    plain = (words > MAX_BOILERPLATE_WORDS) | ~F.rlike(line, F.lit(pattern))
    return (F.trim(line) == "") | (punctuation & navigation & plain)


def _repeated_words(df: DataFrame) -> DataFrame:
    """Adds the number of words inside windows that a text holds twice or more.

    Windows compare by 64-bit hashes. Only texts with an equal pair sort them.
    Columns that a function of elements looks into are columns of their own, so
    that they are made once per row.
    """
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    h = F.col("hashes")
    each = F.transform(
        h, lambda x, i: F.xxhash64(x, *(F.get(h, i + F.lit(k)) for k in range(1, WINDOW)))
    )
    df = df.withColumn("windows", F.slice(each, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))))
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.sort_array(
        F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    )
    df = df.withColumn("twice", F.when(some, ordered))
    t = F.col("twice")
    alike = F.filter(
        t,
        lambda w, i: F.coalesce(
            (w["x"] == F.get(t, i - 1)["x"]) | (w["x"] == F.get(t, i + 1)["x"]),
            w["x"] == F.get(t, i - 1)["x"],
            w["x"] == F.get(t, i + 1)["x"],
            F.lit(False),
        ),
    )
    df = df.withColumn("places", F.sort_array(F.transform(alike, lambda w: w["i"])))
    p = F.col("places")
    covered = F.transform(
        p, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - at, F.lit(WINDOW)))
    )
    total = F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("bigint")))


RESULTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "kept",
    "kept_share",
    "clean_text",
)


def clean_lines(
    df: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    phrases: Mapping[str, str] = PHRASES,
) -> DataFrame:
    """``keep``, the base counts, ``base_failed``, ``kept``, ``kept_share`` and ``clean_text``.

    Words are runs of other than ASCII spaces. ``kept_share`` is the share of the
    characters of lines that passed the rules, 1 for a text without any. A null
    text counts as an empty one: no words, so it fails. Every row is judged by
    itself and stays, repeated ones too. An empty table gives an empty result. A long text is
    worked on whole, as one row of the plan. ``phrases`` are patterns of boilerplate by
    language. Sentences may end as in any script of ``OTHER_STOPS``, and words are
    what spaces part, so a line of a script without spaces counts as few of them.
    """
    kept = {name: f"k{i}" for i, name in enumerate(without(keep, RESULTS))}
    body = F.coalesce(col(text), F.lit(""))
    df = df.select(*(col(name).alias(k) for name, k in kept.items()), body.alias("raw"))
    df = df.withColumn("words", F.array_remove(F.split("raw", SPACE + "+"), ""))
    df = df.withColumn("lines", lines_with_words(F.col("raw")))
    df = _repeated_words(df)
    df = df.withColumn("good", F.filter("lines", lambda line: line_passes(line, boilerplate(phrases)))["line"])
    some_word = r"[^\x20\x09-\x0D]"
    with_word = F.filter(F.col("lines")["line"], lambda x: F.rlike(x, F.lit(some_word)))
    df = df.withColumn("full", with_word)
    chars = F.length("raw") - F.size("lines") + 1
    good_chars = F.length(F.array_join("good", ""))
    share = F.when(chars > 0, good_chars / chars).otherwise(1.0)
    n_words = F.size("words").cast("bigint")
    repeated = F.col("n_repeat_words")
    failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)
    return df.select(
        *(F.col(k).alias(name) for name, k in kept.items()),
        n_words.alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        _symbols(F.col("raw")).cast("bigint").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (share >= MIN_KEPT_SHARE)).alias("kept"),
        share.alias("kept_share"),
        F.array_join("good", "\n").alias("clean_text"),
    )
