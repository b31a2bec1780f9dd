"""Quality rules: a threshold table compiled into one projection of built-in functions.

``RULES`` names a ratio of base counts, a comparison and a bound; ``judge`` turns the
table into columns. Everything is a Catalyst expression: no user function, no shuffle, one
row in and one row out, so the work per document depends on that document alone.

Repeated 5-word windows are searched in two steps: the hashes of a text's windows are
counted first, and only a text in which a hash comes twice pays for the exact step, which
sorts its windows as strings.

Defined results: a null or empty text has no words and fails the length rule; equal rows
get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import ROW, field, let, packed

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
GRAM = 5

# Frequent function words of the four languages, as the corpus writes them.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "for", "from", "in", "is", "of", "on", "that", "the", "this", "to", "was", "with",
    "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une",
    "als", "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "ci", "con", "del", "el", "es", "las", "los", "no", "por", "se", "su", "una", "y",
)

#: (name, ratio, comparison the text must meet, bound, fewest words for the rule to apply)
RULES: tuple[tuple[str, str, str, float, int], ...] = (
    ("mean_word_length_low", "word_chars / n_words", ">=", 1.5, 0),
    ("mean_word_length_high", "word_chars / n_words", "<=", 25.0, 0),
    ("symbols", "n_symbols / n_words", "<=", 0.1, 0),
    ("duplicate_lines", "n_dup_lines / n_lines", "<=", 0.5, 0),
    ("stop_words", "n_stop_words / n_words", ">=", 0.02, 50),
)


def _windows_twice(words: Column, n: Column) -> Column:
    """Number of words inside windows of ``GRAM`` words that the text has twice or more."""
    starts = F.sequence(F.lit(0), n - GRAM)
    gram = lambda i: F.concat_ws(" ", F.slice(words, i + 1, F.lit(GRAM)))
    ordered = F.sort_array(F.transform(starts, lambda i: F.struct(gram(i).alias("g"), i.alias("i"))))
    same = lambda s, k, j: F.get(s, k)["g"].eqNullSafe(F.get(s, j)["g"])

    def covered(s: Column) -> Column:
        twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(s, k, k - 1) | same(s, k, k + 1))
        spans = F.transform(twice, lambda k: let(F.get(s, k)["i"], lambda i: F.sequence(i, i + (GRAM - 1))))
        return F.size(F.array_distinct(F.flatten(spans))).cast("long")

    return let(ordered, covered)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` beside the base counts of every text."""
    t = F.coalesce(F.col("t"), F.lit(""))
    step = packed(docs).select(ROW, field(text).alias("t"))
    step = step.select(
        ROW,
        F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("w"),
        F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0).alias("lines"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    words, n = F.col("w"), F.size("w")
    hashes = F.transform(F.sequence(F.lit(0), n - GRAM), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(GRAM)]))
    step = step.select("*", F.when(n > GRAM, hashes).alias("hashes"))
    repeats = F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), _windows_twice(words, n)).otherwise(F.lit(0).cast("long"))
    spoken = [v for s in STOP_WORDS for v in (s, s.capitalize())]
    found = F.struct(
        n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
        F.size(F.filter(words, lambda x: x.isin(spoken))).cast("long").alias("n_stop_words"),
    )
    # A generator's output: a filter on a measure can't be pushed below it, where the words
    # would be made anew for every element that a rule looks at.
    return step.select(ROW, F.explode_outer(F.array(found)).alias("found")).select(ROW, "found.*")


def compile_rules(rules=RULES) -> Column:
    """One boolean: every rule of the table holds. A rule with too few words holds."""
    verdict = F.lit(True)
    for _, ratio, compare, bound, fewest in rules:
        above, below = (F.col(x.strip()) for x in ratio.split("/"))
        value = above / F.when(below > 0, below)
        holds = F.coalesce(value >= bound if compare == ">=" else value <= bound, F.lit(True))
        verdict = verdict & (holds if not fewest else holds | (F.col("n_words") < fewest))
    return verdict


def judge(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``row``, the base counts, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measure(docs, text).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The input's rows that pass."""
    return judge(docs, text, rules).where("kept").select(*[field(c).alias(c) for c in docs.columns])
