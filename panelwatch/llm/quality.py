"""Quality rules: a threshold table compiled into one Spark projection.

Every figure is a native SQL expression over the text; there is no user
function, no shuffle and no state, so the operator is one narrow stage.

Edge cases: a null text has no words (all figures 0) and fails the base rule;
so does an empty one.  Repeated rows are judged one by one.  An empty table
gives an empty table.  Columns of the input other than id and text are ignored,
so clashing names are harmless.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8

#: frequent function words of the four languages (fixed values)
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on",
    "that", "the", "this", "to", "was", "with",
    "aus", "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "er", "es", "ist", "mit",
    "nicht", "sich", "sie", "und", "von", "zu",
    "dans", "de", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "ou", "par", "pas",
    "pour", "que", "qui", "sur", "un", "une",
    "al", "como", "con", "del", "el", "la", "las", "lo", "los", "no", "para", "por", "se", "su", "una", "y",
)


@dataclass(frozen=True)
class Rule:
    """Rejects where ``low <= value <= high`` does not hold (None: no bound).  ``value`` is
    the ratio of two figures, written ``a / b``; a ratio over 0 is rejected."""

    name: str
    value: str
    low: float | None = None
    high: float | None = None


#: the threshold table
RULES = (
    Rule("mean_word_length", "word_chars / n_words", 1.5, 25.0),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.5),
    Rule("repeated_lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("stop_words", "n_stop_words / n_words", 0.02, None),
    Rule("upper_case", "n_upper / word_chars", None, 0.6),
)


def _let(value: Column, body) -> Column:
    """Bind ``value`` once as a lambda variable and use it in ``body``."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, WHITE, "") != "")


def _runs(items: Column, size: int, join) -> Column:
    """``join`` over each run of ``size`` (a power of two) consecutive items, by doubling."""
    def doubled(x: Column, k: int) -> Column:
        if k == size:
            return F.slice(x, F.lit(1), F.size(x) - (size - 1))
        return _let(F.zip_with(x, F.slice(x, F.lit(k + 1), F.size(x)), join), lambda y: doubled(y, 2 * k))

    return _let(items, lambda x: doubled(x, 1))


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words that lie in a ``size``-word window which occurs twice or more.

    Equal windows have equal hashes, so a text whose window hashes all differ
    has none and ends there.  In the others the windows themselves are sorted
    and compared as strings (n log n in the text's length)."""
    n = F.size(words)

    def covered(starts: Column) -> Column:
        nxt = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.lit(1 << 30)))
        return F.aggregate(F.zip_with(starts, nxt, lambda a, b: F.least(F.lit(size), b - a)), F.lit(0), lambda s, x: s + x)

    def starts(pairs: Column) -> Column:
        def hit(p, i):
            same = lambda j: F.get(pairs, j)["w"] == p["w"]
            return F.coalesce(same(i + 1), F.lit(False)) | F.coalesce(same(i - 1), F.lit(False))

        return F.sort_array(F.transform(F.filter(pairs, hit), lambda p: p["i"]))

    exact = _let(F.sort_array(F.transform(_runs(words, size, lambda a, b: F.concat(a, F.lit(" "), b)), lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
                 lambda p: _let(starts(p), covered))
    hashes = _runs(F.transform(words, lambda w: F.xxhash64(w)), size, lambda a, b: F.xxhash64(a, b))
    return F.when(n <= size, F.lit(0)).otherwise(
        _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(exact)))


def _figures(base: DataFrame, key: str) -> DataFrame:
    """``key`` and the figures of the text in column ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = base.select(key, text.alias("text"), _words(text).alias("words"), _lines(text).alias("lines"))
    return base.select(
        key,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _let(F.transform("words", lambda w: w), lambda w: repeated_words(w)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("text") - F.length(F.translate("text", UPPER, ""))).cast("long").alias("n_upper"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))).cast("long").alias("n_stop_words"),
    )


def _verdicts(figures: DataFrame, rules, min_words: int, max_repeat_percent: int) -> DataFrame:
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    failed = []
    for r in rules:
        a, _, b = r.value.partition(" / ")
        value = F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | F.coalesce(value < r.low, F.lit(True))
        if r.high is not None:
            bad = bad | F.coalesce(value > r.high, F.lit(True))
        failed.append(F.when(bad, F.lit(r.name)))
    out = figures.withColumn("base_failed", base).withColumn("failed_rules", F.concat_ws(",", *failed) if failed else F.lit(""))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, min_words: int = 20,
                  max_repeat_percent: int = 30) -> DataFrame:
    """One row per input row: figures, base verdict, the rules that reject it
    (``failed_rules``) and ``kept``."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _verdicts(_figures(base, "id"), rules, min_words, max_repeat_percent).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, text_col: str = "text", rules=RULES, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """The rows that the rules keep, all columns as they are (the row rides along, no join)."""
    base = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    return _verdicts(_figures(base, "row"), rules, min_words, max_repeat_percent).where("kept").select("row.*")
