"""Quality rules: a table of thresholds compiled into one projection over text measures, in built-in functions only.

Words are runs of characters other than ASCII white space. Repeated three-word windows are found in the row: if all hashes
of windows differ, there are none (equal windows have equal hashes); otherwise the windows themselves are sorted with their
places and compared with their neighbours, so the count is exact and takes n log n steps.

Defined cases: null texts have no words and fail; empty texts likewise; long texts count whole; repeated rows and other
columns do not matter; a rule whose ratio has no denominator passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from detlake.llm.columns import let, starts, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: frequent words of English, German, French and Spanish
STOP_WORDS = ("the of and to in is that for it was with as on be by this are from or an a der die und das den von zu mit sich auf für ist im dem nicht ein eine als auch es "
              "le la les de des et un une du dans pour que par sur est pas au avec el los las y en del se por con una su al lo no").split()

#: rule: (measure, least, most); a measure that is null passes
RULES = {
    "mean_word": ("word_chars / n_words", 1.5, 20.0),
    "symbols": ("n_symbols / n_words", None, 0.2),
    "stop_words": ("n_stop / n_words", 0.02, None),
    "repeated_lines": ("n_dup_lines / n_lines", None, 0.5),
    "shouting": ("n_marks / n_words", None, 0.4),
}


def _repeated_words(w: Column) -> Column:
    """Words in three-word windows that occur twice or more in the array w."""
    def windows(at):
        return F.transform(at, lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def exact(at):
        pairs = F.array_sort(F.transform(windows(at), lambda s, i: F.struct(s.alias("s"), i.alias("i"))))
        def covered(p):
            twice = F.filter(p, lambda x, j: (F.coalesce(F.get(p, j - 1)["s"] == x["s"], F.lit(False))) | (F.coalesce(F.get(p, j + 1)["s"] == x["s"], F.lit(False))))
            first = F.struct(F.lit(-9).alias("last"), F.lit(0).alias("n"))
            return F.aggregate(F.array_sort(F.transform(twice, lambda x: x["i"])), first,
                               lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])
        return let(pairs, covered)

    def count(at):
        hashes = F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(exact(at)))

    return let(starts(F.size(w), 3), count)


def measures(text: Column) -> Column:
    """Struct of the measures of a text."""
    whole = F.coalesce(text, F.lit(""))

    def of(w):
        lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("twice"), F.size(x).cast("long").alias("n"))).alias("lines"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop"),
            (F.length(whole) - F.length(F.translate(whole, "!?", ""))).cast("long").alias("n_marks"))

    return let(words(whole), of)


def verdict(rules: dict = RULES) -> Column:
    """The table as one condition over the measure columns."""
    kept = F.lit(True)
    for expression, least, most in rules.values():
        above, below = expression.split(" / ")
        ratio = F.col(above) / F.nullif(F.col(below), F.lit(0))
        if least is not None:
            kept = kept & F.coalesce(ratio >= least, F.lit(True))
        if most is not None:
            kept = kept & F.coalesce(ratio <= most, F.lit(True))
    return kept


def quality_verdicts(docs: DataFrame, rules: dict = RULES, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    rows = docs.select(F.col(id).alias("id"), measures(F.col(text)).alias("m")).select("id", "m.*")
    rows = rows.select("*", F.col("lines.twice").alias("n_dup_lines"), F.col("lines.n").alias("n_lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(F.col("id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
