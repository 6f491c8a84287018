"""Quality rules, lines first: failing lines go, then documents that lose too much.

DataFrame functions only, and no shuffle: all counts of a document come from
arrays within its own row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.llm.text import WORD, words

#: Phrases, in lower case, of lines that are no prose.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "terms and conditions", "privacy policy", "cookie",
    "javascript", "copyright", "©", "subscribe", "newsletter", "sign in", "sign up", "log in", "click here",
    "read more", "share this", "powered by", "lorem ipsum", "creative commons", "licensed under",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the verdict.

    A line with a word fails
    - punctuation: more than ``marks`` of its words carry doubled marks (``!!``, ``%%%``), or it has fewer than
      ``open_words`` words and no closing punctuation,
    - navigation: more than ``separators`` separators (``|`` and the like) per word,
    - boilerplate: it holds phrases of BOILERPLATE, as whole words, and has at most ``boilerplate_words`` words for each.
    A document is rejected if more than ``most_lost`` of its words are in failing lines.
    """

    marks: float = 0.2
    open_words: int = 8
    separators: float = 0.2
    boilerplate_words: int = 12
    most_lost: float = 0.5


MARKS = r"[!?]{2,}|[%&$#*]{2,}"
SEPARATORS = r"[|»•·>]"
#: No letter stands before or after a phrase.
PHRASES = "(?:^|[^a-z])(?:" + "|".join(BOILERPLATE) + ")(?:s|es)?(?:$|[^a-z])"
CLOSED = r"[.!?:;…。！？]['\"”’»)\]\s]*$"


def _lines(text: Column, rules: LineRules) -> Column:
    """Array of (line, n, bad) of the \\n-split lines."""
    counted = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda x: F.struct(x.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("n")),
    )

    def bad(x: Column) -> Column:
        line, n = x["line"], x["n"]
        punctuation = (F.regexp_count(line, F.lit(MARKS)) > rules.marks * n) | (
            (n < rules.open_words) & ~line.rlike(CLOSED)
        )
        navigation = F.regexp_count(line, F.lit(SEPARATORS)) > rules.separators * n
        phrases = F.regexp_count(F.lower(line), F.lit(PHRASES)) * rules.boilerplate_words >= n
        return (n > 0) & (punctuation | navigation | phrases)

    return F.transform(counted, lambda x: F.struct(x["line"].alias("line"), x["n"].alias("n"), bad(x).alias("bad")))


def _gram_keys(found: Column) -> Column:
    """One long for each 3-word window: 33 bits of a hash above 31 bits of the position."""
    starts = F.when(F.size(found) >= 3, F.sequence(F.lit(0), F.size(found) - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda i: F.shiftleft(F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)), 31).bitwiseOR(
            i.cast("long")
        ),
    )


def _with_equal_neighbour(items: Column, same) -> Column:
    """Items of a sorted array that are like the one before or after."""

    def keep(x: Column, i: Column) -> Column:
        before, after = same(x, F.get(items, i - 1)), same(x, F.get(items, i + 1))
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    return F.filter(items, keep)


def _annotated(docs: DataFrame, text: str, rules: LineRules) -> DataFrame:
    """``docs`` with the working columns __words, __lines and __spots (starts of repeated 3-word windows).

    Windows that share 33 hash bits are candidates; the words of these alone are
    then compared, so the result is exact. Sorting keeps the work at n log n for
    a text of n words.
    """
    c = F.col(f"`{text}`")
    df = docs.withColumns({"__words": words(c), "__lines": _lines(c, rules)})
    df = df.withColumn("__keys", F.sort_array(_gram_keys(F.col("__words"))))
    near = _with_equal_neighbour(F.col("__keys"), lambda a, b: F.shiftright(a, 31) == F.shiftright(b, 31))
    df = df.withColumn("__near", near)
    exact = F.transform(
        "__near",
        lambda k: F.transform(
            F.array(k.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")),
            lambda p: F.struct(
                F.slice("__words", p + 1, 3).alias("gram"),
                p.alias("at"),
            ),
        )[0],
    )
    df = df.withColumn("__grams", F.sort_array(exact))
    spots = F.transform(
        _with_equal_neighbour(F.col("__grams"), lambda a, b: a["gram"] == b["gram"]), lambda x: x["at"]
    )
    return df.withColumn("__spots", spots)


def _n(c: Column) -> Column:
    return c.cast("long")


def _verdicts(docs: DataFrame, text: str, rules: LineRules, with_text: bool) -> DataFrame:
    """``docs`` with __rules: counts, verdicts and, ``with_text``, the text without its failing lines.

    The last step is an outer explode of one struct. A filter on its fields stays
    above it; pushed further down, it would take the expressions apart again and
    evaluate whole arrays once per element.
    """
    df = _annotated(docs, text, rules)
    with_word = F.transform(F.filter("__lines", lambda x: x["n"] > 0), lambda x: x["line"])
    covered = F.flatten(F.transform("__spots", lambda p: F.array(p, p + 1, p + 2)))
    none = F.lit(0).cast("long")
    lost = F.aggregate("__lines", none, lambda a, x: a + F.when(x["bad"], x["n"].cast("long")).otherwise(none))
    symbols = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(r"[#*$%&|<>]"))
    df = df.withColumn("__with_word", with_word)
    df = df.withColumns(
        {
            "__n_words": _n(F.size("__words")),
            "__n_dup_lines": _n(F.size("__with_word") - F.size(F.array_distinct("__with_word"))),
            "__n_repeat_words": _n(F.size(F.array_distinct(covered))),
            "__n_lost": lost,
        }
    )
    failed = (F.col("__n_words") < 50) | (100 * F.col("__n_repeat_words") > 50 * F.col("__n_words"))
    kept = ~failed & (F.col("__n_lost") <= rules.most_lost * F.col("__n_words"))
    clean = F.array_join(F.transform(F.filter("__lines", lambda x: ~x["bad"]), lambda x: x["line"]), "\n")
    found = F.struct(
        F.col("__n_words").alias("n_words"),
        _n(F.length(F.array_join("__words", ""))).alias("word_chars"),
        _n(symbols).alias("n_symbols"),
        F.col("__n_dup_lines").alias("n_dup_lines"),
        F.col("__n_repeat_words").alias("n_repeat_words"),
        failed.alias("base_failed"),
        kept.alias("kept"),
        F.col("__n_lost").alias("n_lost"),
        *[clean.alias("clean_text")] * with_text,
    )
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode_outer(F.array(found)).alias("__rules"))


def quality_verdicts(
    docs: DataFrame, rules: LineRules = LineRules(), key: str = "doc_id", text: str = "text", with_text: bool = True
) -> DataFrame:
    """``key``, counts, ``base_failed``, ``kept``, ``n_lost`` (words of failing lines) and, ``with_text``, ``clean_text``.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (``#*$%&|<>``),
    ``n_dup_lines`` (lines with a word, equal to an earlier one) and
    ``n_repeat_words`` (words in 3-word windows found twice or more) describe the
    whole text. ``base_failed``: fewer than 50 words, or more than half of them
    repeated. ``kept``: not so, and the line rules leave enough. ``clean_text`` is
    the text without its failing lines.

    A null text counts as empty: no words, so it fails, and its clean text is
    empty. Repeated rows keep a row each. Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    return _verdicts(rows, "__text", rules, with_text).select(F.col("__key").alias(key), "__rules.*")


def clean_documents(
    docs: DataFrame, rules: LineRules = LineRules(), text: str = "text", size: str | None = "n_chars"
) -> DataFrame:
    """The rows of ``docs`` that are kept, failing lines removed; ``size`` is set to the text's new length.

    Other columns are kept, whatever their names.
    """
    rest = [c for c in docs.columns if c not in (text, size)]
    rows = docs.select(F.struct(F.lit(0), *[F.col(f"`{c}`") for c in rest]).alias("__row"), F.col(f"`{text}`").alias("__text"))
    df = _verdicts(rows, "__text", rules, True).where("__rules.kept")
    new = {text: F.col("__rules.clean_text")}
    if size in docs.columns:
        new[size] = F.length("__rules.clean_text").cast(docs.schema[size].dataType)
    return df.select(*[(new[c] if c in new else F.col("__row").getField(c)).alias(c) for c in docs.columns])
