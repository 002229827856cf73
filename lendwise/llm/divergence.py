"""Quality rules by distribution divergence (native).

A document is compared with the reference of its language: the
Jensen-Shannon distance between its histogram of character classes, and of
the language's commonest words, and those of all documents of the language.
Short documents are guarded: below a least length a histogram says little
and its test is skipped.  Only DataFrame and SQL expressions are used.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import WORD_SPACES, materialise

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WORD_SPLIT = r"[\x20\x09-\x0D]+"
FEW = 32  # repeated windows up to which a search beats a sort


@dataclass(frozen=True)
class Limits:
    """``common_words`` words per language make its word histogram (and one
    cell for the rest).  ``tracked`` bounds the sketch that proposes them: it
    errs by no more than 3.5/tracked of a language's words.  Where that leaves
    it open which words are the commonest, the language's words are counted
    exactly.  The distances are square roots of the divergence in bits, 0 to
    1."""
    min_words: int = 50
    max_repeat_pct: int = 50
    common_words: int = 16
    tracked: int = 4096
    min_class_chars: int = 200
    max_class_distance: float = 0.28
    min_common_words: int = 64
    max_common_distance: float = 0.36
    max_languages: int = 1000


def _words(text: Column) -> Column:
    # Splitting on one character is a fast path; runs leave empty entries.
    spaced = F.regexp_replace(text, r"[\x09-\x0D]", " ")
    return F.array_remove(F.split(spaced, " ", -1), "")


def _count(text: Column, chars: str) -> Column:
    """Code points of ``text`` in a character class, counted by removing the
    runs of all others."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def class_counts(n_chars: Column, left: Column) -> Column:
    """The code points of each class of a text: white space, symbols, upper
    case, digits, punctuation and the rest.  ``left`` is the text without its
    runs of a-z, most of it, so that the counts read little."""
    counts = [_count(left, r"\x20\x09-\x0D"), _count(left, re.escape(SYMBOLS)), _count(left, r"\p{Lu}"),
              _count(left, "0-9"), _count(left, r"\p{P}\^~`+=&&[^#*%&]")]
    rest = F.greatest(F.lit(0), n_chars - sum(counts[1:], counts[0]))
    return F.array(*counts, rest)


def base_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    kept_words: Callable[[Column], Column] | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """(id, lang, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, classes, found) and the columns ``extra``; ``found`` is
    ``kept_words`` of the array of words.  A null text has no words and no
    lines."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), text.alias("text"), *extra)
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(WORD_SPACES)) != "")
    rows = rows.select("id", "lang", *extra, F.length("text").alias("n_chars"), lines.alias("lines"),
                       F.regexp_replace("text", "[a-z]+", "").alias("left"), _words(F.col("text")).alias("words"))
    n_dup_lines = (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    found = F.array().cast("array<string>") if kept_words is None else kept_words(F.col("words"))
    rows = rows.select("id", "lang", *extra, "n_chars", n_dup_lines.alias("n_dup_lines"),
                       class_counts(F.col("n_chars"), F.col("left")).alias("classes"), found.alias("found"),
                       F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # A hash stands in for the three words of a window: 64 bits, compared
    # only within one document.
    n = F.size("hashes")
    three = F.arrays_zip("hashes", F.slice("hashes", F.lit(2), n), F.slice("hashes", F.lit(3), n))
    grams = F.slice(F.transform(three, lambda x: F.xxhash64(x)), F.lit(1), F.greatest(F.lit(0), n - 2))
    grams = F.when(n >= 3, grams).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumns({"grams": grams, "n_words": n.cast("long")}).drop("hashes")
    # A set is cheaper than a sort, a sort of numbers cheaper than one of
    # structs, so each step is only for documents that need it: the grams
    # found again, and their windows, by search where they are few and by
    # sorting (gram, window) where they are many.
    rows = rows.withColumn("ordered", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array("grams")))
    rows = rows.withColumn("again", F.array_distinct(F.filter("ordered", lambda g, j: F.get("ordered", j - 1) == g)))
    few = F.filter(F.transform("grams", lambda g, i: F.when(F.array_contains("again", g), i)), lambda i: i.isNotNull())
    numbered = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    rows = rows.withColumn("numbered", F.when(F.size("again") > FEW, numbered))
    twice = F.filter("numbered", lambda e, j: (F.get("numbered", j - 1)["g"] == e["g"])
                     | F.coalesce(F.get("numbered", j + 1)["g"] == e["g"], F.lit(False)))
    many = F.sort_array(F.transform(twice, lambda e: e["i"]))
    at = F.when(F.col("numbered").isNull(), few).otherwise(many)
    first = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(at, first, lambda a, i: F.struct(
        i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])
    word_chars = F.col("n_chars") - F.get("classes", F.lit(0))
    return rows.select(
        "id", "lang", *extra, "n_words", word_chars.cast("long").alias("word_chars"),
        F.get("classes", F.lit(1)).cast("long").alias("n_symbols"), "n_dup_lines",
        F.when(F.col("again").isNotNull(), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        "classes", "found")


# The error of the sketch, as a share of the words times ``tracked``.
SKETCH_ERROR = 3.5


def common_words(docs: DataFrame, limits: Limits, text_col: str, lang_col: str) -> DataFrame:
    """(lang, words): words among which the ``common_words`` commonest of the
    language are certain to be.

    A mergeable frequent-items sketch of bounded size per task and language
    proposes twice as many, so no shuffle of all distinct words is needed and
    a hot language is pre-aggregated.  The proposals hold the commonest words
    if the last of these, less the sketch's error, is above all that the
    sketch did not propose; a language of which that is not sure, as its words
    are used alike, is counted word by word.
    """
    k = limits.common_words
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = docs.select(_language(lang_col).alias("lang"), F.explode(_words(text)).alias("w"))
    top = F.expr(f"approx_top_k(w, {2 * k}, {limits.tracked})")
    found = words.groupBy("lang").agg(top.alias("top"), F.count("*").alias("n"))
    error = F.ceil(F.lit(SKETCH_ERROR / limits.tracked) * F.col("n"))
    # The sketch names no word that may be below its error, so it can give
    # fewer than asked for.
    sure = (F.size("top") == 2 * k) & (F.get("top", F.lit(k - 1))["count"] - error
                                       > F.greatest(F.get("top", F.lit(2 * k - 1))["count"], error))
    found = materialise(found.select("lang", F.array_sort(F.transform("top", lambda t: t["item"])).alias("words"), 
                                     F.coalesce(sure, F.lit(False)).alias("sure")), "common_words")
    unsure = found.where("not sure").select("lang")
    if unsure.isEmpty():
        return found.select("lang", "words")
    # Counted before the shuffle; of the counts each task keeps the first k of
    # a language before they meet.
    counts = words.join(unsure, "lang", "left_semi").groupBy("lang", "w").agg(F.count("*").alias("n"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))
    exact = counts.withColumn("rank", first).where(F.col("rank") <= k).groupBy("lang").agg(F.array_sort(F.collect_list("w")).alias("words"))
    return found.where("sure").select("lang", "words").unionByName(materialise(exact, "exact_common_words"))


def _language(lang_col: str) -> Column:
    return F.coalesce(F.col(lang_col).cast("string"), F.lit(""))


def document_counts(docs: DataFrame, proposed: DataFrame, limits: Limits, id_col: str, text_col: str,
                    lang_col: str) -> DataFrame:
    """One pass over the texts: the base statistics, the class counts and
    ``word_counts``, how often each proposed word of the row's language
    stands in the text.  Written out; all that follows reads this small table."""
    docs = docs.select(F.col(id_col).alias("id"), _language(lang_col).alias("lang"), F.col(text_col).alias("text"))
    if proposed.count() <= limits.max_languages:
        # At most max_languages x 2 x common_words short strings.
        known = sorted({w for r in proposed.collect() for w in r.words})
        kept = (lambda words: F.filter(words, lambda w: w.isin(known))) if known else None
        proposed = F.broadcast(proposed)
    else:
        kept = lambda words: F.filter(words, lambda w: F.array_contains("proposed", w))
    docs = docs.join(proposed.select("lang", F.col("words").alias("proposed")), "lang", "left")
    rows = base_statistics(docs, "id", "text", "lang", kept, ("proposed",))
    # The common words of the text, each between two spaces: a word's count
    # is what removing it takes away.
    rows = rows.withColumn("found", F.concat(F.lit(" "), F.array_join("found", "  "), F.lit(" ")))
    counts = F.transform("proposed", lambda w: ((F.length("found") - F.length(F.replace(
        F.col("found"), F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.length(w) + 2)).cast("int"))
    rows = rows.withColumn("word_counts", counts).drop("found", "proposed")
    return materialise(rows, "document_counts")


def references(counted: DataFrame, proposed: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per language ('' for none): ``ref_words``, the places of its
    common words among the proposals, ``ref_common``, their shares of all
    words of the language with the rest last, and ``ref_classes``, the shares
    of the character classes.  Exact counts over all documents."""
    sums = counted.groupBy("lang").agg(
        F.sum("n_words").alias("total"), *[F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(6)])
    words = (counted.select("lang", F.posexplode("word_counts").alias("place", "n"))
             .groupBy("lang", "place").agg(F.sum("n").alias("n"))
             .groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(
                 F.struct((-F.col("n")).alias("minus"), "place"))), 1, limits.common_words).alias("top")))
    chars = F.greatest(F.lit(1), sum((F.col(f"c{i}") for i in range(1, 6)), F.col("c0")))
    share = F.transform("top", lambda t: -t["minus"] / F.greatest(F.lit(1), F.col("total")))
    rest = F.greatest(F.lit(0.0), 1.0 - F.aggregate("common", F.lit(0.0), lambda a, x: a + x))
    out = (sums.join(words, "lang", "left")
           .withColumn("top", F.coalesce("top", F.array().cast("array<struct<minus:bigint,place:int>>")))
           .withColumn("common", share))
    return out.select("lang", F.transform("top", lambda t: t["place"]).alias("ref_words"),
                      F.concat("common", F.array(rest)).alias("ref_common"),
                      F.array(*[F.col(f"c{i}") / chars for i in range(6)]).alias("ref_classes"))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two arrays of
    shares; 0 log 0 counts as 0."""
    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2.0 * a / (a + b))).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: term(a, b) + term(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    # greatest and least skip nulls, a skipped test must stay null.
    return F.when(total.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total / 2))))


def quality_rules(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """Per row: the base statistics, ``class_distance`` and
    ``common_distance`` (null where the length guard skips the test),
    ``base_failed`` and ``kept``.

    Documents without a language are one group with a reference of its own.
    Null and empty texts fail the base rule; repeated rows and null ids come
    back as given; an empty table gives an empty result.
    """
    proposed = common_words(docs, limits, text_col, lang_col)
    rows = document_counts(docs, proposed, limits, id_col, text_col, lang_col)
    refs = materialise(references(rows, proposed, limits), "language_references")
    if refs.count() <= limits.max_languages:
        refs = F.broadcast(refs)  # at most max_languages rows of 2 x common_words + 7 numbers
    rows = rows.join(refs, "lang", "left")
    cells = F.transform("ref_words", lambda i: F.get("word_counts", i) / F.col("n_words"))
    rows = rows.withColumn("cells", F.when(F.col("n_words") >= limits.min_common_words, cells))
    others = F.greatest(F.lit(0.0), 1.0 - F.aggregate("cells", F.lit(0.0), lambda a, x: a + x))
    rows = rows.withColumn("cells", F.concat("cells", F.array(others)))
    rows = rows.withColumn("chars", F.aggregate("classes", F.lit(0), lambda a, x: a + x))
    shares = F.when(F.col("word_chars") >= limits.min_class_chars, F.transform("classes", lambda c: c / F.col("chars")))
    rows = (rows.withColumn("class_distance", js_distance(shares, F.col("ref_classes")))
            .withColumn("common_distance", js_distance(F.col("cells"), F.col("ref_common"))))
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_pct * F.col("n_words"))
    close = (F.coalesce(F.col("class_distance") <= limits.max_class_distance, F.lit(True))
             & F.coalesce(F.col("common_distance") <= limits.max_common_distance, F.lit(True)))
    return rows.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "class_distance", "common_distance", failed.alias("base_failed"),
                       (~failed & close).alias("kept"))
