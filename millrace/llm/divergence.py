"""Quality rules: text statistics, and how far a text's histograms lie from those of its language. Built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: guards: shorter texts are not compared, their histograms say little; smaller references are not used
MIN_CHARS_COMPARED = 200
MIN_WORDS_COMPARED = 50
MIN_REFERENCE_WORDS = 5000
#: largest Jensen-Shannon divergences (squared distances, bits) of a kept text: what texts of a language differ by, and what
#: chance adds to a text of n words or characters. Chance alone makes 8 ln 2 n times the divergence of k shares a chi-square of
#: k - 1 degrees; words are allowed its mean and four deviations, characters, which come in words, a fixed number.
WORD_SLACK, WORD_DEVIATIONS = 0.01, 4
CHAR_SLACK, CHAR_CHANCE = 0.03, 6.0

# Common words of the languages, in natural order.
COMMON_WORDS = {
    "en": "the of and to in a is that it was for on with as be by at this an are or from not".split(),
    "de": "die der und in zu den das nicht von sie ist des sich mit dem ein es auch für auf eine".split(),
    "fr": "de la le et les des en un du une est pour que dans par au sur pas qui il avec".split(),
    "es": "de la que el en y a los del se las por un para con no una su al es lo".split(),
}
LONGEST_COMMON = max(len(w) for words in COMMON_WORDS.values() for w in words)
#: resolution of the typical shares
SHARE_BINS = 2000
CHAR_CLASSES = ("lower", "upper", "digit", "space", "symbol", "other_ascii", "beyond_ascii")


def _length_of(text: Column, others: str) -> Column:
    """Number of characters left when runs of ``others`` go."""
    return F.char_length(F.regexp_replace(text, others, ""))


def _with_statistics(rows: DataFrame) -> DataFrame:
    """Adds the base columns and both histograms to ``rows`` (text without nulls, lang)."""
    text = F.col("text")
    rows = rows.withColumn("_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("long"),
        "_lines": F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(WORD))),
        "_run1": F.transform("_words", lambda w: F.xxhash64(w)),
    })
    # windows by a 64-bit hash: two different ones of a document agree with odds of (windows squared / 2**65). Each word is
    # hashed once, then runs of 2, 4 and 8 words from the runs of half the length.
    width = 1
    while width < REPEAT_WINDOW:
        run = F.col(f"_run{width}")
        later = F.slice(run, width + 1, F.greatest(F.size(run), F.lit(1)))
        longer = F.zip_with(run, later, lambda x, y: F.xxhash64(x, y))
        # a window that is found twice starts with half a window that is
        rows = rows.withColumn(f"_run{2 * width}", longer if 2 * width < REPEAT_WINDOW else F.when(F.size(F.array_distinct(run)) < F.size(run), longer))
        width *= 2
    rows = rows.withColumns({
        "_windows": F.when(F.size("_words") >= REPEAT_WINDOW, F.slice(f"_run{REPEAT_WINDOW}", 1, F.size("_words") - (REPEAT_WINDOW - 1))),
    })
    rows = rows.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_sorted": F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"),
                          F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    })
    rows = rows.withColumn("_places", F.array_sort(F.transform(
        F.filter("_sorted", lambda x, k: (F.coalesce(F.get("_sorted", k - 1)["h"] == x["h"], F.lit(False)))
                 | (F.coalesce(F.get("_sorted", k + 1)["h"] == x["h"], F.lit(False)))), lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))
    covered = F.aggregate(
        F.coalesce("_places", F.array().cast("array<int>")), start,
        lambda a, p: F.struct((p + REPEAT_WINDOW).alias("to"), (a["n"] + p + REPEAT_WINDOW - F.greatest(a["to"], p)).alias("n")), lambda a: a["n"])
    n_chars = F.char_length(text)
    lists = F.coalesce(*[F.when(F.col("lang") == k, F.array(*map(F.lit, v))) for k, v in COMMON_WORDS.items()])
    rows = rows.withColumns({
        "n_repeat_words": covered.cast("long"),
        "_upper": _length_of(text, "[^A-Z]+"), "_lower": _length_of(text, "[^a-z]+"), "_digit": _length_of(text, "[^0-9]+"),
        "_beyond": _length_of(text, r"[\x00-\x7F]+"), "_n": n_chars,
        # every word between spaces of its own, so that a word and its spaces can be counted by length; words too long for a list go
        "_plain": F.concat(F.lit(" "), F.regexp_replace(F.lower(text), rf"[^\p{{L}}]++(?:\p{{L}}{{{LONGEST_COMMON + 1},}}+[^\p{{L}}]*+)*+", "  "), F.lit(" ")),
        "_list": lists,
    })
    plain = F.col("_plain")
    rows = rows.withColumns({
        "_found": F.transform("_list", lambda w: ((F.char_length(plain) - F.char_length(F.replace(plain, F.concat(F.lit(" "), w, F.lit(" ")), F.lit(""))))
                                                  / (F.char_length(w) + 2)).cast("long")),
        "chars": F.array(*[c.cast("long") for c in (
            F.col("_lower"), F.col("_upper"), F.col("_digit"), F.col("_n") - F.col("word_chars"), F.col("n_symbols"),
            F.col("word_chars") - F.col("_lower") - F.col("_upper") - F.col("_digit") - F.col("n_symbols") - F.col("_beyond"), F.col("_beyond"))]),
    })
    total = F.greatest("n_words", F.aggregate("_found", F.lit(0).cast("long"), lambda a, x: a + x))
    return rows.withColumn("common", F.when(F.col("_list").isNotNull(), F.concat(
        "_found", F.array(total - F.aggregate("_found", F.lit(0).cast("long"), lambda a, x: a + x)))))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(counts, lambda x: x / F.greatest(total, F.lit(1).cast("long")))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance of two distributions (arrays of equal length): 0 if equal, 1 if they share nothing. Its square is the divergence."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    each = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def typical_histograms(rows: DataFrame) -> DataFrame:
    """(lang, usual_chars, usual_common): what is usual for a document of each language, however many rows a source has.

    Of each share the median over a source's documents, and of those the median over the language's sources, so a
    source counts once and a kind of junk only where it is more than half of most sources. Only texts long enough
    to be compared count. Medians are exact on shares in steps of 1 / SHARE_BINS: at most SHARE_BINS + 1 counts each.
    """
    n_chars = F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    none = F.array().cast("array<double>")
    shares = lambda name, enough: F.when(enough, F.coalesce(_shares(F.col(name)), none)).otherwise(none)
    parts = [("chars", n_chars >= MIN_CHARS_COMPARED), ("common", F.col("n_words") >= MIN_WORDS_COMPARED)]
    step = lambda name: lambda x, i: F.struct(F.lit(name).alias("part"), i.alias("k"), F.floor(x * SHARE_BINS).alias("step"))
    steps = F.concat(*[F.transform(shares(name, enough), step(name)) for name, enough in parts])
    found = rows.select("lang", "source", F.explode(steps).alias("s")).select("lang", "source", "s.*")
    found = found.groupBy("lang", "source", "part", "k", "step").agg(F.count("*").alias("n"))
    found = found.groupBy("lang", "source", "part", "k").agg(F.percentile("step", F.lit(0.5), F.col("n")).alias("m"))
    # quarters of a step, as a median of medians may lie between two
    found = found.groupBy("lang", "part", "k").agg((F.percentile("m", F.lit(0.5)) * 4).cast("long").alias("m"))
    usual = lambda name: F.transform(F.array_sort(F.collect_list(F.when(F.col("part") == name, F.struct("k", "m")))), lambda x: x["m"])
    return found.groupBy("lang").agg(usual("chars").alias("usual_chars"), usual("common").alias("usual_common"))


def references(rows: DataFrame) -> DataFrame:
    """(lang, ref_words, usual_chars, usual_common): words of all documents of a language, and its typical histograms."""
    words = rows.groupBy("lang").agg(F.sum("n_words").alias("ref_words"))
    usual = typical_histograms(rows).withColumnRenamed("lang", "_lang")
    return words.join(usual, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")


def judged(docs: DataFrame) -> DataFrame:
    """Every row's doc_id, base columns (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed), kept,
    char_distance and word_distance.

    Texts are compared with their language's ``typical_histograms``, which a hot source cannot move. kept is false if
    base_failed, or if the square of a distance is above its limit, which falls with the length of the text: see
    ``WORD_SLACK``. A distance is null where the text or the language has too few words, and the word distance for
    languages without a list; null counts as near.

    A null text has no words, so it fails; a null lang is a language of its own, a null source a source. Repeated rows are
    judged alike; columns other than doc_id, text, lang and source (if there is one) are ignored, whatever their names. A
    very long text is one row like any other. An empty table gives no rows. The rows move to the references only as counts: one
    row for each language is written and joined back, broadcast as long as its file is small.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"),
                       (F.col("source") if "source" in docs.columns else F.lit(None)).cast("string").alias("source"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = stored(_with_statistics(rows).select("doc_id", "lang", "source", *base, "chars", "common"), "divergence-statistics")
    refs = stored(references(rows).withColumnRenamed("lang", "_lang").coalesce(1), "divergence-references")
    rows = rows.join(refs, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    n_chars = F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.withColumn("_chars", n_chars)
    enough = F.col("ref_words") >= MIN_REFERENCE_WORDS
    compared = {"char": enough & (F.col("_chars") >= MIN_CHARS_COMPARED), "word": enough & (F.col("n_words") >= MIN_WORDS_COMPARED) & F.col("common").isNotNull()}
    distance = lambda kind, own, ref: F.when(compared[kind] & (F.size(ref) > 0), jensen_shannon(_shares(F.col(own)), _shares(F.col(ref))))
    rows = rows.withColumns({
        "char_distance": distance("char", "chars", "usual_chars"), "word_distance": distance("word", "common", "usual_common"),
        "base_failed": (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
    })
    degrees = (F.size("common") - 1).cast("double")
    chance = (degrees + F.sqrt(degrees * 2) * WORD_DEVIATIONS) / (8 * math.log(2))
    limits = {"char_distance": CHAR_SLACK + F.lit(CHAR_CHANCE) / F.col("_chars"), "word_distance": WORD_SLACK + chance / F.col("n_words")}
    far = [F.coalesce(F.when(F.col(c).isNotNull(), F.col(c) * F.col(c) > limit), F.lit(False)) for c, limit in limits.items()]
    return rows.select("doc_id", *base, "base_failed", (~F.col("base_failed") & ~(far[0] | far[1])).alias("kept"), "char_distance", "word_distance")
