"""Quality rules by distribution divergence (DataFrame and SQL functions only).

A document's histogram of character classes and of common words is compared with the reference of its
language by Jensen-Shannon distance (base 2, 0 to 1). References are sums over all documents of the
language: the classes' shares, and the ``top`` most frequent words of at most ``short`` letters with
their shares (all other words are one more bin). The words' divergence is lessened by what a sample of
the document's length shows by chance. Documents below ``min_words`` words are too short to
judge and keep the base verdict.

Every value of ``lang`` has a reference of its own. Up to ``MAX_LANGS`` references are broadcast; beyond
that, the largest are, and only texts of the rarer languages are joined by shuffle. A document without a
language is judged by the nearest reference: the one whose distances, each as a part of its threshold,
have the smallest maximum. If no document has a language, there is no reference, and the base verdict
stands.

Defined results: null text has no words, so its base verdict is failed; empty likewise; repeated rows
give repeated rows; other columns are ignored; an empty table gives no rows. Windows of eight words are
equal when their 64-bit hashes are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SEPARATORS, WORD, let, store, table

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
#: Character classes as regular expressions; white space is whatever the others leave.
CLASSES = (r"\p{Ll}", r"\p{Lu}", r"[\p{L}&&[^\p{Ll}\p{Lu}]]", r"\p{N}", r"[.,;:!?'\"()\-]", r"[\p{P}\p{S}&&[^.,;:!?'\"()\-]]")
MIN_WORDS, MAX_CHAR, MAX_WORD = 50, 0.25, 0.27
#: A short sample's histogram differs from its own source by about bins / (8 ln 2 n) in divergence; not all
#: bins are filled, so fewer count.
NOISE_BINS = 25
TOP, SHORT, MAX_LANGS = 40, 4, 500
#: Words that a language needs to be a reference.
MIN_REFERENCE = 1000


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def repeated_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words covered by windows of ``window`` words found twice or more in ``words``.

    Every word is hashed once; hashes of two, four, ... words are made of two of the halves. Only a text in which
    some window hash comes twice goes on: its hashes are sorted with their places, equal neighbours mark repeated
    places, and each place covers the words up to the next repeated place, ``window`` at most.
    """
    def hashes(h: Column, size: int = 1) -> Column:
        if size == window:
            return F.slice(h, F.lit(1), F.size(h) - (window - 1))  # what lies behind is cut off by the end
        return let(F.zip_with(h, F.slice(h, F.lit(size + 1), F.size(h)), lambda a, b: F.xxhash64(a, b)), lambda x: hashes(x, 2 * size))

    def places(h: Column) -> Column:
        s = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        same = let(s, lambda s: F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])))
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        own = F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window))))
        return F.aggregate(own, F.lit(0), lambda a, x: a + x)

    each = F.transform(words, lambda w: F.xxhash64(w))
    counted = let(let(each, lambda h: hashes(h)), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(places(h), covered)).otherwise(F.lit(0)))
    return F.when(F.size(words) > window, counted).otherwise(F.lit(0)).cast("long")


def base_rules(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, text, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "lang", text.alias("text"), split_words(F.col("text")).alias("words"))
    without = lambda chars: F.length("text") - F.length(F.translate("text", chars, ""))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))
    return rows.select(
        "doc_id", "lang", "text", "words", F.size("words").cast("long").alias("n_words"),
        (F.length("text") - without(SEPARATORS)).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    half = lambda a, m: F.when(a > 0, 0.5 * a * F.log2(a / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: half(a, (a + b) / 2) + half(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)))


def common_word_distance(words: Column, ref_words: Column, shares: Column, other: Column) -> Column:
    """Distance of the words' histogram over ``ref_words`` and one bin for the rest.

    Places of words in the reference are sorted and summed run by run; a reference word the document
    lacks adds half its share, which is what the sum starts from.
    """
    n = F.size(words).cast("double")
    placed = F.sort_array(F.filter(F.transform(F.filter(words, lambda w: F.length(w) <= SHORT),
                                               lambda w: F.array_position(ref_words, F.lower(w))), lambda i: i > 0))

    def term(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        part = lambda a: F.when(a > 0, 0.5 * a * F.log2(a / m)).otherwise(F.lit(0.0))
        return part(p) + part(q) - 0.5 * q

    def divergence(s: Column) -> Column:
        ends = F.filter(F.transform(s, lambda x, i: F.when(F.coalesce(F.get(s, i + 1) != x, F.lit(True)), i + 1)), lambda e: e.isNotNull())
        runs = let(ends, lambda e: F.transform(e, lambda x, i: term(
            (x - F.coalesce(F.get(e, i - 1), F.lit(0))) / n, F.get(shares, (F.get(s, x - 1) - 1).cast("int")))))
        return F.aggregate(runs, 0.5 + term((n - F.size(s)) / n, other), lambda a, x: a + x)

    return F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), let(placed, divergence))))


def class_counts(text: Column) -> Column:
    """Characters of each class; a class is taken out of the text before the next is counted."""
    def step(rest: Column, lengths: list[Column]) -> Column:
        lengths = [*lengths, F.length(rest)]
        if len(lengths) > len(CLASSES):
            return F.array(*[a - b for a, b in zip(lengths, lengths[1:])])
        return let(F.regexp_replace(rest, f"{CLASSES[len(lengths) - 1]}+", ""), lambda r: step(r, lengths))

    return let(text, lambda t: step(t, []))


def word_references(rows: DataFrame, top: int = TOP) -> DataFrame:
    """One row per language: ``key, total, ref_words, shares, other`` of rows (key, text)."""
    spark = rows.sparkSession
    words = split_words(F.col("text"))
    item = lambda w, n: F.struct(w.alias("word"), n.cast("long").alias("n"))
    short = let(words, lambda ws: F.concat(
        F.transform(F.filter(ws, lambda w: (F.length(w) <= SHORT) & F.rlike(w, F.lit(r"^\p{L}+$"))), lambda w: item(F.lower(w), F.lit(1))),
        F.array(item(F.lit(None).cast("string"), F.size(ws)))))  # a null word counts all words
    counted = store(spark, rows.filter("key is not null").select("key", F.explode(short).alias("x")).groupBy("key", F.col("x.word").alias("word"))
                    .agg(F.sum("x.n").alias("n")), "quality-words")
    total = counted.filter("word is null").select("key", F.greatest("n", F.lit(1)).alias("total"))
    best = Window.partitionBy("key").orderBy(F.desc("n"), "word")
    ranked = (counted.filter("word is not null").withColumn("r", F.row_number().over(best)).filter(F.col("r") <= top).groupBy(F.col("key").alias("k"))
              .agg(F.sort_array(F.collect_list(F.struct("r", "word", "n"))).alias("list")))
    share = F.transform("list", lambda x: x["n"] / F.col("total"))
    return store(spark, total.join(ranked, total["key"] == ranked["k"], "left")
                 .withColumn("list", F.coalesce("list", F.array().cast("array<struct<r:int,word:string,n:bigint>>")))
                 .select("key", "total", F.transform("list", lambda x: x["word"]).alias("ref_words"), share.alias("shares"),
                         F.aggregate(share, F.lit(1.0), lambda a, x: a - x).alias("other")), "quality-word-references")


def class_references(rows: DataFrame) -> DataFrame:
    """One row per language: ``key, classes`` of rows (key, c: counts, length)."""
    spark = rows.sparkSession
    names = [*[f"c{i}" for i in range(len(CLASSES))], "length"]
    sums = (rows.filter("key is not null").groupBy("key")
            .agg(*[F.sum(F.col("c")[i]).alias(n) for i, n in enumerate(names[:-1])], F.sum("length").alias("length")))
    classes = [F.col(n) / F.greatest("length", F.lit(1)) for n in names[:-1]]
    return store(spark, sums.select("key", F.array(*classes, 1 - sum(classes[1:], classes[0])).alias("classes")), "quality-class-references")


def with_references(rows: DataFrame, refs: DataFrame, size: str) -> DataFrame:
    """``rows`` (key, ...) with ``refs``: the reference of the row's language, or all (in order of ``key``) if it has none.

    Up to ``MAX_LANGS`` references are broadcast; beyond, each language's own is joined as Catalyst sees fit.
    """
    item = F.struct(*refs.columns)
    own = refs.select(F.col("key").alias("k"), F.array(item).alias("own"))
    if refs.count() <= MAX_LANGS:
        own = F.broadcast(own)
    every = F.broadcast(refs.agg(F.array_sort(F.collect_list(item)).alias("every")))
    joined = rows.join(own, rows["key"] == own["k"], "left").drop("k").crossJoin(every)
    return joined.withColumn("refs", F.coalesce("own", "every")).drop("own", "every")


def quality(docs: DataFrame, min_words: int = MIN_WORDS, max_char: float = MAX_CHAR, max_word: float = MAX_WORD,
            min_reference: int = MIN_REFERENCE) -> DataFrame:
    """Base counts, ``char_distance, word_distance`` and ``base_failed, kept`` for every row.

    A language whose texts have fewer than ``min_reference`` words is no reference; its texts, like those without
    a language, are judged by the nearest one.

    Texts are read twice: for the common words, then for everything else of a row; the classes' references
    and distances come from the narrow rows that the second pass stores.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "lang", "text")
    key = F.col("lang").cast("string")
    refs = word_references(docs.select(key.alias("key"), "text")).filter(F.col("total") >= min_reference)
    joined = with_references(base_rules(docs).withColumn("key", key), refs, "total")
    judged = F.col("n_words") >= min_words
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    distances = F.transform("refs", lambda r: common_word_distance(F.col("words"), r["ref_words"], r["shares"], r["other"]))
    scored = store(spark, joined.select(
        "doc_id", "key", *counts, class_counts(F.col("text")).alias("c"), F.length("text").alias("length"),
        F.when(judged, distances).alias("word_distances")), "quality-rows")
    classes = class_references(scored).join(refs.select("key", "total"), "key")
    length = F.greatest("length", F.lit(1))
    mine = F.concat(F.transform("c", lambda x: x / length), F.array(1 - F.aggregate("c", F.lit(0), lambda a, x: a + x) / length))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    noise = NOISE_BINS / (8 * math.log(2) * F.col("n_words"))

    def verdict(word: Column, char: Column) -> Column:
        excess = F.sqrt(F.greatest(F.lit(0.0), word * word - noise))
        return F.struct(F.greatest(char / max_char, excess / max_word).alias("worst"), char.alias("char"), word.alias("word"))

    nearest = let(mine, lambda p: F.array_min(F.zip_with("word_distances", "refs", lambda w, r: let(js_distance(p, r["classes"]), lambda c: verdict(w, c)))))
    out = (with_references(scored, classes, "total").withColumn("near", F.when(judged, nearest))
           .select("doc_id", *counts, failed.alias("base_failed"), F.col("near.char").alias("char_distance"), F.col("near.word").alias("word_distance")))
    alike = F.col("word_distance") * F.col("word_distance") - noise <= max_word * max_word
    good = F.coalesce((F.col("char_distance") <= max_char) & alike, F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & good)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
