"""TF-IDF weights, class weights, splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgauge.functions.hashing import seeded_key
from textgauge.functions.text import let, term_frequencies, words
from textgauge.operators.ranking import StratifiedCuts
from textgauge.session import fits, materialise, once

# Fixed value: a token has at least two word characters.
MIN_TOKEN = 2

#: Terms of a broadcast vocabulary: some 50 bytes each.
BROADCAST_TERMS = 1_000_000

#: Terms of which a row's own are picked out by a literal set.
FEW_TERMS = 16_000

SPLITS = ("test", "val", "train")


def stop_word_list(stop_words: str | Sequence[str] | None) -> list[str]:
    """``None``/``"none"``, a language known to Spark, or an explicit list."""
    if stop_words is None or stop_words == "none":
        return []
    if isinstance(stop_words, str):
        return list(StopWordsRemover.loadDefaultStopWords(stop_words))
    return list(stop_words)


def tokens(text: Column, lowercase: bool = True, stop_words: str | Sequence[str] | None = None) -> Column:
    found = words(F.lower(text) if lowercase else text, MIN_TOKEN)
    dropped = stop_word_list(stop_words)
    return F.filter(found, lambda w: ~w.isin(dropped)) if dropped else found


def ngrams(token_list: Column, n_max: int) -> Column:
    """All runs of 1 to ``n_max`` tokens, joined by blanks."""

    def runs(toks: Column) -> Column:
        per_size = [toks]
        for n in range(2, n_max + 1):
            last = F.size(toks) - n
            starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
                F.array().cast("array<int>")
            )
            per_size.append(run_texts(toks, starts, n))
        return F.concat(*per_size)

    return let(token_list, runs) if n_max > 1 else token_list


def run_texts(toks: Column, starts: Column, n: int) -> Column:
    return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(toks, i + k) for k in range(n)]))


def tf_table(
    df: DataFrame,
    id_col: str,
    text_col: str = "text",
    n_max: int = 1,
    lowercase: bool = True,
    stop_words: str | Sequence[str] | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """(row id, term, tf) without a shuffle; of ``only`` these terms, if given."""
    terms = ngrams(tokens(F.col(text_col), lowercase, stop_words), n_max)
    if only is not None:
        terms = F.filter(terms, lambda term: term.isin(list(only)))
    return once(df, _tf=term_frequencies(terms)).select(id_col, F.inline("_tf"))


def vocabulary(tf: DataFrame, n_docs: Column, min_df: int = 1, max_features: int = 0) -> DataFrame:
    """(term, df, idf) of the kept terms.

    Counts are combined before the shuffle, so a term in every text costs one
    row per task. ``max_features`` keeps the most frequent terms of the corpus,
    equal counts in term order.
    """
    terms = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")).where(
        F.col("df") >= min_df
    )
    if max_features > 0:
        terms = terms.orderBy(F.desc("total"), "term").limit(max_features)
    return terms.select("term", "df", idf(n_docs, F.col("df")).alias("idf"))


def frequent_tf(
    df: DataFrame,
    id_col: str,
    text_col: str,
    n_max: int,
    min_df: int,
    max_features: int,
    lowercase: bool,
    stop_words: str | Sequence[str] | None,
) -> DataFrame | None:
    """(row id, term, tf) of terms among which are the ``max_features`` most frequent ones of ``min_df`` texts.

    Occurrences are counted over all terms, texts only for the most frequent
    ones; if too few of these are in ``min_df`` texts, more are taken. None if
    that takes more than ``FEW_TERMS``.
    """
    grams = ngrams(tokens(F.col(text_col), lowercase, stop_words), n_max)
    counted = df.select(F.explode(grams).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    totals = materialise(counted.where(F.col("total") >= min_df), "totals")
    most = 2 * max_features
    while most <= FEW_TERMS:
        chosen = [r["term"] for r in totals.orderBy(F.desc("total"), "term").limit(most).collect()]
        tf = materialise(tf_table(df, id_col, text_col, n_max, lowercase, stop_words, chosen), "terms")
        enough = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df).count() >= max_features
        if enough or len(chosen) < most:
            return tf
        most *= 2
    return None


def idf(n_docs: Column, df: Column) -> Column:
    """Smoothed inverse document frequency: ln((1 + n) / (1 + df)) + 1."""
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)


def tfidf(
    df: DataFrame,
    id_col: str,
    text_col: str = "text",
    n_max: int = 1,
    min_df: int = 1,
    max_features: int = 0,
    lowercase: bool = True,
    stop_words: str | Sequence[str] | None = None,
) -> DataFrame:
    """(row id, term, weight): tf x idf, each row scaled to length 1.

    Texts are tokenised once: counts and weights are both made from the written
    counts of terms. For a few ``max_features`` they are tokenised twice, but only
    the counts of frequent terms are written. Null ids are rows of their own kind
    and share one length.
    """
    tf = None
    if 0 < 2 * max_features <= FEW_TERMS:
        tf = frequent_tf(df, id_col, text_col, n_max, min_df, max_features, lowercase, stop_words)
    if tf is None:
        tf = materialise(tf_table(df, id_col, text_col, n_max, lowercase, stop_words), "terms")
    n_docs = df.select(F.count(F.lit(1))).scalar()
    weighted = join_terms(tf, materialise(vocabulary(tf, n_docs, min_df, max_features), "vocabulary")).select(
        id_col, "term", (F.col("tf") * F.col("idf")).alias("w")
    )
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return weighted.select(id_col, "term", (F.col("w") / length).alias("weight"))


def join_terms(tf: DataFrame, terms: DataFrame, most: int = BROADCAST_TERMS) -> DataFrame:
    """Rows of ``tf`` with what ``terms`` (one row a term, with ``df``) says of their term.

    A small vocabulary is broadcast, so that nothing is shuffled. Of a larger
    one only the terms with a thousandth of all rows or more are, which are
    1000 at most; the others are joined by shuffle, and none of them is hot.
    """
    if fits(terms, most):
        return tf.join(F.broadcast(terms), "term")
    rows = terms.agg(F.sum("df").alias("n")).first()["n"]
    hot = F.broadcast(terms.where(F.col("df") * 1000 >= rows))
    rest = tf.join(hot.select("term"), "term", "left_anti").join(terms.hint("shuffle_merge"), "term")
    return tf.join(hot, "term").unionByName(rest)


def balanced_class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """(label, weight): n / (classes x class size)."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    rows, classes = totals.select("rows").scalar(), totals.select("classes").scalar()
    return counts.select("label", (rows / (classes * F.col("n"))).alias("weight"))


def fit_split(
    df: DataFrame, id_col: str, label_col: str = "label", test_size: float = 0.2, val_size: float = 0.0, seed: int = 42
) -> StratifiedCuts:
    """Cuts for a stratified split; part 0 is test, 1 validation, 2 training.

    Per stratum, ceil(n x (test + val)) rows are held out, of which
    ceil(held x test share) are for testing.
    """

    def ranks(size: Column) -> list[Column]:
        held = F.ceil(size * F.lit(test_size + val_size))
        if val_size <= 0:
            return [held, held]
        test_share = 1 - val_size / (test_size + val_size)
        return [F.ceil(held * F.lit(test_share)), held]

    return StratifiedCuts.fit(df, label_col, seeded_key(seed, id_col), ranks)


def apply_split(df: DataFrame, cuts: StratifiedCuts, id_col: str, label_col: str = "label", seed: int = 42) -> DataFrame:
    part = cuts.part(F.col(label_col), seeded_key(seed, id_col))
    return df.withColumn("split", F.get(F.lit(list(SPLITS)), part))


def fit_folds(df: DataFrame, id_col: str, label_col: str = "label", folds: int = 5, seed: int = 42) -> StratifiedCuts:
    """Cuts for stratified folds whose sizes per stratum differ by at most one."""
    return StratifiedCuts.fit(
        df,
        label_col,
        seeded_key(seed, id_col),
        lambda size: [F.ceil(size * F.lit(k) / F.lit(folds)) for k in range(1, folds)],
    )


def apply_folds(df: DataFrame, cuts: StratifiedCuts, id_col: str, label_col: str = "label", seed: int = 42) -> DataFrame:
    return df.withColumn("fold", cuts.part(F.col(label_col), seeded_key(seed, id_col)))
