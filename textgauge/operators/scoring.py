"""Row scores from lexicon hits, computed inside the row.

A text, its hits and its score live in one row, so nothing is shuffled by row
id: the only shuffles of an audit are those of its small final aggregates. One
very long text or one very frequent term therefore cannot become a hot key.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.functions.constants import array_of, rows_of, sql_list, sql_value
from textgauge.functions.numbers import rate
from textgauge.functions.text import WORD, occurrence_count, strip_terms
from textgauge.operators.lexicon import CATEGORY_CAPS, DENY_CATEGORY, DENY_WEIGHT, Lexicon
from textgauge.session import once

MIN_SCORE = 0.5

OTHERS_TYPE = "array<struct<pos:int,category:string,weight:double,n:bigint>>"
SUMS_TYPE = "array<struct<category:string,hits:bigint,total:double>>"


def denied_terms(text: Column, denylist: Sequence[str]) -> Column:
    """The denylist terms that occur in a text, ignoring case; one each, empty ones none."""
    denylist = [term for term in denylist if term]
    if not denylist:
        return array_of([])
    low = F.lower(text)
    listed = rows_of([(term, term.lower()) for term in denylist], "term", "key")
    return F.transform(F.filter(listed, lambda d: F.contains(low, d.key)), lambda d: d.term)


def find_terms(
    df: DataFrame,
    lexicon: Lexicon,
    text_col: str = "text",
    allowlist: Sequence[str] = (),
    denylist: Sequence[str] = (),
) -> DataFrame:
    """Append what a row matches: ``_words``, ``_others`` and ``_denied``.

    Plain words are found by tokenising once and keeping tokens of the lexicon,
    whose cost does not grow with the lexicon. Phrases and terms with
    punctuation are counted one by one, after a cheap substring test.
    """
    no_others = F.expr(f"CAST(array() AS {OTHERS_TYPE})")
    token_hits, other_hits = array_of([]), no_others
    keys = lexicon.plain_keys()
    if keys:
        tokens = f"regexp_extract_all(_low, {sql_value(WORD + '+')}, 0)"
        token_hits = F.expr(f"filter({tokens}, w -> w IN ({sql_list(keys)}))")
    others = [e for e in lexicon.entries if not e.plain]
    if others:
        counted = F.transform(
            F.filter(lexicon.literal(others), lambda e: F.contains(F.col("_low"), e.key)),
            lambda e: F.struct(
                e.pos.alias("pos"),
                e.category.alias("category"),
                e.weight.alias("weight"),
                occurrence_count(F.col("_low"), e.pattern).alias("n"),
            ),
        )
        other_hits = F.filter(counted, lambda hit: hit.n > 0)
    lowered = once(df, _low=strip_terms(F.lower(F.col(text_col)), allowlist))
    return once(
        lowered,
        _words=F.coalesce(token_hits, array_of([])),
        _others=F.coalesce(other_hits, no_others),
        _denied=F.coalesce(denied_terms(F.col(text_col), denylist), array_of([])),
    ).drop("_low")


def category_sums(lexicon: Lexicon, denylist: Sequence[str] = ()) -> Column:
    """Per category with hits, a row's hit count and uncapped weight sum.

    Plain words of equal category and weight are counted together by one set
    look-up per token, so the work does not grow with the lexicon.
    """
    # Terms that differ only in case share a key and each add their own weight:
    # a key met again goes to the next round.
    classes: dict[tuple[str, float], list[list[str]]] = defaultdict(list)
    for entry in lexicon.entries:
        if not entry.plain:
            continue
        rounds = classes[entry.category, entry.weight]
        free = next((keys for keys in rounds if entry.key not in keys), None)
        if free is None:
            rounds.append([entry.key])
        else:
            free.append(entry.key)

    parts: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for (category, weight), rounds in classes.items():
        for keys in rounds:
            hits = f"CAST(size(filter(_words, w -> w IN ({sql_list(keys)}))) AS BIGINT)"
            parts[category].append((hits, f"{hits} * {sql_value(weight)}"))
    for category in {e.category for e in lexicon.entries if not e.plain}:
        own = f"filter(_others, h -> h.category = {sql_value(category)})"
        parts[category].append(
            (f"aggregate({own}, 0L, (t, h) -> t + h.n)", f"aggregate({own}, 0D, (t, h) -> t + h.n * h.weight)")
        )
    if denylist:
        denied = "CAST(size(_denied) AS BIGINT)"
        parts[DENY_CATEGORY].append((denied, f"{denied} * {sql_value(DENY_WEIGHT)}"))
    if not parts:
        return F.expr(f"CAST(array() AS {SUMS_TYPE})")
    structs = [
        f"struct({sql_value(category)} AS category, {' + '.join(n for n, _ in both)} AS hits, "
        f"{' + '.join(w for _, w in both)} AS total)"
        for category, both in sorted(parts.items())
    ]
    return F.expr(f"filter(array({', '.join(structs)}), s -> s.hits > 0)")


def score_rows(
    df: DataFrame,
    lexicon: Lexicon,
    text_col: str = "text",
    allowlist: Sequence[str] = (),
    denylist: Sequence[str] = (),
    caps: Mapping[str, float] | None = CATEGORY_CAPS,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """Append ``per_category`` (uncapped), ``hit_count``, ``score`` and ``flagged``.

    Rows without hits stay, with an empty map and score 0.
    """
    found = find_terms(df, lexicon, text_col, allowlist, denylist)
    summed = once(found, _sums=category_sums(lexicon, denylist))

    total = "s.total"
    if caps:
        whens = " ".join(f"WHEN {sql_value(c)} THEN {sql_value(float(cap))}" for c, cap in caps.items())
        # ``least`` skips nulls, so a category without a cap has no limit.
        total = f"least(s.total, CASE s.category {whens} END)"
    return summed.select(
        *df.columns,
        F.expr("map_from_entries(transform(_sums, s -> struct(s.category, s.total)))").alias("per_category"),
        F.expr("aggregate(_sums, 0L, (n, s) -> n + s.hits)").alias("hit_count"),
        F.expr(f"aggregate(_sums, 0D, (t, s) -> t + {total})").alias("score"),
    ).withColumn("flagged", F.col("score") >= F.lit(float(min_score)))


def score_hits(
    df: DataFrame,
    hits: DataFrame,
    id_col: str,
    caps: Mapping[str, float] | None = CATEGORY_CAPS,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """``score_rows`` from a table of hits (row id, category, weight, n).

    For lexicons too large to travel inside the query. Hits are summed per row
    and category, then per row; both groups are as small as one text.
    """
    total = F.col("total")
    if caps:
        whens = " ".join(f"WHEN {sql_value(c)} THEN {sql_value(float(cap))}" for c, cap in caps.items())
        total = F.expr(f"least(total, CASE category {whens} END)")
    per_category = hits.groupBy(id_col, "category").agg(
        F.sum("n").alias("hits"), F.sum(F.col("n") * F.col("weight")).alias("total")
    )
    per_row = per_category.groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.struct("category", "total"))).alias("per_category"),
        F.sum("hits").alias("hit_count"),
        F.sum(total).alias("score"),
    )
    return df.join(per_row, id_col, "left").select(
        *df.columns,
        F.coalesce("per_category", F.expr("CAST(map() AS map<string,double>)")).alias("per_category"),
        F.coalesce("hit_count", F.lit(0).cast("long")).alias("hit_count"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    ).withColumn("flagged", F.col("score") >= F.lit(float(min_score)))


def category_scores(scored: DataFrame, id_col: str) -> DataFrame:
    """One row per (row id, category) with the uncapped weight sum."""
    return scored.select(id_col, F.explode("per_category").alias("category", "total"))


def flagged_rows(scored: DataFrame) -> DataFrame:
    return scored.where("flagged")


def group_metrics(scored: DataFrame, group_col: str, digits: int = 4) -> DataFrame:
    """Rows, flagged rows and flag rate per group; a null group is a group.

    One conditional aggregate serves totals and flagged counts, so a hot group
    shrinks to one partial row per task before the shuffle.
    """
    return (
        scored.groupBy(F.col(group_col).alias("group"))
        .agg(F.count(F.lit(1)).alias("total"), F.count_if("flagged").alias("flagged"))
        .withColumn("flag_rate", rate(F.col("flagged"), F.col("total"), digits))
        .orderBy(F.desc("total"), "group")
    )


def corpus_summary(scored: DataFrame, digits: int = 4) -> DataFrame:
    """Rows, flagged rows, their rate and the sorted categories, as one row.

    Each row is counted once under a null category and once per category it
    has, so one pass and one partial row per category and task are enough.
    """
    none = F.array(F.lit(None).cast("string"))
    by_category = (
        scored.select("flagged", F.explode(F.concat(none, F.map_keys("per_category"))).alias("category"))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("flagged").alias("flagged"))
    )
    every_row = F.col("category").isNull()
    return by_category.agg(
        F.coalesce(F.max(F.when(every_row, F.col("n"))), F.lit(0).cast("long")).alias("rows"),
        F.coalesce(F.max(F.when(every_row, F.col("flagged"))), F.lit(0).cast("long")).alias("flagged_count"),
        F.array_sort(F.collect_set("category")).alias("categories_present"),
    ).select(
        "rows",
        "flagged_count",
        rate(F.col("flagged_count"), F.col("rows"), digits).alias("flagged_rate"),
        "categories_present",
    )


def term_counts(
    df: DataFrame,
    lexicon: Lexicon,
    id_col: str,
    text_col: str = "text",
    allowlist: Sequence[str] = (),
    denylist: Sequence[str] = (),
) -> DataFrame:
    """Corpus frequency per term with its first encounter (row id, position)."""
    found = find_terms(df, lexicon, text_col, allowlist, denylist)

    def tagged(kind: str, key: Column, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.alias("key"), n.cast("long").alias("n"))

    hits = F.concat(
        F.transform("_words", lambda w: tagged("word", w, F.lit(1))),
        F.transform("_others", lambda o: tagged("other", o.pos.cast("string"), o.n)),
        F.transform("_denied", lambda d: tagged("denied", d, F.lit(1))),
    )
    sums = (
        found.select(F.col(id_col).alias("_id"), F.explode(hits).alias("hit"))
        .groupBy("hit.kind", "hit.key")
        .agg(F.sum("hit.n").alias("n"), F.min("_id").alias("first_id"))
    )
    # Terms are named after counting, on at most one row per lexicon entry.
    names = [("word" if e.plain else "other", e.key if e.plain else str(e.pos), e.term, e.pos) for e in lexicon.entries]
    names += [("denied", term, term, len(lexicon.entries) + i) for i, term in enumerate(denylist)]
    if not names:
        return sums.select(F.lit("").alias("term"), "n", F.struct("first_id", F.lit(0).alias("term_pos")).alias("first")).limit(0)
    lookup = rows_of(names, "kind", "key", "term", "pos")
    own = F.filter(lookup, lambda e: (e.kind == F.col("kind")) & (e.key == F.col("key")))
    return (
        sums.select("n", "first_id", F.inline(F.transform(own, lambda e: F.struct(e.term, e.pos))).alias("term", "term_pos"))
        .groupBy("term")
        .agg(F.sum("n").alias("n"), F.min(F.struct("first_id", "term_pos")).alias("first"))
    )


def top_terms(counts: DataFrame, limit: int = 20) -> DataFrame:
    """Most frequent terms; ties go to the term met first."""
    return counts.orderBy(F.desc("n"), "first").limit(limit).select("term", "n")
