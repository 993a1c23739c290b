"""Bias-audit queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textgauge.functions.numbers import clip, rate
from textgauge.functions.text import WORD, contains_any, strip_terms, term_pattern_column, words
from textgauge.operators import automaton, matching, scoring
from textgauge.operators.lexicon import BUILTIN_TERMS, CATEGORY_CAPS, Lexicon, overlay_frames
from textgauge.plans.bias_audit import bias_audit
from textgauge.session import scratch_path
from textgauge.sources import sinks
from textgauge.sources.tables import table
from textgauge.sources.texts import select_texts
from textgauge.workload.registry import documents, placed, query, values

# Terms that occur in the texts, on top of the built-in ones: words, phrases, a
# term with punctuation and a new category for a built-in term.
CUSTOM_TERMS = (
    ("that", "pointer", 0.25),
    ("this", "pointer", 0.5),
    ("with", "relation", 0.25),
    ("was", "tense", 0.25),
    ("of the", "relation", 0.5),
    ("the th", "uncat", 0.25),
    ("der", "article", 0.5),
    ("que", "article", 0.25),
    ("example.com", "contact", 0.75),
    ("she", "pronoun", 0.5),
    ("license", "uncat", 1.5),
)
ALLOWED = ("that in", "With the", "que le")
DENIED = ("worthless", "License", "in der", "that")
CAPS = CATEGORY_CAPS | {"pointer": 2.0, "article": 1.5, "gender": 1.25}

LEXICON = Lexicon.builtin().overlay(CUSTOM_TERMS)
OPTIONS = {"allowlist": ALLOWED, "denylist": DENIED, "caps": CAPS}

W = r"[\p{L}\p{N}_]"
NOT_W = r"[^\p{L}\p{N}_]"

LEX = "lex AS (SELECT * FROM " + values(
    [(e.term, e.key, e.category, e.weight, e.pos) for e in LEXICON.entries], "term", "key", "category", "weight", "pos"
) + ")"
DENY = "deny AS (SELECT * FROM " + values(
    [(d, d.lower(), len(LEXICON.entries) + i) for i, d in enumerate(DENIED)], "term", "key", "pos"
) + ")"
CAP = "caps AS (SELECT * FROM " + values([(c, float(v)) for c, v in CAPS.items()], "category", "cap") + ")"

ALLOW_SQL = "lower(text)"
for _term in ALLOWED:
    ALLOW_SQL = f"replace({ALLOW_SQL}, '{_term.lower()}', ' ')"

DOCS = "docs AS (SELECT doc_id, lang, source, text, lower(text) AS low FROM documents)"
ALLOWED_DOCS = f"docs AS (SELECT doc_id, lang, source, text, {ALLOW_SQL} AS low FROM documents)"

# Hits per text and term: words by token, phrases by length, the rest by a
# regex on a text whose separators are doubled, so that neighbours share none.
HITS = rf"""
tok AS (SELECT doc_id, w, count(*) AS n FROM
        (SELECT doc_id, unnest(regexp_extract_all(low, '{W}+')) AS w FROM docs) GROUP BY ALL),
hits AS (
  SELECT t.doc_id, l.term, l.category, l.weight, l.pos, t.n FROM tok t JOIN lex l ON t.w = l.key
  UNION ALL
  SELECT d.doc_id, l.term, l.category, l.weight, l.pos,
         (length(d.low) - length(replace(d.low, l.key, ''))) // length(l.key) AS n
  FROM docs d JOIN lex l ON contains(l.key, ' ') AND contains(d.low, l.key)
  UNION ALL
  SELECT * FROM (
    SELECT d.doc_id, l.term, l.category, l.weight, l.pos,
           len(regexp_extract_all(regexp_replace(d.low, '({NOT_W})', '\1\1', 'g'),
                                  '(?:^|{NOT_W})example\.\.com(?:{NOT_W}|$)')) AS n
    FROM docs d JOIN lex l ON l.key = 'example.com' AND contains(d.low, l.key)) WHERE n > 0
)"""
DENY_HITS = """
denied AS (SELECT d.doc_id, x.term, 'denylist' AS category, CAST(1.0 AS DOUBLE) AS weight, x.pos, 1 AS n
           FROM documents d JOIN deny x ON contains(lower(d.text), x.key)),
allhits AS (SELECT * FROM hits UNION ALL SELECT * FROM denied)"""
SCORES = """
percat AS (SELECT doc_id, category, sum(weight * n) AS total, sum(n) AS hits FROM allhits GROUP BY ALL),
capped AS (SELECT p.doc_id, sum(least(p.total, coalesce(c.cap, p.total))) AS score, sum(hits) AS hit_count
           FROM percat p LEFT JOIN caps c USING (category) GROUP BY ALL),
scored AS (SELECT d.doc_id, d.lang, d.source, d.text, coalesce(c.score, 0) AS score,
                  CAST(coalesce(c.hit_count, 0) AS BIGINT) AS hit_count
           FROM docs d LEFT JOIN capped c USING (doc_id))"""

PLAIN = f"WITH {DOCS}, {LEX}, {HITS} "
FULL = f"WITH {ALLOWED_DOCS}, {LEX}, {DENY}, {CAP}, {HITS}, {DENY_HITS}, {SCORES} "


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_rows(documents(spark, sf), LEXICON, **OPTIONS)


@query("J3_lexicon_hits", PLAIN + "SELECT doc_id, term, category, weight, CAST(n AS BIGINT) AS n FROM hits")
def lexicon_hits(spark: SparkSession, sf: str) -> DataFrame:
    return matching.match_terms(documents(spark, sf), LEXICON.frame(spark), "doc_id")


SHARED_WORDS = rf"""WITH words AS (
  SELECT key AS term, CASE WHEN length(key) > 4 THEN 'long' ELSE 'short' END AS category
  FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{W}+')) AS key FROM benchmark)),
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{W}+')) AS term FROM documents)
SELECT t.doc_id, t.term, w.category, CAST(1.0 AS DOUBLE) AS weight, count(*) AS n
FROM tok t JOIN words w USING (term) GROUP BY ALL"""


def shared_words(spark: SparkSession, sf: str) -> DataFrame:
    """A lexicon made from data: every word of the benchmark items."""
    terms = table(spark, sf, "benchmark").select(F.explode(words(F.lower("text"))).alias("term")).distinct()
    category = F.when(F.length("term") > 4, "long").otherwise("short")
    return terms.select("term", category.alias("category"), F.lit(1.0).alias("weight"))


@query("J3_large_lexicon_hits", SHARED_WORDS)
def large_lexicon_hits(spark: SparkSession, sf: str) -> DataFrame:
    return matching.match_terms(documents(spark, sf), shared_words(spark, sf), "doc_id")


@query(
    "A2_scores_from_hit_table",
    f"SELECT d.doc_id, d.lang, coalesce(s.score, 0) AS score, coalesce(s.hits, 0) AS hit_count FROM documents d LEFT JOIN ("
    f"SELECT doc_id, sum(CASE WHEN category = 'short' THEN least(n, 40) ELSE n END)::DOUBLE AS score, "
    f"CAST(sum(n) AS BIGINT) AS hits FROM (SELECT doc_id, category, sum(n) AS n FROM ({SHARED_WORDS}) GROUP BY ALL) "
    "GROUP BY doc_id) s USING (doc_id)",
)
def scores_from_hit_table(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    hits = matching.match_terms(docs, shared_words(spark, sf), "doc_id")
    return scoring.score_hits(docs.select("doc_id", "lang"), hits, "doc_id", caps={"short": 40.0}).select(
        "doc_id", "lang", "score", "hit_count"
    )


@query(
    "J4_denylist_hits",
    f"WITH {DENY} SELECT d.doc_id, x.term, 'denylist' AS category, -1 AS hit_start FROM documents d "
    "JOIN deny x ON contains(lower(d.text), x.key)",
)
def denylist_hits(spark: SparkSession, sf: str) -> DataFrame:
    hits = matching.with_hits(documents(spark, sf), Lexicon([]), denylist=DENIED)
    return matching.hit_rows(hits, "doc_id").select("doc_id", "term", "category", F.col("start").alias("hit_start"))


@query("J5_allowlist_removal", f"SELECT doc_id, {ALLOW_SQL} AS low FROM documents")
def allowlist_removal(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", strip_terms(F.lower("text"), ALLOWED).alias("low"))


# A lexicon derived from the texts: words of at least a tenth of the documents.
DERIVED = rf"""derived AS (
  SELECT term, 'common' AS category, CAST(0.25 AS DOUBLE) AS weight,
         CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS pos
  FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '{W}+'))) AS term FROM documents)
  GROUP BY term HAVING count(*) * 10 >= (SELECT count(*) FROM documents))"""
BUILTIN = "builtin AS (SELECT * FROM " + values(
    [(t, c, w, i) for i, (t, c, w) in enumerate(BUILTIN_TERMS)], "term", "category", "weight", "pos"
) + ")"


@query(
    "J6_lexicon_overlay",
    f"WITH {BUILTIN}, {DERIVED} SELECT coalesce(b.term, d.term) AS term, coalesce(d.category, b.category) AS category, "
    "coalesce(d.weight, b.weight) AS weight, "
    "CAST(coalesce(b.pos, d.pos + (SELECT max(pos) + 1 FROM builtin)) AS INTEGER) AS pos "
    "FROM builtin b FULL OUTER JOIN derived d ON b.term = d.term",
)
def lexicon_overlay(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    n = docs.select(F.count(F.lit(1))).scalar()
    terms = (
        docs.select(F.explode(F.array_distinct(words(F.lower("text")))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .where(F.col("df") * 10 >= n)
    )
    # Only words of a tenth of all texts are left, so this order is over few rows.
    derived = terms.select(
        "term",
        F.lit("common").alias("category"),
        F.lit(0.25).alias("weight"),
        (F.row_number().over(Window.orderBy("term")) - 1).alias("pos"),
    )
    return overlay_frames(Lexicon.builtin().frame(spark), derived)


@query("J7_capped_scores", FULL + "SELECT doc_id, score, hit_count FROM scored")
def capped_scores(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("doc_id", "score", "hit_count")


@query("A1_category_sums", FULL + "SELECT doc_id, category, total FROM percat")
def category_sums(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.category_scores(scored(spark, sf), "doc_id")


@query(
    "A2_row_scores",
    FULL + "SELECT s.doc_id, s.score, CAST(coalesce(p.categories, 0) AS INTEGER) AS categories, "
    "coalesce(p.uncapped, 0) AS uncapped FROM scored s LEFT JOIN (SELECT doc_id, count(*) AS categories, "
    "sum(total) AS uncapped FROM percat GROUP BY doc_id) p USING (doc_id)",
)
def row_scores(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select(
        "doc_id",
        "score",
        F.size("per_category").alias("categories"),
        F.aggregate(F.map_values("per_category"), F.lit(0.0), lambda t, v: t + v).alias("uncapped"),
    )


@query("A3_term_counts", FULL + "SELECT term, CAST(sum(n) AS BIGINT) AS n FROM allhits GROUP BY term")
def term_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.term_counts(documents(spark, sf), LEXICON, "doc_id", allowlist=ALLOWED, denylist=DENIED).select(
        "term", "n"
    )


@query(
    "A4_corpus_summary",
    FULL + "SELECT count(*) AS \"rows\", count(*) FILTER (score >= 0.5) AS flagged_count, "
    "round(count(*) FILTER (score >= 0.5) / greatest(count(*), 1), 4) AS flagged_rate, "
    "(SELECT string_agg(category, ',' ORDER BY category) FROM (SELECT DISTINCT category FROM percat)) AS categories "
    "FROM scored",
)
def summary(spark: SparkSession, sf: str) -> DataFrame:
    one = scoring.corpus_summary(scored(spark, sf))
    return one.select(
        "rows", "flagged_count", "flagged_rate", F.array_join("categories_present", ",").alias("categories")
    )


GROUPS = """SELECT {g} AS "group", count(*) AS total, count(*) FILTER (score >= {m}) AS flagged,
round(count(*) FILTER (score >= {m}) / greatest(count(*), 1), 4) AS flag_rate FROM scored GROUP BY {g}"""


@query("A5_group_metrics", FULL + GROUPS.format(g="lang", m=0.5))
def groups_by_language(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.group_metrics(scored(spark, sf), "lang")


@query("J9_group_totals_with_flags", FULL + GROUPS.format(g="source", m=3.0))
def groups_by_source(spark: SparkSession, sf: str) -> DataFrame:
    strict = scoring.score_rows(documents(spark, sf), LEXICON, min_score=3.0, **OPTIONS)
    return scoring.group_metrics(strict, "source")


@query("W10_groups_by_size", FULL + 'SELECT *, row_number() OVER (ORDER BY total DESC, "group") AS place FROM '
       '(SELECT source AS "group", count(*) AS total FROM scored GROUP BY source)')
def groups_by_size(spark: SparkSession, sf: str) -> DataFrame:
    """The groups in order; there are as many as sources."""
    return placed(scoring.group_metrics(scored(spark, sf), "source").select("group", "total"))


@query("A6_categories_present", FULL + "SELECT DISTINCT category FROM percat")
def categories_present(spark: SparkSession, sf: str) -> DataFrame:
    one = scoring.corpus_summary(scored(spark, sf))
    return one.select(F.explode("categories_present").alias("category"))


@query("P2_flagged_rows", FULL + "SELECT doc_id, score, text FROM scored WHERE score >= 2.0")
def flagged(spark: SparkSession, sf: str) -> DataFrame:
    strict = scoring.score_rows(documents(spark, sf), LEXICON, min_score=2.0, **OPTIONS)
    return scoring.flagged_rows(strict).select("doc_id", "score", "text")


@query("J8_flagged_rows_with_group", FULL + "SELECT doc_id, lang AS \"group\" FROM scored WHERE score >= 2.0")
def flagged_with_group(spark: SparkSession, sf: str) -> DataFrame:
    strict = scoring.score_rows(documents(spark, sf), LEXICON, min_score=2.0, **OPTIONS)
    return scoring.flagged_rows(strict).select("doc_id", F.col("lang").alias("group"))


@query(
    "W3_top_terms",
    FULL + "SELECT term, n, row_number() OVER (ORDER BY n DESC, first_doc, first_pos) AS place FROM ("
    "SELECT term, CAST(sum(n) AS BIGINT) AS n, min(doc_id) AS first_doc, arg_min(pos, doc_id * 1000 + pos) AS first_pos "
    "FROM allhits GROUP BY term) QUALIFY place <= 20",
)
def most_common_terms(spark: SparkSession, sf: str) -> DataFrame:
    counts = scoring.term_counts(documents(spark, sf), LEXICON, "doc_id", allowlist=ALLOWED, denylist=DENIED)
    top = counts.orderBy(F.desc("n"), "first").limit(20)
    return top.select("term", "n", F.row_number().over(Window.orderBy(F.desc("n"), "first")).cast("long").alias("place"))


# Offsets: words and the dotted term from runs of (non-)word characters, phrases
# from the pieces between them.
OFFSETS = rf"""
runs AS (SELECT doc_id, i, r, sum(length(r)) OVER (PARTITION BY doc_id ORDER BY i) - length(r) AS s,
                lead(r, 1) OVER (PARTITION BY doc_id ORDER BY i) AS r1,
                lead(r, 2) OVER (PARTITION BY doc_id ORDER BY i) AS r2
         FROM (SELECT doc_id, unnest(a) AS r, generate_subscripts(a, 1) AS i
               FROM (SELECT doc_id, regexp_extract_all(low, '{W}+|{NOT_W}+') AS a FROM docs))),
pieces AS (SELECT doc_id, term, i, k, sum(length(p)) OVER (PARTITION BY doc_id, term ORDER BY i)
                  + (i - 1) * length(term) AS s
           FROM (SELECT doc_id, term, unnest(a) AS p, generate_subscripts(a, 1) AS i, len(a) AS k
                 FROM (SELECT d.doc_id, l.term, string_split(d.low, l.key) AS a
                       FROM docs d JOIN lex l ON contains(l.key, ' ') AND contains(d.low, l.key)))),
offsets AS (
  SELECT doc_id, r AS term, s FROM runs WHERE r IN (SELECT key FROM lex)
  UNION ALL SELECT doc_id, 'example.com', s FROM runs WHERE r = 'example' AND r1 = '.' AND r2 = 'com'
  UNION ALL SELECT doc_id, term, s FROM pieces WHERE i < k),
spans AS (SELECT o.doc_id, o.term, CAST(o.s AS INTEGER) AS hit_start,
                 CAST(o.s + length(o.term) AS INTEGER) AS hit_end, d.text
          FROM offsets o JOIN docs d USING (doc_id))"""
CONTEXT_SQL = """substring(text, greatest(hit_start - 36, 0) + 1,
least(length(text), hit_end + 36) - greatest(hit_start - 36, 0)) AS context"""


@query("F3_hit_offsets", f"WITH {DOCS}, {LEX}, {OFFSETS} SELECT doc_id, term, hit_start, hit_end FROM spans")
def hit_offsets(spark: SparkSession, sf: str) -> DataFrame:
    hits = matching.with_hits(documents(spark, sf), LEXICON)
    return matching.hit_rows(hits, "doc_id").select(
        "doc_id", "term", F.col("start").alias("hit_start"), F.col("end").alias("hit_end")
    )


@query(
    "F4_hit_contexts",
    f"WITH {ALLOWED_DOCS}, {LEX}, {OFFSETS} SELECT doc_id, term, hit_start, {CONTEXT_SQL} FROM spans",
)
def hit_contexts(spark: SparkSession, sf: str) -> DataFrame:
    """Offsets count the shortened text, contexts show the original."""
    hits = matching.with_hits(documents(spark, sf), LEXICON, allowlist=ALLOWED)
    return matching.hit_rows(hits, "doc_id").select("doc_id", "term", F.col("start").alias("hit_start"), "context")


ALL_WORDS = rf"""WITH parts AS (
  SELECT doc_id, text, unnest(a) AS r, generate_subscripts(a, 1) AS i
  FROM (SELECT doc_id, text, regexp_extract_all(lower(text), '{W}+|{NOT_W}+') AS a FROM documents)),
placed AS (SELECT *, CAST(sum(length(r)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS hit_end FROM parts),
spans AS (SELECT *, hit_end - length(r) AS hit_start FROM placed WHERE regexp_matches(r, '^{W}'))
SELECT doc_id, r AS term, CAST(length(r) AS DOUBLE) AS weight, CAST(hit_start AS INTEGER) AS hit_start,
CAST(hit_end AS INTEGER) AS hit_end, {CONTEXT_SQL} FROM spans"""


@query("F4_table_hit_contexts", ALL_WORDS)
def table_hit_contexts(spark: SparkSession, sf: str) -> DataFrame:
    """Places and contexts for a lexicon that holds every word of the documents."""
    docs = documents(spark, sf)
    terms = docs.select(F.explode(words(F.lower("text"))).alias("term")).distinct()
    lexicon = terms.select("term", F.lit("word").alias("category"), F.length("term").cast("double").alias("weight"))
    hits = automaton.term_hits(docs, lexicon, "doc_id")
    return hits.select("doc_id", "term", "weight", F.col("start").alias("hit_start"), F.col("end").alias("hit_end"), "context")


# Two words with one blank between them, found anywhere, so also inside longer
# words: ends of a word with beginnings of the next. The second word lacks the
# first one's first letter, so that two places of a phrase never overlap.
PHRASES = rf"""WITH parts AS (
  SELECT doc_id, unnest(a) AS u, unnest(list_append(a[2:], NULL)) AS gap, unnest(list_concat(a[3:], [NULL, NULL])[1:len(a)]) AS v
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '{W}+|{NOT_W}+') AS a FROM documents)),
pairs AS (SELECT doc_id, u, v FROM parts WHERE gap = ' ' AND v IS NOT NULL AND regexp_matches(u, '^{W}')),
lexicon AS (SELECT DISTINCT u || ' ' || v AS term FROM pairs WHERE NOT contains(v, substring(u, 1, 1))),
counted AS (SELECT doc_id, u, v, count(*) AS n FROM pairs GROUP BY ALL),
ends AS (SELECT doc_id, v, n, substring(u, CAST(i AS BIGINT)) AS e FROM (SELECT *, unnest(range(1, length(u) + 1)) AS i FROM counted)),
heads AS (SELECT doc_id, n, e || ' ' || substring(v, 1, CAST(i AS BIGINT)) AS term FROM (SELECT *, unnest(range(1, length(v) + 1)) AS i FROM ends))
SELECT doc_id, term, CAST(sum(n) AS BIGINT) AS n FROM heads SEMI JOIN lexicon USING (term) GROUP BY ALL"""


@query("J3_phrase_table_hits", PHRASES)
def phrase_table_hits(spark: SparkSession, sf: str) -> DataFrame:
    """A lexicon of all pairs of neighbouring words of the documents: more than 100,000 phrases at sf0.01."""
    docs = documents(spark, sf)
    parts = docs.select(F.regexp_extract_all(F.lower("text"), F.lit(rf"{WORD}+|[^\p{{L}}\p{{N}}_]+"), F.lit(0)).alias("a"))
    near = F.arrays_zip(F.col("a").alias("u"), F.expr("slice(a, 2, size(a))").alias("gap"), F.expr("slice(a, 3, size(a))").alias("v"))
    neighbours = parts.select(F.inline(near))
    kept = neighbours.where((F.col("gap") == " ") & F.col("v").isNotNull() & F.regexp_like("u", F.lit(f"^{WORD}")) & ~F.contains("v", F.substring("u", 1, 1)))
    lexicon = kept.select(F.concat_ws(" ", "u", "v").alias("term")).distinct()
    lexicon = lexicon.select("term", F.lit("pair").alias("category"), F.lit(1.0).alias("weight"))
    return matching.match_terms(docs, lexicon, "doc_id").select("doc_id", "term", "n")


@query(
    "F2_term_patterns",
    rf"""WITH words AS (SELECT unnest(regexp_extract_all(lower(text), '{W}+')) AS term FROM benchmark),
terms AS (SELECT DISTINCT term FROM words UNION SELECT DISTINCT p_name FROM part)
SELECT term, contains(term, ' ') AS anywhere FROM terms""",
)
def term_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """Patterns of terms from data: phrases match anywhere, words as a whole."""
    items = table(spark, sf, "benchmark").select(F.explode(words(F.lower("text"))).alias("term"))
    names = table(spark, sf, "part").select(F.col("p_name").alias("term"))
    terms = items.union(names).distinct()
    inside = F.concat(F.lit("x"), F.col("term"), F.lit("x"))
    alone = F.concat(F.lit("("), F.col("term"), F.lit(")"))
    pattern = term_pattern_column(F.col("term"))
    return terms.where(F.regexp_like(alone, pattern)).select("term", F.regexp_like(inside, pattern).alias("anywhere"))


@query("F1_lower_case", "SELECT doc_id, lower(text) AS low FROM documents")
def lower_case(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", F.lower("text").alias("low"))


@query(
    "F8_substring_membership",
    "SELECT doc_id, contains(lower(text), 'of the') OR contains(lower(text), 'der') AS found FROM documents",
)
def membership(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", contains_any(F.lower("text"), ("of the", "der")).alias("found"))


@query(
    "F10_clipped_scores",
    FULL + "SELECT doc_id, least(greatest(score, 0.5), 2.0) AS clipped FROM scored",
)
def clipped_scores(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("doc_id", clip(F.col("score"), 0.5, 2.0).alias("clipped"))


@query(
    "F9_rounded_rates",
    FULL + "SELECT source, round(sum(score) / count(*), 3) AS mean_3, round(sum(score) / count(*), 4) AS mean_4 "
    "FROM scored GROUP BY source",
)
def rounded_rates(spark: SparkSession, sf: str) -> DataFrame:
    sums = scored(spark, sf).groupBy("source").agg(F.sum("score").alias("s"), F.count(F.lit(1)).alias("n"))
    return sums.select(
        "source", rate(F.col("s"), F.col("n"), 3).alias("mean_3"), rate(F.col("s"), F.col("n"), 4).alias("mean_4")
    )


@query(
    "F11_category_json",
    FULL + "SELECT doc_id, CAST(count(category) AS INTEGER) AS categories, coalesce(sum(total), 0) AS uncapped "
    "FROM docs LEFT JOIN percat USING (doc_id) GROUP BY doc_id",
)
def category_json(spark: SparkSession, sf: str) -> DataFrame:
    """The category map through its JSON text and back."""
    text = scored(spark, sf).select("doc_id", F.to_json("per_category").alias("json"))
    back = F.from_json("json", "map<string,double>")
    return text.select(
        "doc_id",
        F.size(back).alias("categories"),
        F.aggregate(F.map_values(back), F.lit(0.0), lambda t, v: t + v).alias("uncapped"),
    )


@query("P1_text_as_string", "SELECT doc_id, CAST(n_chars AS VARCHAR) AS text FROM documents")
def text_as_string(spark: SparkSession, sf: str) -> DataFrame:
    return select_texts(documents(spark, sf), "n_chars", "doc_id").select("doc_id", F.col("n_chars").alias("text"))


@query(
    "P9_nulls_stay_null",
    FULL + "SELECT CASE WHEN lang = 'fr' THEN NULL ELSE lang END AS \"group\", count(*) AS total, "
    "count(*) FILTER (score >= 0.5) AS flagged FROM scored GROUP BY 1",
)
def null_group(spark: SparkSession, sf: str) -> DataFrame:
    """A null group value is counted as a group and stays null."""
    docs = documents(spark, sf).withColumn("lang", F.nullif("lang", F.lit("fr")))
    return scoring.group_metrics(scoring.score_rows(docs, LEXICON, **OPTIONS), "lang").select(
        "group", "total", "flagged"
    )


@query(
    "U2_lexicon_and_denylist_hits",
    FULL + "SELECT category, count(DISTINCT doc_id) AS docs, CAST(sum(n) AS BIGINT) AS n FROM allhits GROUP BY category",
)
def all_hits(spark: SparkSession, sf: str) -> DataFrame:
    hits = matching.with_hits(documents(spark, sf), LEXICON, allowlist=ALLOWED, denylist=DENIED)
    per_row = matching.hit_rows(hits, "doc_id").groupBy("category", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_row.groupBy("category").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n"))


@query("U3_distinct_categories", FULL + "SELECT DISTINCT lang, category FROM percat JOIN docs USING (doc_id)")
def distinct_categories(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("lang", F.explode(F.map_keys("per_category")).alias("category")).distinct()


@query(
    "K2_detailed_rows",
    FULL + "SELECT s.doc_id, s.score, s.hit_count, coalesce(p.categories, '') AS categories FROM scored s LEFT JOIN "
    "(SELECT doc_id, string_agg(category, ',' ORDER BY category) AS categories FROM percat GROUP BY doc_id) p "
    "USING (doc_id)",
)
def detailed_rows(spark: SparkSession, sf: str) -> DataFrame:
    tables = bias_audit(documents(spark, sf), "doc_id", lexicon=LEXICON, group_col="lang", **OPTIONS)
    path = scratch_path(spark, "details")
    sinks.write_details(tables["rows"], path)
    back = spark.read.schema(tables["rows"].schema).parquet(path)
    return back.select(
        "doc_id",
        "score",
        F.size("hits").cast("long").alias("hit_count"),
        F.array_join(F.array_sort(F.array_distinct("hits.category")), ",").alias("categories"),
    )


@query("K3_flagged_csv", FULL + "SELECT doc_id AS id, score, text FROM scored WHERE score >= 0.5")
def flagged_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "flagged")
    sinks.write_flagged_csv(scored(spark, sf), path, "doc_id")
    schema = "id bigint, score double, per_category string, text string"
    back = spark.read.schema(schema).options(header=True, quote='"', escape='"', multiLine=True).csv(path)
    return back.select("id", "score", "text")
