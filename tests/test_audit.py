"""Lexicon matching and scoring, against Python's own regex engine."""

import random
import re

import pytest

from textgauge.functions.text import BLOCK
from textgauge.operators import automaton, lookup, matching, scoring
from textgauge.operators.lexicon import CATEGORY_CAPS, Lexicon
from textgauge.plans.bias_audit import bias_audit, write_bias_audit
from textgauge.session import scratch_path

EDGE_TEXTS = [
    "he said hé éhe He he, he he_ the",
    "page 62 and age 62",
    "he he he",
    "c++ c++x, c++",
    "male\U0001d41ahe he\U0001d41a he",
    "she",
    "the end: he",
    "",
    "well-known and well-knowns",
    "aaaa aa a",
    "İstanbul he",
]
TERMS = [
    ("he", "gender", 0.25), ("she", "gender", 0.5), ("age 62", "age", 1.0), ("c++", "lang", 0.5),
    ("well-known", "style", 0.75), ("aa", "rep", 1.0), ("a a", "rep", 0.25), ("He", "gender", 2.0),
]


def python_hits(text, terms, allowlist=(), window=36, case_sensitive=False):
    """The expected hits of one text."""
    low = text.lower()
    for term in allowlist:
        low = low.replace(term.lower(), " ")
    hits = []
    for term, category, weight in terms:
        pattern = re.escape(term) if " " in term else rf"\b{re.escape(term)}\b"
        for m in re.finditer(pattern, low, 0 if case_sensitive else re.IGNORECASE):
            hits.append((term, m.start(), m.end(), text[max(0, m.start() - window):min(len(text), m.end() + window)]))
    return hits


def spark_hits(spark, texts, lexicon, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = matching.hit_rows(matching.with_hits(df, lexicon, **options), "id").collect()
    found = {i: [] for i in range(len(texts))}
    for r in rows:
        found[r.id].append((r.term, r.start, r.end, r.context))
    return found


def random_texts(n, seed=7):
    rng = random.Random(seed)
    parts = ["he", "she", "é", "age 62", " ", " ", ",", "_", "c++", "well-known", "aa", "a", "He", "\n", "62", "ß", "東"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("allowlist", [(), ("She", "aa ", "é")])
def test_hits_equal_regex_engine(spark, allowlist):
    texts = EDGE_TEXTS + random_texts(150)
    found = spark_hits(spark, texts, Lexicon(TERMS), allowlist=allowlist)
    for i, text in enumerate(texts):
        assert found[i] == python_hits(text, TERMS, allowlist), text


def test_case_sensitive_terms_meet_lowered_text(spark):
    found = spark_hits(spark, ["He he HE"], Lexicon([("He", "x", 1.0), ("he", "x", 1.0)], case_sensitive=True))
    assert [h[:3] for h in found[0]] == [("he", 0, 2), ("he", 3, 5), ("he", 6, 8)]


def test_word_offsets(spark):
    found = spark_hits(spark, ["he said hé éhe He he, he he_ the"], Lexicon([("he", "gender", 0.25)]))
    # Python: an accented neighbour or an underscore is part of the word.
    assert [h[1] for h in found[0]] == [m.start() for m in re.finditer(r"\bhe\b", "he said hé éhe he he, he he_ the")]


def test_many_hits_in_one_text(spark):
    n = 3 * BLOCK + 17
    found = spark_hits(spark, ["ab, " * n], Lexicon([("ab", "x", 1.0)]), window=2)
    assert [h[1] for h in found[0]] == [4 * i for i in range(n)]


def test_hits_keep_lexicon_order_and_denylist_comes_last(spark):
    df = spark.createDataFrame([(1, "male, female and Worthless")], "id int, text string")
    hits = matching.with_hits(df, Lexicon.builtin(), denylist=["worthless", "absent"]).first().hits
    assert [(h.term, h.category, h.start, h.context) for h in hits][0][0] == "female"
    assert (hits[-1].term, hits[-1].category, hits[-1].start, hits[-1].end, hits[-1].context) == (
        "worthless", "denylist", -1, -1, "",
    )


def test_counts_agree_with_hits(spark):
    texts = EDGE_TEXTS + random_texts(80, seed=3)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    scored = scoring.score_rows(df, Lexicon(TERMS), caps={"gender": 1.5, "rep": 3.0})
    weight = {t: (c, w) for t, c, w in TERMS}
    for row in scored.collect():
        sums = {}
        for term, *_ in python_hits(row.text, TERMS):
            category, w = weight[term]
            sums[category] = sums.get(category, 0.0) + w
        assert row.per_category == sums
        caps = {"gender": 1.5, "rep": 3.0}
        assert row.score == sum(min(v, caps.get(c, v)) for c, v in sums.items())


def test_one_hit_of_one_word(spark):
    found = spark_hits(spark, ["Pregnant candidate"], Lexicon([("pregnant", "gender", 1.0)]))
    assert len(found[0]) == 1
    assert spark_hits(spark, ["male candidate"], Lexicon([("male", "gender", 0.5)]), allowlist=["male"])[0] == []


def test_caps_limit_the_score_but_not_the_map(spark):
    df = spark.createDataFrame([("foo foo bar",)], "text string")
    lexicon = Lexicon([("foo", "gender", 2.0), ("bar", "age", 1.0)])
    row = scoring.score_rows(df, lexicon, caps={"gender": 3.0, "age": 3.0}).first()
    assert (row.score, row.per_category["gender"]) == (4.0, 4.0)
    assert scoring.score_rows(df, lexicon, caps=None).first().score == 5.0


def test_null_and_empty_texts_score_zero(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "id int, text string")
    rows = scoring.score_rows(df, Lexicon.builtin(), denylist=["x"]).collect()
    assert [(r.score, r.per_category, r.hit_count, r.flagged) for r in rows] == [(0.0, {}, 0, False)] * 2
    assert matching.with_hits(df, Lexicon.builtin(), denylist=["x"]).first().hits == []


def test_denylist_ignores_the_allowlist_and_has_no_cap(spark):
    df = spark.createDataFrame([("Banned banned words",)], "text string")
    row = scoring.score_rows(df, Lexicon([]), allowlist=["banned"], denylist=["BANNED", "words"]).first()
    assert (row.score, row.per_category) == (2.0, {"denylist": 2.0})


def test_overlay_replaces_in_place_and_appends():
    lexicon = Lexicon([("a", "x", 1.0), ("b", "y", 1.0)]).overlay([("c", "z", 2.0), ("a", "w", 3.0)])
    assert [(e.term, e.category, e.weight, e.pos) for e in lexicon.entries] == [
        ("a", "w", 3.0, 0), ("b", "y", 1.0, 1), ("c", "z", 2.0, 2),
    ]


SAMPLE = [
    (1, "a", "Strong delivery record."),
    (2, "a", "A pregnant applicant asked about leave."),
    (3, "a", "They are too young for this role."),
    (4, "b", "Asked whether religion-related days are free."),
    (5, "b", "Mentions disability support."),
    (6, None, "Nothing to see."),
]


def test_audit_tables(spark):
    df = spark.createDataFrame(SAMPLE, "id int, grp string, text string")
    tables = bias_audit(df, "id", group_col="grp")
    assert [r.score for r in tables["rows"].orderBy("id").collect()] == [0, 1, 0.75, 0.75, 1, 0]
    assert [r.asDict() for r in tables["group_stats"].collect()] == [
        {"group": "a", "total": 3, "flagged": 2, "flag_rate": 0.6667},
        {"group": "b", "total": 2, "flagged": 2, "flag_rate": 1.0},
        {"group": None, "total": 1, "flagged": 0, "flag_rate": 0.0},
    ]
    summary = tables["summary"].first()
    assert (summary.rows, summary.flagged_count, summary.flagged_rate) == (6, 4, 0.6667)
    assert summary.categories_present == ["age", "disability", "gender", "religion"]
    # All terms occur once, so the order is that of first encounter.
    assert [r.term for r in tables["top_terms"].collect()] == ["pregnant", "too young", "religion", "disability"]


def test_empty_table_has_a_summary(spark):
    df = spark.createDataFrame([], "id int, text string")
    summary = bias_audit(df, "id")["summary"].first()
    assert (summary.rows, summary.flagged_count, summary.flagged_rate, summary.categories_present) == (0, 0, 0.0, [])


def test_results_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(list(enumerate(random_texts(60))), "id int, text string")

    def results(parts):
        tables = bias_audit(df.repartition(parts), "id", lexicon=Lexicon(TERMS), caps=CATEGORY_CAPS)
        return (
            sorted(tuple(map(str, r)) for r in tables["rows"].collect()),
            tables["top_terms"].collect(),
            tables["summary"].collect(),
        )

    assert results(1) == results(16)


def test_written_audit(spark):
    df = spark.createDataFrame(SAMPLE, "id int, grp string, text string")
    path = scratch_path(spark, "audit")
    write_bias_audit(df, "id", path, "run-1", "2026-01-01T00:00:00Z")
    assert spark.read.parquet(f"{path}/rows").count() == 6
    flagged = spark.read.csv(f"{path}/flagged", header=True, quote='"', escape='"').orderBy("id").collect()
    assert [r.id for r in flagged] == ["2", "3", "4", "5"]
    assert flagged[0].per_category == '{"gender":1.0}'
    assert spark.read.parquet(f"{path}/runs").first().run_id == "run-1"


def test_large_lexicon_join_equals_small(spark):
    df = spark.createDataFrame(list(enumerate(EDGE_TEXTS + random_texts(80, seed=5))), "id int, text string")
    terms = Lexicon(TERMS).frame(spark)
    small = matching.match_terms(df, terms, "id").collect()
    large = matching.match_terms(df, terms, "id", max_broadcast=2, part_chars=10).collect()
    assert sorted(small) == sorted(large)
    texts = dict(df.collect())
    expected = {}
    for i, text in texts.items():
        for term, *_ in python_hits(text, TERMS):
            expected[i, term] = expected.get((i, term), 0) + 1
    assert {(r.id, r.term): r.n for r in small} == expected


@pytest.mark.parametrize("part_chars,allowlist", [(1 << 20, ()), (9, ()), (30, ("She", "aa ", "é"))])
def test_table_hits_have_places_and_contexts(spark, part_chars, allowlist):
    """Automata of all sizes find what a regex engine finds, place by place."""
    texts = EDGE_TEXTS + random_texts(120, seed=11) + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    terms = spark.createDataFrame([*TERMS, ("(she)", "mark", 1.0), ("", "empty", 1.0), (None, "none", 1.0)], "term string, category string, weight double")
    hits = automaton.term_hits(df, terms, "id", allowlist=allowlist, part_chars=part_chars).collect()
    expected = [
        (i, term, start, end, context)
        for i, text in enumerate(texts)
        for term, start, end, context in python_hits(text or "", [*TERMS, ("(she)", "mark", 1.0)], allowlist)
    ]
    assert sorted((r.id, r.term, r.start, r.end, r.context) for r in hits) == sorted(expected)
    weights = {term: (category, weight) for term, category, weight in TERMS}
    assert all((r.category, r.weight) == weights[r.term] for r in hits if r.term in weights)


def test_a_key_that_is_its_term_is_shuffled_once(spark, monkeypatch):
    """What comes back to a text has a key of its own only for terms with capitals, and all are found."""
    df = spark.createDataFrame([(1, "one Two two"), (2, "none"), (3, "TWO")], "id int, text string")
    terms = spark.createDataFrame([("one", "x", 1.0), ("Two", "x", 1.0), ("two", "y", 2.0)], "term string, category string, weight double")
    handed = []
    monkeypatch.setattr(lookup.F, "collect_list", lambda c, made=lookup.F.collect_list: handed.append(c) or made(c))
    hits = automaton.term_hits(df, terms, "id", part_chars=5).collect()
    assert sorted((r.id, r.term, r.category, r.start) for r in hits) == sorted(
        [(1, "one", "x", 0), *[(i, t, c, s) for i, s in ((1, 4), (1, 8), (3, 0)) for t, c in (("Two", "x"), ("two", "y"))]]
    )
    entries = spark.createDataFrame([("two", "two", "y", 2.0), ("two", "Two", "x", 1.0)], "key string, term string, category string, weight double")
    assert [r[0].key for r in entries.select(handed[0]).collect()] == [None, "two"]


def test_table_hits_of_an_empty_lexicon_and_many_in_one_text(spark, monkeypatch):
    df = spark.createDataFrame([(1, "ab " * 30_000), (2, "")], "id int, text string")
    none = spark.createDataFrame([], "term string, category string, weight double")
    assert automaton.term_hits(df, none, "id").count() == 0
    some = spark.createDataFrame([("ab", "x", 1.0), ("b a", "y", 1.0)], none.schema)
    counts = {r.term: r.n for r in automaton.term_counts(df, some, "id").collect()}
    assert counts == {"ab": 30_000, "b a": 29_999}
    assert automaton.term_hits(df, some, "id").count() == 59_999


def test_scores_from_hit_table_equal_scores_in_rows(spark):
    texts = EDGE_TEXTS + random_texts(60, seed=9) + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    lexicon, options = Lexicon(TERMS), {"caps": {"gender": 1.5, "rep": 3.0}, "min_score": 2.0}
    hits = matching.match_terms(df, lexicon.frame(spark), "id", allowlist=["she"])
    by_join = scoring.score_hits(df, hits, "id", **options).orderBy("id").collect()
    in_rows = scoring.score_rows(df, lexicon, allowlist=["she"], **options).orderBy("id").collect()
    assert by_join == in_rows


def test_a_lexicon_beyond_one_automaton_does_not_read_the_texts_again(spark, monkeypatch):
    """Terms of a large lexicon meet the texts by shuffle; only what has no strings of its own goes to automata."""
    texts = EDGE_TEXTS + random_texts(40, seed=3) + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    parts = []
    monkeypatch.setattr(automaton, "_matcher", None)
    real = automaton._parts
    monkeypatch.setattr(automaton, "_parts", lambda *a: (parts.append(p) or p for p in real(*a)))
    terms = [*TERMS, (" he", "lead", 1.0), ("e he", "ends", 1.0), ("++", "mark", 1.0), ("he, he", "long", 1.0)]
    lexicon = spark.createDataFrame(terms, "term string, category string, weight double")
    counts = automaton.term_counts(df, lexicon, "id", part_chars=10).collect()
    hits = automaton.term_hits(df, lexicon, "id", part_chars=10).collect()
    assert not parts
    expected = [(i, *hit) for i, text in enumerate(texts) for hit in python_hits(text or "", terms)]
    assert sorted((r.id, r.term, r.start, r.end, r.context) for r in hits) == sorted(expected)
    by_term = {}
    for i, term, *_ in expected:
        by_term[i, term] = by_term.get((i, term), 0) + 1
    assert {(r.id, r.term): r.n for r in counts} == by_term


def test_terms_without_strings_of_their_own_are_found_too(spark):
    texts = ["a  b   c - d", "  ", "one two " * 12, " ".join("abcdefghijkl") + " m"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    terms = [("  ", "blanks", 1.0), (" - ", "dash", 1.0), ("e two " * 9 + "on", "none", 1.0), (" ".join("abcdefghijkl"), "many", 1.0), ("b", "word", 1.0)]
    lexicon = spark.createDataFrame(terms, "term string, category string, weight double")
    found = {(r.id, r.term, r.start) for r in automaton.term_hits(df, lexicon, "id", part_chars=10).collect()}
    assert found == {(i, term, start) for i, text in enumerate(texts) for term, start, *_ in python_hits(text, terms)}
    assert {term for _, term, _ in found} == {"  ", " - ", " ".join("abcdefghijkl"), "b"}
