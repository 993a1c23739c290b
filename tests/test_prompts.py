from itertools import product

import pytest

from textgauge.functions.templates import parse
from textgauge.operators import fewshot, prompts, rubric
from textgauge.plans.prompt_batch import prompt_batch

TEMPLATES = ("Explain {topic} in {style}.", "{topic} for {audience} ({domain})", "Plain", "{style} {level} {topic}")


def fill(template, values):
    defaults = {"domain": "general"}
    return template.format(**{**defaults, **{k: v for k, v in values.items() if v is not None}})


def expected(row, templates, styles, audiences, levels, dedupe, limit):
    """Plain Python: all combinations, then first-seen, then the limit."""
    out = []
    for s, a, v in product(styles, audiences, levels):
        for t in templates:
            out.append((fill(t, row | {"style": s, "audience": a, "level": v}), s, a, v, t))
    if dedupe:
        seen = {}
        for record in out:
            seen.setdefault(record[0], record)
        out = list(seen.values())
    return out[:limit] if limit else out


def generated(df, **options):
    rows = prompts.generate(df, ["id"], **options).orderBy("id", "ordinal").collect()
    found = {}
    for r in rows:
        found.setdefault(r.id, []).append((r.prompt, r.style, r.audience, r.level, r.source_template))
    return found


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("limit", [0, 1, 5, 20])
def test_generate_equals_nested_loops(spark, dedupe, limit):
    rows = [(1, "cats", None), (2, "cats", ""), (3, "concise", "pets")]
    lists = {"styles": ["concise", "bullet", "concise"], "audiences": ["dev", "lead"], "levels": ["easy", "pro"]}
    df = spark.createDataFrame(rows, "id int, topic string, domain string")
    found = generated(df, templates=TEMPLATES, dedupe=dedupe, limit=limit, **lists)
    for i, topic, domain in rows:
        row = {"topic": topic, "domain": domain}
        assert found[i] == expected(row, TEMPLATES, *lists.values(), dedupe, limit)


def test_defaults_fill_absent_fields(spark):
    df = spark.createDataFrame([("prompt engineering",)], "topic string")
    out = prompts.fill_templates(df, ["Explain {topic} to a {audience} in a {style} style for {domain}."]).first()
    assert out.prompt == "Explain prompt engineering to a general reader in a concise style for general."


def test_unknown_fields_become_empty_and_braces_survive(spark):
    df = spark.createDataFrame([("{style}",)], "topic string")
    out = prompts.fill_templates(df, ["{a}{topic}{b} {{x}}"]).first()
    assert out.prompt == "{style} {x}"
    with pytest.raises(ValueError):
        parse("{topic!r}")


def test_blank_topics_are_skipped(spark):
    df = spark.createDataFrame([(1, "   "), (2, None), (3, " a ")], "id int, topic string")
    assert [r.topic for r in prompts.permutations(df, ["s"], ["a"], ["v"]).collect()] == ["a"]


def test_default_batch_sizes(spark):
    df = spark.createDataFrame([(i, f"topic {i}") for i in range(5)], "id int, topic string")
    assert prompts.fill_templates(prompts.permutations(df)).count() == 1440
    assert prompts.generate(df, ["id"], dedupe=True, limit=0).count() == 210
    batch = prompt_batch(df, ["id"], seed=42, dedupe=True)
    assert batch["prompts"].count() == 100
    assert batch["average"].first().average_score == 3.75
    assert [(r.grade, r.n) for r in batch["grades"].collect()] == [("strong", 100)]
    assert {r.dimension: r.coverage for r in batch["coverage"].collect()} == {
        "specificity": 0.85, "structure": 0.9, "audience": 1.0, "evaluation_ready": 1.0,
    }


def test_seeded_order_is_stable(spark):
    df = spark.range(100)
    orders = [[r.id for r in prompts.seeded_order(df.repartition(n), 42, "id").collect()] for n in (1, 13)]
    assert orders[0] == orders[1] != [r.id for r in prompts.seeded_order(df, 43, "id").collect()]


def score(spark, rows, columns):
    return rubric.score_prompts(spark.createDataFrame(rows, columns))


def test_builtin_templates_are_strong(spark):
    df = spark.createDataFrame([("a topic", "AI", "none")], "topic string, domain string, constraint string")
    filled = prompts.fill_templates(prompts.permutations(df))
    assert rubric.score_prompts(filled).where("grade <> 'strong'").count() == 0


def test_rubric_values(spark):
    good, bad = score(
        spark,
        [("List exactly 4 steps in a decision matrix, with success metrics, for a new nurse.", "new nurse"), ("Describe rivers.", None)],
        "prompt string, audience string",
    ).collect()
    assert (good.score, good.grade, good.recommendations) == (4, "strong", [])
    assert (bad.grade, len(bad.recommendations)) == ("thin", 4)
    assert "Name the target audience" in bad.recommendations[2]


def test_summary_values(spark):
    rows = [("d", 0, "thin", (0, 0, 0, 0), ["z"]), ("a", 4, "strong", (1, 1, 1, 1), []), ("c", 1, "thin", (0, 1, 0, 0), ["y"]),
            ("b", 3, "strong", (1, 1, 1, 0), ["x"])]
    df = spark.createDataFrame(
        rows,
        "prompt string, score int, grade string, rubric struct<specificity:int,structure:int,audience:int,"
        "evaluation_ready:int>, recommendations array<string>",
    )
    assert tuple(rubric.average_score(df).first()) == (4, 2.0)
    assert [tuple(r) for r in rubric.grade_counts(df).collect()] == [("strong", 2), ("thin", 2)]
    shares = {r.dimension: r.coverage for r in rubric.coverage(df).collect()}
    assert shares == {"specificity": 0.5, "structure": 0.75, "audience": 0.5, "evaluation_ready": 0.25}
    assert rubric.top_prompts(df).first().prompt == "a"
    assert [r.prompt for r in rubric.needs_attention(df).collect()] == ["d", "c", "b"]
    # The limit comes before the filter.
    assert [r.prompt for r in rubric.needs_attention(df, limit=1).collect()] == ["d"]
    assert tuple(rubric.average_score(df.limit(0)).first()) == (0, 0.0)


def test_few_shot(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", " Be kind. "), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"),
         (1, 4, "assistant", "a2"), (1, 5, "user", " q3 "), (2, 0, "user", "x"), (2, 1, "user", "y")],
        "conv_id int, turn int, role string, text string",
    )
    built = {(r.conv_id, r.turn): r for r in fewshot.few_shot_prompts(turns, created="now").collect()}
    last = built[1, 5]
    assert (last.system, last.user, [tuple(s) for s in last.shots]) == ("Be kind.", "q3", [("q1", "a1"), ("q2", "a2")])
    assert [tuple(s) for s in built[1, 3].shots] == [("q1", "a1")]
    assert built[2, 1].shots == [] and built[2, 1].system == "" and built[2, 1].created == "now"


def test_few_shot_across_blocks_and_gaps(spark):
    n = 2 * fewshot.BLOCK_TURNS + 40
    kept = [t for t in range(n) if t not in (7, 300)]
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in kept]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    pairs = {r.turn: (r.q, r.a) for r in fewshot.shot_pairs(df).collect()}
    following = dict(zip(kept, kept[1:]))
    assert pairs == {t: (f"t{t}", f"t{following[t]}") for t in kept if t % 2 == 0 and t in following and following[t] % 2}
    place = {t: k for k, t in enumerate(kept)}
    for r in fewshot.few_shot_prompts(df).collect():
        earlier = [kept[place[r.turn] - b] for b in (4, 2) if place[r.turn] >= b]
        assert [tuple(s) for s in r.shots] == [pairs[t] for t in earlier if t in pairs]


def test_few_shot_with_far_turns(spark):
    rows = [(1, 10, "user", "q"), (1, 5000, "assistant", "a"), (1, 90_000, "user", "next"), (1, 90_001, "system", "Sys")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    assert [tuple(r) for r in fewshot.shot_pairs(df).collect()] == [(1, 10, "q", "a")]
    built = {r.turn: r for r in fewshot.few_shot_prompts(df, shots=150).collect()}
    assert [tuple(s) for s in built[90_000].shots] == [("q", "a")] and built[10].shots == [] and built[10].system == "Sys"
