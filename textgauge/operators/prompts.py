"""Prompt batches: topics x styles x audiences x levels x templates.

The topic table is the only large side. The lists are configuration, so their
combinations are built once as a constant array and expanded inside each topic
row. De-duplication and the per-row limit then work on that array too: a batch
needs no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.functions.constants import rows_of
from textgauge.functions.hashing import seeded_key
from textgauge.functions.templates import field_lookup, fields_of, render
from textgauge.session import once

# The built-in templates, in their order.
BUILTIN_TEMPLATES = (
    "Explain {topic} for a {audience} in a {style} style with sections for context, key ideas, risks, and metrics. Include one assessment question.",
    "Create a step-by-step checklist to implement {topic} for a {audience}. Include pitfalls, mitigations, and success metrics.",
    "Summarize pros and cons of {topic} in exactly 5 bullets for a {audience}. Include selection criteria and one risk to monitor.",
    "Provide a practical mini-guide to {topic} for a {audience} with sections: Overview, Use-Cases, Risks, Metrics, and Assessment. Keep tone {style}.",
    "Draft a comparison: {topic} vs alternatives for a {audience}. Include selection criteria, risks, and a decision matrix.",
    "Design a quickstart for {topic} in the {domain} domain for a {audience} with constraints: {constraint}. Include sections for setup, risks, metrics, and validation.",
    "Give 3 common failure modes for {topic} and a mitigation plan for each, for a {audience}. Include assessment criteria.",
    "Produce an outline to teach {topic} for a {audience}. Include sections, assessment questions, risks, and success metrics.",
)

# The default lists.
STYLES = ("concise", "practical", "bullet", "checklist")
AUDIENCES = ("senior engineer", "junior dev", "product manager")
LEVELS = ("easy", "intermediate", "pro")

LIMIT_PER_ROW = 20

# The columns that the lists always overwrite.
LISTED = ("style", "audience", "level")


def usable_topics(df: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Rows with a topic, which is trimmed."""
    return df.withColumn(topic_col, F.trim(F.col(topic_col))).where(F.col(topic_col) != "")


def list_product(styles: Sequence[str], audiences: Sequence[str], levels: Sequence[str]) -> list[dict[str, str]]:
    return [{"style": s, "audience": a, "level": v} for s in styles for a in audiences for v in levels]


def permutations(
    df: DataFrame,
    styles: Sequence[str] = STYLES,
    audiences: Sequence[str] = AUDIENCES,
    levels: Sequence[str] = LEVELS,
) -> DataFrame:
    """Each topic row once per style, audience and level, in list order."""
    combos = rows_of([[c[k] for k in LISTED] for c in list_product(styles, audiences, levels)], *LISTED)
    kept = [c for c in df.columns if c not in LISTED]
    return usable_topics(df).select(*kept, F.posexplode(combos).alias("permutation", "combo")).select(
        *kept, "permutation", "combo.*"
    )


def fill_templates(
    permuted: DataFrame, templates: Sequence[str] = BUILTIN_TEMPLATES, topic_col: str = "topic"
) -> DataFrame:
    """Each permutation once per template, with the filled prompt."""
    value_of = field_lookup({c: F.col(c) for c in permuted.columns} | {"topic": F.col(topic_col)})
    numbered = rows_of(enumerate(templates), "template", "source_template")
    prompt = choose_template(F.col("template"), [render(t, value_of) for t in templates])
    return permuted.select("*", F.inline(numbered)).select("*", prompt.alias("prompt"))


def choose_template(index: Column, rendered: Sequence[Column]) -> Column:
    choice = F.lit(None).cast("string")
    for i in reversed(range(len(rendered))):
        choice = F.when(index == i, rendered[i]).otherwise(choice)
    return choice


def combinations(
    templates: Sequence[str], lists: Sequence[Mapping[str, str]], dedupe: bool, limit: int
) -> list[tuple[dict[str, str], int]]:
    """The (list values, template) pairs worth filling, in output order.

    With ``dedupe``, a pair that agrees with an earlier one in all the list
    values its template mentions would only repeat that prompt. Without it,
    nothing after the limit can be seen.
    """
    used = [fields_of(t) & set(LISTED) for t in templates]
    seen, pairs = set(), []
    for values in lists:
        for i in range(len(templates)):
            signature = (i, tuple(values[k] for k in LISTED if k in used[i]))
            if dedupe and signature in seen:
                continue
            seen.add(signature)
            pairs.append((dict(values), i))
    return pairs[:limit] if limit and not dedupe else pairs


def generate(
    df: DataFrame,
    key_cols: Sequence[str],
    templates: Sequence[str] = BUILTIN_TEMPLATES,
    styles: Sequence[str] = STYLES,
    audiences: Sequence[str] = AUDIENCES,
    levels: Sequence[str] = LEVELS,
    dedupe: bool = False,
    limit: int = LIMIT_PER_ROW,
    topic_col: str = "topic",
) -> DataFrame:
    """The prompt records of every topic row.

    ``dedupe`` keeps the first of equal prompts within an input row and comes
    before ``limit`` (0 = none), which counts per input row, not per topic.
    """
    pairs = combinations(templates, list_product(styles, audiences, levels), dedupe, limit)
    if not pairs:
        raise ValueError("templates and lists must not be empty")
    combos = rows_of(
        [[*(values[k] for k in LISTED), i, templates[i]] for values, i in pairs], *LISTED, "template", "source_template"
    )
    topics = usable_topics(df, topic_col)
    row_fields = {c: F.col(c) for c in topics.columns} | {"topic": F.col(topic_col)}

    def prompt_of(combo: Column) -> Column:
        value_of = field_lookup(row_fields | {k: combo[k] for k in LISTED})
        return choose_template(combo.template, [render(t, value_of) for t in templates])

    filled = once(topics, _prompts=F.transform(combos, prompt_of))
    if dedupe:
        chosen = F.array_distinct("_prompts")  # keeps the first of equals, in order
        if limit:
            chosen = F.slice(chosen, F.lit(1), F.lit(limit))
        records = F.transform(
            chosen,
            lambda p: F.struct(p.alias("prompt"), F.get(combos, F.array_position("_prompts", p) - 1).alias("combo")),
        )
    else:
        records = F.zip_with("_prompts", combos, lambda p, c: F.struct(p.alias("prompt"), c.alias("combo")))
    return filled.select(
        *key_cols, F.col(topic_col).alias("topic"), F.posexplode(records).alias("ordinal", "record")
    ).select(
        *key_cols,
        "ordinal",
        "topic",
        "record.prompt",
        *[f"record.combo.{k}" for k in LISTED],
        "record.combo.source_template",
    )


def seeded_order(df: DataFrame, seed: int, *key_cols: str) -> DataFrame:
    """A reproducible shuffle: the same rows get the same order on any cluster."""
    return df.orderBy(seeded_key(seed, *key_cols), *key_cols)


def role_templates(roles: DataFrame, role_col: str, templates: Sequence[str]) -> DataFrame:
    """Every role in every system-prompt template."""
    numbered = rows_of(enumerate(templates), "template", "source_template")
    value_of = field_lookup({"role": F.col("role")})
    return roles.select(F.col(role_col).alias("role"), F.inline(numbered)).select(
        "role", "template", choose_template(F.col("template"), [render(t, value_of) for t in templates]).alias("prompt")
    )


# The system-prompt templates for roles.
ROLE_TEMPLATES = (
    "You are an expert {role}. Provide clear, concise answers.",
    "Act as a {role} mentor guiding a new team member.",
    "As a senior {role}, respond in checklist format with reasoning.",
    "Write your response as if you were documenting best practices for {role}s.",
)

# The parameter grid.
TEMPERATURES = (0.2, 0.5, 0.7, 1.0)
MAX_TOKENS = (100, 250, 500)


def parameter_grid(
    scores: DataFrame,
    temperatures: Sequence[float] = TEMPERATURES,
    max_tokens: Sequence[int] = MAX_TOKENS,
) -> DataFrame:
    """Each row of measured scores once per temperature and token limit."""
    cells = [(float(t), int(m)) for t in temperatures for m in max_tokens]
    return scores.select(F.inline(rows_of(cells, "temperature", "max_tokens")), "*")
