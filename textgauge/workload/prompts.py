"""Prompt queries: topics from ``part``, few-shot prompts from ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.functions.hashing import seeded_key
from textgauge.functions.templates import placeholders
from textgauge.operators import fewshot, prompts, rubric
from textgauge.plans.prompt_batch import prompt_batch
from textgauge.session import scratch_path
from textgauge.sources import sinks
from textgauge.sources.tables import table
from textgauge.workload.registry import placed, query, spread, values

KEY = ["p_partkey"]

# A mix of good and poor templates, so that every grade and piece of advice occurs.
MIXED_TEMPLATES = (
    "Explain {topic} in a {style} way.",
    "List the risks of {topic} for a {audience}.",
    "Describe {topic} in the {domain} domain as a {style}, aimed at a {audience}; include {length} notes.",
    "Compare {topic} vs alternatives in exactly 3 bullets with metrics and {unknown}limits: {constraint}.",
    prompts.BUILTIN_TEMPLATES[0],
    prompts.BUILTIN_TEMPLATES[5],
)


def topics(spark: SparkSession, sf: str) -> DataFrame:
    """A topic per part."""
    return spread(table(spark, sf, "part")).select(
        "p_partkey",
        F.col("p_name").alias("topic"),
        F.col("p_type").alias("domain"),
        F.col("p_brand").alias("constraint"),
    )


def mixed(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.generate(topics(spark, sf), KEY, templates=MIXED_TEMPLATES, dedupe=True, limit=0)


def scored_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Scored without the audience column, so that phrases decide that point."""
    return rubric.score_prompts(mixed(spark, sf).drop("audience"))


TOPICS = (
    "topics AS (SELECT p_partkey, trim(p_name) AS topic, p_type AS domain, p_brand AS cons FROM part "
    "WHERE trim(p_name) <> '')"
)
LISTS = ", ".join(
    f"{name} AS (SELECT * FROM {values(list(enumerate(items)), name + '_i', name)})"
    for name, items in (("style", prompts.STYLES), ("audience", prompts.AUDIENCES), ("level", prompts.LEVELS))
)


def filled(templates: tuple[str, ...]) -> str:
    fields = {"topic": "topic", "style": "style", "audience": "audience", "level": "level", "domain": "domain",
              "constraint": "cons", "length": "'short'", "unknown": "''"}
    text = "tmpl"
    for field, value in fields.items():
        text = f"replace({text}, '{{{field}}}', {value})"
    listed = values(list(enumerate(templates)), "tmpl_i", "tmpl")
    return (
        f"WITH {TOPICS}, {LISTS}, tmpls AS (SELECT * FROM {listed}), "
        f"allp AS (SELECT *, {text} AS prompt, ((style_i * 3 + audience_i) * 3 + level_i) * {len(templates)} + tmpl_i AS o "
        "FROM topics, style, audience, level, tmpls), "
        "firsts AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY o) - 1 AS ordinal FROM "
        "(SELECT * FROM allp QUALIFY row_number() OVER (PARTITION BY p_partkey, prompt ORDER BY o) = 1)) "
    )


BUILTIN = filled(prompts.BUILTIN_TEMPLATES)
MIXED = filled(MIXED_TEMPLATES)


def any_of(terms: tuple[str, ...]) -> str:
    return "CAST(" + " OR ".join(f"contains(lower(prompt), '{t}')" for t in terms) + " AS INTEGER)"


SCORED = MIXED + (
    ", points AS (SELECT p_partkey, CAST(ordinal AS INTEGER) AS ordinal, topic, style, level, tmpl_i, prompt, "
    f"{any_of(rubric.SPECIFICITY_TERMS)} AS specificity, {any_of(rubric.STRUCTURE_TERMS)} AS structure, "
    f"{any_of(rubric.AUDIENCE_PHRASES)} AS audience, {any_of(rubric.EVALUATION_TERMS)} AS evaluation_ready FROM firsts), "
    "scored AS (SELECT *, specificity + structure + audience + evaluation_ready AS score, "
    "CASE WHEN specificity + structure + audience + evaluation_ready >= 3 THEN 'strong' "
    "WHEN specificity + structure + audience + evaluation_ready >= 2 THEN 'usable' ELSE 'thin' END AS grade FROM points) "
)
ADVICE = " || ".join(
    f"CASE WHEN {name} = 0 THEN '{text}|' ELSE '' END" for name, text in rubric.GUIDANCE.items()
)


@query(
    "J1_permutations",
    f"WITH {TOPICS}, {LISTS} SELECT p_partkey, topic, style, audience, level, "
    "CAST((style_i * 3 + audience_i) * 3 + level_i AS INTEGER) AS permutation FROM topics, style, audience, level",
)
def permutations(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.permutations(topics(spark, sf)).select(
        "p_partkey", "topic", "style", "audience", "level", "permutation"
    )


@query(
    "J2_filled_templates",
    BUILTIN + "SELECT style, audience, level, CAST(tmpl_i AS INTEGER) AS template, count(*) AS n, "
    "CAST(sum(length(prompt)) AS BIGINT) AS chars, min(prompt) AS first_prompt, max(prompt) AS last_prompt "
    "FROM allp GROUP BY ALL",
)
def filled_templates(spark: SparkSession, sf: str) -> DataFrame:
    """Every combination is filled; the result shows what came out per cell."""
    filled_rows = prompts.fill_templates(prompts.permutations(topics(spark, sf)))
    return filled_rows.groupBy("style", "audience", "level", "template").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("prompt")).alias("chars"),
        F.min("prompt").alias("first_prompt"),
        F.max("prompt").alias("last_prompt"),
    )


@query("P4_usable_topics", "SELECT p_partkey, trim(t) AS topic FROM (SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN "
       "'  ' ELSE ' ' || p_name || ' ' END AS t FROM part) WHERE trim(t) <> ''")
def usable_topics(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.when(F.col("p_type") == "SMALL", F.lit("  ")).otherwise(F.concat(F.lit(" "), "p_name", F.lit(" ")))
    return prompts.usable_topics(table(spark, sf, "part").select("p_partkey", padded.alias("topic")))


OVERLAY = "Make a {length} {style} note on {topic} for {audience} in {domain}: {constraint}.{goal}{unknown}"


@query(
    "J14_row_over_defaults",
    "SELECT p_partkey, 'Make a short concise note on ' || p_name || ' for general reader in ' || "
    "CASE p_type WHEN 'ECONOMY' THEN 'general' WHEN 'SMALL' THEN '' ELSE p_type END || ': ' || p_brand || '.' AS prompt "
    "FROM part",
)
def row_over_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """A null or absent field takes its default, an empty one stays empty."""
    domain = F.when(F.col("domain") == "SMALL", "").when(F.col("domain") == "ECONOMY", None).otherwise(F.col("domain"))
    rows = topics(spark, sf).withColumn("domain", domain)
    return prompts.fill_templates(rows, [OVERLAY]).select("p_partkey", "prompt")


@query(
    "F6_template_values_kept",
    "SELECT p_partkey, 'On {style} ' || p_name || ' in concise style' AS prompt FROM part",
)
def values_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Braces in a value are text, not placeholders."""
    rows = topics(spark, sf).withColumn("topic", F.concat(F.lit("{style} "), "topic"))
    return prompts.fill_templates(rows, ["On {topic} in {style} style"]).select("p_partkey", "prompt")


@query(
    "F5_placeholders",
    "SELECT p_partkey, 'topic,' || lower(p_type) || ',style' AS fields FROM part",
)
def template_placeholders(spark: SparkSession, sf: str) -> DataFrame:
    """Templates made from rows; a repeated placeholder counts once."""
    template = F.concat(F.lit("{topic} and {"), F.lower("domain"), F.lit("} {topic} in {style} {not a field}"))
    return topics(spark, sf).select("p_partkey", F.array_join(placeholders(template), ",").alias("fields"))


@query("W1_deduplicated_prompts", BUILTIN + "SELECT p_partkey, CAST(ordinal AS INTEGER) AS ordinal, prompt, style, audience, "
       "level FROM firsts")
def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.generate(topics(spark, sf), KEY, dedupe=True, limit=0).select(
        "p_partkey", "ordinal", "prompt", "style", "audience", "level"
    )


@query("W2_first_prompts_per_topic", BUILTIN + "SELECT p_partkey, CAST(ordinal AS INTEGER) AS ordinal, topic, prompt, style, "
       "audience, level, tmpl AS source_template FROM firsts WHERE ordinal < 20")
def first_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.generate(topics(spark, sf), KEY, dedupe=True)


@query("W2_first_prompts_with_repeats", BUILTIN + "SELECT p_partkey, CAST(o AS INTEGER) AS ordinal, prompt, level FROM allp "
       "WHERE o < 20")
def first_with_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.generate(topics(spark, sf), KEY, dedupe=False).select("p_partkey", "ordinal", "prompt", "level")


@query("U1_all_topics_together", MIXED + "SELECT topic, count(*) AS n, count(DISTINCT prompt) AS prompts FROM firsts "
       "GROUP BY topic")
def all_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Repeats are dropped within a row only, so equal topics repeat prompts."""
    return mixed(spark, sf).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("prompt").alias("prompts")
    )


@query(
    "W8_seeded_shuffle",
    MIXED + "SELECT p_partkey, CAST(ordinal AS INTEGER) AS ordinal, "
    "md5(concat_ws(':', '42', p_partkey, ordinal)) AS shuffle_key FROM firsts",
)
def seeded_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    ordered = prompts.seeded_order(mixed(spark, sf), 42, "p_partkey", "ordinal")
    return ordered.select("p_partkey", "ordinal", seeded_key(42, "p_partkey", "ordinal").alias("shuffle_key"))


@query("P5_rubric_points", SCORED + "SELECT p_partkey, ordinal, specificity, structure, audience, evaluation_ready, score "
       "FROM scored")
def rubric_points(spark: SparkSession, sf: str) -> DataFrame:
    return scored_mixed(spark, sf).select("p_partkey", "ordinal", "rubric.*", "score")


@query("P6_grades", SCORED + "SELECT p_partkey, ordinal, grade FROM scored")
def grades(spark: SparkSession, sf: str) -> DataFrame:
    return scored_mixed(spark, sf).select("p_partkey", "ordinal", "grade")


@query("P7_recommendations", SCORED + f"SELECT p_partkey, ordinal, rtrim({ADVICE}, '|') AS advice FROM scored")
def advice(spark: SparkSession, sf: str) -> DataFrame:
    return scored_mixed(spark, sf).select("p_partkey", "ordinal", F.array_join("recommendations", "|").alias("advice"))


@query("P8_fields_passed_through", SCORED + "SELECT p_partkey, ordinal, topic, style, level, prompt, score FROM scored")
def passed_through(spark: SparkSession, sf: str) -> DataFrame:
    return scored_mixed(spark, sf).select("p_partkey", "ordinal", "topic", "style", "level", "prompt", "score")


@query("F15_joined_advice", SCORED + f"SELECT advice, count(*) AS n FROM (SELECT rtrim(replace({ADVICE}, '|', ' ')) AS advice "
       "FROM scored) WHERE advice <> '' GROUP BY advice")
def joined_advice(spark: SparkSession, sf: str) -> DataFrame:
    joined = scored_mixed(spark, sf).select(F.concat_ws(" ", "recommendations").alias("advice"))
    return joined.where("advice <> ''").groupBy("advice").agg(F.count(F.lit(1)).alias("n"))


@query("A7_grade_distribution", SCORED + "SELECT grade, count(*) AS n FROM scored GROUP BY grade")
def grade_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return rubric.grade_counts(scored_mixed(spark, sf))


@query("A8_average_score", SCORED + "SELECT count(*) AS records, round(sum(score) / greatest(count(*), 1), 3) AS average_score "
       "FROM scored")
def average_score(spark: SparkSession, sf: str) -> DataFrame:
    return rubric.average_score(scored_mixed(spark, sf))


@query(
    "A9_rubric_coverage",
    SCORED + " UNION ALL ".join(
        f"SELECT '{name}' AS dimension, round(sum({name}) / count(*), 3) AS coverage FROM scored"
        for name in rubric.GUIDANCE
    ),
)
def rubric_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return rubric.coverage(scored_mixed(spark, sf))


@query("W4_top_prompts", SCORED + "SELECT topic, prompt, score, grade, row_number() OVER (ORDER BY score DESC, prompt, "
       "p_partkey, ordinal) AS place FROM scored QUALIFY place <= 5")
def top_prompts(spark: SparkSession, sf: str) -> DataFrame:
    top = rubric.top_prompts(scored_mixed(spark, sf), tie_cols=("p_partkey", "ordinal"))
    return placed(top.select("topic", "prompt", "score", "grade"))


@query(
    "W5_needs_attention",
    SCORED + f"SELECT topic, prompt, score, rtrim({ADVICE}, '|') AS advice, row_number() OVER (ORDER BY score, prompt, "
    "p_partkey, ordinal) AS place FROM (SELECT * FROM scored ORDER BY score, prompt, p_partkey, ordinal LIMIT 5) "
    "WHERE score < 4",
)
def needs_attention(spark: SparkSession, sf: str) -> DataFrame:
    lowest = rubric.needs_attention(scored_mixed(spark, sf), tie_cols=("p_partkey", "ordinal"))
    return placed(lowest.select("topic", "prompt", "score", F.array_join("recommendations", "|").alias("advice")))


@query(
    "A25_mean_template_score",
    SCORED + "SELECT CAST(tmpl_i AS INTEGER) AS template, count(*) AS evaluated, round(avg(score), 3) AS avg_score "
    "FROM scored GROUP BY tmpl_i",
)
def mean_template_score(spark: SparkSession, sf: str) -> DataFrame:
    number = F.array_position(F.lit(list(MIXED_TEMPLATES)), F.col("source_template")) - 1
    return (
        scored_mixed(spark, sf)
        .groupBy("source_template")
        .agg(F.count(F.lit(1)).alias("evaluated"), F.round(F.avg("score"), 3).alias("avg_score"))
        .select(number.cast("int").alias("template"), "evaluated", "avg_score")
    )


GRID = ", ".join(
    f"{name} AS (SELECT * FROM {values([(v,) for v in items], name)})"
    for name, items in (("temperature", prompts.TEMPERATURES), ("max_tokens", prompts.MAX_TOKENS))
)


@query(
    "J13_parameter_grid",
    SCORED + f", {GRID} SELECT temperature, max_tokens, style, round(avg(score), 6) AS avg_eval_score "
    "FROM scored, temperature, max_tokens GROUP BY ALL",
)
def parameter_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Each cell holds the measured rubric average per style, not a random score."""
    measured = scored_mixed(spark, sf).groupBy("style").agg(F.round(F.avg("score"), 6).alias("avg_eval_score"))
    return prompts.parameter_grid(measured)


@query(
    "J12_roles_in_templates",
    "WITH roles AS (SELECT DISTINCT p_type || ' ' || p_brand AS role FROM part), t AS (SELECT * FROM "
    + values(list(enumerate(prompts.ROLE_TEMPLATES)), "template", "tmpl")
    + ") SELECT role, CAST(template AS INTEGER) AS template, replace(tmpl, '{role}', role) AS prompt FROM roles, t",
)
def roles_in_templates(spark: SparkSession, sf: str) -> DataFrame:
    roles = table(spark, sf, "part").select(F.concat_ws(" ", "p_type", "p_brand").alias("role")).distinct()
    return prompts.role_templates(roles, "role", prompts.ROLE_TEMPLATES)


def gappy_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations, a third of them with gaps of whole blocks between turns."""
    turn = F.when(F.col("conv_id") % 3 == 0, F.col("turn") * 300).otherwise(F.col("turn"))
    return table(spark, sf, "conversations").withColumn("turn", turn)


TURNS = """WITH t AS (SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN turn * 300 ELSE turn END AS turn, role, text FROM conversations),
n AS (SELECT *, lag(role, 1) OVER w AS r1, lag(role, 2) OVER w AS r2, lag(role, 3) OVER w AS r3, lag(role, 4) OVER w AS r4,
lag(text, 1) OVER w AS x1, lag(text, 2) OVER w AS x2, lag(text, 3) OVER w AS x3, lag(text, 4) OVER w AS x4,
lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) """


@query("F14_few_shot_pairs", TURNS + "SELECT conv_id, turn, text AS q, next_text AS a FROM n WHERE role = 'user' "
       "AND next_role = 'assistant'")
def few_shot_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return fewshot.shot_pairs(gappy_turns(spark, sf))


@query(
    "F14_few_shot_prompts",
    TURNS + "SELECT u.conv_id, u.turn, trim(u.text) AS user, trim(coalesce(s.text, 'Answer briefly.')) AS system, "
    "concat_ws(' | ', CASE WHEN r4 = 'user' AND r3 = 'assistant' THEN x4 || ' -> ' || x3 END, "
    "CASE WHEN r2 = 'user' AND r1 = 'assistant' THEN x2 || ' -> ' || x1 END) AS shots FROM n u "
    "LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS text FROM conversations WHERE role = 'system' GROUP BY conv_id) s "
    "ON s.conv_id = u.conv_id WHERE u.role = 'user'",
)
def few_shot_prompts(spark: SparkSession, sf: str) -> DataFrame:
    built = fewshot.few_shot_prompts(gappy_turns(spark, sf), default_system="Answer briefly.")
    shown = F.transform("shots", lambda s: F.concat(s.q, F.lit(" -> "), s.a))
    return built.select("conv_id", "turn", "user", "system", F.array_join(shown, " | ").alias("shots"))


@query(
    "F7_trimmed_texts",
    "SELECT conv_id, turn, trim('  ' || text || ' ') AS text FROM conversations",
)
def trimmed(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit("  "), "text", F.lit(" "))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.trim(padded).alias("text"))


@query("K1_prompt_file", BUILTIN + "SELECT topic, prompt, style, audience, level, tmpl AS source_template FROM firsts "
       "WHERE ordinal < 20")
def prompt_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "prompts")
    batch = prompt_batch(topics(spark, sf), KEY, dedupe=True)
    sinks.write_prompts(batch["prompts"], path)
    return spark.read.schema(", ".join(f"{c} string" for c in sinks.PROMPT_FIELDS)).json(path)


@query("K1_plain_prompt_file", BUILTIN + "SELECT prompt FROM firsts WHERE ordinal < 20")
def plain_prompt_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "prompts")
    sinks.write_prompts(prompts.generate(topics(spark, sf), KEY, dedupe=True), path, with_metadata=False)
    return spark.read.schema("prompt string").json(path)


@query("K4_scored_prompt_file", SCORED + f"SELECT p_partkey, prompt, score, grade, structure, rtrim({ADVICE}, '|') AS advice "
       "FROM scored")
def scored_prompt_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "scored")
    scored = scored_mixed(spark, sf)
    sinks.write_scored_prompts(scored, path, compression="gzip")  # records repeat their advice
    back = spark.read.schema(scored.schema).json(path)
    return back.select(
        "p_partkey", "prompt", "score", "grade", "rubric.structure", F.array_join("recommendations", "|").alias("advice")
    )
