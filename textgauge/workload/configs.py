"""Source queries: files and configuration documents made from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.operators import catalog
from textgauge.session import scratch_path
from textgauge.sources import configs, files, prompts, texts
from textgauge.sources.tables import table
from textgauge.workload.registry import documents, labelled, placed, query


@query("S1_csv_texts", "SELECT doc_id, lang, text FROM documents")
def csv_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents through CSV; the absent column asked for is left out."""
    return through_csv(spark, sf, None)


@query("S1_csv_in_ranges", "SELECT doc_id, lang, text FROM documents")
def csv_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The same, each file read as large ones are."""
    return through_csv(spark, sf, True)


def through_csv(spark: SparkSession, sf: str, ranged: bool | None) -> DataFrame:
    path = scratch_path(spark, "texts")
    documents(spark, sf).select("doc_id", "lang", "text").write.options(header=True, quote='"', escape='"').csv(path)
    schema = "doc_id bigint, lang string, text string"
    return texts.read_csv_texts(spark, path, "text", "doc_id", "lang", schema=schema, ranged=ranged).select("doc_id", "lang", "text")


@query("S2_topic_csv", "SELECT p_name AS topic, p_type AS domain, CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_brand END "
       "AS \"constraint\", p_partkey AS id FROM part")
def topic_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "topics")
    padded = table(spark, sf, "part").select(
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias(" topic "),
        F.concat("p_type", F.lit(" ")).alias("domain "),
        F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_brand")).alias(" constraint"),
        F.col("p_partkey").alias("id"),
    )
    padded.write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return texts.read_topics(spark, path).withColumn("id", F.col("id").cast("bigint"))


@query("S3_column_json", "SELECT text, CAST(quality AS BIGINT) AS label FROM documents JOIN labels USING (doc_id)")
def column_json(spark: SparkSession, sf: str) -> DataFrame:
    """Parallel arrays of at most 64 rows each, as ids are unique."""
    path = scratch_path(spark, "columns")
    blocks = labelled(spark, sf).groupBy((F.col("doc_id") / 64).cast("bigint").alias("block")).agg(
        F.collect_list(F.struct("text", "label")).alias("rows")
    )
    blocks.select(F.col("rows.text").alias("text"), F.col("rows.label").alias("label")).write.json(path)
    parallel = spark.read.schema("text array<string>, label array<bigint>").json(path)
    return texts.pair_columns(parallel)


@query("S3_columns_in_ranges", "SELECT text, CAST(quality AS BIGINT) AS label FROM documents JOIN labels USING (doc_id)")
def columns_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one object each, with the arrays of at most 4096 rows, cut by commas."""
    path = scratch_path(spark, "columns")
    blocks = labelled(spark, sf).groupBy((F.col("doc_id") / 4096).cast("bigint").alias("block")).agg(
        F.collect_list(F.struct("text", "label")).alias("rows")
    )
    arrays = blocks.select("block", F.lit("of, [all]").alias("made"), F.col("rows.text").alias("text"), F.col("rows.label").alias("label"))
    arrays.write.partitionBy("block").json(path)
    return texts.read_column_json(spark, path, ranged=True)


@query("S4_jsonl_texts", "SELECT text, CAST(toxic AS BIGINT) AS label FROM documents JOIN labels USING (doc_id)")
def jsonl_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a prompt instead of a text; blank lines are skipped."""
    path = scratch_path(spark, "lines")
    lines = labelled(spark, sf, "toxic").select(F.to_json(F.struct(F.col("text").alias("prompt"), "label")).alias("v"))
    lines.select(F.concat("v", F.lit("\n"))).write.text(path)
    return texts.read_jsonl_texts(spark, path)


@query(
    "S5_prompt_batches",
    "SELECT conv_id, turn, 0 AS pos, text AS prompt, NULL AS topic FROM conversations UNION ALL "
    "SELECT conv_id, turn, 1, 'Re: ' || text, role FROM conversations",
)
def prompt_batches(spark: SparkSession, sf: str) -> DataFrame:
    """One batch per turn: its text as a string, then as an object."""
    record = F.to_json(F.struct(F.concat(F.lit("Re: "), "text").alias("prompt"), F.col("role").alias("topic")))
    # A JSON string literal is what remains of a one-element array of it.
    text = F.regexp_replace(F.to_json(F.array("text")), r"^\[|\]$", "")
    batch = F.concat(F.lit("["), text, F.lit(", "), record, F.lit("]"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", batch.alias("document"))
    return prompts.parse_prompt_batches(turns, "document", "conv_id", "turn").select(
        "conv_id", "turn", "pos", "prompt", "topic"
    )


@query("S5_batches_in_ranges", "SELECT text AS prompt, role AS topic FROM conversations")
def batches_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one batch each, with the turns of 1024 conversation numbers, cut by commas."""
    path = scratch_path(spark, "batches")
    turns = table(spark, sf, "conversations").groupBy((F.col("conv_id") / 1024).cast("bigint").alias("block")).agg(
        F.collect_list(F.struct(F.col("text").alias("prompt"), F.col("role").alias("topic"))).alias("items")
    )
    turns.select("block", F.to_json("items").alias("value")).write.partitionBy("block").text(path)
    return prompts.read_prompts(spark, path, ranged=True).select("prompt", "topic")


@query(
    "S6_lexicon_documents",
    "SELECT p_partkey, term, category, CAST(weight AS DOUBLE) AS weight, pos FROM ("
    "SELECT p_partkey, p_name AS term, p_type AS category, p_size / 4.0 AS weight, 0 AS pos FROM part WHERE p_type <> 'SMALL' "
    "UNION ALL SELECT p_partkey, p_brand, 'uncat', 1.0, 1 FROM part WHERE p_type <> 'SMALL' "
    "UNION ALL SELECT p_partkey, p_name, 'uncat', p_size / 4.0, 0 FROM part WHERE p_type = 'SMALL')",
)
def lexicon_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Both lexicon shapes, with missing categories, weights and terms."""
    weight = (F.col("p_size") / 4.0).alias("weight")
    quoted = weight.cast("string").alias("weight")
    listed = F.struct(
        F.array(
            F.struct(F.col("p_name").alias("pattern"), F.lit(None).cast("string").alias("term"),
                     F.col("p_type").alias("category"), quoted),
            F.struct(F.lit("").alias("pattern"), F.col("p_brand").alias("term"),
                     F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("weight")),
            F.struct(F.lit(None).cast("string").alias("pattern"), F.lit(None).cast("string").alias("term"),
                     F.lit("skipped").alias("category"), quoted),
        ).alias("terms")
    )
    mapped = F.create_map("p_name", F.struct(weight))
    document = F.when(F.col("p_type") == "SMALL", F.to_json(mapped)).otherwise(F.to_json(listed))
    rows = table(spark, sf, "part").select("p_partkey", document.alias("document"))
    return configs.parse_lexicons(rows, "document", "p_partkey")


@query("S7_term_lists", "SELECT DISTINCT trim(p_name) AS term FROM part WHERE trim(p_name) <> ''")
def term_lists(spark: SparkSession, sf: str) -> DataFrame:
    """A word list file with padding and blank lines; a missing file is empty."""
    path = scratch_path(spark, "terms")
    table(spark, sf, "part").select(F.concat(F.lit("  "), "p_name", F.lit(" \n  "))).write.text(path)
    terms = configs.read_terms(spark, path).unionByName(configs.read_terms(spark, path + "-missing"))
    return terms.select(F.col("value").alias("term")).distinct()


@query(
    "S8_template_lists",
    "SELECT p_partkey, 0 AS tmpl_i, 'Explain {topic} to ' || p_type AS tmpl FROM part UNION ALL "
    "SELECT p_partkey, 1, 'List {topic} for ' || p_brand FROM part",
)
def template_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Bare lists and wrapped lists."""
    listed = F.array(F.concat(F.lit("Explain {topic} to "), "p_type"), F.concat(F.lit("List {topic} for "), "p_brand"))
    document = F.when(F.col("p_type") == "SMALL", F.to_json(listed)).otherwise(
        F.to_json(F.struct(listed.alias("templates")))
    )
    rows = table(spark, sf, "part").select("p_partkey", document.alias("document"))
    return configs.parse_templates(rows, "document", "p_partkey")


def file_name(df: DataFrame) -> DataFrame:
    return df.withColumn("path", F.regexp_extract("path", "([^/]+)$", 1))


NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
LISTED = ", ".join(f"('{n}.parquet')" for n in NAMES)


@query("S9_file_fingerprints", f"SELECT path, true AS hexadecimal, true AS sized FROM (VALUES {LISTED}) AS v(path)")
def file_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Names and the form of the digests; their values are tested on files of known bytes."""
    found = file_name(files.file_fingerprints(spark, sf, "*.parquet")).where(F.col("path").isin(*[f"{n}.parquet" for n in NAMES]))
    return found.select("path", F.col("sha256").rlike("^[0-9a-f]{64}$").alias("hexadecimal"), (F.col("bytes") > 0).alias("sized"))


# All tables by column. Numbers with fractions, times and vectors are brought to
# a form that both engines write alike.
TABLES = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal:number c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal:number",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice:number",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice:number o_orderdate:time o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity:number l_extendedprice:number l_discount:number "
    "l_tax:number l_returnflag l_linestatus l_shipdate:time",
    "events": "event_id ts:time user_id event_type value:number props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding:vector label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
SPARK_FORM = {
    "": "{c}",
    "number": "cast(round({c} * 10000) AS bigint)",
    "time": "date_format({c}, 'yyyy-MM-dd HH:mm:ss')",
    "vector": "array_join(transform({c}, x -> cast(cast(round(cast(x AS double) * 1000000) AS bigint) AS string)), ',')",
}
DUCK_FORM = {
    "": "CAST({c} AS VARCHAR)",
    "number": "CAST(CAST(round({c} * 10000) AS BIGINT) AS VARCHAR)",
    "time": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
    "vector": "array_to_string(list_transform({c}, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',')",
}


def forms(columns: str, by: dict[str, str]) -> list[tuple[str, str]]:
    """(column, expression) of a table's columns."""
    split = [c.partition(":") for c in columns.split()]
    return [(name, by[kind].format(c=name)) for name, _, kind in split]


DIGEST_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS path, count(*) AS \"rows\", CAST(sum(CAST(('0x' || md5(concat("
    + ", ".join(f"coalesce(length({e}) || ':' || {e}, '-')" for _, e in forms(columns, DUCK_FORM))
    + f"))[:15]) AS BIGINT)) AS VARCHAR) AS digest FROM {name}"
    for name, columns in TABLES.items()
)


@query("S9_table_digests", DIGEST_SQL)
def table_digests(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        name: table(spark, sf, name).selectExpr(*[f"{e} AS {c}" for c, e in forms(columns, SPARK_FORM)])
        for name, columns in TABLES.items()
    }
    return catalog.profiles(tables).select("path", "rows", "digest")


@query("F12_text_hashes", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def text_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", F.sha2("text", 256).alias("sha256"))


@query("S10_file_listing", f"SELECT path, row_number() OVER (ORDER BY path) AS place FROM (VALUES {LISTED}) AS v(path)")
def file_listing(spark: SparkSession, sf: str) -> DataFrame:
    found = file_name(files.list_files(spark, sf, "*.parquet"))
    return placed(found.where(F.col("path").isin(*[f"{n}.parquet" for n in NAMES])).select("path"))


@query(
    "A23_dataset_profiles",
    " UNION ALL ".join(
        f"SELECT '{n}' AS path, 'parquet' AS format, (SELECT count(*) FROM {n}) AS \"rows\", "
        f"(SELECT string_agg(name, ',' ORDER BY cid) FROM pragma_table_info('{n}')) AS columns"
        for n in NAMES
    ),
)
def dataset_profiles(spark: SparkSession, sf: str) -> DataFrame:
    tables = {n: table(spark, sf, n) for n in NAMES}
    rows = catalog.profiles(tables, fingerprint=False)
    return rows.withColumn("columns", F.array_join("columns", ","))


@query("A10_label_count_map", "SELECT '0:' || count(*) FILTER (quality = 0) || ',1:' || count(*) FILTER (quality = 1) AS counts "
       "FROM labels")
def label_count_map(spark: SparkSession, sf: str) -> DataFrame:
    one = catalog.label_count_map(table(spark, sf, "labels"), "quality")
    pairs = F.transform(F.map_entries("label_counts"), lambda e: F.concat_ws(":", e.key, e.value.cast("string")))
    return one.select(F.array_join(pairs, ",").alias("counts"))


@query(
    "J15_catalog_freshness",
    "SELECT * FROM (SELECT 'pages' AS path, 'added' AS state UNION ALL SELECT 'old_labels', 'removed' UNION ALL "
    "SELECT 'documents', CASE WHEN (SELECT count(*) FROM (SELECT DISTINCT lang, text FROM documents)) < "
    "(SELECT count(*) FROM documents) THEN 'changed' END) WHERE state IS NOT NULL",
)
def catalog_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """A stored catalog of all tables without pages, with distinct documents and an old table."""
    names = [n for n in NAMES if n != "pages"]
    now = {n: table(spark, sf, n) for n in (*names, "pages")}
    docs = now["documents"]
    before = {n: now[n] for n in names} | {
        "documents": docs.dropDuplicates(["lang", "text"]).select(docs.columns),
        "old_labels": now["labels"],
    }
    return catalog.freshness(catalog.profiles(now), catalog.profiles(before))
