"""The registered queries of the operators, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.llm import bpe, fill_middle, html_text, importance, kneser_ney, line_dedup, pii, quality_classifier, quality_rules, simhash, suffix_repeats, warc, winnowing

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query
def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    found = pii.find(docs, pii.fit(docs))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("id").alias("doc_id"), *map(count, pii.KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


@query
def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op3_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    found = bpe.decode(bpe.encode(table(spark, sf, "documents", "doc_id", "text"), path), path)
    return found.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_kneser_ney(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")

    def held(key: str) -> Column:
        return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(7)) == 2, F.lit(False))

    model = kneser_ney.train(docs.where(~held("doc_id")))
    return kneser_ney.score(docs, model).select(
        F.col("id").alias("doc_id"), held("id").alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity"
    )


@query
def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    model = quality_rules.fit(docs, table(spark, sf, "labels", "doc_id", "quality"))
    return quality_rules.judge(docs, model).withColumnRenamed("id", "doc_id")


@query
def op6_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    weights = quality_classifier.fit(docs, table(spark, sf, "labels", "doc_id", "quality").where(~held))
    scored = quality_classifier.score(docs, weights)
    return scored.select(
        F.col("id").alias("doc_id"),
        (F.pmod(F.crc32(F.col("id").cast("string")), F.lit(4)) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query
def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    items = table(spark, sf, "benchmark", "item_id", "text")
    return winnowing.contaminated_words(docs, items).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL["op7_decontamination"] = rf"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce({LOWER}, ''), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(coalesce({LOWER}, ''), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), items AS (
  SELECT item_id, least(len(w), 10) AS span, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w FROM iw WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, span, array_to_string(w[i:i + span - 1], ' ') AS win FROM items
), spans AS (
  SELECT DISTINCT span FROM windows
), found AS (
  SELECT doc_id, span, i, array_to_string(w[i:i + span - 1], ' ') AS win
  FROM (SELECT doc_id, span, w, unnest(range(1, len(w) - span + 2)) AS i FROM dw, spans)
), hits AS (
  SELECT doc_id, item_id, i, f.span FROM found f JOIN windows USING (span, win)
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + span)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op8_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages", "page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))


# What the method must give on pages whose article is marked and whose blocks
# are headings and paragraphs, as in the given tables.
SQL["op8_html_text"] = r"""
WITH inner_html AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS a FROM pages
), parts AS (
  SELECT page_id, url, string_split_regex(regexp_replace(a, '</?b>', '', 'g'), '</?(p|h1)>') AS p FROM inner_html
), plain AS (
  SELECT page_id, url, list_filter(list_transform(p, lambda x: trim(regexp_replace(
    replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS p
  FROM parts
)
SELECT page_id, url, array_to_string(p, chr(10) || chr(10)) AS text, CAST(length(array_to_string(p, chr(10) || chr(10))) AS BIGINT) AS n_chars
FROM plain
"""


@query
def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    # the table has no time of capture: one a minute, in the order of ids
    pages = table(spark, sf, "pages", "page_id", "url", "html").withColumn("captured", F.lit(1_600_000_000) + 60 * F.col("page_id"))
    found = warc.archive(pages)
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "captured")


SQL["op9_warc"] = """
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), named AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda k:
    array_to_string(list_transform([15, 10, 5, 0], lambda s:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hex, CAST(5 * k + 1 AS BIGINT), 5) AS BIGINT) >> s) % 32 + 1 AS BIGINT), 1)
    ), '')), '') AS payload_digest FROM digests
), firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM named GROUP BY payload_digest
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to, 1600000000 + 60 * page_id AS captured
FROM named JOIN firsts USING (payload_digest)
"""


@query
def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op10_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, line, pos,
    trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, line, pos, keeper IS NOT NULL AND keeper <> doc_id AS dropped FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op11_suffix_repeats(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_repeats.remove_repeats(table(spark, sf, "documents", "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op11_suffix_repeats"] = """
WITH bytes AS (
  SELECT doc_id, hex(coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS n FROM documents
), starts AS (
  SELECT doc_id, i, md5(substr(x, 2 * i + 1, 400)) AS m FROM (SELECT doc_id, x, unnest(range(n - 199)) AS i FROM bytes WHERE n >= 200)
), repeated AS (
  SELECT m FROM starts GROUP BY m HAVING count(*) > 1
), marked AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM starts SEMI JOIN repeated USING (m)
), runs AS (
  SELECT doc_id, i, sum(CASE WHEN b IS NULL OR i > b + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t, b FROM spans
), parts AS (
  SELECT doc_id, f, t FROM gaps UNION ALL SELECT doc_id, coalesce(max(s.b), 0), any_value(n) FROM bytes LEFT JOIN spans s USING (doc_id) GROUP BY doc_id
), kept AS (
  SELECT doc_id, sha256(unhex(coalesce(string_agg(substr(x, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) FILTER (t > f), ''))) AS kept_sha256
  FROM parts JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed, count(a) AS n_spans, any_value(kept_sha256) AS kept_sha256
FROM bytes LEFT JOIN spans USING (doc_id) JOIN kept USING (doc_id) GROUP BY doc_id, n
"""


@query
def op12_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf, "documents", "doc_id", "text"))
    return made.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(), 256).alias("restored_sha256"),
    )


SQL["op12_fill_middle"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), h AS (
  SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(d, CAST(i AS BIGINT), 8) AS BIGINT)) AS h FROM t
), c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
      WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
    coalesce(array_to_string(u[b + 1:n], ''), '') AS suf FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


@query
def op13_importance(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    found = importance.resample(docs, table(spark, sf, "benchmark", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


SQL["op13_importance"] = rf"""
WITH polynomial AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t
), texts AS (
  SELECT true AS ours, doc_id AS id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark
), listed AS (
  SELECT ours, id, list_filter(regexp_split_to_array(coalesce({LOWER}, ''), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM texts
), found AS (
  SELECT ours, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM listed
), hexed AS (
  SELECT f, hex(f) AS x FROM (SELECT DISTINCT f FROM found)
), hashed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256)), 4294967295) % 10000 AS bucket FROM hexed, polynomial
), counted AS (
  SELECT bucket, count(*) FILTER (ours) AS s, count(*) FILTER (NOT ours) AS t FROM found JOIN hashed USING (f) GROUP BY bucket
), sums AS (
  SELECT CAST(sum(s) AS DOUBLE) AS s_sum, CAST(sum(t) AS DOUBLE) AS t_sum FROM counted
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (s_sum + 10000)) / ((s + 1) * (t_sum + 10000)))) AS BIGINT) AS gain FROM counted, sums
), weighed AS (
  SELECT id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM found JOIN hashed USING (f) JOIN gains USING (bucket) WHERE ours GROUP BY id
), scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features,
    coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
    CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) AS h
  FROM listed LEFT JOIN weighed USING (id) WHERE ours
), noisy AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM noisy WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM noisy LEFT JOIN placed USING (doc_id)
"""
