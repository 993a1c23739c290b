import hashlib
import json

import pytest

from textgauge.operators import catalog, contracts, runs
from textgauge.operators.lexicon import Lexicon
from textgauge.sources import configs, files, manifests, prompts, sinks, texts
from textgauge.session import once, scratch_path, shared_dir


def write(folder, name, content):
    path = folder / name
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_csv_texts(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'id,grp,text\n1,a,"line one\nsays ""hi"""\n2,,plain\n')
    rows = texts.read_csv_texts(spark, path, id_col="id", group_col="absent").collect()
    assert [(r.id, r.text) for r in rows] == [("1", 'line one\nsays "hi"'), ("2", "plain")]
    with pytest.raises(ValueError, match="no column 'note'"):
        texts.read_csv_texts(spark, path, text_col="note")


def test_topics_are_trimmed(spark, tmp_path):
    path = write(tmp_path, "t.csv", "topic , domain\n a topic ,\n")
    row = texts.read_topics(spark, path).first()
    assert row.asDict() == {"topic": "a topic", "domain": ""}


def test_column_json(spark, tmp_path):
    good = write(tmp_path, "a.json", json.dumps({"text": ["warm rain", "no", "hail"], "label": [0, 1, 1], "made": "here"}, indent=1))
    assert [tuple(r) for r in texts.read_column_json(spark, good).collect()] == [("warm rain", 0), ("no", 1), ("hail", 1)]
    with pytest.raises(ValueError, match="a list of texts and a list of labels"):
        texts.read_column_json(spark, write(tmp_path, "b.json", '{"text": ["a"]}'))
    with pytest.raises(Exception, match="differ in length"):
        texts.read_column_json(spark, write(tmp_path, "c.json", '{"text": ["a", "b"], "label": [1]}')).collect()


def test_jsonl(spark, tmp_path):
    path = write(tmp_path, "a.jsonl", '{"prompt":"snow","label":0}\n\n{"label":1,"prompt":"ice"}\n')
    assert [tuple(r) for r in texts.read_jsonl_texts(spark, path).collect()] == [("snow", 0), ("ice", 1)]
    mixed = write(tmp_path, "b.jsonl", '{"prompt":"a","text":"b","label":1.0}\n{"text":null,"prompt":"c","label":"0"}\n{"label":1}\n')
    assert [tuple(r) for r in texts.read_jsonl_texts(spark, mixed).collect()] == [("b", 1), ("c", 0), (None, 1)]
    with pytest.raises(Exception, match="not a JSON object: nonsense"):
        texts.read_jsonl_texts(spark, write(tmp_path, "c.jsonl", '{"text":"a","label":1}\nnonsense\n')).collect()
    with pytest.raises(Exception, match="abc"):
        texts.read_jsonl_texts(spark, write(tmp_path, "d.jsonl", '{"text":"a","label":"abc"}\n')).collect()


def test_prompt_batches(spark, tmp_path):
    path = write(tmp_path, "p.json", json.dumps([{"prompt": "Draw a map.", "topic": "Maps"}, "List three rivers.", {"prompt": "Name a lake."}]))
    rows = prompts.read_prompts(spark, path).orderBy("pos").collect()
    assert [(r.prompt, r.topic) for r in rows] == [("Draw a map.", "Maps"), ("List three rivers.", None), ("Name a lake.", None)]
    assert prompts.read_prompts(spark, write(tmp_path, "e.json", "[]")).count() == 0
    for bad, message in (('{"prompt": "x"}', "a prompt batch is a list"), ("[1]", "a text or has one"), ('[{"prompt": 2}]', "a text or has one"),
                         ('[{"topic": "x"}]', "a text or has one")):
        with pytest.raises(Exception, match=message):
            prompts.read_prompts(spark, write(tmp_path, "bad.json", bad)).collect()


def lexicon_rows(spark, tmp_path, content):
    rows = configs.read_lexicon(spark, write(tmp_path, "lex.json", content)).orderBy("pos").collect()
    return [(r.term, r.category, r.weight) for r in rows]


def test_lexicons(spark, tmp_path):
    listed = {"terms": [{"pattern": "a", "category": "x", "weight": 2}, {"term": "b"}, {"category": "lost"}, {"pattern": "", "term": "c"}]}
    assert lexicon_rows(spark, tmp_path, json.dumps(listed)) == [("a", "x", 2.0), ("b", "uncat", 1.0), ("c", "uncat", 1.0)]
    mapped = {"it's": {"category": "x", "weight": 0.5}, "b": {}, "c": None}
    assert lexicon_rows(spark, tmp_path, json.dumps(mapped)) == [("it's", "x", 0.5), ("b", "uncat", 1.0)]
    assert lexicon_rows(spark, tmp_path, '{"terms": []}') == []
    quoted = {"terms": [{"pattern": "a", "weight": "0.5"}, {"pattern": "b", "weight": None}]}
    assert lexicon_rows(spark, tmp_path, json.dumps(quoted)) == [("a", "uncat", 0.5), ("b", "uncat", 1.0)]
    with pytest.raises(Exception, match="not a weight: abc"):
        lexicon_rows(spark, tmp_path, '{"terms": [{"pattern": "a", "weight": "abc"}]}')
    with pytest.raises(Exception, match="a list of terms or a map"):
        lexicon_rows(spark, tmp_path, "[1]")


def test_lexicon_from_file(spark, tmp_path):
    path = write(tmp_path, "l.json", '{"he": {"category": "pronoun"}, "so-called": {"category": "tone", "weight": 0.5}}')
    custom = configs.read_lexicon(spark, path).collect()
    lexicon = Lexicon.builtin().overlay([(r.term, r.category, r.weight) for r in custom])
    assert len(lexicon.entries) == 20
    assert Lexicon.from_frame(lexicon.frame(spark)).entries == lexicon.entries


def test_term_lists(spark, tmp_path):
    path = write(tmp_path, "deny.txt", " one \n\n  \ntwo words\n")
    assert [r.value for r in configs.read_terms(spark, path).collect()] == ["one", "two words"]
    assert configs.read_terms(spark, str(tmp_path / "none.txt")).count() == 0
    assert configs.read_terms(spark, None).count() == 0
    many = write(tmp_path, "many.txt", "".join(f"term {k}\n" for k in range(5000, 0, -1)))
    assert configs.listed(configs.read_terms(spark, many), "value") == [f"term {k}" for k in range(5000, 0, -1)]


def test_templates(spark, tmp_path):
    for content in ('["Explain {topic}.", "Two"]', '{"templates": ["Explain {topic}.", "Two"]}'):
        rows = configs.read_templates(spark, write(tmp_path, "t.json", content)).orderBy("tmpl_i").collect()
        assert [r.tmpl for r in rows] == ["Explain {topic}.", "Two"]
    for content in ('["a", " "]', '{"other": []}', '["a", null]'):
        with pytest.raises(Exception, match="list of templates"):
            configs.read_templates(spark, write(tmp_path, "t.json", content)).collect()


def test_file_fingerprint(spark, tmp_path):
    write(tmp_path, "d.json", '{"text":["good","bad"],"label":[1,0]}')
    write(tmp_path, "b.csv", "x\n")
    write(tmp_path, "skipped.txt", "x\n")
    rows = files.file_fingerprints(spark, str(tmp_path)).collect()
    assert [r.path.rsplit("/", 1)[1] for r in rows] == ["b.csv", "d.json"]
    assert rows[1].sha256 == "2e2610caa83cc8019f9a433bdfe01c8bb8b7c8e0116a2516f834e37bb98f30f8"
    assert [r.bytes for r in files.list_files(spark, str(tmp_path)).collect()] == [2, 37]


def test_large_files_are_streamed(spark, tmp_path):
    """Beyond a row's size files are read in chunks; names need not be plain."""
    sizes = {"a b%20é#?.json": 5, "b.json": 3, "c.json": 4, "d.json": 2 * files.CHUNK + 1}
    for name, size in sizes.items():
        with open(tmp_path / name, "wb") as out:
            out.write(bytes(range(256)) * (size // 256) + b"x" * (size % 256))
    rows = files.file_fingerprints(spark, str(tmp_path), max_row_bytes=3).collect()
    found = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256) for r in rows}
    assert sorted(found.values()) == sorted((n, hashlib.sha256((tmp_path / k).read_bytes()).hexdigest()) for k, n in sizes.items())


def test_sparse_file_of_gigabytes(spark, tmp_path):
    """A file of zeros that no row could hold."""
    size = 3 << 30
    with open(tmp_path / "zeros.json", "wb") as out:
        out.truncate(size)
    digest = hashlib.sha256()
    for _ in range(size >> 24):
        digest.update(bytes(1 << 24))
    row = files.file_fingerprints(spark, str(tmp_path)).first()
    assert (row.bytes, row.sha256) == (size, digest.hexdigest())


def test_catalog(spark):
    df = spark.createDataFrame([(1, "hello"), (2, "world"), (2, "world")], "id int, text string")
    row = catalog.profile(df, "t", "csv").first()
    assert (row.rows, row.columns, row.format) == (3, ["id", "text"], "csv")
    same = catalog.profile(df.repartition(5).orderBy("text"), "t", "csv").first()
    assert same.digest == row.digest
    assert catalog.profile(df.distinct(), "t", "csv").first().digest != row.digest
    blank = spark.createDataFrame([("",)], "a string"), spark.createDataFrame([(None,)], "a string")
    assert catalog.profile(blank[0], "t", "x").first().digest != catalog.profile(blank[1], "t", "x").first().digest
    labels = spark.createDataFrame([(0,), (1,), (1,)], "label int")
    assert catalog.label_count_map(labels).first().label_counts == {"0": 1, "1": 2}


def test_catalog_freshness(spark):
    a, b = spark.range(3).toDF("id"), spark.range(4).toDF("id")
    stored = catalog.profiles({"x": a, "gone": a, "y": a})
    now = catalog.profiles({"x": a, "new": a, "y": b})
    assert {tuple(r) for r in catalog.freshness(now, stored).collect()} == {
        ("new", "added"), ("gone", "removed"), ("y", "changed"),
    }
    catalog.require_fresh(now, now)
    with pytest.raises(ValueError, match="stale"):
        catalog.require_fresh(now, stored)


def labelled(spark, labels):
    return spark.createDataFrame([("t", v) for v in labels], "text string, label int")


def test_contract(spark):
    with pytest.raises(ValueError, match="binary labels 0 and 1"):
        contracts.checked(labelled(spark, [0, 1, 2]))
    with pytest.raises(ValueError, match="binary labels 0 and 1"):
        contracts.checked(labelled(spark, [1, 1]))
    with pytest.raises(ValueError, match="at least 2 rows"):
        contracts.checked(labelled(spark, [1, 0, 1]))
    with pytest.raises(ValueError, match="lacks a text or a label"):
        contracts.checked(labelled(spark, [None]))
    with pytest.raises(ValueError, match="no column named"):
        contracts.checked(spark.range(2).toDF("text"))
    assert contracts.checked(labelled(spark, [0, 0, 1, 1, None])).count() == 4
    assert contracts.violations(labelled(spark, [0, 0, 1, 1])).count() == 0
    assert [r.column for r in contracts.missing_columns(spark.range(1)).collect()] == ["label", "text"]


MANIFEST = {
    "status": "passed",
    "generated_at_utc": "2026-01-01T00:00:00Z",
    "steps": [
        {"name": "evaluate_prompts", "artifacts": []},
        {"name": "bias_detection", "artifacts": [{"path": "elsewhere/sample_bias_report.json", "exists": True, "bytes": 5},
                                                  {"path": "elsewhere/x.csv", "exists": False, "bytes": 0}]},
    ],
}


def test_manifests_and_reports(spark, tmp_path):
    write(tmp_path, "manifest.json", json.dumps(MANIFEST, indent=2))
    write(tmp_path, "prompt_evaluation.json", '{"summary": {"records": 2}}')
    manifest = manifests.read_manifests(spark, str(tmp_path / "manifest.json"))
    flat = runs.artifact_rows(manifest, "manifest_path", "base_dir")
    summary = {r.step: (r.artifacts, r.missing, r.bytes) for r in runs.step_summary(flat, "manifest_path").collect()}
    assert summary == {"evaluate_prompts": (0, 0, 0), "bias_detection": (2, 1, 5)}
    run = runs.run_summary(flat, "manifest_path").first()
    assert (run.steps, run.artifacts, run.missing) == (2, 2, 1)
    assert [r.path for r in runs.missing_artifacts(flat).collect()] == ["elsewhere/x.csv"]
    paths = runs.report_paths(flat, "manifest_path", "base_dir")
    by_report = {r.report: r.path for r in paths.collect()}
    assert by_report["bias_report"] == "elsewhere/sample_bias_report.json"  # no root is given
    found = runs.attach_reports(paths, manifests.read_reports(spark, str(tmp_path))).collect()
    content = {r.report: r.content for r in found}
    assert json.loads(content["prompt_eval"])["summary"]["records"] == 2
    assert content["model_summary"] is None


def test_runs_of_every_kind(spark, tmp_path):
    """No steps, repeated names, plain paths, and reports found through artifacts."""
    lab = tmp_path / "lab"
    (lab / "out").mkdir(parents=True)
    write(lab / "out", "sample_bias_report.json", '{"rows": 4}')
    step = {"name": "bias_detection", "artifacts": ["out/sample_bias_report.json", {"path": "gone.csv", "exists": False, "bytes": 3}]}
    docs = {"a": {"steps": []}, "b": {"status": "passed"}, "c": {"steps": [step, {"name": "s"}, {"name": "s", "artifacts": ["x"]}]}}
    for name, content in docs.items():
        (lab / name).mkdir()
        write(lab / name, "manifest.json", json.dumps(content, indent=1))
    flat = runs.artifact_rows(manifests.read_manifests(spark, f"{lab}/*/manifest.json"), "manifest_path", "base_dir")
    summary = {r.manifest_path[-15]: (r.steps, r.artifacts, r.missing, r.bytes) for r in runs.run_summary(flat, "manifest_path").collect()}
    assert summary == {"a": (0, 0, 0, 0), "b": (0, 0, 0, 0), "c": (3, 3, 1, 3)}
    paths = runs.report_paths(flat, "manifest_path", "base_dir", root=str(lab))
    assert paths.count() == 9
    found = runs.attach_reports(paths, manifests.read_reports(spark, f"{lab}/out")).where("content IS NOT NULL").collect()
    assert [(r.report, r.content) for r in found] == [("bias_report", '{"rows": 4}')]


def test_prompt_sinks(spark):
    df = spark.createDataFrame([("t", "p", 1)], "topic string, prompt string, extra int")
    path = scratch_path(spark, "sink")
    sinks.write_prompts(df, path + "/a")
    sinks.write_prompts(df, path + "/b", with_metadata=False)
    assert spark.read.json(path + "/a").columns == ["prompt", "topic"]
    assert prompts.read_prompts_jsonl(spark, path + "/b").first().asDict() == {"prompt": "p"} | dict.fromkeys(prompts.FIELDS)


def test_shared_folder_is_reused(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_once_is_a_barrier(spark):
    from pyspark.sql import functions as F

    df = once(spark.range(5), heavy=F.upper(F.repeat(F.lit("a"), 3))).where("heavy = 'AAA'")
    assert df.count() == 5
