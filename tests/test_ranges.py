"""Files read in ranges against the same files read by one task, and by Python's own parsers."""

import csv
import io
import json
import random
from contextlib import contextmanager

import pytest

from textgauge.sources import prompts, ranges, texts

CELLS = ["", "plain", "two words", "a,b", 'say "hi"', "line\nbreak", "cr\r\nlf", '"', '""', "\n\n", "é漢", ' "x" ', "5\" disk", ",", "\n,\"\n"]


@contextmanager
def split_every(spark, size):
    """Let Spark cut files into ranges of about so many bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def write(path, content):
    path.write_text(content, encoding="utf-8", newline="")
    return str(path)


def csv_of(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end,size", [("\n", 24), ("\n", 200), ("\r\n", 33), ("\n", 1 << 20)])
def test_csv_ranges_equal_one_task(spark, tmp_path, end, size):
    rng = random.Random(size)
    rows = [[str(i), rng.choice(["a", "b", ""]), "".join(rng.choices(CELLS, k=rng.randint(0, 3)))] for i in range(40)]
    rows[7][2] = "x,\n" * 60  # a record over many ranges
    path = write(tmp_path / "t.csv", csv_of([["id", "grp", "text"], *rows], end))
    whole = texts.read_csv_texts(spark, path, id_col="id", group_col="grp", ranged=False).collect()
    with split_every(spark, size):
        found = texts.read_csv_texts(spark, path, id_col="id", group_col="grp", ranged=True).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, whole))
    # Spark's parser makes line ends in a text plain in a file whose lines end with both characters
    assert {r.id: r.text or "" for r in found} == {i: t if end == "\n" else t.replace("\r\n", "\n") for i, _, t in rows}


def test_csv_of_stray_quotes_and_empty_lines(spark, tmp_path):
    content = 'text,n\n5" disk,1\n\n"a ""b""\n\nc",2\nend "x" y,3\n,4\n"",5\nlast,6'
    path = write(tmp_path / "t.csv", content)
    whole = spark.read.options(**texts.CSV_OPTIONS).csv(path).collect()
    for size in (3, 11, 1000):
        with split_every(spark, size):
            found = texts.read_csv(spark, path, ranged=True).collect()
        assert sorted(map(repr, found)) == sorted(map(repr, whole))


def test_csv_of_one_column_and_several_files(spark, tmp_path):
    for name in ("a", "b"):
        write(tmp_path / f"{name}.csv", csv_of([["text"], [f"{name}\n1"], [f"{name} 2"], ["x" * 500]]))
    with split_every(spark, 20):
        found = texts.read_csv_texts(spark, str(tmp_path), ranged=True).collect()
    assert sorted(r.text for r in found) == sorted(["a\n1", "b\n1", "a 2", "b 2", "x" * 500, "x" * 500])
    typed = texts.read_csv(spark, write(tmp_path / "c.csv", "n,t\n1,a\n2,b\n"), schema="n INT, t STRING", ranged=True)
    assert sorted(map(tuple, typed.collect())) == [(1, "a"), (2, "b")]


def test_topics_in_ranges(spark, tmp_path):
    path = write(tmp_path / "t.csv", csv_of([[" topic ", "goal"], [" Maps ", "x\ny"], ["Snow", ""]]))
    with split_every(spark, 9):
        rows = texts.read_topics(spark, path, ranged=True).collect()
    assert sorted((r.topic, r.goal) for r in rows) == [("Maps", "x\ny"), ("Snow", "")]


def test_large_files_are_read_in_ranges(spark, tmp_path):
    path = write(tmp_path / "t.csv", csv_of([["text"], *[[f"row\n{i}"] for i in range(200)]]))
    assert not ranges.has_large_files(spark, path)
    with split_every(spark, 100):
        assert ranges.has_large_files(spark, path)
        df = texts.read_csv_texts(spark, path)
        assert df.rdd.getNumPartitions() > 1
        assert sorted(r.text for r in df.collect()) == sorted(f"row\n{i}" for i in range(200))


STRINGS = ["", "plain", "a, b", 'say "hi"', "back\\slash", "\\", '\\"', "[x], {y}", "line\n", "é漢😀", "]", "}{", ","]


@pytest.mark.parametrize("size,indent", [(11, None), (60, 1), (300, None), (1 << 20, None)])
def test_column_json_ranges(spark, tmp_path, size, indent):
    rng = random.Random(size)
    listed = ["".join(rng.choices(STRINGS, k=rng.randint(0, 4))) for _ in range(40)]
    labels = [rng.randint(0, 1) for _ in listed]
    data = {"name": "x, [y]", "text": listed, "classes": {"0": "a,b", "1": ["c"]}, "label": labels, "made": "here"}
    path = write(tmp_path / "a.json", json.dumps(data, indent=indent, ensure_ascii=False))
    with split_every(spark, size):
        found = texts.read_column_json(spark, path, ranged=True).collect()
    assert sorted(map(tuple, found)) == sorted(zip(listed, labels))


def test_column_json_in_ranges_is_checked(spark, tmp_path):
    with split_every(spark, 10):
        empty = write(tmp_path / "a.json", '{"text": [], "label": [ ]}')
        assert texts.read_column_json(spark, empty, ranged=True).count() == 0
        uneven = write(tmp_path / "b.json", '{"text": ["a", "b"], "label": [1]}')
        with pytest.raises(Exception, match="differ in length"):
            texts.read_column_json(spark, uneven, ranged=True).collect()


@pytest.mark.parametrize("size,indent", [(9, None), (64, 2), (1 << 20, None)])
def test_prompt_batch_ranges(spark, tmp_path, size, indent):
    rng = random.Random(size)
    items = [rng.choice([s, {"prompt": s, "topic": "t,[1]"}]) for s in STRINGS * 3]
    path = write(tmp_path / "p.json", json.dumps(items, indent=indent))
    whole = prompts.read_prompts(spark, path, ranged=False).collect()
    with split_every(spark, size):
        found = prompts.read_prompts(spark, path, ranged=True).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, whole), key=repr)
    assert [r.prompt for r in sorted(found, key=lambda r: r.pos)] == [i if isinstance(i, str) else i["prompt"] for i in items]


def test_prompt_batch_in_ranges_is_checked(spark, tmp_path):
    with split_every(spark, 6):
        assert prompts.read_prompts(spark, write(tmp_path / "e.json", " [ ] "), ranged=True).count() == 0
        for bad, message in (('{"prompt": "x", "topic": "y"}', "a prompt batch is a list"), ("[1, 2]", "a text or has one"), ('["a", {"topic": "x"}]', "a text or has one")):
            with pytest.raises(Exception, match=message):
                prompts.read_prompts(spark, write(tmp_path / "bad.json", bad), ranged=True).collect()
