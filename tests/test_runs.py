"""Paths of reports, found with one row a run."""

from textgauge.operators import runs

ROWS = [
    (1, "b1", 0, "prompt_eval", 0, "x/other.json"), (1, "b1", 0, "prompt_eval", 1, "x/p.json"), (1, "b1", 0, "prompt_eval", 2, "y/p.json"),
    (1, "b1", 3, "prompt_eval", 0, "z/p.json"), (2, "b2", 0, "prompt_eval", 0, "x/none"), (2, "b2", 1, "prompt_eval", 0, "x/p.json"),
    (2, "b2", 2, "bias", None, None), (3, "b3", None, None, None, None),
]
REPORTS = {"one": ("prompt_eval", "p.json"), "two": ("bias", "q.json")}


def test_first_artifact_of_the_first_step_by_one_row_a_run(spark):
    df = spark.createDataFrame(ROWS, "run int, base string, step_no int, step string, artifact_no int, path string").repartition(3)
    found = runs.report_paths(df, "run", "base", REPORTS)
    expected = [(1, "one", "x/p.json"), (1, "two", "b1/q.json"), (2, "one", "b2/p.json"), (2, "two", "b2/q.json"), (3, "one", "b3/p.json"), (3, "two", "b3/q.json")]
    assert sorted(map(tuple, found.collect())) == expected
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate [run")  # reports are listed above the sums, not below
