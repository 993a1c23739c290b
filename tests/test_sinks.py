"""Written records."""

import glob

from textgauge.sources import sinks


def test_scored_prompts_may_be_compressed(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "'the same long advice for every prompt' AS advice").coalesce(1)
    sinks.write_scored_prompts(df, str(tmp_path / "plain"))
    sinks.write_scored_prompts(df, str(tmp_path / "packed"), compression="gzip")
    assert sorted(map(tuple, spark.read.schema(df.schema).json(str(tmp_path / "packed")).collect())) == sorted(map(tuple, df.collect()))
    plain, packed = (sum(len(open(f, "rb").read()) for f in glob.glob(f"{tmp_path}/{name}/part-*")) for name in ("plain", "packed"))
    assert packed * 5 < plain
