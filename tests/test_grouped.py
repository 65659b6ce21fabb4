"""Grouped map: many groups a batch, the same frames for the function as one batch a group."""

import pandas as pd
import pytest

from genoframe.operators.grouped import group_map


@pytest.mark.parametrize("batch", [3, 10_000])
def test_groups_equal_apply_in_pandas(spark, batch):
    """NULLs in one group leave the integers of another whole; a NULL key is a group; groups pass the ends of batches."""
    def seen(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf["x"]
        return pd.DataFrame({"a": [pdf["a"].iloc[0]], "n": [len(pdf)], "total": [x.sum()], "whole": [x.dtype.kind == "i"],
                             "named": [int(pdf["s"].notna().sum())], "big": [int(pdf["y"][len(pdf) - 1] >> 60)], "most": [int(pdf["y"].max())]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rows = [(None if i % 13 == 0 else i % 37, i % 2 == 0, None if i % 37 == 5 and i % 3 == 0 else i, (1 << 60) + i, None if i % 4 else "s") for i in range(600)]
        df = spark.createDataFrame(rows, "a long, b boolean, x int, y long, s string")
        out = "a long, n long, total double, whole boolean, named long, big long, most long"
        got, want = group_map(df, ["a", "b"], seen, out), df.groupBy("a", "b").applyInPandas(seen, out)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() > 70
        assert "FlatMapGroupsInPandas" not in got._jdf.queryExecution().toString()
        assert group_map(df.limit(0), ["a"], seen, out).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_other_types_go_alone(spark):
    df = spark.createDataFrame([("u", 1.5), ("u", 2.5), (None, 1.0)], "k string, x double")
    got = group_map(df, ["k"], lambda p: pd.DataFrame({"k": [p["k"].iloc[0]], "t": [p["x"].sum()]}), "k string, t double")
    assert sorted(map(tuple, got.collect()), key=repr) == [("u", 4.0), (None, 1.0)]
