"""Annotations whose lists grow with the source: how variants are spread, and the rows."""

from pyspark.sql import functions as F

from genoframe.operators import annotate as oa


def test_overlaps_are_made_in_many_tasks(spark):
    """Few bytes of variants with many pairs are spread by their key; repeated and null keys share their pairs as before."""
    v = spark.createDataFrame([(1, "1", 15), (2, "1", 25), (2, "1", 500), (None, "1", 15), (3, "2", 15)], "v bigint, chrom string, pos bigint").coalesce(1)
    iv = spark.createDataFrame([(7, "1", 10, 20), (8, "1", 12, 30), (9, "1", 490, 510)], "k bigint, chrom string, start bigint, end bigint")
    out = oa.annotate_overlap(v, iv, {"n": ("k", "count"), "ks": ("k", "concat")}, bin_width=100)
    assert "RepartitionByExpression [v" in (plan := out._jdf.queryExecution().optimizedPlan().toString()) and f", {oa._parts(v)}" in plan
    got = sorted(((r["v"], r["pos"], r["n"], r["ks"]) for r in out.collect()), key=str)
    assert got == sorted([(1, 15, 2, "7,8"), (2, 25, 2, "8,9"), (2, 500, 2, "8,9"), (None, 15, None, None), (3, 15, None, None)], key=str)


def test_lists_of_a_key_stand_together(spark):
    """Every part holds few keys, so that its file holds few different lists; a large key takes several parts."""
    v = spark.range(4000).select(F.col("id").alias("v"), (F.col("id") % 5).cast("string").alias("chrom")).repartition(8)
    src = spark.range(500).select(F.concat(F.lit("name"), F.col("id").cast("string")).alias("name"), (F.col("id") % 4).cast("string").alias("chrom"))
    spec = oa.AnnotationSpec(["name", "name"], ["n", "names"], ["count", "concat"])
    out = oa.annotate_exact(v, src, spec, key=["chrom"]).withColumn("part", F.spark_partition_id()).toPandas()
    assert out.groupby("part")["chrom"].nunique().max() <= 2 and out.groupby("chrom")["part"].nunique().min() > 1
    assert len(out) == 4000 and out[out["chrom"] == "4"]["names"].isna().all() and (out[out["chrom"] != "4"]["n"] == 125).all()
    assert out[out["chrom"] == "1"]["names"].unique().tolist() == [",".join(sorted(f"name{i}" for i in range(1, 500, 4)))]
