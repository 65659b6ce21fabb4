"""Stored score tables: no exchange on the score side, one record per allele, transcripts resolved."""

from pyspark.sql import functions as F

from genoframe import fixtures as fx
from genoframe.operators import scores as sc
from genoframe.session import scratch_dir


def test_the_score_side_is_not_shuffled(spark, sf):
    s = fx.scores(spark, sf)
    name = sc.write_scores(s, scratch_dir(spark, "t"), ["CADD_phred", "GO"], buckets=8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sc.annotate_stored(fx.variants(spark, sf), name)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, plan
    assert got.count() == fx.variants(spark, sf).count() and got.where("CADD_phred IS NOT NULL").count() > 0


def test_repeated_alleles_have_one_result(spark):
    rows = [("1", 5, "A", "C", "b", 1.0), ("1", 5, "A", "C", "a", 9.0), ("1", 5, "A", "C", "a", 3.0), ("1", 6, "A", "C", None, None)]
    d = spark.createDataFrame(rows, "chrom string, pos bigint, ref string, alt string, x string, y double")
    for n in (1, 3, 7):
        got = sorted(map(tuple, sc.one_per_allele(d.repartition(n), ["x", "y"]).collect()))
        assert got == [("1", 5, "A", "C", "a", 3.0), ("1", 6, "A", "C", None, None)]


def test_transcripts(spark):
    rows = [(1, "T1;T2;T3", "D;.;T", "0.5"), (2, "T1", "D", "."), (3, None, "D", "1"), (4, "T1;T2", "D", None)]
    d = spark.createDataFrame(rows, "v int, ids string, a string, b string")
    got = {(r.v, r.transcript): (r.a, r.b) for r in sc.unnest_transcripts(d, ["a", "b"], "ids").collect()}
    assert got == {(1, "T1"): ("D", "0.5"), (1, "T2"): (None, "0.5"), (1, "T3"): ("T", "0.5"), (2, "T1"): ("D", None),
                   (3, None): (None, None), (4, "T1"): ("D", None), (4, "T2"): ("D", None)}
    one = d.select("v", sc.for_transcript(F.col("a"), F.col("ids"), F.lit("T3")).alias("x")).collect()
    assert {r.v: r.x for r in one} == {1: "T", 2: None, 3: None, 4: None}


def test_splice_union_and_gene_terms(spark):
    schema = "chrom string, pos bigint, ref string, alt string, SpliceAI string"
    snv = spark.createDataFrame([("1", 5, "A", "C", "C|GX|0.1|0.2|0.0|0.0|1|2|3|4,C|GB|0.2|0.0|0.0|0.0|1|2|3|4,G|GZ|1|1|1|1|1|1|1|1")], schema)
    indel = spark.createDataFrame([("1", 9, "AT", "A", "A|GY|.|.|0.7|.|1|2|3|4"), ("1", 8, "AT", "A", "A|GY|.|.|.|.|1|2|3|4")], schema)
    got = {r.pos: (r.splice_gene, r.splice_delta) for r in sc.splice_scores(snv, indel).collect()}
    assert got == {5: ("GB", 0.2), 9: ("GY", 0.7)}
    terms = spark.createDataFrame([("A", "z"), ("A", "b"), ("A", "b"), ("B", None)], "SYMBOL string, go string")
    rows = sc.with_gene_terms(spark.createDataFrame([("A",), ("B",), (None,)], "SYMBOL string"), terms).collect()
    assert {r.SYMBOL: r.GO for r in rows} == {"A": "b&z", "B": None, None: None}
    assert len(sc.SCORE_COLUMNS) == len(set(sc.SCORE_COLUMNS)) == 44
