"""Worst transcripts by consequence terms."""

from genoframe.operators import consequence as oq
from genoframe.operators.columns import split_csq


def test_terms_ties_and_gaps(spark):
    rows = [(1, "A|LOW|synonymous_variant,B|LOW|splice_region_variant&intron_variant"),     # equal IMPACT, terms decide
            (2, "A|HIGH|stop_gained,B|HIGH|stop_gained&splice_region_variant"),             # equal terms, the first stays
            (3, "A|LOW|made_up_variant,B|LOW|sequence_variant"),                            # unlisted ranks below the list
            (4, "A|LOW|,B|LOW|made_up_variant"),                                            # no term ranks last
            (5, "A|LOW|"), (6, None),
            (7, "A|LOW|intron_variant&&splice_donor_variant")]
    d = split_csq(spark.createDataFrame(rows, "v int, csq string"), ["SYMBOL", "IMPACT", "Consequence"])
    got = {r.v: (r.worst and r.worst.SYMBOL, r.worst_term, r.worst_rank) for r in oq.worst_by_term(d).collect()}
    n = len(oq.TERM_ORDER)
    assert got == {1: ("B", "splice_region_variant", 16), 2: ("A", "stop_gained", 4), 3: ("B", "sequence_variant", n),
                   4: ("B", "made_up_variant", n + 1), 5: ("A", None, n + 2), 6: (None, None, None), 7: ("A", "splice_donor_variant", 3)}


def test_per_gene_and_own_order(spark):
    rows = [(1, "A|LOW|x,B|LOW|y&x,A|LOW|y,|LOW|y")]
    d = split_csq(spark.createDataFrame(rows, "v int, csq string"), ["SYMBOL", "IMPACT", "Consequence"])
    got = {r.SYMBOL: r.worst_term for r in oq.worst_by_gene(d, order=["y", "x"]).collect()}
    assert got == {"A": "y", "B": "y", None: "y"}
    plan = oq.worst_by_gene(d)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
