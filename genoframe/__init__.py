"""genoframe: cohort-genomics analytics expressed as Spark DataFrame operators.

Sub-packages:
  sources    readers and writers (VCF text, TSV/CSV registries, partitioned Parquet)
  functions  Column -> Column scalar expressions (ids, dates, recodes, clinical scores,
             annotation post-ops)
  operators  DataFrame -> DataFrame operators (filters, joins, windows, aggregates,
             reshaping, site statistics, annotation, global ordered scans)
  plans      multi-stage analyses (QC chain, association tests, PCA, set tests,
             curve fits, figure tables, phenotype assembly)
  streaming  (no streaming operators: every step of the modelled workflow is batch)
"""

from genoframe.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
