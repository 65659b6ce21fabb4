"""The fixture bindings of ``genoframe.fixtures`` written as DuckDB SQL CTEs.

``with_ctes(body, *names)`` prefixes a query with the CTEs it needs (and their
dependencies) so each oracle query is a single self-contained SQL string.
"""

from __future__ import annotations

_CHROM = ("CASE WHEN {k} % 25 < 22 THEN CAST({k} % 25 + 1 AS VARCHAR) "
          "WHEN {k} % 25 = 22 THEN 'X' WHEN {k} % 25 = 23 THEN 'Y' ELSE 'MT' END")
_BASE = "(['A','C','G','T'])[({i}) + 1]"


def _allele(k: str) -> str:
    return (f"{_CHROM.format(k=k)} AS chrom, "
            f"10000 + ({k} * 7919) % 1000000 AS pos, "
            f"{_BASE.format(i=f'{k} % 4')} AS ref, "
            f"{_BASE.format(i=f'({k} % 4 + 1 + ({k} // 4) % 3) % 4')} AS alt")


_POPS = ["afr", "ami", "amr", "asj", "eas", "fin", "mid", "nfe", "remaining", "sas"]

CTES: dict[str, tuple[list[str], str]] = {
    "variants": ([], f"""variants AS (
  SELECT p_partkey AS v, {_allele('p_partkey')}, p_brand AS gene,
         CAST(p_size AS DOUBLE) AS cadd,
         CASE p_type WHEN 'ECONOMY' THEN 'HIGH' WHEN 'LARGE' THEN 'MODERATE'
              WHEN 'MEDIUM' THEN 'MODERATE' WHEN 'PROMO' THEN 'LOW' WHEN 'SMALL' THEN 'LOW'
              WHEN 'STANDARD' THEN 'MODIFIER' END AS impact,
         CASE WHEN p_partkey % 9 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter
  FROM part)"""),
    "calls": ([], """calls AS (
  SELECT l_partkey AS v, o_custkey % 100 AS s,
         max(CASE WHEN l_quantity > 25 THEN 2 ELSE 1 END) AS dosage
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2)"""),
    "genotypes": (["calls"], """genotypes AS (
  SELECT v, s, CASE WHEN (v * 31 + s * 17) % 97 = 0 THEN NULL ELSE dosage END AS dosage
  FROM calls)"""),
    "rare_genotypes": (["calls"], """rare_genotypes AS (
  SELECT v, s, dosage FROM calls WHERE (v * 13 + s) % 41 = 0)"""),
    "cohort_calls": ([], """cohort_calls AS (
  SELECT l_partkey AS v, o_custkey AS s, max(CASE WHEN l_quantity > 25 THEN 2 ELSE 1 END) AS dosage
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""),
    "samples": ([], """samples AS (
  SELECT DISTINCT o_custkey % 100 AS s, printf('S%03d', o_custkey % 100) AS sample_id FROM orders)"""),
    "pheno": ([], """pheno AS (
  SELECT s, printf('S%03d', s) AS sample_id,
         CAST(CASE WHEN s % 10 = 0 THEN NULL ELSE 1 + s % 2 END AS INTEGER) AS status,
         CASE WHEN s % 3 = 0 THEN 'M' WHEN s % 3 = 1 THEN 'F' END AS sex,
         CASE WHEN s % 4 = 0 THEN 'CONTROL' WHEN s % 4 = 1 THEN 'ALS' WHEN s % 4 = 2 THEN 'MS' END AS pheno,
         (['ALS-S','ALS-B','ALS-R','PLS','PMA','PBP','FAS','FLS'])[s % 8 + 1] AS als_pheno,
         (['SP','NP','FP'])[s % 3 + 1] AS dfs_pc,
         (['FP','NP','SP'])[(s // 3) % 3 + 1] AS d50_pc,
         (['RR','SP','PP'])[(s // 5) % 3 + 1] AS ms_pheno,
         quant, c1, c2, c3, c4, c5, c6
  FROM (SELECT o_custkey % 100 AS s, avg(o_totalprice) AS quant, avg(o_orderkey) AS c1,
               min(o_totalprice) AS c2, max(o_totalprice) AS c3,
               avg(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))) AS c4,
               CAST(count(*) AS DOUBLE) AS c5,
               avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS c6
        FROM orders GROUP BY 1))"""),
    "visits": ([], "visits AS (\n  SELECT o_orderkey AS _row, o_custkey AS pid, CAST(o_orderdate AS DATE) AS day, "
               + ", ".join(f"CAST((o_orderkey // {j}) % 5 AS INTEGER) AS i{j}" for j in range(1, 14))
               + ",\n    CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE "
               + " + ".join(f"(o_orderkey // {j}) % 5" for j in range(1, 14) if j != 6)
               + " END AS INTEGER) AS total,\n    o_orderkey % 11 = 0 AS peg,\n"
               + "    CAST(CASE WHEN o_orderkey % 17 = 0 THEN (o_orderkey // 17) % 5 END AS INTEGER) AS kings_rec\n"
               + "  FROM orders)"),
    "patients": ([], """patients AS (
  SELECT pid, onset, CAST(onset + CAST(pid % 400 AS INTEGER) AS DATE) AS diagnosis,
         CAST(onset - CAST(9000 + 17 * (pid % 900) AS INTEGER) AS DATE) AS birth,
         CASE WHEN pid % 4 = 0 THEN CAST(d1 + CAST(pid % 300 AS INTEGER) AS DATE) END AS death
  FROM (SELECT o_custkey AS pid, CAST(min(CAST(o_orderdate AS DATE)) - 200 AS DATE) AS onset,
               max(CAST(o_orderdate AS DATE)) AS d1
        FROM orders GROUP BY 1))"""),
    "registry_text": ([], """registry_text AS (
  SELECT o_orderkey AS _row, o_custkey AS pid,
         CASE WHEN o_orderkey % 10 = 0 THEN 'NS/NC'
              WHEN o_orderkey % 10 = 1 THEN CAST(datediff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR)
              ELSE strftime(CAST(o_orderdate AS DATE), '%d-%m-%Y') END AS fecha_visita,
         CASE WHEN o_orderkey % 10 = 0 THEN 'NS/NC' ELSE CAST(o_totalprice AS VARCHAR) END AS peso,
         o_orderpriority AS prioridad
  FROM orders)"""),
    "episodes": ([], """episodes AS (
  SELECT event_id, user_id AS patient_id, CAST(ts AS DATE) AS date FROM events)"""),
    "ms_onsets": ([], """ms_onsets AS (
  SELECT DISTINCT user_id AS patient_id, CAST(DATE '2024-01-01' + CAST(user_id % 10 AS INTEGER) AS DATE) AS ms_onset
  FROM events)"""),
    "sites": ([], "sites AS (\n  SELECT " + _allele("p_partkey")
              + ",\n    'rs' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 5 = 0 THEN ',rs' || CAST(p_partkey + 1 AS VARCHAR) ELSE '' END AS \"ID\",\n"
              + "    'PASS' AS \"FILTER\", CAST(p_size * (p_partkey % 4) AS BIGINT) AS \"AC\", CAST(100 * (p_partkey % 7) AS BIGINT) AS \"AN\",\n    "
              + ",\n    ".join(f"CAST(p_size * ((p_partkey + {j}) % 4) AS BIGINT) AS \"AC_{pop}\", "
                             f"CAST(100 * ((p_partkey + {j}) % 7) AS BIGINT) AS \"AN_{pop}\""
                             for j, pop in enumerate(_POPS, start=1))
              + "\n  FROM part WHERE p_partkey % 3 <> 0)"),
    "clinvar": ([], "clinvar AS (\n  SELECT " + _allele("p_partkey") + """,
    'cv' || CAST(p_partkey AS VARCHAR) AS "ID",
    (['Pathogenic','Likely_pathogenic','Benign','Uncertain_significance','Pathogenic/Likely_pathogenic'])[p_partkey % 5 + 1] AS "CLNSIG",
    'disease_' || CAST(p_partkey % 13 AS VARCHAR) AS "CLNDN",
    CASE WHEN p_partkey % 4 = 1 THEN '.' ELSE 'rs' || CAST(p_partkey AS VARCHAR) END AS "RS"
  FROM part WHERE p_partkey % 2 = 1)"""),
    "intervals": ([], "intervals AS (\n  SELECT s_suppkey AS sv_key, " + _CHROM.format(k="s_suppkey") + """ AS chrom,
    10000 + (s_suppkey * 104729) % 1000000 AS start,
    10000 + (s_suppkey * 104729) % 1000000 + 1000 * (s_suppkey % 50) AS "end",
    s_name AS sv_name, s_acctbal AS sv_score
  FROM supplier)"""),
    "scores": (["variants"], """scores AS (
  SELECT chrom, pos, ref, alt,
    (['D','T'])[(v % 4) // 2 + 1] AS "SIFT4G_pred",
    (['D','P','B'])[v % 3 + 1] AS "Polyphen2_HVAR_pred",
    round(CAST(v % 97 AS DOUBLE) / 3.0, 3) AS "CADD_phred",
    'GO:' || printf('%07d', v % 1000) AS "GO"
  FROM variants WHERE v % 2 = 0)"""),
    "csq": (["variants"], """csq AS (
  SELECT v, chrom, pos, ref, alt,
    array_to_string(list_transform(range(0, CAST(v % 4 AS BIGINT) + 1), lambda j:
      'G' || CAST((v + j) % 50 AS VARCHAR) || '|' ||
      (['HIGH','MODERATE','LOW','MODIFIER'])[(v + j) % 4 + 1] || '|' ||
      CAST(((v + j) * 7) % 40 AS VARCHAR) || '|' ||
      (['D','P','B'])[(v + j) % 3 + 1] || '|' ||
      (['D','T'])[(v + j + 1) % 2 + 1] || '|' ||
      (['D','T'])[(v + j) % 2 + 1]), ',') AS csq
  FROM variants)"""),
    "results": ([], "results AS (\n  SELECT p_partkey AS v, " + _allele("p_partkey") + """, p_brand AS gene,
    CAST(p_size - 25 AS DOUBLE) / 10.0 AS beta,
    CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE CAST((p_partkey * 7919) % 9973 + 1 AS DOUBLE) / 9974.0 END AS p,
    """ + _CHROM.format(k="p_partkey") + """ || ':' || CAST(10000 + (p_partkey * 7919) % 1000000 AS VARCHAR) AS id
  FROM part)"""),
    "raw_ids": ([], """raw_ids AS (
  SELECT c_custkey,
    CASE WHEN (c_custkey // 4) % 2 = 0 THEN 'ELA-' ELSE 'EMADN' END || printf('%03d', c_custkey)
      || (['-ADN1','-ambBED','ADN2',''])[c_custkey % 4 + 1] AS raw_id,
    c_nationkey, c_mktsegment, c_acctbal
  FROM customer)"""),
    "curves": ([], """curves AS (
  SELECT c_custkey AS pid, CAST(t AS DOUBLE) AS t,
         48.0 / (1 + exp((t - (20 + c_custkey % 80)) / (2 + c_custkey % 7))) AS total
  FROM customer, generate_series(0, 60, 6) AS g(t))"""),
}


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the named CTEs (dependencies first, each once)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(CTES[n][1] for n in order) + "\n" + body
