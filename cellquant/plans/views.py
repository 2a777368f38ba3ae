"""Read tables derived from the given star schema, in SQL that Spark and DuckDB read alike.

A read's number is its line's part, order and line; one line is taken of those that share all three. ``translate(md5(x), hex
digits, bases)`` makes 32 bases of any key. A third of the reads are internal (no tag, no UMI); ``rid % 20`` picks how the
first index read is damaged, ``rid % 7`` how much of an adapter the second mate holds. Genes lie 197 bases a part apart, so a
contig grows with the parts and a base meets about as many genes at every scale; the reads of a part lie on its gene, and
share its UMI but for one place in line 4. Every eleventh part shares that of another part of its cells.

``records`` are alignments of mates: ``rid % 10`` leaves one mate out (3, 4), ``rid % 9 = 0`` has a second place (``rid % 36 = 9`` on a spike-in contig), ``rid % 23 =
0`` a supplementary record, ``rid % 29 = 0`` lies on a spike-in contig and ``rid % 31 = 0`` where no gene is.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from cellquant.storage import stored

TAG = "ATTGCGCAATG"


def _dna(x: str) -> str:
    return f"translate(md5({x}),'0123456789abcdef','ACGTACGTACGTACGT')"


def _key(prefix: str, column: str) -> str:
    return f"concat('{prefix}',cast({column} as varchar(20)))"


INDEX_PANEL = f"""
SELECT a.n_nationkey AS k7, b.n_nationkey AS k5, substr({_dna(_key("i7-", "a.n_nationkey"))},1,10) AS i7_index,
 substr({_dna(_key("i5-", "b.n_nationkey"))},1,10) AS i5_index
FROM nation a CROSS JOIN nation b WHERE a.n_nationkey < 12 AND b.n_nationkey < 8 AND (a.n_nationkey*8+b.n_nationkey) % 10 <> 0"""

_LINES = "SELECT l_orderkey, l_linenumber, l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey"
_RID = "l_partkey*100000000+l_orderkey*10+l_linenumber"
_UMI_PART = "l_partkey - CASE WHEN l_partkey % 11 = 0 THEN 40 ELSE 0 END"
ADAPTERS = ("CTGTCTCTTATACACATCT", "GATCGGAAGAGC")


def _qual(x: str, symbols: str) -> str:
    return f"translate(md5({x}),'0123456789abcdef','{symbols}')"


READS = f"""
SELECT *, substr(concat({_qual(_key("q-", "rid"), "#+05:?ABDEFGHIII")},{_qual(_key("p-", "rid"), "#+05:?ABDEFGHIII")}),1,cast(length(r1_seq) as integer)) AS r1_qual,
 substr(concat({_qual(_key("r-", "rid"), "+5?ABBDEEFGHIIII")},{_qual(_key("s-", "rid"), "+5?ABBDEEFGHIIII")},{_qual(_key("t-", "rid"), "+5?ABBDEEFGHIIII")}),1,cast(length(r2_seq) as integer)) AS r2_qual,
 substr({_qual(_key("u-", "rid"), "+5?ABBDEEFGHIIII")},1,10) AS i1_qual, substr({_qual(_key("v-", "rid"), "+5?ABBDEEFGHIIII")},1,10) AS i2_qual
FROM (SELECT rid, m, k7, k5, concat(cast(k7 as varchar(20)),'_',cast(k5 as varchar(20))) AS bc,
 CASE WHEN m < 14 THEN i7 WHEN m < 16 THEN concat(substr(i7,1,3),'A',substr(i7,5,6)) WHEN m = 16 THEN concat('CC',substr(i7,3,8))
      WHEN m = 17 THEN concat(substr(i7,2,9),'G') WHEN m = 18 THEN concat(substr(i7,1,5),'T',substr(i7,6,4)) ELSE concat(substr(i7,1,9),'N') END AS i1_seq,
 i5 AS i2_seq, rid % 3 <> 0 AS tagged,
 CASE WHEN rid % 3 = 0 THEN {_dna(_key("r1-", "rid"))} WHEN rid % 101 = 1 THEN concat('{TAG}', substr(umi,1,5)) ELSE concat('{TAG}', umi, 'GGG', {_dna(_key("r1-", "rid"))}) END AS r1_seq,
 CASE WHEN rid % 7 = 0 THEN concat(substr(r2,1,cast(12 + rid % 40 as integer)),'{ADAPTERS[0]}',substr(r2,1,9)) WHEN rid % 7 = 1 THEN concat(substr(r2,1,50),'{ADAPTERS[1][:9]}')
      WHEN rid % 7 = 2 THEN concat(substr(r2,1,cast(5 + rid % 50 as integer)),'CTGTCTCTAATACACATCT') ELSE r2 END AS r2_seq,
 CASE WHEN rid % 3 = 0 THEN '' ELSE umi END AS umi, concat('run:',cast(rid as varchar(20)),'/1 extra') AS read_id
FROM (SELECT {_RID} AS rid, (l_orderkey*10+l_linenumber) % 20 AS m, l_suppkey % 12 AS k7, l_partkey % 8 AS k5,
 substr({_dna(_key("i7-", "l_suppkey % 12"))},1,10) AS i7, substr({_dna(_key("i5-", "l_partkey % 8"))},1,10) AS i5,
 concat({_dna(_key("r2a-", _RID))},{_dna(_key("r2b-", _RID))}) AS r2,
 CASE WHEN l_linenumber = 4 THEN concat('A',substr({_dna(_key("u", _UMI_PART))},2,7)) ELSE substr({_dna(_key("u", _UMI_PART))},1,8) END AS umi
 FROM ({_LINES}) l) t) r"""

EXONS = """
SELECT concat('G',cast(p_partkey as varchar(20))) AS gene_id, concat('chr',cast(p_partkey % 5 as varchar(20))) AS chrom,
 CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, g + 1 + k*(200+p_size*10) AS start_pos, g + k*(200+p_size*10) + 100 + p_size AS end_pos
FROM (SELECT p_partkey, p_size, p_partkey * 197 AS g FROM part) p CROSS JOIN (SELECT n_nationkey AS k FROM nation WHERE n_nationkey < 3) n"""

_CIGAR = "CASE WHEN rid % 4 = 0 THEN '40M60N10M' WHEN rid % 4 = 1 THEN '5S45M' WHEN rid % 4 = 2 THEN '20M2D30M' ELSE '50M' END"
ALIGNMENTS = f"""
SELECT rid, chrom, 1 + h AS pos, {_CIGAR} AS cigar, rid % 3 <> 0 AS tagged, CASE WHEN rid % 2 = 0 THEN '-' ELSE '+' END AS frag_strand, rid % 9 = 0 AS is_multi
FROM (SELECT {_RID} AS rid, concat('chr',cast(l_partkey % 5 as varchar(20))) AS chrom, l_partkey*197 + l_linenumber*53 + l_orderkey % 97 AS h FROM ({_LINES}) l) t"""

SPIKES = "SELECT concat('ERCC',cast(n_nationkey as varchar(20))) AS contig, 900 + n_nationkey * 10 AS length FROM nation"

_PLACED = f"""SELECT rid, CASE WHEN rid % 29 = 0 THEN concat('ERCC',cast(l_suppkey % 25 as varchar(20))) WHEN rid % 31 = 0 THEN 'chrX' ELSE concat('chr',cast(l_partkey % 5 as varchar(20))) END AS chrom,
 CASE WHEN rid % 29 = 0 THEN 1 + rid % 500 ELSE 1 + l_partkey*197 + l_linenumber*53 + l_orderkey % 97 END AS pos FROM (SELECT {_RID} AS rid, l_partkey, l_suppkey, l_orderkey, l_linenumber FROM ({_LINES}) l) t"""
RECORDS = f"""
SELECT concat('run:',cast(rid as varchar(20))) AS qname, flag, chrom, pos, {_CIGAR} AS cigar, CASE WHEN rid % 9 = 0 THEN 2 ELSE 1 END AS nh, bc, umi AS ub
FROM (SELECT p.rid, p.chrom, p.pos, CASE WHEN p.rid % 2 = 0 THEN 81 ELSE 65 END AS flag FROM ({_PLACED}) p WHERE p.rid % 10 <> 4
 UNION ALL SELECT p.rid, p.chrom, p.pos + 150 AS pos, CASE WHEN p.rid % 2 = 0 THEN 129 ELSE 145 END AS flag FROM ({_PLACED}) p WHERE p.rid % 10 <> 3
 UNION ALL SELECT p.rid, CASE WHEN p.rid % 36 = 9 THEN concat('ERCC',cast(p.rid % 25 as varchar(20))) ELSE p.chrom END AS chrom, CASE WHEN p.rid % 36 = 9 THEN 1 + p.rid % 500 ELSE p.pos + 985 END AS pos, CASE WHEN p.rid % 2 = 0 THEN 337 ELSE 321 END AS flag FROM ({_PLACED}) p WHERE p.rid % 9 = 0
 UNION ALL SELECT p.rid, p.chrom, p.pos + 400 AS pos, 2113 AS flag FROM ({_PLACED}) p WHERE p.rid % 23 = 0) x
JOIN (SELECT rid AS rd, bc, umi FROM ({READS}) rr) r ON r.rd = x.rid"""

SQL = {"index_panel": INDEX_PANEL, "reads": READS, "exons": EXONS, "alignments": ALIGNMENTS, "spikes": SPIKES, "records": RECORDS}


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that reads are made of, stored, with the read's number."""
    rows = spark.sql(_LINES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    return stored(rows, "lines").selectExpr("*", f"{_RID} AS rid")


def view(spark: SparkSession, sf_dir: str, name: str, of: DataFrame | None = None) -> DataFrame:
    """One of the derived tables over the Parquet files in ``sf_dir``; of: the ``lines`` it is made of, in their order."""
    found = re.compile(r"\b(FROM|JOIN) (lineitem|nation|part|lines)\b")
    sql = SQL[name] if of is None else SQL[name].replace(f"({_LINES})", "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lines)")
    tables = {t: of if t == "lines" else spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in sorted({m[2] for m in found.finditer(sql)})}
    return spark.sql(found.sub(r"\1 {\2}", sql), **tables)
