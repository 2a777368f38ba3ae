"""Queries of the main engine over the derived read tables, each with its SQL equivalent."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellquant.functions import seq, trimming
from cellquant.operators import barcode, counts, filtering, fragments, intervals, mates, matrices, panel, qc, readqc, sampling, umi
from cellquant.plans.views import ADAPTERS, SQL, TAG, lines, view
from cellquant.sources import bam, readers
from cellquant.storage import clean_shuffles, in_slices, shared_dir, stored

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}
ADAPTER = "GATCGGAAGAGC"


def _query(sql: str | None = None, *, needs: str = "", ctes: str = "", recursive: bool = False) -> Callable[[Query], Query]:
    """Register a query; ``needs`` names derived tables and ``ctes`` further ones that its SQL reads."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            parts = [f"{n} AS ({SQL[n]})" for n in needs.split()] + ([ctes] if ctes else [])
            _ORACLE[f.__name__] = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {sql}" if parts else sql
        return f

    return add


# --- scalar functions over reads

_QUAL = "[greatest(ascii(c) - 33, 0) FOR c IN string_split(r1_qual, '')]"
_WIN = f"""q AS (SELECT rid, r1_seq, {_QUAL} AS q FROM reads),
g AS (SELECT rid, q, list_filter(generate_series(0, len(q) - 1), lambda i: q[i + 1] >= 25) AS good FROM q),
e AS (SELECT rid, q, coalesce(list_min(good), 0) AS s, coalesce(list_max(good) + 1, 0) AS e FROM g),
w AS (SELECT rid, s, e, list_min(list_filter(generate_series(s, e - 4), lambda i: list_sum(q[i + 1 : i + 4]) < 100)) AS bad FROM e)"""


@_query("SELECT rid, concat('run:', cast(rid as varchar)) AS qname FROM reads", needs="reads")
def qname_clean(spark, sf):
    return view(spark, sf, "reads").select("rid", seq.query_name(F.col("read_id")).alias("qname"))


@_query("SELECT rid, reverse(translate(i1_seq, 'ACGT', 'TGCA')) AS rc FROM reads", needs="reads")
def revcomp_seq(spark, sf):
    return view(spark, sf, "reads").select("rid", seq.reverse_complement(F.col("i1_seq")).alias("rc"))


@_query(f"SELECT rid, cast(len(list_filter({_QUAL}, lambda x: x < 25)) as integer) AS n_low FROM reads", needs="reads")
def low_quality_bases(spark, sf):
    return view(spark, sf, "reads").select("rid", seq.low_bases(F.col("r1_qual"), 25).alias("n_low"))


@_query(f"SELECT rid, hamming(substr(r1_seq, 1, 11), '{TAG}') <= 2 AS has_tag FROM reads", needs="reads")
def hamming_tag_split(spark, sf):
    return view(spark, sf, "reads").select("rid", seq.has_tag(F.col("r1_seq"), TAG, 2).alias("has_tag"))


@_query("SELECT rid, cast(s as integer) AS s, cast(coalesce(bad, e) as integer) AS e FROM w", needs="reads", ctes=_WIN)
def sliding_window_trim(spark, sf):
    w = trimming.window_span(F.col("r1_qual"), 25)
    return view(spark, sf, "reads").select("rid", w.alias("w")).select("rid", F.col("w.start").alias("s"), F.col("w.end").alias("e"))


@_query(
    f"""SELECT rid, cast(coalesce(list_min(list_filter(generate_series(0, length(r1_seq) - 5), lambda i:
    10 * list_sum([(substr(r1_seq, i + j, 1) <> substr('{ADAPTER}', j, 1))::int FOR j IN generate_series(1, least(12, length(r1_seq) - i))])
    <= least(12, length(r1_seq) - i))), length(r1_seq)) as integer) AS n FROM reads""",
    needs="reads",
)
def adapter_clip(spark, sf):
    return view(spark, sf, "reads").select("rid", seq.clip_adapter(F.col("r1_seq"), ADAPTER).alias("n"))


# --- demultiplexing

_SUBS = "SELECT DISTINCT code, concat(substr(code,1,p-1), b, substr(code,p+1)) AS w FROM {c}, (SELECT unnest(generate_series(1,10)) AS p), bases"
_SPHERE = f"""bases AS (SELECT unnest(['A','C','G','T']) AS b), c7 AS (SELECT DISTINCT i7_index AS code FROM index_panel), c5 AS (SELECT DISTINCT i5_index AS code FROM index_panel),
near AS (SELECT 7 AS k, * FROM ({_SUBS.format(c="c7")}) UNION SELECT 5, * FROM ({_SUBS.format(c="c5")})
 UNION SELECT k, code, concat(substr(code,1,p-1), substr(code,p+1), b) FROM (SELECT 7 AS k, code FROM c7 UNION ALL SELECT 5, code FROM c5), (SELECT unnest(generate_series(1,10)) AS p), bases
 UNION SELECT k, code, substr(concat(substr(code,1,p), b, substr(code,p+1)),1,10) FROM (SELECT 7 AS k, code FROM c7 UNION ALL SELECT 5, code FROM c5), (SELECT unnest(generate_series(0,10)) AS p), bases),
sphere AS (SELECT k, w, coalesce(max(CASE WHEN w = code THEN code END), CASE WHEN count(DISTINCT code) = 1 THEN min(code) END) AS code, bool_or(w = code) AS is_exact FROM near GROUP BY k, w)"""
_DEMUX = (
    _SPHERE
    + """, demux AS (SELECT r.*, s7.code AS i7_code, s5.code AS i5_code,
 CASE WHEN (s7.w IS NOT NULL AND s7.code IS NULL) OR (s5.w IS NOT NULL AND s5.code IS NULL) THEN 'dropped_ambiguous' WHEN s7.w IS NULL OR s5.w IS NULL THEN 'dropped_absent'
 WHEN p.i7_index IS NULL THEN 'dropped_uncorrectable' WHEN s7.is_exact AND s5.is_exact THEN 'exact' ELSE 'corrected' END AS outcome
 FROM reads r LEFT JOIN sphere s7 ON s7.k = 7 AND s7.w = r.i1_seq LEFT JOIN sphere s5 ON s5.k = 5 AND s5.w = r.i2_seq
 LEFT JOIN index_panel p ON p.i7_index = s7.code AND p.i5_index = s5.code)"""
)


def _demux(spark, sf):
    return barcode.demultiplex(view(spark, sf, "reads"), view(spark, sf, "index_panel"))


@_query("SELECT w AS \"window\", code, is_exact FROM sphere WHERE k = 7", needs="index_panel", ctes=_SPHERE)
def index_sphere(spark, sf):
    return barcode.index_sphere(view(spark, sf, "index_panel").select(F.col("i7_index").alias("code")).distinct(), 1)


@_query("SELECT rid, i7_code, i5_code, outcome FROM demux", needs="index_panel reads", ctes=_DEMUX)
def index_sphere_decode(spark, sf):
    return _demux(spark, sf).select("rid", "i7_code", "i5_code", "outcome")


@_query("SELECT outcome, count(*) AS n FROM demux GROUP BY outcome", needs="index_panel reads", ctes=_DEMUX)
def drop_reasons(spark, sf):
    return barcode.outcome_counts(_demux(spark, sf))


@_query(
    "SELECT concat(i7_code, i5_code) AS bc, count(*) FILTER (WHERE tagged) AS tagged, count(*) FILTER (WHERE NOT tagged) AS internal FROM demux WHERE outcome IN ('exact', 'corrected') GROUP BY 1",
    needs="index_panel reads", ctes=_DEMUX,
)
def per_barcode_counts(spark, sf):
    kept = _demux(spark, sf).where(F.col("outcome").isin("exact", "corrected"))
    return kept.groupBy(F.concat("i7_code", "i5_code").alias("bc")).agg(F.count_if("tagged").alias("tagged"), F.count_if(~F.col("tagged")).alias("internal"))


def _codes(spark, sf, column):
    return view(spark, sf, "index_panel").select(F.col(column).alias("code")).distinct()


@_query(
    """SELECT count(*) FILTER (WHERE f AND NOT r) AS forward, count(*) FILTER (WHERE r AND NOT f) AS reverse, count(*) FILTER (WHERE f AND r) AS both, count(*) FILTER (WHERE NOT f AND NOT r) AS neither
 FROM (SELECT i1_seq IN (SELECT i7_index FROM index_panel) AS f, reverse(translate(i1_seq,'ACGT','TGCA')) IN (SELECT i7_index FROM index_panel) AS r FROM reads ORDER BY rid LIMIT 50000)""",
    needs="index_panel reads",
)
def orientation_vote(spark, sf):
    return panel.orientation_votes(panel.first_windows(view(spark, sf, "reads"), "i1_seq", "rid"), "i1_seq", _codes(spark, sf, "i7_index"))


_DIST = """code AS (SELECT DISTINCT 'i7' AS k, i7_index AS c FROM index_panel UNION SELECT DISTINCT 'i5', i5_index FROM index_panel),
dist AS (SELECT a.k AS index, a.c AS a, b.c AS b, cast(least(list_min([levenshtein(substr(a.c, 1, i), b.c) FOR i IN generate_series(0, 10)]), list_min([levenshtein(a.c, substr(b.c, 1, i)) FOR i IN generate_series(0, 10)])) AS integer) AS d
 FROM code a JOIN code b ON a.k = b.k AND a.c < b.c)"""


@_query("SELECT * FROM dist", needs="index_panel", ctes=_DIST)
def panel_distances(spark, sf):
    i7, i5 = (panel.code_distances(_codes(spark, sf, f"{k}_index")).withColumn("index", F.lit(k)) for k in ("i7", "i5"))
    return i7.unionByName(i5)


@_query(
    "SELECT code.k AS index, count(DISTINCT c) AS codes, min(d) AS min_distance, cast(floor((min(d) - 1) / 2) as integer) AS safe_radius, (SELECT count(*) FROM dist x WHERE x.index = code.k AND d <= 4) AS collisions FROM code JOIN dist ON dist.index = code.k GROUP BY code.k",
    needs="index_panel", ctes=_DIST,
)
def panel_radius(spark, sf):
    i7, i5 = (panel.panel_report(_codes(spark, sf, f"{k}_index"), 2).withColumn("index", F.lit(k)) for k in ("i7", "i5"))
    return i7.unionByName(i5)


# --- the decision on each read

def _clip_sql(n: str, adapter: str) -> str:
    m = len(adapter)
    return f"""cast(coalesce(list_min(list_filter(generate_series(0, {n} - 5), lambda i:
    10 * list_sum([(substr(r2_seq, i + j, 1) <> substr('{adapter}', j, 1))::int FOR j IN generate_series(1, least({m}, {n} - i))]) <= least({m}, {n} - i))), {n}) as integer)"""


def _phred(column: str) -> str:
    return f"[greatest(ascii(c) - 33, 0) FOR c IN string_split({column}, '')]"


_TRIM = f"""t1 AS (SELECT *, {_clip_sql("length(r2_seq)", ADAPTERS[0])} AS n1 FROM reads), t2 AS (SELECT *, {_clip_sql("n1", ADAPTERS[1])} AS n2 FROM t1),
tq AS (SELECT rid, n2, {_phred("r2_qual")} AS q FROM t2), tg AS (SELECT rid, q, list_filter(generate_series(0, n2 - 1), lambda i: q[i + 1] >= 20) AS good FROM tq),
te AS (SELECT rid, q, coalesce(list_min(good), 0) AS s, coalesce(list_max(good) + 1, 0) AS e FROM tg),
tw AS (SELECT rid, s, e, list_min(list_filter(generate_series(s, e - 4), lambda i: list_sum(q[i + 1 : i + 4]) < 80)) AS bad FROM te),
trim AS (SELECT rid, cast(s as integer) AS s, cast(coalesce(bad, e) as integer) AS e FROM tw)"""


def _low_sql(text: str, phred: int) -> str:
    return f"len(list_filter({_phred(text)}, lambda x: x < {phred}))"


_DECIDED = f"""{_DEMUX}, {_TRIM}, flt AS (SELECT d.rid, d.i7_code || d.i5_code AS cell, d.outcome = 'corrected' AS corrected, has_tag, CASE WHEN has_tag THEN substr(r1_seq, 12, 8) ELSE '' END AS umi, concat('run:', cast(d.rid as varchar)) AS qname,
 length(substr(r1_seq, CASE WHEN has_tag THEN 23 ELSE 1 END)) AS n1, substr(r2_seq, s + 1, e - s) AS r2_cdna,
 CASE WHEN e - s < 20 THEN 'dropped_short_r2' WHEN d.outcome = 'dropped_ambiguous' THEN 'dropped_no_barcode_ambiguous' WHEN d.outcome = 'dropped_absent' THEN 'dropped_no_barcode_absent'
  WHEN d.outcome = 'dropped_uncorrectable' THEN 'dropped_no_barcode_uncorrectable' WHEN {_low_sql("concat(i1_qual, i2_qual)", 20)} > 3 THEN 'dropped_bc_quality'
  WHEN has_tag AND length(r1_seq) < 22 THEN 'dropped_short_r2' WHEN has_tag AND {_low_sql("substr(r1_qual, 12, 8)", 20)} > 3 THEN 'dropped_umi_quality' ELSE 'passed' END AS outcome,
 NOT (e - s < 20) AND d.outcome IN ('exact', 'corrected') AND NOT ({_low_sql("concat(i1_qual, i2_qual)", 20)} > 3) AS past
 FROM (SELECT *, length(r1_seq) >= 11 AND hamming(rpad(substr(r1_seq, 1, 11), 11, '-'), '{TAG}') <= 2 AS has_tag FROM demux) d JOIN trim USING (rid))"""
_STATS = """st AS (SELECT count(*) AS total, count(*) FILTER (WHERE outcome = 'passed') AS passed, count(*) FILTER (WHERE outcome = 'passed' AND has_tag) AS tagged, count(*) FILTER (WHERE outcome = 'passed' AND NOT has_tag) AS internal,
 count(*) FILTER (WHERE outcome = 'dropped_short_r2') AS dropped_short_r2, count(*) FILTER (WHERE outcome = 'dropped_no_barcode_absent') AS dropped_no_barcode_absent,
 count(*) FILTER (WHERE outcome = 'dropped_no_barcode_uncorrectable') AS dropped_no_barcode_uncorrectable, count(*) FILTER (WHERE outcome = 'dropped_no_barcode_ambiguous') AS dropped_no_barcode_ambiguous,
 count(*) FILTER (WHERE outcome = 'dropped_bc_quality') AS dropped_bc_quality, count(*) FILTER (WHERE outcome = 'dropped_umi_quality') AS dropped_umi_quality,
 count(*) FILTER (WHERE past AND NOT corrected) AS bc_exact, count(*) FILTER (WHERE past AND corrected) AS bc_corrected FROM flt)"""
_METRICS = ", ".join(filtering.METRICS)
_RANKED = f"rank AS (SELECT metric AS reason, n FROM st UNPIVOT (n FOR metric IN ({', '.join(m for m in filtering.METRICS if m.startswith('dropped'))})) WHERE n > 0)"


def _filtered(spark, sf):
    return filtering.filter_reads(view(spark, sf, "reads"), view(spark, sf, "index_panel"), filtering.ReadLayout(adapters=ADAPTERS))


@_query("SELECT * FROM trim", needs="reads", ctes=_TRIM)
def trim_second_mate(spark, sf):
    w = trimming.trim_span(F.col("r2_seq"), F.col("r2_qual"), ADAPTERS)
    return view(spark, sf, "reads").select("rid", w.alias("w")).select("rid", F.col("w.start").alias("s"), F.col("w.end").alias("e"))


@_query("SELECT rid, qname, cell, corrected, has_tag, umi, n1, r2_cdna, outcome FROM flt", needs="index_panel reads", ctes=_DECIDED)
def filter_decisions(spark, sf):
    return _filtered(spark, sf).select("rid", "qname", "cell", "corrected", "has_tag", "umi", F.length("r1_cdna").cast("long").alias("n1"), "r2_cdna", "outcome")


@_query(
    f"SELECT metric, cast(n as varchar) AS value FROM st UNPIVOT (n FOR metric IN ({_METRICS})) UNION ALL SELECT 'i7_orient', 'Forward' UNION ALL SELECT 'i5_orient', 'Forward' UNION ALL SELECT 'passed_pct', printf('%.4f', 100.0 * passed / total) FROM st",
    needs="index_panel reads", ctes=f"{_DECIDED}, {_STATS}",
)
def filter_stats(spark, sf):
    return filtering.filter_statistics(filtering.filter_counts(_filtered(spark, sf))).drop("place")


@_query("SELECT cast(row_number() OVER (ORDER BY n DESC, reason) as integer) AS place, reason, n FROM rank", needs="index_panel reads", ctes=f"{_DECIDED}, {_STATS}, {_RANKED}")
def drop_ranking(spark, sf):
    return filtering.drop_ranking(filtering.filter_counts(_filtered(spark, sf)))


@_query(
    """SELECT category, cast(level as integer) AS level, n, round(100.0 * n / total, 6) AS pct_total, round(100.0 * n / of, 6) AS pct_parent FROM (
 SELECT 'total' AS category, 0 AS level, total AS n, total, NULL AS of FROM st UNION ALL SELECT 'passed', 1, passed, total, total FROM st UNION ALL SELECT 'tagged', 2, tagged, total, passed FROM st
 UNION ALL SELECT 'internal', 2, internal, total, passed FROM st UNION ALL SELECT 'dropped', 1, total - passed, total, total FROM st UNION ALL SELECT reason, 2, n, total, total - passed FROM rank, st)""",
    needs="index_panel reads", ctes=f"{_DECIDED}, {_STATS}, {_RANKED}",
)
def read_categories(spark, sf):
    found = filtering.read_table(filtering.filter_counts(_filtered(spark, sf)))
    return found.withColumns({c: F.round(c, 6) for c in ("pct_total", "pct_parent")})


@_query("SELECT cell, count(*) FILTER (WHERE has_tag) AS tagged, count(*) FILTER (WHERE NOT has_tag) AS internal, count(*) AS total FROM flt WHERE outcome = 'passed' GROUP BY cell", needs="index_panel reads", ctes=_DECIDED)
def filter_per_cell(spark, sf):
    return filtering.per_cell_totals(_filtered(spark, sf))


@_query("SELECT qname, r2_cdna FROM (SELECT qname, r2_cdna, md5(concat('s1', qname)) AS h FROM flt WHERE outcome = 'passed' ORDER BY h, qname LIMIT 1000)", needs="index_panel reads", ctes=_DECIDED)
def qc_read_sample(spark, sf):
    """The sample of reads that the quality report looks at, of a stated size by its nature. Only reads whose turn it is are filtered."""
    panel_, layout = view(spark, sf, "index_panel"), filtering.ReadLayout(adapters=ADAPTERS)

    def passing(reads):
        return filtering.filter_reads(reads, panel_, layout).where("outcome = 'passed'").select("qname", "r2_cdna")

    return sampling.sample_passing(view(spark, sf, "reads").withColumn("qname", seq.query_name(F.col("read_id"))), 1000, "qname", passing)


# --- annotation

_MERGED = """o AS (SELECT *, CASE WHEN start_pos <= max(end_pos) OVER (PARTITION BY gene_id ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS n FROM exons),
i AS (SELECT *, sum(n) OVER (PARTITION BY gene_id ORDER BY start_pos, end_pos ROWS UNBOUNDED PRECEDING) AS k FROM o),
merged AS (SELECT gene_id, chrom, strand, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM i GROUP BY gene_id, chrom, strand, k)"""
_UNION = """uo AS (SELECT *, CASE WHEN start_pos <= max(end_pos) OVER (PARTITION BY chrom ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS n FROM exons),
ui AS (SELECT *, sum(n) OVER (PARTITION BY chrom ORDER BY start_pos, end_pos ROWS UNBOUNDED PRECEDING) AS k FROM uo),
u AS (SELECT chrom, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM ui GROUP BY chrom, k),
gap AS (SELECT * FROM (SELECT chrom, end_pos + 1 AS start_pos, lead(start_pos) OVER (PARTITION BY chrom ORDER BY start_pos) - 1 AS end_pos FROM u) WHERE end_pos >= start_pos)"""
_SINGLE = """span AS (SELECT chrom, gene_id, min(start_pos) AS s, max(end_pos) AS e FROM exons GROUP BY chrom, gene_id),
ev AS (SELECT chrom, s AS p, 1 AS d, cast(substr(gene_id, 2) as bigint) AS g FROM span UNION ALL SELECT chrom, e + 1, -1, -cast(substr(gene_id, 2) as bigint) FROM span),
evs AS (SELECT chrom, p, sum(d) AS d, sum(g) AS g FROM ev GROUP BY chrom, p),
sw AS (SELECT chrom, p AS start_pos, lead(p) OVER (PARTITION BY chrom ORDER BY p) - 1 AS end_pos, sum(d) OVER (PARTITION BY chrom ORDER BY p) AS depth, sum(g) OVER (PARTITION BY chrom ORDER BY p) AS g FROM evs),
one AS (SELECT *, CASE WHEN start_pos <= lag(end_pos) OVER (PARTITION BY chrom, g ORDER BY start_pos) + 1 THEN 0 ELSE 1 END AS n FROM sw WHERE depth = 1),
ones AS (SELECT *, sum(n) OVER (PARTITION BY chrom, g ORDER BY start_pos ROWS UNBOUNDED PRECEDING) AS k FROM one),
single AS (SELECT chrom, concat('G', cast(g as varchar)) AS gene_id, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM ones GROUP BY chrom, g, k)"""
_INTRONS = (
    _UNION + ", " + _SINGLE
    + ", introns AS (SELECT gap.chrom, gene_id, gap.start_pos, gap.end_pos FROM gap JOIN single s ON s.chrom = gap.chrom AND gap.start_pos >= s.start_pos AND gap.end_pos <= s.end_pos WHERE gap.end_pos - gap.start_pos + 1 > 10 AND gap.end_pos - gap.start_pos + 1 < 100000)"
)


def _merged(spark, sf):
    return intervals.merge(view(spark, sf, "exons"), "gene_id", "chrom", "strand")


def _introns(spark, sf):
    exons = view(spark, sf, "exons")
    return intervals.introns(exons).join(exons.select("gene_id", "strand").distinct(), "gene_id")


@_query("SELECT * FROM merged", needs="exons", ctes=_MERGED)
def merge_exons(spark, sf):
    return _merged(spark, sf)


@_query("SELECT gene_id, cast(sum(end_pos - start_pos + 1) as bigint) AS length FROM merged GROUP BY gene_id", needs="exons", ctes=_MERGED)
def gene_length(spark, sf):
    return _merged(spark, sf).groupBy("gene_id").agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("length"))


@_query("SELECT * FROM gap", needs="exons", ctes=_UNION)
def intergenic_gaps(spark, sf):
    return intervals.gaps(intervals.merge_contigs(view(spark, sf, "exons")))


@_query("SELECT * FROM single", needs="exons", ctes=_SINGLE)
def single_gene_regions(spark, sf):
    return intervals.single_gene_regions(view(spark, sf, "exons").groupBy("chrom", "gene_id").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")))


@_query("SELECT * FROM introns", needs="exons", ctes=_INTRONS)
def introns(spark, sf):
    return _introns(spark, sf).drop("strand")


# --- fragments

_BLOCKS = """block AS (SELECT rid, chrom, pos AS s, pos + CASE rid % 4 WHEN 0 THEN 39 WHEN 1 THEN 44 WHEN 2 THEN 19 ELSE 49 END AS e FROM alignments
 UNION ALL SELECT rid, chrom, pos + CASE rid % 4 WHEN 0 THEN 100 ELSE 22 END, pos + CASE rid % 4 WHEN 0 THEN 109 ELSE 51 END FROM alignments WHERE rid % 4 IN (0, 2)),
mapped AS (SELECT rid, cast(sum(e - s + 1) as bigint) AS mapped FROM block GROUP BY rid)"""
_OV = "SELECT rid, x.gene_id, x.strand, cast(sum(least(e, x.end_pos) - greatest(s, x.start_pos) + 1) as bigint) AS olen FROM block b JOIN {t} x ON x.chrom = b.chrom AND b.s <= x.end_pos AND x.start_pos <= b.e GROUP BY rid, x.gene_id, x.strand"
_RESOLVE = """SELECT rid, CASE WHEN is_multi OR count(*) = 1 THEN list(gene_id ORDER BY gene_id) END AS genes, NOT is_multi AND count(*) > 1 AS tie FROM (
 SELECT a.rid, a.is_multi, o.gene_id, o.olen, max(o.olen) OVER (PARTITION BY a.rid) AS best FROM {fr} a JOIN mapped USING (rid) JOIN ({ov}) o USING (rid)
 WHERE (NOT a.tagged OR o.strand = a.frag_strand) AND (a.is_multi OR o.olen / mapped >= 0.25)) WHERE is_multi OR olen = best GROUP BY rid, is_multi"""
_ASSIGNED = (
    f"{_BLOCKS}, {_MERGED}, {_INTRONS}, ix AS (SELECT n.*, g.strand FROM introns n JOIN (SELECT DISTINCT gene_id, strand FROM exons) g USING (gene_id)), "
    f"ge AS ({_RESOLVE.format(fr='alignments', ov=_OV.format(t='merged'))}), gi AS ({_RESOLVE.format(fr='alignments', ov=_OV.format(t='ix'))}), "
    "assigned AS (SELECT a.rid, r.bc, r.umi, a.tagged, NOT a.is_multi AS is_uniq, ge.genes AS ge, gi.genes AS gi, "
    "CASE WHEN ge.genes IS NOT NULL THEN 'Exon' WHEN ge.tie THEN 'Ambiguity' WHEN gi.genes IS NOT NULL THEN 'Intron' WHEN gi.tie THEN 'Ambiguity' ELSE 'Intergenic' END AS category "
    "FROM alignments a JOIN reads r USING (rid) LEFT JOIN ge USING (rid) LEFT JOIN gi USING (rid)), "
    "layer AS (SELECT *, 'exon' AS layer, ge AS genes FROM assigned WHERE ge IS NOT NULL UNION ALL SELECT *, 'intron', gi FROM assigned WHERE ge IS NULL AND gi IS NOT NULL "
    "UNION ALL SELECT *, 'inex', coalesce(ge, gi) FROM assigned WHERE coalesce(ge, gi) IS NOT NULL)"
)
_ALL = "alignments exons reads"


def _blocks(spark, sf):
    return fragments.blocks(view(spark, sf, "alignments"))


def _assigned(spark, sf):
    rows = view(spark, sf, "alignments")
    frags = rows.select("rid", "tagged", "frag_strand", "is_multi", seq.aligned_bases(F.col("pos"), F.col("cigar")).alias("mapped"))
    reads = view(spark, sf, "reads").select("rid", "bc", "umi")
    exons, introns_ = stored(_merged(spark, sf), "merged-exons"), stored(_introns(spark, sf), "introns")
    found = fragments.assign_once(frags, fragments.blocks(rows), exons, introns_, fraction=0.25)
    return stored(found.withColumn("is_uniq", ~F.col("is_multi")).join(reads, "rid"), "assigned")


def _layers(spark, sf):
    return fragments.layers(_assigned(spark, sf))


@_query("SELECT rid, chrom, s AS start_pos, e AS end_pos FROM block", needs="alignments", ctes=_BLOCKS)
def cigar_blocks(spark, sf):
    return _blocks(spark, sf)


@_query(_OV.format(t="merged"), needs="alignments exons", ctes=f"{_BLOCKS}, {_MERGED}")
def overlap_len_per_gene(spark, sf):
    return fragments.gene_overlaps(_blocks(spark, sf), _merged(spark, sf))


@_query("SELECT rid, array_to_string(genes, ',') AS genes, tie AS ambiguous FROM ge", needs=_ALL, ctes=_ASSIGNED)
def largest_overlap_gene(spark, sf):
    rows = _blocks(spark, sf)
    frags = view(spark, sf, "alignments").select("rid", "tagged", "frag_strand", "is_multi").join(fragments.mapped_length(rows), "rid")
    return fragments.resolve(frags, fragments.gene_overlaps(rows, _merged(spark, sf)), fraction=0.25).select("rid", F.array_join("genes", ",").alias("genes"), "ambiguous")


@_query("SELECT rid, bc, category FROM assigned", needs=_ALL, ctes=_ASSIGNED)
def fragment_taxonomy(spark, sf):
    return _assigned(spark, sf).select("rid", "bc", "category")


_CELLS = "SELECT bc, count(*) FILTER (WHERE category = 'Exon') AS exon, count(*) FILTER (WHERE category = 'Intron') AS intron, count(*) FILTER (WHERE category = 'Ambiguity') AS ambiguity, count(*) FILTER (WHERE category = 'Intergenic') AS intergenic, count(*) FILTER (WHERE category = 'User') AS user, count(*) AS mapped FROM assigned GROUP BY bc"


@_query(_CELLS, needs=_ALL, ctes=_ASSIGNED)
def cell_taxonomy(spark, sf):
    return fragments.category_counts(_assigned(spark, sf))


_BAD = """SELECT cell, type, n FROM (SELECT CASE WHEN t.total >= 70 THEN t.bc ELSE 'bad' END AS cell, cast(sum(exon) as bigint) AS exon, cast(sum(intron) as bigint) AS intron, cast(sum(ambiguity) as bigint) AS ambiguity,
 cast(sum(intergenic) as bigint) AS intergenic, cast(sum(greatest(t.total - mapped, 0)) as bigint) AS unmapped, cast(sum(c.user) as bigint) AS user FROM tot t JOIN cells c USING (bc) GROUP BY 1) UNPIVOT (n FOR type IN (exon, intron, ambiguity, intergenic, unmapped, user))"""


@_query(
    _BAD,
    needs=_ALL, ctes=f"{_ASSIGNED}, cells AS ({_CELLS}), tot AS (SELECT bc, count(*) + 3 AS total FROM reads GROUP BY bc)",
)
def readspercell_bad_rollup(spark, sf):
    totals = view(spark, sf, "reads").groupBy("bc").agg((F.count(F.lit(1)) + 3).alias("total"))
    return qc.reads_per_cell(cell_taxonomy(spark, sf), totals, 70)


# --- counts

_ONE = "SELECT bc, layer, genes[1] AS gene, count(*) AS value FROM layer WHERE len(genes) = 1 GROUP BY bc, layer, genes[1]"


@_query(_ONE, needs=_ALL, ctes=_ASSIGNED)
def readcount_layers(spark, sf):
    return umi.single_gene_counts(_layers(spark, sf), "bc", "layer")


@_query(
    "SELECT bc, gene, round(value / (sum(value) OVER (PARTITION BY bc) * 1e-6) / (length / 1000.0), 6) AS value FROM onegene JOIN len USING (gene)",
    needs=_ALL, ctes=f"{_ASSIGNED}, onegene AS ({_ONE.replace('WHERE len', "WHERE layer = 'exon' AND NOT tagged AND len")}), len AS (SELECT gene_id AS gene, sum(end_pos - start_pos + 1) AS length FROM merged GROUP BY gene_id)",
)
def rpkm_internal(spark, sf):
    internal = umi.single_gene_counts(_layers(spark, sf).where("layer = 'exon' AND NOT tagged"), "bc")
    lengths = gene_length(spark, sf).withColumnRenamed("gene_id", "gene")
    return matrices.rpkm(internal, lengths).select("bc", "gene", F.round("value", 6).alias("value"))


_UMI = """acc AS (SELECT bc, layer, umi, count(*) AS n, count(*) FILTER (WHERE is_uniq) AS nu FROM layer WHERE tagged GROUP BY bc, layer, umi),
held AS (SELECT bc, layer, umi, g, count(*) FILTER (WHERE is_uniq) AS u, count(*) FILTER (WHERE NOT is_uniq) AS m FROM (SELECT bc, layer, umi, is_uniq, unnest(genes) AS g FROM layer WHERE tagged) GROUP BY bc, layer, umi, g),
sets AS (SELECT a.bc, a.layer, a.umi, a.n, CASE WHEN nu > 0 THEN coalesce(list(g ORDER BY g) FILTER (WHERE u = nu), []) END AS uniq, CASE WHEN n > nu THEN coalesce(list(g ORDER BY g) FILTER (WHERE m = n - nu), []) END AS multi
 FROM acc a JOIN held h ON a.bc = h.bc AND a.layer = h.layer AND a.umi = h.umi GROUP BY a.bc, a.layer, a.umi, a.n, nu)"""
_NET = """rk AS (SELECT *, row_number() OVER (PARTITION BY bc, layer ORDER BY n DESC, umi) AS r FROM sets),
edges AS (SELECT a.bc, a.layer, a.r AS src, b.r AS dst FROM rk a JOIN rk b ON a.bc = b.bc AND a.layer = b.layer AND a.r <> b.r AND hamming(a.umi, b.umi) = 1 AND a.n >= 2 * b.n - 1),
reach AS (SELECT bc, layer, r AS anc, r AS node FROM rk UNION SELECT x.bc, x.layer, x.anc, e.dst FROM reach x JOIN edges e ON x.bc = e.bc AND x.layer = e.layer AND x.node = e.src),
lab AS (SELECT bc, layer, node, min(anc) AS seed FROM reach GROUP BY bc, layer, node),
net AS (SELECT rk.*, s.umi AS seed FROM rk JOIN lab ON rk.bc = lab.bc AND rk.layer = lab.layer AND rk.r = lab.node JOIN rk s ON s.bc = lab.bc AND s.layer = lab.layer AND s.r = lab.seed),
side AS (SELECT bc, layer, seed, count(*) FILTER (WHERE uniq IS NOT NULL) AS nu, count(*) FILTER (WHERE multi IS NOT NULL) AS nm FROM net GROUP BY bc, layer, seed),
evd AS (SELECT bc, layer, seed, 1 AS u, unnest(uniq) AS g FROM net UNION ALL SELECT bc, layer, seed, 0, unnest(multi) FROM net),
com AS (SELECT s.bc, s.layer, s.seed, e.g FROM side s JOIN evd e ON e.bc = s.bc AND e.layer = s.layer AND e.seed = s.seed AND e.u = (CASE WHEN nu > 0 THEN 1 ELSE 0 END) GROUP BY s.bc, s.layer, s.seed, e.g, nu, nm HAVING count(*) = CASE WHEN nu > 0 THEN nu ELSE nm END),
mol AS (SELECT bc, layer, seed, list(g ORDER BY g) AS genes FROM com GROUP BY bc, layer, seed)"""


def _accumulated(spark, sf):
    return umi.accumulate(_layers(spark, sf).where("tagged"))


@_query("SELECT bc, layer, umi, n, array_to_string(uniq, ',') AS uniq, array_to_string(multi, ',') AS multi FROM sets", needs=_ALL, ctes=f"{_ASSIGNED}, {_UMI}")
def umi_accumulate(spark, sf):
    return _accumulated(spark, sf).select("bc", "layer", "umi", "n", F.array_join("uniq", ",").alias("uniq"), F.array_join("multi", ",").alias("multi"))


@_query(
    "SELECT bc, layer, umi, seed FROM net".replace("net", "nets"), needs="reads", recursive=True,
    ctes="sets AS (SELECT bc, 'all' AS layer, umi, count(*) AS n FROM reads WHERE tagged GROUP BY bc, umi), " + _NET.split("side AS")[0].rstrip().rstrip(",").replace("net AS", "nets AS"),
)
def umi_networks(spark, sf):
    counts = view(spark, sf, "reads").where("tagged").groupBy("bc", "umi").agg(F.count(F.lit(1)).alias("n"))
    return umi.networks(counts, "bc").select("bc", F.lit("all").alias("layer"), "umi", "seed")


@_query("SELECT bc, layer, genes[1] AS gene, count(*) AS value FROM mol WHERE len(genes) = 1 GROUP BY bc, layer, genes[1]", needs=_ALL, ctes=f"{_ASSIGNED}, {_UMI}, {_NET}", recursive=True)
def umi_counts(spark, sf):
    return umi.single_gene_counts(umi.molecules(_accumulated(spark, sf)), "bc", "layer")


_SETS = """cs AS (SELECT bc, genes, cast(count(*) as double) AS c FROM layer WHERE layer = 'inex' AND NOT tagged GROUP BY bc, genes),
x AS (SELECT bc, genes, c, len(genes) AS k, unnest(genes) AS gene FROM cs),
wt AS (SELECT bc, gene, sum(CASE WHEN k = 1 THEN c ELSE 0 END) AS geu, sum(CASE WHEN k > 1 THEN c / k ELSE 0 END) AS guni FROM x GROUP BY bc, gene)"""
_SHARE = "SELECT bc, gene, round(sum(CASE WHEN t > 0 THEN c * w / t ELSE c / k END), 6) AS value FROM (SELECT *, sum(w) OVER (PARTITION BY bc, genes) AS t FROM (SELECT x.bc, x.genes, x.c, x.k, x.gene, {w} AS w FROM x JOIN wt ON x.bc = wt.bc AND x.gene = wt.gene WHERE k > 1)) GROUP BY bc, gene HAVING sum(CASE WHEN t > 0 THEN c * w / t ELSE c / k END) > 0"


def _gene_sets(spark, sf):
    return matrices.set_counts(_layers(spark, sf).where("layer = 'inex' AND NOT tagged"), "bc")


def _rounded(df):
    return df.select("bc", "gene", F.round("value", 6).alias("value"))


@_query(_SHARE.format(w="0"), needs=_ALL, ctes=f"{_ASSIGNED}, {_SETS}")
def multimap_uniform(spark, sf):
    return _rounded(matrices.share_uniform(_gene_sets(spark, sf)))


@_query(_SHARE.format(w="geu"), needs=_ALL, ctes=f"{_ASSIGNED}, {_SETS}")
def multimap_propunique(spark, sf):
    return _rounded(matrices.share_prop_unique(_gene_sets(spark, sf)))


@_query(_SHARE.format(w="geu + guni"), needs=_ALL, ctes=f"{_ASSIGNED}, {_SETS}")
def multimap_rescue(spark, sf):
    return _rounded(matrices.share_rescue(_gene_sets(spark, sf)))


_EM = """mx AS (SELECT * FROM x WHERE k > 1),
em AS (
 SELECT bc, gene, geu, geu + guni AS theta, 0 AS it, 1e9 AS moved FROM wt WHERE guni > 0
 UNION ALL
 SELECT bc, gene, geu, nxt, it + 1, max(abs(nxt - theta)) OVER (PARTITION BY bc) FROM (
  SELECT bc, gene, geu, theta, it, CASE WHEN geu + sum(share) >= 0.01 THEN geu + sum(share) ELSE 0 END AS nxt FROM (
   SELECT bc, gene, geu, theta, it, CASE WHEN z > 0 THEN c * theta / z ELSE c / k END AS share FROM (
    SELECT mx.*, em.geu, em.theta, em.it, sum(em.theta) OVER (PARTITION BY mx.bc, mx.genes) AS z FROM em JOIN mx ON mx.bc = em.bc AND mx.gene = em.gene WHERE em.moved >= 0.01 AND em.it < 100))
  GROUP BY bc, gene, geu, theta, it))"""


@_query("SELECT bc, gene, round(max_by(theta, it) - any_value(geu), 4) AS value FROM em GROUP BY bc, gene HAVING max_by(theta, it) - any_value(geu) > 0", needs=_ALL, ctes=f"{_ASSIGNED}, {_SETS}, {_EM}", recursive=True)
def multimap_em(spark, sf):
    return matrices.share_em(_gene_sets(spark, sf)).withColumn("value", F.round("value", 4))


@_query("SELECT bc, gene, round(max_by(theta, it) - any_value(geu), 4) AS value FROM em GROUP BY bc, gene HAVING max_by(theta, it) - any_value(geu) > 0", needs=_ALL, ctes=f"{_ASSIGNED}, {_SETS}, {_EM}", recursive=True)
def multimap_em_by_rounds(spark, sf):
    return matrices.em_by_rounds(_gene_sets(spark, sf)).withColumn("value", F.round("value", 4))


@_query(
    "SELECT rid, bc FROM (SELECT rid, bc, count(*) OVER (PARTITION BY bc) AS have, row_number() OVER (PARTITION BY bc ORDER BY md5(concat('s42', cast(rid as varchar))), rid) AS turn FROM reads) WHERE have >= 60 AND turn <= 60",
    needs="reads",
)
def downsample_cells(spark, sf):
    return matrices.downsample(view(spark, sf, "reads").select("rid", "bc"), 60)


# --- quality control

_BODY = """pl AS (SELECT *, coalesce(sum(end_pos - start_pos + 1) OVER (PARTITION BY gene_id ORDER BY start_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(end_pos - start_pos + 1) OVER (PARTITION BY gene_id) AS length FROM merged),
hit AS (SELECT gene_id, strand, length, before + greatest(s, start_pos) - start_pos AS lo, before + least(e, end_pos) - start_pos AS hi FROM block b JOIN pl ON pl.chrom = b.chrom AND b.s <= pl.end_pos AND pl.start_pos <= b.e),
base AS (SELECT gene_id, length, strand, unnest(generate_series(cast(lo as bigint), cast(hi as bigint))) AS p FROM hit),
body AS (SELECT gene_id, cast(CASE WHEN strand = '+' THEN p ELSE length - 1 - p END * 100 // length as bigint) AS percentile, count(*) AS n FROM base GROUP BY 1, 2)"""


@_query("SELECT * FROM body", needs="alignments exons", ctes=f"{_BLOCKS}, {_MERGED}, {_BODY}")
def genebody_coverage(spark, sf):
    return qc.gene_body(_blocks(spark, sf), _merged(spark, sf))


@_query(
    "SELECT percentile, round(sum(share) / (SELECT count(DISTINCT gene_id) FROM body), 6) AS coverage FROM (SELECT percentile, n / max(n) OVER (PARTITION BY gene_id) AS share FROM body) GROUP BY percentile",
    needs="alignments exons", ctes=f"{_BLOCKS}, {_MERGED}, {_BODY}",
)
def coverage_mean_profile(spark, sf):
    return qc.mean_profile(genebody_coverage(spark, sf)).select("percentile", F.round("coverage", 6).alias("coverage"))


@_query("SELECT length(r1_seq) AS length, count(*) AS n FROM reads GROUP BY 1 ORDER BY n DESC, length LIMIT 1", needs="reads")
def mode_read_length(spark, sf):
    r = qc.mode_length(view(spark, sf, "reads"), "r1_seq")
    return r.select(F.col("length").cast("long").alias("length"), "n")


@_query(
    "SELECT bc, layer, count(*) AS genes, cast(sum(value) as bigint) AS reads FROM onegene GROUP BY bc, layer", needs=_ALL, ctes=f"{_ASSIGNED}, onegene AS ({_ONE})"
)
def qc_genes_per_cell(spark, sf):
    return readcount_layers(spark, sf).groupBy("bc", "layer").agg(F.count(F.lit(1)).alias("genes"), F.sum("value").alias("reads"))


@_query("SELECT round_even(median(exon), 0) AS exon, round_even(median(mapped), 0) AS mapped FROM cells", needs=_ALL, ctes=f"{_ASSIGNED}, cells AS ({_CELLS})")
def qc_medians(spark, sf):
    return qc.medians(cell_taxonomy(spark, sf), "exon", "mapped")


_SPAN = """spl AS (SELECT *, coalesce(sum(end_pos - start_pos + 1) OVER (PARTITION BY gene_id ORDER BY start_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - start_pos AS before FROM merged),
tspan AS (SELECT rid, gene_id, min(before + greatest(s, start_pos)) AS lo, max(before + least(e, end_pos)) AS hi FROM block b JOIN spl ON spl.chrom = b.chrom AND b.s <= spl.end_pos AND spl.start_pos <= b.e GROUP BY rid, gene_id),
sizes AS (SELECT tagged, cast(hi - lo + 1 as bigint) AS size, count(*) AS n FROM assigned a JOIN tspan ON tspan.rid = a.rid AND tspan.gene_id = a.ge[1] WHERE is_uniq AND len(ge) = 1 GROUP BY 1, 2)"""


@_query("SELECT rid, gene_id, cast(lo as bigint) AS lo, cast(hi as bigint) AS hi FROM tspan", needs=_ALL, ctes=f"{_ASSIGNED}, {_SPAN}")
def transcript_spans(spark, sf):
    return qc.transcript_spans(_blocks(spark, sf), _merged(spark, sf))


@_query("SELECT * FROM sizes", needs=_ALL, ctes=f"{_ASSIGNED}, {_SPAN}")
def insert_size_hist(spark, sf):
    return qc.insert_sizes(_assigned(spark, sf), transcript_spans(spark, sf))


@_query("SELECT tagged, size, n, round(100 * n / sum(n) OVER (PARTITION BY tagged), 6) AS percent FROM sizes WHERE size BETWEEN 40 AND 10000", needs=_ALL, ctes=f"{_ASSIGNED}, {_SPAN}")
def insert_size_fraction(spark, sf):
    return qc.insert_size_shares(insert_size_hist(spark, sf), least=40).withColumn("percent", F.round("percent", 6))


@_query("SELECT bc, count(*) FILTER (WHERE NOT tagged) AS n_nontagged, count(*) FILTER (WHERE tagged) AS n_umi_tag FROM assigned GROUP BY bc", needs=_ALL, ctes=_ASSIGNED)
def bcumistats(spark, sf):
    return qc.read_kinds(_assigned(spark, sf))


@_query(
    "SELECT type, n, round(100 * n / sum(n) OVER (), 6) AS percent FROM (SELECT CASE WHEN cell = 'bad' THEN 'unused' ELSE type END AS type, cast(sum(n) as bigint) AS n FROM rpc GROUP BY 1)",
    needs=_ALL, ctes=f"{_ASSIGNED}, cells AS ({_CELLS}), tot AS (SELECT bc, count(*) + 3 AS total FROM reads GROUP BY bc), rpc AS ({_BAD})",
)
def qc_read_type_pct(spark, sf):
    return qc.type_shares(readspercell_bad_rollup(spark, sf)).withColumn("percent", F.round("percent", 6))


_LEVELS = "8,5-12"
_DRAW = "len(list_filter(generate_series(1, {most}), lambda i: cast(concat('0x', substr(md5(concat('s42:{t}:', bc, ':', layer, '#', cast(i as varchar))), 1, 8)) as bigint) / 4294967296.0 < held / depth))"


def _levels_sql(levels: str) -> str:
    """CTEs that add the downsampled levels to ``layer0``, each layer named with its level."""
    parts = []
    for t, least, most in counts.parse_levels(levels):
        draw = _DRAW.format(most=most, t=t)
        parts.append(f"SELECT rid, bc, umi, tagged, is_uniq, genes, concat(layer, '|downsampled_{t}') AS layer FROM ranked WHERE depth >= {least} AND turn <= CASE WHEN depth <= {most} THEN held ELSE least({draw}, held) END")
    return f"""dep AS (SELECT bc, count(*) AS depth FROM assigned GROUP BY bc),
ranked AS (SELECT l.*, depth, count(*) OVER (PARTITION BY bc, layer) AS held, row_number() OVER (PARTITION BY bc, layer ORDER BY md5(concat('s42', cast(rid as varchar))), rid) AS turn FROM layer0 l JOIN dep USING (bc)),
layer AS (SELECT rid, bc, umi, tagged, is_uniq, genes, concat(layer, '|all') AS layer FROM layer0 UNION ALL {" UNION ALL ".join(parts)})"""


@_query(
    "SELECT split_part(layer, '|', 2) AS level, bc, split_part(layer, '|', 1) AS layer, count(*) AS n FROM layer WHERE NOT contains(layer, '|all') GROUP BY 1, 2, 3",
    needs=_ALL, ctes=f"{_ASSIGNED.replace('layer AS (SELECT *', 'layer0 AS (SELECT *')}, {_levels_sql(_LEVELS)}",
)
def downsample_levels(spark, sf):
    rows = counts.layer_rows(_assigned(spark, sf), counts.parse_levels(_LEVELS))
    return rows.where("level <> 'all'").groupBy("level", "bc", "layer").agg(F.count(F.lit(1)).alias("n"))


@_query("SELECT row_number() OVER (ORDER BY rid) - 1 AS n, read_id, r1_seq, r1_qual, r2_seq, r2_qual, i1_seq, i1_qual, i2_seq, i2_qual FROM reads", needs="reads")
def fastq_zip(spark, sf):
    """The reads as four FASTQ files, which are written each by itself, zipped by position. What reads are made of is put in
    order before they are made, so only keys are sorted; the files are gzip, a folder of parts each."""
    folder = f"{shared_dir(spark)}/fastq-{uuid.uuid4().hex}"
    held = lines(spark, sf)
    for mate in ("r1", "r2", "i1", "i2"):
        rows = view(spark, sf, "reads", held.repartitionByRange("rid").sortWithinPartitions("rid"))
        text = F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), f"{mate}_seq", F.lit("+"), f"{mate}_qual")
        with clean_shuffles(spark):
            rows.select(text.alias("value")).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(f"{folder}/{mate}")
    return readers.zip_fastq(spark, [tuple(f"{folder}/{m}" for m in ("r1", "r2", "i1", "i2"))]).drop("lane")


@_query(
    "SELECT bc, n, min(v) FILTER (WHERE v BETWEEN a AND b) AS low, q1, median, q3, max(v) FILTER (WHERE v BETWEEN a AND b) AS high, count(*) FILTER (WHERE v < a OR v > b) AS outliers FROM (SELECT *, q1 - 1.5 * (q3 - q1) AS a, q3 + 1.5 * (q3 - q1) AS b FROM held JOIN boxes USING (bc)) GROUP BY bc, n, q1, median, q3",
    needs="reads", ctes="held AS (SELECT bc, cast(count(*) as double) AS v FROM reads GROUP BY bc, umi), boxes AS (SELECT bc, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM held GROUP BY bc)",
)
def qc_boxes(spark, sf):
    held = view(spark, sf, "reads").groupBy("bc", "umi").agg(F.count(F.lit(1)).cast("double").alias("v"))
    return qc.box_statistics(held, "v", "bc")


@_query("SELECT length(r1_seq) AS length, count(*) AS n FROM (SELECT r1_seq FROM reads ORDER BY rid LIMIT 1000) GROUP BY 1 ORDER BY n DESC, length LIMIT 1", needs="reads")
def probe_read_length(spark, sf):
    return qc.probe_length(view(spark, sf, "reads"), "rid", "r1_seq")


# --- quality of the reads

_CYCLES = """ch AS (SELECT unnest(generate_series(1, length(r2_seq))) AS cycle, unnest(string_split(r2_seq, '')) AS b, unnest(string_split(r2_qual, '')) AS q FROM reads WHERE r2_seq <> ''),
qh AS (SELECT cycle, greatest(ascii(q) - 33, 0) AS q, count(*) AS n FROM ch GROUP BY 1, 2),
qc AS (SELECT *, sum(n) OVER (PARTITION BY cycle ORDER BY q) AS upto, sum(n) OVER (PARTITION BY cycle) AS total FROM qh),
qs AS (SELECT cycle, sum(q * n) / sum(n) AS mean, min(q) FILTER (WHERE upto >= total * 0.1) AS q10, min(q) FILTER (WHERE upto >= total * 0.25) AS q25, min(q) FILTER (WHERE upto >= total * 0.5) AS q50,
 min(q) FILTER (WHERE upto >= total * 0.75) AS q75, min(q) FILTER (WHERE upto >= total * 0.9) AS q90 FROM qc GROUP BY cycle),
bs AS (SELECT cycle, count(*) AS n, count(*) FILTER (WHERE b = 'A') AS a, count(*) FILTER (WHERE b = 'C') AS c, count(*) FILTER (WHERE b = 'G') AS g, count(*) FILTER (WHERE b = 'T') AS t, count(*) FILTER (WHERE b NOT IN ('A', 'C', 'G', 'T')) AS other FROM ch GROUP BY cycle)"""


@_query("SELECT cast(cycle as bigint) AS cycle, n, a, c, g, t, other, round(mean, 6) AS mean, cast(q10 as integer) AS q10, cast(q25 as integer) AS q25, cast(q50 as integer) AS q50, cast(q75 as integer) AS q75, cast(q90 as integer) AS q90 FROM bs JOIN qs USING (cycle)", needs="reads", ctes=_CYCLES)
def read_qc_cycles(spark, sf):
    return readqc.cycle_profile(view(spark, sf, "reads"), "r2_seq", "r2_qual").withColumn("mean", F.round("mean", 6))


@_query(
    f"SELECT cast(list_max(list_filter({list(readqc.LEVELS)}, lambda x: x <= copies)) as integer) AS level, count(*) AS sequences, cast(sum(copies) as bigint) AS reads FROM (SELECT i1_seq, count(*) AS copies FROM reads GROUP BY i1_seq) GROUP BY 1",
    needs="reads",
)
def read_qc_duplication(spark, sf):
    return readqc.duplication_levels(view(spark, sf, "reads"), "i1_seq")


@_query("SELECT substr(r1_seq, 1, 20) AS sequence, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM reads), 6) AS percent FROM reads GROUP BY 1 HAVING count(*) >= 0.002 * (SELECT count(*) FROM reads)", needs="reads")
def read_qc_overrepresented(spark, sf):
    return readqc.overrepresented(view(spark, sf, "reads"), "r1_seq", share=0.002, prefix=20).withColumn("percent", F.round("percent", 6))


# --- mates, spike-ins, and all counts

_FOLD = """cnt AS (SELECT *, nh > 1 AS is_multi, concat(qname, CASE WHEN nh > 1 THEN '*' ELSE '' END) AS rid, (flag & 64) <> 0 AS one, (flag & 16) <> 0 AS rev,
 concat(chrom, chr(1), lpad(cast(pos as varchar), 12, '0'), lpad(cast(flag as varchar), 5, '0')) AS place FROM records WHERE (flag & 2048) = 0),
folded AS (SELECT rid, qname, is_multi, min_by(bc, place) AS bc, min_by(ub, place) AS ub, max_by(rev, place) FILTER (WHERE one) AS r1_rev, max_by(rev, place) FILTER (WHERE NOT one) AS r2_rev, count(*) AS n_records FROM cnt GROUP BY rid, qname, is_multi),
fr AS (SELECT *, ub <> '' AS tagged, CASE WHEN coalesce(r1_rev, NOT r2_rev, false) THEN '-' ELSE '+' END AS frag_strand FROM folded)"""
_MATE_BLOCKS = """block AS (SELECT rid, chrom, pos AS s, pos + CASE cigar WHEN '40M60N10M' THEN 39 WHEN '5S45M' THEN 44 WHEN '20M2D30M' THEN 19 ELSE 49 END AS e FROM cnt
 UNION ALL SELECT rid, chrom, pos + CASE cigar WHEN '40M60N10M' THEN 100 ELSE 22 END, pos + CASE cigar WHEN '40M60N10M' THEN 109 ELSE 51 END FROM cnt WHERE cigar IN ('40M60N10M', '20M2D30M')),
mapped AS (SELECT rid, cast(sum(e - s + 1) as bigint) AS mapped FROM block GROUP BY rid)"""
_ANNOTATION = f"gexons AS ({SQL['exons']}), exons AS (SELECT gene_id, chrom, strand, start_pos, end_pos FROM gexons UNION ALL SELECT contig, contig, '+', 1, length FROM spikes)"
_MATES = (
    f"{_ANNOTATION}, {_FOLD}, {_MATE_BLOCKS}, {_MERGED}, {_INTRONS.replace('FROM exons', 'FROM gexons')}, ix AS (SELECT n.*, g.strand FROM introns n JOIN (SELECT DISTINCT gene_id, strand FROM gexons) g USING (gene_id)), "
    f"ge AS ({_RESOLVE.format(fr='fr', ov=_OV.format(t='merged'))}), gi AS ({_RESOLVE.format(fr='fr', ov=_OV.format(t='ix'))}), "
    "assigned AS (SELECT a.rid, a.bc, a.ub AS umi, a.tagged, NOT a.is_multi AS is_uniq, r1_rev, r2_rev, ge.genes AS ge, gi.genes AS gi, coalesce(len(list_filter(ge.genes, lambda g: NOT starts_with(g, 'ERCC'))) = 0, false) AS user, "
    "CASE WHEN ge.genes IS NOT NULL AND len(list_filter(ge.genes, lambda g: NOT starts_with(g, 'ERCC'))) = 0 THEN 'User' WHEN ge.genes IS NOT NULL THEN 'Exon' WHEN ge.tie THEN 'Ambiguity' WHEN gi.genes IS NOT NULL THEN 'Intron' WHEN gi.tie THEN 'Ambiguity' ELSE 'Intergenic' END AS category "
    "FROM fr a LEFT JOIN ge USING (rid) LEFT JOIN gi USING (rid))"
)
_MATE_LAYER = (
    "layer0 AS (SELECT *, 'exon' AS layer, ge AS genes FROM assigned WHERE ge IS NOT NULL UNION ALL SELECT *, 'intron', gi FROM assigned WHERE ge IS NULL AND gi IS NOT NULL "
    "UNION ALL SELECT *, 'inex', coalesce(ge, gi) FROM assigned WHERE coalesce(ge, gi) IS NOT NULL)"
)


def _annotation(spark, sf):
    """Exons and, as one more gene each, the spike-in contigs."""
    spikes = view(spark, sf, "spikes").select(F.col("contig").alias("gene_id"), F.col("contig").alias("chrom"), F.lit("+").alias("strand"), F.lit(1).cast("long").alias("start_pos"), F.col("length").cast("long").alias("end_pos"), F.lit(True).alias("additional"))
    return view(spark, sf, "exons").withColumn("additional", F.lit(False)).unionByName(spikes)


#: lines whose records are worked on at a time; fragments never meet others than those of their read's number
SLICE = 20_000_000


def _mates(spark, sf, make, name):
    """What ``make`` (of records, assigned fragments, blocks, merged exons) gives of all records, in slices by the number of the read
    beyond ``SLICE`` lines. What slices give is one table, in which their rows stand one after the other."""
    annotation = stored(_annotation(spark, sf), "annotation")  # it is read several times, as are records and lines
    merged = stored(intervals.merge(annotation, "gene_id", "chrom", "strand", "additional"), "merged-exons")
    gaps = stored(intervals.introns(annotation).join(annotation.select("gene_id", "strand").distinct(), "gene_id"), "introns")
    held = lines(spark, sf)
    n = max(1, -(-held.count() // SLICE))

    def one(k):
        part = held if n == 1 else held.where(F.pmod(F.xxhash64("rid"), F.lit(n)) == k)
        records = stored(view(spark, sf, "records", part), "records")
        blocks = mates.record_blocks(records)
        found = fragments.assign_once(mates.fold(records), blocks, merged, gaps, fraction=0.25).withColumnRenamed("ub", "umi").withColumn("is_uniq", ~F.col("is_multi"))
        return make(records, found, blocks, merged)

    return in_slices(spark, n, one, name), merged


@_query("SELECT rid, qname, is_multi, bc, ub, r1_rev, r2_rev, n_records, tagged, frag_strand FROM fr", needs="records", ctes=_FOLD)
def fragment_fold(spark, sf):
    return mates.fold(view(spark, sf, "records")).drop("mapped")


@_query("SELECT *, gene_id LIKE 'ERCC%' AS additional FROM exons", needs="spikes", ctes=_ANNOTATION)
def final_annotation(spark, sf):
    return _annotation(spark, sf)


@_query("SELECT rid, bc, array_to_string(ge, ',') AS ge, array_to_string(gi, ',') AS gi, category FROM assigned", needs="records spikes", ctes=_MATES)
def mate_taxonomy(spark, sf):
    return _mates(spark, sf, lambda _records, found, *_: found.select("rid", "bc", F.array_join("ge", ",").alias("ge"), F.array_join("gi", ",").alias("gi"), "category"), "taxonomy")[0]


@_query(
    "SELECT r.qname, r.flag, r.chrom, r.pos, coalesce(array_to_string(a.ge, ','), '') AS \"GE\", coalesce(array_to_string(a.gi, ','), '') AS \"GI\" FROM records r LEFT JOIN assigned a ON (r.flag & 2048) = 0 AND a.rid = concat(r.qname, CASE WHEN r.nh > 1 THEN '*' ELSE '' END)",
    needs="records spikes", ctes=_MATES,
)
def tagged_records(spark, sf):
    return _mates(spark, sf, lambda records, found, *_: mates.tagged_records(records, found).select("qname", "flag", "chrom", "pos", "GE", "GI"), "tagged-records")[0]


@_query(
    f"SELECT cell, type, n FROM ({_BAD})", needs="records spikes reads",
    ctes=f"{_MATES}, cells AS ({_CELLS}), tot AS (SELECT bc, count(*) AS total FROM reads GROUP BY bc)",
)
def mate_reads_per_cell(spark, sf):
    totals = view(spark, sf, "reads").groupBy("bc").agg(F.count(F.lit(1)).alias("total"))
    each = _mates(spark, sf, lambda _records, found, *_: fragments.category_counts(found), "categories")[0]
    return qc.reads_per_cell(each.groupBy("bc").agg(*(F.sum(c).alias(c) for c in each.columns if c != "bc")), totals, 70)


#: contigs of the records, in an order that is not that of their names; a genome's grow with the parts, so they are as long as the
#: format lets them be
LONGEST = (1 << 31) - 1
_CONTIGS = [("chrX", LONGEST), *((f"chr{i}", LONGEST) for i in (3, 0, 4, 1, 2)), *((f"ERCC{i}", 2000) for i in range(25))]
REGION = ("chr1", 5_000, 30_000)


def _as_bam(spark, sf, **how):
    """The records as BAM files in the shared folder, in order of place."""
    path = f"{shared_dir(spark)}/bam-{uuid.uuid4().hex}"
    placed = mates.by_coordinate(view(spark, sf, "records"), [c for c, _ in _CONTIGS])
    bam.write_bam(mates.bam_rows(placed), path, bam.header(_CONTIGS, order="coordinate"), **how)
    return path


@_query("SELECT qname, cast(flag as integer) AS flag, chrom AS rname, cast(pos as bigint) AS pos, cigar, cast(nh as integer) AS nh, bc, ub FROM records", needs="records")
def bam_round_trip(spark, sf):
    got = readers.read_bam(spark, [_as_bam(spark, sf)])
    return got.select("qname", "flag", "rname", "pos", "cigar", F.col("NH").alias("nh"), F.col("BC").alias("bc"), F.col("UB").alias("ub"))


@_query(
    f"SELECT qname, cast(flag as integer) AS flag, cast(pos as bigint) AS pos FROM records WHERE chrom = '{REGION[0]}' AND pos <= {REGION[2]} AND pos + CASE cigar WHEN '40M60N10M' THEN 109 WHEN '5S45M' THEN 44 WHEN '20M2D30M' THEN 51 ELSE 49 END >= {REGION[1]}",
    needs="records",
)
def bam_region(spark, sf):
    path = _as_bam(spark, sf, index=True)
    return bam.scan_bam(spark, [path], region=f"{REGION[0]}:{REGION[1]}-{REGION[2]}").select("qname", "flag", "pos")


_MATE_SPAN = """spl AS (SELECT *, coalesce(sum(end_pos - start_pos + 1) OVER (PARTITION BY gene_id ORDER BY start_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - start_pos AS before FROM merged),
tspan AS (SELECT rid, gene_id, min(before + greatest(s, start_pos)) AS lo, max(before + least(e, end_pos)) AS hi FROM block b JOIN spl ON spl.chrom = b.chrom AND b.s <= spl.end_pos AND spl.start_pos <= b.e GROUP BY rid, gene_id)"""


@_query(
    "SELECT a.user, a.tagged, cast(hi - lo + 1 as bigint) AS size, count(*) AS n FROM assigned a JOIN tspan ON tspan.rid = a.rid AND tspan.gene_id = a.ge[1] WHERE r1_rev IS NOT NULL AND r2_rev IS NOT NULL AND len(ge) = 1 GROUP BY 1, 2, 3",
    needs="records spikes", ctes=f"{_MATES}, {_MATE_SPAN}",
)
def mate_insert_sizes(spark, sf):
    each = _mates(spark, sf, lambda _records, found, blocks, merged: qc.mate_insert_sizes(found, qc.transcript_spans(blocks, merged.drop("additional", "strand"))), "insert-sizes")[0]
    return each.groupBy("user", "tagged", "size").agg(F.sum("n").alias("n"))


_MATE_BODY = """pl AS (SELECT *, coalesce(sum(end_pos - start_pos + 1) OVER (PARTITION BY gene_id ORDER BY start_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(end_pos - start_pos + 1) OVER (PARTITION BY gene_id) AS length FROM merged),
own AS (SELECT rid, g LIKE 'ERCC%' AS additional, tagged, g AS gene_id FROM (SELECT rid, tagged, unnest(ge) AS g FROM assigned)),
hit AS (SELECT additional, tagged, pl.gene_id, strand, length, before + greatest(s, start_pos) - start_pos AS lo, before + least(e, end_pos) - start_pos AS hi FROM block b JOIN own USING (rid) JOIN pl ON pl.gene_id = own.gene_id AND pl.chrom = b.chrom AND b.s <= pl.end_pos AND pl.start_pos <= b.e),
base AS (SELECT additional, tagged, gene_id, length, strand, unnest(generate_series(cast(lo as bigint), cast(hi as bigint))) AS p FROM hit),
body AS (SELECT additional, tagged, gene_id, cast(CASE WHEN strand = '+' THEN p ELSE length - 1 - p END * 100 // length as bigint) AS percentile, count(*) AS n FROM base GROUP BY 1, 2, 3, 4)"""


@_query(
    "SELECT additional, tagged, percentile, round(sum(share) / any_value(genes), 6) AS coverage FROM (SELECT additional, tagged, percentile, n / max(n) OVER (PARTITION BY tagged, gene_id) AS share FROM body) JOIN (SELECT additional, tagged, count(DISTINCT gene_id) AS genes FROM body GROUP BY 1, 2) USING (additional, tagged) GROUP BY 1, 2, 3",
    needs="records spikes", ctes=f"{_MATES}, {_MATE_BODY}",
)
def mate_gene_body(spark, sf):
    def turns(_records, found, blocks, merged):
        own = stored(found.select("rid", "tagged", F.explode("ge").alias("gene_id")), "fragment-genes")  # its rows may be counted before they are joined
        return qc.gene_turns(blocks, merged.drop("additional"), own, ("tagged",))

    each, merged = _mates(spark, sf, turns, "gene-turns")
    body = qc.body_of(each, keys=("tagged",)).join(merged.select("gene_id", "additional").distinct(), "gene_id")
    return qc.mean_profile(body, "additional", "tagged").withColumn("coverage", F.round("coverage", 6))


_COUNT_LEVELS, _LEAST_READS = "20,5-15", 40
_COUNTED = f"""{_MATES}, tot AS (SELECT bc, count(*) AS total FROM reads GROUP BY bc), ak AS (SELECT assigned.* FROM assigned JOIN tot USING (bc) WHERE total >= {_LEAST_READS}), {_MATE_LAYER.replace("FROM assigned", "FROM ak")},
{_levels_sql(_COUNT_LEVELS).replace("FROM assigned", "FROM ak")}, {_UMI}, {_NET},
fam AS (SELECT 'umicount' AS quant, layer, bc, genes FROM mol UNION ALL SELECT 'readcount', layer, bc, genes FROM layer UNION ALL SELECT 'readcount_internal', layer, bc, genes FROM layer WHERE NOT tagged),
cs AS (SELECT quant, layer, bc, genes, cast(count(*) as double) AS c FROM fam GROUP BY quant, layer, bc, genes),
x AS (SELECT quant, layer, bc, genes, c, len(genes) AS k, unnest(genes) AS gene FROM cs),
wt AS (SELECT quant, layer, bc, gene, sum(CASE WHEN k = 1 THEN c ELSE 0 END) AS geu, sum(CASE WHEN k > 1 THEN c / k ELSE 0 END) AS guni FROM x GROUP BY ALL),
sh AS (SELECT x.quant, x.layer, x.bc, x.genes, x.c, x.gene, geu + guni AS w, sum(geu + guni) OVER (PARTITION BY x.quant, x.layer, x.bc, x.genes) AS t FROM x JOIN wt USING (quant, layer, bc, gene) WHERE k > 1),
len AS (SELECT gene_id AS gene, sum(end_pos - start_pos + 1) AS length FROM merged GROUP BY gene_id),
sgl AS (SELECT quant, layer, bc, genes[1] AS gene, c AS value FROM cs WHERE len(genes) = 1),
allc AS (SELECT * FROM sgl UNION ALL SELECT concat(quant, '_mult_rescue'), layer, bc, gene, sum(c * w / t) FROM sh WHERE quant <> 'readcount' GROUP BY quant, layer, bc, gene
 UNION ALL SELECT 'rpkm', layer, bc, gene, value / (sum(value) OVER (PARTITION BY bc) * 1e-6) / (length / 1000.0) FROM sgl JOIN len USING (gene) WHERE quant = 'readcount_internal' AND layer = 'exon|all')"""
_LONG = "SELECT quant, split_part(layer, '|', 1) AS feature, split_part(layer, '|', 2) AS level, gene, bc AS cell, round(value, 6) AS value FROM allc"


def _counts_long(spark, sf):
    found, merged = _mates(spark, sf, lambda _records, found, *_: found.select("rid", "bc", "umi", "tagged", "is_uniq", "ge", "gi"), "assigned")
    totals = view(spark, sf, "reads").groupBy("bc").agg(F.count(F.lit(1)).alias("total"))
    lengths = merged.groupBy(F.col("gene_id").alias("gene")).agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("length"))
    return counts.counts_long(found, totals, lengths, least_reads=_LEAST_READS, mode="rescue", levels=_COUNT_LEVELS)


@_query(_LONG, needs="records spikes reads", ctes=_COUNTED, recursive=True)
def counts_long(spark, sf):
    return _counts_long(spark, sf).withColumn("value", F.round("value", 6))


@_query(
    f"SELECT concat(replace(quant, '_mult_rescue', ''), '_UniqueAndMult-rescue') AS quant, feature, level, gene, cell, round(sum(v), 5) AS value FROM ({_LONG.replace('round(value, 6) AS value', 'value AS v')}) WHERE quant NOT IN ('readcount', 'rpkm') GROUP BY 1, 2, 3, 4, 5",
    needs="records spikes reads", ctes=_COUNTED, recursive=True,
)
def unique_and_mult(spark, sf):
    return counts.unique_and_mult(_counts_long(spark, sf), "rescue").withColumn("value", F.round("value", 5))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
