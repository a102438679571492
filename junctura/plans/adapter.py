"""Junctions, annotation and results derived from the driver's tables.

Each frame has a twin in SQL (``CTES``), so that queries over it can be compared
cell by cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from junctura.functions import introns as I
from junctura.operators import clusters, counts

PARTS, SUPPLIERS = 2000, 100  # keys a million bases, those of a scale of 0.01
SAMPLES = [f"S{i}" for i in range(1, 8)]
GROUPS = {s: "A" if i < 3 else "B" for i, s in enumerate(SAMPLES)}
#: Thresholds at which each filter removes something at a scale of 0.01.
LIMITS = {"min_intron_count": 200, "min_intron_samples": 5, "min_cluster_count": 300, "min_cluster_samples": 5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _motif(m: F.Column) -> F.Column:
    return (
        F.when(m <= 2, "GT--AG").when(m <= 5, "CT--AC").when(m == 6, "GC--AG").when(m == 7, "CT--GC").when(m == 8, "GT--AT").otherwise("AA--TT")
    )


def _away(key: F.Column, many: int) -> F.Column:
    """Bases by which what a key names lies away from the first: a million for each ``many`` keys, so that places grow with the tables."""
    return F.floor(key / many) * 1_000_000


def junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample_id, intron, splice_pair, splice_flag, count: a row per line item."""
    c = F.col
    away = _away(c("l_partkey"), PARTS)
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), c("l_linenumber")).alias("sample_id"),
        F.concat(
            F.lit("chr"), c("l_suppkey") % 5 + 1, F.lit(":"), away + 100000 + (c("l_partkey") % 40) * 1000, F.lit("-"),
            away + 500000 + (c("l_partkey") % 7) * 1000 + (c("l_suppkey") % 4) * 100,
        ).alias("intron"),
        _motif((c("l_partkey") % 40 + c("l_partkey") % 7) % 10).alias("splice_pair"), c("l_quantity").cast("long").alias("count"),
    )
    return rows.select("sample_id", "intron", "splice_pair", I.splice_flag(F.col("splice_pair")).alias("splice_flag"), "count")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.sum_junctions(junctions(spark, sf_dir))


def introns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.junction_introns(junctions(spark, sf_dir))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustered introns, a row each, with counts in the order of ``SAMPLES``."""
    return clusters.packed_clusters(cells(spark, sf_dir), SAMPLES)


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustered long counts with a row for every intron and sample."""
    return counts.unpacked(packed(spark, sf_dir), SAMPLES)


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.dense_totals(packed(spark, sf_dir), SAMPLES)


def metadata(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, g, i % 2) for i, (s, g) in enumerate(GROUPS.items(), 1)], "sample_id string, `group` string, batch int")


def wild_metadata(spark: SparkSession) -> DataFrame:
    """Metadata with a blank name, an unknown sample and two samples left out."""
    rows = [(s, g) for s, g in GROUPS.items() if s not in ("S6", "S7")] + [("S9", "B"), (" ", "A"), (None, "A")]
    return spark.createDataFrame(rows, "sample_id string, `group` string")


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom, start, end, strand, gene_name, ord of a gene for each supplier."""
    k = F.col("s_suppkey")
    start = _away(k, SUPPLIERS) + 100000 + k * 7919 % 400000
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("chr"), k % 5 + 1).alias("chrom"), start.alias("start"), (start + 1000 + k * 104729 % 30000).alias("end"),
        F.when(k % 2 == 0, "+").otherwise("-").alias("strand"), F.concat(F.lit("G"), k % 60).alias("gene_name"), k.alias("ord"),
    )


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exon rows: two on the sides of an intron of the matrix, or several by transcript."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    k = F.col("k")
    away = _away(k, PARTS)
    istart, iend = away + 100000 + k % 40 * 1000, away + 500000 + k % 7 * 1000 + k % 4 * 100
    strand = I.strand_of(_motif((k % 40 + k % 7) % 10))
    around = part.where(k % 3 == 0).select(
        F.concat(F.lit("chr"), k % 5 + 1).alias("chrom"), strand.alias("strand"), F.concat(F.lit("K"), k).alias("transcript_id"), F.concat(F.lit("G"), k % 60).alias("gene_name"),
        F.explode(F.array(F.struct((istart - 100).alias("start"), (istart - 1).alias("end"), (2 * k).alias("ord")), F.struct((iend + 1).alias("start"), (iend + 200).alias("end"), (2 * k + 1).alias("ord")))).alias("e"),
    ).select("chrom", "strand", "transcript_id", "gene_name", "e.*")
    t = k % 50
    start = away + 100000 + k * 977 % 400000
    several = part.where(k % 3 == 1).select(
        F.concat(F.lit("chr"), t % 5 + 1).alias("chrom"), F.when(t % 2 == 0, "+").otherwise("-").alias("strand"), F.concat(F.lit("T"), t, F.when(away > 0, F.concat(F.lit("/"), away)).otherwise("")).alias("transcript_id"),
        F.concat(F.lit("G"), t % 40).alias("gene_name"), start.alias("start"), (start + 50 + k % 100).alias("end"), (2 * k).alias("ord"),
    )
    return around.unionByName(several)


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test results of two contrasts per intron, made up from its counts."""
    per = cells(spark, sf_dir).groupBy("intron_id").agg(F.sum("count").cast("long").alias("s"), F.count("*").alias("k"))
    per = per.withColumn("c", F.explode(F.array(F.lit(0), F.lit(1))))
    u = ((F.col("s") * 7919 + F.col("k") * 31 + F.col("c") * 977) % 2000 + 1) / F.lit(2001.0)
    p = F.when(F.col("s") % 97 != 0, F.col("u") * F.col("u") * F.col("u"))
    out = per.withColumn("u", u).select(
        "intron_id", F.when(F.col("c") == 0, "A_vs_B").otherwise("A_vs_C").alias("contrast"), p.alias("PValue"),
        (((F.col("s") * 31 + F.col("c") * 7) % 401 - 200) / F.lit(50.0)).alias("logFC"), "s", "k",
    )
    site = F.regexp_extract("intron_id", r"^([^-]+)-", 1)
    return out.withColumn("cluster", site).withColumn("gene_name", F.when(F.col("s") % 5 != 0, F.concat(F.lit("G"), F.col("s") % 30)))


#: The frames above in SQL, each building on those before it.
CTES = {
    "junction": """SELECT 'S' || l_linenumber AS sample_id,
        'chr' || (l_suppkey % 5 + 1) || ':' || (l_partkey // 2000 * 1000000 + 100000 + (l_partkey % 40) * 1000) || '-' || (l_partkey // 2000 * 1000000 + 500000 + (l_partkey % 7) * 1000 + (l_suppkey % 4) * 100) AS intron,
        CASE WHEN (l_partkey % 40 + l_partkey % 7) % 10 <= 2 THEN 'GT--AG' WHEN (l_partkey % 40 + l_partkey % 7) % 10 <= 5 THEN 'CT--AC'
             WHEN (l_partkey % 40 + l_partkey % 7) % 10 = 6 THEN 'GC--AG' WHEN (l_partkey % 40 + l_partkey % 7) % 10 = 7 THEN 'CT--GC'
             WHEN (l_partkey % 40 + l_partkey % 7) % 10 = 8 THEN 'GT--AT' ELSE 'AA--TT' END AS splice_pair,
        CASE WHEN (l_partkey % 40 + l_partkey % 7) % 10 = 9 THEN 'NON' ELSE 'OK' END AS splice_flag, CAST(l_quantity AS BIGINT) AS count FROM lineitem""",
    "cell": "SELECT intron || '^' || splice_pair || '^' || splice_flag AS intron_id, sample_id, CAST(sum(count) AS BIGINT) AS count FROM junction GROUP BY 1, 2",
    "parsed": """SELECT intron_id, regexp_extract(intron_id, '^([^:]+):', 1) AS chrom, CAST(regexp_extract(intron_id, ':([0-9]+)-', 1) AS BIGINT) AS "start",
        CAST(regexp_extract(intron_id, '-([0-9]+)\\^', 1) AS BIGINT) AS "end", split_part(intron_id, '^', 2) AS splice_pair, split_part(intron_id, '^', 3) AS flag
        FROM (SELECT DISTINCT intron_id FROM cell)""",
    "stranded": """SELECT *, CASE WHEN splice_pair IN ('GT--AG', 'GC--AG', 'AT--AC') THEN '+' WHEN splice_pair IN ('CT--AC', 'CT--GC', 'GT--AT') THEN '-' ELSE '?' END AS strand FROM parsed""",
    "sited": """SELECT *, CASE WHEN strand = '-' THEN "end" ELSE "start" END AS donor, CASE WHEN strand = '-' THEN "start" ELSE "end" END AS acceptor FROM stranded""",
    "intron": "SELECT *, chrom || ':' || donor || ':' || strand AS donor_cluster, chrom || ':' || acceptor || ':' || strand AS acceptor_cluster FROM sited",
    "sample": "SELECT 'S' || i AS sample_id, CASE WHEN i <= 3 THEN 'A' ELSE 'B' END AS grp FROM range(1, 8) AS r(i)",
    "dense": "SELECT i.*, s.sample_id, s.grp, CAST(coalesce(c.count, 0) AS BIGINT) AS count FROM intron i CROSS JOIN sample s LEFT JOIN cell c ON c.intron_id = i.intron_id AND c.sample_id = s.sample_id",
    "total2": """SELECT *, CAST(sum(count) OVER (PARTITION BY donor_cluster, sample_id) AS BIGINT) AS donor_total,
        CAST(sum(count) OVER (PARTITION BY acceptor_cluster, sample_id) AS BIGINT) AS acceptor_total FROM dense""",
    "total": "SELECT *, greatest(donor_total, acceptor_total) AS shared_total FROM total2",
    "psi": "SELECT *, CASE WHEN shared_total > 0 THEN CAST(count AS DOUBLE) / shared_total ELSE 0.0 END AS psi FROM total",
    "canonical": "SELECT * FROM dense WHERE flag = 'OK'",
    "lowcount": "SELECT * FROM canonical WHERE intron_id IN (SELECT intron_id FROM canonical GROUP BY 1 HAVING sum(count) >= 200 AND count(*) FILTER (WHERE count > 0) >= 5)",
    "donor_ok": "SELECT donor_cluster FROM (SELECT donor_cluster, sample_id, sum(count) AS n FROM lowcount GROUP BY 1, 2) GROUP BY 1 HAVING count(*) FILTER (WHERE n >= 300) >= 5",
    "acceptor_ok": "SELECT acceptor_cluster FROM (SELECT acceptor_cluster, sample_id, sum(count) AS n FROM lowcount GROUP BY 1, 2) GROUP BY 1 HAVING count(*) FILTER (WHERE n >= 300) >= 5",
    "flagged": "SELECT *, donor_cluster IN (SELECT * FROM donor_ok) AS d, acceptor_cluster IN (SELECT * FROM acceptor_ok) AS a FROM lowcount",
    "kept": "SELECT * FROM flagged WHERE d OR a",
    "per": "SELECT intron_id, CAST(sum(count) AS BIGINT) AS s, count(*) AS k FROM cell GROUP BY 1",
    "made": "SELECT *, ((s * 7919 + k * 31 + c * 977) % 2000 + 1) / 2001.0::DOUBLE AS u FROM per CROSS JOIN range(0, 2) AS r(c)",
    "result": """SELECT intron_id, CASE WHEN c = 0 THEN 'A_vs_B' ELSE 'A_vs_C' END AS contrast, CASE WHEN s % 97 <> 0 THEN u * u * u END AS "PValue",
        ((s * 31 + c * 7) % 401 - 200) / 50.0::DOUBLE AS "logFC", s, k, regexp_extract(intron_id, '^([^-]+)-', 1) AS cluster,
        CASE WHEN s % 5 <> 0 THEN 'G' || (s % 30) END AS gene_name FROM made""",
    "gene": """SELECT 'chr' || (s_suppkey % 5 + 1) AS chrom, s_suppkey // 100 * 1000000 + 100000 + s_suppkey * 7919 % 400000 AS "start", s_suppkey // 100 * 1000000 + 100000 + s_suppkey * 7919 % 400000 + 1000 + s_suppkey * 104729 % 30000 AS "end",
        CASE WHEN s_suppkey % 2 = 0 THEN '+' ELSE '-' END AS strand, 'G' || (s_suppkey % 60) AS gene_name, s_suppkey AS ord FROM supplier""",
    "around": """SELECT p_partkey AS k, p_partkey // 2000 * 1000000 + 100000 + p_partkey % 40 * 1000 AS istart, p_partkey // 2000 * 1000000 + 500000 + p_partkey % 7 * 1000 + p_partkey % 4 * 100 AS iend, (p_partkey % 40 + p_partkey % 7) % 10 AS m FROM part WHERE p_partkey % 3 = 0""",
    "exon": """SELECT 'chr' || (k % 5 + 1) AS chrom, CASE WHEN m <= 2 OR m = 6 THEN '+' WHEN m <= 8 THEN '-' ELSE '?' END AS strand, 'K' || k AS transcript_id, 'G' || (k % 60) AS gene_name,
            CASE WHEN side = 0 THEN istart - 100 ELSE iend + 1 END AS "start", CASE WHEN side = 0 THEN istart - 1 ELSE iend + 200 END AS "end", 2 * k + side AS ord FROM around CROSS JOIN range(0, 2) AS r(side)
        UNION ALL SELECT 'chr' || (p_partkey % 50 % 5 + 1), CASE WHEN p_partkey % 50 % 2 = 0 THEN '+' ELSE '-' END,
            'T' || (p_partkey % 50) || CASE WHEN p_partkey >= 2000 THEN '/' || (p_partkey // 2000 * 1000000) ELSE '' END, 'G' || (p_partkey % 50 % 40),
            p_partkey // 2000 * 1000000 + 100000 + p_partkey * 977 % 400000, p_partkey // 2000 * 1000000 + 100000 + p_partkey * 977 % 400000 + 50 + p_partkey % 100, 2 * p_partkey FROM part WHERE p_partkey % 3 = 1""",
    "paired": """SELECT chrom, strand, transcript_id, "end" + 1 AS istart, lead("start") OVER (PARTITION BY transcript_id ORDER BY "start", ord) - 1 AS iend,
        lead(chrom) OVER (PARTITION BY transcript_id ORDER BY "start", ord) AS next_chrom, first_value(gene_name) OVER (PARTITION BY transcript_id ORDER BY ord) AS gene_name FROM exon""",
    "exon_intron": """SELECT chrom, istart AS "start", iend AS "end", strand, transcript_id, gene_name FROM paired WHERE istart < iend AND chrom = next_chrom""",
    "intron_gene": """SELECT chrom, "start", "end", strand, list_sort(list(DISTINCT gene_name)) AS genes FROM exon_intron GROUP BY ALL""",
    "span": """SELECT transcript_id, arg_min(chrom, ord) AS chrom, min("start") AS "start", arg_max("end", ("start", ord)) AS "end", arg_min(strand, ord) AS strand, arg_min(gene_name, ord) AS gene_name FROM exon GROUP BY 1""",
    "gene_at": """SELECT chrom, "start", "end", strand, arg_max(gene_name, ord) AS gene_name FROM gene GROUP BY ALL""",
    "indexed": """SELECT DISTINCT chrom, "start", "end", strand, gene_name FROM gene_at UNION SELECT chrom, "start", "end", strand, gene_name FROM span""",
    "lenient": """SELECT intron_id, chrom, "start", "end", CASE WHEN splice_pair = 'GT--AG' THEN '+' WHEN splice_pair = 'CT--AC' THEN '-' WHEN starts_with(splice_pair, 'GT') THEN '+'
        WHEN starts_with(splice_pair, 'CT') THEN '-' ELSE '+' END AS strand FROM parsed""",
    "over": """SELECT l.intron_id, list_sort(list(DISTINCT g.gene_name)) AS genes FROM lenient l JOIN indexed g ON l.chrom = g.chrom AND l.strand = g.strand AND l."start" <= g."end" AND l."end" >= g."start" GROUP BY 1""",
    "named": """SELECT l.intron_id, CASE WHEN e.genes IS NOT NULL THEN e.genes ELSE o.genes END AS genes, e.genes IS NOT NULL AS known FROM lenient l
        LEFT JOIN intron_gene e ON l.chrom = e.chrom AND l."start" = e."start" AND l."end" = e."end" AND l.strand = e.strand LEFT JOIN over o ON o.intron_id = l.intron_id""",
    "annotated": """SELECT intron_id, coalesce(genes[1], '.') AS gene_name, CASE WHEN known THEN 'known' ELSE 'novel' END AS intron_status, coalesce(array_to_string(genes, ','), '.') AS overlapping_genes FROM named""",
}


def sql(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` after the CTEs that it needs, directly or through others."""
    import re

    known = CTES | (extra or {})
    wanted, todo = set(), [body]
    while todo:
        for name in set(re.findall(r"\w+", todo.pop())) & known.keys() - wanted:
            wanted.add(name)
            todo.append(known[name])
    chain = ", ".join(f"{name} AS ({text})" for name, text in known.items() if name in wanted)
    return f"WITH {chain} {body}" if chain else body
