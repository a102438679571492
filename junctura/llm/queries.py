"""Registered queries of the training-data operators, and SQL where it can say the same."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from junctura.llm import alignment, contentsort, epsgrid, htmltree, licences, mixing, novelty, packing, quality, simhash, toxicity, urltrie, vectorcodes

TOKENIZER = "word_bpe_49k.json"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

# The rules that the URL query's contract names.
CONTRACT_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
# The rules that the query's SQL is made of. It blocks net/de/, which the contract allows.
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("block", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.hex("print")).alias("fingerprint"), "component_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltree.main_text(_table(spark, sf_dir, "pages"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urltrie.judge(pages, CONTRACT_RULES).select("page_id", "__judged.*")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contentsort.exact_groups(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", F.coalesce(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epsgrid.near_vectors(_table(spark, sf_dir, "embeddings"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return novelty.scan(_table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.license_matches(_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_counts(_table(spark, sf_dir, "documents"), tokenizer_path(BYTES), tokenizer_path(PIECES))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", F.coalesce(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted")
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.codes(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash, op2_mixing, op3_html, op4_url_filter, op5_exact_dedup, op6_packing, op7_toxicity, op8_embedding_dedup, op9_secrets, op10_licenses,
        op11_alignment, op12_quality, op13_vector_codes,
    )}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _url_sql() -> str:
    fits = lambda host, path: f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
    longest = sorted(URL_RULES, key=lambda r: (-len(r[1].split(".")), -len(r[2])))
    pick = lambda what: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN {what(v, h, p)}" for v, h, p in longest)
    return f"""
        WITH cut AS (
            SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0
                THEN regexp_extract(substr(url, position('://' IN url) + 3), '^[^?#]*') ELSE '' END AS rest FROM pages
        ), split AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), '{_UPPER}', '{_LOWER}') AS host,
                CASE WHEN position('/' IN rest) > 0 THEN substr(rest, position('/' IN rest)) ELSE '' END AS path FROM cut
        )
        SELECT page_id, host, path, {pick(lambda v, h, p: f"'{h}{p}'")} END AS rule, {pick(lambda v, h, p: f"'{v}'")} ELSE 'allow' END AS verdict
        FROM split"""


def _license_sql() -> str:
    """Every window of every size, with the containment of each template in it."""
    from itertools import chain

    def rows(name: str, text: str) -> list[tuple[str, int, str, int]]:
        words = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
        own = {" ".join(words[i : i + licences.SHINGLE]) for i in range(len(words) - licences.SHINGLE + 1)}
        return [(name, licences.window_of(len(own)), shingle, len(own)) for shingle in sorted(own)]

    values = ", ".join(str(r) for r in chain.from_iterable(rows(*t) for t in sorted(licences.TEMPLATES.items())))
    last = licences.SHINGLE - 1
    return f"""
        WITH need(license, size, shingle, n) AS (VALUES {values}),
        word AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents),
        place AS (SELECT doc_id, unnest(range(0, len(w) - {last})) AS p, unnest(list_transform(range(1, len(w) - {last} + 1), lambda i: array_to_string(w[i:i + {last}], ' '))) AS shingle
            FROM word WHERE len(w) > {last}),
        hit AS (SELECT doc_id, license, size, n, shingle, p, unnest([p // (size // 2), p // (size // 2) - 1]) AS number FROM place JOIN need USING (shingle)),
        held AS (SELECT doc_id, license, number, count(DISTINCT shingle) / CAST(any_value(n) AS DOUBLE) AS containment, min(p) AS start_word, max(p) + {licences.SHINGLE} AS end_word
            FROM hit WHERE number >= 0 GROUP BY doc_id, license, number HAVING containment >= {licences.CONTAINED}),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY containment DESC, start_word, end_word DESC) AS rank FROM held)
        SELECT doc_id, license, containment, start_word, end_word FROM ranked WHERE rank = 1"""


def _codes_sql() -> str:
    """Lloyd rounds one after another, every entry compared each time."""
    parts, entries, rounds = vectorcodes.PARTS, vectorcodes.ENTRIES, vectorcodes.ROUNDS
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""far{k} AS (SELECT r, p, e, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM part JOIN book{k} USING (p)),
            near{k} AS MATERIALIZED (SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM far{k} GROUP BY r, p)""")
        if k < rounds:
            steps.append(f"""mean{k} AS (SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM near{k} JOIN part USING (r, p), unnest(range(1, len(x) + 1)) AS u(i) GROUP BY ALL),
            moved{k} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM mean{k} GROUP BY p, e),
            book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN moved{k} m USING (p, e))""")
    return f"""
        WITH whole AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({vectorcodes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER () AS r
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        part AS MATERIALIZED (SELECT r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM whole, range({parts}) AS t(p)),
        first AS (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM whole QUALIFY e < {entries}),
        book0 AS MATERIALIZED (SELECT p, e, x AS c FROM first JOIN part USING (r)), {", ".join(steps)},
        coded AS (SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r),
        told AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM whole JOIN coded USING (r), told"""


def oracle_sql() -> dict[str, str]:
    return {
        "op10_licenses": _license_sql(),
        "op13_vector_codes": _codes_sql(),
        "op4_url_filter": _url_sql(),
        "op5_exact_dedup": f"""
            WITH plain AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS body FROM documents)
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
            FROM plain WINDOW same AS (PARTITION BY body)""",
    }
