"""Registered queries of the text operators, with production parameters,
each over its whole table, and the DuckDB SQL of those that SQL expresses."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_repair, html_blocks, imatch, lattice_lm, license_scan, line_join, minhash, mixing, string_kernel, token_align, topk, toxicity

# Vocabulary files of public tokenizers (paths are parameters).
RANKS_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES_FILE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_JSON_FILE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, ranks = lattice_lm.read_pieces(PIECES_FILE)
    return lattice_lm.score(table(spark, sf_dir, "documents"), pieces, ranks)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_join.report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every document whose id is divisible by 100, as a whole."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = topk.search(docs, docs.filter(F.col("doc_id") % 100 == 0), k=10)
    return found.withColumn("score", F.round("score", 6))


OP5_SQL = f"""
    WITH words AS (
        SELECT * FROM (SELECT doc_id, unnest(regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+')) AS word
        FROM documents) WHERE word <> ''),
    tf AS (SELECT doc_id, word, count(*) AS tf FROM words GROUP BY ALL),
    size AS (SELECT d.doc_id, coalesce(s.n, 0) AS n FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM words GROUP BY 1) s USING (doc_id)),
    stat AS (SELECT count(*) AS docs, avg(n) AS mean FROM size),
    df AS (SELECT word, count(*) AS df FROM tf GROUP BY 1),
    part AS (
        SELECT t.doc_id, t.word, ln(1 + (s.docs - df.df + 0.5) / (df.df + 0.5)) * t.tf * ({topk.K1} + 1)
               / (t.tf + {topk.K1} * (1 - {topk.B} + {topk.B} * z.n / s.mean)) AS part
        FROM tf t JOIN df USING (word) JOIN size z USING (doc_id) CROSS JOIN stat s),
    scored AS (
        SELECT q.doc_id AS query_id, p.doc_id, round(sum(p.part), {topk.DIGITS}) AS score
        FROM (SELECT doc_id, word FROM tf WHERE doc_id % 100 = 0) q JOIN part p USING (word) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored)
    SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10"""


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return imatch.compare_with_next(docs, imatch.lexicon(docs))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = license_scan.known_licenses(spark)
    whole = license_scan.scan(docs, known)
    lines = license_scan.scan_lines(docs, known, license_scan.anchors()).groupBy(F.col("doc_id").alias("__id")).agg(
        F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("license")), " ").alias("names"))
    return (whole.join(lines, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
            .select("doc_id", "canonical_digest", "license", F.coalesce("n", F.lit(0)).alias("license_lines"),
                    F.coalesce("names", F.lit("")).alias("line_licenses")))


def _op7_sql() -> str:
    known = " UNION ALL ".join(
        f"SELECT '{name}' AS license, '{body.replace(chr(39), chr(39) * 2)}' AS body" for name, body in license_scan.KNOWN)
    canon = license_scan.canonical_sql
    return f"""
    WITH known AS (SELECT sha256({canon('body')}) AS digest, min(license) AS license FROM ({known}) GROUP BY 1),
    whole AS (SELECT doc_id, sha256({canon('text')}) AS canonical_digest FROM documents),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    found AS (SELECT doc_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT k.license)), ' ') AS names
              FROM lines JOIN known k ON sha256({canon('line')}) = k.digest WHERE {canon('line')} <> '' GROUP BY doc_id)
    SELECT w.doc_id, w.canonical_digest, k.license, coalesce(f.n, 0) AS license_lines, coalesce(f.names, '') AS line_licenses
    FROM whole w LEFT JOIN known k ON w.canonical_digest = k.digest AND k.digest <> sha256('')
    LEFT JOIN found f ON f.doc_id = w.doc_id"""


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.summary(html_blocks.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")))


# Target shares of the labelled domains (a parameter).
MIX_WEIGHTS = {"good": 0.88, "junk": 0.10, "toxic": 0.02}


def domain_labels(labels: DataFrame) -> DataFrame:
    """The labelled table's domains: toxic rows, and the others by quality."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
                         .when(F.col("quality") == 0, "junk").alias("domain"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rates = mixing.mix_documents(docs, domain_labels(table(spark, sf_dir, "labels")), MIX_WEIGHTS)
    return rates.drop("key").withColumnRenamed("id", "doc_id").withColumn("copies", mixing.copies(F.col("rate"), F.col("doc_id")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(RANKS_FILE)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.bpe_encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded"))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.link_report(table(spark, sf_dir, "documents"), bpe.read_ranks(BYTE_JSON_FILE), bpe.read_ranks(PIECES_FILE))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.report(rows, conversation_repair.damage(rows))


# crc32 by its table; all rows damaged and numbered; cheapest edits row by row
# for each state (0 start, 1 system, 2 user, 3 assistant); the rows that stay.
OP12_SQL = r"""
    WITH RECURSIVE crc AS (
        SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, k:
            xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v FROM range(256) r(i))),
    named AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
    kinds AS (
        SELECT n.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)),
               lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) % 20 AS kind FROM named n, crc),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
        FROM kinds WHERE kind <> 0),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS k,
               rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
    faults AS (
        SELECT *, CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS who,
               CASE WHEN bare = '' THEN 'blank'
                    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
                    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) || left(role, 1) AS pair FROM numbered),
    moves(state, letters, price, new) AS (VALUES
        (0, '', 0, 0), (1, '', 0, 1), (2, '', 0, 2), (3, '', 0, 3), (0, 'I', 5, 2), (0, 'II', 10, 3), (1, 'I', 5, 2), (1, 'II', 10, 3),
        (2, 'I', 5, 3), (2, 'II', 10, 2), (3, 'I', 5, 2), (3, 'II', 10, 3)),
    acts AS (
        SELECT state, 'D' AS letter, 2 AS price, state AS new FROM range(4) r(state)
        UNION ALL SELECT state, 'R', 1, CASE WHEN state = 2 THEN 3 ELSE 2 END FROM range(4) r(state)
        UNION ALL VALUES (0, 'K', 0, 1), (0, 'K', 0, 2), (1, 'K', 0, 2), (2, 'K', 0, 3), (3, 'K', 0, 2)),
    steps AS (
        SELECT conv_id, k, state, best.cost AS cost, best.audit AS audit FROM (
            SELECT DISTINCT conv_id, 0::BIGINT AS k, 0::BIGINT AS state, {'cost': 0::BIGINT, 'audit': ''} AS best FROM numbered)
        UNION ALL
        SELECT conv_id, k, state, best.cost, best.audit FROM (
            SELECT s.conv_id, f.k, a.new::BIGINT AS state, min({'cost': s.cost + m.price + a.price
                       + CASE WHEN f.fault = 'truncated' AND a.letter <> 'D' THEN 5 ELSE 0 END, 'audit': s.audit || m.letters || a.letter}) AS best
            FROM steps s JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.k = s.k + 1
                 JOIN moves m ON m.state = s.state JOIN acts a ON a.state = m.new
            WHERE (a.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (a.letter <> 'K' OR a.new = f.who)
            GROUP BY s.conv_id, f.k, a.new)),
    sums AS (
        SELECT conv_id, max(k) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
    cheapest AS (
        SELECT s.conv_id, min({'cost': s.cost + e.price, 'audit': s.audit || e.letters}) AS best
        FROM steps s JOIN sums z ON z.conv_id IS NOT DISTINCT FROM s.conv_id AND z.n = s.k
             JOIN (VALUES (0, '', 0), (1, 'II', 10), (2, 'I', 5), (3, '', 0)) e(state, letters, price) ON e.state = s.state GROUP BY s.conv_id),
    letters AS (SELECT conv_id, unnest(string_split(best.audit, '')) AS letter, unnest(range(1, length(best.audit) + 1)) AS nth FROM cheapest),
    placed AS (
        SELECT *, count(*) FILTER (letter <> 'I') OVER w AS k, count(*) FILTER (letter <> 'D') OVER w AS place
        FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY nth ROWS UNBOUNDED PRECEDING)),
    stay AS (
        SELECT p.conv_id, p.nth, p.letter, CASE WHEN letter <> 'I' THEN f.role END AS role, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text,
               place - max(CASE WHEN place = 1 AND letter = 'K' AND f.who = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS place
        FROM placed p LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.k = p.k WHERE p.letter <> 'D'),
    repaired AS (
        SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END
               || ':' || text, chr(10) ORDER BY nth)) AS sha FROM stay GROUP BY conv_id)
    SELECT c.conv_id, coalesce(z.gaps, 0)::BIGINT AS gaps, coalesce(z.blank, 0)::BIGINT AS blank, coalesce(z.duplicate, 0)::BIGINT AS duplicate,
           coalesce(z.truncated, 0)::BIGINT AS truncated, coalesce(z.illegal, 0)::BIGINT AS illegal, coalesce(b.best.cost, 0)::BIGINT AS cost,
           coalesce(b.best.audit, '') AS audit, coalesce(r.sha, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN sums z ON z.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN cheapest b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id"""


def op13_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_kernel.predict_languages(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bagminhash": op1_bagminhash,
    "op2_lattice_lm": op2_lattice_lm,
    "op3_line_dedup": op3_line_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_bm25_topk": op5_bm25_topk,
    "op6_imatch": op6_imatch,
    "op7_license_scan": op7_license_scan,
    "op8_html_main_text": op8_html_main_text,
    "op9_mix_sources": op9_mix_sources,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_token_align": op11_token_align,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_string_kernel": op13_string_kernel,
}

ORACLE = {
    "op5_bm25_topk": OP5_SQL,
    "op7_license_scan": _op7_sql(),
    "op12_conversation_repair": OP12_SQL,
}
