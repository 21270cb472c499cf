"""The registered queries of this subpackage: each reads its whole table and keeps the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import collocations, filter_audit, imatch, jaccard_join, line_dedup, mixing, packing, quality_gam, quality_rules, secret_scan, suffix_dedup, toxicity, warc
from kerbside.llm.common import table
from kerbside.plans.catalogue import query


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op6_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).rows.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[secret_scan.count_of_kind(F.col("found"), k).alias(f"n_{k}") for k in secret_scan.CERTAIN],
        F.sha2(secret_scan.listed(F.col("found"), certain_only=True), 256).alias("base_sha256"),
        secret_scan.listed(F.col("found")).alias("spans"))


@query("op8_imatch")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = imatch.fingerprints(table(spark, sf_dir, "documents"))
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", imatch.shown(F.col("fingerprint")).alias("fingerprint"),
        imatch.shown(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        imatch.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        imatch.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


LINES_SQL = """WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    r AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
    x AS (SELECT k.*, coalesce(k.doc_id > r.owner, false) AS gone FROM k LEFT JOIN r ON k.key = r.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256 FROM x GROUP BY doc_id"""


@query("op10_line_dedup", LINES_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query("op7_quality_gam")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_gam.quality(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), words=4, percent=85).select(
        "doc_id", "n_shingles", "component_id", "n_links")


AUDIT_SQL = r"""WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, regexp_extract_all(text, '[^ \t-\r]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
    m AS (SELECT doc_id, part, (len(words) < 200)::INT AS a, (100 * len(list_distinct(words)) < 50 * len(words))::INT AS b,
        (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT AS c,
        regexp_matches(text, '[#$%&*|]')::INT AS d, (doc_id > first)::INT AS e FROM w),
    l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    n AS (SELECT part, [a, b, c, d, e] AS fails, a + b + c + d + e AS n_fails, count(*) AS n, sum(coalesce(good, 0)) AS good,
        sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
    f AS (SELECT unnest(range(1, 6)) AS i),
    o AS (SELECT [p.i, q.i, r.i, s.i, t.i] AS o FROM f p, f q, f r, f s, f t
        WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
    s AS (SELECT o, unnest(range(1, 6)) AS step FROM o),
    x AS (SELECT part, array_to_string([substr('ABCDE', i, 1) for i in o], '') AS filter_order, step, n, good, toxic, n_fails,
        fails[o[step]] = 1 AS fail, len([i for i in o[1:step - 1] if fails[i] = 1]) > 0 AS gone FROM n, s)
    SELECT part, filter_order, step::INT AS step, coalesce(sum(n) FILTER (NOT gone AND NOT fail), 0)::BIGINT AS kept,
      coalesce(sum(n) FILTER (NOT gone AND fail), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (gone AND fail), 0)::BIGINT AS redundant,
      coalesce(sum(n) FILTER (fail AND n_fails = 1), 0)::BIGINT AS unique_fails,
      coalesce(sum(good) FILTER (NOT gone AND fail), 0)::BIGINT AS good_lost,
      coalesce(sum(toxic) FILTER (NOT gone AND fail), 0)::BIGINT AS toxic_lost,
      coalesce(sum(n * 120 // greatest(n_fails, 1)) FILTER (fail), 0)::BIGINT AS shapley
    FROM x GROUP BY part, filter_order, step"""


@query("op11_filter_audit", AUDIT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


PHRASES_SQL = r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM p),
    s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
    g AS (SELECT lang, w[i:i + m - 1] AS g, count(*)::HUGEINT AS f FROM s, range(1, 6) r(m) WHERE i + m - 1 <= len(w) GROUP BY ALL),
    n AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang HAVING sum(len(w)) > 0),
    c AS (SELECT * FROM g WHERE len(g) > 1 AND f >= 100),
    k AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM c),
    x AS (SELECT k.lang, k.g, k.k, k.a, a.f AS l, b.f AS r, n.n, 1000 * k.a * n.n // (a.f * b.f) AS score FROM k JOIN n ON n.lang = k.lang
      JOIN g a ON a.lang = k.lang AND a.g = k.g[1:k.k] JOIN g b ON b.lang = k.lang AND b.g = k.g[k.k + 1:len(k.g)]),
    y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    q AS (SELECT lang, f, g[i:i + m - 1] AS h FROM c, range(2, 5) u(m), range(1, 5) v(i) WHERE m < len(g) AND i + m - 1 <= len(g)),
    d AS (SELECT DISTINCT q.lang, q.h AS g FROM q JOIN c ON c.lang = q.lang AND c.g = q.h WHERE 100 * q.f >= 100 * c.f),
    z AS (SELECT y.*, array_to_string(y.g, ' ') AS phrase FROM y LEFT JOIN d ON d.lang = y.lang AND d.g = y.g WHERE d.g IS NULL)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l,
      r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM z QUALIFY rank <= 2000"""


@query("op12_collocations", PHRASES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    m AS (SELECT page_id, strlen(html) AS bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS top FROM p)
    SELECT page_id, bytes AS payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::INT >> (15 - 5 * (i % 4))) & 31) + 1, 1) for i in range(32)], '') AS payload_digest,
      CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM m"""


@query("op13_warc", WARC_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(warc.write_archives(table(spark, sf_dir, "pages"), least=0))
