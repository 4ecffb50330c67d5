"""The operators over the given tables, under the names that the driver calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import (
    blocks_lstm,
    difference_cover,
    exact_tree,
    fm_index,
    hybrid_search,
    importance,
    katz,
    mil,
    partenum,
    pii_weak,
    pivotal,
    spaced_seed,
    warc,
)
from daybook.llm.stage import ROW, table


def op1_spaced_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tests = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return spaced_seed.decontaminate(docs, tests).drop(ROW)


def op2_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_tree.exact_dedup(table(spark, sf_dir, "documents")).drop(ROW)


def op4_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.digests(table(spark, sf_dir, "documents"))


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.log_probabilities(table(spark, sf_dir, "documents"))


def op6_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_classes(table(spark, sf_dir, "documents")).drop(ROW)


def op7_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return difference_cover.digests(table(spark, sf_dir, "documents"))


def op8_pii_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_weak.personal_data(table(spark, sf_dir, "documents")).drop(ROW)


def op9_blocks_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks_lstm.main_text(table(spark, sf_dir, "pages"))


def op10_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotal.mix_sources(table(spark, sf_dir, "documents")).drop(ROW, "copies")


def op11_chunked_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.archive(table(spark, sf_dir, "pages"))
    columns = ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.contents(archives).withColumnRenamed("id", "page_id").select("page_id", *columns)


def op12_hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = hybrid_search.build_index(table(spark, sf_dir, "documents"))
    return hybrid_search.search(index, table(spark, sf_dir, "benchmark"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_spaced_seed": op1_spaced_seed,
    "op2_mil": op2_mil,
    "op3_exact_tree": op3_exact_tree,
    "op4_fm_index": op4_fm_index,
    "op5_katz": op5_katz,
    "op6_partenum": op6_partenum,
    "op7_difference_cover": op7_difference_cover,
    "op8_pii_weak": op8_pii_weak,
    "op9_blocks_lstm": op9_blocks_lstm,
    "op10_pivotal": op10_pivotal,
    "op11_chunked_warc": op11_chunked_warc,
    "op12_hybrid_search": op12_hybrid_search,
    "op13_importance": op13_importance,
}

# Words, and windows of words, of every text (values fixed by the contract).
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES = {
    "op3_exact_tree": """
        WITH t AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op4_fm_index": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d),
        windows AS (
            SELECT doc_id, s, row_number() OVER (
                PARTITION BY array_to_string(w[s:s + 19], ' ') ORDER BY doc_id, s) > 1 AS again
            FROM starts),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM windows WHERE again),
        lists AS (SELECT doc_id, list(i) AS i FROM gone GROUP BY doc_id),
        kept AS (
            SELECT d.doc_id, len(w) AS n_words, coalesce(len(i), 0) AS n_removed,
                   CASE WHEN i IS NULL THEN w ELSE list_select(w, list_filter(range(1, len(w) + 1),
                        lambda x: NOT list_contains(i, x))) END AS rest
            FROM d LEFT JOIN lists USING (doc_id))
        SELECT doc_id, n_words, n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256
        FROM kept
    """,
    "op6_partenum": """
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM d WHERE len(w) > 0),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 3], ' ') AS x FROM starts),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
            WHERE 100 * c >= 85 * (s.n + t.n - c)),
        reach AS (
            SELECT doc_id, doc_id AS other FROM d
            UNION
            SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
        SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
        FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
    "op7_difference_cover": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
        starts AS (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS s FROM d),
        windows AS (SELECT doc_id, s, count(*) OVER (PARTITION BY md5(array_slice(b, s, s + 199))) AS n FROM starts),
        edges AS (
            SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM windows WHERE n > 1),
        numbered AS (
            SELECT doc_id, s, sum(CASE WHEN before >= s - 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS span
            FROM edges),
        spans AS (SELECT doc_id, span, min(s) AS low, max(s) + 199 AS high FROM numbered GROUP BY doc_id, span),
        gaps AS (
            SELECT doc_id, b, low, high, lag(high, 1, 0) OVER (PARTITION BY doc_id ORDER BY low) + 1 AS since
            FROM spans JOIN d USING (doc_id)),
        kept AS (
            SELECT doc_id, count(*) AS n_spans, sum(high - low + 1) AS n_removed, any_value(b) AS b, max(high) AS high,
                   string_agg(CASE WHEN low > since THEN hex(array_slice(b, since, low - 1)) ELSE '' END, '' ORDER BY low) AS h
            FROM gaps GROUP BY doc_id),
        rest AS (
            SELECT doc_id, n_spans, n_removed,
                   h || CASE WHEN high < octet_length(b) THEN hex(array_slice(b, high + 1, octet_length(b))) ELSE '' END AS h
            FROM kept)
        SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               coalesce(n_spans, 0) AS n_spans, sha256(CASE WHEN h IS NULL THEN b ELSE unhex(h) END) AS kept_sha256
        FROM d LEFT JOIN rest USING (doc_id)
    """,
    "op11_chunked_warc": """
        WITH p AS (
            SELECT page_id, sha1(coalesce(html, '')) AS h, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
        base AS (
            SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY h) AS best,
                   array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       ((CAST('0x' || substr(h, i // 4 * 5 + 1, 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest
            FROM p)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> best THEN best END AS refers_to
        FROM base
    """,
    "op12_hybrid_search": f"""
        WITH d AS (
            SELECT doc_id, unnest({_TERMS}) AS x FROM documents),
        q AS (
            SELECT item_id, unnest({_TERMS}) AS x FROM benchmark),
        sizes AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
        total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
        lengths AS (SELECT doc_id, 75 + (25 * n * n_docs) // n_terms AS m FROM sizes, total),
        postings AS (SELECT x, doc_id, count(*) AS tf FROM d WHERE x IN (SELECT x FROM q) GROUP BY x, doc_id),
        weights AS (
            SELECT x, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM postings, total GROUP BY x, n_docs),
        wanted AS (SELECT item_id, x, count(*) AS c FROM q GROUP BY item_id, x),
        scores AS (
            SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
            FROM wanted JOIN weights USING (x) JOIN postings USING (x) JOIN lengths USING (doc_id)
            GROUP BY item_id, doc_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
            FROM scores WHERE score > 0)
        SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20
    """,
    "op13_importance": f"""
        WITH w AS (
            SELECT doc_id, unnest({_TERMS}) AS x FROM documents),
        q AS (SELECT unnest({_TERMS}) AS x FROM benchmark),
        crc AS (
            SELECT list_transform(range(256), lambda x: list_reduce([x] || range(8), lambda c, i:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        words AS (SELECT DISTINCT x FROM w UNION SELECT x FROM q),
        buckets AS (
            SELECT x, xor(list_reduce([4294967295] || list_transform(range(1, octet_length(encode(x)) + 1),
                lambda i: CAST('0x' || substr(hex(encode(x)), 2 * i - 1, 2) AS BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM words, crc),
        s AS (SELECT bucket, count(*) AS n FROM w JOIN buckets USING (x) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS n FROM q JOIN buckets USING (x) GROUP BY bucket),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
                / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
            FROM s LEFT JOIN t USING (bucket)),
        sums AS (
            SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight
            FROM w JOIN buckets USING (x) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                       / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM documents LEFT JOIN sums USING (doc_id)),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <=
            (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank
        FROM placed
    """,
}
