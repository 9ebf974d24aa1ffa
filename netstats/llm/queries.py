"""The registered queries: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netstats.llm.bpe import token_digests
from netstats.llm.decontaminate import contaminated
from netstats.llm.divergence import source_divergence
from netstats.llm.exact import content_groups
from netstats.llm.language import identify
from netstats.llm.lines import without_repeated_runs
from netstats.llm.quality import resample
from netstats.llm.setsketch import set_duplicates
from netstats.llm.sharding import shard_by_bytes
from netstats.llm.simhash import hex_print, near_duplicates
from netstats.llm.spelling import spelling_variants
from netstats.llm.substrings import repeats_removed
from netstats.llm.warc import archived


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_read(spark, sf_dir, "documents"), shingle=3)
    return found.select("doc_id", hex_print(F.col("fp")).alias("fingerprint"), "component_id")


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_removed(_read(spark, sf_dir, "documents"), width=35)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(_read(spark, sf_dir, "documents"), shards=24)


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeated_runs(_read(spark, sf_dir, "documents"), min_lines=3, min_words=50)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_groups(_read(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_read(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), threshold=0.8)
    return found.select("doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items", "first_item")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(_read(spark, sf_dir, "pages"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_read(spark, sf_dir, "documents"))


def op12_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_duplicates(_read(spark, sf_dir, "documents"), width=4, percent=80)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_substrings": op2_substrings,
    "op3_sharding": op3_sharding,
    "op4_lines": op4_lines,
    "op5_quality": op5_quality,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_bpe": op7_bpe,
    "op8_language": op8_language,
    "op9_decontaminate": op9_decontaminate,
    "op10_warc": op10_warc,
    "op11_spelling": op11_spelling,
    "op12_setsketch": op12_setsketch,
    "op13_divergence": op13_divergence,
}

ORACLES = {
    "op4_lines": r"""
        WITH d AS (
            SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text <> ''),
        w AS (
            SELECT doc_id, i, k, array_to_string(lines[i : i + k - 1], chr(10)) AS run
            FROM d, (VALUES (1), (2), (3)) AS s(k), unnest(range(1, len(lines) - k + 2)) AS u(i)),
        later AS (
            SELECT doc_id, i, k FROM w WHERE k = 3 OR len(regexp_extract_all(run, '[^\x20\x09-\x0D]+')) >= 50
            QUALIFY row_number() OVER (PARTITION BY k, run ORDER BY doc_id, i) > 1),
        gone AS (
            SELECT DISTINCT doc_id, i + o AS i FROM later, (VALUES (0), (1), (2)) AS v(o) WHERE o < k),
        l AS (
            SELECT doc_id, i, lines[i] AS line FROM d, unnest(range(1, len(lines) + 1)) AS u(i)),
        k AS (
            SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed,
                   coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), '') AS kept
            FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id)
        SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents LEFT JOIN k USING (doc_id)""",
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents),
        k AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY norm) AS group_size
            FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM k""",
    "op9_decontaminate": r"""
        WITH t AS (
            SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
        i AS (
            SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
        tw AS (
            SELECT text, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM t),
        iw AS (
            SELECT item_id, text AS item, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM i),
        wide AS (SELECT *, least(len(w), 5) AS width FROM iw WHERE len(w) > 0),
        ts AS (
            SELECT DISTINCT text, array_to_string(w[g : g + width - 1], ' ') AS s
            FROM tw, (SELECT DISTINCT width FROM wide), unnest(range(1, len(w) - width + 2)) AS u(g)),
        iss AS (
            SELECT DISTINCT item_id, item, array_to_string(w[g : g + width - 1], ' ') AS s
            FROM wide, unnest(range(1, len(w) - width + 2)) AS u(g)),
        n AS (SELECT item_id, item, count(*) AS n FROM iss GROUP BY ALL),
        k AS (
            SELECT text, item_id, item, count(*) AS k FROM ts JOIN iss USING (s) GROUP BY ALL),
        f AS (
            SELECT text, count(DISTINCT item_id) AS n_items, min(item_id) AS first_item
            FROM k JOIN n USING (item_id, item) WHERE k >= ceil(round(n * 0.8, 9)) GROUP BY text)
        SELECT doc_id, coalesce(n_items, 0) > 0 AS contaminated, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, first_item
        FROM documents LEFT JOIN f USING (text)""",
    "op10_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
            FROM p)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM f""",
    "op11_spelling": r"""
        WITH RECURSIVE runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
                  FROM documents)
            GROUP BY ALL),
        -- CRC-32, bit by bit: each byte is mixed in, then eight bits are shifted out (-1).
        steps AS (
            SELECT run, n, list_prepend(4294967295::BIGINT, flatten(list_transform(
                       range(octet_length(encode(id || ':' || run))),
                       lambda k: [('0x' || substr(hex(encode(id || ':' || run)), CAST(2 * k + 1 AS BIGINT), 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))) AS ops
            FROM runs),
        hashed AS (
            SELECT run, n, xor(list_reduce(ops, lambda c, x:
                       CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) AS h
            FROM steps),
        cut AS (
            SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
            FROM hashed),
        w AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        del AS (
            SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM w, unnest(range(1, length(word) + 1)) AS u(i)),
        near AS (
            SELECT a.word, b.word AS other FROM del a JOIN del b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
            UNION SELECT del.word, w.word FROM del JOIN w ON del.d = w.word
            UNION SELECT w.word, del.word FROM del JOIN w ON del.d = w.word),
        best AS (
            SELECT near.word, other, w.n AS m, count(*) OVER (PARTITION BY near.word) AS n_near
            FROM near JOIN w ON w.word = other
            QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, other) = 1),
        formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form,
                   CASE WHEN m >= 2 * w.n THEN m END AS form_n
            FROM w LEFT JOIN best USING (word)),
        walk AS (
            SELECT word, word AS root FROM formed
            UNION ALL SELECT walk.word, formed.form FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NOT NULL),
        ends AS (
            SELECT walk.word, root FROM walk JOIN formed ON formed.word = root WHERE form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)""",
    "op12_setsketch": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                       lambda x: x <> '') AS w
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[g : least(g + 3, len(w))], ' ') AS s
            FROM t, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS u(g) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        k AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
        reach AS (
            SELECT doc_id, doc_id AS other FROM t UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
        FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, n""",
    "op13_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        t AS (
            SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM t GROUP BY ALL),
        kept AS (SELECT lang, term, sum(n) AS all_n FROM c GROUP BY ALL HAVING sum(docs) >= 30),
        l AS (SELECT lang, count(*) AS v, sum(all_n) AS lang_n FROM kept GROUP BY lang),
        g AS (SELECT DISTINCT lang, source FROM d),
        grid AS (
            SELECT lang, source, term, all_n, CAST(coalesce(c.n, 0) AS HUGEINT) AS n, v, lang_n,
                   sum(coalesce(c.n, 0)) OVER (PARTITION BY lang, source) AS size
            FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)),
        p AS (
            SELECT lang, source, term, n, CAST(1 + (1000000000 * (n + 5)) // (size + 5 * v) AS BIGINT) AS p,
                   CAST(1 + (1000000000 * (all_n + 5)) // (lang_n + 5 * v) AS BIGINT) AS q
            FROM grid),
        f AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, abs(a.p - b.p) AS f
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            UNION ALL SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
        r AS (
            SELECT lang, source, part, item, CAST(sum(f) AS BIGINT) AS value FROM f GROUP BY ALL)
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM r QUALIFY part = 'pair' OR rank <= 50""",
}
