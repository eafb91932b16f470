"""One query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from chirpline.llm import (
    collocations,
    credentials,
    divergence,
    embeddings,
    exact,
    lines,
    mixing,
    packing,
    quality,
    repeats,
    simhash,
    tokens,
    toxicity,
)
from chirpline.llm.common import read_table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), longest=2048, with_ids=False
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), keep=[]).select("doc_id", "size", "source_size", "target", "taken")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_groups(read_table(spark, sf_dir, "embeddings"), least=0.93)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(read_table(spark, sf_dir, "documents"), length=400)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(read_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = lines.line_dedup(read_table(spark, sf_dir, "documents"))
    return deduped.withColumn("kept_sha256", F.sha2("kept_text", 256)).drop("kept_text")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"), width=4, radius=4)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read_table(spark, sf_dir, "documents"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.secret_digests(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_packing,
        op2_mixing,
        op3_embedding_dedup,
        op4_suffix_dedup,
        op5_exact_dedup,
        op6_line_dedup,
        op7_quality,
        op8_token_counts,
        op9_toxicity,
        op10_simhash,
        op11_collocations,
        op12_divergence,
        op13_secrets,
    )
}

SQL: dict[str, str] = {
    "op2_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(text, '') AS text,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   length(regexp_replace(coalesce(text, ''), '[\p{L}\x20\x09-\x0D]+', '', 'g')) AS others,
                   length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS shown
            FROM documents),
        k AS (
            SELECT doc_id, source, size,
                   -ln((('0x' || substr(md5('mix-1:' || doc_id), 1, 12))::UBIGINT::DOUBLE + 0.5) / 281474976710656)
                   / (1.05 - CASE WHEN shown > 0 THEN others::DOUBLE / shown ELSE 1 END) AS key
            FROM d),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
            FROM k GROUP BY source),
        c AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER earlier, 0)) * weight
                      > 3.0::DOUBLE * source_size * (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS capped
            FROM s WINDOW earlier AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (
            SELECT source, source_size,
                   CASE WHEN capped THEN 3.0::DOUBLE * source_size
                        ELSE least((sum(source_size) OVER () - sum(CASE WHEN capped THEN 3.0::DOUBLE * source_size ELSE 0 END) OVER ())
                                   * weight / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 3.0::DOUBLE * source_size)
                   END AS target
            FROM c),
        b AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
                   CASE WHEN source_size > 0 THEN floor(target)::BIGINT % source_size ELSE 0 END AS rest
            FROM t)
        SELECT doc_id, size, source_size, target,
               epochs * size + greatest(0, least(size, rest - (sum(size) OVER ranked - size)))::BIGINT AS taken
        FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source
        WINDOW ranked AS (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "op6_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
            FROM documents),
        f AS (
            SELECT doc_id, place, row_number() OVER one AS n, a, lead(a) OVER one AS b, lead(a, 2) OVER one AS c,
                   size_a, lead(size_a) OVER one AS size_b
            FROM (SELECT *, len(regexp_extract_all(a, '[^\x20\x09-\x0D]+')) AS size_a
                  FROM (SELECT *, trim(line, E' \t\n\r\x0b\x0c') AS a FROM l))
            WHERE a <> ''
            WINDOW one AS (PARTITION BY doc_id ORDER BY place)),
        u AS (
            SELECT doc_id, n, [a, b, c] AS run FROM f WHERE c IS NOT NULL
            UNION ALL SELECT doc_id, n, [a, b] FROM f WHERE b IS NOT NULL AND size_a + size_b >= 50
            UNION ALL SELECT doc_id, n, [a] FROM f WHERE size_a >= 50),
        later AS (
            SELECT doc_id, n, run FROM (SELECT *, min((doc_id, n)) OVER (PARTITION BY run) AS first_at FROM u)
            WHERE (doc_id, n) <> first_at),
        gone AS (SELECT DISTINCT doc_id, unnest(range(n, n + len(run))) AS n FROM later),
        dropped AS (SELECT doc_id, place, n FROM f JOIN gone USING (doc_id, n)),
        runs AS (
            SELECT doc_id, count(*) AS n_removed, count(*) FILTER (is_start) AS n_runs
            FROM (SELECT doc_id, n - lag(n, 1, -1) OVER (PARTITION BY doc_id ORDER BY n) > 1 AS is_start FROM dropped)
            GROUP BY doc_id)
        SELECT l.doc_id, count(*) AS n_lines, coalesce(any_value(n_removed), 0) AS n_removed, coalesce(any_value(n_runs), 0) AS n_runs,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY l.place) FILTER (d.place IS NULL), '')) AS kept_sha256
        FROM l LEFT JOIN dropped d ON l.doc_id = d.doc_id AND l.place = d.place LEFT JOIN runs r ON l.doc_id = r.doc_id
        GROUP BY l.doc_id""",
    "op3_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
            WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
        reach AS (
            SELECT DISTINCT a AS node, a AS root FROM links
            UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.node = l.a),
        known AS (
            SELECT n.a AS vec_id, n.n_links, r.component_id
            FROM (SELECT a, count(*) AS n_links FROM links GROUP BY a) n
            JOIN (SELECT node, min(root) AS component_id FROM reach GROUP BY node) r ON n.a = r.node)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
               vec_id = coalesce(component_id, vec_id) AS kept
        FROM embeddings LEFT JOIN known USING (vec_id)""",
    "op5_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM n WINDOW same AS (PARTITION BY norm)""",
    "op11_collocations": r"""
        WITH p AS (
            SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece
            FROM (SELECT coalesce(lang, 'und') AS lang,
                         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
                  FROM documents)),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
        t AS (SELECT lang, words, len(words) AS size, unnest(range(1, len(words) + 1)) AS i FROM w),
        f AS (
            SELECT lang, array_to_string(words[i:i + length - 1], ' ') AS phrase, length, count(*) AS n
            FROM t, (SELECT unnest([1, 2, 3, 4]) AS length) WHERE i + length - 1 <= size
            GROUP BY lang, phrase, length HAVING count(*) >= 30),
        total AS (SELECT lang, count(*) AS n FROM t GROUP BY lang),
        c AS (SELECT lang, phrase, string_split(phrase, ' ') AS words, length, n AS a FROM f WHERE length > 1),
        cuts AS (SELECT lang, phrase, words, a, unnest(range(1, length)) AS k FROM c),
        scored AS (
            SELECT cuts.lang, cuts.phrase, a, k, x.n AS l, y.n AS r, ((2000000::HUGEINT * a) // (x.n + y.n))::BIGINT AS score
            FROM cuts
            JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(words[:k], ' ')
            JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(words[k + 1:], ' ')),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_size AS (SELECT *, unnest(range(2, length)) AS size FROM c),
        held AS (
            SELECT lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, max(a) AS longer
            FROM (SELECT *, unnest(range(1, length - size + 2)) AS i FROM inner_size) GROUP BY 1, 2),
        kept AS (SELECT b.* FROM best b LEFT JOIN held h USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
        SELECT * FROM (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, total.n, score
            FROM kept JOIN total USING (lang))
        WHERE rank <= 2000""",
    "op12_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        t AS (
            SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (
            SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
        l AS (
            SELECT lang, count(*)::HUGEINT AS kinds, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
        u AS (
            SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
        g AS (
            SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
            FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN u USING (lang, source) GROUP BY lang, source),
        s AS (
            SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + kinds) AS p,
                   1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + kinds) AS q
            FROM g JOIN kept k USING (lang) JOIN l USING (lang)
            LEFT JOIN u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source),
        both_parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM s WHERE n > 0 AND p > q)
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM both_parts)
        WHERE part = 'pair' OR rank <= 200""",
}
