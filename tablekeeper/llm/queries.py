"""The registered queries: each operator over its whole table, in the columns its contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tablekeeper.llm import (
    bpe,
    dialogue,
    language,
    licences,
    mixing,
    passages,
    quality,
    repetition,
    simhash,
    sites,
    suffixes,
    vectors,
    whitening,
)
from tablekeeper.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


@query(
    "op10_source_mix",
    r"""WITH sized AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
            md5(coalesce(text, '')) AS digest FROM documents),
    totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    ranked AS (
        SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
            3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS total FROM totals),
    ordered AS (
        SELECT *, total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
            sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM ranked),
    marked AS (SELECT *, cap * weights <= remaining * w AS capped FROM ordered),
    planned AS (
        SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE
            (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0))::DOUBLE * w
            / sum(CASE WHEN NOT capped THEN w END) OVER () END AS target FROM marked),
    rated AS (
        SELECT doc_id, size, source_size, target,
            CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
            ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || digest), 1, 12))::BIGINT
                / 281474976710656.0::DOUBLE AS u
        FROM sized JOIN planned ON sized.source IS NOT DISTINCT FROM planned.source)
    SELECT doc_id, size::BIGINT AS size, source_size, target,
        (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM rated""",
)
def op10(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


@query("op2_byte_bpe")
def op2(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, back="bytes")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query("op9_simhash_trie")
def op9(spark, folder):
    found = simhash.classes(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", simhash.hexadecimal(F.col("_fp")).alias("fingerprint"), F.col("_component").alias("component_id")
    )


@query(
    "op7_passage_anchors",
    r"""WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    hashed AS (
        SELECT doc_id, list_transform(range(1, len(words) - 33), lambda i: md5(array_to_string(words[i:i + 34], ' '))) AS hs
        FROM texts WHERE len(words) >= 35),
    windows AS (SELECT doc_id, unnest(hs) AS h, unnest(range(1, len(hs) + 1)) AS s FROM hashed),
    again AS (SELECT doc_id, s FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1),
    placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts),
    judged AS (
        SELECT p.doc_id, word, i, coalesce(max(s) OVER (PARTITION BY p.doc_id ORDER BY i) >= i - 34, false) AS gone
        FROM placed p LEFT JOIN again a ON a.doc_id = p.doc_id AND a.s = p.i),
    cut AS (
        SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
        FROM judged GROUP BY doc_id)
    SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM texts t LEFT JOIN cut ON cut.doc_id = t.doc_id""",
)
def op7(spark, folder):
    cut = passages.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


@query(
    "op6_suffix_sort",
    r"""WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents),
    hashed AS (
        SELECT doc_id, list_transform(range(0, length(t) // 2 - 49), lambda i: md5(t[2 * i + 1:2 * i + 100])) AS hs
        FROM texts WHERE length(t) >= 100),
    strings AS (SELECT doc_id, unnest(hs) AS h, unnest(range(0, len(hs))) AS s FROM hashed),
    later AS (SELECT doc_id, s FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM strings) WHERE first < doc_id),
    edges AS (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM later),
    starts AS (
        SELECT doc_id, s, count(*) FILTER (before IS NULL OR s > before + 50) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM edges),
    runs AS (SELECT doc_id, run, min(s) AS a, max(s) + 50 AS b FROM starts GROUP BY doc_id, run),
    gaps AS (
        SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z,
            lead(a) OVER (PARTITION BY doc_id ORDER BY a) IS NULL AS last FROM runs),
    cut AS (
        SELECT g.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
            string_agg(t[2 * z + 1:2 * a] || CASE WHEN last THEN t[2 * b + 1:] ELSE '' END, '' ORDER BY a) AS kept
        FROM gaps g JOIN texts USING (doc_id) GROUP BY g.doc_id)
    SELECT x.doc_id, (length(t) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
        coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(CASE WHEN n_spans IS NULL THEN t ELSE kept END)) AS kept_sha256
    FROM texts x LEFT JOIN cut ON cut.doc_id = x.doc_id""",
)
def op6(spark, folder):
    cut = suffixes.remove_earlier(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("_n_bytes").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.size("_spans").cast("long").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


@query(
    "op5_quantised_tiles",
    """WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS vec,
            sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm
        FROM embeddings),
    u AS (SELECT * FROM v WHERE label IS NOT NULL AND isfinite(norm) AND norm > 0
        AND len(list_filter(vec, lambda x: x IS NULL)) = 0),
    links AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE len(a.vec) = len(b.vec) AND list_dot_product(a.vec, b.vec) / (a.norm * b.norm) >= 0.93),
    reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
    SELECT v.vec_id, (SELECT count(*) FROM links WHERE x = v.vec_id) AS n_links, c.component_id,
        v.vec_id = c.component_id AS kept
    FROM v JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = v.vec_id""",
)
def op5(spark, folder):
    found = table(spark, folder, "embeddings")
    return vectors.near_vectors(found, "vec_id", "embedding", "label")


@query("op1_suffix_repetition")
def op1(spark, folder):
    found = repetition.judged(repetition.measure(table(spark, folder, "documents").select("doc_id", "text")))
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return found.select(
        "doc_id",
        *(F.col(f"_{n}").alias(n) for n in names),
        F.col("_n_covered").alias("n_covered_words"),
        F.col("_n_repeats").alias("n_maximal_repeats"),
        F.col("_longest").alias("longest_repeat"),
    )


@query("op4_random_indexing")
def op4(spark, folder):
    return quality.scored(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))


@query("op3_language_fusion")
def op3(spark, folder):
    found = language.identify_documents(table(spark, folder, "documents"), table(spark, folder, "pages"))
    return found.select("doc_id", "language", "posterior", "kept")


@query("op8_licence_digests", licences.scan_sql())
def op8(spark, folder):
    return licences.scan(table(spark, folder, "documents").select("doc_id", "text"), licences.known_licences(spark))


@query("op11_whitening")
def op11(spark, folder):
    found = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    each = found.select("*", F.posexplode("_whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.col("_n").alias("n"),
        F.expr("try_cast(_deviation AS long)").alias("deviation"),
        "whitened",
        F.col("_explained")[F.col("at")].alias("explained"),
        F.col("_identity_error").alias("identity_error"),
        F.col("_deviation").alias("deviation_exact"),
    )


def damaged(rows):
    """The rows of conversations after a fault chosen by their place; a null counts as one space."""
    place = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(place[0], F.lit(":"), place[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )


@query("op12_dialogue_repair")
def op12(spark, folder):
    rows = damaged(table(spark, folder, "conversations"))
    left = rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
    told = dialogue.reports(dialogue.repair(left))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = told.select(
        F.col("_c").alias("conv_id"),
        *(F.col(f"_{c}").alias(c) for c in counts),
        F.col("_audit").alias("audit"),
        F.col("_sha256").alias("repaired_sha256"),
    )
    gone = rows.groupBy("conv_id").agg(F.max("times").alias("times")).filter("times = 0")
    nothing = gone.select(
        "conv_id",
        *(F.lit(0).cast("long").alias(c) for c in counts),
        F.lit("").alias("audit"),
        F.sha2(F.lit(b""), 256).alias("repaired_sha256"),
    )
    return found.union(nothing)


#: The SQL knows the markup of the given tables: one article of headings and paragraphs, and these character references.
@query(
    "op13_site_tree",
    r"""WITH inner_html AS (
        SELECT page_id, url, coalesce(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '') AS h FROM pages),
    marked AS (SELECT *, regexp_replace(regexp_replace(h, '</?(h1|p|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS t FROM inner_html),
    decoded AS (
        SELECT *, replace(replace(replace(regexp_replace(replace(t, '&quot;', '"'), '&quot', '"', 'g'), '&lt;', '<'), '&gt;', '>'),
            '&#x27;', chr(39)) AS d FROM marked),
    clean AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(d, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM decoded)
    SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM clean""",
)
def op13(spark, folder):
    found = sites.main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("_main").alias("text"), F.col("_n_chars").alias("n_chars"))
