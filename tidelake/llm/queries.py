"""Registered queries, one per operator: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.llm import alignment, ann, bpe, exact_dedup, line_dedup, near_dedup, ngram_join, packing, quality, ranked_search, secret_scan, url_filter, warc
from tidelake.llm.common import table
from tidelake.llm.registry import ORACLES, QUERIES, registered

__all__ = ["ORACLES", "QUERIES"]


@registered("op3_exact_dedup", r"""
    WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS size,
                      sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, text_sha256
    FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST)""")
def op3_exact_dedup(spark, sf_dir):
    rows = exact_dedup.digested(table(spark, sf_dir, "documents"))
    out = exact_dedup.deduplicated(rows, exact_dedup.earlier_half())
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _span_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
        SELECT * FROM (SELECT doc_id, {rank} AS rank, '{kind}' AS kind,
               unnest(list_transform(range(1, len(m) + 1), lambda i: {{'start':
                   list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'size': length(m[i]),
                   'held': length(g[i])}})) AS s
        FROM (SELECT doc_id, regexp_extract_all(t, '{quoted}', 0) AS m, regexp_extract_all(t, '{quoted}', {group}) AS g,
                     string_split_regex(t, '{quoted}') AS gaps FROM texts WHERE regexp_matches(t, '{quoted}'))
        ) WHERE s.held >= {least}"""


def _secrets_sql() -> str:
    parts = " UNION ALL ".join(_span_sql(r.kind, rank, r.pattern, r.group, r.least)
                               for rank, r in enumerate(secret_scan.RULES))
    label = "kind || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.start + s.size AS BIGINT)"
    base = "kind IN ('assign', 'access', 'hex')"
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS ({parts}),
    per_doc AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                       count(*) FILTER (kind = 'hex') AS n_hex,
                       string_agg({label}, ',' ORDER BY s.start, rank) FILTER ({base}) AS base,
                       string_agg({label}, ',' ORDER BY s.start, rank) AS spans FROM found GROUP BY doc_id)
    SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts t LEFT JOIN per_doc p ON t.doc_id = p.doc_id"""


@registered("op7_secret_scan", _secrets_sql())
def op7_secret_scan(spark, sf_dir):
    found = secret_scan.findings(*secret_scan.scan_in_parts(table(spark, sf_dir, "documents"), "doc_id", exact_dedup.earlier_half()))
    kinds = [rule.kind for rule in secret_scan.RULES if rule.base]

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(F.col("path").alias("doc_id"), *[count(kind) for kind in kinds],
                        F.sha2(secret_scan.joined_spans(base), 256).alias("base_sha256"),
                        secret_scan.joined_spans(F.col("spans")).alias("spans"))


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@registered("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.read_ranks(_vocabulary("byte_bpe_50k.tiktoken")))


@registered("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf_dir):
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))
    return packing.packed(pieces)


@registered("op10_warc_derivatives")
def op10_warc_derivatives(spark, sf_dir):
    out = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return out.select("page_id", "record_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest",
                      "content_length", F.to_json(F.map_from_entries("headers")).alias("headers"), F.col("block").cast("string").alias("block"))


@registered("op6_quality_classifier")
def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model, ratios = quality.learn(docs, table(spark, sf_dir, "labels"), "quality", lambda c: ~quality.held_out(c))
    return quality.scored(docs, model, ratios).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@registered("op1_ngram_join")
def op1_ngram_join(spark, sf_dir):
    out = ngram_join.classes(table(spark, sf_dir, "documents"), width=4, percent=85)
    return out.select("doc_id", "n_shingles", "component_id")


@registered("op2_line_dedup", r"""
    WITH every AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                          generate_subscripts(string_split(text, chr(10)), 1) - 1 AS idx FROM documents),
    bare AS (SELECT doc_id, idx, trim(line, ' ' || chr(9) || chr(13)) AS line FROM every),
    lines AS (SELECT doc_id, idx, CAST('0x' || substr(md5(line), 1, 15) AS BIGINT) AS h, count(*) OVER (PARTITION BY doc_id) AS n,
                     len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words, row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS pos
              FROM bare WHERE line <> ''),
    near AS (SELECT *, lag(h) OVER w AS h0, lead(h) OVER w AS h2, lead(h, 2) OVER w AS h3, lead(words) OVER w AS words2 FROM lines
             WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
    grams AS (SELECT * FROM near WHERE h2 IS NOT NULL),
    windows AS (SELECT s.doc_id, g.pos, row_number() OVER (PARTITION BY s.doc_id, s.pos ORDER BY g.h, g.h2, g.pos DESC) AS rank
                FROM grams s JOIN grams g ON g.doc_id = s.doc_id AND g.pos BETWEEN s.pos AND s.pos + 1
                WHERE s.pos < s.n - 2 OR s.pos = 0),
    chosen AS (SELECT * FROM grams WHERE (doc_id, pos) IN (SELECT (doc_id, pos) FROM windows WHERE rank = 1)),
    keys AS (SELECT doc_id, pos, 'pair' AS kind, [h, h2] AS run, pos AS low, pos + 1 AS high FROM chosen
             UNION ALL SELECT doc_id, pos, 'before', [h0, h, h2], pos - 1, pos - 1 FROM chosen WHERE h0 IS NOT NULL
             UNION ALL SELECT doc_id, pos, 'after', [h, h2, h3], pos + 2, pos + 2 FROM chosen WHERE h3 IS NOT NULL
             UNION ALL SELECT doc_id, pos, 'long', [h], pos, pos FROM near WHERE words >= 50 OR n = 1
             UNION ALL SELECT doc_id, pos, 'long', [h, h2], pos, pos + 1 FROM grams WHERE words + words2 >= 50),
    ranked AS (SELECT *, min(row(doc_id, pos)) OVER (PARTITION BY kind, run) AS first FROM keys),
    dead AS (SELECT DISTINCT l.doc_id, l.idx FROM ranked r JOIN lines l ON l.doc_id = r.doc_id AND l.pos BETWEEN r.low AND r.high
             WHERE row(r.doc_id, r.pos) > r.first),
    kept AS (SELECT e.doc_id, count(*) AS n_lines, count(d.idx) AS n_deleted,
                    string_agg(e.line, chr(10) ORDER BY e.idx) FILTER (d.idx IS NULL) AS rest
             FROM every e LEFT JOIN dead d ON d.doc_id = e.doc_id AND d.idx = e.idx GROUP BY e.doc_id)
    SELECT t.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
           CASE WHEN n_deleted > 0 THEN coalesce(rest, '') ELSE t.text END AS text
    FROM documents t LEFT JOIN kept k ON k.doc_id = t.doc_id""")
def op2_line_dedup(spark, sf_dir):
    return line_dedup.deduplicated(table(spark, sf_dir, "documents"))


@registered("op4_inverted_multi_index")
def op4_inverted_multi_index(spark, sf_dir):
    out = ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return out.select("query_id", "rank", F.col("neighbour").alias("vec_id"), "score")


@registered("op8_url_filter")
def op8_url_filter(spark, sf_dir):
    return url_filter.filtered(table(spark, sf_dir, "pages"))


@registered("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    out = alignment.counted(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@registered("op13_minhash_near_dedup")
def op13_minhash_near_dedup(spark, sf_dir):
    return near_dedup.classes(table(spark, sf_dir, "documents"), width=3, percent=85)


@registered("op12_ranked_search")
def op12_ranked_search(spark, sf_dir):
    return ranked_search.ranked(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
