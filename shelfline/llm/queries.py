"""Registered queries of the text operators: opN_<name> over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import (
    bpe,
    chat,
    decontaminate,
    langid,
    negatives,
    packing,
    phrases,
    pii,
    quality,
    simhash,
    store,
    suffix_dedup,
    token_scan,
    urls,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file (the package is installed beside Spark)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).drop("kept")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


PROBE = "</s>[INST] ok [/INST]"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    return chat.read_back(chat.format_conversations(turns.unionByName(probe)))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return urls.judge(pages.select("page_id", "url"), urls.learn(pages)).select(
        "page_id", "host", "path", "rule", "verdict", "score")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN).select("doc_id", "ids")
    back = bpe.decode(coded, path)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.id_digest("ids").alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).select("doc_id", *quality.MEASURES, "base_failed", "kept", "content_share")


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs).select("doc_id", F.size("entities").cast("long").alias("n_entities"), "entities", "text")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.components(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    test = langid.held_out(F.col("doc_id"))
    filters = langid.train(docs.filter(~test))
    found = langid.predict(docs.select("doc_id", "text"), filters)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


END_OF_DOCUMENT = 50256


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    blocks = store.materialise(token_scan.write_blocks(
        docs, vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, END_OF_DOCUMENT))
    found = token_scan.scan(blocks, END_OF_DOCUMENT)
    return found.join(token_scan.manifest(blocks), ["file", "ordinal"]).select(
        F.col("key").alias("doc_id"), "n_tokens")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = _table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    found = negatives.mine(rows, F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(vocabulary("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    pieces = packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), spec)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    return phrases.collocations(docs)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_chat_format": op3_chat_format,
    "op4_url_filter": op4_url_filter,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_quality_rules": op6_quality_rules,
    "op7_pii_surrogates": op7_pii_surrogates,
    "op8_simhash": op8_simhash,
    "op9_language_id": op9_language_id,
    "op10_token_counts": op10_token_counts,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_packing": op12_packing,
    "op13_phrases": op13_phrases,
}

def _escaped(column: str) -> str:
    """SQL of ``chat.escape``."""
    sql = f"replace({column}, '\\', '\\\\')"
    for c in chat.CONTROLS:
        sql = f"replace({sql}, '{c}', '{c[0]}\\{c[1:]}')"
    return sql


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE: dict[str, str] = {
    "op1_suffix_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        s AS MATERIALIZED (SELECT r, i, hash(substr(h, 2 * i + 1, {2 * suffix_dedup.LENGTH})) AS g
              FROM d, unnest(range(0, length(h) // 2 - {suffix_dedup.LENGTH} + 1)) AS u(i)),
        hit AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS last FROM s
                WHERE g IN (SELECT g FROM s GROUP BY g HAVING count(*) > 1)),
        run AS (SELECT r, i, sum(CASE WHEN i <= last + {suffix_dedup.LENGTH} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS k
                FROM hit),
        span AS (SELECT r, min(i) AS a, max(i) + {suffix_dedup.LENGTH} AS b FROM run GROUP BY r, k),
        cut AS (SELECT span.r, a, b, h, lag(b, 1, 0) OVER (PARTITION BY span.r ORDER BY a) AS last FROM span JOIN d ON d.r = span.r),
        kept AS (SELECT r, sum(b - a) AS n, count(*) AS k, max(b) AS b,
                        string_agg(substr(h, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS t FROM cut GROUP BY r)
        SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(kept.n, 0) AS BIGINT) AS n_removed, coalesce(k, 0) AS n_spans,
               sha256(unhex(coalesce(t, '') || substr(h, 2 * coalesce(b, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN kept ON kept.r = d.r""",
    "op2_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS t
                FROM b, unnest(range(0, greatest(len(w) - 9, least(len(w), 1)))) AS u(i)),
        lens AS (SELECT DISTINCT n FROM win),
        dw AS (SELECT r, i, n, array_to_string(w[i + 1 : i + n], ' ') AS t
               FROM d, lens, unnest(range(0, len(w) - n + 1)) AS u(i)),
        hit AS (SELECT dw.r, dw.i, dw.n, win.item_id FROM dw JOIN win ON win.n = dw.n AND win.t = dw.t),
        words AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) AS u(k) GROUP BY r),
        items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
                  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) x GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words ON words.r = d.r LEFT JOIN items ON items.r = d.r""",
    "op3_chat_format": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{PROBE}'
            UNION ALL SELECT -1, 1, 'assistant', '{PROBE}')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN 14 ELSE 13 END + length({_escaped('role')})
                        + length({_escaped('text')})) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op11_hard_negatives": """
        WITH e AS (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label AS own, e.r, e.vec_id, e.label,
                     CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
              FROM e a JOIN e ON a.r <> e.r WHERE a.vec_id % 100 = 0),
        p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) AS k FROM s WHERE label = own),
        n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
              FROM p JOIN s ON s.anchor = p.anchor AND s.label <> s.own AND 80 * p.score <= 100 * s.score AND s.score <= p.score
              WHERE p.k <= 5)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
    "op13_phrases": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        f AS (SELECT lang, n, array_to_string(w[i + 1 : i + n], ' ') AS phrase, count(*) AS a
              FROM w, unnest([1, 2, 3, 4]) AS s(n), unnest(range(0, len(w) - n + 1)) AS u(i) GROUP BY ALL),
        total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE n = 1 GROUP BY lang),
        c AS (SELECT lang, n, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE n > 1 AND a >= 30),
        cut AS (SELECT c.lang, c.phrase, c.a, h.a AS l, t.a AS r, k, CAST(2000000 AS HUGEINT) * c.a // (h.a + t.a) AS score
                FROM c, unnest(range(1, c.n)) AS u(k)
                JOIN f h ON h.lang = c.lang AND h.n = k AND h.phrase = array_to_string(c.w[1 : k], ' ')
                JOIN f t ON t.lang = c.lang AND t.n = c.n - k AND t.phrase = array_to_string(c.w[k + 1 : c.n], ' ')),
        best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        gone AS (SELECT DISTINCT i.lang, i.phrase FROM c i JOIN (
                     SELECT lang, a, array_to_string(w[b + 1 : b + m], ' ') AS phrase
                     FROM c, unnest([2, 3]) AS s(m), unnest(range(0, c.n - m + 1)) AS u(b) WHERE m < c.n) o
                 ON o.lang = i.lang AND o.phrase = i.phrase AND 100 * CAST(o.a AS HUGEINT) >= 80 * CAST(i.a AS HUGEINT)),
        ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
                   FROM best b ANTI JOIN gone g ON g.lang = b.lang AND g.phrase = b.phrase)
        SELECT ranked.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000""",
}
