"""Registered queries of the operators, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import (
    collocations, fertility, langid, licenses, mixing, pieces, simhash, spelling, token_scan, topk, trie_dedup,
    url_filter, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

#: The policy that the url query applies.
RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)


def model_path() -> str:
    """The vocabulary file that the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf, "pages"), RULES)


def op2(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0)))
    captures = pages.select(
        F.col("page_id").alias("capture_id"), captured.alias("captured"), "url", F.col("html").alias("payload")
    )
    merged = warc.archive_and_index(captures)
    return merged.select(
        F.col("capture_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to",
        "url_key", "captured",
    )


def op3(spark: SparkSession, sf: str) -> DataFrame:
    return digests(pieces.round_trip(_table(spark, sf, "documents"), model_path(), batch=1024, remembered=400_000))


def digests(coded: DataFrame) -> DataFrame:
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op5(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf, "documents"))


def op6(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf, "documents"), words=4, differing=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op7(spark: SparkSession, sf: str) -> DataFrame:
    return trie_dedup.exact_groups(_table(spark, sf, "documents"), keep="max")


def op8(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(_table(spark, sf, "documents"))


def op9(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf, "documents"))
    first = mixed.withColumn("position", F.try_element_at("positions", F.lit(1))).drop("positions", "source")
    key = F.col("position").asc_nulls_last()
    return first.repartitionByRange(key, "doc_id").sortWithinPartitions(key, "doc_id")


def op10(spark: SparkSession, sf: str) -> DataFrame:
    return token_scan.document_token_counts(_table(spark, sf, "documents"), model_path())


def op11(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf, "documents"), least=10, share=50, top=2000)


def op12(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(_table(spark, sf, "documents"), shortest=7, least=2, factor=10, every=31)


def op13(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    vocabularies = [model_path(), public_tokenizers.path("byte_bpe_50k.tiktoken")]
    return fertility.judge(_table(spark, sf, "documents"), vocabularies, public_tokenizers.PATTERN)


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


def queries() -> dict[str, Query]:
    return {
        "op1_url_redirect_filter": op1,
        "op2_warc_capture_index": op2,
        "op3_sentencepiece": op3,
        "op4_impact_topk": op4,
        "op5_license_scan": op5,
        "op6_simhash_pivots": op6,
        "op7_trie_dedup": op7,
        "op8_language_filters": op8,
        "op9_curriculum_mix": op9,
        "op10_token_counts": op10,
        "op11_collocations": op11,
        "op12_spelling_variants": op12,
        "op13_tokeniser_fertility": op13,
        "pipeline": pipeline,
    }


def _sql_part(url: str, group: int) -> str:
    return f"coalesce(regexp_extract({url}, '^(.*?)://([^/?#]*)([^?#]*)([^#]*)', {group}, 's'), '')"


def _sql_lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_rule(what: str) -> str:
    """The best rule of a row with ``host`` and ``path``."""
    fits = "(p.host = r.rhost OR ends_with(p.host, concat('.', r.rhost))) AND starts_with(p.path, r.rpath)"
    return f"(SELECT {what} FROM rules r WHERE {fits} ORDER BY length(r.rule) DESC LIMIT 1)"


_RULE_ROWS = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}', '{r.text}')" for r in RULES)
_KEY = "CASE WHEN host <> '' THEN concat(host, CASE WHEN path = '' THEN '/' ELSE path END, rest) END"

SQL = {
    # Links are taken from the html as the query does; here they are walked from the blocked urls.
    "op1_url_redirect_filter": f"""
        WITH RECURSIVE rules AS (SELECT * FROM (VALUES {_RULE_ROWS}) v(verdict, rhost, rpath, rule)),
        parsed AS (SELECT page_id, url, html, {_sql_part('url', 1)} AS scheme,
                    {_sql_lower(_sql_part('url', 2))} AS host, {_sql_part('url', 3)} AS path, {_sql_part('url', 4)} AS rest
                   FROM pages),
        tags AS (SELECT *, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^>]*>')) AS tag FROM parsed),
        found AS (SELECT *, trim(replace(CASE
                   WHEN regexp_matches(tag, '(?i)\\brel\\s*=\\s*["'']?\\s*canonical\\b')
                    THEN regexp_extract(tag, '(?i)\\bhref\\s*=\\s*["'']?([^"''>]*)', 1)
                   WHEN regexp_matches(tag, '(?i)\\bhttp-equiv\\s*=\\s*["'']?\\s*refresh\\b')
                    THEN regexp_extract(tag, '(?i)\\burl\\s*=\\s*[''"]?([^"''>]*)', 1) END, '&amp;', '&')) AS link
                  FROM tags),
        targets AS (SELECT {_KEY} AS a, CASE
                     WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
                     WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
                     WHEN starts_with(link, '//') THEN concat(scheme, ':', link)
                     WHEN starts_with(link, '/') THEN concat(scheme, '://', host, link)
                     WHEN starts_with(link, '?') THEN concat(scheme, '://', host, path, link)
                     ELSE concat(scheme, '://', host, coalesce(nullif(regexp_extract(path, '^(.*/)', 1, 's'), ''), '/'), link)
                    END AS target
                    FROM found WHERE link <> '' AND NOT starts_with(link, '#')),
        ends AS (SELECT a, {_sql_lower(_sql_part('target', 2))} AS host, {_sql_part('target', 3)} AS path,
                  {_sql_part('target', 4)} AS rest FROM targets),
        edges AS (SELECT a, {_KEY} AS b FROM ends), both_ways AS (
          SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
        nodes AS (SELECT DISTINCT a AS node, regexp_extract(a, '^([^/]*)', 1) AS host,
                   regexp_extract(a, '^[^/]*([^?]*)', 1, 's') AS path FROM both_ways),
        named AS (SELECT node, {_sql_rule('r.verdict')} AS verdict FROM nodes p),
        reached AS (SELECT node AS origin, node FROM nodes UNION
                    SELECT r.origin, e.b FROM reached r JOIN both_ways e ON e.a = r.node),
        classes AS (SELECT r.origin AS node, min(r.node) AS alias_class,
                     bool_or(n.verdict = 'block') AS bad FROM reached r JOIN named n ON n.node = r.node GROUP BY r.origin),
        judged AS (SELECT page_id, host, path, {_KEY} AS node, {_sql_rule('r.rule')} AS rule,
                    {_sql_rule('r.verdict')} AS own FROM parsed p)
        SELECT page_id, host, path, rule,
         coalesce(own, CASE WHEN coalesce(bad, false) THEN 'block' ELSE 'allow' END) AS verdict,
         alias_class, own IS NULL AND coalesce(bad, false) AS propagated
        FROM judged LEFT JOIN classes USING (node)""",
    "op4_impact_topk": """
        WITH numbers AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND
           len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
          FROM numbers q JOIN numbers c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id
          ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM scored) r WHERE rank <= 5""",
    "op7_trie_dedup": f"""
        WITH texts AS (SELECT doc_id, {_sql_lower("coalesce(text, '')")} AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
         doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY text)""",
    "op11_collocations": f"""
        WITH pieces AS (SELECT row_number() OVER () AS piece, lang, regexp_extract_all(text, '[^\\x20\\x09]+') AS w FROM (
          SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_sql_lower("coalesce(text, '')")},
           '[.,;:!?\\x0A-\\x0D]')) AS text FROM documents) p),
        words AS MATERIALIZED (SELECT piece, lang, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM pieces),
        runs AS MATERIALIZED (SELECT lang, word, lead(word) OVER along AS second, lead(word, 2) OVER along AS third
          FROM words WINDOW along AS (PARTITION BY piece ORDER BY place)),
        met AS (SELECT lang, word AS phrase FROM runs
          UNION ALL SELECT lang, concat(word, ' ', second) FROM runs WHERE second IS NOT NULL
          UNION ALL SELECT lang, concat(word, ' ', second, ' ', third) FROM runs WHERE third IS NOT NULL),
        f AS MATERIALIZED (SELECT lang, phrase, count(*) AS a FROM met GROUP BY ALL),
        totals AS (SELECT lang, count(*) AS n FROM runs GROUP BY lang),
        often AS (SELECT lang, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE a >= 10),
        parts AS MATERIALIZED (SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
          FROM (SELECT *, unnest(range(1, len(w))) AS k FROM often WHERE len(w) > 1) o),
        counts AS MATERIALIZED (SELECT lang, phrase, a FROM f WHERE a >= 10),
        cut AS (SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r,
           CAST(1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a) AS BIGINT) AS score, c.k
          FROM parts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head
          JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail),
        lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inside AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer
          FROM (SELECT *, unnest([1, 2]) AS i FROM often WHERE len(w) = 3) t GROUP BY ALL),
        ranked AS (SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank,
           c.phrase, a, l, r, score
          FROM lowest c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
          WHERE i.longer IS NULL OR 100 * i.longer < 50 * a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
