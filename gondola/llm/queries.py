"""The operators as registered queries over the shared tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import bpe, exact_dedup, language, merkle, multi_index, packing, periodic_runs, pii, sharding, simhash, token_counts, url_filters, vector_search

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = pii.replace_private(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.surrogate_key(spark))
    return masked.select("doc_id", "text", F.size("entities").alias("n_entities"), "entities")


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.label_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge(pages, url_filters.rules_table(spark, RULES), url_filters.link_edges(pages))


def encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"), "n_chunks")


def copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with planted repeats: where the checksum h of the doc_id ends in 0, the words from
    number a on repeat the p words there; a and p follow from h and the number of words."""
    n, a, p = F.col("__n"), F.col("__a"), F.col("__p")
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    planted = docs.select("doc_id", "text", (h % 10 == 0).alias("__chosen"), F.floor(h / 10).alias("__g"))
    planted = planted.withColumn("__words", F.when(F.col("__chosen"), words)).withColumn("__n", F.size("__words"))
    planted = planted.withColumn("__a", F.when(n > 0, F.col("__g") % n).cast("int"))
    planted = planted.withColumn("__p", (1 + F.floor((n - a) / (3 + F.col("__g") % 8))).cast("int"))
    cycle = F.slice("__words", a + 1, p)
    rest = F.slice(F.flatten(F.array_repeat(cycle, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    text = F.when(n > 0, F.array_join(F.concat(F.slice("__words", F.lit(1), a), rest), " ")).otherwise(F.col("text"))
    return planted.select("doc_id", text.alias("text"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect_runs(with_repeats(table(spark, sf_dir, "documents")))
    # By start and period; of equal exponents the first stays.
    denser = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    best = F.reduce("runs", F.lit(None).cast(kind), lambda best, run: F.when(denser(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.*",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, held against rows of which every seventh or so was changed."""
    tampered = F.col("n_chars") + F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, 1).otherwise(0)
    fields = [F.col(n) for n in ("doc_id", "source", "lang", "n_chars", "text")]
    checked = merkle.record_hash(*fields[:3], tampered, fields[4])
    found = merkle.manifest(table(spark, sf_dir, "documents"), merkle.record_hash(*fields), checked)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_surrogates": surrogates,
    "op2_packing": pack,
    "op3_language": languages,
    "op4_url_filters": urls,
    "op5_bpe": encode,
    "op6_top_k": search,
    "op7_simhash": near,
    "op8_sharding": shards,
    "op9_token_counts": count_tokens,
    "op10_exact_dedup": copies,
    "op11_periodic_runs": runs,
    "op12_merkle_manifest": signed,
    "op13_neighbours": neighbours,
}

SQL: dict[str, str] = {
    # The tables hold no redirect or canonical link; where one occurs, the recursion follows it.
    "op4_url_filters": r"""
WITH RECURSIVE cut AS (
  SELECT page_id, url, row_number() OVER () AS place,
    CASE WHEN contains(url, '://') THEN lower(regexp_extract(url, '^(?s:.*?)://[^/?#]*')) || coalesce(nullif(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^#]*)', 1), ''), '/') ELSE regexp_replace(url, '#.*$', '', 's') END AS meeting,
    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule, rule_host, rule_path, verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
ruled AS (
  SELECT c.*, r.rule, r.verdict,
    row_number() OVER (PARTITION BY c.place ORDER BY length(r.rule) DESC NULLS LAST) AS n
  FROM cut c LEFT JOIN rules r
    ON (c.host = r.rule_host OR ends_with(c.host, '.' || r.rule_host)) AND starts_with(c.path, r.rule_path)),
own AS (SELECT * FROM ruled WHERE n = 1),
edge AS (
  SELECT c.meeting AS a, lower(regexp_extract(b, '^(?s:.*?)://[^/?#]*')) || coalesce(nullif(regexp_extract(b, '^(?s:.*?)://[^/?#]*([^#]*)', 1), ''), '/') AS b
  FROM (SELECT url, unnest([regexp_extract(html, '<link [^>]*rel="canonical"[^>]* href="([^"]+)"', 1), regexp_extract(html, '<meta http-equiv="refresh"[^>]*url=([^"]+)"', 1)]) AS b FROM pages) l
  JOIN cut c USING (url)),
both_ways AS (SELECT a, b FROM edge WHERE b <> '/' UNION SELECT b, a FROM edge WHERE b <> '/'),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
heard AS (
  SELECT r.a AS meeting, bool_or(o.verdict = 'allow') AS allowed
  FROM reach r JOIN own o ON o.meeting = r.b WHERE o.rule IS NOT NULL GROUP BY r.a)
SELECT o.page_id, o.host, o.path, o.rule,
  coalesce(o.verdict, CASE WHEN h.allowed THEN 'allow' WHEN NOT h.allowed THEN 'block' END, 'allow') AS verdict
FROM own o LEFT JOIN heard h USING (meeting)
""",
    "op6_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
asks AS (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 50 = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(list_dot_product(q.v, c.v)::BIGINT) AS score
  FROM asks q JOIN (SELECT *, row_number() OVER () AS place FROM v) c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  GROUP BY q.vec_id, c.vec_id, c.place),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op10_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size, row_number() OVER best AS place,
    first_value(doc_id) OVER best AS keep_id FROM n WINDOW best AS (PARTITION BY norm ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM g
""",
    # crc32 is worked out bit by bit. Levels of a tree come from the level below by recursion.
    "op12_merkle_manifest": """
WITH RECURSIVE bytes AS (
  SELECT doc_id, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda k: ord(substr(doc_id::VARCHAR, k, 1))::BIGINT) AS b
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
sums AS (
  SELECT doc_id, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x:
    list_reduce(list_concat([xor(c, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) AS h
  FROM bytes),
fields AS (
  SELECT d.doc_id, coalesce('1' || lang, '0') AS g, n_chars + CASE WHEN h % 7 = 0 THEN 1 ELSE 0 END AS changed, n_chars,
    coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    coalesce(strlen(text) || ':' || text, '-') AS z
  FROM documents d LEFT JOIN sums USING (doc_id)),
leaves AS (
  SELECT doc_id, g, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS leaf,
    sha256(a || coalesce(strlen(changed::VARCHAR) || ':' || changed, '-') || z) AS checked FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
tree(g, level, i, n, node) AS (
  SELECT g, 0, i, n, leaf FROM placed
  UNION ALL
  SELECT g, level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY g, level, i // 2),
subroots AS (
  SELECT g, level AS height, node, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
crown(level, i, n, node) AS (
  SELECT 0, i, n, node FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM crown WHERE n > 1 GROUP BY level, i // 2),
steps AS (
  SELECT p.g, p.i, t.level, CASE WHEN t.i < (p.i >> t.level) THEN t.node ELSE '' END AS before, CASE WHEN t.i > (p.i >> t.level) THEN t.node ELSE '' END AS after
  FROM placed p JOIN tree t ON t.g = p.g AND t.n > 1 AND t.i // 2 = (p.i >> t.level) // 2 AND (t.i <> (p.i >> t.level) OR t.i = t.n - 1 AND t.i % 2 = 0)),
crown_steps AS (
  SELECT s.g, s.height + c.level AS level, CASE WHEN c.i < (s.i >> c.level) THEN c.node ELSE '' END AS before, CASE WHEN c.i > (s.i >> c.level) THEN c.node ELSE '' END AS after
  FROM subroots s JOIN crown c ON c.n > 1 AND c.i // 2 = (s.i >> c.level) // 2 AND (c.i <> (s.i >> c.level) OR c.i = c.n - 1 AND c.i % 2 = 0)),
paths AS (
  SELECT p.g, p.i, s.level, s.before, s.after FROM placed p JOIN steps s USING (g, i)
  UNION ALL SELECT p.g, p.i, c.level, c.before, c.after FROM placed p JOIN crown_steps c USING (g)),
proofs AS (SELECT g, i, string_agg(before || after, '' ORDER BY level) AS siblings, max(level) AS last FROM paths GROUP BY g, i),
folds(g, i, level, node) AS (
  SELECT g, i, 0, checked FROM placed
  UNION ALL
  SELECT f.g, f.i, f.level + 1, sha256(x.before || f.node || x.after) FROM folds f JOIN paths x ON x.g = f.g AND x.i = f.i AND x.level = f.level)
SELECT p.doc_id, p.leaf, s.node AS subroot, (SELECT node FROM crown WHERE n = 1) AS root, sha256(coalesce(r.siblings, '')) AS proof_sha256,
  f.node AS folded_root, f.node = (SELECT node FROM crown WHERE n = 1) AS verified
FROM placed p JOIN subroots s ON s.g = p.g LEFT JOIN proofs r ON r.g = p.g AND r.i = p.i
JOIN folds f ON f.g = p.g AND f.i = p.i AND f.level = coalesce(r.last + 1, 0)
""",
}
