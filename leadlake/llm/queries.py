"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm.common import table
from leadlake.llm.exact_dedup import exact_dedup
from leadlake.llm.langid import language_id
from leadlake.llm.license_scan import license_scan
from leadlake.llm.line_dedup import line_dedup
from leadlake.llm.merkle import merkle_manifest, proof_digest
from leadlake.llm.minhash import near_duplicates
from leadlake.llm.mixing import mix_plan
from leadlake.llm.packing import best_fit_packing
from leadlake.llm.prefix_trie import conversation_trie
from leadlake.llm.quality import quality_classifier
from leadlake.llm.sharding import interleaved_shards
from leadlake.llm.topk_search import top_k_search
from leadlake.llm.warc_archive import archived_pages


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), bands=((12, 2), (6, 1)))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved_shards(table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op11_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_language_id": op3_language_id,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_sharding": op7_sharding,
    "op8_topk_search": op8_topk_search,
    "op9_mixing": op9_mixing,
    "op10_license_scan": op10_license_scan,
    "op11_warc_archive": op11_warc_archive,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}

def _crc32(text: str) -> str:
    """DuckDB expression: the CRC-32 of an ASCII text, bit by bit."""
    shifted = "lambda v, z: xor(v >> 1, 3988292384 * (v & 1))"
    folded = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {shifted})"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), "
            f"lambda ch: ascii(ch)::BIGINT)), {folded}), 4294967295)")


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


ORACLES: dict[str, str] = {
    "op11_warc_archive": """
WITH sized AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
newest AS (SELECT body, max(page_id) AS best FROM sized WHERE payload_bytes >= 1000 GROUP BY body)
SELECT page_id, payload_bytes, sha1(s.body) AS payload_digest,
       CASE WHEN page_id < best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < best THEN best END AS refers_to
FROM sized s LEFT JOIN newest n ON n.body = s.body""",
    # A node is the joined hashes of its turns, so that a prefix of the key is an ancestor's key.
    "op12_conversation_trie": rf"""
WITH turns AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(words ORDER BY turn NULLS FIRST, id) AS words,
         ({_crc32("conv_id::VARCHAR")} % 4)::BIGINT AS h FROM turns GROUP BY conv_id),
whole AS (
  SELECT c.conv_id, list_concat(coalesce(b.ids, [])[:c.h], c.ids[c.h + 1:]) AS ids,
         list_concat(coalesce(b.words, [])[:c.h], c.words[c.h + 1:]) AS words
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
stood AS (
  SELECT conv_id, d, array_to_string(ids[:d], '') AS node, CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words, d = len(ids) AS ends
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM whole)),
nodes AS MATERIALIZED (
  SELECT node, d, min(conv_id) AS low, count(*) AS n, any_value(words) AS words, left(node, 32 * (d - 1)::BIGINT) AS up,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM stood GROUP BY node, d),
kids AS MATERIALIZED (SELECT up, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
totals AS (
  SELECT left(x.node, 32 * a) AS node, sum(CASE WHEN k.up IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((x.n - 1) * x.words) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM nodes) x LEFT JOIN kids k ON k.up = x.node GROUP BY 1)
SELECT n.low AS conv_id, n.d AS depth, p.low AS parent_conv_id, n.n AS n_convs, coalesce(k.n_children, 0) AS n_children,
       CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.node = n.node LEFT JOIN kids k ON k.up = n.node
LEFT JOIN nodes p ON n.d > 0 AND p.node = n.up""",
    # Level by level: all nodes of all sources, then those over the sources; a proof gathers the other nodes of
    # every run on the way up, and the fold takes one level at a time.
    "op13_merkle_manifest": f"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256({" || ".join(_field(c) for c in (
             "doc_id", "source", "lang", "n_chars", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))})
         END AS tampered FROM documents),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM base),
nodes(s, lvl, idx, h, n) AS (
  SELECT s, 0, pos, leaf, count(*) OVER (PARTITION BY s) FROM numbered
  UNION ALL
  SELECT s, lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY s, lvl, idx // 16),
inner_nodes AS MATERIALIZED (SELECT * FROM nodes),
subroots AS MATERIALIZED (SELECT s, lvl AS height, h FROM inner_nodes WHERE n = 1),
tops(lvl, idx, h, n) AS (
  SELECT 0, s, h, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 15) // 16
  FROM tops WHERE n > 1 GROUP BY lvl, idx // 16),
top_nodes AS MATERIALIZED (SELECT * FROM tops),
runs AS MATERIALIZED (
  SELECT s, lvl, lvl AS step, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM inner_nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT NULL, lvl, lvl, idx // 16, list(h ORDER BY idx) FROM top_nodes WHERE n > 1 GROUP BY ALL),
placed AS MATERIALIZED (
  SELECT d.*, r.height, r.h AS subroot, (SELECT h FROM top_nodes WHERE n = 1) AS root FROM numbered d JOIN subroots r USING (s)),
climb(s, pos, height, lvl, proof, fold) AS (
  SELECT s, pos, height, 0, '', coalesce(tampered, leaf) FROM placed
  UNION ALL
  SELECT c.s, c.pos, c.height, c.lvl + 1,
         c.proof || array_to_string(r.hs[:c.at % 16], '') || array_to_string(r.hs[c.at % 16 + 2:], ''),
         sha256(array_to_string(r.hs[:c.at % 16], '') || c.fold || array_to_string(r.hs[c.at % 16 + 2:], ''))
  FROM (SELECT *, CASE WHEN lvl < height THEN pos // (16 ** lvl)::BIGINT ELSE s // (16 ** (lvl - height))::BIGINT END AS at
        FROM climb) c
  JOIN runs r ON r.s IS NOT DISTINCT FROM (CASE WHEN c.lvl < c.height THEN c.s END)
    AND r.step = CASE WHEN c.lvl < c.height THEN c.lvl ELSE c.lvl - c.height END AND r.run = c.at // 16),
done AS (SELECT s, pos, arg_max(proof, lvl) AS proof, arg_max(fold, lvl) AS fold FROM climb GROUP BY s, pos)
SELECT p.doc_id, p.leaf, p.subroot, p.root, sha256(d.proof) AS proof_sha256, d.fold AS folded_root, d.fold = p.root AS verified
FROM placed p JOIN done d USING (s, pos)""",
    # DuckDB's levenshtein counts bytes, so letters beyond ASCII become single control bytes first. A pair
    # within two edits has an unchanged first, last or middle third, which spares most distance computations.
    "op1_line_dedup": """
WITH RECURSIVE split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
seen AS (
  SELECT doc_id, unnest(range(0, len(l)))::INTEGER AS line_no, unnest(l) AS line FROM split),
long AS MATERIALIZED (
  SELECT line, length(line) AS n,
         translate(line, 'éèÍÊñÄâÉßêçÇíÈÑîáóöüÖÓäÜú', '') AS b
  FROM seen WHERE length(line) >= 6 GROUP BY line),
links AS MATERIALIZED (
  SELECT x.line AS u, y.line AS v FROM long x JOIN long y ON x.line <> y.line AND abs(x.n - y.n) <= 2
  WHERE (starts_with(y.b, x.b[:x.n // 3]) OR ends_with(y.b, x.b[x.n - x.n // 3 + 1:])
         OR contains(y.b, x.b[x.n // 3 + 1:x.n - x.n // 3]))
    AND levenshtein(x.b, y.b) <= CASE WHEN least(x.n, y.n) >= 12 THEN 2 ELSE 1 END),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, k.v FROM reach r JOIN links k ON r.v = k.u),
firsts AS (
  SELECT line, min({'d': doc_id, 'n': line_no}) AS f, any_value(length(line)) AS n_chars FROM seen GROUP BY line),
classed AS (
  SELECT f.line, f.n_chars, least(f.f, coalesce(min(g.f), f.f)) AS c, greatest(count(DISTINCT r.v), 1) AS class_lines
  FROM firsts f LEFT JOIN reach r ON r.u = f.line LEFT JOIN firsts g ON g.line = r.v GROUP BY f.line, f.n_chars, f.f),
first_links AS (SELECT f.f, count(k.v) AS n_links FROM firsts f LEFT JOIN links k ON k.u = f.line GROUP BY f.f)
SELECT s.doc_id, s.line_no, c.n_chars, c.c.d AS class_doc_id, c.c.n AS class_line_no, c.class_lines, k.n_links,
       s.doc_id = c.c.d AND s.line_no = c.c.n AS kept
FROM seen s JOIN classed c USING (line) JOIN first_links k ON k.f = c.c""",
    "op5_minhash_near_dedup": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda w: w <> '') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM worded),
posted AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v FROM posted a JOIN posted b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, k.v FROM reach r JOIN links k ON r.v = k.u),
low AS (SELECT u, min(v) AS m FROM reach GROUP BY u)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(low.m, s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(low.m, s.doc_id)) AS kept
FROM sets s LEFT JOIN low ON low.u = s.doc_id""",
    "op2_exact_dedup": """
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(coalesce(d.text, '')) AS text_sha256
FROM documents d
JOIN (SELECT coalesce(text, '') AS body, max(doc_id) AS keep_id, count(*) AS group_size
      FROM documents GROUP BY 1) g ON coalesce(d.text, '') = g.body""",
    "op8_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 10""",
    "op9_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS hash,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][(place - 1) % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS lim,
         1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE AS wanted
  FROM src),
stepped AS (
  SELECT a.*, (a.wanted - coalesce((SELECT sum(b.lim) FROM weighed b WHERE (b.lim / b.weight, b.place) < (a.lim / a.weight, a.place)), 0))
         / (SELECT sum(b.weight) FROM weighed b WHERE (b.lim / b.weight, b.place) >= (a.lim / a.weight, a.place))::DOUBLE AS level
  FROM weighed a),
aimed AS (
  SELECT source, source_size,
         least(lim, (SELECT arg_min(level, (lim / weight, place)) FROM stepped WHERE level * weight <= lim) * weight) AS target
  FROM stepped),
drawn AS (
  SELECT s.doc_id, s.size, a.source_size, a.target,
         coalesce(a.target / nullif(a.source_size, 0), 0) AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), '') || ':' || s.hash), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM drawn""",
}
