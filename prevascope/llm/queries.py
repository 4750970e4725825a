"""Registered queries of the text operators, over whole tables, and the SQL that some must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from prevascope.llm import centroids, contamination, exact_dedup, html_text, jaccard_join, lexical_search, lm_score, near_dedup
from prevascope.llm import pieces, privacy, secrets, toxicity, warc
from prevascope.llm.common import table


def op1_lm_score(spark, folder):
    return lm_score.score(table(spark, folder, "documents"))


def op2_html_text(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


def op3_exact_dedup(spark, folder):
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op4_near_dedup(spark, folder):
    return near_dedup.near_duplicates(table(spark, folder, "documents")).drop("text_key")


def op5_contamination(spark, folder):
    found = contamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_key")


def op6_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    scores = toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))
    spans = F.transform("sentences", lambda s: F.concat_ws(":", s["at"], s["to"], F.round(s["score"], 4)))
    counted = scores.withColumn("n_offending", F.size("sentences").cast("long"))
    return counted.withColumn("offending", F.array_join(spans, ",")).drop("sentences", "text_key")


def op7_private_spans(spark, folder):
    return privacy.private_spans(table(spark, folder, "documents")).drop("found")


def op8_pieces(spark, folder):
    return pieces.encode(table(spark, folder, "documents"), digest=True)


def op9_secret_scan(spark, folder):
    return secrets.secret_scan(table(spark, folder, "documents")).drop("findings")


def op10_warc(spark, folder):
    pages = table(spark, folder, "pages")
    read = warc.read_archives(spark, warc.write_archives(pages), payloads=False)
    kind = pages.schema["page_id"].dataType
    return read.select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind)
    )


def op11_lexical_search(spark, folder):
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_centroids(spark, folder):
    return centroids.cluster(table(spark, folder, "embeddings"))


def op13_jaccard_join(spark, folder):
    return jaccard_join.jaccard_components(table(spark, folder, "documents"))


OP3 = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


OP4 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
paired AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y USING (s) WHERE x.doc_id != y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM paired JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id, doc_id AS low FROM docs UNION SELECT links.a, reach.low FROM reach JOIN links ON links.b = reach.doc_id
)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(low) AS component_id, doc_id = min(low) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

OP5 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), placed AS (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS key FROM placed),
starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows)),
found AS (
  SELECT s.doc_id, s.i, s.n, v.item
  FROM (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS key FROM starts) s JOIN windows v USING (n, key)
), hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
owned AS (SELECT doc_id, count(DISTINCT item) AS n_items, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN owned USING (doc_id)
"""

OP11 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
), total AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_words FROM docs WHERE len(w) > 0),
bags AS (SELECT doc_id, len(w) AS n, t, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS t FROM docs) GROUP BY doc_id, w, t),
weights AS (
  SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM bags, total GROUP BY t
), scores AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words))))::BIGINT AS score
  FROM items JOIN bags USING (t) JOIN weights USING (t), total GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""


def _op12() -> str:
    """Rounds one after the other; a component of a vector is a row."""
    assign = """near{0} AS (
  SELECT vec_id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM (
    SELECT p.vec_id, c.cluster, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS distance FROM parts p JOIN centroids{0} c USING (i) GROUP BY 1, 2
  ) GROUP BY vec_id
)"""
    move = """centroids{1} AS (
  SELECT c.cluster, c.i, coalesce(m.x, c.x) AS x FROM centroids{0} c LEFT JOIN (
    SELECT cluster, i, ((sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) // count(*))::BIGINT AS x
    FROM near{0} JOIN parts USING (vec_id) GROUP BY cluster, i
  ) m ON m.cluster = c.cluster AND m.i = c.i
)"""
    rounds = [part.format(n, n + 1) for n in range(centroids.ROUNDS) for part in (assign, move)]
    last = centroids.ROUNDS
    return f"""
WITH kept AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND list_count(embedding) = 64 AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, i, floor(64 * embedding[i]::DOUBLE)::BIGINT AS x FROM kept, range(1, 65) r(i)
), first AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM kept QUALIFY cluster < 16
), centroids0 AS (SELECT cluster, i, x FROM first JOIN parts USING (vec_id)),
{", ".join(rounds)},
{assign.format(last)},
digests AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM centroids{last} GROUP BY cluster)
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM near{last} JOIN digests USING (cluster)
"""


OP13 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
paired AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y USING (s) WHERE x.doc_id != y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM paired JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 90 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id, doc_id AS low FROM docs UNION SELECT links.a, reach.low FROM reach JOIN links ON links.b = reach.doc_id
)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(low) AS component_id FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def queries() -> dict:
    return {q.__name__: q for q in (op1_lm_score, op2_html_text, op3_exact_dedup, op4_near_dedup, op5_contamination, op6_toxicity, op7_private_spans, op8_pieces, op9_secret_scan, op10_warc, op11_lexical_search, op12_centroids, op13_jaccard_join)}


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": OP3, "op4_near_dedup": OP4, "op5_contamination": OP5, "op11_lexical_search": OP11, "op12_centroids": _op12(), "op13_jaccard_join": OP13}
