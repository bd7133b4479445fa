"""The registered queries of the corpus operators: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import quality, toxicity
from .ann import nearest_neighbours
from .centroids import CLUSTERS, ROUNDS, centroid_clusters, centroid_report
from .exact_dedup import exact_dedup
from .mixing import mix
from .name_join import name_links
from .pieces import encode_pieces
from .pii import find_pii
from .setsketch import sketch_components
from .simhash import simhash_components
from .token_counts import token_counts
from .token_ids import read_token_blocks, write_token_blocks

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), store="packed")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(C.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, C.table(spark, sf_dir, "labels")))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(C.table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(C.table(spark, sf_dir, "documents"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(C.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(C.table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(C.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, C.table(spark, sf_dir, "labels")))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = C.scratch_path(spark, "token-blocks")
    write_token_blocks(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_token_blocks(spark, path, with_ids=False)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_report(*centroid_clusters(C.table(spark, sf_dir, "embeddings")))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_components(C.table(spark, sf_dir, "documents"))


def op13_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_links(C.table(spark, sf_dir, "clients"), C.table(spark, sf_dir, "vendors"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_pii": op5_pii,
    "op6_ann": op6_ann,
    "op7_simhash": op7_simhash,
    "op8_mixing": op8_mixing,
    "op9_quality": op9_quality,
    "op10_token_ids": op10_token_ids,
    "op11_centroids": op11_centroids,
    "op12_minhash": op12_minhash,
    "op13_name_join": op13_name_join,
}

OP4_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  ('0x' || substr(md5(concat('42:', coalesce(doc_id::VARCHAR, 'null'), ':', coalesce(text, ''))), 1, 15))::BIGINT AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
w AS (SELECT *, source_size * 3 AS cap, source_size * 3 / weight AS ratio FROM s),
v AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER r, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER r, 0))::DOUBLE AS level
      FROM w WINDOW r AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT level FROM v WHERE ratio > level ORDER BY ratio, level LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN ratio <= level THEN cap::DOUBLE ELSE (SELECT level FROM l) * weight END AS target FROM v),
u AS (SELECT *, target - source_size * whole AS rest FROM (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t)),
p AS (SELECT source, place, sum(size) OVER (PARTITION BY source ORDER BY place)::BIGINT AS upto FROM d),
g AS (SELECT u.source, place, abs(upto - rest) AS gap FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source UNION ALL SELECT source, -1, rest FROM u),
c AS (SELECT source, place AS last_place FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY gap, place) AS k FROM g) WHERE k = 1)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE size * (whole + (place <= last_place)::INT) END::BIGINT AS taken
FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source JOIN c ON d.source IS NOT DISTINCT FROM c.source
"""


def centroid_sql(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """Every vector against every centroid in every round."""
    parts = [
        """WITH e AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE)))),
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM e)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS j, v FROM (SELECT v, sha256('2:' || coalesce(vec_id::VARCHAR, 'null')) AS h FROM v ORDER BY h, v LIMIT {k}))""",
    ]
    for n in range(rounds + 1):
        parts.append(
            f"""a{n} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, j) AS place FROM (
  SELECT r, vec_id, v.v, j, list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{n} AS c)) WHERE place = 1)"""
        )
        if n < rounds:
            parts.append(
                f"""c{n + 1} AS MATERIALIZED (SELECT c{n}.j, coalesce(m.v, c{n}.v) AS v FROM c{n} LEFT JOIN (
  SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
    SELECT j, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT j, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{n}) GROUP BY j, i) GROUP BY j) AS m ON m.j = c{n}.j)"""
            )
    return ",\n".join(parts) + f"""
SELECT vec_id, a.j::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON a.j = c.j
"""


OP12_SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2])))) END AS s FROM w),
d AS MATERIALIZED (SELECT doc_id, len(s) AS n, md5(array_to_string(s, chr(10))) AS g, s FROM s),
g AS MATERIALIZED (SELECT g, any_value(n) AS n, any_value(s) AS s, min(doc_id) AS least FROM d WHERE n > 0 GROUP BY g),
x AS MATERIALIZED (SELECT g, n, unnest(s) AS x FROM g),
p AS MATERIALIZED (SELECT a.g AS a, b.g AS b, count(*) AS c, any_value(a.n) AS n, any_value(b.n) AS m FROM x AS a JOIN x AS b ON a.x = b.x AND a.g < b.g AND a.n * 100 >= b.n * 85 AND b.n * 100 >= a.n * 85 GROUP BY a.g, b.g),
l AS MATERIALIZED (SELECT a, b FROM p WHERE 100 * c >= 85 * (n + m - c) UNION ALL SELECT b, a FROM p WHERE 100 * c >= 85 * (n + m - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT q.g, least(any_value(q.least), min(o.least)) AS least FROM g AS q LEFT JOIN r ON r.a = q.g LEFT JOIN g AS o ON r.b = o.g GROUP BY q.g)
SELECT doc_id, n AS n_shingles, coalesce(least, doc_id) AS component_id, doc_id = coalesce(least, doc_id) AS kept FROM d LEFT JOIN c ON d.g = c.g AND d.n > 0
"""

OP13_SQL = """
WITH RECURSIVE v AS (SELECT vendor_id, name, length(name) AS n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(vendor_id::VARCHAR) + 1), lambda i: ascii(substr(vendor_id::VARCHAR, i, 1))::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)) + z))) AS h FROM vendors),
w AS (SELECT vendor_id, CASE WHEN h % 2 = 0 AND n >= 2 THEN substr(name, 1, h % (n - 1)) || substr(name, h % (n - 1) + 2, 1) || substr(name, h % (n - 1) + 1, 1) || substr(name, h % (n - 1) + 3) ELSE name END AS b FROM v),
chars AS MATERIALIZED (SELECT s, list_transform(range(1, length(s) + 1), lambda i: substr(s, i, 1)) AS c FROM (SELECT name AS s FROM clients WHERE name <> '' UNION SELECT b FROM w WHERE b <> '')),
p AS (SELECT DISTINCT x.s AS a, y.s AS b, x.c AS ca, y.c AS cb FROM chars AS x JOIN chars AS y ON abs(len(x.c) - len(y.c)) <= 2 WHERE x.s IN (SELECT name FROM clients) AND y.s IN (SELECT b FROM w)),
d AS (
  SELECT a, b, ca, cb, 0::BIGINT AS i, range(0, len(cb) + 1) AS r, NULL::BIGINT[] AS q FROM p
  UNION ALL
  SELECT a, b, ca, cb, i + 1, list_reduce(list_prepend([i + 1], list_transform(range(1, len(cb) + 1), lambda j: [j])),
    lambda acc, e: list_append(acc, least(acc[e[1]] + 1, r[e[1] + 1] + 1, r[e[1]] + (ca[i + 1] <> cb[e[1]])::BIGINT,
      CASE WHEN i > 0 AND e[1] > 1 AND ca[i + 1] = cb[e[1] - 1] AND ca[i] = cb[e[1]] THEN q[e[1] - 1] + 1 ELSE 9 END))), r
  FROM d WHERE i < len(ca) AND list_min(r) <= 2),
m AS MATERIALIZED (SELECT a, b, r[len(cb) + 1] AS distance FROM d WHERE i = len(ca) AND r[len(cb) + 1] <= 2),
k AS (SELECT name, client_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(client_id::VARCHAR) + 1), lambda i: ascii(substr(client_id::VARCHAR, i, 1))::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)) + z))) AS crc FROM clients)
SELECT vendor_id, distance::INT AS distance, count(*) AS n_clients, min(client_id) AS first_client_id, sum(crc)::BIGINT AS clients_crc
FROM m JOIN k ON k.name = m.a JOIN w ON w.b = m.b GROUP BY vendor_id, distance
"""

ORACLES: dict[str, str] = {"op4_exact_dedup": OP4_SQL, "op8_mixing": OP8_SQL, "op11_centroids": centroid_sql(), "op12_minhash": OP12_SQL, "op13_name_join": OP13_SQL}
