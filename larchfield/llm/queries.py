"""The registered corpus queries and their DuckDB checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larchfield.llm import (
    contamination,
    language,
    licenses,
    lines,
    merkle,
    minhash,
    neighbours,
    packing,
    quality,
    runs,
    shards,
    toxicity,
    warc,
)
from larchfield.llm.common import scratch_path, table, tuned

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(tuned(spark), sf_dir)
    return build


@query
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    records = warc.roundtrip(table(spark, sf_dir, "pages"), folder, scratch_path(spark, "manifest"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op2_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), r AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last_id FROM p
), t AS (
  SELECT *, payload_bytes >= 1000 AND page_id <> last_id AS again FROM r
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN last_id END AS refers_to
FROM t
"""


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), packing.default_tokenizer())
    return pieces.drop("queue")


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return named.select("doc_id", "held_out", "lang_pred", "score")


@query
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@query
def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.pack_shards(table(spark, sf_dir, "documents")).drop("tokens")


@query
def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "text", "lines_removed")


ORACLES["op9_lines"] = r"""
WITH l AS (
  SELECT doc_id, text, u.n AS n, u.line AS line,
         trim(replace(u.line, chr(13), ''), ' ') AS t
  FROM (SELECT doc_id, text, unnest(list_zip(range(len(string_split(text, chr(10)))),
                                             string_split(text, chr(10)))) AS z
        FROM documents),
       LATERAL (SELECT z[1] AS n, z[2] AS line) u
), k AS (
  SELECT doc_id, n, t, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS pos FROM l WHERE t <> ''
), w AS (
  SELECT doc_id, pos, t AS a, lead(t) OVER d AS b, lead(t, 2) OVER d AS c
  FROM k WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), f AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS seen
  FROM w WHERE c IS NOT NULL
), g AS (
  SELECT DISTINCT f.doc_id, k.n
  FROM f JOIN k ON k.doc_id = f.doc_id AND k.pos BETWEEN f.pos AND f.pos + 2
  WHERE f.seen > 1
), r AS (
  SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.n) FILTER (g.n IS NULL), '') AS text,
         count(g.n) AS lines_removed
  FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.n = l.n
  GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN r.doc_id IS NULL THEN d.text ELSE r.text END AS text,
       CAST(coalesce(r.lines_removed, 0) AS BIGINT) AS lines_removed
FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id
"""


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.grade_documents(docs, model).drop("text")


@query
def op10_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "leaked_items", "leak_share")


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered_text()).drop("proof")


# CRC-32 of the decimal doc_id: a table of 256 entries from the polynomial, then a step per digit.
CRC = """
crc_table AS (
  SELECT list(t ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
    FROM range(256) r(i))
), crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(
           list_concat([4294967295], [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
           lambda c, b: xor(steps[xor(c, b) % 256 + 1], c >> 8))) AS h
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc_table
)"""


def framed_sql(*values: str) -> str:
    return " || ".join(
        f"coalesce(CAST(octet_length(encode(CAST({v} AS VARCHAR))) AS VARCHAR) || ':' || CAST({v} AS VARCHAR), '-')"
        for v in values
    )


def climb_sql(tree: str, node: str) -> str:
    """A recursive step: runs of three nodes of the step below become one."""
    return f"""
    SELECT {tree}, lvl + 1, pos // 3, sha256(string_agg({node}, '' ORDER BY pos)), (max(n) + 2) // 3
    FROM """


def beside_sql(nodes: str, tree: str) -> str:
    """The siblings before and after each node."""
    return f"""
  SELECT a.{tree}, a.lvl, a.pos, a.n, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lead,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS trail
  FROM {nodes} a LEFT JOIN {nodes} b
    ON a.{tree} = b.{tree} AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 AND a.pos <> b.pos
  WHERE a.n > 1 GROUP BY ALL"""


ORACLES["op12_merkle"] = f"""
WITH RECURSIVE {CRC}, d AS (
  SELECT documents.*, CASE WHEN h % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS altered
  FROM documents LEFT JOIN crc USING (doc_id)
), named AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM d)
), leaves AS (
  SELECT tree, doc_id, leaf, other, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM (SELECT tree, doc_id, sha256({framed_sql('doc_id', 'd.source', 'lang', 'n_chars', 'text')}) AS leaf,
               sha256({framed_sql('doc_id', 'd.source', 'lang', 'n_chars', 'altered')}) AS other
        FROM d JOIN named ON d.source IS NOT DISTINCT FROM named.source)
), low AS (
  SELECT tree, 0 AS lvl, pos, leaf AS h, n FROM leaves
  UNION ALL {climb_sql('tree', 'h')} low WHERE n > 1 GROUP BY tree, lvl, pos // 3
), high AS (
  SELECT 0 AS tree, 0 AS lvl, tree AS pos, h, (SELECT count(*) FROM named) AS n FROM low WHERE n = 1
  UNION ALL {climb_sql('tree', 'h')} high WHERE n > 1 GROUP BY tree, lvl, pos // 3
), low_beside AS ({beside_sql('low', 'tree')}
), high_beside AS ({beside_sql('high', 'tree')}
), low_fold AS (
  SELECT tree, pos AS place, 0 AS lvl, pos, n, other AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT f.tree, place, f.lvl + 1, f.pos // 3, (f.n + 2) // 3, sha256(lead || f.h || trail), proof || lead || trail
  FROM low_fold f JOIN low_beside b ON f.tree = b.tree AND f.lvl = b.lvl AND f.pos = b.pos
), high_fold AS (
  SELECT tree, place, 0 AS lvl, tree AS pos, (SELECT count(*) FROM named) AS n, h, proof FROM low_fold WHERE n = 1
  UNION ALL
  SELECT f.tree, place, f.lvl + 1, f.pos // 3, (f.n + 2) // 3, sha256(lead || f.h || trail), proof || lead || trail
  FROM high_fold f JOIN high_beside b ON f.lvl = b.lvl AND f.pos = b.pos
)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM leaves l JOIN high_fold f ON l.tree = f.tree AND l.pos = f.place AND f.n = 1
JOIN low s ON s.tree = l.tree AND s.n = 1 JOIN high r ON r.n = 1
"""


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.find_periodic(table(spark, sf_dir, "documents"), runs.plant)


# Runs are islands of word pairs at equal distance; of equal stretches the smallest distance counts.
ORACLES["op13_runs"] = rf"""
WITH {CRC}, split AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, h
  FROM documents LEFT JOIN crc USING (doc_id)
), shaped AS (
  SELECT id, doc_id, words, len(words) AS n, h % 10 = 0 AND len(words) > 0 AS planted,
         (h // 10) % greatest(len(words), 1) AS a, 3 + (h // 10) % 8 AS parts
  FROM split
), placed AS (
  SELECT id, i, CASE WHEN planted AND i >= a THEN words[a + (i - a) % (1 + (n - a) // parts) + 1] ELSE words[i + 1] END AS w, n
  FROM (SELECT *, unnest(range(n)) AS i FROM shaped)
), pairs AS (
  SELECT x.id, x.i, y.i - x.i AS q FROM placed x JOIN placed y ON x.id = y.id AND x.w = y.w
    AND y.i > x.i AND y.i - x.i <= x.n // 4
), islands AS (
  SELECT id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS island FROM pairs)
  GROUP BY id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT id, start, length, min(q) AS period FROM islands GROUP BY id, start, length
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (
    PARTITION BY id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1
), listed AS (
  SELECT id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY id
), kept AS (
  SELECT p.id, string_agg(w, ' ' ORDER BY i) AS text FROM placed p
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.id = p.id AND p.i >= r.start + r.period AND p.i < r.start + r.length)
  GROUP BY p.id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM split s LEFT JOIN listed USING (id) LEFT JOIN best USING (id) LEFT JOIN kept k USING (id)
"""
