"""Registered corpus queries: name -> (builder of (spark, folder), SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.common import table
from tallywork.llm.licences import recognise_sql

CRC_SQL = """
byte_crc AS (
  SELECT list(c ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c
    FROM (SELECT unnest(range(256)) AS b)))"""


def crc_sql(bytes_list: str) -> str:
    """CRC-32 of a list of byte values, with the table of ``CRC_SQL`` in scope."""
    return (
        f"xor(list_reduce(list_prepend(4294967295, {bytes_list}), "
        "lambda c, b: xor(c >> 8, crc[CAST(xor(c, b) & 255 AS INT) + 1])), 4294967295)"
    )


BYTES = "list_transform(regexp_extract_all(hex(encode({t})), '..'), lambda h: CAST('0x' || h AS BIGINT))"


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.sharding import shard_by_bytes

    placed = shard_by_bytes(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


OP1_SQL = f"""
WITH {CRC_SQL},
sized AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(strlen(coalesce(text, '')) AS BIGINT) + 8 AS size FROM documents),
numbered AS (
  SELECT doc_id, t, size, row_number() OVER (PARTITION BY doc_id, t) AS copy FROM sized),
running AS (
  SELECT doc_id, t, size,
    CAST(coalesce(sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
    row_number() OVER o AS row, CAST(sum(size) OVER () AS BIGINT) AS total
  FROM numbered WINDOW o AS (ORDER BY md5(t), doc_id NULLS FIRST, copy)),
placed AS (
  SELECT *, CAST(least(23, (2 * start + size) * 24 // (2 * total)) AS INT) AS shard FROM running)
SELECT doc_id, size, coalesce(CAST({crc_sql("hexed")} AS BIGINT), 0) AS text_crc32,
  'bytes' AS law, shard, row - min(row) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INT) AS grown_shard
FROM (SELECT *, {{bytes}} AS hexed FROM placed), byte_crc"""


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
numbered AS (
  SELECT *, md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), digest,
    CAST(row_number() OVER (PARTITION BY doc_id, source, digest, size) - 1 AS VARCHAR))) AS key FROM sized),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][turn % 3 + 1] AS weight, 2 * source_size AS cap, 2 * source_size / [3, 1, 2][turn % 3 + 1] AS room FROM sources),
leveled AS (
  SELECT *, row_number() OVER o AS place,
    (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY room, turn)),
chosen AS (SELECT min(place) AS first, arg_min(level, place) AS level FROM leveled WHERE level <= room),
targets AS (
  SELECT source, source_size, turn, coalesce(CASE WHEN place < first THEN CAST(cap AS DOUBLE) ELSE c.level * weight END, 0) AS target
  FROM leveled, chosen c),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, CAST(floor(target - epochs * source_size) AS BIGINT)
    - coalesce(sum(size) OVER (PARTITION BY turn ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken
FROM numbered n JOIN epochs e ON n.source IS NOT DISTINCT FROM e.source"""


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), k=20, every=20)


OP5_SQL = """
WITH whole AS (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
terms AS (SELECT vec_id, rid, unnest(v) AS w, unnest(range(len(v))) AS term FROM whole),
scored AS (
  SELECT q.rid AS query, q.vec_id AS query_id, r.rid, r.vec_id, CAST(sum(q.w * r.w) AS BIGINT) AS score
  FROM terms q JOIN terms r ON q.term = r.term AND q.rid <> r.rid WHERE q.vec_id % 20 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20"""


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.warc import archive_and_read

    return archive_and_read(table(spark, sf_dir, "pages"))


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS last FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(s, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM g"""


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.pii import find_personal_data, personal_data_digest

    return personal_data_digest(find_personal_data(table(spark, sf_dir, "documents")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.quality import fit_quality, score_quality

    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.decontamination import find_leaks

    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "windows", "first_word", "last_word", "most_equal")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.jaccard_join import near_copies

    return near_copies(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.licences import recognise

    return recognise(table(spark, sf_dir, "documents")).drop("digest")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.line_dedup import later_matches

    found = later_matches(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), F.array_join("removed", ",").alias("removed"))


def op11_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.projection_forest import nearest

    return nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.fill_in_middle import fill_in_middle, restore

    back = restore(fill_in_middle(table(spark, sf_dir, "documents"), rate=100, spm_rate=50, salt=7))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
drawn AS (
  SELECT doc_id, t, lines, CAST(len(lines) AS BIGINT) AS n,
    list_transform(range(4), lambda i: CAST('0x' || substr(s, CAST(8 * i + 1 AS INT), 8) AS BIGINT)) AS h FROM texts),
formed AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
      WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(lines[1:a], '') AS p, array_to_string(lines[a + 1:b], '') AS m, array_to_string(lines[b + 1:n], '') AS s FROM formed),
written AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output
  FROM parts),
found AS (
  SELECT *, strpos(output, '<P>') AS at_p, strpos(output, '<S>') AS at_s, strpos(output, '<M>') AS at_m FROM written)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars, sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN substr(output, at_p + 3, at_s - at_p - 3) || substr(output, at_m + 3) || substr(output, at_s + 3, at_m - at_s - 3)
    ELSE substr(output, at_p + 3, at_m - at_p - 3) || substr(output, at_m + 3) || substr(output, at_s + 3, at_p - at_s - 3) END) AS restored_sha256
FROM found"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywork.llm.prefix_trie import branched, prefix_trie

    return prefix_trie(branched(table(spark, sf_dir, "conversations")))


OP13_SQL = f"""
WITH {CRC_SQL},
ordered AS (
  SELECT conv_id, {{{{'role': coalesce(role, ''), 'text': coalesce(text, '')}}}} AS turn,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {crc_sql("{bytes}")} % 4 AS taken
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS t FROM ordered), byte_crc),
rebuilt AS (
  SELECT c.conv_id, o.pos, o.turn FROM convs c JOIN ordered o ON o.conv_id = c.base AND o.pos <= c.taken
  UNION ALL SELECT c.conv_id, o.pos + 4, o.turn FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND o.pos > c.taken),
listed AS (
  SELECT conv_id, coalesce(list(turn ORDER BY pos) FILTER (WHERE pos IS NOT NULL), []) AS turns, count(pos) AS n
  FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
prefixes AS (
  SELECT conv_id, n, depth, md5(CAST(turns[1:depth] AS VARCHAR)) AS node, md5(CAST(turns[1:depth - 1] AS VARCHAR)) AS parent, turns[depth].text AS last
  FROM (SELECT *, unnest(range(n + 1)) AS depth FROM listed)),
nodes AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(coalesce(any_value(last), ''), '[^\x20\x09-\x0D]+')) END AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth),
family AS (
  SELECT x.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = x.depth + 1 AND c.parent = x.node) AS n_children
  FROM nodes x LEFT JOIN nodes p ON p.node = x.parent AND p.depth = x.depth - 1),
below AS (
  SELECT DISTINCT a.node AS top, a.depth AS top_depth, b.node, b.depth FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (
  SELECT top, top_depth, sum((n_convs - 1) * words) AS saved, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves
  FROM below JOIN family USING (node, depth) GROUP BY ALL)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM family JOIN sums ON top = node AND top_depth = depth"""


QUERIES: dict = {
    "op1_shards": (op1_shards, OP1_SQL.replace("{bytes}", BYTES.format(t="t"))),
    "op2_pii": (op2_pii, None),
    "op3_mix": (op3_mix, OP3_SQL),
    "op4_quality": (op4_quality, None),
    "op5_topk": (op5_topk, OP5_SQL),
    "op6_licences": (op6_licences, recognise_sql()),
    "op7_line_dedup": (op7_line_dedup, None),
    "op8_warc": (op8_warc, OP8_SQL),
    "op9_decontaminate": (op9_decontaminate, None),
    "op10_jaccard_join": (op10_jaccard_join, None),
    "op11_projection_forest": (op11_projection_forest, None),
    "op12_fill_in_middle": (op12_fill_in_middle, OP12_SQL),
    "op13_prefix_trie": (op13_prefix_trie, OP13_SQL.replace("{bytes}", BYTES.format(t="t")).replace("{{", "{").replace("}}", "}")),
}
