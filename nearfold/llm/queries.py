"""The registered queries of this package, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfold.llm import (
    alignment, chunks, decontaminate, embeddings, jaccard, language, licenses, manifest, packing, quality, suffix,
    threads, token_files,
)
from nearfold.llm.batches import id_remainder, table
from nearfold.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def _removed_bytes() -> Column:
    return F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])


@query()
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


_SHINGLES_SQL = r"""RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS i
        FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)"""


@query(
    f"""WITH {_SHINGLES_SQL}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, min(r.b)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id
GROUP BY d.doc_id, n.n"""
)
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard.similar_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


@query()
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = chunks.drop_repeated_chunks(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_chunks", "n_repeats",
        _removed_bytes().alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query()
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    rows = token_files.checksums(token_files.read_token_files(spark, path))
    return token_files.positions(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


@query()
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(id_remainder("doc_id", 4) != 2)
    scored = quality.score_quality(docs, quality.fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"),
    )


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs.filter(id_remainder("doc_id", 3) != 1)))
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        _removed_bytes().alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


_NORMAL_SQL = r"trim(regexp_replace(lower({}), '[ \t\r\f\n]+', ' ', 'g'))"


@query(
    rf"""WITH m AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
id AS (SELECT *, row_number() OVER () AS k FROM m),
raw AS (SELECT k, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM id),
lines AS (SELECT k, i, length(replace(regexp_extract(line, '^((?:> ?)+)', 1), ' ', '')) AS depth,
                 regexp_replace(line, '^((?:> ?)+)', '') AS body FROM raw),
edge AS (SELECT *, CASE WHEN depth = lag(depth) OVER (PARTITION BY k ORDER BY i) THEN 0 ELSE 1 END AS e FROM lines),
run AS (SELECT *, sum(e) OVER (PARTITION BY k ORDER BY i) AS p FROM edge),
own AS (SELECT k, regexp_replace(string_agg(body, chr(10) ORDER BY i), '^[ 	
]+|[ 	
]+$', '', 'g') AS content
        FROM lines WHERE depth = 0 GROUP BY k),
unit AS (
  SELECT k, depth, 0 AS rank, {_NORMAL_SQL.format('body')} AS said FROM lines
  UNION ALL SELECT k, depth, 1, {_NORMAL_SQL.format("string_agg(body, chr(10) ORDER BY i)")} FROM run GROUP BY k, depth, p
  UNION ALL SELECT k, 0, 1, {_NORMAL_SQL.format('content')} FROM own),
said AS (SELECT conv_id, turn, depth, rank, said FROM unit JOIN id USING (k) WHERE said <> '' AND turn IS NOT NULL),
origin AS (SELECT conv_id, said, min(turn) AS first_turn FROM said WHERE depth = 0 GROUP BY ALL),
met AS (SELECT s.conv_id, s.turn, s.depth, s.rank, o.first_turn FROM said s JOIN origin o
        ON o.conv_id IS NOT DISTINCT FROM s.conv_id AND o.said = s.said AND o.first_turn < s.turn WHERE s.depth > 0),
link AS (SELECT conv_id, turn, count(DISTINCT first_turn) AS n,
                arg_max(first_turn, (-depth, rank, first_turn)) AS linked FROM met GROUP BY ALL),
msg AS (SELECT id.conv_id, id.turn, id.role, coalesce(own.content, '') AS content, coalesce(link.n, 0) AS n_links,
               coalesce(link.linked, prev.turn) AS reply_to
        FROM id LEFT JOIN own USING (k)
        LEFT JOIN link ON link.conv_id IS NOT DISTINCT FROM id.conv_id AND link.turn = id.turn
        LEFT JOIN (SELECT DISTINCT conv_id, turn FROM m) prev
          ON prev.conv_id IS NOT DISTINCT FROM id.conv_id AND prev.turn = id.turn - 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                                        content, reply_to NULLS FIRST) - 1 AS place FROM msg)
SELECT conv_id, place // {threads.PART} AS part, count(*) AS n_messages, CAST(sum(n_links) AS BIGINT) AS n_links,
  string_agg(coalesce(CAST(reply_to AS VARCHAR), '-'), ',' ORDER BY place) AS replies,
  string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || content || chr(10), '' ORDER BY place) AS chat
FROM placed GROUP BY ALL"""
)
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.format_chats(table(spark, sf_dir, "conversations"))


@query()
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def _signature_values() -> str:
    rows = [(n, t, label, key, licenses.over_words(p)) for n, (t, label, key, p) in enumerate(licenses.all_rules())]
    return ",\n".join(f"({n}, {t}, '{label}', ' {key} ', '{p}')" for n, t, label, key, p in rows)


@query(
    f"""WITH rule(no, tier, label, keyword, pattern) AS (VALUES {_signature_values()}),
said AS (
  SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{licenses.SEPARATORS}', '  ', 'g'), ' ') AS said FROM documents),
padded AS (SELECT doc_id, CASE WHEN said = '' THEN '' ELSE ' ' || said || ' ' END AS t FROM said),
hit AS (
  SELECT doc_id, no, tier, label, regexp_split_to_array(t, pattern) AS pieces, regexp_extract_all(t, pattern) AS found
  FROM padded JOIN rule ON contains(t, keyword)),
place AS (
  SELECT doc_id, no, tier, label, unnest(generate_series(1, len(found))) AS k, pieces, found FROM hit),
span AS (
  SELECT doc_id, no, tier, label, (start - length(replace(lead_in, ' ', ''))) // 2 AS start,
    (start - length(replace(lead_in, ' ', '')) + length(one) - length(replace(one, ' ', ''))) // 2 AS stop
  FROM (SELECT *, array_to_string(pieces[1:k], '') || array_to_string(found[1:k - 1], '') AS lead_in,
               length(lead_in) AS start, found[k] AS one FROM place)),
kept AS (
  SELECT d.*, tier = 0 OR NOT EXISTS (
    FROM span e WHERE e.doc_id = d.doc_id AND e.tier BETWEEN 1 AND d.tier AND e.start <= d.start AND e.stop >= d.stop
    AND (e.tier < d.tier OR e.stop - e.start > d.stop - d.start
         OR (e.stop - e.start = d.stop - d.start AND e.no < d.no))) AS kept
  FROM span d)
SELECT p.doc_id, any_value((length(t) - length(replace(t, ' ', ''))) // 2) AS n_words,
  count(*) FILTER (tier = 0) AS n_base,
  min(start) FILTER (tier = 0) AS first_word, max(start) FILTER (tier = 0) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (tier = 0), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (kept), '') AS labels,
  coalesce(max(CASE tier {' '.join(f'WHEN {t} THEN {c}::DOUBLE' for t, c in licenses.CONFIDENCE.items())} END)
           FILTER (kept), 0.0::DOUBLE) AS score
FROM padded p LEFT JOIN kept k ON k.doc_id = p.doc_id GROUP BY p.doc_id"""
)
def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.align(table(spark, sf_dir, "documents")).rows
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


_LEAF_SQL = "sha256(concat(" + ", ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("doc_id", "source", "lang", "{n}", "text")
) + "))"
#: The checksum of the id, bit by bit: the polynomial shifts in once for each bit of each digit.
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda d: [ascii(d), 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)))"""


@query(
    f"""WITH RECURSIVE leaf AS (
  SELECT doc_id, lang, {_LEAF_SQL.format(n='n_chars')} AS leaf,
    CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_LEAF_SQL.format(n='(n_chars + 1)')} END AS other,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS slot, count(*) OVER (PARTITION BY lang) AS n
  FROM documents),
tree AS (
  SELECT lang, 0 AS lvl, slot, n, leaf AS h FROM leaf
  UNION ALL
  SELECT lang, lvl + 1, slot // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY slot))
  FROM tree WHERE n > 1 GROUP BY lang, lvl, slot // 2),
subroot AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS slot, count(*) OVER () AS n
  FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, slot, n, subroot AS h FROM subroot
  UNION ALL
  SELECT lvl + 1, slot // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY slot))
  FROM top WHERE n > 1 GROUP BY lvl, slot // 2),
height AS (SELECT DISTINCT lang, lvl FROM tree WHERE n > 1),
step AS (
  SELECT d.doc_id, x.lvl AS k, (d.slot >> x.lvl) & 1 AS side, coalesce(t.h, '') AS h
  FROM leaf d JOIN height x ON x.lang IS NOT DISTINCT FROM d.lang
  LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM d.lang AND t.lvl = x.lvl AND t.slot = xor(d.slot >> x.lvl, 1)
  UNION ALL
  SELECT d.doc_id, 100 + x.lvl, (s.slot >> x.lvl) & 1, coalesce(t.h, '')
  FROM leaf d JOIN subroot s ON s.lang IS NOT DISTINCT FROM d.lang
  CROSS JOIN (SELECT DISTINCT lvl FROM top WHERE n > 1) x
  LEFT JOIN top t ON t.lvl = x.lvl AND t.slot = xor(s.slot >> x.lvl, 1)),
path AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS k, side, h FROM step),
folded AS (
  SELECT doc_id, 0 AS k, coalesce(other, leaf) AS h FROM leaf
  UNION ALL
  SELECT f.doc_id, f.k + 1, sha256(CASE WHEN p.side = 1 THEN p.h || f.h ELSE f.h || p.h END)
  FROM folded f JOIN path p ON p.doc_id = f.doc_id AND p.k = f.k),
proof AS (SELECT doc_id, sha256(string_agg(h, '' ORDER BY k)) AS proof_sha256 FROM path GROUP BY doc_id),
ends AS (SELECT doc_id, arg_max(h, k) AS folded_root FROM folded GROUP BY doc_id)
SELECT d.doc_id, d.leaf, s.subroot, r.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
  e.folded_root, e.folded_root = r.h AS verified
FROM leaf d JOIN subroot s ON s.lang IS NOT DISTINCT FROM d.lang JOIN top r ON r.n = 1
LEFT JOIN proof p ON p.doc_id = d.doc_id JOIN ends e ON e.doc_id = d.doc_id"""
)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    tampered = F.when(id_remainder("doc_id", 7) == 0, manifest.leaf_digest(columns, {"n_chars": more}))
    claims = {"claimed": F.coalesce(tampered, manifest.leaf_digest(columns))}
    rows = manifest.verify(manifest.manifest(table(spark, sf_dir, "documents"), columns, claims=claims), "claimed")
    return rows.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", "verified",
    )
