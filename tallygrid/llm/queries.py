"""The registered queries: each operator over its whole table, with production settings."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, exact, idfiles, katz, merkle, minhash, packing, resampling, secrets, sentencepieces,
               toxicity, vectors, warc)
from .common import remainder, ship, staged, text_of

QUERIES, ORACLE = {}, {}


def query(fn):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op10_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op10_exact_dedup"] = """
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM lowered"""


@query
def op6_pack_best_fit(spark: SparkSession, sf: str) -> DataFrame:
    windows = packing.packed(table(spark, sf, "documents"),
                             public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packing.piece_rows(windows).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op8_id_files(spark: SparkSession, sf: str) -> DataFrame:
    rows = staged(idfiles.token_rows(table(spark, sf, "documents"),
                                     public_tokenizers.path("word_bpe_49k.json"), end_id=1))
    back = idfiles.read_ids(spark, idfiles.write_ids(rows))
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


@query
def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    records = warc.with_revisits(table(spark, sf, "pages"))
    back = warc.read_archives(spark, warc.write_archives(records))
    return back.select(warc.page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", warc.page_id("refers_to").alias("refers_to"))


ORACLE["op3_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY t) AS first FROM payloads)
SELECT page_id, strlen(t) AS payload_bytes, sha256(t) AS payload_digest,
  CASE WHEN strlen(t) >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(t) >= 100 AND first <> page_id THEN first END AS refers_to
FROM firsts"""


@query
def op5_chat_windows(spark: SparkSession, sf: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").union(added)
    windows = chat.chat_windows(turns, public_tokenizers.path("word_bpe_49k.json"))
    return chat.digests(chat.read_windows(windows))


# All but formatted_chars, which follows from the windows chosen; the tests compare these.
CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256
FROM turns GROUP BY conv_id"""


@query
def op2_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf, "embeddings"))


ORACLE["op2_near_vectors"] = """
WITH RECURSIVE sound AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
units AS (SELECT vec_id, v FROM sound WHERE len([x for x in v if x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b ON a.vec_id <> b.vec_id
    AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS c FROM embeddings
  UNION SELECT l.a, r.c FROM reach r JOIN links l ON l.b = r.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
  (SELECT min(c) FROM reach r WHERE r.a = e.vec_id) AS component_id,
  (SELECT min(c) FROM reach r WHERE r.a = e.vec_id) = e.vec_id AS kept
FROM embeddings e"""


@query
def op4_prob_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents")).drop("text_key")


@query
def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scores = toxicity.scored(documents.select("doc_id", "text"), labels.select("doc_id", "toxic"),
                             remainder("doc_id", 5) != 0)
    return scores.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op1_sentencepieces(spark: SparkSession, sf: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    # whole texts, their ids and the texts read back go through Python: few rows at a time
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    rows = sentencepieces.encoded(table(spark, sf, "documents").select("doc_id", "text"), model)
    back = sentencepieces.decoded(rows, model)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                       F.xxhash64("ids").alias("ids_hash"), F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == text_of("text")).alias("same"))


@query
def op9_katz(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    model = katz.fit(documents.where(remainder("doc_id", 10) != 0), min_count=1)
    return katz.evaluate(documents, model).select(
        "doc_id", (remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


@query
def op11_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < secrets.RANDOM)
    return found.select(
        F.col("id").alias("doc_id"),
        *[secrets.counted(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"))


@query
def op12_resampling(spark: SparkSession, sf: str) -> DataFrame:
    drawn = resampling.resampled(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return drawn.withColumnRenamed("id", "doc_id")


# CRC-32 of the bytes of a text, in SQL: ``tab`` is the table of a byte's eight steps.
CRC_SQL = """tab AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1
    THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(i)))"""


def crc_sql(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
    range(strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])))"""


ORACLE["op12_resampling"] = rf"""
WITH {CRC_SQL},
words AS (
  SELECT 0 AS side, doc_id AS id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM documents
  UNION ALL SELECT 1, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
  FROM benchmark),
vocabulary AS (SELECT w, {crc_sql("w")} % 10000 AS bucket FROM (SELECT DISTINCT w FROM words), tab),
found AS (SELECT side, id, bucket FROM words JOIN vocabulary USING (w)),
sides AS (SELECT count(*) FILTER (side = 0) AS s_all, count(*) FILTER (side = 1) AS t_all FROM found),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE)
    / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM found GROUP BY bucket),
    sides),
weights AS (
  SELECT id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM found JOIN gains USING (bucket)
  WHERE side = 0 GROUP BY id),
scores AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT)
      + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights ON doc_id = id),
ranks AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS able
  FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= able * 10 // 100 THEN r END AS rank
FROM scores LEFT JOIN ranks USING (doc_id)"""


@query
def op13_merkle(spark: SparkSession, sf: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = merkle.leaf_of(*[F.replace(F.col(f), F.lit("\n"), F.lit("")) if f == "text" else F.col(f)
                                for f in fields])
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    carry = {"tampered": F.when(altered & F.contains("text", F.lit("\n")), tampered)}
    rows = merkle.manifest(table(spark, sf, "documents"), fields, "doc_id", "source", carry=carry)
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                       F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
                       folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(field_sql, ["doc_id", "source", "lang", "n_chars", text])) + ")"


# Level by level: ``nodes`` are the trees of the sources (tree 1, 2, …), then, as tree 0, that of
# their roots; ``walk`` goes up from each document.
ORACLE["op13_merkle"] = f"""
WITH RECURSIVE {CRC_SQL},
sources AS (SELECT source AS name, row_number() OVER (ORDER BY source NULLS FIRST) AS tree
  FROM (SELECT DISTINCT source FROM documents)),
leaves AS (
  SELECT d.doc_id, tree, {leaf_sql("text")} AS leaf,
    CASE WHEN {crc_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {leaf_sql("replace(text, chr(10), '')")}
      ELSE {leaf_sql("text")} END AS used
  FROM documents d JOIN sources s ON d.source IS NOT DISTINCT FROM s.name, tab),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM leaves),
low(tree, lvl, pos, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT tree, any_value(lvl) + 1, pos // 3, any_value(n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM low WHERE n > 1 GROUP BY tree, pos // 3),
subroots AS (SELECT tree, lvl, h FROM low WHERE n = 1),
high(tree, lvl, pos, n, h) AS (
  SELECT 0, 0, tree - 1, (SELECT count(*) FROM subroots), h FROM subroots
  UNION ALL
  SELECT 0, any_value(lvl) + 1, pos // 3, any_value(n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM high WHERE n > 1 GROUP BY pos // 3),
nodes AS (
  SELECT tree, lvl, pos, n,
    coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
    coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
  FROM (SELECT * FROM low UNION ALL SELECT * FROM high)
  WINDOW run AS (PARTITION BY tree, lvl, pos // 3 ORDER BY pos)),
walk(doc_id, leaf, own, tree, lvl, pos, proof, folded) AS (
  SELECT doc_id, leaf, tree, tree, 0, pos, '', used FROM placed
  UNION ALL
  SELECT doc_id, leaf, own, CASE WHEN n = 1 THEN 0 ELSE w.tree END, CASE WHEN n = 1 THEN 0 ELSE w.lvl + 1 END,
    CASE WHEN n = 1 THEN own - 1 ELSE w.pos // 3 END, proof || lefts || rights,
    CASE WHEN n = 1 THEN folded ELSE sha256(lefts || folded || rights) END
  FROM walk w JOIN nodes USING (tree, lvl, pos) WHERE NOT (w.tree = 0 AND n = 1))
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = r.h AS verified
FROM walk w JOIN subroots s ON s.tree = own, (SELECT lvl, h FROM high WHERE n = 1) r
WHERE w.tree = 0 AND w.lvl = r.lvl"""
