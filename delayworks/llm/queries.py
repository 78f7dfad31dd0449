"""The registered queries of this package: each applies one operator, with production settings, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayworks.llm import chat, fim, licenses, merkle, minhash, mixing, packing, quality, simhash, substrings, toxicity, vectors, warc
from delayworks.llm.common import held_out, scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_quality")
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), quality.score(model, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    tagged = docs.select("doc_id", held_out("doc_id").alias("held_out"), toxicity.tag(model, "text").alias("t"))
    return tagged.select("doc_id", "held_out", F.col("t.score").alias("score"),
                         (F.col("t.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                         F.col("t.spans").alias("spans"))


@query("op3_packing")
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.stored_pieces(table(spark, folder, "documents"))
    digests = pieces.select("id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.place(digests).withColumnRenamed("id", "doc_id")


OP4_SQL = """
    WITH RECURSIVE v AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
      WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
              AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
    FROM embeddings e JOIN component c ON e.vec_id = c.a LEFT JOIN counts ON e.vec_id = counts.a"""


@query("op4_vectors", OP4_SQL)
def op4_vectors(spark: SparkSession, folder: str) -> DataFrame:
    found = vectors.near_duplicates(table(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


OP5_SQL = """
    WITH rows AS (
      SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
      UNION ALL SELECT -1, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) x(n, r)),
    shown AS (
      SELECT *, regexp_replace(regexp_replace(replace(t, '␛', '␛␛'), '(<)(s>|/s>|<SYS>>|</SYS>>)', '\\1␛\\2', 'g'),
                '(\\[)(/?INST\\]|/?ROLE\\]|END\\])', '\\1␛\\2', 'g') AS escaped FROM rows)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) AS turns_sha256,
           CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
           CAST(3 + sum(length(escaped) + CASE r WHEN 'user' THEN 13 WHEN 'system' THEN 15 WHEN 'assistant' THEN 4 ELSE 18 + length(r) END) AS BIGINT)
             AS formatted_chars
    FROM shown GROUP BY conv_id"""


@query("op5_chat", OP5_SQL)
def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.assemble(given.unionAll(probe))).withColumnRenamed("conv", "conv_id")


# base32 from the bits of the digest, five at a time
OP6_SQL = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, h, CAST(unhex(sha1(h)) AS BIT)::VARCHAR AS bits, max(page_id) OVER (PARTITION BY h) AS last FROM p)
    SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(range(5),
             lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS BIGINT), 1) AS INT) * (1 << (4 - j)))) AS BIGINT), 1)), '') AS payload_digest,
           CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> last THEN last END AS refers_to
    FROM d"""


@query("op6_warc", OP6_SQL)
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(warc.plan(table(spark, folder, "pages")), path)
    records = warc.read(spark, path, keep_payload=False)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


@query("op7_simhash")
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hexadecimal("fp").alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query("op8_mixing")
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixing.taken_words(mixed).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op9_minhash")
def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.compare_edited(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "fingerprint",
                        "edited_fingerprint", "near_edited", "near_next")


@query("op10_licenses")
def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "documents").select("doc_id", licenses.scan("text").alias("s"))
    return found.select("doc_id", "s.*")


# the CRC-32 of the id's digits bit by bit, the trees level by level, then each leaf's way up
OP11_SQL = """
    WITH RECURSIVE d AS (
      SELECT *, list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
          lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
      FROM documents),
    shown AS (
      SELECT doc_id, source, text, xor(crc, 4294967295) % 5 = 0 AS tampered,
             concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM d),
    leaves AS (
      SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             sha256(head || coalesce(strlen(text) || ':' || CASE WHEN tampered THEN low ELSE text END, '-')) AS claim FROM shown),
    nodes AS (
      SELECT source, 0 AS level, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n, leaf AS digest
      FROM leaves
      UNION ALL
      SELECT source, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY source, level, idx // 16, n),
    tops AS (
      SELECT 0 AS level, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n, digest, source FROM nodes WHERE n = 1
      UNION ALL
      SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)), NULL FROM tops WHERE n > 1 GROUP BY level, idx // 16, n),
    way AS (
      SELECT doc_id, source, 0 AS level, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS idx, leaf, claim AS now, '' AS proof FROM leaves
      UNION ALL
      SELECT w.doc_id, w.source, w.level + 1, w.idx // 16, w.leaf, sha256(string_agg(CASE WHEN s.idx = w.idx THEN w.now ELSE s.digest END, '' ORDER BY s.idx)),
             w.proof || coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx <> w.idx), '')
      FROM way w JOIN (SELECT * FROM nodes WHERE n > 1) s ON s.source IS NOT DISTINCT FROM w.source AND s.level = w.level AND s.idx // 16 = w.idx // 16
      GROUP BY w.doc_id, w.source, w.level, w.idx, w.leaf, w.now, w.proof),
    arrived AS (SELECT w.*, n.digest AS subroot FROM way w JOIN nodes n ON n.n = 1 AND n.source IS NOT DISTINCT FROM w.source AND n.level = w.level),
    higher AS (
      SELECT a.doc_id, a.leaf, a.subroot, 0 AS level, t.idx, a.now, a.proof
      FROM arrived a JOIN tops t ON t.level = 0 AND t.source IS NOT DISTINCT FROM a.source
      UNION ALL
      SELECT w.doc_id, w.leaf, w.subroot, w.level + 1, w.idx // 16, sha256(string_agg(CASE WHEN s.idx = w.idx THEN w.now ELSE s.digest END, '' ORDER BY s.idx)),
             w.proof || coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx <> w.idx), '')
      FROM higher w JOIN (SELECT * FROM tops WHERE n > 1) s ON s.level = w.level AND s.idx // 16 = w.idx // 16
      GROUP BY w.doc_id, w.leaf, w.subroot, w.level, w.idx, w.now, w.proof)
    SELECT h.doc_id, h.leaf, h.subroot, t.digest AS root, sha256(h.proof) AS proof_sha256, h.now AS folded_root, h.now = t.digest AS verified
    FROM higher h JOIN tops t ON t.n = 1 AND t.level = h.level"""


@query("op11_merkle", OP11_SQL)
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    made = merkle.build(table(spark, folder, "documents"), claimed={"text": F.when(tampered, low).otherwise(F.col("text"))})
    return merkle.audit(made).withColumnRenamed("id", "doc_id")


OP12_SQL = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || doc_id) AS h FROM documents),
    g AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3,
                 CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
    f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
    p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM f)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                       ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p"""


@query("op12_fim", OP12_SQL)
def op12_fim(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digests(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


OP13_SQL = r"""
    WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
    recurring AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS n FROM windows) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM recurring),
    words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)"""


@query("op13_substrings", OP13_SQL)
def op13_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
