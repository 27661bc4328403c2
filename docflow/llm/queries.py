"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import chat, decontam, exact_dedup, langid, lm, merkle, mixing, quality, sharding, simhash, toxicity, url_filter, vector_codes
from docflow.llm.common import crc_mod, read, text_of

CUT = 0.3
SHARDS = 8
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod("doc_id", 5) == 0
    labels = read(spark, sf_dir, "labels").filter(~held_out)
    out = quality.classify(read(spark, sf_dir, "documents"), labels, "quality")
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(read(spark, sf_dir, "pages"), URL_RULES)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod("doc_id", 4) == 2
    docs = read(spark, sf_dir, "documents")
    grammar = toxicity.fit(docs, read(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.scores(docs, grammar).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"), crc_mod("doc_id", 10) != 0)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.examples(turns.unionByName(extra)))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod("doc_id", 4) == 2
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shuffled_shards(read(spark, sf_dir, "documents"), SHARDS)
    text = text_of("text")
    return out.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(read(spark, sf_dir, "embeddings"))
    code = F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return vector_codes.label_errors(coded).select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error",
                                                   F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = F.when(crc_mod("doc_id", 7) == 0, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    tampered = merkle.digest(*[merkle.field(c) for c in ("doc_id", "source", "lang", more, "text")])
    out = merkle.manifest(read(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], extra={"tampered": tampered})
    folded = out.withColumn("folded_root", merkle.fold(F.col("tampered"), "steps"))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings("steps"), 256).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_simhash, op3_quality, op4_decontaminate, op5_mix, op6_url_filter,
                                   op7_toxicity, op8_lm_score, op9_chat, op10_language, op11_sharding, op12_vector_codes, op13_merkle)}


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds of op12 as a chain of common table expressions."""
    def assigned(k: int) -> str:
        return f"""
a{k} AS (SELECT vec_id, part, min(d * {entries} + entry) % {entries} AS entry, min(d * {entries} + entry) // {entries} AS d
        FROM (SELECT p.vec_id, p.part, e.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - e.x[i]) * (p.x[i] - e.x[i]))) AS d
              FROM p JOIN e{k} e USING (part)) GROUP BY vec_id, part)"""
    def refined(k: int) -> str:
        return f""",
m{k} AS (SELECT a.part, a.entry, i, CAST(sum(p.x[i]) AS HUGEINT) AS s, count(*) AS n FROM a{k} a JOIN p USING (vec_id, part), unnest(range(1, len(p.x) + 1)) AS u(i)
        GROUP BY a.part, a.entry, i),
q{k} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM m{k} GROUP BY part, entry),
e{k + 1} AS (SELECT part, entry, coalesce(q.x, e.x) AS x FROM e{k} e LEFT JOIN q{k} q USING (part, entry)),"""
    chain = "".join(assigned(k) + refined(k) for k in range(rounds)) + assigned(rounds)
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS x FROM v, unnest(range({parts})) AS u(part)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < {entries}),
e0 AS (SELECT part, entry, [CAST(c AS HUGEINT) FOR c IN x] AS x FROM p JOIN f USING (vec_id)),{chain},
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM e{rounds}),
r AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r JOIN v USING (vec_id), b"""


SQL = {
    "op1_exact_dedup": """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""",
    "op4_decontaminate": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS phrase
            FROM b, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS u(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT k FROM windows),
places AS (SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
           FROM d, lengths, unnest(generate_series(1, len(w) - k + 1)) AS u(i) WHERE len(w) >= k),
hits AS (SELECT doc_id, i, p.k, item FROM places p JOIN windows USING (k, phrase)),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM hits, unnest(generate_series(0, k - 1)) AS u(o) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op9_chat": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
             19 + length(regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')) +
             length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')) + 4 AS size
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
r AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY pos) AS upto, role = 'assistant' AS hit FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE hit), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE hit), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (WHERE hit OR pos = n) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id""",
    "op12_vector_codes": _codes_sql(),
    "op13_merkle": r"""
WITH RECURSIVE d AS (SELECT doc_id, lang, n_chars, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') AS f_id,
       coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS f_from,
       coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS f_chars,
       coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS f_more,
       coalesce(strlen(text) || ':' || text, '-') AS f_text,
       list_transform(range(length(coalesce(CAST(doc_id AS VARCHAR), ''))), lambda i: ord(substr(CAST(doc_id AS VARCHAR), i + 1, 1))) AS bytes FROM documents),
c AS (SELECT *, xor(list_reduce(bytes, lambda a, b: list_reduce(range(8), lambda x, k:
          CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(a, b)), 4294967295), 4294967295) AS crc FROM d),
l AS (SELECT doc_id, lang, sha256(f_id || f_from || f_chars || f_text) AS leaf,
             sha256(f_id || f_from || CASE WHEN crc % 7 = 0 THEN f_more ELSE f_chars END || f_text) AS changed FROM c),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             count(*) OVER (PARTITION BY lang) AS n FROM l),
up AS (SELECT lang, 0 AS lvl, i, n, leaf AS h FROM o
       UNION ALL SELECT lang, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY lang, lvl, i // 2, n),
s AS (SELECT lang, lvl AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j, count(*) OVER () AS m FROM up WHERE n = 1),
top AS (SELECT 0 AS lvl, j, m, subroot AS h FROM s
        UNION ALL SELECT lvl + 1, j // 2, (m + 1) // 2, sha256(string_agg(h, '' ORDER BY j)) FROM top WHERE m > 1 GROUP BY lvl, j // 2, m),
r AS (SELECT lvl AS top_height, h AS root FROM top WHERE m = 1),
p AS (SELECT doc_id, o.lang, o.i, leaf, changed, subroot, height, j, root, height + top_height AS steps
      FROM o JOIN s ON o.lang IS NOT DISTINCT FROM s.lang CROSS JOIN r),
f AS (SELECT lang, i, height, j, steps, 0 AS lvl, changed AS acc, '' AS proof FROM p
      UNION ALL
      SELECT f.lang, f.i, f.height, f.j, f.steps, f.lvl + 1,
             sha256(CASE WHEN f.lvl < f.height AND (f.i >> f.lvl) % 2 = 1 OR f.lvl >= f.height AND (f.j >> (f.lvl - f.height)) % 2 = 1
                         THEN coalesce(u.h, t.h, '') || acc ELSE acc || coalesce(u.h, t.h, '') END), proof || coalesce(u.h, t.h, '')
      FROM f LEFT JOIN up u ON f.lvl < f.height AND u.lang IS NOT DISTINCT FROM f.lang AND u.lvl = f.lvl AND u.i = xor(f.i >> f.lvl, 1)
             LEFT JOIN top t ON f.lvl >= f.height AND t.lvl = f.lvl - f.height AND t.j = xor(f.j >> (f.lvl - f.height), 1)
      WHERE f.lvl < f.steps)
SELECT p.doc_id, p.leaf, p.subroot, p.root, sha256(f.proof) AS proof_sha256, f.acc AS folded_root, f.acc = p.root AS verified
FROM p JOIN f ON p.lang IS NOT DISTINCT FROM f.lang AND p.i = f.i AND f.lvl = f.steps""",
}
