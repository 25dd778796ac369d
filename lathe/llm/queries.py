"""The corpus operators as registered queries, each over its whole table, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm import op01_langid, op02_mixing, op03_toxicity, op04_warc, op05_jaccard, op06_tokens, op07_binary, op08_decontam, op09_quality, op10_kdtree, op11_repair, op12_replay, op13_merkle
from lathe.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def crc_mod(col: str, n: int) -> Column:
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % n, F.lit(-1))


def op1_langid_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = op01_langid.fit(docs, crc_mod("doc_id", 3) != 1)
    got = op01_langid.predict(docs, model)
    return got.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "n_letter_words")


def op2_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = op02_mixing.mixed(table(spark, sf_dir, "documents"))
    return got.withColumn("rate", F.round("rate", 9))


def op3_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = op03_toxicity.fit(docs, labels, crc_mod("id", 5) != 0)
    got = op03_toxicity.score(docs, model)
    return got.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_warc_zdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = op04_warc.write_archives(table(spark, sf_dir, "pages"))
    return op04_warc.read_archives(manifest, folder)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op05_jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, layout = op07_binary.write_shards(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))
    return op07_binary.read_shards(manifest, layout)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_quality.cascade(table(spark, sf_dir, "documents")).drop("failed_rule")


def op10_kdtree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = op10_kdtree.shards(table(spark, sf_dir, "documents"), n_shards=40)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op11_repair.damaged(op11_repair.rows_of(table(spark, sf_dir, "conversations")))
    got = op11_repair.repair_digests(rows)
    return got.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return op12_replay.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_merkle.document_proofs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_langid_crf, op2_poisson_mix, op3_toxicity_nnpu, op4_warc_zdict, op5_ngram_jaccard, op6_token_counts, op7_training_shards, op8_decontamination, op9_quality_cascade, op10_kdtree_shards, op11_conversation_repair, op12_merge_replay, op13_merkle_manifest)
}

_BLANK = r"[\x20\x09-\x0D]"


def _crc32(name: str) -> str:
    """CRC-32 of an ASCII text in SQL, bit by bit: each byte enters with the first of its eight steps."""
    bits = f"flatten(list_transform(string_split({name}, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), {step}), 4294967295::BIGINT)"


def _leaf(n_chars: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


ORACLES: dict[str, str] = {
    "op2_poisson_mix": """
WITH by_source AS (SELECT source, sum(strlen(coalesce(text, ''))) AS bytes FROM documents GROUP BY source),
     weighted AS (SELECT source, bytes, pow(bytes::DOUBLE, 0.5) AS w FROM by_source),
     rates AS (SELECT source, CASE WHEN bytes > 0 THEN 1.0 * w / (SELECT sum(w) FROM weighted) * (SELECT sum(bytes) FROM weighted) / bytes ELSE 1.0::DOUBLE END AS rate FROM weighted),
     steps AS (SELECT source, rate, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM rates, range(0, 90) t(k)),
     drawn AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, s.rate,
                      ('0x' || substr(md5('mix#' || coalesce(d.doc_id::VARCHAR, md5(d.text), '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
               FROM documents d JOIN rates s ON d.source IS NOT DISTINCT FROM s.source),
     counted AS (SELECT *, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM drawn.source AND s.cdf <= drawn.u)::INT AS copies FROM drawn)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, copies, "copy"::INT AS "copy",
       ('0x' || substr(md5('mix-place#' || coalesce(doc_id::VARCHAR, md5(text), '') || '#' || "copy"), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS place
FROM (SELECT *, unnest(range(1, copies + 1)) AS "copy" FROM counted WHERE copies > 0)
""",
    "op4_warc_zdict": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4)::INT)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
""",
    "op5_ngram_jaccard": rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANK}+'), lambda x: x <> '') AS words FROM documents),
     s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                  ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles FROM w),
     e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS h FROM s),
     pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
     links AS (SELECT a, b FROM pairs WHERE 100 * common >= 75 * (na + nb - common)),
     ways AS (SELECT a AS x, b AS y FROM links UNION SELECT b, a FROM links),
     reach AS (SELECT x, y FROM ways UNION SELECT r.x, g.y FROM reach r JOIN ways g ON r.y = g.x)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m.low, s.doc_id)) AS component_id
FROM s LEFT JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) m ON m.x = s.doc_id
""",
    "op9_quality_cascade": rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANK}+'), lambda x: x <> '') AS words FROM documents),
     m AS (SELECT doc_id, words, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
                  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
     grams AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM m WHERE n_words >= 8)),
     twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
     covered AS (SELECT doc_id, count(DISTINCT i + j) AS c FROM twice, range(0, 8) r(j) GROUP BY doc_id),
     b AS (SELECT m.*, len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words FROM m LEFT JOIN covered USING (doc_id)),
     f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 5 * n_symbols > 2 * n_words OR 2 * n_dup_lines > n_lines
            OR 20 * len(list_filter(words, lambda x: length(x) > 60)) > n_words
            OR 2 * len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) < n_words
            OR 20 * len(list_distinct(words)) < n_words) AS kept
FROM f
""",
    "op11_conversation_repair": rf"""
WITH RECURSIVE
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hit AS (SELECT *, {_crc32('name')} % 20 AS k FROM raw),
dam AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
               CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit),
ord AS (SELECT conv_id, turn, role, text, left(role, 1) AS ini, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
               row_number() OVER w AS i, lag(left(role, 1)) OVER w AS prev
        FROM dam WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM ord),
sym AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
stat AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (i > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM sym GROUP BY conv_id),
ins(q, k, r) AS (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (0, 3, 2), (1, 0, 1), (1, 1, 2), (1, 2, 3), (1, 3, 2), (2, 0, 2), (2, 1, 3), (2, 2, 2), (2, 3, 3), (3, 0, 3), (3, 1, 2), (3, 2, 3), (3, 3, 2)),
keep(q, ini, r) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
made(q, r, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
names(r, role) AS (VALUES (2, 'user'), (3, 'assistant')),
-- rows inserted from a state on, as text
pad AS (SELECT q, k, r, 5 * k AS cost, repeat('I', k) AS audit,
               CASE k WHEN 0 THEN '' WHEN 1 THEN chr(10) || CASE r WHEN 2 THEN 'user:' ELSE 'assistant:' END
                      WHEN 2 THEN chr(10) || CASE r WHEN 2 THEN 'assistant:' ELSE 'user:' END || chr(10) || CASE r WHEN 2 THEN 'user:' ELSE 'assistant:' END
                      ELSE chr(10) || CASE r WHEN 2 THEN 'user:' ELSE 'assistant:' END || chr(10) || CASE r WHEN 2 THEN 'assistant:' ELSE 'user:' END || chr(10) || CASE r WHEN 2 THEN 'user:' ELSE 'assistant:' END END AS lines FROM ins),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS best FROM stat
  UNION ALL
  SELECT conv_id, i, q, min({{'c': c, 'a': a, 'o': o}}) FROM (
    SELECT d.conv_id, s.i, e.r AS q, d.best.c + p.cost + e.cost AS c, d.best.a || p.audit || e.edit AS a, d.best.o || p.lines || e.line AS o
    FROM dp d JOIN pad p ON p.q = d.q JOIN sym s ON s.conv_id IS NOT DISTINCT FROM d.conv_id AND s.i = d.i + 1,
    LATERAL (SELECT p.r, 2 AS cost, 'D' AS edit, '' AS line
             UNION ALL SELECT k.r, CASE s.fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K', chr(10) || s.role || ':' || s.text FROM keep k WHERE k.q = p.r AND k.ini = s.ini AND s.fault IN ('', 'truncated')
             UNION ALL SELECT m.r, CASE s.fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R', chr(10) || m.role || ':' || s.text FROM made m WHERE m.q = p.r AND s.fault IN ('', 'truncated')) e
  ) GROUP BY conv_id, i, q
),
fin AS (SELECT d.conv_id, min({{'c': d.best.c + p.cost, 'a': d.best.a || p.audit, 'o': d.best.o || p.lines}}) AS best
        FROM dp d JOIN stat t ON t.conv_id IS NOT DISTINCT FROM d.conv_id AND d.i = t.n JOIN pad p ON p.q = d.q AND p.r IN (0, 3) GROUP BY d.conv_id)
SELECT c.conv_id, coalesce(t.gaps, 0)::BIGINT AS gaps, coalesce(t.blank, 0)::BIGINT AS blank, coalesce(t.duplicate, 0)::BIGINT AS duplicate,
       coalesce(t.truncated, 0)::BIGINT AS truncated, coalesce(t.illegal, 0)::BIGINT AS illegal, coalesce(f.best.c, 0)::BIGINT AS cost,
       coalesce(f.best.a, '') AS audit, sha256(coalesce(substr(f.best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stat t ON t.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN fin f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE
docs AS (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
                CASE WHEN {_crc32("coalesce(doc_id::VARCHAR, '')")} % 7 = 0 AND doc_id IS NOT NULL THEN {_leaf('(n_chars + 1)')} END AS changed FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM docs),
tree AS (SELECT lang, 0 AS level, i, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM placed
         UNION ALL
         SELECT lang, level, i, d, count(*) OVER (PARTITION BY lang) AS n
         FROM (SELECT lang, level + 1 AS level, i // 2 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM tree WHERE n > 1 GROUP BY lang, level, i // 2)),
subs AS (SELECT lang, d AS subroot, level AS height FROM tree WHERE n = 1),
place AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM subs),
top AS (SELECT 0 AS level, i, subroot AS d, count(*) OVER () AS n FROM place
        UNION ALL
        SELECT level, i, d, count(*) OVER () AS n
        FROM (SELECT level + 1 AS level, i // 2 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM top WHERE n > 1 GROUP BY level, i // 2)),
-- every leaf's way up: the side it is on and its sibling, if any
way AS (SELECT a.doc_id, a.lang, a.i AS leaf_at, t.level, (a.i >> t.level) & 1 AS side, s.d
        FROM placed a JOIN tree t ON t.lang IS NOT DISTINCT FROM a.lang AND t.i = a.i >> t.level AND t.n > 1
        LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM t.lang AND s.level = t.level AND s.i = xor(t.i, 1)
        UNION ALL
        SELECT a.doc_id, a.lang, a.i, p.height + t.level, (p.i >> t.level) & 1, s.d
        FROM placed a JOIN place p ON p.lang IS NOT DISTINCT FROM a.lang JOIN top t ON t.i = p.i >> t.level AND t.n > 1
        LEFT JOIN top s ON s.level = t.level AND s.i = xor(t.i, 1)),
ways AS (SELECT lang, leaf_at, sha256(coalesce(string_agg(d, '' ORDER BY level), '')) AS proof_sha256,
                list_transform(list(struct_pack(side := side, d := d) ORDER BY level), lambda x: CASE WHEN x.d IS NULL THEN '' WHEN x.side = 1 THEN 'l' || x.d ELSE 'r' || x.d END) AS steps FROM way GROUP BY lang, leaf_at),
folded AS (SELECT a.doc_id, a.leaf, a.lang, coalesce(w.proof_sha256, sha256('')) AS proof_sha256,
                  list_reduce(list_concat([coalesce(a.changed, a.leaf)], coalesce(w.steps, [])),
                              lambda x, s: sha256(CASE left(s, 1) WHEN 'l' THEN substr(s, 2) || x WHEN 'r' THEN x || substr(s, 2) ELSE x END)) AS folded_root
           FROM placed a LEFT JOIN ways w ON w.lang IS NOT DISTINCT FROM a.lang AND w.leaf_at = a.i)
SELECT f.doc_id, f.leaf, p.subroot, r.d AS root, f.proof_sha256, f.folded_root, f.folded_root = r.d AS verified
FROM folded f JOIN place p ON p.lang IS NOT DISTINCT FROM f.lang, (SELECT d FROM top WHERE n = 1) r
""",
}
