"""Queries opN_<name> over the standard tables, with production parameters, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import chat, fim, importance, language, lbl, mixing, pii, probminhash, quality_rules, spelling, spm, topk, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_read(spark, sf_dir, "documents"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_read(spark, sf_dir, "documents"))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.score(_read(spark, sf_dir, "documents"))


def public_model() -> str:
    """Path of the public SentencePiece model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.digests(_read(spark, sf_dir, "documents"), public_model())


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.classes(_read(spark, sf_dir, "documents"))


#: What the extra conversation -1 says, in both turns.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), said.alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    rows = rows.unionByName(extra).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("content"))
    return chat.digest(chat.format_conversations(rows))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(_read(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(_read(spark, sf_dir, "documents"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language.identify(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "n_words", F.size("segments").alias("n_segments"))


QUERIES = {
    "op2_personal_data": op2_personal_data,
    "op1_mix_sources": op1_mix_sources,
    "op3_topk_search": op3_topk_search,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_importance_resampling": op6_importance_resampling,
    "op7_log_bilinear": op7_log_bilinear,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_chat_format": op10_chat_format,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_language": op13_language,
}

_STOP = "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS)) + "]"

SQL: dict[str, str] = {
    "op1_mix_sources": r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
r AS (SELECT *, (CAST(CAST('0x' || substr(md5(concat_ws(':', '20240607', CAST(doc_id AS VARCHAR), CAST(size AS VARCHAR))), 1, 13) AS BIGINT) AS DOUBLE) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, source_size * 3 AS most, sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, CAST(total - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, coalesce(least(CAST(most AS DOUBLE), max(CASE WHEN level * weight <= most THEN level END) OVER () * weight), CAST(most AS DOUBLE)) AS target FROM l),
o AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(source_size * 3 AS DOUBLE), target / CAST(source_size AS DOUBLE) * source_size) / source_size ELSE 0 END AS raw FROM t),
p AS (SELECT *, CASE WHEN abs(raw - round(raw)) < 1e-9 THEN round(raw) ELSE raw END AS copies FROM o),
q AS (SELECT *, CAST(floor(copies) AS BIGINT) AS whole, copies - floor(copies) AS chance, target - floor(copies) * source_size AS budget FROM p),
j AS (SELECT r.doc_id, r.size, r.source, q.source_size, q.target, q.whole, q.chance, q.budget, CASE WHEN q.chance > 0 THEN ln(r.u / (1 - r.u)) - ln(q.chance / (1 - q.chance)) END AS rank FROM r JOIN q ON r.source IS NOT DISTINCT FROM q.source),
h AS (SELECT *, sum(size) OVER (PARTITION BY source, chance > 0 ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2 AS half FROM j)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies, source
FROM (SELECT *, whole + CASE WHEN chance > 0 AND half <= budget THEN 1 ELSE 0 END AS copies FROM h)
""",
    "op5_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
e AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
v AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o || ' ' || lead(word, 5) OVER o || ' ' || lead(word, 6) OVER o || ' ' || lead(word, 7) OVER o AS eight FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, eight) AS n FROM v WHERE eight IS NOT NULL) WHERE n > 1),
r AS (SELECT doc_id, CAST(sum(covered) AS BIGINT) AS n FROM (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS covered FROM t) GROUP BY doc_id),
m AS (
  SELECT e.doc_id, len(words) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines, length(text) - length(replace(text, '!', '')) AS n_exclamations, len(list_filter(words, lambda x: list_contains({_STOP}, x))) AS n_stop,
    len(list_filter(lines, lambda x: ends_with(rtrim(x), '...') OR ends_with(rtrim(x), '…'))) AS n_ellipsis, len(list_filter(lines, lambda x: substr(ltrim(x), 1, 1) IN ('-', '*', '•', '‣', '·'))) AS n_bullets
  FROM e LEFT JOIN r ON e.doc_id = r.doc_id
), q AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END::DOUBLE AS mean_word_chars, CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END::DOUBLE AS symbols_per_word, CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END::DOUBLE AS repeat_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END::DOUBLE AS dup_line_ratio, CASE WHEN n_words > 0 THEN n_exclamations / n_words ELSE 0.0 END::DOUBLE AS exclamations_per_word, CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0.0 END::DOUBLE AS stop_ratio,
    CASE WHEN n_lines > 0 THEN n_ellipsis / n_lines ELSE 0.0 END::DOUBLE AS ellipsis_line_ratio, CASE WHEN n_lines > 0 THEN n_bullets / n_lines ELSE 0.0 END::DOUBLE AS bullet_line_ratio, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(f"{m} >= {low}" for m, low, _ in quality_rules.RULES.values() if low is not None)} AND {" AND ".join(f"{m} <= {high}" for m, _, high in quality_rules.RULES.values() if high is not None)} AS kept,
  mean_word_chars, symbols_per_word, repeat_ratio, dup_line_ratio, exclamations_per_word, stop_ratio, ellipsis_line_ratio, bullet_line_ratio FROM q
""",
    "op3_topk_search": """
WITH f AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM f q JOIN f c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op10_chat_format": r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(replace(text, '\', '\\'), '(<)(\|turn\|>|\|body\|>|\|end\|>|\|image\|>|\|audio\|>|\|document\|>|s>|/s>|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>)|(\[)(INST\]|/INST\])', '\1\3\\\2\4', 'g') AS escaped FROM r
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, escaped)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, escaped) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|>') + length(role) + length('<|body|>') + length(escaped) + length('<|end|>')) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op11_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) for i in range(4)] AS hs FROM d),
c AS (
  SELECT doc_id, text, units, len(units) AS n, least(hs[1] % (len(units) + 1), hs[2] % (len(units) + 1)) AS low, greatest(hs[1] % (len(units) + 1), hs[2] % (len(units) + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 90 THEN 'plain' WHEN hs[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (SELECT doc_id, text, n, form, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle, array_to_string(units[high + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
""",
    "op12_spelling_variants": r"""
WITH RECURSIVE crc(i, k, c) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
), tab AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
o AS (SELECT id, run, count(*) AS times, hex(encode(id || ':' || run)) AS code FROM r GROUP BY ALL),
h AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, [CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT) for i in range(length(code) // 2)]), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM o, tab
), s AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM h),
w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM s GROUP BY word HAVING sum(times) >= 5 AND length(word) >= 6),
k AS (SELECT word, n, unnest(list_distinct(list_prepend(word, [substr(word, 1, i) || substr(word, i + 2) for i in range(length(word))]))) AS key FROM w),
c AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM k a JOIN k b ON a.key = b.key AND a.word <> b.word),
e AS (
  SELECT * FROM c WHERE CASE length(word) - length(near)
    WHEN 0 THEN len([1 for i in range(1, length(word) + 1) if substr(word, i, 1) <> substr(near, i, 1)]) = 1
    WHEN 1 THEN list_contains([substr(word, 1, i) || substr(word, i + 2) for i in range(length(word))], near)
    WHEN -1 THEN list_contains([substr(near, 1, i) || substr(near, i + 2) for i in range(length(near))], word) ELSE false END
), b AS (SELECT word, n, count(*) AS n_near, min({'m': -near_n, 'near': near}) AS best FROM e GROUP BY word, n),
f AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.best.m >= 5 * w.n THEN b.best.near END AS form, CASE WHEN -b.best.m >= 5 * w.n THEN -b.best.m END AS form_n FROM w LEFT JOIN b ON w.word = b.word),
g(word, root) AS (SELECT word, form FROM f WHERE form IS NOT NULL UNION ALL SELECT g.word, f.form FROM g JOIN f ON g.root = f.word WHERE f.form IS NOT NULL),
z AS (SELECT word, root FROM g WHERE root NOT IN (SELECT word FROM f WHERE form IS NOT NULL))
SELECT f.word, f.form, coalesce(z.root, f.word) AS root, f.n, f.n_near, f.form_n FROM f LEFT JOIN z ON f.word = z.word
""",
}
