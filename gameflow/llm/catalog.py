"""Registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gameflow.llm import (
    codes, collocations, decontam, htmltext, katz, mixing, quality, quotes, simhash, suffixes, tokens, toxicity, warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), "doc_id")


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations, which hold no quotes, are first written out as mails that quote."""
    return quotes.link_quotes(quotes.as_mail(_table(spark, sf_dir, "conversations")))


#: What was quoted must be found again and the texts be as they were: blank lines at either end
#: are dropped, and who quotes a text of blank lines only links to nothing.
OP2_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, regexp_matches(coalesce(text, ''), '[^\s]') AS says FROM conversations),
linked AS (
  SELECT t.*, CASE WHEN p.says THEN p.turn WHEN q.says THEN q.turn END AS reply_to,
         CASE WHEN q.turn IS NOT NULL THEN 2 WHEN p.turn IS NOT NULL THEN 1 ELSE 0 END AS quote_depth
  FROM t LEFT JOIN t p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1
         LEFT JOIN t q ON q.conv_id = t.conv_id AND q.turn = t.turn - 2),
chain AS (
  WITH RECURSIVE c AS (
    SELECT conv_id, turn, turn AS thread, 0 AS level FROM linked WHERE reply_to IS NULL
    UNION ALL
    SELECT l.conv_id, l.turn, c.thread, c.level + 1 FROM linked l JOIN c ON l.conv_id = c.conv_id AND l.reply_to = c.turn)
  SELECT * FROM c)
SELECT conv_id, turn, role, reply_to, thread, level, quote_depth,
       regexp_replace(text, '\A(?:[ \t\r]*\n)+|(?:\n[ \t\r]*)+\z', '', 'g') AS text
FROM linked JOIN chain USING (conv_id, turn)
"""


def op3_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.visible_text(_table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


_SKETCH = "(x >> greatest(length(bin(x)) - 6, 0)) << greatest(length(bin(x)) - 6, 0)"


def _quantiles_sql(group: str) -> str:
    return f"""
    SELECT {group}, measure, max(total) AS total,
           min(CASE WHEN upto * 100 >= total * 10 THEN value END) AS q10,
           min(CASE WHEN upto * 100 >= total * 50 THEN value END) AS q50,
           min(CASE WHEN upto * 100 >= total * 90 THEN value END) AS q90
    FROM (SELECT {group}, measure, value, sum(n) OVER (PARTITION BY {group}, measure) AS total,
                 sum(n) OVER (PARTITION BY {group}, measure ORDER BY value) AS upto
          FROM (SELECT {group}, measure, value, count(*) AS n FROM sketch GROUP BY ALL))
    GROUP BY {group}, measure"""


OP4_SQL = rf"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) t(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, source, len(words) AS n_words, list_sum(list_transform(words, lambda x: length(x))) AS wc,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeated r ON r.doc_id = w.doc_id),
rated AS (
  SELECT *, coalesce(wc, 0)::BIGINT AS word_chars, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         (100 * coalesce(wc, 0)) // greatest(n_words, 1) AS word_length, (1000 * n_symbols) // greatest(n_words, 1) AS symbol_rate,
         (1000 * n_dup_lines) // greatest(n_lines, 1) AS dup_line_rate, (1000 * n_repeat_words) // greatest(n_words, 1) AS repeat_rate
  FROM m),
sketch AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, measure, {_SKETCH} AS value
  FROM (SELECT lang, source, base_failed, unnest([
          struct_pack(measure := 'word_length', x := word_length::BIGINT), struct_pack(measure := 'symbol_rate', x := symbol_rate::BIGINT),
          struct_pack(measure := 'dup_line_rate', x := dup_line_rate::BIGINT), struct_pack(measure := 'repeat_rate', x := repeat_rate::BIGINT)], recursive := true)
        FROM rated)
  WHERE NOT base_failed),
own AS ({_quantiles_sql("lang, source")}),
wide AS ({_quantiles_sql("lang")}),
chosen AS (
  SELECT o.lang, o.source, o.measure, CASE WHEN o.total < 200 THEN w.q10 ELSE o.q10 END AS q10,
         CASE WHEN o.total < 200 THEN w.q50 ELSE o.q50 END AS q50, CASE WHEN o.total < 200 THEN w.q90 ELSE o.q90 END AS q90
  FROM own o JOIN wide w ON o.lang = w.lang AND o.measure = w.measure),
bounds AS (
  SELECT lang, source,
         max(CASE measure WHEN 'word_length' THEN q90 + greatest(200, 4 * (q90 - q50)) END) AS wl_high,
         max(CASE measure WHEN 'word_length' THEN q10 - greatest(200, 4 * (q50 - q10)) END) AS wl_low,
         max(CASE measure WHEN 'symbol_rate' THEN q90 + greatest(100, 4 * (q90 - q50)) END) AS sr_high,
         max(CASE measure WHEN 'dup_line_rate' THEN q90 + greatest(400, 4 * (q90 - q50)) END) AS dl_high,
         max(CASE measure WHEN 'repeat_rate' THEN q90 + greatest(400, 4 * (q90 - q50)) END) AS rr_high
  FROM chosen GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND word_length <= wl_high AND word_length >= wl_low AND symbol_rate <= sr_high
                AND dup_line_rate <= dl_high AND repeat_rate <= rr_high, false) AS kept
FROM rated LEFT JOIN bounds ON bounds.lang = coalesce(rated.lang, '') AND bounds.source = coalesce(rated.source, '')
"""


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.suffix_dedup(_table(spark, sf_dir, "documents"), texts=True)


def op7_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_texts(_table(spark, sf_dir, "documents"))


def op8_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_table(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


#: The level of the sources that are not full is found here by resharing until no more is left over.
OP9_SQL = r"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT source, source_size, sid, [3, 1, 2][(sid % 3 + 1)::INT] AS weight, 2 * source_size AS cap
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM src)),
reshared AS (
  SELECT 0 AS round, (SELECT sum(source_size) * 1.5 FROM weighed)::DOUBLE / (SELECT sum(weight) FROM weighed)::DOUBLE AS level
  UNION ALL
  SELECT round + 1, left_over / open_weight
  FROM (SELECT round, level, sum(source_size) * 1.5::DOUBLE - sum(CASE WHEN cap < level * weight THEN cap ELSE 0 END)::DOUBLE AS left_over,
               sum(CASE WHEN cap < level * weight THEN 0 ELSE weight END)::DOUBLE AS open_weight
        FROM reshared, weighed GROUP BY round, level)
  WHERE open_weight > 0 AND left_over / open_weight > level),
targets AS (
  SELECT source, sid, source_size, least(cap::DOUBLE, (SELECT max(level) FROM reshared) * weight) AS target FROM weighed),
cut AS (
  SELECT *, greatest(least(source_size, ceil(source_size / least(256.0::DOUBLE, greatest(target / 64, 1.0::DOUBLE)))::BIGINT), 1) AS blocks FROM targets),
needed AS (
  SELECT *, round(target / greatest(source_size, 1) * blocks)::BIGINT AS needs, source_size // blocks AS short, source_size % blocks AS longer FROM cut),
bounds AS (
  SELECT *, floor((sum(needs + 16) OVER (ORDER BY sid))::DOUBLE / (sum(needs + 16) OVER ())::DOUBLE * 2147483648)::BIGINT AS stop FROM needed),
slots AS (
  SELECT i AS slot, (i % 2147483648) * 1327217885 % 2147483648 AS point
  FROM (SELECT unnest(range(CAST((SELECT sum(needs + 16) FROM needed) AS BIGINT))) AS i)),
ranked AS (
  SELECT b.sid, blocks, needs, row_number() OVER (PARTITION BY b.sid ORDER BY slot) - 1 AS r
  FROM slots JOIN (SELECT *, coalesce(lag(stop) OVER (ORDER BY sid), 0) AS start FROM bounds) b ON point >= start AND point < stop),
plays AS (SELECT sid, r % blocks AS block, count(*) AS plays FROM ranked WHERE r < needs GROUP BY ALL),
played AS (
  SELECT p.sid, plays, block * short + least(block, longer) AS first, (block + 1) * short + least(block + 1, longer) AS last
  FROM plays p JOIN needed n ON n.sid = p.sid),
placed AS (
  SELECT doc_id, s.source, size, t.sid, source_size, target,
         sum(size) OVER (PARTITION BY t.sid ORDER BY md5(concat(doc_id::VARCHAR, '|mix-1')), doc_id ROWS UNBOUNDED PRECEDING) - size AS a
  FROM sizes s JOIN needed t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (
  SELECT doc_id, sum((least(a + size, last) - greatest(a, first)) * plays)::BIGINT AS taken
  FROM placed JOIN played p ON p.sid = placed.sid AND first < a + size AND last > a
  WHERE size > 0 GROUP BY doc_id)
SELECT doc_id, source, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM placed LEFT JOIN taken USING (doc_id)
"""


def op10_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


OP10_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
o AS (SELECT d, max(page_id) AS original FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN o ON o.d = p.d
"""


def op5_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.vector_codes(_table(spark, sf_dir, "embeddings"))


def _op12_sql(rounds: int = 6) -> str:
    """The rounds written out one after the other, in integers, with a row per component."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
d{k} AS MATERIALIZED (
  SELECT p.id, p.part, e.entry, sum((p.x - e.x) * (p.x - e.x)) AS d
  FROM parts p JOIN e{k} e ON e.part = p.part AND e.pos = p.pos GROUP BY p.id, p.part, e.entry),
a{k} AS MATERIALIZED (
  SELECT id, part, entry, d FROM (SELECT *, row_number() OVER (PARTITION BY id, part ORDER BY d, entry) AS r FROM d{k}) WHERE r = 1),
m{k} AS (
  SELECT a.part, a.entry, p.pos, sum(p.x)::BIGINT AS s, count(*)::BIGINT AS n
  FROM a{k} a JOIN parts p ON p.id = a.id AND p.part = a.part GROUP BY a.part, a.entry, p.pos),
e{k + 1} AS MATERIALIZED (
  SELECT e.part, e.entry, e.pos, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, e.x) AS x
  FROM e{k} e LEFT JOIN m{k} m ON m.part = e.part AND m.entry = e.entry AND m.pos = e.pos)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id AS id, label, [floor(4096 * v::DOUBLE)::BIGINT FOR v IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = len(embedding)),
parts AS MATERIALIZED (
  SELECT id, (i - 1) // (n // 8) AS part, (i - 1) % (n // 8) AS pos, v[i] AS x
  FROM (SELECT id, v, len(v) AS n, unnest(range(1, len(v) + 1)) AS i FROM kept)),
firsts AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS entry FROM kept ORDER BY id LIMIT 16),
e0 AS MATERIALIZED (SELECT p.part, f.entry, p.pos, p.x FROM firsts f JOIN parts p ON p.id = f.id),{",".join(steps)},
coded AS (
  SELECT a.id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} a GROUP BY a.id),
book AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM e{rounds})
SELECT id AS vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (id), book
"""


OP12_SQL = _op12_sql()


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f1 AS (SELECT lang, p, count(*) AS n FROM (SELECT lang, unnest(w) AS p FROM w) GROUP BY ALL),
f2 AS (
  SELECT lang, u, v, count(*) AS n FROM (SELECT lang, w[i] AS u, w[i + 1] AS v FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w))
  GROUP BY ALL HAVING count(*) >= 10),
f3 AS (
  SELECT lang, u, v, x, count(*) AS n
  FROM (SELECT lang, w[i] AS u, w[i + 1] AS v, w[i + 2] AS x FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM w))
  GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, u, v, max(n) AS n FROM (SELECT lang, u, v, n FROM f3 UNION ALL SELECT lang, v AS u, x AS v, n FROM f3) GROUP BY lang, u, v),
cuts AS (
  SELECT f.lang, f.u || ' ' || f.v AS phrase, 1 AS k, f.n AS a, p.n AS l, q.n AS r
  FROM f2 f JOIN f1 p ON p.lang = f.lang AND p.p = f.u JOIN f1 q ON q.lang = f.lang AND q.p = f.v
  LEFT JOIN longer g ON g.lang = f.lang AND g.u = f.u AND g.v = f.v WHERE 100 * coalesce(g.n, 0) < 50 * f.n
  UNION ALL
  SELECT f.lang, f.u || ' ' || f.v || ' ' || f.x, 1, f.n, p.n, q.n
  FROM f3 f JOIN f1 p ON p.lang = f.lang AND p.p = f.u JOIN f2 q ON q.lang = f.lang AND q.u = f.v AND q.v = f.x
  UNION ALL
  SELECT f.lang, f.u || ' ' || f.v || ' ' || f.x, 2, f.n, p.n, q.n
  FROM f3 f JOIN f2 p ON p.lang = f.lang AND p.u = f.u AND p.v = f.v JOIN f1 q ON q.lang = f.lang AND q.p = f.x),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE cut = 1)
SELECT ranked.lang, rank, phrase, a, l, r, t.n, score
FROM ranked JOIN (SELECT lang, sum(n)::BIGINT AS n FROM f1 GROUP BY lang) t ON t.lang = ranked.lang WHERE rank <= 2000
"""


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_benchmark_decontamination, op2_quotation_linking, op3_visible_text, op4_quality_rules, op5_simhash_components,
        op6_suffix_dedup, op7_katz_scores, op8_length_histogram, op9_source_mix, op10_warc_salvage,
        op11_toxicity_scores, op12_vector_codes, op13_collocations,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op2_quotation_linking": OP2_SQL, "op4_quality_rules": OP4_SQL, "op9_source_mix": OP9_SQL, "op10_warc_salvage": OP10_SQL,
    "op12_vector_codes": OP12_SQL, "op13_collocations": OP13_SQL,
}
