"""Queries over the given tables: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (
    decontaminate,
    language,
    line_templates,
    merkle,
    mixing,
    near_dups,
    pack,
    quality,
    spelling,
    syncmers,
    token_store,
    tool_calls,
    warc,
)
from .common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_templates.without_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped_lines"),
        F.col("kept_text").alias("text"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "spans",
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.against_next(table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = warc.write(warc.chunk_table(table(spark, sf_dir, "pages")))
    return warc.resolved(warc.read(spark, folder, manifest, with_data=False))


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = token_store.write(table(spark, sf_dir, "documents"))
    return token_store.read(spark, folder, manifest)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return language.predict(table(spark, sf_dir, "documents"), held_out)


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.turns_as_calls(table(spark, sf_dir, "conversations"))
    out = tool_calls.link(calls, results, tool_calls.REPLY)
    return out.select(
        F.col("conversation").alias("conv_id"),
        "call_id",
        F.col("seq").alias("turn"),
        "delay",
        "n_results",
        "valid",
        F.array_join("errors", "; ").alias("errors"),
        "message",
    )


def op8_other_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.other_turns(table(spark, sf_dir, "conversations"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.packed(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    claimed = merkle.leaf([n_chars if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    out = merkle.verified(merkle.manifest(docs, claimed=claimed))
    digest = lambda c: F.lower(F.hex(c))
    return out.select(
        "doc_id",
        digest("leaf").alias("leaf"),
        digest("subroot").alias("subroot"),
        digest("root").alias("root"),
        digest("proof").alias("proof_sha256"),
        digest("folded").alias("folded_root"),
        "verified",
    )


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.runs(table(spark, sf_dir, "documents"))
    words = runs.select(spelling.slipped(F.col("doc"), F.col("run")).alias("word"))
    return spelling.variants(spelling.vocabulary(words))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_fingerprints": op3_fingerprints,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_warc": op5_warc,
    "op6_token_ids": op6_token_ids,
    "op7_language": op7_language,
    "op8_tool_calls": op8_tool_calls,
    "op8_other_turns": op8_other_turns,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_merkle": op11_merkle,
    "op12_mixing": op12_mixing,
    "op13_spelling": op13_spelling,
    "pipeline": corpus_pipeline.run,
}

_TOOL_CALLS_SQL = r"""
WITH calls AS (
  SELECT conv_id, turn, text, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS call_id,
         (conv_id + turn // 2) % 7 = 3 AS late,
         CAST(conv_id AS VARCHAR) || '-' || CAST(CASE
           WHEN (conv_id + turn // 2) % 7 = 3 THEN turn + 2
           WHEN turn >= 2 AND (conv_id + (turn - 2) // 2) % 7 <> 3 THEN turn - 2 END AS VARCHAR) AS after_id,
         CAST(len(regexp_extract_all(coalesce(text, ''), '\S+')) AS BIGINT) AS words
  FROM conversations WHERE role = 'user'),
results AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) || '-' || CAST(turn - 1 AS VARCHAR) AS call_id, turn, text,
         count(*) OVER w AS n_results, row_number() OVER (w ORDER BY turn, text NULLS FIRST) AS place
  FROM conversations WHERE role = 'assistant' WINDOW w AS (PARTITION BY conv_id, turn)),
answers AS (SELECT *, text AS content FROM results WHERE place = 1),
checked AS (
  SELECT c.conv_id, coalesce(c.call_id, a.call_id) AS call_id, c.turn, coalesce(a.n_results, 0) AS n_results,
         a.content, c.text, c.words, c.call_id IS NOT NULL AS called, coalesce(c.late AND p.call_id IS NOT NULL, false) AS delayed,
         concat_ws('; ',
           CASE WHEN c.call_id IS NULL THEN 'no call' END,
           CASE WHEN c.after_id IS NOT NULL AND p.call_id IS NULL THEN 'depends on no call: ' || c.after_id END,
           CASE WHEN a.n_results > 1 THEN 'more than one result' END,
           CASE WHEN c.call_id IS NOT NULL AND c.text IS NULL THEN 'prompt is missing' END,
           CASE WHEN length(c.text) < 16 THEN 'prompt has less than 16 characters' END,
           CASE WHEN c.words < 3 THEN 'words is below 3' END,
           CASE WHEN c.words > 30 THEN 'words is above 30' END) AS errors,
         coalesce(c.conv_id, a.conv_id) AS conversation
  FROM calls c FULL JOIN answers a ON c.conv_id = a.conv_id AND c.call_id = a.call_id
  LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.call_id = c.after_id)
SELECT conversation AS conv_id, call_id, turn, CAST(delayed AS BIGINT) AS delay, n_results, errors = '' AS valid, errors,
       '{"arguments":' || CASE WHEN called THEN
           '{' || CASE WHEN text IS NULL THEN '' ELSE '"prompt":' || CAST(to_json(text) AS VARCHAR) || ',' END
           || '"turn":' || CAST(turn AS VARCHAR) || ',"words":' || CAST(words AS VARCHAR) || '}' ELSE 'null' END
         || ',"id":' || CAST(to_json(call_id) AS VARCHAR)
         || ',"name":' || CASE WHEN called THEN '"reply"' ELSE 'null' END
         || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS message
FROM checked
UNION ALL
SELECT conv_id, call_id, turn, 0, n_results, false, 'further result',
       '{"arguments":null,"id":' || CAST(to_json(call_id) AS VARCHAR) || ',"name":null,"result":'
         || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || '}'
FROM results WHERE place > 1
"""

_OTHER_TURNS_SQL = """
SELECT conv_id, turn, role, CASE WHEN role = 'system' THEN 'no call' ELSE 'unknown role' END AS status,
       '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}' AS message
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""

def _crc_table() -> list[int]:
    """The remainders of all bytes, by the rule of crc32."""
    table = list(range(256))
    for _ in range(8):
        table = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return table


_CRC = f"xor(list_reduce([4294967295] || {{bytes}}, lambda c, b: xor(c >> 8, {_crc_table()}[xor(c & 255, b) + 1])), 4294967295)"


def _crc(numbers: str) -> str:
    """SQL of the unsigned crc32 of a list of byte values."""
    return _CRC.replace("{bytes}", numbers)


_DIGITS = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))"


def _field(column: str) -> str:
    value = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(n_chars if c == "n_chars" else c) for c in merkle.FIELDS) + ")"


_MERKLE_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
         {_leaf(f"(n_chars + CASE WHEN {_crc(_DIGITS)} % 7 = 0 THEN 1 ELSE 0 END)")} AS claimed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM docs),
low AS (
  SELECT tree, 0 AS level, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM low WHERE n > 1 GROUP BY tree, level, pos // 2),
subroots AS (
  SELECT tree, level AS height, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM high WHERE n > 1 GROUP BY level, pos // 2),
steps AS (
  SELECT p.tree, p.pos, l.level AS step, l.pos % 2 AS side, s.h AS sibling
  FROM placed p JOIN low l ON l.tree = p.tree AND l.pos = p.pos >> l.level AND l.n > 1
  LEFT JOIN low s ON s.tree = l.tree AND s.level = l.level AND s.pos = xor(l.pos, 1)
  UNION ALL
  SELECT p.tree, p.pos, r.height + l.level, l.pos % 2, s.h
  FROM placed p JOIN subroots r ON r.tree = p.tree JOIN high l ON l.pos = r.pos >> l.level AND l.n > 1
  LEFT JOIN high s ON s.level = l.level AND s.pos = xor(l.pos, 1)),
proofs AS (
  SELECT tree, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256, count(*) AS height
  FROM steps GROUP BY tree, pos),
folds AS (
  SELECT tree, pos, 0 AS step, claimed AS h FROM placed
  UNION ALL
  SELECT f.tree, f.pos, f.step + 1,
         sha256(CASE WHEN s.side = 1 THEN s.sibling || f.h ELSE f.h || coalesce(s.sibling, '') END)
  FROM folds f JOIN steps s ON s.tree = f.tree AND s.pos = f.pos AND s.step = f.step)
SELECT p.doc_id, p.leaf, r.subroot, t.h AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
       f.h AS folded_root, f.h = t.h AS verified
FROM placed p JOIN subroots r ON r.tree = p.tree
LEFT JOIN proofs q ON q.tree = p.tree AND q.pos = p.pos
JOIN folds f ON f.tree = p.tree AND f.pos = p.pos AND f.step = coalesce(q.height, 0)
CROSS JOIN (SELECT h FROM high WHERE n = 1) t
"""

_MIXING_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('0' || source, '1') AS source, text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sized AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source) - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM sized),
-- with the sources in the order in which they fill up, the level if those before are full
filled AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
-- the first source that is not full sets the level
levels AS (SELECT min_by(level, cap / weight) AS level FROM filled WHERE cap > weight * level),
goals AS (SELECT source, source_size, coalesce(least(CAST(cap AS DOUBLE), weight * level), cap) AS target FROM weighed, levels),
expected AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS e,
         (CAST('0x' || substr(sha256('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM docs d JOIN goals USING (source)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY (u / (1 - u)) / ((e - floor(e)) / (1 - (e - floor(e)))), doc_id) AS place
  FROM expected WHERE e > floor(e) AND size > 0),
fitted AS (
  SELECT source, CAST(floor(any_value(target) - sum(floor(e) * size)) AS BIGINT) AS gap, 0 AS place, CAST(NULL AS BIGINT) AS doc_id, false AS more
  FROM expected GROUP BY source
  UNION ALL
  SELECT f.source, CASE WHEN r.size <= f.gap THEN f.gap - r.size ELSE f.gap END, r.place, r.doc_id, r.size <= f.gap
  FROM fitted f JOIN ranked r ON r.source = f.source AND r.place = f.place + 1)
SELECT e.doc_id, e.size, e.source_size, e.target,
       e.size * (CAST(floor(e.e) AS BIGINT) + CASE WHEN f.more THEN 1 ELSE 0 END) AS taken
FROM expected e LEFT JOIN fitted f ON f.source = e.source AND f.doc_id = e.doc_id AND f.place > 0
"""

_SPELLING_SQL = f"""
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
counted AS MATERIALIZED (
  SELECT row_number() OVER () AS id, run, n, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR) || ':' || run, ''),
         lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, CAST(ord(c) - 64 AS BIGINT)] END)) AS bytes
  FROM (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL)),
longest AS MATERIALIZED (SELECT max(len(bytes)) AS m FROM counted),
-- crc32 is linear: what a byte adds to it depends on the byte and on how many follow
bytes AS MATERIALIZED (SELECT unnest(range(256)) AS byte, unnest({_crc_table()}) AS crc),
adds AS (
  SELECT byte, 0 AS behind, crc FROM bytes
  UNION ALL
  SELECT a.byte, a.behind + 1, xor(a.crc >> 8, b.crc) FROM adds a JOIN bytes b ON b.byte = a.crc & 255
  WHERE a.behind < (SELECT m FROM longest)),
zeros AS (
  SELECT 0 AS length, 4294967295 AS crc
  UNION ALL
  SELECT z.length + 1, xor(z.crc >> 8, b.crc) FROM zeros z JOIN bytes b ON b.byte = z.crc & 255
  WHERE z.length < (SELECT m FROM longest)),
hashes AS MATERIALIZED (
  SELECT id, bit_xor(a.crc) AS h
  FROM (SELECT id, unnest(bytes) AS byte, len(bytes) - unnest(range(1, len(bytes) + 1)) AS behind FROM counted) c
  JOIN adds a ON a.byte = c.byte AND a.behind = c.behind GROUP BY id),
hashed AS MATERIALIZED (
  SELECT run, n, xor(xor(h, z.crc), 4294967295) AS h
  FROM counted c JOIN hashes USING (id) JOIN zeros z ON z.length = len(c.bytes)),
vocab AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
  GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
cuts AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT c.word, v.word, v.n FROM cuts c JOIN vocab v ON v.word = c.rest
  UNION
  SELECT v.word, c.word, c.n FROM cuts c JOIN vocab v ON v.word = c.rest),
best AS (
  SELECT word, count(*) AS n_near, min_by(other, {{'n': -other_n, 'w': encode(other)}}) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
         CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM vocab v LEFT JOIN best b ON b.word = v.word),
paths AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL
  SELECT p.word, f.word, f.form FROM paths p JOIN forms f ON f.word = p.next)
SELECT f.word, f.form, p.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN paths p ON p.word = f.word AND p.next IS NULL
"""

#: By query, where SQL can express it.
SQL: dict[str, str] = {
    "op8_tool_calls": _TOOL_CALLS_SQL,
    "op8_other_turns": _OTHER_TURNS_SQL,
    "op11_merkle": _MERKLE_SQL,
    "op12_mixing": _MIXING_SQL,
    "op13_spelling": _SPELLING_SQL,
}
