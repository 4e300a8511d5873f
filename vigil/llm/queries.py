"""Registered queries of the operators, each over its whole table, and SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import quality, rules, toxicity
from vigil.llm.common import Scratch, table
from vigil.llm.contamination import find_contamination
from vigil.llm.html import extract
from vigil.llm.html import fit as fit_html
from vigil.llm.neardup import near_duplicates
from vigil.llm.packing import pack_documents
from vigil.llm.prefixtrie import borrowed, numbered, trie
from vigil.llm.simhash import compare_neighbours, name_near
from vigil.llm.spelling import variants
from vigil.llm.substring import strip_repeats
from vigil.llm.tokencount import scan_files, stitch, write_tokens
from vigil.llm.warc import read_archives, write_archives
from vigil.plans.scratch import scratch_path

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


# CRC-32 in SQL: the table of its 256 steps, made by its rule, and a fold over bytes in hex.
CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1
                            THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS step
  FROM range(0, 256) t(i)
)
"""


def crc32_sql(text: str) -> str:
    """SQL for the CRC-32 of the UTF-8 bytes of ``text``, where ``crc_table`` is joined."""
    byte = "('0x' || substr(hex(encode(TEXT)), (2 * k + 1)::INTEGER, 2))::BIGINT"
    fold = (
        "xor(list_reduce(range(0, octet_length(encode(TEXT))), lambda c, k: "
        f"xor(step[xor(c, {byte}) % 256 + 1], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT)"
    )
    return fold.replace("TEXT", text)


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
places AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs
),
windows AS (
  SELECT doc_id, i, words[i] AS word,
         CASE WHEN i + 19 <= len(words) THEN array_to_string(words[i:i + 19], ' ') END AS seq
  FROM places
),
judged AS (
  SELECT doc_id, i, word,
         CASE WHEN seq IS NULL THEN 0
              WHEN row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) > 1 THEN 1
              ELSE 0 END AS again
  FROM windows
),
marked AS (
  SELECT doc_id, i, word,
         max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
           AS gone
  FROM judged
),
kept AS (
  SELECT doc_id, sum(gone) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""


@query("op1_substring_dedup", OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return strip_repeats(docs, min_words=20, with_text=False).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


OP2_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(lower_ascii, '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM (
    SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
    FROM benchmark
  )
),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n,
         array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS seq
  FROM (
    SELECT item_id, words,
           unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
    FROM item_words WHERE len(words) > 0
  )
),
docs AS (
  SELECT doc_id, regexp_extract_all(lower_ascii, '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
    FROM documents
  )
),
places AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs
),
hits AS (
  SELECT DISTINCT p.doc_id, p.i, w.n, w.item_id
  FROM (
    SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS seq
    FROM places, (SELECT DISTINCT n FROM item_windows)
    WHERE i + n - 1 <= len(words)
  ) p JOIN item_windows w ON p.seq = w.seq AND p.n = w.n
),
hit_words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op2_benchmark_decontamination", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    benchmark = table(spark, folder, "benchmark")
    found = find_contamination(docs, benchmark, n=10, with_text=False)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op3_token_counts")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as flat files of 16-bit ids; the counts come from the files alone."""
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, folder, "documents"), path)
    counts = stitch(scan_files(spark, path))
    number = F.regexp_extract("file", r"part-(\d+)-.*-c(\d+)", 1).cast("int")
    part = F.regexp_extract("file", r"part-(\d+)-.*-c(\d+)", 2).cast("int")
    return counts.select(
        number.alias("file"), part.alias("part"), "document", "start", "n_tokens"
    )


@query("op4_quality_classifier")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    fold = toxicity.fold(F.col("doc_id"), 3)
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    field = quality.fit(docs, labels.filter(fold != 1))
    scored = quality.score(docs, field, with_text=False)
    return scored.select("doc_id", (fold == 1).alias("held_out"), "score", "predicted")


@query("op5_document_fingerprints")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """``representative``: the least id with the same fingerprint, so that rows with the same one
    are its members. For ids divisible by 20, and null for the rest: ``n_near``, how many other
    documents have a fingerprint within the radius, and ``near``, the other fingerprints found,
    each by its distance, representative and number of members."""
    docs = table(spark, folder, "documents")
    scratch = Scratch(spark)
    compared = scratch.put(compare_neighbours(docs), "fingerprints")
    return name_near(compared, F.col("doc_id") % 20 == 0, scratch)


@query("op6_toxicity")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    fold = toxicity.fold(F.col("doc_id"), 5)
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    weights = toxicity.fit(docs, labels.filter(fold != 0))
    scored = toxicity.score(docs, weights, with_text=False)
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


OP7_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id,
         CASE WHEN len(words) = 1 THEN words[1] ELSE words[i] || ' ' || words[i + 1] END AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words), 2))) AS i
        FROM docs WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
near AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL
),
links AS (
  SELECT a, b FROM near JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * near.n >= 80 * (x.n + y.n - near.n)
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM docs
  UNION
  SELECT r.a, l.b FROM reached r JOIN both_ways l ON r.b = l.a
),
least_ids AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id,
       d.doc_id = c.component_id AS kept
FROM docs d LEFT JOIN sizes s USING (doc_id) JOIN least_ids c USING (doc_id)
"""


@query("op7_minhash_neardup", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = near_duplicates(docs, shingle=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op8_html_extraction")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extract(pages, fit_html(pages), with_html=False)


OP9_SQL = r"""
WITH bodies AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
),
hashed AS (
  SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex,
         min(page_id) OVER (PARTITION BY html) AS response
  FROM bodies
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, (k // 4 * 5 + 1)::INTEGER, 5))::INTEGER
           >> (15 - 5 * (k % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id > response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > response THEN response END AS refers_to
FROM hashed
"""


@query("op9_warc_revisits", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes=0)
    return read_archives(spark, path, with_body=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op10_best_fit_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), size=4096, end_id=1)


OP11_SQL = (
    "WITH " + CRC_TABLE + r""",
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
sizes AS (SELECT conv_id, count(*) AS size FROM turns GROUP BY conv_id),
ids AS (
  SELECT s.conv_id, h, s.conv_id - s.conv_id % 20 AS lender, least(h, coalesce(l.size, 0)) AS lent
  FROM (SELECT conv_id, {CRC} % 4 AS h FROM sizes, crc_table) s
  LEFT JOIN sizes l ON l.conv_id = s.conv_id - s.conv_id % 20
),
rebuilt AS (
  SELECT i.conv_id, t.place, role, text FROM ids i JOIN turns t ON t.conv_id = lender AND t.place < h
  UNION ALL
  SELECT i.conv_id, t.place - h + lent, role, text
  FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.place >= h
),
named AS (
  SELECT conv_id, place + 1 AS depth, text,
         sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
                OVER (PARTITION BY conv_id ORDER BY place)) AS name
  FROM rebuilt
),
prefixes AS (
  SELECT conv_id, 0 AS depth, 'root' AS name, 0 AS words FROM ids
  UNION ALL
  SELECT conv_id, depth, name, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM named
),
chained AS (
  SELECT *, lag(name) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
         depth = max(depth) OVER (PARTITION BY conv_id) AS is_end
  FROM prefixes
),
nodes AS (
  SELECT name, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
         min(parent) AS parent,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), ''))
           AS ends_sha256
  FROM chained GROUP BY name, depth
),
children AS (SELECT parent AS name, count(*) AS n_children FROM nodes GROUP BY parent),
own AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * words AS saved
  FROM nodes n LEFT JOIN children USING (name)
),
totals AS (
  SELECT p.name, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM own o JOIN prefixes p ON p.conv_id = o.conv_id AND p.depth <= o.depth GROUP BY p.name
)
SELECT o.conv_id, o.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM own o JOIN totals USING (name) LEFT JOIN own u ON o.parent = u.name
""".replace("{CRC}", crc32_sql("conv_id::VARCHAR"))
)


@query("op11_conversation_trie", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    turns = scratch.put(numbered(table(spark, folder, "conversations")), "turns")
    rebuilt, ids = borrowed(turns)
    return trie(scratch.put(rebuilt, "rebuilt"), scratch.put(ids, "ids"), scratch)


OP12_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)),
                             lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS seq
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM docs)
),
again AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, seq) > 1
),
repeated AS (
  SELECT doc_id, count(DISTINCT word) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS word FROM again) GROUP BY doc_id
),
measured AS (
  SELECT d.doc_id, len(words) AS n_words,
         length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words,
         len(list_filter(words, lambda w: lower(w) IN {STOP})) AS n_stop,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS n_bullet,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_open
  FROM docs d JOIN lines USING (doc_id) LEFT JOIN repeated r USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words
         AND 100 * word_chars BETWEEN 300 * n_words AND 1000 * n_words
         AND 100 * n_symbols <= 10 * n_words AND n_stop >= 2 AND 100 * n_stop >= 2 * n_words
         AND 100 * n_dup_lines <= 50 * n_lines AND 100 * n_bullet <= 90 * n_lines
         AND 100 * n_open <= 30 * n_lines AS kept
FROM measured
""".replace("{STOP}", "(" + ", ".join(f"'{word}'" for word in rules.STOP_WORDS) + ")")


@query("op12_quality_rules", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return rules.judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


OP13_SQL = (
    "WITH RECURSIVE " + CRC_TABLE + r""",
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (
    SELECT doc_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents
  )
  WHERE length(run) >= 6 GROUP BY ALL
),
hashed AS (
  SELECT run, times, {CRC} AS h FROM runs, crc_table
),
words AS (
  SELECT word, sum(times)::BIGINT AS n
  FROM (
    SELECT times, CASE WHEN h % 199 = 0
             THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
             ELSE run END AS word
    FROM hashed
  )
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
),
gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS gap,
         substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
  SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b
  ON a.gap = b.gap AND a.word <> b.word
  UNION
  SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.less = w.word
  UNION
  SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.less = w.word
),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS most,
         (list(other ORDER BY n DESC, encode(other)))[1] AS other
  FROM near GROUP BY word
),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN most >= 5 * w.n THEN other END AS form,
         CASE WHEN most >= 5 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best USING (word)
),
roots AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL
  UNION ALL
  SELECT f.word, r.root FROM forms f JOIN roots r ON f.form = r.word
)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN roots USING (word)
""".replace("{CRC}", crc32_sql("(doc_id || ':' || run)"))
)


@query("op13_spelling_variants", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return variants(docs, Scratch(spark)).select("word", "n", "n_near", "form", "form_n", "root")
