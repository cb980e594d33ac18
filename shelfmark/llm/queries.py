"""The registered queries of this package, each next to its check SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    bpe, exact, html, language, lines, merkle, middle, multiset, near, packing, quality, substring, suffixes,
)
from shelfmark.plans.registry import table

QUERIES = {}
ORACLES = {}

BLANKS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return wrap


@query("op1_substring_dedup", r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, p, list_slice(w, p, p + 12) AS phrase
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words WHERE len(w) >= 13)),
firsts AS (SELECT phrase, min(doc_id) AS source FROM windows GROUP BY phrase),
covered AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM windows JOIN firsts USING (phrase) WHERE source < doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words)
         ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id) USING (doc_id)
""")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = substring.without_spans(docs, substring.duplicate_spans(docs))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def held_out(fold: int, folds: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold


@query("op2_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out(0, 5)), F.col("lang"))
    return language.predict(docs, model).select("doc_id", held_out(0, 5).alias("held_out"), "lang_pred", "score")


@query("op3_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op4_line_dedup", rf"""
WITH lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
               FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                              '{UPPER}', '{LOWER}') AS key FROM lines),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT doc_id, line, pos, coalesce(doc_id > first_doc, false) AS dropped FROM keyed LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = lines.kept_lines(docs, lines.line_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op5_exact_dedup", f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(low) AS text_sha256
FROM t WINDOW same AS (PARTITION BY low)
""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op6_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~held_out(2, 4)))
    return quality.score(docs, model).select("doc_id", held_out(2, 4).alias("held_out"), "score",
                                             (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op7_bpe")
def byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)


@query("op8_packing")
def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_minhash_near_dedup", rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
                        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda p: list_slice(w, p, p + 3))) END AS s
         FROM words),
classes AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
items AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM classes),
links AS (SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.g = b.g AND a.rep <> b.rep
            AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
          GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT rep, rep FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
labels AS (SELECT a AS rep, min(b) AS label FROM reach GROUP BY a)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(label, doc_id) AS component_id,
       doc_id = coalesce(label, doc_id) AS kept
FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s AND len(sets.s) > 0 LEFT JOIN labels USING (rep)
""")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), settings=near.Settings(shingle=4)).drop("text_hash")


@query("op10_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query("op11_suffix_array_dedup", """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
sized AS (SELECT doc_id, x, len(x) // 2 AS n FROM bytes),
pieces AS (SELECT doc_id, c, least(1000, n - 99 - c) AS m, x[2 * c + 1:2 * c + 2198] AS piece
           FROM (SELECT *, unnest(range(0, n - 99, 1000)) AS c FROM sized WHERE n >= 100)),
windows AS (SELECT doc_id, c + p AS p, piece[2 * p + 1:2 * p + 200] AS s FROM (SELECT *, unnest(range(m)) AS p FROM pieces)),
firsts AS (SELECT s, min((doc_id, p)) AS f FROM windows GROUP BY s),
late AS (SELECT doc_id, p FROM windows JOIN firsts USING (s) WHERE (doc_id, p) <> f),
ends AS (SELECT doc_id, p, max(p + 100) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
         FROM late),
grouped AS (SELECT doc_id, p, sum(CASE WHEN before >= p THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM ends),
spans AS (SELECT doc_id, span, min(p) AS a, max(p) + 100 AS b FROM grouped GROUP BY doc_id, span),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b, a AS o FROM spans
         UNION ALL SELECT doc_id, max(b), NULL, max(b) FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x[2 * g.a + 1:2 * coalesce(g.b, n)], '' ORDER BY g.o, g.a) AS k FROM gaps g JOIN sized USING (doc_id)
         GROUP BY doc_id),
totals AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM sized LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = suffixes.without_runs(docs, suffixes.repeated_runs(docs))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _field(column: str) -> str:
    return f"coalesce(octet_length(encode(CAST({column} AS VARCHAR))) || ':' || CAST({column} AS VARCHAR), '-')"


#: crc32 of the decimal id, bit by bit, as DuckDB has none
_CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1),
  lambda i: ascii(CAST(doc_id AS VARCHAR)[i])::UBIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8),
  lambda k: k::UBIGINT)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT)"""


@query("op12_merkle_manifest", f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, {_CRC32} % 7 = 0 AS tampered,
         sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text")))}) AS leaf,
         sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars + 1", "text")))}) AS other
  FROM documents),
leaves AS (SELECT *, coalesce('v' || lang, 'n') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                  count(*) OVER (PARTITION BY lang) AS n FROM rows),
up(tree, level, i, n, h) AS (
  SELECT tree, 0, i, n, leaf FROM leaves
  UNION ALL SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1
  GROUP BY tree, level, i // 2, (n + 1) // 2),
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS gi, count(*) OVER () AS gn FROM up WHERE n = 1),
top(level, i, n, h) AS (
  SELECT 0, gi, gn, subroot FROM subroots
  UNION ALL SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1
  GROUP BY level, i // 2, (n + 1) // 2),
steps AS (
  SELECT l.tree, l.i AS leaf_i, u.level, u.h AS sibling, CAST((l.i >> u.level) % 2 AS BIGINT) AS side
  FROM leaves l JOIN up u ON u.tree = l.tree AND u.n > 1 AND u.i = xor(l.i >> u.level, 1::BIGINT)
  UNION ALL
  SELECT l.tree, l.i, 1000 + t.level, t.h, CAST((s.gi >> t.level) % 2 AS BIGINT)
  FROM leaves l JOIN subroots s USING (tree) JOIN top t ON t.n > 1 AND t.i = xor(s.gi >> t.level, 1::BIGINT)),
proofs AS (SELECT tree, leaf_i, sha256(string_agg(sibling, '' ORDER BY level)) AS proof FROM steps GROUP BY tree, leaf_i),
levels AS (SELECT tree, level, row_number() OVER (PARTITION BY tree ORDER BY level) AS step FROM (
  SELECT DISTINCT tree, level FROM up WHERE n > 1
  UNION ALL SELECT tree, 1000 + level FROM subroots, (SELECT DISTINCT level FROM top WHERE n > 1))),
fold(tree, leaf_i, step, h) AS (
  SELECT tree, i, 0, CASE WHEN tampered AND n_chars_known THEN other ELSE leaf END
  FROM (SELECT l.*, other <> leaf AS n_chars_known FROM leaves l)
  UNION ALL
  SELECT f.tree, f.leaf_i, f.step + 1, sha256(CASE WHEN s.side = 0 THEN f.h || s.sibling WHEN s.side = 1 THEN s.sibling || f.h ELSE f.h END)
  FROM fold f JOIN levels v ON v.tree = f.tree AND v.step = f.step + 1
  LEFT JOIN steps s ON s.tree = f.tree AND s.leaf_i = f.leaf_i AND s.level = v.level),
folded AS (SELECT tree, leaf_i, max_by(h, step) AS h FROM fold GROUP BY tree, leaf_i)
SELECT doc_id, leaf, subroot, t.h AS root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM leaves l JOIN subroots USING (tree) JOIN folded f ON f.tree = l.tree AND f.leaf_i = l.i
  LEFT JOIN proofs p ON p.tree = l.tree AND p.leaf_i = l.i, top t
WHERE t.n = 1
""")
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0, F.lit(1)).otherwise(F.lit(0))
    proofs = merkle.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "lang",
                             claimed={"n_chars": F.col("n_chars").cast("decimal(20,0)") + changed})
    return merkle.verified(proofs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op13_fill_in_middle", """
WITH cut AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
rolled AS (SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3,
                  ('0x' || x[25:32])::BIGINT AS h4 FROM cut),
formed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM rolled),
parts AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
""")
def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.fill_in_middle(table(spark, sf_dir, "documents"))
