"""One query for each operator of this package, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from sightlake.llm import (
    block_names, decontaminate, grid_codes, html_content, importance, licenses, line_templates,
    quality_model, quality_rules, sentencepiece_codec, simhash, suffix_dedup, token_files,
)
from sightlake.queries import Query, table
from sightlake.session import staging_path

PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


def op1_sentencepiece(spark, sf_dir):
    """Ids of every document with an end id, and what they decode to."""
    model = public_tokenizers.path(PIECES)
    coded = sentencepiece_codec.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_simhash(spark, sf_dir):
    """Fingerprints of three-word shingles, linked at three bits or fewer."""
    found = simhash.near_duplicates(
        table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op3_licenses(spark, sf_dir):
    """License statements of every document: the base phrases, and what the rules add."""
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts = F.transform("base", lambda d: d["start"])
    base = licenses.labels(F.col("base"))
    both = F.array_sort(F.array_union(base, licenses.labels(F.col("detections"))))
    sure = F.array_max(F.transform("detections", lambda d: d["confidence"]))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.coalesce(sure, F.lit(0.0)).alias("score"))


def op4_token_files(spark, sf_dir):
    """Ids of every document written as Arrow sequences, and what the files say of them."""
    folder = staging_path(spark, "token_files")
    manifest = token_files.write_files(
        table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORDS), end_id=1)
    return token_files.read_documents(spark, manifest, folder)


def op5_decontamination(spark, sf_dir):
    """Words of every document that lie in passages of the benchmark."""
    found = decontaminate.find_benchmark(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"))


OP5_SQL = """
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
span AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS size,
    array_to_string(list_slice(ws, i, i + least(13, len(ws)) - 1), ' ') AS win
  FROM item, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS r(i) WHERE len(ws) > 0),
doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
place AS (
  SELECT doc_id, i, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS win
  FROM (SELECT DISTINCT size FROM span), doc, unnest(range(1, len(ws) - size + 2)) AS r(i)),
hit AS (SELECT doc_id, i, size, item_id FROM place JOIN span USING (size, win)),
word AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_hit
  FROM hit, unnest(range(0, size)) AS r(j) GROUP BY doc_id),
met AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN met USING (doc_id)
"""


def op6_quality_model(spark, sf_dir):
    """Quality and toxicity of every document, and whether it is kept."""
    scored = quality_model.classify(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "quality", "toxicity", "kept")


def op7_line_dedup(spark, sf_dir):
    """Every document without the lines of templates that recur in other documents."""
    left = line_templates.drop_recurring(
        table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"), n_chars="n_chars")
    return left.select("doc_id", "text", "n_chars", "n_dropped")


def op8_quality_rules(spark, sf_dir):
    """The ledger of every document, and what the strict policy keeps of it."""
    written = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return written.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.STRICT).alias("kept"), "failed")


def op9_html_content(spark, sf_dir):
    """The main text of every page."""
    return html_content.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", "n_chars")


def op10_suffix_dedup(spark, sf_dir):
    """Every document without the bytes of strings of 400 that stand elsewhere, too."""
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


OP8_SQL = """
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS w
  FROM doc, unnest(range(1, len(ws) - 6)) AS r(i) WHERE len(ws) >= 8),
twice AS (SELECT doc_id, w FROM win GROUP BY doc_id, w HAVING count(*) > 1),
again AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM win JOIN twice USING (doc_id, w),
    unnest(range(0, 8)) AS r(j) GROUP BY doc_id),
line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM doc)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN again USING (doc_id) LEFT JOIN line USING (doc_id)),
f AS (
  SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)
      THEN 16 ELSE 0 END AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed % 4 <> 0 AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed FROM f
"""

def op11_importance(spark, sf_dir):
    """Documents drawn to look like the benchmark."""
    found = importance.resample(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"),
        percent=10, seed="2024")
    return found.select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 is stated bit by bit (its polynomial is a fixed value), for each distinct word.
OP11_SQL = """
WITH entry AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i)),
crc AS (SELECT list(c ORDER BY i) AS t FROM entry),
doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
item AS (
  SELECT regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
dw AS (SELECT doc_id, unnest(ws) AS w FROM doc), tw AS (SELECT unnest(ws) AS w FROM item),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(
      range(CAST(length(hex(w)) / 2 AS BIGINT)),
      lambda i: CAST('0x' || substr(hex(w), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM dw UNION SELECT w FROM tw), crc),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM tw JOIN hashed USING (w) GROUP BY bucket),
gain AS (
  SELECT b AS bucket, floor(1000 * ln(
    (CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * (SELECT coalesce(sum(n), 0) + 10000 FROM s))
    / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * (SELECT coalesce(sum(n), 0) + 10000 FROM t)))) AS g
  FROM range(10000) AS r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
weighed AS (
  SELECT doc_id, CAST(sum(g) AS BIGINT) AS weight
  FROM dw JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc.doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST(
      '0x' || substr(sha256('2024:' || CAST(doc.doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE)
      + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM doc LEFT JOIN weighed USING (doc_id)),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE n_features >= 20
  QUALIFY rank <= (SELECT count(*) * 10 // 100 FROM scored WHERE n_features >= 20))
SELECT scored.doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)
"""


def op12_exact_dedup(spark, sf_dir):
    """Every document with the one that stays of those equal to it."""
    return block_names.exact_copies(table(spark, sf_dir, "documents")).drop("place")


OP12_SQL = """
WITH doc AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS solid FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY solid ORDER BY n DESC, doc_id) AS place,
    first_value(doc_id) OVER (PARTITION BY solid ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY solid) AS group_size FROM doc)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept,
  sha256(solid) AS text_sha256 FROM ranked
"""


def op13_vector_codes(spark, sf_dir):
    """Every usable vector as a code of sixteen parts, with its error and its label's."""
    return grid_codes.compress(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def _codes_sql(parts, entries, rounds):
    def nearest(book):
        return (
            "SELECT vec_id, part, q, entry, d FROM (SELECT vec_id, part, q, entry, list_sum("
            "list_transform(range(1, len(q) + 1), lambda i: (q[i] - e[i]) * (q[i] - e[i]))) AS d "
            f"FROM p JOIN {book} USING (part)) "
            "QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1")

    steps = []
    for i in range(rounds):
        steps += [
            f"a{i} AS ({nearest(f'b{i}')})",
            f"m{i} AS (SELECT part, entry, list(total ORDER BY i) AS e FROM (SELECT part, entry, i, "
            f"CAST(floor(sum(q[i]) / count(*)) AS BIGINT) AS total FROM a{i}, unnest(range(1, len(q) + 1)) "
            "AS r(i) GROUP BY part, entry, i) GROUP BY part, entry)",
            f"b{i + 1} AS (SELECT b{i}.part, b{i}.entry, coalesce(m{i}.e, b{i}.e) AS e FROM b{i} "
            f"LEFT JOIN m{i} ON m{i}.part = b{i}.part AND m{i}.entry = b{i}.entry)"]
    return f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x:
    CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS z FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT vec_id, part, list_slice(z, part * (len(z) // {parts}) + 1, (part + 1) * (len(z) // {parts})) AS q
  FROM v, unnest(range({parts})) AS r(part)),
b0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, q AS e
  FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries})),
{', '.join(steps)},
f AS ({nearest(f'b{rounds}')}),
coded AS (
  SELECT vec_id, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code,
    CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY vec_id),
book AS (
  SELECT string_agg(array_to_string(e, ','), ',' ORDER BY part, entry) AS numbers FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  sha256(numbers) AS codebooks_sha256 FROM coded JOIN v USING (vec_id), book
"""


QUERIES = {
    "op1_sentencepiece": Query(op1_sentencepiece),
    "op2_simhash": Query(op2_simhash),
    "op3_licenses": Query(op3_licenses),
    "op4_token_files": Query(op4_token_files),
    "op5_decontamination": Query(op5_decontamination, OP5_SQL),
    "op6_quality_model": Query(op6_quality_model),
    "op7_line_dedup": Query(op7_line_dedup),
    "op8_quality_rules": Query(op8_quality_rules, OP8_SQL),
    "op9_html_content": Query(op9_html_content),
    "op10_suffix_dedup": Query(op10_suffix_dedup),
    "op11_importance": Query(op11_importance, OP11_SQL),
    "op12_exact_dedup": Query(op12_exact_dedup, OP12_SQL),
    "op13_vector_codes": Query(op13_vector_codes, _codes_sql(
        grid_codes.PARTS, grid_codes.ENTRIES, grid_codes.ROUNDS)),
}
