"""Queries of this subpackage: one opN_<name> for each operator, over whole tables, and the SQL that states their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, exact_dedup, fill_middle, licenses, line_dedup, mixing, neighbours, packing, pii, quality, similar, toxicity, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.decisions(_table(spark, sf_dir, "documents")).drop("uid")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.linked_components(_table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The vocabulary file that packing is specified on; other callers of pack() give their own."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(_table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(_table(spark, sf_dir, "conversations"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(_table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    every = (
        op1_line_dedup, op2_ngram_jaccard, op3_mix_sources, op4_license_scan, op5_pack,
        op6_pii, op7_chat_format, op8_exact_dedup, op9_nearest, op10_quality,
        op11_fill_middle, op12_toxicity, op13_whiten,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict:
    return {"op2_ngram_jaccard": OP2, "op3_mix_sources": OP3, "op4_license_scan": OP4, "op7_chat_format": OP7, "op8_exact_dedup": OP8, "op11_fill_middle": OP11}


OP3 = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most FROM s),
l AS (SELECT *, row_number() OVER o AS i,
        ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM w WINDOW o AS (ORDER BY most / weight, source ASC NULLS LAST)),
g AS (SELECT arg_min(level, i) AS level FROM l WHERE level * weight <= most),
t AS (SELECT source, source_size, coalesce(least(most, g.level * weight), most) AS target FROM w LEFT JOIN g ON true),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
        CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496 AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
"""

OP8 = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS i, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, i = 1 AS kept, sha256(t) AS text_sha256 FROM k
"""

OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
s AS (SELECT *, CAST(len(l) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM s),
p AS (SELECT *, array_to_string(l[1:i], '') AS prefix, array_to_string(l[i + 1:j], '') AS middle, array_to_string(l[j + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""

OP7 = r"""
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) - 1 AS place FROM conversations),
r AS (SELECT conv_id, place, role, text, string_agg(coalesce('r' || len(role) || ':' || role, 'n') || coalesce('t' || len(text) || ':' || text, 'n'), '') OVER (PARTITION BY conv_id ORDER BY place) AS said,
        count(*) OVER (PARTITION BY conv_id) AS n_turns FROM t),
e AS (SELECT said, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS copies FROM r WHERE place = n_turns - 1 GROUP BY said),
k AS (SELECT * FROM e WHERE said NOT IN (SELECT said FROM r WHERE place < n_turns - 1))
SELECT r.conv_id, CAST(r.place // 512 AS INTEGER) AS part, k.n_turns, k.copies,
  string_agg('<|' || coalesce(role, 'user') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '' ORDER BY r.place) AS text
FROM r JOIN k ON r.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY r.conv_id, part, k.n_turns, k.copies
"""

OP2 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


def _op4() -> str:
    """SQL of the licence scan: key phrases word by word, and the share of IDF mass that a template has in its place."""
    known = licenses.templates()
    vocab = set(licenses.vocabulary())
    text = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    facts = ", ".join(f"({n}, '{label}', {text(key)}, {at}, {str(base).upper()})" for n, label, _, key, at, base in known)
    posts = ", ".join(f"({n}, '{w}', {rel})" for n, _, words, *_ in known for rel, w in enumerate(words) if w in vocab)
    return rf"""
WITH t(n, label, key, off, base) AS (VALUES {facts}), post(n, word, rel) AS (VALUES {posts}),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
df AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(w) AS word FROM w) GROUP BY word),
idf AS (SELECT word, ln((1 + (SELECT count(*) FROM documents)) / (1 + coalesce(df, 0))) + 1 AS idf FROM (SELECT DISTINCT word FROM post) LEFT JOIN df USING (word)),
mass AS (SELECT n, sum(idf) AS mass FROM post JOIN idf USING (word) GROUP BY n),
hit AS (SELECT doc_id, w, t.n, label, base, unnest(list_filter(range(len(w) - len(key) + 1), lambda i: w[i + 1:i + len(key)] = key)) - off AS start FROM w, t WHERE list_has_all(w, key)),
got AS (SELECT h.doc_id, h.n, h.label, h.base, h.start, sum(CASE WHEN h.start + p.rel >= 0 AND h.w[h.start + p.rel + 1] = p.word THEN idf ELSE 0 END) AS got FROM hit h JOIN post p ON p.n = h.n JOIN idf USING (word) GROUP BY 1, 2, 3, 4, 5),
per AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(least(1.0::DOUBLE, round(got / mass, 6))) AS score FROM got JOIN mass USING (n) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score FROM w LEFT JOIN per ON per.doc_id = w.doc_id
"""


OP4 = _op4()
