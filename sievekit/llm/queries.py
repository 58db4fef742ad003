"""Registered queries of the training-data operators: name -> (query, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .frames import table

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def tokenizer_path(name: str) -> str:
    """Default place of the public vocabulary files; the operators take any path."""
    import public_tokenizers
    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return add


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i:i+4] END AS s
  FROM words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i)
  WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY 1) USING (doc_id)
"""


@query("op2_ngram_jaccard_join", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .pieces import encode
    docs = table(spark, sf_dir, "documents")
    rows = encode(docs, tokenizer_path("piece_bpe_32k.model"))
    return rows.select("doc_id", "ids", "n_pieces", "decoded", F.length("decoded").cast("long").alias("n_chars"))


OP10_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pats AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, w[i:i+9] AS p
  FROM bw, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) WHERE len(w) > 0),
places AS (
  SELECT doc_id, i, m, w[i:i+m-1] AS p FROM dw, (SELECT DISTINCT len(p) AS m FROM pats) l,
    LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS i)),
occ AS (SELECT doc_id, i, m, item FROM places JOIN pats USING (p)),
hits AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM (SELECT DISTINCT doc_id, i, m FROM occ)) GROUP BY 1),
found AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM occ WHERE item IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op10_decontamination", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op4_html_main_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pages import main_texts
    return main_texts(table(spark, sf_dir, "pages"))


#: the key of the registered queries; a real run takes its own secret
SURROGATE_KEY = "surrogates of the registered queries"


@query("op5_pii_surrogates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .private import with_surrogates
    return with_surrogates(table(spark, sf_dir, "documents"), SURROGATE_KEY)


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify
    return identify(table(spark, sf_dir, "documents"))


@query("op9_secret_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import secret_spans
    return secret_spans(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_of AS (SELECT x, min(y) AS m FROM reach GROUP BY 1),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN degree ON degree.x = vec_id LEFT JOIN least_of ON least_of.x = vec_id
"""


@query("op3_embedding_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP8_SQL = r"""
WITH h AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM h, LATERAL (SELECT unnest(range(0, n - 49)) AS i)),
first_in AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, i + k AS pos FROM win JOIN first_in USING (s), range(50) r(k) WHERE doc_id > d),
spans AS (
  SELECT doc_id, count(*) AS n_removed, count(CASE WHEN before IS NULL OR before < pos - 1 THEN 1 END) AS n_spans
  FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM gone) GROUP BY 1),
kept AS (
  SELECT doc_id, string_agg(b, '' ORDER BY pos) AS k
  FROM (SELECT doc_id, pos, substr(x, 2 * pos + 1, 2) AS b FROM h, LATERAL (SELECT unnest(range(0, n)) AS pos)) a
  ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM h LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op8_suffix_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import without_repeats
    rows = without_repeats(table(spark, sf_dir, "documents"), keep_text=False)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP11_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM t WINDOW g AS (PARTITION BY t)
"""


@query("op11_exact_dedup", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact import exact_duplicates
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, w[i:i+k-1] AS g
  FROM words, (VALUES (1), (2), (3)) ks(k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)),
f AS (SELECT lang, k, g, count(*) AS c FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, g, c AS a FROM f WHERE k > 1 AND c >= 10),
held AS (
  SELECT lang, g[1:2] AS g, a AS b FROM cand WHERE k = 3 UNION ALL
  SELECT lang, g[2:3] AS g, a AS b FROM cand WHERE k = 3),
most AS (SELECT lang, g, max(b) AS b FROM held GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN most m ON c.lang = m.lang AND c.g = m.g WHERE b IS NULL OR 100 * b < 50 * a),
cuts AS (
  SELECT c.lang, c.g, a, j, x.c AS l, y.c AS r,
         (1000000::HUGEINT * a * a) // (x.c::HUGEINT * y.c) AS score
  FROM kept c, (VALUES (1), (2)) js(j), f x, f y
  WHERE j < c.k AND x.lang = c.lang AND x.g = c.g[1:j] AND y.lang = c.lang AND y.g = c.g[j+1:c.k]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
named AS (SELECT *, array_to_string(g, ' ') AS phrase FROM best)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n, score::BIGINT AS score
FROM named JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


@query("op12_phrase_collocations", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import collocations
    return collocations(table(spark, sf_dir, "documents"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .whitening import whitened
    return whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
