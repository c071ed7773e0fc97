"""Named queries over whole tables, and their SQL checks where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from . import (
    ann, decontaminate, divergence, jaccard, language, line_dedup, lm, middle, packing, secrets, simhash,
    token_files, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            CHECKS[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the installed package, which every worker has."""
    import public_tokenizers

    return public_tokenizers.path(name)


LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH x AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS number
  FROM documents WHERE text IS NOT NULL),
l AS (
  SELECT doc_id, number,
         list_transform(regexp_extract_all({LOWERED.format("line")}, '[^\x20\x09-\x0D]+'),
                        lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS w
  FROM x),
o AS (SELECT doc_id, number, w, len(w) || ' ' || array_to_string(w[1:3], ' ') AS leaf FROM l WHERE len(w) >= 3),
s AS (SELECT leaf, w, count(DISTINCT doc_id) AS docs FROM o GROUP BY leaf, w),
t AS (SELECT leaf, w, docs, unnest(w) AS token, unnest(range(len(w))) AS place FROM s),
c AS (
  SELECT leaf, place, token FROM t WHERE token <> '<*>'
  GROUP BY leaf, place, token HAVING sum(docs) >= 3),
m AS (
  SELECT t.leaf, t.w, any_value(docs) AS docs, count(c.token) AS fixed,
         list(CASE WHEN c.token IS NULL THEN '<*>' ELSE t.token END ORDER BY t.place) AS template
  FROM t LEFT JOIN c ON t.leaf = c.leaf AND t.place = c.place AND t.token = c.token
  GROUP BY t.leaf, t.w),
r AS (SELECT template FROM m WHERE fixed >= 0.75 * len(w) GROUP BY template HAVING sum(docs) >= 3),
f AS (
  SELECT doc_id, number,
         row_number() OVER (PARTITION BY template ORDER BY doc_id, number) AS nth
  FROM o JOIN m USING (w) JOIN r USING (template) WHERE fixed >= 0.75 * len(w)),
k AS (
  SELECT doc_id, count(*) AS n_lines, count(f.number) AS n_dropped,
         string_agg(line, chr(10) ORDER BY x.number) FILTER (WHERE f.number IS NULL) AS text
  FROM x LEFT JOIN (SELECT * FROM f WHERE nth > 1) f USING (doc_id, number) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN k USING (doc_id)
"""


@query("op1_line_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_recurring(documents, shared_folder(spark, "line-dedup"))


def id_remainder(modulus: int):
    """The remainder of the crc32 of a document's id as text."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


@query("op2_lm_score")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return lm.score(documents, id_remainder(7) == 2, order=3)

OP3_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")},
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")},
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM b WHERE len(w) > 0)),
g AS (
  SELECT doc_id, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
h AS (SELECT doc_id, item_id, g.m, i FROM g JOIN p ON g.g = p.g AND g.m = p.m),
n AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS x FROM h) GROUP BY doc_id),
s AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
"""


@query("op3_decontamination", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10
    )


@query("op4_secrets")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query("op5_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), id_remainder(4) == 2)


@query("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    token_files.write(
        table(spark, sf_dir, "documents"), f"{path}/corpus", f"{path}/work",
        tokenizer_file("word_bpe_49k.json"), vocabulary=49_408, cut="word", end_id=2,
    )
    read = token_files.read(spark, f"{path}/corpus")
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


OP7_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")},
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT r.a AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""


@query("op7_jaccard_join", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(
        table(spark, sf_dir, "documents"), shared_folder(spark, "jaccard"), shingle_words=3, percent=90
    )


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        table(spark, sf_dir, "documents"), shared_folder(spark, "packing"),
        tokenizer_file("byte_bpe_50k.json"), vocabulary=50_257, cut="spaced", end_id=0, length=1024,
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op9_nearest_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, shared_folder(spark, "neighbours"), k=10
    )


OP10_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, min(page_id) AS f FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.h AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> f THEN f END AS refers_to
FROM p LEFT JOIN m USING (h)
"""


@query("op10_warc", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path, warc_date="2024-01-01T00:00:00Z")
    return warc.read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t FROM documents),
u AS (
  SELECT doc_id, text, t, CAST(len(t) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT doc_id, text, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT doc_id, text, n, form, array_to_string(list_slice(t, 1, a), '') AS prefix,
         array_to_string(list_slice(t, a + 1, b), '') AS middle,
         array_to_string(list_slice(t, b + 1, n), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = middle.rearranged(table(spark, sf_dir, "documents"), seed="1", changed_percent=90, spm_percent=20)
    return middle.restored(changed).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("restored_sha256"),
    )


OP12_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
o AS (SELECT i, lang, source, unnest(w) AS t FROM d),
k AS (SELECT lang, t FROM o GROUP BY lang, t HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, t, count(*) AS c FROM o JOIN k USING (lang, t) GROUP BY lang, source, t),
a AS (
  SELECT g.lang, g.source, k.t, coalesce(c.c, 0) AS c,
         sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n,
         sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, k.t) AS lc,
         sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang) AS ln, v.v
  FROM g JOIN k USING (lang) JOIN v USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
p AS (
  SELECT lang, source, t, c,
         CAST(1 + CAST(1000000000 AS HUGEINT) * (c + 5) // (n + 5 * v) AS BIGINT) AS p,
         CAST(1 + CAST(1000000000 AS HUGEINT) * (lc + 5) // (ln + 5 * v) AS BIGINT) AS q FROM a),
s AS (
  SELECT x.lang, x.source, y.source AS item, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.t = y.t AND x.source <> y.source GROUP BY 1, 2, 3),
r AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0) AS value
  FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL
  SELECT lang, source, 'term', t, p - q FROM p WHERE c > 0 AND p > q),
z AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM r)
SELECT * FROM z WHERE part = 'pair' OR rank <= 50
"""


@query("op12_source_divergence", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(
        table(spark, sf_dir, "documents"), shared_folder(spark, "divergence"), min_docs=30, terms=50
    )


@query("op13_simhash")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(
        table(spark, sf_dir, "documents"), shared_folder(spark, "simhash"), shingle_words=4, bits=4
    )
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))
