"""One query for each operator, applied to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jurispark.llm.centroids import cluster_vectors
from jurispark.llm.common import cut, delete, table
from jurispark.llm.decontamination import find_contamination, summarise
from jurispark.llm.fingerprints import edited_fingerprints
from jurispark.llm.licenses import PHRASES, TEMPLATES, TEXTS, scan_licenses
from jurispark.llm.line_dedup import dedup_lines
from jurispark.llm.middle import fill_in_middle
from jurispark.llm.mixing import MIX_SQL, mix
from jurispark.llm.ngram_join import near_groups
from jurispark.llm.secrets import digest, find_secrets
from jurispark.llm.substrings import dedup_substrings
from jurispark.llm.tokens import count_tokens
from jurispark.llm.toxicity import held_out, score_toxicity
from jurispark.llm.warc import WARC_SQL, archive_path, page_records, read_warc, write_warc

#: Words of texts, A-Z lower-cased: alphanumeric ones, and runs without white space.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = "regexp_extract_all(coalesce(" + _LOWER.format("text") + ", ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_RUNS = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"
#: Every window of 50 words with the smallest document that it starts in; words of windows that start earlier go.
SUBSTRING_SQL = f"""
WITH d AS (SELECT doc_id, {_RUNS.format("text")} AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p+49], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)),
gone AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY t) AS first FROM win) WHERE first < doc_id),
edges AS (SELECT doc_id, spot, sum(step) AS step FROM (SELECT doc_id, p AS spot, 1 AS step FROM gone UNION ALL SELECT doc_id, p + 50, -1 FROM gone) GROUP BY ALL),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
covered AS (SELECT w.doc_id, w.p, w.word, sum(coalesce(e.step, 0)) OVER (PARTITION BY w.doc_id ORDER BY w.p) > 0 AS hit FROM words w LEFT JOIN edges e ON e.doc_id = w.doc_id AND e.spot = w.p)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, CAST(count(*) FILTER (hit) AS BIGINT) AS n, string_agg(word, ' ' ORDER BY p) FILTER (NOT hit) AS kept FROM covered GROUP BY doc_id) USING (doc_id)
"""
#: All pairs of texts with a common shingle, those of 0.75 and more as links, and the least document that links lead to.
NEAR_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_RUNS.format(_LOWER.format("text"))} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM d),
texts AS (SELECT min(doc_id) AS doc, s FROM (SELECT doc_id, list_sort(s) AS s FROM s) WHERE len(s) > 0 GROUP BY s),
token AS (SELECT doc, len(s) AS n, unnest(s) AS t FROM texts),
link AS (SELECT a.doc AS x, b.doc AS y FROM token a JOIN token b ON a.t = b.t AND a.doc < b.doc AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n GROUP BY a.doc, b.doc, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc, doc AS root FROM texts UNION SELECT ways.y, reach.root FROM reach JOIN ways ON ways.x = reach.doc AND reach.root < ways.y),
least AS (SELECT doc, min(root) AS root FROM reach GROUP BY doc)
SELECT doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN doc_id ELSE root END AS component_id
FROM s LEFT JOIN texts ON texts.s = list_sort(s.s) LEFT JOIN least USING (doc)
"""
#: Windows of items joined with runs of as many words of documents.
LEAK_SQL = f"""
WITH i AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_ALNUM} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p+n-1], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
run AS (SELECT doc_id, n, p, array_to_string(w[p:p+n-1], ' ') AS t FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win))),
found AS (SELECT doc_id, item_id, p, run.n FROM run JOIN win ON run.n = win.n AND run.t = win.t),
hits AS (SELECT doc_id, CAST(count(DISTINCT q) AS BIGINT) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
_quoted = lambda t: "'" + " ".join(t.split()).replace("'", "''") + "'"
#: Phrases at each word, and the most of a template's words in any run of twice as many.
LICENSE_SQL = f"""
WITH phrase AS (SELECT * FROM (VALUES {", ".join(f"({_quoted(t)}, {len(t.split())}, '{k}')" for t, k in PHRASES.items())}) AS t(phrase, n, label)),
template AS (SELECT id, label, len(w) AS n, len(list_distinct(w)) AS size, list_distinct(w) AS tokens FROM (SELECT id, label, {_ALNUM} AS w FROM (VALUES {", ".join(f"({i}, {_quoted(t)}, '{k}')" for i, (t, k) in enumerate([*TEMPLATES, *TEXTS]))}) AS t(id, text, label))),
token AS (SELECT id, label, n, size, unnest(tokens) AS token FROM template),
d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
base AS (SELECT doc_id, p - 1 AS start, label FROM pos JOIN phrase ON array_to_string(w[p:p+n-1], ' ') = phrase),
bases AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_base, min(start) AS first_word, max(start) AS last_word FROM base GROUP BY doc_id),
occ AS (SELECT doc_id, id, label, n, size, p, token FROM pos JOIN token ON w[p] = token),
cand AS (SELECT doc_id, id FROM occ GROUP BY doc_id, id, size HAVING 4 * count(DISTINCT token) >= 3 * size),
run AS (SELECT doc_id, label, size, count(DISTINCT token) OVER (PARTITION BY doc_id, id ORDER BY p RANGE BETWEEN 2 * n - 1 PRECEDING AND CURRENT ROW) AS c FROM occ JOIN cand USING (doc_id, id)),
met AS (SELECT doc_id, label, c / CAST(size AS DOUBLE) AS share FROM run WHERE 4 * c >= 3 * size),
said AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label, bool_or(base) AS base FROM (SELECT DISTINCT doc_id, label, true AS base FROM base UNION ALL SELECT DISTINCT doc_id, label, false FROM met) GROUP BY ALL) GROUP BY doc_id),
best AS (SELECT doc_id, max(share) AS share FROM met GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN bases USING (doc_id) LEFT JOIN said USING (doc_id) LEFT JOIN best USING (doc_id)
"""
#: Two cuts and an order from the hash of an id.
MIDDLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS h1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS h2, CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4 FROM d),
c AS (SELECT *, least(h1, h2) AS a, greatest(h1, h2) AS b, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM s),
p AS (SELECT *, substring(text, 1, a) AS pre, substring(text, a + 1, b - a) AS mid, substring(text, b + 1, n) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
#: Lines with their keys, keys that five documents hold, and lines that stay.
LINES_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS p FROM d),
k AS (SELECT *, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
common AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (doc_id < holder) AS BIGINT) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (holder IS NULL OR doc_id = holder), '')) AS kept_sha256
FROM k LEFT JOIN common USING (key) GROUP BY doc_id
"""


def _clusters_sql(k: int = 8, rounds: int = 10) -> str:
    """Rounds one after another: distances to all centroids, the least of them, floored means."""
    steps = [
        "v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, e FROM (SELECT e, sha256('3:' || vec_id) AS h FROM v ORDER BY h LIMIT {k}))",
    ]
    for r in range(rounds + 1):
        away = "list_sum(list_transform(list_zip(v.e, m.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, e, c, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS place FROM (SELECT vec_id, v.e, m.c, CAST({away} AS BIGINT) AS d FROM v, c{r} AS m)) WHERE place = 1)")
        if r < rounds:
            mean = f"SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM (SELECT c, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (SELECT c, unnest(e) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY c, i) GROUP BY c"
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(f.e, o.e) AS e FROM c{r} AS o LEFT JOIN ({mean}) AS f ON f.c = o.c)")
    sums = "CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia"
    return f"WITH {', '.join(steps)} SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, {sums}, sha256(array_to_string(m.e, ',')) AS centroid_sha256 FROM a{rounds} AS a JOIN c{rounds} AS m ON m.c = a.c"


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


@query("op1_mix", MIX_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query("op7_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", *digest(found))


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op2_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op9_decontamination", LEAK_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(find_contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))).drop("longest")


@query("op3_licenses", LICENSE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text")


@query("op6_warc", WARC_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = archive_path(spark)
    write_warc(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    found = page_records(read_warc(spark, path, payloads=False))
    delete(spark, path)  # the reader has kept what it read
    return found.select(F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op5_ngram_join", NEAR_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op4_substring_dedup", SUBSTRING_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op11_fill_in_middle", MIDDLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select("doc_id", *[f"fim.{c}" for c in ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")])


@query("op12_line_dedup", LINES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op13_centroid_clusters", _clusters_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding")).drop("centroid")
