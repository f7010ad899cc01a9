"""The catalog's queries in plain SQL, for comparison on the same tables.

Written from the definition of each operator and sharing no code with it. The SQL engine's
patterns know ASCII only, so texts are reduced first: a letter outside ASCII becomes ``_`` (a word
character that none of the patterns asks for).
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_PLAIN = r"regexp_replace({0}, '[^\x00-\x7F]', '_', 'g')"
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _plain(c: str) -> str:
    return _PLAIN.format(c)


def _norm(c: str) -> str:
    return f"lower({_STRIP.format(c)})"


NEGATED = """text || CASE lang WHEN 'fr' THEN ' This is not final.'
  WHEN 'de' THEN ' It was Deprecated, it is FALSE and no longer used.'
  WHEN 'es' THEN ' Knot and cannotation are plain words.' ELSE '' END"""
DATED = """text || CASE lang
  WHEN 'en' THEN ' Updated 20' || (15 + doc_id % 10) || '-0' || (1 + doc_id % 9) || '-'
    || (10 + doc_id % 20) || ' and in 2016.'
  WHEN 'fr' THEN ' Seen on March ' || (1 + doc_id % 28) || ', 20' || (18 + doc_id % 6) || '.'
  WHEN 'de' THEN ' From ' || (1 + doc_id % 28) || ' sept 20' || (20 + doc_id % 4) || ', not 2021/02/30.'
  ELSE ' Undated.' END"""

# -- document and table quality --------------------------------------------------------------

ORACLES["doc_length_profile"] = """
SELECT 'document_length_range' AS check_name, too_short + too_long = 0 AS passed,
  (too_short + too_long)::DOUBLE AS metric_value, * FROM (
  SELECT count(*) FILTER (length(text) < 10) AS too_short,
    count(*) FILTER (length(text) > 50000) AS too_long,
    min(length(text)) AS min_length, max(length(text)) AS max_length,
    round(avg(length(text)), 1) AS mean_length, round(median(length(text)), 1) AS median_length
  FROM documents)"""

ORACLES["blank_content"] = """
WITH d AS (SELECT doc_id, CASE WHEN n_chars < 250 THEN '' ELSE text END AS t FROM documents),
b AS (SELECT doc_id FROM d WHERE length(trim(t)) = 0),
f AS (SELECT doc_id FROM b ORDER BY doc_id LIMIT 20)
SELECT 'empty_content' AS check_name, (SELECT count(*) FROM b) = 0 AS passed,
  (SELECT count(*) FROM b)::DOUBLE AS metric_value,
  coalesce(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id), '') AS empty_doc_ids FROM f"""

_COPIES = f"""
WITH d AS (SELECT doc_id, {_norm('text')} AS t FROM documents),
p AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS first_doc_id FROM d),
c AS (SELECT * FROM p WHERE doc_id > first_doc_id)"""

ORACLES["duplicate_content"] = f"""{_COPIES},
f AS (SELECT * FROM c ORDER BY doc_id LIMIT 20)
SELECT 'duplicate_content' AS check_name, (SELECT count(*) FROM c) = 0 AS passed,
  (SELECT count(*) FROM c)::DOUBLE AS metric_value,
  string_agg(doc_id || '=' || first_doc_id, ',' ORDER BY doc_id) AS duplicate_pairs FROM f"""

ORACLES["duplicate_pairs"] = f"""{_COPIES}
SELECT doc_id::VARCHAR AS doc_id, first_doc_id::VARCHAR AS first_doc_id, doc_id AS pos FROM c"""

ORACLES["document_checks"] = f"""{_COPIES},
m AS (
  SELECT 'document_length_range' AS check_name,
    count(*) FILTER (length(text) < 200 OR length(text) > 20000) AS n FROM documents
  UNION ALL SELECT 'empty_content', count(*) FILTER (length(trim(text)) = 0) FROM documents
  UNION ALL SELECT 'duplicate_content', count(*) FROM c)
SELECT check_name, 'documents' AS dataset, n = 0 AS passed, n::DOUBLE AS metric_value FROM m"""

_LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()
ORACLES["table_quality_checks"] = (
    "SELECT check_name, 'lineitem' AS dataset, passed, n::DOUBLE AS metric_value FROM ("
    "SELECT 'row_count' AS check_name, count(*) > 0 AS passed, count(*) AS n FROM lineitem"
    + "".join(
        f" UNION ALL SELECT 'missing_count({c})', count(*) = count({c}), count(*) - count({c}) FROM lineitem"
        for c in _LINEITEM
    )
    + " UNION ALL SELECT 'duplicate_count(l_orderkey)', count(*) = count(DISTINCT l_orderkey),"
    " count(*) - count(DISTINCT l_orderkey) FROM lineitem)"
)

ORACLES["missing_counts"] = """
WITH h AS (
  SELECT count(*) AS n, 0 AS a, count(*) FILTER (l_returnflag = 'R') AS b,
    count(*) FILTER (l_linenumber = 3) AS c, count(*) FILTER (l_discount = 0) AS d,
    count(*) FILTER (l_shipdate >= TIMESTAMP '1995-01-01') AS e FROM lineitem)
SELECT name AS "column", a::BIGINT AS null_count, n AS total_rows
FROM h, unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_quantity', 'l_extendedprice', 'l_tax', 'l_linestatus']) AS u(name)
UNION ALL SELECT 'l_returnflag', b, n FROM h UNION ALL SELECT 'l_linenumber', c, n FROM h
UNION ALL SELECT 'l_discount', d, n FROM h UNION ALL SELECT 'l_shipdate', e, n FROM h"""

ORACLES["duplicate_key_count"] = """
SELECT 'key' AS "column", (count(*) - count(DISTINCT o_custkey % 700))::BIGINT AS duplicates
FROM orders"""

# -- text signals ----------------------------------------------------------------------------

_NEGATIONS = [
    r"\bnot\b", r"\bnever\b", r"\bno longer\b", r"\bdoes(?:n''t| not)\b", r"\bis(?:n''t| not)\b",
    r"\bwas(?:n''t| not)\b", r"\bwere(?:n''t| not)\b", r"\bcan(?:''t|not)\b", r"\bwon''t\b",
    r"\bshouldn''t\b", r"\bfalse\b", r"\bincorrect\b", r"\bdiscontinued\b", r"\bdeprecated\b",
]
_NEGATION_COUNT = " + ".join(f"regexp_matches(t, '(?i){p}')::BIGINT" for p in _NEGATIONS)
_NUMBERS = (
    r"list_sort(list_distinct(list_transform(regexp_extract_all(t, "
    r"'\b(\d+(?:\.\d+)?)\s*(%|percent|million|billion|thousand)?\b', 0), lambda x: trim(x, ' ' || chr(9) || chr(10)))))"
)
_ENTITIES = (
    r"list_sort(list_distinct(list_concat("
    r"regexp_extract_all(t, '\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)\b', 1), "
    r"regexp_extract_all(t, '\b([A-Z]{2,6})\b', 1))))"
)

ORACLES["negation_signals"] = f"""
WITH d AS (SELECT doc_id::VARCHAR AS doc_id, {_plain(NEGATED)} AS t FROM documents),
n AS (SELECT doc_id, {_NEGATION_COUNT} AS negations FROM d)
SELECT doc_id, negations, negations > 0 AS negated FROM n"""

ORACLES["number_mentions"] = f"""
WITH d AS (SELECT doc_id::VARCHAR AS doc_id, {_plain(
    "text || ' About ' || n_chars || '.5 million, or ' || (doc_id % 100) || ' percent.'")} AS t
  FROM documents)
SELECT doc_id, array_to_string({_NUMBERS}, ',') AS numbers FROM d"""

ORACLES["entity_mentions"] = f"""
WITH d AS (SELECT doc_id::VARCHAR AS doc_id, {_plain('text')} AS t FROM documents),
e AS (SELECT doc_id, {_ENTITIES} AS e FROM d)
SELECT doc_id, len(e) AS n, coalesce(array_to_string(e, ','), '') AS entities FROM e"""

_DATES = rf"""
d AS (SELECT doc_id::VARCHAR AS doc_id, {_plain(DATED)} AS t FROM documents),
m AS (
  SELECT doc_id, replace(x, '/', '-') AS s FROM (SELECT doc_id, unnest(regexp_extract_all(t,
    '\b(20\d{{2}})[/-](0[1-9]|1[0-2])[/-](0[1-9]|[12]\d|3[01])\b', 0)) AS x FROM d)
  UNION ALL
  SELECT doc_id, regexp_extract(x, '20\d\d$') || '-' || strftime(strptime(regexp_extract(x, '^\w+'), '%B'), '%m')
    || '-' || lpad(regexp_extract(x, '\s(\d{{1,2}})\D', 1), 2, '0')
  FROM (SELECT doc_id, unnest(regexp_extract_all(t,
    '(?i)\b(January|February|March|April|May|June|July|August|September|October|November|December)\s+(\d{{1,2}}),?\s+(20\d{{2}})\b', 0)) AS x FROM d)
  UNION ALL
  SELECT doc_id, regexp_extract(x, '20\d\d$') || '-' || strftime(strptime(regexp_extract(x, '[A-Za-z]{{3}}'), '%b'), '%m')
    || '-' || lpad(regexp_extract(x, '^\d+'), 2, '0')
  FROM (SELECT doc_id, unnest(regexp_extract_all(t,
    '(?i)\b(\d{{1,2}})\s+(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\w*\s+(20\d{{2}})\b', 0)) AS x FROM d)
  UNION ALL
  SELECT doc_id, y || '-07-01' FROM (SELECT doc_id, unnest(regexp_extract_all(t,
    '(?i)\b(?:in|since|from|as of|until|before|after)\s+(20\d{{2}})\b', 1)) AS y FROM d)),
v AS (SELECT doc_id, try_cast(s AS DATE) AS day FROM m)"""

ORACLES["date_mentions"] = f"""
WITH {_DATES}
SELECT d.doc_id, coalesce(string_agg(strftime(day, '%Y-%m-%d'), ',' ORDER BY day), '') AS dates
FROM d LEFT JOIN v ON v.doc_id = d.doc_id GROUP BY d.doc_id"""

_STALE = f"""
WITH {_DATES},
l AS (SELECT doc_id, max(day) AS latest, date_diff('day', max(day), DATE '2024-06-30') AS age_days
  FROM v GROUP BY doc_id),
s AS (SELECT doc_id, strftime(latest, '%Y-%m-%d') AS latest, age_days,
  CASE WHEN age_days > 1095 THEN 'CRITICAL' WHEN age_days > 730 THEN 'WARNING' ELSE 'INFO' END AS severity,
  round(least(age_days / 1825.0::DOUBLE, 1.0), 3) AS confidence FROM l WHERE age_days > 365)"""

ORACLES["temporal_staleness"] = f"{_STALE} SELECT * FROM s"
ORACLES["temporal_risks"] = f"""{_STALE}
SELECT 'temporal' AS risk_type, severity, 0::BIGINT AS pos, doc_id,
  'Document contains potentially outdated information. Most recent date found: ' || latest || ' ('
  || age_days || ' days old, threshold: 365 days).' AS description, confidence FROM s"""

# -- sources ---------------------------------------------------------------------------------

ORACLES["doc_id_hash"] = """
SELECT doc_id, substr(sha256(source || '::' || doc_id), 1, 16) AS hashed FROM documents"""

ORACLES["paragraph_split"] = f"""
WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
  lambda x: {_STRIP.format('x')}), lambda x: x <> '') AS p FROM documents)
SELECT doc_id::VARCHAR AS doc_id, (generate_subscripts(p, 1) - 1)::BIGINT AS chunk_index,
  len(p) AS total_chunks, md5(unnest(p)) AS content_md5 FROM p"""

ORACLES["json_records"] = """
SELECT doc_id, text AS content, 'body=' || text || ',lang=' || lang || ',long='
  || CASE WHEN n_chars > 1000 THEN 'True' ELSE 'False' END || ',n_chars=' || n_chars AS metadata
FROM documents"""

ORACLES["json_metadata"] = """
SELECT event_id, props AS content, 'k=' || (props ->> '$.k') AS metadata FROM events"""

ORACLES["table_rows_as_documents"] = """
WITH c AS (SELECT c_custkey, coalesce(nullif(c_mktsegment, 'MACHINERY'), '') AS s, c_name FROM customer)
SELECT c_custkey, c_name AS content, c_custkey || ',' || s AS metadata,
  c_custkey || ' | ' || s || ' | ' || c_name AS row_text FROM c"""

# -- vectors ---------------------------------------------------------------------------------

_VECTORS = "v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings)"

ORACLES["vector_arithmetic"] = f"""
WITH {_VECTORS}
SELECT a.vec_id, round(sqrt(list_dot_product(a.e, a.e)), 5) AS length,
  round(list_cosine_similarity(a.e, b.e), 5) AS similarity,
  round(1 - list_cosine_similarity(a.e, b.e), 5) AS distance,
  round(list_distance(a.e, b.e), 5) AS l2,
  round(exp(-0.5 * list_distance(a.e, b.e) * list_distance(a.e, b.e)), 5) AS kernel
FROM v a JOIN v b ON b.vec_id = a.vec_id + 1"""

ORACLES["similarity_pairs"] = f"""
WITH {_VECTORS}, p AS (
  SELECT a.vec_id AS x, b.vec_id AS y, list_cosine_similarity(a.e, b.e) AS s
  FROM v a JOIN v b ON a.vec_id < b.vec_id)
SELECT x::VARCHAR AS id_a, y::VARCHAR AS id_b, round(s, 5) AS similarity FROM p WHERE s >= 0.2"""

_CONTRADICTIONS = f"""
WITH {_VECTORS},
d AS (SELECT doc_id, {_plain(NEGATED)} AS t FROM documents),
s AS (SELECT doc_id, {_NEGATION_COUNT} > 0 AS negated, {_NUMBERS} AS numbers, e
  FROM d JOIN v ON v.vec_id = d.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, list_cosine_similarity(a.e, b.e) AS sim,
    a.negated <> b.negated AS negation_divergence,
    len(a.numbers) > 0 AND len(b.numbers) > 0 AND a.numbers <> b.numbers AS number_conflict,
    a.numbers AS na, b.numbers AS nb
  FROM s a JOIN s b ON a.doc_id < b.doc_id),
g AS (SELECT x::VARCHAR AS doc_a, y::VARCHAR AS doc_b, sim, negation_divergence, number_conflict, na, nb,
    CASE WHEN negation_divergence AND number_conflict THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
    round(CASE WHEN negation_divergence AND number_conflict THEN least(sim * 0.8::DOUBLE + 0.15::DOUBLE, 1.0)
      ELSE sim * 0.8::DOUBLE END, 3) AS confidence
  FROM p WHERE sim >= 0.2 AND (negation_divergence OR number_conflict))"""

ORACLES["contradictions"] = f"""{_CONTRADICTIONS}
SELECT doc_a, doc_b, round(sim, 5) AS similarity, negation_divergence, number_conflict, severity,
  confidence FROM g"""

_SET = "'{{''' || array_to_string({0}, ''', ''') || '''}}'"
ORACLES["contradiction_risks"] = f"""{_CONTRADICTIONS}
SELECT 'contradiction' AS risk_type, severity, unnest([0, 1])::BIGINT AS pos, unnest([doc_a, doc_b]) AS doc_id,
  'Potential contradiction between semantically similar documents (similarity=' || printf('%.3f', sim)
  || '). Signals: ' || concat_ws(', ', CASE WHEN negation_divergence THEN 'negation divergence' END,
    CASE WHEN number_conflict THEN 'conflicting numbers: ' || {_SET.format('na')} || ' vs ' || {_SET.format('nb')} END)
  || '.' AS description, confidence FROM g"""

_SPREAD = f"""
WITH {_VECTORS},
d AS (SELECT doc_id, {_plain('text')} AS t FROM documents),
m AS (SELECT doc_id, unnest({_ENTITIES}) AS entity FROM d),
l AS (SELECT entity, doc_id, e FROM m JOIN v ON v.vec_id = m.doc_id
  QUALIFY count(*) OVER (PARTITION BY entity) >= 3),
x AS (SELECT entity, doc_id, unnest(e) AS x, generate_subscripts(e, 1) AS dim FROM l),
c AS (SELECT entity, dim, avg(x) AS c FROM x GROUP BY ALL),
r AS (SELECT entity, doc_id, sqrt(sum((x - c) * (x - c))) AS r FROM x JOIN c USING (entity, dim) GROUP BY ALL),
s AS (SELECT entity, count(*) AS n_docs, avg(r) AS mean_distance, var_pop(r) AS variance FROM r GROUP BY entity)"""

ORACLES["entity_spread"] = f"""{_SPREAD}
SELECT entity, n_docs, round(mean_distance, 5) AS mean_distance, round(variance, 5) AS variance FROM s"""
ORACLES["ambiguous_entities"] = f"""{_SPREAD}
SELECT CASE WHEN mean_distance > 0.8 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, n_docs AS documents,
  doc_id AS pos, doc_id::VARCHAR AS doc_id,
  'Entity ''' || entity || ''' appears in ' || n_docs || ' documents with high contextual variance (mean_distance='
  || printf('%.3f', mean_distance) || ', variance=' || printf('%.3f', variance)
  || '). May refer to different things.' AS description,
  round(least(mean_distance / 1.5, 1.0), 3) AS confidence FROM s JOIN r USING (entity) WHERE mean_distance > 0.5"""
ORACLES["ambiguity_findings"] = f"""{_SPREAD}
SELECT md5('ambiguity' || chr(31) || entity) AS finding_id, 'ambiguity' AS risk_type,
  CASE WHEN mean_distance > 0.8 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, n_docs AS documents,
  round(least(mean_distance / 1.5, 1.0), 3) AS confidence FROM s WHERE mean_distance > 0.5"""


def _neighbors(radius: float, among: str = "embeddings") -> str:
    return f"""v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM {among}),
q AS (SELECT a.vec_id AS i, 1 - list_cosine_similarity(a.e, b.e) AS dist
  FROM v a JOIN v b ON a.vec_id <> b.vec_id),
n AS (SELECT v.vec_id AS i, count(dist) AS neighbors,
    coalesce(avg(dist) FILTER (dist > 0), {radius}::DOUBLE) AS mean_distance
  FROM v LEFT JOIN (SELECT * FROM q WHERE dist <= {radius}) q ON q.i = v.vec_id GROUP BY v.vec_id)"""


ORACLES["neighbor_counts"] = f"""WITH {_neighbors(0.75)}
SELECT i::VARCHAR AS doc_id, neighbors, round(mean_distance, 5) AS mean_distance FROM n"""

_ALIGNED = "embeddings JOIN documents ON doc_id = vec_id"


def _sparse(radius: float, least: int) -> str:
    """Findings ``f`` of both kinds: one per document, or one for a mostly sparse corpus."""
    return f"""WITH {_neighbors(radius, _ALIGNED)},
s AS (SELECT * FROM n WHERE neighbors < {least}),
c AS (SELECT count(*) AS found, (SELECT count(*) FROM n) AS total FROM s),
f AS (
  SELECT CASE WHEN neighbors = 0 THEN 'CRITICAL' WHEN neighbors < {least // 2} THEN 'WARNING' ELSE 'INFO' END AS severity,
    1::BIGINT AS documents, i,
    'Document is in a sparse region of the knowledge space. Only ' || neighbors
    || ' neighbors within radius {radius} (minimum: {least}). Mean neighbor distance: ' || printf('%.3f', mean_distance)
    || '. LLM may lack sufficient context for accurate responses.' AS description,
    CASE WHEN neighbors = 0 THEN 0.95::DOUBLE WHEN neighbors < {least // 2} THEN 0.7::DOUBLE ELSE 0.5::DOUBLE END AS confidence
  FROM s, c WHERE found <= total // 2
  UNION ALL
  SELECT 'WARNING', found, i, found || '/' || total || ' documents (' || round_even(found * 100 / total, 0)::INT
    || '%) have fewer than {least} neighbors within radius {radius}. The corpus is too small or too topically diverse'
    || ' for reliable RAG coverage. Add more documents to dense topic areas.', 0.8::DOUBLE
  FROM s, c WHERE found > total // 2)"""


ORACLES["sparse_context"] = f"""{_sparse(0.75, 8)}
SELECT 'sparse_context' AS risk_type, severity, i AS pos, i::VARCHAR AS doc_id, description, confidence FROM f"""
ORACLES["sparse_corpus_summary"] = f"""{_sparse(0.4, 2)}
SELECT severity, documents, i::VARCHAR AS doc_id, description, confidence FROM f"""

# -- drift -----------------------------------------------------------------------------------

ORACLES["drift_centroid"] = f"""
WITH {_VECTORS},
x AS (SELECT label < 5 AS b, unnest(e) AS x, generate_subscripts(e, 1) AS dim FROM v),
c AS (SELECT dim, avg(x) FILTER (b) AS b, avg(x) FILTER (NOT b) AS c FROM x GROUP BY dim),
m AS (SELECT sum(b * c) AS d, sqrt(sum(b * b)) AS nb, sqrt(sum(c * c)) AS nc FROM c)
SELECT 'cosine_centroid' AS test_name, round(d / (nb * nc), 6) AS statistic, 0.85::DOUBLE AS threshold,
  d / (nb * nc) < 0.85 AS is_drifted, round(nb, 4) AS baseline_centroid_norm,
  round(nc, 4) AS current_centroid_norm,
  (SELECT count(*) FROM v WHERE label < 5) AS baseline_samples,
  (SELECT count(*) FROM v WHERE label >= 5) AS current_samples FROM m"""


def _ks(shift: float) -> str:
    """D per dimension, and p as the mass of random paths that leave the band |i*n2 - j*n1| < h."""
    return f"""
WITH RECURSIVE v AS (SELECT label < 5 AS b, CASE WHEN label < 5 THEN embedding ELSE
    list_transform(embedding, lambda z: (z + {shift}::DOUBLE)::FLOAT) END AS e FROM embeddings),
t AS (SELECT count(*) FILTER (b) AS n1, count(*) FILTER (NOT b) AS n2 FROM v),
x AS (SELECT b, unnest(e) AS x, generate_subscripts(e, 1) - 1 AS dim FROM v),
g AS (SELECT dim, x, count(*) FILTER (b) AS c1, count(*) FILTER (NOT b) AS c2 FROM x GROUP BY dim, x),
u AS (SELECT dim, sum(c1) OVER w AS u1, sum(c2) OVER w AS u2 FROM g WINDOW w AS (PARTITION BY dim ORDER BY x)),
s AS (SELECT dim, n1, n2, max(abs(u1 / n1::DOUBLE - u2 / n2::DOUBLE)) AS statistic,
  max(abs(u1 * n2 - u2 * n1))::BIGINT AS h FROM u, t GROUP BY dim, n1, n2),
walk(h, n1, n2, i, j, p) AS (
  SELECT DISTINCT h, n1, n2, 0::BIGINT, 0::BIGINT, 1.0::DOUBLE FROM s
  UNION ALL
  SELECT h, n1, n2, i2, j2, sum(q) FROM (
    SELECT h, n1, n2, unnest([i + 1, i]) AS i2, unnest([j, j + 1]) AS j2,
      unnest([p * (n1 - i) / (n1 + n2 - i - j), p * (n2 - j) / (n1 + n2 - i - j)]) AS q
    FROM walk WHERE i + j < n1 + n2)
  WHERE abs(i2 * n2 - j2 * n1) < h AND i2 <= n1 AND j2 <= n2 GROUP BY h, n1, n2, i2, j2),
e AS (SELECT h, p FROM walk WHERE i = n1 AND j = n2),
k AS (SELECT s.dim, s.n1, s.n2, s.statistic, greatest(1 - coalesce(e.p, 0), 0.0) AS p_value
  FROM s LEFT JOIN e ON e.h = s.h)"""


_KS_SUMMARY = """
SELECT 'ks_test' AS test_name,
  round(count(*) FILTER (p_value < 0.05) / count(*)::DOUBLE, 4) AS statistic,
  round(min(p_value), 6) AS p_value, 0.1::DOUBLE AS threshold,
  count(*) FILTER (p_value < 0.05) / count(*)::DOUBLE > 0.1 AS is_drifted,
  count(*) FILTER (p_value < 0.05) AS drifted_dimensions, count(*) AS total_dimensions,
  round(count(*) FILTER (p_value < 0.05) / count(*)::DOUBLE, 4) AS drifted_fraction,
  round(max(statistic), 4) AS max_ks_statistic, 0.05::DOUBLE AS alpha,
  array_to_string(list(dim ORDER BY round(p_value, 4), dim)[1:10], ',') AS top_drifted FROM k"""

ORACLES["drift_ks_by_dim"] = f"""{_ks(0.0)}
SELECT dim::BIGINT AS dim, n1, n2, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value FROM k"""
ORACLES["drift_ks"] = f"{_ks(0.05)} {_KS_SUMMARY}"

_MMD = """
mv AS (SELECT vec_id, label < 5 AS b, embedding::DOUBLE[] AS e FROM embeddings
  QUALIFY row_number() OVER (PARTITION BY label < 5 ORDER BY md5('0' || vec_id), vec_id::VARCHAR) <= 500),
mq AS (SELECT a.b AS ab, c.b AS cb, list_distance(a.e, c.e) AS r FROM mv a, mv c),
mm AS (SELECT median(r) AS md FROM mq WHERE r > 0),
mg AS (SELECT md, 1 / (2 * md * md) AS gamma FROM mm),
mk AS (SELECT gamma, md, greatest(avg(exp(-gamma * r * r)) FILTER (ab AND cb)
    + avg(exp(-gamma * r * r)) FILTER (NOT ab AND NOT cb)
    - 2 * avg(exp(-gamma * r * r)) FILTER (ab AND NOT cb), 0) AS m FROM mq, mg GROUP BY ALL)"""
ORACLES["drift_mmd"] = f"""
WITH {_MMD}
SELECT 'mmd' AS test_name, round(m, 6) AS statistic, 0.1::DOUBLE AS threshold, m > 0.1 AS is_drifted,
  round(gamma, 6) AS gamma, round(md, 4) AS median_distance,
  (SELECT count(*) FROM mv WHERE b) AS baseline_samples,
  (SELECT count(*) FROM mv WHERE NOT b) AS current_samples FROM mk"""

ORACLES["drift_mmd_full"] = f"""
WITH {_MMD},
fv AS (SELECT label < 5 AS b, embedding::DOUBLE[] AS e FROM embeddings),
fd AS (SELECT i, j, md5('0:' || i || ':' || j) AS m
  FROM range(1024) AS a(i), range((SELECT max(len(e)) FROM fv)) AS c(j)),
fw AS (SELECT i, list(sqrt(-2 * ln((('0x' || m[1:8])::BIGINT + 1) / 4294967296::DOUBLE))
    * cos(2 * pi() * ('0x' || m[9:16])::BIGINT / 4294967296::DOUBLE) * sqrt(2 * gamma) ORDER BY j) AS w
  FROM fd, mg GROUP BY i),
fa AS (SELECT b, i, list_dot_product(e, w) AS a FROM fv, fw),
fm AS (SELECT i, avg(cos(a)) FILTER (b) - avg(cos(a)) FILTER (NOT b) AS c,
  avg(sin(a)) FILTER (b) - avg(sin(a)) FILTER (NOT b) AS s FROM fa GROUP BY i),
ft AS (SELECT avg(c * c + s * s) AS m, stddev_samp(c * c + s * s) AS sd, ln(4 / 0.05::DOUBLE) AS l FROM fm)
SELECT 'mmd_full' AS test_name, round(m, 6) AS statistic, 0.1::DOUBLE AS threshold, m > 0.1 AS is_drifted,
  round((SELECT gamma FROM mg), 6) AS gamma, round(sd / sqrt(1024), 6) AS error,
  round(least(4 * sqrt(l / 2048), sd * sqrt(2 * l / 1024) + 28 * l / 3069), 6) AS bound,
  1024::BIGINT AS frequencies, (SELECT count(*) FROM fv WHERE b) AS baseline_samples,
  (SELECT count(*) FROM fv WHERE NOT b) AS current_samples FROM ft"""

# A sketch keeps up to k = 1000 values as they are: then only the grid of 2003 quantiles is left of its error.
ORACLES["drift_ks_sketch"] = f"""{_ks(0.0)}
SELECT dim::BIGINT AS dim, n1, n2, round(1 / 2003::DOUBLE, 6) AS error,
  round(max(abs((u1 * 4006 + n1) // (2 * n1) - (u2 * 4006 + n2) // (2 * n2))) / 2003::DOUBLE, 6) AS statistic
FROM u, t GROUP BY dim, n1, n2"""

ORACLES["drift_guard"] = """
SELECT 'none' AS test_name, 0.0::DOUBLE AS statistic, 0.0::DOUBLE AS p_value, 0.0::DOUBLE AS threshold,
  false AS is_drifted WHERE false"""

ORACLES["drift_all"] = f"""{_ks(0.0)}, {_MMD},
kk AS ({_KS_SUMMARY}),
cx AS (SELECT b, unnest(e)::DOUBLE AS x, generate_subscripts(e, 1) AS dim FROM v),
cc AS (SELECT dim, avg(x) FILTER (b) AS b, avg(x) FILTER (NOT b) AS c FROM cx GROUP BY dim),
cs AS (SELECT sum(b * c) / (sqrt(sum(b * b)) * sqrt(sum(c * c))) AS s FROM cc)
SELECT test_name, statistic, p_value, threshold, is_drifted FROM kk
UNION ALL SELECT 'mmd', round(m, 6), NULL, 0.001::DOUBLE, m > 0.001 FROM mk
UNION ALL SELECT 'cosine_centroid', round(s, 6), NULL, 0.85::DOUBLE, s < 0.85 FROM cs"""

ORACLES["hash_sample"] = """
SELECT vec_id::VARCHAR AS doc_id, label FROM embeddings ORDER BY md5('0' || vec_id), vec_id::VARCHAR LIMIT 100"""

# -- retrieval -------------------------------------------------------------------------------


def _terms(name: str, source: str, key: str) -> str:
    """Dense term vectors of a table's texts, single precision as they are stored."""
    return f"""
{name}_t AS (SELECT {key}::VARCHAR AS id, unnest(regexp_extract_all(lower(text), '\\S+')) AS w FROM {source}),
{name}_c AS (SELECT id, ('0x' || substr(md5(w), 1, 8))::UBIGINT % 64 AS b, count(*)::DOUBLE AS c FROM {name}_t GROUP BY ALL),
{name}_n AS (SELECT id, b, c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS x FROM {name}_c),
{name}_a AS (SELECT k.id, d.b, coalesce(n.x, 0)::FLOAT::DOUBLE AS x
  FROM (SELECT DISTINCT {key}::VARCHAR AS id FROM {source}) k CROSS JOIN range(64) d(b)
  LEFT JOIN {name}_n n ON n.id = k.id AND n.b = d.b),
{name} AS (SELECT id, list(x ORDER BY b) AS e FROM {name}_a GROUP BY id)"""


_HITS = f"""
WITH {_terms('td', 'documents', 'doc_id')}, {_terms('tq', 'benchmark', 'item_id')},
pairs AS (SELECT tq.id AS query_id, td.id AS doc_id,
  round(1 - coalesce(list_cosine_similarity(tq.e, td.e), 0), 9) AS distance FROM tq, td),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM pairs
  QUALIFY rank <= 5)"""

ORACLES["term_vectors"] = f"""WITH {_terms('td', 'documents', 'doc_id')}
SELECT id AS doc_id, b::BIGINT AS dim, round(x, 4) AS weight FROM td_a WHERE x > 0"""

ORACLES["knn_retrieval"] = f"""{_HITS}
SELECT query_id, doc_id, round(distance, 5) AS distance, rank FROM hits"""

ORACLES["candidate_recall"] = f"""
WITH {_VECTORS}
SELECT count(*) AS pairs, 0::BIGINT AS wrong, true AS recall_reached
FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.5"""

ORACLES["knn_by_cells"] = ORACLES["knn_retrieval"]

ORACLES["label_neighbors"] = f"""
WITH {_VECTORS},
x AS (SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS dim FROM v),
c AS (SELECT label, dim, avg(x)::FLOAT::DOUBLE AS c FROM x GROUP BY ALL),
q AS (SELECT label, list(c ORDER BY dim) AS c FROM c GROUP BY label),
p AS (SELECT q.label::VARCHAR AS query_id, vec_id::VARCHAR AS doc_id,
  round(1 - list_cosine_similarity(c, e), 9) AS distance FROM q, v)
SELECT query_id, doc_id, round(distance, 5) AS distance,
  row_number() OVER (PARTITION BY query_id ORDER BY p.distance, doc_id) AS rank FROM p
QUALIFY rank <= 10"""

_RELEVANCE = f"""{_HITS},
rel AS (SELECT query_id, round(avg(1 - distance), 4) AS score, count(*) AS retrieved_count,
  round(avg(1 - distance), 4) AS mean_similarity, count(*) FILTER (1 - distance >= 0.5) AS above_threshold,
  0.5::DOUBLE AS threshold, string_agg(doc_id, ',' ORDER BY rank) AS per_document FROM hits GROUP BY query_id)"""
ORACLES["retrieval_relevance"] = f"{_RELEVANCE} SELECT * FROM rel"
ORACLES["retrieval_summary"] = f"""{_RELEVANCE}
SELECT count(*) AS total_queries, round(avg(score), 4) AS score, round(avg(score), 4) AS mean_score,
  round(min(score), 4) AS min_score, round(max(score), 4) AS max_score,
  count(*) FILTER (score < 0.5) AS below_threshold FROM rel"""

ORACLES["context_coverage"] = f"""{_HITS}
SELECT query_id, round(0.7::DOUBLE * max(1 - distance) + 0.3::DOUBLE * avg(1 - distance), 4) AS score,
  round(max(1 - distance), 4) AS best_similarity, round(avg(1 - distance), 4) AS mean_similarity,
  round(min(1 - distance), 4) AS min_similarity, count(*) AS retrieved_count,
  count(*) FILTER (1 - distance >= 0.6) AS above_threshold FROM hits GROUP BY query_id"""

ORACLES["context_redundancy"] = f"""{_HITS},
l AS (SELECT query_id, rank, e FROM hits JOIN td ON td.id = hits.doc_id),
s AS (SELECT a.query_id, list_cosine_similarity(a.e, b.e) AS s
  FROM l a JOIN l b ON a.query_id = b.query_id AND a.rank < b.rank)
SELECT query_id, round(1 - avg(s), 4) AS score, round(avg(s), 4) AS mean_similarity,
  round(max(s), 4) AS max_similarity, count(*) FILTER (s > 0.9) AS redundant_pairs, count(*) AS total_pairs
FROM s GROUP BY query_id"""

ORACLES["chunk_size_quality"] = r"""
WITH w AS (SELECT len(regexp_extract_all(text, '\S+')) / 0.75::DOUBLE AS t FROM documents)
SELECT count(*) AS total_chunks, round(greatest(0, 1 - avg(abs(t - 512) / 512)), 4) AS score,
  round(avg(t), 1) AS mean_tokens, round(median(t), 1) AS median_tokens, round(min(t), 1) AS min_tokens,
  round(max(t), 1) AS max_tokens, 512::BIGINT AS target_tokens, count(*) FILTER (t < 128) AS too_small,
  count(*) FILTER (t > 1024) AS too_large FROM w"""

ORACLES["chunk_coherence"] = r"""
WITH c AS (SELECT list_transform(embedding, lambda x: (x * (0.55::DOUBLE + label * 0.25::DOUBLE))::FLOAT)::DOUBLE[] AS e
  FROM documents JOIN embeddings ON vec_id = doc_id WHERE len(regexp_extract_all(text, '\S+')) >= 4),
s AS (SELECT least(round(sqrt(list_dot_product(e, e)), 6) / 2, 1.0) AS s FROM c)
SELECT count(*) AS chunks_analyzed, round(avg(s), 4) AS score, round(avg(s), 4) AS mean_coherence,
  round(min(s), 4) AS min_coherence, count(*) FILTER (s < 0.5) AS low_coherence_count FROM s"""

# -- embedding tables ------------------------------------------------------------------------

ORACLES["incremental_embed"] = f"""
WITH {_terms('td', 'documents', 'doc_id')},
k AS (SELECT DISTINCT doc_id::VARCHAR AS id FROM labels WHERE doc_id % 7 <> 0
  OR doc_id IN (SELECT doc_id FROM documents WHERE text = 'old text'))
SELECT td.id AS doc_id, k.id IS NOT NULL AS from_cache, len(list_filter(e, lambda x: x > 0)) AS entries,
  round(list_max(e), 4) AS largest FROM td LEFT JOIN k ON k.id = td.id"""

ORACLES["embedding_upsert"] = f"""
WITH {_terms('td', 'documents', 'doc_id')},
m AS (SELECT id, e FROM td UNION ALL
  SELECT vec_id::VARCHAR, embedding::DOUBLE[] FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents))
SELECT id AS doc_id, round(list_max(e), 4) AS largest, round(list_min(e), 4) AS smallest FROM m"""

ORACLES["vector_table_upsert"] = ORACLES["embedding_upsert"]

_DATED = """d AS (SELECT vec_id::VARCHAR AS doc_id, label, embedding,
  TIMESTAMP '2024-01-01' + to_hours((vec_id % 240)::INT) AS ts FROM embeddings)"""

ORACLES["vector_table_remove"] = f"""
WITH {_DATED}
SELECT doc_id, label, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ingested_at FROM d WHERE label NOT IN (3, 7)"""

ORACLES["vector_table_clear"] = """
SELECT vec_id::VARCHAR AS doc_id, label FROM embeddings WHERE label < 4"""

ORACLES["vector_table_window"] = f"""
WITH {_DATED}, w AS (SELECT doc_id, label, ts + CASE WHEN label % 2 = 1 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS ts FROM d)
SELECT doc_id, label, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ingested_at FROM w
WHERE ts BETWEEN TIMESTAMP '2024-01-02 06:00:00' AND TIMESTAMP '2024-01-05'"""

ORACLES["drift_windows"] = f"""
WITH {_DATED},
x AS (SELECT ts < TIMESTAMP '2024-01-06' AS b, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM d),
c AS (SELECT dim, avg(x) FILTER (b) AS b, avg(x) FILTER (NOT b) AS c FROM x GROUP BY dim),
m AS (SELECT sum(b * c) / (sqrt(sum(b * b)) * sqrt(sum(c * c))) AS s FROM c)
SELECT 'cosine_centroid' AS test_name, round(s, 6) AS statistic, 0.85::DOUBLE AS threshold, s < 0.85 AS is_drifted FROM m"""

ORACLES["retrieved_documents"] = f"""{_HITS}
SELECT query_id, rank, h.doc_id, md5(text) AS content_md5, source AS source_path, lang, 1::BIGINT AS entries
FROM hits h JOIN documents d ON h.doc_id = d.doc_id::VARCHAR"""

ORACLES["embedding_window_scan"] = """
SELECT vec_id::VARCHAR AS doc_id, label, strftime(t, '%Y-%m-%d %H:%M:%S') AS ingested_at
FROM (SELECT *, TIMESTAMP '2024-01-01' + to_hours(vec_id % 240) AS t FROM embeddings)
WHERE t BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-06'"""

ORACLES["embedding_count"] = "SELECT count(*) AS vectors FROM embeddings"

# -- history, alerts, reports ----------------------------------------------------------------

_RUN = "strftime(ts, '%Y-%m-%d')"
_AT = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
_TEST = "CASE user_id % 3 WHEN 0 THEN 'ks_test' WHEN 1 THEN 'mmd' ELSE 'cosine_centroid' END"
_RISK = (
    "CASE user_id % 4 WHEN 0 THEN 'contradiction' WHEN 1 THEN 'ambiguity' "
    "WHEN 2 THEN 'temporal' ELSE 'sparse_context' END"
)
_SEVERITY = (
    "CASE WHEN value > 60 THEN 'CRITICAL' WHEN value > 20 THEN 'WARNING' "
    "WHEN value > 5 THEN 'INFO' ELSE 'DEBUG' END"
)
_CHECK = "CASE user_id % 2 WHEN 0 THEN 'row_count' ELSE 'empty_content' END"
_METRIC = "CASE user_id % 2 WHEN 0 THEN 'chunk_coherence' ELSE 'retrieval_relevance' END"
_END = "TIMESTAMP '2024-01-31'"

ORACLES["drift_history"] = f"""
SELECT event_id, {_RUN} AS run_id, value AS statistic, {_AT} AS measured_at FROM events
WHERE event_type = 'view' AND user_id % 3 = 0 AND ts >= {_END} - INTERVAL 10 DAY"""
ORACLES["risk_history"] = f"""
SELECT event_id, {_RISK} AS risk_type, {_SEVERITY} AS severity, round(least(value / 100, 1.0), 4) AS confidence
FROM events WHERE event_type = 'error' AND ts >= {_END} - INTERVAL 7 DAY"""
ORACLES["check_history"] = f"""
SELECT event_id, {_CHECK} AS check_name, value < 40 AS passed, value AS metric_value
FROM events WHERE event_type = 'click' AND ts >= {_END} - INTERVAL 14 DAY"""
ORACLES["rag_history"] = f"""
SELECT event_id, {_METRIC} AS metric_name, round(value / 100, 4) AS score
FROM events WHERE event_type = 'purchase' AND ts >= {_END} - INTERVAL 14 DAY"""
ORACLES["alert_history"] = f"""
SELECT event_id, 'user ' || user_id AS title, 'value ' || value AS message, {_AT} AS created_at
FROM events WHERE event_type = 'signup' AND value > 60 AND ts >= {_END} - INTERVAL 7 DAY"""
ORACLES["alerts_by_threshold"] = f"""
SELECT event_id, {_SEVERITY} AS severity, CASE WHEN value > 60 THEN 3 ELSE 2 END::BIGINT AS severity_rank
FROM events WHERE event_type = 'signup' AND value > 20"""
ORACLES["alert_payloads"] = f"""
SELECT event_id, {_SEVERITY} AS severity, 'quality' AS source, 'user ' || user_id AS title,
  'value ' || value AS message, props ->> '$.k' AS k, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at
FROM events WHERE event_type = 'signup'"""
ORACLES["delivered_alerts"] = ORACLES["alert_payloads"].replace("SELECT event_id, ", "SELECT ", 1)
ORACLES["alerts_derived"] = f"""
SELECT 'WARNING' AS severity, 'drift' AS source_module, 'Drift detected: ' || {_TEST} AS title,
  {_TEST} || ' detected distribution shift (statistic=' || value || ', threshold=30.0)' AS message,
  {_AT} AS created_at FROM events WHERE event_type = 'view' AND value > 30
UNION ALL SELECT {_SEVERITY}, 'hallucination', 'Hallucination risk: ' || {_RISK}, 'user ' || user_id, {_AT}
FROM events WHERE event_type = 'error' AND value > 20
UNION ALL SELECT 'WARNING', 'quality', 'Quality check failed: ' || {_CHECK},
  'Check ''' || {_CHECK} || ''' on dataset ''documents'' failed (value=' || value || ')', {_AT}
FROM events WHERE event_type = 'click' AND NOT value < 40"""

_RUNS = f"""
runs AS (SELECT {_RUN} AS run_id, min(ts) AS started_at, max(ts) AS completed_at,
  count(*) AS documents_processed FROM events GROUP BY 1)"""
ORACLES["latest_run"] = f"""WITH {_RUNS}
SELECT {_RUN} AS run_id, event_id, {_TEST} AS test_name, value AS statistic, value > 30 AS is_drifted
FROM events WHERE event_type = 'view' AND {_RUN} = (SELECT run_id FROM runs ORDER BY started_at DESC LIMIT 1)"""
ORACLES["latest_metrics"] = f"""
SELECT {_RUN} AS run_id, event_id, {_METRIC} AS metric_name, round(value / 100, 4) AS score
FROM events WHERE event_type = 'purchase'
AND {_RUN} = (SELECT {_RUN} FROM events WHERE event_type = 'purchase' ORDER BY ts DESC LIMIT 1)"""
_SUMMARY = f"""
WITH {_RUNS},
s AS (SELECT {_RUN} AS run_id,
  count(*) FILTER (event_type = 'view') AS drift_tests,
  count(*) FILTER (event_type = 'view' AND value > 30) AS drift_detected,
  count(*) FILTER (event_type = 'error') AS risks,
  count(*) FILTER (event_type = 'error' AND value > 20) AS serious_risks,
  count(*) FILTER (event_type = 'click') AS quality_checks,
  count(*) FILTER (event_type = 'click' AND NOT value < 40) AS quality_failures,
  count(*) FILTER (event_type = 'purchase') AS rag_metrics,
  count(*) FILTER (event_type = 'signup') AS alerts FROM events GROUP BY 1)"""
ORACLES["run_summary"] = f"""{_SUMMARY}
SELECT s.*, documents_processed,
  round(epoch_us(completed_at) / 1e6::DOUBLE - epoch_us(started_at) / 1e6::DOUBLE, 1) AS duration_seconds
FROM s JOIN runs USING (run_id)"""
ORACLES["health_score"] = f"""{_SUMMARY},
f AS (SELECT run_id, greatest(drift_tests + quality_checks + risks, 1) AS findings,
  drift_detected + quality_failures + serious_risks AS issues FROM s)
SELECT run_id, findings, issues, greatest(0, 100 - floor(issues / findings::DOUBLE * 100))::BIGINT AS health FROM f"""
ORACLES["risk_breakdown"] = f"""
SELECT 'risk_type' AS dimension, {_RISK} AS value, count(*) AS risks FROM events e
WHERE event_type = 'error' GROUP BY 2
UNION ALL SELECT 'severity', {_SEVERITY}, count(*) FROM events e WHERE event_type = 'error' GROUP BY 2"""
ORACLES["pass_rate_trend"] = f"""
SELECT {_RUN} AS day, count(*) AS total, count(*) FILTER (value < 40) AS passed,
  round(count(*) FILTER (value < 40) / count(*)::DOUBLE * 100, 4) AS pass_rate
FROM events WHERE event_type = 'click' GROUP BY 1"""
ORACLES["latest_pass_counts"] = f"""
SELECT count(*) FILTER (value < 40) AS passed, count(*) FILTER (NOT value < 40) AS failed FROM events
WHERE event_type = 'click' AND {_RUN} = (SELECT max({_RUN}) FROM events)"""
ORACLES["metric_series"] = f"""
WITH d AS (SELECT {_RUN} AS run_id, {_METRIC} AS series, avg(value / 100) AS value, max(ts) AS t
  FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT series, CASE series WHEN 'chunk_coherence' THEN 'Chunk Coherence' ELSE 'Retrieval Relevance' END AS label,
  run_id, round(value, 9) AS value,
  round(value - lag(value) OVER (PARTITION BY series ORDER BY t, run_id), 9) AS change FROM d"""
