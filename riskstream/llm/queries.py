"""The registered queries of this subpackage, and the same as SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskstream.llm import ann, bytespans, collocations, exact, jaccard, licenses, merkle, mixing, packing, quality, secrets, simhash, substring


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_digest(substring.remove_repeats(_documents(spark, sf_dir)))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return quality.score(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.text_classes(_documents(spark, sf_dir))


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.secret_scan(_documents(spark, sf_dir)))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(_documents(spark, sf_dir)).drop("copies")


def license_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_documents(spark, sf_dir))


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(packing.pack(_documents(spark, sf_dir)))


def byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytespans.bytespan_digest(bytespans.remove_repeats(_documents(spark, sf_dir)))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(_documents(spark, sf_dir))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_digest(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substring_dedup,
    "op2_nearest_neighbours": nearest_neighbours,
    "op3_quality": quality_scores,
    "op4_near_dedup": near_dedup,
    "op5_exact_dedup": exact_dedup,
    "op6_secrets": secret_spans,
    "op7_mixing": source_mix,
    "op8_licenses": license_labels,
    "op9_packing": packed_sequences,
    "op10_byte_dedup": byte_dedup,
    "op11_jaccard_join": jaccard_join,
    "op12_collocations": phrase_collocations,
    "op13_merkle_manifest": merkle_manifest,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_SUBSTRING = f"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT doc_id, len(w) AS n, w, unnest(range(0, greatest(len(w) - {substring.WINDOW - 1}, 0))) AS pos FROM words),
windows AS (SELECT doc_id, pos, md5(list_aggregate(w[pos + 1 : pos + {substring.WINDOW}], 'string_agg', ' ')) AS h FROM places),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
hits AS (SELECT doc_id, list(pos) AS starts FROM windows WHERE h IN (SELECT h FROM twice) GROUP BY doc_id),
gone AS (SELECT doc_id, list_distinct(flatten(list_transform(starts, lambda s: range(s, s + {substring.WINDOW})))) AS places FROM hits),
kept AS (
  SELECT words.doc_id, w, coalesce(len(places), 0) AS n_removed,
    CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i - 1)) END AS k
  FROM words LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(w) AS n_words, n_removed, sha256(coalesce(list_aggregate(k, 'string_agg', ' '), '')) AS kept_sha256 FROM kept
"""

_NEAREST = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS own, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, q.own, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.own <> c.own WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id))::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_EXACT = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), {_UPPER}) AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
"""

_MIXING = f"""
WITH d AS (SELECT doc_id, text, source, len({_WORDS}) AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM totals),
shares AS (
  SELECT *, sum(source_size) OVER () AS everything,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM weighed),
full_ones AS (SELECT *, cap < (everything - held)::DOUBLE * weight / open::DOUBLE AS is_full FROM shares),
level AS (
  SELECT (any_value(everything) - coalesce(sum(cap) FILTER (is_full), 0))::DOUBLE AS rest, sum(weight) FILTER (NOT is_full)::DOUBLE AS open
  FROM full_ones),
targets AS (SELECT source, source_size, least(cap::DOUBLE, rest * weight / level.open) AS target FROM weighed, level),
rates AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:0:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS number
  FROM d JOIN targets ON d.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, size * (floor(rate) + CASE WHEN number < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM rates
"""


def _license_sql() -> str:
    """Plain SQL over all lines and templates, without the filters of the join."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), " + _UPPER + r"), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    line_words = r"regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    phrases = ", ".join(f"({p.split()!r}, {label!r})" for p, label in licenses.PHRASES.items())
    templates = ", ".join(f"({i}, {label!r}, {sorted(set(t.split()))!r})" for i, (label, t) in enumerate(licenses.TEMPLATES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, {words} AS w FROM documents),
phrases(p, label) AS (VALUES {phrases}),
templates(t, label, s) AS (VALUES {templates}),
hits AS (
  SELECT r, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1 : i + len(p)] = p)) AS pos FROM d, phrases),
base AS (
  SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_distinct(list(label)) AS labels FROM hits GROUP BY r),
lines AS (SELECT r, unnest(string_split_regex(translate(coalesce(text, ''), {_UPPER}), '[\\n\\r]+')) AS line FROM d),
sets AS (SELECT r, list_distinct({line_words}) AS s FROM lines),
shares AS (
  SELECT r, label, len(list_intersect(sets.s, templates.s)) AS common, len(templates.s) AS n FROM sets, templates),
found AS (
  SELECT r, list_distinct(list(label)) AS labels, max(common / n) AS share FROM shares
  WHERE common >= ceil({licenses.CONTAINMENT} * n - 1e-9) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""


_JACCARD = f"""
WITH RECURSIVE
words AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - {jaccard.SHINGLE - 2}, 2)),
    lambda i: array_to_string(w[i : i + {jaccard.SHINGLE - 1}], ' '))) END AS s
  FROM words),
items AS (SELECT r, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (SELECT a.r, b.r AS other FROM items a JOIN items b USING (x) WHERE a.r <> b.r GROUP BY a.r, b.r, a.n, b.n
  HAVING 100 * count(*) >= {jaccard.SIMILARITY} * (a.n + b.n - count(*))),
reach(r, other) AS (SELECT r, r FROM sets UNION SELECT reach.r, pairs.other FROM reach JOIN pairs ON reach.other = pairs.r)
SELECT any_value(a.doc_id) AS doc_id, any_value(len(a.s)) AS n_shingles, min(b.doc_id) AS component_id
FROM reach JOIN sets a ON a.r = reach.r JOIN sets b ON b.r = reach.other GROUP BY reach.r
"""

_COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{collocations.NO_LANG}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), {_UPPER}), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM worded, range(1, {collocations.LONGEST + 1}) t(k)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= {collocations.THRESHOLD}),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r, ({collocations.SCALE}::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1 : ], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
spans AS (SELECT lang, a, k, w, unnest(range(2, k)) AS size FROM candidates),
inner_phrases AS (
  SELECT lang, a, unnest(list_transform(range(1, k - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase FROM spans),
longer AS (SELECT lang, phrase, max(a) AS f FROM inner_phrases GROUP BY lang, phrase),
free AS (
  SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE NOT coalesce(100::HUGEINT * f >= {collocations.ABSORBED}::HUGEINT * a, false))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM free JOIN totals USING (lang) QUALIFY rank <= {collocations.TOP}
"""


def _merkle_sql() -> str:
    """Both kinds of trees level by level, and every leaf folded a level a step."""
    fan = merkle.FANOUT
    crc_step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    encoded = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
    leaf = " || ".join(encoded.format(name) for name in merkle.FIELDS[:-1])

    def tree(name: str, leaves: str) -> str:
        return f"""
{name}(tree, lvl, pos, n, digest) AS (
  SELECT tree, 0, pos, n, digest FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, pos // {fan}, (n + {fan - 1}) // {fan}, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // {fan}, n),
{name}_sides AS (
  SELECT tree, lvl, pos,
    coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY tree, lvl, pos // {fan} ORDER BY pos))"""

    def fold(name: str, starts: str, nodes: str) -> str:
        return f"""
{name}(id, tree, lvl, pos, path, node) AS (
  SELECT id, tree, 0, pos, path, node FROM {starts}
  UNION ALL
  SELECT id, f.tree, f.lvl + 1, f.pos // {fan}, path || l || r, sha256(l || node || r)
  FROM {name} f JOIN {nodes}_sides s ON f.tree = s.tree AND f.lvl = s.lvl AND f.pos = s.pos),
{name}_ends AS (SELECT id, any_value(tree) AS tree, max_by(path, lvl) AS path, max_by(node, lvl) AS node FROM {name} GROUP BY id)"""

    return f"""
WITH RECURSIVE
bytes AS (SELECT list_transform(range(0, 256), lambda b: list_reduce(list_prepend(b, range(0, 8)), lambda c, i: {crc_step})) AS t),
d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('s' || source, '-') AS tree, {leaf} AS head, text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc
  FROM documents, bytes),
rows AS (
  SELECT id, doc_id, tree, sha256(head || {encoded.format("text")}) AS digest,
    sha256(head || CASE WHEN crc % 2 = 0 THEN {encoded.format("replace(text, chr(10), '')")} ELSE {encoded.format("text")} END) AS other
  FROM d),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM rows),
{tree("nodes", "leaves")},
subroots AS (
  SELECT tree AS source, '' AS tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
{tree("tops", "subroots")},
starts AS (SELECT id, tree, pos, '' AS path, other AS node FROM leaves),
{fold("steps", "starts", "nodes")},
top_starts AS (SELECT id, '' AS tree, pos, path, node FROM steps_ends JOIN subroots ON steps_ends.tree = subroots.source),
{fold("top_steps", "top_starts", "tops")}
SELECT doc_id, leaves.digest AS leaf, subroots.digest AS subroot, tops.digest AS root, sha256(e.path) AS proof_sha256,
  e.node AS folded_root, e.node = tops.digest AS verified
FROM leaves JOIN subroots ON leaves.tree = subroots.source JOIN tops ON tops.n = 1 JOIN top_steps_ends e ON e.id = leaves.id
"""


ORACLE: dict[str, str] = {
    "op1_substring_dedup": _SUBSTRING,
    "op2_nearest_neighbours": _NEAREST,
    "op5_exact_dedup": _EXACT,
    "op7_mixing": _MIXING,
    "op8_licenses": _license_sql(),
    "op11_jaccard_join": _JACCARD,
    "op12_collocations": _COLLOCATIONS,
    "op13_merkle_manifest": _merkle_sql(),
}
