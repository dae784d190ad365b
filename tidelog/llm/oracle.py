"""DuckDB SQL for the registered queries of this subpackage, as far as SQL can express them on whole tables."""

from __future__ import annotations

#: Query parameters that name a visit.
_VISIT = "^(utm_[a-z]+|gclid|fbclid|sessionid|sid|phpsessid|ref)="

OP5 = rf"""
WITH page AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS digest, 1700000000 + 60 * page_id AS ts, 'day ' || (page_id // 100) AS day,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
  FROM pages
), part AS (
  SELECT *, regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), ':(80|443)$', '') AS host, regexp_replace(bare, '^[^/?]*', '') AS rest
  FROM page
), place AS (
  SELECT * REPLACE (
    regexp_replace(host, '^(www|m)\.', '') || regexp_replace(regexp_extract(rest, '^[^?]*'), '/+$', '') || CASE WHEN kept = '' THEN '' ELSE '?' || kept END AS url
  ) FROM (
    SELECT *, array_to_string(list_sort(list_filter(
      string_split(regexp_replace(rest, '^[^?]*\??', ''), '&'), lambda q: q <> '' AND NOT regexp_matches(q, '{_VISIT}'))), '&') AS kept
    FROM part
  )
), response AS (
  SELECT url, ts, 4 * page_id AS response_id, digest AS tag, day FROM place
  UNION ALL
  SELECT url, ts + 43200, 4 * page_id + 1, CASE WHEN page_id % 3 = 0 THEN md5(digest || '-2') ELSE digest END, day FROM place
), newest AS (
  SELECT * FROM response WHERE url IS NOT NULL AND ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY url, ts ORDER BY response_id DESC, tag DESC) = 1
), revisit AS (
  SELECT 4 * page_id + 2 AS record_id, url, ts + CASE WHEN page_id % 13 = 0 THEN -3600 WHEN page_id % 2 = 0 THEN 86400 ELSE 20000 END AS ts,
    CASE WHEN page_id % 11 = 0 OR page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN 'changed' ELSE digest END AS named_tag,
    CASE WHEN page_id % 11 <> 0 AND page_id % 7 = 0 THEN day END AS named_day
  FROM place
), found AS (
  SELECT r.record_id, r.url, named_tag, named_day, response_id, tag, day,
    CASE WHEN response_id IS NULL THEN 'no-earlier-response' WHEN named_tag IS NULL AND named_day IS NULL THEN 'no-validator'
      WHEN coalesce(named_tag = tag, named_day = day) THEN 'resolved' ELSE 'stale' END AS outcome
  FROM revisit AS r ASOF LEFT JOIN newest AS s ON r.url = s.url AND r.ts > s.ts
)
SELECT record_id, url, outcome, CASE WHEN outcome = 'resolved' THEN response_id END AS response_id,
  CASE WHEN outcome = 'resolved' THEN CAST(200 AS INTEGER) END AS status, CASE WHEN outcome = 'resolved' THEN tag END AS payload_digest,
  CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=120' || chr(10) || 'content-type: text/html' || chr(10) ||
    'etag: ' || coalesce('W/"' || named_tag || '"', '"' || tag || '"') || chr(10) || 'last-modified: ' || coalesce(named_day, day) END AS headers
FROM found
"""

#: Words of the lower-cased text, by the class that decontamination uses.
_ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents
), item AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_ITEM_WORDS} AS w FROM benchmark
), gram AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS g
  FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(k) WHERE len(w) > 0
), place AS (
  SELECT r, k, size, array_to_string(w[k:k + size - 1], ' ') AS g
  FROM doc, (SELECT DISTINCT size FROM gram) AS sizes, unnest(range(1, len(w) - size + 2)) AS u(k) WHERE len(w) >= size
), found AS (
  SELECT r, k, size, item FROM place JOIN gram USING (size, g)
), hits AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM found, unnest(range(k, k + size)) AS u(p) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP8 = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), place AS (
  SELECT r, k, array_to_string(w[k:k + 34], ' ') AS g FROM doc, unnest(range(1, len(w) - 33)) AS u(k) WHERE len(w) >= 35
), repeated AS (
  SELECT r, k FROM place WHERE g IN (SELECT g FROM place GROUP BY g HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT r, p FROM repeated, unnest(range(k, k + 35)) AS u(p)
), word AS (
  SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM doc
), kept AS (
  SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

OP10 = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
  FROM doc, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(k) WHERE len(w) > 0
), size AS (
  SELECT doc_id, count(*) AS n, min(s) AS least, sum(hash(s)) AS h FROM shingle GROUP BY doc_id
), class AS (
  SELECT doc_id, n, min(doc_id) OVER (PARTITION BY n, least, h) AS rep FROM size
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingle AS a JOIN shingle AS b ON a.s = b.s AND a.doc_id < b.doc_id
  WHERE a.doc_id IN (SELECT rep FROM class) AND b.doc_id IN (SELECT rep FROM class) GROUP BY ALL
), link AS (
  SELECT a, b FROM shared JOIN size AS x ON x.doc_id = a JOIN size AS y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), both_ways AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
  SELECT a AS node, b AS other FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.other
), component AS (
  SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node
)
SELECT doc.doc_id, coalesce(class.n, 0) AS n_shingles, coalesce(component, class.rep, doc.doc_id) AS component_id,
  doc.doc_id = coalesce(component, class.rep, doc.doc_id) AS kept
FROM doc LEFT JOIN class USING (doc_id) LEFT JOIN component ON node = class.rep
"""


def _encoded(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


#: CRC-32 of the decimal doc_id, one bit of the reflected polynomial at a time.
_CRC = """xor(4294967295::UBIGINT, list_reduce(
  list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS UBIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)))"""
_LEAF = " || ".join(_encoded(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_TAMPERED = _LEAF.replace(_encoded("text"), _encoded("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))


def _levels(name: str, deep: int) -> list[str]:
    """Nodes ``name0`` to ``name{deep}`` and, of all but the last, what stands before and after each in its run."""
    parts = []
    for k in range(deep):
        whole = f"CASE WHEN n <= {8**k} THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END"
        index = f"CASE WHEN n <= {8**k} THEN 0 ELSE i // 8 END"
        side = "coalesce(string_agg(d, '') OVER (PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN {}), '')"
        parts += [
            f"{name}{k + 1} AS MATERIALIZED (SELECT tree, {index} AS i, n, {whole} AS d FROM {name}{k} GROUP BY tree, {index}, n)",
            f"{name}p{k} AS MATERIALIZED (SELECT tree, i, {side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS before, "
            f"{side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS after FROM {name}{k} WHERE n > {8**k})",
        ]
    return parts


def _folds(name: str, source: str, tree: str, index: str, size: str, walk: int, deep: int) -> list[str]:
    """Paths ``walk{k}``: one level of tree ``name`` each, from ``walk`` on."""
    parts = []
    for k in range(deep):
        node = f"CASE WHEN p.before IS NULL THEN f ELSE sha256(p.before || f || p.after) END"
        parts.append(
            f"walk{walk + k + 1} AS MATERIALIZED (SELECT w.* REPLACE ({node} AS f, proof || coalesce(p.before || p.after, '') AS proof) "
            f"FROM walk{walk + k} AS w LEFT JOIN {name}p{k} AS p ON p.tree = w.{tree} AND p.i = w.{index} // {8**k} AND w.{size} > {8**k})"
        )
    return parts


_DEEP, _TOP = 8, 3
OP11 = (
    "WITH "
    + ",\n".join(
        [
            f"""doc AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, sha256({_LEAF}) AS d,
    CASE WHEN {_CRC} % 3 = 0 THEN sha256({_TAMPERED}) END AS altered
  FROM documents)""",
            """l0 AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM doc)""",
            *_levels("l", _DEEP),
            f"""t0 AS MATERIALIZED (
  SELECT '' AS tree, tree AS lang, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, d FROM l{_DEEP})""",
            *_levels("t", _TOP),
            """walk0 AS MATERIALIZED (
  SELECT l0.doc_id, l0.d AS leaf, l0.tree AS tree, l0.i AS i, l0.n AS n, t0.tree AS top, t0.i AS ti, t0.n AS tn, t0.d AS subroot,
    coalesce(altered, l0.d) AS f, '' AS proof
  FROM l0 JOIN t0 ON t0.lang = l0.tree)""",
            *_folds("l", "l0", "tree", "i", "n", 0, _DEEP),
            *_folds("t", "t0", "top", "ti", "tn", _DEEP, _TOP),
        ]
    )
    + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM walk{_DEEP + _TOP}, (SELECT d AS root FROM t{_TOP})
"""
)


def _round(k: int) -> str:
    """Nearest centroids ``a{k}`` from ``c{k}``, and ``c{k + 1}``."""
    square = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    return f"""a{k} AS MATERIALIZED (
  SELECT r, vec_id, x, k, CAST(d AS BIGINT) AS d FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, k) AS nearest FROM (SELECT v.r, v.vec_id, v.x, c.k, {square} AS d FROM v, c{k} AS c))
  WHERE nearest = 1
), c{k + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.x, c.x) AS x FROM c{k} AS c LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x
    FROM (SELECT k, j, sum(x[j]) AS s, count(*) AS n FROM a{k}, unnest(range(1, 65)) AS u(j) GROUP BY k, j) GROUP BY k) AS m ON m.k = c.k
)"""


OP12 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, x FROM v ORDER BY sha256('3:' || vec_id) LIMIT 8
), {", ".join(_round(k) for k in range(11))}
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a10 AS a JOIN c10 AS c ON c.k = a.k
"""


def _size_class(shingles: int, percent: int, source: str) -> str:
    return source.replace("w[k:k + 4]", f"w[k:k + {shingles - 1}]").replace("len(w) - 4, 1", f"len(w) - {shingles - 1}, 1").replace(">= 75 *", f">= {percent} *")


OP13 = _size_class(4, 85, OP10[: OP10.rindex("SELECT doc.doc_id")]) + """
SELECT doc.doc_id, coalesce(class.n, 0) AS n_shingles, coalesce(component, class.rep, doc.doc_id) AS component_id
FROM doc LEFT JOIN class USING (doc_id) LEFT JOIN component ON node = class.rep
"""

ORACLE = {
    "op5_revisits": OP5,
    "op6_decontamination": OP6,
    "op8_substring_dedup": OP8,
    "op10_near_duplicates": OP10,
    "op11_merkle_manifest": OP11,
    "op12_centroid_clusters": OP12,
    "op13_ngram_join": OP13,
}
