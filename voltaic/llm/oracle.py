"""DuckDB SQL for the numbered queries that SQL can express."""
from __future__ import annotations

from voltaic.llm.pii import ADDED, BASE, CONTEXT, Kind

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()


def _words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def near_duplicates(threshold: float = 0.8) -> str:
    """Components of all pairs whose shingle multisets overlap enough."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words("text")} AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
c AS (SELECT doc_id, sh, count(*) AS n FROM s GROUP BY ALL),
t AS (SELECT doc_id, sum(n) AS total FROM c GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS o
      FROM c a JOIN c b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN t x ON x.doc_id = a JOIN t y ON y.doc_id = b
      WHERE o::DOUBLE / (x.total + y.total - o)::DOUBLE >= {threshold}::DOUBLE),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id)
SELECT id AS doc_id, min(c) AS class_id, id = min(c) AS kept FROM r GROUP BY id"""


def decontamination(size: int = 10) -> str:
    """Windows of every length that occurs, joined by text."""
    return f"""
WITH w AS (SELECT doc_id, {_words("text")} AS ws FROM documents),
i AS (SELECT item_id, {_words("text")} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), {size}) AS n,
        unnest(list_transform(range(1, greatest(len(ws) - {size - 1}, 1) + 1),
               lambda k: array_to_string(ws[k:k + {size - 1}], ' '))) AS txt FROM i WHERE len(ws) > 0),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS k, ws FROM w JOIN lens ON len(ws) >= n),
h AS (SELECT DISTINCT doc_id, k, d.n, item_id
      FROM (SELECT doc_id, n, k, array_to_string(ws[k:k + n - 1], ' ') AS txt FROM dw) d JOIN win USING (n, txt)),
pos AS (SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM h) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM h GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""


#: A hex digest in base32: five hex digits make four characters.
_BASE32 = """array_to_string(list_transform(range(8), lambda j: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(hex, 5 * j + 1, 5))::BIGINT >> s) & 31)::INTEGER, 1)), '')), '')"""

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, strlen(html) AS n, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""


def url_rules(rules: list[tuple[str, str, str]], default: str = "allow") -> str:
    """Every rule against every url; the longest that fits wins."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return rf"""
WITH u AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(v, h, p) AS (VALUES {values}),
m AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
      FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT u.page_id, host, path, rule, coalesce(verdict, '{default}') AS verdict
FROM u LEFT JOIN m USING (page_id)"""


def embedding_duplicates(threshold: float = 0.98) -> str:
    """All pairs of a label."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= {threshold}::DOUBLE),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1),
r(id, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
m AS (SELECT id AS vec_id, min(c) AS component_id FROM r GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM m LEFT JOIN n USING (vec_id)"""


#: ``m`` is a match, ``before`` and ``after`` what lies between it and its neighbours.
_ALONE = "NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]')"
_CHECKS = {
    "email": "true",
    "ip": "list_max(list_transform(string_split(m, '.'), lambda p: p::HUGEINT)) <= 255",
    "card": """len(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, len(d) + 1), lambda k:
               CASE WHEN (len(d) - k) % 2 = 0 THEN d[k]::INT ELSE (d[k]::INT * 2) // 10 + (d[k]::INT * 2) % 10 END)) % 10 = 0""",
    "phone": "len(d) BETWEEN 9 AND 15",
    "iban": f"""{_ALONE} AND len(replace(m, ' ', '')) BETWEEN 15 AND 34 AND
                list_reduce(list_prepend(0, list_transform(string_split(replace(m, ' ', '')[5:] || m[1:4], ''),
                  lambda c: instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1)),
                  lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1""",
    "ssn": f"""{_ALONE} AND NOT regexp_matches(m, '^(000|666|9)|-00-|0000$')
               AND NOT regexp_matches(before, '[0-9]-$') AND NOT regexp_matches(after, '^-[0-9]')""",
}


def _kind_spans(place: int, kind: Kind, base: bool, threshold: float) -> str:
    near = f"lower(right(before, {CONTEXT}) || ' ' || left(after, {CONTEXT}))"
    score = f"""{kind.prior} + CASE WHEN regexp_matches({near}, '{kind.support}') THEN {kind.lift} ELSE 0 END
                - CASE WHEN regexp_matches({near}, '{kind.oppose}') THEN {kind.lift} ELSE 0 END"""
    kept = "" if base else f"AND round({score}, 6) >= {threshold}"
    return f"""
SELECT doc_id, {place} AS place, '{kind.name}' AS kind, stop - length(m) AS start, stop
FROM (SELECT doc_id, ms[k] AS m, regexp_replace(ms[k], '[^0-9]', '', 'g') AS d, ps[k] AS before, ps[k + 1] AS after,
        sum(length(ms[k]) + length(ps[k])) OVER (PARTITION BY doc_id ORDER BY k) AS stop
      FROM (SELECT doc_id, ms, ps, unnest(range(1, len(ms) + 1)) AS k
            FROM (SELECT doc_id, regexp_extract_all(t, '{kind.pattern}') AS ms, regexp_split_to_array(t, '{kind.pattern}') AS ps
                  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))))
WHERE {_CHECKS[kind.name]} {kept}"""


def personal_data(threshold: float = 0.5) -> str:
    """Every kind's matches and the gaps between them; offsets are running sums of their lengths."""
    kinds = [(k, True) for k in BASE] + [(k, False) for k in ADDED]
    found = " UNION ALL ".join(_kind_spans(i, k, base, threshold) for i, (k, base) in enumerate(kinds))
    counts = ", ".join(f"coalesce(n_{k.name}, 0)::BIGINT AS n_{k.name}" for k in BASE)
    sums = ", ".join(f"count_if(kind = '{k.name}') AS n_{k.name}" for k in BASE)
    listed = "string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY place, start)"
    return f"""
WITH s AS ({found}),
g AS (SELECT doc_id, {sums}, {listed} FILTER (place < {len(BASE)}) AS base, {listed} AS spans FROM s GROUP BY doc_id)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN g USING (doc_id)"""
