"""DuckDB statements for the operators that SQL can express: written from the contracts, over the whole table.

Each counts and compares plainly (windows as strings, entropies recomputed for every window), which is what makes it
independent of the operator's method.  The documents' ids are unique in the tables that these run on.
"""

from __future__ import annotations

from bazaar.llm import host_rules, secret_scan

_WORDS = r"""
w AS (SELECT doc_id, list_filter(regexp_split_to_array(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents)"""

SUBSTRING = f"""
WITH {_WORDS.strip()},
s AS (SELECT doc_id, ws, UNNEST(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
h AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY array_to_string(ws[i:i + 34], ' ')) AS n FROM s),
gone AS (SELECT DISTINCT doc_id, i + UNNEST(range(0, 35)) AS p FROM h WHERE n > 1),
each AS (SELECT doc_id, UNNEST(ws) AS x, UNNEST(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, COUNT(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - COALESCE(kept.n, 0) AS n_removed, sha256(COALESCE(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def _hosts() -> str:
    """Shrunk host rates: moments of the rates over hosts give the prior."""
    fails = ", ".join(f"SUM(CAST({sql} AS INTEGER)) AS n_{r}" for r, sql in ((r, f"({s})") for r, s in host_rules.RULES.items()))
    moments = ", ".join(
        f"LEAST(GREATEST(AVG(n_{r} / n), 1e-6), 1 - 1e-6) AS m_{r}, var_pop(n_{r} / n) AS v_{r}" for r in host_rules.RULES)
    strength = ", ".join(
        f"CASE WHEN v_{r} > 0 THEN LEAST(GREATEST(m_{r} * (1 - m_{r}) / v_{r} - 1, 2.0), 1000.0) ELSE 1000.0 END AS g_{r}" for r in host_rules.RULES)
    bad = ", ".join(f"(n_{r} + m_{r} * g_{r}) / (n + g_{r}) > 0.5 AS bad_{r}" for r in host_rules.RULES)
    return f"""
hosts AS (SELECT source, COUNT(*) AS n, {fails} FROM c WHERE source IS NOT NULL GROUP BY source),
prior AS (SELECT * , {strength} FROM (SELECT {moments} FROM hosts) t),
verdict AS (SELECT source, {bad} FROM hosts, prior)"""


HOST_RULES = f"""
WITH {_WORDS.strip()},
g AS (SELECT doc_id, ws, UNNEST(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
r AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, ws[i:i + 2]) AS n FROM g),
rep AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, i + UNNEST([0, 1, 2]) AS p FROM r WHERE n > 1) x GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
c AS (SELECT d.doc_id, d.source, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(COALESCE(list_sum(list_transform(w.ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(COALESCE(d.text, '')) - length(regexp_replace(COALESCE(d.text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(l.ls) AS n_lines, len(l.ls) - len(list_distinct(l.ls)) AS n_dup_lines, COALESCE(rep.n, 0) AS n_repeat_words
      FROM documents d JOIN w USING (doc_id) JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)),{_hosts()},
f AS (SELECT c.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             {" OR ".join(f"(({s}) AND COALESCE(bad_{r}, FALSE))" for r, s in host_rules.RULES.items())} AS host_failed
      FROM c LEFT JOIN verdict USING (source))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_failed, NOT base_failed AND NOT host_failed AS kept FROM f"""


def _spans(name: str, pattern: str) -> str:
    """Matches of a pattern with their places: what lies between matches and the matches take turns."""
    return f"""
{name}_m AS (SELECT doc_id, regexp_extract_all(t, {pattern}) AS hits, string_split_regex(t, {pattern}) AS gaps FROM t WHERE regexp_matches(t, {pattern})),
{name} AS (SELECT doc_id, hits[j] AS hit, list_sum(list_transform(gaps[1:j], lambda x: length(x)))
                  + COALESCE(list_sum(list_transform(hits[1:j - 1], lambda x: length(x))), 0) AS s
           FROM (SELECT *, UNNEST(range(1, len(hits) + 1)) AS j FROM {name}_m) u)"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_ASSIGN = _quoted(secret_scan.ASSIGN)
_ALLOW = _quoted("^(?:" + "|".join(f"(?:{p})" for p in secret_scan.ALLOW[:-1]) + ")$")
SECRETS = f"""
WITH t AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),{_spans('asg', _ASSIGN)},{_spans('acc', "'AKIA[A-Z0-9]+'")},{_spans('hx', "'[0-9a-f]+'")},
{_spans('cand', "'[A-Za-z0-9+/_=-]{20,}'").strip()},
base AS (SELECT doc_id, s, s + length(hit) AS e, 'assign' AS kind, 0 AS r FROM asg WHERE length(regexp_extract(hit, {_ASSIGN}, 1)) >= 6
         UNION ALL SELECT doc_id, s, s + length(hit), 'access', 1 FROM acc WHERE length(hit) >= 20
         UNION ALL SELECT doc_id, s, s + length(hit), 'hex', 2 FROM hx WHERE length(hit) >= 24),
fresh AS (SELECT *, regexp_matches(hit, '^[0-9a-fA-F]+$') AS is_hex FROM cand c
          WHERE NOT regexp_matches(hit, {_ALLOW}) AND len(list_distinct(string_split(hit, ''))) > 1
            AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.s < c.s + length(c.hit) AND b.e > c.s)),
peak AS (SELECT doc_id, s, hit, is_hex, list_max(list_transform(range(1, length(hit) - {secret_scan.WINDOW - 2}),
                lambda i: list_aggregate(string_split(substr(CASE WHEN is_hex THEN lower(hit) ELSE hit END, i, {secret_scan.WINDOW}), ''), 'entropy'))) AS bits FROM fresh),
added AS (SELECT doc_id, s, s + length(hit) AS e, CASE WHEN is_hex THEN 'entropy_hex' ELSE 'entropy_base64' END AS kind,
                 CASE WHEN is_hex THEN 3 ELSE 4 END AS r FROM peak WHERE bits >= CASE WHEN is_hex THEN 3.0 ELSE 3.7 END),
b AS (SELECT doc_id, COUNT(*) FILTER (kind = 'assign') AS n_assign, COUNT(*) FILTER (kind = 'access') AS n_access, COUNT(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, r) AS x FROM base GROUP BY doc_id),
a AS (SELECT doc_id, COUNT(*) FILTER (r > 2) AS n_entropy, string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, r) AS x
      FROM (SELECT * FROM base UNION ALL SELECT * FROM added) u GROUP BY doc_id)
SELECT t.doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex,
       sha256(COALESCE(b.x, '')) AS base_sha256, COALESCE(n_entropy, 0) AS n_entropy, COALESCE(a.x, '') AS spans
FROM t LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)"""


def _phrase_counts(k: int) -> str:
    words = " || ' ' || ".join(f"ws[i + {j}]" if j else "ws[i]" for j in range(k))
    return (f"f{k} AS (SELECT lang, {words} AS p, COUNT(*) AS f FROM "
            f"(SELECT lang, ws, UNNEST(range(1, len(ws) - {k - 2})) AS i FROM pieces WHERE len(ws) >= {k}) u GROUP BY ALL)")


PHRASES = r"""
WITH t AS (SELECT COALESCE(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents WHERE text IS NOT NULL),
parts AS (SELECT lang, UNNEST(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM parts),
""" + ",\n".join(_phrase_counts(k) for k in (1, 2, 3)) + r""",
total AS (SELECT lang, CAST(SUM(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
cuts AS (SELECT c.lang, c.p, c.f AS a, 1 AS k, x.f AS l, y.f AS r FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.p = split_part(c.p, ' ', 1)
           JOIN f1 y ON y.lang = c.lang AND y.p = split_part(c.p, ' ', 2) WHERE c.f >= 10
         UNION ALL SELECT c.lang, c.p, c.f, 1, x.f, y.f FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.p = split_part(c.p, ' ', 1)
           JOIN f2 y ON y.lang = c.lang AND y.p = split_part(c.p, ' ', 2) || ' ' || split_part(c.p, ' ', 3) WHERE c.f >= 10
         UNION ALL SELECT c.lang, c.p, c.f, 2, x.f, y.f FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.p = split_part(c.p, ' ', 1) || ' ' || split_part(c.p, ' ', 2)
           JOIN f1 y ON y.lang = c.lang AND y.p = split_part(c.p, ' ', 3) WHERE c.f >= 10),
scored AS (SELECT *, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
kept AS (SELECT * FROM lowest c WHERE NOT EXISTS (SELECT 1 FROM f3 g WHERE g.lang = c.lang AND g.f >= 10 AND 100 * g.f >= 50 * c.a
           AND c.p IN (split_part(g.p, ' ', 1) || ' ' || split_part(g.p, ' ', 2), split_part(g.p, ' ', 2) || ' ' || split_part(g.p, ' ', 3))))
SELECT lang, rank, p AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM
  (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank FROM kept) q JOIN total USING (lang) WHERE rank <= 2000"""
