"""DuckDB SQL for the queries of this package; written apart from the Spark code and without its helpers."""

from __future__ import annotations

#: White space and capitals as the contracts have them.
_WS = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {_WORDS.format("t")} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
l AS (SELECT r, ls[i] AS line, row_number() OVER (PARTITION BY r, ls[i] ORDER BY i) AS k FROM (SELECT r, ls, unnest(range(1, len(ls) + 1)) AS i FROM w)),
dl AS (SELECT r, count(*) FILTER (k > 1) AS n_dup, coalesce(sum(length(line)) FILTER (k > 1), 0) AS dup_chars, sum(length(line)) AS line_chars FROM l GROUP BY r),
g AS (SELECT r, n, i, array_to_string(ws[i : i + n - 1], ' ') AS win FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, (SELECT unnest([5, 6, 7, 8, 9, 10]) AS n) WHERE len(ws) >= n)),
twice AS (SELECT r, n, i FROM g QUALIFY count(*) OVER (PARTITION BY r, n, win) > 1),
marked AS (SELECT DISTINCT r, n, p FROM (SELECT r, n, unnest(range(i, i + n)) AS p FROM twice)),
cover AS (SELECT r, n, count(*) AS words, sum(length(ws[p])) AS chars FROM marked JOIN w USING (r) GROUP BY r, n),
c AS (SELECT r, {", ".join(f"coalesce(max(chars) FILTER (n = {k}), 0) AS cover_{k}" for k in range(5, 11))}, coalesce(max(words) FILTER (n = 8), 0) AS reps FROM cover GROUP BY r),
m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup, 0) AS n_dup_lines, coalesce(reps, 0) AS n_repeat_words, coalesce(dup_chars, 0) AS dup_line_chars, coalesce(line_chars, 0) AS line_chars,
  {", ".join(f"coalesce(cover_{k}, 0) AS cover_{k}" for k in range(5, 11))} FROM w LEFT JOIN dl USING (r) LEFT JOIN c USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND 100 * dup_line_chars <= 40 * line_chars AND 100 * cover_5 <= 50 * word_chars AND 100 * cover_6 <= 48 * word_chars AND 100 * cover_7 <= 46 * word_chars
  AND 100 * cover_8 <= 44 * word_chars AND 100 * cover_9 <= 42 * word_chars AND 100 * cover_10 <= 40 * word_chars AS kept,
  CASE WHEN n_dup_lines > 0 THEN dup_line_chars ELSE 0 END::BIGINT AS dup_line_chars, {", ".join(f"cover_{k}::BIGINT AS cover_{k}" for k in range(5, 11))} FROM f
"""

OP7 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line, {_LOWER.format(f"trim(ls[i], {_WS})")} AS k FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
hot AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
s AS (SELECT l.*, hot.k IS NOT NULL AND doc_id <> keeper AS gone FROM l LEFT JOIN hot USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM s GROUP BY doc_id
"""

#: Of op4: kind, pattern, group to measure, least length (fixed values); RE2 has no look-behind, and leftmost runs need none.
_OP4_KINDS = (
    ("assign", "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("entropy", "[A-Za-z0-9+/_=-]{20,}", 0, 20),
)
#: Candidates that are no secrets (fixed values).
_OP4_ALLOWED = (
    "^[0-9_=/+-]+$",
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "(?i)abcdefgh|12345678|example|sample|placeholder|changeme|dummy|redacted|xxxx",
    "^/?[A-Za-z0-9_-]*(/[A-Za-z0-9_-]*){2,}$",
    "^[A-Za-z]+([-_=][A-Za-z]+)*[-_=]?[0-9]{1,4}$",
)


def _op4() -> str:
    # A window of 20 has entropy h bits or more if the sum of c * log2(c) is at most 20 * (log2(20) - h); in millionths.
    most = lambda bits: f"round(20 * (log2(20) - {bits}) * 1000000)::BIGINT"
    kinds, names = _OP4_KINDS, [k for k, *_ in _OP4_KINDS]
    found = " UNION ALL ".join(
        f"SELECT r, '{k}' AS kind, {i} AS rank, {n} AS least, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}', 0) AS ms, regexp_extract_all(t, '{p}', {g}) AS what FROM d WHERE regexp_matches(t, '{p}')"
        for i, (k, p, g, n) in enumerate(kinds)
    )
    allowed = " OR ".join(f"regexp_matches(what, '{p}')" for p in _OP4_ALLOWED)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({found}),
m AS (SELECT r, kind, rank, least, i, length(gaps[i]) AS gap, length(ms[i]) AS len, what[i] AS what FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM f)),
p AS (SELECT *, (sum(gap + len) OVER (PARTITION BY r, rank ORDER BY i) - len)::BIGINT AS s FROM m),
base AS (SELECT r, kind, rank, s, s + len AS e FROM p WHERE rank < 3 AND length(what) >= least),
cand AS (SELECT *, 20 AS win, CASE WHEN regexp_matches(what, '^[0-9a-fA-F]+$') THEN {most(3.0)} ELSE {most(3.6)} END AS most FROM p
  WHERE rank = 3 AND regexp_matches(what, '[0-9]') AND (regexp_matches(what, '^[0-9a-fA-F]+$') OR (regexp_matches(what, '[A-Z]') AND regexp_matches(what, '[a-z]'))) AND NOT ({allowed})),
wins AS (SELECT r, s, w, most, unnest(string_split(substring(what, w::BIGINT, win), '')) AS ch FROM (SELECT *, unnest(range(1, len - win + 2)) AS w FROM cand WHERE len >= win)),
cnt AS (SELECT r, s, w, most, ch, count(*) AS c FROM wins GROUP BY ALL),
tot AS (SELECT r, s, w, most, sum(round(c * log2(c) * 1000000)::BIGINT) AS x FROM cnt GROUP BY r, s, w, most),
hot AS (SELECT DISTINCT r, s FROM tot WHERE x <= most),
ent AS (SELECT c.r, c.kind, c.rank, c.s, c.s + c.len AS e FROM cand c JOIN hot USING (r, s) WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = c.r AND b.s < c.s + c.len AND c.s < b.e)),
a AS (SELECT * FROM base UNION ALL SELECT * FROM ent),
g AS (SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in names)}, coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3), '') AS b, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM a GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in names)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)
"""


ORACLES = {"op4_secret_scan": _op4(), "op6_quality_rules": OP6, "op7_line_dedup": OP7}
