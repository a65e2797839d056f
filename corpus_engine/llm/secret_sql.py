"""The secret scan as one SQL statement: every window is counted anew, by its letters."""

from __future__ import annotations

from corpus_engine.llm import secret_scan as scan


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _found(kind: str, pattern: str, group: int) -> str:
    p = _text(pattern)
    return (
        f"SELECT r, '{kind}' AS kind, unnest(regexp_extract_all(t, {p})) AS hit, unnest(regexp_extract_all(t, {p}, {group})) AS part, "
        f"unnest(string_split_regex(t, {p})[:-2]) AS gap, generate_subscripts(regexp_extract_all(t, {p}), 1) AS i FROM d"
    )


_LONG = " OR ".join(f"(kind = '{k}' AND length(part) >= {least})" for k, (_, _, least) in scan.BASE.items())
_CLASS = "CASE " + " ".join(f"WHEN regexp_matches(hit, {_text(p)}) THEN {k}" for k, (_, p, _, _) in enumerate(scan.CLASSES)) + " END"
_ALLOWED = " OR ".join(
    [f"regexp_matches(hit, {_text(p)})" for p in scan.ALLOWED.values()]
    + [f"regexp_matches(right(gap, {scan.BEFORE}), {_text(p)})" for p in scan.ALLOWED_BEFORE.values()]
)
_WIDTHS = ", ".join(f"({k}, {w}, {scan.limit(w, bits)})" for k, (_, _, w, bits) in enumerate(scan.CLASSES))
_SHARES = ", ".join(f"({c}, {scan.share(c)})" for c in range(1, scan.WIDEST + 1))
_RANK = "list_position([" + ", ".join(f"'{k}'" for k in scan.KINDS) + "], kind)"
_JOINED = f"string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, {_RANK}, e)"

STATEMENT = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_found(k, p, g) for k, (p, g, _) in scan.BASE.items())}
          UNION ALL {_found("entropy", scan.CANDIDATE, 0)}),
placed AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY r, kind ORDER BY i) - length(hit) AS spot FROM found),
base AS (SELECT r, kind, spot AS s, spot + length(hit) AS e FROM placed WHERE {_LONG}),
widths(class, width, most) AS (VALUES {_WIDTHS}),
shares(c, share) AS (VALUES {_SHARES}),
open AS (SELECT r, i, spot, hit, width, most FROM (SELECT *, {_CLASS} AS class FROM placed WHERE kind = 'entropy' AND NOT ({_ALLOWED}))
         JOIN widths USING (class) WHERE length(hit) >= width),
windows AS (SELECT r, i, spot, width, most, w, hit[w + 1:w + width] AS letters FROM (SELECT *, unnest(range(length(hit) - width + 1)) AS w FROM open)),
letters AS (SELECT r, i, spot, width, most, w, unnest(string_split(letters, '')) AS letter FROM windows),
counted AS (SELECT r, i, spot, width, most, w, letter, count(*) AS c FROM letters GROUP BY ALL),
high AS (SELECT r, i, spot, width, w FROM counted JOIN shares USING (c) GROUP BY r, i, spot, width, most, w HAVING sum(share) <= most),
marked AS (SELECT *, coalesce(w > lag(w) OVER (PARTITION BY r, i ORDER BY w) + width, true)::INTEGER AS fresh FROM high),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY r, i ORDER BY w) AS run FROM marked),
more AS (SELECT r, 'entropy' AS kind, spot + min(w) AS s, spot + max(w) + width AS e FROM runs GROUP BY r, i, spot, width, run),
spans AS (SELECT *, true AS base FROM base UNION ALL
          SELECT *, false FROM more m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = m.r AND b.s <= m.s AND m.e <= b.e)),
joined AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                  count(*) FILTER (kind = 'hex') AS n_hex, {_JOINED} AS spans, {_JOINED} FILTER (base) AS base_spans
           FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (r)"""
