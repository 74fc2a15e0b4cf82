"""DuckDB SQL for the operators that plain SQL can express, written from the
stated results and not from the Spark plans: every window, every shared
shingle and every span is spelled out over the whole ``documents`` table."""

from __future__ import annotations

from shoptrail.llm.secrets import ACCESS, ASSIGN, HEX, KINDS

_BLANK = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"[x FOR x IN regexp_split_to_array(coalesce({text}, ''), '{_BLANK}') IF x <> '']"


def phrase_dedup(width: int = 13) -> str:
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_words("text")} AS w FROM documents),
win AS MATERIALIZED (
    SELECT doc_id, i, array_to_string(w[i:i + {width - 1}], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {width - 2})) AS i FROM d)),
firsts AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS MATERIALIZED (
    SELECT DISTINCT doc_id, i + k AS i
    FROM (SELECT doc_id, i, unnest(range(0, {width})) AS k FROM win JOIN firsts USING (g) WHERE m < doc_id)),
kept AS (
    SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS t, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) p
    LEFT JOIN gone USING (doc_id, i) WHERE gone.i IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def near_dedup(percent: int = 75, k: int = 5) -> str:
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(lowered)} AS w FROM documents),
sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + {k - 1}], ' ') FOR i IN range(1, len(w) - {k - 2})]) END AS s
    FROM d),
each AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
    SELECT a.doc_id AS u, b.doc_id AS v FROM each a JOIN each b ON a.g = b.g AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
steps AS MATERIALIZED (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(root, node) AS (
    SELECT doc_id, doc_id FROM sets
    UNION
    SELECT r.root, s.v FROM reach r JOIN steps s ON s.u = r.node WHERE s.v > r.root),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON node = doc_id"""


def _either_case(pattern: str) -> str:
    """The words before the value in either case, ASCII letters only."""
    words, rest = pattern.removeprefix("(?i)").split(")", 1)
    return "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in words) + ")" + rest


def _spans(kind: int, pattern: str, value: str, least: int) -> str:
    """One row a match: code points before it are the pieces and matches
    that come earlier."""
    p = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, source, {kind} AS kind, start AS s, start + length(hit) AS e, {value.format(p=p)} AS value
    FROM (SELECT doc_id, source, hit, CAST(sum(length(gap)) OVER before + sum(length(hit)) OVER before - length(hit) AS BIGINT) AS start
          FROM (SELECT doc_id, source, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, unnest(range(len(hits))) AS i
                FROM (SELECT doc_id, source, regexp_extract_all(text, '{p}', 0) AS hits, regexp_split_to_array(text, '{p}') AS gaps
                      FROM documents WHERE text IS NOT NULL))
          WINDOW before AS (PARTITION BY doc_id ORDER BY i))
    WHERE length({value.format(p=p)}) >= {least}"""


def secrets(copied_owners: int = 3) -> str:
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"

    def joined(keep: str) -> str:
        return (f"coalesce(string_agg({names}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind, e) "
                f"FILTER (WHERE {keep}), '')")
    return f"""
WITH base AS MATERIALIZED ({_spans(0, _either_case(ASSIGN), "regexp_extract(hit, '{p}', 2)", 8)}
    UNION ALL {_spans(1, ACCESS, "hit", 16)}
    UNION ALL {_spans(2, HEX, "hit", 32)}),
mixed AS ({_spans(3, "[A-Za-z0-9+/_=-]{20,}", "hit", 20)}),
found AS MATERIALIZED (
    SELECT * FROM base
    UNION ALL
    SELECT m.* FROM mixed m WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
        AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = m.doc_id AND b.s < m.e AND m.s < b.e)),
held AS (SELECT value, count(DISTINCT coalesce('=' || source, '~')) AS owners FROM found GROUP BY value),
judged AS (SELECT d.doc_id, kind, s, e, owners < {copied_owners} AS live
    FROM documents d LEFT JOIN (found JOIN held USING (value)) f ON d.doc_id = f.doc_id)
SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
    count(*) FILTER (WHERE kind = 2) AS n_hex, sha256({joined("kind < 3")}) AS base_sha256, {joined("kind < 3 OR live")} AS spans,
    {joined("live")} AS live_spans, count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_copied
FROM judged GROUP BY doc_id"""


def jaccard_join(percent: int = 80) -> str:
    return f"SELECT doc_id, n_shingles, component_id FROM ({near_dedup(percent)})"


def lexical_search(top: int = 50) -> str:
    terms = (r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")
    return f"""
WITH cut AS MATERIALIZED (
    SELECT doc_id, {terms} AS term FROM documents),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM cut GROUP BY ALL),
len AS MATERIALIZED (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM len),
wanted AS (SELECT DISTINCT item_id, {terms} AS term FROM benchmark),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, total GROUP BY term, all_docs),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len.n * all_docs) // all_terms)))) AS BIGINT) AS score
    FROM wanted JOIN tf USING (term) JOIN weight USING (term) JOIN len USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {top}"""
