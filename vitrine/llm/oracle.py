"""DuckDB SQL for the queries that SQL can express, written from the contracts.

``op1`` (vocabulary), ``op2`` (MinHash) and ``op9`` (trees) have none; their tests
compare with brute force."""

from __future__ import annotations

from vitrine.llm import mixing as M
from vitrine.llm.chat import END
from vitrine.llm.spotsigs import ANCHOR_WORDS, REACH

WORD_SPLIT = r"'[\x20\x09-\x0D]+'"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _words(text: str) -> str:
    return f"[x FOR x IN regexp_split_to_array({text}, {WORD_SPLIT}) IF x <> '']"


HOST_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_words('t')} AS w,
        [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM d),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM (
        SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w))),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM (SELECT r, i, unnest([0, 1, 2]) AS j FROM g WHERE k > 1)
        GROUP BY r),
s AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
f AS (SELECT *, base_failed OR 10 * n_symbols > 5 * n_words OR 100 * n_dup_lines > 30 * n_lines
        OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS host_failed FROM b),
h AS (SELECT source, count(*) AS n, count(*) FILTER (host_failed) AS k FROM f GROUP BY source),
p AS (SELECT avg(k / n) AS m,
        coalesce(var_samp(k / n), 0) - avg(k / n) * (1 - avg(k / n)) * avg(1.0 / n) AS spread FROM h),
c AS (SELECT m, CASE WHEN spread > 0 THEN greatest(m * (1 - m) / spread - 1, 1.0) END AS c FROM p),
v AS (SELECT source, coalesce((k + m * c) / (n + c), m) >= 0.5 AS flagged FROM h, c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (flagged AND host_failed) AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

_ANCHORS = "[" + ", ".join(f"'{a}'" for a in ANCHOR_WORDS) + "]"


def _signatures(name: str, source: str, column: str) -> str:
    """Relation (r, s): the sorted signature sets of a text column."""
    return rf"""
{name}_w AS (SELECT r, {column} AS t,
    [x FOR x IN regexp_split_to_array(lower({column}), '[^\p{{L}}\p{{N}}]+') IF x <> ''] AS w FROM {source}),
{name}_i AS (SELECT r, w, i, w[i] AS x, list_contains({_ANCHORS}, w[i]) AS a
    FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM {name}_w)),
{name}_p AS (SELECT *, bool_or(a) OVER (PARTITION BY r) AS any_a FROM {name}_i),
{name}_s AS (SELECT r, list_sort(list(DISTINCT substr(md5(array_to_string(list_concat([x],
    [y FOR y IN w[i + 1:i + {REACH}] IF NOT list_contains({_ANCHORS}, y)][1:2]), ' ')), 1, 8))) AS s
    FROM {name}_p WHERE a OR NOT any_a GROUP BY r),
{name} AS (SELECT r, coalesce(s, [substr(md5(t), 1, 8)]) AS s FROM {name}_w LEFT JOIN {name}_s USING (r))"""


def _likeness(a: str, b: str) -> str:
    return (f"CAST(len(list_intersect({a}, {b})) AS DOUBLE) "
            f"/ (len({a}) + len({b}) - len(list_intersect({a}, {b})))")


def _fingerprint(s: str) -> str:
    return (f"CAST(CAST(floor(ln(len({s})) / ln(1 / 0.75)) AS INT) AS VARCHAR) || ':' "
            f"|| array_to_string({s}, '')")


SPOTSIGS = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
    row_number() OVER (ORDER BY doc_id DESC NULLS LAST, md5(coalesce(text, ''))) AS r FROM documents),
n AS (SELECT *, coalesce(lead(t) OVER (ORDER BY r), first_value(t) OVER (ORDER BY r)) AS next,
    CASE WHEN r = max(r) OVER () THEN 1 ELSE r + 1 END AS next_r FROM d),
e AS (SELECT *, substr(t, 1, length(t) - length(t) // 2) || substr(next, 1, length(t) // 2) AS edited FROM n),
{_signatures('own', 'e', 't')},
{_signatures('cut', 'e', 'edited')}
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
  {_fingerprint('o.s')} AS fingerprint, {_fingerprint('c.s')} AS edited_fingerprint,
  {_likeness('o.s', 'c.s')} AS near_edited, {_likeness('o.s', 'x.s')} AS near_next
FROM e JOIN own o USING (r) JOIN cut c USING (r) JOIN own x ON x.r = e.next_r
"""

_DIGITS = " || ".join(
    f"substr('{BASE32}', CAST(1 + ((v[{i + 1}] >> {s}) & 31) AS INT), 1)"
    for i in range(8) for s in (15, 10, 5, 0))

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first,
        [CAST('0x' || substr(h, 1 + 5 * CAST(i AS INT), 5) AS BIGINT) FOR i IN range(8)] AS v FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, {_DIGITS} AS payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM q
"""

CHAT = f"""
WITH t AS (SELECT conv_id, turn, coalesce(nullif(trim(role, ' '), ''), 'unknown') AS speaker,
    replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, speaker, text) AS position
      FROM t),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
l AS (SELECT o.*, perspective, CASE WHEN speaker = 'system' THEN 'system'
        WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS label
      FROM o JOIN p ON o.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '<|' || label || '|>' || chr(10)
        || CASE WHEN label = 'user' THEN speaker || ': ' ELSE '' END AS head FROM l),
s AS (SELECT *, head || text || '{END}' || chr(10) AS segment FROM h),
e AS (SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY position) AS upto FROM s)
SELECT conv_id, perspective, CAST(position AS BIGINT) AS position, turn, speaker, label, segment,
  CAST(upto - length(segment) AS BIGINT) AS start, CAST(upto AS BIGINT) AS "end",
  CAST(CASE WHEN label = 'assistant' THEN upto - length(segment) + length(head) END AS BIGINT) AS mask_start,
  CAST(CASE WHEN label = 'assistant' THEN upto - 1 END AS BIGINT) AS mask_end
FROM e
"""


def _weight(column: str, weights: dict[str, float]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items())
    return f"CAST(CASE {column} {cases} ELSE 1.0 END AS DOUBLE)" if cases else "CAST(1.0 AS DOUBLE)"


def _deal(name: str, source: str, parent: str, child: str) -> str:
    """Relation like ``source`` (cap, weight, budget) with the share each child gets."""
    return f"""
{name}_o AS (SELECT *, (budget - coalesce(sum(cap) OVER b, 0))
    / (sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER b, 0)) AS level FROM {source}
  WINDOW b AS (PARTITION BY {parent} ORDER BY cap / weight, {child}
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name} AS (SELECT *, coalesce(least(cap, weight * max(level) FILTER (cap / weight > level)
    OVER (PARTITION BY {parent})), cap) AS got FROM {name}_o)"""


MIXING = f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
    'domain' || (CAST('0x' || substr(md5(coalesce(source, '')), 1, 1) AS INT) % 4) AS domain FROM documents),
n AS (SELECT doc_id, domain, lang, source, CAST(len({_words('t')}) AS BIGINT) AS n,
    coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(t) AS identity,
    coalesce(lang, chr(0) || 'null') AS l, coalesce(source, chr(0) || 'null') AS s FROM d),
leaf AS (SELECT domain, l, s, sum(n) AS tokens, CAST(sum(n) * {M.MAX_EPOCHS} AS DOUBLE) AS cap FROM n GROUP BY ALL),
d1 AS (SELECT domain, 0 AS root, sum(cap) AS cap, {_weight('domain', M.DOMAIN_WEIGHTS)} AS weight,
    (SELECT sum(n) FROM n) * CAST({M.SHARE} AS DOUBLE) AS budget FROM leaf GROUP BY domain),
{_deal('g1', 'd1', 'root', 'domain')},
d2 AS (SELECT domain, l, sum(leaf.cap) AS cap, {_weight('l', M.LANG_WEIGHTS)} AS weight, any_value(g1.got) AS budget
    FROM leaf JOIN g1 USING (domain) GROUP BY domain, l),
{_deal('g2', 'd2', 'domain', 'l')},
d3 AS (SELECT domain, l, s, leaf.cap, tokens, CAST(1.0 AS DOUBLE) AS weight, g2.got AS budget
    FROM leaf JOIN g2 USING (domain, l)),
{_deal('g3', 'd3', 'domain, l', 's')},
q AS (SELECT domain, l, s, CAST(floor(got + 1e-6) AS BIGINT) // CAST(tokens AS BIGINT) AS epochs,
    CAST(floor(got + 1e-6) AS BIGINT) % CAST(tokens AS BIGINT) AS rest FROM g3 WHERE got > 0),
k AS (SELECT n.*, epochs, rest, md5('{M.SEED}:' || epochs || ':' || identity) AS key FROM n JOIN q USING (domain, l, s)),
u AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, l, s ORDER BY key
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS before FROM k),
x AS (SELECT *, epochs + CASE WHEN before < rest
    AND 2 * before + sum(n) OVER (PARTITION BY domain, l, s, key) <= 2 * rest THEN 1 ELSE 0 END AS times FROM u)
SELECT doc_id, domain, lang, source, n AS n_tokens, CAST(epoch AS INT) AS epoch
FROM (SELECT *, unnest(range(times)) AS epoch FROM x)
"""

ORACLE_SQL = {"op4_mixing": MIXING, "op5_host_rules": HOST_RULES, "op6_spotsigs": SPOTSIGS,
              "op7_warc": WARC, "op8_chat": CHAT}
