"""SQL counterparts of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

from spendscope.llm import chat, urls

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


def _lower(c: str) -> str:
    return f"translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _escaped(c: str) -> str:
    c = rf"replace({c}, '\', '\\')"
    for mark in chat.CONTROL:
        c = rf"replace({c}, '{mark}', '{mark[0]}\{mark[1:]}')"
    return c


_MARKS = len(chat.TURN + chat.TEXT + chat.END)

OP1 = f"""
WITH said AS (
  SELECT CAST(conv_id AS BIGINT) conv_id, turn, coalesce(role, '') r, coalesce(text, '') t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_MARKS} + length({_escaped('r')}) + length({_escaped('t')})) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""

OP2 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_RULES = ", ".join(
    f"('{r.name}', '{r.verdict}', '{r.name.split('/')[0]}', '/{r.name.split('/', 1)[1]}')" for r in urls.RULES
)
_TOPICS = "|".join(r.tokens[0] for r in urls.TOPICS)

OP3 = f"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), place AS (
  SELECT page_id, url, {_lower("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(rule, verdict, rule_host, rule_path) AS (VALUES {_RULES}),
fits AS (
  SELECT p.*, r.rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id, p.url ORDER BY length(r.rule) DESC NULLS LAST) AS place
  FROM place p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN verdict
  WHEN regexp_matches({_lower("coalesce(url, '')")}, '(^|[^a-z0-9])({_TOPICS})([^a-z0-9]|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM fits WHERE place = 1
"""

OP4 = """
WITH clean AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
), parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM clean),
scores AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(sum(q.x * d.x) AS BIGINT) AS score
  FROM parts q JOIN parts d ON q.i = d.i AND q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id GROUP BY 1, 2
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP6 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORD}') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM split
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM sets LEFT JOIN least ON doc_id = a
"""

OP10 = f"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), windows AS (
  SELECT row, i, sha256(array_to_string(w[i:i + 34], ' ')) AS x FROM (SELECT row, w, unnest(range(1, len(w) - 33)) AS i FROM split)
), hits AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY x) AS n FROM windows) WHERE n > 1
), gone AS (SELECT DISTINCT row, unnest(range(i, i + 35)) AS i FROM hits),
words AS (SELECT row, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM split),
kept AS (
  SELECT row, string_agg(x, ' ' ORDER BY words.i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (row, i) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (row)
"""

# Cut into chunks first: a place deep in a long string is slow to reach.
OP12 = """
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, hex(coalesce(text, '')) AS h FROM documents),
chunks AS (SELECT row, doc_id, low, substr(h, 2 * low + 1, 226) AS part FROM (SELECT *, unnest(range(0, len(h) // 2, 64)) AS low FROM docs)),
bytes AS (
  SELECT row, doc_id, low + k AS i, substr(part, 2 * k + 1, 100) AS x
  FROM (SELECT *, unnest(range(least(64, len(part) // 2))) AS k FROM chunks)
), firsts AS (SELECT x, min(doc_id) AS first_id FROM bytes WHERE len(x) = 100 GROUP BY x),
hits AS (SELECT row, i, left(x, 2) AS c, coalesce(first_id < doc_id, false) AS hit FROM bytes LEFT JOIN firsts USING (x)),
marked AS (SELECT row, i, c, bool_or(hit) OVER (PARTITION BY row ORDER BY i ROWS 49 PRECEDING) AS gone FROM hits),
runs AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY row ORDER BY i) AS starts FROM marked),
cut AS (
  SELECT row, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_spans,
    string_agg(c, '' ORDER BY i) FILTER (NOT gone) AS kept
  FROM runs GROUP BY row
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs LEFT JOIN cut USING (row)
"""


def _repair_sql() -> str:
    """The costs still to come of the four states (none, s, u, a), row by row from the end, with edits and lines."""
    given, after = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def way(rest: str, cost: str, edit: str, line: str | None) -> str:
        lines = f"{rest}.t" if line is None else f"{line} || CASE WHEN {rest}.t = '' THEN '' ELSE chr(10) || {rest}.t END"
        return f"{{'c': {cost} + {rest}.c, 'a': '{edit}' || {rest}.a, 't': {lines}}}"

    def row(q: int) -> str:
        more = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
        ways = [way(f"f{q}", "2", "D", None)]
        rerole = way(f"f{after[q]}", f"1 + {more}", "R", f"'{given[q]}:' || text")
        ways.append(f"CASE WHEN fault NOT IN ('blank', 'duplicate') THEN {rerole} END")
        for initial, to in kept[q].items():
            keep = way(f"f{to}", more, "K", "role || ':' || text")
            ways.append(f"CASE WHEN fault NOT IN ('blank', 'duplicate') AND initial = '{initial}' THEN {keep} END")
        return f"list_min(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL)) AS f{q}"

    def insert(q: int) -> str:
        put = way(f"f{after[q]}", "5", "I", f"'{given[q]}:'")
        return f"list_min([f{q}, {put}]) AS f{q}"

    states = range(4)
    inserts = ", ".join(map(insert, states))
    f = ", ".join(f"f{q}" for q in states)
    end = {0: (0, "", ""), 1: (10, "II", "user:'||chr(10)||'assistant:"), 2: (5, "I", "assistant:"), 3: (0, "", "")}
    ends = ", ".join(f"{{'c': {c}, 'a': '{a}', 't': '{t}'}} AS f{q}" for q, (c, a, t) in end.items())
    # crc32 bit by bit: a number stands for a byte that comes in, -1 for a shift.
    crc = """list_reduce([4294967295] || flatten(list_transform(string_split(k, ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda c, op: CASE WHEN op >= 0 THEN xor(c, op) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)"""
    blank = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), kinds AS (SELECT *, xor({crc}, 4294967295) % 20 AS kind FROM named),
spoilt AS (
  SELECT conv_id, turn, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, {blank}) AS bare,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS said FROM spoilt
), faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN said > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM placed
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id
), steps AS (
  SELECT conv_id, n AS i, {ends} FROM counts
  UNION ALL
  SELECT conv_id, i, {inserts} FROM (SELECT conv_id, i, {inserts} FROM (
    SELECT s.conv_id, s.i - 1 AS i, {", ".join(map(row, states))}
    FROM steps s JOIN faults r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i))
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
  CAST(coalesce(f0.c, 0) AS BIGINT) AS cost, coalesce(f0.a, '') AS audit, sha256(coalesce(f0.t, '')) AS repaired_sha256
FROM ids LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
  LEFT JOIN steps ON steps.conv_id IS NOT DISTINCT FROM ids.conv_id AND steps.i = 0
"""


OP13 = _repair_sql()

ORACLES: dict[str, str] = {
    "op1_chat_format": OP1,
    "op2_exact_dedup": OP2,
    "op3_url_filter": OP3,
    "op4_topk_search": OP4,
    "op6_near_dedup": OP6,
    "op10_substring_dedup": OP10,
    "op12_suffix_dedup": OP12,
    "op13_conversation_repair": OP13,
}
