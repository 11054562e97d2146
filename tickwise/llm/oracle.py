"""DuckDB SQL of the query keys that SQL can express."""

from __future__ import annotations

import re

from tickwise.llm import license_scan

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def low(column: str) -> str:
    """A-Z lower-cased, nothing else; null is empty."""
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


def words(column: str) -> str:
    return rf"regexp_extract_all({low(column)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


SQL: dict[str, str] = {}

SQL["op7_decontaminate"] = f"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {words('text')} AS w FROM benchmark),
bw AS (  -- windows of the items
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram, i
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, {words('text')} AS w FROM documents),
g AS (
  SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT n FROM bw), LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS p)),
hit AS (SELECT r, p, g.n, item, bw.i FROM g JOIN bw ON g.n = bw.n AND g.gram = bw.gram),
items AS (
  SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS ids
  FROM hit GROUP BY r),
hw AS (SELECT r, count(DISTINCT q) AS n_hit FROM hit, LATERAL (SELECT unnest(range(p, p + n)) AS q) GROUP BY r),
runs AS (  -- neighbouring windows of an item at neighbouring places
  SELECT r, max(c) AS longest FROM (
    SELECT r, item, p - i AS dg, grp, max(p + n) - min(p) AS c FROM (
      SELECT *, p - row_number() OVER (PARTITION BY r, item, p - i ORDER BY p) AS grp FROM (
        SELECT r, item, p, n, min(i) AS i FROM hit GROUP BY r, item, p, n))
    GROUP BY ALL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  CAST(coalesce(longest, 0) AS BIGINT) AS longest_match
FROM d LEFT JOIN items USING (r) LEFT JOIN hw USING (r) LEFT JOIN runs USING (r)"""

SQL["op10_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {low('text')} AS t FROM documents),
r AS (SELECT *, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
        row_number() OVER (PARTITION BY t, doc_id) AS copy FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size,
  doc_id IS NOT DISTINCT FROM keep_id AND copy = 1 AS kept, sha256(t) AS text_sha256
FROM r"""

TURN = """replace(replace(replace(replace({}, chr(92), chr(92) || chr(92)), '</turn>', '<' || chr(92) || '/turn>'),
  '<|', '<' || chr(92) || '|'), '##', '#' || chr(92) || '#')"""

SQL["op1_chat_format"] = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, k, ['user', 'assistant'][k + 1], chr(92) || '### Assistant: </turn> ok' FROM range(2) t(k)),
f AS (SELECT *, '### ' || {TURN.format("replace(replace(role, '%', '%25'), ':', '%3A')")} || ': '
  || {TURN.format('text')} || '</turn>' || chr(10) AS block FROM m)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, block)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, block) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(block)) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""

SQL["op6_url_filter"] = rf"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, s, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
  ('org', '/fr/', 'allow')),
best AS (SELECT r, max_by(h || s, length(h || s)) AS rule, max_by(action, length(h || s)) AS action
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN best USING (r)"""


def pattern(markup: str, max_var: int = license_scan.MAX_VAR) -> tuple[str, int]:
    """A template as a regular expression over words that each have a space behind them, and the most words that it can take."""
    out, most, skipped = "", 0, False
    for part in re.split(r"(<<[^>]*>>)", markup):
        mark = re.fullmatch(r"<<(/?)(optional|var)\s*(\d*)>>", part)
        if not mark:
            found = [] if skipped else re.findall(r"[0-9a-z]+", part)
            out, most = out + "".join(w + " " for w in found), most + len(found)
        elif mark[2] == "optional":
            out += ")?" if mark[1] else "(?:"
        elif mark[1]:
            skipped = False
        else:
            n = int(mark[3] or max_var)
            out, most, skipped = out + f"(?:[^ ]+ ){{1,{n}}}", most + n, True
    return out, most


def first_words(expression: str) -> list[str]:
    """The words that a match can begin with: those of the optional regions at the front, and the first one behind them."""
    out, depth = [], 0
    for optional, end, word in re.findall(r"(\(\?:)(?!\[)|(\)\?)|([0-9a-z]+) ", expression):
        if optional:
            depth, fresh = depth + 1, True
        elif end:
            depth -= 1
        elif not depth:
            return [*out, word]
        elif fresh:
            out.append(word)
            fresh = False
    raise ValueError("a template without mandatory words")


def templates(found: list[tuple[str, str]]) -> str:
    """Rows of a VALUES list: number, label, first word, expression, most words, mandatory words."""
    rows = []
    for k, (label, markup) in enumerate(found):
        expression, most = pattern(markup)
        plain = expression
        while "(?:" in plain:  # without regions, innermost first
            plain = re.sub(r"\(\?:[^()]*\)(\?|\{1,\d+\})", "", plain)
        rows += [f"({k}, '{label}', '{w}', '^{expression}', {most}, {len(plain.split())})" for w in first_words(expression)]
    return ", ".join(rows)


BASE_PHRASES = ", ".join(f"('{phrase}', '{label}')" for phrase, label in license_scan.BASE)
BASE_FIRST = sorted({phrase.split()[0] for phrase, _ in license_scan.BASE})

SQL["op4_license_scan"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words('text')} AS w FROM documents),
place AS (SELECT r, p, w[p] AS word FROM d, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS p)),
t(k, label, first, expression, most, wording) AS (VALUES {templates(license_scan.TEMPLATES)}),
base AS (
  SELECT r, count(*) AS n, min(p) - 1 AS a, max(p) - 1 AS z, list_sort(list_distinct(list(label))) AS labels
  FROM place JOIN d USING (r) JOIN (VALUES {BASE_PHRASES}) b(phrase, label) ON word = split_part(phrase, ' ', 1)
    AND array_to_string(w[p:p + len(string_split(phrase, ' ')) - 1], ' ') = phrase
  WHERE word IN ({", ".join(f"'{w}'" for w in BASE_FIRST)}) GROUP BY r),
found AS (
  SELECT r, count(DISTINCT (k, p)) AS n, max(wording) AS wording, list_distinct(list(label)) AS labels
  FROM place JOIN t ON word = first JOIN d USING (r)
  WHERE regexp_matches(array_to_string(w[p:p + most - 1], ' ') || ' ', expression) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, a AS first_word, z AS last_word,
  array_to_string(coalesce(base.labels, []), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(found.labels, []))), ',') AS labels,
  least(greatest(coalesce(wording, 0), CASE WHEN base.n > 0 THEN 3 ELSE 0 END) / 8.0, 1.0)::DOUBLE AS score,
  CAST(coalesce(found.n, 0) AS BIGINT) AS n_found
FROM d LEFT JOIN base USING (r) LEFT JOIN found USING (r)"""


def crc32(text: str) -> str:
    """The CRC-32 of a string's UTF-8 bytes, four bits at a time."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ 0xEDB88320 if c & 1 else c >> 1
        table.append(c)
    digits = f"hex(encode({text}))"
    nibbles = f"list_transform(range(CAST(length({digits}) AS BIGINT)), lambda i: CAST('0x' || {digits}[CAST(xor(i, 1) AS BIGINT) + 1] AS BIGINT))"
    return f"""xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || {nibbles},
  lambda a, x: xor(a >> 4, CAST({table} AS BIGINT[])[(xor(a, x) & 15) + 1])))"""


SQL["op12_line_dedup"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
n AS (SELECT r, i, l[i] AS line, translate(trim(l[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM d, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)),
common AS (SELECT key FROM n WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
k AS (SELECT r, count(*) AS n_lines, count(*) FILTER (common.key IS NOT NULL) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (common.key IS NULL), '') AS kept
  FROM n LEFT JOIN common USING (key) GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN k USING (r)"""

SQL["op11_spelling"] = rf"""
WITH RECURSIVE runs AS (  -- a document's different runs
  SELECT doc_id, translate(w, '{UPPER}', '{LOWER}') AS w, count(*) AS n FROM (
    SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
  GROUP BY r, 1, 2),
h AS (SELECT w, n, {crc32("coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || w")} AS h FROM runs),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word, n FROM h)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z
  FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
near AS (
  SELECT x.word, y.word AS other, y.n FROM cut x JOIN cut y ON x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.a || c.z
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.a || c.z),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM near GROUP BY word),
f AS (SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * words.n THEN other END AS form,
    CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.at WHERE f.form IS NOT NULL)
SELECT f.*, walk.at AS root FROM f JOIN walk USING (word) JOIN f AS e ON e.word = walk.at WHERE e.form IS NULL"""

SQL["op13_importance"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words('text')} AS w FROM documents),
o AS (SELECT r, unnest(w) AS w FROM d), b AS (SELECT unnest({words('text')}) AS w FROM benchmark),
hashed AS (SELECT w, {crc32('w')} % 10000 AS k FROM (SELECT w FROM o UNION SELECT w FROM b)),
s AS (SELECT k, count(*) AS s FROM o JOIN hashed USING (w) GROUP BY k), t AS (SELECT k, count(*) AS t FROM b JOIN hashed USING (w) GROUP BY k),
gain AS (SELECT k, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE)
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM range(10000) x(k) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
g AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM o JOIN hashed USING (w) JOIN gain USING (k) GROUP BY r),
v AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(weight, 0) AS weight,
    CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null'))[1:8] AS BIGINT) AS h FROM d LEFT JOIN g USING (r)),
x AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM v),
p AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM x WHERE n_words >= 20)
SELECT doc_id, n_words AS n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank, n_words
FROM x LEFT JOIN p USING (r)"""
