"""DuckDB twins of the conversation, spelling and decontamination queries."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """crc32 of a string, bit by bit (the polynomial in reversed notation is 0xEDB88320)."""
    steps = (f"flatten(list_transform(range(0, strlen({text})), lambda i: [('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INT), 2))::BIGINT,"
             " 0, 0, 0, 0, 0, 0, 0]))")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, e: CASE WHEN xor(c, e) % 2 = 1 "
            "THEN xor(xor(c, e) // 2, 3988292384) ELSE xor(c, e) // 2 END), 4294967295::BIGINT)")


# ------------------------------------------------------------------ 11: conversation repair

def _add(value: str, cost: str, edits: str) -> str:
    """A label is nine digits of cost, then the audit; labels compare as strings."""
    return f"lpad((left({value}, 9)::INT + {cost})::VARCHAR, 9, '0') || '{edits}' || substr({value}, 10)"


_NONE = "'500000000'"
_LIVE = "r.fault IN ('', 't')"
_PEN = "CASE WHEN r.fault = 't' THEN 3 ELSE 0 END"


def _step(state: str, keeps: dict[str, str], spoken: str) -> str:
    kept = " ".join(f"WHEN {_LIVE} AND r.ini = '{i}' THEN {_add('d.f' + to, _PEN, 'K')}" for i, to in keeps.items())
    return (f"least({_add('d.f' + state, '4', 'D')}, CASE {kept} ELSE {_NONE} END, "
            f"CASE WHEN {_LIVE} THEN {_add('d.f' + spoken, '3 + ' + _PEN, 'R')} ELSE {_NONE} END) AS g{state}")


OP11_SQL = f"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s
  FROM conversations),
keyed AS (SELECT *, {crc32_sql('s')} % 20 AS k FROM base),
dmg AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE r END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN translate(t, '.!?', '') ELSE t END AS text, unnest(CASE k WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM keyed WHERE k <> 0),
ord AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS ini,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM dmg),
rows AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN nth > 1 THEN 'd'
                 WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
  FROM ord),
report AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) AS n,
         count(*) FILTER (i > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM rows) GROUP BY conv_id),
dp AS (
  SELECT conv_id, n + 1 AS i, '000000000' AS f0, '000000006II' AS f1, '000000003I' AS f2, '000000000' AS f3 FROM report
  UNION ALL
  SELECT conv_id, i, least(g0, {_add('g2', '3', 'I')}, {_add('g3', '6', 'II')}), least(g1, {_add('g2', '3', 'I')}, {_add('g3', '6', 'II')}),
         least(g2, {_add('g3', '3', 'I')}), least(g3, {_add('g2', '3', 'I')})
  FROM (SELECT d.conv_id, r.i,
               {_step('0', {'s': '1', 'u': '2'}, '2')}, {_step('1', {'u': '2'}, '2')},
               {_step('2', {'a': '3'}, '3')}, {_step('3', {'u': '2'}, '2')}
        FROM dp d JOIN rows r ON d.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = d.i - 1)),
won AS (SELECT conv_id, left(f0, 9)::BIGINT AS cost, substr(f0, 10) AS audit FROM dp WHERE i = 1),
edits AS (
  SELECT conv_id, j, substr(audit, j, 1) AS e, length(replace(left(audit, j), 'I', '')) AS i, length(replace(left(audit, j), 'D', '')) AS place,
         length(replace(audit, 'D', '')) AS said
  FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS j FROM won)),
mended AS (
  SELECT e.conv_id, string_agg(CASE WHEN e = 'K' THEN r.role WHEN (place + said) % 2 = 1 THEN 'user' ELSE 'assistant' END
                               || ':' || CASE WHEN e = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY j) AS body
  FROM edits e LEFT JOIN rows r ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.i = r.i AND e.e <> 'I' WHERE e <> 'D' GROUP BY e.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN report p ON c.conv_id IS NOT DISTINCT FROM p.conv_id LEFT JOIN won w ON c.conv_id IS NOT DISTINCT FROM w.conv_id
LEFT JOIN mended m ON c.conv_id IS NOT DISTINCT FROM m.conv_id
"""


# ------------------------------------------------------------------ 12: spelling variants

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = f"""
WITH RECURSIVE found AS (
  SELECT doc_id, {_LOWER.format('run')} AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, times, {crc32_sql('s')} AS h FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM found)),
words AS (
  SELECT word, sum(times)::BIGINT AS n
  FROM (SELECT times, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
holes AS (SELECT word, n, i, left(word, i - 1) || chr(1) || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS shorter
          FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT h.word AS a, w.word AS b FROM holes h JOIN words w ON h.shorter = w.word),
pairs AS (
  SELECT a.word, b.word AS near FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION ALL SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter),
near AS (
  SELECT p.word, count(*) AS n_near, min(struct_pack(o := -w.n, x := w.word)) AS best FROM pairs p JOIN words w ON p.near = w.word GROUP BY p.word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.o >= 10 * w.n THEN best.x END AS form, CASE WHEN -best.o >= 10 * w.n THEN -best.o END AS form_n
  FROM words w LEFT JOIN near USING (word)),
follow AS (
  SELECT word, word AS reached FROM forms
  UNION ALL SELECT f.word, s.form FROM follow f JOIN forms s ON f.reached = s.word WHERE s.form IS NOT NULL)
SELECT s.word, s.form, r.reached AS root, s.n, s.n_near, s.form_n
FROM forms s JOIN follow r ON s.word = r.word JOIN forms e ON r.reached = e.word WHERE e.form IS NULL
"""


# ------------------------------------------------------------------ 13: decontamination

_WORDS = "coalesce(regexp_extract_all(" + _LOWER.format("text") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"

OP13_SQL = f"""
WITH items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, size, array_to_string(ws[i:i + size - 1], ' ') AS win
  FROM (SELECT item, ws, least(len(ws), 10) AS size, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM items WHERE len(ws) > 0)),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
windows AS (
  SELECT rid, i, size, array_to_string(ws[i:i + size - 1], ' ') AS win
  FROM (SELECT rid, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM item_windows))),
hits AS (SELECT w.rid, w.i, w.size, m.item FROM windows w JOIN item_windows m USING (size, win)),
covered AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT rid, i, size FROM hits)) GROUP BY rid),
met AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN met USING (rid)
"""
