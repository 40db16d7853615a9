"""SQL that states the encoding of texts by the public vocabulary, and what follows from the counts.

It is independent of the operator: words are found without look-ahead, and each
step contracts the leftmost pair of least rank of a word and nothing else.
"""

from __future__ import annotations

from threadmill.functions import text as X
from threadmill.llm.encode import VOCABULARY, byte_names

#: White space of the vocabulary's pattern.
_WS = r"\t-\r \x{85}" + X.SPACES[1:-1].replace(r"\x0b", "").replace(r"\x1c-\x1f", "").replace(r"\x{85}", "")
#: Marks where a run of white space leaves its last character to the next word; no character of any text.
_MARK = "chr(1114110)"
_WORD = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}\x{{10FFFE}}]+|[{_WS}]+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def encoded(vocabulary: str = VOCABULARY) -> str:
    """CTEs up to word_ids(word, ids) and doc_words(doc_id, text, k, word), over documents. Opens with WITH RECURSIVE."""
    names = ", ".join(_q(c) for _, c in sorted(byte_names().items()))
    return f"""WITH RECURSIVE
model AS (SELECT (content::JSON)->'model' AS m FROM read_text({_q(vocabulary)})),
entry AS (SELECT unnest(map_entries(from_json(m->'vocab', '"MAP(VARCHAR, INTEGER)"'))) AS e FROM model),
vocab AS (SELECT e.key AS token, e.value AS id FROM entry),
rule AS (SELECT unnest(from_json(m->'merges', '["JSON"]')) AS r FROM model),
pair AS (SELECT CASE WHEN json_type(r) = 'ARRAY' THEN r->>0 ELSE split_part(r->>'$', ' ', 1) END AS a, CASE WHEN json_type(r) = 'ARRAY' THEN r->>1 ELSE split_part(r->>'$', ' ', 2) END AS b FROM rule),
merge_rule AS (SELECT x.id AS a, y.id AS b, z.id AS made FROM pair p JOIN vocab x ON x.token = p.a JOIN vocab y ON y.token = p.b JOIN vocab z ON z.token = p.a || p.b),
byte_id AS (SELECT b, v.id FROM (SELECT unnest(range(0, 256)) AS b, unnest([{names}]) AS name) n JOIN vocab v ON v.token = n.name),
found AS (SELECT doc_id, text, regexp_extract_all(regexp_replace(text, {_q(f'([{_WS}]+)([{_WS}])([^{_WS}])')}, '\\1' || {_MARK} || '\\2\\3', 'g'), {_q(_WORD)}) AS words FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text <> '')),
doc_words AS (SELECT doc_id, text, k, words[k] AS word FROM (SELECT doc_id, text, words, unnest(range(1, len(words) + 1)) AS k FROM found)),
each_word AS (SELECT word, row_number() OVER () AS w FROM (SELECT DISTINCT word FROM doc_words)),
symbol AS (SELECT w, p, i.id AS tok FROM (SELECT w, unnest(range(1, len(h) // 2 + 1)) AS p, h FROM (SELECT w, hex(encode(word)) AS h FROM each_word)) s JOIN byte_id i ON i.b = ('0x' || substr(h, 2 * p - 1, 2))::INT),
step(w, p, tok, n) AS (
  SELECT w, p, tok, 0 FROM symbol
  UNION ALL
  SELECT s.w, s.p, CASE WHEN s.p = b.x.p THEN b.x.made ELSE s.tok END, s.n + 1
  FROM step s JOIN (
    SELECT s.w, min({{'made': m.made, 'p': s.p, 'after': s.after}}) AS x
    FROM (SELECT *, lead(tok) OVER (PARTITION BY w ORDER BY p) AS following, lead(p) OVER (PARTITION BY w ORDER BY p) AS after FROM step) s
    JOIN merge_rule m ON m.a = s.tok AND m.b = s.following GROUP BY s.w) b ON b.w = s.w
  WHERE s.p <> b.x.after),
word_ids AS (SELECT e.word, list(s.tok ORDER BY s.p) AS ids FROM step s JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) l ON l.w = s.w AND l.n = s.n JOIN each_word e ON e.w = s.w GROUP BY e.word)"""


def ids() -> str:
    return f"""{encoded()},
joined AS (SELECT d.doc_id, d.text, flatten(list(i.ids ORDER BY d.k)) AS ids FROM doc_words d JOIN word_ids i USING (word) GROUP BY d.doc_id, d.text)
SELECT d.doc_id, coalesce(j.ids, []::INTEGER[]) AS ids FROM documents d LEFT JOIN joined j ON j.doc_id = d.doc_id AND j.text = d.text"""


def counted() -> str:
    """CTEs up to size(doc_id, text, n)."""
    return f"{encoded()},\nsize AS (SELECT d.doc_id, d.text, sum(len(i.ids)) AS n FROM doc_words d JOIN word_ids i USING (word) GROUP BY d.doc_id, d.text)"


def oversized(limit: int = 2048) -> str:
    return f"{counted()}\nSELECT DISTINCT doc_id FROM size WHERE n > {limit}"


def short_sources() -> str:
    return f"""{counted()},
held AS (SELECT lower(trim(d.source)) AS source, sum(s.n) AS n FROM documents d JOIN size s ON s.doc_id = d.doc_id AND s.text = d.text GROUP BY 1),
target AS (SELECT lower(trim(source)) AS source, sum(coalesce(target_weight, 0)) AS weight, max(coalesce(max_repeats, 1)) AS repeats FROM mix_targets WHERE source IS NOT NULL GROUP BY 1)
SELECT t.source FROM target t LEFT JOIN held h USING (source) WHERE coalesce(h.n, 0) * t.repeats < t.weight * (SELECT sum(n) FROM held)"""
