"""Pieces of the SQL that states the analytics queries independently."""

from __future__ import annotations

from threadmill.config import Config
from threadmill.functions import patterns as P
from threadmill.functions import text as X


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q('(?i)' + pattern)})"


def n(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {q('(?i)' + pattern)}))"


def fold(x: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace({x}, {q(X.SPACES)}, ' ', 'g'), {q(X.LETTERS)}, '_', 'g'), '\\p{{M}}', '·', 'g')"


def prose(x: str) -> str:
    return f"regexp_replace({x}, {q(P.CODE_FENCE)}, ' ', 'g')"


_BLANK = "[\\s" + X.SPACES[1:]


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {q(f'^{_BLANK}+')}, ''), {q(f'{_BLANK}+$')}, '')"


def norm(x: str) -> str:
    """Lower case [a-z0-9] words. Characters that unfold to several are spelt out only where a text has them."""
    source, target, several = X.compatibility()
    unfolded = f"list_reduce(list_prepend({x}, [{', '.join(q(a + b) for a, b in several)}]), lambda t, m: replace(t, m[1], m[2:]))"
    flat = f"nfc_normalize(translate(CASE WHEN regexp_matches({x}, {q('[' + ''.join(a for a, _ in several) + ']')}) THEN {unfolded} ELSE {x} END, {q(source)}, {q(target)}))"
    return f"trim(regexp_replace(lower(CASE WHEN regexp_matches({x}, '[^\\x00-\\x7F]') THEN {flat} ELSE {x} END), '[^a-z0-9]+', ' ', 'g'))"


def voice(f: str, words: str) -> str:
    return f"(2 * ({n(f, P.FIRST_PERSON)} * 100.0::DOUBLE / greatest({words}, 1)) + {n(f, P.SPOKEN_FILLER)} * 100.0::DOUBLE / greatest({words}, 1))"


def label(f: str, words: str, cfg: Config | None = None) -> str:
    cfg = cfg or Config()
    trimmed = f"regexp_replace(regexp_replace({f}, '^\\s+', ''), '\\s+$', '')"
    links = f"coalesce(list_sum(list_transform(regexp_extract_all({f}, {q(P.URL)}), lambda u: length(u))), 0)"
    return f"""CASE WHEN {f} IS NULL THEN NULL
  WHEN {words} >= {P.LONG_TURN_WORDS} AND {has(f"substring({f}, 1, {P.OWN_VOICE_HEAD})", "(" + P.any_of(P.OWN_VOICE, cfg.extra_own_voice_preambles) + ")")} THEN 'own_voice'
  WHEN {has(f, "(" + P.any_of(P.THIRD_PARTY, cfg.extra_paste_markers) + ")")} OR {n(f, P.TIMESTAMP)} >= 3 THEN 'pasted'
  WHEN {links} > 0 AND {links}::DOUBLE / greatest(length({f}), 1) > {P.URL_SHARE} THEN 'pasted'
  WHEN {has(f, P.OPTION_PICK)} OR {has(f, P.OPTION_BLOCK)} THEN 'quiz'
  WHEN {words} <= {P.CHIP_MAX_WORDS} AND NOT {has(f, P.FIRST_PERSON)} AND ({has(f, P.CHIP_VERB)} OR
       (({has(f, P.BULLET)} OR contains({trimmed}, chr(10))) AND {has(f, P.SECOND_PERSON)} AND NOT {trimmed} LIKE '%?')) THEN 'suggestion'
  WHEN {words} < {P.LONG_TURN_WORDS} THEN 'authored'
  WHEN {voice(f, words)} >= {P.AUTHORED_FLOOR} THEN 'authored' ELSE 'pasted' END"""


def part_text(p: str) -> str:
    return f"CASE WHEN regexp_matches({p}, '^\\s*\\{{') AND json_valid({p}) THEN coalesce(json_extract_string({p}, '$.text'), '') ELSE coalesce({p}, '') END"


def rounded(a: str, b: str, digits: int) -> str:
    return f"CASE WHEN {b} = 0 THEN 0.0::DOUBLE ELSE round_even({a} * 1e{digits}::DOUBLE / {b}, 0) / 1e{digits}::DOUBLE END"


#: Common table expressions: turns(conv_no, conversation_id, title, create_time, pos, role, text, ts) of the active branches.
TURNS = f"""
latest AS (SELECT * FROM conversations WHERE conv_no IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conv_no ORDER BY exported_at DESC) = 1),
entry AS (SELECT conv_no, map_entries(mapping) AS es FROM latest WHERE mapping IS NOT NULL),
node AS (SELECT conv_no, es[i].key AS node_id, es[i].value.parent AS parent, es[i].value.message AS message, i
         FROM (SELECT conv_no, es, unnest(range(1, len(es) + 1)) AS i FROM entry)),
parents AS (SELECT DISTINCT conv_no, parent FROM node WHERE parent IS NOT NULL),
leaf AS (SELECT n.conv_no, max_by(n.node_id, n.i) AS node_id FROM node n ANTI JOIN parents p ON p.conv_no = n.conv_no AND p.parent = n.node_id GROUP BY 1),
start AS (
  SELECT l.conv_no, coalesce(n.node_id, f.node_id) AS node_id, cardinality(l.mapping) AS size FROM latest l
  LEFT JOIN node n ON n.conv_no = l.conv_no AND n.node_id = l.current_node LEFT JOIN leaf f ON f.conv_no = l.conv_no),
way(conv_no, node_id, far, size) AS (
  SELECT conv_no, node_id, 0, size FROM start WHERE node_id IS NOT NULL
  UNION ALL
  SELECT w.conv_no, n.parent, w.far + 1, w.size FROM way w JOIN node n ON n.conv_no = w.conv_no AND n.node_id = w.node_id
  JOIN node p ON p.conv_no = n.conv_no AND p.node_id = n.parent WHERE w.far < w.size),
path AS (SELECT conv_no, node_id, (count(*) OVER (PARTITION BY conv_no) - 1 - min(far))::INTEGER AS pos FROM way GROUP BY conv_no, node_id),
turns AS (
  SELECT * FROM (
    SELECT l.conv_no, coalesce(nullif(l.conversation_id, ''), l.id) AS conversation_id, l.title, l.create_time, p.pos, lower(n.message.author.role) AS role,
      {strip(f"array_to_string(list_filter(list_transform(n.message.content.parts, lambda p: {part_text('p')}), lambda t: t <> ''), chr(10))")} AS text,
      nullif(n.message.create_time, 0) AS ts
    FROM path p JOIN node n USING (conv_no, node_id) JOIN latest l USING (conv_no)
    WHERE n.message IS NOT NULL AND NOT coalesce(n.message.metadata.is_visually_hidden_from_conversation, false)
      AND lower(n.message.author.role) IN ('user', 'assistant') AND n.message.content.content_type IN ('text', 'multimodal_text'))
  WHERE text <> '')"""

#: After TURNS: labelled user turns, and credited ones.
CREDITED = f"""
ahead AS (SELECT *, lag(role) OVER w AS r0, lag(text) OVER w AS t0 FROM turns WINDOW w AS (PARTITION BY conv_no ORDER BY pos)),
said AS (SELECT *, CASE WHEN r0 = 'assistant' THEN t0 END AS before, {prose('text')} AS prose FROM ahead WHERE role = 'user'),
folded AS (SELECT *, {fold('prose')} AS f, {fold('text')} AS fa FROM said),
counted AS (SELECT *, {n('f', P.WORD)} AS n_prose, {n('fa', P.WORD)} AS n_all FROM folded),
labelled AS (SELECT *, {label('f', 'n_prose')} AS label FROM counted),
toks AS (
  SELECT conv_no, pos, before IS NOT NULL AS replies, list_filter(string_split({norm('prose')}, ' '), lambda x: x <> '') AS mine,
         CASE WHEN before IS NULL THEN [] ELSE list_filter(string_split({norm('before')}, ' '), lambda x: x <> '') END AS theirs
  FROM labelled WHERE label IN ('authored', 'own_voice')),
own AS (SELECT conv_no, pos, replies, len(mine) AS size, i, array_to_string(mine[i:i + 7], ' ') AS run FROM (SELECT *, unnest(range(1, len(mine) - 6)) AS i FROM toks)),
other AS (SELECT DISTINCT conv_no, pos, array_to_string(theirs[i:i + 7], ' ') AS run FROM (SELECT *, unnest(range(1, len(theirs) - 6)) AS i FROM toks WHERE replies)),
owner AS (SELECT conv_no, run, min(pos) AS first_pos FROM own GROUP BY 1, 2),
hit AS (
  SELECT o.conv_no, o.pos, o.size, unnest(range(o.i, o.i + 8)) AS place FROM own o
  JOIN other t ON t.conv_no = o.conv_no AND t.pos = o.pos AND t.run = o.run JOIN owner f ON f.conv_no = o.conv_no AND f.run = o.run WHERE f.first_pos >= o.pos),
shares AS (SELECT conv_no, pos, count(DISTINCT place)::DOUBLE / any_value(size) AS share FROM hit GROUP BY 1, 2),
credited AS (
  SELECT l.*, coalesce(s.share, 0)::DOUBLE AS echo_share, CASE WHEN label IN ('authored', 'own_voice') THEN round_even(n_prose * coalesce(s.share, 0)::DOUBLE, 0) ELSE 0 END::BIGINT AS echoed
  FROM labelled l LEFT JOIN shares s USING (conv_no, pos))"""


def term_bags(rows: str, cap: int = P.TERM_CAP) -> str:
    """CTEs word, bags(conv_no, terms) of labelled rows(conv_no, text, label)."""
    stop = ", ".join(q(w) for w in P.STOP_WORDS)
    return f"""
word AS (SELECT conv_no, trim(unnest(regexp_extract_all(lower(text), {q(P.TERM)})), '''-') AS word FROM {rows} WHERE label IN ('authored', 'own_voice')),
freq AS (SELECT conv_no, word, count(*) AS k FROM word WHERE length(word) >= 3 AND word NOT IN ({stop}) GROUP BY 1, 2),
bags AS (SELECT conv_no, list(word ORDER BY k DESC, word) AS terms FROM
  (SELECT * FROM freq QUALIFY row_number() OVER (PARTITION BY conv_no ORDER BY k DESC, word) <= {cap}) GROUP BY 1)"""


def metrics() -> str:
    """CTEs up to metrics, after TURNS and CREDITED."""
    mine = "label IN ('authored', 'own_voice')"
    third, course = "(" + P.any_of(P.THIRD_PARTY) + ")", "(" + P.any_of(P.COURSEWORK) + ")"
    return f"""{term_bags('credited')},
by_turn AS (
  SELECT conv_no, count(*) AS user_turns, sum(n_all) AS user_words, coalesce(sum(n_prose - echoed) FILTER ({mine}), 0) AS authored_words,
    coalesce(sum(n_prose - echoed) FILTER (label = 'own_voice'), 0) AS own_voice_words, sum(CASE WHEN {mine} THEN 0 ELSE n_prose END + n_all - n_prose) AS pasted_words,
    sum(echoed) AS echoed_words, count(*) FILTER ({mine}) AS authored_turns, coalesce(max(n_prose - echoed) FILTER ({mine}), 0) AS max_user_turn_words,
    count(*) FILTER ({has('fa', P.OPTION_PICK)} OR {has('fa', P.OPTION_BLOCK)} OR {has('fa', P.DRILL)}) AS drills, {fold("string_agg(text, chr(10) ORDER BY pos)")} AS body
  FROM credited GROUP BY 1),
per_day AS (SELECT conv_no, strftime(make_timestamp((ts * 1000000)::BIGINT), '%Y-%m-%d') AS d, sum(n_prose - echoed) AS w FROM credited WHERE {mine} AND ts IS NOT NULL GROUP BY 1, 2),
content AS (SELECT conv_no, count(*) FILTER (w >= {P.CONTENT_DAY_WORDS}) AS content_days FROM per_day GROUP BY 1),
every AS (
  SELECT conv_no, count(*) FILTER (role = 'assistant') AS assistant_turns, coalesce(sum({n(fold('text'), P.WORD)}) FILTER (role = 'assistant'), 0) AS assistant_words,
    count(DISTINCT strftime(make_timestamp((ts * 1000000)::BIGINT), '%Y-%m-%d')) AS days_touched,
    CASE WHEN count(ts) > 1 THEN (max(ts) - min(ts)) / 3600 ELSE 0 END::DOUBLE AS span, string_agg(text, chr(10) ORDER BY pos) AS every_text
  FROM turns GROUP BY 1),
metrics AS (
  SELECT e.conv_no, coalesce(user_turns, 0)::BIGINT AS user_turns, assistant_turns::BIGINT AS assistant_turns, coalesce(user_words, 0)::BIGINT AS user_words, assistant_words::BIGINT AS assistant_words,
    {rounded('coalesce(user_words, 0)', 'coalesce(user_turns, 0)', 1)} AS avg_user_turn_words, days_touched::BIGINT AS days_touched, span AS span_hours,
    {rounded(f"coalesce(list_sum(list_transform(regexp_extract_all(every_text, {q(P.CODE_FENCE)}), lambda c: length(c))), 0)", 'length(every_text)', 3)} AS code_ratio, length(every_text)::BIGINT AS chars,
    coalesce(authored_words, 0)::BIGINT AS authored_words, coalesce(own_voice_words, 0)::BIGINT AS own_voice_words, coalesce(pasted_words, 0)::BIGINT AS pasted_words, coalesce(echoed_words, 0)::BIGINT AS echoed_words,
    coalesce(authored_turns, 0)::BIGINT AS authored_turns, coalesce(max_user_turn_words, 0)::BIGINT AS max_user_turn_words, {rounded('coalesce(authored_words, 0)', 'coalesce(authored_turns, 0)', 1)} AS avg_authored_turn_words,
    coalesce(content_days, 0)::BIGINT AS content_days, coalesce(terms, []::VARCHAR[]) AS terms,
    coalesce(({has('body', third)} AND {has('body', P.SCHOOL)}) OR {has('body', course)}
      OR (user_turns >= 4 AND drills >= 4 AND drills::DOUBLE / user_turns >= 0.30 AND ({has('body', P.OPTION_BLOCK)} OR {has('body', P.SCHOOL)})), false) AS coursework
  FROM every e LEFT JOIN by_turn b USING (conv_no) LEFT JOIN content c USING (conv_no) LEFT JOIN bags t USING (conv_no))"""


def score(cfg: Config | None = None) -> str:
    cfg = cfg or Config()
    w, p = cfg.weights, cfg.penalties
    ln = lambda x: f"ln(1 + coalesce({x}, 0)::DOUBLE)"
    pace = "(coalesce(authored_words, 0)::DOUBLE / greatest(coalesce(days_touched, 0), 1))"
    visits = f"coalesce(content_days, CASE WHEN {pace} < {w['routine_min_wpd']} THEN 1 ELSE coalesce(days_touched, 0) END)"
    skew = "(coalesce(assistant_words, 0)::DOUBLE / greatest(coalesce(authored_words, 0), 1))"
    return f"""({w['authored_words']}::DOUBLE * {ln('authored_words')} + {w['own_voice']}::DOUBLE * {ln('own_voice_words')} + {w['longest_turn']}::DOUBLE * {ln('max_user_turn_words')}
  + CASE WHEN coalesce(coursework, false) THEN -{p['coursework']}::DOUBLE ELSE
      {w['turn_depth']}::DOUBLE * {ln('authored_turns')} + {w['turn_length']}::DOUBLE * {ln('avg_authored_turn_words')} + {w['return_visit']}::DOUBLE * least(greatest({visits} - 1, 0), {w['return_cap']})
      - CASE WHEN coalesce(days_touched, 0) >= 3 AND {pace} < {w['routine_min_wpd']} THEN {p['routine']}::DOUBLE * {ln('days_touched')} ELSE 0 END END
  - {p['code']}::DOUBLE * coalesce(code_ratio, 0)
  - CASE WHEN coalesce(authored_words, 0) > 0 AND {skew} > 6 AND coalesce(avg_authored_turn_words, 0) < 40 THEN {p['consumption']}::DOUBLE * ln(1 + greatest({skew} - 6, 0)) ELSE 0 END)"""


def topics(cfg: Config | None = None) -> str:
    cfg = cfg or Config()
    text = fold("(concat_ws(' ', lower(coalesce(title, '')), CASE WHEN len(terms) > 0 THEN array_to_string(terms, ' ') END))")
    found, drops = [], []
    for name, spec in cfg.topics.items():
        spec = {"pattern": spec} if isinstance(spec, str) else spec
        patterns = [spec["pattern"]] if "pattern" in spec else list(spec["all_of"])
        tests = [f"len(list_distinct(regexp_extract_all({text}, {q('(?i)' + x)}, 1))) >= {cfg.min_term_hits}" for x in patterns]
        found.append(f"CASE WHEN {' AND '.join(tests)} THEN {q(name)} END")
        drops += [(r, " AND ".join(tests)) for r in spec.get("replaces", [])]
    listed = f"list_filter([{', '.join(found)}], lambda t: t IS NOT NULL)"
    for name, test in drops:
        listed = f"CASE WHEN {test} THEN list_filter({listed}, lambda t: t <> {q(name)}) ELSE {listed} END"
    return listed


#: After turns(conv_no, pos, role, text) and notes(file, content): quoted(file, line, quote, context).
#: A quotation stands between two neighbouring quotation marks of a line; of two that would share a mark the first counts.
def quoted() -> str:
    inner = "p[i]"
    straight = f"""(CASE WHEN i = 2 AND p[1] = '' THEN true ELSE regexp_matches(p[i - 1], '[\\s(>\\[*_]$') END)
      AND length({inner}) >= 40 AND regexp_matches({inner}, '^\\S') AND regexp_matches({inner}, '\\S$')
      AND (CASE WHEN i + 1 = len(p) AND p[i + 1] = '' THEN true ELSE regexp_matches(p[i + 1], '^[\\s.,;:!?)\\]*_]') END)"""
    return f"""
lined AS (
  SELECT file, lines, i AS line, lines[i] AS row, array_to_string(lines[greatest(i - 3, 1):i + 1], chr(10)) AS context FROM (
    SELECT file, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT file, string_split(content, chr(10)) AS lines FROM notes WHERE content IS NOT NULL AND NOT regexp_replace(file, '.*/', '') LIKE '\\_%' ESCAPE '\\'))),
piece AS (SELECT file, line, context, p, unnest(range(2, len(p))) AS i FROM (SELECT *, string_split(row, '"') AS p FROM lined)),
fits AS (SELECT file, line, context, i, p[i] AS raw FROM piece WHERE {straight}),
island AS (SELECT *, i - row_number() OVER (PARTITION BY file, line ORDER BY i) AS g FROM fits),
taken AS (SELECT *, row_number() OVER (PARTITION BY file, line, g ORDER BY i) AS k FROM island),
raws AS (
  SELECT file, line, context, raw FROM taken WHERE k % 2 = 1
  UNION ALL SELECT file, line, context, unnest(regexp_extract_all(row, '“([^”\\n]{{40,}})”', 1)) FROM lined),
quoted AS (SELECT file, line::INTEGER AS line, replace(raw, '**', '') AS quote, context FROM raws
  WHERE NOT contains(replace(raw, '**', ''), '[[') AND NOT contains(replace(raw, '**', ''), 'source:') AND NOT contains(replace(raw, '**', ''), '`') AND length({norm("replace(raw, '**', '')")}) >= 30)"""


def checked() -> str:
    """After quoted: checks(file, line, quote, status, labeled). Every quotation is tried on every turn."""
    words = lambda status, keys: f"(status = '{status}' AND len(list_filter(bold, lambda b: regexp_matches(b, {q(f'(?i)' + chr(92) + f'b({keys}|unverifiable)' + chr(92) + 'b')}))) > 0)"
    labels = " OR ".join(words(s, k) for s, k in (("echoed", "assistant[- ]coined|echoed"), ("unsourced", "cleaned|paraphrase"), ("not_authored", "pasted|chip|clicked")))
    grams = lambda toks: f"list_distinct(list_transform(range(1, len({toks}) - {P.QUOTE_RUN - 2}), lambda i: array_to_string({toks}[i:i + {P.QUOTE_RUN - 1}], ' ')))"
    return f"""
each AS (SELECT DISTINCT quote FROM quoted),
cutup AS (SELECT quote, list_filter(list_transform(string_split_regex(quote, '\\.\\.\\.|…|\\[\\.\\.\\.\\]'), lambda s: {norm('s')}), lambda s: length(s) >= {P.MIN_SEGMENT}) AS found, {norm('quote')} AS whole FROM each),
seg AS (SELECT quote, whole, CASE WHEN len(found) > 0 THEN found ELSE [whole] END AS segs FROM cutup),
raw_turn AS (SELECT conv_no, pos, role, {norm('text')} AS said, {fold('text')} AS f FROM turns),
told AS (SELECT *, {n('f', P.WORD)} AS n_words FROM raw_turn),
speech AS (SELECT conv_no, pos, role, said, CASE WHEN role = 'user' THEN {label('f', 'n_words')} IN ('authored', 'own_voice') END AS mine FROM told),
hit AS (SELECT s.quote, t.conv_no, t.pos, t.mine FROM seg s JOIN speech t ON t.role = 'user' AND len(list_filter(s.segs, lambda x: NOT contains(t.said, x))) = 0),
near_turn AS (SELECT conv_no, pos, role, mine, string_split(said, ' ') AS toks FROM speech WHERE conv_no IN (SELECT conv_no FROM hit) AND said <> ''),
run AS (SELECT conv_no, pos, role, mine, unnest({grams('toks')}) AS run FROM near_turn),
owners AS (SELECT conv_no, run, min(pos) FILTER (mine) AS owner, min(pos) FILTER (role = 'assistant') AS theirs FROM run GROUP BY 1, 2),
ask AS (SELECT quote, unnest({grams('toks')}) AS run FROM (SELECT quote, string_split(whole, ' ') AS toks FROM seg)),
lent AS (
  SELECT h.quote, h.conv_no, min(o.theirs) AS theirs FROM (SELECT DISTINCT quote, conv_no FROM hit WHERE mine) h JOIN ask a USING (quote) JOIN owners o ON o.conv_no = h.conv_no AND o.run = a.run
  WHERE o.theirs IS NOT NULL AND (o.owner IS NULL OR o.owner >= o.theirs) GROUP BY 1, 2),
judged AS (SELECT h.quote, bool_or(h.mine) AS any_mine, bool_or(h.mine AND (l.theirs IS NULL OR l.theirs >= h.pos)) AS clean FROM hit h LEFT JOIN lent l ON l.quote = h.quote AND l.conv_no = h.conv_no GROUP BY 1),
state AS (SELECT e.quote, CASE WHEN j.quote IS NULL THEN 'unsourced' WHEN NOT j.any_mine THEN 'not_authored' WHEN j.clean THEN 'ok' ELSE 'echoed' END AS status FROM each e LEFT JOIN judged j USING (quote)),
checks AS (SELECT file, line, quote, status, {labels} AS labeled FROM (SELECT *, regexp_extract_all(context, '\\*\\*([^*\\n]+?)\\*\\*', 1) AS bold FROM quoted JOIN state USING (quote)))"""


def stems(x: str) -> str:
    """The names that links in a text lead to."""
    tidy = "regexp_replace(regexp_replace(x, '^\\[\\[|^\\]\\(', ''), '\\.md\\)$', '')"
    return f"list_filter(list_transform(regexp_extract_all({x}, '\\[\\[[^\\]|\\\\]+|\\]\\([^)]+?\\.md\\)'), lambda x: trim(regexp_replace({tidy}, CASE WHEN x LIKE '[[%' THEN '^$' ELSE '.*/' END, ''))), lambda s: s <> '')"


def gated(with_quotes: bool) -> str:
    """After notes, and checks if with_quotes: gate(file, problems list, cited list)."""
    failed = ", CASE WHEN file IN (SELECT file FROM checks WHERE status <> 'ok' AND NOT labeled) THEN 'quotations fail' END, CASE WHEN file IN (SELECT 'note-' || doc_id || '.md' FROM documents WHERE lower(trim(source)) = 'note_final') THEN 'a note of this name exists' END" if with_quotes else ""
    return f"""
form AS (
  SELECT file, content, regexp_matches(content, '(?s)^---\\n(.*?)\\n---\\n') AS front, regexp_matches(regexp_extract(content, '(?s)^---\\n(.*?)\\n---\\n', 1), '(?m)^source:\\s*\\S') AS source,
    list_distinct(list_filter(flatten(list_transform(regexp_extract_all(content, '(?im)^\\*?Sources?:\\*?(.*)$', 1), lambda y: {stems('y')})), lambda s: regexp_matches(s, '^\\d{{4}}-\\d{{2}}-\\d{{2}}-'))) AS cites
  FROM (SELECT file, coalesce(content, '') AS content FROM notes)),
there AS (SELECT list(DISTINCT regexp_replace(file, '\\.md$', '')) AS all_stems FROM conv_index),
gate AS (
  SELECT file, list_filter([CASE WHEN NOT front THEN 'no frontmatter block' END, CASE WHEN front AND NOT source THEN 'frontmatter has no source' END, CASE WHEN len(cites) = 0 THEN 'cites no conversation' END,
      CASE WHEN len(list_filter(cites, lambda c: NOT list_contains(all_stems, c))) > 0 THEN 'cites an unknown conversation' END{failed}], lambda x: x IS NOT NULL) AS problems,
    list_sort(list_filter(cites, lambda c: list_contains(all_stems, c))) AS cited
  FROM form, there)"""


def quotation_queries(before: str, notes: str, turns: str) -> dict[str, str]:
    """The SQL of the queries over notes. ``before`` opens with WITH RECURSIVE and ends in turns."""
    base = f"{before}, {notes}, {quoted()}, {checked()}"
    return {
        "note_quotes": f"WITH {notes}, {quoted()} SELECT file, line, quote FROM quoted",
        "quote_checks": f"{base} SELECT file, line, quote, status, labeled FROM checks",
        "quote_summary": f"{base} SELECT status, labeled, count(*) AS quotes FROM checks GROUP BY 1, 2",
        "note_problems": f"{base}, {gated(True)} SELECT file, array_to_string(problems, '; ') AS problems, len(cited)::INTEGER AS cited FROM gate",
        "promoted_pending": f"""WITH {notes}, {gated(False)},
k AS (SELECT regexp_replace(file, '\\.md$', '') AS stem, file, max(user_turns) AS user_turns, arg_max(conversation_id, (coalesce(user_turns, -1), coalesce(conversation_id, ''))) AS conversation_id FROM conv_index WHERE file IS NOT NULL GROUP BY 1, 2),
c AS (SELECT file AS note, unnest(cited) AS stem FROM gate WHERE len(problems) = 0),
p AS (SELECT coalesce(nullif(k.conversation_id, ''), k.file) AS rec_key, k.file, k.user_turns, c.note FROM k JOIN c USING (stem))
SELECT rec_key, min(file) AS file, min(user_turns)::BIGINT AS user_turns, array_to_string(list_sort(list_distinct(list(note))), ' ') AS notes FROM p GROUP BY 1""",
    }
