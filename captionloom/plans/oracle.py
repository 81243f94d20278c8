"""DuckDB SQL for the queries of the registry, written apart from their DataFrame plans."""

from __future__ import annotations

import html.entities

from captionloom.params import REVIEW_PACKS, REVIEW_PARTS, TASKS_V1, TASKS_V2, Budget

CLOSERS = "[\"”’''»)\\]]"
TERMINAL = f"[.!?…]+({CLOSERS}+)?$"
CLAUSE = f"[,;:]+({CLOSERS}+)?$"
TOKEN = "[0-9A-Za-zÀ-ỹĐđ]+"
SPACE = "[\\s\\x0B\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"


def clean(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return spaced(x)


def spaced(x: str) -> str:
    """Text without zero-width characters, with single spaces within a line and none at the ends."""
    return f"regexp_replace(regexp_replace(regexp_replace({x}, '[\\x{{200b}}\\x{{feff}}]', '', 'g'), '[ \\t\\r\\f\\x0B]+', ' ', 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"


def unescaped(source: str, key: str, text: str) -> str:
    """v_unescaped({key}, plain): texts with all references of HTML resolved, each once. A number may lack its semicolon; of names the
    longest that the text goes on with counts, and names that HTML knows without a semicolon need none."""
    quote = lambda x: x.replace("'", "''")
    names = ", ".join(f"('{k}', '{quote(v)}')" for k, v in html.entities.html5.items())
    western = ", ".join("'" + (bytes([k]).decode("cp1252", "ignore") or chr(k)) + "'" for k in range(0x80, 0xA0))
    return f"""v_names(name, chars) AS (VALUES {names}
), v_rows AS MATERIALIZED (SELECT row_number() OVER () AS r, {key}, {text} AS t FROM {source}
), v_parts AS MATERIALIZED (SELECT r, unnest(ps) AS p, generate_subscripts(ps, 1) AS k FROM (SELECT r, string_split(t, '&') AS ps FROM v_rows)
), v_begins AS (SELECT r, k, unnest(list_transform(range(2, least(length(p), 32) + 1), lambda n: p[:n])) AS name FROM v_parts WHERE k > 1
), v_named AS (SELECT r, k, arg_max(name, length(name)) AS name, arg_max(chars, length(name)) AS chars FROM v_begins JOIN v_names USING (name) GROUP BY ALL
), v_digits AS (
  SELECT *, ltrim(regexp_extract(p, '^#([0-9]+)', 1), '0') AS ten, lower(ltrim(regexp_extract(p, '^#[xX]([0-9a-fA-F]+)', 1), '0')) AS sixteen,
    regexp_extract(p, '^#([0-9]+|[xX][0-9a-fA-F]+);?', 0) AS number FROM v_parts WHERE k > 1
), v_codes AS (
  SELECT *, CASE WHEN number = '' THEN NULL WHEN greatest(length(ten), length(sixteen)) > 7 THEN 1114112 WHEN ten <> '' THEN ten::BIGINT
    ELSE coalesce(list_sum(list_transform(range(1, length(sixteen) + 1), lambda i: (instr('0123456789abcdef', sixteen[i]) - 1) * (16 ** (length(sixteen) - i))::BIGINT)), 0)::BIGINT END AS code
  FROM v_digits
), v_resolved AS (
  SELECT r, k, CASE WHEN code IS NOT NULL THEN CASE
      WHEN code BETWEEN 128 AND 159 THEN [{western}][code - 127]
      WHEN code = 0 OR code BETWEEN 55296 AND 57343 OR code > 1114111 THEN chr(65533)
      WHEN code BETWEEN 1 AND 8 OR code BETWEEN 14 AND 31 OR code IN (11, 127) OR code BETWEEN 64976 AND 65007 OR code % 65536 >= 65534 THEN ''
      ELSE chr(code::INT) END || p[length(number) + 1:]
    WHEN name IS NOT NULL THEN chars || p[length(name) + 1:] ELSE '&' || p END AS p
  FROM v_codes LEFT JOIN v_named USING (r, k)
  UNION ALL SELECT r, k, p FROM v_parts WHERE k = 1
), v_unescaped AS (SELECT {key}, plain FROM v_rows LEFT JOIN (SELECT r, string_agg(p, '' ORDER BY k) AS plain FROM v_resolved GROUP BY r) USING (r))"""


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def lexical(x: str) -> str:
    return squeeze(f"regexp_replace(lower({clean(x)}), '[^0-9a-zA-ZÀ-ỹĐđ\\s\\x0B\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]', ' ', 'g')")


WORDS = f"""
v_tok AS MATERIALIZED (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS word_index
  FROM (SELECT doc_id, string_split(t, ' ') AS ws FROM (
    SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g')) AS t FROM documents) WHERE t <> '')
), v_timed AS (
  SELECT 'd' || doc_id AS video_id, doc_id, word_index, word, word_index // 20 AS segment_id, 250 + 20 * length(word) AS dur_ms,
    CASE WHEN regexp_matches(word, '[.!?]$') THEN 650 WHEN regexp_matches(word, '[,;:]$') THEN 250
         WHEN (word_index * 7919) % 11 = 0 THEN 400 ELSE 50 END AS gap_ms,
    (50 + (word_index * 37 + doc_id * 11) % 50) / 100.0 AS probability
  FROM v_tok
), v_words AS MATERIALIZED (
  SELECT *, start_ms + dur_ms AS end_ms FROM (
    SELECT *, coalesce(sum(dur_ms + gap_ms) OVER (PARTITION BY video_id ORDER BY word_index
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_ms FROM v_timed)
)"""

SEGMENTS = """
v_segments AS MATERIALIZED (
  SELECT video_id, doc_id, segment_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms, string_agg(word, ' ' ORDER BY word_index) AS text,
    -((segment_id * 13 + doc_id) % 120) / 100.0 AS avg_logprob, ((segment_id * 29 + doc_id) % 80) / 100.0 AS no_speech_prob
  FROM v_words GROUP BY ALL
)"""

CAPTIONS = """
v_captions AS MATERIALIZED (
  SELECT video_id, word_index // 7 AS event_index, min(start_ms) AS start_ms, max(end_ms) + 500 AS end_ms, string_agg(word, ' ' ORDER BY word_index) AS text
  FROM v_words WHERE word_index % 13 <> 12 GROUP BY ALL
)"""

UNITS = f"""
v_run AS (
  SELECT *, coalesce(sum(ends) OVER (PARTITION BY video_id ORDER BY event_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS run
  FROM (SELECT *, regexp_matches(trim(text), '{TERMINAL}')::INT AS ends FROM v_captions)
), v_glued AS (
  SELECT *, CASE WHEN lag(text) OVER r IS NULL THEN '' WHEN regexp_matches(lag(text) OVER r, '[ \\n]$') THEN ''
    WHEN regexp_matches(text, '^[ \\n,.?!…:;)\\]}}]') THEN '' ELSE ' ' END AS glue
  FROM v_run WINDOW r AS (PARTITION BY video_id, run ORDER BY event_index)
), v_units AS MATERIALIZED (
  SELECT video_id, run + 1 AS unit_no, min(start_ms) AS start_ms, max(end_ms) AS end_ms, min(event_index) AS first_event_index,
    max(event_index) AS last_event_index, count(*) AS n_events, {clean("string_agg(glue || text, '' ORDER BY event_index)")} AS text, max(ends) = 1 AS terminated
  FROM v_glued GROUP BY video_id, run
)"""

PIECES = f"""
v_cut AS (
  SELECT *, regexp_split_to_array(regexp_replace(text, '((?:[.!?]+|…+)["”’»)\\]]*)({SPACE}|$)', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS raws FROM v_units
), v_raw AS (
  SELECT video_id, unit_no, start_ms, end_ms, length(text) AS n, unnest(raws) AS raw, generate_subscripts(raws, 1) AS k FROM v_cut
), v_at AS (
  SELECT *, regexp_replace(raw, '^{SPACE}+|{SPACE}+$', '', 'g') AS piece, length(raw) - length(regexp_replace(raw, '^{SPACE}+', '')) AS blank,
    coalesce(sum(length(raw)) OVER (PARTITION BY video_id, unit_no ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM v_raw
), v_no AS (
  SELECT *, row_number() OVER (PARTITION BY video_id, unit_no ORDER BY k) AS piece_no, count(*) OVER (PARTITION BY video_id, unit_no) AS n_pieces,
    pos + blank AS char_start, pos + blank + length(piece) AS char_end, length(piece) AS char_count, len(string_split({squeeze("piece")}, ' ')) AS word_count
  FROM v_at WHERE piece <> ''
), v_pieces AS MATERIALIZED (
  SELECT video_id, video_id || '_S' || lpad(unit_no::VARCHAR, 6, '0') AS parent_block_id,
    video_id || '_S' || lpad(unit_no::VARCHAR, 6, '0') || '_P' || lpad(piece_no::VARCHAR, 3, '0') AS piece_id, unit_no, piece_no, char_start, char_end,
    piece AS text_exact, char_count, word_count, round(start_ms + (end_ms - start_ms) * char_start / greatest(1, n), 3) AS approx_start_ms,
    round(start_ms + (end_ms - start_ms) * char_end / greatest(1, n), 3) AS approx_end_ms, word_count > 42 OR char_count > 240 AS needs_split_hint,
    word_count <= 2 OR char_count <= 12 AS tiny_hint, CASE WHEN n_pieces > 1 THEN 'internal_terminal_punctuation' ELSE 'parent_block_unsplit' END AS split_basis
  FROM v_no
)"""

PUNCT = "[!-/:-@\\[-`{-~…]"
RISKS = f"""
v_risks AS MATERIALIZED (
  SELECT piece_id, len(list_filter(w, lambda x, i: x <> '' AND i > 1 AND x = w[i - 1])) > 0 AS repeat_hint,
    len(list_filter(range(1, len(h) - 3), lambda k: len(list_filter(h[k:k + 4], lambda c: len(list_filter(h[k:k + 4], lambda d: d = c)) >= 4)) > 0)) > 0 AS crowding_hint
  FROM (SELECT piece_id, list_transform(string_split({squeeze("lower(text_exact)")}, ' '), lambda x: regexp_replace(x, '^{PUNCT}+|{PUNCT}+$', '', 'g')) AS w,
    list_transform(list_filter(regexp_extract_all(lower(text_exact), '{TOKEN}'), lambda t: length(t) >= 2), lambda t: t[1]) AS h FROM v_pieces)
)"""

GAPS = """
v_gaps AS MATERIALIZED (
  SELECT *, greatest(0, start_ms - lag(end_ms) OVER w) AS raw_before, start_ms - lag(end_ms) OVER w AS gap_global_ms,
    CASE WHEN lag(end_ms) OVER w IS NOT NULL THEN greatest(0, start_ms - lag(end_ms) OVER w) END AS gap_before_ms,
    CASE WHEN lead(start_ms) OVER w IS NOT NULL THEN greatest(0, lead(start_ms) OVER w - end_ms) END AS gap_after_ms,
    coalesce(lead(segment_id) OVER w <> segment_id, true) AS segment_boundary, coalesce(lag(segment_id) OVER w <> segment_id, true) AS cross_segment,
    row_number() OVER w - 1 AS word_no
  FROM v_words WINDOW w AS (PARTITION BY video_id ORDER BY start_ms, end_ms, segment_id, word_index)
)"""

def matched(source: str, p: str, a: str, b: str, name: str) -> str:
    """{name}(pid, ratio): 2M/T of the matching blocks of the token lists a and b of each row p of source, which is
    materialised. The longest common run of a range, the first of equals in a and then in b, splits it in two."""
    return f"""
{name}_a AS (SELECT {p} AS pid, unnest({a}) AS tok, generate_subscripts({a}, 1) AS i FROM {source}),
{name}_b AS (SELECT {p} AS pid, unnest({b}) AS tok, generate_subscripts({b}, 1) AS j FROM {source}),
{name}_hit AS MATERIALIZED (SELECT pid, i, j, i - j AS d FROM {name}_a JOIN {name}_b USING (pid, tok)),
{name}_block AS (
  SELECT {p} AS pid, 1::BIGINT AS alo, len({a})::BIGINT AS ahi, 1::BIGINT AS blo, len({b})::BIGINT AS bhi, 0::BIGINT AS size FROM {source}
  UNION ALL
  SELECT pid, CASE WHEN side THEN i + n ELSE alo END, CASE WHEN side THEN ahi ELSE i - 1 END, CASE WHEN side THEN j + n ELSE blo END,
    CASE WHEN side THEN bhi ELSE j - 1 END, CASE WHEN side THEN 0 ELSE n END
  FROM (SELECT pid, alo, ahi, blo, bhi, min(i) AS i, min(j) AS j, count(*) AS n
    FROM (SELECT r.pid, alo, ahi, blo, bhi, i, j, d, i - row_number() OVER (PARTITION BY r.pid, alo, ahi, blo, bhi, d ORDER BY i) AS run
      FROM {name}_block r JOIN {name}_hit h ON h.pid = r.pid AND i BETWEEN alo AND ahi AND j BETWEEN blo AND bhi)
    GROUP BY pid, alo, ahi, blo, bhi, d, run
    QUALIFY row_number() OVER (PARTITION BY pid, alo, ahi, blo, bhi ORDER BY count(*) DESC, min(i), min(j)) = 1) CROSS JOIN (VALUES (false), (true)) s(side)
), {name} AS MATERIALIZED (
  SELECT t.{p} AS pid, CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * m::DOUBLE / (len({a}) + len({b}))::DOUBLE END AS ratio
  FROM {source} t JOIN (SELECT pid, sum(size) AS m FROM {name}_block GROUP BY pid) m ON m.pid = t.{p}
)"""


CONSENSUS = f"""
v_pairs AS MATERIALIZED (
  SELECT row_number() OVER () AS n, * FROM
    (SELECT video_id, (start_ms + end_ms) // 60000 AS bucket, regexp_extract_all(lower(string_agg(text, ' ' ORDER BY segment_id)), '{TOKEN}') AS a FROM v_segments GROUP BY ALL)
    JOIN (SELECT video_id, (start_ms + end_ms) // 60000 AS bucket, regexp_extract_all(lower(string_agg(text, ' ' ORDER BY event_index)), '{TOKEN}') AS b FROM v_captions GROUP BY ALL)
    USING (video_id, bucket)
), {matched("v_pairs", "n", "a", "b", "v_match")}, v_consensus AS MATERIALIZED (
  SELECT video_id, bucket, ratio AS token_similarity FROM v_pairs JOIN v_match ON pid = n
)"""

BOUND = f"""
v_tokens AS (
  SELECT 'a' AS side, video_id, (start_ms + end_ms) // 60000 AS bucket, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS tok FROM v_segments
  UNION ALL SELECT 'c', video_id, (start_ms + end_ms) // 60000, unnest(regexp_extract_all(lower(text), '{TOKEN}')) FROM v_captions
), v_counts AS (SELECT side, video_id, bucket, tok, count(*) AS n FROM v_tokens GROUP BY ALL
), v_sizes AS (SELECT side, video_id, bucket, sum(n) AS n FROM v_counts GROUP BY ALL
), v_shared AS (
  SELECT a.video_id, a.bucket, sum(least(a.n, c.n)) AS n FROM v_counts a JOIN v_counts c USING (video_id, bucket, tok) WHERE a.side = 'a' AND c.side = 'c' GROUP BY ALL
), v_grid AS (
  SELECT video_id, bucket FROM (SELECT DISTINCT video_id, (start_ms + end_ms) // 60000 AS bucket FROM v_segments)
  JOIN (SELECT DISTINCT video_id, (start_ms + end_ms) // 60000 AS bucket FROM v_captions) USING (video_id, bucket)
), v_bound AS MATERIALIZED (
  SELECT g.video_id, g.bucket, CASE WHEN coalesce(a.n, 0) + coalesce(c.n, 0) = 0 THEN 1.0
    ELSE 2.0::DOUBLE * coalesce(s.n, 0)::DOUBLE / (coalesce(a.n, 0) + coalesce(c.n, 0))::DOUBLE END AS token_similarity
  FROM v_grid g LEFT JOIN v_shared s USING (video_id, bucket) LEFT JOIN (FROM v_sizes WHERE side = 'a') a USING (video_id, bucket)
  LEFT JOIN (FROM v_sizes WHERE side = 'c') c USING (video_id, bucket)
)"""

BANDS = "CASE WHEN token_similarity >= 0.85 THEN 'HIGH' WHEN token_similarity >= 0.65 THEN 'MID' ELSE 'LOW' END"

SCORED = f"""
v_parts AS (
  SELECT *, coalesce(gap_after_ms, 0) AS gap, regexp_matches(word, '{TERMINAL}') AS term, regexp_matches(word, '{CLAUSE}') AS clause,
    lead(start_ms) OVER (PARTITION BY video_id ORDER BY word_no) IS NULL AS is_last FROM v_gaps
), v_scored AS MATERIALIZED (
  SELECT video_id, word_no, word, segment_id, start_ms, end_ms, probability,
    CASE WHEN is_last THEN 10.0 ELSE CASE WHEN term THEN 4.0 WHEN clause THEN 1.5 ELSE 0 END
      + CASE WHEN gap >= 600 THEN 4.0 WHEN gap >= 350 THEN 3.0 WHEN gap >= 200 THEN 2.0 WHEN gap >= 120 THEN 0.75 ELSE 0 END
      + CASE WHEN segment_boundary THEN 1.0 ELSE 0 END END::DOUBLE AS boundary_score,
    CASE WHEN is_last THEN 'end_of_source' ELSE coalesce(nullif(concat_ws('+', CASE WHEN term THEN 'terminal' WHEN clause THEN 'clause' END,
      CASE WHEN gap >= 600 THEN 'pause>=0.60' WHEN gap >= 350 THEN 'pause>=0.35' WHEN gap >= 200 THEN 'pause>=0.20' WHEN gap >= 120 THEN 'pause>=0.12' END,
      CASE WHEN segment_boundary THEN 'segment_boundary' END), ''), 'weak_boundary') END AS boundary_basis
  FROM v_parts
)"""

BEST = """
v_probe AS MATERIALIZED (
  SELECT video_id, word_no, start_ms, word_no + k AS e_no FROM v_scored, range(0, 64) o(k)
), v_reach AS MATERIALIZED (
  SELECT s.video_id, s.word_no, s.start_ms, s.e_no, e.end_ms - s.start_ms AS dur, e.boundary_score
  FROM v_probe s JOIN v_scored e ON e.video_id = s.video_id AND e.word_no = s.e_no WHERE e.end_ms - s.start_ms <= 16000
), v_option AS (
  SELECT video_id, word_no, e_no, (boundary_score * 16000)::BIGINT + greatest(0, 40000 - 5 * abs(dur - 8000))
    + CASE WHEN e_no - word_no + 1 >= 3 THEN 8000 ELSE -32000 END AS score, abs(dur - 8000) AS away FROM v_reach WHERE dur BETWEEN 3000 AND 14000
), v_pick AS (
  SELECT * FROM v_option QUALIFY row_number() OVER (PARTITION BY video_id, word_no ORDER BY score DESC, away, e_no) = 1
), v_inside AS (SELECT video_id, word_no, max(e_no) FILTER (dur <= 14000) AS inside, max(e_no) AS any_in FROM v_reach GROUP BY ALL
), v_best AS MATERIALIZED (
  SELECT s.video_id, s.word_no, coalesce(p.e_no, CASE WHEN i.any_in > coalesce(i.inside, s.word_no - 1) THEN coalesce(i.inside, s.word_no - 1) + 1
      ELSE greatest(coalesce(i.inside, s.word_no), s.word_no) END) AS end_no, coalesce(p.score, -16000) AS score, p.e_no IS NULL AS forced
  FROM v_scored s LEFT JOIN v_pick p USING (video_id, word_no) LEFT JOIN v_inside i USING (video_id, word_no)
)"""

SPANS = """
v_chain AS (
  SELECT video_id, 0::BIGINT AS s, 1 AS n FROM v_best WHERE word_no = 0
  UNION ALL SELECT c.video_id, b.end_no + 1, c.n + 1 FROM v_chain c JOIN v_best b ON b.video_id = c.video_id AND b.word_no = c.s
    JOIN v_best x ON x.video_id = c.video_id AND x.word_no = b.end_no + 1
), v_plain AS (
  SELECT c.video_id, c.n, c.s, b.end_no AS e, b.score, b.forced, a.start_ms, z.end_ms, max(c.n) OVER (PARTITION BY c.video_id) AS m
  FROM v_chain c JOIN v_best b ON b.video_id = c.video_id AND b.word_no = c.s JOIN v_scored a ON a.video_id = c.video_id AND a.word_no = c.s
  JOIN v_scored z ON z.video_id = c.video_id AND z.word_no = b.end_no
), v_tail AS (
  SELECT *, lead(e) OVER w AS tail_e, lead(score) OVER w AS tail_score, n = m - 1 AND lead(end_ms) OVER w - lead(start_ms) OVER w < 3000 AND lead(end_ms) OVER w - start_ms <= 16000 AS takes
  FROM v_plain WINDOW w AS (PARTITION BY video_id ORDER BY n)
), v_spans AS MATERIALIZED (
  SELECT video_id, n::INT AS clip_no, s AS first_no, CASE WHEN takes THEN tail_e ELSE e END AS last_no, CASE WHEN takes THEN greatest(score, tail_score) ELSE score END AS score,
    forced, coalesce(takes, false) AS merged, e AS basis_no
  FROM (SELECT *, lag(takes) OVER (PARTITION BY video_id ORDER BY n) AS taken FROM v_tail) WHERE NOT coalesce(taken, false)
)"""

MANIFEST = f"""
v_members AS (
  SELECT p.video_id, p.clip_no, w.* EXCLUDE (video_id) FROM v_spans p JOIN v_scored w ON w.video_id = p.video_id AND w.word_no BETWEEN p.first_no AND p.last_no
), v_glue AS (
  SELECT *, {clean("word")} AS tok FROM v_members
), v_join AS (
  SELECT *, CASE WHEN lag(tok) OVER c IS NULL OR regexp_matches(tok, '^[,.;:!?…%)\\]}}”’»]') OR regexp_matches(lag(tok) OVER c, '[(\\[{{“‘«]$') THEN '' ELSE ' ' END AS glue
  FROM v_glue WHERE tok <> '' WINDOW c AS (PARTITION BY video_id, clip_no ORDER BY word_no)
), v_text AS (SELECT video_id, clip_no, {clean("string_agg(glue || tok, '' ORDER BY word_no)")} AS text FROM v_join GROUP BY ALL
), v_facts AS (
  SELECT video_id, clip_no, arg_min(start_ms, word_no) AS raw_start_ms, arg_max(end_ms, word_no) AS raw_end_ms, count(*) AS word_count,
    round(avg(probability::DOUBLE), 9) AS mean_word_probability, round(quantile_cont(probability::DOUBLE, 0.1), 9) AS word_probability_p10 FROM v_members GROUP BY ALL
), v_sq AS (
  SELECT video_id, clip_no, median(avg_logprob::DOUBLE) AS median_segment_avg_logprob, max(no_speech_prob::DOUBLE) AS max_segment_no_speech_prob
  FROM (SELECT DISTINCT video_id, clip_no, segment_id FROM v_members) JOIN v_segments USING (video_id, segment_id) GROUP BY ALL
), v_cs AS (
  SELECT f.video_id, f.clip_no, sum(w * token_similarity) / sum(w) AS clip_consensus_mean FROM (
    SELECT f.video_id, f.clip_no, least(raw_end_ms, (c.bucket + 1) * 30000) - greatest(raw_start_ms, c.bucket * 30000) AS w, token_similarity
    FROM v_facts f JOIN v_consensus c ON c.video_id = f.video_id AND c.bucket BETWEEN raw_start_ms // 30000 AND raw_end_ms // 30000) f WHERE w > 0 GROUP BY ALL
), v_trust AS (SELECT video_id, avg(token_similarity) AS source_consensus_mean FROM v_consensus GROUP BY ALL
), v_rows AS (
  SELECT p.video_id, p.clip_no, p.video_id || '_C' || lpad(p.clip_no::VARCHAR, 6, '0') AS clip_id, p.score / 16000 AS boundary_score, coalesce(t.text, '') AS text,
    CASE WHEN p.forced THEN 'forced_max_or_short_tail' ELSE b.boundary_basis END || CASE WHEN p.merged THEN '+merged_short_tail' ELSE '' END AS boundary_basis,
    f.* EXCLUDE (video_id, clip_no), q.* EXCLUDE (video_id, clip_no), clip_consensus_mean, coalesce(source_consensus_mean >= 0.60, false) AS caption_trusted,
    CASE WHEN lag(raw_end_ms) OVER w IS NULL THEN 240 ELSE greatest(0, raw_start_ms - lag(raw_end_ms) OVER w) END AS gap_before_ms,
    CASE WHEN lead(raw_start_ms) OVER w IS NULL THEN 300 ELSE greatest(0, lead(raw_start_ms) OVER w - raw_end_ms) END AS gap_after_ms
  FROM v_spans p JOIN v_facts f USING (video_id, clip_no) JOIN v_scored b ON b.video_id = p.video_id AND b.word_no = p.basis_no LEFT JOIN v_text t USING (video_id, clip_no)
  LEFT JOIN v_sq q USING (video_id, clip_no) LEFT JOIN v_cs USING (video_id, clip_no) LEFT JOIN v_trust USING (video_id) WINDOW w AS (PARTITION BY p.video_id ORDER BY p.clip_no)
), v_flag AS (
  SELECT *, raw_end_ms - raw_start_ms AS dur, greatest(0.0, raw_start_ms - least(120.0, gap_before_ms / 2)) AS cut_start_ms, raw_end_ms + least(150.0, gap_after_ms / 2) AS cut_end_ms,
    greatest(0, least(1, (median_segment_avg_logprob + 2) / 2)) AS lp, 1 - greatest(0, least(1, max_segment_no_speech_prob)) AS ns,
    greatest(0, 1 - abs(raw_end_ms - raw_start_ms - 8000) / 8000) AS ds FROM v_rows
), v_why AS (
  SELECT *, concat_ws(';', CASE WHEN dur > 16000 THEN 'duration>absolute_max' END, CASE WHEN word_count < 2 THEN 'too_few_words' END,
      CASE WHEN mean_word_probability < 0.55 THEN 'very_low_word_probability' END, CASE WHEN max_segment_no_speech_prob > 0.65 THEN 'very_high_no_speech' END) AS drops,
    concat_ws(';', CASE WHEN dur < 3000 THEN 'short_duration' END, CASE WHEN dur > 14000 THEN 'long_duration' END, CASE WHEN word_count < 3 THEN 'few_words' END,
      CASE WHEN mean_word_probability < 0.78 THEN 'word_probability' END, CASE WHEN word_probability_p10 < 0.45 THEN 'word_probability_p10' END,
      CASE WHEN median_segment_avg_logprob < -0.90 THEN 'segment_logprob' END, CASE WHEN max_segment_no_speech_prob > 0.35 THEN 'no_speech' END,
      CASE WHEN starts_with(boundary_basis, 'forced') THEN 'forced_boundary' END, CASE WHEN caption_trusted AND clip_consensus_mean < 0.55 THEN 'caption_consensus' END) AS reviews
  FROM v_flag
), v_manifest AS MATERIALIZED (
  SELECT *, CASE WHEN drops <> '' THEN 'DROP' WHEN reviews <> '' THEN 'REVIEW' WHEN caption_trusted THEN 'KEEP_AUTO' ELSE 'KEEP_WHISPER_PRIMARY' END AS decision,
    CASE WHEN drops <> '' THEN drops WHEN reviews <> '' THEN reviews WHEN caption_trusted THEN 'whisper_confident+caption_reference_trusted'
      ELSE 'whisper_confident+caption_reference_low_trust' END AS decision_reason,
    greatest(0, least(1, CASE WHEN caption_trusted AND clip_consensus_mean IS NOT NULL
      THEN 0.45 * mean_word_probability + 0.18 * lp + 0.12 * ns + 0.15 * clip_consensus_mean + 0.10 * ds ELSE 0.58 * mean_word_probability + 0.20 * lp + 0.12 * ns + 0.10 * ds END)) AS quality_score
  FROM v_why
)"""

GRADED = """
v_graded AS MATERIALIZED (
  SELECT video_id, video_id || '_' || unit_no AS clip_id, unit_no AS clip_no, start_ms AS raw_start_ms, start_ms AS cut_start_ms, end_ms AS cut_end_ms,
    (unit_no * 31 + substr(video_id, 2)::BIGINT * 7) % 97 / 100.0 AS quality_score, unit_no * 13 % 9 AS boundary_score,
    CASE (unit_no * 7 + substr(video_id, 2)::BIGINT) % 5 WHEN 0 THEN 'KEEP_AUTO' WHEN 1 THEN 'KEEP_AUTO' WHEN 2 THEN 'KEEP_WHISPER_PRIMARY' WHEN 3 THEN 'REVIEW' ELSE 'DROP' END AS decision
  FROM v_units
)"""

U = f"{WORDS}, {CAPTIONS}, {UNITS}"
UP = f"{U}, {PIECES}"
S = f"{WORDS}, {GAPS}, {SCORED}"
M = f"{S}, {SEGMENTS}, {CAPTIONS}, {CONSENSUS}, {BEST}, {SPANS}, {MANIFEST}"


def even(source: str, k: str, reason: str, priority: int) -> str:
    """Evenly spaced ranks of a source's rows by quality."""
    ranked = f"SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY quality_score, raw_start_ms, clip_no) - 1 AS i, count(*) OVER (PARTITION BY video_id) AS n, {k} AS k FROM {source}"
    hit = "EXISTS (SELECT 1 FROM range(0, 1000) r(j) WHERE j < k AND round_even(j * (n - 1) / (k - 1), 0) = i)"
    return f"SELECT video_id, clip_id, clip_no, quality_score, raw_start_ms, {priority} AS priority, '{reason}' AS pilot_reason FROM ({ranked}) WHERE CASE WHEN n <= k THEN true WHEN k = 1 THEN i = n // 2 ELSE {hit} END"


def first(source: str, order: str, reason: str, priority: int) -> str:
    return f"SELECT video_id, clip_id, clip_no, quality_score, raw_start_ms, {priority}, '{reason}' FROM {source} QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY {order}) = 1"


def pilot(clips: str, k: str, review: str) -> str:
    kept = f"(SELECT * FROM {clips} WHERE decision IN ('KEEP_AUTO', 'KEEP_WHISPER_PRIMARY'))"
    sets = [even(kept, k, "keep_quality_spread", 0)]
    if review:
        sets.append(even(f"(SELECT * FROM {clips} WHERE decision = 'REVIEW')", review, "review_quality_spread", 1))
    sets += [
        first(kept, "cut_end_ms - cut_start_ms, quality_score, clip_no", "keep_shortest", 2),
        first(kept, "cut_end_ms - cut_start_ms DESC, quality_score, clip_no", "keep_longest", 3),
        first(kept, "boundary_score, quality_score, raw_start_ms, clip_no", "keep_weakest_boundary", 4),
        f"SELECT video_id, clip_id, clip_no, quality_score, raw_start_ms, 5, 'fill_source_quota' FROM {clips} WHERE decision <> 'DROP'",
    ]
    union = " UNION ALL ".join(f"({x})" for x in sets)
    return f"""v_once AS (SELECT * FROM ({union}) QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY priority) = 1),
    v_placed AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY priority, quality_score, raw_start_ms, clip_no) AS place FROM v_once)"""


def packed(budget: Budget) -> str:
    t, s, h, c = budget.target, budget.soft_max, budget.hard_max, budget.item_cost
    full = f"(held >= {h} OR (held >= {t} AND held + cost > {s}))"
    return f"""v_item AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY doc_no, unit_no, piece_no) AS r FROM (
      SELECT 'g' || substr(video_id, 2)::BIGINT // 50 AS video_id, substr(video_id, 2)::BIGINT AS doc_no, unit_no, piece_no, piece_id, text_exact, char_count, char_count + {c} AS cost FROM v_pieces)),
    v_walk AS (SELECT video_id, r, 1 AS pack_no, cost AS total FROM v_item WHERE r = 1
      UNION ALL SELECT i.video_id, i.r, CASE WHEN {full} THEN pack_no + 1 ELSE pack_no END, CASE WHEN {full} THEN cost ELSE held + cost END
      FROM (SELECT video_id, r, pack_no, total AS held FROM v_walk) w JOIN v_item i ON i.video_id = w.video_id AND i.r = w.r + 1),
    v_packed AS (SELECT i.*, pack_no FROM v_walk JOIN v_item i USING (video_id, r))"""


PACKED = "SELECT video_id, piece_id, pack_no FROM v_packed"

AUDIT = f"""{GRADED}, v_audit AS (
  SELECT *, CASE decision WHEN 'KEEP_AUTO' THEN 'TRUSTED_CAPTION_ALIGNMENT' ELSE 'WHISPER_PRIMARY_LOW_CAPTION_TRUST' END AS audit_route,
    CASE WHEN decision <> 'KEEP_AUTO' THEN 'REVIEW_WHISPER_PRIMARY' WHEN clip_no % 3 = 0 THEN 'ACCEPT_CAPTION_CANDIDATE' ELSE 'REVIEW_ALIGNMENT' END AS audit_decision,
    CASE WHEN decision <> 'KEEP_AUTO' THEN '' WHEN clip_no % 3 = 0 THEN 'ACCEPT_CAPTION' ELSE 'REVIEW_ALIGNMENT' END AS alignment_decision,
    CASE WHEN decision = 'KEEP_AUTO' THEN clip_no % 10 / 10.0 END AS proposal_similarity
  FROM v_graded WHERE decision IN ('KEEP_AUTO', 'KEEP_WHISPER_PRIMARY')
)"""

def spread_steps(name: str, group: str, count: int = 5) -> str:
    """{name}_picked(k, video_id, clip_id): `count` rows of an audit group, one for each target rank in turn: the nearest of a source that
    has none yet, else the nearest."""
    out = f"""{name}_rank AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY proposal_similarity, video_id, raw_start_ms, clip_id) - 1 AS i, count(*) OVER () AS n FROM v_audit WHERE audit_decision = '{group}')"""
    for k in range(count):
        before = " UNION ALL ".join(f"SELECT i, video_id FROM {name}_{j}" for j in range(k)) or "SELECT NULL, NULL WHERE false"
        out += f""", {name}_{k} AS MATERIALIZED (SELECT {k + 1} AS k, r.* FROM {name}_rank r WHERE i NOT IN (SELECT i FROM ({before}) x(i, v))
      ORDER BY video_id IN (SELECT v FROM ({before}) x(i, v)), abs(i - round_even({k} * (n - 1) / {count - 1}, 0)), i LIMIT 1)"""
    return out + f", {name}_picked AS ({' UNION ALL '.join(f'SELECT k, video_id, clip_id FROM {name}_{k}' for k in range(count))})"


VALIDATED = f"""
v_block AS (SELECT video_id || '_' || unit_no AS block_id, unit_no, text FROM v_units),
v_result AS (
  SELECT CASE WHEN unit_no % 17 = 0 THEN video_id || '_' || unit_no || '_x' ELSE video_id || '_' || unit_no END AS block_id, unit_no,
    string_agg(text_exact, ' ' ORDER BY piece_no) AS back, count(*) AS segment_count, bool_or(piece_no = 1) AND unit_no % 11 = 0 AS wrong
  FROM v_pieces WHERE NOT (unit_no % 7 = 0 AND piece_no = 1) AND unit_no % 13 <> 0 GROUP BY video_id, unit_no
), v_valid AS (
  SELECT coalesce(b.block_id, r.block_id) AS block_id, coalesce(r.segment_count, 0) AS segment_count, CASE WHEN b.block_id IS NULL THEN 'EXTRA_RESULT_BLOCK' WHEN r.block_id IS NULL THEN 'MISSING_RESULT_BLOCK'
    ELSE concat_ws(';', CASE WHEN wrong THEN 'INVALID_LABEL:0:NOT_A_LABEL' END, CASE WHEN {squeeze("r.back")} <> {squeeze("b.text")} THEN 'TEXT_COVERAGE_MISMATCH' END) END AS errors
  FROM v_block b FULL JOIN v_result r ON b.block_id = r.block_id
)"""

MARK = "[.!?…]+[\"”’''»)\\]]*"
ALIGNED = f"""
v_window AS (SELECT s.video_id, s.segment_id, string_agg(c.text, ' ' ORDER BY c.start_ms, c.end_ms, c.event_index) AS t FROM v_segments s JOIN v_captions c ON c.video_id = s.video_id
  AND c.end_ms >= s.start_ms - 6000 AND c.start_ms <= s.end_ms + 6000 GROUP BY ALL
), v_clip AS MATERIALIZED (
  SELECT video_id || '_' || segment_id AS clip_id, regexp_extract_all(lower(text), '{TOKEN}') AS w,
    list_filter(list_transform(string_split(regexp_replace(coalesce(t, ''), '({MARK})({SPACE}|$)', '\\1' || chr(1) || '\\2', 'g'), chr(1))[:-2], lambda x: {squeeze("x")}), lambda x: x <> '') AS s
  FROM v_segments LEFT JOIN v_window USING (video_id, segment_id)
), v_first AS (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM v_clip WHERE len(w) > 0
), v_run AS (SELECT *, unnest(range(1, least(6, len(s) - i + 1) + 1)) AS k FROM v_first
), v_said AS (SELECT clip_id, w, i, k, array_to_string(s[i:i + k - 1], ' ') AS proposal FROM v_run
), v_try AS MATERIALIZED (
  SELECT row_number() OVER () AS n, *, len(p) / len(w) AS r FROM (SELECT *, regexp_extract_all(lower(proposal), '{TOKEN}') AS p FROM v_said)
  WHERE len(p) > 0 AND len(p) / len(w) BETWEEN 1 - 0.35::DOUBLE AND 1 + 0.35::DOUBLE
), {matched("v_try", "n", "w", "p", "v_like")}, v_best AS (
  SELECT * FROM v_try t JOIN v_like l ON l.pid = t.n QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY ratio - 0.04::DOUBLE * abs(len(t.p) - len(w)) / len(w) DESC, i, k) = 1
)
SELECT c.clip_id, coalesce(proposal, '') AS proposal_text, coalesce(ratio, 0.0) AS proposal_similarity, r AS proposal_token_ratio, coalesce(k, 0) AS proposal_sentence_count,
  CASE WHEN ratio >= 0.90 THEN 'ACCEPT_CAPTION' ELSE 'REVIEW_ALIGNMENT' END AS alignment_decision,
  CASE WHEN len(c.s) = 0 OR len(c.w) = 0 THEN 'no_complete_caption_sentence' WHEN ratio IS NULL THEN 'no_length_compatible_complete_sentence_span'
    WHEN ratio >= 0.90 THEN 'caption_sentence_alignment_pass' ELSE 'caption_sentence_similarity_low' END AS alignment_reason
FROM v_clip c LEFT JOIN v_best USING (clip_id)"""

def near(pad: int, op: str) -> str:
    return f"FROM v_segments s JOIN v_captions c ON c.video_id = s.video_id AND c.end_ms >{op} s.start_ms - {pad} AND c.start_ms <{op} s.end_ms + {pad}"


EVENT_RUNS = f"""
v_near AS (SELECT s.video_id || '_' || segment_id AS clip_id, s.text, c.text AS said, row_number() OVER (PARTITION BY s.video_id, segment_id ORDER BY c.start_ms, c.end_ms, c.event_index) AS i
  {near(3000, "=")}
), v_next AS (SELECT clip_id, text, i, list(said) OVER (PARTITION BY clip_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS l FROM v_near
), v_runs AS (SELECT *, unnest(range(1, len(l) + 1)) AS k FROM v_next
), v_words_of AS (SELECT clip_id, i, k, trim(array_to_string(l[1:k], ' ')) AS matched, {lexical("text")} AS x FROM v_runs
), v_both AS MATERIALIZED (SELECT row_number() OVER () AS n, clip_id, i, k, matched, CASE WHEN x = '' THEN [] ELSE string_split(x, ' ') END AS w, CASE WHEN y = '' THEN [] ELSE string_split(y, ' ') END AS c
  FROM (SELECT *, {lexical("matched")} AS y FROM v_words_of)
), {matched("v_both", "n", "w", "c", "v_same")}
SELECT clip_id, ratio AS similarity, matched, k AS events FROM v_both JOIN v_same ON pid = n QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY ratio DESC, i, k) = 1"""

SUBSEQUENCE = f"""
s_text AS (SELECT s.video_id, s.segment_id, string_agg(c.text, ' ' ORDER BY c.start_ms, c.end_ms, c.event_index) AS t {near(4000, "=")} GROUP BY ALL
), s_clip AS MATERIALIZED (
  SELECT video_id || '_' || segment_id AS clip_id, regexp_extract_all(lower(text), '{TOKEN}') AS w, regexp_extract_all(lower(coalesce(t, '')), '{TOKEN}') AS c FROM v_segments LEFT JOIN s_text USING (video_id, segment_id)
), s_size AS (SELECT *, len(w) AS m, greatest(1, len(w) - greatest(4, len(w) // 4)) AS low, least(len(c), len(w) + greatest(6, floor(len(w) * 0.35::DOUBLE)::BIGINT)) AS high FROM s_clip WHERE len(w) > 0 AND len(c) > 0
), s_start AS (SELECT *, unnest(range(1, len(c) - low + 2)) AS a FROM s_size WHERE low <= high
), s_token AS (SELECT clip_id, m, low, a, unnest(range(1, least(high, len(c) - a + 1) + 1)) AS size, unnest(c[a:a + least(high, len(c) - a + 1) - 1]) AS t FROM s_start
), s_cap AS (SELECT clip_id, t, count(*) AS cap FROM (SELECT clip_id, unnest(w) AS t FROM s_size) GROUP BY ALL
), s_seen AS (SELECT s.*, row_number() OVER (PARTITION BY clip_id, a, t ORDER BY size) <= coalesce(cap, 0) AS counts FROM s_token s LEFT JOIN s_cap USING (clip_id, t)
), s_common AS (SELECT clip_id, m, low, a, size, sum(counts::INT) OVER (PARTITION BY clip_id, a ORDER BY size) AS common FROM s_seen
), s_bound AS MATERIALIZED (SELECT clip_id, a, size, 2.0::DOUBLE * common::DOUBLE / (m + size)::DOUBLE - 0.03::DOUBLE * abs(size - m) / m AS bound FROM s_common WHERE size >= low
), s_top AS MATERIALIZED (SELECT clip_id, size, a, w, c[a:a + size - 1] AS r FROM s_bound JOIN s_clip USING (clip_id) QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY bound DESC, size, a) = 1
), {matched("s_top", "clip_id", "w", "r", "s_first")}, s_limit AS MATERIALIZED (SELECT clip_id, size, a, ratio - 0.03::DOUBLE * abs(size - len(w)) / len(w) AS score FROM s_top JOIN s_first ON pid = clip_id
), s_rest AS MATERIALIZED (SELECT row_number() OVER () AS n, b.clip_id, b.size, b.a, w, c[b.a:b.a + b.size - 1] AS r FROM s_bound b JOIN s_limit l ON l.clip_id = b.clip_id JOIN s_clip c ON c.clip_id = b.clip_id
  WHERE bound > score OR (bound = score AND (b.size < l.size OR (b.size = l.size AND b.a <= l.a)))
), {matched("s_rest", "n", "w", "r", "s_same")}, s_all AS (
  SELECT clip_id, size, a, ratio, array_to_string(r, ' ') AS matched, ratio - 0.03::DOUBLE * abs(size - len(w)) / len(w) AS score FROM s_rest JOIN s_same ON pid = n
  UNION ALL SELECT clip_id, size, a, ratio, array_to_string(r, ' '), ratio - 0.03::DOUBLE * abs(size - len(w)) / len(w) FROM s_top JOIN s_first ON pid = clip_id
), s_best AS (SELECT * FROM s_all QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY score DESC, size, a) = 1)
SELECT clip_id, coalesce(ratio, 0.0) AS similarity, coalesce(matched, '') AS matched FROM s_clip LEFT JOIN s_best USING (clip_id)"""

VERDICTS = """v_verdicts AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic <> 1 THEN 'GOOD' WHEN quality <> 1 AND toxic <> 1 THEN 'BAD_TEXT'
  WHEN quality = 1 THEN 'BAD_BOUNDARY' ELSE 'BAD_BOTH' END AS verdict FROM labels)"""

INTERVALS = """v_intervals AS (SELECT user_id, event_id, event_type, value, epoch_us(ts) // 1000 AS start_ms, epoch_us(ts) // 1000 + floor(value * 1000)::BIGINT AS end_ms FROM events)"""


def overlaps(source: str, key: str, ident: str) -> str:
    return f"""SELECT {key}, prev AS prev_{ident}, {ident}, overlap_ms, overlap_ms > 250 AS severe FROM (SELECT {key}, {ident}, lag({ident}) OVER w AS prev,
      lag(end_ms) OVER w - start_ms AS overlap_ms FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY start_ms, end_ms, {ident})) WHERE overlap_ms > 50"""


def repeats(source: str, key: str, order: str) -> str:
    return f"""SELECT {key}, count_if(coalesce(norm = prev, false)) AS consecutive, round(count(DISTINCT norm) / count(*), 9) AS unique_ratio FROM (SELECT {key}, norm, lag(norm) OVER (PARTITION BY {key} ORDER BY {order}) AS prev
      FROM (SELECT {key}, {order}, {lexical('text')} AS norm FROM {source})) GROUP BY ALL"""


def quantiles(column: str) -> str:
    return ", ".join(f"round(quantile_cont({column}::DOUBLE, {p / 100}), 6) AS {column}_p{p}" for p in (50, 75, 90, 95, 99))


def hours(ms: str) -> str:
    """Milliseconds with halves at most as hours to six digits, halves up."""
    return f"((2 * ({ms}))::BIGINT * 1000000 + 3600000) // 7200000 / 1e6"


def merkle(source: str, most: int) -> str:
    """The digest of line items by ranges of 64 order keys, sixteen nodes under one, for a tree of `most` levels above the leaves at most."""
    text = "to_json([l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR, round(l_extendedprice * 100)::BIGINT::VARCHAR, round(l_quantity * 100)::BIGINT::VARCHAR, l_returnflag])"
    part = lambda first: f"sum(('0x' || substr(d, {first}, 15))::BIGINT)"
    out = f"""m_0 AS (SELECT node, n, md5(concat_ws('|', n, a, b)) AS digest FROM (SELECT node, count(*) AS n, {part(1)} AS a, {part(16)} AS b
      FROM (SELECT l_orderkey // 64 AS node, md5({text}::VARCHAR) AS d FROM {source}) GROUP BY node))"""
    for k in range(1, most + 1):
        out += f", m_{k} AS (SELECT node // 16 AS node, sum(n) AS n, md5(string_agg(node || ':' || digest, ',' ORDER BY node)) AS digest FROM m_{k - 1} GROUP BY ALL)"
    # the first level with one node is the root
    return out + " " + " UNION ALL ".join(
        f"SELECT n::BIGINT AS rows, md5(digest) AS digest, {k + 1} AS height FROM m_{k} WHERE (SELECT max(node) FROM m_{k}) = 0" + (f" AND (SELECT max(node) FROM m_{k - 1}) > 0" if k else "") for k in range(most + 1)
    )


THRESHOLDS = (-450, -300, 0, 200, 300, 400, 500, 700, 1000, 1500)
BAD = "(raw_end_ms <= raw_start_ms OR cut_end_ms <= cut_start_ms OR cut_start_ms < -0.001)"

SQL: dict[str, str] = {
    "v_words": f"WITH {WORDS} SELECT * EXCLUDE (doc_id) FROM v_words",
    "v_segments": f"WITH {WORDS}, {SEGMENTS} SELECT * EXCLUDE (doc_id) FROM v_segments",
    "v_captions": f"WITH {WORDS}, {CAPTIONS} SELECT * FROM v_captions",
    "unescaped_pages": f"""WITH {unescaped('pages', 'page_id', 'html')}
        SELECT page_id, md5(c) AS clean_md5, length(c) AS clean_chars FROM (SELECT page_id, {spaced('plain')} AS c FROM v_unescaped)""",
    "clean_text": f"SELECT doc_id, md5({clean('text')}) AS clean_md5, length({clean('text')}) AS clean_chars FROM documents",
    "lexical_tokens": f"SELECT conv_id, turn, form, CASE WHEN form = '' THEN 0 ELSE len(string_split(form, ' ')) END AS n_tokens, n_found FROM (SELECT conv_id, turn, {lexical('text')} AS form, len(regexp_extract_all(lower(text), '{TOKEN}')) AS n_found FROM conversations)",
    "entity_forms": f"SELECT conv_id, turn, {lexical('text')} AS form FROM conversations",
    "parsed_numbers": """WITH v AS (SELECT event_type, try_cast(CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN event_id % 11 = 0 THEN 'NaN' WHEN event_id % 13 = 0 THEN '' WHEN event_id % 17 = 0 THEN ' 12.5 ' WHEN event_id % 19 = 0 THEN '1e3'
      ELSE value::VARCHAR END AS DOUBLE) AS x FROM events), n AS (SELECT event_type, CASE WHEN NOT isnan(x) THEN x END AS x FROM v) SELECT event_type, count(x) AS numbers, count_if(x IS NULL) AS "none", round(sum(x), 4) AS total FROM n GROUP BY ALL""",
    "terminal_flags": f"WITH {WORDS} SELECT video_id, count_if(regexp_matches(word, '{TERMINAL}')) AS terminal, count_if(regexp_matches(word, '{CLAUSE}')) AS clause, count(*) AS words FROM v_words GROUP BY ALL",
    "piece_hints": f"""WITH {UP}, {RISKS} SELECT piece_id, needs_split_hint, tiny_hint, repeat_hint, crowding_hint FROM v_pieces JOIN v_risks USING (piece_id)""",
    "semantic_pilot": f"""WITH {UP}, {RISKS}, b AS (SELECT video_id, piece_id, lag(text_exact) OVER w AS prev_text, lead(text_exact) OVER w AS next_text,
      CASE WHEN needs_split_hint THEN 'LONG_SPLIT' WHEN tiny_hint THEN 'TINY_FRAGMENT' WHEN repeat_hint OR crowding_hint THEN 'REPEAT_OR_CROWDING'
        WHEN word_count BETWEEN 6 AND 28 AND char_count BETWEEN 25 AND 160 THEN 'NORMAL_CONTROL' END AS bucket
      FROM v_pieces JOIN v_risks USING (piece_id) WINDOW w AS (PARTITION BY video_id ORDER BY unit_no, piece_no)),
      n AS (SELECT *, row_number() OVER (PARTITION BY video_id, bucket ORDER BY md5('260103|' || piece_id), piece_id) AS bucket_place FROM b WHERE bucket IS NOT NULL)
      SELECT piece_id, bucket, bucket_place, prev_text, next_text FROM n WHERE bucket_place <= CASE bucket WHEN 'REPEAT_OR_CROWDING' THEN 2 ELSE 4 END""",
    "hms_labels": f"""WITH {WORDS}, {SEGMENTS} SELECT video_id, segment_id, printf('%02d:%02d:%02d.%03d', start_ms // 3600000, start_ms // 60000 % 60, start_ms // 1000 % 60, start_ms % 1000) AS start_label,
      printf('%02d:%02d:%02d.%03d', end_ms // 3600000, end_ms // 60000 % 60, end_ms // 1000 % 60, end_ms % 1000) AS end_label FROM v_segments""",
    "mojibake_report": "SELECT lang, sum(" + " + ".join(f"(length(text) - length(replace(text, '{m}', ''))) // {len(m)}" for m in ("Ã", "Â", "Ä", "Æ", "á»", "áº", "â€", "ðŸ", "�")) + ") AS markers, count_if(regexp_matches(text, '[ăâđêôơư]')) AS native FROM documents GROUP BY ALL",
    "output_verification": "SELECT l_returnflag, count_if(ok) AS verified, count_if(NOT ok) AS failed FROM (SELECT l_returnflag, abs((l_quantity + l_discount * 5) - l_quantity) <= 0.35 AND l_linenumber % 4 <> 0 AND l_partkey % 5 <> 0 AS ok FROM lineitem) GROUP BY ALL",
    "task_estimates": f"WITH {WORDS}, {CAPTIONS.replace('% 13 <> 12', '% 13 <> 12 AND word_index // 7 % 10 <> 9')}, {UNITS} SELECT video_id, unit_no, round((end_ms - start_ms) / 1000.0, 3) AS unit_duration_sec, last_event_index - first_event_index + 1 AS events_in_unit, n_events, greatest(1, round_even((end_ms - start_ms) / 8000.0, 0)::INT) AS target_segments FROM v_units",
    "word_gaps": f"WITH {WORDS}, {GAPS} SELECT video_id, word_index, gap_before_ms, gap_after_ms, gap_global_ms, segment_boundary, cross_segment FROM v_gaps",
    "pause_percent_rank": f"""WITH {WORDS}, {GAPS} SELECT video_id, word_index, CASE WHEN gap_global_ms IS NOT NULL AND n >= 5 THEN round((r + (c - 1) / 2) / n, 9) END AS pause_percentile FROM (
      SELECT *, rank() OVER (PARTITION BY video_id ORDER BY gap_global_ms NULLS LAST) AS r, count(*) OVER (PARTITION BY video_id, gap_global_ms) AS c, count(gap_global_ms) OVER (PARTITION BY video_id) AS n FROM v_gaps)""",
    "event_gaps": f"WITH {WORDS}, {CAPTIONS} SELECT video_id, event_index, lead(start_ms) OVER (PARTITION BY video_id ORDER BY start_ms, event_index) - end_ms AS gap_after_ms FROM v_captions",
    "gap_histogram": f"WITH {WORDS}, {CAPTIONS}, g AS (SELECT lead(start_ms) OVER (PARTITION BY video_id ORDER BY start_ms, event_index) - end_ms AS g FROM v_captions) SELECT "
    + ", ".join(f'count_if(g >= {t}) AS "ge_{t}"' for t in THRESHOLDS) + " FROM g",
    "overlap_audit": f"WITH {WORDS}, {CAPTIONS} {overlaps('v_captions', 'video_id', 'event_index')}",
    "user_overlaps": f"WITH {INTERVALS} {overlaps('v_intervals', 'user_id', 'event_id')}",
    "consecutive_dups": repeats("conversations", "conv_id", "turn"),
    "caption_repeats": f"WITH {WORDS}, {CAPTIONS} {repeats('v_captions', 'video_id', 'event_index')}",
    "long_pauses": f"WITH {WORDS}, {GAPS} SELECT video_id, word_index, gap_after_ms FROM v_gaps WHERE gap_after_ms >= 300 ORDER BY gap_after_ms DESC, video_id, word_index",
    "interval_overlaps": f"""WITH {INTERVALS}, o AS (SELECT user_id, lag(event_id) OVER w AS prev_clip_id, event_id AS clip_id, lag(end_ms) OVER w - start_ms AS raw_overlap_ms,
      lag(end_ms) OVER w + 150 - (start_ms - 120) AS cut_overlap_ms FROM v_intervals WINDOW w AS (PARTITION BY user_id ORDER BY start_ms, end_ms, event_id))
      SELECT *, raw_overlap_ms > 250 AS severe_raw, cut_overlap_ms > 250 AS severe_cut FROM o WHERE raw_overlap_ms > 50 OR cut_overlap_ms > 50""",
    "sentence_units": f"WITH {U} SELECT * FROM v_units",
    "lossless_pieces": f"WITH {UP} SELECT * FROM v_pieces",
    "coverage_check": f"""WITH {UP}, b AS (SELECT video_id, unit_no, string_agg(text_exact, ' ' ORDER BY piece_no) AS back FROM v_pieces GROUP BY ALL)
      SELECT video_id, count(*) AS parents, count_if({squeeze('text')} = {squeeze("coalesce(back, '')")}) AS covered FROM v_units LEFT JOIN b USING (video_id, unit_no) GROUP BY ALL""",
    "caption_qc_summary": f"WITH {U}, u AS (SELECT *, end_ms - start_ms AS dur, length(text) AS chars FROM v_units) SELECT count(*) AS units, count(DISTINCT video_id) AS sources, count_if(NOT terminated) AS open_tails, {quantiles('dur')}, {quantiles('chars')}, "
    + ", ".join([*(f"count_if(chars > {t}) AS chars_gt_{t}" for t in (300, 500, 800, 1200)), *(f"count_if(dur > {t * 1000}) AS dur_gt_{t}" for t in (15, 25, 40))]) + " FROM u",
    "lineitem_quantiles": " UNION ALL ".join(
        f"SELECT '{c}' AS name, {p}::DOUBLE AS share, round(quantile_cont({c}::DOUBLE, {p}), 6) AS value FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_orderkey") for p in (0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0)
    ),
    "long_interval_join": f"""WITH {INTERVALS}, l AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN start_ms + (end_ms - start_ms) * 10000 ELSE end_ms END AS to_ms FROM v_intervals)
      SELECT l.user_id, l.event_id, count(*) AS events, min(s.event_id) AS first_event, max(s.event_id) AS last_event FROM l JOIN v_intervals s ON s.user_id = l.user_id AND s.end_ms >= l.start_ms - 3000 AND s.start_ms <= l.to_ms + 3000 GROUP BY ALL""",
    "table_digest": f"WITH {merkle('lineitem', 5)}",
    "changed_ranges": """WITH c AS (SELECT l_orderkey // 64 AS node, count(*) AS rows_a, sum(CASE WHEN l_orderkey % 7001 = 11 THEN 0 WHEN l_orderkey % 9001 = 13 THEN 2 ELSE 1 END)::BIGINT AS rows_b,
        bool_or((l_orderkey % 5003 = 7 AND l_linenumber = 1) OR l_orderkey % 7001 = 11 OR l_orderkey % 9001 = 13) AS differs FROM lineitem GROUP BY ALL)
      SELECT node * 64 AS first_key, node * 64 + 63 AS last_key, rows_a, rows_b FROM c WHERE differs""",
    "top_long_units": f"WITH {U} SELECT video_id, unit_no, length(text) AS chars, end_ms - start_ms AS dur_ms FROM v_units ORDER BY chars DESC, dur_ms DESC, video_id, unit_no LIMIT 200",
    "near_events": f"WITH {WORDS}, {SEGMENTS}, {CAPTIONS} SELECT s.video_id, s.segment_id, count(*) AS events, min(event_index) AS first_event, max(event_index) AS last_event {near(3000, '=')} GROUP BY ALL",
    "overlap_text": f"WITH {WORDS}, {SEGMENTS}, {CAPTIONS} SELECT s.video_id, s.segment_id, string_agg(c.text, ' ' ORDER BY c.start_ms, c.event_index) AS caption_text {near(0, '')} GROUP BY ALL",
    "overlap_weighted_mean": f"""WITH RECURSIVE {U}, {SEGMENTS}, {CONSENSUS} SELECT unit_id, round(sum(w * token_similarity) / sum(w), 6) AS consensus FROM (SELECT u.video_id || '_' || unit_no AS unit_id, token_similarity,
      least(end_ms, (bucket + 1) * 30000) - greatest(start_ms, bucket * 30000) AS w FROM v_units u JOIN v_consensus c ON c.video_id = u.video_id AND bucket BETWEEN start_ms // 30000 AND end_ms // 30000) WHERE w > 0 GROUP BY ALL""",
    "segment_quality": f"""WITH {WORDS}, {SEGMENTS} SELECT clip_id, median(avg_logprob::DOUBLE) AS median_segment_avg_logprob, max(no_speech_prob::DOUBLE) AS max_segment_no_speech_prob
      FROM (SELECT DISTINCT video_id, video_id || '_' || (word_index // 33) AS clip_id, segment_id FROM v_words) JOIN v_segments USING (video_id, segment_id) GROUP BY ALL""",
    "missing_extra_keys": "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'extra' END AS side FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL",
    "one_to_one_audit": "SELECT c_nationkey AS n_nationkey, count(*) AS customers, any_value(n_name) AS n_name FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
    "aligned_union": "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer",
    "bucket_pairs": f"""WITH {WORDS}, {SEGMENTS}, {CAPTIONS}, a AS (SELECT video_id, (start_ms + end_ms) // 60000 AS bucket, string_agg(text, ' ' ORDER BY segment_id) AS asr_text FROM v_segments GROUP BY ALL),
      c AS (SELECT video_id, (start_ms + end_ms) // 60000 AS bucket, string_agg(text, ' ' ORDER BY event_index) AS caption_text FROM v_captions GROUP BY ALL) SELECT * FROM a JOIN c USING (video_id, bucket)""",
    "quick_ratio_buckets": f"WITH {WORDS}, {SEGMENTS}, {CAPTIONS}, {BOUND} SELECT video_id, bucket, round(token_similarity, 9) AS similarity, {BANDS} AS match_band FROM v_bound",
    "bucket_consensus": f"WITH RECURSIVE {WORDS}, {SEGMENTS}, {CAPTIONS}, {CONSENSUS} SELECT video_id, bucket, token_similarity, {BANDS} AS match_band FROM v_consensus",
    "highest_20_buckets": f"WITH RECURSIVE {WORDS}, {SEGMENTS}, {CAPTIONS}, {CONSENSUS} SELECT video_id, bucket, round(token_similarity, 9) AS similarity FROM v_consensus ORDER BY similarity DESC, video_id, bucket LIMIT 20",
    "density_flags": f"""WITH {WORDS}, {SEGMENTS}, {CAPTIONS}, t AS (SELECT s.video_id, s.segment_id, string_agg(c.text, ' ' ORDER BY c.start_ms, c.event_index) AS t {near(0, '')} GROUP BY ALL),
      n AS (SELECT video_id, segment_id, (end_ms - start_ms) / 1000.0::DOUBLE AS sec, len(regexp_extract_all(lower(text), '{TOKEN}')) AS w, coalesce(len(regexp_extract_all(lower(t), '{TOKEN}')), 0) AS c FROM v_segments LEFT JOIN t USING (video_id, segment_id)),
      r AS (SELECT video_id, segment_id, w / nullif(sec, 0) AS x, c / nullif(w, 0) AS y FROM n)
      SELECT video_id, segment_id, round(x, 6) AS tokens_per_sec, round(y, 6) AS token_ratio, coalesce(x < 0.8, false) AS low_density, coalesce(y > 1.8, false) AS high_ratio FROM r""",
    "lowest_20_buckets": f"WITH RECURSIVE {WORDS}, {SEGMENTS}, {CAPTIONS}, {CONSENSUS} SELECT video_id, bucket, round(token_similarity, 9) AS similarity FROM v_consensus ORDER BY similarity, video_id, bucket LIMIT 20",
    "source_trust": f"WITH RECURSIVE {WORDS}, {SEGMENTS}, {CAPTIONS}, {CONSENSUS} SELECT video_id, round(avg(token_similarity), 6) AS mean_similarity, round(avg(token_similarity), 6) >= 0.60 AS trusted FROM v_consensus GROUP BY ALL",
    "boundary_scores": f"WITH {S} SELECT video_id, word_no, boundary_score, boundary_basis FROM v_scored",
    "best_end": f"WITH {S}, {BEST} SELECT * FROM v_best",
    "clip_spans": f"WITH RECURSIVE {S}, {BEST}, {SPANS} SELECT * FROM v_spans",
    "clip_spans_linked": f"WITH RECURSIVE {S}, {BEST}, {SPANS} SELECT * FROM v_spans",
    "clip_candidates": f"""WITH RECURSIVE {M} SELECT clip_id, raw_start_ms, raw_end_ms, cut_start_ms, cut_end_ms, word_count, text, boundary_basis, boundary_score, gap_before_ms, gap_after_ms,
      round(mean_word_probability, 6) AS mean_word_probability, round(word_probability_p10, 6) AS word_probability_p10, round(median_segment_avg_logprob, 6) AS median_segment_avg_logprob,
      round(max_segment_no_speech_prob, 6) AS max_segment_no_speech_prob, round(clip_consensus_mean, 6) AS clip_consensus_mean, decision, decision_reason, round(round_even(quality_score, 6) + 1e-7, 4) AS quality_score FROM v_manifest""",
    "decision_summary": f"WITH RECURSIVE {M} SELECT video_id, decision, count(*) AS clips, {hours('sum(cut_end_ms - cut_start_ms)')} AS hours, sum(word_count) AS words FROM v_manifest GROUP BY ALL",
    "suspicious_keep": f"""WITH RECURSIVE {M}, a AS (SELECT * REPLACE (mean_word_probability - CASE WHEN right(clip_id, 1) IN ('3', '7') THEN 0.3 ELSE 0 END AS mean_word_probability) FROM v_manifest)
      SELECT clip_id, decision, word_count, raw_start_ms, raw_end_ms FROM a WHERE decision LIKE 'KEEP%' AND (dur < 3000 OR dur > 14000 OR word_count < 3 OR mean_word_probability < 0.78 OR word_probability_p10 < 0.45
      OR max_segment_no_speech_prob > 0.35 OR median_segment_avg_logprob < -0.90)""",
    "structural_qc": f"""WITH RECURSIVE {M}, f AS (SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT clip_id FROM v_manifest WHERE clip_id IS NOT NULL GROUP BY clip_id HAVING count(*) > 1)) AS duplicate_ids, 0 AS unknown_decisions, count_if({BAD} AND decision <> 'DROP') AS invalid_active,
      count_if({BAD} AND decision = 'DROP') AS invalid_drop, count_if(trim(text) = '') AS empty_text FROM v_manifest),
      m AS (SELECT count(*) AS missing_sources FROM (SELECT DISTINCT 'd' || doc_id AS v FROM documents) WHERE v NOT IN (SELECT video_id FROM v_manifest)),
      o AS (SELECT count(*) AS overlaps, coalesce(count_if(x > 250), 0) AS severe_overlaps FROM (SELECT lag(raw_end_ms) OVER (PARTITION BY video_id ORDER BY raw_start_ms, raw_end_ms, clip_id) - raw_start_ms AS x FROM v_manifest) WHERE x > 50),
      r AS (SELECT *, 0 AS extra_sources FROM f, m, o), e AS (SELECT *, concat_ws(';', CASE WHEN duplicate_ids > 0 THEN 'DUPLICATE_IDS' END, CASE WHEN invalid_active > 0 THEN 'INVALID_ACTIVE' END,
        CASE WHEN empty_text > 0 THEN 'EMPTY_TEXT' END, CASE WHEN missing_sources > 0 THEN 'MISSING_SOURCES' END, CASE WHEN severe_overlaps > 0 THEN 'SEVERE_OVERLAPS' END) AS errors FROM r) SELECT *, errors = '' AS qc_pass FROM e""",
    "invalid_intervals": f"WITH {INTERVALS} SELECT event_type, count(*) AS rows, count_if(end_ms <= start_ms) AS invalid, count_if(abs(value * 1000 - (end_ms - start_ms)) > 0.5) AS mismatched FROM v_intervals GROUP BY ALL",
    "duplicate_texts": "SELECT doc_id, md5(text) AS digest FROM documents QUALIFY count(*) OVER (PARTITION BY md5(text)) > 1",
    "source_qc_quantiles": f"""WITH RECURSIVE {M}, k AS (SELECT *, decision LIKE 'KEEP%' AS kept, round_even(quality_score, 6) AS q FROM v_manifest) SELECT video_id, count(*) AS candidates, count_if(decision = 'KEEP_AUTO') AS keep_auto,
      count_if(decision = 'KEEP_WHISPER_PRIMARY') AS keep_whisper_primary, count_if(decision = 'REVIEW') AS review, count_if(decision = 'DROP') AS drop, {hours('coalesce(sum(cut_end_ms - cut_start_ms) FILTER (kept), 0)')} AS keep_hours,
      round(quantile_cont(q, 0.1) FILTER (kept), 6) AS keep_quality_p10, round(quantile_cont(q, 0.5) FILTER (kept), 6) AS keep_quality_p50 FROM k GROUP BY ALL""",
    "balanced_pilot": f"WITH {U}, {GRADED}, {pilot('v_graded', '5', '2')} SELECT video_id, clip_id, pilot_reason, place FROM v_placed WHERE place <= 10",
    "listening_queue": f"""WITH {U}, {GRADED}, {pilot('v_graded', '5', '2')}, q AS (SELECT p.*, decision FROM v_placed p JOIN v_graded g USING (video_id, clip_id) WHERE place <= 10),
      o AS (SELECT *, CASE WHEN decision = 'REVIEW' THEN 0 WHEN pilot_reason = 'keep_weakest_boundary' THEN 1 WHEN pilot_reason = 'keep_shortest' THEN 2 WHEN pilot_reason = 'keep_longest' THEN 3
        WHEN decision = 'KEEP_WHISPER_PRIMARY' THEN 4 ELSE 5 END AS review_priority FROM q)
      SELECT row_number() OVER (ORDER BY review_priority, video_id, place) - 1 AS queue_no, review_priority, clip_id, pilot_reason FROM o""",
    "review_queue": f"WITH {U}, {GRADED} SELECT row_number() OVER (ORDER BY quality_score, raw_start_ms, clip_id) - 1 AS queue_no, clip_id, quality_score FROM v_graded WHERE decision = 'REVIEW'",
    "queue_page": f"""WITH {U}, {GRADED} SELECT row_number() OVER (ORDER BY quality_score, raw_start_ms, clip_id) - 1 AS queue_no, clip_id, quality_score FROM v_graded WHERE decision = 'REVIEW'
      ORDER BY queue_no LIMIT 50 OFFSET 20""",
    "balanced_counts": "SELECT n_regionkey, count(*) AS rows FROM nation GROUP BY ALL",
    "first_values": f"""WITH {U} SELECT video_id, arg_min(n_events, unit_no) FILTER (unit_no % 3 = 0) AS n_events, arg_min(end_ms, unit_no) FILTER (terminated) AS end_ms FROM v_units GROUP BY ALL""",
    "quota_pilot": f"""WITH {U}, {GRADED}, v_auto AS (SELECT * FROM v_graded WHERE decision = 'KEEP_AUTO'), v_quota AS (SELECT video_id, 160 // count(*) OVER () + (row_number() OVER (ORDER BY video_id) - 1 < 160 % count(*) OVER ())::INT AS quota
      FROM (SELECT DISTINCT video_id FROM v_auto)), {pilot('v_auto', '160', '')} SELECT video_id, clip_id, pilot_reason, place FROM v_placed JOIN v_quota USING (video_id) WHERE place <= quota""",
    "keep_auto_queue": f"""WITH {U}, {GRADED}, v_auto AS (SELECT * FROM v_graded WHERE decision = 'KEEP_AUTO'), v_quota AS (SELECT video_id, 160 // count(*) OVER () + (row_number() OVER (ORDER BY video_id) - 1 < 160 % count(*) OVER ())::INT AS quota
      FROM (SELECT DISTINCT video_id FROM v_auto)), {pilot('v_auto', '160', '')}, q AS (SELECT *, coalesce(list_position(['keep_quality_spread', 'keep_weakest_boundary', 'keep_shortest', 'keep_longest'], pilot_reason), 5) - 1 AS review_priority
      FROM v_placed JOIN v_quota USING (video_id) WHERE place <= quota) SELECT row_number() OVER (ORDER BY review_priority, video_id, place) - 1 AS queue_no, review_priority, clip_id, pilot_reason FROM q""",
    "group_sample": f"WITH {U}, {AUDIT}, {spread_steps('a', 'ACCEPT_CAPTION_CANDIDATE')}, {spread_steps('b', 'REVIEW_ALIGNMENT')}, "
    + """w AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY quality_score, raw_start_ms, clip_no) - 1 AS i, count(*) OVER (PARTITION BY video_id) AS n, dense_rank() OVER (ORDER BY video_id) AS d FROM v_audit WHERE audit_decision = 'REVIEW_WHISPER_PRIMARY')
      SELECT 'ACCEPT_CAPTION_CANDIDATE' AS audit_group, k AS sample_order, video_id, clip_id FROM a_picked UNION ALL SELECT 'REVIEW_ALIGNMENT', k + 5, video_id, clip_id FROM b_picked
      UNION ALL SELECT 'REVIEW_WHISPER_PRIMARY', d + 10, video_id, clip_id FROM w WHERE d <= 5 AND i = n // 2""",
    "middle_pick": f"WITH {U}, {GRADED} SELECT video_id, clip_id FROM v_graded QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY quality_score, raw_start_ms, clip_no) - 1 = count(*) OVER (PARTITION BY video_id) // 2",
    "review_parts": f"WITH RECURSIVE {UP}, {packed(REVIEW_PARTS)} {PACKED}",
    "semantic_tasks": f"WITH RECURSIVE {UP}, {packed(TASKS_V2)} {PACKED}",
    "semantic_tasks_v1": f"WITH RECURSIVE {UP}, {packed(TASKS_V1)} {PACKED}",
    "review_packs": f"WITH RECURSIVE {UP}, {packed(REVIEW_PACKS)} {PACKED}",
    "review_packs_linked": f"WITH RECURSIVE {UP}, {packed(REVIEW_PACKS)} {PACKED}",
    "pack_index": f"""WITH RECURSIVE {UP}, {packed(REVIEW_PACKS)}, g AS (SELECT video_id, pack_no, count(*) AS item_count, sum(char_count)::BIGINT AS source_text_chars, arg_min(piece_id, r) AS first_item_id,
      arg_max(piece_id, r) AS last_item_id FROM v_packed GROUP BY ALL) SELECT *, 'review_pack_' || lpad((row_number() OVER (ORDER BY video_id, pack_no))::VARCHAR, 4, '0') AS pack_id FROM g""",
    "review_bodies": f"""WITH RECURSIVE {UP}, {packed(REVIEW_PARTS)}, l AS (SELECT video_id, pack_no, list(text_exact ORDER BY r) AS t FROM v_packed GROUP BY ALL),
      b AS (SELECT *, lag(t) OVER (PARTITION BY video_id ORDER BY pack_no) AS p FROM l), j AS (SELECT video_id, pack_no, array_to_string(list_concat(['# ' || video_id || ' part ' || pack_no],
        list_transform(coalesce(p, [])[-3:], lambda x: '~ ' || x), list_transform(t, lambda x, i: lpad(i::VARCHAR, 4, '0') || '  ' || x)), chr(10)) AS body FROM b)
      SELECT video_id, pack_no, length(body) AS chars, md5(body) AS digest FROM j""",
    "context_windows": f"""WITH {UP} SELECT piece_id, coalesce(string_agg(piece_id, ',') OVER (w ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), '') AS prev_context,
      coalesce(string_agg(piece_id, ',') OVER (w ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), '') AS next_context FROM v_pieces WINDOW w AS (PARTITION BY video_id ORDER BY unit_no, piece_no)""",
    "reviewed_verdicts": f"WITH {VERDICTS} SELECT verdict, count(*) AS n FROM documents JOIN v_verdicts USING (doc_id) GROUP BY ALL",
    "suffix_join": f"WITH {VERDICTS} SELECT doc_id, n_chars AS size_text, lang, length(verdict) AS size_verdict, verdict FROM documents LEFT JOIN v_verdicts USING (doc_id)",
    "verdict_flags": "SELECT doc_id, concat_ws(',', CASE WHEN n_chars % 7 = 0 THEN 'clipped_end' END, CASE WHEN n_chars % 3 = 0 THEN 'clipped_start' END, CASE WHEN n_chars % 2 = 0 THEN 'noise_or_music' END) AS flags FROM documents",
    "acceptance_rate": f"""WITH {U}, {AUDIT}, r AS (SELECT video_id, count(*) AS rows, count_if(audit_decision = 'ACCEPT_CAPTION_CANDIDATE') AS accepted FROM v_audit WHERE decision = 'KEEP_AUTO' GROUP BY ROLLUP (video_id))
      SELECT coalesce(video_id, '(all)') AS video_id, rows, accepted, CASE WHEN rows = 0 THEN 0.0 ELSE round(accepted / rows, 6) END AS acceptance_rate FROM r""",
    "display_text": f"WITH {U} SELECT video_id, unit_no, CASE WHEN unit_no % 2 = 1 THEN text WHEN unit_no % 6 = 0 THEN '' ELSE reverse(text) END AS display_text FROM v_units",
    "source_audit": """SELECT 'd' || doc_id AS video_id, CASE WHEN doc_id % 7 = 3 THEN 'EXTRACT_FAIL' ELSE 'OK' END AS status, CASE WHEN doc_id % 7 <> 3 THEN source END AS title, CASE WHEN doc_id % 7 <> 3 THEN n_chars / 2 END AS duration_sec,
      CASE WHEN doc_id % 7 = 3 THEN NULL WHEN doc_id % 5 IN (0, 1) THEN 'MANUAL_VI' WHEN doc_id % 5 = 2 THEN 'AUTO_VI' ELSE 'NEED_ASR' END AS candidate, CASE WHEN doc_id % 7 = 3 THEN 'timed out' END AS error FROM documents""",
    "item_validation": f"""WITH {UP}, s AS (SELECT video_id, unit_no, piece_no, unit_no % 7 = 0 AND piece_no = 2 AS lost, CASE WHEN unit_no % 5 = 0 AND piece_no = 1 THEN '' ELSE text_exact END AS t, unit_no % 11 = 0 AND piece_no = 1 AS wrong FROM v_pieces WHERE unit_no % 13 <> 0),
      r AS (SELECT video_id || '_' || unit_no AS id, string_agg(t, ' ' ORDER BY piece_no) FILTER (NOT lost) AS back, string_agg(CASE WHEN lost THEN 'SEGMENT_' || piece_no - 1 || '_NOT_OBJECT'
        ELSE nullif(concat_ws(';', CASE WHEN t = '' THEN 'SEGMENT_' || piece_no - 1 || '_EMPTY_TEXT' END, CASE WHEN wrong THEN 'SEGMENT_' || piece_no - 1 || '_INVALID_LABEL:NOT_A_LABEL' END), '') END, ';' ORDER BY piece_no) AS each FROM s GROUP BY ALL),
      e AS (SELECT u.video_id || '_' || u.unit_no AS pilot_id, concat_ws(';', CASE WHEN r.id IS NULL OR u.unit_no % 17 = 0 THEN 'PILOT_ID_MISMATCH' END, CASE WHEN r.id IS NULL THEN 'NO_SEGMENTS' END, each,
        CASE WHEN {squeeze("coalesce(back, '')")} <> {squeeze("u.text")} AND r.id IS NOT NULL THEN 'TEXT_COVERAGE_MISMATCH' END) AS errors FROM v_units u LEFT JOIN r ON r.id = u.video_id || '_' || u.unit_no WHERE u.unit_no % 19 <> 0)
      SELECT pilot_id, errors, CASE WHEN errors <> '' THEN 'Correct these errors: ' || replace(errors, ';', ', ') END AS feedback FROM e""",
    "caption_scan": f"""WITH {WORDS}, {CAPTIONS}, n AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY event_index) AS k FROM v_captions) SELECT video_id, 2 * k - 1 AS event_index, start_ms / 1000 AS start_sec, end_ms / 1000 AS end_sec,
      round((end_ms - start_ms) / 1000, 3) AS duration_sec, {clean('text')} AS text, regexp_matches({clean('text')}, '{TERMINAL}') AS ends_terminal_punctuation FROM n""",
    "csv_round_trip": "SELECT doc_id, lang, md5(text) AS digest FROM documents",
    "csv_rescue": """WITH l AS (SELECT *, CASE WHEN doc_id % 17 = 0 THEN 'x' ELSE '' END || doc_id AS ident, doc_id % 17 = 0 OR doc_id % 23 = 5 OR doc_id % 19 = 3 AS bad FROM documents)
      SELECT CASE WHEN NOT bad THEN doc_id END AS doc_id, CASE WHEN NOT bad THEN lang END AS lang, CASE WHEN NOT bad THEN n_chars END AS n_chars, CASE WHEN bad THEN CASE WHEN doc_id % 23 = 5 THEN ident
        ELSE concat_ws(',', ident, lang, n_chars, CASE WHEN doc_id % 19 = 3 THEN 'more' END) END END AS rescued FROM l""",
    "caption_rescue": f"""WITH {WORDS}, {CAPTIONS}, e AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY event_index) - 1 AS k, substr(video_id, 2)::BIGINT AS n FROM v_captions),
      r AS (SELECT *, CASE WHEN event_index % 9 = 4 THEN 'BAD_START' WHEN event_index % 10 = 6 THEN 'BAD_SEGMENTS' ELSE '' END AS reason FROM e)
      SELECT video_id, k AS event_index, reason, CASE WHEN reason = '' THEN start_ms / 1000 END AS start_sec, CASE WHEN reason = '' THEN {clean('text')} END AS text FROM r WHERE n % 13 <> 2 AND n % 11 <> 1 AND (reason <> '' OR {clean('text')} <> '')
      UNION ALL SELECT DISTINCT video_id, NULL, CASE WHEN n % 11 = 1 THEN 'NOT_JSON' ELSE 'NO_EVENTS' END, NULL::DOUBLE, NULL FROM r WHERE n % 13 = 2 OR n % 11 = 1""",
    "json_round_trip": "SELECT n_nationkey::VARCHAR AS task_id, n_name, n_regionkey FROM nation",
    "first_file_scan": "SELECT DISTINCT 'n_regionkey=' || n_regionkey AS folder, '.parquet' AS suffix FROM nation",
    "by_source_sink": f"WITH {U} SELECT video_id, unit_no, start_ms, end_ms, text FROM v_units",
    "summary_sink": f"WITH {WORDS}, {CAPTIONS}, g AS (SELECT lead(start_ms) OVER (PARTITION BY video_id ORDER BY start_ms, event_index) - end_ms AS g FROM v_captions) SELECT "
    + ", ".join(f'count_if(g >= {t}) AS "ge_{t}"' for t in THRESHOLDS) + " FROM g",
    "failure_isolation": "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN '' ELSE 'negative balance of customer ' || c_custkey END AS error FROM customer",
    "failed_run_counts": """WITH e AS (SELECT event_type, value, (props->>'k')::BIGINT AS k FROM events), o AS (SELECT *, CASE WHEN event_type = 'error' AND k > 90 THEN 'LookupError' WHEN k % 20 = 0 THEN 'ZeroDivisionError' ELSE '' END AS error_type FROM e)
      SELECT error_type, CASE WHEN error_type = 'LookupError' THEN 'no rate for ' || k ELSE '' END AS error, count(*) AS n, sum(CASE WHEN error_type = '' THEN round(value * 100)::BIGINT // (k % 20) ELSE 0 END)::BIGINT AS total FROM o GROUP BY ALL
      UNION ALL SELECT 'FailedRows', count_if(error_type <> '') || ' of ' || count(*), count_if(error_type <> ''), 0 FROM o""",
    "resumed_stage": f"WITH {U} SELECT video_id, count(*) AS units, sum(length(text))::BIGINT AS chars, substr(video_id, 2)::BIGINT % 3 + 1 AS version FROM v_units GROUP BY ALL",
    "event_run_match": f"WITH RECURSIVE {WORDS}, {SEGMENTS}, {CAPTIONS}, {EVENT_RUNS}",
    "token_subsequence": f"WITH RECURSIVE {WORDS}, {SEGMENTS}, {CAPTIONS}, {SUBSEQUENCE}",
    "sentence_alignment": f"""WITH RECURSIVE {WORDS}, {SEGMENTS}, {CAPTIONS}, {ALIGNED}""",
    "verdict_stats": f"""WITH {VERDICTS}, s AS (SELECT verdict, (n_chars % 100) / 100.0::DOUBLE AS x FROM v_verdicts JOIN documents USING (doc_id)) SELECT verdict, count(*) AS n, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.1), 6) AS p10,
      round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.9), 6) AS p90, count_if(x < 0.85) AS below_85 FROM s GROUP BY ALL""",
    "progress_rollup": f"""WITH {VERDICTS} SELECT coalesce(lang, '(all)') AS lang, count(*) AS total, count(verdict) AS reviewed, count_if(verdict = 'GOOD') AS good, count_if(verdict = 'BAD_TEXT') AS bad_text, count_if(verdict = 'BAD_BOUNDARY') AS bad_boundary,
      count_if(verdict = 'BAD_BOTH') AS bad_both, count(*) - count(verdict) AS remaining FROM documents LEFT JOIN v_verdicts USING (doc_id) GROUP BY ROLLUP (lang)""",
    "keep_audit": f"WITH {U}, {AUDIT} SELECT clip_id, audit_route, audit_decision, alignment_decision, proposal_similarity FROM v_audit",
    "audit_rollup": f"WITH {U}, {AUDIT} SELECT video_id, decision, audit_route, audit_decision, count(*) AS clips FROM v_audit GROUP BY ALL",
    "validate_results": f"WITH {UP}, {VALIDATED} SELECT * FROM v_valid",
    "readiness": f"WITH {UP}, {VALIDATED} SELECT count(*) AS blocks, count_if(errors <> '') AS bad_blocks, count(*) > 0 AND count_if(errors <> '') = 0 AS ready FROM v_valid",
    "streamed_units": """WITH e AS (SELECT user_id AS source, event_id, epoch_us(ts) // 1000 AS ms, round(value * 100)::BIGINT AS amount, event_type = 'purchase' AS ends FROM events),
      b AS (SELECT *, coalesce(lag(ends) OVER w OR ms - lag(ms) OVER w > 3600000, true) AS opens FROM e WINDOW w AS (PARTITION BY source ORDER BY ms, event_id)),
      u AS (SELECT *, sum(opens::INT) OVER (PARTITION BY source ORDER BY ms, event_id)::BIGINT AS unit_no FROM b),
      g AS (SELECT source, unit_no, arg_min(event_id, (ms, event_id)) AS first_event, arg_max(event_id, (ms, event_id)) AS last_event, count(*) AS n_events, sum(amount)::BIGINT AS amount, max(ms) AS end_ms, bool_or(ends) AS ended FROM u GROUP BY ALL)
      SELECT * EXCLUDE (ended), CASE WHEN ended THEN 'end' ELSE 'pause' END AS closed_by FROM g
      WHERE ended OR unit_no < (SELECT max(unit_no) FROM g o WHERE o.source = g.source) OR end_ms + 3600000 < (SELECT max(ms) FROM e)""",
    "manifest_digest": f"WITH {U} SELECT video_id, md5(string_agg(md5(concat_ws('|', unit_no, start_ms, end_ms, text)), '' ORDER BY unit_no)) AS digest, count(*) AS rows FROM v_units GROUP BY ALL",
}
