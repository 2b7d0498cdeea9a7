"""DuckDB SQL that states the results of the queries which SQL can express."""

from __future__ import annotations

from starmill.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

QUALITY_RULES = f"""
WITH base AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
    FROM base, unnest(range(1, len(w) - 6)) AS u(i)
), repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
    SELECT doc_id, sum(least(8, coalesce(following - i, 8)))::BIGINT AS n
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following
          FROM repeated)
    GROUP BY doc_id
), measured AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
           length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           len(lines) AS n_lines,
           coalesce(n, 0)::BIGINT AS n_repeat_words,
           length(regexp_replace(t, '[^A-ZÄÖÜÉÈÊÇÑÓÍÁ]', '', 'g')) AS n_capitals,
           len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
           len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•‣·]\\s'))) AS n_bullets,
           len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) AS n_ellipses
    FROM base LEFT JOIN covered USING (doc_id)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           concat_ws(',',
               CASE WHEN n_words < 20 THEN 'few_words' END,
               CASE WHEN n_words > 10000000 THEN 'many_words' END,
               CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 'repeated_windows' END,
               CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words
                    THEN 'word_length' END,
               CASE WHEN n_words > 0 AND n_symbols / n_words > 0.3 THEN 'symbols' END,
               CASE WHEN n_words >= 50 AND n_stop_words / n_words < 0.02 THEN 'stop_words' END,
               CASE WHEN word_chars > 0 AND n_capitals / word_chars > 0.4 THEN 'capitals' END,
               CASE WHEN n_dup_lines / greatest(n_lines, 1) > 0.5 THEN 'repeated_lines' END,
               CASE WHEN n_words >= 100 AND n_bullets / greatest(n_lines, 1) > 0.9
                    THEN 'bullet_lines' END,
               CASE WHEN n_words >= 100 AND n_ellipses / greatest(n_lines, 1) > 0.3
                    THEN 'ellipsis_lines' END) AS failed_rules
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

CHAT_FORMAT = """
WITH rows AS (
    SELECT coalesce(conv_id::VARCHAR, '') AS conv_id, turn, role, coalesce(text, '') AS text
    FROM conversations
), calls AS (
    SELECT * FROM rows WHERE role = 'user' AND turn IS NOT NULL
), results AS (
    SELECT * FROM rows WHERE role = 'assistant' AND turn IS NOT NULL
), linked AS (
    SELECT coalesce(c.conv_id, r.conv_id) AS conv_id,
           'call-' || coalesce(c.turn, r.turn - 1) AS call_id,
           coalesce(c.turn, r.turn) AS turn, coalesce(c.turn, r.turn) AS order_key,
           CASE WHEN c.turn IS NULL THEN 'orphan' WHEN r.turn IS NULL THEN 'open' ELSE 'linked' END
               AS status,
           (c.turn IS NOT NULL)::BIGINT AS copies, c.turn IS NOT NULL AS valid, '' AS errors,
           CASE WHEN c.turn IS NOT NULL THEN '{"arguments":{"prompt":' || to_json(c.text)::VARCHAR
               || ',"turn":' || c.turn || '},' ELSE '{' END
           || '"call_id":"call-' || coalesce(c.turn, r.turn - 1) || '"'
           || coalesce(',"content":' || to_json(r.text)::VARCHAR, '')
           || CASE WHEN c.turn IS NOT NULL THEN ',"name":"reply"}' ELSE '}' END AS json
    FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.turn + 1 = r.turn
)
SELECT * FROM linked
UNION ALL
SELECT conv_id, '', turn, turn, 'message', 1, true, '',
       '{"content":' || to_json(text)::VARCHAR
       || coalesce(',"role":' || to_json(role)::VARCHAR, '') || '}'
FROM rows
WHERE NOT coalesce(role IN ('user', 'assistant') AND turn IS NOT NULL, false)
"""


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text: per byte, eight steps with the reversed polynomial."""
    steps = "list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda t, k: xor(t >> 1, 3988292384 * (t & 1)))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce([4294967295] || {codes}, lambda c, b: {steps}), 4294967295)"


def _added(state: str, cost: str, letter: str) -> str:
    """A state's least cost, nine digits, and the audit behind them, with one more turn."""
    return f"(lpad((substr({state}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{letter}')"


# Insertions are left out: removing an inserted turn and its partner's row costs less, 2 (with a system
# turn that is left alone, 4) instead of 5.
TURN_REPAIR = f"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
    FROM conversations
), coded AS (
    SELECT *, {_crc32("place")} % 20 AS code FROM named
), damaged AS (
    SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
           CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                ELSE text END AS text
    FROM coded, unnest(CASE code WHEN 3 THEN [0, 1] ELSE [0] END) AS u(copy) WHERE code <> 0
), placed AS (
    SELECT *, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos
    FROM damaged
), faults AS (
    SELECT *, left(role, 1) AS initial,
           CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                WHEN pos > min(pos) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated'
           END AS fault
    FROM placed
), steps AS (
    SELECT *, coalesce(fault, '') IN ('blank', 'duplicate') AS gone,
           CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before
    FROM faults
), best AS (
    SELECT conv_id, 0::BIGINT AS pos, '000000000' AS n, NULL::VARCHAR AS s, NULL::VARCHAR AS u,
           NULL::VARCHAR AS a
    FROM (SELECT DISTINCT conv_id FROM steps)
    UNION ALL
    SELECT r.conv_id, r.pos, {_added("b.n", "2", "D")},
           least({_added("b.s", "2", "D")},
                 CASE WHEN NOT gone AND initial = 's' THEN {_added("b.n", "extra", "K")} END),
           least({_added("b.u", "2", "D")},
                 CASE WHEN NOT gone AND initial = 'u' THEN least({_added("b.n", "extra", "K")},
                     {_added("b.s", "extra", "K")}, {_added("b.a", "extra", "K")}) END,
                 CASE WHEN NOT gone THEN least({_added("b.n", "1 + extra", "R")},
                     {_added("b.s", "1 + extra", "R")}, {_added("b.a", "1 + extra", "R")}) END),
           least({_added("b.a", "2", "D")},
                 CASE WHEN NOT gone AND initial = 'a' THEN {_added("b.u", "extra", "K")} END,
                 CASE WHEN NOT gone THEN {_added("b.u", "1 + extra", "R")} END)
    FROM best b JOIN steps r ON b.conv_id IS NOT DISTINCT FROM r.conv_id AND r.pos = b.pos + 1
), chosen AS (
    SELECT conv_id, least(n, a) AS found, substr(least(n, a), 10) AS audit FROM best
    QUALIFY pos = max(pos) OVER (PARTITION BY conv_id)
), kept AS (
    SELECT t.conv_id, t.pos, t.text, t.role, t.initial, substr(audit, t.pos, 1) AS letter,
           row_number() OVER (PARTITION BY t.conv_id ORDER BY t.pos) AS nth
    FROM steps t JOIN chosen c ON t.conv_id IS NOT DISTINCT FROM c.conv_id
    WHERE substr(audit, t.pos, 1) <> 'D'
), lines AS (
    SELECT *, max(CASE WHEN nth = 1 AND initial = 's' AND letter = 'K' THEN 1 ELSE 0 END)
               OVER (PARTITION BY conv_id) AS led
    FROM kept
), repaired AS (
    SELECT conv_id, string_agg(
        CASE WHEN letter = 'K' THEN role WHEN (nth - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || text, chr(10) ORDER BY pos) AS body
    FROM lines GROUP BY conv_id
), counted AS (
    SELECT conv_id,
           coalesce(max(turn)::BIGINT - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count_if(fault = 'blank')::BIGINT AS blank,
           count_if(fault = 'duplicate')::BIGINT AS duplicate,
           count_if(fault = 'truncated')::BIGINT AS truncated,
           count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
    FROM steps GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(substr(found, 1, 9)::BIGINT, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN chosen d ON o.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN repaired e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""

PREFIX_TRIE = f"""
WITH placed AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                              sha256(coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), decimals AS (
    SELECT DISTINCT conv_id, conv_id::VARCHAR AS decimal FROM placed
), convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("decimal")} % 9 AS h FROM decimals
), front AS (
    SELECT c.conv_id, pos, role, text FROM convs c JOIN placed p ON p.conv_id = c.base AND pos <= h
), taken AS (
    SELECT conv_id, count(*) AS n FROM front GROUP BY conv_id
), rebuilt AS (
    SELECT * FROM front
    UNION ALL
    SELECT p.conv_id, pos - h + coalesce(n, 0), role, text
    FROM placed p JOIN convs USING (conv_id) LEFT JOIN taken USING (conv_id) WHERE pos > h
), paths AS (
    SELECT conv_id, pos AS depth, strlen(text) AS bytes,
           sha256(string_agg(sha256(length(role) || ':' || role || ':' || text), '')
                  OVER (PARTITION BY conv_id ORDER BY pos)) AS key
    FROM rebuilt
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM convs
), linked AS (
    SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
           depth = max(depth) OVER (PARTITION BY conv_id) AS ends
    FROM paths
), nodes AS (
    SELECT key, depth, any_value(parent) AS parent, any_value(bytes) AS bytes,
           min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), ''))
               AS ends_sha256
    FROM linked GROUP BY key, depth
), children AS (
    SELECT parent AS key, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
    SELECT p.key, sum((c.key IS NULL)::BIGINT)::BIGINT AS n_leaves,
           sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens
    FROM nodes n LEFT JOIN children c ON n.key = c.key
    JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth
    GROUP BY p.key
)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes q ON q.key = n.parent LEFT JOIN children c ON c.key = n.key
JOIN below b ON b.key = n.key
"""

ORACLE = {
    "op1_quality_rules": QUALITY_RULES,
    "op7_exact_dedup": EXACT_DEDUP,
    "op8_chat_format": CHAT_FORMAT,
    "op11_turn_repair": TURN_REPAIR,
    "op12_prefix_trie": PREFIX_TRIE,
}
