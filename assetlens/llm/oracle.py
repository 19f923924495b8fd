"""DuckDB SQL for the text queries that SQL can express. The others (hash-based fingerprints, models, tokenizers,
best-fit packing, components) are held against brute force in the tests."""

from __future__ import annotations

from .common import LOWER, UPPER
from .license_scan import PHRASES, TEMPLATES, half_window
from .queries import PROBE
from .quality_rules import STOP_WORDS

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = f"'{UPPER}', '{LOWER}'"
_LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _places(phrase: str, label: str) -> str:
    hit = " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase.split(" ")))
    return f"SELECT doc_id, i - 1 AS place, '{label}' AS label FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w) WHERE {hit}"


OP3 = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), {_LOWER}) AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{_LICENSE_WORD}') AS words FROM t),
places AS ({" UNION ALL ".join(_places(p, x) for p, x in PHRASES.items())}),
base AS (SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS labels FROM places GROUP BY doc_id),
templates AS (SELECT label, half, list_distinct(regexp_extract_all(wording, '{_LICENSE_WORD}')) AS tokens
              FROM (VALUES {", ".join(f"('{k}', '{v.lower()}', {half_window(v)})" for k, v in TEMPLATES.items())}) v(label, wording, half)),
starts AS (SELECT doc_id, words, half, unnest(range(0, greatest(ceil(len(words) / half)::BIGINT - 1, 1))) AS k FROM w, (SELECT DISTINCT half FROM templates)),
blocks AS (SELECT doc_id, half, list_distinct(words[k * half + 1:(k + 2) * half]) AS tokens FROM starts),
met AS (SELECT doc_id, label, max(len(list_intersect(b.tokens, t.tokens)) / len(t.tokens)) AS containment
        FROM blocks b JOIN templates t ON b.half = t.half AND len(list_intersect(b.tokens, t.tokens)) >= ceil(0.9 * len(t.tokens) - 1e-9) GROUP BY ALL),
own AS (SELECT doc_id, list(label) AS labels, max(containment) AS score FROM met GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',') AS labels,
  greatest(coalesce(score, 0), CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)
"""

OP4 = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(0, 8) x(j) WHERE n > 1 GROUP BY doc_id),
m AS (SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        len(list_filter(words, lambda x: list_contains([{", ".join(f"'{x}'" for w in sorted(set(STOP_WORDS)) for x in sorted({w, w.capitalize()}))}], x))) AS n_stop,
        coalesce(covered.n, 0) AS n_repeat_words
      FROM w LEFT JOIN covered USING (doc_id)),
v AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
f AS (SELECT *, array_to_string(list_filter([
        CASE WHEN n_words > 0 AND NOT word_chars / n_words BETWEEN 2 AND 12 THEN 'word_length' END,
        CASE WHEN n_words > 0 AND n_symbols / n_words > 0.2 THEN 'symbols' END,
        CASE WHEN n_words > 0 AND n_stop / n_words < 0.05 THEN 'stop_words' END,
        CASE WHEN len(lines) > 0 AND n_dup_lines / len(lines) > 0.5 THEN 'repeated_lines' END], lambda x: x IS NOT NULL), ',') AS failed FROM v)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND failed = '' AS kept, failed
FROM f
"""

OP8 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, {_SPACE}), {_LOWER}) AS key FROM l),
frequent AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(frequent.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE frequent.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN frequent USING (key) GROUP BY doc_id
"""

_ESCAPED = "replace(replace(coalesce({}, ''), chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')"
OP10 = f"""
WITH r AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
e AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, {_ESCAPED.format("text")} AS body, {_ESCAPED.format("role")} AS who FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(who) + 1 + length(body) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars,
  regexp_full_match(string_agg(role || '>', '' ORDER BY turn, role, text), '(system>)?(user>assistant>)+') AS valid
FROM e GROUP BY conv_id
"""

# crc32 of a decimal number: its table of 256 entries by eight shifts each, then one step per digit
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i))"
_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"


def _tree(name: str, leaves: str) -> str:
    """Recursive levels of the trees in ``leaves`` (tree, i, n, d, hi): every node with its run's digests; ``hi`` is the height."""
    return f"""{name} AS (
  SELECT tree, i, n, d, 0 AS level, list(d) OVER run AS run, row_number() OVER run_at AS slot FROM {leaves}
    WINDOW run AS (PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
           run_at AS (PARTITION BY tree, i // 3 ORDER BY i)
  UNION ALL
  SELECT tree, i, n, d, level, list(d) OVER run AS run, row_number() OVER run_at AS slot
    FROM (SELECT tree, i // 3 AS i, (n + 2) // 3 AS n, sha256(array_to_string(run, '')) AS d, level + 1 AS level FROM {name} WHERE slot = 1 AND n > 1)
    WINDOW run AS (PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
           run_at AS (PARTITION BY tree, i // 3 ORDER BY i))"""


def _folded(name: str, start: str, nodes: str) -> str:
    """Recursive walk of the rows in ``start`` (id, tree, i, d, proof) up ``nodes``: the digest met and the siblings so far."""
    return f"""{name} AS (
  SELECT id, tree, i, d, proof, 0 AS level FROM {start}
  UNION ALL
  SELECT w.id, w.tree, w.i // 3, sha256(array_to_string(list_concat(t.run[:t.slot - 1], [w.d], t.run[t.slot + 1:]), '')),
         w.proof || array_to_string(list_concat(t.run[:t.slot - 1], t.run[t.slot + 1:]), ''), w.level + 1
    FROM {name} w JOIN {nodes} t ON t.tree = w.tree AND t.i = w.i AND t.level = w.level WHERE t.n > 1)"""


OP12 = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t),
docs AS (SELECT row_number() OVER () AS id, d.*, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
             lambda c, x: xor(crc.t[(xor(c, x) & 255) + 1], c // 256), 4294967295::BIGINT) AS c FROM documents d, crc),
kept AS (SELECT id, doc_id, coalesce('=' || source, '') AS tree, {_LEAF.format(text="text")} AS d,
             {_LEAF.format(text="(CASE WHEN xor(c, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS other FROM docs),
leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM kept),
{_tree("nodes", "leaves")},
subroots AS MATERIALIZED (SELECT tree AS grp, '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n, d FROM nodes WHERE n = 1),
{_tree("crown", "subroots")},
root AS (SELECT d AS root FROM crown WHERE n = 1),
starts AS (SELECT id, tree, i, d, '' AS proof FROM leaves UNION ALL SELECT -id, tree, i, other, '' FROM leaves),
{_folded("walked", "starts", "nodes")},
halfway AS (SELECT w.id, '' AS tree, s.i, w.d, w.proof FROM (SELECT *, max(level) OVER (PARTITION BY id) AS top FROM walked) w JOIN subroots s ON s.grp = w.tree WHERE level = top),
{_folded("finished", "halfway", "crown")},
ends AS (SELECT id, d, proof FROM (SELECT *, max(level) OVER (PARTITION BY id) AS top FROM finished) WHERE level = top)
SELECT doc_id, l.d AS leaf, s.d AS subroot, root, sha256(e.proof) AS proof_sha256, t.d AS folded_root, t.d = root AS verified
FROM leaves l JOIN subroots s ON s.grp = l.tree CROSS JOIN root JOIN ends e ON e.id = l.id JOIN ends t ON t.id = -l.id
"""

OP13 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
d AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
        ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS e FROM t),
f AS (SELECT *, least(a, b) AS x, greatest(a, b) AS y, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
        WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, substring(t, 1, x) AS prefix, substring(t, x + 1, y - x) AS middle, substring(t, y + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

ORACLE_SQL = {"op3_licenses": OP3, "op4_quality_rules": OP4, "op8_line_dedup": OP8, "op10_chat": OP10, "op12_merkle": OP12,
              "op13_infill": OP13}
