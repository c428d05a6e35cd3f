"""DuckDB SQL for the queries that SQL can express. They keep to the plain definition: every
window, shingle, line or byte string is a row."""

from __future__ import annotations

from millrace.llm.licenses import NOTICES, PHRASES, THRESHOLD, block_words

_SPACE = r"[\x20\x09-\x0D]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{_SPACE}+'), lambda w: w <> '')"


TWINS: dict[str, str] = {}

TWINS["op2_substring_dedup"] = f"""
WITH docs AS MATERIALIZED (SELECT doc_id, {_words('text')} AS w FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM docs)),
later AS (
  SELECT doc_id, s FROM windows JOIN (
    SELECT h, min(struct_pack(d := doc_id, s := s)) AS first FROM windows GROUP BY h HAVING count(*) > 1) USING (h)
  WHERE struct_pack(d := doc_id, s := s) > first),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS k FROM later),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY k) AS text
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM docs) ANTI JOIN gone USING (doc_id, k)
  GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n_kept, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

TWINS["op6_ngram_jaccard"] = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words(_LOWER.format('text'))} AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS items
  FROM docs),
shingles AS MATERIALIZED (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n) AS n_a, any_value(b.n) AS n_b
  FROM shingles a JOIN shingles b ON a.item = b.item AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * common >= 80 * (n_a + n_b - common)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT a AS node, a AS other FROM edges
  UNION
  SELECT node, b FROM reached JOIN edges ON other = a)
SELECT doc_id, len(items)::BIGINT AS n_shingles, least(doc_id, low) AS component_id
FROM sets LEFT JOIN (SELECT node, min(other) AS low FROM reached GROUP BY 1) ON doc_id = node"""

_ITEM_WORDS = "list_filter(regexp_split_to_array({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')".format(
    _LOWER.format("coalesce(text, '')"))
TWINS["op7_decontamination"] = f"""
WITH items AS (SELECT item_id::VARCHAR AS item, {_ITEM_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT item, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
windows AS MATERIALIZED (
  SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
docs AS MATERIALIZED (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM windows))),
met AS MATERIALIZED (SELECT doc_id, n, s, item FROM places JOIN windows USING (n, run)),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM met) GROUP BY 1),
found AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM met GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)"""

_BASE32 = "list_aggregate(list_transform(range(32), lambda k: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substring(h, 5 * (k // 4) + 1, 5))::BIGINT >> (5 * (3 - k % 4))::INT) & 31)::INT, 1)), 'string_agg', '')"
TWINS["op8_warc"] = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS MATERIALIZED (SELECT page_id, octet_length(encode(payload)) AS size, sha1(payload) AS h FROM payloads),
firsts AS (SELECT h, size, min(page_id) AS first FROM hashed GROUP BY ALL)
SELECT page_id, size::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed JOIN firsts USING (h, size)"""

TWINS["quality_base_rules"] = f"""
WITH docs AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text, {_words('text')} AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
windows AS (SELECT doc_id, s, array_to_string(w[s:s + 2], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS s FROM docs)),
again AS (SELECT doc_id, run FROM windows GROUP BY ALL HAVING count(*) > 1),
hit AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(s, s + 3)) AS k FROM windows JOIN again USING (doc_id, run)) GROUP BY 1),
found AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN lines USING (doc_id) LEFT JOIN hit USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM found"""

TWINS["op9_line_dedup"] = f"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, k, line, {_LOWER.format(f"regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g')")} AS key
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS k
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
held AS (
  SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
  GROUP BY 1 HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT lines.*, first IS NOT NULL AND first <> doc_id AS goes FROM lines LEFT JOIN held USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT goes), '')) AS kept_sha256
FROM judged GROUP BY 1"""

TWINS["op10_suffix_dedup"] = """
WITH docs AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, s, md5_number(substring(h, 2 * s - 1, 100)) AS w
  FROM (SELECT doc_id, h, unnest(range(1, n - 48)) AS s FROM docs)),
later AS (
  SELECT doc_id, s FROM windows JOIN (
    SELECT w, min(doc_id) AS first FROM windows GROUP BY 1 HAVING min(doc_id) <> max(doc_id)) USING (w)
  WHERE doc_id > first),
marked AS (
  SELECT doc_id, s, s > 50 + coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s), -50) AS begins FROM later),
spans AS (
  SELECT doc_id, min(s) AS a, max(s) + 49 AS b
  FROM (SELECT doc_id, s, sum(begins::INT) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM marked) GROUP BY doc_id, span),
cuts AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS start, a - 1 AS stop, b FROM spans),
fronts AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a + 1) AS removed, max(b) AS last,
    string_agg(substring(h, 2 * start - 1, 2 * (stop - start + 1)), '' ORDER BY a) AS front
  FROM cuts JOIN docs USING (doc_id) GROUP BY 1)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(front, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN fronts USING (doc_id)"""


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 of text in U+0000 to U+007F and U+00C0 to U+00FF, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: unicode(c))"
    octets = f"flatten(list_transform({codes}, lambda c: CASE WHEN c < 128 THEN [c] ELSE [195, c - 64] END))"
    bits = f"flatten(list_transform({octets}, lambda c: list_transform(range(8), lambda k: (c::BIGINT >> k::INT) & 1)))"
    return f"xor(4294967295, list_reduce({bits}, lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT))"


def _values(*rows: tuple) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


TWINS["op11_licenses"] = f"""
WITH docs AS MATERIALIZED (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
phrases(label, p) AS (SELECT label, string_split(p, ' ') FROM (VALUES {_values(*PHRASES)}) v(label, p)),
base AS (
  SELECT doc_id, count(*) AS n_base, min(k) AS first_word, max(k) AS last_word, list(DISTINCT label) AS labels
  FROM (SELECT doc_id, w, unnest(range(len(w))) AS k FROM docs), phrases WHERE w[k + 1:k + len(p)] = p GROUP BY 1),
notices AS (
  SELECT label, list_distinct(string_split(t, ' ')) AS own, size
  FROM (VALUES {_values(*[(label, text, block_words(len(text.split()))) for label, text in NOTICES])}) v(label, t, size)),
blocks AS (
  SELECT doc_id, size, w[a + 1:a + size] AS words
  FROM (SELECT doc_id, w, size, unnest(range(0, greatest(1, len(w) - size // 2), size // 2)) AS a
        FROM docs, (SELECT DISTINCT size FROM notices))),
shares AS (SELECT doc_id, label, len(list_intersect(list_distinct(words), own)) / len(own) AS share FROM blocks JOIN notices USING (size)),
met AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS score FROM shares WHERE share >= {THRESHOLD} - 1e-9 GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(met.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0) END::DOUBLE AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN met USING (doc_id)"""

TWINS["op12_spelling"] = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER.format('text')}, '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
drawn AS (SELECT *, {_crc32("doc_id || ':' || run")} AS h FROM runs),
words AS MATERIALIZED (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substring(run, (h % length(run) + 2)::INT) ELSE run END AS word,
    sum(n)::BIGINT AS n
  FROM drawn GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
places AS MATERIALIZED (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS k FROM words),
less AS MATERIALIZED (SELECT DISTINCT word, n, left(word, k - 1) || substring(word, k + 1) AS rest FROM places),
holes AS MATERIALIZED (SELECT word, n, k, left(word, k - 1) || substring(word, k + 1) AS rest FROM places),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT words.word, less.word, less.n FROM words JOIN less ON words.word = less.rest
  UNION SELECT less.word, words.word, words.n FROM words JOIN less ON words.word = less.rest),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(low := -n, other := other)) AS best FROM near GROUP BY 1),
forms AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN -best.low >= 5 * words.n THEN best.other END AS form, CASE WHEN -best.low >= 5 * words.n THEN -best.low END::BIGINT AS form_n
  FROM words LEFT JOIN best USING (word)),
followed AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT followed.word, forms.form, step + 1 FROM followed JOIN forms ON followed.root = forms.word WHERE forms.form IS NOT NULL)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN (SELECT word, arg_max(root, step) AS root FROM followed GROUP BY 1) USING (word)"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR)) || ':' || ({value})::VARCHAR, '-')"


def _tree(name: str, leaves: str) -> str:
    """All nodes (g, lvl, i, h, last) over leaves (g, i, h); `last` is the level of the root."""
    return f"""{name}_up AS (
  SELECT g, 0 AS lvl, i, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
  UNION ALL
  SELECT g, lvl + 1, j, h, count(*) OVER (PARTITION BY g) FROM (
    SELECT g, lvl, i // 16 AS j, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}_up WHERE n > 1 GROUP BY ALL)),
{name} AS MATERIALIZED (SELECT *, max(lvl) OVER (PARTITION BY g) AS last FROM {name}_up)"""


def _climb(name: str, starts: str, tree: str) -> str:
    """What starts (id, g, i, h) become when folded with their siblings: (id, lvl, h)."""
    return f"""{name} AS (
  SELECT id, g, i, h, 0 AS lvl FROM {starts}
  UNION ALL
  SELECT s.id, s.g, s.i // 16, sha256(string_agg(CASE WHEN t.i = s.i THEN s.h ELSE t.h END, '' ORDER BY t.i)), s.lvl + 1
  FROM {name} s JOIN {tree} t ON s.g = t.g AND s.lvl = t.lvl AND s.i // 16 = t.i // 16 WHERE s.lvl < t.last GROUP BY ALL)"""


def _siblings(name: str, starts: str, tree: str) -> str:
    return f"""{name} AS (
  SELECT s.id, string_agg(t.h, '' ORDER BY t.lvl, t.i) AS proof
  FROM {starts} s JOIN {tree} t ON s.g = t.g AND t.lvl < t.last AND (s.i >> (4 * t.lvl)::INT) // 16 = t.i // 16 AND s.i >> (4 * t.lvl)::INT <> t.i
  GROUP BY 1)"""


_LEAF = "sha256(" + " || ".join([_field("doc_id"), _field("source"), _field("lang"), _field("n_chars"), _field("{0}")]) + ")"
TWINS["op13_manifest"] = f"""
WITH RECURSIVE hashed AS MATERIALIZED (
  SELECT doc_id, source, {_LEAF.format('text')} AS h,
    CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {_LEAF.format(_LOWER.format('text'))} END AS altered FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, h) AS id, coalesce('1' || source, '0') AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM hashed),
{_tree('low', 'leaves')},
roots AS MATERIALIZED (SELECT g AS name, 'top' AS g, h, row_number() OVER (ORDER BY g) - 1 AS i FROM low WHERE lvl = last),
{_tree('top', 'roots')},
changed AS (SELECT id, g, i, coalesce(altered, h) AS h FROM leaves),
{_climb('low_fold', 'changed', 'low')},
reached AS (SELECT id, g, arg_max(h, lvl) AS h FROM low_fold GROUP BY ALL),
starts AS (SELECT id, 'top' AS g, roots.i, reached.h FROM reached JOIN roots ON reached.g = roots.name),
{_climb('top_fold', 'starts', 'top')},
folded AS (SELECT id, arg_max(h, lvl) AS folded_root FROM top_fold GROUP BY 1),
{_siblings('low_proof', 'leaves', 'low')},
{_siblings('top_proof', 'starts', 'top')}
SELECT doc_id, leaves.h AS leaf, roots.h AS subroot, root,
  sha256(coalesce(low_proof.proof, '') || coalesce(top_proof.proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN roots ON leaves.g = roots.name JOIN folded USING (id) CROSS JOIN (SELECT h AS root FROM top WHERE lvl = last)
  LEFT JOIN low_proof USING (id) LEFT JOIN top_proof USING (id)"""
