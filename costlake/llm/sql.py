"""DuckDB SQL of the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"'[^\x20\x09-\x0D]+'"

#: Sets of shingles, pairs by their common shingles, and what each document reaches.
JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORDS}) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""


def sharding(limit: int) -> str:
    """The shortest prefix of each document's hash whose bucket fits."""
    return f"""
WITH bits AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
    array_to_string([lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0') FOR c IN string_split(substr(md5(CAST(doc_id AS VARCHAR)), 1, 15), '')], '') AS b
  FROM documents),
nodes AS (
  SELECT d, substr(b, 1, d) AS p, CAST(sum(n_bytes) AS BIGINT) AS bytes, count(*) AS n FROM bits, range(0, 61) AS r(d) GROUP BY 1, 2),
leaf AS (
  SELECT doc_id, min(d) AS depth FROM bits JOIN nodes ON p = substr(b, 1, d) WHERE bytes <= {limit} OR n = 1 GROUP BY 1)
SELECT doc_id, n_bytes, p AS shard, CAST(depth AS INTEGER) AS depth, bytes AS shard_bytes, n AS shard_rows
FROM bits JOIN leaf USING (doc_id) JOIN nodes ON d = depth AND p = substr(b, 1, depth)"""


def chat() -> str:
    """Digests straight from the rows, and the length that markers and escapes make."""
    controls = r"\\|### System:|### User:|### Assistant:|### Role:|</turn>|</role>"
    escapes = f"len(regexp_extract_all({{}}, '{controls}'))"
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
marked AS (
  SELECT *, lag(role) OVER w AS before, lag(turn) OVER w AS number, lead(role) OVER w AS behind,
    CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 9 WHEN 'assistant' THEN 14
      ELSE 9 + length(role) + {escapes.format('role')} + 7 END + 1 + length(text) + {escapes.format('text')} + 8 AS chars
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN turn <= number THEN false
             WHEN before = 'system' THEN role = 'user' WHEN before = 'user' THEN role = 'assistant'
             WHEN before = 'assistant' THEN role = 'user' ELSE false END
           AND (behind IS NOT NULL OR role = 'assistant')) AS valid
FROM marked GROUP BY conv_id"""


def quality_rules(ratios: dict, reach: float, gamma: float, least: float, min_docs: int = 100) -> str:
    """Counts, bucketed quantiles of each group, and fences."""
    value = {"symbols": "n_symbols / n_words", "dup_lines": "n_dup_lines / greatest(n_lines, 1)", "repeats": "n_repeat_words / n_words",
             "word_length": "word_chars / n_words", "upper": "n_upper / greatest(word_chars, 1)"}
    long = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS ratio, {value[r]} AS v FROM features WHERE n_words > 0" for r in ratios)

    def level(name: str, by: str) -> str:
        keys = f"{by}, " if by else ""
        return f"""{name}_sums AS (SELECT {keys}ratio, bucket, sum(n) AS n FROM sketch GROUP BY ALL),
{name}_up AS (SELECT *, sum(n) OVER (PARTITION BY {keys}ratio) AS docs, sum(n) OVER (PARTITION BY {keys}ratio ORDER BY bucket) AS up_to,
  CASE WHEN bucket = 0 THEN 0.0 ELSE {least} * pow(CAST({gamma} AS DOUBLE), bucket - 0.5) END AS v FROM {name}_sums),
{name} AS (SELECT {keys}ratio, max(docs) AS docs, min(v) FILTER (up_to >= docs * 0.25) AS low, min(v) FILTER (up_to >= docs * 0.5) AS mid,
  min(v) FILTER (up_to >= docs * 0.75) AS high FROM {name}_up GROUP BY ALL)"""

    spread = "CASE f.ratio " + " ".join(f"WHEN '{r}' THEN {s}" for r, (_, s, _) in ratios.items()) + " END"
    lower = ", ".join(f"'{r}'" for r, (_, _, low) in ratios.items() if low)

    def pick(q: str) -> str:
        return f"CASE WHEN f.docs >= {min_docs} THEN f.{q} WHEN l.docs >= {min_docs} THEN l.{q} ELSE c.{q} END"

    return rf"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
grams AS (SELECT *, CASE WHEN lead(word, 2) OVER o IS NOT NULL THEN word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o END AS g
  FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT *, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 THEN 1 ELSE 0 END AS t FROM grams),
covered AS (SELECT doc_id, greatest(t, coalesce(lag(t) OVER o, 0), coalesce(lag(t, 2) OVER o, 0)) AS c
  FROM twice WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
repeats AS (SELECT doc_id, sum(c) AS n FROM covered GROUP BY 1),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS d FROM
  (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) WHERE regexp_matches(line, {WORDS}) GROUP BY 1),
features AS (SELECT d.doc_id, d.lang, d.source, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(l.n - l.d, 0) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(l.n, 0) AS n_lines,
  CAST(length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper
  FROM documents d JOIN words USING (doc_id) LEFT JOIN repeats r USING (doc_id) LEFT JOIN lines l USING (doc_id)),
ratios AS ({long}),
sketch AS (SELECT lang, source, ratio, CASE WHEN v <= {least} THEN 0 ELSE greatest(1, ceil(ln(v / {least}) / ln({gamma}))) END AS bucket,
  count(*) AS n FROM ratios GROUP BY ALL),
{level('fine', 'lang, source')},
{level('by_lang', 'lang')},
{level('corpus', '')},
fences AS (SELECT f.lang, f.source, f.ratio, {pick('mid')} AS mid, {pick('high')} AS high, {pick('low')} AS low, {spread} AS spread
  FROM fine f JOIN by_lang l ON f.lang IS NOT DISTINCT FROM l.lang AND f.ratio = l.ratio JOIN corpus c ON f.ratio = c.ratio),
outside AS (SELECT DISTINCT x.doc_id FROM
  (SELECT doc_id, lang, source, ratio, v FROM features, LATERAL (SELECT unnest([{', '.join(f"'{r}'" for r in ratios)}]) AS ratio,
     unnest([{', '.join(value[r].replace('/ n_words', '/ nullif(n_words, 0)') for r in ratios)}]) AS v)) x
  JOIN fences f ON x.lang IS NOT DISTINCT FROM f.lang AND x.source IS NOT DISTINCT FROM f.source AND x.ratio = f.ratio
  WHERE v > mid + {reach} * greatest(spread, high - mid) OR x.ratio IN ({lower}) AND v < mid - {reach} * greatest(spread, mid - low))
SELECT f.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND o.doc_id IS NULL AS kept
FROM features f LEFT JOIN outside o USING (doc_id)"""


#: The 256 entries of CRC-32's table, one row with a list.
CRCS = """crcs AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(256) AS r(i)))"""


def crc32(h: str) -> str:
    """CRC-32 of the bytes whose hex digits are ``h``, beside ``CRCS``."""
    return f"""xor(list_reduce(list_concat([4294967295], [CAST('0x' || substr({h}, 2 * i + 1, 2) AS BIGINT) FOR i IN range(length({h}) // 2)]),
    lambda x, b: xor(x >> 8, t[1 + (xor(x, b) & 255)])), 4294967295)"""


def warc() -> str:
    """The largest id of each payload, and SHA-1 digits in groups of 20 bits, four base-32 letters each."""
    letter = "(CAST('0x' || substr(x, 5 * (j // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31"
    return f"""
WITH own AS (SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS lead FROM pages),
digests AS (SELECT page_id, lead, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS x FROM own)
SELECT page_id, payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ({letter}), 1) FOR j IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> lead THEN lead END AS refers_to FROM digests"""


def repair() -> str:
    """A recursion over rows, forward: for each of four states the least (cost, audit) so far, and the rows it makes."""
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

    def state(name: str, more: int, edit: str, row: str = "''") -> str:
        return f"{{'c': {name}.c + {more}, 'a': {name}.a || '{edit}', 'r': {name}.r || {row}}}"

    def either(*of: str) -> str:
        return f"list_min([{', '.join(of)}])"

    def closed(q0: str, q1: str, q2: str, q3: str) -> tuple[str, str]:
        """States 2 and 3 with insertions."""
        user, reply = "'user:' || chr(10)", "'assistant:' || chr(10)"
        two = either(q2, state(q0, 5, "I", user), state(q1, 5, "I", user), state(q3, 5, "I", user))
        return two, either(q3, state("two", 5, "I", reply))

    two, three = closed("q0", "q1", "q2", "q3")
    never = "{'c': 1000000000, 'a': '', 'r': ''}"
    row = "role || ':' || text || chr(10)"

    def own(source: str, to: str) -> list[str]:
        """Keeping and reroling a row that may stay, from a state that a turn of ``to`` may follow."""
        extra = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
        name = {"u": "user", "a": "assistant"}[to]
        keep = f"CASE WHEN may AND initial = '{to}' THEN {state(source, 0, 'K', row).replace('.c + 0', f'.c + {extra}')} ELSE {never} END"
        rerole = state(source, 1, "R", f"'{name}:' || text || chr(10)").replace(".c + 1", f".c + 1 + {extra}")
        return [keep, f"CASE WHEN may THEN {rerole} ELSE {never} END"]

    start = state("q0", 0, "K", row).replace(".c + 0", ".c + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END")
    return f"""
WITH RECURSIVE {CRCS},
codes AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32('h')} % 20 AS code
  FROM (SELECT *, hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h FROM conversations), crcs),
damaged AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM codes, range(2) AS r(copy) WHERE code <> 0 AND (copy = 0 OR code = 3)),
ordered AS (SELECT *, row_number() OVER w AS i,
    left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before, rtrim(text, {space}) AS core
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(CAST(length(role) AS VARCHAR) || ':' || role || ':' || text))),
turns AS (SELECT *, CASE WHEN core = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM ordered),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM turns GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0 AS i, {{'c': 0, 'a': '', 'r': ''}} AS q0, {never} AS q1, {never} AS q2, {never} AS q3 FROM facts
  UNION ALL
  SELECT conv_id, i, {state('q0', 2, 'D')}, {either(state('q1', 2, 'D'), f"CASE WHEN may AND initial = 's' THEN {start} ELSE {never} END")},
    {either(state('two', 2, 'D'), *own('q0', 'u'), *own('q1', 'u'), *own('three', 'u'))}, {either(state('three', 2, 'D'), *own('two', 'a'))}
  FROM (SELECT *, {three} AS three FROM (
    SELECT t.*, w.q0, w.q1, w.q3, fault IS NULL OR fault = 'truncated' AS may, {two} AS two
    FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1))),
finish AS (SELECT conv_id, {either('q0', 'three')} AS best FROM (SELECT *, {three} AS three FROM (
  SELECT w.*, {two} AS two FROM walk w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = f.n)))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(left(best.r, length(best.r) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN finish e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""


def resampling(percent: int = 25, least_words: int = 20, buckets: int = 10_000, seed: int = 7) -> str:
    """CRC of each distinct feature by a table of 256 entries, counts, gains, and ranks of the noisy weights."""

    def found(source: str, key: str) -> str:
        words = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
        return f"""(SELECT {key}, len(w) AS n_words, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f
  FROM (SELECT {key}, {words} AS w FROM {source}))"""

    return f"""
WITH {CRCS},
own AS (SELECT doc_id, n_words, f, count(*) AS k FROM {found('documents', 'doc_id')} GROUP BY ALL),
other AS (SELECT f, count(*) AS k FROM {found('benchmark', 'item_id')} GROUP BY f),
coded AS (SELECT f, {crc32('h')} % {buckets} AS bucket
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM own UNION SELECT f FROM other)), crcs),
s AS (SELECT bucket, sum(k) AS n FROM own JOIN coded USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(k) AS n FROM other JOIN coded USING (f) GROUP BY bucket),
totals AS (SELECT CAST(coalesce((SELECT sum(k) FROM own), 0) AS DOUBLE) AS s_all, CAST(coalesce((SELECT sum(k) FROM other), 0) AS DOUBLE) AS t_all),
gains AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(CAST(t.n AS DOUBLE), 0) + 1) * (s_all + {buckets})
    / ((CAST(s.n AS DOUBLE) + 1) * (t_all + {buckets})))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), totals),
weights AS (SELECT doc_id, sum(k) AS n, CAST(floor(CAST(sum(k * gain) AS DOUBLE) / CAST(sum(k) AS DOUBLE)) AS BIGINT) AS weight, any_value(n_words) AS n_words
  FROM own JOIN coded USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
scores AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(n_words, 0) >= {least_words} AS may,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY may) AS n FROM scores)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN may AND place <= {percent} * n // 100 THEN place END AS rank FROM ranked"""
