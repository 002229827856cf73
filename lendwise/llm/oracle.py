"""DuckDB SQL for the operators' queries that SQL can express.

The contracts' patterns and limits are written out here again, so that the
SQL does not depend on the code it checks.
"""

# ------------------------------------------------------------------ op3
OP3_QUALITY_RULES = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
classes AS (
  SELECT doc_id, lang,
         length(t) - length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS c0,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS c1,
         length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS c2,
         length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS c3,
         length(t) - length(regexp_replace(regexp_replace(t, '[#*%&]', '', 'g'), '[\p{P}^~`+=]', '', 'g'))
           - (length(t) - length(regexp_replace(t, '[#*%&]', '', 'g'))) AS c4,
         length(t) AS n
  FROM d),
parts AS (
  SELECT doc_id, lang, n, unnest([0, 1, 2, 3, 4, 5]) AS cell,
         unnest([c0, c1, c2, c3, c4, greatest(0, n - c0 - c1 - c2 - c3 - c4)]) AS c
  FROM classes),
class_ref AS (
  SELECT lang, cell, sum(c) / greatest(1, sum(sum(c)) OVER (PARTITION BY lang)) AS q FROM parts GROUP BY lang, cell),
js_class AS (
  SELECT doc_id, sqrt(greatest(0, sum(
           CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS distance
  FROM (SELECT doc_id, parts.c / n AS p, q FROM parts JOIN class_ref USING (lang, cell) WHERE n > 0)
  GROUP BY doc_id),
each_word AS (SELECT doc_id, lang, unnest(words) AS w FROM d),
totals AS (SELECT lang, sum(len(words)) AS total FROM d GROUP BY lang),
common AS (
  SELECT lang, w, count(*) AS n FROM each_word GROUP BY lang, w
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) <= 16),
word_ref AS (SELECT lang, w, n / total AS q FROM common JOIN totals USING (lang)),
word_doc AS (SELECT doc_id, w, count(*) AS n FROM each_word GROUP BY doc_id, w),
word_cells AS (
  SELECT d.doc_id, coalesce(x.n, 0) / len(d.words) AS p, r.q
  FROM d JOIN word_ref r USING (lang) LEFT JOIN word_doc x ON x.doc_id = d.doc_id AND x.w = r.w
  WHERE len(d.words) > 0),
word_all AS (
  SELECT doc_id, p, q FROM word_cells
  UNION ALL SELECT doc_id, greatest(0, 1 - sum(p)), greatest(0, 1 - sum(q)) FROM word_cells GROUP BY doc_id),
js_word AS (
  SELECT doc_id, sqrt(greatest(0, sum(
           CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS distance
  FROM word_all GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, (c.n - c.c0)::BIGINT AS word_chars, c.c1::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d JOIN classes c USING (doc_id) LEFT JOIN repeated r USING (doc_id))
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND (word_chars < 200 OR coalesce(jc.distance, 0) <= 0.28)
         AND (n_words < 64 OR coalesce(jw.distance, 0) <= 0.36) AS kept
FROM base b LEFT JOIN js_class jc USING (doc_id) LEFT JOIN js_word jw USING (doc_id)
"""

# ------------------------------------------------------------------ op5
OP5_SHARDING = r"""
WITH RECURSIVE r AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
b AS (
  SELECT 0 AS depth, 0::BIGINT AS prefix, sum(n_bytes)::BIGINT AS bytes, count(*)::BIGINT AS n, min(h) AS lo, max(h) AS hi
  FROM r
  UNION ALL
  SELECT b.depth + 1, r.h >> (59 - b.depth), sum(r.n_bytes)::BIGINT, count(*)::BIGINT, min(r.h), max(r.h)
  FROM b JOIN r ON (r.h >> (60 - b.depth)) = b.prefix
  WHERE b.bytes > 1048576 AND b.lo <> b.hi
  GROUP BY b.depth, r.h >> (59 - b.depth)),
leaf AS (SELECT * FROM b WHERE bytes <= 1048576 OR lo = hi)
SELECT r.doc_id, r.n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard,
       0::BIGINT AS page, leaf.bytes AS shard_bytes, leaf.n AS shard_rows
FROM r JOIN leaf ON (r.h >> (60 - leaf.depth)) = leaf.prefix
"""

# ------------------------------------------------------------------ op6
OP6_WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (
  SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex,
         min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM q
"""

# ------------------------------------------------------------------ op7
OP7_NGRAM_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS g
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
"""

# ------------------------------------------------------------------ op9
_KINDS = (
    ("assign", 2, 8, r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", 0, 16, r"AKIA[A-Z0-9]+"),
    ("hex", 0, 32, r"[0-9a-f]+"),
    ("private_key", 0, 0, r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"),
    ("github", 0, 0, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    ("slack", 0, 0, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("jwt", 0, 0, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def _op9() -> str:
    one = """
  SELECT doc_id, {order} AS o, '{kind}' AS kind, len(hit) AS size,
         (list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: len(x))), 0))::BIGINT AS s
  FROM (SELECT doc_id, gaps, hits, i, hits[i] AS hit, parts[i] AS part
        FROM (SELECT doc_id, gaps, hits, parts, unnest(range(1, len(hits) + 1)) AS i
              FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS hits,
                           regexp_extract_all(t, '{pattern}', {group}) AS parts FROM d)))
  WHERE len(part) >= {least}"""
    every = "\n  UNION ALL".join(one.format(order=o, kind=k, group=g, least=n, pattern=p) for o, (k, g, n, p) in enumerate(_KINDS))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({every}),
by_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || (s + size), ',' ORDER BY s, o) FILTER (o < 3) AS base,
         string_agg(kind || ':' || s || ':' || (s + size), ',' ORDER BY s, o) AS spans
  FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN by_doc USING (doc_id)
"""


# ----------------------------------------------------------------- op11
def _op11() -> str:
    """Every conversation's turns in order, one step a turn: a label (cost,
    audit, repaired text) for each state of (s?(ua)+)?."""
    nothing = "{'c': 1000000000, 'a': '', 't': ''}"
    messages = {"u": "user:", "a": "assistant:"}

    def more(label: str, cost: str, letter: str, message: str | None = None) -> str:
        text = f"{label}.t" if message is None else f"{label}.t || chr(10) || {message}"
        return f"{{'c': {label}.c + {cost}, 'a': {label}.a || '{letter}', 't': {text}}}"

    def least(*labels: str) -> str:
        return f"list_min([{', '.join(labels)}])"

    insert = {r: f"'{m}'" for r, m in messages.items()}
    # Turns inserted before the next one, or at the end.
    into_u = least("l2", *(more(x, "2", "I", insert["u"]) for x in ("l0", "l1", "l3")))
    closed = f"SELECT conv_id, i, l0, l1, {into_u} AS l2, l3 FROM"
    closed_a = f"SELECT conv_id, i, l0, l1, l2, {least('l3', more('l2', '2', 'I', insert['a']))} AS l3 FROM"

    def taken(state: str, froms: tuple[str, ...], role: str) -> str:
        ways = [more(state, "3", "D")]
        for x in froms:
            kept = more(x, "cut", "K", "role || ':' || text")
            ways.append(f"CASE WHEN keep AND role[1] = '{role}' THEN {kept} ELSE {nothing} END")
            if role != "s":
                given = more(x, "2 + cut", "R", f"'{messages[role]}' || text")
                ways.append(f"CASE WHEN keep THEN {given} ELSE {nothing} END")
        return least(*ways)

    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crc AS (
  SELECT keyed.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM crc WHERE kind <> 0),
rows AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
faults AS (
  SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM rows),
turns AS (
  SELECT *, NOT blank AND NOT dup AS keep, (NOT blank AND NOT dup AND NOT (body[-1] IN ('.', '!', '?')))::INT AS cut FROM faults),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': ''}} AS l0, {nothing} AS l1, {nothing} AS l2, {nothing} AS l3 FROM turns
  UNION ALL
  SELECT w.conv_id, t.i, {taken('l0', (), 'x')}, {taken('l1', ('l0',), 's')}, {taken('l2', ('l0', 'l1', 'l3'), 'u')}, {taken('l3', ('l2',), 'a')}
  FROM ({closed_a} ({closed} walk)) w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1),
ended AS (
  SELECT conv_id, list_min([l0, l3]) AS best FROM ({closed_a} ({closed} walk))
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS duplicate, sum(cut) AS truncated,
         count(*) FILTER (pair IS NOT NULL AND NOT (pair IN ('su', 'ua', 'au'))) AS illegal FROM turns GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
"""


# ----------------------------------------------------------------- op13
def _op13(rounds: int = 5) -> str:
    def nearest(r: int) -> str:
        return f"""near{r} AS MATERIALIZED (
  SELECT row, vec_id, cluster, distance, v FROM (
    SELECT k.row, k.vec_id, k.v, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i]))) AS distance
    FROM kept k, cent{r} c)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)"""

    def moved(r: int) -> str:
        return f"""sums{r} AS (
  SELECT cluster, i, sum(x)::HUGEINT AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS i FROM near{r})
  GROUP BY cluster, i),
mean{r} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM sums{r} GROUP BY cluster),
cent{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM cent{r} c LEFT JOIN mean{r} m USING (cluster))"""

    steps = ",\n".join(f"{nearest(r)},\n{moved(r)}" for r in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
cent0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v
  FROM (SELECT v, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h FROM kept ORDER BY h, v LIMIT 40)),
{steps},
{nearest(rounds)}
SELECT vec_id, cluster::INT AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near{rounds} JOIN cent{rounds} c USING (cluster)
"""


ORACLE = {
    "op3_quality_rules": OP3_QUALITY_RULES,
    "op5_sharding": OP5_SHARDING,
    "op6_warc": OP6_WARC,
    "op7_ngram_join": OP7_NGRAM_JOIN,
    "op9_secret_scans": _op9(),
    "op11_conversation_repair": _op11(),
    "op13_pivot_clusters": _op13(),
}
