"""SQL (DuckDB dialect) for the operators that SQL can express."""

from __future__ import annotations

from . import licenses, secrets, sharding, trie, vectors


def _components(nodes: str, links: str) -> str:
    """CTE text: ``labels`` (node, root) with the least node that each node reaches."""
    return f"""
reach AS (
  SELECT node, node AS root FROM {nodes}
  UNION
  SELECT l.b, r.root FROM reach r JOIN {links} l ON l.a = r.node
),
labels AS (SELECT node, min(root) AS root FROM reach GROUP BY node)"""


def _license_sql() -> str:
    phrases = " UNION ALL ".join(
        f"SELECT '{label}' AS label, {phrase.split()} AS phrase"
        for label, phrase in licenses.PHRASES.items()
    )
    templates = ", ".join(
        f"({i}, '{t.label}', {list(t.words)}, {t.required.split()}, {t.needed})"
        for i, t in enumerate(licenses.TEMPLATES)
    )
    step = max(len(t.text.split()) for t in licenses.TEMPLATES)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = f"translate(coalesce(text, ''), '{upper}', '{upper.lower()}')"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH RECURSIVE low AS (
  SELECT doc_id, {low} AS t FROM documents
),
words AS (SELECT doc_id, t, regexp_extract_all(t, '{word}') AS w FROM low),
phrases AS ({phrases}),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(len(w)),
         lambda i: w[i + 1 : i + len(phrase)] = phrase)) AS start
  FROM words, phrases
),
base AS (
  SELECT doc_id, count(*) AS n, min(start) AS first_word, max(start) AS last_word,
         list_distinct(list(label)) AS labels
  FROM places GROUP BY doc_id
),
lines AS (
  SELECT doc_id, generate_subscripts(string_split(t, chr(10)), 1) AS block,
         unnest(string_split(t, chr(10))) AS text FROM low
),
windows AS (
  SELECT doc_id, w, unnest(range(0, greatest(len(w) - {step} - 1, 0) + 1, {step})) AS start
  FROM words WHERE contains(t, chr(10))
),
blocks AS (
  SELECT doc_id, block, list_distinct(regexp_extract_all(text, '{word}')) AS b FROM lines
  UNION ALL
  SELECT doc_id, -2 - start // {step}, list_distinct(w[start + 1 : start + 2 * {step}])
  FROM windows
),
templates(id, label, t, required, needed) AS (VALUES {templates}),
met AS (
  SELECT doc_id, block, id, label, len(list_intersect(b, t)) / len(t) AS score
  FROM blocks, templates
  WHERE list_has_all(b, required) AND len(list_intersect(b, t)) >= needed
),
under AS (
  SELECT DISTINCT m.doc_id, m.block + near.i AS block, less.id
  FROM met m JOIN templates more ON more.id = m.id
  JOIN templates less ON list_has_all(more.t, less.t) AND len(more.t) > len(less.t)
  JOIN (VALUES (-1), (0), (1)) AS near(i) ON near.i = 0 OR m.block < 0
),
best AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(score) AS score
  FROM met ANTI JOIN under USING (doc_id, block, id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
         list_concat(coalesce(base.labels, []), coalesce(best.labels, [])))), ','), '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)"""


def _secret_sql() -> str:
    kinds = [*secrets.BASE, "entropy"]
    patterns = {k: (p, g) for k, (p, g, _) in secrets.BASE.items()}
    patterns["entropy"] = (secrets.CANDIDATE, 0)
    found = " UNION ALL ".join(
        f"""SELECT doc_id, {i} AS kind, regexp_extract_all(t, '{quoted}') AS m,
       regexp_extract_all(t, '{quoted}', {group}) AS v, string_split_regex(t, '{quoted}') AS g
       FROM texts WHERE regexp_matches(t, '{quoted}')"""
        for i, (quoted, group) in enumerate(
            (patterns[k][0].replace("'", "''"), patterns[k][1]) for k in kinds
        )
    )
    least = "CASE kind " + "".join(
        f"WHEN {i} THEN {n} " for i, (_, _, n) in enumerate(secrets.BASE.values())
    )
    w, width = secrets.WINDOW, f"{float(secrets.WINDOW)}"
    bits = {k: least for k, (_, least) in secrets.CLASSES.items()}
    counts = ", ".join(
        f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(kinds)
    )
    name = "CASE kind " + "".join(f"WHEN {i} THEN '{k}' " for i, k in enumerate(kinds)) + "END"
    joined = f"string_agg({name} || ':' || s || ':' || e, ',' ORDER BY s, kind)"
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
places AS (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM found),
spans AS (
  SELECT doc_id, kind, m[k] AS x, v[k] AS value, right(g[k], 24) AS before,
         CAST(list_sum(list_transform(g[1:k], lambda q: length(q)))
           + coalesce(list_sum(list_transform(m[1:k-1], lambda q: length(q))), 0) AS INT) AS s
  FROM places
),
base AS (
  SELECT doc_id, kind, s, s + length(x) AS e FROM spans
  WHERE kind < {len(secrets.BASE)} AND length(value) >= {least} END
),
random AS (
  SELECT *, rtrim(left_over, '=') AS r FROM (
    SELECT DISTINCT doc_id, kind, s, x, before, array_to_string(list_filter(
        string_split(x, '/'), lambda p:
        NOT regexp_matches(p, '(?i)(example|sample|dummy|placeholder|changeme|redacted|xxxx|your_|lorem)')
        AND NOT regexp_matches(p, '(?i)(0123456789|abcdefghij|qwertyuiop)')
        AND len(list_filter(range(1, length(p) - 6), lambda i:
          substr(lower(p), i, 8) = repeat(substr(lower(p), i, 1), 8))) = 0), '/') AS left_over
    FROM spans WHERE kind = {len(secrets.BASE)})
),
windows AS (
  SELECT x, unnest(list_transform(range(1, length(r) - {w - 2}),
                   lambda i: substr(r, i, {w}))) AS win
  FROM (SELECT DISTINCT x, r FROM random)
),
bits AS (
  SELECT x, max(list_sum(list_transform(list_distinct(string_split(win, '')), lambda c:
    -((length(win) - length(replace(win, c, ''))) / {width})
    * log2((length(win) - length(replace(win, c, ''))) / {width})))) AS bits
  FROM windows GROUP BY x
),
added AS (
  SELECT doc_id, kind, s, s + length(x) AS e
  FROM random JOIN bits USING (x)
  WHERE bits >= CASE
      WHEN regexp_full_match(left_over, '[0-9A-Fa-f]+') THEN {bits["hex"]}
      WHEN regexp_full_match(left_over, '[0-9A-Za-z]+=*') AND regexp_matches(left_over, '[0-9]')
        AND regexp_matches(left_over, '[A-Za-z]') THEN {bits["alnum"]}
      WHEN regexp_matches(left_over, '[0-9]') AND regexp_matches(left_over, '[A-Z]')
        AND regexp_matches(left_over, '[a-z]') THEN {bits["mixed"]}
      WHEN NOT regexp_matches(left_over, '[0-9]') THEN {bits["letters"]}
      ELSE {bits["other"]} END
    AND NOT regexp_matches(before, '(?i)(sha-?(1|256|384|512)|md5|commit|checksum|integrity)["'':= -]*$')
    AND NOT regexp_matches(left_over, '(?i)^[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}$')
    AND NOT regexp_matches(left_over, '^[0-9]+$')
),
every AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM added a WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = a.doc_id AND b.s < a.e AND a.s < b.e)
),
sums AS (
  SELECT doc_id, {counts}, {joined} AS spans,
         {joined[:-1]}) FILTER (WHERE kind < {len(secrets.BASE)}) AS base
  FROM every GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in kinds)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN sums USING (doc_id)"""


_NEAR_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 4 THEN [w]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i : i + 3]) END)) AS s
  FROM words WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 80 * (x.n + y.n - c)
),
nodes AS (SELECT doc_id AS node FROM documents),{_components("nodes", "links")}
SELECT node AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, root AS component_id,
       node = root AS kept
FROM labels LEFT JOIN sizes ON node = doc_id"""


_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
         AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
         FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(text) + 24
         + len(regexp_extract_all(text, '<\\*\|im_(start|end)\|>'))) AS BIGINT)
         AS formatted_chars
FROM turns GROUP BY conv_id"""


_VECTOR_SQL = f"""
WITH RECURSIVE units AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM units x JOIN units y
  ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
     AND list_cosine_similarity(x.e, y.e) >= {vectors.COSINE}
),
nodes AS (SELECT vec_id AS node FROM embeddings),{_components("nodes", "links")},
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT node AS vec_id, coalesce(n, 0) AS n_links, root AS component_id, node = root AS kept
FROM labels LEFT JOIN degrees ON node = a"""


def _crc_table() -> list[int]:
    """The byte table of CRC-32, from its polynomial."""
    table = list(range(256))
    for _ in range(8):
        table = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in table]
    return table


def _crc32(numbers: str) -> str:
    """The unsigned CRC-32 of a list of bytes."""
    step = f"xor(a >> 8, (CAST({_crc_table()} AS BIGINT[]))[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce({numbers}, lambda a, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _bytes(text: str) -> str:
    digits = f"regexp_extract_all(hex(encode({text})), '..')"
    return f"list_transform({digits}, lambda y: CAST('0x' || y AS BIGINT))"


def _shard_sql() -> str:
    ahead = (
        "floor((shard + 1) * (CAST(2147483648 AS DOUBLE) / (CAST(key >> 33 AS DOUBLE) + 1)))"
    )
    following = f"(key * {sharding.MULTIPLIER} + 1) % 18446744073709551616"
    return f"""
WITH RECURSIVE sized AS (
  SELECT row_number() OVER () AS row, doc_id,
         octet_length(encode(coalesce(text, ''))) + 8 AS size,
         {_bytes("coalesce(text, '')")} AS bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS UHUGEINT) AS key
  FROM documents
),
jumps AS (
  SELECT row, {following} AS key, CAST(0 AS BIGINT) AS shard, shards
  FROM sized, (VALUES ({sharding.SHARDS}), ({sharding.SHARDS} + 1)) AS counts(shards)
  UNION ALL
  SELECT row, {following}, CAST({ahead} AS BIGINT), shards FROM jumps WHERE {ahead} < shards
),
last AS (
  SELECT row, max(shard) FILTER (WHERE shards = {sharding.SHARDS}) AS shard,
         max(shard) FILTER (WHERE shards > {sharding.SHARDS}) AS grown
  FROM jumps GROUP BY row
),
placed AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, {_crc32("bytes")} AS text_crc32, shard, grown
  FROM sized JOIN last USING (row)
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard
         ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(grown AS INTEGER) AS grown_shard
FROM placed"""


_TRIE_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '')
           || coalesce(text, '')) AS said,
         sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '')
           || coalesce(text, '')) AS rank,
         octet_length(encode(coalesce(text, ''))) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list({{'said': said, 'bytes': bytes}} ORDER BY turn NULLS FIRST, rank) AS said,
         {_crc32(_bytes("CAST(conv_id AS VARCHAR)"))} % {trie.SHARED} AS h
  FROM turns GROUP BY conv_id
),
paths AS (
  SELECT o.conv_id, coalesce(b.said[1 : o.h], []) || o.said[o.h + 1 :] AS path
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % {trie.FAMILY}
),
prefixes AS (
  SELECT conv_id, unnest(range(len(path) + 1)) AS depth, path FROM paths
),
nodes AS (
  SELECT list_transform(path[1 : depth], lambda t: t.said) AS node, depth,
         min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(coalesce(path[depth].bytes, 0)) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
           FILTER (WHERE len(path) = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY ALL
),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c
           WHERE c.depth = n.depth + 1 AND c.node[1 : n.depth] = n.node) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1 : n.depth - 1]
),
up AS (
  SELECT node[1 : unnest(range(depth + 1))] AS node, (n_children = 0) AS leaf,
         (n_convs - 1) * if(depth = 0, 0, bytes) AS saved
  FROM linked
),
totals AS (
  SELECT node, count(*) FILTER (WHERE leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved
  FROM up GROUP BY node
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved AS saved_tokens,
       ends_sha256
FROM linked JOIN totals USING (node)"""


ORACLE: dict[str, str] = {
    "op2_secret_scan": _secret_sql(),
    "op3_license_scan": _license_sql(),
    "op4_minhash_near_dedup": _NEAR_SQL,
    "op7_chat_formatting": _CHAT_SQL,
    "op10_embedding_near_dedup": _VECTOR_SQL,
    "op11_sharding": _shard_sql(),
    "op13_conversation_trie": _TRIE_SQL,
}
