"""DuckDB statements for the queries that SQL can express; each takes another way than the operator."""

# CRC-32 of a decimal text, bit by bit: a character's code goes in, then come eight shifts.
_CRC32 = """xor(list_reduce(flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: list_concat([ascii(x)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[]))),
    lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT), 4294967295::BIGINT)"""


def _clusters(rounds: int = 10, k: int = 8) -> str:
    """Every round written out: distances to all centroids, then floored means."""
    steps = [f"""
vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS n, v AS c FROM (SELECT sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM vectors) ORDER BY h, v LIMIT {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d * {k} + n) % {k} AS n, min(d) AS d FROM (
    SELECT row, vec_id, v, n, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM vectors, c{r}) GROUP BY row)""")
        if r < rounds:
            steps.append(f"""
m{r} AS MATERIALIZED (
  SELECT n, list((s - ((s % m) + m) % m) // m ORDER BY i)::BIGINT[] AS c FROM (
    SELECT n, i, sum(x) AS s, count(*) AS m FROM (SELECT n, unnest(v) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY n, i) GROUP BY n),
c{r + 1} AS MATERIALIZED (SELECT n, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (n))""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, n::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY n))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (n)"""


ORACLE: dict[str, str] = {
    # Sorts every source by hash and sums; the operator only has histograms.
    "op2_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS hash
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source),
ratios AS (SELECT *, 2.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS pos FROM sources),
levels AS (
  SELECT a.pos, any_value(a.source) AS source, any_value(a.source_size) AS source_size, any_value(a.weight) AS weight, any_value(a.cap) AS cap,
         ((SELECT sum(source_size)::DOUBLE * 1.5::DOUBLE FROM sources) - coalesce(sum(b.cap) FILTER (b.pos < a.pos), 0)) / sum(b.weight) FILTER (b.pos >= a.pos) AS level
  FROM ratios a CROSS JOIN ratios b GROUP BY a.pos),
settled AS (SELECT min(pos) AS first_open, arg_min(level, pos) AS level FROM levels WHERE weight * level < cap),
targets AS (
  SELECT l.source, l.source_size, CASE WHEN f.first_open IS NULL OR l.pos < f.first_open THEN l.cap ELSE l.weight * f.level END AS target
  FROM levels l, settled f),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
hashes AS (SELECT source, hash, sum(size) AS size FROM sized GROUP BY ALL),
sums AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY hash) AS passed FROM hashes),
cuts AS (
  SELECT s.source, min(s.hash + CASE WHEN s.passed > b.target - b.whole * b.source_size AND 2 * (b.target - b.whole * b.source_size - s.passed + s.size) < s.size THEN 0 ELSE 1 END)
           FILTER (s.passed > b.target - b.whole * b.source_size) AS below
  FROM sums s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source GROUP BY s.source)
SELECT d.doc_id, d.size, b.source_size, b.target,
       d.size * (b.whole + CASE WHEN b.target - b.whole * b.source_size > 0 AND d.hash < c.below THEN 1 ELSE 0 END)::BIGINT AS taken
FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
""",
    # Joins all windows of ten words by value.
    "op3_decontamination": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size)),
hits AS (SELECT p.doc_id, p.i, p.size, x.item_id FROM places p JOIN windows x ON p.size = x.size AND p.win = x.win),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(i.listed, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
""",
    # Tries every rule on every page.
    "op6_url_rules": r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1) AS path
  FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)),
rules(rhost, rpath, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT page_id, rhost || rpath AS rule, verdict FROM parts, rules
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict FROM parts p LEFT JOIN best b USING (page_id)
""",
    # Digests of the turns as they came in; the operator's come back from its formatted text.
    "op9_chat_format": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\' || chr(10))) + 24)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
""",
    # All prefixes of all conversations, and joins over them in place of rounds.
    "op11_prefix_trie": f"""
WITH turns AS (
  SELECT conv_id, list(struct_pack(d := d, b := b) ORDER BY turn NULLS FIRST, d, b) AS t FROM (
    SELECT conv_id, turn, substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS d,
           octet_length(encode(coalesce(text, '')))::BIGINT AS b
    FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
numbered AS (SELECT conv_id, t, {_CRC32} % 9 AS h FROM turns),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(o.t[1 : c.h], []), c.t[c.h + 1 :]) AS t
  FROM numbered c LEFT JOIN turns o ON o.conv_id = c.conv_id - c.conv_id % 5),
places AS (
  SELECT conv_id, depth, depth = len(t) AS is_end, CASE WHEN depth > 0 THEN t[depth].b ELSE 0 END AS b,
         md5(array_to_string(list_transform(t[1 : depth], lambda x: x.d), ',')) AS node,
         CASE WHEN depth > 0 THEN md5(array_to_string(list_transform(t[1 : depth - 1], lambda x: x.d), ',')) END AS parent
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS depth FROM rebuilt)),
nodes AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM places GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
leaves AS (
  SELECT p.node, count(*) AS n_leaves FROM nodes x JOIN places p ON p.conv_id = x.conv_id AND p.depth <= x.depth
  WHERE x.node NOT IN (SELECT node FROM children) GROUP BY p.node),
saved AS (
  SELECT p.node, sum((x.n_convs - 1) * x.b) AS saved_tokens FROM nodes x JOIN places p ON p.conv_id = x.conv_id AND p.depth <= x.depth GROUP BY p.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children, l.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.node = n.node JOIN leaves l ON l.node = n.node JOIN saved s ON s.node = n.node
""",
    # Compares every vector with every centroid in every round.
    "op12_centroids": _clusters(),
    # Scores every pair.
    "op13_top_k": r"""
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.row AS query, q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
  FROM vectors q JOIN vectors x ON q.vec_id % 100 = 0 AND q.row <> x.row),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST) AS n FROM scores)
SELECT query_id, n::INT AS rank, vec_id, score FROM ranked WHERE n <= 10
""",
}
