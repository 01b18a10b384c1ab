"""The results of the registered queries in SQL, where SQL can express them."""

from courtlens.llm.mix_sources import permutation

# Empty strings go: a word has at least one character.
_WORDS_BETWEEN = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_ALNUM = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
        SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)),
dw AS (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
        SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT r, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.t = bw.t),
words AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
           sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
    FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP10 = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS_BETWEEN.format(text="coalesce(text, '')")} AS w
    FROM documents),
win AS (
    SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS t FROM (
        SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
low AS (SELECT t, min(doc_id) AS first FROM win GROUP BY t HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM win JOIN low USING (t) WHERE first < doc_id),
words AS (
    SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (r, p)
    GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP2 = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
low AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM low
"""

# The least draw among the children of one level; path is SQL text, children (child, weight) rows.
_DRAW = "-ln((('0x' || substr(md5(key || '/' || {path} || child), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"


def _level(name: str, source: str, path: str, on: str, children: str) -> str:
    draw = _DRAW.format(path=path)
    return f"""{name} AS (
    SELECT {source}.*, best.child AS {name} FROM {source} JOIN (
        SELECT r, arg_min(child, {draw} / weight) AS child
        FROM {source} JOIN (VALUES {children}) AS t(parent, child, weight) ON {on} GROUP BY r) best USING (r))"""


def _tree(prefix: str, regions: str, racks: str, leaves: str) -> str:
    """Regions, racks by region and leaves by 10 * region + rack, as (parent, child, weight)."""
    region, rack, leaf = f"{prefix}_region", f"{prefix}_rack", f"{prefix}_leaf"
    return ",\n".join(
        [
            _level(region, "d", "''", "TRUE", regions),
            _level(rack, region, f"{region} || '/'", f"parent = {region}", racks),
            _level(
                leaf, rack, f"{region} || '/' || {rack} || '/'", f"parent = 10 * {region} + {rack}", leaves
            ),
        ]
    )


_RACKS = "(0, 0, 4), (0, 1, 4), (1, 0, 4), (1, 1, 4)"
_LEAVES = ", ".join(f"({p}, {c}, 1)" for p in (0, 1, 10, 11) for c in range(4))

# CRC-32 over the bytes of each text, with its table made by eight steps of the polynomial.
_CRC = """
steps AS (SELECT i, list_reduce([i] || range(8), lambda c, x: CASE WHEN c & 1 = 1
          THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS c FROM range(256) t(i)),
crcs AS (SELECT list(c ORDER BY i) AS crc FROM steps),
texts AS (SELECT DISTINCT coalesce(text, '') AS t FROM documents),
bytes AS (SELECT t, hex(encode(t)) AS h FROM texts),
sums AS (
    SELECT t, xor(4294967295, list_reduce(
        [4294967295::BIGINT] || list_transform(range(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT),
        lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) AS text_crc32
    FROM bytes, crcs)"""

OP7 = f"""
WITH {_CRC},
d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::VARCHAR, '') AS key,
           (octet_length(encode(t)) + 1)::BIGINT AS size, text_crc32
    FROM documents JOIN sums ON t = coalesce(text, '')),
{_tree("a", "(0, 0, 8), (0, 1, 8)", _RACKS, _LEAVES)},
{_tree("b", "(0, 0, 8), (0, 1, 8), (0, 2, 1)", _RACKS + ", (2, 0, 1)", _LEAVES + ", (20, 0, 1)")},
placed AS (
    SELECT a_leaf.*, 8 * a_region + 4 * a_rack + a_leaf AS shard,
           8 * b_region + 4 * b_rack + b_leaf AS grown_shard,
           ('0x' || substr(md5(key || '/' || size || '/' || text_crc32), 1, 13))::BIGINT AS place
    FROM a_leaf JOIN (SELECT r, b_region, b_rack, b_leaf FROM b_leaf) USING (r))
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY place, key, size, text_crc32) - 1 AS slot,
       grown_shard::INTEGER AS grown_shard
FROM placed
"""

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
terms AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d),
stats AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, t, count(*) AS tf FROM terms GROUP BY r, t),
w AS (
    SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tf, stats GROUP BY t, n_docs),
i AS (
    SELECT item_id, text, t, count(*) AS q
    FROM (SELECT item_id, text, unnest({_ALNUM}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark))
    GROUP BY item_id, text, t),
scores AS (
    SELECT item_id, i.text, r, any_value(doc_id) AS doc_id,
           sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM i JOIN tf USING (t) JOIN w USING (t), stats GROUP BY item_id, i.text, r),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank
    FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def _permuted(x: str, n: str, key: str, source: str) -> str:
    """SQL of ``source`` with column b: where the permutation of a source takes ``x``."""
    sql, steps = source, permutation(x, n, key, 42, "at")
    for step in sum(steps, []):
        sql = f"SELECT *, {step.replace(' div ', ' // ')} FROM ({sql})"
    return f"SELECT *, at_x{len(steps) - 2} AS b FROM ({sql})"


OP12 = f"""
WITH d AS (
    SELECT doc_id, source, len({_WORDS_BETWEEN.format(text="coalesce(text, '')")})::BIGINT AS size FROM documents),
s AS (
    SELECT *, [3, 1, 2][number % 3 + 1] AS weight FROM (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
        FROM d GROUP BY source)),
levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS own
    FROM s WINDOW before AS (ORDER BY source_size::DOUBLE / weight, number
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
    SELECT coalesce(first(own ORDER BY source_size::DOUBLE / weight, number)
                    FILTER (WHERE weight * own < 2 * source_size), 0) AS level FROM levels),
t AS (
    SELECT source, source_size, number, (source_size + 63) // 64 AS blocks,
           CASE WHEN weight * level >= 2 * source_size THEN 2.0::DOUBLE * source_size ELSE weight * level END AS target
    FROM s, level),
plan AS (
    SELECT *, CASE WHEN 2 * (rest - 64 * n_full) >= source_size - 64 * n_full THEN blocks
                   ELSE least(n_full, floor(rest / 64 + 0.5)) END AS more
    FROM (SELECT *, floor(target / source_size)::BIGINT AS rounds, source_size // 64 AS n_full,
                 target - floor(target / source_size) * source_size AS rest FROM t WHERE source_size > 0)),
b AS ({_permuted("place", "n_full", "number", "SELECT *, unnest(range(n_full)) AS place FROM plan")}),
taken_blocks AS (
    SELECT source, b, rounds + (place < more)::BIGINT AS times FROM b
    UNION ALL SELECT source, n_full, rounds + (n_full < more)::BIGINT FROM plan WHERE blocks > n_full),
placed AS (
    SELECT row_number() OVER () AS r, *, coalesce(sum(size) OVER (
        PARTITION BY source ORDER BY doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o
    FROM d),
pieces AS (
    SELECT r, source, b, least((b + 1) * 64, o + size) - greatest(b * 64, o) AS words
    FROM (SELECT *, unnest(range(o // 64, (o + size - 1) // 64 + 1)) AS b FROM placed WHERE size > 0)),
taken AS (
    SELECT r, sum(words * times)::BIGINT AS taken FROM pieces p
    JOIN taken_blocks k ON p.source IS NOT DISTINCT FROM k.source AND p.b = k.b GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM placed LEFT JOIN taken USING (r) JOIN t ON placed.source IS NOT DISTINCT FROM t.source
"""

OP13 = f"""
WITH RECURSIVE {_CRC.split("texts AS")[0].rstrip().rstrip(",")},
runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
    GROUP BY doc_id, run),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        [4294967295::BIGINT] || list_transform(range(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT),
        lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) AS h
    FROM (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs WHERE length(run) >= 5), crcs),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
        FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS (
    SELECT word, n, i, word[:i - 1] || '.' || word[i + 1:] AS replaced, word[:i - 1] || word[i + 1:] AS deleted
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS near, b.n FROM holes a JOIN holes b ON a.i = b.i AND a.replaced = b.replaced AND a.word <> b.word
    UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.deleted = w.word
    UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.deleted = w.word),
best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS form, max(n) AS form_n FROM near GROUP BY word),
forms AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * words.n THEN form END AS form,
           CASE WHEN form_n >= 2 * words.n THEN form_n END AS form_n
    FROM words LEFT JOIN best USING (word)),
ways AS (
    SELECT word, word AS root FROM forms WHERE form IS NULL
    UNION ALL SELECT forms.word, ways.root FROM forms JOIN ways ON forms.form = ways.word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ways USING (word)
"""

ORACLE_SQL = {
    "op2_sharded_warc": OP2,
    "op4_winnow_decontaminate": OP4,
    "op7_hash_tree_shards": OP7,
    "op10_automaton_substring_dedup": OP10,
    "op11_bag_ranked_search": OP11,
    "op12_block_mix": OP12,
    "op13_gram_spelling_variants": OP13,
}
