"""SQL of the llm queries that DuckDB can express, over whole tables.

Record files and tokenizer ids (3, 4), byte models (5) and hashed n-gram models (10) have no SQL;
the tests compare these queries with brute-force versions.
"""

from __future__ import annotations

from cabrank.llm import divergence, licenses, secrets, shards, spelling

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


def _alnum_words(text: str) -> str:
    return rf"regexp_extract_all({_low(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _blank_words(text: str) -> str:
    return rf"regexp_extract_all({_low(text)}, '[^\x20\x09-\x0D]+')"


def _uniform(name: str) -> str:
    digits = f"('0x' || substr(md5(concat_ws('|', k, '{name}')), 1, 13))::BIGINT"
    return f"(({digits} + 0.5::DOUBLE) / {2.0**52}::DOUBLE)"


def _draw(node: shards.Node) -> str:
    """The child of the lowest draw, by its name where draws are equal."""
    children = node.children
    if len(children) == 1:
        return f"'{children[0].name}'"
    draws = ", ".join(
        f"{{'d': -ln({_uniform(c.name)}) / {float(c.weight)}::DOUBLE, 'n': '{c.name}'}}" for c in children
    )
    return f"list_min([{draws}]).n"


def _level(at: str, nodes: list[shards.Node]) -> str:
    return "CASE " + " ".join(f"WHEN {at} = '{n.name}' THEN {_draw(n)}" for n in nodes) + " END"


def _placed(source: str, tree: shards.Node, prefix: str) -> str:
    racks = [rack for region in tree.children for rack in region.children]
    leaves = ", ".join(f"'{leaf.name}': {leaf.shard}" for rack in racks for leaf in rack.children)
    region, rack = f"{prefix}region", f"{prefix}rack"
    return f"""
        SELECT *, CAST((MAP {{{leaves}}})[leaf] AS INTEGER) AS {prefix}shard FROM (
            SELECT *, {_level(rack, racks)} AS leaf FROM (
                SELECT *, {_level(region, list(tree.children))} AS {rack} FROM (
                    SELECT *, {_draw(tree)} AS {region} FROM {source})))
    """


# crc32, byte by byte over a table of 256 entries that is computed first.
_CRC = """
bits AS (
    SELECT i AS b, list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)
), tab AS (SELECT list(c ORDER BY b) AS t FROM bits)
"""
_CRC_OF = """
xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))
"""

_OP1 = f"""
WITH {_CRC}, raw AS (
    SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, hex(encode(coalesce(text, ''))) AS h
    FROM documents
), docs AS (
    SELECT doc_id, k, CAST(length(h) // 2 + 8 AS BIGINT) AS size,
        list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS bytes
    FROM raw
), summed AS (SELECT doc_id, k, size, CAST({_CRC_OF} AS BIGINT) AS text_crc32 FROM docs, tab),
grown AS ({_placed("summed", shards.tree_of(25), "grown_")}),
placed AS ({_placed("(SELECT * EXCLUDE (leaf) FROM grown)", shards.tree_of(24), "")}),
dealt AS (
    SELECT *, ('0x' || substr(md5(concat_ws('|', k, text_crc32, size)), 1, 8))::BIGINT
        % {shards.BUCKETS} AS bucket
    FROM placed
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
    grown_shard, region, rack
FROM dealt
"""

_TEMPLATES = ", ".join(
    f"({i}, '{label}', '" + text.replace("'", "''") + "')" for i, (label, text) in enumerate(licenses.TEMPLATES)
)
_PLACES = " UNION ALL ".join(
    f"""SELECT d, i AS place, '{label}' AS label FROM docs, unnest(range(len(w))) AS u(i)
        WHERE w[i + 1 : i + {len(phrase.split())}] = {phrase.split()}"""
    for phrase, label in licenses.PHRASES
)

_OP7 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id, {_alnum_words("text")} AS w FROM documents
), places AS ({_PLACES}),
templates AS (
    SELECT t, label, list_distinct(said) AS tokens, 2 * len(said) AS width,
        greatest(1, ceil({licenses.THRESHOLD} * len(list_distinct(said)) - 1e-9)) AS need
    FROM (SELECT t, label, {_alnum_words("body")} AS said FROM (VALUES {_TEMPLATES}) AS v(t, label, body))
    WHERE len(said) > 0
), near AS (
    SELECT d, w, t FROM (SELECT *, list_distinct(w) AS own FROM docs), templates
    WHERE len(list_intersect(tokens, own)) >= need
), found AS (
    SELECT d, t, i, w[i] AS word
    FROM near JOIN templates USING (t), unnest(range(1, len(w) + 1)) AS u(i) WHERE list_contains(tokens, w[i])
), blocks AS (
    SELECT a.d, a.t, a.i, count(DISTINCT b.word) AS shared
    FROM found a JOIN templates USING (t) JOIN found b ON b.d = a.d AND b.t = a.t AND b.i >= a.i AND b.i < a.i + width
    GROUP BY a.d, a.t, a.i
), matches AS (
    SELECT d, label, shared / len(tokens) AS share FROM blocks JOIN templates USING (t) WHERE shared >= need
), base AS (
    SELECT d, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY d
), both_labels AS (
    SELECT d, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM (SELECT d, label, 0.0::DOUBLE AS share FROM places UNION ALL SELECT d, label, share FROM matches)
    GROUP BY d
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN base USING (d) LEFT JOIN both_labels USING (d)
"""

_OP8 = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_blank_words("text")} AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w]
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i : i + 1])) END AS s
    FROM docs
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id != b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id, doc_id AS seen FROM documents
    UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.seen
), least AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""

_OP9 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id, {_alnum_words("text")} AS w FROM documents
), items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_alnum_words("text")} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(10, len(w)) AS size, w[i : i + least(10, len(w)) - 1] AS gram
    FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT d, i, size, w[i : i + size - 1] AS gram
    FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)
), hits AS (SELECT d, i, p.size, item FROM places p JOIN windows USING (size, gram)),
covered AS (
    SELECT d, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(size)) AS u(k) GROUP BY d
), found AS (
    SELECT d, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
    FROM hits GROUP BY d
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (d) LEFT JOIN found USING (d)
"""



def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _matches(pattern: str, rank: int) -> str:
    """Each match of a pattern with its start: what stands between and before it, added up."""
    p = _quoted(pattern)
    return f"""
        SELECT d, {rank} AS rank, m[i] AS body, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS place
        FROM (SELECT d, regexp_extract_all(t, {p}) AS m, regexp_split_to_array(t, {p}) AS g
              FROM docs WHERE regexp_matches(t, {p})), unnest(range(1, len(m) + 1)) AS u(i)
    """


_KINDS = ", ".join(f"({i}, '{kind}')" for i, kind in enumerate(secrets.KINDS))
_ALLOWED = " OR ".join(f"regexp_matches(body, {_quoted(p)})" for p in secrets.ALLOWED)
_W = secrets.WINDOW


def _class_runs(i: int) -> str:
    """Maximal runs of a class that are not wholly of a narrower one, and what they have to reach."""
    c = secrets.CLASSES[i]
    narrower = "|".join(n.pattern for n in secrets.CLASSES[:i])
    other = f"AND NOT regexp_full_match(body, '{narrower}')" if narrower else ""
    return f"""
        SELECT d, rank, place, body, {c.bits}::DOUBLE AS least, {i + 1 < len(secrets.CLASSES)} AS whole
        FROM ({_matches(secrets.run_of(c, _W), 3 + i)}) WHERE NOT ({_ALLOWED}) {other}
    """


_RUNS = " UNION ALL ".join(_class_runs(i) for i in range(len(secrets.CLASSES)))

_OP2 = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS t FROM documents),
assign AS ({_matches(_ASSIGN, 0)}), access AS ({_matches(secrets.ACCESS, 1)}), hex AS ({_matches(secrets.HEX, 2)}),
runs AS ({_RUNS}), letters AS (
    SELECT d, rank, place, i, unnest(string_split(substr(body, i, {_W}), '')) AS letter
    FROM runs, unnest(range(1, length(body) - {_W} + 2)) AS u(i)
), rated AS (
    SELECT d, rank, place, i, -sum(n / {_W} * log2(n / {_W})) AS bits
    FROM (SELECT d, rank, place, i, letter, count(*) AS n FROM letters GROUP BY ALL) GROUP BY ALL
), found AS (
    SELECT d, rank, place, any_value(whole) AS whole, any_value(length(body)) AS n, min(i) AS low, max(i) AS high
    FROM rated JOIN runs USING (d, rank, place) WHERE bits >= least - 1e-9 GROUP BY d, rank, place
), spans AS (
    SELECT d, rank, place AS s, place + length(body) AS e FROM assign
    WHERE length(regexp_extract(body, {_quoted(_ASSIGN)}, 2)) >= {secrets.ASSIGN_LENGTH}
    UNION ALL SELECT d, rank, place, place + length(body) FROM access
    UNION ALL SELECT d, rank, place, place + length(body) FROM hex
    UNION ALL SELECT d, rank, CASE WHEN whole THEN place ELSE place + low - 1 END,
        CASE WHEN whole THEN place + n ELSE place + high - 1 + {_W} END FROM found
), said AS (
    SELECT d, rank, s, concat_ws(':', kind, s, e) AS said
    FROM spans JOIN (VALUES {_KINDS}) AS k(rank, kind) USING (rank)
), listed AS (
    SELECT d, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
        count(*) FILTER (rank = 2) AS n_hex, string_agg(said, ',' ORDER BY s, rank) AS spans,
        string_agg(said, ',' ORDER BY s, rank) FILTER (rank < 3) AS base
    FROM said GROUP BY d
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (d)
"""

_PEELED = "".join(
    f", q{i} AS (SELECT *, regexp_replace(r{i}, {_quoted(pattern)}, '', 'g') AS r{i + 1} FROM q{i - 1})"
    if i
    else f", q0 AS (SELECT *, regexp_replace(r0, {_quoted(pattern)}, '', 'g') AS r1 FROM docs)"
    for i, (_, pattern) in enumerate(divergence.CHAR_CLASSES)
)
_N = len(divergence.CHAR_CLASSES)
_CHARS = ", ".join(f"length(r{i}) - length(r{i + 1})" for i in range(_N)) + f", length(r{_N})"
_LISTS = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in divergence._word_lists().items()) + "}"
_SAME = "len(list_filter(low, lambda x: x = c))"


def _distance(own: str, ref: str) -> str:
    """Square root of half the summed divergences from the mean, over the bins of two lists."""
    part = lambda x, y: f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({x} + {y})) ELSE 0 END"
    p, q = f"{own}[i]", f"{ref}[i]"
    total = f"list_sum(list_transform(range(1, len({own}) + 1), lambda i: {part(p, q)} + {part(q, p)}))"
    return f"CASE WHEN {ref} IS NOT NULL THEN round(sqrt(greatest({total} / 2, 0)), 6) END"


_OP6 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS r0,
        CASE WHEN lower(lang) IN {tuple(divergence.COMMON_WORDS)} THEN lower(lang) ELSE 'other' END AS lang,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
){_PEELED},
windows AS (
    SELECT d, i, w[i : i + 7] AS gram FROM docs, unnest(range(1, len(w) - 6)) AS u(i)
), twice AS (SELECT d, gram FROM windows GROUP BY d, gram HAVING count(*) > 1),
repeats AS (
    SELECT d, count(DISTINCT i + k) AS n_repeat_words
    FROM windows JOIN twice USING (d, gram), unnest(range(8)) AS v(k) GROUP BY d
), counted AS (
    SELECT d, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(r0) - length(r2) + length(r3) AS BIGINT) AS word_chars,
        CAST(length(r5) - length(r6) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        [{_CHARS}] AS chars, list_transform(w, lambda x: lower(x)) AS low
    FROM q{_N - 1} LEFT JOIN repeats USING (d)
), binned AS (
    SELECT *, n_words < {divergence.LEAST_WORDS}
            OR 100 * n_repeat_words > {divergence.REPEAT_PERCENT} * n_words AS base_failed,
        list_transform(({_LISTS})[lang], lambda c: {_SAME}) AS found
    FROM counted
), shares AS (
    SELECT *, list_transform(chars, lambda x: x / greatest(list_sum(chars), 1)) AS c,
        list_transform(list_append(found, n_words - list_sum(found)), lambda x: x / greatest(n_words, 1)) AS s
    FROM binned
), usable AS (SELECT * FROM shares WHERE NOT base_failed AND n_words >= {divergence.MIN_WORDS}),
char_refs AS (
    SELECT lang, list(m ORDER BY i) AS ref_c
    FROM (SELECT lang, i, avg(c[i]) AS m FROM usable, unnest(range(1, len(c) + 1)) AS u(i) GROUP BY lang, i)
    GROUP BY lang
), word_refs AS (
    SELECT lang, list(m ORDER BY i) AS ref_s
    FROM (SELECT lang, i, avg(s[i]) AS m FROM usable, unnest(range(1, len(s) + 1)) AS u(i) GROUP BY lang, i)
    GROUP BY lang
), far AS (
    SELECT *, {_distance("c", "ref_c")} AS char_distance, {_distance("s", "ref_s")} AS word_distance
    FROM shares LEFT JOIN char_refs USING (lang) LEFT JOIN word_refs USING (lang)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance,
    word_distance, NOT base_failed AND NOT (n_words >= {divergence.MIN_WORDS}
        AND coalesce(char_distance > {divergence.MAX_CHAR_DISTANCE}
            OR word_distance > {divergence.MAX_WORD_DISTANCE}, false)) AS kept
FROM far
"""

_OP11 = rf"""
WITH {_CRC}, turns AS (
    SELECT c, k, w, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS i
    FROM (
        SELECT conv_id AS c, turn, md5(md5(coalesce(role, '')) || coalesce(text, '')) AS k,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
        FROM conversations WHERE conv_id IS NOT NULL)
), named AS (
    SELECT c, list_transform(range(length(h) // 2),
        lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS bytes
    FROM (SELECT DISTINCT c, hex(encode(CAST(c AS VARCHAR))) AS h FROM turns)
), convs AS (SELECT c, c - c % 20 AS base, {_CRC_OF} % 4 AS h FROM named, tab),
steps AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d, k, w FROM (
        SELECT v.c, false AS own, t.i, t.k, t.w FROM convs v JOIN turns t ON t.c = v.base AND t.i <= v.h
        UNION ALL
        SELECT v.c, true, t.i, t.k, t.w FROM convs v JOIN turns t ON t.c = v.c AND t.i > v.h)
), paths AS (
    SELECT c, d, w, md5(string_agg(k, '') OVER (PARTITION BY c ORDER BY d)) AS p FROM steps
    UNION ALL SELECT c, 0, 0, '' FROM convs
), nodes AS (
    SELECT d, p, min(c) AS conv_id, count(*) AS n, any_value(w) AS w FROM paths GROUP BY d, p
), ends AS (
    SELECT d, p, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
    FROM paths JOIN (SELECT c, max(d) AS d FROM paths GROUP BY c) USING (c, d) GROUP BY d, p
), linked AS (
    SELECT n.*, up.conv_id AS parent_conv_id, up.p AS above
    FROM nodes n LEFT JOIN paths q ON q.c = n.conv_id AND q.d = n.d - 1
    LEFT JOIN nodes up ON up.d = q.d AND up.p = q.p
), children AS (SELECT d - 1 AS d, above AS p, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY 1, 2),
sums AS (
    SELECT a.d, a.p, sum((n.n - 1) * n.w) AS saved, count(*) FILTER (k.n_children IS NULL) AS leaves
    FROM nodes n JOIN paths a ON a.c = n.conv_id AND a.d <= n.d
    LEFT JOIN children k ON k.d = n.d AND k.p = n.p GROUP BY a.d, a.p
)
SELECT conv_id, d AS depth, parent_conv_id, n AS n_convs, coalesce(n_children, 0) AS n_children,
    CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
    sha256(coalesce(ids, '')) AS ends_sha256
FROM linked JOIN sums USING (d, p) LEFT JOIN children USING (d, p) LEFT JOIN ends USING (d, p)
"""

_OP12 = rf"""
WITH RECURSIVE {_CRC}, runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all({_low("text")}, '{spelling.RUN}')) AS run
        FROM documents) GROUP BY ALL
), named AS (
    SELECT run, n, list_transform(range(length(h) // 2),
        lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS bytes
    FROM (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs)
), hashed AS (SELECT run, n, {_CRC_OF} AS h FROM named, tab),
words AS (
    SELECT CASE WHEN h % 97 = 0
        THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
        ELSE run END AS word, n
    FROM hashed
), vocab AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
), cuts AS (
    SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, CAST(unnest(range(length(word))) AS INTEGER) AS i FROM vocab)
), pairs AS (
    SELECT a.word AS a, b.word AS b, b.n AS n FROM cuts a JOIN cuts b USING (i, rest) WHERE a.word != b.word
    UNION SELECT c.word, v.word, v.n FROM cuts c JOIN vocab v ON v.word = c.rest
    UNION SELECT v.word, c.word, c.n FROM cuts c JOIN vocab v ON v.word = c.rest
), ranked AS (
    SELECT a AS word, b, n AS form_n, count(*) OVER (PARTITION BY a) AS n_near,
        row_number() OVER (PARTITION BY a ORDER BY n DESC, encode(b)) AS r
    FROM pairs
), judged AS (
    SELECT v.word, CASE WHEN form_n >= 2 * v.n THEN b END AS form, v.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN form_n >= 2 * v.n THEN form_n END AS form_n
    FROM vocab v LEFT JOIN (SELECT * FROM ranked WHERE r = 1) USING (word)
), up AS (
    SELECT word, word AS root, 0 AS d FROM judged
    UNION ALL SELECT up.word, j.form, d + 1 FROM up JOIN judged j ON j.word = up.root WHERE j.form IS NOT NULL
), last AS (SELECT word, arg_max(root, d) AS root FROM up GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN last USING (word)
"""

ORACLE: dict[str, str] = {
    "op2_entropy_secrets": _OP2,
    "op1_weighted_hash_tree": _OP1,
    "op6_distribution_divergence": _OP6,
    "op7_license_containment": _OP7,
    "op8_multi_index_hamming": _OP8,
    "op9_decontaminate_windows": _OP9,
    "op11_prefix_trie": _OP11,
    "op12_spelling_variants": _OP12,
}
