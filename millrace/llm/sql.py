"""SQL statements for the operators' queries, written apart from their code."""

from __future__ import annotations

from millrace.llm import licences

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
WORDS = r"[^\x20\x09-\x0D]+"
ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


MIXING = rf"""
WITH d AS (
    SELECT doc_id, source, coalesce('s' || source, '') AS skey,
           CAST(coalesce(len(regexp_extract_all(text, '{WORDS}')), 0) AS BIGINT) AS size,
           md5('8|' || coalesce(CAST(doc_id AS VARCHAR), text, '')) AS h
    FROM documents),
s AS (
    SELECT source, skey, CAST(sum(size) AS BIGINT) AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
    FROM d GROUP BY source, skey),
l AS (
    SELECT *, CAST(source_size * 2 AS DOUBLE) AS cap,
           (sum(source_size) OVER () * 1.5::DOUBLE
              - coalesce(sum(CAST(source_size * 2 AS DOUBLE)) OVER (
                  ORDER BY source_size * 2 / w, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY source_size * 2 / w, source NULLS LAST
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM s),
t AS (
    SELECT skey, source_size,
           coalesce(least(cap, max(CASE WHEN cap > level * w THEN level END) OVER () * w), cap)
             AS target,
           CAST('0x' || substr(md5('8|' || skey), 1, 5) AS BIGINT) AS start
    FROM l),
p AS (
    SELECT d.*, t.source_size, t.target, t.start,
           CASE WHEN t.source_size > 0
                THEN CAST(floor(t.target / t.source_size * 1048576) AS BIGINT) ELSE 0 END AS rate,
           row_number() OVER (
             PARTITION BY d.skey
             ORDER BY length(CAST(size AS VARCHAR)), substr(CAST(size AS VARCHAR), 1, 2), h, size
           ) AS place
    FROM d JOIN t USING (skey))
SELECT doc_id, size, source_size, target,
       size * ((place * rate + start) // 1048576 - ((place - 1) * rate + start) // 1048576)
         AS taken
FROM p"""

DECONTAMINATION = rf"""
WITH b AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
           regexp_extract_all({lowered("text")}, '{ITEM_WORDS}') AS w
    FROM benchmark WHERE text IS NOT NULL),
strings AS (
    SELECT DISTINCT item, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
    FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM b WHERE len(w) > 0)),
d AS (
    SELECT doc_id, regexp_extract_all({lowered("text")}, '{ITEM_WORDS}') AS w FROM documents),
windows AS (
    SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
          FROM d, (SELECT DISTINCT m FROM strings) WHERE len(w) >= m)),
found AS (SELECT doc_id, item, i, windows.m FROM windows JOIN strings USING (m, s)),
places AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""

JACCARD = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all({lowered("text")}, '{WORDS}') AS w FROM documents),
sh AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
          FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
overlap AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id != b.doc_id GROUP BY ALL),
link AS (
    SELECT x, y FROM overlap JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id
    WHERE 100 * k >= 80 * (a.n + b.n - k)),
reach AS (
    SELECT doc_id, doc_id AS r FROM d
    UNION SELECT reach.doc_id, y FROM reach JOIN link ON r = x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, coalesce(k.n_links, 0) AS n_links
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, count(*) AS n_links FROM link GROUP BY x) k USING (doc_id)"""

WARC = """
WITH p AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
f AS (
    SELECT *, CASE WHEN payload_bytes >= 100
                   THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
    FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first != page_id THEN first END AS refers_to
FROM f"""

_SOLID = r"regexp_matches(line, '[^\x20\x09-\x0D]')"

LINE_DEDUP = rf"""
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS no
    FROM documents),
s AS (
    SELECT *, lead(line) OVER w AS next, row_number() OVER w AS i,
           len(regexp_extract_all(line, '{WORDS}')) >= 50 AS long
    FROM l WHERE {_SOLID} WINDOW w AS (PARTITION BY doc_id ORDER BY no)),
c AS (
    SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, no) > 1 AS later,
           next IS NOT NULL
             AND row_number() OVER (PARTITION BY line, next ORDER BY doc_id, no) > 1 AS later_run
    FROM s),
g AS (
    SELECT doc_id, no, later AND long OR later_run
             OR coalesce(lag(later_run) OVER (PARTITION BY doc_id ORDER BY no), false) AS gone
    FROM c),
runs AS (
    SELECT doc_id, count(*) AS n
    FROM (SELECT doc_id, no - row_number() OVER (PARTITION BY doc_id ORDER BY no) AS island
          FROM g WHERE gone)
    GROUP BY doc_id, island),
kept AS (
    SELECT l.doc_id, string_agg(line, chr(10) ORDER BY no) AS text
    FROM l LEFT JOIN g USING (doc_id, no) WHERE NOT coalesce(gone, false) GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n.n_lines, 0) AS n_lines, coalesce(n.n_deleted, 0) AS n_deleted,
       coalesce(r.longest_run, 0) AS longest_run, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted
           FROM g GROUP BY doc_id) n USING (doc_id)
LEFT JOIN (SELECT doc_id, max(n) AS longest_run FROM runs GROUP BY doc_id) r USING (doc_id)
LEFT JOIN kept USING (doc_id)"""


def _field(column: str) -> str:
    value = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


#: For each byte, what eight shifts of the reflected polynomial make of it.
_CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps)"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, where crc_table is joined; null stays null."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    step = "xor(c >> 8, steps[(xor(c, b) & 255) + 1])"
    crc = f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {step}), 4294967295)"
    return f"CASE WHEN {text} IS NOT NULL THEN {crc} END"


def merkle(levels: int) -> str:
    """The manifest of groups and of a forest that so many levels of runs of 16 suffice for.

    All trees grow by one level at a time; one that is down to a node stays as it is. A leaf's
    place at each level is `slot`, what it folds to `fold`, and its siblings are joined to `proof`.
    """
    steps = [
        f"""
n0 AS (
    SELECT coalesce('s' || source, '') AS tree, {_leaf("text")} AS digest,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {_leaf("text")}) - 1 AS pos
    FROM documents),
f0 AS (
    SELECT doc_id, coalesce('s' || source, '') AS tree, {_leaf("text")} AS leaf,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {_leaf("text")}) - 1 AS slot,
           CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0
                THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf("text")} END AS fold,
           '' AS proof
    FROM documents, crc_table)"""
    ]
    for i in range(2 * levels):
        nodes = f"n{i}"
        if i == levels:
            nodes = "forest"
            steps.append(
                f"""
forest AS (
    SELECT '' AS tree, digest, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS pos
    FROM n{i}),
entered AS (
    SELECT f{i}.* EXCLUDE (tree, slot), '' AS tree, pos AS slot, digest AS subroot
    FROM f{i} JOIN forest ON name = f{i}.tree)"""
            )
        folds = "entered" if i == levels else f"f{i}"
        carried = "doc_id, leaf" + (", subroot" if i >= levels else "")
        steps.append(
            f"""
c{i} AS (SELECT tree, count(*) AS size FROM {nodes} GROUP BY tree),
n{i + 1} AS (
    SELECT tree, CASE WHEN max(size) = 1 THEN max(digest)
                      ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest,
           pos // 16 AS pos
    FROM {nodes} JOIN c{i} USING (tree) GROUP BY tree, pos // 16),
f{i + 1} AS (
    SELECT {carried}, f.tree, slot // 16 AS slot,
           CASE WHEN max(size) = 1 THEN max(fold)
                ELSE sha256(string_agg(CASE WHEN pos = slot THEN fold ELSE digest END, '' ORDER BY pos))
           END AS fold,
           max(proof) || coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos != slot), '') AS proof
    FROM (SELECT *, row_number() OVER () AS row FROM {folds}) f
    JOIN {nodes} n ON n.tree = f.tree AND n.pos // 16 = slot // 16 JOIN c{i} ON c{i}.tree = f.tree
    GROUP BY row, {carried}, f.tree, slot)"""
        )
    last = 2 * levels
    return f"""WITH {_CRC_TABLE},{",".join(steps)}
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
       fold = digest AS verified
FROM f{last}, n{last}"""


#: 16 to the 4 leaves a source, and as many sources.
MERKLE = merkle(4)


def centroids(k: int, rounds: int) -> str:
    """Exact assignments of all vectors to all centroids, round by round.

    A floor is taken as an exact remainder off, since integer division rounds towards zero.
    """
    apart = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"""
vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v,
           row_number() OVER () AS row
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
k0 AS (
    SELECT v AS c, row_number() OVER (ORDER BY h, v) - 1 AS cluster
    FROM (SELECT v, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h FROM vectors)
    ORDER BY h, v LIMIT {k})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""
a{i} AS (
    SELECT row, first(vec_id) AS vec_id, first(v) AS v,
           min((CAST({apart} AS BIGINT), cluster)) AS near
    FROM vectors, k{i} GROUP BY row)"""
        )
        if i < rounds:
            steps.append(
                f"""
s{i} AS (
    SELECT cluster, place, sum(x)::BIGINT AS total, count(*) AS n
    FROM (SELECT near[2] AS cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i})
    GROUP BY cluster, place),
k{i + 1} AS (
    SELECT coalesce(m.c, k{i}.c) AS c, k{i}.cluster
    FROM k{i} LEFT JOIN (
        SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY place) AS c
        FROM s{i} GROUP BY cluster) m USING (cluster))"""
            )
    return f"""WITH {",".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, near[1] AS distance,
       CAST(sum(near[1]) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(near[1]) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN k{rounds} ON cluster = near[2]"""


CENTROIDS = centroids(40, 5)

_TEMPLATES = ", ".join(
    f"({i}, '{t.label}', {t.exact}, {t.base}, '{t.text}')" for i, t in enumerate(licences.TEMPLATES)
)

LICENSES = rf"""
WITH t AS (
    SELECT *, len(w) AS size
    FROM (SELECT id, label, exact, base, string_split(text, ' ') AS w
          FROM (VALUES {_TEMPLATES}) x(id, label, exact, base, text))),
tg AS (
    SELECT id, size, label, exact, base, array_to_string(w[spot + 1:spot + 3], ' ') AS gram, spot
    FROM (SELECT *, unnest(range(size - 2)) AS spot FROM t)),
d AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all({lowered("text")}, '{ITEM_WORDS}') AS w
    FROM documents),
dg AS (
    SELECT row, array_to_string(w[pos + 1:pos + 3], ' ') AS gram, pos
    FROM (SELECT row, w, unnest(range(len(w) - 2)) AS pos FROM d)),
votes AS (SELECT row, id, label, exact, base, size, pos - spot AS diagonal, spot
          FROM dg JOIN tg USING (gram)),
whole AS (
    SELECT row, id, label, diagonal, base FROM votes WHERE exact
    GROUP BY row, id, label, base, size, diagonal HAVING count(*) = size - 2),
chains AS (
    SELECT *, sum(far::INT) OVER (PARTITION BY row, id ORDER BY diagonal) AS chain
    FROM (SELECT row, id, diagonal,
                 coalesce(diagonal - lag(diagonal) OVER (PARTITION BY row, id ORDER BY diagonal) > 3, false)
                   AS far
          FROM (SELECT DISTINCT row, id, diagonal FROM votes WHERE NOT exact))),
covers AS (
    SELECT row, id, label, size, chain, min(diagonal + spot) AS first, max(diagonal + spot) + 2 AS last,
           list_distinct(flatten(list([spot, spot + 1, spot + 2]))) AS covered
    FROM votes JOIN chains USING (row, id, diagonal) GROUP BY ALL),
scores AS (
    SELECT row, label, len(covered) / greatest(size, last - first + 1) AS score FROM covers
    UNION ALL SELECT row, label, 1.0::DOUBLE FROM whole),
b AS (
    SELECT row, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM whole WHERE base GROUP BY row),
s AS (
    SELECT row, max(score) AS score,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (score >= 0.8) AS labels
    FROM scores GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0) AS score
FROM d LEFT JOIN b USING (row) LEFT JOIN s USING (row)"""
