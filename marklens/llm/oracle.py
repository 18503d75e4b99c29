"""SQL for the queries of the operators for training data, where SQL can express them.

The others need a trained model, a tokenizer, a greedy balance or a page's
structure; the tests hold them against brute force.
"""

from __future__ import annotations

from marklens.llm.licenses import BASE as PHRASES
from marklens.llm.licenses import DEFAULT as VOTING
from marklens.llm.licenses import MORE as PASSAGES
from marklens.llm.secrets import BASE as FIXED_KINDS
from marklens.llm.secrets import KINDS, LIVE_CHARACTERS, LIVE_LENGTH, SHARED_OWNERS

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"

LSH_FOREST = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
sets AS (
    SELECT doc_id, CASE
        WHEN len(words) >= 5 THEN list_distinct(list_transform(
            range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
        WHEN len(words) > 0 THEN ['short ' || array_to_string(words, ' ')]
        ELSE [] END AS shingles
    FROM worded
),
single AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb,
        count(*) AS common
    FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY ALL
),
links AS (SELECT a, b FROM shared WHERE 100 * common >= 85 * (na + nb - common)),
reached AS (
    SELECT doc_id AS start, doc_id AS seen FROM documents
    UNION
    SELECT start, b FROM reached JOIN links ON seen = a
)
SELECT sets.doc_id, len(shingles)::BIGINT AS n_shingles, component_id,
    sets.doc_id = component_id AS kept
FROM sets JOIN (SELECT start, min(seen) AS component_id FROM reached GROUP BY start)
    ON start = sets.doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    kinds = ", ".join(
        f"({rank}, '{k.name}', {_quoted(k.pattern)}, {k.group}, {k.least})"
        for rank, k in enumerate(KINDS)
    )
    # The group to extract has to be a constant.
    values = " ".join(
        f"WHEN {rank} THEN regexp_extract_all(txt, {_quoted(k.pattern)}, {k.group})"
        for rank, k in enumerate(KINDS)
    )
    wholes = " ".join(
        f"WHEN {rank} THEN regexp_extract_all(txt, {_quoted(k.pattern)}, 0)"
        for rank, k in enumerate(KINDS)
    )
    pieces = " ".join(
        f"WHEN {rank} THEN string_split_regex(txt, {_quoted(k.pattern)})"
        for rank, k in enumerate(KINDS)
    )
    counts = ", ".join(
        f"coalesce(count(DISTINCT place) FILTER (kind = '{k.name}'), 0)::BIGINT AS n_{k.name}"
        for k in FIXED_KINDS
    )
    verdicts = ", ".join(
        f"count(DISTINCT place) FILTER (verdict = '{v}')::BIGINT AS n_{v}"
        for v in ("live", "shared")
    )
    fixed = len(FIXED_KINDS)
    return f"""
WITH kinds(rank, kind, pattern, grp, least) AS (VALUES {kinds}),
texts AS (SELECT doc_id, source, coalesce(text, '') AS txt FROM documents),
found AS (
    SELECT doc_id, source, rank, kind, least,
        CASE rank {pieces} END AS pieces,
        CASE rank {wholes} END AS wholes,
        CASE rank {values} END AS vals
    FROM texts, kinds
),
hits AS (
    SELECT doc_id, source, rank, kind, vals[i] AS val, length(wholes[i]) AS size,
        least, list_sum(list_transform(pieces[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(wholes[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT *, unnest(range(1, len(wholes) + 1)) AS i FROM found)
),
spans AS (
    SELECT *, start + size AS stop, (start, rank, kind, start + size) AS place
    FROM hits WHERE length(val) >= least
),
held AS (
    SELECT val, count(DISTINCT coalesce(source, chr(0))) AS owners FROM spans GROUP BY val
),
judged AS (
    SELECT spans.*, CASE WHEN owners >= {SHARED_OWNERS} THEN 'shared'
        WHEN length(val) >= {LIVE_LENGTH}
            AND len(list_distinct(string_split(val, ''))) >= {LIVE_CHARACTERS} THEN 'live'
        ELSE 'plain' END AS verdict
    FROM spans JOIN held USING (val)
),
listed AS (
    SELECT doc_id, {counts}, {verdicts},
        string_agg(concat(kind, ':', start::BIGINT, ':', stop::BIGINT), ','
            ORDER BY start, rank) AS spans,
        string_agg(concat(kind, ':', start::BIGINT, ':', stop::BIGINT), ','
            ORDER BY start, rank) FILTER (rank < {fixed}) AS base
    FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
    coalesce(n_shared, 0) AS n_shared
FROM documents LEFT JOIN listed USING (doc_id)
"""


def _licenses() -> str:
    phrases = ", ".join(
        f"({number}, {_quoted(text)}, '{label}')"
        for number, (text, label) in enumerate(PHRASES + PASSAGES)
    )
    base = len(PHRASES)
    return rf"""
WITH phrases(template, phrase, label) AS (VALUES {phrases}),
worded AS (
    SELECT doc_id,
        regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
),
pairs AS (
    SELECT doc_id, i AS place, words[i + 1] || ' ' || words[i + 2] AS gram
    FROM (SELECT doc_id, words, unnest(range(0, len(words) - 1)) AS i FROM worded)
),
places AS (
    SELECT template, label, i AS place, len(words) - 1 AS pairs,
        words[i + 1] || ' ' || words[i + 2] AS gram
    FROM (SELECT *, unnest(range(0, len(words) - 1)) AS i
          FROM (SELECT *, string_split(phrase, ' ') AS words FROM phrases))
),
lined AS (
    SELECT doc_id, template, label, p.pairs, pairs.place - p.place AS diagonal,
        list(DISTINCT p.place) AS matched, min(pairs.place) AS first, max(pairs.place) AS last
    FROM pairs JOIN places p USING (gram)
    GROUP BY ALL
),
gaps AS (
    SELECT *, coalesce(diagonal - lag(diagonal) OVER line > {VOTING.band}, true)::INT AS opens
    FROM lined WHERE pairs >= {VOTING.exact}
    WINDOW line AS (PARTITION BY doc_id, template ORDER BY diagonal)
),
banded AS (
    SELECT *, sum(opens) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS band FROM gaps
),
merged AS (
    SELECT doc_id, template, label, pairs, min(first) AS first, max(last) AS last,
        len(list_distinct(flatten(list(matched)))) / pairs AS score
    FROM banded GROUP BY doc_id, template, label, pairs, band
),
spans AS (
    SELECT doc_id, template, label, first, 1.0::DOUBLE AS score FROM lined
    WHERE pairs < {VOTING.exact} AND len(matched) = pairs
    UNION ALL
    SELECT doc_id, template, label, first, score FROM merged
    WHERE score >= {VOTING.cover} AND last - first + 2 <= {VOTING.slack} * (pairs + 1)
),
listed AS (
    SELECT doc_id, count(*) FILTER (template < {base}) AS n_base,
        min(first) FILTER (template < {base}) AS first_word,
        max(first) FILTER (template < {base}) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (template < {base}) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
        max(score) AS score
    FROM spans GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
    first_word, last_word, coalesce(base_labels, '') AS base_labels,
    coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM worded LEFT JOIN listed USING (doc_id)
"""


REPEATS = r"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS passage
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM worded)
),
repeated AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, min(doc_id) OVER (PARTITION BY passage) AS first FROM windows)
    WHERE doc_id > first
),
gone AS (
    SELECT DISTINCT doc_id, spot
    FROM (SELECT doc_id, unnest(range(i, i + 13)) AS spot FROM repeated)
),
places AS (
    SELECT doc_id, words[spot] AS word, spot
    FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS spot FROM worded)
),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY spot) AS text, count(*) AS n
    FROM places ANTI JOIN gone USING (doc_id, spot) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)
"""


def _clusters(rounds: int = 10) -> str:
    """Every round in turn: all distances, then the floor of each mean."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
apart{t} AS MATERIALIZED (
    SELECT vec_id, cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
    FROM components v JOIN centroids{t} c USING (spot) GROUP BY vec_id, cluster
),
nearest{t} AS MATERIALIZED (
    SELECT vec_id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
    FROM apart{t} GROUP BY vec_id
)""")
        if t < rounds:
            steps.append(f"""
means{t} AS (
    SELECT cluster, spot, sum(x)::BIGINT AS total, count(*) AS n
    FROM components JOIN nearest{t} USING (vec_id) GROUP BY cluster, spot
),
centroids{t + 1} AS MATERIALIZED (
    SELECT cluster, spot,
        CASE WHEN total IS NULL THEN x
             ELSE total // n - CASE WHEN total % n < 0 THEN 1 ELSE 0 END END AS x
    FROM centroids{t} LEFT JOIN means{t} USING (cluster, spot)
)""")
    return f"""
WITH usable AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) = 64
        AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64
),
components AS MATERIALIZED (
    SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS spot FROM usable
),
centroids0 AS MATERIALIZED (
    SELECT cluster, unnest(v) AS x, unnest(range(64)) AS spot
    FROM (SELECT v, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster FROM usable)
    WHERE cluster < 8
),
{",".join(steps)},
digests AS (
    SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY spot)) AS centroid_sha256
    FROM centroids{rounds} GROUP BY cluster
)
SELECT vec_id, cluster::INTEGER AS cluster, distance,
    sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
    sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM nearest{rounds} JOIN digests USING (cluster)
"""


def _manifest(levels: int = 6, top_levels: int = 5) -> str:
    """Trees level by level: sources of up to 16**levels rows, 16**top_levels sources.

    A lone node goes up as it is. From its siblings, each node's text left and right
    is kept; a leaf's way up is then a join per level.
    """

    def field(value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        parts = [field(c) for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    lowered = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    step = "xor(c >> 1, 3988292384 * (c & 1))"
    crc = (
        "xor(list_reduce([ord(d)::BIGINT FOR d IN string_split(doc_id::VARCHAR, '')], "
        "lambda a, b: list_reduce(range(8), lambda c, _: "
        f"{step}, xor(a, b)), 4294967295), 4294967295)"
    )

    def level(nodes: str, l: int) -> str:
        run = "PARTITION BY tree, place // 16 ORDER BY place ROWS BETWEEN"
        return f"""
{nodes}{l}_seats AS MATERIALIZED (
    SELECT tree, place, hash, width,
        coalesce(string_agg(hash, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(hash, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {nodes}{l}
),
{nodes}{l + 1} AS MATERIALIZED (
    SELECT tree, place // 16 AS place, (width + 15) // 16 AS width,
        CASE WHEN width = 1 THEN any_value(hash)
             ELSE sha256(string_agg(hash, '' ORDER BY place)) END AS hash
    FROM {nodes}{l} GROUP BY tree, place // 16, width
)"""

    def climb(earlier: str, later: str, nodes: str, l: int) -> str:
        return f"""
{later} AS MATERIALIZED (
    SELECT u.* EXCLUDE (place, folded, proof), u.place // 16 AS place,
        CASE WHEN s.width = 1 THEN u.folded ELSE sha256(s.before || u.folded || s.after) END AS folded,
        u.proof || s.before || s.after AS proof
    FROM {earlier} u JOIN {nodes}{l}_seats s ON s.tree = u.tree AND s.place = u.place
)"""

    trees = ",".join(level("node", l) for l in range(levels))
    tops = ",".join(level("top", l) for l in range(top_levels))
    ups = ",".join(climb(f"up{l}", f"up{l + 1}", "node", l) for l in range(levels))
    over = ",".join(climb(f"over{l}", f"over{l + 1}", "top", l) for l in range(top_levels))
    return f"""
WITH leaves AS (
    SELECT doc_id, source, {leaf("text")} AS leaf,
        CASE WHEN {crc} % 5 = 0 THEN {leaf(lowered)} END AS tampered
    FROM documents
),
placed AS MATERIALIZED (
    SELECT doc_id, leaf, tampered,
        dense_rank() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS tree,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY source) AS width
    FROM leaves
),
node0 AS (SELECT tree, place, leaf AS hash, width FROM placed),
{trees},
top0 AS (
    SELECT 0 AS tree, tree AS place, hash, count(*) OVER () AS width FROM node{levels}
),
{tops},
up0 AS (
    SELECT doc_id, leaf, tree, place, coalesce(tampered, leaf) AS folded, '' AS proof FROM placed
),
{ups},
over0 AS (
    SELECT u.doc_id, u.leaf, n.hash AS subroot, 0 AS tree, u.tree AS place, u.folded, u.proof
    FROM up{levels} u JOIN node{levels} n USING (tree)
),
{over}
SELECT doc_id, leaf, subroot, t.hash AS root, sha256(proof) AS proof_sha256,
    folded AS folded_root, folded = t.hash AS verified
FROM over{top_levels}, top{top_levels} t
"""


ORACLE: dict[str, str] = {
    "op5_ownership_frequency": _secrets(),
    "op7_diagonal_voting": _licenses(),
    "op9_lsh_forest": LSH_FOREST,
    "op11_super_k_mers": REPEATS,
    "op12_drift_tightening": _clusters(),
    "op13_pointer_jumping": _manifest(),
}
