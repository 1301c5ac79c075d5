"""SQL of the manifest, the source mix and the clusters, written from their definitions and not from the Spark code."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


# crc32 bit by bit: each byte is followed by seven zeros, and each of these eight numbers is one shift
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))))"""

MANIFEST = f"""
WITH RECURSIVE leaf AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('text')} AS leaf,
           CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf('text')} END AS shown FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaf
), node AS (
    SELECT tree, 0 AS level, pos, n, leaf AS digest FROM placed
    UNION ALL
    SELECT tree, level + 1, pos // 8, any_value(n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
    FROM node WHERE n > 1 GROUP BY tree, level, pos // 8
), sides AS (
    SELECT tree, level, pos, n, digest, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
           coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
    FROM node WINDOW run AS (PARTITION BY tree, level, pos // 8 ORDER BY pos)
), crown AS (
    SELECT tree, 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, digest FROM node WHERE n = 1
), upper AS (
    SELECT level, pos, n, digest FROM crown
    UNION ALL
    SELECT level + 1, pos // 8, any_value(n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY level, pos // 8
), upper_sides AS (
    SELECT level, pos, n, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
           coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
    FROM upper WINDOW run AS (PARTITION BY level, pos // 8 ORDER BY pos)
), fold AS (
    SELECT tree, pos AS leaf_pos, 0 AS level, pos, n, shown AS folded, '' AS proof FROM placed
    UNION ALL
    SELECT tree, leaf_pos, f.level + 1, f.pos // 8, (f.n + 7) // 8, sha256(lft || folded || rgt), proof || lft || rgt
    FROM fold f JOIN sides s USING (tree, level, pos) WHERE f.n > 1
), met AS (
    SELECT f.tree, leaf_pos, folded, proof, c.pos, c.n, c.digest AS subroot FROM fold f JOIN crown c ON f.tree = c.tree WHERE f.n = 1
), onward AS (
    SELECT tree, leaf_pos, subroot, 0 AS level, pos, n, folded, proof FROM met
    UNION ALL
    SELECT tree, leaf_pos, subroot, o.level + 1, o.pos // 8, (o.n + 7) // 8, sha256(lft || folded || rgt), proof || lft || rgt
    FROM onward o JOIN upper_sides s USING (level, pos) WHERE o.n > 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM onward o JOIN placed p ON o.tree = p.tree AND o.leaf_pos = p.pos, (SELECT digest AS root FROM upper WHERE n = 1) WHERE o.n = 1
"""

# sources in the order in which they stop; at the first one that does not, the shares of the open ones are known
MIX = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), named AS (
    SELECT source, sum(size)::BIGINT AS size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source
), stopping AS (
    SELECT *, row_number() OVER w AS k, sum(size) OVER () - coalesce(sum(3 * size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
           sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM named WINDOW w AS (ORDER BY 3.0 * size / weight, source NULLS LAST)
), level AS (
    SELECT arg_min(rest::BIGINT, k) AS rest, arg_min(weights::BIGINT, k) AS weights FROM stopping WHERE 3 * size * weights >= weight * rest
), sources AS (
    SELECT source, n.size AS source_size,
           CASE WHEN 3 * n.size * weights < weight * rest THEN (3 * n.size)::DOUBLE ELSE weight::DOUBLE * rest / greatest(weights, 1) END AS target
    FROM named n, level
), placed AS (
    SELECT doc_id, d.size, source_size::BIGINT AS source_size, target, least(round(target)::BIGINT, 3 * source_size)::BIGINT AS quota,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR) NULLS FIRST, doc_id, d.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE
           (quota // source_size * size + greatest(0, least(start + size, quota % source_size) - start))::BIGINT END AS taken
FROM placed
"""


def clusters(count: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64) -> str:
    """Each round as tables of its own: squared distances of all vectors to all centroids, the nearest, the floors of the means."""
    steps = [f"""
kept AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS parts FROM embeddings
    WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}
), part AS (SELECT r, unnest(range({dimensions})) AS j, unnest(parts) AS x FROM kept
), ordered AS (
    SELECT r, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), parts) - 1 AS c FROM kept
), centre0 AS (SELECT c, j, x FROM ordered JOIN part USING (r) WHERE c < {count})"""]
    for k in range(rounds + 1):
        steps.append(f"""
far{k} AS (SELECT r, c, sum((p.x - m.x) * (p.x - m.x))::BIGINT AS d FROM part p JOIN centre{k} m USING (j) GROUP BY r, c
), near{k} AS (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM far{k} GROUP BY r)""")
        if k < rounds:
            steps.append(f"""
mean{k} AS (SELECT c, j, sum(x)::BIGINT AS s, count(*) AS n FROM near{k} JOIN part USING (r) GROUP BY c, j
), centre{k + 1} AS (SELECT c, j, CASE WHEN n IS NULL THEN m.x ELSE (s - ((s % n) + n) % n) // n END AS x FROM centre{k} m LEFT JOIN mean{k} USING (c, j))""")
    return "WITH " + ",".join(steps) + f""",
named AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM centre{rounds} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM near{rounds} JOIN named USING (c) JOIN kept USING (r)
"""
