"""DuckDB SQL for the operators that SQL can express: archives, links of shingle sets and of vectors, near words, whole-number clusters."""

from __future__ import annotations

#: Base32 of a digest: each five hexadecimal digits are four letters.
_BASE32 = "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INT), 5) AS INT) >> CAST(15 - i % 4 * 5 AS INT)) & 31) + 1, 1)), '')"

WARC = f"""WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
  hashed AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM payloads),
  told AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS original FROM hashed)
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to FROM told"""

#: Smallest id that the pairs of `links` (u, v; both directions) reach from each id of `nodes`.
_REACHED = "reached(id, other) AS (SELECT id, id FROM nodes UNION SELECT r.id, l.v FROM reached r JOIN links l ON l.u = r.other), components AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)"

JACCARD = rf"""WITH RECURSIVE worded AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
  sets AS (SELECT id, list_distinct(CASE WHEN len(words) = 0 THEN [] ELSE list_transform(range(greatest(len(words) - 4, 1)), lambda i: array_to_string(words[i + 1 : i + 5], ' ')) END) AS shingles FROM worded),
  keyed AS (SELECT id, len(shingles) AS n, shingles, CASE WHEN len(shingles) > 0 THEN min(id) OVER (PARTITION BY sha1(array_to_string(list_sort(shingles), chr(10)))) ELSE id END AS class FROM sets),
  nodes AS (SELECT id, n FROM keyed WHERE id = class),
  items AS (SELECT id, n, unnest(shingles) AS shingle FROM keyed WHERE id = class),
  pairs AS (SELECT a.id AS u, b.id AS v, a.n + b.n AS sizes, count(*) AS common FROM items a JOIN items b ON a.shingle = b.shingle AND a.id < b.id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n GROUP BY ALL),
  linked AS (SELECT u, v FROM pairs WHERE 100 * common >= 80 * (sizes - common)),
  links AS (SELECT u, v FROM linked UNION ALL SELECT v, u FROM linked),
  {_REACHED}
  SELECT k.id AS doc_id, CAST(k.n AS BIGINT) AS n_shingles, c.component_id FROM keyed k JOIN components c ON c.id = k.class"""

EMBEDDINGS = f"""WITH RECURSIVE nodes AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  usable AS (SELECT *, list_transform(v, lambda x: coalesce(x, 0)) AS w FROM nodes WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
  links AS (SELECT a.id AS u, b.id AS v FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.id <> b.id WHERE list_cosine_similarity(a.w, b.w) >= 0.93),
  {_REACHED}, degrees AS (SELECT u AS id, count(*) AS n FROM links GROUP BY u)
  SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM components LEFT JOIN degrees USING (id)"""

#: crc32 of a blob's bytes, by the table that the polynomial gives.
_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))"

SPELLING = rf"""WITH RECURSIVE crc(t) AS MATERIALIZED (SELECT {_CRC_TABLE}),
  runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
  counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL),
  bytes AS (SELECT *, list_transform(range(strlen(id || ':' || run)), lambda i: CAST('0x' || substr(hex(encode(id || ':' || run)), CAST(2 * i + 1 AS INT), 2) AS BIGINT)) AS b FROM counted),
  hashed AS (SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM bytes, crc),
  cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed),
  words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
  holes AS MATERIALIZED (SELECT word, n, i, substr(word, 1, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
  pairs AS (SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word),
  near AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS best, max(m) AS m FROM pairs GROUP BY word),
  forms AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN best END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n FROM words LEFT JOIN near USING (word)),
  chain(word, reached, form) AS (SELECT word, word, form FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.form)
  SELECT f.word, f.form, c.reached AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.form IS NULL"""

_ASSIGN = "{out} AS MATERIALIZED (SELECT vec_id, ord, v, cluster, distance FROM (SELECT x.vec_id, x.ord, x.v, c.cluster, list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance FROM kept x JOIN {centroids} c ON true) QUALIFY row_number() OVER (PARTITION BY ord ORDER BY distance, cluster) = 1)"
_MOVE = "{out} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM {centroids} c LEFT JOIN (SELECT cluster, list(q ORDER BY k) AS v FROM (SELECT cluster, k, CAST(floor(CAST(sum(v[k]) AS DOUBLE) / count(*)) AS BIGINT) AS q FROM {assigned}, range(1, 65) r(k) GROUP BY cluster, k) GROUP BY cluster) m USING (cluster))"

CLUSTERS = """WITH kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS ord, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, v FROM kept ORDER BY sha256('2:' || vec_id) LIMIT 40),
  """ + ",\n  ".join([x for k in range(5) for x in (_ASSIGN.format(out=f"a{k}", centroids=f"c{k}"), _MOVE.format(out=f"c{k + 1}", centroids=f"c{k}", assigned=f"a{k}"))] + [_ASSIGN.format(out="last", centroids="c5")]) + """
  SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c5.v, ',')) AS centroid_sha256 FROM last JOIN c5 USING (cluster)"""

ORACLES = {"op4_warc": WARC, "op6_jaccard": JACCARD, "op8_embeddings": EMBEDDINGS, "op12_spelling": SPELLING, "op13_clusters": CLUSTERS}
