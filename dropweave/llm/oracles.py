"""DuckDB SQL for the queries that SQL can express."""

# crc32 of a text: a byte at a time over a table that the reflected polynomial 0xEDB88320 generates.
_CRC_TABLE = """SELECT list(c ORDER BY n) t FROM (WITH RECURSIVE g AS (
  SELECT n::BIGINT n, n::BIGINT c, 0 k FROM range(256) r(n)
  UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM g WHERE k < 8)
  SELECT n, c FROM g WHERE k = 8)"""


def crc32(text: str) -> str:
    """SQL of a text's checksum; ``t`` must be in scope."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), "
            "lambda h: ('0x' || h)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)")


OP1 = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id query_id, v.vec_id,
             list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])), lambda a, b: a + b) score
      FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) n FROM s)
SELECT query_id, n::INTEGER AS "rank", vec_id, score FROM r WHERE n <= 20
"""

OP3 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) payload_bytes, sha1(coalesce(html, '')) payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM m
"""

# Shingles of whole texts, links from exact counts of shared shingles, then the smallest id over paths of links.
OP6 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x20\x09-\x0D]+') ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) g FROM w),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id a, b.doc_id b, count(*) k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id reached FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(reached) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id, n
"""


def _draw(level: str, name: str, weight: str) -> str:
    return (f"(-ln((('0x' || md5(k || '/{level}/' || {name})[1:12])::BIGINT + 0.5) / 281474976710656.0) / {weight})")


def _shards(regions: str) -> str:
    """SQL of every document's shard in 5 regular regions of 2 racks of 4, or with a sixth of the one shard 40."""
    return f"""
    r AS (SELECT doc_id, row_id, k, arg_min(r, struct_pack(d := d, r := r)) r FROM (
        SELECT doc_id, row_id, k, r, {_draw('region', 'r', 'CASE WHEN r < 5 THEN 8.0 ELSE 1.0 END')} d FROM keyed, {regions}) GROUP BY ALL),
    c AS (SELECT doc_id, row_id, k, r, arg_min(c, struct_pack(d := d, c := c)) c FROM (
        SELECT doc_id, row_id, k, r, c, {_draw('rack', "r || '.' || c", 'CASE WHEN r < 5 THEN 4.0 ELSE 1.0 END')} d
        FROM r, (SELECT unnest([0, 1]) c) WHERE r < 5 OR c = 0) GROUP BY ALL)
    SELECT row_id, arg_min(s, struct_pack(d := d, s := s)) s FROM (
        SELECT row_id, s, {_draw('shard', 's', '1.0')} d
        FROM (SELECT row_id, k, unnest(CASE WHEN r < 5 THEN range(8 * r + 4 * c, 8 * r + 4 * c + 4) ELSE [40] END) s FROM c)) GROUP BY ALL"""


OP7 = f"""
WITH keyed AS (SELECT *, row_number() OVER () row_id, coalesce(doc_id::VARCHAR, 'null') k FROM documents),
now AS (WITH {_shards('(SELECT unnest(range(5)) r)')}),
later AS (WITH {_shards('(SELECT unnest(range(6)) r)')}),
crc AS ({_CRC_TABLE}),
f AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 size, {crc32("coalesce(text, '')")} text_crc32, 'key' law,
             now.s::INTEGER shard, later.s::INTEGER grown_shard, md5(k)[1:12] h
      FROM keyed JOIN now USING (row_id) JOIN later USING (row_id), crc)
SELECT doc_id, size::BIGINT AS size, text_crc32, law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, doc_id, size, text_crc32) - 1 AS slot, grown_shard FROM f
"""

# Counts per group, dense shares over all kept terms of a language, integers throughout.
OP12 = r"""
WITH d AS (SELECT coalesce(lang, '') lang, coalesce(source, '') source, row_number() OVER () r,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') ts FROM documents),
t AS (SELECT lang, source, r, unnest(ts) term FROM d),
k AS (SELECT lang, term, count(*) n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) v, sum(n) total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) total,
             l.v, k.n lang_n, l.total lang_total
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n::HUGEINT + 5)) // (total + 5 * v) p,
             1 + (1000000000 * (lang_n::HUGEINT + 5)) // (lang_total + 5 * v) q FROM s),
pairs AS (SELECT a.lang, a.source, 'pair' part, b.source item, coalesce(f, 0) "value"
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source s1, y.source s2, sum(abs(x.p - y.p)) f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) z
            ON z.lang = a.lang AND z.s1 = a.source AND z.s2 = b.source),
parts AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY "value" DESC, item) n FROM parts)
SELECT lang, source, part, item, "value"::BIGINT AS "value", n::INTEGER AS "rank" FROM ranked WHERE part = 'pair' OR n <= 50
"""

ALL = {"op1_one_bit_neighbours": OP1, "op3_warc": OP3, "op6_jaccard_join": OP6, "op7_hash_tree": OP7, "op12_source_divergence": OP12}
