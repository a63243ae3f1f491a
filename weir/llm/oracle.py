"""SQL (DuckDB) for the operators whose contract it can state; the others are
held against brute force in ``tests/llm``."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# ---- op11: Merkle manifest ---------------------------------------------------------


def _field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 of a short ASCII text, bit by bit (polynomial 0xEDB88320)
_CRC = (
    "xor(4294967295, list_reduce([4294967295] || list_transform(string_split(d, ''), lambda ch: CAST(ascii(ch) AS BIGINT)), "
    "lambda c, b: list_reduce([xor(c, b)] || CAST(range(8) AS BIGINT[]), "
    "lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"
)

ORACLE["op11_manifest"] = f"""WITH RECURSIVE ids AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS d FROM documents WHERE doc_id IS NOT NULL),
crc AS (SELECT doc_id, {_CRC} AS c FROM ids),
leaves AS (
  SELECT d.doc_id, d.source, {_leaf('text')} AS leaf,
         CASE WHEN c.c % 5 = 0 THEN {_leaf(_LOWER.format('text'))} ELSE {_leaf('text')} END AS claimed
  FROM documents d LEFT JOIN crc c USING (doc_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM leaves),
low AS (
  SELECT tree, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), CAST(ceil(any_value(n) / 16) AS BIGINT)
  FROM low WHERE n > 1 GROUP BY tree, level, pos // 16),
subroots AS (SELECT tree, h FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, tree AS pos, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), CAST(ceil(any_value(n) / 16) AS BIGINT)
  FROM high WHERE n > 1 GROUP BY level, pos // 16),
tops AS (SELECT max(level) AS levels FROM high),
heights AS (SELECT tree, max(level) AS levels FROM low GROUP BY tree),
-- the siblings of every node that has a parent
nodes AS (
  SELECT 'low' AS part, l.tree, l.level, l.pos, l.h FROM low l WHERE l.n > 1
  UNION ALL SELECT 'high', 0, level, pos, h FROM high WHERE n > 1),
kin AS (
  SELECT a.part, a.tree, a.level, a.pos,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS after
  FROM nodes a JOIN nodes b ON a.part = b.part AND a.tree = b.tree AND a.level = b.level AND a.pos // 16 = b.pos // 16
  GROUP BY a.part, a.tree, a.level, a.pos),
walk AS (
  SELECT p.tree, p.pos AS leaf_pos, 0 AS step, p.pos AS pos, p.claimed AS h, '' AS proof FROM placed p
  UNION ALL
  SELECT w.tree, w.leaf_pos, w.step + 1,
         (CASE WHEN w.step + 1 = t.levels THEN w.tree ELSE w.pos // 16 END),
         sha256(k.before || w.h || k.after), w.proof || k.before || k.after
  FROM walk w JOIN heights t ON t.tree = w.tree
  JOIN kin k ON (w.step < t.levels AND k.part = 'low' AND k.tree = w.tree AND k.level = w.step AND k.pos = w.pos)
             OR (w.step >= t.levels AND k.part = 'high' AND k.level = w.step - t.levels
                 AND k.pos = CASE WHEN w.step = t.levels THEN w.tree ELSE w.pos END)),
folded AS (
  SELECT w.tree, w.leaf_pos, w.h, w.proof FROM walk w JOIN heights t ON t.tree = w.tree, tops
  WHERE w.step = t.levels + tops.levels)
SELECT p.doc_id, p.leaf, s.h AS subroot, (SELECT h FROM high WHERE n = 1) AS root, sha256(f.proof) AS proof_sha256,
       f.h AS folded_root, f.h = (SELECT h FROM high WHERE n = 1) AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN folded f ON f.tree = p.tree AND f.leaf_pos = p.pos"""

# ---- op12: ranked search ---------------------------------------------------------------

_TERMS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE["op12_search"] = f"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS.format('text')} AS words FROM documents),
c AS (SELECT * FROM d WHERE len(words) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_terms FROM c),
tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(len(words)) AS n, term, count(*) AS tf
       FROM (SELECT r, doc_id, words, unnest(words) AS term FROM c) GROUP BY r, term),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, total WHERE term IN (SELECT term FROM asked) GROUP BY term),
scores AS (
  SELECT a.item_id, t.r, any_value(t.doc_id) AS doc_id,
         CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * t.n * total.n_docs) // total.n_terms)))) AS BIGINT) AS score
  FROM asked a JOIN w ON w.term = a.term JOIN tf t ON t.term = a.term, total GROUP BY a.item_id, t.r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10"""

# ---- op13: decontamination ---------------------------------------------------------------

_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op13_decontaminate"] = f"""WITH items AS (
  SELECT item_id, {_WORDS.format('text')} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS ws FROM documents),
places AS (
  SELECT r, k, i, array_to_string(ws[i : i + k - 1], ' ') AS win
  FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM docs, sizes WHERE len(ws) >= k)),
hits AS (SELECT p.r, p.k, p.i, w.item_id FROM places p JOIN windows w ON w.k = p.k AND w.win = p.win),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS j FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(w.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
       sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(w.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words w USING (r) LEFT JOIN found f USING (r)"""

# ---- op1: substrings ---------------------------------------------------------------

# texts as hexadecimal digits, two a byte; the 50-byte strings that start at each byte
ORACLE["op1_substrings"] = """WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (
  SELECT r, doc_id, i, substring(h, CAST(2 * i + 1 AS BIGINT), 100) AS s
  FROM (SELECT r, doc_id, h, unnest(range(0, strlen(h) // 2 - 49)) AS i FROM d WHERE strlen(h) >= 100)),
firsts AS (SELECT s, min(doc_id) AS first FROM places GROUP BY s HAVING min(doc_id) < max(doc_id)),
runs AS (
  SELECT p.r, p.i, sum(CASE WHEN p.i - before > 50 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY p.r ORDER BY p.i) AS run
  FROM (SELECT p.r, p.i, lag(p.i) OVER (PARTITION BY p.r ORDER BY p.i) AS before
        FROM places p JOIN firsts f ON f.s = p.s WHERE f.first < p.doc_id) p),
spans AS (SELECT r, run, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY r, run),
gaps AS (
  SELECT s.r, s.b AS a, coalesce(lead(s.a) OVER (PARTITION BY s.r ORDER BY s.a), strlen(d.h) // 2) AS b
  FROM spans s JOIN d ON d.r = s.r
  UNION ALL SELECT r, 0, min(a) FROM spans GROUP BY r),
kept AS (SELECT g.r, string_agg(substring(d.h, CAST(2 * g.a + 1 AS BIGINT), CAST(2 * (g.b - g.a) AS BIGINT)), '' ORDER BY g.a) AS h
         FROM gaps g JOIN d ON d.r = g.r GROUP BY g.r),
sums AS (SELECT r, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed FROM spans GROUP BY r)
SELECT d.doc_id, CAST(strlen(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(s.n_removed, 0) AS n_removed, coalesce(s.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN sums s ON s.r = d.r LEFT JOIN kept k ON k.r = d.r"""

# ---- components, shared by op4 and op9 ------------------------------------------------

# ``nodes`` (r, id) and ``links`` (a, b, both ways) are given
_REACH = """reach AS (
  SELECT a AS r, b AS other FROM links
  UNION
  SELECT x.r, l.b FROM reach x JOIN links l ON l.a = x.other),
least AS (SELECT x.r, min(n.id) AS id FROM reach x JOIN nodes n ON n.r = x.other GROUP BY x.r),
degree AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)"""

_SHINGLE_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x20\x09-\x0D]+')"

ORACLE["op4_jaccard"] = f"""WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, {_SHINGLE_WORDS.format('text')} AS ws FROM documents),
nodes AS (SELECT r, doc_id AS id FROM d),
shingles AS (
  SELECT DISTINCT r, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.r = c.a JOIN sizes y ON y.r = c.b
  WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
{_REACH}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.id, d.doc_id)) AS component_id, coalesce(g.n, 0) AS n_links
FROM d LEFT JOIN sizes s ON s.r = d.r LEFT JOIN least l ON l.r = d.r LEFT JOIN degree g ON g.r = d.r"""

ORACLE["op9_embeddings"] = f"""WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
nodes AS (SELECT r, vec_id AS id FROM e),
fit AS (
  SELECT r, v, sqrt(list_dot_product(v, v)) AS norm FROM e
  WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.r AS a, y.r AS b FROM fit x JOIN fit y ON x.r <> y.r AND len(x.v) = len(y.v)
  WHERE list_dot_product(x.v, y.v) / (x.norm * y.norm) >= 0.9),
{_REACH}
SELECT e.vec_id, coalesce(g.n, 0) AS n_links, least(e.vec_id, coalesce(l.id, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.id, e.vec_id)) AS kept
FROM e LEFT JOIN least l ON l.r = e.r LEFT JOIN degree g ON g.r = e.r"""
