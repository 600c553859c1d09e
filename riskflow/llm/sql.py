"""DuckDB SQL of the corpus queries that need more than a few lines of it."""

#: The usual reflected checksum of 32 bits: its table of 256 values by rule, and a fold over the bytes of a text.
_CRC = """
crc_table AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(i)))"""


def _crc32(codes: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295)"


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


MERKLE = f"""
WITH RECURSIVE {_CRC},
rows_in AS (SELECT *, {_crc32("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)")} % 2 = 0 AS struck FROM documents, crc_table),
leaves AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf("CASE WHEN struck THEN replace(text, chr(10), '') ELSE text END")} AS changed,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM rows_in),
nodes AS (
  SELECT 0 AS level, source, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT level + 1, source, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY level, source, pos // 3, n),
subroots AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
heads AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM heads WHERE n > 1 GROUP BY level, pos // 3, n),
steps AS (
  SELECT level, source, pos,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY level, source, pos // 3 ORDER BY pos)),
head_steps AS (
  SELECT level, pos,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM heads WHERE n > 1 WINDOW run AS (PARTITION BY level, pos // 3 ORDER BY pos)),
climb AS (
  SELECT doc_id, source, leaf, 0 AS level, pos, n, '' AS proof, changed AS digest FROM leaves
  UNION ALL
  SELECT doc_id, c.source, leaf, c.level + 1, c.pos // 3, (n + 2) // 3, proof || before || after, sha256(before || digest || after)
  FROM climb AS c JOIN steps AS s ON s.level = c.level AND s.source IS NOT DISTINCT FROM c.source AND s.pos = c.pos
  WHERE n > 1),
top AS (
  SELECT doc_id, leaf, subroot, 0 AS level, s.pos, s.n, proof, digest FROM climb AS c JOIN subroots AS s ON s.source IS NOT DISTINCT FROM c.source WHERE c.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, t.level + 1, t.pos // 3, (n + 2) // 3, proof || before || after, sha256(before || digest || after)
  FROM top AS t JOIN head_steps AS s ON s.level = t.level AND s.pos = t.pos
  WHERE n > 1)
SELECT doc_id, leaf, subroot, h.digest AS root, sha256(proof) AS proof_sha256, t.digest AS folded_root, t.digest = h.digest AS verified
FROM top AS t, (SELECT digest FROM heads WHERE n = 1) AS h WHERE t.n = 1"""

#: All letters are below 256, so a code point is one byte or two.
_BYTES = ("flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''), "
          "lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [192 + (ord(x) >> 6)::BIGINT, 128 + (ord(x) & 63)::BIGINT] END))")

SPELLING = f"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents)),
numbered AS (SELECT run, {_crc32(_BYTES)} AS h FROM runs, crc_table),
words AS MATERIALIZED (
  SELECT word, count(*) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM numbered)
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS MATERIALIZED (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cut AS a JOIN cut AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cut AS a JOIN words AS b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cut AS a JOIN words AS b ON a.rest = b.word),
near AS (SELECT word, count(*) AS n_near FROM pairs GROUP BY word),
forms AS MATERIALIZED (
  SELECT word, other AS form, other_n AS form_n FROM pairs WHERE other_n >= 10 * n
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) = 1),
chains AS (
  SELECT word, form AS root FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chains AS c JOIN forms AS f ON c.root = f.word),
roots AS (SELECT word, root FROM chains AS c WHERE root NOT IN (SELECT word FROM forms))
SELECT word, form, coalesce(root, word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN near USING (word) LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)"""
