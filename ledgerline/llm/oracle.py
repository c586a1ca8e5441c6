"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

#: crc32 of a string's UTF-8 bytes, bit by bit (reflected polynomial 0xEDB88320).
CRC32 = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(regexp_extract_all(hex({0}), '..'),
    lambda h: [('0x' || h)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295)"""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
item AS (
  SELECT item_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, words[s + 1 : s + 10] AS phrase
  FROM (SELECT item_id, words, unnest(range(greatest(1, len(words) - 9))) AS s FROM item WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT len(phrase) AS size FROM win),
spot AS (
  SELECT doc_id, size, s, words[s + 1 : s + size] AS phrase
  FROM (SELECT doc_id, words, size, unnest(range(len(words) - size + 1)) AS s FROM doc, sizes WHERE len(words) >= size)),
hit AS (SELECT doc_id, s, size, item_id FROM spot JOIN win USING (phrase)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM (SELECT DISTINCT doc_id, s, size FROM hit)) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP4 = f"""
WITH rows AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size, {CRC32.format("coalesce(text, '')")}::BIGINT AS text_crc32 FROM documents),
placed AS (
  SELECT *, row_number() OVER by_id AS nth, sum(size) OVER (by_id ROWS UNBOUNDED PRECEDING)::HUGEINT - size AS before, sum(size) OVER ()::HUGEINT AS total
  FROM rows WINDOW by_id AS (ORDER BY doc_id NULLS FIRST, text_crc32, size)),
cut AS (SELECT *, ((before * 2 + size) * 16 // (total * 2))::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY nth)::BIGINT - 1 AS slot,
       NULL::INTEGER AS grown_shard
FROM cut
"""

OP6 = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place
  FROM documents),
often AS (
  SELECT source, line, count(DISTINCT doc_id) AS pages FROM lines WHERE source IS NOT NULL AND regexp_matches(line, '[^ \\t\\n\\x0b\\f\\r]') GROUP BY 1, 2),
bad AS (
  SELECT source, line FROM often JOIN (SELECT source, count(*) AS total FROM documents GROUP BY 1) USING (source)
  WHERE pages >= 5 AND pages > total * 0.05::DOUBLE),
marked AS (SELECT l.*, b.line IS NOT NULL AS gone FROM lines l LEFT JOIN bad b ON l.source = b.source AND l.line = b.line),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped_lines,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY 1)
SELECT d.doc_id, d.source, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped_lines, 0)::BIGINT AS n_dropped_lines,
       octet_length(encode(k.text))::BIGINT AS kept_bytes, sha256(k.text) AS text_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

OP7 = """
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM (SELECT *, octet_length(encode(h)) >= 100 AND first <> page_id AS again
      FROM (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS first FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)))
"""

OP9 = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
                 ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles FROM doc),
flat AS MATERIALIZED (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS s FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM flat a JOIN flat b ON a.s = b.s AND a.doc_id < b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) GROUP BY 1, 2),
link AS MATERIALIZED (
  SELECT a, b FROM pairs WHERE 100 * inter >= 80 * (na + nb - inter) UNION ALL SELECT b, a FROM pairs WHERE 100 * inter >= 80 * (na + nb - inter)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT sets.doc_id, len(shingles)::BIGINT AS n_shingles, component_id, sets.doc_id = component_id AS kept
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) USING (doc_id)
"""


def _accents() -> str:
    """DuckDB's levenshtein compares bytes: each accented letter stands for one ASCII character that no word has."""
    free = [chr(c) for c in range(1, 127) if not chr(c).islower() and chr(c) != "'"]
    return f"translate({{0}}, '{''.join(map(chr, range(0xC0, 0x100)))}', {' || '.join(f'chr({ord(c)})' for c in free[:64])})"


OP11 = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT *, {CRC32.format("encode(doc_id::VARCHAR || ':' || run)")}::BIGINT AS h FROM runs),
read AS (SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, k FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(k)::BIGINT AS n, {_accents().format("word")} AS plain FROM read WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cut AS (SELECT word, n, plain, plain AS key FROM words
  UNION ALL SELECT DISTINCT word, n, plain, plain[1 : i] || plain[i + 2 :]
  FROM (SELECT *, unnest(range(length(plain))) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
  FROM cut a JOIN cut b ON a.key = b.key AND a.word <> b.word WHERE levenshtein(a.plain, b.plain) = 1),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form,
         CASE WHEN other_n >= 5 * n THEN other_n END::BIGINT AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS here, 0 AS step FROM forms
  UNION ALL SELECT chain.word, forms.form, step + 1 FROM chain JOIN forms ON forms.word = chain.here WHERE forms.form IS NOT NULL)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN (SELECT word, arg_max(here, step) AS root FROM chain GROUP BY word) USING (word)
"""


def _levels(name: str, start: str, key: str, count: int) -> str:
    """CTEs name0, name1, ...: nodes (key, pos, h) of each level with the
    siblings before and after; a group's lone node goes up as it is."""
    out = [f"{name}0 AS MATERIALIZED ({start})"]
    for i in range(count):
        out.append(f"""{name}run{i} AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY {key}) AS many,
         CASE WHEN many > 1 THEN coalesce(string_agg(h, '') OVER (PARTITION BY {key}, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
         CASE WHEN many > 1 THEN coalesce(string_agg(h, '') OVER (PARTITION BY {key}, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r
  FROM {name}{i})""")
        out.append(f"""{name}{i + 1} AS MATERIALIZED (
  SELECT {key}, pos // 3 AS pos, CASE WHEN any_value(many) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
  FROM {name}run{i} GROUP BY {key}, pos // 3)""")
    return ",\n".join(out)


def op12(inner: int = 11, outer: int = 6) -> str:
    """SQL for sources of up to 3 ** inner rows and up to 3 ** outer sources."""
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
                                       for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    steps, joins = [], []
    for name, count, key, at in (("a", inner, "gpos", "pos"), ("b", outer, "one", "gpos")):
        for i in range(count):
            joins.append(f"JOIN {name}run{i} {name}{i}r ON {name}{i}r.{key} = x.{key} AND {name}{i}r.pos = x.{at} // {3 ** i}")
            steps.append(f"CASE WHEN {name}{i}r.many > 1 THEN {name}{i}r.l || '|' || {name}{i}r.r END")
    return f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS gpos, 1 AS one, {leaf("text")} AS h,
         CASE WHEN {CRC32.format("encode(doc_id::VARCHAR)")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS claimed,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents),
{_levels("a", "SELECT gpos, pos, h FROM leaves", "gpos", inner)},
{_levels("b", f"SELECT 1 AS one, gpos AS pos, h FROM a{inner}", "one", outer)},
x AS (SELECT l.*, s.h AS subroot, b.h AS root FROM leaves l JOIN a{inner} s USING (gpos) JOIN b{outer} b USING (one)),
y AS (SELECT x.*, list_filter([{", ".join(steps)}], lambda e: e IS NOT NULL) AS steps FROM x {" ".join(joins)}),
z AS (SELECT *, list_reduce(list_prepend(claimed, steps), lambda h, e: sha256(split_part(e, '|', 1) || h || split_part(e, '|', 2))) AS folded_root FROM y)
SELECT doc_id, h AS leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root,
       folded_root = root AS verified FROM z
"""

OP13 = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS t FROM documents) WINDOW same AS (PARTITION BY t)
"""

ORACLE = {"op3_positional_index": OP3, "op4_byte_prefix_shards": OP4, "op6_site_lines": OP6, "op7_arc_to_warc": OP7, "op9_bayes_minhash": OP9,
          "op11_frequency_trie": OP11, "op12_merkle_rollup": op12(), "op13_chunk_recipes": OP13}
