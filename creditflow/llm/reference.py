"""Reference SQL (DuckDB) of the operators that SQL can express.

Language identification, URL verdicts, quality scores and token ids are beyond SQL; their queries
are tested against plain restatements, round trips or held-out accuracy.
"""

from __future__ import annotations

_BLANKS = r"[^\x20\x09-\x0D]+"
_ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(nodes: str) -> str:
    """From ``links(a, b)``: ``component(id, component_id)`` over the ids of ``nodes``."""
    return f"""
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT id, id AS r FROM ({nodes})
  UNION
  SELECT reached.id, both_ways.b FROM reached JOIN both_ways ON reached.r = both_ways.a
),
component AS (SELECT id, min(r) AS component_id FROM reached GROUP BY id)"""


def near_duplicates(percent: int = 85, width: int = 5) -> str:
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_BLANKS}') AS w FROM documents
),
shingles AS (
  SELECT doc_id, unnest(CASE
      WHEN len(w) >= {width} THEN list_distinct(list_transform(
        range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' ')))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= {percent} * (x.n + y.n - c)
),{_components("SELECT doc_id AS id FROM documents")}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component ON d.doc_id = component.id LEFT JOIN sizes ON d.doc_id = sizes.doc_id"""


def warc() -> str:
    digits = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, {5 * k + 1}, 5) AS BIGINT) >> {shift}) & 31) + 1, 1)"
        for k in range(8)
        for shift in (15, 10, 5, 0)
    )
    return f"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
),
firsts AS (SELECT payload, min(page_id) AS first FROM hashed GROUP BY payload)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {digits} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed JOIN firsts USING (payload)"""


def decontamination(window: int = 10) -> str:
    return f"""
WITH items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_ITEM_WORDS}') AS w FROM benchmark
),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), {window}) AS size, array_to_string(w[i:i + {window - 1}], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - {window - 1}) + 1)) AS i FROM items WHERE len(w) > 0)
),
words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORDS}') AS w FROM documents
),
document_windows AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)
),
hits AS (SELECT doc_id, i, size, item_id FROM document_windows JOIN item_windows USING (size, s)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT words.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def vectors(threshold: float = 0.95) -> str:
    return f"""
WITH RECURSIVE units AS (
  SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS u
  FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)
  WHERE len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v)
    AND len(list_filter(v, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM units x JOIN units y
  ON x.vec_id < y.vec_id AND list_inner_product(x.u, y.u) >= {threshold}
),{_components("SELECT vec_id AS id FROM embeddings")},
counted AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component ON vec_id = component.id LEFT JOIN counted ON vec_id = a"""


def substring(window: int = 20) -> str:
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_BLANKS}') AS w FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {window - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS i FROM words WHERE len(w) >= {window})
),
late AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM windows)
  WHERE rn > 1
),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS p FROM late),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM placed ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id
)
SELECT words.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""


def _crc32(text: str) -> str:
    """CRC-32 of a text, four bits at a time; the 16 steps of the table follow from the polynomial."""
    table = []
    for x in range(16):
        for _ in range(4):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        table.append(x)
    digits = f"hex(encode({text}))"
    # Of each byte the low half comes first; the list starts with the register's first value.
    halves = f"list_transform(range(0, length({digits})), lambda i: instr('0123456789ABCDEF', substr({digits}, CAST(i + 2 - 2 * (i % 2) AS BIGINT), 1)) - 1)"
    step = f"lambda c, h: xor(c >> 4, list_extract({table}::BIGINT[], CAST((xor(c, h) & 15) + 1 AS BIGINT)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {halves}::BIGINT[]), {step}), 4294967295::BIGINT)"


def spelling(worn: int = 31, least: int = 7, ratio: int = 10) -> str:
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= {least} GROUP BY 1, 2),
hashed AS (SELECT run, n, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM counted),
worn AS (
  SELECT CASE WHEN h % {worn} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM worn WHERE length(word) >= {least} GROUP BY word HAVING sum(n) >= 2
),
cut AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
pairs AS (
  SELECT x.word AS word, y.word AS near FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON rest = words.word
  UNION SELECT words.word, cut.word FROM cut JOIN words ON rest = words.word
),
ranked AS (
  SELECT pairs.word, near, n, count(*) OVER (PARTITION BY pairs.word) AS n_near,
         row_number() OVER (PARTITION BY pairs.word ORDER BY n DESC, encode(near)) AS place
  FROM pairs JOIN words ON near = words.word
),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN r.n >= {ratio} * words.n THEN near END AS form, CASE WHEN r.n >= {ratio} * words.n THEN r.n END AS form_n
  FROM words LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON words.word = r.word
),
way AS (
  SELECT word, word AS last FROM forms UNION ALL SELECT way.word, form FROM way JOIN forms ON last = forms.word WHERE form IS NOT NULL
),
roots AS (SELECT way.word, last AS root FROM way JOIN forms ON last = forms.word WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""


def neighbours(every: int = 20, k: int = 20) -> str:
    return f"""
WITH sound AS (
  SELECT vec_id, v FROM (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE vec_id IS NOT NULL)
  WHERE len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v) AND len(list_filter(v, lambda x: x <> 0)) > 0
),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])) AS score
  FROM sound q JOIN sound x ON q.vec_id % {every} = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}"""


def collocations(least: int = 100, longest: int = 5, top: int = 2000) -> str:
    sizes = ", ".join(str(k) for k in range(1, longest + 1))
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM worded, unnest([{sizes}]) AS t(m) WHERE len(w) >= m)
),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY 1, 2, 3),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= {least}),
inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, a
  FROM (SELECT lang, w, a, m, s, unnest(range(1, m - s + 2)) AS i FROM candidates, unnest([{sizes}]) AS t(s) WHERE s > 1 AND s < m)
),
dropped AS (SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inside USING (lang, phrase) WHERE 100 * inside.a >= 100 * c.a),
cuts AS (
  SELECT lang, phrase, a, w, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)
),
scored AS (
  SELECT c.lang, c.phrase, a, h.f AS l, t.f AS r, n, k, (1000::HUGEINT * a * n) // (h.f::HUGEINT * t.f) AS score
  FROM cuts c JOIN f h ON c.lang = h.lang AND head = h.phrase JOIN f t ON c.lang = t.lang AND tail = t.phrase JOIN totals ON c.lang = totals.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best ANTI JOIN dropped USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {top}"""


def statements() -> dict[str, str]:
    return {
        "op2_odd_sketch": near_duplicates(),
        "op3_warc": warc(),
        "op6_decontamination": decontamination(),
        "op7_multi_index": vectors(),
        "op9_substring_dedup": substring(),
        "op11_spelling_variants": spelling(),
        "op12_nearest_neighbours": neighbours(),
        "op13_collocations": collocations(),
    }
