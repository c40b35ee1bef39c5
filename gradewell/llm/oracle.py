"""DuckDB SQL of the operators that SQL can express, by the plainest method."""

from __future__ import annotations

from gradewell.llm.licenses import DEFAULT as LICENSES, span, template_tokens
from gradewell.llm.url_filter import DEFAULT as VOCABULARY, RULES

#: Words of a text, lower-cased in A-Z.
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _plain_words(text: str) -> str:
    return (
        f"list_filter(string_split_regex(translate({text}, '{_UP}', '{_LOW}'), "
        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
    )


OP3 = f"""
WITH docs AS (SELECT doc_id, {_plain_words("coalesce(text, '')")} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_plain_words("coalesce(text, '')")} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n,
         array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)
),
hits AS (SELECT doc_id, i, n, item FROM grams JOIN windows USING (n, phrase)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def _op4() -> str:
    """Terms are ASCII letters and digits alone, so they stand where a run of those is one of their writings."""
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
    stands = ", ".join(f"('{form}', '{t}')" for form, terms in VOCABULARY.stands_for().items() for t in terms)
    kinds = ", ".join([*(f"('{t}', true, 0.0)" for t in VOCABULARY.strict), *(f"('{t}', false, {w})" for t, w in VOCABULARY.soft.items())])
    return f"""
WITH after AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM after
), rules(h, p, v) AS (VALUES {rules}),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
), stands(form, term) AS (VALUES {stands}), kinds(term, strict, weight) AS (VALUES {kinds}),
words AS (
  SELECT page_id, unnest(regexp_extract_all(translate(url || ' ' || url_decode(url), '{_UP}', '{_LOW}'), '[0-9a-z]+')) AS form
  FROM pages WHERE url IS NOT NULL
), found AS (SELECT DISTINCT page_id, term, strict, weight FROM words JOIN stands USING (form) JOIN kinds USING (term)),
bad AS (
  SELECT page_id FROM found GROUP BY page_id
  HAVING bool_or(strict) OR count(*) FILTER (NOT strict) >= {VOCABULARY.distinct} OR max(weight) >= {VOCABULARY.alone}
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN page_id IN (SELECT page_id FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN best USING (page_id)
"""


OP5 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UP}', '{_LOW}'),
                                                '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM docs UNION SELECT reach.doc_id, b FROM reach JOIN links ON a = seen
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP10 = """
WITH records AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), told AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
  FROM records
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM told
"""



def _op2() -> str:
    phrases = ", ".join(f"('{f}', '{label}', {f.count(' ') + 1})" for f, label in LICENSES.phrases.items())
    templates = ", ".join(
        f"('{label}', {tokens}, {least}, {span(LICENSES, i)}, {[t for t in tokens if t in LICENSES.telling]}::VARCHAR[])"
        for i, label, tokens, least in template_tokens(LICENSES))
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, {_plain_words("coalesce(text, '')")} AS w, {_plain_words("lower(coalesce(text, ''))")} AS low
  FROM documents
), phrases(phrase, label, n) AS (VALUES {phrases}),
places AS (
  SELECT doc_id, label, i FROM (SELECT doc_id, w, label, phrase, n, unnest(range(0, len(w) - n + 1)) AS i
                                FROM docs, phrases WHERE len(w) >= n)
  WHERE array_to_string(w[i + 1 : i + n], ' ') = phrase
), base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM places GROUP BY doc_id
), templates(label, tokens, least, span, told) AS (VALUES {templates}),
blocks AS (
  SELECT doc_id, label, tokens, least, told, i, list_intersect(low[i : i + span - 1], tokens) AS common
  FROM (SELECT doc_id, low, unnest(range(1, len(low) + 1)) AS i FROM docs), templates WHERE list_contains(tokens, low[i])
), met AS (
  SELECT doc_id, label, i, common, len(common) / len(tokens) AS share FROM blocks
  WHERE len(common) >= least AND list_has_all(common, told)
), kept AS (
  SELECT * FROM met a WHERE NOT EXISTS (
    SELECT 1 FROM met b WHERE b.doc_id = a.doc_id AND b.i = a.i AND b.label <> a.label AND len(b.common) > len(a.common)
                          AND list_has_all(b.common, a.common))
), named AS (
  SELECT doc_id, label, true AS is_base FROM places UNION SELECT doc_id, label, false FROM kept
), labels AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM named GROUP BY doc_id
), scores AS (SELECT doc_id, max(share) AS best FROM kept GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(coalesce(best, 0), CASE WHEN n_base > 0 THEN {LICENSES.phrase_score} ELSE 0 END)::DOUBLE AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN scores USING (doc_id)
"""


OP11 = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, len(embedding) AS n FROM embeddings
), usable AS (
  SELECT * FROM vectors WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                          AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.n = b.n AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach(vec_id, seen) AS (
  SELECT vec_id, vec_id FROM vectors UNION SELECT reach.vec_id, b FROM reach JOIN links ON a = seen
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(seen) AS component_id FROM reach GROUP BY vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a) USING (vec_id)
"""

#: The checksum's own table, made by its rule; a checksum is a fold of it over the bytes of a text.
_CRC_TABLE = """
SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, bit:
         CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
"""

OP12 = f"""
WITH crc AS ({_CRC_TABLE}),
docs AS (SELECT doc_id, {_plain_words("coalesce(text, '')")} AS w FROM documents),
items AS (SELECT {_plain_words("coalesce(text, '')")} AS w FROM benchmark),
own AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM docs),
wanted AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM items),
hashed AS (
  SELECT f, xor(list_reduce(
           list_prepend(4294967295, list_transform(range(0, strlen(f)), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT f FROM own UNION SELECT f FROM wanted), crc
),
corpus AS (SELECT bucket, count(*) AS s FROM own JOIN hashed USING (f) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM own) + 10000)
                                      / ((s + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000)))) AS BIGINT) AS gain
  FROM corpus LEFT JOIN target USING (bucket)
),
sums AS (
  SELECT doc_id, count(*) AS n_features, sum(gain) AS total
  FROM own JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY doc_id
),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
         CAST(coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM docs LEFT JOIN sums USING (doc_id)
),
drawn AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score, n_words >= 20 AS able FROM scored
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place FROM drawn)
SELECT doc_id, n_features, weight, score,
       CASE WHEN able AND place <= 25 * (SELECT count(*) FROM drawn WHERE able) // 100 THEN place END AS rank
FROM ranked
"""

OP13 = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || doc_id) AS h FROM documents
), drawn AS (
  SELECT *, len(w) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM cut
), parts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), told AS (
  SELECT *, array_to_string(w[1 : a], '') AS prefix, array_to_string(w[a + 1 : b], '') AS middle,
         array_to_string(w[b + 1 : n], '') AS suffix FROM parts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM told
"""


ORACLE_SQL = {
    "op2_license_scan": _op2(),
    "op3_decontamination": OP3, "op4_url_filter": _op4(), "op5_superminhash": OP5, "op10_warc": OP10,
    "op11_rotated_codes": OP11, "op12_resampling": OP12, "op13_fill_middle": OP13,
}
