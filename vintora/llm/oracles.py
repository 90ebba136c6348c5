"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import re

from vintora.llm import licenses

_lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_lower}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
walk AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT p.v, walk.c FROM walk JOIN p ON walk.doc_id = p.u)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.c AS component_id FROM s JOIN (SELECT doc_id, min(c) AS c FROM walk GROUP BY doc_id) m ON s.doc_id = m.doc_id"""


def op7() -> str:
    """The same votes, runs and labels; template k-grams as a list of values."""
    k = licenses.K
    split = lambda s: re.findall(r"[0-9a-z\x80-\U0010ffff]+", s.lower())
    texts = [(split(p), label, True) for p, label in licenses.PHRASES.items()] + [(split(t), label, False) for label, ts in licenses.TEMPLATES.items() for t in ts]
    grams = ", ".join(f"({n}, '{label}', {str(base).upper()}, {len(w)}, {j}, '{' '.join(w[j : j + k])}')" for n, (w, label, base) in enumerate(texts) for j in range(len(w) - k + 1))
    return rf"""
WITH t(template, label, base, size, place, gram) AS (VALUES {grams}),
d AS (SELECT row_number() OVER () AS row_id, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT row_id, CAST(unnest(range(0, len(w) - {k - 1})) AS INT) AS pos, unnest([array_to_string(w[i:i + {k - 1}], ' ') FOR i IN range(1, len(w) - {k - 2})]) AS gram FROM d WHERE len(w) >= {k}),
v AS (SELECT row_id, template, label, base, size, pos - place AS diagonal, count(*) AS votes, list(place) AS places, min(pos) AS first, max(pos) AS last FROM g JOIN t USING (gram) GROUP BY ALL),
o AS (SELECT *, CASE WHEN base OR abs(diagonal - lag(diagonal) OVER q) > {licenses.SHIFT} OR first - lag(last) OVER q > {licenses.GAP} OR lag(last) OVER q IS NULL THEN 1 ELSE 0 END AS new_run FROM v WINDOW q AS (PARTITION BY row_id, template ORDER BY first, diagonal)),
r AS (SELECT *, sum(new_run) OVER (PARTITION BY row_id, template ORDER BY first, diagonal) AS run FROM o),
f AS (SELECT row_id, template, label, base, size, run, sum(votes) AS votes, len(list_distinct(flatten(list(places)))) AS covered, min(diagonal) AS diagonal, min(first) AS first, max(last) - min(first) + {k} AS span FROM r GROUP BY ALL),
x AS (SELECT *, rank() OVER (PARTITION BY row_id, base, first ORDER BY covered DESC) AS rival, least(1.0, CAST(covered AS DOUBLE) / (size - {k - 1})) AS cover FROM f),
y AS (SELECT *, base AND votes = size - {k - 1} AS exact, NOT base AND rival = 1 AND cover >= {licenses.COVER} AND span <= 1.5 * size + 2 AS near FROM x),
z AS (SELECT row_id, count(*) FILTER (WHERE exact) AS n_base, min(diagonal) FILTER (WHERE exact) AS first_word, max(diagonal) FILTER (WHERE exact) AS last_word, array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE exact))), ',') AS base_labels, array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE exact OR near))), ',') AS labels, max(CASE WHEN exact THEN 1.0 WHEN near THEN cover END) AS score FROM y GROUP BY row_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score FROM d LEFT JOIN z ON d.row_id = z.row_id"""


OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, {_lower} AS t FROM documents),
p AS (SELECT d, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS t FROM d),
w AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, unnest(w) AS g, 1 AS k FROM w
      UNION ALL SELECT lang, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]), 2 FROM w WHERE len(w) > 1
      UNION ALL SELECT lang, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]), 3 FROM w WHERE len(w) > 2),
f AS (SELECT lang, g, k, count(*) AS f, string_split(g, ' ') AS w FROM g GROUP BY ALL HAVING count(*) >= 10),
cut AS (SELECT c.lang, c.g, c.w, c.k, c.f AS a, x.f AS l, y.f AS r, x.k AS place, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score FROM f c
    JOIN f x ON x.lang = c.lang AND x.k < c.k AND x.g = array_to_string(c.w[:x.k], ' ') JOIN f y ON y.lang = c.lang AND y.k = c.k - x.k AND y.g = array_to_string(c.w[x.k + 1:], ' ') WHERE c.k > 1),
c AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, place) = 1),
part AS (SELECT lang, array_to_string(w[1:2], ' ') AS g, a FROM c WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3),
longer AS (SELECT lang, g, max(a) AS longer FROM part GROUP BY lang, g),
kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, g) WHERE longer IS NULL OR 100 * longer < 50 * a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, g AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM r JOIN n USING (lang) WHERE rank <= 2000"""

OP12 = f"""
WITH d AS (SELECT doc_id, {_lower} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM d"""

ORACLES = {"op1_jaccard_join": OP1, "op7_licenses": op7(), "op11_collocations": OP11, "op12_exact_dedup": OP12}
