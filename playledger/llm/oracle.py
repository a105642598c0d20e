"""DuckDB SQL of the registered queries, where SQL can express them."""

from __future__ import annotations

_RULES = {
    "few_words": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > n_words",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)",
}


def _share(name: str) -> str:
    """The shrunk share of one rule per host, over ``hosts`` and the one row ``tot``."""
    mean = f"((tot.s_{name} + 0.5) / (tot.n + 1.0))"
    chance = f"({mean} * (1 - {mean}))"
    spread = f"(tot.q_{name} - tot.s_{name} * tot.s_{name} / tot.n::DOUBLE - (tot.hosts - 1) * {chance})"
    room = f"((tot.n - tot.n2 / tot.n - (tot.hosts - 1)) * {chance})"
    weight = (
        f"(CASE WHEN {room} > 0 AND {spread} > 0 "
        f"THEN least(greatest({room} / {spread} - 1.0, 1.0), 10000.0) ELSE 10000.0 END)"
    )
    return f"((h.f_{name} + {mean} * {weight}) / (h.n_docs + {weight}))"


_NAMES = ["any", *_RULES]
_COUNTS = ", ".join(f"sum(CASE WHEN r_{n} THEN 1 ELSE 0 END)::DOUBLE AS f_{n}" for n in _NAMES)
_SUMS = ", ".join(f"sum(f_{n}) AS s_{n}, sum(f_{n} * f_{n} / n_docs) AS q_{n}" for n in _NAMES)
_BAD = ", ".join(f"{_share(n)} >= {0.8 if n == 'any' else 0.5} AS b_{n}" for n in _NAMES)
_LOST = " OR ".join(["coalesce(b_any, false)", *(f"(r_{n} AND coalesce(b_{n}, false))" for n in _RULES)])

OP7 = rf"""
WITH doc AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc)),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (
    SELECT doc_id, i, unnest(range(5)) AS k FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM spots) WHERE c > 1)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM doc)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc.doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM doc LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
r AS (
  SELECT *, r_few_words OR r_repeats OR r_symbols OR r_dup_lines OR r_word_length AS r_any
  FROM (SELECT *, {", ".join(f"({c}) AS r_{n}" for n, c in _RULES.items())} FROM m)),
hosts AS (
  SELECT source AS host, count(*)::DOUBLE AS n_docs, {_COUNTS} FROM r WHERE source IS NOT NULL GROUP BY source),
tot AS (
  SELECT count(*)::DOUBLE AS hosts, sum(n_docs) AS n, sum(n_docs * n_docs) AS n2, {_SUMS} FROM hosts),
verdict AS (SELECT h.host, {_BAD} FROM hosts h, tot)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       r_few_words OR r_repeats AS base_failed, NOT (r_few_words OR r_repeats) AND NOT ({_LOST}) AS kept
FROM r LEFT JOIN verdict ON source = host
"""

OP2 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_have AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM both_have JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
side AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, side.b FROM reach JOIN side ON reach.b = side.a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)
"""

OP8 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

OP11 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
link AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.93),
side AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, side.b FROM reach JOIN side ON reach.b = side.a),
n AS (SELECT a, count(*) AS n FROM side GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n ON n.a = vec_id
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, term, source, count(*) AS n, count(DISTINCT doc) AS docs FROM t GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::BIGINT AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
big AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
cell AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.n AS n_lang
  FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS MATERIALIZED (
  SELECT cell.*, (1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v))::BIGINT AS p,
         (1 + (1000000000::HUGEINT * (n_lang + 1)) // (total + v))::BIGINT AS q
  FROM cell JOIN big USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(pair.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN pair ON pair.lang = x.lang AND pair.source = x.source AND pair.item = y.source),
every AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT lang, source, part, item, value,
         (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank FROM every)
WHERE part = 'pair' OR rank <= 200
"""


def _op13() -> str:
    """Six rounds written out, each a few tables."""
    down = "(({s} - ((({s} % {c}) + {c}) % {c})) // {c})"
    part = "list_slice(x, {i} * len(x) // 8 + 1, ({i} + 1) * len(x) // 8)"
    ctes = [
        "v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, "
        "list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS x FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "y AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT r, {i} AS part, {part.format(i=i)} AS x FROM v" for i in range(8)) + ")",
        "book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS e FROM y WHERE r <= 16)",
    ]
    for k in range(7):
        distance = "list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
        ctes.append(
            f"near{k} AS MATERIALIZED (SELECT r, part, x, entry, d FROM (SELECT r, part, x, entry, {distance} AS d "
            f"FROM y JOIN book{k} USING (part)) QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1)"
        )
        if k < 6:
            mean = down.format(s="sum(c)::BIGINT", c="count(*)")
            ctes.append(
                f"mean{k} AS MATERIALIZED (SELECT part, entry, list(m ORDER BY i) AS e FROM (SELECT part, entry, i, {mean} AS m FROM "
                f"(SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM near{k}) GROUP BY part, entry, i) GROUP BY part, entry)"
            )
            ctes.append(
                f"book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{k} b "
                f"LEFT JOIN mean{k} m ON m.part = b.part AND m.entry = b.entry)"
            )
    ctes.append(
        "coded AS MATERIALIZED (SELECT r, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near6 GROUP BY r)"
    )
    ctes.append("sha AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS s FROM book6)")
    return (
        f"WITH {', '.join(ctes)} SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, "
        "s AS codebooks_sha256 FROM coded JOIN v USING (r), sha"
    )


ORACLE: dict[str, str] = {
    "op2_setsketch": OP2,
    "op7_host_rules": OP7,
    "op8_exact_dedup": OP8,
    "op11_cap_filters": OP11,
    "op12_source_divergence": OP12,
    "op13_pivot_codes": _op13(),
}
