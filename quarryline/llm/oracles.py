"""SQL (DuckDB dialect) for the queries of this subpackage that SQL can express: joins and searches, not learned models or codes."""

from __future__ import annotations

from quarryline.llm import licenses

_TOP_K = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10"""

_REACH = """reach AS (
  SELECT id, id AS other FROM items
  UNION
  SELECT r.id, l.b FROM reach r JOIN linked l ON l.a = r.other),
classes AS (SELECT id, min(other) AS class FROM reach GROUP BY id),
degrees AS (SELECT a AS id, count(*) AS n FROM linked GROUP BY a)"""

_CAPS = f"""WITH RECURSIVE items AS (
  SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings),
linked AS (
  SELECT x.id AS a, y.id AS b FROM items x JOIN items y ON x.label = y.label AND x.id <> y.id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
{_REACH}
SELECT i.id AS vec_id, coalesce(n, 0) AS n_links, class AS component_id, i.id = class AS kept
FROM items i JOIN classes c ON c.id = i.id LEFT JOIN degrees d ON d.id = i.id"""

_JACCARD = rf"""WITH RECURSIVE items AS (
  SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT id, array_to_string(w[i + 1 : i + 5], ' ') AS s
  FROM items, LATERAL (SELECT unnest(range(greatest(1, len(w) - 4))) AS i) u WHERE len(w) > 0),
sizes AS (SELECT id, count(*) AS size FROM shingles GROUP BY id),
common AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM shingles x JOIN shingles y ON x.s = y.s AND x.id <> y.id GROUP BY x.id, y.id),
linked AS (
  SELECT a, b FROM common JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE shared * 9 >= (x.size + y.size) * 4),
{_REACH}
SELECT i.id AS doc_id, class AS class_id, coalesce(n, 0) AS n_links, i.id = class AS kept
FROM items i JOIN classes c ON c.id = i.id LEFT JOIN degrees d ON d.id = i.id"""


def _licences() -> str:
    rows = []
    sources = [(label, phrase, "TRUE") for phrase, label in licenses.PHRASES] + [(label, text, "FALSE") for label, text in licenses.TEMPLATES]
    for number, (label, text, exact) in enumerate(sources):
        words = licenses.plain_words(text)
        n = len(words) - licenses.K + 1
        rows += [f"({number}, '{label}', {exact}, {n}, {i}, '{' '.join(words[i : i + licenses.K])}')" for i in range(n)]
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""WITH grams(template, label, exact, n_grams, pos, gram) AS (VALUES {', '.join(rows)}),
docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array({small}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
placed AS (
  SELECT doc_id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS gram
  FROM docs, LATERAL (SELECT unnest(range(greatest(0, len(w) - 2))) AS i) u),
votes AS (
  SELECT doc_id, template, label, exact, n_grams, i - pos AS diagonal, count(*) AS votes
  FROM placed JOIN grams USING (gram) GROUP BY ALL),
steps AS (
  SELECT *, (diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {licenses.BAND})::INT AS far FROM votes),
banded AS (SELECT *, sum(coalesce(far, 0)) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS band FROM steps),
bands AS (
  SELECT doc_id, label, exact, sum((exact AND votes = n_grams)::INT) AS places,
         min(CASE WHEN exact AND votes = n_grams THEN diagonal END) AS first, max(CASE WHEN exact AND votes = n_grams THEN diagonal END) AS last,
         least(sum(votes) / n_grams, 1.0) AS part
  FROM banded GROUP BY doc_id, template, label, exact, n_grams, band),
shares AS (SELECT *, CASE WHEN exact THEN (places > 0)::INT::DOUBLE ELSE part::DOUBLE END AS share FROM bands),
found AS (
  SELECT doc_id, sum(places)::BIGINT AS n_base, min(first)::BIGINT AS first_word, max(last)::BIGINT AS last_word,
         string_agg(DISTINCT CASE WHEN exact AND places > 0 THEN label END, ',' ORDER BY CASE WHEN exact AND places > 0 THEN label END) AS base_labels,
         string_agg(DISTINCT CASE WHEN (exact AND places > 0) OR (NOT exact AND share >= {licenses.COVERAGE}) THEN label END, ','
           ORDER BY CASE WHEN (exact AND places > 0) OR (NOT exact AND share >= {licenses.COVERAGE}) THEN label END) AS labels,
         max(share) AS score
  FROM shares GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs d LEFT JOIN found f ON f.doc_id = d.doc_id"""


def _crc32(text: str) -> str:
    """The crc32 of a short ASCII text, bit by bit."""
    shift = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: ascii({text}[i])::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {shift}), 4294967295::BIGINT)"


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_MIX = f"""WITH docs AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         md5('mix|' || coalesce(doc_id::VARCHAR, '-') || '|' || coalesce(md5(text), '-')) AS seeded FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM docs GROUP BY source),
-- A source is full when the others, less full per weight, leave it more than twice its size.
filling AS (
  SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER earlier, 0) AS halves,
         sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS weights
  FROM sources WINDOW earlier AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT halves, weights FROM filling WHERE halves * weight < 4 * source_size * weights
  ORDER BY source_size / weight, source NULLS LAST LIMIT 1),
goals AS (
  SELECT s.source, source_size, CASE WHEN l.halves * weight < 4 * source_size * l.weights THEN l.halves * weight ELSE 2 * source_size END::BIGINT AS up,
         CASE WHEN l.halves * weight < 4 * source_size * l.weights THEN 2 * l.weights ELSE 1 END::BIGINT AS down
  FROM sources s LEFT JOIN level l ON TRUE),
placed AS (
  SELECT d.*, source_size, up / down AS target, (2 * up + down) // (2 * down) AS quota,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY seeded, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, size, source_size, round(target::DOUBLE, 6) AS target,
       CASE WHEN source_size = 0 THEN 0 ELSE quota // source_size * size + greatest(0, least(size, quota % source_size - earlier)) END::BIGINT AS taken
FROM placed"""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _manifest() -> str:
    plain = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    climb = """SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value(n + 2) // 3
  FROM {0} WHERE n > 1 GROUP BY tree, level, pos // 3"""
    return f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_field("source")} AS tree, sha256({plain} || {_field("text")}) AS leaf,
         sha256({plain} || {_field("changed")}) AS tampered
  FROM (SELECT *, CASE WHEN {_crc32("coalesce(doc_id::VARCHAR, '')")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM documents)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
low(tree, level, pos, h, n) AS (
  SELECT tree, 0, pos, leaf, n FROM placed
  UNION ALL {climb.format("low")}),
subroots AS (
  SELECT l.tree, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM low l JOIN (SELECT DISTINCT tree, source FROM leaves) s ON s.tree = l.tree WHERE l.n = 1),
high(tree, level, pos, h, n) AS (
  SELECT 0, 0, place, subroot, n FROM subroots
  UNION ALL {climb.format("high")}),
runs AS (
  SELECT tree, level, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM low WHERE n > 1 GROUP BY ALL),
top_runs AS (
  SELECT level, pos // 3 AS parent, list(h ORDER BY pos) AS hs FROM high WHERE n > 1 GROUP BY ALL),
ways AS (
  SELECT p.tree, p.pos, r.level, r.hs, (p.pos // (3 ** r.level)::BIGINT) % 3 AS slot
  FROM placed p JOIN runs r ON r.tree = p.tree AND r.parent = p.pos // (3 ** (r.level + 1))::BIGINT
  UNION ALL
  SELECT p.tree, p.pos, 1000 + r.level, r.hs, (s.place // (3 ** r.level)::BIGINT) % 3
  FROM placed p JOIN subroots s ON s.tree = p.tree JOIN top_runs r ON r.parent = s.place // (3 ** (r.level + 1))::BIGINT),
paths AS (
  SELECT tree, pos, list({{'a': array_to_string(hs[1:slot], ''), 'z': array_to_string(hs[slot + 2:], '')}} ORDER BY level) AS path
  FROM ways GROUP BY tree, pos),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT h FROM high WHERE n = 1) AS root,
         sha256(array_to_string(list_transform(coalesce(path, []), lambda x: x.a || x.z), '')) AS proof_sha256,
         list_reduce([{{'a': tampered, 'z': ''}}] || coalesce(path, []), lambda x, s: {{'a': sha256(s.a || x.a || s.z), 'z': ''}}).a AS folded_root
  FROM placed p JOIN subroots s ON s.tree = p.tree LEFT JOIN paths w ON w.tree = p.tree AND w.pos = p.pos)
SELECT *, folded_root = root AS verified FROM folded"""


_RUNS = f"""WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, w, len(w)::BIGINT AS n, {_crc32("coalesce(doc_id::VARCHAR, '')")} AS h
  FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
chosen AS (SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM split),
docs AS (
  SELECT row, doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i: w[(CASE WHEN i < a THEN i ELSE a + (i - a) % p END) + 1]) ELSE w END AS w
  FROM chosen),
words AS (SELECT row, n, unnest(w) AS word, unnest(range(n)) AS i FROM docs),
pairs AS (
  SELECT x.row, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT row, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY row, q, island),
runs AS (
  SELECT row, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY row, start, length),
listed AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
         first({{'start': start, 'length': length, 'period': period}} ORDER BY length / period DESC, start, period) AS best
  FROM runs GROUP BY row),
dropped AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period,
       (1000 * best.length // best.period)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (row) LEFT JOIN kept USING (row)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_topk": _TOP_K, "op4_jaccard_join": _JACCARD, "op5_licenses": _licences(), "op6_caps": _CAPS,
        "op11_mixing": _MIX, "op12_merkle": _manifest(), "op13_periods": _RUNS,
    }
