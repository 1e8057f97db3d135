"""The results of ``catalog`` in plain SQL over the same tables (DuckDB dialect)."""

from __future__ import annotations

DIM, K, CUT = 64, 15, 10
PROBES, SOURCE = (1, 4, 10), "src0"
_RULE = "-" * 30
_WORD = r"[^\p{L}\p{N}]+"


def _tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{_WORD}'), lambda t: t <> '')"


def _collapse(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def _hash(text: str) -> str:
    return f"sha256({_collapse(text)})"


def _markdown(title: str, text: str) -> str:
    marks = {
        "A": r"\n## A", "L": r"\n### L", "E": rf"\n{_RULE}\nE", "O": r"\n```\nO", "T": r"\n\nT", "I": r"\n\n### I",
    }
    for letter, mark in marks.items():
        text = f"replace({text}, '. {letter}', e'.{mark}')"
    return rf"'## ' || {title} || e'\n' || {text}"


_CORPUS = f"""corpus AS (
  SELECT source || '::' || doc_id || '.md' AS doc_id, source, {_markdown('lang', 'text')} AS text FROM documents)"""
_TURNS = f"""turns AS (
  SELECT role || '::' || conv_id || '-' || turn AS doc_id, role AS source, {_markdown('role', 'text')} AS text
  FROM conversations)"""


def _blocks(corpus: str) -> str:
    return rf"""blocks AS (
  SELECT doc_id, source, CAST(u.i - 1 AS INTEGER) AS block, kept[u.i] AS block_text
  FROM (SELECT doc_id, source, list_filter(list_transform(regexp_split_to_array(text, '(?m)^-{{30,}}\s*$'),
          lambda b: {_strip('b')}), lambda b: b <> '') AS kept FROM {corpus}) t,
       LATERAL (SELECT unnest(range(1, len(kept) + 1)) AS i) u)"""


_LINES = r"regexp_split_to_array(block_text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]')"
_TOPIC_RE = r"^\s*###\s+(.+?)\s*$"
_TOPIC = rf"""coalesce(nullif({_strip(f"regexp_extract(list_filter(list_filter({_LINES}, lambda x: {_strip('x')} <> '')[1:12], lambda x: regexp_matches(x, '{_TOPIC_RE}'))[1], '{_TOPIC_RE}', 1)")}, ''), 'General')"""

_SECTIONS = rf"""lines AS (
  SELECT doc_id, source, block, {_TOPIC} AS topic, u.i AS line_no, {_strip('lines[u.i]')} AS line
  FROM (SELECT *, {_LINES} AS lines FROM blocks) t, LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i) u),
fences AS (
  SELECT *, (line LIKE '```%' OR line LIKE '~~~%') AS is_fence,
         sum((line LIKE '```%' OR line LIKE '~~~%')::INT) OVER w AS n_fences
  FROM lines WINDOW w AS (PARTITION BY doc_id, block ORDER BY line_no)),
levels AS (
  SELECT *, (is_fence OR n_fences % 2 = 1) AS fenced,
         CASE WHEN is_fence OR n_fences % 2 = 1 THEN 0 WHEN regexp_matches(line, '^###(\s|$)') THEN 3
              WHEN regexp_matches(line, '^##(\s|$)') THEN 2 ELSE 0 END AS level
  FROM fences),
paths AS (
  SELECT *, last_value(CASE WHEN level = 2 THEN title END IGNORE NULLS) OVER w AS h2,
         max(CASE WHEN level = 2 THEN line_no END) OVER w AS h2_line,
         last_value(CASE WHEN level = 3 THEN title END IGNORE NULLS) OVER w AS h3_title,
         max(CASE WHEN level = 3 THEN line_no END) OVER w AS h3_line,
         sum((level > 0 OR (NOT fenced AND line = ''))::INT) OVER w AS gap
  FROM (SELECT *, {_strip("regexp_replace(line, '^#+', '')")} AS title FROM levels)
  WINDOW w AS (PARTITION BY doc_id, block ORDER BY line_no)),
body AS (
  SELECT *, CASE WHEN h2_line IS NULL OR h3_line > h2_line THEN h3_title END AS h3
  FROM paths WHERE level = 0 AND (fenced OR line <> '')),
marked AS (
  SELECT *, lag(gap) OVER w AS gap_before,
         (lag(line_no) OVER w IS NULL OR lag(h2) OVER w IS DISTINCT FROM h2 OR lag(h3) OVER w IS DISTINCT FROM h3) AS starts
  FROM body WINDOW w AS (PARTITION BY doc_id, block ORDER BY line_no)),
numbered AS (
  SELECT *, sum(starts::INT) OVER (PARTITION BY doc_id, block ORDER BY line_no) - 1 AS section_no FROM marked),
sections AS (
  SELECT doc_id, block, CAST(section_no AS INTEGER) AS section_no, any_value(source) AS source, any_value(topic) AS topic,
         any_value(h2) AS h2, any_value(h3) AS h3,
         string_agg(CASE WHEN starts THEN '' WHEN gap_before = gap THEN e'\n' ELSE e'\n\n' END || line, '' ORDER BY line_no)
           AS section_text
  FROM numbered GROUP BY doc_id, block, section_no),
labelled AS (
  SELECT *, CASE WHEN coalesce(nullif(h3, ''), nullif(h2, ''), 'Overview') = topic THEN 'Overview'
                 ELSE coalesce(nullif(h3, ''), nullif(h2, ''), 'Overview') END AS section
  FROM sections)"""
SIZE, OVERLAP = 2000, 300


def _packs(name: str, source: str, sep: str) -> str:
    """Greedy packing of the parts of (k, o1, o2, text) between separators: CTEs ``<name>_w`` (windows) and ``<name>_b`` (parts
    above the size). A step goes from one full pack to the next; ``s`` is the first part of the pack, ``c`` the next part."""
    return rf"""{name}_p AS (
  SELECT k, o1, o2, string_split(text, {sep}) AS parts, list_transform(string_split(text, {sep}), lambda p: length(p)) AS lens FROM {source}),
{name}_t AS (
  SELECT p.k, p.o1, p.o2, parts, lens, len(parts) AS n, sums FROM {name}_p p JOIN (
    SELECT k, o1, o2, list(total ORDER BY i) AS sums FROM (
      SELECT k, o1, o2, i, coalesce(sum(l + length({sep})) OVER (PARTITION BY k, o1, o2 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS total
      FROM (SELECT k, o1, o2, unnest(lens || [0]) AS l, unnest(range(len(lens) + 1)) AS i FROM {name}_p)) GROUP BY k, o1, o2) q
  ON q.k = p.k AND q.o1 = p.o1 AND q.o2 = p.o2),
{name}_r AS (
  SELECT k, o1, o2, 0 AS step, 0::BIGINT AS s, 0::BIGINT AS c, 0::BIGINT AS ws, 0::BIGINT AS we, NULL::BIGINT AS big FROM {name}_t
  UNION ALL
  SELECT k, o1, o2, step + 1,
         CASE WHEN lens[e + 1] > {SIZE} THEN e + 1 ELSE list_filter(range(s, e + 1), lambda x: x = e OR
           (sums[e + 1] - sums[x + 1] - length({sep}) <= {OVERLAP} AND sums[e + 1] - sums[x + 1] + lens[e + 1] <= {SIZE}))[1] END,
         e + 1, s, coalesce(e, n), CASE WHEN lens[e + 1] > {SIZE} THEN e END
  FROM (SELECT r.k, r.o1, r.o2, r.step, r.s, t.n, t.lens, t.sums, list_filter(range(r.c, least(t.n, r.s + {SIZE} + 3)), lambda x:
          (x > r.s AND t.sums[x + 1] - t.sums[r.s + 1] + t.lens[x + 1] > {SIZE}) OR t.lens[x + 1] > {SIZE})[1] AS e
        FROM {name}_r r JOIN {name}_t t ON t.k = r.k AND t.o1 = r.o1 AND t.o2 = r.o2 WHERE r.c IS NOT NULL) stepped),
{name}_w AS (
  SELECT r.k, r.o1, r.o2, r.step, array_to_string(parts[ws + 1 : we], {sep}) AS text
  FROM {name}_r r JOIN {name}_t t ON t.k = r.k AND t.o1 = r.o1 AND t.o2 = r.o2 WHERE we > ws),
{name}_b AS (
  SELECT r.k, r.o1, r.o2, r.step, parts[big + 1] AS text
  FROM {name}_r r JOIN {name}_t t ON t.k = r.k AND t.o1 = r.o1 AND t.o2 = r.o2 WHERE big IS NOT NULL)"""


def size_split(source: str) -> str:
    """CTE ``pieces`` (k, piece_no, piece) of ``source`` (k, text): blank lines, then spaces, then characters."""
    return rf"""long_texts AS (SELECT k, text FROM {source} WHERE length(text) > {SIZE}),
by_line AS (SELECT k, 0 AS o1, 0 AS o2, text FROM long_texts WHERE contains(text, e'\n\n')),
{_packs('a', 'by_line', r"e'\n\n'")},
finer AS (
  SELECT k, 0 AS o1, text FROM long_texts WHERE NOT contains(text, e'\n\n') UNION ALL SELECT k, step, text FROM a_b),
by_word AS (SELECT k, o1, 0 AS o2, text FROM finer WHERE contains(text, ' ')),
{_packs('b', 'by_word', "' '")},
whole AS (SELECT k, o1, 0 AS o2, text FROM finer WHERE NOT contains(text, ' ') UNION ALL SELECT k, o1, step, text FROM b_b),
loose AS (
  SELECT k, 0 AS o1, 0 AS o2, 0 AS o3, text FROM {source} WHERE length(text) <= {SIZE}
  UNION ALL SELECT k, step, 0, 0, text FROM a_w
  UNION ALL SELECT k, o1, step, 0, text FROM b_w
  UNION ALL SELECT k, o1, o2, i + 1, substr(text, i * {SIZE - OVERLAP} + 1, {SIZE})
    FROM whole, LATERAL (SELECT unnest(range(greatest(1, ceil((length(text) - {OVERLAP}) / {SIZE - OVERLAP}))::BIGINT)) AS i) u),
stripped AS (SELECT k, o1, o2, o3, {_strip('text')} AS piece FROM loose),
pieces AS (
  SELECT k, row_number() OVER (PARTITION BY k ORDER BY o1, o2, o3) - 1 AS piece_no, piece FROM stripped WHERE piece <> '')"""


_DOC_SECTIONS = ",\n".join([_CORPUS, _blocks("corpus"), _SECTIONS])
_CHUNKS = f"""section_texts AS (
  SELECT doc_id || chr(31) || block || chr(31) || section_no AS k, section_text AS text FROM labelled),
{size_split('section_texts')},
numbered_chunks AS (
  SELECT l.*, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY block, section_no, piece_no) - 1 AS INTEGER) AS doc_chunk_index,
         substr(doc_id, length(source) + 3) AS relative_path,
         'Topic: ' || topic || e'\\nSection: ' || section || e'\\n\\n' || piece AS content
  FROM labelled l JOIN pieces p ON p.k = doc_id || chr(31) || block || chr(31) || section_no),
chunks_named AS (SELECT *, doc_id || '::' || lpad(doc_chunk_index::VARCHAR, 5, '0') AS chunk_id FROM numbered_chunks)"""
_ALL_SECTIONS = ",\n".join(
    [_CORPUS, _TURNS, "both_corpora AS (SELECT * FROM corpus UNION ALL SELECT * FROM turns)", _blocks("both_corpora"), _SECTIONS]
)


def _dense(name: str) -> str:
    return f"""{name}_v AS (
  SELECT g.k, list(coalesce(w.weight, 0)::DOUBLE ORDER BY g.b) AS v
  FROM (SELECT k, b FROM (SELECT DISTINCT k FROM {name}_w), (SELECT unnest(range({DIM})) AS b)) g
       LEFT JOIN {name}_w w ON w.k = g.k AND w.bucket = g.b
  GROUP BY g.k)"""


def _weights(name: str, key: str, text: str, source: str) -> str:
    return f"""{name}_c AS (
  SELECT k, ('0x' || substr(md5(t), 1, 8))::BIGINT % {DIM} AS bucket, count(*) AS c
  FROM (SELECT {key} AS k, unnest({_tokens(text)}) AS t FROM {source}) GROUP BY ALL),
{name}_w AS (SELECT k, bucket, (c / sqrt(sum(c * c) OVER (PARTITION BY k)))::FLOAT AS weight FROM {name}_c)"""


_DOC_WEIGHTS = _weights("d", "doc_id::VARCHAR", "text", "documents")
_QUERY_WEIGHTS = _weights("q", "'bench_' || item_id", "text", "benchmark")
_DOC_VECTORS = f"{_DOC_WEIGHTS},\n{_dense('d')}"


def _nearest(name: str, queries: str, chunks: str, keys: str = "query_id, query_text") -> str:
    """Best K of (chunk_id, chunk_text, v) for each of (query_id, query_text, v)."""
    return f"""{name} AS (
  SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY dist, chunk_id) AS INTEGER) AS rank,
         round(dist, 6) AS dist, chunk_id, chunk_text
  FROM (SELECT q.* EXCLUDE (v), c.chunk_id, c.chunk_text, round(list_cosine_distance(q.v, c.v), 9) AS dist
        FROM {queries} q, {chunks} c)
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY dist, chunk_id) <= {K})"""


_DOC_CHUNKS = """chunks AS (
  SELECT doc_id::VARCHAR AS chunk_id, text AS chunk_text, source, v FROM documents JOIN d_v ON d_v.k = doc_id::VARCHAR)"""
_ASKED = """asked AS (
  SELECT 'bench_' || item_id AS query_id, text AS query_text, v FROM benchmark JOIN q_v ON q_v.k = 'bench_' || item_id)"""
_VECTOR_HITS = ",\n".join(
    [_DOC_VECTORS, _QUERY_WEIGHTS, _dense("q"), _DOC_CHUNKS, _ASKED, _nearest("vhits", "asked", "chunks")]
)
_SOURCE_HITS = f"""{_VECTOR_HITS},
of_source AS (SELECT * FROM chunks WHERE source = '{SOURCE}'), {_nearest('vhits_s', 'asked', 'of_source')}"""

_LABEL_HITS = f"""means AS (
  SELECT label, i, round(avg(embedding[i]::DOUBLE), 6) AS m
  FROM embeddings, (SELECT unnest(range(1, {DIM} + 1)) AS i) GROUP BY label, i),
label_asked AS (
  SELECT 'label_' || label AS query_id, label::VARCHAR AS query_text, list(m ORDER BY i) AS v FROM means GROUP BY label),
vecs AS (SELECT vec_id::VARCHAR AS chunk_id, label::VARCHAR AS chunk_text, embedding::DOUBLE[] AS v FROM embeddings),
{_nearest('lhits', 'label_asked', 'vecs')}"""

_UNIT = "list_transform(v, lambda x: x / sqrt(list_inner_product(v, v)))"
_CELL_HITS = f"""{_LABEL_HITS},
centres AS (SELECT query_text::INT AS cell, v AS m FROM label_asked),
chunk_cells AS (
  SELECT chunk_id, cell FROM (SELECT chunk_id, {_UNIT} AS u FROM vecs), centres
  QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY round(list_inner_product(m, m) - 2 * list_inner_product(u, m), 9), cell) = 1),
query_cells AS (
  SELECT query_id, cell, row_number() OVER (PARTITION BY query_id
           ORDER BY round(list_inner_product(m, m) - 2 * list_inner_product(u, m), 9), cell) AS nth
  FROM (SELECT query_id, {_UNIT} AS u FROM label_asked), centres),
cell_hits AS (
  SELECT query_id, query_text, 'hnsw_ef' || p || '_k{K}' AS run_name, p AS param_value,
         CAST(row_number() OVER (PARTITION BY query_id, p ORDER BY dist, chunk_id) AS INTEGER) AS rank, round(dist, 6) AS dist, chunk_id, chunk_text
  FROM (SELECT q.query_id, q.query_text, p, c.chunk_id, c.chunk_text, round(list_cosine_distance(q.v, c.v), 9) AS dist
        FROM label_asked q JOIN query_cells n ON n.query_id = q.query_id JOIN (SELECT unnest({list(PROBES)}) AS p) ON n.nth <= p
             JOIN chunk_cells b ON b.cell = n.cell JOIN vecs c ON c.chunk_id = b.chunk_id)
  QUALIFY row_number() OVER (PARTITION BY query_id, p ORDER BY dist, chunk_id) <= {K})"""

_POSTINGS = f"""toks AS (SELECT doc_id::VARCHAR AS chunk_id, {_tokens('text')} AS ts FROM documents),
postings AS (
  SELECT chunk_id, token, count(*) AS tf, any_value(dl) AS dl
  FROM (SELECT chunk_id, len(ts) AS dl, unnest(ts) AS token FROM toks) GROUP BY chunk_id, token),
token_df AS (SELECT token, count(*) AS df FROM postings GROUP BY token),
totals AS (SELECT count(*) AS n_chunks, avg(len(ts)) AS avg_dl FROM toks)"""
_KEYWORD_HITS = f"""{_POSTINGS},
terms AS (SELECT DISTINCT 'bench_' || item_id AS query_id, unnest({_tokens('text')}) AS token FROM benchmark),
scores AS (
  SELECT query_id, chunk_id, round(sum(ln(1 + (n_chunks - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
           / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avg_dl))), 6) AS score
  FROM terms JOIN postings USING (token) JOIN token_df USING (token), totals GROUP BY query_id, chunk_id),
khits AS (
  SELECT query_id, b.text AS query_text, CAST(rank AS INTEGER) AS rank, score, chunk_id, d.text AS chunk_text
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM scores) s
       JOIN benchmark b ON 'bench_' || b.item_id = query_id JOIN documents d ON d.doc_id::VARCHAR = chunk_id
  WHERE rank <= {K})"""

_SOURCE_KEYWORD_HITS = f"""{_KEYWORD_HITS},
khits_s AS (
  SELECT query_id, b.text AS query_text, CAST(rank AS INTEGER) AS rank, score, chunk_id, s.text AS chunk_text
  FROM (SELECT s.*, d.text, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
        FROM scores s JOIN documents d ON d.doc_id::VARCHAR = chunk_id WHERE d.source = '{SOURCE}') s
       JOIN benchmark b ON 'bench_' || b.item_id = query_id
  WHERE rank <= {K})"""


def _fused(name: str, parts: str) -> str:
    """``parts``: (query_id, query_text, chunk_id, chunk_text, part)."""
    return f"""{name}_s AS (
  SELECT query_id, query_text, chunk_id, chunk_text, sum(part) AS score FROM ({parts}) GROUP BY ALL),
{name} AS (
  SELECT query_id, query_text, chunk_id, chunk_text, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, query_text, chunk_id) AS INTEGER) AS rank
  FROM (SELECT * FROM {name}_s
        QUALIFY row_number() OVER (PARTITION BY query_id, chunk_id ORDER BY query_text, chunk_text) = 1))"""


def _part(hits: str, weight: float, times: int = 1) -> str:
    return f"""SELECT query_id, query_text, chunk_id, chunk_text, {weight * times}::DOUBLE / (60 + rank) AS part FROM {hits}"""


_FUSED_HITS = ",\n".join(
    [_VECTOR_HITS, _KEYWORD_HITS, _fused("fused", f"{_part('vhits', 0.5)} UNION ALL {_part('khits', 0.5)}")]
)
_RERANKED = f"""scored AS (
  SELECT f.*, len(list_intersect(q, {_tokens('chunk_text')})) / len(q) AS rerank_score
  FROM fused f, LATERAL (SELECT list_distinct({_tokens('f.query_text')}) AS q) t),
reranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(rerank_score, 9) DESC, rank, chunk_id) AS INTEGER)
           AS rank_reranked
  FROM scored
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(rerank_score, 9) DESC, rank, chunk_id) <= {CUT})"""
_TRUTH = """truth AS (
  SELECT query_id, chunk_id, max(quality * 2 + (1 - toxic)) AS relevance
  FROM khits JOIN labels ON doc_id::VARCHAR = chunk_id GROUP BY ALL)"""

_JUDGED = """judged AS (
  SELECT source AS query_id, sha256(text) AS chunk_id, n_chars AS rank, quality * 2 + (1 - toxic) AS relevance
  FROM documents LEFT JOIN labels USING (doc_id))"""


def _scores(hits: str, keys: str = "query_id") -> str:
    """CTE ``qs``: scores of every query in ``hits`` (keys, chunk_id, rank, relevance)."""
    return f"""distinct_hits AS (
  SELECT {keys}, chunk_id, rank, coalesce(relevance, 0) AS rel FROM {hits}
  QUALIFY row_number() OVER (PARTITION BY {keys}, chunk_id ORDER BY rank NULLS LAST, coalesce(relevance, 0)) = 1),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY rank NULLS LAST, chunk_id) AS p,
         row_number() OVER (PARTITION BY {keys} ORDER BY rel DESC) AS best
  FROM distinct_hits),
running AS (SELECT *, sum((rel > 1)::INT) OVER (PARTITION BY {keys} ORDER BY p) AS found FROM placed),
qs AS (
  SELECT {keys}, sum(CASE WHEN p <= {CUT} THEN (pow(2, rel) - 1) / log2(p + 1) ELSE 0 END) AS dcg,
         sum(CASE WHEN best <= {CUT} THEN (pow(2, rel) - 1) / log2(best + 1) ELSE 0 END) AS ideal,
         sum((p <= {CUT} AND rel > 1)::INT) / {CUT} AS prec,
         coalesce(sum(CASE WHEN p <= {CUT} AND rel > 1 THEN found / p ELSE 0 END)
                  / nullif(sum((p <= {CUT} AND rel > 1)::INT), 0), 0) AS ap
  FROM running GROUP BY {keys})"""


_NDCG = "CASE WHEN ideal > 0 THEN dcg / ideal ELSE 0 END"
_MEANS = f"avg(prec) AS p_at_k, avg(ap) AS map_at_k, avg({_NDCG}) AS ndcg_at_k, avg(dcg) AS dcg_at_k"


def _rounded_means(decimals: int, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{m}, {decimals}) AS {m}" for m in ("p_at_k", "map_at_k", "ndcg_at_k", "dcg_at_k"))


_CHUNK_TABLE = f"""chunk_table AS (
  SELECT d.doc_id::VARCHAR AS id, lang AS document_id, n_chars::INT AS chunk_index, text AS content,
         CASE WHEN l.doc_id IS NULL THEN {_hash('text')} END AS content_hash,
         CASE WHEN lang <> 'de' THEN [1.0] END AS embedding
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
_TYPED = """typed AS (
  SELECT source AS query_id, sha256(text) AS chunk_id,
         CASE WHEN quality = 1 AND toxic = 0 THEN ' 2.7 ' WHEN quality = 1 THEN '1e0' WHEN toxic = 1 THEN 'bad'
              WHEN quality = 0 THEN '-1.5' END AS relevance
  FROM documents LEFT JOIN labels USING (doc_id))"""
_TYPED_TRUTH = f"""WITH {_TYPED}
SELECT query_id, chunk_id, max(CAST(coalesce(trunc(TRY_CAST(trim(relevance) AS DOUBLE)), 0) AS INTEGER)) AS relevance
FROM typed GROUP BY query_id, chunk_id"""

_PUBLISHED = f"""rows AS (
  SELECT source, doc_id AS chunk_index, text AS content, {_hash('text')} AS content_hash, lang,
         count(*) OVER (PARTITION BY source) AS n_nodes
  FROM documents),
kept AS (
  SELECT *, sha256(source || '|' || content_hash) AS id, sha256(source) AS document_id FROM rows
  QUALIFY row_number() OVER (PARTITION BY source, content_hash ORDER BY chunk_index) = 1)"""

_TURN_HITS = """SELECT conv_id::VARCHAR AS query_id, 'he said "' || role || '", then' AS query_text,
       'exact_k15' AS run_name, 50 AS param_value, CAST(turn + 1 AS INTEGER) AS rank, turn / 8 AS dist,
       conv_id || '-' || turn AS chunk_id, e' "quoted",\\n\\n' || text AS chunk_text FROM conversations"""

_ANSWERS = r"""base AS (
  SELECT conv_id || '-' || turn AS turn_id, text, to_json(struct_pack(refined_query := text))::VARCHAR AS plain
  FROM conversations),
inner_part AS (SELECT *, substr(plain, 2, length(plain) - 2) AS inside FROM base),
answers AS (
  SELECT turn_id, text, 'plain' AS form, plain AS raw FROM inner_part
  UNION ALL SELECT turn_id, text, 'full',
    '{"filters":{"p":"x"},"must_not":["y"],"confidence":"0.5",' || inside || '}' FROM inner_part
  UNION ALL SELECT turn_id, text, 'boolean', '{"confidence":true,' || inside || '}' FROM inner_part
  UNION ALL SELECT turn_id, text, 'list_filter', '{"filters":{"p":["x"]},' || inside || '}' FROM inner_part
  UNION ALL SELECT turn_id, text, 'null_filter', '{"filters":null,' || inside || '}' FROM inner_part
  UNION ALL SELECT turn_id, text, 'number_in_list', '{"must_not":[1],' || inside || '}' FROM inner_part
  UNION ALL SELECT turn_id, text, 'wrong_type', '{"refined_query":5}' FROM inner_part
  UNION ALL SELECT turn_id, text, 'tail', plain || ' done' FROM inner_part
  UNION ALL SELECT turn_id, text, 'list', '[' || plain || ']' FROM inner_part
  UNION ALL SELECT turn_id, text, 'two', plain || ',{"b":1}' FROM inner_part
  UNION ALL SELECT turn_id, text, 'prose', text FROM inner_part),
parsed AS (SELECT *, CASE WHEN json_valid(raw) THEN raw::JSON END AS j FROM answers),
judged_answers AS (
  SELECT *, coalesce(json_type(j) = 'OBJECT' AND json_type(j, '$.refined_query') = 'VARCHAR'
    AND (json_type(j, '$.filters') IS NULL
         OR (json_type(j, '$.filters') = 'OBJECT'
             AND len(list_filter(json_extract(j, '$.filters.*'), lambda x: json_type(x) <> 'VARCHAR')) = 0))
    AND (json_type(j, '$.must_not') IS NULL
         OR (json_type(j, '$.must_not') = 'ARRAY'
             AND len(list_filter(json_extract(j, '$.must_not[*]'), lambda x: json_type(x) <> 'VARCHAR')) = 0))
    AND (json_extract_string(j, '$.confidence') IS NULL OR json_type(j, '$.confidence') = 'BOOLEAN'
         OR TRY_CAST(json_extract_string(j, '$.confidence') AS DOUBLE) IS NOT NULL), FALSE) AS valid
  FROM parsed)"""


def _prompt_sql() -> str:
    lead = "Return ONLY valid JSON. No prose. No markdown."
    return rf"""WITH {_KEYWORD_HITS},
context AS (
  SELECT query_id, string_agg('Chunk ' || rank || e':\n' || chunk_text, e'\n\n' ORDER BY rank) AS context
  FROM khits WHERE rank <= 3 GROUP BY query_id),
people AS (
  SELECT 'bench_' || item_id AS query_id, text AS query_text FROM benchmark
  UNION ALL SELECT 'turn-' || conv_id || '-' || turn, '{{user_query}} ' || text FROM conversations),
prompts AS (
  SELECT query_id, e'Return {{JSON}}.\nChunks:\n' || coalesce(context, '(none)') || e'\nQuery: \'' || query_text || '''' AS prompt
  FROM people LEFT JOIN context USING (query_id))
SELECT query_id, prompt, e'{lead}\n\n' || prompt AS repair_prompt FROM prompts"""


def oracle_sql() -> dict[str, str]:
    run_hits = """runs AS (
  SELECT 'vector' AS run, query_id, chunk_id, rank FROM vhits
  UNION ALL SELECT 'bm25', query_id, chunk_id, rank FROM khits
  UNION ALL SELECT 'rrf', query_id, chunk_id, rank FROM fused
  UNION ALL SELECT 'reranked', query_id, chunk_id, rank FROM reranked),
run_labelled AS (
  SELECT run, r.query_id, r.chunk_id, rank, coalesce(t.relevance, 0) AS relevance
  FROM runs r LEFT JOIN truth t ON t.query_id = r.query_id AND t.chunk_id = r.chunk_id)"""
    rewritten = r"""versions AS (
  SELECT 'unparsed' AS run, 'bench_' || item_id AS query_id, text FROM benchmark
  UNION ALL SELECT 'parsed', 'bench_' || item_id, regexp_replace(text, '[.,]', '', 'g') FROM benchmark
  UNION ALL SELECT 'improved', 'bench_' || item_id, list_extract(string_split(text, '. '), -1) FROM benchmark
  UNION ALL SELECT 'augmented', 'bench_' || item_id, concat_ws(' ', b.text, chunk_text)
    FROM benchmark b LEFT JOIN khits k ON k.query_id = 'bench_' || item_id AND k.rank = 1)"""
    sql = {
        "s1_load_corpus": "SELECT source AS folder, TRUE AS named, sha256(text) AS text_hash FROM documents",
        "s2_read_queries": """SELECT 'q' || item_id AS id, 'usage' AS category, CAST(length(text) AS INTEGER) AS difficulty,
            text, 0 AS n_tags FROM benchmark""",
        "s3_read_labelled": f"""SELECT query_id, query_text, rank, dist, chunk_id, chunk_text, rank || '.7' AS relevance
            FROM ({_TURN_HITS})""",
        "s3_read_fused": f"""SELECT query_id, query_text, chunk_id, chunk_text, dist AS score, rank, ' 2 ' AS relevance
            FROM ({_TURN_HITS})""",
        "s3_read_truth": _TYPED_TRUTH,
        "s4_export_for_labelling": f"""SELECT query_id, run_name, param_value, rank, chunk_id, chunk_text, '' AS relevance
            FROM ({_TURN_HITS})""",
        "s5_result_sink": _TYPED_TRUTH,
        "s6_publish": f"""WITH {_PUBLISHED}
            SELECT id, document_id, source, chunk_index, content_hash, '{{"lang":"' || lang || '"}}' AS chunk_metadata,
                   'second' AS title, '{{"kind":"prose","n_nodes":' || n_nodes || '}}' AS doc_metadata, {DIM} AS dim
            FROM kept""",
        "s6_publish_changes": f"""WITH {_PUBLISHED},
            known AS (SELECT DISTINCT source, {_hash('text')} AS content_hash FROM documents WHERE lang <> 'fr')
            SELECT id, document_id, source, chunk_index, content_hash, k.content_hash IS NOT NULL AS carried
            FROM kept LEFT JOIN known k USING (source, content_hash)""",
        "s7_snapshot": f"WITH {_PUBLISHED} SELECT id AS chunk_id, source, content AS chunk_text FROM kept",
        "s7_snapshot_one_source": f"""WITH {_PUBLISHED} SELECT id AS chunk_id, source, content AS chunk_text FROM kept
            WHERE source = '{SOURCE}'""",
        "c1_blocks": f"WITH {_CORPUS}, {_blocks('corpus')} SELECT doc_id, block, block_text FROM blocks",
        "c2_block_topic": f"""WITH {_CORPUS}, {_TURNS},
            both_corpora AS (SELECT * FROM corpus UNION ALL SELECT * FROM turns), {_blocks('both_corpora')}
            SELECT doc_id, block, {_TOPIC} AS topic FROM blocks""",
        "c3_sections": f"WITH {_ALL_SECTIONS} SELECT doc_id, block, section_no, h2, h3, section_text FROM sections",
        "c4b_character_windows": """SELECT doc_id, CAST(i AS INTEGER) AS piece_no, substr(text, i * 1700 + 1, 2000) AS piece
            FROM documents, LATERAL (SELECT unnest(range(greatest(1, ceil((length(text) - 300) / 1700))::BIGINT)) AS i) u""",
        "c5_word_windows": r"""SELECT doc_id, CAST(i AS INTEGER) AS piece_no,
              CAST(len(w[i * 420 + 1 : i * 420 + 500]) AS INTEGER) AS n_words,
              array_to_string(w[i * 420 + 1 : i * 420 + 500], ' ') AS piece
            FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents),
                 LATERAL (SELECT unnest(range(greatest(1, ceil((len(w) - 80) / 420))::BIGINT)) AS i) u
            WHERE len(w) > 0""",
        "c6_section_label": f"WITH {_ALL_SECTIONS} SELECT doc_id, block, section_no, section FROM labelled",
        "c7_context_injection": f"""WITH {_ALL_SECTIONS} SELECT doc_id, block, section_no,
            'Topic: ' || topic || e'\\nSection: ' || section || e'\\n\\n' || section_text AS content FROM labelled""",
        "c8_chunk_ids": f"""WITH RECURSIVE {_DOC_SECTIONS}, {_CHUNKS} SELECT doc_id, doc_chunk_index, chunk_id FROM chunks_named""",
        "c4_recursive_split": f"""WITH RECURSIVE {_CORPUS}, texts AS (SELECT doc_id AS k, text FROM corpus), {size_split('texts')}
            SELECT doc_id, CAST(piece_no AS INTEGER) AS piece_no, piece FROM corpus LEFT JOIN pieces ON k = doc_id""",
        "c9_metadata": f"""WITH {_ALL_SECTIONS} SELECT doc_id, section_no, source AS meta_source,
            coalesce(h2, 'from document') AS meta_h2, h3 AS meta_h3, topic AS meta_topic, block::VARCHAR AS meta_block,
            CAST(4 + (h3 IS NOT NULL)::INT AS INTEGER) AS n_keys FROM sections""",
        "c11_chunk_corpus": f"""WITH RECURSIVE {_DOC_SECTIONS}, {_CHUNKS}
            SELECT chunk_id, doc_chunk_index, topic, section, content,
              concat_ws(e'\\n', 'source: ' || source, 'relative_path: ' || relative_path, 'doc_id: ' || doc_id, 'H2: ' || h2,
                        'H3: ' || h3) || e'\\n\\n' || content AS embed_text,
              '{{"source":' || to_json(source) || ',"relative_path":' || to_json(relative_path) || ',"doc_id":' || to_json(doc_id)
                || coalesce(',"H2":' || to_json(h2), '') || coalesce(',"H3":' || to_json(h3), '')
                || ',"document_id":' || to_json(doc_id) || ',"chunk_index":"' || doc_chunk_index || '","chunk_id":'
                || to_json(chunk_id) || ',"topic":' || to_json(topic) || ',"section":' || to_json(section) || '}}' AS chunk_metadata
            FROM chunks_named""",
        "ingest_corpus": f"""WITH RECURSIVE {_DOC_SECTIONS}, {_CHUNKS},
            rows AS (
              SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id, doc_chunk_index) - 1 AS chunk_index,
                     {_hash('content')} AS content_hash, count(*) OVER (PARTITION BY source) AS n_nodes FROM chunks_named)
            SELECT sha256(source || '|' || content_hash) AS id, sha256(source) AS document_id, source, chunk_index, content_hash,
                   '{{"n_nodes":' || n_nodes || '}}' AS doc_metadata, {DIM} AS dim
            FROM rows QUALIFY row_number() OVER (PARTITION BY source, content_hash ORDER BY chunk_index) = 1""",
        "v3_all_cells": f"""WITH {_LABEL_HITS} SELECT query_id, query_text, 'hnsw_ef16_k{K}' AS run_name, 16 AS param_value,
            rank, dist, chunk_id, chunk_text FROM lhits""",
        "v3_recall_target": f"""WITH {_LABEL_HITS} SELECT query_id, query_text, 'cells_r100_k{K}' AS run_name, 100 AS param_value,
            rank, dist, chunk_id, chunk_text FROM lhits""",
        "v3_grown_cells": f"""WITH {_LABEL_HITS} SELECT query_id, query_text, 'cells_r100_k{K}' AS run_name, 100 AS param_value,
            rank, dist, chunk_id, chunk_text FROM lhits""",
        "c10_embedding_text": f"""WITH {_ALL_SECTIONS} SELECT doc_id, block, section_no,
            concat_ws(e'\\n', 'source: ' || source, 'doc_id: ' || doc_id, 'H2: ' || h2, 'H3: ' || h3) || e'\\n\\n' || section_text
              AS embed_text FROM sections""",
        "h1_content_hash": f"SELECT doc_id, {_hash('text')} AS content_hash FROM documents",
        "h2_hash_backfill": f"SELECT doc_id::VARCHAR AS id, {_hash('text')} AS content_hash FROM documents",
        "h3_dedup_chunks": f"""WITH {_CHUNK_TABLE} SELECT id, document_id, chunk_index, content_hash FROM chunk_table
            QUALIFY content_hash IS NULL
              OR row_number() OVER (PARTITION BY document_id, content_hash ORDER BY chunk_index, id) = 1""",
        "h4_integrity_report": f"""WITH {_CHUNK_TABLE},
            owners AS (SELECT DISTINCT lang AS id FROM documents WHERE lang <> 'fr')
            SELECT 'null' AS check_name, 'embedding' AS key, count(*) AS n FROM chunk_table WHERE embedding IS NULL HAVING count(*) > 0
            UNION ALL SELECT 'repeated_index', document_id || '|' || chunk_index, count(*) FROM chunk_table
              GROUP BY document_id, chunk_index HAVING count(*) > 1
            UNION ALL SELECT 'repeated_hash', document_id || '|' || content_hash, count(*) FROM chunk_table
              WHERE content_hash IS NOT NULL GROUP BY document_id, content_hash HAVING count(*) > 1
            UNION ALL SELECT 'orphan', document_id, count(*) FROM chunk_table
              WHERE document_id NOT IN (SELECT id FROM owners) GROUP BY document_id""",
        "h5_embedding_check": "SELECT vec_id, label FROM embeddings WHERE label IN (0, 1)",
        "e1_model_embedding": """SELECT doc_id, length(text)::DOUBLE AS e0,
            (length(text) - length(replace(text, ' ', '')))::DOUBLE AS e1 FROM documents""",
        "e2_hash_embedding": f"""WITH {_DOC_WEIGHTS}
            SELECT k AS chunk_id, CAST(bucket AS INTEGER) AS bucket, round(weight::DOUBLE, 6) AS weight FROM d_w""",
        "e3_query_embedding": f"""WITH {_QUERY_WEIGHTS}
            SELECT k AS query_id, CAST(bucket AS INTEGER) AS bucket, round(weight::DOUBLE, 6) AS weight FROM q_w""",
        "v1_cosine_topk": f"""WITH {_VECTOR_HITS} SELECT query_id, query_text, 'exact_k{K}' AS run_name, {K} AS param_value,
            rank, dist, chunk_id, chunk_text FROM vhits""",
        "v1_cosine_one_source": f"""WITH {_SOURCE_HITS} SELECT query_id, query_text, 'exact_k{K}' AS run_name, {K} AS param_value,
            rank, dist, chunk_id, chunk_text FROM vhits_s""",
        "v3_cells_topk": f"WITH {_CELL_HITS} SELECT * FROM cell_hits",
        "v3_recall": f"""WITH {_CELL_HITS} SELECT run_name, param_value,
            round(sum((l.chunk_id IS NOT NULL)::INT) / (SELECT count(*) FROM lhits), 6) AS recall
            FROM cell_hits h LEFT JOIN lhits l ON l.query_id = h.query_id AND l.chunk_id = h.chunk_id GROUP BY run_name, param_value""",
        "v2_parameter_sweep": f"""WITH {_VECTOR_HITS} SELECT query_id, query_text, 'hnsw_ef' || ef || '_k{K}' AS run_name,
            ef AS param_value, rank, dist, chunk_id, chunk_text FROM vhits, (VALUES (50), (100)) p(ef)""",
        "v4_postings": f"""WITH {_POSTINGS} SELECT chunk_id, token, tf, dl, df, n_chunks, round(avg_dl, 6) AS avg_dl
            FROM postings JOIN token_df USING (token), totals""",
        "v5_bm25_topk": f"""WITH {_KEYWORD_HITS} SELECT query_id, query_text, 'bm25' AS run_name, {K} AS param_value, rank,
            score, chunk_id, chunk_text FROM khits""",
        "v5_bm25_one_source": f"""WITH {_SOURCE_KEYWORD_HITS} SELECT query_id, query_text, 'bm25' AS run_name, {K} AS param_value, rank,
            score, chunk_id, chunk_text FROM khits_s""",
        "v6_hybrid_one_source": f"""WITH {_SOURCE_HITS}, {_SOURCE_KEYWORD_HITS},
            {_fused('hybrid', f"{_part('vhits_s', 0.5, 2)} UNION ALL {_part('khits_s', 0.5)}")}
            SELECT query_id, query_text, chunk_id, chunk_text, round(score, 6) AS score, rank FROM hybrid""",
        "v6_hybrid_search": f"""WITH {_VECTOR_HITS}, {_KEYWORD_HITS},
            {_fused('hybrid', f"{_part('vhits', 0.5, 2)} UNION ALL {_part('khits', 0.5)}")}
            SELECT query_id, query_text, chunk_id, chunk_text, round(score, 6) AS score, rank FROM hybrid""",
        "v7_rrf": f"""WITH lists AS (
              SELECT source AS query_id, source AS query_text, doc_id::VARCHAR AS chunk_id, lang AS chunk_text,
                     0.7::DOUBLE / (60 + n_chars) AS part FROM documents
              UNION ALL SELECT source, source, doc_id::VARCHAR, lang, 0.3::DOUBLE / (60 + doc_id) FROM documents),
            {_fused('f', 'SELECT * FROM lists')}
            SELECT query_id, query_text, chunk_id, chunk_text, round(score, 6) AS score, rank FROM f""",
        "v8_rerank": f"""WITH {_FUSED_HITS}, {_RERANKED}
            SELECT query_id, chunk_id, rank, round(rerank_score, 6) AS rerank_score, rank_reranked FROM reranked""",
        "v9_context": rf"""WITH {_KEYWORD_HITS}
            SELECT query_id, string_agg('Chunk ' || rank || e':\n' || chunk_text, e'\n\n' ORDER BY rank) AS context
            FROM khits WHERE rank <= 3 GROUP BY query_id""",
        "l1_nearest_hits": f"""WITH {_LABEL_HITS} SELECT query_id, query_text, 'hnsw_ef50_k{K}' AS run_name, 50 AS param_value,
            rank, dist, chunk_id, chunk_text FROM lhits""",
        "l2_truth": _TYPED_TRUTH,
        "l3_repeated_labels": f"WITH {_TYPED} SELECT query_id, chunk_id, count(*) AS n FROM typed GROUP BY ALL HAVING count(*) > 1",
        "l4_gold_query_id": """WITH ids AS (
              SELECT unnest(['parse_eval2_q' || lpad(item_id::VARCHAR, 3, '0') || '_01', 'eval2_q' || lpad(item_id::VARCHAR, 3, '0'),
                             'parse_parse_q' || lpad(item_id::VARCHAR, 3, '0') || '_a_b']) AS query_id FROM benchmark)
            SELECT query_id, array_to_string(string_split(regexp_replace(query_id, '^parse_', ''), '_')[1:2], '_') AS gold_query_id
            FROM ids""",
        "l5_label_join": f"""WITH {_VECTOR_HITS}, {_KEYWORD_HITS}, {_TRUTH}
            SELECT 'parse_' || v.query_id || '_01' AS query_id, v.chunk_id, v.rank, v.query_id AS gold_query_id,
                   t.query_id AS query_id_truth, CAST(coalesce(t.relevance, 0) AS INTEGER) AS relevance
            FROM vhits v LEFT JOIN truth t ON t.query_id = v.query_id AND t.chunk_id = v.chunk_id""",
        "m1_ranked_list": f"""WITH {_JUDGED}, {_scores('judged')}
            SELECT query_id, chunk_id, CAST(rel AS INTEGER) AS relevance, CAST(p AS INTEGER) AS rank FROM placed""",
        "m2_dcg": f"WITH {_JUDGED}, {_scores('judged')} SELECT query_id, round(dcg, 6) AS dcg_value FROM qs",
        "m3_ndcg": f"""WITH {_JUDGED}, {_scores('judged')}
            SELECT query_id, round({_NDCG}, 6) AS ndcg_value, round(dcg, 6) AS dcg_value FROM qs""",
        "m4_precision": f"WITH {_JUDGED}, {_scores('judged')} SELECT query_id, round(prec, 6) AS precision_at_k FROM qs",
        "m5_average_precision": f"WITH {_JUDGED}, {_scores('judged')} SELECT query_id, round(ap, 6) AS average_precision FROM qs",
        "m6_precision_scores": f"""WITH {_JUDGED}, {_scores('judged')}
            SELECT query_id, round(prec, 6) AS precision_at_k, round(ap, 6) AS average_precision FROM qs""",
        "m7_summary": f"""WITH {_LABEL_HITS},
            graded AS (SELECT *, CASE abs(query_text::INT - chunk_text::INT) WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS relevance
                       FROM lhits), {_scores('graded')}, means_over AS (SELECT {_MEANS} FROM qs)
            SELECT 'label_means' AS run, {_rounded_means(6)} FROM means_over""",
        "m8_run_comparison": f"""WITH {_FUSED_HITS}, {_RERANKED}, {_TRUTH}, {run_hits}, {_scores('run_labelled', 'run, query_id')},
            summary AS (SELECT run, {_MEANS} FROM qs GROUP BY run)
            SELECT run, {_rounded_means(4)} FROM summary
            UNION ALL SELECT 'rrf - vector', {', '.join(f'round(a.{m} - b.{m}, 4)' for m in ('p_at_k', 'map_at_k', 'ndcg_at_k', 'dcg_at_k'))}
            FROM summary a, summary b WHERE a.run = 'rrf' AND b.run = 'vector'""",
        "m8_chunker_delta": f"""WITH RECURSIVE {_DOC_SECTIONS}, {_CHUNKS},
            fixed_words AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM corpus),
            both_chunks AS (
              SELECT 'custom' AS run, chunk_id, doc_id, content FROM chunks_named
              UNION ALL SELECT 'fixed', doc_id || '::' || lpad(i::VARCHAR, 5, '0'), doc_id, array_to_string(w[i * 420 + 1 : i * 420 + 500], ' ')
              FROM fixed_words, LATERAL (SELECT unnest(range(greatest(1, ceil((len(w) - 80) / 420))::BIGINT)) AS i) u WHERE len(w) > 0),
            {_weights('d', "run || chr(31) || chunk_id", 'content', 'both_chunks')}, {_dense('d')},
            {_QUERY_WEIGHTS}, {_dense('q')}, {_ASKED},
            asked_twice AS (SELECT r.run, a.query_id, a.v FROM asked a, (VALUES ('custom'), ('fixed')) r(run)),
            both_hits AS (
              SELECT q.run, q.query_id, c.chunk_id, c.doc_id, round(list_cosine_distance(q.v, d_v.v), 9) AS dist
              FROM asked_twice q JOIN both_chunks c ON c.run = q.run JOIN d_v ON d_v.k = c.run || chr(31) || c.chunk_id),
            run_labelled AS (
              SELECT h.run, h.query_id, h.chunk_id, row_number() OVER (PARTITION BY h.run, h.query_id ORDER BY dist, h.chunk_id) AS rank,
                     coalesce(l.quality * 2 + (1 - l.toxic), 0) AS relevance
              FROM both_hits h LEFT JOIN (SELECT source || '::' || d.doc_id || '.md' AS owner, quality, toxic
                                          FROM labels JOIN documents d ON d.doc_id = labels.doc_id) l ON l.owner = h.doc_id
              QUALIFY row_number() OVER (PARTITION BY h.run, h.query_id ORDER BY dist, h.chunk_id) <= {K}),
            {_scores('run_labelled', 'run, query_id')}, summary AS (SELECT run, {_MEANS} FROM qs GROUP BY run)
            SELECT run, {_rounded_means(4)} FROM summary
            UNION ALL SELECT 'custom - fixed', {', '.join(f'round(a.{m} - b.{m}, 4)' for m in ('p_at_k', 'map_at_k', 'ndcg_at_k', 'dcg_at_k'))}
            FROM summary a, summary b WHERE a.run = 'custom' AND b.run = 'fixed'""",
        "q1_prompts": _prompt_sql(),
        "q2_validate_output": f"""WITH {_ANSWERS}
            SELECT turn_id, form, valid, CASE WHEN valid THEN j->>'$.refined_query' END AS refined_query,
                   CASE WHEN valid THEN CAST(coalesce(len(json_keys(j, '$.filters')), 0) AS INTEGER) END AS n_filters,
                   CASE WHEN valid THEN CAST(coalesce(json_array_length(j, '$.must_not'), 0) AS INTEGER) END AS n_must_not,
                   CASE WHEN valid AND json_type(j, '$.confidence') = 'BOOLEAN' THEN (j->>'$.confidence')::BOOLEAN::INT::DOUBLE
                        WHEN valid THEN TRY_CAST(j->>'$.confidence' AS DOUBLE) END AS confidence
            FROM judged_answers""",
        "q3_attempts": f"""WITH {_ANSWERS}
            SELECT turn_id, form, CASE WHEN valid THEN 1 WHEN form <> 'prose' THEN 2 ELSE 0 END AS attempt,
                   CASE WHEN valid THEN j->>'$.refined_query' WHEN form <> 'prose' THEN 'again: ' || text ELSE text END AS refined_query
            FROM judged_answers""",
        "q4_substitute": """SELECT 'bench_' || item_id AS query_id, 'refined: ' || text AS query_text,
            CAST(length(text) AS INTEGER) AS difficulty FROM benchmark""",
        "q5_rewrite_experiment": f"""WITH {_DOC_VECTORS}, {_KEYWORD_HITS}, {rewritten},
            {_weights('q', "run || chr(31) || query_id", 'text', 'versions')}, {_dense('q')}, {_DOC_CHUNKS},
            asked AS (SELECT run, query_id, v FROM versions JOIN q_v ON q_v.k = run || chr(31) || query_id),
            {_nearest('vhits', 'asked', 'chunks', 'run, query_id')}, {_TRUTH},
            run_labelled AS (
              SELECT run, r.query_id, r.chunk_id, r.rank, coalesce(t.relevance, 0) AS relevance
              FROM vhits r LEFT JOIN truth t ON t.query_id = r.query_id AND t.chunk_id = r.chunk_id),
            {_scores('run_labelled', 'run, query_id')}, summary AS (SELECT run, {_MEANS} FROM qs GROUP BY run)
            SELECT run, {_rounded_means(6)} FROM summary""",
    }
    # Other ways to the same rows.
    same = {
        "c11_long_documents": "c11_chunk_corpus", "v4_postings_by_token": "v4_postings", "v5_postings_topk": "v5_bm25_topk",
        "v5_postings_one_source": "v5_bm25_one_source", "e1_resumed_embedding": "e1_model_embedding",
    }
    return sql | {name: sql[other] for name, other in same.items()}
