"""DuckDB SQL equal to each registered query (same column names and types)."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["search_topk"] = """
WITH s AS (
  SELECT q.vec_id AS query_id, p.vec_id AS point_id, p.label,
         list_dot_product(q.embedding::DOUBLE[], p.embedding::DOUBLE[]) AS score
  FROM embeddings q CROSS JOIN embeddings p
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, point_id, label
FROM r WHERE rank <= 5 AND score >= 0.35
"""

# ---------------------------------------------------------------- SQL building blocks

# The same white-space class, control class and replacements as
# vellum.functions.text, written for DuckDB (RE2).
WS = (
    r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NON_WS = "[^" + WS[1:]
TOKEN_PATTERN = f"{WS}*{NON_WS}+|{WS}+"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '\\A{WS}+|{WS}+\\z', '', 'g')"


def normalize(x: str, nfc: bool = True) -> str:
    t = f"nfc_normalize({x})" if nfc else x
    t = f"regexp_replace({t}, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g')"
    t = f"translate({t}, {lit('’‘“”–—')}, {lit(chr(39) * 2 + chr(34) * 2 + '--')})"
    t = f"regexp_replace({t}, '[ \\t]+', ' ', 'g')"
    t = f"regexp_replace({t}, '\\n{{3,}}', {lit(chr(10) * 2)}, 'g')"
    t = f"regexp_replace({t}, '(?m)^{WS}+$', '', 'g')"
    return strip(t)


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(TOKEN_PATTERN)})"


def windows(x: str, size: int, overlap: int) -> str:
    """Token windows of a text as a list (empty for an empty text)."""
    step = size - overlap
    return (
        f"(SELECT CASE WHEN len(tk) = 0 THEN []::VARCHAR[] ELSE list_transform(generate_series(0, len(tk) - 1, {step}), "
        f"lambda s: array_to_string(tk[s + 1:s + {size}], '')) END FROM (SELECT {tokens(x)} AS tk))"
    )


def noisy(x: str) -> str:
    pairs = [("é", "é"), (". ", ".”  \t" + "\x07" + " "), (", ", " – ‘"), ("\n", "\n \n\n\n \n")]
    for a, b in pairs:
        b_sql = " || ".join(lit(part) if part != "\x07" else "chr(7)" for part in _split_keep(b, "\x07"))
        x = f"replace({x}, {lit(a)}, {b_sql})"
    return f"({lit('　 ')} || {x} || {lit(chr(13) + chr(10) + ' ')})"


def _split_keep(s: str, ch: str) -> list[str]:
    out, cur = [], ""
    for c in s:
        if c == ch:
            if cur:
                out.append(cur)
            out.append(c)
            cur = ""
        else:
            cur += c
    if cur:
        out.append(cur)
    return out


def lines(x: str) -> str:
    """Stripped, non-empty lines of a text."""
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {strip('l')}), lambda l: length(l) > 0)"


def ordered_join(order: str, val: str, sep: str) -> str:
    return f"string_agg({val}, {sep} ORDER BY {order})"


SQL["normalize_text"] = f"""
SELECT doc_id, {normalize(noisy('text'))} AS text, CAST(length({normalize(noisy('text'))}) AS INTEGER) AS char_count
FROM documents
"""

SQL["min_length"] = f"""
SELECT doc_id, CAST(len(ls) AS INTEGER) AS lines, CAST(len(list_filter(ls, lambda l: length(l) >= 60)) AS INTEGER) AS long_lines
FROM (SELECT doc_id, {lines('text')} AS ls FROM documents)
"""

SQL["file_hashes"] = "SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5 FROM documents"

SQL["token_chunks"] = f"""
WITH w AS (SELECT doc_id, source, sha256(text) AS file_hash, {windows('text', 500, 50)} AS ws FROM documents),
u AS (SELECT doc_id, source, file_hash, unnest(ws) AS t, generate_subscripts(ws, 1) - 1 AS chunk FROM w)
SELECT doc_id, source, CAST(chunk AS INTEGER) AS chunk, CAST(len({tokens('t')}) AS INTEGER) AS tokens, file_hash, md5(t) AS text_md5
FROM u
"""


def point_id(file_hash: str, chunk_id: str) -> str:
    key = f"md5({file_hash} || '_' || CAST({chunk_id} AS VARCHAR))"
    return f"(('0x' || right({key}, 16))::UBIGINT & 9223372036854775807::UBIGINT)::BIGINT"


SQL["chunk_metadata"] = f"""
WITH pg AS (
  SELECT conv_id AS doc, CAST(turn + 1 AS INTEGER) AS page, text,
         CAST(count(*) OVER (PARTITION BY conv_id) AS INTEGER) AS total_pages
  FROM conversations
), b AS (
  SELECT 'conversations/' || CAST(doc AS VARCHAR) || '.Pdf' AS path, md5(CAST(doc AS VARCHAR) || '/conv') AS file_hash,
         page AS block_no, page, total_pages, {windows('text', 60, 10)} AS ws
  FROM pg
), pc AS (
  SELECT path, file_hash, block_no, page, total_pages, unnest(ws) AS t, generate_subscripts(ws, 1) AS piece_no FROM b
), kept AS (
  SELECT *, {strip('t')} AS s FROM pc
), k2 AS (
  SELECT * FROM kept WHERE length(s) >= 60
), num AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY path ORDER BY block_no, piece_no) - 1 AS INTEGER) AS chunk_id,
         CAST(count(*) OVER (PARTITION BY path) AS INTEGER) AS total_chunks
  FROM k2
)
SELECT {point_id('file_hash', 'chunk_id')} AS point_id,
       regexp_extract(path, '([^/]*)$', 1) AS filename, path AS filepath, 'pdf' AS file_type, file_hash, chunk_id,
       CAST(length(s) AS INTEGER) AS char_count, page, total_pages, total_chunks, md5(s) AS text_md5
FROM num
"""

SQL["page_blocks"] = f"""
WITH pg AS (
  SELECT conv_id, CAST(turn + 1 AS INTEGER) AS page, {normalize('text')} AS text,
         CAST(count(*) OVER (PARTITION BY conv_id) AS INTEGER) AS total_pages
  FROM conversations
)
SELECT conv_id, page, total_pages, text FROM pg WHERE length(text) >= 60
"""

# beside every file one that has only empty or null pages; the rule is: a page with text
# adds text and newline, and a file is blank when nothing but white space came together
WITH_BLANK = """(SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1 - conv_id, turn, role, CASE WHEN turn % 2 = 0 THEN '' END FROM conversations)"""

SQL["concat_pages"] = f"""
WITH d AS (
  SELECT conv_id, coalesce(string_agg(CASE WHEN length(t) > 0 THEN t || chr(10) END, '' ORDER BY turn), '') AS text
  FROM (SELECT conv_id, turn, text AS t FROM {WITH_BLANK}) GROUP BY conv_id
)
SELECT conv_id, length({strip('text')}) = 0 AS blank, CAST(length(text) AS INTEGER) AS char_count, md5(text) AS text_md5 FROM d
"""

SQL["section_blocks"] = f"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS t, generate_subscripts(ls, 1) - 1 AS pos FROM (SELECT doc_id, {lines('text')} AS ls FROM documents)
), a AS (
  SELECT *, length(t) < 40 AS hd,
         max(CASE WHEN NOT length(t) < 40 THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS last_non
  FROM l
), b AS (
  SELECT *, CASE WHEN hd AND (CASE WHEN last_non IS NULL THEN (pos + 1) % 2 = 0 ELSE (pos - last_non) % 2 = 1 END)
                 THEN 1 ELSE 0 END AS bd
  FROM a
), c AS (
  SELECT *, sum(bd) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS sec FROM b
), body AS (
  SELECT doc_id, sec, {ordered_join('pos', 't', 'chr(10)')} AS body FROM c WHERE bd = 0 GROUP BY doc_id, sec
), heads AS (
  SELECT doc_id, sec, t AS heading FROM c WHERE bd = 1
), s AS (
  SELECT body.doc_id, body.sec, heading, {normalize(strip('body'))} AS body FROM body LEFT JOIN heads USING (doc_id, sec)
), k AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sec) AS idx FROM s WHERE length(body) >= 60
)
SELECT doc_id, coalesce(heading, 'Sección ' || CAST(idx AS VARCHAR)) AS section, CAST(idx AS INTEGER) AS section_idx, body AS text FROM k
"""

SQL["table_rows_text"] = f"""
WITH c AS (
  SELECT n_regionkey AS doc, 0 AS tbl, n_nationkey AS row, u.col, {strip('u.t')} AS t
  FROM nation JOIN region ON n_regionkey = r_regionkey,
       (SELECT unnest([0, 1, 2, 3]) AS col) AS cc,
       LATERAL (SELECT cc.col AS col, [n_name, CAST(n_nationkey AS VARCHAR), ' ' || r_name, '  '][cc.col + 1] AS t) AS u
), r AS (
  SELECT doc, tbl, row, {ordered_join('col', 't', "' | '")} AS t FROM c WHERE length(t) > 0 GROUP BY doc, tbl, row
)
SELECT doc AS region, CAST(tbl AS INTEGER) AS tbl, {ordered_join('row', 't', 'chr(10)')} AS text FROM r GROUP BY doc, tbl
"""

SQL["append_tables"] = f"""
WITH e AS (SELECT n_regionkey AS region, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS pos, length(n_name) < 6 AS is_heading, n_name AS text FROM nation),
c AS (
  SELECT n_regionkey AS doc, n_nationkey % 2 AS tbl, n_nationkey AS row,
         concat_ws(' | ', {strip('n_name')}, CAST(n_nationkey AS VARCHAR), {strip('r_name')}) AS t
  FROM nation JOIN region ON n_regionkey = r_regionkey
), t AS (SELECT doc, tbl, {ordered_join('row', 't', 'chr(10)')} AS text FROM c GROUP BY doc, tbl)
SELECT region, CAST(pos AS INTEGER) AS pos, is_heading, text FROM e
UNION ALL
SELECT doc, CAST((SELECT max(pos) FROM e WHERE region = doc) + row_number() OVER (PARTITION BY doc ORDER BY tbl) AS INTEGER), false, text FROM t
"""

# ---------------------------------------------------------------- incremental ingest over documents

FILES = """files AS (
  SELECT doc_id, 'documents/' || lang || '/' || source || '_' || CAST(doc_id AS VARCHAR) || '.txt' AS path, text, md5(text) AS file_hash
  FROM documents
), prev AS (
  SELECT doc_id, path, t AS text, md5(t) AS file_hash FROM (
    SELECT f.doc_id, f.path, CASE WHEN l.quality = 1 THEN f.text ELSE f.text || ' (v0)' END AS t
    FROM files f JOIN labels l USING (doc_id))
)"""


def chunks_cte(name: str, src: str) -> str:
    """Chunks of the files in CTE ``src`` (one block each, 500/50 token windows)."""
    return f"""{name}_w AS (
  SELECT path, file_hash, {windows('text', 500, 50)} AS ws FROM {src}
), {name}_p AS (
  SELECT path, file_hash, unnest(ws) AS t, generate_subscripts(ws, 1) AS piece_no FROM {name}_w
), {name}_k AS (
  SELECT path, file_hash, piece_no, {strip('t')} AS s FROM {name}_p
), {name} AS (
  SELECT regexp_extract(path, '([^/]*)$', 1) AS filename, path AS filepath, file_hash,
         CAST(row_number() OVER (PARTITION BY path ORDER BY piece_no) - 1 AS INTEGER) AS chunk_id,
         CAST(length(s) AS INTEGER) AS char_count,
         CAST(count(*) OVER (PARTITION BY path) AS INTEGER) AS total_chunks, s AS text
  FROM {name}_k WHERE length(s) >= 60
)"""


def points_cte(name: str, chunks: str) -> str:
    return f"{name} AS (SELECT {point_id('file_hash', 'chunk_id')} AS point_id, * FROM {chunks})"


def last_wins_cte(name: str, src: str) -> str:
    return f"{name} AS (SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY filepath DESC) = 1)"


RUN = f"""{FILES},
todo AS (SELECT * FROM files f WHERE NOT EXISTS (SELECT 1 FROM prev p WHERE p.path = f.path AND p.file_hash = f.file_hash)),
skipped AS (SELECT * FROM files f WHERE EXISTS (SELECT 1 FROM prev p WHERE p.path = f.path AND p.file_hash = f.file_hash)),
{chunks_cte('ch', 'todo')},
errs AS (SELECT path, 'no valid chunks after extraction' AS error FROM todo WHERE path NOT IN (SELECT filepath FROM ch)),
outcome AS (
  SELECT f.path, f.file_hash,
         CASE WHEN s.path IS NOT NULL THEN 'skipped' WHEN e.path IS NOT NULL THEN 'error' ELSE 'processed' END AS status,
         CAST(CASE WHEN s.path IS NULL AND e.path IS NULL THEN coalesce(c.n, 0) ELSE 0 END AS BIGINT) AS chunks,
         CASE WHEN s.path IS NULL THEN e.error END AS error
  FROM files f LEFT JOIN skipped s USING (path) LEFT JOIN errs e USING (path)
  LEFT JOIN (SELECT filepath AS path, count(*) AS n FROM ch GROUP BY 1) c USING (path)
)"""

SQL["known_hashes"] = f"""WITH {FILES}, {chunks_cte('pc', 'prev')}
SELECT DISTINCT file_hash FROM pc WHERE file_hash IS NOT NULL"""

SQL["drop_known"] = f"""WITH {FILES}, {chunks_cte('pc', 'prev')}
SELECT doc_id, path, file_hash FROM files WHERE file_hash NOT IN (SELECT file_hash FROM pc)"""

SQL["changed_files"] = f"""WITH {RUN}
SELECT doc_id, path, 'process' AS status FROM todo UNION ALL SELECT doc_id, path, 'skip' AS status FROM skipped"""

SQL["last_wins"] = f"""WITH {FILES}, {chunks_cte('ac', 'files')}, {points_cte('ap', 'ac')}, {last_wins_cte('lw', 'ap')}
SELECT point_id, filepath, chunk_id, total_chunks FROM lw"""

SQL["stale_points"] = f"""WITH {FILES}, {chunks_cte('pc', 'prev')}, {points_cte('pp', 'pc')}
SELECT point_id, filepath, file_hash FROM pp
WHERE NOT EXISTS (SELECT 1 FROM files f WHERE f.path = pp.filepath AND f.file_hash = pp.file_hash)"""

SQL["upsert_points"] = f"""WITH {RUN}, {chunks_cte('pc', 'prev')}, {points_cte('pp', 'pc')}, {last_wins_cte('old', 'pp')},
{points_cte('np', 'ch')}, {last_wins_cte('new', 'np')}
SELECT point_id, filepath, file_hash, chunk_id FROM old WHERE point_id NOT IN (SELECT point_id FROM new)
UNION ALL SELECT point_id, filepath, file_hash, chunk_id FROM new"""

SQL["update_state"] = f"""WITH {RUN},
ok AS (SELECT path, file_hash FROM todo WHERE path NOT IN (SELECT path FROM errs))
SELECT coalesce(p.path, ok.path) AS path, coalesce(ok.file_hash, p.file_hash) AS file_hash
FROM (SELECT path, file_hash FROM prev) p FULL OUTER JOIN ok ON p.path = ok.path"""

SQL["quarantine"] = f"""WITH {RUN}
SELECT path, regexp_extract(path, '([^/]*)$', 1) AS filename, error,
       regexp_extract(path, '([^/]*)\\.txt$', 1) || '__20241201_143435.txt' AS quarantine_name
FROM errs"""

SQL["file_outcome"] = f"WITH {RUN} SELECT path, status, chunks, error FROM outcome"

SQL["run_summary"] = f"""WITH {RUN}
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'processed') AS processed,
       count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'error') AS errors,
       CAST(coalesce(sum(chunks), 0) AS BIGINT) AS chunks
FROM outcome"""

SQL["chunks_per_file"] = f"WITH {RUN} SELECT filepath, count(*) AS chunks FROM ch GROUP BY filepath"

# ---------------------------------------------------------------- encoding and search

QUERY_PREFIX = "Represent this query for searching relevant passages: "
PASSAGE_PREFIX = "Represent this passage for searching relevant queries: "


def hashed_vector(x: str, dim: int = 64) -> str:
    """Signed feature hashing of the words of ``x``, L2-normalised, FLOAT[]."""
    words = f"list_filter(string_split_regex(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    codes = f"list_transform({words}, lambda w: ('0x' || substr(md5(w), 1, 8))::UBIGINT::BIGINT)"
    counts = (
        f"list_transform(range({dim}), lambda i: CAST(len(list_filter(hs, lambda h: h % {dim} = i AND (h // {dim}) % 2 = 0))"
        f" - len(list_filter(hs, lambda h: h % {dim} = i AND (h // {dim}) % 2 = 1)) AS DOUBLE))"
    )
    return (
        f"(SELECT list_transform(c, lambda v: CAST(CASE WHEN nrm > 0 THEN v / nrm ELSE 0 END AS FLOAT)) FROM "
        f"(SELECT c, sqrt(list_sum(list_transform(c, lambda v: v * v))) AS nrm FROM "
        f"(SELECT {counts} AS c FROM (SELECT {codes} AS hs))))"
    )


CORPUS = f"""{FILES}, {chunks_cte('ac', 'files')}, {points_cte('ap', 'ac')}, {last_wins_cte('lw', 'ap')},
pts AS (SELECT *, {hashed_vector('text')} AS vector FROM lw)"""

SQL["embed_passages"] = f"""WITH {FILES}, {chunks_cte('ac', 'files')},
v AS (SELECT filepath, chunk_id, {hashed_vector('text')} AS vec FROM ac),
u AS (SELECT filepath, chunk_id, unnest(vec) AS w, generate_subscripts(vec, 1) - 1 AS dim FROM v)
SELECT filepath, chunk_id, CAST(dim AS INTEGER) AS dim, round(CAST(w AS DOUBLE), 6) AS weight FROM u WHERE w <> 0"""

SQL["embed_search"] = f"""WITH {CORPUS},
qv AS (SELECT item_id AS query_id, {hashed_vector(lit(QUERY_PREFIX) + ' || text')} AS vec FROM benchmark),
sc AS (SELECT q.query_id, p.point_id, p.filepath, p.chunk_id, list_dot_product(q.vec::DOUBLE[], p.vector::DOUBLE[]) AS score
       FROM qv q CROSS JOIN pts p),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS rank FROM sc)
SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, point_id, filepath, chunk_id
FROM r WHERE rank <= 5 AND score >= 0.35"""

BATCH = f"""{CORPUS},
bq AS (
  SELECT item_id AS query_id, text AS query, CASE WHEN length(text) < 150 THEN 3 ELSE 5 END AS top,
         CASE WHEN NOT length(text) < 150 THEN CAST(0.35 AS DOUBLE) END AS threshold, CAST(NULL AS VARCHAR) AS filter
  FROM benchmark
), dq AS (
  SELECT -1 - f.doc_id AS query_id, f.text AS query, 5 AS top, CAST(0.35 AS DOUBLE) AS threshold,
         'filename=' || regexp_extract(f.path, '([^/]*)$', 1) AS filter
  FROM files f
), qs AS (
  SELECT query_id, {strip('query')} AS query, top, threshold, filter,
         CASE WHEN instr(filter, '=') > 0 THEN substr(filter, instr(filter, '=') + 1) END AS fname
  FROM (SELECT * FROM bq UNION ALL SELECT * FROM dq)
  WHERE lower({strip('query')}) NOT IN ('exit', 'quit')
), qv AS (
  SELECT *, {hashed_vector(lit(QUERY_PREFIX) + ' || query')} AS vec FROM qs
), sc AS (
  SELECT q.query_id, q.top, q.threshold, p.point_id, p.filename, p.chunk_id, p.total_chunks, p.char_count, p.text,
         list_dot_product(q.vec::DOUBLE[], p.vector::DOUBLE[]) AS score
  FROM qv q JOIN pts p ON (q.fname IS NULL OR p.filename = q.fname)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS rank FROM sc
), hits AS (
  SELECT * FROM r WHERE rank <= top AND (threshold IS NULL OR score >= threshold)
)"""

SQL["batch_search"] = f"""WITH {BATCH}
SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, point_id, filename, chunk_id FROM hits"""


def preview_sql(x: str, n: int, flatten: bool = False) -> str:
    head = f"substr({x}, 1, {n})"
    if flatten:
        head = f"replace({head}, chr(10), ' ')"
    return f"({head} || CASE WHEN length({x}) > {n} THEN '...' ELSE '' END)"


SQL["result_view_g1"] = f"""WITH {BATCH}
SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, filename AS source, chunk_id AS chunk,
       {preview_sql('text', 600)} AS preview FROM hits"""

SQL["result_view_g2"] = f"""WITH {BATCH}, cards AS (
  SELECT query_id, rank, score, filename, chunk_id, total_chunks, char_count, text, NULL AS page, NULL AS total_pages, NULL AS section FROM hits
  UNION ALL
  SELECT -1000000000 - k, 1, k / 25, CASE WHEN k % 5 <> 0 THEN n_name END, CASE WHEN k % 11 <> 0 THEN k END, CASE WHEN k % 7 <> 0 THEN k + 1 END,
         CASE WHEN k % 13 <> 0 THEN k * 10 END, CASE WHEN k % 2 <> 0 THEN repeat(n_name || chr(10), 40) END,
         CASE WHEN k % 3 = 0 THEN k + 1 END, CASE WHEN k % 6 = 0 THEN k + 2 END, CASE WHEN k % 3 = 1 THEN repeat(n_name, 9) END
  FROM (SELECT n_name, CAST(n_nationkey AS BIGINT) AS k FROM nation)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, coalesce(filename, 'N/A') AS filename,
       CAST(page AS VARCHAR) || '/' || coalesce(CAST(total_pages AS VARCHAR), '?') AS page_info, substr(section, 1, 40) AS section,
       coalesce(CAST(chunk_id AS VARCHAR), '?') || '/' || coalesce(CAST(total_chunks AS VARCHAR), '?') AS chunk_info,
       CAST(coalesce(char_count, 0) AS INTEGER) AS char_count, {preview_sql("coalesce(text, '')", 300, True)} AS preview
FROM cards"""

SQL["empty_queries"] = f"""WITH {BATCH}
SELECT query_id, query FROM qs WHERE query_id NOT IN (SELECT query_id FROM hits)"""

SQL["parse_filter_arg"] = """
SELECT doc_id, arg, CASE WHEN instr(arg, '=') > 0 THEN substr(arg, instr(arg, '=') + 1) END AS value
FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN 'filename=' || source || '=x' ELSE source END AS arg FROM documents)"""


def name_sql(p: str) -> str:
    return f"regexp_extract({p}, '([^/]*)$', 1)"


def suffix_sql(p: str) -> str:
    return f"regexp_extract({name_sql(p)}, '^.+(\\.[^.]+)$', 1)"


SQL["text_preview"] = f"""WITH {FILES}, pp AS (
  SELECT *, CASE WHEN lang = 'fr' THEN path || '.PDF' WHEN lang = 'de' THEN regexp_replace(path, '\\.txt$', '')
                 WHEN lang = 'es' THEN regexp_replace(path, '/([^/]*)$', '/.\\1') ELSE path END AS p
  FROM files JOIN (SELECT doc_id, lang FROM documents) USING (doc_id)
)
SELECT doc_id, {preview_sql('text', 600)} AS preview600, {preview_sql('text', 300, True)} AS preview300,
       {name_sql('p')} AS filename, substr({name_sql('p')}, 1, length({name_sql('p')}) - length({suffix_sql('p')})) AS stem,
       {suffix_sql('p')} AS suffix, lower(regexp_replace({suffix_sql('p')}, '^\\.', '')) AS file_type,
       CAST(length({lit(PASSAGE_PREFIX)} || text) AS INTEGER) AS passage_len, CAST(length(text) AS INTEGER) AS plain_len,
       md5({lit(QUERY_PREFIX)} || text) AS query_md5
FROM pp"""

SQL["l2_normalize"] = """
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (label + 1)) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x::DOUBLE * x::DOUBLE))) AS nrm FROM s),
u AS (SELECT vec_id, unnest(list_transform(v, lambda x: CAST(CASE WHEN nrm > 0 THEN x::DOUBLE / nrm ELSE 0 END AS FLOAT))) AS x,
             generate_subscripts(v, 1) - 1 AS dim FROM n)
SELECT vec_id, CAST(dim AS INTEGER) AS dim, round(CAST(x AS DOUBLE), 6) AS x FROM u"""

SQL["cosine_score"] = """
WITH d AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings),
m AS (SELECT label, dim, avg(x) AS m FROM d GROUP BY ALL),
c AS (SELECT label, list(m ORDER BY dim) AS centroid FROM m GROUP BY label)
SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], centroid), 6) AS cosine,
       round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 6) AS self_dot
FROM embeddings JOIN c USING (label)"""

# the row-local forms compute the same tables
SQL["page_blocks_per_file"] = SQL["page_blocks"]
SQL["section_blocks_per_file"] = SQL["section_blocks"]
SQL["chunk_metadata_per_file"] = SQL["chunk_metadata"]

SQL["g1_search"] = f"""WITH {FILES},
w AS (SELECT path, regexp_extract(path, '([^/]*)$', 1) AS source, sha256(text) AS file_hash, {windows('text', 500, 50)} AS ws FROM files),
u AS (SELECT path, source, file_hash, unnest(ws) AS t, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS chunk FROM w),
pts AS (SELECT {point_id('md5(path)', 'chunk')} AS point_id, source, chunk, t AS text, {hashed_vector('t')} AS vector FROM u),
qv AS (SELECT item_id AS query_id, {hashed_vector('text')} AS vec FROM benchmark),
sc AS (SELECT q.query_id, p.point_id, p.source, p.chunk, p.text, list_dot_product(q.vec::DOUBLE[], p.vector::DOUBLE[]) AS score
       FROM qv q CROSS JOIN pts p),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS rank FROM sc)
SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, source, chunk, {preview_sql('text', 600)} AS preview
FROM r WHERE rank <= 3"""

SQL["store_roundtrip"] = f"""WITH {FILES}, {chunks_cte('pc', 'prev')}, {points_cte('pp', 'pc')}, {last_wins_cte('old', 'pp')},
{chunks_cte('ac', 'files')}, {points_cte('ap', 'ac')}, {last_wins_cte('new', 'ap')},
merged AS (
  SELECT point_id, filepath, file_hash, chunk_id, total_chunks FROM old WHERE point_id NOT IN (SELECT point_id FROM new)
  UNION ALL SELECT point_id, filepath, file_hash, chunk_id, total_chunks FROM new
)
SELECT *, (SELECT count(*) FROM merged) AS points FROM merged"""

SQL["store_filter"] = f"""WITH {FILES}, {chunks_cte('ac', 'files')}, {points_cte('ap', 'ac')}, {last_wins_cte('lw', 'ap')}
SELECT point_id, filename, chunk_id, 'txt' AS file_type FROM lw
WHERE filename IN (SELECT regexp_extract(path, '([^/]*)$', 1) FROM files WHERE doc_id IN (1, 10, 20, 30, 40))"""

SQL["store_append"] = f"""WITH d AS (
  SELECT conv_id, md5(CAST(conv_id AS VARCHAR)) AS file_hash,
         string_agg(text || chr(10), '' ORDER BY turn) AS text
  FROM conversations WHERE text IS NOT NULL AND text <> '' GROUP BY conv_id
), ok AS (SELECT * FROM d WHERE length({strip('text')}) > 0),
w AS (SELECT conv_id, file_hash, {windows('text', 500, 50)} AS ws FROM ok),
u AS (SELECT conv_id, file_hash, unnest(ws) AS t, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS chunk FROM w)
SELECT CAST(conv_id AS VARCHAR) || '.pdf' AS source, chunk, CAST(len({tokens('t')}) AS INTEGER) AS tokens, file_hash,
       36 AS id_len
FROM u"""

# each document was written as one text file: its text and a newline
SQL["discover_files"] = """
SELECT doc_id, 'txt' AS file_type, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS length, md5(text || chr(10)) AS file_hash
FROM documents"""

SQL["token_ingest"] = f"""WITH c AS {WITH_BLANK}, h AS (
  SELECT conv_id, sha256(CAST(conv_id AS VARCHAR) || '/' || sha256(coalesce(string_agg(text, chr(12) ORDER BY turn), ''))) AS file_hash FROM c GROUP BY conv_id
), known AS (
  SELECT DISTINCT h.file_hash FROM c JOIN h USING (conv_id) WHERE c.turn = 0 AND c.role = 'assistant'
), d AS (
  SELECT 'conversations/' || CAST(c.conv_id AS VARCHAR) || '.pdf' AS path, h.file_hash,
         coalesce(string_agg(CASE WHEN length(c.text) > 0 THEN c.text || chr(10) END, '' ORDER BY c.turn), '') AS text
  FROM c JOIN h USING (conv_id) WHERE h.file_hash NOT IN (SELECT file_hash FROM known) GROUP BY ALL
),
w AS (SELECT path, file_hash, {windows('text', 500, 50)} AS ws FROM d WHERE length({strip('text')}) > 0),
u AS (SELECT path, file_hash, unnest(ws) AS t, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS chunk FROM w)
SELECT path, regexp_extract(path, '([^/]*)$', 1) AS source, chunk, CAST(len({tokens('t')}) AS INTEGER) AS tokens, file_hash,
       md5(t) AS text_md5, 'indexed' AS status
FROM u
UNION ALL
SELECT path, '', -1, 0, file_hash, '', 'empty' FROM d WHERE length({strip('text')}) = 0"""

# ---------------------------------------------------------------- X1 extraction job


def sections_sql(lines: str) -> str:
    """CTEs turning rows ``(doc, pos, t, hd)`` (stripped, non-blank, dense pos)
    into ``secs(doc, section, section_idx, text)``."""
    return f"""sa AS (
  SELECT *, max(CASE WHEN NOT hd THEN pos END) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING) AS last_non
  FROM {lines}
), sb AS (
  SELECT *, CASE WHEN hd AND (CASE WHEN last_non IS NULL THEN (pos + 1) % 2 = 0 ELSE (pos - last_non) % 2 = 1 END)
                 THEN 1 ELSE 0 END AS bd
  FROM sa
), sc AS (
  SELECT *, sum(bd) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING) AS sec FROM sb
), sbody AS (
  SELECT doc, sec, {ordered_join('pos', 't', 'chr(10)')} AS body FROM sc WHERE bd = 0 GROUP BY doc, sec
), sheads AS (
  SELECT doc, sec, t AS heading FROM sc WHERE bd = 1
), ss AS (
  SELECT sbody.doc, sbody.sec, heading, {normalize(strip('body'))} AS body FROM sbody LEFT JOIN sheads USING (doc, sec)
), sk AS (
  SELECT *, row_number() OVER (PARTITION BY doc ORDER BY sec) AS idx FROM ss WHERE length(body) >= 60
), secs AS (
  SELECT doc, coalesce(heading, 'Sección ' || CAST(idx AS VARCHAR)) AS section, CAST(idx AS INTEGER) AS section_idx, body AS text
  FROM sk
)"""


_BLOCK_TAGS = "p|div|li|br|tr|td|th|ul|ol|nav|article|footer|header|section|table|title|h[1-6]"
_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
             ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def html_lines(x: str) -> str:
    b = f"coalesce(nullif(regexp_extract({x}, '(?is)<body[^>]*>(.*)</body>', 1), ''), {x})"
    b = f"regexp_replace({b}, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', '', 'g')"
    b = f"regexp_replace({b}, '(?i)<h([1-6])\\b[^>]*>', chr(10) || chr(1) || '\\1', 'g')"
    b = f"regexp_replace({b}, '(?i)</?({_BLOCK_TAGS})\\b[^>]*>', chr(10), 'g')"
    b = f"regexp_replace({b}, '<[^>]*>', '', 'g')"
    for a, c in _ENTITIES:
        b = f"replace({b}, {lit(a)}, {lit(c)})"
    return f"string_split({b}, chr(10))"


SQL["extract_blocks"] = f"""WITH mf AS (
  SELECT 'documents/' || lang || '/' || source || '_' || CAST(doc_id AS VARCHAR) || '.txt' AS path, text AS content, 'txt' AS ft
  FROM documents
  UNION ALL SELECT 'pages/' || CAST(page_id AS VARCHAR) || '.html', html, 'html' FROM pages
  UNION ALL SELECT 'conversations/' || CAST(conv_id AS VARCHAR) || '.json', coalesce(string_agg(text, chr(10) ORDER BY turn), ''), 'json'
  FROM conversations GROUP BY conv_id
), raw AS (
  SELECT path, unnest(ls) AS l, generate_subscripts(ls, 1) AS rpos
  FROM (SELECT path, string_split(content, chr(10)) AS ls FROM mf WHERE ft = 'txt'
        UNION ALL SELECT path, {html_lines('content')} FROM mf WHERE ft = 'html')
), el AS (
  SELECT path, rpos,
         CASE WHEN starts_with(l, chr(1)) THEN true
              WHEN path LIKE '%.txt' THEN length(trim(l)) < 40 ELSE false END AS hd,
         {strip("CASE WHEN starts_with(l, chr(1)) THEN substr(l, 3) ELSE l END")} AS t
  FROM raw
), lines AS (
  SELECT path AS doc, CAST(row_number() OVER (PARTITION BY path ORDER BY rpos) - 1 AS BIGINT) AS pos, t, hd
  FROM el WHERE length(t) > 0
), {sections_sql('lines')},
blk AS (
  SELECT doc AS path, section_idx AS block_no, section,
         CAST(length(text) AS INTEGER) AS char_count, md5(text) AS text_md5, CAST(NULL AS VARCHAR) AS error
  FROM secs
), err AS (
  SELECT path, CASE WHEN ft = 'json' THEN 'unsupported format: .json' ELSE 'no extractable text (scanned without OCR?)' END AS e
  FROM mf WHERE ft = 'json' OR path NOT IN (SELECT path FROM blk)
)
SELECT * FROM blk
UNION ALL SELECT path, 0, NULL, 0, NULL, e FROM err"""

SQL["ann_topk_all_cells"] = """
WITH s AS (
  SELECT q.vec_id AS query_id, p.vec_id AS point_id, p.label,
         list_dot_product(q.embedding::DOUBLE[], p.embedding::DOUBLE[]) AS score
  FROM embeddings q CROSS JOIN embeddings p
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, point_id, label FROM r WHERE rank <= 5
"""


MIXED = """mf AS (
  SELECT 'documents/' || lang || '/' || source || '_' || CAST(doc_id AS VARCHAR) || '.txt' AS path, text AS content, 'txt' AS ft
  FROM documents
  UNION ALL SELECT 'pages/' || CAST(page_id AS VARCHAR) || '.html', html, 'html' FROM pages
  UNION ALL SELECT 'conversations/' || CAST(conv_id AS VARCHAR) || '.json', coalesce(string_agg(text, chr(10) ORDER BY turn), ''), 'json'
  FROM conversations GROUP BY conv_id
)"""

SQL["index_documents_windows"] = f"""WITH {FILES}, {MIXED},
mh AS (SELECT *, md5(content) AS file_hash FROM mf),
skipped AS (SELECT m.* FROM mh m JOIN prev p ON p.path = m.path AND p.file_hash = m.file_hash),
todo AS (SELECT * FROM mh WHERE path NOT IN (SELECT path FROM skipped)),
raw AS (
  SELECT path, unnest(ls) AS l, generate_subscripts(ls, 1) AS rpos
  FROM (SELECT path, string_split(content, chr(10)) AS ls FROM todo WHERE ft = 'txt'
        UNION ALL SELECT path, {html_lines('content')} FROM todo WHERE ft = 'html')
), el AS (
  SELECT path, rpos,
         CASE WHEN starts_with(l, chr(1)) THEN true
              WHEN path LIKE '%.txt' THEN length(trim(l)) < 40 ELSE false END AS hd,
         {strip("CASE WHEN starts_with(l, chr(1)) THEN substr(l, 3) ELSE l END")} AS t
  FROM raw
), lines AS (
  SELECT path AS doc, CAST(row_number() OVER (PARTITION BY path ORDER BY rpos) - 1 AS BIGINT) AS pos, t, hd
  FROM el WHERE length(t) > 0
), {sections_sql('lines')},
pw AS (SELECT doc AS path, {windows('text', 500, 50)} AS ws FROM secs),
pc AS (SELECT path, unnest(ws) AS w FROM pw),
cnt AS (SELECT path, count(*) AS n FROM pc WHERE length({strip('w')}) >= 60 GROUP BY path),
hasblk AS (SELECT DISTINCT doc AS path FROM secs)
SELECT path, 'skipped' AS status, CAST(0 AS BIGINT) AS chunks, CAST(NULL AS VARCHAR) AS error FROM skipped
UNION ALL
SELECT t.path,
       CASE WHEN t.ft = 'json' OR h.path IS NULL OR coalesce(c.n, 0) = 0 THEN 'error' ELSE 'processed' END,
       CAST(CASE WHEN t.ft = 'json' OR h.path IS NULL OR coalesce(c.n, 0) = 0 THEN 0 ELSE c.n END AS BIGINT),
       CASE WHEN t.ft = 'json' THEN 'unsupported format: .json'
            WHEN h.path IS NULL THEN 'no extractable text (scanned without OCR?)'
            WHEN coalesce(c.n, 0) = 0 THEN 'no valid chunks after extraction' END
FROM todo t LEFT JOIN hasblk h USING (path) LEFT JOIN cnt c USING (path)"""

SQL["search_copies"] = """
WITH p AS (SELECT vec_id AS point_id, embedding FROM embeddings UNION ALL SELECT vec_id + 1000000000, embedding FROM embeddings), s AS (
  SELECT q.vec_id AS query_id, p.point_id, list_dot_product(q.embedding::DOUBLE[], p.embedding::DOUBLE[]) AS score
  FROM embeddings q CROSS JOIN p
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, point_id FROM r WHERE rank <= 5
"""

SQL["g1_store_search"] = f"""WITH d AS (
  SELECT conv_id, coalesce(string_agg(CASE WHEN length(t) > 0 THEN t || chr(10) END, '' ORDER BY turn), '') AS text
  FROM (SELECT conv_id, turn, text AS t FROM {WITH_BLANK}) GROUP BY conv_id
),
w AS (SELECT {windows('text', 500, 50)} AS ws FROM d WHERE length({strip('text')}) > 0),
u AS (SELECT unnest(ws) AS t FROM w),
pts AS (SELECT t AS text, {hashed_vector('t')} AS vector FROM u),
qv AS (SELECT item_id AS query_id, {hashed_vector('text')} AS vec FROM benchmark),
sc AS (SELECT q.query_id, p.text, list_dot_product(q.vec::DOUBLE[], p.vector::DOUBLE[]) AS score FROM qv q CROSS JOIN pts p),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC) AS rank FROM sc)
SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, md5(text) AS text_md5 FROM r WHERE rank <= 3"""

SQL["ann_topk_given"] = """
WITH m AS (SELECT label, part, i, avg(x::DOUBLE) AS x
  FROM (SELECT label, vec_id % 4 AS part, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, part, i),
c AS (SELECT row_number() OVER (ORDER BY label, part) - 1 AS cell, list(x ORDER BY i) AS v FROM m GROUP BY label, part),
near AS (SELECT vec_id, embedding, cell, row_number() OVER (PARTITION BY vec_id ORDER BY list_dot_product(embedding::DOUBLE[], v) DESC, cell) AS n
         FROM embeddings CROSS JOIN c),
s AS (SELECT q.vec_id AS query_id, p.vec_id AS point_id, list_dot_product(q.embedding::DOUBLE[], p.embedding::DOUBLE[]) AS score
      FROM near q JOIN near p ON q.cell = p.cell WHERE q.n <= 26 AND p.n = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, round(score, 4) AS score, point_id FROM r WHERE rank <= 5
"""

SQL["ann_stored"] = SQL["ann_topk_given"]

# what each index must reach against the exact search
SQL["ann_recall"] = """
WITH e AS (SELECT count(*) AS n FROM (
  SELECT row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.embedding::DOUBLE[], p.embedding::DOUBLE[]) DESC, p.vec_id) AS rank
  FROM embeddings q CROSS JOIN embeddings p) WHERE rank <= 5)
SELECT name, n AS exact_hits, true AS reached FROM e CROSS JOIN (VALUES ('cells'), ('tables'), ('given')) AS t(name)"""


def recursive_sql(x: str, size: int = 512, overlap: int = 52) -> str:
    """The chunks of a text: a fold over the pieces of each separator in turn."""
    cuts, nothing = "STRUCT(a INTEGER, b INTEGER, o BOOLEAN)[]", "{{'at': {}, 'ws': []::INTEGER[], 'cuts': []::{}}}"
    flushed = "(CASE WHEN len(c.ws) > 0 THEN list_concat(c.cuts, [{'a': c.ws[1], 'b': c.at, 'o': false}]) ELSE c.cuts END)"
    full = f"(len(c.ws) > 0 AND c.at - c.ws[1] + e.at > {size})"
    segs = f"CASE WHEN {x} IS NULL THEN [] ELSE [{{'t': CASE WHEN length({x}) > {size} THEN {x} ELSE {strip(x)} END, 'o': length({x}) > {size}}}] END"
    for sep in ("\\n\\n", "\\n", ". ", "? ", "! ", "; ", ", ", " "):
        q = "'" + sep + "'" if "\\" not in sep else " || ".join(["chr(10)"] * (len(sep) // 2))
        n = len(sep) // 2 if "\\" in sep else len(sep)
        pieces = f"list_transform(string_split(s.t, {q}), lambda p, i: {nothing.format(f'CAST(length(p) + CASE WHEN i > 1 THEN {n} ELSE 0 END AS INTEGER)', cuts)})"
        step = f"""CASE WHEN e.at = 0 THEN c
          WHEN e.at >= {size} THEN {{'at': c.at + e.at, 'ws': []::INTEGER[], 'cuts': list_concat({flushed}, [{{'a': c.at, 'b': c.at + e.at, 'o': true}}])}}
          ELSE {{'at': c.at + e.at, 'ws': list_append(CASE WHEN {full} THEN list_filter(c.ws, lambda w: c.at - w <= least({overlap}, {size} - e.at)) ELSE c.ws END, c.at),
                 'cuts': CASE WHEN {full} THEN {flushed} ELSE c.cuts END}} END"""
        fold = f"list_reduce(list_concat([{nothing.format('0::INTEGER', cuts)}], {pieces}), lambda c, e: {step})"
        piece = "substr(s.t, z.a + 1, z.b - z.a)"
        told = f"list_transform({flushed}, lambda z: {{'t': CASE WHEN z.o THEN {piece} ELSE {strip(piece)} END, 'o': z.o}})"
        segs = f"flatten(list_transform({segs}, lambda s: CASE WHEN s.o AND contains(s.t, {q}) THEN list_transform([{fold}], lambda c: {told})[1] ELSE [s] END))"
    step = size - overlap
    windows = f"list_transform(range(0, {step} * CAST(ceil((length(s.t) - {size}) / {step}) AS BIGINT) + 1, {step}), lambda o: {strip(f'substr(s.t, o + 1, {size})')})"
    return f"list_filter(flatten(list_transform({segs}, lambda s: CASE WHEN s.o THEN {windows} ELSE [s.t] END)), lambda t: t <> '')"


SQL["recursive_chunks"] = f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk, CAST(length(t) AS INTEGER) AS char_count, md5(t) AS text_md5
FROM (SELECT doc_id, unnest(cs) AS t, generate_subscripts(cs, 1) AS i FROM (SELECT doc_id, {recursive_sql('text')} AS cs FROM documents))"""

SQL["recursive_chunks_native"] = SQL["recursive_chunks"]

SQL["index_documents"] = SQL["index_documents_windows"].replace(windows("text", 500, 50), recursive_sql("text"))
