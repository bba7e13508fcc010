"""ORACLES: query name -> DuckDB SQL over the given tables (see ``oracle``)."""

from __future__ import annotations

from . import workloads as W
from .oracle import (
    CJK_CLASS,
    RUN_PATTERN,
    WS_CLASS,
    composed_sql,
    SEGMENT_SQL_RE,
    bm25_topk_sql,
    docs_cte,
    idf_sql,
    one_query,
    q,
    scored_clauses_cte,
    stats_cte,
    tfnorm_sql,
    tok,
)

ORACLES: dict[str, str] = {}


def _reg(name: str, sql: str) -> None:
    ORACLES[name] = " ".join(sql.split())


_DOCS = "SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(lang, '') AS header_key, coalesce(text, '') AS text FROM documents"

# ---- C ------------------------------------------------------------------------
_reg(
    "token_counts",
    f"""WITH {docs_cte()}
    SELECT id, header_key, CAST(len(toks) AS BIGINT) AS n_tokens, CAST(len(list_distinct(toks)) AS BIGINT) AS n_terms FROM d""",
)

# token table with UTF-8 byte offsets: runs (and white-space runs) tile the
# text; running sums give each run's byte offset and first position
def _offsets_sql(source: str) -> str:
    return f"""WITH d AS ({source}),
    runs AS (SELECT id, regexp_extract_all(text, {q(SEGMENT_SQL_RE)}, 1) AS rs FROM d),
    r1 AS (SELECT id, unnest(rs) AS r, generate_subscripts(rs, 1) AS idx FROM runs),
    r2 AS (SELECT id, idx, r,
             CASE WHEN regexp_matches(r, '^[{CJK_CLASS}]') THEN 'c'
                  WHEN regexp_matches(r, '^[{WS_CLASS}]') THEN 'w' ELSE 'x' END AS kind,
             strlen(r) AS nb FROM r1),
    r3 AS (SELECT *, CASE kind WHEN 'c' THEN 2 * length(r) - 1 WHEN 'w' THEN 0 ELSE 1 END AS nt FROM r2),
    r4 AS (SELECT *, coalesce(sum(nb) OVER (PARTITION BY id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b0,
                     coalesce(sum(nt) OVER (PARTITION BY id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p0 FROM r3),
    words AS (SELECT id, CAST(p0 AS INTEGER) AS pos, r AS term, 1 AS pos_len, CAST(b0 AS INTEGER) AS off_from, CAST(b0 + nb AS INTEGER) AS off_to FROM r4 WHERE kind = 'x'),
    chars AS (SELECT id, p0, b0, r, unnest(range(1, length(r) + 1)) AS j FROM r4 WHERE kind = 'c'),
    uni AS (SELECT id, CAST(p0 + 2 * (j - 1) AS INTEGER) AS pos, substr(r, j, 1) AS term, 1 AS pos_len,
                   CAST(b0 + strlen(substr(r, 1, j - 1)) AS INTEGER) AS off_from,
                   CAST(b0 + strlen(substr(r, 1, j)) AS INTEGER) AS off_to FROM chars),
    bi AS (SELECT id, CAST(p0 + 2 * (j - 1) + 1 AS INTEGER) AS pos, substr(r, j, 2) AS term, 2 AS pos_len,
                  CAST(b0 + strlen(substr(r, 1, j - 1)) AS INTEGER) AS off_from,
                  CAST(b0 + strlen(substr(r, 1, j + 1)) AS INTEGER) AS off_to FROM chars WHERE j < length(r))
    SELECT * FROM words UNION ALL SELECT * FROM uni UNION ALL SELECT * FROM bi"""


_CJK_DOCS = (
    "SELECT CAST(doc_id AS VARCHAR) AS id, translate(lower(coalesce(text, '')), 'abcdefghijkl', '北京天気今日한국上海学校') AS text FROM documents"
)
_reg("token_table", _offsets_sql(_DOCS))
_reg("token_table_cjk", _offsets_sql(_CJK_DOCS))

_reg(
    "cjk_tokens",
    f"""WITH {docs_cte('cjk_documents')},
    t AS (SELECT id, unnest(toks) AS term FROM d)
    SELECT term, CAST(count(DISTINCT id) AS BIGINT) AS df, CAST(count(*) AS BIGINT) AS cf FROM t GROUP BY term""",
)

# ---- D ------------------------------------------------------------------------
_reg(
    "postings",
    f"""WITH {docs_cte()},
    t AS (SELECT id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM d)
    SELECT term, id, CAST(count(*) AS BIGINT) AS tf, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
    FROM t GROUP BY term, id""",
)
_reg(
    "term_df",
    f"""WITH {docs_cte()},
    t AS (SELECT id, unnest(toks) AS term FROM d)
    SELECT term, CAST(count(DISTINCT id) AS BIGINT) AS df, CAST(count(*) AS BIGINT) AS cf FROM t GROUP BY term""",
)
_reg(
    "doc_length",
    f"""WITH {docs_cte()} SELECT id, header_key, CAST(len(toks) AS BIGINT) AS dl FROM d""",
)
_reg(
    "corpus_stats",
    f"""WITH {docs_cte()}
    SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(coalesce(sum(len(toks)), 0) AS BIGINT) AS total_tokens,
           round(coalesce(avg(len(toks)), 0), 6) AS avgdl FROM d""",
)

# ---- E ------------------------------------------------------------------------
_reg(
    "bm25_search",
    f"SELECT rank, id, score FROM ({bm25_topk_sql('documents', one_query(W.BM25_QUERY), W.TOP_K)})",
)
_reg(
    "bm25_batch",
    bm25_topk_sql(
        "documents",
        "SELECT CAST(item_id AS VARCHAR) AS query_id, text AS query FROM benchmark",
        W.TOP_K,
    ),
)
_reg(
    "cjk_search",
    f"SELECT rank, id, score FROM ({bm25_topk_sql('cjk_documents', one_query(W.CJK_QUERY), W.TOP_K)})",
)
_reg(
    "phrase_search",
    f"""WITH {docs_cte()}, {stats_cte()}, {scored_clauses_cte(one_query(W.PHRASE_QUERY), whole_phrase=True)}
    SELECT id, CAST(tf AS BIGINT) AS occurrences, round(score, 6) AS score FROM cs""",
)


# ---- E5 / E7 / E9 -------------------------------------------------------------


def _hits_sql(corpus: str, text: str) -> str:
    return f"""WITH {docs_cte(corpus)}, {stats_cte()}, {scored_clauses_cte(one_query(text))},
    s AS (SELECT id, header_key, sum(score) AS score FROM cs GROUP BY id, header_key),
    r AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, id) AS rn FROM s)"""


_reg(
    "facets",
    f"""{_hits_sql('documents', W.BM25_QUERY)}
    SELECT header_key, CAST(count(*) AS BIGINT) AS count FROM r GROUP BY header_key""",
)
_reg(
    "result_map",
    f"""{_hits_sql('documents', W.BM25_QUERY)}
    SELECT id, round(score, 6) AS score FROM r WHERE rn <= {W.TOP_K}""",
)

# ---- E4: DuckDB's damerau_levenshtein is byte-based and unrestricted; fold
# every non-ASCII character to one byte first (exact for ASCII queries) ------


def _fuzzy_sql(text: str, dist: int) -> str:
    return f"""WITH {docs_cte()},
    qt0 AS (SELECT {tok(q(text))} AS qt),
    qt AS (SELECT unnest(qt) AS qterm, generate_subscripts(qt, 1) AS cid FROM qt0),
    vocab AS (SELECT DISTINCT unnest(toks) AS term FROM d),
    mt AS (SELECT qt.cid, vocab.term FROM qt, vocab
           WHERE abs(length(vocab.term) - length(qt.qterm)) <= {dist}
             AND damerau_levenshtein(regexp_replace(vocab.term, '[^\\x00-\\x7F]', '~', 'g'), qt.qterm) <= {dist}),
    occ AS (SELECT DISTINCT d.id, mt.cid FROM (SELECT id, unnest(toks) AS term FROM d) d JOIN mt USING (term)),
    s AS (SELECT id, CAST(count(*) AS DOUBLE) AS score FROM occ GROUP BY id)"""


_reg("fuzzy_search_d1", f"{_fuzzy_sql(W.FUZZY_D1_QUERY, 1)} SELECT id, score FROM s")
_reg("fuzzy_search_d2", f"{_fuzzy_sql(W.FUZZY_D2_QUERY, 2)} SELECT id, score FROM s")
_reg(
    "fuzzy_top10",
    f"""{_fuzzy_sql(W.FUZZY_D1_QUERY, 1)},
    r AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, id) AS rank FROM s)
    SELECT CAST(rank AS INTEGER) AS rank, id, score FROM r WHERE rank <= {W.TOP_K}""",
)

# ---- B ------------------------------------------------------------------------
_UPS = (
    "SELECT CAST(conv_id * 1000 + turn AS BIGINT) AS seq, CAST(conv_id AS VARCHAR) AS id, "
    "coalesce(role, '') AS header_key, coalesce(text, '') AS text FROM conversations"
)
_reg(
    "upsert",
    f"""WITH docs AS ({_DOCS}), ups AS ({_UPS}),
    latest AS (SELECT * FROM ups QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC, header_key DESC, text DESC) = 1),
    res AS (SELECT id, header_key, text FROM docs WHERE id NOT IN (SELECT id FROM latest)
            UNION ALL SELECT id, header_key, text FROM latest)
    SELECT id, header_key, md5(text) AS text_md5 FROM res""",
)
_reg(
    "delete_by_header",
    f"""SELECT rank, id, score FROM ({bm25_topk_sql(
        f"SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(lang, '') AS header_key, coalesce(text, '') AS text "
        f"FROM documents WHERE coalesce(lang, '') <> {q(W.DELETED_HEADER)}",
        one_query(W.BM25_QUERY), W.TOP_K)})""",
)
# the change-feed rule stated directly: a row survives unless a later change
# upserts its id or deletes its header_key
_reg(
    "change_feed",
    f"""WITH docs AS ({_DOCS}), u AS ({_UPS}),
    ch AS (SELECT seq,
                  CASE WHEN header_key = 'system' THEN 'delete_header' ELSE 'upsert' END AS op,
                  CASE WHEN header_key = 'system' THEN NULL ELSE id END AS id,
                  CASE WHEN header_key = 'system' THEN 'assistant' ELSE header_key END AS header_key,
                  CASE WHEN header_key = 'system' THEN NULL ELSE text END AS text FROM u),
    allrows AS (SELECT -1 AS seq, id, header_key, text FROM docs
                UNION ALL SELECT seq, id, header_key, text FROM ch WHERE op = 'upsert'),
    res AS (SELECT * FROM allrows a
            WHERE NOT EXISTS (SELECT 1 FROM ch c WHERE c.op = 'upsert' AND c.id = a.id AND c.seq > a.seq)
              AND NOT EXISTS (SELECT 1 FROM ch c WHERE c.op = 'delete_header' AND c.header_key = a.header_key AND c.seq > a.seq))
    SELECT id, header_key, md5(text) AS text_md5 FROM res""",
)

# ---- F ------------------------------------------------------------------------
for _name, _query in W.COMPOSED.items():
    _reg(_name, composed_sql(_query))

# ---- A / G1 ---------------------------------------------------------------------
ORACLES["corpus_rebuild"] = ORACLES["bm25_search"]
_reg(
    "open_or_create",
    f"""WITH {docs_cte('conversations')}
    SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(coalesce(sum(len(toks)), 0) AS BIGINT) AS total_tokens,
           round(coalesce(avg(len(toks)), 0), 6) AS avgdl FROM d""",
)
_reg(
    "snapshot_read",
    f"""WITH v2 AS ({ORACLES['change_feed']})
    SELECT 1 AS version, coalesce(lang, '') AS header_key, CAST(count(*) AS BIGINT) AS n_docs FROM documents GROUP BY 2
    UNION ALL SELECT 2, header_key, CAST(count(*) AS BIGINT) FROM v2 GROUP BY 2""",
)
ORACLES["stream_upsert"] = ORACLES["change_feed"]
ORACLES["shuffled_feed"] = ORACLES["change_feed"]
_reg(
    "refused_calls",
    """SELECT call, error, (SELECT count(*) FROM documents) AS n_docs FROM (VALUES
    ('top_k of 0', 'ValueError'), ('distance of 3', 'ValueError'), ('distance of -1', 'ValueError'), ('only must_not', 'ValueError'),
    ('search after close', 'RuntimeError'), ('change after close', 'RuntimeError'), ('snapshot after close', 'RuntimeError')) AS t(call, error)""",
)

# ---- more corpora / query tables ------------------------------------------------
_reg(
    "conversation_search",
    bm25_topk_sql(
        "conversations",
        "SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS query_id, text AS query "
        "FROM conversations WHERE role = 'user'",
        W.CONVERSATION_K,
    ),
)
_reg(
    "filtered_search",
    f"""{_hits_sql('documents', W.BM25_QUERY)},
    f AS (SELECT * FROM s WHERE id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1)),
    fr AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, id) AS rank FROM f)
    SELECT CAST(rank AS INTEGER) AS rank, id, round(score, 6) AS score FROM fr WHERE rank <= {W.TOP_K}""",
)
# Non-ASCII query tokens: folding every non-ASCII character to one byte can
# only shrink a distance, so the folded distance is a prefilter; survivors are
# re-encoded pair by pair (each distinct character of the pair -> its own
# single byte) and measured exactly. At distance 1 restricted = unrestricted.
_reg(
    "fuzzy_batch",
    f"""WITH {docs_cte()},
    qs AS (SELECT CAST(item_id AS VARCHAR) AS query_id, {tok('text')} AS qt FROM benchmark),
    qt AS (SELECT query_id, unnest(qt) AS qterm, generate_subscripts(qt, 1) AS cid FROM qs),
    vocab AS (SELECT DISTINCT unnest(toks) AS term FROM d),
    mt0 AS (SELECT qt.query_id, qt.cid, qt.qterm, vocab.term FROM qt JOIN vocab
           ON abs(length(vocab.term) - length(qt.qterm)) <= 1
          AND damerau_levenshtein(regexp_replace(vocab.term, '[^\\x00-\\x7F]', '~', 'g'),
                                  regexp_replace(qt.qterm, '[^\\x00-\\x7F]', '~', 'g')) <= 1),
    mt1 AS (SELECT *, list_sort(list_distinct(string_split(qterm || term, ''))) AS alph FROM mt0),
    mt AS (SELECT query_id, cid, term FROM mt1
           WHERE damerau_levenshtein(
                   array_to_string(list_transform(string_split(term, ''), lambda c: chr(32 + list_position(alph, c))), ''),
                   array_to_string(list_transform(string_split(qterm, ''), lambda c: chr(32 + list_position(alph, c))), '')) <= 1),
    occ AS (SELECT DISTINCT mt.query_id, d.id, mt.cid FROM (SELECT id, unnest(toks) AS term FROM d) d JOIN mt USING (term)),
    s AS (SELECT query_id, id, CAST(count(*) AS DOUBLE) AS score FROM occ GROUP BY query_id, id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, id, score FROM r WHERE rank <= {W.TOP_K}""",
)
_PAGES = (
    "SELECT CAST(page_id AS VARCHAR) AS id, coalesce(regexp_extract(url, '://([^/]+)', 1), '') AS header_key, "
    "coalesce(html, '') AS text FROM pages"
)
_reg("pages_search", f"SELECT rank, id, score FROM ({bm25_topk_sql(_PAGES, one_query(W.PAGES_QUERY), W.TOP_K)})")

# ---- more operators --------------------------------------------------------------
_reg(
    "cjk_characters",
    f"""WITH d AS ({_CJK_DOCS}), c AS (SELECT unnest(string_split(text, '')) AS ch FROM d)
    SELECT ch, count(*) AS n, regexp_matches(ch, {q(f'^[{CJK_CLASS}]$')}) AS cjk FROM c WHERE ch <> '' GROUP BY ch""",
)
_reg(
    "text_runs",
    f"""WITH d AS ({_CJK_DOCS}), r AS (SELECT id, regexp_extract_all(text, {q(RUN_PATTERN)}, 1) AS rs FROM d)
    SELECT id, CAST(len(rs) AS BIGINT) AS n_runs, md5(coalesce(array_to_string(rs, '|'), '')) AS runs_md5 FROM r""",
)
ORACLES["stored_postings"] = ORACLES["postings"]
_reg("blank_search", f"SELECT * FROM ({ORACLES['bm25_search']}) WHERE false")
_reg(
    "blank_in_batch",
    f"""WITH found AS (SELECT query_id, count(*) AS n FROM ({ORACLES['bm25_batch']}) GROUP BY query_id),
    qs AS (SELECT CAST(item_id AS VARCHAR) AS query_id FROM benchmark UNION SELECT 'blank-' || CAST(item_id AS VARCHAR) FROM benchmark)
    SELECT query_id, CAST(coalesce(n, 0) AS BIGINT) AS n_results FROM qs LEFT JOIN found USING (query_id)""",
)
_LOWER = (
    "SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(lang, '') AS header_key, lower(coalesce(text, '')) AS text FROM documents"
)
_reg("analyzer_search", f"SELECT rank, id, score FROM ({bm25_topk_sql(_LOWER, one_query(W.LOWERCASE_QUERY.lower()), W.TOP_K)})")
ORACLES["ephemeral_search"] = ORACLES["bm25_search"]
_reg("truncated", "SELECT 1 AS version, count(*) AS n_docs FROM documents UNION ALL SELECT 2, 0")
_reg(
    "search_facets",
    f"""SELECT 'result' AS kind, rank, id AS name, score, CAST(NULL AS BIGINT) AS count FROM ({ORACLES['bm25_search']})
    UNION ALL SELECT 'facet', NULL, header_key, NULL, count FROM ({ORACLES['facets']})""",
)
_reg(
    "phrase_top10",
    f"SELECT rank, id, score FROM ({bm25_topk_sql('documents', one_query(W.PHRASE_QUERY), W.TOP_K, whole_phrase=True)})",
)
_reg(
    "phrase_batch",
    bm25_topk_sql(
        "documents", "SELECT CAST(item_id AS VARCHAR) AS query_id, text AS query FROM benchmark", W.TOP_K, whole_phrase=True
    ),
)
# every row a document, whatever its id; the query's terms are single words
_reg(
    "repeated_ids",
    f"""WITH d AS (SELECT row_number() OVER () AS r, CAST(conv_id AS VARCHAR) AS id, {tok('text')} AS toks FROM conversations),
    {stats_cte()},
    t AS (SELECT r, any_value(id) AS id, any_value(dl) AS dl, term, count(*) AS tf
          FROM (SELECT r, id, len(toks) AS dl, unnest(toks) AS term FROM d) WHERE term IN ({', '.join(map(q, W.REPEATED_QUERY.split()))}) GROUP BY r, term),
    f AS (SELECT term, count(*) AS df FROM t GROUP BY term)
    SELECT any_value(id) AS id, round(sum({idf_sql('df')} * {tfnorm_sql('tf', 'dl')}), 6) AS score
    FROM t JOIN f USING (term), st GROUP BY r""",
)
_CHANGED = ORACLES["change_feed"].replace("SELECT id, header_key, md5(text) AS text_md5 FROM res", "SELECT id, header_key, text FROM res")
_reg("search_after_changes", f"SELECT rank, id, score FROM ({bm25_topk_sql(_CHANGED, one_query(W.BM25_QUERY), W.TOP_K)})")
