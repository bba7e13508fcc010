"""DuckDB reference SQL for the registered queries.

Written from the rules, independently of the Spark plans: tokens come from a
list comprehension over maximal runs (no lookahead: RE2 has none), phrases
from a sliding comparison of token lists, BM25 from its formula. Every
computed column carries the same alias as the Spark side; scores are
rounded to 6 digits and ties broken by ``round(score, 9) desc, id``.
"""

from __future__ import annotations

# Spelled out here, not shared with the library: fixed values of the rules.
CJK_CLASS = "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0x1100, 0x11FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF), (0xF900, 0xFAFF), (0x20000, 0x2A6DF)))
WS_CLASS = "\\t\\n\\x0B\\f\\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "\u2000-\u200a"
RUN_PATTERN = f"([{CJK_CLASS}]+|[^{CJK_CLASS}{WS_CLASS}]+)"
BM25_K1, BM25_B = 1.2, 0.75

LITERAL_RE = f"[^{WS_CLASS}]+"
#: maximal CJK runs, non-CJK words and white-space runs: they tile a text
SEGMENT_SQL_RE = f"([{CJK_CLASS}]+|[^{CJK_CLASS}{WS_CLASS}]+|[{WS_CLASS}]+)"
CJK_HEAD_RE = f"^[{CJK_CLASS}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def tok(expr: str) -> str:
    """Token list of a text expression (DuckDB)."""
    return (
        f"flatten(list_transform(regexp_extract_all(coalesce({expr}, ''), {q(RUN_PATTERN)}, 1), "
        f"lambda r: CASE WHEN regexp_matches(r, {q(CJK_HEAD_RE)}) THEN "
        f"flatten(list_transform(range(1, length(r) + 1), lambda j: CASE WHEN j < length(r) "
        f"THEN [substr(r, j, 1), substr(r, j, 2)] ELSE [substr(r, j, 1)] END)) "
        f"ELSE [r] END))"
    )


def literals(expr: str) -> str:
    return f"regexp_extract_all(coalesce({expr}, ''), {q(LITERAL_RE)}, 0)"


def docs_cte(corpus: str = "documents") -> str:
    """``d(id, header_key, text, toks)`` for a named corpus."""
    if corpus == "documents":
        src = "SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(lang, '') AS header_key, coalesce(text, '') AS text FROM documents"
    elif corpus == "documents_source":
        src = "SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(source, '') AS header_key, coalesce(text, '') AS text FROM documents"
    elif corpus == "cjk_documents":
        src = (
            "SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(lang, '') AS header_key, "
            "translate(lower(coalesce(text, '')), 'abcdefghijkl', '北京天気今日한국上海学校') AS text FROM documents"
        )
    elif corpus == "conversations":
        src = (
            "SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, "
            "coalesce(role, '') AS header_key, coalesce(text, '') AS text FROM conversations"
        )
    else:
        src = corpus  # a SELECT giving id, header_key, text
    return f"d0 AS ({src}), d AS MATERIALIZED (SELECT id, header_key, text, {tok('text')} AS toks FROM d0)"


def stats_cte() -> str:
    return "st AS MATERIALIZED (SELECT count(*)::DOUBLE AS n, coalesce(avg(len(toks)), 0)::DOUBLE AS avgdl FROM d)"


def idf_sql(df: str) -> str:
    return f"ln(1 + (st.n - {df} + 0.5::DOUBLE) / ({df} + 0.5::DOUBLE))"


def tfnorm_sql(tf: str, dl: str) -> str:
    return (
        f"({tf} * {BM25_K1 + 1.0}::DOUBLE / ({tf} + {BM25_K1}::DOUBLE * "
        f"({1.0 - BM25_B}::DOUBLE + {BM25_B}::DOUBLE * {dl} / st.avgdl)))"
    )


def scored_clauses_cte(queries_sql: str, whole_phrase: bool = False, p: str = "") -> str:
    """``{p}cs(query_id, id, header_key, tf, score)``: one row per matching
    (query, clause, document) for queries ``queries_sql`` giving
    ``(query_id, query)``. Plain queries: each white-space literal is a
    clause (one token: term clause, more: phrase). ``whole_phrase``: the
    whole query is one phrase clause. Phrases match by relational division
    over token positions. Needs the ``d`` and ``st`` CTEs; ``p`` prefixes the
    CTE names so that several blocks fit in one statement."""
    if whole_phrase:
        lits = f"{p}lits AS (SELECT query_id, 1 AS cid, query AS lit FROM {p}qs)"
    else:
        lits = (
            f"{p}l0 AS (SELECT query_id, {literals('query')} AS ls FROM {p}qs), "
            f"{p}lits AS (SELECT query_id, generate_subscripts(ls, 1) AS cid, unnest(ls) AS lit FROM {p}l0)"
        )
    return f"""
    {p}qs AS ({queries_sql}),
    {lits},
    {p}lq AS (SELECT query_id, cid, {tok('lit')} AS qt FROM {p}lits),
    {p}lqn AS (SELECT * FROM {p}lq WHERE len(qt) > 0),
    {p}qterms AS (SELECT DISTINCT unnest(qt) AS term FROM {p}lqn),
    {p}tpos AS MATERIALIZED (SELECT * FROM (SELECT id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM d)
                          WHERE term IN (SELECT term FROM {p}qterms)),
    {p}dfs AS (SELECT term, count(DISTINCT id) AS df FROM {p}tpos GROUP BY term),
    {p}w AS MATERIALIZED (SELECT l.query_id, l.cid, l.qt,
                 (SELECT sum({idf_sql('coalesce(x.df, 0)')}) FROM unnest(l.qt) AS u(term) LEFT JOIN {p}dfs x USING (term), st) AS w
          FROM {p}lqn l),
    {p}qtok AS (SELECT query_id, cid, w, len(qt) AS m, unnest(qt) AS term, generate_subscripts(qt, 1) - 1 AS off FROM {p}w),
    {p}starts AS (SELECT a.query_id, a.cid, a.w, a.m, b.id, b.pos - a.off AS s, count(*) AS c
               FROM {p}qtok a JOIN {p}tpos b USING (term) GROUP BY ALL),
    {p}mt AS (SELECT query_id, cid, w, id, count(*) AS tf FROM {p}starts WHERE c = m GROUP BY ALL),
    {p}m AS MATERIALIZED (SELECT mt.query_id, mt.w, mt.id, d.header_key, len(d.toks) AS dl, mt.tf FROM {p}mt mt JOIN d USING (id)),
    {p}cs AS (SELECT m.query_id, m.id, m.header_key, m.tf, m.w * {tfnorm_sql('m.tf', 'm.dl')} AS score FROM {p}m m, st WHERE m.tf > 0)
    """


def match_cte(name: str, text: str, whole_phrase: bool = False) -> str:
    """``{name}(id, header_key, score)``: hits of one plain query (or phrase)."""
    return (
        scored_clauses_cte(one_query(text), whole_phrase, p=f"{name}_")
        + f", {name} AS (SELECT id, header_key, sum(score) AS score FROM {name}_cs GROUP BY id, header_key)"
    )


def bm25_topk_sql(corpus: str, queries_sql: str, k: int, whole_phrase: bool = False) -> str:
    return f"""
    WITH {docs_cte(corpus)}, {stats_cte()}, {scored_clauses_cte(queries_sql, whole_phrase)},
    s AS (SELECT query_id, id, sum(score) AS score FROM cs GROUP BY query_id, id),
    r AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, id, round(score, 6) AS score FROM r WHERE rank <= {k}
    """


def one_query(text: str) -> str:
    return f"SELECT 'q' AS query_id, {q(text)} AS query"


def pos_cte() -> str:
    """``pos(id, term, pos)``: every token with its position."""
    return "pos AS MATERIALIZED (SELECT id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos FROM d)"


def composed_ctes(query, name: str) -> list[str]:
    """CTEs ending in ``{name}(id, header_key, score)`` for a composed query
    object of ``plans.query`` (needs ``d``, ``st`` and ``pos``)."""
    from . import query as Q

    if isinstance(query, Q.Match):
        return [match_cte(name, query.text)]
    if isinstance(query, Q.Phrase) and not query.prefix and query.slop == 0:
        return [match_cte(name, query.text, whole_phrase=True)]
    if isinstance(query, Q.Phrase) and query.prefix:
        return [
            f"""{name}_q AS (SELECT {tok(q(query.text))} AS qt),
            {name}_qtok AS (SELECT unnest(qt) AS term, generate_subscripts(qt, 1) - 1 AS off, len(qt) AS m FROM {name}_q),
            {name}_mt AS (SELECT p.id, p.pos - a.off AS s, count(*) AS c, any_value(a.m) AS m
                          FROM pos p JOIN {name}_qtok a
                          ON (a.off < a.m - 1 AND p.term = a.term) OR (a.off = a.m - 1 AND starts_with(p.term, a.term))
                          GROUP BY p.id, p.pos - a.off),
            {name}_cnt AS (SELECT id, count(*) AS tf, any_value(m) AS m FROM {name}_mt WHERE c = m GROUP BY id),
            {name}_w AS (SELECT coalesce(sum({idf_sql('x.df')}), 0) AS w
                         FROM (SELECT a.term, (SELECT count(DISTINCT p.id) FROM pos p WHERE p.term = a.term) AS df
                               FROM {name}_qtok a WHERE a.off < a.m - 1) x, st),
            {name} AS (SELECT c.id, d.header_key,
                              CASE WHEN c.m = 1 THEN 1.0::DOUBLE ELSE w.w * {tfnorm_sql('c.tf', 'len(d.toks)')} END AS score
                       FROM {name}_cnt c JOIN d USING (id), {name}_w w, st)"""
        ]
    if isinstance(query, Q.Phrase):  # sloppy: each next token at its nearest later place
        words = query.text.split()  # tokens of a text without CJK
        ctes = [f"{name}_c0 AS (SELECT id, pos AS p, pos AS e FROM pos WHERE term = {q(words[0])})"]
        for i, word in enumerate(words[1:], start=1):
            ctes.append(
                f"""{name}_c{i} AS (SELECT a.id, a.p, min(b.pos) AS e FROM {name}_c{i - 1} a JOIN pos b
                    ON a.id = b.id AND b.pos > a.e AND b.term = {q(word)} GROUP BY a.id, a.p)"""
            )
        terms = ", ".join(f"({q(w)})" for w in words)
        return [
            *ctes,
            f"""{name}_cnt AS (SELECT id, count(*) AS tf FROM {name}_c{len(words) - 1} WHERE e - p - {len(words) - 1} <= {int(query.slop)} GROUP BY id),
            {name}_w AS (SELECT sum({idf_sql('x.df')}) AS w
                         FROM (SELECT u.term, (SELECT count(DISTINCT p.id) FROM pos p WHERE p.term = u.term) AS df
                               FROM (VALUES {terms}) AS u(term)) x, st),
            {name} AS (SELECT c.id, d.header_key, w.w * {tfnorm_sql('c.tf', 'len(d.toks)')} AS score
                       FROM {name}_cnt c JOIN d USING (id), {name}_w w, st)""",
        ]
    if isinstance(query, Q.Field):
        f, v = query.field, q(query.value)
        return [
            f"""{name} AS (SELECT d.id, d.header_key, {idf_sql('x.df')} AS score
                FROM d, st, (SELECT count(*) AS df FROM d WHERE {f} = {v}) x WHERE d.{f} = {v})"""
        ]
    if isinstance(query, (Q.Range, Q.InSet)):
        col = "x" if query.field == "text" else query.field
        if isinstance(query, Q.Range):
            conds = []
            if query.lower is not None:
                conds.append(f"{col} {'>=' if query.include_lower else '>'} {q(query.lower)}")
            if query.upper is not None:
                conds.append(f"{col} {'<=' if query.include_upper else '<'} {q(query.upper)}")
            cond = " AND ".join(conds) or "TRUE"
        else:
            cond = f"{col} IN ({', '.join(q(v) for v in query.values)})"
        if query.field == "text":
            where = f"len(list_filter(toks, lambda x: {cond})) > 0"
        else:
            where = cond
        return [f"{name} AS (SELECT id, header_key, 1.0::DOUBLE AS score FROM d WHERE {where})"]
    if isinstance(query, Q.MatchAll):
        return [f"{name} AS (SELECT id, header_key, 1.0::DOUBLE AS score FROM d)"]
    if isinstance(query, Q.Boost):
        inner = composed_ctes(query.query, f"{name}_b")
        return inner + [f"{name} AS (SELECT id, header_key, score * {float(query.factor)}::DOUBLE AS score FROM {name}_b)"]
    if isinstance(query, Q.Bool):
        ctes, parts = [], []
        for role, qs in (("must", query.must), ("should", query.should), ("not", query.must_not)):
            for i, child in enumerate(qs):
                cn = f"{name}_{role}{i}"
                ctes += composed_ctes(child, cn)
                parts.append(f"SELECT id, header_key, score, '{role}' AS role FROM {cn}")
        need_should = "" if query.must else " AND ns > 0"
        ctes.append(
            f"""{name}_g AS (SELECT id, header_key,
                    sum(CASE WHEN role <> 'not' THEN score ELSE 0 END) AS score,
                    sum(CASE WHEN role = 'must' THEN 1 ELSE 0 END) AS nm,
                    sum(CASE WHEN role = 'should' THEN 1 ELSE 0 END) AS ns,
                    sum(CASE WHEN role = 'not' THEN 1 ELSE 0 END) AS nn
                FROM ({' UNION ALL '.join(parts)}) GROUP BY id, header_key),
            {name} AS (SELECT id, header_key, score FROM {name}_g WHERE nm = {len(query.must)} AND nn = 0{need_should})"""
        )
        return ctes
    raise TypeError(f"no SQL for {query!r}")


def composed_sql(query, corpus: str = "documents") -> str:
    ctes = composed_ctes(query, "res")
    return (
        f"WITH {docs_cte(corpus)}, {stats_cte()}, {pos_cte()}, {', '.join(ctes)} "
        "SELECT id, header_key, round(score, 6) AS score FROM res"
    )
