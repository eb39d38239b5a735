"""The registered queries again, as SQL over the same tables."""

from __future__ import annotations

from corpusgrove.catalog.queries import FIRST_ROUND, LINKS, PACK_BUDGET, PAIR_THRESHOLD, PATIENCE, RARE, REFINED, SMALL_CONTEXT
from corpusgrove.catalog import stub

TOKEN = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]"
SPACED = r"\s*(?:[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s])"


def tokens(text: str) -> str:
    return f"len(regexp_extract_all({text}, '{TOKEN}'))"


def cut(text: str, n: str) -> str:
    return (
        f"CASE WHEN {tokens(text)} > {n} THEN array_to_string(list_slice("
        f"regexp_extract_all({text}, '{SPACED}'), 1, {n}), '') ELSE {text} END"
    )


def capital(word: str) -> str:
    return f"upper(left({word}, 1)) || substr({word}, 2)"


def literal(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _similar(labels: str) -> str:
    """Labels of every document, most similar first: rank, and tokens up to and with each."""
    return rf"""
        SELECT doc_id, pos, label, tok, row_number() OVER w AS rank, sum(tok) OVER w AS upto FROM (
            SELECT d.doc_id, l.pos, l.label, l.tok, round(coalesce(x.dot / (dnorm.z * ln.z), 0), 12) AS s
            FROM documents d CROSS JOIN {labels} l LEFT JOIN dnorm ON dnorm.doc_id = d.doc_id
            LEFT JOIN (SELECT pos, sqrt(sum(n * n)) AS z FROM ({_terms(labels)}) GROUP BY pos) ln ON ln.pos = l.pos
            LEFT JOIN (SELECT a.doc_id, b.pos, sum(a.n * b.n) AS dot FROM dterm a JOIN ({_terms(labels)}) b USING (dim) GROUP BY 1, 2) x
                ON x.doc_id = d.doc_id AND x.pos = l.pos)
        WINDOW w AS (PARTITION BY doc_id ORDER BY s DESC, pos)"""


def _terms(labels: str) -> str:
    return rf"""SELECT pos, ('0x' || left(md5(w), 4))::INTEGER % 256 AS dim, count(*)::DOUBLE AS n
        FROM (SELECT pos, unnest(regexp_extract_all(lower(label), '[\p{{L}}\p{{N}}]+')) AS w FROM {labels}) GROUP BY 1, 2"""


def _refined(rounds: int) -> str:
    """Tables of the refinement: the nodes, their labels, the two best unseen pairs and the merge of each round."""
    parts = [f"node0 AS (SELECT ord AS pos, name, n, descr FROM topics WHERE n >= (SELECT sum(n) FROM topics) * {REFINED})"]
    for r in range(rounds):
        seen = " UNION ALL ".join(f"SELECT pair FROM best{k}" for k in range(r)) or "SELECT NULL WHERE false"
        parts += [
            f"label{r} AS (SELECT pos, '[1] ' || name || ': ' || descr AS label FROM node{r})",
            f"term{r} AS ({_terms(f'label{r}')})",
            f"size{r} AS (SELECT pos, sqrt(sum(n * n)) AS z FROM term{r} GROUP BY 1)",
            f"""near{r} AS (SELECT d.i, d.j, round(d.dot / (a.z * b.z), 12) AS s FROM (
                    SELECT a.pos AS i, b.pos AS j, sum(a.n * b.n) AS dot FROM term{r} a JOIN term{r} b ON a.dim = b.dim AND a.pos < b.pos GROUP BY 1, 2) d
                    JOIN size{r} a ON a.pos = d.i JOIN size{r} b ON b.pos = d.j)""",
            f"""best{r} AS (SELECT i, j, s, list_sort([a.label, b.label]) AS pair FROM near{r} JOIN label{r} a ON a.pos = i JOIN label{r} b ON b.pos = j
                    WHERE s > 0.5 AND list_sort([a.label, b.label]) NOT IN ({seen}) ORDER BY s DESC, i, j LIMIT 2)""",
            f"head{r} AS (SELECT i, j FROM best{r} ORDER BY s DESC, i, j LIMIT 1)",
            f"""node{r + 1} AS (SELECT o.pos, o.name, o.n + CASE WHEN h.i IS NULL THEN 0 ELSE m.n END AS n,
                    CASE WHEN h.i IS NULL THEN o.descr ELSE 'Merged topics.' END AS descr
                    FROM node{r} o LEFT JOIN head{r} h ON h.i = o.pos LEFT JOIN node{r} m ON m.pos = h.j WHERE o.pos NOT IN (SELECT j FROM head{r}))""",
        ]
    return ",\n".join(parts)


# ------------------------------------------------------------ common tables

CTE = {
    "words": r"SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}]{6,}')) AS w FROM documents",
    "ranked": """
        SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, w) AS rk
        FROM (SELECT doc_id, w, count(*) AS n FROM words GROUP BY doc_id, w) QUALIFY rk <= 2""",
    "two": """
        SELECT d.doc_id, d.lang, d.source, max(w) FILTER (rk = 1) AS w1, max(w) FILTER (rk = 2) AS w2
        FROM documents d LEFT JOIN ranked r USING (doc_id) GROUP BY d.doc_id, d.lang, d.source""",
    "parts": f"""
        SELECT doc_id, 1 AS pos, '[1] ' || CASE WHEN doc_id % 2 = 0 THEN {capital('w1')} ELSE w1 END
               || ': Documents from ' || source || ' about ' || w1 || '.' AS line FROM two WHERE w1 IS NOT NULL
        UNION ALL
        SELECT doc_id, 2, '[1] ' || CASE WHEN doc_id % 2 = 0 THEN {capital('w2')} ELSE w2 END
               || ': Documents from ' || source || ' about ' || w2 || '.' FROM two WHERE w2 IS NOT NULL
        UNION ALL SELECT doc_id, 3, '[1] Unlisted Matter: Nothing in the tree covers this.' FROM two WHERE doc_id % 23 = 22
        UNION ALL SELECT doc_id, 4, '[2] Detail: A lower level line.' FROM two WHERE doc_id % 13 = 12
        UNION ALL SELECT doc_id, 5, 'no topic on this line' FROM two WHERE doc_id % 11 = 10""",
    "resp": """
        SELECT t.doc_id, t.lang, t.source,
               CASE WHEN t.doc_id % 29 = 28 THEN 'Error'
                    WHEN t.doc_id % 17 = 16 THEN 'None'
                    ELSE coalesce(string_agg(p.line, chr(10) ORDER BY p.pos), 'None') END AS responses
        FROM two t LEFT JOIN parts p USING (doc_id) GROUP BY t.doc_id, t.lang, t.source""",
    "lines": r"""
        SELECT doc_id, unnest(string_split(responses, chr(10))) AS line,
               (generate_subscripts(string_split(responses, chr(10)), 1) - 1)::INTEGER AS line_idx FROM resp""",
    "level1": r"""
        SELECT doc_id, line_idx, trim(regexp_extract(line, '^\[(\d+)\] ([\p{L}\p{N}_\s+#-]+):(.+)', 2)) AS name,
               trim(regexp_extract(line, '^\[(\d+)\] ([\p{L}\p{N}_\s+#-]+):(.+)', 3)) AS descr
        FROM lines WHERE regexp_matches(line, '^\[1\] ([\p{L}\p{N}_\s+#-]+):(.+)')""",
    "topics": """
        SELECT lower(name) AS key, count(*) AS n, min(doc_id * 1048576 + line_idx) AS ord,
               arg_min(name, doc_id * 1048576 + line_idx) AS name, arg_min(descr, doc_id * 1048576 + line_idx) AS descr
        FROM level1 GROUP BY lower(name)""",
    "frequent": f"SELECT * FROM topics WHERE n >= (SELECT sum(n) FROM topics) * {RARE}",
    "mentions": r"""
        SELECT l.doc_id, l.line_idx, '[1] ' || f.name AS topic FROM lines l JOIN frequent f
        ON regexp_extract(l.line, '^\[1\] ([\p{L}\p{N}_\s+#-]+):(.+)', 1) = f.name""",
    "assigned": r"""
        SELECT doc_id, line_idx, trim(regexp_extract(line, '^\[\d+\] ([\p{L}\p{N}_\s&''-]+):', 1)) AS topic
        FROM lines WHERE regexp_matches(line, '^\[\d+\] ([\p{L}\p{N}_\s&''-]+):')""",
    "errors": "SELECT doc_id FROM resp WHERE doc_id NOT IN (SELECT doc_id FROM assigned)",
    "hallucinated": "SELECT DISTINCT doc_id FROM assigned WHERE topic NOT IN (SELECT name FROM frequent)",
    "bad": """
        SELECT doc_id, 'error' AS reason FROM errors UNION ALL SELECT doc_id, 'hallucinated' FROM hallucinated""",
    "numbered": "SELECT *, row_number() OVER (ORDER BY doc_id, line_idx) - 1 AS g FROM level1",
    "marks": """
        SELECT g, lead(g) OVER (ORDER BY g) AS next_g
        FROM (SELECT min(g) AS g FROM numbered GROUP BY lower(name) UNION ALL SELECT -1)""",
    "stop": f"""
        SELECT n.* FROM numbered n WHERE g = (SELECT min(g + {PATIENCE} + 1) FROM marks
        WHERE next_g IS NULL OR g + {PATIENCE} + 1 < next_g)""",
    "heads": "SELECT source, min(doc_id) AS head, count(*) AS n FROM documents GROUP BY source",
    "langs": "SELECT source, lang, min(doc_id) AS born, count(*) AS n FROM documents GROUP BY source, lang",
    "tree": """
        SELECT head, -1 AS born, 1 AS lvl, source AS name, n, 'Documents of ' || source AS descr, '' AS parent,
               head::VARCHAR AS path FROM heads
        UNION ALL
        SELECT h.head, l.born, 2, l.lang, l.n, CASE WHEN l.lang = 'es' THEN '' ELSE 'Documents in ' || l.lang END,
               l.source, h.head || '/' || l.born FROM langs l JOIN heads h USING (source)""",
    "firsts": r"SELECT doc_id, lang, CASE WHEN regexp_matches(responses, '\[(?:\d+)\] ([^:]+): (?:.+)') "
    r"THEN regexp_extract(responses, '\[(?:\d+)\] ([^:]+): (?:.+)', 1) ELSE 'None' END AS pred FROM resp",
    "cells": "SELECT lang AS truth, pred, count(*) AS n FROM firsts GROUP BY lang, pred",
    "pm": "SELECT pred, sum(n) AS b FROM cells GROUP BY pred",
    "tm": "SELECT truth, sum(n) AS a FROM cells GROUP BY truth",
    "tot": "SELECT sum(n)::DOUBLE AS n FROM cells",
    "qcells": "SELECT l.quality AS truth, lower(f.pred) AS pred, count(*) AS n "
    "FROM firsts f JOIN labels l USING (doc_id) GROUP BY 1, 2",
    "merge_answers": f"""
        SELECT doc_id, w1, w2, {capital('w1')} AS a, {capital('w2')} AS b FROM two WHERE w2 IS NOT NULL""",
    "originals": """
        SELECT doc_id, 0 AS pos, a AS new_name, a AS old_name FROM merge_answers
        UNION ALL SELECT doc_id, 1, a, b FROM merge_answers""",
    "vec": "SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings",
    "cluster": f"""
        SELECT label, v, '[1] Cluster ' || label || ': Vectors like the first of ' || label AS topic,
               {tokens("'[1] Cluster ' || label || ': Vectors like the first of ' || label")} AS tok
        FROM vec QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1""",
    "sims": """
        SELECT e.vec_id, c.topic, c.tok, list_cosine_similarity(e.v, c.v) AS s,
               row_number() OVER (PARTITION BY e.vec_id ORDER BY list_cosine_similarity(e.v, c.v) DESC, c.label)::INTEGER - 1 AS position,
               sum(c.tok) OVER (PARTITION BY e.vec_id ORDER BY list_cosine_similarity(e.v, c.v) DESC, c.label) AS upto
        FROM vec e CROSS JOIN cluster c""",
    "vpairs": f"""
        SELECT a.vec_id AS i, b.vec_id AS j, list_cosine_similarity(a.v, b.v) AS score
        FROM vec a JOIN vec b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) > {PAIR_THRESHOLD}""",
    "dterm": r"""
        SELECT doc_id, ('0x' || left(md5(w), 4))::INTEGER % 256 AS dim, count(*)::DOUBLE AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM documents) GROUP BY 1, 2""",
    "dnorm": "SELECT doc_id, sqrt(sum(n * n)) AS z FROM dterm GROUP BY 1",
    "flab": f"""SELECT ord AS pos, '[1] ' || name || ': ' || descr AS label, {tokens("'[1] ' || name || ': ' || descr")} AS tok FROM frequent""",
    "tlab": f"""SELECT ord AS pos, '[1] ' || name AS label, {tokens("'[1] ' || name")} AS tok FROM topics""",
    "fsim": _similar("flab"),
    "tsim": _similar("tlab"),
    "sized": f"""
        SELECT lang AS topic, doc_id, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i,
               {tokens('text')} AS whole, least({tokens('text')}, {PACK_BUDGET // 5}) + 2 AS tok FROM documents""",
    "packed": f"""
        SELECT topic, i, 0::BIGINT AS batch_id, tok AS fill FROM sized WHERE i = 1
        UNION ALL
        SELECT s.topic, s.i, CASE WHEN p.fill + s.tok >= {PACK_BUDGET} THEN p.batch_id + 1 ELSE p.batch_id END,
               CASE WHEN p.fill + s.tok >= {PACK_BUDGET} THEN s.tok ELSE p.fill + s.tok END
        FROM packed p JOIN sized s ON s.topic = p.topic AND s.i = p.i + 1""",
    "batches": f"""
        SELECT topic, batch_id, count(*) AS n_docs, sum(tok) AS n_tokens,
               string_agg('Document ' || i || chr(10) || CASE WHEN whole >= {PACK_BUDGET // 5}
                   THEN {cut('text', str(PACK_BUDGET // 5))} ELSE replace(text, chr(10), ' ') END || chr(10), '' ORDER BY i) AS text
        FROM sized JOIN packed USING (topic, i) GROUP BY topic, batch_id""",
    "plain_parts": f"""
        SELECT doc_id, rk, '[1] ' || {capital('w')} || ': Documents about ' || w || '.' AS line, w FROM ranked""",
    "plain": "SELECT doc_id, rk, w, row_number() OVER (ORDER BY doc_id, rk) - 1 AS g FROM ranked",
    "plain_marks": """
        SELECT g, lead(g) OVER (ORDER BY g) AS next_g
        FROM (SELECT min(g) AS g FROM plain GROUP BY w UNION ALL SELECT -1)""",
    "labels_text": """
        SELECT string_agg('[1] ' || name || ': ' || descr, chr(10) ORDER BY ord) AS whole,
               list('[1] ' || name || ': ' || descr ORDER BY ord) AS labels, string_agg('[1] ' || name, chr(10) ORDER BY ord) AS bare,
               first('[1] ' || name ORDER BY ord) AS head FROM frequent""",
    "turns": "SELECT conv_id, turn, role, text, sha256(text) AS prompt_hash FROM conversations",
}

NEEDS = {
    "ranked": ["words"], "two": ["ranked"], "parts": ["two"], "resp": ["two", "parts"], "lines": ["resp"],
    "level1": ["lines"], "topics": ["level1"], "frequent": ["topics"], "mentions": ["lines", "frequent"],
    "assigned": ["lines"], "errors": ["resp", "assigned"], "hallucinated": ["assigned", "frequent"],
    "bad": ["errors", "hallucinated"], "numbered": ["level1"], "marks": ["numbered"], "stop": ["numbered", "marks"],
    "tree": ["heads", "langs"], "firsts": ["resp"], "cells": ["firsts"], "pm": ["cells"], "tm": ["cells"],
    "tot": ["cells"], "qcells": ["firsts"], "merge_answers": ["two"], "originals": ["merge_answers"],
    "cluster": ["vec"], "sims": ["cluster"], "vpairs": ["vec"], "packed": ["sized"], "batches": ["packed"],
    "plain_parts": ["ranked"], "plain": ["ranked"], "plain_marks": ["plain"], "labels_text": ["frequent"],
    "dnorm": ["dterm"], "flab": ["frequent"], "tlab": ["topics"], "fsim": ["flab", "dnorm"], "tsim": ["tlab", "dnorm"],
}


def with_tables(select: str, *names: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    body = ",\n".join(f"{n} AS ({CTE[n]})" for n in ordered)
    return f"WITH RECURSIVE {body}\n{select}" if ordered else select


SCORES = """
    SELECT round(sum(best * a) / (SELECT sum(n) FROM {c}), 6) AS harmonic_purity FROM (
        SELECT c.truth, any_value(t.a) AS a, max(2.0 * c.n / (t.a + p.b)) AS best FROM {c} c
        JOIN (SELECT truth, sum(n) AS a FROM {c} GROUP BY truth) t USING (truth)
        JOIN (SELECT pred, sum(n) AS b FROM {c} GROUP BY pred) p USING (pred) GROUP BY c.truth)"""
RAND = """
    SELECT round((joint - expected) / (0.5 * (sa + sb) - expected), 6) AS adjusted_rand FROM (
        SELECT (SELECT sum(n * (n - 1) / 2.0) FROM {c}) AS joint, sa, sb,
               sa * sb / (total * (total - 1) / 2.0) AS expected FROM (
            SELECT (SELECT sum(a * (a - 1) / 2.0) FROM (SELECT sum(n) AS a FROM {c} GROUP BY truth)) AS sa,
                   (SELECT sum(b * (b - 1) / 2.0) FROM (SELECT sum(n) AS b FROM {c} GROUP BY pred)) AS sb,
                   (SELECT sum(n)::DOUBLE FROM {c}) AS total))"""
MUTUAL = """
    SELECT round(mi / ((ha + hb) / 2), 6) AS normalized_mi FROM (
        SELECT (SELECT sum(c.n / total * ln(c.n * total / (t.a * p.b))) FROM {c} c
                  JOIN (SELECT truth, sum(n) AS a FROM {c} GROUP BY truth) t USING (truth)
                  JOIN (SELECT pred, sum(n) AS b FROM {c} GROUP BY pred) p USING (pred)) AS mi,
               (SELECT -sum(a / total * ln(a / total)) FROM (SELECT sum(n) AS a FROM {c} GROUP BY truth)) AS ha,
               (SELECT -sum(b / total * ln(b / total)) FROM (SELECT sum(n) AS b FROM {c} GROUP BY pred)) AS hb
        FROM (SELECT sum(n)::DOUBLE AS total FROM {c}))"""


def _prompt(template: str, **values: str) -> str:
    out = literal(template)
    for name, value in values.items():
        out = out.replace("{" + name + "}", f"' || {value} || '")
    return f"({out})"


ROOM = f"(300 - {tokens(literal(stub.ASSIGN_TEMPLATE))})"
CUT_DOC = cut("d.text", ROOM)
FIT_ROOM = f"((SELECT sum({tokens(chr(39) + '[1] ' + chr(39) + ' || name')}) FROM topics) + 600 - {tokens(literal(stub.GENERATION_TEMPLATE))})"

TREE_ROOM = "((SELECT sum(tok) FROM flab) // 2)"
CORRECT_ROOM = "((SELECT sum(tok) FROM flab) + 300)"
SUMMARY = "length(text) || ' characters, ' || (length(text) - length(replace(text, ' ', ''))) || ' blanks, last ' || right(text, 1)"

ORACLE: dict[str, str] = {
    # level 1
    "topic_counts": with_tables('SELECT name, n AS count, descr AS "desc" FROM topics', "topics"),
    "first_seen_desc": with_tables(
        """SELECT lower(name) AS key, doc_id AS doc_idx, line_idx, name, descr AS "desc" FROM level1
           QUALIFY row_number() OVER (PARTITION BY lower(name) ORDER BY doc_id, line_idx) = 1""", "level1"),
    "seed_aware_counts": with_tables(
        """, used AS (SELECT d.lang, lower(l.name) AS key, count(*) AS n FROM level1 l JOIN documents d USING (doc_id) GROUP BY 1, 2),
           seeds AS (SELECT lang, key, row_number() OVER (PARTITION BY key ORDER BY lang) AS nth FROM (
               SELECT lang, key FROM used QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, key) = 1))
           SELECT CASE WHEN s.key IS NULL THEN t.name ELSE upper(s.key) END AS name,
                  t.n + CASE WHEN s.key IS NULL THEN 0 ELSE 1 END AS count,
                  CASE WHEN s.key IS NULL THEN t.descr ELSE '' END AS "desc"
           FROM topics t LEFT JOIN (SELECT * FROM seeds WHERE nth = 1) s USING (key)
           UNION ALL SELECT upper(key), 1, '' FROM seeds WHERE nth > 1""", "topics").replace("\n, used", ",\nused"),
    "match_existing": with_tables(
        "SELECT l.doc_id AS doc_idx, l.line_idx, l.name, f.name AS node_name FROM level1 l LEFT JOIN frequent f ON lower(l.name) = f.key",
        "frequent"),
    "early_stop_position": with_tables("SELECT doc_id AS doc_idx, line_idx, g FROM stop", "stop"),
    "early_stop_kept_docs": with_tables(
        "SELECT doc_id AS doc_idx, responses FROM resp WHERE doc_id < coalesce((SELECT doc_id FROM stop), 1e18)", "stop"),
    "early_stop_counts": with_tables(
        """SELECT arg_min(name, g) AS name, count(*) AS count FROM numbered
           WHERE g <= coalesce((SELECT g FROM stop), 1e18) GROUP BY lower(name)""", "stop"),
    "stop_on_error_docs": with_tables(
        """SELECT doc_id AS doc_idx, CASE WHEN responses = 'Error' THEN 'error' ELSE 'ok' END AS status FROM resp
           WHERE doc_id <= coalesce((SELECT min(doc_id) FROM resp WHERE responses = 'Error'), 1e18)""", "resp"),
    "level1_rejects": with_tables(
        r"""SELECT doc_id AS doc_idx, line_idx, line FROM lines
            WHERE NOT regexp_matches(line, '^\[(\d+)\] ([\p{L}\p{N}_\s+#-]+):(.+)')""", "lines"),
    "level_gate": with_tables('SELECT doc_id AS doc_idx, line_idx, name, descr AS "desc" FROM level1', "level1"),
    # documents and topics
    "doc_topics": with_tables(
        """SELECT r.doc_id AS doc_idx, coalesce(string_agg(m.topic, '|' ORDER BY m.line_idx), 'None') AS topics
           FROM resp r LEFT JOIN mentions m USING (doc_id) GROUP BY r.doc_id""", "mentions"),
    "docs_with_topics": with_tables("SELECT DISTINCT doc_id AS doc_idx FROM mentions", "mentions"),
    "doc_frequency": with_tables("SELECT topic, count(DISTINCT doc_id) AS docs FROM mentions GROUP BY topic", "mentions"),
    "docs_for_topic": with_tables(
        """SELECT DISTINCT topic, doc_id AS doc_idx FROM mentions
           WHERE topic IN (SELECT '[1] ' || name FROM frequent WHERE n > 10)""", "mentions"),
    "expandable_topics": with_tables(
        "SELECT name, n AS count FROM frequent WHERE n > 0.005 * (SELECT count(DISTINCT doc_id) FROM mentions)", "mentions"),
    "cap_parents": with_tables(
        "SELECT name, n AS count FROM topics WHERE n > 0.005 * (SELECT count(*) FROM documents) ORDER BY ord LIMIT 10", "topics"),
    "expandable_leaves": with_tables(
        "SELECT path, name, n AS count FROM tree WHERE lvl = 2 AND n > 0.01 * (SELECT count(*) FROM documents)", "tree"),
    "remove_rare_topics": with_tables("SELECT name, n AS count FROM frequent", "frequent"),
    "level1_total": with_tables("SELECT sum(n) AS total FROM topics", "topics"),
    # trees
    "topic_labels": with_tables(
        """SELECT '[1] ' || name AS label, '[1] ' || name || ': ' || descr AS label_desc,
                  '[1] ' || name || ' (Count: ' || n || ')' AS label_count,
                  '[1] ' || name || ' (Count: ' || n || '): ' || descr AS label_count_desc FROM topics""", "topics"),
    "topic_list": with_tables(
        "SELECT row_number() OVER (ORDER BY ord) - 1 AS position, '[1] ' || name || ': ' || descr AS label FROM topics", "topics"),
    "preorder": with_tables(
        """SELECT row_number() OVER (ORDER BY head, born) - 1 AS position,
                  '[' || lvl || '] ' || name || ' (Count: ' || n || ')' AS label FROM tree""", "tree"),
    "topic_names": with_tables("SELECT DISTINCT name FROM tree", "tree"),
    "tree_view": with_tables("SELECT path, repeat(chr(9), lvl - 1) || '[' || lvl || '] ' || name AS line FROM tree", "tree"),
    "resolve_parents": with_tables(
        """, src AS (SELECT doc_id AS line, CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 3 ELSE 2 END AS lvl,
                            coalesce(w1, 'none') AS name, source FROM two),
           c1 AS (SELECT name, min(line) AS born, count(*) AS n, arg_min(source, line) AS d FROM src WHERE lvl = 1 GROUP BY name),
           l2 AS (SELECT s.*, (SELECT max(born) FROM c1 WHERE born < s.line) AS up FROM src s WHERE lvl = 2),
           c2 AS (SELECT up, name, min(line) AS born, count(*) AS n, arg_min(source, line) AS d FROM l2 WHERE up IS NOT NULL GROUP BY up, name),
           l3 AS (SELECT s.*, (SELECT max(born) FROM c2 WHERE born < s.line) AS up FROM src s WHERE lvl = 3),
           c3 AS (SELECT up, name, min(line) AS born, count(*) AS n, arg_min(source, line) AS d FROM l3 WHERE up IS NOT NULL GROUP BY up, name)
           SELECT born::VARCHAR AS path, 1 AS lvl, name, n AS count, d AS "desc" FROM c1
           UNION ALL SELECT up || '/' || born, 2, name, n, d FROM c2
           UNION ALL SELECT c2.up || '/' || c2.born || '/' || c3.born, 3, c3.name, c3.n, c3.d FROM c3 JOIN c2 ON c3.up = c2.born""",
        "two").replace("\n, src", ",\nsrc"),
    "topic_file_round_trip": with_tables(
        'SELECT lvl, name, n AS count, descr AS "desc", parent FROM tree WHERE descr <> \'\'', "tree"),
    "topic_file_rejects": with_tables(
        r"""SELECT starts_with(line, '[1]') AS valid, CASE WHEN starts_with(line, '[1]') THEN 1 END AS lvl,
                   CASE WHEN starts_with(line, '[1]') THEN 3 END AS count, count(*) AS lines,
                   count(DISTINCT CASE WHEN starts_with(line, '[1]') THEN regexp_extract(line, '^\[1\] ([^:]+):', 1) ELSE '' END) AS names
            FROM lines GROUP BY 1, 2, 3""", "lines"),
    "remove_topic": with_tables(
        """, gone AS (SELECT path FROM tree WHERE name = 'fr' AND lvl = 2 ORDER BY head, born LIMIT 1)
           SELECT path, name, n AS count FROM tree
           WHERE path NOT IN (SELECT path FROM gone) AND head NOT IN (SELECT head FROM heads WHERE source = 'src3')""",
        "tree").replace("\n, gone", ",\ngone"),
    "add_topic": with_tables(
        """, docs AS (SELECT source, CASE WHEN doc_id % 3 = 0 THEN 'late ' || lang ELSE lang END AS name FROM documents),
           added AS (SELECT h.head, d.name, count(*) AS n FROM docs d JOIN heads h USING (source) GROUP BY 1, 2)
           SELECT t.lvl, t.name, t.n + coalesce(a.n, 0) AS count, t.descr AS "desc", t.head FROM tree t
             LEFT JOIN added a ON t.lvl = 2 AND a.head = t.head AND a.name = t.name
           UNION ALL SELECT 2, a.name, a.n, 'added', a.head FROM added a
             WHERE NOT EXISTS (SELECT 1 FROM tree t WHERE t.lvl = 2 AND t.head = a.head AND t.name = a.name)""",
        "tree").replace("\n, docs", ",\ndocs"),
    "seed_tree": with_tables(
        "SELECT 1 AS lvl, name || ': ' || descr AS name, 1 AS count, '' AS \"desc\" FROM topics", "topics"),
    # tokens and prompts
    "token_counts": f"SELECT doc_id AS doc_idx, {tokens('text')} AS tokens FROM documents",
    "truncate_tokens": f"SELECT doc_id AS doc_idx, {cut('text', '200')} AS text FROM documents",
    "user_token_counter": r"SELECT doc_id AS doc_idx, len(regexp_split_to_array(trim(text), '[ \n]+')) AS tokens FROM documents",
    "prompt_sizes": with_tables(
        f"""SELECT doc_id AS doc_idx, {tokens('text')} AS doc_tokens,
               CASE WHEN {tokens('text')} + (SELECT sum({tokens("'[1] ' || name")}) FROM topics) <= {FIT_ROOM} THEN 'whole'
                    WHEN {tokens('text')} > {FIT_ROOM} - 500 THEN 'cut_document' ELSE 'prune_topics' END AS fit FROM documents""",
        "topics"),
    "generation_prompt": with_tables(
        f"""SELECT d.doc_id AS doc_idx, md5(p) AS prompt_md5, {tokens('p')} AS tokens FROM (SELECT doc_id,
               {_prompt(stub.GENERATION_TEMPLATE, Topics='bare', Document='text')} AS p FROM documents, labels_text) d""",
        "labels_text"),
    "generation_prompt_budget": with_tables(
        f"""SELECT doc_id AS doc_idx, fit, md5({_prompt(stub.GENERATION_TEMPLATE, Topics='shown', Document='doc')}) AS prompt_md5 FROM (
            SELECT d.doc_id, fit, CASE WHEN fit = 'cut_document' THEN {cut('d.text', f'({FIT_ROOM} - 500)')} ELSE d.text END AS doc,
                   CASE WHEN fit = 'prune_topics' THEN coalesce((SELECT string_agg(label || chr(10), '' ORDER BY rank) FROM tsim t
                            WHERE t.doc_id = d.doc_id AND upto <= left_over AND upto - tok < left_over), '')
                        ELSE (SELECT string_agg('[1] ' || name, chr(10) ORDER BY ord) FROM topics) END AS shown
            FROM (SELECT doc_id, text, {FIT_ROOM} - {tokens('text')} AS left_over,
                         CASE WHEN {tokens('text')} + (SELECT sum(tok) FROM tlab) <= {FIT_ROOM} THEN 'whole'
                              WHEN {tokens('text')} > {FIT_ROOM} - 500 THEN 'cut_document' ELSE 'prune_topics' END AS fit FROM documents) d)""",
        "tsim"),
    "assign_prompt_pruned": with_tables(
        f"""SELECT doc_id AS doc_idx, doc AS prompted_docs, md5({_prompt(stub.ASSIGN_TEMPLATE, tree='shown', Document='doc')}) AS prompt_md5 FROM (
            SELECT doc_id, shown, {cut('text', f"greatest({TREE_ROOM} - {tokens(literal(stub.ASSIGN_TEMPLATE))} - used, 0)")} AS doc FROM (
                SELECT d.doc_id, any_value(d.text) AS text, coalesce(string_agg(f.label || chr(10), '' ORDER BY f.rank), '') AS shown,
                       coalesce(sum(f.tok), 0) AS used
                FROM documents d LEFT JOIN fsim f ON f.doc_id = d.doc_id AND upto <= {TREE_ROOM} AND upto - tok < {TREE_ROOM}
                GROUP BY d.doc_id))""", "fsim"),
    "assign_prompt": with_tables(
        f"""SELECT doc_id AS doc_idx, doc AS prompted_docs, md5({_prompt(stub.ASSIGN_TEMPLATE, tree='whole', Document='doc')}) AS prompt_md5
            FROM (SELECT d.doc_id, {CUT_DOC} AS doc FROM documents d), labels_text""", "labels_text"),
    "pack_documents": with_tables("SELECT topic, batch_id, n_docs, n_tokens, md5(text) AS text_md5 FROM batches", "batches"),
    "subtopic_prompts": with_tables(
        f"""SELECT md5(text) AS text_md5, md5({_prompt(stub.SUBTOPIC_TEMPLATE, Topic='topic', Document='text')}) AS prompt_md5,
                   'ok' AS status FROM batches""", "batches"),
    # similarity
    "embedding_cosine": with_tables(
        "SELECT e.vec_id, round(list_cosine_similarity(e.v, c.v), 6) AS cosine FROM vec e JOIN cluster c USING (label)", "cluster"),
    "embed_documents": r"""
        SELECT doc_id AS doc_idx, ('0x' || left(md5(w), 4))::INTEGER % 256 AS dim, count(*)::DOUBLE AS weight
        FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM documents) GROUP BY 1, 2""",
    "similar_topics": with_tables(
        "SELECT vec_id, position, topic, round(s, 6) AS similarity FROM sims WHERE position < 3", "sims"),
    "budgeted_topics": with_tables(
        """SELECT vec_id, position, topic, round(s, 6) AS similarity FROM sims
           WHERE upto <= 20 + vec_id % 40 AND upto - tok < 20 + vec_id % 40""", "sims"),
    "half_context_topics": with_tables(
        "SELECT vec_id, position, topic, round(s, 6) AS similarity FROM sims WHERE upto <= 40 OR position < 5", "sims"),
    "topic_pairs": with_tables("SELECT i, j, round(score, 6) AS score FROM vpairs", "vpairs"),
    "unprompted_pairs": with_tables("SELECT i, j FROM vpairs WHERE (i + j) % 2 = 0", "vpairs"),
    "prompted_pairs": with_tables(
        """SELECT DISTINCT array_to_string(list_sort(['[1] Vector ' || i, '[1] Vector ' || j]), ' + ') AS pair
           FROM vpairs WHERE (i + j) % 2 = 1 OR i % 3 = 0""", "vpairs"),
    "top_pairs": with_tables(
        "SELECT i, j, round(score, 6) AS score FROM vpairs ORDER BY vpairs.score DESC, i, j LIMIT 2", "vpairs"),
    "refine_prompt": with_tables(
        f"""SELECT {_prompt(stub.REFINE_TEMPLATE, Topics='t')} AS prompt FROM (SELECT string_agg('[1] Vector ' || i || chr(10)
               || '[1] Vector ' || j, chr(10) ORDER BY score DESC, i, j) AS t
               FROM (SELECT * FROM vpairs ORDER BY score DESC, i, j LIMIT 2))""", "vpairs"),
    # merging
    "merge_lines": with_tables(
        """SELECT doc_id AS doc_idx, 0 AS line_idx, 1 AS lvl, a AS name, 'Texts on ' || w1 || ' and ' || w2 || '.' AS "desc",
                  '[1] ' || a || ', [1] ' || b AS originals FROM merge_answers""", "merge_answers"),
    "merge_originals": with_tables(
        "SELECT doc_id AS doc_idx, pos, new_name, old_name, 1 AS old_lvl FROM originals", "originals"),
    "merge_nodes": with_tables(
        "SELECT o.doc_id AS merge_id, o.pos, t.name, t.n AS count FROM originals o JOIN topics t ON lower(o.old_name) = t.key",
        "originals", "topics"),
    "merge_counts": with_tables(
        """SELECT o.doc_id AS merge_id, any_value(o.new_name) AS new_name, coalesce(sum(f.n), 0) AS count
           FROM originals o LEFT JOIN frequent f ON lower(o.old_name) = f.key GROUP BY o.doc_id""", "originals", "frequent"),
    "apply_merge": with_tables(
        f""", stems AS (SELECT left(key, 7) AS stem, sum(n) AS n FROM topics GROUP BY 1 HAVING count(*) > 1)
            SELECT name, n AS count, descr AS "desc" FROM topics WHERE left(key, 7) NOT IN (SELECT stem FROM stems)
            UNION ALL SELECT {capital('stem')}, n, 'Words on ' || stem FROM stems""", "topics").replace("\n, stems", ",\nstems"),
    "apply_merge_overlapping": with_tables(
        """, stems AS (SELECT left(key, 7) AS stem, sum(n) AS n, count(*) AS k FROM topics GROUP BY 1 HAVING count(*) > 1),
            others AS (SELECT * FROM topics WHERE left(key, 7) NOT IN (SELECT stem FROM stems))
            SELECT 1 AS lvl, name, n AS count, descr AS "desc" FROM others UNION ALL SELECT 2, 'Kid of ' || name, 1, 'kid' FROM others
            UNION ALL SELECT 1, 'Group ' || stem, n, 'Step ' || (k - 1) FROM stems""", "topics").replace("\n, stems", ",\nstems"),
    "merge_mapping": with_tables(
        """, e AS (SELECT DISTINCT old_name AS old FROM originals WHERE doc_id % 2 = 0),
           l AS (SELECT old_name AS old, arg_max(new_name, doc_id * 1048576 + pos) AS new FROM originals WHERE doc_id % 2 = 1 GROUP BY 1)
           SELECT coalesce(e.old, l.old) AS old, coalesce(l.new, 'Earlier') AS new, e.old IS NULL AS added
           FROM e FULL JOIN l ON e.old = l.old""", "originals").replace("\n, e AS", ",\ne AS"),
    "rewrite_topics": with_tables(
        """, m AS (SELECT list(struct_pack(o := source, n := 'origin ' || substr(source, 4)) ORDER BY head) AS l FROM heads)
           SELECT doc_id AS doc_idx, list_reduce(list_prepend(struct_pack(o := '', n := responses), l),
                  lambda acc, x: struct_pack(o := '', n := replace(acc.n, x.o, x.n))).n AS refined_responses FROM resp, m""",
        "resp", "heads").replace("\n, m AS", ",\nm AS"),
    "mapping_round_trip": with_tables(
        """SELECT min(doc_id * 1048576 + pos) + 2305843009213693952 AS seq, old_name AS old,
                  arg_max(new_name, doc_id * 1048576 + pos) AS new FROM originals GROUP BY old_name""", "originals"),
    "mapping_object_round_trip": with_tables(
        """SELECT row_number() OVER (ORDER BY min(doc_id * 1048576 + pos)) - 1 AS seq, old_name AS old,
                  arg_max(new_name, doc_id * 1048576 + pos) AS new FROM originals GROUP BY old_name""", "originals"),
    # subtopics
    "subtopic_lines": with_tables(
        """SELECT doc_id AS prompt_idx, 0 AS line_idx, 1 AS lvl, a AS name, '' AS documents, '' AS "desc", false AS adds FROM merge_answers
           UNION ALL SELECT doc_id, 1, 2, b, '1,3', 'Texts on ' || w2 || '.', true FROM merge_answers
           UNION ALL SELECT doc_id, 2, 2, 'Group ' || lang, '2', 'More in ' || lang || '.', true FROM merge_answers JOIN documents USING (doc_id)""",
        "merge_answers"),
    "subtopic_parent": with_tables(
        """, adds AS (SELECT f.name AS parent, m.doc_id * 4 + 1 AS born, m.b AS name, 'Texts on ' || m.w2 || '.' AS d
                      FROM merge_answers m JOIN frequent f ON f.key = m.w1
                      UNION ALL SELECT f.name, m.doc_id * 4 + 2, 'Group ' || d.lang, 'More in ' || d.lang || '.'
                      FROM merge_answers m JOIN frequent f ON f.key = m.w1 JOIN documents d USING (doc_id)),
           nodes AS (SELECT a.parent, a.name, f.ord, min(a.born) AS born FROM adds a JOIN frequent f ON f.name = a.parent GROUP BY 1, 2, 3),
           late AS (SELECT m.doc_id, d.lang, n.parent AS up, n.name AS parent FROM merge_answers m JOIN documents d USING (doc_id)
                    JOIN nodes n ON n.name = m.b AND n.born < m.doc_id * 4 + 1
                    WHERE m.w1 NOT IN (SELECT key FROM frequent)
                    QUALIFY row_number() OVER (PARTITION BY m.doc_id ORDER BY n.ord, n.born) = 1)
           SELECT '' AS parent, 1 AS lvl, name, n AS count, descr AS "desc" FROM frequent
           UNION ALL SELECT parent, 2, name, count(*), arg_min(d, born) FROM adds GROUP BY parent, name
           UNION ALL SELECT parent, 2, 'Group ' || lang, count(*), 'More in ' || lang || '.' FROM late GROUP BY up, parent, lang""",
        "merge_answers", "frequent").replace("\n, adds", ",\nadds"),
    "subtopic_chain": f"""
        WITH RECURSIVE named AS (SELECT doc_id, doc_id % {LINKS} AS link, 'Chain ' || doc_id // {LINKS} || ' link ' AS chain FROM documents),
        reached AS (SELECT * FROM named WHERE link = 0 UNION ALL
                    SELECT n.* FROM reached r JOIN named n ON n.doc_id = r.doc_id + 1 AND n.link > 0)
        SELECT '' AS parent, 1 AS lvl, 'Roots' AS name, 1::BIGINT AS count, 'of all chains' AS "desc"
        UNION ALL SELECT CASE WHEN link = 0 THEN 'Roots' ELSE chain || (link - 1) END, 2, chain || link, 1, 'part ' || link || '.' FROM reached""",
    # grounding
    "assigned_topics": with_tables(
        """SELECT r.doc_id AS doc_idx, coalesce(string_agg(a.topic, '|' ORDER BY a.line_idx), '') AS topics
           FROM resp r LEFT JOIN assigned a USING (doc_id) GROUP BY r.doc_id""", "assigned"),
    "grounding_errors": with_tables("SELECT doc_id AS doc_idx FROM errors", "errors"),
    "grounding_hallucinated": with_tables("SELECT doc_id AS doc_idx FROM hallucinated", "hallucinated"),
    "ungrounded_topics": with_tables(
        """SELECT topic, count(DISTINCT doc_id) AS docs FROM assigned WHERE topic NOT IN (SELECT name FROM frequent) GROUP BY topic""",
        "assigned", "frequent"),
    "grounding_report": with_tables(
        "SELECT (SELECT count(*) FROM errors) AS errors, (SELECT count(*) FROM hallucinated) AS hallucinated", "bad"),
    "reprompt_set": with_tables("SELECT doc_id AS doc_idx, reason FROM bad", "bad"),
    "apply_corrections": with_tables(
        """SELECT r.doc_id AS doc_idx, coalesce('[1] Repaired: was ' || b.reason, r.responses) AS responses
           FROM resp r LEFT JOIN bad b USING (doc_id)""", "bad"),
    "correct_until_grounded": with_tables(
        """SELECT r.doc_id AS doc_idx, CASE WHEN b.doc_id IS NULL THEN r.responses ELSE head || ': Reassigned.' END AS responses
           FROM resp r LEFT JOIN bad b USING (doc_id), labels_text""", "bad", "labels_text"),
    "correct_rounds": with_tables(
        """SELECT r.doc_id AS doc_idx, CASE WHEN b.doc_id IS NULL THEN r.responses WHEN length(d.text) % 5 = 0 THEN '[1] Second Matter: Again.'
                  ELSE head || ': Reassigned.' END AS responses
           FROM resp r JOIN documents d USING (doc_id) LEFT JOIN bad b USING (doc_id), labels_text""", "bad", "labels_text"),
    "correct_prompt": with_tables(
        f"""SELECT d.doc_id AS doc_idx, md5({_prompt(stub.CORRECT_TEMPLATE, tree='whole', Document='d.text',
            Message="'Previously, this document was assigned to: ' || r.responses || '. Please reassign it to an existing topic in the hierarchy.'")})
            AS prompt_md5 FROM bad JOIN documents d USING (doc_id) JOIN resp r USING (doc_id), labels_text""", "bad", "labels_text"),
    "correct_prompt_pruned": with_tables(
        f"""SELECT doc_id AS doc_idx, fits, md5({_prompt(stub.CORRECT_TEMPLATE, tree='shown', Document='doc',
            Message="'Previously, this document was assigned to: ' || responses || '. Please reassign it to an existing topic in the hierarchy.'")})
            AS prompt_md5 FROM (
            SELECT doc_id, responses, fits, CASE WHEN fits THEN whole ELSE part END AS shown,
                   CASE WHEN fits THEN text ELSE {cut('text', f"greatest({CORRECT_ROOM} - {tokens(literal(stub.CORRECT_TEMPLATE))} - used, 0)")} END AS doc
            FROM (SELECT d.doc_id, any_value(d.text) AS text, any_value(r.responses) AS responses, any_value(whole) AS whole,
                         any_value({tokens('d.text')}) + {tokens(literal(stub.CORRECT_TEMPLATE))} + (SELECT sum(tok) FROM flab) <= {CORRECT_ROOM} AS fits,
                         string_agg(f.label, chr(10) ORDER BY f.rank) AS part, sum(f.tok) AS used
                  FROM bad JOIN documents d USING (doc_id) JOIN resp r USING (doc_id) JOIN fsim f USING (doc_id), labels_text
                  WHERE upto <= {CORRECT_ROOM} // 2 OR rank <= 10 GROUP BY d.doc_id))""", "bad", "labels_text", "fsim"),
    # metrics
    "first_topic": with_tables("SELECT doc_id AS doc_idx, pred AS topic FROM firsts", "firsts"),
    "contingency": with_tables("SELECT truth, pred, n FROM cells", "cells"),
    "purity": with_tables(
        "SELECT round(sum(best) / (SELECT n FROM tot), 6) AS purity FROM (SELECT max(n) AS best FROM cells GROUP BY pred)", "tot"),
    "inverse_purity": with_tables(
        "SELECT round(sum(best) / (SELECT n FROM tot), 6) AS inverse_purity FROM (SELECT max(n) AS best FROM cells GROUP BY truth)", "tot"),
    "harmonic_purity": with_tables(SCORES.format(c="cells"), "cells"),
    "adjusted_rand": with_tables(RAND.format(c="cells"), "cells"),
    "normalized_mi": with_tables(MUTUAL.format(c="cells"), "cells"),
    "alignment_report": with_tables(
        f"SELECT * FROM ({SCORES.format(c='qcells')}), ({RAND.format(c='qcells')}), ({MUTUAL.format(c='qcells')})", "qcells"),
    # completion
    "assign_topics": with_tables(
        f"""SELECT doc_id AS doc_idx, labels[1 + length(doc) % len(labels)] AS responses, 'ok' AS status
            FROM (SELECT d.doc_id, {CUT_DOC} AS doc FROM documents d), labels_text""", "labels_text"),
    "complete_batches": with_tables(
        f"SELECT conv_id, turn, {SUMMARY} AS response, 'ok' AS status, 1 AS attempts, prompt_hash FROM turns", "turns"),
    "failed_calls": with_tables(
        """SELECT conv_id, turn, 'Error' AS response, 'ValueError: refused ' || length(text) || ' characters' AS error
           FROM turns WHERE length(text) % 7 = 0""", "turns"),
    "stage_usage": with_tables(
        f"""SELECT role AS stage, count(*) AS calls, sum(p) AS prompt_tokens, sum(r) AS response_tokens,
                   round((sum(p) * 5.0 + sum(r) * 15.0) / 1e6, 6) AS cost
            FROM (SELECT role, {tokens('text')} AS p, {tokens(SUMMARY)} AS r FROM turns) GROUP BY ROLLUP (role)""", "turns"),
    "replay_responses": with_tables(
        """, rec AS (SELECT u.prompt_hash, min(a.text) AS answer FROM turns u JOIN turns a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
                     GROUP BY 1)
           SELECT conv_id, turn, coalesce(answer, 'Error') AS response,
                  CASE WHEN answer IS NULL OR answer = 'Error' THEN 'error' ELSE 'ok' END AS status
           FROM turns LEFT JOIN rec USING (prompt_hash)""", "turns").replace("\n, rec", ",\nrec"),
    "usage_report": with_tables(
        f"""SELECT lang AS stage, count(*) AS calls, sum(p) AS prompt_tokens, sum(r) AS response_tokens,
                   round((sum(p) * 5.0 + sum(r) * 15.0) / 1e6, 6) AS cost
            FROM (SELECT resp.lang, {tokens('text')} AS p, {tokens('responses')} AS r FROM resp JOIN documents USING (doc_id))
            GROUP BY ROLLUP (lang)""", "resp"),
    "error_rows": with_tables("SELECT doc_id AS doc_idx, responses FROM resp WHERE responses = 'Error'", "resp"),
    # files
    "corpus_round_trip": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_idx, doc_id::VARCHAR AS id, text, lang AS label
                            FROM documents""",
    "sample_corpus": "SELECT doc_id AS doc_idx, lang FROM documents ORDER BY md5(doc_id || '-7'), doc_id LIMIT 100",
    # whole stages
    "generate_level1": with_tables(
        f"""SELECT {capital('w')} AS name, count(*) AS count, 'Documents about ' || w || '.' AS "desc" FROM plain GROUP BY w""", "plain"),
    "generate_level1_budget": f"""
        WITH sent AS (
            SELECT doc_id, CASE WHEN tok > room - 500 AND (tok > room OR doc_id >= low + {FIRST_ROUND}) THEN {cut('text', 'room - 500')} ELSE text END AS text
            FROM (SELECT doc_id, text, {tokens('text')} AS tok, min(doc_id) OVER () AS low, {SMALL_CONTEXT} - {tokens(literal(stub.GENERATION_TEMPLATE))} AS room FROM documents)),
        named AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}]{{6,}}')) AS w FROM sent),
        chosen AS (SELECT doc_id, w FROM (SELECT doc_id, w, count(*) AS n FROM named GROUP BY doc_id, w)
                   QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, w) <= 2)
        SELECT {capital('w')} AS name, count(*) AS count, 'Documents about ' || w || '.' AS "desc" FROM chosen GROUP BY w""",
    "refine_rounds": with_tables(
        f""", {_refined(2)} SELECT name, n AS count, descr AS "desc" FROM node2""", "topics").replace("\n, node0", ",\nnode0"),
    "generate_level1_docs": with_tables(
        f"""SELECT d.doc_id AS doc_idx, coalesce(string_agg(p.line, chr(10) ORDER BY p.rk), 'None') AS responses
            FROM documents d LEFT JOIN plain_parts p USING (doc_id)
            WHERE d.doc_id < coalesce((SELECT doc_id FROM plain WHERE g = (SELECT min(g + {PATIENCE} + 1) FROM plain_marks
                WHERE next_g IS NULL OR g + {PATIENCE} + 1 < next_g)), 1e18) GROUP BY d.doc_id""", "plain_marks", "plain_parts"),
    "generate_level2": with_tables(
        f""", spread AS (SELECT '[1] ' || name AS topic, name, n FROM topics
                         WHERE n > 0.005 * (SELECT count(DISTINCT l.doc_id) FROM lines l JOIN topics t
                             ON regexp_extract(l.line, '^\\[1\\] ([\\p{{L}}\\p{{N}}_\\s+#-]+):(.+)', 1) = t.name)),
            held AS (SELECT DISTINCT s.name, l.doc_id FROM lines l JOIN spread s
                     ON regexp_extract(l.line, '^\\[1\\] ([\\p{{L}}\\p{{N}}_\\s+#-]+):(.+)', 1) = s.name),
            room AS (SELECT {PACK_BUDGET + 10 - 5} - {tokens(literal(stub.SUBTOPIC_TEMPLATE))} AS r),
            hsized AS (SELECT name, row_number() OVER (PARTITION BY name ORDER BY doc_id) AS i,
                              least({tokens('text')}, r // 5) + 2 AS tok FROM held JOIN documents USING (doc_id), room),
            hpacked AS (SELECT name, i, 0::BIGINT AS b, tok AS fill FROM hsized WHERE i = 1 UNION ALL
                        SELECT s.name, s.i, CASE WHEN p.fill + s.tok >= r THEN p.b + 1 ELSE p.b END,
                               CASE WHEN p.fill + s.tok >= r THEN s.tok ELSE p.fill + s.tok END
                        FROM hpacked p JOIN hsized s ON s.name = p.name AND s.i = p.i + 1, room)
            SELECT 1 AS lvl, name, n AS count, descr AS "desc" FROM topics
            UNION ALL SELECT 2, name || ' Group', max(b) + 1, 'One prompt of ' || name || '.' FROM hpacked GROUP BY name""",
        "topics").replace("\n, spread", ",\nspread"),
}

# Sums are HUGEINT and bare numbers INTEGER in this dialect; the tables hold BIGINT.
for _name, _columns in {
    "level1_total": ["total"],
    "topic_file_rejects": ["count"],
    "seed_tree": ["count"],
    "pack_documents": ["n_tokens"],
    "merge_counts": ["count"],
    "apply_merge": ["count"],
    "apply_merge_overlapping": ["count"],
    "refine_rounds": ["count"],
    "usage_report": ["prompt_tokens", "response_tokens"],
    "stage_usage": ["prompt_tokens", "response_tokens"],
}.items():
    _casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _columns)
    ORACLE[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLE[_name]})"
