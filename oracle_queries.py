"""The registered queries as SQL for the comparison engine, on the same tables."""

from __future__ import annotations

N_SHARDS = 20


def _lines(key: str = "doc_id", text: str = "text", table: str = "documents") -> str:
    """CTE lines(key, line_no, line); a final line end opens no line."""
    return f"""
    parts AS (
      SELECT {key} AS doc, regexp_split_to_array({text}, '\\r\\n|\\r|\\n') AS p FROM {table}
    ), kept AS (
      SELECT doc, CASE WHEN p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS p FROM parts
    ), lines AS (
      SELECT doc, CAST(generate_subscripts(p, 1) - 1 AS BIGINT) AS line_no, unnest(p) AS line FROM kept
    )"""


NAME = "CAST(doc_id AS VARCHAR) || '.txt'"


def _shard(name: str, shards: int = 2) -> str:
    return f"""CAST((list_reduce(list_prepend(CAST(0 AS BIGINT),
        list_transform(string_split({name}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda h, c: (h * 31 + c) % 4294967296) & 2147483647) % {shards} AS INTEGER)"""


SPLIT = "list_filter(regexp_split_to_array(line, '[ \\t\\n\\r\\f]+'), lambda x: x <> '')"

TOKENS = f"""{_lines(NAME)}, tokens AS (
      SELECT {_shard("doc")} AS shard, doc, line_no, {SPLIT} AS ids FROM lines
    ), vocab AS (
      SELECT shard, token, count(*) AS freq
      FROM (SELECT shard, unnest(ids) AS token FROM tokens) GROUP BY ALL HAVING count(*) >= 2
    ), vocab_all AS (
      SELECT token, count(*) AS freq
      FROM (SELECT unnest(ids) AS token FROM tokens) GROUP BY ALL HAVING count(*) >= 2
    )"""

SHARDS = f"""
    docs AS (
      SELECT doc_id, CAST(strlen(text) AS BIGINT) AS size, row_number() OVER (ORDER BY doc_id) AS rn
      FROM documents
    ), lim AS (
      SELECT CAST(sum(size) // {N_SHARDS} AS BIGINT) AS l FROM docs
    ), walk(rn, cur, grp, cnt, big, num, closed) AS (
      SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), 0, 0, false, 0, CAST(NULL AS INTEGER)
      UNION ALL
      SELECT d.rn,
        CASE WHEN d.size > l THEN 0 ELSE d.size END + CASE WHEN w.cur > l THEN 0 ELSE w.cur END,
        w.grp + CAST(w.cur > l AS INTEGER),
        w.cnt + CAST(w.cur > l AS INTEGER) + CAST(d.size > l AS INTEGER),
        d.size > l,
        w.cnt + CAST(w.cur > l AS INTEGER),
        CASE WHEN w.cur > l THEN w.cnt END
      FROM walk w JOIN docs d ON d.rn = w.rn + 1 CROSS JOIN lim
    ), sharded AS (
      SELECT d.doc_id, d.size, CAST(CASE WHEN w.big THEN w.num ELSE
        coalesce(c.closed, (SELECT max(cnt) FROM walk)) END AS BIGINT) AS shard
      FROM docs d JOIN walk w ON d.rn = w.rn
      LEFT JOIN (SELECT grp - 1 AS grp, closed FROM walk WHERE closed IS NOT NULL) c ON c.grp = w.grp
    )"""

DOUBLES = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"


def _closest(queries: str, candidates: str, out: str = "word, closest_word") -> str:
    """Each query's best candidate; both sides are SELECTs of (id, word, v)."""
    return f"""
    WITH q AS ({queries}), c AS ({candidates}), pairs AS (
      SELECT q.id, c.word AS cand, abs(list_cosine_similarity(q.v, c.v)) AS s
      FROM q JOIN c ON q.word <> c.word
      WHERE list_dot_product(q.v, q.v) > 0 AND list_dot_product(c.v, c.v) > 0
    ), best AS (
      SELECT id, min_by(cand, {{'s': -round(s, 9), 'w': cand}}) AS cand
      FROM pairs WHERE s > 0 AND NOT isnan(s) GROUP BY id
    ), result AS (
      SELECT q.word, coalesce(best.cand, '') AS closest_word FROM q LEFT JOIN best ON q.id = best.id
    ) SELECT {out} FROM result"""


def _vectors(word: str = "CAST(vec_id AS VARCHAR)", v: str = DOUBLES) -> str:
    return f"SELECT vec_id AS id, {word} AS word, {v} AS v FROM embeddings"


def _flat(columns: str, source: str = "embeddings", value: str = "x") -> str:
    return f"""
    SELECT {columns}, CAST(i AS BIGINT) AS i, round({value}, 6) AS value FROM (
      SELECT *, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS x
      FROM {source})"""


def oracle_sql() -> dict[str, str]:
    numbered = "row_number() OVER (PARTITION BY shard ORDER BY {}) - 1"
    vec_word = "CAST(vec_id AS VARCHAR)"
    self_join = _closest(_vectors(), _vectors())
    own_axis = "list_transform(embedding, lambda x, i: CASE WHEN i = label THEN CAST(x AS DOUBLE) ELSE 0 END)"
    signs = "list_transform(embedding, lambda x: CAST(sign(x) AS DOUBLE))"
    reverse = f"list_reverse({DOUBLES})"
    neighbours = f"""
      FROM (SELECT vec_id, {DOUBLES} AS v FROM embeddings) a
      JOIN (SELECT vec_id, {DOUBLES} AS v FROM embeddings) b ON b.vec_id = a.vec_id + 1"""
    return {
        "src_lines": f"""WITH {_lines()} SELECT doc, line_no, CAST(coalesce(sum(strlen(line) + 1)
            OVER (PARTITION BY doc ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS BIGINT) AS byte_offset, line FROM lines""",
        "src_list": """SELECT CAST(8 AS BIGINT) AS n_files, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes
            FROM documents""",
        "src_utf8": "SELECT doc_id, text FROM documents",
        "src_tokens": f"""WITH {TOKENS} SELECT shard, CAST(len(ids) AS BIGINT) AS n_tokens,
            array_to_string(ids, ' ') AS line FROM tokens WHERE len(ids) > 0""",
        "src_emb": _flat(
            "CASE WHEN label = 0 THEN ',' WHEN label = 1 THEN '' WHEN label = 2 THEN '),w' || vec_id "
            "WHEN label = 3 THEN '1,000' WHEN label = 4 THEN 'a,1' WHEN label = 5 THEN '12,' || vec_id "
            "ELSE 'w' || vec_id END AS word, vec_id + 1 AS freq"
        ),
        "src_shards": f"WITH {TOKENS} SELECT DISTINCT shard FROM tokens",
        "snk_shards": f"""WITH RECURSIVE {SHARDS}, {_lines()}
            SELECT shard, {numbered.format("doc DESC, line_no")} AS line_no, line
            FROM lines JOIN sharded ON doc = doc_id""",
        "snk_tokens": f"""WITH {TOKENS} SELECT shard, {numbered.format("doc, line_no")} AS line_no,
            array_to_string(ids, ' ') AS line FROM tokens WHERE len(ids) > 0""",
        "snk_emb": _flat(
            "CAST(pos AS BIGINT) AS pos, word, CAST(freq AS BIGINT) AS freq",
            f"""(SELECT {vec_word} AS word, label + 1 AS freq, embedding,
                row_number() OVER (ORDER BY {vec_word}) - 1 AS pos FROM embeddings)""",
        ),
        "snk_closest": _closest(
            _vectors(), _vectors(),
            "row_number() OVER (ORDER BY word) - 1 AS line_no, word || chr(9) || closest_word AS line",
        ),
        "snk_model": f"WITH {TOKENS} SELECT token, CAST(8 AS BIGINT) AS dim FROM vocab_all",
        "snk_guard": "SELECT count(*) AS n_rows, CAST(sum(doc_id) AS BIGINT) AS keys, true AS refused FROM documents",
        "prj_encode": f"WITH {_lines()} SELECT doc, line_no, line AS text FROM lines",
        "prj_decode": f"""WITH {_lines()} SELECT doc, line_no,
            regexp_replace(line, '[^\\x21-\\x7e]', '', 'g') AS visible FROM lines WHERE line <> ''""",
        "flt_empty": f"""WITH {_lines("page_id", "translate(html, '<>', chr(10) || chr(10))", "pages")}
            SELECT doc, line_no FROM lines WHERE len({SPLIT}) > 0""",
        "prj_ids2str": f"""WITH {TOKENS}, lens AS (
              SELECT doc, line_no, list_transform(ids, lambda x: length(x)) AS n FROM tokens)
            SELECT doc, line_no, array_to_string(n, ' ') AS ids_text,
              CAST(list_sum(n) AS BIGINT) AS total FROM lens WHERE len(n) > 0""",
        "prj_bundle": f"""SELECT {vec_word} AS word, CAST(label + 1 AS BIGINT) AS freq,
            CAST(len(embedding) AS BIGINT) AS dim, round(list_sum({DOUBLES}), 6) AS total FROM embeddings""",
        "flt_self": _closest(
            _vectors("CAST(label AS VARCHAR)"), _vectors("CAST(label AS VARCHAR)")
        ),
        "flt_pos": _closest(_vectors(v=own_axis), _vectors(v=own_axis)),
        "jon_closest": self_join,
        "jon_closest_blocks": self_join,
        "jon_lookup": _closest(
            _vectors(f"'q' || {vec_word}", reverse), _vectors()
        ),
        "agg_argmax": _closest(_vectors(v=signs), _vectors(v=signs)),
        "agg_vocab": f"WITH {TOKENS} SELECT shard, token, freq FROM vocab",
        "agg_mean": """SELECT CAST(label AS VARCHAR) AS word, CAST(i AS BIGINT) AS i, round(avg(x), 6) AS value
            FROM (SELECT label, generate_subscripts(embedding, 1) - 1 AS i,
                    CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY ALL""",
        "agg_freq": """SELECT CAST(label AS VARCHAR) AS word, CAST(sum(vec_id + 1) AS BIGINT) AS freq
            FROM embeddings GROUP BY label""",
        "agg_limit": f'SELECT CAST(sum(strlen(text)) // {N_SHARDS} AS BIGINT) AS shard_limit FROM documents',
        "agg_shard": f"WITH RECURSIVE {SHARDS} SELECT doc_id, shard FROM sharded",
        "ord_part": f"SELECT {NAME} AS doc, {_shard(NAME, 7)} AS shard FROM documents",
        "ord_comp": f"""WITH {TOKENS} SELECT shard, doc, line_no,
            {numbered.format("doc, line_no")} AS pos FROM tokens""",
        "ord_word": f"""SELECT row_number() OVER (ORDER BY {vec_word}) - 1 AS pos, {vec_word} AS word
            FROM embeddings""",
        "set_union": _flat(
            "shard, word",
            f"""(SELECT 0 AS shard, {vec_word} AS word, embedding FROM embeddings UNION ALL
                SELECT 1, CAST(label AS VARCHAR), embedding FROM embeddings)""",
        ),
        "fn_dot": f"""SELECT a.vec_id, round(list_dot_product(a.v, b.v), 6) AS dot {neighbours}""",
        "fn_cosine": f"""SELECT a.vec_id, round(abs(list_cosine_similarity(a.v, b.v)), 6) AS cosine
            {neighbours}""",
        "fn_misc": f"""SELECT CAST(n_chars AS BIGINT) AS byte_offset, source || '#' || {NAME} AS doc,
            true AS is_text FROM documents""",
        "ml_w2v": f"WITH {TOKENS} SELECT shard, token, freq, CAST(16 AS BIGINT) AS dim FROM vocab",
        "ml_export": f"""WITH {TOKENS} SELECT 0 AS shard, token, freq, CAST(8 AS BIGINT) AS dim, true AS finite
            FROM vocab_all""",
        "pipe_run": f"""WITH {_lines(NAME)} SELECT {_shard("doc")} AS shard, count(*) AS lines,
            CAST(sum(strlen(line)) AS BIGINT) AS bytes, true AS all_counted, true AS all_found,
            true AS closest_is_other, true AS closest_is_near FROM lines WHERE line <> '' GROUP BY ALL""",
        "pipe_shard": f"""WITH RECURSIVE {SHARDS} SELECT shard, count(*) AS n_docs,
            CAST(sum(size) AS BIGINT) AS bytes FROM sharded GROUP BY shard""",
        "pipe_stages": f"""WITH {TOKENS} SELECT token AS word, CAST(sum(freq) AS BIGINT) AS freq,
            true AS closest_is_other FROM vocab GROUP BY token""",
    }
