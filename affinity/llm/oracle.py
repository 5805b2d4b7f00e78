"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _merkle(levels: int = 6, fanout: int = 16) -> str:
    """The manifest by levels, enough for fanout ** levels rows a source and sources."""
    def part(value: str) -> str:
        return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([part("doc_id::VARCHAR"), part("source"), part("lang"), part("n_chars::VARCHAR"), part(text)]) + ")"

    # crc32 bit by bit: each byte is xored in, then eight shifts (-1)
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE
                WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""
    lower = _LOWER.format("text")
    sql = f"""WITH h AS (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf(lower)} AS lowered FROM documents),
        t0 AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                      row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM h),
        n0 AS (SELECT tree, place, leaf AS hash, count(*) OVER (PARTITION BY tree) AS size FROM t0)"""

    def climb(name: str, start: str) -> str:
        out = ""
        for k in range(levels):
            below = start if k == 0 else f"{name}{k}"
            # a tree of one node stays as it is
            out += f""",
        {name}{k + 1} AS (SELECT tree, place // {fanout} AS place, CASE WHEN size = 1 THEN any_value(hash)
                   ELSE sha256(string_agg(hash, '' ORDER BY place)) END AS hash, ceil(size / {fanout})::BIGINT AS size
            FROM {below} GROUP BY tree, place // {fanout}, size)"""
        return out

    sql += climb("n", "n0")
    sql += f""",
        m0 AS (SELECT 0 AS tree, tree AS place, hash, count(*) OVER () AS size FROM n{levels})"""
    sql += climb("m", "m0")
    # each leaf with what it finds, then level by level with its siblings
    sql += f""",
        c0 AS (SELECT doc_id, leaf, tree AS own, tree, place, '' AS proof, CASE WHEN {crc} % 5 = 0
                      THEN lowered ELSE leaf END AS folded FROM t0)"""
    count = 0
    for name in ("n", "m"):
        if name == "m":
            sql += f""",
        c{count + 1} AS (SELECT doc_id, leaf, own, 0 AS tree, own AS place, proof, folded FROM c{count})"""
            count += 1
        for k in range(levels):
            sql += f""",
        c{count + 1} AS (SELECT c.doc_id, c.leaf, c.own, c.tree, c.place // {fanout} AS place,
                   c.proof || coalesce(g.left_of, '') || coalesce(g.right_of, '') AS proof,
                   CASE WHEN g.size = 1 THEN c.folded ELSE sha256(g.left_of || c.folded || g.right_of) END AS folded
            FROM c{count} c JOIN (SELECT tree, place, size,
                   coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS left_of,
                   coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS right_of
                   FROM {name}{k} WINDOW w AS (PARTITION BY tree, place // {fanout} ORDER BY place)) g USING (tree, place))"""
            count += 1
    return sql + f"""
        SELECT c.doc_id, c.leaf, s.hash AS subroot, r.hash AS root, sha256(c.proof) AS proof_sha256,
               c.folded AS folded_root, c.folded = r.hash AS verified
        FROM c{count} c JOIN n{levels} s ON s.tree = c.own, m{levels} r"""


ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents),
        g AS (SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
                     count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op8_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
        k AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
        s AS (SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 20
              GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        m AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keep_id AS gone FROM k LEFT JOIN s USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op10_mixing": f"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
                          md5('mix-1:' || doc_id || ':' || md5(coalesce(text, ''))) AS place FROM documents),
        s0 AS (SELECT source, sum(size)::BIGINT AS source_size,
                      [1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
               FROM d GROUP BY source),
        s1 AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total, sum(w) OVER () AS w_all,
                      coalesce(sum(3 * source_size) OVER r, 0) AS cap_before, coalesce(sum(w) OVER r, 0) AS w_before
               FROM s0 WINDOW r AS (ORDER BY 3 * source_size * (6 // w), source NULLS LAST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        s2 AS (SELECT *, (total - cap_before)::DOUBLE / (w_all - w_before)::DOUBLE AS level FROM s1),
        lv AS (SELECT arg_min(level, cap_before) AS level FROM s2 WHERE w * level < cap),
        t AS (SELECT source, source_size,
                     CASE WHEN lv.level IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, w * lv.level) END AS target
              FROM s2, lv),
        p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
        j AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, target - whole * source_size AS more,
                     sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
              FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, source_size, target,
               (size * (whole + CASE WHEN upto - size / 2 < more THEN 1 ELSE 0 END))::BIGINT AS taken FROM j""",
    "op11_ranked_search": f"""
        WITH t AS (SELECT row_number() OVER () AS row, doc_id,
                          regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') AS terms FROM documents),
        s AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM t),
        p AS (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM t),
        f AS (SELECT row, doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
              FROM f, s GROUP BY term, n_docs),
        i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{_TERM}')) AS term FROM benchmark),
        r AS (SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (
                     100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
              FROM i JOIN w USING (term) JOIN f USING (term), s GROUP BY ALL),
        k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
                     doc_id, score FROM r WHERE score > 0)
        SELECT * FROM k WHERE rank <= 50""",
    "op12_merkle": _merkle(),
}
