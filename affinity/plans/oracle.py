"""DuckDB SQL twins of the registered queries, over the fixture tables
(views region nation customer supplier part orders lineitem events documents
...).  Column names equal the Spark query's.  Hash coefficients are inlined
from the same generator the Spark side uses."""

from __future__ import annotations

from ..functions.hashing import hash_family
from ..params import DEFAULTS, MERSENNE_P, profile

P = DEFAULTS
K = P["k_values"][-1]
LSH_B, LSH_R = 50, 4
T = P["similarity_threshold"]
SUPPORT = 0.2
CONF = P["min_confidence"]

EPOCH = "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', {c})"

CTE = {
    "interactions": f"""
      SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, ceil(l.l_quantity / 5) / 2 AS rating,
             {EPOCH.format(c='o.o_orderdate')} AS ts
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "raw_base": f"""
      SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
             CASE WHEN l.l_linenumber <> 3 THEN ceil(l.l_quantity / 5) / 2 END AS rating,
             CASE WHEN l.l_linenumber <> 7 THEN {EPOCH.format(c='o.o_orderdate')} END AS ts,
             l.l_linenumber
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "raw_interactions": """
      SELECT user_id, item_id, rating, ts FROM raw_base
      UNION ALL SELECT user_id, item_id, rating, ts FROM raw_base WHERE l_linenumber = 2""",
    "clean": """
      SELECT user_id, item_id, rating, ts FROM interactions
      WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL AND ts IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, rating DESC) = 1""",
    "items": """
      SELECT p_partkey AS item_id, p_name AS title,
             concat_ws('|', p_type, string_split(p_name, ' ')[1], string_split(p_name, ' ')[2]) AS genres
      FROM part""",
    "items_var": """
      SELECT p_partkey AS item_id, p_name AS title,
             concat_ws('|',
               CASE WHEN p_size > 45 THEN lower(p_type) WHEN p_size < 5 THEN p_type || '-'
                    WHEN p_size BETWEEN 20 AND 22 THEN upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2))
                    ELSE p_type END,
               string_split(p_name, ' ')[1],
               CASE WHEN p_size = 33 THEN string_split(p_name, ' ')[2] || 's' ELSE string_split(p_name, ' ')[2] END
             ) AS genres
      FROM part""",
    "tags": f"""
      SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, event_type AS tag,
             {EPOCH.format(c='ts')} AS ts
      FROM events""",
    "bin_r": "SELECT *, CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS binary_rating FROM clean",
    "ua": "SELECT user_id, count(*) AS num_ratings FROM clean GROUP BY user_id",
    "ia": """
      SELECT c.item_id, count(*) AS num_ratings, round(avg(c.rating), 6) AS avg_rating, i.title
      FROM clean c JOIN items i ON c.item_id = i.item_id GROUP BY c.item_id, i.title""",
    "quality": """
      SELECT q.item_id, q.total_ratings, round(q.approval_pct, 6) AS approval_pct, i.title
      FROM (SELECT item_id, count(*) AS total_ratings, avg(binary_rating) * 100.0 AS approval_pct
            FROM bin_r GROUP BY item_id) q
      JOIN items i ON q.item_id = i.item_id""",
    "genres_x": "SELECT item_id, unnest(string_split(genres, '|')) AS genre FROM items",
    "supply": "SELECT genre, count(*) AS num_items FROM genres_x GROUP BY genre",
    "gact": """
      SELECT s.genre, s.num_items, d.num_ratings, round(d.s / d.num_ratings, 6) AS avg_rating
      FROM supply s JOIN (
        SELECT g.genre, CAST(sum(p.n) AS BIGINT) AS num_ratings, sum(p.s) AS s
        FROM (SELECT item_id, count(*) AS n, sum(rating) AS s FROM clean GROUP BY item_id) p
        JOIN genres_x g ON p.item_id = g.item_id GROUP BY g.genre) d ON s.genre = d.genre""",
    # category canonicalisation
    "pieces": "SELECT unnest(string_split(genres, '|')) AS raw FROM items_var",
    "raw_counts": "SELECT raw, count(*) AS n FROM pieces GROUP BY raw",
    "keyed": """
      SELECT raw, n,
        CASE WHEN raw IS NULL OR trim(raw) IN ('', '(no genres listed)') THEN 'unknown'
        ELSE array_to_string(list_transform(
               string_split(trim(regexp_replace(regexp_replace(lower(trim(raw)), '[!-/:-@\\[-`{-~]', '', 'g'), '\\s+', ' ', 'g')), ' '),
               lambda w: CASE WHEN length(w) > 3 THEN
                      regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                        w, 'sses$', 'ss'), 'ies$', 'i'), '([^su])s$', '\\1'), 'y$', 'i'), '([a-z]{3})e$', '\\1')
                    ELSE w END), ' ')
        END AS key
      FROM raw_counts""",
    "cmap": """
      SELECT raw, key, first_value(raw) OVER (PARTITION BY key ORDER BY n DESC, raw ASC) AS canonical, n
      FROM keyed""",
    "normalized": """
      SELECT item_id, title, array_to_string(list_sort(list_distinct(list(v))), '|') AS genres
      FROM (SELECT x.item_id, x.title, coalesce(m.canonical, x.piece) AS v
            FROM (SELECT item_id, title, trim(unnest(string_split(genres, '|'))) AS piece FROM items_var
                  WHERE genres IS NOT NULL AND trim(genres) <> '') x
            LEFT JOIN (SELECT DISTINCT trim(raw) AS piece, canonical FROM cmap) m ON x.piece = m.piece)
      GROUP BY item_id, title
      UNION ALL SELECT item_id, title, genres FROM items_var WHERE genres IS NULL OR trim(genres) = ''""",
    # sets
    "liked_m": """SELECT DISTINCT item_id AS entity, user_id AS element FROM interactions
                  WHERE rating >= 3.5 AND item_id IS NOT NULL AND user_id IS NOT NULL""",
    "doc_m": """
      SELECT DISTINCT doc_id AS entity,
             CAST(('0x' || substr(md5(array_to_string(ws[i:i + 2], ' ')), 1, 15)) AS BIGINT) AS element
      FROM (SELECT doc_id, string_split(lower(text), ' ') AS ws FROM documents) d,
           range(1, CAST(len(ws) - 1 AS BIGINT)) t(i)""",
    "item_sizes": "SELECT entity, count(*) AS set_size FROM liked_m GROUP BY entity",
    "hf": "VALUES " + ", ".join(f"({h}, {a}, {b})" for h, (a, b) in enumerate(hash_family(K, P["hash_seed"]))),
}


def _jaccard_ctes(m: str, prefix: str, min_j: float = 0.0) -> dict[str, str]:
    where = f"WHERE inter / (s1.n + s2.n - inter) >= {min_j}" if min_j > 0 else ""
    return {
        f"{prefix}_sz": f"SELECT entity, count(*) AS n FROM {m} GROUP BY entity",
        f"{prefix}_ov": f"""SELECT a.entity AS id1, b.entity AS id2, count(*) AS inter
                            FROM {m} a JOIN {m} b ON a.element = b.element AND a.entity < b.entity
                            GROUP BY 1, 2""",
        f"{prefix}_jp": f"""SELECT id1, id2, inter, s1.n + s2.n - inter AS "union",
                                   inter / (s1.n + s2.n - inter) AS jaccard
                            FROM {prefix}_ov JOIN {prefix}_sz s1 ON s1.entity = id1
                            JOIN {prefix}_sz s2 ON s2.entity = id2 {where}""",
        f"{prefix}_sig": f"""SELECT m.entity, hf.col0 AS h,
                                    min((hf.col1 * (m.element % {MERSENNE_P}) + hf.col2) % {MERSENNE_P}) AS v
                             FROM {m} m, hf GROUP BY 1, 2""",
    }


CTE.update(_jaccard_ctes("liked_m", "it"))
CTE.update(_jaccard_ctes("doc_m", "dc", T))
CTE["it_est"] = f"""
  SELECT j.id1, j.id2, j.jaccard, count(*) FILTER (WHERE s1.v = s2.v) / {K} AS estimate
  FROM it_jp j JOIN it_sig s1 ON s1.entity = j.id1 JOIN it_sig s2 ON s2.entity = j.id2 AND s2.h = s1.h
  GROUP BY j.id1, j.id2, j.jaccard"""
CTE["it_n"] = "SELECT count(DISTINCT entity) AS n FROM liked_m"
CTE["dc_n"] = "SELECT count(DISTINCT entity) AS n FROM doc_m"
CTE["dc_bands"] = f"""
  SELECT entity, h // {LSH_R} AS band, array_to_string(list(v ORDER BY h), ',') AS vals
  FROM dc_sig WHERE h < {LSH_B * LSH_R} GROUP BY entity, h // {LSH_R}"""
CTE["dc_cand"] = """
  SELECT DISTINCT a.entity AS id1, b.entity AS id2
  FROM dc_bands a JOIN dc_bands b ON a.band = b.band AND a.vals = b.vals AND a.entity < b.entity"""
CTE["dc_pred"] = f"""
  SELECT c.id1, c.id2, count(*) FILTER (WHERE s1.v = s2.v) / {K} AS estimate
  FROM dc_cand c JOIN dc_sig s1 ON s1.entity = c.id1 JOIN dc_sig s2 ON s2.entity = c.id2 AND s2.h = s1.h
  GROUP BY c.id1, c.id2 HAVING count(*) FILTER (WHERE s1.v = s2.v) / {K} >= {T}"""
CTE["cfg"] = "VALUES " + ", ".join(f"({i}, {b}, {r})" for i, (b, r) in enumerate(P["lsh_configs"])
                                   if b * r == K)
CTE["sw_bands"] = """
  SELECT cfg.col0 AS pos, cfg.col1 AS b, cfg.col2 AS r, s.entity, s.h // cfg.col2 AS band,
         array_to_string(list(s.v ORDER BY s.h), ',') AS vals
  FROM dc_sig s, cfg WHERE s.h < cfg.col1 * cfg.col2 GROUP BY 1, 2, 3, 4, 5"""
CTE["sw_cand"] = """
  SELECT DISTINCT a.pos, a.b, a.r, a.entity AS id1, b.entity AS id2
  FROM sw_bands a JOIN sw_bands b ON a.pos = b.pos AND a.band = b.band AND a.vals = b.vals AND a.entity < b.entity"""

SWEEP = """
  SELECT c.col0 AS pos, c.col1 AS b, c.col2 AS r,
         round(pow(1.0 / c.col1, 1.0 / c.col2), 6) AS threshold,
         coalesce(x.candidates, 0) AS candidates, coalesce(x.tp, 0) AS tp,
         coalesce(x.candidates, 0) - coalesce(x.tp, 0) AS fp,
         (SELECT count(*) FROM {truth}) - coalesce(x.tp, 0) AS fn,
         round(CASE WHEN coalesce(x.candidates, 0) > 0 THEN x.tp / x.candidates ELSE 0 END, 6) AS precision,
         round(CASE WHEN (SELECT count(*) FROM {truth}) > 0 THEN coalesce(x.tp, 0) / (SELECT count(*) FROM {truth}) ELSE 0 END, 6) AS recall,
         round(CASE WHEN coalesce(x.tp, 0) > 0 THEN
               2.0 * (x.tp / x.candidates) * (x.tp / (SELECT count(*) FROM {truth}))
               / ((x.tp / x.candidates) + (x.tp / (SELECT count(*) FROM {truth}))) ELSE 0 END, 6) AS f1,
         round(100.0 * coalesce(x.candidates, 0) / ((SELECT n FROM dc_n) * ((SELECT n FROM dc_n) - 1) / 2), 6) AS candidate_pct
  FROM {cfg} c LEFT JOIN (
    SELECT s.pos, count(*) AS candidates, count(t.id1) AS tp
    FROM {cand} s LEFT JOIN {truth} t ON s.id1 = t.id1 AND s.id2 = t.id2 GROUP BY s.pos) x ON x.pos = c.col0"""
CTE["sweep"] = SWEEP.format(truth="dc_jp", cfg="cfg", cand="sw_cand")


def _sweep_sql(name: str) -> str:
    """The sweep of a named profile over the documents' sets."""
    p = profile(name)
    k, configs = p["k_values"][-1], p["lsh_configs"]
    family = ", ".join(f"({h}, {a}, {b})" for h, (a, b) in enumerate(hash_family(k, p["hash_seed"])))
    return f"""
      WITH p_hf AS (VALUES {family}),
      p_cfg AS (VALUES {", ".join(f"({i}, {b}, {r})" for i, (b, r) in enumerate(configs) if b * r == k)}),
      p_jp AS (SELECT * FROM dc_jp WHERE jaccard >= {p["similarity_threshold"]}),
      p_sig AS (SELECT m.entity, h.col0 AS h, min((h.col1 * (m.element % {MERSENNE_P}) + h.col2) % {MERSENNE_P}) AS v
                FROM doc_m m, p_hf h GROUP BY 1, 2),
      p_bands AS (SELECT c.col0 AS pos, c.col1 AS b, c.col2 AS r, s.entity, s.h // c.col2 AS band,
                         array_to_string(list(s.v ORDER BY s.h), ',') AS vals
                  FROM p_sig s, p_cfg c GROUP BY 1, 2, 3, 4, 5),
      p_cand AS (SELECT DISTINCT a.pos, a.b, a.r, a.entity AS id1, b.entity AS id2 FROM p_bands a JOIN p_bands b
                 ON a.pos = b.pos AND a.band = b.band AND a.vals = b.vals AND a.entity < b.entity)
      {SWEEP.format(truth="p_jp", cfg="p_cfg", cand="p_cand")}"""


# baskets and rules (customer x brand, min support 0.2)
CTE["bi"] = """SELECT DISTINCT i.user_id AS basket_id, p.p_brand AS item
               FROM interactions i JOIN part p ON i.item_id = p.p_partkey WHERE i.rating >= 3.5"""
CTE["ob"] = "SELECT DISTINCT l.l_orderkey AS basket_id, p.p_brand AS item FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"


def _itemset_ctes(prefix: str, items: str, support: float) -> dict[str, str]:
    """Baskets of two items or more; their itemsets of any depth: rows of a
    basket and an itemset in it grow by one later item at a time, as long as
    enough baskets hold the longer itemset."""
    least = f"ceil({support} * (SELECT n FROM {prefix}_nb))"
    return {
        f"{prefix}_bs": f"SELECT basket_id, count(*) AS n_items FROM {items} GROUP BY basket_id HAVING count(*) >= {P['basket_min']}",
        f"{prefix}_bk": f"SELECT x.basket_id, x.item FROM {items} x JOIN {prefix}_bs USING (basket_id)",
        f"{prefix}_nb": f"SELECT count(*) AS n FROM {prefix}_bs",
        f"{prefix}_rows": f"""
          SELECT 1 AS size, [item] AS items, basket_id FROM (
            SELECT *, count(*) OVER (PARTITION BY item) AS c FROM {prefix}_bk) WHERE c >= {least}
          UNION ALL
          SELECT size, items, basket_id FROM (
            SELECT r.size + 1 AS size, list_append(r.items, k.item) AS items, r.basket_id,
                   count(*) OVER (PARTITION BY list_append(r.items, k.item)) AS c
            FROM {prefix}_rows r JOIN {prefix}_bk k ON k.basket_id = r.basket_id AND k.item > r.items[-1]) WHERE c >= {least}""",
        f"{prefix}_is": f"SELECT items, size, count(*) AS freq FROM {prefix}_rows GROUP BY items, size",
    }


CTE.update(_itemset_ctes("ub", "bi", SUPPORT))
CTE.update(_itemset_ctes("od", "ob", P["min_support"]))
CTE["bk"] = "SELECT basket_id, item FROM ub_bk"
CTE["strat_all"] = """SELECT i.item_id, string_split(i.genres, '|')[1] AS stratum, a.num_ratings
                    FROM ia a JOIN items i ON i.item_id = a.item_id"""
CTE["strat"] = f"""SELECT * FROM strat_all QUALIFY row_number() OVER (
                 PARTITION BY stratum ORDER BY md5('{P['sample_seed']}:' || item_id), item_id) <= {P['top_k']}"""
CTE["rules"] = f"""
  SELECT array_to_string(a.items, '|') AS antecedent, c.item AS consequent, f.freq / a.freq AS confidence,
         (f.freq / a.freq) / (k.freq / (SELECT n FROM ub_nb)) AS lift, f.freq / (SELECT n FROM ub_nb) AS support,
         k.freq / (SELECT n FROM ub_nb) AS consequent_support
  FROM (SELECT items, freq, unnest(items) AS item FROM ub_is WHERE size > 1) f
  JOIN ub_is a ON a.items = list_filter(f.items, lambda x: x <> f.item)
  JOIN ub_is k ON k.items = [f.item], LATERAL (SELECT f.item AS item) c
  WHERE f.freq / a.freq >= {CONF}"""
CTE["relevant"] = f"""SELECT * FROM rules WHERE confidence >= {P['relevant_confidence']}
                      AND lift > {P['relevant_lift']}"""

R6 = "round({0}, 6) AS {0}"
RULE_COLS = ("antecedent, consequent, round(confidence, 6) AS confidence, round(lift, 6) AS lift, "
             "round(support, 6) AS support")


def _describe(src: str, col: str) -> str:
    return f"""
      SELECT count(*) AS n, round(avg({col}), 6) AS mean, round(stddev_samp({col}), 6) AS stddev,
             min({col}) AS min, max({col}) AS max,
             (SELECT {col} FROM (SELECT {col}, row_number() OVER (ORDER BY {col}) AS rn FROM {src})
              WHERE rn = (SELECT greatest(1, CAST(ceil(0.5 * count(*)) AS BIGINT)) FROM {src})) AS median
      FROM {src}"""


def _quantile(src: str, col: str, q: float) -> str:
    return f"""(SELECT {col} FROM (SELECT {col}, row_number() OVER (ORDER BY {col}) AS rn FROM {src})
               WHERE rn = (SELECT greatest(1, CAST(ceil({q} * count(*)) AS BIGINT)) FROM {src}))"""


def _hist(src: str, col: str, bins: int) -> str:
    lo = f"(SELECT min({col}) FROM {src})"
    hi = f"(SELECT max({col}) FROM {src})"
    idx = (f"CAST(CASE WHEN {hi} = {lo} THEN 0 ELSE least(floor((CAST({col} AS DOUBLE) - {lo}) / ({hi} - {lo}) * {bins}), {bins - 1}) END AS INTEGER)")
    return f"""
      SELECT CAST(b.range AS INTEGER) AS bin,
             round({lo} + b.range * (({hi} - {lo}) / {bins}), 6) AS lo,
             round({lo} + (b.range + 1) * (({hi} - {lo}) / {bins}), 6) AS hi,
             coalesce(c.count, 0) AS count
      FROM range({bins}) b LEFT JOIN (
        SELECT {idx} AS bin, count(*) AS count FROM {src} WHERE {col} IS NOT NULL GROUP BY 1
      ) c ON c.bin = b.range"""


def _loghist(src: str, col: str, edges: int, lo: str, hi: str) -> str:
    nb = edges - 1
    llo = f"log10(greatest(1.0, CAST({lo} AS DOUBLE)))"
    lhi = f"log10(CAST({hi} AS DOUBLE))"
    x = f"CAST({col} AS DOUBLE)"
    idx = f"CAST(CASE WHEN {lhi} = {llo} THEN 0 ELSE least(floor((log10({x}) - {llo}) / ({lhi} - {llo}) * {nb}), {nb - 1}) END AS INTEGER)"
    return f"""
      SELECT bin, round(pow(10.0, {llo} + bin * (({lhi} - {llo}) / {nb})), 6) AS lo,
             round(pow(10.0, {llo} + (bin + 1) * (({lhi} - {llo}) / {nb})), 6) AS hi,
             count, round(count / sum(count) OVER (), 6) AS proportion
      FROM (SELECT {idx} AS bin, count(*) AS count FROM {src}
            WHERE {x} >= greatest(1.0, CAST({lo} AS DOUBLE)) AND {x} <= CAST({hi} AS DOUBLE) GROUP BY 1)"""


SA, SB = hash_family(1, P["sample_seed"])[0]
SAMPLE_PRED = f"(({SA} * entity + {SB}) % {MERSENNE_P}) < {int(P['sample_fraction'] * MERSENNE_P)}"

BODY = {
    "scan_interactions": "SELECT * FROM interactions",
    "scan_items": "SELECT * FROM items",
    "scan_tags": "SELECT * FROM tags",
    "preview": "SELECT * FROM interactions ORDER BY user_id, item_id, ts, rating LIMIT 20",
    "null_counts": """SELECT count(*) FILTER (WHERE user_id IS NULL) AS user_id,
                             count(*) FILTER (WHERE item_id IS NULL) AS item_id,
                             count(*) FILTER (WHERE rating IS NULL) AS rating,
                             count(*) FILTER (WHERE ts IS NULL) AS ts FROM raw_interactions""",
    "drop_nulls": """SELECT * FROM raw_interactions WHERE user_id IS NOT NULL AND item_id IS NOT NULL
                     AND rating IS NOT NULL AND ts IS NOT NULL""",
    "dedupe_keys": "SELECT * FROM clean",
    "dedupe_rows": "SELECT DISTINCT * FROM raw_interactions",
    "clean_report": """
      WITH nn AS (SELECT * FROM raw_interactions WHERE user_id IS NOT NULL AND item_id IS NOT NULL
                  AND rating IS NOT NULL AND ts IS NOT NULL),
           c AS (SELECT (SELECT count(*) FROM raw_interactions) AS n0, (SELECT count(*) FROM nn) AS n1,
                        (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM nn)) AS n2)
      SELECT 'nulls' AS step, n0 AS rows_before, n1 AS rows_after, n0 - n1 AS removed FROM c
      UNION ALL SELECT 'duplicates', n1, n2, n1 - n2 FROM c""",
    "binarize": "SELECT * FROM bin_r",
    "binary_distribution": """SELECT binary_rating, count(*) AS count,
                                     round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct
                              FROM bin_r GROUP BY binary_rating""",
    "like_summary": """
      SELECT total, likes, dislikes, round(lp, 6) AS like_pct, round(dp, 6) AS dislike_pct,
             printf('%d (%.2f%%)', likes, round(lp, 2)) AS likes_label,
             printf('%d (%.2f%%)', dislikes, round(dp, 2)) AS dislikes_label
      FROM (SELECT total, likes, total - likes AS dislikes,
                   CASE WHEN total > 0 THEN 100.0 * likes / total ELSE 0 END AS lp,
                   CASE WHEN total > 0 THEN 100.0 * (total - likes) / total ELSE 0 END AS dp
            FROM (SELECT count(*) AS total, CAST(coalesce(sum(binary_rating), 0) AS BIGINT) AS likes FROM bin_r))""",
    "liked": "SELECT * FROM clean WHERE rating >= 3.5",
    "explode_genres": "SELECT item_id, genre FROM genres_x",
    "canonical_map": "SELECT * FROM cmap",
    "normalize_genres": "SELECT * FROM normalized",
    "genre_report": """
      SELECT b AS distinct_before, a AS distinct_after,
             round(CASE WHEN b > 0 THEN (1.0 - a / b) * 100.0 ELSE 0 END, 6) AS reduction_pct
      FROM (SELECT (SELECT count(DISTINCT p) FROM (SELECT unnest(string_split(genres, '|')) AS p FROM items_var)) AS b,
                   (SELECT count(DISTINCT p) FROM (SELECT unnest(string_split(genres, '|')) AS p FROM normalized)) AS a)""",
    "contains_filter": "SELECT * FROM normalized WHERE contains(genres, 'ring') OR contains(genres, 'Ring')",
    "genre_niches": f"""SELECT *, round(num_items * {P['niche_bubble_scale']}, 6) AS bubble_size FROM gact
                        WHERE genre <> '(no genres listed)' AND num_ratings >= {P['niche_min_ratings']}""",
    "user_activity": "SELECT * FROM ua",
    "item_activity": "SELECT * FROM ia",
    "user_activity_stats": _describe("ua", "num_ratings"),
    "item_activity_stats": _describe("ia", "num_ratings"),
    "rating_stats": f"""
      SELECT count(*) AS n, round(avg(rating), 6) AS mean, round(stddev_samp(rating), 6) AS stddev,
             min(rating) AS min, max(rating) AS max, {_quantile('clean', 'rating', 0.25)} AS q1,
             {_quantile('clean', 'rating', 0.5)} AS median, {_quantile('clean', 'rating', 0.75)} AS q3
      FROM clean""",
    "rating_distribution": """
      SELECT rating, count, round(100.0 * count / sum(count) OVER (), 6) AS pct,
             CAST(sum(count) OVER (ORDER BY rating ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_count,
             round(100.0 * sum(count) OVER (ORDER BY rating ROWS UNBOUNDED PRECEDING) / sum(count) OVER (), 6) AS cum_pct
      FROM (SELECT rating, count(*) AS count FROM clean GROUP BY rating)""",
    "item_quality": "SELECT * FROM quality",
    "item_quality_min50": f"SELECT * FROM quality WHERE total_ratings >= {P['quality_min_ratings']}",
    "genre_supply": "SELECT * FROM supply",
    "genre_activity": "SELECT * FROM gact",
    "sparsity": """
      SELECT num_users, num_items, num_ratings, num_users * num_items AS possible,
             round(100.0 * num_ratings / (num_users * num_items), 6) AS density_pct,
             round(100.0 - 100.0 * num_ratings / (num_users * num_items), 6) AS sparsity_pct,
             round(num_ratings / num_users, 6) AS mean_per_user, round(num_ratings / num_items, 6) AS mean_per_item
      FROM (SELECT count(DISTINCT user_id) AS num_users, count(DISTINCT item_id) AS num_items,
                   count(*) AS num_ratings FROM clean)""",
    "item_counts_topk": f"""SELECT item_id, count(*) AS num_ratings FROM clean GROUP BY item_id
                            ORDER BY num_ratings DESC, item_id LIMIT {P['top_k']}""",
    "pareto_curve": """
      SELECT num_ratings, n_users, re - n_users + 1 AS rank_start, re AS rank_end, cum AS cum_activity,
             round(100.0 * re / sum(n_users) OVER (), 6) AS users_pct,
             round(100.0 * cum / sum(mass) OVER (), 6) AS cum_pct
      FROM (SELECT num_ratings, n_users, mass,
                   CAST(sum(n_users) OVER (ORDER BY num_ratings DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS re,
                   CAST(sum(mass) OVER (ORDER BY num_ratings DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
            FROM (SELECT num_ratings, count(*) AS n_users, num_ratings * count(*) AS mass FROM ua GROUP BY num_ratings))""",
    "pareto_top20": f"""
      WITH curve AS (
        SELECT num_ratings, n_users, re - n_users + 1 AS rank_start, re AS rank_end, cum
        FROM (SELECT num_ratings, n_users,
                     sum(n_users) OVER (ORDER BY num_ratings DESC ROWS UNBOUNDED PRECEDING) AS re,
                     sum(mass) OVER (ORDER BY num_ratings DESC ROWS UNBOUNDED PRECEDING) AS cum
              FROM (SELECT num_ratings, count(*) AS n_users, num_ratings * count(*) AS mass FROM ua GROUP BY num_ratings))),
      s AS (SELECT max(rank_end) AS n, max(cum) AS total FROM curve),
      r AS (SELECT n, total, least(n - 1, CAST(floor(n * {P['pareto_share']}) AS BIGINT)) + 1 AS r FROM s)
      SELECT CAST(r.n AS BIGINT) AS n_users, CAST(r.r AS BIGINT) AS top_users,
             round(100.0 * (c.cum - (c.rank_end - r.r) * c.num_ratings) / r.total, 6) AS top_share_pct
      FROM curve c, r WHERE c.rank_start <= r.r AND r.r <= c.rank_end""",
    "histogram": _hist("ua", "num_ratings", P["histogram_bins"]),
    "log_histogram": _loghist("item_sizes", "set_size", P["log_bins"],
                              "(SELECT min(set_size) FROM item_sizes)", "(SELECT max(set_size) FROM item_sizes)"),
    "sample_fidelity": f"""
      WITH smp AS (SELECT * FROM item_sizes WHERE {SAMPLE_PRED}),
      f AS ({_loghist('item_sizes', 'set_size', P['log_bins'], '(SELECT min(set_size) FROM item_sizes)', '(SELECT max(set_size) FROM item_sizes)')}),
      s AS ({_loghist('smp', 'set_size', P['log_bins'], '(SELECT min(set_size) FROM item_sizes)', '(SELECT max(set_size) FROM item_sizes)')})
      SELECT coalesce(f.bin, s.bin) AS bin, coalesce(f.proportion, 0.0) AS full_prop,
             coalesce(s.proportion, 0.0) AS sample_prop,
             round(abs(coalesce(f.proportion, 0.0) - coalesce(s.proportion, 0.0)), 6) AS abs_diff
      FROM f FULL OUTER JOIN s ON f.bin = s.bin""",
    "boxplot_stats": f"""
      WITH q AS (SELECT {_quantile('ua', 'num_ratings', 0.25)} AS q1, {_quantile('ua', 'num_ratings', 0.5)} AS median,
                        {_quantile('ua', 'num_ratings', 0.75)} AS q3)
      SELECT q1, median, q3, q3 - q1 AS iqr,
             (SELECT min(num_ratings) FROM ua WHERE num_ratings >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
             (SELECT max(num_ratings) FROM ua WHERE num_ratings <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
             (SELECT count(*) FROM ua WHERE num_ratings < q1 - 1.5 * (q3 - q1) OR num_ratings > q3 + 1.5 * (q3 - q1)) AS n_outliers
      FROM q""",
    "density_2d": f"""
      WITH b AS (SELECT log10(CAST(num_ratings AS DOUBLE)) AS lx, CAST(avg_rating AS DOUBLE) AS y FROM ia WHERE num_ratings > 0),
      m AS (SELECT min(lx) AS x0, max(lx) AS x1, min(y) AS y0, max(y) AS y1 FROM b)
      SELECT cell_x, cell_y, count, round(log10(CAST(count AS DOUBLE)), 6) AS log10_count
      FROM (SELECT CAST(CASE WHEN x1 = x0 THEN 0 ELSE least(floor((lx - x0) / (x1 - x0) * {P['density_grid']}), {P['density_grid'] - 1}) END AS INTEGER) AS cell_x,
                   CAST(CASE WHEN y1 = y0 THEN 0 ELSE least(floor((y - y0) / (y1 - y0) * {P['density_grid']}), {P['density_grid'] - 1}) END AS INTEGER) AS cell_y,
                   count(*) AS count
            FROM b, m GROUP BY 1, 2)""",
    "top_items_sql": f"""
      SELECT m.item_id, m.title, count(r.rating) AS num_ratings, round(avg(r.rating), 2) AS avg_rating
      FROM clean r JOIN items m ON r.item_id = m.item_id
      GROUP BY m.item_id, m.title ORDER BY num_ratings DESC, m.item_id LIMIT {P['top_k']}""",
    "top_users": "SELECT * FROM ua ORDER BY num_ratings DESC, user_id LIMIT 10",
    "top_items": "SELECT * FROM ia ORDER BY num_ratings DESC, item_id LIMIT 10",
    "bottom_items": "SELECT * FROM ia ORDER BY num_ratings ASC, item_id LIMIT 10",
    "top_quality": f"""SELECT * FROM quality ORDER BY approval_pct DESC, total_ratings DESC, item_id
                       LIMIT {P['quality_top_k']}""",
    "top_genres_demand": "SELECT * FROM gact ORDER BY num_ratings DESC, genre LIMIT 10",
    "top_genres_supply": "SELECT * FROM supply ORDER BY num_items DESC, genre LIMIT 10",
    "hash_sample": f"SELECT * FROM item_sizes WHERE {SAMPLE_PRED}",
    "item_sets": """SELECT s.entity AS item_id, i.title, s.set_size FROM item_sizes s
                    LEFT JOIN items i ON i.item_id = s.entity""",
    "user_sets": """SELECT user_id, count(*) AS set_size FROM (SELECT DISTINCT user_id, item_id FROM interactions
                    WHERE rating >= 3.5 AND user_id IS NOT NULL AND item_id IS NOT NULL) GROUP BY user_id""",
    "tag_sets": """SELECT item_id, count(*) AS set_size FROM (SELECT DISTINCT item_id, tag FROM tags
                   WHERE item_id IS NOT NULL AND tag IS NOT NULL) GROUP BY item_id""",
    "jaccard_pairs": 'SELECT id1, id2, inter, "union", round(jaccard, 6) AS jaccard FROM it_jp',
    "top_jaccard": """
      SELECT t.id1, t.id2, a.title AS title1, b.title AS title2, round(t.jaccard, 4) AS jaccard
      FROM (SELECT * FROM it_jp ORDER BY jaccard DESC, id1, id2 LIMIT 20) t
      LEFT JOIN items a ON a.item_id = t.id1 LEFT JOIN items b ON b.item_id = t.id2""",
    "minhash_signatures": "SELECT entity, CAST(h AS INTEGER) AS h, v FROM it_sig",
    "minhash_estimate": "SELECT id1, id2, round(jaccard, 6) AS jaccard, round(estimate, 6) AS estimate FROM it_est",
    "minhash_error_by_k": f"""
      SELECT k, round(sum(abs(m / k - jaccard)) / ((SELECT n FROM it_n) * ((SELECT n FROM it_n) - 1) / 2), 6) AS mean_error,
             round(1.0 / sqrt(k), 6) AS theoretical_error, count(*) AS overlapping_pairs
      FROM (SELECT j.id1, j.id2, j.jaccard, k.k,
                   count(*) FILTER (WHERE s1.v = s2.v AND s1.h < k.k) AS m
            FROM it_jp j JOIN it_sig s1 ON s1.entity = j.id1
            JOIN it_sig s2 ON s2.entity = j.id2 AND s2.h = s1.h,
            (SELECT unnest([{', '.join(str(k) for k in P['k_values'])}]) AS k) k
            GROUP BY j.id1, j.id2, j.jaccard, k.k)
      GROUP BY k""",
    "minhash_report": """
      SELECT count(*) AS n, round(avg(abs(estimate - jaccard)), 6) AS mae,
             round(sqrt(avg((estimate - jaccard) * (estimate - jaccard))), 6) AS rmse,
             round(max(abs(estimate - jaccard)), 6) AS max_error,
             round(CASE WHEN count(*) > 1 THEN coalesce(corr(estimate, jaccard), 0) ELSE 0 END, 6) AS pearson_r
      FROM it_est""",
    "minhash_error_hist": "WITH e AS (SELECT abs(estimate - jaccard) AS error FROM it_est) " + _hist("e", "error", 20),
    "minhash_error_by_entity": """
      SELECT entity, round(coalesce(sum(e), 0) / ((SELECT n FROM it_n) - 1), 6) AS mean_error, count(e) AS overlapping_pairs
      FROM (SELECT id1 AS entity, abs(estimate - jaccard) AS e FROM it_est
            UNION ALL SELECT id2, abs(estimate - jaccard) FROM it_est
            UNION ALL SELECT DISTINCT entity, NULL FROM liked_m) GROUP BY entity""",
    "doc_sets": "SELECT entity AS doc_id, count(*) AS set_size FROM doc_m GROUP BY entity",
    "doc_similar_pairs": 'SELECT id1, id2, inter, "union", round(jaccard, 6) AS jaccard FROM dc_jp',
    # 20 tables miss a pair at the boundary about once in a thousand times, none of the fixtures'
    "mllib_similar_pairs": "SELECT id1, id2, round(jaccard, 6) AS jaccard FROM dc_jp",
    "lsh_candidates": "SELECT * FROM dc_cand",
    "doc_signatures": "SELECT entity, CAST(h AS INTEGER) AS h, v FROM dc_sig",
    "item_lsh_candidates": """
      WITH b AS (SELECT entity, h // 4 AS band, array_to_string(list(v ORDER BY h), ',') AS vals
                 FROM it_sig WHERE h < 200 GROUP BY entity, h // 4)
      SELECT DISTINCT x.entity AS id1, y.entity AS id2 FROM b x JOIN b y
      ON x.band = y.band AND x.vals = y.vals AND x.entity < y.entity""",
    "lsh_sweep": "SELECT * FROM sweep",
    "lsh_best": "SELECT * FROM sweep ORDER BY f1 DESC, pos ASC LIMIT 1",
    "lsh_confusion": """
      SELECT tp, fp, fn,
             round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
             round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
             round(CASE WHEN tp > 0 THEN 2.0 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) ELSE 0 END, 6) AS f1
      FROM (SELECT count(*) FILTER (WHERE p.id1 IS NOT NULL AND t.id1 IS NOT NULL) AS tp,
                   count(*) FILTER (WHERE p.id1 IS NOT NULL AND t.id1 IS NULL) AS fp,
                   count(*) FILTER (WHERE p.id1 IS NULL AND t.id1 IS NOT NULL) AS fn
            FROM dc_pred p FULL OUTER JOIN dc_jp t ON p.id1 = t.id1 AND p.id2 = t.id2)""",
    "similarity_error": """
      SELECT count(*) AS n, round(avg(abs(p.estimate - t.jaccard)), 6) AS mae,
             round(sqrt(avg((p.estimate - t.jaccard) * (p.estimate - t.jaccard))), 6) AS rmse
      FROM dc_pred p JOIN dc_jp t ON p.id1 = t.id1 AND p.id2 = t.id2""",
    "similar_items": 'SELECT t.id1, t.id2, t.inter, t."union", round(t.jaccard, 6) AS jaccard FROM dc_jp t JOIN dc_cand c ON c.id1 = t.id1 AND c.id2 = t.id2',
    "baskets_guarded": f"""SELECT basket_id, string_agg(item, '|' ORDER BY item) AS items, count(*) AS n_items FROM bk
                        GROUP BY basket_id HAVING count(*) <= {P['basket_guard']}""",
    "baskets": "SELECT basket_id, string_agg(item, '|' ORDER BY item) AS items, count(*) AS n_items FROM bk GROUP BY basket_id",
    "user_funnel": f"""
      WITH pu AS (SELECT i.user_id, count(DISTINCT CASE WHEN i.rating >= 3.5 THEN p.p_brand END) AS pos
                  FROM interactions i JOIN part p ON i.item_id = p.p_partkey GROUP BY i.user_id),
      c AS (SELECT count(*) AS s1, count(*) FILTER (WHERE pos >= 1) AS s2,
                   count(*) FILTER (WHERE pos >= {P['basket_min']}) AS s3,
                   count(*) FILTER (WHERE pos BETWEEN {P['basket_min']} AND {P['basket_max']}) AS s4 FROM pu),
      st AS (SELECT 1 AS step, 'all users' AS stage, s1 AS users, s1 AS prev FROM c
             UNION ALL SELECT 2, 'with positive interactions', s2, s1 FROM c
             UNION ALL SELECT 3, 'basket size >= {P['basket_min']}', s3, s2 FROM c
             UNION ALL SELECT 4, 'basket size <= {P['basket_max']}', s4, s3 FROM c)
      SELECT step, stage, users, prev - users AS lost,
             round(CASE WHEN prev > 0 THEN 100.0 * (prev - users) / prev ELSE 0 END, 6) AS pct_lost FROM st""",
    "frequent_itemsets": """SELECT array_to_string(items, '|') AS items, size, freq,
                                   round(freq / (SELECT n FROM ub_nb), 6) AS support FROM ub_is""",
    "itemset_bitmaps": "SELECT array_to_string(items, '|') AS items, size, freq, freq AS bitmap_freq FROM ub_is",
    "order_itemsets": """SELECT array_to_string(items, '|') AS items, size, freq,
                                round(freq / (SELECT n FROM od_nb), 6) AS support FROM od_is""",
    "association_rules": f"SELECT {RULE_COLS} FROM rules",
    "rules_lift": f"SELECT {RULE_COLS}, round(consequent_support, 6) AS consequent_support FROM rules",
    "top_rules": f"SELECT {RULE_COLS} FROM relevant ORDER BY lift DESC, confidence DESC, antecedent, consequent LIMIT 10",
    "rules_without_sequels": f"""
      SELECT {RULE_COLS}, sim AS max_title_similarity FROM (
        SELECT *, list_max(list_transform(string_split(antecedent, '|'), lambda a:
                  round(CASE WHEN greatest(length(lower(a)), length(lower(consequent))) = 0 THEN 1.0
                  ELSE 1.0 - levenshtein(lower(a), lower(consequent))
                       / greatest(length(lower(a)), length(lower(consequent))) END, 6))) AS sim
        FROM relevant)
      WHERE sim <= {P['sequel_similarity']}
      ORDER BY lift DESC, confidence DESC, antecedent, consequent LIMIT 10""",
    "rule_titles": """
      WITH t AS (SELECT p_brand, min(p_name) AS title FROM part GROUP BY p_brand),
      x AS (SELECT antecedent, consequent, unnest(string_split(antecedent, '|')) AS item,
                   unnest(range(len(string_split(antecedent, '|')))) AS pos FROM rules),
      a AS (SELECT x.antecedent, x.consequent, string_agg(coalesce(t.title, 'ID:' || x.item), '|' ORDER BY x.pos) AS titles
            FROM x LEFT JOIN t ON t.p_brand = x.item GROUP BY x.antecedent, x.consequent)
      SELECT a.antecedent, a.consequent, a.titles AS antecedent_titles, coalesce(t.title, 'ID:' || a.consequent) AS consequent_titles
      FROM a LEFT JOIN t ON t.p_brand = a.consequent""",
    "rule_strength": f"""
      SELECT {RULE_COLS}, CASE WHEN lift > 1.5 THEN 'very strong' WHEN lift > 1.2 THEN 'strong'
                               WHEN lift > 1.0 THEN 'moderate' ELSE 'weak' END AS strength FROM rules""",
    "recommendations": """
      SELECT item, recommended, round(confidence, 6) AS confidence, round(lift, 6) AS lift, rank FROM (
        SELECT antecedent AS item, consequent AS recommended, confidence, lift,
               CAST(row_number() OVER (PARTITION BY antecedent ORDER BY lift DESC, confidence DESC, consequent) AS INTEGER) AS rank
        FROM rules WHERE NOT contains(antecedent, '|')) WHERE rank <= 5""",
    "rule_stats": """
      SELECT count(*) AS n_rules,
             round(avg(confidence), 6) AS mean_confidence, round(min(confidence), 6) AS min_confidence, round(max(confidence), 6) AS max_confidence,
             round(avg(lift), 6) AS mean_lift, round(min(lift), 6) AS min_lift, round(max(lift), 6) AS max_lift,
             round(avg(support), 6) AS mean_support, round(min(support), 6) AS min_support, round(max(support), 6) AS max_support
      FROM rules""",
    "rule_graph_edges": "SELECT string_split(antecedent, '|')[1] AS src, consequent AS dst, round(max(lift), 6) AS weight FROM relevant GROUP BY 1, 2",
    "rule_graph_strong": f"""SELECT string_split(antecedent, '|')[1] AS src, consequent AS dst, round(max(lift), 6) AS weight
                             FROM relevant WHERE lift > {P['graph_lift']} GROUP BY 1, 2""",
    "csv_rejects": """
      SELECT CASE WHEN l_linenumber IN (3, 5, 7) THEN 'malformed' WHEN l_linenumber = 6 THEN 'missing item_id' ELSE 'good' END AS reason,
             count(*) AS rows
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "distinct_users": """
      WITH g AS (SELECT x.genre, c.user_id FROM clean c JOIN genres_x x ON x.item_id = c.item_id)
      SELECT genre, count(DISTINCT user_id) AS exact, true AS within_bound FROM g GROUP BY genre
      UNION ALL SELECT NULL, count(DISTINCT user_id), true FROM g""",
    "activity_quantiles": """
      WITH s AS (SELECT CAST(entity % 10 AS INTEGER) AS part FROM item_sizes),
      n AS (SELECT part, count(*) AS n FROM s GROUP BY part UNION ALL SELECT NULL, count(*) FROM s)
      SELECT part, share, CAST(n AS BIGINT) AS n, true AS within_bound
      FROM n, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95])::DOUBLE AS share)""",
    "stratified_sample": "SELECT * FROM strat",
    "sample_distance": """
      WITH x AS (SELECT num_ratings AS v, count(*) AS f, 0 AS s FROM strat_all GROUP BY 1
                 UNION ALL SELECT num_ratings, 0, count(*) FROM strat GROUP BY 1),
      y AS (SELECT v, sum(f) AS f, sum(s) AS s FROM x GROUP BY v),
      z AS (SELECT sum(f) OVER (ORDER BY v) / sum(f) OVER () AS a, sum(s) OVER (ORDER BY v) / sum(s) OVER () AS b FROM y)
      SELECT (SELECT count(*) FROM strat_all) AS n_full, (SELECT count(*) FROM strat) AS n_sample,
             round(max(abs(a - b)), 6) AS distance FROM z""",
    "density_hex": f"""
      WITH b AS (SELECT log10(CAST(num_ratings AS DOUBLE)) AS lx, CAST(avg_rating AS DOUBLE) AS y FROM ia WHERE num_ratings > 0),
      m AS (SELECT min(lx) AS x0, min(y) AS y0,
                   CASE WHEN max(lx) = min(lx) THEN 1.0 ELSE (max(lx) - min(lx)) / {P['density_grid']} END AS sx,
                   CASE WHEN max(y) = min(y) THEN 1.0 ELSE (max(y) - min(y)) / {int(P['density_grid'] / 3 ** 0.5)} END AS sy FROM b),
      p AS (SELECT (lx - x0) / sx AS u, (y - y0) / sy AS v FROM b, m),
      c AS (SELECT u, v, floor(u + 0.5) AS u1, floor(v + 0.5) AS v1, least(floor(u), {P['density_grid'] - 1}) + 0.5 AS u2,
                   least(floor(v), {int(P['density_grid'] / 3 ** 0.5) - 1}) + 0.5 AS v2 FROM p),
      n AS (SELECT *, (u - u1) * (u - u1) + 3 * (v - v1) * (v - v1) <= (u - u2) * (u - u2) + 3 * (v - v2) * (v - v2) AS one FROM c),
      k AS (SELECT CAST(2 * CASE WHEN one THEN u1 ELSE u2 END AS INTEGER) AS cell_x,
                   CAST(2 * CASE WHEN one THEN v1 ELSE v2 END AS INTEGER) AS cell_y, count(*) AS count FROM n GROUP BY 1, 2)
      SELECT cell_x, cell_y, round(x0 + cell_x / 2 * sx, 6) AS center_x, round(y0 + cell_y / 2 * sy, 6) AS center_y, count,
             round(log10(CAST(count AS DOUBLE)), 6) AS log10_count FROM k, m""",
    "item_quality_few": f"SELECT * FROM quality WHERE total_ratings >= {P['quality_few_ratings']}",
    "jaccard_at_least": """SELECT id1, id2, inter, "union", round(jaccard, 6) AS jaccard FROM it_jp WHERE jaccard >= 0.1 - 1e-9""",
    "feature_vectors": """
      WITH m AS (SELECT DISTINCT user_id AS entity, item_id AS element FROM tags WHERE user_id IS NOT NULL AND item_id IS NOT NULL),
      u AS (SELECT element, row_number() OVER (ORDER BY element) - 1 AS place FROM (SELECT DISTINCT element FROM m))
      SELECT entity, '(' || (SELECT count(*) FROM u) || ',[' || string_agg(place::VARCHAR, ',' ORDER BY place) || '],['
             || string_agg('1.0', ',') || '])' AS features FROM m JOIN u USING (element) GROUP BY entity""",
    "user_tag_sets": """
      SELECT item_id, count(*) AS set_size FROM (
        SELECT DISTINCT item_id, 'u' AS kind, user_id::VARCHAR AS e FROM interactions WHERE rating >= 3.5
        UNION ALL SELECT DISTINCT item_id, 't', tag FROM tags WHERE item_id IS NOT NULL AND tag IS NOT NULL)
      GROUP BY item_id""",
    "lsh_sweep_quick": _sweep_sql("quick"),
    "lsh_sweep_full": _sweep_sql("full"),
}

_ORDER = list(CTE)


def _needed(body: str) -> list[str]:
    """CTE names the body needs, transitively, in definition order."""
    import re

    need: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in _ORDER:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                todo.append(CTE[name])
    return [n for n in _ORDER if n in need]


def build(name: str) -> str:
    body = BODY[name]
    names = _needed(body)
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({CTE[n]})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH RECURSIVE {ctes},\n{body[5:]}"
    return f"WITH RECURSIVE {ctes}\n{body}"


ORACLE_SQL: dict[str, str] = {name: build(name) for name in BODY}
