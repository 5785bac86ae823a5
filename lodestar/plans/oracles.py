"""DuckDB SQL equivalents of the registered queries (same column names).

Views ``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations`` are registered by the caller.
Doubles are rounded the same way on both sides; ``+ 0.0`` turns DuckDB's
``-0.0`` into ``0.0``.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Long form of the embedding vectors: one row per (vec_id, dim).
_POINTS_LONG = """
pl AS (
  SELECT vec_id, label, unnest(generate_series(0, len(embedding) - 1)) AS dim,
         CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings
)"""

ORACLES["topn_per_cluster"] = f"""
WITH {_POINTS_LONG},
c AS (SELECT label, dim, avg(x) AS m FROM pl GROUP BY label, dim),
d AS (
  SELECT pl.vec_id, pl.label, sqrt(sum((pl.x - c.m) * (pl.x - c.m))) AS dist
  FROM pl JOIN c ON pl.label = c.label AND pl.dim = c.dim
  GROUP BY pl.vec_id, pl.label
),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY dist, vec_id) AS rn FROM d)
SELECT CAST(label AS BIGINT) AS cluster_id, CAST(vec_id AS BIGINT) AS item_id,
       round(dist, 6) + 0.0 AS ranking_score, CAST(rn AS BIGINT) AS rank
FROM r WHERE rn <= 20
"""


from lodestar.functions.numeric import sql_sig_round as _sig  # noqa: E402

# ---------------------------------------------------------------- relations

RATINGS = """
ratings AS (
  SELECT o.o_custkey AS "user", l.l_partkey AS item,
         1 + CAST(max(l.l_quantity) AS INTEGER) % 5 AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey
)"""

PREDICTIONS = """
means AS (SELECT "user", round(avg(rating), 0) AS prediction FROM ratings GROUP BY "user"),
joined AS (
  SELECT r."user", r.item, CAST(r.rating AS DOUBLE) AS rating, CAST(m.prediction AS DOUBLE) AS prediction
  FROM ratings r JOIN means m ON r."user" = m."user"
)"""

CLASSED = """
classed AS (
  SELECT l_orderkey, l_linenumber, l_discount, l_tax,
         CASE WHEN l_discount >= 0.05 THEN 2 WHEN l_tax >= 0.04 THEN 1 ELSE 3 END AS label
  FROM lineitem
)"""

ITEMS = """
items AS (
  SELECT p_partkey AS item_id, p_name AS title,
         (p_size >> 0) & 1 AS f0, (p_size >> 1) & 1 AS f1, (p_size >> 2) & 1 AS f2,
         (p_size >> 3) & 1 AS f3, (p_size >> 4) & 1 AS f4, (p_size >> 5) & 1 AS f5
  FROM part
)"""

GENRES_TEXT = ("concat(CASE WHEN f0 = 1 THEN 'Plain|' ELSE '' END, "
               "CASE WHEN f1 = 1 THEN 'Brisk|' ELSE '' END, "
               "CASE WHEN f2 = 1 THEN 'Sunny|' ELSE '' END, "
               "CASE WHEN f3 = 1 THEN 'Woven|' ELSE '' END, "
               "CASE WHEN f4 = 1 THEN 'Tall|' ELSE '' END, "
               "CASE WHEN f5 = 1 THEN 'Quiet|' ELSE '' END)")

HASH80 = ("((('0x' || substr(md5(CAST({k1} AS VARCHAR) || ':' || CAST({k2} AS VARCHAR)), 1, 8))::BIGINT"
          " % 100) < 80)")


def _lno(start: int, stop: int) -> str:
    return f"""
occ AS (
  SELECT event_id, user_id,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
  FROM events
),
cand AS (SELECT event_id FROM occ WHERE rn BETWEEN {start} AND {stop})"""


# ---------------------------------------------------------------- splits

ORACLES["holdout_split"] = f"""
WITH {RATINGS}
SELECT CASE WHEN {HASH80.format(k1='"user"', k2='item')} THEN 'train' ELSE 'test' END AS split,
       CAST(count(*) AS BIGINT) AS n
FROM ratings GROUP BY 1
"""

ORACLES["sample_k"] = """
SELECT vec_id FROM embeddings ORDER BY md5('1:' || CAST(vec_id AS VARCHAR)), vec_id LIMIT 5
"""

ORACLES["kfold_by_position"] = """
WITH s AS (SELECT min(event_id) AS lo, count(*) AS n FROM events)
SELECT event_id, user_id, CAST(((event_id - lo) * 5) // n AS INTEGER) AS fold
FROM events, s
"""

ORACLES["kfold_by_sorted_position"] = f"""
WITH {RATINGS},
p AS (SELECT "user", item, row_number() OVER (ORDER BY "user", item) - 1 AS pos FROM ratings),
s AS (SELECT count(*) AS n FROM ratings)
SELECT "user", item, CAST((pos * 5) // n AS INTEGER) AS fold FROM p, s
"""

ORACLES["split_files_roundtrip"] = f"""
WITH {RATINGS},
p AS (SELECT "user", item, rating, row_number() OVER (ORDER BY "user", item) - 1 AS pos FROM ratings),
s AS (SELECT count(*) AS n FROM ratings)
SELECT "user", item, CAST(rating AS BIGINT) AS rating, CAST((pos * 5) // n AS INTEGER) AS fold FROM p, s
"""

ORACLES["split_files_sorted"] = f"""
WITH {RATINGS}
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order FROM ratings
"""

ORACLES["random_split_counts"] = """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_twice, CAST(0 AS BIGINT) AS n_neither, true AS share_ok
FROM lineitem
"""

ORACLES["leave_n_out"] = f"""
WITH {_lno(1, 10)}
SELECT e.event_id, e.user_id,
       CASE WHEN c.event_id IS NOT NULL THEN 'test' ELSE 'base' END AS split
FROM events e LEFT JOIN cand c ON e.event_id = c.event_id
"""

ORACLES["leave_n_out_capped"] = f"""
WITH {_lno(11, 20)},
capped AS (SELECT event_id FROM cand ORDER BY event_id LIMIT 1000)
SELECT e.event_id, e.user_id,
       CASE WHEN c.event_id IS NOT NULL THEN 'test' ELSE 'base' END AS split
FROM events e LEFT JOIN capped c ON e.event_id = c.event_id
"""

ORACLES["union_splits"] = """
WITH s AS (SELECT min(event_id) AS lo, count(*) AS n FROM events),
f AS (SELECT event_id, user_id, CAST(((event_id - lo) * 5) // n AS INTEGER) AS fold FROM events, s)
SELECT * FROM f WHERE fold = 1 UNION ALL SELECT * FROM f WHERE fold = 2
UNION ALL SELECT * FROM f WHERE fold = 3 UNION ALL SELECT * FROM f WHERE fold = 4
"""

ORACLES["split_complement"] = f"""
WITH {_lno(1, 10)}
SELECT event_id, user_id FROM events WHERE event_id NOT IN (SELECT event_id FROM cand)
"""

ORACLES["bag_complement"] = f"""
WITH {_lno(1, 10)}
SELECT user_id, event_type FROM events
EXCEPT ALL
SELECT user_id, event_type FROM events WHERE event_id IN (SELECT event_id FROM cand)
"""

# ---------------------------------------------------------------- lookups, projections

ORACLES["first_n_ordered"] = f"""
WITH {RATINGS}
SELECT "user", item, CAST(rating AS BIGINT) AS rating FROM ratings ORDER BY "user", item LIMIT 10
"""

ORACLES["drop_columns"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
"""

ORACLES["ratings_vs_predictions"] = f"""
WITH {RATINGS}, {PREDICTIONS}
SELECT * FROM joined
"""

ORACLES["join_pairs_skewed"] = ORACLES["ratings_vs_predictions"]

ORACLES["mse_rmse"] = f"""
WITH {RATINGS}, {PREDICTIONS}
SELECT round(avg((rating - prediction) * (rating - prediction)), 9) + 0.0 AS mse,
       round(sqrt(avg((rating - prediction) * (rating - prediction))), 9) + 0.0 AS rmse,
       CAST(count(*) AS BIGINT) AS n
FROM joined
"""

ORACLES["filter_pair"] = f"""
WITH {RATINGS}, {PREDICTIONS}
SELECT min("user") AS "user", min(item) AS item, round(avg((rating - prediction) * (rating - prediction)), 9) + 0.0 AS squared_error,
       round(sqrt(avg((rating - prediction) * (rating - prediction))), 9) + 0.0 AS root_squared_error,
       CAST(count(*) AS BIGINT) AS n
FROM joined WHERE ("user", item) = (SELECT ("user", item) FROM ratings ORDER BY "user", item LIMIT 1)
"""

ORACLES["user_ratings_lookup"] = f"""
WITH {RATINGS}
SELECT "user", item, CAST(rating AS BIGINT) AS rating FROM ratings WHERE "user" = 7
"""

ORACLES["user_history"] = f"""
WITH {RATINGS}
SELECT "user", CAST(count(*) AS BIGINT) AS n_ratings FROM ratings GROUP BY "user"
"""

_TOP_RATED = """
top AS (
  SELECT "user", item, rating,
         row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS rn
  FROM ratings
)"""

ORACLES["user_top_rated"] = f"""
WITH {RATINGS}, {_TOP_RATED}
SELECT "user", item, CAST(rating AS BIGINT) AS rating, CAST(rn AS BIGINT) AS rank
FROM top WHERE rn <= 10
"""

ORACLES["titles_lookup"] = f"""
WITH {RATINGS}, {_TOP_RATED},
titles AS (SELECT p_partkey AS item_id, max(p_name) AS title FROM part GROUP BY p_partkey)
SELECT t."user", t.item, CAST(t.rating AS BIGINT) AS rating, ti.title
FROM top t LEFT JOIN titles ti ON t.item = ti.item_id
WHERE t.rn <= 10
"""

ORACLES["genre_labels"] = f"""
WITH {ITEMS}
SELECT item_id, title || '|' || {GENRES_TEXT} AS info, {GENRES_TEXT} AS genres FROM items
"""

ORACLES["topn_per_cluster_enriched"] = ORACLES["topn_per_cluster"].replace(
    "FROM embeddings", "FROM embeddings WHERE vec_id IN (SELECT p_partkey FROM part)").replace(
    "SELECT CAST(label AS BIGINT) AS cluster_id, CAST(vec_id AS BIGINT) AS item_id,\n"
    "       round(dist, 6) + 0.0 AS ranking_score, CAST(rn AS BIGINT) AS rank\n"
    "FROM r WHERE rn <= 20",
    f""",
{ITEMS}
SELECT CAST(r.label AS BIGINT) AS cluster_id, CAST(r.vec_id AS BIGINT) AS item_id,
       i.title || '|' || {GENRES_TEXT.replace('WHEN f', 'WHEN i.f')} AS info,
       round(r.dist, 6) + 0.0 AS ranking_score
FROM r JOIN items i ON r.vec_id = i.item_id WHERE r.rn <= 20""").replace(
    "WITH \npl AS", "WITH \npl AS")

# ---------------------------------------------------------------- statistics

ORACLES["accuracy_metric"] = f"""
WITH {CLASSED}
SELECT round(avg(CASE WHEN (CASE WHEN l_discount >= 0.06 THEN 2 WHEN l_tax >= 0.04 THEN 1 ELSE 3 END) = label
                 THEN 1.0 ELSE 0.0 END), 9) + 0.0 AS accuracy,
       CAST(count(*) AS BIGINT) AS n
FROM classed
"""

_CORR_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]

ORACLES["corr_with_target"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(corr(l_extendedprice, {c}), 9) + 0.0 AS corr FROM lineitem"
    for c in _CORR_FEATURES)

ORACLES["select_by_correlation"] = f"""
WITH c AS ({ORACLES["corr_with_target"]}
UNION ALL SELECT 'net_price', round(corr(l_extendedprice, l_extendedprice * (1 - l_discount)), 9) FROM lineitem
UNION ALL SELECT 'tax_amount', round(corr(l_extendedprice, l_extendedprice * l_tax), 9) FROM lineitem)
SELECT feature, corr FROM c WHERE abs(corr) >= 0.5
"""

ORACLES["gram_matrix_wide"] = f"""
WITH {_POINTS_LONG}
SELECT CAST(a.dim AS BIGINT) AS i, CAST(b.dim AS BIGINT) AS j, {_sig('sum(a.x * b.x)', 9)} AS value
FROM pl a JOIN pl b ON a.vec_id = b.vec_id AND a.dim <= b.dim
GROUP BY a.dim, b.dim
"""

ORACLES["gram_tiled"] = ORACLES["gram_matrix_wide"]

_GRAM_COLS = ["l_quantity", "l_discount", "l_tax", "intercept"]


def _gram_sql() -> str:
    parts = []
    for i, a in enumerate(_GRAM_COLS):
        for b in _GRAM_COLS[i:]:
            parts.append(f"SELECT '{a}' AS row_name, '{b}' AS col_name, "
                         f"{_sig(f'sum({a} * {b})', 10)} AS value FROM d")
        parts.append(f"SELECT '{a}' AS row_name, 'l_extendedprice' AS col_name, "
                     f"{_sig(f'sum({a} * l_extendedprice)', 10)} AS value FROM d")
    return ("WITH d AS (SELECT l_quantity, l_discount, l_tax, 1.0 AS intercept, l_extendedprice "
            "FROM lineitem)\n" + "\nUNION ALL\n".join(parts))


ORACLES["gram_matrix"] = _gram_sql()


def _ols_sql(where: str) -> str:
    """Three features + intercept: Cramer's rule on the sample covariances."""
    x = ["l_quantity", "l_discount", "l_tax"]
    cov = ", ".join([f"covar_samp({x[i]}, {x[j]}) AS s{i}{j}" for i in range(3) for j in range(3)]
                    + [f"covar_samp({x[i]}, l_extendedprice) AS s{i}y, avg({x[i]}) AS m{i}" for i in range(3)])

    def det(replaced: int | None) -> str:
        c = [[f"s{i}{'y' if j == replaced else j}" for j in range(3)] for i in range(3)]
        return " + ".join(f"{c[0][j]} * ({c[1][(j + 1) % 3]} * {c[2][(j + 2) % 3]} - {c[1][(j + 2) % 3]} * {c[2][(j + 1) % 3]})"
                          for j in range(3))

    return f"""
s AS (SELECT {cov}, avg(l_extendedprice) AS my FROM lineitem {where}),
b AS (SELECT ({det(0)}) / ({det(None)}) AS b1, ({det(1)}) / ({det(None)}) AS b2, ({det(2)}) / ({det(None)}) AS b3,
             m0, m1, m2, my FROM s),
w AS (SELECT b1, b2, b3, my - b1 * m0 - b2 * m1 - b3 * m2 AS b0 FROM b)"""


ORACLES["ols_coefficients"] = f"""
WITH {_ols_sql("")}
SELECT 'l_quantity' AS feature, {_sig('b1', 9)} AS coefficient FROM w
UNION ALL SELECT 'l_discount', {_sig('b2', 9)} FROM w
UNION ALL SELECT 'l_tax', {_sig('b3', 9)} FROM w
UNION ALL SELECT 'intercept', {_sig('b0', 9)} FROM w
"""

ORACLES["ols_qr"] = ORACLES["ols_coefficients"]

_TRAIN = "WHERE " + HASH80.format(k1="l_orderkey", k2="l_linenumber")

ORACLES["ols_predictions"] = f"""
WITH {_ols_sql(_TRAIN)}
SELECT l_orderkey, l_linenumber,
       {_sig('l_quantity * b1 + l_discount * b2 + l_tax * b3 + 1.0 * b0', 9)} AS prediction
FROM lineitem, w
WHERE NOT {HASH80.format(k1="l_orderkey", k2="l_linenumber")}
"""

# ---------------------------------------------------------------- sources / sinks

ORACLES["parse_ratings"] = f"""
WITH {RATINGS}
SELECT "user", item, CAST(rating AS BIGINT) AS rating FROM ratings
"""

ORACLES["parse_items"] = f"""
WITH {ITEMS}
SELECT item_id, title, CAST(f0 + f1 + f2 + f3 + f4 + f5 AS BIGINT) AS n_flags,
       concat(f0, f1, f2, f3, f4, f5) AS flag_bits
FROM items
"""

ORACLES["parse_points"] = """
SELECT vec_id, CAST(unnest(generate_series(0, len(embedding) - 1)) AS BIGINT) AS dim,
       round(CAST(unnest(embedding) AS DOUBLE), 9) + 0.0 AS value
FROM embeddings
"""

ORACLES["csv_roundtrip_noheader"] = f"""
WITH {CLASSED}
SELECT CAST(l_orderkey AS BIGINT) AS _c0, CAST(l_linenumber AS BIGINT) AS _c1,
       l_discount AS _c2, l_tax AS _c3, CAST(label AS BIGINT) AS _c4
FROM classed
"""

ORACLES["csv_one_file"] = f"""
WITH {RATINGS}
SELECT "user", item, CAST(rating AS BIGINT) AS rating, false AS out_of_order FROM ratings
"""

ORACLES["csv_roundtrip_header"] = """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, CAST(1.0 AS DOUBLE) AS intercept,
       l_extendedprice
FROM lineitem
"""

ORACLES["text_sink_roundtrip"] = ORACLES["csv_roundtrip_header"]


# ---------------------------------------------------------------- k-means (Lloyd)


def _lloyd_sql(k: int = 5, iters: int = 3, order: str = "vec_id") -> str:
    """CTE chain: init = the first k ids in ``order`` (lowest ids, or a seeded
    md5 order), then ``iters`` rounds of (assign, average, keep the old centre
    for an empty cluster)."""
    ctes = [_POINTS_LONG.strip(),
            f"""init AS (SELECT vec_id, CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS c
                         FROM embeddings ORDER BY {order} LIMIT {k})""",
            "c0 AS (SELECT i.c, pl.dim, pl.x AS v FROM init i JOIN pl ON pl.vec_id = i.vec_id)"]
    for t in range(1, iters + 2):
        p = t - 1
        ctes.append(f"""d{t} AS (
  SELECT pl.vec_id, c{p}.c, sum((pl.x - c{p}.v) * (pl.x - c{p}.v)) AS dist
  FROM pl JOIN c{p} ON pl.dim = c{p}.dim GROUP BY pl.vec_id, c{p}.c)""")
        ctes.append(f"""a{t} AS (
  SELECT vec_id, c, dist FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, c) AS rn FROM d{t}) WHERE rn = 1)""")
        if t <= iters:
            ctes.append(f"""m{t} AS (
  SELECT a.c, pl.dim, avg(pl.x) AS v FROM a{t} a JOIN pl ON a.vec_id = pl.vec_id GROUP BY a.c, pl.dim)""")
            ctes.append(f"""c{t} AS (
  SELECT c{p}.c, c{p}.dim, coalesce(m{t}.v, c{p}.v) AS v
  FROM c{p} LEFT JOIN m{t} ON c{p}.c = m{t}.c AND c{p}.dim = m{t}.dim)""")
            ctes.append(f"""s{t} AS (
  SELECT {t} AS iteration, coalesce(sum((c{p}.v - m{t}.v) * (c{p}.v - m{t}.v)), 0.0) AS shift
  FROM c{p} JOIN m{t} ON c{p}.c = m{t}.c AND c{p}.dim = m{t}.dim)""")
    return "WITH " + ",\n".join(ctes)


_L = _lloyd_sql()

ORACLES["kmeans_lloyd_centroids"] = _L + """
SELECT CAST(c AS BIGINT) AS cluster_id, CAST(dim AS BIGINT) AS dim, round(v, 9) + 0.0 AS value FROM c3
"""

ORACLES["kmeans_bounded"] = _L + """
SELECT CAST(c AS BIGINT) AS cluster_id, CAST(dim AS BIGINT) AS dim, round(v, 9) + 0.0 AS value, true AS skipped FROM c3
"""

ORACLES["kmeans_lloyd_sampled_init"] = _lloyd_sql(
    order="md5('1:' || CAST(vec_id AS VARCHAR)), vec_id") + """
SELECT CAST(c AS BIGINT) AS cluster_id, CAST(dim AS BIGINT) AS dim, round(v, 9) + 0.0 AS value FROM c3
"""

ORACLES["kmeans_lloyd_assign"] = _L + """
SELECT vec_id, CAST(c AS BIGINT) AS cluster_id FROM a4
"""

ORACLES["kmeans_lloyd_shift"] = _L + """
SELECT CAST(iteration AS BIGINT) AS iteration, round(shift, 9) + 0.0 AS shift FROM s1
UNION ALL SELECT CAST(iteration AS BIGINT), round(shift, 9) + 0.0 FROM s2
UNION ALL SELECT CAST(iteration AS BIGINT), round(shift, 9) + 0.0 FROM s3
"""

ORACLES["kmeans_cost"] = _L + """
SELECT round(sum(sqrt(dist)), 6) + 0.0 AS sum_distance, round(sum(dist), 6) + 0.0 AS sum_squared_distance
FROM a4
"""

# ---------------------------------------------------------------- k-means (MLlib)

ORACLES["kmeans_mllib_summary"] = """
SELECT label, CAST(count(*) AS BIGINT) AS n_points, CAST(1 AS BIGINT) AS n_clusters
FROM embeddings GROUP BY label
"""

ORACLES["kmeans_mllib_random_init"] = """
SELECT CAST(label % 4 AS BIGINT) AS grp, CAST(count(*) AS BIGINT) AS n_points, CAST(1 AS BIGINT) AS n_clusters
FROM embeddings GROUP BY 1
"""

ORACLES["kmeans_lloyd_converged"] = f"""
WITH {_POINTS_LONG},
names AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS c FROM (SELECT DISTINCT label FROM embeddings))
SELECT CAST(c AS BIGINT) AS cluster_id, CAST(dim AS BIGINT) AS dim, round(avg(x + label * 100.0), 6) + 0.0 AS value,
       true AS converged
FROM pl JOIN names USING (label) GROUP BY c, dim
"""

ORACLES["cluster_assignments"] = """
SELECT vec_id, CAST(label AS BIGINT) AS cluster_label FROM embeddings
"""

ORACLES["kmeans_mllib_cost"] = f"""
WITH {_POINTS_LONG},
sp AS (SELECT vec_id, label, dim, x + label * 100.0 AS x FROM pl),
c AS (SELECT label, dim, avg(x) AS m FROM sp GROUP BY label, dim),
d AS (SELECT sp.vec_id, sqrt(sum((sp.x - c.m) * (sp.x - c.m))) AS dist
      FROM sp JOIN c ON sp.label = c.label AND sp.dim = c.dim GROUP BY sp.vec_id)
SELECT round(sum(dist), 6) + 0.0 AS sum_distance, round(sum(dist * dist), 6) + 0.0 AS sum_squared_distance
FROM d
"""

ORACLES["model_save_load_same_predictions"] = """
SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS mismatches FROM embeddings
"""

# ---------------------------------------------------------------- PCA

ORACLES["covariance_long"] = f"""
WITH {_POINTS_LONG}
SELECT CAST(a.dim AS BIGINT) AS i, CAST(b.dim AS BIGINT) AS j, {_sig('covar_samp(a.x, b.x)', 9)} AS cov
FROM pl a JOIN pl b ON a.vec_id = b.vec_id
GROUP BY a.dim, b.dim
"""

ORACLES["pca_components_2d"] = f"""
WITH {_POINTS_LONG},
cv AS (SELECT a.dim AS i, b.dim AS j, covar_samp(a.x, b.x) AS c FROM pl a JOIN pl b ON a.vec_id = b.vec_id GROUP BY a.dim, b.dim)
SELECT CAST(0 AS DOUBLE) AS residual, CAST(0 AS DOUBLE) AS orthonormality, CAST(0 AS BIGINT) AS n_out_of_order,
       {_sig('sum(c) FILTER (i = j)', 8)} AS sum_values, {_sig('sum(c * c)', 8)} AS sum_squares
FROM cv
"""

ORACLES["pca2_with_cluster"] = f"""
WITH {_POINTS_LONG},
cv AS (SELECT a.dim AS i, b.dim AS j, covar_samp(a.x, b.x) AS c FROM pl a JOIN pl b ON a.vec_id = b.vec_id GROUP BY a.dim, b.dim),
m AS (SELECT {_sig('sum(c) FILTER (i = j)', 8)} AS sum_variances, {_sig('sum(c * c)', 8)} AS sum_squared_variances FROM cv)
SELECT vec_id, round(sum(x * x), 6) + 0.0 AS squared_norm, CAST(count(*) AS BIGINT) AS n_components,
       CAST(label AS BIGINT) AS cluster_id, CAST(0 AS DOUBLE) AS covariance_off_diagonal,
       CAST(0 AS BIGINT) AS n_variances_out_of_order, any_value(sum_variances) AS sum_variances,
       any_value(sum_squared_variances) AS sum_squared_variances
FROM pl, m GROUP BY vec_id, label
"""

# ---------------------------------------------------------------- vectors

ORACLES["vector_distances"] = """
SELECT a.vec_id, b.vec_id AS next_id,
       round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
             * list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) + 0.0
         AS squared_distance,
       round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) + 0.0 AS distance
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
"""

ORACLES["factor_score_pairs"] = f"""
WITH {RATINGS}
SELECT r."user", r.item,
       round(list_inner_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])), 9) + 0.0 AS score
FROM ratings r JOIN embeddings u ON u.vec_id = r."user" JOIN embeddings i ON i.vec_id = r.item
"""

ORACLES["recommend_topk"] = """
WITH u AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 7),
s AS (SELECT e.vec_id AS item, list_inner_product(CAST(e.embedding AS DOUBLE[]), u.v) AS score
      FROM embeddings e, u)
SELECT item, round(score, 9) + 0.0 AS score,
       CAST(row_number() OVER (ORDER BY score DESC, item) AS BIGINT) AS rank
FROM s ORDER BY score DESC, item LIMIT 10
"""

ORACLES["score_bucketed"] = ORACLES["factor_score_pairs"]

ORACLES["recommend_topk_users"] = """
WITH s AS (SELECT u.vec_id AS "user", i.vec_id AS item,
                  list_inner_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS score
           FROM embeddings u, embeddings i WHERE u.vec_id % 100 = 0)
SELECT "user", item, round(score, 9) + 0.0 AS score,
       CAST(row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS BIGINT) AS rank
FROM s QUALIFY rank <= 10
"""


# ---------------------------------------------------------------- classification

_TEST = "NOT " + HASH80.format(k1="l_orderkey", k2="l_linenumber")

_CLASS_PRED = f"""
WITH {CLASSED}
SELECT l_orderkey, l_linenumber, CAST(label AS BIGINT) AS label, CAST(label AS BIGINT) AS prediction
FROM classed WHERE {_TEST}
"""

for _n in ("classification_tree", "classification_tree_default", "classification_forest",
           "classification_forest_small"):
    ORACLES[_n] = _CLASS_PRED

ORACLES["classification_logreg"] = f"""
SELECT CAST(class AS BIGINT) AS class, feature, CAST(0 AS DOUBLE) AS score,
       (SELECT CAST(count(*) AS BIGINT) FROM lineitem WHERE {_TEST}) AS n_test
FROM (SELECT unnest([1, 2, 3]) AS class),
     (SELECT unnest(['intercept', 'l_quantity', 'l_discount', 'l_tax']) AS feature)
"""

_ENET_ROWS = "\nUNION ALL\n".join(
    f"SELECT CAST({c} AS BIGINT) AS class, '{f}' AS feature, round((avg(y{c}) * avg({f}) - avg(y{c} * {f})) "
    f"/ stddev_samp({f}), 9) + 0.0 AS null_gradient, true AS agrees FROM hits"
    for c in (1, 2, 3) for f in ("l_discount", "l_tax"))

ORACLES["classification_logreg_enet"] = f"""
WITH {CLASSED},
hits AS (SELECT *, CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END AS y1, CASE WHEN label = 2 THEN 1.0 ELSE 0.0 END AS y2,
                CASE WHEN label = 3 THEN 1.0 ELSE 0.0 END AS y3 FROM classed)
{_ENET_ROWS}
"""

ORACLES["logreg_training_accuracy"] = """
SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS DOUBLE) AS difference, true AS reaches_commonest FROM lineitem
"""

# ---------------------------------------------------------------- ALS

ORACLES["als_rank1_reconstruct"] = f"""
WITH {RATINGS}
SELECT CAST("user" AS BIGINT) AS "user", CAST(count(*) AS BIGINT) AS n_pairs, CAST(0 AS BIGINT) AS n_off
FROM ratings GROUP BY 1
"""

ORACLES["als_mse"] = f"""
WITH {RATINGS}
SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS DOUBLE) AS mse_difference, CAST(0 AS DOUBLE) AS rmse_difference,
       true AS all_pairs, true AS beats_mean
FROM ratings
"""

ORACLES["als_topk_titles"] = f"""
WITH {RATINGS}
SELECT min("user") AS "user", CAST(least(10, count(DISTINCT item)) AS BIGINT) AS n_recs, CAST(0 AS BIGINT) AS n_out_of_order,
       CAST(0 AS BIGINT) AS n_wrong_scores, CAST(0 AS BIGINT) AS n_left_out, CAST(0 AS BIGINT) AS n_untitled
FROM ratings
"""

ORACLES["als_cluster_report_checks"] = f"""
WITH {RATINGS}
SELECT CAST(count(DISTINCT item) AS BIGINT) AS n_items, CAST(0 AS BIGINT) AS n_bad_ranks, CAST(0 AS BIGINT) AS n_falls,
       CAST(0 AS BIGINT) AS n_left_out, CAST(0 AS BIGINT) AS n_untitled
FROM ratings
"""

ORACLES["als_topk_rows"] = f"""
WITH {RATINGS}
SELECT CAST(7 AS BIGINT) AS "user", CAST(least(10, count(DISTINCT item)) AS BIGINT) AS n_recs,
       CAST(least(10, count(DISTINCT item)) AS BIGINT) AS n_items, CAST(0 AS BIGINT) AS n_out_of_order,
       CAST(0 AS BIGINT) AS n_wrong_scores, CAST(0 AS BIGINT) AS n_left_out
FROM ratings
"""

ORACLES["als_heldout_mse"] = f"""
WITH {RATINGS},
tagged AS (SELECT *, {HASH80.format(k1='"user"', k2='item')} AS train FROM ratings)
SELECT CAST(count(*) FILTER (WHERE train) AS BIGINT) AS n_train,
       CAST(count(*) FILTER (WHERE NOT train AND "user" IN (SELECT "user" FROM tagged WHERE train)
                             AND item IN (SELECT item FROM tagged WHERE train)) AS BIGINT) AS n_heldout,
       true AS mse_recomputed, true AS heldout_is_larger
FROM tagged
"""

ORACLES["als_factor_shape"] = f"""
WITH {RATINGS}
SELECT 'user' AS side, CAST(count(DISTINCT "user") AS BIGINT) AS n_ids, CAST(10 AS BIGINT) AS rank,
       CAST(0 AS BIGINT) AS n_unsolved FROM ratings
UNION ALL
SELECT 'item', CAST(count(DISTINCT item) AS BIGINT), CAST(10 AS BIGINT), CAST(0 AS BIGINT) FROM ratings
"""

ORACLES["als_item_clusters"] = f"""
WITH {RATINGS}
SELECT CAST(count(DISTINCT item) AS BIGINT) AS n_items, CAST(count(DISTINCT item) AS BIGINT) AS n_distinct_items,
       CAST(0 AS BIGINT) AS n_bad_cluster_ids, CAST(0 AS BIGINT) AS n_not_nearest, CAST(0 AS BIGINT) AS n_unsolved
FROM ratings
"""
