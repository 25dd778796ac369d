"""SQL twins of the registered queries, for DuckDB over the same parquet tables.

Written independently of the Spark code: plain SQL with CTEs, exact
``median``, ``row_number`` windows and joins. Doubles are rounded to 6
decimals (+0.0) exactly as ``queries.fin`` does. Long column lists are
generated from the fixed column names below; no logic is shared with the
Spark side.
"""

from __future__ import annotations

# Fixed names of the stand-in feature table (see sources.tables).
KEY = "o_orderkey"
LABEL = "o_totalprice"
NUMERIC = ["avg_disc", "avg_tax", "sum_qty", "returned_qty", "n_supp", "n_lines", "c_acctbal"]
CATEGORIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RATIOS = [
    ("rooms_per_household", "sum_qty", "n_lines"),
    ("population_per_household", "n_supp", "n_lines"),
]
BEDROOMS = ("bedrooms_per_room", "returned_qty", "sum_qty")
INDICATORS = [f"o_orderpriority_{c}" for c in CATEGORIES[1:]]


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


FEATURES = """
li AS (
  SELECT l_orderkey,
         avg(l_discount) AS avg_disc,
         avg(l_tax) AS avg_tax,
         sum(l_quantity) AS sum_qty,
         sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS returned_qty,
         count(DISTINCT l_suppkey) AS n_supp,
         count(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey
),
feat AS (
  SELECT o.o_orderkey, li.avg_disc, li.avg_tax, li.sum_qty, li.returned_qty,
         li.n_supp, li.n_lines, c.c_acctbal, o.o_totalprice, o.o_orderpriority
  FROM orders o
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
hashed AS (
  SELECT *, md5(concat_ws('#', CAST(o_orderkey AS VARCHAR), '42')) AS _h FROM feat
),
flagged AS (
  SELECT * EXCLUDE (_h, _rn, _n), _rn <= ceil(0.25 * _n) AS is_test
  FROM (SELECT *, row_number() OVER (ORDER BY _h, o_orderkey) AS _rn, count(*) OVER () AS _n FROM hashed)
),
train AS (SELECT * EXCLUDE (is_test) FROM flagged WHERE NOT is_test),
test AS (SELECT * EXCLUDE (is_test) FROM flagged WHERE is_test),
med AS (
  SELECT {med} FROM train
),
imp_train AS (
  SELECT t.o_orderkey, t.o_totalprice, t.o_orderpriority, {imp} FROM train t CROSS JOIN med m
),
imp_test AS (
  SELECT t.o_orderkey, t.o_totalprice, t.o_orderpriority, {imp} FROM test t CROSS JOIN med m
),
imp_all AS (
  SELECT f.o_orderkey, f.o_totalprice, f.o_orderpriority, f.is_test, {imp_f} FROM flagged f CROSS JOIN med m
),
sc AS (
  SELECT {sc} FROM imp_train
)
""".format(
    med=", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in NUMERIC),
    imp=", ".join(f"coalesce(CAST(t.{c} AS DOUBLE), m.m_{c}) AS {c}" for c in NUMERIC),
    imp_f=", ".join(f"coalesce(CAST(f.{c} AS DOUBLE), m.m_{c}) AS {c}" for c in NUMERIC),
    sc=", ".join(
        f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}, stddev_pop({c}) AS raw_sd_{c}"
        for c in NUMERIC
    ),
)


def with_base(body: str) -> str:
    return "WITH " + FEATURES.strip() + "\n" + body


def ratio_sql(alias: str, ratios) -> list[str]:
    return [f"{r6(f'{alias}.{n} / nullif({alias}.{d}, 0)')} AS {name}" for name, n, d in ratios]


def scaled_sql(alias: str) -> list[str]:
    return [f"{r6(f'({alias}.{c} - s.mu_{c}) / s.sd_{c}')} AS {c}" for c in NUMERIC]


def indicator_sql(alias: str, cats=CATEGORIES[1:]) -> list[str]:
    return [
        f"CASE WHEN {alias}.o_orderpriority = '{c}' THEN 1.0 ELSE 0.0 END AS {q('o_orderpriority_' + c)}"
        for c in cats
    ]


def prepared_sql(src: str, with_label: bool = True) -> str:
    cols = [f"i.{KEY}"]
    if with_label:
        cols.append(f"{r6('i.' + LABEL)} AS {LABEL}")
    cols += ratio_sql("i", RATIOS) + scaled_sql("i") + indicator_sql("i")
    return f"SELECT {', '.join(cols)} FROM {src} i CROSS JOIN sc s"


def _long(select_parts: list[str]) -> str:
    return "\nUNION ALL\n".join(select_parts)


ORACLES: dict[str, str] = {}

ORACLES["features_base"] = with_base(
    "SELECT o_orderkey, "
    + ", ".join(
        [r6(f"CAST({c} AS DOUBLE)") + f" AS {c}" for c in NUMERIC]
    )
    + f", {r6(LABEL)} AS {LABEL}, o_orderpriority FROM feat"
)

_feat_cols = [KEY, *NUMERIC, LABEL, "o_orderpriority"]
_feat_types = ["bigint", "double", "double", "double", "double", "bigint", "bigint", "double", "double", "string"]
ORACLES["profile_columns"] = with_base(
    _long(
        [
            f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, '{t}' AS data_type, "
            f"count(*) AS n_rows, count({c}) AS n_non_null, count({c}) < count(*) AS has_missing FROM feat"
            for i, (c, t) in enumerate(zip(_feat_cols, _feat_types))
        ]
    )
)


def _digest(src: str) -> str:
    # the data holds no double of 2^43 or more
    toks = []
    for c, t in zip(_feat_cols, _feat_types):
        text = f"length({c}) || ':' || {c}" if t == "string" else f"CAST(CAST(round({c} * 1000000.0) AS BIGINT) AS VARCHAR) || ';'" if t == "double" else f"CAST({c} AS VARCHAR) || ';'"
        toks.append(f"coalesce({text}, '-;')")
    row = " || ".join(toks)
    return (
        f"SELECT count(*) AS num_rows, CAST(count(*) * {len(_feat_cols)} AS BIGINT) AS num_elements, "
        f"CAST(coalesce(sum(CAST(('0x' || substr(md5({row}), 1, 15)) AS BIGINT)::HUGEINT), 0) % 18446744073709551616 AS VARCHAR) AS digest "
        f"FROM {src}"
    )


ORACLES["profile_dataset"] = with_base(
    f"SELECT *, 'training' AS context FROM ({_digest('train')}) UNION ALL SELECT *, 'testing' AS context FROM ({_digest('test')})"
)

_sig_cols = [n for n, _, _ in RATIOS] + NUMERIC + INDICATORS
_prep_train_cte = f", prep_tr AS ({prepared_sql('imp_train')})\n"
ORACLES["schema_signature"] = with_base(
    _prep_train_cte
    + _long(
        [
            f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, 'double' AS data_type, count({q(c)}) = count(*) AS required FROM prep_tr"
            for i, c in enumerate(_sig_cols)
        ]
    )
)

ORACLES["split_approx"] = with_base(
    "SELECT o_orderkey, "
    "CAST(('0x' || substr(md5(concat_ws('#', CAST(o_orderkey AS VARCHAR), '42')), 1, 8)) AS BIGINT) < 1073741824 AS is_test FROM feat"
)
ORACLES["split_exact_sizes"] = with_base("SELECT is_test, count(*) AS n_rows FROM flagged GROUP BY is_test")
ORACLES["split_exact_rows"] = with_base("SELECT o_orderkey, is_test FROM flagged")
ORACLES["kfold_hash"] = with_base(
    "SELECT o_orderkey, CAST(CAST(('0x' || substr(md5(concat_ws('#', CAST(o_orderkey AS VARCHAR), '42')), 9, 8)) AS BIGINT) % 5 AS INTEGER) AS fold FROM train"
)
ORACLES["kfold_ntile"] = with_base(
    "SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM train"
)

ORACLES["impute_median_stats"] = with_base(
    _long([f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, {r6('m_' + c)} AS fill_value FROM med" for i, c in enumerate(NUMERIC)])
)


def _impute_from(stat_cte: str) -> str:
    cols = ", ".join(f"{r6(f'coalesce(CAST(t.{c} AS DOUBLE), s.v_{c})')} AS {c}" for c in NUMERIC)
    return f"{stat_cte}\nSELECT t.o_orderkey, {cols} FROM test t CROSS JOIN st s"


ORACLES["impute_median"] = with_base(
    _impute_from(", st AS (SELECT " + ", ".join(f"m_{c} AS v_{c}" for c in NUMERIC) + " FROM med)")
)
ORACLES["impute_mean"] = with_base(
    _impute_from(", st AS (SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS v_{c}" for c in NUMERIC) + " FROM train)")
)
_mode_ctes = ", ".join(
    f"mode_{c} AS (SELECT CAST({c} AS DOUBLE) AS v FROM train WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 ASC LIMIT 1)"
    for c in NUMERIC
)
ORACLES["impute_mode"] = with_base(
    _impute_from(
        ", "
        + _mode_ctes
        + ", st AS (SELECT "
        + ", ".join(f"(SELECT v FROM mode_{c}) AS v_{c}" for c in NUMERIC)
        + ")"
    )
)
ORACLES["impute_constant"] = with_base(
    _impute_from(", st AS (SELECT " + ", ".join(f"0.0 AS v_{c}" for c in NUMERIC) + ")")
)

ORACLES["ratio_features"] = with_base(f"SELECT i.o_orderkey, {', '.join(ratio_sql('i', RATIOS))} FROM imp_test i")
ORACLES["ratio_features_all"] = with_base(
    f"SELECT i.o_orderkey, {', '.join(ratio_sql('i', RATIOS + [BEDROOMS]))} FROM imp_test i"
)
ORACLES["scaler_stats"] = with_base(
    _long(
        [
            f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, {r6('mu_' + c)} AS mean, {r6('raw_sd_' + c)} AS std FROM sc"
            for i, c in enumerate(NUMERIC)
        ]
    )
)
ORACLES["scale"] = with_base(f"SELECT i.o_orderkey, {', '.join(scaled_sql('i'))} FROM imp_test i CROSS JOIN sc s")
ORACLES["onehot_categories"] = with_base(
    "SELECT 'o_orderpriority' AS column_name, o_orderpriority AS category, "
    "CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS position, "
    "row_number() OVER (ORDER BY o_orderpriority) > 1 AS kept "
    "FROM (SELECT DISTINCT o_orderpriority FROM train WHERE o_orderpriority IS NOT NULL)"
)
ORACLES["onehot"] = with_base(f"SELECT t.o_orderkey, {', '.join(indicator_sql('t'))} FROM test t")
ORACLES["onehot_unknown"] = with_base(
    f"SELECT t.o_orderkey, t.o_orderpriority, {', '.join(indicator_sql('t', CATEGORIES[2:]))} FROM test t"
)
ORACLES["branch_union"] = with_base(prepared_sql("imp_test", with_label=False))
ORACLES["onehot_join"] = with_base(
    f"SELECT i.o_orderkey, {', '.join(scaled_sql('i') + indicator_sql('i'))} FROM imp_test i CROSS JOIN sc s"
)
ORACLES["prep_train"] = with_base(prepared_sql("imp_train"))
ORACLES["prep_test"] = with_base(prepared_sql("imp_test"))
ORACLES["label_reattach"] = with_base(
    f", feats AS ({prepared_sql('imp_test', with_label=False)}), labels AS (SELECT o_orderkey, o_totalprice FROM test)\n"
    f"SELECT f.*, {r6('l.o_totalprice')} AS o_totalprice FROM feats f LEFT JOIN labels l ON f.o_orderkey = l.o_orderkey"
)
_unr = [f"(i.{n} / nullif(i.{d}, 0)) AS {name}" for name, n, d in RATIOS]
_uns = [f"((i.{c} - s.mu_{c}) / s.sd_{c}) AS {c}" for c in NUMERIC]
ORACLES["prep_full_counts"] = with_base(
    f", pa AS (SELECT i.is_test, {', '.join(_unr + _uns + indicator_sql('i'))} FROM imp_all i CROSS JOIN sc s)\n"
    "SELECT is_test, count(*) AS n_rows, "
    + ", ".join([f"{r6(f'avg({n})')} AS avg_{n}" for n, _, _ in RATIOS] + [f"{r6(f'avg({c})')} AS avg_{c}" for c in NUMERIC])
    + ", "
    + ", ".join(f"{r6(f'sum({q(i)})')} AS {q('n_' + i)}" for i in INDICATORS)
    + " FROM pa GROUP BY is_test"
)


# --- metrics, cross-validation and tracking (group-mean stand-in) -----------------

MEAN_GROUPS = [[], ["o_orderpriority"], ["n_lines"], ["o_orderpriority", "n_lines"]]
FOLD_SQL = "CAST(CAST(('0x' || substr(md5(concat_ws('#', CAST(o_orderkey AS VARCHAR), '42')), 9, 8)) AS BIGINT) % 5 AS INTEGER)"


def r4(expr: str) -> str:
    return f"(round({expr}, 4) + 0.0)"


def _cv_ctes(candidates: list[int]) -> str:
    parts = [
        f", cvd AS (SELECT o_orderkey, o_orderpriority, n_lines, o_totalprice / 1000.0 AS y, {FOLD_SQL} AS fold FROM train)",
        ", models AS (SELECT DISTINCT fold AS m FROM cvd)",
        ", fold_mean AS (SELECT md.m, avg(c.y) AS mu FROM models md JOIN cvd c ON c.fold <> md.m GROUP BY md.m)",
    ]
    unions = []
    for i in candidates:
        g = MEAN_GROUPS[i]
        if g:
            gcols = ", ".join(f"c.{x}" for x in g)
            parts.append(f", gm_{i} AS (SELECT md.m, {gcols}, avg(c.y) AS mu FROM models md JOIN cvd c ON c.fold <> md.m GROUP BY md.m, {gcols})")
            on = " AND ".join(f"g.{x} IS NOT DISTINCT FROM c.{x}" for x in g)
            pred = "coalesce(g.mu, gl.mu)"
            join = f"LEFT JOIN gm_{i} g ON g.m = md.m AND {on}"
        else:
            pred, join = "gl.mu", ""
        parts.append(
            f", se_{i} AS (SELECT CAST({i} AS BIGINT) AS candidate_id, md.m AS fold, "
            f"CASE WHEN c.fold = md.m THEN 'test' ELSE 'train' END AS split, (c.y - {pred}) * (c.y - {pred}) AS se "
            f"FROM models md CROSS JOIN cvd c JOIN fold_mean gl ON gl.m = md.m {join})"
        )
        unions.append(f"SELECT * FROM se_{i}")
    parts.append(
        ", scores AS (SELECT candidate_id, fold, split, -avg(se) AS score FROM ("
        + " UNION ALL ".join(unions)
        + ") GROUP BY candidate_id, fold, split)"
    )
    parts.append(
        ", res AS (SELECT candidate_id, "
        "avg(score) FILTER (WHERE split = 'test') AS mean_test_score, "
        "stddev_pop(score) FILTER (WHERE split = 'test') AS std_test_score, "
        "avg(score) FILTER (WHERE split = 'train') AS mean_train_score, "
        "stddev_pop(score) FILTER (WHERE split = 'train') AS std_train_score FROM scores GROUP BY candidate_id)"
    )
    parts.append(", ranked AS (SELECT *, CAST(rank() OVER (ORDER BY mean_test_score DESC) AS BIGINT) AS rank_test_score FROM res)")
    return "\n".join(parts) + "\n"


_CV_ALL = _cv_ctes([0, 1, 2, 3])
_RANKED_COLS = (
    "candidate_id, "
    + ", ".join(f"{r4(c)} AS {c}" for c in ["mean_test_score", "std_test_score", "mean_train_score", "std_train_score"])
    + ", rank_test_score"
)

ORACLES["cv_fold_scores"] = with_base(_CV_ALL + f"SELECT candidate_id, fold, split, {r4('score')} AS score FROM scores")
ORACLES["cv_results_ranked"] = with_base(_CV_ALL + f"SELECT {_RANKED_COLS} FROM ranked")
ORACLES["cv_best"] = with_base(
    _CV_ALL
    + f"SELECT candidate_id, {r4('mean_test_score')} AS mean_test_score, rank_test_score FROM ranked "
    "ORDER BY rank_test_score, candidate_id LIMIT 1"
)
# random search: the two candidates with the smallest md5(id#42), ranked among themselves
ORACLES["random_candidates"] = with_base(
    _CV_ALL
    + ", sampled AS (SELECT * FROM res ORDER BY md5(CAST(candidate_id AS VARCHAR) || '#42') LIMIT 2)\n"
    + f"SELECT {_RANKED_COLS.replace('rank_test_score', 'CAST(rank() OVER (ORDER BY sampled.mean_test_score DESC) AS BIGINT) AS rank_test_score')} FROM sampled"
)


def _mean_model_test(group: list[str], name: str = "scored") -> str:
    if group:
        gcols = ", ".join(group)
        on = " AND ".join(f"gm.{x} IS NOT DISTINCT FROM t.{x}" for x in group)
        return (
            f", {name}_gm AS (SELECT {gcols}, avg(o_totalprice / 1000.0) AS mu FROM train GROUP BY {gcols})"
            f", {name}_gl AS (SELECT avg(o_totalprice / 1000.0) AS mu FROM train)"
            f", {name} AS (SELECT t.*, t.o_totalprice / 1000.0 AS y, coalesce(gm.mu, gl.mu) AS p FROM test t "
            f"LEFT JOIN {name}_gm gm ON {on} CROSS JOIN {name}_gl gl)\n"
        )
    return (
        f", {name}_gl AS (SELECT avg(o_totalprice / 1000.0) AS mu FROM train)"
        f", {name} AS (SELECT t.*, t.o_totalprice / 1000.0 AS y, gl.mu AS p FROM test t CROSS JOIN {name}_gl gl)\n"
    )


_METRIC_SELECT = (
    "count(*) AS n_rows, "
    + r6("avg(abs(y - p))") + " AS mae, "
    + r6("avg((y - p) * (y - p))") + " AS mse, "
    + r6("sqrt(avg((y - p) * (y - p)))") + " AS rmse, "
    + r6(
        "CASE WHEN var_pop(y) * count(*) = 0 THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END "
        "ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END"
    )
    + " AS r2"
)
ORACLES["regression_metrics"] = with_base(_mean_model_test(["o_orderpriority"]) + f"SELECT {_METRIC_SELECT} FROM scored")
ORACLES["regression_metrics_by_group"] = with_base(
    _mean_model_test(["o_orderpriority"]) + f"SELECT o_orderpriority, {_METRIC_SELECT} FROM scored GROUP BY o_orderpriority"
)

ORACLES["linreg_one_feature"] = with_base(
    ", lr AS (SELECT (i.sum_qty - s.mu_sum_qty) / s.sd_sum_qty AS x, i.o_totalprice / 1000.0 AS y FROM imp_train i CROSS JOIN sc s)\n"
    f"SELECT {r6('regr_slope(y, x)')} AS slope, {r6('regr_intercept(y, x)')} AS intercept, {r6('regr_r2(y, x)')} AS r2 FROM lr"
)

_RUN_ID = "md5(concat_ws('/', 'cv-stand-in', 'Group_Mean_' || CAST(candidate_id AS VARCHAR)))"
ORACLES["run_metrics"] = with_base(
    _CV_ALL
    + f"SELECT {_RUN_ID} AS run_id, 'Group_Mean_' || CAST(candidate_id AS VARCHAR) AS run_name, 'mean_test_score' AS key, {r4('mean_test_score')} AS value FROM ranked "
    f"UNION ALL SELECT {_RUN_ID} AS run_id, 'Group_Mean_' || CAST(candidate_id AS VARCHAR) AS run_name, 'std_test_score' AS key, {r4('std_test_score')} AS value FROM ranked"
)
_GROUP_JSON = ["[]", '["o_orderpriority"]', '["n_lines"]', '["o_orderpriority","n_lines"]']
_best = "(SELECT candidate_id FROM ranked ORDER BY rank_test_score, candidate_id LIMIT 1)"
ORACLES["run_params"] = with_base(
    _CV_ALL
    + f", best AS (SELECT {_best} AS candidate_id)\n"
    "SELECT 'Group_Mean_' || CAST(candidate_id AS VARCHAR) AS run_name, 'param' AS kind, 'folds' AS key, '5' AS value FROM best "
    "UNION ALL SELECT 'Group_Mean_' || CAST(candidate_id AS VARCHAR), 'param', 'group_by', CASE candidate_id "
    + " ".join(f"WHEN {i} THEN '{j}'" for i, j in enumerate(_GROUP_JSON))
    + " END FROM best "
    "UNION ALL SELECT 'Group_Mean_' || CAST(candidate_id AS VARCHAR), 'tag', 'label', 'price_k' FROM best "
    "UNION ALL SELECT 'Group_Mean_' || CAST(candidate_id AS VARCHAR), 'tag', 'best_run', 'true' FROM best"
)

_eval_parts = []
_eval_ctes = ""
for _i, _g in enumerate(MEAN_GROUPS):
    _eval_ctes += _mean_model_test(_g, f"sc{_i}")
    _eval_parts.append(f"SELECT CAST({_i} AS BIGINT) AS candidate_id, {_METRIC_SELECT} FROM sc{_i}")
ORACLES["run_tree"] = with_base(
    _CV_ALL
    + _eval_ctes
    + ", evals AS (" + " UNION ALL ".join(_eval_parts) + ")\n"
    + f", best AS (SELECT * FROM ranked ORDER BY rank_test_score, candidate_id LIMIT 1)\n"
    ", ev AS (SELECT e.* FROM evals e JOIN best b ON e.candidate_id = b.candidate_id)\n"
    "SELECT 'Parent run' AS run_name, CAST(NULL AS VARCHAR) AS parent_run_name, CAST(NULL AS VARCHAR) AS key, CAST(NULL AS DOUBLE) AS value "
    "UNION ALL SELECT 'data_ingestion_and_preprocessing', 'Parent run', NULL, NULL "
    f"UNION ALL SELECT 'Group_Mean_best_model', 'Parent run', 'neg_mean_squared_error', {r4('mean_test_score')} FROM best "
    f"UNION ALL SELECT 'evaluation', 'Parent run', 'mean_absolute_error', {r4('mae')} FROM ev "
    f"UNION ALL SELECT 'evaluation', 'Parent run', 'root_mean_squared_error', {r4('rmse')} FROM ev "
    f"UNION ALL SELECT 'evaluation', 'Parent run', 'r_squared', {r4('r2')} FROM ev"
)
ORACLES["input_example"] = with_base(
    _prep_train_cte
    + "SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS _rn FROM prep_tr) WHERE _rn IN (1, 51, 101)"
)

ORACLES["ols_predict_one_feature"] = with_base(
    ", lr AS (SELECT (i.sum_qty - s.mu_sum_qty) / s.sd_sum_qty AS x, i.o_totalprice / 1000.0 AS y FROM imp_train i CROSS JOIN sc s)\n"
    ", fit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM lr)\n"
    f"SELECT i.o_orderkey, {r6('f.a + f.b * ((i.sum_qty - s.mu_sum_qty) / s.sd_sum_qty)')} AS prediction "
    "FROM imp_test i CROSS JOIN sc s CROSS JOIN fit f"
)

ORACLES["kfold_ols_one_feature"] = with_base(
    f", cvo AS (SELECT {FOLD_SQL} AS fold, (i.sum_qty - s.mu_sum_qty) / s.sd_sum_qty AS x, i.o_totalprice / 1000.0 AS y "
    "FROM imp_train i CROSS JOIN sc s)\n"
    ", models AS (SELECT DISTINCT fold AS m FROM cvo)\n"
    ", fits AS (SELECT md.m, regr_slope(c.y, c.x) AS b, regr_intercept(c.y, c.x) AS a FROM models md JOIN cvo c ON c.fold <> md.m GROUP BY md.m)\n"
    ", errs AS (SELECT f.m AS fold, c.fold = f.m AS is_test, (c.y - f.a - f.b * c.x) * (c.y - f.a - f.b * c.x) AS se FROM fits f CROSS JOIN cvo c)\n"
    "SELECT fold, count(*) FILTER (WHERE is_test) AS n_test, count(*) FILTER (WHERE NOT is_test) AS n_train, "
    f"{r4('avg(se) FILTER (WHERE is_test)')} AS test_mse, {r4('avg(se) FILTER (WHERE NOT is_test)')} AS train_mse "
    "FROM errs GROUP BY fold"
)

# an uncapped tree over few values predicts the group's mean; so does a forest of such trees.
# Splits lie midway between values, so a value that the training part lacks goes to the nearest one (the lower of two).
ORACLES["tree_one_feature"] = ORACLES["forest_one_feature"] = with_base(
    ", g AS (SELECT n_lines, avg(o_totalprice / 1000.0) AS m FROM imp_train GROUP BY n_lines)\n"
    ", near AS (SELECT v.n_lines, arg_min(g.m, abs(g.n_lines - v.n_lines) + g.n_lines * 1e-6) AS m FROM (SELECT DISTINCT n_lines FROM imp_test) v CROSS JOIN g GROUP BY v.n_lines)\n"
    f"SELECT i.o_orderkey, {r6('near.m')} AS prediction FROM imp_test i JOIN near ON i.n_lines = near.n_lines"
)

# statistics of each fold's complement, and rows prepared by them
_by_fold = (
    ", tf AS (SELECT *, ('0x' || substr(md5(concat_ws('#', CAST(o_orderkey AS VARCHAR), '42')), 9, 8))::BIGINT % 5 AS fold FROM train)\n"
    ", med_f AS (SELECT k, " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in NUMERIC) + " FROM range(0, 5) r(k) JOIN tf ON tf.fold <> r.k GROUP BY k)\n"
    ", imp_f AS (SELECT m.k, t.o_orderkey, t.fold, t.o_totalprice, t.o_orderpriority, "
    + ", ".join(f"coalesce(CAST(t.{c} AS DOUBLE), m.m_{c}) AS {c}" for c in NUMERIC)
    + " FROM tf t CROSS JOIN med_f m)\n"
    ", sc_f AS (SELECT k, " + ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in NUMERIC) + " FROM imp_f WHERE fold <> k GROUP BY k)\n"
)
ORACLES["fold_prep_stats"] = with_base(
    _by_fold
    + _long([f"SELECT CAST(k AS INTEGER) AS fold, '{c}' AS column_name, round(m_{c}, 5) + 0.0 AS median, round(mu_{c}, 5) + 0.0 AS mean, round(sd_{c}, 5) + 0.0 AS std FROM med_f JOIN sc_f USING (k)" for c in NUMERIC])
)
ORACLES["fold_prep_rows"] = with_base(
    _by_fold
    + f"SELECT i.o_orderkey, round(i.o_totalprice, 5) + 0.0 AS {LABEL}, CAST(i.fold AS INTEGER) AS fold, "
    + ", ".join(
        [f"round(i.{n} / nullif(i.{d}, 0), 5) + 0.0 AS {name}" for name, n, d in RATIOS]
        + [f"round((i.{c} - s.mu_{c}) / s.sd_{c}, 5) + 0.0 AS {c}" for c in NUMERIC]
        + indicator_sql("i")
    )
    + " FROM imp_f i JOIN sc_f s ON s.k = i.k WHERE i.fold = i.k"
)

# least squares with every feature: normal equations of centred columns, solved by elimination row by row
_OLS = [x[0] for x in RATIOS] + NUMERIC + INDICATORS


def _ols_sql(rows: str, part: str) -> str:
    """``rows`` (fold, is_part per model k, features, label) -> CTEs up to ``beta`` (k, b DOUBLE[], means) and the shared row list."""
    p = len(_OLS)
    cols = [q(c) for c in _OLS] + [LABEL]
    means = ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(cols))
    dev = ", ".join(f"{c} - m{i} AS d{i}" for i, c in enumerate(cols))
    gram = ", ".join("[" + ", ".join(f"sum(d{i} * d{j})" for j in range(p + 1)) + "]" for i in range(p))
    return (
        f", mu AS (SELECT k, {means} FROM {rows} WHERE {part} GROUP BY k)\n"
        f", dev AS (SELECT r.k, {dev} FROM {rows} r JOIN mu USING (k) WHERE {part})\n"
        f", gram AS (SELECT k, [{gram}] AS g FROM dev GROUP BY k)\n"
        ", solved AS (SELECT k, 1 AS step, g FROM gram UNION ALL SELECT k, step + 1, "
        "list_transform(range(1, len(g) + 1), lambda i: CASE WHEN i = step THEN list_transform(g[i], lambda x: x / g[step][step]) "
        "ELSE list_transform(range(1, len(g[i]) + 1), lambda j: g[i][j] - g[i][step] * g[step][j] / g[step][step]) END) "
        f"FROM solved WHERE step <= {p})\n"
        f", beta AS (SELECT k, list_transform(g, lambda r: r[{p + 1}]) AS b, [{', '.join(f'm{i}' for i in range(p + 1))}] AS m FROM solved JOIN mu USING (k) WHERE step = {p + 1})\n"
    )


def _ols_guess(alias: str) -> str:
    return f"b.m[{len(_OLS) + 1}]" + "".join(f" + b.b[{i + 1}] * ({alias}.{q(c)} - b.m[{i + 1}])" for i, c in enumerate(_OLS))


def _raw_prepared(src: str, extra: str) -> str:
    cols = [f"i.{n} / nullif(i.{d}, 0) AS {name}" for name, n, d in RATIOS] + [f"(i.{c} - s.mu_{c}) / s.sd_{c} AS {c}" for c in NUMERIC] + indicator_sql("i")
    return f"SELECT {extra}, i.{KEY}, i.{LABEL}, {', '.join(cols)} FROM {src} i CROSS JOIN sc s"


ORACLES["fit_ols_predict"] = with_base(
    f", tr AS ({_raw_prepared('imp_train', '0 AS k')}), te AS ({_raw_prepared('imp_test', '0 AS k')})\n"
    + _ols_sql("tr", "TRUE")
    + f"SELECT t.{KEY}, round({_ols_guess('t')}, 3) + 0.0 AS prediction FROM te t JOIN beta b USING (k)"
).replace("WITH ", "WITH RECURSIVE ", 1)
ORACLES["kfold_ols"] = with_base(
    f", base AS ({_raw_prepared('imp_train', FOLD_SQL.replace('fold', 'fold') + ' AS fold')}), tr AS (SELECT r.k, base.* FROM base CROSS JOIN range(0, 5) r(k))\n"
    + _ols_sql("tr", "fold <> k")
    + f", off AS (SELECT t.k, t.fold = t.k AS is_test, t.{LABEL} - ({_ols_guess('t')}) AS e FROM tr t JOIN beta b USING (k))\n"
    "SELECT CAST(k AS INTEGER) AS fold, count(*) FILTER (WHERE is_test) AS n_test, count(*) FILTER (WHERE NOT is_test) AS n_train, "
    "round(avg(e * e) FILTER (WHERE is_test), 0) + 0.0 AS test_mse, round(avg(e * e) FILTER (WHERE NOT is_test), 0) + 0.0 AS train_mse FROM off GROUP BY k"
).replace("WITH ", "WITH RECURSIVE ", 1)

EXACT_FEATURES = ["sum_qty", "returned_qty", "n_supp", "n_lines", "c_acctbal"]


def _mix32(x: str) -> str:
    """The 32-bit mixing function that draws features and bootstrap weights."""
    keep = "& 4294967295::UBIGINT"
    return (
        f"list_reduce([({x})::UBIGINT, 0::UBIGINT, 1::UBIGINT, 2::UBIGINT], lambda a, s: CASE s "
        f"WHEN 0 THEN (xor(a, a >> 16) * 2146121005::UBIGINT) {keep} WHEN 1 THEN (xor(a, a >> 15) * 2221713035::UBIGINT) {keep} ELSE xor(a, a >> 16) END)"
    )


def forest_sql(n_trees: int, max_features: int, bootstrap: bool, seed: int) -> str:
    """An uncapped forest grown in SQL, level by level: every row of every tree moves to its node's child until the node's labels agree."""
    feats = ", ".join(EXACT_FEATURES)
    bag = f"(SELECT count(*) FROM poisson c WHERE c.p <= {_mix32('xor(kh, ' + _mix32('root') + ')')} / 4294967296.0::DOUBLE)::DOUBLE" if bootstrap else "1.0::DOUBLE"
    return with_base(f"""
, poisson AS (SELECT sum(exp(-1.0::DOUBLE) / f) OVER (ORDER BY k) AS p FROM (SELECT k, CASE WHEN k = 0 THEN 1 ELSE list_product(range(1, k + 1)) END::DOUBLE AS f FROM range(0, 12) r(k)))
, names AS (SELECT number, {_mix32(f'xor({_mix32(str(seed))}, number::UBIGINT)')} AS root FROM range(0, {n_trees}) t(number))
, every AS (SELECT o_orderkey, o_totalprice, 1 AS used, [{feats}]::DOUBLE[] AS x FROM imp_train UNION ALL SELECT o_orderkey, o_totalprice, 0, [{feats}]::DOUBLE[] FROM imp_test)
, begin AS (SELECT n.number, n.root, e.o_orderkey, e.used, e.x, round(e.o_totalprice * 100) AS y, ('0x' || substr(md5(e.o_orderkey || '#0'), 1, 8))::UBIGINT AS kh FROM every e, names n)
, grown AS (
  SELECT number, 0 AS level, '' AS node, root AS h, o_orderkey, used * {bag} AS w, y, x FROM begin
  UNION ALL
  SELECT g.number, g.level + 1, g.node || CASE WHEN g.x[b.f] > b.cut THEN 'r' ELSE 'l' END,
         {_mix32("xor(g.h, CASE WHEN g.x[b.f] > b.cut THEN 2246822507::UBIGINT ELSE 2654435769::UBIGINT END)")}, g.o_orderkey, g.w, g.y, g.x
  FROM grown g JOIN (
    SELECT number, node, arg_max({{'f': f, 'cut': v + (nv - v) * 0.5}}, {{'g': gain, 'f': -f, 'v': -v}}) AS best FROM (
      SELECT number, node, f, v, nv, sl * sl / wl + (s - sl) * (s - sl) / (w - wl) AS gain FROM (
        SELECT *, dense_rank() OVER (PARTITION BY number, node ORDER BY lot) AS place FROM (
          SELECT number, node, h, f, v, lead(v) OVER u AS nv, sum(w) OVER u AS wl, sum(s) OVER u AS sl,
                 sum(w) OVER (PARTITION BY number, node, f) AS w, sum(s) OVER (PARTITION BY number, node, f) AS s,
                 count(*) OVER (PARTITION BY number, node, f) AS n_values, {_mix32(f"xor(h, {_mix32('f::UBIGINT')})")} AS lot
          FROM (SELECT number, node, h, f, x[f] AS v, sum(w) AS w, sum(w * y) AS s
                FROM (SELECT *, min(y) OVER p <> max(y) OVER p AS differ FROM grown WHERE w > 0 WINDOW p AS (PARTITION BY number, node)), range(1, {len(EXACT_FEATURES) + 1}) c(f)
                WHERE differ GROUP BY ALL)
          WINDOW u AS (PARTITION BY number, node, f ORDER BY v)) WHERE n_values > 1)
      WHERE nv IS NOT NULL AND place <= {max_features}) GROUP BY number, node) a ON a.number = g.number AND a.node = g.node, LATERAL (SELECT a.best.f AS f, a.best.cut AS cut) b
)
, means AS (SELECT number, level, node, sum(w * y) / sum(w) AS mean FROM grown GROUP BY number, level, node)
, guess AS (SELECT g.number, g.o_orderkey, arg_max(m.mean, g.level) AS v FROM grown g JOIN means m ON m.number = g.number AND m.level = g.level AND m.node = g.node WHERE g.o_orderkey IN (SELECT o_orderkey FROM test) GROUP BY g.number, g.o_orderkey)
SELECT o_orderkey, round(avg(v) / 100, 4) + 0.0 AS prediction FROM guess GROUP BY o_orderkey""").replace("WITH ","WITH RECURSIVE ",1)


ORACLES["tree_exact"] = forest_sql(1, len(EXACT_FEATURES), False, 42)
ORACLES["forest_exact"] = forest_sql(3, 2, True, 42)

# least squares leaves residuals that are orthogonal to every feature
ORACLES["ols_residuals"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 0.0::DOUBLE AS mean_product" for c in [x[0] for x in RATIOS] + NUMERIC + INDICATORS
)

ORACLES["model_roundtrip_equal"] = with_base("SELECT count(*) AS n_rows, count(*) AS n_equal FROM test")


# --- sources, roles, matrices, scoring folders and run records ---------------------------

ORACLES["csv_roundtrip"] = ORACLES["features_base"]
_prep_cols = ", ".join([KEY, *[n for n, _, _ in RATIOS], *NUMERIC, *[q(i) for i in INDICATORS]])
ORACLES["prepared_roundtrip"] = with_base(
    f", a AS ({prepared_sql('imp_train')}), b AS ({prepared_sql('imp_test', with_label=False)})\n"
    f"SELECT {_prep_cols}, {LABEL}, 'train' AS part FROM a UNION ALL SELECT {_prep_cols}, CAST(NULL AS DOUBLE), 'test' FROM b"
)
ORACLES["land_once"] = "SELECT o_orderkey, o_totalprice FROM orders"
_roles = {KEY: "key", LABEL: "label", "o_orderpriority": "categorical"}
ORACLES["roles_by_schema"] = with_base(
    _long(
        [
            f"SELECT '{c}' AS column_name, '{_roles.get(c, 'numeric')}' AS role, {c in NUMERIC} AS numeric_type, count({c}) AS n_non_null FROM feat"
            for c in _feat_cols
        ]
    )
)
_matrix = [f"coalesce({r6(f'i.{n} / nullif(i.{d}, 0)')}, 0.0)" for _, n, d in RATIOS]
_matrix += [r6(f"(i.{c} - s.mu_{c}) / s.sd_{c}") for c in NUMERIC]
_matrix += [f"CASE WHEN i.o_orderpriority = '{c}' THEN 1.0 ELSE 0.0 END" for c in CATEGORIES[1:]]
ORACLES["vector_matrix"] = with_base(
    _long([f"SELECT i.{KEY}, CAST({k} AS INTEGER) AS position, CAST({x} AS DOUBLE) AS value FROM imp_test i CROSS JOIN sc s" for k, x in enumerate(_matrix)])
)
ORACLES["onehot_sparse"] = """
WITH fit AS (SELECT * FROM orders WHERE o_orderstatus = 'O'),
     a AS (SELECT v, row_number() OVER (ORDER BY v) - 2 AS p FROM (SELECT DISTINCT o_orderpriority AS v FROM fit WHERE o_orderpriority IS NOT NULL)),
     b AS (SELECT v, row_number() OVER (ORDER BY v) - 2 AS p FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS v FROM fit WHERE o_custkey IS NOT NULL)),
     na AS (SELECT greatest(count(*) - 1, 0) AS n FROM a), nb AS (SELECT greatest(count(*) - 1, 0) AS n FROM b)
SELECT o.o_orderkey, na.n + nb.n AS n_dims,
       concat_ws(',', CASE WHEN a.p >= 0 THEN CAST(a.p AS VARCHAR) END, CASE WHEN b.p >= 0 THEN CAST(na.n + b.p AS VARCHAR) END) AS ones
FROM orders o LEFT JOIN a ON a.v = o.o_orderpriority LEFT JOIN b ON b.v = CAST(o.o_custkey AS VARCHAR) CROSS JOIN na CROSS JOIN nb
"""
ORACLES["grid_candidates"] = with_base(
    f", f AS (SELECT {FOLD_SQL} AS fold, count(*) AS n FROM train GROUP BY 1)\n"
    ", c AS (SELECT row_number() OVER (ORDER BY bi, fi, ei) - 1 AS candidate_id, "
    """'{"bootstrap": ' || b || ', "max_features": ' || m || ', "n_estimators": ' || e || '}' AS params """
    "FROM (VALUES (0, 'true'), (1, 'false')) x(bi, b) CROSS JOIN (VALUES (0, 2), (1, 6)) y(fi, m) CROSS JOIN (VALUES (0, 3), (1, 10)) z(ei, e))\n"
    "SELECT candidate_id, params, fold, CAST((SELECT sum(n) FROM f) - n AS BIGINT) AS n_train, n AS n_test FROM c CROSS JOIN f"
)
ORACLES["train_metrics"] = with_base(
    ", gm AS (SELECT o_orderpriority, avg(o_totalprice / 1000.0) AS mu FROM train GROUP BY o_orderpriority)"
    ", scored AS (SELECT t.o_totalprice / 1000.0 AS y, gm.mu AS p FROM train t JOIN gm ON gm.o_orderpriority IS NOT DISTINCT FROM t.o_orderpriority)\n"
    f"SELECT {_METRIC_SELECT} FROM scored"
)
ORACLES["score_models_tables"] = (
    f"SELECT 'Decision_tree' AS model, o_orderkey, prediction FROM ({ORACLES['tree_one_feature']}) "
    f"UNION ALL SELECT 'Linear_Regression', o_orderkey, prediction FROM ({ORACLES['ols_predict_one_feature']})"
)
ORACLES["experiment_upsert"] = "SELECT DISTINCT substr(md5(o_orderpriority), 1, 18) AS experiment_id, o_orderpriority AS name FROM orders WHERE o_orderpriority IS NOT NULL"
ORACLES["run_inputs"] = with_base(
    _long(
        [
            f"SELECT '{run}' AS run_name, '{context}' AS context, '{context}' AS name, num_rows, num_elements, digest, '{LABEL}' AS targets FROM ({_digest(part)})"
            for run, context, part in (("data_ingestion_and_preprocessing", "training", "train"), ("evaluation", "testing", "test"))
        ]
    )
)
ORACLES["run_durations"] = with_base(
    "SELECT 'Parent run' AS run_name, CAST(NULL AS VARCHAR) AS parent_run_name, 'FINISHED' AS status, TRUE AS times_fit, CAST(2 AS BIGINT) AS n_children, CAST(NULL AS DOUBLE) AS n_rows "
    "UNION ALL SELECT 'data_ingestion_and_preprocessing', 'Parent run', 'FINISHED', TRUE, 0, count(*)::DOUBLE FROM train "
    "UNION ALL SELECT 'evaluation', 'Parent run', 'FINISHED', TRUE, 0, count(*)::DOUBLE FROM test"
)


# --- inferred types, signature rules, run states, draws -----------------------------------

_csv_sums = "count(n_lines)::DOUBLE AS n_lines, round(sum(CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 0.5 ELSE o_orderkey % 7 END), 3) AS half, count(o_orderpriority)::DOUBLE AS quoted"
ORACLES["csv_inferred"] = with_base(
    _long(
        [
            f"SELECT CAST({k} AS BIGINT) AS position, '{c}' AS column_name, {t} AS data_type, s.* FROM (SELECT {_csv_sums} FROM feat) s"
            for k, (c, t) in enumerate(
                [
                    (KEY, "'bigint'"), ("n_lines", "'bigint'"),
                    ("c_acctbal", "(SELECT CASE WHEN count(*) FILTER (WHERE c_acctbal <> floor(c_acctbal)) > 0 THEN 'double' ELSE 'bigint' END FROM feat)"),
                    ("quoted", "'string'"), ("half", "'double'"), ("blank", "'string'"), ("even", "'boolean'"),
                ]
            )
        ]
    )
)
_urgent = "o_orderpriority = '1-URGENT'"
ORACLES["signature_violations"] = with_base(
    _long(
        [
            f"SELECT '{c}' AS column_name, '{rule}' AS rule, count(*) AS n_rows FROM feat WHERE {cond}"
            for c, rule, cond in [
                (KEY, "required", "o_orderkey IS NULL"), ("avg_tax", "missing", "TRUE"), ("sum_qty", "required", "sum_qty IS NULL"),
                ("n_supp", "type", _urgent), ("n_lines", "required", "n_lines IS NULL"),
                ("", "kept", f"NOT coalesce({_urgent}, FALSE) AND sum_qty IS NOT NULL"), ("", "set apart", f"{_urgent} OR sum_qty IS NULL"),
            ]
        ]
    )
)
ORACLES["run_states"] = (
    "SELECT o_orderpriority AS run_name, CASE o_orderpriority WHEN '2-HIGH' THEN 'FAILED' WHEN '5-LOW' THEN 'RUNNING' ELSE 'FINISHED' END AS status, "
    "o_orderpriority <> '5-LOW' AS ended, count(*) AS n_rows FROM orders GROUP BY o_orderpriority"
)


def _drawn(name: str) -> str:
    return f"(('0x' || substr(md5(draw || '#{name}#42'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


ORACLES["random_search_draws"] = (
    "WITH d AS (SELECT draw, floor(" + _drawn("group_by") + " * 4)::BIGINT AS candidate_id, 3 + floor(" + _drawn("depth") + " * 10)::BIGINT AS depth, "
    "round(exp(ln(0.001) + " + _drawn("rate") + " * (ln(1.0) - ln(0.001))), 4) AS rate, round(0.2 + " + _drawn("share") + " * 0.6, 4) AS share FROM range(0, 8) t(draw)) "
    f"SELECT d.draw, d.candidate_id, d.depth, d.rate, d.share, c.mean_test_score FROM d JOIN ({ORACLES['cv_results_ranked']}) c USING (candidate_id)"
)


ORACLES["train_models_saved"] = with_base(
    _long([f"SELECT '{m}' AS model, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys FROM test" for m in ("Decision_tree", "Linear_Regression", "Random_Forest_untuned", "model")])
)
ORACLES["pipeline_files"] = with_base(
    "SELECT 'raw train' AS what, count(*) AS n_rows FROM train UNION ALL SELECT 'raw test', count(*) FROM test "
    "UNION ALL SELECT 'cv table', 2 UNION ALL SELECT 'input example', least(3, 1 + (count(*) - 1) // 50) FROM train "
    "UNION ALL SELECT 'label sum train', CAST(round(sum(o_totalprice)) AS BIGINT) FROM train UNION ALL SELECT 'label sum test', CAST(round(sum(o_totalprice)) AS BIGINT) FROM test"
)
