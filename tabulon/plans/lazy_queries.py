"""Queries of the K family."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions.scale import cut_lineage
from tabulon.operators import compare, lazy, neighbours, reduce
from tabulon.plans.registry import load, query, rnd, rounded


def vectors(spark, sf):
    return load(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), "label",
        F.pmod("vec_id", F.lit(10)).cast("int").alias("fold"))


_KW = {"key": "id", "features": "x", "label": "label"}

_DIST = {1: "list_sum(list_transform(list_zip(a.x, b.x), lambda p: abs(p[1] - p[2])))",
         2: "list_distance(a.x, b.x)",
         3: "pow(list_sum(list_transform(list_zip(a.x, b.x), lambda p: pow(abs(p[1] - p[2]), 3))), 1/3.0)"}


def near_cte(name, k, r=2, on="a.fold <> b.fold", train="e", test="e"):
    return f"""{name} AS MATERIALIZED (SELECT * FROM (SELECT a.id AS test_id, b.id AS train_id, b.label AS label, a.label AS truth, a.fold AS fold,
  round({_DIST[r]}, 9) AS distance, row_number() OVER (PARTITION BY a.id ORDER BY round({_DIST[r]}, 9), b.id)::INTEGER AS rank
  FROM {test} a JOIN {train} b ON {on}) WHERE rank <= {k})"""


_E = "WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS x, label, (vec_id % 10)::INTEGER AS fold FROM embeddings), "


def majority_sql(source, k, tie="min(rank)", cols=""):
    return (f"SELECT test_id, {cols} arg_min(label, (-v, t)) AS predicted FROM (SELECT test_id, {cols} label, count(*) AS v, {tie.replace('rank', 'rank')} AS t "
            f"FROM {source} WHERE rank <= {k} GROUP BY test_id, {cols} label) GROUP BY test_id" + (f", {cols.rstrip(', ')}" if cols else ""))


def plurality_sql(source, k):
    return f"""SELECT test_id, arg_max(label, prefix) AS predicted FROM (
SELECT test_id, prefix, max(v) AS top, arg_max(label, v) AS label, count(*) AS classes, list(v ORDER BY v DESC)[2] AS second FROM (
  SELECT test_id, prefix, label, count(*) AS v FROM {source}, (SELECT unnest(range(1, {k + 1})) AS prefix) WHERE rank <= prefix GROUP BY ALL)
GROUP BY 1, 2) WHERE classes = 1 OR top > second GROUP BY 1"""


@query("k1_knn", _E + near_cte("n", 5) + " SELECT test_id, rank, train_id, round(distance, 6) AS distance, label FROM n")
def _(spark, sf):
    e = vectors(spark, sf)
    return rounded(neighbours.knn(e, e, 5, 2, exclude="fold", pivots=24, **_KW), 6, "distance")


@query("k1_knn_manhattan", _E + near_cte("n", 3, 1) + " SELECT test_id, rank, train_id, round(distance, 6) AS distance, label FROM n")
def _(spark, sf):
    e = vectors(spark, sf)
    return rounded(neighbours.knn(e, e, 3, 1, exclude="fold", **_KW), 6, "distance")


@query("k1_knn_cubic", _E + near_cte("n", 3, 3, "a.id <> b.id") + " SELECT test_id, rank, train_id, round(distance, 6) AS distance, label FROM n")
def _(spark, sf):
    e = vectors(spark, sf)
    return rounded(neighbours.knn(e, e, 3, 3, exclude="id", **_KW), 6, "distance")


@query("k1_knn_parts", """
WITH p AS (SELECT p_partkey AS id, p_size::DOUBLE AS a, p_retailprice AS b, p_type AS label FROM part)
SELECT test_id, rank, train_id, round(distance, 6) AS distance, label FROM (
SELECT x.id AS test_id, y.id AS train_id, y.label AS label, round(sqrt(pow(x.a - y.a, 2) + pow(x.b - y.b, 2)), 9) AS distance,
  row_number() OVER (PARTITION BY x.id ORDER BY round(sqrt(pow(x.a - y.a, 2) + pow(x.b - y.b, 2)), 9), y.id)::INTEGER AS rank
FROM p x JOIN p y ON x.id <> y.id) WHERE rank <= 4""")
def _(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("a"),
                                       F.col("p_retailprice").alias("b"), "p_type")
    out = neighbours.knn(p, p, 4, 2, key="p_partkey", features=["a", "b"], label="p_type", exclude="p_partkey",
                         pivots=16, block_rows=256)
    return rounded(out, 6, "distance")


@query("k2_vote_majority", _E + near_cte("n", 5) + majority_sql("n", 5))
def _(spark, sf):
    e = vectors(spark, sf)
    return neighbours.vote_majority(neighbours.knn(e, e, 5, 2, exclude="fold", **_KW), 5)


@query("k3_vote_majority_label", _E + near_cte("n", 5) + majority_sql("n", 5, "label"))
def _(spark, sf):
    e = vectors(spark, sf)
    return neighbours.vote_majority_label(neighbours.knn(e, e, 5, 2, exclude="fold", **_KW), 5)


@query("k4_vote_plurality", _E + near_cte("n", 5) + plurality_sql("n", 5))
def _(spark, sf):
    e = vectors(spark, sf)
    return neighbours.vote_plurality(neighbours.knn(e, e, 5, 2, exclude="fold", **_KW), 5)


@query("k5_retention", _E + near_cte("n", 5) + ", p AS (" + majority_sql("n", 5) + """),
d AS (SELECT test_id, (sum(c) - max(c)) / (9.0::DOUBLE * max(c)) AS disagreement FROM (SELECT test_id, label, count(*) AS c FROM n GROUP BY 1, 2) GROUP BY 1)
SELECT e.id AS test_id, policy, round(disagreement, 6) AS disagreement, CASE policy WHEN 'nr' THEN false WHEN 'ar' THEN true
  WHEN 'df' THEN predicted <> label ELSE disagreement >= 0.5 END AS retain
FROM e JOIN p ON p.test_id = e.id JOIN d ON d.test_id = e.id, (SELECT unnest(['nr', 'ar', 'df', 'dd']) AS policy)""")
def _(spark, sf):
    e = vectors(spark, sf)
    near = neighbours.knn(e, e, 5, 2, exclude="fold", **_KW)
    cases = (e.select(F.col("id").alias("test_id"), "label").join(neighbours.vote_majority(near, 5), "test_id")
             .join(lazy.disagreement(near, 10), "test_id")
             .withColumn("policy", F.explode(F.array(*map(F.lit, lazy.POLICIES)))))
    return rounded(lazy.retention(cases).select("test_id", "policy", "disagreement", "retain"), 6, "disagreement")


_HALF = "SELECT * FROM e WHERE x[1] {op} (SELECT avg(x[1]) FROM e)"


def _halves(spark, sf):
    """Training and test part: both sides of the mean of the first cell."""
    e = vectors(spark, sf)
    cut = e.agg(F.avg(F.get("x", F.lit(0)))).first()[0]
    return e.where(F.get("x", F.lit(0)) < cut), e.where(F.get("x", F.lit(0)) >= cut)


_HALF_E = _E + f"tr AS ({_HALF.format(op='<')}), te AS ({_HALF.format(op='>=')}), "


@query("k6_ibl_run_never", _HALF_E + near_cte("n", 3, 2, "true", "tr", "te") + ", p AS (" + majority_sql("n", 3)
       + ") SELECT id AS test_id, label, predicted FROM te JOIN p ON test_id = id")
def _(spark, sf):
    train, test = _halves(spark, sf)
    return lazy.ibl_run(train, test, k=3, policy="nr", **_KW).select("test_id", "label", "predicted")


# with policy "ar" a case sees the training part and all cases of earlier batches
@query("k6_ibl_run_always", _HALF_E + "b AS (SELECT *, ntile(3) OVER (ORDER BY id) - 1 AS batch FROM te), u AS (SELECT *, -1 AS batch FROM tr UNION ALL SELECT * FROM b), "
       + near_cte("n", 3, 2, "b.batch < a.batch", "u", "b") + ", p AS (" + majority_sql("n", 3)
       + ") SELECT id AS test_id, label, predicted, batch::INTEGER AS batch FROM b JOIN p ON test_id = id")
def _(spark, sf):
    train, test = _halves(spark, sf)
    return lazy.ibl_run(train, test, k=3, policy="ar", batches=3, **_KW).select("test_id", "label", "predicted", "batch")


@query("k6_ibl_run_disagreement")
def _(spark, sf):
    train, test = _halves(spark, sf)
    return lazy.ibl_run(train, test, k=3, policy="dd", batches=3, **_KW)


_KS, _RS = (1, 3, 5, 7), (1, 2, 3)
_GRID = ", ".join(near_cte(f"n{r}", 7, r) for r in _RS) + "".join(
    f", m{r}_{k} AS ({majority_sql(f'n{r}', k)}), q{r}_{k} AS ({plurality_sql(f'n{r}', k)})" for r in _RS for k in _KS)
_GRID_ROWS = " UNION ALL ".join(
    f"SELECT {k} AS k, {r} AS r, '{v}' AS vote, fold, avg((predicted = e.label)::INTEGER) AS accuracy FROM e JOIN {t}{r}_{k} ON test_id = id GROUP BY fold"
    for r in _RS for k in _KS for v, t in (("most_voted", "m"), ("plurality", "q")))


def _grid(spark, sf, policies=("nr",)):
    return lazy.grid_run(vectors(spark, sf), **_KW, policies=policies)


@query("k7_grid_run", _E + _GRID + f" SELECT k, r, vote, fold, round(accuracy, 6) AS accuracy FROM ({_GRID_ROWS})")
def _(spark, sf):
    return rounded(_grid(spark, sf).select("k", "r", "vote", "fold", "accuracy"), 6, "accuracy")


@query("k7_grid_run_growing")
def _(spark, sf):
    return _grid(spark, sf, lazy.POLICIES)


@query("k8_grid_summary", _E + _GRID + f" SELECT k, r, vote, round(avg(accuracy), 6) AS accuracy FROM ({_GRID_ROWS}) GROUP BY 1, 2, 3")
def _(spark, sf):
    out = lazy.grid_summary(_grid(spark, sf), ["k", "r", "vote"])
    return rounded(out.drop("seconds"), 6, "accuracy")


@query("k8_profile_by_k", _E + _GRID + f" SELECT k, round(avg(accuracy), 6) AS accuracy FROM ({_GRID_ROWS}) GROUP BY 1")
def _(spark, sf):
    return rounded(lazy.grid_summary(_grid(spark, sf), ["k"]).drop("seconds"), 6, "accuracy")


# per (event type, day) largest value stands for a configuration x fold table
_EV = """WITH v AS (SELECT event_type AS config, date_trunc('day', ts)::DATE::VARCHAR AS fold, max(value) AS accuracy, count(*)::DOUBLE AS seconds
FROM events GROUP BY 1, 2) """


def _study(spark, sf):
    return load(spark, sf, "events").groupBy(
        F.col("event_type").alias("config"), F.to_date("ts").cast("string").alias("fold")).agg(
        F.max("value").alias("accuracy"), F.count("*").cast("double").alias("seconds"))


@query("k8_repair_timings", _EV + """SELECT config, fold, accuracy, round(CASE WHEN seconds > 75 THEN m ELSE seconds END, 6) AS seconds
FROM v JOIN (SELECT config, avg(seconds) FILTER (seconds <= 75) AS m FROM v GROUP BY 1) USING (config)""")
def _(spark, sf):
    return rounded(lazy.repair_timings(_study(spark, sf), ["config"], F.col("seconds") > 75), 6, "seconds")


@query("k9_friedman", _EV + """, r AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY accuracy) + (count(*) OVER (PARTITION BY fold, accuracy) - 1) / 2.0 AS rk,
  count(*) OVER (PARTITION BY fold, accuracy) AS t FROM v),
c AS (SELECT count(DISTINCT fold) AS n, count(DISTINCT config) AS k, sum(t * t - 1) AS ties FROM r),
s AS (SELECT sum(q * q) AS ss FROM (SELECT sum(rk) AS q FROM r GROUP BY config))
SELECT round((12.0 / (k * n * (k + 1)) * ss - 3 * n * (k + 1)) / (1 - ties / (k * (k * k - 1) * n)), 6) + 0.0 AS statistic, (k - 1)::INTEGER AS df FROM c, s""")
def _(spark, sf):
    return rounded(compare.friedman(_study(spark, sf), "fold", "config", "accuracy").drop("p_value"), 6, "statistic")


_DUNN = _EV + """, r AS (SELECT *, rank() OVER (ORDER BY accuracy) + (count(*) OVER (PARTITION BY accuracy) - 1) / 2.0 AS rk FROM v),
t AS (SELECT sum(c * c * c - c) AS ties, sum(c) AS n FROM (SELECT count(*)::DOUBLE AS c FROM v GROUP BY accuracy)),
m AS (SELECT config, avg(rk) AS m, count(*) AS n FROM r GROUP BY 1),
p AS (SELECT a.config AS a, b.config AS b, abs(a.m - b.m) / sqrt((t.n * (t.n + 1) / 12 - ties / (12 * (t.n - 1))) * (1.0 / a.n + 1.0 / b.n)) AS z
      FROM m a JOIN m b ON a.config < b.config, t) """


@query("k10_dunn_statistic", _DUNN + "SELECT a, b, round(z, 6) + 0.0 AS z FROM p")
def _(spark, sf):
    out = compare.dunn_holm(_study(spark, sf), "config", "accuracy", ["config", "fold"])
    return rounded(out.select("a", "b", "z"), 6, "z")


# erf(x) = 2 / sqrt(pi) * exp(-x^2) * sum of 2^n x^(2n+1) / (2n+1)!!, all terms positive
@query("k10_dunn_holm", _DUNN + """, q AS (SELECT a, b, z, CASE WHEN z = 0 THEN 1.0 WHEN z > 9 THEN 0.0 ELSE greatest(0.0, 1 - 2 / sqrt(pi()) * (
    SELECT sum(exp(2 * n * ln(2) + (2 * n + 1) * ln(z / sqrt(2)) - z * z / 2 + lgamma(n + 1) - lgamma(2 * n + 2))) FROM (
      SELECT unnest(range(300))::DOUBLE AS n))) END AS p FROM p),
h AS (SELECT *, least(1.0, (count(*) OVER () - row_number() OVER (ORDER BY p, a, b) + 1) * p) AS s FROM q)
SELECT a, b, round(z, 6) + 0.0 AS z, round(p, 6) + 0.0 AS p,
  round(max(s) OVER (ORDER BY p, a, b ROWS UNBOUNDED PRECEDING), 6) + 0.0 AS p_holm FROM h""")
def _(spark, sf):
    return rounded(compare.dunn_holm(_study(spark, sf), "config", "accuracy", ["config", "fold"]), 6, "z", "p", "p_holm")


# mean quantity per (line number, return flag x month) with a clear difference built in
@query("k11_pick_best", """
WITH v AS (SELECT l_linenumber AS config, date_trunc('month', l_shipdate) AS fold, avg(l_quantity + 20 * l_linenumber) AS accuracy FROM lineitem GROUP BY 1, 2)
SELECT config, round(avg(accuracy), 6) AS accuracy, config = 7 AS best, config = 1 AS not_rejected FROM v GROUP BY 1""")
def _(spark, sf):
    v = load(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("config"), F.date_trunc("month", "l_shipdate").alias("fold")).agg(
        F.avg(F.col("l_quantity") + 20 * F.col("l_linenumber")).alias("accuracy"))
    v = cut_lineage(v)
    pairs = compare.dunn_holm(v, "config", "accuracy", ["config", "fold"])
    means = v.groupBy("config").agg(F.avg("accuracy").alias("accuracy"))
    return rounded(compare.pick_best(pairs, means, "config"), 6, "accuracy")


@query("k12_reduce_enn", _E + near_cte("n", 3, 2, "a.id <> b.id") + ", p AS (" + majority_sql("n", 3, "label")
       + ") SELECT id, label FROM e JOIN p ON test_id = id WHERE predicted = label")
def _(spark, sf):
    return reduce.reduce_enn(vectors(spark, sf), k=3, **_KW).select("id", "label")


@query("k13_reduce_cnn")
def _(spark, sf):
    return reduce.reduce_cnn(vectors(spark, sf), **_KW).select("id", "label")


@query("k13_cnn_consistency", "SELECT count(*) AS n, count(*) AS right_rows FROM embeddings")
def _(spark, sf):
    e = vectors(spark, sf)
    base = cut_lineage(reduce.reduce_cnn(e, **_KW))
    near = neighbours.knn(base, e, 1, 2, **_KW)
    joined = e.select(F.col("id").alias("test_id"), F.col("label").alias("truth")).join(near, "test_id")
    return joined.agg(F.count("*").alias("n"), F.count_if(F.col("truth") == F.col("label")).alias("right_rows"))


def _wilson_sql(p, n, z, sign):
    return f"({p} + {z * z} / (2 * {n}) {sign} {z} * sqrt({p} * (1 - {p}) / {n} + {z * z} / (4 * {n} * {n}))) / (1 + {z * z} / {n})"


@query("k14_wilson_bounds", f"""
WITH c AS (SELECT l_linenumber AS id, count(*) FILTER (l_returnflag = 'A')::DOUBLE AS hits, count(*)::DOUBLE AS trials FROM lineitem GROUP BY 1)
SELECT id, round({_wilson_sql('(hits / trials)', 'trials', 0.9, '-')}, 6) AS low, round({_wilson_sql('(hits / trials)', 'trials', 0.7, '+')}, 6) AS high FROM c""")
def _(spark, sf):
    c = load(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("id")).agg(
        F.count_if(F.col("l_returnflag") == "A").cast("double").alias("hits"), F.count("*").cast("double").alias("trials"))
    p, n = F.col("hits") / F.col("trials"), F.col("trials")
    return c.select("id", rnd(reduce.wilson(p, n, 0.9, False)).alias("low"), rnd(reduce.wilson(p, n, 0.7, True)).alias("high"))


@query("k14_reduce_ib3")
def _(spark, sf):
    return reduce.reduce_ib3(vectors(spark, sf), **_KW).select("id", "label")


_TWO = near_cte("n", 2, 2, "a.id <> b.id") + """, w AS (SELECT test_id, any_value(truth) AS truth, max(train_id) FILTER (rank = 1) AS n1, max(label) FILTER (rank = 1) AS l1,
  max(train_id) FILTER (rank = 2) AS n2, max(label) FILTER (rank = 2) AS l2 FROM n GROUP BY 1),
s AS (SELECT e.id, coalesce(sum((l1 = truth)::INTEGER), 0) AS w1, coalesce(sum((l2 = truth)::INTEGER), 0) AS w2 FROM e LEFT JOIN w ON n1 = e.id GROUP BY 1),
x AS (SELECT n1 AS u, n2 AS v FROM w UNION SELECT test_id, n1 FROM w UNION SELECT test_id, n2 FROM w), """


def _round_sql(order):
    return _E + _TWO + f"""c AS (SELECT s.id, {order} AS o FROM s WHERE w2 >= w1),
l AS (SELECT CASE WHEN (a.o, a.id) < (b.o, b.id) THEN b.id ELSE a.id END AS id FROM x JOIN c a ON a.id = u JOIN c b ON b.id = v)
SELECT id FROM c WHERE id NOT IN (SELECT id FROM l)"""


@query("k15_drop1_round", _round_sql("0.0"))
def _(spark, sf):
    rows = vectors(spark, sf).select("id", "x", "label")
    return reduce.drop_round(rows, rows)


@query("k15_reduce_drop1")
def _(spark, sf):
    return reduce.reduce_drop1(vectors(spark, sf), **_KW).select("id", "label")


_ENEMY = near_cte("z", 1, 2, "a.label <> b.label")


@query("k16_nearest_enemy", _E + _ENEMY + " SELECT test_id AS id, round(distance, 6) AS distance FROM z")
def _(spark, sf):
    return rounded(reduce.nearest_enemy(vectors(spark, sf), **_KW), 6, "distance")


@query("k16_drop2_round", _round_sql("(SELECT -distance FROM z WHERE z.test_id = s.id)").replace("WITH e AS", "WITH e AS", 1).replace(
    "c AS (SELECT s.id", _ENEMY + ", c AS (SELECT s.id", 1))
def _(spark, sf):
    e = vectors(spark, sf)
    rows = e.select("id", "x", "label")
    enemy = reduce.nearest_enemy(e, **_KW).select("id", (-F.col("distance")).alias("p"))
    return reduce.drop_round(rows, rows, enemy)


@query("k16_reduce_drop2")
def _(spark, sf):
    return reduce.reduce_drop2(vectors(spark, sf), **_KW).select("id", "label")


_TOP1 = near_cte("n", 1, 2, "true", "tr", "te") + ", " + near_cte("l", 3, 2, "a.id <> b.id", "tr", "tr") + ", p AS (" + majority_sql("l", 3, "label") + \
    "), k AS (SELECT tr.* FROM tr JOIN p ON test_id = id WHERE predicted = label), " + near_cte("o", 1, 2, "true", "k", "te")


@query("k17_reduction_report", _HALF_E + _TOP1 + """
SELECT 'none' AS method, round(avg((label = truth)::INTEGER), 6) AS accuracy, (SELECT count(*) FROM tr) AS before, (SELECT count(*) FROM tr) AS kept, 0.0::DOUBLE AS saved FROM n
UNION ALL SELECT 'enn', round(avg((label = truth)::INTEGER), 6), (SELECT count(*) FROM tr), (SELECT count(*) FROM k), round(1 - (SELECT count(*) FROM k) / (SELECT count(*) FROM tr), 6) FROM o""")
def _(spark, sf):
    train, test = _halves(spark, sf)
    methods = {"none": train, "enn": cut_lineage(reduce.reduce_enn(train, k=3, **_KW))}
    out = reduce.reduction_report(train, test, methods, **_KW)
    return rounded(out.drop("seconds"), 6, "accuracy", "saved")
