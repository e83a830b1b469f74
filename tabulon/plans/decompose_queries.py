"""Queries of the X family."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tabulon.operators import decompose, som
from tabulon.plans.cluster_queries import (_SCALED, NUM, _assign_sql, _dist_sql, _event_points, _ESRC, _scaled_part,
                                           _values, scaled_lineitem)
from tabulon.plans.registry import load, query, rnd, rounded

# fixed orthonormal axes (rows) for queries that check a projection
AXES = [(0.5, 0.5, 0.5, 0.5), (0.5, -0.5, 0.5, -0.5)]
FULL = [*AXES, (0.5, 0.5, -0.5, -0.5), (0.5, -0.5, -0.5, 0.5)]


def _correlated(spark, sf):
    q, p, d = F.col("l_quantity"), F.col("l_extendedprice") / 1000, F.col("l_discount") * 100
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", q.alias("q"), (p + q).alias("p"),
                                              (d + q / 2).alias("d"))


@query("x1_pca_fit")
def _(spark, sf):
    df = _correlated(spark, sf)
    return decompose.pca_fit(df, ["q", "p", "d"], 3).as_table(df)


# eigenvalues of a symmetric 3 x 3 matrix in closed form
@query("x1_explained_variance", """
WITH s AS (SELECT l_quantity AS q, l_extendedprice / 1000 + l_quantity AS p, l_discount * 100 + l_quantity / 2 AS d FROM lineitem),
m AS (SELECT var_samp(q) AS a, var_samp(p) AS b, var_samp(d) AS c, covar_samp(q, p) AS ab, covar_samp(q, d) AS ac, covar_samp(p, d) AS bc FROM s),
k AS (SELECT *, (a + b + c) / 3 AS t FROM m),
h AS (SELECT *, sqrt((pow(a - t, 2) + pow(b - t, 2) + pow(c - t, 2) + 2 * (ab * ab + ac * ac + bc * bc)) / 6) AS w FROM k),
f AS (SELECT *, acos(((a - t) * ((b - t) * (c - t) - bc * bc) - ab * (ab * (c - t) - bc * ac) + ac * (ab * bc - (b - t) * ac)) / (2 * w * w * w)) / 3 AS phi FROM h)
SELECT component, round(v, 5) AS variance FROM (SELECT 0 AS component, t + 2 * w * cos(phi) AS v FROM f
UNION ALL SELECT 1, t + 2 * w * cos(phi - 2 * pi() / 3) FROM f UNION ALL SELECT 2, t + 2 * w * cos(phi + 2 * pi() / 3) FROM f)""")
def _(spark, sf):
    model = decompose.pca_fit(_correlated(spark, sf), ["q", "p", "d"])
    out = spark.createDataFrame([(i, float(v)) for i, v in enumerate(model.variances)], "component int, variance double")
    return rounded(out, 5, "variance")


def _project_sql(axes):
    return ", ".join("round(" + " + ".join(f"{c} * ({w})" for c, w in zip(NUM, a)) + f", 6) + 0.0 AS y{k}"
                     for k, a in enumerate(axes))


@query("x2_pca_transform", f"WITH {_SCALED} SELECT l_orderkey, l_linenumber, {_project_sql(AXES)} FROM s")
def _(spark, sf):
    out = decompose.pca_transform(scaled_lineitem(spark, sf), NUM, AXES)
    return out.select("l_orderkey", "l_linenumber", *[rnd(F.get("projected", F.lit(k))).alias(f"y{k}") for k in range(2)])


_VAR = """(SELECT row_number() OVER (ORDER BY v DESC) - 1 AS component, v FROM (
SELECT unnest([var_samp(l_quantity), var_samp(l_discount * 100), var_samp(l_tax * 100), var_samp(l_linenumber)]) AS v FROM lineitem))"""


def _variance_table(spark, sf):
    df = load(spark, sf, "lineitem").agg(
        F.var_samp("l_quantity").alias("a"), F.var_samp(F.col("l_discount") * 100).alias("b"),
        F.var_samp(F.col("l_tax") * 100).alias("c"), F.var_samp("l_linenumber").alias("d"))
    return df.select(F.posexplode(F.sort_array(F.array("a", "b", "c", "d"), asc=False)).alias("component", "explained"))


@query("x3_choose_components", f"""
SELECT (min(component) + 1)::INTEGER AS components FROM (SELECT component, sum(v) OVER (ORDER BY component) / sum(v) OVER () AS c FROM {_VAR}) WHERE c >= 0.9""")
def _(spark, sf):
    return decompose.choose_components(_variance_table(spark, sf), 0.9)


@query("x4_cumulative_variance", f"""
SELECT component::INTEGER AS component, round(v, 6) AS explained, round(c, 6) AS cumulative, c >= 60 AS reaches_60, c >= 80 AS reaches_80, c >= 90 AS reaches_90
FROM (SELECT component, v, sum(v) OVER (ORDER BY component) / sum(v) OVER () * 100 AS c FROM {_VAR})""")
def _(spark, sf):
    return rounded(decompose.cumulative_variance(_variance_table(spark, sf)), 6, "explained", "cumulative")


@query("x5_pca_reconstruct", f"""WITH {_SCALED}, y AS (SELECT *, {', '.join(
    '(' + ' + '.join(f'{c} * ({w})' for c, w in zip(NUM, a)) + f') AS y{k}' for k, a in enumerate(AXES))} FROM s),
r AS (SELECT *, {', '.join('(' + ' + '.join(f'y{k} * ({AXES[k][j]})' for k in range(2)) + f') AS r{j}' for j in range(4))} FROM y)
SELECT l_orderkey, l_linenumber, round(r0, 6) + 0.0 AS r0, round(sqrt({' + '.join(f'pow({c} - r{j}, 2)' for j, c in enumerate(NUM))}), 6) + 0.0 AS error FROM r""")
def _(spark, sf):
    out = decompose.pca_transform(scaled_lineitem(spark, sf), NUM, AXES)
    out = decompose.reconstruction_error(decompose.pca_reconstruct(out, AXES), NUM)
    return out.select("l_orderkey", "l_linenumber", rnd(F.get("reconstructed", F.lit(0))).alias("r0"), rnd("error").alias("error"))


@query("x5_full_rank_reconstruct", f"WITH {_SCALED} SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round({c}, 6) + 0.0 AS {c}" for c in NUM) + " FROM s")
def _(spark, sf):
    out = decompose.pca_reconstruct(decompose.pca_transform(scaled_lineitem(spark, sf), NUM, FULL), FULL)
    return out.select("l_orderkey", "l_linenumber", *[rnd(F.get("reconstructed", F.lit(j))).alias(c) for j, c in enumerate(NUM)])


@query("x6_incremental_moments", " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, count(*)::BIGINT AS n, round(sum({a}), 2) AS sum_i, round(sum({a} * {b}), 2) AS sum_ij FROM lineitem"
    for i, a in enumerate(NUM[:1] + NUM[2:]) for j, b in enumerate(NUM[:1] + NUM[2:]) if i <= j))
def _(spark, sf):
    cols = NUM[:1] + NUM[2:]
    df = load(spark, sf, "lineitem", "l_returnflag", *cols)
    batches = [df.where(F.col("l_returnflag") == f) for f in "ANR"]
    out = decompose.merge_moments(*[decompose.moments(b, cols) for b in batches])
    return rounded(out.drop("sum_j"), 2, "sum_i", "sum_ij")


@query("x6_incremental_pca")
def _(spark, sf):
    df = _correlated(spark, sf)
    parts = [df.where(F.col("l_linenumber") <= 3), df.where(F.col("l_linenumber") > 3)]
    return decompose.incremental_pca(parts, ["q", "p", "d"], 2).as_table(df)


@query("x7_project_points", f"""WITH {_SCALED}, c AS (SELECT l_returnflag, {', '.join(f'avg({c}) AS {c}' for c in NUM)} FROM s GROUP BY 1)
SELECT l_returnflag, {_project_sql(AXES)} FROM c""")
def _(spark, sf):
    centres = scaled_lineitem(spark, sf).groupBy("l_returnflag").agg(*[F.avg(c).alias(c) for c in NUM])
    model = decompose.PcaModel(NUM, np.array(AXES), np.zeros(4), np.ones(4))
    out = decompose.project_points(centres, NUM, model)
    return out.select("l_returnflag", *[rnd(F.get("projected", F.lit(k))).alias(f"y{k}") for k in range(2)])


# ---- self-organising map -----------------------------------------------------------
_H, _W = 3, 4
_BOOK = [(0.8 * (u // _W) - 0.8, 0.7 * (u % _W) - 1.0) for u in range(_H * _W)]
_BOOK_SQL = "(VALUES " + ", ".join(f"({u}, {u // _W}, {u % _W}, {a!r}::DOUBLE, {b!r}::DOUBLE)"
                                   for u, (a, b) in enumerate(_BOOK)) + ") AS g(unit, x, y, w0, w1)"
_SOM_HITS = f"WITH {_ESRC}, b AS ({_assign_sql('s', ['x', 'y'], _H * _W, '(' + _values(_BOOK) + ')')}) "


def _book(spark):
    model = som.SomModel(_H, _W, ["x", "y"], np.array(_BOOK))
    return model, model.as_table(spark.range(1))


@query("x8_som_fit")
def _(spark, sf):
    df = _event_points(spark, sf)
    return som.som_fit(df, ["x", "y"], 6, 6, epochs=6, key=["event_id"]).as_table(df)


@query("x8_som_quantisation_falls", "SELECT true AS falls, count(*) AS n FROM events")
def _(spark, sf):
    df = _event_points(spark, sf)
    model = som.som_fit(df, ["x", "y"], 5, 5, epochs=6, step=1.0, key=["event_id"])
    return df.agg(F.count("*").alias("n")).select(F.lit(model.errors[-1] < model.errors[0]).alias("falls"), "n")


@query("x8_som_step", _SOM_HITS + f""", t AS (SELECT cluster AS u, count(*) AS n, sum(x) AS s0, sum(y) AS s1 FROM b GROUP BY 1),
p AS (SELECT g.unit AS a, o.unit AS b, CASE WHEN pow(g.x - o.x, 2) + pow(g.y - o.y, 2) <= 4 THEN exp(-(pow(g.x - o.x, 2) + pow(g.y - o.y, 2)) / 8.0) ELSE 0 END AS h, g.w0, g.w1
  FROM {_BOOK_SQL}, {_BOOK_SQL.replace('AS g(', 'AS o(')})
SELECT a AS unit, round(any_value(w0) + 0.5 * (sum(h * s0) / sum(h * n) - any_value(w0)), 6) + 0.0 AS w0,
  round(any_value(w1) + 0.5 * (sum(h * s1) / sum(h * n) - any_value(w1)), 6) + 0.0 AS w1 FROM p JOIN t ON t.u = p.b GROUP BY 1""")
def _(spark, sf):
    model, _table = _book(spark)
    out = som.epoch(_event_points(spark, sf), model, 2.0, 0.5).as_table(spark.range(1))
    return out.select("unit", rnd(F.get("weights", F.lit(0))).alias("w0"), rnd(F.get("weights", F.lit(1))).alias("w1"))


@query("x9_som_hits", _SOM_HITS + f"""SELECT cluster AS unit, (cluster // {_W})::INTEGER AS x, (cluster % {_W})::INTEGER AS y, event_type, count(*) AS n
FROM b JOIN events USING (event_id) GROUP BY ALL""")
def _(spark, sf):
    model, _table = _book(spark)
    df = _event_points(spark, sf).join(load(spark, sf, "events", "event_id", "event_type"), "event_id")
    return som.som_hits(df, model, "event_type")


# the map under the u-matrix queries is fitted: mean point of every grid cell of the data
_CELLS = f"""WITH {_ESRC}, g AS (SELECT (least(greatest(floor(x + 1), 0), 2))::INTEGER AS gx, (least(greatest(floor(y * 2 + 2), 0), 3))::INTEGER AS gy, avg(x) AS w0, avg(y) AS w1 FROM s GROUP BY 1, 2)"""


def _cell_book(spark, sf):
    df = _event_points(spark, sf)
    gx = F.least(F.greatest(F.floor(F.col("x") + 1), F.lit(0)), F.lit(2)).cast("int")
    gy = F.least(F.greatest(F.floor(F.col("y") * 2 + 2), F.lit(0)), F.lit(3)).cast("int")
    return df.groupBy(gx.alias("gx"), gy.alias("gy")).agg(F.array(F.avg("x"), F.avg("y")).alias("weights")).select(
        (F.col("gx") * 4 + F.col("gy")).alias("unit"), F.col("gx").alias("x"), F.col("gy").alias("y"), "weights")


def _u_sql(on):
    return _CELLS + f""" SELECT (a.gx * 4 + a.gy) AS unit, a.gx AS x, a.gy AS y, round(avg({_dist_sql(['a.w0', 'a.w1'], ['b.w0', 'b.w1'])}), 6) AS distance
FROM g a JOIN g b ON {on} GROUP BY ALL"""


@query("x10_u_matrix_rect", _u_sql("abs(a.gx - b.gx) + abs(a.gy - b.gy) = 1"))
def _(spark, sf):
    return rounded(som.u_matrix(_cell_book(spark, sf)), 6, "distance")


@query("x10_u_matrix_hex", _u_sql("""(a.gx = b.gx AND abs(a.gy - b.gy) = 1) OR (abs(a.gx - b.gx) = 1 AND
 ((a.gx % 2 = 0 AND b.gy IN (a.gy - 1, a.gy)) OR (a.gx % 2 = 1 AND b.gy IN (a.gy, a.gy + 1))))"""))
def _(spark, sf):
    return rounded(som.u_matrix(_cell_book(spark, sf), hexagonal=True), 6, "distance")


@query("x11_u_matrix_expanded", _CELLS + f""" SELECT a.gx + b.gx AS x, a.gy + b.gy AS y, round({_dist_sql(['a.w0', 'a.w1'], ['b.w0', 'b.w1'])}, 6) AS distance
FROM g a JOIN g b ON (b.gx = a.gx + 1 AND b.gy = a.gy) OR (b.gx = a.gx AND b.gy = a.gy + 1)""")
def _(spark, sf):
    return rounded(som.u_matrix_expanded(_cell_book(spark, sf)), 6, "distance")
