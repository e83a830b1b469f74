"""Queries of the D, U and M families."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions import vectors as V
from tabulon.operators import clean, cluster, frame, hierarchy, metrics
from tabulon.operators.frame import with_ordinal
from tabulon.plans.registry import load, query, rnd, rounded, sql_rnd

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# fixed starting points on the scaled columns
START = [(-1.0, -1.0, 0.0, 0.5), (1.0, -0.5, 0.5, -0.5), (0.0, 1.0, -1.0, 0.0), (1.0, 1.0, 1.0, 1.0)]


def _dist_sql(cols, values, kind="euclidean"):
    if kind == "euclidean":
        return "sqrt(" + " + ".join(f"({c} - ({v})) * ({c} - ({v}))" for c, v in zip(cols, values)) + ")"
    return "(" + " + ".join(f"({c} <> {v})::INTEGER" for c, v in zip(cols, values)) + ")::DOUBLE"


# ---- D -------------------------------------------------------------------
def _vector_pairs(spark, sf):
    """Every vector next to the mean vector of its label."""
    e = load(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("a"))
    means = e.groupBy("label").agg(F.array(*[F.avg(F.get("a", F.lit(i))) for i in range(64)]).alias("b"))
    return e.join(means, "label")


_VEC_SQL = """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS a FROM embeddings),
m AS (SELECT label, list(v ORDER BY i) AS b FROM (SELECT label, i, avg(a[i]) AS v
      FROM (SELECT label, a, unnest(range(1, 65)) AS i FROM e) GROUP BY 1, 2) GROUP BY 1)
SELECT vec_id, {body} FROM e JOIN m USING (label)"""


@query("d1_euclidean", _VEC_SQL.format(body="round(list_distance(a, b), 6) AS d"))
def _(spark, sf):
    return _vector_pairs(spark, sf).select("vec_id", rnd(V.euclidean(F.col("a"), F.col("b"))).alias("d"))


@query("d2_minkowski", _VEC_SQL.format(body="""
round(list_sum(list_transform(list_zip(a, b), lambda p: abs(p[1] - p[2]))), 6) AS d1, round(list_distance(a, b), 6) AS d2,
round(pow(list_sum(list_transform(list_zip(a, b), lambda p: pow(abs(p[1] - p[2]), 3))), 1/3.0), 6) AS d3"""))
def _(spark, sf):
    a, b = F.col("a"), F.col("b")
    return _vector_pairs(spark, sf).select("vec_id", *[rnd(V.minkowski(a, b, r)).alias(f"d{r}") for r in (1, 2, 3)])


@query("d3_manhattan", "SELECT l_orderkey, l_linenumber, round(abs(l_quantity - 10) + abs(l_discount - 0.05), 6) AS d FROM lineitem")
def _(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", rnd(
        V.manhattan(["l_quantity", "l_discount"], [F.lit(10.0), F.lit(0.05)])).alias("d"))


@query("d4_matching_distance", """
SELECT o_orderkey, ((o_orderstatus <> 'F')::INTEGER + (o_orderpriority <> '5-LOW')::INTEGER) AS d FROM orders""")
def _(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", V.matching_distance(
        ["o_orderstatus", "o_orderpriority"], [F.lit("F"), F.lit("5-LOW")]).alias("d"))


@query("d5_mixed_distance", """
SELECT p_partkey, round((p_brand <> 'Brand#2')::INTEGER + (p_type <> 'PROMO')::INTEGER
  + 0.8 * sqrt((p_size - 10) * (p_size - 10) + (p_retailprice - 950) * (p_retailprice - 950)), 6) AS d FROM part""")
def _(spark, sf):
    return load(spark, sf, "part").select("p_partkey", rnd(V.mixed_distance(
        ["p_size", "p_retailprice"], [F.lit(10.0), F.lit(950.0)],
        ["p_brand", "p_type"], [F.lit("Brand#2"), F.lit("PROMO")], 0.8)).alias("d"))


@query("d6_cosine_similarity", _VEC_SQL.format(
    body="round(list_cosine_similarity(a, b), 6) + 0.0 AS s, round(1 - list_cosine_similarity(a, b), 6) + 0.0 AS d"))
def _(spark, sf):
    a, b = F.col("a"), F.col("b")
    return _vector_pairs(spark, sf).select("vec_id", rnd(V.cosine_similarity(a, b)).alias("s"),
                                           rnd(V.cosine_distance(a, b)).alias("d"))


@query("d7_pairwise_distances", " UNION ALL ".join(
    f"SELECT p_partkey, {i} AS centroid, round(greatest({_dist_sql(['p_size', 'p_retailprice'], c)}, 2.220446049250313e-16), 6) AS distance FROM part"
    for i, c in enumerate([(10, 920), (25, 950), (40, 980)])))
def _(spark, sf):
    out = cluster.pairwise_distances(load(spark, sf, "part", "p_partkey", "p_size", "p_retailprice"),
                                     ["p_size", "p_retailprice"], [(10, 920), (25, 950), (40, 980)])
    return rounded(out.select("p_partkey", "centroid", "distance"), 6, "distance")


_TURNS_SQL = """
WITH t AS (SELECT conv_id, turn, list_filter(string_split_regex(lower(trim(text)), '\\s+'), lambda x: x <> '') AS a FROM conversations),
p AS (SELECT x.conv_id, x.turn, x.a AS a, y.a AS b FROM t x JOIN t y ON x.conv_id = y.conv_id AND y.turn = x.turn + 1)
SELECT conv_id, turn, {body} FROM p WHERE len(a) > 0 AND len(b) > 0"""


def turn_pairs(spark, sf):
    """Every conversation turn next to the following one."""
    words = F.filter(F.split(F.lower(F.trim("text")), r"\s+"), lambda x: x != "")
    t = load(spark, sf, "conversations").select("conv_id", "turn", words.alias("a"))
    nxt = t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    return t.join(nxt, ["conv_id", "turn"]).where((F.size("a") > 0) & (F.size("b") > 0))


@query("d8_jaccard", _TURNS_SQL.format(body="""
round(1 - len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) + 0.0 AS d,
round(5.0 * len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) + 0.0 AS score"""))
def _(spark, sf):
    return turn_pairs(spark, sf).select("conv_id", "turn", rnd(V.jaccard_distance("a", "b")).alias("d"),
                                        rnd(V.jaccard_score("a", "b")).alias("score"))


@query("d9_overlap_score", _TURNS_SQL.format(body="""
round(2.0 * list_sum(list_transform(a, lambda w: len(list_filter(b, lambda x: x = w)))) / (len(a) + len(b)), 6) + 0.0 AS score"""))
def _(spark, sf):
    return turn_pairs(spark, sf).select("conv_id", "turn", rnd(V.overlap_score("a", "b")).alias("score"))


@query("d10_angular_score", _VEC_SQL.format(
    body="round(1 - acos(greatest(-1, least(1, list_cosine_similarity(a, b)))), 6) + 0.0 AS score"))
def _(spark, sf):
    return _vector_pairs(spark, sf).select("vec_id", rnd(V.angular_score(F.col("a"), F.col("b"))).alias("score"))


@query("d11_hamming_share", """
SELECT l_orderkey, l_linenumber, ((l_returnflag <> 'A')::INTEGER + (l_linestatus <> 'F')::INTEGER) / 2.0::DOUBLE AS d FROM lineitem""")
def _(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", V.hamming_share(
        ["l_returnflag", "l_linestatus"], [F.lit("A"), F.lit("F")]).alias("d"))


# ---- U -------------------------------------------------------------------
_SCALED = "s AS (SELECT l_orderkey, l_linenumber, l_returnflag, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in NUM) + " FROM lineitem)"


def scaled_lineitem(spark, sf):
    df = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", *NUM)
    return clean.standard_scale(df, NUM)


def _assign_sql(source, cols, k, protos, kind="euclidean", extra="", dist=None):
    """CTE body: every row of source with its first nearest prototype."""
    ds = [dist(i) if dist else _dist_sql(cols, [f"p{i}_{j}" for j in range(len(cols))], kind) for i in range(k)]
    least = f"least({', '.join(f'd{i}' for i in range(k))})"
    case = "CASE " + " ".join(f"WHEN d{i} = {least} THEN {i}" for i in range(k)) + " END"
    return (f"SELECT *, {case} AS cluster, {least} AS distance FROM (SELECT {source}.*, "
            + ", ".join(f"{d} AS d{i}" for i, d in enumerate(ds)) + f" FROM {source}, {protos})")


def _values(start):
    return "SELECT " + ", ".join(f"{v if isinstance(v, str) else repr(float(v)) + '::DOUBLE'} AS p{i}_{j}"
                                 for i, c in enumerate(start) for j, v in enumerate(c))


def lloyd_sql(with_, source, cols, start, n_iter, kind="euclidean", cat=(), dist=None):
    """n_iter assignment/update rounds unrolled as CTEs a0..; prototypes c0.."""
    k, parts = len(start), [with_, f"c0 AS ({_values(start)})"]
    for t in range(n_iter):
        parts.append(f"a{t} AS MATERIALIZED ({_assign_sql(source, cols, k, f'c{t}', kind, dist=dist)})")
        upd = []
        for i in range(k):
            for j, c in enumerate(cols):
                if c in cat:
                    v = (f"(SELECT {c} FROM a{t} WHERE cluster = {i} GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")
                else:
                    v = f"(SELECT avg({c}) FROM a{t} WHERE cluster = {i})"
                upd.append(f"coalesce({v}, (SELECT p{i}_{j} FROM c{t})) AS p{i}_{j}")
        parts.append(f"c{t + 1} AS MATERIALIZED (SELECT {', '.join(upd)})")
    return "WITH " + ",\n".join(parts) + "\n"


@query("u1_assign_nearest", lloyd_sql(_SCALED, "s", NUM, START, 1)
       + "SELECT l_orderkey, l_linenumber, l_returnflag, cluster, round(distance, 6) AS distance FROM a0")
def _(spark, sf):
    out = cluster.assign_nearest(scaled_lineitem(spark, sf), NUM, START)
    return rounded(out.select("l_orderkey", "l_linenumber", "l_returnflag", "cluster", "distance"), 6, "distance")


@query("flagship", """
WITH k AS (SELECT lineitem.* FROM lineitem, (SELECT """ + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUM) + " FROM lineitem) WHERE " + " AND ".join(
    f"abs(({c} - m_{c}) / s_{c}) < 3" for c in NUM) + "), " + _SCALED.replace("FROM lineitem)", "FROM k), ")
    + lloyd_sql("", "s", NUM, START, 1)[len("WITH ,"):] +
    "SELECT l_returnflag, cluster, count(*) AS n FROM a0 GROUP BY 1, 2")
def flagship(spark, sf):
    """Typed split, outlier filter, scaling, nearest centroid, contingency."""
    df = load(spark, sf, "lineitem", *NUM, "l_returnflag")
    split = frame.split_features(df, [], "l_returnflag")
    kept = clean.drop_outliers(split.frame, split.numeric)
    scaled = clean.standard_scale(kept, split.numeric)
    level = F.get(F.lit(split.response_levels), F.col("l_returnflag").cast("int"))
    labelled = cluster.assign_nearest(scaled, split.numeric, START).withColumn("l_returnflag", level)
    return metrics.contingency(labelled, "l_returnflag", "cluster")


def _proto_rows(start, n_cols, t, names, digits=5, text=()):
    return " UNION ALL ".join(
        f"SELECT {i} AS cluster, '{names[j]}' AS \"column\", "
        + (f"p{i}_{j}::VARCHAR AS value" if names[j] in text else f"(round(p{i}_{j}, {digits}) + 0.0)::VARCHAR AS value")
        + f" FROM c{t}" for i in range(len(start)) for j in range(n_cols))


@query("u2_kmeans_prototypes", lloyd_sql(_SCALED, "s", NUM, START, 5) + " UNION ALL ".join(
    f"SELECT {i} AS cluster, " + ", ".join(f"round(p{i}_{j}, 5) + 0.0 AS {c}" for j, c in enumerate(NUM))
    + " FROM c5" for i in range(4)))
def _(spark, sf):
    model = cluster.kmeans(scaled_lineitem(spark, sf), NUM, 4, start=START, max_iter=5)
    out = spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(model.centroids)],
                                "cluster int, " + ", ".join(f"{c} double" for c in NUM))
    return rounded(out, 5, *NUM)


@query("u2_kmeans_labels", lloyd_sql(_SCALED, "s", NUM, START, 4)
       + "SELECT cluster, count(*) AS n, round(sum(distance), 3) AS inertia FROM a3 GROUP BY 1")
def _(spark, sf):
    df = scaled_lineitem(spark, sf)
    model = cluster.kmeans(df, NUM, 4, start=START, max_iter=4)
    return model.predict(df).groupBy("cluster").agg(F.count("*").alias("n"), rnd(F.sum("distance"), 3).alias("inertia"))


@query("u2_kmeans_converged")
def _(spark, sf):
    df = load(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    df = clean.standard_scale(df, ["p_size", "p_retailprice"])
    model = cluster.kmeans(df, ["p_size", "p_retailprice"], 3, key=["p_partkey"], seed=12)
    return model.predict(df).select("p_partkey", "cluster", "distance")


_OCAT = ["o_orderstatus", "o_orderpriority"]
_OSTART = [("'F'", "'1-URGENT'"), ("'O'", "'3-MEDIUM'"), ("'P'", "'5-LOW'")]


@query("u3_kmodes", lloyd_sql("s AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders)", "s", _OCAT,
                              _OSTART, 3, "matching", _OCAT)
       + "SELECT o_orderkey, cluster, distance FROM a2")
def _(spark, sf):
    df = load(spark, sf, "orders", "o_orderkey", *_OCAT)
    start = [tuple(v.strip("'") for v in c) for c in _OSTART]
    model = cluster.kmodes(df, _OCAT, 3, start=start, max_iter=3)
    return model.predict(df).select("o_orderkey", "cluster", "distance")


_PNUM, _PCAT = ["p_size", "p_retailprice"], ["p_brand", "p_type"]
_PSCALED = "s AS (SELECT p_partkey, p_brand, p_type, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in _PNUM) + " FROM part)"
_PSTART = [(-1.0, -1.0, "'Brand#1'", "'ECONOMY'"), (0.0, 0.5, "'Brand#2'", "'PROMO'"), (1.0, 1.0, "'Brand#9'", "'SMALL'")]


def _mixed_dist(i):
    return (_dist_sql(_PCAT, [f"p{i}_2", f"p{i}_3"], "m") + " + 0.8 * " + _dist_sql(_PNUM, [f"p{i}_0", f"p{i}_1"]))


def _scaled_part(spark, sf):
    df = load(spark, sf, "part").select("p_partkey", *_PCAT, *[F.col(c).cast("double").alias(c) for c in _PNUM])
    return clean.standard_scale(df, _PNUM)


@query("u4_kprototypes", lloyd_sql(_PSCALED, "s", [*_PNUM, *_PCAT], _PSTART, 3, cat=_PCAT, dist=_mixed_dist)
       + "SELECT p_partkey, cluster, round(distance, 5) AS distance FROM a2")
def _(spark, sf):
    df = _scaled_part(spark, sf)
    start = [tuple(v.strip("'") if isinstance(v, str) else v for v in c) for c in _PSTART]
    model = cluster.kprototypes(df, _PNUM, _PCAT, 3, gamma=0.8, start=start, max_iter=3)
    return rounded(model.predict(df).select("p_partkey", "cluster", "distance"), 5, "distance")


_ESRC = ("s AS (SELECT event_id, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS x, "
         "(h - avg(h) OVER ()) / stddev_pop(h) OVER () AS y FROM (SELECT event_id, value, hour(ts)::DOUBLE AS h FROM events))")
_ESTART = [(-0.5, -1.0), (0.0, 1.0), (2.0, 0.0)]


def _fcm_sql(n_iter, start=_ESTART, k=3):
    parts = [_ESRC, f"c0 AS ({_values(start)})"]
    for t in range(n_iter + 1):
        w = ", ".join(f"pow(greatest({_dist_sql(['x', 'y'], [f'p{i}_0', f'p{i}_1'])}, 2.220446049250313e-16), -2) AS w{i}" for i in range(k))
        tot = " + ".join(f"w{i}" for i in range(k))
        us = ", ".join(f"w{i} / ({tot}) AS u{i}" for i in range(k))
        parts.append(f"u{t} AS MATERIALIZED (SELECT event_id, x, y, {us} FROM (SELECT s.*, {w} FROM s, c{t}))")
        parts.append(f"c{t + 1} AS MATERIALIZED (SELECT " + ", ".join(
            f"sum(u{i} * u{i} * {c}) / sum(u{i} * u{i}) AS p{i}_{j}" for i in range(k) for j, c in enumerate("xy")) + f" FROM u{t})")
    return "WITH " + ",\n".join(parts) + "\n"


def _event_points(spark, sf):
    df = load(spark, sf, "events").select("event_id", F.col("value").alias("x"),
                                          F.hour("ts").cast("double").alias("y"))
    return clean.standard_scale(df, ["x", "y"])


@query("u5_fuzzy_cmeans", _fcm_sql(4) + " UNION ALL ".join(
    f"SELECT {i} AS cluster, round(p{i}_0, 5) + 0.0 AS x, round(p{i}_1, 5) + 0.0 AS y FROM c4" for i in range(3)))
def _(spark, sf):
    model = cluster.fuzzy_cmeans(_event_points(spark, sf), ["x", "y"], 3, start=_ESTART, tol=0.0, max_iter=4)
    out = spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(model.centroids)],
                                "cluster int, x double, y double")
    return rounded(out, 5, "x", "y")


@query("u6_defuzzify", _fcm_sql(0) + "SELECT event_id, CASE WHEN u0 >= u1 AND u0 >= u2 THEN 0 WHEN u1 >= u2 THEN 1 ELSE 2 END AS cluster, "
       "round(u0, 6) AS u0, round(u1, 6) AS u1, round(u2, 6) AS u2 FROM u0")
def _(spark, sf):
    u = cluster.memberships(_event_points(spark, sf), ["x", "y"], _ESTART)
    out = cluster.defuzzify(u)
    return out.select("event_id", "cluster", *[rnd(F.get("u", F.lit(i))).alias(f"u{i}") for i in range(3)])


@query("u7_membership_change", _fcm_sql(3) + " UNION ALL ".join(
    f"SELECT {t} AS iteration, round(max(greatest(abs(a.u0 - b.u0), abs(a.u1 - b.u1), abs(a.u2 - b.u2))), 5) AS max_change, "
    f"round(avg((abs(a.u0 - b.u0) + abs(a.u1 - b.u1) + abs(a.u2 - b.u2)) / 3), 6) AS mean_change "
    f"FROM u{t} a JOIN u{t - 1} b USING (event_id)" for t in (1, 2, 3)))
def _(spark, sf):
    df = _event_points(spark, sf)
    model = cluster.fuzzy_cmeans(df, ["x", "y"], 3, start=_ESTART, tol=0.0, max_iter=3)
    return rounded(rounded(cluster.membership_change(df, model), 5, "max_change"), 6, "mean_change")


@query("u8_agglomerative")
def _(spark, sf):
    df = _scaled_part(spark, sf)
    return hierarchy.agglomerative(df, _PNUM, 3, linkage="average").select("p_partkey", "cluster")


def _brand_means(spark, sf):
    return load(spark, sf, "part").groupBy("p_brand").agg(
        F.avg("p_size").alias("x"), (F.avg("p_retailprice") / 100).alias("y"))


# merges one by one: the labels of all points, then the pair of labels with the least linkage
def _hierarchy_sql(linkage: str, k: int) -> str:
    return f"""
WITH RECURSIVE o AS (
  SELECT *, row_number() OVER (ORDER BY x, y) AS i
  FROM (SELECT p_brand, avg(p_size) AS x, avg(p_retailprice) / 100 AS y FROM part GROUP BY 1)),
d AS (SELECT a.i AS i, b.i AS j, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS d FROM o a JOIN o b ON a.i < b.i),
s AS (
  SELECT 0 AS step, (SELECT list(i ORDER BY i) FROM o) AS lab
  UNION ALL
  SELECT step + 1, list_transform(lab, lambda l: CASE WHEN l = m.b THEN m.a ELSE l END)
  FROM s, LATERAL (
    SELECT least(s.lab[d.i], s.lab[d.j]) AS a, greatest(s.lab[d.i], s.lab[d.j]) AS b
    FROM d WHERE s.lab[d.i] <> s.lab[d.j] GROUP BY 1, 2 ORDER BY {linkage}(d.d), 1, 2 LIMIT 1) m
  WHERE step < (SELECT count(*) FROM o) - {k})
SELECT p_brand, (dense_rank() OVER (ORDER BY lab[i]) - 1)::INTEGER AS cluster
FROM o, (SELECT lab FROM s ORDER BY step DESC LIMIT 1)"""


def _hierarchy_query(linkage: str):
    return lambda spark, sf: hierarchy.agglomerative(_brand_means(spark, sf), ["x", "y"], 5, linkage=linkage).select("p_brand", "cluster")


for _linkage, _fn in (("single", "min"), ("complete", "max"), ("average", "avg")):
    query(f"u8_{_linkage}_linkage", _hierarchy_sql(_fn, 5))(_hierarchy_query(_linkage))


@query("u8_linkage_table", """
WITH m AS (SELECT o_orderpriority AS g, avg(o_totalprice) AS x, avg(o_custkey) AS y FROM orders GROUP BY 1)
SELECT a.g AS a, b.g AS b, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 4) + 0.0 AS distance
FROM m a, m b""")
def _(spark, sf):
    means = load(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.array(F.avg("o_totalprice"), F.avg("o_custkey").cast("double")).alias("x"))
    points = with_ordinal(means, ["o_orderpriority"], "id")
    pairs = hierarchy.pair_table(points.select("id", "x"))
    both = pairs.select(F.inline(F.array(F.struct("a", "b", "m"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "m")))).unionByName(
        points.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("m")))
    name = lambda c: points.select(F.col("id").alias(c), F.col("o_orderpriority").alias(f"{c}_name"))
    out = both.join(name("a"), "a").join(name("b"), "b").select(
        F.col("a_name").alias("a"), F.col("b_name").alias("b"), F.col("m").alias("distance"))
    return rounded(out, 4, "distance")


@query("u9_make_clusterer", lloyd_sql("s AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders)", "s", _OCAT,
                                      _OSTART, 2, "matching", _OCAT)
       + "SELECT cluster, count(*) AS n, 'hamming' AS metric FROM a1 GROUP BY 1")
def _(spark, sf):
    df = load(spark, sf, "orders", "o_orderkey", *_OCAT)
    fit, metric = cluster.make_clusterer("kmodes")
    model = fit(df, _OCAT, 3, start=[tuple(v.strip("'") for v in c) for c in _OSTART], max_iter=2)
    return model.predict(df).groupBy("cluster").agg(F.count("*").alias("n")).withColumn("metric", F.lit(metric))


@query("u10_seed_scores")
def _(spark, sf):
    df = _scaled_part(spark, sf)
    scores = cluster.seed_scores(df, [1, 2, 3, 4], 3, "p_type", numeric=_PNUM, key=["p_partkey"], max_iter=8)
    best = cluster.best_seed(scores).withColumn("best", F.lit(True))
    return scores.join(best.select("seed", "best"), "seed", "left").na.fill(False, ["best"])


@query("u11_elbow", " UNION ALL ".join(
    f"(WITH {_PSCALED}, a AS ({_assign_sql('s', _PNUM, k, '(' + _values([c[:2] for c in START][:k]) + ')')}) "
    f"SELECT {k} AS k, round(sum(distance), 3) AS inertia FROM a)" for k in (2, 3, 4)))
def _(spark, sf):
    starts = {k: [c[:2] for c in START][:k] for k in (2, 3, 4)}
    out = cluster.elbow(_scaled_part(spark, sf), [2, 3, 4], numeric=_PNUM, starts=starts, max_iter=1)
    return rounded(out.drop("iterations"), 3, "inertia")


@query("u12_silhouette_sweep")
def _(spark, sf):
    df = _scaled_part(spark, sf)
    return cluster.silhouette_sweep(df, [2, 3, 4], _PNUM, key="p_partkey", metric="manhattan", max_iter=10)


# ---- M -------------------------------------------------------------------
_LAB = f"WITH {_SCALED}, l AS ({_assign_sql('s', NUM, 4, '(' + _values(START) + ')')}) "


def labelled(spark, sf):
    return cluster.assign_nearest(scaled_lineitem(spark, sf), NUM, START)


_CT = _LAB + """, t AS (SELECT l_returnflag AS y, cluster AS p, count(*) AS n FROM l GROUP BY 1, 2),
a AS (SELECT y, sum(n)::DOUBLE AS a FROM t GROUP BY 1), b AS (SELECT p, sum(n)::DOUBLE AS b FROM t GROUP BY 1),
g AS (SELECT sum(n)::DOUBLE AS g FROM t) """


@query("m1_contingency", _CT + "SELECT y AS l_returnflag, p AS cluster, n FROM t")
def _(spark, sf):
    return metrics.contingency(labelled(spark, sf), "l_returnflag", "cluster")


@query("m1_confusion_matrix", _LAB + """SELECT l_returnflag, count(*) FILTER (cluster = 0) AS "0", count(*) FILTER (cluster = 1) AS "1",
count(*) FILTER (cluster = 2) AS "2", count(*) FILTER (cluster = 3) AS "3" FROM l GROUP BY 1""")
def _(spark, sf):
    return metrics.confusion_matrix(labelled(spark, sf), "l_returnflag", "cluster", [0, 1, 2, 3])


@query("m2_purity", _CT + "SELECT round(sum(m)::DOUBLE / (SELECT g FROM g), 6) AS purity FROM (SELECT max(n) AS m FROM t GROUP BY p)")
def _(spark, sf):
    return rounded(metrics.purity(labelled(spark, sf), "l_returnflag", "cluster"), 6, "purity")


@query("m3_adjusted_rand", _CT + """, z AS (SELECT (SELECT sum(n * (n - 1) / 2.0) FROM t)::DOUBLE AS s, (SELECT sum(a * (a - 1) / 2) FROM a) AS a,
  (SELECT sum(b * (b - 1) / 2) FROM b) AS b, (SELECT g * (g - 1) / 2 FROM g) AS t)
SELECT round((s - a * b / t) / ((a + b) / 2 - a * b / t), 8) + 0.0 AS adjusted_rand FROM z""")
def _(spark, sf):
    return rounded(metrics.adjusted_rand(labelled(spark, sf), "l_returnflag", "cluster"), 8, "adjusted_rand")


_AMI_TAIL = """
h AS (SELECT (SELECT sum(n / g * ln(n * g / (a * b))) FROM t JOIN a USING (y) JOIN b USING (p), g) AS mi,
  (SELECT -sum(a / g * ln(a / g)) FROM a, g) AS hy, (SELECT -sum(b / g * ln(b / g)) FROM b, g) AS hp),
x AS (SELECT a, b, g, unnest(range(greatest(1, a + b - g)::BIGINT, least(a, b)::BIGINT + 1))::DOUBLE AS n FROM a, b, g),
e AS (SELECT sum(n / g * ln(n * g / (a * b)) * exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(g - a + 1) + lgamma(g - b + 1)
  - lgamma(g + 1) - lgamma(n + 1) - lgamma(a - n + 1) - lgamma(b - n + 1) - lgamma(g - a - b + n + 1))) AS e FROM x)
SELECT round(mi, 6) AS mutual_info, round(hy, 6) AS entropy_true, round(hp, 6) AS entropy_pred,
  round(e, 6) AS expected_mutual_info, round((mi - e) / ((hy + hp) / 2 - e), 6) + 0.0 AS adjusted_mutual_info FROM h, e"""


@query("m4_adjusted_mutual_info", """
WITH t AS (SELECT p_type AS y, least(floor(p_size / 11), 3)::INTEGER AS p, count(*) AS n FROM part GROUP BY 1, 2),
a AS (SELECT y, sum(n)::DOUBLE AS a FROM t GROUP BY 1), b AS (SELECT p, sum(n)::DOUBLE AS b FROM t GROUP BY 1),
g AS (SELECT sum(n)::DOUBLE AS g FROM t), """ + _AMI_TAIL)
def _(spark, sf):
    df = load(spark, sf, "part").select("p_type", F.least(F.floor(F.col("p_size") / 11), F.lit(3)).cast("int").alias("p"))
    out = metrics.adjusted_mutual_info(df, "p_type", "p")
    return rounded(out, 6, *out.columns)


_SIL = """SELECT {id}, cluster, round(CASE WHEN n <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END, 6) + 0.0 AS silhouette
FROM (SELECT {id}, cluster, max(own_n) AS n, max(own) AS a, min(other) AS b FROM (
  SELECT {id}, cluster, CASE WHEN cluster = c2 THEN n END AS own_n,
         CASE WHEN cluster = c2 THEN s / greatest(n - 1, 1) END AS own, CASE WHEN cluster <> c2 THEN s / n END AS other
  FROM (SELECT x.{id}, x.cluster, y.cluster AS c2, count(*) AS n, sum({dist}) AS s FROM l x, l y GROUP BY ALL)) GROUP BY ALL)"""


@query("m5_silhouette_euclidean", "WITH l AS (SELECT vec_id, label AS cluster, embedding::DOUBLE[] AS v FROM embeddings) "
       + _SIL.format(id="vec_id", dist="list_distance(x.v, y.v)"))
def _(spark, sf):
    df = load(spark, sf, "embeddings").select("vec_id", F.col("label").alias("cluster"), "embedding")
    out = metrics.silhouette_samples(df, "vec_id", "embedding", "cluster", "euclidean")
    return rounded(out.select("vec_id", "cluster", "silhouette"), 6, "silhouette")


_PLAB = (f"WITH {_PSCALED}, l AS ({_assign_sql('s', _PNUM, 3, '(' + _values([c[:2] for c in START][:3]) + ')')}) ")


def _labelled_part(spark, sf):
    return cluster.assign_nearest(_scaled_part(spark, sf), _PNUM, [c[:2] for c in START][:3])


@query("m5_silhouette_manhattan", _PLAB + _SIL.format(
    id="p_partkey", dist="abs(x.p_size - y.p_size) + abs(x.p_retailprice - y.p_retailprice)"))
def _(spark, sf):
    out = metrics.silhouette_samples(_labelled_part(spark, sf), "p_partkey", _PNUM, "cluster", "manhattan", buckets=16)
    return rounded(out.select("p_partkey", "cluster", "silhouette"), 6, "silhouette")


@query("m5_silhouette_hamming", _PLAB + _SIL.format(
    id="p_partkey", dist="((x.p_brand <> y.p_brand)::INTEGER + (x.p_type <> y.p_type)::INTEGER) / 2.0::DOUBLE"))
def _(spark, sf):
    out = metrics.silhouette_samples(_labelled_part(spark, sf), "p_partkey", _PCAT, "cluster", "hamming")
    return rounded(out.select("p_partkey", "cluster", "silhouette"), 6, "silhouette")


@query("m5_silhouette_lineitem")
def _(spark, sf):
    out = metrics.silhouette_samples(labelled(spark, sf), "l_orderkey", NUM, "cluster", "manhattan")
    return out.select("l_orderkey", "l_linenumber", "cluster", "silhouette")


@query("m6_silhouette_score", _PLAB + "SELECT round(avg(silhouette), 5) + 0.0 AS silhouette FROM (" + _SIL.format(
    id="p_partkey", dist="sqrt(pow(x.p_size - y.p_size, 2) + pow(x.p_retailprice - y.p_retailprice, 2))") + ")")
def _(spark, sf):
    return rounded(metrics.silhouette_score(_labelled_part(spark, sf), "p_partkey", _PNUM, "cluster", "euclidean"), 5, "silhouette")


@query("m7_davies_bouldin", _LAB + ", c AS (SELECT cluster AS g, " + ", ".join(f"avg({c}) AS m{j}" for j, c in enumerate(NUM))
       + " FROM l GROUP BY 1), sp AS (SELECT g, avg(" + _dist_sql(NUM, [f"m{j}" for j in range(4)]) + ") AS s FROM l JOIN c ON cluster = g GROUP BY 1)"
       " SELECT round(avg(r), 6) AS davies_bouldin FROM (SELECT a.g, max((sa.s + sb.s) / " + _dist_sql([f"a.m{j}" for j in range(4)], [f"b.m{j}" for j in range(4)])
       + ") AS r FROM c a JOIN c b ON a.g <> b.g JOIN sp sa ON sa.g = a.g JOIN sp sb ON sb.g = b.g GROUP BY 1)")
def _(spark, sf):
    return rounded(metrics.davies_bouldin(labelled(spark, sf), NUM, "cluster"), 6, "davies_bouldin")


_FLAGS = {"A": 0, "N": 1, "R": 2}
_MATCH = _LAB + """, y AS (SELECT *, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y FROM l),
t AS (SELECT y, cluster, count(*) AS n FROM y GROUP BY 1, 2),
m0 AS (SELECT cluster FROM t WHERE y = 0 ORDER BY n DESC, cluster LIMIT 1),
m1 AS (SELECT cluster FROM t WHERE y = 1 AND cluster NOT IN (FROM m0) ORDER BY n DESC, cluster LIMIT 1),
m2 AS (SELECT cluster FROM t WHERE y = 2 AND cluster NOT IN (FROM m0) AND cluster NOT IN (FROM m1) ORDER BY n DESC, cluster LIMIT 1),
r AS (SELECT *, CASE WHEN cluster = (FROM m0) THEN 0 WHEN cluster = (FROM m1) THEN 1 WHEN cluster = (FROM m2) THEN 2 ELSE cluster END AS p FROM y) """


def _flagged(spark, sf):
    y = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return labelled(spark, sf).withColumn("y", y)


@query("m8_match_labels", _MATCH + "SELECT y, p AS cluster, count(*) AS n FROM r GROUP BY 1, 2")
def _(spark, sf):
    return metrics.contingency(metrics.rename_labels(_flagged(spark, sf), "y", "cluster"), "y", "cluster")


@query("m9_f_measure", _MATCH + "SELECT round(avg((y = p)::INTEGER), 6) AS f_measure FROM r")
def _(spark, sf):
    return rounded(metrics.f_measure(metrics.rename_labels(_flagged(spark, sf), "y", "cluster"), "y", "cluster"), 6, "f_measure")


@query("m9_f_measure_binary", """
SELECT round(2.0 * count(*) FILTER (quality = 1 AND toxic = 1) / (sum(quality) + sum(toxic)), 6) AS f_measure FROM labels""")
def _(spark, sf):
    return rounded(metrics.f_measure(load(spark, sf, "labels"), "quality", "toxic", 1), 6, "f_measure")


@query("m10_accuracy", "SELECT round(avg((quality = 1 - toxic)::INTEGER), 6) AS accuracy FROM labels")
def _(spark, sf):
    df = load(spark, sf, "labels").withColumn("guess", 1 - F.col("toxic"))
    return rounded(metrics.accuracy(df, "quality", "guess"), 6, "accuracy")


@query("m11_cluster_report")
def _(spark, sf):
    df = _labelled_part(spark, sf).withColumn("y", F.pmod(F.hash("p_type"), F.lit(3)))
    return metrics.cluster_report(df, "y", "cluster", _PNUM, "p_partkey", "manhattan")


@query("m12_r2", """
SELECT round(1 - sum(pow(l_extendedprice - 2000 * l_quantity, 2)) / sum(pow(l_extendedprice - m, 2)), 6) AS r2
FROM lineitem, (SELECT avg(l_extendedprice) AS m FROM lineitem)""")
def _(spark, sf):
    df = load(spark, sf, "lineitem").withColumn("guess", F.col("l_quantity") * 2000)
    return rounded(metrics.r2(df, "l_extendedprice", "guess"), 6, "r2")
