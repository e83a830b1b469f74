"""Queries of the P, E and C families."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions.vectors import append_cells, drop_leading
from tabulon.operators import clean, explore, frame
from tabulon.plans.registry import load, query, rnd, rounded

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# ---- P -------------------------------------------------------------------
@query("p1_split_features", """
SELECT c_custkey::DOUBLE AS c_custkey, c_nationkey::BIGINT AS c_nationkey, c_acctbal,
       (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::BIGINT AS c_mktsegment
FROM customer""")
def _(spark, sf):
    df = load(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return frame.split_features(df, ["c_nationkey"], "c_mktsegment").frame


@query("p2_drop_keep_columns", "SELECT p_partkey, p_brand, p_size FROM part")
def _(spark, sf):
    df = frame.drop_columns(load(spark, sf, "part"), ["p_name", "p_retailprice"])
    return frame.keep_columns(df, ["p_type"])


@query("p3_filter_rows", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem
WHERE l_quantity < 40 AND l_extendedprice < 50000""")
def _(spark, sf):
    df = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_returnflag")
    return frame.filter_rows(df, (F.col("l_quantity") < 40) & (F.col("l_extendedprice") < 50000))


@query("p4_replace_level", """
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN '4-NOT SPECIFIED'
       ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def _(spark, sf):
    return frame.replace_level(load(spark, sf, "orders", "o_orderkey", "o_orderpriority"),
                               "o_orderpriority", {"5-LOW": "4-NOT SPECIFIED"})


@query("p5_join_features", """
SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice, (p_type = 'ECONOMY')::INTEGER AS is_economy
FROM part""")
def _(spark, sf):
    part = load(spark, sf, "part")
    num = part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    cat = part.select("p_partkey", (F.col("p_type") == "ECONOMY").cast("int").alias("is_economy"))
    return frame.join_features(num, cat, "p_partkey")


@query("p6_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(spark, sf):
    return frame.head(load(spark, sf, "orders", "o_orderkey", "o_totalprice"),
                      [F.desc("o_totalprice"), "o_orderkey"], 20)


@query("p7_sort_by_time", "SELECT event_id, ts, value FROM events ORDER BY ts")
def _(spark, sf):
    df = load(spark, sf, "events", "event_id", "ts", "value")
    text = df.withColumn("ts", F.date_format("ts", "yyyy.MM.dd.HH.mm.ss.SSSSSS"))
    out = frame.sort_by_time(text, "ts", "yyyy.MM.dd.HH.mm.ss.SSSSSS")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("p8_time_slice", """
SELECT event_id, ts, value, 'train' AS part FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-12 23:52:39'
UNION ALL
SELECT event_id, ts, value, 'test' FROM events WHERE ts >= TIMESTAMP '2024-01-12 23:52:39'""")
def _(spark, sf):
    df = load(spark, sf, "events", "event_id", "ts", "value")
    train = frame.time_slice(df, "ts", "2024-01-03 00:00:00", "2024-01-12 23:52:39")
    test = frame.time_slice(df, "ts", "2024-01-12 23:52:39")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("p9_cast_all", """
SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey FROM supplier""")
def _(spark, sf):
    return frame.cast_all(load(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey"), "string")


@query("p10_stack_unstack", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       max(l_quantity) * 2 AS l_quantity, max(l_discount) * 2 AS l_discount
FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    df = load(spark, sf, "lineitem").groupBy(*ids).agg(
        F.max("l_quantity").alias("l_quantity"), F.max("l_discount").alias("l_discount"))
    long = frame.to_long(df, ids, ["l_quantity", "l_discount"]).withColumn("value", F.col("value") * 2)
    return frame.to_wide(long, ids, ["l_quantity", "l_discount"])


@query("p11_prefix_split", """
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey)
       <= floor(0.9 * (SELECT count(*) FROM orders)) THEN 'train' ELSE 'test' END AS split FROM orders""")
def _(spark, sf):
    return frame.prefix_split(load(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 0.9).select(
        "o_orderkey", "split")


@query("p12_random_split", """
SELECT split, n::BIGINT AS n FROM (SELECT ceil(0.2 * count(*))::BIGINT AS t, count(*) AS a FROM customer) s,
LATERAL (SELECT 'test' AS split, t AS n UNION ALL SELECT 'train', a - t)""")
def _(spark, sf):
    out = frame.random_split(load(spark, sf, "customer"), ["c_custkey"], 0.2, 12)
    return out.groupBy("split").agg(F.count("*").alias("n"))


@query("p13_contiguous_folds", """
SELECT c_custkey, (ntile(4) OVER (ORDER BY c_custkey) - 1)::INTEGER AS fold FROM customer""")
def _(spark, sf):
    return frame.contiguous_folds(load(spark, sf, "customer"), ["c_custkey"], 4).select("c_custkey", "fold")


@query("p14_vector_slice", """
SELECT vec_id, round(list_sum(embedding[2:]::DOUBLE[]), 6) + 0.0 AS rest, len(embedding[2:])::INTEGER AS n
FROM embeddings""")
def _(spark, sf):
    df = load(spark, sf, "embeddings").select(
        "vec_id", drop_leading(F.col("embedding").cast("array<double>"), F.size("embedding")).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return df.select("vec_id", rnd(total).alias("rest"), F.size("v").alias("n"))


@query("p15_append_predictions", """
SELECT vec_id, (len(embedding) + 2)::INTEGER AS n, round(embedding[1]::DOUBLE * 0.7, 6) + 0.0 AS p1,
       label * 0.3::DOUBLE AS p2 FROM embeddings""")
def _(spark, sf):
    df = load(spark, sf, "embeddings")
    v = append_cells(F.col("embedding").cast("array<double>"),
                     F.get("embedding", F.lit(0)).cast("double") * 0.7, F.col("label") * F.lit(0.3))
    df = df.select("vec_id", v.alias("v"))
    return df.select("vec_id", F.size("v").alias("n"), rnd(F.element_at("v", -2)).alias("p1"),
                     F.element_at("v", -1).alias("p2"))


# ---- E -------------------------------------------------------------------
@query("e1_null_counts", """
SELECT * FROM (SELECT 'l_quantity' AS "column", count(*) FILTER (nullif(l_quantity, 7) IS NULL) AS nulls FROM lineitem
UNION ALL SELECT 'l_returnflag', count(*) FILTER (nullif(l_returnflag, 'R') IS NULL) FROM lineitem
UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax IS NULL) FROM lineitem)""")
def _(spark, sf):
    df = load(spark, sf, "lineitem").select(
        F.nullif("l_quantity", F.lit(7.0)).alias("l_quantity"),
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"), "l_tax")
    return explore.null_counts(df)


@query("e2_describe_dataset", """
SELECT count(*) AS n_instances, 6::INTEGER AS n_features, 4::INTEGER AS n_num_features, 2::INTEGER AS n_cat_features,
       'double:4, string:2' AS dtypes FROM lineitem""")
def _(spark, sf):
    return explore.describe_dataset(load(spark, sf, "lineitem"), NUM, ["l_returnflag", "l_linestatus"])


@query("e3_value_counts", """
SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS freq FROM orders GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2
ORDER BY freq DESC""")
def _(spark, sf):
    return explore.value_counts(load(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"]).orderBy(
        F.desc("freq"))


@query("e4_level_shares", """
SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS freq,
       round(count(*) / sum(count(*)) OVER (), 6) AS share FROM lineitem GROUP BY 2
UNION ALL SELECT 'l_linestatus', l_linestatus, count(*), round(count(*) / sum(count(*)) OVER (), 6)
FROM lineitem GROUP BY 2""")
def _(spark, sf):
    return explore.level_shares(load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], 6)


@query("e5_distinct_levels", """
SELECT 'p_brand' AS "column", p_brand AS value, count(*) OVER () AS n_levels FROM (SELECT DISTINCT p_brand FROM part)
UNION ALL SELECT 'p_type', p_type, count(*) OVER () FROM (SELECT DISTINCT p_type FROM part)""")
def _(spark, sf):
    return explore.distinct_levels(load(spark, sf, "part"), ["p_brand", "p_type"])


@query("e6_histogram", """
WITH v AS (SELECT 'l_quantity' AS "column", l_quantity AS x FROM lineitem
           UNION ALL SELECT 'l_discount', l_discount * 500 FROM lineitem),
e AS (SELECT min(x) AS lo, (max(x) - min(x)) / 10 AS w FROM v)
SELECT "column", bin, round(lo + bin * w, 6) AS lower, freq FROM (
SELECT "column", least(floor((x - lo) / w), 9)::INTEGER AS bin, count(*) AS freq FROM v, e GROUP BY 1, 2), e""")
def _(spark, sf):
    df = load(spark, sf, "lineitem").select("l_quantity", (F.col("l_discount") * 500).alias("l_discount"))
    return rounded(explore.histogram(df, ["l_quantity", "l_discount"], 10), 6, "lower")


_BOX = """
SELECT '{c}' AS "column", q1, median, q3, min(x) FILTER (x >= q1 - 1.5 * (q3 - q1)) AS low_whisker,
  max(x) FILTER (x <= q3 + 1.5 * (q3 - q1)) AS high_whisker,
  count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
FROM (SELECT {c} AS x FROM {t}), (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
  quantile_cont({c}, 0.75) AS q3 FROM {t}) GROUP BY ALL"""


@query("e7_box_stats", "SELECT \"column\", round(q1,6) AS q1, round(median,6) AS median, round(q3,6) AS q3, "
       "low_whisker, high_whisker, outliers FROM ("
       + " UNION ALL ".join(_BOX.format(c=c, t="lineitem") for c in ("l_quantity", "l_extendedprice")) + ")")
def _(spark, sf):
    return rounded(explore.box_stats(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]),
                   6, "q1", "median", "q3")


@query("e7_box_stats_events", "SELECT \"column\", round(q1,6) AS q1, round(median,6) AS median, round(q3,6) AS q3, "
       "low_whisker, high_whisker, outliers FROM (" + _BOX.format(c="value", t="events") + ")")
def _(spark, sf):
    return rounded(explore.box_stats(load(spark, sf, "events"), ["value"]), 6, "q1", "median", "q3")


def _pairs_sql(fn: str, name: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round({fn}({a}, {b}), 6) + 0.0 AS {name} FROM lineitem"
        for a in cols for b in cols)


@query("e8_corr_matrix", _pairs_sql("corr", "r", NUM))
def _(spark, sf):
    return rounded(explore.corr_matrix(load(spark, sf, "lineitem"), NUM), 6, "r")


@query("e9_pearson", "SELECT round(corr(n_chars, quality), 6) + 0.0 AS r, count(*) AS n "
       "FROM documents JOIN labels USING (doc_id)")
def _(spark, sf):
    df = load(spark, sf, "documents", "doc_id", "n_chars").join(load(spark, sf, "labels"), "doc_id")
    return rounded(explore.pearson(df, "n_chars", "quality").drop("p_value"), 6, "r")


@query("e10_validate_scores", """
WITH g AS (SELECT doc_id, quality * 5.0::DOUBLE AS gold FROM labels),
s AS (SELECT doc_id, n_chars / 1000.0::DOUBLE AS system FROM documents)
SELECT doc_id, gold, system, CASE WHEN gold IS NULL THEN 'missing gold' WHEN system IS NULL THEN 'missing system'
  WHEN system NOT BETWEEN 0 AND 5 THEN 'system out of range' ELSE 'gold out of range' END AS problem
FROM g FULL JOIN s USING (doc_id)
WHERE gold IS NULL OR system IS NULL OR system NOT BETWEEN 0 AND 5 OR gold NOT BETWEEN 0 AND 5""")
def _(spark, sf):
    gold = load(spark, sf, "labels").select("doc_id", (F.col("quality") * F.lit(5.0)).alias("score"))
    system = load(spark, sf, "documents").select("doc_id", (F.col("n_chars") / 1000.0).alias("score"))
    return explore.validate_scores(gold, system, "doc_id", "score")


@query("e11_cov_matrix", _pairs_sql("covar_samp", "cov", NUM).replace(", 6)", ", 4)"))
def _(spark, sf):
    return rounded(explore.cov_matrix(load(spark, sf, "lineitem"), NUM), 4, "cov")


@query("e12_correlated_pairs", """
SELECT 'qty' AS a, 'total' AS b, round(corr(l_quantity, l_quantity * l_extendedprice), 6) AS r FROM lineitem
UNION ALL SELECT 'price', 'total', round(corr(l_extendedprice, l_quantity * l_extendedprice), 6) FROM lineitem""")
def _(spark, sf):
    df = load(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * F.col("l_extendedprice")).alias("total"))
    return rounded(explore.correlated_pairs(df, ["qty", "price", "total"], 0.5), 6, "r")


@query("e12_drop_correlated", "SELECT l_orderkey, l_linenumber, l_quantity AS qty, l_extendedprice AS price FROM lineitem")
def _(spark, sf):
    df = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * F.col("l_extendedprice")).alias("total"))
    return explore.drop_correlated(df, ["qty", "price", "total"], 0.5, {"qty": 2.0, "price": 1.5, "total": 1.0})


@query("e13_label_sizes", "SELECT label, count(*) AS n FROM embeddings GROUP BY 1")
def _(spark, sf):
    return explore.label_sizes(load(spark, sf, "embeddings", "label"), "label")


# ---- C -------------------------------------------------------------------
def _z_sql(cols, source, extra=""):
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    keep = " AND ".join(f"(({c} IS NULL) OR abs(({c} - m_{c}) / s_{c}) < 3)" for c in cols)
    return f"SELECT {source}.* FROM {source}, (SELECT {stats} FROM {source}) AS st WHERE {keep}{extra}"


@query("c1_drop_outliers", "WITH e AS (SELECT event_id, value, value * value AS power FROM events) "
       + _z_sql(["value", "power"], "e"))
def _(spark, sf):
    df = load(spark, sf, "events").select("event_id", "value", (F.col("value") * F.col("value")).alias("power"))
    return clean.drop_outliers(df, ["value", "power"], 3.0)


@query("c2_standard_scale", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}" for c in NUM) + " FROM lineitem")
def _(spark, sf):
    df = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", *NUM)
    return rounded(clean.standard_scale(df, NUM), 6, *NUM)


@query("c3_minmax_scale", "SELECT l_orderkey, l_linenumber, NULL::DOUBLE AS flat, " + ", ".join(
    f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) + 0.0 AS {c}"
    for c in NUM) + " FROM lineitem")
def _(spark, sf):
    df = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", *NUM).withColumn("flat", F.lit(3.0))
    return rounded(clean.minmax_scale(df, [*NUM, "flat"]), 6, *NUM)


@query("c4_minmax_fit_transform", """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE ts <= TIMESTAMP '2024-01-10 00:00:00')
SELECT event_id, round((value - lo) / (hi - lo), 6) + 0.0 AS value FROM events, s
WHERE ts > TIMESTAMP '2024-01-10 00:00:00'""")
def _(spark, sf):
    df = load(spark, sf, "events", "event_id", "ts", "value")
    cut = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    state = clean.minmax_fit(df.where(F.col("ts") <= cut), ["value"])
    out = clean.minmax_transform(df.where(F.col("ts") > cut).drop("ts"), state)
    return rounded(out, 6, "value")


_HOLES = "(SELECT p_partkey, nullif(p_size, 7)::DOUBLE AS p_size, CASE WHEN p_retailprice >= 905 THEN p_retailprice END AS p_retailprice FROM part)"


def _holes(spark, sf):
    return load(spark, sf, "part").select(
        "p_partkey", F.nullif(F.col("p_size"), F.lit(7)).cast("double").alias("p_size"),
        F.when(F.col("p_retailprice") >= 905, F.col("p_retailprice")).alias("p_retailprice"))


@query("c5_impute_mean", "SELECT p_partkey, " + ", ".join(
    f"round(coalesce({c}, avg({c}) OVER ()), 6) AS {c}" for c in ("p_size", "p_retailprice")) + f" FROM {_HOLES}")
def _(spark, sf):
    return rounded(clean.impute_mean(_holes(spark, sf), ["p_size", "p_retailprice"]), 6, "p_size", "p_retailprice")


@query("c6_impute_median", "SELECT p_partkey, " + ", ".join(
    f"round(coalesce({c}, median({c}) OVER ()), 6) AS {c}" for c in ("p_size", "p_retailprice")) + f" FROM {_HOLES}")
def _(spark, sf):
    df = _holes(spark, sf).withColumn("empty", F.lit(None).cast("double"))
    return rounded(clean.impute_median(df, ["p_size", "p_retailprice", "empty"]), 6, "p_size", "p_retailprice")


@query("c7_label_encode", """
SELECT p_partkey, p_brand, (dense_rank() OVER (ORDER BY p_brand) - 1)::BIGINT AS p_brand_code,
       p_type, (dense_rank() OVER (ORDER BY p_type) - 1)::BIGINT AS p_type_code FROM part""")
def _(spark, sf):
    df = load(spark, sf, "part", "p_partkey", "p_brand", "p_type")
    return clean.label_transform(df, clean.label_fit(df, ["p_brand", "p_type"]), ["p_brand", "p_type"])


@query("c7_label_inverse", "SELECT p_partkey, p_type AS p_type_level FROM part")
def _(spark, sf):
    df = load(spark, sf, "part", "p_partkey", "p_type")
    state = clean.label_fit(df, ["p_type"])
    coded = clean.label_transform(df, state, ["p_type"]).drop("p_type")
    return clean.label_inverse(coded, state, "p_type").drop("p_type_code")


_PRIO = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_SEG = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _hot(col, levels):
    return ", ".join(f"({col} = '{v}')::INTEGER AS \"{col}_{v}\"" for v in levels)


@query("c8_one_hot", f"""
SELECT o_orderkey, {_hot('o_orderpriority', _PRIO)}, {_hot('o_orderstatus', ['F', 'O'])} FROM orders""")
def _(spark, sf):
    df = load(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    # fitted without level P: unseen levels encode to all zeros
    state = clean.one_hot_fit(df.where("o_orderstatus <> 'P'"), ["o_orderpriority", "o_orderstatus"])
    return clean.one_hot_transform(df, state)


@query("c9_get_dummies", f"SELECT c_custkey, c_acctbal, {_hot('c_mktsegment', _SEG)} FROM customer")
def _(spark, sf):
    return clean.get_dummies(load(spark, sf, "customer", "c_custkey", "c_acctbal", "c_mktsegment"),
                             ["c_mktsegment"])


@query("c10_binary_features", """
SELECT 'l_linestatus' AS "column", count(DISTINCT l_linestatus) AS n_levels FROM lineitem
HAVING count(DISTINCT l_linestatus) = 2 AND (SELECT count(DISTINCT l_returnflag) FROM lineitem) <> 2""")
def _(spark, sf):
    return clean.binary_features(load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


def _cut_sql(c, n):
    return (f"CASE WHEN {c} <= lo_{c} + (hi_{c} - lo_{c}) * 1 / {n} THEN 0 "
            + " ".join(f"WHEN {c} <= lo_{c} + (hi_{c} - lo_{c}) * {i} / {n} THEN {i - 1}" for i in range(2, n))
            + f" ELSE {n - 1} END AS {c}")


@query("c11_bin_equal_width", f"""
SELECT event_id, {_cut_sql('value', 4)} FROM events,
(SELECT min(value) AS lo_value, max(value) AS hi_value FROM events)""")
def _(spark, sf):
    return clean.bin_equal_width(load(spark, sf, "events", "event_id", "value"), ["value"], 4)


@query("c12_bin_quantile", """
SELECT o_orderkey, CASE WHEN o_totalprice <= a THEN 0 WHEN o_totalprice <= b THEN 1 ELSE 2 END AS o_totalprice
FROM orders, (SELECT quantile_cont(o_totalprice, 1/3.0) AS a, quantile_cont(o_totalprice, 2/3.0) AS b FROM orders)""")
def _(spark, sf):
    return clean.bin_quantile(load(spark, sf, "orders", "o_orderkey", "o_totalprice"), ["o_totalprice"], 3)


_RARE = "(SELECT p_partkey, CASE WHEN p_size <= 2 THEN 'a' WHEN p_size <= 25 THEN 'b' WHEN p_size <= 48 THEN 'c' ELSE 'd' END AS band FROM part)"


def _bands(spark, sf):
    s = F.col("p_size")
    return load(spark, sf, "part").select("p_partkey", F.when(s <= 2, "a").when(s <= 25, "b").when(
        s <= 48, "c").otherwise("d").alias("band"))


@query("c13_merge_rare_ordinal", f"""
WITH t AS {_RARE}, f AS (SELECT band, count(*) / (SELECT count(*) FROM t) AS share FROM t GROUP BY 1)
SELECT p_partkey, CASE WHEN share >= 0.1 THEN band WHEN band = 'a' THEN 'b' ELSE 'c' END AS band
FROM t JOIN f USING (band)""")
def _(spark, sf):
    return clean.merge_rare_levels(_bands(spark, sf), "band", 0.1, ordinal=True)


@query("c13_merge_rare_common", f"""
WITH t AS {_RARE}, f AS (SELECT band, count(*) / (SELECT count(*) FROM t) AS share FROM t GROUP BY 1)
SELECT p_partkey, CASE WHEN share >= 0.1 THEN band ELSE (SELECT band FROM f ORDER BY share DESC, band LIMIT 1) END AS band
FROM t JOIN f USING (band)""")
def _(spark, sf):
    return clean.merge_rare_levels(_bands(spark, sf), "band", 0.1)


def _scaled(cols, source):
    return ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}" for c in cols)


@query("c14_clean_mixed", f"""
WITH b AS (SELECT o_orderkey, o_totalprice, c_acctbal, c_mktsegment, o_orderpriority, o_orderstatus
           FROM orders JOIN customer ON o_custkey = c_custkey),
k AS ({_z_sql(['o_orderkey', 'o_totalprice', 'c_acctbal'], 'b')}),
m AS (SELECT * REPLACE (CASE o_orderpriority WHEN '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS o_orderpriority) FROM k)
SELECT {_scaled(['o_orderkey', 'o_totalprice', 'c_acctbal'], 'm')},
  {_hot('o_orderpriority', _PRIO[:4])}, {_hot('c_mktsegment', _SEG)},
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END::BIGINT AS o_orderstatus FROM m""")
def _(spark, sf):
    df = (load(spark, sf, "orders").join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
          .select("o_orderkey", "o_totalprice", "c_acctbal", "c_mktsegment", "o_orderpriority", "o_orderstatus"))
    out, split = clean.clean_mixed(df, ["o_orderpriority", "c_mktsegment"], "o_orderstatus",
                                   {"o_orderpriority": {"5-LOW": "4-NOT SPECIFIED"}})
    return rounded(out, 6, *split.numeric)


@query("c15_clean_mean", f"""
WITH b AS (SELECT p_partkey, nullif(p_size, 7)::DOUBLE AS p_size, p_retailprice, p_type,
            dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand FROM part),
i AS (SELECT * REPLACE (coalesce(p_size, avg(p_size) OVER ()) AS p_size) FROM b),
k AS ({_z_sql(['p_partkey', 'p_size', 'p_retailprice'], 'i')})
SELECT {_scaled(['p_partkey', 'p_size', 'p_retailprice'], 'k')},
  {_hot('p_type', ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'])}, p_brand::BIGINT AS p_brand FROM k""")
def _(spark, sf):
    df = load(spark, sf, "part").withColumn("p_size", F.nullif(F.col("p_size"), F.lit(7)))
    out, split = clean.clean_mean(df, ["p_type"], "p_brand", ["p_name"])
    return rounded(out, 6, *split.numeric)


@query("c16_clean_median", f"""
WITH b AS (SELECT p_partkey::DOUBLE AS p_partkey, nullif(p_size, 7)::DOUBLE AS p_size, p_retailprice, p_type,
            dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand FROM part),
i AS (SELECT * REPLACE (coalesce(p_size, median(p_size) OVER ()) AS p_size) FROM b)
SELECT {", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) + 0.0 AS {c}"
                  for c in ("p_partkey", "p_size", "p_retailprice"))},
  {_hot('p_type', ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'])}, p_brand::BIGINT AS p_brand FROM i""")
def _(spark, sf):
    df = load(spark, sf, "part").withColumn("p_size", F.nullif(F.col("p_size"), F.lit(7)))
    out, split, _encoder = clean.clean_median(df, ["p_type"], "p_brand", ["p_name"])
    return rounded(out, 6, *split.numeric)
