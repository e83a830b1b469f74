"""Queries of the S and Z families. Files are written from the given tables to
the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions import tokens as T
from tabulon.functions.html import html_to_text
from tabulon.functions.scale import scratch_path
from tabulon.operators import clean, decompose, frame, series
from tabulon.plans.lazy_queries import _E, _HALF_E, _halves, majority_sql, near_cte, vectors
from tabulon.plans.registry import load, query, rnd, rounded
from tabulon.plans.text_queries import EVENT_WORD, tagged_events, tok_sql
from tabulon.sources import arff, corpus, tables
from tabulon.streaming import jobs

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("s1_read_arff", """SELECT o_orderkey::DOUBLE AS o_orderkey, nullif(o_orderpriority, '2-HIGH') AS o_orderpriority,
CASE WHEN o_totalprice >= 5000 THEN o_totalprice END AS o_totalprice, o_orderstatus FROM orders""")
def _(spark, sf):
    path = scratch_path(spark, "arff")
    df = load(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("o_orderpriority"),
        F.when(F.col("o_totalprice") >= 5000, F.col("o_totalprice")).alias("o_totalprice"), "o_orderstatus")
    arff.write_arff(df, path, "orders", {"o_orderpriority": PRIORITIES, "o_orderstatus": ["F", "O", "P"]})
    return arff.read_arff(spark, path)


@query("s2_read_folds", """SELECT vec_id::DOUBLE AS vec_id, label::VARCHAR AS label, f.fold::INTEGER AS fold, CASE WHEN vec_id % 2 = f.fold THEN 'test' ELSE 'train' END AS split
FROM embeddings, (SELECT unnest([0, 1]) AS fold) f""")
def _(spark, sf):
    path = scratch_path(spark, "folds")
    df = load(spark, sf, "embeddings", "vec_id", "label").withColumn("label", F.col("label").cast("string"))
    for fold in (0, 1):
        for split, rows in (("test", df.where(F.col("vec_id") % 2 == fold)), ("train", df.where(F.col("vec_id") % 2 != fold))):
            arff.write_arff(rows, f"{path}/vec.fold.{fold:06d}.{split}.arff", "vec", {"label": [str(i) for i in range(10)]})
    return arff.read_folds(spark, f"{path}/*.arff")


@query("s3_read_pairs", r"""SELECT conv_id::VARCHAR AS conv_id, turn, regexp_replace(text, '[\t\r\n]+', ' ', 'g') AS text FROM conversations""")
def _(spark, sf):
    path = scratch_path(spark, "pairs")
    tables.write_pairs(load(spark, sf, "conversations", "conv_id", "turn", "text"), path)
    return tables.read_pairs(spark, path, ["conv_id", "turn", "text"], {"turn": "bigint"})


@query("s4_zip_columns", """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id, quality, toxic FROM labels""")
def _(spark, sf):
    left_path, right_path = scratch_path(spark, "left"), scratch_path(spark, "right")
    df = load(spark, sf, "labels").orderBy("doc_id")
    df.select("doc_id", "quality").write.csv(left_path, sep="\t")
    df.select("toxic").write.csv(right_path, sep="\t")
    left = tables.line_numbers(tables.read_pairs(spark, left_path, ["doc_id", "quality"], {"doc_id": "bigint", "quality": "int"}))
    right = tables.line_numbers(tables.read_pairs(spark, right_path, ["toxic"], {"toxic": "int"}))
    return tables.zip_columns(left, right)


@query("s5_read_many", """SELECT row_number() OVER (ORDER BY part, name) - 1 AS row_id, name FROM (
SELECT 0 AS part, r_name AS name FROM region UNION ALL SELECT 1, n_name FROM nation UNION ALL SELECT 2, s_name FROM supplier)""")
def _(spark, sf):
    parts = [load(spark, sf, t).select(F.col(c).alias("name")) for t, c in
             (("region", "r_name"), ("nation", "n_name"), ("supplier", "s_name"))]
    return tables.read_many(parts)


@query("s6_read_snapshots", """SELECT date_trunc('day', ts) AS ts, count(*) AS n, round(avg(abs(value)), 6) AS ch0, round(avg(abs(value - 10)), 6) AS ch1 FROM events GROUP BY 1""")
def _(spark, sf):
    path = scratch_path(spark, "snapshots")
    df = load(spark, sf, "events").select(F.date_format(F.date_trunc("day", "ts"), "yyyy.MM.dd.HH.mm.ss").alias("stamp"),
                                          F.col("value").alias("ch0"), (F.col("value") - 10).alias("ch1"))
    df.repartition(8, "stamp").write.partitionBy("stamp").csv(path, sep="\t")
    out = tables.read_snapshots(spark, f"{path}/stamp=*", 2).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    agg = out.groupBy("ts").agg(F.count("*").alias("n"), F.avg(F.abs("ch0")).alias("ch0"), F.avg(F.abs("ch1")).alias("ch1"))
    return rounded(agg, 6, "ch0", "ch1")


_RES = "SELECT event_type AS config, (dense_rank() OVER (ORDER BY date_trunc('day', ts)) - 1)::INTEGER AS fold, max(value) AS accuracy FROM events GROUP BY event_type, date_trunc('day', ts)"


def _results(spark, sf):
    return load(spark, sf, "events").groupBy(F.col("event_type").alias("config"), F.date_trunc("day", "ts").alias("day")).agg(
        F.max("value").alias("accuracy"))


@query("s7_read_results_json", _RES)
def _(spark, sf):
    path = scratch_path(spark, "results")
    tables.write_results_json(_results(spark, sf), path, "config", "day", "accuracy")
    return tables.read_results_json(spark, path)


@query("s8_write_results_json", f"SELECT config, count(*) AS folds, round(sum(accuracy), 4) AS total FROM ({_RES}) GROUP BY 1")
def _(spark, sf):
    path = scratch_path(spark, "results")
    tables.write_results_json(_results(spark, sf), path, "config", "day", "accuracy")
    back = tables.read_results_json(spark, path)
    return rounded(back.groupBy("config").agg(F.count("*").alias("folds"), F.sum("accuracy").alias("total")), 4, "total")


@query("s9_feature_table", "SELECT p_partkey, p_brand, p_size, p_retailprice, (p_size > 25)::INTEGER AS score FROM part")
def _(spark, sf):
    path = scratch_path(spark, "features")
    df = load(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice", (F.col("p_size") > 25).cast("int").alias("score"))
    tables.write_features(df, path)
    return tables.read_features(spark, path, df.schema)


_SENT = f"""(SELECT doc_id, lang, (i - 1)::INTEGER AS sent_id, s[i] AS s FROM (SELECT doc_id, lang, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, lang,
 list_filter(list_transform(string_split_regex(text, '{T.SENTENCE_END}'), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)))"""


@query("s10_category_words", f"SELECT lang AS category, doc_id, sent_id, (p - 1)::INTEGER AS pos, t[p] AS word FROM (SELECT lang, doc_id, sent_id, t, unnest(range(1, len(t) + 1)) AS p FROM (SELECT lang, doc_id, sent_id, {tok_sql('s')} AS t FROM {_SENT}))")
def _(spark, sf):
    return corpus.category_words(load(spark, sf, "documents"), "lang", "text", "doc_id")


@query("s10_tagged_corpus", f"SELECT event_type AS category, user_id AS sent_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, {EVENT_WORD} AS token, event_type AS tag FROM events")
def _(spark, sf):
    df = tagged_events(spark, sf).withColumn("category", F.col("tag"))
    return corpus.tagged_corpus(df, "category", "user_id", ["ts", "event_id"], "word", "tag")


def write_vectors(spark, sf, path):
    """Vector of a label name and of every third vector id, as a text file."""
    e = load(spark, sf, "embeddings").orderBy("vec_id").select(F.concat_ws(" ", F.concat(F.lit("w"), "vec_id"), F.array_join(
        F.transform("embedding", lambda x: F.round(x.cast("double"), 4).cast("string")), " ")).alias("value"))
    e.write.text(path)


def _event_tokens(spark, sf):
    return load(spark, sf, "events").select(F.array(F.concat(F.lit("w"), F.col("user_id").cast("string"))).alias("tokens"))


_WV = "SELECT 'w' || vec_id AS word, len(embedding)::INTEGER AS d, round(list_sum(list_transform(embedding, lambda x: round(x::DOUBLE, 4))), 6) + 0.0 AS total FROM embeddings"


def _vec_summary(df):
    return df.select("word", F.size("vec").alias("d"), rnd(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)).alias("total"))


@query("s11_read_word_vectors", _WV + " WHERE 'w' || vec_id IN (SELECT 'w' || user_id FROM events)")
def _(spark, sf):
    path = scratch_path(spark, "vectors")
    write_vectors(spark, sf, path)
    return _vec_summary(corpus.read_word_vectors(spark, path, vocab=corpus.vocabulary(_event_tokens(spark, sf))))


@query("s11_read_first_vectors", _WV + " WHERE vec_id <= 100")
def _(spark, sf):
    path = scratch_path(spark, "vectors")
    write_vectors(spark, sf, path)
    return _vec_summary(corpus.read_word_vectors(spark, path, first_k=100))


@query("s12_extend_vocab", _WV + " WHERE vec_id < 10 OR vec_id IN (SELECT user_id FROM events)")
def _(spark, sf):
    source = load(spark, sf, "embeddings").select(F.concat(F.lit("w"), "vec_id").alias("word"), F.transform(
        "embedding", lambda x: F.round(x.cast("double"), 4)).alias("vec"), "vec_id")
    start = source.where("vec_id < 10").drop("vec_id")
    return _vec_summary(corpus.extend_vocab(start, source.drop("vec_id"), _event_tokens(spark, sf)))


# every "<" opens a part; what follows a part's ">" is text unless a script or style is open
@query("s13_html_to_text", r"""
WITH p AS (SELECT page_id, unnest(string_split(html, '<')) AS part, generate_subscripts(string_split(html, '<'), 1) AS i FROM pages),
m AS (SELECT *, lower(regexp_extract(part, '^(/?[A-Za-z]+)', 1)) AS tag FROM p),
o AS (SELECT *, arg_max(tag, i) FILTER (tag IN ('script', '/script', 'style', '/style')) OVER (
        PARTITION BY page_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS state FROM m),
v AS (SELECT page_id, string_agg(CASE WHEN i = 1 THEN part WHEN state IN ('script', 'style') THEN ''
        ELSE substr(part, instr(part, '>') + 1) END, ' ' ORDER BY i) AS t FROM o GROUP BY 1),
e AS (SELECT page_id, replace(replace(replace(replace(replace(t, '&middot;', chr(183)), '&copy;', chr(169)), '&quot;', '"'),
        '&nbsp;', ' '), '&amp;', '&') AS t FROM v)
SELECT page_id, array_to_string(list_filter(regexp_split_to_array(t, '[ \t\r\n]+'), lambda x: x <> ''), ' ') AS text FROM e""")
def _(spark, sf):
    return load(spark, sf, "pages").select("page_id", html_to_text("html").alias("text"))


@query("s14_fitted_state", "SELECT p_partkey, round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 6) + 0.0 AS p_retailprice FROM part")
def _(spark, sf):
    path = scratch_path(spark, "state")
    df = load(spark, sf, "part", "p_partkey", "p_retailprice")
    tables.save_state(clean.moments_fit(df, ["p_retailprice"]), path)
    return rounded(clean.standard_transform(df, tables.load_state(spark, path)), 6, "p_retailprice")


# ---- Z -------------------------------------------------------------------
_HOUR = "SELECT event_type, date_trunc('hour', ts) AS window_start, round(avg(abs(value)), 6) AS value FROM events GROUP BY 1, 2"


def _event_series(spark, sf):
    return load(spark, sf, "events", "event_type", "ts", "value")


@query("z1_snapshot_features", _HOUR)
def _(spark, sf):
    return rounded(series.window_features(_event_series(spark, sf), "ts", "1 hour", ["value"], ["event_type"]), 6, "value")


@query("z2_train_test_by_time", """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-10 23:52:39')
SELECT ts, round((value - lo) / (hi - lo), 6) + 0.0 AS value, 'train' AS part FROM events, s WHERE ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-10 23:52:39'
UNION ALL SELECT ts, round((value - lo) / (hi - lo), 6) + 0.0, 'test' FROM events, s WHERE ts >= TIMESTAMP '2024-01-10 23:52:39'""")
def _(spark, sf):
    df = load(spark, sf, "events", "ts", "value")
    train, test, _state = series.train_test_by_time(df, "ts", ("2024-01-01 00:00:00", "2024-01-10 23:52:39"), ("2024-01-10 23:52:39",), ["value"])
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return rounded(both, 6, "value")


def _even(lo: float, hi: float, n: int) -> list[tuple[float, float, float]]:
    """n triangles with evenly spaced peaks from lo to hi."""
    step = (hi - lo) / (n - 1)
    return [(lo + (k - 1) * step, lo + k * step, lo + (k + 1) * step) for k in range(n)]


# priority in 0..100: a level up with each step of quantity, a level down with a discount
_STEPS, _CUTS = 4, 2
RULES = series.RuleBase(
    inputs={"l_quantity": _even(2.0, 50.0, _STEPS), "l_discount": _even(0.0, 0.1, _CUTS)},
    output=_even(0.0, 100.0, _STEPS + _CUTS - 1), output_range=(0.0, 100.0),
    rules=[((q, d), q + _CUTS - 1 - d) for q in range(_STEPS) for d in range(_CUTS)])


def _tri_sql(x, t):
    a, b, c = t
    return f"greatest(least(({x} - {a!r}::DOUBLE) / {b - a!r}::DOUBLE, ({c!r}::DOUBLE - {x}) / {c - b!r}::DOUBLE), 0)"


_MF = ", ".join(f"{_tri_sql(v, t)} AS {v}_{i}" for v, sets in RULES.inputs.items() for i, t in enumerate(sets))


@query("z3_fuzzy_membership", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round({_tri_sql(v, t)}, 6) + 0.0 AS {v}_{i}" for v, sets in RULES.inputs.items() for i, t in enumerate(sets)) + " FROM lineitem")
def _(spark, sf):
    df = series.memberships(load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount"), RULES)
    names = [c for c in df.columns if c[-2] == "_"]
    return rounded(df.drop("l_quantity", "l_discount"), 6, *names)


_FIRE = ", ".join("greatest(" + ", ".join(f"least(l_quantity_{a}, l_discount_{b})" for (a, b), out in RULES.rules if out == o) + f") AS f{o}" for o in range(len(RULES.output)))
_CUT_OFF = ", ".join(f"least(f{o}, s{o})" for o in range(len(RULES.output)))


@query("z4_fuzzy_score", f"""
WITH p AS (SELECT DISTINCT l_quantity, l_discount FROM lineitem), m AS (SELECT *, {_MF} FROM p), f AS (SELECT l_quantity, l_discount, {_FIRE} FROM m),
g AS (SELECT y, {", ".join(f"{_tri_sql('y', t)} AS s{o}" for o, t in enumerate(RULES.output))} FROM (SELECT unnest(range(101))::DOUBLE AS y)),
c AS (SELECT l_quantity, l_discount, sum(y * h) AS n, sum(h) AS d FROM (SELECT l_quantity, l_discount, y, greatest({_CUT_OFF}) AS h FROM f, g) GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, round(CASE WHEN d > 0 THEN n / d ELSE 50 END, 6) AS score FROM lineitem JOIN c USING (l_quantity, l_discount)""")
def _(spark, sf):
    df = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return rounded(series.fuzzy_score(df, RULES).select("l_orderkey", "l_linenumber", "score"), 6, "score")


def _stream(spark, sf, table):
    batch = load(spark, sf, table)
    return spark.readStream.schema(batch.schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf)


@query("z5_stream_snapshot_features", _HOUR)
def _(spark, sf):
    # a closing row past the end pushes the watermark over the last window
    src = scratch_path(spark, "stream-in")
    ev = _event_series(spark, sf)
    end = ev.agg(F.max("ts").alias("t")).first()["t"]
    ev.write.parquet(f"{src}/a")
    ev.limit(1).select("event_type", (F.lit(end) + F.expr("INTERVAL 50 DAYS")).cast("timestamp_ntz").alias("ts"), "value").write.parquet(f"{src}/b")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 4).parquet(f"{src}/*")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    out = scratch_path(spark, "stream-out")
    # a delay as long as the data: files may arrive in any order
    q = (jobs.stream_snapshot_features(stream, "ts", "1 hour", ["value"], "40 days", ["event_type"])
         .writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "stream-log")).trigger(availableNow=True).start())
    q.awaitTermination()
    done = spark.read.schema("event_type string, window_start timestamp, value double").parquet(out)
    return rounded(done.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), 6, "value")


@query("z6_stream_moments", """SELECT 0 AS i, 0 AS j, count(*) AS n, round(sum(l_quantity), 2) AS sum_i, round(sum(l_quantity * l_quantity), 2) AS sum_ij FROM lineitem
UNION ALL SELECT 0, 1, count(*), round(sum(l_quantity), 2), round(sum(l_quantity * l_tax), 2) FROM lineitem UNION ALL SELECT 1, 1, count(*), round(sum(l_tax), 2), round(sum(l_tax * l_tax), 2) FROM lineitem""")
def _(spark, sf):
    state = scratch_path(spark, "moments")
    jobs.stream_moments(_stream(spark, sf, "lineitem"), ["l_quantity", "l_tax"], state, scratch_path(spark, "log")).awaitTermination()
    return rounded(jobs.read_moments(spark, state).select("i", "j", "n", "sum_i", "sum_ij"), 2, "sum_i", "sum_ij")


@query("z7_stream_lazy_learner", _HALF_E + near_cte("n", 3, 2, "true", "tr", "te") + ", p AS (" + majority_sql("n", 3)
       + ") SELECT id, label, predicted FROM te JOIN p ON test_id = id")
def _(spark, sf):
    train, test = _halves(spark, sf)
    src, base, out = (scratch_path(spark, n) for n in ("cases", "base", "out"))
    test.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(test.schema).option("maxFilesPerTrigger", 1).parquet(src)
    jobs.stream_lazy_learner(stream, train, base, out, scratch_path(spark, "log"), key="id", features="x", label="label",
                             k=3, policy="nr", n_classes=10).awaitTermination()
    return spark.read.parquet(out).select("id", "label", "predicted")
