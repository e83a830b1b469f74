"""Queries of the L, V and R families."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import functions as F

from tabulon.functions import tokens as T
from tabulon.functions import vectors as V
from tabulon.functions.scale import cut_lineage, spread
from tabulon.operators import embed, frame, lexicon, regress
from tabulon.plans.registry import load, query, rnd, rounded
from tabulon.plans.text_queries import STOP_SQL, _PUNCT_SQL, tok_sql

# ---- stand-in resources -----------------------------------------------------------
# A token's tag follows its length; the lexicon maps long words to their stem.
_TAG_SQL = "CASE length({w}) % 5 WHEN 0 THEN 'NN' WHEN 1 THEN 'VB' WHEN 2 THEN 'JJ' WHEN 3 THEN 'RB' ELSE 'DT' END"
_POS_SQL = "CASE length({w}) % 5 WHEN 0 THEN 'n' WHEN 1 THEN 'v' WHEN 2 THEN 'a' WHEN 3 THEN 'r' END"


def tag_of(w):
    m = F.length(w) % 5
    return F.when(m == 0, "NN").when(m == 1, "VB").when(m == 2, "JJ").when(m == 3, "RB").otherwise("DT")


def conversation_tokens(spark, sf, lower=False):
    text = F.lower("text") if lower else F.col("text")
    return spread(load(spark, sf, "conversations", "conv_id", "turn", "text")).select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("sent_id"), T.word_tokenize(text).alias("tokens"))


def token_rows(spark, sf):
    rows = conversation_tokens(spark, sf).select("sent_id", F.posexplode_outer("tokens").alias("pos", "token"))
    return rows.where(F.col("token").isNotNull()).withColumn("tag", tag_of(F.col("token")))


def lexicon_table(spark, sf):
    """Lemma = first five letters, for every word of seven letters or more."""
    w = token_rows(spark, sf).where(F.length("token") >= 7).select(F.lower("token").alias("word"), F.col("tag")).distinct()
    return w.select("word", T.map_pos("tag").alias("pos"), F.substring("word", 1, 5).alias("lemma")).where("pos IS NOT NULL").distinct()


_TR = f"""WITH d AS (SELECT conv_id * 100 + turn AS sent_id, {tok_sql('text')} AS t FROM conversations),
k AS (SELECT sent_id, (i - 1)::INTEGER AS pos, t[i] AS token FROM (SELECT sent_id, t, unnest(range(1, len(t) + 1)) AS i FROM d)),
r AS (SELECT *, {_TAG_SQL.format(w='token')} AS tag, {_POS_SQL.format(w='token')} AS p, lower(token) AS w FROM k),
lex AS (SELECT DISTINCT w AS word, p AS pos, left(w, 5) AS lemma FROM r WHERE length(token) >= 7 AND p IS NOT NULL) """


@query("l1_map_pos", _TR + "SELECT tag, p AS pos, count(*) AS n FROM r GROUP BY 1, 2")
def _(spark, sf):
    return token_rows(spark, sf).groupBy("tag", T.map_pos("tag").alias("pos")).agg(F.count("*").alias("n"))


@query("l2_lemmatize", _TR + "SELECT sent_id, r.pos, token, CASE WHEN p IS NULL THEN token ELSE coalesce(lemma, w) END AS lemma FROM r LEFT JOIN lex ON lex.word = w AND lex.pos = p")
def _(spark, sf):
    out = lexicon.lemmatize(token_rows(spark, sf), lexicon_table(spark, sf))
    return out.select("sent_id", "pos", "token", "lemma")


@query("l2_lemmatize_nouns_verbs", _TR + "SELECT sent_id, r.pos, token, CASE WHEN p IS NULL OR p NOT IN ('n', 'v') THEN token ELSE coalesce(lemma, w) END AS lemma FROM r LEFT JOIN lex ON lex.word = w AND lex.pos = p")
def _(spark, sf):
    out = lexicon.lemmatize(token_rows(spark, sf), lexicon_table(spark, sf), "NV")
    return out.select("sent_id", "pos", "token", "lemma")


# senses: every benchmark item is a gloss; its words of five letters or more name it
_SENSE = _TR + f"""s AS (SELECT DISTINCT 's' || item_id AS sense_id, word, CASE item_id % 4 WHEN 0 THEN 'n' WHEN 1 THEN 'v' WHEN 2 THEN 'a' ELSE 'r' END AS pos, item_id AS rank, text AS gloss
FROM (SELECT item_id, lower(text) AS text, unnest({tok_sql('lower(text)')}) AS word FROM benchmark) WHERE length(word) >= 3) """.replace("s AS", ", s AS", 1)


def sense_table(spark, sf):
    i = F.col("item_id") % 4
    pos = F.when(i == 0, "n").when(i == 1, "v").when(i == 2, "a").otherwise("r")
    rows = load(spark, sf, "benchmark").select("item_id", F.lower("text").alias("gloss"), F.explode(T.word_tokenize(F.lower("text"))).alias("word"))
    return rows.where(F.length("word") >= 3).select(
        F.concat(F.lit("s"), "item_id").alias("sense_id"), "word", pos.alias("pos"), F.col("item_id").alias("rank"), "gloss").distinct()


@query("l3_pick_sense", _SENSE + """, a AS (SELECT word, pos, arg_min(sense_id, rank) AS s FROM s GROUP BY 1, 2),
b AS (SELECT word, arg_min(sense_id, (CASE pos WHEN 'n' THEN 1 WHEN 'v' THEN 2 WHEN 'a' THEN 3 ELSE 4 END, rank)) AS s FROM s GROUP BY 1)
SELECT sent_id, r.pos, token, coalesce(CASE WHEN p IS NOT NULL THEN a.s ELSE b.s END, b.s, 'default') AS sense FROM r LEFT JOIN a ON a.word = w AND a.pos = p LEFT JOIN b ON b.word = w""")
def _(spark, sf):
    out = lexicon.pick_sense(token_rows(spark, sf), sense_table(spark, sf), "default")
    return out.select("sent_id", "pos", "token", "sense")


_LESK = _SENSE + """, c AS (SELECT r.sent_id, r.pos, s.sense_id, s.pos = p AS same, s.gloss FROM r JOIN s ON s.word = w WHERE p IS NOT NULL {f}),
x AS (SELECT sent_id, list(DISTINCT token) AS ctx FROM r GROUP BY 1),
h AS (SELECT sent_id, pos, sense_id, same, len(list_intersect(list_distinct(list_filter(string_split_regex(gloss, '\\s+'), lambda y: y <> '')), ctx)) AS hits FROM c JOIN x USING (sent_id)),
b AS (SELECT sent_id, pos, arg_max(sense_id, (same, hits, sense_id)) AS s FROM h GROUP BY 1, 2)
SELECT sent_id, pos, token, coalesce(s, token) AS sense FROM r LEFT JOIN b USING (sent_id, pos)"""


@query("l4_lesk", _LESK.replace("{f}", ""))
def _(spark, sf):
    return lexicon.lesk(token_rows(spark, sf), sense_table(spark, sf)).select("sent_id", "pos", "token", "sense")


@query("l4_lesk_with_pos", _LESK.replace("{f}", "AND s.pos = p"))
def _(spark, sf):
    return lexicon.lesk(token_rows(spark, sf), sense_table(spark, sf), "token").select("sent_id", "pos", "token", "sense")


_EDGES = """e AS (SELECT 'R' || r_regionkey AS child, 'root' AS parent FROM region UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer)"""
_CLOSURE = f"WITH RECURSIVE {_EDGES}, c AS (SELECT node, node AS ancestor, 0 AS distance FROM (SELECT child AS node FROM e UNION SELECT 'root') UNION ALL SELECT c.node, e.parent, distance + 1 FROM c JOIN e ON e.child = c.ancestor) "


def hypernym_table(spark, sf):
    r = load(spark, sf, "region").select(F.concat(F.lit("R"), "r_regionkey").alias("child"), F.lit("root").alias("parent"))
    n = load(spark, sf, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("child"), F.concat(F.lit("R"), "n_regionkey").alias("parent"))
    c = load(spark, sf, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("child"), F.concat(F.lit("N"), "c_nationkey").alias("parent"))
    return r.unionByName(n).unionByName(c)


@query("l5_ancestors", _CLOSURE + "SELECT node, ancestor, distance FROM c")
def _(spark, sf):
    return lexicon.ancestors(hypernym_table(spark, sf))


_NODES = _CLOSURE + """, dp AS (SELECT node, max(distance) + 1 AS depth FROM c GROUP BY 1),
ct AS (SELECT 'C' || o_custkey AS node, count(*) AS n FROM orders GROUP BY 1), ic AS (SELECT ancestor AS node, -ln(sum(n) / (SELECT sum(n) FROM ct)) AS ic FROM c JOIN ct USING (node) GROUP BY 1),
pr AS (SELECT DISTINCT 'C' || o_custkey AS a, CASE WHEN o_orderkey % 3 = 0 THEN 'N' || (o_orderkey % 25) ELSE 'C' || ((o_custkey * 7 + o_orderkey) % (SELECT count(*) FROM customer)) END AS b FROM orders),
m AS (SELECT pr.a, pr.b, x.ancestor, x.distance + y.distance AS steps FROM pr JOIN c x ON x.node = a JOIN c y ON y.node = b AND y.ancestor = x.ancestor),
g AS (SELECT a, b, min(steps) AS steps, max(dp.depth) AS lcs, max(ic.ic) AS lic FROM m JOIN dp ON dp.node = ancestor LEFT JOIN ic ON ic.node = ancestor GROUP BY 1, 2) """


def _pairs(spark, sf):
    n = load(spark, sf, "customer").count()
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    other = F.when(k % 3 == 0, F.concat(F.lit("N"), k % 25)).otherwise(F.concat(F.lit("C"), (c * 7 + k) % n))
    return load(spark, sf, "orders").select(F.concat(F.lit("C"), "o_custkey").alias("a"), other.alias("b")).distinct()


def taxonomy_nodes(spark, sf):
    closure = lexicon.ancestors(hypernym_table(spark, sf))
    counts = load(spark, sf, "orders").groupBy(F.concat(F.lit("C"), "o_custkey").alias("node")).agg(F.count("*").alias("n"))
    return cut_lineage(lexicon.node_table(closure, lexicon.information_content(closure, counts)))


@query("l5_information_content", _NODES.split(",\npr AS")[0] + " SELECT node, round(ic, 6) + 0.0 AS ic FROM ic")
def _(spark, sf):
    closure = lexicon.ancestors(hypernym_table(spark, sf))
    counts = load(spark, sf, "orders").groupBy(F.concat(F.lit("C"), "o_custkey").alias("node")).agg(F.count("*").alias("n"))
    return rounded(lexicon.information_content(closure, counts).drop("n"), 6, "ic")


def _similarity(name, expr):
    @query(f"{name}_sim", _NODES + f"SELECT a, b, round({expr}, 6) + 0.0 AS score FROM g JOIN dp da ON da.node = a JOIN dp db ON db.node = b LEFT JOIN ic ia ON ia.node = a LEFT JOIN ic ib ON ib.node = b")
    def _(spark, sf):
        out = lexicon.pair_similarities(_pairs(spark, sf), taxonomy_nodes(spark, sf))
        return out.select("a", "b", rnd(name.split("_")[1]).alias("score"))


_similarity("l6_path", "1.0::DOUBLE / (1 + steps)")
_similarity("l7_lch", "ln((steps + 1) / 8.0) / ln(1 / 8.0)")
_similarity("l8_wup", "2.0::DOUBLE * lcs / (da.depth + db.depth)")
_similarity("l9_lin", "2 * lic / nullif(ia.ic + ib.ic, 0)")


@query("l10_greedy_alignment")
def _(spark, sf):
    nodes = taxonomy_nodes(spark, sf)
    # senses of a customer's orders by priority: the first two priorities against the others
    o = load(spark, sf, "orders").select("o_custkey", F.concat(F.lit("C"), (F.col("o_orderkey") * 13 + F.col("o_custkey")) % load(spark, sf, "customer").count()).alias("node"), "o_orderkey",
                                         F.when(F.col("o_orderpriority") < "3", "a").otherwise("b").alias("side"))
    rows = o.join(nodes, "node").groupBy("o_custkey", "side").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "up"))), lambda s: s["up"]).alias("up"))
    a, b = (rows.where(F.col("side") == s).select("o_custkey", F.col("up").alias(s)) for s in "ab")
    out, depth = a.join(b, "o_custkey"), lexicon.taxonomy_depth(nodes)
    for m in ("path", "lch", "wup", "lin"):
        out = lexicon.greedy_alignment(out, "a", "b", m, depth)
    return out.drop("a", "b")


@query("l11_content_words", _TR + f""", t AS (SELECT sent_id, pos, lead(token) OVER o AS head, lead(tag) OVER o AS head_tag, token AS dep, tag AS dep_tag FROM r WINDOW o AS (PARTITION BY sent_id ORDER BY pos)),
u AS (SELECT sent_id, pos * 2 AS first, dep AS word, dep_tag AS tag FROM t WHERE head IS NOT NULL UNION ALL SELECT sent_id, pos * 2 + 1, head, head_tag FROM t WHERE head IS NOT NULL)
SELECT sent_id, word, tag, min(first)::INTEGER AS first FROM u WHERE tag LIKE '%V%' OR tag LIKE '%N%' GROUP BY 1, 2, 3""")
def _(spark, sf):
    pairs = conversation_tokens(spark, sf).select("sent_id", F.posexplode(T.bigrams("tokens")).alias("pos", "p"))
    triples = pairs.select("sent_id", "pos", F.col("p.w2").alias("head"), tag_of(F.col("p.w2")).alias("head_tag"),
                           F.col("p.w1").alias("dep"), tag_of(F.col("p.w1")).alias("dep_tag"))
    return lexicon.content_words_from_triples(triples)


def sentence_pairs(spark, sf):
    """Consecutive conversation turns as sentence pairs."""
    c = load(spark, sf, "conversations").select("conv_id", "turn", "text")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("sent2"))
    return c.join(nxt, ["conv_id", "turn"]).select((F.col("conv_id") * 100 + F.col("turn")).alias("pair_id"), F.col("text").alias("sent1"), "sent2")


_CLEAN = f"list_filter({tok_sql('text')}, lambda y: NOT list_contains({STOP_SQL}, y) AND NOT list_contains({_PUNCT_SQL}, y))"
_PRE = _TR + f""", q AS (SELECT conv_id * 100 + turn AS sent_id, {_CLEAN} AS t FROM conversations),
qk AS (SELECT sent_id, i, t[i] AS token FROM (SELECT sent_id, t, unnest(range(1, len(t) + 1)) AS i FROM q)),
ql AS (SELECT sent_id, i, CASE WHEN {_POS_SQL.format(w='token')} IS NULL THEN token ELSE coalesce(lemma, lower(token)) END AS l FROM qk LEFT JOIN lex ON lex.word = lower(token) AND lex.pos = {_POS_SQL.format(w='token')}),
qs AS (SELECT sent_id, list(l ORDER BY i) AS toks FROM ql GROUP BY 1),
pp AS (SELECT x.conv_id * 100 + x.turn AS pair_id, coalesce(a.toks, []) AS a, coalesce(b.toks, []) AS b FROM conversations x JOIN conversations y ON y.conv_id = x.conv_id AND y.turn = x.turn + 1
  LEFT JOIN qs a ON a.sent_id = x.conv_id * 100 + x.turn LEFT JOIN qs b ON b.sent_id = y.conv_id * 100 + y.turn) """


def processed_pairs(spark, sf):
    return lexicon.preprocess_pair(sentence_pairs(spark, sf), lexicon_table(spark, sf), tag_of)


@query("l12_preprocess_pair", _PRE + "SELECT pair_id, array_to_string(a, ' ') AS sent1_processed, array_to_string(b, ' ') AS sent2_processed FROM pp")
def _(spark, sf):
    return processed_pairs(spark, sf).select("pair_id", "sent1_processed", "sent2_processed")


# ---- V: word vectors from digest bytes of the words seen more than once ---------------
_DIM = 8
_VEC = f"""wv AS (SELECT word, [{", ".join(f"('0x' || substr(md5(word), {2 * i + 1}, 2))::INTEGER / 255.0::DOUBLE" for i in range(_DIM))}] AS vec
FROM (SELECT word FROM (SELECT unnest({tok_sql('lower(text)')}) AS word FROM conversations) GROUP BY 1 HAVING count(*) > 1 UNION SELECT '</s>'))"""
_MARKS = f"WITH d AS (SELECT conv_id * 100 + turn AS sent_id, list_concat(['<s>'], {tok_sql('lower(text)')}, ['</s>']) AS t FROM conversations), {_VEC}, k AS (SELECT sent_id, i - 1 AS pos, t[i] AS word FROM (SELECT sent_id, t, unnest(range(1, len(t) + 1)) AS i FROM d)) "


def word_vectors(spark, sf):
    words = conversation_tokens(spark, sf, lower=True).select(F.explode_outer("tokens").alias("word")).where("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("n")).where("n > 1").select("word")
    words = words.unionByName(spark.createDataFrame([("</s>",)], "word string"))
    h = F.md5("word")
    return words.select("word", F.array(*[F.conv(F.substring(h, 2 * i + 1, 2), 16, 10).cast("int") / F.lit(255.0) for i in range(_DIM)]).alias("vec"))


def _cells(df, col):
    return df.select("sent_id", *[rnd(F.get(col, F.lit(i))).alias(f"e{i}") for i in range(_DIM)])


@query("v1_embed_text_max", _MARKS + "SELECT sent_id, " + ", ".join(f"round(max(vec[{i + 1}]), 6) AS e{i}" for i in range(_DIM)) + " FROM k JOIN wv USING (word) GROUP BY 1")
def _(spark, sf):
    return _cells(embed.embed_text(conversation_tokens(spark, sf, True), word_vectors(spark, sf), "sent_id"), "embedding")


@query("v1_embed_text_mean", _MARKS + "SELECT sent_id, " + ", ".join(f"round(avg(vec[{i + 1}]), 6) AS e{i}" for i in range(_DIM)) + " FROM k JOIN wv USING (word) GROUP BY 1")
def _(spark, sf):
    return _cells(embed.embed_text(conversation_tokens(spark, sf, True), word_vectors(spark, sf), "sent_id", pool="mean"), "embedding")


@query("v2_vocab_coverage", _MARKS + "SELECT count(wv.word) AS kept, count(*) AS total, round(count(wv.word) / count(*), 6) AS coverage FROM k LEFT JOIN wv USING (word)")
def _(spark, sf):
    return rounded(embed.vocab_coverage(conversation_tokens(spark, sf, True), word_vectors(spark, sf), "sent_id"), 6, "coverage")


@query("v3_token_importance", _MARKS + f""", b AS (SELECT sent_id, d, arg_min(pos, (-vec[d], pos)) AS pos FROM k JOIN wv USING (word), (SELECT unnest(range(1, {_DIM + 1})) AS d) GROUP BY 1, 2)
SELECT sent_id, b.pos::INTEGER AS pos, word, count(*) / {_DIM}.0::DOUBLE AS share FROM b JOIN k USING (sent_id, pos) GROUP BY ALL""")
def _(spark, sf):
    return embed.token_importance(conversation_tokens(spark, sf, True), word_vectors(spark, sf), "sent_id")


def digest_encoder(texts):
    """Encoder for checks: digest bytes of the whole text."""
    return np.array([[int(hashlib.md5(t.encode()).hexdigest()[2 * i:2 * i + 2], 16) / 255.0 for i in range(_DIM)] for t in texts])


@query("v4_batch_encode", "SELECT doc_id, " + ", ".join(f"round(('0x' || substr(md5(text), {2 * i + 1}, 2))::INTEGER / 255.0, 6) AS e{i}" for i in range(_DIM)) + " FROM documents")
def _(spark, sf):
    out = embed.batch_encode(load(spark, sf, "documents", "doc_id", "text"), "text", digest_encoder, 64)
    return out.select("doc_id", *[rnd(F.get("embedding", F.lit(i))).alias(f"e{i}") for i in range(_DIM)])


_PAIR_EMB = _MARKS + ", m AS (SELECT sent_id, [" + ", ".join(f"avg(vec[{i + 1}])" for i in range(_DIM)) + "] AS e FROM k JOIN wv USING (word) GROUP BY 1) "


def _embedded_pairs(spark, sf):
    # max pooling saturates on long turns, mean pooling keeps them apart
    e = embed.embed_text(conversation_tokens(spark, sf, True), word_vectors(spark, sf), "sent_id", pool="mean").select("sent_id", "embedding")
    nxt = e.select((F.col("sent_id") - 1).alias("sent_id"), F.col("embedding").alias("b"))
    return e.withColumnRenamed("embedding", "a").join(nxt, "sent_id").withColumnRenamed("sent_id", "pair_id")


@query("v5_pair_embedding_score", _PAIR_EMB + "SELECT x.sent_id AS pair_id, round(list_cosine_similarity(x.e, y.e), 6) AS infer, round(1 - acos(greatest(-1, least(1, list_cosine_similarity(x.e, y.e)))), 5) AS uni FROM m x JOIN m y ON y.sent_id = x.sent_id + 1")
def _(spark, sf):
    out = embed.pair_embedding_score(_embedded_pairs(spark, sf), "a", "b", "infer")
    out = embed.pair_embedding_score(out, "a", "b", "uni", "angular")
    return rounded(rounded(out.drop("a", "b"), 6, "infer"), 5, "uni")


def feature_pairs(spark, sf):
    """Overlap, Jaccard, length ratio and embedding score per sentence pair."""
    p = processed_pairs(spark, sf)
    a, b = F.col("sent1_tokens"), F.col("sent2_tokens")
    base = p.where((F.size(a) > 0) & (F.size(b) > 0)).select(
        "pair_id", V.overlap_score(a, b).alias("over"), V.jaccard_score(a, b).alias("jac"),
        (F.least(F.size(a), F.size(b)) / F.greatest(F.size(a), F.size(b))).alias("ratio"))
    emb = embed.pair_embedding_score(_embedded_pairs(spark, sf), "a", "b", "infer").select("pair_id", "infer")
    return embed.pair_features(base, [emb])


_FEAT = """ptb AS (SELECT pair_id, 2.0 * list_sum(list_transform(a, lambda w: len(list_filter(b, lambda y: y = w)))) / (len(a) + len(b)) AS over,
 5.0 * len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) AS jac, least(len(a), len(b)) / greatest(len(a), len(b)) AS ratio FROM pp WHERE len(a) > 0 AND len(b) > 0) """


@query("v6_pair_features", _PRE + ", " + _FEAT + "SELECT pair_id, round(over, 6) + 0.0 AS over, round(jac, 6) + 0.0 AS jac, round(ratio, 6) + 0.0 AS ratio FROM ptb")
def _(spark, sf):
    return rounded(feature_pairs(spark, sf).drop("infer"), 6, "over", "jac", "ratio")


_GOLD = _PRE + ", " + _FEAT + ", gd AS (SELECT pair_id, ratio * 5 AS gold FROM ptb) "


@query("v7_score_against_gold", _GOLD + "SELECT round(corr(jac * 5, gold), 6) AS r, count(*) AS n FROM ptb JOIN gd USING (pair_id)")
def _(spark, sf):
    f = cut_lineage(feature_pairs(spark, sf))
    gold = f.select("pair_id", (F.col("ratio") * 5).alias("gold"))
    return rounded(embed.score_against_gold(f, gold, "pair_id", "jac", "gold").drop("p_value"), 6, "r")


@query("v7_score_against_reversed_gold", _GOLD + """SELECT round(corr(jac * 5, gold), 6) + 0.0 AS r, count(*) AS n FROM (SELECT jac, row_number() OVER (ORDER BY pair_id) AS o FROM ptb)
JOIN (SELECT gold, row_number() OVER (ORDER BY pair_id DESC) AS o FROM gd) USING (o)""")
def _(spark, sf):
    f = cut_lineage(feature_pairs(spark, sf))
    gold = f.select("pair_id", (F.col("ratio") * 5).alias("gold"))
    out = embed.score_against_gold(f, gold, "pair_id", "jac", "gold", reverse_gold=True)
    return rounded(out.drop("p_value"), 6, "r")


# ---- R -------------------------------------------------------------------
_X = ["qty", "price", "disc", "line"]
_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price"]
_RSQL = """WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS qty, l_extendedprice / 1000 AS price, l_discount * 100 AS disc, l_linenumber::DOUBLE AS line, l_returnflag,
 l_quantity * l_extendedprice / 10000 + l_discount * 200 AS y, (l_partkey % 4)::INTEGER AS fold FROM lineitem) """


def regression_rows(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("qty"), (F.col("l_extendedprice") / 1000).alias("price"),
        (F.col("l_discount") * 100).alias("disc"), F.col("l_linenumber").cast("double").alias("line"), "l_returnflag",
        (F.col("l_quantity") * F.col("l_extendedprice") / 10000 + F.col("l_discount") * 200).alias("y"),
        (F.col("l_partkey") % 4).cast("int").alias("fold"))


def _train_test(spark, sf):
    rows = regression_rows(spark, sf)
    return rows.where("l_returnflag <> 'R'"), rows.where("l_returnflag = 'R'")


@query("r1_fit_gbt")
def _(spark, sf):
    train, test = _train_test(spark, sf)
    return regress.fit_gbt(train, test, _X, "y", _KEY, trees=5, depth=4, rate=0.3)[1]


@query("r2_search_params")
def _(spark, sf):
    space = {"trees": [3, 5], "rate": [0.3, 0.5], "depth": [2, 3], "row_share": [0.8, 1.0], "column_share": ["all"]}
    return regress.search_params(regression_rows(spark, sf), _X, "y", _KEY, trials=2, folds=4, space=space)


@query("r3_ridge_cv", _RSQL + """, a AS (SELECT unnest([1.0, 100.0, 10000.0])::DOUBLE AS alpha), f AS (SELECT unnest(range(4))::INTEGER AS fold),
w AS (SELECT alpha, f.fold, covar_pop(qty, y) * count(*) / (var_pop(qty) * count(*) + alpha) AS w, avg(qty) AS mx, avg(y) AS my FROM b, a, f WHERE b.fold <> f.fold GROUP BY 1, 2)
SELECT alpha, w.fold, round(avg(pow(y - my - w * (qty - mx), 2)), 4) AS mse FROM b JOIN w USING (fold) GROUP BY 1, 2""")
def _(spark, sf):
    return rounded(regress.ridge_cv(regression_rows(spark, sf), ["qty"], "y", [1.0, 100.0, 10000.0])[1], 4, "mse")


@query("r3_lasso_cv")
def _(spark, sf):
    return regress.lasso_cv(regression_rows(spark, sf), _X, "y", [0.1, 10.0])[1]


_SOFT = _RSQL + """, a AS (SELECT unnest([0.5, 10.0, 5000.0])::DOUBLE AS alpha), f AS (SELECT unnest(range(4))::INTEGER AS fold),
w AS (SELECT alpha, f.fold, sign(covar_pop(qty, y)) * greatest(abs(covar_pop(qty, y)) - alpha, 0) / var_pop(qty) AS w, avg(qty) AS mx, avg(y) AS my
      FROM b, a, f WHERE b.fold <> f.fold GROUP BY 1, 2)
SELECT alpha, w.fold, round(avg(pow(y - my - w * (qty - mx), 2)), 4) AS mse FROM b JOIN w USING (fold) GROUP BY 1, 2"""


@query("r3_lasso_soft_threshold", _SOFT)
def _(spark, sf):
    return rounded(regress.lasso_cv(regression_rows(spark, sf), ["qty"], "y", [0.5, 10.0, 5000.0])[1], 4, "mse")


# lines through the first items of orders that have two, with different quantities
_LINES = _RSQL + """, s AS (SELECT l_orderkey AS k, regr_slope(y, qty) AS w, regr_intercept(y, qty) AS c FROM b
  WHERE l_linenumber <= 2 AND l_orderkey < 40 GROUP BY 1 HAVING count(*) = 2 AND count(DISTINCT qty) = 2),
t AS (SELECT (row_number() OVER (ORDER BY k) - 1)::INTEGER AS trial, w, c FROM s),
n AS (SELECT trial, count(*) FILTER (abs(y - c - w * qty) <= 30.0) AS inliers FROM t, b GROUP BY 1)
SELECT trial, inliers, row_number() OVER (ORDER BY inliers DESC, trial) = 1 AS best FROM n"""


@query("r4_ransac_given_subsets", _LINES)
def _(spark, sf):
    rows = regression_rows(spark, sf)
    ends = rows.where("l_orderkey < 40 and l_linenumber <= 2").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "qty", "y"))).alias("p")).orderBy("l_orderkey").collect()
    subsets = [np.array([[q["qty"], q["y"]] for q in r["p"]]) for r in ends if len(r["p"]) == 2 and r["p"][0]["qty"] != r["p"][1]["qty"]]
    return regress.count_inliers(rows, ["qty"], "y", subsets, 30.0)[1]


@query("r4_ransac")
def _(spark, sf):
    return regress.ransac(regression_rows(spark, sf), ["qty", "price"], "y", _KEY, trials=20)[1]


@query("r5_stack")
def _(spark, sf):
    train, test = _train_test(spark, sf)
    bases = {"linear": regress.linear_base(_X, "y"), "tree": regress.gbt_base(_X, "y", trees=3, depth=3, rate=0.5)}
    return regress.stack(train, test, bases, "y")[1].select(*_KEY, "y", "linear", "tree", "prediction")


@query("r5_stack_linear", _RSQL + """, t AS (SELECT * FROM b WHERE l_returnflag <> 'R'), s AS (SELECT regr_slope(y, qty) AS w, regr_intercept(y, qty) AS c FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(c + w * qty, 4) + 0.0 AS base FROM b, s WHERE l_returnflag = 'R'""")
def _(spark, sf):
    train, test = _train_test(spark, sf)
    out = regress.stack(train, test, {"base": regress.linear_base(["qty"], "y", 0.0)}, "y")[1]
    return rounded(out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "base"), 4, "base")


@query("r6_blend")
def _(spark, sf):
    train, test = _train_test(spark, sf)
    out = regress.blend(train, test, _X, "y", regress.linear_base(_X, "y"), regress.linear_base(_X[:2], "y"), trees=3, depth=3)
    return out.select(*_KEY, "y", "blend", "prediction")


@query("r7_seed_search")
def _(spark, sf):
    return regress.seed_search(regression_rows(spark, sf), _KEY, "y", lambda s: regress.linear_base(_X, "y"), range(10, 14))


@query("r8_feature_importance")
def _(spark, sf):
    train, _test = _train_test(spark, sf)
    model = regress.gbt(_X, "y", trees=3, depth=3).fit(regress.assemble(train, _X))
    return regress.feature_importance(model, _X, spark, 10)


@query("r9_shadow_select")
def _(spark, sf):
    return regress.shadow_select(regression_rows(spark, sf), _X, "y", _KEY, rounds=5, trees=5, depth=4)


@query("r10_ablation", _RSQL + " UNION ALL ".join(
    f"(SELECT '{n}' AS features, 1 AS n, round(corr({c} * (SELECT sign(regr_slope(y, {c})) FROM b WHERE l_returnflag <> 'R'), y), 6) AS pearson FROM b WHERE l_returnflag = 'R')"
    for n, c in (("quantity", "qty"), ("price", "price"), ("discount", "disc"))))
def _(spark, sf):
    train, test = _train_test(spark, sf)
    out = regress.ablation(train, test, {"quantity": ["qty"], "price": ["price"], "discount": ["disc"]}, "y")
    return rounded(out, 6, "pearson")


@query("r10_ablation_groups")
def _(spark, sf):
    train, test = _train_test(spark, sf)
    return regress.ablation(train, test, {"amounts": ["qty", "price"], "rates": ["disc", "line"], "all": _X}, "y")
