"""Queries of the T, N and G families."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions import tokens as T
from tabulon.functions.scale import cut_lineage, only_row, spread
from tabulon.operators import tagging, textstats
from tabulon.plans.registry import load, query, rnd, rounded

_CONTRACT = T.CONTRACTION.replace("'", "''")
_TOKEN = T.TOKEN.replace("'", "''")


def tok_sql(text: str) -> str:
    return f"regexp_extract_all(regexp_replace({text}, '{_CONTRACT}', ' n''t', 'g'), '{_TOKEN}')"


_STOP_LIST = list(dict.fromkeys([*T.STOPWORDS, *[w.capitalize() for w in T.STOPWORDS], *[w.upper() for w in T.STOPWORDS]]))
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in _STOP_LIST) + "]"
_PUNCT_SQL = "[" + ", ".join("'" + c.replace("'", "''") + "'" for c in T.PUNCTUATION) + "]"


def documents(spark, sf, lower=True):
    text = F.lower("text") if lower else F.col("text")
    docs = spread(load(spark, sf, "documents", "doc_id", "lang", "source", "text"))
    return docs.select("doc_id", "lang", "source", T.word_tokenize(text).alias("tokens"))


_D = f"WITH d AS (SELECT doc_id, lang, source, {tok_sql('lower(text)')} AS tokens FROM documents), w AS (SELECT doc_id, lang, source, unnest(tokens) AS word FROM d) "


# ---- T -------------------------------------------------------------------
@query("t1_word_tokenize", f"SELECT doc_id, len(t)::INTEGER AS n, md5(array_to_string(t, chr(1))) AS h FROM (SELECT doc_id, {tok_sql('text')} AS t FROM documents)")
def _(spark, sf):
    d = documents(spark, sf, lower=False)
    return d.select("doc_id", F.size("tokens").alias("n"), F.md5(F.array_join("tokens", "\x01")).alias("h"))


@query("t2_split_join", r"SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''), ' ') AS text FROM documents")
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", T.join_tokens(T.split_ws("text")).alias("text"))


@query("t3_remove_stopwords", f"""SELECT doc_id, len(t)::INTEGER AS n, md5(array_to_string(t, ' ')) AS h FROM (SELECT doc_id,
list_filter({tok_sql('text')}, lambda w: NOT list_contains({STOP_SQL}, w) AND NOT list_contains({_PUNCT_SQL}, w) AND w <> '¿') AS t FROM documents)""")
def _(spark, sf):
    kept = T.remove_stopwords("tokens", punct=True, custom="¿")
    d = documents(spark, sf, lower=False).select("doc_id", kept.alias("t"))
    return d.select("doc_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("h"))


@query("t4_sentence_split", f"""SELECT doc_id, (pos - 1)::INTEGER AS pos, s[pos] AS sentence FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS pos FROM (
SELECT doc_id, list_filter(list_transform(string_split_regex(text, '{T.SENTENCE_END}'), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents))""")
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", F.posexplode(T.sentence_split("text")).alias("pos", "sentence"))


# ---- N -------------------------------------------------------------------
@query("n1_text_stats", _D + "SELECT lang, source, count(*) AS tokens, count(DISTINCT word) AS types, round(count(*) / count(DISTINCT word), 6) AS diversity FROM w GROUP BY 1, 2")
def _(spark, sf):
    return rounded(textstats.text_stats(documents(spark, sf), by=["lang", "source"]), 6, "diversity")


@query("n2_word_count", _D + "SELECT count(*) AS n FROM w WHERE word = 'the'")
def _(spark, sf):
    return textstats.word_count(documents(spark, sf), "the")


@query("n3_most_common", _D + "SELECT word, count(*) AS n FROM w GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
def _(spark, sf):
    return textstats.most_common(textstats.freq_dist(documents(spark, sf)), 50)


@query("n3_freq_dist", _D + "SELECT word, count(*) AS n FROM w GROUP BY 1")
def _(spark, sf):
    return textstats.freq_dist(documents(spark, sf))


@query("n4_cumulative_freq", _D + "SELECT word, n, (sum(n) OVER (ORDER BY n DESC, word))::BIGINT AS cumulative FROM (SELECT word, count(*) AS n FROM w GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30)")
def _(spark, sf):
    return textstats.cumulative_freq(textstats.freq_dist(documents(spark, sf)), 30)


@query("n5_hapaxes", _D + "SELECT word FROM w GROUP BY 1 HAVING count(*) = 1")
def _(spark, sf):
    return textstats.hapaxes(textstats.freq_dist(documents(spark, sf)))


@query("n6_long_words", _D + "SELECT DISTINCT word FROM w WHERE length(word) > 15")
def _(spark, sf):
    return textstats.long_words(textstats.freq_dist(documents(spark, sf)), 15)


@query("n6_words_ending", _D + "SELECT DISTINCT word FROM w WHERE ends_with(word, 'tion')")
def _(spark, sf):
    return textstats.words_ending(textstats.freq_dist(documents(spark, sf)), "tion")


@query("n7_length_dist", _D + "SELECT length(word)::INTEGER AS length, count(*) AS n, round(count(*) / (SELECT count(*) FROM w), 8) AS share FROM w GROUP BY 1")
def _(spark, sf):
    return rounded(textstats.length_dist(textstats.freq_dist(documents(spark, sf))), 8, "share")


@query("n8_concordance", _D + """SELECT doc_id, (pos - 1)::BIGINT AS pos, array_to_string(tokens[greatest(pos - 4, 1):pos - 1], ' ') AS "left", tokens[pos] AS word,
array_to_string(tokens[pos + 1:pos + 4], ' ') AS "right" FROM (SELECT doc_id, tokens, unnest(range(1, len(tokens) + 1)) AS pos FROM d) WHERE tokens[pos] = 'with'""")
def _(spark, sf):
    out = textstats.concordance(documents(spark, sf), "with", 4)
    return out.withColumn("pos", F.col("pos").cast("bigint"))


_BI = _D + ", b AS (SELECT tokens[i] AS w1, tokens[i + 1] AS w2 FROM (SELECT tokens, unnest(range(1, len(tokens))) AS i FROM d)), p AS (SELECT w1, w2, count(*) AS n FROM b GROUP BY 1, 2) "


@query("n9_bigrams", _BI + "SELECT w1, w2, n FROM p")
def _(spark, sf):
    return textstats.bigram_counts(documents(spark, sf))


EVENT_WORD = "floor(value / 10)::BIGINT::VARCHAR"


def tagged_events(spark, sf):
    """Tag sequences: one per user, ordered by time; word = value bucket."""
    return load(spark, sf, "events").select(
        "user_id", "ts", "event_id", F.col("event_type").alias("tag"),
        F.floor(F.col("value") / 10).cast("bigint").cast("string").alias("word"))


_EV = f"""WITH e AS (SELECT user_id, event_id, ts, event_type AS tag, {EVENT_WORD} AS word, lag(event_type) OVER o AS prev, lag(event_type, 2) OVER o AS prev2,
  lag({EVENT_WORD}) OVER o AS prev_word, row_number() OVER o - 1 AS pos, dense_rank() OVER (ORDER BY user_id) - 1 AS seq_no FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)) """


def _placed(spark, sf):
    return tagging.positions(tagged_events(spark, sf), "user_id", ["ts", "event_id"])


@query("n9_tag_bigrams", _EV + "SELECT prev AS t1, tag AS t2, count(*) AS n FROM e WHERE prev IS NOT NULL GROUP BY 1, 2")
def _(spark, sf):
    return tagging.next_tag_counts(_placed(spark, sf), "user_id")


@query("n9_tags_before", _EV + "SELECT prev AS tag, count(*) AS n FROM e WHERE prev IS NOT NULL AND tag = 'purchase' GROUP BY 1")
def _(spark, sf):
    return tagging.tags_before_tag(_placed(spark, sf), "user_id", "purchase")


@query("n9_tags_after_word", _EV + "SELECT tag, count(*) AS n FROM e WHERE prev_word = '3' GROUP BY 1")
def _(spark, sf):
    return tagging.tags_after_word(_placed(spark, sf), "user_id", "3")


def _g2_part(o, e):
    return f"(CASE WHEN {o} > 0 THEN {o} * ln({o} / ({e})) ELSE 0 END)"


@query("n10_collocations", _BI + f""", l AS (SELECT w1, sum(n)::DOUBLE AS a FROM p GROUP BY 1), r AS (SELECT w2, sum(n)::DOUBLE AS b FROM p GROUP BY 1), t AS (SELECT sum(n)::DOUBLE AS t FROM p)
SELECT w1, w2, n, round(2 * ({_g2_part('n::DOUBLE', 'a * b / t')} + {_g2_part('(a - n)', 'a * (t - b) / t')} + {_g2_part('(b - n)', '(t - a) * b / t')} + {_g2_part('(t - a - b + n)', '(t - a) * (t - b) / t')}), 5) AS score
FROM p JOIN l USING (w1) JOIN r USING (w2), t WHERE n >= 2 AND length(w1) >= 3 AND length(w2) >= 3
 AND NOT list_contains({STOP_SQL}, w1) AND NOT list_contains({STOP_SQL}, w2) ORDER BY round(score, 6) DESC, w1, w2 LIMIT 20""")
def _(spark, sf):
    return rounded(textstats.collocations(documents(spark, sf), 20), 5, "score")


@query("n11_similar_words", _D + """, c AS (SELECT DISTINCT tokens[i - 1] AS l, tokens[i] AS word, tokens[i + 1] AS r FROM (SELECT tokens, unnest(range(2, len(tokens))) AS i FROM d))
SELECT word, count(*) AS shared FROM c JOIN (SELECT l, r FROM c WHERE word = 'the') m USING (l, r) WHERE word <> 'the' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def _(spark, sf):
    return textstats.similar_words(documents(spark, sf), "the", 20)


@query("n12_cond_freq_dist", _D + "SELECT lang, word, count(*) AS n FROM w GROUP BY 1, 2")
def _(spark, sf):
    return textstats.cond_freq_dist(documents(spark, sf), "lang")


@query("n12_conditions", _D + "SELECT lang, count(*) AS n, count(DISTINCT word) AS types FROM w GROUP BY 1")
def _(spark, sf):
    return textstats.conditions(textstats.cond_freq_dist(documents(spark, sf), "lang"), "lang")


@query("n12_top_per_condition", _D + "SELECT lang, word, n, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM (SELECT lang, word, count(*) AS n FROM w GROUP BY 1, 2)) WHERE rank <= 5")
def _(spark, sf):
    return textstats.top_per_condition(textstats.cond_freq_dist(documents(spark, sf), "lang"), "lang", 5)


# ---- G -------------------------------------------------------------------
_SPLIT = _EV + ", k AS (SELECT floor(0.9 * count(DISTINCT user_id)) AS cut FROM events), tr AS (SELECT e.* FROM e, k WHERE seq_no < cut), te AS (SELECT e.* FROM e, k WHERE seq_no >= cut) "
_UNI = """, u AS (SELECT word, arg_min(tag, (-n, tag)) AS tag FROM (SELECT word, tag, count(*) AS n FROM tr GROUP BY 1, 2) GROUP BY 1),
b AS (SELECT prev, word, x.tag FROM (SELECT prev, word, arg_min(tag, (-n, tag)) AS tag FROM (SELECT coalesce(prev, '<s>') AS prev, word, tag, count(*) AS n FROM tr GROUP BY 1, 2, 3) GROUP BY 1, 2) x
  JOIN u USING (word) WHERE u.tag <> x.tag) """


def _split(spark, sf):
    """Placed rows with previous tags; first 90 % of the users train."""
    placed = _placed(spark, sf)
    placed = tagging.with_previous(tagging.with_previous(placed, "user_id", ["tag"]), "user_id", ["tag"], back=2)
    numbers = tagging.training_ordinal(tagged_events(spark, sf), "user_id")
    cut = int(only_row(numbers.agg(F.count("*").alias("n")))["n"] * 0.9)
    placed = cut_lineage(placed.join(numbers, "user_id"))
    return placed.where(F.col("seq_no") < cut), placed.where(F.col("seq_no") >= cut)


@query("g1_default_tagger", _EV + "SELECT 'view' AS predicted, round(avg((tag = 'view')::INTEGER), 6) AS accuracy FROM e")
def _(spark, sf):
    out = tagging.default_tagger(tagged_events(spark, sf), "view")
    return rounded(tagging.evaluate_tagger(out, by=["predicted"]).drop("tokens"), 6, "accuracy")


@query("g2_unigram_tagger", _SPLIT + _UNI + "SELECT event_id, te.tag, coalesce(u.tag, 'view') AS predicted FROM te LEFT JOIN u USING (word)")
def _(spark, sf):
    train, test = _split(spark, sf)
    return tagging.unigram_tag(test, tagging.unigram_fit(train), "view").select("event_id", "tag", "predicted")


@query("g3_backoff_tagger_forced", _SPLIT + _UNI + """SELECT event_id, te.tag, coalesce(b.tag, u.tag, 'view') AS predicted FROM te
LEFT JOIN u USING (word) LEFT JOIN b ON b.word = te.word AND b.prev = coalesce(te.prev, '<s>')""")
def _(spark, sf):
    train, test = _split(spark, sf)
    uni = tagging.unigram_fit(train)
    out = tagging.backoff_tag_forced(test, tagging.bigram_fit(train, uni), uni, "view")
    return out.select("event_id", "tag", "predicted")


@query("g3_backoff_tagger", _SPLIT.replace("WITH e", "WITH RECURSIVE e", 1) + _UNI + """, z AS (SELECT user_id, pos, te.word, te.tag, event_id, u.tag AS u FROM te LEFT JOIN u USING (word)),
v AS (SELECT z.user_id, z.pos, z.event_id, z.tag, coalesce(b.tag, z.u, 'view') AS predicted FROM z LEFT JOIN b ON b.word = z.word AND b.prev = '<s>' WHERE z.pos = 0
UNION ALL SELECT z.user_id, z.pos, z.event_id, z.tag, coalesce(b.tag, z.u, 'view') FROM v JOIN z ON z.user_id = v.user_id AND z.pos = v.pos + 1 LEFT JOIN b ON b.word = z.word AND b.prev = v.predicted)
SELECT event_id, tag, predicted FROM v""")
def _(spark, sf):
    train, test = _split(spark, sf)
    uni = tagging.unigram_fit(train)
    bi = tagging.bigram_fit(train, uni)
    out = tagging.backoff_tag(test, "user_id", bi, uni, "view", tagging.tag_set(train))
    return out.select("event_id", "tag", "predicted")


@query("g4_hmm_counts", _SPLIT + """SELECT 'start' AS kind, '' AS a, tag AS b, count(*) AS n FROM tr WHERE prev IS NULL GROUP BY 3
UNION ALL SELECT 'transition', prev, tag, count(*) FROM tr WHERE prev IS NOT NULL GROUP BY 2, 3 UNION ALL SELECT 'emission', tag, word, count(*) FROM tr GROUP BY 2, 3""")
def _(spark, sf):
    c = tagging.hmm_counts(_split(spark, sf)[0])
    return (c["start"].select(F.lit("start").alias("kind"), F.lit("").alias("a"), F.col("tag").alias("b"), "n")
            .unionByName(c["transition"].select(F.lit("transition").alias("kind"), F.col("prev").alias("a"), F.col("tag").alias("b"), "n"))
            .unionByName(c["emission"].select(F.lit("emission").alias("kind"), F.col("tag").alias("a"), F.col("word").alias("b"), "n")))


# Viterbi as recursion: best scores per position, then the path backwards
_HMM = """, tg AS (SELECT DISTINCT tag FROM tr), kk AS (SELECT count(*) AS k FROM tg), vv AS (SELECT count(DISTINCT word) AS v FROM tr),
em AS (SELECT w.word, t.tag, ln(coalesce(c.n, 0) + 1) - ln(m.n + vv.v + 1) AS s FROM (SELECT DISTINCT word FROM te) w CROSS JOIN tg t
  LEFT JOIN (SELECT tag, word, count(*) AS n FROM tr GROUP BY 1, 2) c ON c.word = w.word AND c.tag = t.tag JOIN (SELECT tag, count(*) AS n FROM tr GROUP BY 1) m ON m.tag = t.tag, vv),
st AS (SELECT t.tag, ln((coalesce(c.n, 0) + 1) / (x.n + kk.k)) AS s FROM tg t LEFT JOIN (SELECT tag, count(*) AS n FROM tr WHERE prev IS NULL GROUP BY 1) c USING (tag), kk, (SELECT count(*) AS n FROM tr WHERE prev IS NULL) x),
ts AS (SELECT a.tag AS prev, b.tag AS tag, ln((coalesce(c.n, 0) + 1) / (m.n + kk.k)) AS s FROM tg a CROSS JOIN tg b LEFT JOIN (SELECT prev, tag, count(*) AS n FROM tr WHERE prev IS NOT NULL GROUP BY 1, 2) c ON c.prev = a.tag AND c.tag = b.tag
  JOIN (SELECT prev, count(*) AS n FROM tr WHERE prev IS NOT NULL GROUP BY 1) m ON m.prev = a.tag, kk),
v AS (SELECT te.user_id, te.pos, em.tag, st.s + em.s AS score FROM te JOIN em USING (word) JOIN st ON st.tag = em.tag WHERE te.pos = 0
  UNION ALL SELECT te.user_id, te.pos, em.tag, max(v.score + ts.s) + any_value(em.s) FROM v JOIN te ON te.user_id = v.user_id AND te.pos = v.pos + 1 JOIN em ON em.word = te.word JOIN ts ON ts.prev = v.tag AND ts.tag = em.tag GROUP BY te.user_id, te.pos, em.tag),
vm AS MATERIALIZED (SELECT * FROM v), ends AS (SELECT user_id, max(pos) AS pos FROM te GROUP BY 1),
p AS (SELECT user_id, pos, arg_max(tag, score) AS tag FROM vm JOIN ends USING (user_id, pos) GROUP BY 1, 2
  UNION ALL SELECT vm.user_id, vm.pos, arg_max(vm.tag, vm.score + ts.s) FROM p JOIN vm ON vm.user_id = p.user_id AND vm.pos = p.pos - 1 JOIN ts ON ts.prev = vm.tag AND ts.tag = p.tag GROUP BY 1, 2)
SELECT te.event_id, te.tag, p.tag AS predicted FROM te JOIN p USING (user_id, pos)"""


@query("g4_hmm_tagger", _SPLIT.replace("WITH e", "WITH RECURSIVE e", 1) + _HMM)
def _(spark, sf):
    train, test = _split(spark, sf)
    return tagging.hmm_tag(test, "user_id", tagging.hmm_counts(train)).select("event_id", "tag", "predicted")


_TRI = _SPLIT + """, t AS (SELECT coalesce(prev2, '<s>') AS t1, coalesce(prev, '<s>') AS t2, tag AS t3 FROM tr),
tri AS (SELECT t1, t2, t3, count(*) AS n FROM t GROUP BY 1, 2, 3), bi AS (SELECT t2, t3, count(*) AS n FROM t GROUP BY 1, 2), uni AS (SELECT t3, count(*) AS n FROM t GROUP BY 1) """


@query("g5_trigram_counts", _TRI + "SELECT t1, t2, t3, n FROM tri UNION ALL SELECT NULL, t2, t3, n FROM bi UNION ALL SELECT NULL, NULL, t3, n FROM uni")
def _(spark, sf):
    c = tagging.trigram_counts(_split(spark, sf)[0])
    none = F.lit(None).cast("string")
    return (c["tri"].unionByName(c["bi"].withColumn("t1", none)).unionByName(c["uni"].withColumns({"t1": none, "t2": none})))


@query("g5_interpolation_weights", _TRI + """, j AS (SELECT tri.n, coalesce((tri.n - 1) / nullif(a.c - 1, 0), 0) AS p3, coalesce((bi.n - 1) / nullif(b.c - 1, 0), 0) AS p2, (uni.n - 1) / (g.c - 1) AS p1
FROM tri JOIN (SELECT t1, t2, sum(n) AS c FROM tri GROUP BY 1, 2) a USING (t1, t2) JOIN bi USING (t2, t3) JOIN (SELECT t2, sum(n) AS c FROM bi GROUP BY 1) b USING (t2) JOIN uni USING (t3), (SELECT sum(n) AS c FROM uni) g),
o AS (SELECT n, CASE WHEN p1 >= p2 AND p1 >= p3 THEN 1 WHEN p2 >= p3 THEN 2 ELSE 3 END AS o FROM j)
SELECT round(coalesce(sum(n) FILTER (o = 1), 0) / sum(n), 6) AS lambda1, round(coalesce(sum(n) FILTER (o = 2), 0) / sum(n), 6) AS lambda2, round(coalesce(sum(n) FILTER (o = 3), 0) / sum(n), 6) AS lambda3 FROM o""")
def _(spark, sf):
    out = tagging.interpolation_weights(tagging.trigram_counts(_split(spark, sf)[0]))
    return rounded(out, 6, "lambda1", "lambda2", "lambda3")


@query("g5_trigram_tagger")
def _(spark, sf):
    train, test = _split(spark, sf)
    return tagging.trigram_tag(test, "user_id", tagging.trigram_counts(train)).select("event_id", "tag", "predicted")


@query("g6_evaluate_tagger", _SPLIT + _UNI + """SELECT 'unigram' AS model, round(avg((te.tag = coalesce(u.tag, 'view'))::INTEGER), 6) AS accuracy, count(*) AS tokens FROM te LEFT JOIN u USING (word)
UNION ALL SELECT 'default', round(avg((tag = 'view')::INTEGER), 6), count(*) FROM te""")
def _(spark, sf):
    train, test = _split(spark, sf)
    a = tagging.unigram_tag(test, tagging.unigram_fit(train), "view").withColumn("model", F.lit("unigram"))
    b = tagging.default_tagger(test, "view").withColumn("model", F.lit("default"))
    return rounded(tagging.evaluate_tagger(a.unionByName(b), by=["model"]), 6, "accuracy")


@query("g7_learning_curve", _SPLIT + """, s AS (SELECT unnest([20, 50, 100, 1000]) AS size), c AS (SELECT size, word, arg_min(tag, (-n, tag)) AS tag FROM (SELECT size, word, tag, count(*) AS n FROM tr, s WHERE seq_no < size GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT s.size::INTEGER AS size, round(avg((te.tag = coalesce(c.tag, 'view'))::INTEGER), 6) AS accuracy FROM te CROSS JOIN s LEFT JOIN c ON c.size = s.size AND c.word = te.word GROUP BY 1""")
def _(spark, sf):
    train, test = _split(spark, sf)
    return rounded(tagging.learning_curve(train, test, [20, 50, 100, 1000], "seq_no", "view"), 6, "accuracy")


@query("g8_tag_confusion", _SPLIT + _UNI + "SELECT te.tag, coalesce(u.tag, 'view') AS predicted, count(*) AS n FROM te LEFT JOIN u USING (word) GROUP BY 1, 2")
def _(spark, sf):
    train, test = _split(spark, sf)
    return tagging.tag_confusion(tagging.unigram_tag(test, tagging.unigram_fit(train), "view"))


@query("g9_language_id", _D + """, m AS (SELECT lang, word, count(*) AS n FROM w GROUP BY 1, 2), s AS (SELECT lang, sum(n) + (SELECT count(DISTINCT word) FROM m) AS mass FROM m GROUP BY 1),
c AS (SELECT doc_id, word, count(*) AS c FROM w GROUP BY 1, 2), g AS (SELECT doc_id, m.lang, sum(c * ln(n + 1)) AS gain FROM c JOIN m USING (word) GROUP BY 1, 2),
r AS (SELECT d.doc_id, s.lang, round(coalesce(gain, 0) - len(tokens) * ln(mass), 6) AS score FROM d CROSS JOIN s LEFT JOIN g ON g.doc_id = d.doc_id AND g.lang = s.lang)
SELECT doc_id, arg_min(lang, (-score, lang)) AS predicted, round(max(score), 2) AS score FROM r GROUP BY 1""")
def _(spark, sf):
    d = documents(spark, sf)
    return rounded(textstats.language_id(d, textstats.language_model(d, "lang"), "lang", "doc_id"), 2, "score")
