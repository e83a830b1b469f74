"""Lexicon, senses and taxonomy similarity (the L family).

Lexical resources are tables: ``lexicon(word, pos, lemma)``, ``senses(sense_id,
word, pos, rank, gloss)``, ``hypernyms(child, parent)``, ``counts(node, n)``.
Token rows are (sent_id, pos, token, tag).
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions import tokens as T
from tabulon.functions.scale import cut_lineage, only_row


def lemmatize(tokens: DataFrame, lexicon: DataFrame, letters: str = "NVJR") -> DataFrame:
    """Lemma of lower(token) and part of speech for tags starting with one of
    ``letters``; other tokens stay as they are."""
    keyed = tokens.withColumns({"_w": F.lower("token"), "_p": F.when(
        F.substring("tag", 1, 1).isin(*letters), T.map_pos("tag"))})
    lex = lexicon.select(F.col("word").alias("_w"), F.col("pos").alias("_p"), "lemma")
    out = keyed.join(lex, ["_w", "_p"], "left")
    # an unknown word of a covered tag comes out lower-cased, as from a lemmatizer
    return out.withColumn("lemma", F.when(F.col("_p").isNull(), F.col("token")).otherwise(
        F.coalesce("lemma", "_w"))).drop("_w", "_p")


def _first_senses(senses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First sense by (word, pos) and by word alone."""
    order = F.struct(F.array_position(F.array(*map(F.lit, "nvar")), F.col("pos")).alias("p"), "rank", "sense_id")
    by_pos = senses.groupBy("word", "pos").agg(F.min(F.struct("rank", "sense_id")).alias("m")).select(
        F.col("word").alias("_w"), F.col("pos").alias("_p"), F.col("m.sense_id").alias("_s1"))
    by_word = senses.groupBy("word").agg(F.min(order).alias("m")).select("word", F.col("m.sense_id").alias("sense"))
    return by_pos, by_word


def pick_sense(tokens: DataFrame, senses: DataFrame, default: str) -> DataFrame:
    """Covered tags look up (word, pos), others the word; then the word without
    punctuation; then ``default``."""
    by_pos, by_word = _first_senses(senses)
    keyed = tokens.withColumns({"_w": F.lower("token"), "_p": T.map_pos("tag")})
    keyed = keyed.withColumn("_clean", T.strip_punctuation("_w"))
    out = (keyed.join(by_pos, ["_w", "_p"], "left")
           .join(by_word.toDF("_w", "_s2"), "_w", "left").join(by_word.toDF("_clean", "_s3"), "_clean", "left"))
    direct = F.when(F.col("_p").isNotNull(), F.col("_s1")).otherwise(F.col("_s2"))
    return out.withColumn("sense", F.coalesce(direct, "_s3", F.lit(default))).drop(
        "_w", "_p", "_clean", "_s1", "_s2", "_s3")


def lesk(tokens: DataFrame, senses: DataFrame, if_null: str = "no_pos") -> DataFrame:
    """Sense whose gloss shares most words with the sentence (the largest id on
    a tie): with the part of speech, then (``no_pos``) without, else the token."""
    # the overlap depends on the sentence and the sense only, the choice on the
    # word and its part of speech: both are made distinct before any join
    context = tokens.groupBy("sent_id").agg(F.collect_set("token").alias("_ctx"))  # vocabulary of one text
    rows = tokens.withColumns({"_w": F.lower("token"), "_p": T.map_pos("tag")})
    wanted = rows.where("_p IS NOT NULL").select("sent_id", "_w", "_p").distinct()
    glosses = senses.select("sense_id", F.array_distinct(T.split_ws("gloss")).alias("_g")).dropDuplicates(["sense_id"])
    cand = wanted.join(senses.select(F.col("word").alias("_w"), F.col("pos").alias("_sp"), "sense_id"), "_w")
    if if_null != "no_pos":
        cand = cand.where(F.col("_sp") == F.col("_p"))
    hits = (cand.select("sent_id", "sense_id").distinct().join(context, "sent_id").join(glosses, "sense_id")
            .select("sent_id", "sense_id", F.size(F.array_intersect("_g", "_ctx")).alias("hits")))
    rank = F.struct((F.col("_sp") == F.col("_p")).alias("same"), "hits", "sense_id")
    best = cand.join(hits, ["sent_id", "sense_id"]).groupBy("sent_id", "_w", "_p").agg(F.max(rank).alias("b")).select(
        "sent_id", "_w", "_p", F.col("b.sense_id").alias("_sense"))
    return rows.join(best, ["sent_id", "_w", "_p"], "left").withColumn(
        "sense", F.coalesce("_sense", "token")).drop("_sense", "_w", "_p")


# ---- taxonomy ------------------------------------------------------------------
def ancestors(hypernyms: DataFrame) -> DataFrame:
    """(node, ancestor, distance) closure with every node as its own ancestor;
    the shortest distance where there are several ways.

    Ways double in every round: a way longer than the reach so far starts with
    one of just that length, so a taxonomy of any depth takes as many rounds as
    its depth has binary digits.  A cycle is refused."""
    edges = hypernyms.select(F.col("child").alias("node"), F.col("parent").alias("ancestor")).distinct()
    nodes = edges.select("node").unionByName(edges.select(F.col("ancestor").alias("node"))).distinct()
    ways = cut_lineage(edges.select("node", "ancestor", F.lit(1).alias("distance")))
    reach = 1
    while True:
        start = ways.where(F.col("distance") == reach).select("node", F.col("ancestor").alias("_mid"))
        more = start.join(ways.select(F.col("node").alias("_mid"), "ancestor", F.col("distance").alias("_d")), "_mid")
        grown = cut_lineage(ways.unionByName(more.select("node", "ancestor", (F.col("_d") + reach).alias("distance"))).groupBy(
            "node", "ancestor").agg(F.min("distance").alias("distance")))
        reach *= 2
        ways = grown
        if ways.where(F.col("distance") == reach).isEmpty():
            break
    if not ways.where(F.col("node") == F.col("ancestor")).isEmpty():
        raise ValueError("the taxonomy has a cycle")
    return ways.unionByName(nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("distance")))


def information_content(closure: DataFrame, counts: DataFrame) -> DataFrame:
    """ic(node) = -ln(share of the counts at or below the node)."""
    below = closure.join(counts, "node").groupBy(F.col("ancestor").alias("node")).agg(F.sum("n").alias("n"))
    total = only_row(counts.agg(F.sum("n").alias("t")))["t"]
    return below.select("node", "n", (-F.log(F.col("n") / F.lit(float(total)))).alias("ic"))


def node_table(closure: DataFrame, ic: DataFrame | None = None) -> DataFrame:
    """One row per node: depth (root 1) and its ancestors with distance, depth
    and information content - as many as the taxonomy is deep."""
    depth = closure.groupBy("node").agg((F.max("distance") + 1).alias("depth"))
    about = depth if ic is None else depth.join(ic.select("node", "ic"), "node", "left")
    if ic is None:
        about = about.withColumn("ic", F.lit(None).cast("double"))
    rows = closure.join(about.toDF("ancestor", "_d", "_ic"), "ancestor")
    up = rows.groupBy("node").agg(F.array_sort(F.collect_list(F.struct(
        "distance", F.col("ancestor").alias("node"), F.col("_d").alias("depth"), F.col("_ic").alias("ic")))).alias("up"))
    return up.join(about, "node")


def taxonomy_depth(nodes: DataFrame) -> int:
    return only_row(nodes.agg(F.max("depth").alias("d")))["d"]


def pair_similarities(pairs: DataFrame, nodes: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """path, lch (relative to its self value), wup and lin of every given pair;
    null without a common ancestor."""
    depth = taxonomy_depth(nodes)
    left = nodes.select(F.col("node").alias(a), F.col("up").alias("_ua"), F.col("depth").alias("_da"), F.col("ic").alias("_ia"))
    right = nodes.select(F.col("node").alias(b), F.col("up").alias("_ub"), F.col("depth").alias("_db"), F.col("ic").alias("_ib"))
    out = pairs.join(left, a, "left").join(right, b, "left")
    by_node = F.map_from_entries(F.transform("_ub", lambda u: F.struct(u["node"], u["distance"])))
    out = out.withColumn("_m", by_node)
    common = F.filter("_ua", lambda u: F.map_contains_key(F.col("_m"), u["node"]))
    out = out.withColumn("_c", common)
    steps = F.array_min(F.transform("_c", lambda u: u["distance"] + F.try_element_at(F.col("_m"), u["node"])))
    out = out.withColumns({"_steps": steps, "_lcs": F.array_max(F.transform("_c", lambda u: u["depth"])),
                           "_lic": F.array_max(F.transform("_c", lambda u: u["ic"]))})
    return out.withColumns({
        "path": path_sim(F.col("_steps")), "lch": lch_sim(F.col("_steps"), depth),
        "wup": wup_sim(F.col("_lcs"), F.col("_da"), F.col("_db")),
        "lin": lin_sim(F.col("_lic"), F.col("_ia"), F.col("_ib"))}).drop(
        "_ua", "_ub", "_da", "_db", "_ia", "_ib", "_m", "_c", "_steps", "_lcs", "_lic")


def path_sim(steps: Column) -> Column:
    return F.lit(1.0) / (1 + steps)


def lch_sim(steps: Column, depth: int) -> Column:
    return -F.log((steps + 1) / (2.0 * depth)) / F.lit(-math.log(1 / (2.0 * depth)))


def wup_sim(lcs_depth: Column, depth_a: Column, depth_b: Column) -> Column:
    return 2.0 * lcs_depth / (depth_a + depth_b)


def lin_sim(lcs_ic: Column, ic_a: Column, ic_b: Column) -> Column:
    return 2.0 * lcs_ic / F.nullif(ic_a + ic_b, F.lit(0.0))


def _pair_score(a: list, b: list, measure: str, depth: int) -> float:
    """Similarity of two senses given as their ancestor lists."""
    other = {u["node"]: u["distance"] for u in b}
    shared = [u for u in a if u["node"] in other]
    if not shared:
        return 0.0
    if measure in ("path", "lch"):
        steps = min(u["distance"] + other[u["node"]] for u in shared)
        return 1 / (1 + steps) if measure == "path" else math.log((steps + 1) / (2 * depth)) / math.log(1 / (2 * depth))
    own = [next(u for u in side if u["distance"] == 0) for side in (a, b)]
    if measure == "wup":
        return 2 * max(u["depth"] for u in shared) / (own[0]["depth"] + own[1]["depth"])
    mass = (own[0]["ic"] or 0.0) + (own[1]["ic"] or 0.0)
    return 2 * max(u["ic"] or 0.0 for u in shared) / mass if mass else 0.0


def align_score(first: list, second: list, measure: str, depth: int) -> float | None:
    """Each item of the shorter list takes its best unused partner (the last on
    a tie); partners left over count 0; mean."""
    short, rest = (list(first), list(second)) if len(first) <= len(second) else (list(second), list(first))
    if not rest:
        return None
    total, n = 0.0, len(rest)
    for s in short:
        scores = [_pair_score(s, t, measure, depth) for t in rest]
        best = max(scores)
        total += best
        rest.pop(len(scores) - 1 - scores[::-1].index(best))
    return total / n


def greedy_alignment(df: DataFrame, a: str, b: str, measure: str, depth: int, name: str | None = None) -> DataFrame:
    """``a`` and ``b`` are arrays of ancestor lists (``node_table.up``)."""
    @F.pandas_udf("double")
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else align_score(p, q, measure, depth) for p, q in zip(x, y)],
                         dtype="float64")
    return df.withColumn(name or measure, score(a, b))


def content_words_from_triples(triples: DataFrame) -> DataFrame:
    """(sent_id, first, word, tag): dependents and heads of (sent_id, pos, head,
    head_tag, dep, dep_tag) rows, first seen first, tags holding V or N."""
    seen = triples.select("sent_id", F.inline(F.array(
        F.struct((F.col("pos") * 2).alias("first"), F.col("dep").alias("word"), F.col("dep_tag").alias("tag")),
        F.struct((F.col("pos") * 2 + 1).alias("first"), F.col("head").alias("word"), F.col("head_tag").alias("tag")))))
    kept = seen.where(F.col("tag").contains("V") | F.col("tag").contains("N"))
    return kept.groupBy("sent_id", "word", "tag").agg(F.min("first").alias("first"))


def preprocess_pair(pairs: DataFrame, lexicon: DataFrame, tag_of, cols=("sent1", "sent2"), key: str = "pair_id",
                    letters: str = "NVJR") -> DataFrame:
    """Tokens, stop words out, tags, lemmas and the joined text of both sides;
    ``tag_of(column)`` gives the tag of a token."""
    out = pairs
    for c in cols:
        kept = T.remove_stopwords(T.word_tokenize(c), punct=True)
        rows = pairs.select(F.col(key).alias("sent_id"), F.posexplode(kept).alias("pos", "token"))
        lemmas = lemmatize(rows.withColumn("tag", tag_of(F.col("token"))), lexicon, letters)
        joined = lemmas.groupBy(F.col("sent_id").alias(key)).agg(F.transform(F.array_sort(F.collect_list(
            F.struct("pos", "lemma"))), lambda s: s["lemma"]).alias(f"{c}_tokens"))  # one text per group
        out = out.join(joined, key, "left").withColumn(
            f"{c}_tokens", F.coalesce(f"{c}_tokens", F.array().cast("array<string>")))
        out = out.withColumn(f"{c}_processed", T.join_tokens(f"{c}_tokens"))
    return out
