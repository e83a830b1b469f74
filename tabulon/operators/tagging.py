"""Sequence tagging (the G family) over (seq, pos..., word, tag) rows.

Training is counting. Decoding keeps sequences of any length distributed: a
sequence is cut into chunks of bounded size, every chunk of a long one is reduced
to its scores from entry to end states, these are combined, and the chunks are
then decoded between their known end states, many of them in step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.scale import bounded_rows, cut_lineage, with_ordinal

CHUNK = 4096
NEG = -1e300
MAX_TAGS = 200
#: Scores that a task holds at once while it steps.
CELLS = 1 << 20


def positions(df: DataFrame, seq: str, order: Sequence[str]) -> DataFrame:
    """Adds ``ord`` (total order), ``pos`` (0-based inside the sequence) and
    ``chunk``; no window over a sequence."""
    placed = with_ordinal(df, [seq, *order], "ord")
    first = placed.groupBy(seq).agg(F.min("ord").alias("_first"))
    return placed.join(first, seq).withColumn("pos", F.col("ord") - F.col("_first")).drop("_first").withColumn(
        "chunk", F.floor(F.col("pos") / CHUNK))


def with_previous(placed: DataFrame, seq: str, cols: Sequence[str], back: int = 1) -> DataFrame:
    """Columns of the row ``back`` places before, null at the start: a join on
    the unique ordinal instead of a window over a (possibly huge) sequence."""
    prev = placed.select((F.col("ord") + back).alias("ord"), F.col(seq).alias("_seq"),
                         *[F.col(c).alias(f"prev{back}_{c}") for c in cols])
    out = placed.join(prev, "ord", "left")
    same = F.col("_seq") == F.col(seq)
    for c in cols:
        out = out.withColumn(f"prev{back}_{c}", F.when(same, F.col(f"prev{back}_{c}")))
    return out.drop("_seq")


# ---- simple taggers --------------------------------------------------------------
def default_tagger(df: DataFrame, tag: str, name: str = "predicted") -> DataFrame:
    return df.withColumn(name, F.lit(tag))


def _most_frequent(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    best = F.min(F.struct((-F.col("n")).alias("n"), "tag")).alias("b")
    return counts.groupBy(*by).agg(best).select(*by, F.col("b.tag").alias("tag"))


def unigram_fit(train: DataFrame) -> DataFrame:
    """Most frequent tag of every word (the smallest on a tie)."""
    return _most_frequent(train.groupBy("word", "tag").agg(F.count("*").alias("n")), ["word"])


def unigram_tag(df: DataFrame, model: DataFrame, default: str | None = None, name: str = "predicted") -> DataFrame:
    guess = model.select("word", F.col("tag").alias(name))
    out = df.join(guess, "word", "left")
    return out if default is None else out.na.fill({name: default})


def bigram_fit(train_with_prev: DataFrame, unigram: DataFrame) -> DataFrame:
    """(prev, word) -> tag, kept only where it changes the unigram answer, as a
    backoff model does."""
    counts = train_with_prev.select(F.coalesce("prev1_tag", F.lit("<s>")).alias("prev"), "word", "tag").groupBy(
        "prev", "word", "tag").agg(F.count("*").alias("n"))
    best = _most_frequent(counts, ["prev", "word"])
    return best.join(unigram.withColumnRenamed("tag", "_u"), "word", "left").where(
        F.col("_u").isNull() | (F.col("_u") != F.col("tag"))).select("prev", "word", "tag")


def backoff_tag_forced(df_with_prev: DataFrame, bigram: DataFrame, unigram: DataFrame, default: str,
                       name: str = "predicted") -> DataFrame:
    """Bigram -> unigram -> default with the previous gold tag (teacher forced)."""
    out = df_with_prev.withColumn("prev", F.coalesce("prev1_tag", F.lit("<s>")))
    out = out.join(bigram.withColumnRenamed("tag", "_b"), ["prev", "word"], "left")
    out = out.join(unigram.withColumnRenamed("tag", "_u"), "word", "left")
    return out.withColumn(name, F.coalesce("_b", "_u", F.lit(default))).drop("_b", "_u", "prev")


# ---- chunked decoding ------------------------------------------------------------------
@dataclass
class StateModel:
    """Scores over ``size`` states; state i carries tag ``tag_of[i]``.  ``step``
    gives the scores from state to state of several rows; ``start`` is the entry
    state, ``end`` the score of ending in a state, ``inner`` the states that can
    stand inside a sequence."""

    tags: list[str]
    tag_of: list[int]
    start: int
    end: np.ndarray
    column: str  # the per-row input of ``step``, an array of numbers
    inner: np.ndarray

    @property
    def size(self) -> int:
        return len(self.tag_of)

    @property
    def cells(self) -> int:
        """Scores that meet while one sequence takes one row."""
        return self.size ** 2

    def step(self, values: np.ndarray) -> np.ndarray:
        """rows x from x to"""
        raise NotImplementedError

    def move(self, scores: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores after a row, for each sequence, with the best previous state of
        every state (the first one on a tie)."""
        total = scores[:, :, None] + self.step(values)
        return total.max(1), total.argmax(1)


def _forward(model: StateModel, scores: np.ndarray, values: np.ndarray, first: np.ndarray, length: np.ndarray,
             rows: range, keep: bool) -> list[np.ndarray]:
    """Take sequences (longest first) through ``rows`` of theirs, all of them a row
    at a time; ``scores`` end up after the last one of each.  With ``keep``, the
    best previous states by row number."""
    back, block = [], max(1, CELLS // model.cells)
    for t in rows:
        n = int(np.searchsorted(-length, -t, side="left"))
        came = np.empty((n, model.size), np.uint16)
        for a in range(0, n, block):
            some = slice(a, min(a + block, n))
            scores[some], came[some] = model.move(scores[some], values[first[some] + t])
        if keep:
            back.append(came)
    return back


def _one_hot(model: StateModel, states: np.ndarray) -> np.ndarray:
    scores = np.full((len(states), model.size), NEG)
    scores[np.arange(len(states)), states] = 0.0
    return scores


def _from_entries(model: StateModel, entry: np.ndarray, values: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Scores from entry states to all states, for chunks (longest first) that
    stand once for each of their entries.

    What happened before a chunk soon stops to matter: the scores from two entries
    then differ by a constant.  Such entries go on as one, looked for after 1, 2,
    4, ... rows, so most rows cost as much as decoding."""
    scores, stands, lift = _one_hot(model, entry), np.arange(len(entry)), np.zeros(len(entry))
    done, total = 0, int(length[0])
    while done < total:
        stop = min(max(1, 2 * done), total)
        _forward(model, scores, values, first, length, range(done, stop), False)
        done = stop
        top = scores.max(1)
        _, at, of = np.unique(first, return_index=True, return_inverse=True)
        lead = at[of]  # the first entry left of the same chunk
        same = np.abs(scores - top[:, None] - (scores[lead] - top[lead, None])).max(1) <= 1e-9
        same[at] = False
        into, left = np.where(same, lead, np.arange(len(scores))), np.flatnonzero(~same)
        lift += np.where(same, top - top[lead], 0.0)[stands]
        number = np.cumsum(~same) - 1
        stands = number[into[stands]]
        scores, first, length = scores[left], first[left], length[left]
    return scores[stands] + lift[:, None]


def _pieces(batches, seq: str, rows: int):
    """Tables of whole chunks with about ``rows`` rows, with the first row and
    the length of each chunk; rows arrive by sequence, chunk and order."""
    held: list[pa.RecordBatch] = []

    def borders(table):
        differs = np.zeros(table.num_rows, bool)
        differs[:1] = True
        for name in (seq, "chunk"):
            col = table.column(name).combine_chunks()
            other = pc.not_equal(col.slice(1), col.slice(0, max(len(col) - 1, 0)))
            differs[1:] |= other.fill_null(True).to_numpy(zero_copy_only=False)
        return np.flatnonzero(differs)

    def cut(table, at):
        return table, at, np.diff(np.append(at, table.num_rows))

    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            at = borders(table)
            if len(at) > 1:
                yield cut(table.slice(0, int(at[-1])), at[:-1])
                table = table.slice(int(at[-1]))
                held = table.to_batches()
                n = table.num_rows
    if held:
        table = pa.Table.from_batches(held)
        yield cut(table, borders(table))


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    lists = table.column(column).combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _longest_first(first: np.ndarray, length: np.ndarray, most: int):
    """Runs of at most ``most`` chunks of falling length."""
    order = np.argsort(-length, kind="stable")
    for a in range(0, len(order), most):
        yield order[a:a + most]


def decode(placed: DataFrame, seq: str, model: StateModel, name: str = "predicted") -> DataFrame:
    """Best tag sequence of every sequence. ``placed`` has ord, chunk and the
    column the model reads.

    Chunks of sequences with several are first reduced to the scores from their
    entry states to all states; combined as a stream, these fix the states at
    the chunk borders. Then all chunks are decoded independently. Tasks step
    many chunks together, a row of each at a time."""
    s = model.size
    seq_type = dict(placed.dtypes)[seq]
    rows = placed.select(seq, "ord", "chunk", model.column)
    long_ones = rows.where(F.col("chunk") > 0).select(seq).distinct()
    at_once, buffered = max(1, CELLS // s), max(1, CELLS // s)

    def by_chunk(df: DataFrame) -> DataFrame:
        return df.repartition(seq, "chunk").sortWithinPartitions(seq, "chunk", "ord")

    def reduce_chunks(batches):
        for table, first, length in _pieces(batches, seq, buffered):
            values, chunk = _matrix(table, model.column), table.column("chunk").to_numpy()
            entries = [np.array([model.start]) if chunk[f] == 0 else model.inner for f in first.tolist()]
            count = np.array([len(e) for e in entries])
            piece, entry = np.repeat(np.arange(len(first)), count), np.concatenate(entries)
            for some in _longest_first(first[piece], length[piece], at_once):
                p = piece[some]
                scores = _from_entries(model, entry[some], values, first[p], length[p])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * s, pa.int32()), pa.array(scores.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [table.column(seq).combine_chunks().take(pa.array(first[p])), pa.array(chunk[first[p]], pa.int64()),
                     pa.array(entry[some], pa.int32()), lists], names=[seq, "chunk", "entry", "scores"])

    tables = cut_lineage(by_chunk(rows.join(long_ones, seq, "left_semi")).mapInArrow(
        reduce_chunks, f"`{seq}` {seq_type}, chunk bigint, entry int, scores array<double>"))

    def combine(batches):
        # of the open sequence: its key, chunks, best entry of each state by chunk; then its open chunk
        key, chunks, came = None, [], []
        scores = best = arg = None

        def close_chunk():
            nonlocal scores
            if best is not None:
                scores = np.maximum(best, NEG)
                came.append(arg)

        def close_sequence():
            state = int((scores + model.end).argmax())
            enters, leaves = [], []
            for back in reversed(came):
                leaves.append(state)
                state = int(back[state])
                enters.append(state)
            n = len(chunks)
            return pa.RecordBatch.from_arrays(
                [pa.array([key] * n, kind), pa.array(chunks, pa.int64()), pa.array(enters[::-1], pa.int32()),
                 pa.array(leaves[::-1], pa.int32())], names=[seq, "chunk", "enter", "leave"])

        kind = None
        for table, first, length in _pieces(batches, seq, 1):
            kind = table.schema.field(seq).type
            scored, entry, chunk = _matrix(table, "scores"), table.column("entry").to_numpy(), table.column("chunk").to_numpy()
            keys = table.column(seq).combine_chunks().take(pa.array(first)).to_pylist()
            for k, f, n in zip(keys, first.tolist(), length.tolist(), strict=True):
                close_chunk()
                if not chunks or k != key:
                    if chunks:
                        yield close_sequence()
                    key, chunks, came = k, [], []
                    scores = _one_hot(model, np.array([model.start]))[0]
                chunks.append(int(chunk[f]))
                total = scores[entry[f:f + n], None] + scored[f:f + n]
                top = total.argmax(0)
                best, arg = total[top, np.arange(s)], entry[f:f + n][top].astype(np.uint16)
        if chunks:
            close_chunk()
            yield close_sequence()

    borders = tables.repartition(seq).sortWithinPartitions(seq, "chunk", "entry").mapInArrow(
        combine, f"`{seq}` {seq_type}, chunk bigint, enter int, leave int")

    def decode_chunks(batches):
        tag_of = np.array(model.tag_of)
        for table, first, length in _pieces(batches, seq, buffered):
            values = _matrix(table, model.column)
            enter, leave = (table.column(c).fill_null(-1).to_numpy()[first] for c in ("enter", "leave"))
            tags = np.zeros(table.num_rows, np.int64)
            for some in _longest_first(first, length, at_once):
                f, n = first[some], length[some]
                scores = _one_hot(model, np.where(enter[some] < 0, model.start, enter[some]))
                back = _forward(model, scores, values, f, n, range(int(n[0])), True)
                state = np.where(leave[some] < 0, (scores + model.end).argmax(1), leave[some])
                for t in range(len(back) - 1, -1, -1):
                    m = len(back[t])
                    tags[f[:m] + t] = tag_of[state[:m]]
                    state[:m] = back[t][np.arange(m), state[:m]]
            yield pa.RecordBatch.from_arrays(
                [table.column("ord").combine_chunks(), pa.array(model.tags).take(pa.array(tags))], names=["ord", name])

    joined = by_chunk(rows.join(borders, [seq, "chunk"], "left"))
    return placed.join(joined.mapInArrow(decode_chunks, f"ord bigint, `{name}` string"), "ord")


def tag_set(train: DataFrame) -> list[str]:
    return sorted(r["tag"] for r in bounded_rows(train.select("tag").distinct(), MAX_TAGS, "tags"))


class _Greedy(StateModel):
    """Deterministic left-to-right backoff tagging as a state model: from the
    previous predicted tag exactly one next tag has score 0."""

    def step(self, values: np.ndarray) -> np.ndarray:
        out = np.full((len(values), self.size, self.size), NEG)
        np.put_along_axis(out, values[:, :, None], 0.0, 2)
        return out


def backoff_tag(placed: DataFrame, seq: str, bigram: DataFrame, unigram: DataFrame, default: str,
                tags: list[str], name: str = "predicted") -> DataFrame:
    """Bigram on the previous *predicted* tag -> unigram -> default."""
    tags = sorted({*tags, default})
    index = F.lit(tags)
    by_word = bigram.where(F.col("prev").isin([*tags, "<s>"])).groupBy("word").agg(
        F.map_from_entries(F.collect_list(F.struct("prev", "tag"))).alias("_m"))  # at most one entry per tag
    rows = placed.join(by_word, "word", "left").join(unigram.withColumnRenamed("tag", "_u"), "word", "left")
    fallback = F.coalesce("_u", F.lit(default))
    choice = F.transform(F.lit([*tags, "<s>"]), lambda p: (F.array_position(
        index, F.coalesce(F.try_element_at("_m", p), fallback)) - 1).cast("int"))
    rows = rows.withColumn("choice", choice).drop("_m", "_u")
    model = _Greedy(tags, [*range(len(tags)), 0], len(tags), np.zeros(len(tags) + 1), "choice",
                    np.arange(len(tags)))
    return decode(rows, seq, model, name).drop("choice")


# ---- hidden Markov model -------------------------------------------------------------
def hmm_counts(train_with_prev: DataFrame) -> dict[str, DataFrame]:
    """Start, transition and emission counts."""
    start = train_with_prev.where(F.col("prev1_tag").isNull()).groupBy("tag").agg(F.count("*").alias("n"))
    trans = train_with_prev.where(F.col("prev1_tag").isNotNull()).groupBy(
        F.col("prev1_tag").alias("prev"), "tag").agg(F.count("*").alias("n"))
    emit = train_with_prev.groupBy("tag", "word").agg(F.count("*").alias("n"))
    return {"start": start, "transition": trans, "emission": emit}


class _Hmm(StateModel):
    transition: np.ndarray

    def step(self, values: np.ndarray) -> np.ndarray:
        return self.transition[None] + values[:, None, :]


def hmm_tag(placed: DataFrame, seq: str, counts: dict[str, DataFrame], name: str = "predicted") -> DataFrame:
    """Viterbi with add-one smoothed tables."""
    start = {r["tag"]: r["n"] for r in bounded_rows(counts["start"], MAX_TAGS, "start counts")}
    trans = {(r["prev"], r["tag"]): r["n"] for r in bounded_rows(counts["transition"], MAX_TAGS ** 2, "transitions")}
    per_tag = {r["tag"]: (r["n"], r["types"]) for r in counts["emission"].groupBy("tag").agg(
        F.sum("n").alias("n"), F.count("*").alias("types")).collect()}
    tags = sorted(per_tag)
    k, vocabulary = len(tags), counts["emission"].select("word").distinct().count()
    table = np.full((k + 1, k + 1), NEG)
    for j, b in enumerate(tags):
        table[k, j] = np.log((start.get(b, 0) + 1) / (sum(start.values()) + k))
        for i, a in enumerate(tags):
            out_of = sum(trans.get((a, c), 0) for c in tags)
            table[i, j] = np.log((trans.get((a, b), 0) + 1) / (out_of + k))
    mass = {t: per_tag[t][0] + vocabulary + 1 for t in tags}
    by_word = counts["emission"].groupBy("word").agg(
        F.map_from_entries(F.collect_list(F.struct("tag", "n"))).alias("_m"))  # at most one entry per tag
    logs = F.transform(F.lit(tags), lambda t: F.log(F.coalesce(F.try_element_at("_m", t), F.lit(0)) + 1.0))
    rows = placed.join(by_word, "word", "left").withColumn("emit", F.concat(
        F.zip_with(logs, F.lit([float(np.log(mass[t])) for t in tags]), lambda a, b: a - b), F.array(F.lit(NEG))))
    model = _Hmm(tags, [*range(k), 0], k, np.zeros(k + 1), "emit", np.arange(k))
    model.transition = table
    return decode(rows.drop("_m"), seq, model, name).drop("emit")


# ---- interpolated trigrams -------------------------------------------------------------
def trigram_counts(train: DataFrame) -> dict[str, DataFrame]:
    """Tag n-grams with boundary marks; ``train`` carries prev1_tag, prev2_tag."""
    t = train.select(F.coalesce("prev2_tag", F.lit("<s>")).alias("t1"), F.coalesce("prev1_tag", F.lit("<s>")).alias("t2"),
                     F.col("tag").alias("t3"), "word")
    n = F.count("*").alias("n")
    return {"uni": t.groupBy("t3").agg(n), "bi": t.groupBy("t2", "t3").agg(n), "tri": t.groupBy("t1", "t2", "t3").agg(n),
            "emission": t.groupBy(F.col("t3").alias("tag"), "word").agg(n)}


def interpolation_weights(counts: dict[str, DataFrame]) -> DataFrame:
    """Deleted interpolation: every trigram votes with its count for the order
    whose leave-one-out estimate is largest (the lower order on a tie)."""
    tri, bi, uni = counts["tri"], counts["bi"], counts["uni"]
    total = uni.agg(F.sum("n").alias("t")).first()["t"]
    ctx2 = tri.groupBy("t1", "t2").agg(F.sum("n").alias("c12"))
    ctx1 = bi.groupBy("t2").agg(F.sum("n").alias("c2"))
    j = (tri.join(ctx2, ["t1", "t2"]).join(bi.withColumnRenamed("n", "c23"), ["t2", "t3"])
         .join(ctx1, "t2").join(uni.withColumnRenamed("n", "c3"), "t3"))

    def share(a, b):
        return F.coalesce((a - 1) / F.nullif(b - 1, F.lit(0)), F.lit(0.0))

    p3, p2 = share(F.col("n"), F.col("c12")), share(F.col("c23"), F.col("c2"))
    p1 = share(F.col("c3"), F.lit(total))
    w = j.select("n", F.when((p1 >= p2) & (p1 >= p3), 1).when(p2 >= p3, 2).otherwise(3).alias("o"))
    sums = w.agg(*[F.sum(F.when(F.col("o") == i, F.col("n")).otherwise(0)).alias(f"s{i}") for i in (1, 2, 3)])
    all_ = F.col("s1") + F.col("s2") + F.col("s3")
    return sums.select(*[(F.col(f"s{i}") / all_).alias(f"lambda{i}") for i in (1, 2, 3)])


class _Trigram(StateModel):
    """State (a, b) = a * m + b over the m - 1 tags and the boundary mark; a row
    moves (a, b) to (b, c), so only m scores meet in a new state."""

    transition: np.ndarray  # m x m x m scores of c after a, b

    @property
    def cells(self) -> int:
        return self.transition.size

    def move(self, scores: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = len(self.transition)
        total = scores.reshape(len(scores), m, m, 1) + self.transition[None]
        first = total.argmax(1)  # best a for every (b, c)
        best = np.take_along_axis(total, first[:, None], 1)[:, 0] + values[:, None, :]
        came = first * m + np.arange(m)[None, :, None]
        return best.reshape(len(scores), -1), came.reshape(len(scores), -1)


def trigram_tag(placed: DataFrame, seq: str, counts: dict[str, DataFrame], name: str = "predicted") -> DataFrame:
    """Exact search over tag pairs (a beam wide enough to keep all of them)."""
    lam = interpolation_weights(counts).first()
    uni = {r["t3"]: r["n"] for r in bounded_rows(counts["uni"], MAX_TAGS, "tags")}
    bi = {(r["t2"], r["t3"]): r["n"] for r in bounded_rows(counts["bi"], MAX_TAGS ** 2, "tag pairs")}
    tri = {(r["t1"], r["t2"], r["t3"]): r["n"] for r in bounded_rows(counts["tri"], MAX_TAGS ** 3, "tag triples")}
    tags = sorted(uni)
    k, total = len(tags), sum(uni.values())
    prev = [*tags, "<s>"]
    c1 = {a: sum(bi.get((a, c), 0) for c in tags) for a in prev}
    c12 = {(a, b): sum(tri.get((a, b, c), 0) for c in tags) for a in prev for b in prev}

    def score(a, b, c):
        p = lam["lambda1"] * uni[c] / total
        p += lam["lambda2"] * bi.get((b, c), 0) / c1[b] if c1[b] else 0.0
        p += lam["lambda3"] * tri.get((a, b, c), 0) / c12[a, b] if c12[a, b] else 0.0
        return np.log(max(p, 1e-12))

    table = np.array([[[score(a, b, c) for c in tags] + [NEG] for b in prev] for a in prev])
    vocabulary = counts["emission"].select("word").distinct().count()
    mass = {t: uni[t] + vocabulary + 1 for t in tags}
    by_word = counts["emission"].groupBy("word").agg(
        F.map_from_entries(F.collect_list(F.struct("tag", "n"))).alias("_m"))  # at most one entry per tag
    logs = F.transform(F.lit(tags), lambda t: F.log(F.coalesce(F.try_element_at("_m", t), F.lit(0)) + 1.0))
    rows = placed.join(by_word, "word", "left").withColumn("emit", F.concat(F.zip_with(
        logs, F.lit([float(np.log(mass[t])) for t in tags]), lambda a, b: a - b), F.array(F.lit(NEG))))
    tag_of = [*(list(range(k)) + [0]) * (k + 1)]
    model = _Trigram(tags, tag_of, (k + 1) ** 2 - 1, np.zeros((k + 1) ** 2), "emit",
                     np.flatnonzero(np.arange((k + 1) ** 2) % (k + 1) < k))
    model.transition = table
    return decode(rows.drop("_m"), seq, model, name).drop("emit")


# ---- evaluation ---------------------------------------------------------------------------
def evaluate_tagger(df: DataFrame, gold: str = "tag", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    hit = F.coalesce(F.col(gold) == F.col(predicted), F.lit(False))
    return df.groupBy(*by).agg(F.avg(hit.cast("double")).alias("accuracy"), F.count("*").alias("tokens"))


def tag_confusion(df: DataFrame, gold: str = "tag", predicted: str = "predicted") -> DataFrame:
    return df.groupBy(gold, predicted).agg(F.count("*").alias("n"))


def learning_curve(train: DataFrame, test: DataFrame, sizes: Sequence[int], ordinal: str, default: str) -> DataFrame:
    """Unigram-with-default accuracy per training size (number of sequences),
    all sizes as a key of the same aggregation."""
    grid = F.filter(F.lit(list(sizes)), lambda n: F.col(ordinal) < n)
    counts = train.select("word", "tag", F.explode(grid).alias("size")).groupBy("size", "word", "tag").agg(
        F.count("*").alias("n"))
    model = _most_frequent(counts, ["size", "word"]).withColumnRenamed("tag", "predicted")
    probe = test.groupBy("word", "tag").agg(F.count("*").alias("w")).select(
        "word", "tag", "w", F.explode(F.lit(list(sizes))).alias("size"))
    guess = F.coalesce("predicted", F.lit(default))
    return probe.join(model, ["size", "word"], "left").groupBy("size").agg(
        (F.sum(F.when(guess == F.col("tag"), F.col("w")).otherwise(0)) / F.sum("w")).alias("accuracy"))


def training_ordinal(df: DataFrame, seq: str) -> DataFrame:
    """0-based number of every sequence in key order."""
    return with_ordinal(df.select(seq).distinct(), [seq], "seq_no")


def next_tag_counts(placed: DataFrame, seq: str) -> DataFrame:
    """(previous tag, tag) pair counts."""
    prev = with_previous(placed, seq, ["tag"])
    return prev.where(F.col("prev1_tag").isNotNull()).groupBy(F.col("prev1_tag").alias("t1"), F.col("tag").alias("t2")).agg(
        F.count("*").alias("n"))


def tags_after_word(placed: DataFrame, seq: str, word: str) -> DataFrame:
    prev = with_previous(placed, seq, ["word"])
    return prev.where(F.col("prev1_word") == word).groupBy("tag").agg(F.count("*").alias("n"))


def tags_before_tag(placed: DataFrame, seq: str, tag: str) -> DataFrame:
    return next_tag_counts(placed, seq).where(F.col("t2") == tag).select(F.col("t1").alias("tag"), "n")


