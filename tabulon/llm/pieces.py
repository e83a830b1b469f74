"""SentencePiece encoding and decoding over a relational lattice.

A text is split at spaces; every word starts with the space mark.  The distinct
words of a batch of texts become a table of substrings of bounded length, which
is equi-joined with the piece table; the joined rows are the edges of the
lattice, grouped by word and end.  Spark's higher-order ``aggregate`` folds
Viterbi over the ends of a word.  Texts then take the pieces of their words.

The three steps follow each other within a task, so no row is shuffled: the
substrings of all texts are about fifty times the input, those of the distinct
words of a batch are less than the input.  The piece table is small by
definition (``MAX_PIECES``) and is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.llm.common import fresh, slices

#: Vocabulary of the public tokenizers that queries use; a parameter everywhere.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Proves the size of the broadcast.
MAX_PIECES = 1_000_000
#: Code points that are folded in one go; a longer word is folded part by part, the
#: last states of a part are carried over, so the best path is that of the whole word.
PART = 128
#: Code points of the longest piece that an edge's 8 bits allow.
MAX_PIECE = 256 - PART
#: Bytes of text whose distinct words are encoded together; words and code points of a row batch.
BATCH_BYTES, BATCH_WORDS, BATCH_POINTS = 12 << 20, 20_000, 1 << 18
#: Space mark, and a lone surrogate that stands for a mark found in a text.
_MARK, _OWN_MARK = "▁", "\udc81"
_MULT = np.uint64(0x9E3779B97F4A7C15)
#: An edge is one number: score in steps, then 8 bits of start (its place among the
#: states at hand while its part is folded), then 24 bits of piece number, or of the
#: code point with ``_LONE`` set where there is no piece.
_ENDS = "array<array<long>>"
_LONE = 1 << 23


class Vocabulary:
    """Pieces by number with scores; byte pieces by byte."""

    def __init__(self, pieces: list[str], scores: list[float], bytes_: list[int]):
        self.pieces, self.scores, self.bytes_ = pieces, scores, bytes_

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        """From a model file with byte fallback."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        if n > MAX_PIECES:
            raise ValueError(f"{n} pieces; at most {MAX_PIECES} are broadcast")
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
        pieces = [sp.id_to_piece(i) if plain[i] else "" for i in range(n)]
        by_byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if len(by_byte) != 256:
            raise ValueError("the vocabulary lacks byte pieces")
        return cls(pieces, [sp.get_score(i) for i in range(n)], [by_byte[b] for b in range(256)])

    def decoded(self) -> list[bytes]:
        """Bytes that each piece stands for."""
        out = [p.replace(_MARK, " ").encode() for p in self.pieces]
        for b, i in enumerate(self.bytes_):
            out[i] = bytes([b])
        return out


class Lattice:
    """The piece table by length, ready to be joined.  ``used`` are the numbers of
    its pieces, all if not given."""

    def __init__(self, v: Vocabulary, used: list[int] | None = None):
        real = [(p, i) for i, p in enumerate(v.pieces) if p]
        self.longest = max((len(p) for p, _ in real), default=1)
        usual = [v.scores[i] for _, i in real if v.scores[i] > -1e8]
        self.fallback = (min(usual) if usual else 0.0) - 10.0
        if self.longest > MAX_PIECE:
            raise ValueError(f"a piece has {self.longest} code points; at most {MAX_PIECE} fit")
        # sums of scores in steps, from the first state carried to the end of a part, fit in 31 bits
        largest = max(map(abs, [*usual, self.fallback]))
        self.steps = 2.0 ** int(np.floor(np.log2((1 << 31) / (largest * (PART + 2 * self.longest + 1)))))
        self.by_length = {}
        if used is not None:
            real = [(v.pieces[i], i) for i in used]
        for n in sorted({len(p) for p, _ in real}):
            some = [(p, i) for p, i in real if len(p) == n]
            points = np.frombuffer("".join(p for p, _ in some).encode("utf-32-le"), np.uint32).reshape(-1, n)
            keys = np.zeros(len(some), np.uint64)
            for k in range(n):
                keys = keys * _MULT + points[:, k]
            order = np.argsort(keys, kind="stable")
            ids = np.array([i for _, i in some], np.int32)[order]
            self.by_length[n] = keys[order], points[order], ids, np.array(v.scores)[ids]

    def in_steps(self, scores: np.ndarray) -> np.ndarray:
        """Whole numbers that scores are added as."""
        return np.rint(np.maximum(scores, self.fallback) * self.steps).astype(np.int64)

    def edges(self, words: list[str]):
        """Explode, join, group: (offsets of words in code points, number of
        edges for each end, edges).  Pieces with scores below -1e8 are as good as
        a code point without a piece."""
        sizes = np.array([len(w) for w in words], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        stop = np.repeat(offsets[1:], sizes)
        begin = np.repeat(offsets[:-1], sizes)
        n, at, parts, alone = len(points), np.arange(len(points)), [], np.zeros(len(points), bool)
        keys = np.zeros(n, np.uint64)
        for length in range(1, max(self.by_length, default=0) + 1):
            keep = at + length <= stop[at]
            at, keys = at[keep], keys[keep]
            keys = keys * _MULT + points[at + (length - 1)]
            if length not in self.by_length:
                continue
            known, spelled, ids, scores = self.by_length[length]
            place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = np.flatnonzero(known[place] == keys)
            starts, place = at[hit], place[hit]
            same = (points[starts[:, None] + np.arange(length)] == spelled[place]).all(axis=1)
            starts, place = starts[same], place[same]
            if length == 1:
                alone[starts] = True
            parts.append((starts, starts + length, scores[place], ids[place]))
        lone = np.flatnonzero(~alone)
        parts.append((lone, lone + 1, np.full(len(lone), self.fallback), _LONE | points[lone].astype(np.int32)))
        starts, ends, scores, ids = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(ends, kind="stable")
        counts = np.bincount(ends - 1, minlength=n) if n else np.zeros(0, np.int64)
        score = self.in_steps(scores)
        place = starts - begin[starts] - carried_from(ends - begin[starts], self.longest)
        edges = (score << 32) | (place << 24) | ids
        return offsets, counts, edges[order]


def useful(v: Vocabulary) -> list[int]:
    """Pieces that some word's best path may take.  A piece is left out if other
    pieces spell it with a larger sum of scores: wherever it fits they fit, so no
    best path to any state has it.  (Of merge-rank scores that is most pieces.)"""
    numbers = [i for i, p in enumerate(v.pieces) if p]
    score = dict(zip((v.pieces[i] for i in numbers), Lattice(v, []).in_steps(np.array(v.scores)[numbers]).tolist(), strict=True))
    out = []
    for i in numbers:
        p = v.pieces[i]
        best: list[int | None] = [0]
        for end in range(1, len(p) + 1):
            sums = [best[start] + score[p[start:end]] for start in range(end)
                    if best[start] is not None and end - start < len(p) and p[start:end] in score]
            best.append(max(sums, default=None))
        if best[-1] is None or best[-1] <= score[p]:
            out.append(i)
    return out


def carried_from(end: np.ndarray, longest: int) -> np.ndarray:
    """Place in its word of the first state at hand when the part of ``end`` is
    folded: the first part has the word's start, later ones ``longest`` states
    from before."""
    part = (end - 1) // PART
    return np.where(part > 0, part * PART - longest + 1, 0)


def viterbi(ends: Column, longest: int) -> Column:
    """For each place in a word the best edge that ends there, with the sum of
    scores up to it: the largest sum, then the later start, then the larger number.

    The sum stands in an edge's high bits, so adding an edge to the state at its
    start (low bits cleared) gives the state at its end.  Words of several parts
    carry as many states from part to part as a piece can reach back, their sums
    taken relative to the last one."""
    high = F.lit(-1 << 32)

    def step(acc, edges):
        # every place is reached, so an edge always finds the state at its start
        return F.array_append(acc, F.array_max(F.transform(
            edges, lambda e: F.get(acc, F.shiftright(e, 24).bitwiseAND(255).cast("int")).bitwiseAND(high) + e)))

    def take_part(acc, part):
        return F.get(F.transform(F.array(F.aggregate(part, acc["carry"], step)), lambda states: F.struct(
            F.transform(F.slice(states, F.lit(-longest), F.lit(longest)),
                        lambda s: s - F.element_at(states, -1).bitwiseAND(high)).alias("carry"),
            F.array_append(acc["done"], F.slice(states, F.size(acc["carry"]) + 1, F.size(part))).alias("done"))), F.lit(0))

    start = F.array(F.lit(0).cast("long"))
    last = F.floor((F.size(ends) - 1) / PART).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(ends, k * PART + 1, F.lit(PART)))
    zero = F.struct(start.alias("carry"), F.array().cast(_ENDS).alias("done"))
    by_part = F.aggregate(parts, zero, take_part, lambda acc: F.concat(start, F.flatten(acc["done"])))
    return F.when(F.size(ends) <= PART, F.aggregate(ends, start, step)).otherwise(by_part)


def best_paths(states: np.ndarray, sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of words, one after the other, and their numbers, read backwards
    from the last state of every word; ``sizes`` are numbers of states."""
    first = np.cumsum(sizes) - sizes
    at, word, back = sizes - 1, np.arange(len(sizes)), []
    while len(word):
        state = states[first[word] + at]
        back.append((word, state & 0xFFFFFF))
        at = ((state >> 24) & 0xFF) + carried_from(at, longest)
        word, at = word[at > 0], at[at > 0]
    if not back:
        return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
    words = np.concatenate([w for w, _ in back])
    step = np.repeat(np.arange(len(back)), [len(w) for w, _ in back])
    order = np.lexsort((-step, words))
    return np.concatenate([p for _, p in back])[order], np.bincount(words, minlength=len(sizes))


def _words(text: str) -> list[str]:
    """Marked words."""
    return [_MARK + w for w in text.replace(_MARK, _OWN_MARK).split(" ")]


def _word_batches(words: list[str]):
    """Runs of at most ``BATCH_WORDS`` words with about ``BATCH_POINTS`` code points;
    a longer word is alone."""
    begin = size = 0
    for i, w in enumerate(words):
        if i > begin and (i - begin == BATCH_WORDS or size + len(w) > BATCH_POINTS):
            yield words[begin:i]
            begin, size = i, 0
        size += len(w)
    if begin < len(words):
        yield words[begin:]


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "ids") -> DataFrame:
    """Append ``out``, the piece numbers of every whole text; all columns stay.

    Null gives null, an empty text no pieces.  Code points without a piece, and
    the space mark itself, become byte pieces, so decoding is exact.  Words of any
    length have the best path of the whole word.  Equal texts have equal pieces,
    wherever they stand; an empty table gives an empty one.  If a column ``out``
    exists, underscores are added to the new one's name.
    """
    out = fresh(docs, out)
    batch_no, at, ends = (fresh(docs, c) for c in ("_batch", "_at", "_ends"))
    sent = docs.sparkSession.sparkContext.broadcast(
        (vocabulary.pieces, vocabulary.scores, vocabulary.bytes_, useful(vocabulary)))
    plain = [T.StructField(f.name, f.dataType, True) for f in docs.schema.fields]
    tail = T._parse_datatype_string(f"`{batch_no}` int, `{at}` array<int>, `{ends}` {_ENDS}").fields

    def lattice(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        schema, table, number = to_arrow_schema(T.StructType([*plain, *tail])), Lattice(Vocabulary(*sent.value[:3]), sent.value[3]), 0
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                number += 1
                seen: dict[str, int] = {}
                places = []
                for t in part.column(part.schema.get_field_index(text)).to_pylist():
                    places.append(None if t is None else np.array(
                        [seen.setdefault(w, len(seen)) for w in _words(t)] if t else [], np.int32))
                words = list(seen)
                del seen
                for some in _word_batches(words):
                    offsets, counts, edges = table.edges(some)
                    inner = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(edges))
                    outer = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), inner)
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.nulls(len(some), f.type) for f in list(schema)[:-3]],
                         pa.array(np.full(len(some), number, np.int32)), pa.nulls(len(some), schema.field(at).type),
                         outer.cast(schema.field(ends).type)], schema=schema)
                for b in range(0, part.num_rows, 1000):
                    rows = part.slice(b, 1000)
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(np.full(rows.num_rows, number, np.int32)),
                         pa.array(places[b:b + 1000], schema.field(at).type),
                         pa.nulls(rows.num_rows, schema.field(ends).type)], schema=schema)

    joined = docs.mapInArrow(lattice, T.StructType([*plain, *tail]))
    word, longest = F.col(ends).isNotNull(), max(map(len, vocabulary.pieces))
    folded = joined.select(*docs.columns, batch_no, at, F.when(word, viterbi(F.col(ends), longest)).alias(ends))

    def assemble(batches):
        of_byte, number, paths = sent.value[2], 0, []
        flat = first = count = None
        for batch in batches:
            mark = batch.column(batch.schema.get_field_index(batch_no)).to_numpy(zero_copy_only=False)
            path = batch.column(batch.schema.get_field_index(ends))
            is_word = np.asarray(path.is_valid())
            border = np.flatnonzero(np.diff(mark) | np.diff(is_word.astype(np.int8))) + 1
            for a, b in zip([0, *border.tolist()], [*border.tolist(), batch.num_rows], strict=True):
                if b == a:
                    continue
                if mark[a] != number:
                    number, paths, flat = int(mark[a]), [], None
                if is_word[a]:
                    states = path.slice(a, b - a)
                    codes, n = best_paths(states.flatten().to_numpy(), np.diff(states.offsets.to_numpy()), longest)
                    paths.append(_bytes_spelled(codes, n, of_byte))
                    continue
                if flat is None:
                    flat = np.concatenate([np.zeros(0, np.int32), *[f for f, _ in paths]])
                    count = np.concatenate([np.zeros(0, np.int64), *[c for _, c in paths]])
                    first = np.cumsum(count) - count
                    paths = []
                rows = batch.slice(a, b - a)
                words = rows.column(rows.schema.get_field_index(at))
                which = words.flatten().to_numpy()
                n = count[which]
                ends_at = np.cumsum(n)
                values = flat[np.repeat(first[which] - (ends_at - n), n) + np.arange(int(n.sum()))]
                upto = np.concatenate([[0], ends_at])
                lengths = pa.compute.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False)
                offsets = upto[np.concatenate([[0], np.cumsum(lengths)])]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                if words.null_count:
                    lists = pa.compute.if_else(words.is_valid(), lists, pa.nulls(len(lists), lists.type))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-3], lists], names=[*rows.schema.names[:-3], out])

    return folded.mapInArrow(assemble, T.StructType([*plain, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def _bytes_spelled(ids: np.ndarray, sizes: np.ndarray, of_byte: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Code points without a piece replaced by byte pieces, and the sizes after that."""
    low = np.flatnonzero(ids & _LONE)
    if not len(low):
        return ids.astype(np.int32), sizes
    spelled = {}
    for p in np.unique(ids[low]).tolist():
        c = chr(p & (_LONE - 1))
        spelled[p] = [of_byte[b] for b in (_MARK if c == _OWN_MARK else c).encode()]
    width = np.ones(len(ids), np.int64)
    width[low] = [len(spelled[p]) for p in ids[low].tolist()]
    upto = np.concatenate([[0], np.cumsum(width)])
    out = np.repeat(ids, width).astype(np.int32)
    for i in low.tolist():
        out[upto[i]:upto[i + 1]] = spelled[int(ids[i])]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return out, np.diff(upto[bounds])


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Append the text that piece numbers stand for.  Null gives null, no pieces
    the empty text; a number outside the vocabulary ends the job."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary.decoded())
    out = fresh(docs, out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        spelled = sent.value
        for batch in batches:
            for b in range(0, batch.num_rows, 1000):
                rows = batch.slice(b, 1000)
                texts = []
                for x in rows.column(rows.schema.get_field_index(ids)):
                    texts.append(None if not x.is_valid else
                                 b"".join(map(spelled.__getitem__, x.values.to_numpy().tolist()))[1:].decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], names=[*rows.schema.names, out])

    return docs.mapInArrow(run, schema)


