"""Numbers of tokens without token ids.

Every text falls into pre-tokens that no piece of the vocabulary crosses.  The
tokenizer counts the pieces of each distinct pre-token of the corpus once; the
counts are joined to the documents' pre-token frequencies and summed.

A pre-token is a run of spaces with what follows it.  It ends before the next
space, since no piece has a space after another character (checked when the
vocabulary is loaded).  One longer than ``LONG`` bytes is cut further
wherever no piece holds the two code points beside the cut.  Pieces only ever
come from joining neighbours into longer pieces of the vocabulary, so the
pieces of a text are those of its pre-tokens.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.llm.common import fresh
from tabulon.llm.factors import answered, by_slice, factored

_MARK = "▁"
#: Bytes of a pre-token that is left whole without a look for cuts.
LONG = 64
_WORD = re.compile(rb" +[^ ]*")
_MARK_BYTES = _MARK.encode()


class Vocabulary:
    """A model of the sentencepiece library as bytes, small by definition and
    sent to the tasks; ``anchor`` is a code point that no piece holds."""

    def __init__(self, model: bytes):
        self.model = model
        pieces = self._pieces()
        if any(p.lstrip(_MARK).count(_MARK) for p in pieces):
            raise ValueError("a piece has a space after another character; its texts have no pre-tokens")
        held = set("".join(pieces))
        self.anchor = next(chr(c) for c in range(0xE000, 0xF8FF) if chr(c) not in held)
        processor = self.processor()
        if processor.normalize(" x  y ﬁ ") != f"{_MARK * 2}x{_MARK * 2}y ﬁ{_MARK}":
            raise ValueError("the vocabulary changes characters or drops spaces")
        self.anchor_size = len(processor.encode(self.anchor))

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls(f.read())

    def processor(self):
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    def _pieces(self) -> list[str]:
        p = self.processor()
        return [p.id_to_piece(i) for i in range(p.get_piece_size())
                if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]

    def pairs(self) -> np.ndarray:
        """Neighbouring code points within pieces, as sorted numbers."""
        return np.unique(np.array([ord(a) << 21 | ord(b) for p in self._pieces() for a, b in zip(p, p[1:], strict=False)], np.int64))

    def counter(self):
        """Function from pre-tokens in UTF-8 to their numbers of pieces.  The
        anchor in front takes the space that the library puts there."""
        processor, anchor, less = self.processor(), self.anchor, self.anchor_size
        return lambda words: [len(ids) - less for b in range(0, len(words), 5000) for ids in processor.encode(
            [anchor + w.decode() for w in words[b:b + 5000]], num_threads=1)]


def splitter(vocabulary: Vocabulary):
    """Function from a text in UTF-8 to its pre-tokens; joined they are the text
    after a space, with space marks as spaces."""
    pairs = None

    def cut(word: bytes) -> list[bytes]:
        nonlocal pairs
        if pairs is None:
            pairs = vocabulary.pairs()
        points = np.frombuffer(word.replace(b" ", _MARK_BYTES).decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        beside = points[:-1] << 21 | points[1:]
        apart = pairs[np.minimum(np.searchsorted(pairs, beside), len(pairs) - 1)] != beside
        sizes = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        sizes[points == ord(_MARK)] = 1
        at = [0, *np.cumsum(sizes)[:-1][apart].tolist(), len(word)]
        return [word[a:b] for a, b in zip(at, at[1:], strict=False)]

    def split(text: bytes) -> list[bytes]:
        words = _WORD.findall(b" " + text.replace(_MARK_BYTES, b" "))
        if max(map(len, words)) > LONG:
            words = [p for w in words for p in (cut(w) if len(w) > LONG else (w,))]
        return words

    return split


def count(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, with ``n_bytes`` (of the
    UTF-8 text) and ``n_tokens`` as the library counts them, without begin, end
    or added special tokens.

    Null counts as the empty text, which has no tokens.  Equal rows, also with
    equal keys, are counted each; texts may be of any length; an empty table
    gives none.  Where a kept column is called like a result, the result's name
    ends in an underscore.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary.model)
    kept = docs.select(*keep)
    n_bytes, n_tokens = fresh(kept, "n_bytes"), fresh(kept, "n_tokens")
    table = factored(docs, text, keep, lambda: splitter(Vocabulary(sent.value)))

    def sizes():
        pieces = Vocabulary(sent.value).counter()
        return lambda words: [str(n).encode() for n in pieces(words)]

    def add(rows: pa.Array, n_bytes: pa.Array, answers: list[bytes], n_docs, places, times) -> pa.Table:
        pieces = np.repeat(np.array(answers, dtype="S").astype(np.int64) if answers else np.zeros(0, np.int64), n_docs)
        total = np.zeros(len(rows), np.int64)
        np.add.at(total, places, times * pieces)
        return pa.table({"kept": rows, "n_bytes": n_bytes, "n_tokens": pa.array(total)})

    schema = T.StructType([T.StructField("kept", table.schema["kept"].dataType.elementType),
                           *T._parse_datatype_string("n_bytes long, n_tokens long").fields])
    counted = by_slice(table, answered(table, sizes), add, schema)
    return counted.select(*[F.col("kept").getField(c).alias(c) for c in kept.columns],
                          F.col("n_bytes").alias(n_bytes), F.col("n_tokens").alias(n_tokens))
