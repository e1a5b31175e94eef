"""Token counts by overlap resynchronisation (operator 7).

A document longer than ``CHUNK`` characters is cut into chunks that overlap.
Each chunk is encoded on its own, with offsets. A chunk that starts anywhere
may begin with wrong tokens, and one that ends anywhere may end with some; two
neighbours are spliced at a place in their overlap where both have a token
boundary and which is proven stable: a non-white character followed by a space
or a line feed, or two neighbours of different kinds among letters, digits and punctuation
(``_STABLE``). The byte-level pattern never continues over such a place nor
looks behind it, so what either side holds there does not depend on where its
chunk began or ended. Where an overlap holds no such place it is widened; where the whole left
chunk holds none (a run of a million letters), that is encoded anew to twice its length.

Shorter documents are encoded whole (``bpe.FragmentEncoder``, equal to the
library). A SentencePiece ``.model`` file has no such stable places (its
normaliser and unigram or merge search run over the whole text), so there
every document is encoded whole.

Edge cases: null text counts as empty (0 bytes, 0 tokens). Special strings
inside texts are treated as the library does by default. Repeated rows and
null keys are counted like any other row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from hostelry.llm.bpe import encoder
from hostelry.llm.common import only, text_parts, texts

#: Characters of a chunk, and by how many it overlaps the next at first.
CHUNK, OVERLAP = 16_384, 256
# Letters, digits and punctuation that every version of Unicode classes alike. The pre-tokeniser always cuts where one
# of these kinds follows another, but for an apostrophe before a letter, and where a blank or line feed follows what is not white.
_L = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f\u0391-\u03a1\u03b1-\u03c9\u0410-\u044f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_P = "!-&(-/:-@\\[-`{-~\u3001\u3002\u300c-\u300f\uff01\uff0c\uff1a\uff1b\uff1f"
_STABLE = re.compile(f"(?<=[{_L}])[0-9{_P}']|(?<=[0-9])[{_L}{_P}']|(?<=[{_P}])[0-9{_L}]|(?<=\\S)[ \\n]")


class Chunk:
    """Encoding of text[start:stop]; boundaries are positions in the text."""

    def __init__(self, start: int, stop: int, encoding):
        self.start, self.stop = start, stop
        self.begins = start + np.array([a for a, _ in encoding.offsets], np.int64)

    def tokens(self, a: int, b: int) -> int:
        """Tokens that begin in text[a:b]."""
        lo, hi = np.searchsorted(self.begins, [a, b], "left")
        return int(hi - lo)

    def has(self, p: int) -> bool:
        i = np.searchsorted(self.begins, p, "left")
        return i < len(self.begins) and self.begins[i] == p


def common_boundary(text: str, left: Chunk, right: Chunk, after: int, special: list[str]) -> int | None:
    """First stable place in the overlap, beyond ``after`` and inside no special string, where both
    chunks begin a token. The character there is inside both chunks, so the left one has seen it."""
    for m in _STABLE.finditer(text, max(right.start, after + 1), left.stop):
        p = m.start()
        if left.has(p) and right.has(p) and not any(-1 < text.find(s, max(0, p - len(s) + 1), p + len(s) - 1) < p for s in special):
            return p
    return None


def count_tokens(text: str, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one long text, from overlapping chunks, of which two are held at a time.

    The overlap is widened until it holds a stable place at which both chunks begin a token. If
    the left chunk has none beyond the last splice, it is encoded again to twice its
    length, so all encodings together are linear in the text."""
    def encoded(a: int, b: int) -> Chunk:
        b = min(b, len(text))
        return Chunk(a, b, tokenizer.encode(text[a:b], add_special_tokens=False))
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    total, since, left = 0, 0, encoded(0, chunk + overlap)
    while left.stop < len(text):
        width, p = overlap, None
        while p is None and left.stop - width > since:
            start = left.stop - width
            if _STABLE.search(text, start, left.stop):
                right = encoded(start, left.stop + chunk)
                p = common_boundary(text, left, right, since, special)
            width *= 2
        if p is None:
            left = encoded(left.start, left.stop + max(chunk, left.stop - left.start))
        else:
            total += left.tokens(since, p)
            since, left = p, right
    return total + left.tokens(since, len(text))


def token_counts(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit: n_tokens > limit) of every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path.endswith(".model"):
            import sentencepiece
            processor = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            enc = encoder(path)
        for part in text_parts(batches, text):
            col = texts(part, text)
            if path.endswith(".model"):
                counts = np.array([len(x) for x in processor.encode(col.to_pylist(), num_threads=1)], np.int64)
            else:
                long = pc.utf8_length(col).to_numpy(zero_copy_only=False) > CHUNK
                counts = enc.encode(pc.if_else(pa.array(long), pa.scalar("", pa.large_string()), col))[1]
                for i in np.flatnonzero(long):
                    counts[i] = count_tokens(col[i].as_py(), enc.tokenizer)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pc.binary_length(col).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(counts > limit)],
                ["key", "n_bytes", "n_tokens", "over_limit"])
    src = only(docs, key, text)
    kind = src.schema[key].dataType.simpleString()
    return src.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("key", key)
