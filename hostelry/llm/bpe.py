"""BPE encoding and decoding by forced-boundary splitting (operator 3).

A pair of adjacent bytes that occurs inside no vocabulary token can never be
joined by a merge, so a text may be cut there, its fragments encoded on their
own and the ids concatenated. Of those pairs only the ones that the
pre-tokeniser also leaves apart in every context are used: a non-white
character followed by a space or by a line feed (no alternative of the
byte-level pattern continues over such a place, and none looks back). Equal
fragments, mostly words, are then encoded once per worker instead of once per
occurrence. Decoding looks bytes up by id and reads them as UTF-8.

Edge cases: null text is empty text (no ids, empty decoded text). A text
without such a boundary is one fragment; a fragment of more than
``LONG_FRAGMENT`` characters (a million blanks or letters) is encoded by the
library. Special strings inside a text are
treated as the tokenizers library does by default; they contain no white
space, so no cut falls into one. Rows keep their number, order within a
partition and repetition; columns other than those asked for are left alone.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from hostelry.llm.common import only, row_chunks, text_parts, texts

#: Fragments remembered by a worker before it starts anew.
FRAGMENT_CACHE = 200_000
#: Bytes of text encoded at once: more means fewer lookups of the same fragment.
ENCODE_BYTES = 4 << 20
#: Characters of a fragment from which on it goes to the library: the rank-based
#: encoder's pattern overflows its stack on a million blanks in a row.
LONG_FRAGMENT = 100_000
#: Fixed value: the pattern by which byte-level BPE splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = re.compile(r"(?<=\S)[ \n]")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes:
    visible Latin-1 bytes stand for themselves, the others for U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class FragmentEncoder:
    """Encodes texts with a byte-level BPE file of the tokenizers library.

    Fragments without special strings are encoded by rank. Merging the adjacent
    pair of least rank gives the library's ids if every token is what the
    library's merges make of its own bytes; ``unreachable`` lists the tokens of
    which that is not so (none in the public files, see the tests).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        spec = json.loads(open(path, encoding="utf-8").read())
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("a byte-level tokenizer without normalizer and prefix space is needed")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = {t["id"]: t["content"] for t in spec["added_tokens"]}
        if any(re.search(r"\s", t) for t in added.values()):
            raise ValueError("added tokens with white space are not supported")
        alphabet = byte_alphabet()
        ids = spec["model"]["vocab"]
        table = [b""] * (max([*ids.values(), *added]) + 1)
        pairs: set[tuple[int, int]] = set()
        for token, i in ids.items():
            table[i] = bytes(alphabet[c] for c in token) if i not in added else b""
            pairs.update(zip(table[i], table[i][1:], strict=False))
        self.added = list(added.values())
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [ids[a + b] for a, b in merges]
        if spec["model"].get("ignore_merges") or made != sorted(made) or len(set(made)) != len(made):
            raise ValueError("the vocabulary's ids must rise with the merges")
        self.merge_rank = {(table[ids[a]], table[ids[b]]): n for n, (a, b) in enumerate(merges)}
        # ids rise with the merges, so ids serve as ranks for a rank-based encoder, which is faster
        import tiktoken
        self.ranked = tiktoken.Encoding("fragments", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            table[i]: i for t, i in ids.items() if i not in added})
        for i, token in added.items():
            table[i] = token.encode()
        #: left bytes after which a space or a line feed is not a forced boundary
        self.unforced = {a for a, b in pairs if b in (0x20, 0x0A)}
        #: visible ASCII pieces, cut safely before and after, tested without a call each
        safe = "".join(f"\\x{b:02x}" for b in range(0x21, 0x7F) if b not in self.unforced)
        self.plain = rf"(?s)^\n?(?:[\x21-\x7e].*)?[{safe}]$" if safe else "[^\\x00-\\x{10FFFF}]"
        self.lengths = np.array([len(t) for t in table], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self._reset()

    def unreachable(self) -> list[int]:
        """Tokens that the merges do not make of their own bytes."""
        out = []
        for i in self.ranked._mergeable_ranks.values():
            parts = [bytes([b]) for b in self.bytes[self.starts[i]:self.starts[i] + self.lengths[i]]]
            while len(parts) > 1:
                rank, k = min((self.merge_rank.get((a, b), 1 << 40), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if rank == 1 << 40:
                    out.append(i)
                    break
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return out

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.frag_start = np.zeros(1, np.int64)  # number 0: nothing
        self.frag_len = np.zeros(1, np.int64)
        self.store = np.empty(0, np.uint32)

    def _closed(self, piece: str) -> bool:
        """A cut right after this piece, before a space or line feed, is safe."""
        last = piece[-1:]
        return bool(last) and not last.isspace() and last.encode()[-1] not in self.unforced

    def pieces(self, text: str) -> list[str]:
        """Fragments of a text, cut only where the boundary is forced; their
        concatenation is the text."""
        out, at = [], 0
        for m in _CUT.finditer(text):
            i = m.start()
            if self._closed(text[i - 1]):
                out.append(text[at:i])
                at = i
        out.append(text[at:])
        return [x for x in out if x]

    def _library(self, fragments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each fragment, encoded on its own."""
        ids, counts = [np.empty(0, np.uint32)], []
        for f in fragments:
            if len(f) > LONG_FRAGMENT or any(a in f for a in self.added):
                got = self.tokenizer.encode(f, add_special_tokens=False).ids
            else:
                got = self.ranked.encode_ordinary(f)
            ids.append(np.array(got, np.uint32))
            counts.append(len(got))
        return np.concatenate(ids), np.array(counts, np.int64)

    def _keep(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Puts fragments into the store; their numbers."""
        base = len(self.frag_len)
        self.frag_start = np.concatenate([self.frag_start, len(self.store) + np.cumsum(counts) - counts])
        self.frag_len = np.concatenate([self.frag_len, counts])
        self.store = np.concatenate([self.store, ids])
        return np.arange(base, base + len(counts))

    def _learn(self, fragments: pa.Array) -> np.ndarray:
        """Adds fragments (large_string) to the store; their numbers. Those without special strings are
        encoded as one string, whose ids fall apart again at the forced boundaries, by byte lengths."""
        odd = pc.greater(pc.utf8_length(fragments), LONG_FRAGMENT)
        for a in self.added:
            odd = pc.or_(odd, pc.match_substring(fragments, a))
        odd = odd.to_numpy(zero_copy_only=False)
        numbers = np.empty(len(fragments), np.int64)
        plain = fragments.filter(pa.array(~odd))
        ids, counts = [], []
        lengths = pc.binary_length(plain).to_numpy()
        for a, b in row_chunks(lengths):
            joined = "".join(plain.slice(a, b - a).to_numpy(zero_copy_only=False))
            own = np.array(self.ranked.encode_ordinary(joined), np.uint32)
            at = np.searchsorted(np.cumsum(self.lengths[own]), np.cumsum(lengths[a:b]), "left") + 1
            ids.append(own)
            counts.append(np.diff(at, prepend=0))
        if ids:
            numbers[~odd] = self._keep(np.concatenate(ids), np.concatenate(counts))
        if odd.any():
            numbers[odd] = self._keep(*self._library(fragments.filter(pa.array(odd)).to_pylist()))
        return numbers

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Store numbers of distinct pieces; -1: not cut safely beside it."""
        if len(self.index) > FRAGMENT_CACHE:
            self._reset()
        pieces = words.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.index.get, pieces, repeat(-2)), np.int64, len(pieces))
        at = np.flatnonzero(numbers == -2)
        if len(at):
            new = words.take(pa.array(at))
            plain = pc.match_substring_regex(new, self.plain).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(~plain).tolist():
                p = pieces[at[i]]
                plain[i] = self._closed(p) and not p[p[0] == "\n":][:1].isspace()
            own = new.filter(pa.array(plain))
            literal = pc.if_else(pc.starts_with(own, "\n"), own, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), own, pa.scalar("", pa.large_string())))
            numbers[at] = -1
            numbers[at[plain]] = self._learn(literal)
            self.index.update(zip(map(pieces.__getitem__, at.tolist()), numbers[at].tolist(), strict=True))
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) one text after the other, and the texts' id counts.

        Texts (large_string without nulls) are cut before every space and line
        feed. A fragment that begins a line keeps its line feed; the text's own
        first fragment is given one, whose id is taken off again. A text in
        which one of these cuts is not safe goes through ``pieces``.
        """
        n = len(texts)
        if not n:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        marked = pc.replace_substring(pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), texts, pa.scalar("", pa.large_string())), "\n", " \n")
        cut = pc.split_pattern(marked, " ")
        ends = cut.offsets.to_numpy()
        words = cut.flatten().dictionary_encode()
        numbers = self._numbers(words.dictionary)[words.indices.to_numpy()]
        begin, end = ends[:-1] - ends[0] + 1, ends[1:] - ends[0]  # what precedes the first line feed is empty
        starts, lens = self.frag_start[numbers], self.frag_len[numbers]
        starts[begin] += 1
        lens[begin] -= 1
        unsafe = np.zeros(len(numbers) + 1, np.int64)
        unsafe[1:] = np.cumsum(numbers < 0)
        slow = np.flatnonzero(unsafe[end] > unsafe[begin])
        lens[begin - 1] = 0
        for i in slow:
            lens[begin[i]:end[i]] = 0
        total = np.zeros(len(lens) + 1, np.int64)
        total[1:] = np.cumsum(lens)
        counts = total[end] - total[begin]
        ids = gather(self.store, starts, lens)
        if len(slow):
            parts, at = [], 0
            places = np.cumsum(counts) - counts  # where the ids of a slow text belong; it has none yet
            known: dict[str, int] = {}
            for i in slow:
                cuts = self.pieces(texts[i].as_py())
                if missing := [p for p in dict.fromkeys(cuts) if p not in known]:
                    known.update(zip(missing, self._keep(*self._library(missing)).tolist(), strict=True))
                got = np.fromiter(map(known.__getitem__, cuts), np.int64, len(cuts))
                made = gather(self.store, self.frag_start[got], self.frag_len[got])
                parts += [ids[at:places[i]], made]
                at, counts[i] = places[i], len(made)
            ids = np.concatenate([*parts, ids[at:]])
        return ids, counts

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; bytes that are not UTF-8 become U+FFFD."""
        raw = gather(self.bytes, self.starts[ids], self.lengths[ids]).tobytes()
        return raw.decode("utf-8", "replace").encode()


def gather(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """values[s:s+n] of every (s, n), one after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - (ends - lens), lens)
    at += np.arange(total)
    return values[at]


_ENCODERS: dict[str, FragmentEncoder] = {}


def encoder(path: str) -> FragmentEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = FragmentEncoder(path)
    return _ENCODERS[path]


def bpe_decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of rows of ids."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            text = [None if x is None else enc.decode(np.array(x, np.int64)).decode() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], ["key", "text"])
    src = only(encoded, key, ids)
    return src.mapInArrow(run, f"key {src.schema[key].dataType.simpleString()}, text string").withColumnRenamed("key", key)


def bpe_encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """(key, n_tokens, ids array<int> or ids_sha256, decoded_sha256) of every
    row: encode, then decode the ids, in one pass. Ids go as little-endian
    32-bit integers into their digest."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for part in text_parts(batches, text, ENCODE_BYTES):
            ids, counts = enc.encode(texts(part, text))
            ends = np.cumsum(counts)
            own = [ids[a:b] for a, b in zip(ends - counts, ends, strict=True)]
            decoded = pa.array([hashlib.sha256(enc.decode(x)).hexdigest() for x in own], pa.string())
            if with_ids:
                col = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(ids.astype(np.int32)))
            else:
                col = pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in own], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), col, decoded], ["key", "n_tokens", "ids", "decoded_sha256"])
    src = only(docs, key, text)
    kind = src.schema[key].dataType.simpleString()
    out = src.mapInArrow(run, f"key {kind}, n_tokens long, ids {'array<int>' if with_ids else 'string'}, decoded_sha256 string")
    return out.withColumnsRenamed({"key": key, "ids": "ids" if with_ids else "ids_sha256"})
