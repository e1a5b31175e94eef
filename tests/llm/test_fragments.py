"""Fragments of texts, learned in bulk."""
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from hostelry.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_new_fragments_are_encoded_together():
    """One call for a megabyte of new fragments; odd ones still on their own."""
    tokenizer = Tokenizer.from_file(PATH)
    enc, calls = bpe.FragmentEncoder(PATH), []

    class Counted:
        def encode_ordinary(self, text, own=enc.ranked):
            calls.append(text)
            return own.encode_ordinary(text)
    enc.ranked = Counted()
    odd = ["", " ", "\n", "\n\n x", "\u00a0a b\u00a0 c", "\u00e9t\u00e9 \u00e9 \u65e5\u672c \u3000x", "a<|endoftext|> b <|endoftext|>", "\u2028a \u2028 a\n\u2028b", "x\ty  z", "end \n"]
    every = [" ".join(f"w{i}" for i in range(20000)), *odd, "\n".join(f"v{i}" for i in range(3000))]
    for texts in (every, every[::-1]):  # learned, then known
        ids, counts = enc.encode(pa.array(texts, pa.large_string()))
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert sum(len(c) > 1000 for c in calls) == 1 and len(calls) < 100
