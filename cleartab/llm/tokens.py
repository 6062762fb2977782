"""Token ids of whole texts with a public byte-level vocabulary."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

SEPARATOR = 1
VOCABULARY = "byte_bpe_50k"
MEMO_ENTRIES = 300_000
"""Words whose ids a task remembers; past that it forgets all and starts again. Results do not depend on it."""


def encoder(vocabulary: str = VOCABULARY, entries: int = MEMO_ENTRIES) -> Callable[[str | None], np.ndarray]:
    """A function from text to its ids, followed by the separator. A null text is empty.

    The vocabulary's pre-tokenizer never joins anything across a space that is
    followed by a visible character. Texts are cut there, and the ids of each
    piece are remembered as bytes, so most words cost one look-up. Texts where
    a space meets other blanks are encoded whole.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    bpe = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def raw(text: str) -> bytes:
        return np.array(bpe.encode_ordinary(text), dtype="<u4").tobytes()

    class Memo(dict):
        def __missing__(self, word: str) -> bytes:
            if not word or word[0].isspace():
                raise LookupError
            ids = raw(" " + word)
            if len(self) >= entries:
                self.clear()
            self[word] = ids
            return ids

    memo = Memo()
    end = np.array([SEPARATOR], dtype="<u4").tobytes()

    def encode(text: str | None) -> np.ndarray:
        first, *rest = (text or "").split(" ")
        try:
            whole = raw(first) + b"".join(map(memo.__getitem__, rest))
        except LookupError:
            whole = raw(text)
        return np.frombuffer(whole + end, dtype="<u4")

    return encode


def encoded_batches(batches, entries: int = MEMO_ENTRIES):
    """(doc_id, ids) of Arrow batches with columns doc_id and text."""
    encode = encoder(entries=entries)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield doc_id, encode(text.as_py())


def id_and_text(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text")
