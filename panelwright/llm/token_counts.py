"""Token counts by the whole-token shortcut, for tokenizers that merge inside words with a word-end mark.

Offline, on the driver, every vocabulary string is tried: those that are one pre-token and encode alone as one
token form the proven set (at most the vocabulary, so it is sent to all tasks). Online, a pre-token of that set
counts one; only the rest is merged, each distinct one once while it stays in a worker's bounded cache.

Null text counts as empty: no bytes, no tokens. Rows are independent, so ties, repeats and order play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .shared import raw_texts, worker_cache

#: The tokenizer file's own pre-token pattern (fixed values).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Up to here, case and normal forms are the same in every edition of Unicode and no marks combine.
PLAIN = regex.compile("[^\x00-ɏ]")
CACHE = 300_000
END = "</w>"
COUNTS_T = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(extra)) for b in range(256)]


LETTERS = byte_letters()
BYTES = {letter: b for b, letter in enumerate(LETTERS)}


def spelled(piece: str) -> str:
    return "".join(map(LETTERS.__getitem__, piece.encode()))


class Pieces:
    """Pre-tokens of a text and how many tokens each makes."""

    def __init__(self, definition: str, proven: frozenset[str] = frozenset()):
        self.library = Tokenizer.from_str(definition)
        self.pattern = regex.compile(PIECES)
        self.special = regex.compile("|".join(map(regex.escape, sorted((t.content for t in self.library.get_added_tokens_decoder().values()), key=len, reverse=True))) or r"(?!)")
        self.proven = proven
        self.size: dict[str, int] = {}

    def of(self, text: str) -> list[str]:
        if not PLAIN.search(text):
            return self.pattern.findall(text.lower())
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(BYTES.__getitem__, p)).decode() for p, _ in pieces]

    def merged(self, piece: str) -> int:
        return len(self.library.model.tokenize(spelled(piece)))

    def count(self, text: str) -> int:
        special = self.special.findall(text) if "<" in text else ()
        total = len(special)
        for part in self.special.split(text) if special else (text,):
            pieces = self.of(part)
            proven, size = self.proven, self.size
            rest = [p for p in pieces if p not in proven]
            total += len(pieces) - len(rest)
            for p in rest:
                n = size.get(p)
                if n is None:
                    n = size[p] = self.merged(p)
                total += n
        if len(self.size) > CACHE:
            self.size = {}
        return total


def prove(definition: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and alone make exactly their own token."""
    pieces = Pieces(definition)
    out = set()
    for token in pieces.library.get_vocab(with_added_tokens=False):
        if token.endswith(END) and all(c in BYTES for c in token[: -len(END)]):
            try:
                text = bytes(BYTES[c] for c in token[: -len(END)]).decode()
            except UnicodeDecodeError:
                continue
            if text and pieces.of(text) == [text] and [t.value for t in pieces.library.model.tokenize(spelled(text))] == [token]:
                out.add(text)
    return frozenset(out)


def token_counts(docs: DataFrame, definition: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of ``docs`` (doc_id, text); ``definition`` is the tokenizer file's
    content."""
    shared = docs.sparkSession.sparkContext.broadcast((definition, prove(definition)))

    def run(batches):
        cache = worker_cache()
        if cache.get("pieces_of") != definition_hash:
            cache["pieces_of"], cache["pieces"] = definition_hash, Pieces(*shared.value)
        pieces = cache["pieces"]
        for b in batches:
            texts = raw_texts(b)
            counts = np.fromiter((pieces.count(t.decode()) for t in texts), np.int64, len(texts))
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(sizes), pa.array(counts)], schema=COUNTS_T)

    definition_hash = hash(definition)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
