"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import whole

# UTF-8 bytes of texts counted together, and of new pieces handed to one call of the encoder.
BATCH_BYTES = 1 << 20
BLOCK_BYTES = 1 << 14
# Bytes that a worker remembers, an entry taking ENTRY_BYTES besides its piece; it forgets all beyond, which only costs time.
REMEMBERED = 1 << 25
ENTRY_BYTES = 120


def batches_of(texts: Sequence[str], most: int) -> Iterator[Sequence[str]]:
    """The texts in order, in runs that end where they reach ``most`` bytes."""
    ends = list(accumulate(map(len, map(str.encode, texts))))
    at = 0
    while at < len(ends):
        to = bisect_left(ends, most + (ends[at - 1] if at else 0), at) + 1
        yield texts[at:to]
        at = to


class _Counter:
    """Counts tokens by pieces that begin at a safe boundary.

    A single space or line end between two characters that are no white space
    is safe: the encoder's pre-tokens never reach over it from the left, and
    the white space begins the pre-token on its right.  Pieces repeat often,
    so the encoder gets each piece that the worker has not met before, many at
    a time, and texts of any length never reach it as one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        # Known lengths by piece, after a space, after a line end and at a text's start.
        self.known: dict[str, dict[str, int]] = {" ": {}, "\n": {}, "": {}}
        self.size = 0

    @staticmethod
    def _clean(piece: str) -> bool:
        return bool(piece) and not piece[0].isspace() and not piece[-1].isspace()

    def pieces(self, text: str) -> list[tuple[str, list[str]]]:
        """(what stands before, pieces): joined again they give the text."""
        heads, inner = [], []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            heads.append(head)
            inner += rest
        if all(map(self._clean, heads)) and all(map(self._clean, inner)):
            return [("", heads[:1]), ("\n", heads[1:]), (" ", inner)]
        # White space that is not single somewhere: walk the pieces and glue what must stay together.
        out: dict[str, list[str]] = {"": [], "\n": [], " ": []}
        mark, held = "", ""
        for n, line in enumerate(text.split("\n")):
            for m, piece in enumerate(line.split(" ")):
                sep = "" if n == m == 0 else "\n" if m == 0 else " "
                if sep and held and not held[-1].isspace() and piece and not piece[0].isspace():
                    out[mark].append(held)
                    mark, held = sep, piece
                else:
                    held += sep + piece
        out[mark].append(held)
        return list(out.items())

    def lengths(self, texts: list[str]) -> list[int]:
        if self.size > REMEMBERED:
            self.size = 0
            for known in self.known.values():
                known.clear()
        cut = [self.pieces(t) for t in texts]
        for mark, known in self.known.items():
            new = list({p for parts in cut for m, ps in parts if m == mark for p in ps} - known.keys())
            for block in batches_of(new, BLOCK_BYTES):
                for p, e in zip(block, self.encoder.encode_batch_fast([mark + p for p in block], add_special_tokens=False)):
                    known[p] = len(e)
            self.size += sum(map(len, map(str.encode, new))) + ENTRY_BYTES * len(new)
        return [sum(sum(map(self.known[m].__getitem__, ps)) for m, ps in parts) for parts in cut]


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """docs with the number of tokens of each whole text, a null text counting as empty.

    Every row keeps its own count, repeated rows and rows without an id too; an
    existing column of the name ``out`` is replaced.  The path must be readable
    on the executors.  Nothing is shuffled: scan tasks are balanced by bytes,
    and within a task the encoder's batches are cut by bytes.
    """

    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _Counter(tokenizer_path)
        for batch in batches:
            counts = [n for texts in batches_of(batch.tolist(), BATCH_BYTES) for n in counter.lengths(texts)]
            yield pd.Series(counts, dtype="int64")

    return docs.withColumn(out, lengths(whole(text)))
