"""Byte-level BPE encoding and decoding (operator 9).

A text is cut by the tokenizer's pattern; each match is encoded by itself. A
match that is a token is that token. Any other match is encoded in linear time
by backtracking: an Aho-Corasick automaton over all tokens (bytes mapped to
Latin-1 characters) gives the longest token at every position; the encoder takes
it if it may follow the previous token, else the next shorter token that is a
prefix of it, and steps back when none is left. Two tokens may stand side by
side exactly if BPE, undoing their merges step by step, would at no point have
merged across the border first; that verdict is memoised per pair. As every
prefix of a BPE encoding is the encoding of that prefix, the result is the one
that merging by rank gives.

The automaton holds only tokens that merging by rank itself produces; a rank
file whose tokens do not build on lower ranks is refused.

Workers remember the ids of a bounded number of matches. Whole texts are
encoded; null is an empty text. A repeated row is encoded as often as it occurs;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Matches (of at most ``SHORT`` bytes) and pairs that a worker remembers.
REMEMBERED = 300_000
SHORT = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {i: t for t, i in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"{len(missing)} single bytes have no rank")
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.parts[rank] = (rank, rank)
                continue
            halves = self._merge(token, rank)
            if len(halves) != 2:
                continue  # never made by merging: only a whole match is this token
            left, right = ranks[halves[0]], ranks[halves[1]]
            if max(left, right) >= rank:
                raise ValueError(f"token {rank} does not build on lower ranks")
            self.parts[rank] = (left, right)
            self.merged[left, right] = rank
        self.automaton = ahocorasick.Automaton()
        for i in self.parts:
            self.automaton.add_word(self.bytes_of[i].decode("latin-1"), (len(self.bytes_of[i]), i))
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        for i in self.parts:
            t = self.bytes_of[i]
            for n in range(len(t) - 1, 0, -1):
                if (p := ranks.get(t[:n])) is not None and p in self.parts:
                    self.shorter[i] = p
                    break
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}

    def _merge(self, token: bytes, below: int) -> list[bytes]:
        """The token's bytes merged by the ranks under ``below``."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, at = min(
                (self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
            )
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether BPE can leave ``left`` and ``right`` next to each other."""
        got = self.fits.get((left, right))
        if got is None:
            if len(self.fits) >= REMEMBERED:
                self.fits.clear()
            got = self.fits[left, right] = self._undo(left, right)
        return got

    def _undo(self, left: int, right: int) -> bool:
        """Undo merges from the latest to the first; a merge across the border
        that ranks before those still to be undone would have come first."""
        bound = None  # rank of the merge undone last
        while True:
            across = self.merged.get((left, right))
            if across is not None and (bound is None or across < bound[0] or (across == bound[0] and bound[1])):
                return False
            whole_left, whole_right = self.parts[left][0] == left, self.parts[right][0] == right
            if whole_left and whole_right:
                return True
            # Equal merges go from left to right: one in the left token comes
            # before the one across, one in the right token after it.
            if whole_right or (not whole_left and left > right):
                bound, left = (left, False), self.parts[left][1]
            else:
                bound, right = (right, True), self.parts[right][0]

    def encode_bytes(self, piece: bytes) -> list[int]:
        """The merges of one match that is no token itself."""
        end = len(piece)
        longest = [-1] * end
        for last, (n, token) in self.automaton.iter(piece.decode("latin-1")):
            at = last - n + 1
            if longest[at] < 0 or len(self.bytes_of[longest[at]]) < n:
                longest[at] = token
        size = self.bytes_of
        open_at = bytearray(b"\1") * (end + 1)  # positions not yet proven dead ends
        out: list[int] = []
        at, token = 0, longest[0]
        while at < end:
            stop = at + len(size[token])
            if open_at[stop] and (not out or self.side_by_side(out[-1], token)):
                out.append(token)
                at = stop
                token = longest[at] if at < end else -1
            elif token in self.shorter:
                token = self.shorter[token]
            else:
                open_at[at] = 0
                token = out.pop()
                at -= len(size[token])
                # the popped token was the choice here; its end is now closed
        return out

    def encode_match(self, match: str) -> tuple[int, ...]:
        piece = match.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(piece)
        ids = (whole,) if whole is not None else tuple(self.encode_bytes(piece))
        if len(piece) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[match] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        known, encode = self.known.get, self.encode_match
        for m in self.pattern.findall(text or ""):
            out += known(m) or encode(m)
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec a worker process and rank file."""
    return Codec(read_ranks(path), pattern)


def bpe(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    keep_ids: bool = True,
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, with the
    ids themselves (``ids``, array of int) and the ``decoded`` bytes if
    ``keep_ids``."""
    path = path or public_tokenizers.path(RANKS)
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        fields += ", ids array<int>, decoded binary"

    @F.pandas_udf(fields)
    def of(texts: pd.Series) -> pd.DataFrame:
        c = codec(path, pattern)
        rows = []
        for t in texts:
            ids = np.array(c.encode(t), "<u4")
            back = c.decode(ids.tolist())
            row = [len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back).hexdigest()]
            rows.append(row + [ids.astype(np.int32), back] if keep_ids else row)
        return pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])

    return docs.select(col(doc_id).alias("doc_id"), of(col(text)).alias("r")).select("doc_id", "r.*")


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Query: token counts and digests of every document."""
    return bpe(table(spark, sf_dir, "documents"), keep_ids=False)
