"""Token counts by a unigram model (operator 4).

A text's best segmentation is the one whose pieces' scores add up highest. Pieces
never run from a letter into a space sign, so the text falls into pre-tokens
(space signs and what follows up to the next) that are segmented by themselves.

A worker keeps the distinct pre-tokens in a trie. A node holds the best score and
its number of tokens for the string from the root to it: the forward step of the
dynamic programme, taken once for all pre-tokens that share the prefix. The
count at a pre-token's last node is stored; a text's count is the sum over its
pre-tokens. Trie and counts are bounded and start anew when full; pre-tokens
beyond ``DEEP`` characters run through the same steps without entering the trie.

The model is a SentencePiece file, a parameter: its pieces and scores are used as
they stand. A character that no piece covers counts as its UTF-8 bytes (byte
fallback). Ties go to the longer last piece.

Defined results: a null or empty text has no tokens; whole texts are counted;
repeated rows and null ids are counted as they come; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, table

MODEL = "piece_bpe_32k.model"
SPACE_SIGN = "▁"
#: Nodes of the trie, and pre-tokens with their counts, that a worker keeps.
NODES = 400_000
REMEMBERED = 400_000
DEEP = 256
_PRE_TOKEN = re.compile(f"{SPACE_SIGN}*[^{SPACE_SIGN}]+|{SPACE_SIGN}+")


def pre_tokens(text: str | None) -> list[str]:
    if not text:
        return []
    return _PRE_TOKEN.findall(SPACE_SIGN + text.replace(" ", SPACE_SIGN))


class Counter:
    """Counts tokens with one model's pieces (``{piece: score}``)."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        #: lengths of the pieces that end in two given characters, longest first
        self.lengths: dict[str, list[int]] = {}
        for n, tail in sorted({(len(p), p[-2:]) for p in scores if len(p) > 1}, reverse=True):
            self.lengths.setdefault(tail, []).append(n)
        self.unknown = min(scores.values(), default=0.0) - 10
        self._clear()
        self.counts: dict[str, int] = {}

    def _clear(self):
        self.next: list[dict[str, int]] = [{}]
        self.best: list[float] = [0.0]
        self.tokens: list[int] = [0]

    def _forward(self, s: str, end: int, best: list[float], tokens: list[int]) -> tuple[float, int]:
        """Best score and tokens of ``s[:end]`` from those of its prefixes."""
        top, n = None, 0
        score = self.scores.get
        for length in self.lengths.get(s[end - 2 : end], ()) if end > 1 else ():
            start = end - length
            if start >= 0 and (p := score(s[start:end])) is not None:
                total = best[start] + p
                if top is None or total > top:
                    top, n = total, tokens[start] + 1
        c = s[end - 1]
        p = score(c)
        total = best[end - 1] + (self.unknown if p is None else p)
        if top is None or total > top:
            top, n = total, tokens[end - 1] + (len(c.encode("utf-8", "surrogatepass")) if p is None else 1)
        return top, n

    def count(self, pre_token: str) -> int:
        if len(pre_token) > DEEP:
            best, tokens = [0.0], [0]
            for end in range(1, len(pre_token) + 1):
                b, t = self._forward(pre_token, end, best, tokens)
                best.append(b)
                tokens.append(t)
            return tokens[-1]
        if len(self.best) > NODES:
            self._clear()
        if len(self.counts) >= REMEMBERED:
            self.counts.clear()
        node, best, tokens = 0, [0.0], [0]
        for end, c in enumerate(pre_token, 1):
            child = self.next[node].get(c)
            if child is None:
                b, t = self._forward(pre_token, end, best, tokens)
                child = self.next[node][c] = len(self.best)
                self.next.append({})
                self.best.append(b)
                self.tokens.append(t)
            node = child
            best.append(self.best[node])
            tokens.append(self.tokens[node])
        self.counts[pre_token] = tokens[-1]
        return tokens[-1]

    def count_text(self, text: str | None) -> tuple[int, int]:
        """Pre-tokens and tokens of a text."""
        known, count = self.counts.get, self.count
        parts = pre_tokens(text)
        return len(parts), sum(known(p) or count(p) for p in parts)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter a worker process and model."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = (i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return Counter({model.id_to_piece(i): model.get_score(i) for i in plain})


def token_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, n_pre_tokens, n_tokens`` of every row of ``docs``."""
    path = path or public_tokenizers.path(MODEL)

    @F.pandas_udf("n_pre_tokens long, n_tokens long")
    def of(texts: pd.Series) -> pd.DataFrame:
        c = counter(path)
        return pd.DataFrame([c.count_text(t) for t in texts], columns=["n_pre_tokens", "n_tokens"], dtype="int64")

    return docs.select(col(doc_id).alias("doc_id"), of(col(text)).alias("r")).select("doc_id", "r.*")


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    """Query: token counts of every document."""
    return token_counts(table(spark, sf_dir, "documents"))
