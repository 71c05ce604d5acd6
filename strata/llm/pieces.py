"""SentencePiece BPE encoding and decoding by a table of distinct chunks (operator 11).

White space is marked: a text gets a leading marker ``▁`` and each of its spaces
becomes one. If no piece of the model holds a marker behind another character,
no merge can cross from a character to a following marker, so a text falls into
chunks (markers and the characters up to the next marker) that are encoded
independently. Words recur: a chunk table holds every distinct chunk once, with
its ids; a text is the list of its chunks, and its ids are the table's entries
joined by position. An entry is made once: the chunk is segmented, its ids are
decoded, and the table notes whether they give the chunk back. Decoded texts are
joined by position likewise, from the chunks whose ids give them back and from
what the ids of the others decode to.

A chunk is cut once more before it is segmented, where no piece has the two
characters side by side: characters that are neighbours in any piece make classes,
and a run of one class (with the markers before it) is a part. Parts have a table
of their own, so ``word``, ``word,`` and ``word.`` are segmented once.

A part is segmented by merging: of all neighbours whose concatenation is a
piece, the pair with the highest score (leftmost of equals) is merged first. Words
look for it in a short list of scores; a part over ``SHORT`` characters takes it
from a heap, so a long run without white space takes n log n. What is no piece in
the end falls back to its UTF-8 bytes.

Where pieces do cross markers (another model), a chunk is the whole text; the
table then holds distinct texts. Models are refused with ``ValueError`` where this
encoder could differ from the library: no byte fallback, unused or
user-defined pieces, a normalizer that changes text, no leading
marker.

The table is a worker's own: distinct words of all texts have no bound, and a
shuffle of every word to look it up costs more than segmenting the frequent ones
once a worker. It is bounded: beyond ``ENTRIES`` entries or ``CHARS`` characters
the chunks that were not asked for since the last time go. That changes no result.

Defined results: null is an empty text, and an empty text has no ids; whole texts
are encoded, however long; a literal ``▁`` counts as a marker, as in the library,
and decodes to a space; a repeated row is encoded as often as it occurs; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Entries and characters of each of the two halves of a worker's chunk table.
ENTRIES = 200_000
CHARS = 4_000_000
#: Characters of a chunk that is segmented without a heap.
SHORT = 40
_NONE = float("-inf")
#: Texts that a usable normalizer only marks.
_PROBES = ("a", " a  b ", "\ta\r\n", "ﬁ Ａ é   　", "İÅ")


def _one_by_one(error: UnicodeError):
    """Every byte that is no part of a character becomes U+FFFD by itself."""
    return "�", error.start + 1


codecs.register_error("strata-bytewise", _one_by_one)


def mark(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


class Model:
    """Pieces and scores of one model file, and the table of known chunks."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        special = {i for i in ids if sp.is_control(i) or sp.is_unknown(i)}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.pieces: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        for i in ids:
            if i not in special and not sp.is_byte(i):
                piece = sp.id_to_piece(i)
                self.pieces[piece], self.scores[piece] = i, sp.get_score(i)
        if not all(sp.is_byte(i) for i in self.byte_ids):
            raise ValueError("the model has no byte fallback")
        if any(sp.is_unused(i) for i in ids):
            raise ValueError("the model has unused pieces")
        if sum(s >= 0 for s in self.scores.values()) > 1:  # they are never split
            raise ValueError("the model has user-defined pieces")
        if any(sp.normalize(t) != mark(t) for t in _PROBES):
            raise ValueError("the model's normalizer does more than mark white space")
        value = {i: b for b, i in enumerate(self.byte_ids)}
        #: What an id decodes to: bytes of a character, or text.
        self.byte_of = {i: bytes([b]) for i, b in value.items()}
        self.text_of = {i: p.replace(MARK, " ") for p, i in self.pieces.items()}
        self.text_of |= {i: "" for i in special}
        self.text_of[sp.unk_id()] = sp.decode([sp.unk_id()])
        self.decimal = [str(i) for i in ids]
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            self.chunks = self.parts = re.compile("(?s:.+)").findall
        else:
            self.chunks = re.compile(f"{MARK}+[^{MARK}]*").findall
            self.parts = re.compile(f"{MARK}*(?:{self._classes()}[^{MARK}])|{MARK}+").findall
        self.begin()

    def _classes(self) -> str:
        """Alternatives for runs of characters that pieces have side by side."""
        root: dict[str, str] = {}

        def find(c: str) -> str:
            while root.setdefault(c, c) != c:
                root[c] = c = root[root[c]]
            return c

        for piece in self.pieces:
            bare = piece.lstrip(MARK)
            for a, b in zip(bare, bare[1:]):
                root[find(a)] = find(b)
        members: dict[str, list[str]] = {}
        for c in root:
            members.setdefault(find(c), []).append(c)
        return "".join(f"[{''.join(map(re.escape, sorted(m)))}]+|" for _, m in sorted(members.items()))

    def begin(self) -> None:
        """Empty tables of chunks and parts (entries in use, and older ones), and
        the chunks whose ids decode to something else."""
        self.known: dict[str, str] = {}
        self.older = self.known
        self.known_parts: dict[str, tuple[int, ...]] = {}
        self.odd: set[str] = set()
        self.chars = 0

    def ids_of(self, chunk: str) -> list[int]:
        """The ids of one chunk."""
        out: list[int] = []
        known = self.known_parts
        for part in self.parts(chunk):
            ids = known.get(part)
            if ids is None:
                if len(known) >= ENTRIES:
                    known.clear()
                ids = self.segment(part)
                if len(part) <= SHORT:
                    known[part] = tuple(ids)
            out += ids
        return out

    def segment(self, part: str) -> list[int]:
        """The ids of one part, by merging."""
        symbols = self._merged_word(part) if len(part) <= SHORT else self._merged(part)
        try:
            return [self.pieces[s] for s in symbols]
        except KeyError:  # some of them fall back to bytes
            pass
        out: list[int] = []
        for s in symbols:
            i = self.pieces.get(s)
            if i is None:
                out.extend(self.byte_ids[b] for b in s.encode("utf-8", "surrogatepass"))
            else:
                out.append(i)
        return out

    def _merged_word(self, part: str) -> list[str]:
        """The symbols of a short part after all merges."""
        symbols, score = list(part), self.scores.get
        scores = [score(a + b, _NONE) for a, b in zip(symbols, symbols[1:])]
        while scores and (best := max(scores)) > _NONE:
            at = scores.index(best)
            pair = symbols[at] = symbols[at] + symbols.pop(at + 1)
            del scores[at]
            if at:
                scores[at - 1] = score(symbols[at - 1] + pair, _NONE)
            if at < len(scores):
                scores[at] = score(pair + symbols[at + 1], _NONE)
        return symbols

    def _merged(self, part: str) -> list[str]:
        """The symbols of a part of any length after all merges."""
        symbols, scores, n = list(part), self.scores, len(part)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []

        def offer(left: int) -> None:
            pair = symbols[left] + symbols[after[left]]
            score = scores.get(pair)
            if score is not None:
                heapq.heappush(heap, (-score, left, pair))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, left, pair = heapq.heappop(heap)
            right = after[left]
            # a merge of either side since then leaves another text here
            if not symbols[left] or right >= n or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [s for s in symbols if s]

    def decode_marked(self, ids) -> str:
        """The text of ``ids`` with the leading marker's space."""
        try:
            return "".join([self.text_of[i] for i in ids])
        except KeyError:  # bytes of characters among them
            pass
        parts: list[str] = []
        run: list[bytes] = []
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                parts.append(b"".join(run).decode("utf-8", "strata-bytewise"))
                run.clear()
            parts.append(self.text_of[i])
        if run:
            parts.append(b"".join(run).decode("utf-8", "strata-bytewise"))
        return "".join(parts)

    def decode(self, ids) -> str:
        """What the library's ``decode`` gives for a list of ids that this
        encoder makes."""
        return self.decode_marked(ids).removeprefix(" ")

    def look_up(self, text: str) -> tuple[str, str]:
        """The ids of ``text`` as decimals joined by commas, and the text they
        decode to, both from the table's entries for its chunks in order."""
        marked = mark(text)
        chunks = self.chunks(marked)
        known = self.known
        for chunk in set(chunks).difference(known):
            entry = self.older.get(chunk)
            if entry is None:
                ids = self.ids_of(chunk)
                entry = ",".join([self.decimal[i] for i in ids])
                if self.decode_marked(ids) != chunk.replace(MARK, " "):
                    self.odd.add(chunk)
            known[chunk] = entry
            self.chars += len(chunk)
        decimals = ",".join(map(known.__getitem__, chunks))
        if self.odd and not self.odd.isdisjoint(chunks):
            back = "".join(
                self.decode_marked(map(int, known[c].split(","))) if c in self.odd else c.replace(MARK, " ") for c in chunks
            )
        else:
            back = marked.replace(MARK, " ")
        if len(known) > ENTRIES or self.chars > CHARS:
            self.older, self.known, self.chars = known, {}, 0
            self.odd.intersection_update(known)
        return decimals, back.removeprefix(" ")

    def encode(self, text: str | None) -> list[int]:
        decimals, _ = self.look_up(text or "")
        return [int(i) for i in decimals.split(",")] if decimals else []


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """One model and chunk table a worker process and file."""
    return Model(path)


def encode_pieces(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    keep_ids: bool = True,
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, with the
    ids themselves (``ids``, array of int) and the ``decoded`` text if
    ``keep_ids``. The digests are of the ids' decimals joined by commas and of the
    decoded text in UTF-8."""
    path = path or public_tokenizers.path(MODEL)
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        fields += ", ids array<int>, decoded string"

    @F.pandas_udf(fields)
    def of(texts: pd.Series) -> pd.DataFrame:
        m = model(path)
        rows = []
        for t in texts:
            decimals, back = m.look_up(t or "")
            row = [
                decimals.count(",") + 1 if decimals else 0,
                hashlib.sha256(decimals.encode()).hexdigest(),
                hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(),
            ]
            if keep_ids:
                row += [np.array(decimals.split(",") if decimals else [], np.int32), back]
            rows.append(row)
        return pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])

    return docs.select(col(doc_id).alias("doc_id"), of(col(text)).alias("r")).select("doc_id", "r.*")


def op11_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Query: token counts and digests of every document."""
    return encode_pieces(table(spark, sf_dir, "documents"), keep_ids=False)
