"""Token counts of a byte-level BPE vocabulary, without making identifiers.

A text is cut at the vocabulary's special strings, then into pieces by the
public pattern.  Each piece starts as one symbol per byte in a doubly linked
list; a heap holds the rank of every adjacent pair that can merge.  Popping
the lowest rank (leftmost first) merges one pair and offers at most two new
ones, so a piece of n bytes costs O(n log n) whatever its length, and its
tokens are its bytes minus its merges.  Counts of short pieces are remembered
per worker in a table of bounded size.
"""

from __future__ import annotations

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pattern of the vocabulary, and its names of the 256 bytes
# (printable Latin-1 stands for itself, the others follow from U+0100).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

LIMIT = 512
REMEMBERED = 1 << 18
REMEMBERED_CHARS = 64


def byte_names() -> dict[int, str]:
    shown = set(PRINTABLE)
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Memory(dict):
    """Piece to token count; forgets everything when full."""

    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, piece: str) -> int:
        n = self.count(piece)
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n


class PieceCounter:
    """Counts tokens of a vocabulary in the ``tokenizers`` JSON format."""

    def __init__(self, vocabulary: bytes):
        spec = json.loads(vocabulary)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space")
                or spec.get("normalizer") or model.get("ignore_merges") or model.get("dropout")):
            raise ValueError("not a plain byte-level BPE vocabulary")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {tuple(p): rank for rank, p in enumerate(pairs)}
        self.names = byte_names()
        added = spec.get("added_tokens") or []
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError("special strings with stripping are not supported")
        strings = sorted((a["content"] for a in added if a["content"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, strings))) if strings else None
        self.pattern = regex.compile(PATTERN)
        # The pattern's classes depend on the Unicode version from U+0530 on:
        # there the vocabulary's own library cuts the pieces.
        self.newer = regex.compile("[^\\x00-\\u052F]")
        self._vocabulary = vocabulary
        self._library = None
        self.memory = _Memory(self.count_piece)

    def count_piece(self, piece: str) -> int:
        """Symbols left when no adjacent pair can merge any more."""
        symbols: list = [self.names[b] for b in piece.encode("utf-8")]
        n = left = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if symbols[i] is None or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
                continue  # one of the two has merged meanwhile
            symbols[i] += symbols[j]
            symbols[j] = None
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                    heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
                heappush(heap, (r, h))
        return left

    def _pieces(self, text: str) -> list[str]:
        if self.newer.search(text) is None:
            return self.pattern.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self._vocabulary.decode("utf-8")).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def count(self, text: str) -> int:
        total, parts = 0, [text]
        if self.special is not None:
            parts = self.special.split(text)
            total = len(parts) - 1
        return total + sum(sum(map(self.memory.__getitem__, self._pieces(p))) for p in parts if p)


@lru_cache(maxsize=4)
def _counter(vocabulary: bytes) -> PieceCounter:
    return PieceCounter(vocabulary)


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """One row per input row: the id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``n_tokens`` is what the ``tokenizers`` library gives for the whole text
    with the byte-level BPE file at ``vocabulary_path``, with no begin, end
    or template tokens; special strings inside a text count as one token.
    ``over_limit`` is ``n_tokens > limit``.  Null and empty texts have 0
    tokens; repeated rows and null ids are rows like any other.  The file is
    read once on the driver and sent to the tasks (its size is fixed, it does
    not grow with the documents).
    """
    with open(vocabulary_path, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        count = _counter(shipped.value).count
        for b in batches:
            n = [count(t) if t else 0 for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("n_bytes"), pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return (slim.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
