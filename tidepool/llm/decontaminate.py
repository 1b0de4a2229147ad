"""Benchmark items inside documents, up to a bounded number of edits.

An item of m characters may differ by ``floor(rate * m)`` edits.  Cut into
one piece more than that, at least one piece must stand unchanged in any
match, so: find every exact piece hit of every item in one pass over the
document (Aho-Corasick), merge hits on neighbouring diagonals into windows,
and let Myers' bit-parallel algorithm decide each window.  Nothing is
sampled or cut: all pieces of all items, whole documents.

Scale: documents are never shuffled; items are dealt into blocks of bounded
text size, each a pass over the documents, so no task holds more than a block
of items and a batch of texts.
"""

from __future__ import annotations

from functools import reduce

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, unused

ERROR_RATE = 0.08
MIN_CHARS = 1
WORD_CHARS = 12  # the filter stage counts items of up to so many characters only where they stand as whole words
BLOCK_CHARS = 1 << 20
_IN_WORD = regex.compile(r"[[\p{L}\p{M}\p{N}]--[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]]",
                         regex.V1)  # not of scripts that write words without blanks


def normalise(text: str | None) -> str:
    """Lower case, white space runs as one blank, none at the ends."""
    return " ".join(text.lower().split()) if text else ""


def myers_best(pattern_bits: dict[str, int], m: int, text: str) -> int:
    """Smallest edit distance of the pattern to any substring of ``text``."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    get = pattern_bits.get
    for ch in text:
        eq = get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best = score
                if not best:
                    return 0
        ph <<= 1  # a match may start anywhere: no carry into row 0
        pv = ((mh << 1) | ~(xv | ph)) & full
        mv = ph & xv & full
    return best


def _whole(text: str, lo: int, hi: int) -> bool:
    """No word of ``text`` goes on over an end of ``text[lo:hi]``."""
    return not any(0 < at < len(text) and _IN_WORD.match(text[at - 1]) and _IN_WORD.match(text[at]) for at in (lo, hi))


def _stands_whole(text: str, item: str) -> bool:
    """Some occurrence of ``item`` cuts no word."""
    at = text.find(item)
    while at >= 0:
        if _whole(text, at, at + len(item)):
            return True
        at = text.find(item, at + 1)
    return False


class ItemMatcher:
    """Finds all items of one block in a text."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            m, k = len(text), int(rate * len(text))
            bits: dict[str, int] = {}
            for i, ch in enumerate(text):
                bits[ch] = bits.get(ch, 0) | (1 << i)
            for j in range(k + 1):
                a, z = j * m // (k + 1), (j + 1) * m // (k + 1)
                pieces.setdefault(text[a:z], []).append((len(self.items), a))
            self.items.append((item_id, text, m, k, bits))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if self.items:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple]:
        """(item id, smallest distance, item characters, whole word) of every item within its budget."""
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = {}
        exact: dict[int, bool] = {}  # items without a budget: does one stand as whole words
        for end, (size, owners) in self.automaton.iter(text):
            for item, offset in owners:
                if self.items[item][3]:
                    starts.setdefault(item, set()).add(end - size + 1 - offset)
                elif not exact.get(item):
                    exact[item] = _whole(text, end - size + 1, end + 1)
        found = [(self.items[item][0], 0, self.items[item][2], whole) for item, whole in exact.items()]
        for item, at in starts.items():
            item_id, whole, m, k, bits = self.items[item]
            best = k + 1
            for lo, hi in _windows(sorted(at), k):
                window = text[max(0, lo - k):hi + m + k]
                best = min(best, 0 if whole in window else myers_best(bits, m, window))
                if not best:
                    break
            if best <= k:
                found.append((item_id, best, m, None if best else _stands_whole(text, whole)))
        return sorted(found, key=lambda f: (f[0] is None, f[0]))


def _windows(starts: list[int], k: int):
    """Diagonals no more than k apart share a window: (first, last start)."""
    lo = hi = starts[0]
    for s in starts[1:]:
        if s - hi > k:
            yield lo, hi
            lo = s
        hi = s
    yield lo, hi


_MATCHERS: dict[int, ItemMatcher] = {}


def _leaks_of(shipped, rate: float, id_type: str):
    """A column function for one block of items."""
    @F.pandas_udf(f"array<struct<item_id: {id_type}, distance: int, item_chars: int, whole_word: boolean>>")
    def leaks(texts: pd.Series) -> pd.Series:
        key = shipped.id if hasattr(shipped, "id") else id(shipped)
        if key not in _MATCHERS:
            _MATCHERS.clear()
            _MATCHERS[key] = ItemMatcher(shipped.value, rate)
        find = _MATCHERS[key].find
        return pd.Series([[{"item_id": i, "distance": d, "item_chars": m, "whole_word": w} for i, d, m, w in find(normalise(t))]
                          for t in texts], dtype=object)

    return leaks


def _blocks(items: DataFrame, item_id: str, item_text: str, min_chars: int):
    """Normalised items, in blocks of about ``BLOCK_CHARS`` characters."""
    block, size = [], 0
    for r in items.select(F.col(item_id), F.col(item_text)).orderBy(item_id).toLocalIterator():
        text = normalise(r[1])
        if len(text) < min_chars:
            continue
        block.append((r[0], text))
        size += len(text)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def leak_columns(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text", rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> list[Column]:
    """One array column of leaks per block of items, to select from ``docs``."""
    sc = docs.sparkSession.sparkContext
    id_type = items.schema[item_id].dataType.simpleString()
    return [_leaks_of(sc.broadcast(block), rate, id_type)(F.col(text_col)) for block in _blocks(items, item_id, item_text, min_chars)]


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE,
               min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document row and benchmark item that it contains.

    Columns: the id, ``item_id`` (of any type that sorts), ``distance``
    (smallest edit distance of the normalised item to any substring of the
    normalised text, at most ``floor(rate * item_chars)``), ``item_chars`` and
    ``whole_word``: whether an exact occurrence cuts no word at its ends
    (letters and digits of scripts written with blanks do not go on over them),
    null for an inexact one.  Both sides are lower-cased with white space
    collapsed; items of every length are found by the same rule.  Empty items,
    and those shorter than ``min_chars`` where a caller sets it, match nothing;
    null or empty texts contain nothing.  Items with a null id are found like
    others.  Repeated document or item rows give repeated result rows; equal
    items with two ids give one row each.
    """
    schema = (f"{id_col} {docs.schema[id_col].dataType.simpleString()}, item_id {items.schema[item_id].dataType.simpleString()}, "
              "distance int, item_chars int, whole_word boolean")
    cols = leak_columns(docs, items, text_col, item_id, item_text, rate, min_chars)
    found = [docs.select(F.col(id_col), F.explode(c).alias("leak")).select(id_col, "leak.*") for c in cols]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    if len(found) > 1:  # one pass over the documents per block
        found = [materialize(f, "leaks") for f in found]
    return reduce(DataFrame.unionByName, found)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", rate: float = ERROR_RATE,
                      min_chars: int = MIN_CHARS, word_chars: int = WORD_CHARS) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item; columns as given.

    An item of up to ``word_chars`` characters counts only where it stands as
    whole words, so that a short word among the items does not take every text
    that holds its letters; 0 counts every occurrence."""
    out, name = docs, unused(docs, "leaks")
    for c in leak_columns(docs, items, text_col, rate=rate, min_chars=min_chars):
        counts = F.filter(name, lambda x: (x["item_chars"] > word_chars) | F.coalesce(x["whole_word"], F.lit(True)))
        out = out.withColumn(name, c).where(F.size(counts) == 0).drop(name)
    return out
