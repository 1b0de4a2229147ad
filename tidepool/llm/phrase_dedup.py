"""Repeated phrases located by sharded Aho-Corasick automata.

A window is ``size`` consecutive words; it goes from every document but the
smallest id that holds it.

1. *Anchors.*  Each window names its smallest hashed group of ``GROUP`` words
   (leftmost on ties).  Equal windows name equal groups, and neighbouring
   windows mostly the same place, so the places named are about two in nine.  A
   window can recur only if its group is named in two documents.
2. *Confirmed passages.*  The windows that name one place make a context of at
   most ``2 * size - GROUP`` words.  Contexts at anchors seen twice travel to
   their anchor as window keys (128 bits with the anchor's), sorted by id, and
   a stream tells for every window the smallest id that holds it.  Contexts
   with a window of a smaller id are the passages to look for.
3. *Automata.*  Documents are dealt into shards of about ``SHARD_BYTES`` of
   text.  A shard cuts its passages from its documents, compiles them with
   pyahocorasick over word numbers, and streams its documents past the
   automaton, which finds every occurrence of every passage, word for word.

Scale: texts are exchanged once, to their shards; anchors are 16-byte rows, a
fifth as many as words, and contexts travel without words.  Anchors seen twice
are kept as a bitmap of at most ``MAX_BITS`` bits in every task while that holds
them (false positives only make more contexts), which passes through the driver
packed; beyond, contexts find their anchor in a join.  An anchor that holds a
large share of the contexts (no more than ``SHARES`` of them can) goes to several
tasks, each of which gets the owners of the anchor's recurring windows, found by
a combined aggregation.
Rows equal in id and text that are a large share of all go to several shards; a
shard holds each of them once.  Memory is a batch, the distinct windows of one
anchor, or one shard.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, materialize, row_key, slices

WINDOW = 13
GROUP = 6
SHARD_BYTES = 1 << 20
MAX_BITS = 1 << 28
BITS_PER_ANCHOR = 12
SHARES = 1024  # an anchor, or rows equal in id and text, are heavy from this part of all on
_HELD = 1 << 17  # heavy windows that a task sums up
_WORDS = 1 << 12  # words of the bitmap that come to the driver in a row
_OWNER, _CONTEXT = 0, 1
_PASSAGE, _TEXT = 0, 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _rolled(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` neighbours."""
    mixed = _mixed(hashes + np.uint64(seed))
    n = len(hashes) - size + 1
    out = mixed[:n].copy()
    for j in range(1, size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += mixed[j:n + j]
    return _mixed(out)


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)
_SPACE = np.isin(np.arange(256), list(SPACES.encode()))
_LONG_WORD = 512  # longer words are hashed by XXH64
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of the base and of its inverse


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(n + n // 4, base, np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of an Arrow column of texts, and the words of each text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = ~_SPACE[data]
    inner = offsets[(offsets > 0) & (offsets < len(data))]  # where a text follows another
    new, last = inside.copy(), inside.copy()
    new[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    new[inner] |= inside[inner]
    last[inner - 1] |= inside[inner - 1]
    starts, ends = np.flatnonzero(new), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[:len(data)], out=sums[1:])
    out = _mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    for k in np.flatnonzero(ends - starts > _LONG_WORD).tolist():
        out[k] = xxhash.xxh64_intdigest(data[starts[k]:ends[k]].tobytes())
    return out, counts


class Batch:
    """The words of a few texts, one after the other, and the contexts of their windows."""

    def __init__(self, texts: pa.Array, size: int, group: int):
        self.hashes, lengths = word_hashes(texts)
        self.before = np.cumsum(lengths) - lengths  # words of the texts before
        n, spread = len(self.hashes), size - group + 1
        none = np.zeros(0, np.int64)
        self.first, self.last, self.doc, self.anchor = none, none, none, none.astype(np.uint64)
        if n < size:
            return
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
        groups = _rolled(self.hashes, group, 11)
        windows = n - size + 1
        least = groups[:windows].copy()
        for j in range(1, spread):
            np.minimum(least, groups[j:windows + j], out=least)
        place = np.empty(windows, np.int64)
        at = np.arange(windows)
        for j in range(spread - 1, -1, -1):  # the leftmost of equal groups is written last
            np.copyto(place, at + j, where=groups[j:windows + j] == least)
        starts = np.flatnonzero(doc[:windows] == doc[size - 1:])  # windows inside one text
        if not len(starts):
            return
        place = place[starts]
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (doc[starts[1:]] != doc[starts[:-1]])])
        at = np.flatnonzero(new)
        self.first = starts[at]  # first and last window that name one place
        self.last = starts[np.concatenate([at[1:], [len(starts)]]) - 1]
        self.doc, self.anchor = doc[self.first], groups[place[at]]


def _anchors(size: int, group: int):
    """Anchors of each text, each once per text."""
    def run(batches):
        for b in batches:
            for part in slices(b, "t"):
                x = Batch(part.column("t"), size, group)
                order = np.lexsort((x.anchor, x.doc))
                anchor, doc = x.anchor[order], x.doc[order]
                new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])[:len(anchor)]
                yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64))], names=["anchor"])
    return run


class Bitmap:
    """Anchors seen twice, by their low bits."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def holds(self, anchor: np.ndarray) -> np.ndarray:
        at = anchor & np.uint64(self.bits - 1)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _packed(batches):
    """The words of a bitmap and their bits as bytes, ``_WORDS`` to a row."""
    def row(held: list) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        return pa.RecordBatch.from_arrays([pa.array([t.column(c).to_numpy().tobytes()], pa.binary()) for c in ("word", "ones")],
                                          names=["words", "ones"])

    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= _WORDS:
            yield row(held)
            held, n = [], 0
    if n:
        yield row(held)


def anchor_bitmap(recurring: DataFrame, bits: int) -> Bitmap:
    """The bitmap of a table of anchors; the driver holds its ``bits / 8`` bytes and a partition of what comes to it."""
    words = (recurring.select(F.expr(f"shiftright(anchor & {bits - 1}L, 6)").alias("word"),
                              F.expr("shiftleft(1L, CAST(anchor & 63 AS INT))").alias("one"))
             .groupBy("word").agg(F.bit_or("one").alias("ones")))
    out = np.zeros(bits // 64, np.uint64)
    for r in materialize(words.mapInArrow(_packed, "words binary, ones binary"), "phrase-bitmap").toLocalIterator():
        out[np.frombuffer(r["words"], np.int64)] = np.frombuffer(r["ones"], np.uint64)
    return Bitmap(out, bits)


_STREAM = "anchor long, salt int, kind int, id long, r1 long, start int, windows binary, owner long"


def _contexts(size: int, group: int, shipped, ways: dict[int, int]):
    """Contexts at anchors that the bitmap holds (all without one), those of heavy anchors salted."""
    heavy = np.array(sorted(ways), np.int64)
    shares = np.array([ways[a] for a in heavy.tolist()], np.int64)

    def run(batches):
        bitmap = shipped.value if shipped is not None else None
        seen: set[int] = set()  # equal rows have equal contexts: a task sends them once
        for b in batches:
            r1 = b.column("r1").to_pylist()
            new = [r not in seen and not seen.add(r) for r in r1]
            for part in slices(b.filter(pa.array(new, pa.bool_())), "t"):
                x = Batch(part.column("t"), size, group)
                keep = np.flatnonzero(bitmap.holds(x.anchor)) if bitmap is not None else np.arange(len(x.anchor))
                if not len(keep):
                    continue
                first, last, doc = x.first[keep], x.last[keep], x.doc[keep]
                keys = _rolled(x.hashes, size, 3).tobytes()
                windows = [keys[8 * a:8 * z + 8] for a, z in zip(first.tolist(), last.tolist())]
                of = pa.array(doc)
                anchor, r1 = x.anchor[keep].view(np.int64), part.column("r1").take(of)
                salt = np.zeros(len(keep), np.int64)
                if len(heavy):
                    at = np.minimum(np.searchsorted(heavy, anchor), len(heavy) - 1)
                    salt = np.where(heavy[at] == anchor, r1.to_numpy(zero_copy_only=False) % shares[at], 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(salt.astype(np.int32)), pa.array(np.full(len(keep), _CONTEXT, np.int32)),
                     part.column("id").take(of), r1, pa.array((first - x.before[doc]).astype(np.int32)),
                     pa.array(windows, pa.binary()), pa.nulls(len(keep), pa.int64())],
                    names=["anchor", "salt", "kind", "id", "r1", "start", "windows", "owner"])
    return run


def _heavy_windows(size: int, group: int, ways: dict[int, int]):
    """The windows of heavy anchors: (anchor, key, least id, greatest id); a task sums up what it has seen lately."""
    heavy = np.array(sorted(ways), np.int64)

    def rows(seen: dict) -> pa.RecordBatch:
        keys, ids = list(seen), list(seen.values())
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array([i[0] for i in ids], pa.int64()), pa.array([i[1] for i in ids], pa.int64())],
            names=["anchor", "key", "least", "most"])

    def run(batches):
        seen: dict[tuple[int, int], tuple[int, int]] = {}
        for b in batches:
            for part in slices(b.filter(pc.is_valid(b.column("id"))), "t"):
                x = Batch(part.column("t"), size, group)
                keep = np.flatnonzero(np.isin(x.anchor.view(np.int64), heavy))
                if not len(keep):
                    continue
                count = x.last[keep] - x.first[keep] + 1
                at = np.repeat(x.first[keep] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                ids = part.column("id").to_numpy()[x.doc[keep]]
                for key, i in zip(zip(np.repeat(x.anchor[keep].view(np.int64), count).tolist(),
                                      _rolled(x.hashes, size, 3)[at].view(np.int64).tolist()), np.repeat(ids, count).tolist()):
                    lo, hi = seen.get(key, (i, i))
                    seen[key] = (min(lo, i), max(hi, i))
                if len(seen) > _HELD:
                    yield rows(seen)
                    seen = {}
        yield rows(seen)
    return run


def _resolve(batches):
    """Sorted by anchor, salt, kind, id and place: every window's smallest id, and the contexts that lose windows to one."""
    held, owners, whole, before = None, {}, {}, None
    for b in batches:
        r1s, starts, flat, ends = [], [], [], [0]
        for anchor, salt, kind, i, r1, start, windows, owner in zip(*(c.to_pylist() for c in b.columns)):
            if held != (anchor, salt):
                held, owners, whole = (anchor, salt), {}, {}
            if kind == _OWNER:
                owners[windows[::-1]] = owner
                continue
            if before == (anchor, r1, start):  # an equal row of another task
                continue
            before = (anchor, r1, start)
            known = whole.get(windows)
            if known is not None and (i is None or known[0] < i):  # every owner of these windows is known, and smaller
                by = known[1]
            else:
                by, all_of = [], []
                for k in range(0, len(windows), 8):
                    key = windows[k:k + 8]
                    of = owners.get(key)
                    if of is None and i is not None:
                        of = owners[key] = i  # rows come by id
                    all_of.append(of)
                    by.append(of if of is not None and (i is None or of < i) else None)
                if i is not None:
                    whole[windows] = (max(all_of), all_of)
                if by.count(None) == len(by):
                    continue
            r1s.append(r1)
            starts.append(start)
            flat += by
            ends.append(len(flat))
        yield pa.RecordBatch.from_arrays(
            [pa.array(r1s, pa.int64()), pa.array(starts, pa.int32()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))], names=["r1", "start", "owners"])


def _string(ids: np.ndarray) -> str:
    """Word numbers as text, two characters a word, so that no node of an automaton has many children."""
    pair = np.empty((len(ids), 2), np.uint32)
    pair[:, 0], pair[:, 1] = 256 + (ids >> 8), ids & 255
    pair[:, 0] += np.where(pair[:, 0] >= 0xD800, 0x800, 0).astype(np.uint32)  # past the surrogates
    return pair.astype("<u4").tobytes().decode("utf-32-le")


def _spans(gone: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).tolist()
    return [{"start": a, "length": z - a} for a, z in zip(edge[::2], edge[1::2])]


class Shard:
    """The passages and documents of one shard; equal rows are held once."""

    def __init__(self):
        self.passages: dict[int, list] = {}
        self.docs: dict[tuple, list] = {}

    def add_passage(self, r1: int, start: int, owners: list) -> None:
        self.passages.setdefault(r1, []).append((start, owners))

    def add_document(self, r1: int, doc_id: int | None, text: str | None) -> None:
        self.docs.setdefault((r1, doc_id), [text, 0])[1] += 1

    def _compile(self, texts: dict, size: int) -> ahocorasick.Automaton:
        """The automaton of all passages; contexts that follow each other are one passage."""
        found: dict[str, list] = {}
        for (r1, _), text in texts.items():
            first, joined = 0, []
            for start, owners in [*sorted(self.passages.pop(r1, ())), (-1, ())]:
                if joined and start == first + len(joined):
                    joined += owners
                    continue
                if joined:
                    passage = text[2 * first:2 * (first + len(joined) + size - 1)]
                    known = found.setdefault(passage, joined)
                    if known is not joined:  # elsewhere it loses other windows
                        found[passage] = [o if o is not None else n for o, n in zip(known, joined)]
                first, joined = start, list(owners)
        automaton = ahocorasick.Automaton()
        for passage, owners in found.items():
            automaton.add_word(passage, (len(passage) // 2, owners, None if None in owners else max(owners)))
        automaton.make_automaton()
        return automaton

    def rows(self, size: int):
        """(id, number of words, removed spans, kept text) of every document."""
        split = {key: (text or "").encode().split() for key, (text, _) in self.docs.items()}
        if not self.passages:
            for key, words in split.items():
                yield from [(key[1], len(words), [], b" ".join(words).decode())] * self.docs[key][1]
            return
        number: dict[bytes, int] = {}
        flat = [number.setdefault(w, len(number)) for words in split.values() for w in words]
        text, at, texts = _string(np.array(flat, np.int64)), 0, {}
        for key, words in split.items():
            texts[key] = text[2 * at:2 * (at + len(words))]
            at += len(words)
        automaton = self._compile(texts, size)
        for key, words in split.items():
            doc_id, edge = key[1], None
            for end, (n, owners, most) in automaton.iter(texts[key]):
                if edge is None:
                    edge = [0] * (len(words) + 1)
                start = (end + 1) // 2 - n
                if most is not None and (doc_id is None or most < doc_id):
                    edge[start] += 1
                    edge[start + n] -= 1
                    continue
                for j, owner in enumerate(owners, start):
                    if owner is not None and (doc_id is None or owner < doc_id):
                        edge[j] += 1
                        edge[j + size] -= 1
            removed, kept = [], words
            if edge is not None:
                gone = np.cumsum(edge[:-1]) > 0
                removed, kept = _spans(gone), [w for w, x in zip(words, gone.tolist()) if not x]
            yield from [(doc_id, len(words), removed, b" ".join(kept).decode())] * self.docs[key][1]


def _stream(size: int):
    """Per shard: its passages, then its documents."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def batch(rows: list) -> pa.RecordBatch:
        ids, n, removed, kept = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(removed, span),
                                           pa.array(kept, pa.string())], names=["id", "n_words", "removed", "kept"])

    def results(shard: Shard):
        rows, held = [], 0
        for row in shard.rows(size):
            rows.append(row)
            held += len(row[3])
            if held > SHARD_BYTES or len(rows) == 1024:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)

    def run(batches):
        number, shard = None, Shard()
        for b in batches:
            for at, kind, r1, i, text, start, owners in zip(*(c.to_pylist() for c in b.columns)):
                if at != number:
                    yield from results(shard)
                    number, shard = at, Shard()
                if kind == _PASSAGE:
                    shard.add_passage(r1, start, owners)
                else:
                    shard.add_document(r1, i, text)
        yield from results(shard)
    return run


def dedup_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW,
                  group: int = GROUP, max_bits: int = MAX_BITS, shard_bytes: int = SHARD_BYTES,
                  shares: int = SHARES) -> DataFrame:
    """Remove each word that a recurring window covers, but in the smallest id that holds the window.

    Returns one row per input row: the id, ``n_words``, ``removed`` (spans of
    word numbers: start, length) and ``kept`` (the other words joined by one
    blank).  Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a window is ``size`` of
    them, and windows are judged on the input, not on what is left.  A null,
    empty or short text loses nothing.  Ids are integers; a window that stands
    in rows of one id only does not recur.  Rows with a null id own nothing:
    they lose every window that any document with an id holds, and two of them
    take nothing from each other.  Repeated rows are treated alike.  Other
    columns are not read.  ``max_bits``, ``shard_bytes`` and ``shares`` do not
    change the result.
    """
    spark = docs.sparkSession
    k1, _ = row_key(F.col(id_col).cast("long"), F.col(text_col))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), k1.alias("r1"))

    # shards, and the rows so often repeated that they need several
    rows = materialize(base.groupBy("r1").agg(F.count("*").alias("n"), F.sum(F.octet_length("t")).alias("bytes")), "phrase-rows")
    total = rows.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    shards = max(1, -(-(total["bytes"] or 0) // shard_bytes))
    heavy = rows.where(F.col("n") >= max(2, -(-(total["n"] or 0) // shares))).select(  # at most `shares` rows
        "r1", F.least(F.lit(shards), F.ceil(F.col("n") * (4 * shares) / F.lit(total["n"] or 1))).cast("int").alias("ways"))
    heavy = F.broadcast(heavy)

    anchors = materialize(base.select("t").mapInArrow(_anchors(size, group), "anchor long")
                          .groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > 1), "phrase-anchors")
    held = anchors.agg(F.count("*").alias("anchors"), F.sum("n").alias("n")).first()
    ways = {r["anchor"]: r["ways"] for r in anchors.where(F.col("n") >= max(64, -(-(held["n"] or 0) // shares))).select(
        "anchor", F.ceil(F.col("n") * (4 * shares) / F.lit(held["n"] or 1)).alias("ways")).collect()}  # at most `shares`

    bits = 1 << 16
    while bits < BITS_PER_ANCHOR * held["anchors"] and bits < max_bits:
        bits *= 2
    if held["anchors"] <= bits <= max_bits:
        shipped = spark.sparkContext.broadcast(anchor_bitmap(anchors, bits))
        found = base.mapInArrow(_contexts(size, group, shipped, ways), _STREAM)
    else:
        found = (base.mapInArrow(_contexts(size, group, None, ways), _STREAM)
                 .join(anchors.select("anchor"), "anchor", "left_semi"))
    if ways:
        owned = (base.select("id", "t").mapInArrow(_heavy_windows(size, group, ways), "anchor long, key long, least long, most long")
                 .groupBy("anchor", "key").agg(F.min("least").alias("owner"), F.max("most").alias("most")))
        salts = F.explode(F.sequence(F.lit(0), F.col("ways").cast("int") - 1)).alias("salt")
        shared = F.broadcast(spark.createDataFrame(list(ways.items()), "anchor long, ways long"))
        big = F.expr("unhex(lpad(hex(key), 16, '0'))")  # a key's bytes in the other order than numpy writes them
        found = found.unionByName(owned.join(shared, "anchor").select(
            "anchor", salts, F.lit(_OWNER).alias("kind"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("r1"),
            F.lit(None).cast("int").alias("start"), big.alias("windows"), "owner"))
    needs = materialize(found.select(*[c.split()[0] for c in _STREAM.split(", ")]).repartition("anchor", "salt")
                        .sortWithinPartitions("anchor", "salt", "kind", F.col("id").asc_nulls_last(), "r1", "start")
                        .mapInArrow(_resolve, "r1 long, start int, owners array<bigint>"), "phrase-needs")

    def shard(way):
        return F.pmod(F.xxhash64("r1", way), F.lit(shards)).alias("shard")

    way = F.explode(F.sequence(F.lit(0), F.coalesce("ways", F.lit(1)) - 1)).alias("way")
    passages = needs.join(heavy, "r1", "left").select("*", way).select(
        shard(F.col("way")), F.lit(_PASSAGE).alias("kind"), "r1", F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("string").alias("text"), "start", "owners")
    dealt = base.join(heavy, "r1", "left").select(
        shard(F.pmod(F.monotonically_increasing_id(), F.coalesce("ways", F.lit(1))).cast("int")), F.lit(_TEXT).alias("kind"),
        "r1", "id", F.col("t").alias("text"), F.lit(None).cast("int").alias("start"),
        F.lit(None).cast("array<bigint>").alias("owners"))
    return (passages.unionByName(dealt).repartition("shard").sortWithinPartitions("shard", "kind")
            .mapInArrow(_stream(size), "id long, n_words long, removed array<struct<start:bigint,length:bigint>>, kept string")
            .withColumnRenamed("id", id_col))
