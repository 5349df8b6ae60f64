"""Operator 8: removal of repeated long substrings with a run-length index.

A byte goes if a string of ``LENGTH`` bytes covers it that starts anywhere else too. Steps:

1. Every window of LENGTH bytes belongs to its minimizer: the K-gram with the smallest hash in it (leftmost of
   equals). Equal windows have the same one at the same place, so windows can only repeat within the
   group of their minimizer. Neighbouring windows of one minimizer make one segment.
2. Minimizers that occur once are dropped (counted over all texts); a fixed-size filter carries
   the others to a second pass, which cuts out their segments. Equal segments are combined, with their number.
3. Segments of a group of minimizers are indexed together: suffixes are sorted, the Burrows-Wheeler transform is
   run-compressed, and the longest match with the neighbouring suffix is sampled at run ends alone. Matching statistics
   are streamed from the samples: between samples they fall by one a byte. A window repeats
   if its segment was seen twice or either neighbour shares LENGTH bytes with it.
4. The marks are joined back to the documents and the bytes cut.

A minimizer with more than ``HOT`` distinct segments is not indexed in one task: its windows are dealt by their
128-bit digests over all tasks and counted there.

Cases: null text is empty; texts shorter than LENGTH keep all; matches never cross rows; rows that repeat
doc_id and text are copies of each other; null doc_ids are handled as any id; very long texts are cut
in overlapping stretches; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.common import FILTER_BITS, discard, in_filter, key_filter, prepare, rows_batches, slot_of, stage, texts

LENGTH, K = 400, 32
#: Window starts handled at once; with the overlap it stays below 2**20.
STRETCH = 1 << 18
#: Bytes indexed together, and distinct segments of one minimizer that one task indexes (of 2 * LENGTH bytes at most each).
INDEX_BYTES, HOT = 1 << 20, 6000
#: Letters of nine bits in the key of the first sort.
FIRST = 7

_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_LOW = np.uint64((1 << 20) - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _kgrams(raw: np.ndarray) -> np.ndarray:
    """64-bit hash of the 32 bytes from every position."""
    x = raw.astype(np.uint64)
    x = x[:-1] | (x[1:] << np.uint64(8))
    x = x[:-2] | (x[2:] << np.uint64(16))
    x = _mix(x[:-4] | (x[4:] << np.uint64(32)))
    n = len(raw) - K + 1
    return _mix(x[:n] * _MUL[0] + x[8 : 8 + n] * _MUL[1] + x[16 : 16 + n] * _MUL[2] + x[24 : 24 + n] * _MUL[3])


def _slide(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every ``width`` neighbours."""
    done, m = 1, key
    while done * 2 <= width:
        m = np.minimum(m[:-done], m[done:])
        done *= 2
    rest = width - done
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def window_groups(raw: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first window, last window) of the runs of windows with one minimizer."""
    n = len(raw) - length + 1
    h = _kgrams(raw)
    key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    at = (_slide(key, length - K + 1) & _LOW).astype(np.int64)[:n]
    start = np.flatnonzero(np.diff(at, prepend=-1))
    return h[at[start]], start, np.append(start[1:], n) - 1


def pieces(data: list[bytes], length: int = LENGTH):
    """Stretches of the texts to look at together: (raw bytes, [(text index, offset in the text, offset in the stretch, bytes)])."""
    held, parts, size = [], [], 0
    for i, d in enumerate(data):
        for at in range(0, max(len(d) - length + 1, 0), STRETCH):
            part = d[at : at + STRETCH + length - 1]
            if size and size + len(part) > STRETCH + length - 1:
                yield np.frombuffer(b"".join(held), np.uint8), parts
                held, parts, size = [], [], 0
            parts.append((i, at, size, len(part)))
            held.append(part)
            size += len(part)
    if size:
        yield np.frombuffer(b"".join(held), np.uint8), parts


def groups_of(data: list[bytes], length: int = LENGTH):
    """(text index, first window, last window, minimizer) arrays, window positions in the text."""
    for raw, parts in pieces(data, length):
        # windows that cross from one text into the next belong to nobody
        seed, first, last = window_groups(raw, length)
        begin = np.array([p[2] for p in parts])
        final = begin + np.array([p[3] for p in parts]) - length
        # a run may reach over a border: cut it at the borders of every text it touches
        a = np.searchsorted(begin, first, "right") - 1
        b = np.searchsorted(begin, last, "right") - 1
        reach = b - a + 1
        of = np.repeat(np.arange(len(first)), reach)
        text = np.repeat(a, reach) + np.arange(len(of)) - np.repeat(np.cumsum(reach) - reach, reach)
        lo, hi = np.maximum(first[of], begin[text]), np.minimum(last[of], final[text])
        ok = lo <= hi
        of, text, lo, hi = of[ok], text[ok], lo[ok], hi[ok]
        index, offset = np.array([p[0] for p in parts])[text], np.array([p[1] for p in parts])[text] - begin[text]
        yield index, lo + offset, hi + offset, seed[of]


def _encoded(batch) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts(batch)]


def _seeds(length: int):
    def run(batches):
        for batch in batches:
            found = [g[3] for g in groups_of(_encoded(batch), length)]
            if found:
                seed, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(n)], names=["seed", "n"])

    return run


_CUT = "doc_id long, row_key long, at int, seed long, digest binary, n long, segment binary"
_CUT_PA = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("at", pa.int32()), ("seed", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("segment", pa.binary())])


def _cut(length: int, shared):
    """Per shared run of windows a row with its place; per distinct segment of a batch one with its bytes."""

    def rows(batches):
        bits = shared.value
        for batch in batches:
            data, seen = _encoded(batch), {}
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist()
            for index, lo, hi, seed in groups_of(data, length):
                keep = in_filter(bits, _filter_slot(seed.view(np.int64)))
                for i, a, b, s in zip(index[keep].tolist(), lo[keep].tolist(), hi[keep].tolist(), seed[keep].view(np.int64).tolist(), strict=True):
                    segment = data[i][a : b + length]
                    digest = xxhash.xxh3_128_digest(segment)
                    yield ids[i], keys[i], a, s, digest, None, None
                    got = seen.get((s, digest))
                    seen[s, digest] = (got[0] + 1 if got else 1, segment)
            for (s, digest), (n, segment) in seen.items():
                yield None, None, None, s, digest, n, segment

    return lambda batches: rows_batches(rows(batches), _CUT_PA, 2000)


def _filter_slot(seed: np.ndarray) -> np.ndarray:
    """The slot of a minimizer, whose bits are mixed already."""
    return seed & np.int64((1 << FILTER_BITS) - 1)


class RunIndex:
    """Run-length BWT of byte strings with samples at run ends.

    ``before[p]`` and ``after[p]`` stream the longest match of suffix p with its neighbours in suffix order, from the
    samples alone.
    """

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings])
        self.start = np.cumsum(sizes + 1) - sizes - 1
        n = int((sizes + 1).sum())
        text = np.full(n, -1, np.int64)
        flat = np.frombuffer(b"".join(strings), np.uint8)
        end = self.start + sizes
        inner = np.ones(n, bool)
        inner[end] = False
        text[inner] = flat
        text[end] = 256 + np.arange(len(strings))  # every string ends with a letter of its own
        self.text = text
        self._sort()
        sa, n = self.sa, len(text)
        bwt = text[sa - 1]
        head = np.append(True, bwt[1:] != bwt[:-1])
        first = np.flatnonzero(head)
        # a border between two runs is the sample of both
        border = np.concatenate([[0], self._match(sa[first[1:]], sa[first[1:] - 1]), [0]])
        self.before = self._stream(sa[first], border[:-1])
        self.after = self._stream(sa[np.append(first[1:], n) - 1], border[1:])

    def _first(self) -> np.ndarray:
        """The first FIRST letters of every suffix as one number; nothing follows the end of its string."""
        n = len(self.text)
        letter = np.minimum(self.text, 256) + 1
        ends = letter == 257
        letter, ends = np.append(letter, np.zeros(FIRST, np.int64)), np.append(ends, np.zeros(FIRST, bool))
        key, over = letter[:n].copy(), ends[:n].copy()
        for i in range(1, FIRST):
            key = (key << 9) | np.where(over, 0, letter[i : i + n])
            over |= ends[i : i + n]
        self.closed = over
        return key

    def _sort(self) -> None:
        """Suffix array by prefix doubling, from FIRST letters on. Each round sorts only the suffixes whose place is open;
        a rank is the place of the first suffix that begins alike, and the ranks of every round are kept for match lengths."""
        n, step = len(self.text), FIRST
        key = self._first()
        sa = np.argsort(key)
        # what reaches the end of its string differs from all else: equal keys by string
        special = self.closed[sa]
        inner = sa[special]
        sa[special] = inner[np.lexsort((inner, key[inner]))]
        ordered = key[sa]
        head = np.append(True, ordered[1:] != ordered[:-1]) | special
        rank = np.empty(n, np.int32)
        rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        self.levels = [(step, rank)]
        place = np.arange(n)
        while True:
            open_ = ~(head & np.append(head[1:], True))
            place = place[open_]
            if not len(place):
                break
            at = sa[place]
            # a suffix whose place is open has FIRST letters alike and no end among them, so it is longer than ``step``
            key = rank[at].astype(np.int64) * n + rank[at + step]
            order = np.argsort(key)
            at, key = at[order], key[order]
            sa[place] = at
            head = np.append(True, key[1:] != key[:-1])
            rank = rank.copy()
            rank[at] = place[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
            step *= 2
            self.levels.append((step, rank))
        self.sa = sa

    def _match(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes p and q."""
        total, n = np.zeros(len(p), np.int64), len(self.text)
        for step, rank in [*reversed(self.levels), *[(1, self.text)] * (FIRST - 1)]:
            i, j = p + total, q + total
            same = (i < n) & (j < n)
            same &= rank[np.minimum(i, n - 1)] == rank[np.minimum(j, n - 1)]
            total += same * step
        return total

    def _stream(self, sample: np.ndarray, length: np.ndarray) -> np.ndarray:
        n = len(self.text)
        known, at = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        known[sample], at[sample] = length, sample
        at = np.maximum.accumulate(at)
        return known[at] - (np.arange(n) - at)


def repeated(strings: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """For each string which of its windows occur more than once among all (with their numbers)."""
    index = RunIndex(strings)
    long = np.maximum(index.before, index.after) >= length
    return [np.ones(len(s) - length + 1, bool) if m > 1 else long[a : a + len(s) - length + 1] for s, m, a in zip(strings, counts, index.start.tolist(), strict=True)]


def covered(marks: np.ndarray, length: int) -> list[dict]:
    """The byte ranges that the marked windows cover."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return [{"lo": int(a), "hi": int(b) - 1 + length} for a, b in zip(edge[::2], edge[1::2], strict=True)]


_RANGE = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
_MARK = "seed long, digest binary, ranges array<struct<lo:int,hi:int>>"
_MARK_PA = pa.schema([("seed", pa.int64()), ("digest", pa.binary()), ("ranges", _RANGE)])


def _index(length: int):
    """Index the segments of a task, sorted by minimizer, in groups of whole minimizers of about INDEX_BYTES."""

    def rows(batches):
        held, size = [], 0

        def flush():
            for r, marks in zip(held, repeated([r[2] for r in held], [r[3] for r in held], length), strict=True):
                if marks.any():
                    yield r[0], r[1], covered(marks, length)

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("seed", "digest", "segment", "n")), strict=True):
                if size > INDEX_BYTES and r[0] != held[-1][0]:
                    yield from flush()
                    held, size = [], 0
                held.append(r)
                size += len(r[2])
        if held:
            yield from flush()

    return lambda batches: rows_batches(rows(batches), _MARK_PA, 2000)


def _windows(length: int):
    """The windows of hot segments: (seed, digest, place, digest of the window, number)."""

    def rows(batches):
        for batch in batches:
            for seed, digest, segment, n in zip(*(batch.column(c).to_pylist() for c in ("seed", "digest", "segment", "n")), strict=True):
                for at in range(len(segment) - length + 1):
                    yield seed, digest, at, xxhash.xxh3_128_digest(segment[at : at + length]), n

    return lambda batches: rows_batches(rows(batches), pa.schema([("seed", pa.int64()), ("digest", pa.binary()), ("at", pa.int32()), ("window", pa.binary()), ("n", pa.int64())]), 5000)


_OUT = "doc_id long, n_bytes long, n_removed long, spans array<struct<lo:int,hi:int>>, kept binary, kept_sha256 string"
_OUT_PA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", _RANGE), ("kept", pa.binary()), ("kept_sha256", pa.string())])


def merge(ranges: list[dict]) -> list[dict]:
    """Sorted disjoint ranges; touching ones are one."""
    out: list[dict] = []
    for r in sorted(ranges, key=lambda r: (r["lo"], r["hi"])):
        if out and r["lo"] <= out[-1]["hi"]:
            out[-1]["hi"] = max(out[-1]["hi"], r["hi"])
        else:
            out.append({"lo": r["lo"], "hi": r["hi"]})
    return out


def _strip(with_text: bool, shared=None):
    def rows(batches):
        for batch in batches:
            if shared is not None:
                batch = batch.filter(pa.array(~in_filter(shared.value, batch.column("slot").to_numpy())))
            ranges = batch.column("ranges").to_pylist() if shared is None else [None] * batch.num_rows
            for doc_id, data, found in zip(batch.column("doc_id").to_pylist(), _encoded(batch), ranges, strict=True):
                spans, kept, at = merge(found or []), [], 0
                for s in spans:
                    kept.append(data[at : s["lo"]])
                    at = s["hi"]
                left = b"".join([*kept, data[at:]])
                yield doc_id, len(data), len(data) - len(left), spans, left if with_text else None, hashlib.sha256(left).hexdigest()

    return lambda batches: rows_batches(rows(batches), _OUT_PA, 200)


def _passing(shared):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_filter(shared.value, batch.column("slot").to_numpy())))

    return run


def strip_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, spans (removed byte ranges), kept (remaining bytes), kept_sha256."""
    spark = prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    seeds = rows.select("text").mapInArrow(_seeds(length), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")
    shared = spark.sparkContext.broadcast(key_filter(seeds, "seed", mixed=True))
    cut = stage(rows.mapInArrow(_cut(length, shared), _CUT), "repeats-cut")
    segments = cut.where("segment is not null").groupBy("seed", "digest").agg(F.sum("n").alias("n"), F.first("segment").alias("segment"))
    segments = stage(segments, "repeats-segments")
    by_seed = segments.groupBy("seed").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1").select("seed", "kinds")
    known = segments.join(by_seed, "seed")
    cold = known.where(F.col("kinds") <= HOT).select("seed", "digest", "segment", "n").repartition("seed").sortWithinPartitions("seed", "digest")
    marks = cold.mapInArrow(_index(length), _MARK)
    hot = known.where(F.col("kinds") > HOT).select("seed", "digest", "segment", "n").mapInArrow(_windows(length), "seed long, digest binary, at int, window binary, n long")
    again = hot.groupBy("seed", "window").agg(F.sum("n").alias("total")).where("total > 1").select("seed", "window")
    hot_marks = (
        hot.join(again, ["seed", "window"], "left_semi")
        .groupBy("seed", "digest")
        .agg(F.collect_list(F.struct(F.col("at").alias("lo"), (F.col("at") + length).alias("hi"))).alias("ranges"))
    )
    marks = stage(marks.unionAll(hot_marks), "repeats-marks")
    places = cut.where("segment is null").select("doc_id", "row_key", "at", "seed", "digest")
    spans = (
        places.join(marks, ["seed", "digest"])
        .select("doc_id", "row_key", F.explode("ranges").alias("r"), "at")
        .select("doc_id", "row_key", F.struct((F.col("at") + F.col("r.lo")).alias("lo"), (F.col("at") + F.col("r.hi")).alias("hi")).alias("r"))
        .distinct()  # rows that repeat share their ranges
        .groupBy("doc_id", "row_key")
        .agg(F.collect_list("r").alias("ranges"))  # bounded by the length of one text
    )
    spans = stage(spans, "repeats-spans")
    discard(cut, segments, marks)
    touched = spark.sparkContext.broadcast(key_filter(spans, "row_key"))
    slotted = rows.withColumn("slot", slot_of("row_key"))
    some = slotted.mapInArrow(_passing(touched), "doc_id long, row_key long, text string, slot long")
    s = spans.withColumnsRenamed({"doc_id": "s_id", "row_key": "s_key"})
    changed = some.join(s, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("row_key") == F.col("s_key")), "left").select("doc_id", "text", "ranges")
    same = slotted.select("doc_id", "text", "slot").mapInArrow(_strip(with_text, touched), _OUT)
    return changed.mapInArrow(_strip(with_text), _OUT).unionAll(same)
