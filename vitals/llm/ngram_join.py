"""Operator 6: exact n-gram Jaccard join with token-combination prefixes.

A document's set holds the 64-bit hashes of its distinct word shingles; sets x and y link when
100 * |x & y| >= percent * |x | y|. The global token order is: rare tokens by hash, then frequent tokens by
hash. A linked pair shares all but t = |x| - ceil(percent * |x| / 100) tokens of x, so x's prefix is
extended until no removal of t tokens can empty it of signatures:

* a rare token is a signature by itself (removing it costs one); a set with rare tokens enough takes twice as many of them,
  so that linked sets share many, and goes without those that most sets have (``spare``, ``_rarest``);
* frequent tokens fall into classes by hash, and two tokens of one class together are a
  signature; a class of n tokens in the prefix resists n - 1 removals.

The prefix is the shortest one with (rare tokens) + sum over classes (n - 1) >= t + 1. Of a linked
pair, the prefix that ends first lies, as far as the sets agree, inside the other, so both share a
signature. The number of classes grows with the set's size (``LEVELS``), or pairs of tokens would grow with
its square; sets that may link across a level boundary are indexed on both levels.

Which tokens are frequent is a fixed-size bitmap of heavy hitters, so it can be shipped however many there
are; any such bitmap gives the same links, only other candidates.

Pairs of candidates are settled by size and by parity sketches (about a bit a token) before any set travels: two sets differ
in at least as many tokens as their sketches in bits. Only the sets of the pairs that are left are fetched, and
compared exactly.

Equal sets are joined by their 128-bit digest first, and one representative goes on. Signatures that
occur once (among sets of like size) are dropped; the others give candidates: all pairs where a signature has
``SMALL`` rows at most, else in rounds: each signature compares its rows to one pivot, links are verified on
the whole sets, and rows that are connected already are not compared again. The rows that are still open after
``PIVOTS`` rounds are joined anew among themselves, by prefixes in ascending order of how many of them hold a token,
and a pair is verified only if what follows its shared token, and the parity sketches of both sets, leave room for
a link. So no component is split, and a group of m near copies costs about m comparisons a round.

``jaccard_join`` gives connectivity: links inside a component that is known already are not verified. ``jaccard_links`` gives
every link, verified, with the number of pairs of rows it stands for; its work grows with the number of links, which
in a group of m near copies is the square of m.

Cases: null text, or text without a word, has an empty set and links with nothing; with fewer words
than the shingle the whole sequence is one shingle; rows with the same doc_id are one node and are each
returned; null doc_ids get a null component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.common import components, discard, in_filter, key_filter, prepare, rows_batches, slot_of, stage, texts

#: A token is counted as heavy if at least LOCAL sets of one chunk of CHUNK hashes hold it, frequent if
#: chunks with heavy counts add up to FREQUENT sets.
CHUNK, LOCAL, FREQUENT = 2_000_000, 4, 32
BITMAP_BITS = 25
#: (sets from this size on, classes of frequent tokens)
LEVELS = ((0, 1), (64, 16), (1024, 256), (16384, 4096))
PIVOTS = 3
#: Times that signatures are counted, each time among the sets that are left.
COUNTS = 2
#: Signatures with at most SMALL rows compare all of them at once.
SMALL = 8
#: 64-bit words of a set's parity sketch (a power of two), and prefix tokens looked back at for a pair's first one.
SKETCH_WORDS, EARLIER = 8, 4
#: Ids of a round that are broadcast (16 bytes each) to fetch their sets; more go by a fixed-size filter and a shuffle.
FEW_IDS = 200_000
#: Bits of the smallest sketch; a larger set has a bit a token, rounded up to a power of two.
LEAST_BITS = 512

_MULTIPLY = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Texts are hashed in stretches of about this many bytes.
STRETCH = 1 << 20
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9FB21C651E98DF25)
_IS_BLANK = np.array([c in b"\x09\x0a\x0b\x0c\x0d\x20" for c in range(256)])


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(byte offset, 64-bit hash) of each blank-separated word."""
    raw = np.frombuffer(data, np.uint8)
    solid = ~_IS_BLANK[raw]
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    first, length = edge[::2], edge[1::2] - edge[::2]
    if not len(first):
        return first, np.zeros(0, np.uint64)
    at = np.cumsum(length) - length
    inside = np.arange(int(length.sum())) - np.repeat(at, length)
    power = np.multiply.accumulate(np.full(int(length.max()), _STEP, np.uint64))
    return first, _mix(np.add.reduceat(_BYTE[raw[solid]] * power[inside], at) + length.astype(np.uint64))


def _cut(data: bytes) -> list[bytes]:
    """Stretches of about STRETCH bytes that end at blanks."""
    out, at = [], 0
    while len(data) - at > STRETCH:
        end = at + STRETCH
        while end < len(data) and not _IS_BLANK[data[end]]:
            end += 1
        out.append(data[at:end])
        at = end
    return [*out, data[at:]]


def _of_hashes(h: np.ndarray, k: int) -> np.ndarray:
    total = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        total = _mix(total * _MULTIPLY[i % 8] + h[i : i + len(total)])
    return total


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def shingle_sets(texts_: list[str], n: int):
    """The sorted distinct shingle hashes of each text, a stretch of texts at a time. On bytes,
    lower() folds A-Z alone."""
    data = [t.encode("utf-8", "surrogatepass").lower() for t in texts_]
    at = 0
    while at < len(data):
        end, size = at + 1, len(data[at])
        while end < len(data) and size + len(data[end]) <= STRETCH:
            size += len(data[end]) + 1
            end += 1
        if end == at + 1:
            h = np.concatenate([_word_hashes(part)[1] for part in _cut(data[at])])
            bounds = [0, len(h)]
        else:
            first, h = _word_hashes(b"\n".join(data[at:end]))
            ends = np.cumsum([len(d) + 1 for d in data[at:end]])
            bounds = [0, *np.searchsorted(first, ends).tolist()]
        full = _of_hashes(h, n) if len(h) >= n else h[:0]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield _distinct(full[a : b - n + 1]) if b - a >= n else _of_hashes(h[a:b], b - a) if b > a else h[:0]
        at = end


def _digests(n: int):
    """Per document its set's size and digest; per chunk the tokens that many sets hold."""

    def rows(batches):
        held, size = [], 0

        def heavy():
            token, count = np.unique(np.concatenate(held), return_counts=True)
            for t, c in zip(token[count >= LOCAL].view(np.int64).tolist(), count[count >= LOCAL].tolist(), strict=True):
                yield None, None, None, t, c

        for batch in batches:
            for doc_id, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(texts(batch), n), strict=True):
                yield doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None, None, None
                held.append(s)
                size += len(s)
                if size > CHUNK:
                    yield from heavy()
                    held, size = [], 0
        if held:
            yield from heavy()

    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("token", pa.int64()), ("sets", pa.int64())])
    return lambda batches: rows_batches(rows(batches), schema, 5000)


def ceil_share(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def levels(size: int, percent: int) -> list[int]:
    """The level of a set, and the next one if a partner may be there."""
    own = max(i for i, (least, _) in enumerate(LEVELS) if size >= least)
    out = [own]
    if own + 1 < len(LEVELS) and 100 * size >= percent * LEVELS[own + 1][0]:
        out.append(own + 1)
    return out


def needed(size: int, percent: int) -> int:
    """Tokens of a set of which every linked set holds one at least."""
    return size - ceil_share(size, percent) + 1


def spare(size: int, rare: int, percent: int) -> int:
    """How many of a set's signatures may be left out, those that most sets have. Of the prefixes of 2 * needed - 1 rare tokens of two
    linked sets ``needed`` are shared, by the smaller set's number, and that set has percent of the size at least. If a set has fewer
    rare tokens, all are signatures, and none is left out."""
    return needed(ceil_share(size, percent), percent) - 1 if 1 < size and rare >= 2 * needed(size, percent) - 1 else 0


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of a set, given which of its sorted tokens are frequent."""
    size = len(tokens)
    if size < 2:
        return tokens[:0]  # links only with an equal set
    need = needed(size, percent)
    rare, often = tokens[~frequent], tokens[frequent]
    if len(rare) >= need:
        return rare[: 2 * need - 1]
    out = [rare]
    for level in levels(size, percent):
        group = _mix(often) % np.uint64(LEVELS[level][1])
        # a token adds to the resistance unless it is the first of its class
        first = np.zeros(len(often), bool)
        first[np.unique(group, return_index=True)[1]] = True
        reach = len(rare) + np.cumsum(~first)
        end = int(np.searchsorted(reach, need)) + 1
        part, cls = often[:end], group[:end]
        order = np.argsort(cls, kind="stable")
        part, cls = part[order], cls[order]
        for lag in range(1, len(part)):
            same = cls[lag:] == cls[:-lag]
            if not same.any():
                break
            out.append(_mix(part[:-lag][same] * _MULTIPLY[0] + _mix(part[lag:][same] + np.uint64(level + 1))))
    return np.unique(np.concatenate(out))


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the numbers of tokens by their low bits."""
    bits = max(LEAST_BITS, 1 << max(len(tokens) - 1, 0).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differ(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, the larger one folded to the smaller one's length: a lower bound of the number of
    tokens that one of the two sets has alone."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(a) > len(b):
        a, b = b, a
    if len(b) > len(a):
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def _able(percent: int):
    """Pairs (a, b) that sizes and sketches don't rule out: |x ^ y| <= (|x| + |y|) * (100 - percent) / (100 + percent)."""

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("sa", "sb", "x", "y"))
            keep = pa.array([differ(x, y) * (100 + percent) <= (sa + sb) * (100 - percent) for sa, sb, x, y in zip(*columns, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in "ab"], names=["a", "b"])

    return run


def _signatures(n: int, percent: int, shared):
    def run(batches):
        bits = shared.value
        for batch in batches:
            sigs, sizes, sketches, spares = [], [], [], []
            for s in shingle_sets(texts(batch), n):
                sizes.append(len(s))
                sketches.append(sketch(s))
                slot = (s & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
                frequent = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                sigs.append(signatures(s, frequent, percent).view(np.int64))
                spares.append(spare(len(s), len(s) - int(frequent.sum()), percent))
            columns = [pa.array(sizes, pa.int32()), pa.array(spares, pa.int32()), pa.array(sigs, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "size", "spare", "sigs", "sketch"])

    return run


def _sets(n: int, shared):
    """The sets of the documents, or of those that pass a fixed-size filter."""

    def rows(batches):
        for batch in batches:
            if shared is not None:
                batch = batch.filter(pa.array(in_filter(shared.value, batch.column("slot").to_numpy())))
            for doc_id, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(texts(batch), n), strict=True):
                yield doc_id, s.tobytes()

    return lambda batches: rows_batches(rows(batches), pa.schema([("doc_id", pa.int64()), ("tokens", pa.binary())]), 200)


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


def _exploded(batches):
    """A row for each token of each set, by the set's key."""
    for batch in batches:
        for tokens in batch.column("tokens").to_pylist():
            token = np.frombuffer(tokens, np.int64)
            for at in range(0, len(token), CHUNK):
                part = token[at : at + CHUNK]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), set_key(tokens))), pa.array(part)], names=["key", "token"])


def set_key(tokens: bytes) -> int:
    return xxhash.xxh3_64_intdigest(tokens) >> 1


_WORDS = [f"w{i}" for i in range(SKETCH_WORDS)]
_HEAD = "doc_id long, component long, key long, size int, " + ", ".join(f"{w} long" for w in _WORDS)


def _heads(batches):
    """A row for each set: its key, size and sketch, folded to SKETCH_WORDS words."""
    for batch in batches:
        sets = batch.column("tokens").to_pylist()
        words = [np.bitwise_xor.reduce(np.frombuffer(sketch(np.frombuffer(t, np.uint64)), np.int64).reshape(-1, SKETCH_WORDS), axis=0) for t in sets]
        keys, sizes = pa.array([set_key(t) for t in sets], pa.int64()), pa.array([len(t) // 8 for t in sets], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("component"), keys, sizes, *(pa.array([int(w[i]) for w in words], pa.int64()) for i in range(SKETCH_WORDS))],
            names=["doc_id", "component", "key", "size", *_WORDS],
        )


def _open_pairs(sets: DataFrame, left: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b, sa, sb) among the documents ``left`` (doc_id, component): prefixes in ascending order of
    the tokens' numbers among them, and the sets' rests after a shared token must be able to link.

    Tokens travel as (key of the set, token) and those of one set alone stay behind, as only their number matters: they come first
    in every prefix. The parities of a set's tokens by their low bits are its sketch; two sets differ in as many tokens as their
    sketches in bits, or more, so a pair whose sketches differ too much can't link.
    """
    heads = stage(sets.join(left, "doc_id").mapInArrow(_heads, _HEAD), "join-heads")
    own = stage(sets.join(left, "doc_id", "left_semi").mapInArrow(_exploded, "key long, token long"), "join-tokens")
    often = own.groupBy("token").agg(F.count("*").cast("int").alias("n")).where("n > 1")
    ranked = own.join(often, "token").groupBy("key").agg(F.array_sort(F.collect_set(F.struct("n", "token"))).alias("ranked"))
    alone = F.col("size") - F.size("ranked")
    most = F.col("size") - F.floor((F.col("size").cast("long") * percent + 99) / 100) + 1
    prefix = heads.join(ranked, "key").withColumn("alone", alone).withColumn("ranked", F.slice("ranked", F.lit(1), F.greatest(most - F.col("alone"), F.lit(0)).cast("int")))
    prefix = prefix.select("doc_id", "component", "size", *_WORDS, "alone", F.col("ranked.token").alias("ranked"), F.posexplode("ranked.token").alias("at", "token"))
    # a pair is made where none of the EARLIER tokens before is shared: at its first shared token, and seldom again
    earlier = F.slice("ranked", F.greatest(F.col("at") - EARLIER, F.lit(0)) + 1, F.least("at", F.lit(EARLIER)))
    prefix = stage(prefix.select("doc_id", "component", "size", *_WORDS, (F.col("size") - F.col("alone") - F.col("at")).alias("rest"), earlier.alias("earlier"), "token"), "join-prefixes")
    discard(heads, own)
    # tokens of one component alone make no pair
    mixed = prefix.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    prefixes = prefix.join(mixed, "token", "left_semi")
    x, y = prefixes.alias("x"), prefixes.alias("y")
    both, shared = F.expr("x.size + y.size"), F.expr("least(x.rest, y.rest)")
    apart = sum((F.bit_count(F.col(f"x.{w}").bitwiseXOR(F.col(f"y.{w}"))) for w in _WORDS), F.lit(0))
    able = (shared * 100 >= (both - shared) * percent) & (apart * (100 + percent) <= both * (100 - percent))
    pairs = x.join(y, F.expr("x.token = y.token and x.doc_id < y.doc_id and x.component <> y.component") & able & ~F.arrays_overlap("x.earlier", "y.earlier"))
    pairs = pairs.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), F.col("x.size").alias("sa"), F.col("y.size").alias("sb"))
    pairs = stage(pairs.distinct(), "join-pairs")
    discard(prefix)
    return pairs


def _frequent(found: DataFrame) -> np.ndarray:
    """The bitmap of frequent tokens: fixed size, built from heavy hitters of all sets."""
    heavy = found.where("token is not null").groupBy("token").agg(F.sum("sets").alias("sets")).where(F.col("sets") >= FREQUENT)
    slot = F.col("token").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)) + 1
    parts = heavy.select(slot.alias("s")).groupBy(F.expr("bitmap_bucket_number(s)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(s))").alias("bits")).collect()
    out = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for p in parts:
        out[(p["b"] - 1) * 4096 : p["b"] * 4096] = np.frombuffer(p["bits"], np.uint8)
    return out


def _labelled(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """Posts with the component of each row (itself if it has none)."""
    return posts.join(labels, posts["doc_id"] == labels["node"], "left").select("sig", "doc_id", "size", F.coalesce("component", "doc_id").alias("component"))


def _shared(posts: DataFrame) -> DataFrame:
    """The posts of signatures that several documents have."""
    often = posts.groupBy("sig").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("sig")
    return posts.join(often, "sig", "left_semi").select("sig", "doc_id", "size")


def _rarest(posts: DataFrame) -> DataFrame:
    """Each set's signatures that other documents have too, without its ``spare`` commonest ones.

    Signatures of one document come first in the order, so a set with many of its own has nothing left: it links with nothing.
    Without such sets others' signatures are alone as well, hence the second count.
    """
    held = []
    for turn in range(COUNTS):
        if held:
            posts = held[0].join(held[1], ["doc_id", "size"], "left_semi").select("doc_id", "size", "spare", "sig")
        often = posts.groupBy("sig").agg(F.count("*").alias("m"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("sig", "m")
        counted = stage(posts.join(often, "sig"), "join-counted")
        discard(*held)
        ranked = counted.groupBy("doc_id", "size").agg(F.min("spare").alias("spare"), F.array_sort(F.collect_set(F.struct("m", "sig"))).alias("ranked"))
        kept = ranked.where(F.size("ranked") > F.col("spare"))
        if turn + 1 < COUNTS:
            held = [counted, stage(kept.select("doc_id", "size"), "join-kept")]
    rarest = F.slice(F.col("ranked.sig"), F.lit(1), F.size("ranked") - F.col("spare"))
    out = stage(kept.select("doc_id", "size", F.explode(rarest).alias("sig")), "join-shared")
    discard(counted)
    return out


def jaccard_join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id."""
    spark = prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    found = stage(rows.mapInArrow(_digests(n), "doc_id long, n long, digest binary, token long, sets long"), "join-digests")
    shared = spark.sparkContext.broadcast(_frequent(found))
    sized = found.where("n is not null").select("doc_id", "n", "digest")
    # equal sets: the smallest id stands for all (min is combined map-side, so copies cost nothing)
    first = sized.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = first.select(F.col("rep").alias("doc_id")).distinct()
    signed = rows.mapInArrow(_signatures(n, percent, shared), "doc_id long, size int, spare int, sigs array<long>, sketch binary").where(F.size("sigs") > 0)
    signed = stage(signed.join(reps, "doc_id", "left_semi"), "join-signed")
    first_cut = _rarest(signed.select("doc_id", "size", "spare", F.explode("sigs").alias("sig")))
    # sizes of a linked pair differ by a factor of 100 / percent at most: they meet in one of two neighbouring size classes
    bucket = F.floor(F.log("size") / (math.log(100 / percent) * 1.001)) if percent < 100 else F.col("size").cast("long")
    classed = first_cut.select(F.explode(F.array(bucket, bucket + 1)).alias("b"), "sig", "doc_id", "size").select(F.xxhash64("sig", "b").alias("sig"), "doc_id", "size")
    active = stage(_shared(classed), "join-active")
    discard(first_cut)
    sketches = stage(signed.select("doc_id", "sketch").join(active.select("doc_id").distinct(), "doc_id", "left_semi"), "join-sketches")
    discard(signed)

    def fetched(ids: DataFrame) -> DataFrame:
        """The distinct sets of documents."""
        if ids.count() <= FEW_IDS:
            some = rows.join(F.broadcast(ids), "doc_id", "left_semi").mapInArrow(_sets(n, None), "doc_id long, tokens binary")
        else:
            passing = spark.sparkContext.broadcast(key_filter(ids, "doc_id"))
            some = rows.withColumn("slot", slot_of("doc_id")).mapInArrow(_sets(n, passing), "doc_id long, tokens binary").join(ids, "doc_id", "left_semi")
        return stage(some.distinct(), "join-sets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        # the smaller set needs percent of the larger one's size
        near = pairs.where(F.least("sa", "sb") * 100 >= F.greatest("sa", "sb") * percent).select("a", "b", "sa", "sb").distinct()
        x, y = (sketches.select(F.col("doc_id").alias(k), F.col("sketch").alias(v)) for k, v in (("a", "x"), ("b", "y")))
        able = stage(near.join(x, "a").join(y, "b").mapInArrow(_able(percent), "a long, b long").distinct(), f"{name}-able")
        wanted = stage(able.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}-ids")
        sets = fetched(wanted)
        left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
        right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
        out = stage(able.join(left, "a").join(right, "b").mapInArrow(_verify(percent), "a long, b long").distinct(), name)
        discard(able, wanted, sets)
        return out

    # a doc_id with several texts is one node: it links the representatives of its texts
    by_rep = sized.join(first, "digest", "left")
    links = stage(by_rep.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b"), "join-links")
    labels = components(links, "join-cc")
    for turn in range(PIVOTS + 1):
        now = _labelled(active, labels)
        stats = now.groupBy("sig").agg(
            F.count("*").alias("m"), F.min("component").alias("c0"), F.max("component").alias("c1"),
            F.min_by(F.struct("doc_id", "size", "component"), F.xxhash64("doc_id", F.lit(turn))).alias("pivot"),
        ).where("c0 < c1")
        open_ = stage(now.join(stats.select("sig", "m", "pivot"), "sig"), "join-open")
        discard(active)
        if open_.isEmpty():
            break
        if turn == PIVOTS:
            left = stage(open_.select("doc_id", "component").distinct(), "join-left")
            sets = fetched(left.select("doc_id").distinct())
            new = verified(_open_pairs(sets, left, percent), "join-verified")
            discard(sets, left)
            if not new.isEmpty():
                labels = components(links.unionAll(new), "join-cc")
            discard(open_)
            break
        few = F.col("m") <= SMALL
        other = open_.where(few).select("sig", F.col("doc_id").alias("b"), F.col("size").alias("sb"), F.col("component").alias("cb"))
        pairs = open_.where(few).join(other, "sig").where("doc_id < b and component <> cb").select(F.col("doc_id").alias("a"), "b", F.col("size").alias("sa"), "sb")
        to_pivot = open_.where(~few).where("component <> pivot.component")
        pairs = pairs.unionAll(
            to_pivot.select(F.least("doc_id", "pivot.doc_id").alias("a"), F.greatest("doc_id", "pivot.doc_id").alias("b"), F.col("size").alias("sa"), F.col("pivot.size").alias("sb"))
        )
        new = verified(pairs, "join-verified")
        if not new.isEmpty():
            links = links.unionAll(new)
            labels = components(links, "join-cc")
        active = open_.where(~few).select("sig", "doc_id", "size")
        if active.isEmpty():
            break
    # the rows of a representative share its component, whose smallest id is a representative
    out = by_rep.join(labels, by_rep["rep"] == labels["node"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def _keyed_sets(n: int):
    """Every document's set with a 63-bit key of it; documents without a set are left out."""

    def rows(batches):
        for batch in batches:
            for doc_id, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(texts(batch), n), strict=True):
                if doc_id is not None and len(s):
                    yield doc_id, set_key(s.tobytes()), s.tobytes()

    return lambda batches: rows_batches(rows(batches), pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("tokens", pa.binary())]), 200)


def jaccard_links(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """Every link between different sets: a, b (the smallest doc_ids of either set) and links, the pairs of document
    rows that it stands for; rows of equal sets link with each other in a row of a = b."""
    prepare(docs.sparkSession)
    rows = stage(docs.select("doc_id", "text").mapInArrow(_keyed_sets(n), "doc_id long, key long, tokens binary"), "links-rows")
    held = stage(rows.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")), "links-keys")
    sets = stage(rows.groupBy("key").agg(F.first("tokens").alias("tokens")).withColumnRenamed("key", "doc_id"), "links-sets")
    discard(rows)
    near = stage(_open_pairs(sets, sets.select("doc_id", F.col("doc_id").alias("component")), percent).select("a", "b").distinct(), "links-near")
    x, y = (sets.select(F.col("doc_id").alias(k), F.col("tokens").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    found = near.join(x, "a").join(y, "b").mapInArrow(_verify(percent), "a long, b long")
    left, right = (held.select(F.col("key").alias(k), F.col("rep").alias(f"r{k}"), F.col("rows").alias(f"n{k}")) for k in "ab")
    between = found.join(left, "a").join(right, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"), (F.col("na") * F.col("nb")).alias("links"))
    equal = held.where("rows > 1").select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.expr("rows * (rows - 1) div 2").alias("links"))
    return between.unionAll(equal)
