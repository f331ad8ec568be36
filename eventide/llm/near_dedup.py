"""Near-duplicate documents by MinHash, banding and connected components.

1. Every document becomes the set of its distinct word shingles (64-bit hashes).  Documents of
   equal sets are one class, and only the smallest id of a class goes on.
2. ``bands * rows`` universal hash functions a * x + b mod 2**32 give each set its minima.  The
   minima of a band are hashed to a bucket; at the defaults two sets of Jaccard similarity 0.8
   share a bucket with probability 1 - 8e-6, two of 0.85 with 1 - 2e-9.
3. Candidates, first round: every member of a bucket with the bucket's smallest id.  Second
   round: the members of a bucket outside its most common component, with all other members
   not yet connected to them, in blocks.  So each pair of sets that share a bucket is either
   confirmed, refuted, or already connected otherwise: no bucket is capped, no pairs of a
   bucket are emitted, and a bucket of copies costs one pair a member.
4. A pair is verified on its signatures (an estimate clearly below the threshold refutes it),
   then on the full shingle sets: 100 * |A and B| >= percent * |A or B|.
5. Components by alternating large-star and small-star steps over the confirmed links, each
   step written to the shared checkpoint folder.

Hot keys: classes and buckets are reduced by aggregates with map-side partial sums; members
meet their bucket's smallest id in a join that adaptive execution can split.

Files: each file written costs its executor a few processes (chmod), whatever its size, so tables
are written by few tasks: the short ones (members of buckets, links, steps of the components) by
no more than there are cores, the others by four a core.  The tasks that search keep their number.

Defined results: words are lower-cased (A-Z) runs of non-blanks; a text of fewer words than a
shingle is one shingle of all its words; a null text or one without words has an empty set, is
linked with nothing and is its own component; repeated rows of one id share a component, each
keeping its row (an id with different texts is verified on the smallest of them); rows of a null id are kept, and have a null component; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import schema, small_batches, stored

BANDS, ROWS = 64, 8
SLACK = 0.1                 # estimates this far below the threshold refute a pair (5 sigma)


def shingle_hashes(text: bytes, size: int, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a lower-cased text."""
    tokens = text.split()
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(memo) > 500_000:
        memo.clear()
    try:
        h = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
    except KeyError:
        for w in set(tokens):
            if w not in memo:
                memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
    if len(tokens) < size:
        return mixed(np.array([len(tokens)], np.uint64) + fold(h, len(tokens)))
    return np.unique(fold(h, size))


def fold(h: np.ndarray, size: int) -> np.ndarray:
    """One hash for every ``size`` consecutive ones."""
    n = len(h) - size + 1
    x = np.zeros(n, np.uint64)
    for j in range(size):
        x = mixed(x * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
    return x


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def hash_family(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, n, dtype=np.uint32))


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        part = x[i:i + 512]
        np.minimum(out, (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out)
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """A bucket for each band, as signed 64-bit numbers."""
    rows = sig.reshape(bands, -1).astype(np.uint64)
    x = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows.shape[1]):
        x = mixed(x * np.uint64(0x9E3779B97F4A7C15) + rows[:, j] + np.uint64(1))
    return x.view(np.int64)


def _signatures(batches, size, bands, rows):
    """(doc_id, n, set digest, signature of 16-bit minima, bucket of each band)."""
    memo: dict[bytes, int] = {}
    a, b = hash_family(bands * rows)
    for batch in batches:
        n, hi, lo, sigs, keys = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            s = shingle_hashes(text.lower(), size, memo)
            d = xxhash.xxh3_128_intdigest(s.tobytes())
            m = minima(s, a, b)
            n.append(len(s))
            hi.append((d >> 64) - (1 << 63))
            lo.append((d & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
            sigs.append((m >> np.uint32(16)).astype(np.uint16).tobytes())
            keys.append(band_keys(m, bands))
        offsets = np.arange(0, bands * len(n) + 1, bands, dtype=np.int32)
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
             pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            names=["doc_id", "n_shingles", "hi", "lo", "sig", "keys"])


def _alike(batches, percent):
    """Pairs whose signatures do not rule the threshold out."""
    least = percent / 100 - SLACK
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16) for i in (2, 3))
        if not batch.num_rows:
            continue
        same = (a.reshape(batch.num_rows, -1) == b.reshape(batch.num_rows, -1)).mean(axis=1)
        yield batch.select([0, 1]).filter(pa.array(same >= least))


def _confirmed(batches, percent, size):
    """Pairs of texts whose full shingle sets are similar enough."""
    memo: dict[bytes, int] = {}
    for batch in batches:
        ok = []
        last, last_set = None, None
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if x != last:
                last, last_set = x, shingle_hashes(x.lower(), size, memo)
            other = shingle_hashes(y.lower(), size, memo)
            both = len(np.intersect1d(last_set, other, assume_unique=True))
            ok.append(100 * both >= percent * (len(last_set) + len(other) - both))
        yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))


def _cross_links(batches, percent, size):
    """Links between the open members of a bucket and its other members.

    Rows (key, block, chunk, role, id, c, text) arrive sorted; in each (key, block, chunk) the
    open members (role 0) come first and are held, the others pass by one at a time.  The sizes
    of all intersections with the held sets come from one look-up of a member's shingles.  One
    link per open member and component is enough.
    """
    memo: dict[bytes, int] = {}
    at, held, index, out = None, [], None, []
    linked: set = set()

    def build():
        sets = [x[2] for x in held]
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        codes = np.concatenate(sets)
        order = np.argsort(codes, kind="stable")
        return codes[order], owner[order], np.array([len(x) for x in sets]), np.array([x[1] for x in held])

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(7)]
        for key, block, chunk, role, doc, c, text in zip(*cols):
            if (key, block, chunk) != at:
                at, held, index = (key, block, chunk), [], None
                linked.clear()
            s = shingle_hashes(text.lower(), size, memo)
            if role == 0:
                held.append((doc, c, s))
                continue
            if index is None:
                index = build()
            codes, owner, sizes, comps = index
            lo, hi = np.searchsorted(codes, s, "left"), np.searchsorted(codes, s, "right")
            spans = hi - lo
            flat = np.repeat(lo - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
            both = np.bincount(owner[flat], minlength=len(held))
            ok = (100 * both >= percent * (sizes + len(s) - both)) & (comps != c)
            for j in np.flatnonzero(ok):
                if (held[j][0], c) not in linked:
                    linked.add((held[j][0], c))
                    out.append((held[j][0], doc))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
        out = []


def components(links: DataFrame, stop: int = 50) -> DataFrame:
    """(id, component) for every id of ``links`` (a, b): the smallest id it is connected with.

    Alternates large-star (every larger neighbour is linked to the smallest neighbour) and
    small-star (every smaller neighbour is) until the links no longer change.
    """
    cores = links.sparkSession.sparkContext.defaultParallelism
    both = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    now = stored(both.coalesce(cores), "star")
    before = None
    for _ in range(stop):
        large = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = large.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        now = stored(small.coalesce(cores), "star")
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle in {stop} rounds")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    sets = stored(texts.mapInArrow(
        lambda it: _signatures(it, size, bands, rows),
        schema("doc_id long, n_shingles long, hi long, lo long, sig binary, keys array<long>")), "sets")
    cores = docs.sparkSession.sparkContext.defaultParallelism
    whole = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(whole.groupBy("hi", "lo").agg(F.min("doc_id").alias("rep")).coalesce(4 * cores), "classes")
    # an id with several texts is one document: its classes are linked
    ids = whole.select("doc_id", "hi", "lo").join(classes, ["hi", "lo"]).select("doc_id", "rep")
    per_id = stored(ids.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("other"))
                    .coalesce(4 * cores), "class-ids")
    several = per_id.where("rep < other")
    shared_ids = several.select(F.col("rep").alias("a"), F.col("other").alias("b"))
    own = ids.join(several.select("doc_id"), "doc_id").select(
        F.least("doc_id", "rep").alias("a"), F.greatest("doc_id", "rep").alias("b")).where("a < b")
    named = whole.select("hi", "lo", F.col("doc_id").alias("rep"), "keys").join(classes, ["hi", "lo", "rep"])
    buckets = named.select(F.col("rep").alias("id"), F.explode("keys").alias("key"))
    crowded = (buckets.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last"))
               .where("lead < last").select("key", "lead"))
    members = stored(buckets.join(crowded, "key").distinct().repartition(cores), "buckets")
    wanted = members.select("id").distinct()
    signed = stored(whole.select(F.col("doc_id").alias("id"), "n_shingles", "sig").join(wanted, "id", "left_semi")
                    .groupBy("id").agg(F.min(F.struct("n_shingles", "sig")).alias("s")).coalesce(4 * cores), "signatures")
    texts_of = stored(texts.select(F.col("doc_id").alias("id"), "text").join(wanted, "id", "left_semi")
                      .groupBy("id").agg(F.min("text").alias("text")).coalesce(4 * cores), "candidate-texts")

    def verified(pairs):
        few = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
        side = lambda s: signed.select(F.col("id").alias(s), F.col("s.n_shingles").alias(f"n{s}"),
                                       F.col("s.sig").alias(f"s{s}"))
        near = (pairs.join(side("a"), "a").join(side("b"), "b").where(few).select("a", "b", "sa", "sb")
                .mapInArrow(lambda it: _alike(it, percent), schema("a long, b long")))
        near = (near.join(texts_of.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
                .join(texts_of.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a"))
        return near.select("a", "b", "ta", "tb").mapInArrow(lambda it: _confirmed(it, percent, size),
                                                            schema("a long, b long"))

    first = members.where("id > lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    first = stored(verified(first).union(shared_ids).union(own).repartition(cores), "links")
    part = components(first)
    placed = stored(members.join(part, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
                    .coalesce(4 * cores), "placed")
    second = _second_round(placed, texts_of, size, percent).repartition(cores)
    joined = components(first.union(stored(second, "links")))
    found = (per_id.join(joined, F.col("rep") == F.col("id"), "left")
             .select(F.col("doc_id").alias("_id"), F.coalesce("component", "rep").alias("_component")))
    return (sets.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("_id"), "left")
            .select("doc_id", "n_shingles", F.coalesce("_component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _second_round(placed: DataFrame, texts_of: DataFrame, size: int, percent: int, block: int = 256,
                  chunk: int = 4096) -> DataFrame:
    """Links between members of one bucket that the first round left in different components.

    Members outside a bucket's most common component are open.  They are dealt over blocks, all
    members over chunks, and every (block, chunk) of a bucket is compared on its own, so a task
    holds ``block`` sets whatever the size of the bucket.  A bucket of two was settled before.
    """
    sums = placed.groupBy("key", "c").agg(F.count("*").alias("n"))
    sums = sums.groupBy("key").agg(F.max(F.struct("n", "c")).alias("main"), F.sum("n").alias("n"))
    sums = sums.where("main.n < n AND n > 2").select(
        "key", F.col("main.c").alias("main"), F.expr(f"int(ceil((n - main.n) / {block}))").alias("blocks"),
        F.expr(f"int(ceil(n / {chunk}))").alias("chunks"))
    rows = placed.join(sums, "key")
    pick = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    unit = lambda b, k, role: F.struct(b.alias("block"), k.alias("chunk"), F.lit(role).alias("role"))
    all_of = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    opened = F.when(F.col("c") != F.col("main"), F.transform(all_of("chunks"), lambda k: unit(pick(F.col("blocks")), k, 0)))
    passing = F.transform(all_of("blocks"), lambda b: unit(b, pick(F.col("chunks")), 1))
    none = F.filter(passing, lambda x: F.lit(False))
    units = rows.withColumn("u", F.explode(F.concat(F.coalesce(opened, none), passing)))
    units = units.select("key", "u.block", "u.chunk", "u.role", "id", "c").join(texts_of, "id")
    units = units.select("key", "block", "chunk", "role", "id", "c", "text")
    units = units.repartition("key", "block", "chunk").sortWithinPartitions("key", "block", "chunk", "role", "id")
    return units.mapInArrow(lambda it: _cross_links(it, percent, size), schema("a long, b long"))
