"""Phrase collocations from FM-indexes over word ids, one index a shard.

Texts are cut into pieces at ``.,;:!?`` and line breaks, pieces into words (A-Z lower-cased).  A
task packs the texts it reads into shards of one language: word ids, with 0 between pieces.  A
phrase's count is the sum over the shards.

A shard's bidirectional FM-index is the Burrows-Wheeler transform of its ids and that of the
reversed ids, their rows sorted by the first words only, as many as the phrases at hand have.  A
phrase is an interval of rows in both.  One step of backward search in the reversed index extends
intervals by every word that follows, and with the order of these words inside the interval the
forward interval follows too; its rows give the places in the text.

Phrases grow word by word over the whole corpus.  Those of ``d`` words are summed across shards,
and each shard gets back which of its phrases reach ``least``.  It extends them to the right and
keeps an extension only if its last ``d`` words reach it too (in the reversed index, the row falls
in a kept interval).  A shard's ids then shrink to the places of what was kept.  No phrase of
``least`` occurrences can be missed: all its parts have as many.

How the work spreads: texts are not shuffled.  For the pruning, shards send short digests of their
phrases with counts, sorted and packed, a block for each range of digests, and get back a bit for
each; phrases whose digests collide are at worst kept for longer.  A digest has more values than
the texts have bytes.  The words themselves are sent, and summed exactly, only for what is left,
also packed by range.  The commonest phrase is one digest a shard.  The number of ranges follows
the bytes of the texts.  Shards hold up to ``SHARD_WORDS`` words; a piece is never cut, so one huge
piece makes a larger shard.

Defined results: a null or empty text has no words; a null language is ``und``; repeated rows and
ids count each time; an empty table gives an empty result; further columns are not used.
"""

from __future__ import annotations

from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import bounded_batches, schema, small_batches, stored

LONGEST, LEAST, TOP = 5, 100, 2000
SHARD_WORDS = 1 << 22
TEXT_BYTES = 4 << 20                        # a longer text is read piece by piece
BREAK = b"\xff"                             # no byte of UTF-8
_BREAKS = b".,;:!?\n\x0b\x0c\r"
READ = bytes.maketrans(bytes(range(65, 91)) + b"\t" + _BREAKS, bytes(range(97, 123)) + b" " + BREAK * len(_BREAKS))
# a shard has one row with its words, ids and phrases (rows of ids) and the number of words, one per range
# of digests with the digests and counts of its phrases, and one per range with those phrases of the level
# before that reached the least, in words, and their counts
SHARD = "shard long, lang string, n long, words binary, ids binary, phrases binary, deal int, digests binary, found binary, counts binary"
KINDS = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
REPLY = "shard long, deal int, known binary"
SUMS = "lang string, phrase string, f long"
ROWS = 1 << 16                              # rows an output batch
DEAL_BYTES = 32 << 20                       # bytes of text for each range of digests


class _Ids(dict):
    """Numbers for words in order of first use; 0 is the break."""

    def __init__(self):
        super().__init__({BREAK: 0})

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def _parts(text: bytes):
    """The text, read, in runs that end where a piece ends."""
    text, at = text.translate(READ), 0
    while at < len(text):
        end = text.find(BREAK, at + TEXT_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def _pack(numbers, kind=np.int32) -> bytes:
    """Numbers, first all their lowest bytes, then all the next."""
    numbers = np.ascontiguousarray(numbers, kind)
    return zstandard.compress(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes(), 1)


def _unpack(data: bytes, kind=np.int32):
    data = np.frombuffer(zstandard.decompress(data), np.uint8)
    return data.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _pack_phrases(phrases) -> bytes:
    """Column by column; they are in order, so the first ids differ by little."""
    steps = phrases.T.astype(np.int32)
    steps[0, 1:] = np.diff(steps[0])
    return _pack(steps.ravel())


def _unpack_phrases(data: bytes, width):
    steps = _unpack(data).reshape(width, -1)
    steps[0] = np.cumsum(steps[0])
    return steps.T


def _pack_digests(named, counts, least) -> bytes:
    """Sorted digests by their differences, with counts; ``least`` stands for all counts above."""
    kind = np.min_scalar_type(least)
    steps = _pack(np.diff(named, prepend=np.uint64(0)), np.uint64)
    return len(steps).to_bytes(8, "little") + steps + _pack(np.minimum(counts, least), kind)


def _unpack_digests(data: bytes, least):
    end = 8 + int.from_bytes(data[:8], "little")
    return np.cumsum(_unpack(data[8:end], np.uint64)), _unpack(data[end:], np.min_scalar_type(least))


def _squeeze(ids):
    """One break between pieces and one at the end."""
    ids = np.append(ids, 0)
    return ids[(ids > 0) | (np.append(0, ids[:-1]) > 0)]


def _rows(shard, lang, count, /, **columns):
    names = [c.split()[0] for c in SHARD.split(", ")]
    columns |= {"shard": [shard] * count, "lang": [lang] * count}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(count, k)
                                       for c, k in zip(names, KINDS)], names=names)


def digests(lang, words, phrases):
    """64-bit digests of phrases (rows of ids into ``words``, from 1), the same in every shard."""
    each = np.array([xxhash.xxh3_64_intdigest(w) for w in (lang, *words)], np.uint64)
    out = np.full(len(phrases), each[0], np.uint64)
    for ids in phrases.T:
        out = out * np.uint64(0x9E3779B97F4A7C15) + each[ids]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def _dealt(lang, words, phrases, bits, deals):
    """Short digests of phrases in order, the phrase of each, and where each of the ranges begins and ends."""
    named = digests(lang, words, phrases).view(np.uint64) & np.uint64((1 << bits) - 1)
    order = np.argsort(named, kind="stable")
    named = named[order]
    # range i has the digests d with d * deals >> bits = i
    bounds = [-(-(i << bits) // deals) for i in range(deals)]
    return named, order, np.append(np.searchsorted(named, np.array(bounds, np.uint64)), len(named))


def _shard_rows(shard, lang, words, ids, phrases, counts, deal):
    bits, deals, least = deal
    yield _rows(shard, lang, 1, n=[np.count_nonzero(ids)], words=[zstandard.compress("\n".join(words).encode(), 1)],
                ids=[_pack(ids)], phrases=[_pack_phrases(phrases)])
    named, order, at = _dealt(lang, words, phrases, bits, deals)
    counts = counts[order]
    full = np.flatnonzero(np.diff(at))
    blocks = [_pack_digests(named[at[i]:at[i + 1]], counts[at[i]:at[i + 1]], least) for i in full]
    if blocks:
        yield _rows(shard, lang, len(blocks), deal=full, digests=blocks)


def _frequent(batches, least):
    """A bit for each digest of each block: whether it reaches ``least`` over all blocks of its range.

    Columns shard, deal, digests; all blocks of a range.
    """
    blocks = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
    if not blocks:
        return
    named, counts = zip(*(_unpack_digests(block, least) for _, _, block in blocks))
    ends = np.cumsum([len(x) for x in named])[:-1]
    named, counts = np.concatenate(named), np.concatenate(counts)
    order = np.argsort(named, kind="stable")
    first = np.append(True, np.diff(named[order]) > 0)
    reached = np.add.reduceat(counts[order], np.flatnonzero(first), dtype=np.int64) >= least
    known = np.empty(len(named), bool)
    known[order] = reached[np.cumsum(first) - 1]
    found = [(shard, deal, np.packbits(part).tobytes())
             for (shard, deal, _), part in zip(blocks, np.split(known, ends)) if part.any()]
    for at in range(0, len(found), ROWS):
        columns = zip(*found[at:at + ROWS])
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.binary()))],
                                         names=["shard", "deal", "known"])


def _shards(batches, limit, deal):
    """Shard rows of (lang, text) batches; the phrases of a shard's first level are its words."""
    part, made, open_, total = TaskContext.get().partitionId(), 0, {}, 0

    def close(lang):
        nonlocal made, total
        numbers, ids = open_.pop(lang)
        total -= len(ids)
        ids = np.frombuffer(ids, np.int32)
        counts = np.bincount(ids, minlength=len(numbers))
        counts[0] = 0
        order = np.argsort(-counts, kind="stable")      # common words get small ids, the break comes last
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(1, len(order) + 1)
        place[0] = 0
        names = list(numbers)
        words = [names[i].decode() for i in order[:-1]]
        made += 1
        phrases = np.arange(1, len(words) + 1).reshape(-1, 1)
        return _shard_rows(part << 32 | made, lang, words, _squeeze(place[ids]), phrases, counts[order[:-1]], deal)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            for run in _parts(text):
                numbers, ids = open_.setdefault(lang, (_Ids(), array("i")))
                before = len(ids)
                ids.extend(map(numbers.__getitem__, run.replace(BREAK, b" \xff ").split()))
                ids.append(0)
                total += len(ids) - before
                if total >= limit:
                    yield from close(max(open_, key=lambda x: len(open_[x][1])))
    for lang in list(open_):
        if len(open_[lang][0]) > 1:
            yield from close(lang)


class FmIndex:
    """Burrows-Wheeler transform of a circular id text, its rows sorted by their first ``depth`` ids.

    Steps from phrases of less than ``depth`` ids to phrases of one more are exact.
    """

    def __init__(self, text, depth):
        rank, width = text.astype(np.int64), 1
        while width < depth:
            step = min(width, depth - width)
            key = rank * (rank.max() + 1) + np.roll(rank, -step)
            width += step
            if width < depth:
                rank = np.unique(key, return_inverse=True)[1]
        self.rows = np.argsort(key, kind="stable").astype(np.int32)     # text position of each row
        del key, rank
        self.bwt = text[self.rows - 1]                  # the id before it
        order = np.argsort(self.bwt, kind="stable").astype(np.int32)
        self.before = np.empty_like(order)              # the row of the text that starts one id earlier
        self.before[order] = np.arange(len(order), dtype=np.int32)
        self.starts = np.append(0, np.cumsum(np.bincount(text)))
        # (id, row) in order: how often an id comes before a row is a place in this list
        self._seen = self.bwt[order].astype(np.int64) * len(text) + order if depth > 2 else None

    def find(self, phrases):
        """First row and number of rows of each phrase (a row of ids), by backward search."""
        low = self.starts[phrases[:, -1]]
        high = self.starts[phrases[:, -1] + 1]
        for ids in phrases[:, -2::-1].T.astype(np.int64) if phrases.shape[1] > 1 else ():
            low = np.searchsorted(self._seen, ids * len(self.bwt) + low)
            high = np.searchsorted(self._seen, ids * len(self.bwt) + high)
        return low, high - low

    def extend(self, low, size):
        """All one-id extensions of disjoint intervals: owner, id, first row, rows, and how many of the
        owner's rows extend by a smaller id (its offset in the other direction's index)."""
        owner = np.repeat(np.arange(len(low)), size)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        ids = self.bwt[at]
        # by owner, then id; the sort is stable, so rows stay in order
        order = np.argsort(owner * len(self.starts) + ids, kind="stable")
        owner, ids, at = owner[order], ids[order], at[order]
        first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1]))) if len(at) else order
        rows = np.diff(np.append(first, len(at)))
        owner, ids, start = owner[first], ids[first], self.before[at[first]]
        offset = first - (np.cumsum(size) - size)[owner]
        real = ids > 0
        return owner[real], ids[real], start[real], rows[real], offset[real]


def _covered(length, at, width):
    """Mask of the positions that phrases of ``width`` ids starting at ``at`` cover."""
    change = np.bincount(at, minlength=length + 1) - np.bincount(at + width, minlength=length + 1)
    return np.cumsum(change[:length]) > 0


def _spread(low, size):
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)


def extensions(ids, phrases, width):
    """Phrases of ``width`` + 1 ids whose first and last ``width`` are among ``phrases`` (rows of ids).

    Returns the counts of ``phrases``; the owner (a row of ``phrases``), the added id and the count of
    each extension, and the mask of the positions they cover.
    """
    forward, backward = FmIndex(ids, width + 1), FmIndex(ids[::-1], width + 1)
    low, size = forward.find(phrases)
    mirror, _ = backward.find(phrases[:, ::-1])
    kept = np.zeros(len(ids), bool)
    kept[_spread(mirror, size)] = True
    owner, added, start, count, offset = backward.extend(mirror, size)
    good = kept[start]
    owner, added, count = owner[good], added[good], count[good]
    places = forward.rows[_spread(low[owner] + offset[good], count)]
    return size, owner, added, count, _covered(len(ids), places, width + 1)


def _longer(batches, width, last, deal):
    """The shards' phrases that are ``known`` (by digest), and their extensions unless ``last``.

    Columns shard, lang, words, ids, phrases, known.
    """
    for batch in batches:
        for i in range(batch.num_rows):
            shard, lang, words, ids, phrases = (batch.column(c)[i].as_py() for c in range(5))
            ids, phrases = _unpack(ids), _unpack_phrases(phrases, width)
            words = zstandard.decompress(words).decode().split("\n")
            _, order, at = _dealt(lang, words, phrases, *deal[:2])
            known, dealt = np.zeros(len(phrases), bool), {}
            for part in batch.column(5)[i].as_py():
                named = order[at[part["deal"]]:at[part["deal"] + 1]]
                named = np.sort(named[np.unpackbits(np.frombuffer(part["known"], np.uint8), count=len(named)) > 0])
                known[named], dealt[part["deal"]] = True, named
            phrases, place = phrases[known], np.cumsum(known) - 1
            if last:
                counts, added = FmIndex(ids, width + 1).find(phrases)[1], ()
            else:
                counts, owner, added, more, covered = extensions(ids, phrases, width)
            found = []
            for named in dealt.values():
                part = [" ".join([words[k - 1] for k in p]) for p in phrases[place[named]].tolist()]
                found.append((zstandard.compress("\n".join(part).encode(), 1), _pack(counts[place[named]], np.int64)))
            yield _rows(shard, lang, len(found), deal=list(dealt), found=[x for x, _ in found], counts=[x for _, x in found])
            if len(added):
                ids = _squeeze(np.where(covered, ids, 0))
                used, ids = np.unique(ids, return_inverse=True)     # 0 stays 0, the order of ids stays
                phrases = np.searchsorted(used, np.column_stack([phrases[owner], added]))
                yield from _shard_rows(shard, lang, [words[k - 1] for k in used[1:]], ids, phrases, more, deal)


def _sums(batches, least):
    """(lang, phrase, f) of the phrases that reach ``least`` over all blocks of a range.

    Columns lang, found, counts; all blocks of a range.
    """
    sums = Counter()
    for batch in batches:
        for lang, found, counts in zip(*(c.to_pylist() for c in batch.columns)):
            for phrase, count in zip(zstandard.decompress(found).decode().split("\n"), _unpack(counts, np.int64).tolist()):
                sums[lang, phrase] += count
    rows = [(*key, f) for key, f in sums.items() if f >= least]
    for at in range(0, len(rows), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[at:at + ROWS])], names=["lang", "phrase", "f"])


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST,
                     shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of at most ``longest`` words and ``least`` occurrences,
    and (lang, n): the number of words of each language."""
    spark = docs.sparkSession
    small_batches(spark)
    bounded_batches(spark)
    texts = docs.where("text IS NOT NULL").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    length = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # digests of so many bits, dealt to so many ranges, counted up to least
    deal = (length.bit_length() + 1, length // DEAL_BYTES + 1, least)
    level = stored(texts.mapInArrow(lambda it: _shards(it, shard_words, deal), schema(SHARD)), "phrase-shards", "zstd")
    totals = stored(level.where("ids IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    found = []
    for size in range(1, longest + 1):
        known = (level.where("digests IS NOT NULL").select("shard", "deal", "digests").repartitionById(deal[1], "deal")
                 .mapInArrow(lambda it: _frequent(it, least), schema(REPLY))
                 .groupBy("shard").agg(F.collect_list(F.struct("deal", "known")).alias("known")))
        held = level.where("ids IS NOT NULL").select("shard", "lang", "words", "ids", "phrases").join(known, "shard")
        level = stored(held.mapInArrow(lambda it, size=size: _longer(it, size, size == longest, deal), schema(SHARD)),
                       f"phrase-shards-{size}", "zstd")
        sums = (level.where("found IS NOT NULL").repartitionById(deal[1], "deal").select("lang", "found", "counts")
                .mapInArrow(lambda it: _sums(it, least), schema(SUMS)))
        found.append(stored(sums.withColumn("size", F.lit(size)), f"phrases-{size}"))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole, totals


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two words or more.

    ``score`` is floor(1000 * a * n / (l * r)) of the phrase's weakest cut into two parts that occur
    l and r times.  A phrase that always stands inside a longer one is left out: it does if one word
    more, on either side, occurs as often.
    """
    phrases, totals = frequent_phrases(docs, longest, least, shard_words)
    words = F.split("phrase", " ")
    long = phrases.where("size > 1").select("lang", "phrase", F.col("f").alias("a"), "size", words.alias("words"))
    cuts = long.select("lang", "phrase", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    parts = phrases.select("lang", "phrase", "f")
    cuts = (cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
            .join(totals, "lang"))
    # exact beyond 64 bits: whole decimals of up to 38 digits
    cuts = cuts.withColumn("score", F.expr("(1000BD * CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0))) "
                                           "DIV (CAST(l AS DECIMAL(17, 0)) * CAST(r AS DECIMAL(17, 0)))"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    size = F.col("size")
    inner = long.where(size > 2).select("lang", "a", F.explode(F.array(
        F.array_join(F.slice("words", 1, size - 1), " "), F.array_join(F.slice("words", 2, size - 1), " "))).alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = best.join(covered, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = free.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


# DuckDB: the same rows by counting all phrases, and by looking for each phrase in every longer one.
PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM words),
grams AS (
  SELECT lang, d AS size, array_to_string(list_slice(w, i, i + d - 1), ' ') AS phrase
  FROM starts, generate_series(1, 5) AS g(d) WHERE i + d - 1 <= len(w)),
sums AS (SELECT lang, size, phrase, count(*)::BIGINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS left_part,
         array_to_string(list_slice(string_split(phrase, ' '), k + 1, size), ' ') AS right_part
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM sums WHERE size > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
         ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN sums x ON x.lang = c.lang AND x.phrase = c.left_part
  JOIN sums y ON y.lang = c.lang AND y.phrase = c.right_part JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
free AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM sums q WHERE q.lang = b.lang AND q.phrase <> b.phrase AND q.f >= b.a
      AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
