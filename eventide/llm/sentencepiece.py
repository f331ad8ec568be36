"""SentencePiece encoding and decoding by a max-plus parallel scan.

Encoding finds the segmentation of a text into vocabulary pieces with the largest sum of piece
scores; a character that no piece spells costs ``min score - 10`` and is written as byte pieces.
As in the library, a space is put before the text and spaces become U+2581.

A text longer than ``chunk`` characters is cut into chunks.  A piece may hang over a chunk's
end by fewer characters than the longest piece has, so a chunk is a max-plus matrix from the
overhang at its start to the overhang at its end.  Matrices are combined associatively, the
states of the best path are read back from the last boundary, and each chunk is traced on its
own between its two states.  Where a cut that no piece can cross lies in a chunk (a word start,
a character outside the vocabulary), its matrix is head + middle + tail, and the middle is
summed from its words.

Matrices of ``BLOCK`` neighbouring chunks are multiplied in one group, products again, until a
document's are one block; going back down, every block is traced between the states found
above.  So no group holds more than ``BLOCK`` matrices, however long a document is.  The
vocabulary (a fixed file) is broadcast as plain data.  Shorter texts, and the middles of chunks,
are coded by their words, each distinct word of a batch once and all of them together: pieces are
found from every character at once, and the best sums of all words grow character by character.

Decoding concatenates the pieces.  decode(encode(t)) == t for every text without U+2581, which
decodes as a space.

Defined results: a null or empty text has no pieces; among segmentations of one score the
choice is fixed for a given text and chunk size; repeated rows are encoded alike; the given
columns are passed on.

The scores are those in the model file.  For a file of merge rules (BPE) they are ranks, and
the best-scoring segmentation may differ from the one by merge order.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import schema, small_batches, stored
from eventide.llm.ppm import CodeMap

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
CHUNK = 1 << 15
BLOCK = 32                  # matrices multiplied in one group
LONG_WORD = 64              # characters; longer words are coded one by one
NONE = -np.inf


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str = MODEL):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes = [0] * 256
        self.pieces: dict[str, tuple[float, int]] = {}
        self.spell: list[bytes] = []
        for i in ids:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.spell.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spell.append(b"")
            else:
                self.pieces[piece] = (model.get_score(i), i)
                self.spell.append(piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.pieces))
        # each beginning of a piece, with the piece that it is itself, if any
        self.begun = {p[:n]: self.pieces.get(p[:n]) for p in self.pieces for n in range(1, len(p) + 1)}
        # the same as arrays: beginnings are numbered from 1, 0 is the empty one
        number = {p: k for k, p in enumerate(self.begun, 1)}
        self.edges = np.array([number.get(p[:-1], 0) << 21 | ord(p[-1]) for p in self.begun], np.int64)
        own = [(0.0, -1), *[x or (0.0, -1) for x in self.begun.values()]]
        self.node_score, self.node_id = np.array([x[0] for x in own]), np.array([x[1] for x in own], np.int32)
        self.unknown = min(s for s, _ in self.pieces.values()) - 10
        letters = set("".join(self.pieces))
        # no piece holds a space mark after another character: words are cut apart there
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.lone_newline = "\n" not in letters

    def plain(self) -> dict:
        """Attributes of built-in types: what is broadcast, so that workers need no class of ours."""
        return dict(vars(self))

    @classmethod
    def of(cls, plain: dict) -> Vocabulary:
        v = cls.__new__(cls)
        vars(v).update(plain)
        return v


class Coder:
    """Encoding and decoding with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        brk = "\n" if vocabulary.lone_newline else ""
        self.start = re.compile(f"(?<!{SPACE}){SPACE}" + ("|\n|(?<=\n)(?s:.)" if brk else ""))
        self.next = CodeMap(vocabulary.edges)
        first = vocabulary.edges >> 21 == 0
        self.first = np.zeros(0x110000, np.int32)
        self.first[vocabulary.edges[first]] = np.flatnonzero(first) + 1
        size = np.array([len(x) for x in vocabulary.spell], np.int64)
        self.spell_size, self.spell_at = size, np.cumsum(size) - size
        self.spell_bytes = np.frombuffer(b"".join(vocabulary.spell), np.uint8)
        self.byte_ids = np.array(vocabulary.bytes, np.int32)

    def steps(self, text: str, start: int, end: int):
        """Best score, and length of the last piece, for each place from ``start`` on."""
        get, longest = self.v.begun.get, self.v.longest
        best, back = [NONE] * (end - start + 1), [0] * (end - start + 1)
        best[0] = 0.0
        for i in range(start, end):
            here = best[i - start]
            if here == NONE:
                continue
            alone = False
            for n in range(1, min(longest, end - i) + 1):
                found = get(text[i:i + n], 0)
                if found == 0:          # no piece begins like this
                    break
                if found:
                    alone |= n == 1
                    if here + found[0] >= best[i + n - start]:
                        best[i + n - start], back[i + n - start] = here + found[0], n
            if not alone and here + self.v.unknown >= best[i + 1 - start]:
                best[i + 1 - start], back[i + 1 - start] = here + self.v.unknown, 1
        return best, back

    def trace(self, text: str, start: int, end: int, back: list[int]) -> list[int]:
        cuts, at = [], end
        while at > start:
            n = back[at - start]
            cuts.append(text[at - n:at])
            at -= n
        out: list[int] = []
        for piece in reversed(cuts):
            found = self.v.pieces.get(piece)
            out.extend([found[1]] if found else [self.v.bytes[b] for b in piece.encode()])
        return out

    def word(self, word: str) -> tuple[float, array]:
        best, back = self.steps(word, 0, len(word))
        return best[-1], array("i", self.trace(word, 0, len(word), back))

    def many(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each word, its number of ids, and the ids of all, one word after another.

        ``words`` are UTF-8 with spaces for space marks.
        """
        first, data = _bytes(words)
        letter = (data & 0xC0) != 0x80
        ends = np.append(0, np.cumsum(letter))[first]       # characters before each word
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        chars[chars == 32] = ord(SPACE)
        size = np.diff(ends)
        scores, counts = np.zeros(len(size)), np.zeros(len(size), np.int64)
        ids = [None] * len(size)
        for k in np.flatnonzero(size > LONG_WORD):
            scores[k], ids[k] = self.word("".join(map(chr, chars[ends[k]:ends[k + 1]])))
            counts[k] = len(ids[k])
        short = np.flatnonzero(size <= LONG_WORD)
        if len(short) < len(size):
            chars = chars[np.repeat(size <= LONG_WORD, size)]
        scores[short], counts[short], flat = self._together(chars, size[short])
        if len(short) == len(size):
            return scores, counts, flat
        cut = np.append(0, np.cumsum(counts[short]))
        for k, i, j in zip(short, cut[:-1], cut[1:]):
            ids[k] = flat[i:j]
        return scores, counts, np.concatenate([np.frombuffer(x, np.int32) for x in ids])

    def _together(self, chars: np.ndarray, size: np.ndarray):
        """``many`` for short words, from their characters and lengths: as ``steps`` and ``trace``."""
        starts = np.cumsum(size) - size
        inside = np.arange(len(chars)) - np.repeat(starts, size)
        left = np.repeat(size, size) - inside               # characters up to the word's end
        at, node = np.arange(len(chars)), self.first[chars]
        lone = self.v.node_id[node] >= 0
        froms, lengths, nodes = [at[lone]], [np.ones(int(lone.sum()), np.int8)], [node[lone]]
        for n in range(2, self.v.longest + 1):
            on = (node > 0) & (left[at] >= n)
            at, node = at[on], node[on]
            if not len(at):
                break
            node = self.next.find(node.astype(np.int64) << 21 | chars[at + n - 1]) + 1
            piece = self.v.node_id[node] >= 0
            froms.append(at[piece])
            lengths.append(np.full(len(froms[-1]), n, np.int8))
            nodes.append(node[piece])
        froms.append(np.flatnonzero(~lone))                 # node 0: a character that no piece spells
        lengths.append(np.ones(len(froms[-1]), np.int8))
        nodes.append(np.zeros(len(froms[-1]), np.int32))
        froms, lengths, nodes = map(np.concatenate, (froms, lengths, nodes))
        order = np.argsort(inside[froms].astype(np.int16), kind="stable")
        froms, lengths, nodes = froms[order], lengths[order], nodes[order]
        gain = np.where(nodes > 0, self.v.node_score[nodes], self.v.unknown)
        # a word has a place before each character and one at its end
        shift = np.repeat(np.arange(len(size)), size)
        source = froms + shift[froms]
        target = source + lengths
        best, back = np.full(len(chars) + len(size), NONE), np.zeros(len(chars) + len(size), np.int8)
        via = np.zeros(len(best), np.int32)
        origin = starts + np.arange(len(size))
        best[origin] = 0.0
        edges = np.append(0, np.cumsum(np.bincount(inside[froms])) if len(froms) else [])
        for i, j in zip(edges[:-1].astype(np.int64), edges[1:].astype(np.int64)):
            to = target[i:j]
            value = best[source[i:j]] + gain[i:j]
            won = value >= best[to]
            to = to[won]
            best[to], back[to], via[to] = value[won], lengths[i:j][won], nodes[i:j][won]
        used, now, begin = np.zeros(len(best), bool), origin + size, origin
        scores = best[now]
        while len(now):
            on = now > begin
            now, begin = now[on], begin[on]
            used[now] = True
            now = now - back[now]
        ends = np.flatnonzero(used)
        ids, word = self.v.node_id[via[ends]], np.searchsorted(origin, ends, "right") - 1
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):
            spelt = [chr(chars[k]).encode() for k in ends[unknown] - word[unknown] - 1]
            width = np.ones(len(ids), np.int64)
            width[unknown] = [len(x) for x in spelt]
            wide = np.zeros(len(ids), bool)
            wide[unknown] = True
            ids, word, wide = np.repeat(ids, width), np.repeat(word, width), np.repeat(wide, width)
            ids[wide] = self.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
        return scores, np.bincount(word, minlength=len(size)), ids

    def _kinds(self, data: np.ndarray, begins: np.ndarray, end: int):
        """Distinct words of a text's bytes, and which of them stands at each of ``begins``."""
        edges = np.append(begins, end)
        words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(edges), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)

    def _placed(self, size: np.ndarray, flat: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the kinds in the order ``which``, and where each one's end."""
        at, n = (np.cumsum(size) - size)[which], size[which]
        ends = np.append(0, np.cumsum(n))
        return flat[np.repeat(at - ends[:-1], n) + np.arange(ends[-1])], ends

    def _spelt(self, kinds: pa.Array, size: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Whether the ids of each word, decoded, are its bytes."""
        first, data = _bytes(kinds)
        out, ends = self._placed(self.spell_size, self.spell_bytes, flat)
        ends = ends[np.append(0, np.cumsum(size))]
        fits = np.diff(ends) == np.diff(first)
        if fits.all():
            differs = np.append(0, np.cumsum(out != data))
            return differs[first[1:]] == differs[first[:-1]]
        data, out = data.tobytes(), out.tobytes()
        return np.array([out[i:j] == data[k:m] for i, j, k, m in zip(ends[:-1], ends[1:], first[:-1], first[1:])])

    def run(self, marked: str) -> tuple[float, array]:
        """Score and ids of a text between two cuts."""
        if not marked:
            return 0.0, array("i")
        if not self.v.by_word:
            return self.word(marked)
        data = np.frombuffer(marked.replace(SPACE, " ").encode(), np.uint8)
        begins = _word_starts(data, np.array([0, len(data)]), self.v.lone_newline)
        kinds, which = self._kinds(data, begins, len(data))
        scores, size, flat = self.many(kinds)
        # summed word by word, in order
        return float(np.cumsum(scores[which])[-1]), array("i", self._placed(size, flat, which)[0].tobytes())

    def texts(self, texts: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """Ids of whole texts, and whether their words spell them.

        The words of all texts are one array over the texts' own bytes; each distinct word is
        coded, and decoded again, once, and its ids are copied to where it stands.
        """
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE, " ")
        full = pc.greater(pc.binary_length(texts), 0)
        blank, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        texts = pc.if_else(full, pc.binary_join_element_wise(blank, texts, none), texts)
        first, data = _bytes(texts)
        begins = _word_starts(data, first, self.v.lone_newline) if self.v.by_word else first[:-1][np.diff(first) > 0]
        kinds, which = self._kinds(data, begins, first[-1])
        _, size, flat = self.many(kinds)
        ids, ends = self._placed(size, flat, which)
        # words before each text's first byte
        word = np.searchsorted(begins, first)
        wrong = np.append(0, np.cumsum(~self._spelt(kinds, size, flat)[which]))
        out = pa.ListArray.from_arrays(pa.array(ends[word].astype(np.int32)), pa.array(ids, pa.int32()))
        return out, wrong[word[1:]] == wrong[word[:-1]]

    def cuts(self, marked: str, end: int) -> tuple[int, int] | None:
        """First and last place in 1..end that no piece can cross (what stands before the
        chunk is not known here, so its own start is none)."""
        if not self.v.by_word:
            return None
        found = self.start.search(marked, 1, end + 1)
        if not found:
            return None
        last = min(end, len(marked) - 1)
        while not self.start.match(marked, last):
            last -= 1
        return found.start(), last

    def matrix(self, marked: str, size: int) -> np.ndarray:
        """Best score from each overhang at the start to each overhang at the end of a chunk.

        ``marked`` is the chunk's ``size`` characters and the few after it that pieces reach.
        """
        m = self.v.longest
        out = np.full((m, m), NONE)
        found = self.cuts(marked, size)
        ends = min(m - 1, len(marked) - size)
        if found is None:
            for i in range(min(m, len(marked) + 1)):
                best, _ = self.steps(marked, i, size + ends)
                for j in range(ends + 1):
                    if size + j >= i:
                        out[i, j] = best[size + j - i]
            return out
        first, last = found
        middle, _ = self.run(marked[first:last])
        tail, _ = self.steps(marked, last, size + ends)
        for i in range(min(m, first + 1)):
            best, _ = self.steps(marked, i, first)
            for j in range(ends + 1):
                out[i, j] = best[-1] + middle + tail[size + j - last]
        return out

    def between(self, marked: str, entry: int, leave: int) -> array:
        """Ids of the best path between two places of a chunk."""
        found = self.cuts(marked, leave)
        if found is None or found[0] < entry:
            _, back = self.steps(marked, entry, leave)
            return array("i", self.trace(marked, entry, leave, back))
        first, last = found
        _, back = self.steps(marked, entry, first)
        ids = array("i", self.trace(marked, entry, first, back))
        ids.extend(self.run(marked[first:last])[1])
        _, back = self.steps(marked, last, leave)
        ids.extend(self.trace(marked, last, leave, back))
        return ids

    def encode(self, text: str) -> array:
        return self.run(mark(text))[1]

    def decode(self, ids) -> str:
        spell = self.v.spell
        out = b"".join([spell[i] for i in ids]).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


def mark(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the texts of an array without nulls, and their bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    first = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return first - first[0], body[first[0]:first[-1]]


def _word_starts(data: np.ndarray, first: np.ndarray, lone_newline: bool) -> np.ndarray:
    """Places where words begin: texts, blank runs, and newlines that stand alone and what follows."""
    blank = data == 32
    begin = blank.copy()
    begin[1:] &= ~blank[:-1]
    if lone_newline:
        line = data == 10
        begin |= line
        begin[1:] |= line[:-1]
    begin[first[:-1][np.diff(first) > 0]] = True
    return np.flatnonzero(begin)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product: best sum over the state between two stretches of text."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def path_states(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """State at every boundary of the best path through ``matrices`` between two states."""
    m = len(matrices[0])
    forward = [np.where(np.arange(m) == entry, 0.0, NONE)]
    for t in matrices[:-1]:
        forward.append((forward[-1][:, None] + t).max(axis=0))
    states = [leave]
    for t, before in zip(matrices[::-1], forward[::-1]):
        states.append(int((before + t[:, states[-1]]).argmax()))
    return states[::-1]


def _square(cells: bytes, size: int) -> np.ndarray:
    return np.frombuffer(cells).reshape(size, size)


def _in_order(table: pa.Table) -> pa.Table:
    return table.take(pa.array(np.argsort(table["chunk"].to_numpy(), kind="stable")))


def scan(matrices: DataFrame, size: int, chunks: int, block: int = BLOCK) -> DataFrame:
    """(k, c, entry, over): states of the best path at both ends of every chunk.

    ``matrices`` (key, chunk, matrix) has at most ``chunks`` chunks a key.  Upwards, ``block``
    neighbours are multiplied into one matrix a round, until a key's matrices are a block;
    downwards, each block is traced on its own between the states of the round above.  A group
    is one block, never a document.
    """
    levels = [matrices]
    while chunks > block:
        def multiply(table):
            table = _in_order(table)
            out = None
            for cells in table["matrix"]:
                m = _square(cells.as_py(), size)
                out = m if out is None else product(out, m)
            return pa.table({"key": table["key"][:1], "chunk": table["block"][:1],
                             "matrix": pa.array([out.tobytes()], pa.binary())})
        rows = levels[-1].withColumn("block", F.floor(F.col("chunk") / block).cast("long"))
        levels.append(stored(rows.groupBy("key", "block").applyInArrow(
            multiply, schema("key long, chunk long, matrix binary")), "products"))
        chunks = -(-chunks // block)

    def trace(table):
        table = _in_order(table)
        found = path_states([_square(x.as_py(), size) for x in table["matrix"]],
                            table["enter"][0].as_py(), table["leave"][0].as_py())
        return pa.table({"k": table["key"], "c": table["chunk"],
                         "entry": pa.array(found[:-1], pa.int64()), "over": pa.array(found[1:], pa.int64())})

    out = schema("k long, c long, entry long, over long")
    zero = F.lit(0).cast("long")
    states = None
    for rows in levels[::-1]:
        rows = rows.withColumn("block", F.floor(F.col("chunk") / block).cast("long"))
        if states is None:
            rows = rows.withColumns({"enter": zero, "leave": zero})
        else:
            above = states.select("k", "c", F.col("entry").alias("enter"), F.col("over").alias("leave"))
            rows = rows.join(above, (F.col("key") == F.col("k")) & (F.col("block") == F.col("c"))).drop("k", "c")
        states = rows.groupBy("key", "block").applyInArrow(trace, out)
    return states


def _list(ids: list) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
    flat = np.concatenate([np.frombuffer(x, np.int32) for x in ids if len(x)] or [np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _slices(batches, at, limit: int = 4 << 20):
    """Batches cut to about ``limit`` bytes of text (a longer text is one of its own)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        run = np.cumsum(size) // limit
        edges = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if len(run) else []
        for i, j in zip(edges, [*edges[1:], len(run)]):
            yield batch.slice(i, j - i)


def _chunks(batches, at, size, reach):
    """(key, chunk, body size, characters of the chunk and of its reach)."""
    for batch in batches:
        rows = []
        for key, text in zip(batch.column(at[0]).to_pylist(), batch.column(at[1]).to_pylist()):
            marked = mark(text)
            for k, start in enumerate(range(0, len(marked), size)):
                body = min(size, len(marked) - start)
                rows.append((key, k, body, marked[start:start + body + reach]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 4,
                                            (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
            names=["key", "chunk", "body", "marked"])


def encode(docs: DataFrame, model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with n_pieces, ids, n_chunks and round_trip (decoding gives the text back)."""
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = Vocabulary(model)
    reach = vocabulary.longest - 1
    shared = spark.sparkContext.broadcast(vocabulary.plain())
    added = ("n_pieces", "ids", "n_chunks", "round_trip")
    docs = docs.select(*[c for c in docs.columns if c not in added])
    at = docs.columns.index("text")
    long_text = F.length(F.coalesce("text", F.lit(""))) >= chunk

    def whole(batches):
        coder = Coder(Vocabulary.of(shared.value))
        for batch in _slices(batches, at):
            texts = pc.fill_null(batch.column(at), "")
            ids, same = coder.texts(texts)
            # the space mark itself is decoded as a space
            same = pc.and_not(pa.array(same), pc.match_substring(texts, SPACE))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pc.list_value_length(ids).cast(pa.int64()), ids,
                 pc.greater(pc.binary_length(texts), 0).cast(pa.int64()), same],
                names=[*batch.schema.names, *added])

    more = schema("n_pieces long, ids array<int>, n_chunks long, round_trip boolean")
    short = docs.where(~long_text).mapInArrow(whole, T.StructType([*docs.schema.fields, *more.fields]))

    # texts of many chunks
    giants = stored(docs.where(long_text).select(F.struct("*").alias("row"), F.col("text").alias("body_text"))
                    .withColumn("key", F.monotonically_increasing_id()), "giants")
    parts = giants.select("key", "body_text").mapInArrow(
        lambda it: _chunks(it, (0, 1), chunk, reach), schema("key long, chunk long, body long, marked string"))
    parts = stored(parts.repartition("key", "chunk"), "chunks")

    def matrices(batches):
        coder = Coder(Vocabulary.of(shared.value))
        for batch in batches:
            out = [coder.matrix(t, n).tobytes() for n, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["key", "chunk", "matrix"])

    made = stored(parts.mapInArrow(matrices, schema("key long, chunk long, matrix binary")), "matrices")
    most = made.agg(F.coalesce(F.max("chunk"), F.lit(0)) + 1).first()[0]
    states = scan(made, vocabulary.longest, most)
    placed = parts.join(states, (F.col("key") == F.col("k")) & (F.col("chunk") == F.col("c")))
    placed = placed.select("key", "chunk", "body", "marked", "entry", "over")

    def traced(batches):
        coder = Coder(Vocabulary.of(shared.value))
        for batch in batches:
            ids, same = [], []
            for body, marked, entry, over in zip(*[batch.column(i).to_pylist() for i in range(2, 6)]):
                x = coder.between(marked, entry, body + over)
                ids.append(x)
                spelt = b"".join([coder.v.spell[i] for i in x]).decode("utf-8", "replace")
                same.append(spelt == marked[entry:body + over].replace(SPACE, " "))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _list(ids), pa.array(same, pa.bool_())],
                                             names=["key", "chunk", "ids", "same"])

    traces = placed.mapInArrow(traced, schema("key long, chunk long, ids array<int>, same boolean"))
    joined = traces.groupBy(F.col("key").alias("k")).agg(
        F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("x"), F.min("same").alias("same"))
    has_mark = F.contains(F.col("body_text"), F.lit(SPACE))
    giants = (giants.join(joined, F.col("key") == F.col("k"))
              .withColumn("ids", F.flatten(F.transform("x", lambda s: s["ids"])))
              .select("row.*", F.size("ids").cast("long").alias("n_pieces"), "ids",
                      F.size("x").cast("long").alias("n_chunks"), (F.col("same") & ~has_mark).alias("round_trip")))
    return short.unionByName(giants)


def decode(coded: DataFrame, model: str = MODEL, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the text of its piece ids (null ids: null)."""
    spark = coded.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(model).plain())

    @F.pandas_udf("string")
    def text(column):
        coder = Coder(Vocabulary.of(shared.value))
        return column.map(lambda x: None if x is None else coder.decode(x))

    return coded.withColumn(out, text(F.col(ids)))
