"""SentencePiece encoding by sampled segmentations, and lossless decoding.

A text is drawn a segmentation from the lattice of all ways to cut it into pieces: forward
filtering sums the weights of all paths to each place, and backward sampling picks, from
the end, each last piece with the share of the paths that end in it. A piece weighs
(rank + RANK_SHIFT) ** -alpha, where rank is its place in the vocabulary file: a
Zipf-Mandelbrot curve in place of the probabilities that a file of merges doesn't hold.

No piece has a space behind another character, so each run of spaces begins a unit that
every path enters at its start: the lattice of a text is the chain of those of its units.
A worker filters a unit's lattice once and keeps the cumulative shares of the edges into
each place as integers; the sampling of all units of a slice of rows then goes on in step,
one binary search for each piece drawn. Random numbers are hashes of the seed, the row key
and the place in the text, so a row's segmentation depends on nothing else: not on
partitions, batches, retries, or what a cache holds.

A character that is no piece is spelt by its UTF-8 bytes, with the weight of one piece. A literal U+2581, the mark that
pieces have for a space, is spelt by bytes too, which keeps decoding lossless.

Defined results: a null text gives null pieces, an empty one none; a null key counts as
the smallest 64-bit integer; repeated rows give equal results; other columns are not read
by encode(), and with_pieces() passes them on, whatever their names; an empty table gives
an empty one.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from corpusmill.llm.common import beside, named, restored, slices, unused, worker_state

MARK = "▁"
RANK_SHIFT = 100
UNIT = re.compile(" +[^ ]*")
SLICE_CHARS = 500_000
#: Bounds of a worker's cache, and the characters of units that are filtered many at a time.
UNITS, EDGES = 250_000, 4_500_000
SHORT = 48
SCALE = 512.0
NO_KEY = -(1 << 63)

_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Pieces:
    """A piece file: the weights of its pieces as surfaces, and the bytes each id stands for.

    Weights are those of the docstring times SCALE to the piece's length. All paths to a
    place are equally long, so that changes no share, and keeps sums within range.
    """

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.weight: dict[str, tuple[int, float]] = {}
        self.bytes = [b""] * sp.vocab_size()
        self.byte_id = [0] * 256
        first = next(i for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)))
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes[i], self.byte_id[value] = bytes([value]), i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                surface = piece.replace(MARK, " ")
                self.bytes[i] = surface.encode()
                self.weight[surface] = (i, (i - first + RANK_SHIFT) ** -alpha * SCALE ** len(surface))
        if any(" " in p.lstrip(" ") for p in self.weight):
            raise ValueError("a piece goes on behind a space, so the units of a text are not independent")
        self.longest = max(map(len, self.weight))
        #: Of a character that no piece is: spelt out by its bytes.
        self.spelt = (sp.vocab_size() + RANK_SHIFT) ** -alpha * SCALE
        self.tables, self.maybe = [], np.zeros(1 << 20, bool)
        for k in range(1, self.longest + 1):
            surfaces = [p for p in self.weight if len(p) == k]
            h = np.zeros(len(surfaces), np.uint64)
            codes = np.frombuffer("".join(surfaces).encode("utf-32-le"), np.uint32).reshape(-1, k)
            for column in codes.T:
                h = (h + column) * _K[0]
            h = mix(h)
            order = np.argsort(h)
            self.maybe[h >> np.uint64(44)] = True
            self.tables.append((h[order], np.array([self.weight[p][0] for p in surfaces], np.int32)[order], np.array([self.weight[p][1] for p in surfaces])[order]))

    def one(self, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As many(), for one unit of any length; weights are rescaled on the way."""
        sums, out = [1.0], ([], [], [], [])
        for end in range(1, len(unit) + 1):
            edges = [(end - start, *self.weight[unit[start:end]]) for start in range(max(0, end - self.longest), end) if unit[start:end] in self.weight]
            if unit[end - 1] not in self.weight:
                edges.append((1, -1, self.spelt))
            run, here = 0.0, []
            for k, _, w in edges:
                run += sums[-k] * w
                here.append(run)
            for (k, piece, _), x in zip(edges, here, strict=True):
                for column, v in zip(out, (end, min(int(x / run * (1 << 32)), 1 << 32) if x < run else 1 << 32, k, piece), strict=True):
                    column.append(v)
            out[1][-1] = 1 << 32
            sums.append(run)
            del sums[: -self.longest - 1]
            if not 2.0**-400 < run < 2.0**400:
                power = 2.0 ** -math.frexp(run)[1]
                sums = [x * power for x in sums]
        return tuple(np.array(x, np.int64) for x in out)

    def many(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward filtering of short units at once: of each edge its node, the upper bound of
        its share in 32-bit units, its length and its piece id (-1: spelt out). A unit has one
        node more than characters; nodes are numbered unit by unit, edges in order of nodes."""
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        unit = np.repeat(np.arange(len(units)), sizes)
        stop = np.cumsum(sizes)[unit]
        live, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        single = np.zeros(len(codes), bool)
        found = []
        for k, (hashes, ids, weights) in enumerate(self.tables, 1):
            if k > 1:
                stay = live + k <= stop[live]
                live, h = live[stay], h[stay]
            h = (h + codes[live + k - 1]) * _K[0]
            m = mix(h)
            near = np.flatnonzero(self.maybe[m >> np.uint64(44)])
            at = np.searchsorted(hashes, m[near])
            at[at == len(hashes)] = 0
            hit = hashes[at] == m[near] if len(hashes) else np.zeros(len(near), bool)
            start = live[near[hit]]
            if k == 1:
                single[start] = True
            found.append((start, np.full(len(start), k), ids[at[hit]], weights[at[hit]]))
        start = np.flatnonzero(~single)
        found.append((start, np.ones(len(start), np.int64), np.full(len(start), -1, np.int32), np.full(len(start), self.spelt)))
        start, length, piece, weight = (np.concatenate(x) for x in zip(*found, strict=True))
        source = start + unit[start]
        node = source + length
        place = node - (np.cumsum(sizes) - sizes + np.arange(len(units)))[unit[start]]
        order = np.argsort((place * (len(codes) + len(units)) + node) * 32 - length)
        source, node, place, length, piece, weight = (x[order] for x in (source, node, place, length, piece, weight))
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        degree = np.diff(np.append(first, len(node)))
        sums, score = np.ones(len(codes) + len(units)), np.empty(len(node))
        cuts = np.searchsorted(place, np.arange(1, (place[-1] if len(place) else 0) + 2))
        groups = np.searchsorted(first, cuts)
        for a, b, i, j in zip(cuts.tolist(), cuts[1:].tolist(), groups.tolist(), groups[1:].tolist(), strict=False):
            part = sums[source[a:b]] * weight[a:b]
            score[a:b] = part
            sums[node[first[i:j]]] = np.add.reduceat(part, first[i:j] - a)
        row = np.repeat(np.arange(len(first)), degree)
        column = np.arange(len(node)) - first[row]
        table = np.zeros((len(first), int(degree.max())))
        table[row, column] = score
        run = np.cumsum(table, axis=1)
        bound = (run[row, column] / run[row, -1] * (1 << 32)).astype(np.int64)
        bound[first + degree - 1] = 1 << 32
        order = np.argsort(node * 32 - length)
        return node[order], bound[order], length[order], piece[order]


class Sampler:
    """Filtered lattices of units, laid end to end, and the sampling over them."""

    def __init__(self, path: str, alpha: float = 1.0):
        self.pieces = Pieces(path, alpha)
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.ends, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the last node of each unit, and its characters
        self.nodes = self.edges = 0
        self.keys, self.lengths, self.ids = np.empty(1 << 16, np.uint64), np.empty(1 << 16, np.int8), np.empty(1 << 16, np.int32)

    def add(self, units: list[str]) -> None:
        """Filters the lattices of units, each without its first space, and lays them behind the others."""
        short = [u for u in units if len(u) < SHORT]
        if short:
            self.lay(short, self.pieces.many([" " + u for u in short]))
        for u in units:
            if len(u) >= SHORT:
                self.lay([u], self.pieces.one(" " + u))

    def lay(self, units: list[str], edges: tuple[np.ndarray, ...]) -> None:
        node, bound, length, piece = edges
        n, m = self.edges, self.edges + len(node)
        if m > len(self.keys):
            room = max(len(self.keys) * 3 // 2, m)
            self.keys, self.lengths, self.ids = (np.concatenate([x[:n], np.empty(room - n, x.dtype)]) for x in (self.keys, self.lengths, self.ids))
        self.keys[n:m] = ((node + self.nodes) << 32) + bound
        self.lengths[n:m], self.ids[n:m] = length, piece
        self.edges = m
        sizes = np.fromiter(map(len, units), np.int64, len(units)) + 1
        self.index.update(zip(units, range(len(self.ends), len(self.ends) + len(units)), strict=True))
        self.ends = np.concatenate([self.ends, self.nodes + np.cumsum(sizes + 1) - 1])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.nodes += int(sizes.sum()) + len(units)

    def sample(self, keys: np.ndarray, batch: list[str], seed: int) -> list[np.ndarray]:
        """The drawn ids of each text."""
        if len(self.index) > UNITS or self.edges > EDGES:
            self.reset()
        units = [t.split(" ") if "  " not in t and t[-1:] != " " and t[:1] != " " else [u[1:] for u in UNIT.findall(" " + t)] for t in batch]
        units = [u if t else [] for u, t in zip(units, batch, strict=True)]
        index = self.index
        new = {x for u in units for x in u if x not in index}
        if new:
            self.add(list(new))
        counts = np.array([len(u) for u in units], np.int64)
        uid = np.fromiter(map(index.__getitem__, chain.from_iterable(units)), np.int64, int(counts.sum()))
        with np.errstate(over="ignore"):
            row = mix(np.asarray(keys, np.int64).view(np.uint64) * _K[0] + np.uint64(seed % (1 << 64)))
            place = np.arange(len(uid)) - np.repeat(np.cumsum(counts) - counts, counts)
            state = mix(np.repeat(row, counts) + place.astype(np.uint64) * _K[1])
        node = self.ends[uid]
        begin = node - self.sizes[uid]
        # in order of units, so that the searches go through the edges from front to back
        live, step, drawn, keys = np.argsort(uid), 0, [], self.keys[: self.edges]
        while len(live):
            with np.errstate(over="ignore"):
                u = mix(state[live] + np.uint64(step) * _K[2]) >> np.uint64(32)
            edge = np.searchsorted(keys, (node[live].astype(np.uint64) << np.uint64(32)) | u, side="right")
            drawn.append((live, edge))
            node[live] -= self.lengths[edge]
            live = live[node[live] > begin[live]]
            step += 1
        # an edge drawn at step s is the s-th from its unit's end
        steps = np.zeros(len(uid), np.int64)
        for live, _ in drawn:
            steps[live] += 1
        offsets = np.concatenate([[0], np.cumsum(steps)])
        edges = np.empty(offsets[-1], np.int64)
        for s, (live, edge) in enumerate(drawn):
            edges[offsets[live + 1] - 1 - s] = edge
        ids = self.ids[edges]
        cuts = offsets[np.concatenate([[0], np.cumsum(counts)])]
        out = []
        for k, t in enumerate(batch):
            part = ids[cuts[k] : cuts[k + 1]]
            out.append(self.spelt(t, part, self.lengths[edges[cuts[k] : cuts[k + 1]]]) if (part < 0).any() else part)
        return out

    def spelt(self, text: str, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """ids with the bytes of the characters that are no piece in place of -1."""
        whole, at = " " + text, np.cumsum(lengths) - lengths
        out: list[int] = []
        last = 0
        for k in np.flatnonzero(ids < 0).tolist():
            out += ids[last:k].tolist()
            out += [self.pieces.byte_id[b] for b in whole[at[k]].encode()]
            last = k + 1
        return np.array(out + ids[last:].tolist(), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; their first character is the space that begins every text."""
        return b"".join(map(self.pieces.bytes.__getitem__, ids.tolist()))[1:].decode()


def sampler(path: str, alpha: float) -> Sampler:
    return worker_state("piece_sampling", (path, alpha), lambda: Sampler(path, alpha))


def _slices(batch: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of a batch with about SLICE_CHARS characters each."""
    start = size = 0
    for i, t in enumerate(batch):
        if size and size + len(t) > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if batch:
        yield start, len(batch)


def _drawn(path: str, alpha: float, seed: int, keys: pa.Array, texts: list[str | None]) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    key = keys.cast(pa.int64()).fill_null(NO_KEY).to_numpy(zero_copy_only=False)
    batch = [t or "" for t in texts]
    draw = sampler(path, alpha)
    for a, b in _slices(batch):
        yield a, b, draw.sample(key[a:b], batch[a:b], seed)


def encode(docs: DataFrame, path: str, seed: int = 0, alpha: float = 1.0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the drawn piece ids of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            raw = batch.column(1).to_pylist()
            for a, b, ids in _drawn(path, alpha, seed, batch.column(0), raw):
                lists = [None if raw[a + k] is None else x for k, x in enumerate(ids)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(lists, pa.list_(pa.int32()))], names=["doc_id", "pieces"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, pieces array<int>")


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", pieces: str = "pieces") -> DataFrame:
    """doc_id and the text of the piece ids of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = sampler(path, 1.0)
        for batch in batches:
            texts = [None if x is None else draw.decode(np.array(x, np.int32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(doc_id).cast("long").alias("doc_id"), pieces).mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, seed: int = 0, alpha: float = 1.0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, n_pieces, pieces_crc32 and whether decoding gives the text again, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            raw = batch.column(1).to_pylist()
            draw = sampler(path, alpha)
            for a, b, ids in _drawn(path, alpha, seed, batch.column(0), raw):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(t or "") for t in raw[a:b]], pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                        pa.array([draw.decode(x) == (t or "") for x, t in zip(ids, raw[a:b], strict=True)], pa.bool_()),
                    ],
                    names=["doc_id", "n_chars", "n_pieces", "pieces_crc32", "lossless"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, n_pieces long, pieces_crc32 long, lossless boolean")


def with_pieces(docs: DataFrame, path: str, seed: int = 0, alpha: float = 1.0, doc_id: str = "doc_id", text: str = "text", name: str = "pieces") -> DataFrame:
    """docs with the drawn ids as a further column, and text as decoded from them.

    Where docs has a column of that name, the new one gets underscores behind it.
    """
    name = unused(name, docs.columns)
    rows = beside(docs, named(doc_id).cast("long").alias("doc_id"), named(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            raw = batch.column(2).to_pylist()
            draw = sampler(path, alpha)
            for a, b, ids in _drawn(path, alpha, seed, batch.column(1), raw):
                decoded = pa.array([None if t is None else draw.decode(x) for x, t in zip(ids, raw[a:b], strict=True)], batch.schema.field(2).type)
                lists = pa.array([None if t is None else x for x, t in zip(ids, raw[a:b], strict=True)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), decoded, lists], names=["row", "text", "pieces"])

    schema = StructType([rows.schema["row"], rows.schema["text"], StructField("pieces", ArrayType(IntegerType()))])
    return restored(rows.mapInArrow(run, schema), docs.columns, **{text: F.col("text"), name: F.col("pieces")})
