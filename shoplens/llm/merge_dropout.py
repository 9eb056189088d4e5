"""SentencePiece (merge type) encoding with seeded merge-dropout, and lossless decoding.

A text is normalised as the model says (a space in front, spaces as U+2581)
and cut into parts in front of spaces and around line ends, where no piece of
the vocabulary goes on, so merges never cross.  In each part the agenda pops
the best pair of neighbours (ties: the left one); a keyed hash of seed,
variant, whole text, the part's place in it and the number of the pop decides
whether this merge is skipped.  So every occurrence of a word draws for every
candidate merge anew.  The same seed always gives the same ids; another seed
(or variant: documents are spread over ``variants`` of them) gives another
segmentation.  At rate 0 the ids are those of the library.  Characters without
a piece, and U+2581 itself, are spelled in byte pieces, so every text decodes
to itself.

The agendas of many parts run side by side, one array row each: a step pops
the best pair of every row.  Very long parts use a heap.  What is cached (and
emptied when full) is free of draws: a part's ids and number of pops when
nothing is skipped.

Defined results: NULL text is the empty text (no ids); repeated rows are
encoded alike; a NULL id uses variant 0; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import ship_package
from shoplens.llm.tokens import ID_BYTES

SPACE = "▁"
MARK = "\ud800"  # stands for a real U+2581; no text of Spark holds a surrogate
WORD = 2**64 - 1
PLACE_STEP, POP_STEP = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
NONE = np.int32(2**31 - 1)
WIDTHS = (6, 9, 13, 20, 32, 48)  # characters of the parts that run side by side
ROWS = 8192
PARTS = 100_000  # parts of texts encoded at a time


class PairTable:
    """Pairs of symbols and what they merge to (``none``: they do not), as a hash table in arrays.

    Symbols are at most ``none`` + 1; small vocabularies have 32-bit keys.
    """

    def __init__(self, pairs: dict[tuple[int, int], int], none: int):
        self.none, self.shift = none, (none + 2).bit_length()
        self.word, self.signed = (np.uint32, np.int32) if 2 * self.shift < 32 else (np.uint64, np.int64)
        self.step = self.word(PLACE_STEP >> 32 if self.word is np.uint32 else PLACE_STEP)
        bits = max(4, (8 * max(1, len(pairs)) - 1).bit_length())
        self.drop = self.word(8 * np.dtype(self.word).itemsize - bits)
        self.keys = np.full((1 << bits) + len(pairs) + 1, -1, dtype=self.signed)
        self.values = np.full(len(self.keys), none, dtype=np.int32)
        left, right = (np.array([k[side] for k in pairs], dtype=self.signed) for side in (0, 1))
        keys, values = left << self.shift | right, np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slots(keys)
        while len(keys):  # each free slot takes one key, the others go to the next slot
            _, first = np.unique(slots, return_index=True)
            first = first[self.keys[slots[first]] < 0]
            self.keys[slots[first]], self.values[slots[first]] = keys[first], values[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, slots = keys[rest], values[rest], slots[rest] + 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(self.word) * self.step) >> self.drop).astype(np.intp)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each pair merges to."""
        keys = left.astype(self.signed) << self.shift | right
        slots = self._slots(keys)
        found, out = self.keys[slots], self.values[slots]
        wrong = np.flatnonzero(found != keys)
        out[wrong] = self.none
        wrong = wrong[found[wrong] >= 0]
        while len(wrong):  # a taken slot: the next one may hold the key
            slots[wrong] += 1
            found = self.keys[slots[wrong]]
            hit = found == keys[wrong]
            out[wrong[hit]] = self.values[slots[wrong[hit]]]
            wrong = wrong[~hit & (found >= 0)]
        return out


class Vocabulary:
    """Pieces and scores of a merge-type SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = sp = SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        self.ids, self.byte_ids, self.surface, scores = {}, {}, [], {}
        for i, name in enumerate(names):
            raw = b""
            if sp.is_byte(i):
                raw = bytes([int(name[3:5], 16)])
                self.byte_ids[raw[0]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[name], scores[name] = i, sp.get_score(i)
                raw = name.replace(SPACE, " ").encode()
            self.surface.append(raw)
        self.surfaces = np.frombuffer(b"".join(self.surface), np.uint8)
        self.surface_ends = np.concatenate([[0], np.cumsum([len(x) for x in self.surface])])
        # symbols are token ids; size stands for a character without a piece
        self.size = size
        ranks = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = np.full(size + 1, NONE, dtype=np.int32)
        self.symbol = np.full(0x110000, size, dtype=np.int32)
        for name, i in self.ids.items():
            self.rank[i] = ranks[scores[name]]
            if len(name) == 1:
                self.symbol[ord(name)] = i
        self.merged = {
            (self.ids[name[:k]], self.ids[name[k:]]): i
            for name, i in self.ids.items()
            for k in range(1, len(name))
            if name[:k] in self.ids and name[k:] in self.ids
        }
        self.pairs = PairTable(self.merged, size)
        meets = {name[k : k + 2] for name in self.ids for k in range(len(name) - 1)}
        # where no piece goes on: in front of spaces and around line ends
        cuts = not any("\n" in x or (x[1] == SPACE and x[0] != SPACE) for x in meets)
        self.cut = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+") if cuts else None

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        if SPACE in text:
            text = text.replace(SPACE, MARK)
        text = SPACE + text.replace(" ", SPACE)
        return self.cut.findall(text) if self.cut else [text]

    def symbols(self, part: str) -> tuple[np.ndarray, np.ndarray]:
        """The symbol and the code point of every character."""
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.symbol[points], points

    def ids_of(self, symbols: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of final symbols, and how many each has; ``points`` are their first code points."""
        odd = np.flatnonzero(symbols == self.size)
        n = np.ones(len(symbols), dtype=np.int64)
        if not len(odd):
            return symbols.astype("<u4"), n
        spelled = {}
        for point in np.unique(points[odd]).tolist():
            c = chr(point)
            spelled[point] = [self.byte_ids[b] for b in (SPACE if c == MARK else c).encode("utf-8", "surrogatepass")]
        n[odd] = [len(spelled[c]) for c in points[odd].tolist()]
        ids = np.repeat(symbols, n).astype("<u4")
        ends = np.cumsum(n)
        for end, point in zip(ends[odd].tolist(), points[odd].tolist()):
            ids[end - len(spelled[point]) : end] = spelled[point]
        return ids, n


def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of each 64-bit number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges, one behind the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


@dataclass
class Segments:
    """Ids of parts in one array, and each part's start, number of ids and pops."""

    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    pops: np.ndarray


class Known:
    """Parts of which nothing is skipped: their place by the part, and their segments."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.int64)
        self.places: dict[str, int] = {}
        self.letters = 0
        self.segments = Segments(np.zeros(0, "<u4"), none, none, none)

    def add(self, parts: list[str], new: Segments) -> None:
        old, first = self.segments, len(self.places)
        self.places.update(zip(parts, range(first, first + len(parts))))
        self.letters += sum(map(len, parts))
        self.segments = Segments(
            np.concatenate([old.ids, new.ids]),
            np.concatenate([old.starts, new.starts + len(old.ids)]),
            np.concatenate([old.sizes, new.sizes]),
            np.concatenate([old.pops, new.pops]),
        )

    def take(self, at: np.ndarray) -> Segments:
        s = self.segments
        return Segments(s.ids, s.starts[at], s.sizes[at], s.pops[at])


class MergeCache:
    """Encodes texts for one seed, variant and rate."""

    def __init__(self, vocabulary: Vocabulary, seed: int, variant: int, rate: float, limit: int = 600_000, plain: Known | None = None):
        self.vocabulary, self.limit = vocabulary, limit
        self.key = xxhash.xxh3_64_intdigest(b"%d:%d" % (seed, variant))
        # the pop of a part with hash h is skipped if the hash of h + number * POP_STEP is below
        self.below = min(WORD, max(0, int(rate * 2.0**64)))
        self.plain = Known() if plain is None else plain

    def skips(self, h: np.ndarray, pop: np.ndarray) -> np.ndarray:
        """Whether pop number ``pop`` (from 0) of a part with hash ``h`` is skipped."""
        if not self.below:
            return np.zeros(len(h), bool)
        return mixed(h + (pop.astype(np.uint64) + np.uint64(1)) * np.uint64(POP_STEP)) <= np.uint64(self.below)

    # --- agendas

    def side_by_side(self, parts: list[str], width: int, h: np.ndarray | None):
        """Final symbols of parts of at most ``width`` characters, where they stand in an array of
        rows, and the parts' pops.

        A row is a linked list over its columns; its last column is neither a
        symbol nor a pair and ends the list on both sides.
        """
        rank, get, n, step = self.vocabulary.rank, self.vocabulary.pairs.get, len(parts), width + 1
        pad = self.vocabulary.size + 1
        lengths = np.fromiter(map(len, parts), np.int64, n)
        filled = np.arange(step) < lengths[:, None]
        places = np.flatnonzero(filled)
        symbols, points = self.vocabulary.symbols("".join(parts))
        s = np.full(n * step, pad, dtype=np.int32)
        s[places] = symbols
        after, before = np.arange(1, n * step + 1), np.arange(-1, n * step - 1)
        first, last = np.arange(n) * step, np.arange(n) * step + width
        before[first] = last
        after[first + lengths - 1] = last
        merged = np.full(n * step, self.vocabulary.size, dtype=np.int32)
        pairs = places[after[places] != last[places // step]]
        merged[pairs] = get(s[pairs], s[pairs + 1])
        r = rank[merged]
        pops = np.zeros(n, dtype=np.int64)
        rows, table = np.arange(n), r.reshape(n, step)
        while len(rows):
            k = table.argmin(axis=1)
            live = table[np.arange(len(rows)), k] != NONE
            if not live.all():
                rows, table, k = rows[live], table[live], k[live]
            line = np.arange(len(rows))
            at = rows * step + k
            if h is not None:
                skip = self.skips(h[rows], pops[rows])
                table[line[skip], k[skip]] = NONE
                line, at = line[~skip], at[~skip]
            pops[rows] += 1
            piece, right = merged[at], after[at]
            behind, front = after[right], before[at]
            s[at], s[right] = piece, pad
            after[at], before[behind] = behind, at
            new = get(np.concatenate([piece, s[front]]), np.concatenate([s[behind], piece]))
            half = len(at)
            merged[at], merged[front] = new[:half], new[half:]
            start = rows[line] * step
            table[line, right - start] = NONE
            table[line, at - start] = rank[new[:half]]
            table[line, front - start] = rank[new[half:]]
        kept = s != pad
        point = np.zeros(n * step, dtype=np.uint32)
        point[places] = points
        return s[kept], point[kept], kept.reshape(n, step).sum(axis=1), pops

    def by_heap(self, part: str, h: int | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Final symbols, their code points, and pops of one part of any length."""
        rank, merged = self.vocabulary.rank, self.vocabulary.merged
        start, points = self.vocabulary.symbols(part)
        symbols: list[int] = start.tolist()
        after, before = [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
        agenda: list[tuple[int, int, int, int]] = []
        pops, drawn = 0, np.zeros(0, bool)

        def propose(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                piece = merged.get((symbols[left], symbols[right]))
                if piece is not None:
                    heapq.heappush(agenda, (int(rank[piece]), left, symbols[left], symbols[right]))

        for k in range(len(symbols) - 1):
            propose(k, k + 1)
        while agenda:
            _, left, a, b = heapq.heappop(agenda)
            right = after[left]
            if symbols[left] != a or right < 0 or symbols[right] != b:
                continue
            if h is not None:
                if pops >= len(drawn):
                    more = np.arange(len(drawn), 2 * len(drawn) + 1024)
                    drawn = np.concatenate([drawn, self.skips(np.full(len(more), h, dtype=np.uint64), more)])
                skip = drawn[pops]
            pops += 1
            if h is not None and skip:
                continue
            symbols[left], symbols[right] = merged[a, b], -1
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            propose(before[left], left)
            propose(left, after[left])
        final = np.array(symbols, dtype=np.int32)
        return final[final >= 0], points[final >= 0], pops

    def segment(self, parts: list[str], h: np.ndarray | None) -> Segments:
        """Ids and pops of every part; without ``h`` nothing is skipped."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        group = np.searchsorted(WIDTHS, lengths)
        pops, sizes = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for g in np.unique(group).tolist():
            places = np.flatnonzero(group == g)
            step = ROWS if g < len(WIDTHS) else 1
            for at in range(0, len(places), step):
                chosen = places[at : at + step]
                if g < len(WIDTHS):
                    symbols, points, count, pops[chosen] = self.side_by_side(
                        [parts[p] for p in chosen.tolist()], WIDTHS[g], None if h is None else h[chosen]
                    )
                else:
                    p = int(chosen[0])
                    symbols, points, pops[p] = self.by_heap(parts[p], None if h is None else int(h[p]))
                    count = np.array([len(symbols)])
                ids, n = self.vocabulary.ids_of(symbols, points)
                sizes[chosen] = np.add.reduceat(n, np.cumsum(count) - count)
                done.append((chosen, ids))
        starts = np.cumsum(sizes) - sizes
        flat = np.zeros(int(sizes.sum()), dtype="<u4")
        for chosen, ids in done:
            flat[ranges(starts[chosen], sizes[chosen])] = ids
        return Segments(flat, starts, sizes, pops)

    # --- texts

    def free(self, parts: list[str]) -> Segments:
        """Ids and pops of parts of which nothing is skipped."""
        places = list(map(self.plain.places.get, parts))
        unknown = [k for k, place in enumerate(places) if place is None]
        if unknown:
            missing = list(dict.fromkeys([parts[k] for k in unknown]))
            if len(self.plain.places) + len(missing) > self.limit:
                self.plain.clear()
                unknown, missing = range(len(parts)), list(dict.fromkeys(parts))
            self.plain.add(missing, self.segment(missing, None))
            for k in unknown:
                places[k] = self.plain.places[parts[k]]
        found = self.plain.take(np.array(places, dtype=np.int64))
        if self.plain.letters > self.limit * WIDTHS[-1]:
            self.plain.clear()
        return found

    def hashes(self, texts: list[str], counts: np.ndarray) -> np.ndarray:
        """A hash of every part, by seed, variant, text and place."""
        seeds = [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"), self.key) for t in texts]
        ends = np.cumsum(counts)
        place = np.arange(1, int(ends[-1]) + 1) - np.repeat(ends - counts, counts)
        return mixed(np.repeat(np.array(seeds, dtype=np.uint64), counts) + place.astype(np.uint64) * np.uint64(PLACE_STEP))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Packed ids of every text."""
        cut = [self.vocabulary.parts(t) for t in texts]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        parts = [p for c in cut for p in c]
        if not parts:
            return [b""] * len(texts)
        found = self.free(parts)
        ids, starts, sizes = found.ids, found.starts, found.sizes
        if self.below:
            h = self.hashes(texts, counts)
            of_part = np.repeat(np.arange(len(parts)), found.pops)
            number = np.arange(len(of_part)) - np.repeat(np.cumsum(found.pops) - found.pops, found.pops)
            # a part of which no pop is skipped is as it is without dropout
            drawn = np.unique(of_part[self.skips(h[of_part], number)])
            again = self.segment([parts[p] for p in drawn.tolist()], h[drawn])
            starts, sizes = starts.copy(), sizes.copy()
            starts[drawn], sizes[drawn] = again.starts + len(ids), again.sizes
            ids = np.concatenate([ids, again.ids])
        raw = ids[ranges(starts, sizes)].tobytes()
        part_ends = np.concatenate([[0], np.cumsum(sizes)]) * ID_BYTES
        ends = part_ends[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]


def slices(texts: list[str]):
    """Ranges of texts of about PARTS parts together (by their spaces)."""
    start = size = 0
    for i, text in enumerate(texts):
        n = text.count(" ") + 1
        if i > start and size + n > PARTS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def decode(vocabulary: Vocabulary, ids) -> bytes:
    """The text of ids (without the space put in front), as UTF-8."""
    ids = np.asarray(ids, dtype=np.int64)
    starts = vocabulary.surface_ends[ids]
    return vocabulary.surfaces[ranges(starts, vocabulary.surface_ends[ids + 1] - starts)].tobytes()[1:]


_CACHES: dict[tuple, tuple[Vocabulary, list[MergeCache]]] = {}


def merge_caches(path: str, seed: int, rate: float, variants: int) -> tuple[Vocabulary, list[MergeCache]]:
    """This Python worker's encoders, one for each variant, and their shared cache."""
    key = (path, seed, rate, variants)
    if key not in _CACHES:
        vocabulary, shared = Vocabulary(path), Known()  # free of seed and variant
        _CACHES[key] = (vocabulary, [MergeCache(vocabulary, seed, v, rate, plain=shared) for v in range(variants)])
    return _CACHES[key]


def encode_batch(caches: list[MergeCache], variants: list[int], texts: list[str]):
    """Packed ids of the texts in order, each by its variant's encoder."""
    for start, stop in slices(texts):
        out = [b""] * (stop - start)
        for v in set(variants[start:stop]):
            places = [k for k in range(start, stop) if variants[k] == v]
            for k, ids in zip(places, caches[v].encode_many([texts[k] for k in places])):
                out[k - start] = ids
        yield from out


def encode_documents(
    docs: DataFrame,
    model: str,
    seed: int = 17,
    rate: float = 0.1,
    variants: int = 2,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """``doc_id, variant, ids`` for every whole text."""
    return _run(docs, model, seed, rate, variants, text_col, id_col, False)


def encode_and_decode(
    docs: DataFrame,
    model: str,
    seed: int = 17,
    rate: float = 0.1,
    variants: int = 2,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Per document the ids' count and checksum, and those of the text decoded from them."""
    return _run(docs, model, seed, rate, variants, text_col, id_col, True)


def _run(docs, model, seed, rate, variants, text_col, id_col, digest) -> DataFrame:
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(variants)).cast("int"), F.lit(0)).alias("variant"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def ids_only(batches):
        _, caches = merge_caches(model, seed, rate, variants)
        for batch in batches:
            encoded = encode_batch(caches, batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ids = [np.frombuffer(raw, "<u4").tolist() for raw in encoded]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "variant", "ids"]
            )

    def digests(batches):
        vocabulary, caches = merge_caches(model, seed, rate, variants)
        for batch in batches:
            out = [[], [], [], []]
            texts = batch.column(2).to_pylist()
            for text, raw in zip(texts, encode_batch(caches, batch.column(1).to_pylist(), texts)):
                ids = np.frombuffer(raw, "<u4")
                back = decode(vocabulary, ids)
                for column, value in zip(
                    out, (len(ids), zlib.crc32(raw), zlib.crc32(back), back == text.encode("utf-8", "surrogatepass"))
                ):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *[pa.array(c, pa.int64()) for c in out[:3]],
                    pa.array(out[3], pa.bool_()),
                ],
                names=["doc_id", "variant", "n_tokens", "ids_crc32", "decoded_crc32", "lossless"],
            )

    if digest:
        schema = "doc_id long, variant int, n_tokens long, ids_crc32 long, decoded_crc32 long, lossless boolean"
        return rows.mapInArrow(digests, schema)
    return rows.mapInArrow(ids_only, "doc_id long, variant int, ids array<int>")
