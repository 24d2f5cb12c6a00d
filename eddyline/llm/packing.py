"""Best-fit packing of token pieces into sequences, certified by lower bounds.

1. ``token_pieces`` tokenizes whole texts (one pass) and cuts only documents longer than a
   sequence; what is packed afterwards are rows of a few numbers, never texts.
2. The pieces are dealt to groups of about ``GROUP`` rows. Each group, also a single one, is packed
   by best-fit decreasing; dual feasible functions (the volume bound, the thresholds f_p that
   round large items up and drop small ones, and the rounding functions u_k) give a lower bound
   on its sequences. A group that meets its bound is certified: no packing of it is smaller.
3. Exchange: a group with a gap releases its emptiest sequences, in proportion to the gap; a
   certified group releases its emptiest one only (the rest that its bound rounded up), a certified
   single group none. The released pieces of all groups are mixed and dealt anew to groups of
   ``GROUP`` rows, and best-fit decreasing runs again, for at most ``ROUNDS`` rounds, so no group of
   any round is larger than those of the first. A round that saves no sequence is undone and is
   the last. Rows that are not released are final.

``certificate`` compares the result with the bound for the whole table, which needs only the
counts of the lengths (at most one row per length); each row's ``certified`` tells whether the
group that placed it met its own bound.

Defined cases: a null text is the empty text (the end token alone); repeated rows are packed
each on their own; null ids pass through; an empty table gives an empty result; other input
columns are not used. Lengths must be between 1 and the capacity.
"""

from __future__ import annotations

import math
import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline._ship import ship_by_value
from eddyline.llm.common import byte_values, kept_by_process, map_batches, slices
from eddyline.session import materialize

CAPACITY = 4096
END = 1
GROUP = 50_000
ROUNDS = 5
RELEASE = 8  # sequences released per sequence of gap
CHUNKS = 900_000  # chunks whose ids a task remembers
ROUNDING = 24  # functions u_1 ... u_ROUNDING

# ---------------------------------------------------------------- tokens


PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
WORD_END = "</w>"  # how the tokenizer marks a token that closes a word
JOINED = 200  # runs of letters tokenized as one string
LATIN = chr(0x250)  # letters below are letters in every version of Unicode


def splits_off(core: bytes) -> bool:
    """Is this a run of letters, so that punctuation behind it is tokenized apart?"""
    if core.isalpha():  # ASCII
        return True
    # such letters are in composed form already; lower-casing one may add a mark, which is none
    plain = core.decode().lower()
    return plain.isalpha() and max(plain) < LATIN


class Chunks(dict):
    """Ids (little-endian unsigned 32-bit) of a chunk between ASCII white space. The
    tokenizer's own words never cross white space, so a text's ids are its chunks' in order.
    A-Z are lower-cased first, as the tokenizer does, so fewer chunks differ (not in texts
    with ``<|``, where a special token's case matters). A new chunk that ends in punctuation
    is put together from its letters and the rest; only what is still unknown is tokenized,
    all of a slice of texts in one call, runs of letters many to a string: each of them is one
    word of the tokenizer and ends with a token that closes a word."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.closes = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, k in tokenizer.get_vocab().items():
            self.closes[k] = token.endswith(WORD_END)

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        made = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [e.ids for e in made]

    def learn(self, chunks: set[bytes]) -> None:
        """Tokenize chunks and remember their ids."""
        letters = [c for c in chunks if splits_off(c)]
        rest = list(chunks.difference(letters))
        groups = [letters[k : k + JOINED] for k in range(0, len(letters), JOINED)]
        for group, ids in zip(groups, self.encode([b" ".join(g) for g in groups]), strict=True):
            ids = np.array(ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(group):  # a chunk is not one word after all
                rest += group
                continue
            raw, at = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.update((c, raw[i:j]) for c, i, j in zip(group, at, at[1:], strict=False))
        self.update(zip(rest, (array("I", ids).tobytes() for ids in self.encode(rest)), strict=True))

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text."""
        cut = [(t if b"<|" in t else t.lower()).split() for t in texts]
        words = list(chain.from_iterable(cut))
        found = list(map(self.get, words))  # one lookup a word; what is new is filled in below
        holes = [k for k, ids in enumerate(found) if ids is None]
        missing = {words[k] for k in holes}
        cores = {}  # of new chunks that end in punctuation
        for chunk in missing:
            core = chunk.rstrip(PUNCTUATION)
            if core and len(core) < len(chunk) and splits_off(core):
                cores[chunk] = core
        asked = missing.difference(cores)
        asked.update(w for w in cores.values() if w not in self)
        asked.update(w for w in {c[len(core) :] for c, core in cores.items()} if w not in self)
        self.learn(asked)
        for chunk, core in cores.items():
            self[chunk] = self[core] + self[chunk[len(core) :]]
        for k in holes:
            found[k] = self[words[k]]
        out, at = [], 0
        for text in cut:
            out.append(b"".join(found[at : at + len(text)]))
            at += len(text)
        if len(self) > CHUNKS:  # what came last goes: frequent chunks come early
            for w in missing.union(asked):
                del self[w]
        return out


def token_pieces(
    docs: DataFrame, tokenizer_json: str, ids: list[str], text: str = "text", capacity: int = CAPACITY, end: int = END, tokens: bool = False
) -> DataFrame:
    """(ids, piece, start, length, ids_crc32) per piece; with ``tokens`` also the ids themselves
    (little-endian unsigned 32-bit). ``tokenizer_json``: the tokenizer file's path."""
    with open(tokenizer_json, encoding="utf-8") as f:  # read by the driver; tasks get its content
        definition = f.read()
    content = docs.sparkSession.sparkContext.broadcast(definition)
    digest = zlib.crc32(definition.encode())
    source = docs.select(*ids, text)
    fields = [
        *(source.schema[c] for c in ids), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("tokens", T.BinaryType())] if tokens else []),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        last = end.to_bytes(4, "little")
        chunks = kept_by_process(f"chunks-{digest}", lambda: Chunks(Tokenizer.from_str(content.value)))
        for batch in batches:
            for part in slices(batch, text):
                row, piece, start, length, crc, raw = [], [], [], [], [], []
                for k, made in enumerate(chunks.ids([b or b"" for b in byte_values(part.column(text))])):
                    made += last
                    for p, s in enumerate(range(0, len(made) // 4, capacity)):
                        cut = made[4 * s : 4 * (s + capacity)]
                        row.append(k), piece.append(p), start.append(s)
                        length.append(len(cut) // 4), crc.append(zlib.crc32(cut))
                        raw.append(cut if tokens else None)
                taken = pa.array(row, pa.int64())
                columns = [part.column(c).take(taken) for c in ids]
                columns += [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                columns += [pa.array(raw, pa.binary())] if tokens else []
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return map_batches(source, run, T.StructType(fields))


# ---------------------------------------------------------------- bounds and best fit


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that pieces of ``counts[length]`` need at least (dual feasible functions)."""
    sizes = np.arange(len(counts), dtype=np.int64)
    counts = counts.astype(np.int64)
    volume = counts * sizes
    up_to, mass = np.cumsum(counts), np.cumsum(volume)
    n = up_to[-1] if len(counts) else 0
    if not n:
        return 0
    best = -(-int(mass[-1]) // capacity)
    p = np.arange(1, capacity // 2 + 1)  # f_p: above C-p counts whole, below p not at all
    whole = n - up_to[capacity - p]
    middle = mass[capacity - p] - mass[p - 1]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    for k in range(1, ROUNDING + 1):
        steps = (k + 1) * sizes
        value = np.where(steps % capacity == 0, k * sizes, steps // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: (sequence, offset) per piece and each sequence's free room."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, free = 0, []  # bit r of rooms: some open sequence has room r
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            s = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            room, s = capacity, len(free)
            free.append(capacity)
        sequence[i], offset[i] = s, capacity - room
        free[s] = left = room - size
        if left:
            if not stacks[left]:
                rooms |= 1 << left
            stacks[left].append(s)
    return sequence, offset, free


def released(free: list[int], gap: int) -> list[int]:
    """The sequences that a group hands to the exchange."""
    open_ones = sorted((s for s, room in enumerate(free) if room), key=lambda s: -free[s])
    return open_ones[: 1 + RELEASE * gap]


PLACE = ("sequence_id", "offset", "certified")


def _pack_round(pieces: DataFrame, columns: list[str], number: int, groups: int, capacity: int) -> DataFrame:
    def pack(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy().astype(np.int64)
        sequence, offset, free = best_fit(lengths, capacity)
        gap = len(free) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        out = released(free, gap) if number + 1 < ROUNDS and (gap or groups > 1) else []
        table = table.select(columns)
        table = table.append_column("sequence_id", pa.array((number << 56) + (key[0].as_py() << 24) + sequence))
        table = table.append_column("offset", pa.array(offset))
        table = table.append_column("certified", pa.array(np.full(len(lengths), gap == 0)))
        return table.append_column("_released", pa.array(np.isin(sequence, out)))

    fields = [pieces.schema[c] for c in columns]
    fields += [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    fields += [T.StructField("certified", T.BooleanType()), T.StructField("_released", T.BooleanType())]
    return pieces.groupBy("_group").applyInArrow(pack, T.StructType(fields))


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` (with a long column ``length``) plus ``sequence_id``, ``offset`` and ``certified``."""
    columns = [c for c in pieces.columns if c.lower() not in (*PLACE, "_group", "_released")]
    left = materialize(pieces.select(*columns))
    n, before, done = left.count(), None, None
    for number in range(ROUNDS):
        groups = max(1, math.ceil(n / group))
        # the rows are fixed by now, so their running numbers are too: equal rows spread evenly
        dealt = F.pmod(F.xxhash64(F.lit(number), F.monotonically_increasing_id()), F.lit(groups)).alias("_group")
        packed = materialize(_pack_round(left.select(*columns, dealt), columns, number, groups, capacity))
        first, out = F.col("offset") == 0, F.col("_released")  # a sequence has one piece at place 0
        used, passed, n = packed.agg(F.count(F.when(first, 1)), F.count(F.when(first & out, 1)), F.count(F.when(out, 1))).first()
        if before is not None and used >= before:
            return done.unionByName(left)
        final = packed.where("not _released").drop("_released")
        done = final if done is None else done.unionByName(final)
        if not n:
            return done
        left, before = packed.where("_released").drop("_released"), passed
    return done


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences used, lower bound for the whole table)."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in packed.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    used = packed.select("sequence_id").distinct().count()
    return used, lower_bound(counts, capacity)


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def query(docs: DataFrame) -> DataFrame:
    pieces = token_pieces(docs, tokenizer_path(), ["doc_id"])
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", *PLACE)


ship_by_value(__name__)
