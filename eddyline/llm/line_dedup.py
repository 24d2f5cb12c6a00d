"""Line deduplication through a sharded minimal perfect hash.

1. Every text is cut into lines; a line's key is the line stripped of ASCII white space and
   with A-Z lower-cased. Tasks count the documents of each 64-bit key hash batch by batch,
   so a line that many documents share is one row per batch, and a grouped sum finishes.
2. Hashes that enough documents share are dealt to shards by their low bits (about
   ``SHARD_KEYS`` each). Per shard a minimal perfect hash (levels of bit arrays: a key takes
   the first level where no other key of the shard falls on its bit; its rank among all set
   bits is its slot) indexes two dense arrays: fingerprints (the 64-bit hash itself, so a
   key that is not indexed is always refused) and document counts.
3. Documents probe the arrays. While the arrays together are at most ``broadcast_bytes``
   they travel to every task and the texts are never shuffled. Beyond that the probes
   travel: (text key, line hash) rows go to the shard's arrays, salted over ``SALTS`` copies
   of each shard, and the hits come back to the texts. Both ways drop the same lines.

Defined cases: a null or empty text is one empty line and stays the empty string; a key of
less than ``min_length`` code points never counts; repeated rows are documents of their own;
other columns pass through and columns called ``n_lines`` / ``n_dropped`` are replaced; an
empty table gives an empty result. Two different keys share a 64-bit hash with a chance of
about n*n / 2**65 for n distinct keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline._ship import ship_by_value
from eddyline.llm.common import byte_values, map_batches, map_rows, mix64, slices, string_array
from eddyline.session import materialize

MIN_DOCS = 10
MIN_LENGTH = 1
SHARD_KEYS = 1 << 20
BROADCAST_BYTES = 32 << 20
SALTS = 8
BLANK = b" \t\n\x0b\x0c\r"
GAMMA = 1.5  # bits per key still to place, per level
INDEX_SCHEMA = "shard int, n_keys long, sizes array<long>, bits binary, fingerprints binary, counts binary"


# ---------------------------------------------------------------- keys of lines


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK).lower()  # bytes.lower() changes A-Z only


def key_hash(key: bytes) -> int:
    """Signed 64-bit hash of a key."""
    h = xxhash.xxh3_64_intdigest(key)
    return h - (1 << 64) if h >> 63 else h


def counted(key: bytes, min_length: int) -> bool:
    """Is the key long enough to count? (code points: bytes that do not continue one)"""
    if len(key) < min_length:
        return False
    return min_length <= 1 or sum((c & 0xC0) != 0x80 for c in key) >= min_length


def line_hashes(text: bytes | None, min_length: int) -> tuple[list[bytes], list[int | None]]:
    lines = (text or b"").split(b"\n")
    keys = map(line_key, lines)
    return lines, [key_hash(k) if counted(k, min_length) else None for k in keys]


def count_lines(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """(line_hash, n_docs): documents that hold a line with the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                seen: list[int] = []
                for b in byte_values(part.column(text)):
                    found = set(line_hashes(b, min_length)[1])
                    found.discard(None)
                    seen.extend(found)
                h, n = np.unique(np.array(seen, np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(n, pa.int64())], names=["line_hash", "n"]
                )

    counts = map_batches(docs.select(text), run, "line_hash long, n long")
    return counts.groupBy("line_hash").agg(F.sum("n").alias("n_docs"))


# ---------------------------------------------------------------- the perfect hash


def level_positions(h: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where keys fall in the bit array of a level (uniform, another mix per level)."""
    x = mix64(h ^ np.uint64((level + 1) * 0xD6E8FEB86659FD93 % 2**64))
    return (x % np.uint64(size)).astype(np.int64)


def ranks(bits: np.ndarray) -> np.ndarray:
    """Set bits before each byte of a packed bit array."""
    per_byte = np.bitwise_count(bits).astype(np.int64)
    return np.concatenate([[0], np.cumsum(per_byte)[:-1]]) if len(bits) else np.empty(0, np.int64)


def build_shard(hashes: np.ndarray, counts: np.ndarray) -> tuple[list[int], bytes, bytes, bytes]:
    """(level sizes in bits, packed bits of all levels, fingerprints, counts) of distinct hashes."""
    h = hashes.astype(np.int64).view(np.uint64)
    sizes, packed, left = [], [], h
    while len(left):
        size = -(-max(64, int(GAMMA * len(left))) // 8) * 8
        at = level_positions(left, len(sizes), size)
        hits = np.bincount(at, minlength=size)
        packed.append(np.packbits(hits == 1, bitorder="little"))
        sizes.append(size)
        left = left[hits[at] != 1]
    bits = np.concatenate(packed) if packed else np.empty(0, np.uint8)
    slot = slots(h, sizes, bits, ranks(bits))
    fingerprints, dense = np.zeros(len(h), np.uint64), np.zeros(len(h), np.int64)
    fingerprints[slot], dense[slot] = h, counts
    return sizes, bits.tobytes(), fingerprints.tobytes(), dense.tobytes()


def slots(h: np.ndarray, sizes: list[int], bits: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Slot of each hash, -1 where no level has its bit. A key that was indexed always gets
    its own slot; any other key gets -1 or some slot, which its fingerprint then refuses."""
    out = np.full(len(h), -1, np.int64)
    todo, base = np.arange(len(h)), 0
    for level, size in enumerate(sizes):
        at = level_positions(h[todo], level, size)
        byte, bit = base + (at >> 3), (at & 7).astype(np.uint8)
        word = bits[byte]
        found = (word >> bit) & 1 == 1
        below = np.bitwise_count(word & ((np.uint8(1) << bit) - np.uint8(1)).astype(np.uint8))
        out[todo[found]] = before[byte[found]] + below[found]
        todo, base = todo[~found], base + size // 8
        if not len(todo):
            break
    return out


class Shard:
    """The arrays of one shard, ready to be probed."""

    def __init__(self, sizes, bits, fingerprints, counts):
        self.sizes, self.bits = list(sizes), np.frombuffer(bits, np.uint8)
        self.before = ranks(self.bits)
        self.fingerprints = np.frombuffer(fingerprints, np.uint64)
        self.counts = np.frombuffer(counts, np.int64)

    def documents(self, hashes: np.ndarray) -> np.ndarray:
        """Document count of each hash (int64), 0 for a hash that is not indexed."""
        h = hashes.view(np.uint64)
        slot = slots(h, self.sizes, self.bits, self.before)
        out = np.zeros(len(h), np.int64)
        known = np.flatnonzero(slot >= 0)
        known = known[self.fingerprints[slot[known]] == h[known]]
        out[known] = self.counts[slot[known]]
        return out


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard, from (line_hash, n_docs)."""

    def build(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        h, n = table["line_hash"].to_numpy(), table["n_docs"].to_numpy()
        sizes, bits, fingerprints, dense = build_shard(h, n)
        schema = pa.schema([
            ("shard", pa.int32()), ("n_keys", pa.int64()), ("sizes", pa.list_(pa.int64())),
            ("bits", pa.binary()), ("fingerprints", pa.binary()), ("counts", pa.binary()),
        ])
        row = {"shard": key[0].as_py(), "n_keys": len(h), "sizes": sizes, "bits": bits,
               "fingerprints": fingerprints, "counts": dense}
        return pa.Table.from_pylist([row], schema=schema)

    shard = F.pmod(F.col("line_hash"), F.lit(shards)).cast("int")
    return counts.withColumn("shard", shard).groupBy("shard").applyInArrow(build, INDEX_SCHEMA)


# ---------------------------------------------------------------- probing

OUT_FIELDS = [
    T.StructField("text", T.StringType()),
    T.StructField("n_lines", T.LongType()),
    T.StructField("n_dropped", T.LongType()),
]


def keep_lines(lines: list[bytes], hashes: list[int | None], drop: set[int]) -> tuple[bytes, int, int]:
    kept = [line for line, h in zip(lines, hashes, strict=True) if h not in drop]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _columns(text: str, rows: list[tuple[bytes, int, int]]) -> dict[str, pa.Array]:
    kept, n, dropped = zip(*rows, strict=True) if rows else ((), (), ())
    return {text: string_array(list(kept)), "n_lines": pa.array(n, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}


def _fields(text: str) -> list[T.StructField]:
    return [T.StructField(text, T.StringType()), *OUT_FIELDS[1:]]


def probe_broadcast(docs: DataFrame, index: DataFrame, shards: int, text: str, min_docs: int, min_length: int) -> DataFrame:
    """Texts stay where they are; the arrays (size checked by the caller) go to every task."""
    rows = {r["shard"]: tuple(r)[2:] for r in index.collect()}
    arrays = docs.sparkSession.sparkContext.broadcast(rows)

    def make():
        ready = {s: Shard(*a) for s, a in arrays.value.items()}

        def step(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            cut = [line_hashes(b, min_length) for b in byte_values(batch.column(text))]
            asked = np.array(sorted({h for _, hs in cut for h in hs if h is not None}), np.int64)
            drop: set[int] = set()
            of = asked % shards
            for s in np.unique(of):
                if int(s) in ready:
                    mine = asked[of == s]
                    drop.update(mine[ready[int(s)].documents(mine) >= min_docs].tolist())
            return _columns(text, [keep_lines(lines, hs, drop) for lines, hs in cut])

        return step

    return map_rows(docs, make, _fields(text), by=text)


def probe_routed(docs: DataFrame, index: DataFrame, shards: int, text: str, min_docs: int, min_length: int) -> DataFrame:
    """The probes travel to the arrays. Texts are keyed by two hashes of their content, so
    equal texts ask once per task and share one list of hits."""
    key = ["_text_1", "_text_2"]
    keyed = docs.withColumn("_text_1", F.xxhash64(F.coalesce(text, F.lit("")))).withColumn(
        "_text_2", F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                k1, k2 = part.column("_text_1").to_pylist(), part.column("_text_2").to_pylist()
                rows: dict[tuple[int, int, int], None] = {}
                for a, b, t in zip(k1, k2, byte_values(part.column(text)), strict=True):
                    rows |= dict.fromkeys((a, b, h) for h in line_hashes(t, min_length)[1] if h is not None)
                a, b, h = (np.array(x, np.int64) for x in (zip(*rows, strict=True) if rows else ([], [], [])))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, h)], names=[*key, "line_hash"])

    probes = map_batches(keyed.select(*key, text), ask, "_text_1 long, _text_2 long, line_hash long")
    probes = probes.select(
        F.pmod(F.col("line_hash"), F.lit(shards)).cast("int").alias("shard"),
        F.pmod("_text_1", F.lit(SALTS)).cast("int").alias("salt"),
        F.lit(1).alias("is_probe"), *key, "line_hash",
    )
    arrays = index.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(0).alias("is_probe"),
        "sizes", "bits", "fingerprints", "counts",
    )
    both = arrays.unionByName(probes, allowMissingColumns=True)
    both = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "is_probe")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, arrays_of = None, None  # the shard whose arrays were read last
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            salt, probe = batch.column("salt").to_numpy(), batch.column("is_probe").to_numpy()
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(salt) != 0) | (np.diff(probe) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(shard)], strict=True):
                if lo == hi:
                    continue
                if not probe[lo]:
                    row = batch.slice(lo, 1).to_pylist()[0]
                    at = (shard[lo], salt[lo])
                    arrays_of = Shard(row["sizes"], row["bits"], row["fingerprints"], row["counts"])
                elif at == (shard[lo], salt[lo]):
                    part = batch.slice(lo, hi - lo)
                    found = arrays_of.documents(part.column("line_hash").to_numpy()) >= min_docs
                    yield part.select([*key, "line_hash"]).filter(pa.array(found))

    hits = map_batches(both, answer, "_text_1 long, _text_2 long, line_hash long")
    hits = hits.groupBy(*key).agg(F.collect_set("line_hash").alias("_drop"))
    joined = keyed.join(hits, key, "left")

    def make():
        def step(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            drops = batch.column("_drop").to_pylist()
            cut = [line_hashes(b, min_length) for b in byte_values(batch.column(text))]
            return _columns(text, [keep_lines(*c, set(d or ())) for c, d in zip(cut, drops, strict=True)])

        return step

    return map_rows(joined, make, _fields(text), by=text, keep=docs.columns)


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    min_docs: int = MIN_DOCS,
    min_length: int = MIN_LENGTH,
    broadcast_bytes: int = BROADCAST_BYTES,
    shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``, plus ``n_lines`` and ``n_dropped``."""
    shared = materialize(count_lines(docs, text, min_length).where(F.col("n_docs") >= min_docs))
    shards = max(1, math.ceil(shared.count() / shard_keys))
    index = materialize(build_index(shared, shards))
    held = sum(F.length(c) for c in ("bits", "fingerprints", "counts"))
    size = index.agg(F.sum(held)).first()[0] or 0
    probe = probe_broadcast if size <= broadcast_bytes else probe_routed
    return probe(docs, index, shards, text, min_docs, min_length)


def query(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ship_by_value(__name__)
