"""Document fingerprints as Merkle trees over sections and paragraphs.

A text's paragraphs are its lines; a section ends at a blank line or after a paragraph whose
digest says so (a content-defined cut, so texts without blank lines branch too and an edit
does not move the sections behind it). Long paragraphs are cut further, after white space
whose preceding bytes hash to a cut, into leaves of some 16 words (4 in short texts, so that
an edit of a text of one line can be located too). A node's digest is the hash of its
children's digests; the root also covers the exact text. The fingerprint is printable:
``root/sections`` with sections joined by ``;`` and paragraphs by ``,``; a paragraph is its
digest and its length in bytes, then, if it is cut, ``=`` and its leaves, alike, joined by a
space.

Equal roots mean equal texts. ``likeness`` walks two trees from the top, matches equal
sections, then equal paragraphs of what is left, then equal leaves, and returns the matched
share of both texts' bytes. ``edits`` returns the byte spans of the leaves that differ.

The fingerprint of a text needs nothing but the text (no shuffle). ``with_next`` pairs every
document with the one of the next higher doc_id in one shuffle of the texts: rows are dealt to
id ranges, and the first row of each range is also sent to the range before it.

Defined cases: a null text is the empty text (one empty leaf; two empty texts have likeness
1); rows with a null id come first; rows of one id are ordered by the hash of their text;
the last document is followed by the first, a single one by itself; other columns pass
through ``fingerprints``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline._ship import ship_by_value
from eddyline.llm.common import byte_values, map_batches, map_rows, slices
from eddyline.session import target_parallelism

SHORT = 1024  # bytes of a short text
FINE = (24, 4)  # short texts: bytes of a paragraph that stays whole, mean words of a leaf
COARSE = (128, 16)  # other texts
SECTION = 8  # mean paragraphs of a section without blank lines
LOWEST = -(1 << 63)  # where null ids stand in the order


def _cuts(line: bytes, words: int) -> np.ndarray:
    """Content-defined cuts of a long paragraph: ends of leaves, after white space."""
    b = np.frombuffer(line, np.uint8)
    at = np.flatnonzero((b == 32) | (b == 9))
    at = at[at >= 4]
    w = [b[at - k].astype(np.uint32) for k in (1, 2, 3, 4)]
    x = (w[0] | w[1] << 8 | w[2] << 16 | w[3] << 24) * np.uint32(0x9E3779B1)
    return at[(x >> np.uint32(16)) % words == 0] + 1


def leaves(line: bytes, whole: int, words: int) -> list[bytes]:
    if len(line) <= whole:
        return [line]
    ends = _cuts(line, words).tolist()
    return [line[i:j] for i, j in zip([0, *ends], [*ends, len(line)], strict=True) if i < j]


def _node(content: bytes) -> str:
    return f"{xxhash.xxh3_64_intdigest(content) & 0xFFFFFFFFFF:010x}{len(content):x}"


def fingerprint(text: bytes) -> str:
    rule = FINE if len(text) < SHORT else COARSE
    sections, section = [], []
    for line in text.split(b"\n"):
        parts = leaves(line, *rule)
        node = _node(line)
        section.append(node if len(parts) == 1 else f"{node}={' '.join(map(_node, parts))}")
        if not line.strip() or int(node[:10], 16) % SECTION == 0:
            sections.append(",".join(section))
            section = []
    if section:
        sections.append(",".join(section))
    root = xxhash.xxh3_128()
    for s in sections:
        root.update(xxhash.xxh3_64_digest(s))
    root.update(text)
    return f"{root.hexdigest()}/{';'.join(sections)}"


def _size(node: str) -> int:
    return int(node[10:], 16)


def _unmatched(a: list[str], b: list[str], name=lambda node: node) -> tuple[list[str], list[str], list[str]]:
    """(matched of a, rest of a, rest of b) of two lists of nodes, equal by ``name``."""
    common = Counter(map(name, a)) & Counter(map(name, b))
    out = []
    for side in (a, b):
        left, same, rest = common.copy(), [], []
        for x in side:
            if left[name(x)] > 0:
                left[name(x)] -= 1
                same.append(x)
            else:
                rest.append(x)
        out += [same, rest]
    return out[0], out[1], out[3]


def _paragraph(node: str) -> str:
    return node.partition("=")[0]


def _leaves_of(paragraph: str) -> list[str]:
    node, cut, parts = paragraph.partition("=")
    return parts.split(" ") if cut else [node]


def likeness(a: str, b: str) -> float:
    """Share of both texts' bytes in equal sections, paragraphs and leaves."""
    (root_a, _, tree_a), (root_b, _, tree_b) = a.partition("/"), b.partition("/")
    if root_a == root_b:
        return 1.0
    total = sum(_size(_paragraph(p)) for t in (tree_a, tree_b) for s in t.split(";") for p in s.split(","))
    same, left, right = _unmatched(tree_a.split(";"), tree_b.split(";"))
    matched = sum(_size(_paragraph(p)) for s in same for p in s.split(","))
    left, right = ([p for s in side for p in s.split(",")] for side in (left, right))
    same, left, right = _unmatched(left, right, _paragraph)
    matched += sum(_size(_paragraph(p)) for p in same)
    left, right = ([x for p in side for x in _leaves_of(p)] for side in (left, right))
    matched += sum(map(_size, _unmatched(left, right)[0]))
    # different texts are never quite alike
    return min(2.0 * matched / total, 1.0 - 1e-9) if total else 0.0


def edits(a: str, b: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Byte spans (start, end) of either text whose leaves differ from the other's."""
    out = []
    flat = []
    for x in (a, b):
        paragraphs = [p for section in x.partition("/")[2].split(";") for p in section.split(",")]
        flat.append([leaf for p in paragraphs for leaf in (*_leaves_of(p), None)])  # None: the newline
    for mine, other in (flat, flat[::-1]):
        left, spans, at = Counter(x for x in other if x), [], 0
        for leaf in mine:
            size = 1 if leaf is None else _size(leaf)
            if leaf is not None:
                if left[leaf] > 0:
                    left[leaf] -= 1
                elif spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + size)
                else:
                    spans.append((at, at + size))
            at += size
        out.append(spans)
    return out[0], out[1]


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``fingerprint``; no shuffle."""

    def make():
        def step(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            return {"fingerprint": pa.array([fingerprint(b or b"") for b in byte_values(batch.column(text))], pa.string())}

        return step

    return map_rows(docs, make, [T.StructField("fingerprint", T.StringType())], by=text)


# ---------------------------------------------------------------- each document and the next


def with_next(docs: DataFrame, function, schema: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows made by ``function(rows)`` from (doc_id, text, next_text) iterators, where next is the
    document of the next higher id (after the last: the first)."""
    width = target_parallelism(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LOWEST)).alias("_at"),
    )
    bounds = rows.approxQuantile("_at", [k / width for k in range(1, width)], 0.2 / width)
    bounds = sorted({int(x) for x in bounds})
    # a range for every id: the number of bounds at or below it
    bucket = F.size(F.filter(F.array(*(F.lit(x).cast("long") for x in bounds)), lambda b: b <= F.col("_at"))) if bounds else F.lit(0)
    rows = rows.withColumn("_bucket", bucket)
    firsts = sorted(tuple(r) for r in rows.groupBy("_bucket").agg(F.min("_at")).collect())  # at most ``width`` rows
    used = [b for b, _ in firsts]
    before = dict(zip(used, [used[-1], *used[:-1]], strict=True)) if used else {}
    first = {b: x for b, x in firsts}
    size = len(bounds) + 1
    first_at = F.array(*(F.lit(first.get(b)).cast("long") for b in range(size)))
    sent_to = F.array(*(F.lit(before.get(b, b)).cast("int") for b in range(size)))
    own = F.struct(F.col("_bucket").cast("int").alias("_to"), F.lit(False).alias("_ahead"))
    ahead = F.struct(F.get(sent_to, F.col("_bucket")).alias("_to"), F.lit(True).alias("_ahead"))
    both = F.when(F.col("_at") == F.get(first_at, F.col("_bucket")), F.array(own, ahead)).otherwise(F.array(own))
    dealt = rows.select("doc_id", "text", "_at", F.inline(both))
    dealt = dealt.repartitionById(size, "_to").sortWithinPartitions("_to", "_ahead", "_at", F.xxhash64("text"))
    dealt = dealt.select("doc_id", "text", "_to", "_ahead")

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, closed = None, None  # the row whose next is awaited; the range that is complete
        for batch in batches:
            for part in slices(batch, "text"):
                columns = (part.column(c).to_pylist() for c in ("doc_id", "_to", "_ahead"))
                for i, to, is_ahead, b in zip(*columns, byte_values(part.column("text")), strict=True):
                    if held is not None and held[2] == to:
                        yield held[0], held[1], b or b""
                        held = None
                    if is_ahead:
                        closed = to
                    elif closed != to:
                        held = (i, b or b"", to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(triples(batches))

    return map_batches(dealt, run, schema)


DIGEST = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The text with its last floor(n/2) code points replaced by the first of the next text."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def digests(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in DIGEST.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]] for c in DIGEST.split(", ")]
    last = (None, None)  # the next document is the row after: its fingerprint is made once
    out = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    for doc_id, raw, following in rows:
        mine = last[1] if last[0] == raw else fingerprint(raw)
        theirs = fingerprint(following)
        last = (following, theirs)
        text = raw.decode()
        other = edited(text, following.decode()).encode()
        changed = fingerprint(other)
        out.append((
            doc_id, len(text), hashlib.sha256(other).hexdigest(), mine, changed,
            likeness(mine, changed), likeness(mine, theirs),
        ))
        if len(out) >= 500:
            yield batch()
            out.clear()
    if out:
        yield batch()


def query(docs: DataFrame) -> DataFrame:
    return with_next(docs.select("doc_id", "text"), digests, DIGEST)


ship_by_value(__name__)
