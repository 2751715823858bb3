"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs (lines, and inside long lines runs of words that end where the word's hash says so, so
an edit moves only nearby cuts). Each paragraph's 64-bit digest goes into three cells of a small table of (count, xor of
digests, xor of checks). Two versions' tables are subtracted; cells that hold one digest are peeled off
until the table is empty, which recovers the digests that only one version has. Where peeling gets stuck, both tables
are built again four times larger. Likeness is shared over all paragraphs.

Documents are dealt to ranges of ids of about ``range_bytes`` text, whose first ids are read off a range sort of ids
and sizes alone; the first document of each range also goes to the range before it, so every row meets its
successor in one deal of the texts, without one task seeing all of them.

Defined cases: null texts are empty; a null id comes first; equal ids stand in the order of their texts; the last document's
successor is the first one (of a single document itself); two empty texts have likeness 1; a text
longer than a range is a range of its own.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.shared import BLANK, Rolling, Words, flat_text, in_chunks, mix, read_table

CELLS = 18
HASHES = 3
GROWTH = 4
#: One word in so many ends a paragraph inside a line.
RUN = 8
RANGE_BYTES = 8 << 20

_NEWLINE = 10


def paragraphs(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, digest) of all texts, sorted."""
    words = Words(data, begins, BLANK, lower=False)
    if not len(words.begin):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lines = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == _NEWLINE, out=lines[1:])
    text = words.text
    last = np.zeros(len(text), bool)
    last[-1] = True
    last[:-1] = (np.diff(text) > 0) | (lines[words.end[:-1]] != lines[words.begin[1:]])
    last |= words.hash % np.uint64(RUN) == 0
    ends = np.flatnonzero(last)
    first = np.concatenate([[0], ends[:-1] + 1])
    digest = Rolling(words.hash).of(first, ends + 1)
    owner = text[ends]
    order = np.lexsort((digest, owner))
    owner, digest = owner[order], digest[order]
    new = np.ones(len(owner), bool)
    new[1:] = (np.diff(owner) > 0) | (digest[1:] != digest[:-1])
    return owner[new], digest[new]


def places(digest: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each digest in each of the three parts of a table."""
    part = cells // HASHES
    salts = [np.uint64(0x9E3779B97F4A7C15 * (k + 1) + cells & 0xFFFFFFFFFFFFFFFF) for k in range(HASHES)]
    return np.stack([(mix(digest ^ s) % np.uint64(part)).astype(np.int64) + k * part for k, s in enumerate(salts)])


def check_of(digest: np.ndarray) -> np.ndarray:
    return mix(digest + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(32)


def tables(owner: np.ndarray, digest: np.ndarray, n: int, cells: int):
    """Count, xor of digests and xor of checks of every cell of ``n`` tables."""
    count = np.zeros(n * cells, np.int64)
    keys, checks = np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
    for place in places(digest, cells):
        at = owner * cells + place
        order = np.argsort(at, kind="stable")
        own, first = np.unique(at[order], return_index=True)
        if len(own):
            count[own] += np.diff(np.append(first, len(at)))
            keys[own] ^= np.bitwise_xor.reduceat(digest[order], first)
            checks[own] ^= np.bitwise_xor.reduceat(check_of(digest)[order], first)
    return count.reshape(n, cells), keys.reshape(n, cells), checks.reshape(n, cells)


def peel(count: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of digests recovered from each difference of tables, and whether it came out empty."""
    n, cells = count.shape
    count, keys, checks = count.ravel().copy(), keys.ravel().copy(), checks.ravel().copy()
    found = np.zeros(n, np.int64)
    active = np.arange(n * cells)
    while True:
        single = active[np.abs(count[active]) == 1]
        single = single[check_of(keys[single]) == checks[single]]
        if not len(single):
            break
        # A digest shows in up to three cells at once: take it once.
        pairs = np.stack([(single // cells).astype(np.uint64), keys[single]])
        _, once = np.unique(pairs, axis=1, return_index=True)
        single = single[once]
        owner, digest, sign = single // cells, keys[single], count[single]
        found += np.bincount(owner, minlength=n)
        touched = []
        for place in places(digest, cells):
            at = owner * cells + place
            np.subtract.at(count, at, sign)
            np.bitwise_xor.at(keys, at, digest)
            np.bitwise_xor.at(checks, at, check_of(digest))
            touched.append(at)
        active = np.unique(np.concatenate(touched))
    empty = ~((count != 0) | (keys != 0)).reshape(n, cells).any(axis=1)
    return found, empty


def differences(left: tuple, right: tuple, n: int, cells: int = CELLS) -> np.ndarray:
    """Size of the symmetric difference of each pair of digest sets, by subtracting tables."""
    out = np.zeros(n, np.int64)
    open_ = np.arange(n)
    while len(open_):
        number = np.full(n, -1)
        number[open_] = np.arange(len(open_))
        parts = []
        for owner, digest in (left, right):
            keep = number[owner] >= 0
            parts.append(tables(number[owner[keep]], digest[keep], len(open_), cells))
        (a, b, c), (x, y, z) = parts
        found, empty = peel(a - x, b ^ y, c ^ z)
        out[open_[empty]] = found[empty]
        open_ = open_[~empty]
        cells *= GROWTH
    return out


def likeness(left: tuple, right: tuple, n: int) -> np.ndarray:
    sizes = np.bincount(left[0], minlength=n) + np.bincount(right[0], minlength=n)
    apart = differences(left, right, n)
    return np.where(sizes == 0, 1.0, (sizes - apart) / np.maximum(sizes + apart, 1))


def as_strings(owner: np.ndarray, digest: np.ndarray, n: int, cells: int = CELLS) -> list[str]:
    """The fingerprint: the cells of the smallest table, as text."""
    count, keys, checks = tables(owner, digest, n, cells)
    packed = np.zeros((n, cells), np.dtype([("n", "<i4"), ("key", "<u8"), ("check", "<u4")]))
    packed["n"], packed["key"], packed["check"] = count, keys, checks
    raw = packed.view(np.uint8).reshape(n, -1)
    return [base64.b64encode(row.tobytes()).decode() for row in raw]


def id_ranges(docs: DataFrame, doc_id: str, text: str, range_bytes: int) -> np.ndarray:
    """First ids of consecutive ranges of about so many bytes: one number per range comes to the driver."""

    def run(batches):
        held = None
        for batch in batches:
            ids, sizes = batch.column("id").to_numpy(), batch.column("size").to_numpy()
            cuts = []
            for own, size in zip(ids.tolist(), sizes.tolist(), strict=True):
                if held is None or held >= range_bytes:
                    cuts.append(own)
                    held = 0
                held += size
            yield pa.RecordBatch.from_arrays([pa.array(cuts, pa.int64())], ["first"])

    sizes = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LOWEST)).alias("id"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("size"),
    )
    cuts = sizes.repartitionByRange("id").sortWithinPartitions("id").mapInArrow(run, "first long")
    return np.unique(np.array([r[0] for r in cuts.collect()], np.int64))


#: Stands for a null id, which comes first.
LOWEST = -(1 << 63)


def compare_successors(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text (second half replaced by the begin
    of the next document), the edited text's digest, and the likenesses."""
    firsts = docs.sparkSession.sparkContext.broadcast(id_ranges(docs, doc_id, text, range_bytes))

    def deal(batches):
        cuts = firsts.value
        for batch in in_chunks(batches, "text"):
            key = batch.column("key").to_numpy()
            at = np.maximum(np.searchsorted(cuts, key, "right") - 1, 0)
            ahead = np.flatnonzero(cuts[at] == key)
            take = pa.array(np.concatenate([np.arange(len(key)), ahead]))
            spot = np.concatenate([at, (at[ahead] - 1) % len(cuts)])
            extra = np.concatenate([np.zeros(len(key), bool), np.ones(len(ahead), bool)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(spot), pa.array(extra), *(c.take(take) for c in batch.columns)],
                ["range", "is_next", *batch.schema.names],
            )

    def meet(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        texts = group["text"].to_pylist()
        key, extra = group["key"].to_pylist(), group["is_next"].to_pylist()
        own = sorted((k for k in range(len(key)) if not extra[k]), key=lambda k: (key[k], texts[k]))
        more = sorted((k for k in range(len(key)) if extra[k]), key=lambda k: (key[k], texts[k]))
        follow = [*own[1:], more[0]]
        parts = []
        size = 0
        begin = 0
        for k in range(len(own)):
            size += len(texts[own[k]])
            if size >= (1 << 20) or k == len(own) - 1:
                parts.append(_compared(group, texts, own[begin : k + 1], follow[begin : k + 1]))
                begin, size = k + 1, 0
        return pa.concat_tables(parts)

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LOWEST)).alias("key"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).mapInArrow(deal, f"range long, is_next boolean, key long, doc_id {kind}, text string")
    return rows.groupBy("range").applyInArrow(
        meet,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def _compared(group: pa.Table, texts: list[str], own: list[int], follow: list[int]) -> pa.Table:
    n = len(own)
    mine = [texts[k] for k in own]
    after = [texts[k] for k in follow]
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(mine, after, strict=True)]
    first = paragraphs(*flat_text(pa.array(mine, pa.large_string())))
    changed = paragraphs(*flat_text(pa.array(edited, pa.large_string())))
    # The successors are the same texts, one further on, but for the last.
    last_owner, last_digest = paragraphs(*flat_text(pa.array(after[-1:], pa.large_string())))
    ahead = first[0] > 0
    following = (
        np.concatenate([first[0][ahead] - 1, last_owner + n - 1]),
        np.concatenate([first[1][ahead], last_digest]),
    )
    return pa.table(
        {
            "doc_id": group["doc_id"].take(pa.array(own)),
            "n_chars": pa.array([len(x) for x in mine], pa.int64()),
            "edited_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in edited],
            "fingerprint": as_strings(*first, n),
            "edited_fingerprint": as_strings(*changed, n),
            "near_edited": likeness(first, changed, n),
            "near_next": likeness(first, following, n),
        }
    )


def op7_fingerprint(spark, sf_dir):
    return compare_successors(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
