"""Benchmark decontamination by suffix arrays over the training shards.

A shard is a batch of whole documents inside a task. Its words are hashed, and the words that stand in
runs of benchmark word pairs (nothing else can hold a window) become a suffix array, sorted by prefix
doubling. Every suffix of the benchmark is then looked up by binary search, all at once, one word
deeper each step: the interval of the array at the window's depth gives all occurrences of the
window. The depth at which a place drops out of the interval is its longest verbatim match; of these every document
keeps its own longest (the first in the document, of the least item, if several are as long), whatever rows share the batch.

The benchmark goes to the tasks in blocks of ``block_bytes`` text at most (by measured size), one Python step per
block over the same rows, so neither side is shuffled and a benchmark of any size fits.

Defined cases: null and empty texts have no words and no hits; an item without words has no window; an item
shorter than the window is one window; equal items and equal documents each count; a null item id
reads as the empty string; further columns are kept, and own columns that clash get a leading underscore.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.llm.shared import Words, byte_class, flat_text, in_chunks, mix, read_table, ship_code

WINDOW = 10

#: Benchmark text that goes to the tasks at once.
BLOCK_BYTES = 32 << 20

# Everything in ASCII that is no letter or digit (after lower-casing).
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

FOUND = "n_words long, hits array<struct<begin:long,end:long>>, items array<string>, longest long, longest_begin long, longest_item string"
EDGE = np.uint64(0)


class Suffixes:
    """The suffixes of a block of items, and what a shard word must be to matter."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int):
        words = Words(*flat_text(texts), byte_class(SEPARATORS))
        self.ids = ids
        self.hash = np.maximum(words.hash, np.uint64(1))
        size = np.repeat(words.count, words.count)
        place = np.arange(len(self.hash)) - np.repeat(words.first[:-1], words.count)
        self.item = words.text
        self.left = size - place  # words from here to the item's end
        self.depth = np.minimum(size, window)
        self.is_window = self.left >= self.depth
        self.shortest = int(self.depth.min()) if len(self.depth) else 0
        self.longest = int(size.max()) if len(size) else 0
        if self.shortest > 1:
            self.pair = self._bitmap(pair_hash(self.hash)[self.left[:-1] > 1])
        else:
            self.pair = self._bitmap(mix(self.hash))

    @staticmethod
    def _bitmap(keys: np.ndarray) -> np.ndarray:
        bits = max(16, math.ceil(math.log2(max(1, len(keys)))) + 6)
        table = np.zeros(1 << min(bits, 26), bool)
        table[keys & np.uint64(len(table) - 1)] = True
        return table

    def candidates(self, words: Words, hashes: np.ndarray) -> np.ndarray:
        """Words of the shard inside runs that are long enough for the shortest window."""
        n = len(hashes)
        mask = np.uint64(len(self.pair) - 1)
        if self.shortest == 1:
            return self.pair[mix(hashes) & mask]
        linked = np.zeros(n + 1, bool)
        linked[: n - 1] = self.pair[pair_hash(hashes) & mask]
        linked[words.first[1:][words.count > 0] - 1] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[False], linked])))
        begin, end = edges[::2], edges[1::2]
        long = end - begin + 1 >= self.shortest
        inside = np.zeros(n + 1, np.int32)
        np.add.at(inside, begin[long], 1)
        np.add.at(inside, end[long] + 1, -1)
        return np.cumsum(inside[:-1]) > 0


def pair_hash(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[:-1] * np.uint64(3) + hashes[1:])


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``symbols`` sorted by the ``depth`` symbols that follow; ``EDGE`` ends a suffix."""
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    rank[symbols == EDGE] = 0
    reach = 1
    while reach < depth:
        after = np.zeros_like(rank)
        after[:-reach] = rank[reach:]
        after[rank == 0] = 0
        both = rank * (rank.max() + 1) + after
        kinds, new = np.unique(both, return_inverse=True)
        new = new.astype(np.int64) + 1
        new[rank == 0] = 0
        done = len(kinds) == len(symbols)
        rank, reach = new, reach * 2
        if done:
            break
    return np.argsort(rank, kind="stable")


def narrow(column: np.ndarray, low: np.ndarray, high: np.ndarray, value: np.ndarray, right: bool):
    """Binary search of each value in its own sorted stretch of ``column``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        at = column[np.minimum(middle, len(column) - 1)]
        up = open_ & ((at <= value) if right else (at < value))
        low = np.where(up, middle + 1, low)
        high = np.where(open_ & ~up, middle, high)


def look_up(tests: Suffixes, symbols: np.ndarray, array: np.ndarray):
    """For all benchmark suffixes the interval of the array at the window's depth; for all places of the array
    the depth of their longest match and the first benchmark suffix that has it."""
    total = len(tests.hash)
    low, high = np.zeros(total, np.int64), np.zeros(total, np.int64)
    best, by = np.zeros(len(array), np.int64), np.zeros(len(array), np.int64)
    alive = np.arange(total)
    a, z = np.zeros(total, np.int64), np.full(total, len(array))
    depth = 0
    padded = np.concatenate([symbols, np.zeros(tests.longest + 1, np.uint64)])

    def leave(which: np.ndarray, a: np.ndarray, z: np.ndarray) -> None:
        """Some or all places of these intervals match no deeper. Those that do are overwritten later."""
        if depth < tests.shortest or not len(a):
            return
        # Intervals of one depth are equal or apart; of equal ones the first suffix counts.
        a, first = np.unique(a, return_index=True)
        z, which = z[first], which[first]
        size = z - a
        at = np.arange(size.sum()) + np.repeat(a - (np.cumsum(size) - size), size)
        which = np.repeat(which, size)
        by[at] = np.where(best[at] == depth, np.minimum(by[at], which), which)
        best[at] = depth

    while len(alive):
        column = padded[array + depth]
        value = tests.hash[alive + depth]
        old_a, old_z = a, z
        a, z = narrow(column, a, z, value, False), narrow(column, a, z, value, True)
        less = (z - a) < (old_z - old_a)
        leave(alive[less], old_a[less], old_z[less])
        depth += 1
        some = a < z
        alive, a, z = alive[some], a[some], z[some]
        at = tests.depth[alive] == depth
        low[alive[at]], high[alive[at]] = a[at], z[at]
        more = tests.left[alive] > depth
        leave(alive[~more], a[~more], z[~more])
        alive, a, z = alive[more], a[more], z[more]
    return low, high, best, by


def search(tests: Suffixes, texts: pa.Array):
    """Words of each text, hit ranges and items of the texts that have any, and longest matches."""
    words = Words(*flat_text(texts), byte_class(SEPARATORS))
    hits, items, longest = {}, {}, {}
    if not len(tests.hash) or not len(words.begin):
        return words.count, hits, items, longest
    hashes = np.maximum(words.hash, np.uint64(1))
    keep = np.flatnonzero(tests.candidates(words, hashes))
    if not len(keep):
        return words.count, hits, items, longest
    text = words.text[keep]
    new = np.ones(len(keep), bool)
    new[1:] = (np.diff(keep) > 1) | (np.diff(text) > 0)
    # Stretches follow each other with an edge symbol between them.
    shift = np.arange(len(keep)) + np.cumsum(new)
    symbols = np.zeros(shift[-1] + 2, np.uint64)
    symbols[shift] = hashes[keep]
    word_at = np.full(len(symbols), -1)
    word_at[shift] = keep
    array = suffix_array(symbols, tests.longest)
    array = array[symbols[array] != EDGE]
    low, high, best, by = look_up(tests, symbols, array)
    found = np.flatnonzero(tests.is_window & (low < high))
    doc_of = np.full(len(symbols), -1)
    doc_of[shift] = text
    first = words.first
    if len(found):
        depth = tests.depth[found]
        intervals, back = np.unique(np.stack([low[found], high[found], depth]), axis=1, return_inverse=True)
        back = back.reshape(-1)
        cover = np.zeros(len(words.begin) + 1, np.int64)
        holders = []
        for a, z, d in intervals.T:
            at = word_at[array[a:z]]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + d, -1)
            holders.append(np.unique(doc_of[array[a:z]]))
        inside = np.cumsum(cover[:-1]) > 0
        for k in np.unique(np.concatenate(holders)):
            part = np.concatenate([[False], inside[first[k] : first[k + 1]], [False]])
            edges = np.flatnonzero(part[1:] != part[:-1])
            hits[int(k)] = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        pairs = np.unique(np.stack([back, tests.item[found]]), axis=1)
        for interval, item in pairs.T:
            for k in holders[interval]:
                items.setdefault(int(k), set()).add(tests.ids[item])
    held = np.flatnonzero(best)
    held = held[np.lexsort((word_at[array[held]], -best[held], doc_of[array[held]]))]
    docs, firsts = np.unique(doc_of[array[held]], return_index=True)
    for k, r in zip(docs.tolist(), held[firsts], strict=True):
        longest[k] = (int(best[r]), int(word_at[array[r]] - first[k]), tests.ids[tests.item[by[r]]])
    return words.count, hits, items, longest


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _step(block, text: str, names: list[str], window: int, is_first: bool, schema: pa.Schema):
    """One pass over the rows with one block of the benchmark."""

    def run(batches):
        ids, texts = block.value
        tests = Suffixes(ids, pa.array(texts, pa.string()), window)
        for batch in in_chunks(batches, text):
            counts, hits, items, longest = search(tests, batch.column(text))
            n = batch.num_rows
            have = [None if is_first else batch.column(c).to_pylist() for c in names]
            rows = {c: [] for c in names}
            for k in range(n):
                old = (None, [], [], 0, None, None) if is_first else tuple(h[k] for h in have)
                ranges = hits.get(k, [])
                if old[1]:
                    ranges = merged(ranges + [(r["begin"], r["end"]) for r in old[1]])
                held = sorted({*old[2], *items.get(k, ())}) if old[2] or k in items else []
                # The longest; then the first in the document; then the least item.
                best = min((old[3:], longest.get(k, (0, None, None))), key=lambda x: (-x[0], x[1] or 0, x[2] or ""))
                row = (int(counts[k]), [{"begin": a, "end": z} for a, z in ranges], held, *best)
                for c, value in zip(names, row, strict=True):
                    rows[c].append(value)
            others = [batch.column(c) for c in batch.schema.names if c not in names]
            made = [pa.array(rows[c], schema.field(c).type) for c in names]
            yield pa.RecordBatch.from_arrays([*others, *made], schema=schema)

    return run


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All columns of ``docs`` and, in words: ``n_words``, ``hits`` (merged ranges inside occurrences of
    windows), ``items`` (ids, sorted) and the longest verbatim match of ``shortest window`` words or more."""
    spark = docs.sparkSession
    ship_code(spark)
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col(item_text), F.lit("")).alias("body"),
    )
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    fields = T.StructType.fromDDL(FOUND).fields
    names = []
    for f in fields:
        while f.name in docs.columns:
            f.name = f"_{f.name}"
        names.append(f.name)
    target = T.StructType([*docs.schema.fields, *fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)
    result = docs
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id", "body"), F.lit(blocks)) == k) if blocks > 1 else items
        rows = part.orderBy("id", "body").toArrow()
        block = spark.sparkContext.broadcast((rows["id"].to_pylist(), rows["body"].to_pylist()))
        result = result.mapInArrow(_step(block, text, names, window, k == 0, arrow), target)
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any occurrence of a window, with the columns they came with."""
    found = find_benchmark(docs, benchmark, **options)
    hits = found.columns[len(docs.columns) + 1]
    return found.where(F.size(hits) == 0).select(*docs.columns)


def op6_decontaminate(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(docs, read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + h["end"] - h["begin"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def decontaminate_sql(documents: str = "documents") -> str:
    """The result of :func:`op6_decontaminate` with all windows spelled out as strings."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def words(table: str, key: str) -> str:
        return f"""SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORD}') AS w
    FROM {table}"""

    return f"""
WITH item AS ({words("benchmark", "coalesce(item_id::VARCHAR, '') AS item_id")}
), item_window AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n,
         unnest([array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') FOR i IN
                 range(1, len(w) - least(len(w), {WINDOW}) + 2)]) AS body
  FROM item WHERE len(w) > 0
), doc AS ({words(documents, "doc_id")}
), sizes AS (SELECT DISTINCT n FROM item_window
), place AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n
), hit AS (
  SELECT p.doc_id, p.i, p.n, t.item_id FROM place p
  JOIN item_window t ON t.n = p.n AND t.body = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')
), word_hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id
), item_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word_hit USING (doc_id) LEFT JOIN item_hit USING (doc_id)"""
