"""Suffix-array dedup: removes every byte that a string of ``length`` bytes covers which also starts in a document of a
smaller id.

Full suffix arrays hold an entry per byte. Here every string of ``length`` bytes elects one suffix inside it, the one
whose first ``gram`` bytes hash lowest (leftmost on ties): equal strings elect the same one, so only elected suffixes, one in about
``(length - gram) / 2`` bytes, have to meet. A first pass counts grams in packed, hash-bucketed lists and leaves a bitmap of bounded
size of those that more than one document holds; it only lets too much pass, never too little. A second pass sends on each elected suffix
that it lets pass, with the bytes of all strings that elected it; a task sends equal ones once, with the documents that hold them.

The suffixes are range-partitioned by their leading bytes at splitters that Spark samples, so equal strings share a bucket whatever
side of a splitter their neighbours are on. A bucket cuts at changes of the leading bytes, sorts the strings by
multikey quicksort over 8-byte tokens (only ties go on to the next token) and compares neighbours; the least id among
equal strings decides. The result travels back to the documents as byte ranges.

Leading bytes that very many places share (a phrase before ever new words) would be one group that no bucket can cut. A
sample of the documents finds them; their strings are spelled out, reduced to the least id by an aggregate that combines
before the exchange, and joined back, so that only equal strings meet. A string elects by its own bytes, so all its places
go the same way, and the sample decides about effort only.

Exact copies of a whole text meet first, by digest: the one of the least id goes on, the others are covered whole.

Defined cases: null texts are empty; texts shorter than ``length`` lose nothing; equal ids never remove from each other;
a null id counts as the least; equal rows get equal results; further columns are not carried.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.repeats import gathered, in_bitmap, repeated_bitmap
from stagewise.llm.shared import Rolling, byte_values, flat_text, in_chunks, read_table, written

LENGTH = 50
GRAM = 24
#: Elected suffixes that a task gathers before it sends them on.
GATHER = 150_000
#: Entries that a bucket sorts at once (a group of equal leading bytes is never cut).
SORT_AT_ONCE = 15_000
#: Places with the same leading bytes from which on their strings are spelled out, the text that is sampled to find
#: them at least, and one part in how many it is at least.
HOT_PLACES = 100_000
SAMPLE_BYTES = 64 << 20
SAMPLE_PART = 256
LOWEST = -(1 << 63)


def elect(data: np.ndarray, begins: np.ndarray, length: int, gram: int):
    """Runs of neighbouring strings that elect the same suffix: first and last string, the suffix, its hash."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64), None
    rolling = Rolling(byte_values(data))
    place = np.arange(n - gram + 1)
    hashes = rolling.of(place, place + gram)
    value = (hashes & np.uint64(0xFFFFFFFF00000000)) | place.astype(np.uint64)
    width, least = 1, value
    window = length - gram + 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
    chosen = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Strings lie inside one text: leave out those that begin too near its end.
    inside = np.ones(n + 1, bool)
    for back in range(length - 1):
        at = begins[1:] - 1 - back
        inside[at[at >= 0]] = False
    start = np.flatnonzero(inside[: len(chosen)])
    if not len(start):
        return none, none, none, none.astype(np.uint64), None
    suffix = chosen[start]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(suffix) != 0) | (np.diff(start) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return start[first], start[last], suffix[first], hashes[suffix[first]], rolling


def multikey_groups(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by their tokens, and for each place in it whether a new row content begins."""
    order = np.argsort(tokens[:, 0], kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = tokens[order[1:], 0] != tokens[order[:-1], 0]
    for k in range(1, tokens.shape[1]):
        # Only rows whose tokens so far are tied go on.
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(new)[at]
        rows = order[at]
        rows = rows[np.lexsort((tokens[rows, k], group))]
        order[at] = rows
        differs = tokens[rows[1:], k] != tokens[rows[:-1], k]
        new[at[1:]] |= differs & (group[1:] == group[:-1])
    return order, new


def decide(before: pa.Array, suffix: pa.Array, least: np.ndarray, most: np.ndarray, length: int):
    """For every string of every entry the least id that holds it; runs of strings with one such id that
    is under the entry's greatest: entry, first and last string, id."""
    left, left_at = flat_bytes(before)
    right, right_at = flat_bytes(suffix)
    n_left, n_right = np.diff(left_at), np.diff(right_at)
    size = n_left + n_right
    whole_at = np.concatenate([[0], np.cumsum(size)])
    whole = np.zeros(whole_at[-1], np.uint8)
    whole[np.arange(len(left)) + np.repeat(whole_at[:-1] - left_at[:-1], n_left)] = left
    whole[np.arange(len(right)) + np.repeat(whole_at[:-1] + n_left - right_at[:-1], n_right)] = right
    strings = size - length + 1
    owner = np.repeat(np.arange(len(strings)), strings)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
    padded = -(-length // 8) * 8
    window = np.zeros((len(owner), padded), np.uint8)
    window[:, :length] = np.lib.stride_tricks.sliding_window_view(whole, length)[whole_at[owner] + step]
    tokens = window.view(">u8").astype(np.uint64)
    order, new = multikey_groups(tokens)
    starts = np.flatnonzero(new)
    low = np.minimum.reduceat(least[owner[order]], starts)
    held = np.empty(len(owner), np.int64)
    held[order] = np.repeat(low, np.diff(np.append(starts, len(order))))
    gone = held < most[owner]
    change = np.ones(len(owner), bool)
    change[1:] = (owner[1:] != owner[:-1]) | (held[1:] != held[:-1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(owner)) - 1
    keep = gone[first]
    first, last = first[keep], last[keep]
    return owner[first], step[first], step[last], held[first]


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def slices(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - begin
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], size)
    return pa.Array.from_buffers(
        pa.binary(), len(begin), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[at]))]
    )


#: Who holds an entry: id, mark of the text, place of the first string in the text.
HOLDER = np.dtype([("id", "<i8"), ("mark", "<i4"), ("at", "<i4")])


class Copies:
    """Exact copies of whole texts: a bitmap of repeated text hashes tells which rows have to meet; of those
    that do, the one of the least id goes on. Columns of the rows: ``id, mark, text, met``."""

    def __init__(self, rows: DataFrame, total: int):
        self.bits, cells = repeated_bitmap(rows.select("text"), "text", total, 1024, self.hashes)
        self.shipped = rows.sparkSession.sparkContext.broadcast(cells)  # 32 MB at most

    @staticmethod
    def hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        data, begins = flat_text(batch.column("text"))
        return Rolling(byte_values(data)).of(begins[:-1], begins[1:]), np.arange(batch.num_rows)


def split_copies(rows: DataFrame, total: int):
    """All rows that strings are taken from, a function that leaves out, inside a task, the rows whose stand-in is
    among them, and the exact copies of a text of smaller id as ``id, mark, n_bytes``."""
    found = Copies(rows, total)
    bits, shipped, hashes = found.bits, found.shipped, Copies.hashes

    def repeated(batch: pa.RecordBatch) -> np.ndarray:
        return in_bitmap(hashes(batch)[0], bits, np.frombuffer(shipped.value, np.uint8))

    def meeting(batches):
        for batch in in_chunks(batches, "text"):
            keep = repeated(batch)
            if keep.any():
                yield batch.filter(pa.array(keep))

    def own(batch: pa.RecordBatch) -> pa.RecordBatch:
        met = batch.column("met").to_numpy(zero_copy_only=False)
        keep = met | ~repeated(batch)
        return batch if keep.all() else batch.filter(pa.array(keep))

    met = rows.mapInArrow(meeting, "id long, mark int, text string")
    met = met.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    first = written(met.groupBy("digest").agg(F.min(F.struct("id", "mark", "text")).alias("first")))
    copies = (
        met.select("id", "mark", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
        .join(first.select("digest", F.col("first.id").alias("first_id")), "digest")
        .where(F.col("id") > F.col("first_id"))
        .select("id", "mark", "n_bytes")
    )
    together = rows.withColumn("met", F.lit(False)).unionByName(first.select("first.*", F.lit(True).alias("met")))
    return together, own, copies


def remove_repeats(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
) -> DataFrame:
    """One row per document: ``doc_id``, ``text`` (as it came), ``spans`` (byte ranges to remove, sorted, may overlap)."""
    if not 8 <= gram < length:
        raise ValueError("a gram has eight bytes or more and fewer than the string")
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LOWEST)).alias("id"),
        F.hash(F.col(text)).alias("mark"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    rows, own_rows, copies = split_copies(rows, total)

    def grams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        data, begins = flat_text(own_rows(batch).column("text"))
        _, _, suffix, hashes, _ = elect(data, begins, length, gram)
        return hashes, np.searchsorted(begins, suffix, "right") - 1

    bits, cells = repeated_bitmap(rows, "text", total, 16, grams)
    bitmap = spark.sparkContext.broadcast(cells)  # 32 MB at most

    hot = hot_leads(rows, own_rows, total, length, gram)
    hot_hashes = spark.sparkContext.broadcast(hot)

    def spelled(batches):
        """All strings of the hot leading bytes: the place of these in the string, its bytes, and who holds it where."""
        own = np.frombuffer(bitmap.value, np.uint8)
        for batch in in_chunks(batches, "text"):
            batch = own_rows(batch)
            data, begins = flat_text(batch.column("text"))
            first, last, suffix, hashes, _ = elect(data, begins, length, gram)
            if not len(first):
                continue
            keep = np.isin(hashes, hot_hashes.value)
            keep[keep] = in_bitmap(hashes[keep], bits, own)
            first, last, suffix = first[keep], last[keep], suffix[keep]
            size = last - first + 1
            start = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
            off = np.repeat(suffix, size) - start
            row = np.searchsorted(begins, start, "right") - 1
            for a in range(0, len(start), GATHER):
                one = slice(a, a + GATHER)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(off[one].astype(np.int32)), slices(data, start[one], start[one] + length),
                        batch.column("id").take(pa.array(row[one])), batch.column("mark").take(pa.array(row[one])),
                        pa.array(start[one] - begins[row[one]]),
                    ],
                    ["off", "string", "id", "mark", "at"],
                )

    def send(parts):
        hashes, holders = gathered([p[:2] for p in parts])
        before = pa.concat_arrays([p[2] for p in parts])
        suffix = pa.concat_arrays([p[3] for p in parts])
        order = np.argsort(hashes, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = hashes[order[1:]] != hashes[order[:-1]]
        first = np.flatnonzero(new)
        take = pa.array(order[first])
        ends = (np.append(first, len(order)) * HOLDER.itemsize).astype(np.int32)
        packed = pa.Array.from_buffers(
            pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(holders[order].tobytes())]
        )
        return pa.RecordBatch.from_arrays([before.take(take), suffix.take(take), packed], ["before", "suffix", "holders"])

    def gather(batches):
        own = np.frombuffer(bitmap.value, np.uint8)
        parts, held = [], 0
        for batch in in_chunks(batches, "text"):
            batch = own_rows(batch)
            data, begins = flat_text(batch.column("text"))
            first, last, suffix, hashes, rolling = elect(data, begins, length, gram)
            if not len(first):
                continue
            keep = in_bitmap(hashes, bits, own)
            if len(hot_hashes.value):
                keep &= ~np.isin(hashes, hot_hashes.value)
            first, last, suffix = first[keep], last[keep], suffix[keep]
            row = np.searchsorted(begins, suffix, "right") - 1
            holders = np.empty(len(first), HOLDER)
            holders["id"] = batch.column("id").to_numpy()[row]
            holders["mark"] = batch.column("mark").to_numpy()[row]
            holders["at"] = first - begins[row]
            # Equal bytes around a suffix at the same distance: the split is part of the key.
            key = rolling.of(first, last + length) ^ (suffix - first).astype(np.uint64)
            parts.append((key, holders, slices(data, first, suffix), slices(data, suffix, last + length)))
            held += len(first)
            if held >= GATHER:
                yield send(parts)
                parts, held = [], 0
        if held:
            yield send(parts)

    lead = F.substring("suffix", 1, gram)

    def judge(batches):
        def result(table: pa.Table):
            flat, places = flat_bytes(table["holders"])
            holders = np.frombuffer(flat.tobytes(), HOLDER)
            places = places // HOLDER.itemsize
            least = np.minimum.reduceat(holders["id"], places[:-1])
            most = np.maximum.reduceat(holders["id"], places[:-1])
            entry, begin, end, low = decide(table["before"], table["suffix"], least, most, length)
            times = np.diff(places)[entry]
            who = np.arange(times.sum()) + np.repeat(places[entry] - (np.cumsum(times) - times), times)
            gone = holders["id"][who] > np.repeat(low, times)
            who = who[gone]
            at = holders["at"][who].astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(holders["id"][who]), pa.array(holders["mark"][who]),
                    pa.array(at + np.repeat(begin, times)[gone]), pa.array(at + np.repeat(end, times)[gone] + length),
                ],
                ["of", "of_mark", "begin", "end"],
            )

        waiting, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            held += batch.num_rows
            if held < SORT_AT_ONCE:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            heads = leads(table["suffix"], gram)
            cuts = np.flatnonzero((heads[1:] != heads[:-1]).any(axis=1)) + 1
            if len(cuts):
                # What follows the last change may go on in the next batch.
                yield result(table.slice(0, int(cuts[-1])))
                table = table.slice(int(cuts[-1])).combine_chunks()
            waiting, held = table.to_batches(), table.num_rows
        if waiting:
            yield result(pa.Table.from_batches(waiting))

    found = (
        rows.mapInArrow(gather, "before binary, suffix binary, holders binary")
        .repartitionByRange(lead)
        .sortWithinPartitions(lead)
        .mapInArrow(judge, "of long, of_mark int, begin long, end long")
    )
    if len(hot):
        strings = written(rows.mapInArrow(spelled, "off int, string binary, id long, mark int, at long"))
        least = strings.groupBy("off", "string").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
        begin = F.col("at").alias("begin")
        found = found.unionByName(
            strings.join(least, ["off", "string"])
            .where("id > low")
            .select(F.col("id").alias("of"), F.col("mark").alias("of_mark"), begin, (F.col("at") + length).alias("end"))
        )
    whole = copies.where(F.col("n_bytes") >= length).select(
        F.col("id").alias("of"), F.col("mark").alias("of_mark"), F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")
    )
    ranges = (
        found.unionByName(whole)
        .groupBy("of", "of_mark")
        .agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("ranges"))
    )
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        ranges,
        (F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)) == F.col("of")) & (F.hash("text") == F.col("of_mark")),
        "left",
    ).select("doc_id", "text", F.col("ranges").alias("spans"))


def hot_leads(rows: DataFrame, own_rows, total: int, length: int, gram: int) -> np.ndarray:
    """Hashes of the leading bytes that, by a sample of the rows, ``HOT_PLACES`` places or more share, sorted."""
    part = max(1, min(SAMPLE_PART, int(total) // SAMPLE_BYTES))
    sample = rows.where(F.pmod(F.xxhash64("id", "mark"), F.lit(part)) == 0) if part > 1 else rows

    def leading(batches):
        for batch in in_chunks(batches, "text"):
            data, begins = flat_text(own_rows(batch).column("text"))
            _, _, _, hashes, _ = elect(data, begins, length, gram)
            kinds, times = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(times)], ["lead", "places"])

    found = sample.mapInArrow(leading, "lead long, places long").groupBy("lead").agg(F.sum("places").alias("places"))
    return np.sort(
        np.array([r.lead for r in found.where(F.col("places") * part >= HOT_PLACES).toLocalIterator()], np.int64).view(np.uint64)
    )


def leads(column: pa.Array, gram: int) -> np.ndarray:
    data, at = flat_bytes(column)
    return data[at[:-1][:, None] + np.arange(gram)]


def op10_suffixes(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digest(batches):
        for batch in in_chunks(batches, "text"):
            data, begins = flat_text(batch.column("text"))
            raw = data.tobytes()
            spans = batch.column("spans").to_pylist()
            removed, runs, kept = [], [], []
            for k in range(batch.num_rows):
                base, end = int(begins[k]), int(begins[k + 1])
                mark, at, gone, n = hashlib.sha256(), 0, 0, 0
                for span in spans[k] or ():
                    if not n or span["begin"] > at:
                        mark.update(raw[base + at : base + span["begin"]])
                        n += 1
                        at = span["begin"]
                    gone += max(0, span["end"] - at)
                    at = max(at, span["end"])
                mark.update(raw[base + at : end])
                removed.append(gone)
                runs.append(n)
                kept.append(mark.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(np.diff(begins)), pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()), pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return remove_repeats(docs).mapInArrow(
        digest, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
