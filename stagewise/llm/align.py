"""Alignment of the tokens of two tokenizers by merge-path partitioning.

A text is cut by A (byte-level BPE) and by B (sentence pieces); what is aligned are the byte offsets where tokens end. The two
ascending lists of ends are merged in pieces of equal work: a binary search along each diagonal of the merge grid finds how
many ends of A lie in front of it, so pieces do not depend on each other and are merged side by side. Every end but the second of
an equal pair emits one overlap (the token of A and the token of B that reach over the bytes in front of it); equal ends
close a group. What a piece cannot see, whether its first end equals the last one of the piece before, is stitched
afterwards, together with the numbers of its groups.

Tokenizing is shared: neither vocabulary joins bytes across a space that stands between two filled characters, so a text
is cut there, and every distinct segment is encoded once per task (compared byte for byte). Overlaps of token ids
are counted per chunk of texts, summed over the corpus, and only the counts of a chunk's own pairs come back to
its documents; nothing of the corpus is broadcast.

Defined cases: null and empty texts, and texts that either tokenizer does not give back byte for byte, have no tokens: zeros and an empty ``groups``;
repeated rows each count; null ids are carried; a single text longer than a chunk is worked on whole by one task; further columns are not carried.
"""

from __future__ import annotations

import hashlib
import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.repeats import pack, unpack
from stagewise.llm.shared import Rolling, byte_values, flat_text, in_chunks, read_table, ship_code, written

#: Bytes of text that are aligned and counted at once.
TEXT_BYTES = 1 << 20
#: Ends in a piece of the merge.
PIECE = 512
#: Distinct segments whose tokens a task keeps.
KEPT_SEGMENTS = 600_000
ENCODED_AT_ONCE = 2000
SPACE = 0x20
#: Bytes that can begin a white-space character beyond ASCII; no cut in front of them.
WIDE_BLANKS = (0xC2, 0xE1, 0xE2, 0xE3)


def gather(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``begin`` and are ``size`` long, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)


def offsets(size: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(size, dtype=np.int64)])


# --- merge path -------------------------------------------------------------------


def diagonals(a: np.ndarray, b: np.ndarray, width: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many values of ``a`` and of ``b`` lie in front of every ``width``-th step of their merge (``a`` first where
    equal): one binary search per diagonal, all at once."""
    total = len(a) + len(b)
    step = np.append(np.arange(0, total, width), total)
    low, high = np.maximum(step - len(b), 0), np.minimum(step, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        # a[middle] belongs in front of the diagonal if it does not exceed the value of b that would be the last one in front.
        at = np.where(open_, middle, 0)
        front = a[np.minimum(at, len(a) - 1)] <= b[np.clip(step - at - 1, 0, len(b) - 1)]
        low, high = np.where(open_ & front, middle + 1, low), np.where(open_ & ~front, middle, high)
    return low, step - low


def merged(a: np.ndarray, b: np.ndarray, width: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps (number in ``a``, number in ``b``) in order, the group of each, and the ends that close groups."""
    from_a, from_b = diagonals(a, b, width)
    in_a, in_b = np.diff(from_a), np.diff(from_b)
    pieces = len(in_a)
    far = np.iinfo(np.int64).max
    ends = np.full((pieces, width), far, np.int64)
    column = np.arange(width)
    mine = column < in_a[:, None]
    ends[mine] = a
    ends[(column >= in_a[:, None]) & (column < (in_a + in_b)[:, None])] = b
    # Each row is two ascending runs; a stable sort merges them with a in front where equal.
    order = np.argsort(ends, axis=1, kind="stable")
    ends = np.take_along_axis(ends, order, axis=1)
    is_a = order < in_a[:, None]
    filled = ends < far
    before_a = np.cumsum(is_a, axis=1) - is_a
    before_b = column - before_a
    closes = np.zeros_like(is_a)
    closes[:, 1:] = ~is_a[:, 1:] & (ends[:, 1:] == ends[:, :-1])
    # Stitching: the end in front of a piece, and the groups that pieces before it have closed.
    last = a[np.maximum(from_a[:-1] - 1, 0)] if len(a) else np.zeros(pieces, np.int64)
    closes[:, 0] = ~is_a[:, 0] & (from_a[:-1] > 0) & (ends[:, 0] == last)
    closes &= filled
    closed = offsets(closes.sum(axis=1))[:-1]
    group = closed[:, None] + np.cumsum(closes, axis=1) - closes
    emits = filled & ~closes
    return (
        (from_a[:-1, None] + before_a)[emits], (from_b[:-1, None] + before_b)[emits], group[emits], ends[closes],
    )


# --- tokenizers -------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others in order from 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoders:
    """Both tokenizers from the contents of their files, and the bytes of their tokens."""

    def __init__(self, a_file: bytes, b_file: bytes):
        # A task has one core.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        by_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(c in letters for c in token)
            by_a[number] = bytes(letters[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        by_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.letters = [np.frombuffer(b"".join(own), np.uint8) for own in (by_a, by_b)]
        self.size = [np.array([len(t) for t in own], np.int32) for own in (by_a, by_b)]
        self.at = [offsets(own) for own in self.size]
        # Cutting in front of a space is right only if no piece of B holds one behind another character.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_ids, self.b_ids = len(by_a), len(by_b)

    def encode(self, segments: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Whether both give each segment (a space in front included) back byte for byte, and for A and B the ids of all of them,
        where each token ends in its segment, and how many tokens each has (none where it is not given back)."""
        good = np.ones(len(segments), bool)
        wanted = np.frombuffer(b"".join(segments), np.uint8)
        length = np.array([len(x) for x in segments], np.int64)
        sides = []
        for side, run in ((0, self._by_a), (1, self._by_b)):
            lists = run(segments)
            count = np.array([len(x) for x in lists], np.int64)
            ids = np.fromiter(chain.from_iterable(lists), np.int32, int(count.sum()))
            size = self.size[side][ids].astype(np.int64)
            before = offsets(size)
            got = np.diff(before[offsets(count)])
            fits = got == length
            # Bytes are compared where the lengths are right.
            own = np.repeat(fits, count)
            given = self.letters[side][gather(self.at[side][ids[own]], size[own])]
            differs = given != wanted[gather(offsets(length)[:-1][fits], length[fits])]
            fits[np.flatnonzero(fits)[np.searchsorted(np.cumsum(length[fits]), np.flatnonzero(differs), "right")]] = False
            good &= fits
            sides.append((ids, before[1:] - np.repeat(before[offsets(count)[:-1]], count), count))
        for side, (ids, ends, count) in enumerate(sides):
            keep = np.repeat(good, count)
            sides[side] = (ids[keep], ends[keep].astype(np.int32), np.where(good, count, 0))
        return good, sides

    def _by_a(self, segments: list[bytes]) -> list[list[int]]:
        out = []
        for k in range(0, len(segments), ENCODED_AT_ONCE):
            some = [x.decode() for x in segments[k : k + ENCODED_AT_ONCE]]
            out += [e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False)]
        return out

    def _by_b(self, segments: list[bytes]) -> list[list[int]]:
        return self.b.encode([x[1:].decode() for x in segments], num_threads=1)


class Segments:
    """Tokens of the distinct segments that a task has met."""

    def __init__(self, encoders: Encoders):
        self.encoders = encoders
        self._empty()

    def _empty(self):
        none, zero = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.marks, self.entries = np.zeros(0, np.uint64), none
        self.text, self.text_at, self.good = np.zeros(0, np.uint8), zero, np.zeros(0, bool)
        self.ids, self.ends, self.at = [none, none], [none, none], [zero, zero]

    def _add(self, segments: list[bytes]) -> np.ndarray:
        """The entries that the segments get."""
        entry = len(self.good) + np.arange(len(segments))
        good, sides = self.encoders.encode(segments)
        self.good = np.concatenate([self.good, good])
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(segments), np.uint8)])
        self.text_at = np.concatenate([self.text_at, self.text_at[-1] + np.cumsum([len(s) for s in segments])])
        for side, (ids, ends, count) in enumerate(sides):
            self.ids[side] = np.concatenate([self.ids[side], ids])
            self.ends[side] = np.concatenate([self.ends[side], ends])
            self.at[side] = np.concatenate([self.at[side], self.at[side][-1] + np.cumsum(count)])
        return entry

    def of(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of every segment of ``data``."""
        if len(self.marks) > KEPT_SEGMENTS:
            self._empty()
        marks = Rolling(byte_values(data)).of(begin, end)
        kinds, first, which = np.unique(marks, return_index=True, return_inverse=True)
        place = np.searchsorted(self.marks, kinds)
        known = np.zeros(len(kinds), bool)
        if len(self.marks):
            known = self.marks[np.minimum(place, len(self.marks) - 1)] == kinds
        entry = np.zeros(len(kinds), np.int64)
        entry[known] = self.entries[place[known]]
        raw = data.tobytes()
        if not known.all():
            spots = first[~known]
            entry[~known] = self._add([raw[a:z] for a, z in zip(begin[spots].tolist(), end[spots].tolist(), strict=True)])
            marks = np.concatenate([self.marks, kinds[~known]])
            order = np.argsort(marks, kind="stable")
            self.marks, self.entries = marks[order], np.concatenate([self.entries, entry[~known]])[order]
        entry = entry[which]
        # Equal hashes are not yet equal bytes.
        size = self.text_at[entry + 1] - self.text_at[entry]
        same = size == end - begin
        if same.all():
            differs = data != self.text[gather(self.text_at[entry], size)]
            if not differs.any():
                return entry
            same[np.searchsorted(end, np.flatnonzero(differs), "right")] = False
        odd = np.flatnonzero(~same)
        entry[odd] = self._add([raw[begin[k] : end[k]] for k in odd.tolist()])
        return entry


def cut_places(data: np.ndarray, starts: np.ndarray, cuts: bool) -> np.ndarray:
    """Where segments begin: texts, and spaces between two filled characters."""
    begins = np.zeros(len(data), bool)
    if cuts and len(data) > 2:
        allowed = np.ones(256, bool)
        allowed[: SPACE + 1] = False
        follows = allowed.copy()
        follows[list(WIDE_BLANKS)] = False
        begins[1:-1] = (data[1:-1] == SPACE) & allowed[data[:-2]] & follows[data[2:]]
    begins[starts] = True
    return np.flatnonzero(begins)


# --- chunks of texts --------------------------------------------------------------


def _number_table(count: int, ending: bytes) -> list[bytes]:
    return [b"%d%s" % (k, ending) for k in range(count)]


class Writer:
    """Decimal ids with what stands behind them, as flat bytes."""

    def __init__(self, a_ids: int, b_ids: int):
        # In order: A followed by A, last A of a group, B followed by B, last B of a group, last B of a text.
        kinds = [(a_ids, b","), (a_ids, b"|"), (b_ids, b","), (b_ids, b";"), (b_ids, b"")]
        self.base = offsets(np.array([n for n, _ in kinds]))
        words = [w for n, ending in kinds for w in _number_table(n, ending)]
        self.size = np.array([len(w) for w in words], np.int64)
        self.letters = np.frombuffer(b"".join(words), np.uint8)
        self.at = offsets(self.size)

    def write(self, kind: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word = self.base[kind] + number
        size = self.size[word]
        return self.letters[gather(self.at[word], size)], offsets(size)


def aligned(texts: pa.Array, segments: Segments, writer: Writer, width: int = PIECE) -> dict:
    """Counts and overlaps of the texts of a chunk: arrays with one entry per text, ``pair`` codes and
    the text of each overlap, and ``groups`` as bytes per text."""
    flat, begins = flat_text(texts)
    size = np.diff(begins)
    filled = np.flatnonzero(size > 0)
    # A space in front of every filled text.
    starts = begins[:-1][filled] + np.arange(len(filled))
    data = np.full(len(flat) + len(filled), SPACE, np.uint8)
    keep = np.ones(len(data), bool)
    keep[starts] = False
    data[keep] = flat
    begin = cut_places(data, starts, segments.encoders.cuts)
    end = np.append(begin[1:], len(data))
    entry = segments.of(data, begin, end)
    owner = np.searchsorted(starts, begin, "right") - 1
    lost = np.zeros(len(filled), bool)
    lost[owner[~segments.good[entry]]] = True
    use = ~lost[owner]
    begin, entry, owner = begin[use], entry[use], owner[use]
    ids, ends, texts_of = [], [], []
    for side in (0, 1):
        count = segments.at[side][entry + 1] - segments.at[side][entry]
        place = gather(segments.at[side][entry], count)
        ids.append(segments.ids[side][place])
        ends.append(np.repeat(begin, count) + segments.ends[side][place])
        texts_of.append(np.repeat(filled[owner], count))
    (a_id, b_id), (a_end, b_end), (a_text, b_text) = ids, ends, texts_of
    n = len(texts)
    link_a, link_b, group, closing = merged(a_end, b_end, width)
    a_group, b_group = np.zeros(len(a_id), np.int64), np.zeros(len(b_id), np.int64)
    a_group[link_a], b_group[link_b] = group, group

    # Groups one after the other, the tokens of A in front of those of B.
    groups = len(closing)
    per_a, per_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    at_a = np.arange(len(a_id)) + offsets(per_b)[a_group]
    at_b = np.arange(len(b_id)) + offsets(per_a)[b_group + 1]
    kind, number = np.zeros(len(a_id) + len(b_id), np.int64), np.zeros(len(a_id) + len(b_id), np.int64)
    a_last, b_last, text_last = np.ones(len(a_id), bool), np.ones(len(b_id), bool), np.ones(len(b_id), bool)
    a_last[:-1], b_last[:-1] = a_group[1:] != a_group[:-1], b_group[1:] != b_group[:-1]
    text_last[:-1] = b_text[1:] != b_text[:-1]
    kind[at_a], number[at_a] = a_last, a_id
    kind[at_b], number[at_b] = 2 + b_last.astype(np.int64) + text_last, b_id
    letters, letter_at = writer.write(kind, number)
    n_a, n_b = np.bincount(a_text, minlength=n), np.bincount(b_text, minlength=n)
    cut = letter_at[offsets(n_a + n_b)]
    group_text = b_text[np.flatnonzero(b_last)]
    link_text = a_text[link_a]
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(group_text, minlength=n), "n_links": np.bincount(link_text, minlength=n),
        "groups": [letters[cut[k] : cut[k + 1]].tobytes() for k in range(n)],
        "pair": a_id[link_a].astype(np.int64) * segments.encoders.b_ids + b_id[link_b], "text": link_text,
    }


def align_tokens(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    spelled: bool = True,
    text_bytes: int = TEXT_BYTES,
) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, and with ``spelled`` the ``groups``
    themselves (``a1,a2|b1;a3|b2``). An overlap's count is how often its two ids overlap in all of ``docs``; ``n_best`` are the
    overlaps whose count is the highest of their B id. The files of the tokenizers are read by the driver and sent with the code."""
    spark = docs.sparkSession
    ship_code(spark)
    with open(a_path, "rb") as file_a, open(b_path, "rb") as file_b:
        files = spark.sparkContext.broadcast((file_a.read(), file_b.read()))  # of a vocabulary's size
    kind = docs.schema[doc_id].dataType.simpleString()
    counts = "n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>"
    schema = (
        f"chunk long, doc_id array<{kind}>, {counts}, sha array<string>, groups array<string>, "
        "entries binary, entry binary, times binary, pair array<long>, n array<long>"
    )

    def run(batches):
        encoders = Encoders(*files.value)
        segments, writer = Segments(encoders), Writer(encoders.a_ids, encoders.b_ids)
        base, made = TaskContext.get().partitionId() << 32, 0
        for batch in in_chunks(_joined(batches, "text", text_bytes), "text", text_bytes):
            found = aligned(batch.column("text"), segments, writer)
            pair, which, n = np.unique(found["pair"], return_inverse=True, return_counts=True)
            # Each text's own pairs with how often they occur in it.
            own, times = np.unique(found["text"] * max(1, len(pair)) + which, return_counts=True)
            of_text, entry = np.divmod(own, max(1, len(pair)))
            groups = found["groups"]
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([base + made], pa.int64()),
                    "doc_id": _one_list(batch.column("doc_id")),
                    **{c: _one_list(pa.array(found[c], pa.int64())) for c in ("n_a", "n_b", "n_groups", "n_links")},
                    "sha": _one_list(pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string())),
                    "groups": _one_list(pa.array([g.decode() for g in groups] if spelled else [], pa.string())),
                    "entries": [pack(np.bincount(of_text, minlength=batch.num_rows).astype(np.uint32))],
                    "entry": [pack(entry.astype(np.uint32))],
                    "times": [pack(times.astype(np.uint32))],
                    "pair": _one_list(pa.array(pair, pa.int64())),
                    "n": _one_list(pa.array(n, pa.int64())),
                }
            )
            made += 1

    chunks = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema))
    met = chunks.select("chunk", F.posexplode(F.arrays_zip("pair", "n")).alias("entry", "p")).select(
        "chunk", "entry", F.col("p.pair").alias("pair"), F.col("p.n").alias("n")
    )
    b_ids = Encoders(*files.value).b_ids
    total = met.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair") % b_ids)
    highest = total.groupBy("b").agg(F.max("count").alias("highest"))
    known = written(total.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best")))
    back = met.select("chunk", "entry", "pair").join(known, "pair").select(F.col("chunk").alias("of"), "entry", "count", "best")
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    out += ", groups string" if spelled else ""

    def settle(chunk: pa.Table, counted: pa.Table) -> pa.Table:
        rows = {c: _cells(chunk[c]) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        size = unpack(chunk["entries"][0].as_py()).astype(np.int64)
        entry, times = (unpack(chunk[c][0].as_py()).astype(np.int64) for c in ("entry", "times"))
        count, best = np.zeros(counted.num_rows, np.int64), np.zeros(counted.num_rows, np.int64)
        place = counted["entry"].to_numpy()
        count[place], best[place] = counted["count"].to_numpy(), counted["best"].to_numpy()
        at = offsets(size)
        sums = {
            "n_best": offsets(times * best[entry] if len(entry) else times),
            "count_sum": offsets(times * count[entry] if len(entry) else times),
        }
        columns = rows | {c: pa.array(s[at[1:]] - s[at[:-1]], pa.int64()) for c, s in sums.items()}
        columns["groups_sha256"] = _cells(chunk["sha"])
        if spelled:
            columns["groups"] = _cells(chunk["groups"])
        return pa.table(columns)

    left = chunks.select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "groups", "entries", "entry", "times")
    return left.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(settle, out)


def _one_list(values: pa.Array) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _cells(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks().flatten()


def _joined(batches, text: str, most: int):
    """Small batches together, up to about ``most`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size or held:
        for batch in pa.Table.from_batches(held).combine_chunks().to_batches():
            yield batch


def op12_align(spark, sf_dir):
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align_tokens(docs, *files, spelled=False)
