"""Near-duplicates by one-permutation hashing.

A document is the set of its word shingles; equal sets are one node. One hash per shingle fills a sketch: its leading bits
name one of ``BINS`` bins, which keep the least hash. An empty bin takes the value of a filled one that a
universal hash of the bin and the attempt names (optimal densification), so every bin of two sketches agrees about as often as the sets'
similarity says, however few shingles there are. ``BANDS`` bands of the sketch name buckets; two sets at 0.8 miss all of
them once in 20 million.

Buckets make stars, not pairs: every member is a candidate of the bucket's least node. Candidates whose sketches agree in too few bins for the
threshold are dropped (5 standard deviations), the others are confirmed on their full sets, read from the texts, and confirmed links become components.
What a star can miss is two members that are alike while the centre is like only one of them. So buckets that hold members of different
components after that are opened: their sketches meet block by block inside tasks, members of different components are compared, and only pairs
whose sketches agree come out, to be confirmed: first the likeliest one of each member, then all that are still apart. No pair of a bucket is left out, and copies cost one comparison each.

Defined cases: null, empty and blank texts have an empty set and are their own component; fewer words than a shingle has are
one shingle; a null id never names a component unless all ids in it are null; rows equal in id and text are one node; ties do not
matter, the least id names a component; further columns are not carried.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.components import components
from stagewise.llm.jaccard import distinct_sets, set_marks_of
from stagewise.llm.repeats import among
from stagewise.llm.shared import in_chunks, mix, read_table, written

BIN_BITS = 7
BINS = 1 << BIN_BITS
BANDS, ROWS = 32, 4
#: Agreeing bins below which a pair is not compared: so many standard deviations under the threshold.
DEVIATIONS = 5.5
#: Members of a bucket that are compared at once where stars do not settle it.
BLOCK = 1024
#: Token values a member brings to such a comparison: all of a set up to this size, a sample by value of a larger one.
DETAIL = 2048
_SALT = np.uint64(0x5DEECE66D1CE4E5B)
_DETAIL_SALT = np.uint64(0x2545F4914F6CDD1D)


def sketches(owner: np.ndarray, token: np.ndarray, rows: int) -> np.ndarray:
    """``rows`` sketches of ``BINS`` values; a row without tokens has zeros."""
    spread = mix(token ^ _SALT)
    order = np.lexsort((spread, owner))
    owner, spread = owner[order], spread[order]
    cell = owner * BINS + (spread >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    least = np.ones(len(cell), bool)
    least[1:] = cell[1:] != cell[:-1]
    values, filled = np.zeros(rows * BINS, np.uint64), np.zeros(rows * BINS, bool)
    values[cell[least]], filled[cell[least]] = spread[least], True
    some = np.zeros(rows, bool)
    some[owner] = True
    open_ = np.flatnonzero(~filled & np.repeat(some, BINS))
    attempt = 0
    while len(open_):
        attempt += 1
        row, bin_ = np.divmod(open_, BINS)
        asked = mix(bin_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        donor = row * BINS + (asked >> np.uint64(64 - BIN_BITS)).astype(np.int64)
        gives = filled[donor]
        values[open_[gives]] = values[donor[gives]]
        open_ = open_[~gives]
    return values.reshape(rows, BINS)


def bands_of(values: np.ndarray) -> np.ndarray:
    """``BANDS`` bucket names per sketch."""
    parts = values.reshape(len(values), BANDS, ROWS)
    name = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        name = mix(name * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return name


def _least_agreeing(percent: int) -> int:
    share = percent / 100
    return int(BINS * share - DEVIATIONS * (BINS * share * (1 - share)) ** 0.5)


def similar_components(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per document; documents whose sets have
    ``100 * intersection >= percent * union`` are linked. The bands are set for a similarity of 0.8 or more."""
    if not 80 <= percent <= 100 or words < 1:
        raise ValueError("percent in 80..100 and one word or more")
    kind = docs.schema[doc_id].dataType.simpleString()

    def sketch(batches):
        for batch in in_chunks(batches, "text"):
            owner, token = distinct_sets(batch.column("text"), words)
            size = np.bincount(owner, minlength=batch.num_rows)
            first = np.concatenate([[0], np.cumsum(size)])
            values = sketches(owner, token, batch.num_rows)
            bands = bands_of(values).view(np.int64)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS
            short = (mix(values) >> np.uint64(56)).astype(np.uint8)
            marks = set_marks_of(token, first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_mark"), pa.array(size, pa.int64()),
                    pa.array(marks[0].view(np.int64)), pa.array(marks[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel())),
                    pa.array([row.tobytes() for row in short], pa.binary()),
                ],
                ["doc_id", "text_mark", "n", "m1", "m2", "bands", "sketch"],
            )

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("text_mark"), F.col(text).alias("text")
    )
    schema = f"doc_id {kind}, text_mark long, n long, m1 long, m2 long, bands array<long>, sketch binary"
    sets = written(rows.mapInArrow(sketch, schema).withColumn("node", F.xxhash64("n", "m1", "m2")))
    filled = sets.where("n > 0")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_mark", "n", "bands", "sketch")
    nodes = written(filled.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.min(row).alias("row")))
    nodes = nodes.select("node", "least_id", "row.*")

    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    heads = buckets.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
    heads = heads.where("centre <> last").select("bucket", "centre")
    shared = written(buckets.join(heads, "bucket").select("bucket", "node", "centre"))

    stars = shared.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    confirmed = _confirmed(rows, nodes, stars, words, percent)
    rooted = components(confirmed)
    missed, held = _missed(rows, shared, nodes, rooted, words, percent)
    rooted = _merged(rooted, _confirmed(rows, nodes, missed, words, percent, held))
    named = nodes.select("node", "least_id").join(rooted, "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "root").select("node", "component_id")
    out = sets.select("doc_id", "n", "node").join(named, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _missed(
    rows: DataFrame, shared: DataFrame, nodes: DataFrame, rooted: DataFrame, words: int, percent: int
) -> tuple[DataFrame, DataFrame | None]:
    """Links ``a, b`` between members of one bucket that are in different components: what the stars could not
    see. Members of such buckets are dealt to blocks with the tokens of their sets; every two blocks of a bucket meet once. A pair is compared in
    the first bucket it shares, and of the links found in a block only those come out that join what is still apart in it. Also the texts of all these members."""
    left = shared.where("node <> centre").select("bucket", "node").join(rooted, "node", "left")
    left = left.withColumn("root", F.coalesce("root", "node"))
    mixed = left.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"))
    mixed = mixed.where("low <> high").select("bucket", F.ceil(F.col("members") / BLOCK).cast("int").alias("parts"))
    left = written(left.join(mixed, "bucket"))
    if left.isEmpty():
        return left.select(F.col("node").alias("a"), F.col("node").alias("b")), None
    needed = written(nodes.join(left.select("node").distinct(), "node"))
    held = _texts_of(rows, needed)
    details = held.mapInArrow(partial(_details, words=words, most=DETAIL), "node long, level int, detail binary")
    details = written(details.dropDuplicates(["node"]))
    members = needed.select("node", "n", "sketch", "bands").join(details, "node")
    dealt = left.withColumn("part", F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    dealt = dealt.select("bucket", "node", "root", "part", other).withColumns(
        {"i": F.least("part", "other"), "j": F.greatest("part", "other")}
    )
    least = _least_agreeing(percent)

    def meet(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        bucket, i, j = (k.as_py() for k in key)
        node, root, n, part = (block[c].to_numpy() for c in ("node", "root", "n", "part"))
        sketch = _fixed(block["sketch"].combine_chunks())
        bands = block["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        tokens = _Tokens(block["detail"].combine_chunks(), block["level"].to_numpy(), n)
        # The members of the largest component need no comparison with each other.
        _, label, times = np.unique(root, return_inverse=True, return_counts=True)
        largest = label == np.argmax(times)
        pairs = []
        for x in np.flatnonzero(~largest):
            to = (label != label[x]) & (n * 100 >= n[x] * percent) & (n[x] * 100 >= n * percent)
            # Two that are both outside of it meet at the smaller of them only.
            to &= largest | (node > node[x])
            if i != j:
                to &= part != part[x]
            to = np.flatnonzero(to)
            alike = bands[to] == bands[x]
            to = to[bands[x][np.argmax(alike, axis=1)] == bucket]
            to = to[(sketch[to] == sketch[x]).sum(axis=1) >= least]
            if not len(to):
                continue
            maybe, sure = tokens.links(x, to, percent)
            _, one_each = np.unique(label[to[sure]], return_index=True)
            joined = to[sure][one_each]
            if len(joined):
                label[np.isin(label, label[joined])] = label[x]
            unsure = to[maybe & ~sure]
            to = np.concatenate([joined, unsure[label[unsure] != label[x]]])
            pairs.append(np.stack([np.minimum(node[to], node[x]), np.maximum(node[to], node[x])]))
        a, b = np.concatenate([np.zeros((2, 0), np.int64), *pairs], axis=1)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    columns = dealt.join(members, "node").select("bucket", "i", "j", "node", "root", "n", "part", "sketch", "bands", "level", "detail")
    return columns.groupBy("bucket", "i", "j").applyInArrow(meet, "a long, b long").distinct(), held


def _details(batches, words: int, most: int):
    """The sets of texts as 32-bit token values. Of a set of more than ``most`` tokens only values under a power of
    two that its size names (``level``), so that any two sets can be compared by the values under the lower of both bounds."""
    for batch in in_chunks(batches, "text"):
        owner, token = distinct_sets(batch.column("text"), words)
        size = np.bincount(owner, minlength=batch.num_rows)
        level = np.ceil(np.log2(np.maximum(size, most) / most)).astype(np.int32)
        value = (mix(token ^ _DETAIL_SALT) >> np.uint64(32)).astype(np.uint32)
        keep = value.astype(np.uint64) < (np.uint64(1 << 32) >> level[owner].astype(np.uint64))
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=batch.num_rows))])
        value = value[keep]
        detail = [value[u:v].tobytes() for u, v in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(level), pa.array(detail, pa.binary())], ["node", "level", "detail"]
        )


class _Tokens:
    """Token values of the members of a block, to compare one member with many."""

    def __init__(self, detail: pa.Array, level: np.ndarray, n: np.ndarray):
        _, places, data = detail.buffers()
        ends = np.frombuffer(places, np.int32)[detail.offset : detail.offset + len(detail) + 1] // 4
        flat = np.frombuffer(data, np.uint32)[ends[0] : ends[-1]]
        self.begin, self.size = (ends[:-1] - ends[0]).astype(np.int64), np.diff(ends).astype(np.int64)
        values, self.value = np.unique(flat, return_inverse=True)
        self.level, self.n = level, n
        self.mark = np.zeros(len(values), bool)
        # Numbers under this one are values under the bound of a level.
        deepest = int(level.max(initial=0))
        self.bounds = [len(values), *(int(np.searchsorted(values, np.uint32(1 << (32 - k)))) for k in range(1, deepest + 1))]

    def _gathered(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[which]
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(first[-1]) + np.repeat(self.begin[which] - first[:-1], size)
        return self.value[at], np.repeat(np.arange(len(which)), size)

    def links(self, x: int, to: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``to`` may be linked to ``x``, and which surely are. Two values may be equal by chance, so a number of common tokens
        is too high at most, and surely by no more than one; of samples the share is known to ``DEVIATIONS`` standard deviations."""
        own = self.value[self.begin[x] : self.begin[x] + self.size[x]]
        value, which = self._gathered(to)
        self.mark[own] = True
        common = np.bincount(which[self.mark[value]], minlength=len(to)).astype(np.int64)
        self.mark[own] = False
        level = np.maximum(self.level[to], self.level[x])
        if not level.any():
            both = self.n[to] + self.n[x]
            return common * 100 >= percent * (both - common), (common - 1) * 100 >= percent * (both - common + 1)
        bound = np.array(self.bounds)[level]
        here = np.searchsorted(np.sort(own), bound)
        there = np.bincount(which[value < bound[which]], minlength=len(to))
        union = np.maximum(here + there - common, 1)
        slack = np.where(level > 0, DEVIATIONS * np.sqrt(percent * (100 - percent) / union), 0)
        share = 100 * common / union
        return share >= percent - slack, (share - slack >= percent) & (common - 1 >= percent * (union + 1) / 100)


def _merged(rooted: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links, from those between components alone."""
    if links.isEmpty():
        return rooted
    ends = written(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node")))
    roots_a, roots_b = (ends.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
    between = links.join(roots_a, "a").join(roots_b, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    moved = components(between).select(F.col("node").alias("root"), F.col("root").alias("new"))
    # Ends that had no component yet join with their own number.
    every = rooted.unionByName(ends.where("node = root")).distinct()
    return written(every.join(moved, "root", "left").select("node", F.coalesce("new", "root").alias("root")))


def _confirmed(rows, nodes, pairs, words: int, percent: int, held: DataFrame | None = None) -> DataFrame:
    """Those of the pairs ``a, b`` (``a`` the centre) whose full sets are similar enough; ``held`` are the texts of their nodes, if they
    have been gathered already."""
    side = nodes.select("node", "n", "sketch")
    fits = (F.col("n_a") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("n_a") * percent)
    sized = pairs.join(side.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a")), "a")
    sized = sized.join(side.withColumnRenamed("node", "b"), "b").where(fits).select("a", "b", "sketch_a", "sketch")
    least = _least_agreeing(percent)

    def agreeing(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (_fixed(batch.column(c)) for c in ("sketch_a", "sketch"))
                keep = (a == b).sum(axis=1) >= least
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    likely = written(sized.mapInArrow(agreeing, "a long, b long"))
    if likely.isEmpty():
        return likely
    if held is None:  # texts of the nodes that any candidate needs, once; from there on only those move
        held = _texts_of(rows, nodes.join(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node"))
    both = likely.join(held.withColumnRenamed("node", "b"), "b").join(held.select(F.col("node").alias("a"), F.col("text").alias("centre")), "a")

    def confirmed(batches):
        centre, tokens = None, np.zeros(0, np.uint64)
        for batch in in_chunks(batches, "text"):
            owner, token = distinct_sets(batch.column("text"), words)
            ends = np.cumsum(np.bincount(owner, minlength=batch.num_rows))
            keep, begin = [], 0
            for k, (own, end) in enumerate(zip(batch.column("a").to_pylist(), ends.tolist(), strict=True)):
                if own != centre:  # a centre's candidates stand together
                    centre, tokens = own, distinct_sets(batch.column("centre").slice(k, 1), words)[1]
                common = np.intersect1d(token[begin:end], tokens, assume_unique=True).size
                keep.append(common * 100 >= percent * (end - begin + len(tokens) - common))
                begin = end
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return written(both.select("a", "b", "text", "centre").mapInArrow(confirmed, "a long, b long"))


def _texts_of(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """``node, text`` of the nodes in ``needed``. The rows that stand for them are written first, and only texts that may be of
    such a row are dealt."""
    stands = written(needed.select("node", F.col("doc_id").alias("at_id"), F.col("text_mark").alias("at_mark")))
    rows, bitmap = among(rows, F.xxhash64("doc_id", "text_mark"), stands.select(F.xxhash64("at_id", "at_mark")))
    same = F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("text_mark") == F.col("at_mark"))

    def once(batches):
        seen = set()  # rows equal in id and text stand for one node; a task needs it once
        for batch in in_chunks(batches, "text"):
            ids = batch.column("node").to_pylist()
            fresh = [k for k, node in enumerate(ids) if node not in seen and not seen.add(node)]
            yield batch.take(pa.array(fresh, pa.int64()))

    held = written(rows.join(stands, same).select("node", "text").mapInArrow(once, "node long, text string"))
    bitmap.destroy()
    return held


def _fixed(column: pa.Array) -> np.ndarray:
    """Sketches of equal length as a matrix."""
    _, _, data = column.buffers()
    begin = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(data, np.uint8)[begin : begin + len(column) * BINS].reshape(-1, BINS)


def op11_minhash(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return similar_components(docs, words=4, percent=80)
