"""N-gram Jaccard join by a token-group matrix.

A document is the set of its word shingles. Equal sets become one node first. Nodes that share a token of
their prefixes (the rarest tokens; two sets over the threshold must share one of them) with a node of fitting size are
active; each active node belongs to one group, named by the least such token, so similar nodes meet in a group.

Inside a group all members of fitting size are compared with a few hubs (members with the fewest tokens of their own);
those over the threshold hang on their hub and need no comparison with each other. Members are then stored in blocks of one hub and bounded size, each with
the union of its tokens. The token-group matrix (token, block) tells which blocks a node's prefix reaches; blocks of
the node's own hub are left out. Parity sketches, about a bit per token, tell which hubs, and which members of the blocks that it
reaches, a node may be similar to; texts and token sets of the others are not moved. The node's overlap with the block's union
bounds its overlap with any member, and only blocks that pass are opened, their members counted exactly. Links make
components by alternating stars.

Everything is exact up to equal 64-bit hashes of different shingles; the frequency order of tokens is a
hint only. Groups of any size are split: hub comparisons are a join, blocks and query blocks are bounded in tokens.

Defined cases: null, empty and blank texts have an empty set and are their own component; fewer words than a
shingle has are one shingle; equal rows are one node; a null id never names a component unless all ids in it are null;
ties do not matter, since the least id names a component; further columns of the input are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.components import components
from stagewise.llm.parity import may_be_similar, may_meet, sketches
from stagewise.llm.repeats import among, in_bitmap, repeated_bitmap
from stagewise.llm.shared import BLANK, Rolling, Words, flat_text, free_names, in_chunks, mix, read_table, written

#: Cells in which frequent tokens are noticed; a cell is sent on if a task finds it so much
#: over the mean, and so often at least.
CELLS = 1 << 20
OVER_MEAN = 8
HUBS = 2
#: Tokens of a block and of the queries that meet it at once.
BLOCK_TOKENS = 150_000
QUERY_TOKENS = 400_000


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, token) of all shingles, with repeats, in reading order."""
    found = Words(*flat_text(texts), BLANK)
    if not len(found.begin):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = np.repeat(found.first[1:], found.count)
    begin = np.arange(len(found.begin))
    whole = begin + words <= last
    short = (begin == np.repeat(found.first[:-1], found.count)) & (last - begin < words)
    keep = whole | short
    end = np.minimum(begin + words, last)
    return found.text[keep], Rolling(found.hash).of(begin[keep], end[keep])


def distinct_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    owner, token = shingle_sets(texts, words)
    order = np.lexsort((token, owner))
    owner, token = owner[order], token[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])
    return owner[new], token[new]


def set_marks_of(token: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit marks per set, from the sums of its spread tokens: equal sets have equal marks in any batch."""
    marks = []
    for salt in (0x8F3B, 0x51A7):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(token ^ np.uint64(salt)), dtype=np.uint64)])
        marks.append(mix((sums[first[1:]] - sums[first[:-1]]) + np.diff(first).astype(np.uint64)))
    return marks


def set_marks(texts: pa.Array, words: int) -> list[np.ndarray]:
    owner, token = distinct_sets(texts, words)
    return set_marks_of(token, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]))


def frequent_cells(docs: DataFrame, words: int, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cells whose tokens are frequent, with their counts: CELLS rows at most."""

    def run(batches):
        count = np.zeros(CELLS, np.int64)
        for batch in in_chunks(batches, text):
            _, token = shingle_sets(batch.column(text), words)
            count += np.bincount((token >> np.uint64(44)).astype(np.int64), minlength=CELLS)
        high = np.flatnonzero(count >= max(8, OVER_MEAN * count.mean()))
        yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(count[high])], ["cell", "n"])

    rows = docs.select(text).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n"))
    found = sorted((r[0], r[1]) for r in rows.collect())
    return np.array([c for c, _ in found], np.int64), np.array([n for _, n in found], np.int64)


def similar_components(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``doc_id, text_mark, n_shingles, component_id, component``: one row per document; documents whose sets
    have ``100 * intersection >= percent * union`` are linked. ``text_mark`` is xxhash64 of the text, ``component`` a number
    that also tells components apart whose least id is the same."""
    if not 0 < percent <= 100 or words < 1:
        raise ValueError("percent in 1..100 and one word or more")
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0

    def set_hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        owner, token = distinct_sets(batch.column(text), words)
        return token, owner

    bits, repeated = repeated_bitmap(docs.select(text), text, total, 16, set_hashes)
    table = spark.sparkContext.broadcast((*frequent_cells(docs, words, text), repeated))  # CELLS rows, 32 MB
    kind = docs.schema[doc_id].dataType.simpleString()

    def prefixes(batches):
        level = np.zeros(CELLS, np.int8)
        at, n, repeated = table.value
        repeated = np.frombuffer(repeated, np.uint8)
        level[at] = np.log2(np.maximum(n, 1)).astype(np.int8) + 1
        for batch in in_chunks(batches, "text"):
            owner, token = distinct_sets(batch.column("text"), words)
            rows = batch.num_rows
            size = np.bincount(owner, minlength=rows)
            first = np.concatenate([[0], np.cumsum(size)])
            marks = set_marks_of(token, first)
            # Rarest first: tokens of one document only, then by how frequent their cell is.
            many = in_bitmap(token, bits, repeated)
            rarity = np.where(many, level[(token >> np.uint64(44)).astype(np.int64)] + 1, 0)
            order = np.lexsort((token, rarity, owner))
            place = np.arange(len(token)) - first[owner]
            need = -(-size * percent // 100)
            # A token that no other document holds is part of the prefix but links nothing.
            keep = (place < (size - need + 1)[owner]) & many[order]
            taken = token[order][keep]
            # What can still be shared from this token on, itself included.
            after = (size[owner] - place)[keep]
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_mark"), pa.array(size, pa.int64()),
                    pa.array(np.bincount(owner[~many], minlength=rows), pa.int64()),
                    pa.array(marks[0].view(np.int64)), pa.array(marks[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(taken.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(after, pa.int32())),
                    sketches(token, first, np.diff(ends) > 0),
                ],
                ["doc_id", "text_mark", "n", "lone", "m1", "m2", "prefix", "after", "sketch"],
            )

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("text_mark"), F.col(text).alias("text")
    )
    sets = written(
        rows.mapInArrow(
            prefixes,
            f"doc_id {kind}, text_mark long, n long, lone long, m1 long, m2 long, prefix array<long>, after array<int>, sketch binary",
        ).withColumn("node", F.xxhash64("n", "m1", "m2"))
    )
    table.destroy()  # 32 MB of the driver and of every executor
    # Equal sets are one node; any of its rows stands for it.
    filled = sets.where("n > 0")
    nodes = filled.groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_mark")).alias("row")
    )
    nodes = written(nodes)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_mark")
    first_rows = filled.where(F.size("prefix") > 0).join(nodes.select("node", F.col("row").alias("stands")), "node").where(row == F.col("stands"))
    reach = written(
        first_rows.select("node", "n", "lone", F.explode(F.arrays_zip("prefix", "after")).alias("p"))
        .select("node", "n", "lone", F.col("p.prefix").alias("token"), F.col("p.after").alias("after"))
        .dropDuplicates(["node", "token"])
    )
    # Sizes over the threshold apart are two classes apart at least: a token counts for a node if another
    # node has it in the same or a neighbouring class.
    step = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-12
    reach = reach.withColumn("class", F.floor(F.log("n") / step))
    near = F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)).alias("class")
    shared = (
        reach.groupBy("token", "class").agg(F.count("*").alias("nodes")).select("token", near, "nodes")
        .groupBy("token", "class").agg(F.sum("nodes").alias("nodes")).where("nodes > 1").select("token", "class")
    )
    active = written(reach.join(shared, ["token", "class"]).drop("class"))
    # The group of a node: its least shared token in an order that has nothing to do with rarity.
    named = F.struct(F.xxhash64("token"), "token")
    grouped = written(active.groupBy("node").agg(F.min(named).getField("token").alias("group"), F.max("n").alias("n"), F.max("lone").alias("lone")))

    drawn_up = filled.where(F.size("prefix") > 0).select("node", "sketch").dropDuplicates(["node"])
    drawn_up = written(drawn_up.join(grouped.select("node"), "node"))

    def token_sets(batches):
        seen = set()  # rows equal in id and text stand for one node; a task needs it once
        for batch in in_chunks(batches, "text"):
            ids = batch.column("node").to_pylist()
            fresh = [k for k, node in enumerate(ids) if node not in seen and not seen.add(node)]
            batch = batch.take(pa.array(fresh, pa.int64()))
            owner, token = distinct_sets(batch.column("text"), words)
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(token.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), tokens], ["node", "tokens"])

    def members_of(wanted: DataFrame) -> DataFrame:
        """Token sets of the nodes in the one column of ``wanted``, from their texts."""
        stands = written(nodes.join(wanted.distinct(), "node").select(
            "node", F.col("row.doc_id").alias("at_id"), F.col("row.text_mark").alias("at_mark")
        ))
        needed, bitmap = among(rows, F.xxhash64("doc_id", "text_mark"), stands.select(F.xxhash64("at_id", "at_mark")))
        # Dealt even if few: in one stage, both steps would keep two Python workers a core.
        texts = needed.join(
            stands.hint("merge"), F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("text_mark") == F.col("at_mark"))
        ).select("node", "text")
        members = written(texts.mapInArrow(token_sets, "node long, tokens array<long>"))
        bitmap.destroy()
        return members

    # The middle of a family of copies has the fewest tokens of its own.
    drawn = [F.struct("lone", F.xxhash64(F.col("node"), F.lit(k)), "node", "n") for k in range(HUBS)]
    hubs = grouped.groupBy("group").agg(*[F.min(d).alias(f"hub{k}") for k, d in enumerate(drawn)])
    listed = F.array_distinct(F.array(*[F.struct(f"hub{k}.node", f"hub{k}.n") for k in range(HUBS)]))
    hubs = hubs.select(F.col("group").alias("of"), F.explode(listed).alias("h"))
    fits = (F.col("n") * 100 >= F.col("h.n") * percent) & (F.col("h.n") * 100 >= F.col("n") * percent)
    to_ask = grouped.join(hubs, (F.col("group") == F.col("of")) & (F.col("node") != F.col("h.node")) & fits)
    to_ask = to_ask.select("node", F.col("h.node").alias("hub"), (F.col("n") + F.col("h.n")).alias("sizes"))

    def may_hang(batches):
        for batch in batches:
            near = may_be_similar(batch.column("sketch"), batch.column("hub_sketch"), batch.column("sizes").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("hub")], ["node", "hub"]).filter(pa.array(near))

    to_try = written(
        to_ask.join(drawn_up, "node")
        .join(drawn_up.select(F.col("node").alias("hub"), F.col("sketch").alias("hub_sketch")), "hub")
        .select("node", "hub", "sizes", "sketch", "hub_sketch")
        .mapInArrow(may_hang, "node long, hub long")
    )
    members = members_of(to_try.select("node").unionByName(to_try.select(F.col("hub").alias("node"))))
    hub_sets = members.select(F.col("node").alias("hub"), F.col("tokens").alias("hub_tokens"))

    def against_hubs(batches):
        for batch in batches:
            sizes_a, flat_a = _lists(batch.column("tokens"))
            sizes_b, flat_b = _lists(batch.column("hub_tokens"))
            both = _overlaps(sizes_a, flat_a, sizes_b, flat_b)
            link = both * 100 >= percent * (sizes_a + sizes_b - both)
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("hub")], ["node", "hub"]).filter(pa.array(link))

    to_hubs = written(
        to_try.join(members, "node")
        .join(hub_sets, "hub")
        .select("node", "hub", "tokens", "hub_tokens")
        .mapInArrow(against_hubs, "node long, hub long")
    )
    # A member belongs to the family of its least hub, a hub to the least hub that shares a member with it.
    # Families are connected, which is all that is asked of them; two that are connected may stay apart.
    own_hub = to_hubs.groupBy("node").agg(F.min("hub").alias("first_hub"))
    hub_root = to_hubs.join(own_hub, "node").groupBy("hub").agg(F.min("first_hub").alias("root"))
    hub_root = hub_root.select("hub", F.least("hub", "root").alias("root"))
    rooted = own_hub.join(hub_root, F.col("first_hub") == F.col("hub")).select("node", "root")
    rooted = rooted.unionByName(hub_root.select(F.col("hub").alias("node"), "root"))
    rooted = written(rooted.groupBy("node").agg(F.min("root").alias("root")))
    placed = grouped.join(rooted, "node", "left").select(
        "node", "group", "n", F.coalesce("root", "node").alias("family"), F.col("root").isNotNull().alias("hangs")
    )
    sizes = placed.groupBy("family").agg(F.count("*").alias("family_size"))
    placed = placed.join(sizes, "family")
    # Blocks: members of one group and family, or the single ones of a group, bounded in tokens.
    family_key = F.when(F.col("hangs"), F.col("family")).otherwise(F.lit(0))
    placed = placed.withColumn("family_key", family_key)
    tokens = placed.groupBy("group", "hangs", "family_key").agg(F.sum("n").alias("tokens"))
    blocked = written(
        placed.join(tokens, ["group", "hangs", "family_key"]).withColumn(
            "block",
            F.xxhash64(
                "group", "hangs", "family_key",
                F.pmod(F.xxhash64("node"), F.ceil(F.col("tokens") / BLOCK_TOKENS).cast("long")),
            ),
        ).select("node", "n", "hangs", "family", "family_size", "block")
    )

    # The matrix, and the blocks that each node's prefix reaches.
    marked = active.select("token", "node", "after").join(blocked, "node")
    matrix = marked.groupBy("token", "block").agg(
        F.min("hangs").alias("b_hangs"), F.min("family").alias("b_family"), F.max("family").alias("b_last"),
        F.max("family_size").alias("b_size"), F.min("n").alias("b_least"), F.max("n").alias("b_most"),
        F.max("after").alias("b_after"),
    )
    spread = matrix.groupBy("token").agg(F.min("b_family").alias("f_least"), F.max("b_last").alias("f_most"))
    asking = marked.join(spread, "token").where("f_least <> f_most").drop("f_least", "f_most", "block")
    own_first = F.struct("family_size", "family") < F.struct("b_size", "b_family")
    ask = (
        (F.col("family") != F.col("b_family")) | (F.col("b_family") != F.col("b_last"))
    ) & F.when(F.col("hangs") & F.col("b_hangs"), own_first).otherwise(~F.col("hangs") | ~F.col("b_hangs"))
    # Of a single one and one that hangs, the single one asks.
    ask = ask & ~(F.col("hangs") & ~F.col("b_hangs"))
    ask = ask & (F.col("n") * 100 >= F.col("b_least") * percent) & (F.col("b_most") * 100 >= F.col("n") * percent)
    # From the first shared token on both sides must still hold the overlap that their sizes ask for.
    wanted = (F.col("n") + F.greatest(F.col("b_least"), F.ceil(F.col("n") * percent / F.lit(100.0)) - 1)) * percent
    ask = ask & (F.col("after") * (100 + percent) >= wanted) & (F.col("b_after") * (100 + percent) >= wanted)
    pairs = (
        asking.join(matrix.withColumnRenamed("token", "t"), (F.col("token") == F.col("t")) & ask)
        .select("node", "n", "block")
        .distinct()
    )
    pairs = written(pairs)

    def fitting(asking: pa.Table, held: pa.Table) -> pa.Table:
        if not asking.num_rows or not held.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "asks": pa.array([], pa.bool_())})
        asks, holds = may_meet(asking, held, percent)
        asking, held = asking.filter(pa.array(asks)), held.filter(pa.array(holds))
        return pa.table({
            "block": pa.chunked_array([*asking["block"].chunks, *held["to_block"].chunks], pa.int64()),
            "node": pa.chunked_array([*asking["node"].chunks, *held["held"].chunks], pa.int64()),
            "n": pa.chunked_array([*asking["n"].chunks, *held["held_n"].chunks], pa.int64()),
            "asks": pa.array(np.arange(asking.num_rows + held.num_rows) < asking.num_rows),
        })

    def opened(asking: pa.Table, held: pa.Table) -> pa.Table:
        return _open_block(asking, held, percent)

    # What a block holds meets each part of the nodes that ask it.
    fit = written(_met(pairs, blocked, drawn_up, fitting, "block long, node long, n long, asks boolean").distinct())
    members = members_of(fit.select("node"))
    found = _met(fit.where("asks"), fit.where("NOT asks"), members, opened, "a long, b long")
    links = to_hubs.select(F.col("node").alias("a"), F.col("hub").alias("b")).unionByName(found)
    rooted = components(links)
    named = nodes.join(rooted, "node", "left").select(
        "node", "least_id", F.coalesce("root", "node").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = written(named.join(least, "root").select("node", "component_id", F.col("root").alias("component")))
    return sets.join(named, "node", "left").select(
        "doc_id", "text_mark", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "component",
    )


def _met(pairs: DataFrame, held: DataFrame, sets: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``run`` on the nodes of ``pairs`` that ask a block, in parts of bounded tokens, and on those of ``held`` in it, each with
    what ``sets`` has of the node."""
    (what,) = (c for c in sets.columns if c != "node")
    asked = pairs.groupBy("block").agg(F.ceil(F.sum("n") / QUERY_TOKENS).cast("int").alias("parts"))
    queries = (
        pairs.join(asked, "block")
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts").cast("long")).cast("int"))
        .join(sets, "node")
        .select("block", "part", "node", "n", what)
    )
    stored = (
        held.select("node", "n", "block")
        .join(asked, "block")
        .join(sets, "node")
        .select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", "n", what)
        .toDF("to_block", "to_part", "held", "held_n", f"held_{what}")
    )
    return queries.groupBy("block", "part").cogroup(stored.groupBy("to_block", "to_part")).applyInArrow(run, schema)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return sizes, column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def _overlaps(sizes_a, flat_a, sizes_b, flat_b) -> np.ndarray:
    """Common tokens of the k-th set on the left and the k-th on the right."""
    out = np.zeros(len(sizes_a), np.int64)
    a = b = 0
    for k, (m, n) in enumerate(zip(sizes_a, sizes_b, strict=True)):
        out[k] = np.intersect1d(flat_a[a : a + m], flat_b[b : b + n], assume_unique=True).size
        a, b = a + m, b + n
    return out


def _open_block(asking: pa.Table, held: pa.Table, percent: int) -> pa.Table:
    """Links of the asking nodes with members of the block, as few as show all connections."""
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if not asking.num_rows or not held.num_rows:
        return none
    size_q, flat_q = _lists(asking["tokens"])
    size_m, flat_m = _lists(held["held_tokens"])
    order = np.argsort(flat_m, kind="stable")
    sorted_m = flat_m[order]
    owner = np.repeat(np.arange(len(size_m)), size_m)[order]
    union = np.unique(sorted_m)
    query, member = asking["node"].to_numpy(), held["held"].to_numpy()
    parent = {int(x): int(x) for x in np.concatenate([query, member])}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right = [], []
    begin = 0
    for k, n in enumerate(size_q):
        tokens = flat_q[begin : begin + n]
        begin += n
        at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
        bound = int((union[at] == tokens).sum())
        # The overlap with a member is at most the overlap with the union.
        if bound * 100 < percent * n:
            continue
        low, high = np.searchsorted(sorted_m, tokens, "left"), np.searchsorted(sorted_m, tokens, "right")
        times = high - low
        spots = np.arange(times.sum()) + np.repeat(low - (np.cumsum(times) - times), times)
        common = np.bincount(owner[spots], minlength=len(size_m))
        for m in np.flatnonzero((common * 100 >= percent * (n + size_m - common)) & (common > 0)):
            x, y = top(int(query[k])), top(int(member[m]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                left.append(int(query[k]))
                right.append(int(member[m]))
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())}) if left else none


def keep_one_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component stays: the one of the least id (of several texts with that id, the one of the least
    mark). Documents without words all stay; rows equal in id and text are one document and stay or go together."""
    found = similar_components(docs, doc_id=doc_id, text=text, words=words, percent=percent)
    blank = found.where("n_shingles = 0").select("doc_id", "text_mark").distinct()
    first = found.where("n_shingles > 0 AND component_id <=> doc_id").groupBy("component", "doc_id")
    stays = blank.unionByName(first.agg(F.min("text_mark").alias("text_mark")).select("doc_id", "text_mark"))
    own_id, own_mark = free_names(docs, "stay_id", "stay_mark")
    stays = stays.toDF(own_id, own_mark)
    mark = F.coalesce(F.xxhash64(F.col(text)), F.lit(0))
    kept = docs.join(stays, F.col(doc_id).eqNullSafe(F.col(own_id)) & (mark == F.col(own_mark)), "left_semi")
    return kept.select(*docs.columns)


def op8_jaccard(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = similar_components(docs, words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")
