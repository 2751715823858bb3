"""MinHash groups, tokenizer alignment and conversation repair: against brute force, in small pieces, on awkward rows."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stagewise.llm import align, lattice, minhash, repair
from stagewise.llm.registry import QUERIES
from stagewise.llm.repeats import among
from tests.llm.brute_align import align as align_brute
from tests.llm.brute_repair import damage_and_repair

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"
FILES = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
REPAIRED = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- minhash ----------------------------------------------------------------------


def groups_by_brute_force(rows, words, percent):
    sets = {}
    for doc_id, text in rows:
        w = (text or "").lower().split()
        sets[doc_id] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {d: (len(sets[d]), top(d)) for d in ids}


@pytest.fixture(scope="module")
def families():
    """Chains of texts that drift apart, templates with own endings, copies, short and blank texts."""
    rng = random.Random(7)
    rows, doc_id = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "One"), (5, "two words"), (6, "a b c d e"), (7, "a b c d e f")], 10
    for family in range(6):
        text = [f"f{family}w{rng.randrange(10**6)}" for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(12):
            text = list(text)
            text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            rows += [(doc_id, " ".join(text)), (doc_id + 1, " ".join(text))]
            doc_id += 2
    template = [f"t{k}" for k in range(60)]
    for k in range(150):
        rows.append((doc_id + k, " ".join(template + [f"own{k}x{j}" for j in range(rng.choice([8, 20, 25]))])))
    return rows


@pytest.mark.parametrize("block, detail", [(1024, 2048), (5, 2048), (1024, 16)])
def test_minhash_groups_equal_brute_force(spark, families, monkeypatch, block, detail):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "DETAIL", detail)
    docs = spark.createDataFrame(families, DOCS).repartition(3)
    found = minhash.similar_components(docs, words=4, percent=80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert got == groups_by_brute_force(families, 4, 80)
    assert found.where("kept <> (doc_id = component_id)").isEmpty()


def test_sketch_agreement_is_the_similarity():
    rng = np.random.default_rng(3)
    for size in (6, 40, 400):
        agree = []
        for _ in range(60):
            both = rng.integers(0, 2**63, size).astype(np.uint64)
            own = rng.integers(0, 2**63, (2, size // 4)).astype(np.uint64)
            token = np.concatenate([both, own[0], both, own[1]])
            owner = np.repeat([0, 1], size + size // 4)
            a, b = minhash.sketches(owner, token, 2)
            agree.append((a == b).mean())
        exact = size / (size + 2 * (size // 4))
        assert abs(np.mean(agree) - exact) < 0.06


def test_token_values_tell_links_from_others():
    rng = np.random.default_rng(5)
    common = rng.integers(0, 2**32, 4000)
    for size, own in ((40, 5), (3000, 300), (3000, 600)):
        rows = [np.unique(np.concatenate([common[:size], rng.integers(0, 2**32, own)])).astype(np.uint32) for _ in range(5)]
        bound = 1 << 30 if size > 2000 else 1 << 32  # two levels of a sample
        detail = pa.array([r[r < bound].tobytes() for r in rows], pa.binary())
        level = np.full(5, 2 if size > 2000 else 0, np.int32)
        tokens = minhash._Tokens(detail, level, np.array([len(r) for r in rows]))
        maybe, sure = tokens.links(0, np.arange(1, 5), 80)
        share = [len(np.intersect1d(rows[0], r)) / len(np.union1d(rows[0], r)) for r in rows[1:]]
        assert all(maybe[np.array(share) >= 0.8]) and not any(sure[np.array(share) < 0.8])
        if not level.any():
            assert list(maybe) == [x >= 0.8 for x in share]


def test_minhash_awkward_rows(spark):
    same = "these are the very same words in every row"
    rows = [(1, same), (1, same), (None, same), (2, None), (None, None), (3, "x " * 50_000), (4, "x " * 50_000)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("node", "n", "bucket", "kept", "a", "root")})
    got = rows_of(minhash.similar_components(docs), ["doc_id", "n_shingles", "component_id"])
    assert got == sorted([(1, 5, 1), (1, 5, 1), (None, 5, 1), (2, 0, 2), (None, 0, None), (3, 1, 3), (4, 1, 3)], key=repr)
    assert minhash.similar_components(spark.createDataFrame([], DOCS)).count() == 0


# --- alignment --------------------------------------------------------------------

ODD_TEXTS = [
    (1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "a  b  c 　 d"), (6, "<|endoftext|> </s> <s> x"), (7, "▁x y"),
    (8, "日本語 テキスト です。 次 の 文"), (9, "x" * 5000), (10, "tab\t x\n y  z\r\n"), (11, "é" * 50 + " ok"), (None, "don't we'll 's x"),
    (12, "a\x00b c"), (12, "a\x00b c"), (13, " lead"), (14, "tail "), (15, " em space   y"), (16, "1 2 3 4,5 6.7 .. !"),
    (17, "emoji 😀 😀x 👍🏽 ok"), (18, "<0x41> <unk> ﬁ ½"), (19, "a \u0085 b c\u0085 d"), (20, "a ​b"),
]


@pytest.mark.parametrize("text_bytes", [1 << 20, 30])
def test_alignment_equals_brute_force(spark, text_bytes):
    docs = spark.createDataFrame(ODD_TEXTS, DOCS).coalesce(1).withColumns({c: F.lit(1) for c in ("pair", "n", "chunk", "entry")})
    got = rows_of(align.align_tokens(docs, *FILES, text_bytes=text_bytes), [*ALIGNED, "groups"])
    assert got == align_brute(ODD_TEXTS)


def test_alignment_of_the_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op12_align"](spark, SF_DIR), ALIGNED) == [r[:-1] for r in align_brute(docs)]


def test_alignment_of_nothing_and_of_a_long_text(spark):
    assert align.align_tokens(spark.createDataFrame([], DOCS), *FILES).count() == 0
    rows = [(1, " ".join(f"word{k % 977} x{k}" for k in range(60_000))), (2, "short")]
    got = rows_of(align.align_tokens(spark.createDataFrame(rows, DOCS), *FILES, spelled=False), ALIGNED)
    assert got == [r[:-1] for r in align_brute(rows)]


def test_pieces_of_the_merge_are_equal_and_independent():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a, b = (np.unique(rng.integers(1, 300, rng.integers(1, 120))) for _ in "ab")
        a, b = np.append(a, 300), np.append(b, 300)
        ends = sorted({*a.tolist(), *b.tolist()})
        links = [(int(np.searchsorted(a, e)), int(np.searchsorted(b, e))) for e in ends]
        for width in (1, 2, 7, 64, 1000):
            i, j = align.diagonals(a, b, width)
            assert (np.diff(i + j)[:-1] == width).all()
            link_a, link_b, group, closing = align.merged(a, b, width)
            assert list(zip(link_a.tolist(), link_b.tolist(), strict=True)) == links
            assert closing.tolist() == sorted(set(a.tolist()) & set(b.tolist()))
            assert group.tolist() == [int(np.searchsorted(closing, e)) for e in ends]


def test_equal_hashes_of_different_segments_stay_apart(monkeypatch):
    with open(FILES[0], "rb") as a, open(FILES[1], "rb") as b:
        segments = align.Segments(align.Encoders(a.read(), b.read()))
    monkeypatch.setattr(align.Rolling, "of", lambda self, begin, end: np.zeros(len(begin), np.uint64))
    data = np.frombuffer(b" one two one", np.uint8)
    entry = segments.of(data, np.array([0, 4, 8]), np.array([4, 8, 12]))
    ids = [segments.ids[0][segments.at[0][e] : segments.at[0][e + 1]].tolist() for e in entry]
    assert ids[0] == ids[2] != ids[1]


# --- repair -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(5)
    rows = []
    for conv_id in [*range(60), None]:
        long = conv_id in (3, 7)
        for _ in range(rng.randint(100, 300) if long else rng.randint(0, 9)):
            rows.append(
                (
                    conv_id, rng.choice([None, *range(200 if long else 12)]),
                    rng.choice(["user", "assistant", "system", "tool", None, "", "user", "assistant"]),
                    rng.choice([None, "", " \n", "Hi.", "yes", "Why?", "no! ", "a", "same."]),
                )
            )
    return rows


@pytest.mark.parametrize("piece_rows", [8192, 7])
def test_repair_equals_brute_force(spark, talks, piece_rows):
    turns = spark.createDataFrame(talks, TURNS).repartition(5).withColumns({c: F.lit(1) for c in ("piece", "whole", "kind", "cost")})
    found = repair.repair_conversations(repair.damaged(turns), gone="gone", piece_rows=piece_rows)
    got = {r[0]: tuple(r[1:]) for r in repair.digests(found).select(*REPAIRED).collect()}
    assert got == damage_and_repair(talks)


def test_repaired_conversations_are_right(spark, talks):
    found = repair.repair_conversations(repair.damaged(spark.createDataFrame(talks, TURNS)), gone="gone", piece_rows=16)
    whole = defaultdict(list)
    for row in sorted(found.collect(), key=lambda r: r.piece):
        whole[row.conv_id] += row.roles
    import re

    assert all(re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in roles)) for roles in whole.values())


def test_a_cell_is_the_same_for_every_split():
    rng = random.Random(2)
    for _ in range(20):
        kinds = np.array([rng.randrange(len(repair.KINDS)) for _ in range(rng.randint(1, 12))])
        _, cost, audit = repair.chart(kinds, np.zeros(len(kinds), np.int64))
        cell = (repair._LEAF_COST[kinds[:1]], repair._LEAF_AUDIT[kinds[:1]])
        for k in range(1, len(kinds)):
            cell = repair.combined(cell, (repair._LEAF_COST[kinds[k : k + 1]], repair._LEAF_AUDIT[kinds[k : k + 1]]))
        assert (cell[0] == cost).all() and (cell[1] == audit).all()


def test_repair_of_one_long_conversation_and_of_nothing(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"Turn {t % 900}.") for t in range(30_000)]
    turns = spark.createDataFrame(rows, TURNS).repartition(4)
    got = repair.digests(repair.repair_conversations(repair.damaged(turns), gone="gone", piece_rows=500)).select(*REPAIRED).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == damage_and_repair(rows)
    assert repair.repair_conversations(spark.createDataFrame([], TURNS)).count() == 0


def test_a_head_that_does_not_fit_is_still_a_head(spark):
    """More words of one count than the head holds: scores stay right, and part of them need no join."""
    rows = [(k, " ".join(f"w{j}" for j in range(40))) for k in range(30)] + [(99, "rare words here")]
    docs = spark.createDataFrame(rows, DOCS)
    columns = ["doc_id", "n_tokens", "n_known", "train_tokens"]
    whole = lattice.score_documents(docs, F.lit(True))
    small = lattice.score_documents(docs, F.lit(True), head_words=20)
    assert rows_of(whole, columns) == rows_of(small, columns)
    scores = [sorted((r.doc_id, round(r.score, 9), round(r.base_score, 9)) for r in df.collect()) for df in (whole, small)]
    assert scores[0] == scores[1]


def test_rows_that_a_join_needs_are_never_lost(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("id"), F.lit("x").alias("at_key"))
    for wanted in (rows.where("id % 7 = 0"), rows.where("id IS NULL"), rows.where("id < 0")):
        picked, bitmap = among(rows, F.xxhash64("id"), wanted.select(F.xxhash64("id")))
        assert picked.columns == rows.columns
        assert wanted.exceptAll(picked).isEmpty()
        least = wanted.count()
        assert picked.count() <= least + (20_000 - least) / 8
        bitmap.destroy()
