"""The training-data operators: against SQL twins, brute force and planted cases, and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stagewise.llm import decontaminate, fingerprint, jaccard, language, lattice, lines, mixing, parity, secrets, suffixes, toxicity
from stagewise.llm.components import components
from stagewise.llm.registry import ORACLE_SQL, QUERIES
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = " ".join(f"shared{i} word{i}" for i in range(40))
LINES = "\n".join(f"common line {i * i}" for i in range(40))


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, copies, columns whose names clash."""
    long = " ".join(f"w{i * 7919 % 30011} AKIAABCDEFGH{i:08d}" for i in range(20_000))
    rows = [
        (1, "", "en", "a"), (2, None, "en", "a"), (3, "  \n\t ", None, "a"), (4, long, "en", None), (5, long, None, "b"),
        (6, PASSAGE, "en", "b"), (6, PASSAGE, "en", "b"), (7, "x " + PASSAGE + " y", "fr", "b"), (None, "no id here at all", "en", "c"),
        (None, None, None, None), (8, LINES + "\nown tail", "en", "c"), (9, "own head\n" + LINES, "en", "c"), (10, "one", "fr", "c"),
        (11, "日本語 テキスト です", "ja", "d"), (12, "token = 'abc' secret: token: abcdefgh password=hunter22", "en", "d"), (13, "é" * 200, "fr", "d"),
    ]
    df = spark.createDataFrame([(*r, len(r[1]) if r[1] else None) for r in rows], SCHEMA)
    clash = ("id", "size", "gone", "hits", "n_words", "stay_id", "row_id", "node", "entry", "toxic", "n_lines", "toxicity", "mark", "label")
    return df.withColumns({c: F.lit(7) for c in clash})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PASSAGE), (2, "one"), (None, "two words"), (3, None), (4, ""), (5, "  .,  "), (6, PASSAGE)]
    return spark.createDataFrame(rows, "item_id long, text string")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_twin(spark, name):
    got, want = compare(spark, connect(SF_DIR), SF_DIR, name, QUERIES[name], ORACLE_SQL[name])
    assert got == want and got[1]


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 11))


# --- 1 language ----------------------------------------------------------------

def test_language_is_right_on_held_out_texts(spark, given):
    got = language.op1_language(spark, SF_DIR).join(given.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == given.count() and held
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_language_on_awkward_rows(spark, awkward, nothing):
    model = language.fit_language(awkward.where("text is not null"))
    got = language.predict_language(awkward, model, keys=("doc_id", "text")).collect()
    assert len(got) == awkward.count()
    for r in got:
        unreadable = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == unreadable and (r.score == 0) == unreadable
    assert language.fit_language(nothing) is None
    assert {r.lang_pred for r in language.predict_language(awkward, None).collect()} == {"und"}
    assert language.predict_language(nothing, model).count() == 0


# --- 2 toxicity ----------------------------------------------------------------

def test_toxicity_ranks_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    scored = toxicity.op2_toxicity(spark, sf).where("held_out")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = scored.join(labels, "doc_id").collect()
    score, toxic = np.array([r.score for r in got]), np.array([r.toxic for r in got]) == 1
    auc = (score[toxic][:, None] > score[~toxic][None, :]).mean()
    flagged = np.array([r.predicted for r in got]) == 1
    assert auc > 0.93
    assert flagged[toxic].mean() > 0.7 and flagged[~toxic].mean() < 0.01


def test_toxicity_on_awkward_rows(spark, awkward, nothing):
    rows = [(1, 0), (4, 0), (6, 1), (6, 0), (7, 1), (8, 0), (None, 1), (99, 1), (10, None)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    model = toxicity.fit_toxicity(awkward, labels)
    got = toxicity.score_toxicity(awkward, model)
    assert got.columns[:-1] == awkward.columns and got.count() == awkward.count()
    assert all(0 <= r[-1] <= 1 for r in got.collect())
    assert toxicity.fit_toxicity(awkward, labels.limit(0)) is None
    assert toxicity.score_toxicity(nothing, None).count() == 0


# --- 3 mixing ------------------------------------------------------------------

def test_mix_meets_its_targets(spark, given):
    got = mixing.mix_sources(given).collect()
    source = {r.doc_id: r.source for r in given.collect()}
    sums, targets = Counter(), {}
    for r in got:
        sums[source[r.doc_id]] += r.taken
        targets[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        assert r.position is None or 0 <= r.position < 1
    assert all(abs(sums[s] - t) <= 0.5 for s, t in targets.items())
    assert abs(sum(targets.values()) - 1.5 * sum(r.size for r in got)) < 1e-3
    assert [r.position for r in got if r.position is not None] == sorted(r.position for r in got if r.position is not None)
    assert rows_of(mixing.mix_sources(given), "doc_id", "taken", "position") == sorted(
        ((r.doc_id, r.taken, r.position) for r in got), key=repr
    )


def test_mix_on_awkward_rows(awkward, nothing):
    got = mixing.mix_sources(awkward).collect()
    assert len(got) == awkward.count() and all(r.taken <= 2 * r.size for r in got)
    assert mixing.mix_sources(nothing).count() == 0
    with pytest.raises(ValueError):
        mixing.position_sql("part", "turn", ((1.0, 0.0),) * 3)


def test_every_reading_has_a_position(spark):
    # Sources a, b and c have equal sizes, so a is read twice, b and c in part.
    docs = spark.createDataFrame([(k, "w " * (k % 5 + 1), "abc"[k % 3]) for k in range(150)], "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs).persist()
    got = {r.doc_id: r for r in mixed.collect()}
    turn = {k: k % 3 for k in got}
    order = mixing.training_order(mixed).collect()
    assert len(order) == sum(r.copies for r in got.values()) > len({r.doc_id for r in order})
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert sum(r.taken for r in order) == sum(r.taken for r in got.values())
    for r in got.values():
        assert len(r.readings) == r.copies and (r.position is None or r.position == r.readings[0].position)
        for k, one in enumerate(r.readings):
            # The integral of the schedule up to the position is the part of the target that was read before.
            a, b, c = mixing.SCHEDULES[turn[r.doc_id]]
            first, second = min(one.position, 0.5), max(one.position - 0.5, 0)
            area = a * first + (b - a) * first**2 + b * second + (c - b) * second**2
            total = (a + 2 * b + c) / 4
            assert abs(area / total - (r.start + k * r.source_size) / r.target) < 1e-9


# --- 4 secrets -----------------------------------------------------------------

def _base_spans(text):
    word = "password|passwd|secret|token|api_?key"
    insensitive = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    found = []
    for m in re.finditer(f"({insensitive})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets_keep_the_base_and_ask_for_owners(spark, awkward, nothing):
    live, copied = "Zq9Xw7Er5Ty3Ui1Op8As", "Example9Key7Sample5Val3"
    texts = [f"here {live} there", f"see {copied} ok", f"again {copied}", f"{copied} too", "deadbeef" * 4 + " é token='abcdef1'"]
    df = spark.createDataFrame([(i, t, "en", f"s{i}", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in secrets.scan_secrets(df).collect()}
    assert [(s.a, s.z) for s in got[0].added] == [(5, 25)]
    assert all(not got[i].added for i in (1, 2, 3))
    for frame in (df, awkward):
        base = secrets.scan_secrets(frame).select("doc_id", F.transform(F.array_sort("base"), lambda s: F.struct(s["a"], s["kind"], s["z"])).alias("b"))
        got = sorted(((r.doc_id, [tuple(s) for s in r.b or []]) for r in base.collect()), key=repr)
        want = sorted(((r.doc_id, _base_spans(r.text or "")) for r in frame.select("doc_id", "text").collect()), key=repr)
        assert got == want
    assert secrets.scan_secrets(nothing).count() == 0


def test_secrets_of_a_text_with_very_many_matches(spark):
    body = " ".join(f"token=abcdef{k} {k:024x} Zq9Xw7Er5Ty3Ui1Op8{k:06d}" for k in range(3000))
    around = f"{'Ab1' * 12} AKIA{'A1' * 10}/{'b2' * 8} {'Cd3' * 9}"  # the second stands beside a base span of its own run
    df = spark.createDataFrame([(1, body, "a"), (2, around, "b")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secrets.scan_secrets(df).collect()}
    assert sorted((s.a, s.kind, s.z) for s in got[1].base) == _base_spans(body)
    assert [body[s.a : s.z] for s in sorted(got[1].added)] == [f"Zq9Xw7Er5Ty3Ui1Op8{k:06d}" for k in range(3000)]
    assert sorted(around[s.a : s.z] for s in got[2].added) == ["Ab1" * 12, "Cd3" * 9] and len(got[2].base) == 1


# --- 5 lattice -----------------------------------------------------------------

def test_lattice_sums_all_segmentations():
    pieces = [b" ab", b"a", b"b", b" ", b"abc", b"bc", b"c"]
    logs = np.log(np.random.default_rng(0).random(len(pieces) + 256) / 300)
    model = lattice.Lattice(pieces, logs)
    known = dict(zip(pieces, logs, strict=False))

    def total(word, at=0):
        if at == len(word):
            return 1.0
        out = 0.0
        for size in range(1, len(word) - at + 1):
            piece = word[at : at + size]
            if piece in known:
                out += math.exp(known[piece]) * total(word, at + size)
            elif size == 1:
                out += math.exp(logs[len(pieces) + word[at]]) * total(word, at + 1)
        return out

    asked = ["abc", "a", "abcx", "ccab", "", "bbb", "é"]
    got = model.log_probabilities(pa.array(asked))
    assert np.allclose(got, [math.log(total(b" " + w.encode())) for w in asked])
    counts = model.expected(pa.array(asked), np.ones(len(asked)))
    spelled = sum(n * len(p) for n, p in zip(counts, [*pieces, *[b"x"] * 256], strict=True))
    assert math.isclose(spelled, sum(len(w.encode()) + 1 for w in asked))


def test_base_score_equals_counting(spark, given):
    got = {r.doc_id: r for r in lattice.op5_lattice(spark, SF_DIR).collect()}
    tokens = {r.doc_id: [*words(r.text), None] for r in given.select("doc_id", "text").collect()}
    count = Counter()
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(t)
    total, kinds = sum(count.values()), len(count)
    assert set(got) == set(tokens)
    for i, t in tokens.items():
        base = sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in t)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(t), sum(count[w] > 0 for w in t), total)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9) and got[i].score < 0


def test_a_small_head_changes_nothing(spark, awkward, nothing):
    learn = F.lit(True)
    whole = lattice.score_documents(awkward, learn).collect()
    small = lattice.score_documents(awkward, learn, head_words=3).collect()
    key = lambda r: (repr(r.doc_id), r.n_tokens, round(r.base_score, 6), round(r.score, 6))
    assert sorted(map(key, whole)) == sorted(map(key, small)) and len(whole) == awkward.count()
    assert lattice.score_documents(nothing, learn).count() == 0


# --- 6 decontamination -----------------------------------------------------------

def _hits(text, items, window=10):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    covered, held = set(), set()
    for item, body in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (body or "").translate(LOWER))
        n = min(window, len(w))
        for a in range(len(w) - n + 1) if n else ():
            for b in range(len(own) - n + 1):
                if own[b : b + n] == w[a : a + n]:
                    covered.update(range(b, b + n))
                    held.add("" if item is None else str(item))
    return len(own), len(covered), sorted(held)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_equals_brute_force(awkward, benchmark, block_bytes):
    docs = awkward.where("length(text) < 5000 or text is null")
    items = [tuple(r) for r in benchmark.collect()]
    found = decontaminate.find_benchmark(docs, benchmark, block_bytes=block_bytes)
    made = found.columns[len(docs.columns):]
    got = [(r.doc_id, r[made[0]], sum(h.end - h.begin for h in r[made[1]]), list(r[made[2]])) for r in found.collect()]
    want = [(r.doc_id, *_hits(r.text, items)) for r in docs.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    clean = decontaminate.drop_contaminated(awkward, benchmark)
    assert clean.columns == awkward.columns
    assert not {6, 7, 10} & {r.doc_id for r in clean.collect()} and 4 in {r.doc_id for r in clean.collect()}


def test_longest_match_and_its_place(spark, benchmark, nothing):
    text = "lead in " + " ".join(PASSAGE.split()[5:30]) + " tail"
    docs = spark.createDataFrame([(1, text, None, None, None)], SCHEMA)
    r = decontaminate.find_benchmark(docs, benchmark.where("item_id = 1")).first()
    assert (r.longest, r.longest_begin, r.longest_item) == (25, 2, "1") and [tuple(h) for h in r.hits] == [(2, 27)]
    assert decontaminate.find_benchmark(docs, benchmark.limit(0)).first().hits == []
    assert decontaminate.find_benchmark(nothing, benchmark).count() == 0


def _longest(text, items, shortest):
    own, best = words(text), (0, None, None)
    for item, body in sorted(items):
        w = words(body)
        for b in range(len(own)):
            for a in range(len(w)):
                n = 0
                while a + n < len(w) and b + n < len(own) and w[a + n] == own[b + n]:
                    n += 1
                if n >= shortest and (-n, b) < (-best[0], best[1] if best[0] else 1 << 60):
                    best = (n, b, item)
    return best


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_longest_match_of_every_document_of_a_batch(spark, block_bytes):
    body, other = PASSAGE.split(), [f"other{i % 7}" for i in range(30)]
    items = [("a", PASSAGE), ("b", " ".join(other)), ("c", " ".join(body[10:40] + other[:12])), ("d", PASSAGE), ("Z", " ".join(body[5:17]))]
    texts = [
        "lead " + " ".join(body[5:30]), "lead " + " ".join(body[5:30]), " ".join(body[5:17]) + " tail", PASSAGE, "no match at all",
        " ".join(body[30:40] + other[:12]), " ".join(other[:15] + ["x"] + body[:15]), " ".join(body[:9]), " ".join(other * 2), " ".join(body[5:17]),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = decontaminate.find_benchmark(docs, spark.createDataFrame(items, "item_id string, text string"), block_bytes=block_bytes)
    got = {r.doc_id: (r.longest, r.longest_begin, r.longest_item) for r in found.collect()}
    assert got == {k: _longest(t, items, 10) for k, t in enumerate(texts)}
    assert got[0] == got[1] == (25, 1, "a") and got[2][0] == got[9][0] == 12 and got[7] == (0, None, None)


# --- 7 fingerprint ---------------------------------------------------------------

def test_peeling_recovers_differences_of_any_size():
    rng = np.random.default_rng(1)
    pairs = np.unique(np.stack([rng.integers(0, 30, 4000), rng.integers(0, 300, 4000)]).astype(np.uint64), axis=1)
    kept = pairs[:, rng.random(pairs.shape[1]) < 0.9]
    left, right = ((p[0].astype(np.int64), fingerprint.mix(p[1])) for p in (pairs, kept))
    want = np.bincount(left[0], minlength=30) - np.bincount(right[0], minlength=30)
    assert (fingerprint.differences(left, right, 30) == want).all()


@pytest.mark.parametrize("range_bytes", [1 << 20, 500])
def test_fingerprints_of_edited_texts(awkward, given, nothing, range_bytes):
    for docs in (awkward.select("doc_id", "text"), given.select("doc_id", "text")):
        got = fingerprint.compare_successors(docs, range_bytes=range_bytes).collect()
        rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        want = []
        for k, (i, a) in enumerate(rows):
            b, half = rows[(k + 1) % len(rows)][1], len(a) // 2
            want.append((i, len(a), hashlib.sha256((a[: len(a) - half] + b[:half]).encode()).hexdigest()))
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
        by_size = defaultdict(set)
        for r in got:
            by_size[r.doc_id, r.n_chars].add(r.fingerprint)
        assert by_size[6, len(PASSAGE)] == set() or len(by_size[6, len(PASSAGE)]) == 1
    assert fingerprint.compare_successors(nothing).count() == 0


# --- 8 Jaccard join ----------------------------------------------------------------

def _components(rows, size, percent):
    sets = {}
    for i, text in rows:
        w = words(text)
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()
    kinds = defaultdict(list)
    for i, s in sets.items():
        kinds[s].append(i)
    filled, parent = [s for s in kinds if s], {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, x in enumerate(filled):
        for b in range(a):
            y = filled[b]
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                parent[top(a)] = top(b)
    members = defaultdict(list)
    for a, x in enumerate(filled):
        members[top(a)] += kinds[x]
    out = {i: (len(s), i) for i, s in sets.items()}
    for group in members.values():
        for i in group:
            out[i] = (len(sets[i]), min(group))
    return out


@pytest.fixture(scope="module")
def families(spark, given):
    """The given documents and two families of near copies, one larger than the rest and mixed in its distances."""
    base = [f"tok{i * 31 % 97} item{i}" for i in range(60)]
    rows = []
    for k in range(150):
        edited = list(base)
        for j in range(k % 7):
            edited[(k * 13 + j * 7) % 60] = f"edit{k} number{j}"
        rows.append((100_000 + k, " ".join(edited)))
    rows += [(200_000 + k, " ".join(base[:30] + [f"chain{j}" for j in range(k, k + 60)])) for k in range(0, 40, 2)]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    return given.select("doc_id", "text").unionByName(extra)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_similar_components_equal_brute_force(families, size, percent):
    rows = [tuple(r) for r in families.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(families, words=size, percent=percent).collect()}
    assert got == _components(rows, size, percent)


def test_small_blocks_and_queries_change_nothing(families, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(jaccard, "QUERY_TOKENS", 500)
    rows = [tuple(r) for r in families.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(families, words=3, percent=90).collect()}
    assert got == _components(rows, 3, 90)


def test_sets_of_nodes_that_only_share_rare_tokens_are_not_moved(spark, monkeypatch):
    """Neighbours in a ring share a passage but are not similar; only the two near copies need their token sets."""
    rows = [(k, " ".join([f"own{k}x{j}" for j in range(5)] + [f"link{m}y{j}" for m in (k, (k + 1) % 60) for j in range(40)])) for k in range(60)]
    near = [f"near{j}" for j in range(80)]
    rows += [(1000, " ".join(near)), (1001, " ".join(near + ["more"]))]
    tables, write = [], jaccard.written

    def kept(df):
        tables.append(write(df))
        return tables[-1]

    monkeypatch.setattr(jaccard, "written", kept)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(docs, words=3, percent=90).collect()}
    assert got == _components(rows, 3, 90)
    assert next(t for t in tables if "group" in t.columns).count() > 40  # nearly all of them are active
    assert sum(t.count() for t in tables if "tokens" in t.columns) <= 2


@pytest.mark.parametrize("percent", [1, 50, 80, 90, 100])
def test_parity_sketches_pass_all_similar_pairs(percent):
    draw = np.random.default_rng(percent)
    sets = [draw.integers(0, 2**64, n, np.uint64) for n in (1, 2, 3, 60, 64, 65, 128, 129, 500, 3000)]
    sets += [np.concatenate([s[: max(1, round(len(s) * part))], draw.integers(0, 2**64, round(len(s) * more), np.uint64)]) for s in sets for part, more in ((1, 0.05), (0.95, 0.02), (0.9, 0.3), (0.6, 0.1))]
    sets = [np.unique(s) for s in sets]
    first = np.cumsum([0, *map(len, sets)])
    wanted = np.arange(len(sets)) != 4
    packed = parity.sketches(np.concatenate(sets), first, wanted)
    assert [len(x) * 8 >= len(s) for x, s in zip(packed.to_pylist(), sets, strict=True)] == list(wanted)
    pairs = [(a, b) for a in np.flatnonzero(wanted) for b in np.flatnonzero(wanted)]
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in pairs])
    sizes = np.array([len(sets[a]) + len(sets[b]) for a, b in pairs])
    passed = parity.may_be_similar(packed.take([a for a, _ in pairs]), packed.take([b for _, b in pairs]), sizes, percent)
    similar = both * 100 >= percent * (sizes - both)
    assert similar.any() and not (similar & ~passed).any()
    if percent >= 80:  # of sets of fitting size without a common member none passes
        close = np.array([min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])) for a, b in pairs])
        assert (far := (both == 0) & close & (sizes > 100)).any() and not passed[far].any()
    nodes = pa.array(np.flatnonzero(wanted))
    n, drawn = pa.array(np.diff(first)[wanted]), packed.filter(pa.array(wanted))
    asks, holds = parity.may_meet(
        pa.table({"node": nodes, "n": n, "sketch": drawn}), pa.table({"held": nodes, "held_n": n, "held_sketch": drawn}), percent
    )
    others = {a for (a, b), fits in zip(pairs, passed, strict=True) if fits and a != b}
    met = {a for (a, b), fits in zip(pairs, similar, strict=True) if fits and a != b}
    for found in (asks, holds):
        assert met <= set(nodes.to_numpy()[found]) <= others


def test_one_of_each_group_stays(awkward, nothing):
    kept = jaccard.keep_one_each(awkward, words=3, percent=80)
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert kept.columns == awkward.columns
    assert 4 in ids and 5 not in ids and 6 in ids and 7 not in ids
    assert {1, 2, 3} <= set(ids) and None in ids
    assert jaccard.keep_one_each(nothing).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.range(300).select((F.col("id") * 11 % 301).alias("a"), ((F.col("id") + 1) * 11 % 301).alias("b"))
    other = spark.createDataFrame([(1000, 1001), (1001, 1000), (1002, 1002)], "a long, b long")
    got = {r.node: r.root for r in components(chain.unionByName(other)).collect()}
    assert {got[n] for n in range(301)} == {0} and got[1001] == got[1000] == 1000 and 1002 not in got


# --- 9 lines -----------------------------------------------------------------------

def test_repeated_line_chunks_go(awkward, nothing):
    got = {r.doc_id: r for r in lines.dedup_line_chunks(awkward.where("doc_id is not null")).collect()}
    assert got[8].text == LINES + "\nown tail" and got[9].text != "own head\n" + LINES
    assert got[9].text.startswith("own head") and got[9]["_n_lines"] == 41 and len(got[9].text) < len(LINES) / 2
    assert 41 - len(got[9].text.split("\n")) == got[9].removed_lines
    assert got[2].text is None and got[1].text == "" and got[6].text == PASSAGE
    assert lines.dedup_line_chunks(awkward).count() == awkward.count()
    assert lines.dedup_line_chunks(nothing).count() == 0


def test_planted_passages_of_any_length_go(spark, awkward, nothing):
    rows, want = [], {}
    for n in (1, 2, 3, 4, 5, 6, 8):
        passage = [" ".join(f"p{n}l{i}w{j}" for j in range(-(-51 // n))) for i in range(n)]
        for c in range(3):
            k = len(rows)
            own = [f"own line {k} {i} ." for i in range(4)]
            rows.append((k, "\n".join([*own[:2], *passage, "", *own[2:]])))
            want[k] = rows[-1][1] if c == 0 else "\n".join([*own[:2], "", *own[2:]])
    rows += [(100, "same\nsame\nsame\nsame"), (101, "short\nother 1"), (102, "short\nother 2"), (103, rows[0][1].split("\n")[2])]
    want |= {100: "same", 101: "short\nother 1", 102: "short\nother 2", 103: ""}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.dedup_line_runs(docs).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert {r.doc_id: (r.removed_runs, r.removed_lines) for r in got if r.doc_id in (0, 1, 19, 20)} == {
        0: (0, 0), 1: (1, 1), 19: (1, 8), 20: (1, 8)
    }
    again = lines.dedup_line_runs(awkward)
    assert again.count() == awkward.count() and lines.dedup_line_runs(nothing).count() == 0
    texts = {r.doc_id: r.text for r in again.collect()}
    assert texts[9] == "own head" and texts[8] == LINES + "\nown tail" and texts[6] == PASSAGE and texts[2] is None


# --- 10 suffixes -------------------------------------------------------------------

def _removed(rows, length):
    least, out = {}, []
    rows = sorted(((i, (t or "").encode()) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for i, body in rows:
        key = suffixes.LOWEST if i is None else i
        for k in range(len(body) - length + 1):
            least.setdefault(body[k : k + length], key)
    for i, body in rows:
        key = suffixes.LOWEST if i is None else i
        gone = bytearray(len(body))
        for k in range(len(body) - length + 1):
            if least[body[k : k + length]] < key:
                gone[k : k + length] = b"\1" * length
        out.append((i, bytes(c for c, g in zip(body, gone, strict=True) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("length", "gram"), [(50, 24), (20, 8)])
def test_suffix_dedup_equals_brute_force(awkward, given, nothing, length, gram, monkeypatch):
    monkeypatch.setattr(suffixes, "SORT_AT_ONCE", 500)
    for docs in (awkward.where("length(text) < 5000 or text is null"), given.limit(60)):
        docs = docs.select("doc_id", "text").persist()
        got = []
        for r in suffixes.remove_repeats(docs, length=length, gram=gram).collect():
            body, keep, at = (r.text or "").encode(), b"", 0
            for s in r.spans or ():
                keep += body[at : max(at, s.begin)]
                at = max(at, s.end)
            got.append((r.doc_id, keep + body[at:]))
        assert sorted(got, key=repr) == _removed([tuple(r) for r in docs.collect()], length)
    assert suffixes.remove_repeats(nothing).count() == 0


def test_places_of_a_hot_phrase_do_not_meet_in_one_call(spark, monkeypatch):
    phrase = "licensed by its owners to the holder of this: "
    names = [f"{k * 7919 % 1009:04d} and {k * 104729 % 9973:05d} own words {k * k:09d}" for k in range(200)]
    tail = " which then goes on with the same words as in the other one"
    docs = [(k, f"{names[k]} {phrase}{names[k // 2 if k % 10 == 1 else -k]}{tail if k % 5 == 0 else ''} {k}") for k in range(200)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).persist()
    monkeypatch.setattr(suffixes, "HOT_PLACES", 50)
    dealt = suffixes.hot_leads(
        rows.select(F.col("doc_id").alias("id"), F.hash("text").alias("mark"), "text"), lambda b: b, 1, 50, 24
    )
    assert 0 < len(dealt) < 100
    tables = []

    def kept(df):
        tables.append(suffixes_written(df))
        return tables[-1]

    suffixes_written = suffixes.written
    monkeypatch.setattr(suffixes, "written", kept)
    got = []
    for r in suffixes.remove_repeats(rows).collect():
        body, keep, at = r.text.encode(), b"", 0
        for s in r.spans or ():
            keep += body[at : max(at, s.begin)]
            at = max(at, s.end)
        got.append((r.doc_id, keep + body[at:]))
    assert sorted(got, key=repr) == _removed(docs, 50) and any(body != t.encode() for (_, body), (_, t) in zip(sorted(got), docs, strict=True))
    # All places of a hot phrase are spelled out, and their strings are dealt by more than the phrase.
    strings = next(t for t in tables if "string" in t.columns)
    assert strings.select("id").distinct().count() == 200
    assert strings.groupBy("off", "string").count().agg(F.max("count")).first()[0] < 50


def test_multikey_groups_equal_rows():
    tokens = np.random.default_rng(3).integers(0, 3, (500, 4)).astype(np.uint64)
    order, new = suffixes.multikey_groups(tokens)
    ordered = [tuple(t) for t in tokens[order]]
    assert ordered == sorted(ordered)
    assert [a != b for a, b in zip(ordered[1:], ordered, strict=False)] == list(new[1:])


def test_equal_sets_are_one_node_whatever_their_batch(spark):
    """Exact copies beside other rows: the set marks must not depend on what stands before them."""
    texts = [(k, f"only {k} " + " ".join(f"t{k * j % 9973}" for j in range(1, 40))) for k in range(300)]
    copies = [(1000 + k, PASSAGE) for k in range(300)]
    mixed = [row for pair in zip(texts, copies, strict=True) for row in pair]
    docs = spark.createDataFrame(mixed, "doc_id long, text string").coalesce(1)
    marks = jaccard.set_marks(pa.array([t for _, t in mixed]), 5)
    assert len({(int(a), int(b)) for (_, t), a, b in zip(mixed, *marks, strict=True) if t == PASSAGE}) == 1
    found = jaccard.similar_components(docs)
    assert found.where("doc_id >= 1000").select("component_id").distinct().collect()[0][0] == 1000


def test_ten_thousand_equal_rows(spark):
    same = " ".join(f"word{k}" for k in range(60))
    rows = [(7, same)] * 10_000 + [(8, same + " more"), (9, "something else of a few words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard.similar_components(docs)
    counted = {(r.doc_id, r.component_id): r["count"] for r in found.groupBy("doc_id", "component_id").count().collect()}
    assert counted == {(7, 7): 10_000, (8, 7): 1, (9, 9): 1}
