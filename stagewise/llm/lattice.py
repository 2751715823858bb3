"""Subword lattice likelihood: the probability of a text over all its segmentations.

The vocabulary is an existing one (``vocabulary``: a file of a public tokenizer); its pieces start with the scores
that the file's order gives. Rounds of expectation maximisation over the word counts of all
training documents turn these into unigram probabilities of the same pieces. A word's probability is
the sum over all its segmentations, by a forward recursion in log space; a text's is the product over its words and one end.

The corpus is gathered as word counts (combined on the map side), so the recursion runs once per distinct
word instead of once per token. For the documents, the ``head_words`` most frequent words (a bound, not
a cut) go to the tasks as arrays; all other words meet their counts in a join on the word, in which no key is hot
because every frequent word is in the head.

Defined cases: null and empty texts are one end token; equal rows are scored each; a null id is in fold 0; an empty
training set gives counts of 0 and the file's probabilities; bytes without a piece are byte pieces, so every text has a probability.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.llm.language import fold_of
from stagewise.llm.shared import BLANK, Words, flat_text, in_chunks, read_table, written

HEAD_WORDS = 1 << 18
ROUNDS = 1
#: Added to the expected count of every piece.
SMOOTHING = 0.1
#: Cells of a lattice that are worked on at once.
CELLS = 3_000_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(vocabulary: str) -> list[bytes]:
    """The pieces that can stand in lower-cased words, best score first; a space marks a word's begin."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    scored = []
    for i in range(model.get_piece_size()):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i).encode().replace("▁".encode(), b" ")
        if b" " not in piece[1:] and not any(65 <= b <= 90 for b in piece):
            scored.append((-model.get_score(i), i, piece))
    return [piece for _, _, piece in sorted(scored)]


class Lattice:
    """Pieces as a trie, and their log probabilities; byte pieces come after the others."""

    def __init__(self, pieces: list[bytes], logs: np.ndarray):
        self.logs = logs
        self.longest = max(map(len, pieces), default=1)
        self.bytes_from = len(pieces)
        letters = sorted({b for p in pieces for b in p})
        self.letter = np.zeros(256, np.int64)
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        nodes: dict[tuple[int, int], int] = {}
        ends = {}
        for k, piece in enumerate(pieces):
            node = 0
            for b in piece:
                node = nodes.setdefault((node, int(self.letter[b])), len(nodes) + 1)
            ends[node] = k
        self.child = np.zeros((len(nodes) + 1) * self.width, np.int32)
        for (node, letter), child in nodes.items():
            self.child[node * self.width + letter] = child
        self.piece = np.full(len(nodes) + 1, -1, np.int32)
        for node, k in ends.items():
            self.piece[node] = k

    def edges(self, rows: np.ndarray) -> np.ndarray:
        """Piece numbers by (word, last byte, length - 1), -1 where there is none."""
        n, size = rows.shape
        reach = min(size, self.longest)
        out = np.full((n, size, reach), -1, np.int32)
        flat = rows.ravel()
        letters = self.letter[flat]
        begin = np.arange(n * size)
        node = np.zeros(n * size, np.int32)
        for length in range(1, reach + 1):
            inside = begin % size + length <= size
            begin, node = begin[inside], node[inside]
            node = self.child[node.astype(np.int64) * self.width + letters[begin + length - 1]]
            alive = node > 0
            begin, node = begin[alive], node[alive]
            piece = self.piece[node]
            whole = piece >= 0
            at = begin[whole]
            out[at // size, at % size + length - 1, length - 1] = piece[whole]
        single = out[:, :, 0]
        out[:, :, 0] = np.where(single < 0, rows.astype(np.int32) + self.bytes_from, single)
        return out

    def forward(self, score: np.ndarray) -> np.ndarray:
        n, size, reach = score.shape
        alpha = np.zeros((n, size + 1))
        for j in range(1, size + 1):
            most = min(j, reach)
            x = alpha[:, j - most : j][:, ::-1] + score[:, j - 1, :most]
            top = x.max(axis=1)
            alpha[:, j] = top + np.log(np.exp(x - top[:, None]).sum(axis=1))
        return alpha

    def backward(self, score: np.ndarray) -> np.ndarray:
        n, size, reach = score.shape
        beta = np.zeros((n, size + 1))
        for i in range(size - 1, -1, -1):
            most = min(size - i, reach)
            steps = np.arange(most)
            x = beta[:, i + 1 : i + 1 + most] + score[:, i + steps, steps]
            top = x.max(axis=1)
            beta[:, i] = top + np.log(np.exp(x - top[:, None]).sum(axis=1))
        return beta

    def scores(self, pieces: np.ndarray) -> np.ndarray:
        return np.where(pieces < 0, -np.inf, self.logs[pieces])

    def words(self, column: pa.Array):
        """Words in groups of one length: their numbers and their bytes with the begin mark."""
        data, begins = flat_text(column)
        sizes = np.diff(begins)
        order = np.argsort(sizes, kind="stable")
        cuts = np.flatnonzero(np.diff(sizes[order])) + 1
        for group in np.split(order, cuts):
            if not len(group):
                continue
            size = int(sizes[group[0]])
            most = max(1, CELLS // ((size + 1) * min(size + 1, self.longest)))
            for k in range(0, len(group), most):
                part = group[k : k + most]
                rows = np.full((len(part), size + 1), 32, np.uint8)
                rows[:, 1:] = data[begins[part][:, None] + np.arange(size)]
                yield part, rows

    def log_probabilities(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        with np.errstate(divide="ignore"):
            for part, rows in self.words(column):
                out[part] = self.forward(self.scores(self.edges(rows)))[:, -1]
        return out

    def expected(self, column: pa.Array, times: np.ndarray) -> np.ndarray:
        """Expected number of each piece in words that occur so many times."""
        total = np.zeros(len(self.logs))
        with np.errstate(divide="ignore", invalid="ignore"):
            for part, rows in self.words(column):
                pieces = self.edges(rows)
                score = self.scores(pieces)
                alpha, beta = self.forward(score), self.backward(score)
                whole = alpha[:, -1]
                for length in range(1, score.shape[2] + 1):
                    own = pieces[:, length - 1 :, length - 1]
                    log = alpha[:, : -length] + score[:, length - 1 :, length - 1] + beta[:, length:] - whole[:, None]
                    weight = np.exp(log) * times[part][:, None]
                    held = own >= 0
                    total += np.bincount(own[held], weights=weight[held], minlength=len(total))
        return total


def file_scores(n: int) -> np.ndarray:
    """Log probabilities by the order of the file (Zipf), byte pieces far behind."""
    p = np.concatenate([1 / (np.arange(n) + 10.0), np.full(256, 0.01 / (n + 10.0))])
    return np.log(p / p.sum())


def word_counts(docs: DataFrame, learn: Column, text: str = "text") -> DataFrame:
    """Every distinct word with its number in learned (``c``) and all documents (``n``)."""

    def run(batches):
        for batch in in_chunks(batches, "body"):
            words = Words(*flat_text(batch.column("body")), BLANK)
            if not len(words.begin):
                continue
            learned = batch.column("learn").to_numpy(zero_copy_only=False)[words.text]
            kinds, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
            n = np.bincount(back, minlength=len(kinds))
            c = np.bincount(back, weights=learned, minlength=len(kinds)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([words.strings(first), pa.array(c), pa.array(n)], ["word", "c", "n"])

    rows = docs.select(F.col(text).alias("body"), learn.alias("learn"))
    counted = rows.mapInArrow(run, "word string, c long, n long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def fit_scores(counts: DataFrame, pieces: list[bytes], documents: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces, and of the end."""
    spark = counts.sparkSession
    logs = file_scores(len(pieces))
    end = math.log(1 / (2 + documents))
    for _ in range(rounds):
        shipped = spark.sparkContext.broadcast((pieces, logs))  # as large as the vocabulary

        def run(batches, shipped=shipped):
            lattice = Lattice(*shipped.value)
            total = np.zeros(len(lattice.logs))
            for batch in batches:
                total += lattice.expected(batch.column("word"), batch.column("c").to_numpy().astype(float))
            held = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["piece", "n"])

        found = counts.where("c > 0").select("word", "c").mapInArrow(run, "piece long, n double")
        expected = np.zeros(len(logs))
        for piece, n in found.groupBy("piece").agg(F.sum("n")).collect():  # a row per piece at most
            expected[piece] = n
        if not expected.any():
            break
        total = expected.sum() + documents + SMOOTHING * (len(logs) + 1)
        logs = np.log((expected + SMOOTHING) / total)
        end = math.log((documents + SMOOTHING) / total)
    return logs, end


def score_documents(
    docs: DataFrame,
    learn: Column,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    rounds: int = ROUNDS,
    head_words: int = HEAD_WORDS,
) -> DataFrame:
    """One row per document: ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one word unigram)
    and ``score`` (subword lattice), both log10. ``learn``: which rows to learn from."""
    spark = docs.sparkSession
    pieces = read_pieces(vocabulary or default_vocabulary())
    counts = written(word_counts(docs, learn, text))
    documents = docs.where(learn).count()
    tokens, kinds = counts.agg(F.sum("c"), F.sum(F.when(F.col("c") > 0, 1))).first()
    tokens = (tokens or 0) + documents
    kinds = (kinds or 0) + (documents > 0)
    below = math.log10(tokens + kinds + 1)
    logs, end = fit_scores(counts, pieces, documents, rounds)
    shipped = spark.sparkContext.broadcast((pieces, logs))  # as large as the vocabulary

    def lattice_scores(batches):
        lattice = Lattice(*shipped.value)
        for batch in batches:
            log = lattice.log_probabilities(batch.column("word")) / math.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(log)], ["word", "c", "n", "lattice"])

    scored = written(counts.mapInArrow(lattice_scores, "word string, c long, n long, lattice double"))

    # The most frequent words, about head_words: counts in cells of 4 %, the highest first; of the cell that does not fit
    # whole the share that does, by a hash of the word, so that there is a head whatever the counts are.
    cell = F.floor(F.log2(F.greatest("n", F.lit(1))) * 16)
    sizes = scored.groupBy(cell.alias("cell")).count().orderBy(F.desc("cell")).collect()  # 1,024 rows at most
    chosen, room = F.lit(False), head_words
    for at, words in sizes:
        if words > room:
            drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < F.lit(room * (1 << 20) // words)
            chosen = chosen | ((cell == at) & drawn)
            break
        chosen, room = cell >= at, room - words
    head = scored.where(chosen).select("word", "c", "lattice").toArrow()
    names = head["word"].combine_chunks()
    hashed = Words(*flat_text(names), np.zeros(256, bool)).hash
    order = np.argsort(hashed)
    table = spark.sparkContext.broadcast(
        (hashed[order], head["c"].to_numpy()[order], head["lattice"].to_numpy()[order])
    )

    def run(batches):
        known_hash, known_c, known_lattice = table.value
        known_base = np.log10(known_c + 1.0) - below
        row = TaskContext.get().partitionId() << 33
        for batch in in_chunks(batches, "body"):
            n = batch.num_rows
            words = Words(*flat_text(batch.column("body")), BLANK)
            hashes, text_of = words.hash, words.text
            at = np.searchsorted(known_hash, hashes)
            at[at == len(known_hash)] = 0
            is_head = known_hash[at] == hashes if len(known_hash) else np.zeros(len(hashes), bool)
            mine, where = at[is_head], text_of[is_head]
            known = np.bincount(where, weights=known_c[mine] > 0, minlength=n).astype(np.int64)
            base = np.bincount(where, weights=known_base[mine], minlength=n).astype(float)
            lattice = np.bincount(where, weights=known_lattice[mine], minlength=n).astype(float)
            rest = np.flatnonzero(~is_head)
            rest = rest[np.lexsort((hashes[rest], text_of[rest]))]
            new = np.ones(len(rest), bool)
            new[1:] = (np.diff(text_of[rest]) != 0) | (hashes[rest][1:] != hashes[rest][:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(rest)))
            ends = np.searchsorted(text_of[rest[first]], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)), batch.column("doc_id"), pa.array(words.count + 1),
                    pa.array(known), pa.array(base), pa.array(lattice),
                    pa.ListArray.from_arrays(pa.array(ends), words.strings(rest[first])),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(times, pa.int64())),
                ],
                ["row", "doc_id", "n_tokens", "known", "base", "lattice", "words", "times"],
            )
            row += n

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body")).mapInArrow(
        run,
        f"row long, doc_id {kind}, n_tokens long, known long, base double, lattice double, "
        "words array<string>, times array<long>",
    )
    rows = written(rows)  # the row numbers must not change when a task is run again
    rest = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
    rest = rest.select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    sums = (
        rest.join(scored, "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rest_known"),
            F.sum(F.col("times") * (F.log10(F.col("c") + 1) - F.lit(below))).alias("rest_base"),
            F.sum(F.col("times") * F.col("lattice")).alias("rest_lattice"),
        )
    )
    end_base = math.log10(documents + 1) - below

    def total(own: str, added, more: str) -> Column:
        return F.col(own) + F.coalesce(F.col(more), F.lit(0)) + F.lit(added)

    return (
        rows.drop("words", "times")
        .join(sums, "row", "left")
        .select(
            "doc_id",
            "n_tokens",
            total("known", int(documents > 0), "rest_known").cast("long").alias("n_known"),
            F.lit(int(tokens)).cast("long").alias("train_tokens"),
            total("base", end_base, "rest_base").alias("base_score"),
            total("lattice", end / math.log(10), "rest_lattice").alias("score"),
        )
    )


def op5_lattice(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, fold_of("doc_id", 7) != 2)
    return scored.select("doc_id", (fold_of("doc_id", 7) == 2).alias("held_out"), *scored.columns[1:])
