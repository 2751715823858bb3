"""Repair of the structure of conversations by weighted CYK interval parsing.

A conversation is right if the initials of its roles read ``(s?(ua)+)?``. The grammar of repairs is in Chomsky normal
form: ``X[p,q]`` derives the spans of rows that take the reading of initials from place ``p`` to place ``q`` of that pattern, at
the least cost; ``X[p,q] -> X[p,r] X[r,q]`` joins neighbouring spans, a single row derives Keep, Rerole or Delete, and its cell is closed under the
insertions that may stand in front of it. A cell holds (cost, audit): the cheapest edits and, among them, the ASCII-least
initials. Cells are combined bottom-up by span length: 1, 2, 4, ... rows; as the pattern is regular, any
split of a span gives the same cell, so one is enough.

Two audits of a span that end in the place of a row are never one the beginning of the other (each has one letter per row, and insertions
only in front of them), so the least audit of a whole is made of the least audits of its parts. This lets a conversation be
cut anywhere: rows are range-partitioned by (conversation, turn, role, text), every task charts the pieces it holds, the
few conversations that lie across tasks, or are longer than a piece, are settled by folding the small cells of
their pieces, and their texts never meet in one place.

Defined cases: null roles and texts are one space; null conversation ids are one conversation; null turns come first; rows of one turn are
in the order of role and text; repeated rows stand beside each other and are duplicates from the second on; a conversation
without rows after the damage has zeros and an empty audit; further columns are not carried.
"""

from __future__ import annotations

import hashlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.shared import read_table, ship_code, written

BLANKS = " \t\n\x0b\x0c\r"
#: A conversation longer than this is charted in pieces; small conversations are charted this many rows at once.
PIECE_ROWS = 8192
PIECE_CHARS = 4 << 20

# Costs of edits, of rows that stay cut off, and legal neighbours.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}

#: Places of the pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a. What a letter leads to.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
PLACES = 4
#: Splits of a cell that can hold anything: the pattern never goes back to 0 or 1.
SPLITS = [
    (p, q, [r for r in range(PLACES) if (r >= 2 or p <= r) and (q >= 2 or r <= q)])
    for p in range(PLACES) for q in range(PLACES) if q >= 2 or p <= q
]
NEVER = 1 << 50


def due(place: int) -> str:
    """The letter that Rerole and Insert give at a place."""
    return "a" if place == 2 else "u"


def _closure(place: int):
    """Insertions in front of a row: (place after them, cost, audit); more than two lead back to a place seen."""
    cost, audit = 0, ""
    for _ in range(3):
        yield place, cost, audit
        place, cost, audit = STEPS[place, due(place)], cost + INSERT, audit + "I"


def leaf(initial: str, cut_off: bool, must_go: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """Cells of one row, by (place before, place after)."""
    cells = {(p, p): (DELETE, "D") for p in range(PLACES)}
    if must_go:
        return cells
    for p in range(PLACES):
        for at, cost, audit in _closure(p):
            cost += CUT_OFF * cut_off
            options = [(STEPS[at, due(at)], cost + REROLE, audit + "R")]
            if (at, initial) in STEPS:
                options.append((STEPS[at, initial], cost, audit + "K"))
            for q, *cell in options:
                cells[p, q] = min(cells.get((p, q), (NEVER, "")), tuple(cell))
    return cells


def closing(place: int) -> tuple[int, str]:
    """Insertions after the last row that end the pattern."""
    return {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}[place]


KINDS = [(c, t, False) for c in ("s", "u", "a", "") for t in (False, True)] + [("", False, True)]
KIND_OF = {kind: k for k, kind in enumerate(KINDS)}
_LEAF_COST = np.full((len(KINDS), PLACES, PLACES), NEVER, np.int64)
_LEAF_AUDIT = np.full((len(KINDS), PLACES, PLACES), "", object)
for _k, _kind in enumerate(KINDS):
    for (_p, _q), (_cost, _audit) in leaf(*_kind).items():
        _LEAF_COST[_k, _p, _q], _LEAF_AUDIT[_k, _p, _q] = _cost, _audit


def combined(left, right):
    """Cells of neighbouring spans to cells of both together, for many spans at once."""
    (cost_l, audit_l), (cost_r, audit_r) = left, right
    cost, audit = np.full(cost_l.shape, NEVER, np.int64), np.full(cost_l.shape, "", object)
    for p, q, splits in SPLITS:
        for r in splits:
            total = cost_l[:, p, r] + cost_r[:, r, q]
            can = np.flatnonzero((total < NEVER) & (total <= cost[:, p, q]))
            if not len(can):
                continue
            edits = audit_l[can, p, r] + audit_r[can, r, q]
            wins = (total[can] < cost[can, p, q]) | (edits < audit[can, p, q]).astype(bool)
            cost[can[wins], p, q], audit[can[wins], p, q] = total[can[wins]], edits[wins]
    return cost, audit


def chart(kinds: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, cost cells, audit cells) of every run of rows with one owner, bottom-up by span length."""
    cost, audit = _LEAF_COST[kinds], _LEAF_AUDIT[kinds]
    while len(owner) and (owner[1:] == owner[:-1]).any():
        first = np.concatenate([[True], owner[1:] != owner[:-1]])
        start = np.flatnonzero(first)
        place = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
        left = np.flatnonzero((place % 2 == 0) & np.append(owner[1:] == owner[:-1], False))
        both = combined((cost[left], audit[left]), (cost[left + 1], audit[left + 1]))
        cost[left], audit[left] = both
        stays = place % 2 == 0
        owner, cost, audit = owner[stays], cost[stays], audit[stays]
    return owner, cost, audit


def rendered(audit: str, place: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts that the edits leave."""
    out_roles, out_texts, row = [], [], 0
    for edit in audit:
        if edit == "D":
            row += 1
            continue
        if edit == "K":
            role, text = roles[row], texts[row]
        else:
            role, text = ROLES[due(place)], texts[row] if edit == "R" else ""
        place = STEPS[place, role[:1]]
        row += edit != "I"
        out_roles.append(role)
        out_texts.append(text)
    return out_roles, out_texts


class _Piece:
    """Rows of one conversation that stand together, in order."""

    def __init__(self, conv_id, whole: bool):
        self.conv_id, self.whole = conv_id, whole
        self.turns, self.roles, self.texts, self.seen, self.chars = [], [], [], [], 0

    def facts(self) -> tuple[list[int], dict]:
        """The kind of every row, and the counts."""
        kinds, count = [], [0, 0, 0]
        for role, text, seen in zip(self.roles, self.texts, self.seen, strict=True):
            filled = text.rstrip(BLANKS)
            fault = 0 if not filled else 1 if seen else 2 if filled[-1] not in ".!?" else None
            if fault is not None:
                count[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else ""
            kinds.append(KIND_OF[("", False, True) if fault in (0, 1) else (initial, fault == 2, False)])
        turns = [t for t in self.turns if t is not None]
        initials = [role[:1] for role in self.roles]
        return kinds, {
            "rows": len(self.roles), "turns": len(set(turns)), "low": min(turns, default=None), "high": max(turns, default=None),
            "head": initials[0] if initials else None, "tail": initials[-1] if initials else None,
            "blank": count[0], "duplicate": count[1], "truncated": count[2],
            "illegal": sum(a + b not in LEGAL for a, b in pairwise(initials)),
        }


def settled(pieces: list[dict]) -> tuple[dict, list[tuple[int, int, str]]]:
    """What a conversation's pieces come to, and for each of them the places it leads from and to and the insertions after it."""
    pieces = sorted(pieces, key=lambda x: x["piece"])
    togo = [[closing(q)[0] for q in range(PLACES)]]
    for piece in reversed(pieces):
        cost = np.array(piece["costs"]).reshape(PLACES, PLACES)
        togo.append((cost + np.array(togo[-1])).min(axis=1).tolist())
    togo.reverse()
    place, way = 0, []
    for piece, after in zip(pieces, togo[1:], strict=True):
        total = np.array(piece["costs"]).reshape(PLACES, PLACES)[place] + np.array(after)
        rank = np.array(piece["ranks"]).reshape(PLACES, PLACES)[place]
        leads = min((q for q in range(PLACES) if total[q] == total.min()), key=lambda q: rank[q])
        way.append((place, leads, ""))
        place = leads
    way[-1] = (*way[-1][:2], closing(place)[1])
    out = {name: sum(p[name] for p in pieces) for name in ("blank", "duplicate", "truncated", "illegal")}
    filled = [p for p in pieces if p["rows"]]
    out["illegal"] += sum(a["tail"] + b["head"] not in LEGAL for a, b in pairwise(filled))
    timed = [p for p in pieces if p["turns"]]
    turns = sum(p["turns"] for p in timed) - sum(a["high"] == b["low"] for a, b in pairwise(timed))
    out["gaps"] = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
    out["cost"] = togo[0][0]
    return out, way


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_STATE = "rows long, turns long, low long, high long, head string, tail string, costs array<long>, ranks array<int>"
_RESULT = "piece long, whole boolean, " + _COUNTS + ", audit string, roles array<string>, texts array<string>"


def _ranks(audit: np.ndarray) -> list[int]:
    out = []
    for row in audit:
        order = sorted(range(PLACES), key=lambda q: row[q])
        out += [order.index(q) for q in range(PLACES)]
    return out


def _finished(pieces: list[_Piece], number: int) -> list[dict]:
    """Result rows of whole conversations, state rows of pieces of others."""
    facts = [p.facts() for p in pieces]
    kinds = np.array([k for own, _ in facts for k in own], np.int64)
    owner = np.repeat(np.arange(len(pieces)), [len(own) for own, _ in facts])
    nothing = [[0 if p == q else NEVER for q in range(PLACES)] for p in range(PLACES)]
    cells = {int(k): (c, a) for k, c, a in zip(*chart(kinds, owner), strict=True)}
    rows = []
    for k, (piece, (_, state)) in enumerate(zip(pieces, facts, strict=True)):
        cost, audit = cells.get(k, (np.array(nothing), np.full((PLACES, PLACES), "", object)))
        own = {"conv_id": piece.conv_id, "piece": number + k, "whole": piece.whole}
        state |= {"piece": number + k, "costs": cost.ravel().tolist(), "ranks": _ranks(audit)}
        if piece.whole:
            counts, [(p, q, tail)] = settled([state])
            edits = audit[p, q] + tail
            roles, texts = rendered(edits, 0, piece.roles, piece.texts)
            rows.append(own | counts | {"audit": edits, "roles": roles, "texts": texts})
        else:
            rows.append(own | state | {"audits": audit.ravel().tolist(), "roles": piece.roles, "texts": piece.texts})
    return rows


def _charted(schema: pa.Schema, piece_rows: int, piece_chars: int):
    def run(batches):
        base, made = TaskContext.get().partitionId() << 32, 0
        ready: list[_Piece] = []
        current: _Piece | None = None
        group, repeats = None, set()  # of one (turn, role, beginning): digests of texts that an earlier turn holds
        last = None

        def out():
            nonlocal ready, made
            rows = _finished(ready, base + made)
            made += len(ready)
            ready = []
            return pa.RecordBatch.from_pylist(rows, schema)

        for batch in batches:
            for conv_id, turn, role, head, kind, digest, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or conv_id != current.conv_id:
                    if current is not None:
                        ready.append(current)
                        if sum(len(p.roles) for p in ready) >= piece_rows or sum(p.chars for p in ready) >= piece_chars:
                            yield out()
                    # The first conversation of a task may have begun in the task before.
                    current = _Piece(conv_id, whole=current is not None)
                    group, last = None, None
                elif len(current.roles) >= piece_rows or current.chars >= piece_chars:
                    current.whole = False
                    ready.append(current)
                    yield out()
                    current = _Piece(conv_id, whole=False)
                if kind == 0:  # says only that there is such a conversation
                    continue
                if (turn, role, head) != group:
                    group, repeats = (turn, role, head), set()
                if kind == 1:
                    repeats.add(digest)
                    continue
                current.seen.append(digest in repeats or (turn, digest) == last)
                last = (turn, digest)
                current.turns.append(turn)
                current.roles.append(role)
                current.texts.append(text)
                current.chars += len(text)
        if current is not None:
            current.whole = False
            ready.append(current)
        if ready:
            yield out()

    return run


def repair_conversations(
    turns: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    gone: str | None = None,
    piece_rows: int = PIECE_ROWS,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """The cheapest repair of every conversation: ``conv_id, piece, whole``, what was found (``gaps, blank, duplicate, truncated,
    illegal``), ``cost``, ``audit`` (initials of the edits) and the repaired ``roles`` and ``texts``. Rows where the boolean column
    ``gone`` holds count as missing, but their conversation is reported.

    Nearly all conversations are one row with ``whole`` true. Others come in several rows, in the order of ``piece``,
    with the counts and the cost in the first of them and null in the others.
    """
    ship_code(turns.sparkSession)
    key_type = turns.schema[conv_id].dataType.simpleString()
    given = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.col(gone) if gone else F.lit(False)).alias("gone"),
    )
    here = given.where(~F.col("gone")).select(
        "conv_id", "turn", "role", F.substring("text", 1, 32).alias("head"), F.lit(2).alias("kind"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"), "text",
    )
    # Which texts a conversation repeats in a later turn, from digests alone.
    narrow = here.select("conv_id", "turn", "role", "head", "digest")
    first = narrow.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("same")).agg(
        F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last")
    )
    first = first.where(~F.col("first.turn").eqNullSafe(F.col("last.turn")))
    again = narrow.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")))
    again = again.where(~F.col("turn").eqNullSafe(F.col("first.turn"))).select(
        "conv_id", "turn", "role", "head", F.lit(1).alias("kind"), "digest", F.lit(None).cast("string").alias("text")
    ).distinct()
    no_text = F.lit(None).cast("string")
    missing = given.where("gone").select(
        "conv_id", F.lit(None).cast("long").alias("turn"), no_text.alias("role"), no_text.alias("head"), F.lit(0).alias("kind"),
        no_text.alias("digest"), no_text.alias("text"),
    ).distinct()
    order = ["conv_id", "turn", "role", "head"]
    rows = here.unionByName(again).unionByName(missing).repartitionByRange(*order)
    rows = rows.sortWithinPartitions(*order, "kind", "text")
    schema = f"conv_id {key_type}, {_RESULT}, {_STATE}, audits array<string>"
    charted = written(rows.mapInArrow(_charted(_arrow(turns.sparkSession, schema), piece_rows, piece_chars), schema))

    columns = ["conv_id", *[c.split()[0] for c in _RESULT.split(", ")]]
    pieces = charted.where("NOT whole")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    way_schema = f"piece long, p int, q int, closing string, {_COUNTS}"
    way_arrow = _arrow(turns.sparkSession, way_schema)

    def fold(group: pa.Table) -> pa.Table:
        states = group.to_pylist()
        found, way = settled(states)
        rows = []
        for k, (state, (p, q, tail)) in enumerate(zip(sorted(states, key=lambda x: x["piece"]), way, strict=True)):
            rows.append({"piece": state["piece"], "p": p, "q": q, "closing": tail, **(found if k == 0 else {})})
        return pa.Table.from_pylist(rows, way_arrow)

    narrow = pieces.select(
        "conv_id", "piece", "blank", "duplicate", "truncated", "illegal", *[c.split()[0] for c in _STATE.split(", ")]
    )
    way = narrow.groupBy("conv_id").applyInArrow(fold, way_schema)
    to_do = pieces.select("conv_id", "piece", "audits", "roles", "texts").join(way, "piece")
    repaired_type = f"conv_id {key_type}, {_RESULT}"
    repaired_arrow = _arrow(turns.sparkSession, repaired_type)

    def render(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                edits = row["audits"][row["p"] * PLACES + row["q"]] + row["closing"]
                roles, texts = rendered(edits, row["p"], row["roles"], row["texts"])
                own = {name: row[name] for name in ("conv_id", "piece", *counts)}
                rows.append(own | {"whole": False, "audit": edits, "roles": roles, "texts": texts})
            yield pa.RecordBatch.from_pylist(rows, repaired_arrow)

    return charted.where("whole").select(*columns).unionByName(to_do.mapInArrow(render, repaired_type).select(*columns))


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, the whole audit and sha256 of ``role:text`` lines. Pieces of a
    conversation are read one after the other, never held together."""
    key_type = repaired.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {key_type}, {_COUNTS}, audit string, repaired_sha256 string"
    arrow = _arrow(repaired.sparkSession, schema)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches):
        held, sha, lines, audit = None, None, 0, []
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if held is None or row["conv_id"] != held["conv_id"] or row["cost"] is not None:
                    if held is not None:
                        rows.append(held | {"audit": "".join(audit), "repaired_sha256": sha.hexdigest()})
                    held = {name: row[name] for name in ("conv_id", *counts)}
                    sha, lines, audit = hashlib.sha256(), 0, []
                audit.append(row["audit"])
                for role, text in zip(row["roles"], row["texts"], strict=True):
                    sha.update(f"\n{role}:{text}".encode() if lines else f"{role}:{text}".encode())
                    lines += 1
            yield pa.RecordBatch.from_pylist(rows, arrow)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held | {"audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], arrow)

    parts = repaired.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return repaired.where("whole").mapInArrow(run, schema).unionByName(parts.mapInArrow(run, schema))


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows damaged by the crc32 of ``conv_id:turn``."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    case = F.pmod(F.crc32(key.cast("binary")), F.lit(20)).cast("int")
    out = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), case.alias("case"))
    copies = F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return out.select(
        "conv_id", "turn",
        F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("case") == 0).alias("gone"), copies.alias("copy"),
    ).drop("copy")


def op13_repair(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(repair_conversations(damaged(turns), gone="gone"))


def repair_sql() -> str:
    """The query as DuckDB SQL: the same repairs found row by row, with the place of the pattern as state."""
    letters = " UNION ALL ".join(f"SELECT {p} AS p, '{c}' AS letter, {q} AS q" for (p, c), q in STEPS.items())
    closures = " UNION ALL ".join(
        f"SELECT {p} AS p, {at} AS at, {cost} AS cost, '{audit}' AS edits, "
        f"{[ROLES[due(x)] + ':' for x in _on_the_way(p, len(audit))]}::VARCHAR[] AS lines"
        for p in range(PLACES) for at, cost, audit in _closure(p)
    )
    closings = " UNION ALL ".join(
        f"SELECT {p} AS p, {closing(p)[0]} AS cost, '{closing(p)[1]}' AS edits, "
        f"{[ROLES[due(x)] + ':' for x in _on_the_way(p, len(closing(p)[1]))]}::VARCHAR[] AS lines"
        for p in range(PLACES)
    )
    return f"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b::BIGINT], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of),
keyed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(1, length(key) + 1), lambda i: ascii(key[i])::BIGINT)),
    lambda c, b: xor(crc_of[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS k
  FROM keyed, bits),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, range(CASE WHEN k = 3 THEN 2 ELSE 1 END) WHERE k <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS filled,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM placed),
rows_of AS (
  SELECT conv_id, i, turn, role, text, pair, filled = '' AS blank, filled <> '' AND seen AS duplicate,
    filled <> '' AND NOT seen AND filled[-1] NOT IN ('.', '!', '?') AS truncated
  FROM judged),
letters AS ({letters}), closures AS ({closures}), closings AS ({closings}),
edits AS (
  SELECT c.p, l.q, l.letter, 'K' AS edit, c.cost, c.edits || 'K' AS edits, c.lines FROM closures c JOIN letters l ON c.at = l.p
  UNION ALL
  SELECT c.p, l.q, l.letter, 'R', c.cost + {REROLE}, c.edits || 'R', c.lines FROM closures c JOIN letters l ON c.at = l.p AND l.letter <> 's'
  UNION ALL
  SELECT p, p, '', 'D', {DELETE}, 'D', [] FROM range({PLACES}) AS t(p)),
cells AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS p, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM (SELECT DISTINCT conv_id FROM rows_of)
  UNION ALL
  SELECT conv_id, i, q, cost, audit, lines FROM (
    SELECT c.conv_id, r.i, e.q, c.cost + e.cost + CASE WHEN r.truncated AND e.edit <> 'D' THEN {CUT_OFF} ELSE 0 END AS cost, c.audit || e.edits AS audit,
      CASE e.edit WHEN 'D' THEN c.lines WHEN 'K' THEN c.lines || e.lines || [r.role || ':' || r.text]
        ELSE c.lines || e.lines || [CASE e.letter WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text] END AS lines
    FROM cells c JOIN rows_of r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.i = c.i + 1
    JOIN edits e ON e.p = c.p AND (e.edit = 'D' OR NOT (r.blank OR r.duplicate)) AND (e.edit <> 'K' OR e.letter = r.role[1])
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, i, q ORDER BY cost, audit) = 1),
ends AS (
  SELECT c.conv_id, c.cost + z.cost AS cost, c.audit || z.edits AS audit, c.lines || z.lines AS lines
  FROM cells c JOIN closings z ON z.p = c.p
  JOIN (SELECT conv_id, max(i) AS i FROM rows_of GROUP BY 1) n ON n.conv_id IS NOT DISTINCT FROM c.conv_id AND n.i = c.i
  QUALIFY row_number() OVER (PARTITION BY c.conv_id ORDER BY c.cost + z.cost, c.audit || z.edits) = 1),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_of GROUP BY 1)
SELECT o.conv_id, coalesce(f.gaps, 0)::BIGINT AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate,
  coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal, coalesce(e.cost, 0)::BIGINT AS cost,
  coalesce(e.audit, '') AS audit, sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""


def _on_the_way(place: int, steps: int) -> list[int]:
    """The places in front of each of so many insertions."""
    way = []
    for _ in range(steps):
        way.append(place)
        place = STEPS[place, due(place)]
    return way
