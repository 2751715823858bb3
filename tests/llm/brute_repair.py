"""Repairs of conversations by a search over single edits, on plain lists."""

import hashlib
import heapq
import zlib
from itertools import pairwise

BLANKS = " \t\n\x0b\x0c\r"
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
ROLES = (("u", "user"), ("a", "assistant"))


def damage_and_repair(rows):
    """``(conv_id, turn, role, text)`` rows to the result row of every conversation."""
    kept = {}
    for conv_id, turn, role, text in rows:
        own = kept.setdefault(conv_id, [])
        case = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case == 1:
            text = ""
        if case == 2:
            text = "".join(c for c in text if c not in ".!?")
        if case == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(case, 1)
    return {conv_id: repair(own) for conv_id, own in kept.items()}


def repair(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        filled = text.rstrip(BLANKS)
        faults.append("blank" if not filled else "duplicate" if (role, text) in seen else "cut" if filled[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(rows))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, place, out = heapq.heappop(heap)
        if i == len(rows) and place in ("", "a"):
            sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
            return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("cut"), illegal, cost, audit, sha)
        if (i, place) in done:
            continue
        done.add((i, place))
        for letter, role in ROLES:
            if (place, letter) in STEPS:
                heapq.heappush(heap, (cost + 3, audit + "I", i, STEPS[place, letter], (*out, f"{role}:")))
        if i == len(rows):
            continue
        _, own, text = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, place, out))
        if faults[i] in ("blank", "duplicate"):
            continue
        more = 3 * (faults[i] == "cut")
        if (place, own[:1]) in STEPS:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, STEPS[place, own[:1]], (*out, f"{own}:{text}")))
        for letter, role in ROLES:
            if (place, letter) in STEPS:
                heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, STEPS[place, letter], (*out, f"{role}:{text}")))
