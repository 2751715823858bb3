"""Alignment of two tokenizers token by token, on plain lists."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from stagewise.llm.align import byte_letters


def align(rows):
    """``(doc_id, text)`` rows to result rows, sorted."""
    by_a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_a.encode_special_tokens = True
    by_b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = byte_letters()
    docs, count = [], Counter()
    for doc_id, text in rows:
        a, b = [], []
        if text:
            whole = (" " + text).encode()
            for k in by_a.encode(" " + text, add_special_tokens=False).ids:
                a.append((k, bytes(letters[c] for c in by_a.id_to_token(k))))
            for k in by_b.encode(text):
                piece = by_b.id_to_piece(k)
                b.append((k, bytes([int(piece[3:5], 16)]) if by_b.is_byte(k) else piece.replace("▁", " ").encode()))
            if not b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
                a, b = [], []
        a, b = spans(a), spans(b)
        links, first = [], 0
        for k, begin, end in a:
            while first < len(b) and b[first][2] <= begin:
                first += 1
            at = first
            while at < len(b) and b[at][1] < end:
                links.append((k, b[at][0]))
                at += 1
        groups, i, j = [], 0, 0
        for end in sorted({e for _, _, e in a} & {e for _, _, e in b}):
            left, right = [], []
            while i < len(a) and a[i][2] <= end:
                left.append(str(a[i][0]))
                i += 1
            while j < len(b) and b[j][2] <= end:
                right.append(str(b[j][0]))
                j += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        text_of = ";".join(groups)
        count.update(links)
        docs.append((doc_id, len(a), len(b), len(groups), links, text_of))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (d, n_a, n_b, g, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(s.encode()).hexdigest() if n_a else "", s)
            for d, n_a, n_b, g, links, s in docs
        ),
        key=repr,
    )


def spans(tokens):
    out, at = [], 0
    for k, piece in tokens:
        out.append((k, at, at + len(piece)))
        at += len(piece)
    return out
