"""Small documents with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def vocabulary(seed: int, size: int = 400) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghiéß") for _ in range(draw.randint(2, 7))) for _ in range(size)]


def documents(seed: int = 1, many: int = 60) -> list[tuple]:
    """Random texts with copies, near copies, shared passages, nulls, empty and long texts, and
    repeated rows."""
    draw, words = random.Random(seed), vocabulary(seed)
    passage = [draw.choice(words) for _ in range(70)]
    texts: list[str | None] = []
    for i in range(many):
        text = [draw.choice(words) for _ in range(draw.choice([1, 3, 40, 90, 200]))]
        kind = i % 8
        if kind == 1 and texts[i - 1]:
            text = texts[i - 1].split()
            for _ in range(max(1, len(text) // 40)):
                text[draw.randrange(len(text))] = draw.choice(words)
        elif kind == 2:
            at = draw.randrange(len(text) + 1)
            text[at:at] = passage[draw.randrange(10) :]
        elif kind == 3 and i > 8:
            texts.append(texts[draw.randrange(i)])
            continue
        elif kind == 4:
            text = text + text[-60:] + text[-60:]
        texts.append(draw.choice([" ", "  ", "\n"]).join(text))
    texts += [None, "", " \t\n", "one", "One two", "one TWO", "12 34 !?", "x" * 3000, "ab " * 900, "é" * 130, "é" * 131]
    rows = [(i, text, "en", f"s{i % 3}", len(text or "")) for i, text in enumerate(texts)]
    draw.shuffle(rows)
    rows.append(rows[3])  # a repeated row
    rows.append((None, "one two three", None, None, None))
    return rows


def key(doc_id: int | None) -> float:
    return float("inf") if doc_id is None else doc_id


def spaced(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    if lower:
        text = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def lettered(text: str | None) -> list[str]:
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def shingles(text: str | None, size: int) -> frozenset:
    words = spaced(text, lower=True)
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(rows: list[tuple], size: int, percent: int = 80) -> dict[tuple, float]:
    """The least id that links reach, by id and text."""
    nodes = sorted({(key(r[0]), shingles(r[1], size)) for r in rows}, key=lambda n: n[0])
    parent = {node: node for node in nodes}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            both = len(a[1] & b[1])
            if both and 100 * both >= percent * len(a[1] | b[1]):
                x, y = sorted((root(a), root(b)), key=lambda n: n[0])
                parent[y] = x
    return {(r[0], r[1]): root((key(r[0]), shingles(r[1], size)))[0] for r in rows}


def by_id(frame, *columns) -> dict:
    found = defaultdict(list)
    for row in frame.collect():
        found[row["doc_id"]].append(tuple(row[c] for c in columns))
    return {doc: sorted(rows, key=repr) for doc, rows in found.items()}
