"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text: str, size: int = 3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(max(1, len(words) - size + 1))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items: list, near) -> list[int]:
    """Per item the first item of its component."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if near(items[i], items[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(items))]


def ppm(train: list[str], texts: list[str], order: int = 4) -> list[float]:
    counts = [defaultdict(Counter) for _ in range(order + 1)]

    def symbols(text):
        return [0] * order + [b + 1 for b in text.encode()] + [0]

    for text in train:
        s = symbols(text)
        for p in range(order, len(s)):
            for k in range(order + 1):
                counts[k][tuple(s[p - k : p])][s[p]] += 1
    out = []
    for text in texts:
        s, total = symbols(text), 0.0
        for p in range(order, len(s)):
            gone: set = set()
            for k in range(order, -1, -1):
                left = {x: n for x, n in counts[k].get(tuple(s[p - k : p]), {}).items() if x not in gone}
                if not left:
                    continue
                all_ = sum(left.values())
                if s[p] in left:
                    total += math.log10((2 * left[s[p]] - 1) / (2 * all_))
                    break
                total += math.log10(len(left) / (2 * all_))
                gone |= set(left)
            else:
                total -= math.log10(257 - len(gone))
        out.append(total)
    return out


def counts(text: str) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def without_repeats(docs: list[tuple[int, str]]) -> dict[int, tuple]:
    first: dict[bytes, int] = {}
    for key, text in sorted(docs):
        data = text.encode()
        for i in range(len(data) - 49):
            first.setdefault(data[i : i + 50], key)
    out = {}
    for key, text in docs:
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < key:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def near_lines(a: list[str], b: list[str]) -> bool:
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 5:
        return False
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    return head + tail >= max(len(a), len(b)) - 1


def line_dedup(docs: list[tuple[int, str]]) -> dict[int, str]:
    seen: list[list[str]] = []
    out = {}
    for key, text in sorted(docs):
        kept = []
        for line in text.split("\n"):
            words = WORD.findall(line)
            if words:
                if any(near_lines(words, other) for other in seen):
                    seen.append(words)
                    continue
                seen.append(words)
            kept.append(line)
        out[key] = "\n".join(kept)
    return out


def held_out(key, divisor: int) -> int:
    return zlib.crc32(b"" if key is None else str(key).encode()) % divisor
