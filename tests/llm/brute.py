"""Plain Python forms of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

#: Nulls, empty and long texts, repeated rows, a null id, accents and special strings.
AWKWARD = [
    (1, None), (2, ""), (3, "   \t\n "), (4, "one"), (5, "Two words"), (6, "the quick brown fox jumps over the lazy dog"), (7, "THE QUICK brown fox jumps over the lazy dog"), (8, "the quick brown fox jumps over the lazy dog"),
    (8, "the quick brown fox jumps over the lazy dog"), (None, "no id here at all"), (9, "naïve Ünïcode   text \U0001f600 with wide blanks <|endoftext|> inside's we'll"), (10, "again and again and again and again\nline\nline\n\nline x\n" * 40), (11, "word " * 20_000), (12, "tail\r\nend  "),
]

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def lower(text):
    return (text or "").translate(LOWER)


def fingerprint(text: str | None) -> int:
    words = WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps: dict[int, int], radius: int = 2) -> dict[int, int]:
    """doc_id to the least doc_id reachable over pairs within ``radius`` bits."""
    left, out = dict(fps), {}
    for first in sorted(fps):
        if first in out:
            continue
        queue = [first]
        while queue:
            d = queue.pop()
            if d in out:
                continue
            out[d] = first
            left.pop(d, None)
            queue += [e for e, f in left.items() if (f ^ fps[d]).bit_count() <= radius]
    return out


def quality(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen: dict = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    marked = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines, before = 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in before
            before.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": lines, "n_repeat_words": len(marked), "base_failed": len(words) < 50 or 100 * len(marked) > 50 * len(words)}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text: str | None) -> dict:
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12 and all(c.isascii() for c in m[0])]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16]
    order = {"assign": 0, "access": 1, "hex": 2}
    found.sort(key=lambda s: (s[1], order[s[0]]))
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
    return {"n_assign": sum(k == "assign" for k, _, _ in found), "n_access": sum(k == "access" for k, _, _ in found), "n_hex": sum(k == "hex" for k, _, _ in found), "base_sha256": hashlib.sha256(joined.encode()).hexdigest(), "base": found}


BENCH = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(docs: list[tuple], items: list[tuple], size: int = 13) -> dict:
    windows: dict = {}
    for item, text in items:
        words = BENCH.findall(lower(text))
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for doc_id, text in docs:
        words = BENCH.findall(lower(text))
        hit, of = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                w = tuple(words[i : i + n])
                if w in windows:
                    hit.update(range(i, i + n))
                    of |= windows[w]
        out[doc_id] = (len(words), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(words))
    return out


def crc(value) -> int:
    return zlib.crc32(str(value).encode())
