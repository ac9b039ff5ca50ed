"""Plain versions of the operators' contracts, written for clarity and small inputs."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def base_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def simhash(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(fingerprints, most=2):
    """Smallest id reachable, by comparing all pairs of distinct fingerprints."""
    distinct = sorted(set(fingerprints.values()))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= most:
                parent[root(a)] = root(b)
    smallest = {}
    for doc, f in fingerprints.items():
        smallest[root(f)] = min(doc, smallest.get(root(f), doc))
    return {doc: smallest[root(f)] for doc, f in fingerprints.items()}


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def marks(text, k, width):
    """(hash, byte position) by looking at every window on its own."""
    data = text.encode()
    if not data:
        return []
    grams = [xxhash.xxh64_intdigest(data[i:i + k], 42) >> 32 for i in range(max(len(data) - k + 1, 1))]
    out = []
    for first in range(max(len(grams) - width + 1, 1)):
        window = grams[first:first + width]
        least = min(window)
        place = first + max(i for i, h in enumerate(window) if h == least)
        if not out or out[-1] != (least, place):
            out.append((least, place))
    return out


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0
