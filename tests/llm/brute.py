"""Plain versions of the operators, one document at a time."""

import math
import re
import unicodedata
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def components(texts, percent=85):
    """id -> least id reachable over links, from {id: text}."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def network_score(network, text):
    """The convolution window by window: filters of 16 bytes at each stride of 4, the
    largest response of each chunk of 512 (in steps of 448), the chunks' mean."""
    n_filters = len(network.weights)
    # A text's area ends at a whole segment behind at least 20 bytes of padding.
    area = (len(text) + 20 + 63) // 64 * 64
    data = text.ljust(area, b"\0")
    responses = {}
    for at in range(0, area - 12, 4):
        x = [float(v) for byte in data[at : at + 16] for v in network.embedding[byte]]
        weights = network.filters.reshape(64, n_filters)
        responses[at] = [
            max(0.0, math.fsum([float(network.bias[f]), *(a * float(w) for a, w in zip(x, weights[:, f]))])) for f in range(n_filters)
        ]
    chunks = 1 + max(0, -(-(len(text) - 512) // 448))
    pooled = [
        [max((responses[at][f] for at in responses if 448 * c <= at < 448 * c + 512), default=0.0) for f in range(n_filters)]
        for c in range(chunks)
    ]
    z = float(network.offset)
    for f in range(n_filters):
        z = z + sum(p[f] for p in pooled) / chunks * float(network.weights[f])
    return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def gear_chunks(data, gear, least=8, normal=24, most=96, hard=5, easy=3):
    """Chunk lengths, byte by byte: the 16-bit gear hash of the last 16 bytes cuts where
    its top bits are zero, more of them before a chunk's normal size than after."""
    lengths, size = [], 0
    for i, _ in enumerate(data):
        size += 1
        h = 0
        for byte in data[max(0, i - 15) : i + 1]:
            h = (h * 2 + gear[byte]) % 65536
        bits = hard if size < normal else easy
        if size == most or size >= least and h < 2 ** (16 - bits):
            lengths.append(size)
            size = 0
    return lengths + [size] * (size > 0)


def letter_grams(text):
    """Letter n-grams of 1 to 3 with word ends (a blank), and their counts."""
    words = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()).split()
    if not words:
        return Counter()
    line = " " + " ".join(words) + " "
    grams = [line[i : i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)]
    return Counter(g for g in grams if g != " " and not (len(g) == 3 and g[1] == " "))


def ranked(counts, size=300):
    """The most frequent first, ties in the order of their packed code points."""
    packed = {g: sum((1 if c == " " else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)) for g in counts}
    return sorted(counts, key=lambda g: (-counts[g], packed[g]))[:size]


def out_of_place(text, profiles, size=300):
    """Language and mean distance of the nearest profile, first by name; None without letters."""
    own = ranked(letter_grams(text), size)
    if not own:
        return None
    found = []
    for name in sorted(profiles):
        rank = {g: i for i, g in enumerate(profiles[name])}
        found.append((sum(abs(rank[g] - i) if g in rank else size for i, g in enumerate(own)) / len(own), name))
    return min(found)


def byte_shards(rows, shards, order):
    """Shard of each (id, text) row: the shards' bytes are equal parts of all rows put in
    ``order``; a row belongs where its middle byte lies."""
    rows = sorted(rows, key=order)
    sizes = [len((text or "").encode()) + 1 for _, text in rows]
    total, begin, found = sum(sizes), 0, []
    for row, size in zip(rows, sizes):
        found.append((row, min((2 * begin + size) * shards // (2 * total), shards - 1)))
        begin += size
    return found
