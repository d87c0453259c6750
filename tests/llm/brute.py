"""Plain Python versions of the operators, quadratic where they like."""

import hashlib
import math
import re
import string
import zlib
from collections import defaultdict
from itertools import combinations

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text):
    data = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    return hashlib.sha256(data).hexdigest()


class Sets:
    """Union of what is linked."""

    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def root(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    if len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def near_duplicates(docs, k, percent=80):
    """{place: (set size, place of the component's first)} of a list of texts."""
    sets = [shingle_set(t, k) for t in docs]
    linked = Sets(range(len(docs)))
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, j in {p for h in holders.values() for p in combinations(h, 2)}:
        common = len(sets[i] & sets[j])
        if 100 * common >= percent * len(sets[i] | sets[j]):
            linked.join(i, j)
    return {i: (len(sets[i]), linked.root(i)) for i in range(len(docs))}


SECRETS = (
    (
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
        2,
        12,
    ),
    (r"AKIA[A-Z0-9]+", 0, 0, 18),
    (r"[0-9a-f]+", 0, 0, 16),
)


def base_secrets(text):
    out = []
    for kind, (pattern, flags, group, least) in enumerate(SECRETS):
        for match in re.finditer(pattern, text or "", flags):
            if len(match.group(group)) >= least:
                out.append((match.start(), kind, match.end()))
    return sorted(out)


def entropy(text, width):
    best = None
    for i in range(len(text) - width + 1):
        window = text[i : i + width]
        bits = -sum(
            window.count(c) / width * math.log2(window.count(c) / width) for c in set(window)
        )
        best = bits if best is None else max(best, bits)
    return best


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def licenses(text, phrases, templates):
    text = (text or "").translate(LOWER)
    words, places = WORD.findall(text), []
    for label, phrase in phrases.items():
        phrase = phrase.split()
        for i in range(len(words) - len(phrase) + 1):
            if words[i : i + len(phrase)] == phrase:
                places.append((i, label))
    labels, best = {label for _, label in places}, 1.0 if places else 0.0
    blocks = {i: set(WORD.findall(line)) for i, line in enumerate(text.split("\n"))}
    step = max(len(t.text.split()) for t in templates)
    if "\n" in text:
        for i, at in enumerate(range(0, max(len(words) - step - 1, 0) + 1, step)):
            blocks[-2 - i] = set(words[at : at + 2 * step])
    met = [
        (at, t)
        for at, block in blocks.items()
        for t in templates
        if len(set(t.words) & block) >= t.needed and set(t.required.split()) <= block
    ]
    for at, t in met:
        near = {at - 1, at, at + 1} if at < 0 else {at}
        covers = any(
            set(t.words) < set(other.words) and (there in near if there < 0 or there == at else False)
            for there, other in met
        )
        if not covers:
            labels.add(t.label)
            best = max(best, len(set(t.words) & blocks[at]) / len(t.words))
    return len(words), sorted(places), ",".join(sorted(labels)), best


def distance(pattern, text):
    """Least edit distance of the pattern to any substring."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        above, row = row, [i]
        for j, c in enumerate(text, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (p != c)))
    return min(row)


def jump(key, shards):
    """Jump consistent hash of one 64-bit key."""
    shard, ahead = -1, 0
    while ahead < shards:
        shard = ahead
        key = (key * 2862933555777941757 + 1) % 2**64
        ahead = int((shard + 1) * (2**31 / ((key >> 33) + 1)))
    return shard


def family_paths(rows):
    """Rebuilt paths by conversation, of (conv_id, turn, role, text) rows."""
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            said[conv].append((turn is not None, turn or 0, digest, role, text))
    whole = {c: [x[3:] for x in sorted(turns)] for c, turns in said.items()}
    out = {}
    for conv, own in whole.items():
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = whole.get(conv - conv % 5, [])[:h] + own[h:]
    return out


def trie(paths):
    """(conv_id, depth) -> the other columns of the node, by walking every path."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv in sorted(paths):
        path = tuple(paths[conv])
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
            if d:
                children[path[: d - 1]].add(path[:d])
        ends[path].append(conv)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        below = [out[members[c][0], len(c)] for c in children[node]]
        out[members[node][0], len(node)] = (
            members[node[:-1]][0] if node else None,
            len(members[node]),
            len(below),
            sum(b[3] for b in below) if below else 1,
            own + sum(b[4] for b in below),
            sha(",".join(map(str, ends[node]))),
        )
    return out
