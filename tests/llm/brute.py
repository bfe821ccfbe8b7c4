"""Plain versions of the contracts, one document at a time, to hold the operators against."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha256(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def counts(text):
    text = text or ""
    words = SPACE_WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def secrets(text):
    text = text or ""
    spans = [("assign", *m.span()) for m in re.finditer(ASSIGN, text, re.ASCII) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    n = Counter(s[0] for s in spans)
    order = ("assign", "access", "hex")
    spans.sort(key=lambda s: (s[1], order.index(s[0])))
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return n["assign"], n["access"], n["hex"], sha256(listed), listed


def repeats(docs, size=50):
    """{doc_id: (bytes, removed, spans, sha256 of the rest)} for (doc_id, text) rows."""
    first = {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        raw = (text or "").encode()
        for i in range(len(raw) - size + 1):
            first.setdefault(raw[i : i + size], doc)
    out = {}
    for doc, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if first[raw[i : i + size]] < doc:
                gone[i : i + size] = b"\x01" * size
        runs = len([m for m in re.finditer(b"\x01+", bytes(gone))])
        out[doc] = (len(raw), sum(gone), runs, sha256(bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def shingles(text, size=5):
    words = SPACE_WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(docs):
    """{doc_id: (set size, smallest linked doc_id)}."""
    sets = {doc: shingles(text) for doc, text in docs}
    holders = defaultdict(list)
    for doc, own in sets.items():
        for s in own:
            holders[s].append(doc)
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for doc, own in sets.items():
        shared = Counter(o for s in own for o in holders[s] if o < doc)
        for other, n in shared.items():
            if 100 * n >= 75 * (len(own) + len(sets[other]) - n):
                a, b = root(doc), root(other)
                parent[max(a, b)] = min(a, b)
    return {doc: (len(own), root(doc)) for doc, own in sets.items()}


def contamination(docs, items, size=13):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        for i in range(max(len(words) - size, 0) + 1) if words else ():
            windows[tuple(words[i : i + size])].add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in windows[w] if x is not None}
        ids = sorted(found)
        out.append((doc, len(words), len(hit), len(ids), sha256(",".join(ids)), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def archive(pages):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) for (page_id, html) rows."""
    last = {}
    for page, html in pages:
        last[html or ""] = max(page, last.get(html or "", page))
    out = []
    for page, html in pages:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        to = last[html or ""]
        out.append((page, len(raw), digest, "response" if to == page else "revisit", None if to == page else to))
    return out


def fill_in_middle(doc, text, seed="1"):
    """(n, form, prefix, middle, output) of a text."""
    text = text or ""
    n = len(text)
    digest = sha256(f"{seed}:{'' if doc is None else doc}")
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def tokens(text):
    """Lower-cased words, and None for the end."""
    return [*SPACE_WORD.findall((text or "").translate(LOWER)), None]


def held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


def unigrams(docs):
    """Training counts, and for each of the (doc_id, text) rows (held_out, n_tokens, n_known, train_tokens, base_score)."""
    seen = Counter(w for d, t in docs if not held_out(d) for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    out = []
    for d, t in docs:
        words = tokens(t)
        base = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((held_out(d), len(words), sum(seen[w] > 0 for w in words), n, base))
    return seen, out


def forward_log(start, move, emit, steps):
    """Natural logarithm of the probability of one sequence, a step and a state at a time."""
    total, states = 0.0, range(len(start))
    share = [start[k] * emit[steps[0]][k] for k in states]
    for step in steps[1:]:
        scale = sum(share)
        total += math.log(scale)
        share = [sum(share[j] / scale * move[j][k] for j in states) * emit[step][k] for k in states]
    return total + math.log(sum(share))


def trie(turns, every=20, most=4):
    """Nodes of rebuilt conversations from (conv_id, turn, role, text) rows."""
    talks = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            talks[conv].append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [x[2:] for x in sorted(rows, key=lambda r: r[:2])] for c, rows in talks.items()}
    members, ends, words, kids = defaultdict(list), defaultdict(list), {}, defaultdict(set)
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % most
        built = tuple(talks.get(c - c % every, [])[:h] + own[h:])
        ends[built].append(c)
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
            words[built[:d]] = len(SPACE_WORD.findall(built[d - 1][1])) if d else 0
            if d:
                kids[built[: d - 1]].add(built[:d])
    leaves, saved = Counter(), Counter()
    for node, has in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(has) - 1) * words[node]
    return [
        (min(has), len(node), min(members[node[:-1]]) if node else None, len(has), len(kids.get(node, ())), leaves[node], saved[node],
         sha256(",".join(map(str, sorted(ends.get(node, []))))))
        for node, has in members.items()
    ]
