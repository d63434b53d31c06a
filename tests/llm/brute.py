"""Plain Python versions of the operators, for small tables."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    words = WHITE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def components(sets):
    """{id: smallest id reachable} over links of Jaccard 0.75 and more."""
    ids = sorted(sets)
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 4 * len(x) >= 3 * len(y) and 4 * len(y) >= 3 * len(x):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
    return {d: find(d) for d in ids}


def secret_spans(text):
    """Base spans: (start, order of the kind, end, kind)."""
    text = text or ""
    assign = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """{source: target} by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    got, open_, left = dict.fromkeys(order, 0.0), set(order), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        rest = 0.0
        for s in sorted(open_, key=str):
            got[s] += left * weight[s] / total
            if got[s] > most * sizes[s]:
                rest += got[s] - most * sizes[s]
                got[s] = float(most * sizes[s])
        open_ = {s for s in open_ if got[s] < most * sizes[s]}
        left = rest
    return got


def mix_passes(rows, most=2, seed="mix", packet=64, share=1.5):
    """[(doc_id, pass, words taken)] for rows (doc_id, source, text): the packets of all sources in one
    queue by finish time, ended by the budget alone."""
    size = {d: len(WHITE.findall(t or "")) for d, _, t in rows}
    by = defaultdict(list)
    for d, s, _ in rows:
        by[s].append(d)
    goal = targets({s: sum(size[d] for d in ds) for s, ds in by.items()})
    queue = []
    for number, s in enumerate(sorted(by, key=lambda s: (s is None, (s or "").encode()))):
        done = 0
        for turn in range(most):
            for d in sorted(by[s], key=lambda d: (hashlib.md5(f"{seed}:{d}".encode()).hexdigest(), size[d])):
                for start in range(0, size[d], packet):
                    words = min(packet, size[d] - start)
                    done += words
                    queue.append((done / goal[s], number, done, d, turn, words))
    room, taken = math.floor(share * sum(size.values())), defaultdict(int)
    for _, _, _, d, turn, words in sorted(queue):
        taken[d, turn] += min(words, room)
        room -= min(words, room)
    return [(d, turn, n) for (d, turn), n in taken.items() if n], size, goal


def mix(rows, **more):
    """{doc_id: words taken}, sizes and targets."""
    passes, size, goal = mix_passes(rows, **more)
    taken = dict.fromkeys(size, 0)
    for d, _, n in passes:
        taken[d] += n
    return taken, size, goal


def trie(rows):
    """Nodes of rows (conv_id, turn, role, text): (conv_id, depth, parent, members, children, leaves, saved, ends)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        rebuilt = own.get(base, [])[:h] + turns[h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
        ends[tuple(rebuilt)].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    total, out = {}, []
    for k in sorted(members, key=len, reverse=True):
        leaves = sum(total[c][0] for c in children[k]) or 1
        saved = sum(total[c][1] for c in children[k]) + ((len(members[k]) - 1) * len(WHITE.findall(k[-1][1])) if k else 0)
        total[k] = leaves, saved
        ids = ",".join(map(str, sorted(ends[k])))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(children[k]), leaves, saved,
                    hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=repr)


def aligned(texts, tokenizer, pieces, bytes_a, bytes_b):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups hash) of each text by the libraries' own encoding of the whole text."""
    docs, count = [], Counter()
    for text in texts:
        a, b = (tokenizer.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)) if text else ([], [])
        raw = (" " + text).encode() if text else b""
        if not text or b"".join(bytes_a[k] for k in a) != raw or b"".join(bytes_b(k) for k in b) != raw:
            docs.append(None)
            continue
        end_a, end_b = (list(itertools.accumulate(sizes)) for sizes in ([len(bytes_a[k]) for k in a], [len(bytes_b(k)) for k in b]))
        groups, i, j = [], 0, 0
        for end in sorted(set(end_a) & set(end_b)):
            p, q = end_a.index(end, i) + 1, end_b.index(end, j) + 1
            groups.append((a[i:p], b[j:q]))
            i, j = p, q
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        count.update(links.keys())
        docs.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc in docs:
        if doc is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = doc
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(m for k, m in links.items() if count[k] == best[k[0]]),
                    sum(m * count[k] for k, m in links.items()), hashlib.sha256(text.encode()).hexdigest()))
    return out
