"""Plain Python versions of the operators, for small fixtures."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
BLANKS = "\t\n\x0b\x0c\r "


def shingles(text, size=5):
    w = WORD.findall((text or "").lower())
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def links(texts, similarity=0.8):
    sets = [shingles(t) for t in texts]
    out = [[] for _ in texts]
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and both >= similarity * len(sets[i] | sets[j]) - 1e-9:
            out[i].append(j)
            out[j].append(i)
    return out


def groups(linked):
    seen = {}
    for start in range(len(linked)):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen[x] = start
                todo += linked[x]
    return [seen[k] for k in range(len(linked))]


def line_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def dedup_lines(texts, least=10):
    n = Counter(k for t in texts for k in {line_key(x) for x in (t or "").split("\n")} if k)
    kept = [[x for x in (t or "").split("\n") if not (line_key(x) and n[line_key(x)] >= least)] for t in texts]
    return ["\n".join(x) for x in kept], [len((t or "").split("\n")) - len(x) for t, x in zip(texts, kept, strict=True)]


def edit_distance_inside(item, text):
    """Least edit distance of the item to any run of the text's words."""
    row = list(range(len(item) + 1))
    best = len(item)
    for word in text:
        new = [0]
        for j, x in enumerate(item, 1):
            new.append(min(row[j - 1] + (x != word), row[j] + 1, new[j - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = defaultdict(list)
    for k in range(len(w) - 4):
        runs[tuple(w[k : k + 5])].append(k)
    again = {k + d for at in runs.values() if len(at) > 1 for k in at for d in range(5)}
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed


def cheapest_repair(roles):
    """Least cost of turning roles into a legal conversation, by search over all states."""
    following = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    costs = {"start": 0}

    def inserted(costs):
        for _ in range(3):
            for state, cost in list(costs.items()):
                for role in following[state]:
                    costs[role] = min(costs.get(role, 99999), cost + 3)
        return costs

    for role in roles:
        new = {}
        for state, cost in inserted(dict(costs)).items():
            for r in following[state]:
                new[r] = min(new.get(r, 99999), cost + 2 * (r != role))
        for state, cost in costs.items():
            if state != "start":
                new[state] = min(new.get(state, 99999), cost + 1 + 2 * (state != role))
        costs = new
    return inserted(dict(costs))["assistant"] if roles else 0


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrase_counts(rows, order):
    """Occurrences of all phrases per language, and of all words, from (text, lang) rows."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, order + 1) for i in range(len(w) - k + 1))
    return counts, totals


def collocations(rows, order, least, top, share=100):
    counts, totals = phrase_counts(rows, order)
    found = {p: n for p, n in counts.items() if n >= least and len(p[1]) > 1}

    def inside(a, b):
        return len(a) < len(b) and any(b[i : i + len(a)] == a for i in range(len(b) - len(a) + 1))

    ranked = defaultdict(list)
    for (lang, p), a in found.items():
        if any(x == lang and inside(p, q) and 100 * n >= share * a for (x, q), n in found.items()):
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        ranked[lang].append((-score, -a, " ".join(p), left, right))
    return [
        (lang, rank, p, -a, left, right, totals[lang], -score)
        for lang, all_of in ranked.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(all_of)[:top], 1)
    ]


def quartile_digest(text, buckets):
    data = (text or "").encode()
    counts = [0] * buckets
    for k in range(len(data) - 2):
        triplet = int.from_bytes(data[k : k + 3], "big") + 1
        counts[(triplet * 2654435769 & 0xFFFFFFFF) * buckets >> 32] += 1
    ordered = sorted(counts)
    return [sum(c > ordered[q * buckets // 4 - 1] for q in (1, 2, 3)) for c in counts]


def misspelt(doc_id, run, deleted):
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % deleted else run[: h % len(run)] + run[h % len(run) + 1 :]


def spelling(rows, min_length=6, min_count=5, ratio=5, deleted=199):
    """(word, form, root, n, n_near, form_n) from (doc_id, text) rows."""
    seen = Counter(
        misspelt("" if d is None else d, r, deleted) for d, t in rows for r in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(LOWER))
    )
    n = {w: k for w, k in seen.items() if k >= min_count and len(w) >= min_length}
    near = {w: neighbours(w, n) for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=lambda r: r[0])


def neighbours(word, words):
    """The other words one insertion, deletion or replacement of a code point away."""
    letters = {c for w in words for c in w}
    cut = {word[:i] + word[i + 1 :] for i in range(len(word))}
    changed = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    longer = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return ((cut | changed | longer) - {word}) & words.keys()


def battery(token, encodings):
    """The narrowest encoding and Fisher's combined p-value of the three tests."""
    name, alphabet = next((n, a) for n, a in encodings if set(token) <= set(a))
    v, n, size = [alphabet.index(c) for c in token], len(token), len(alphabet)
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    chi = size / n * sum(v.count(k) ** 2 for k in range(size)) - n
    df = size - 1
    z_chi = ((max(chi, 1e-9) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    above = [2 * x >= size for x in v]
    high = sum(above)
    runs = 1 + sum(a != b for a, b in itertools.pairwise(above))
    expected = 2 * high * (n - high) / n + 1
    spread = (expected - 1) * (expected - 2) / (n - 1)
    z_runs = abs(runs - expected) / math.sqrt(spread) if spread > 0 else 12
    mean = sum(v) / n
    total = sum((x - mean) ** 2 for x in v)
    z_serial = abs(sum((a - mean) * (b - mean) for a, b in itertools.pairwise(v)) / total + 1 / n) * math.sqrt(n) if total else 12
    half = -sum(min(0, math.log(max(p, 1e-12))) for p in (tail(z_chi), 2 * tail(z_runs), 2 * tail(z_serial)))
    return name, math.exp(-half) * (1 + half + half * half / 2)


def evidence(token, alphabet, module):
    """Bits of the token as ordinary text less its bits as a random string."""
    table = module.ordinary_bits()
    codes = [len(module.CHARACTERS), *(module.CHARACTERS.index(c) for c in token)]
    return sum(table[a, b] for a, b in itertools.pairwise(codes)) - len(token) * math.log2(len(alphabet))


def segmentations(word, pieces):
    """All ways to cut a word into pieces."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            yield from ([word[:n], *rest] for rest in segmentations(word[n:], pieces))
