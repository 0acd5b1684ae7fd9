"""Plain versions of the operators, for small inputs."""

import math
import hashlib
import re

BLANK = r"[^\x20\x09-\x0D]+"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return re.findall(BLANK, text or "")


def shingles(text, k):
    w = words((text or "").translate(_LOWER))
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def groups(rows, k=3, percent=90, count=False):
    """(id, set size, smallest id reachable by links) of every (id, text) row, or the number of groups."""
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, s in enumerate(sets):
        for b in range(a):
            both = len(s & sets[b])
            if s and sets[b] and 100 * both >= percent * (len(s) + len(sets[b]) - both):
                up[find(a)] = find(b)
    if count:
        return len({find(i) for i in range(len(rows))})
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = doc if r not in least or least[r] is None or (doc is not None and doc < least[r]) else least[r]
    return [(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def private(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def private_digest(text):
    return hashlib.sha256(",".join("%s:%d:%d" % x for x in private(text)).encode()).hexdigest()


def rule_stats(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if re.search(BLANK, x)]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    cover = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(cover), failed


def best_path(nodes, parent, score):
    """The leaf's path with the best mean score, then the longest, then the smallest leaf id."""
    inner = {p for p in parent.values() if p in nodes}
    best = None
    for leaf in sorted(nodes - inner):
        path, at = [], leaf
        while at in nodes and at not in path:
            path.append(at)
            at = parent[at]
        if at in nodes:
            continue
        key = (sum(score[n] for n in path) / len(path), len(path), -leaf)
        if best is None or key > best[0]:
            best = (key, path[::-1])
    return best and best[1]


def fused(rows, languages, smooth=5.0, sure=0.6):
    """(lang, confidence, text_lang, kept) of evidence rows, each judged by sums over all other rows."""
    k = len(languages)

    def softmax(logs):
        weights = [math.exp(x - max(logs)) for x in logs]
        return [w / sum(weights) for w in weights]

    def shares(sums, base):
        total = sum(sums)
        return [(s + smooth * b) / (total + smooth) for s, b in zip(sums, base)]

    known = [r["n"] > 0 and max(r["ratio"]) > 0 for r in rows]
    p = [softmax(r["ratio"]) if ok else [0.0] * k for r, ok in zip(rows, known)]
    whole = [sum(x[i] for x in p) for i in range(k)]
    corpus = [(x + 1) / (sum(whole) + k) for x in whole]
    out = []
    for at, r in enumerate(rows):
        def others(key):
            alike = [p[j] for j, o in enumerate(rows) if j != at and o[key] == r[key]]
            return [sum(x[i] for x in alike) for i in range(k)]

        host = shares(others("host"), shares(others("domain"), corpus))
        logs = [(x if r["n"] > 0 else 0.0) + math.log(h) for x, h in zip(r["ratio"], host)]
        for key in ("declared", "suffix"):
            lift = [a / b for a, b in zip(shares(others(key), corpus), corpus)]
            logs = [a + math.log(b) for a, b in zip(logs, lift)]
        posterior = softmax(logs)
        sure_of = max(posterior)
        explained = known[at] or (0 < r["n"] < 10 and r["declared"] in languages)
        out.append((
            languages[posterior.index(sure_of)] if explained else "und", sure_of,
            languages[p[at].index(max(p[at]))] if known[at] else "und", explained and sure_of >= sure,
        ))
    return out


def reliabilities(patterns, labelers, tolerance):
    """Prior and vote tables by expectation-maximisation over counted vote patterns (dicts with n and a vote per labeler)."""
    prior, before, count = 0.5, -math.inf, sum(r["n"] for r in patterns)
    says = {name: {1: (0.5, 0.15), 0: (0.35, 0.35), -1: (0.15, 0.5)} for name in labelers}
    while True:
        weight, fit = [], 0.0
        for r in patterns:
            a = prior * math.prod(says[name][r[name]][0] for name in labelers)
            b = (1 - prior) * math.prod(says[name][r[name]][1] for name in labelers)
            weight.append(r["n"] * a / (a + b))
            fit += r["n"] * math.log(a + b) / count
        if abs(fit - before) < tolerance:
            return prior, says
        yes, before = sum(weight), fit
        prior = yes / count
        says = {name: {vote: (
            (sum(w for w, r in zip(weight, patterns) if r[name] == vote) + 1) / (yes + 3),
            (sum(r["n"] - w for w, r in zip(weight, patterns) if r[name] == vote) + 1) / (count - yes + 3),
        ) for vote in (1, 0, -1)} for name in labelers}
