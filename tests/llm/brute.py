"""Plain versions of what the contracts ask."""

import hashlib
import re
from collections import defaultdict

WORD = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digits(value):
    return re.sub("[^0-9]", "", value)


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal(text):
    found = {
        "email": [m for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))],
        "card": [m for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))],
        "phone": [m for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m.group())) <= 15],
    }
    spans = [(k, m.start(), m.end()) for k, all_ in found.items() for m in all_]
    return [len(v) for v in found.values()], listed(spans)


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def secret(text):
    found = {
        "assign": [m for m in re.finditer(ASSIGN, text) if len(m.group(1)) >= 12],
        "access": [m for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18],
        "hex": [m for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16],
    }
    order = list(found)
    spans = sorted((m.start(), order.index(k), k, m.end()) for k, all_ in found.items() for m in all_)
    return [len(v) for v in found.values()], listed((k, a, b) for a, _, k, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, n):
    w = re.findall(WORD, (text or "").translate(LOWER))
    return frozenset(tuple(w[j : j + n]) for j in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def groups(texts, n, num, den):
    """Smallest id of each id's component; ``texts`` by id."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    ids, root = list(sets), {i: i for i in sets}
    by_gram = defaultdict(set)
    for i in ids:
        for g in sets[i]:
            by_gram[g].add(i)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in set().union(*(by_gram[g] for g in sets[i])):
            common = len(sets[i] & sets[j])
            if j < i and den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def repeated_lines(texts, window, long_line):
    """Lines that go, by id; ``texts`` by id, in order."""
    first, gone = {}, defaultdict(set)
    for i in sorted(texts):
        if texts[i] is None:
            continue
        lines = texts[i].split("\n")
        solid = [(p, x.strip(" ")) for p, x in enumerate(lines) if x.strip(" ")]
        runs = [solid[k : k + window] for k in range(len(solid) - window + 1)] + [[s] for s in solid if len(re.findall(WORD, s[1])) >= long_line]
        for run in sorted(runs, key=lambda r: r[0][0]):
            key = tuple(x for _, x in run)
            if key in first and first[key] != (i, run[0][0]):
                gone[i] |= set(range(run[0][0], run[-1][0] + 1))
            else:
                first[key] = (i, run[0][0])
    return gone
