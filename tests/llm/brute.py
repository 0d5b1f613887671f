"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict, deque
from itertools import combinations, product

from xxhash import xxh64_intdigest

SPACE = " \t\n\x0b\f\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def groups(pairs, nodes):
    """Smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def line_dedup(rows, size=3):
    """{id: (text, removed)} of (id, text) with distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        lines = (text or "").split("\n")
        spots = [i for i, line in enumerate(lines) if line.strip(SPACE)]
        covered = set()
        for k in range(len(spots) - size + 1):
            window = tuple(lines[i].strip(SPACE) for i in spots[k : k + size])
            if window in seen:
                covered.update(range(k, k + size))
            seen.add(window)
        gone = {spots[k] for k in covered}
        for k in covered:
            if k + 1 in covered:
                gone.update(range(spots[k], spots[k + 1]))
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text, len(covered))
    return out


def fingerprint(text, size=3):
    found = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    found = words(found)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + size]) for i in range(len(found) - size + 1)] or [" ".join(found)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows, size=3, distance=3):
    prints = {i: fingerprint(t, size) for i, t in rows}
    pairs = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= distance]
    return prints, groups(pairs, prints)


def quality_counts(text):
    found = words(text)
    n, at = len(found), defaultdict(list)
    for i in range(n - 4):
        at[tuple(found[i : i + 5])].append(i)
    repeated = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {
        "n_words": n,
        "word_chars": sum(map(len, found)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
    }


def best_fit(items, capacity):
    """Bins of (size, source, cluster), by trying every bin."""
    bins, out = [], []
    for size, source, cluster in items:
        fits = [
            (left, k)
            for k, (left, sources, clusters) in enumerate(bins)
            if left >= size and left and (source is None or source not in sources) and (cluster is None or cluster not in clusters)
        ]
        if fits:
            _, k = min(fits)
        else:
            k = len(bins)
            bins.append([capacity, set(), set()])
        bins[k][0] -= size
        bins[k][1].add(source)
        bins[k][2].add(cluster)
        out.append(k)
    return out


def linked(rows, tokens_a, tokens_b):
    """(rows of (id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest), counts of
    id pairs); ``tokens_a`` and ``tokens_b`` give (id, bytes) of a text's tokens."""
    counts, cut = Counter(), []
    for i, text in rows:
        raw, groups, links = f" {text}".encode(), [], Counter()
        a, b = (tokens_a(text), tokens_b(text)) if text else ([], [])
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == raw:
            a, b = [], []
        at_a = at_b = 0
        left, right, mine, theirs = deque(a), deque(b), [], []
        while left or right:
            if at_a <= at_b:
                token, x = left.popleft()
                mine.append(token)
                at_a += len(x)
            else:
                token, x = right.popleft()
                theirs.append(token)
                at_b += len(x)
            if at_a == at_b:
                groups.append((mine, theirs))
                mine, theirs = [], []
        for mine, theirs in groups:
            links.update(product(mine, theirs))
        counts.update(set(links))
        cut.append((i, len(a), len(b), groups, links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for i, n_a, n_b, groups, links in cut:
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            i, n_a, n_b, len(groups), sum(links.values()),
            sum(n for k, n in links.items() if counts[k] == best[k[0]]), sum(n * counts[k] for k, n in links.items()),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        ))
    return out, dict(counts)


def damaged(rows):
    """Conversation rows after the damage of the query."""
    def named(x):
        return " " if x is None else str(x)

    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{named(conv)}:{named(turn)}".encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", named(text)) if draw == 2 else named(text)
        for _ in range((1, 2)[draw == 3] if draw else 0):
            yield conv, turn, "user" if draw == 4 else named(role), text


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of one
    conversation, keeping all cheapest repairs to each state as whole strings."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:64], hashlib.md5(r[3].encode()).digest()))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def closed(states):
        for _ in range(4):
            for state, ways in list(states.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in after:
                        more = {(cost + 2, audit + "I", (*out, f"{role}:")) for cost, audit, out in ways if not audit.endswith("II")}
                        states.setdefault(after[state, role[0]], set()).update(more)
        return {s: {w for w in ways if w[0] == min(ways)[0]} for s, ways in states.items() if ways}

    states, seen, faults = closed({"": {(0, "", ())}}), set(), Counter()
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        faults[fault] += 1
        seen.add((role, text))
        stays, then = int(fault == "truncated"), defaultdict(set)
        for state, ways in states.items():
            for cost, audit, out in ways:
                then[state].add((cost + 3, audit + "D", out))
                for to, price, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if fault not in ("blank", "duplicate") and (state, to[:1]) in after:
                        then[after[state, to[:1]]].add((cost + price + stays, audit + letter, (*out, f"{to}:{text}")))
        states = closed(then)
    ends = [w for state in ("", "a") for w in states.get(state, ())]
    cost, audit, out = min(ends)
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:], strict=False))
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest


def languages(rows, order, fold):
    """{id: language} by naive Bayes over plain n-grams; ``rows`` are (id, text, lang)."""
    def grams(text):
        plain = re.sub(r"[\W\d_]+", " ", f" {text.lower()} ")
        return [plain[i : i + n] for n in range(1, order + 1) for i in range(len(plain) - n + 1) if plain[i : i + n] != " "]

    counts, docs = defaultdict(Counter), Counter()
    for i, text, lang in rows:
        if lang is not None and zlib.crc32(str(i).encode()) % 4 != fold:
            docs[lang] += 1
            counts[lang].update(grams(text or ""))
    out = {}
    for i, text, _ in rows:
        found = grams(text or "")
        sums = {x: math.log(docs[x]) + sum(math.log((counts[x][g] + 0.1) / (counts[x].total() + 6553.6)) for g in found) for x in docs}
        out[i] = max(sums, key=sums.get) if found else "und"
    return out


def spelled_ratios(counts, words, order=6, shared=2, discount=0.75, letter=1 / 200):
    """{word: log-likelihood ratio} by two Kneser-Ney models of the words' document counts
    (ordinary, toxic), each probability worked out from plain counts."""
    def ends(word):
        s = f"^{word}$"
        return [s[max(0, e - order) : e] for e in range(2, len(s) + 1)]

    top = defaultdict(lambda: [0, 0])
    for word, pair in counts.items():
        for gram in ends(word):
            for k in (0, 1):
                top[gram][k] += pair[k]
    tables, grams = {}, {g: v for g, v in top.items() if len(g) == order}
    for n in range(order, 0, -1):
        if n < order:
            before = defaultdict(lambda: [0, 0])
            for gram, pair in grams.items():
                for k in (0, 1):
                    before[gram[1:]][k] += pair[k] > 0
            for gram, pair in top.items():
                if len(gram) == n and gram[0] == "^":
                    for k in (0, 1):
                        before[gram][k] += pair[k]
            grams = dict(before)
        sums = [sum(v[k] for v in grams.values()) for k in (0, 1)]
        least = min((x for x in sums if x), default=0)
        scaled = {g: [v[k] * least / sums[k] if sums[k] else 0.0 for k in (0, 1)] for g, v in grams.items()}
        if n <= shared:
            scaled = {g: [sum(v)] * 2 for g, v in scaled.items()}
        of = defaultdict(list)
        for gram, pair in scaled.items():
            of[gram[:-1]].append((gram, pair))
        tables[n] = {}
        for context, rows in of.items():
            for k in (0, 1):
                total = sum(v[k] for _, v in rows)
                own = {g: (v[k] - discount * min(v[k], 1)) / total if total else 0.0 for g, v in rows}
                tables[n][context, k] = own, 1 - sum(own.values())

    def p(gram, k):
        if not gram:
            return letter
        shorter = p(gram[1:], k)
        own = tables[len(gram)].get((gram[:-1], k))
        return shorter if own is None else own[0].get(gram, 0.0) + own[1] * shorter

    return {w: sum(math.log(p(g, 1) / p(g, 0)) for g in ends(w)) for w in words}


def toxic_gains(rows, labels, mixed=0.05, noise=3.0):
    """{id: mean gain} of (id, text) rows with distinct ids, from (id, toxic) labels."""
    def found(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    toxic = {}
    for i, label in labels:
        if label is not None:
            toxic[i] = max(toxic.get(i, 0), int(label > 0))
    counts = defaultdict(lambda: [0, 0])
    for i, text in rows:
        if i in toxic and (draw := zlib.crc32(str(i).encode())) % 4 != 2 and draw // 4 % 4 != 0:
            for word in set(found(text)):
                counts[word][toxic[i]] += 1
    ratios = spelled_ratios(counts, {w for _, text in rows for w in found(text)})
    gains = {w: math.log((1 - mixed + mixed * math.exp(r)) / (1 - mixed)) if r > noise else 0.0 for w, r in ratios.items()}
    return {i: sum(map(gains.get, found(text))) / len(found(text)) if found(text) else 0.0 for i, text in rows}
