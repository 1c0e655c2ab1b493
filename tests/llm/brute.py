"""Plain single-process versions of what SQL cannot express."""

import collections
import hashlib


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def components(rows):
    """doc_id -> (set size, smallest reachable id), all pairs compared."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    holders = collections.defaultdict(list)
    for i in ids:
        near = {j for s in sets[i] for j in holders[s]}
        for j in near:
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def dedup_lines(rows):
    """doc_id -> text without the lines that stand in several documents."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    return {i: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), i) == i) for i, t in rows}


def copies(rows):
    """doc_id -> copies in the mix; ``rows`` are (doc_id, text, source)."""
    sized = [(i, len((t or "").encode().split()), s) for i, t, s in rows]
    total = collections.Counter()
    for _, n, s in sized:
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    full, left = set(), sum(total.values())
    while True:
        share = left / max(sum(weight[s] for s in order if s not in full), 1)
        over = [s for s in order if s not in full and 3 * total[s] <= weight[s] * share]
        if not over:
            break
        full.update(over)
        left -= 3 * sum(total[s] for s in over)
    target = {s: 3 * total[s] if s in full else weight[s] * share for s in order}
    rate = {s: target[s] / total[s] if total[s] else 0 for s in order}

    def taken(i, s, j):
        digest = hashlib.sha256(f"7:{i}".encode()).hexdigest()
        return int(rate[s]) + (int(digest[8 * j:8 * j + 8], 16) / 2 ** 32 < rate[s] - int(rate[s]))

    out = {}
    for s in order:
        own = [(i, n) for i, n, x in sized if x == s]
        j = min(range(8), key=lambda j: (abs(sum(n * taken(i, s, j) for i, n in own) - target[s]), j))
        out |= {i: taken(i, s, j) for i, _ in own}
    return out


def encodings(texts, path):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(path)
    for t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = lib.decode(ids, skip_special_tokens=False)
        yield len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def cheapest_reading(steps, costs):
    """Viterbi over (last two letters), one dictionary a step; ``steps`` offer (letter, price)."""
    from loadlab.llm.toxicity import CODE, OTHER

    best = {("", 0, 0): 0.0}  # (word, last two codes): the cheapest word of each pair of codes
    for options in steps:
        new = {}
        for (word, a, b), cost in best.items():
            for x, price in options:
                c = CODE.get(x, OTHER)
                to = (word + x, b, c) if x else (word, a, b)
                total = cost + price + (float(costs[a, b, c]) if x else 0.0)
                if total < new.get(to[1:], (float("inf"),))[0]:
                    new[to[1:]] = (total, to[0])
        best = {(w, *ends): cost for ends, (cost, w) in new.items()}
    return min((cost + float(costs[a, b, 0]), w) for (w, a, b), cost in best.items())[1]


def toxic_scores(rows, weights, costs):
    """doc_id -> highest weight of a reading: every token as it stands and decoded with every run of edge
    marks on or off, and runs of single characters."""
    from loadlab.llm import toxicity as t

    def read(token):
        plain = token.strip(t._EDGES)
        words = [plain] if plain.isalpha() else t._WORDS.findall(plain)
        core = t._LONG_RUN.sub(r"\1\1\1", token).strip(t._MARKS)
        first = next((i for i, c in enumerate(core) if c.isalnum()), None)
        last = max((i for i, c in enumerate(core) if c.isalnum()), default=None)
        border = [i for i in range(len(core) + 1) if i in (0, len(core)) or core[i - 1] != core[i]]
        for a in border:
            for b in border:
                if first is not None and not (a <= first and last < b):
                    continue
                part = core[a:b].strip(t._MARKS)
                if part and t.suspicious(part):
                    words += {cheapest_reading(t.lattice(part, pairs), costs) for pairs in (False, True)
                              if not pairs or t._TWICE_MARK.search(part)}
        return words

    value = lambda words: max((weights.get(f, 0.0) for w in words for f in t.features(w)), default=0.0)
    known = {}
    out = {}
    for i, text in rows:
        low = (text or "").lower()
        for token in set(low.split()) - known.keys():
            known[token] = value(read(token))
        out[i] = max([t.FLOOR, value(t.spaced_words(low, costs)), *(known[x] for x in set(low.split()))])
    return out
