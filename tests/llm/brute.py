"""Plain versions of the operators, for small inputs."""


def roots(nodes, links):
    """node -> smallest node reachable."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def word_shingles(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def ngram_groups(docs, percent=80):
    """doc id -> (set size, component) for (id, text) rows with distinct ids."""
    sets = {i: word_shingles(t) for i, t in docs}
    where = {}
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    links = set()
    for i, s in sets.items():
        near = {j for g in s for j in where[g] if j < i}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                links.add((j, i))
    up = roots(sets, links)
    return {i: (len(s), up[i]) for i, s in sets.items()}
