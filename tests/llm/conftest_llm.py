"""Plain helpers for brute-force answers."""


def components(nodes, edges):
    root = {n: n for n in nodes if n is not None}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in root}
