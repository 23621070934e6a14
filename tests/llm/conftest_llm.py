"""Helpers of the tests in this folder."""

import hashlib


def union_find(number, edges):
    """Smallest index of each index's component."""
    root = list(range(number))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(int(a)), find(int(b))
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(number)]


def fair_queue(rows, weight):
    """(id, words) of the mixture of (id, text, source): all copies by virtual finish time, until the budget is spent."""
    queue, served = [], dict.fromkeys(weight, 0)
    for turn in range(3):
        for name, text, source in sorted(rows, key=lambda r: hashlib.md5(f"mix{r[0]}".encode()).hexdigest()):
            begin = served[source]
            served[source] += len(text.encode().split())
            place = hashlib.md5(f"mix{name}".encode()).hexdigest()
            queue.append((served[source] / weight[source], "=" + source, place, name, begin / weight[source], text.encode().split()))
    queue.sort()
    budget = sum(len(text.encode().split()) for _, text, _ in rows)
    total = {s: served[s] // 3 for s in weight}
    low, high = 0.0, 1e9  # the virtual time at which the budget is spent
    for _ in range(200):
        time = (low + high) / 2
        spent = sum(min(3 * total[s], time * weight[s]) for s in weight)
        low, high = (time, high) if spent < budget else (low, time)
    want = []
    for finish, key, _, name, begin, words in queue:
        goal = min(3 * total[key[1:]], int(high * weight[key[1:]] + 1e-6))
        left = goal - round(begin * weight[key[1:]])
        if left > 0:
            want.append((name, b" ".join(words[:left]).decode()))
    return want
