"""Plain versions to hold the operators against."""

import numpy as np


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is None, x) for x in r))


def components(ids, links):
    """Smallest id reachable, by id."""
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def repeats(texts, size):
    """doc -> (bytes, removed, spans, what is left), by looking at every window in order."""
    seen, out = {}, {}
    for doc in sorted(texts):
        raw = (texts[doc] or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - size + 1):
            if raw[s:s + size] in seen:
                gone[s:s + size] = True
            else:
                seen[raw[s:s + size]] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out[doc] = (len(raw), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return out
