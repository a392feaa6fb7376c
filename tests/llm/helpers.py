"""Plain re-statements of the contracts, for small inputs."""

import re

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_NOT_SPACE = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return _ALNUM.findall((text or "").translate(_UPPER))


def spaced_words(text):
    return _NOT_SPACE.findall((text or "").translate(_UPPER))


class Links:
    """Smallest member of each group of linked nodes."""

    def __init__(self, nodes):
        self.above = {n: n for n in nodes}

    def least(self, node):
        while self.above[node] != node:
            node = self.above[node]
        return node

    def link(self, a, b):
        a, b = self.least(a), self.least(b)
        self.above[max(a, b)] = min(a, b)


def with_clashes(frame):
    """The frame with columns more whose names are those of results, in other letter case too."""
    taken = {c.lower() for c in frame.columns}
    names = ("score", "N_WORDS", "spans", "item_ids", "key", "part", "component", "ids", "n", "tokens")
    return frame.selectExpr("*", *(f"'x' AS `{n}`" for n in names if n.lower() not in taken))
