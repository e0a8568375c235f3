"""The same rules in plain Python, one batch at a time, for small fixtures."""

from __future__ import annotations

import hashlib
import re
from collections import Counter


def tokens(content: str) -> list[str]:
    if content == "":
        return [""]
    parts = re.split("[^a-z0-9]+", content.lower())
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def digest(content: str) -> str:
    return hashlib.sha1("".join(tokens(content)).encode("utf-16-le")).hexdigest()


def phrases(content: str, n: int = 4) -> list[str]:
    t = tokens(content)
    return [" ".join(t[i : i + n]) for i in range(len(t) - n + 1)]


class Model:
    def __init__(self):
        self.uris: dict[str, str] = {}
        self.texts: dict[str, str] = {}

    def apply(self, rows: list[tuple[str, str, int]]) -> None:
        last = {}
        for uri, content, seq in sorted(rows, key=lambda r: r[2]):
            last[uri] = (content, seq)
        changed = {u: v for u, v in last.items() if self.uris.get(u) != digest(v[0])}
        for uri, (content, _) in changed.items():
            self.uris[uri] = digest(content)
        live = set(self.uris.values())
        for uri, (content, seq) in sorted(changed.items(), key=lambda kv: (kv[1][1], kv[0])):
            self.texts.setdefault(digest(content), content)
        self.texts = {h: t for h, t in self.texts.items() if h in live}

    def refs(self) -> dict[str, int]:
        return dict(Counter(self.uris.values()))

    def counts(self) -> dict[str, tuple[int, int]]:
        docs, total = Counter(), Counter()
        for text in self.texts.values():
            found = Counter(phrases(text))
            total.update(found)
            docs.update(found.keys())
        return {p: (docs[p], total[p]) for p in total}
