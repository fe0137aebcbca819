"""Edge rows that every operator must survive, and plain versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside or return; as extra columns they must neither break nor be changed.
CLASHING = ["score", "lang_pred", "hash", "key", "fp", "group", "words", "places", "n_words", "line", "start", "end", "spans",
            "ids", "id", "leaf", "bucket", "own", "rank", "shard", "node", "root", "a", "b", "item", "term", "kind", "run", "similarity"]

LONG = " ".join(f"word{k % 997} runs on." for k in range(20_000))
UNSPLIT = "漢字" * 6_000 + "x" * 9_000 + "0123456789" * 900 + "!?" * 5_000 + " " * 5_000 + "é" * 6_000

EDGE_ROWS = [
    (None, "A row without an id. It has two sentences.", "en", "a", 10),
    (None, None, None, None, None),
    (1, None, "en", "a", None),
    (2, "", "en", None, 0),
    (3, " \n\t ", "de", "a", 4),
    (4, "Same text, twice over, in two rows that repeat each other word by word and id by id, to the end of it.", "en", "a", 5),
    (4, "Same text, twice over, in two rows that repeat each other word by word and id by id, to the end of it.", "en", "a", 5),
    (4, "Another text under an id that is taken.", "en", "a", 5),
    (5, LONG, "en", "b", len(LONG)),
    (6, UNSPLIT, None, "b", len(UNSPLIT)),
    (7, "1234 5678 !!! ...", None, "b", 17),
    (8, "tail <|endoftext|>  <|endoftext|>\u0000 � 😀 é", "xx", "b", 1),
    (9, "Same text, twice over, in two rows that repeat each other word by word and id by id, to the end of it.", "fr", "c", 5),
]


def edge_docs(spark, extra: bool = True):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(EDGE_ROWS, SCHEMA)
    return docs.withColumns({name: F.lit(f"own {name}") for name in CLASHING}) if extra else docs


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def simhash(text, size: int = 3) -> int:
    """Fingerprint, word by word and bit by bit."""
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(prints: dict, most: int = 2) -> dict:
    """Least key reachable over pairs of at most ``most`` differing bits."""
    parent = {k: k for k in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(prints)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 - 9 * (int(d) > 4) if k % 2 else int(d) for k, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def personal(text: str) -> list[tuple]:
    """(start, kind number, end, kind) by the contract's own patterns."""
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]
    out = []
    for number, (kind, pattern) in enumerate(kinds):
        for match in re.finditer(pattern, text):
            value, digits = match.group(), re.sub("[^0-9]", "", match.group())
            if kind == "ip" and any(int(p) > 255 for p in value.split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((match.start(), number, match.end(), kind))
    return sorted(out)


def decontaminate(text, items: dict, window: int = 13) -> tuple:
    """Words, words hit, items found, and the verdict."""
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    words, hit, found = words_of(text), set(), set()
    for item, item_text in items.items():
        own = words_of(item_text)
        size = min(window, len(own))
        wanted = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
        for k in range(len(words) - size + 1):
            if own and tuple(words[k : k + size]) in wanted:
                hit.update(range(k, k + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)


def likeness(a: list, b: list) -> float:
    left, right = Counter(a), Counter(b)
    union = sum((left | right).values())
    return sum((left & right).values()) / union if union else 1.0
