"""Small documents that hold every awkward case, and brute-force answers."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, rank string, spans string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def sentence(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * (seed % 5 + 1) + i * i) % len(WORDS)] + str((seed + i) % 23) for i in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    """Ids out of order, a NULL id, NULL, empty, blank and very long texts, copies, near copies, repeated rows."""
    long = sentence(3, 9000)
    base = sentence(11, 60)
    rows: list[tuple[int | None, str | None]] = [
        (40, base),
        (41, base),
        (7, base + " tail"),
        (8, base.replace("alpha", "ALPHA")),
        (9, " ".join(base.split()[3:])),
        (12, None),
        (13, ""),
        (14, " \n\t "),
        (15, "word"),
        (16, "WORD"),
        (17, "one two three"),
        (20, long),
        (21, long[: len(long) // 2] + " changed here " + long[len(long) // 2 :]),
        (22, "x" * 50_000),
        (23, "été  café\n\nnaïve\tend 中文文本没有空格"),
        (24, "Write to ann.lee@mail.example.com or call +1 (415) 555-2671, card 4111 1111 1111 1111."),
        (25, "host 10.0.0.1 and 300.1.1.1, card 4111111111111112, password=hunter2hunter2"),
        (30, sentence(5, 40)),
        (30, sentence(5, 40)),
        (None, sentence(6, 30)),
    ]
    rows += [(100 + i, sentence(i, 5 + i % 50)) for i in range(40)]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    data = [(i, t, "en", "s", None if t is None else len(t), 3, "r", "p") for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def shingles(text: str | None, size: int = 5) -> frozenset:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if 0 < len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(rows) -> dict[int, int]:
    """Smallest id reachable by links of Jaccard 0.75 or more."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 75 * len(sets[a][1] | sets[b][1]):
                parent[find(a)] = find(b)
    groups: dict[int, list] = {}
    for k, (i, _) in enumerate(sets):
        groups.setdefault(find(k), []).append(i)
    return {i: min(x for x in ids if x is not None) for ids in groups.values() for i in ids if i is not None}
