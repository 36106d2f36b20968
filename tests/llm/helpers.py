"""Documents with every awkward case, and plain versions of the operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, hits string, taken bigint, __h string, host_pages int, gone_id int"


def words(rng: random.Random, n: int, size: int = 200) -> str:
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def corpus(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    base = [words(rng, 60) for _ in range(12)]
    texts = list(base)
    for b in base[:6]:
        t = b.split()
        t[30] = "changed"
        texts += [b, " ".join(t), b.replace(" ", "\n"), b.upper()]
    texts += [None, "", " \t\n", "one two", "one two", "x", words(rng, 30000), base[0] + "\n" + base[1] + "\n" + base[0], "boiler plate line\n" + words(rng, 9), "a" * 700, "ab" * 400, "é" * 120 + "𝄞" * 40]
    texts += ["boiler plate line\n" + words(rng, 5) + f"\n{i}" for i in range(8)]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s1", None, "s2"][i % 4], None if t is None else len(t), "h", 1, "x", 1, 1) for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, base[2], "en", "s1", 1, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
