"""Small awkward tables for the corpus operators."""

import random

SCHEMA = "doc_id long, text string, id string, key long, sha string, n int, part string, label string"

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def odd_rows():
    """Nulls, empty and very long texts, equal texts, repeated rows and repeated ids; columns
    whose names the operators use inside."""
    base = "the quick brown fox jumps over the lazy dog near the old river bank today"
    texts = [(1, base), (2, None), (3, ""), (4, base.replace(" ", " \t")), (5, LONG), (6, "x"),
             (7, base + " again"), (7, base + " again"), (8, "Ünï çødé 日本語 🙂 " * 5), (9, "\n\n  \t"),
             (10, base.upper()), (11, LONG + " end"), (None, "a row without an id"), (12, base), (2, "second two")]
    return [(i, t, "clash", 5, "s", None, "p", None) for i, t in texts]


def sentences(rng: random.Random, syllables: list[str], n: int) -> str:
    out = []
    for _ in range(n):
        out.append("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))))
    return " ".join(out)


def auc(score, label):
    pairs = [(s, l) for s, l in zip(score, label)]
    pos, neg = [s for s, l in pairs if l], [s for s, l in pairs if not l]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
