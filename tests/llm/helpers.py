"""Small tables with every awkward case, and reference computations without Spark."""

import random

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp string, copies string, drop string"


def documents(spark, rows):
    """Documents of (doc_id, text, source), with further columns whose names the operators use themselves."""
    full = [(i, t, "en", s, None if t is None else len(t), 7, "fp", "copies", None) for i, t, s in rows]
    return spark.createDataFrame(full, EXTRA)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    known = "the of and to a in is that it was for on with as be by this are at from".split()
    made = ["".join(draw.choice(["ba", "ke", "lo", "mi", "tu", "ra"]) for _ in range(draw.randint(2, 4))) for _ in range(200)]
    return " ".join(draw.choice(known) if draw.random() < 0.35 else draw.choice(made) for _ in range(words))


def awkward():
    """Null, empty and blank texts, null ids and sources, ties, repeated rows, and a very long text."""
    return [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (None, "no id here at all", "b"), (None, None, None),
        (4, prose(1, 80), "b"), (4, prose(1, 80), "b"), (5, prose(1, 80), "b"), (6, prose(2, 30_000), "c"),
        (7, "\n".join(["one line that comes again and again"] * 4), "a"), (8, "É word\x1c <|endoftext|>  x ", "a"),
    ]


def components(nodes, links):
    """Smallest reachable node of each node."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}
