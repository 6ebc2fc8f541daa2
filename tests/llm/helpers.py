"""Small tables with everything that is awkward in them."""

import random

SF_DIR = "/root/testdata/sf0.001"
WORDS = "ash birch cedar elm fir hazel larch maple oak pine rowan willow alder beech yew lime".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


def documents(spark, rows):
    """Rows of (doc_id, text) with further columns whose names the operators use themselves."""
    wide = [(i, t, "en", "s", 0, 1, "x", b"x") for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, block int, node string, lane binary"
    return spark.createDataFrame(wide, schema)


def awkward():
    """NULLs, empty and blank texts, ties, repeated rows, a long text, equal texts under many ids."""
    rng = random.Random(3)
    base = [sentence(rng, 40) for _ in range(6)]
    near = base[0].split()
    near[20] = "changed"
    texts = [
        (1, base[0]),
        (2, " ".join(near)),
        (3, base[1]),
        (3, base[1]),
        (4, None),
        (5, ""),
        (6, "   \n\t\n"),
        (7, base[2] + "\n" + base[3]),
        (8, base[3] + "\n\n" + base[2].upper()),
        (9, "one"),
        (10, "one"),
        (None, base[4]),
        (None, base[4]),
        (11, base[4]),
        (12, sentence(rng, 5000)),
        (13, "12345 !!! ???"),
        (14, "日本語 ▁ é 😀\x00 <|endoftext|> x"),
        (15, None),
    ]
    return texts + [(20 + i, base[5]) for i in range(12)]


class Groups:
    """Union by the smallest member."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a
