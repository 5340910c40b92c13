"""Small inputs with every awkward case, and plain versions of the operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, marker string, places int, copy string, dropped_lines int, score string"


def sentence(random_, words):
    return " ".join(random_.choice(words) for _ in range(random_.randint(3, 14)))


def documents(seed=3, count=60):
    """``(doc_id, text)``: copies, near copies, shared passages, repeated words, nulls, blanks and one long text."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghijéß") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    passage = " ".join(rnd.choice(words) for _ in range(130))
    texts = []
    for i in range(count):
        lines = [sentence(rnd, words) for _ in range(rnd.randint(1, 25))]
        if i % 4 == 0:
            lines.insert(rnd.randint(0, len(lines)), f"Page {i} of 99 is free")
        if i % 5 == 0:
            lines.insert(rnd.randint(0, len(lines)), passage)
        texts.append("\n".join(lines))
    for i in range(12):
        near = texts[i].split(" ")
        near[rnd.randrange(len(near))] = "changed"
        texts.append(" ".join(near))
    texts += [texts[3]] * 5 + ["ab " * 700, "z" * 3000, "one two", "one two", "", "  \n\t ", None, "long " + " ".join(rnd.choice(words) for _ in range(20_000))]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in rows] + [(None, texts[0])]


def frame(spark, rows, sources=("a", "b", None)):
    full = [(i, t, "en", sources[(i or 0) % len(sources)], len(t or ""), "m", 1, "c", 2, "s") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(text):
    return WORD.findall(text or "")


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
