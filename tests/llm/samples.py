"""Made-up documents."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long, class_id string, size string, w string, key string, tag int"
SYLLABLES = ["an", "ou", "té", "ra", "ki", "los", "mé", "ver", "ß", "qui", "no", "ta"]


def prose(rng, n, vocabulary=None):
    ws = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    out = []
    for i, w in enumerate(ws):
        out.append(w)
        out.append("\n" if rng.random() < 0.08 else "\t" if rng.random() < 0.02 else " ")
    return "".join(out)


def corpus(seed=1):
    """Prose, exact and near copies, shared passages, junk, nulls, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(3, 150)) for _ in range(40)]
    texts += [prose(rng, 3000)]
    base = prose(rng, 120)
    for k in range(14):
        w = base.split(" ")
        for _ in range(k % 5):
            w[rng.randrange(len(w))] = "neu" + str(k)
        texts.append(" ".join(w))
    texts += [texts[3]] * 5 + [texts[40]] * 2
    shared = prose(rng, 40)
    texts += [prose(rng, 20) + shared[: rng.randint(40, len(shared))] + prose(rng, 20) for _ in range(10)]
    texts += ["ab " * 400, "x" * 49, "x" * 50, "x" * 500, "one", "a b c d", None, "", " \n\t ", "\x0b\x0c", "%%% ***" * 60, "a\x1cb\x85c\xa0d " * 30]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[5], (None, texts[7]), (None, None), (rows[9][0], "another text under the same id " * 4)]
    return rows
