"""Documents that try an operator: copies, shared passages, nulls, long and empty texts."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, block string, kept int,"
    " _doc long, `_later` long, hash string, other string, `a.b` int"
)


def prose(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def thue_morse(n):
    """Two words of 2^n letters that every polynomial hash modulo 2^64 takes for one, if n > 9."""
    word = "a"
    for _ in range(n):
        word += word.translate({97: "b", 98: "a"})
    return word, word.translate({97: "b", 98: "a"})


def odd_documents(seed=0, n=60):
    """Rows of SCHEMA; `block` and `kept` are extra columns whose names clash with inner ones."""
    rng = random.Random(seed)
    passage = prose(rng, 80)
    base = prose(rng, 120)
    texts = []
    for k in range(n):
        kind = k % 10
        own = prose(rng, rng.randrange(1, 160))
        if kind < 3:
            texts.append(own)
        elif kind == 3:
            texts.append(f"{own} {passage} {prose(rng, 30)}")
        elif kind == 4:
            words = base.split()
            words[rng.randrange(len(words))] = f"edit{k}"
            texts.append(" ".join(words))
        elif kind == 5:
            texts.append(base)
        elif kind == 6:
            texts.append(f"{own}\n\n  {passage[40:]}\té{k} ß x")
        elif kind == 7:
            texts.append("aaaa " * rng.randrange(0, 90))
        elif kind == 8:
            texts.append(rng.choice(["", None, " ", "\n", "one", "ünï", "a\x00b " * 60]))
        else:
            texts.append(f"{passage} {passage} {own}")
    texts.append(prose(rng, 4000) + " " + base + " " + prose(rng, 3000, 20))
    ids = list(range(0, 3 * len(texts), 3))
    rng.shuffle(ids)
    rows = [
        (i, t, rng.choice(["en", None]), f"src{k % 3}", None if t is None else len(t), "b", None, i, i, "h", None, 1)
        for k, (i, t) in enumerate(zip(ids, texts, strict=True))
    ]
    rows.append(rows[5])  # a repeated row
    rows.append((ids[5], passage, None, None, 1, *[None] * 7))  # an id twice, other text
    rows.append((None, passage + " tail", *[None] * 10))
    rows.append((None, base, *[None] * 10))
    return rows
