"""Small tables for the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of other tables' names, which no operator may trip over.
EXTRA = ", key string, payload string, kind int, bucket long, score double, kept string, fp long, g string, row string"


def documents(spark, texts, extra: bool = False, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", f"src{k % 3}", len(t) if t is not None else None) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    if extra:
        rows = [(*r, "k", "p", 1, 2, 0.5, "yes", 3, "g", "r") for r in rows]
    return spark.createDataFrame(rows, DOCS + (EXTRA if extra else ""))


def prose(seed: int, n: int, vocabulary: int = 3000) -> str:
    """n invented words in sentences and lines."""
    rng = random.Random(seed)
    out, sentence = [], 0
    for _ in range(n):
        r = rng.randrange(vocabulary)
        w = "".join("bcdfghklmnprstvz"[(r >> s) % 16] + "aeiou"[(r >> s) % 5] for s in (0, 4, 8))[: 3 + r % 4]
        sentence += 1
        if sentence >= 8 + r % 7:
            w, sentence = w + (".\n" if r % 3 == 0 else "."), 0
        out.append(w)
    return " ".join(out).replace("\n ", "\n")


ODD = [None, "", " \n\t ", "one", "two words", "à côté de ça ligne", "\x00\x0b\x0c", "x" * 5000, "a b " * 3000]
