"""Small made corpora and plain-Python forms of what the operators compute."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None, pattern: str = r"[^\x20\x09-\x0D]+", lower: bool = False) -> list[str]:
    text = text or ""
    if lower:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    return re.findall(pattern, text)


def corpus(seed: int, rows: int = 40, vocabulary: int = 60, longest: int = 60) -> list[tuple]:
    """Random texts with copies, near copies, shared passages, blanks, nulls and repeated rows."""
    rng = random.Random(seed)
    vocab = [("é" if rng.random() < 0.1 else "") + "".join(rng.choices("abcdeABC", k=rng.randint(1, 6))) for _ in range(vocabulary)]
    passage = " ".join(rng.choices(vocab, k=20))
    out: list[tuple] = []
    for i in range(rows):
        text = "".join(w + rng.choice([" ", " ", "\n", "  ", "\t"]) for w in rng.choices(vocab, k=rng.randint(0, longest)))
        kind = rng.random()
        if kind < 0.1 and out:
            text = rng.choice(out)[1]
        elif kind < 0.3 and out:
            old = (rng.choice(out)[1] or "").split(" ")
            old[rng.randrange(len(old))] = "zz"
            text = " ".join(old)
        elif kind < 0.5:
            text = f"{text} {passage} {rng.choice(vocab)}"
        elif kind < 0.55:
            text = None
        elif kind < 0.6:
            text = rng.choice(["", " \n\t "])
        out.append((i * 3, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(text or "")))
    out.append(out[0])
    out.append((None, passage, None, None, 1))
    rng.shuffle(out)
    return out
