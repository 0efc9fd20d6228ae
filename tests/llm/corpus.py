"""Small tables for the tests: documents with all kinds of odd rows, and random ones."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, shard string, _text string, target double, cls int, p int, skey string"
WORDS = "the of and stone river light paper green seven house water under music field open close table north cloud glass".split()


def line(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 400)) for _ in range(n))


def row(doc_id, text, lang="en", source="src1"):
    n = None if text is None else len(text)
    return (doc_id, text, lang, source, n, 7, "x", "y", 0.5, 3, 2, "z")


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    shared = "\n".join(line(rng, 12) for _ in range(4))
    long = "\n".join(line(rng, 50) for _ in range(300))
    rows = [
        row(1, None), row(2, ""), row(3, " \t\n "), row(4, "word"), row(5, "two words"), row(6, long), row(7, long),
        row(None, "a text without id " + shared), row(8, shared, None, None), row(9, shared + "\n" + line(rng, 30), "de", None),
        row(10, shared, "fr", "src2"), row(10, shared, "fr", "src2"), row(10, shared, "fr", "src2"), row(11, "x" * 20000),
        row(12, "same " * 400), row(13, "Ünïcödé mail a.b@ex-ample.org, card 4111 1111 1111 1111 漢字"), row(None, None, None, None),
        row(14, line(rng, 40) + "\nReleased under the MIT License.\n" + line(rng, 40), "es", "ä"),
    ]
    return rows


def random_rows(n: int = 120, seed: int = 3) -> list[tuple]:
    """Documents with exact and near copies, shared passages and repeated lines."""
    rng = random.Random(seed)
    passages = ["\n".join(line(rng, rng.randint(3, 25)) for _ in range(rng.randint(1, 5))) for _ in range(6)]
    texts: list[str] = []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            text = rng.choice(texts)
        elif texts and kind < 0.45:
            words = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = "new" + str(rng.randint(0, 99))
            text = " ".join(words)
        else:
            text = "\n".join(line(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 12)))
            if kind > 0.75:
                text += "\n" + rng.choice(passages) + "\n" + line(rng, 5)
            if kind > 0.95:
                text += "\n\n" + "\n".join(["again and again"] * 30)
        texts.append(text)
    return [row(i, t, rng.choice(["en", "de", None]), f"src{rng.randint(0, 5)}") for i, t in enumerate(texts)]
