import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """Invented texts: words of a small vocabulary, some near copies, exact copies, empties and a very long one."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(30, 80))) for _ in range(60)]
    for i in range(12):
        parts = texts[i].split()
        parts[rng.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    texts += texts[:5] + [None, "", "", "   ", "one", "One", "one two three", "ONE  two\nthree", " ".join(rng.choices(words, k=4000))]
    return texts
