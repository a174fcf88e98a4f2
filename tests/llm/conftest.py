import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, sources=None, ids=None):
        rows = [(ids[i] if ids else i, t, "en", sources[i % len(sources)] if sources else "s", len(t) if t else 0) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Invented texts: long and short, with copies, near copies, shared passages and lines, odd white space, and no text."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(400)] + ["Ünïcode", "ß", "İx", "naïve"]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    passage = " ".join(say(60))
    line = " ".join(say(12))
    out = []
    for i in range(120):
        n = rng.choice([0, 1, 2, 5, 19, 20, 21, 40, 150, 400])
        text = " ".join(say(n))
        if i % 5 == 0:
            text += " " + passage + " " + " ".join(say(5))
        if i % 7 == 0:
            text = line + "\n" + text + "\n" + line
        if i % 11 == 0:
            near = list(line)
            near[rng.randrange(len(near))] = "z"
            text += "\n" + "".join(near)
        out.append(text)
    base = say(300)
    for i in range(12):
        near = list(base)
        for _ in range(i % 6):
            near[rng.randrange(len(near))] = rng.choice(words)
        out.append(" ".join(near))
    out += [out[3], out[3].upper(), out[10], "", None, None, " \t\n", "a b  c\x0bd\x0ce\rf", "x" * 500, "Word word WORD " * 80]
    return out


@pytest.fixture(autouse=True)
def no_waiting(monkeypatch):
    """Shuffle files of these small tables need not be deleted at once."""
    from tierline.llm import lines, minhash

    for module in (lines, minhash):
        monkeypatch.setattr(module, "let_go", lambda spark: None)
