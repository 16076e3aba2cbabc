"""Small tables with awkward rows, shared by the tests of this folder."""
import random

WEIRD = [
    (0, "", "en", "a"), (1, None, None, None), (2, " \t\n\x0b\x0c\r ", "en", "a"),
    (3, "one", "en", "b"), (4, "one", "fr", "b"), (5, "ONE", None, "b"),
    (6, "a b c d e f g h i j " * 30, "en", None), (7, "line\nline\n\n line\nline \nline", "de", "a"),
    (8, "中文 文字，好 吗　中文", "zh", "c"), (9, "Привет мир " * 40, "ru", "c"),
    (10, "it's <|endoftext|> don't # $ % & | < > *[", "en", "c"), (11, "\U0001f600 é é  x y", None, "a"),
    (12, "x" * 70_000, "en", "a"), (13, "word " * 20_000, "en", "a"), (-5, "neg\r\nid\r\n\r\n", "en", "z"),
    (2**40, "big id\u0000nul", "en", "Z"),
]


def weird(spark, extra=()):
    """The awkward rows, with columns whose names clash with internal ones."""
    rows = [(i, t, lang, s, len(t or ""), "id", (i or 0) % 2 == 0) for i, t, lang, s in [*WEIRD, *extra]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id string, kept boolean")


def empty(spark):
    return weird(spark).limit(0)


def prose(n, seed=0, words=(5, 200), vocabulary=400):
    """(doc_id, text) with shared passages, exact and near copies and repeated lines."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghijklmnoprstuv") for _ in range(r.randint(1, 9))) for _ in range(vocabulary)]
    passage = [r.choice(vocab) for _ in range(60)]
    out = []
    for i in range(n):
        kind = r.random()
        if out and kind < 0.15:
            text = r.choice(out)[1]
        elif out and kind < 0.4:
            w = r.choice(out)[1].split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[r.randrange(len(w))] = r.choice(vocab)
            text = " ".join(w)
        else:
            w = [r.choice(vocab) for _ in range(r.randint(*words))]
            if kind > 0.7:
                k = r.randrange(len(w))
                cut = r.randint(15, 60)
                w[k:k] = passage[:cut]
            text = " ".join(x + ("\n" if r.random() < 0.1 else "") for x in w)
        out.append((i, text))
    return out
