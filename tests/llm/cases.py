"""Texts and tables that operators have to get right."""

import random

from pyspark.sql import functions as F

EMPTY: list = []
CLASH = ("score", "n_tokens", "part", "start", "class", "shingle", "key", "base", "segments", "doc", "row", "grp", "lane", "spans", "_doc")


def docs_frame(spark, rows, clashing=()):
    """A documents table; `clashing` adds columns whose names operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit("x") for c in clashing})


def texts():
    rng = random.Random(5)
    words = ["Mar", "house", "élan", "straße", "it's", "3.14", "foo_bar", "don't,", "naïve.", "日本語", "🙂", "a" * 40]
    long = " ".join(rng.choice(words) for _ in range(3000))
    return [
        None, "", " ", "  two  spaces ", "\n\nlines\n and\ttabs\r\n", "<s> </s> <unk> <|endoftext|> <|startoftext|> x<|endoftext|>y", "▁under▁score ▁ ▁▁x",
        " no break　wide", "é combining ́alone", "x\u0000y  ", "don't we'll I'm you're IT'S 'tis", "ΑΣ ΣΑΣ. İstanbul ſ K",
        "0123456789 1 22 333 4444", "word" * 300, "!" * 100 + " ?" * 20, "日本語のテキスト、です。 中文 字", long, "The cat sat. The cat sat.", "a", "\n", "🙂🙂 🙂‍🙂 a\u0085b",
    ]


def random_texts(n, seed=1, vocabulary=40):
    """Texts that share passages, with exact and near copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passage = " ".join(rng.choice(words) for _ in range(18))
    out = []
    for _ in range(n):
        kind = rng.random()
        if out and kind < 0.2:
            out.append(rng.choice(out))
        elif out and kind < 0.5:
            own = rng.choice(out).split(" ")
            for _ in range(rng.randint(1, 2)):
                own[rng.randrange(len(own))] = rng.choice(words)
            out.append(" ".join(own))
        else:
            own = [rng.choice(words) for _ in range(rng.randint(1, 60))]
            out.append(" ".join(own) + (f" {passage}" if kind > 0.8 else ""))
    return out
