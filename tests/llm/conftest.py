import random

import pytest

CLASH = ("doc_id long, text string, kept boolean, shard int, component_id string, ids string, key int, kind int, "
         "block string, row string, n_chars long, `odd name` string, __id long, doc string")


def corpus(seed=7, n=120):
    """Small texts with copies, near copies, shared passages, repeats, odd
    white space, nulls, empty texts and one long text."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "straße", "The", "the", "漢字", "###", "a|b"]
    word = lambda k: [rnd.choice(vocab) for _ in range(k)]
    passage = word(70)
    docs = []
    for i in range(n):
        w = word(rnd.choice([1, 3, 4, 12, 60, 130]))
        if i % 5 == 0:
            at = rnd.randint(0, len(w))
            cut = rnd.randint(0, 25)
            w = w[:at] + passage[cut:] + w[at:]
        docs.append(" ".join(x + rnd.choice(["", "", "", "\n", "\t"]) for x in w))
    docs += [docs[3], docs[3] + "  ", docs[8].replace(" ", "\n"), docs[3]]                    # equal texts
    big = word(200)
    for k in range(20):                                                                       # near copies
        c = list(big)
        for _ in range(rnd.randint(0, 6)):
            c[rnd.randrange(len(c))] = rnd.choice(vocab)
        docs.append(" ".join(c))
    docs += ["", None, " \n\t ", None, "x", "same same same same " * 40, " ".join(word(20000)), "one two", "ONE two"]
    docs += ["a" * 5000, "end<|endoftext|>of text", "\u3000x\x85y\x1cz", "\u3000\n\u3000\n \n\x1c\n\x1c\n" + "w v " * 9]
    return docs


@pytest.fixture(scope="session")
def texts():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The corpus with ids in another order than its rows, repeated rows, a
    null id and columns whose names operators use themselves."""
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    rows = [(i, t) for i, t in zip(ids, texts)]
    rows += [rows[3], rows[3], rows[40], (None, texts[5]), (None, "no id at all"), (None, None)]
    full = [(i, t, None, 3, "c", None, 1, 7, "b", None, len(t) if t else None, "q", 0, "d") for i, t in rows]
    return spark.createDataFrame(full, CLASH).repartition(5)


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], CLASH)


@pytest.fixture(scope="session")
def vocabulary():
    from qtrlens.llm.bpe import default_vocabulary
    return default_vocabulary()
