from __future__ import annotations

import random

import pytest

ROWS = "doc_id long, text string, digest string, fp long, group int, score string"


@pytest.fixture(scope="session")
def texts():
    """Invented texts with copies, near copies, odd white space, an empty and a very long one."""
    rng = random.Random(4)
    words = ["".join(rng.choice(["ta", "re", "no", "li", "mu", "és", "ok"]) for _ in range(rng.randint(1, 4)))
             for _ in range(300)]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 120))) for _ in range(30)]
    near = out[3].split(" ")
    near[7] = "changed"
    out += [out[0], out[0].replace(" ", "\n\t"), out[0] + " ", " ".join(near), out[3].upper()]
    out += ["", "   ", "one", "two words", "<|endoftext|> it's\x1c odd space", " ".join(rng.choice(words) for _ in range(30000))]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts, tmp_path_factory):
    """The texts with a null text, a null identifier, a repeated row, and columns with clashing names."""
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(len(rows), None), (None, texts[5]), (7, texts[7]), (7, texts[7])]
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    full = [(i, t, "d", 1, 2, "s") for i, t in rows]
    spark.createDataFrame(full, ROWS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ROWS)


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]
