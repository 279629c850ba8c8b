import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus import documents, table
from tokenizers import Tokenizer

from evenkeel.llm import tokencount
from evenkeel.llm.common import flat

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    return tokencount.Tokenizer(PATH), Tokenizer.from_file(PATH)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_random_texts(both):
    compiled, library = both
    rng = random.Random(4)
    parts = ["'", "s", "re", "ve", "ll", "d", "t", "m", " ", "  ", "\n", "\t", "a", "B", "9", "½", "é", "漢", "!", "?", "'r", "'l", "<|endoftext|>", "<|endof", " ", "　", "\U0001F600", "x" * 50, "----", "'v", "ſ", "\x00", "İ", "the", "ing"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    assert compiled.count(*flat(pa.array(texts))).tolist() == expected(library, texts)


def test_chunks_compose(both):
    """Any chunk length gives the marks of one run from start to end."""
    classes = np.append(np.random.default_rng(1).integers(0, 11, 5000), 11).astype(np.uint8)
    one = tokencount.split_marks(classes, 5001)
    assert all((tokencount.split_marks(classes, n) == one).all() for n in (1, 7, 64, 1000))


def test_starting_afresh_changes_nothing(both, monkeypatch):
    compiled, library = both
    monkeypatch.setattr(tokencount, "MOST_STATES", 50)
    monkeypatch.setattr(tokencount, "MOST_PIECES", 50)
    texts = [t for _, t in documents()]
    for t in texts:
        assert compiled.count(*flat(pa.array([t], pa.string()))).tolist() == expected(library, [t])


def test_operator(spark, both):
    rows = [*documents(), (None, "it's"), (1, "again")]
    got = tokencount.token_counts(table(spark, rows), PATH).collect()
    texts = [t for _, t in rows]
    want = sorted(((i, len((t or "").encode()), n) for (i, t), n in zip(rows, expected(both[1], texts))), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert tokencount.token_counts(table(spark, rows).limit(0), PATH).isEmpty()
